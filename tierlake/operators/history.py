"""Type-2 history of a dimension: one row per version, with validity bounds.

Snapshots that arrive in order extend a history directly (``first_versions``, ``next_versions``).
Versions that may arrive late are kept as observations, of which ``versions_of`` makes the history;
``version_at`` gives facts the version valid at their own time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.functions import content_hash

VALIDITY = ("_version_hash", "_valid_from", "_valid_to", "_is_current")


def first_versions(snapshot: DataFrame, pk: str, attributes: Iterable[str], at: Column) -> DataFrame:
    columns = list(attributes)
    return snapshot.select(
        pk,
        *columns,
        content_hash(columns).alias("_version_hash"),
        at.alias("_valid_from"),
        F.lit(None).cast("timestamp").alias("_valid_to"),
        F.lit(True).alias("_is_current"),
    )


def next_versions(
    history: DataFrame,
    snapshot: DataFrame,
    pk: str,
    attributes: Iterable[str],
    at: Column,
    close_missing: bool = False,
) -> DataFrame:
    """History after one more snapshot (one row per key).

    Changed keys get their open version closed at ``at`` and a new one opened; new keys open
    their first version; unchanged keys stay. Keys absent from the snapshot stay open unless
    ``close_missing``. Closed versions pass through untouched; open ones meet the snapshot in a
    single full outer join.
    """
    columns = list(attributes)
    names = [pk, *columns, *VALIDITY]
    incoming = first_versions(snapshot, pk, columns, at)
    closed = history.where(~F.col("_is_current")).select(*names)
    open_rows = history.where(F.col("_is_current")).select(*names)

    paired = open_rows.select(F.col(pk).alias("_key"), F.struct(*names).alias("old")).join(
        incoming.select(F.col(pk).alias("_key"), F.struct(*names).alias("new")), "_key", "full_outer"
    )
    ended = F.struct(
        *[F.col(f"old.{c}").alias(c) for c in [pk, *columns, "_version_hash", "_valid_from"]],
        at.alias("_valid_to"),
        F.lit(False).alias("_is_current"),
    )
    changed = ~F.col("old._version_hash").eqNullSafe(F.col("new._version_hash"))
    gone = F.array(ended) if close_missing else F.array("old")
    versions = (
        F.when(F.col("old").isNull(), F.array("new"))
        .when(F.col("new").isNull(), gone)
        .when(changed, F.array(ended, F.col("new")))
        .otherwise(F.array("old"))
    )
    current = paired.select(F.explode(versions).alias("row")).select("row.*")
    return closed.unionByName(current)


def observed(rows: DataFrame, pk: str, attributes: Iterable[str], at: str, tie: str) -> DataFrame:
    """What rows say about their keys, and when. Rows without a key or a time say nothing.

    Observations only accumulate: later ones, earlier ones and the same ones again may be added by
    ``unionByName`` in any order. ``tie`` (not NULL, the least counts) decides among those of one
    moment, so it should depend on the row alone, as a row hash does.
    """
    columns = list(attributes)
    return rows.where(F.col(pk).isNotNull() & F.col(at).isNotNull()).select(
        pk, *columns, content_hash(columns).alias("_version_hash"), F.col(at).alias("_seen_at"), F.col(tie).alias("_tie")
    )


def versions_of(
    observations: DataFrame,
    pk: str,
    attributes: Iterable[str],
    heavy: DataFrame | None = None,
    span_days: int = 31,
) -> DataFrame:
    """The history that observations amount to, whatever order they came in.

    A version opens where a key's attributes differ from those before, and is valid until the next
    one opens. An observation that changed nothing opens nothing, but counts when a late one comes
    to lie before it. One shuffle and one sort serve all three window steps. The windows keep no
    key's rows in memory; yet keys in ``heavy`` (see ``skew.heavy_keys``) are worked on in spans of
    ``span_days``, so that none of them is one task. The list only steers; results are the same.
    """
    columns = list(attributes)
    if heavy is None:
        return _closed(_opening(_first_seen(observations, [pk]), [pk]), [pk]).select(pk, *columns, *VALIDITY)

    marks = heavy.select(F.col(pk).alias("_heavy"))
    span = F.when(F.col("_heavy").isNotNull(), F.floor(F.unix_date(F.to_date("_seen_at")) / span_days)).otherwise(F.lit(0))
    part = [pk, "_span"]
    spanned = observations.join(F.broadcast(marks), F.col(pk) == F.col("_heavy"), "left").withColumn("_span", span)
    moments = _first_seen(spanned, part)
    ordered = Window.partitionBy(pk).orderBy("_span")
    split = F.col("_heavy").isNotNull()

    # What a span of a heavy key needs of the others is one row for each of them.
    ends = moments.where(split).groupBy(*part).agg(F.max_by("_version_hash", "_seen_at").alias("_last_hash"))
    before = ends.select(*part, F.lag("_last_hash").over(ordered).alias("_hash_before"))
    opened = _opening(moments.join(before, part, "left"), part, F.col("_hash_before"))
    starts = opened.where(split).groupBy(*part).agg(F.min("_seen_at").alias("_first_open"))
    after = starts.select(*part, F.lead("_first_open").over(ordered).alias("_open_after"))
    return _closed(opened.join(after, part, "left"), part, F.col("_open_after")).select(pk, *columns, *VALIDITY)


def _first_seen(observations: DataFrame, part: list[str]) -> DataFrame:
    """One observation of each moment: the one with the least tie."""
    order = Window.partitionBy(*part).orderBy("_seen_at", "_tie")
    previous = F.lag("_seen_at").over(order)
    return observations.withColumn("_repeated", previous.eqNullSafe(F.col("_seen_at"))).where("NOT _repeated").drop("_repeated")


def _opening(moments: DataFrame, part: list[str], before: Column | None = None) -> DataFrame:
    """Those that differ from the one before; ``before`` is the hash before a part's first."""
    previous = F.lag("_version_hash").over(Window.partitionBy(*part).orderBy("_seen_at", "_tie"))
    previous = previous if before is None else F.coalesce(previous, before)
    return moments.withColumn("_same", previous.eqNullSafe(F.col("_version_hash"))).where("NOT _same").drop("_same")


def _closed(opened: DataFrame, part: list[str], after: Column | None = None) -> DataFrame:
    """Validity bounds; ``after`` is the next opening behind a part's last."""
    following = F.lead("_seen_at").over(Window.partitionBy(*part).orderBy("_seen_at", "_tie"))
    until = following if after is None else F.coalesce(following, after)
    return opened.withColumn("_valid_to", until).select(
        "*", F.col("_seen_at").alias("_valid_from"), F.col("_valid_to").isNull().alias("_is_current")
    )


def version_key(pk: str) -> Column:
    """A key of a version that a rebuilt history gives it again: hash of the key and its start."""
    start = F.date_format("_valid_from", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.sha2(F.concat_ws("|", F.col(pk).cast("string"), start), 256)


def version_at(
    facts: DataFrame, history: DataFrame, pk: str, at: str, carry: Iterable[str], bin_days: int = 366
) -> DataFrame:
    """Facts with the ``carry`` columns of the version of their key valid at their time.

    ``_valid_from`` is included in a version's time, ``_valid_to`` is not. Every fact stays once;
    those without a key, a time or a version valid then get NULL. Versions are listed in each time
    bin they touch between the facts' first and last, so that key and bin join by equality and the
    bounds are a residue: no unequal join, and a crowded key has as many join keys as bins, which
    adaptive execution splits further.
    """
    names = list(carry)
    day = lambda c: F.unix_date(F.to_date(c))
    bin_of = lambda c: F.floor(day(c) / bin_days)
    first, last = facts.agg(F.min(bin_of(at)), F.max(bin_of(at))).first()
    if first is None:
        first, last = 0, -1
    opens = F.greatest(bin_of("_valid_from"), F.lit(first))
    ends = F.least(F.coalesce(bin_of("_valid_to"), F.lit(last)), F.lit(last))
    listed = (
        history.select(F.col(pk).alias("_of"), *[F.col(c).alias(f"_carried_{c}") for c in names], "_valid_from", "_valid_to")
        .where(opens <= ends)
        .withColumn("_in_bin", F.explode(F.sequence(opens, ends)))
    )
    valid = (F.col(at) >= F.col("_valid_from")) & (F.col("_valid_to").isNull() | (F.col(at) < F.col("_valid_to")))
    matched = facts.withColumn("_at_bin", bin_of(at)).join(
        listed, (F.col(pk) == F.col("_of")) & (F.col("_at_bin") == F.col("_in_bin")) & valid, "left"
    )
    return matched.select(*facts.columns, *[F.col(f"_carried_{c}").alias(c) for c in names])
