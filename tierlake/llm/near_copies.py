"""Near copies by the similarity of word shingles: groups linked at a Jaccard similarity of 0.8.

Two texts are linked when the sets of their five-word shingles have a similarity of at least 4/5.
Finding the links is exact up to clashes of 64-bit hashes:

- A set that has ``n - ceil(4n/5) + 1`` shingles of its own is similar to no other. Texts are sorted
  out by this twice: first by the part of all shingles whose hash falls under a bound, which most
  texts pass, then by all shingles of the few left (shingles of texts that are out count no more).
- Fingerprints of all texts (``simhash``, over the same five-word shingles, repeats included) go through
  its index; what it groups is a candidate and is never sorted out. Fingerprints miss most copies with
  more than a word or two changed, so candidates are completed exactly:
- In any order that all texts share, similar sets have a shingle in common among their first
  ``n - ceil(4n/5) + 1``. Shingles of a text alone come first in the order, then by count. These
  prefixes meet by shingle, sorted by set size; neighbours of compatible size are chained, so n texts
  give n rows, never n squared. A shingle of very many texts is split over ranges of sizes, whose
  ends are chained afterwards. The components of the chains and of the fingerprints' groups hold every
  similar pair.
- A component of one block is compared in one task. In a larger one, blocks drawn twice at random
  link what is much alike; only texts outside the component's largest such cluster, usually few, are
  then compared with all others, block by block.

Texts are read and sets sent in full only where a bitmap of fixed size shows that they may have a
partner. Chance hits in it cost work and change no result.

Edge cases: texts with the same set of shingles are one node; null and wordless texts have the empty
set and are copies of each other; up to five words are one shingle; null ids are kept last; rows of
one id and one text are one document.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from tierlake.llm.bitmap import Bitmap
from tierlake.llm.common import annotate, bytes_of
from tierlake.llm.components import components
from tierlake.llm.simhash import _unite, fingerprint_of, group, shingle_hashes
from tierlake.sources.staging import Staging

SHINGLE = 5
#: Part of the shingles that the first sorting out looks at, in thousandths; over a fifth.
FIRST_PART = 300
#: Counts of shingles below this are not told apart in the order of prefixes.
FREQUENT_FROM = 3
#: Texts and shingles of a block of a large component; keys a task remembers.
BLOCK_ROWS = 256
BLOCK_SHINGLES = 1 << 21
REMEMBERED = 1 << 18
_LINKS = "a long, b long"
_ROWS = "shingle long, key long, size int"
_NEEDED = "size - (4 * size + 4) div 5 + 1"


def shingle_set(text: bytes | None) -> np.ndarray:
    return np.unique(shingle_hashes(text, SHINGLE))


def _key(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes())


def _keys(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    hashes = [shingle_hashes(text, SHINGLE) for text in bytes_of(batch)]
    made = {"_key": [_key(np.unique(h)) for h in hashes], "_fp": [fingerprint_of(h) for h in hashes]}
    return {name: pa.array(np.array(values, dtype=np.uint64).view(np.int64)) for name, values in made.items()}


def with_key(documents: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Documents plus ``_key``, the hash of their set of shingles, and ``_fp``, their fingerprint."""
    return annotate(documents, [T.StructField(name, T.LongType()) for name in ("_key", "_fp")], _keys, drop)


def _new_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Keys and non-empty sets of texts, without the copies that this task remembers."""
    seen: set[int] = set()
    for batch in batches:
        found = []
        for text in bytes_of(batch):
            shingles = shingle_set(text)
            key = _key(shingles)
            if len(shingles) and key not in seen:
                if len(seen) < REMEMBERED:
                    seen.add(key)
                found.append((key, shingles))
        yield found


def _rows(found: list[tuple[int, np.ndarray, int]]) -> pa.RecordBatch:
    """One row per shingle with its text's key and the size of its whole set."""
    lengths = [len(s) for _, s, _ in found]
    keys = np.array([k for k, _, _ in found], dtype=np.uint64).view(np.int64)
    sizes = np.array([n for _, _, n in found], dtype=np.int32)
    shingles = np.concatenate([s for _, s, _ in found] or [np.empty(0, np.uint64)]).view(np.int64)
    columns = [shingles, np.repeat(keys, lengths), np.repeat(sizes, lengths)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shingle", "key", "size"])


def _part_of_shingles(part: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for found in _new_sets(batches):
        yield _rows([(k, s[(s >> np.uint64(11)) % np.uint64(1000) < part], len(s)) for k, s in found])


def _possible_sets(possible: Bitmap, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for found in _new_sets(batches):
        kept = possible.holds(np.array([k for k, _ in found], dtype=np.uint64))
        chosen = [x for x, k in zip(found, kept, strict=True) if k]
        arrays = [
            pa.array(np.array([k for k, _ in chosen], dtype=np.uint64).view(np.int64)),
            pa.array([len(s) for _, s in chosen], pa.int32()),
            pa.array([s.tobytes() for _, s in chosen], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["key", "size", "shingles"])


def _shingles_of_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = np.array(batch.column(0).to_pylist(), dtype=np.int64).view(np.uint64).tolist()
        sets = [np.frombuffer(s, dtype=np.uint64) for s in batch.column(1).to_pylist()]
        yield _rows([(k, s, len(s)) for k, s in zip(keys, sets, strict=True)])


def alone(rows: DataFrame) -> DataFrame:
    """Keys with so many shingles of their own that no other set is similar; sums per shingle first."""
    once = rows.groupBy("shingle").agg(F.min("key").alias("key"), F.max("key").alias("_other"), F.max("size").alias("size"))
    own = once.filter("key = _other").groupBy("key").agg(F.count("*").alias("own"), F.max("size").alias("size"))
    return own.filter(f"own >= {_NEEDED}").select("key")


def possible_sets(texts: DataFrame, keys: DataFrame, grouped: DataFrame, staging: Staging) -> DataFrame:
    """``(key, size, shingles)`` of every text that may have a partner or is ``grouped``; staged, one row per key."""
    rows = texts.mapInArrow(functools.partial(_part_of_shingles, FIRST_PART), _ROWS)
    sorted_out = alone(rows).join(grouped, "key", "left_anti")
    left = staging.keep(keys.join(sorted_out, "key", "left_anti"), "left")
    mapped = texts.mapInArrow(functools.partial(_possible_sets, Bitmap.of(left)), "key long, size int, shingles binary")
    sets = staging.keep(mapped.dropDuplicates(["key"]), "sets")
    out = alone(sets.select("key", "shingles").mapInArrow(_shingles_of_sets, _ROWS)).join(grouped, "key", "left_anti")
    return staging.keep(sets.join(out, "key", "left_anti"), "sets")


def prefixes(sets: DataFrame) -> DataFrame:
    """``(shingle, key, size)``: those first shingles of every set that another set has, too."""
    rows = sets.select("key", "shingles").mapInArrow(_shingles_of_sets, _ROWS)
    counts = rows.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1")
    shared = rows.join(counts, "shingle")
    order = F.when(F.col("n") >= FREQUENT_FROM, F.col("n")).otherwise(0)
    own = Window.partitionBy("key")
    ranked = shared.select(
        "shingle",
        "key",
        "size",
        F.row_number().over(own.orderBy(order, "shingle")).alias("rank"),
        F.count("*").over(own).alias("together"),
    )
    # Shingles of the text alone come first.
    return ranked.filter(f"rank + size - together <= {_NEEDED}").select("shingle", "key", "size")


_CHAINS = "a long, b long, shingle long, size int"


def _chain(shingle: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    near = (shingle[1:] == shingle[:-1]) & (key[1:] != key[:-1]) & (5 * size[:-1] >= 4 * size[1:])
    pairs = np.stack([np.minimum(key[:-1], key[1:])[near], np.maximum(key[:-1], key[1:])[near]])
    return np.unique(pairs, axis=1)


def _chains(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of neighbours, and the first and last row; rows come sorted by shingle, size and key."""

    def made(a, b, shingle, size) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
        arrays = [pa.array(c, k) for c, k in zip((a, b, shingle, size), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "shingle", "size"])

    def end(row: list[int]) -> pa.RecordBatch:
        return made([row[2]], [None], [row[0]], [row[1]])

    last: list[np.ndarray] = [np.empty(0, np.int64)] * 3
    for batch in batches:
        if not batch.num_rows:
            continue
        new = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]
        if not len(last[0]):
            yield end([int(c[0]) for c in new])
        shingle, size, key = (np.concatenate(x) for x in zip(last, new, strict=True))
        a, b = _chain(shingle, size, key)
        yield made(a, b, [None] * len(a), [None] * len(a))
        last = [c[-1:] for c in (shingle, size, key)]
    if len(last[0]):
        yield end([int(c[0]) for c in last])


def alike_prints(prints: DataFrame, staging: Staging) -> DataFrame:
    """Links ``(a, b)`` from the least key of each group of fingerprints of ``(key, _fp)`` to its others; staged.

    A key may have several fingerprints: texts of one set may repeat its shingles differently.
    """
    labels = staging.keep(prints.join(group(prints, staging), "_fp").select("key", "_label").distinct(), "print-labels")
    least = labels.groupBy("_label").agg(F.min("key").alias("a"), F.count("*").alias("n")).filter("n > 1")
    return staging.keep(labels.join(least, "_label").filter("key <> a").select("a", F.col("key").alias("b")), "alike")


def candidates(sets: DataFrame, alike: DataFrame, staging: Staging) -> DataFrame:
    """``(node, label)``: keys in components such that ``alike`` and similar sets are in one component."""
    columns = ("shingle", "size", "key")
    rows = staging.keep(prefixes(sets).select(*columns), "prefixes")
    ordered = rows.repartitionByRange(*columns).sortWithinPartitions(*columns)
    chains = staging.keep(ordered.mapInArrow(_chains, _CHAINS).distinct(), "chains")
    # Two rows per range: the ends of neighbouring ranges meet in one small task.
    ends = chains.filter("b IS NULL").select("shingle", "size", F.col("a").alias("key")).distinct()
    between = ends.coalesce(1).sortWithinPartitions(*columns).mapInArrow(_chains, _CHAINS)
    links = chains.filter("b IS NOT NULL").unionByName(between.filter("b IS NOT NULL")).select("a", "b").union(alike)
    return staging.keep(components(links, staging), "candidates")


def similar(sets: list[np.ndarray], own: np.ndarray | None = None, among: bool = True, group: list[int] | None = None) -> np.ndarray:
    """Root position of every non-empty set, after linking all pairs with a similarity of 4/5.

    With ``own``, only pairs of an own set with another are compared, and own ones only if ``among``.
    Sets of one ``group`` are linked from the start; sets linked already are not compared.
    """
    root = np.arange(len(sets))
    if group is not None:
        first: dict[int, int] = {}
        root = np.array([first.setdefault(g, i) for i, g in enumerate(group)])
    own = np.ones(len(sets), dtype=bool) if own is None else own
    sizes = np.array([len(s) for s in sets])
    distinct, at = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    mark = np.zeros(len(distinct), dtype=np.int32)
    for i in range(1, len(sets)):
        asked = own[:i] & among | ~own[:i] if own[i] else own[:i]
        if not (asked & (root[:i] != root[i])).any():
            continue
        mine = at[starts[i] : starts[i] + sizes[i]]
        mark[mine] = 1
        common = np.add.reduceat(mark[at[: starts[i]]], starts[:i])
        mark[mine] = 0
        found = np.flatnonzero(asked & (9 * common >= 4 * (sizes[:i] + sizes[i])))
        _unite(root, found, np.full(len(found), i))
    return root


def _verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of every cell; rows come sorted by cell."""

    def flush(cell: tuple, rows: list[tuple]) -> pa.RecordBatch:
        keys, own, groups, sets = zip(*rows, strict=True)
        root = similar(list(sets), np.array(own), cell[2] == 0, list(groups))
        named = np.array(keys, dtype=np.int64)
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(named[linked]), pa.array(named[root[linked]])], names=["a", "b"])

    cell, rows = None, []
    for batch in batches:
        for label, low, high, key, own, group, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (label, low, high) != cell:
                if len(rows) > 1:
                    yield flush(cell, rows)
                cell, rows = (label, low, high), []
            rows.append((key, own, group, np.frombuffer(blob, dtype=np.uint64)))
    if len(rows) > 1:
        yield flush(cell, rows)


def _compared(cells: DataFrame, sets: DataFrame, staging: Staging) -> DataFrame:
    """Links inside the cells of ``(label, low, high, key, own, group)``; staged."""
    cell = ("label", "low", "high")
    full = cells.join(sets.select("key", "shingles"), "key").select(*cell, "key", "own", "group", "shingles")
    ordered = full.repartition(*cell).sortWithinPartitions(*cell)
    return staging.keep(ordered.mapInArrow(_verified, _LINKS), "similar")


def _blocks(block_rows: int) -> Column:
    parts = F.greatest(F.ceil(F.count("*") / block_rows), F.ceil(F.sum("size") / BLOCK_SHINGLES))
    return parts.cast("int").alias("blocks")


def _slot(count: str, *salt: Column | str) -> Column:
    return F.pmod(F.xxhash64("key", *salt), F.col(count)).cast("int")


def links(sets: DataFrame, coarse: DataFrame, staging: Staging, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Spanning links ``(a, b)`` between the keys of similar sets."""
    members = coarse.select(F.col("node").alias("key"), "label").join(sets.select("key", "size"), "key")
    members = staging.keep(members, "members")
    placed = staging.keep(members.join(members.groupBy("label").agg(_blocks(block_rows)), "label"), "placed")
    whole = {"low": F.lit(0), "high": F.lit(0), "own": F.lit(True), "group": F.col("key")}
    cell = ("label", "low", "high", "key", "own", "group")
    found = _compared(placed.filter("blocks = 1").withColumns(whole).select(*cell), sets, staging)
    large = placed.filter("blocks > 1")
    if large.isEmpty():
        return found
    twice = large.withColumn("low", F.explode(F.array(F.lit(1), F.lit(2)))).withColumns({**whole, "low": F.col("low")})
    drawn = twice.withColumn("low", F.col("low") + 2 * _slot("blocks", "low"))
    alike = _compared(drawn.select(*cell), sets, staging)
    clusters = components(alike, staging).select(F.col("node").alias("key"), F.col("label").alias("cluster"))
    grouped = large.join(clusters, "key", "left").withColumn("group", F.coalesce("cluster", "key")).drop("cluster")
    grouped = staging.keep(grouped, "grouped")
    counted = grouped.groupBy("label", "group").agg(F.count("*").alias("n"))
    main = counted.groupBy("label").agg(F.max(F.struct("n", "group")).alias("m")).select("label", F.col("m.group").alias("main"))
    marked = grouped.join(main, "label").withColumn("minor", F.col("group") != F.col("main"))
    minors = marked.filter("minor").groupBy("label").agg(_blocks(block_rows).alias("rest"))
    marked = staging.keep(marked.join(minors, "label").withColumn("part", F.when(F.col("minor"), _slot("rest", F.lit(7)))), "marked")
    mine = marked.filter("minor").select(
        "label", F.col("part").alias("low"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("high"), "key", F.lit(True).alias("own"), "group"
    )
    # Texts of the rest meet those of later parts once, texts of the main cluster meet every part.
    upto = F.expr("CASE WHEN minor THEN part ELSE rest END")
    others = marked.filter("NOT minor OR part > 0").select(
        "label", F.explode(F.sequence(F.lit(0), upto - 1)).alias("low"), _slot("blocks").alias("high"), "key", F.lit(False).alias("own"), "group"
    )
    rest = _compared(mine.unionByName(others), sets, staging)
    return found.union(alike).union(rest)


def groups(texts: DataFrame, prints: DataFrame, staging: Staging, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(key, label)`` of every key that is similar to another one; staged.

    ``prints`` are the distinct ``(key, _fp)`` of the texts. All other results on the way are released.
    """
    with Staging(staging.spark) as inner:
        alike = alike_prints(prints, inner)
        keys = inner.keep(prints.select("key").distinct(), "keys")
        grouped = inner.keep(alike.select(F.col("a").alias("key")).union(alike.select("b")).distinct(), "grouped")
        sets = possible_sets(texts, keys, grouped, inner)
        found = links(sets, candidates(sets, alike, inner), inner, block_rows)
        return staging.keep(components(found, inner).select(F.col("node").alias("key"), "label"), "groups")


def keep_one(documents: DataFrame, staging: Staging, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One document of each group, the one with the least id (then text), with all its columns."""
    columns = [c for c in documents.columns if c != "_rid"]
    row = F.xxhash64(F.col("doc_id"), F.col("doc_id").isNull(), F.col("text"))
    documents = documents.select(*[F.col(f"`{c}`") for c in columns], row.alias("_rid"))
    narrow = with_key(documents.select("doc_id", "text", "_rid"), drop=("text",))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_rid")).alias("first")
    # Copies are reduced to their first document before anything else.
    heads = staging.keep(narrow.groupBy(F.col("_key").alias("key"), "_fp").agg(first), "heads")
    labels = groups(documents.select("text"), heads.select("key", "_fp"), staging, block_rows)
    named = heads.join(labels, "key", "left").groupBy(F.coalesce("label", "key")).agg(F.min("first").alias("first"))
    kept = staging.keep(named.select(F.col("first._rid").alias("_rid")), "kept")
    return documents.dropDuplicates(["_rid"]).join(kept, "_rid", "left_semi").select(*[F.col(f"`{c}`") for c in columns])
