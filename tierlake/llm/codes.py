"""Vector code compression: one small codebook per part of a vector, searched by equal averages.

Components become whole numbers ``floor(256 x)`` and every vector is cut into equal consecutive parts.
A codebook entry is found without trying all entries: entries are sorted by the sum of their
components, and the search goes outward from the part's own sum, nearer sum first. As a squared gap of
sums over the dimension is never more than the squared distance, it ends as soon as that bound
strictly exceeds the best distance, so ties are still met and go to the lower index.

Codebooks (parts x entries, a fixed size) are all that the driver holds. A round is one pass over the
staged vectors: each task returns one sum per entry component, and Spark adds them up.

Edge cases: vectors that are null or hold null or non-finite components are left out. Shorter vectors
count as extended with zeros to the longest one, and that to a multiple of the parts. Null ids come
last in the order that gives the first entries; repeated rows are rows of their own; fewer vectors
than entries give fewer entries, and a table without vectors gives no rows. Components beyond
2^62 are clamped to it and errors to the range of a long; everything in between is exact.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tierlake.llm.common import annotate, prepare, read_table
from tierlake.sources.staging import Staging

PARTS = 16
ENTRIES = 64
ROUNDS = 2
_CLAMP = 1 << 62
_LONG = (1 << 63) - 1
#: Sums of parts whose dimension times largest component stays below this fit 64 bits when squared.
_NARROW = 1 << 30


def _whole(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    """Components as whole numbers in little-endian longs; null for vectors that take no part."""
    vectors = batch.column(batch.schema.get_field_index("embedding"))
    sizes = np.array([0 if v is None else v for v in vectors.value_lengths().to_pylist()], dtype=np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    row = np.repeat(np.arange(len(sizes)), sizes)
    bad = np.bincount(row[~np.isfinite(values)], minlength=len(sizes)) > 0
    with np.errstate(over="ignore", invalid="ignore"):
        clamped = np.clip(np.floor(256 * values), -float(_CLAMP), float(_CLAMP))
    blob = np.where(np.isfinite(clamped), clamped, 0).astype("<i8").tobytes()
    ends = np.cumsum(sizes) * 8
    starts = ends - sizes * 8
    missing = bad | np.asarray(vectors.is_null())
    return {"_v": pa.array([None if m else blob[a:b] for m, a, b in zip(missing, starts, ends, strict=True)], pa.binary())}


def parts_of(blobs: list[bytes], width: int, parts: int) -> np.ndarray:
    """``(vectors, parts, width)`` whole numbers, zeros where a vector is shorter."""
    size = width * parts * 8
    joined = b"".join(blob.ljust(size, b"\0") for blob in blobs)
    return np.frombuffer(joined, dtype="<i8").reshape(len(blobs), parts, width)


def _exact(points: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as longs where squares fit, else as unbounded numbers."""
    most = max([abs(int(x)) for a in (points, books) if a.size for x in (a.min(), a.max())], default=0)
    kind = np.int64 if most * points.shape[-1] < _NARROW else object
    return points.astype(kind), books.astype(kind)


def nearest(points: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of every part's nearest entry; ``(vectors, parts)`` each.

    ``points`` is ``(vectors, parts, width)``, ``books`` is ``(parts, entries, width)``.
    """
    points, books = _exact(points, books)
    rows, parts, width = points.shape
    entries = books.shape[1]
    sums = books.sum(axis=2)
    order = np.argsort(sums, axis=1, kind="stable")
    ordered = np.take_along_axis(sums, order, axis=1)
    own = points.sum(axis=2)
    flat = points.reshape(rows * parts, width)
    total = own.reshape(-1)
    part = np.tile(np.arange(parts), rows)
    up = np.stack([np.searchsorted(ordered[p], own[:, p]) for p in range(parts)], axis=1).reshape(-1)
    down = up - 1
    far = _CLAMP if points.dtype != object else 1 << 200
    best = np.full(rows * parts, far // width, dtype=points.dtype)
    found = np.full(rows * parts, entries)
    active = np.arange(rows * parts)
    while True:
        p, lo, hi, mine = part[active], down[active], up[active], total[active]
        below = np.where(lo >= 0, mine - ordered[p, np.maximum(lo, 0)], far)
        above = np.where(hi < entries, ordered[p, np.minimum(hi, entries - 1)] - mine, far)
        gap = np.minimum(below, above)
        open_ = gap < far
        gap = np.where(open_, gap, 0)
        going = open_ & (gap * gap <= best[active] * width)
        active = active[going]
        if not len(active):
            return found.reshape(rows, parts), best.reshape(rows, parts)
        left = (below <= above)[going]
        p = p[going]
        entry = order[p, np.where(left, lo[going], hi[going])]
        apart = flat[active] - books[p, entry]
        distance = (apart * apart).sum(axis=1)
        better = (distance < best[active]) | ((distance == best[active]) & (entry < found[active]))
        best[active[better]] = distance[better]
        found[active[better]] = entry[better]
        down[active] -= left
        up[active] += ~left


def _sums(books: np.ndarray, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's sums per entry component, as two limbs of 32 bits, and counts."""
    parts, entries, width = books.shape
    sums = np.zeros((parts, entries, width), dtype=object)
    counts = np.zeros((parts, entries), dtype=np.int64)
    where = np.arange(parts)[None, :]
    for batch in batches:
        if not batch.num_rows:
            continue
        points = parts_of(batch.column(0).to_pylist(), width, parts)
        at, _ = nearest(points, books)
        wide = _exact(points, books)[0]
        here = np.zeros((parts, entries, width), dtype=wide.dtype)
        np.add.at(here, (np.broadcast_to(where, at.shape), at), wide)
        np.add.at(counts, (np.broadcast_to(where, at.shape), at), 1)
        sums = sums + here
    slots = [(p, e, i) for p, e in np.argwhere(counts > 0).tolist() for i in range(width)]
    arrays = [
        pa.array([p * entries + e for p, e, _ in slots], pa.int32()),
        pa.array([i for *_, i in slots], pa.int32()),
        pa.array([int(sums[s]) >> 32 for s in slots], pa.int64()),
        pa.array([int(sums[s]) & 0xFFFFFFFF for s in slots], pa.int64()),
        pa.array([int(counts[p, e]) for p, e, _ in slots], pa.int64()),
    ]
    yield pa.RecordBatch.from_arrays(arrays, names=["slot", "position", "high", "low", "n"])


def refined(table: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round over the staged vectors; at most one row per entry component returns."""
    parts, entries, _ = books.shape
    schema = "slot int, position int, high long, low long, n long"
    rows = table.select("_v").mapInArrow(functools.partial(_sums, books), schema).groupBy("slot", "position")
    new = books.astype(object)
    for r in rows.agg(*[F.sum(c).alias(c) for c in ("high", "low", "n")]).collect():
        new[r.slot // entries, r.slot % entries, r.position] = ((r.high << 32) + r.low) // r.n
    return new.astype(np.int64)


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def _codes(books: np.ndarray, batch: pa.RecordBatch) -> dict[str, pa.Array]:
    parts, _, width = books.shape
    blobs = batch.column(batch.schema.get_field_index("_v")).to_pylist()
    if not blobs:
        return {"code": pa.array([], pa.string()), "error": pa.array([], pa.int64())}
    at, distance = nearest(parts_of(blobs, width, parts), books)
    errors = [min(int(sum(map(int, row))), _LONG) for row in distance]
    return {"code": pa.array([bytes(row).hex() for row in at.astype(np.uint8)]), "error": pa.array(errors, pa.int64())}


def learn(
    vectors: DataFrame, staging: Staging, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray | None]:
    """The staged whole-number vectors ``(vec_id, label, _v)`` and their codebooks."""
    source = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    whole = annotate(source, [T.StructField("_v", T.BinaryType())], _whole, drop=["embedding"])
    table = staging.keep(whole.filter(F.col("_v").isNotNull()), "whole-vectors")
    longest = table.agg(F.max(F.length("_v"))).first()[0]
    if longest is None:
        return table, None
    width = max(1, -(-(longest // 8) // parts))
    first = table.orderBy(F.col("vec_id").asc_nulls_last(), "_v").limit(min(entries, 256)).collect()
    books = parts_of([bytes(r["_v"]) for r in first], width, parts).transpose(1, 0, 2).astype(np.int64)
    for _ in range(rounds):
        books = refined(table, books)
    return table, books


def compress(vectors: DataFrame, staging: Staging, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of every vector that takes part."""
    table, books = learn(vectors, staging, parts, entries, rounds)
    fields = [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    if books is None:
        books = np.zeros((parts, 0, 1), dtype=np.int64)
    coded = staging.keep(annotate(table, fields, functools.partial(_codes, books), drop=["_v"]), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    labels = coded.groupBy(F.col("label").alias("_label")).agg(
        F.least(total, F.lit(_LONG).cast("decimal(38,0)")).cast("long").alias("label_error")
    )
    joined = coded.join(labels, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return compress(read_table(spark, sf_dir, "embeddings"), Staging(spark)).drop("label")


def _oracle() -> str:
    """Two rounds written out; vectors of one length that the parts divide."""
    ctes = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT r, (j - 1) // (len(q) // {PARTS}) AS part, (j - 1) % (len(q) // {PARTS}) AS i, q[j] AS x
  FROM (SELECT r, q, unnest(generate_series(1, len(q))) AS j FROM v)
), c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, i, x FROM p WHERE r <= {ENTRIES})"""
    ]
    for k in range(ROUNDS + 1):
        ctes.append(
            f"""d{k} AS (
  SELECT p.r, p.part, c.entry, sum((p.x - c.x) * (p.x - c.x)) AS d FROM p JOIN c{k} c ON p.part = c.part AND p.i = c.i GROUP BY ALL
), a{k} AS MATERIALIZED (
  SELECT r, part, entry, d FROM d{k} QUALIFY row_number() OVER (PARTITION BY r, part ORDER BY d, entry) = 1
)"""
        )
        if k < ROUNDS:
            ctes.append(
                f"""m{k} AS (
  SELECT a.part, a.entry, p.i, sum(p.x) AS s, count(*) AS n FROM a{k} a JOIN p ON a.r = p.r AND a.part = p.part GROUP BY ALL
), c{k + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, c.i, CASE WHEN m.n IS NULL THEN c.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x
  FROM c{k} c LEFT JOIN m{k} m USING (part, entry, i)
)"""
            )
    return f"""WITH {", ".join(ctes)}, e AS (
  SELECT r, CAST(sum(d) AS BIGINT) AS error, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code
  FROM a{ROUNDS} GROUP BY r
), h AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, i)) AS codebooks_sha256 FROM c{ROUNDS}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN e USING (r), h"""


ORACLE = _oracle()
