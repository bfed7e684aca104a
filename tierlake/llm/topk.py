"""Exact top-k inner-product search with norm buckets.

Vectors are grouped by length: quantiles of the lengths cut the table into buckets, and a bucket
with many vectors (all, if lengths are equal) is dealt into slices by hash. Query blocks meet every
slice through an equi-join on the slice number, so the work is a grid of bounded tasks. Inside one,
a slice's vectors are visited from long to short in small local buckets. A query's k-th best score
so far, first taken from the longest vectors of the table, gives its local cosine threshold:

- above 1, no vector of the bucket can reach it: the bucket is skipped, and all shorter ones;
- near 1, coordinate pruning: only vectors whose largest query coordinates lie in the feasible range;
- otherwise length pruning: only vectors at least as long as the threshold asks.

What is left is verified by exact integer inner products.

Edge cases: vectors that are null or hold null or non-finite components take no part, nor do null
ids; shorter vectors count as extended with zeros; repeated rows count once; rows that share an id
with a query are its own row; scores beyond 64 bits are clamped to the range of a long. A table
without vectors gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tierlake.llm.common import prepare, read_table
from tierlake.sources.staging import Staging

K = 5
#: Rows of a slice and of a query block, blocks of a cell, vectors of a local bucket and of the seed.
SLICE_ROWS = 8192
QUERY_ROWS = 512
CELL_BLOCKS = 8
BUCKET_ROWS = 1024
SEED_ROWS = 512
NORM_BUCKETS = 64
COORDINATE_FROM = 0.9
FOCUS = 3
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def _quantised(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components as floor(256 x), exact in doubles; rows that take no part are left out."""
    for batch in batches:
        ids, vectors = batch.column(0), batch.column(1)
        keep, blobs, norms = [], [], []
        for i, vector in enumerate(vectors.to_pylist()):
            if vector is None or ids[i].as_py() is None or any(x is None for x in vector):
                continue
            x = np.asarray(vector, dtype=float)
            with np.errstate(over="ignore", invalid="ignore"):
                whole = np.floor(256 * x)
            if not np.isfinite(whole).all():
                continue
            keep.append(ids[i].as_py())
            blobs.append(whole.tobytes())
            norms.append(min(float(np.linalg.norm(whole)), 1e300))
        arrays = [pa.array(keep, pa.int64()), pa.array(blobs, pa.binary()), pa.array(norms, pa.float64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "v", "norm"])


def matrix(blobs: list[bytes], width: int = 0) -> np.ndarray:
    """Vectors as rows, shorter ones extended with zeros."""
    longest = max([width, *(len(b) // 8 for b in blobs)])
    return np.frombuffer(b"".join(b.ljust(longest * 8, b"\0") for b in blobs)).reshape(len(blobs), longest)


def _best(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of each row's k best: higher score first, then smaller id."""
    order = np.lexsort((ids, -scores, rows))
    sorted_rows = rows[order]
    rank = np.arange(len(order)) - np.searchsorted(sorted_rows, sorted_rows)
    return order[rank < k]


def _feasible(query: np.ndarray, unit: np.ndarray, cosine: float) -> np.ndarray:
    """Vectors whose coordinates allow a cosine of at least ``cosine`` with the (unit) query.

    The interval of a coordinate ends at the axis itself where the axis is within that angle.
    """
    possible = np.ones(len(unit), dtype=bool)
    for f in np.argsort(-np.abs(query))[:FOCUS]:
        middle = query[f] * cosine
        reach = np.sqrt(max(0.0, (1 - cosine * cosine) * (1 - query[f] * query[f]))) + 1e-6
        if query[f] < cosine:
            possible &= unit[:, f] <= middle + reach
        if query[f] > -cosine:
            possible &= unit[:, f] >= middle - reach
    return possible


def _huge(q: np.ndarray, p: np.ndarray, qid: np.ndarray, pid: np.ndarray, k: int):
    """Scores beyond doubles' exact range, in unbounded integers."""
    whole = [[int(x) for x in row] for row in p]
    for i, row in enumerate([int(x) for x in r] for r in q):
        found = [
            (-max(-_LONG - 1, min(_LONG, sum(a * b for a, b in zip(row, other, strict=True)))), int(pid[j]))
            for j, other in enumerate(whole)
            if pid[j] != qid[i]
        ]
        yield from ((i, vec, -score) for score, vec in sorted(found)[:k])


def search_slice(q, q_norm, q_id, floor, p, p_norm, p_id, k: int):
    """``(query position, vec_id, score)`` of each query's k best in one slice, at or above ``floor``."""
    width = max(q.shape[1], p.shape[1])
    q = np.pad(q, ((0, 0), (0, width - q.shape[1])))
    p = np.pad(p, ((0, 0), (0, width - p.shape[1])))
    order = np.lexsort((p_id, -p_norm))
    p, p_norm, p_id = p[order], p_norm[order], p_id[order]
    if width and np.abs(q).max(initial=0) * np.abs(p).max(initial=0) * width >= _EXACT:
        found = list(_huge(q, p, q_id, p_id, k))
        return tuple(np.array(x, dtype=np.int64) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3
    unit_q = q / np.maximum(q_norm, 1e-12)[:, None]
    need = floor.astype(float)
    rows, ids, scores = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    for start in range(0, len(p), BUCKET_ROWS):
        part, part_norm, part_id = (x[start : start + BUCKET_ROWS] for x in (p, p_norm, p_id))
        longest = part_norm[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(need > 0, need / (q_norm * longest), -1.0)
        live = np.flatnonzero(cosine <= 1 + 1e-9)
        if not len(live):
            break
        sharp = live[cosine[live] >= COORDINATE_FROM]
        broad = live[cosine[live] < COORDINATE_FROM]
        new = []
        if len(broad):
            least = np.where(need[broad] > 0, need[broad] / np.maximum(q_norm[broad], 1e-12), 0.0).min()
            count = int(np.searchsorted(-part_norm, -least * (1 - 1e-9), side="right")) if least > 0 else len(part)
            product = q[broad] @ part[:count].T
            i, j = np.nonzero((product >= need[broad][:, None]) & (part_id[None, :count] != q_id[broad][:, None]))
            new.append((broad[i], part_id[j], product[i, j]))
        if len(sharp):
            unit_p = part / np.maximum(part_norm, 1e-12)[:, None]
            for i in sharp:
                j = np.flatnonzero(_feasible(unit_q[i], unit_p, min(1.0, cosine[i])) & (part_id != q_id[i]))
                product = part[j] @ q[i]
                good = product >= need[i]
                new.append((np.full(good.sum(), i), part_id[j][good], product[good]))
        rows, ids, scores = (np.concatenate([old, *more]) for old, more in zip((rows, ids, scores), zip(*new, strict=True), strict=True))
        best = _best(rows, scores, ids, k)
        rows, ids, scores = rows[best], ids[best], scores[best]
        full = np.bincount(rows, minlength=len(q)) >= k
        worst = np.full(len(q), np.inf)
        np.minimum.at(worst, rows, scores)
        need = np.where(full, np.maximum(need, worst), need)
    return rows, ids, scores.astype(np.int64)


def _floors(seed: tuple, k: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each query's k-th best score among the longest vectors: a lower bound of its result."""
    ids, blobs = seed
    seeds = matrix(blobs)
    for batch in batches:
        q_id = np.array(batch.column(0).to_pylist(), dtype=np.int64)
        floor = np.full(len(q_id), -np.inf)
        if len(q_id) and len(ids) > k:
            q = matrix(batch.column(1).to_pylist(), seeds.shape[1])
            s = np.pad(seeds, ((0, 0), (0, q.shape[1] - seeds.shape[1])))
            if np.abs(q).max(initial=0) * np.abs(s).max(initial=0) * max(1, q.shape[1]) < _EXACT:
                product = q @ s.T
                product[q_id[:, None] == ids[None]] = -np.inf
                floor = np.partition(product, -k, axis=1)[:, -k]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor)], names=["vec_id", "v", "norm", "floor"])


def _search(k: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["query_id", "key", "vec_id", "score"]
    for batch in batches:
        for row in batch.to_pylist():
            queries, vectors = row["queries"], row["vectors"]
            column = lambda rows, name, kind: np.array([r[name] for r in rows], dtype=kind)
            q_id = column(queries, "vec_id", np.int64)
            at, ids, scores = search_slice(
                matrix([r["v"] for r in queries]),
                column(queries, "norm", float),
                q_id,
                column(queries, "floor", float),
                matrix([r["v"] for r in vectors]),
                column(vectors, "norm", float),
                column(vectors, "vec_id", np.int64),
                k,
            )
            keys = column(queries, "key", np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (q_id[at], keys[at], ids, scores)], names=names)


def _ceil(count: int, size: int) -> int:
    return max(1, -(-count // size))


def top_k(vectors: DataFrame, is_query, staging: Staging, k: int = K, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The k highest inner products of every query row of ``vectors(vec_id, embedding)``.

    ``is_query`` is a condition on ``vec_id``. Returns query_id, rank, vec_id, score.
    """
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>"))
    table = staging.keep(
        source.mapInArrow(_quantised, "vec_id long, v binary, norm double").dropDuplicates(["vec_id", "v"]), "vectors"
    )
    cuts = [i / NORM_BUCKETS for i in range(1, NORM_BUCKETS)]
    edges = table.agg(F.percentile_approx("norm", cuts, 1000).alias("e")).first().e or []
    edges = sorted(set(edges))
    bucket = F.lit(0)
    for edge in edges:
        bucket = bucket + (F.col("norm") < F.lit(edge)).cast("int")
    placed = table.withColumn("bucket", bucket)
    # One row per length bucket reaches the driver: at most NORM_BUCKETS.
    sizes = {r.bucket: r["count"] for r in placed.groupBy("bucket").count().collect()}
    slices, first = 0, {}
    group_rows = max(1, slice_rows)
    for number in sorted(sizes):
        parts = _ceil(sizes[number], group_rows)
        first[number] = (slices, parts)
        slices += parts
    if not slices:
        return staging.spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # Small neighbouring buckets share a slice, so that slices are about equally large.
    joined, number, held = {}, 0, 0
    for b in sorted(sizes):
        if first[b][1] > 1:
            number += held > 0
            joined[b] = (number, first[b][1])
            number, held = number + first[b][1], 0
        else:
            if held + sizes[b] > group_rows:
                number, held = number + 1, 0
            joined[b] = (number, 1)
            held += sizes[b]
    slices = number + (held > 0)
    start = F.lit(0)
    for b, (at, parts) in joined.items():
        here = F.col("bucket") == b
        start = F.when(here, F.lit(at) + F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)).cast("int")).otherwise(start)
    packed = placed.withColumn("slice", start).groupBy("slice").agg(
        F.collect_list(F.struct("vec_id", "v", "norm")).alias("vectors")
    )
    longest = table.orderBy(F.col("norm").desc(), "vec_id", "v").limit(SEED_ROWS).select("vec_id", "v").collect()
    seed = (np.array([r.vec_id for r in longest], dtype=np.int64), [bytes(r.v) for r in longest])
    chosen = table.filter(is_query)
    floored = chosen.mapInArrow(functools.partial(_floors, seed, k), "vec_id long, v binary, norm double, floor double")
    blocks = _ceil(chosen.count(), QUERY_ROWS)
    queries = (
        floored.withColumns({"key": F.xxhash64("v"), "block": F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")})
        .groupBy("block")
        .agg(F.collect_list(F.struct("vec_id", "key", "v", "norm", "floor")).alias("queries"))
    )
    # A cell of the grid holds one slice and at most CELL_BLOCKS query blocks.
    groups = _ceil(blocks, CELL_BLOCKS)
    left = (
        staging.keep(queries, "query-blocks")
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        .select((F.col("slice").cast("long") * groups + F.col("block") % groups).alias("cell"), "queries")
    )
    right = (
        staging.keep(packed, "slices")
        .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        .select((F.col("slice").cast("long") * groups + F.col("group")).alias("cell"), "vectors")
    )
    # Both sides are shuffled: the planner sees what one copy of the query blocks takes compressed on disk,
    # and would broadcast, through the driver, as many copies as there are slices.
    pairs = left.hint("merge").join(right, "cell").select("queries", "vectors")
    hits = pairs.mapInArrow(functools.partial(_search, k), "query_id long, key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "key").orderBy(F.col("score").desc(), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, Staging(spark))


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
