"""Quality classification by importance resampling with hashed n-gram models.

Two bags of hashed words and word pairs are counted: one over all documents (raw), one over a
bounded sample of documents labelled as good (target). A document's weight is the mean log ratio of
its n-grams under both, times EXCERPT, so that texts of any length compare like excerpts of one length.
Adding Gumbel noise, drawn from a hash of the id, and taking the k highest keys samples k documents
without replacement in proportion to their weights. The k-th key is found by counting keys in
ever finer intervals, so no ordering of all documents is needed.

Edge cases: texts without words have no weight and are never sampled, nor do they count for the share;
null ids share one noise value; ties at the k-th key
are all selected; without labels the ratio is that of an empty target; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tierlake.llm.common import annotate, bounded_sample, bytes_of, prepare, read_table
from tierlake.sources.staging import Staging

BUCKETS = 10_000
#: Bound of the labelled sample that the target model is counted over.
TARGET_DOCS = 20_000
EXCERPT = 128
SHARE = 0.5
_INTERVALS = 4096
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def buckets(text: bytes | None) -> np.ndarray:
    """Buckets of every word and of every pair of neighbouring words."""
    words = (text or b"").lower().split()
    single = np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))
    pairs = ((single[:-1] * _PAIR) ^ single[1:]) * _PAIR >> np.uint64(32)
    return np.concatenate([single % BUCKETS, pairs % BUCKETS]).astype(np.int64)


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket and task: occurrences in all texts and in target texts."""
    raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for text, good in zip(bytes_of(batch), batch.column(1).to_pylist(), strict=True):
            seen = np.bincount(buckets(text), minlength=BUCKETS)
            raw += seen
            if good:
                target += seen
    arrays = [pa.array(np.arange(BUCKETS, dtype=np.int32)), pa.array(raw), pa.array(target)]
    yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "raw", "target"])


def fit(documents: DataFrame, labels: DataFrame, target_docs: int = TARGET_DOCS) -> np.ndarray:
    """Log ratio of target to raw probability of every bucket, add-one smoothed."""
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    chosen = bounded_sample(good.withColumn("_one", F.lit(1)), "_one", "doc_id", target_docs)
    # At most target_docs ids.
    marked = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left")
    rows = marked.select("text", F.col("_one").isNotNull().alias("good")).mapInArrow(_counts, "bucket int, raw long, target long")
    sums = rows.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    raw[sums["bucket"]] += sums["raw"]
    target[sums["bucket"]] += sums["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weight(text: bytes | None, ratio: np.ndarray) -> float | None:
    at = buckets(text)
    return float(ratio[at].mean() * EXCERPT) if len(at) else None


def _weights(ratio: np.ndarray, batch: pa.RecordBatch) -> dict[str, pa.Array]:
    return {"log_weight": pa.array([weight(t, ratio) for t in bytes_of(batch)], pa.float64())}


def weigh(documents: DataFrame, ratio: np.ndarray, drop: tuple[str, ...] = ()) -> DataFrame:
    """Documents plus ``log_weight``."""
    return annotate(documents, [T.StructField("log_weight", T.DoubleType())], functools.partial(_weights, ratio), drop)


def kth_largest(keys: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a column without nulls; None if there are fewer than k or k < 1."""
    top = keys.agg(F.min(column), F.max(column), F.count("*")).first()
    low, high, total = top
    if k < 1 or total < k:
        return None
    value = F.col(column)
    while low < high:
        step = (high - low) / _INTERVALS
        if step == 0 or low + step == low:
            break
        slot = F.least(F.floor((value - F.lit(low)) / F.lit(step)), F.lit(_INTERVALS - 1))
        here = keys.filter((value >= low) & (value <= high)).groupBy(slot.alias("slot"))
        # At most _INTERVALS rows.
        rows = sorted(here.agg(F.count("*").alias("n"), F.min(column).alias("a"), F.max(column).alias("b")).collect(), reverse=True)
        for row in rows:
            if row.n >= k:
                low, high = row.a, row.b
                break
            k -= row.n
    return high


def resample(documents: DataFrame, ratio: np.ndarray, staging: Staging, share: float = SHARE) -> DataFrame:
    """doc_id, log_weight, gumbel_key and whether the row is among the sampled ``share`` of those with words."""
    weighed = weigh(documents.select("doc_id", "text"), ratio, drop=("text",))
    slot = F.pmod(F.xxhash64(F.lit("gumbel"), "doc_id"), F.lit(1 << 52))
    uniform = (slot + F.lit(0.5)) / F.lit(float(1 << 52))
    keyed = staging.keep(weighed.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform))), "keys")
    weighted = keyed.filter(F.col("gumbel_key").isNotNull())
    least = kth_largest(weighted, "gumbel_key", round(share * weighted.count()))
    chosen = F.lit(False) if least is None else F.coalesce(F.col("gumbel_key") >= F.lit(least), F.lit(False))
    return keyed.withColumn("selected", chosen)


def op8_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    documents = read_table(spark, sf_dir, "documents")
    ratio = fit(documents, read_table(spark, sf_dir, "labels"))
    return resample(documents, ratio, Staging(spark))
