"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

Three disjoint parts of a bounded sample of labelled rows are used: one to learn which words mark
toxic texts (the lexicon), one to grow the trees, one to calibrate their scores. Scoring then reads
every whole text once, without a shuffle.

Features of a text: densities of lexicon words and their weights, lexicon words near a second
person, second-person words, capitals, punctuation, exclamation marks, digits, and obfuscated
spellings (letters replaced by digits or signs, letters set apart) with what they stand for.

Edge cases: null and empty texts have all features zero and get the calibrated score of such a
text; without labels of both kinds the score is the share of toxic labels (0 without any);
labels that disagree on a document count as toxic; null labels and null ids teach nothing.
"""

from __future__ import annotations

import functools
import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tierlake.llm.common import annotate, prepare, bounded_sample, in_fold, read_table, texts_of
from tierlake.sources.staging import Staging

#: Bound of the training sample: rows of each label, the first by hash of the id.
SAMPLE_PER_LABEL = 12_000
#: Bound of the learned lexicon.
LEXICON_WORDS = 2_000
THRESHOLD = 0.7

SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tuyo tuya usted ustedes vosotros vuestro contigo".split()
)
NEAR_WORDS = 4

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_SPACED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
# Letters, signs used in place of letters, anything else.
_SHAPES = bytes(97 if b >= 128 or chr(b).isalpha() else 49 if chr(b) in "0134578@$*!" else 32 for b in range(256))
_PLAIN = bytes.maketrans(b"0134578@$!", b"oieastbasi")
_SIGNS = b"0134578@$*!"
# A run of letters and signs that holds both, wherever the signs are.
_MIXED = re.compile(rb"(?:a+1|1+a)[a1]*")
_APART = re.compile(rb"(?<![a-z0-9])(?:[a-z0-9] ){2,}[a-z0-9](?![a-z0-9])")

FEATURES = (
    "hits",
    "hit_density",
    "weight_density",
    "strongest",
    "distinct_hits",
    "hidden_hits",
    "near_person",
    "person_density",
    "capitals",
    "punctuation",
    "exclamations",
    "digits",
    "mixed_rate",
    "apart_rate",
)


def _disguised(data: bytes, lexicon: dict[bytes, float]) -> tuple[int, int, int]:
    """Words with signs for letters, words set apart letter by letter, and lexicon words among both.

    Stars and exclamation marks around a word are punctuation and disguise nothing.
    """
    mixed = apart = found = 0
    for match in _MIXED.finditer(data.translate(_SHAPES)):
        word = data[match.start() : match.end()].strip(b"*!")
        if len(word.translate(None, _SIGNS)) in (0, len(word)):
            continue
        mixed += 1
        found += word.translate(_PLAIN) in lexicon or word.strip(b"*$!@").translate(_PLAIN) in lexicon
    for match in _APART.finditer(data.translate(_SPACED)):
        apart += 1
        found += match.group().replace(b" ", b"").translate(_PLAIN) in lexicon
    return mixed, apart, found


def features(text: str | None, lexicon: dict[bytes, float]) -> list[float]:
    """The dense features of one whole text, in the order of ``FEATURES``."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = text.encode("utf-8", "replace")
    data = text.lower().encode("utf-8", "replace")
    size = len(raw)
    words = data.translate(_SPACED).split()
    total = len(words) or 1
    hits = [i for i, word in enumerate(words) if word in lexicon]
    weights = [lexicon[words[i]] for i in hits]
    persons = [i for i, word in enumerate(words) if word in _PERSON_BYTES]
    near = 0
    if hits and persons:
        places = np.asarray(persons)
        at = np.searchsorted(places, np.asarray(hits))
        before = np.abs(np.asarray(hits) - places[np.maximum(at - 1, 0)])
        after = np.abs(np.asarray(hits) - places[np.minimum(at, len(places) - 1)])
        near = int((np.minimum(before, after) <= NEAR_WORDS).sum())
    mixed, apart, hidden = _disguised(data, lexicon)
    return [
        math.log1p(len(hits)),
        len(hits) / total,
        sum(weights) / total,
        max(weights, default=0.0),
        math.log1p(len({words[i] for i in hits})),
        math.log1p(hidden),
        math.log1p(near),
        len(persons) / total,
        (size - len(raw.translate(None, _UPPER))) / size,
        (size - len(raw.translate(None, _PUNCTUATION))) / size,
        raw.count(b"!") / size,
        (size - len(raw.translate(None, _DIGITS))) / size,
        mixed / total,
        apart / total,
    ]


_PERSON_BYTES = frozenset(word.encode() for word in SECOND_PERSON)


@dataclass
class Trees:
    """Boosted regression trees of fixed depth over binned features, for the logistic loss."""

    edges: list[np.ndarray]
    base: float
    rate: float = 0.2
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins = self.binned(x)
        out = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(int(math.log2(len(value)))):
                right = bins[np.arange(len(x)), feature[node]] > cut[node]
                node = 2 * node + 1 + right
            out += self.rate * value[node - (len(value) - 1)]
        return out


def _grow(bins, gradient, hessian, depth: int, slots: int, ridge: float = 1.0):
    rows, width = bins.shape
    feature = np.zeros(2**depth - 1, dtype=np.int64)
    cut = np.full(2**depth - 1, slots, dtype=np.int64)
    node = np.zeros(rows, dtype=np.int64)
    for level in range(depth):
        first, count = 2**level - 1, 2**level
        local = node - first
        best = np.full(count, 1e-9)
        total_g = np.bincount(local, gradient, count)
        total_h = np.bincount(local, hessian, count)
        for j in range(width):
            key = local * slots + bins[:, j]
            g = np.bincount(key, gradient, count * slots).reshape(count, slots).cumsum(1)
            h = np.bincount(key, hessian, count * slots).reshape(count, slots).cumsum(1)
            rest_g, rest_h = total_g[:, None] - g, total_h[:, None] - h
            gain = g * g / (h + ridge) + rest_g**2 / (rest_h + ridge) - (total_g**2 / (total_h + ridge))[:, None]
            gain[(h < 1e-3) | (rest_h < 1e-3)] = 0
            at = gain.argmax(1)
            found = gain[np.arange(count), at]
            better = found > best
            best[better] = found[better]
            feature[first : first + count][better] = j
            cut[first : first + count][better] = at[better]
        node = 2 * node + 1 + (bins[np.arange(rows), feature[node]] > cut[node])
    leaf = node - (2**depth - 1)
    g = np.bincount(leaf, gradient, 2**depth)
    h = np.bincount(leaf, hessian, 2**depth)
    return feature, cut, -g / (h + ridge)


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, slots: int = 32) -> Trees:
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, slots)[1:-1])) for column in x.T]
    model = Trees(edges, math.log(share / (1 - share)))
    bins = model.binned(x)
    margin = np.full(len(x), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(bins, p - y, p * (1 - p), depth, slots)
        model.trees.append(tree)
        grown = Trees(edges, 0.0, model.rate, [tree])
        margin += grown.margin(x)
    return model


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: block centres and their non-decreasing shares of label 1.

    One row of each label is added at the ends, so that no share is exactly 0 or 1.
    """
    order = np.argsort(margin, kind="stable")
    m, t = margin[order], y[order].astype(float)
    m = np.concatenate([m[:1], m, m[-1:]])
    t = np.concatenate([[1.0], t, [0.0]])
    w = np.concatenate([[0.5], np.ones(len(y)), [0.5]])
    blocks: list[list[float]] = []
    for value, label, weight in zip(m, t, w, strict=True):
        blocks.append([value * weight, label * weight, weight])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], top, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


@dataclass
class ToxicityModel:
    lexicon: dict[bytes, float]
    trees: Trees | None
    centres: np.ndarray
    shares: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.trees is None or not texts:
            return np.full(len(texts), self.shares[0])
        x = np.array([features(text, self.lexicon) for text in texts], dtype=float)
        return np.interp(self.trees.margin(x), self.centres, self.shares)


def _distinct_words(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    sets = [sorted(set(t.lower().encode("utf-8", "replace").translate(_SPACED).split())) if t else [] for t in texts_of(batch)]
    return {"words": pa.array(sets, pa.list_(pa.binary()))}


def _feature_rows(lexicon: dict[bytes, float], batch: pa.RecordBatch) -> dict[str, pa.Array]:
    return {"x": pa.array([features(t, lexicon) for t in texts_of(batch)], pa.list_(pa.float64()))}


def _part(doc_id: str) -> Column:
    """Half of the sample for the lexicon, a third for the trees, a sixth for the calibration."""
    slot = F.pmod(F.xxhash64(F.lit("part"), F.col(doc_id)), F.lit(6))
    return F.when(slot < 3, 0).when(slot < 5, 1).otherwise(2)


def _learn_lexicon(part: DataFrame, toxic: int, clean: int) -> dict[bytes, float]:
    """Words whose share among toxic texts clearly exceeds that among clean ones, with log odds.

    The sample is bounded, so the counts are too; at most ``LEXICON_WORDS`` reach the driver.
    """
    each = annotate(part, [T.StructField("words", T.ArrayType(T.BinaryType()))], _distinct_words, drop=["text"])
    words = each.select("label", F.explode("words").alias("word"))
    hit = F.col("label") == 1
    counts = words.groupBy("word").agg(
        F.count(F.when(hit, 1)).alias("t"), F.count(F.when(~hit, 1)).alias("c")
    )
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0))
    expected = (F.col("t") + F.col("c")) * toxic / (toxic + clean)
    surplus = (F.col("t") - expected) / F.sqrt(expected + 1)
    picked = (
        counts.withColumns({"odds": odds, "surplus": surplus})
        .filter((F.col("t") >= 3) & (F.col("odds") >= math.log(4)) & (F.col("surplus") >= 2))
        .orderBy(F.col("surplus").desc(), "word")
        .limit(LEXICON_WORDS)
    )
    return {bytes(r.word): float(r.odds) for r in picked.select("word", "odds").collect()}


def fit(documents: DataFrame, labels: DataFrame, staging: Staging, per_label: int = SAMPLE_PER_LABEL) -> ToxicityModel:
    """Learn from labelled rows outside the held-out fold, at most ``per_label`` of each label."""
    labelled = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~in_fold("doc_id", 3, 1))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    chosen = bounded_sample(labelled, "label", "doc_id", per_label)
    # At most two labels times per_label ids of 12 bytes.
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = staging.keep(texts.withColumn("part", _part("doc_id")), "toxic-sample")
    counts = {(r.part, r.label): r["count"] for r in sample.groupBy("part", "label").count().collect()}
    toxic = sum(n for (_, label), n in counts.items() if label)
    flat = ToxicityModel({}, None, np.zeros(1), np.array([toxic / max(1, sum(counts.values()))]))
    if any(counts.get((part, label), 0) == 0 for part in (0, 1, 2) for label in (0, 1)):
        return flat
    lexicon = _learn_lexicon(sample.filter("part = 0"), counts[0, 1], counts[0, 0])
    field_x = T.StructField("x", T.ArrayType(T.DoubleType()))
    rest = annotate(sample.filter("part > 0"), [field_x], functools.partial(_feature_rows, lexicon), drop=["text"])
    rows = rest.orderBy("doc_id").select("part", "label", "x").toPandas()
    x = np.array(rows["x"].tolist(), dtype=float)
    y = rows["label"].to_numpy(float)
    part = rows["part"].to_numpy()
    trees = fit_trees(x[part == 1], y[part == 1])
    centres, shares = isotonic(trees.margin(x[part == 2]), y[part == 2])
    return ToxicityModel(lexicon, trees, centres, shares)


def _scored(model: ToxicityModel, threshold: float, batch: pa.RecordBatch) -> dict[str, pa.Array]:
    scores = model.scores(texts_of(batch))
    return {"score": pa.array(scores, pa.float64()), "predicted": pa.array((scores >= threshold).astype(np.int32))}


def score(documents: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, drop: tuple[str, ...] = ()) -> DataFrame:
    """Documents plus ``score`` (0 to 1) and ``predicted`` (1 from the threshold on)."""
    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return annotate(documents, fields, functools.partial(_scored, model, threshold), drop)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(documents, read_table(spark, sf_dir, "labels"), Staging(spark))
    scored = score(documents, model, drop=("text",))
    return scored.select("doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "score", "predicted")
