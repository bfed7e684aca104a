"""Language identification by a byte convolutional network trained in numpy.

A window of fixed length is embedded byte by byte; filters of several widths run over it, each
keeps its maximum, and a softmax layer names the language. A text is the length-weighted mean of
all its windows. Training takes a bounded number of windows, spread over whole texts, from a bounded
number of documents per language; prediction reads every byte of every text, without a shuffle.

Edge cases: null texts and texts without a letter are ``und`` with score 0, as is everything when
no labelled text exists; null languages and null ids teach nothing; ties go to the smaller name.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tierlake.llm.common import annotate, prepare, bounded_sample, in_fold, read_table, texts_of
from tierlake.sources.staging import Staging

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 8
#: Bounds of the training sample: documents per language, languages, windows per document.
DOCS_PER_LANGUAGE = 300
LANGUAGES = 256
WINDOWS_PER_DOC = 8
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
_BLOCK = 96


@dataclass
class ByteNet:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # per width: FILTERS x width x EMBEDDING
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def tables(self) -> tuple[np.ndarray, ...]:
        """Filter responses of byte pairs: every convolution becomes one gather and two additions."""
        single = [[self.embedding @ w[:, o].T for o in range(w.shape[1])] for w in self.filters]
        pair = lambda left, right: (left[:, None] + right[None]).reshape(65536, -1)
        zero = np.zeros((256, FILTERS))
        two = pair(single[0][0], single[0][1])
        three = pair(single[1][0], single[1][1])
        four = pair(single[2][0], single[2][1])
        three_last = pair(single[1][2], zero)
        four_last = pair(single[2][2], single[2][3])
        return np.concatenate([two, three, four, three_last, four_last], axis=1).astype(np.float32)

    def head(self, pooled: np.ndarray) -> np.ndarray:
        logits = np.maximum(pooled + self.bias, 0) @ self.weights + self.offset
        logits -= logits.max(1, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(1, keepdims=True)


def windows_of(data: bytes) -> np.ndarray:
    """Whole text as rows of WINDOW bytes, the last filled with zeros."""
    rows = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(rows * WINDOW, b"\0"), dtype=np.uint8).reshape(rows, WINDOW)


def pooled(windows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Maximum response of every filter in every window."""
    out = np.empty((len(windows), FILTERS * len(WIDTHS)), dtype=np.float32)
    f = FILTERS
    for start in range(0, len(windows), _BLOCK):
        block = np.pad(windows[start : start + _BLOCK].astype(np.int32), ((0, 0), (0, 1)))
        # Position first, so that the maxima run over contiguous rows.
        answer = table[(block[:, :-1] * 256 + block[:, 1:]).T]
        part = out[start : start + _BLOCK]
        part[:, :f] = answer[:-1, :, :f].max(0)
        part[:, f : 2 * f] = (answer[:-2, :, f : 2 * f] + answer[2:, :, 3 * f : 4 * f]).max(0)
        part[:, 2 * f :] = (answer[:-3, :, 2 * f : 3 * f] + answer[2:-1, :, 4 * f :]).max(0)
    return out


def train(windows: np.ndarray, target: np.ndarray, languages: list[str], epochs: int = 8, seed: int = 7) -> ByteNet:
    """Adam on cross-entropy; gradients flow through the position that won each maximum."""
    rng = np.random.default_rng(seed)
    total = FILTERS * len(WIDTHS)
    net = ByteNet(
        languages,
        rng.normal(0, 0.5, (256, EMBEDDING)),
        [rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (FILTERS, w, EMBEDDING)) for w in WIDTHS],
        np.zeros(total),
        rng.normal(0, 0.2, (total, len(languages))),
        np.zeros(len(languages)),
    )
    parameters = [net.embedding, *net.filters, net.bias, net.weights, net.offset]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    share = np.bincount(target, minlength=len(languages)) / len(target)
    importance = 1 / (len(languages) * np.maximum(share, 1e-9))
    step, batch = 0, 128
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.001
        order = rng.permutation(len(windows))
        for start in range(0, len(order), batch):
            rows = order[start : start + batch]
            x, y = windows[rows].astype(np.int64), target[rows]
            best, at = [], []
            for w in net.filters:
                span = WINDOW - w.shape[1] + 1
                response = 0
                for o in range(w.shape[1]):
                    response = response + (net.embedding @ w[:, o].T).astype(np.float32)[x[:, o : o + span]]
                place = response.argmax(1)
                at.append(place)
                best.append(np.take_along_axis(response, place[:, None], 1)[:, 0])
            maxima = np.concatenate(best, axis=1).astype(float)
            hidden = np.maximum(maxima + net.bias, 0)
            p = net.head(maxima)
            slope = p.copy()
            slope[np.arange(len(y)), y] -= 1
            slope *= importance[y][:, None] / len(y)
            back = (slope @ net.weights.T) * (hidden > 0)
            grads = [np.zeros_like(net.embedding)]
            for i, w in enumerate(net.filters):
                g = back[:, i * FILTERS : (i + 1) * FILTERS]
                places = at[i][:, :, None] + np.arange(w.shape[1])
                seen = x[np.arange(len(y))[:, None, None], places]
                grads.append(np.einsum("nf,nfwd->fwd", g, net.embedding[seen], optimize=True))
                np.add.at(grads[0], seen, g[:, :, None, None] * w[None])
            grads += [back.sum(0), hidden.T @ slope, slope.sum(0)]
            step += 1
            for parameter, gradient, (m, v) in zip(parameters, grads, moments, strict=True):
                m += 0.1 * (gradient - m)
                v += 0.001 * (gradient**2 - v)
                parameter -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _spread_windows(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    picked = []
    for text in texts_of(batch):
        rows = windows_of((text or "").encode("utf-8", "replace"))
        at = np.unique(np.linspace(0, len(rows) - 1, min(len(rows), WINDOWS_PER_DOC)).astype(int))
        picked.append([rows[i].tobytes() for i in at])
    return {"windows": pa.array(picked, pa.list_(pa.binary()))}


def fit(documents: DataFrame, staging: Staging, per_language: int = DOCS_PER_LANGUAGE) -> ByteNet | None:
    """Train on documents with a language outside the held-out fold; None if there are none."""
    usable = F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~in_fold("doc_id", 3, 1)
    ids = documents.select("doc_id", F.col("lang").cast("string").alias("lang")).filter(usable)
    # The most frequent languages; a label set, so the bound is far away.
    common = ids.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(LANGUAGES).select("lang")
    ids = ids.join(F.broadcast(common), "lang", "left_semi")
    chosen = bounded_sample(ids, "lang", "doc_id", per_language)
    chosen = chosen.select("doc_id").distinct()
    # At most LANGUAGES * per_language ids.
    texts = documents.filter(usable & F.col("text").isNotNull()).select("doc_id", "lang", "text").join(F.broadcast(chosen), "doc_id")
    made = annotate(texts, [T.StructField("windows", T.ArrayType(T.BinaryType()))], _spread_windows, drop=["text"])
    rows = made.orderBy("doc_id", "lang").toPandas()
    rows = rows[rows["windows"].map(len) > 0]
    if not len(rows):
        return None
    languages = sorted(set(rows["lang"]))
    windows = np.stack([np.frombuffer(w, dtype=np.uint8) for each in rows["windows"] for w in each])
    target = np.array([languages.index(lang) for lang, each in zip(rows["lang"], rows["windows"]) for _ in each])
    return train(windows, target, languages)


def predict(net: ByteNet | None, table: np.ndarray | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    at = [i for i, text in enumerate(texts) if net and text and _LETTER.search(text)]
    if not at:
        return names, scores
    pieces = [texts[i].encode("utf-8", "replace") for i in at]
    # Texts are joined into runs of bounded size.
    start = 0
    while start < len(at):
        stop, size = start, 0
        while stop < len(at) and (stop == start or size + len(pieces[stop]) <= 1 << 20):
            size += len(pieces[stop])
            stop += 1
        parts = [windows_of(piece) for piece in pieces[start:stop]]
        p = net.head(pooled(np.concatenate(parts), table))
        ends = np.cumsum([len(part) for part in parts])
        weight = np.full(len(p), float(WINDOW))
        weight[ends - 1] = [max(1, len(d) - (len(w) - 1) * WINDOW) for d, w in zip(pieces[start:stop], parts, strict=True)]
        sums = np.add.reduceat(p * weight[:, None], np.concatenate([[0], ends[:-1]]), axis=0)
        mean = sums / sums.sum(1, keepdims=True)
        for i, row in zip(at[start:stop], mean, strict=True):
            names[i], scores[i] = net.languages[int(row.argmax())], float(row.max())
        start = stop
    return names, scores


def _predicted(net: ByteNet | None, batch: pa.RecordBatch) -> dict[str, pa.Array]:
    names, scores = predict(net, _table_of(net), texts_of(batch))
    return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())}


_tables: dict[bytes, np.ndarray] = {}


def _table_of(net: ByteNet | None) -> np.ndarray | None:
    """The pair table of the model at hand, made once per worker instead of shipped."""
    if net is None:
        return None
    key = net.embedding.tobytes()[:256] + net.weights.tobytes()[:256]
    if key not in _tables:
        _tables.clear()
        _tables[key] = net.tables()
    return _tables[key]


def identify(documents: DataFrame, net: ByteNet | None, drop: tuple[str, ...] = ()) -> DataFrame:
    """Documents plus ``lang_pred`` and ``score``."""
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return annotate(documents, fields, functools.partial(_predicted, net), drop)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    documents = read_table(spark, sf_dir, "documents")
    net = fit(documents, Staging(spark))
    found = identify(documents.select("doc_id", "text"), net, drop=("text",))
    return found.select("doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")
