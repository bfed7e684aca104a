"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Benchmark items are normalised (lower case, runs of anything but letters and digits become one
space) and cut into overlapping windows of 64 bytes, one every 16 bytes and one at the end. So every
excerpt of an item of at least 79 normalised bytes (13 words of five letters) holds a whole window,
wherever it begins; shorter excerpts are found if they hold one, and items under 64 bytes as a whole.
A passage within ``e`` edits of a window of ``w`` bytes shares at least ``w + 1 - q (e + 1)`` q-grams with it, all on ``e + 1`` neighbouring diagonals, so
shared q-grams are counted in overlapping diagonal bands; a band that reaches the bound is verified
by an alignment restricted to it. The filter loses nothing: the result is every window that
occurs within its edit budget. Hits of windows of one item that overlap in the text are merged into spans.

The items travel to the tasks only in blocks of bounded size. A larger benchmark takes further passes
over the documents, each written before the next block is read.

Edge cases: null texts, null items and windows shorter than one q-gram match nothing; null ids are
carried along; repeated items are each reported; repeated documents are reported as often as they occur.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tierlake.llm.common import annotate, prepare, read_table, texts_of
from tierlake.sources.staging import Staging

Q = 10
WINDOW = 64
STRIDE = 16
#: Bytes of an excerpt that is sure to hold a window.
SMALLEST_EXCERPT = WINDOW + STRIDE - 1
#: Four edits in a whole window; a fifth would leave the lemma a bound of five q-grams, which filters little.
EDIT_RATE = 0.07
#: Width of the diagonal steps between overlapping bands.
BAND_STEP = 16
#: Characters of benchmark text in one pass over the documents.
BLOCK_CHARS = 1 << 20
_FILTER_BITS = 22
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_KEEP = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def normalise(text: str | None) -> bytes:
    return b" ".join((text or "").lower().encode("utf-8", "replace").translate(_KEEP).split())


def budget(width: int, rate: float = EDIT_RATE) -> int:
    """Edits allowed in a window: at most ``rate`` of it, and few enough for the lemma to hold."""
    return max(0, min(int(rate * width), width // Q - 1))


def gram_codes(data: bytes) -> np.ndarray:
    """A 64-bit code of the q-gram at every position."""
    count = len(data) - Q + 1
    if count < 1:
        return np.empty(0, dtype=np.uint64)
    words = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    return words[:count] * _M1 ^ words[Q - 8 : Q - 8 + count] * _M2


@dataclass
class WindowIndex:
    items: np.ndarray  # item of each window
    patterns: list[bytes]
    grams: np.ndarray  # sorted distinct codes
    first: np.ndarray  # where each code's occurrences begin
    window: np.ndarray  # occurrences: window, position in it
    place: np.ndarray
    rate: float

    def __post_init__(self):
        self.widths = np.array([len(p) for p in self.patterns], dtype=np.int64)
        self.edits = np.array([budget(w, self.rate) for w in self.widths], dtype=np.int64)
        self.bound = self.widths + 1 - Q * (self.edits + 1)

    @classmethod
    def build(cls, items: list[tuple[int | None, str | None]], rate: float = EDIT_RATE) -> WindowIndex:
        owners, patterns = [], []
        for number, (_, text) in enumerate(items):
            data = normalise(text)
            last = max(0, len(data) - WINDOW)
            cuts = sorted({*range(0, last + 1, STRIDE), last})
            for cut in cuts:
                if len(data) >= Q:
                    owners.append(number)
                    patterns.append(data[cut : cut + WINDOW])
        codes = [gram_codes(p) for p in patterns]
        lengths = np.array([len(c) for c in codes], dtype=np.int64)
        flat = np.concatenate([*codes, np.empty(0, np.uint64)])
        window = np.repeat(np.arange(len(patterns)), lengths)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        order = np.argsort(flat, kind="stable")
        grams, first = np.unique(flat[order], return_index=True)
        return cls(
            np.array(owners, dtype=np.int64), patterns, grams, np.append(first, len(flat)), window[order], place[order], rate
        )

    def filter_table(self) -> np.ndarray:
        table = np.zeros(1 << _FILTER_BITS, dtype=bool)
        table[_slots(self.grams)] = True
        return table


def _slots(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def candidate_bands(data: bytes, index: WindowIndex, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows and first diagonals of the bands that share enough q-grams with them."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    codes = gram_codes(data)
    if not len(codes) or not len(index.grams):
        return none
    at = np.flatnonzero(table[_slots(codes)])
    if not len(at):
        return none
    slot = np.searchsorted(index.grams, codes[at])
    slot[slot == len(index.grams)] = 0
    same = index.grams[slot] == codes[at]
    at, slot = at[same], slot[same]
    counts = index.first[slot + 1] - index.first[slot]
    total = int(counts.sum())
    if not total:
        return none
    offset = np.repeat(index.first[slot] - (np.cumsum(counts) - counts), counts) + np.arange(total)
    window, diagonal = index.window[offset], np.repeat(at, counts) - index.place[offset]
    band = diagonal // BAND_STEP
    # A band covers BAND_STEP + e diagonals, so the first e of a step also belong to the band before.
    shared = diagonal - band * BAND_STEP < index.edits[window]
    window = np.concatenate([window, window[shared]])
    band = np.concatenate([band, band[shared] - 1])
    key = window * (1 << 40) + band + (1 << 20)
    keys, number = np.unique(key, return_counts=True)
    window = keys >> 40
    enough = number >= index.bound[window]
    window, band = window[enough], (keys[enough] & ((1 << 40) - 1)) - (1 << 20)
    return window, band * BAND_STEP


def align(data: bytes, patterns: list[bytes], starts: np.ndarray, edits: np.ndarray):
    """Least edits of each pattern against any text on its diagonals, with that text's start and end.

    ``starts`` are the first diagonals; the band has BAND_STEP + e of them. All candidates of a
    text advance together, one pattern byte at a time.
    """
    m = len(patterns)
    span = BAND_STEP + int(edits.max())
    longest = max(len(p) for p in patterns)
    letters = np.zeros((m, longest), dtype=np.int16)
    for i, p in enumerate(patterns):
        letters[i, : len(p)] = np.frombuffer(p, dtype=np.uint8)
    lengths = np.array([len(p) for p in patterns])
    # Bytes before and after the text match nothing.
    margin = longest + span + BAND_STEP + int(edits.max()) + 1
    text = np.full(len(data) + 2 * margin, -1, dtype=np.int16)
    text[margin : margin + len(data)] = np.frombuffer(data, dtype=np.uint8)
    k = np.arange(span)
    outside = k[None, :] >= (BAND_STEP + edits)[:, None]
    big, unit = np.int64(1) << 50, np.int64(1) << 32
    # Cost in the high bits, start of the match in the low ones: the least value is the best match.
    begin = starts[:, None] + k[None, :]
    usable = (begin >= 0) & (begin <= len(data)) & ~outside
    cost = np.where(usable, np.clip(begin, 0, len(data)), big)
    best, finish = np.full(m, big), np.zeros(m, dtype=np.int64)
    for i in range(longest):
        place = begin + i
        step = np.where(text[np.clip(place + margin, 0, len(text) - 1)] == letters[:, i : i + 1], cost, cost + unit)
        step = np.where((place >= 0) & (place < len(data)), step, big)
        skip = np.full_like(cost, big)
        skip[:, :-1] = cost[:, 1:] + unit
        cost = np.minimum(np.minimum(step, skip), big)
        cost[outside] = big
        cost = np.minimum.accumulate(cost - k * unit, axis=1) + k * unit
        cost = np.minimum(np.where((place + 1 >= 0) & (place + 1 <= len(data)), cost, big), big)
        cost[outside] = big
        done = np.flatnonzero(lengths == i + 1)
        if len(done):
            at = cost[done].argmin(1)
            best[done] = cost[done, at]
            finish[done] = starts[done] + at + i + 1
    return best >> 32, best & (unit - 1), finish


def window_matches(data: bytes, index: WindowIndex, table: np.ndarray) -> list[tuple[int, int, int, int]]:
    """``(window, start, end, edits)`` in normalised bytes, one per window and band within budget."""
    windows, starts = candidate_bands(data, index, table)
    found = []
    for first in range(0, len(windows), 512):
        w, s = windows[first : first + 512], starts[first : first + 512]
        patterns = [index.patterns[i] for i in w]
        allowed = index.edits[w]
        # A copy without edits needs no alignment.
        exact = np.array(
            [
                data.find(p, max(0, int(d)), max(0, int(d) + BAND_STEP + int(e) - 1 + len(p)))
                for p, d, e in zip(patterns, s, allowed, strict=True)
            ]
        )
        found += [(int(w[i]), int(exact[i]), int(exact[i]) + len(patterns[i]), 0) for i in np.flatnonzero(exact >= 0)]
        rest = np.flatnonzero(exact < 0)
        if not len(rest):
            continue
        cost, begin, finish = align(data, [patterns[i] for i in rest], s[rest], allowed[rest])
        for k in np.flatnonzero(cost <= allowed[rest]):
            found.append((int(w[rest[k]]), int(begin[k]), int(finish[k]), int(cost[k])))
    return found


def _original(text: str) -> np.ndarray:
    """For every byte of the normalised text, the character of the text it comes from."""
    lower = text.lower()
    if len(lower) != len(text):  # a letter that has no lower case of one character
        owner = np.array([i for i, c in enumerate(text) for _ in c.lower()], dtype=np.int64)
        lower = "".join(c.lower() for c in text)
    else:
        owner = np.arange(len(text))
    points = np.frombuffer(lower.encode("utf-32-le", "replace"), dtype="<u4")
    size = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    plain = np.frombuffer(_KEEP, dtype=np.uint8) != 32
    kept = np.flatnonzero((points >= 128) | plain[np.minimum(points, 127)])
    gap = np.diff(kept, prepend=kept[:1]) > 1
    origin = np.repeat(owner[kept], size[kept] + gap)
    begins = np.cumsum(size[kept] + gap) - (size[kept] + gap)
    origin[begins[gap]] = owner[kept[gap] - 1]
    return origin


def spans(text: str | None, index: WindowIndex, table: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """``(item number, start, end, edits, windows)`` in characters; the most edits of one window."""
    data = normalise(text)
    matches = window_matches(data, index, table)
    if not matches:
        return []
    origin = _original(text)
    merged: list[list[int]] = []
    for item, a, b, edits, window in sorted((int(index.items[w]), a, b, e, w) for w, a, b, e in matches):
        if merged and merged[-1][0] == item and a <= merged[-1][2]:
            last = merged[-1]
            last[2], last[3] = max(last[2], b), max(last[3], edits)
            last[4].add(window)
        else:
            merged.append([item, a, b, edits, {window}])
    size = len(origin)
    return [
        (item, int(origin[min(a, size - 1)]), int(origin[min(max(b - 1, a), size - 1)]) + 1, edits, len(windows))
        for item, a, b, edits, windows in merged
    ]


_SPAN = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("edits", T.IntegerType()),
        T.StructField("windows", T.IntegerType()),
    ]
)
_ARROW_SPAN = pa.struct(
    [("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32()), ("windows", pa.int32())]
)


class _Matcher:
    """Finds spans in batches; the tables derived from the items are made once per task."""

    def __init__(self, items: list[tuple[int | None, str | None]], rate: float):
        self.items, self.rate = items, rate
        self.index: WindowIndex | None = None

    def __call__(self, batch: pa.RecordBatch) -> dict[str, pa.Array]:
        if self.index is None:
            self.index = WindowIndex.build(self.items, self.rate)
            self.table = self.index.filter_table()
        rows = [
            [
                {"item_id": self.items[item][0], "start": a, "end": b, "edits": e, "windows": n}
                for item, a, b, e, n in spans(text, self.index, self.table)
            ]
            for text in texts_of(batch)
        ]
        return {"_spans": pa.array(rows, pa.list_(_ARROW_SPAN))}

    def __getstate__(self):
        return {"items": self.items, "rate": self.rate, "index": None}


def _blocks(benchmark: DataFrame) -> tuple[int, Callable[[int], list[tuple[int | None, str]]]]:
    """How many blocks the items make, and the items of a block; only that block is read."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter(F.col("text").isNotNull())
    # One number reaches the driver.
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))

    def block(number: int) -> list[tuple[int | None, str]]:
        here = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == number)
        return [(r.item_id, r.text) for r in here.orderBy("item_id", "text").collect()]

    return blocks, block


def _spanned(documents: DataFrame, items: list[tuple[int | None, str]], rate: float, drop: tuple[str, ...] = ()) -> DataFrame:
    """Documents plus ``_spans``, the passages of these items found in each."""
    return annotate(documents, [T.StructField("_spans", T.ArrayType(_SPAN))], _Matcher(items, rate), drop)


def matches(
    documents: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE, staging: Staging | None = None
) -> DataFrame:
    """One row per passage: doc_id, item_id, start, end (characters), edits, windows."""
    blocks, block = _blocks(benchmark)
    result = None
    for number in range(blocks):
        found = _spanned(documents.select("doc_id", "text"), block(number), rate, ("text",))
        rows = found.select("doc_id", F.explode("_spans").alias("s")).select("doc_id", "s.*")
        rows = rows if blocks == 1 else (staging or Staging(documents.sparkSession)).keep(rows, "passages")
        result = rows if result is None else result.unionByName(rows)
    return result


def clean(
    documents: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE, staging: Staging | None = None
) -> DataFrame:
    """Documents without a benchmark passage, with all their columns."""
    columns = [c for c in documents.columns if not c.startswith("_spans")]
    blocks, block = _blocks(benchmark)
    for number in range(blocks):
        spanned = _spanned(documents.select(*columns), block(number), rate)
        documents = spanned.filter(F.size("_spans") == 0).select(*columns)
        documents = documents if blocks == 1 else (staging or Staging(documents.sparkSession)).keep(documents, "clean")
    return documents


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), staging=Staging(spark))
