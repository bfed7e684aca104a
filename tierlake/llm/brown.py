"""Language-model scoring with Brown-style word classes found by exchange clustering.

All counts cover all training texts. Every distinct word has a count and a class of its own.

- The most frequent words are types of their own; all others start as types shared by ending, so that
  type bigrams have a fixed bound. Exchange rounds sum each type's neighbouring classes on Spark; then
  every type in turn picks the class that raises the class-bigram likelihood most.
- Then every other word leaves its ending's type: the classes beside all its occurrences are summed on
  Spark, and it takes the class that raises the likelihood most, all words by the same class counts.
- Class bigrams are counted anew with these classes. Counts and classes of such words are in a table
  that is dealt by hash, never broadcast: texts are numbered in chunks, each chunk's distinct words are
  sent to their part of the table once, in blocks, and the chunk is read with what comes back.

P(text) is the product of class transition (smoothed by class frequency) and word emission within
the class (add one, with one unseen word per class). A text starts after an end and closes with one.

Edge cases: null and empty texts consist of one end; null ids teach nothing and are not held out;
without training texts every class and word is equally likely; repeated rows are scored each.
"""

from __future__ import annotations

import functools
import math
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tierlake.llm.common import bytes_of, in_fold, prepare, read_table
from tierlake.sources.staging import Staging

#: Types: frequent words of their own, and for a start groups of all other words by their last three bytes.
OWN_TYPES = 2048
ENDINGS = 1021
CLASSES = 64
ROUNDS = 7
_COUNTED = 200_000
_REMEMBERED = 200_000
_PAIRS_HELD = 1_500_000
#: Bytes of text numbered as one chunk, words that chunks send to one part, words that choose at once.
CHUNK_BYTES = 16 << 20
PART_WORDS = 1 << 20
_CHOOSING = 1 << 12


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush() -> pa.RecordBatch:
        arrays = [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["word", "n"])

    counts: Counter[bytes] = Counter()
    for batch in batches:
        for text in bytes_of(batch):
            counts.update(words_of(text))
            if len(counts) > _COUNTED:
                yield flush()
                counts.clear()
    yield flush()


class TypeOf(dict):
    """Word to type: own types first, then the end, then groups by ending. Remembers what it met."""

    def __init__(self, own: list[bytes]):
        super().__init__((word, i) for i, word in enumerate(own))
        self.end = len(own)

    def __missing__(self, word: bytes) -> int:
        kind = self.end + 1 + zlib.crc32(word[-3:]) % ENDINGS
        if len(self) < _REMEMBERED:
            self[word] = kind
        return kind


def _count_pairs(own: list[bytes], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring types, summed inside the task as far as memory allows."""
    types = TypeOf(own)
    width = types.end + 1 + ENDINGS

    def emit(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array((keys // width).astype(np.int32)), pa.array((keys % width).astype(np.int32)), pa.array(counts)]
        return pa.RecordBatch.from_arrays(arrays, names=["prev", "cur", "n"])

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)

    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        sequence = [types.end]
        for text in bytes_of(batch):
            sequence += map(types.__getitem__, words_of(text))
            sequence.append(types.end)
            if len(sequence) > 1 << 19:
                held.append(_pairs(sequence, width))
                sequence = [types.end]
        held.append(_pairs(sequence, width))
        size = sum(len(k) for k, _ in held)
        if size > _PAIRS_HELD:
            held = [merged(held)]
            if len(held[0][0]) > _PAIRS_HELD // 2:
                yield emit(*held[0])
                held = []
    if held:
        yield emit(*merged(held))


def _pairs(sequence: list[int], width: int) -> tuple[np.ndarray, np.ndarray]:
    kinds = np.array(sequence, dtype=np.int64)
    return np.unique(kinds[:-1] * width + kinds[1:], return_counts=True)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def best_class(pairs: np.ndarray, right: np.ndarray, left: np.ndarray, own: float, at: int) -> int:
    """The class whose likelihood gains most from taking the type in; ties go to its present class.

    The last class belongs to the end and is not open to others.
    ``pairs`` are class bigram counts with the type in class ``at``; ``right`` and ``left`` count the
    classes after and before it without its own repetitions, which are ``own``.
    """
    rest = pairs.copy()
    rest[at] -= right
    rest[:, at] -= left
    rest[at, at] -= own
    rest = np.maximum(rest, 0)
    # Totals of the classes with the type's neighbours counted, wherever the type goes.
    after, before = rest.sum(1) + left, rest.sum(0) + right
    gain = (_xlogx(rest + right[None]) - _xlogx(rest)).sum(1)
    gain += (_xlogx(rest + left[:, None]) - _xlogx(rest)).sum(0)
    corner = np.diag(rest)
    gain -= _xlogx(corner + right) + _xlogx(corner + left) - 2 * _xlogx(corner)
    gain += _xlogx(corner + right + left + own) - _xlogx(corner)
    gain -= _xlogx(after + right.sum() + own) - _xlogx(after)
    gain -= _xlogx(before + left.sum() + own) - _xlogx(before)
    gain = gain[:-1]
    return at if gain[at] >= gain.max() - 1e-9 else int(gain.argmax())


def _class_frame(spark: SparkSession, classes: np.ndarray) -> DataFrame:
    """One row per type, so at most OWN_TYPES + ENDINGS + 1."""
    return F.broadcast(spark.createDataFrame(list(enumerate(classes.tolist())), "kind int, class int"))


def _class_pairs(bigrams: DataFrame, frame: DataFrame, count: int) -> np.ndarray:
    before, after = frame.toDF("prev", "c"), frame.toDF("cur", "d")
    rows = bigrams.join(before, "prev").join(after, "cur").groupBy("c", "d").agg(F.sum("n").alias("n")).collect()
    table = np.zeros((count, count))
    for row in rows:
        table[row.c, row.d] = row.n
    return table


def _neighbours(bigrams: DataFrame, frame: DataFrame, size: int, count: int) -> tuple[np.ndarray, ...]:
    """Per type: counts of the classes after and before it, and of its own repetitions.

    Summed on the cluster; the driver receives two numbers per type and class, whatever the corpus.
    """
    same = F.col("prev") == F.col("cur")
    side = lambda kind, number, near: F.struct(F.col(kind).alias("kind"), F.lit(number).alias("side"), near.alias("near"))
    sides = F.when(same, F.array(side("prev", 2, F.lit(0)))).otherwise(
        F.array(side("prev", 0, F.col("d")), side("cur", 1, F.col("c")))
    )
    seen = bigrams.join(frame.toDF("prev", "c"), "prev").join(frame.toDF("cur", "d"), "cur")
    rows = seen.select(F.explode(sides).alias("s"), "n").groupBy("s.kind", "s.side", "s.near").agg(F.sum("n").alias("n")).toPandas()
    tables = [np.zeros((size, count)) for _ in range(3)]
    for number, table in enumerate(tables):
        part = rows[rows["side"] == number]
        table[part["kind"].to_numpy(), part["near"].to_numpy()] = part["n"].to_numpy()
    return tables[0], tables[1], tables[2][:, 0]


def cluster(bigrams: DataFrame, weight: np.ndarray, end: int, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of every type, from type bigrams and type frequencies.

    The most frequent types start in classes of their own, the others together in the last common
    one. A round takes the types by falling frequency; a move changes the class counts the next
    type sees, while neighbouring classes are summed anew once a round. A seeded coin lets half of
    the moves of a round happen, as neighbours that move together would follow outdated counts.
    """
    spark = bigrams.sparkSession
    coin = np.random.default_rng(11)
    order = [int(k) for k in np.argsort(-weight, kind="stable") if k != end and weight[k] > 0]
    found = np.full(len(weight), classes - 1, dtype=np.int64)
    found[order[: classes - 1]] = np.arange(min(classes - 1, len(order)))
    found[end] = classes
    for _ in range(rounds):
        frame = _class_frame(spark, found)
        right, left, own = _neighbours(bigrams, frame, len(weight), classes + 1)
        pairs = np.zeros((classes + 1, classes + 1))
        np.add.at(pairs, found, right)
        np.add.at(pairs, (found, found), own)
        for kind in order:
            at = found[kind]
            to = best_class(pairs, right[kind], left[kind], own[kind], at)
            if to != at and coin.random() < 0.5:
                for place, sign in ((at, -1), (to, 1)):
                    pairs[place] += sign * right[kind]
                    pairs[:, place] += sign * left[kind]
                    pairs[place, place] += sign * own[kind]
                np.maximum(pairs, 0, out=pairs)
                found[kind] = to
    return found


@dataclass
class ClassModel:
    own: list[bytes]
    own_counts: np.ndarray
    ends: int
    classes: np.ndarray  # of types; those of endings are for words that training texts do not have
    transition: np.ndarray  # log10
    emission: np.ndarray  # log10 of each class's denominator
    tokens: int
    distinct: int

    @property
    def base(self) -> float:
        return math.log10(self.tokens + self.distinct + 1)


def _smoothed(pairs: np.ndarray, share: np.ndarray) -> np.ndarray:
    return np.log10((pairs + share[None]) / (pairs.sum(1, keepdims=True) + 1))


class Numbering(dict):
    """Numbers of words in a chunk: types of own words and the end first, then others as they appear."""

    def __init__(self, own: list[bytes]):
        super().__init__((word, i) for i, word in enumerate(own))
        self.first = len(own) + 1
        self.rare: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = self.first + len(self.rare)
        self.rare.append(word)
        return number


_CHUNK_SCHEMA = (
    "chunk long, part int, numbers binary, words binary, kinds binary, spans binary, slots binary, counts binary, "
    "doc_ids array<bigint>, learn array<boolean>, sizes array<int>, sequence binary"
)
_BLOCK = ["chunk", "part", "numbers", "words", "kinds", "spans", "slots", "counts"]
_TEXTS = ["chunk", "doc_ids", "learn", "sizes", "sequence"]
_KINDS = dict.fromkeys(_BLOCK, pa.binary()) | {
    "chunk": pa.int64(), "part": pa.int32(), "doc_ids": pa.list_(pa.int64()), "learn": pa.list_(pa.bool_()),
    "sizes": pa.list_(pa.int32()), "sequence": pa.binary(),
}


def _batch(rows: list[dict], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    arrays = [pa.array([row.get(name) for row in rows], kind) for name, kind in kinds.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(kinds))


def _beside(
    sequence: np.ndarray, learn: np.ndarray, classes: np.ndarray, first: int, width: int
) -> tuple[np.ndarray, ...]:
    """``(number, slot, n)`` of words that are no types, where ``learn``: the classes after, then those before."""
    own = classes[sequence]
    at = np.flatnonzero((sequence >= first) & learn)
    # A chunk starts after an end and closes with one, which is a type.
    after, before = own[np.minimum(at + 1, len(own) - 1)], own[at - 1]
    number = (sequence[at] - first).astype(np.int64) * 2 * width
    keys, n = np.unique(np.concatenate([number + after, number + width + before]), return_counts=True)
    return keys // (2 * width), (keys % (2 * width)).astype(np.uint8), n.astype("<i4")


def _part_of(words: list[bytes], parts: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) % parts for w in words), dtype=np.int32, count=len(words))


def _chunks(
    own: list[bytes], classes: np.ndarray | None, parts: int, chunk_bytes: int, batches: Iterable[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Per chunk a row with its texts as numbers, and a row per part with its words that are no types.

    With the classes of types, such a row also says how often which class is beside a word.
    """
    types = TypeOf(own)
    context = TaskContext.get()
    chunk = (context.partitionId() if context else 0) << 34

    def emit() -> pa.RecordBatch:
        sequence, rare = np.array(numbers, dtype=np.int32), known.rare
        kinds = np.fromiter(map(types.__getitem__, rare), dtype=np.int32, count=len(rare))
        owner, slot, n = np.empty(0, np.int64), np.empty(0, np.uint8), np.empty(0, "<i4")
        if classes is not None:
            each = np.concatenate([classes[: known.first], classes[kinds]])
            owner, slot, n = _beside(sequence, np.repeat(learn, sizes), each, known.first, int(classes[types.end]) + 1)
        spans = np.bincount(owner, minlength=len(rare)).astype(np.uint8)
        part = _part_of(rare, parts)
        order, entries = np.argsort(part, kind="stable"), np.argsort(part[owner], kind="stable")
        edges, cuts = (np.searchsorted(x, np.arange(parts + 1)) for x in (part[order], part[owner][entries]))
        rows = [{"chunk": chunk, "doc_ids": ids, "learn": learn, "sizes": sizes, "sequence": sequence.tobytes()}]
        for p in np.flatnonzero(np.diff(edges)).tolist():
            here, at = order[edges[p] : edges[p + 1]], entries[cuts[p] : cuts[p + 1]]
            values = (chunk, p, here.astype("<i4").tobytes(), b"\n".join([rare[i] for i in here.tolist()]), kinds[here].tobytes())
            rows.append(dict(zip(_BLOCK, (*values, spans[here].tobytes(), slot[at].tobytes(), n[at].tobytes()), strict=True)))
        return _batch(rows, {name: _KINDS[name] for name in (*_BLOCK, *_TEXTS[1:])})

    known, numbers, ids, learn, sizes, held = Numbering(own), array("i"), [], [], [], 0
    for batch in batches:
        for doc_id, text, learns in zip(batch.column(0).to_pylist(), bytes_of(batch), batch.column(2).to_pylist(), strict=True):
            words = words_of(text)
            numbers.extend(map(known.__getitem__, words))
            numbers.append(types.end)
            ids.append(doc_id)
            learn.append(learns)
            sizes.append(len(words) + 1)
            held += len(text or b"")
            if held > chunk_bytes:
                yield emit()
                known, numbers, ids, learn, sizes, held, chunk = Numbering(own), array("i"), [], [], [], 0, chunk + 1
    if ids:
        yield emit()


def choose(pairs: np.ndarray, owner: np.ndarray, slot: np.ndarray, n: np.ndarray, present: np.ndarray) -> np.ndarray:
    """The class of every word that raises the likelihood of the class bigrams ``pairs`` most, if the word
    leaves its present class; ties go to that. ``(owner, slot, n)`` are sorted and count the classes after
    a word and, from ``len(pairs)`` on, those before it. The last class is the end's.
    """
    count = len(pairs)
    right = slot < count
    near = np.where(right, slot, slot.astype(np.int64) - count)
    stays = present[owner]
    here = np.where(right[:, None], pairs.T[near], pairs[near])
    each = np.arange(len(owner))
    here[each, stays] = np.maximum(here[each, stays] - n, 0)
    gain = np.add.reduceat(_xlogx(here + n[:, None]) - _xlogx(here), np.searchsorted(owner, np.arange(len(present))))
    for side, totals in ((right, pairs.sum(1)), (~right, pairs.sum(0))):
        mine = np.bincount(owner[side], n[side], len(present))
        rest = np.repeat(totals[None], len(present), 0)
        rest[np.arange(len(present)), present] -= mine
        rest = np.maximum(rest, 0)
        gain -= _xlogx(rest + mine[:, None]) - _xlogx(rest)
    gain = gain[:, :-1]
    best = gain.argmax(1)
    own = gain[np.arange(len(present)), present]
    return np.where(own >= gain.max(1) - 1e-9, present, best)


_FOUND = "chunk long, part int, numbers binary, words binary, classes binary, counts binary"
_FOUND_KINDS = {name: _KINDS[name] for name in _BLOCK[:4]} | {"classes": pa.binary(), "counts": pa.binary()}


def _by_part(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of every part, which come together."""
    part, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[1] != part:
                if rows:
                    yield part, rows
                part, rows = row[1], []
            rows.append(row)
    if rows:
        yield part, rows


def _choose(pairs: np.ndarray, classes: np.ndarray, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The class and count of every word of every chunk, and per part of all words that were learnt."""
    width = 2 * len(pairs)
    for part, rows in _by_part(batches):
        index: dict[bytes, int] = {}
        owners, slots, counts, places = [], [], [], []
        kinds = np.zeros(sum(len(row[2]) // 4 for row in rows), dtype=np.int32)
        for chunk, _, numbers, words, kind, spans, slot, n in rows:
            named = words.split(b"\n")
            at = np.fromiter((index.setdefault(w, len(index)) for w in named), dtype=np.int64, count=len(named))
            kinds[at] = np.frombuffer(kind, dtype=np.int32)
            owners.append(np.repeat(at, np.frombuffer(spans, dtype=np.uint8)))
            slots.append(np.frombuffer(slot, dtype=np.uint8))
            counts.append(np.frombuffer(n, dtype="<i4"))
            places.append((chunk, numbers, at))
        keys, place = np.unique(np.concatenate(owners) * width + np.concatenate(slots), return_inverse=True)
        n = np.bincount(place, np.concatenate(counts), len(keys))
        owner, slot = keys // width, keys % width
        chosen = classes[kinds[: len(index)]].astype(np.uint8)
        c = np.bincount(owner, np.where(slot >= len(pairs), n, 0), len(index)).astype("<i8")
        learnt = np.unique(owner)
        for start in range(0, len(learnt), _CHOOSING):
            some = learnt[start : start + _CHOOSING]
            low, high = np.searchsorted(owner, [some[0], some[-1] + 1])
            own = np.searchsorted(some, owner[low:high])
            chosen[some] = choose(pairs, own, slot[low:high], n[low:high], classes[kinds[some]])
        words = list(index)
        found = [(None, part, None, b"\n".join([words[i] for i in learnt.tolist()]), chosen[learnt].tobytes(), c[learnt].tobytes())]
        found = found if len(learnt) else []
        found += [(chunk, part, numbers, None, chosen[at].tobytes(), c[at].tobytes()) for chunk, numbers, at in places]
        yield _batch([dict(zip(_FOUND_KINDS, row, strict=True)) for row in found], _FOUND_KINDS)


def _words_of_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words, classes, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            arrays = [pa.array(words.split(b"\n"), pa.binary()), pa.array(np.frombuffer(classes, dtype=np.uint8).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.frombuffer(counts, dtype="<i8"))], names=["word", "class", "c"])


def _parts_of_words(parts: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, classes, counts = (c.to_pylist() for c in batch.columns)
        rows = [
            {"part": p, "words": w, "classes": bytes([k]), "counts": c.to_bytes(8, "little")}
            for p, w, k, c in zip(_part_of(words, parts).tolist(), words, classes, counts, strict=True)
        ]
        yield _batch(rows, {name: (_KINDS | _FOUND_KINDS)[name] for name in _LOOKED_UP})


_LOOKED_UP = ["chunk", "part", "numbers", "words", "kinds", "classes", "counts"]


def _look_up(classes: np.ndarray, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class and count of the words of chunks; a part's rows come together, those of the table first."""
    part, table = None, {}
    for batch in batches:
        for chunk, p, numbers, words, kinds, chosen, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if p != part:
                part, table = p, {}
            if chunk is None:
                table[words] = (chosen[0], int.from_bytes(counts, "little"))
                continue
            first = classes[np.frombuffer(kinds, dtype=np.int32)].tolist()
            found = [table.get(w, (k, 0)) for w, k in zip(words.split(b"\n"), first, strict=True)]
            row = {"chunk": chunk, "part": p, "numbers": numbers, "classes": bytes([k for k, _ in found])}
            yield _batch([row | {"counts": np.array([c for _, c in found], dtype="<i8").tobytes()}], _FOUND_KINDS)


_READ = (
    "doc_ids array<bigint>, learn array<boolean>, sizes array<int>, weights array<double>, known array<bigint>, classes binary"
)


def _read_chunks(
    classes: np.ndarray, own_counts: np.ndarray, batches: Iterable[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Chunks with the class of every token, and per text its words' weights and how many are known.

    A chunk's rows come together, its texts first.
    """
    own = len(own_counts)
    kinds = {name: _KINDS[name] for name in _TEXTS[1:4]}
    kinds |= {"weights": pa.list_(pa.float64()), "known": pa.list_(pa.int64()), "classes": pa.binary()}

    def read() -> pa.RecordBatch:
        doc_ids, learn, sizes, sequence = texts
        number, chosen, c = (
            np.concatenate([np.empty(0, kind), *(np.frombuffer(f[i], dtype=kind) for f in found)])
            for i, kind in enumerate(("<i4", np.uint8, "<i8"))
        )
        classed, counted = np.empty(own + len(number), np.uint8), np.empty(own + len(number))
        classed[:own], counted[:own] = classes[:own], own_counts
        classed[own + number], counted[own + number] = chosen, c
        sequence = np.frombuffer(sequence, dtype=np.int32)
        starts = np.cumsum(sizes) - sizes
        weights = np.add.reduceat(np.log10(counted + 1)[sequence], starts)
        known = np.add.reduceat((counted > 0)[sequence].astype(np.int64), starts)
        values = (doc_ids, learn, sizes, weights.tolist(), known.tolist(), classed[sequence].tobytes())
        return _batch([dict(zip(kinds, values, strict=True))], kinds)

    texts, found = None, []
    for batch in batches:
        for numbers, chosen, counts, *new in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if numbers is not None:
                found.append((numbers, chosen, counts))
                continue
            if texts is not None:
                yield read()
            texts, found = new, []
    if texts is not None:
        yield read()


def _read(chunks: DataFrame, found: DataFrame, classes: np.ndarray, own_counts: np.ndarray) -> DataFrame:
    """Staged chunks read with the counts and classes of their words."""
    found = found.filter("chunk IS NOT NULL").select("chunk", "numbers", "classes", "counts")
    texts = chunks.filter("part IS NULL").select(*_TEXTS)
    together = found.unionByName(texts, allowMissingColumns=True).repartition("chunk")
    rows = together.sortWithinPartitions("chunk", F.col("numbers").isNotNull()).drop("chunk")
    return rows.mapInArrow(functools.partial(_read_chunks, classes, own_counts), _READ)


def _count_classes(count: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class bigrams of the texts to learn from."""
    table = np.zeros(count * count, dtype=np.int64)
    for batch in batches:
        for learn, sizes, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = np.frombuffer(data, dtype=np.uint8).astype(np.int64)
            # A chunk starts after an end, as it closes with one.
            both = (np.roll(own, 1) * count + own)[np.repeat(learn, sizes)]
            table += np.bincount(both, minlength=len(table))
    at = np.flatnonzero(table)
    arrays = [pa.array((at // count).astype(np.int32)), pa.array((at % count).astype(np.int32)), pa.array(table[at])]
    yield pa.RecordBatch.from_arrays(arrays, names=["c", "d", "n"])


def _table(rows: Iterable, count: int) -> np.ndarray:
    table = np.zeros((count, count))
    for row in rows:
        table[row.c, row.d] = row.n
    return table


def fit(documents: DataFrame, staging: Staging, chunk_bytes: int = CHUNK_BYTES) -> tuple[ClassModel, DataFrame]:
    """The class model and the table ``(word, class, c)`` of all words of ``documents(text)`` that are no types."""
    return learn(documents.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(True).alias("learn")), staging, chunk_bytes)[:2]


def learn(
    marked: DataFrame, staging: Staging, chunk_bytes: int = CHUNK_BYTES
) -> tuple[ClassModel, DataFrame, DataFrame]:
    """The model and words of ``fit`` from the rows of ``(doc_id, text, learn)`` that are marked, and all rows read."""
    marked = marked.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "learn")
    documents = marked.filter("learn")
    counted = documents.select("text").mapInArrow(_count_words, "word binary, n long")
    words = staging.keep(counted.groupBy("word").agg(F.sum("n").alias("c")), "words")
    ends = documents.count()
    top = words.orderBy(F.col("c").desc(), "word").limit(OWN_TYPES).collect()
    own = [bytes(r.word) for r in top]
    end = len(own)
    pairs = documents.select("text").mapInArrow(functools.partial(_count_pairs, own), "prev int, cur int, n long")
    bigrams = staging.keep(pairs.groupBy("prev", "cur").agg(F.sum("n").alias("n")), "bigrams")
    listed = staging.spark.createDataFrame([(word, i) for i, word in enumerate(own)], "word binary, own int")
    ending = F.crc32(F.when(F.length("word") > 3, F.substring("word", -3, 3)).otherwise(F.col("word")))
    kind = F.coalesce("own", (F.lit(end + 1) + ending % ENDINGS).cast("int"))
    sums = (
        words.join(F.broadcast(listed), "word", "left").groupBy(kind.alias("kind"))
        .agg(F.sum("c").alias("tokens"), F.count("*").alias("distinct")).collect()
    )
    size = end + 1 + ENDINGS
    tokens, distinct = np.zeros(size), np.zeros(size)
    for row in sums:
        tokens[row.kind], distinct[row.kind] = row.tokens, row.distinct
    tokens[end], distinct[end] = ends, ends > 0
    classes = cluster(bigrams, tokens, end)
    count = CLASSES + 1
    before = _class_pairs(bigrams, _class_frame(staging.spark, classes), count)
    parts = int(tokens[end + 1 :].sum()) // PART_WORDS + 1
    numbering = functools.partial(_chunks, own, classes, parts, chunk_bytes)
    chunks = staging.keep(marked.mapInArrow(numbering, _CHUNK_SCHEMA), "chunks", "zstd")
    dealt = chunks.filter("part IS NOT NULL").select(*_BLOCK).repartition("part").sortWithinPartitions("part")
    found = staging.keep(dealt.mapInArrow(functools.partial(_choose, before, classes), _FOUND), "found", "zstd")
    named = found.filter("chunk IS NULL").select("words", "classes", "counts")
    chosen = staging.keep(named.mapInArrow(_words_of_parts, "word binary, class int, c long"), "classes")
    own_counts = np.array([*(r.c for r in top), ends], dtype=float)
    read = staging.keep(_read(chunks, found, classes, own_counts), "read", "zstd")
    pairs = read.select("learn", "sizes", "classes").mapInArrow(functools.partial(_count_classes, count), "c int, d int, n long")
    after = _table(pairs.groupBy("c", "d").agg(F.sum("n").alias("n")).collect(), count)
    class_tokens = np.bincount(classes[: end + 1], own_counts, count)
    class_words = np.bincount(classes[: end + 1], own_counts > 0, count)
    for row in chosen.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        class_tokens[row["class"]] += row.c
        class_words[row["class"]] += row.n
    share = (class_tokens + 1) / (class_tokens.sum() + count)
    model = ClassModel(
        own,
        own_counts[:-1],
        ends,
        classes,
        _smoothed(after, share),
        np.log10(class_tokens + class_words + 1),
        int(tokens.sum()),
        int(distinct.sum()),
    )
    return model, chosen, read


def _score(model: ClassModel, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text of a chunk."""
    for batch in batches:
        for doc_ids, _, sizes, weights, known, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            classes = np.frombuffer(data, dtype=np.uint8)
            # Every text, the first of a chunk included, starts after an end.
            steps = model.transition[np.roll(classes, 1), classes] - model.emission[classes]
            weights, n = np.array(weights), np.array(sizes, dtype=np.int64)
            total = np.add.reduceat(steps, np.cumsum(n) - n) + weights
            arrays = [pa.array(doc_ids, pa.int64()), pa.array(n), pa.array(known, pa.int64())]
            arrays += [pa.array(weights - n * model.base), pa.array(total)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "n_known", "base_score", "score"])


def scored(read: DataFrame, model: ClassModel) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score (log10) of every text that was read."""
    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    return read.mapInArrow(functools.partial(_score, model), schema)


def score(
    documents: DataFrame, model: ClassModel, words: DataFrame, staging: Staging | None = None, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """As ``scored``, for every row of any ``documents``, with the words that were learnt."""
    staging = staging or Staging(documents.sparkSession)
    parts = words.count() // PART_WORDS + 1
    source = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.lit(False).alias("learn"))
    numbering = functools.partial(_chunks, model.own, None, parts, chunk_bytes)
    chunks = staging.keep(source.mapInArrow(numbering, _CHUNK_SCHEMA), "chunks", "zstd")
    asked = chunks.filter("part IS NOT NULL").select("chunk", "part", "numbers", "words", "kinds")
    schema = ", ".join(f"{name} {'long' if name == 'chunk' else 'int' if name == 'part' else 'binary'}" for name in _LOOKED_UP)
    table = words.select("word", "class", "c").mapInArrow(functools.partial(_parts_of_words, parts), schema)
    both = table.unionByName(asked, allowMissingColumns=True).select(*_LOOKED_UP).repartition("part")
    found = both.sortWithinPartitions("part", F.col("chunk").isNotNull()).mapInArrow(functools.partial(_look_up, model.classes), _FOUND)
    return scored(_read(chunks, found, model.classes, np.append(model.own_counts, model.ends)), model)


def op6_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = documents.withColumn("learn", F.col("doc_id").isNotNull() & ~in_fold("doc_id", 7, 2))
    model, _, read = learn(marked, Staging(spark))
    return scored(read, model).select(
        "doc_id",
        in_fold("doc_id", 7, 2).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
