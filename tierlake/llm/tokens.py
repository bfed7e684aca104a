"""SentencePiece encoding and decoding with a max-plus parallel scan for giant texts.

A text up to ``CHUNK`` characters is segmented in one go. A longer one is split into chunks that are
dealt over the cluster. A chunk's boundary state is how far the piece crossing the boundary reaches
beyond it; the chunk yields the max-plus matrix of best scores from each entry state to each exit
state. Matrices are multiplied in groups, groups per text, which gives every chunk its entry scores;
each chunk then says which entry state each exit state leads back to, those maps are composed, and
with its exit state known every chunk is backtraced on its own. Scores are whole numbers, so the ids
equal those of the text segmented in one go.

Positions that no piece can cross cut a text into units; ids of recent units are remembered.

Edge cases: a null text has null ids and decodes to null; an empty text has no ids; unknown ids
decode to nothing; a space sign in a text decodes to a space; repeated rows are encoded each.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tierlake.llm.common import annotate, prepare, read_table, texts_of
from tierlake.llm.unigram import (
    NEVER,
    VOCABULARY,
    Remembered,
    Vocabulary,
    automaton,
    backtrace,
    forward,
    load,
    normalised,
    segment,
)
from tierlake.sources.staging import Staging

#: Characters of a chunk; texts that are longer are encoded by the parallel scan.
CHUNK = 32_768
GROUP = 64
_IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
_TEXT = T.StructField("decoded", T.StringType())


class UnitIds(Remembered):
    """Ids of units as packed bytes."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        matcher = automaton(vocabulary)
        super().__init__(lambda unit: array("i", segment(vocabulary, matcher, unit)[0]).tobytes())

    def encode(self, text: str) -> np.ndarray:
        units = self.vocabulary.units.findall(normalised(text))
        return np.frombuffer(b"".join(map(self.__getitem__, units)), dtype=np.int32)


class ScoredUnits(Remembered):
    """Packed ids of units with their scores, which only matrices need."""

    def __init__(self, vocabulary: Vocabulary):
        matcher = automaton(vocabulary)

        def scored(unit: str) -> tuple[bytes, int]:
            ids, score = segment(vocabulary, matcher, unit)
            return array("i", ids).tobytes(), score

        super().__init__(scored)


def _lists(rows: list[np.ndarray | None]) -> pa.Array:
    sizes = [0 if r is None else len(r) for r in rows]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = np.concatenate([*(r for r in rows if r is not None), np.empty(0, np.int32)])
    mask = pa.array([r is None for r in rows], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()), mask=mask)


class _Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.units: UnitIds | None = None

    def __call__(self, batch: pa.RecordBatch) -> dict[str, pa.Array]:
        if self.units is None:
            self.units = UnitIds(self.vocabulary)
        return {"ids": _lists([None if t is None else self.units.encode(t) for t in texts_of(batch)])}

    def __getstate__(self):
        return {"vocabulary": self.vocabulary, "units": None}


def _decoded(spelled: list[bytes], batch: pa.RecordBatch) -> dict[str, pa.Array]:
    column = batch.column(batch.schema.get_field_index("ids"))
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    known = len(spelled)
    texts: list[str | None] = []
    for i, valid in enumerate(column.is_valid().to_pylist()):
        if not valid:
            texts.append(None)
            continue
        ids = values[offsets[i] : offsets[i + 1]]
        if len(ids) and not 0 <= ids.min() <= ids.max() < known:
            ids = ids[(ids >= 0) & (ids < known)]
        data = b"".join(map(spelled.__getitem__, ids.tolist()))
        texts.append(data.decode("utf-8", "replace").removeprefix(" "))
    return {"decoded": pa.array(texts, pa.string())}


class _RoundTrip(_Encoder):
    """Ids and what they decode to, made in one worker: texts cross to Python once."""

    def __call__(self, batch: pa.RecordBatch) -> dict[str, pa.Array]:
        made = super().__call__(batch)
        return made | _decoded(self.vocabulary.spelled, pa.RecordBatch.from_pydict(made))


def decode(tokens: DataFrame, vocabulary: Vocabulary, drop: tuple[str, ...] = ()) -> DataFrame:
    """``tokens`` plus ``decoded``, the text that its ``ids`` stand for."""
    return annotate(tokens, [_TEXT], functools.partial(_decoded, vocabulary.spelled), drop)


def _split(chunk: int, reach: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of long texts, each with the characters a crossing piece may need, one per batch."""
    for batch in batches:
        for text, row in zip(texts_of(batch), texts_of(batch, "_row"), strict=True):
            whole = normalised(text)
            count = max(1, -(-len(whole) // chunk))
            for i in range(count):
                part = whole[i * chunk : (i + 1) * chunk + reach]
                size = min(chunk, len(whole) - i * chunk)
                arrays = [pa.array([row]), pa.array([i]), pa.array([count]), pa.array([size]), pa.array([part])]
                yield pa.RecordBatch.from_arrays(arrays, names=["row", "chunk", "chunks", "size", "part"])


@dataclass
class Chunk:
    """A chunk as seen by the scan: its matrix, and what the backtrace will need of it.

    Between its first and last cut a chunk has one best way, whose ids are final. ``head`` ends at
    the first cut, ``tail`` begins at the last; without a cut the head is the whole chunk.
    """

    matrix: np.ndarray
    head: str
    head_size: int
    middle: bytes
    tail: str
    tail_size: int  # -1: no cut


def transfer(vocabulary: Vocabulary, units: ScoredUnits, part: str, size: int) -> Chunk:
    """Best scores from each entry to each exit state of a chunk of ``size`` characters."""
    states = vocabulary.longest
    out = np.full((states, states), NEVER, dtype=np.int64)

    def exits(best: list[int], base: int) -> list[int]:
        return [best[base + t] if base + t < len(best) else NEVER for t in range(states)]

    first = next((i for i in range(states - 1, size + 1) if vocabulary.is_cut(part, i)), None)
    if first is None:
        for s in range(states):
            out[s] = exits(forward(vocabulary, part, [NEVER] * s + [0], size)[0], size)
        return Chunk(out, part, size, b"", "", -1)
    last = next(i for i in range(size, first - 1, -1) if i == first or vocabulary.is_cut(part, i))
    found = [units[u] for u in vocabulary.units.findall(part[first:last])]
    middle = sum(score for _, score in found)
    tail = exits(forward(vocabulary, part[last:], [0], size - last)[0], size - last)
    for s in range(states):
        head = forward(vocabulary, part[:first], [NEVER] * s + [0], first)[0][first]
        if head > NEVER:
            out[s] = [NEVER if t == NEVER else head + middle + t for t in tail]
    return Chunk(out, part[:first], first, b"".join(ids for ids, _ in found), part[last:], size - last)


def state_map(vocabulary: Vocabulary, entry: list[int], head: str, head_size: int, tail_size: int) -> bytes:
    """For every exit state of a chunk, the entry state its best way leads back to."""
    _, start = forward(vocabulary, head, entry, head_size)
    back = []
    for state in range(vocabulary.longest):
        at = head_size + (state if tail_size < 0 else 0)
        if at >= len(start) or start[at] == -2:
            back.append(0)
            continue
        while start[at] >= 0:
            at = start[at]
        back.append(at)
    return bytes(back)


def chunk_ids(vocabulary: Vocabulary, entry: list[int], exit_state: int, chunk: Chunk) -> np.ndarray:
    """Ids of the pieces that start in a chunk, given where it is entered and left."""
    _, start = forward(vocabulary, chunk.head, entry, chunk.head_size)
    cut = chunk.tail_size >= 0
    ids, _ = backtrace(vocabulary, chunk.head, start, chunk.head_size + (0 if cut else exit_state))
    parts = [np.array(ids, dtype=np.int32), np.frombuffer(chunk.middle, dtype=np.int32)]
    if cut:
        _, start = forward(vocabulary, chunk.tail, [0], chunk.tail_size)
        ids, _ = backtrace(vocabulary, chunk.tail, start, chunk.tail_size + exit_state)
        parts.append(np.array(ids, dtype=np.int32))
    return np.concatenate(parts)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    out = (a[:, :, None] + b[None]).max(1)
    return np.where(out < NEVER // 2, NEVER, out)


def _vector_times(v: np.ndarray, m: np.ndarray) -> np.ndarray:
    return times(v[None], m)[0]


def _chunk_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    yield from batch.to_pylist()


_CHUNKS = "row long, chunk long, m binary, head string, head_size long, middle binary, tail string, tail_size long"


def _transfers(vocabulary: Vocabulary, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    units = ScoredUnits(vocabulary)
    names = ["row", "chunk", "m", "head", "head_size", "middle", "tail", "tail_size"]
    kinds = [pa.binary(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64()]
    for batch in batches:
        made = [transfer(vocabulary, units, r["part"], r["size"]) for r in _chunk_rows(batch)]
        rows = [(c.matrix.tobytes(), c.head, c.head_size, c.middle, c.tail, c.tail_size) for c in made]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)


def _square(data: bytes, states: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.int64).reshape(states, states)


def _products(states: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [
            functools.reduce(times, [_square(p["m"], states) for p in sorted(r["parts"], key=lambda p: p["chunk"])]).tobytes()
            for r in _chunk_rows(batch)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary())], names=["row", "chunk", "m"])


def _entries(states: int, given: bool, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entry scores of consecutive chunks (or groups) from those of the first."""
    for batch in batches:
        rows, chunks, entries = [], [], []
        for r in _chunk_rows(batch):
            v = np.frombuffer(r["v"], dtype=np.int64) if given else np.array([0] + [NEVER] * (states - 1))
            for part in sorted(r["parts"], key=lambda p: p["chunk"]):
                rows.append(r["row"])
                chunks.append(part["chunk"])
                entries.append(v.tobytes())
                v = _vector_times(v, _square(part["m"], states))
        arrays = [pa.array(rows, pa.int64()), pa.array(chunks, pa.int64()), pa.array(entries, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["row", "chunk", "v"])


def _state_maps(vocabulary: Vocabulary, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = [
            state_map(vocabulary, np.frombuffer(r["v"], dtype=np.int64).tolist(), r["head"], r["head_size"], r["tail_size"])
            for r in _chunk_rows(batch)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.binary())], names=["row", "chunk", "back"])


def _exits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exit state of every chunk: the end of the text has state 0, the maps lead back from there."""
    for batch in batches:
        rows, chunks, exits = [], [], []
        for r in _chunk_rows(batch):
            state = 0
            for part in sorted(r["parts"], key=lambda p: -p["chunk"]):
                rows.append(r["row"])
                chunks.append(part["chunk"])
                exits.append(state)
                state = part["back"][state]
        arrays = [pa.array(rows, pa.int64()), pa.array(chunks, pa.int64()), pa.array(exits, pa.int32())]
        yield pa.RecordBatch.from_arrays(arrays, names=["row", "chunk", "exit"])


def _chunk_ids(vocabulary: Vocabulary, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for r in _chunk_rows(batch):
            chunk = Chunk(np.empty((0, 0)), r["head"], r["head_size"], r["middle"], r["tail"], r["tail_size"])
            made.append(chunk_ids(vocabulary, np.frombuffer(r["v"], dtype=np.int64).tolist(), r["exit"], chunk))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(made)], names=["row", "chunk", "ids"])


def scan(long: DataFrame, vocabulary: Vocabulary, staging: Staging, chunk: int = CHUNK) -> DataFrame:
    """``row`` and ``ids`` of texts given as ``text`` and a unique ``_row``, by the parallel scan.

    A text is one value, so its matrices (2 KB per chunk) fit a task; they are multiplied in groups
    of GROUP chunks first. Chunks are the unit of work and are spread evenly.
    """
    states = vocabulary.longest
    binary = "row long, chunk long, m binary"
    reach = states
    split = long.select("text", "_row").mapInArrow(
        functools.partial(_split, max(chunk, states), reach), "row long, chunk long, chunks long, size long, part string"
    )
    dealt = split.repartition("row", "chunk")
    chunks = staging.keep(dealt.mapInArrow(functools.partial(_transfers, vocabulary), _CHUNKS), "chunks")
    grouped = chunks.groupBy("row", F.expr(f"chunk div {GROUP}").alias("part")).agg(
        F.collect_list(F.struct("chunk", "m")).alias("parts")
    )
    products = grouped.mapInArrow(functools.partial(_products, states), binary)
    texts = products.groupBy("row").agg(F.lit(0).cast("long").alias("part"), F.collect_list(F.struct("chunk", "m")).alias("parts"))
    vectors = "row long, chunk long, v binary"
    starts = texts.mapInArrow(functools.partial(_entries, states, False), vectors).withColumnRenamed("chunk", "part")
    entries = staging.keep(
        grouped.join(starts, ["row", "part"]).mapInArrow(functools.partial(_entries, states, True), vectors), "entries"
    )
    entered = chunks.drop("m").join(entries, ["row", "chunk"])
    ends = entered.select("row", "chunk", "v", "head", "head_size", "tail_size")
    maps = ends.mapInArrow(functools.partial(_state_maps, vocabulary), "row long, chunk long, back binary")
    ways = maps.groupBy("row").agg(F.collect_list(F.struct("chunk", "back")).alias("parts"))
    exits = staging.keep(ways.mapInArrow(_exits, "row long, chunk long, exit int"), "exits")
    made = entered.join(exits, ["row", "chunk"]).mapInArrow(
        functools.partial(_chunk_ids, vocabulary), "row long, chunk long, ids array<int>"
    )
    ordered = F.array_sort(F.collect_list(F.struct("chunk", "ids")))
    return made.groupBy("row").agg(F.flatten(F.transform(ordered, lambda c: c["ids"])).alias("ids"))


def _numbered(kept: list[str], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with numbers that are unique over all tasks."""
    context = TaskContext.get()
    row = (context.partitionId() if context else 0) << 34
    for batch in batches:
        numbers = pa.array(np.arange(row, row + batch.num_rows))
        row += batch.num_rows
        columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
        yield pa.RecordBatch.from_arrays([*columns, numbers], names=[*kept, "_row"])


def encode(
    documents: DataFrame, vocabulary: Vocabulary, staging: Staging, chunk: int = CHUNK, decoded: bool = False
) -> DataFrame:
    """Documents plus ``ids``, and with ``decoded`` the text that they stand for, too.

    Long texts are written once, so that both of their uses agree on rows.
    """
    fields, compute = ([_IDS, _TEXT], _RoundTrip(vocabulary)) if decoded else ([_IDS], _Encoder(vocabulary))
    columns = [c for c in documents.columns if c not in ("_row", *(f.name for f in fields))]
    documents = documents.select(*columns)
    is_long = F.coalesce(F.length("text") >= chunk, F.lit(False))
    short = annotate(documents.filter(~is_long), fields, compute)
    long = documents.filter(is_long)
    schema = T.StructType([*documents.schema.fields, T.StructField("_row", T.LongType())])
    numbered = staging.keep(long.mapInArrow(functools.partial(_numbered, columns), schema), "long-texts")
    if numbered.isEmpty():
        return short
    ids = scan(numbered, vocabulary, staging, chunk).withColumnRenamed("row", "_row")
    joined = numbered.join(ids, "_row").select(*columns, "ids")
    return short.unionByName(decode(joined, vocabulary) if decoded else joined)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    vocabulary = load(VOCABULARY)
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    back = encode(documents, vocabulary, Staging(spark), decoded=True)
    return back.select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).alias("n_tokens"),
        F.xxhash64("ids").alias("ids_hash"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )
