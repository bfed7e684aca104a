"""Phrase collocations: frequent phrases by mergeable Misra-Gries summaries, then exact counts.

A phrase of two to four words can only be frequent if all its parts are, so phrases are found by
length, each length in one pass over the texts:

- Words are counted exactly; this also gives the number of words of every language.
- First pass per length: every task counts the phrases whose parts have survived and deals them, by
  hash, over partitions. A partition's counts are merged into one Misra-Gries summary whose capacity
  exceeds the partition's mass over the threshold, so that no phrase that occurs often enough can be
  lost, in memory that depends on the capacity alone. Partitions are as many as keep it small.
- Last pass: phrases that survive in any summary are counted exactly, by their words. Tasks send their
  counts in blocks, dealt by hash, which are merged block by block.

Survivors travel to the tasks as bitmaps of a fixed size. A chance hit in one costs some work and
changes no result, as what counts in the end is the exact count.

Edge cases: null and empty texts have no words; null languages count as ``und``; texts of any length
are read in segments that overlap by the longest phrase; repeated rows count as often as they occur;
ties are ranked by phrase; an empty table gives no rows. Summaries take two phrases for one if their
64-bit hashes clash, which can only add work: it makes counts larger, never smaller.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tierlake.llm.bitmap import Bitmap
from tierlake.llm.common import bytes_of, prepare, read_table
from tierlake.sources.staging import Staging

LONGEST = 4
LEAST = 30
COVERED_PERCENT = 80
TOP = 2000
SCALE = 2_000_000
UNDETERMINED = "und"
#: Bytes of text handled at once, hashes and phrases held in a task, and counters of a summary.
SEGMENT = 4 << 20
HELD = 1 << 20
SUMS_HELD = 400_000
COUNTERS = 1 << 16
#: Phrases of a part whose exact counts are merged in one task, at most.
MERGED = 1 << 19

_STOP = b","
_MARKS = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
_BREAK = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
_SEED = 42


def words_of(texts: list[bytes]) -> list[bytes]:
    """Lower-case words of texts in order; a comma, which no word holds, stands between pieces."""
    return b"\n".join(texts).lower().translate(_MARKS).replace(b"\n", b" , ").split()


def _long_text(text: bytes, segment: int) -> Iterator[tuple[list[bytes], int]]:
    at, carried = 0, []
    while at < len(text):
        end = len(text)
        if end - at > segment and (found := _BREAK.search(text, at + segment)):
            end = found.start()
        words = carried + words_of([text[at:end]])
        yield words, len(carried)
        carried, at = words[-(LONGEST - 1) :], end


def word_runs(batches: Iterable[pa.RecordBatch], segment: int = SEGMENT) -> Iterator[tuple[bytes, list[bytes], int]]:
    """``(language, words, carried)`` of bounded size; the first ``carried`` words were there before."""
    held: dict[bytes, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(bytes_of(batch, "lang"), bytes_of(batch), strict=True):
            if not text:
                continue
            if len(text) > segment:
                for words, carried in _long_text(text, segment):
                    yield lang, words, carried
                continue
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size > segment:
                for name, texts in held.items():
                    yield name, words_of(texts), 0
                held, size = {}, 0
    for name, texts in held.items():
        yield name, words_of(texts), 0


class Numbered(dict):
    """Numbers words in order of appearance; the stop between pieces is 0."""

    def __init__(self):
        super().__init__({_STOP: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _numbers(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    known = Numbered()
    ids = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
    return ids, list(known)


class Sums:
    """Counts per language and key, summed inside a task as far as memory allows."""

    def __init__(self, key: str, held: int = SUMS_HELD):
        self.key = key
        self.most = held
        self.held: dict[bytes, dict[bytes | None, int]] = {}
        self.size = 0

    def add(self, lang: bytes, keys: list[bytes | None], counts: list[int]) -> Iterator[pa.RecordBatch]:
        own = self.held.setdefault(lang, {})
        before = len(own)
        get = own.get
        for key, n in zip(keys, counts, strict=True):
            own[key] = get(key, 0) + n
        self.size += len(own) - before
        if self.size > self.most:
            yield from self.emit()

    def emit(self, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
        for lang, own in self.held.items():
            keys, counts = list(own), list(own.values())
            for at in range(0, len(keys), rows):
                part = keys[at : at + rows]
                arrays = [pa.array([lang] * len(part), pa.binary()), pa.array(part, pa.binary())]
                arrays.append(pa.array(counts[at : at + rows], pa.int64()))
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", self.key, "n"])
        self.held, self.size = {}, 0


def _count_words(segment: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language and word, and under a null word the number of words."""
    sums = Sums("word")
    for lang, words, carried in word_runs(batches, segment):
        ids, known = _numbers(words)
        counts = np.bincount(ids[carried:], minlength=len(known))[1:]
        at = np.flatnonzero(counts)
        yield from sums.add(lang, [None, *(known[i + 1] for i in at.tolist())], [int(counts.sum()), *counts[at].tolist()])
    yield from sums.emit()


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its first words and that of its last word."""
    h = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_hashes(lang: bytes, known: list[bytes]) -> np.ndarray:
    start = lang + b"\0"
    return np.fromiter((xxhash.xxh64_intdigest(start + w, _SEED) for w in known), dtype=np.uint64, count=len(known))


def phrase_hashes(
    lang: bytes, ids: np.ndarray, known: list[bytes], upto: int, found: dict[int, Bitmap]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, hash, whether all parts are known as frequent)`` at every start, by length.

    Parts are checked as far as ``found`` has a bitmap for their length.
    """
    hashes = _word_hashes(lang, known)
    single = found[1].holds(hashes)
    single[0] = False
    own, alive = hashes[ids], single[ids]
    each = own
    for length in range(2, upto + 1):
        if len(ids) < length:
            return
        alive = alive[:-1] & alive[1:]
        own = _mix(own[:-1], each[length - 1 :])
        yield length, own, alive
        if length in found:
            alive = alive & found[length].holds(own)


def _summarise(
    lengths: tuple[int, ...], found: dict[int, Bitmap], parts: int, segment: int, batches: Iterable[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Per partition its mass, and the counts of its phrases sorted by hash."""

    def emit(hashes: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        keys, at = np.unique(np.concatenate(hashes), return_inverse=True)
        sums = np.bincount(at, np.concatenate(counts), len(keys)).astype("<i8")
        part = ((keys >> np.uint64(3)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        rows = []
        for p in np.flatnonzero(np.diff(edges)).tolist():
            here = order[edges[p] : edges[p + 1]]
            rows.append((p, int(sums[here].sum()), None, None))
            rows.append((p, 0, keys[here].astype("<u8").tobytes(), sums[here].tobytes()))
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 4, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["part", "mass", "hashes", "counts"])

    hashes, counts, size = [], [], 0
    for lang, words, carried in word_runs(batches, segment):
        ids, known = _numbers(words)
        for length, own, alive in phrase_hashes(lang, ids, known, max(lengths), found):
            if length not in lengths:
                continue
            start = max(0, carried - length + 1)
            keys, n = np.unique(own[start:][alive[start:]], return_counts=True)
            hashes.append(keys)
            counts.append(n)
            size += len(keys)
        if size > HELD:
            yield emit(hashes, counts)
            hashes, counts, size = [], [], 0
    if size:
        yield emit(hashes, counts)


class MisraGries:
    """A summary of at most ``capacity`` counters; counters are too low by at most ``lost``."""

    def __init__(self, capacity: int):
        self.capacity = max(1, capacity)
        self.keys = np.empty(0, dtype=np.uint64)
        self.counts = np.empty(0, dtype=np.int64)
        self.lost = 0
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        self._size += len(keys)
        if self._size > 4 * self.capacity:
            self.merge()

    def merge(self) -> MisraGries:
        """Fold what waits into the counters: add equal keys, then take the next-largest off all."""
        parts = [(self.keys, self.counts), *self._waiting]
        self._waiting, self._size = [], 0
        keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        counts = np.zeros(len(keys), dtype=np.int64)
        np.add.at(counts, at, np.concatenate([p[1] for p in parts]))
        if len(keys) > self.capacity:
            least = np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1]
            self.lost += int(least)
            keys, counts = keys[counts > least], counts[counts > least] - least
        self.keys, self.counts = keys, counts
        return self

    def survivors(self, least: int) -> np.ndarray:
        """Keys that may have occurred ``least`` times; all that did, if the capacity sufficed."""
        self.merge()
        return self.keys[self.counts + self.lost >= least]


def _merge_summaries(least: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Survivors of every partition; rows come sorted by partition, masses first."""
    part, mass, summary = None, 0, None

    def ended() -> pa.RecordBatch:
        keys = summary.survivors(least) if summary else np.empty(0, dtype=np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["h"])

    for batch in batches:
        for p, m, hashes, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if p != part:
                if part is not None:
                    yield ended()
                part, mass, summary = p, 0, None
            if hashes is None:
                mass += m
                continue
            if summary is None:
                summary = MisraGries(mass // least + 1)
            summary.add(np.frombuffer(hashes, dtype="<u8"), np.frombuffer(counts, dtype="<i8"))
    if part is not None:
        yield ended()


_BLOCKS = "lang binary, part int, phrases binary, counts binary"


def _blocks(parts: int, sums: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of phrases in blocks: per language and part, the phrases (no phrase holds a line feed) and
    their counts. A phrase has the same part in every task."""
    names, kinds = ["lang", "part", "phrases", "counts"], (pa.binary(), pa.int32(), pa.binary(), pa.binary())
    for batch in sums:
        lang, phrases, counts = batch.column(0)[0].as_py(), batch.column(1).to_pylist(), batch.column(2).to_numpy()
        part = np.fromiter((zlib.crc32(p) % parts for p in phrases), dtype=np.int64, count=len(phrases))
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        rows = []
        for p in np.flatnonzero(np.diff(edges)).tolist():
            here = order[edges[p] : edges[p + 1]]
            rows.append((lang, p, b"\n".join([phrases[i] for i in here.tolist()]), counts[here].astype("<i8").tobytes()))
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _count_phrases(
    found: dict[int, Bitmap], parts: int, segment: int, batches: Iterable[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Exact counts of surviving phrases, by their words, in blocks."""
    sums = Sums("phrase")
    for lang, words, carried in word_runs(batches, segment):
        ids, known = _numbers(words)
        before = ids
        for length, own, alive in phrase_hashes(lang, ids, known, max(found), found):
            at = np.flatnonzero(alive & found[length].holds(own))
            # The number of the first words and that of the last one tell a phrase exactly.
            key = before[at] * len(known) + ids[at + length - 1]
            _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
            before = np.zeros(len(own), dtype=np.int64)
            before[at] = inverse
            counts = np.bincount(inverse[at >= carried - length + 1], minlength=len(first))
            some = np.flatnonzero(counts)
            named = [b" ".join(words[start : start + length]) for start in at[first[some]].tolist()]
            yield from _blocks(parts, sums.add(lang, named, counts[some].tolist()))
    yield from _blocks(parts, sums.emit())


def _merge_blocks(least: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases that occur ``least`` times; rows come sorted by language and part, which no two tasks share."""
    place, sums = None, Sums("phrase")

    def ended() -> Iterator[pa.RecordBatch]:
        for own in sums.held.values():
            for phrase in [p for p, n in own.items() if n < least]:
                del own[phrase]
        yield from sums.emit()

    for batch in batches:
        for lang, part, phrases, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (lang, part) != place:
                yield from ended()
                place = (lang, part)
            own = sums.held.setdefault(lang, {})
            for phrase, n in zip(phrases.split(b"\n"), np.frombuffer(counts, dtype="<i8").tolist(), strict=True):
                own[phrase] = own.get(phrase, 0) + n
    yield from ended()


def frequent(documents: DataFrame, staging: Staging, least: int = LEAST, segment: int = SEGMENT, counters: int = COUNTERS) -> DataFrame:
    """``(lang, phrase, k, f)`` of all phrases of up to four words that occur ``least`` times; staged.

    Rows with a null phrase (and ``k`` 0) hold the number of words of a language.
    """
    texts = documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNDETERMINED)).alias("lang"), F.col("text").cast("string").alias("text")
    )
    raw = texts.mapInArrow(functools.partial(_count_words, segment), "lang binary, word binary, n long")
    summed = raw.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = staging.keep(summed.filter(F.col("word").isNull() | (F.col("n") >= least)), "words")
    named = words.filter(F.col("word").isNotNull())
    found = {1: Bitmap.of(named.select(F.xxhash64(F.concat("lang", F.lit(b"\0"), "word"))))}
    mass = words.filter(F.col("word").isNull()).agg(F.sum("n")).first()[0] or 0
    for lengths in ((2,), tuple(range(3, LONGEST + 1))):
        parts = len(lengths) * mass // (least * counters) + 1
        schema = "part int, mass long, hashes binary, counts binary"
        dealt = texts.mapInArrow(functools.partial(_summarise, lengths, found, parts, segment), schema)
        ordered = dealt.repartition("part").sortWithinPartitions("part", F.col("hashes").isNotNull())
        alive = Bitmap.of(staging.keep(ordered.mapInArrow(functools.partial(_merge_summaries, least), "h long"), "alive"))
        found = found | {length: alive for length in lengths}
    # As many parts as keep the phrases of one, of which each occurs ``least`` times, in memory.
    parts = LONGEST * mass // (least * MERGED) + 1
    blocks = texts.mapInArrow(functools.partial(_count_phrases, found, parts, segment), _BLOCKS)
    place = ("lang", "part")
    counted = blocks.repartition(*place).sortWithinPartitions(*place)
    phrases = counted.mapInArrow(functools.partial(_merge_blocks, least), "lang binary, phrase binary, n long")
    both = words.select("lang", F.col("word").alias("phrase"), "n").union(phrases).withColumnRenamed("n", "f")
    lang, phrase = F.col("lang").cast("string"), F.col("phrase").cast("string")
    k = F.coalesce(F.size(F.split(phrase, " ", -1)), F.lit(0))
    return staging.keep(both.select(lang.alias("lang"), phrase.alias("phrase"), k.alias("k"), "f"), "frequent")


def scored(counts: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(lang, phrase, k, a, l, r, score)``: every phrase by its lowest-scoring cut, the first of equals."""
    parts = counts.filter("k > 0")
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = counts.filter("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), cut)
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', cut)")).withColumn(
        "tail", F.expr("substring_index(phrase, ' ', cut - k)")
    )
    heads = parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    both = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    score = F.expr(f"(cast(a as decimal(20,0)) * {scale}BD) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("m")
    grouped = both.groupBy("lang", "phrase", "k", "a").agg(lowest)
    return grouped.select("lang", "phrase", "k", "a", "m.l", "m.r", F.col("m.score").cast("long").alias("score"))


def uncovered(phrases: DataFrame, percent: int = COVERED_PERCENT) -> DataFrame:
    """Phrases that no longer phrase holds with at least ``percent`` of their occurrences."""
    inside = F.explode(
        F.expr(
            "flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1),"
            " i -> array_join(slice(split(phrase, ' ', -1), i, m), ' '))))"
        )
    )
    longer = phrases.filter("k > 2").select("lang", inside.alias("phrase"), F.col("a").alias("longer"))
    most = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    wide = "cast({} as decimal(20,0)) * {}BD"
    covered = F.expr(f"{wide.format('longer', 100)} >= {wide.format('a', percent)}")
    return phrases.join(most, ["lang", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False))).drop("longer")


def collocations(documents: DataFrame, staging: Staging, least: int = LEAST, top: int = TOP, **sizes: int) -> DataFrame:
    """The ``top`` phrases of every language of ``documents(lang, text)``."""
    counts = frequent(documents, staging, least, **sizes)
    kept = staging.keep(uncovered(scored(counts)), "scored")
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    totals = counts.filter("k = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return collocations(read_table(spark, sf_dir, "documents"), Staging(spark))


ORACLE = f"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t
), w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^ \\x09]+') AS w FROM pieces
), g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
), f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {LEAST}
), n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), cuts AS (
  SELECT lang, k, phrase, f AS a, c, array_to_string(string_split(phrase, ' ')[1:c], ' ') AS head,
    array_to_string(string_split(phrase, ' ')[c + 1:k], ' ') AS tail
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS c FROM f WHERE k > 1)
), s AS MATERIALIZED (
  SELECT x.lang, x.k, x.phrase, x.a, h.f AS l, y.f AS r, CAST((CAST({SCALE} AS HUGEINT) * x.a) // (h.f + y.f) AS BIGINT) AS score
  FROM cuts x JOIN f h ON x.lang = h.lang AND x.head = h.phrase JOIN f y ON x.lang = y.lang AND x.tail = y.phrase
  QUALIFY row_number() OVER (PARTITION BY x.lang, x.phrase ORDER BY score, x.c) = 1
), covered AS (
  SELECT DISTINCT s.lang, s.phrase FROM s JOIN s b ON s.lang = b.lang AND b.k > s.k
    AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * b.a >= {COVERED_PERCENT} * s.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM s JOIN n USING (lang) ANTI JOIN covered USING (lang, phrase)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {TOP}
"""
