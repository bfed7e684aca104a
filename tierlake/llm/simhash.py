"""SimHash near-duplicate groups through a Gray-order hierarchical index.

Fingerprints within ``radius`` bits of each other agree on all but ``radius`` of ``radius + 2``
blocks of bits. The upper index nodes are those masked bit patterns: each distinct fingerprint goes
to the nodes (mask, pattern) it carries, and nodes are spread over the cluster. A node holding very
many fingerprints is factored again by the bits its mask leaves open, after which it has at most
65,536 members by construction. Inside a node fingerprints are sorted by Gray rank and grouped into a
tree whose nodes carry the bits all members share; pairs of groups whose shared bits already
differ in too many places are pruned together. Only a spanning forest of the links leaves a node, so
a group of n near copies costs n rows, never n squared; no link between components is lost.

Edge cases: null and wordless texts have fingerprint zero and are linked like any other; null ids
belong to their group and never name it (a group of null ids only has a null id); repeated rows are
returned as often as they occur.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

from tierlake.llm.common import annotate, bytes_of, prepare, read_table
from tierlake.llm.components import components
from tierlake.sources.staging import Staging

BITS = 64
SHINGLE = 3
RADIUS = 2
SEED = 42
#: Nodes with more fingerprints than this are factored once more.
NODE_ROWS = 4096
LEAF = 16
FAN = 8
_PAIRS = 1 << 15


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """XXH64 of every run of ``width`` words, repeats included; fewer words give one hash."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, SEED)], dtype=np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    count = len(words) - width + 1
    spans = zip(starts[:count].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype=np.uint64, count=count)


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """Bit i is set when it is set in over half of the shingles' hashes; unsigned."""
    return fingerprint_of(shingle_hashes(text, width))


def fingerprint_of(hashes: np.ndarray) -> int:
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 15):
        part = hashes[start : start + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprints(width: int, batch: pa.RecordBatch) -> dict[str, pa.Array]:
    values = np.array([fingerprint(text, width) for text in bytes_of(batch)], dtype=np.uint64)
    return {"_fp": pa.array(values.view(np.int64))}


def with_fingerprint(documents: DataFrame, width: int = SHINGLE, drop: tuple[str, ...] = ()) -> DataFrame:
    """Documents plus ``_fp``, the fingerprint as a signed 64-bit number."""
    return annotate(documents, [T.StructField("_fp", T.LongType())], functools.partial(_fingerprints, width), drop)


def _block_masks(bits: list[int], blocks: int, agree: int) -> list[int]:
    """Masks over ``bits`` (positions) of every choice of ``agree`` out of ``blocks`` blocks."""
    edges = [round(i * len(bits) / blocks) for i in range(blocks + 1)]
    parts = [sum(1 << b for b in bits[edges[i] : edges[i + 1]]) for i in range(blocks)]
    return [sum(choice) for choice in itertools.combinations(parts, agree)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def node_masks(radius: int) -> list[int]:
    return _block_masks(list(range(BITS)), radius + 2, 2)


def inner_masks(mask: int, radius: int) -> list[int]:
    """Masks that factor a node again: its own bits and two blocks of the bits left open."""
    rest = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | inner for inner in _block_masks(rest, radius + 2, 2)]


def _nodes(masks: list[int]) -> Column:
    """One (mask number, pattern) per mask."""
    return F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("mask"), F.col("_fp").bitwiseAND(F.lit(_signed(m))).alias("pattern"))
                for i, m in enumerate(masks)
            ]
        )
    )


def _gray_rank(value: Column) -> Column:
    """Rank of a fingerprint in the reflected Gray sequence: the prefix parity of its bits."""
    for shift in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, shift))
    return value


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of linked positions; roots stay the least position of their set."""
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up


def _levels(values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level, leaves first: the bits all members of a group share, and where they agree."""
    shared, agree = values.copy(), np.full(len(values), ~np.uint64(0))
    levels = []
    size = LEAF
    while True:
        starts = np.arange(0, len(shared), size)
        ones = np.bitwise_or.reduceat(shared & agree, starts)
        zeros = np.bitwise_or.reduceat(~shared & agree, starts)
        agree = np.bitwise_and.reduceat(agree, starts) & ~(ones & zeros)
        shared = ones & agree
        levels.append((shared, agree))
        if len(shared) == 1:
            return levels
        size = FAN


def link_node(values: np.ndarray, radius: int) -> np.ndarray:
    """Root position of every fingerprint of one node, given in Gray order and without repeats.

    Top down, a pair of groups is dropped when the bits both groups fix differ in more than
    ``radius`` places; pairs of leaves that survive are compared member by member.
    """
    root = np.arange(len(values))
    levels = _levels(values)
    frontier = [(len(levels) - 1, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while frontier:
        level, a, b = frontier.pop()
        if len(a) > _PAIRS:
            frontier.append((level, a[_PAIRS:], b[_PAIRS:]))
            a, b = a[:_PAIRS], b[:_PAIRS]
        shared, agree = levels[level]
        near = np.bitwise_count((shared[a] ^ shared[b]) & agree[a] & agree[b]) <= radius
        a, b = a[near], b[near]
        if not len(a):
            continue
        if level:
            width = len(levels[level - 1][0])
            grid = np.arange(FAN)
            left = (a[:, None, None] * FAN + grid[None, :, None]).repeat(FAN, 2).ravel()
            right = (b[:, None, None] * FAN + grid[None, None, :]).repeat(FAN, 1).ravel()
            good = (left < width) & (right < width) & (left <= right)
            frontier.append((level - 1, left[good], right[good]))
            continue
        for start in range(0, len(a), 1024):
            left = a[start : start + 1024, None] * LEAF + np.arange(LEAF)
            right = b[start : start + 1024, None] * LEAF + np.arange(LEAF)
            x = np.minimum(left, len(values) - 1)
            y = np.minimum(right, len(values) - 1)
            close = np.bitwise_count(values[x][:, :, None] ^ values[y][:, None, :]) <= radius
            pair, i, j = np.nonzero(close)
            _unite(root, x[pair, i], y[pair, j])
    return root


def _forest(radius: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of every node; rows come sorted by node and Gray rank."""

    def flush(node: np.ndarray, pattern: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        change = np.flatnonzero((node[1:] != node[:-1]) | (pattern[1:] != pattern[:-1])) + 1
        starts = np.concatenate([[0], change])
        ends = np.concatenate([change, [len(node)]])
        root = np.arange(len(node))
        size = ends - starts
        pairs = starts[size == 2]
        near = np.bitwise_count(prints[pairs] ^ prints[pairs + 1]) <= radius
        root[pairs[near] + 1] = pairs[near]
        for i in np.flatnonzero(size > 2):
            root[starts[i] : ends[i]] = starts[i] + link_node(prints[starts[i] : ends[i]], radius)
        linked = np.flatnonzero(root != np.arange(len(root)))
        links = [prints[linked].view(np.int64), prints[root[linked]].view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in links], names=["a", "b"])

    held: list[tuple[np.ndarray, ...]] = []
    rows = 0
    for batch in batches:
        node, pattern, prints = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        held.append((node, pattern, prints.view(np.uint64)))
        rows += len(node)
        if rows < 1 << 16:
            continue
        node, pattern, prints = (np.concatenate(x) for x in zip(*held, strict=True))
        last = np.flatnonzero((node != node[-1]) | (pattern != pattern[-1]))
        cut = last[-1] + 1 if len(last) else 0
        if cut:
            yield flush(node[:cut], pattern[:cut], prints[:cut])
        held = [(node[cut:], pattern[cut:], prints[cut:])]
        rows = len(node) - cut
    if rows:
        yield flush(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _links(routed: DataFrame, radius: int) -> DataFrame:
    """Links inside nodes: rows of a node meet in one task, in Gray order."""
    ordered = routed.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern", _gray_rank(F.col("_fp")))
    return ordered.select("mask", "pattern", "_fp").mapInArrow(functools.partial(_forest, radius), "a long, b long")


def link(prints: DataFrame, staging: Staging, radius: int = RADIUS, node_rows: int = NODE_ROWS) -> DataFrame:
    """Spanning links ``(a, b)`` between distinct fingerprints at most ``radius`` bits apart."""
    masks = node_masks(radius)
    routed = prints.select("_fp", _nodes(masks).alias("_n")).select("_fp", "_n.mask", "_n.pattern")
    sizes = routed.groupBy("mask", "pattern").count()
    large = staging.keep(sizes.filter(F.col("count") > node_rows).select("mask", "pattern"), "large-nodes")
    if large.isEmpty():
        return staging.keep(_links(routed, radius), "forest")
    plain = routed.join(large, ["mask", "pattern"], "left_anti")
    dense = routed.join(large, ["mask", "pattern"], "left_semi")
    again = [
        dense.filter(F.col("mask") == i)
        .select("_fp", _nodes(inner_masks(m, radius)).alias("_n"))
        .select("_fp", (F.col("_n.mask") + (i + 1) * 1000).alias("mask"), "_n.pattern")
        for i, m in enumerate(masks)
    ]
    return staging.keep(_links(functools.reduce(DataFrame.unionByName, [plain, *again]), radius), "forest")


def group(prints: DataFrame, staging: Staging, radius: int = RADIUS) -> DataFrame:
    """``(_fp, _label)``: each distinct fingerprint's component, named by its least fingerprint."""
    distinct = staging.keep(prints.select("_fp").distinct(), "distinct-prints")
    labels = components(link(distinct, staging, radius), staging)
    return distinct.join(labels, distinct._fp == labels.node, "left").select(
        "_fp", F.coalesce("label", "_fp").alias("_label")
    )


def near_duplicates(documents: DataFrame, staging: Staging, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``_fp`` and ``component_id``, the least id reachable by links."""
    prints = staging.keep(with_fingerprint(documents.select("doc_id", "text"), width, ("text",)), "prints")
    labels = staging.keep(group(prints, staging, radius), "print-labels")
    least = prints.groupBy("_fp").agg(F.min("doc_id").alias("_least"))
    named = least.join(labels, "_fp").groupBy("_label").agg(F.min("_least").alias("component_id"))
    answer = staging.keep(labels.join(named, "_label").select("_fp", "component_id"), "print-components")
    return prints.join(answer, "_fp").select("doc_id", "_fp", "component_id")


def keep_one(documents: DataFrame, staging: Staging, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each group, the one with the least id (then text), with all its columns."""
    columns = [c for c in documents.columns if c not in ("_fp", "_label", "_rank")]
    marked = with_fingerprint(documents.select(*columns), width)
    prints = marked.select("_fp").distinct()
    labels = staging.keep(group(staging.keep(prints, "prints"), staging, radius), "print-labels")
    first = Window.partitionBy("_label").orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    kept = marked.join(labels, "_fp").withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") == 1)
    return kept.select(*columns)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = near_duplicates(read_table(spark, sf_dir, "documents"), Staging(spark))
    return found.select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")
