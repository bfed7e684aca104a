"""Connected components of a graph given as links, by contraction.

In every round each node follows least neighbours to the end, which is its label, and the links are
drawn anew between labels; those within a label go. What is left shrinks with every round, so that all
rounds together move the links a few times. The rounds' labels are then followed from the last back to
the first. Every round writes to the shared folder, so lineage stays
short and a lost executor costs one round. Links are joined with labels as plain scans or shuffles on
both sides, which lets adaptive execution split a node that has very many links; minima are combined
inside tasks first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierlake.sources.staging import Staging


def _pairs(links: DataFrame, a: Column, b: Column) -> DataFrame:
    return links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()


def components(links: DataFrame, staging: Staging) -> DataFrame:
    """``(node, label)`` for every node of ``links(a, b)``; the label is the component's least node.

    Self-links and repeated links are harmless; no links give no rows.
    """
    pairs = staging.keep(_pairs(links, F.col("a"), F.col("b")), "links")
    rounds: list[DataFrame] = []
    while True:
        # A pair's lesser node counts as its own neighbour: the least node of its surroundings stays.
        reached = pairs.union(pairs.select("b", "b")).toDF("node", "label").groupBy("node").agg(F.min("label").alias("label"))
        labels = staging.keep(reached, "near")
        while True:
            further = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
            moved = staging.keep(labels.join(further, "label"), "moved")
            labels = moved.select("node", F.col("next").alias("label"))
            if moved.filter("next <> label").isEmpty():
                break
        rounds.append(labels)
        of_a, of_b = (labels.select(F.col("node").alias(c), F.col("label").alias(f"_{c}")) for c in ("a", "b"))
        drawn = pairs.filter("a <> b").join(of_a, "a").join(of_b, "b").filter("_a <> _b")
        pairs = staging.keep(_pairs(drawn, F.col("_a"), F.col("_b")), "links")
        if pairs.isEmpty():
            break
    found = rounds.pop()
    for labels in reversed(rounds):
        last = found.select(F.col("node").alias("label"), F.col("label").alias("_last"))
        found = staging.keep(
            labels.join(last, "label", "left").select("node", F.coalesce("_last", "label").alias("label")), "labels"
        )
    return found
