"""Quality rules: base limits, then a decision list learned by sequential covering.

Statistics of every whole text come from one pass. On labelled rows a list of rules is learned: each
is a conjunction of thresholds on rates such as symbols per word, grown condition by condition on two
thirds of the rows by information gain, then cut back from its end on the other third as long as that
raises the share of bad texts less that of good ones. A rule is taken while it holds on the pruning
part; the rows it covers are removed before the next one is grown. The list is emitted as one ordered
conditional expression over the statistics, which Spark evaluates on every row.

The labelled sample is bounded and the same bound holds at every size; the statistics and verdicts
cover all documents.

Edge cases: null and empty texts have no words and fail the base; rates over nothing are zero; null
labels and null ids teach nothing; labels that disagree on a document count as bad; without labels of
both kinds the list is empty and keeps what passes the base; repeated rows are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tierlake.llm.common import annotate, bytes_of, prepare, read_table

#: Bound of the labelled sample: rows of each label, the first by hash of the id.
SAMPLE_PER_LABEL = 10_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Rules of a list, conditions of a rule, thresholds tried for a rate.
MAX_RULES = 24
MAX_CONDITIONS = 4
CUTS = 128
#: A rule needs so many bad texts, and so large a share of them, in both parts.
MIN_COVERED = 3
MIN_PRECISION = 0.9

STATISTICS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_chars",
    "n_distinct",
    "n_upper",
    "n_digits",
    "n_marks",
)
_SPACE = bytes([9, 10, 11, 12, 13, 32])
_SYMBOLS = b"#*$%&|<>"
_MARKS = b".,;:!?"
_DIGITS = b"0123456789"
_UPPER = bytes(range(65, 91))
_CONTINUED = bytes(range(128, 192))


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words inside windows of three that occur twice or more; ``ids`` number the words."""
    if len(ids) < 4:
        return 0
    _, pairs = np.unique(ids[:-1] * distinct + ids[1:], return_inverse=True)
    _, window, times = np.unique(pairs[:-1] * distinct + ids[2:], return_inverse=True, return_counts=True)
    often = times[window] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(often)] |= often
    return int(covered.sum())


def statistics(text: bytes | None) -> tuple[int, ...]:
    """The statistics of one whole text, in the order of ``STATISTICS``."""
    if not text:
        return (0,) * len(STATISTICS)
    size = len(text)
    chars = len(text.translate(None, _CONTINUED))
    solid = len(text.translate(None, _SPACE + _CONTINUED))
    words = text.split()
    known = _Numbers()
    ids = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        solid,
        size - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(ids, len(known)),
        len(lines),
        chars,
        len(known),
        size - len(text.translate(None, _UPPER)),
        size - len(text.translate(None, _DIGITS)),
        size - len(text.translate(None, _MARKS)),
    )


def _statistics(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    rows = np.array([statistics(t) for t in bytes_of(batch)], dtype=np.int64).reshape(-1, len(STATISTICS))
    return {name: pa.array(rows[:, i]) for i, name in enumerate(STATISTICS)}


def with_statistics(documents: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Documents plus the statistics of their texts."""
    return annotate(documents, [T.StructField(name, T.LongType()) for name in STATISTICS], _statistics, drop)


def rates() -> dict[str, Column]:
    """What rules may test, as expressions over the statistics."""

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))

    return {
        "mean_word_length": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "duplicate_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "distinct_words": share("n_distinct", "n_words"),
        "capitals": share("n_upper", "n_chars"),
        "digits": share("n_digits", "n_chars"),
        "marks_per_word": share("n_marks", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
    }


def base_failed() -> Column:
    """Too few words, or too many of them repeated; never null."""
    repeated = F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    return (F.col("n_words") < MIN_WORDS) | repeated


@dataclass(frozen=True)
class Condition:
    rate: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = rates()[self.rate]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values > self.threshold if self.above else values <= self.threshold

    def __str__(self) -> str:
        return f"{self.rate} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Ordered rules; the first that holds rejects, none keeps."""

    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def rule_number(self) -> Column:
        """Which rule (from 1) rejects a row; null if none."""
        out = F.lit(None).cast("int")
        for number, rule in reversed(list(enumerate(self.rules, 1))):
            holds = rule[0].column()
            for condition in rule[1:]:
                holds = holds & condition.column()
            out = F.when(holds, F.lit(number)).otherwise(out)
        return out

    def keeps(self) -> Column:
        return self.rule_number().isNull()

    def __str__(self) -> str:
        return "\n".join(f"{i}. reject if " + " and ".join(map(str, rule)) for i, rule in enumerate(self.rules, 1)) or "keep"


def _covered(rule: list[Condition], x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for c in rule:
        out &= c.holds(x[:, names.index(c.rate)])
    return out


def _cuts(values: np.ndarray) -> np.ndarray:
    """Middles between neighbouring values, at most ``CUTS`` of them."""
    seen = np.unique(values)
    middles = (seen[:-1] + seen[1:]) / 2
    if len(middles) > CUTS:
        middles = np.unique(middles[np.linspace(0, len(middles) - 1, CUTS).round().astype(int)])
    return middles


def best_condition(x: np.ndarray, bad: np.ndarray, names: list[str]) -> tuple[float, Condition | None]:
    """The condition of the largest information gain on the rows a rule covers so far."""
    total_p, total_n = int(bad.sum()), int((~bad).sum())
    before = np.log2(total_p / (total_p + total_n))
    best: tuple[float, Condition | None] = (1e-9, None)
    for j, name in enumerate(names):
        cuts = _cuts(x[:, j])
        if not len(cuts):
            continue
        p_low = np.searchsorted(np.sort(x[bad, j]), cuts, side="right")
        n_low = np.searchsorted(np.sort(x[~bad, j]), cuts, side="right")
        for above in (False, True):
            p, n = (total_p - p_low, total_n - n_low) if above else (p_low, n_low)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / np.maximum(p + n, 1)) - before), 0.0)
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = float(gain[at]), Condition(name, above, float(cuts[at]))
    return best


def grow(x: np.ndarray, bad: np.ndarray, names: list[str]) -> list[Condition]:
    rule: list[Condition] = []
    inside = np.ones(len(x), dtype=bool)
    while len(rule) < MAX_CONDITIONS and (inside & ~bad).any():
        _, condition = best_condition(x[inside], bad[inside], names)
        if condition is None:
            break
        rule.append(condition)
        inside &= condition.holds(x[:, names.index(condition.rate)])
    return rule


def prune(rule: list[Condition], x: np.ndarray, bad: np.ndarray, names: list[str]) -> list[Condition]:
    """The shortest beginning of the rule that is worth most on rows it was not grown on."""
    worth = []
    for size in range(1, len(rule) + 1):
        inside = _covered(rule[:size], x, names)
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        worth.append((p - n) / (p + n) if p + n else -1.0)
    return rule[: int(np.argmax(worth)) + 1]


def cover(x: np.ndarray, bad: np.ndarray, grows: np.ndarray, names: list[str]) -> DecisionList:
    """Rules for the bad rows, best first; ``grows`` marks the rows that rules are grown on."""
    learned = DecisionList()
    left = np.ones(len(x), dtype=bool)
    while len(learned.rules) < MAX_RULES and (left & grows & bad).sum() >= MIN_COVERED and (left & grows & ~bad).any():
        rule = grow(x[left & grows], bad[left & grows], names)
        if not rule:
            break
        rule = prune(rule, x[left & ~grows], bad[left & ~grows], names)
        inside = left & _covered(rule, x, names)
        for part in (inside & grows, inside & ~grows):
            p, n = int((part & bad).sum()), int((part & ~bad).sum())
            if p < MIN_COVERED or p < MIN_PRECISION * (p + n):
                return learned
        learned.rules.append(tuple(rule))
        left &= ~inside
    return learned


def learn(documents: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> DecisionList:
    """A list learned from labelled documents that pass the base, at most ``per_label`` of each label."""
    known = (
        labels.select("doc_id", F.col("quality").cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    slot = F.xxhash64(F.lit("rules"), F.col("doc_id"))
    first = [known.filter(F.col("label") == v).orderBy(slot, "doc_id").limit(per_label) for v in (0, 1)]
    # At most two labels times per_label ids of 12 bytes.
    chosen = F.broadcast(first[0].union(first[1]))
    texts = documents.select("doc_id", "text").join(chosen, "doc_id")
    measured = with_statistics(texts, drop=("text",)).filter(~base_failed())
    exprs = rates()
    grows = F.pmod(F.xxhash64(F.lit("grow"), F.col("doc_id")), F.lit(3)) < 2
    # A copied id may bring more rows than ids were drawn; the bound holds for rows, too.
    drawn = measured.select("doc_id", "label", grows.alias("grows"), *[e.alias(n) for n, e in exprs.items()])
    order = [F.xxhash64(F.lit("rules"), F.col("doc_id")), "doc_id", *exprs]
    rows = drawn.orderBy(*order).limit(4 * per_label).toPandas()
    bad = rows["label"].to_numpy(np.int64) == 0
    if not len(rows) or bad.all() or not bad.any():
        return DecisionList()
    return cover(rows[list(exprs)].to_numpy(float), bad, rows["grows"].to_numpy(bool), list(exprs))


def judge(documents: DataFrame, rules: DecisionList, drop: tuple[str, ...] = ()) -> DataFrame:
    """Documents plus statistics, ``base_failed``, the ``rule`` that rejects (null if none) and ``kept``."""
    measured = with_statistics(documents, drop)
    judged = measured.withColumns({"base_failed": base_failed(), "rule": rules.rule_number()})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = learn(documents, read_table(spark, sf_dir, "labels"))
    judged = judge(documents, rules, drop=("text",))
    return judged.select("doc_id", *STATISTICS[:5], "base_failed", "kept")
