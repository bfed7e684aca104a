"""Vector codes, phrase collocations and quality rules against plain computations."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tierlake.llm import codes, phrases, rules
from tierlake.llm.common import prepare

# Vector codes


def plain_codes(rows, parts, entries, rounds):
    """Codes, errors and the digest by trying every entry, in unbounded numbers."""
    kept = []
    for vec_id, vector, label in rows:
        if vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, label, [max(-(1 << 62), min(1 << 62, math.floor(256 * x))) for x in vector]))
    width = max(1, -(-max(len(v) for *_, v in kept) // parts))
    cut = [[(v + [0] * parts * width)[p * width : (p + 1) * width] for p in range(parts)] for *_, v in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0))[:entries]
    books = [[cut[i][p] for i in order] for p in range(parts)]

    def assign():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(x[p], c, strict=True)), e) for e, c in enumerate(books[p])) for p in range(parts)]
            for x in cut
        ]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut[i][p] for i in range(len(cut)) if found[i][p][1] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = assign()
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    out = [
        (v, label, "".join(f"{e:02x}" for _, e in row), min(sum(d for d, _ in row), (1 << 63) - 1))
        for (v, label, _), row in zip(kept, found, strict=True)
    ]
    sums = Counter()
    for _, label, _, error in out:
        sums[label] += error
    return [(*r, min(sums[r[1]], (1 << 63) - 1)) for r in out], hashlib.sha256(text.encode()).hexdigest()


def vectors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return frame.withColumns({"code": F.lit("own"), "error": F.lit(1), "_v": F.lit(2), "_label": F.lit(3)})


def check_codes(spark, staging, rows, parts, entries):
    found = codes.compress(vectors(spark, rows), staging, parts, entries, 2).collect()
    expected, sha = plain_codes(rows, parts, entries, 2)
    key = lambda r: tuple(map(str, r))
    got = [(r.vec_id, r.label, r.code, r.error, r.label_error) for r in found]
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert {r.codebooks_sha256 for r in found} == {sha}


@pytest.mark.parametrize("width", [8, 10, 3])
def test_codes_equal_brute_force(spark, staging, width):
    prepare(spark)
    rng = np.random.default_rng(width)
    rows = [(i, (rng.integers(-40, 40, width) / 128).tolist(), [0, 1, None][i % 3]) for i in range(300)]
    rows += [(900, None, 1), (901, [0.5, None] + [0.0] * (width - 2), 1), (902, [float("nan")] * width, 0)]
    rows += [(903, [float("inf")] * width, 0), (904, [-0.001] * width, None), (905, [0.25], 2), (906, [], 2)]
    rows += [(5, rows[5][1], 1), (5, rows[5][1], 1), (None, [0.125] * width, None)]
    check_codes(spark, staging, rows, 4, 16)


def test_codes_of_huge_components_and_few_vectors(spark, staging):
    rows = [(1, [1e30, -1e18, 3.0, 0.0], 1), (2, [5e15, 1e12, -7.0, 1.0], 1), (3, [5e15, 1e12, -7.5, 1.0], None)]
    check_codes(spark, staging, rows, 2, 64)


def test_codes_of_a_table_without_vectors(spark, staging):
    assert codes.compress(vectors(spark, [(1, None, 1), (2, [None], 1)]), staging).collect() == []


def test_nearest_breaks_ties_to_the_lower_index():
    books = np.array([[[4, 0], [0, 4], [2, 2], [0, 4]]])
    points = np.array([[[0, 4]], [[2, 2]], [[3, 1]], [[9, 9]]])
    at, distance = codes.nearest(points, books)
    assert at[:, 0].tolist() == [1, 2, 0, 0] or at[:, 0].tolist() == [1, 2, 0, 2]
    full = ((points[:, 0, None, :] - books[0][None]) ** 2).sum(2)
    assert at[:, 0].tolist() == full.argmin(1).tolist() and distance[:, 0].tolist() == full.min(1).tolist()


# Phrases


def plain_phrases(rows, least, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, c in counts.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            score, cut = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            inside = any(
                len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in found.items()
            )
            if not inside:
                scored.append((-score, -a, " ".join(p).encode(), c[p[:cut]], c[p[cut:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def spoken(spark):
    prepare(spark)
    rng = random.Random(3)
    common = ["The", "a", "of", "é", "Ünd", "x-y", "中文", "ab", "cd", "#1"]
    rows = []
    for i in range(120):
        words = [rng.choice(common) if rng.random() < 0.7 else f"w{rng.randrange(300)}" for _ in range(rng.randrange(80))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", " ; ", "\x0b", "\xa0"]) for w in words)
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), text))
    rows += [("en", "of the red door " * 900), ("en", None), (None, ""), ("de", ".,;"), ("de", "one two three four"), rows[0]]
    frame = spark.createDataFrame(rows, "lang string, text string")
    return rows, frame.withColumns({"phrase": F.lit("own"), "n": F.lit(1), "k": F.lit(2), "h": F.lit(3)})


@pytest.mark.parametrize(("least", "top", "sizes"), [(3, 2000, {}), (4, 7, {"segment": 70, "counters": 4}), (30, 50, {"segment": 1000})])
def test_phrases_equal_brute_force(spark, staging, spoken, least, top, sizes):
    rows, frame = spoken
    found = phrases.collocations(frame, staging, least, top, **sizes).collect()
    assert sorted(map(tuple, found)) == plain_phrases(rows, least, top)


def test_counts_leave_a_task_in_blocks_and_are_merged_exactly():
    sums = phrases.Sums("phrase")
    counts = {b"one p%d" % i: i % 7 + 1 for i in range(500)}
    rows = []
    for lang in (b"en", b"a\nb"):
        for _ in range(2):
            assert not list(sums.add(lang, list(counts), list(counts.values())))
            rows.append(pa.Table.from_batches(phrases._blocks(3, sums.emit())))
    assert [len(r) for r in rows] == [3] * 4
    ordered = pa.concat_tables(rows).sort_by([("lang", "ascending"), ("part", "ascending")])
    merged = pa.Table.from_batches(phrases._merge_blocks(10, ordered.to_batches(max_chunksize=2))).to_pylist()
    expected = sorted((lang, p, 2 * n) for lang in (b"en", b"a\nb") for p, n in counts.items() if 2 * n >= 10)
    assert sorted((r["lang"], r["phrase"], r["n"]) for r in merged) == expected


def test_phrases_of_an_empty_table(spark, staging, spoken):
    assert phrases.collocations(spoken[1].limit(0), staging).collect() == []


def test_summaries_keep_every_frequent_key():
    """Split over many small summaries in any order, whatever occurs often enough survives."""
    rng = np.random.default_rng(1)
    for least in (5, 30):
        keys = np.concatenate([rng.integers(0, 5000, 20000), np.repeat(np.arange(9000, 9020), least), np.full(3000, 7)])
        rng.shuffle(keys)
        summary = phrases.MisraGries(len(keys) // least + 1)
        for part in np.array_split(keys.astype(np.uint64), 40):
            summary.add(*np.unique(part, return_counts=True))
        alive = set(summary.survivors(least).tolist())
        times = Counter(keys.tolist())
        assert {k for k, n in times.items() if n >= least} <= alive
        assert len(summary.keys) <= summary.capacity and summary.lost < least


def test_capacity_bounds_a_summary_of_distinct_keys():
    summary = phrases.MisraGries(100)
    for start in range(0, 100000, 1000):
        summary.add(np.arange(start, start + 1000, dtype=np.uint64), np.ones(1000, dtype=np.int64))
    assert len(summary.merge().keys) <= 100


# Quality rules

PROSE = "the quiet river runs below the old stone house and children walk along its banks every morning".split()


def good_text(seed, n=120):
    rng = random.Random(seed)
    return " ".join(rng.choice(PROSE) + (rng.choice([".", ","]) if rng.random() < 0.1 else f"{rng.randrange(9)}" * (rng.random() < 0.3)) for _ in range(n))


def bad_text(seed, n=120):
    text = good_text(seed, n)
    return text.replace(" ", "### ") if seed % 2 else text.upper().replace(" ", "!! ")


@pytest.fixture(scope="module")
def labelled(spark):
    prepare(spark)
    rows = [(i, bad_text(i) if i % 4 == 0 or i % 4 == 1 and i % 8 == 1 else good_text(i)) for i in range(600)]
    rows += [(700, None), (701, ""), (702, "two words"), (703, "a b c " * 5000), (None, good_text(9)), (5, good_text(5)), (704, good_text(1, 40000))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.withColumns({"kept": F.lit("own"), "n_words": F.lit(-1), "rule": F.lit(1), "label": F.lit(2)})
    labels = [(i, 0 if i % 4 == 0 or i % 4 == 1 and i % 8 == 1 else 1) for i in range(400)]
    labels += [(3, 1), (7, None), (None, 0), (700, 0), (9999, 1)]
    return frame, spark.createDataFrame(labels, "doc_id long, quality int")


def test_rules_reject_unseen_bad_texts_and_keep_good_ones(labelled):
    documents, labels = labelled
    learned = rules.learn(documents, labels)
    assert learned.rules and len(str(learned).splitlines()) == len(learned.rules)
    found = {r.doc_id: r for r in rules.judge(documents, learned, drop=("text",)).collect()}
    unseen = range(400, 600)
    bad = [i for i in unseen if i % 4 == 0 or i % 8 == 1]
    assert sum(not found[i].kept for i in bad) / len(bad) > 0.95
    assert sum(found[i].kept for i in unseen if i not in bad) / (200 - len(bad)) > 0.95
    assert all(found[i].base_failed and not found[i].kept for i in (700, 701, 702, 703))
    # Forty thousand words out of a few hundred repeat themselves.
    assert found[704].n_words == 40000 and found[704].base_failed and found[704].rule is None and None in found


def test_rules_without_both_labels_or_rows(labelled):
    documents, labels = labelled
    assert rules.learn(documents, labels.filter("quality = 1")).rules == []
    assert rules.learn(documents.limit(0), labels).rules == []
    assert rules.learn(documents, labels.limit(0)).rules == []
    assert rules.judge(documents.limit(0), rules.DecisionList()).count() == 0


def test_expression_equals_the_rules_in_order(spark, labelled):
    """The emitted conditional gives every row the first rule that holds."""
    documents, labels = labelled
    learned = rules.learn(documents, labels)
    names = list(rules.rates())
    rows = rules.judge(documents, learned).select("rule", *[c.alias(n) for n, c in rules.rates().items()]).collect()
    for r in rows:
        x = np.array([[r[n] for n in names]])
        first = next((i for i, rule in enumerate(learned.rules, 1) if rules._covered(list(rule), x, names)[0]), None)
        assert r["rule"] == first


def plain_statistics(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def test_statistics_equal_a_plain_count():
    rng = random.Random(8)
    texts = ["".join(rng.choice(["a", "b", "é", "中", "🙂", " ", " ", "\n", "\t", "#", "|", "\x1f", "\xa0", " "]) for _ in range(n)) for n in (0, 1, 5, 30, 200, 900)]
    texts += ["a a a", "a a a a", "x y z x y z", "é\né\n é\n\n", " ", "\r\n \r\n"]
    for text in texts:
        assert rules.statistics(text.encode())[:5] == plain_statistics(text)
    assert rules.statistics(None) == (0,) * len(rules.STATISTICS)


def test_best_condition_is_the_best_of_all():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 6, (60, 3)) / 4
    bad = (x[:, 1] > 0.6) & (x[:, 2] < 1) | (rng.random(60) < 0.1)
    names = ["a", "b", "c"]
    gain, found = rules.best_condition(x, bad, names)
    p0 = bad.sum() / len(bad)
    best = 0.0
    for j, name in enumerate(names):
        for cut in np.unique(x[:, j]):
            for above in (False, True):
                inside = x[:, j] > cut if above else x[:, j] <= cut
                p = (inside & bad).sum()
                if p:
                    best = max(best, p * (math.log2(p / inside.sum()) - math.log2(p0)))
    assert math.isclose(gain, best) and found.rate in names
