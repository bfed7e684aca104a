"""Tokens, licences, search, near duplicates, decontamination and the pipeline."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tierlake.llm import components, decontaminate, licenses, near_copies, simhash, token_counts, tokens, topk, unigram
from tierlake.llm.common import prepare
from tierlake.sources.staging import Staging

random.seed(5)
LETTERS = ["a", "e", "th", "in", " ", "  ", "\n", "é", "中", "🙂", "x", "!!", "\t", "ß", "the ", "and "]
TEXTS = ["".join(random.choice(LETTERS) for _ in range(random.randint(0, 90))) for _ in range(150)]
LONG = ["".join(random.choice(LETTERS) for _ in range(6000)), "x" * 9000, "thein" * 900 + " end"]


@pytest.fixture(scope="module")
def vocabulary():
    return unigram.load()


@pytest.fixture(scope="module")
def documents(spark):
    prepare(spark)
    rows = list(enumerate(TEXTS + LONG)) + [(900, None), (901, ""), (902, " \n\t"), (3, TEXTS[3]), (None, TEXTS[4])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.withColumns({"ids": F.lit("own"), "n_tokens": F.lit(-1), "_fp": F.lit(0), "_spans": F.lit(0), "_row": F.lit(1)})


@pytest.fixture(scope="module")
def library(vocabulary):
    """The public unigram encoder with this vocabulary's scores."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(unigram.VOCABULARY, "rb") as source:
        model.ParseFromString(source.read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        if piece.piece in vocabulary.pieces and piece.type == 1:
            piece.score = vocabulary.pieces[piece.piece][1]
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def test_encoding_equals_the_library_with_and_without_the_scan(spark, documents, vocabulary, library, staging):
    for chunk in (64, 4000, 1 << 20):
        encoded = tokens.encode(documents.select("doc_id", "text"), vocabulary, staging, chunk)
        rows = tokens.decode(encoded, vocabulary).collect()
        assert len(rows) == documents.count()
        for r in rows:
            assert r.ids == (None if r.text is None else library.encode(r.text))
            assert r.decoded == r.text


def test_encoding_keeps_columns_and_takes_empty_tables(documents, vocabulary, staging):
    encoded = tokens.encode(documents, vocabulary, staging)
    assert set(encoded.columns) == set(documents.columns) - {"_row"}
    assert tokens.encode(documents.limit(0), vocabulary, staging).count() == 0


def test_transfer_matrices_are_associative(vocabulary):
    text = unigram.normalised("thein" * 40 + " and the end" + "x" * 30)
    reach, size = vocabulary.longest, 40
    parts = [(text[i : i + size + reach], min(size, len(text) - i)) for i in range(0, len(text), size)]
    units = tokens.ScoredUnits(vocabulary)
    made = [tokens.transfer(vocabulary, units, p, n).matrix for p, n in parts]
    left = made[0]
    for m in made[1:]:
        left = tokens.times(left, m)
    right = made[-1]
    for m in reversed(made[:-1]):
        right = tokens.times(m, right)
    assert np.array_equal(left, right)
    assert left[0, 0] == unigram.forward(vocabulary, text, [0], len(text))[0][-1]


def test_token_counts_equal_the_library(documents, vocabulary, library):
    rows = token_counts.count_tokens(documents, vocabulary).collect()
    assert len(rows) == documents.count()
    for r in rows:
        ids = library.encode(r.text or "")
        assert r.n_tokens == len(ids)
        assert r.score == (unigram.forward(vocabulary, t := unigram.normalised(r.text), [0], len(t))[0][-1] if r.text else 0)


def test_licences(spark):
    mit = licenses.KNOWN[0][1]
    rows = [
        (1, "Copyright (c) 2021 Some One\n" + mit.replace("sublicense", "sub-license").upper()),
        (2, mit + " and more"),
        (3, "text\n  licensed under the apache licence, version 2.0\nmore"),
        (4, None),
        (5, ""),
        (6, "?!"),
        (None, "Released under the MIT License."),
        (3, "text"),
    ]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit(1)), licenses.known_digests(spark))
    rows = sorted((str(r.doc_id), r.scope, r.line_no, r.license_id) for r in found.collect())
    assert rows == sorted(
        [("1", "text", 0, "MIT"), ("1", "line", 2, "MIT"), ("2", "text", 0, None), ("3", "text", 0, None), ("3", "line", 2, "Apache-2.0"), ("3", "text", 0, None)]
        + [("4", "text", 0, None), ("5", "text", 0, None), ("6", "text", 0, None), ("None", "text", 0, "MIT"), ("None", "line", 1, "MIT")]
    )
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string"), licenses.known_digests(spark)).count() == 0


def brute_top(vectors, k=5):
    exact = {i: [int(np.floor(256 * x)) for x in v] for i, v in vectors.items()}
    for q in sorted(i for i in exact if i % 50 == 0):
        scores = []
        for other, v in exact.items():
            if other != q:
                scores.append((-sum(a * b for a, b in zip(exact[q], v)), other))
        for rank, (score, other) in enumerate(sorted(scores)[:k], 1):
            yield q, rank, other, max(-(1 << 63), min((1 << 63) - 1, -score))


@pytest.mark.parametrize("kind", ["random", "ties", "lengths", "huge", "near"])
def test_top_k_equals_brute_force(spark, staging, kind):
    prepare(spark)
    rng = np.random.default_rng(2)
    vectors = rng.normal(0, 0.3, (420, 8))
    if kind == "ties":
        vectors[:200] = vectors[7]
    if kind == "lengths":
        vectors *= np.exp(rng.normal(0, 2, (420, 1)))
        vectors[60:80] = 0
    if kind == "huge":
        vectors[5] *= 1e14
        vectors[100] *= 1e14
    if kind == "near":
        vectors = vectors[rng.integers(0, 9, 420)] + rng.normal(0, 0.01, (420, 8))
    table = {i: v.tolist() for i, v in enumerate(vectors)}
    rows = list(table.items()) + [(900, None), (950, [1.0, None] + [0.0] * 6), (1000, [float("nan")] * 8), (None, table[1]), (50, table[50])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(0))
    found = topk.top_k(frame, F.col("vec_id") % 50 == 0, staging, slice_rows=64)
    assert sorted(map(tuple, found.collect())) == sorted(brute_top(table))


@pytest.mark.parametrize("kind", ["sparse", "one", "two", "three"])
def test_top_k_of_queries_along_an_axis(kind, monkeypatch):
    """Coordinate pruning keeps the hits of queries that one coordinate dominates."""
    monkeypatch.setattr(topk, "BUCKET_ROWS", 16)
    rng = np.random.default_rng(5)
    width = {"sparse": 12, "one": 1, "two": 2, "three": 3}[kind]
    vectors = rng.normal(0, 1, (300, width))
    if kind == "sparse":
        vectors = np.where(rng.random((300, width)) < 0.85, 0, vectors)
        vectors[np.arange(300), rng.integers(0, width, 300)] += rng.choice([-2, 2], 300)
    whole = np.floor(256 * vectors)
    norms, ids = np.linalg.norm(whole, axis=1), np.arange(300)
    order = np.argsort(norms)
    q = np.concatenate([whole[:60], 256 * np.eye(width)])
    q_id = np.concatenate([ids[:60], 1000 + np.arange(width)])
    found = topk.search_slice(q, np.linalg.norm(q, axis=1), q_id, np.full(len(q), -np.inf), whole[order], norms[order], ids[order], 5)
    expected = []
    for i, row in enumerate(q):
        scores = sorted((-int(s), int(v)) for s, v in zip(whole @ row, ids, strict=True) if v != q_id[i])
        expected += [(i, v, -s) for s, v in scores[:5]]
    assert sorted(zip(*(x.tolist() for x in found), strict=True)) == sorted(expected)


def test_top_k_of_few_or_no_vectors(spark, staging):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0])], "vec_id long, embedding array<float>")
    assert list(map(tuple, topk.top_k(few, F.col("vec_id") == 0, staging).collect())) == [(0, 1, 1, 256 * 768)]
    assert topk.top_k(few.limit(0), F.col("vec_id") == 0, staging).count() == 0


def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(values, radius):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(values)), 2):
        if bin(values[i] ^ values[j]).count("1") <= radius:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(values))]


def test_near_duplicates_equal_brute_force(spark, documents, staging):
    words = [f"w{i}" for i in range(300)]
    rng = random.Random(4)
    bases = [[rng.choice(words) for _ in range(400)] for _ in range(5)]
    texts = []
    for base in bases:
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(400)] = rng.choice(words)
            texts.append(" ".join(copy))
    extra = spark.createDataFrame([(5000 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = documents.select("doc_id", "text").union(extra)
    rows = docs.collect()
    values = [plain_fingerprint(r.text) for r in rows]
    roots = plain_roots(values, 2)
    found = simhash.near_duplicates(docs.withColumn("_label", F.lit(1)), staging).collect()
    ids: dict[int, list[int]] = {}
    for r, root in zip(rows, roots):
        ids.setdefault(root, []).extend([] if r.doc_id is None else [r.doc_id])
    expected = sorted((str(r.doc_id), v, min(ids[root], default=None)) for r, v, root in zip(rows, values, roots))
    assert sorted((str(r.doc_id), r._fp % 2**64, r.component_id) for r in found) == expected
    assert len(set(roots)) < len(set(values)), "the fixture has links"
    kept = simhash.keep_one(docs, staging).collect()
    assert len(kept) == len(set(roots))
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(min(g) for g in ids.values() if g)
    assert simhash.near_duplicates(docs.limit(0), staging).count() == 0


@pytest.mark.parametrize("node_rows", [3, 4096])
def test_links_inside_dense_nodes(spark, staging, node_rows):
    """Clusters around a few centres, so that nodes are large and are factored again."""
    prepare(spark)
    rng = random.Random(8)
    values = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(60):
            value = centre
            for _ in range(rng.randint(0, 5)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    values = sorted(values)
    roots = plain_roots(values, 2)
    frame = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "_fp long")
    labels = components.components(simhash.link(frame, staging, node_rows=node_rows), staging)
    got = {r.node % 2**64: r.label for r in labels.collect()}
    groups: dict[int, set] = {}
    for v, root in zip(values, roots):
        groups.setdefault(root, set()).add(got.get(v, v - 2**64 if v >= 2**63 else v))
    assert all(len(g) == 1 for g in groups.values())
    assert len({min(g) for g in groups.values()}) == len(groups)


def test_components_of_a_long_path(spark, staging):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.label for r in components.components(links, staging).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components.components(links.limit(0), staging).count() == 0


def test_components_move_links_a_few_times(spark, staging, monkeypatch):
    """Links shrink from round to round instead of travelling whole in each."""
    path = random.Random(8).sample(range(1000), 100)
    links = list(itertools.pairwise(path))
    staged, keep = [], Staging.keep
    monkeypatch.setattr(Staging, "keep", lambda self, df, name, codec=None: staged.append((name, keep(self, df, name, codec))) or staged[-1][1])
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a long, b long"), staging).collect()}
    assert got == dict.fromkeys(path, min(path))
    rows = sum(df.count() for _, df in staged)
    assert rows <= 10 * len(links)


def least_edits(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_decontamination_equals_brute_force(spark):
    prepare(spark)
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(150)]
    run = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, run(rng.choice([6, 15, 40]))) for i in range(8)] + [(8, None), (9, "ab"), (None, run(20))]

    def damaged(text, edits):
        letters = list(text)
        for _ in range(edits):
            at = rng.randrange(len(letters))
            letters[at] = rng.choice(["", "q", letters[at] + "z"])
        return "".join(letters)

    rows = []
    for i in range(60):
        text = run(rng.randint(0, 25)) + rng.choice([" ", ", ", "\n"]) + damaged(rng.choice(items[:8])[1].upper(), rng.choice([0, 2, 5, 9, 14]))
        rows.append((i, text + ". " + run(rng.randint(0, 9))))
    rows += [(100, None), (101, ""), (102, run(3000)), (7, rows[7][1]), (None, items[2][1])]
    documents = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit(1))
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("windows", F.lit(1))
    found = decontaminate.matches(documents, benchmark).collect()
    index = decontaminate.WindowIndex.build([x for x in items if x[1] is not None])
    names = [x[0] for x in items if x[1] is not None]
    expected = set()
    for doc_id, text in rows:
        if doc_id == 102:
            continue
        data = decontaminate.normalise(text)
        for window, pattern in enumerate(index.patterns):
            if least_edits(pattern, data) <= index.edits[window]:
                expected.add((doc_id, names[index.items[window]]))
    assert {(r.doc_id, r.item_id) for r in found if r.doc_id != 102} == expected and expected
    texts = dict(rows)
    exact = [r for r in found if r.edits == 0]
    assert exact and all(decontaminate.normalise(texts[r.doc_id][r.start : r.end]) in decontaminate.normalise(texts[r.doc_id]) for r in exact)
    kept = decontaminate.clean(documents, benchmark)
    assert kept.columns == documents.columns
    assert kept.count() == sum(doc_id not in {r.doc_id for r in found} for doc_id, _ in rows)
    assert decontaminate.matches(documents, benchmark.limit(0)).count() == 0
    assert decontaminate.matches(documents.limit(0), benchmark).count() == 0


def test_decontamination_in_blocks(spark, monkeypatch):
    documents = spark.createDataFrame([(1, "one two three four five six seven eight"), (2, "nothing")], "doc_id long, text string")
    benchmark = documents.select((F.col("doc_id") + 10).alias("item_id"), "text").union(documents.select(F.lit(30), F.lit("other words that stand here")))
    whole = decontaminate.matches(documents, benchmark).collect()
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 20)
    assert sorted(decontaminate.matches(documents, benchmark).collect()) == sorted(whole) and whole


def test_pipeline_stages(spark, tmp_path):
    """Each stage's decisions on a small corpus with null texts, copies, repeated rows and extra columns."""
    rng = random.Random(9)
    words = [f"word{chr(97 + i % 26)}{i}" for i in range(400)]
    run = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, run(60) + (" you blockhead numskull" if i % 5 == 0 else " you kind friend"), "en", f"s{i % 3}") for i in range(300)]
    labels = [(i, 1, int(i % 5 == 0)) for i in range(300)]
    leak = run(40)
    rows += [(400, None, "en", None), (401, "", None, None), (402, "123 456", "en", "s"), (403, run(30) + " " + leak, "en", "s")]
    rows += [(404, rows[1][1], "en", "s"), (1, rows[1][1], "en", "s1"), (None, run(50), "en", "s")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    documents = documents.withColumns({"score": F.lit("mine"), "_fp": F.lit("mine"), "_label": F.lit("x"), "_spans": F.lit(1)})
    folder = str(tmp_path)
    documents.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, folder)
        if i < 4:
            assert result.columns == docs.columns and result.dtypes == docs.dtypes
        result.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        seen[name] = sorted((r.doc_id for r in docs.collect()), key=str)
    clean = [i for i in range(300) if i % 5]
    assert set(seen["toxicity"]) == {*clean, 400, 401, 402, 403, 404, None}
    assert set(seen["language"]) == {*clean, 403, 404, None}
    assert sorted(seen["near_copies"], key=str) == sorted([*clean, 403, None], key=str)
    assert sorted(seen["benchmark"], key=str) == sorted([*clean, None], key=str)
    assert seen["tokens"] == seen["benchmark"]
    assert all(r.round_trip and len(r.ids) == r.n_tokens > 0 for r in docs.collect())
    assert corpus_pipeline.run(spark, folder).count() == len(seen["tokens"])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents.limit(0), folder).count() == 0, name


def test_every_excerpt_of_the_smallest_length_is_found(spark):
    """Verbatim excerpts at every offset of an item, from the stated length on, inside other words."""
    prepare(spark)
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
    items = [" ".join(word() for _ in range(60)), " ".join(word() for _ in range(16))]
    rows, owner = [], {}
    for number, item in enumerate(items):
        for size in (decontaminate.SMALLEST_EXCERPT, 100, 128):
            for start in range(len(item) - size + 1):
                owner[len(rows)] = number
                rows.append((len(rows), f"{word()} {word()} {item[start : start + size]} {word()}"))
    first_clean = len(rows)
    rows += [(first_clean + i, " ".join(word() for _ in range(40))) for i in range(100)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(documents, benchmark).collect()}
    assert found == set(owner.items())


@pytest.mark.parametrize(("block_rows", "frequent_from"), [(256, 3), (8, 10**9)])
def test_near_copies_equal_brute_force(spark, staging, monkeypatch, block_rows, frequent_from):
    """Edited copies, chains of copies and a passage common to many texts; blocks and sample do not matter."""
    prepare(spark)
    monkeypatch.setattr(near_copies, "FREQUENT_FROM", frequent_from)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    passage = rng.choices(words, k=30)
    texts = [rng.choices(words, k=rng.choice([3, 5, 40, 150])) + passage * rng.randint(0, 1) for _ in range(60)]
    for i in range(160):
        copy = list(texts[rng.choice([7, 11, rng.randrange(len(texts))])])
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(9)}"
        texts.append(copy[: len(copy) - rng.randint(0, 4)])
    rows = [(500 - i, " ".join(t)) for i, t in enumerate(texts)] + [(900, None), (901, ""), (None, " ".join(texts[0]))]
    sets = []
    for _, text in rows:
        t = (text or "").split()
        sets.append({tuple(t[j : j + 5]) for j in range(max(1, len(t) - 4))} if t else set())
    root = list(range(len(rows)))
    linked = 0
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            linked += sets[i] != sets[j]
            a, b = root[i], root[j]
            root = [a if r == b else r for r in root]
    assert linked > 100
    best: dict[int, int] = {}
    for r, (doc_id, _) in zip(root, rows, strict=True):
        if doc_id is not None:
            best[r] = min(doc_id, best.get(r, doc_id))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("extra", F.lit("x"))
    kept = near_copies.keep_one(docs, staging, block_rows)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(best.values())
    assert near_copies.keep_one(docs.limit(0), staging).count() == 0


def test_cells_of_the_search_are_not_broadcast(spark, staging):
    """However small the query blocks look on disk: their copies, one per slice, must not pass the driver."""
    prepare(spark)
    rows = [(i, [float(i % 7), 1.0]) for i in range(400)]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, staging, slice_rows=64)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert found.count() == 8 * topk.K


def test_pipeline_drops_near_copies(spark):
    """Copies with a few edited words, far more than 2 bits away, go; less similar ones stay."""
    rng = random.Random(6)
    base = [f"word{rng.randrange(900)}" for _ in range(120)]
    near, far = list(base), list(base)
    near[30], near[80] = "changed", "altered"
    for i in range(10, 120, 20):
        far[i] = f"other{i}"
    rows = [(1, base), (2, near), (3, far)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == [1, 3]


def test_near_copies_take_candidates_from_fingerprints(spark, staging, monkeypatch):
    """The stage's prints are op10's over five words, and what their index groups is compared."""
    prepare(spark)
    texts = {1: "a b c d e f g h " * 4, 2: "a b c d e f g h " * 4 + "a", 3: "other words of a text that is like none"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    keyed = {r.doc_id: r for r in near_copies.with_key(docs).collect()}
    for doc_id, text in texts.items():
        assert keyed[doc_id]._fp % 2**64 == simhash.fingerprint(text.encode(), 5)
    prints = spark.createDataFrame([(7, 0b1), (5, 0b111), (9, 0b11100011111), (6, -1)], "key long, _fp long")
    assert [tuple(r) for r in near_copies.alike_prints(prints, staging).collect()] == [(5, 7)]
    monkeypatch.setattr(near_copies, "prefixes", lambda sets: sets.select("key", "key", "size").toDF("shingle", "key", "size").limit(0))
    base = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(base)), (2, " ".join([*base, "end"])), (3, " ".join(f"v{i}" for i in range(90)))]
    close = bin(simhash.fingerprint(rows[0][1].encode(), 5) ^ simhash.fingerprint(rows[1][1].encode(), 5)).count("1")
    assert close <= simhash.RADIUS
    kept = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), staging)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_all_fingerprints_go_through_the_index(spark, staging, monkeypatch):
    """Also those of texts that shingles sort out, and all of the texts that repeat one set differently."""
    prepare(spark)
    words = "a b c d e f g h "
    texts = [" ".join(f"u{i}" for i in range(60)), words * 3, words * 90, " ".join(f"v{i}" for i in range(60)) + " end", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = {simhash.fingerprint((t or "").encode(), 5) for t in texts}
    seen, compared = [], []
    group, possible = near_copies.group, near_copies.possible_sets
    monkeypatch.setattr(near_copies, "group", lambda prints, kept: (seen.extend(r._fp % 2**64 for r in prints.collect()), group(prints, kept))[1])

    def sets_of(*given):
        found = possible(*given)
        compared.extend(r.key for r in found.collect())
        return found

    monkeypatch.setattr(near_copies, "possible_sets", sets_of)
    kept = near_copies.keep_one(docs, staging)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 3, 4]
    assert set(seen) == wanted and compared == []
    # What the index groups is compared, though each text has only shingles of its own.
    monkeypatch.setattr(near_copies, "group", lambda prints, _: prints.select("_fp").distinct().withColumn("_label", F.lit(1)))
    kept = near_copies.keep_one(docs, staging)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 3, 4]
    assert len(compared) == 3


def test_encoding_and_decoding_in_one_worker(documents, vocabulary, staging):
    """Short texts cross to Python once; the rows are those of the two operators in turn."""
    both = tokens.encode(documents, vocabulary, staging, 500, decoded=True)
    apart = tokens.decode(tokens.encode(documents, vocabulary, staging, 500), vocabulary)
    names = ("doc_id", "text", "ids", "decoded")
    assert sorted(map(str, both.select(*names).collect())) == sorted(map(str, apart.select(*names).collect()))
    short = tokens.encode(documents.filter("length(text) < 80"), vocabulary, staging, decoded=True)
    assert short._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_units_with_and_without_spelled_characters(vocabulary):
    matcher = unigram.automaton(vocabulary)
    for text in TEXTS:
        for unit in vocabulary.units.findall(unigram.normalised(text)):
            assert unigram.segment(vocabulary, matcher, unit) == unigram._segment_spelled(vocabulary, matcher, unit)
