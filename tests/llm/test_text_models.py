"""Language identification, toxicity, class-based scoring and resampling."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierlake.llm import brown, language, resample, toxicity
from tierlake.llm.common import in_fold, prepare

EN = "the house and the river are quiet this morning with birds over the water"
DE = "das haus und der fluss sind heute morgen ruhig und die vögel über dem wasser"
FR = "la maison et la rivière sont calmes ce matin avec des oiseaux sur les eaux"


def sentence(base, seed, n=40):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(base.split(), n))


@pytest.fixture(scope="module")
def documents(spark):
    """Three languages, null and odd texts, a repeated row, a null id and columns with clashing names."""
    prepare(spark)
    rows = [(i, sentence((EN, DE, FR)[i % 3], i), ("en", "de", "fr")[i % 3]) for i in range(240)]
    rows += [(1000, None, "en"), (1001, "", "de"), (1002, "12 34 !!", None), (1003, sentence(EN, 5, 9000), "en")]
    rows += [(1004, sentence(FR, 9), None), (1004, sentence(FR, 9), None), (None, sentence(DE, 8), "de")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return frame.withColumns({"score": F.lit("own"), "label": F.lit(1), "windows": F.lit(2), "_rank": F.lit(3)})


def by_id(rows):
    return {r.doc_id: r for r in rows}


def test_language_held_out_accuracy_and_edges(spark, documents, staging):
    net = language.fit(documents, staging)
    found = by_id(language.identify(documents.select("doc_id", "text"), net).collect())
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum(found[i].lang_pred == ("en", "de", "fr")[i % 3] for i in held)
    assert right / len(held) > 0.95
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (1000, 1001, 1002))
    assert found[1003].lang_pred == "en" and found[1004].lang_pred == "fr" and found[None].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_without_labels(spark, documents, staging):
    none = documents.withColumn("lang", F.lit(None).cast("string"))
    assert language.fit(none, staging) is None
    assert {r.lang_pred for r in language.identify(none.select("doc_id", "text"), None).collect()} == {"und"}
    assert language.identify(none.limit(0).select("doc_id", "text"), None).count() == 0


def test_pair_table_equals_plain_convolution():
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 256, (5, language.WINDOW), dtype=np.uint8)
    net = language.train(windows, np.array([0, 1, 0, 1, 0]), ["a", "b"], epochs=1)
    expected = []
    for w in net.filters:
        span = language.WINDOW - w.shape[1] + 1
        total = sum((net.embedding @ w[:, o].T)[windows[:, o : o + span]] for o in range(w.shape[1]))
        expected.append(total.max(1))
    assert np.allclose(language.pooled(windows, net.tables()), np.concatenate(expected, 1), atol=1e-4)


@pytest.fixture(scope="module")
def toxic(spark):
    prepare(spark)
    rows, labels = [], []
    for i in range(900):
        bad = i % 4 == 0
        text = sentence(EN, i, 30) + (" you total blockhead and numskull" if bad else " you kind friend")
        rows.append((i, text))
        labels.append((i, 1 if bad else 0))
    labels += [(0, 0), (None, 1), (5, None)]
    rows += [(2000, None), (2001, ""), (2002, "numskull " * 20000), (3, rows[3][1])]
    documents = spark.createDataFrame(rows, "doc_id long, text string").withColumn("predicted", F.lit("x"))
    return documents, spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("text", F.lit("no"))


def test_toxicity_held_out(spark, toxic, staging):
    documents, labels = toxic
    model = toxicity.fit(documents, labels, staging)
    found = toxicity.score(documents.select("doc_id", "text"), model).collect()
    assert len(found) == documents.count()
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        if r.doc_id < 900 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1:
            assert r.predicted == int(r.doc_id % 4 == 0)
    odd = by_id(found)
    assert odd[2000].score == odd[2001].score and odd[2000].predicted == 0


def test_toxicity_without_both_labels(spark, toxic, staging):
    documents, labels = toxic
    model = toxicity.fit(documents, labels.filter("toxic = 0"), staging)
    assert {r.score for r in toxicity.score(documents, model).select("score").collect()} == {0.0}
    model = toxicity.fit(documents.limit(0), labels.limit(0), staging)
    assert toxicity.score(documents.limit(0), model).count() == 0


def test_hidden_spellings_and_persons():
    lexicon = {b"idiot": 3.0, b"scum": 2.0}
    at = dict(zip(toxicity.FEATURES, toxicity.features("You id1ot! s c u m and idiot", lexicon), strict=True))
    assert at["hits"] == math.log1p(1) and at["hidden_hits"] == math.log1p(2)
    assert at["person_density"] > 0 and at["capitals"] > 0 and at["exclamations"] > 0


def test_isotonic_is_monotone_and_bounded():
    rng = np.random.default_rng(1)
    margin = rng.normal(size=400)
    y = (rng.random(400) < 1 / (1 + np.exp(-2 * margin))).astype(float)
    centres, shares = toxicity.isotonic(margin, y)
    assert (np.diff(centres) >= 0).all() and (np.diff(shares) >= 0).all() and shares[0] >= 0 and shares[-1] <= 1


def test_class_model_base_score_and_gain(spark, documents, staging):
    docs = documents.select("doc_id", "text", "lang")
    training = docs.filter(F.col("doc_id").isNotNull() & ~in_fold("doc_id", 7, 2))
    model, words = brown.fit(training, staging)
    found = brown.score(docs, model, words).collect()
    counts, ends = Counter(), 0
    rows = docs.collect()
    for r in rows:
        if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            counts.update((r.text or "").encode().lower().split())
            ends += 1
    total, kinds = sum(counts.values()) + ends, len(counts) + 1
    assert (model.tokens, model.distinct) == (total, kinds)
    log = lambda c: math.log10((c + 1) / (total + kinds + 1))
    expected = sorted(
        (str(r.doc_id), len(w) + 1, sum(x in counts for x in w) + 1, round(sum(log(counts[x]) for x in w) + log(ends), 6))
        for r in rows
        for w in [(r.text or "").encode().lower().split()]
    )
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found) == expected
    assert sum(r.score for r in found) > sum(r.base_score for r in found)


def test_class_model_is_a_distribution(spark, documents, staging):
    model, _ = brown.fit(documents.select("text"), staging)
    assert np.allclose((10**model.transition).sum(1), 1)


def test_class_model_without_training(spark, documents, staging):
    model, words = brown.fit(documents.limit(0).select("text"), staging)
    found = brown.score(documents.filter("doc_id = 1"), model, words).collect()
    assert found[0].base_score == 0 and found[0].n_known == 0
    assert brown.score(documents.limit(0), model, words).count() == 0


@pytest.mark.parametrize("chunk_bytes", [1, 300, 8 << 20])
def test_every_word_has_a_class_of_its_own(spark, staging, monkeypatch, chunk_bytes):
    """Words of one ending and other company part; scores equal a plain computation with the classes found."""
    monkeypatch.setattr(brown, "OWN_TYPES", 6)
    prepare(spark)
    rng = np.random.default_rng(2)
    texts = [" ".join(f"{a} {rng.choice(['kax', 'kbx', 'kcx'] if a == 'the' else ['max', 'mbx', 'mcx'])}".replace("x", "xing")
             for a in rng.choice(["the", "you"], 30)) for _ in range(60)]
    rows = [*enumerate(texts), (70, None), (71, "the zzz unseen"), (None, texts[0]), (3, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    training = docs.filter("doc_id < 70 OR doc_id = 70")
    monkeypatch.setattr(brown, "PART_WORDS", 500)
    model, words = brown.fit(training, staging, chunk_bytes)
    table = {bytes(r.word): (r["class"], r.c) for r in words.collect()}
    counts = Counter(w for i, t in rows if i is not None and i <= 70 for w in (t or "").encode().split())
    assert {w: c for w, (_, c) in table.items()} == {w: c for w, c in counts.items() if w not in model.own}
    types = brown.TypeOf(model.own)
    of = lambda w: table[w][0] if w in table else model.classes[types[w]]
    if len({w[:1] for w in table}) == 2:
        assert len({of(w) for w in table}) > 1
    end = model.classes[types.end]
    pairs = np.zeros_like(model.transition)
    tokens, distinct = np.zeros(len(pairs)), np.zeros(len(pairs))
    trained = [[of(w) for w in (t or "").encode().split()] for i, t in rows if i is not None and i <= 70]
    for classes in trained:
        np.add.at(pairs, ([end, *classes], [*classes, end]), 1)
        np.add.at(tokens, [*classes, end], 1)
    for w in counts:
        distinct[of(w)] += 1
    distinct[end] += 1
    share = (tokens + 1) / (tokens.sum() + len(tokens))
    assert np.allclose(model.transition, brown._smoothed(pairs, share))
    assert np.allclose(model.emission, np.log10(tokens + distinct + 1))
    expected = []
    for i, t in rows:
        kinds = [of(w) for w in (t or "").encode().split()] + [end]
        weight = sum(math.log10(counts[w] + 1) for w in (t or "").encode().split()) + math.log10(len(trained) + 1)
        steps = (model.transition[[end, *kinds[:-1]], kinds] - model.emission[kinds]).sum()
        expected.append((str(i), round(weight + steps, 6)))
    found = brown.score(docs, model, words, staging, chunk_bytes).collect()
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in found) == sorted(expected)
    marked = docs.withColumn("learn", F.coalesce(F.col("doc_id") <= 70, F.lit(False)))
    same, _, read = brown.learn(marked, staging, chunk_bytes)
    assert np.allclose(same.transition, model.transition) and np.allclose(same.emission, model.emission)
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in brown.scored(read, same).collect()) == sorted(expected)


def test_words_choose_the_class_that_their_neighbours_favour():
    rng = np.random.default_rng(5)
    pairs = rng.integers(20, 400, (5, 5)).astype(float)
    present = np.array([1, 0, 2, 3])
    owner = np.repeat(np.arange(4), 3)
    slot = np.array([[0, 3, 6], [1, 5, 9], [2, 4, 7], [0, 8, 9]]).ravel()
    n = rng.integers(1, 15, 12)
    for word, got in enumerate(brown.choose(pairs, owner, slot, n, present)):
        right, left = np.zeros(5), np.zeros(5)
        for s, k in zip(slot[owner == word], n[owner == word], strict=True):
            (right if s < 5 else left)[s % 5] += k
        gains = []
        for c in range(4):
            mine = lambda x, y: y if c == present[word] else 0
            value = 0.0
            for j in range(5):
                for k, at in ((right[j], pairs[c, j]), (left[j], pairs[j, c])):
                    at = at - mine(at, k)
                    value += float(brown._xlogx(np.array(at + k)) - brown._xlogx(np.array(at)))
            for k, at in ((right.sum(), pairs[c].sum()), (left.sum(), pairs[:, c].sum())):
                at = at - mine(at, k)
                value -= float(brown._xlogx(np.array(at + k)) - brown._xlogx(np.array(at)))
            gains.append(value)
        assert gains[got] == pytest.approx(max(gains))


def test_best_class_equals_full_likelihood():
    rng = np.random.default_rng(3)
    bigrams = rng.integers(0, 6, (9, 9)).astype(float)
    classes = np.array([0, 1, 2, 0, 1, 2, 0, 1, 3])

    def table(c):
        out = np.zeros((4, 4))
        np.add.at(out, (c[:, None], c[None, :]), bigrams)
        return out

    def likelihood(c):
        t = table(c)
        return brown._xlogx(t).sum() - brown._xlogx(t.sum(1)).sum() - brown._xlogx(t.sum(0)).sum()

    for kind in range(8):
        other = np.arange(9) != kind
        right = np.bincount(classes[other], bigrams[kind, other], 4)
        left = np.bincount(classes[other], bigrams[other, kind], 4)
        values = []
        for c in range(3):
            moved = classes.copy()
            moved[kind] = c
            values.append(likelihood(moved))
        got = brown.best_class(table(classes), right, left, bigrams[kind, kind], classes[kind])
        assert values[got] == pytest.approx(max(values))


def test_resampling_matches_brute_force(spark, documents, staging):
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)] + [(None, 1), (7, None)], "doc_id long, quality int")
    ratio = resample.fit(documents, labels)
    raw, target = np.ones(resample.BUCKETS), np.ones(resample.BUCKETS)
    rows = documents.select("doc_id", "text").collect()
    for r in rows:
        words = (r.text or "").encode().lower().split()
        grams = [zlib.crc32(w) % resample.BUCKETS for w in words]
        mix = lambda a, b: (((zlib.crc32(a) * 0x9E3779B97F4A7C15 % 2**64) ^ zlib.crc32(b)) * 0x9E3779B97F4A7C15 % 2**64) >> 32
        grams += [mix(a, b) % resample.BUCKETS for a, b in zip(words, words[1:])]
        np.add.at(raw, grams, 1)
        if r.doc_id is not None and r.doc_id < 240 and r.doc_id % 3 == 0:
            np.add.at(target, grams, 1)
    assert np.allclose(ratio, np.log(target / target.sum()) - np.log(raw / raw.sum()))
    found = resample.resample(documents, ratio, staging).collect()
    assert len(found) == len(rows)
    # Texts without words are never sampled and do not count for the share.
    worded = [r for r in found if r.log_weight is not None]
    assert len(worded) == sum(bool((r.text or "").split()) for r in rows) < len(rows)
    keys = sorted((r.gumbel_key for r in worded), reverse=True)
    least = keys[round(resample.SHARE * len(worded)) - 1]
    assert all(r.selected == (r.gumbel_key >= least) for r in worded)
    assert not any(r.selected for r in found if r.log_weight is None)
    odd = by_id(found)
    assert odd[1000].log_weight is odd[1001].gumbel_key is None and odd[1000].selected is False
    found = worded
    good = np.mean([r.log_weight for r in found if r.doc_id is not None and r.doc_id < 240 and r.doc_id % 3 == 0])
    assert good > np.mean([r.log_weight for r in found if r.doc_id is not None and r.doc_id < 240 and r.doc_id % 3])
    assert resample.resample(documents.limit(0), ratio, staging).count() == 0


def test_kth_largest(spark):
    values = [1.0, 5.0, 5.0, 2.5, -3.0, 5.0000001, 0.0]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert [resample.kth_largest(frame, "v", k) for k in range(1, 8)] == sorted(values, reverse=True)
    assert resample.kth_largest(frame, "v", 0) is None and resample.kth_largest(frame, "v", 8) is None


@pytest.mark.parametrize(
    ("text", "hidden", "mixed", "apart"),
    [
        ("what an a$$hole here", 1, 1, 0),
        ("b00b", 1, 1, 0),
        ("1diot", 1, 1, 0),
        ("you idio7", 1, 1, 0),
        ("id1ot!", 1, 1, 0),
        ("i d i o t", 1, 0, 1),
        ("1 d i o t, really", 1, 0, 1),
        ("an idiot!! and *idiot*", 0, 0, 0),
        ("1984 and 10:30 at gate b4", 0, 1, 0),
        ("ünder! drüben", 0, 0, 0),
        ("", 0, 0, 0),
    ],
)
def test_disguised_words_are_counted_where_they_stand(text, hidden, mixed, apart):
    lexicon = {b"asshole": 2.0, b"boob": 1.0, b"idiot": 3.0}
    found = dict(zip(toxicity.FEATURES, toxicity.features(text, lexicon), strict=True))
    words = len(text.lower().encode().translate(toxicity._SPACED).split()) or 1
    assert math.isclose(found["hidden_hits"], math.log1p(hidden))
    assert math.isclose(found["mixed_rate"] * words, mixed, abs_tol=1e-9)
    assert math.isclose(found["apart_rate"] * words, apart, abs_tol=1e-9)
