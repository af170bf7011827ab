"""Language ID, language model and toxicity: held-out accuracy and brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gladwire.llm import hmm, langid, toxicity
from gladwire.llm.common import fold, text_words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def made(seed: int, count: int, alphabet: str) -> list[str]:
    rng = random.Random(seed)
    words = ["".join(rng.choices(alphabet, k=rng.randint(2, 6))) for _ in range(60)]
    return [" ".join(rng.choices(words, k=rng.randint(20, 60))) for _ in range(count)]


# --- language ID -------------------------------------------------------------


def test_language_held_out(spark):
    texts = [(t, "aa") for t in made(1, 30, "abcdef")] + [(t, "zz") for t in made(2, 30, "uvwxyé")]
    rows = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(texts)], "doc_id long, text string, lang string")
    prototypes = langid.train(rows.filter(fold("doc_id", 3) != 0))
    got = rows.select("lang", langid.predictor(spark, prototypes)("text").alias("p")).collect()
    assert all(r["p"]["lang"] == r["lang"] and 0 < r["p"]["score"] <= 1 for r in got)


def test_bundle_is_the_sum_of_bound_trigrams():
    letters = langid.Letters()
    got = langid.bundle(["Ab, c", "b"], letters)
    vector = lambda c, turn: letters.rotated(np.array([letters.by_letter[c]]), turn)[0].astype(int)
    plain = " ab c "
    want = sum(
        vector(plain[i], 2) * vector(plain[i + 1], 1) * vector(plain[i + 2], 0) for i in range(len(plain) - 2)
    )
    assert (got[0] == want).all()
    assert (got[1] == vector(" ", 2) * vector("b", 1) * vector(" ", 0)).all()


def plain_bundle(text):
    """Trigrams one by one, letters drawn anew each time."""
    letters = [c.lower()[0] if c.isalpha() else " " for c in f" {text} "]
    letters = [c for i, c in enumerate(letters) if c != " " or i == 0 or letters[i - 1] != " "]
    draw = lambda c, turn: np.roll(np.random.default_rng([langid.SEED, ord(c)]).integers(0, 2, langid.DIM) * 2 - 1, turn)
    drawn = [draw(" ", t) if c == " " else draw(c, t) for c in letters for t in (2, 1, 0)]
    return sum((drawn[3 * i] * drawn[3 * i + 4] * drawn[3 * i + 8] for i in range(len(letters) - 2)), np.zeros(langid.DIM))


def test_prototypes_and_cosines_by_hand(spark):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choices("abc é1" if i % 3 else "xyzß -", k=rng.randint(1, 40))), f"l{i % 3}") for i in range(30)]
    rows = [(i, t + "a", g) for i, t, g in rows] + [(30, "12", "l0"), (31, None, "l0"), (32, "abc", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    unit = lambda v: v / np.linalg.norm(v)
    want = {}
    for _, t, g in rows[:30]:
        want[g] = want.get(g, 0) + np.rint(unit(plain_bundle(t)) * langid.GRAIN)
    prototypes = langid.train(frame)
    assert prototypes.keys() == want.keys()
    assert all(np.allclose(prototypes[g], unit(v), atol=1e-5) for g, v in want.items())
    got = frame.select("text", langid.predictor(spark, prototypes)("text").alias("p")).limit(30).collect()
    for r in got:
        near = {g: float(unit(plain_bundle(r.text)) @ unit(v)) for g, v in want.items()}
        assert near[r.p.lang] == pytest.approx(max(near.values()), abs=1e-5) and r.p.score == pytest.approx(max(0, max(near.values())), abs=1e-5)


def test_bundles_of_a_large_alphabet_are_exact_and_small(monkeypatch):
    import tracemalloc

    rng = np.random.default_rng(1)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9000, 400))) for _ in range(1000)]
    letters = langid.Letters()
    tracemalloc.start()
    got = langid.bundle(texts, letters)
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert peak < 500
    for i in (0, 7, 999):
        assert (got[i] == plain_bundle(texts[i])).all()
    # dense and sparse sums are the same
    few = ["".join(rng.choice(list("abcde "), 200)) for _ in range(20)]
    dense = langid.bundle(few, letters)
    monkeypatch.setattr(langid, "KINDS", 3)
    monkeypatch.setattr(langid, "CELLS", 5)
    assert (langid.bundle(few, letters) == dense).all() and (dense[3] == plain_bundle(few[3])).all()


def test_junk_languages_teach_nothing(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    rows = [(i, "some words here", "aa") for i in range(5)] + [(9, "other words", "bb"), (10, "more", "bb"), (11, "junk", "cc")]
    found = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(found) == ["aa", "bb"]


def test_language_defined_cases(spark):
    rows = spark.createDataFrame(
        [(1, "abc abd", "aa"), (1, "abc abd", "aa"), (2, None, "aa"), (3, "", None), (None, "12 !!", "aa"), (4, "abc " * 50_000, None)],
        "doc_id long, text string, lang string",
    )
    predict = langid.predictor(spark, langid.train(rows))
    got = [tuple(r["p"]) for r in rows.select(predict("text").alias("p")).collect()]
    assert [g[0] for g in got] == ["aa", "aa", "und", "und", "und", "aa"]
    assert [g[1] for g in got][2:5] == [0, 0, 0] and got[0] == got[1]
    untrained = langid.predictor(spark, langid.train(rows.limit(0)))
    assert {r["p"]["lang"] for r in rows.select(untrained("text").alias("p")).collect()} == {"und"}
    assert langid.train(rows.limit(0)) == {}


# --- toxicity ----------------------------------------------------------------


def toxic_rows(count: int):
    clean = made(3, count, "abcdefgh")
    return [
        (i, f"{t} vile" if i % 3 == 0 else t, int(i % 3 == 0)) for i, t in enumerate(clean)
    ]


def test_toxicity_held_out(spark):
    rows = toxic_rows(300)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    training = toxicity.training_rows(docs, labels, lambda c: fold(c, 3) != 1)
    assert training.count() == sum(zlib.crc32(str(r[0]).encode()) % 3 != 1 for r in rows)
    score = toxicity.scorer(spark, toxicity.train(training))
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", score("text").alias("s")).collect()}
    assert all((got[i] >= 0.5) == bool(label) for i, _, label in rows)


def test_follow_matches_plain_ftrl():
    rng = np.random.default_rng(0)
    size = 40
    xs = [np.unique(rng.integers(0, size, 6)) for _ in range(60)]
    ys = [int(3 in x) for x in xs]
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    toxicity.follow(z, n, xs, ys)
    zz, nn = [0.0] * (size + 1), [0.0] * (size + 1)
    for x, y in zip(xs, ys, strict=True):
        w = {}
        for i in [*x, size]:
            rate = (toxicity.BETA + math.sqrt(nn[i])) / toxicity.ALPHA + toxicity.L2
            l1 = 0 if i == size else toxicity.L1
            w[i] = 0.0 if abs(zz[i]) <= l1 else (math.copysign(l1, zz[i]) - zz[i]) / rate
        g = (1 / (1 + math.exp(-sum(w.values()))) - y) * (toxicity.TOXIC_WEIGHT if y else 1)
        for i, wi in w.items():
            sigma = (math.sqrt(nn[i] + g * g) - math.sqrt(nn[i])) / toxicity.ALPHA
            zz[i] += g - sigma * wi
            nn[i] += g * g
    assert np.allclose(z, zz) and np.allclose(n, nn)


def test_toxicity_defined_cases(spark):
    docs = spark.createDataFrame(
        [(1, "vile words", "x"), (1, "vile words", "x"), (2, None, None), (None, "", "y"), (3, "good " * 60_000, "y")],
        "doc_id long, text string, label string",
    )
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, 0), (3, 0), (4, None)], "doc_id long, toxic int")
    model = toxicity.train(toxicity.training_rows(docs, labels, lambda c: F.lit(True)))
    got = [r["s"] for r in docs.select(toxicity.scorer(spark, model)("text").alias("s")).collect()]
    assert all(0 <= s <= 1 for s in got) and got[0] == got[1] and got[2] == got[3]
    nothing = toxicity.train(toxicity.training_rows(docs, labels.limit(0), lambda c: F.lit(True)))
    assert [r["s"] for r in docs.select(toxicity.scorer(spark, nothing)("text").alias("s")).collect()] == [0.0] * 5
    assert docs.limit(0).select(toxicity.scorer(spark, model)("text").alias("s")).collect() == []


# --- hidden Markov model -----------------------------------------------------


def test_forward_is_exact_and_training_climbs():
    rng = np.random.default_rng(1)
    shape = (hmm.STATES, 5)
    model = hmm.normalised(hmm.Model(rng.random(hmm.STATES), rng.random((hmm.STATES, hmm.STATES)), rng.random(shape)))
    texts = sorted((rng.integers(0, 5, k) for k in (7, 4, 4, 1)), key=len, reverse=True)
    got = hmm.log10_likelihoods(model, texts)
    for text, value in zip(texts, got, strict=True):
        a = model.start * model.emit[:, text[0]]
        for symbol in text[1:]:
            a = (a @ model.move) * model.emit[:, symbol]
        assert math.isclose(value, math.log10(a.sum()), rel_tol=1e-9)
    last = -math.inf
    for _ in range(5):
        value = hmm.log10_likelihoods(model, texts).sum()
        assert value > last - 0.05
        last = value
        sums = hmm.Model(*(np.zeros_like(x) for x in (model.start, model.move, model.emit)))
        hmm.expected(model, texts, sums)
        assert math.isclose(sums.emit.sum(), sum(map(len, texts)), rel_tol=1e-9)
        assert math.isclose(sums.move.sum(), sum(len(t) - 1 for t in texts), rel_tol=1e-9)
        model = hmm.normalised(sums)


def test_scaling_every_eighth_step_changes_no_count():
    """Against recursions that scale every step, with rare symbols in a row, copies and texts of many lengths."""
    rng = np.random.default_rng(2)
    shape = (hmm.STATES, 6)
    model = hmm.Model(rng.random(hmm.STATES), rng.random((hmm.STATES, hmm.STATES)) ** 9, rng.random(shape))
    model.emit[:, 4:] *= 1e-14
    model = hmm.Model(*(x / x.sum(axis=-1, keepdims=True) for x in (model.start, model.move, model.emit)))
    texts = [np.full(40, 4), *(rng.integers(0, 6, k) for k in (33, 25, 17, 16, 16, 9, 8, 8, 7, 1, 1))]
    times = np.array([1, 3, 2, 1, 0, 1, 1, 5, 1, 2, 1, 4])
    want = hmm.Model(*(np.zeros_like(x) for x in (model.start, model.move, model.emit)))
    logs = []
    for text, copies in zip(texts, times, strict=True):
        alpha, scale = np.empty((len(text), hmm.STATES)), np.empty(len(text))
        for t, symbol in enumerate(text):
            a = (alpha[t - 1] @ model.move if t else model.start) * model.emit[:, symbol]
            scale[t] = a.sum()
            alpha[t] = a / scale[t]
        logs.append(np.log10(scale).sum())
        beta = np.ones(hmm.STATES)
        for t in reversed(range(len(text))):
            want.emit[:, text[t]] += copies * alpha[t] * beta
            emitted = model.emit[:, text[t]] * beta / scale[t]
            if t:
                want.move += copies * np.outer(alpha[t - 1], emitted) * model.move
                beta = model.move @ emitted
            else:
                want.start += copies * alpha[0] * beta
    got = hmm.Model(*(np.zeros_like(x) for x in (model.start, model.move, model.emit)))
    hmm.expected(model, texts, got, times)
    for own, other in ((got.start, want.start), (got.move, want.move), (got.emit, want.emit)):
        assert np.allclose(own, other, rtol=1e-10, atol=1e-200)
    assert np.allclose(hmm.log10_likelihoods(model, texts), logs, rtol=1e-12)
    # The steps in between are left alone: most of the work of a step was its scaling.
    assert list(hmm.forward(model, texts)[1]) == [8, 16, 24, 32]


def test_symbols_of_a_batch_are_those_of_its_texts():
    known = hmm.Vocabulary([b"a", b"b", b"c"], [3, 2, 1], 9, 3, 3)
    known.symbols = 2
    places = [np.array(p, dtype=np.int32) for p in ([0, 2, -1, 1], [], [-1], [], [2**31 - 1, 0])]
    got = hmm.as_symbols([p.tobytes() for p in places], known.rare, known.end)
    assert [g.tolist() for g in got] == [known.as_symbols(p).tolist() for p in places]
    assert hmm.as_symbols([], known.rare, known.end) == []


@pytest.mark.parametrize("known", [3, hmm.KNOWN])
def test_base_score_against_counting(spark, monkeypatch, known):
    monkeypatch.setattr(hmm, "KNOWN", known)
    monkeypatch.setattr(hmm, "SYMBOLS", 2)
    texts = [*made(5, 12, "abc"), None, "", "New\twords THE\x85the \n", "x" * 5000, "x" * 5000]
    rows = [(i if i != 3 else None, t, "k") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(3)
    # A null id is in no fold and does not teach.
    got = hmm.score(docs, fold("doc_id", 7) != 2).collect()
    teaches = [i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for i, _, _ in rows]
    counts = Counter()
    for (_, text, _), yes in zip(rows, teaches, strict=True):
        if yes:
            counts.update([*text_words(text), "end"])
    n, v = sum(counts.values()), len(counts)
    want = {}
    for i, text, _ in rows:
        tokens = [*text_words(text), "end"]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        want[i] = (len(tokens), sum(counts[t] > 0 for t in tokens), n, base)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[r["doc_id"]][:3]
        assert math.isclose(r["base_score"], want[r["doc_id"]][3], rel_tol=1e-9)
        assert r["score"] < 0 and r["key"] == "k"


def test_model_is_a_distribution_over_one_word_texts(spark, monkeypatch):
    """All one-word texts of the vocabulary, and one unknown word, weigh at most 1."""
    monkeypatch.setattr(hmm, "SYMBOLS", 2)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c", "a b", "a d a e"])], "doc_id long, text string")
    more = docs.unionByName(
        spark.createDataFrame([(100 + i, w) for i, w in enumerate(["a", "b", "c", "d", "e", "other"])], docs.schema)
    )
    got = {r["doc_id"]: r["score"] for r in hmm.score(more, F.col("doc_id") < 100).collect()}
    assert 0 < sum(10 ** got[100 + i] for i in range(6)) < 1


def test_every_round_covers_all_training_texts(spark, monkeypatch):
    """More texts than a sample would hold, a third of them equal, against a plain loop."""
    monkeypatch.setattr(hmm, "SYMBOLS", 12)
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdefghijklmnop", k=rng.randint(0, 4))) for _ in range(6_000)] + ["a b a c"] * 3_000
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    counts = Counter(w for t in texts for w in text_words(t))
    most = sorted(counts.items(), key=lambda w: (-w[1], w[0]))
    known = hmm.Vocabulary([w for w, _ in most], [n for _, n in most], sum(counts.values()), len(most), len(texts))
    got = hmm.train(docs, known)
    start = np.random.default_rng(hmm.SEED)
    size, states = known.symbols + 2, hmm.STATES
    want = hmm.normalised(
        hmm.Model(np.ones(states), np.ones((states, states)) + 40 * np.eye(states), start.random((states, size)) + 0.5)
    )
    every = sorted((known.as_symbols(known.places(t)[0]) for t in texts), key=len, reverse=True)
    for _ in range(7):
        sums = hmm.Model(*(np.zeros_like(x) for x in (want.start, want.move, want.emit)))
        hmm.expected(want, every, sums)
        want = hmm.normalised(sums)
    for own, other in ((got.start, want.start), (got.move, want.move), (got.emit, want.emit)):
        assert np.allclose(own, other, rtol=1e-6, atol=1e-12)


def test_texts_are_taken_apart_twice(spark, monkeypatch):
    """Once for the counts of words and once for all that follows, and every null, copy and extra column is scored."""
    docs = spark.createDataFrame([(i, None if i % 9 == 4 else f"a b{i % 7} c", None if i % 5 else "x") for i in range(60)], "doc_id long, text string, `key` string")
    passes, plain = [], hmm.arrow_rows
    monkeypatch.setattr(hmm, "KNOWN", 3)
    monkeypatch.setattr(hmm, "arrow_rows", lambda rows, *more: passes.append(rows.columns) or plain(rows, *more))
    got = hmm.score(docs, F.col("doc_id") % 2 == 0).collect()
    assert len(got) == 60 and len({r["doc_id"] for r in got}) == 60 and {r["key"] for r in got} == {None, "x"}
    assert len({(r["score"], r["base_score"], r["n_known"]) for r in got if r["doc_id"] % 9 == 4}) == 1
    # the counts are made by ``word_counts``
    assert sum("text" in columns for columns in passes) == 1


def test_model_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = hmm.score(docs, F.lit(False)).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got} == {(3, 0, 0, 0.0), (1, 0, 0, 0.0)}
    assert hmm.score(docs.limit(0), F.lit(True)).collect() == []
