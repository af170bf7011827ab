"""Line dedup, near duplicates, fingerprints and decontamination against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gladwire.llm import decontam, imatch, linededup, neardup
from gladwire.llm.common import text_words

# --- line dedup --------------------------------------------------------------


def brute_lines(rows):
    """Texts by (id, text) after dedup, in plain loops."""
    order = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, gone = set(), {}
    for row in order:
        lines = row[1].split("\n")
        full = [i for i, line in enumerate(lines) if line.strip(" \t\r\x0b\f")]
        for at in range(len(full) - 2):
            key = tuple(lines[i].strip(" \t\r\x0b\f") for i in full[at : at + 3])
            if key in seen:
                gone.setdefault(row, set()).update(range(full[at], full[at + 2] + 1))
            seen.add(key)
    return {
        row: "\n".join(x for i, x in enumerate(row[1].split("\n")) if i not in gone.get(row, ())) for row in order
    }


def test_line_dedup_random(spark):
    rng = random.Random(4)
    rows = [(i, "\n".join(rng.choice(["a", "b", " b", "c", "", "d d"]) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    rows += [(None, "a\nb\nc\nq"), (70, None), (71, "")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, _id string, places int")
    got = linededup.dedup_lines(docs).collect()
    want = brute_lines(rows)
    assert len(got) == len(rows)
    by_id = dict(rows)
    for r in got:
        text = by_id[r["doc_id"]]
        assert r["text"] == (None if text is None else want[(r["doc_id"], text)])
        assert r["_id"] == "x" and r["places"] == 1


def test_line_dedup_repeats_and_long(spark):
    text = "one\ntwo\n\nthree\nfour"
    long = "\n".join(f"line {i}" for i in range(30_000))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (3, long), (4, f"new\n{long}\nend")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"], r["removed_lines"]) for r in linededup.dedup_lines(docs).collect())
    assert got == [(1, text, 0), (1, text, 0), (2, "", 5), (3, long, 0), (4, "new\nend", 30_000)]
    assert linededup.dedup_lines(docs.limit(0)).collect() == []


# --- near duplicates ---------------------------------------------------------


def brute_groups(rows, size, percent=80):
    """Set size and component of each id, over all pairs."""

    def shingles(text):
        w = text_words(text)
        return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()

    sets = {i: shingles(t) for i, t in rows}
    above = {i: i for i in sets}

    def find(x):
        while above[x] != x:
            x = above[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                above[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def edited_texts(seed, families, copies, words, edits):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(families):
        base = rng.choices(vocabulary, k=rng.randint(*words))
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, max(1, int(len(own) * edits)))):
                at = rng.randrange(len(own))
                if rng.random() < 0.5:
                    own[at] = rng.choice(vocabulary)
                else:
                    del own[at]
                    own = own or ["w"]
            texts.append(" ".join(own))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(
    "case", [(1, 12, 8, (1, 9), 0.2, 2), (2, 10, 8, (8, 40), 0.06, 2), (3, 3, 40, (150, 260), 0.09, 2), (4, 8, 8, (20, 80), 0.03, 5)]
)
def test_groups_match_all_pairs(spark, case, monkeypatch):
    seed, families, copies, words, edits, size = case
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 16)
    rows = edited_texts(seed, families, copies, words, edits)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), size).collect()
    want = brute_groups(rows, size)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_every_small_set_is_found(spark):
    """Sets of 4 and 5, and one more or less at every place of the order."""
    rng = random.Random(9)
    rows = []
    for n in range(1, 26):
        words = [f"{n}x{i}" for i in range(n + 1)]
        rows += [" ".join(words), " ".join(words[:-1]), " ".join(words[1:]), " ".join([*words, f"{n}more"])]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_groups(rows, 2)


def test_near_defined_cases(spark):
    long = " ".join(f"v{i}" for i in range(40_000))
    rows = [
        (5, "Same words here"), (3, "same WORDS here"), (3, "same WORDS here"), (None, "same words here"),
        (7, None), (8, ""), (9, "  \n"), (None, "only one"), (None, "only one"), (10, long), (11, long + " tail"),
    ]
    docs = spark.createDataFrame([(*r, "k", 0) for r in rows], "doc_id long, text string, kept string, rep int")
    got = neardup.near_duplicates(docs, 2)
    by = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"] or -1, r["kept"]) for r in got.collect())
    assert by == [
        (False, 3, 2, 3, True), (False, 3, 2, 3, True), (False, 5, 2, 3, False), (False, 7, 0, 7, True),
        (False, 8, 0, 8, True), (False, 9, 0, 9, True), (False, 10, 39_999, 10, True), (False, 11, 40_000, 10, False),
        (True, 0, 1, -1, True), (True, 0, 1, -1, True), (True, 0, 2, 3, False),
    ]
    left = neardup.keep_firsts(docs, 2)
    assert left.columns == docs.columns and left.count() == 8
    assert neardup.near_duplicates(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        neardup.near_duplicates(docs, percent=50)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in neardup.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# --- I-Match -----------------------------------------------------------------


def plain_fingerprint(text, lexicon):
    """Subset by subset, in plain loops; the lexicon holds terms."""
    hashed = {w: xxhash.xxh3_64_intdigest(w) for w in set(text_words(text))}
    chosen = {h for w, h in hashed.items() if w in lexicon} or set(hashed.values())
    signed = sorted(h - 2**64 if h >= 2**63 else h for h in chosen)
    parts = []
    for deal in range(imatch.DEALS):
        for subset in range(imatch.SUBSETS):
            own = [h for h in signed if ((h * 0x9E3779B97F4A7C15 % 2**64) >> (48 - 16 * deal)) % imatch.SUBSETS == subset]
            digest = xxhash.xxh3_64_hexdigest(b"".join(h.to_bytes(8, "little", signed=True) for h in own))
            parts.append(digest[: imatch.DIGITS] if own else imatch.NONE)
    return "".join(parts) if signed else ""


def plain_likeness(a, b):
    if not a or not b:
        return float(a == b)
    parts = [(a[i : i + 4], b[i : i + 4]) for i in range(0, len(a), 4)]
    parts = [p for p in parts if p != (imatch.NONE, imatch.NONE)]
    return sum(x == y for x, y in parts) / len(parts)


def test_fingerprints_by_hand(spark):
    rng = random.Random(2)
    vocabulary = [f"t{i}" for i in range(200)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 80))) for _ in range(40)]
    texts += [texts[0], texts[0], None, "", "unheard of words", "é " * 30_001, "文" * 60, "字" * 60]
    texts += [f"{'長' * 40} z{i}" for i in range(3)]
    rows = list(enumerate(texts)) + [(None, "first of all"), (None, "t1 t2"), (None, None), (7, "t3 t4 t5")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, packed string, slice int").repartition(4)
    known = imatch.lexicon(docs)
    counts = {}
    for _, t in rows:
        for w in set(text_words(t)):
            counts[w] = counts.get(w, 0) + 1
    low, high = max(3, len(rows) * imatch.LEAST_SHARE), max(3, len(rows) * imatch.MOST_SHARE)
    lexicon = {w for w, n in counts.items() if low <= n <= high}
    assert known.tolist() == sorted(imatch.term_hashes(b" ".join(lexicon).decode()).tolist()) and any(len(w) > 64 for w in lexicon)
    got = {(r["doc_id"], r["n_chars"], r["edited_sha256"]): r for r in imatch.compare(docs, known, slices=9).collect()}
    assert len(got) == len(rows)
    tie = {r["text"]: r["h"] for r in docs.selectExpr("text", "xxhash64(text) AS h").collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]]))
    for at, (i, text) in enumerate(ordered):
        text, follower = text or "", ordered[(at + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + follower[:half]
        r = got[i, len(text), hashlib.sha256(changed.encode()).hexdigest()]
        own, other, after = (plain_fingerprint(t, lexicon) for t in (text, changed, follower))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (own, other)
        assert (r["near_edited"], r["near_next"]) == (plain_likeness(own, other), plain_likeness(own, after))
    # texts without spaces that have no term in common are not alike
    assert imatch.likeness(plain_fingerprint("文" * 60, lexicon), plain_fingerprint("字" * 60, lexicon)) < 0.1
    assert imatch.compare(docs.limit(0), known[:0], slices=3).collect() == [] and len(imatch.lexicon(docs.limit(0))) == 0


def test_the_band_bounds_the_lexicon(spark, monkeypatch):
    monkeypatch.setattr(imatch, "MAX_TERMS", 10)
    rows = [(i, " ".join(f"w{j}" for j in range(i % 40))) for i in range(80)]
    known = imatch.lexicon(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(known) <= 10


def test_one_id_with_many_texts_is_cut_into_slices(spark):
    rows = [(5, f"a{i} b{i % 7}") for i in range(300)] + [(None, f"n{i}") for i in range(200)] + [(i, "x") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    laid = imatch.with_followers(docs, 10).filter("after = 0").groupBy("slice").count().collect()
    assert len(laid) >= 8 and max(r["count"] for r in laid) < 160
    assert imatch.compare(docs, imatch.lexicon(docs), slices=10).count() == 510


def test_one_document_follows_itself(spark):
    docs = spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")
    r = imatch.compare(docs, np.zeros(0, np.int64)).collect()[0]
    assert r["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest()


# --- decontamination ---------------------------------------------------------


def brute_leaks(docs, items):
    import re
    from collections import Counter

    def words(t):
        return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]

    out = {}
    for i, text in docs:
        w = words(text)
        for item, passage in items:
            v = words(passage)
            if not v or not w:
                continue
            m = len(v)
            for start in range(max(1, len(w) - m + 1)):
                window = w[start : start + m]
                s = min(5, m)
                a = Counter(tuple(window[k : k + s]) for k in range(len(window) - s + 1))
                b = Counter(tuple(v[k : k + s]) for k in range(m - s + 1))
                both = sum((a & b).values())
                similarity = both / (sum(a.values()) + sum(b.values()) - both) if a else 0
                if similarity >= 0.8 and similarity > out.get((i, item), (0, 0))[1]:
                    out[i, item] = (start, similarity)
    return out


def test_leaks_match_all_windows(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(150)]
    draw = lambda k: rng.choices(vocabulary, k=k)
    items = [(i, " ".join(draw(rng.choice([2, 4, 12, 30, 50])))) for i in range(8)] + [(8, None), (9, ""), (10, "a a a a a a a a")]
    docs = []
    for i in range(50):
        passage = items[rng.randrange(8)][1].split()
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            at = rng.choice([0, len(passage) - 1, rng.randrange(len(passage))])
            passage[at] = rng.choice(vocabulary)
        docs.append((i, " ".join([*draw(rng.randint(0, 30)), *passage, *draw(rng.randint(0, 30))]).upper()))
    docs += [(60, None), (61, ""), (62, "a a a a a a a"), (63, "a " * 5000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = decontam.leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute_leaks(docs, items)
    assert {(r["doc_id"], r["item_id"]): (r["start"], round(r["similarity"], 9)) for r in got} == {
        k: (start, round(s, 9)) for k, (start, s) in want.items()
    }


def test_leaks_beyond_the_radius(spark):
    """Windows at exactly 0.8 whose fingerprints are further apart than the radius."""
    import xxhash

    def fingerprint(words):
        values = np.array([xxhash.xxh64(w, seed=42).intdigest() for w in words], dtype=np.uint64)
        return (values[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).sum(axis=0) * 2 > len(words)

    docs, items = [], []
    for i in range(4_000):
        passage = [f"w{i}x{k}" for k in range(40)]
        changed = passage[:36] + [f"v{i}x{k}" for k in range(4)]
        if (fingerprint(passage) != fingerprint(changed)).sum() > decontam.RADIUS:
            items.append((i, " ".join(passage)))
            docs.append((i, " ".join(changed)))
    assert len(docs) >= 10
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontam.leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["start"], r["similarity"]) for r in got} == {(i, i, 0, 0.8) for i, _ in docs}


def test_drop_leaks_defined_cases(spark):
    passage = "The quick brown fox jumps over the lazy dog at noon"
    rows = [(1, f"So: {passage}!"), (1, f"So: {passage}!"), (1, "other text"), (None, passage), (None, "clean"), (2, None)]
    docs = spark.createDataFrame([(*r, 7, "c") for r in rows], "doc_id long, text string, item_id int, start string")
    items = spark.createDataFrame([(1, passage), (1, passage)], "item_id long, text string")
    left = decontam.drop_leaks(docs, items)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in left.collect()) == [(0, "clean"), (1, "other text"), (2, "")]
    assert decontam.drop_leaks(docs, items.limit(0)).count() == 6
    assert decontam.drop_leaks(docs.limit(0), items).count() == 0


def test_fingerprint_counts_bits(spark):
    rng = np.random.default_rng(3)
    hashed = [rng.integers(-(2**63), 2**63 - 1, k).tolist() for k in (1, 2, 35, 400)]
    frame = spark.createDataFrame(list(enumerate(hashed)), "i int, h array<bigint>")
    got = {r["i"]: r["fp"] for r in decontam.fingerprints(frame, ["i"], "h").collect()}
    for i, values in enumerate(hashed):
        bits = sum(1 << k for k in range(64) if sum((v >> k) & 1 for v in values) * 2 > len(values))
        assert got[i] % 2**64 == bits


def test_fingerprint_counts_all_words_of_long_windows(spark):
    rng = np.random.default_rng(4)
    kept = rng.integers(-(2**63), 2**63 - 1, 35_000)
    hashed = [
        np.concatenate([rng.integers(-(2**63), 2**63 - 1, 35_000), kept]),
        np.concatenate([kept, kept, rng.integers(-(2**63), 2**63 - 1, 40_000)]),
    ]
    frame = spark.createDataFrame([(i, h.tolist()) for i, h in enumerate(hashed)], "i int, h array<bigint>")
    got = {r["i"]: r["fp"] for r in decontam.fingerprints(frame, ["i"], "h").collect()}
    for i, values in enumerate(hashed):
        ones = (values.view(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).sum(axis=0)
        bits = sum(1 << k for k in range(64) if ones[k] * 2 > len(values))
        assert got[i] % 2**64 == bits
