"""Hidden Markov language model over words.

States are latent; each emits symbols. A frequent word is a symbol of its
own, the end of a text is one, and all other words share one symbol, within
which a word has its add-one unigram share. So the model gives every text,
unknown words included, a probability: the scaled forward recursion over its
symbols times the shares of its rare words.

Baum-Welch: every task computes expected counts of its texts with the scaled
forward and backward recursions, and the counts are summed over the
partitions. Every round covers all training texts, and texts that a batch holds several times are
counted by their number of copies. Texts are taken apart twice, for the counts of words and for their
places in the vocabulary; the places are written once and read by each round and by the scoring.

Counts of the most frequent words are broadcast, at most ``KNOWN``; the other
words of each text are looked up by a join. Equal texts ask once per task.

Defined cases: a null text is empty, and an empty text is its end alone;
repeated rows are scored alike and count as often as they occur in training;
words of any length are words, but one longer than ``LONGEST`` bytes is never
in the broadcast part; without training rows N and V are 0 and every word is
unknown. Texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gladwire.llm.common import arrow_rows, most_frequent, text_words, word_counts, written

STATES = 8
SYMBOLS = 16_384
KNOWN = 150_000
LONGEST = 64
# Rounds, each over all training texts.
ROUNDS = 7
SEED = 7
# Tokens that one recursion holds at a time (one text may be longer).
BLOCK = 400_000
# Tokens whose counts are added up at a time, so that they stay in a processor's cache.
COUNTED = 32_768
# Steps between two scalings. Symbols and moves have about ``PRIOR`` / tokens as probability at least, so the
# nine steps up to the first scaling stay above 1e-252 if a trillion tokens teach.
SCALED = 8
# Added to the expected counts: nothing gets probability 0.
PRIOR = 0.01


@dataclass
class Model:
    """``start[s]``, ``move[s, t]``, ``emit[s, symbol]``; the last symbols are rare and end."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def sequences(lengths: np.ndarray) -> list[np.ndarray]:
    """Places of the texts, longest first, in blocks of bounded tokens."""
    order = np.argsort(-lengths, kind="stable")
    if not len(order):
        return []
    edges = np.cumsum(lengths[order]) // BLOCK
    return np.split(order, np.flatnonzero(np.diff(edges)) + 1)


def _laid(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols by step, all texts of a step together, how many texts each step has, and offsets.

    ``texts`` come longest first, so those still running are always the first ones; each holds one symbol at least.
    """
    lengths = np.array([len(t) for t in texts])
    running = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    offsets = np.concatenate([[0], np.cumsum(running)])
    flat = np.empty(offsets[-1], dtype=np.int64)
    for place, text in enumerate(texts):
        flat[offsets[: len(text)] + place] = text
    return flat, running, offsets


def forward(model: Model, texts: list[np.ndarray]):
    """Forward values, scales by step of the steps that were scaled, what each text has at its end, and the layout.

    Only every ``SCALED``th step is scaled to sum 1; those between shrink by what their symbols have for probability.
    """
    flat, running, offsets = _laid(texts)
    emit, alpha = np.ascontiguousarray(model.emit.T), np.empty((len(flat), len(model.start)))
    alpha[: running[0]] = emit[flat[: running[0]]] * model.start
    moved, scales, ones = np.empty((running[0], alpha.shape[1])), {}, np.ones(alpha.shape[1])
    for t in range(1, len(running)):
        a, step = alpha[offsets[t] : offsets[t + 1]], moved[: running[t]]
        np.take(emit, flat[offsets[t] : offsets[t + 1]], axis=0, out=a, mode="clip")
        np.dot(alpha[offsets[t - 1] : offsets[t - 1] + running[t]], model.move, out=step)
        a *= step
        if t % SCALED == 0:
            scales[t] = a @ ones
            a /= scales[t][:, None]
    last = offsets[np.array([len(t) for t in texts]) - 1] + np.arange(len(texts))
    return alpha, scales, alpha[last] @ ones, last, flat, running, offsets


def log10_likelihoods(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Exact log10 probability of each symbol sequence."""
    _, scales, ends, *_ = forward(model, texts)
    out = np.log10(ends)
    for scale in scales.values():
        out[: len(scale)] += np.log10(scale)
    return out


def expected(model: Model, texts: list[np.ndarray], into: Model, times: np.ndarray | None = None) -> None:
    """Add the expected counts of the texts, each ``times`` its own, to ``into``."""
    alpha, scales, ends, last, flat, running, offsets = forward(model, texts)
    # The counts are linear in the backward values, so the probability of a text and its copies enter at its end.
    weights = ((1.0 if times is None else times) / ends)[:, None]
    alpha[last] *= weights
    emit, back, pairs = np.ascontiguousarray(model.emit.T), np.ascontiguousarray(model.move.T), np.zeros_like(model.move)
    own, emitted, going = np.empty((running[0], alpha.shape[1])), np.empty((running[0], alpha.shape[1])), 0
    for t in reversed(range(len(running))):
        lo, hi, now = offsets[t], offsets[t + 1], running[t]
        if going:
            # ``emitted`` is that of the next step; the counts of this one take the place of its forward values.
            np.dot(emitted[:going], back, out=own[:going])
            alpha[lo : lo + going] *= own[:going]
        if now > going:
            own[going:now] = weights[going:now]
        if t:
            beta = emitted[:now]
            np.take(emit, flat[lo:hi], axis=0, out=beta, mode="clip")
            beta *= own[:now]
            if t in scales:
                beta /= scales[t][:, None]
            pairs += np.dot(alpha[offsets[t - 1] : offsets[t - 1] + now].T, beta)
        going = now
    into.move += pairs * model.move
    into.start += alpha[: running[0]].sum(axis=0)
    for lo in range(0, len(flat), COUNTED):
        symbols, counts = flat[lo : lo + COUNTED], np.ascontiguousarray(alpha[lo : lo + COUNTED].T)
        for s, weights in enumerate(counts):
            into.emit[s] += np.bincount(symbols, weights=weights, minlength=into.emit.shape[1])


def normalised(counts: Model) -> Model:
    def rows(x):
        x = x + PRIOR
        return x / x.sum(axis=-1, keepdims=True)

    return Model(rows(counts.start), rows(counts.move), rows(counts.emit))


class Vocabulary:
    """Broadcast part of the counts: words by falling count, and the totals."""

    def __init__(self, words: list[bytes], counts: list[int], n: int, v: int, ends: int):
        self.place = {w: i for i, w in enumerate(words)}
        self.counts, self.n, self.v, self.ends = counts, n, v, ends
        self.symbols = min(SYMBOLS, len(words))
        own = sum(c + 1 for c in counts[: self.symbols]) + ends + 1
        # What all words without a symbol weigh together, unknown ones (1) included.
        self.rare_weight = max(n + v + 1 - own, 1)
        # log10(c + 1) by place, and its sum needs N + V + 1 once per token.
        self.logs = np.array([math.log10(c + 1) for c in counts])
        self.log_all, self.log_rare = math.log10(n + v + 1), math.log10(self.rare_weight)

    @property
    def rare(self) -> int:
        return self.symbols

    @property
    def end(self) -> int:
        return self.symbols + 1

    def places(self, text: str | None) -> tuple[np.ndarray, list[bytes]]:
        """Places of the known words (-1: not among them), and the other words."""
        words = text_words(text)
        get = self.place.get
        places = np.array([get(w, -1) for w in words], dtype=np.int64)
        return places, [words[i] for i in np.flatnonzero(places < 0)]

    def as_symbols(self, places: np.ndarray) -> np.ndarray:
        """The symbols of a text: words without one of their own are rare, and the end follows."""
        return np.append(np.where((places < 0) | (places >= self.rare), self.rare, places), self.end)


def as_symbols(places: list[bytes], rare: int, end: int) -> list[np.ndarray]:
    """The symbols of each text of a batch, from its places as 32-bit integers."""
    last = np.int32(-1).tobytes()
    # Read without a sign, -1 is the greatest of all places.
    flat = np.minimum(np.frombuffer(last.join([*places, b""]), dtype=np.uint32), np.uint32(rare)).view(np.int32)
    stops = np.cumsum(np.array([len(p) // 4 + 1 for p in places], dtype=np.int64))
    flat[stops - 1] = end
    return [flat[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)] if places else []


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    """From the written counts of the training words; ``ends`` training texts end."""
    totals = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    most = most_frequent(counts.filter(F.octet_length("word") <= LONGEST), KNOWN)
    n, v = (totals["n"] or 0) + ends, totals["v"] + (1 if ends else 0)
    return Vocabulary([w for w, _ in most], [c for _, c in most], n, v, ends)


def _coded(docs: DataFrame, kept: dict[str, str], trains: Column, vocabulary) -> DataFrame:
    """Columns of ``docs`` but ``text`` under other names, and what training and scoring need of each text.

    ``places`` are those of its words; ``asked`` and ``times`` are its words that are not in the broadcast
    part, given once per text and task. ``symbols`` and ``copies`` are given for training texts of a batch, once per text.
    """
    own = docs.select("text", F.coalesce(trains, F.lit(False)), *(F.col(f"`{c}`").alias(n) for c, n in kept.items()))
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in own.schema.fields[2:])

    def encode(batches):
        known = vocabulary.value
        seen: set[bytes] = set()
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            training = Counter(t for t, yes in zip(texts, batch.column(1).to_pylist(), strict=True) if yes)
            coded: dict[str, tuple] = {}
            asked, times, copies = [], [], []
            for text in texts:
                first = text not in coded
                if first:
                    coded[text] = (_key(text), *known.places(text))
                key, _, others = coded[text]
                own = Counter(others) if first and key not in seen else {}
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add(key)
                asked.append(list(own))
                times.append(list(own.values()))
                copies.append(training[text] if first else 0)
            yield {
                **{name: batch.column(i + 2) for i, name in enumerate(kept.values())},
                "key": [coded[t][0] for t in texts], "places": [coded[t][1].astype(np.int32).tobytes() for t in texts],
                "asked": asked, "times": times, "copies": copies,
            }

    added = "key binary, places binary, asked array<binary>, times array<bigint>, copies bigint"
    return arrow_rows(own, schema + added, encode)


def train(texts: DataFrame, vocabulary: Vocabulary) -> Model:
    """Baum-Welch over column ``text``."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)
    return _fitted(written(_coded(texts.select("text"), {}, F.lit(True), shared), "coded"), vocabulary)


def _fitted(coded: DataFrame, vocabulary: Vocabulary) -> Model:
    """Baum-Welch over the rows of ``places, copies`` that have copies."""
    spark, size = coded.sparkSession, vocabulary.symbols + 2
    rng = np.random.default_rng(SEED)
    model = normalised(
        Model(np.ones(STATES), np.ones((STATES, STATES)) + 40 * np.eye(STATES), rng.random((STATES, size)) + 0.5)
    )
    rare, end = vocabulary.rare, vocabulary.end
    coded = coded.filter("copies > 0").select("places", "copies")
    for _ in range(ROUNDS):
        now = spark.sparkContext.broadcast(model)

        def count(batches, now=now):
            model = now.value
            sums = Model(*(np.zeros_like(x) for x in (model.start, model.move, model.emit)))
            for batch in batches:
                every = as_symbols(batch.column(0).to_pylist(), rare, end)
                times = batch.column(1).to_numpy()
                lengths = np.array([len(s) for s in every])
                for block in sequences(lengths):
                    expected(model, [every[i] for i in block], sums, times[block])
            stacked = np.concatenate([sums.start[None], sums.move, sums.emit.T])
            seen = np.flatnonzero(stacked.any(axis=1))
            yield {"row": seen, "counts": stacked[seen].tolist()}

        part = arrow_rows(coded, "row int, counts array<double>", count)
        sums = part.groupBy("row").agg(*(F.sum(F.col("counts")[s]).alias(f"s{s}") for s in range(STATES)))
        got = sums.toPandas()
        stacked = np.zeros((1 + STATES + size, STATES))
        stacked[got["row"].to_numpy()] = got.drop(columns="row").to_numpy()
        model = normalised(Model(stacked[0], stacked[1 : 1 + STATES], stacked[1 + STATES :].T))
    return model


def _key(text: str | None) -> bytes:
    return xxhash.xxh3_128_digest((text or "").encode())


def score(docs: DataFrame, trains: Column) -> DataFrame:
    """Columns of ``docs`` but ``text``, and counts and scores of every row of it.

    ``trains`` tells the rows to learn from.
    """
    spark = docs.sparkSession
    training = docs.filter(trains)
    rows = training.count()
    counts = written(word_counts(training), "word-counts")
    known = vocabulary(counts, rows)
    kept = [c for c in docs.columns if c != "text"]
    taken = {c: f"_{i}" for i, c in enumerate(kept)}
    coded = written(_coded(docs, taken, trains, spark.sparkContext.broadcast(known)), "coded")
    shared = spark.sparkContext.broadcast((known, _fitted(coded, known)))
    own = coded.select("places", "key", *taken.values())
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in own.schema.fields[2:])

    def first(batches):
        known, model = shared.value
        for batch in batches:
            stored = batch.column(0).to_pylist()
            places = [np.frombuffer(p, dtype=np.int32) for p in stored]
            every = as_symbols(stored, known.rare, known.end)
            base = [_base(known, p) for p in places]
            hmm = np.zeros(len(places))
            for block in sequences(np.array([len(s) for s in every])):
                hmm[block] = log10_likelihoods(model, [every[i] for i in block])
            yield {
                **{name: batch.column(i + 2) for i, name in enumerate(taken.values())},
                "key": batch.column(1),
                "n_tokens": [len(p) + 1 for p in places],
                "n_known": [b[0] for b in base], "base": [b[1] for b in base],
                "shares": [b[2] for b in base], "n_rare": [b[3] for b in base], "hmm": hmm.tolist(),
            }

    scored = written(
        arrow_rows(
            own,
            schema + "key binary, n_tokens bigint, n_known bigint, base double, shares double, n_rare bigint, hmm double",
            first,
        ),
        "scored",
    )
    asked = coded.select("key", F.explode(F.arrays_zip("asked", "times")).alias("a")).select(
        "key", F.col("a.asked").alias("word"), "a.times"
    )
    # An unknown word adds log10(0 + 1) = 0, so the inner join is enough.
    found = (
        asked.join(counts, "word").groupBy("key", "word")
        .agg(F.first("times").alias("times"), F.first("n").alias("n"))
        .groupBy("key").agg(
            F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more")
        )
    )
    more, more_known = F.coalesce("more", F.lit(0.0)), F.coalesce("more_known", F.lit(0))
    return scored.join(found, "key", "left").select(
        *(F.col(taken[c]).alias(c) for c in kept),
        "n_tokens", (F.col("n_known") + more_known).alias("n_known"),
        F.lit(known.n).cast("bigint").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * known.log_all).alias("base_score"),
        (F.col("hmm") + F.col("shares") + more - F.col("n_rare") * known.log_rare).alias("score"),
    )


def _base(known: Vocabulary, places: np.ndarray) -> tuple[int, float, float, int]:
    """Known tokens, sum of log10(c+1) of base and of rare words, and how many are rare."""
    inside = places[places >= 0]
    logs, rare = known.logs[inside], inside >= known.symbols
    return (
        len(inside) + (known.ends > 0), float(logs.sum()) + math.log10(known.ends + 1), float(logs[rare].sum()),
        len(places) - len(inside) + int(rare.sum()),
    )
