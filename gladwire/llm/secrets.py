"""Secret scans: fixed patterns, and strings on which a tokenizer is wasteful.

The base patterns find assignments, access keys and long hexadecimal runs. The
token-efficiency test looks at the remaining runs of key characters: random
strings split into many short tokens of a general vocabulary, so few
characters per token expose them. The test looks at the whole run, and, where
that is none, at its parts between ``/ = _ -``: readable parts hide no random
ones, and random parts that follow each other count together. Strings that
are known not to be secrets are left out: digests of the usual lengths,
UUIDs, and plain numbers. What lies outside the base spans stays of a random
run that overlaps one.

Spans are in code points, the end exclusive. Defined cases: a null or empty
text has no spans; repeated rows each get theirs; texts are read whole.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

# The patterns and least lengths of the base.
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "random")

# Runs that may be keys; anything shorter is too short to tell.
LEAST = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
PART = re.compile(r"[A-Za-z0-9+]+")
DIGEST_LENGTHS = {32, 40, 48, 56, 64, 96, 128}
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
IDENTIFIER = re.compile(rf"(?<![A-Za-z0-9+])(?:{UUID.pattern})(?![A-Za-z0-9+])")
CHARS_PER_TOKEN = 2.0
# Runs are tokenized in pieces of so many characters: time stays linear.
PIECE = 4096

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of what the fixed patterns find."""
    found = [
        (m.start(), m.end(), "assign")
        for m in ASSIGN.finditer(text)
        if len(m[1]) >= ASSIGN_LEAST
    ]
    found += [
        (m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST
    ]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return in_order(found)


def in_order(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def known_harmless(run: str) -> bool:
    """Digests, identifiers and plain numbers."""
    if UUID.fullmatch(run):
        return True
    if len(run) in DIGEST_LENGTHS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", run):
        return True
    return re.search("[A-Za-z]", run) is None


def wasteful(run: str, tokens) -> bool:
    """Whether a run has few characters per token."""
    pieces = (run[i : i + PIECE] for i in range(0, len(run), PIECE))
    return len(run) < CHARS_PER_TOKEN * sum(len(tokens(p)) for p in pieces)


def random_parts(run: str, tokens) -> list[tuple[int, int]]:
    """Start and end of the stretches of random parts of a run, identifiers and digests between them."""
    found: list[tuple[int, int]] = []
    edge = 0
    for m in [*IDENTIFIER.finditer(run), None]:
        stretch: list[tuple[int, int]] = []
        for part in PART.finditer(run, edge, m.start() if m else len(run)):
            # A number says nothing of itself and may stand inside a key; a digest ends a stretch.
            number = part[0].isdigit()
            if (number and stretch) or (not number and not known_harmless(part[0]) and wasteful(part[0], tokens)):
                stretch.append(part.span())
                continue
            found += _joined(stretch)
            stretch = []
        found += _joined(stretch)
        edge = m.end() if m else edge
    return [(start, end) for start, end in found if end - start >= LEAST and not known_harmless(run[start:end])]


def _joined(stretch: list[tuple[int, int]]) -> list[tuple[int, int]]:
    return [(stretch[0][0], stretch[-1][1])] if stretch else []


def random_spans(text: str, tokens) -> list[tuple[int, int, str]]:
    """Runs of few characters per token; ``tokens`` gives the ids of a string."""
    found = []
    for m in CANDIDATE.finditer(text):
        run = m[0].strip("=-_/+")
        if len(run) >= LEAST and not known_harmless(run):
            if wasteful(run, tokens):
                found.append((m.start(), m.end(), "random"))
            else:
                found += [(m.start() + a, m.start() + b, "random") for a, b in random_parts(m[0], tokens)]
    return found


def outside(start: int, end: int, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The parts between two places that lie in no base span; these come in order."""
    found = []
    for a, b, _ in base:
        if a > start and start < end:
            found.append((start, min(a, end)))
        start = max(start, b)
    return found + [(start, end)] if start < end else found


def all_spans(text: str, tokens) -> tuple[list, list]:
    """The base spans, and these with the random ones, as far as they lie outside the base spans."""
    base = base_spans(text)
    more: list[tuple[int, int]] = []
    # Both lists are in order: base spans that end before a random one are passed over once.
    ends = np.maximum.accumulate([b for _, b, _ in base]) if base else []
    for start, end, _ in random_spans(text, tokens):
        over = []
        for i in range(int(np.searchsorted(ends, start, "right")), len(base)):
            if base[i][0] >= end:
                break
            if start < base[i][1]:
                over.append(base[i])
        if not over:
            more.append((start, end))
            continue
        # Of a run that is cut, readable words and separators do not stay.
        for a, b in outside(start, end, over):
            rest = text[a:b].strip("=-_/+")
            if not known_harmless(rest) and wasteful(rest, tokens):
                more.append((a, b))
    # A base span may hide what stands beside it in its run.
    if base:
        for a, b in outside(0, len(text), base):
            more += [(a + s, a + e) for s, e, _ in random_spans(text[a:b], tokens)]
    merged: list[list[int]] = []
    for a, b in sorted(more):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return base, in_order(base + [(a, b, "random") for a, b in merged])


def as_text(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def tokenizer(ranks_file: bytes):
    """Token ids of a string, by a vocabulary of ranks."""
    import tiktoken

    ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, ranks_file.splitlines()) if t}
    encoding = tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return encoding.encode_ordinary


def scanner(spark, vocabulary: str = VOCABULARY):
    """A function from a text column to counts, the digest of the base spans, and all spans.

    The vocabulary file, of fixed size, is read by the driver and broadcast.
    """
    with open(vocabulary, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    own: list = []

    @F.pandas_udf(
        "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_random bigint"
    )
    def scan(texts: pd.Series) -> pd.DataFrame:
        if not own:
            own.append(tokenizer(shared.value))
        rows = []
        for text in texts:
            base, spans = all_spans(text or "", own[0])
            kinds = [kind for _, _, kind in spans]
            digest = hashlib.sha256(as_text(base).encode()).hexdigest()
            n = [kinds.count(k) for k in KINDS]
            rows.append((n[0], n[1], n[2], digest, as_text(spans), n[3]))
        return pd.DataFrame(
            rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]
        )

    return scan
