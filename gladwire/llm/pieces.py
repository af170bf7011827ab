"""SentencePiece encoding and decoding with the tokenizers library as backend.

The model protobuf is parsed here, and its parts are rebuilt: the normaliser
(a compiled character map, if there is one), the marker for spaces, the
pieces with their scores (as a unigram model, or as the merges of a BPE model
in the order of scores), and the fall-back to bytes. Batches are encoded by
the backend's threads, and decoding rebuilds the text from the ids.

Every text is decoded again from its ids by the backend, and ``round_trip``
tells whether it came back. Every whole text is encoded by the original library too,
and ``parity`` tells whether the ids agree. Rows are taken in blocks of ``BLOCK`` characters (or one text),
and nothing of a block is kept for the next. Equal texts of a block are encoded, compared and decoded once.

Defined cases: a null or empty text has no ids, and decodes to the empty
text; repeated rows each get their ids; texts are read whole; a text
that holds the space marker itself comes back with spaces there, as in the
original; characters without a piece become bytes, or the unknown piece where the model has no
bytes; names of control and byte pieces in a text are spelled out; an empty table gives an empty
result. Columns of any name are carried along.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gladwire.llm.common import arrow_rows

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Threads of one worker: a task has one core, and more threads only wait for each other.
THREADS = 1
# Parity is tested on the texts whose CRC-32 is divisible by this: on all.
VERIFY_EVERY = 1
MARK = "▁"
# Texts of one call of the backend, and rows whose ids are held at a time: at most so many characters, or one text.
BLOCK = 200_000

# Field numbers and kinds of the model format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _BPE = 1, 2


@dataclass
class Spec:
    """What the backend needs to know of a model."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = _UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True

    @property
    def unknown(self) -> int:
        return next((i for i, (_, _, kind) in enumerate(self.pieces) if kind == _UNKNOWN), 0)


def _fields(data: bytes):
    """Number and value of the fields of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(wire) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


def parse(model: bytes) -> Spec:
    """The parts of a serialised model."""
    import struct

    spec = Spec()
    for number, value in _fields(model):
        if number == _PIECES:
            own = dict(_fields(value))
            score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
            spec.pieces.append((own.get(1, b"").decode(), score, own.get(3, _NORMAL)))
        elif number == _TRAINER:
            own = dict(_fields(value))
            spec.kind, spec.byte_fallback = own.get(3, _UNIGRAM), bool(own.get(35, 0))
        elif number == _NORMALIZER:
            own = dict(_fields(value))
            spec.charsmap = own.get(2, b"")
            spec.add_dummy_prefix = bool(own.get(3, 1))
            spec.remove_extra_whitespaces = bool(own.get(4, 1))
            spec.escape_whitespaces = bool(own.get(5, 1))
    return spec


def merges(spec: Spec) -> list[tuple[str, str]]:
    """Pairs of pieces that form a piece, best score first."""
    usable = {p: (score, i) for i, (p, score, kind) in enumerate(spec.pieces) if kind in (_NORMAL, _USER)}
    found = []
    for piece, (score, _) in usable.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in usable and right in usable:
                found.append((-score, usable[left][1], usable[right][1], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def normaliser(spec: Spec):
    """The backend's normaliser for a model."""
    from tokenizers import Regex, normalizers

    steps = [normalizers.Precompiled(spec.charsmap)] if spec.charsmap else []
    if spec.remove_extra_whitespaces:
        # spaces only: other white space is a sign like others unless the character map says otherwise
        steps += [normalizers.Replace(Regex(r"\A +| +\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if spec.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    return normalizers.Sequence(steps)


def build(spec: Spec, for_encoding: bool = False):
    """The backend's tokenizer for a model.

    A unigram model finds its pieces by name wherever they stand in a text. ``for_encoding``, the names of
    pieces that texts must not match are replaced by ones with spaces, which no marked text has.
    """
    from tokenizers import Tokenizer, decoders, models

    names = [p for p, _, _ in spec.pieces]
    if spec.kind == _UNIGRAM:
        hidden = (_UNKNOWN, _CONTROL, _UNUSED, _BYTE) if for_encoding else ()
        own = [f" \U0010fffe {i}" if kind in hidden else p for i, (p, _, kind) in enumerate(spec.pieces)]
        scores = [0.0 if kind in hidden else score for _, score, kind in spec.pieces]
        model = models.Unigram(
            list(zip(own, scores, strict=True)), spec.unknown, spec.byte_fallback and not for_encoding
        )
    elif spec.kind == _BPE:
        model = models.BPE(
            {p: i for i, p in enumerate(names)}, merges(spec), unk_token=names[spec.unknown],
            fuse_unk=True, byte_fallback=spec.byte_fallback,
        )
    else:
        raise ValueError("only unigram and BPE models can be rebuilt")
    tokenizer = Tokenizer(model)
    tokenizer.normalizer = normaliser(spec)
    back = [decoders.ByteFallback(), decoders.Fuse(), decoders.Replace(MARK, " ")]
    if spec.add_dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(back)
    return tokenizer


class Codec:
    """Backend and original of one model, for the texts of a worker."""

    def __init__(self, model: bytes, threads: int = THREADS):
        import sentencepiece
        from tokenizers import decoders

        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        spec = parse(model)
        self.encoder, self.backend = build(spec, for_encoding=True), build(spec)
        self.original = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.threads = threads
        # ids of the bytes, where the encoder does not fall back by itself; then texts come normalised, so
        # that offsets are places in them
        self.signs = build(spec, for_encoding=True)
        self.signs.normalizer = None
        self.bytes = {
            int(p[3:5], 16): i for i, (p, _, kind) in enumerate(spec.pieces)
            if kind == _BYTE and spec.kind == _UNIGRAM and spec.byte_fallback
        }
        self.unknown = spec.unknown
        # A normaliser that only sets marks is cheaper outside of the backend, which keeps the place of every sign;
        # likewise the last steps of decoding, which follow the joined text.
        self.plain = spec.escape_whitespaces and not spec.charsmap and not spec.remove_extra_whitespaces
        self.prefix = " " if spec.add_dummy_prefix else ""
        self.backend.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse()])

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, by the backend's threads."""
        out: list[list[int]] = []
        for block in _blocks(texts):
            if self.plain:
                marked = [(self.prefix + t).replace(" ", MARK) if t else t for t in block]
                encoded = self.signs.encode_batch_fast(marked, add_special_tokens=False)
            else:
                encoded = self.encoder.encode_batch_fast(block, add_special_tokens=False)
            out += [self._ids(e.ids, text) for text, e in zip(block, encoded, strict=True)]
        return out

    def _ids(self, ids: list[int], text: str) -> list[int]:
        """Ids with bytes in the place of unknown signs, where the encoder has not put them itself."""
        if not self.bytes or self.unknown not in ids:
            return ids
        text = self.encoder.normalizer.normalize_str(text)
        encoded = self.signs.encode(text, add_special_tokens=False)
        out: list[int] = []
        for i, (begin, end) in zip(encoded.ids, encoded.offsets, strict=True):
            out += [self.bytes[b] for b in text[begin:end].encode()] if i == self.unknown else [i]
        return out

    def parity(self, texts: list[str], ids: list[list[int]], every: int) -> list[bool | None]:
        """Whether the original library agrees; None where a text is not tested."""
        tested = [i for i, t in enumerate(texts) if every == 1 or zlib.crc32(t.encode()) % every == 0]
        want = self.original.encode([texts[i] for i in tested], num_threads=self.threads)
        same: list[bool | None] = [None] * len(texts)
        for i, own in zip(tested, want, strict=True):
            same[i] = own == ids[i]
        return same

    def decode(self, ids: list[list[int]]) -> list[str]:
        back = self.backend.decode_batch(ids, skip_special_tokens=False)
        return [t.replace(MARK, " ").removeprefix(self.prefix) for t in back]

    def verified(self, texts: list[str], every: int) -> tuple[list, list, list]:
        """Ids, parity and round trip of each text; equal texts share the work."""
        own = list(dict.fromkeys(texts))
        ids = self.encode(own)
        same = self.parity(own, ids, every)
        back = [text == b for text, b in zip(own, self.decode(ids), strict=True)]
        place = {text: i for i, text in enumerate(own)}
        return tuple([found[place[t]] for t in texts] for found in (ids, same, back))


# One codec a worker and model: building one takes as long as thousands of texts.
_codecs: dict[str, Codec] = {}


def codec_of(model: bytes) -> Codec:
    """The worker's codec of a model."""
    digest = hashlib.sha256(model).hexdigest()
    if digest not in _codecs:
        _codecs.clear()
        _codecs[digest] = Codec(model)
    return _codecs[digest]


def _row_blocks(lengths: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of rows of at most ``BLOCK`` characters, or of one row."""
    out, begin, total = [], 0, 0
    for i, length in enumerate(lengths.tolist()):
        if i > begin and total + length > BLOCK:
            out.append((begin, i))
            begin, total = i, 0
        total += length
    return [*out, (begin, len(lengths))] if len(lengths) else out


def _blocks(texts: list[str]):
    block, length = [], 0
    for text in texts:
        if block and length + len(text) > BLOCK:
            yield block
            block, length = [], 0
        block.append(text)
        length += len(text)
    if block:
        yield block


def _shared(spark, model: str):
    """The model file, of fixed size, read by the driver and broadcast."""
    with open(model, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def decoder(spark, model: str = MODEL):
    """A function from a column of ids to the text; null ids give null."""
    shared = _shared(spark, model)

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        back = codec_of(shared.value).decode([[] if i is None else [int(x) for x in i] for i in ids])
        return pd.Series([None if i is None else b for i, b in zip(ids, back, strict=True)])

    return decode


def tokenized(docs: DataFrame, model: str = MODEL, every: int = VERIFY_EVERY) -> DataFrame:
    """The rows with ``token_ids, n_tokens, parity, round_trip`` behind their columns.

    Columns of these names that the rows already have are replaced.
    """
    added = ("token_ids", "n_tokens", "parity", "round_trip")
    kept = [c for c in docs.columns if c not in added]
    rows = docs.select(F.col("text"), *(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(kept)))
    more = StructType.fromDDL("token_ids array<int>, n_tokens int, parity boolean, round_trip boolean")
    shared, names = _shared(docs.sparkSession, model), rows.columns[1:]

    def work(batches):
        codec = codec_of(shared.value)
        for whole in batches:
            lengths = pc.fill_null(pc.utf8_length(whole.column(0)), 0).to_numpy(zero_copy_only=False)
            for begin, end in _row_blocks(lengths):
                batch = whole.slice(begin, end - begin)
                ids, same, back = codec.verified([t or "" for t in batch.column(0).to_pylist()], every)
                yield {
                    **{name: batch.column(i + 1) for i, name in enumerate(names)},
                    "token_ids": [np.array(i, dtype=np.int32) for i in ids], "n_tokens": [len(i) for i in ids],
                    "parity": same, "round_trip": back,
                }

    coded = arrow_rows(rows, StructType(rows.schema.fields[1:] + more.fields), work)
    return coded.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(kept)), *added)
