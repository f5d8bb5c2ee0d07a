"""Byte-level BPE through a sentencepiece model that is written directly from a rank file.

Every byte of a token is one printable character, every token one piece, and its score is its negative
rank, so that sentencepiece merges the pair of lowest rank first. The normaliser is the identity. Each
pre-token is a sentence of its own; decoding looks each id up in the inverse table.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.llm.common import extended, query, slices, table

# Pre-tokens kept with their ids per task, and pre-tokens taken at a time from a very long text.
CACHED = 400_000
AT_A_TIME = 100_000
# Code points from which a text is taken in runs; bytes of the texts that are encoded together.
LONG_TEXT = 1_000_000
TOGETHER = 2 * 1024 * 1024
PIECE_NORMAL, PIECE_UNKNOWN, PIECE_UNUSED, MODEL_BPE = 1, 2, 5, 2


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank from lines of base64, blank, number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def byte_characters() -> str:
    """A printable character for each byte: itself where printable, else the next from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return "".join(chr(b if b in shown else next(spare)) for b in range(256))


def _varint(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised model. A piece's id is its rank; ranks without token get unused pieces."""
    characters = byte_characters()
    by_rank = {rank: token.decode("latin-1").translate(characters) for token, rank in ranks.items()}
    last = max(by_rank, default=-1)

    def piece(text: str, score: float, kind: int) -> bytes:
        return _bytes(1, _bytes(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))

    pieces = [
        piece(by_rank[r], -float(r), PIECE_NORMAL) if r in by_rank else piece(f"<unused {r}>", 0.0, PIECE_UNUSED)
        for r in range(last + 1)
    ]
    pieces.append(piece("<unk>", 0.0, PIECE_UNKNOWN))
    trainer = b"".join(
        [_number(3, MODEL_BPE), _number(4, last + 2), _number(40, last + 1), _number(41, -1), _number(42, -1), _number(43, -1)]
    )
    # No prefix blank, no removed or escaped blanks.
    normalizer = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join([*pieces, _bytes(2, trainer), _bytes(3, normalizer)])


class Encoder:
    """Ids of pre-tokens, with a bounded cache. Ids are held as little-endian 32-bit integers."""

    def __init__(self, model: bytes, pattern: str, whole: dict[bytes, int]):
        import regex
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pattern = regex.compile(pattern)
        self.characters = byte_characters()
        # Tokens that the merges do not reach count where they are a whole pre-token.
        self.whole = {token: struct.pack("<I", rank) for token, rank in whole.items()}
        self.known: dict[str, bytes] = {}

    def mapped(self, token: str) -> str:
        return token.encode().decode("latin-1").translate(self.characters)

    def _learn(self, runs: list[list[str]]) -> None:
        if len(self.known) > CACHED:
            self.known.clear()
        new = list(set().union(*runs) - self.known.keys())
        for token, ids in zip(new, self.pieces.encode([self.mapped(t) for t in new], num_threads=1)):
            self.known[token] = self.whole.get(token.encode()) or struct.pack(f"<{len(ids)}I", *ids)

    def _ids(self, runs: list[list[str]]) -> list[bytes]:
        self._learn(runs)
        return [b"".join(map(self.known.__getitem__, run)) for run in runs]

    def _long(self, text: str) -> bytes:
        found = (m.group() for m in self.pattern.finditer(text))
        out = []
        while run := list(islice(found, AT_A_TIME)):
            out += self._ids([run])
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. The texts' new pre-tokens are encoded together, very long texts in runs."""
        short = [t for t in texts if len(t) <= LONG_TEXT]
        ids = iter(self._ids([self.pattern.findall(t) for t in short]))
        return [next(ids) if len(t) <= LONG_TEXT else self._long(t) for t in texts]


def unreached(model: bytes, ranks: dict[bytes, int]) -> dict[bytes, int]:
    """Tokens that sentencepiece does not build from their bytes."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    characters = byte_characters()
    tokens = list(ranks)
    found = pieces.encode([t.decode("latin-1").translate(characters) for t in tokens], num_threads=1)
    return {t: ranks[t] for t, ids in zip(tokens, found) if ids != [ranks[t]]}


def _encoding(model: bytes, pattern: str, whole: dict[bytes, int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model, pattern, whole)
        for batch in batches:
            for part in slices(batch, "text", TOGETHER):
                ids = encoder.encode([t or "" for t in part.column("text").to_pylist()])
                kept = part.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(ids, pa.binary())], names=[*kept.schema.names, "ids"])

    return run


def _decoding(tokens: list[bytes]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for part in slices(batch, "ids"):
                decoded = [
                    b"".join(map(tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))
                    for ids in part.column("ids").to_pylist()
                ]
                names = [*part.schema.names, "decoded"]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], names=names)

    return run


def bpe_encode(docs: DataFrame, vocabulary: str, pattern: str, *, text_column: str = "text") -> DataFrame:
    """``docs`` with ``ids`` instead of the text: little-endian unsigned 32-bit integers in one binary.

    ``vocabulary`` is the path of a rank file, ``pattern`` splits texts before the merges. Whole texts
    are encoded; a null text is empty and has no ids; rows that repeat an id or a text get a row each, an empty table gives no rows. Other columns stay; one called ``ids`` is replaced.
    """
    ranks = read_ranks(vocabulary)
    model = model_bytes(ranks)
    others = [c for c in docs.columns if c not in (text_column, "ids")]
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)], F.col(f"`{text_column}`").alias("text"))
    schema = extended(inner.drop("text").schema, "ids binary")
    encoded = inner.mapInArrow(_encoding(model, pattern, unreached(model, ranks)), schema)
    return encoded.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], "ids")


def bpe_decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes that the ``ids`` stand for; null ids give no bytes."""
    by_rank = {rank: token for token, rank in read_ranks(vocabulary).items()}
    tokens = [by_rank.get(r, b"") for r in range(max(by_rank, default=-1) + 1)]
    others = [c for c in encoded.columns if c not in ("ids", "decoded")]
    inner = encoded.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)], "ids")
    out = inner.mapInArrow(_decoding(tokens), extended(inner.schema, "decoded binary"))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], "ids", "decoded")


def bpe_digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Per document: number of ids, digests of the ids and of what they decode to."""
    decoded = bpe_decode(bpe_encode(docs.select("doc_id", "text"), vocabulary, pattern), vocabulary)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op8_byte_bpe(spark, folder):
    """Every document encoded and decoded again."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_digests(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
