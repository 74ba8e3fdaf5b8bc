"""Byte-level BPE through a sentencepiece model made from a rank file.

The model is serialised directly, without training: every token of the rank
file becomes a piece, its bytes mapped to one character each, with the
negative rank as score (a BPE encoder joins the pair whose joint piece scores
highest, i.e. ranks lowest); the normaliser is the identity. A piece's id is
its rank. Texts are split into pre-tokens by the vocabulary's pattern; a
pre-token that is itself a token is that token, any other is encoded by the
model. Decoding maps pieces back to bytes.

Defined cases: a NULL or empty text has no tokens and decodes to no bytes;
each row is encoded on its own, repeated rows alike; other columns are never
read. No length limit applies to texts or pre-tokens.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from selfmend.llm.common import map_arrow, text_slices

#: Pre-tokens kept with their ids per Python worker; the memory is emptied when full.
CACHED_TOKENS = 800_000
#: Longer pre-tokens are encoded anew each time.
CACHED_LENGTH = 40
#: Byte b is written as the character with this code point plus b.
FIRST_CHAR = 0x100


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """A protocol-buffer field: varint, 32-bit float or length-delimited."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


_CHARS = "".join([chr(FIRST_CHAR + b) for b in range(256)])


def to_chars(data: bytes) -> str:
    return codecs.charmap_decode(data, "strict", _CHARS)[0]


def to_bytes(piece: str) -> bytes:
    return bytes([ord(c) - FIRST_CHAR for c in piece])


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The model file of a vocabulary whose ranks are 0, 1, 2, ... . The
    unknown piece every model must have stands behind the vocabulary."""
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must run from 0 without gaps and hold every byte")
    # fixed values: ModelProto.pieces 1 (piece 1, score 2, type 3: normal 1, unknown 2), trainer_spec 2
    # (model_type 3: BPE 2, unk_id 40), normalizer_spec 3 (name 1, dummy prefix 3, extra white space 4, escape 5)
    out = [_field(1, _field(1, to_chars(t).encode()) + _field(2, float(-i)) + _field(3, 1))
           for i, t in enumerate(tokens)]
    out.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    out.append(_field(2, _field(3, 2) + _field(40, len(tokens))))
    out.append(_field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)))
    return b"".join(out)


class Codec:
    """Encoder and decoder of one vocabulary file and pre-token pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        import sentencepiece
        self.ranks = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        self.pattern = regex.compile(pattern)
        n = len(self.ranks)
        # the inverse mapping, read back from the model
        self.token_bytes = [to_bytes(self.model.id_to_piece(i)) for i in range(n)]
        self.decimal = [str(i) for i in range(n)]
        self.known: dict[str, bytes] = {}

    def _learn(self, tokens: list[str]) -> dict[str, bytes]:
        out, rest = {}, []
        for token in tokens:
            data = token.encode("utf-8", "surrogatepass")
            rank = self.ranks.get(data)
            if rank is None:
                rest.append((token, to_chars(data)))
            else:
                out[token] = struct.pack("<I", rank)
        for (token, _), ids in zip(rest, self.model.encode([x for _, x in rest], num_threads=1) if rest else []):
            out[token] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text. New pre-tokens of all texts are encoded together."""
        split = [self.pattern.findall(text) for text in texts]
        known = self.known
        new = set().union(*split).difference(known)
        known.update(self._learn(list(new)))
        for tokens in split:
            yield np.frombuffer(b"".join([known[t] for t in tokens]), dtype="<u4")
        if len(known) > CACHED_TOKENS:
            known.clear()
        else:
            for token in new:
                if len(token) > CACHED_LENGTH:
                    del known[token]

    def decode(self, ids: list[int]) -> bytes:
        table = self.token_bytes
        return b"".join([table[i] for i in ids])


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec for a vocabulary file."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode_column(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row ``doc_id``, its token ``ids`` and the ``decoded`` bytes."""
    def run(batches):
        own = codec(path, pattern)
        for part in text_slices(batches):
            ids = [x.tolist() for x in own.encode([x or "" for x in part.column("text").to_pylist()])]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(ids, pa.list_(pa.int32())),
                 pa.array([own.decode(x) for x in ids], pa.binary())], names=["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, ids array<int>, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    def run(batches):
        own = codec(path, pattern)
        decimal = own.decimal
        for part in text_slices(batches):
            n, a, b = [], [], []
            for found in own.encode([x or "" for x in part.column("text").to_pylist()]):
                ids = found.tolist()
                n.append(len(ids))
                a.append(hashlib.sha256(",".join([decimal[i] for i in ids]).encode()).hexdigest())
                b.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        docs.select("doc_id", "text"), run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
