"""Byte-level BPE through a sentencepiece model serialised straight from the vocabulary.

Each byte is written as one letter (chr(256 + byte)), so every piece of the rank file is a string of such letters. The
model is a BPE model whose pieces stand in rank order with score -rank and whose normaliser is the identity; merging
the best-scored neighbours first is then merging by lowest rank. Texts are cut into pre-tokens by the pattern, each
pre-token is encoded by itself (a pre-token that is a piece as a whole is that piece), and decoding maps each id to
its bytes.

Edge cases: NULL and empty texts give no ids; ids and bytes of any text round-trip; repeated rows and NULL document
ids are carried through; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import regex
import sentencepiece
from pyspark.sql import DataFrame

from mercato.llm.common import map_texts

#: Pre-tokens remembered by each task; the store is emptied when it is full.
MEMO_SIZE = 200_000
BYTE_LETTER = [chr(256 + b) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The pieces of a rank file in rank order; ranks must be 0, 1, 2, ... without gaps."""
    with open(path, "rb") as f:
        ranks = {int(rank): base64.b64decode(piece) for piece, rank in (line.split() for line in f if line.strip())}
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value: bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def letters(raw: bytes) -> str:
    return "".join(map(BYTE_LETTER.__getitem__, raw))


def serialise_model(pieces: list[bytes]) -> bytes:
    """A sentencepiece ModelProto: pieces, then an unknown piece (never reached: every byte is a piece)."""
    def piece(text: str, score: float, kind: int) -> bytes:
        return _field(1, _field(1, text.encode()) + b"\x15" + np.float32(score).tobytes() + _field(3, kind))

    body = b"".join(piece(letters(p), -rank, 1) for rank, p in enumerate(pieces))
    trainer = _field(3, 2) + _field(4, len(pieces) + 1) + _field(40, len(pieces))
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return body + piece("<unk>", 0.0, 2) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encoder and decoder of one vocabulary; built once in each task."""

    def __init__(self, pieces: list[bytes], model: bytes, pattern: str) -> None:
        self.pieces = pieces
        self.find = regex.compile(pattern).findall
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.whole = {p: np.uint32(i).tobytes() for i, p in enumerate(pieces)}
        self.memo: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        rest = []
        for w in words:
            raw = w.encode()
            if raw in self.whole:
                self.memo[w] = self.whole[raw]
            else:
                rest.append((w, letters(raw)))
        if rest:
            for (w, _), ids in zip(rest, self.processor.encode([x for _, x in rest], num_threads=1), strict=True):
                self.memo[w] = np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        words = self.find(text)
        new = set(words).difference(self.memo)
        if new:
            if len(self.memo) + len(new) > MEMO_SIZE:
                self.memo.clear()
                new = set(words)
            self._learn(new)
        return b"".join(map(self.memo.__getitem__, words))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """The id of every document with n_tokens, ids (little-endian uint32, if asked for) and the digests of the ids
    and of the decoded bytes. ``vocabulary`` is the path of a rank file; it is read on the driver and sent as a
    serialised model, whose size is the vocabulary's."""
    pieces = read_ranks(vocabulary)
    model = serialise_model(pieces)

    def start():
        codec = Codec(pieces, model, pattern)

        def work(texts: list[str | None]) -> Iterator[dict]:
            for text in texts:
                ids = codec.encode(text) if text else b""
                yield {"n_tokens": len(ids) // 4, "ids": ids, "ids_sha256": hashlib.sha256(ids).hexdigest(),
                       "decoded_sha256": hashlib.sha256(codec.decode(ids)).hexdigest()}
        return work

    made = {"n_tokens": "long", "ids": "binary", "ids_sha256": "string", "decoded_sha256": "string"}
    if not with_ids:
        del made["ids"]
    return map_texts(docs, text_col, [id_col], start, made)
