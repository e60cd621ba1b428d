"""Encoding with a public byte-level BPE vocabulary, carried out by a sentencepiece model serialised from it."""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Words and pre-tokens whose ids a worker remembers, of each; when full it starts afresh.
REMEMBER = 300_000
#: Characters that are looked up at a time, and tokens of a batch that is handed on.
GROUP, BATCH = 2_000_000, 4_000_000

_BLANKS, _CUT = re.compile(r" (?:\s|\Z)"), re.compile(r" (?=\S)")

# Fixed value: the vocabulary's public pre-token pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_vocabulary() -> str:
    """Path of byte_bpe_50k among the installed public tokenizers."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def byte_letters() -> list[str]:
    """A printable letter for each byte: itself if it is printable in Latin-1, else the next letter from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(no: int, value: bytes | int | float) -> bytes:
    """One protobuf field: bytes, bool or integer, or float."""
    if isinstance(value, bytes):
        return _varint(no << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(no << 3 | 5) + struct.pack("<f", value)
    return _varint(no << 3) + _varint(value & (1 << 64) - 1)


def sentencepiece_model(vocabulary: bytes) -> bytes:
    """A sentencepiece BPE model of a tiktoken vocabulary file: piece ids are its ranks, scores the negative ranks, normalisation is the identity."""
    letters = byte_letters()
    ranks = {int(r): base64.b64decode(t) for t, r in map(bytes.split, vocabulary.splitlines())}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, …")
    piece = lambda text, score, kind: _field(1, _field(1, text.encode()) + _field(2, score) + _field(3, kind))
    pieces = [piece("".join(letters[b] for b in ranks[r]), -float(r), 1) for r in range(len(ranks))]
    pieces.append(piece("<unk>", 0.0, 2))  # every byte is in the vocabulary: never used
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(ranks)) + _field(41, -1) + _field(42, -1) + _field(43, -1)
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


def _starts(ids: Iterable[bytes]) -> bytes:
    return b"".join(b"\1" + bytes(len(x) // 4 - 1) for x in ids)


def _groups(texts: Sequence[str | None]) -> Iterator[list[str]]:
    """Texts, '' for null, in groups of about GROUP characters."""
    some, size = [], 0
    for t in texts:
        some.append(t or "")
        size += len(some[-1])
        if size >= GROUP:
            yield some
            some, size = [], 0
    if some:
        yield some


class Encoder:
    """Encodes and decodes texts; ids are those of the vocabulary, without special tokens.

    A text is cut before every space that a letter, digit or sign follows: no pre-token reaches over such a place, and none depends on what lies
    beyond it. What lies between, mostly a word with its space and punctuation, is encoded by its pre-tokens once and remembered as packed ids.
    """

    def __init__(self, model: bytes) -> None:
        import regex
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.scan = regex.compile(PATTERN)
        self.split = self.scan.findall
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        self.bytes_of = {c: b for b, c in self.letters.items()}
        #: Bytes of each token.
        self.widths = np.fromiter(map(len, self.sp.id_to_piece(list(range(self.sp.get_piece_size())))), np.int32)
        self.pre: dict[str, bytes] = {}  # pre-token -> ids
        self.words: dict[str, bytes] = {}  # word after a space -> ids
        self.starts: dict[str, bytes] = {}  # word after a space -> 1 for each id that starts a pre-token, else 0

    def pre_ids(self, pre: Sequence[str]) -> list[bytes]:
        """Packed ids of each pre-token."""
        known = self.pre
        new = list(set(pre).difference(known))
        if new:
            if len(known) + len(new) > REMEMBER:
                known.clear()
                new = list(set(pre))
            mapped = [p.encode().decode("latin-1").translate(self.letters) for p in new]
            # a call with a list starts threads, which a few short strings don't pay for
            ids = map(self.sp.encode, mapped) if len(mapped) < 16 else self.sp.encode(mapped, out_type=int, num_threads=1)
            known.update((p, struct.pack(f"{len(x)}i", *x)) for p, x in zip(new, ids, strict=True))
        return [known[p] for p in pre]

    def _parts(self, texts: Sequence[str]) -> list[tuple[list[bytes], list[str]]]:
        """For each text the ids of the pre-tokens before the first cut and the words after each cut, which are known from now on."""
        cut = [_CUT.split(t) if _BLANKS.search(t) else t.split(" ") for t in texts]
        heads = [self.split(c.pop(0)) for c in cut]
        new = set(chain.from_iterable(cut)).difference(self.words)
        if len(self.words) + len(new) > REMEMBER:
            self.words.clear()
            self.starts.clear()
            new = set(chain.from_iterable(cut))
        split = [self.split(" " + w) for w in new]
        ids = iter(self.pre_ids(list(chain.from_iterable(chain(heads, split)))))
        first = [list(islice(ids, len(h))) for h in heads]
        for w, pre in zip(new, split, strict=True):
            each = list(islice(ids, len(pre)))
            self.words[w], self.starts[w] = b"".join(each), _starts(each)
        return list(zip(first, cut, strict=True))

    def packed(self, texts: Sequence[str | None]) -> Iterator[bytes]:
        """Ids of each text as packed 32-bit integers; null and empty texts have none."""
        for some in _groups(texts):
            for head, words in self._parts(some):
                yield b"".join((*head, *map(self.words.__getitem__, words)))

    def marked(self, texts: Sequence[str | None]) -> Iterator[tuple[bytes, bytes]]:
        """``packed`` and, for each id, 1 if it starts a pre-token, else 0."""
        for some in _groups(texts):
            for head, words in self._parts(some):
                yield b"".join((*head, *map(self.words.__getitem__, words))), b"".join((_starts(head), *map(self.starts.__getitem__, words)))

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; null and empty texts have none."""
        return np.frombuffer(next(self.packed([text])), np.int32).tolist()

    def size(self, text: str | None) -> int:
        return sum(map(len, self.pre_ids(self.split(text)))) // 4 if text else 0

    def token_bytes(self, i: int) -> bytes:
        return bytes(self.bytes_of[c] for c in self.sp.id_to_piece(i))

    def decode(self, ids: Iterable[int]) -> str:
        """The text again, byte for byte."""
        return b"".join(map(self.token_bytes, ids)).decode()


_ENCODERS: dict[int, Encoder] = {}


def shipped(df: DataFrame, vocabulary: str | None = None) -> callable:
    """A function that gives a worker its encoder. The model is broadcast: its size is the vocabulary's (about 1 MB), whatever the data."""
    model = df.sparkSession.sparkContext.broadcast(sentencepiece_model(Path(vocabulary or default_vocabulary()).read_bytes()))

    def encoder() -> Encoder:
        import zlib

        key = zlib.crc32(model.value)
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(model.value)
        return _ENCODERS[key]

    return encoder


def encode_corpus(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row of ``documents`` (doc_id, text): one row out for each row in, repeated rows and null doc_ids too.

    Null and empty texts have the empty list. Texts are encoded whole; other columns are ignored.
    """
    encoder = shipped(documents, vocabulary)

    def lists(docs: pa.Array, ids: list[bytes]) -> pa.RecordBatch:
        ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
        values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(ids))])
        return pa.RecordBatch.from_arrays([docs, pa.ListArray.from_arrays(pa.array(ends), values)], ["doc_id", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder()
        for b in batches:
            ids, first, size = [], 0, 0
            for x in e.packed(b.column(1).to_pylist()):
                ids.append(x)
                size += len(x) // 4
                if size >= BATCH:
                    yield lists(b.column(0).slice(first, len(ids)), ids)
                    ids, first, size = [], first + len(ids), 0
            if ids:
                yield lists(b.column(0).slice(first, len(ids)), ids)

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")
