"""Splitting oversized texts at natural boundaries (token offset prefix sums and binary search)."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from noticelake.llm.tokens import Encoder, shipped

#: Tokens of a piece at most, and tokens that neighbours share.
LIMIT, OVERLAP = 512, 64

# Natural boundaries, the strongest first: where the next paragraph, line, sentence, clause or word starts.
BOUNDARIES = {
    "paragraph": re.compile(r"\n[^\S\n]*\n\s*|\r\n[^\S\n]*\r\n\s*"),
    "line": re.compile(r"[\r\n]\s*"),
    "sentence": re.compile(r"[.!?…][\"”’)\]]*\s+"),
    "clause": re.compile(r"[;:,|]\s+"),
    "word": re.compile(r"\s+"),
}


class TokenMap:
    """Character offset of every token boundary of a text (prefix sums of the tokens' bytes), and the token places of its natural boundaries."""

    def __init__(self, e: Encoder, text: str, ids: bytes, starts: bytes) -> None:
        self.e, self.text, self.places = e, text, {}
        at = np.concatenate(([0], np.cumsum(e.widths[np.frombuffer(ids, np.int32)])))
        raw = np.frombuffer(text.encode(), np.uint8)
        if len(raw) > len(text):  # bytes to characters; -1 inside one
            first = np.append((raw & 0xC0) != 0x80, True)
            at = np.where(first[at], (np.cumsum(first) - 1)[at], -1)
        self.at = at.tolist()
        self.size = len(self.at) - 1
        self.whole = np.append(np.flatnonzero(np.frombuffer(starts, np.uint8)), self.size)  # token places where pre-tokens start
        self.offsets = at[self.whole]

    def natural(self, kind: str) -> list[int]:
        """Sorted token places of the boundaries of a kind, found when first asked for; one inside a pre-token counts before it."""
        if kind not in self.places:
            ends = [m.end() for m in BOUNDARIES[kind].finditer(self.text)]
            self.places[kind] = np.unique(self.whole[np.searchsorted(self.offsets, ends, "right") - 1]).tolist()
        return self.places[kind]

    def legal(self, k: int) -> int:
        """The last boundary at or before token ``k`` that is no inside of a character."""
        while self.at[k] < 0:
            k -= 1
        return k

    def piece_size(self, s: int, e: int) -> int:
        """Tokens of the text between two token places, taken by itself.

        Pre-tokens come from a scan to the right that looks ahead only at the end of blanks, so those inside the piece are as in the whole text. Encoded
        anew are only the ones up to the first that starts where one does in the whole text, and from the last that isn't blank on.
        """
        a, z = self.at[s], self.at[e]
        i = int(np.searchsorted(self.whole, s))
        head = 0
        if self.whole[i] != s:
            pos, pre = a, []
            while True:
                m = self.e.scan.match(self.text, pos, z)
                if m is None:  # the piece ends before its scan meets the text's
                    return self.e.size(self.text[a:z])
                pre.append(m[0])
                pos = m.end()
                i = int(np.searchsorted(self.offsets, pos))
                if pos < z and self.offsets[i] == pos:
                    break
            head = sum(map(len, self.e.pre_ids(pre))) // 4
        j = int(np.searchsorted(self.whole, e, "right")) - 1
        if self.whole[j] == e:
            j -= 1
        while j > i and self.text[self.offsets[j] : self.offsets[j + 1]].isspace():
            j -= 1
        if j <= i:
            return self.e.size(self.text[a:z])
        return head + int(self.whole[j] - self.whole[i]) + self.e.size(self.text[self.offsets[j] : z])


def pieces(m: TokenMap, limit: int, overlap: int) -> list[tuple[int, int, int, int, int, str]]:
    """(start_token, end_token, start_char, end_char, n_tokens, boundary) of the pieces of a text of more than ``limit`` tokens.

    A piece ends at the last boundary of the strongest kind that leaves it at least half full, else at the last weaker one, else
    at the last character boundary (``hard``). The next piece starts ``overlap`` tokens before, at the last character
    boundary before that where it falls inside one (without overlap if that would be no step forward, as with limits of a few tokens). ``n_tokens`` is the size of the piece's own text and never exceeds ``limit``.
    """
    if not 0 <= 2 * overlap < limit or limit < 8:
        raise ValueError("the overlap must be under half the limit, the limit at least 8")
    out, s = [], 0
    while True:
        room = limit
        while True:
            most = s + room
            if most >= m.size:
                end, kind = m.size, "end"
            else:
                end, kind = -1, "hard"
                for name in BOUNDARIES:
                    places = m.natural(name)
                    i = bisect_right(places, most) - 1
                    if i >= 0 and places[i] > s + max(room // 2, overlap + 4):
                        end, kind = places[i], name
                        break
                if end < 0:
                    end = m.legal(most)
            n = m.piece_size(s, end)
            if n <= limit:
                break
            room -= n - limit  # cut inside a word, the ends may take more tokens than they did in the text
        out.append((s, end, m.at[s], m.at[end], n, kind))
        if end >= m.size:
            return out
        back = m.legal(end - overlap)
        s = back if back > s else end


def split_corpus(documents: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, vocabulary: str | None = None) -> DataFrame:
    """Pieces of every document: doc_id, piece_no (from 1), n_pieces, start_token, start_char, end_char, n_tokens, boundary, text.

    Texts within the limit are one piece (boundary ``whole``), empty ones one of 0 tokens, null ones one with null text and 0 tokens.
    Each row of ``documents`` is split by itself and whole, so equal rows give equal pieces.
    """
    encoder = shipped(documents, vocabulary)
    schema = pa.schema([("doc_id", pa.int64()), ("piece_no", pa.int32()), ("n_pieces", pa.int32()), ("start_token", pa.int32()), ("start_char", pa.int32()), ("end_char", pa.int32()), ("n_tokens", pa.int32()), ("boundary", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder()
        for b in batches:
            rows: list[tuple] = []
            texts = b.column(1).to_pylist()
            for doc, text, (ids, starts) in zip(b.column(0).to_pylist(), texts, e.marked(texts), strict=True):
                n = len(ids) // 4
                if n <= limit:
                    rows.append((doc, 1, 1, 0, 0, len(text or ""), n, "whole", text))
                else:
                    cut = pieces(TokenMap(e, text, ids, starts), limit, overlap)
                    rows += [(doc, k, len(cut), s, a, z, size, kind, text[a:z]) for k, (s, _, a, z, size, kind) in enumerate(cut, 1)]
                if len(rows) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, piece_no int, n_pieces int, start_token int, start_char int, end_char int, n_tokens int, boundary string, text string")
