"""Token counts by byte-pair merging with a heap over a linked list.

A pre-token's bytes are nodes of a doubly linked list. A heap holds adjacent
pairs by (merge rank, place); the lowest is popped, its nodes joined, and the
new neighbours pushed, until no pair has a rank. The count is the number of
initial symbols minus the merges: no token identifier is made.

Counts of distinct pre-tokens are kept in a bounded dictionary per worker.
Null and empty texts have 0 tokens; very long texts are read whole; an empty
table gives an empty table; repeated rows are counted row by row. Null ids are
passed through, and only the columns named are read, so other columns' names
don't matter.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from quire.llm.spans import SPACES, Memo, runs, text_buffer, word_spans

#: Pre-tokens that a worker remembers, and the longest that it does.
REMEMBERED, REMEMBERED_LENGTH = 500_000, 64
SYMBOL_BITS = 24
# The pattern of a byte-level pre-tokenizer, for texts of Latin-1 characters.
_LETTER, _DIGIT, _SPACE = r"A-Za-z\xAA\xB5\xBA\xC0-\xD6\xD8-\xF6\xF8-\xFF", r"0-9\xB2\xB3\xB9\xBC-\xBE", r"\t-\r\x20\x85\xA0"
LATIN_1 = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_SPACE}{_LETTER}{_DIGIT}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
#: White space outside ASCII, and controls that some take for it.
OTHER_SPACES = rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"


def byte_letters() -> list[str]:
    """The letter by which a byte-level vocabulary writes each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    others = (b for b in range(256) if b not in letters)
    return [c for _, c in sorted((letters | {b: chr(256 + i) for i, b in enumerate(others)}).items())]


class _Counts(dict[str, int]):
    """Counts of pre-tokens, made when first asked for and forgotten all at once when there are too many."""

    def __init__(self, count: Callable[[str], int]) -> None:
        super().__init__()
        self.count = count

    def __missing__(self, piece: str) -> int:
        n = self.count(piece)
        if len(piece) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = n
        return n


class ByteMerges:
    """Counts tokens as the byte-level model in a tokenizer's JSON file would make them."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec: dict[str, Any] = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("a byte-level BPE without a normalizer is needed")
        as_byte = {c: bytes([b]) for b, c in enumerate(byte_letters())}
        names: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        #: left symbol << SYMBOL_BITS | right symbol -> rank; the symbol that each rank makes
        self.ranks: dict[int, int] = {}
        self.joined: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = (b"".join(map(as_byte.__getitem__, p)) for p in (pair.split(" ") if isinstance(pair, str) else pair))
            self.joined.append(names.setdefault(left + right, len(names)))
            self.ranks.setdefault(names[left] << SYMBOL_BITS | names[right], rank)
        added = [re.escape(t["content"]) for t in spec["added_tokens"]]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take context aren't supported")
        self.added = re.compile("|".join(sorted(added, key=len, reverse=True))) if added else None
        self.latin = re.compile(LATIN_1).findall
        #: Other texts are split by the library, which writes each byte as a letter.
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.memo = Memo()
        added_bytes = [re.escape(t["content"].encode()) for t in spec["added_tokens"]]
        self.unusual = re.compile(b"|".join([OTHER_SPACES, *added_bytes])).finditer
        self.known = _Counts(lambda piece: self.merged(piece.encode()))
        self.known_letters = _Counts(lambda piece: self.merged(b"".join(map(as_byte.__getitem__, piece))))

    def merged(self, symbols: bytes) -> int:
        """Tokens of one pre-token."""
        n, rank_of, joined_by = len(symbols), self.ranks.get, self.joined
        shift = n.bit_length()
        value, left, right = list(symbols), list(range(-1, n - 1)), list(range(1, n + 1))
        # rank[i]: of the pair that starts at node i, -1 if none; an entry of the heap with another rank is out of date.
        rank = [rank_of(a << SYMBOL_BITS | b, -1) for a, b in zip(symbols, symbols[1:], strict=False)]
        heap = [r << shift | i for i, r in enumerate(rank) if r >= 0]
        heapq.heapify(heap)
        rank.append(-1)
        pop, push, last, merges = heapq.heappop, heapq.heappush, (1 << shift) - 1, 0
        while heap:
            entry = pop(heap)
            i, lowest = entry & last, entry >> shift
            if rank[i] != lowest:
                continue
            merges += 1
            j = right[i]
            value[i] = joined = joined_by[lowest]
            after = right[i] = right[j]
            rank[j] = rank[i] = -1
            if after < n:
                left[after] = i
                if (r := rank_of(joined << SYMBOL_BITS | value[after], -1)) >= 0:
                    rank[i] = r
                    push(heap, r << shift | i)
            if (before := left[i]) >= 0:
                rank[before] = r = rank_of(value[before] << SYMBOL_BITS | joined, -1)
                if r >= 0:
                    push(heap, r << shift | before)
        return n - merges

    def plain(self, text: str) -> int:
        """Tokens of a text without added tokens."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return sum(self.known_letters[piece] for piece, _ in self.split(text))
        return sum(map(self.known.__getitem__, self.latin(text)))

    def whole(self, text: str) -> int:
        """Tokens of a text; added tokens' strings inside it are one token each."""
        if self.added is None or not (found := self.added.findall(text)):
            return self.plain(text)
        return len(found) + sum(map(self.plain, self.added.split(text)))

    def count(self, text: str) -> int:
        data = np.frombuffer(text.encode(), np.uint8)
        return int(self.counts(data, np.array([0, len(data)]))[0])

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text of a buffer.

        Pre-tokens don't reach over ASCII white space but for one space before a
        word, so words are counted once for each form and the white space between
        them apart. Texts with other white space or an added token are read alone.
        """
        hashes, first, last = word_spans(data, offsets, fold_case=False)
        if self.memo.full():
            self.memo.clear()
        text_of = np.searchsorted(offsets, first, "right") - 1
        gap = first - np.maximum(np.concatenate([[0], last[:-1]]), offsets[text_of]) if len(first) else first
        before = data[np.maximum(first - 1, 0)]
        spaced = (gap > 0) & (before == 0x20)
        read = data.tobytes()
        make = lambda at: np.array([self.plain((" " if spaced[i] else "") + read[first[i] : last[i]].decode()) for i in at.tolist()], np.int64)
        tokens = self.memo.get(hashes ^ np.where(spaced, np.uint64(0x5BD1E995A5A5A5A5), np.uint64(0)), make)
        # The last character before a word is a pre-token unless it is a space; those before it are one.
        single = np.zeros(256, np.int64)
        single[list(SPACES)] = [self.known[chr(c)] for c in SPACES]
        tokens += np.where((gap > 0) & ~spaced, single[before], 0)
        for i in np.flatnonzero(gap > 1).tolist():
            tokens[i] += self.known[read[first[i] - gap[i] : first[i] - 1].decode()]
        sums = np.concatenate([[0], np.cumsum(tokens)])
        word = np.searchsorted(first, offsets)
        out = sums[word[1:]] - sums[word[:-1]]
        ends = np.where(word[1:] > word[:-1], last[np.maximum(word[1:] - 1, 0)] if len(last) else 0, offsets[:-1])
        for t in np.flatnonzero(offsets[1:] > ends).tolist():
            out[t] += self.known[read[ends[t] : offsets[t + 1]].decode()]
        odd = {int(np.searchsorted(offsets, m.start(), "right")) - 1 for m in self.unusual(read)}
        for t in odd:
            out[t] = self.whole(read[offsets[t] : offsets[t + 1]].decode())
        return out


@functools.lru_cache(maxsize=4)
def _model(path: str) -> ByteMerges:
    return ByteMerges(path)


def token_counts(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every whole text. ``tokenizer``: path of a JSON file on every executor."""
    slim = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(tokenizer)
        for batch in batches:
            data, at = text_buffer(batch.column(1))
            counts = [model.counts(data[at[a] : at[b]], at[a : b + 1] - at[a]) for a, b in runs(at, 4 << 20)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at)), pa.array(np.concatenate([np.zeros(0, np.int64), *counts]))], ["doc_id", "n_bytes", "n_tokens"])

    return slim.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
