"""Packing by vector bin packing with the dot-product heuristic.

Items have a size in three dimensions: tokens, segments and loss-bearing tokens.
A sequence takes, again and again, the fitting item whose size has the largest
dot product with the sequence's free space, dimensions scaled by capacity and
weighted by their total demand. Documents longer than a sequence are first cut
into whole sequences and a rest; when no rest fits any more, one item is cut to
fill the sequence, so that only the last sequence of a block is padded, and its
content is cut at powers of two, which need no padding.

Each partition packs its own documents in blocks of BLOCK_TOKENS tokens or so, or
BLOCK_ITEMS documents: no shuffle, memory bounded by a block and its longest
document. Items of one size are a group, so that a choice costs no more than there
are sizes. Sequence ids are
the partition's number and a running count, so a retried task repeats them.

A null or empty text is its end token alone. Repeated rows are packed each; an
empty table gives no piece; null ids are passed through.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from quire.llm.bpe import byte_letters
from quire.llm.spans import Memo, runs, text_buffer, word_spans

MAX_TOKENS, MAX_SEGMENTS = 2048, 256
BLOCK_TOKENS, BLOCK_ITEMS = 1 << 20, 1 << 16
END_ID = 1
REMEMBERED = 100_000
#: Outside Latin-1, not in composed form alone, or a control on which libraries differ about white space.
UNUSUAL = re.compile(r"[^\x00-\x1B\x20-\x84\x86-\x9F\xA1-\xFF]").search
# The pattern of the word-level pre-tokenizer, for lower-case Latin-1 text.
_LETTER, _DIGIT, _SPACE = r"a-zA-Z\xAA\xB5\xBA\xC0-\xD6\xD8-\xF6\xF8-\xFF", r"0-9\xB2\xB3\xB9\xBC-\xBE", r"\t-\r\x20\x85\xA0"
WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_SPACE}{_LETTER}{_DIGIT}]+").findall
LETTERS = byte_letters()


class Encoder:
    """Ids of texts, as the tokenizer gives them without special tokens added.

    If a probe shows that no id of the tokenizer reaches over ASCII white space and
    case doesn't matter, each distinct chunk between white space is encoded once; its
    ids lie in a pool, and a text's are gathered from there. Otherwise the library
    gets whole texts.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.model_ids = lambda w: [t.id for t in self.tokenizer.model.tokenize(w)]
        self.words: dict[str, list[int]] = {}
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo, self.pool, self.used = Memo(2_000_000), np.zeros(1 << 20, np.uint32), 0
        probe = "a,b's é12 !?x ßi'll ab 't word. :no Hello hello A  \n b"
        try:
            self.by_word = [i for w in probe.split() for i in self._chunk(w)] == self._whole(probe)
        except Exception:  # a model that can't take such letters isn't of this kind
            self.by_word = False

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _chunk(self, chunk: str) -> list[int]:
        if UNUSUAL(chunk) or "<" in chunk:
            return self._whole(chunk)
        out: list[int] = []
        for word in WORDS(chunk.lower()):
            ids = self.words.get(word)
            if ids is None:
                if len(self.words) >= REMEMBERED:
                    self.words.clear()
                ids = self.words[word] = self.model_ids("".join(map(LETTERS.__getitem__, word.encode())))
            out += ids
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each text of a UTF-8 buffer."""
        if not self.by_word:
            read = data.tobytes()
            texts = [read[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        hashes, first, last = word_spans(data, offsets)
        if self.memo.full() or self.used > 1 << 25:
            self.memo.clear()
            self.used = 0
        read = data.tobytes()

        def make(at: np.ndarray) -> np.ndarray:
            found = [self._chunk(read[a:b].decode()) for a, b in zip(first[at].tolist(), last[at].tolist(), strict=True)]
            n = np.array([len(x) for x in found], np.int64)
            flat = np.fromiter((i for x in found for i in x), np.uint32, int(n.sum()))
            if self.used + len(flat) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(flat)), np.uint32)])
            self.pool[self.used : self.used + len(flat)] = flat
            at_pool = self.used + np.cumsum(n) - n
            self.used += len(flat)
            return at_pool << 24 | n  # a chunk of 2**24 ids would be over 16 MB

        values = self.memo.get(hashes, make)
        n, start = values & (1 << 24) - 1, values >> 24
        ends = np.cumsum(n)
        ids = self.pool[np.repeat(start - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        cut = np.concatenate([[0], ends])[np.searchsorted(first, offsets)]
        return [ids[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


@functools.lru_cache(maxsize=4)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def pack(sizes: np.ndarray, limits: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start, length) for items of ``sizes`` (n x 3: tokens, segments, loss-bearing tokens).

    Every token of every item is in exactly one piece; no sequence exceeds ``limits``.
    Loss-bearing tokens are taken to lie evenly in an item, so that a cut item's share is its length's.
    """
    cap = int(limits[0])
    done: list[list[tuple[int, int, int]]] = []
    #: Rest of each item: where it starts, and its size.
    start, left = np.zeros(len(sizes), np.int64), sizes.astype(np.float64).copy()
    for i in np.flatnonzero(sizes[:, 0] >= cap):
        step = max(1, min(cap, int(cap * limits[2] / max(sizes[i, 2] * cap / sizes[i, 0], 1e-9))))
        whole = int(sizes[i, 0]) // step
        done += [[(int(i), k * step, step)] for k in range(whole)]
        start[i] = whole * step
        left[i, 0] -= whole * step
        left[i, 2] = sizes[i, 2] * left[i, 0] / sizes[i, 0]
    order = np.flatnonzero(left[:, 0] > 0)
    order = order[np.argsort(-left[order, 0], kind="stable")]
    # Rests of equal size are one group, a stack of items; a sequence chooses among groups.
    size, group = np.unique(left[order], axis=0, return_inverse=True)
    size, group = size[::-1], len(size) - 1 - group.ravel()
    by_group = np.argsort(group, kind="stable")
    stacks = [order[x][::-1].tolist() for x in np.split(by_group, np.cumsum(np.bincount(group, minlength=len(size)))[:-1])] if len(order) else []
    tokens, size, n_left = size[:, 0].astype(np.int64), size / limits, np.bincount(group, minlength=len(size))
    weight = (size * n_left[:, None]).sum(0) / max(float((size.sum(1) * n_left).sum()), 1e-12)
    known = {(int(t), float(z)): g for g, (t, z) in enumerate(zip(tokens, size[:, 2], strict=True))}
    while n_left.any():
        if 2 * np.count_nonzero(n_left) < len(n_left):
            on = np.flatnonzero(n_left)
            tokens, size, n_left, stacks = tokens[on], size[on], n_left[on], [stacks[g] for g in on]
            known = {(int(t), float(z)): g for g, (t, z) in enumerate(zip(tokens, size[:, 2], strict=True))}
        free, used, bin_ = np.ones(3), 0, []
        fits = n_left > 0
        while used < cap:
            fits &= (n_left > 0) & (size <= free + 1e-9).all(1)
            at = np.flatnonzero(fits)
            if not len(at):
                break
            g = int(at[np.argmax(size[at] @ (weight * free))]) if len(at) > 1 else int(at[0])
            # With one group left the choice stays the same until it no longer fits.
            n = 1 if len(at) > 1 else max(1, min(len(stacks[g]), int(((free + 1e-9) / np.maximum(size[g], 1e-12)).min())))
            for item in reversed(stacks[g][-n:]):
                bin_.append((item, int(start[item]), int(tokens[g])))
            del stacks[g][-n:]
            free, used, n_left[g] = free - n * size[g], used + n * int(tokens[g]), n_left[g] - n
        room = cap - used
        if n_left.any() and room and free[1] * limits[1] >= 1 - 1e-9:
            # Cut the longest rest that has more than the room; its share of loss-bearing tokens must fit.
            share = np.minimum(room, tokens * np.minimum(1, np.maximum(free[2], 0) / np.maximum(size[:, 2], 1e-12)))
            share = np.where(n_left > 0, np.floor(share), 0)
            g = int(np.argmax(share))
            cut = int(min(share[g], tokens[g] - 1))
            if cut >= 1:
                item = stacks[g].pop()
                bin_.append((item, int(start[item]), cut))
                rest, loss = int(tokens[g]) - cut, float(size[g, 2] * (tokens[g] - cut) / tokens[g])
                start[item], n_left[g] = start[item] + cut, n_left[g] - 1
                if (to := known.get((rest, loss))) is None:
                    to = known[rest, loss] = len(stacks)
                    tokens, n_left = np.append(tokens, rest), np.append(n_left, 0)
                    size = np.vstack([size, [rest / limits[0], size[g, 1], loss]])
                    stacks.append([])
                stacks[to].append(item)
                n_left[to] += 1
        if not bin_:
            raise ValueError("an item's demand exceeds a limit that cutting can't meet")
        done.append(bin_)
    return done


def _at_powers(bin_: list[tuple[int, int, int]], cap: int) -> list[list[tuple[int, int, int]]]:
    """A sequence that isn't full, cut where powers of two end, as those need no padding."""
    used = sum(p[2] for p in bin_)
    if used in (0, cap):
        return [bin_]
    out: list[list[tuple[int, int, int]]] = []
    room = 0
    rest = used
    for item, at, n in bin_:
        while n:
            if not room:
                room = 1 << (rest.bit_length() - 1)
                rest -= room
                out.append([])
            k = min(n, room)
            out[-1].append((item, at, k))
            at, n, room = at + k, n - k, room - k
    return out


def packed(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss_tokens: int | None = None, loss_tokens: str | None = None) -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids (little-endian uint32), doc_tokens, loss_tokens, sequence_id, offset.

    ``max_loss_tokens`` (by default max_tokens) is the limit of loss-bearing tokens. How many of a document's tokens,
    its end token included, bear loss is in the column ``loss_tokens``; all do without it or where it is null. They are
    taken to lie evenly in it: pieces have whole shares that add up to the document's number.
    """
    slim = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].cast("string").alias("text"), *([docs[f"`{loss_tokens}`"].cast("long").alias("loss")] if loss_tokens else []))
    kind = slim.schema["doc_id"].dataType.simpleString()
    limits = np.array([max_tokens, max_segments, max_loss_tokens or max_tokens], np.float64)
    end = np.array([END_ID], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, context = _encoder(tokenizer), TaskContext.get()
        next_id = (context.partitionId() if context else 0) << 40
        ids: list[np.ndarray] = []
        keys: list[object] = []
        given: list[int | None] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal next_id, held
            n = np.array([len(x) for x in ids])
            rows: list[tuple] = []
            loss = np.array([k if x is None else min(max(x, 0), k) for k, x in zip(n.tolist(), given, strict=True)], np.int64)
            bins = pack(np.stack([n, np.ones(len(n), np.int64), loss], 1), limits)
            for whole in bins:
                for bin_ in _at_powers(whole, max_tokens):
                    offset = borne = 0
                    for item, at, k in bin_:
                        own = int((at + k) * loss[item] // n[item] - at * loss[item] // n[item])
                        if borne + own > limits[2]:  # shares rounded up have passed the limit
                            next_id, offset, borne = next_id + 1, 0, 0
                        rows.append((keys[item], at, k, ids[item][at : at + k].tobytes(), len(ids[item]), own, next_id, offset))
                        offset, borne = offset + k, borne + own
                    next_id += 1
            ids.clear()
            keys.clear()
            given.clear()
            held = 0
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        schema = None
        for batch in batches:
            schema = schema or pa.schema([("doc_id", batch.schema.field(0).type)] + [(c, pa.int64()) for c in ("start", "length")] + [("ids", pa.binary())] + [(c, pa.int64()) for c in ("doc_tokens", "loss_tokens", "sequence_id", "offset")])
            data, at = text_buffer(batch.column(1))
            names = batch.column(0).to_pylist()
            losses = batch.column(2).to_pylist() if loss_tokens else [None] * len(names)
            for a, b in runs(at):
                for i, found in enumerate(encoder.encode(data[at[a] : at[b]], at[a : b + 1] - at[a]), a):
                    ids.append(np.append(found, end))
                    keys.append(names[i])
                    given.append(losses[i])
                    held += len(ids[-1])
                    if held >= BLOCK_TOKENS or len(ids) >= BLOCK_ITEMS:
                        yield flush()
        if ids:
            yield flush()

    return slim.mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, loss_tokens long, sequence_id long, offset long")
