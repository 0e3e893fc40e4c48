"""Byte-level BPE encoding and decoding over padded numpy matrices.

A text is cut by the tokenizer's pattern. Each piece is encoded by itself: a piece
that is in the vocabulary is its id; any other starts as its bytes, and every round
each row of a matrix merges its leftmost pair of smallest rank until none is left.
Pieces of similar length share a matrix (length buckets, padded with -1); pair ranks are
looked up in an open-addressed hash table; merged rows are closed up, and finished rows
leave the matrix. A worker keeps the ids of pieces it has met, up to a bound.

Defined cases: a NULL or empty text has no ids and decodes to no bytes. Every row is
encoded by itself; further columns are ignored. An empty table gives an empty result.
Text that looks like a special token is ordinary text.
"""

import base64

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from runlake.llm.common import arrow_friendly, chunks, mix, text_bytes

# Pieces whose ids a worker remembers, and cells of one matrix.
KNOWN_PIECES = 1 << 17
MATRIX_CELLS = 1 << 17
# Bytes of text encoded at once, and ids decoded at once; a longer text is by itself.
ENCODED_BYTES = 1 << 18
DECODED_IDS = 1 << 16
NO_RANK = np.int32(2**31 - 1)


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by id, from a rank file of ``base64 id`` lines."""
    with open(path, "rb") as f:
        ranks = {int(i): base64.b64decode(t) for t, i in map(bytes.split, f)}
    assert sorted(ranks) == list(range(len(ranks))), "ids must be 0 to n-1"
    return [ranks[i] for i in range(len(ranks))]


class PairTable:
    """Rank of the token that two adjacent tokens make, by linear probing over numpy arrays."""

    def __init__(self, tokens: list[bytes]):
        ids = {t: i for i, t in enumerate(tokens)}
        pairs = [(ids[t[:k]] << 32 | ids[t[k:]], i) for i, t in enumerate(tokens) for k in range(1, len(t))
                 if t[:k] in ids and t[k:] in ids]
        size = 1 << (2 * len(pairs) + 1).bit_length()
        self.mask = np.uint64(size - 1)
        self.keys, self.ranks = np.full(size, -1, np.int64), np.full(size, NO_RANK, np.int32)
        keys, ranks = (np.array(c) for c in zip(*pairs)) if pairs else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == -1
            at, first = np.unique(np.where(free, slots, -1), return_index=True)
            first = first[at >= 0]
            self.keys[slots[first]], self.ranks[slots[first]] = keys[first], ranks[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, ranks, slots = keys[rest], ranks[rest], self._next(slots[rest])

    def _slots(self, keys):
        return (mix(keys.astype(np.uint64)) & self.mask).astype(np.int64)

    def _next(self, slots):
        return (slots + 1) & int(self.mask)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        shape = left.shape
        left, right = left.ravel().astype(np.int64), right.ravel().astype(np.int64)
        out = np.full(len(left), NO_RANK, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left[todo] << 32 | right[todo]
        slots = self._slots(keys)
        while len(todo):
            held = self.keys[slots]
            hit = held == keys
            out[todo[hit]] = self.ranks[slots[hit]]
            go = ~hit & (held != -1)
            todo, keys, slots = todo[go], keys[go], self._next(slots[go])
        return out.reshape(shape)


def merge(rows: np.ndarray, pairs: PairTable) -> list[np.ndarray]:
    """Merge every row (token ids, padded at the end with -1) until it holds no pair; its ids."""
    out: list = [None] * len(rows)
    where = np.arange(len(rows))
    ranks = pairs(rows[:, :-1], rows[:, 1:])
    while len(rows):
        if ranks.shape[1]:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
        else:
            best = np.full(len(rows), NO_RANK)
        done = best == NO_RANK
        for i in np.flatnonzero(done):
            out[where[i]] = rows[i][rows[i] >= 0]
        if done.all():
            break
        live = ~done
        rows, ranks, at, best, where = rows[live], ranks[live], at[live], best[live], where[live]
        n = np.arange(len(rows))
        rows[n, at] = best
        # Close up: drop the pair's right token, and the rank that began at it.
        columns = np.arange(rows.shape[1] - 1)
        rows = np.take_along_axis(rows, columns + (columns > at[:, None]), 1)
        columns = columns[:-1]
        ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), 1)
        if ranks.shape[1]:
            for start in (at - 1, at):
                ok = np.flatnonzero((start >= 0) & (start < ranks.shape[1]))
                ranks[ok, start[ok]] = pairs(rows[ok, start[ok]], rows[ok, start[ok] + 1])
    return out


class Encoder:
    """Ids of texts; remembers pieces in flat arrays."""

    def __init__(self, tokens: list[bytes], pairs: PairTable, pattern: str):
        self.whole = {t: i for i, t in enumerate(tokens)}
        self.pairs, self.cut = pairs, regex.compile(pattern).findall
        self.byte = np.array([self.whole[bytes([b])] for b in range(256)], np.int32)
        self.known, self.ids = {}, np.zeros(0, np.int32)
        self.begin = self.count = np.zeros(0, np.int64)
        self.again = np.zeros(0, bool)  # pieces met in a later call than the one that learnt them, or that last forgot

    def forget(self):
        """Only pieces met again stay, if they leave room for others."""
        keep = np.flatnonzero(self.again)
        if len(keep) > KNOWN_PIECES // 2:
            keep = keep[:0]
        pieces = list(self.known)
        self.known = {pieces[k]: i for i, k in enumerate(keep.tolist())}
        self.ids, self.count = self.ids[ragged(self.begin[keep], self.count[keep])], self.count[keep]
        self.begin, self.again = np.cumsum(self.count) - self.count, np.zeros(len(keep), bool)

    def _learn(self, pieces: list[str]):
        raw = [p.encode() for p in pieces]
        found = [np.array([self.whole[r]], np.int32) if r in self.whole else None for r in raw]
        sizes = np.array([0 if f is not None else len(r) for f, r in zip(found, raw)])
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] > 0]
        while len(order):
            width = 1 << int(sizes[order[0]] - 1).bit_length()
            bucket = order[:min(np.searchsorted(sizes[order], width, "right"), max(1, MATRIX_CELLS // width))]
            order = order[len(bucket):]
            rows = np.full((len(bucket), int(sizes[bucket].max())), -1, np.int32)
            for i, k in enumerate(bucket):
                rows[i, :sizes[k]] = self.byte[np.frombuffer(raw[k], np.uint8)]
            for k, ids in zip(bucket, merge(rows, self.pairs)):
                found[k] = ids
        counts = np.array([len(f) for f in found], np.int64)
        for i, p in enumerate(pieces, len(self.known)):
            self.known[p] = i
        self.begin = np.concatenate((self.begin, len(self.ids) + np.cumsum(counts) - counts))
        self.count = np.concatenate((self.count, counts))
        self.ids = np.concatenate((self.ids, *found))
        self.again = np.concatenate((self.again, np.zeros(len(pieces), bool)))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        pieces = [self.cut(t) for t in texts]
        fresh = set().union(*pieces)
        if len(self.known) + len(fresh) > KNOWN_PIECES:
            self.forget()
        fresh, before = list(fresh.difference(self.known)), len(self.known)
        if fresh:
            self._learn(fresh)
        look = self.known.__getitem__
        index = [np.fromiter(map(look, p), np.int64, len(p)) for p in pieces]
        sizes = np.array([self.count[i].sum() for i in index], np.int64)
        index = np.concatenate(index) if index else np.zeros(0, np.int64)
        self.again[index[index < before]] = True
        return self.ids[ragged(self.begin[index], self.count[index])], sizes


def ragged(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Positions begin, begin+1, ... of every run, one after the other."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _encode(tokens, pairs, pattern):
    def run(batches):
        encode = Encoder(tokens, pairs, pattern)
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            for low, high in chunks(offsets, ENCODED_BYTES):
                part = batch.slice(low, high - low)
                ids, sizes = encode([t or "" for t in part.column(1).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "ids"])
    return run


def _decode(tokens):
    def run(batches):
        blob = np.frombuffer(b"".join(tokens), np.uint8)
        count = np.array([len(t) for t in tokens], np.int64)
        begin = np.cumsum(count) - count
        for batch in batches:
            sizes = batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            for low, high in chunks(np.concatenate(([0], np.cumsum(sizes))), DECODED_IDS):
                part = batch.slice(low, high - low)
                lists = part.column(1)
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                data = blob[ragged(begin[ids], count[ids])]
                ends = np.concatenate(([0], np.cumsum(count[ids])))
                cuts = ends[np.concatenate(([0], np.cumsum(sizes[low:high])))].astype(np.int32)
                decoded = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(data.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column(0), lists, decoded], ["doc_id", "ids", "decoded"])
    return run


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text).

    ``ranks`` is the vocabulary file, read by the driver; tasks get its contents, a
    few MB whatever the input.
    """
    arrow_friendly(docs.sparkSession)
    tokens = read_ranks(ranks)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _encode(tokens, PairTable(tokens), pattern), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes that the ids of each row stand for; NULL ids stand for none."""
    arrow_friendly(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(_decode(read_ranks(ranks)), "doc_id long, ids array<int>, decoded binary")
