"""LM scoring by masked pseudo-likelihood.

A small network predicts every word from the two on each side: the sum of one vector
per neighbour and position, tanh, then a softmax over ``CLASSES`` word classes. A word's probability
is that of its class by the network times its own within the class. A
document's score is the sum of log-probabilities of all its words, each masked in turn.

What is learnt comes from the whole corpus and grows with it. All words of all documents
are counted; the most frequent have classes of their own, the rest share hashed ones. Within a shared class a
word has (n + ``ALPHA``) / (N + ``ALPHA`` (V + 1)) by its count n, the class's N occurrences of V words; the one place
more is that of unseen words. The counts are a table, joined to the distinct words of runs of about ``HELD`` such words.
Every word of every document is a training window, in each of the ``ROUNDS`` rounds. The training table holds the
texts as sequences of classes, a byte a word. Training is numpy in tasks: each takes steps over its share of that table from the
common parameters, and parameters are averaged by the windows seen.
The driver holds the parameters only, whose number is fixed. Up to ``SHARDS`` tasks train at a time,
so what is averaged is bounded too.

Defined cases: a NULL, empty or blank text has no words and log-likelihood 0 and a NULL mean. Every row is
scored by itself, repeated or not; further columns are ignored. An empty table gives an
empty result. Texts at a file's edges are not neighbours.
"""

from types import SimpleNamespace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from runlake.llm import common
from runlake.llm.common import Words, arrow_friendly, text_bytes
from runlake.session import materialize

CLASSES, HASHED, WIDTH = 256, 64, 16
SIDES = (-2, -1, 1, 2)
ROUNDS, STEP, RATE = 3, 1024, 0.1
SHARDS, SHARD_WINDOWS = 1024, 500_000
ALPHA = 0.5
HELD = 1 << 20  # words of shared classes, and rows, whose distinct words are looked up together
COUNTED = 1 << 20  # distinct words a task holds before it passes its counts on
BLOCK = 208  # windows whose values of all classes stay in a core's cache
LOG2E = np.float32(np.log2(np.e))


def chunks(offsets):
    """Row ranges whose words stay in a core's cache."""
    return common.chunks(offsets, common.CHUNK_BYTES // 4)


def _count(batches):
    split = Words()
    nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    held, size = [nothing], 0

    def merged():
        words, n = (np.concatenate(x) for x in zip(*held))
        word, at = np.unique(words, return_inverse=True)
        return word, np.bincount(at, n, len(word)).astype(np.int64)

    def out(word, n):
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])
    for batch in batches:
        data, offsets = text_bytes(batch.column(0))
        for low, high in chunks(offsets):
            _, _, _, hashes = split(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
            held.append(np.unique(hashes, return_counts=True))
            size += len(held[-1][0])
            if size > 2 * COUNTED:  # merged seldom, as a merge sorts all that is held
                held = [merged()]
                size = len(held[0][0])
                if size > COUNTED:
                    yield out(*held[0])
                    held, size = [nothing], 0
    yield out(*merged())


class Vocabulary(NamedTuple):
    frequent: np.ndarray  # sorted hashes of the words with classes of their own
    total: np.ndarray  # occurrences of each shared class's words
    distinct: np.ndarray  # and how many words they are
    counts: DataFrame | None  # (word, n) of every word

    def small(self) -> "Vocabulary":
        """What tasks are sent."""
        return self._replace(counts=None)


def vocabulary(docs: DataFrame) -> Vocabulary:
    """All words of the corpus; the most frequent, ties by hash, have classes of their own."""
    arrow_friendly(docs.sparkSession)
    counts = materialize(docs.select(F.col("text").cast("string")).mapInArrow(
        _count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    top = counts.orderBy(F.desc("n"), "word").limit(CLASSES - HASHED - 1).toArrow()
    frequent = top.column("word").to_numpy().astype(np.int64).view(np.uint64)
    held = counts.groupBy(F.shiftrightunsigned("word", 58).cast("int").alias("c")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).toArrow()
    c = held.column("c").to_numpy().astype(np.int64)
    shared = (frequent >> np.uint64(58)).astype(np.int64)
    total, distinct = (np.bincount(c, held.column(x).to_numpy(), HASHED) for x in ("n", "v"))
    total -= np.bincount(shared, top.column("n").to_numpy(), HASHED)
    return Vocabulary(np.sort(frequent), total, distinct - np.bincount(shared, minlength=HASHED), counts)


class Windows:
    """Class of every word, with those of its neighbours; class 0 is beyond a text's edge."""

    def __init__(self, words: Vocabulary):
        self.split, self.frequent = Words(), words.frequent
        # A word's first bits name the one frequent word that it may be, by its class; they are as many as keep those apart.
        bits = next((b for b in range(8, 23) if len(np.unique(self.frequent >> np.uint64(64 - b))) == len(self.frequent)), None)
        self.shift = bits and np.uint64(64 - bits)
        if bits:
            self.first = np.zeros(1 << bits, np.uint8)
            self.first[self.frequent >> self.shift] = np.arange(1, len(self.frequent) + 1)
            self.word_of = np.concatenate((np.zeros(1, np.uint64), self.frequent))

    def classes(self, hashes):
        own = (CLASSES - HASHED + (hashes >> np.uint64(58)).astype(np.int64)).astype(np.uint8)
        if self.shift:
            at = self.first.take(hashes >> self.shift, mode="clip")
            return np.where((self.word_of.take(at) == hashes) & (at > 0), at, own)
        at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
        return np.where(self.frequent[at] == hashes, at + 1, own).astype(np.uint8)

    def __call__(self, data, offsets):
        """Row and hash of every word, and a matrix of (left, left, word, right, right) classes."""
        _, _, rows, hashes = self.split(data, offsets)
        classes = self.classes(hashes)
        n = len(rows)
        out = np.zeros((n, 5), np.uint8)
        for side in (-2, -1, 0, 1, 2):
            low, high = max(0, -side), n - max(0, side)
            if low < high:
                near = np.where(rows[low:high] == rows[low + side:high + side], classes[low + side:high + side], 0)
                out[low:high, side + 2] = near
        return rows, hashes, out


EDGE = bytes(2)  # the class beyond a text's edge, as far as a window reaches


def _sequences(words):
    """Per chunk, the classes of all words in order, with an edge before, between and after the texts."""
    def run(batches):
        windows = Windows(words)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for low, high in chunks(offsets):
                _, _, rows, hashes = windows.split(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
                out = np.zeros(len(rows) + 2 * (high - low), np.uint8)
                out[np.arange(len(rows)) + 2 * rows] = windows.classes(hashes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([EDGE + out.tobytes()], pa.binary()), pa.array([len(rows)], pa.int64())], ["classes", "n"])
    return run


def windows_of(classes: bytes) -> np.ndarray:
    """The (left, left, word, right, right) classes of every word of a sequence."""
    line = np.frombuffer(classes, np.uint8)
    at = np.flatnonzero(line)
    return np.stack([line[at + side] for side in (-2, -1, 0, 1, 2)], 1)


class Network:
    """near: (side, class, width); out: (class, width); bias by class."""

    shapes = ((len(SIDES), CLASSES, WIDTH), (CLASSES, WIDTH), (CLASSES,))

    def __init__(self, flat: np.ndarray | None = None):
        if flat is None:
            rng = np.random.default_rng(5)
            self.near, self.out = (rng.normal(0, 0.1, s).astype(np.float32) for s in self.shapes[:2])
            self.bias = np.zeros(CLASSES, np.float32)
        else:
            cut = np.cumsum([int(np.prod(s)) for s in self.shapes])[:-1]
            self.near, self.out, self.bias = (p.reshape(s).astype(np.float32) for p, s in zip(np.split(flat, cut), self.shapes))

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in (self.near, self.out, self.bias)]).astype(np.float64)

    def hidden(self, windows):
        """Hidden values, with a last column of ones."""
        total = self.near[0].take(windows[:, SIDES[0] + 2], 0)
        for i, side in enumerate(SIDES[1:], 1):
            total += self.near[i].take(windows[:, side + 2], 0)
        out = np.ones((len(windows), WIDTH + 1), np.float32)
        out[:, :WIDTH] = np.tanh(total, out=total)
        return out

    def weights(self):
        """What makes logits of hidden values, as powers of two, and whether one can be over 60 as a power of e."""
        out = np.concatenate((self.out.T, self.bias[None])) * LOG2E
        return out, np.abs(out).sum(0).max() > 60 * LOG2E

    def blocks(self, hidden, weights, large):
        """First row of each block of rows, and exp(logits) in a buffer that the next block overwrites."""
        if not hasattr(self, "cells"):
            self.cells = np.empty((BLOCK, CLASSES), np.float32)
        for low in range(0, len(hidden), BLOCK):
            part = hidden[low:low + BLOCK]
            cells = np.matmul(part, weights, out=self.cells[:len(part)])
            if large:
                np.minimum(cells, 60 * LOG2E, out=cells)
            yield low, np.exp2(cells, out=cells)

    def log_probabilities(self, windows) -> np.ndarray:
        weights, ones = self.weights(), np.ones(CLASSES, np.float32)
        own, total = np.empty(len(windows), np.float32), np.empty(len(windows), np.float32)
        for start in range(0, len(windows), STEP):
            part = windows[start:start + STEP]
            at = np.arange(len(part)) % BLOCK * CLASSES + part[:, 2]
            for low, cells in self.blocks(self.hidden(part), *weights):
                high = low + len(cells)
                cells.ravel().take(at[low:high], out=own[start + low:start + high])
                np.matmul(cells, ones, out=total[start + low:start + high])
        return np.log(own / total)

    def room(self, n):
        """What a step over ``n`` windows writes to, kept from step to step."""
        if not hasattr(self, "kept") or len(self.kept.first) != n:
            rows, classes, half = (n, WIDTH), (CLASSES, WIDTH + 1), WIDTH // 2
            self.kept = SimpleNamespace(
                first=np.arange(n) % BLOCK * CLASSES, total=np.empty(n, np.float32), hidden=np.ones((n, WIDTH + 1), np.float32),
                **{x: np.empty((n, WIDTH + 1), np.float32) for x in ("sums", "scaled")}, **{x: np.empty(rows, np.float32) for x in ("tanh", "some", "back")},
                with_one=np.ones(classes, np.float32), **{x: np.empty(classes, np.float32) for x in ("out", "more")},
                pairs=np.arange(CLASSES * half).reshape(-1, half), at=np.empty((n, half), np.intp),
                slopes=[np.empty(s, np.float32) for s in self.shapes], steps=[np.empty(s, np.float32) for s in self.shapes])
        return self.kept

    def train(self, windows, past):
        """One AdaGrad step over the windows."""
        n = len(windows)
        room, classes = self.room(n), windows.T.astype(np.intp)
        target, sides = classes[2], [classes[side + 2] for side in SIDES]
        hidden = self.near[0].take(sides[0], 0, out=room.tanh, mode="clip")
        for near, side in zip(self.near[1:], sides[1:]):
            hidden += near.take(side, 0, out=room.some, mode="clip")
        room.hidden[:, :WIDTH] = np.tanh(hidden, out=hidden)
        room.with_one[:, :WIDTH] = self.out
        at, out = room.first + target, room.out
        for low, cells in self.blocks(room.hidden, *self.weights()):
            high = low + len(cells)
            total, line, own = room.total[low:high], cells.reshape(-1), at[low:high]
            total[:] = np.matmul(cells, room.with_one, out=room.sums[low:high])[:, WIDTH]
            line[own] = line.take(own) - total
            total *= np.float32(n)
            scaled = np.divide(room.hidden[low:high], total[:, None], out=room.scaled[low:high])
            if low:
                out += np.matmul(cells.T, scaled, out=room.more)
            else:
                np.matmul(cells.T, scaled, out=out)
        back = self.out.take(target, 0, out=room.back, mode="clip")
        back *= room.sums[:, WIDTH:]
        np.subtract(room.sums[:, :WIDTH], back, out=back)
        slope = np.subtract(1, np.multiply(hidden, hidden, out=hidden), out=hidden)
        slope /= room.total[:, None]
        back *= slope
        # Numbers of a class's vector for a side are added up in pairs, as complex ones.
        back, slopes = back.view(np.complex64).ravel(), room.slopes
        slopes[0][:] = 0
        for slope, side in zip(slopes[0], sides):
            np.add.at(slope.view(np.complex64).ravel(), room.pairs.take(side, 0, out=room.at, mode="clip").ravel(), back)
        slopes[1][:], slopes[2][:] = out[:, :WIDTH], out[:, WIDTH]
        for values, g, seen, step in zip((self.near, self.out, self.bias), slopes, past, room.steps):
            seen += np.multiply(g, g, out=step)
            g *= np.float32(RATE)
            values -= np.divide(g, np.sqrt(seen, out=step), out=step)


def _train(flat):
    def run(batches):
        net = Network(flat)
        past = [np.full(s, 1e-4, np.float32) for s in Network.shapes]
        seen, rest = 0, np.zeros((0, 5), np.uint8)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                rest = np.concatenate((rest, windows_of(blob)))
                while len(rest) >= STEP:
                    net.train(rest[:STEP], past)
                    rest, seen = rest[STEP:], seen + STEP
        if len(rest):
            net.train(rest, past)
            seen += len(rest)
        values = net.flat() * seen
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values), pa.array(np.full(len(values), seen, np.int64))],
            ["i", "v", "n"])
    return run


def train(docs: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> Network:
    """Fit on every word of all ``docs`` (text)."""
    arrow_friendly(docs.sparkSession)
    texts = materialize(docs.select(F.col("text").cast("string")).mapInArrow(
        _sequences(words.small()), "classes binary, n long").filter("n > 0"), "windows")
    total = texts.agg(F.sum("n")).first()[0] or 0
    net = Network()
    shards = texts.select("classes").coalesce(max(1, min(SHARDS, -(-total // SHARD_WINDOWS))))
    for _ in range(rounds if total else 0):
        mean = (shards.mapInArrow(_train(net.flat()), "i int, v double, n long").groupBy("i")
                .agg((F.sum("v") / F.sum("n")).alias("v")).toArrow())
        flat = np.zeros(mean.num_rows)
        flat[mean.column("i").to_numpy()] = mean.column("v").to_numpy()
        net = Network(flat)
    return net


def _classed(words, flat):
    """Rows of a run of texts: their classes' log-probability, and the words of shared classes as places in a list of distinct ones."""
    def run(batches):
        windows, net, held, size = Windows(words), Network(flat), [], 0

        def out():
            ids, n, total, shared, hashes = zip(*held)
            word, place = np.unique(np.concatenate(hashes), return_inverse=True)
            lists = [pa.concat_arrays(ids), *(pa.array(np.concatenate(x)) for x in (n, total, shared)), pa.array(word.view(np.int64))]
            # The places byte by byte, so that the zeros of small numbers stand together.
            place = place.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
            return pa.RecordBatch.from_arrays(
                [*(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists), pa.array([place], pa.binary())],
                ["doc_id", "n", "total", "shared", "word", "place"])
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for low, high in common.chunks(offsets):
                rows, hashes, near = windows(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
                logs, shared = net.log_probabilities(near).astype(float), near[:, 2] >= CLASSES - HASHED
                held.append((batch.column(0).slice(low, high - low), np.bincount(rows, minlength=high - low),
                             np.bincount(rows, logs, high - low).astype(float), np.bincount(rows[shared], minlength=high - low), hashes[shared]))
                size += len(held[-1][-1]) + high - low
                if size >= HELD:
                    yield out()
                    held.clear()
                    size = 0
        if held:
            yield out()
    return run


def _whole(total, distinct):
    """Adds the log-probabilities within classes; ``found``: counts (pos, n) of those of a run's distinct words that have one."""
    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        doc_id, n, of_classes, shared, kind = (texts.column(c).combine_chunks().flatten() for c in ("doc_id", "n", "total", "shared", "kind"))
        kind, shared = kind.to_numpy(), shared.to_numpy()
        times = np.zeros(len(kind))
        times[found.column("pos").to_numpy()] = found.column("n").to_numpy()
        logs = np.log((times + ALPHA) / (total[kind] + ALPHA * (distinct[kind] + 1)))
        place = np.frombuffer(texts.column("place")[0].as_py(), np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()
        within = np.bincount(np.repeat(np.arange(len(shared)), shared), logs[place], len(shared))
        return pa.table({"doc_id": doc_id, "n_tokens": n, "log_likelihood": pa.array(of_classes.to_numpy() + within)})
    return run


def score(docs: DataFrame, words: Vocabulary, net: Network) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_probability) of every row of ``docs`` (doc_id, text)."""
    arrow_friendly(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _classed(words.small(), net.flat()),
        "doc_id array<long>, n array<long>, total array<double>, shared array<long>, word array<long>, place binary")
    texts = materialize(texts.withColumn("run", F.monotonically_increasing_id()), "runs")
    found = texts.select("run", F.posexplode("word").alias("pos", "word")).join(words.counts, "word").select("run", "pos", "n")
    kind = F.transform("word", lambda w: F.shiftrightunsigned(w, 58).cast("byte"))
    lines = texts.select(F.col("run").alias("of"), "doc_id", "n", "total", "shared", kind.alias("kind"), "place")
    scored = lines.groupBy("of").cogroup(found.groupBy("run")).applyInArrow(
        _whole(words.total, words.distinct), "doc_id long, n_tokens long, log_likelihood double")
    return scored.withColumn("mean_log_probability", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
