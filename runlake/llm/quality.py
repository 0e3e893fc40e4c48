"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document's features are its hashed words (term frequencies of norm 1), statistics of its
text's structure, and its declared length (``n_chars``) as metadata. The score is the
logistic of bias, weights and all pairwise interactions through vectors of ``FACTORS``
numbers; the sum-of-squares identity makes those linear in the features:
2 * sum_{i<j} <v_i, v_j> x_i x_j = sum_f (sum_i v_if x_i)^2 - sum_i (v_if x_i)^2.

Labels, language, source and ``doc_id`` are never features. The machine is fitted in
numpy on at most ``TRAIN_ROWS`` labelled rows, those with the smallest hash of ``doc_id``, all rows of an id or none;
their features alone reach the driver. Scoring is one pass over the documents.

Defined cases: a NULL or empty text has its (zero) structure statistics and a score like
any other; a NULL ``n_chars`` counts as the average. Every row is scored by itself, repeated or not. A
document with several labels has the lowest; NULL labels don't count. Without labels every
score is 0.5. Further columns are ignored. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from runlake.llm.common import Words, arrow_friendly, chunks, shingle_sets, text_bytes

TRAIN_ROWS = 20_000
WORD_BITS, FACTORS = 12, 8
EPOCHS, BATCH, RATE, DECAY = 8, 128, 0.08, 2e-5
ACCEPT = 0.7
CLIP = 4.0  # standard deviations

_BYTES = {  # shares of a text's bytes
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "blank": (32, 9), "line": (10, 13),
    "stop": b".!?", "comma": b",;:", "shout": b"!?", "mark": b"#$%&*+=<>@^~_\\/", "bar": b"|", "quote": b"\"'`",
    "bracket": b"()[]{}", "far": range(128, 256)}


class Features:
    """Sparse word features and dense statistics of a batch, chunk by chunk."""

    def __init__(self):
        self.words, self.lines = Words(), Words(lower=False)
        self.lines.space[:] = False
        self.lines.space[[10, 13]] = True
        self.classes = [np.isin(np.arange(256), list(values)) for values in _BYTES.values()]

    def __call__(self, column, n_chars):
        """Per chunk: number of rows, (row, bucket, value) of words, statistics by row."""
        data, offsets = text_bytes(column)
        for low, high in chunks(offsets):
            part, base = data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
            yield self._chunk(part, base, n_chars[low:high])

    def _chunk(self, data, offsets, n_chars):
        n = len(offsets) - 1
        starts, ends, rows, hashes = self.words(data, offsets)
        key, count = np.unique(rows << WORD_BITS | (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64), return_counts=True)
        row, value = key >> WORD_BITS, count.astype(float)
        norm = np.sqrt(np.bincount(row, value * value, n))
        _, _, line_rows, line_hashes = self.lines(data, offsets)
        _, _, distinct_lines = shingle_sets(line_hashes, line_rows, n, 1)
        _, _, distinct_runs = shingle_sets(hashes, rows, n, 3)
        words, lines = np.bincount(rows, minlength=n), np.bincount(line_rows, minlength=n)
        size = np.diff(offsets)

        def per(total, of):
            return total / np.maximum(of, 1)
        length = (ends - starts).astype(float)
        mean = per(np.bincount(rows, length, n), words)
        last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
        lettered = self.classes[0][last] | self.classes[1][last] | self.classes[2][last] | self.classes[12][last]
        top = np.zeros(n)
        np.maximum.at(top, row, value)
        stats = [np.log1p(size), np.log1p(words), np.log1p(lines), mean,
                 np.sqrt(np.maximum(per(np.bincount(rows, length * length, n), words) - mean * mean, 0)),
                 per(np.bincount(row, minlength=n), words), per(top, words), per(distinct_lines, lines),
                 per(distinct_runs, np.maximum(words - 2, 1)), per(words, lines), per(np.bincount(rows, ~lettered, n), words)]
        for members in self.classes:
            sums = np.concatenate(([0], np.cumsum(members[data])))
            stats.append(per(sums[offsets[1:]] - sums[offsets[:-1]], size))
        stats.append(np.log1p(np.maximum(n_chars, 0)))  # NaN where not declared
        return n, row, key & (1 << WORD_BITS) - 1, value / norm[row], np.stack(stats, 1)


def _lengths(column) -> np.ndarray:
    return column.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)


def _gather(batches):
    features = Features()
    for batch in batches:
        done = 0
        for n, row, bucket, value, stats in features(batch.column(0), _lengths(batch.column(1))):
            ends = np.searchsorted(row, np.arange(n + 1))
            out = [[], [], []]
            for i in range(n):
                out[0].append(bucket[ends[i]:ends[i + 1]].astype(np.int32).tobytes())
                out[1].append(value[ends[i]:ends[i + 1]].astype(np.float32).tobytes())
                out[2].append(stats[i].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.binary()) for c in out), batch.column(2).slice(done, n)],
                ["bucket", "value", "stats", "quality"])
            done += n


def _numbers(column, kind) -> list[np.ndarray]:
    """The numbers in every row of a binary column, as views of what the driver has received."""
    out = []
    for data, offsets in map(text_bytes, column.chunks):
        out += [data[low:high].view(kind) for low, high in zip(offsets[:-1], offsets[1:])]
    return out


class Machine:
    """Bias, weights and factor vectors; dense statistics follow the word buckets."""

    def __init__(self, n_stats: int):
        n = (1 << WORD_BITS) + n_stats
        self.bias, self.weight = 0.0, np.zeros(n)
        self.factors = np.random.default_rng(7).normal(0, 0.02, (n, FACTORS))
        self.mean, self.scale = np.zeros(n_stats), np.ones(n_stats)

    def standard(self, stats):
        x = (stats - self.mean) / self.scale
        return np.clip(np.where(np.isfinite(x), x, 0), -CLIP, CLIP)

    def logits(self, n, row, bucket, value, stats):
        """Scores before the logistic, and what the gradient needs."""
        x = self.standard(stats)
        k = 1 << WORD_BITS
        words = self.factors[bucket] * value[:, None]
        sums, squares = x @ self.factors[k:], (x * x) @ (self.factors[k:] ** 2)
        for f in range(FACTORS):
            sums[:, f] += np.bincount(row, words[:, f], n)
            squares[:, f] += np.bincount(row, words[:, f] ** 2, n)
        linear = self.bias + np.bincount(row, self.weight[bucket] * value, n) + x @ self.weight[k:]
        return linear + 0.5 * (sums * sums - squares).sum(1), sums, words, x

    def scores(self, *features):
        return 1 / (1 + np.exp(-np.clip(self.logits(*features)[0], -30, 30)))

    def fit(self, documents, labels):
        """``documents``: (bucket, value, stats) each. AdaGrad on the log loss."""
        stats = np.stack([s for _, _, s in documents])
        if len(stats) > 1:
            with np.errstate(invalid="ignore"):
                known = np.isfinite(stats)
                self.mean = np.where(known, stats, 0).sum(0) / np.maximum(known.sum(0), 1)
                spread = np.where(known, (stats - self.mean) ** 2, 0).sum(0) / np.maximum(known.sum(0), 1)
            self.scale = np.where(spread > 1e-12, np.sqrt(spread), 1)
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        self.bias = np.log(share / (1 - share))
        past = [1e-6, np.full(len(self.weight), 1e-6), np.full(self.factors.shape, 1e-6)]
        rng, k = np.random.default_rng(11), 1 << WORD_BITS
        for epoch in range(EPOCHS):
            order = rng.permutation(len(documents))
            rate = RATE * (1 - epoch / EPOCHS)
            for begin in range(0, len(order), BATCH):
                pick = order[begin:begin + BATCH]
                n = len(pick)
                row = np.repeat(np.arange(n), [len(documents[i][0]) for i in pick])
                bucket = np.concatenate([documents[i][0] for i in pick])
                value = np.concatenate([documents[i][1] for i in pick]).astype(float)
                logits, sums, words, x = self.logits(n, row, bucket, value, stats[pick])
                off = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels[pick]) / n
                push = off[row] * value
                weight = np.bincount(bucket, push, len(self.weight))
                weight[k:] += x.T @ off
                factors = np.zeros_like(self.factors)
                for f in range(FACTORS):
                    factors[:, f] = np.bincount(bucket, push * (sums[row, f] - words[:, f]), len(self.weight))
                factors[k:] += x.T @ (sums * off[:, None]) - (x * x).T @ off[:, None] * self.factors[k:]
                weight += DECAY * self.weight
                factors += DECAY * self.factors
                for i, (name, g) in enumerate((("bias", off.sum()), ("weight", weight), ("factors", factors))):
                    past[i] = past[i] + g * g
                    setattr(self, name, getattr(self, name) - rate * g / np.sqrt(past[i]))
        return self


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Machine | None:
    """Fit on labelled ``docs`` (doc_id, text, n_chars); ``labels`` (doc_id, quality). None without labels."""
    arrow_friendly(docs.sparkSession)
    picked = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).filter(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # An id may have many rows, so ids are taken while their rows add up to no more than the bound.
    upto = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = docs.select("doc_id").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "quality").agg(F.count(F.lit(1)).alias("n"))
    picked = counted.withColumn("upto", upto).filter(F.col("upto") <= rows).select("doc_id", "quality")
    # At most ``rows`` pairs of numbers: broadcast, so that no text is shuffled.
    sample = docs.select("doc_id", "text", "n_chars").join(F.broadcast(picked), "doc_id").select(
        F.col("text").cast("string").alias("text"), F.col("n_chars").cast("double").alias("n_chars"), "quality")
    found = sample.mapInArrow(_gather, "bucket binary, value binary, stats binary, quality int").toArrow()
    if not len(found):
        return None
    documents = list(zip(*(_numbers(found.column(c), kind) for c, kind in (("bucket", np.int32), ("value", np.float32), ("stats", np.float64)))))
    machine = Machine(len(documents[0][2])).fit(documents, found.column("quality").to_numpy().astype(float))
    del documents, found
    pa.default_memory_pool().release_unused()  # the driver keeps the machine only
    return machine


def _score(machine, whole):
    def run(batches):
        features = Features()
        for batch in batches:
            kept = batch.column(0)
            if whole:
                text, n_chars = (kept.flatten()[kept.type.get_field_index(c)] for c in ("text", "n_chars"))
            else:
                text, n_chars = batch.column(1), batch.column(2)
            if machine is None:
                scores = [np.full(batch.num_rows, 0.5)]
            else:
                scores = [machine.scores(*f) for f in features(text.cast(pa.string()), _lengths(n_chars))] or [np.zeros(0)]
            yield pa.RecordBatch.from_arrays([kept, pa.array(np.concatenate(scores))], [batch.schema.names[0], "score"])
    return run


def score(docs: DataFrame, machine: Machine | None, whole: bool = False) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text, n_chars); with ``whole`` all its columns, as ``row``, beside the score."""
    arrow_friendly(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")) if whole else docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("n_chars").cast("double").alias("n_chars"))
    return rows.mapInArrow(_score(machine, whole), T.StructType([rows.schema[0], T.StructField("score", T.DoubleType())]))
