"""Language ID: multinomial naive Bayes over hashed character n-grams.

A text is lowered, every run of characters that are no letters becomes one blank, and a blank
precedes it. Its n-grams of ``SIZES`` characters are hashed to 2**``BITS`` buckets. Counting is one
pass over all learning rows: a task adds up buckets by language and sends its sums, Spark adds those
of all tasks. The logarithms of smoothed shares are a matrix (language, bucket) that is broadcast;
tasks multiply it with the sparse counts of a batch of texts and add the languages' priors.

The matrix is bounded: more than ``MAX_LANGUAGES`` distinct languages are an error, as such a column
holds no languages. Texts of any length are handled in steps of bounded size.

Defined cases: a NULL text, or one without any letter, is ``und`` with score 0, and teaches nothing but
its language's prior; NULL languages teach nothing. Of equally likely languages the first in order wins.
The score is the posterior of the predicted language. A NULL ``doc_id`` is not held out and teaches
nothing either. Repeated rows count as often as they occur. Where nothing can be learned, every text is
``und``. Further columns are ignored. An empty table gives an empty result.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from runlake.llm.common import arrow_friendly, chunks, starts_of, text_bytes
from runlake.session import materialize

BITS = 16
SIZES = (1, 2, 3)
SMOOTHING = 0.5
MAX_LANGUAGES = 200
UNKNOWN = "und"
# Characters handled at once, and languages whose counts a task keeps before it sends them.
STEP = 1 << 15
KEPT_LANGUAGES = 32
DOCUMENTS = -1  # the bucket that counts documents

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def letters() -> np.ndarray:
    """Whether a code point is a letter, packed to bits."""
    return np.packbits(np.array([chr(i).isalpha() for i in range(0x110000)]))


class Grams:
    """(row, bucket) of all n-grams of a text column, in steps."""

    def __init__(self, packed: np.ndarray):
        self.letter = np.unpackbits(packed).astype(bool)

    def __call__(self, column):
        """Per chunk of rows: its range and a list of (row, bucket) steps; a text without letters has none."""
        data, offsets = text_bytes(pc.utf8_lower(column))
        for low, high in chunks(offsets):
            part, base = data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
            yield low, high, self._steps(part, base)

    def _steps(self, data, offsets):
        n = len(offsets) - 1
        first = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]  # in characters
        codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        letter = self.letter[codes]
        lettered = np.concatenate(([0], np.cumsum(letter)))
        row = np.repeat(np.arange(n), np.diff(first))
        keep = letter.copy()
        keep[1:] |= letter[:-1] & (row[1:] == row[:-1])  # one blank after a word
        keep &= (lettered[first[1:]] > lettered[first[:-1]])[row]
        kept, row = np.where(letter, codes, 0)[keep], row[keep]
        new = starts_of(row)
        at = np.arange(len(kept)) + np.searchsorted(new, np.arange(len(kept)), "right")  # a blank before every text
        text, owner = np.zeros(len(kept) + len(new), np.uint64), np.zeros(len(kept) + len(new), np.int64)
        text[at], owner[at] = kept, row
        owner[new + np.arange(len(new))] = row[new]
        for size in SIZES:
            for low in range(0, len(text) - size + 1, STEP):
                m = min(STEP, len(text) - size + 1 - low)
                value = np.full(m, size, np.uint64)
                for j in range(size):
                    value += text[low + j:low + j + m] * _ODD[j]
                value = (value ^ (value >> np.uint64(31))) * _ODD[4] >> np.uint64(64 - BITS)
                whole = owner[low:low + m] == owner[low + size - 1:low + size - 1 + m]
                yield owner[low:low + m][whole], value[whole].astype(np.int64)


@dataclass
class Model:
    """Languages in order, their log priors, and log shares by (language, bucket)."""

    languages: list[str]
    prior: np.ndarray
    shares: np.ndarray

    def likelihoods(self, steps, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, language) log likelihoods with priors, and whether a row has n-grams."""
        total, seen = np.tile(self.prior, (n, 1)), np.zeros(n, bool)
        for row, bucket in steps:
            seen[row] = True
            for k in range(len(self.languages)):
                total[:, k] += np.bincount(row, self.shares[k][bucket], n)
        return total, seen


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _count(packed):
    def run(batches):
        grams, totals = Grams(packed), {}

        def send():
            for name, sums in totals.items():
                at = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(at), pa.string()), pa.array((at - 1).astype(np.int32)), pa.array(sums[at])], ["lang", "bucket", "n"])
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), object)
            for low, high, steps in grams(batch.column(0)):
                here = names[low:high]
                own, which = np.unique(here, return_inverse=True)
                for name, n in zip(own, np.bincount(which)):
                    if name not in totals:
                        if len(totals) >= KEPT_LANGUAGES:
                            yield from send()
                            totals = {}
                        totals[name] = np.zeros((1 << BITS) + 1, np.int64)
                    totals[name][0] += n  # the place of bucket DOCUMENTS
                steps = list(steps)
                if steps:
                    of, bucket = which[np.concatenate([r for r, _ in steps])], np.concatenate([b for _, b in steps])
                    for k, name in enumerate(own):
                        if name not in totals:  # sent above, as this chunk has very many languages
                            totals[name] = np.zeros((1 << BITS) + 1, np.int64)
                        totals[name][1:] += np.bincount(bucket[of == k] if len(own) > 1 else bucket, minlength=1 << BITS)
        yield from send()
    return run


def train(docs: DataFrame) -> Model | None:
    """Learn from ``docs`` (text, lang); None where no row has a language."""
    arrow_friendly(docs.sparkSession)
    rows = docs.filter("lang IS NOT NULL").select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    sums = materialize(rows.mapInArrow(_count(letters()), "lang string, bucket int, n long")
                       .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "languages")
    known = sums.filter(F.col("bucket") == DOCUMENTS).select("lang", "n").orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(known) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    if not known:
        return None
    place = {r.lang: k for k, r in enumerate(known)}
    counts = np.zeros((len(known), 1 << BITS))
    found = sums.filter(F.col("bucket") != DOCUMENTS).toArrow()
    lang = pc.index_in(found.column("lang").combine_chunks(), pa.array(list(place), pa.string())).to_numpy(zero_copy_only=False).astype(np.int64)
    counts[lang, found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    shares = np.log(counts + SMOOTHING) - np.log(counts.sum(1, keepdims=True) + SMOOTHING * (1 << BITS))
    docs_of = np.array([r.n for r in known], float)
    return Model(list(place), np.log(docs_of / docs_of.sum()), shares)


def _predict(packed, shared):
    def run(batches):
        grams, model = Grams(packed), shared.value
        for batch in batches:
            names, scores = [], []
            for low, high, steps in grams(batch.column(1)) if model else ():
                total, seen = model.likelihoods(steps, high - low)
                best = total.argmax(1)
                total -= total.max(1, keepdims=True)
                names += [model.languages[k] if s else UNKNOWN for k, s in zip(best, seen)]
                scores += np.where(seen, 1 / np.exp(total).sum(1), 0.0).tolist()
            if model is None:
                names, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text)."""
    spark = arrow_friendly(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predict(letters(), spark.sparkContext.broadcast(model)), "doc_id long, lang_pred string, score double")
