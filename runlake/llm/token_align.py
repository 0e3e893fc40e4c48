"""Cross-tokenizer alignment: the groups in which two tokenizers cut a text, and how their tokens overlap.

Two lists of tokens that spell the same bytes are cut into groups where a token of both ends. For texts of any
length the work is split by byte ranges: the tokens that end in a range form a fragment of an
associative monoid. A fragment without a common end is all open; any other has an open prefix up to its first
common end, closed groups, and an open suffix after its last. Joining two fragments closes one group out
of the left one's suffix and the right one's prefix; nothing closed is looked at again. Fragments of long texts are
made in different tasks and joined by a tree of grouped joins, ``FAN`` at a time.

Tokens of a range are those of the whole text: no token of either tokenizer holds a blank after something that
is not white space, and neither looks across such a place, so a range is tokenized from the last
such place before it to the first behind it. Texts of plain Latin characters go through a faster engine with
the same merges; where classes of characters may differ between the engines, the file's own one is used.

How often ids are linked is counted over the corpus and looked up in sorted arrays that are broadcast in
slices of about ``SLICE`` pairs, however many pairs there are.

Defined cases: a NULL or empty text, or one that either tokenizer doesn't spell exactly (with a blank before
it), has no tokens: zeros and ''. Strings of special tokens are plain text. Every row is aligned by itself and counts,
repeated or without ``doc_id``. Further columns are ignored. An empty table gives an empty result.
"""

import hashlib
import json
import os
import re
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from runlake.llm.common import CHUNK_BYTES, arrow_friendly
from runlake.session import materialize

SPAN = 32_768  # bytes of a range; a text of at most one range is a single fragment
FAN = 16
SLICE = 4_000_000
ID_BITS = 20  # of a token id

BLANK = "▁"
CUT = re.compile(r"(?<=\S) ")  # a blank that no token holds together with what precedes it
ODD = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-\u024f\u2010-\u2027\u20ac]")  # not plain Latin
ROW = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a array<int>, b array<int>, n array<int>"
FRAGMENT = ("row long, doc_id long, k long, ok boolean, closed boolean, pa binary, pb binary, groups binary, n_groups long, "
            "links binary, counts binary, sa binary, sb binary, n_a long, n_b long")


def byte_level() -> dict[str, int]:
    """The byte that a character of a byte-level vocabulary stands for: printable ones themselves, others from U+0100 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Files(NamedTuple):
    """What workers build the tokenizers from."""

    byte_file: str
    piece_file: bytes
    tokens: list[bytes]  # of the byte-level tokenizer, by id
    ranks: dict[bytes, int] | None  # of bytes and merges, if ids are in the order of merges


def read_tokenizers(byte_path: str, piece_path: str) -> Files:
    """A byte-level BPE file of ``tokenizers`` and a ``sentencepiece`` model."""
    with open(byte_path, encoding="utf-8") as a, open(piece_path, "rb") as b:
        byte_file, piece_file = a.read(), b.read()
    model, of = json.loads(byte_file)["model"], byte_level()
    vocab = model["vocab"]
    tokens = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        tokens[i] = bytes(of.get(c, 0) for c in token)
    made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    ranks = {tokens[i]: i for i in [*(vocab[c] for c in of), *made]} if made == sorted(made) and max(vocab[c] for c in of) < min(made) else None
    return Files(byte_file, piece_file, tokens, ranks)


def words_of(text: str) -> list[str]:
    """Parts of a text, each of which is tokenized alike by itself with a blank before it."""
    words = CUT.split(text)
    if len(words) > 1 and not words[-1]:
        words[-2:] = [words[-2] + " "]
    return words


class Tokens:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, files: Files):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        self.files, self.a = files, None
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.piece_file)
        self.bytes_a = files.tokens
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=files.ranks) if files.ranks else None
        self.len_a, self.len_b = (np.array([len(t) for t in x]) for x in (self.bytes_a, self.bytes_b))
        # an id with what follows it: a comma, or what ends its side of a group
        self.text_a = np.array([b"%d%s" % (i, e) for e in (b",", b"|") for i in range(len(self.bytes_a))], object)
        self.text_b = np.array([b"%d%s" % (i, e) for e in (b",", b";") for i in range(len(self.bytes_b))], object)

    def __call__(self, text: str):
        """Ids of both tokenizers for a text with a blank before it, or None if one doesn't spell it."""
        if self.plain and not ODD.search(text):
            a = self.plain.encode_ordinary(" " + text)
        else:
            if self.a is None:
                import tokenizers
                self.a = tokenizers.Tokenizer.from_str(self.files.byte_file)
                self.a.encode_special_tokens = True
            a = self.a.encode(" " + text, add_special_tokens=False).ids
        b, whole = self.b.encode(text), (" " + text).encode()
        if b"".join([self.bytes_a[i] for i in a]) != whole or b"".join([self.bytes_b[i] for i in b]) != whole:
            return None
        return np.array(a, np.int32), np.array(b, np.int32)

    def close(self, a: np.ndarray, b: np.ndarray):
        """Text, number and sorted links of the groups of tokens that begin and end together."""
        return self.close_all([(a, b)])[0]

    def close_all(self, pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[bytes, int, np.ndarray, np.ndarray]]:
        """``close`` of several, laid end to end."""
        a, b = (np.concatenate(side) for side in zip(*pairs))
        last = np.cumsum([(len(x), len(y)) for x, y in pairs], 0)
        ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        at_end = np.zeros(int(ends_a[-1]) + 1, np.int8)  # by byte: 1 where a token of the first ends, 2 of the second
        at_end[ends_a] = 1
        at_end[ends_b] += 2
        all_ends = np.flatnonzero(at_end)  # every two tokens that overlap share one stretch between these
        kind = at_end[all_ends]
        both = kind == 3
        count_a, count_b, groups = (np.cumsum(x) for x in (kind != 2, kind != 1, both))
        at_a, at_b = count_a - (kind != 2), count_b - (kind != 1)
        whole = np.searchsorted(all_ends, ends_a[last[:, 0] - 1], "right")  # where the stretches of a pair end
        owner = np.repeat(np.arange(len(pairs)), np.diff(whole, prepend=0))
        keys, counts = np.unique((owner << 2 * ID_BITS) | (a[at_a].astype(np.int64) << ID_BITS) | b[at_b], return_counts=True)
        of = np.searchsorted(keys, np.arange(len(pairs) + 1) << 2 * ID_BITS)
        keys = ((keys >> ID_BITS) & ((1 << ID_BITS) - 1)) << 32 | (keys & ((1 << ID_BITS) - 1))
        # a group's first tokens, then its second ones: each token is moved behind those of the other side that precede it
        shared = both[kind != 2], both[kind != 1]
        until = np.concatenate(([0], count_b[both])), count_a[both]
        group_a, group_b = (groups - both)[kind != 2], (groups - both)[kind != 1]
        text = np.empty(len(a) + len(b), object)
        text[np.arange(len(a)) + until[0][group_a]] = self.text_a[a + len(self.bytes_a) * shared[0]]
        text[np.arange(len(b)) + until[1][group_b]] = self.text_b[b + len(self.bytes_b) * shared[1]]
        text, n_groups, low, out = text.tolist(), np.diff(groups[whole - 1], prepend=0).tolist(), 0, []
        for i, high in enumerate(last.sum(1).tolist()):
            out.append((b"".join(text[low:high])[:-1], n_groups[i], keys[of[i]:of[i + 1]], counts[of[i]:of[i + 1]]))
            low = high
        return out

    def fragment(self, a, b, start: int, low: int, high: int) -> "Fragment":
        """Of the tokens that end in (``low``, ``high``], where the first token begins at byte ``start``."""
        ends_a, ends_b = start + np.cumsum(self.len_a[a]), start + np.cumsum(self.len_b[b])
        (a0, a1), (b0, b1) = (np.searchsorted(ends, (low, high), "right") for ends in (ends_a, ends_b))
        a, b, ends_a, ends_b = a[a0:a1], b[b0:b1], ends_a[a0:a1], ends_b[b0:b1]
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        if not len(both):
            return Fragment(a, b, len(a), len(b))
        (i, j), (k, m) = (np.searchsorted(ends, (both[0], both[-1]), "right") for ends in (ends_a, ends_b))
        inner = self.close(a[i:j], b[k:m]) if j > i else NO_GROUPS
        return Fragment(a[:i], b[:k], len(a), len(b), True, *inner, a[j:], b[m:])


class Shared:
    """The files as broadcast; a worker builds the tokenizers once and keeps them with the value."""

    def __init__(self, files: Files):
        self.files, self.made = files, None

    def tokens(self) -> Tokens:
        self.made = self.made or Tokens(self.files)
        return self.made


NONE = np.zeros(0, np.int32)
NO_GROUPS = (b"", 0, np.zeros(0, np.int64), np.zeros(0, np.int64))


class Fragment(NamedTuple):
    """Open prefix, closed groups with their links, open suffix. Not ``closed``: the prefix is all there is."""

    pa: np.ndarray
    pb: np.ndarray
    n_a: int
    n_b: int
    closed: bool = False
    groups: bytes = b""
    n_groups: int = 0
    links: np.ndarray = NO_GROUPS[2]
    counts: np.ndarray = NO_GROUPS[3]
    sa: np.ndarray = NONE
    sb: np.ndarray = NONE


def _summed(links, counts):
    keys, at = np.unique(np.concatenate(links), return_inverse=True)
    return keys, np.bincount(at, np.concatenate(counts), len(keys)).astype(np.int64)


def joined(tokens: Tokens, parts: list[Fragment]) -> Fragment:
    """The fragment of adjacent ranges, in order."""
    prefix, suffix, closed = [], [], False
    groups, n_groups, links, counts = [], 0, [NO_GROUPS[2]], [NO_GROUPS[3]]

    def add(text, n, keys, numbers):
        nonlocal n_groups
        groups.extend([text] if n else [])
        n_groups += n
        links.append(keys)
        counts.append(numbers)
    for p in parts:
        if not closed:
            prefix.append((p.pa, p.pb))
        else:
            suffix.append((p.pa, p.pb))
            if p.closed:
                add(*tokens.close(*(np.concatenate(x) for x in zip(*suffix))))
        if p.closed:
            closed, suffix = True, [(p.sa, p.sb)]
            add(p.groups, p.n_groups, p.links, p.counts)
    pre, post = ([np.concatenate(x) for x in zip(*side)] if side else [NONE, NONE] for side in (prefix, suffix))
    return Fragment(*pre, sum(p.n_a for p in parts), sum(p.n_b for p in parts), closed, b";".join(groups), n_groups,
                    *_summed(links, counts), *post)


def finished(tokens: Tokens, whole: Fragment):
    """Numbers, digest and links of a whole text, whose prefix is its first group."""
    first, n, links, counts = tokens.close(whole.pa, whole.pb)
    links, counts = _summed([links, whole.links], [counts, whole.counts])
    sha = hashlib.sha256(first + (b";" + whole.groups if whole.n_groups else b"")).hexdigest()
    return whole.n_a, whole.n_b, n + whole.n_groups, int(counts.sum()), sha, links, counts


NOTHING = (0, 0, 0, 0, "", *NO_GROUPS[2:])


def _rows(found):
    """An Arrow batch of (doc_id, what ``finished`` returns)."""
    *plain, links, counts = zip(*found)
    offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in links]))).astype(np.int32))
    keys, numbers = np.concatenate(links), np.concatenate(counts).astype(np.int32)
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in ((keys >> 32).astype(np.int32), (keys & 0xFFFFFFFF).astype(np.int32), numbers)]
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, t) for c, t in zip(plain, [pa.int64()] * 5 + [pa.string()])), *lists],
        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "n"])


def _align_short(files):
    def run(batches):
        tokens = files.value.tokens()
        for batch in batches:
            found, held, size = [], {}, 0

            def finish():
                for (i, (a, b)), (groups, n, links, counts) in zip(held.items(), tokens.close_all([*held.values()])):
                    found[i] += (len(a), len(b), n, int(counts.sum()), hashlib.sha256(groups).hexdigest(), links, counts)
                held.clear()
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = tokens(text) if text else None
                found.append((doc_id,) if ids else (doc_id, *NOTHING))
                if ids:
                    held[len(found) - 1] = ids
                    size += len(text)
                    if size > CHUNK_BYTES:
                        finish()
                        size = 0
            if held:
                finish()
            if found:
                yield _rows(found)
    return run


def ranges(words: list[str], span: int):
    """(k, start, low, high, text): the byte ranges of a text, each with the words that tokens ending in it belong to.

    A boundary within the word that holds the one before is left out, so that no word is tokenized more than twice.
    """
    sizes = np.array([len(w.encode()) + 1 for w in words])
    ends = np.cumsum(sizes)
    low, k = 0, 0
    for high in [*range(span, int(ends[-1]), span), int(ends[-1])]:
        first, last = int(np.searchsorted(ends, low, "right")), int(np.searchsorted(ends, high))
        if high < ends[-1] and first == last and ends[first] - sizes[first] < low and high < ends[last]:
            continue
        yield k, int(ends[first] - sizes[first]), low, high, " ".join(words[first:last + 1])
        low, k = high, k + 1


def _cut(span):
    def run(batches):
        names = ["row", "doc_id", "k", "start", "low", "high", "text"]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "text" else pa.int64()) for c, n in zip(zip(*rows), names)], names)
        for batch in batches:
            for row, doc_id, text in zip(*batch.columns):
                held = []
                for part in ranges(words_of(text.as_py()), span):
                    held.append((row.as_py(), doc_id.as_py(), *part))
                    if len(held) == 64:
                        yield out(held)
                        held = []
                if held:
                    yield out(held)
    return run


def _packed(rows):
    """An Arrow batch of (row, doc_id, k, fragment or None)."""
    def raw(x):
        return x if isinstance(x, (bytes, bool, int)) else x.tobytes()
    schema = [("row", pa.int64()), ("doc_id", pa.int64()), ("k", pa.int64()), ("ok", pa.bool_()), ("closed", pa.bool_())]
    fields = ["pa", "pb", "groups", "n_groups", "links", "counts", "sa", "sb", "n_a", "n_b"]
    schema += [(f, pa.int64() if f[:2] == "n_" else pa.binary()) for f in fields]
    made = []
    for row, doc_id, k, x in rows:
        p = x or Fragment(NONE, NONE, 0, 0)
        made.append((row, doc_id, k, x is not None, p.closed, *(raw(getattr(p, f)) for f in fields)))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*made), schema)], [n for n, _ in schema])


def _unpacked(r: dict) -> Fragment | None:
    ids, longs = (lambda f: np.frombuffer(r[f], np.int32)), (lambda f: np.frombuffer(r[f], np.int64))
    return Fragment(ids("pa"), ids("pb"), r["n_a"], r["n_b"], r["closed"], r["groups"], r["n_groups"], longs("links"), longs("counts"),
                    ids("sa"), ids("sb")) if r["ok"] else None


def _fragments(files):
    def run(batches):
        tokens = files.value.tokens()
        for batch in batches:
            rows = []
            for row, doc_id, k, start, low, high, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = tokens(text)
                rows.append((row, doc_id, k, tokens.fragment(*ids, start, low, high) if ids else None))
            if rows:
                yield _packed(rows)
    return run


def _join(files):
    def run(table):
        rows = sorted(table.to_pylist(), key=lambda r: r["k"])
        parts = [_unpacked(r) for r in rows]
        whole = joined(files.value.tokens(), parts) if None not in parts else None
        return pa.Table.from_batches([_packed([(rows[0]["row"], rows[0]["doc_id"], rows[0]["k"] // FAN, whole)])])
    return run


def _finish(files):
    def run(batches):
        tokens = files.value.tokens()
        for batch in batches:
            if batch.num_rows:
                yield _rows([(r["doc_id"], *(finished(tokens, _unpacked(r)) if r["ok"] else NOTHING)) for r in batch.to_pylist()])
    return run


def _long(docs: DataFrame, files, span: int) -> DataFrame:
    """Alignments of texts that are longer than a range."""
    pieces = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        _cut(span), "row long, doc_id long, k long, start long, low long, high long, text string")
    parts = materialize(pieces.repartition("row", "k").mapInArrow(_fragments(files), FRAGMENT), "fragments")
    most = parts.agg(F.max("k")).first()[0] or 0
    while most:
        most //= FAN
        grouped = parts.groupBy("row", F.floor(F.col("k") / FAN).alias("of")).applyInArrow(_join(files), FRAGMENT)
        parts = materialize(grouped, "fragments")
    return parts.mapInArrow(_finish(files), ROW)


def _look_up(shared):
    def run(batches):
        keys, numbers, best = shared.value
        for batch in batches:
            a, b, n = (batch.column(batch.schema.get_field_index(c)) for c in "abn")
            offsets = a.offsets.to_numpy().astype(np.int64)
            a, b, n = (x.flatten().to_numpy().astype(np.int64) for x in (a, b, n))
            key = a << 32 | b
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            n = np.where(keys[at] == key, n, 0)
            columns = list(batch.columns)
            for name, values in (("n_best", n * best[at]), ("count_sum", n * numbers[at])):
                sums = np.concatenate(([0], np.cumsum(values)))[offsets - offsets[0]]
                i = batch.schema.get_field_index(name)
                columns[i] = pa.array(columns[i].to_numpy() + np.diff(sums))
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)
    return run


def link_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n, best): how many links of the corpus hold an id pair, and whether none of its ``b`` holds more."""
    pairs = materialize(aligned.select(F.inline(F.arrays_zip("a", "b", "n"))).groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")
    return pairs.join(pairs.groupBy("b").agg(F.max("n").alias("most")), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, byte_path: str, piece_path: str, span: int = SPAN, slice_rows: int = SLICE) -> DataFrame:
    """Alignment of every row of ``docs`` (doc_id, text), with its links.

    (doc_id, n_a, n_b, n_groups, n_links, groups_sha256, a, b, n, n_best, count_sum); ``a``, ``b`` and ``n`` list
    the linked id pairs and how often each is linked.
    """
    spark = arrow_friendly(docs.sparkSession)
    files = spark.sparkContext.broadcast(Shared(read_tokenizers(byte_path, piece_path)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    long = F.coalesce(F.octet_length("text"), F.lit(0)) >= span
    aligned = materialize(texts.filter(~long).mapInArrow(_align_short(files), ROW).unionByName(_long(texts.filter(long), files, span)), "aligned")
    counts = materialize(link_counts(aligned), "pairs")
    n = -(-counts.count() // slice_rows)
    scored = aligned.withColumn("n_best", F.lit(0).cast("long")).withColumn("count_sum", F.lit(0).cast("long"))
    for i in range(n):
        part = counts.filter(F.pmod(F.xxhash64("a", "b"), F.lit(n)) == i).toArrow()
        a, b, numbers, best = (part.column(c).to_numpy() for c in ("a", "b", "n", "best"))
        key = a.astype(np.int64) << 32 | b
        order = np.argsort(key)
        if len(order):
            shared = spark.sparkContext.broadcast((key[order], numbers[order], best[order].astype(np.int64)))
            scored = scored.mapInArrow(_look_up(shared), f"{ROW}, n_best long, count_sum long")
    return scored
