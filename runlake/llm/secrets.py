"""Secret scans: Aho-Corasick keywords, anchored patterns at their hits, embedded checksums.

One automaton over the lower-cased bytes finds where a pattern can begin; the
pattern is then matched at that byte only. Bare hex keys have no keyword; their runs are
found by a byte mask. Token kinds that carry a checksum count only if it holds.

Spans are code points, end exclusive, of the whole match. Per kind they are leftmost
and do not overlap; kinds may overlap each other. Order: start, then kind as in ``KINDS``.

Defined cases: a NULL or empty text has no spans. Every row is judged by itself,
repeated or not, with or without a ``doc_id``; further columns are ignored. An empty
table gives an empty result.
"""

import re
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from runlake.llm.common import arrow_friendly, chunks, text_bytes

KINDS = ("assign", "access", "hex", "github", "npm", "age")
BASE = KINDS[:3]

# Published token formats, with the keyword that each begins with.
ASSIGN = rb"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
PATTERNS = {
    "assign": (ASSIGN, ("password", "passwd", "secret", "token", "apikey", "api_key")),
    "access": (rb"AKIA[A-Z0-9]+", ("akia",)),
    "github": (rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    "npm": (rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])", ("npm_",)),
    "age": (rb"AGE-SECRET-KEY-1[02-9AC-HJ-NP-Z]{58}(?![A-Z0-9])", ("age-secret-key-1",)),
}
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BECH32 = b"QPZRY9X8GF2TVDW0S3JN54KHCE6MUA7L"
BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)


def crc_holds(token: bytes) -> bool:
    """The last 6 characters are the base-62 CRC-32 of the 30 after the prefix."""
    body, check = token[4:-6], token[-6:]
    value = 0
    for c in check:
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(body)


def bech32_holds(token: bytes) -> bool:
    """The checksum over the lower-cased prefix and all data characters is 1."""
    prefix, _, data = token.rpartition(b"1")
    prefix = prefix.lower()
    value = 1
    for digit in [c >> 5 for c in prefix] + [0] + [c & 31 for c in prefix] + [BECH32.index(c) for c in data]:
        top, value = value >> 25, (value & 0x1FFFFFF) << 5 ^ digit
        for i, step in enumerate(BECH32_STEPS):
            value ^= step * (top >> i & 1)
    return value == 1


def _counts(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return m.end(2) - m.start(2) >= 8
    if kind == "access":
        return m.end() - m.start() >= 16
    return bech32_holds(m[0]) if kind == "age" else crc_holds(m[0])


class Scanner:
    def __init__(self):
        self.patterns = {kind: re.compile(p) for kind, (p, _) in PATTERNS.items()}
        self.keywords = ahocorasick.Automaton()
        for kind, (_, words) in PATTERNS.items():
            for word in words:
                self.keywords.add_word(word, (kind, len(word)))
        self.keywords.make_automaton()
        self.hex = np.zeros(256, bool)
        self.hex[list(b"0123456789abcdef")] = True

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, start byte, kind, end byte) of every span in texts laid end to end."""
        raw = data.tobytes()
        hits = sorted((end - n + 1, kind) for end, (kind, n) in self.keywords.iter(raw.lower().decode("latin-1")))
        found, free = [], {}
        rows = np.searchsorted(offsets, [at for at, _ in hits], "right") - 1
        for (at, kind), row in zip(hits, rows.tolist()):
            if at < free.get(kind, 0):
                continue
            m = self.patterns[kind].match(raw, at, int(offsets[row + 1]))
            if m:
                free[kind] = m.end()
                if _counts(kind, m):
                    found.append((row, m.start(), KINDS.index(kind), m.end()))
        inside = np.concatenate(([False], self.hex[data], [False]))
        cut = np.zeros(len(inside), bool)
        cut[offsets[:-1] + 1] = True
        begins = np.flatnonzero(inside[1:] & (~inside[:-1] | cut[1:]))
        ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut[1:]))
        long = ends - begins >= 32
        for b, e in zip(begins[long].tolist(), ends[long].tolist()):
            found.append((int(np.searchsorted(offsets, b, "right")) - 1, b, KINDS.index("hex"), e))
        return sorted(found)


def _scan(batches):
    scan = Scanner()
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        rows, spans = [], []
        for low, high in chunks(offsets):
            part, base = data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
            found = scan(part, base)
            if not found:
                continue
            points = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))
            for row, start, kind, end in found:
                first = points[base[row]]
                rows.append(low + row)
                spans.append((kind, points[start] - first, points[end] - first))
        counts = np.bincount(np.array(rows, np.int64), minlength=batch.num_rows)
        table = np.array(spans, np.int64).reshape(-1, 3)
        values = pa.StructArray.from_arrays(
            [pa.array([KINDS[k] for k in table[:, 0]], pa.string()), pa.array(table[:, 1]), pa.array(table[:, 2])],
            ["kind", "start", "end"])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), values)
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "spans"])


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row of ``docs`` (doc_id, text); spans is an array of (kind, start, end)."""
    arrow_friendly(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _scan, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def joined(spans):
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s["end"].cast("string"))), ",")
