"""BPE, secrets, fingerprints, line dedup and chat against plain Python."""

import base64
import hashlib
import random
import re
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from runlake.llm import bpe, chat, line_dedup, secrets, simhash
from runlake.llm.queries import QUERIES, RANKS

ODD = [None, "", " ", "\n\n\n", "a", "É中文字 🙂🙂", "don't  we'll\t\tgo 1234567 !!!??", "x" * 3000, "ab " * 9000, "\x00\x01   ﻿",
       "<|endoftext|> aaaaaaaaaaaaaaaa", "á" * 700 + "\r\n" * 40]


def docs(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string").repartition(2)


@pytest.fixture(scope="module")
def reference_tokenizer():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_is_the_librarys(spark, reference_tokenizer):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("abcdeé 中'!.\n1 ") for _ in range(rng.randrange(400))) for _ in range(60)]
    got = bpe.decode(bpe.encode(docs(spark, texts), RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r.doc_id] or ""
        assert list(r.ids) == reference_tokenizer.encode_ordinary(text) and bytes(r.decoded) == text.encode()


def test_bpe_when_a_worker_forgets(reference_tokenizer, monkeypatch):
    tokens = bpe.read_ranks(RANKS)
    encode = bpe.Encoder(tokens, bpe.PairTable(tokens), public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 3)
    monkeypatch.setattr(bpe, "MATRIX_CELLS", 16)
    for text in ("one two three four five", "six seven qwertyuiopasdf one"):
        ids, sizes = encode([text, ""])
        assert ids.tolist() == reference_tokenizer.encode_ordinary(text) and sizes.tolist() == [len(ids), 0]


def test_bpe_holds_a_bounded_part_of_a_batch(reference_tokenizer, monkeypatch):
    """However long a batch's texts are together, a worker cuts and decodes them part by part."""
    tokens = bpe.read_ranks(RANKS)
    texts = [*ODD, *(f"word{i} again and again " * 40 for i in range(60))]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    monkeypatch.setattr(bpe, "ENCODED_BYTES", 3000, raising=False)
    monkeypatch.setattr(bpe, "DECODED_IDS", 500, raising=False)
    cut, opened, encode, ragged = [], [], bpe.Encoder.__call__, bpe.ragged
    monkeypatch.setattr(bpe.Encoder, "__call__", lambda self, part: cut.append(part) or encode(self, part))
    encoded = pa.Table.from_batches(list(bpe._encode(tokens, bpe.PairTable(tokens), public_tokenizers.PATTERN)([batch]))).combine_chunks().to_batches()
    monkeypatch.setattr(bpe, "ragged", lambda begin, count: opened.append(len(count)) or ragged(begin, count))
    null = pa.RecordBatch.from_arrays([pa.array([-1, -2], pa.int64()), pa.array([None, []], pa.list_(pa.int32()))], ["doc_id", "ids"])
    got = pa.Table.from_batches(list(bpe._decode(tokens)([*encoded, null]))).to_pylist()
    assert all(len(part) == 1 or sum(len(t.encode()) for t in part) <= 3000 for part in cut)
    most = max(len(reference_tokenizer.encode_ordinary(t or "")) for t in texts)
    assert max(opened) <= max(500, most) < sum(opened)
    assert [(r["doc_id"], r["ids"], r["decoded"].decode()) for r in got] == [
        (i, reference_tokenizer.encode_ordinary(t or ""), t or "") for i, t in enumerate(texts)] + [(-1, None, ""), (-2, [], "")]


def test_bpe_forgets_pieces_met_once(reference_tokenizer, monkeypatch):
    tokens = bpe.read_ranks(RANKS)
    encode = bpe.Encoder(tokens, bpe.PairTable(tokens), public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 12)
    learnt, real = [], bpe.Encoder._learn
    monkeypatch.setattr(bpe.Encoder, "_learn", lambda self, pieces: learnt.extend(pieces) or real(self, pieces))
    for i in range(12):
        text = f"usualword unusual{'abcdefghijkl'[i]}xq {i}"
        assert encode([text])[0].tolist() == reference_tokenizer.encode_ordinary(text) and len(encode.known) <= 12
    assert learnt.count("usualword") == 1 and len(learnt) > 24


KEYWORDS = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    found = [("assign", m.start(), m.end()) for m in KEYWORDS.finditer(text) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def github_token(body="a" * 30, right=True):
    value, digits = zlib.crc32(body.encode()) + (not right), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = chr(secrets.BASE62[d]) + digits
    return f"ghp_{body}{digits}"


def test_secrets_are_those_of_plain_patterns(spark):
    rng = random.Random(5)
    parts = ["password", "PassWd", "token=", "api_key", "APIKEY", "secretſ", ": ", "=", '"', " ", "é中", "\n", "AKIA", "AKIAABCDEFGH1234", "0123456789abcdef",
             "deadbeef" * 5, "abcdefgh", "x1", "ABCDEFGHIJ", "passpasswordtoken = 'abcdefghijk'", github_token(), github_token(right=False)]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(300)]
    for r in secrets.find_secrets(docs(spark, texts)).collect():
        got = [(s.kind, s.start, s.end) for s in r.spans]
        assert [s for s in got if s[0] in secrets.BASE] == base_spans(texts[r.doc_id] or "")
        assert got == sorted(got, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_checksums_decide(spark):
    good, bad = github_token("Z9" * 15), github_token("Z9" * 15, right=False)
    got = secrets.find_secrets(docs(spark, [f"é {good}", bad])).orderBy("doc_id").collect()
    assert [(s.kind, s.start, s.end) for s in got[0].spans] == [("github", 2, 42)] and not got[1].spans
    prefix, charset = b"age-secret-key-", secrets.BECH32
    data = [7] * 52
    digits = [c >> 5 for c in prefix] + [0] + [c & 31 for c in prefix] + data + [0] * 6
    value = 1
    for d in digits:
        top, value = value >> 25, (value & 0x1FFFFFF) << 5 ^ d
        for i, step in enumerate(secrets.BECH32_STEPS):
            value ^= step * (top >> i & 1)
    key = b"AGE-SECRET-KEY-1" + bytes(charset[d] for d in data + [(value ^ 1) >> 5 * (5 - i) & 31 for i in range(6)])
    assert secrets.bech32_holds(key) and not secrets.bech32_holds(key[:-1] + (b"Q" if key[-1:] != b"Q" else b"P"))


def test_fingerprints(spark):
    rng = random.Random(7)
    words = [f"w{rng.randrange(3000)}" for _ in range(400)]
    texts = ODD + [" ".join(words), " ".join(words), " ".join(words[:300] + [f"n{i}" for i in range(100)]),
                   " ".join(f"o{rng.randrange(3000)}" for _ in range(400))]
    got = {r.doc_id: (r.high, r.low) for r in simhash.fingerprint(docs(spark, texts).select("doc_id", "text"), ["doc_id"]).collect()}
    n = len(ODD)
    assert len(got) == len(texts) and got[0] == got[1] == (0, 0) and got[n] == got[n + 1]

    def apart(i, j):
        return sum(bin((a ^ b) & (2**64 - 1)).count("1") for a, b in zip(got[i], got[j]))
    assert apart(n, n + 2) < 45 < apart(n, n + 3)


def test_block_tables_find_all_within_the_radius(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(128) for _ in range(6)]
    prints = base + [b ^ sum(1 << k for k in rng.sample(range(128), rng.randrange(12))) for b in base for _ in range(20)] + base[:2]
    signed = [(x >> 64, x & (2**64 - 1)) for x in prints]
    signed = [tuple(h - 2**64 if h >= 2**63 else h for h in x) for x in signed]
    table = spark.createDataFrame([(i, *x) for i, x in enumerate(signed)], "doc_id long, high long, low long")
    got = {r.doc_id: r.n_within for r in simhash.within(table, table.select("high", "low")).collect()}
    assert got == {i: sum(bin(x ^ y).count("1") <= simhash.RADIUS for y in prints) for i, x in enumerate(prints)}


@pytest.mark.parametrize("radius,blocks", [(simhash.RADIUS, simhash.BLOCKS), (0, 5), (3, 8), (11, 6)])
def test_blocks_miss_nothing_up_to_the_radius(spark, radius, blocks):
    rng = random.Random(10 + radius)
    base = [rng.getrandbits(128) for _ in range(4)] + [0, 2**128 - 1]
    prints = base + [b ^ sum(1 << k for k in rng.sample(range(128), n)) for b in base for n in range(25)] + base[:2]
    signed = [tuple(h - 2**64 if h >= 2**63 else h for h in (x >> 64, x & (2**64 - 1))) for x in prints]
    table = spark.createDataFrame([(i, *x) for i, x in enumerate(signed)], "doc_id long, high long, low long")
    got = {r.doc_id: r.n_within for r in simhash.within(table, table.select("high", "low"), radius, blocks).collect()}
    assert got == {i: sum(bin(x ^ y).count("1") <= radius for y in prints) for i, x in enumerate(prints)}


def test_edited_texts_are_within_the_radius(spark):
    rng = random.Random(14)
    words = ["".join(rng.choice("abcdefghijklmno") for _ in range(rng.randrange(2, 12))) for _ in range(3000)]
    texts, n = [], 40
    for size, changed in ((60, 1), (200, 4), (1000, 20)):
        for _ in range(n):
            text = [rng.choice(words) for _ in range(size)]
            edited = list(text)
            for i in rng.sample(range(size), changed):
                edited[i] = rng.choice(words)
            texts += [" ".join(text), " ".join(edited)]
    prints = simhash.fingerprint(docs(spark, texts).select("doc_id", "text"), ["doc_id"])
    got = {r.doc_id: r.n_within for r in simhash.within(prints, prints.select("high", "low")).collect()}
    assert set(got.values()) <= {1, 2}  # unrelated texts are not within it
    for k in range(3):
        assert sum(got[i] == 2 for i in range(2 * n * k, 2 * n * (k + 1), 2)) >= 0.9 * n


def test_next_ids(spark):
    ids = [5, 9, 1, 100, 40, 7, 7]
    got = {r.doc_id: (r.next_id, r.prev_id) for r in simhash.next_ids(spark.createDataFrame([(i,) for i in ids], "doc_id long").repartition(4)).collect()}
    order = sorted(set(ids))
    assert got == {d: (order[(i + 1) % len(order)], order[i - 1]) for i, d in enumerate(order)}
    assert simhash.next_ids(spark.createDataFrame([], "doc_id long")).collect() == []


def plain_dedup(rows):
    """(doc_id, text) -> text, n_removed; rows have distinct ids."""
    first, gone = {}, {}
    for doc, text in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        lines = text.split("\n")
        for p in range(len(lines) - 2):
            key = tuple(lines[p:p + 3])
            if not re.search("[^ \t\r\f\x0b]", "".join(key)):
                continue
            if key not in first:
                first[key] = (doc, p)
            else:
                fd, fp = first[key]
                gone.setdefault(doc, set()).update(range(max(p, fp + 3) if fd == doc else p, p + 3))
    return {d: (None, 0) if t is None else ("\n".join(l for i, l in enumerate(t.split("\n")) if i not in gone.get(d, ())), len(gone.get(d, ()))) for d, t in rows}


def test_line_dedup(spark):
    rng = random.Random(11)
    texts = ODD + ["\n".join(rng.choice("abc ") for _ in range(rng.randrange(1, 14))) for _ in range(60)] + ["a\n" * 400, "q\nr\ns\nt", "q\nr\ns\nt", "z\nq\nr\ns\nt\nu"]
    rows = list(enumerate(texts))
    df = docs(spark, texts).withColumn("row", F.lit(1)).withColumn("first", F.lit(2))
    got = {r.row.doc_id: (r.row.text, r.n_removed) for r in line_dedup.dedup_lines(df).collect()}
    assert got == plain_dedup(rows)
    assert line_dedup.dedup_lines(df.limit(0)).collect() == []
    twice = spark.createDataFrame([(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "a\nb\nc"), (2, "a\nb\nc")], "doc_id long, text string")
    assert sorted((str(r.row.doc_id), r.row.text) for r in line_dedup.dedup_lines(twice).collect()) == [("1", ""), ("1", ""), ("2", ""), ("None", "a\nb\nc")]


def test_chat_snapshots_collapse(spark):
    rng, rows, convs = random.Random(13), [], {}
    for c in range(80):
        n = rng.randrange(1, 9)
        turns = [(rng.choice(["user", "assistant", None]), rng.choice(["hi", "ok", None, ""])) for _ in range(n)]
        if c % 3 and convs:
            whole = convs[rng.choice(list(convs))]
            turns = whole[:rng.randrange(1, len(whole) + 1)]
        convs[c] = turns
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    convs[99] = [("user", str(i)) for i in range(150)]
    rows += [(99, i, *t) for i, t in enumerate(convs[99])]
    rows += [rows[0], (None, 0, "user", "lost")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, pos int").repartition(5)
    got = {}
    for r in sorted(chat.format_chats(df).collect(), key=lambda r: (r.conv_id, r.segment)):
        got.setdefault(r.conv_id, [r.copies, "", r.n_turns])[1] += r.text
    want = {}
    for c, turns in convs.items():
        if any(len(o) > len(turns) and o[:len(turns)] == turns for o in convs.values()) or any(o == turns and k < c for k, o in convs.items()):
            continue
        text = "".join(f"<|im_start|>{role or ''}\n{t or ''}<|im_end|>\n" for role, t in turns)
        want[c] = [sum(o == turns for o in convs.values()), text, len(turns)]
    assert got == want
    assert chat.format_chats(df.limit(0)).collect() == []


def test_fingerprint_query_on_a_small_table(spark, tmp_path):
    texts = ODD + ["one two three four five six seven", "é" * 9]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in QUERIES["op7_document_fingerprints"](spark, str(tmp_path)).collect():
        text, after = texts[r.doc_id] or "", texts[(r.doc_id + 1) % len(texts)] or ""
        k = len(text) // 4
        edited = text[:len(text) - k] + after[:k]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (edited != text) or (r.near_edited == 1.0 and r.fingerprint == r.edited_fingerprint)
