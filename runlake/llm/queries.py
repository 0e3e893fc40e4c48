"""The operators over their whole tables, as the driver calls them: (spark, sf_dir) -> DataFrame."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from runlake.llm import bpe, chat, embed_dedup, langid, line_dedup, lm_score, mixing, ngram_join, prefix_trie, quality, secrets, simhash, token_align
from runlake.session import materialize

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ALIGNED = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
# Shares of the whole, raised to these powers, are the mixing targets.
MIX = {"source": 0.9, "lang": 0.95, "topic": 0.95}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(_table(spark, sf_dir, "documents"), words=4, at_least=85)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "row.doc_id", "row.text", "n_lines", "n_removed")


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.link_vectors(_table(spark, sf_dir, "embeddings"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.train(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))

    def of(*kinds):
        return F.filter("spans", lambda s: s.kind.isin(*kinds))
    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.BASE],
                        F.sha2(secrets.joined(of(*secrets.BASE)), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(_table(spark, sf_dir, "conversations"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document. ``n_within``: other documents at most ``simhash.RADIUS`` bits away, for ids divisible by 100."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    also = {c: F.col(c) for c in ("n_chars", "next_id", "next_mark")} | simhash.packed(F.sha2("text", 256))
    # Grouped by what the texts are partitioned by, so votes and both forms of a text meet without another shuffle.
    prints = simhash.fingerprint(simhash.with_edits(docs), ["key", "doc_id", "mark", "edited"], also)
    forms = {"own_high": ("high", False), "own_low": ("low", False), "copies": ("copies", False), "n_chars": ("n_chars", True), "next_id": ("next_id", True),
             "next_mark": ("next_mark", True), "edited_high": ("high", True), "edited_low": ("low", True)} | {f"sha_{i}": (f"sha_{i}", True) for i in range(4)}
    prints = materialize(prints.groupBy("key", "doc_id", "mark").agg(*[
        F.max(F.when(F.col("edited") == edited, F.col(c))).alias(name) for name, (c, edited) in forms.items()]), "fingerprints")
    own = prints.select("doc_id", "mark", "own_high", "own_low", "copies")
    following = own.select(F.col("doc_id").alias("next_id"), F.col("mark").alias("next_mark"), F.col("own_high").alias("next_high"), F.col("own_low").alias("next_low"))
    meets = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("next_id", "next_mark")]
    joined = prints.alias("l").join(following.alias("r"), meets).select("l.*", "next_high", "next_low", simhash.unpacked().alias("edited_sha256"))
    halves = {p: (F.col(f"{p}_high"), F.col(f"{p}_low")) for p in ("own", "edited", "next")}
    whole = own.select("doc_id", "mark", F.col("own_high").alias("high"), F.col("own_low").alias("low"), F.explode(F.sequence(F.lit(1), F.col("copies"))))
    asked = whole.filter("doc_id % 100 = 0").select(F.struct("doc_id", "mark").alias("doc_id"), "high", "low").distinct()
    near = simhash.within(asked, whole.select("high", "low")).select("doc_id.*", (F.col("n_within") - 1).alias("n_within"))
    return joined.join(near, ["doc_id", "mark"], "left").select(
        "doc_id", "n_chars", "edited_sha256", simhash.text_of(*halves["own"]).alias("fingerprint"),
        simhash.text_of(*halves["edited"]).alias("edited_fingerprint"),
        simhash.likeness(*halves["own"], *halves["edited"]).alias("near_edited"),
        simhash.likeness(*halves["own"], *halves["next"]).alias("near_next"), "n_within",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).drop("_copy")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN), RANKS)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(
        F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def mixed(docs: DataFrame) -> DataFrame:
    return mixing.mix(docs, {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic(F.col("text"))}, MIX)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(_table(spark, sf_dir, "documents")).select("row.doc_id", "weight", "probability", "draw", "kept")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    frequent = lm_score.vocabulary(docs)
    return lm_score.score(docs, frequent, lm_score.train(docs, frequent))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(F.col("doc_id").isNotNull() & ~langid.held_out(F.col("doc_id"))))
    return langid.predict(docs, model).withColumn("held_out", langid.held_out(F.col("doc_id")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    shared = F.crc32(conv.cast("string").cast("binary")) % 9
    return prefix_trie.build(*prefix_trie.spliced(
        *prefix_trie.ordered(_table(spark, sf_dir, "conversations")), conv - conv % 5, shared, most=8))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align(_table(spark, sf_dir, "documents"), *ALIGNED).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_line_dedup, op3_embedding_near_dedup, op4_quality_classifier, op5_secret_scans,
    op6_chat_formatting, op7_document_fingerprints, op8_byte_bpe, op9_source_mixing, op10_lm_scoring,
    op11_language_id, op12_prefix_trie, op13_tokenizer_alignment)}

SQL = {"op2_line_dedup": line_dedup.SQL, "op6_chat_formatting": chat.SQL, "op12_prefix_trie": prefix_trie.SQL}
