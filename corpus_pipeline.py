"""A training corpus out of raw documents, stage by stage.

Every stage takes all that the one before it kept and returns the columns of the
documents, extra ones included; the last one returns token ids.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from runlake.llm import bpe, line_dedup, ngram_join, quality
from runlake.llm.queries import RANKS, mixed
from runlake.session import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier, fitted on the labelled ones, accepts, whatever their ``doc_id``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score(docs, quality.train(docs, labels), whole=True).filter(F.col("score") >= quality.ACCEPT)
    return scored.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the later occurrences of repeated line windows; a text that loses every line goes with its row."""
    found = line_dedup.dedup_lines(docs).filter("n_removed = 0 OR n_removed < n_lines")
    chars = F.when(F.col("n_removed") > 0, F.length("row.text").cast("long")).otherwise(F.col("row.n_chars"))
    return found.select(*[(chars if c == "n_chars" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near duplicates by five-word shingles go; the document with the smallest ``doc_id`` of each group stays.

    A document without words or ``doc_id`` has no group and stays. Rows that
    repeat a ``doc_id`` share its fate.
    """
    groups = ngram_join.link_documents(docs)
    gone = groups.filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def sample_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose token shares by source, language and topic are the tempered ones."""
    return mixed(docs).filter("kept").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text) of every row; ``text`` is what the ids decode to."""
    encoded = materialize(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), "ids")  # so that a core runs one Python worker at a time
    decoded = bpe.decode(encoded, RANKS)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", sample_to_targets),
    ("byte-level BPE encoding and decoding", tokenize),
]

# A trained classifier, a link closure and merge rounds have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
