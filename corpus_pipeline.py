"""A training corpus from raw documents: quality, near-duplicates, benchmark leaks, mixture, token files.

Each stage takes the documents that the stage before kept, written as Parquet and read again. All but
the last return the columns of ``documents``; the last returns the index of the token files.

The first three stages judge every row. A row with a null id is judged by its values, as if these were
an id larger than all others; a null or empty text has a quality like the mean, copies nothing and holds
no benchmark item. Rows that share an id are one document: what drops one drops all, and rows that are
the same stay together, as often as they are there. Where copies tie, the smallest id stays. An empty
table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import table
from sluice.llm.decontaminate import contaminations
from sluice.llm.lsh_forest import near_duplicates
from sluice.llm.mixing import mixed
from sluice.llm.quality_knn import quality_scores
from sluice.llm.queries import tokenizer_path
from sluice.llm.range_coder import token_index
from sluice.runtime import scratch_dir

#: Documents that score below this are rejected.
LEAST_QUALITY = 0.3


def named(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of every row, a null id replaced by a number beyond all ids made of the row's values."""
    values = F.xxhash64(*[F.col(c) for c in ("text", "lang", "source", "n_chars")])
    return docs.select(_key(F.col("doc_id"), values).alias("doc_id"), "text")


def _key(doc_id: Column, values: Column) -> Column:
    return F.coalesce(doc_id, F.lit(1 << 62) + F.shiftrightunsigned(values, 2))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id, as ``named`` gives it, is not among those gone."""
    values = F.xxhash64(*[docs[c] for c in ("text", "lang", "source", "n_chars")])
    gone = gone.select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, _key(docs["doc_id"], values) == F.col("gone"), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that score ``LEAST_QUALITY`` or more."""
    low = quality_scores(named(docs), table(spark, sf_dir, "labels"), LEAST_QUALITY).where("predicted = 0")
    return without(docs, low)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the smallest id, of each group of near-duplicates."""
    return without(docs, near_duplicates(named(docs)).where("NOT kept").select(F.col("id").alias("doc_id")))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold benchmark items or paraphrases of them."""
    return without(docs, contaminations(named(docs), table(spark, sf_dir, "benchmark")).select(F.col("id").alias("doc_id")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw sources to their target weights; a document drawn twice is there twice."""
    return mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token files in order of document ids and return their index."""
    return token_index(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("mixture", mixture),
    ("token_files", token_files),
]

#: The classifier's vote, the latent search and the hashed draws have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
