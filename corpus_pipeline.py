"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage is written as Parquet to the shared folder and read again as the next stage's documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import mixing, packing, secret_scan, simhash, toxicity
from quire.llm.common import read_table, staged
from quire.llm.queries import may_train, word_tokenizer


def _with_text(docs: DataFrame, columns: list[str], text: Column) -> list[Column]:
    """The columns of documents with a new text, and its length where they keep one."""
    changed = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return [changed.get(c, docs[c]).alias(c) for c in columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold; the model learns from the labels of these documents."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), trainable=may_train)
    return model.score(docs, docs.columns).where(F.col("score") < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group."""
    return simhash.deduplicate(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a marker."""
    rows = docs.withColumn("_row", F.struct(*docs.columns))
    found = secret_scan.scan(rows, carry=["_row"])
    clean = found.select("_row", F.size("spans").alias("n"), secret_scan.masked(F.col("text"), F.col("spans")).alias("clean"))
    clean = clean.select(F.when(F.col("n") > 0, F.col("clean")).otherwise(F.col("_row.text")).alias("_text"), "n", "_row.*")
    return clean.select([F.col("_text").alias(c) if c == "text" else
                         F.when(F.col("n") > 0, F.char_length("_text")).otherwise(F.col(c)).alias(c) if c == "n_chars" else
                         F.col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix sends them; those cut at the end of the budget keep their first words."""
    mixed = mixing.mixed_texts(docs)
    return mixed.select(*_with_text(mixed, docs.columns, F.col("text")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 2048 tokens."""
    pieces = packing.token_pieces(docs, word_tokenizer())
    pieces = pieces.select(F.col("id").alias("doc_id"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(pieces, ["doc_id", "piece", "start", "length", "ids_crc32"])


STAGES = [("toxicity", drop_toxic), ("simhash_dedup", drop_near_copies), ("secrets", mask_secrets),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: SQL has neither gradient-boosted trees nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over all documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
