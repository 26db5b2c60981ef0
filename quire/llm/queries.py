"""One registered query per operator: the operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import (bpe_stream, merkle, mixing, multiset_hash, packing, phrases, pii, secret_scan, simhash, spans, substring, toxicity,
                       va_search, warc)
from quire.llm.common import read_table
from quire.llm.oracles import ORACLES  # noqa: F401


def word_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def may_train(id_column: str):
    """Rows whose labels may be learnt from: crc32 of the id as text, modulo 3, is not 1."""
    return ~held_out(id_column)


def held_out(id_column: str):
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(False))


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = va_search.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op2_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(read_table(spark, sf_dir, "documents"), word_tokenizer())
    pieces = pieces.select(F.col("id").alias("doc_id"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(pieces, ["doc_id", "piece", "start", "length", "ids_crc32"])


def op3_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_captures(read_table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op4_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"),
                        *[spans.count(F.col("base"), k.name).alias(f"n_{k.name}") for k in secret_scan.BASE],
                        F.sha2(spans.joined(F.col("base")), 256).alias("base_sha256"),
                        spans.joined(F.col("spans")).alias("spans"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.queue(read_table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


def op6_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_fingerprint().alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op7_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), trainable=may_train)
    return model.score(docs, ["doc_id"]).select("doc_id", held_out("doc_id").alias("held_out"), "score",
                                                (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op8_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = multiset_hash.fingerprint_edits(read_table(spark, sf_dir, "documents"))
    return found.withColumnsRenamed({"id": "doc_id", "edited": "edited_sha256"})


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), *[spans.count(F.col("base"), k.name).alias(f"n_{k.name}") for k in pii.BASE],
                        F.sha2(spans.joined(F.col("base")), 256).alias("base_sha256"),
                        spans.joined(F.col("spans")).alias("spans"))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring.deduplicate(read_table(spark, sf_dir, "documents"))
    return left.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.digests(read_table(spark, sf_dir, "documents"), word_tokenizer()).withColumnRenamed("id", "doc_id")


QUERIES = {f.__name__: f for f in (
    op1_exact_top_k, op2_pack_documents, op3_warc_captures, op4_secret_spans, op5_mix_sources, op6_simhash_components,
    op7_toxicity_scores, op8_multiset_fingerprints, op9_personal_data, op10_repeated_passages, op11_phrase_collocations, op12_merkle_manifest, op13_bpe_round_trip)}
