"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Every source is a queue of its documents in a shuffled order that a seed and the document fix, repeated up to ``epochs`` times.
A document's virtual finish time is the tokens its source has queued up to its end, divided by the source's target. All queued
documents are range-sorted by that time, a running total follows from the totals of the ranges, and the sequence is truncated
where the total budget is spent: the document at the cut keeps the words that still fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import WORD, staged, text_of
from quire.operators.ranking import weighted_positions

EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = 11
BUCKET_ROWS = 4096


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, weight, target) from (source, size) rows; one row per source.

    Sources by code point, null last, take ``weights`` in turn. The targets share the total by weight, but no more than
    ``epochs`` times a source's size; what that leaves over is shared again by weight. Sorted by size per weight,
    the sources that reach their limit come first, so one running sum finds the common level. The two windows here see one row
    per source, never documents."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth % len(weights) + 1).cast("int")))
    per = per.withColumn("most", epochs * F.col("source_size").cast("double"))
    everything = Window.partitionBy()
    upward = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = upward.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("total", F.sum("source_size").over(everything).cast("double")) \
        .withColumn("full", F.coalesce(F.sum("most").over(before), F.lit(0.0))) \
        .withColumn("open", F.sum("weight").over(upward.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    level = (F.col("total") - F.col("full")) / F.col("open")  # if all before are full and none from here on
    fits = level * F.col("weight") <= F.col("most")
    per = per.withColumn("level", F.max(F.when(fits, level)).over(everything))
    return per.select("source", "source_size", "weight",
                      F.least(F.col("most"), F.col("weight") * F.coalesce("level", F.lit(0.0))).alias("target"))


def queue(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS,
          epochs: int = EPOCHS, seed: int = SEED, keep: list[str] = ()) -> DataFrame:
    """(id, version, size, source, source_size, target, ahead, place) and the columns ``keep``: ``ahead`` is what the source
    queues before the document in one epoch, ``place`` a number of the row within its source.

    The running sum of a source goes over hash buckets of its shuffled order, so a source with a third of all documents is many
    small windows. ``version`` is a hash of the text; equal rows are interchangeable."""
    size = F.regexp_count(text_of(text), F.lit(WORD)).cast("long")
    rows = staged(docs.select(F.col(id_column).alias("id"), F.md5(text_of(text)).alias("version"), size.alias("size"),
                              F.col(source).alias("source"), *keep), "mix-sizes")
    per = source_targets(rows.select("source", "size"), weights, epochs)
    counts = rows.groupBy("source").agg(F.ceil(F.count("*") / BUCKET_ROWS).alias("buckets"))
    per = per.join(counts.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    per = staged(per, "mix-targets")
    shuffled = rows.withColumn("turn", F.md5(F.concat_ws("|", F.lit(seed), F.col("id").cast("string"), "version"))) \
        .join(per.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    # buckets are ranges of the shuffled order: the first digits of the hash
    share = F.conv(F.substring("turn", 1, 8), 16, 10).cast("double") / float(1 << 32)
    shuffled = shuffled.withColumn("bucket", F.floor(share * F.col("buckets")))
    order = ["turn", F.col("id").asc_nulls_first(), "version"]
    inside = Window.partitionBy("source", "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = shuffled.groupBy("source", "bucket").agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("of"), F.col("bucket").alias("of_bucket"),
                       F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    own = shuffled.withColumns({"inner": F.coalesce(F.sum("size").over(inside), F.lit(0)),
                                "place": F.col("bucket") * (1 << 32) + F.count(F.lit(1)).over(inside)})
    placed = own.join(sums, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("of_bucket")))
    return placed.select("id", "version", "size", "source", "source_size", "target",
                         (F.col("base") + F.col("inner")).alias("ahead"), "place", *keep)


def schedule(queued: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """The mix: one row per document and epoch it is sent in, with (epoch, finish, before, words) beside the columns of ``queued``.

    ``before`` is the number of words sent earlier, ``words`` what the document sends: all of its words, but for the one at which
    the budget (the words of all documents) runs out. Equal finish times go by source, epoch and place in the queue. Documents
    without words, and sources without a target, send nothing."""
    budget = queued.agg(F.sum("size")).first()[0] or 0
    end = F.col("epoch") * F.col("source_size") + F.col("ahead") + F.col("size")
    turns = queued.where("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))) \
        .withColumn("finish", F.try_divide(end, F.col("target"))).where("finish IS NOT NULL")
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("epoch"), F.col("ahead"), F.col("id").asc_nulls_first(), F.col("version")]
    sent = weighted_positions(turns, order, "size").where(F.col("_before") < budget)
    return sent.select(*queued.columns, "epoch", "finish", F.col("_before").alias("before"),
                       F.least(F.col("size"), F.lit(budget) - F.col("_before")).cast("long").alias("words"))


def taken(queued: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """(id, size, source_size, target, taken): one row per document; ``taken`` counts its words in the mix over all epochs.

    Null texts have size 0 and take 0; a null source is a source of its own, last in order. Empty table: no rows."""
    columns = ["id", "size", "source_size", "target"]
    sent = schedule(queued, epochs).select("source", "place", *columns, "words")
    # rows that send nothing are in neither sum of turns
    all_rows = sent.unionByName(queued.select("source", "place", *columns, F.lit(0).cast("long").alias("words")))
    return all_rows.groupBy("source", "place", *columns).agg(F.sum("words").alias("taken")).select(*columns, "taken")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word, as it stands; the whole text if it has no more."""
    space = r"[\x20\x09-\x0D]+"
    lead = F.char_length(F.regexp_extract(text, "^[\\x20\\x09-\\x0D]*", 0))
    parts = F.split(F.substr(text, lead + 1, F.char_length(text)), space, n.cast("int") + 1)
    rest = F.char_length(F.get(parts, n.cast("int")))
    return F.when(F.size(parts) > n, F.regexp_replace(F.substr(text, F.lit(1), F.char_length(text) - rest), space + "$", "")) \
        .otherwise(text)


def mixed_texts(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
                weights: tuple = WEIGHTS, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """The mix itself, with the columns of ``docs``, in the order of sending (see ``schedule``): a document once per epoch
    that sends it; the one at which the budget ends keeps its first words. Fully repeated rows are as many as the mix sends of them."""
    rows = staged(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "mix-rows")
    sent = schedule(queue(rows, id_column, text, source, weights, epochs, seed, keep=["_mix_row"]), epochs)
    turns = sent.select("_mix_row", F.col("before").alias("_mix_before"), F.col("words").alias("_mix_words"), F.col("size").alias("_mix_size"))
    both = rows.join(turns, "_mix_row").orderBy("_mix_before")
    whole = F.col(text)
    return both.withColumn(text, F.when(F.col("_mix_words") < F.col("_mix_size"), first_words(whole, F.col("_mix_words"))).otherwise(whole)) \
        .select(*docs.columns)
