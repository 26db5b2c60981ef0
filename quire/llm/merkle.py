"""Merkle manifest of a table: a hash tree per group, a tree over the groups' roots, and an inclusion proof per row.

Rows are ranked within their group by a range sort. The digits of the rank in base 8 are grouped away one after the other
inside blocks of 512 leaves: each grouping nests the child structs of a run and hashes them, and all groupings of a block share one
exchange. The roots of the blocks are leaves of the next such rollup, until every group has one block. The nested
structs hold every sibling, so proofs come from a transform and one explode: rows of the table are not joined with nodes; only
a block as a whole (one row per 512 leaves) is met with the path above it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import staged
from quire.operators.ranking import dense_index, weighted_positions

FANOUT = 8
DIGITS = 3  # levels of one block
BLOCK = FANOUT ** DIGITS
PATH = "array<struct<left:string,right:string>>"


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value (numbers in decimal)."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*map(encoded, values)), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the digests beside its path give."""
    return F.aggregate(path, leaf, lambda acc, x: F.sha2(F.concat(x["left"], acc, x["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda x: F.concat(x["left"], x["right"]))), 256)


def _rollup(nodes: DataFrame) -> DataFrame:
    """(key, n, block, kids, hash) from (key, n, rank, hash, item): ``n`` is the number of nodes of the key.

    A level is hashed while it has several nodes; above that, the one node is handed on unchanged."""
    digit = [F.pmod(F.shiftright("rank", 3 * i), F.lit(FANOUT)).cast("int").alias(f"d{i}") for i in range(DIGITS)]
    rows = nodes.select("key", "n", F.shiftright("rank", 3 * DIGITS).alias("block"), *digit, "hash", "item") \
        .repartition("key", "block")
    inner = "item"
    for i in range(DIGITS):
        keep = ["key", "n", "block", *(f"d{j}" for j in range(i + 1, DIGITS))]
        run = rows.groupBy(*keep).agg(F.array_sort(F.collect_list(F.struct(f"d{i}", "hash", inner))).alias("kids"))
        joined = F.sha2(F.concat_ws("", F.col("kids.hash")), 256)
        rows = run.withColumn("hash", F.when(F.col("n") > FANOUT ** i, joined).otherwise(F.col("kids")[0]["hash"]))
        inner = "kids"
    return rows


def _beside(kids: Column, i: Column) -> Column:
    hashes = lambda part: F.concat_ws("", F.transform(part, lambda x: x["hash"]))
    return F.struct(hashes(F.slice(kids, 1, i)).alias("left"), hashes(F.slice(kids, i + 2, FANOUT)).alias("right"))


def _unfold(blocks: DataFrame, keep: list[str]) -> DataFrame:
    """One row per leaf: (keep, hash, item, path) from blocks that have the ``path`` above them."""
    def step(kids: Column, path: Column, level: int, inner: str) -> Column:
        return F.transform(kids, lambda kid, i: F.struct(
            F.when(F.col("n") > FANOUT ** level, F.concat(F.array(_beside(kids, i)), path)).otherwise(path).alias("path"),
            kid["hash"].alias("hash"), kid[inner].alias(inner)))

    def down(found: Column, level: int) -> Column:
        return F.flatten(F.transform(found, lambda x: step(x["kids"], x["path"], level, "kids" if level else "item")))

    found = step(F.col("kids"), F.col("path"), DIGITS - 1, "kids")
    for level in range(DIGITS - 2, -1, -1):
        found = down(found, level)
    return blocks.select(*keep, F.inline(found))


def _above(blocks: DataFrame) -> DataFrame:
    """(key, block, path, top): the path from each block's root up to its key's root, and that root."""
    most = blocks.agg(F.max("n")).first()[0]
    if most is None or most <= BLOCK:
        return blocks.select("key", "block", F.array().cast(PATH).alias("path"), F.col("hash").alias("top"))
    upper = staged(_rollup(blocks.select("key", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("rank"), "hash",
                                         F.col("block").alias("item"))), "merkle")
    return _unfold(_met(upper, _above(upper)), ["key", "top"]).select("key", F.col("item").alias("block"), "path", "top")


def _met(blocks: DataFrame, above: DataFrame) -> DataFrame:
    return blocks.drop("hash").join(above, ["key", "block"])


def manifest(docs: DataFrame, group: Column, order: Column, leaf: Column, altered: Column | None = None) -> DataFrame:
    """(group, id, leaf, altered, subroot, root, path) per row of ``docs``.

    Leaves of a group ascend by ``order`` (null first, ties by leaf); every 8 consecutive nodes (fewer in the last run) become the
    digest of theirs until one is left, the subroot. Subroots ascend by group (null first, bytewise) and give the root alike.
    ``path`` holds, from the leaf up, the digests to the left and to the right in each run. ``altered`` is another digest to carry
    beside the leaf, such as that of a changed row. Repeated rows are leaves of their own; empty table: no rows."""
    leaves = docs.select(F.concat(F.when(group.isNull(), "0").otherwise("1"), F.coalesce(group.cast("string"), F.lit(""))).alias("key"),
                         order.alias("id"), leaf.alias("hash"), (F.lit(None) if altered is None else altered).cast("string").alias("altered"))
    placed = weighted_positions(leaves, [F.col("key"), F.col("id"), F.col("hash")])
    groups = dense_index(placed.groupBy("key").agg(F.min("_before").alias("first"), F.count("*").alias("n")), [F.col("key")], "place")
    count = groups.count()
    nodes = placed.join(groups, "key").select("key", "n", (F.col("_before") - F.col("first")).alias("rank"), "hash",
                                              F.struct("id", "altered").alias("item"))
    blocks = staged(_rollup(nodes), "merkle")
    above = staged(_above(blocks), "merkle-paths")
    subroots = above.where(F.col("block") == 0).join(groups, "key").select(
        F.lit("").alias("key"), F.lit(count).cast("long").alias("n"), F.col("place").alias("rank"), F.col("top").alias("hash"),
        F.col("key").alias("item"))
    roots = staged(_rollup(subroots), "merkle")
    roots = _unfold(_met(roots, _above(roots)), ["top"]).select(F.col("item").alias("key"), F.col("path").alias("outer"), F.col("top").alias("root"))
    whole = _met(blocks, above).join(roots, "key").withColumn("path", F.concat("path", "outer"))
    return _unfold(whole, ["key", F.col("top").alias("subroot"), "root"]).select(
        F.when(F.substring("key", 1, 1) == "1", F.expr("substring(key, 2)")).alias("group"), "item.id", F.col("hash").alias("leaf"),
        "item.altered", "subroot", "root", "path")


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def audit(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id",
          text: str = "text") -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified): the manifest, checked against a table of which a third
    of the rows (3 divides the unsigned crc32 of the decimal id) has the letters A-Z of its text lower-cased.

    ``folded_root`` is what the row at hand and the original siblings give; ``verified`` says whether it is the root. Null
    texts and rows without an id are not changed."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = (F.crc32(F.col(order).cast("string")) % 3 == 0) & (lowered != F.col(text))
    altered = F.when(changed, leaf_hash(*(lowered if c == text else F.col(c) for c in fields)))
    found = manifest(docs, F.col(group), F.col(order), leaf_hash(*map(F.col, fields)), altered)
    folded = F.when(F.col("altered").isNull(), fold(F.col("leaf"), F.col("path"))).otherwise(fold(F.col("altered"), F.col("path")))
    return found.select("id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))
