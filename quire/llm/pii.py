"""Personal data: fixed patterns, and terms whose co-occurrence with a protected entity discloses it.

Every matched value (an e-mail address, number, ...) is a protected entity. Co-occurrence in whole documents estimates how
strongly a term reveals an entity: the pointwise mutual information of term and entity as a share of the entity's own
information. Terms at or over the threshold, in documents that hold the entity, are spans too, to be generalised or removed.
Documents without any entity are never touched. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import spans as S
from quire.llm.common import staged, text_of


def _part_fits(part: Column) -> Column:
    """A decimal number of any length is at most 255."""
    short = F.regexp_replace(part, "^0+", "")
    return (F.char_length(short) < 3) | ((F.char_length(short) == 3) & (short <= "255"))


def luhn(digits: Column) -> Column:
    """The check sum of a string of up to 19 digits is right."""
    order = F.slice(F.split(F.reverse(digits), ""), F.lit(1), F.char_length(digits))
    value = F.transform(order, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int"))))
    return F.aggregate(value, F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


# Runs start where no character of the run stands before, or where the last match ended (\G): the same matches as
# from every start, found in linear time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
BASE = [
    S.Kind("email", EMAIL),
    S.Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
           lambda m: F.forall(F.split(m, r"\."), _part_fits)),
    # whole runs of 14 to 19 digits with single separators; longer and shorter runs fail as a whole
    S.Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])", lambda m: luhn(_digits(m))),
    S.Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: F.char_length(_digits(m)).between(10, 15)),
]
TERM = r"\p{L}{3,}"
SUPPORT = 3  # different texts that must hold both the term and the entity
DISCLOSURE = 0.9  # of the entity's information


def _entity(span: Column) -> Column:
    return F.concat_ws(":", span["kind"], F.when(span["kind"].isin("card", "phone"), _digits(span["value"]))
                       .otherwise(F.lower(span["value"])))


def _terms(text: Column) -> Column:
    """The different lower-case words of a whole text, e-mail parts left out."""
    return F.array_distinct(F.regexp_extract_all(F.regexp_replace(F.lower(text), EMAIL, " "), F.lit(TERM), F.lit(0)))


def disclosing_terms(hits: DataFrame, docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """(entity, term): terms that reveal an entity. ``hits``: (version, text, base); ``docs``: (text) of all documents.

    All frequencies count rows over the whole corpus, a term or entity once per document wherever it stands; support
    counts different texts, so copies lend none. Equal texts travel once, with their number of copies."""
    total = docs.agg(F.count("*").cast("double").alias("n"))
    mention = hits.select("version", F.explode(F.array_distinct(F.transform("base", _entity))).alias("entity")) \
        .groupBy("version", "entity").agg(F.count("*").alias("copies"))
    entities = mention.groupBy("entity").agg(F.sum("copies").alias("df_entity"), F.count("*").alias("texts")) \
        .where(F.col("texts") >= support).select("entity", "df_entity", total.scalar().alias("n"))
    # no document holds both more often than the entity, so a term of over ``most`` documents stays below the threshold
    most = F.col("n") * F.pow(F.col("df_entity") / F.col("n"), F.lit(disclosure)) * (1 + 1e-9)
    mention = staged(mention.join(entities.withColumn("most", most), "entity"), "pii-entities")
    none = hits.sparkSession.createDataFrame([], "entity string, term string")
    if mention.isEmpty():
        return none
    limit = mention.agg(F.max("most").alias("most"))
    vocabulary = docs.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df_term")) \
        .where((F.col("df_term") >= support) & (F.col("df_term") <= limit.scalar()))
    held = hits.join(mention.select("version").distinct(), "version", "left_semi")
    words = held.select("version", F.explode(_terms(F.col("text"))).alias("term")).distinct().join(vocabulary, "term")
    pairs = mention.join(words, "version").where(F.col("df_term") <= F.col("most"))
    scored = pairs.groupBy("entity", "term", "df_entity", "df_term", "n") \
        .agg(F.sum("copies").alias("both"), F.count("*").alias("texts")).where(F.col("texts") >= support)
    information = F.log(F.col("n") / F.col("df_entity"))
    shared = F.log(F.col("both") * F.col("n") / (F.col("df_entity") * F.col("df_term")))
    return scored.where((information > 0) & (shared >= disclosure * information)).select("entity", "term")


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text", support: int = SUPPORT,
         disclosure: float = DISCLOSURE) -> DataFrame:
    """(id, base, spans): ``base`` are the pattern spans, ``spans`` these and the ``term`` spans, sorted by start, then kind.

    Null texts are empty: no spans. Repeated rows get equal results; ids may be null. Empty table: no rows."""
    rows = docs.select(F.col(id_column).alias("id"), text_of(text).alias("text")).withColumn("version", F.xxhash64("text"))
    found = S.find(rows, BASE, "text", "base")
    hits = staged(found.where(F.size("base") > 0), "pii-hits")
    none = F.array().cast(f"array<{S.SPAN}>")
    clean = found.where(F.size("base") == 0).select("id", none.alias("base"), none.alias("spans"))
    flagged = staged(disclosing_terms(hits, rows.select("text"), support, disclosure), "pii-terms")
    # the terms of a document: those of its own entities, found by one alternation
    holds = hits.select("id", "version", F.explode("base").alias("s")).select("id", "version", _entity(F.col("s")).alias("entity"))
    terms = holds.join(flagged, "entity").groupBy("id", "version").agg(F.collect_set("term").alias("terms"))
    terms = terms.select(F.col("id").alias("of"), F.col("version").alias("of_version"),
                         F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(F.array_sort("terms"), "|"),
                                  F.lit(r")(?!\p{L})")).alias("pattern"))
    both = hits.join(terms, F.col("id").eqNullSafe(F.col("of")) & (F.col("version") == F.col("of_version")), "left")
    never = F.lit(r"(?!)")
    both = both.select("id", "base", "text", F.coalesce("pattern", never).alias("pattern"))
    kind = S.Kind("term", "")
    both = both.select("id", "base", F.regexp_extract_all("text", F.col("pattern"), F.lit(0)).alias("v"),
                       F.split("text", F.col("pattern"), -1).alias("g"))
    both = both.select("id", "base", S._located(F.col("g"), F.col("v"), kind, len(BASE)).alias("more"))
    more = S.untouched(F.col("more"), F.col("base"))
    return clean.unionByName(both.select("id", "base", F.array_sort(F.concat("base", more)).alias("spans")))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with entities generalised to their kind (``[EMAIL]``) and disclosing terms removed."""
    return S.redact(text, spans, lambda s: F.when(s["kind"] == "term", "").otherwise(
        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
