"""Text analytics with built-in expressions: lexicon polarity, sentiment
labels, keyword counts, per-class top keywords and word-cloud weights."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.scalar import tokens
from quire.operators.layout import stage_table
from quire.operators.ranking import top_k_per_group


def default_stopwords() -> list[str]:
    """Spark ML's English stop list (needs an active session)."""
    from pyspark.ml.feature import StopWordsRemover
    return StopWordsRemover.loadDefaultStopWords("english")


LEXICON_WORDS = 1 << 17  # different words of a lexicon that every executor holds as a table: some 10 MB


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), 0)


def _hash_table(lex: DataFrame, slots: int) -> Column:
    """A constant: one array of ``slots`` lists of (word, _polarity), each word in the slot its hash names."""
    held: list[list] = [[] for _ in range(slots)]
    for r in lex.select(F.pmod(F.xxhash64("word"), F.lit(slots)).alias("slot"), "word", "_polarity").collect():
        held[r["slot"]].append({"word": r["word"], "_polarity": r["_polarity"]})
    # one text that Spark's optimiser turns into one constant
    return F.from_json(F.lit(json.dumps(held)), "array<array<struct<word:string,_polarity:double>>>")


def _mean_of(words: Column, table: Column, slots: int) -> Column:
    """Mean polarity of the words found in the hash table; 0 if none is."""
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n"))

    def looked_up(t: Column) -> Column:
        def step(acc: Column, w: Column) -> Column:
            found = F.filter(F.get(t, F.pmod(F.xxhash64(w), F.lit(slots)).cast("int")), lambda e: e["word"] == w)
            return _let(found, lambda f: F.struct((acc["sum"] + F.coalesce(F.get(f, 0)["_polarity"], F.lit(0.0))).alias("sum"),
                                                  (acc["n"] + F.size(f)).alias("n")))
        return F.aggregate(words, start, step, lambda acc: F.when(acc["n"] > 0, acc["sum"] / acc["n"]).otherwise(0.0))

    return _let(table, looked_up)


def polarity(df: DataFrame, text: str, lexicon: DataFrame, out: str = "polarity",
             keep_text: bool = True, tokens_out: str | None = None, most_words: int = LEXICON_WORDS) -> DataFrame:
    """Mean lexicon polarity of the words of ``text`` (0 when no word is known, or no text).

    ``lexicon`` has columns (word, polarity); repeated words are averaged.
    Texts are normalised like :func:`quire.functions.scalar.tokens`. ``keep_text=False`` leaves the text
    out of the result; ``tokens_out`` adds the word list under that name.

    Once its size is checked, the lexicon becomes one hash table, a constant of the plan, and every row looks its
    own words up: one pass over the texts, no shuffle and nothing written. A lexicon of over ``most_words`` different
    words is joined with the words instead, with the same result.
    """
    lex = lexicon.where(F.col("word").isNotNull()).groupBy("word").agg(F.avg(F.col("polarity").cast("double")).alias("_polarity")) \
        .where(F.col("_polarity").isNotNull())
    size = lex.count()
    if size > most_words:
        return _joined_polarity(df, text, lex, out, keep_text, tokens_out)
    slots = 1 << max(4, (2 * size).bit_length())
    words = tokens_out or "_tokens"
    scored = df.withColumn(words, tokens(text))
    if not keep_text:
        scored = scored.drop(text)
    mean = _mean_of(F.col(words), _hash_table(lex, slots), slots)
    scored = scored.withColumn(out, F.coalesce(mean, F.lit(0.0)))
    if tokens_out:  # last, as in the joined form
        return scored.select(*[c for c in scored.columns if c != words], words)
    return scored.drop(words)


def _joined_polarity(df: DataFrame, text: str, lex: DataFrame, out: str, keep_text: bool, tokens_out: str | None) -> DataFrame:
    """The rows are numbered and written once with their words; the words are joined with the lexicon and averaged per row."""
    numbered = df.withColumns({"_row": F.monotonically_increasing_id(), "_tokens": tokens(text)})
    rows = stage_table(numbered if keep_text else numbered.drop(text), "texts")
    words = rows.select("_row", F.explode("_tokens").alias("word"))
    per = words.join(lex, "word").groupBy("_row").agg(F.avg("_polarity").alias("_mean"))
    scored = rows.join(per, "_row", "left").withColumn(out, F.coalesce("_mean", F.lit(0.0)))
    if tokens_out:
        scored = scored.withColumn(tokens_out, F.col("_tokens"))
    return scored.drop("_row", "_tokens", "_mean")


def sentiment_label(score: str | Column = "polarity", pos: float = 0.1, neg: float = -0.1) -> Column:
    """> pos Positive, < neg Negative, else Neutral (strict comparisons)."""
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s > pos, F.lit("Positive")).when(s < neg, F.lit("Negative")).otherwise(F.lit("Neutral"))


def classify(df: DataFrame, text: str, lexicon: DataFrame, label: str = "sentiment", **kw) -> DataFrame:
    """Polarity plus its three-way label."""
    return polarity(df, text, lexicon, **kw).withColumn(label, sentiment_label("polarity"))


def distribution(df: DataFrame, label: str = "sentiment") -> DataFrame:
    """Rows per label."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def keyword_counts(df: DataFrame, text: str, stopwords: list[str], by: list[str] | None = None,
                   tokens_col: str | None = None) -> DataFrame:
    """(by..., word, count) over all texts. Stop words are tested after
    punctuation removal (a hash-set ``IN``); partial counts are combined
    map-side before the shuffle. ``tokens_col`` names an already tokenized
    column (e.g. from :func:`polarity`) to use instead of ``text``."""
    by = list(by or [])
    toks = F.col(tokens_col) if tokens_col else tokens(text)
    words = df.select(*by, F.explode(toks).alias("word"))
    if stopwords:
        words = words.where(~F.col("word").isin(*sorted(set(stopwords))))
    return words.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("count"))


def top_keywords(df: DataFrame, text: str, stopwords: list[str], k: int = 20,
                 by: list[str] | None = None, tokens_col: str | None = None) -> DataFrame:
    """Top ``k`` words by count (ties by word), overall or per ``by`` group."""
    by = list(by or [])
    counts = keyword_counts(df, text, stopwords, by, tokens_col)
    if not by:
        return counts.orderBy(F.col("count").desc(), F.col("word").asc()).limit(k)
    return top_k_per_group(counts, by, [F.col("count").desc()], k, key=["word"])


def pair_counts(df: DataFrame, text: str, stopwords: list[str], by: list[str] | None = None,
                tokens_col: str | None = None) -> DataFrame:
    """(by..., first, second, count) over pairs of neighbouring words, neither of them a stop word."""
    by = list(by or [])
    words = df.select(*by, (F.col(tokens_col) if tokens_col else tokens(text)).alias("_w"))
    n = F.greatest(F.size("_w") - 1, F.lit(0))
    both = F.arrays_zip(F.slice("_w", F.lit(1), n).alias("first"), F.slice("_w", F.lit(2), n).alias("second"))
    pairs = words.select(*by, F.inline(both))
    if stopwords:
        stop = sorted(set(stopwords))
        pairs = pairs.where(~F.col("first").isin(*stop) & ~F.col("second").isin(*stop))
    return pairs.groupBy(*by, "first", "second").agg(F.count(F.lit(1)).alias("count"))


def _words_and_pairs(df: DataFrame, text: str, stopwords: list[str], by: list[str], tokens_col: str | None) -> tuple[DataFrame, DataFrame]:
    """:func:`keyword_counts` and :func:`pair_counts` from one pass over the texts: every word is counted with the word after it,
    null if there is none or it is a stop word; the words' counts are sums of these. The counts are written once."""
    words = df.select(*by, (F.col(tokens_col) if tokens_col else tokens(text)).alias("_w"))
    n = F.greatest(F.size("_w") - 1, F.lit(0))
    rows = words.select(*by, F.inline(F.arrays_zip(F.col("_w").alias("first"), F.slice("_w", F.lit(2), n).alias("second"))))
    if stopwords:
        stop = sorted(set(stopwords))
        rows = rows.where(~F.col("first").isin(*stop)).withColumn("second", F.when(~F.col("second").isin(*stop), F.col("second")))
    counts = stage_table(rows.groupBy(*by, "first", "second").agg(F.count(F.lit(1)).alias("count")), "pairs")
    single = counts.groupBy(*by, F.col("first").alias("word")).agg(F.sum("count").alias("count"))
    return single, counts.where("first is not null and second is not null")


def _log_likelihood(k: Column, n: Column, x: Column) -> Column:
    floor = F.lit(1e-10)
    return F.log(F.greatest(x, floor)) * k + F.log(F.greatest(1 - x, floor)) * (n - k)


def with_pairs(words: DataFrame, pairs: DataFrame, by: list[str], threshold: float = 30.0) -> DataFrame:
    """Word counts with the pairs that stand together more often than chance (Dunning's log-likelihood
    ratio above ``threshold``); a kept pair's uses no longer count for its words.

    ``words`` is (by..., word, count), ``pairs`` as :func:`pair_counts` gives it. Works on the counted
    vocabulary; word counts are joined to the pairs by their keys."""
    total = words.groupBy(*by).agg(F.sum("count").alias("_n"))
    first = words.select(*by, F.col("word").alias("first"), F.col("count").alias("_a"))
    second = words.select(*by, F.col("word").alias("second"), F.col("count").alias("_b"))
    p = pairs.join(first, [*by, "first"]).join(second, [*by, "second"])
    p = p.join(total, by) if by else p.withColumn("_n", total.scalar())
    c, a, b, n = F.col("count"), F.col("_a"), F.col("_b"), F.col("_n")
    ratio = -2 * (_log_likelihood(c, a, b / n) + _log_likelihood(b - c, n - a, b / n)
                  - _log_likelihood(c, a, c / a) - _log_likelihood(b - c, n - a, (b - c) / (n - a)))
    kept = p.where((n > a) & (n > b)).where(ratio > threshold).select(*by, "first", "second", "count")
    used = kept.select(*by, F.explode(F.array("first", "second")).alias("word"), (-F.col("count")).alias("count"))
    both = kept.select(*by, F.concat_ws(" ", "first", "second").alias("word"), "count")
    out = words.select(*by, "word", "count").unionByName(used).unionByName(both)
    return out.groupBy(*by, "word").agg(F.sum("count").alias("count")).where(F.col("count") > 0)


def term_weights(df: DataFrame, text: str, stopwords: list[str], k: int = 200, by: list[str] | None = None,
                 tokens_col: str | None = None, bigrams: bool = False, threshold: float = 30.0) -> DataFrame:
    """Word-cloud weights: top ``k`` words per group, weight = count / top count. ``bigrams`` adds
    word pairs that belong together (:func:`with_pairs`); the counts are then written once."""
    by = list(by or [])
    counts = keyword_counts(df, text, stopwords, by, tokens_col)
    if bigrams:
        counts = with_pairs(*_words_and_pairs(df, text, stopwords, by, tokens_col), by, threshold)
    top = top_k_per_group(counts, by, [F.col("count").desc()], k, key=["word"])
    peak = F.max("count").over(Window.partitionBy(*by))  # over at most k rows per group
    return top.withColumn("weight", F.col("count") / peak)
