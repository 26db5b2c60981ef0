"""Registered queries: lexicon sentiment, keywords, word-cloud weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import text
from quire.plans.params import LEXICON, STOPWORDS, lexicon_sql, stopwords_sql
from quire.plans.registry import query, rounded
from quire.sources import fixtures as fx


def _lexicon(spark):
    return spark.createDataFrame(LEXICON, "word string, polarity double")


def _classified(spark, sf, keep_text: bool = True, tokens_out: str | None = None):
    docs = fx.docs_fx(spark, sf).where(F.col("text").isNotNull()).select("doc_id", "text")
    return text.classify(docs, "text", _lexicon(spark), keep_text=keep_text, tokens_out=tokens_out)


def _tok(col: str = "text") -> str:
    return (f"list_filter(regexp_split_to_array(regexp_replace(lower({col}), '[^a-z \\t\\n\\r\\f\\x0B]', '', 'g'), "
            f"'[ \\t\\n\\r\\f\\x0B]+'), lambda t: t <> '')")


_TOK = _tok()

# doc -> polarity in SQL: unnest words, join the lexicon, average; 0 when no word is known.
_POLARITY_SQL = f"""with lex as (select word, avg(polarity) as polarity from {lexicon_sql()} group by word),
d as (select doc_id, text from docs_fx where text is not null),
w as (select doc_id, unnest({_TOK}) as word from d),
p as (select w.doc_id, avg(lex.polarity) as pol from w join lex on w.word = lex.word group by w.doc_id),
s as (select d.doc_id, coalesce(p.pol, 0.0) as polarity from d left join p on d.doc_id = p.doc_id),
lab as (select doc_id, polarity, case when polarity > 0.1 then 'Positive' when polarity < -0.1 then 'Negative'
  else 'Neutral' end as sentiment from s)"""


@query("sentiment_label", _POLARITY_SQL + "\nselect doc_id, round(polarity, 6) as polarity, sentiment from lab")
def sentiment_label(spark, sf):
    return rounded(_classified(spark, sf, keep_text=False).select("doc_id", "polarity", "sentiment"), ["polarity"])


@query("sentiment_distribution", _POLARITY_SQL + "\nselect sentiment, count(*) as count from lab group by sentiment")
def sentiment_distribution(spark, sf):
    return text.distribution(_classified(spark, sf, keep_text=False), "sentiment")


_WORDS_SQL = f"""with d as (select doc_id, text from docs_fx where text is not null),
w as (select doc_id, unnest(list_filter({_TOK}, lambda x: not list_contains({stopwords_sql()}, x))) as word from d)"""


@query("top_keywords", _WORDS_SQL + """
select word, count(*) as count from w group by word order by count desc, word asc limit 20""")
def top_keywords(spark, sf):
    docs = fx.docs_fx(spark, sf).where(F.col("text").isNotNull())
    return text.top_keywords(docs, "text", STOPWORDS, 20)


_LABEL_WORDS_SQL = _POLARITY_SQL + f""",
lw as (select sentiment, unnest(list_filter({_tok('d.text')}, lambda x: not list_contains({stopwords_sql()}, x))) as word
      from lab join d on lab.doc_id = d.doc_id),
c as (select sentiment, word, count(*) as count from lw group by sentiment, word)"""


@query("top_keywords_by_label", _LABEL_WORDS_SQL + """,
r as (select *, row_number() over (partition by sentiment order by count desc, word asc) as rank from c)
select sentiment, word, count, rank from r where rank <= 20 and sentiment in ('Positive', 'Negative')""")
def top_keywords_by_label(spark, sf):
    lab = _classified(spark, sf, keep_text=False, tokens_out="words").where(F.col("sentiment").isin("Positive", "Negative"))
    out = text.top_keywords(lab, "text", STOPWORDS, 20, by=["sentiment"], tokens_col="words")
    return out.select("sentiment", "word", "count", F.col("rank").cast("bigint").alias("rank"))


@query("term_weights", _LABEL_WORDS_SQL + """,
r as (select *, row_number() over (partition by sentiment order by count desc, word asc) as rank from c)
select sentiment, word, count, round(count / max(count) over (partition by sentiment), 6) as weight
from r where rank <= 200""")
def term_weights(spark, sf):
    lab = _classified(spark, sf, keep_text=False, tokens_out="words")
    out = text.term_weights(lab, "text", STOPWORDS, 200, by=["sentiment"], tokens_col="words")
    return rounded(out.select("sentiment", "word", "count", "weight"), ["weight"])


def _llr_sql(k: str, n: str, x: str) -> str:
    return f"(ln(greatest({x}, 1e-10)) * ({k}) + ln(greatest(1 - {x}, 1e-10)) * (({n}) - ({k})))"


_PAIR_SCORE = (f"-2 * ({_llr_sql('p.c', 'a.count', 'b.count / t.n')} + {_llr_sql('b.count - p.c', 't.n - a.count', 'b.count / t.n')}"
               f" - {_llr_sql('p.c', 'a.count', 'p.c / a.count')}"
               f" - {_llr_sql('b.count - p.c', 't.n - a.count', '(b.count - p.c) / (t.n - a.count)')})")


@query("term_weights_bigrams", _LABEL_WORDS_SQL + f""",
dw as (select sentiment, {_tok('d.text')} as words from lab join d on lab.doc_id = d.doc_id),
pr as (select sentiment, unnest(list_zip(words[1:len(words) - 1], words[2:])) as w from dw where len(words) > 1),
pc as (select sentiment, w[1] as first, w[2] as second, count(*) as c from pr
  where not list_contains({stopwords_sql()}, w[1]) and not list_contains({stopwords_sql()}, w[2]) group by all),
t as (select sentiment, sum(count) as n from c group by sentiment),
kept as (select p.* from pc p join c a on a.sentiment = p.sentiment and a.word = p.first
  join c b on b.sentiment = p.sentiment and b.word = p.second join t on t.sentiment = p.sentiment
  where t.n > a.count and t.n > b.count and {_PAIR_SCORE} > 30),
u as (select sentiment, word, count from c union all select sentiment, first, -c from kept
  union all select sentiment, second, -c from kept union all select sentiment, first || ' ' || second, c from kept),
f as (select sentiment, word, cast(sum(count) as bigint) as count from u group by sentiment, word having sum(count) > 0),
r as (select *, row_number() over (partition by sentiment order by count desc, word asc) as rank from f)
select sentiment, word, count, round(count / max(count) over (partition by sentiment), 6) as weight from r where rank <= 200""")
def term_weights_bigrams(spark, sf):
    lab = _classified(spark, sf, keep_text=False, tokens_out="words")
    out = text.term_weights(lab, "text", STOPWORDS, 200, by=["sentiment"], tokens_col="words", bigrams=True)
    return rounded(out.select("sentiment", "word", "count", "weight"), ["weight"])
