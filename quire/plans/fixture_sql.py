"""Fixture views as SQL text, for the DuckDB oracle (same definitions as
:mod:`quire.sources.fixtures`). Oracle queries start with ``WITH`` + the
views they need, as the oracle side only has the raw tables registered."""

from __future__ import annotations

VIEWS = {
    "reviews_fx": """select cast((l_orderkey*10+l_linenumber)*2+added as bigint) as review_id, o_custkey as user_id,
  case when added=0 then l_partkey else -l_partkey end as item_id,
  case when (l_orderkey+l_linenumber)%41=0 then null
       when (l_orderkey+l_partkey)%97=0 then 'Random House'
       else cast(cast(1+(l_orderkey*7+l_partkey*3+l_linenumber)%5 as double) as string) end as score_raw,
  cast(788918400+((l_orderkey*37+l_linenumber)%2400)*86400 as bigint) as review_time,
  o_orderdate as review_ts, cast(l_quantity as int) as review_length
from lineitem join orders on l_orderkey=o_orderkey
join (values (0), (1)) x(added) on added=0 or (l_orderkey+l_linenumber)%10=9""",
    "books_fx": """select p_partkey as item_id, p_name as title, '[''' || p_brand || ''']' as authors,
  case when p_partkey%6=0 then null else '[''' || p_type || ''']' end as categories,
  case when p_partkey%3=0 then null when p_partkey%101=0 then 'A&C Black'
       when p_partkey%50=1 then cast(p_size*40 as string) else cast(p_size as string) end as ratings_raw
from part""",
    "merged_fx": """select r.*, b.title, b.authors, b.categories, try_cast(r.score_raw as double) as score,
  cast(try_cast(b.ratings_raw as int) as double) as ratings_count
from reviews_fx r left join books_fx b on r.item_id=b.item_id""",
    "docs_fx": """select case when added=0 then d.doc_id else -1-d.doc_id end as doc_id, d.lang, d.source,
  case when added=0 then d.text end as text,
  case when l.quality=1 then cast(4+d.doc_id%2 as double) when l.quality=0 then cast(1+d.doc_id%3 as double) end as score
from documents d left join labels l on d.doc_id=l.doc_id
join (values (0), (1)) x(added) on added=0 or d.doc_id%43=0""",
    "dup_fx": """select user_id, item_id, score_raw from reviews_fx
join (values (0), (1), (2), (3)) x(added) on added=0 or review_id%3=0""",
    "gap_fx": """select event_id, ts, user_id, event_type, value from events
union all select event_id, ts, user_id, event_type, cast('NaN' as double) from events where event_id%53=0
union all select event_id, ts, user_id, event_type, cast(null as double) from events where event_id%31=0
union all select event_id, ts + interval 400 days, user_id, event_type, value from events where event_id%97=0""",
}

DEPENDS = {"merged_fx": ["reviews_fx", "books_fx"], "dup_fx": ["reviews_fx"]}
ORDER = ["reviews_fx", "books_fx", "merged_fx", "docs_fx", "dup_fx", "gap_fx"]


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the fixture views it mentions (and their inputs)."""
    needed: set[str] = set()

    def add(v: str) -> None:
        if v in needed:
            return
        for d in DEPENDS.get(v, []):
            add(d)
        needed.add(v)

    for v in ORDER:
        if v in sql:
            add(v)
    if not needed:
        return sql.strip()
    ctes = ",\n".join(f"{v} as (\n{VIEWS[v]}\n)" for v in ORDER if v in needed)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
