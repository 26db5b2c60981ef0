"""DuckDB SQL for the queries that SQL can express, over whole tables."""

from __future__ import annotations

from quire.llm import mixing, secret_scan

OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

OP3 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, octet_length(encode(body)) AS payload_bytes, body,
         list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
           (CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS BIGINT) >> (15 - 5 * (i % 4))::INTEGER) & 31) AS INTEGER), 1)),
           'string_agg', '') AS payload_digest,
         max(page_id) OVER (PARTITION BY body) AS latest FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = latest THEN NULL ELSE latest END AS refers_to FROM d
"""


def _spans(table: str, kinds: list[tuple[str, str, str]], first: int = 0) -> str:
    """CTEs ``m`` and ``found`` (doc_id, s, rank, e, kind, value): matches with their offsets, kept by each kind's test."""
    each = " UNION ALL ".join(
        f"SELECT doc_id, {first + i} AS rank, '{name}' AS kind, regexp_extract_all(text, $q${pattern}$q$) AS v, "
        f"string_split_regex(text, $q${pattern}$q$) AS g FROM {table}" for i, (name, pattern, _) in enumerate(kinds))
    keep = " ".join(f"WHEN '{name}' THEN {test}" for name, _, test in kinds)
    return f"""
m AS ({each}),
l AS (SELECT doc_id, rank, kind, v[i] AS value,
             coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(v[1:i - 1], lambda x: length(x))), 0) AS s
      FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM m WHERE len(v) > 0)),
found AS (SELECT doc_id, CAST(s AS BIGINT) AS s, rank, CAST(s + length(value) AS BIGINT) AS e, kind, value FROM l WHERE CASE kind {keep} END)"""


_JOIN = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank), '')"

_ASSIGN = secret_scan.ASSIGN
_F = f"list_value({', '.join(map(str, secret_scan.unit_terms()))})"
_W = secret_scan.WINDOW
_DENY = " OR ".join(f"regexp_matches(value, $q${p}$q$)" for p in secret_scan.ALLOW)
OP4 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{_spans('d', [('assign', _ASSIGN, f"length(regexp_extract(value, $q${_ASSIGN}$q$, 2)) >= 12"),
              ('access', 'AKIA[A-Z0-9]+', 'length(value) >= 18'), ('hex', '[0-9a-f]+', 'length(value) >= 16')])},
cm AS (SELECT doc_id, regexp_extract_all(text, $q${secret_scan.CANDIDATE}$q$) AS v, string_split_regex(text, $q${secret_scan.CANDIDATE}$q$) AS g FROM d),
cl AS (SELECT doc_id, v[i] AS value,
              coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(v[1:i - 1], lambda x: length(x))), 0) AS s
       FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM cm WHERE len(v) > 0)),
cw AS (SELECT doc_id, s, e, substr(value, e - {_W - 1}, {_W}) AS value FROM (SELECT *, unnest(range({_W}, length(value) + 1)) AS e FROM cl)),
ch AS (SELECT *, regexp_matches(value, '^[0-9A-Fa-f]+$') AS hexed, list_sum(list_transform(list_distinct(string_split(value, '')),
         lambda c: {_F}[1 + {_W} - length(replace(value, c, ''))])) AS h FROM cw),
hit AS (SELECT doc_id, s, e, hexed FROM ch WHERE h <= CASE WHEN hexed THEN {secret_scan.unit_limit(secret_scan.CLASSES['entropy_hex'])}
          ELSE {secret_scan.unit_limit(secret_scan.CLASSES['entropy_base64'])} END AND NOT ({_DENY})),
cut AS (SELECT *, coalesce(lag(hexed) OVER o <> hexed OR e - {_W} > lag(e) OVER o, true) AS fresh FROM hit WINDOW o AS (PARTITION BY doc_id, s ORDER BY e)),
isle AS (SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id, s ORDER BY e) AS isle FROM cut),
more AS (SELECT doc_id, CAST(s + min(e) - {_W} AS BIGINT) AS s, CASE WHEN hexed THEN 3 ELSE 4 END AS rank, CAST(s + max(e) AS BIGINT) AS e,
                CASE WHEN hexed THEN 'entropy_hex' ELSE 'entropy_base64' END AS kind FROM isle GROUP BY doc_id, s, isle, hexed),
spans AS (SELECT doc_id, s, rank, e, kind FROM found UNION ALL
          SELECT * FROM more a WHERE NOT EXISTS (SELECT 1 FROM found b WHERE b.doc_id = a.doc_id AND b.s <= a.s AND b.e >= a.e)),
b AS (SELECT doc_id, {_JOIN} AS b, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex FROM found GROUP BY doc_id),
a AS (SELECT doc_id, {_JOIN} AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b.b, '')) AS base_sha256, coalesce(a.spans, '') AS spans
FROM d LEFT JOIN b ON b.doc_id = d.doc_id LEFT JOIN a ON a.doc_id = d.doc_id
"""

OP5 = f"""
WITH d AS (SELECT doc_id, source, md5(coalesce(text, '')) AS version,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source),
w AS (SELECT *, CAST(nth % 3 + 1 AS DOUBLE) AS weight, 3.0::DOUBLE * source_size AS most FROM p),
u AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS total,
             coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
             sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_ FROM w),
t AS (SELECT *, max(CASE WHEN (total - full_) / open_ * weight <= most THEN (total - full_) / open_ END) OVER () AS level FROM u),
g AS (SELECT source, source_size, least(most, weight * coalesce(level, 0)) AS target FROM t),
q AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('{mixing.SEED}|' || doc_id || '|' || version), doc_id, version
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM d),
x AS (SELECT q.*, g.source_size, g.target, unnest(range({mixing.EPOCHS})) AS epoch FROM q JOIN g ON q.source IS NOT DISTINCT FROM g.source),
f AS (SELECT *, (epoch * source_size + ahead + size) / CASE WHEN target > 0 THEN target END AS finish FROM x),
s AS (SELECT *, CASE WHEN size > 0 AND finish IS NOT NULL THEN size ELSE 0 END AS due,
             coalesce(sum(CASE WHEN size > 0 AND finish IS NOT NULL THEN size ELSE 0 END) OVER (ORDER BY finish NULLS LAST, source NULLS LAST, epoch,
               ahead, doc_id, version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM f)
SELECT doc_id, size, source_size, target,
       CAST(sum(greatest(0, least(due, (SELECT sum(size) FROM d) - before))) AS BIGINT) AS taken
FROM s GROUP BY doc_id, version, source, ahead, size, source_size, target
"""

OP10 = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM d WHERE len(w) >= 20),
k AS (SELECT doc_id, i, row_number() OVER (PARTITION BY w[i:i + 19] ORDER BY doc_id, i) AS nth FROM x),
g AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 20)))) AS gone FROM k WHERE nth > 1 GROUP BY doc_id),
o AS (SELECT d.doc_id, len(w) AS n, w, coalesce(gone, []) AS gone FROM d LEFT JOIN g ON g.doc_id = d.doc_id)
SELECT doc_id, n AS n_words, len(gone) AS n_removed,
       sha256(coalesce(array_to_string(list_transform(list_filter(range(1, n + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]), ' '), '')) AS kept_sha256
FROM o
"""

OP11 = """
WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w
  FROM documents),
g AS MATERIALIZED (SELECT lang, d AS words, array_to_string(w[i:i + d - 1], ' ') AS phrase, count(*) AS a
  FROM (SELECT lang, w, d, unnest(range(1, len(w) - d + 2)) AS i FROM p, (SELECT unnest([1, 2, 3]) AS d)) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM g WHERE words = 1 GROUP BY lang),
c AS (SELECT * FROM g WHERE words > 1 AND a >= 10),
t AS (SELECT lang, a, string_split(phrase, ' ') AS w FROM c WHERE words = 3),
o AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, w[1] || ' ' || w[2] AS phrase FROM t UNION ALL
  SELECT lang, a, w[2] || ' ' || w[3] FROM t) GROUP BY ALL),
k AS (SELECT c.*, string_split(phrase, ' ') AS w FROM c LEFT JOIN o USING (lang, phrase) WHERE o.longer IS NULL OR 100 * o.longer < 50 * c.a),
u AS (SELECT *, array_to_string(w[1:cut], ' ') AS f, array_to_string(w[cut + 1:], ' ') AS e FROM (SELECT *, unnest(range(1, words)) AS cut FROM k)),
s AS (SELECT u.lang, u.phrase, u.a, x.a AS l, y.a AS r, n.n, cut, CAST((1000000 * CAST(u.a AS HUGEINT) * u.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM u JOIN g x ON x.lang = u.lang AND x.phrase = u.f JOIN g y ON y.lang = u.lang AND y.phrase = u.e JOIN n ON n.lang = u.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM b
QUALIFY rank <= 2000
"""


def _merkle(levels: int = 8, above: int = 3) -> str:
    """The manifest level by level, each level's nodes with the digests beside them (up to 8**levels rows a lang, 8**above langs)."""
    def climb(tree: str, base: str, depth: int) -> str:
        out = f"{tree}0 AS MATERIALIZED ({base})"
        for k in range(depth):
            side = "string_agg(h, '') OVER (PARTITION BY key, r // 8 ORDER BY r ROWS BETWEEN {} )"
            out += f""",
{tree}s{k} AS MATERIALIZED (SELECT key, r, coalesce({side.format('UNBOUNDED PRECEDING AND 1 PRECEDING')}, '') AS l,
  coalesce({side.format('1 FOLLOWING AND UNBOUNDED FOLLOWING')}, '') AS g FROM {tree}{k}),
{tree}{k + 1} AS MATERIALIZED (SELECT key, r // 8 AS r, n, CASE WHEN n > {8 ** k} THEN sha256(string_agg(h, '' ORDER BY r)) ELSE min(h) END AS h
  FROM {tree}{k} GROUP BY key, r // 8, n)"""
        return out

    def walk(tree: str, start: str, rows: str, depth: int) -> str:
        out, before = "", start
        for k in range(depth):
            out += f""",
{rows}{k} AS MATERIALIZED (SELECT a.* REPLACE (CASE WHEN a.{tree}n > {8 ** k} THEN sha256(s.l || a.folded || s.g) ELSE a.folded END AS folded,
  CASE WHEN a.{tree}n > {8 ** k} THEN a.proof || s.l || s.g ELSE a.proof END AS proof)
  FROM {before} a JOIN {tree}s{k} s ON s.key = a.{tree}key AND s.r = a.{tree}r // {8 ** k})"""
            before = f"{rows}{k}"
        return out

    part = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
    leaf = lambda text: "sha256(" + " || ".join(part.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    base = "SELECT key, r, n, h FROM d"
    return f"""
WITH t AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
i AS (SELECT *, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS key, {leaf('text')} AS h, {leaf('lowered')} AS hl,
   xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
     lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), CAST(4294967295 AS BIGINT)), 4294967295) % 3 = 0 AS hit
   FROM (SELECT *, {lowered} AS lowered FROM documents), t),
d AS MATERIALIZED (SELECT doc_id, key, h, CASE WHEN hit THEN hl ELSE h END AS used, count(*) OVER (PARTITION BY key) AS n,
   row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, h) - 1 AS r FROM i),
{climb('a', base, levels)},
z AS MATERIALIZED (SELECT key AS lang, h, row_number() OVER (ORDER BY key) - 1 AS r, count(*) OVER () AS n FROM a{levels}),
{climb('b', "SELECT 0 AS key, r, n, h FROM z", above)},
w AS (SELECT doc_id, d.h AS leaf, z.h AS subroot, used AS folded, '' AS proof, d.key AS akey, d.r AS ar, d.n AS an,
   0 AS bkey, z.r AS br, z.n AS bn FROM d JOIN z ON z.lang = d.key){walk('a', 'w', 'x', levels)}{walk('b', f'x{levels - 1}', 'y', above)}
SELECT doc_id, leaf, subroot, b{above}.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = b{above}.h AS verified
FROM y{above - 1}, b{above}
"""


ORACLES = {"op1_exact_top_k": OP1, "op3_warc_captures": OP3, "op4_secret_spans": OP4, "op5_mix_sources": OP5,
           "op10_repeated_passages": OP10, "op11_phrase_collocations": OP11, "op12_merkle_manifest": _merkle()}
