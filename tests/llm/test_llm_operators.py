"""Every operator on hard rows (nulls, empty and long texts, repeated rows, clashing columns) against brute force,
and on empty tables."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from quire.llm import (components, mixing, multiset_hash, packing, pii, secret_scan, simhash, spans, substring,
                       toxicity, va_search, warc)
from quire.llm.queries import may_train, word_tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PASSAGE = " ".join(f"w{i * i % 83}" for i in range(60))
ROWS = [
    (1, "Alpha beta gamma delta epsilon\nzeta eta theta.", "src0"), (2, None, "src1"), (3, "", None), (None, "lone text", "src1"),
    (4, PASSAGE + " tail one", "src0"), (5, "head " + PASSAGE, "src0"), (6, PASSAGE + " tail one", "src2"),
    (6, PASSAGE + " tail one", "src2"), (7, "Éa b  c\t" * 3000, "src1"), (8, " \n\t ", "src0"),
    (9, 'x password="Abc123+/=xyz9" a.b@c.de 10.0.0.255 +1 (988) 555-2485, card 4111 1111 1111 1111', "src2"),
    (10, PASSAGE + " " + PASSAGE, "src0"),
]
SCHEMA = "doc_id long, text string, source string, spans int, fp string, n_chars long, size int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, s, 1, "x", len(t or ""), 0) for i, t, s in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_packing_gives_the_tokenizers_ids_and_fits(docs, none):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(word_tokenizer())
    want = []
    for i, t, _ in ROWS:
        ids = np.array(whole.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(i, k // 64, k, len(ids[k:k + 64]), zlib.crc32(ids[k:k + 64].tobytes())) for k in range(0, len(ids), 64)]
    pieces = packing.token_pieces(docs, word_tokenizer(), capacity=64).select(
        "id", "piece", "start", "length", F.crc32("ids").alias("crc"))
    got = packing.pack(pieces, pieces.columns, 64).toPandas()
    assert sorted(map(str, want)) == sorted(str((None if i != i else int(i), *map(int, r))) for i, *r in
                                            got[["id", "piece", "start", "length", "crc"]].itertuples(index=False))
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 64
    assert packing.pack(packing.token_pieces(none, word_tokenizer()).drop("ids"), ["id"]).count() == 0


def test_plan_fills_bins_exactly_where_it_can():
    assert sum(t for t, _ in packing.plan({6: 4, 4: 4, 5: 2}, 10)) == 5
    assert packing.plan({}, 10) == []


def bits(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = WORD.findall(t)
    s = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components(docs, none, spark):
    got = simhash.near_duplicates(docs).select("id", simhash.hex_fingerprint().alias("f"), "component").collect()
    prints = [bits(t) for _, t, _ in ROWS]
    label = list(range(len(ROWS)))
    for _ in ROWS:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4:
                    label[i] = label[j] = min(label[i], label[j])
    least = {k: min((ROWS[i][0] for i in range(len(ROWS)) if label[i] == k and ROWS[i][0] is not None), default=None) for k in label}
    want = [(i, f"{p:016x}", least[k]) for (i, _, _), p, k in zip(ROWS, prints, label)]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(label))


def test_simhash_of_texts_over_a_slab(monkeypatch):
    import quire.llm.common as common
    texts = ["x" * 90 + " b c d e f", "  " * 60 + "one", "a " + "y" * 80 + " b", "a b " + "z" * 99, "a b c d" + " " * 90,
             " ".join(f"w{i * i % 31}" for i in range(300)), "k" * 200, " " * 150, "a b c" + "\n" * 70 + "d", "short one"]
    monkeypatch.setattr(simhash, "slabs", lambda texts, overlap: common.slabs(texts, overlap, 30))
    assert simhash.text_fingerprints([t.encode() for t in texts]).tolist() == [bits(t) for t in texts]


def test_links_between_tiles_and_chains(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40)
    near = [int(b) ^ (1 << int(p)) ^ (1 << int(q)) for b in base for p, q in rng.integers(0, 60, (6, 2))]
    values = sorted({*map(int, base), *near})
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    roots = {r["node"]: r["root"] for r in components.components(simhash.links(df, 4, tile=8)).collect()}
    label = {v: v for v in values}
    for _ in range(12):
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= 4:
                    label[a] = label[b] = min(label[a], label[b])
    assert {v: roots.get(v, v) for v in values} == label


def test_repeated_passages(docs, none):
    rows = sorted(({(i, t) for i, t, _ in ROWS}), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, want = set(), {}
    for i, t in rows:
        w, gone = WORD.findall(t or ""), set()
        for p in range(len(w) - 19):
            k = tuple(w[p:p + 20])
            if k in seen:
                gone.update(range(p, p + 20))
            seen.add(k)
        want[i] = (len(w), len(gone), " ".join(x for n, x in enumerate(w) if n not in gone))
    got = substring.deduplicate(docs).collect()
    assert len(got) == len(ROWS) and {r["id"]: tuple(r)[1:] for r in got} == want
    assert substring.deduplicate(none).count() == 0


def test_passages_in_long_texts_and_small_batches(monkeypatch):
    import quire.llm.common as common
    text = " ".join(f"w{i * i % 97}" for i in range(3000)).encode()
    whole = substring._windows([text], 20, 8)
    monkeypatch.setattr(substring, "slabs", lambda texts, overlap: common.slabs(texts, overlap, 700))
    assert all((a == b).all() for a, b in zip(whole, substring._windows([text], 20, 8)))


class Marks:
    """Answers that let every anchor through and hold the given ones for hot."""

    def __init__(self, hot=()):
        self.hot = np.array(hot, np.uint64)

    def holds(self, hashes, name):
        return np.ones(len(hashes), bool) if name == "often" else np.isin(hashes, self.hot)


def settled(texts, hot, rounds=False):
    """Intervals of texts that meet after the shuffle, one text per block."""
    import pyarrow as pa
    parts = [substring._combine(np.array([i]), np.array([0], np.int32), [t.encode()], 20, 8, i, Marks(hot)) for i, t in enumerate(texts)]
    rows = pa.Table.from_batches(parts).sort_by([(c, "ascending") for c in ("anchor", "doc", "version", "start")])
    found = [r for b in substring._settle(20, rounds)(iter(rows.to_batches(max_chunksize=3))) for r in b.to_pylist()]
    return sorted({(r["doc"], w) for r in found if r["stop"] for w in range(r["start"], r["stop"])}), rows, [r for r in found if not r["stop"]]


def test_passages_with_one_anchor_and_like_hashes(monkeypatch):
    def anchor(r):
        buf = np.frombuffer(r.encode(), np.uint8)
        return substring.rolling(substring.word_hashes(buf, *substring.word_bounds(buf)), np.array([0]), np.array([8]))[0]

    run = min((" ".join(f"common{k}n{i}" for i in range(8)) for k in range(2000)), key=anchor)  # below most other hashes
    texts = [" ".join([*(f"a{i}x{j}" for j in range(12)), run, *(f"b{i}x{j}" for j in range(12))]) for i in range(40)] * 2
    want = [(d, w) for d in range(40, 80) for w in range(32)]
    _, rows, _ = settled(texts, [])
    hot = np.unique(rows["anchor"].to_numpy()).view(np.uint64)
    assert settled(texts, hot)[0] == want
    # a hot anchor's windows travel one by one, under keys of their own; of each the first copy goes on to the second round
    shared = np.unique(rows["anchor"].to_numpy(), return_counts=True)[1].max()
    _, single, on = settled(texts, hot, rounds=True)
    assert shared >= 40 and np.unique(single["anchor"].to_numpy(), return_counts=True)[1].max() <= 2
    assert len(on) == 40 * 13 and all(r["hot"] and len(r["windows"]) == 1 + substring.HASH_BYTES for r in on)
    rolling = substring.rolling
    with monkeypatch.context() as m:  # windows that agree in 40 bits
        m.setattr(substring, "rolling", lambda v, a, b: rolling(v, a, b) & np.uint64(0xFFFFFF0000000000))
        assert settled(texts, [])[0] == want
    monkeypatch.setattr(substring, "word_hashes", lambda buf, a, b: np.zeros(len(a), np.uint64))
    assert settled(texts, [])[0] == want  # the second hash alone


@pytest.mark.parametrize("hot_rows,size", [(0, 300), (0, 1 << 20), (3, 300), (1 << 14, 300), (1 << 14, 1)])
def test_hot_anchors_and_blocks_leave_the_result(docs, hot_rows, size):
    assert rows_of(substring.deduplicate(docs, hot_rows=hot_rows, block_bytes=size)) == rows_of(substring.deduplicate(docs))


def test_a_passage_in_very_many_blocks(spark):
    rows = spark.range(400).selectExpr("id AS doc_id", f"concat('own', id, ' {PASSAGE} end', id) AS text").repartition(4)
    got = substring.deduplicate(rows, hot_rows=5, block_bytes=500).groupBy("n_removed").count().collect()
    assert {tuple(r) for r in got} == {(0, 1), (60, 399)}


def test_fingerprints_and_edits(docs, none):
    rows = sorted(({(i, t or "") for i, t, _ in ROWS if i != 6}), key=lambda r: (r[0] is not None, r[0] or 0))
    got = {r["id"]: r for r in multiset_hash.fingerprint_edits(docs.where("doc_id IS NULL OR doc_id != 6")).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        edited = t[:len(t) - q] + after[:q]
        assert got[i]["edited"] == hashlib.sha256(edited.encode()).hexdigest() and got[i]["n_chars"] == len(t)
        assert got[i]["fingerprint"] == multiset_hash.of_text(t).hex()
        assert got[i]["edited_fingerprint"] == multiset_hash.of_text(edited).hex()
        assert 0 <= got[i]["near_next"] <= 1 and (got[i]["near_edited"] == 1) == (edited == t)
    assert multiset_hash.fingerprint_edits(docs).count() == len(ROWS)
    assert multiset_hash.fingerprint_edits(none).count() == 0


def test_fingerprints_are_homomorphic():
    a, b = [b"one two", b"three"], [b"four five six", b"one two"]
    both = multiset_hash.of_paragraphs(a) + multiset_hash.of_paragraphs(b)
    assert both.hex() == multiset_hash.of_paragraphs([*reversed(b), *a]).hex()
    assert (both - multiset_hash.of_paragraphs(b)).hex() == multiset_hash.of_paragraphs(a).hex()
    assert multiset_hash.Fingerprint.parse(both.hex()).likeness(both) == 1.0


def test_fingerprints_do_not_depend_on_the_slab():
    a = [b"one two three", b"", b"four " * 9 + b"five", b"  " * 40 + b"six seven", b"x" * 90 + b" y z", b"eight"]
    whole = multiset_hash.of_paragraphs(a)
    for limit in (1, 7, 20, 64):
        assert multiset_hash.of_paragraphs(a, limit).hex() == whole.hex()
        assert multiset_hash.of_paragraphs(a[::-1], limit).hex() == whole.hex()


def test_edits_and_order_of_texts_over_a_slab():
    lines = [f"line {i} of {i * i % 89} words and {i % 7}" for i in range(50_000)]
    text, turned = "\n".join(lines), "\n".join(reversed(lines))
    mark = multiset_hash.of_text(text)
    assert len(text) > 1 << 20 and multiset_hash.of_text(turned).hex() == mark.hex()
    edited, after = multiset_hash._edit(text, mark, "a new end\nof two lines " * 9)
    assert after.hex() == multiset_hash.of_text(edited).hex() and after.hex() != mark.hex()


def test_warc_round_trip(spark, tmp_path):
    pages = [(1, "http://a.b/c d\r\n?q", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "v", ""), (5, "w", "a\r\n\r\nWARC/1.1\r\n\r\nb"),
             (7, "x", "<p>é</p>"), (7, "x", "<p>é</p>"), (None, "z", "only"), (None, "z", "<p>é</p>")]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, digest int")
    most = {}
    for i, _, h in pages:
        most[h or ""] = max(most.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in pages:
        raw = (h or "").encode()
        fresh = (-1 if i is None else i) == most[h or ""]
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if fresh else "revisit",
                     None if fresh else most[h or ""]))
    assert rows_of(warc.archive_captures(df)) == sorted(want, key=str)
    assert warc.archive_captures(df.limit(0)).count() == 0
    warc.write(df, str(tmp_path / "w"))
    found = warc.assemble(warc.read(spark, str(tmp_path / "w"))).collect()
    assert len(found) == len(pages) and all(len(r["requests"]) == len(r["metadata"]) == 1 for r in found)


def test_secrets(docs, none):
    got = {r["id"]: r for r in secret_scan.scan(docs).collect()}
    assert spans_of(got[9]["base"]) == ["assign:2:25"] and got[3]["spans"] == [] and len(got) == len({i for i, _, _ in ROWS})
    text = "k = Zk3Jx8Qw1Vn5Hs7Tb2Lr9 and 123e4567-e89b-12d3-a456-426614174000 and internationalisations"
    one = secret_scan.scan(none.sparkSession.createDataFrame([(1, text)], "doc_id long, text string"))
    assert [s.split(":")[0] for s in spans_of(one.first()["spans"])] == ["entropy_base64"]
    clean = one.select(secret_scan.masked(F.col("text"), F.col("spans"))).first()[0]
    assert clean.startswith("k = [SECRET] and 123e4567") and secret_scan.scan(none).count() == 0


def spans_of(found):
    return [f"{s['kind']}:{s['start']}:{s['end']}" for s in found]


def test_personal_data(docs, none, spark):
    got = {r["id"]: r for r in pii.scan(docs).collect()}
    assert [x.split(":")[0] for x in spans_of(got[9]["base"])] == ["email", "ip", "phone", "card"]
    hard = "a@b.c%d@e.f 1.2.3.4.5.6.7.8 999.1.1.1.2 " + "5" * 30 + " x 4111-1111-1111-1111 a@" + "b." * 30000 + "c " + "7" * 50000
    one = pii.scan(spark.createDataFrame([(1, hard)], "doc_id long, text string")).first()
    assert [x.split(":")[0] for x in spans_of(one["base"])] == ["email", "email", "ip", "ip", "card", "email"]
    assert pii.scan(none).count() == 0
    told = [(i, f"note {i} zanzibar quux of me@x.org the end {i}") for i in range(4)] + \
           [(10 + i, f"the end of note {i} without any") for i in range(30)]
    told = spark.createDataFrame(told, "doc_id long, text string")
    found = {r["id"]: spans_of(r["spans"]) for r in pii.scan(told).collect()}
    assert "term:7:15" in found[0] and all(not s for i, s in found.items() if i >= 10)
    clean = pii.scan(told).where("id = 0").select(pii.sanitised(F.lit("note 0 zanzibar quux of me@x.org the end 0"), F.col("spans"))).first()[0]
    assert "zanzibar" not in clean and "[EMAIL]" in clean


def test_terms_far_from_the_entity(spark):
    fill = lambda i: " ".join(f"{w} {i}" for w in ["plain", "words"] * 60)
    told = [(i, f"Zanzibar heads note {i} {fill(i)} write me@x.org") for i in range(4)] + \
           [(4, "zanzibar me@x.org"), (5, "x" * 200 + " me@x.org quagga " + "y" * 200), (5, "x" * 200 + " me@x.org quagga " + "y" * 200)] + \
           [(10 + i, f"plain words heads note write {fill(i)}") for i in range(30)]
    rows = spark.createDataFrame(told, "doc_id long, text string")
    found = {r["id"]: spans_of(r["spans"]) for r in pii.scan(rows).collect()}
    assert all("term:0:8" in found[i] for i in range(5)) and all(not s for i, s in found.items() if i >= 10)
    assert found[0] == ["term:0:8", f"email:{len(told[0][1]) - 8}:{len(told[0][1])}"]
    assert [s.split(":")[0] for s in found[5]] == ["email"]  # copies lend no support


def test_mixing(docs, none):
    got = mixing.taken(mixing.queue(docs)).toPandas()
    assert len(got) == len(ROWS) and (got.taken <= 3 * got["size"]).all()
    assert got["size"].sum() == sum(len(WORD.findall(t or "")) for _, t, _ in ROWS)
    again = mixing.taken(mixing.queue(docs.repartition(5))).toPandas()
    assert sorted(map(str, got.itertuples(index=False))) == sorted(map(str, again.itertuples(index=False)))
    mixed = mixing.mixed_texts(docs).select(F.sum(F.regexp_count("text", F.lit(WORD.pattern)))).first()[0]
    assert mixed == got.taken.sum() and mixing.taken(mixing.queue(none)).count() == 0


def test_the_mix_is_sent_in_order_of_finish(docs, none):
    queued = mixing.queue(docs).cache()
    rows = queued.collect()
    budget, total, want = sum(r["size"] for r in rows), 0, []
    turns = [((e * r["source_size"] + r["ahead"] + r["size"]) / r["target"], r["source"] is None, r["source"] or "", e, r["ahead"], r)
             for r in rows if r["size"] and r["target"] for e in range(3)]
    for *_, r in sorted(turns, key=lambda t: t[:5]):
        if total < budget:
            want.append((r["id"], r["source"], min(r["size"], budget - total), total))
        total += r["size"]
    order = sorted(mixing.schedule(queued).collect(), key=lambda r: r["before"])
    assert [(r["id"], r["source"], r["words"], r["before"]) for r in order] == want and len({r["source"] for r in order}) > 2
    sent = [(r["doc_id"], len(WORD.findall(r["text"]))) for r in mixing.mixed_texts(docs).collect()]
    assert sum(n for _, n in sent) == budget and [n for _, n in sent] == [w for _, _, w, _ in want]
    assert mixing.taken(queued).agg(F.sum("taken")).first()[0] == budget
    assert mixing.mixed_texts(none).count() == 0


def test_sources_come_near_their_targets(spark):
    rows = [(i, "word " * (1 + i * i % 50), f"s{i * i % 7 % 4}") for i in range(3000)]
    got = mixing.taken(mixing.queue(spark.createDataFrame(rows, "doc_id long, text string, source string"))).toPandas()
    per = got.groupby("target").taken.sum()
    assert (abs(per - per.index) <= 100).all() and (got.taken <= 3 * got["size"]).all()


def test_first_words(spark):
    df = spark.createDataFrame([(" a  b\tc ", n) for n in (1, 2, 3, 4)], "t string, n long")
    assert [r[0] for r in df.select(mixing.first_words(F.col("t"), F.col("n"))).collect()] == [" a", " a  b", " a  b\tc", " a  b\tc "]


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [0.3] * 8 if i % 3 == 0 else [float(x) for x in rng.normal(size=8).round(1)], 0) for i in range(600)]
    bad = [(1000, None, 0), (1001, [float("nan")] * 8, 0), (1002, [None] * 8, 0), (None, [1.0] * 8, 0), (600, [], 0), rows[7]]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, cid int")
    got = va_search.top_k(df, F.col("vec_id") % 100 == 0, block=4).collect()
    rows += [(600, [0.0] * 8, 0), rows[7]]  # the repeated row is a candidate of its own
    m = np.array([[int(np.floor(1024 * x)) for x in v] for _, v, _ in rows])
    want = set()
    for q in range(0, 601, 100):
        best = sorted((-int(s), rows[i][0]) for i, s in enumerate(m @ m[q]) if i != q)[:10]
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    assert {tuple(r) for r in got} == want and va_search.top_k(df.limit(0), F.lit(True)).count() == 0


def test_search_takes_every_row_of_a_repeated_id_and_large_components(spark):
    rng = random.Random(3)
    rows = [(i // 3 if i % 2 else i, [float(rng.randint(-3, 3)) for _ in range(3)]) for i in range(120)]
    rows += [(0, rows[0][1])] * 2 + [rows[5]] * 14 + [(77, [2.0 ** 40, -(2.0 ** 44), 1.0]), (78, [1e30, 0.0, 0.0]), (100, [2.0 ** 41, 3.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = Counter(tuple(r) for r in va_search.top_k(df, F.col("vec_id") % 20 == 0, block=3).collect())
    whole = [(i, tuple(max(-2 ** 57, min(2 ** 57, int(np.floor(1024 * x)))) for x in v)) for i, v in rows]
    want, top = Counter(), 2 ** 63 - 1
    for q in {r for r in whole if r[0] % 20 == 0}:
        left = list(whole)
        left.remove(q)
        best = sorted((-sum(a * b for a, b in zip(v, q[1])), i) for i, v in left)[:10]
        want.update((q[0], n + 1, i, max(-top, min(top, -s))) for n, (s, i) in enumerate(best))
    assert got == want


def test_toxicity_learns_and_survives_bad_labels(spark):
    text = lambda i: ("you utter moron scum, " if i % 4 == 0 else "a fine day ") + f"said {i} of them"
    docs = spark.createDataFrame([(i, text(i)) for i in range(400)] + [(None, None), (900, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (5, None), (777, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, trainable=may_train)
    got = model.score(docs, ["doc_id"]).toPandas()
    held = got[got.doc_id.map(lambda i: i == i and i < 400 and zlib.crc32(str(int(i)).encode()) % 3 == 1)]
    assert len(got) == 402 and ((held.score >= 0.7) == (held.doc_id % 4 == 0)).mean() > 0.95
    assert toxicity.fit(docs, labels.limit(0)).score(docs, ["doc_id"]).agg(F.max("score")).first()[0] == 0.0


def test_stages_keep_the_columns(spark, docs, none, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([(i, int(i == 9)) for i in range(1, 11)], "doc_id long, toxic int").write.parquet(path + "/labels.parquet")
    for table in (docs, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, table, path).columns == docs.columns, name
    masked = dict(corpus_pipeline.STAGES)["secrets"](spark, docs, path).where("doc_id = 9").first()
    assert masked["text"].startswith("x [SECRET]\" a.b@c.de") and masked["n_chars"] == len(masked["text"])
    assert corpus_pipeline.STAGES[-1][1](spark, docs, path).count() >= docs.count()


def test_joined_spans(spark):
    one = spans.find(spark.createDataFrame([("aé1b22",)], "t string"), [spans.Kind("n", "[0-9]+")], "t", "s")
    assert one.select(spans.joined(F.col("s"))).first()[0] == "n:2:3,n:4:6"
