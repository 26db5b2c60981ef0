"""Every stage of the corpus pipeline against plain Python, and the whole of it against its stages in a row."""

import random
import zlib

import numpy as np
import pytest
import corpus_pipeline
from quire.llm import mixing
from quire.llm.queries import word_tokenizer
from tests.llm.test_llm_operators import WORD, bits
from tests.llm.test_spans import entropy_runs, secret_base

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(corpus_pipeline.STAGES)


def made():
    rnd = random.Random(8)
    words = [f"{a}{b}" for a in ("mar", "len", "tor", "vis", "quo") for b in ("den", "pal", "rik", "so", "um")]
    rows = []
    for i in range(240):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(3, 60)))
        if i % 5 == 0:
            text = "you utter moron scum, you vile idiot " + text
        elif i % 7 == 0 and rows:
            text = rows[rnd.randrange(len(rows))][1]
        elif i % 11 == 0:
            text += ' password="Abc123+/=xyz9Q" deadbeefdeadbeef00 9F86D081884C7D659A2FEAA0C55AD015'
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    return rows + [(900, "", "en", "s0", 0), (901, None, None, None, None), (902, "x " * 2100, "en", "s1", 4200)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    rows = made()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0 and i < 240)) for i in range(240)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{path}/labels.parquet")
    return path, rows


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_toxic_documents_go_and_others_stay_as_they_are(spark, tables):
    path, rows = tables
    kept = rows_of(STAGES["toxicity"](spark, spark.read.parquet(f"{path}/documents.parquet"), path))
    toxic = {r[0] for r in rows if (r[1] or "").startswith("you utter")}
    assert [r for r in kept if r[0] not in toxic] == sorted((r for r in rows if r[0] not in toxic), key=str)
    # the model learns from some thirty of them, so a few of the others may score below the threshold
    assert set(kept) <= set(rows) and sum(r[0] in toxic for r in kept) <= len(toxic) // 4


def test_one_document_of_each_group_stays(spark, tables):
    path, rows = tables
    prints, label = [bits(r[1]) for r in rows], list(range(len(rows)))
    for _ in rows:
        before = list(label)
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4:
                    label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    least = {}
    for r, k in zip(rows, label):
        least[k] = min(least.get(k, r[0]), r[0])
    kept = rows_of(STAGES["simhash_dedup"](spark, spark.createDataFrame(rows, SCHEMA).repartition(3), path))
    assert kept == sorted((r for r in rows if r[0] in set(least.values())), key=str) and len(kept) < len(rows)


def masked(text):
    base = secret_base(text)
    found = sorted(base + [x for x in entropy_runs(text) if not any(b[0] <= x[0] and b[2] >= x[2] for b in base)])
    out, at = "", 0
    for a, _, e, _ in found:
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, e)
    return out + text[at:], bool(found)


def test_secrets_are_masked_and_lengths_follow(spark, tables):
    path, rows = tables
    want = []
    for i, text, lang, source, n in rows:
        clean, changed = masked(text or "")
        want.append((i, clean, lang, source, len(clean)) if changed else (i, text, lang, source, n))
    got = rows_of(STAGES["secrets"](spark, spark.createDataFrame(rows, SCHEMA).repartition(3), path))
    assert got == sorted(want, key=str) and sum("[SECRET]" in (r[1] or "") for r in got) > 5


def test_the_mix_keeps_whole_documents_but_one(spark, tables):
    path, rows = tables
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    queued = {r["id"]: r for r in mixing.queue(docs).collect()}
    turns = sorted(((e * r["source_size"] + r["ahead"] + r["size"]) / r["target"], r["source"] is None, r["source"] or "", e, r["ahead"], i)
                   for i, r in queued.items() if r["size"] and r["target"] for e in range(3))
    budget, total, want, by_id = sum(r["size"] for r in queued.values()), 0, [], {r[0]: r for r in rows}
    for *_, i in turns:
        if total < budget:
            n = min(queued[i]["size"], budget - total)
            text = by_id[i][1]
            if n < queued[i]["size"]:
                text = text[:list(WORD.finditer(text))[n - 1].end()]
            want.append((i, text, by_id[i][2], by_id[i][3], len(text)))
        total += queued[i]["size"]
    assert rows_of(STAGES["mixing"](spark, docs, path)) == sorted(want, key=str)


def test_pieces_are_the_documents_tokens(spark, tables):
    from tokenizers import Tokenizer
    path, rows = tables
    whole, want = Tokenizer.from_file(word_tokenizer()), []
    for i, text, *_ in rows:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(i, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes())) for k in range(0, len(ids), 2048)]
    got = STAGES["packing"](spark, spark.createDataFrame(rows, SCHEMA).repartition(3), path).toPandas()
    assert sorted(map(tuple, got[["doc_id", "piece", "start", "length", "ids_crc32"]].astype(int).to_numpy().tolist())) == sorted(want)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 2048


def test_run_is_its_stages_in_a_row(spark, tables):
    path, _ = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path).cache()
    want = corpus_pipeline.pack_sequences(spark, docs, path)
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows_of(corpus_pipeline.run(spark, path).select(pieces)) == rows_of(want.select(pieces))
    assert corpus_pipeline.pack_sequences(spark, docs.limit(0), path).count() == 0
