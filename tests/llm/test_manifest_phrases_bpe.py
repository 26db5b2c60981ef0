"""Merkle manifest, phrase collocations and streaming byte-pair encoding against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import bpe_stream, merkle, phrases, tally
from quire.llm.queries import word_tokenizer

TEXTS = ["", None, "A b a B a b. a b a b!\tc\r\nd  e ", "the end", "the the the the, the the", "x" * 300 + " y", "é É ß. é É ß",
         "new york city is new york city; new york", "a  b\x0bc", ",;.", " \t ", "one"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- Merkle manifest -----------------------------------------------------------------------------

def climb(leaves):
    """Root of a list of digests and each leaf's [(left, right)] from below."""
    paths, nodes, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for i, n in enumerate(at):
            run = n // 8 * 8
            paths[i].append(("".join(nodes[run:n]), "".join(nodes[n + 1:run + 8])))
        nodes = [sha("".join(nodes[r:r + 8])) for r in range(0, len(nodes), 8)]
        at = [n // 8 for n in at]
    return nodes[0], paths


def wanted(rows):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = lambda t: t and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    langs, out = {}, []
    for r in rows:
        langs.setdefault(r[2], []).append((sha("".join(map(enc, r))), r))
    tops = {}
    for lang, items in langs.items():
        items.sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        tops[lang] = (*climb([h for h, _ in items]), items)
    order = sorted(tops, key=lambda x: (x is not None, (x or "").encode()))
    root, above = climb([tops[x][0] for x in order])
    for lang, outer in zip(order, above):
        sub, paths, items = tops[lang]
        for (leaf, r), path in zip(items, paths):
            path = path + outer
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            now = sha("".join(map(enc, (*r[:4], lower(r[4]))))) if hit else leaf
            for left, right in path:
                now = sha(left + now + right)
            out.append((r[0], leaf, sub, root, sha("".join(a + b for a, b in path)), now, now == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, hash int, key string, path string"


def audited(spark, rows):
    df = spark.createDataFrame([(*r, 1, "k", "p") for r in rows], SCHEMA).repartition(5)
    return sorted((tuple(r) for r in merkle.audit(df).collect()), key=str)


def test_manifest_of_hard_rows(spark):
    rows = [(i, None if i % 3 else "s", [None, "en", "é", "zz"][i % 4], i or None, t) for i, t in enumerate(TEXTS)]
    rows += [(None, "s", "en", None, "Null Id"), (3, "s", "en", 1, "Same id"), (4, "s", "en", 1, "Twice"), (4, "s", "en", 1, "Twice"),
             (9, "s", "lone", 1, "One ALONE"), (10, "s", "", 1, "empty lang")]
    assert audited(spark, rows) == wanted(rows)
    assert audited(spark, rows[:1]) == wanted(rows[:1])
    assert merkle.audit(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("n", [8, 9, 512, 513, 1100])
def test_manifest_over_blocks(spark, n):
    rows = [(i * 7, "s", "en", i, f"Text {i}") for i in range(n)] + [(i, "s", None, i, f"text {i}") for i in range(3)]
    assert audited(spark, rows) == wanted(rows)


def test_manifest_of_many_groups(spark):
    rows = [(i, "s", f"l{i % 600}", i, f"Text {i}") for i in range(700)]
    assert audited(spark, rows) == wanted(rows)


# --- phrases -------------------------------------------------------------------------------------

def counted(rows, depth):
    found, n = Counter(), Counter()
    for lang, text in rows:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            found.update((lang or "und", tuple(w[i:i + d])) for d in range(1, depth + 1) for i in range(len(w) - d + 1))
    return found, n


def ranked(rows, depth, least, share, k):
    f, n = counted(rows, depth)
    phrases_ = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = []
    for (lang, w), a in phrases_.items():
        if any(x == lang and len(v) > len(w) and 100 * b >= share * a and any(v[i:i + len(w)] == w for i in range(len(v)))
               for (x, v), b in phrases_.items()):
            continue
        score, cut = min((1000000 * a * a // (f[lang, w[:c]] * f[lang, w[c:]]), c) for c in range(1, len(w)))
        out.append((lang, -score, -a, " ".join(w), f[lang, w[:cut]], f[lang, w[cut:]]))
    out.sort(key=lambda r: (*r[:3], r[3].encode()))
    got, rank = [], Counter()
    for lang, score, a, phrase, left, right in out:
        rank[lang] += 1
        if rank[lang] <= k:
            got.append((lang, rank[lang], phrase, -a, left, right, n[lang], -score))
    return sorted(got)


def phrase_rows():
    rng = random.Random(5)
    words = ["a", "b", "c", "The", "the", "of.", "x!", "é", "longerword"]
    return [(lang, t) for lang in ("en", None, "und") for t in TEXTS] + [
        (rng.choice(["en", "fr"]), " ".join(rng.choice(words) for _ in range(rng.choice([3, 40, 400])))) for _ in range(40)]


@pytest.mark.parametrize("shard,part", [(1 << 20, 1 << 20), (37, 25)])
@pytest.mark.parametrize("depth", [2, 3, 4])
def test_collocations(spark, monkeypatch, shard, part, depth):
    rows = phrase_rows()
    monkeypatch.setattr(tally, "range_bits", lambda n, per_range=1000: int(n // per_range).bit_length())
    cut = phrases.shards
    monkeypatch.setattr(phrases, "shards", lambda *a: cut(*a, part_bytes=part))
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "lang string, text string, n int, phrase string").repartition(3)
    got = phrases.collocations(df, depth, 4, 50, 30, shard_words=shard)
    assert sorted(map(tuple, got.collect())) == ranked(rows, depth, 4, 50, 30)
    f, _ = counted(rows, depth)
    grams, _ = phrases.phrase_counts(df, depth, 4, shard_words=shard)
    assert {(r["lang"], tuple(r["phrase"].split(" "))): r["a"] for r in grams.collect()} == {p: a for p, a in f.items() if a >= 4}
    assert phrases.collocations(df.limit(0), depth, 4).count() == 0


def test_intervals_in_both_orders():
    rng = np.random.default_rng(2)
    ids = np.concatenate([[0], rng.integers(0, 5, 400), [0]]).astype(np.int32)
    index = phrases.BiIndex(phrases._transform(ids, 4), phrases._transform(ids[::-1], 4))
    first = lambda seq, i: [*seq[i:i + 4].tolist(), 0, 0, 0][:4]
    for _, (words, counts) in zip(range(4), index.levels(4)):
        for w, c, at in zip(words.tolist(), counts, zip(*index.starts)):
            for seq, pattern, start in ((ids, w, at[0]), (ids[::-1], w[::-1], at[1])):
                hits = [i for i in range(len(seq)) if seq[i:i + len(w)].tolist() == pattern]
                smaller = sum(1 for i in range(len(seq)) if first(seq, i)[:len(w)] < pattern and 0 not in first(seq, i)[:1]) + sum(seq == 0)
                assert len(hits) == c and start == smaller


# --- byte-pair encoding --------------------------------------------------------------------------

def hard_texts():
    rng = random.Random(1)
    letters = ["abcdefgh ijklm", "ABC 0123", "'slmdtrev-", "́̈각아が \u0085\x1c\x00", "éÀßİΣςДж漢", "😀‍ "]
    vocabulary = ["ing", "er", "tion", "the", "str", "enough", "ana", "ous"]
    texts = ["", " ", "É. ÿ! ß? Àé", "a<|endoftext|>b <|startoftext|>", "a" * 3000, "'" * 900 + "s", "x'll" * 400, "--'" * 500, "é" * 2000,
             "ab" * 900 + "'s" + "é" * 900, "́" * 300]
    texts += ["".join(rng.choice(vocabulary) for _ in range(700)) for _ in range(4)]
    for _ in range(200):
        alphabet = "".join(rng.sample(letters, rng.randint(1, 3)))
        texts.append("".join(rng.choice(alphabet) for _ in range(rng.choice([5, 60, 900]))))
    return texts


@pytest.mark.parametrize("block", [50, 4096])
def test_streamed_ids_are_the_tokenizers(block):
    from tokenizers import Tokenizer
    whole, encoder, decoder = Tokenizer.from_file(word_tokenizer()), bpe_stream.Encoder(word_tokenizer(), block), bpe_stream.Decoder(word_tokenizer())
    for text in hard_texts():
        want = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(b"".join(encoder.blocks(text.encode())), "<u4").tolist() == want, text[:60]
        parts = [decoder.push(want[i:i + 3]) for i in range(0, len(want), 3)]
        assert "".join([*parts, decoder.finish()]) == whole.decode(want, skip_special_tokens=False)


def test_lookahead_is_enough_and_memory_is_bounded():
    letters = bpe_stream.byte_alphabet()
    vocab = {c: i for i, c in enumerate(letters)}
    merges = [("a", "b"), ("c", "ab"), ("ab", "c"), ("b", "a"), ("abc", "ba"), ("c", "c"), ("cc", "cc"), ("a", "a")]
    for left, right in merges:
        vocab[left + right] = len(vocab)
    rules = bpe_stream.Merges(vocab, merges)
    rng = random.Random(4)
    for _ in range(3000):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 40))).encode()
        full, stream, out = rules.merge([rules.plain[b] for b in word]), bpe_stream.WordStream(rules, 3), []
        for b in word:
            out += stream.push(bytes([b]))
            assert len(stream.held) <= 4 + rules.lookahead + max(rules.size.values())
        assert out + stream.finish() == full == rules._short([rules.plain[b] for b in word]) == rules._long([rules.plain[b] for b in word])
    with pytest.raises(ValueError):
        bpe_stream.Merges(vocab, [("ab", "c"), ("a", "b")])


def test_encode_decode_tables(spark):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(word_tokenizer())
    rows = [(i, t) for i, t in enumerate(hard_texts()[:40])] + [(None, None), (None, "null id"), (1, "again"), (1, "again")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, ids int, value string").repartition(3)
    want = []
    for i, t in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids
        back = whole.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(back)))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in bpe_stream.digests(df, word_tokenizer()).collect())
    ids = bpe_stream.encode(df, word_tokenizer())
    back = bpe_stream.decode(ids, word_tokenizer()).select("id", F.sha2("text", 256)).collect()
    assert sorted(str((i, d)) for i, _, _, d in want) == sorted(str(tuple(r)) for r in back)
    assert bpe_stream.digests(df.limit(0), word_tokenizer()).count() == 0


def test_byte_level_decoder_keeps_split_characters():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, decoder = Tokenizer.from_file(path), bpe_stream.Decoder(path)
    for text in ["naïve 😀 漢字", "à\x00 b"]:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert "".join([*(decoder.push([i]) for i in ids), decoder.finish()]) == text
        assert "".join([decoder.push(ids[:-1]), decoder.finish()]) == whole.decode(ids[:-1])
