"""Spans of secrets and personal data with their offsets against plain Python, and texts with very many spans."""

import hashlib
import math
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from quire.llm import pii, secret_scan, spans

SECRET = {"assign": re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
          "access": re.compile(r"AKIA[A-Z0-9]+"), "hex": re.compile(r"[0-9a-f]+")}


def secret_base(text):
    out = []
    for rank, (kind, pattern) in enumerate(SECRET.items()):
        for m in pattern.finditer(text):
            if {"assign": lambda: len(m[2]) >= 12, "access": lambda: len(m[0]) >= 18, "hex": lambda: len(m[0]) >= 16}[kind]():
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def entropy_runs(text):
    """Windows of 20 characters with enough entropy, the counts of each recounted; overlapping or touching ones made one."""
    out, n = [], 20
    deny = [re.compile(p) for p in secret_scan.ALLOW]
    for cand in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        run = None
        for a in range(len(cand[0]) - n + 1):
            w = cand[0][a:a + n]
            total = sum(round(c * math.log2(c) * secret_scan.UNIT) for c in Counter(w).values())
            hexed = re.fullmatch("[0-9A-Fa-f]+", w) is not None
            if total <= secret_scan.unit_limit(3.0 if hexed else 4.0) and not any(p.search(w) for p in deny):
                a += cand.start()
                if run and run[0] == hexed and a <= run[2]:
                    run[2] = a + n
                else:
                    run = [hexed, a, a + n]
                    out.append(run)
    return sorted((a, 3 if h else 4, e, "entropy_hex" if h else "entropy_base64") for h, a, e in out)


def shown(found):
    return ",".join(f"{k}:{a}:{e}" for a, _, e, k in found)


def secret_texts():
    rnd = random.Random(2)
    parts = ["password=", "api_key: '", "Token =\"", "AKIA", " ", "\n", "é😀", "SESSION_ID=9F86D081884C7D659A2FEAA0C55AD015", "samples/wJalrXUtnFEMI7MDENGbPxRfiCYzz9Q",
             "123e4567-e89b-12d3-a456-426614174000", "internationalisations-of-words", "0123456789abcdef0123", "deadbeef" * 3]
    sets = ["abcdef0123456789", "ABCDEF0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "ab", "0123456789-"]
    texts = ["", "SESSION_ID=9F86D081884C7D659A2FEAA0C55AD015", "".join(rnd.choice(sets[2]) for _ in range(5000)),
             "".join(rnd.choice(sets[0] + sets[1]) for _ in range(2500)) + "-" + "".join(rnd.choice(sets[2]) for _ in range(2200))]
    for _ in range(150):
        texts.append("".join(rnd.choice(parts) if rnd.random() < 0.5 else "".join(rnd.choice(s) for _ in range(rnd.randint(1, 40)))
                             for s in rnd.choices(sets, k=rnd.randint(1, 8))))
    return texts


def test_secret_spans_are_those_of_plain_python(spark):
    texts = secret_texts()
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = secret_scan.scan(rows).select("id", spans.joined(F.col("base")).alias("b"), spans.joined(F.col("spans")).alias("s"),
                                        secret_scan.masked(F.col("text"), F.col("spans")).alias("m")).collect()
    seen = set()
    for r in got:
        text, base = texts[r["id"]], secret_base(texts[r["id"]])
        every = sorted(base + [x for x in entropy_runs(text) if not any(b[0] <= x[0] and b[2] >= x[2] for b in base)])
        assert (r["b"], r["s"]) == (shown(base), shown(every)), text[:80]
        clean, at = "", 0
        for a, _, e, _ in every:
            if a >= at:
                clean += text[at:a] + "[SECRET]"
            at = max(at, e)
        assert r["m"] == clean + text[at:]
        seen |= {k for *_, k in every}
    assert seen == {"assign", "access", "hex", "entropy_hex", "entropy_base64"}
    assert [r["s"] for r in got if r["id"] == 1] == ["entropy_hex:11:43"]


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def personal_base(text):
    def luhn(digits):
        return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0

    rules = [("email", EMAIL, lambda m: True), ("ip", re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"), lambda m: all(int(p) <= 255 for p in m.split("."))),
             ("card", re.compile(r"[0-9](?:[\x20-]?[0-9])+"), lambda m: 14 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
             ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15)]
    return sorted((m.start(), rank, m.end(), kind) for rank, (kind, p, keep) in enumerate(rules) for m in p.finditer(text) if keep(m[0]))


def test_personal_spans_are_those_of_plain_python(spark):
    rnd = random.Random(3)
    parts = ["a.b@c.de", "@", "x_y%z@q-w.co.uk", "10.0.0.255", "999.1.2.3", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "5500005555555559",
             "+1 (988) 555-2485", "+49 30 1234", "+", "-", " ", ".", "\n", "é😀", "word", "7", "0042"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = pii.scan(rows).select("id", spans.joined(F.col("base")).alias("b"), "base", "spans").collect()
    assert len(got) == len(texts)
    kinds = set()
    for r in got:
        want = personal_base(texts[r["id"]])
        assert r["b"] == shown(want), texts[r["id"]]
        assert hashlib.sha256(r["b"].encode()).hexdigest() == hashlib.sha256(shown(want).encode()).hexdigest()
        kinds |= {k for *_, k in want}
        held = [(s["start"], s["end"]) for s in r["base"]]
        assert all(s["kind"] != "term" or all(s["end"] <= a or s["start"] >= e for a, e in held) for s in r["spans"])
    assert kinds == {"email", "ip", "card", "phone"}


def test_terms_follow_from_the_counts(spark):
    """Every disclosing term, recomputed from document sets."""
    rnd = random.Random(6)
    names, words = [f"p{i}@x.org" for i in range(6)], [f"{c}word" for c in "abcdefghij"]
    texts = []
    for i in range(300):
        own = rnd.sample(words, rnd.randint(1, 3))
        if i % 3 == 0:
            k = rnd.randrange(6)
            own += [names[k]] + ([f"secret{'abcdef'[k]}"] if rnd.random() < 0.9 else [])
        texts.append(" ".join(rnd.sample(own, len(own))) + f" {i}")
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hits = spans.find(rows.select("doc_id", "text", F.xxhash64("text").alias("version")), pii.BASE, "text", "base").where(F.size("base") > 0)
    got = {(r["entity"], r["term"]) for r in pii.disclosing_terms(hits, rows.select("text")).collect()}
    terms = [set(re.findall(r"[a-z]{3,}", EMAIL.sub(" ", t))) for t in texts]
    holds = [set(EMAIL.findall(t)) for t in texts]
    n, want = len(texts), set()
    for e in names:
        of = [i for i in range(n) if e in holds[i]]
        for t in {t for i in of for t in terms[i]}:
            with_t = sum(t in x for x in terms)
            both = sum(t in terms[i] for i in of)
            if len(of) >= 3 and both >= 3 and math.log(both * n / (len(of) * with_t)) >= 0.9 * math.log(n / len(of)):
                want.add((f"email:{e}", t))
    assert got == want and want


def test_very_many_spans_in_one_text(spark):
    words = [hashlib.sha256(str(i).encode()).hexdigest()[:24 + i % 9] for i in range(20_000)]
    text = " ".join(words)
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    begin = time.time()
    one = secret_scan.scan(rows).select(F.size("spans").alias("n"), spans.count(F.col("base"), "hex").alias("hex"),
                                        F.sha2(spans.joined(F.col("base")), 256).alias("d"),
                                        secret_scan.masked(F.col("text"), F.col("spans")).alias("m")).first()
    assert time.time() - begin < 60
    at, want = 0, []
    for w in words:
        want.append(f"hex:{at}:{at + len(w)}")
        at += len(w) + 1
    assert one["hex"] == 20_000 and one["d"] == hashlib.sha256(",".join(want).encode()).hexdigest()
    assert one["m"] == " ".join(["[SECRET]"] * 20_000)


def test_located_spans_of_100000_matches(spark):
    text = "1, " * 100_000
    one = spans.find(spark.createDataFrame([(text,)], "t string"), [spans.Kind("n", "[0-9]")], "t", "s")
    begin = time.time()
    got = one.select(F.size("s"), F.element_at("s", -1)["start"], F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x["start"])).first()
    assert tuple(got) == (100_000, 299_997, 3 * sum(range(100_000))) and time.time() - begin < 30


def test_sieves_and_running_values(spark):
    rnd = random.Random(7)

    def some(n, length):
        return sorted((a, 0, a + rnd.randint(1, length), "k", "") for a in (rnd.randint(0, 300) for _ in range(n)))

    cases = [(some(rnd.randint(0, 30), 20), some(rnd.randint(0, 10), 60)) for _ in range(60)] + [(some(700, 9), some(600, 5))]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(cases)], f"i int, a array<{spans.SPAN}>, b array<{spans.SPAN}>")
    got = rows.select("i", spans.uncovered(F.col("a"), F.col("b")).alias("u"), spans.untouched(F.col("a"), F.col("b")).alias("t"),
                      spans.running_max(F.transform("a", lambda s: s["end"])).alias("m")).collect()
    for r in got:
        a, b = cases[r["i"]]
        assert [tuple(s) for s in r["u"]] == [s for s in a if not any(h[0] <= s[0] and h[2] >= s[2] for h in b)]
        assert [tuple(s) for s in r["t"]] == [s for s in a if not any(h[0] < s[2] and h[2] > s[0] for h in b)]
        assert r["m"] == [max([-1, *(s[2] for s in a[:k])]) for k in range(len(a))]
