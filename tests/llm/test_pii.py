"""Personal data against Python's patterns, and disclosure against counts."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from tessera.llm import pii as P

SCHEMA = "doc_id long, text string"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    out = []
    for rank, (kind, p) in enumerate(BASE.items()):
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(p, text or "") if valid(kind, m.group())]
    return sorted(out)


def written(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


def random_texts(n):
    rng = random.Random(11)
    parts = ["a@b.c", "x.y@d-e.f.g", "@", ".", "_", "%", "+1", "+12 345", " (555) ", "555-7713", "1.2.3.4", "256", "255", ".", "-", " ",
             "4111 1111 1111 1111", "4111111111111111", "378282246310005", "0", "007", "é", "日本", "😀", "\n", "word", "+", ")", "1.2.3", "5"]
    return ["".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(n)]


def test_base_spans(spark):
    texts = [None, "", "a@b.c.d_e@f.g", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "00000001.2.3.255", "999999999999999999999.1.1.1",
             "4111-1111-1111-1111 4111 1111 1111 1111", "12345678901234567890", "+1 (017) 555-7713.", "x" * 3000 + "@" + "a." * 3000 + "b",
             "7" * 50_000, " ".join(f"u{i}@h.org" for i in range(700)), *random_texts(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    for r in P.pii_report(df).collect():
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(written(want).encode()).hexdigest(), (texts[r.doc_id], r)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[3] == k for x in want) for k in BASE]
        got = [tuple(x.split(":")) for x in r.spans.split(",") if x]
        assert set(written(want).split(",")) - {""} <= {":".join(x) for x in got}


def corpus():
    """``zebra`` stands only beside one address; ``often`` everywhere;
    ``rare`` beside it in too few texts."""
    rows = [f"note {i} often zebra Bob@Site.org end{'abcdefgh'[i]}" for i in range(6)]
    rows += ["often zebra bob@site.org rare", "often zebra bob@site.org rare"]
    rows += [f"often plain text number {i} and more" for i in range(60)] + ["zebra alone often"]
    rows += [f"once{chr(97 + i)} user{i}@other.net often" for i in range(6)]
    return rows


def terms_of(text):
    return {w for w in re.findall(r"[^\W\d_]+", text.lower()) if len(w) >= P.TERM_LETTERS}


def entities_of(text):
    out = set()
    for s, _, e, kind in brute(text):
        m = text[s:e].lower()
        digits = re.sub("[^0-9]", "", m)
        out.add(f"{kind}:{digits if kind in ('card', 'phone') else m}")
        if kind == "email":
            domain = m.split("@")[-1]
            out |= {f"domain:{domain}", "domain:" + ".".join(domain.split(".")[-2:])}
        elif kind == "ip":
            out |= {"network:" + ".".join(m.split(".")[:n]) for n in (2, 3)}
        elif kind == "card":
            out.add(f"issuer:{digits[:6]}")
        else:
            out |= {f"prefix:{digits[:n]}" for n in (4, 7)}
    return out


def brute_terms(rows, alpha=0.8):
    """All pairs of entities and terms by counting texts."""
    n, out = len(rows), {}
    held = [(entities_of(t or ""), terms_of(re.sub(BASE["email"], " ", t or "")), t or "") for t in rows]
    with_term = Counter(w for t in rows for w in terms_of(t or ""))
    held = [h for h in held if h[0]]
    for value in set().union(*(h[0] for h in held)):
        mine = [(w, t) for v, w, t in held if value in v]
        value_texts = len({t for _, t in mine})
        for term in set().union(*(w for w, _ in mine)):
            n_pair, texts = sum(term in w for w, _ in mine), len({t for w, t in mine if term in w})
            n_term = with_term[term]
            ic = math.log2(n / len(mine))
            few = min(n_term, max(value_texts, texts))
            pmi = math.log2(n * n_pair / (n_term * len(mine))) * texts / (texts + 0.25) * few / (few + 0.25)
            if ic > 0 and pmi >= alpha * ic:
                out[value, term] = (pmi, ic)
    return out


def test_disclosing_terms(spark):
    rows = corpus()
    df = spark.createDataFrame(list(enumerate(rows)), SCHEMA)
    got = {(r.value, r.term): (r.pmi, r.ic) for r in P.disclosing_terms(df).collect()}
    want = brute_terms(rows)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)
    assert {k for k in got if k[0].startswith("email")} == {("email:bob@site.org", "zebra"), ("email:bob@site.org", "note")}
    report = {r.doc_id: r.spans for r in P.pii_report(df).collect()}
    assert report[0] == "term:0:4,term:13:18,email:19:31"
    assert report[6] == "term:6:11,email:12:24"
    assert report[10] == "" and "term" not in report[len(rows) - 1]
    assert report[68] == ""  # the term without the value


def test_rare_values_are_judged_by_their_units(spark):
    """No address, number or card stands twice, but their domains, networks,
    prefixes and issuers do; a short name beside them gives them away."""
    rng = random.Random(7)
    fill = ["plain", "text", "goes", "on", "here", "and", "there"]
    rows = [f"{' '.join(rng.sample(fill, 4))} kim u{i}@corp.example.org {i % 3}" for i in range(12)]
    rows += [f"ann{'' if i % 4 else ' ' + rng.choice(fill)} 10.20.30.{i} {rng.choice(fill)}" for i in range(9)]
    rows += [f"{rng.choice(fill)} ed +1 (555) 123-{1000 + i} x" for i in range(6)]
    rows += [" ".join(rng.choices(fill, k=8)) for _ in range(300)] + ["kim alone", None, ""]
    rows += rows[:3]
    df = spark.createDataFrame([(i, t, "k", "v") for i, t in enumerate(rows)], SCHEMA + ", key string, value string")
    got = {(r.value, r.term): (r.pmi, r.ic) for r in P.disclosing_terms(df).collect()}
    want = brute_terms(rows)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)
    assert {("domain:corp.example.org", "kim"), ("network:10.20.30", "ann"), ("prefix:1555123", "ed")} <= got.keys()
    assert not any(t in fill for _, t in got)
    spans = {r.doc_id: r.spans for r in P.pii_report(df).collect()}
    assert all("term" in spans[i] for i in range(27)) and not any("term" in spans[i] for i in range(27, 330))


def test_sanitised(spark):
    rows = [*corpus(), None, "call +1 (017) 555-7713 or é 1.2.3.4!", "clean text"]
    df = spark.createDataFrame([(i, t, 5, "own") for i, t in enumerate(rows)], SCHEMA + ", n_chars long, base string")
    out = P.sanitised(df)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[6].text == "often  <EMAIL> rare" and got[6].n_chars == 19 and got[6].base == "own"
    assert [got[len(rows) - k].text for k in (3, 2, 1)] == [None, "call <PHONE> or é <IP>!", "clean text"]
    assert got[len(rows) - 1].n_chars == 5


def test_table_cases(spark):
    df = spark.createDataFrame([(None, "a@b.cd"), (1, None), (1, "a@b.cd"), (1, "a@b.cd")], SCHEMA)
    assert sorted(r.spans for r in P.pii_report(df).collect()) == ["", "email:0:6", "email:0:6", "email:0:6"]
    assert P.pii_report(df.limit(0)).count() == 0 and P.sanitised(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1000])
def test_running_sums(spark, n):
    from pyspark.sql import functions as F

    x = [(7 * i) % 13 for i in range(n)]
    df = spark.createDataFrame([(x,)], "x array<int>")
    got = df.select(F.when(F.size("x") > 0, P._running(F.col("x"))).otherwise(F.array().cast("array<int>")).alias("s")).first().s
    assert got == [sum(x[:i]) for i in range(n)]


def test_terms_are_counted_before_they_are_joined(spark):
    """No join reads the terms of every document: below it they are counted."""
    rows = P.spanned(spark.createDataFrame([("Zora a@b.c",), ("Zora",)], "text string"), "text", "key", "spans")
    found = P._disclosing(rows, P._beside(rows, "text", "key", "spans", 1), "text", P.ALPHA, 1)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    (at,) = [i for i, line in enumerate(plan) if "n_term" in line and "Aggregate" in line]
    assert not any("Join" in line and depth(line) > depth(plan[at]) for line in plan[at:])
