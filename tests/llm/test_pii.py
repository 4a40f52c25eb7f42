"""Base spans against Python's patterns, secrets by context, and terms that disclose."""

import hashlib
import re
from collections import Counter

from sluice.llm import pii
from sluice.llm.common import table

KINDS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": True, "ip": all(int(p) <= 255 for p in value.split(".")) if kind == "ip" else False,
        "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
    }[kind]


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in KINDS.items() for m in p.finditer(text) if valid(k, m[0])]


def test_base_spans_equal_pythons(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    odd = [
        "a.b@c.d.e. x@y x@y.z- 1.2.3.4.5 256.1.1.1 001.02.3.255 4111 1111 1111 1111 4111-1111-1111-1112 +1 (555) 010-9999. +12 3 +1",
        "é@x.y a@b..c a@-.- 4111  1111 1.1.1.1.1.1.1.1 +1--------9 +1.2.3.4.5.6.7.8.9.0 0000000000000 " + "1" * 40,
    ]
    texts = {r.doc_id: r.text or "" for r in docs.collect()} | {10**6 + i: t for i, t in enumerate(odd)}
    got = pii.report(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    for r in got:
        want = base(texts[r.id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[r.id][:200]
        counts = Counter(s.split(":")[0] for s in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in KINDS)
        assert [s for s in r.spans.split(",") if s and s.split(":")[0] in KINDS] == want


SECRETS = [f"{hashlib.sha1(str(i).encode()).hexdigest()}" for i in range(20)]


def letters():
    rows = [(i, f"some words here then api_key: '{SECRETS[i]}' and more number{i}") for i in range(15)]
    rows += [(100 + i, f"the colour = turquoisegreen is fine here item{i}") for i in range(15)]
    rows += [(200 + i, f"version = release2024build77 in document number {i}") for i in range(15)]
    rows += [(300, f"only {SECRETS[3]} alone"), (301, f"only {SECRETS[19]} alone"), (302, "")]
    return rows


def test_secrets_are_values_of_cues_that_say_nothing(spark):
    rows = letters()
    got = {r.id: r for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(15):
        at = rows[i][1].index(SECRETS[i])
        assert f"secret:{at}:{at + 40}" in got[i].spans.split(",")
    # Words, values that are always the same, and values that no cue ever named are none.
    assert [got[i].n_spans for i in (*range(100, 115), *range(200, 215), 301, 302)] == [0] * 32
    # A value named elsewhere is a secret here too.
    assert got[300].spans.startswith("secret:5:45")


def test_a_term_that_discloses_a_kind_is_generalised(spark):
    rows = letters() + [(400 + i, f"some words here and more number then {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r for r in pii.report(df).collect()}
    at = rows[0][1].index("api")
    assert f"term:{at + 4}:{at + 7}" in got[0].spans.split(",")
    assert got[0].n_term == 1 and all(got[i].n_term == 0 for i in range(400, 440))
    clean = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert clean[0] == "some words here then api_[TERM]: '[SECRET]' and more number0"
    assert clean[300] == "only [SECRET] alone" and clean[400] == rows[-40][1]


def test_very_long_lines_and_odd_rows(spark):
    long = "x" * 300_000 + " k = " + "a1" * 50_000 + " " + "1 " * 100_000
    rows = [(1, long), (1, long), (None, "a@b.cd"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS tag", "2 AS start", "3 AS value", "4 AS kind", "5 AS n_spans")
    got = sorted((str(r.id), r.n_email, r.spans) for r in pii.report(df).collect())
    assert len(got) == 5 and ("None", 1, "email:0:6") in got
    assert pii.report(df.limit(0)).collect() == []
