import hashlib
import re

import pytest

from conftest import SMALL
from tidemark.llm import pii
from tidemark.llm.queries import QUERIES

PATTERN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def valid(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERN.items()
            for m in re.finditer(p, text or "") if valid(k, m.group())]


TEXTS = [
    None, "", "plain", "a@b", "x a@b.c, a@b.c@d.e x a@b.cx_y@d.e", "é12@x.yz 😀 me@ab.cd. ..@a.b",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.0255 0000000000001.1.1.1 999999999999.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 42-42-42-42-42-42-42 4242424242424242424242",
    "+1 (487) 555-7209 +1-2 +12345678 +123456789 ++1 (2)3.4-5 67890( +1234567890123456",
    "1" * 30000, "a" * 30000 + "@b.cd", "a.b@c.d " * 3000, "12 " * 20000, "+1" * 5000, "1.1.1.1" * 2000,
]


def test_base_spans_match_plain_expressions(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.digest_columns(pii.find(df)).collect()}
    for i, t in enumerate(TEXTS):
        want = brute(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (i, want[:5], got[i].spans[:200])
        for k in PATTERN:
            assert got[i][f"n_{k}"] == sum(w.startswith(k + ":") for w in want)


def test_query_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op1_pii"](spark, SMALL).collect()}
    assert len(got) == len(docs)
    for d in docs:
        want = brute(d.text)
        assert got[d.doc_id].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(got[d.doc_id].spans.split(",")) | {""}


def test_patterns_find_unseen_identifiers(spark):
    rows = [(i, f"reach support mail user{i}@site.org now") for i in range(12)]
    rows += [(100, "reach support mail sam99(at)site now"), (101, "nothing else 77x here"),
             (102, "reach support mail sam99(at)site now")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.digest_columns(pii.find(df)).collect()}
    assert got[100].spans == "email:19:32" and got[100].n_email == 0 and got[100].n_found == 1
    assert got[102].spans == "email:19:32"
    assert got[101].spans == ""
    assert got[3].spans == "email:19:33"


@pytest.mark.parametrize("rows", [[], [(None, None), (1, ""), (1, ""), (None, "x 1.2.3.4")]])
def test_empty_and_null(spark, rows):
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, value string")
    got = pii.digest_columns(pii.find(df)).collect()
    assert len(got) == len(rows)
    assert sum(r.n_ip for r in got) == sum(1 for r in rows if r[1] and "1.2.3.4" in r[1])


def seeded(extra):
    rows = [(i, f"reach support mail user{i}@site.org now") for i in range(12)] + extra
    return rows, "doc_id long, text string"


def test_unseen_identifiers_without_digits(spark):
    df = spark.createDataFrame(*seeded([(100, "reach support mail sam(at)site now"), (101, "reach support mail alice[at]site.org, now")]))
    got = {r.doc_id: r for r in pii.digest_columns(pii.find(df)).collect()}
    assert got[100].spans == "email:19:30" and got[101].spans == "email:19:36"


def test_unseen_identifier_beside_a_base_span_or_a_date(spark):
    df = spark.createDataFrame(*seeded([(100, "reach support mail sam99(at)site 10.0.0.1 ok"), (101, "reach support mail sam99(at)site 2024-01-02 ok"),
                                        (102, "reach support mail sam99(at)site/10.0.0.1 ok")]))
    got = {r.doc_id: r for r in pii.digest_columns(pii.find(df)).collect()}
    assert got[100].spans == "email:19:32,ip:33:41"
    assert got[101].spans == "email:19:32" and got[102].spans == "email:19:32,ip:33:41"


def test_unseen_identifiers_are_no_evidence_against_a_pattern(spark):
    df = spark.createDataFrame(*seeded([(100, "reach support mail sam99(at)site now"), (101, "reach support mail kim7(at)site now")]))
    got = {r.doc_id: r for r in pii.digest_columns(pii.find(df)).collect()}
    assert got[100].spans == "email:19:32" and got[101].spans == "email:19:31"


def test_plain_words_and_other_kinds_are_evidence_against_a_pattern(spark):
    words = [(200 + i, f"reach support mail {w} now") for i, w in enumerate(["today", "later", "office"])]
    other = [(200 + i, f"reach support mail 10.0.0.{i} now") for i in range(4)]
    for extra in (words, other):
        df = spark.createDataFrame(*seeded([(100, "reach support mail sam99(at)site now")] + extra))
        got = {r.doc_id: r for r in pii.digest_columns(pii.find(df)).collect()}
        assert got[100].spans == "" and sum(r.n_found for r in got.values()) == 0


def test_hopeless_patterns_are_not_counted_in_all_texts(spark, monkeypatch):
    """Words are counted in one pass over all texts for patterns that may yet
    count; the words of some texts rule out the others."""
    rows, schema = seeded([(100, "reach support mail sam99(at)site now")])
    rows += [(1000 + 400 * j + i, f"just the mail {f'p{i}@site.org' if j else chr(97 + i // 26) + chr(97 + i % 26)} of") for j in (0, 1) for i in range((200, 4)[j])]
    asked, count = [], pii.plain_words

    def counted(docs, patterns, *a):
        asked.append({r.pattern for r in patterns.collect()})
        out = count(docs, patterns, *a)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all") <= 2, plan          # the tokens of a text are found once
        return out

    monkeypatch.setattr(pii, "plain_words", counted)
    got = {r.doc_id: r for r in pii.digest_columns(pii.find(spark.createDataFrame(rows, schema))).collect()}
    assert got[100].spans == "email:19:32" and sum(r.n_found for r in got.values()) == 1
    assert "l2 the mail" not in asked[-1] and "l2 support mail" in asked[-1]
