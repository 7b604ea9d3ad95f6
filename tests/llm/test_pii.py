"""PII spans against an independent reading of the contract with Python's re."""

import hashlib
import re

from pyspark.sql import functions as F

from ledgerlake.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for order, (kind, pat) in enumerate(BASE.items()):
        for m in re.finditer(pat, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                  "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


PLANTED = [
    "a@b.c_d@e.f a..b@c-d.e..f g@h.i@j.k", "x@y.z" * 20, "a@b", "é😀me@x.org 1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "41111111111111111", "4111  1111 1111 1111",
    "+1 (651) 555-8500 +12 +123456789012345 +1234567890123456 + 1 555", "+4111111111111111",
    "GB82 WEST 1234 5698 7654 32, GB82WEST12345698765433 xGB82WEST12345698765432", "ssn 078-05-1120", "078-05-1120",
    'token = "44a0f5b6efd1d1e39ce8544a0f5b6efd"', "44a0f5b6efd1d1e39ce8544a0f5b6efd", "me@x.io " * 700,
]


def result(df):
    return {r.doc_id: r for r in pii.pii_digest(df).collect()}


def check(df):
    texts = {r.doc_id: r.text for r in df.collect()}
    got = result(df)
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        want = brute(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (i, (t or "")[:80])
        assert [s for s in got[i].spans.split(",") if s.split(":")[0] in BASE] == want
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(s.startswith(k) for s in want) for k in BASE]
    return got


def test_tables(documents):
    check(documents)


def test_edges_and_planted(make_docs, edge_texts):
    check(make_docs(PLANTED + edge_texts))


def test_long_runs(make_docs):
    check(make_docs(["a" * 3_000, "1" * 3_000, "1." * 2_000, "a.b@" * 1_000, "+1" + "2" * 3_000]))


def test_long_runs_are_read_once(make_docs):
    # Far beyond what plain backtracking from every start would manage.
    got = result(make_docs(["a" * 1_000_000, "1" * 1_000_000, "1.1.1.1 " * 5_000, "a" * 300_000 + "@b.c"]))
    assert [(r.n_email, r.n_ip, r.n_card) for _, r in sorted(got.items())] == [(0, 0, 0), (0, 0, 0), (0, 5_000, 0), (1, 0, 0)]


def test_method_kinds(make_docs):
    got = result(make_docs(PLANTED))
    assert [got[9].n_iban, got[10].n_ssn, got[11].n_ssn, got[12].n_secret, got[13].n_secret] == [1, 1, 0, 1, 0]


def test_redaction_merges_overlaps(make_docs):
    df = pii.find_pii(make_docs(["mail me@x.org now", "+4111111111111111!", None, "clean"]))
    got = [r.t for r in df.orderBy("doc_id").select(pii.redact(F.col("text"), F.col("pii")).alias("t")).collect()]
    assert got == ["mail [EMAIL] now", "+[CARD]!", None, "clean"]


def test_empty_and_clashing(spark, make_docs):
    df = make_docs(["a@b.cd"])
    assert pii.pii_digest(df.limit(0)).count() == 0
    both = pii.find_pii(df.withColumn("pii", F.lit(1)).union(df.withColumn("pii", F.lit(1))))
    assert [len(r.pii) for r in both.collect()] == [1, 1]


def test_ibans_among_capitals_and_digits(make_docs):
    gb, de, no = "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "NO93 8601 1117 947"
    texts = [f"IBAN {gb} BIC WESTGB2L", f"IBAN {de} EUR 500", f"{de} {gb}", f"{gb} {de} {no} X", f"AB12 CODE {de} A", f"{de}5", f"{de}x {no}, A",
             f"é😀 {no}\n12", f"DE00 3704 0044 0532 0130 00 {no} {no}", f"A{de} B", f"{gb} ref", " ".join([de] * 300), "AB12 " * 2_000]
    want = [[gb], [de], [de, gb], [gb, de, no], [de], [], [no], [no], [no, no], [], [gb], [de] * 300, []]
    df = make_docs(texts)
    got = result(df)
    for i, (t, w) in enumerate(zip(texts, want)):
        spans = [s.split(":") for s in got[i].spans.split(",") if s.startswith("iban")]
        assert [t[int(a):int(b)] for _, a, b in spans] == w and got[i].n_iban == len(w), i
    clean = pii.find_pii(df.filter("doc_id < 2")).orderBy("doc_id").select(pii.redact(F.col("text"), F.col("pii")).alias("t"))
    assert [r.t for r in clean.collect()] == ["IBAN [IBAN] BIC WESTGB2L", "IBAN [IBAN] EUR 500"]
