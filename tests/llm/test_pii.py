"""Personal data against the contract's patterns, tried naively, and hand cases of the checksums and context words."""

import hashlib
import random
import re
import time

import pytest

from carepulse.llm import pii
from carepulse.llm.queries import op11_pii

NAIVE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def naive_luhn(digits):
    total = 0
    for i, d in enumerate(int(c) for c in reversed(digits)):
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def naive(text):
    out = []
    for k, (kind, pattern) in enumerate(NAIVE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 12 <= len(digits) <= 19 and naive_luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, kind, m.end()))
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


def random_text(rnd):
    pieces = ["a.b@c.de", "@", "x@y", "@.", ".", "1.2.3.4", "256.1.1.1", "0001.2.3.255", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004", " ", "-", "+", "+1 (509) 555-6973",
              "+44", "(", ")", "é", "中", "😀", "\n", "12", "7", "word", "%", "_", "+1 2", "+123456789", "..", "--", "a@b.c.d@e.f", "1234567890123456789012"]
    return "".join(rnd.choice(pieces) + rnd.choice(["", " ", ""]) for _ in range(rnd.randint(0, 40)))


@pytest.mark.parametrize("seed", range(8))
def test_base_spans_equal_the_patterns(seed):
    rnd = random.Random(seed)
    for _ in range(1500):
        text = random_text(rnd)
        got = [(k, s, e) for k, s, e, _, base in pii.find_spans(text) if base]
        assert got == naive(text), text


def test_spans_of_messy_rows(spark, docs, messy):
    rows = pii.digests(pii.personal_data(docs, ["doc_id", "kept"])).collect()
    assert len(rows) == len(messy)
    want = sorted((str(r[0]), hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in naive(r[1])).encode()).hexdigest()) for r in messy)
    assert sorted((str(r.doc_id), r.base_sha256) for r in rows) == want


def test_empty_table(spark, none):
    out = pii.digests(pii.personal_data(none, text=False))
    assert out.count() == 0 and out.columns[:6] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]


def test_query_on_whole_table(spark, small_sf):
    got = {r.doc_id: r for r in op11_pii(spark, small_sf).collect()}
    docs = spark.read.parquet(f"{small_sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want = naive(d.text)
        r = got[d.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in want) for kind in NAIVE]
        assert {f"{k}:{s}:{e}" for k, s, e in want} <= set(r.spans.split(","))


def kinds(text):
    return [(k, text[s:e]) for k, s, e, _, base in pii.find_spans(text) if not base]


def test_checksums_confirm():
    assert kinds("to DE89 3704 0044 0532 0130 00 by Monday") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("to DE89 3704 0044 0532 0130 01 by Monday") == []
    assert kinds("GB82WEST12345698765432") == [("iban", "GB82WEST12345698765432")]
    assert kinds("XGB82WEST12345698765432") == [] and kinds("GB82WEST123456987654321") == []
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_swallowed_numbers_come_back():
    text = "Des +1 (826) 555-4081 190.137.223.204 du"
    assert [(k, text[s:e], b) for k, s, e, _, b in pii.find_spans(text)] == [("phone", "+1 (826) 555-4081", False), ("ip", "190.137.223.204", True)]
    text = "the 4111111111111111 19 of"
    assert naive(text) == [] and kinds(text) == [("card", "4111111111111111")]
    assert kinds("the 4111111111111112 19 of") == []


def test_context_words_decide():
    assert kinds("social security 536-22-8726") == [("ssn", "536-22-8726")]
    assert kinds("the part 536-22-8726") == [] and kinds("social security 000-22-8726") == []
    assert kinds("call 509 555 6973 now") == [("phone", "509 555 6973")]
    assert kinds("about 509 555 6973 now") == [] and kinds("invoice, phone: 509 555 6973") == []
    assert kinds("call" + " x" * 60 + " 509 555 6973") == []


def test_scores_and_redaction(spark):
    docs = spark.createDataFrame([(1, "card 4111111111111111, mail a@b.cd"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.personal_data(docs, text=True).collect()}
    assert rows[1].redacted == "card [card], mail [email]" and rows[2].redacted == ""
    assert [(s.kind, s.score, s.base) for s in rows[1].spans] == [("card", 0.9, True), ("email", 1.0, True)]


def test_long_runs_take_linear_time():
    n = 300_000
    for text in ("a" * n, "1" * n, "1." * (n // 2), "1 " * (n // 2), "a.b" * (n // 3) + "@", "@" * n, "a@b." * (n // 4), "+1" * (n // 2), "+1" + "(" * n, "AA11" * (n // 4), "1.2." + "3" * n, "(12" * (n // 3), "+" + "1 " * (n // 2)):
        began = time.process_time()
        pii.find_spans(text)
        assert time.process_time() - began < 5, text[:20]
