import hashlib
import random
import re

from tablepulse.llm import pii
from tablepulse.llm.queries import QUERIES

from .common import prose

SF = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for at, digit in enumerate(map(int, digits[::-1])):
        total += digit if at % 2 == 0 else (2 * digit - 9 if digit > 4 else 2 * digit)
    return total % 10 == 0


def good(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(part) <= 255 for part in match.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def by_patterns(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if good(kind, m.group())
    ]


def base(text):
    return [span for span in pii.find_spans(text) if span[0] in pii.BASE]


def test_base_spans_equal_the_patterns_on_the_table(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op8_pii"](spark, SF).collect()
    assert len(got) == len(docs)
    found = 0
    for row in got:
        spans = by_patterns(docs[row["doc_id"]])
        found += len(spans)
        written = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert row["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        for kind in pii.BASE:
            assert row[f"n_{kind}"] == sum(span[0] == kind for span in spans)
        assert row["spans"].startswith(written)
    assert found > 50


def test_base_spans_equal_the_patterns_on_random_text():
    rng = random.Random(1)
    parts = ["a", "b@", "@", ".", "..", "1", "12", "255", "256", "007", "+", "+1", " ", "-", "(", ")",
             "x.y", "a@b.c", "4785380592391140", "1.2.3.4", "é", "😀", "\n", ",", "_", "%", "0",
             "://", "token = ", "4012 8888 8888 1881", "+1 (743) 555-3824"]
    for _ in range(20000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert base(text) == by_patterns(text), text


def test_added_spans_and_redaction():
    text = 'see ftp://bob:pw1@h.org and token = "ab12cd34ef" or bob@h.org, IBAN DE89370400440532013000'
    kinds = [text[s:e] for k, s, e in pii.find_spans(text) if k not in pii.BASE]
    assert kinds == ["bob:pw1", "ab12cd34ef", "DE89370400440532013000"]
    out = pii.redact(text, pii.find_spans(text))
    assert "ab12cd34ef" not in out and "bob@h.org" not in out and "[EMAIL]" in out
    assert pii.redact("plain", []) == "plain" and pii.redact(None, []) is None


def test_identifiers_behind_cues():
    def accounts(text):
        return [text[s:e] for kind, s, e in pii.find_spans(text) if kind == "account"]

    assert accounts("Account number: 12345678") == ["12345678"]
    assert accounts("password account 99887766") == ["99887766"]
    assert accounts("account 12345678, iban no. is DE8937040044") == ["12345678", "DE8937040044"]
    assert accounts("Passport no 123456789 and token id: ab12cd34") == ["123456789", "ab12cd34"]
    assert accounts("account numbering 123456 password nothing") == []
    assert accounts("token token token " * 3 + "abc12345") == ["abc12345"]


def test_edges(documents):
    table = [(1, None), (2, ""), (3, "a@b.co"), (3, "a@b.co"), (None, "+1 222 333 4444")]
    table += [(5, prose(1, 200000) + " x@y.org"), (6, "1" * 100000), (7, "a@" * 50000)]
    frame = documents([(*row, "en", "s", 1)[:2] + ("en", "s", 1) for row in table], ", spans long")
    got = pii.find_pii(frame).collect()
    none = hashlib.sha256(b"").hexdigest()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(table)
    assert by[1]["base_sha256"] == by[2]["base_sha256"] == by[6]["base_sha256"] == none
    assert by[3]["spans"] == "email:0:6" and by[5]["n_email"] == 1 and by[None]["n_phone"] == 1
    clean = pii.redact_documents(frame)
    assert clean.columns == frame.columns
    assert {r["text"] for r in clean.collect() if r["doc_id"] == 3} == {"[EMAIL]"}
    assert pii.find_pii(frame.limit(0)).count() == 0
