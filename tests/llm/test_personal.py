import hashlib
import random
import re
import time

import pytest

from helpers import documents, prose
from postlake.llm import personal, queries

SF = "/root/testdata/sf0.01"


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute(text):
    """The base spans as the contract states them, by Python's regular expressions over the whole text."""
    text, found = text or "", []
    for kind, pattern, good in (
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15)):
        found += [(m.start(), personal.ORDER[kind], m.end()) for m in re.finditer(pattern, text) if good(m[0])]
    return sorted(found)


def base(text):
    return [s for s in personal.personal_spans(text) if s[1] < len(personal.KINDS)]


def added(text):
    names = (*personal.KINDS, *personal.ADDED)
    return [(names[k], text[a:z]) for a, k, z in personal.personal_spans(text) if k >= len(personal.KINDS)]


CASES = ["", "a@b.c", "a@b", "a@b.c@d.e", "@b.c", "x.y@a-b.c.d.", "a@b..c a@.b", "1.2.3.4", "1.2.3.4.5.6.7.8.9", "256.1.1.1.1.1.1.1", "1.2.3", "0001.02.255.0000",
         "4111 1111 1111 1111", "4111-1111-1111-1111 x", "41111111111111112", "4111  1111 1111 1111", "+1 (201) 555-0123", "+1 2", "+12", "+1 201 555 0123 4567 8901", "++1--2345678-",
         "+1(2)3456789 +44 20 7946 0958", "ü4111111111111111ß", "é.34@mail7.example.com", "1-2 3-4 5-6 7-8 9-0 1-2 3-4", "+1.2.3.4.5.6.7.8.9.0"]


@pytest.mark.parametrize("text", CASES)
def test_base_spans(text):
    assert base(text) == brute(text)


@pytest.mark.parametrize("chars", ["0123456789 -", "01.", "ab@.-", "+12 ().-", "a1@.+- (é", "0123456789.+- @a\n"])
def test_base_spans_of_random_texts(chars):
    rng = random.Random(chars)
    for _ in range(1500):
        text = "".join(rng.choice(chars) for _ in range(rng.randint(0, 70)))
        assert base(text) == brute(text), text


def test_added_spans():
    assert added("write to jürgen@exämple.de or <j@example.com>") == [("mailbox", "jürgen@exämple.de")]
    assert added('"john doe"@example.com') == [("mailbox", '"john doe"@example.com')]
    assert added("see ftp://bob:pw@files.example.org/x and http://example.org/@bob") == [("address", "ftp://bob:pw@files.example.org")]
    assert added("http://[2001:db8::1]:80/ http://[::zz]/") == [("address", "http://[2001:db8::1]")]
    assert added("tel:030-1234567, tel:12") == [("address", "030-1234567")]
    assert added("IBAN: DE89 3704 0044 0532 0130 00 BIC") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert added("iban DE88 3704 0044 0532 0130 00") == []
    assert added("SSN 078-05-1120; ssn 000-05-1120; account no. 12345678, Passport number: C01234567; account of 1999") == [
        ("account", "078-05-1120"), ("account", "12345678"), ("account", "C01234567")]
    assert added("accounting 12345678 my account 12") == []


def test_clean_texts_have_no_spans():
    rng = random.Random(2)
    for _ in range(200):
        assert personal.personal_spans(prose(rng, 80) + " 12.5 2024-01-05 12:30 3,141 a+b C++11 v1.2.3") == []


def test_long_texts_take_linear_time():
    start = time.time()
    for piece in ("1", "1.", "1 ", "a@", "+1", "a.b", "@a.", "account ", "1-1.1+1 1@1"):
        personal.personal_spans(piece * (400_000 // len(piece)))
    assert time.time() - start < 30


def check(rows, out):
    assert len(out) == len(rows)
    todo = sorted(out, key=lambda r: str(r.doc_id))
    for (i, text), r in zip(sorted(rows, key=lambda x: str(x[0])), todo):
        want = brute(text)
        names = [f"{personal.KINDS[k]}:{a}:{z}" for a, k, z in want]
        assert r.doc_id == i
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if s.split(":")[0] in personal.KINDS] == names
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), personal.ORDER[s.split(":")[0]]))


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(SF + "/documents.parquet").collect()]
    out = queries.op13_personal(spark, SF)
    check(rows, out.collect())
    assert dict(out.dtypes) == {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"}


def test_odd_rows(spark, monkeypatch):
    rows = [(1, CASES[12]), (1, CASES[12]), (1, CASES[16]), (2, None), (3, ""), (4, "x " * 300_000 + "a@b.c")]
    docs = documents(spark, rows, {"personal": "clash", "spans": 1, "kind": 2, "value": None})
    monkeypatch.setattr(queries, "table", lambda *a: docs.repartition(3))
    out = queries.op13_personal(spark, SF).collect()
    assert sorted((r.doc_id, r.spans) for r in out) == sorted((i, ",".join(f"{personal.KINDS[k]}:{a}:{z}" for a, k, z in brute(t))) for i, t in rows)
    monkeypatch.setattr(queries, "table", lambda *a: documents(spark, [(None, "a@b.c"), (None, None)]))
    assert sorted(r.spans for r in queries.op13_personal(spark, SF).collect()) == ["", "email:0:5"]
    monkeypatch.setattr(queries, "table", lambda *a: docs.limit(0))
    assert queries.op13_personal(spark, SF).collect() == []


def test_values_and_masks(spark):
    docs = documents(spark, [(1, "é a@b.c, +1 201 555 0123."), (2, None), (3, "clean")])
    found = {r.doc_id: r.personal for r in personal.find_personal(docs).collect()}
    assert [(s.kind, s.value) for s in found[1]] == [("email", "a@b.c"), ("phone", "+1 201 555 0123")] and found[2] == found[3] == []
    masked = {r.doc_id: r.text for r in docs.withColumn("text", personal.mask_personal("text")).collect()}
    assert masked == {1: "é <email>, <phone>.", 2: None, 3: "clean"}
