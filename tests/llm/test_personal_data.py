"""Personal data against the plain patterns and by-hand checksums."""

import random
import re

import duckdb
import pytest

from wardlight.llm import personal_data as P
from wardlight.llm import queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, span):
    digits = [int(c) for c in span if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in span.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = 0
        for i, d in enumerate(reversed(digits)):
            total += d if i % 2 == 0 else (d * 2 if d < 5 else d * 2 - 9)
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return True


def base(text):
    return [(k, *m.span()) for k, p in PLAIN.items() for m in re.finditer(p, text) if passes(k, m.group())]


def found(text):
    return [s[:3] for s in P.find_spans(text) if s[4]]


CASES = [
    "mail a.b@c.d.@e.f.g@h.i and x@y no@dots@z.org",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.000.1.01 1.2.3 1..2.3.4 99999999999999999999.1.1.1",
    "card 4111 1111 1111 1111, 4111-1111-1111-1111-1 4111  1111 0000000000000 12345678901234567890",
    "+1 (017) 555-7713 +12 +1 2 +123456789-  +4 9.30 (12) 34 56 78 9 +1234567890123456",
    "é😀a@b.c +1 (017) 555-7713 1.2.3.4 ٣.٤.٥.٦",
    "", " ", "@", "a@", "@b.c",
]


@pytest.mark.parametrize("text", CASES)
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert found(text) == base(text)


def test_base_spans_on_random_text():
    rnd = random.Random(3)
    for _ in range(4000):
        text = "".join(rnd.choice("ab1@@..+-() 0123456789é") for _ in range(rnd.randrange(80)))
        assert found(text) == base(text), text


def test_added_spans_need_checksum_context_and_room():
    kinds = {s[0]: s[1:3] for s in P.find_spans("IBAN DE89 3704 0044 0532 0130 00 now")}
    assert kinds == {"iban": (5, 32)}
    assert not P.find_spans("IBAN DE88 3704 0044 0532 0130 00 now")  # one digit off
    assert [s[0] for s in P.find_spans("my ssn is 123-45-6789")] == ["ssn"]
    assert not P.find_spans("part 123-45-6789") and not P.find_spans("ssn 000-45-6789") and not P.find_spans("ssn 9123-45-6789")
    assert [s[0] for s in P.find_spans("call (030) 555-1234 today")] == ["local_phone"]
    assert not P.find_spans("sizes (030) 555-1234 today")
    assert [s[0] for s in P.find_spans("call +1 (030) 555-1234 today")] == ["phone"]  # the base span holds it


def test_nearby_words_move_scores():
    near, far = P.find_spans("visa 4111111111111111"), P.find_spans("4111111111111111")
    assert near[0][3] > far[0][3] and far[0][4]


def test_very_long_texts_take_linear_time():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "1." * 1_000_000, "+1" * 500_000, "a@" * 500_000, "1 " * 500_000):
        P.find_spans(text)


def test_edges_and_sql(spark, tmp_path):
    rows = [(i, t, "x", i) for i, t in enumerate(CASES)] + [(100, None, None, None), (None, "a@b.c", "y", 1), (101, "a@b.c", "y", 1)]
    rows += [(102, "IBAN DE89 3704 0044 0532 0130 00, call 030 555-1234, ssn 123-45-6789 " * 3, "z", 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans string, n_email int")
    made = P.span_digest(P.find_personal_data(df))
    assert made.count() == len(rows)
    assert [r["n_email"] for r in made.filter("doc_id is null").collect()] == [1]
    assert made.filter("doc_id = 100").first()["spans"] == ""
    assert P.span_digest(P.find_personal_data(df.limit(0))).count() == 0
    df.filter("doc_id is not null").select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = queries.QUERIES["op13_personal_data"](spark, str(tmp_path)).orderBy("doc_id").collect()
    want = db.execute(f"select * from ({queries.ORACLE['op13_personal_data']}) order by doc_id").fetchall()
    assert [tuple(r) for r in got] == want
