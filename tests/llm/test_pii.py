import hashlib
import re

import pytest

from millrace.llm import pii

SCHEMA = "doc_id long, text string, kind string, start string, rid int"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    """The base rules by Python's engine, as they are stated."""
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    found = {}
    for kind, pattern, ok in rules:
        found[kind] = [(m.start(), m.end()) for m in re.finditer(pattern, text or "") if ok(m.group())]
    return found


def check(row, text):
    expected = plain(text)
    assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [len(expected[k]) for k in pii.KINDS]
    listed = [f"{k}:{a}:{b}" for k in pii.KINDS for a, b in expected[k]]
    assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
    assert set(listed) <= set(row.spans.split(",")) | ({""} if not listed else set())


TEXTS = [
    "write to jane.doe+x@mail-1.example.com, or a@b.c_d@e.f and a@b.c@d.e",
    "é ü 😀 at 10.0.0.1 and 256.1.1.1 or 1.2.3.4.5.6.7.8, 001.002.003.004; 1.2.3. 4",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112, 5500000000000004 and 12 34",
    "call +1 (555) 010-2030 now, +4 4 or +49 30 1234567   , +1+2 345 678 90",
    "",
    None,
    "1" * 3000 + " " + "a" * 5000 + "@" + "1 " * 4000,
    "+1" + " " * 3000 + "2",
    "no personal data here: 12.5 and 3-4",
    "tel 555-123-4567, jane (at) mail (dot) org, IP 2001:db8:0:0:0:0:0:1",
]


def test_base_spans(spark):
    df = spark.createDataFrame([(i, t, "k", "s", 1) for i, t in enumerate(TEXTS)], SCHEMA).repartition(3)
    rows = {r.doc_id: r for r in pii.find(df).collect()}
    assert sorted(rows) == list(range(len(TEXTS)))
    for i, text in enumerate(TEXTS):
        check(rows[i], text)


def test_sample_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    rows = pii.find(df).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        check(r, texts[r.doc_id])
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 50


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a@b.cd", "", "", 0)], SCHEMA)
    plan = pii.find(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a@b.cd", "", "", 0)] * 2 + [(None, "a@b.cd", "", "", 0)], SCHEMA)
    rows = pii.find(df).collect()
    assert [r.spans for r in rows] == ["email:0:6"] * 3
    assert sorted(r.doc_id or 0 for r in rows) == [0, 1, 1]
    assert pii.find(spark.createDataFrame([], SCHEMA)).collect() == []


def test_labelers_add_spans(spark):
    """A number in the usual form beside the word for it is added; one that belongs to an order is not."""
    data = [(i, "please call +1 (555) 010-2030 today", "", "", 0) for i in range(40)]
    data += [(100 + i, "phone: 555-123-4567 or call (555) 123-4567", "", "", 0) for i in range(20)]
    data += [(200 + i, "order x555-123-4567 ref no 9", "", "", 0) for i in range(20)]
    rows = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(data, SCHEMA)).collect()}
    assert rows[100] == "phone:7:19,phone:28:42"
    assert rows[200] == ""


@pytest.mark.parametrize(("digits", "good"), [("4111111111111111", True), ("4111111111111112", False), ("0" * 16, True)])
def test_luhn(spark, digits, good):
    from pyspark.sql import functions as F

    assert spark.range(1).select(pii.luhn(F.lit(digits)).alias("x")).first().x is good


def test_neighbours_that_spoil_a_base_match(spark):
    """A card beside an address and a phone beside a card run together for the base patterns; the wide ones part them."""
    data = [(i, "pay 4111111111111111 now, +1 (555) 010-2030 today, 10.1.2.3 on", "", "", 0) for i in range(60)]
    data += [(100, "x 4111111111111111 5500000000000004 y", "", "", 0), (101, "x +1 (826) 555-4081 190.137.223.204 y", "", "", 0)]
    rows = {r.doc_id: r for r in pii.find(spark.createDataFrame(data, SCHEMA)).collect()}
    assert (rows[100].n_card, rows[100].spans) == (0, "card:2:18,card:19:35")
    assert (rows[101].n_phone, rows[101].n_ip, rows[101].spans) == (0, 1, "ip:20:35,phone:2:19")


def test_printed_cards_and_short_ipv6_are_proposed(spark):
    found = ["3782 822463 10005", "3782-822463-10005", "3056 930902 5904", "4222 222 222 222", "2001:db8::1", "fe80::", "::ffff:0:1", "2001:DB8:0:0:0:0:0:1"]
    left_out = ["std::vector", "Foo::Bar", "a :: b"]
    texts = [f"é before {t} after" for t in found + left_out]
    df = spark.createDataFrame([(i, t, "k", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    cut = pii.candidates(df).cache()
    ids = {r.rid: r.doc_id for r in cut.select("rid", "doc_id").collect()}
    got = [(ids[r.rid], r.start, r.end) for r in pii.spans(cut).where("not sure and kind in (1, 2) and check = 1").collect()]
    assert sorted(texts[i][a:b] for i, a, b in got) == sorted(found)
