"""Personal data spans against a plain scan of each text."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from regional_balance.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [[("email", m) for m in EMAIL.finditer(text)]]
    out.append([("ip", m) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))])
    out.append([("card", m) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))])
    out.append([("phone", m) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15])
    return out


def check(spark, values):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_personal_data(df).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        found = base(text or "")
        joined = ",".join(f"{k}:{m.start()}:{m.end()}" for kind in found for k, m in kind)
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [len(k) for k in found], text
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), text
        assert got[i].spans.startswith(joined), text


def test_random_texts(spark):
    rnd = random.Random(7)
    bits = ["a", "b.c", "@", "@x.y", ".", "-", "_", "%", " ", "  ", "1", "23", "255", "256", "007", "1.2.3.4", "+1", "(", ")", "é", "😀", "\n", "4785380592391139", "4111 1111 1111 1111", "+49 30 1234567", "a@b.c_d@e.f"]
    check(spark, ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))) for _ in range(3000)])


def test_edges(spark):
    long = ["9" * 3_000, "a" * 3_000, "1." * 30_000, "+1" + " " * 50_000, "a@" * 20_000, "a@b.cc " * 1500]
    check(spark, [None, "", " ", "a@b", "a@b.c", *long])


def test_driver_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()
    check(spark, [r.text for r in rows])


@pytest.mark.parametrize(
    "text, spans",
    [
        ("pay to DE89 3704 0044 0532 0130 00 now", "iban:7:34"),
        ("pay to DE89 3704 0044 0532 0130 01 now", ""),
        ("amex card 378282246310005 ok", "short_card:10:25"),
        ("serial 378282246310005 ok", ""),
        ("SSN 536-22-1234", "national_id:4:15"),
        ("part 536-22-1234", ""),
    ],
)
def test_further_kinds(spark, text, spans):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.find_personal_data(df).first().spans == spans


def test_mask(spark):
    rows = [(1, "mail 12@a.bc or call +49 30 1234567!", 3), (2, None, None), (3, "nothing", 7), (4, "4785 3805 9239 1139@x.com", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, all_spans long").withColumnRenamed("all_spans", "n_chars")
    got = {r.doc_id: r for r in pii.mask(df.withColumn("all_spans", df.n_chars).withColumn("found_ip", df.text)).collect()}
    assert got[1].text == "mail [EMAIL] or call [PHONE]!" and got[1].n_chars == len(got[1].text)
    assert got[2].text is None and got[3].text == "nothing" and got[3].all_spans == 7
    assert "9239" not in got[4].text and "x.com" not in got[4].text
    assert pii.mask(df.limit(0)).columns == df.columns


@pytest.mark.parametrize(
    "text, spans",
    [
        ("SSN: 536-22-1234, 536-22-1235", "national_id:5:16,national_id:18:29"),
        ("SSN: 536-22-1234, 536-22-1235, 536-22-1236", "national_id:5:16,national_id:18:29,national_id:31:42"),
        ("536-22-1234, 536-22-1235 (SSN)", "national_id:0:11,national_id:13:24"),
        ("amex: 378282246310005, 371449635398431", "short_card:6:21,short_card:23:38"),
        ("SSN 😀 536-22-1234" + " " * 41 + "536-22-1235", "national_id:6:17"),
    ],
)
def test_context_reaches_past_other_matches(spark, text, spans):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.find_personal_data(df).first().spans == spans


@pytest.mark.parametrize(
    "text, spans",
    [
        ("AT61 1904 3002 3457 3201 BIC", "iban:0:24"),
        ("BE68 5390 0754 7034 EUR", "iban:0:19"),
        ("BE68539007547034 2024", "iban:0:16"),
        ("NO93 8601 1117 947 NOK", "iban:0:18"),
        ("BE68 5390 0754 7034 DE89 3704 0044 0532 0130 00", "iban:0:19,iban:20:47"),
        ("BE68 5390 0754 7035 EUR", ""),
    ],
)
def test_iban_before_other_words(spark, text, spans):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.find_personal_data(df).first().spans == spans


def test_many_spans(spark):
    """Thousands of spans in one text: four times the text takes a few times as long, not sixteen times."""

    def run(n):
        text = "".join(f"call +49 30 {1234567 + k % 1000} or é, " for k in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        began = time.perf_counter()
        found = pii.find_personal_data(df).first()
        took = time.perf_counter() - began
        assert found.n_phone == n and found.spans.count(",") == n - 1
        assert pii.mask(df).first().text == "call [PHONE] or é, " * n
        return took

    run(100)
    small, large = run(2_500), run(10_000)
    assert large < 10 * max(small, 1)


def test_cuts_are_substrings(spark):
    text = "".join(chr(97 + k % 26) if k % 7 else "😀" for k in range(3000))
    places = [(0, 5), (-40, 3), (500, 530), (511, 512), (512, 513), (0, 3000), (2990, 9000), (10, 10), (10, 5), (3000, 3040), (1, 1600)]
    df = spark.createDataFrame([(text, a, b) for a, b in places], "t string, a int, b int")
    got = df.select("a", "b", pii.cut(pii.blocks_of(F.col("t")), F.col("a"), F.col("b")).alias("x")).collect()
    assert [r.x for r in got] == [text[max(a, 0) : b] if b > a else "" for a, b in places]


def test_odd_rows(odd, none):
    assert pii.find_personal_data(odd).count() == odd.count() and pii.find_personal_data(none).count() == 0
    assert pii.mask(none).columns == none.columns and pii.mask(odd).count() == odd.count()
