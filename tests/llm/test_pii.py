from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from trendlake.llm import pii

KEY = "test key"


def run(spark, values, key=KEY):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    return [r.p for r in df.select("i", pii.pseudonymize(F.col("text"), key).alias("p")).orderBy("i").collect()]


def luhn(number):
    digits = [int(c) for c in reversed(re.sub(r"\D", "", number))]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10


def iban_rest(value):
    v = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97


def shape(text):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", text)))


def test_formats_stay_and_validity_too(spark):
    values = [
        "4111 1111 1111 1111", "4111-1111-1111-1112", "5927243074273351", "GB82 WEST 1234 5698 7654 32",
        "DE89370400440532013000", "123-45-6789", "+1 (017) 555-7713", "(555) 123-4567", "2024-02-29", "1999/12/31",
        "31.12.1999", "ann.34@mail7.example.com", '"b44e15e09fd311c3cf3163b66d5a9875b883d8ce"',
    ]
    values[-1] = "=" + values[-1][1:-1]
    for old, new in zip(values, run(spark, [f"x {v} y" for v in values]), strict=True):
        new = new[2:-2]
        assert new != old
        if "@" in old:
            assert new.split("@")[1] == old.split("@")[1]
        if "=" not in old:
            assert shape(new) == shape(old)
        if len(re.sub(r"\D", "", old)) == 16 and "G" not in old:
            assert luhn(new) == luhn(old)
        if old[:2] in ("GB", "DE"):
            assert iban_rest(new) == 1 == iban_rest(old)
        if old == "2024-02-29":
            date.fromisoformat(new)


def test_what_stays(spark):
    texts = [
        None, "", "plain words, version 4.0.", "2023-02-29 and 99.99.1999", "256.1.1.1", "000-12-3456 666-12-3456",
        "GB82 WEST 1234 5698 7654 33", "1234", "1" * 40, "a@b", "0001-01-01",
    ]
    got = run(spark, texts)
    # An IBAN with a wrong check isn't one.
    assert got == texts


def test_equal_values_stay_linked(spark):
    one, two, three, four = run(
        spark, ["card 4111111111111111!", "is 4111 1111 1111 1111", "call +15551234567", "or (555) 123-4567 or 555-123-4567"]
    )
    assert re.sub(r"\D", "", one) == re.sub(r"\D", "", two)
    last = re.sub(r"\D", "", three)[1:]
    assert re.sub(r"\D", "", four) == last * 2
    assert run(spark, ["card 4111111111111111!"], "other key") != [one]


def test_permutations_are_one_to_one(spark):
    ips = [f"10.0.{i}.{j}" for i in range(8) for j in range(32)]
    days = [date.fromordinal(700_000 + i).isoformat() for i in range(400)]
    numbers = [f"{i:09d}"[:3] + "-" + f"{i:09d}"[3:5] + "-" + f"{i:09d}"[5:] for i in range(123_450_001, 123_450_300)]
    accounts = [f"4{i:015d}" for i in range(300)]
    for values in (ips, days, numbers, accounts):
        new = run(spark, values)
        assert len(set(new)) == len(values)
        assert sum(a == b for a, b in zip(values, new, strict=True)) < 5


@pytest.mark.parametrize("sizes", [(3, 5), (1, 7), (16, 16)])
def test_number_network_is_a_permutation(spark, sizes):
    a, b = sizes
    pairs = spark.range(a * b).select(F.floor(F.col("id") / b).alias("a"), (F.col("id") % b).alias("b"))
    got = pairs.select(pii.feistel_numbers(KEY, "x", F.col("a"), F.col("b"), sizes).alias("p")).select("p.*").collect()
    assert len(set(got)) == a * b and all(0 <= r.a < a and 0 <= r.b < b for r in got)


def test_long_text_many_values_and_other_columns(messy):
    long = "mail ann.1@x.example.com at 2001-02-03 " * 3000
    got = messy.withColumn("text", F.lit(long)).withColumn("text", pii.pseudonymize(F.col("text"), KEY))
    rows = got.limit(2).collect()
    assert got.columns == messy.columns
    assert rows[0].text == rows[1].text and "2001-02-03" not in rows[0].text and len(rows[0].text) == len(long)


def test_empty_table_and_plan(no_documents, plan):
    got = no_documents.select(pii.pseudonymize(F.col("text"), KEY).alias("text"))
    assert got.isEmpty()
    assert "Python" not in plan(got)


def test_words_and_numbers_behind_a_value_are_no_part_of_it(spark):
    bare = ["ES9121000418450200051332", "ES91 2100 0418 4502 0005 1332", "NO93 8601 1117 947", "4111 1111 1111 1111", "4111-1111-1111-1111"]
    alone = run(spark, bare)
    assert all(a != b for a, b in zip(alone, bare, strict=True))
    for tail in (" PAGO", " BIC CAIXESBB", " 2024", " ABCD 1234", ", NOW"):
        followed = run(spark, [v + tail for v in bare[:3]])
        assert followed == [a + tail for a in alone[:3]]
    for tail in (" 12", " 2024", "-7", " EUR"):
        assert run(spark, [v + tail for v in bare[3:]]) == [a + tail for a in alone[3:]]


def test_nineteen_digits_in_groups_stay_one_number(spark):
    grouped, plain = run(spark, ["6304 0000 0000 0000 000", "6304000000000000000"])
    assert re.sub(" ", "", grouped) == plain and plain[:16] != "6304000000000000"


@pytest.mark.parametrize("length,names", pii.IBAN_LENGTHS.items())
def test_every_listed_country(length, names):
    for name in names.split():
        value = name + "00" + "1" * (length - 4)
        found = re.search(pii.IBAN, f"x {value} ABCD 12")
        assert found and found[0] == value
