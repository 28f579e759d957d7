"""Scalar rules: table-driven cases and a randomised check of the description parser."""

import datetime as dt
import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ratesheet import fixed_values as fv
from ratesheet.functions import text, values, vectors
from ratesheet.operators import enrichment


def apply(spark, fn, inputs, kind="string"):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


DESCRIPTIONS = [
    ("IBUPROFEN 200 MG TABLET", "IBUPROFEN", "200", "MG", "TABLET"),
    ("IBUPROFEN 200MG TABLET", "IBUPROFEN", "200", "TABLET", None),
    ("HYDROCORTISONE 0.5% CREAM", "HYDROCORTISONE", "0.5", "0.5%", "CREAM"),
    ("8-MOP 10 MG CAPSULE", "8-MOP", "8", "10", "MG"),
    ("ASPIRIN  CHEWABLE", "ASPIRIN  CHEWABLE", None, None, None),
    ("  ASPIRIN\t CHEWABLE \n", "ASPIRIN\t CHEWABLE", None, None, None),
    ("A  B\t10\nMG", "A B", "10", "MG", None),
    ("10", "10", "10", None, None),
    ("X 5%", "X", "5", "5%", None),
    ("X 1/2 TAB", "X", "1", "TAB", None),
    ("X A.5 B", "X", "5", "B", None),
    ("   ", None, None, None, None),
    ("", None, None, None, None),
    (None, None, None, None, None),
]


def test_descriptions(spark):
    rows = [(i, c[0]) for i, c in enumerate(DESCRIPTIONS)]
    df = spark.createDataFrame(rows, "i int, ndc_description string")
    got = enrichment.parse_descriptions(df).orderBy("i").collect()
    assert [tuple(r)[2:] for r in got] == [c[1:] for c in DESCRIPTIONS]


def described(raw):
    """The parsing rules in plain words: see the field docs of the parser."""
    words = (raw or "").split()
    numbered = [n for n, w in enumerate(words) if re.search(r"\d", w)]
    if not numbered:
        return ((raw or "").strip() or None, None, None, None)
    at = numbered[0]
    rest = words[at + 1 :] + [None, None]
    name = " ".join(words[:at]) or words[0]
    number = re.search(r"\d+(?:\.\d+)?", words[at].replace("%", "")).group()
    if "%" in words[at]:
        return (name, number, words[at], rest[0])
    return (name, number, rest[0], rest[1])


def test_random_descriptions(spark):
    rng = random.Random(7)
    alphabet = ["A", "MG", "5", "10", ".", "%", "/", "-", " ", "  ", "\t", " ", "é", "٣", "\n"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(5000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, ndc_description string")
    got = enrichment.parse_descriptions(df).orderBy("i").collect()
    wrong = [(t, tuple(r)[2:], described(t)) for t, r in zip(texts, got) if tuple(r)[2:] != described(t)]
    assert not wrong, wrong[:3]


def test_legacy_descriptions(spark):
    cases = [
        ("A B 200MG X TABLET", "A B", 200, "X", "TABLET"),
        ("A 10 MG", "A", None, "10", "MG"),
        ("7UP 10 MG", "7UP", 7, "10", "MG"),
        ("A B", "A", None, "A", "B"),
        ("A", "A", None, None, "A"),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, ndc_description string")
    got = enrichment.parse_descriptions_legacy(df).orderBy("i").collect()
    assert [tuple(r)[2:] for r in got] == [c[1:] for c in cases]


def test_codes(spark):
    names = fv.EXPLANATION_CODES
    cases = {
        "1, 5": f"{names['1']} | {names['5']}",
        "2,99": names["2"],
        "99": None,
        "  ": None,
        "": None,
        None: None,
        "1,1": f"{names['1']} | {names['1']}",
        "10,\t7,,": "Reserved | Reserved",
    }
    assert apply(spark, text.explain_codes, list(cases)) == list(cases.values())
    df = spark.createDataFrame([(c,) for c in list(cases) * 3], "explanation_code string")
    joined = {r[0]: (r[1], r[2]) for r in enrichment.explain_codes_join(df).collect()}
    assert joined == {c: (t, 3) for c, t in cases.items()}


def test_dates(spark):
    d = dt.date
    cases = {
        "2024-01-05": d(2024, 1, 5),
        " 2024-1-5 ": d(2024, 1, 5),
        "1/5/2024": d(2024, 1, 5),
        "12/31/2024": d(2024, 12, 31),
        "2024/1/5": d(2024, 1, 5),
        "2024-01-05T00:00:00Z": d(2024, 1, 5),
        "2024-02-30": None,
        "2/30/2024": None,
        "13/1/2024": None,
        "0000-01-01": None,
        "1677-09-22": d(1677, 9, 22),
        "1600-01-01": None,
        "9999-12-31": None,
        "4/11/2262": d(2262, 4, 11),
        "24-01-05": None,
        "2024/01/05T00": None,
        "None": None,
        "null": None,
        "": None,
        "abc": None,
        None: None,
    }
    assert apply(spark, values.parse_date, list(cases)) == list(cases.values())


def test_plain_texts_take_short_ways(spark):
    """Days in plain ISO form, codes without odd characters and names without runs of spaces skip steps."""
    days = {
        "2024-01-31": "2024-01-31", "2023-02-29": None, "0000-01-01": None, "2024-01-5 ": "2024-01-05",
        "2024-01-5T": None, "2024-01-5\x00": None, " 024-01-02": None, "+123-01-02": None, "2262-04-12": None,
        "2024-1-\u06610": None, "2024-01-\u0661": None, "2024-01-31T1": "2024-01-31",
    }
    assert apply(spark, lambda c: values.parse_date(c).cast("string"), list(days)) == list(days.values())
    one, five = fv.EXPLANATION_CODES["1"], fv.EXPLANATION_CODES["5"]
    codes = {
        "1, 5": f"{one} | {five}", " 5 ,,\t1\u00a0,x": f"{five} | {one}", ",": None, "99": None, "": None, None: None,
        "1,1": f"{one} | {one}", "1 5": None,
    }
    assert apply(spark, text.explain_codes, list(codes)) == list(codes.values())
    plan = spark.range(1).select(text.explain_codes(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert "filter(" not in plan
    names = {"RED  RING 5 MG": "RED RING", "RED RING 5 MG": "RED RING", "5 MG": "5", " A \t B 5": "A B"}
    cut = spark.createDataFrame(list(enumerate(names)), "i int, c string").withColumn("k", text.cut_description(F.col("c")))
    found = cut.select("i", text.description_fields(F.col("k"), F.col("c"))["drug_name"].alias("name")).orderBy("i")
    assert [r.name for r in found.collect()] == list(names.values())



def test_ndc(spark):
    cases = {"00123-0456-01": "00123045601", " - ": None, "": None, None: None}
    assert apply(spark, values.ndc_digits, list(cases)) == list(cases.values())
    assert apply(spark, values.ndc_number, ["00123-1", "9" * 40]) == [1231, None]
    assert apply(spark, values.ndc_range_bucket, ["00123045601"]) == [123]


def test_prices(spark):
    assert apply(spark, values.price_number, ["$1,234.50", "-1.5", "1e-3"]) == [1234.5, 1.5, 13.0]
    with pytest.raises(PySparkException):
        apply(spark, values.price_number, ["$"])
    safe = ["$1,234.50", "-1.5", "1e-3", "abc", "", "1.5d", None]
    assert apply(spark, values.price_safe, safe) == [1234.5, -1.5, 0.001, None, None, None, None]


def test_plain_cast_of_price_text_raises(spark):
    df = spark.createDataFrame([("$1.00", "1.00")], "a string, b string")
    with pytest.raises(PySparkException):
        df.select(F.col("a").cast("double")).collect()


def test_flags_and_money(spark):
    assert apply(spark, text.classification_name, ["B", "G", "X", None]) == ["Brand Name", "Generic", "X", None]
    assert apply(spark, text.otc_name, ["Y", "N", "", None]) == ["Over-the-counter", "Prescription", "Prescription", None]
    numbers = [0.125, 2.675, 1234.5, 0.0, None]
    expected = [None if x is None else f"{x:.2f}" for x in numbers]
    assert apply(spark, text.money, numbers, "double") == expected


def test_object_names(spark):
    paths = [f"{fv.RAW_PREFIX}a.json", "elsewhere/a.json"]
    assert apply(spark, values.archive_path, paths) == [f"{fv.PROCESSED_PREFIX}a.json", None]
    at = F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")
    names = apply(spark, lambda c: values.page_file_name(c, at), [7], "int")
    assert names == ["medicaid_drug_data_page_0007_20240102_030405.json"]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    rows = df.select(
        vectors.normalise(F.col("a")).alias("n"), vectors.cosine(F.col("a"), F.col("b")).alias("c")
    ).collect()
    assert rows[0].n == [0.6, 0.8] and round(rows[0].c, 6) == 0.96
    assert rows[1].n == [0.0, 0.0] and rows[1].c == 0.0
