import pytest
from pyspark.sql import functions as F

from ledger_spark.functions import clean_description, clean_description_simple, clean_merchant, confidence_score
from ledger_spark.functions.text import substrings

# raw text, merchant, description
EDGES = [
    ("SQ *BLUE BOTTLE COFFEE #B12", "blue bottle coffee", "sq blue bottle coffee b12"),
    ("TST* The Corner Bistro", "tst", "tst the corner bistro"),
    ("TRADER JOE'S #552", "trader joes", "trader joe s 552"),
    ("AMAZON.COM*A12B34CD5", "amazoncom", "amazon com a12b34cd5"),
    ("SQ *", "sq", "sq"),
    ("** FOO", None, "foo"),
    ("* FOO", "foo", "foo"),
    ("", None, ""),
    ("T-MOBILE", "tmobile", "tmobile"),
    (" SQ *X", "sq", "sq x"),
    ("UBER TRIP", "uber trip", "uber trip"),
    (None, None, ""),
    ("Café Ö", "caf", "caf"),
    ("sq *lower", "sq", "sq lower"),
    ("CL *ACME", "acme", "cl acme"),
    ("SQ **X", "sq", "sq x"),
    ("a\vb\tc\nd", "ab c d", "a b c d"),
    (" ", "", ""),
]


def test_cleansing_edges(spark):
    rows = spark.createDataFrame([(i, raw) for i, (raw, _, _) in enumerate(EDGES)], "i int, raw string")
    cleaned = rows.select("i", clean_merchant(F.col("raw")).alias("m"), clean_description(F.col("raw")).alias("d"))
    assert {r.i: (r.m, r.d) for r in cleaned.collect()} == {i: (m, d) for i, (_, m, d) in enumerate(EDGES)}


def test_simple_cleaner_deletes_specials(spark):
    rows = spark.createDataFrame([("ACH DEBIT - T-MOBILE",), ("Trader Joe's",), (None,)], "raw string")
    assert [r[0] for r in rows.select(clean_description_simple(F.col("raw"))).collect()] == [
        "ach debit tmobile", "trader joes", "",
    ]


@pytest.mark.parametrize("clean", [clean_description, clean_description_simple])
def test_description_cleaning_is_idempotent(spark, clean):
    rows = spark.createDataFrame([(raw,) for raw, _, _ in EDGES], "raw string")
    twice = rows.select(clean(F.col("raw")).alias("once")).select("once", clean(F.col("once")).alias("twice"))
    assert twice.filter("once <> twice").count() == 0


def test_scores(spark):
    expected = {0: 0, 2: 0, 3: 50, 4: 50, 5: 60, 9: 76, 10: 80, 14: 96, 15: 80, 20: 85, 29: 94, 40: 94}
    scored = spark.range(41).withColumn("score", confidence_score(F.col("id")))
    actual = {r.id: r.score for r in scored.collect()}
    assert {n: actual[n] for n in expected} == expected


def test_substrings(spark):
    frame = spark.createDataFrame([("abcabc",), ("ab",), (None,)], "s string").select(substrings(F.col("s"), 3))
    assert [r[0] for r in frame.collect()] == [["abc", "bca", "cab"], None, None]
