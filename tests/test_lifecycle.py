import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledger_spark.operators import batches, enrichment, quality
from ledger_spark.operators.cleansing import cleanse_transactions
from ledger_spark.operators.lifecycle import apply_fallback, reset_labels
from ledger_spark.plans.adhoc import run_query
from ledger_spark.schema import prepare_rules_schema, prepare_transactions_schema
from ledger_spark.sources.ingest import ingest_json, read_transactions_json
from ledger_spark.sources.staging import Staging

from .conftest import TRANSACTION_DEFAULTS, by_id


def test_cleansing_is_incremental(make_transactions):
    rows = make_transactions(
        {"description_raw": "A-B", "description_cleaned": "old", "merchant_name_cleaned": "old"},
        {"description_raw": "A-B", "description_cleaned": "old", "merchant_name_raw": "SQ *X #1"},
        {"description_raw": None, "merchant_name_raw": "** X"},
    )
    seen = Observation()
    once = cleanse_transactions(rows, seen)
    expected = [("old", "old"), ("ab", "x"), ("", None)]
    assert list(by_id(once, "description_cleaned", "merchant_name_cleaned").values()) == expected
    assert seen.get["affected"] == 2
    again = cleanse_transactions(once)
    assert list(by_id(again, "description_cleaned", "merchant_name_cleaned").values()) == expected


def test_reset(make_transactions):
    rows = make_transactions({"category_l1": "Income", "description_cleaned": "d", "llm_confidence_score": 7})
    with pytest.raises(ValueError):
        reset_labels(rows)
    cleared = reset_labels(rows, confirm=True)
    assert by_id(cleared, "category_l1", "description_cleaned", "llm_confidence_score") == {"T0000": (None, None, 7)}
    assert cleared.schema == rows.schema


def test_fallback(make_transactions, as_of):
    rows = make_transactions(
        {}, {"transaction_type": "Credit"}, {"category_l1": "Transfer"}, {"transaction_type": "Other"},
        {"category_l1": "Income", "category_l2": "Refund"},
    )
    seen = Observation()
    got = by_id(apply_fallback(rows, as_of, seen), "category_l1", "category_l2", "categorization_method")
    assert list(got.values()) == [
        ("Expense", "Other Expense", "fallback"), ("Income", "Other Income", "fallback"),
        ("Expense", "Other Expense", "fallback"), (None, None, "fallback"), ("Income", "Refund", None),
    ]
    assert seen.get["affected"] == 4


def test_schema_preparation_is_idempotent(spark, make_transactions, make_rules):
    rules = prepare_rules_schema(make_rules({"is_active": None}, {"is_active": False}).drop("is_active"))
    assert [r.is_active for r in prepare_rules_schema(rules).collect()] == [True, True]
    rows = make_transactions({"llm_confidence_score": 3})
    assert prepare_transactions_schema(rows).first().llm_confidence_score == 3
    assert dict(prepare_transactions_schema(rows.drop("llm_confidence_score")).dtypes)["llm_confidence_score"] == "bigint"


def test_quality_report_isolates_failures(spark):
    columns = [c for c in TRANSACTION_DEFAULTS if c != "is_recurring"]
    rows = spark.createDataFrame([tuple(None for _ in columns)], ", ".join(f"{c} string" for c in columns))
    report = quality.quality_report(rows.withColumn("transaction_id", F.lit("T")), Staging(spark))
    assert isinstance(report["inconsistent_recurring"], Exception)
    assert report["status_by_persona"].collect()[0].asDict() == {
        "persona": "Unknown", "category": "Uncategorized", "transaction_count": 1
    }


def test_quality_report_survives_a_report_that_fails_while_it_runs(spark, make_transactions):
    """The error comes from a value, so planning succeeds."""
    rows = make_transactions({"amount": 1.0, "category_l1": "Expense", "category_l2": "Medical"}, {})
    broken = rows.withColumn("amount", F.when(F.col("amount") > 0, F.raise_error(F.lit("no such amount")).cast("double")).otherwise(F.col("amount")))
    report = quality.quality_report(broken, Staging(spark))
    assert "no such amount" in str(report["direction_mismatch"]) and isinstance(report["direction_mismatch"], Exception)
    assert {name for name, result in report.items() if not isinstance(result, Exception)} == set(quality.REPORTS) - {"direction_mismatch"}
    assert report["missing_labels"].first().transaction_count == 1
    sizes = {r.report: (r.n_rows, r.error) for r in quality.report_sizes(broken, Staging(spark)).collect()}
    assert sizes["direction_mismatch"][0] is None and sizes["direction_mismatch"][1] and sizes["status_by_persona"] == (2, None)


def test_adhoc_queries_leave_the_views_of_the_session(spark, make_transactions):
    spark.range(3).createOrReplaceTempView("t")
    result = run_query(spark, "SELECT count(*) AS n FROM t, u", {"t": make_transactions({}), "u": make_transactions({}, {})})
    assert spark.table("t").count() == 3 and not spark.catalog.tableExists("u")
    assert result.first().n == 2
    with pytest.raises(Exception, match="nowhere"):
        run_query(spark, "SELECT * FROM t, nowhere", {"t": make_transactions({})})
    assert spark.table("t").count() == 3
    spark.catalog.dropTempView("t")


def test_adhoc_queries(spark, make_transactions):
    rows = make_transactions({"merchant_name_cleaned": "o'hare"}, {})
    sql = "SELECT count(*) AS n FROM t WHERE merchant_name_cleaned <=> :name"
    assert run_query(spark, sql, {"t": rows}, {"name": "o'hare"}).first().n == 1
    assert run_query(spark, "  with x as (select 1 as a) select * from x", {}).first().a == 1
    assert run_query(spark, "/* all */ SELECT 1 AS a", {}).first().a == 1
    writes = ("WITH x AS (SELECT 1 AS a) INSERT INTO t SELECT a FROM x", "WITH x AS (SELECT 1 AS a) DELETE FROM t WHERE a IN (SELECT a FROM x)")
    for refused in ("DELETE FROM t", "UPDATE t SET a = 1", "DROP TABLE t", "SET a = 1", *writes):
        with pytest.raises(ValueError):
            run_query(spark, refused, {"t": rows})


def test_batches_and_transfers(spark, make_transactions):
    rows = make_transactions(
        *[{"merchant_name_cleaned": "m", "description_cleaned": "d", "channel": "ACH"}] * 2,
        {"merchant_name_cleaned": "m", "category_l1": "Transfer", "amount": -7.0,
         "transaction_date": dt.datetime(2024, 1, 1)},
        {"merchant_name_cleaned": "n", "description_cleaned": "e", "transaction_type": "Credit"},
    )
    for size in (10, None):
        (group,) = batches.merchant_batch(rows, size, Staging(spark)).collect()
        assert (group.merchant_name_cleaned, group.uncategorized_count) == ("m", 2)
        assert [e.amount for e in group.example_transactions] == [-7.0, -1.0, -1.0]
        (pattern,) = batches.pattern_batch(rows, size).collect()
        assert (pattern.description_prefix, len(pattern.example_transactions)) == ("d", 2)
    assert batches.transaction_batch(rows, None).count() == 3
    assert batches.transaction_batch(rows, 1).count() == 1
    assert by_id(batches.transaction_batch(rows, transaction_type="Credit"), "amount") == {"T0003": -1.0}


def test_ingest(spark, tmp_path):
    source, table = tmp_path / "rows.json", str(tmp_path / "table")
    source.write_text('{"transaction_id": "a", "account_id": "x", "amount": 1.5, "transaction_date": "2024-01-02T03:04:05Z"}\n')
    ingest_json(spark, str(source), table, recreate=True)
    assert ingest_json(spark, str(source), table).count() == 2
    assert ingest_json(spark, str(source), table, recreate=True).first().transaction_date == dt.datetime(2024, 1, 2, 3, 4, 5)
    for bad in ('{"transaction_id": "a"}\n', '{"transaction_id": "a", "account_id": "x", "amount": "much"}\n'):
        source.write_text(bad)
        with pytest.raises(Exception):
            read_transactions_json(spark, str(source)).collect()


def test_enrichment(spark):
    rows = spark.createDataFrame(
        [("Groceries", "Trader Joe's", 5.0), ("Peer to Peer Transfer", "x", -5.0), ("Income", "AARP", -5.0),
         ("Education", "AARP", 5.0), (None, "AARP", 5.0)],
        "category_l2 string, merchant_name_cleaned string, amount double",
    ).withColumns({"merchant_name_raw": F.lit("r"), "description_raw": F.lit("A-B c")})
    got = [(r.category_l1, r.transaction_type, r.amount, r.channel, r.description_cleaned)
           for r in enrichment.enrich_incoming(rows).collect()]
    assert got == [
        ("Expense", "Debit", -5.0, "Point-of-Sale", "ab c"), ("Transfer", "Credit", 5.0, "P2P", "ab c"),
        ("Income", "Credit", 5.0, "ACH", "ab c"), ("Expense", "Debit", -5.0, "ACH", "ab c"),
    ]
    assert enrichment.count_incomplete(rows).first().asDict() == {"rejected_rows": 1, "total_rows": 5}


def test_schedule_stays_in_its_month(spark):
    bills = spark.createDataFrame([("RENT", 31, -10.0)], "merchant_name string, day_of_month int, amount_mean double")
    rows = enrichment.expand_schedule(bills, 4, F.lit("2024-04-15").cast("timestamp")).collect()
    assert sorted(str(r.transaction_date.date()) for r in rows) == ["2024-01-31", "2024-02-29", "2024-03-31", "2024-04-30"]
    assert {r.description_cleaned for r in rows} == {"ach debit rent"}


def test_first_event_covers_a_month(spark):
    events = spark.createDataFrame(
        [("c", "late", 2, 5, 2), ("c", "early", 1, 4, 1), ("d", "empty", 1, 3, 3)],
        "consumer_name string, name string, position int, start_month_ago int, end_month_ago int",
    )
    months = spark.createDataFrame([(c, i) for c in "cd" for i in range(7)], "consumer_name string, month_index int")
    got = {(r.consumer_name, r.month_index): r.active_event for r in enrichment.annotate_events(months, events).collect()}
    assert [got["c", i] for i in range(7)] == [None, None, "early", "early", "early", "late", None]
    assert not any(got["d", i] for i in range(7))
