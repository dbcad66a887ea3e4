"""Shape of the physical plans, and skewed keys."""

import pytest
from pyspark.sql import functions as F

from ledger_spark.operators import matching
from ledger_spark.operators.batches import merchant_batch
from ledger_spark.operators.cleansing import cleanse_transactions
from ledger_spark.operators.lifecycle import apply_fallback
from ledger_spark.operators.recurring import recurring_candidates, transaction_intervals
from ledger_spark.operators.rules import apply_rules
from ledger_spark.plans.registry import queries
from ledger_spark.schema import RULES_SCHEMA
from ledger_spark.sources import fixtures


def plan_of(frame, capsys):
    capsys.readouterr()
    frame.explain("formatted")
    return capsys.readouterr().out


def executed(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_product_join_and_no_python(spark, small_folder, name, capsys):
    if name in ("full_categorization", "full_categorization_rules", "recurring_workflow", "ingest_json"):
        pytest.skip("reads staged tables; its steps are checked on their own")
    plan = plan_of(queries()[name](spark, small_folder), capsys)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert node not in plan


def pattern_rules(spark, n):
    """``n`` pattern rules: word and number, such as 'shop 123 paid'."""
    i = F.col("id")
    text = {"rule_id": F.concat(F.lit("R"), i.cast("string")), "identifier": F.concat(F.lit("shop "), i.cast("string"), F.lit(" paid"))}
    fixed = {"rule_type": "pattern", "transaction_type": "Debit", "category_l1": "Expense", "category_l2": "Medical", "confidence_score": 50,
             "is_active": True}
    return spark.range(n).select(*[
        (text.get(f.name) if f.name in text else F.lit(fixed.get(f.name))).cast(f.dataType).alias(f.name) for f in RULES_SCHEMA.fields
    ])


def report_rows(rows, n):
    """Rows whose number in 'shop <number> paid' is one of the ``n`` patterns."""
    return rows.filter(F.regexp_extract("description_cleaned", r"shop (\d+) paid", 1).cast("int") < n).count()


@pytest.mark.parametrize("n", [10, 10_000, 300_000])
def test_matching_has_one_plan_for_all_sizes(spark, n):
    """Probes meet the filter before any shuffle, and a text brings few more probes than it has matches."""
    number = F.length("merchant_name_cleaned").cast("string")
    rows = hot_rows(spark).withColumn("description_cleaned", F.concat(F.lit("card shop "), number, F.lit(" paid at noon")))
    rules = pattern_rules(spark, n)
    index = matching.index_rules(rules)
    frame = matching.match_keys(rows, index)
    before_shuffle = executed(matching.candidate_probes(rows, index))
    assert "Generate" in before_shuffle and "Exchange" not in before_shuffle.split("Subquery")[0]
    for node in ("Cartesian", "NestedLoop", "Python"):
        assert node not in executed(frame)
    joins = [line for line in frame._jdf.queryExecution().analyzed().toString().splitlines() if "Join Inner" in line and "probe" in line]
    hints = frame._jdf.queryExecution().optimizedPlan().toString().count("rightHint=(strategy=broadcast)")
    assert len(joins) == 1 and hints == (n <= matching.MAX_BROADCAST_ROWS)
    assert frame.agg(F.sum("n")).first()[0] == report_rows(rows, n)
    report = matching.probe_report(rows, index).first()
    assert report["n_probes"] > 20 * report["n_rows"]
    assert report["n_shuffled"] <= 3 * report["n_rows"] and report["n_joined"] <= 3 * report["n_texts"]


def test_rows_without_a_matching_rule_are_not_shuffled(spark):
    index = matching.index_rules(pattern_rules(spark, 10_000))
    letters = F.translate("description_cleaned", "0123456789", "abcdefghij")  # shares no substring with a pattern
    rows = hot_rows(spark).withColumn("description_cleaned", letters)
    report = matching.probe_report(rows, index).first()
    assert report["n_rows"] == 60_000 and report["n_shuffled"] < 0.03 * report["n_probes"]
    assert matching.match_keys(rows, index).count() == 0


def test_a_text_is_probed_once_however_many_rows_have_it(spark, monkeypatch):
    index, rows, seen = matching.index_rules(pattern_rules(spark, 100)), hot_rows(spark), []
    probes = matching.candidate_probes
    monkeypatch.setattr(matching, "candidate_probes", lambda keys, *a, **k: seen.append(keys.count()) or probes(keys, *a, **k))
    matching.match_keys(rows, index)
    assert seen == [rows.select(*matching.MATCH_KEY).distinct().count()] and seen[0] < 10_000


def test_projections_do_not_shuffle(spark, small_folder, as_of, capsys):
    rows = fixtures.transactions(spark, small_folder)
    assert "Exchange" not in plan_of(apply_fallback(cleanse_transactions(rows), as_of), capsys)


def test_filters_reach_the_scan(spark, small_folder, as_of, capsys):
    rows, rules = fixtures.transactions(spark, small_folder), fixtures.rules(spark, small_folder)
    plan = plan_of(apply_rules(rows, rules, as_of), capsys)
    assert "PushedFilters: [IsNull(category_l1)" in plan and "PushedFilters: [IsNotNull(category_l1)" in plan
    plan = plan_of(transaction_intervals(rows), capsys)
    assert "description_raw" not in plan


def test_examples_are_limited_before_the_shuffle(spark, small_folder, capsys):
    rows = fixtures.transactions(spark, small_folder)
    for frame in (merchant_batch(rows), merchant_batch(rows, None), recurring_candidates(rows, None)):
        assert "WindowGroupLimit" in plan_of(frame, capsys).split("Exchange")[0] or (
            plan_of(frame, capsys).count("WindowGroupLimit") >= 2
        )


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed_session(spark):
    before = {key: spark.conf.get(key, None) for key in SKEW}
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_rows(spark, n=60_000):
    """A third of all rows share merchant, description and day."""
    i = F.col("id")
    name = F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), (i % 5000).cast("string")))
    return spark.range(0, n, 1, 16).select(
        F.concat(F.lit("T"), F.lpad(i.cast("string"), 8, "0")).alias("transaction_id"),
        F.sha2(i.cast("string"), 512).alias("account_id"),
        name.alias("merchant_name_cleaned"),
        F.concat(F.lit("pay "), name).alias("description_cleaned"),
        F.lit(None).cast("string").alias("persona_type"),
        F.lit("Debit").alias("transaction_type"),
        F.when(i % 3 == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("timestamp").alias("transaction_date"),
        F.lit(-1.0).alias("amount"),
        *[F.lit(None).cast("string").alias(c) for c in ("category_l1", "category_l2", "categorization_method", "rule_id")],
        F.lit(None).cast("boolean").alias("is_recurring"),
        F.lit(None).cast("timestamp").alias("categorization_update_timestamp"),
    )


def test_hot_match_key_is_split(skewed_session, make_rules, as_of, monkeypatch):
    monkeypatch.setattr(matching, "MAX_BROADCAST_ROWS", 0)
    rules = make_rules({"identifier": "hot"}, {"identifier": "pay m1", "rule_type": "pattern", "category_l2": "Medical"})
    labelled = apply_rules(hot_rows(skewed_session), rules, as_of).cache()
    counts = {r.category_l2: r["count"] for r in labelled.groupBy("category_l2").count().collect()}
    assert counts["Shopping"] == 20_000 and sum(counts.values()) == 60_000
    labelled.unpersist()
    frame = apply_rules(hot_rows(skewed_session), rules, as_of)
    frame.collect()
    assert "skew=true" in executed(frame)


def test_hot_merchant_day_is_split(skewed_session):
    frame = transaction_intervals(hot_rows(skewed_session))
    gaps = {}
    for row in frame.collect():
        gaps[row.days_since_last_txn] = gaps.get(row.days_since_last_txn, 0) + 1
    merchants = 1 + hot_rows(skewed_session).filter("merchant_name_cleaned <> 'hot'").select(
        "merchant_name_cleaned").distinct().count()
    assert gaps == {None: merchants, 0: 60_000 - merchants}
    assert "skew=true" in executed(frame)
