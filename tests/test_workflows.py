from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledger_spark.plans import registry
from ledger_spark.plans.workflows import Labellers, run_categorization, run_recurring
from ledger_spark.sources import fixtures
from ledger_spark.sources.staging import Staging, is_written
from ledger_spark.streaming.arrivals import label_arrivals

from .conftest import by_id


def payload(batch, *fields):
    body = F.to_json(F.array(F.struct(*fields)), {"ignoreNullFields": "false"})
    return batch.select(body.alias("payload"))


def medical(*key):
    return lambda batch: payload(
        batch, *key, F.lit("Expense").alias("category_l1"), F.lit("Medical").alias("category_l2"),
        F.lit(9).alias("llm_confidence_score"),
    )


def test_every_step_takes_its_rows(make_transactions, make_rules, as_of):
    rows = make_transactions(
        {"merchant_name_raw": "RULED #1"},
        {"merchant_name_raw": "PAIR #1"}, {"merchant_name_raw": "PAIR #2"},
        {"merchant_name_raw": "** A", "description_raw": "same text", "channel": "ACH"},
        {"merchant_name_raw": "** B", "description_raw": "same text", "channel": "ACH"},
        {"merchant_name_raw": "ALONE"},
        {"merchant_name_raw": "SKIPPED", "transaction_type": "Credit"},
        {"merchant_name_raw": "DONE", "category_l1": "Income", "category_l2": "Refund"},
    ).drop("llm_confidence_score")
    rules = make_rules(
        {"identifier": "ruled", "confidence_score": 80}, {"identifier": "ruled", "category_l2": "Groceries"}
    ).withColumn("is_active", F.lit(None).cast("boolean"))
    labellers = Labellers(
        medical("merchant_name_cleaned", "transaction_type", "persona_type"),
        medical("description_prefix", "transaction_type", "channel", "persona_type"),
        lambda batch: medical("transaction_id")(batch.filter("transaction_type = 'Debit'")),
    )
    result = run_categorization(rows, rules, as_of, labellers, include_patterns=True)
    labelled = result.transactions.select("transaction_id", "category_l2", "categorization_method")
    assert list(dict(sorted(by_id(labelled, "category_l2", "categorization_method").items())).values()) == [
        ("Shopping", "rules-based-merchant"),
        *[("Medical", "llm-bulk-merchant-based")] * 2,
        *[("Medical", "llm-bulk-pattern-based")] * 2,
        ("Medical", "llm-transaction-based"),
        ("Other Income", "fallback"),
        ("Refund", None),
    ]
    assert result.affected_rows() == {
        "conflicts": 1, "cleanse": 8, "rules": 1, "merchants": 2, "patterns": 2, "transactions": 1,
        "learn-merchant": 1, "learn-pattern": 0, "learn-transaction": 0, "learn-single-merchant": 1, "fallback": 1,
    }
    learned = result.rules.select("identifier", "confidence_score", "is_active").collect()
    assert sorted(map(tuple, learned)) == [
        ("alone", 95, True), ("pair", 0, True), ("ruled", 50, False), ("ruled", 80, True)
    ]


class Recorder(Staging):
    """Keeps the physical plans of what is written."""

    def __init__(self, spark):
        super().__init__(spark)
        self.plans = {}

    def _write(self, df, path, partitions=()):
        self.plans[path.rsplit("-", 1)[-1]] = df._jdf.queryExecution().sparkPlan().toString()
        super()._write(df, path, partitions)


def test_raw_rows_are_read_and_cleansed_once(spark, make_transactions, make_rules, as_of, tmp_path):
    raw = str(tmp_path / "raw")
    labelled = {"category_l1": "Income", "category_l2": "Refund"}
    make_transactions({"merchant_name_raw": "RULED #1"}, {"merchant_name_raw": "OTHER"}, labelled).write.parquet(raw)
    staging = Recorder(spark)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        run_categorization(
            spark.read.parquet(raw), make_rules({"identifier": "ruled"}), as_of,
            Labellers(medical("merchant_name_cleaned", "transaction_type", "persona_type")), staging=staging,
        )
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    plans = "".join(staging.plans.values())
    assert plans.count(raw) == 1 and plans.count("regexp_extract(") == 1
    assert raw in staging.plans["cleanse"]
    assert "PartitionFilters: [isnotnull(__holds" in staging.plans["rules"] and "PartitionFilters: [isnotnull(__holds" in staging.plans["merchants"]


def test_staged_tables_are_removed_on_request(spark, make_transactions):
    staging = Staging(spark)
    kept = Staging(spark)
    rows = make_transactions({}, {"category_l1": "Income", "category_l2": "Refund"})
    holds, others = staging.split(rows, "rows", F.col("category_l1").isNull())
    assert holds.columns == rows.columns and (holds.count(), others.count()) == (1, 1)
    table = kept.table(rows, "rows")
    staging.delete()
    assert not is_written(spark, staging.folder + "/001-rows") and is_written(spark, kept.folder + "/001-rows")
    assert table.count() == 2


def test_conflicts_are_settled_by_answers(make_transactions, make_rules, as_of):
    rules = make_rules(
        {"identifier": "a", "confidence_score": 90}, {"identifier": "a", "category_l2": "Groceries"}, {"identifier": "b"},
        {"identifier": "b", "category_l2": "Groceries", "confidence_score": 10},
    )
    seen = []

    def answers(batch):
        seen.extend(r.rule_id for r in batch.collect())
        texts = ['```json\n{"rule_to_keep": "R0001", "rules_to_deactivate": ["R0000"]}\n```', "no idea", '{"rules_to_deactivate": "R0002"}']
        return batch.sparkSession.createDataFrame([(t,) for t in texts], "payload string")

    rows = make_transactions({"merchant_name_raw": "A"})
    result = run_categorization(rows, rules, as_of, Labellers(conflicts=answers))
    assert sorted(seen) == ["R0000", "R0001", "R0002", "R0003"]
    assert by_id(result.rules, "is_active", key="rule_id") == {"R0000": False, "R0001": True, "R0002": True, "R0003": True}
    assert by_id(result.transactions, "rule_id") == {"T0000": "R0001"}
    assert result.affected_rows()["conflicts"] == 1


def test_rounds_offer_no_merchant_twice(make_transactions, as_of):
    rows = make_transactions(*[{"merchant_name_cleaned": f"m{i}", "description_cleaned": "plan"} for i in range(7) for _ in range(5)])
    offered = []

    def some(batch):
        names = [r.merchant_name_cleaned for r in batch.collect()]
        offered.append(names)
        return payload(batch.filter("merchant_name_cleaned <> 'm3'"), "merchant_name_cleaned", "transaction_type", F.lit(True).alias("is_recurring"))

    result = run_recurring(rows, as_of, some, batch_size=3)
    assert [len(names) for names in offered] == [3, 3, 1] and len(set(sum(offered, []))) == 7
    flagged = result.transactions.filter("is_recurring").select("merchant_name_cleaned").distinct().collect()
    assert {r.merchant_name_cleaned for r in flagged} == {f"m{i}" for i in range(7)} - {"m3"}
    assert result.affected_rows()["rounds"] == 3
    assert run_recurring(rows, as_of, some, batch_size=2, max_rounds=2).affected["rounds"] == 2
    assert run_recurring(rows.limit(0), as_of, some, batch_size=2).affected["rounds"] == 0


def test_without_labellers_only_rules_and_fallback_run(make_transactions, make_rules, as_of):
    result = run_categorization(make_transactions({}, {"transaction_type": "Credit"}), make_rules(), as_of)
    assert {r.category_l2 for r in result.transactions.collect()} == {"Other Expense", "Other Income"}


def test_recurring_workflow(make_transactions, as_of):
    month = [{"merchant_name_cleaned": "gym", "transaction_date": None, "description_cleaned": "membership"}]
    rows = make_transactions(
        *month * 4, {**month[0], "category_l1": "Expense", "category_l2": "Health & Wellness"},
        {"merchant_name_cleaned": "gym", "transaction_type": "Credit"},
    )
    result = run_recurring(
        rows, as_of,
        lambda batch: payload(batch, "merchant_name_cleaned", "transaction_type",
                              F.col("has_recurring_keywords").alias("is_recurring")),
    )
    labels = list(by_id(result.transactions, "category_l2", "is_recurring").values())
    assert labels == [("Health & Wellness", True)] * 5 + [(None, None)]
    assert result.affected_rows() == {"flag": 5, "harmonize": 4}


def test_invariants_on_derived_tables(spark, small_folder):
    before = fixtures.transactions_unlabelled(spark, small_folder)
    after = registry.categorize(spark, small_folder).transactions
    assert after.count() == before.count() == after.select("transaction_id").distinct().count()
    assert after.filter("category_l1 IS NULL OR category_l2 IS NULL").count() == 0


def test_arrivals_are_labelled_batch_by_batch(spark, make_transactions, make_rules, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    rows = make_transactions({"merchant_name_raw": "SHOP #1"}, {"merchant_name_raw": "OTHER"})
    rows.filter("transaction_id = 'T0000'").write.parquet(source)
    rules = make_rules({"identifier": "shop"})

    def run():
        stream = spark.readStream.schema(rows.schema).parquet(source)
        query = label_arrivals(stream, lambda _: rules, table, str(tmp_path / "progress"))
        query.trigger(availableNow=True).start().awaitTermination()

    run()
    rows.filter("transaction_id = 'T0001'").write.mode("append").parquet(source)
    run()
    labelled = spark.read.parquet(table)
    assert by_id(labelled, "category_l2", "batch_id") == {"T0000": ("Shopping", 0), "T0001": (None, 1)}


def test_a_replayed_batch_gives_equal_rows(spark, make_transactions, make_rules, tmp_path):
    source, table, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))
    make_transactions({"merchant_name_raw": "SHOP #1"}, {"merchant_name_raw": "OTHER"}).write.parquet(source)
    current = [make_rules({"identifier": "shop"})]

    def run():
        stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        query = label_arrivals(stream, lambda _: current[0], table, progress)
        query.trigger(availableNow=True).start().awaitTermination()
        return sorted(map(str, spark.read.parquet(table).collect()))

    first = run()
    (tmp_path / "progress" / "commits" / "0").unlink()  # as after a failure between the write and the commit
    (tmp_path / "progress" / "commits" / ".0.crc").unlink(missing_ok=True)
    current[0] = make_rules({"identifier": "shop", "category_l2": "Groceries"}, {"identifier": "other"})
    assert run() == first and any("Shopping" in row for row in first)
    assert not list(tmp_path.glob("progress-inputs/ledger-*"))


def test_observation_counts_survive_a_write(make_transactions, as_of, tmp_path):
    from ledger_spark.operators.lifecycle import apply_fallback

    seen = Observation()
    apply_fallback(make_transactions({}, {}), as_of, seen).write.parquet(str(tmp_path / "t"))
    assert seen.get["affected"] == 2
