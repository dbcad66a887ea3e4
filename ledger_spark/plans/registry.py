"""Registered queries: each operator over the derived tables of a test folder.

Results are flattened to strings, integers and booleans so that they can be compared
with an independent SQL engine.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean_description, clean_description_simple, clean_merchant, confidence_score
from ..operators import batches, decisions, enrichment, learning, lifecycle, quality, recurring
from ..operators import rules as engine
from ..operators.cleansing import cleanse_transactions
from ..schema import RULE_KEY, TRANSACTIONS_SCHEMA, add_missing_columns, prepare_rules_schema
from ..sources import fixtures
from ..sources.ingest import ingest_json
from ..sources.staging import Staging
from .adhoc import run_query
from .workflows import Labellers, WorkflowResult, run_categorization, run_recurring

Query = Callable[[SparkSession, str], DataFrame]

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
SCHEDULE_MONTHS = 12
AS_OF = fixtures.as_of


def ts(column: str) -> Column:
    return F.date_format(F.col(column).cast("timestamp"), TS_FORMAT)


def labels_of(frame: DataFrame) -> DataFrame:
    """The columns labelling writes."""
    return frame.select(
        "transaction_id", "category_l1", "category_l2", "is_recurring", "categorization_method",
        "llm_confidence_score", "rule_id", ts("categorization_update_timestamp").alias("updated_at"),
    )


def rules_of(frame: DataFrame) -> DataFrame:
    return frame.select(
        "rule_id", "rule_type", "identifier", "transaction_type", "persona_type", "category_l1", "category_l2",
        "is_recurring_rule", "confidence_score", "is_active",
        ts("created_timestamp").alias("created_at"), ts("last_updated_timestamp").alias("updated_at"),
    )


def joined(array: str, parts: Callable[[Column], list[Column]]) -> Column:
    """An array of structs as one string; NULL fields print as '?'."""
    item = lambda s: F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("?")) for p in parts(s)])
    return F.array_join(F.transform(array, item), ";")


def cents(column: Column) -> Column:
    return F.round(column * 100).cast("bigint")


# --- deterministic stand-ins for a labeller: the decision follows from the group itself ---


def _label(direction: Column, number: Column) -> list[Column]:
    l1 = F.when(direction == "Credit", "Income").otherwise("Expense")
    l2 = F.when(direction == "Credit", F.when(number % 2 == 0, "Refund").otherwise("Payroll")).otherwise(
        F.when(number % 3 == 0, "Groceries").when(number % 3 == 1, "Travel & Vacation").otherwise("Medical")
    )
    return [l1.alias("category_l1"), l2.alias("category_l2")]


def _payload(batch: DataFrame, *fields: Column | str) -> DataFrame:
    """One payload per group: a fenced JSON list with a single decision."""
    body = F.to_json(F.array(F.struct(*fields)), {"ignoreNullFields": "false"})
    return batch.select(F.concat(F.lit("Here you are:\n```json\n"), body, F.lit("\n```")).alias("payload"))


def label_merchants(batch: DataFrame) -> DataFrame:
    size = F.length("merchant_name_cleaned")
    return _payload(batch.filter(size % 4 != 1), *batches.MERCHANT_GROUP, *_label(F.col("transaction_type"), size))


def label_patterns(batch: DataFrame) -> DataFrame:
    size = F.length("description_prefix")
    return _payload(batch.filter(size % 4 != 2), *batches.PATTERN_GROUP, *_label(F.col("transaction_type"), size))


def _number() -> Column:
    return F.substring("transaction_id", 5, 20).cast("bigint")


def label_transactions(batch: DataFrame) -> DataFrame:
    n = _number()
    return _payload(
        batch.filter(n % 3 != 0), "transaction_id", *_label(F.col("transaction_type"), n),
        (n % 10 + 1).alias("llm_confidence_score"),
    )


def label_recurring(batch: DataFrame) -> DataFrame:
    return _payload(
        batch.filter(F.col("transaction_count") % 3 != 0), "merchant_name_cleaned", "transaction_type",
        F.col("has_recurring_keywords").alias("is_recurring"),
    )


def decided(payloads: DataFrame, validate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Validated decisions, written so that the labeller is asked once."""
    return Staging(payloads.sparkSession).table(validate(decisions.parse_decisions(payloads)), "decisions")


def row_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """One payload per transaction, in all shapes a labeller's answer takes."""
    n, row = _number(), F.col("transaction_id")
    score = F.element_at(
        F.array(*[F.lit(s) for s in ("9", '"9"', "9.7", "true", "null", '"9.5"', '"high"', '" 8 "', "-3")]),
        (n % 9 + 1).cast("int"),
    )
    l2 = F.element_at(
        F.array(*[F.lit(s) for s in ("Groceries", "Shopping", "groceries", "Payroll", "Medical")]),
        (n % 5 + 1).cast("int"),
    )
    one = F.concat(
        F.lit('{"transaction_id": "'), row, F.lit('", "category_l1": "Expense", "category_l2": "'), l2,
        F.lit('", "llm_confidence_score": '), score, F.lit("}"),
    )
    persona = F.when(n % 3 == 0, '"persona_type": null, ').when(n % 3 == 1, '"persona_type": "HOUSEHOLD", ').otherwise("")
    bulk = F.concat(
        F.lit('{"merchant_name_cleaned": "m'), _text(n % 50), F.lit('", "transaction_type": "Debit", '), persona,
        F.lit('"category_l1": "Expense", "category_l2": "'), l2, F.lit('"}'),
    )
    payload = (
        F.when(n % 6 == 0, F.concat(F.lit("["), one, F.lit(', 5, "x"]')))
        .when(n % 6 == 1, F.concat(F.lit("Sure!\n```json\n["), one, F.lit(", "), bulk, F.lit("]\n```\nDone.")))
        .when(n % 6 == 2, one)
        .when(n % 6 == 3, F.concat(F.lit("["), one, F.lit(", {")))
        .when(n % 6 == 4, F.concat(F.lit("[{}, "), bulk, F.lit("]")))
        .otherwise(F.concat(F.lit(" [ ["), one, F.lit("], "), one, F.lit(" ] ")))
    )
    return fixtures.transactions_raw(spark, folder).select("transaction_id", payload.alias("payload"))


def loose_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads that strict JSON refuses: repeated keys, NaN and Infinity, an end that is missing."""
    n, row = _number(), F.concat(F.lit('{"transaction_id": "'), F.col("transaction_id"), F.lit('", "category_l2": '))
    payload = (
        F.when(n % 4 == 0, F.concat(F.lit("["), row, F.lit('"Groceries", "category_l1": "Income", "llm_confidence_score": 9, "category_l1": "Expense"}]')))
        .when(n % 4 == 1, F.concat(
            F.lit("["), row, F.lit('"Shopping", "category_l1": "Expense", "llm_confidence_score": NaN}, 5, "x", '),
            row, F.lit('"Medical", "category_l1": "Expense", "llm_confidence_score": 7}]'),
        ))
        .when(n % 4 == 2, F.concat(
            F.lit("Sure.\n```json\n["), row,
            F.lit('null, "category_l1": "Expense", "llm_confidence_score": 8, "note": -Infinity, "category_l2": "Pharmacy", "llm_confidence_score": "6"}]\n```'),
        ))
        .otherwise(F.concat(F.lit("["), row, F.lit('"Groceries", "category_l1": "Expense", "llm_confidence_score": NaN}, {')))
    )
    return fixtures.transactions_raw(spark, folder).select(payload.alias("payload"))


def answer_conflicts(batch: DataFrame) -> DataFrame:
    """A stand-in that keeps the rule with the largest id of each key and answers rule by rule."""
    key = [F.coalesce(c, F.lit("")).alias(c) for c in RULE_KEY]
    kept = batch.groupBy(*key).agg(F.max("rule_id").alias("keep")).withColumnsRenamed({c: f"k_{c}" for c in RULE_KEY})
    same = reduce(and_, [F.coalesce(c, F.lit("")) == F.col(f"k_{c}") for c in RULE_KEY])
    others = batch.join(kept, same).filter("rule_id <> keep")
    body = F.to_json(F.struct(F.col("keep").alias("rule_to_keep"), F.array("rule_id").alias("rules_to_deactivate")))
    return others.select(F.when(F.length("rule_id") % 2 == 0, body).otherwise(F.concat(F.lit("```json\n"), body, F.lit("\n```"))).alias("payload"))


def _text(column: Column) -> Column:
    return column.cast("string")


# --- queries ---


def _on_transactions(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(fixtures.transactions(spark, folder))


def _on_rules(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rules_of(build(fixtures.rules(spark, folder)))


def _on_both(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(fixtures.transactions(spark, folder), fixtures.rules(spark, folder))


def _on_incoming(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(fixtures.incoming(spark, folder))


def dq_inconsistent_recurring(t: DataFrame) -> DataFrame:
    return quality.inconsistent_recurring(t).withColumn(
        "categories_assigned", F.array_join("categories_assigned", ";")
    )


def adhoc_query(t: DataFrame, r: DataFrame) -> DataFrame:
    sql = """
        WITH spending AS (
            SELECT merchant_name_cleaned, CAST(SUM(CAST(ROUND(ABS(amount) * 100) AS BIGINT)) AS BIGINT) AS cents
            FROM transactions WHERE transaction_type = :direction GROUP BY merchant_name_cleaned)
        SELECT s.merchant_name_cleaned, s.cents, COUNT(r.rule_id) AS n_rules
        FROM spending s LEFT JOIN rules r ON r.identifier = s.merchant_name_cleaned AND r.rule_type = 'merchant'
        GROUP BY s.merchant_name_cleaned, s.cents"""
    return run_query(t.sparkSession, sql, {"transactions": t, "rules": r}, {"direction": "Debit"})


def rules_without_state(spark: SparkSession, folder: str) -> DataFrame:
    """Rules as they are before the schema is prepared: some have an active flag, some none."""
    rules = fixtures.rules(spark, folder)
    return rules.withColumn("is_active", F.when(F.length("identifier") % 2 == 0, F.col("is_active")))


def cleanse_query(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the rows come in cleansed by the ingest variant and keep that text."""
    n = _number()
    rows = fixtures.transactions_unlabelled(spark, folder).withColumns(
        {
            "description_cleaned": F.when(n % 2 == 0, clean_description_simple(F.col("description_raw"))),
            "merchant_name_cleaned": F.when(n % 4 == 0, F.lower("merchant_name_raw")),
        }
    )
    return cleanse_transactions(rows).select("transaction_id", "description_cleaned", "merchant_name_cleaned")


def clean_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Description cleansing over whole documents as well as over bank descriptions."""
    raw = fixtures.transactions_raw(spark, folder).select(
        F.col("transaction_id").alias("id"), F.col("description_raw").alias("raw")
    )
    documents = fixtures.read_table(spark, folder, "documents").select(
        F.concat(F.lit("DOC-"), _text(F.col("doc_id"))).alias("id"), F.col("text").alias("raw")
    )
    return raw.unionByName(documents)


def match_rules_query(t: DataFrame, r: DataFrame) -> DataFrame:
    return engine.match_rules(t, r).select(
        "transaction_id", "rule_id", "rule_type", "category_l1", "category_l2", "persona_rank", "confidence_score",
        ts("last_updated_timestamp").alias("rule_updated_at"),
    )


def _on_many_patterns(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(fixtures.transactions(spark, folder), fixtures.rules_with_patterns(spark, folder))


def rule_conflicts_query(spark: SparkSession, folder: str) -> DataFrame:
    return engine.rule_conflicts(fixtures.rules(spark, folder)).withColumn(
        "last_updated_timestamp", ts("last_updated_timestamp")
    )


def deactivate_query(r: DataFrame) -> DataFrame:
    return engine.deactivate_rules(r, r.filter(F.length("rule_id") % 3 == 0), AS_OF())


def user_rules(spark: SparkSession, folder: str) -> DataFrame:
    """A user rule for every part name; some replace known rules, some names are not lower case."""
    names = fixtures.read_table(spark, folder, "part").select("p_name").distinct()
    size = F.length("p_name")
    return names.select(
        F.when(size % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("identifier"),
        F.when(size % 3 == 0, "Pattern").otherwise("merchant").alias("rule_type"),
        F.lit("Expense").alias("category_l1"),
        F.when(size % 5 == 0, "Not A Label").otherwise("Entertainment").alias("category_l2"),
        F.when(size % 4 == 0, "All").otherwise("Debit").alias("transaction_type"),
        (size % 2 == 1).alias("is_recurring_rule"),
        F.when(size % 7 == 0, "HOUSEHOLD").alias("persona_type"),
    )


def upsert_query(spark: SparkSession, folder: str) -> DataFrame:
    return rules_of(
        engine.upsert_user_rules(
            fixtures.rules(spark, folder), user_rules(spark, folder), AS_OF(), on_invalid="skip"
        )
    )


def answered_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    rules = fixtures.rules(spark, folder)
    answers = decisions.parse_conflict_answers(answer_conflicts(engine.rule_conflicts(rules)))
    return rules_of(engine.deactivate_rules(rules, answers, AS_OF()))


def checked_user_rules(spark: SparkSession, folder: str) -> DataFrame:
    checked = engine.check_user_rules(user_rules(spark, folder))
    return checked.select("identifier", "rule_type", "transaction_type", "category_l2", "problem")


def confidence_query(t: DataFrame) -> DataFrame:
    groups = t.groupBy("merchant_name_cleaned", "persona_type").agg(F.count("transaction_id").alias("n"))
    return groups.withColumn("score", confidence_score(F.col("n")))


def intervals_query(t: DataFrame) -> DataFrame:
    return recurring.transaction_intervals(t).select(
        "transaction_id", "merchant_name_cleaned", "transaction_type", "days_since_last_txn"
    )


def candidates_query(t: DataFrame) -> DataFrame:
    return recurring.recurring_candidates(t, None, Staging(t.sparkSession)).select(
        "merchant_name_cleaned",
        "transaction_type",
        "transaction_count",
        joined("transaction_intervals_days", lambda s: [s["days"], s["n"]]).alias("intervals"),
        "has_recurring_keywords",
        F.round("stddev_amount", 4).alias("stddev_amount"),
        cents(F.col("avg_amount") * F.col("transaction_count")).alias("total_cents"),
        joined(
            "example_transactions",
            lambda s: [s["description_cleaned"], cents(s["amount"]), F.date_format(s["transaction_date"], TS_FORMAT)],
        ).alias("examples"),
    )


def flag_query(t: DataFrame) -> DataFrame:
    candidates = recurring.recurring_candidates(t, None, Staging(t.sparkSession))
    flags = decided(label_recurring(candidates), decisions.validate_recurring_decisions)
    return labels_of(recurring.flag_recurring(t, flags))


def merchant_batch_query(t: DataFrame) -> DataFrame:
    return batches.merchant_batch(t).withColumn(
        "example_transactions",
        joined(
            "example_transactions",
            lambda s: [s["description_cleaned"], cents(s["amount"]), s["channel"], s["is_recurring"]],
        ),
    )


def pattern_batch_query(t: DataFrame) -> DataFrame:
    return batches.pattern_batch(t).withColumn(
        "example_transactions",
        joined(
            "example_transactions",
            lambda s: [s["description_cleaned"], s["merchant_name_cleaned"], cents(s["amount"]), s["is_recurring"]],
        ),
    )


def merchant_decisions(t: DataFrame) -> DataFrame:
    batch = batches.top_merchant_groups(t, batch_size=None)
    return decided(label_merchants(batch), decisions.validate_merchant_decisions)


def pattern_decisions(t: DataFrame) -> DataFrame:
    batch = batches.top_pattern_groups(t, batch_size=None).filter(F.col("channel").isNotNull())
    return decided(label_patterns(batch), decisions.validate_pattern_decisions)


def transaction_decisions(t: DataFrame) -> DataFrame:
    batch = batches.transaction_batch(t, batch_size=None)
    return decided(label_transactions(batch), decisions.validate_transaction_decisions)


def parse_query(spark: SparkSession, folder: str) -> DataFrame:
    parsed = decisions.parse_decisions(row_payloads(spark, folder))
    return parsed.select(
        "transaction_id",
        F.col("position").cast("bigint").alias("position"),
        F.try_variant_get("decision", "$.transaction_id", "string").alias("decided_id"),
        F.try_variant_get("decision", "$.merchant_name_cleaned", "string").alias("decided_merchant"),
        F.try_variant_get("decision", "$.category_l2", "string").alias("decided_l2"),
    )


def valid_categories_query(t: DataFrame) -> DataFrame:
    return decisions.valid_categories(t).select("transaction_id", "category_l1", "category_l2")


def categorize(spark: SparkSession, folder: str) -> WorkflowResult:
    """The whole workflow over loaded rows."""
    return run_categorization(
        fixtures.transactions_unlabelled(spark, folder), fixtures.rules(spark, folder), AS_OF(),
        Labellers(label_merchants, label_patterns, label_transactions),
    )


def full_categorization(spark: SparkSession, folder: str) -> DataFrame:
    return labels_of(categorize(spark, folder).transactions)


def full_categorization_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules_of(categorize(spark, folder).rules)


def recurring_workflow(spark: SparkSession, folder: str) -> DataFrame:
    return labels_of(run_recurring(fixtures.transactions(spark, folder), AS_OF(), label_recurring).transactions)


def ingest_query(spark: SparkSession, folder: str) -> DataFrame:
    """Write the transactions as JSON lines, load them with the fixed schema, append them once more."""
    staging = Staging(spark)
    rows = fixtures.transactions(spark, folder).select(*TRANSACTIONS_SCHEMA.names)
    source, table = staging.path("json"), staging.path("table")
    rows.write.json(source)
    ingest_json(spark, source, table, recreate=True)
    loaded = ingest_json(spark, source, table)
    return loaded.select(
        "transaction_id", "account_id", "persona_type", ts("transaction_date").alias("transaction_date"),
        "transaction_type", cents(F.col("amount")).alias("amount_cents"), "is_recurring", "description_raw",
        "merchant_name_cleaned", "category_l1", "category_l2", "channel",
    )


def schedule_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = enrichment.expand_schedule(fixtures.bills(spark, folder), SCHEDULE_MONTHS, AS_OF())
    return rows.select(
        "account_id", "consumer_name", "category_l1", "category_l2", ts("transaction_date").alias("transaction_date"),
        "transaction_type", cents(F.col("amount")).alias("amount_cents"), "is_recurring", "description_raw",
        "description_cleaned", "merchant_name_raw", "merchant_name_cleaned", "channel",
    )


def season_query(t: DataFrame) -> DataFrame:
    return enrichment.season_tag(t).select("transaction_id", "season")


def queries() -> dict[str, Query]:
    return {
        # audit, reset, ad-hoc, schema
        "dq_status_by_persona": _on_transactions(quality.status_by_persona),
        "dq_missing_labels": _on_transactions(quality.missing_labels),
        "dq_direction_mismatch": _on_transactions(
            lambda t: quality.direction_mismatch(t).withColumn("amount", cents(F.col("amount")))
        ),
        "dq_inconsistent_recurring": _on_transactions(dq_inconsistent_recurring),
        "dq_report_sizes": lambda s, d: quality.report_sizes(fixtures.transactions(s, d), Staging(s)),
        "reset_labels": _on_transactions(
            lambda t: lifecycle.reset_labels(t, confirm=True).select(
                "transaction_id", "description_cleaned", "merchant_name_cleaned", "category_l1", "category_l2",
                "is_recurring", "categorization_method", "llm_confidence_score", "rule_id",
            )
        ),
        "adhoc_query": _on_both(adhoc_query),
        "prepare_rules_schema": lambda s, d: rules_of(prepare_rules_schema(rules_without_state(s, d))),
        "prepare_transactions_schema": lambda s, d: add_missing_columns(
            fixtures.transactions_raw(s, d), {"llm_confidence_score": "bigint", "channel": "string"}
        ).select("transaction_id", "channel", "llm_confidence_score"),
        # cleansing
        "clean_description": lambda s, d: clean_texts(s, d).select(
            "id", clean_description(F.col("raw")).alias("cleaned")
        ),
        "clean_merchant": lambda s, d: fixtures.transactions_raw(s, d).select(
            "transaction_id", clean_merchant(F.col("merchant_name_raw")).alias("merchant_name_cleaned")
        ),
        "cleanse_transactions": cleanse_query,
        "clean_description_simple": lambda s, d: clean_texts(s, d).select(
            "id", clean_description_simple(F.col("raw")).alias("cleaned")
        ),
        # rule engine
        "match_rules": _on_both(match_rules_query),
        "match_many_patterns": _on_many_patterns(match_rules_query),
        "apply_many_patterns": _on_many_patterns(lambda t, r: labels_of(engine.apply_rules(t, r, AS_OF()))),
        "backfill_many_patterns": _on_many_patterns(lambda t, r: rules_of(learning.backfill_rule_scores(t, r))),
        "apply_rules": _on_both(lambda t, r: labels_of(engine.apply_rules(t, r, AS_OF()))),
        "rule_hits_by_type": _on_both(lambda t, r: engine.rule_hits_by_type(engine.apply_rules(t, r, AS_OF()))),
        "rule_conflicts": rule_conflicts_query,
        "resolve_rule_conflicts": _on_rules(lambda r: engine.resolve_rule_conflicts(r, AS_OF())),
        "deactivate_rules": _on_rules(deactivate_query),
        "answer_rule_conflicts": answered_conflicts,
        "check_user_rules": checked_user_rules,
        "upsert_user_rules": upsert_query,
        "confidence_score": _on_transactions(confidence_query),
        "learn_merchant_rules": _on_both(lambda t, r: rules_of(learning.learn_merchant_rules(t, r, AS_OF()))),
        "learn_pattern_rules": _on_both(lambda t, r: rules_of(learning.learn_pattern_rules(t, r, AS_OF()))),
        "learn_transaction_rules": _on_both(lambda t, r: rules_of(learning.learn_transaction_rules(t, r, AS_OF()))),
        "learn_single_merchant_rules": _on_both(
            lambda t, r: rules_of(learning.learn_single_merchant_rules(t, r, AS_OF()))
        ),
        "learn_all_rules": _on_both(
            lambda t, r: rules_of(learning.learn_all_rules(t, r, AS_OF(), include_patterns=True))
        ),
        "backfill_rule_scores": _on_both(lambda t, r: rules_of(learning.backfill_rule_scores(t, r))),
        # recurring payments
        "transaction_intervals": _on_transactions(intervals_query),
        "recurring_candidates": _on_transactions(candidates_query),
        "flag_recurring": _on_transactions(flag_query),
        "trusted_recurring_labels": _on_transactions(recurring.trusted_recurring_labels),
        "harmonize_recurring": _on_transactions(lambda t: labels_of(recurring.harmonize_recurring(t, AS_OF()))),
        # work batches
        "top_merchant_groups": _on_transactions(batches.top_merchant_groups),
        "merchant_batch": _on_transactions(merchant_batch_query),
        "top_pattern_groups": _on_transactions(batches.top_pattern_groups),
        "pattern_batch": _on_transactions(pattern_batch_query),
        "transaction_batch": _on_transactions(
            lambda t: batches.transaction_batch(t).withColumn("amount", cents(F.col("amount")))
        ),
        # decisions
        "parse_decisions": parse_query,
        "parse_loose_decisions": lambda s, d: decisions.validate_transaction_decisions(
            decisions.parse_decisions(loose_payloads(s, d))
        ),
        "unparsable_payloads": lambda s, d: decisions.unparsable_payloads(loose_payloads(s, d).unionByName(
            row_payloads(s, d).select("payload")
        )),
        "valid_categories": _on_transactions(valid_categories_query),
        "validate_transaction_decisions": lambda s, d: decisions.validate_transaction_decisions(
            decisions.parse_decisions(row_payloads(s, d))
        ),
        "validate_bulk_decisions": lambda s, d: decisions.validate_merchant_decisions(
            decisions.parse_decisions(row_payloads(s, d))
        ),
        "apply_merchant_decisions": _on_transactions(
            lambda t: labels_of(decisions.apply_merchant_decisions(t, merchant_decisions(t), AS_OF()))
        ),
        "apply_pattern_decisions": _on_transactions(
            lambda t: labels_of(decisions.apply_pattern_decisions(t, pattern_decisions(t), AS_OF()))
        ),
        "apply_transaction_decisions": _on_transactions(
            lambda t: labels_of(decisions.apply_transaction_decisions(t, transaction_decisions(t), AS_OF()))
        ),
        "decision_summary": _on_transactions(lambda t: decisions.decision_summary(transaction_decisions(t))),
        "direction_violations": _on_transactions(
            lambda t: decisions.direction_violations(t).select(
                "transaction_id", "transaction_type", "category_l1", "category_l2"
            )
        ),
        # finishing
        "apply_fallback": _on_transactions(lambda t: labels_of(lifecycle.apply_fallback(t, AS_OF()))),
        "full_categorization": full_categorization,
        "full_categorization_rules": full_categorization_rules,
        "recurring_workflow": recurring_workflow,
        # ingest and enrichment
        "ingest_json": ingest_query,
        "derive_l1": _on_incoming(
            lambda i: enrichment.derive_l1(i).select("transaction_id", "category_l1", "category_l2")
        ),
        "normalize_direction": _on_incoming(
            lambda i: enrichment.normalize_direction(i).select(
                "transaction_id", "transaction_type", cents(F.col("amount")).alias("amount_cents")
            )
        ),
        "derive_channel": _on_incoming(lambda i: enrichment.derive_channel(i).select("transaction_id", "channel")),
        "drop_incomplete": _on_incoming(
            lambda i: enrichment.drop_incomplete(i).select(
                "transaction_id", "category_l2", "merchant_name_raw", "merchant_name_cleaned"
            )
        ),
        "count_incomplete": _on_incoming(enrichment.count_incomplete),
        "enrich_incoming": _on_incoming(
            lambda i: enrichment.enrich_incoming(i).select(
                "transaction_id", "category_l1", "category_l2", "transaction_type",
                cents(F.col("amount")).alias("amount_cents"), "channel", "description_cleaned",
            )
        ),
        "expand_schedule": schedule_query,
        "annotate_events": lambda s, d: enrichment.annotate_events(
            fixtures.consumer_months(s, d), fixtures.life_events(s, d)
        ),
        "season_tag": _on_transactions(season_query),
    }
