from pyspark.sql import Observation

from ledger_spark.operators.learning import (
    learn_all_rules,
    learn_merchant_rules,
    learn_pattern_rules,
    learn_single_merchant_rules,
    learn_transaction_rules,
)
from ledger_spark.sources import fixtures
from ledger_spark.sources.staging import Staging

from .conftest import by_id


def bulk(n, merchant="m", l2="Medical", **more):
    row = {"merchant_name_cleaned": merchant, "category_l1": "Expense", "category_l2": l2,
           "categorization_method": "llm-bulk-merchant-based", **more}
    return [row] * n


def single(**more):
    return {"merchant_name_cleaned": "m", "description_cleaned": "d", "category_l1": "Expense",
            "category_l2": "Medical", "categorization_method": "llm-transaction-based", "llm_confidence_score": 9, **more}


def key_of(frame, *columns):
    return sorted(tuple(r[c] for c in columns) for r in frame.collect())


def test_groups_become_rules(make_transactions, make_rules, as_of):
    rows = make_transactions(
        *bulk(1, "one"), *bulk(2, "two"), *bulk(3, "three", is_recurring=True), *bulk(3, "mixed", is_recurring=True),
        *bulk(1, "mixed"), *bulk(16, "many"), *bulk(5, ""), *bulk(5, "m", categorization_method="fallback"),
    )
    learned = learn_merchant_rules(rows, make_rules(), as_of)
    assert key_of(learned, "identifier", "confidence_score", "is_recurring_rule", "is_active") == [
        ("many", 81, False, True), ("mixed", 50, False, True), ("three", 50, True, True), ("two", 0, False, True),
    ]
    strict = learn_merchant_rules(rows, make_rules(), as_of, min_score=50)
    assert "two" not in {r.identifier for r in strict.collect()}


def test_competing_labels_and_better_scores(make_transactions, make_rules, as_of):
    rows = make_transactions(*bulk(5), *bulk(3, l2="Groceries"), *bulk(5, "kept"), *bulk(4, persona_type="P"))
    rules = make_rules(
        {"identifier": "m", "confidence_score": 59}, {"identifier": "m", "confidence_score": 58, "category_l2": "Travel"},
        {"identifier": "kept", "confidence_score": 60},
    )
    seen = (Observation(), Observation())
    learned = learn_merchant_rules(rows, rules, as_of, observations=seen)
    assert key_of(learned, "identifier", "category_l2", "confidence_score") == [
        ("kept", "Shopping", 60), ("m", "Medical", 50), ("m", "Medical", 60), ("m", "Medical", 60),
    ]
    assert (seen[0].get["affected"], seen[1].get["affected"]) == (2, 1)


def test_patterns_use_forty_characters(make_transactions, make_rules, as_of):
    text = "y" * 45
    rows = make_transactions(
        *bulk(3, description_cleaned=text, categorization_method="llm-bulk-pattern-based"),
        *bulk(2, description_cleaned="short", categorization_method="llm-bulk-pattern-based"),
    )
    learned = learn_pattern_rules(rows, make_rules(), as_of)
    assert key_of(learned, "identifier", "rule_type", "confidence_score") == [("y" * 40, "pattern", 50)]


def test_single_rows(make_transactions, make_rules, as_of):
    rows = make_transactions(
        single(is_recurring=True), single(is_recurring=False), single(category_l2="Groceries"),
        single(llm_confidence_score=8, description_cleaned="weak"), single(description_cleaned="known"),
        single(description_cleaned=""),
    )
    rules = make_rules({"identifier": "known", "rule_type": "transaction", "confidence_score": 1})
    learned = learn_transaction_rules(rows, rules, as_of)
    assert key_of(learned, "identifier", "category_l2", "confidence_score") == [
        ("d", "Groceries", 95), ("d", "Medical", 95), ("known", "Shopping", 1),
    ]
    flags = by_id(learned.filter("identifier = 'd'"), "is_recurring_rule", key="category_l2")
    assert flags == {"Medical": True, "Groceries": None}
    ids = [r.rule_id for r in learned.collect()]
    assert len(set(ids)) == 3 and set(ids) == {r.rule_id for r in learn_transaction_rules(rows, rules, as_of).collect()}
    assert key_of(learn_single_merchant_rules(rows, rules, as_of), "identifier", "rule_type") == [
        ("known", "transaction"), ("m", "merchant"), ("m", "merchant"),
    ]


def test_parts_see_each_other(spark, make_transactions, make_rules, as_of):
    pattern = bulk(3, description_cleaned="p", categorization_method="llm-bulk-pattern-based", merchant="x")
    rows = make_transactions(*bulk(2), single(), *pattern)
    affected: dict[str, int] = {}
    staged = learn_all_rules(rows, make_rules(), as_of, staging=Staging(spark), affected=affected)
    assert key_of(staged, "rule_type", "identifier") == [("merchant", "m"), ("transaction", "d")]
    assert affected == {"learn-merchant": 1, "learn-transaction": 1, "learn-single-merchant": 0}
    with_patterns = learn_all_rules(rows, make_rules(), as_of, include_patterns=True)
    assert ("pattern", "p") in key_of(with_patterns, "rule_type", "identifier")


def test_group_comes_before_single_rows_of_its_key(make_transactions, make_rules, as_of):
    """Both teach merchant m: the group's rule is there first. In a key without enough rows the single ones count."""
    rows = make_transactions(*bulk(2), single(category_l2="Groceries"), *bulk(1, "few"), single(merchant_name_cleaned="few"))
    learned = learn_all_rules(rows, make_rules(), as_of)
    merchants = learned.filter("rule_type = 'merchant'")
    assert key_of(merchants, "identifier", "category_l2", "confidence_score") == [("few", "Medical", 95), ("m", "Medical", 0)]


def test_parts_in_one_pass_equal_parts_in_turn(spark, small_folder, as_of):
    rows, rules = fixtures.transactions(spark, small_folder), fixtures.rules(spark, small_folder)
    in_turn = learn_merchant_rules(rows, rules, as_of)
    in_turn = learn_transaction_rules(rows, learn_pattern_rules(rows, in_turn, as_of), as_of)
    in_turn = learn_single_merchant_rules(rows, in_turn, as_of)
    affected: dict[str, int] = {}
    staged = learn_all_rules(rows, rules, as_of, include_patterns=True, staging=Staging(spark), affected=affected)
    for frame in (learn_all_rules(rows, rules, as_of, include_patterns=True), staged):
        assert sorted(map(str, frame.collect())) == sorted(map(str, in_turn.collect()))
    assert sum(affected.values()) > 0 and set(affected) == {"learn-merchant", "learn-pattern", "learn-transaction", "learn-single-merchant"}


def test_learning_scans_each_table_once(spark, small_folder, as_of):
    rows, rules = fixtures.transactions(spark, small_folder), fixtures.rules(spark, small_folder)
    plan = learn_all_rules(rows, rules, as_of, include_patterns=True)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert plan.count("FullOuter") == 1 and "LeftAnti" not in plan and "LeftOuter" not in plan
