import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledger_spark.operators import decisions
from ledger_spark.operators.batches import MERCHANT_GROUP
from ledger_spark.operators.decisions import (
    apply_merchant_decisions,
    apply_pattern_decisions,
    apply_transaction_decisions,
    decision_summary,
    parse_conflict_answers,
    parse_decisions,
    unparsable_payloads,
    validate_bulk_decisions,
    validate_merchant_decisions,
    validate_recurring_decisions,
    validate_transaction_decisions,
)
from ledger_spark.schema import TAXONOMY, is_valid_category, taxonomy_frame

from .conftest import by_id

LABELS = '"category_l1": "Expense", "category_l2": "Medical"'


@pytest.fixture
def payloads(spark):
    return lambda *texts: spark.createDataFrame([(t,) for t in texts], "payload string")


@pytest.mark.parametrize(
    ("text", "rows"),
    [
        ('[{"a": 1}, 5, "x"]', 3),
        ('see\n```json\n[{"a": 1}]\n```\nbye ```json [1,2] ```', 1),
        ('```json [{"a": 1}]', 1),
        ('```\n[1]\n```', 0),
        ('{"a": 1}', 0),
        ("nope", 0),
        ("", 0),
        (None, 0),
        ("[]", 0),
        ('[{"a": 1}, {]', 0),
    ],
)
def test_parsing(payloads, text, rows):
    assert parse_decisions(payloads(text)).count() == rows


def test_unparsable_payloads(payloads):
    assert {r.payload for r in unparsable_payloads(payloads("[]", "x", '{"a": 1}', "[1]")).collect()} == {"x", '{"a": 1}'}


@pytest.mark.parametrize(
    ("score", "expected"),
    [("9", 9), ('"9"', 9), ("9.7", 9), ("true", 1), ('" 8 "', 8), ("-3.5", -3),
     ("null", None), ('"9.5"', None), ('"high"', None), ("[1]", None)],
)
def test_single_row_scores(payloads, score, expected):
    rows = payloads(f'[{{"transaction_id": "t", {LABELS}, "llm_confidence_score": {score}}}]')
    got = [r.llm_confidence_score for r in validate_transaction_decisions(parse_decisions(rows)).collect()]
    assert got == ([] if expected is None else [expected])


@pytest.mark.parametrize(
    "item",
    [
        f'{{"transaction_id": "", {LABELS}, "llm_confidence_score": 1}}',
        f'{{{LABELS}, "llm_confidence_score": 1}}',
        f'{{"transaction_id": "t", {LABELS}}}',
        '{"transaction_id": "t", "category_l1": "Expense", "category_l2": "medical", "llm_confidence_score": 1}',
        '{"transaction_id": "t", "category_l1": "Income", "category_l2": "Medical", "llm_confidence_score": 1}',
        '{"transaction_id": "t", "category_l1": "Expense", "category_l2": null, "llm_confidence_score": 1}',
        "[1]",
        "7",
    ],
)
def test_invalid_single_rows_are_dropped(payloads, item):
    assert validate_transaction_decisions(parse_decisions(payloads(f"[{item}]"))).count() == 0


def test_bulk_keys_must_be_present(payloads):
    key = '"merchant_name_cleaned": "m", "transaction_type": "Debit"'
    rows = payloads(
        f'[{{{key}, "persona_type": null, {LABELS}}}]', f'[{{{key}, {LABELS}}}]',
        f'[{{{key}, "persona_type": "P", "category_l1": "Nope", "category_l2": "Medical"}}]',
    )
    got = validate_bulk_decisions(parse_decisions(rows), MERCHANT_GROUP).collect()
    assert [tuple(r) for r in got] == [("m", "Debit", None, "Expense", "Medical")]


def test_recurring_needs_json_true(payloads):
    def item(flag, merchant='"m"'):
        return f'[{{"merchant_name_cleaned": {merchant}, "transaction_type": "Debit", "is_recurring": {flag}}}]'

    rows = payloads(item("true"), item('"true"'), item("1"), item("false"), item("null"), item("true", '""'))
    assert [tuple(r) for r in validate_recurring_decisions(parse_decisions(rows)).collect()] == [("m", "Debit")]


def test_conflict_answers(payloads):
    rows = payloads('```json\n{"rule_to_keep": "a", "rules_to_deactivate": ["b", "c"]}\n```',
                    '{"rules_to_deactivate": "d"}', "oops", '{"rule_to_keep": "e"}')
    assert {r.rule_id for r in parse_conflict_answers(rows).collect()} == {"b", "c"}


def test_taxonomy(spark):
    pairs = taxonomy_frame(spark)
    assert pairs.count() == sum(map(len, TAXONOMY.values())) == 26
    assert pairs.filter(is_valid_category(F.col("category_l1"), F.col("category_l2"))).count() == 26
    odd = spark.createDataFrame([("Income", "Medical"), ("expense", "Medical"), (None, None)], "category_l1 string, category_l2 string")
    assert odd.filter(is_valid_category(F.col("category_l1"), F.col("category_l2"))).count() == 0


def decide(spark, *rows):
    ddl = "merchant_name_cleaned string, transaction_type string, persona_type string, category_l1 string, category_l2 string"
    return spark.createDataFrame(list(rows), ddl)


def test_merchant_decisions(spark, make_transactions, as_of):
    rows = make_transactions(
        {"merchant_name_cleaned": "m"}, {"merchant_name_cleaned": "m", "persona_type": "P"},
        {"merchant_name_cleaned": "m", "category_l1": "Transfer"},
        {"merchant_name_cleaned": "m", "category_l1": "Income", "category_l2": "Refund"},
    )
    seen = Observation()
    one = decide(spark, ("m", "Debit", None, "Expense", "Medical"))
    changed = apply_merchant_decisions(rows, one, as_of, observation=seen)
    assert list(by_id(changed, "category_l2", "categorization_method").values()) == [
        ("Medical", "llm-bulk-merchant-based"), (None, None), ("Medical", "llm-bulk-merchant-based"), ("Refund", None),
    ]
    assert seen.get["affected"] == 2
    two = one.union(decide(spark, ("m", "Debit", None, "Expense", "Groceries")))
    with pytest.raises(Exception, match="more than one source row"):
        apply_merchant_decisions(rows, two, as_of).collect()
    best = by_id(apply_merchant_decisions(rows, two, as_of, on_duplicate="best"), "category_l2")
    assert best["T0000"] == "Groceries"
    wrong = decide(spark, ("m", "Debit", None, "Income", "Refund"))
    strict = apply_merchant_decisions(rows, wrong, as_of, enforce_direction=True)
    assert by_id(strict, "category_l2")["T0000"] is None


def test_pattern_decisions_use_the_prefix(spark, make_transactions, as_of):
    prefix = "x" * 40
    rows = make_transactions(
        {"description_cleaned": prefix + "1", "channel": "ACH"}, {"description_cleaned": prefix + "2", "channel": None},
        {"description_cleaned": "x", "channel": "ACH"},
    )
    decision = spark.createDataFrame(
        [(prefix, "Debit", "ACH", None, "Expense", "Medical")],
        "description_prefix string, transaction_type string, channel string, persona_type string, "
        "category_l1 string, category_l2 string",
    )
    changed = apply_pattern_decisions(rows, decision, as_of)
    assert list(by_id(changed, "category_l2").values()) == ["Medical", None, None]
    assert changed.columns == rows.columns


def test_transaction_decisions(spark, make_transactions, as_of, payloads):
    rows = make_transactions({}, {"category_l1": "Income", "category_l2": "Refund"})
    found = validate_transaction_decisions(parse_decisions(payloads(
        f'[{{"transaction_id": "T0000", {LABELS}, "llm_confidence_score": 9}},'
        f' {{"transaction_id": "T0001", {LABELS}, "llm_confidence_score": 9}}]'
    )))
    changed = apply_transaction_decisions(rows, found, as_of)
    assert list(by_id(changed, "category_l2", "llm_confidence_score").values()) == [("Medical", 9), ("Refund", None)]
    assert [tuple(r) for r in decision_summary(found).collect()] == [("Expense", "Medical", 2)]


def test_merchant_validation_uses_the_group_key(payloads):
    rows = payloads('[{"merchant_name_cleaned": "m"}]')
    assert validate_merchant_decisions(parse_decisions(rows)).columns == [*MERCHANT_GROUP, "category_l1", "category_l2"]


def test_json_that_is_refused_at_first(spark):
    texts = [
        '[{"a": NaN, "b": "x"}, {"a": 1, "a": "two", "c": null}, 5, "s", [1]]', '[{"a": 1.50, "b": true, "a": null}]', '{"a": 1, "a": 2}',
        '[{"a": NaN}, {', "['x']", '[{"a": nan}]', "[NaN] x", '```json\n[{"a": -Infinity}]\n```',
    ]
    payloads = spark.createDataFrame(list(enumerate(texts)), "n int, payload string")
    parsed = decisions.parse_decisions(payloads).select("n", "position", F.to_json("decision").alias("j")).collect()
    assert sorted(map(tuple, parsed), key=lambda r: r[:2]) == [
        (0, 0, '{"a":"NaN","b":"x"}'), (0, 1, '{"a":"two","c":null}'), (0, 2, "5"), (0, 3, None), (0, 4, "[1]"),
        (1, 0, '{"a":null,"b":true}'), (7, 0, '{"a":"-Infinity"}'),
    ]
    assert {r.n for r in decisions.unparsable_payloads(payloads).collect()} == {2, 3, 4, 5, 6}
