import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledger_spark.operators import matching
from ledger_spark.operators.learning import backfill_rule_scores, count_rule_matches
from ledger_spark.operators.rules import (
    apply_rules,
    check_user_rules,
    create_rule,
    deactivate_rules,
    match_rules,
    resolve_rule_conflicts,
    rule_conflicts,
    upsert_user_rules,
)
from ledger_spark.sources.staging import Staging

from .conftest import NOW, by_id

TEXT = st.one_of(st.none(), st.text(alphabet="ab é", max_size=9))
PERSONA = st.sampled_from([None, "P", "Q"])
DIRECTION = st.sampled_from(["Debit", "Credit", None])
TRANSACTION = st.fixed_dictionaries(
    {
        "merchant_name_cleaned": TEXT,
        "description_cleaned": TEXT,
        "persona_type": PERSONA,
        "transaction_type": DIRECTION,
        "category_l1": st.sampled_from([None, None, None, "Income"]),
        "is_recurring": st.sampled_from([None, True, False]),
    }
)
RULE = st.fixed_dictionaries(
    {
        "rule_type": st.sampled_from(["merchant", "pattern", "transaction", "other"]),
        "identifier": TEXT,
        "persona_type": PERSONA,
        "transaction_type": st.sampled_from(["Debit", "Credit", "All", None]),
        "confidence_score": st.sampled_from([None, 10, 20]),
        "last_updated_timestamp": st.sampled_from([None, NOW, NOW + dt.timedelta(days=1)]),
        "is_recurring_rule": st.sampled_from([None, True, False]),
        "is_active": st.sampled_from([True, True, True, False, None]),
    }
)


def applies(t, r, persona=True):
    """The definition of a match, row by row."""
    identifier, text, merchant = r["identifier"], t["description_cleaned"], t["merchant_name_cleaned"]
    if identifier is None or t["transaction_type"] is None or t["transaction_type"] != r["transaction_type"]:
        return False
    if persona and r["persona_type"] is not None and r["persona_type"] != t["persona_type"]:
        return False
    kind = r["rule_type"]
    return (
        (kind == "merchant" and merchant == identifier)
        or (kind == "transaction" and text == identifier)
        or (kind == "pattern" and text is not None and identifier in text)
    )


def rank(t, r):
    def descending(value):
        return (value is None, 0 if value is None else -value)

    updated = r["last_updated_timestamp"]
    return (
        1 if r["persona_type"] is not None and r["persona_type"] == t["persona_type"] else 2,
        descending(r["confidence_score"]),
        descending(None if updated is None else updated.timestamp()),
        r["rule_id"],
    )


SOME = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))


@SOME
@given(st.lists(TRANSACTION, min_size=5, max_size=30), st.lists(RULE, min_size=3, max_size=30),
       st.sampled_from([(200_000, 1 << 20), (0, 1 << 20), (200_000, 1)]))
def test_matching_equals_the_definition(make_transactions, make_rules, as_of, transactions, rules, limits):
    """With rules broadcast and shuffled, and with a filter so small that it lets everything pass."""
    transactions = [{**t, "transaction_id": f"T{i:04d}"} for i, t in enumerate(transactions)]
    rules = [{**r, "rule_id": f"R{i:04d}"} for i, r in enumerate(rules)]
    t_frame, r_frame = make_transactions(*transactions), make_rules(*rules)
    active = [r for r in rules if r["is_active"]]
    open_rows = [t for t in transactions if t["category_l1"] is None]

    before = matching.MAX_BROADCAST_ROWS, matching.MAX_FILTER_WORDS
    matching.MAX_BROADCAST_ROWS, matching.MAX_FILTER_WORDS = limits
    try:
        pairs = sorted((p.transaction_id, p.rule_id) for p in match_rules(t_frame, r_frame).collect())
        assert pairs == sorted((t["transaction_id"], r["rule_id"]) for t in open_rows for r in active if applies(t, r))

        seen = Observation()
        labelled = by_id(apply_rules(t_frame, r_frame, as_of, observation=seen), "rule_id", "is_recurring")
        counts = by_id(count_rule_matches(t_frame, r_frame), "transaction_count", key="rule_id")
    finally:
        matching.MAX_BROADCAST_ROWS, matching.MAX_FILTER_WORDS = before

    hits = 0
    for t in transactions:
        matched = [r for r in active if t["category_l1"] is None and applies(t, r)]
        best = min(matched, key=lambda r: rank(t, r)) if matched else None
        hits += best is not None
        flag = t["is_recurring"]
        if best and best["is_recurring_rule"] is not None:
            flag = best["is_recurring_rule"]
        assert labelled[t["transaction_id"]] == (best and best["rule_id"], flag)
    assert seen.get["affected"] == hits

    for r in rules:
        n = sum(applies(t, r, persona=False) for t in transactions if r["rule_type"] in ("merchant", "pattern"))
        assert counts.get(r["rule_id"], 0) == n


def test_a_shared_substring_alone_is_no_match(make_transactions, make_rules):
    """The substring lies in the text where the pattern would have to begin one character before the text."""
    rows = make_transactions({"description_cleaned": "red rod a0"}, {"description_cleaned": "xcold rod co17"})
    rules = make_rules({"identifier": "cold rod co17", "rule_type": "pattern"}, {"identifier": "d rod b", "rule_type": "pattern"})
    assert [(p.transaction_id, p.rule_id) for p in match_rules(rows, rules).collect()] == [("T0001", "R0000")]


def test_staged_winners_give_the_same_result(spark, make_transactions, make_rules, as_of):
    rows = make_transactions(*[{"merchant_name_cleaned": f"m{i % 3}"} for i in range(9)])
    rules = make_rules({"identifier": "m1"}, {"identifier": "m2", "transaction_type": "All"})
    plain = by_id(apply_rules(rows, rules, as_of), "rule_id")
    staged = by_id(apply_rules(rows, rules, as_of, staging=Staging(spark)), "rule_id")
    assert plain == staged == {f"T{i:04d}": "R0000" if i % 3 == 1 else None for i in range(9)}
    anything = by_id(apply_rules(rows, rules, as_of, all_matches_any=True), "rule_id")
    assert anything["T0002"] == "R0001"


def test_l2_missing_is_not_for_the_engine(make_transactions, make_rules, as_of):
    rows = make_transactions({"merchant_name_cleaned": "m", "category_l1": "Transfer"})
    assert by_id(apply_rules(rows, make_rules({"identifier": "m"}), as_of), "category_l1") == {"T0000": "Transfer"}


CONFLICT = [
    {"identifier": "a", "confidence_score": 60},
    {"identifier": "a", "category_l2": "Groceries", "confidence_score": 70},
    {"identifier": "a", "category_l2": "Groceries", "confidence_score": 10},
    {"identifier": "a", "category_l2": "Groceries", "persona_type": "P"},
    {"identifier": "a", "category_l2": "Medical", "is_active": False},
    {"identifier": "b", "category_l2": None},
    {"identifier": "b"},
    {"identifier": "c", "confidence_score": 1},
    {"identifier": "c", "confidence_score": 2},
]


def test_conflicts_and_their_resolution(make_rules, as_of):
    rules = make_rules(*CONFLICT)
    found = by_id(rule_conflicts(rules), "rule_to_keep", "n_labels", "n_rules", key="rule_id")
    assert found == {
        **dict.fromkeys(["R0000", "R0001", "R0002"], ("R0001", 2, 3)),
        **dict.fromkeys(["R0005", "R0006"], ("R0005", 2, 2)),
    }
    seen = Observation()
    active = by_id(resolve_rule_conflicts(rules, as_of, seen), "is_active", key="rule_id")
    assert [r for r, on in sorted(active.items()) if not on] == ["R0000", "R0002", "R0004", "R0006"]
    assert seen.get["affected"] == 3


def test_deactivation_ignores_unknown_and_repeated_ids(spark, make_rules, as_of):
    ids = spark.createDataFrame([("R0000",), ("R0000",), ("nope",)], "rule_id string")
    rules = deactivate_rules(make_rules({"identifier": "a"}, {"identifier": "b"}), ids, as_of)
    assert by_id(rules, "is_active", key="rule_id") == {"R0000": False, "R0001": True}


def test_user_rule_replaces_and_reactivates(spark, make_rules, as_of):
    rules = make_rules({"identifier": "t-mobile", "is_active": False}, {"identifier": "t-mobile", "persona_type": "P"})
    changed = create_rule(
        spark, rules, as_of, identifier="T-Mobile", rule_type="Merchant", category_l1="Expense",
        category_l2="Bills & Utilities", transaction_type="Debit",
    )
    got = by_id(changed, "category_l2", "confidence_score", "is_active", key="rule_id")
    assert got == {"R0000": ("Bills & Utilities", 99, True), "R0001": ("Shopping", 50, True)}


@pytest.mark.parametrize(
    "wrong", [{"rule_type": "transaction"}, {"transaction_type": "debit"}, {"category_l2": "Payroll"}]
)
def test_user_rule_validation(spark, make_rules, as_of, wrong):
    good = {"identifier": "x", "rule_type": "pattern", "category_l1": "Expense", "category_l2": "Medical",
            "transaction_type": "All"}
    with pytest.raises(ValueError):
        create_rule(spark, make_rules(), as_of, **{**good, **wrong})
    frame = spark.createDataFrame([{**good, **wrong}]).withColumns(
        {"is_recurring_rule": F.lit(None).cast("boolean"), "persona_type": F.lit(None).cast("string")}
    )
    assert check_user_rules(frame).first().problem
    assert upsert_user_rules(make_rules(), frame, as_of, on_invalid="skip").count() == 0
    with pytest.raises(Exception, match="in user rule"):
        upsert_user_rules(make_rules(), frame, as_of).collect()


def test_user_rules_normalized_and_duplicates_refused(spark, make_rules, as_of):
    frame = spark.createDataFrame(
        [("T-Mobile", "merchant"), ("Joe's  Bar", "pattern")], "identifier string, rule_type string"
    ).selectExpr("*", "'Expense' category_l1", "'Medical' category_l2", "'Debit' transaction_type",
                 "CAST(NULL AS boolean) is_recurring_rule", "CAST(NULL AS string) persona_type")
    made = upsert_user_rules(make_rules(), frame, as_of, normalize_identifier=True)
    assert {r.identifier for r in made.collect()} == {"tmobile", "joe s bar"}
    with pytest.raises(Exception, match="two user rules"):
        upsert_user_rules(make_rules(), frame.union(frame), as_of).collect()


def test_backfill(make_transactions, make_rules):
    rows = make_transactions(
        *[{"merchant_name_cleaned": "m", "description_cleaned": "o'hare m", "category_l1": "Income"}] * 5,
        {"merchant_name_cleaned": "m", "transaction_type": "Credit"},
    )
    rules = make_rules(
        {"identifier": "m"}, {"identifier": "o'hare", "rule_type": "pattern"}, {"identifier": "none"},
        {"identifier": "o'hare m", "rule_type": "transaction", "confidence_score": 95},
        {"identifier": "m", "persona_type": "P", "confidence_score": 99},
    )
    scores = by_id(backfill_rule_scores(rows, rules), "confidence_score", key="rule_id")
    assert scores == {"R0000": 60, "R0001": 60, "R0002": 0, "R0003": 95, "R0004": 60}
    kept = by_id(backfill_rule_scores(rows, rules, protect_user_rules=True), "confidence_score", key="rule_id")
    assert kept["R0004"] == 99
