import datetime as dt
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledger_spark.operators import recurring
from ledger_spark.operators.recurring import (
    expand_intervals,
    flag_recurring,
    harmonize_recurring,
    interval_histogram,
    recurring_candidates,
    transaction_intervals,
    trusted_recurring_labels,
)
from ledger_spark.sources.staging import Staging

from .conftest import by_id

START = dt.datetime(2024, 1, 1)
ROW = st.fixed_dictionaries(
    {
        "merchant_name_cleaned": st.sampled_from(["hot", "hot", "hot", "cold", "", None]),
        "transaction_type": st.sampled_from(["Debit", "Debit", "Debit", "Credit"]),
        "transaction_date": st.one_of(
            st.none(), st.integers(0, 24 * 9).map(lambda h: START + dt.timedelta(hours=h))
        ),
        "is_recurring": st.sampled_from([None, False, True]),
    }
)


def gaps_by_definition(rows):
    """Sort each merchant's rows by time and id, undated ones first, and look one row back."""
    groups = defaultdict(list)
    for r in rows:
        if r["merchant_name_cleaned"] and r["transaction_type"] == "Debit" and not r["is_recurring"]:
            groups[r["merchant_name_cleaned"]].append(r)
    gaps = {}
    for group in groups.values():
        group.sort(key=lambda r: (r["transaction_date"] is not None, r["transaction_date"] or START, r["transaction_id"]))
        for before, row in zip([None, *group], group):
            dates = [before and before["transaction_date"], row["transaction_date"]]
            gaps[row["transaction_id"]] = None if None in dates else (dates[1].date() - dates[0].date()).days
    return gaps


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=60))
def test_gaps_equal_the_definition(make_transactions, rows):
    rows = [{**r, "transaction_id": f"T{i:04d}"} for i, r in enumerate(rows)]
    frame = make_transactions(*rows)
    expected = gaps_by_definition(rows)
    assert by_id(transaction_intervals(frame), "days_since_last_txn") == expected
    merchants = {r["transaction_id"]: r["merchant_name_cleaned"] for r in rows}
    histogram = defaultdict(Counter)
    for row_id, gap in expected.items():
        if gap is not None:
            histogram[merchants[row_id]][gap] += 1
    found = by_id(interval_histogram(frame), "transaction_intervals_days", key="merchant_name_cleaned")
    assert {m: [(s.days, s.n) for s in steps] for m, steps in found.items()} == {
        m: sorted(c.items()) for m, c in histogram.items()
    }


def daily(merchant, n, **more):
    return [
        {"merchant_name_cleaned": merchant, "transaction_date": START + dt.timedelta(days=30 * i), "amount": -10.0, **more}
        for i in range(n)
    ]


@pytest.mark.parametrize("batch_size", [1, 5, None])
def test_candidates(spark, make_transactions, batch_size):
    rows = make_transactions(
        *daily("plain", 7), *daily("few", 4), *daily("sub", 5, description_cleaned="Monthly plan"),
        *daily("credit", 9, transaction_type="Credit"), *daily("known", 9, is_recurring=True),
    )
    found = recurring_candidates(rows, batch_size, Staging(spark) if batch_size == 5 else None).collect()
    assert [r.merchant_name_cleaned for r in found] == ["sub", "plain"][: batch_size or 2]
    first = found[0]
    assert first.has_recurring_keywords and first.transaction_count == 5
    assert [(s.days, s.n) for s in first.transaction_intervals_days] == [(30, 4)]
    assert (first.stddev_amount, first.avg_amount) == (0.0, 10.0)
    assert [e.transaction_date for e in first.example_transactions] == [
        START + dt.timedelta(days=120), START + dt.timedelta(days=90)
    ]


def test_expanded_histogram(make_transactions):
    rows = make_transactions(*daily("m", 4), *daily("m", 1))
    frame = interval_histogram(rows).select(expand_intervals(F.col("transaction_intervals_days")).alias("all"))
    assert frame.first()["all"] == [0, 30, 30, 30]


def test_flagging(spark, make_transactions):
    rows = make_transactions(
        {"merchant_name_cleaned": "m"}, {"merchant_name_cleaned": "m", "is_recurring": False},
        {"merchant_name_cleaned": "m", "is_recurring": True, "categorization_method": "fallback"},
        {"merchant_name_cleaned": "m", "transaction_type": "Credit"}, {"merchant_name_cleaned": None},
    )
    flags = spark.createDataFrame([("m", "Debit"), ("m", "Debit")], "merchant_name_cleaned string, transaction_type string")
    seen = Observation()
    got = by_id(flag_recurring(rows, flags, seen), "is_recurring", "categorization_method")
    method = "llm-recurring-identification"
    assert list(got.values()) == [(True, method), (True, method), (True, "fallback"), (None, None), (None, None)]
    assert seen.get["affected"] == 2


@pytest.mark.parametrize("small", [None, True, False])
def test_harmonisation(make_transactions, as_of, small, monkeypatch):
    def labelled(l2, n):
        return [{"merchant_name_cleaned": "m", "is_recurring": True, "category_l1": "Expense", "category_l2": l2}] * n

    rows = make_transactions(
        *labelled("Shopping", 2), *labelled("Groceries", 2), *labelled("Medical", 1),
        {"merchant_name_cleaned": "m", "is_recurring": True, "category_l1": "Transfer"},
        {"merchant_name_cleaned": "m"},
        {"merchant_name_cleaned": "other", "is_recurring": True},
    )
    trusted = trusted_recurring_labels(rows)
    assert [tuple(r) for r in trusted.collect()] == [("m", "Debit", "Expense", "Groceries", 2)]
    monkeypatch.setattr(recurring, "fits_broadcast", lambda frame: small)
    seen = Observation()
    changed = harmonize_recurring(rows, as_of, trusted=None if small is None else trusted, observation=seen)
    got = by_id(changed, "category_l1", "category_l2")
    assert got["T0005"] == ("Expense", "Groceries")
    assert got["T0006"] == got["T0007"] == (None, None)
    assert got["T0000"] == ("Expense", "Shopping")
    assert seen.get["affected"] == 1
