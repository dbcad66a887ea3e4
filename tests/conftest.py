from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledger_spark.schema import RULES_SCHEMA, TRANSACTIONS_SCHEMA  # noqa: E402
from ledger_spark.session import build_session  # noqa: E402

TESTDATA = Path("/root/testdata")
NOW = dt.datetime(2024, 6, 1)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "ledger-spark-tests",
        "local[*]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture(scope="session")
def as_of():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


@pytest.fixture(scope="session")
def small_folder():
    folder = TESTDATA / "sf0.001"
    if not folder.exists():
        pytest.skip("no test tables here")
    return str(folder)


def _frame(spark, schema_ddl, defaults, rows):
    return spark.createDataFrame([tuple({**defaults, **row}[c] for c in defaults) for row in rows], schema_ddl)


TRANSACTION_DEFAULTS = {
    "transaction_id": None, "account_id": "A", "persona_type": None, "transaction_date": None,
    "transaction_type": "Debit", "amount": -1.0, "is_recurring": None, "description_raw": None,
    "description_cleaned": None, "merchant_name_raw": None, "merchant_name_cleaned": None, "category_l1": None,
    "category_l2": None, "channel": None, "account_type": None, "categorization_update_timestamp": None,
    "categorization_method": None, "rule_id": None, "llm_confidence_score": None,
}
_TRANSACTION_TYPES = {f.name: f.dataType.simpleString() for f in TRANSACTIONS_SCHEMA.fields} | {
    "llm_confidence_score": "bigint"
}
RULE_DEFAULTS = {
    "rule_id": None, "rule_type": "merchant", "identifier": None, "transaction_type": "Debit", "persona_type": None,
    "category_l1": "Expense", "category_l2": "Shopping", "is_recurring_rule": None, "confidence_score": 50,
    "created_timestamp": NOW, "last_updated_timestamp": NOW, "is_active": True,
}


@pytest.fixture(scope="session")
def make_transactions(spark):
    ddl = ", ".join(f"{c} {_TRANSACTION_TYPES[c]}" for c in TRANSACTION_DEFAULTS)

    def make(*rows):
        numbered = [{"transaction_id": f"T{i:04d}", **row} for i, row in enumerate(rows)]
        return _frame(spark, ddl, TRANSACTION_DEFAULTS, numbered)

    return make


@pytest.fixture(scope="session")
def make_rules(spark):
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RULES_SCHEMA.fields)
    defaults = {f.name: RULE_DEFAULTS[f.name] for f in RULES_SCHEMA.fields}

    def make(*rows):
        return _frame(spark, ddl, defaults, [{"rule_id": f"R{i:04d}", **row} for i, row in enumerate(rows)])

    return make


def by_id(frame, *columns, key="transaction_id"):
    """Rows as {id: value or tuple of values}."""
    return {r[key]: r[columns[0]] if len(columns) == 1 else tuple(r[c] for c in columns) for r in frame.collect()}
