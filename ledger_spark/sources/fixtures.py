"""Transactions, rules and related tables derived from the TPC-H-like test tables.

The same derivation in SQL is in FIXTURES.md and in the oracle; one transaction per
order, in the state of a half-finished labelling run. The derived tables are written
once per application and folder, as the operators expect stored tables: they prune
columns, push filters into the scan, and plan from file sizes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_description, clean_merchant
from .staging import Staging


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_stored_paths: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, folder: str, name: str, derive: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """The derived table, written on first use and again if its files are gone."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key in _stored_paths:
        try:
            return spark.read.parquet(_stored_paths[key])
        except AnalysisException:
            del _stored_paths[key]
    path = Staging(spark).path(name)
    derive(spark, folder).write.parquet(path)
    _stored_paths[key] = path
    return spark.read.parquet(path)


def as_of() -> Column:
    """The fixed point in time that registered queries write into timestamps."""
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def _text(column: Column) -> Column:
    return column.cast("string")


def transactions_raw(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    customers = read_table(spark, folder, "customer")
    merchants = read_table(spark, folder, "part")
    parts = merchants.agg(F.max("p_partkey")).first()[0] or 0  # all parts serve as merchants
    order, customer, name = F.col("o_orderkey"), F.col("o_custkey"), F.col("p_name")
    credit = order % 5 == 0
    kind = order % 8
    wire = order % 16 == 10
    square = F.concat(F.lit("SQ *"), F.upper(name), F.lit(" #B"), _text(order % 40))
    toast = F.concat(F.lit("TST* "), name)
    store = F.concat(F.upper(name), F.lit(" #"), _text(order % 7))
    online = F.concat(F.upper(name), F.lit("*A"), _text(order % 5))
    seller = F.when(order % 16 == 13, F.col("c_mktsegment")).otherwise(name)  # no rule knows these
    paypal = F.concat(F.lit("PYPL *"), seller, F.lit(" & CO-"), _text(customer % 200))
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(merchants, F.col("p_partkey") == order % (parts + 1))
        .select(
            F.concat(F.lit("TXN-"), _text(order)).alias("transaction_id"),
            F.concat(F.lit("ACC-"), _text(customer)).alias("account_id"),
            F.col("c_name").alias("consumer_name"),
            F.when(customer % 11 != 0, F.col("c_mktsegment")).alias("persona_type"),
            F.when(customer % 2 == 0, "Chase").otherwise("Ally Bank").alias("institution_name"),
            F.when((order % 5 == 0) | (order % 3 == 0), "Checking Account")
            .otherwise("Credit Card")
            .alias("account_type"),
            F.col("o_orderdate").cast("timestamp").alias("transaction_date"),
            F.when(credit, "Credit").otherwise("Debit").alias("transaction_type"),
            (F.when(credit, 1.0).otherwise(-1.0) * F.floor("o_totalprice") / 100.0).alias("amount"),
            F.when(wire, F.concat(F.lit("WIRE OUT "), F.col("c_mktsegment")))
            .when(kind == 0, square)
            .when(kind == 1, toast)
            .when(kind == 2, F.concat(F.lit("POS DEBIT "), store, F.lit(" PHOENIX AZ")))
            .when(kind == 3, F.concat(F.lit("ACH DEBIT - "), F.upper(name), F.lit(" MONTHLY PLAN")))
            .when(kind == 4, F.concat(online, F.lit(" HELP.COM/BILL")))
            .when(kind == 5, paypal)
            .when(kind == 6, "")
            .alias("description_raw"),
            F.when(wire, F.lit(None))
            .when(kind == 0, square)
            .when(kind == 1, toast)
            .when(kind == 2, store)
            .when(kind == 3, F.upper(name))
            .when(kind == 4, online)
            .when(kind == 5, paypal)
            .when(kind == 6, F.concat(F.lit("** "), name))
            .alias("merchant_name_raw"),
            F.when(order % 4 == 0, "ACH")
            .when(order % 4 == 1, "Point-of-Sale")
            .when(order % 4 == 2, "Card-Not-Present")
            .alias("channel"),
        )
    )


def transactions_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return transactions_raw(spark, folder).withColumns(
        {
            "description_cleaned": clean_description(F.col("description_raw")),
            "merchant_name_cleaned": clean_merchant(F.col("merchant_name_raw")),
        }
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned rows of which some are labelled, by various methods."""
    return stored(spark, folder, "transactions", derive_transactions)


def transactions_unlabelled(spark: SparkSession, folder: str) -> DataFrame:
    """Rows as after loading: neither cleaned nor labelled."""
    return stored(spark, folder, "transactions-unlabelled", derive_transactions_unlabelled)


def rules(spark: SparkSession, folder: str) -> DataFrame:
    """Global and persona rules, conflicting labels, inactive rules, patterns, whole descriptions."""
    return stored(spark, folder, "rules", derive_rules)


def rules_with_patterns(spark: SparkSession, folder: str) -> DataFrame:
    """The rules and one pattern for each distinct payment partner in the descriptions: thousands, and more in larger tables."""
    return stored(spark, folder, "rules-with-patterns", derive_rules_with_patterns)


def derive_rules_with_patterns(spark: SparkSession, folder: str) -> DataFrame:
    known = rules(spark, folder)
    paid = transactions(spark, folder).filter(F.col("description_cleaned").startswith("pypl "))
    partners = paid.select(F.substring("description_cleaned", 6, 1_000).alias("identifier"), "transaction_type").distinct()
    given = {
        "rule_id": F.concat(F.lit("R-Z-"), F.col("transaction_type"), F.lit("-"), F.col("identifier")),
        "rule_type": F.lit("pattern"),
        "category_l1": F.lit("Expense"),
        "category_l2": F.lit("Entertainment"),
        "confidence_score": 40 + F.length("identifier") % 30,
        "is_active": F.lit(True),
        "created_timestamp": F.lit("2024-01-01 00:00:00"),
        "last_updated_timestamp": F.lit("2024-03-01 00:00:00"),
    }
    kinds = {f.name: f.dataType for f in known.schema.fields}
    made = partners.select(*[given.get(c, F.col(c) if c in partners.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()])
    return known.unionByName(made)


def derive_transactions(spark: SparkSession, folder: str) -> DataFrame:
    n = F.substring("transaction_id", 5, 20).cast("bigint")
    credit = F.col("transaction_type") == "Credit"
    step = n % 10
    return transactions_cleaned(spark, folder).withColumns(
        {
            "category_l1": F.when(step == 4, "Transfer")
            .when(step == 9, "Income")
            .when(step >= 4, F.when(credit, "Income").otherwise("Expense")),
            "category_l2": F.when(step == 9, "Payroll").when(
                step >= 6,
                F.when(credit, F.when(n % 4 < 2, "Refund").otherwise("Other Income"))
                .when(n % 3 == 0, "Groceries")
                .otherwise("Shopping"),
            ),
            "is_recurring": F.when(n % 7 == 0, True).when((n % 7).isin(1, 2), False),
            "categorization_method": F.when(step == 6, "llm-bulk-merchant-based")
            .when(step == 7, "llm-bulk-pattern-based")
            .when(step == 8, "llm-transaction-based")
            .when(step == 9, "fallback"),
            "llm_confidence_score": F.when(step == 8, F.floor(n / 10) % 10 + 1).cast("bigint"),
            "rule_id": F.lit(None).cast("string"),
            "categorization_update_timestamp": F.lit(None).cast("timestamp"),
        }
    )


def derive_transactions_unlabelled(spark: SparkSession, folder: str) -> DataFrame:
    nothing = {
        "description_cleaned": "string", "merchant_name_cleaned": "string", "category_l1": "string",
        "category_l2": "string", "is_recurring": "boolean", "categorization_method": "string", "rule_id": "string",
        "categorization_update_timestamp": "timestamp",
    }
    return transactions_raw(spark, folder).withColumns({c: F.lit(None).cast(t) for c, t in nothing.items()})


def derive_rules(spark: SparkSession, folder: str) -> DataFrame:
    names = (
        read_table(spark, folder, "part")
        .groupBy("p_name")
        .agg(F.min("p_partkey").alias("k"))
    )
    k, name = F.col("k"), F.col("p_name")

    def some(source: DataFrame, prefix: str, text: Column, identifier: Column, rule_type: str, direction: str,
             persona: str | None, l1: str, l2: str, recurring: Column, score: Column, active: Column) -> DataFrame:
        return source.select(
            F.concat(F.lit(prefix), text).alias("rule_id"),
            F.lit(rule_type).alias("rule_type"),
            identifier.alias("identifier"),
            F.lit(direction).alias("transaction_type"),
            F.lit(persona).cast("string").alias("persona_type"),
            F.lit(l1).alias("category_l1"),
            F.lit(l2).alias("category_l2"),
            recurring.cast("boolean").alias("is_recurring_rule"),
            score.cast("bigint").alias("confidence_score"),
            active.alias("is_active"),
        )

    none, on = F.lit(None), F.lit(True)
    first = names.select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("w")).distinct()
    second = names.select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("w")).distinct()
    word = F.col("w")
    plan = F.concat(F.lit("ach debit "), name, F.lit(" monthly plan"))
    flag = F.when(k % 3 == 0, True).when(k % 3 == 1, False)
    parts = [
        some(names, "R-M-", name, name, "merchant", "Debit", None, "Expense", "Shopping", flag, 50 + k % 45,
             k % 6 != 5),
        some(names.filter(k % 2 == 0), "R-H-", name, name, "merchant", "Debit", "HOUSEHOLD", "Expense", "Groceries",
             none, 40 + k % 20, on),
        some(names.filter(k % 5 == 0), "R-X-", name, name, "merchant", "Debit", None, "Expense", "Office Supplies",
             none, F.lit(60), on),
        some(names.filter(k % 7 == 0), "R-A-", name, name, "merchant", "All", None, "Transfer", "Internal Transfer",
             F.lit(False), F.lit(99), on),
        some(first, "R-P-", word, word, "pattern", "Debit", None, "Expense", "Business Services", none, F.lit(55), on),
        some(second, "R-C-", word, word, "pattern", "Credit", None, "Income", "Refund", none, F.lit(70), on),
        some(names.filter(k % 4 == 0), "R-T-", name, plan, "transaction", "Debit", None, "Expense", "Software & Tech",
             on, F.lit(95), on),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    updated = F.concat(F.lit("2024-02-"), _text(10 + F.col("confidence_score") % 15), F.lit(" 00:00:00"))
    return union.withColumns(
        {
            "created_timestamp": F.lit("2024-01-01 00:00:00").cast("timestamp"),
            "last_updated_timestamp": updated.cast("timestamp"),
        }
    )


def bills(spark: SparkSession, folder: str) -> DataFrame:
    """One monthly bill per customer."""
    key = F.col("c_custkey")
    return read_table(spark, folder, "customer").select(
        F.concat(F.lit("ACC-"), _text(key)).alias("account_id"),
        F.col("c_name").alias("consumer_name"),
        F.concat(F.lit("UTILITY "), _text(key % 40)).alias("merchant_name"),
        (key % 31 + 1).cast("int").alias("day_of_month"),
        (F.floor(F.abs("c_acctbal")) / -10.0).alias("amount_mean"),
        F.lit("Expense").alias("category_l1"),
        F.lit("Bills & Utilities").alias("category_l2"),
    )


def life_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events of each user, lasting two or three months."""
    key = F.col("event_id")
    return read_table(spark, folder, "events").select(
        F.concat(F.lit("user "), _text(F.col("user_id"))).alias("consumer_name"),
        F.col("event_type").alias("name"),
        key.alias("position"),
        (key % 11 + 1).cast("int").alias("start_month_ago"),
        (key % 11 + 1 - (2 + key % 2)).cast("int").alias("end_month_ago"),
    )


def consumer_months(spark: SparkSession, folder: str, months: int = 12) -> DataFrame:
    """Each user of the events table with the index of each of the last months."""
    users = read_table(spark, folder, "events").select("user_id").distinct()
    return users.select(
        F.concat(F.lit("user "), _text(F.col("user_id"))).alias("consumer_name"),
        F.explode(F.sequence(F.lit(0), F.lit(months - 1))).alias("month_index"),
    )


def incoming(spark: SparkSession, folder: str) -> DataFrame:
    """Rows as a source delivers them: L2 given, amount unsigned, some keys missing."""
    # Values that exercise every branch of the derivation.
    l2 = F.array(*[F.lit(v) for v in (
        "Groceries", "Income", "Peer to Peer Transfer", "Refund", "Education", "Interest Income", "Other Income",
        "Unheard Of",
    )])
    merchants = F.array(*[F.lit(v) for v in (
        "Whole Foods Market", "Trader Joe's", "Amazon.com", "GEICO", "T-MOBILE", "City Hospital", "Corner Store",
    )])
    n = F.col("n")
    return (
        transactions_raw(spark, folder)
        .withColumn("n", F.substring("transaction_id", 5, 20).cast("bigint"))
        .select(
            "transaction_id",
            "description_raw",
            "merchant_name_raw",
            F.when(n % 13 != 0, F.element_at(merchants, (n % 7 + 1).cast("int"))).alias("merchant_name_cleaned"),
            F.when(n % 17 != 0, F.element_at(l2, (n % 8 + 1).cast("int"))).alias("category_l2"),
            "amount",
        )
    )
