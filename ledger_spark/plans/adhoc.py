"""Ad-hoc queries over named frames."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def _is_query(spark: SparkSession, sql: str) -> bool:
    """Whether the parsed statement, with all parts of it, only reads."""
    logical = "org.apache.spark.sql.catalyst.plans.logical."
    writing = [spark._jvm.java.lang.Class.forName(logical + name) for name in ("Command", "ParsedStatement")]
    parts = [spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)]
    while parts:
        plan = parts.pop()
        if any(kind.isInstance(plan) for kind in writing):
            return False
        children = plan.children()
        parts += [children.apply(i) for i in range(children.size())]
    return True


def run_query(spark: SparkSession, sql: str, views: Mapping[str, DataFrame], args: Mapping[str, Any] | None = None) -> DataFrame:
    """Run a SELECT or WITH statement over ``views``; values are passed as named parameters.

    The parsed statement decides, not its first word. Changes to a table are made by the operators (``keyed_update`` and the functions
    built on it), which return a new frame. The names are there for this statement only: views of the
    session that have the same names are back as soon as it is resolved, before it runs.
    """
    if not _is_query(spark, sql):
        raise ValueError("only SELECT and WITH statements; use the update operators to change rows")
    known = spark._jsparkSession.sessionState().catalog()
    hidden = {name: spark.table(name) for name in views if known.getTempView(name).isDefined()}
    try:
        for name, frame in views.items():
            frame.createOrReplaceTempView(name)
        return spark.sql(sql, args=dict(args or {}))
    finally:
        for name in views:
            spark.catalog.dropTempView(name)
        for name, frame in hidden.items():
            frame.createOrReplaceTempView(name)
