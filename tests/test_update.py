import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledger_spark.operators.update import fits_broadcast, keyed_update, keyed_upsert, new


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [(1, "a", None, 10), (2, "a", "x", None), (3, "b", None, 30), (4, None, "x", 40)],
        "id int, k string, p string, v int",
    )


def run(target, source, **options):
    seen = Observation()
    frame = keyed_update(
        target, source, on=["k", "p"], null_safe=("p",), assign={"v": new("w")}, observation=seen, **options
    )
    values = {r.id: r.v for r in frame.collect()}
    return values, seen.get["affected"]


@pytest.mark.parametrize("small", [True, False])
def test_null_safe_keys_and_affected_rows(spark, target, small):
    source = spark.createDataFrame([("a", None, 99), ("b", None, 30), (None, "x", 5)], "k string, p string, w int")
    values, affected = run(target, source, small_source=small)
    assert values == {1: 99, 2: None, 3: 30, 4: 40}
    assert affected == 2  # row 3 counts although its value stays the same


@pytest.mark.parametrize("small", [True, False])
def test_conditions(spark, target, small):
    source = spark.createDataFrame([("a", None, 5), ("b", None, 50), ("a", "x", 7)], "k string, p string, w int")
    values, affected = run(target, source, small_source=small, rows=F.col("v").isNotNull(), when=new("w") > F.col("v"))
    assert values == {1: 10, 2: None, 3: 50, 4: 40}
    assert affected == 1


def test_duplicate_key_fails_only_where_it_is_used(spark, target):
    source = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("z", None, 3), ("z", None, 4)],
                                   "k string, p string, w int")
    values, _ = run(target, source.filter("k = 'z'"), small_source=True)
    assert values == {1: 10, 2: None, 3: 30, 4: 40}
    values, _ = run(target, source, small_source=True, rows=F.col("id") > 1)
    assert values == {1: 10, 2: None, 3: 30, 4: 40}
    with pytest.raises(Exception, match="more than one source row"):
        run(target, source, small_source=True)


def test_best_duplicate(spark, target):
    source = spark.createDataFrame([("a", None, 1), ("a", None, 2)], "k string, p string, w int")
    values, affected = run(target, source, on_duplicate="best", prefer=[-F.col("w")])
    assert values[1] == 2 and affected == 1
    with pytest.raises(ValueError):
        run(target, source, on_duplicate="whatever")


def test_upsert_inserts_each_unmatched_row(spark, target):
    source = spark.createDataFrame([("a", None, 7), ("n", None, 8)], "k string, p string, w int")
    seen = (Observation(), Observation())
    frame = keyed_upsert(
        target, source, on=["k", "p"], null_safe=("p",), assign={"v": new("w")}, observations=seen,
        insert={"id": F.lit(0), "k": F.col("k"), "p": F.col("p"), "v": F.col("w")},
    )
    assert sorted((r.id, r.k, r.v) for r in frame.collect() if r.k) == [
        (0, "n", 8), (1, "a", 7), (2, "a", None), (3, "b", 30)
    ]
    assert (seen[0].get["affected"], seen[1].get["affected"]) == (1, 1)


def test_upsert_of_several_rows_a_key_and_of_none(spark, target):
    source = spark.createDataFrame([("a", None, [1, 2]), ("n", None, [3, 4]), ("o", None, [])], "k string, p string, ws array<int>")
    rows = F.transform("ws", lambda w: F.struct(w.alias("id"), F.col("k"), F.col("p"), (w * 10).alias("v")))
    seen = (Observation(), Observation())
    frame = keyed_upsert(target, source, on=["k", "p"], null_safe=("p",), insert=rows, observations=seen)
    assert sorted((r.id, r.v or 0) for r in frame.collect()) == [(1, 10), (2, 0), (3, 30), (3, 30), (4, 40), (4, 40)]
    assert (seen[0].get["affected"], seen[1].get["affected"]) == (0, 2)


def test_upsert_is_one_join(spark, target):
    source = spark.createDataFrame([("a", None, 7)], "k string, p string, w int")
    frame = keyed_upsert(
        target, source, on=["k", "p"], null_safe=("p",), assign={"v": new("w")},
        insert={"id": F.lit(0), "k": F.col("k"), "p": F.col("p"), "v": F.col("w")},
    )
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "Join FullOuter" in plan and "Aggregate" not in plan


def test_upsert_keeps_keys_that_are_null(spark, target):
    """A null in a key that is not null-safe matches nothing: the target's row stays, the source's is added."""
    source = spark.createDataFrame([(None, "x", 7)], "k string, p string, w int")
    frame = keyed_upsert(
        target, source, on=["k", "p"], null_safe=("p",), assign={"v": new("w")},
        insert={"id": F.lit(0), "k": F.col("k"), "p": F.col("p"), "v": F.col("w")},
    )
    assert {(r.id, r.k, r.v) for r in frame.collect()} == {(1, "a", 10), (2, "a", None), (3, "b", 30), (4, None, 40), (0, None, 7)}


def test_broadcast_is_measured(spark):
    rows = spark.range(100).select(F.lit("x" * 50).alias("s"))
    assert fits_broadcast(rows)
    assert not fits_broadcast(rows, max_rows=99)
    assert not fits_broadcast(rows, max_bytes=4000)
