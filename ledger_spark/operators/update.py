"""Keyed update and upsert as joins: a frame goes in, a new frame comes out.

Parquet tables have no in-place MERGE, so a matched update is a left join plus
``when(hit, new).otherwise(old)`` per column.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

_KEY, _NEW, _COUNT, _HIT, _KNOWN, _ROWS = "__key_", "__new_", "__n", "__hit", "__known", "__rows"


def new(column: str) -> Column:
    """The source's value of ``column`` inside ``assign`` and ``when`` of an update."""
    return F.col(_NEW + column)


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Measure a lookup frame before it is broadcast. Reads at most ``max_rows`` + 1 rows."""
    widths = [
        F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) if isinstance(f.dataType, T.StringType) else F.lit(16)
        for f in df.schema.fields
    ]
    row_bytes = reduce(lambda a, b: a + b, widths)
    size = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes).alias("bytes")).first()
    return size["n"] <= max_rows and (size["bytes"] or 0) <= max_bytes


def broadcast_limited(df: DataFrame, limit: int, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast a frame that a LIMIT has cut to ``limit`` rows, if that is few enough."""
    return F.broadcast(df) if limit <= max_rows else df


def key_condition(left: Mapping[str, Column], right: Mapping[str, Column], null_safe: Sequence[str] = ()) -> Column:
    """Equality on all keys; those in ``null_safe`` also match NULL with NULL."""
    return reduce(and_, [left[k].eqNullSafe(right[k]) if k in null_safe else left[k] == right[k] for k in left])


def _one_row_per_key(source: DataFrame, on: Sequence[str], on_duplicate: str, prefer: Sequence[Column]) -> DataFrame:
    keys = [F.col(k).alias(_KEY + k) for k in on]
    values = [c for c in source.columns if c not in on]
    if on_duplicate == "unique":
        return source.select(*keys, *[F.col(c).alias(_NEW + c) for c in values], F.lit(1).alias(_COUNT))
    aggregates = [F.count(F.lit(1)).alias(_COUNT)]
    if values:
        row = F.struct(*values)
        order = F.struct(*prefer, *values)
        aggregates.append(F.min_by(row, order).alias("__row"))
    grouped = source.groupBy(*keys).agg(*aggregates)
    return grouped.select(
        *[_KEY + k for k in on], *[F.col("__row").getField(c).alias(_NEW + c) for c in values], _COUNT
    )


def keyed_update(
    target: DataFrame,
    source: DataFrame,
    *,
    on: Sequence[str],
    assign: Mapping[str, Column],
    rows: Column | None = None,
    when: Column | None = None,
    null_safe: Sequence[str] = (),
    on_duplicate: str = "error",
    prefer: Sequence[Column] = (),
    small_source: bool | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Update the target rows that find their key in ``source``.

    ``rows`` is a predicate over target columns, ``when`` may also use :func:`new`.
    ``on_duplicate`` says what happens when the source repeats a key: ``"error"``
    fails as soon as a row to be updated meets it, ``"best"`` takes the first in the
    order of ``prefer``, ``"unique"`` promises there is none.

    The source is broadcast only when it was measured to be small. Beyond that,
    rows outside ``rows`` skip the join altogether, and hot keys are left to
    adaptive skew-join splitting.

    ``observation`` reports ``affected``: the rows whose condition held, whether or
    not a value changed.
    """
    if on_duplicate not in ("error", "best", "unique"):
        raise ValueError(f"unknown on_duplicate policy {on_duplicate!r}")
    lookup = _one_row_per_key(source, on, on_duplicate, prefer)
    small = fits_broadcast(source) if small_source is None else small_source
    lookup = F.broadcast(lookup) if small else lookup
    rows = F.lit(True) if rows is None else F.coalesce(rows, F.lit(False))

    bypass = None
    open_rows = target
    if not small:
        open_rows, bypass = target.filter(rows), target.filter(~rows)

    matches = key_condition(
        {k: F.col(k) for k in on}, {k: F.col(_KEY + k) for k in on}, null_safe
    )
    joined = open_rows.join(lookup, matches, "left")
    hit = F.col(_COUNT).isNotNull() & rows
    if when is not None:
        hit = hit & F.coalesce(when, F.lit(False))
    if on_duplicate == "error":
        message = F.concat(F.lit("more than one source row for key "), F.to_json(F.struct(*[F.col(k) for k in on])))
        hit = F.when(hit & (F.col(_COUNT) > 1), F.raise_error(message).cast("boolean")).otherwise(hit)
    joined = joined.withColumn(_HIT, hit)
    if observation is not None:
        joined = joined.observe(observation, F.count_if(F.col(_HIT)).alias("affected"))
    updated = joined.select(
        *[
            F.when(F.col(_HIT), assign[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
            if f.name in assign
            else F.col(f.name)
            for f in target.schema.fields
        ]
    )
    return updated if bypass is None else updated.unionByName(bypass)


def keyed_upsert(
    target: DataFrame,
    source: DataFrame,
    *,
    on: Sequence[str],
    insert: Mapping[str, Column] | Column,
    assign: Mapping[str, Column] | None = None,
    when: Column | None = None,
    null_safe: Sequence[str] = (),
    observations: tuple[Observation, Observation] | None = None,
    on_change: Callable[[DataFrame, Column, Column], DataFrame] | None = None,
) -> DataFrame:
    """Update matched target rows (if ``assign`` is given) and add rows for unmatched source rows, in one full outer join.

    A key may occur once in ``source``. ``insert`` gives each target column as an expression over
    source columns, or an array of such rows where a source row may add several. Target rows that
    share a key are all updated.

    ``observations`` report ``affected`` updates and inserts. ``on_change`` gets the joined frame, the
    column that says whether a row is updated, and the number of rows it adds, and may observe them.
    """
    fields = target.schema.fields
    if not isinstance(insert, Column):
        insert = F.array(F.struct(*[insert[f.name].cast(f.dataType).alias(f.name) for f in fields]))
    keys = [F.col(k).alias(_KEY + k) for k in on]
    values = [F.col(c).alias(_NEW + c) for c in source.columns if c not in on]
    lookup = source.select(*keys, *values, insert.alias(_ROWS), F.lit(1).alias(_COUNT))
    matches = key_condition({k: F.col(k) for k in on}, {k: F.col(_KEY + k) for k in on}, null_safe)
    joined = target.withColumn(_KNOWN, F.lit(True)).join(lookup, matches, "full_outer")

    known = F.col(_KNOWN).isNotNull()
    hit = known & F.col(_COUNT).isNotNull() if assign is not None else F.lit(False)
    if when is not None:
        hit = hit & F.coalesce(when, F.lit(False))
    joined = joined.withColumn(_HIT, hit)
    added = F.when(known, 0).otherwise(F.size(_ROWS))
    if observations:
        joined = joined.observe(observations[0], F.count_if(F.col(_HIT)).alias("affected"))
        joined = joined.observe(observations[1], F.coalesce(F.sum(added), F.lit(0)).alias("affected"))
    if on_change:
        joined = on_change(joined, F.col(_HIT), added)
    assign = assign or {}
    kept = F.struct(
        *[
            (F.when(F.col(_HIT), assign[f.name].cast(f.dataType)).otherwise(F.col(f.name)) if f.name in assign else F.col(f.name)).alias(f.name)
            for f in fields
        ]
    )
    return joined.select(F.inline(F.when(known, F.array(kept)).otherwise(F.col(_ROWS))))
