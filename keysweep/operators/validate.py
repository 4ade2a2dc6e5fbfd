"""Checks of an update set against the table it is written to.

``check_columns`` and ``check_schema`` compare two DataFrames by their metadata and run no job. The
``*_diff`` forms report the same findings as rows, for inventories of many tables at once.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keysweep.functions.columns import column
from keysweep.operators.joins import distinct_keys

TABLE, NAME, TYPE = "table_name", "column_name", "type_name"


def check_required(df: DataFrame, required: Iterable[str]) -> None:
    absent = sorted(set(required) - set(df.columns))
    if absent:
        raise ValueError(f"required columns are absent: {absent}")


def check_columns(existing: DataFrame, new: DataFrame) -> None:
    """Refuse a different number of columns."""
    old_names, new_names = existing.columns, new.columns
    if len(old_names) == len(new_names):
        return
    raise ValueError(
        f"the target has {len(old_names)} columns and the update set {len(new_names)}; "
        f"missing: {sorted(set(old_names) - set(new_names))}, "
        f"extra: {sorted(set(new_names) - set(old_names))}"
    )


def schema_mismatches(existing: DataFrame, new: DataFrame) -> list[str]:
    old_types, new_types = dict(existing.dtypes), dict(new.dtypes)
    findings = [f"missing column {c}" for c in old_types.keys() - new_types.keys()]
    findings += [f"extra column {c}" for c in new_types.keys() - old_types.keys()]
    findings += [
        f"{c} type mismatch (expected {old_types[c]}, got {new_types[c]})"
        for c in old_types.keys() & new_types.keys()
        if old_types[c] != new_types[c]
    ]
    return sorted(findings)


def check_schema(existing: DataFrame, new: DataFrame) -> None:
    """Refuse different column names or types."""
    findings = schema_mismatches(existing, new)
    if findings:
        raise ValueError("the update set does not fit the target: " + "; ".join(findings))


def schema_inventory(df: DataFrame, table_name: str) -> DataFrame:
    """The columns of ``df`` as rows of (table_name, column_name, type_name)."""
    rows = [(table_name, name, type_name) for name, type_name in df.dtypes]
    return df.sparkSession.createDataFrame(rows, f"{TABLE} string, {NAME} string, {TYPE} string")


def _compared(existing: DataFrame, new: DataFrame) -> DataFrame:
    old = existing.select(TABLE, NAME, column(TYPE).alias("expected"))
    return old.join(new.select(TABLE, NAME, column(TYPE).alias("got")), [TABLE, NAME], "full")


def column_diff(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Missing and extra columns of every table whose number of columns changed."""
    counted = F.count(F.lit(1))
    changed = (
        existing.groupBy(TABLE).agg(counted.alias("n"))
        .unionByName(new.groupBy(TABLE).agg((-counted).alias("n")))
        .groupBy(TABLE).agg(F.sum("n").alias("n"))
        .filter(F.col("n") != 0)
    )
    kind = F.when(F.col("got").isNull(), "missing").when(F.col("expected").isNull(), "extra")
    different = _compared(existing, new).withColumn("kind", kind).filter(F.col("kind").isNotNull())
    changed_names = distinct_keys(changed, [TABLE])
    return different.join(changed_names, TABLE, "left_semi").select(TABLE, "kind", NAME)


def schema_diff(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Every mismatch of names and types, worded as in ``check_schema``."""
    expected, got, name = F.col("expected"), F.col("got"), F.col(NAME)
    mismatch = (
        F.when(got.isNull(), F.concat(F.lit("missing column "), name))
        .when(expected.isNull(), F.concat(F.lit("extra column "), name))
        .when(
            expected != got,
            F.concat(name, F.lit(" type mismatch (expected "), expected, F.lit(", got "), got, F.lit(")")),
        )
    )
    found = _compared(existing, new).select(TABLE, mismatch.alias("mismatch"))
    return found.filter(F.col("mismatch").isNotNull())


def check_written(rows: DataFrame, stored: T.StructType) -> None:
    """Refuse rows for a rewrite of stored ones that lack a column, add one or change its type."""
    have = {f.name: f.dataType for f in rows.schema.fields}
    want = {f.name: f.dataType for f in stored.fields}
    if have != want:
        differ = sorted(c for c in have.keys() | want.keys() if have.get(c) != want.get(c))
        raise ValueError(f"the rows to write differ from the table in the columns {differ}")
