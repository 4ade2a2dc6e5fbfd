"""Column expressions shared by the operators; all of them are built-in functions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keysweep.spec import DELETED, FLAG_COLUMN, META_PREFIX


def column(name: str) -> Column:
    """The column called exactly ``name``, whatever characters it holds."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def is_active(flag_col: str = FLAG_COLUMN, null_is_active: bool = False) -> Column:
    """Whether a row is live. A NULL flag is neither live nor deleted unless ``null_is_active``."""
    live = column(flag_col) != DELETED
    return live | column(flag_col).isNull() if null_is_active else live


def any_null(names: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [column(n).isNull() for n in names])


def none_null(names: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [column(n).isNotNull() for n in names])


def in_values(name: str, values: Sequence) -> Column:
    """Membership in a list that may hold NULL, in a form the scan can prune partitions with."""
    known = [v for v in values if v is not None]
    found = column(name).isin(known)
    return found | column(name).isNull() if len(known) < len(values) else found


def meta_columns(df: DataFrame, prefix: str = META_PREFIX) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def drop_meta(df: DataFrame, prefix: str = META_PREFIX) -> DataFrame:
    """``df`` without the bookkeeping columns of the storage layer."""
    return df.drop(*meta_columns(df, prefix))


def stringify(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Every column, or only ``names``, as text."""
    chosen = set(df.columns if names is None else names)
    return df.select(
        *[column(c).cast("string").alias(c) if c in chosen else column(c) for c in df.columns]
    )


def null_fill(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns and types of ``schema``; columns it lacks become NULL."""
    present = set(df.columns)
    extra = sorted(present - set(schema.fieldNames()))
    if extra:
        raise ValueError(f"columns unknown to the target: {extra}")
    return df.select(
        *[
            (column(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def key_list(text: Column) -> Column:
    """The names in a comma list, trimmed, without empty ones."""
    names = F.transform(F.split(text, ","), lambda part: F.btrim(part, F.lit(" \t\r\n\f\v")))
    return F.filter(names, lambda name: name != "")


def align_keys(source: DataFrame, target_schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The key columns of ``source`` in the types that the target declares for them.

    A key that does not survive the conversion fails the query instead of looking like a deleted row.
    """
    source_types = {f.name.lower(): f.dataType for f in source.schema.fields}
    absent = [key for key in keys if key.lower() not in source_types]
    if absent:
        raise ValueError(f"the source has no key columns {absent}")
    aligned = []
    for key in keys:
        have, want = source_types[key.lower()], target_schema[key].dataType
        aligned.append(column(key).alias(key) if have == want else _converted(key, have, want))
    return source.select(*aligned)


def _converted(key: str, have: T.DataType, want: T.DataType) -> Column:
    fractional = isinstance(have, (T.FloatType, T.DoubleType)) or (
        isinstance(have, T.DecimalType) and have.scale > 0
    )
    if fractional and isinstance(want, T.StringType):
        raise ValueError(
            f"source key {key} is {have.simpleString()} and text in the target, where 7 and 7.0 differ; "
            "cast it in the source"
        )
    value = column(key)
    cast = value.try_cast(want)
    broken = value.isNotNull() & cast.isNull()
    # Several source keys must not become one. Text to timestamp is exact; every other pair is compared with the way back.
    if isinstance(have, T.StringType) and isinstance(want, T.DecimalType):
        broken = broken | (value.try_cast(T.DecimalType(38, 18)) != cast)
    elif isinstance(have, T.StringType) and isinstance(want, T.DateType):
        broken = broken | (value.try_cast("timestamp_ntz") != cast.cast("timestamp_ntz"))
    elif not (isinstance(have, T.StringType) and isinstance(want, (T.TimestampType, T.TimestampNTZType))):
        broken = broken | (cast.try_cast(have) != value)
    message = F.concat(
        F.lit(f"source key {key} is not a {want.simpleString()}: "), value.cast("string")
    )
    return F.when(broken, F.raise_error(message).cast(want)).otherwise(cast).alias(key)
