"""Reading the key columns of a source table over JDBC.

Only keys are selected, inside the database. Large tables are read over several connections, split in one
of three ways:

* equal ranges of the first key. They can use an index, but come out even only for a single, dense key;
* remainders of all integer keys. They stay even when ids have gaps or one value of the first key holds a large
  share of the rows, but each of them scans the table, so they are for few parts;
* quantiles: ranges of the whole key that hold equal numbers of rows. The database finds their bounds in one
  scan, by ``NTILE``. They are even for any key, and each part is a range of the primary key's index,
  so the table is scanned twice in all, however many parts there are.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keysweep.spec import TableSpec

# Read settings of the source. More rows than PARALLEL_ABOVE are read over PARTITIONS connections, or
# as many more as keep each of them below that number.
FETCH_SIZE = 10_000
PARALLEL_ABOVE = 1_000_000
PARTITIONS = 10

AUTO, RANGE, REMAINDER, QUANTILE = "auto", "range", "remainder", "quantile"
SPLITS = (AUTO, RANGE, REMAINDER, QUANTILE)


@dataclass(frozen=True)
class Profile:
    """How a generation of the source is reached: JDBC option -> name of the setting that holds it."""

    name: str
    driver: str
    settings: Mapping[str, str]
    quote: str = '"'
    extra: Mapping[str, str] = field(default_factory=dict)


def password_profile(name: str, driver: str, quote: str = '"') -> Profile:
    """A source that is entered with a user name and a password."""
    settings = {"url": "connectionUrl", "user": "username", "password": "password"}
    return Profile(name, driver, settings, quote)


def token_profile(name: str, driver: str, quote: str = '"') -> Profile:
    """A source that is entered with an account's consumer key and token."""
    names = ("account_id", "consumer_key", "consumer_secret", "token_id", "token_secret")
    return Profile(name, driver, {"url": "db_url", **{n: n for n in names}}, quote)


def profile_named(profiles: Mapping[str, Profile], name: str | None) -> Profile:
    if name not in profiles:
        raise ValueError(f"unknown source profile {name!r}, expected one of {sorted(profiles)}")
    return profiles[name]


def connection_options(profile: Profile, settings: Mapping[str, str]) -> dict[str, str]:
    absent = sorted(s for s in profile.settings.values() if not settings.get(s))
    if absent:
        raise ValueError(f"profile {profile.name} lacks settings: {absent}")
    options = {option: settings[name] for option, name in profile.settings.items()}
    return {**options, "driver": profile.driver, "fetchsize": str(FETCH_SIZE), **profile.extra}


def quoted(name: str, quote: str = '"') -> str:
    """``name`` as an identifier of the database, part by part; it must be in the database's own case."""
    if not quote:
        if not all(part.isidentifier() for part in name.split(".")):
            raise ValueError(f"{name!r} needs quoting")
        return name
    return ".".join(quote + part.replace(quote, quote * 2) + quote for part in name.split("."))


def key_query(table: str, keys: Sequence[str], quote: str = '"') -> str:
    columns = ", ".join(quoted(key, quote) for key in keys)
    return f"(SELECT {columns} FROM {quoted(table, quote)}) subq"


def bounds_query(table: str, key: str, quote: str = '"') -> str:
    name = quoted(key, quote)
    figures = f"MIN({name}) AS lo, MAX({name}) AS hi, COUNT(*) AS n"
    return f"(SELECT {figures} FROM {quoted(table, quote)}) subq"


def count_query(table: str, quote: str = '"') -> str:
    return f"(SELECT COUNT(*) AS n FROM {quoted(table, quote)}) subq"


def connections(source_count: int, partitions: int | None = None) -> int:
    """How many connections read a source of this size: one if it is small, else so that each reads a bounded part."""
    if source_count <= PARALLEL_ABOVE:
        return 1
    return partitions or max(PARTITIONS, -(-source_count // PARALLEL_ABOVE))


def range_options(key: str, low: object, high: object, partitions: int) -> dict[str, str]:
    """Options of a read split by the range of ``key``; Spark adds NULL keys to the first part."""
    return {
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }


def is_integral(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.IntegralType) or (
        isinstance(data_type, T.DecimalType) and data_type.scale == 0
    )


def can_range(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def remainder_predicates(
    schema: T.StructType, partitions: int, quote: str = '"'
) -> list[str] | None:
    """One predicate per part; every row meets exactly one. None without an integer key.

    All integer keys take part, so rows that share one key still spread. A NULL counts as 0.
    """
    terms = [
        f"ABS(MOD(COALESCE({quoted(f.name, quote)}, 0), {partitions}))"
        for f in schema.fields
        if is_integral(f.dataType)
    ]
    if not terms:
        return None
    return [f"MOD({' + '.join(terms)}, {partitions}) = {part}" for part in range(partitions)]


def can_quantile(schema: T.StructType) -> bool:
    """Whether the bounds of ranges can be written for all keys."""
    return all(can_range(f.dataType) or isinstance(f.dataType, T.StringType) for f in schema.fields)


def quantile_query(table: str, keys: Sequence[str], parts: int, quote: str = '"', slices: str | None = None) -> str:
    """The least key of each of ``parts`` ranges that hold equal numbers of rows, with the number of its range.

    Keys with a NULL part are in none of them. One sort of the keys, which the index of the primary key saves. An engine that
    would sort them in one task is told by ``slices``, a column that numbers consecutive ranges of keys in their order: it sorts each
    of these by itself and adds the counts of those before. The rows are the same.
    """
    names = [quoted(key, quote) for key in keys]
    listed, present = ", ".join(names), " AND ".join(f"{name} IS NOT NULL" for name in names)
    if slices:
        return sliced_query(quoted(table, quote), names, present, parts, quoted(slices, quote))
    tiles = f"SELECT {listed}, NTILE({parts}) OVER (ORDER BY {listed}) AS tile FROM {quoted(table, quote)} WHERE {present}"
    places = f"SELECT {listed}, tile, ROW_NUMBER() OVER (PARTITION BY tile ORDER BY {listed}) AS place FROM ({tiles}) tiles"
    return f"(SELECT {listed}, tile FROM ({places}) places WHERE place = 1) subq"


def sliced_query(table: str, names: Sequence[str], present: str, parts: int, part: str) -> str:
    """The rows of ``quantile_query``, by the rank of each row in its slice, ``part``, and the number of rows in the slices before."""
    listed, ours = ", ".join(names), ", ".join(f"places.{name}" for name in names)
    sizes = f"SELECT {part}, COUNT(*) AS size FROM {table} WHERE {present} GROUP BY {part}"
    # One row for each slice.
    before = f"SELECT {part}, SUM(size) OVER (ORDER BY {part}) - size AS skipped, SUM(size) OVER () AS total FROM ({sizes}) sizes"
    places = f"SELECT {listed}, {part}, ROW_NUMBER() OVER (PARTITION BY {part} ORDER BY {listed}) - 1 AS place FROM {table} WHERE {present}"
    ranks = (
        f"SELECT {ours}, skipped + place AS place, FLOOR(total / {parts}) AS size, MOD(total, {parts}) AS longer "
        f"FROM ({places}) places JOIN ({before}) slices ON places.{part} = slices.{part}"
    )
    # The first ``longer`` ranges have a row more than the others, as those of NTILE.
    early, rest = "longer * (size + 1)", "(place - longer * (size + 1))"
    first = f"CASE WHEN place < {early} THEN MOD(place, size + 1) ELSE MOD({rest}, NULLIF(size, 0)) END = 0"
    tile = f"CASE WHEN place < {early} THEN place / (size + 1) ELSE longer + {rest} / NULLIF(size, 0) END + 1"
    return f"(SELECT {listed}, CAST({tile} AS INTEGER) AS tile FROM ({ranks}) ranks WHERE {first}) subq"


def literal(value: object) -> str:
    """``value``, of a key, as SQL. Rounding does no harm, as a bound ends one part and begins the next."""
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    return f"{value:f}" if hasattr(value, "as_tuple") else repr(value)


def not_before(names: Sequence[str], bound: Sequence[object]) -> str:
    """That the key is ``bound`` or a later one, part by part."""
    name, value = names[0], literal(bound[0])
    if len(names) == 1:
        return f"{name} >= {value}"
    return f"({name} > {value} OR ({name} = {value} AND {not_before(names[1:], bound[1:])}))"


def before(names: Sequence[str], bound: Sequence[object]) -> str:
    """That the key comes before ``bound``."""
    name, value = names[0], literal(bound[0])
    if len(names) == 1:
        return f"{name} < {value}"
    return f"({name} < {value} OR ({name} = {value} AND {before(names[1:], bound[1:])}))"


def quantile_predicates(keys: Sequence[str], bounds: Sequence[Sequence[object]], quote: str = '"') -> list[str]:
    """One predicate per part; every row meets exactly one. ``bounds`` are the least keys of the parts, in order.

    Parts are ranges of the first key, made finer by the others where they meet. Keys with a NULL part are a
    part of their own. Equal bounds, of a key that is not unique, are one.
    """
    names = [quoted(key, quote) for key in keys]
    starts = [tuple(bound) for i, bound in enumerate(bounds) if i == 0 or tuple(bound) != tuple(bounds[i - 1])]
    present = [f"{name} IS NOT NULL" for name in names]
    predicates = [" OR ".join(f"{name} IS NULL" for name in names)]
    for i in range(max(1, len(starts))):
        terms = list(present)
        if i > 0:
            terms += [f"{names[0]} >= {literal(starts[i][0])}", not_before(names, starts[i])]
        if i + 1 < len(starts):
            terms += [f"{names[0]} <= {literal(starts[i + 1][0])}", before(names, starts[i + 1])]
        predicates.append(" AND ".join(dict.fromkeys(terms)))
    return predicates


def ranges_are_even(schema: T.StructType, low: object, high: object, rows: int) -> bool:
    """Whether equal ranges of the first key must hold similar numbers of rows.

    A single integer key is unique, so no range holds more rows than it has values; if at least half of
    all values are taken, none holds more than twice the average.
    """
    return len(schema) == 1 and is_integral(schema[0].dataType) and high - low < 2 * rows


def read_source_keys(
    spark: SparkSession,
    spec: TableSpec,
    profile: Profile,
    settings: Mapping[str, str],
    target_count: int,
    split: str = AUTO,
    partitions: int | None = None,
) -> DataFrame:
    """The keys of every source row, in parallel where the source is large, by its own count.

    ``split`` says how: by range, by remainder, or by quantiles. The default is ranges where they must come out even, else
    remainders if they are few, else quantiles. ``target_count`` is what
    the job passes to any source; a small target says nothing about the size of a new source, so it is not used.
    """
    if split not in SPLITS:
        raise ValueError(f"unknown split {split!r}, expected one of {SPLITS}")
    options = connection_options(profile, settings)
    query = key_query(spec.name, spec.keys, profile.quote)
    plain = spark.read.format("jdbc").options(**options, dbtable=query)
    counted = spark.read.format("jdbc").options(**options, dbtable=count_query(spec.name, profile.quote))
    partitions = connections(counted.load().first()[0], partitions)
    if partitions == 1:
        return plain.load().toDF(*spec.keys)

    schema = plain.load().schema
    predicates = remainder_predicates(schema, partitions, profile.quote)
    by_quantile = can_quantile(schema) and (split == QUANTILE or (split == AUTO and partitions > PARTITIONS))
    forced = not by_quantile and (split == RANGE or predicates is None)
    if can_range(schema[0].dataType) and (forced or (split == AUTO and len(schema) == 1)):
        bounds = bounds_query(spec.name, spec.keys[0], profile.quote)
        low, high, rows = spark.read.format("jdbc").options(**options, dbtable=bounds).load().first()
        if low is not None and (forced or ranges_are_even(schema, low, high, rows)):
            parts = range_options(schema[0].name, low, high, partitions)
            return plain.options(**parts).load().toDF(*spec.keys)
    if by_quantile:
        tiles = quantile_query(spec.name, spec.keys, partitions, profile.quote)
        found = spark.read.format("jdbc").options(**options, dbtable=tiles).load().collect()
        bounds = [row[:-1] for row in sorted(found, key=lambda row: row[-1])]
        predicates = quantile_predicates(spec.keys, bounds, profile.quote)
    if predicates is None:
        return plain.load().toDF(*spec.keys)
    properties = {k: v for k, v in options.items() if k != "url"}
    split_rows = spark.read.jdbc(options["url"], query, predicates=predicates, properties=properties)
    return split_rows.toDF(*spec.keys)


def jdbc_source(
    spark: SparkSession,
    spec: TableSpec,
    profiles: Mapping[str, Profile],
    settings: Mapping[str, str],
    **split,
) -> Callable[[int], DataFrame]:
    """The source of a run: reads the keys once the size of the target is known.

    The profile and its settings are checked now, before anything is read.
    """
    profile = profile_named(profiles, spec.profile)
    connection_options(profile, settings)
    return partial(read_source_keys, spark, spec, profile, settings, **split)
