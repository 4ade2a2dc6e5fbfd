"""The JSON table configuration: an object of table name -> settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.functions.columns import key_list
from keysweep.spec import TableSpec

_ENTRY = "struct<integration:string,primary_keys:string,system:string,ordering:string,ordering_type:string>"


def parse_table_config(documents: DataFrame, text_col: str = "value") -> DataFrame:
    """One row per table entry of the JSON objects in ``text_col``; malformed JSON fails the query."""
    entries = F.from_json(F.col(text_col), f"map<string,{_ENTRY}>", {"mode": "FAILFAST"})
    return documents.select(F.explode(entries).alias("table_name", "entry")).select(
        "table_name",
        "entry.integration",
        key_list(F.coalesce("entry.primary_keys", F.lit(""))).alias("primary_keys"),
        "entry.system",
        "entry.ordering",
        "entry.ordering_type",
    )


def read_table_config(spark: SparkSession, path: str) -> DataFrame:
    """The entries of one configuration file, or of every file in a folder."""
    return parse_table_config(spark.read.text(path, wholetext=True))


def config_keys(config: DataFrame) -> DataFrame:
    """One row per table and key column, with the position of the key."""
    keys = F.posexplode("primary_keys").alias("key_pos", "key_name")
    return config.select("table_name", "integration", keys)


def table_specs(config: DataFrame) -> list[TableSpec]:
    """The configured tables; one small row each, so they are brought to the driver."""
    return [
        TableSpec(
            name=row.table_name,
            keys=tuple(row.primary_keys),
            ordering=row.ordering,
            system=row.system or "",
            profile=row.integration,
            ordering_type=row.ordering_type,
        )
        for row in config.orderBy("table_name").collect()
    ]
