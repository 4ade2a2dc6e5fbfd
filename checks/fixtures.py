"""Source and target tables derived from the generated tables; ``oracles.py`` holds the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep import TableSpec, latest_wins

SINGLE = TableSpec("single", ("id",), ordering="last_modified")
PAIR = TableSpec(
    "pair", ("transaction_id", "transaction_line_id"), ordering="date_last_modified_gmt"
)
TEXT = TableSpec("text", ("code", "line", "day"), ordering="o")
FIVE = TableSpec("five", ("k1", "k2", "k3", "k4", "k5"), ordering="date_last_modified")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tgt_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as id",
        "o_custkey as cust_id",
        "o_totalprice as amount",
        "o_orderdate as last_modified",
        "case when o_orderkey % 11 = 0 then '1' when o_orderkey % 97 = 1 then null else '0' end as is_deleted",
        "o_orderstatus as partition_key",
        "'20240101000000' as _hoodie_commit_time",
        "cast(o_orderkey as string) as _hoodie_record_key",
    )


def src_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return ids.filter("id % 13 <> 5").unionAll(ids.filter("id % 5 = 0").selectExpr("id + 1000000 as id"))


def pair_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_returnflag"
    )
    return latest_wins(
        lines, ["l_orderkey", "l_linenumber"], "l_shipdate", tie_break=["l_partkey", "l_suppkey"]
    )


def tgt_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_latest(spark, sf_dir).selectExpr(
        "l_orderkey as transaction_id",
        "l_linenumber as transaction_line_id",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_shipdate as date_last_modified_gmt",
        "case when l_orderkey % 11 = 0 then '1' else '0' end as is_deleted",
        "l_returnflag as partition_key",
    )


def src_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter("(l_orderkey * 7 + l_linenumber) % 13 <> 5")
    return lines.selectExpr(
        "l_orderkey as transaction_id", "l_linenumber as transaction_line_id"
    ).distinct()


def src_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of text, decimals and dates, of which half share their first part; some parts are NULL."""
    return table(spark, sf_dir, "orders").selectExpr(
        "case when o_orderkey % 2 = 0 then 'it''s' when o_orderkey % 53 = 0 then null else o_orderpriority || o_orderkey % 7 end as code",
        "cast(o_orderkey / 4 as decimal(18, 2)) as line",
        "cast(o_orderdate as date) as day",
    )


def src_pair_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src_pair(spark, sf_dir).filter("transaction_id % 11 <> 0")


def tgt_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as k1",
        "l_linenumber as k2",
        "l_partkey as k3",
        "nullif(l_suppkey % 10, 0) as k4",
        "l_returnflag as k5",
        "l_shipdate as date_last_modified",
        "'0' as is_deleted",
        "l_linestatus as partition_key",
    )


def src_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tgt_five(spark, sf_dir).filter("k1 % 17 <> 3").select(*FIVE.keys)


# Every event is stored or incoming; multiples of six are both, which gives ties.
STORED_EVENT = "event_id % 2 = 0"
INCOMING_EVENT = "event_id % 2 = 1 or event_id % 3 = 0"


def latest_event(spark: SparkSession, sf_dir: str, side: str, origin: str) -> DataFrame:
    """The last event of every user on one side of the upsert."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    latest = latest_wins(events.filter(side), ["user_id"], "ts", tie_break=["event_id"])
    return latest.withColumn("origin", F.lit(origin))
