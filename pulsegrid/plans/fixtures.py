"""Detector-shaped views over the star-schema tables the driver provides.

`pulses`: the `events` table read as hits of 15 sensors per user.
`hits`:   the `lineitem` table read as hits, one event per order.
`truth`:  the `orders` table read as per-event labels.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.runtime import spread

STRING_X = (0, 100, 250, -150, -50, 180, -220)
STRING_Y = (0, 200, -50, 100, -250, -160, -90)
HIT_ORDER = ("dom_time", "part_key", "price", "discount", "tax")
EPOCH_2024_MICROS = 1704067200000000


@lru_cache(maxsize=256)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[int, ...]) -> str:
    return f"element_at(array({', '.join(f'{v}D' for v in values)}), string)"


def with_sensor_constants(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "*",
        f"{_pick(STRING_X)} AS dom_x",
        f"{_pick(STRING_Y)} AS dom_y",
        "double(500 - 17 * dom_number - string) AS dom_z",
        "0.0444D AS pmt_area",
        "IF(string % 2 = 1, 1.35D, 1.0D) AS rde",
        "int(dom_number = 3 AND string = 4) AS is_saturated_dom",
        "int(dom_number = 1 AND string = 2) AS is_bad_dom",
        "int(dom_number = 2 AND string = 5) AS is_bright_dom",
    )


def pulses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_sensor_constants(
        table(spark, sf_dir, "events").selectExpr(
            "event_id AS pulse_id",
            "int(user_id) AS event_no",
            """CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
               WHEN 'error' THEN 4 ELSE 5 END AS string""",
            "int(event_id % 3 + 1) AS dom_number",
            f"(unix_micros(timestamp(ts)) - {EPOCH_2024_MICROS}) / 3600000000.0D AS dom_time",
            "CAST(value AS DECIMAL(12, 2)) AS charge",
            "int(event_id % 2) AS hlc",
        )
    )


def hits(spark: SparkSession, sf_dir: str, event: str = "l_orderkey") -> DataFrame:
    return with_sensor_constants(
        table(spark, sf_dir, "lineitem").selectExpr(
            f"int({event}) AS event_no",
            "l_linenumber AS string",
            "int(l_partkey % 5 + 1) AS dom_number",
            "double(datediff(l_shipdate, DATE '1995-01-01')) AS dom_time",
            "CAST(l_quantity AS DECIMAL(12, 2)) AS charge",
            "int(l_quantity) % 2 AS hlc",
            "l_partkey AS part_key",
            "l_orderkey AS order_key",
            "l_extendedprice AS price",
            "l_discount AS discount",
            "l_tax AS tax",
        )
    )


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "int(o_orderkey) AS event_no",
        "22012 AS subdirectory_no",
        "int(o_orderkey % 3 + 1) AS part_no",
        "o_totalprice AS energy",
        "CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 0 END AS InteractionType",
        "int(o_orderkey % 2) AS MuonFilter_13",
        "2201200000 + o_custkey % 1000 AS RunID",
        "int(o_orderkey) AS EventID",
        "o_custkey % 32 / 10.0D AS zenith",
        "o_custkey % 63 / 10.0D AS azimuth",
        "CASE o_orderstatus WHEN 'O' THEN 'nu_e' WHEN 'F' THEN 'nu_mu' ELSE 'nu_tau' END AS flavour",
    )


def daughter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertex and direction per event; events of customers in debt have none."""
    customers = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    suffix = "_GNHighestEDaughter"
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("int(o_orderkey) AS event_no", "o_custkey AS c_custkey")
        .join(customers, "c_custkey")
        .selectExpr(
            "event_no",
            f"c_acctbal / 10.0D - 450 AS pos_x{suffix}",
            f"double(c_custkey * 37 % 1100 - 550) AS pos_y{suffix}",
            f"double(c_custkey * 53 % 1200 - 600) AS pos_z{suffix}",
            f"double(c_custkey % 7 - 3) AS dir_x{suffix}",
            f"double(c_custkey % 5 - 2) AS dir_y{suffix}",
            f"double(c_custkey % 3 - 1) AS dir_z{suffix}",
            f"CASE WHEN c_custkey % 4 = 0 THEN double('NaN') ELSE c_acctbal END AS energy{suffix}",
        )
    )


def clean_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw clean-event listing: all orders but those of low priority, urgent ones twice."""
    rows = table(spark, sf_dir, "orders").select(
        (F.lit(2201200000) + F.col("o_custkey") % 1000).alias("RunID"),
        F.col("o_orderkey").cast("int").alias("EventID"),
        F.col("o_orderpriority").alias("priority"),
    )
    listed, urgent = rows.where(F.col("priority") != "5-LOW"), rows.where(F.col("priority") == "1-URGENT")
    return listed.unionByName(urgent).drop("priority")


def geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensors seen in `events`, on a grid of 86 strings of 60; some are missing."""
    string = (F.col("user_id") % 86 + 1).cast("int")
    dom = (F.col("event_id") % 60 + 1).cast("int")
    seen = table(spark, sf_dir, "events").select(string.alias("string"), dom.alias("dom_number")).distinct()
    s, d = F.col("string"), F.col("dom_number")
    return seen.select(
        "string",
        "dom_number",
        ((s - 1) % 10 * F.lit(125.0) - 560.0).alias("dom_x"),
        (F.floor((s - 1) / 10) * F.lit(125.0) - 500.0).alias("dom_y"),
        (F.lit(500.0) - d * F.lit(17.0) - (d % 7) * F.lit(0.25) - s).alias("dom_z"),
    )


def doms(spark: SparkSession, sf_dir: str, event: str = "l_orderkey") -> DataFrame:
    """Sensor rows of `hits`: position, total charge, first time.

    An event has about as many sensors as hits, so adding up before the shuffle would only hold all rows in memory; after
    it, all that is counted per event finds its rows in one place.
    """
    keys = ["event_no", "string", "dom_number"]
    rows = hits(spark, sf_dir, event)
    totals = (
        rows.repartition(spread(rows), "event_no")
        .groupBy(*keys)
        .agg(F.sum("charge").cast("double").alias("Qtotal"), F.min("dom_time").alias("t1"))
    )
    return with_sensor_constants(totals).select(*keys, "dom_x", "dom_y", "dom_z", "Qtotal", "t1")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth with the daughter's columns, defaults filled in."""
    from pulsegrid.operators.truth import TRUTH_FEATURES, attach_side
    from pulsegrid.schema import SIDE_TABLES

    rows = attach_side(truth(spark, sf_dir), daughter(spark, sf_dir), SIDE_TABLES["daughter"])
    for feature in TRUTH_FEATURES:
        rows = feature(rows)
    return rows


def placed(spark: SparkSession, sf_dir: str, events_per_shard: int = 500) -> DataFrame:
    """Truth of events with hits: N_doms, shard and offset."""
    from pulsegrid.operators import truth as labels

    counted = truth(spark, sf_dir).join(labels.count_doms(hits(spark, sf_dir)), "event_no", "inner")
    return labels.shard_offsets(labels.with_shards(counted, events_per_shard))


def displaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as records near the sensors of `geometry`, off by some metres."""
    s, d = F.col("l_suppkey") % 86 + 1, F.col("l_partkey") % 60 + 1
    shift = (F.col("l_quantity") - 25) * F.lit(0.5)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        ((s - 1) % 10 * F.lit(125.0) - 560.0 + shift).alias("dom_x"),
        (F.floor((s - 1) / 10) * F.lit(125.0) - 500.0 - shift / 2).alias("dom_y"),
        (F.lit(500.0) - d * F.lit(17.0) - (d % 7) * F.lit(0.25) - s + F.lit(0.0625) * (F.col("l_quantity") - 25)).alias("dom_z"),
    )
