"""Decks, lists, cards and prices bound to the given tables, as DataFrames and as SQL of the same rows.

A deck is an order, its archetype the customer's nation, its format the region; deck lines are line items joined to
parts, summed per name and board; the place comes from the priority's leading digit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.functions import text
from gleaner.session import spread, table

#: The fixed clocks of orders and of events.
NOW, EVENTS_NOW = "1998-07-01 00:00:00", "2024-01-30 00:00:00"


def decks(spark: SparkSession, d: str) -> DataFrame:
    """deck_id, player, archetype, format, ts, place, published, kind, prestige."""
    geo = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    people = table(spark, d, "customer").join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = table(spark, d, "orders").join(people, F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(
        F.col("o_orderkey").alias("deck_id"),
        F.col("c_name").alias("player"),
        F.col("n_name").alias("archetype"),
        F.col("r_name").alias("format"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("place"),
        (F.col("o_orderstatus") == "F").alias("published"),
        F.col("c_mktsegment").alias("kind"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", 3).when(F.col("c_mktsegment") == "BUILDING", 2).otherwise(1).alias("prestige"),
    )


DECKS = """decks AS (
  SELECT o_orderkey AS deck_id, c_name AS player, n_name AS archetype, r_name AS format, CAST(o_orderdate AS TIMESTAMP) AS ts, CAST(left(o_orderpriority, 1) AS INTEGER) AS place,
    o_orderstatus = 'F' AS published, c_mktsegment AS kind, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 3 WHEN 'BUILDING' THEN 2 ELSE 1 END AS prestige
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


def lines(spark: SparkSession, d: str, each: int = 500_000) -> DataFrame:
    """deck_id, board (main or side), slug, name, qty: one row per deck, board and name.

    Lines are dealt by deck, about `each` a task and in more tasks the more there are, so that what groups or joins them by deck needs
    no other shuffle and a task holds no more of a larger table.
    """
    parts = table(spark, d, "part").select("p_partkey", "p_name", text.ascii_slug(F.col("p_name")).alias("slug"))
    of = table(spark, d, "lineitem")
    rows = of.select("l_orderkey", "l_partkey", "l_linestatus", "l_quantity").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    rows = spread(rows.select("l_orderkey", "l_linestatus", "p_name", "slug", "l_quantity"), of.count(), "l_orderkey", each=each)
    board = F.when(F.col("l_linestatus") == "F", "main").otherwise("side")
    return rows.groupBy(F.col("l_orderkey").alias("deck_id"), board.alias("board"), F.col("p_name").alias("name"), "slug").agg(F.sum("l_quantity").cast("bigint").alias("qty"))


LINES = """lines AS (
  SELECT l_orderkey AS deck_id, CASE WHEN l_linestatus = 'F' THEN 'main' ELSE 'side' END AS board, p_name AS name, CAST(sum(l_quantity) AS BIGINT) AS qty,
    trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3
)"""


def catalog(spark: SparkSession, d: str) -> DataFrame:
    """One row per slug, that of the smallest part: slug, name, kind, brand, price, colors."""
    from gleaner.operators.priority import first_per_key

    rows = table(spark, d, "part").withColumn("slug", text.ascii_slug(F.col("p_name")))
    first = first_per_key(rows, ["slug"], [F.col("p_partkey")])
    return first.select("slug", F.col("p_name").alias("name"), F.col("p_type").alias("kind"), F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price"), (F.col("p_size") % 5).cast("int").alias("color"))


CATALOG = """catalog AS (
  SELECT slug, p_name AS name, p_type AS kind, p_brand AS brand, p_retailprice AS price, CAST(p_size % 5 AS INTEGER) AS color
  FROM (SELECT *, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug, row_number() OVER (PARTITION BY trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') ORDER BY p_partkey) AS k FROM part) WHERE k = 1
)"""


def prices(spark: SparkSession, d: str) -> DataFrame:
    """printing, card, day, cents: the least unit price of a part on a ship date."""
    rows = table(spark, d, "lineitem").join(table(spark, d, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    cents = F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("bigint")
    return rows.groupBy(F.col("p_partkey").alias("printing"), F.col("p_name").alias("card"), F.to_date("l_shipdate").alias("day")).agg(F.min(cents).alias("cents"))


PRICES = """prices AS (
  SELECT p_partkey AS printing, p_name AS card, CAST(l_shipdate AS DATE) AS day, min(CAST(floor(l_extendedprice / l_quantity) AS BIGINT)) AS cents
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3
)"""
