"""Integrity checks of deliveries, batch by batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.plans.retail import Retail
from larder.registry.base import query
from larder.session import run_dir
from larder.streaming.key_index import KeyIndex

# Lines arrive by line number, so that the lines of an order come with different batches; orders and parts by turns of their key.
BATCHES = 3
SPAN = 50_000


def _key(name: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.LongType())])


@query(
    "check_unique_by_batch",
    "SELECT l_orderkey, l_suppkey, count(*) AS n FROM {lineitem} GROUP BY l_orderkey, l_suppkey HAVING count(*) > 1",
)
def check_unique_by_batch(r: Retail) -> DataFrame:
    """Suppliers that an order names twice, found as the lines arrive: all batches together give the check of the whole table."""
    lines = r.table("lineitem").select(F.col("l_orderkey").cast("bigint"), F.col("l_suppkey").cast("bigint"), "l_linenumber")
    keys = lines.drop("l_linenumber").schema
    index = KeyIndex(r.spark, run_dir(r.spark, "unique"), keys, ranges=64)
    found = []
    for batch in range(BATCHES):
        rows = lines.where(F.col("l_linenumber") % BATCHES == batch)
        found.append(index.duplicates(rows, batch))
        index.add(rows, batch)
    # A later count of a key holds the earlier ones.
    return reduce(DataFrame.unionByName, found).groupBy(*keys.names).agg(F.max("n").alias("n"))


@query(
    "check_foreign_key_by_batch",
    """WITH f AS (SELECT 'placed' AS fk, l_orderkey AS value FROM {lineitem} UNION ALL SELECT 'menu', l_partkey FROM {lineitem}),
         p AS (SELECT 'placed' AS fk, o_orderkey AS value FROM {orders} WHERE o_orderpriority <> '5-LOW'
               UNION ALL SELECT 'menu', p_partkey FROM {part} WHERE p_size < 50)
       SELECT fk, value, count(*) AS n FROM f WHERE value IS NOT NULL AND NOT EXISTS (SELECT 1 FROM p WHERE p.fk = f.fk AND p.value = f.value)
       GROUP BY fk, value""",
)
def check_foreign_key_by_batch(r: Retail) -> DataFrame:
    """References without a parent after all batches. Parents come late, and some never; what is open is asked again."""
    path = run_dir(r.spark, "references")
    parents = {
        "placed": r.table("orders").where("o_orderpriority <> '5-LOW'").select(F.col("o_orderkey").cast("bigint").alias("id")),
        "menu": r.table("part").where("p_size < 50").select(F.col("p_partkey").cast("bigint").alias("id")),
    }
    columns = {"placed": "l_orderkey", "menu": "l_partkey"}
    indexes = {name: KeyIndex(r.spark, f"{path}/{name}", _key("id"), span=SPAN) for name in parents}
    still = {name: r.spark.createDataFrame([], "value bigint, n bigint") for name in parents}
    for batch in range(BATCHES):
        lines = r.table("lineitem").where(F.col("l_linenumber") % BATCHES == batch)
        for name, index in indexes.items():
            index.add(parents[name].where(F.col("id") % BATCHES == batch), batch)
            both = index.missing(still[name], "value", batch).unionByName(index.missing(lines, columns[name], batch))
            place = f"{path}/open/{name}/batch={batch}"
            both.groupBy("value").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(place)
            still[name] = r.spark.read.schema("value bigint, n bigint").parquet(place)
    return reduce(DataFrame.unionByName, [rows.select(F.lit(name).alias("fk"), "value", "n") for name, rows in still.items()])
