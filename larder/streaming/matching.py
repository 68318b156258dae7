"""Changes of two streams that belong together, matched while they flow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larder.streaming.feed import existing
from larder.streaming.loader import consume


def match_streams(left: DataFrame, right: DataFrame, on: tuple[str, str], times: tuple[str, str], within: str, late: str) -> DataFrame:
    """Pairs of rows with equal keys ``on`` whose ``times`` are at most ``within`` apart, whichever comes first.

    Both sides wait for each other in the state of the join. A row leaves it when the watermark, the latest time seen on
    both sides less ``late``, shows that no partner can come any more; a row that is itself older than the watermark is not
    taken in. So the state holds the rows of the last ``within`` and ``late``, not the history. NULL keys and times match
    nothing. Column names of the two sides must differ.
    """
    def timed(side: DataFrame, key: str, time: str) -> DataFrame:
        return side.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)

    span, (a, b) = F.expr(f"INTERVAL {within}"), (F.col(t) for t in times)
    near = (F.col(on[0]) == F.col(on[1])) & (a >= b - span) & (a <= b + span)
    return timed(left, on[0], times[0]).join(timed(right, on[1], times[1]), near)


class MatchLog:
    """What ``match_streams`` finds, appended to plain Parquet batch by batch, each batch once."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def run(self, pairs: DataFrame, every: str | None = None) -> StreamingQuery:
        """Match what is there now; with ``every`` go on matching. A repeated batch replaces its own rows."""
        def keep(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self.root}/pairs/batch={batch_id}")

        return consume(pairs, f"{self.root}/checkpoint", keep, every)

    def pairs(self, schema) -> DataFrame:
        return existing(self.spark, f"{self.root}/pairs", schema, recursiveFileLookup="true")

    def counts(self, schema, *by: str) -> DataFrame:
        """Number of pairs per value of ``by``."""
        return self.pairs(schema).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
