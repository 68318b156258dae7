"""Mixing sources to target weights: weighted sampling without replacement by exponential keys, whole epochs first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.tables import checkpointed, written

WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), Fraction(3, 2), 2, 13
BROADCAST_SOURCES = 100_000
COARSE, FINE = 512, 4096  # buckets for each power of e, and buckets within one of those

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[!-@\[-`{-~]"  # ASCII digits and punctuation
UNITS = 1 << 52


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def prose_share(text: Column) -> Column:
    """A quality weight from the text alone: 1 without digits and punctuation, falling to 1/20 where they are a quarter."""
    symbols = F.regexp_count(text, F.lit(SYMBOL)).cast("double") / F.greatest(F.length(text), F.lit(1)).cast("double")
    return F.greatest(F.lit(0.05), F.lit(1.0) - F.lit(4.0) * symbols)


def exponential_key(doc_id: Column, text: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / weight with u in (0, 1) from a hash of seed, id and text: the least keys are a weighted sample.

    The chance to come first is in proportion to the weight, and so on among the rest. Equal on every run and machine.
    """
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(text.cast("binary")))
    number = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 13), 16, 10).cast("bigint")
    return -F.log((number.cast("double") + 0.5) / float(UNITS)) / weight


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds ``no``: the place of each source by code point, null last, from 0.

    Ranges of sources are sorted apart; only one row for each range goes through a single task.
    """
    order = F.col("source").asc_nulls_last()
    ranges = checkpointed(sources.repartitionByRange(order).withColumn("_range", F.spark_partition_id()))
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    return ranges.withColumn("_in", inside).join(offsets, "_range").select(*sources.columns, (F.col("_in") + F.col("_before")).alias("no"))


def _whole(number: int) -> Column:
    return F.lit(str(number)).cast("decimal(38,0)")


def targets(sources: DataFrame, weights: Sequence[int] | Mapping[str, int] = WEIGHTS, share: Fraction = SHARE, most: int = MOST) -> DataFrame:
    """What each source (source, source_size) gives: target, epochs (whole passes) and rest (words beyond them).

    Together the sources share ``share`` times all sizes by weight; a target stops at ``most`` times its source's size and
    the excess is shared anew among the others until none is above. ``weights`` repeat over the sources by code point, null
    last, or are given by name (0 if missing). The arithmetic is in whole numbers; ``target`` is rounded once.
    """
    if isinstance(weights, Mapping):
        named = [F.when(F.col("source") == name, int(weight)) for name, weight in weights.items()]
        rows = sources.withColumn("weight", F.coalesce(*named, F.lit(0)).cast("bigint"))
    else:
        cycle = F.array(*[F.lit(int(w)) for w in weights])
        rows = _ranked(sources).withColumn("weight", F.get(cycle, (F.col("no") % len(weights)).cast("int")).cast("bigint"))
    rows = checkpointed(rows.select("source", "source_size", "weight"))
    size, weight = (F.col(c).cast("decimal(38,0)") for c in ("source_size", "weight"))
    full, level, limit = F.lit(False), _whole(0), size * most
    capped, down = None, 1
    while True:
        now = rows.agg(
            F.coalesce(F.sum(size), F.lit(0)).alias("size"),
            F.coalesce(F.sum(F.when(full, size)), F.lit(0)).alias("capped"),
            F.coalesce(F.sum(F.when(~full, weight)), F.lit(0)).alias("free"),
            F.count_if(full).alias("n"),
        ).first()
        if now.n == capped or not now.free:
            break
        # What a weight of 1 gets only rises from round to round, so a source that is full stays full.
        capped, down = now.n, int(now.free) * share.denominator
        level = weight * _whole(int(now.size) * share.numerator - most * int(now.capped) * share.denominator)
        full = (level >= limit * _whole(down)) & (weight > 0)
    exact = F.when(full, limit.cast("double")).otherwise(level.cast("double") / float(down))
    reached = F.when(full, limit).otherwise(F.floor(level / _whole(down))).cast("bigint")
    some = F.greatest(F.col("source_size"), F.lit(1))
    return rows.select(
        "source", "source_size", exact.alias("target"), F.call_function("div", reached, some).alias("epochs"), (reached % some).alias("rest")
    )


def _measured(docs: DataFrame, weight: Column | None, seed: int, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    """doc_id, source, size, key and bucket (a step function of the key) of each document, and the columns ``more``.

    Buckets are even steps of ln(key): the logarithm of an exponential key spreads alike at every weight, so no bucket holds
    more than about one row in 1,400 of a source at the coarse steps and one in five million at the fine ones.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = F.coalesce(F.nanvl(weight.cast("double"), F.lit(0.0)), F.lit(0.0)) if weight is not None else prose_share(text)
    used = F.least(F.greatest(given, F.lit(1e-12)), F.lit(1e12))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"), words(text).alias("size"),
        exponential_key(F.col(id_col), text, used, seed).alias("key"), *more,
    )
    return rows.withColumn("bucket", F.floor(F.log("key") * float(COARSE * FINE)).cast("bigint"))


def _crossing(sizes: DataFrame, by: str) -> DataFrame:
    """Per source the first step ``by`` at which the running sum of ``n``, after ``before``, reaches ``rest``."""
    so_far = Window.partitionBy("source").orderBy(by)
    run = sizes.withColumn("_sum", F.col("before") + F.sum("n").over(so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    found = run.where((F.col("_sum") >= F.col("rest")) & (F.col("_sum") - F.col("n") < F.col("rest")))
    return found.select("source", "rest", by, (F.col("_sum") - F.col("n")).alias("before"))


def _with(rows: DataFrame, side: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the source, null being a source of its own; few sources are broadcast, by their measured number."""
    named = side.withColumnRenamed("source", "_source")
    if side.count() <= BROADCAST_SOURCES:
        named = F.broadcast(named)
    return rows.join(named, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def _plan(rows: DataFrame, weights, share: Fraction, most: int) -> DataFrame:
    """Per source what ``targets`` says, and at which step (``edge``), after how many words (``before``), the rest is met."""
    plan = checkpointed(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most))
    coarse = F.floor(F.col("bucket") / FINE).alias("coarse")
    open_sources = plan.where("rest > 0").select("source", "rest", F.lit(0).cast("bigint").alias("before"))
    steps = rows.groupBy("source", coarse).agg(F.sum("size").alias("n"))
    met = checkpointed(_crossing(_with(steps, open_sources), "coarse"))
    inside = _with(rows.select("source", "bucket", "size", coarse), met.withColumnRenamed("coarse", "_coarse")).where("coarse = _coarse")
    fine = inside.groupBy("source", "rest", "before", "bucket").agg(F.sum("size").alias("n"))
    edge = _crossing(fine, "bucket").select(F.col("source").alias("_s"), F.col("bucket").alias("edge"), "before")
    return checkpointed(plan.join(edge, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"))


def _taken(rows: DataFrame, plan: DataFrame, *more: str) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and the columns ``more`` of each row of ``_measured``."""
    placed = _with(rows, plan)
    result = ["doc_id", "source", "size", "source_size", "target", *more]
    settled = placed.where("edge IS NULL OR bucket <> edge").select(
        *result, (F.col("epochs") * F.col("size") + F.when(F.col("bucket") < F.col("edge"), F.col("size")).otherwise(0)).alias("taken")
    )
    alike = placed.where("bucket = edge").groupBy(*result, "epochs", "rest", "before", "key").agg(F.count("*").alias("n"))
    order = ["key", F.col("doc_id").asc_nulls_last(), "size"]
    earlier = Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("rest") - F.col("before") - F.coalesce(F.sum(F.col("n") * F.col("size")).over(earlier), F.lit(0))
    each = alike.withColumn("_left", left).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    part = F.least(F.greatest(F.col("_left") - F.col("_i") * F.col("size"), F.lit(0)), F.col("size"))
    return settled.union(each.select(*result, (F.col("epochs") * F.col("size") + part).alias("taken")))


def mixture(
    docs: DataFrame,
    weights: Sequence[int] | Mapping[str, int] = WEIGHTS,
    share: Fraction = SHARE,
    most: int = MOST,
    weight: Column | None = None,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How many words of each document the mix takes: (doc_id, source, size, source_size, target, taken).

    Every document of a source is taken as often as its target holds the whole source. What is left of the target goes to
    documents in the order of their exponential keys (``exponential_key``, scaled by ``weight``: the document's quality,
    ``prose_share`` if none is given), each in whole until the running sum of sizes meets the target; the document at which
    it does gives its first words only, so a source's taken words are its target, rounded down.

    Nulls: a null text has no words, a null source is a source, null ids are told apart by their texts; a weight that is
    null, NaN or below 1e-12 counts as 1e-12. Documents without words take none. Equal keys are ordered by id and size; rows
    equal in all of these are interchangeable. An empty table gives no rows. Other columns are not looked at.

    Nothing is sorted as a whole. Sizes are summed by steps of the key, the running sum over those finds the step at which
    the target is met, first among coarse, then among fine ones, and only the rows of that step are sorted, so a source with
    a third of all rows needs no task of its own.
    """
    rows = written(_measured(docs, weight, seed, id_col, text_col, source_col), "mix")
    return _taken(rows, _plan(rows, weights, share, most))


def mixed_texts(
    docs: DataFrame,
    weights: Sequence[int] | Mapping[str, int] = WEIGHTS,
    share: Fraction = SHARE,
    most: int = MOST,
    weight: Column | None = None,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mix itself: (doc_id, source, text), one row for each time a text is taken. Same rules as ``mixture``.

    A document of which only a part is taken comes with that many first words, joined by spaces. Texts are not shuffled, but
    for those at which a target is met.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    rows = written(_measured(docs, weight, seed, id_col, text_col, source_col), "mix")
    whole = _measured(docs, weight, seed, id_col, text_col, source_col, text)
    taken = _taken(whole, _plan(rows, weights, share, most), "text").where("taken > 0")
    beyond = (F.col("taken") % F.col("size")).cast("int")
    first = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, beyond), " ")
    part = F.when(beyond > 0, F.array(first)).otherwise(F.array().cast("array<string>"))
    copies = F.concat(F.array_repeat("text", F.call_function("div", "taken", "size").cast("int")), part)
    return taken.select("doc_id", "source", F.explode(copies).alias("text"))


SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM documents
), k AS (
  SELECT doc_id, source, size, -ln((CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(t)), 1, 13) AS BIGINT) + 0.5::DOUBLE)
      / {UNITS}::DOUBLE) / greatest(0.05::DOUBLE, 1.0::DOUBLE - 4.0::DOUBLE * (CAST(length(t) - length(regexp_replace(t, '{SYMBOL}', '', 'g')) AS DOUBLE)
      / CAST(greatest(length(t), 1) AS DOUBLE))) AS key FROM d
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM k GROUP BY source
), f AS (
  SELECT *, coalesce(sum(source_size) OVER before, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS free,
    row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS no FROM s
  WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT *, (3 * (SELECT sum(source_size) FROM s) - 4 * capped) AS up, 2 * free AS down FROM f
), level AS (
  SELECT no, up, down FROM l WHERE weight * up < 2 * source_size * down ORDER BY no LIMIT 1
), p AS (
  SELECT s.source, s.source_size, CASE WHEN l.no < v.no OR v.no IS NULL THEN CAST(2 * s.source_size AS DOUBLE) ELSE CAST(l.weight * v.up AS DOUBLE) / CAST(v.down AS DOUBLE) END AS target,
    CASE WHEN l.no < v.no OR v.no IS NULL THEN 2 * s.source_size ELSE CAST((l.weight * v.up) // v.down AS BIGINT) END AS words
  FROM s JOIN l ON s.source IS NOT DISTINCT FROM l.source LEFT JOIN level v ON true
)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0 ELSE (words // source_size) * size
    + least(greatest(words % source_size - coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0), size)
  END AS BIGINT) AS taken
FROM k JOIN p ON k.source IS NOT DISTINCT FROM p.source
"""
