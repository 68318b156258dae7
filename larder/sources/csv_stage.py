"""Staged CSV files: all-text scan, audit columns, load control."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.dates import moment
from larder.functions.keys import key_text

# The file format all staged files share.
CSV_OPTIONS = {
    "sep": ",",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "enforceSchema": "true",
    "mode": "PERMISSIVE",
}
CORRUPT = "_corrupt_record"

FILE_NAME = "_stg_file_name"
FILE_TS = "_stg_file_load_ts"
FILE_KEY = "_stg_file_md5"
LOADED_AT = "_copy_data_ts"
AUDIT_COLUMNS = (FILE_NAME, FILE_TS, FILE_KEY, LOADED_AT)
FILE_PATH = "_stg_file_path"


def stage_schema(columns: Sequence[str], with_corrupt: bool = False) -> T.StructType:
    """All-text schema in file order."""
    names = [*columns, CORRUPT] if with_corrupt else columns
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


def csv_options(multi_line: bool = False, glob: str | None = None, recursive: bool = False) -> dict[str, str]:
    options = dict(CSV_OPTIONS)
    if multi_line:  # one task per file, so only for files that need it
        options["multiLine"] = "true"
    if glob:
        options["pathGlobFilter"] = glob
    if recursive:
        options["recursiveFileLookup"] = "true"
    return options


def read_stage_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    strict_columns: bool = False,
    **options,
) -> DataFrame:
    """Files as text columns named by position; header names are ignored.

    ``path`` is a file, a folder (every file below it) or a list of either.
    Short rows are padded with NULL, surplus fields dropped. With
    ``strict_columns`` any row with a different field count stops the load when
    it is read. Files compressed by a known codec are read by their extension.
    """
    schema = stage_schema(columns, with_corrupt=strict_columns)
    reader = spark.read.schema(schema).options(**csv_options(**options))
    if not strict_columns:
        return reader.csv(path)
    rows = reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    stop = F.raise_error(F.concat(F.lit("wrong field count: "), F.col(CORRUPT)))
    first = F.when(F.col(CORRUPT).isNull(), F.col(columns[0])).otherwise(stop)
    return rows.withColumn(columns[0], first).drop(CORRUPT)


def load_abort_on_error(rows: DataFrame, typed: Column, name: str) -> DataFrame:
    """Add ``typed`` as column ``name``; a value it cannot convert ends the whole load.

    ``typed`` is a tolerant conversion; text that turns into NULL is the error.
    """
    source = F.col(name)
    stop = F.raise_error(F.concat(F.lit(f"bad value in {name}: "), source))
    return rows.withColumn(name, F.when(source.isNull() | typed.isNotNull(), typed).otherwise(stop))


def with_file(rows: DataFrame) -> DataFrame:
    """Add path, name and time of the source file; ``rows`` come straight from a scan."""
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias(FILE_PATH),
        F.url_decode(F.col("_metadata.file_name")).alias(FILE_NAME),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias(FILE_TS),
    )


def content_keys(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A digest per file of ``with_file`` rows.

    Rows are hashed where they are read and the hashes are added up, so a huge
    file is digested by many tasks and never passes through one. The digest
    identifies the rows of a file, not their order.
    """
    h = F.xxhash64(key_text(*columns))
    digest = F.concat_ws("|", F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h))
    return rows.groupBy(FILE_PATH).agg(F.md5(digest).alias(FILE_KEY))


HASHED_BITS = (1 << 48) - 1  # of a line's hash; so sums over ten billion lines fit a decimal
ROW_BITS = (1 << 33) - 1  # of a row number that Spark counts within a task


def literal_path(spark: SparkSession, url: str) -> str:
    """The path of a file as its metadata give it, safe to hand to a reader: decoded, and nothing in it is a pattern."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(url)).toString()
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def file_keys(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """A digest of the bytes of each file, by its path as the scan's metadata give it. Empty files have none.

    Every task reads the byte ranges that a scan hands out anyway and reduces each to one row: its number of lines, the sum
    of two hashes of its lines, and the sum of these hashes times the line's place in the range. Place sums shift with the
    lines before the range, so ranges are combined in order without looking at a line again: the digest does not depend on
    how a file was cut, and no task holds a file. It covers all bytes of all lines and their order; a file that was only
    copied or touched keeps its digest.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS))
    hashes = {"a": F.xxhash64("value"), "b": F.xxhash64("value", F.lit(1))}
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias(FILE_PATH), F.col("_metadata.file_size").alias("_size"),
        F.col("_metadata.file_block_start").alias("_start"), place.alias("_place"),
        *[h.bitwiseAND(F.lit(HASHED_BITS)).cast("decimal(15,0)").alias(n) for n, h in hashes.items()],
    )
    at = F.col("_place").cast("decimal(10,0)")
    ranges = lines.groupBy(FILE_PATH, "_size", "_start").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"),
        *[F.sum(n).alias(n) for n in hashes], *[F.sum(F.col(n) * at).alias(f"{n}_at") for n in hashes],
    )
    # One row for each range: a file of a terabyte has some thousands.
    before = Window.partitionBy(FILE_PATH).orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).cast("decimal(13,0)")
    placed = ranges.withColumn("_shift", shift)
    sums = [F.sum(n) for n in hashes] + [F.sum(F.col(f"{n}_at") + F.col("_shift") * F.col(n)) for n in hashes]
    digest = F.md5(F.concat_ws("|", "_size", F.sum("_n"), *sums))
    return placed.groupBy(FILE_PATH, "_size").agg(digest.alias(FILE_KEY)).drop("_size")


def keys_of_files(rows: DataFrame) -> DataFrame:
    """``file_keys`` of the files that ``with_file`` rows come from; for a batch of files, whose paths are listed."""
    spark = rows.sparkSession
    paths = [literal_path(spark, r[0]) for r in rows.select(FILE_PATH).distinct().collect()]  # the files of a batch
    if not paths:
        return spark.createDataFrame([], f"{FILE_PATH} string, {FILE_KEY} string")
    return file_keys(spark, paths)


def resplit(rows: DataFrame, columns: Sequence[str], delimiter: str) -> DataFrame:
    """Rows that came with another delimiter, cut anew: the text that the scan cut at commas is put together and parsed.

    Other columns stay. Text beyond the declared columns was cut off by the scan and is not found again.
    """
    fields = ", ".join(f"`{c}` string" for c in columns)
    options = {k: CSV_OPTIONS[k] for k in ("quote", "escape", "nullValue")} | {"sep": delimiter}
    parsed = F.from_csv(F.concat_ws(CSV_OPTIONS["sep"], *columns), fields, options)
    rest = [c for c in rows.columns if c not in columns]
    return rows.withColumn("_parsed", parsed).select(*[F.col(f"_parsed.{c}").alias(c) for c in columns], *rest)


def with_audit(rows: DataFrame, loaded_at: datetime | Column, keys: DataFrame) -> DataFrame:
    """Complete ``with_file`` rows with content key and load time.

    Only files listed in ``keys`` stay. Spark measures the list: a short one is
    broadcast, and with a long one the rows of a large file are split.
    """
    listed = keys.select(FILE_PATH, FILE_KEY)
    data = [c for c in rows.columns if c not in (FILE_PATH, *AUDIT_COLUMNS)]
    return (
        rows.join(listed, FILE_PATH)
        .withColumn(LOADED_AT, moment(loaded_at))
        .select(*data, FILE_PATH, *AUDIT_COLUMNS)
    )


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write with a header row. ``single_file`` is for reports of a few rows."""
    out = df.coalesce(1) if single_file else df
    out.write.option("header", "true").option("escape", '"').csv(path)
