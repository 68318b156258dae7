"""Staged files: queries that write text files from the retail tables and load them.

Files go to a fresh run folder under the shared folder of the session.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import casts
from larder.operators.change_set import change_set
from larder.operators.quality import quarantine
from larder.plans.retail import Retail
from larder.registry.base import query
from larder.registry.capture import CHANGES_SQL, KEY, old_new
from larder.registry.revenue import yearly
from larder.registry.sqltext import YEARLY
from larder.session import run_dir
from larder.sources.csv_stage import (
    FILE_KEY, FILE_NAME, FILE_TS, LOADED_AT, content_keys, export_csv, load_abort_on_error, read_stage_csv, with_audit, with_file,
)
from larder.sources.manifest import copy_history, incremental_load, read_manifest, read_stage
from larder.schemas import CUSTOMER
from larder.streaming.loader import EntityLoader, consume, new_rows

ORDER_COLUMNS = ["orderid", "customerid", "status", "totalamount", "orderdate"]
ORDER_TEXT = """SELECT CAST(o_orderkey AS STRING) AS orderid, CAST(o_custkey AS STRING) AS customerid, o_orderstatus AS status,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS totalamount, substr(CAST(o_orderdate AS STRING), 1, 10) AS orderdate
FROM {orders}"""
TYPED_SQL = """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_amount, CAST(o_orderdate AS DATE) AS order_date FROM {orders}"""
FIRST = datetime(2024, 3, 1, 8, 0)
SECOND = datetime(2024, 3, 1, 9, 30)


def write_stage(rows: DataFrame, path: str, compression: str = "none") -> None:
    """Files as a source system would deliver them: header, quotes where needed, ``\\N`` for NULL."""
    rows.write.mode("append").options(header="true", escape='"', nullValue="\\N").csv(path, compression=compression)


def typed_orders(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select(
        *extra,
        casts.strict("orderid", "bigint").alias("order_id"),
        casts.strict("customerid", "bigint").alias("customer_id"),
        "status",
        casts.strict("totalamount", "decimal(18,2)").alias("total_amount"),
        casts.try_date("orderdate").alias("order_date"),
    )


@query(
    "csv_stage_scan",
    """SELECT CAST(c_custkey AS VARCHAR) AS customerid, c_name || ', "' || lower(c_mktsegment) || '"' AS name,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS preferences FROM {customer}""",
)
def csv_stage_scan(r: Retail) -> DataFrame:
    """Separators and quotes inside values, and NULLs, survive the round trip."""
    path = run_dir(r.spark, "csv-scan")
    write_stage(
        r.sql(
            """SELECT CAST(c_custkey AS STRING) AS customerid, c_name || ', "' || lower(c_mktsegment) || '"' AS name,
                 CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS preferences FROM {customer}"""
        ),
        path,
    )
    return read_stage_csv(r.spark, path, ["customerid", "name", "preferences"])


@query("positional_projection", TYPED_SQL)
def positional_projection(r: Retail) -> DataFrame:
    """The files call their columns c1 to c5; the declared names win by position."""
    path = run_dir(r.spark, "positional")
    write_stage(r.sql(ORDER_TEXT).toDF("c1", "c2", "c3", "c4", "c5"), path)
    return typed_orders(read_stage_csv(r.spark, path, ORDER_COLUMNS))


@query(
    "audit_columns",
    """SELECT o_orderstatus AS status, count(*) AS n_rows, count(*) AS n_named, count(*) AS n_dated, count(*) AS n_keyed,
         TIMESTAMP '2024-03-01 08:00:00' AS loaded_at FROM {orders} GROUP BY o_orderstatus""",
)
def audit_columns(r: Retail) -> DataFrame:
    """Rows whose file name, file time and content key were filled in, per status."""
    path = run_dir(r.spark, "audit files")
    write_stage(r.sql(ORDER_TEXT), path)
    rows = with_file(read_stage_csv(r.spark, path, ORDER_COLUMNS))
    audited = with_audit(rows, FIRST, content_keys(rows, ORDER_COLUMNS))
    return audited.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(FILE_NAME).endswith(".csv")).alias("n_named"),
        F.count(FILE_TS).alias("n_dated"),
        F.count_if(F.length(FILE_KEY) == 32).alias("n_keyed"),
        F.max(LOADED_AT).alias("loaded_at"),
    )


@query("load_abort_on_error", TYPED_SQL)
def abort_on_error(r: Retail) -> DataFrame:
    """A load that would stop at the first row with a wrong field count or a bad amount, and finds none."""
    path = run_dir(r.spark, "abort")
    write_stage(r.sql(ORDER_TEXT), path)
    rows = read_stage_csv(r.spark, path, ORDER_COLUMNS, strict_columns=True)
    return typed_orders(load_abort_on_error(rows, casts.try_decimal("totalamount", 18, 2).cast("string"), "totalamount"))


@query(
    "prefix_load",
    """SELECT 'folder' AS source, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS id_sum FROM {orders}
       UNION ALL SELECT 'file', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM {orders} WHERE o_orderstatus = 'F'""",
)
def prefix_load(r: Retail) -> DataFrame:
    """Everything below a folder, and one part of it alone."""
    path = run_dir(r.spark, "prefix")
    text = r.sql(ORDER_TEXT)
    for status in ("F", "O", "P"):
        write_stage(text.where(F.col("status") == status), f"{path}/day={status}")
    everything = read_stage_csv(r.spark, path, ORDER_COLUMNS, recursive=True)
    one_part = read_stage_csv(r.spark, f"{path}/day=F", ORDER_COLUMNS)

    def summary(name: str, df: DataFrame) -> DataFrame:
        ids = F.sum(F.col("orderid").cast("bigint"))
        return df.agg(F.count(F.lit(1)).alias("n_rows"), ids.alias("id_sum")).select(F.lit(name).alias("source"), "n_rows", "id_sum")

    return summary("folder", everything).unionByName(summary("file", one_part))


def _three_loads(r: Retail) -> str:
    """Delivered orders, then the same folder again with the open ones added, then by force."""
    path = run_dir(r.spark, "incremental")
    text = r.sql(ORDER_TEXT)
    args = (r.spark, "orders", f"{path}/in", ORDER_COLUMNS, f"{path}/stage", f"{path}/manifest")
    write_stage(text.where("status = 'F'"), f"{path}/in")
    incremental_load(*args, loaded_at=FIRST)
    write_stage(text.where("status <> 'F'"), f"{path}/in")
    incremental_load(*args, loaded_at=SECOND)
    incremental_load(*args, loaded_at=SECOND + timedelta(minutes=1))
    incremental_load(*args, loaded_at=SECOND + timedelta(minutes=2), force=True)
    return path


@query(
    "incremental_load",
    """SELECT TIMESTAMP '2024-03-01 08:00:00' AS load_ts, count(*) AS n_rows FROM {orders} WHERE o_orderstatus = 'F'
       UNION ALL SELECT TIMESTAMP '2024-03-01 09:30:00', count(*) FROM {orders} WHERE o_orderstatus <> 'F'
       UNION ALL SELECT TIMESTAMP '2024-03-01 09:32:00', count(*) FROM {orders}""",
)
def incremental(r: Retail) -> DataFrame:
    """Rows per load: only new files each time, nothing on a plain repeat, everything by force."""
    path = _three_loads(r)
    stage = read_stage(r.spark, f"{path}/stage", f"{path}/manifest", "orders")
    return stage.groupBy(F.col(LOADED_AT).alias("load_ts")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "copy_history",
    """SELECT TIMESTAMP '2024-03-01 09:30:00' AS load_ts, count(*) AS n_rows FROM {orders} WHERE o_orderstatus <> 'F'
       UNION ALL SELECT TIMESTAMP '2024-03-01 09:32:00', count(*) FROM {orders}""",
)
def history(r: Retail) -> DataFrame:
    """What the manifest says was loaded during the last hour."""
    path = _three_loads(r)
    manifest = read_manifest(r.spark, f"{path}/manifest")
    recent = copy_history(manifest, "orders", as_of=SECOND + timedelta(minutes=30), within=timedelta(hours=1))
    return recent.groupBy("load_ts").agg(F.sum("row_count").alias("n_rows"))


@query("ctas_snapshot", CHANGES_SQL)
def ctas_snapshot(r: Retail) -> DataFrame:
    """A change set frozen in a table of its own."""
    path = run_dir(r.spark, "snapshot")
    old, new = old_new(r)
    change_set(old, new, KEY).write.parquet(path)
    return r.spark.read.parquet(path)


@query(
    "quarantine_delete",
    """SELECT CAST(o_orderkey AS VARCHAR) AS orderid, false AS quarantined FROM {orders} WHERE o_orderstatus = 'F'
       UNION ALL SELECT CAST(NULL AS VARCHAR), false FROM {orders} WHERE o_orderstatus = 'O'
       UNION ALL SELECT o_orderkey || '|' || o_custkey || '|P', true FROM {orders} WHERE o_orderstatus = 'P'""",
)
def quarantine_query(r: Retail) -> DataFrame:
    """Rows that came with another delimiter are set aside; rows without an id stay."""
    path = run_dir(r.spark, "quarantine")
    write_stage(
        r.sql(
            """SELECT CASE o_orderstatus WHEN 'F' THEN CAST(o_orderkey AS STRING) WHEN 'O' THEN CAST(NULL AS STRING)
                 ELSE o_orderkey || '|' || o_custkey || '|P' END AS orderid, o_orderstatus AS status FROM {orders}"""
        ),
        path,
    )
    kept, bad = quarantine(read_stage_csv(r.spark, path, ["orderid", "status"]), F.col("orderid").like("%|%"))
    return kept.select("orderid", F.lit(False).alias("quarantined")).unionByName(
        bad.select("orderid", F.lit(True).alias("quarantined"))
    )


@query("csv_export", YEARLY)
def csv_export(r: Retail) -> DataFrame:
    """The yearly mart written as a CSV report and read back."""
    path = run_dir(r.spark, "export")
    report = yearly(r)
    export_csv(report, path, single_file=True)  # one row per year
    return r.spark.read.schema(report.schema).option("header", "true").csv(path)


# Streams --------------------------------------------------------------------


def _stream_twice(r: Retail) -> tuple[str, DataFrame]:
    """Consume a folder, add files, consume again; returns the folder and what each run got."""
    path = run_dir(r.spark, "stream")
    text = r.sql(ORDER_TEXT)

    def consume_as(run: int) -> None:
        def keep(batch: DataFrame, batch_id: int) -> None:
            batch.withColumn("run", F.lit(run)).write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")

        consume(new_rows(r.spark, f"{path}/in", ORDER_COLUMNS), f"{path}/checkpoint", keep)

    write_stage(text.where("status = 'F'"), f"{path}/in")
    consume_as(1)
    write_stage(text.where("status <> 'F'"), f"{path}/in")
    consume_as(2)
    consume_as(3)
    return path, r.spark.read.parquet(f"{path}/out")


@query(
    "append_only_stream",
    """SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS run, o_orderkey AS order_id, o_custkey AS customer_id,
         o_orderstatus AS status, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
         CAST(o_orderdate AS DATE) AS order_date FROM {orders}""",
)
def append_only_stream(r: Retail) -> DataFrame:
    """Each run gets exactly the rows that arrived since the one before."""
    _, got = _stream_twice(r)
    return typed_orders(got, "run")


@query(
    "stream_consume_once",
    """SELECT 'peeked' AS reader, count(*) AS n_rows FROM {orders} UNION ALL
       SELECT 'run 1', count(*) FROM {orders} WHERE o_orderstatus = 'F' UNION ALL
       SELECT 'run 2', count(*) FROM {orders} WHERE o_orderstatus <> 'F'""",
)
def stream_consume_once(r: Retail) -> DataFrame:
    """Consuming moves the position, peeking does not; the third run finds nothing."""
    path, got = _stream_twice(r)
    peeked = read_stage_csv(r.spark, f"{path}/in", ORDER_COLUMNS).agg(F.count(F.lit(1)).alias("n_rows"))
    runs = got.groupBy(F.concat(F.lit("run "), F.col("run")).alias("reader")).agg(F.count(F.lit(1)).alias("n_rows"))
    return peeked.select(F.lit("peeked").alias("reader"), "n_rows").unionByName(runs)


def _customers(r: Retail) -> EntityLoader:
    """Customers in three deliveries: most of them, then the rest with some changes, then all as they are."""
    path = run_dir(r.spark, "customers")
    loader = EntityLoader(r.spark, CUSTOMER, f"{path}/tables")
    text = """SELECT CAST(c_custkey AS STRING) AS customerid, c_name || CASE WHEN {changed} THEN ' *' ELSE '' END AS name,
        '900' AS mobile, 'a@b.example' AS email, 'app' AS loginbyusing, 'F' AS gender, '1990-01-01' AS dob,
        CAST(NULL AS STRING) AS anniversary, c_mktsegment AS preferences, '2024-01-01 00:00:00' AS createddate,
        '2024-01-0{day} 00:00:00' AS modifieddate FROM {customer} WHERE {rows}"""
    deliveries = (
        ("false", "c_mktsegment <> 'BUILDING'"),
        ("c_acctbal < 0", "c_mktsegment = 'BUILDING' OR c_acctbal < 0"),
        ("c_acctbal < 0", "true"),
    )
    for day, (changed, rows) in enumerate(deliveries, 1):
        wanted = text.replace("{changed}", changed).replace("{rows}", rows).replace("{day}", str(day))
        write_stage(r.sql(wanted), f"{path}/in")
        loader.run(f"{path}/in")
    return loader


@query(
    "entity_loader",
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name || CASE WHEN c_acctbal < 0 THEN ' *' ELSE '' END AS name,
         c_mktsegment AS preferences, CAST(CASE WHEN c_acctbal < 0 AND c_mktsegment <> 'BUILDING' THEN 2 ELSE 1 END AS BIGINT) AS versions,
         true AS numbered FROM {customer}""",
)
def entity_loader(r: Retail) -> DataFrame:
    """Clean customers and their dimension versions after three batches; each has one number of its own."""
    loader = _customers(r)
    clean, n = loader.clean(), F.count(F.lit(1))
    versions = loader.dimension().groupBy("customer_id").agg(n.alias("versions"))
    unique = clean.groupBy("customer_sk").agg(n.alias("_n"))
    rows = clean.join(versions, "customer_id").join(unique, "customer_sk")
    return rows.select("customer_id", "name", "preferences", "versions", (F.col("_n") == 1).alias("numbered"))
