import datetime as dt
import gzip
import os

import pytest
from pyspark.errors import PySparkException

from larder.functions import casts
from larder.sources.csv_stage import (
    content_keys, export_csv, keys_of_files, load_abort_on_error, read_stage_csv, resplit, with_audit, with_file,
)
from larder.sources.manifest import copy_history, history_from_stage, incremental_load, list_files, read_manifest, read_stage

NOW = dt.datetime(2024, 5, 1, 12)


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_quotes_nulls_short_and_long_rows(spark, tmp_path, rows):
    put(tmp_path / "in", "a.csv", 'X,Y,Z\n1,"a, ""b""",\\N\n2,short\n3,x,y,surplus\n')
    got = read_stage_csv(spark, str(tmp_path / "in"), ["id", "name", "note"])
    assert got.columns == ["id", "name", "note"]
    assert rows(got) == [("1", 'a, "b"', None), ("2", "short", None), ("3", "x", "y")]


def test_strict_columns_stop_the_load(spark, tmp_path):
    for text in ("h1,h2\n1\n", "h1,h2\n1,2,3\n"):
        path = put(tmp_path / str(len(text)), "a.csv", text)
        with pytest.raises(PySparkException):
            read_stage_csv(spark, path, ["a", "b"], strict_columns=True).collect()
    fine = put(tmp_path / "fine", "a.csv", "h1,h2\n1,2\n")
    assert read_stage_csv(spark, fine, ["a", "b"], strict_columns=True).collect() == [("1", "2")]


def test_bad_value_stops_the_load(spark, tmp_path):
    path = put(tmp_path, "a.csv", "h\n1\nx\n")
    rows = read_stage_csv(spark, path, ["n"])
    with pytest.raises(PySparkException, match="bad value in n: x"):
        load_abort_on_error(rows, casts.try_long("n"), "n").collect()


def test_embedded_line_breaks_need_the_option(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'h1,h2\n1,"two\nlines"\n')
    assert read_stage_csv(spark, path, ["a", "b"], multi_line=True).collect() == [("1", "two\nlines")]


def test_folder_glob_recursion_and_compression(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "h\n1\n")
    put(tmp_path / "in" / "deep", "b.csv", "h\n2\n")
    put(tmp_path / "in", "notes.txt", "h\n9\n")
    with gzip.open(tmp_path / "in" / "c.csv.gz", "wt") as f:
        f.write("h\n3\n")
    root = str(tmp_path / "in")
    assert sorted(r[0] for r in read_stage_csv(spark, root, ["n"], glob="*.csv*").collect()) == ["1", "3"]
    deep = read_stage_csv(spark, root, ["n"], glob="*.csv", recursive=True)
    assert sorted(r[0] for r in deep.collect()) == ["1", "2"]


def test_audit_columns_for_names_with_spaces(spark, tmp_path):
    root = tmp_path / "in dir"
    put(root, "first file.csv", "h1,h2\n1,a\n2,b\n")
    put(root, "second.csv", "h1,h2\n2,b\n1,a\n")
    put(root, "third.csv", "h1,h2\n1,a\n")
    scan = with_file(read_stage_csv(spark, str(root), ["n", "v"]))
    got = with_audit(scan, NOW, content_keys(scan, ["n", "v"])).collect()
    assert len(got) == 5
    keys = {r["_stg_file_name"]: r["_stg_file_md5"] for r in got}
    assert set(keys) == {"first file.csv", "second.csv", "third.csv"}
    # The key stands for the rows of a file, whatever their order.
    assert keys["first file.csv"] == keys["second.csv"] != keys["third.csv"]
    assert {r["_copy_data_ts"] for r in got} == {NOW}
    assert all(r["_stg_file_load_ts"] is not None for r in got)


def test_audit_works_on_strict_scans(spark, tmp_path):
    path = put(tmp_path, "a.csv", "h1,h2\n1,2\n")
    scan = with_file(read_stage_csv(spark, path, ["a", "b"], strict_columns=True))
    assert with_audit(scan, NOW, content_keys(scan, ["a", "b"])).first()["_stg_file_name"] == "a.csv"


def test_incremental_load_skips_force_reloads(spark, tmp_path):
    root = tmp_path / "in"
    args = (spark, "t", str(root), ["n"], str(tmp_path / "stage"), str(tmp_path / "manifest"))
    put(root, "a.csv", "h\n1\n2\n")
    assert [r["row_count"] for r in incremental_load(*args, loaded_at=NOW).collect()] == [2]
    hour = dt.timedelta(hours=1)
    assert incremental_load(*args, loaded_at=NOW + hour).collect() == []
    put(root, "b.csv", "h\n3\n")
    put(root, "a.csv", "h\n1\n2\n4\n")  # same name, other content: loaded again
    again = {r["_stg_file_name"]: r["row_count"] for r in incremental_load(*args, loaded_at=NOW + 2 * hour).collect()}
    assert again == {"a.csv": 3, "b.csv": 1}
    assert incremental_load(*args, loaded_at=NOW + 3 * hour, force=True).count() == 2
    manifest = read_manifest(spark, str(tmp_path / "manifest"))
    recent = copy_history(manifest, "t", NOW + 3 * hour, dt.timedelta(minutes=90))
    assert recent.count() == 4
    stage = read_stage(spark, str(tmp_path / "stage"), str(tmp_path / "manifest"), "t")
    assert stage.count() == 2 + 4 + 4
    assert history_from_stage(stage).where("_stg_file_name = 'b.csv'").first()["row_count"] == 2


def test_unchanged_files_are_not_opened_and_touched_ones_only_once(spark, tmp_path, monkeypatch):
    from larder.sources import manifest as module

    root = tmp_path / "in"
    args = (spark, "t", str(root), ["n"], str(tmp_path / "stage"), str(tmp_path / "manifest"))
    path = put(root, "a.csv", "h\n1\n2\n")
    put(root, "empty.csv", "h\n")
    incremental_load(*args, loaded_at=NOW)
    opened = []
    real = module.read_stage_csv
    monkeypatch.setattr(module, "read_stage_csv", lambda spark, paths, *a, **k: opened.append(paths) or real(spark, paths, *a, **k))
    assert incremental_load(*args, loaded_at=NOW + dt.timedelta(hours=1)).count() == 0
    assert opened == []  # the file without rows is known too
    os.utime(path, (1, 1))
    assert incremental_load(*args, loaded_at=NOW + dt.timedelta(hours=2)).count() == 0
    assert [len(p) for p in opened] == [1]
    assert list_files(spark, str(root)).count() == 2


def test_load_that_breaks_off_leaves_no_double_rows(spark, tmp_path, monkeypatch):
    from larder.sources import manifest as module

    root = tmp_path / "in"
    args = (spark, "t", str(root), ["n"], str(tmp_path / "stage"), str(tmp_path / "manifest"))
    put(root, "a.csv", "h\n1\n2\n")
    with monkeypatch.context() as m:
        m.setattr(module, "manifest_rows", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental_load(*args, loaded_at=NOW)
    assert incremental_load(*args, loaded_at=NOW + dt.timedelta(hours=1)).count() == 1
    assert sorted(r["n"] for r in read_stage(spark, args[4], args[5], "t").collect()) == ["1", "2"]


def test_export(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", you'), (2, None)], "id int, s string")
    path = str(tmp_path / "out")
    export_csv(df, path, single_file=True)
    back = spark.read.option("header", "true").option("escape", '"').csv(path).orderBy("id").collect()
    assert back == [("1", 'say "hi", you'), ("2", None)]


def digests(spark, folder):
    rows = with_file(spark.read.schema("v string").text(str(folder)))
    return {r["_stg_file_path"].rsplit("/", 1)[1]: r["_stg_file_md5"] for r in keys_of_files(rows).collect()}


def test_file_keys_stand_for_bytes_in_order(spark, tmp_path):
    lines = [f"{k},name {k % 7}" for k in range(2000)]
    text = "h1,h2\n" + "\n".join(lines) + "\n"
    texts = {
        "a.csv": text, "copy.csv": text, "other order.csv": "h1,h2\n" + "\n".join(reversed(lines)) + "\n",
        "two swapped.csv": text.replace("5,name 5\n6,name 6\n", "6,name 6\n5,name 5\n", 1), "no end.csv": text[:-1],
        "crlf.csv": text.replace("\n", "\r\n"), "glob [1]{x}*.csv": text + "1\n", "header.csv": "h1,h2\n", "empty.csv": "",
    }
    for name, content in texts.items():
        (tmp_path / name).write_bytes(content.encode())
    (tmp_path / "bytes.csv").write_bytes(b"h\n\xff\xfe\n")
    (tmp_path / "other bytes.csv").write_bytes(b"h\n\xfe\xff\n")
    whole = digests(spark, tmp_path)
    assert len(whole) == len(texts) + 1 and len(set(whole.values())) == len(whole) - 1
    assert whole["a.csv"] == whole["copy.csv"]
    os.utime(tmp_path / "a.csv", (1, 1))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")  # a dozen ranges for each file
    try:
        assert digests(spark, tmp_path) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_other_delimiters_are_cut_anew(spark, tmp_path):
    put(tmp_path / "in", "a.csv", 'h1|h2|h3\n1|"a|b"|\\N\n2|c, d|e\n3|x\n')
    got = resplit(read_stage_csv(spark, str(tmp_path / "in"), ["a", "b", "c"]), ["a", "b", "c"], "|")
    assert sorted(map(tuple, got.collect()), key=str) == [("1", "a|b", None), ("2", "c, d", "e"), ("3", "x", None)]
