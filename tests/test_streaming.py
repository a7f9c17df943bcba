import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stratalake.operators.schema import SchemaMismatch, ddl
from stratalake.streaming import files as arrivals
from stratalake.streaming import schema_log

STUDENTS = "id_aluno bigint, process_date date, nome string"


def drop(spark, path, data, schema=STUDENTS, file_format="parquet"):
    frame = spark.createDataFrame(data, schema).withColumn("process_date", F.col("process_date").cast("date"))
    frame.coalesce(1).write.mode("append").format(file_format).option("header", True).save(path)


def drain(spark, folder, schema=STUDENTS, file_format="parquet"):
    stream = arrivals.file_stream(spark, f"{folder}/in", schema, file_format)
    arrivals.upsert_stream(stream, f"{folder}/out", f"{folder}/ckpt", "id_aluno")


TEXT = "id_aluno bigint, process_date string, nome string"


def test_append_reads_each_file_once(spark, folder):
    schema = ddl("a bigint")
    for n in (3, 4):
        spark.range(n).withColumnRenamed("id", "a").write.mode("append").parquet(f"{folder}/in")
        for _ in range(2):  # the second run finds nothing new
            arrivals.append_stream(arrivals.file_stream(spark, f"{folder}/in", schema), f"{folder}/out", f"{folder}/ckpt")
    assert spark.read.parquet(f"{folder}/out").count() == 7


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_upsert_keeps_latest_and_late_rows_win(spark, folder, file_format):
    drop(spark, f"{folder}/in", [(1, "2024-01-05", "old"), (1, "2024-01-09", "new"), (2, "2024-01-01", "b")], TEXT, file_format)
    drain(spark, folder, file_format=file_format)
    current = arrivals.current_rows(spark, f"{folder}/out", "id_aluno")
    assert rows(current, "id_aluno", "nome") == [(1, "new"), (2, "b")]
    drop(spark, f"{folder}/in", [(1, "2024-01-02", "late"), (3, "2024-01-01", "c")], TEXT, file_format)
    drain(spark, folder, file_format=file_format)
    drain(spark, folder, file_format=file_format)  # restart without new files
    read = dict(out=f"{folder}/out", keys="id_aluno")
    assert rows(arrivals.current_rows(spark, **read), "id_aluno", "nome") == [(1, "late"), (2, "b"), (3, "c")]
    guarded = arrivals.current_rows(spark, **read, ignore_late=True)
    assert rows(guarded, "id_aluno", "nome") == [(1, "new"), (2, "b"), (3, "c")]
    assert "ingestion_date" in guarded.columns and arrivals.BATCH not in guarded.columns


def test_rows_without_key_are_inserted(spark, folder):
    for name in ("x", "y"):
        drop(spark, f"{folder}/in", [(None, "2024-01-01", name)], TEXT)
        drain(spark, folder)
    assert rows(arrivals.current_rows(spark, f"{folder}/out", "id_aluno"), "nome") == [("x",), ("y",)]


def test_repeated_batch_replaces_itself(spark, folder):
    """A batch whose commit was lost runs again after a restart."""
    drop(spark, f"{folder}/in", [(1, "2024-01-01", "a")], TEXT)
    drain(spark, folder)
    drop(spark, f"{folder}/in", [(2, "2024-01-01", "b")], TEXT)
    drain(spark, folder)
    commits = f"{folder}/ckpt/commits"
    os.remove(f"{commits}/1")
    if os.path.exists(f"{commits}/.1.crc"):
        os.remove(f"{commits}/.1.crc")
    drain(spark, folder)
    stored = spark.read.parquet(f"{folder}/out/batches")
    assert rows(stored.groupBy(arrivals.BATCH).count()) == [(0, 1), (1, 1)]


def test_fold_batches(spark, folder):
    read = dict(out=f"{folder}/out", keys="id_aluno")
    drop(spark, f"{folder}/in", [(i, "2024-01-01", "a") for i in range(40)] + [(None, "2024-01-01", "n")], TEXT)
    drain(spark, folder)
    assert arrivals.fold_batches(spark, **read, buckets=4) == 0
    assert arrivals.fold_batches(spark, **read) is None
    drop(spark, f"{folder}/in", [(3, "2024-01-02", "b"), (3, "2023-01-01", "late")], TEXT)
    drain(spark, folder)
    want = rows(arrivals.current_rows(spark, **read), "id_aluno", "nome")
    assert (3, "b") in want and len(want) == 41
    assert arrivals.fold_batches(spark, **read) == 1
    assert rows(arrivals.current_rows(spark, **read), "id_aluno", "nome") == want
    assert len(os.listdir(f"{folder}/out/base/fold=1")) == 1 + 2  # one folder, the success mark and its checksum
    old = arrivals.superseded(spark, f"{folder}/out")
    assert len(old) == 2 and all("_batch_id=" in path for path in old)
    drop(spark, f"{folder}/in", [(3, "2024-01-01", "c"), (77, "2024-01-01", "new")], TEXT)
    drain(spark, folder)
    got = dict(rows(arrivals.current_rows(spark, **read), "id_aluno", "nome"))
    assert got[3] == "c" and got[77] == "new" and len(got) == 42
    assert dict(rows(arrivals.current_rows(spark, **read, ignore_late=True), "id_aluno", "nome"))[3] == "b"


def test_keyless_rows_of_one_batch_are_kept(spark, folder):
    drop(spark, f"{folder}/in", [(None, "2024-01-01", "x"), (None, "2024-01-01", "x"), (None, "2024-01-02", "y")], TEXT)
    drain(spark, folder)
    assert arrivals.current_rows(spark, f"{folder}/out", "id_aluno").count() == 3


def test_widened_types_on_the_same_checkpoint(spark, folder):
    """Whole numbers, then fractions, then text, each drop typed by all of its files."""
    drops = [
        [(1, "2024-01-01", "5"), (2, "2024-01-01", "6")],
        [(2, "2024-01-02", "2.5")],
        [(3, "2024-01-03", "none")],
    ]
    kinds = []
    for number, data in enumerate(drops):
        for row in data:  # a file each
            drop(spark, f"{folder}/in/{number}", [row], "id_aluno bigint, process_date string, val string", "csv")
        tracked = schema_log.track(spark, f"{folder}/in/{number}", f"{folder}/schema", "csv")
        kinds.append(tracked["val"].dataType.simpleString())
        stream = arrivals.file_stream(spark, f"{folder}/in/*", tracked, "csv")
        arrivals.upsert_stream(stream, f"{folder}/out", f"{folder}/ckpt", "id_aluno")
        if number == 1:
            got = arrivals.current_rows(spark, f"{folder}/out", "id_aluno")
            assert rows(got, "id_aluno", "val") == [(1, 5.0), (2, 2.5)]
    assert kinds == ["int", "double", "string"]
    got = rows(arrivals.current_rows(spark, f"{folder}/out", "id_aluno"), "id_aluno", "val")
    assert [k for k, _ in got] == [1, 2, 3] and got[2][1] == "none" and got[1][1] == "2.5"


def test_new_column_on_the_same_checkpoint(spark, folder):
    drop(spark, f"{folder}/in", [(1, "2024-01-01", "a"), (2, "2024-01-01", "b")], TEXT)
    log = f"{folder}/schema"
    drain(spark, folder, schema_log.track(spark, f"{folder}/in", log, "parquet"))
    drop(spark, f"{folder}/in", [(2, "2024-01-02", "b2", 7.5)], TEXT + ", nota double")
    tracked = schema_log.track(spark, f"{folder}/in", log, "parquet")
    assert tracked.names == ["id_aluno", "process_date", "nome", "nota"]
    assert schema_log.track(spark, f"{folder}/in", log, "parquet") == tracked == schema_log.load(spark, log)
    drain(spark, folder, tracked)
    got = arrivals.current_rows(spark, f"{folder}/out", "id_aluno")
    assert rows(got, "id_aluno", "nome", "nota") == [(1, "a", None), (2, "b2", 7.5)]


def test_csv_columns_may_only_be_appended(spark, folder):
    log = f"{folder}/schema"
    drop(spark, f"{folder}/one", [(1, "2024-01-01", "a")], TEXT, "csv")
    assert schema_log.track(spark, f"{folder}/one", log, "csv").names == ["id_aluno", "process_date", "nome"]
    drop(spark, f"{folder}/two", [(1, "2024-01-01", "a", 3)], TEXT + ", nota int", "csv")
    drop(spark, f"{folder}/two", [(1, "2024-01-01", "a")], TEXT, "csv")  # narrow and wide files together
    assert schema_log.track(spark, f"{folder}/two", log, "csv").simpleString().endswith("nota:int>")
    drop(spark, f"{folder}/three", [("a", "2024-01-01", 1)], "nome string, process_date string, id_aluno int", "csv")
    with pytest.raises(SchemaMismatch):
        schema_log.track(spark, f"{folder}/three", log, "csv")


def test_known_types_widen(spark):
    merged = schema_log.widened(ddl("a int, b string, d date"), ddl("b int, c double, a bigint, d timestamp"))
    assert merged == ddl("a bigint, b string, d timestamp, c double")
    assert schema_log.widened(ddl("a bigint"), ddl("a double")) == ddl("a string")  # no number keeps both


def test_csv_types_from_every_file(spark, folder):
    """The one fraction is in the last of many files; a quoted comma in the header is no column."""
    for i in range(30):
        value = "3.5" if i == 29 else str(i)
        with open_in(folder, f"{i:03}.csv") as file:
            file.write(f'id,"a, b",big,day,moment,flag,empty,long\n{value},x,{2**40 + i},2024-01-0{1 + i % 9},2024-01-01 10:00:0{i % 9},true,,{10**17}.5\n')
    found = schema_log.discover(spark, f"{folder}/csv", "csv")
    assert found.names[1] == "a, b"
    assert [f.dataType.simpleString() for f in found.fields] == ["double", "string", "bigint", "date", "timestamp", "boolean", "string", "string"]
    read = spark.read.option("header", True).schema(found).csv(f"{folder}/csv")
    assert read.where("id IS NULL OR big IS NULL OR day IS NULL OR moment IS NULL OR flag IS NULL").count() == 0


def open_in(folder, name):
    os.makedirs(f"{folder}/csv", exist_ok=True)
    return open(f"{folder}/csv/{name}", "w")


def test_csv_value_that_does_not_fit_fails(spark, folder):
    drop(spark, f"{folder}/in", [(1, "2024-01-01", "a")], TEXT, "csv")
    drain(spark, folder, file_format="csv")
    drop(spark, f"{folder}/in", [("one", "2024-01-01", "b")], "id_aluno string, process_date string, nome string", "csv")
    with pytest.raises(Exception, match="not a bigint: one"):
        drain(spark, folder, file_format="csv")
    assert rows(arrivals.current_rows(spark, f"{folder}/out", "id_aluno"), "nome") == [("a",)]


def test_only_a_missing_log_is_a_new_stream(spark, folder):
    assert schema_log.load(spark, f"{folder}/none") is None


def test_folds_list_only_what_counts(spark, folder, monkeypatch):
    """A fold lists the live folds, not all that ever were, and looks for touched folders in the new batches alone."""
    read = dict(out=f"{folder}/out", keys="id_aluno")
    listed = []
    inventory = arrivals.file_inventory
    monkeypatch.setattr(arrivals, "file_inventory", lambda s, path, *a: listed.append(path) or inventory(s, path, *a))
    for number in range(3):
        drop(spark, f"{folder}/in", [(i, "2024-01-01", f"v{number}") for i in range(40 + number)], TEXT)
        drain(spark, folder)
        listed.clear()
        assert arrivals.fold_batches(spark, **read, buckets=4) == number
        assert f"{folder}/out/base" not in listed
        assert [p for p in listed if "/base/" in p] == ([f"{folder}/out/base/fold={number - 1}"] if number else [])
    got = arrivals.current_rows(spark, **read)
    assert rows(got, "id_aluno", "nome") == sorted(((i, "v2") for i in range(42)), key=lambda t: (False, str(t[0])))
    assert arrivals._parts([{"fold": 0, "changed": [0, 1, 2]}, {"fold": 1, "changed": [2, 3]}]) == {0: [0, 1], 1: None}
