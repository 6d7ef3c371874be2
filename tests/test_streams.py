from datetime import datetime

from pyspark.sql import types as T

from landing import price_file, price_line
from rows import rows_of
from tidemill.operators.keyed_table import KeyedTable
from tidemill.operators.latest import latest_per_key, newest_first
from tidemill.plans.fuel_prices import SOURCE
from tidemill.plans.ingest import ingest
from tidemill.plans.warehouse import Warehouse
from tidemill.streaming.file_stream import ingest_stream
from tidemill.streaming.latest_stream import upsert_stream

EVENTS = T.StructType(
    [T.StructField("k", T.StringType()), T.StructField("ts", T.LongType()), T.StructField("v", T.StringType())]
)


def run_files(spark, tmp_path, warehouse, **options):
    incoming = str(tmp_path / "incoming" / SOURCE.name)
    query = ingest_stream(spark, SOURCE, incoming, warehouse, str(tmp_path / "checkpoint"), **options)
    query.awaitTermination()
    return query


def loaded(spark, warehouse):
    return rows_of(warehouse.read_raw(spark, SOURCE).drop("ingestion_ts", "batch_id"))


def test_stream_equals_batch_file_by_file_and_after_a_restart(spark, tmp_path):
    incoming = tmp_path / "incoming"
    stream, batch = Warehouse(str(tmp_path / "stream")), Warehouse(str(tmp_path / "batch"))
    for i in range(3):
        price_file(incoming, "2025-01", f"{i}.csv", [price_line(cnpj=str(i)), price_line(cnpj=f"{i}x")])
    price_file(incoming, "2024-02", "twin.csv", [price_line(cnpj="0"), price_line(cnpj="0x")])
    run_files(spark, tmp_path, stream, files_per_trigger=1)
    ingest(spark, SOURCE, str(incoming), batch, datetime(2025, 7, 1))
    assert len(loaded(spark, stream)) == 6
    assert stream.read_ledger(spark, SOURCE).count() == 3
    columns = [f"`{c.name}`" for c in SOURCE.columns]
    assert rows_of(stream.read_raw(spark, SOURCE), *columns) == rows_of(batch.read_raw(spark, SOURCE), *columns)

    run_files(spark, tmp_path, stream, files_per_trigger=1)
    price_file(incoming, "2025-02", "new.csv", [price_line(cnpj="9")])
    run_files(spark, tmp_path, stream)
    assert len(loaded(spark, stream)) == 7


def test_a_lost_checkpoint_loads_nothing_twice(spark, tmp_path):
    price_file(tmp_path / "incoming", "2025-01", "a.csv", [price_line()])
    warehouse = Warehouse(str(tmp_path / "wh"))
    run_files(spark, tmp_path, warehouse)
    before = loaded(spark, warehouse)
    incoming = str(tmp_path / "incoming" / SOURCE.name)
    ingest_stream(spark, SOURCE, incoming, warehouse, str(tmp_path / "other")).awaitTermination()
    assert loaded(spark, warehouse) == before


def test_archive_moves_every_file_in_the_same_run(spark, tmp_path):
    for i in range(3):
        price_file(tmp_path / "incoming", "2025-01", f"{i}.csv", [price_line(cnpj=str(i))])
    warehouse = Warehouse(str(tmp_path / "wh"))
    run_files(spark, tmp_path, warehouse, files_per_trigger=2, archive_root=str(tmp_path / "done"))
    assert sorted(p.name for p in (tmp_path / "done").rglob("*.csv")) == ["0.csv", "1.csv", "2.csv"]
    assert list((tmp_path / "incoming").rglob("*.csv")) == []
    assert len(loaded(spark, warehouse)) == 3
    run_files(spark, tmp_path, warehouse, files_per_trigger=2, archive_root=str(tmp_path / "done"))
    assert len(loaded(spark, warehouse)) == 3


def test_a_move_that_fails_once_is_done_by_the_next_run(spark, tmp_path):
    for i in range(2):
        price_file(tmp_path / "incoming", "2025-01", f"{i}.csv", [price_line(cnpj=str(i))])
    price_file(tmp_path / "incoming", "2025-02", "twin.csv", [price_line(cnpj="0")])
    warehouse, done = Warehouse(str(tmp_path / "wh")), tmp_path / "done"
    done.write_text("a file where a folder should be")
    run_files(spark, tmp_path, warehouse, archive_root=str(done))
    assert len(list((tmp_path / "incoming").rglob("*.csv"))) == 3 and len(loaded(spark, warehouse)) == 2
    done.unlink()
    price_file(tmp_path / "incoming", "2025-02", "new.csv", [price_line(cnpj="9")])
    run_files(spark, tmp_path, warehouse, archive_root=str(done))
    assert sorted(p.name for p in done.rglob("*.csv")) == ["0.csv", "1.csv", "new.csv", "twin.csv"]
    assert list((tmp_path / "incoming").rglob("*.csv")) == [] and len(loaded(spark, warehouse)) == 3


def test_a_small_batch_writes_only_its_own_rows(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "latest"), EVENTS, "k", ("ts", "v"))
    table.replace(spark.range(5000).selectExpr("CAST(id AS STRING) AS k", "1L AS ts", "'old' AS v"), 0)
    for number in (1, 2):
        table.append(spark.createDataFrame([("7", number + 1, f"new {number}"), ("7", 0, "late")], EVENTS), number)
    written = [spark.read.parquet(path).count() for path in table.deltas(spark)]
    assert written == [1, 1] and table.mark(spark) == 2
    assert table.read(spark).count() == 5000
    assert rows_of(table.read(spark).where("k = '7'")) == [("7", 3, "new 2")]
    before = rows_of(table.read(spark))
    table.compact(spark)
    assert table.deltas(spark) == [] and rows_of(table.read(spark)) == before
    assert table.expire(spark) == 3
    assert rows_of(table.read(spark)) == before and table.mark(spark) == 2


def test_latest_over_a_stream_equals_the_batch(spark, tmp_path):
    folder = str(tmp_path / "events")
    parts = [[("a", 1, "x"), ("b", 5, "x")], [("a", 3, "y"), ("a", 2, "z")], [("b", 4, "late"), ("c", 1, "x")]]
    table = KeyedTable(str(tmp_path / "latest"), EVENTS, "k", ("ts", "v"))
    for part in parts:
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(folder)
        rows = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(folder)
        upsert_stream(rows, table, str(tmp_path / "checkpoint")).awaitTermination()
    everything = spark.read.parquet(folder)
    assert rows_of(table.read(spark)) == rows_of(latest_per_key(everything, "k", newest_first(["ts", "v"])))
    assert rows_of(table.read(spark)) == [("a", 3, "y"), ("b", 5, "x"), ("c", 1, "x")]


def stream_of(spark, folder, files=1):
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(folder)


def add_file(spark, folder, rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(folder)


def newest(df):
    return rows_of(latest_per_key(df, "k", newest_first(["ts", "v"])))


def test_a_late_or_equal_row_writes_nothing(spark, tmp_path):
    folder, table = str(tmp_path / "events"), KeyedTable(str(tmp_path / "latest"), EVENTS, "k", ("ts", "v"))
    add_file(spark, folder, [("a", 5, "x"), ("b", 5, "x"), ("hot", 1, "x")])
    upsert_stream(stream_of(spark, folder), table, str(tmp_path / "checkpoint")).awaitTermination()
    add_file(spark, folder, [("a", 4, "late"), ("b", 5, "x"), ("a", 5, "w")])
    add_file(spark, folder, [("hot", n, "y") for n in range(2, 50)] + [("a", 1, "late")])
    upsert_stream(stream_of(spark, folder), table, str(tmp_path / "checkpoint")).awaitTermination()
    written = [rows_of(spark.read.parquet(path)) for path in reversed(table.deltas(spark))]
    assert written == [[("a", 5, "x"), ("b", 5, "x"), ("hot", 1, "x")], [("hot", 49, "y")]]


def test_a_fresh_checkpoint_into_the_same_table_loses_nothing(spark, tmp_path):
    folder, table = str(tmp_path / "events"), KeyedTable(str(tmp_path / "latest"), EVENTS, "k", ("ts", "v"))
    add_file(spark, folder, [("a", 1, "x"), ("b", 5, "x")])
    add_file(spark, folder, [("a", 3, "y")])
    upsert_stream(stream_of(spark, folder), table, str(tmp_path / "one")).awaitTermination()
    other = str(tmp_path / "others")
    add_file(spark, other, [("c", 1, "x"), ("b", 4, "late"), ("a", 9, "z")])
    upsert_stream(stream_of(spark, other), table, str(tmp_path / "two")).awaitTermination()
    want = newest(spark.read.parquet(folder).union(spark.read.parquet(other)))
    assert rows_of(table.read(spark)) == want
    table.compact(spark)
    upsert_stream(stream_of(spark, folder), table, str(tmp_path / "three")).awaitTermination()
    assert rows_of(table.read(spark)) == want


def test_a_repeated_micro_batch_is_added_once(spark, tmp_path):
    folder, table = str(tmp_path / "events"), KeyedTable(str(tmp_path / "latest"), EVENTS, "k", ("ts", "v"))
    add_file(spark, folder, [("a", 1, "x")])
    upsert_stream(stream_of(spark, folder), table, str(tmp_path / "checkpoint")).awaitTermination()
    add_file(spark, folder, [("a", 2, "y")])
    upsert_stream(stream_of(spark, folder), table, str(tmp_path / "checkpoint")).awaitTermination()
    for commit in (tmp_path / "checkpoint" / "commits").glob("*1*"):  # as after a crash before the commit
        commit.unlink()
    upsert_stream(stream_of(spark, folder), table, str(tmp_path / "checkpoint")).awaitTermination()
    assert len(table.deltas(spark)) == 2 and rows_of(table.read(spark)) == [("a", 2, "y")]


def test_keys_of_several_columns_with_nulls(spark, tmp_path):
    folder, table = str(tmp_path / "events"), KeyedTable(str(tmp_path / "latest"), EVENTS, ("k", "v"), ("ts",))
    parts = [[("a", 1, None), (None, 1, "x")], [("a", 3, None), (None, None, "x")], [("a", 2, "x")]]
    for part in parts:
        add_file(spark, folder, part)
    upsert_stream(stream_of(spark, folder), table, str(tmp_path / "checkpoint")).awaitTermination()
    assert rows_of(table.read(spark)) == sorted([("a", 3, None), (None, 1, "x"), ("a", 2, "x")], key=repr)
