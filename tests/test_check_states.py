from datetime import date

from pyspark.sql import functions as F, types as T

from rows import rows_of
from tidemill.operators import check_states
from tidemill.operators.check_states import run_stored_checks
from tidemill.operators.keyed_table import KeyedTable
from tidemill.operators.quality import accepted_values, between, not_null, run_checks, unique

SCHEMA = T.StructType(
    [
        T.StructField("k", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("ts", T.LongType()),
        T.StructField("v", T.StringType()),
    ]
)
CHECKS = (not_null("v"), accepted_values("v", ["a", "b"]), between("ts", 0, 50), unique("k"))


def table_at(path):
    return KeyedTable(str(path), SCHEMA, "k", ("ts", "v"), lambda: F.date_format("day", "yyyy-MM"))


def batch(spark, keys, ts):
    rows = [(f"k{i}", None if i % 11 == 0 else date(2025, 1 + i % 5, 1), ts + i % 7, ("a", "b", "x", "y", None)[(i + ts) % 5]) for i in keys]
    return spark.createDataFrame(rows, SCHEMA)


def test_folded_reports_equal_full_ones_and_read_only_new_slices(spark, tmp_path, monkeypatch):
    table, read = table_at(tmp_path / "t"), []
    units = KeyedTable.read_units
    monkeypatch.setattr(KeyedTable, "read_units", lambda self, s, which: read.append(sorted(which)) or units(self, s, which))
    same = lambda: rows_of(run_stored_checks(spark, table, CHECKS)) == rows_of(run_checks(table.read(spark), CHECKS))
    assert same()
    table.replace(batch(spark, range(100), 48), 1)
    assert same() and len(read[-1]) == 6
    table.merge(batch(spark, [3, 8, 13], 60), 2)  # all of one month
    assert same() and [name for _, name in read[-1]] == ["2025-04"]
    before = len(read)
    assert same() and len(read) == before
    table.merge(batch(spark, [0, 11], 70), 3)
    assert same() and [name for _, name in read[-1]] == ["__HIVE_DEFAULT_PARTITION__"]
    table.expire(spark)
    assert same()
    assert rows_of(run_stored_checks(spark, table, CHECKS[:2])) == rows_of(run_checks(table.read(spark), CHECKS[:2]))


def test_repeated_keys_of_a_slice_are_counted(spark, tmp_path):
    table = table_at(tmp_path / "t")
    table._publish(batch(spark, range(20), 1).union(batch(spark, [4, 4, 7], 2)), 1, "full")
    report = {r["check_name"]: (r["failures"], r["failing_rows"]) for r in run_stored_checks(spark, table, CHECKS).collect()}
    assert report["unique"] == (2, 5)


def test_pending_deltas_and_other_unique_columns_are_read_whole(spark, tmp_path, monkeypatch):
    table = table_at(tmp_path / "t")
    table.replace(batch(spark, range(30), 1), 1)
    table.append(batch(spark, [1, 40], 90), 2)
    monkeypatch.setattr(check_states, "refresh_states", lambda *a: 1 / 0)
    assert rows_of(run_stored_checks(spark, table, CHECKS)) == rows_of(run_checks(table.read(spark), CHECKS))
    table.compact(spark)
    others = (*CHECKS, unique("v"))
    assert rows_of(run_stored_checks(spark, table, others)) == rows_of(run_checks(table.read(spark), others))


def test_an_unfinished_run_of_states_is_ignored(spark, tmp_path):
    table = table_at(tmp_path / "t")
    table.replace(batch(spark, range(30), 1), 1)
    first = rows_of(run_stored_checks(spark, table, CHECKS))
    (folder,) = (tmp_path / "t" / "_checks").iterdir()
    (folder / "run=7").mkdir()
    assert rows_of(run_stored_checks(spark, table, CHECKS)) == first
