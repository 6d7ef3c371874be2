import random
from datetime import date

import pytest
from pyspark.sql import functions as F, types as T

from rows import rows_of
from tidemill.contracts import resolve_namespace
from tidemill.operators import upsert
from tidemill.operators.keyed_table import KeyedTable
from tidemill.operators import latest
from tidemill.operators.latest import latest_of_stored, latest_per_key, newest_first
from tidemill.sources.periods import resolve_periods, rows_of_period
from tidemill.storage import glob_paths, scratch_dir

SCHEMA = T.StructType(
    [
        T.StructField("k", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("ts", T.LongType()),
        T.StructField("v", T.StringType()),
    ]
)
ORDER = ("ts", "v", "day")


def table_at(path, slice_of=lambda: F.date_format("day", "yyyy-MM")):
    return KeyedTable(str(path), SCHEMA, "k", ORDER, slice_of)


def sample(n, seed):
    """Rows whose day is a function of the key; one key holds a third of them."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        key = 0 if rng.random() < 0.33 else rng.randrange(60)
        day = None if key == 7 else date(2025, 1 + key % 5, 1 + key % 28)
        rows.append((f"k{key}", day, rng.randrange(40), rng.choice("abc")))
    return rows


def brute_latest(rows):
    best = {}
    for row in rows:
        if row[0] not in best or (row[2], row[3]) > (best[row[0]][2], best[row[0]][3]):
            best[row[0]] = row
    return sorted(best.values(), key=repr)


def test_latest_matches_brute_force_with_a_hot_key(spark):
    rows = sample(2000, 1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert rows_of(latest_per_key(df, "k", newest_first(ORDER))) == brute_latest(rows)


@pytest.mark.parametrize("word_bits", [latest.WORD_BITS, 1])
def test_latest_of_stored_rows_matches_brute_force(spark, tmp_path, monkeypatch, word_bits):
    """Null keys, equal rows and a hot key; with 128 marks for 3,000 keys nearly every row bears another key's mark."""
    monkeypatch.setattr(latest, "WORD_BITS", word_bits)
    rows = sample(600, 4) + [(None, None, 5, "a"), (None, None, 6, None), ("k1", date(2025, 2, 2), 99, "z")] * 2
    rows += [(f"once{i}", date(2025, 3, 1), i, "v") for i in range(3000)]
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(str(tmp_path / "rows"))
    df = spark.read.schema(SCHEMA).parquet(str(tmp_path / "rows"))
    assert rows_of(latest_of_stored(df, "k", newest_first(ORDER))) == brute_latest(rows)
    # With all columns as the key each distinct row stays once.
    assert rows_of(latest_of_stored(df, SCHEMA.names, newest_first(ORDER))) == sorted(set(rows), key=repr)


def test_stored_rows_of_keys_that_come_once_stay_where_they_lie(spark, tmp_path):
    """A build and a merge leave them in the order of their files; moved rows would lie by the hash of their key."""
    table = table_at(tmp_path / "t", None)
    names = [f"k{i}" for i in range(400)]
    for mark, part in enumerate((names[:300], names[250:]), 1):
        path = str(tmp_path / f"batch-{mark}")
        spark.createDataFrame([(k, date(2025, 1, 1), mark, "v") for k in part], SCHEMA).coalesce(1).write.parquet(path)
        change = table.replace if mark == 1 else table.merge
        change(spark.read.schema(SCHEMA).parquet(path), mark, stored=True)
    assert rows_of(table.read(spark), "k", "ts") == sorted(((k, 1 if i < 250 else 2) for i, k in enumerate(names)), key=repr)
    for part, n_files in ((names[:250], 1), (names[300:], 1)):
        files = table.read(spark).where(F.col("k").isin(part)).groupBy(F.input_file_name()).agg(F.collect_list("k")).collect()
        assert len(files) == n_files and files[0][1] == part


def test_steps_equal_one_full_build(spark, tmp_path):
    rows = sample(900, 2)
    steps = table_at(tmp_path / "steps")
    steps.replace(spark.createDataFrame(rows[:300], SCHEMA), 1)
    steps.merge(spark.createDataFrame(rows[300:600], SCHEMA), 2)
    steps.merge(spark.createDataFrame(rows[600:], SCHEMA), 3)
    assert rows_of(steps.read(spark)) == brute_latest(rows)
    assert steps.mark(spark) == 3


def test_merging_twice_changes_nothing(spark, tmp_path):
    table = table_at(tmp_path / "t")
    batch = spark.createDataFrame(sample(200, 3), SCHEMA)
    table.merge(batch, 1)
    before = rows_of(table.read(spark))
    table.merge(batch, 2)
    assert rows_of(table.read(spark)) == before


def test_merge_rewrites_only_touched_slices(spark, tmp_path):
    table = table_at(tmp_path / "t")
    table.replace(
        spark.createDataFrame([("a", date(2025, 1, 1), 1, "x"), ("b", date(2025, 2, 1), 1, "x")], SCHEMA), 1
    )
    before = table.slices(spark)
    table.merge(spark.createDataFrame([("b", date(2025, 2, 1), 2, "y")], SCHEMA), 2)
    after = table.slices(spark)
    assert after["2025-01"] == before["2025-01"]
    assert after["2025-02"] != before["2025-02"]
    assert rows_of(table.read(spark), "k", "v") == [("a", "x"), ("b", "y")]
    assert rows_of(table.read(spark, ["2025-01"]), "k") == [("a",)]


def test_slice_names_that_need_escaping(spark, tmp_path):
    table = table_at(tmp_path / "t", lambda: F.nullif(F.col("v"), F.lit("null")))
    names = ["a/b", "c=d", "e:f", "", "null", "g h", "ç%20"]
    rows = [(f"k{i}", date(2025, 1, 1), 1, name) for i, name in enumerate(names)]
    table.replace(spark.createDataFrame(rows, SCHEMA), 1)
    newer = [(k, day, 2, v) for k, day, _, v in rows]
    table.merge(spark.createDataFrame(newer, SCHEMA), 2)
    assert rows_of(table.read(spark)) == sorted(newer, key=repr)


def test_an_unfinished_version_is_invisible_and_overwritten(spark, tmp_path):
    table = table_at(tmp_path / "t")
    table.replace(spark.createDataFrame([("a", date(2025, 1, 1), 1, "x")], SCHEMA), 1)
    table.merge(spark.createDataFrame([("a", date(2025, 1, 1), 2, "y")], SCHEMA), 2)
    (tmp_path / "t" / "v=000001-2-part" / "_SUCCESS").unlink()
    assert table.mark(spark) == 1
    assert rows_of(table.read(spark), "v") == [("x",)]
    table.merge(spark.createDataFrame([("a", date(2025, 1, 1), 3, "z")], SCHEMA), 2)
    assert rows_of(table.read(spark), "v") == [("z",)]


def test_full_replace_forgets_older_slices(spark, tmp_path):
    table = table_at(tmp_path / "t")
    table.replace(spark.createDataFrame([("a", date(2025, 1, 1), 1, "x")], SCHEMA), 1)
    table.replace(spark.createDataFrame([("b", date(2025, 2, 1), 1, "x")], SCHEMA), 1)
    assert rows_of(table.read(spark), "k") == [("b",)]


def test_expire_keeps_the_current_state(spark, tmp_path):
    table = table_at(tmp_path / "t")
    for mark in range(3):
        table.merge(spark.createDataFrame(sample(80, mark), SCHEMA), mark)
    before = rows_of(table.read(spark))
    assert table.expire(spark) > 0
    assert table.expire(spark) == 0
    assert rows_of(table.read(spark)) == before
    assert len(glob_paths(spark, f"{table.root}/v=*/_table_slice=*")) == len(table.slices(spark))


def test_a_merge_of_one_slice_keeps_the_others_with_deltas_pending(spark, tmp_path):
    table = table_at(tmp_path / "t")
    january, february = date(2025, 1, 1), date(2025, 2, 1)
    table.replace(spark.createDataFrame([("1", january, 1, "x"), ("2", february, 1, "x"), ("3", february, 1, "x")], SCHEMA), 1)
    table.append(spark.createDataFrame([("2", february, 2, "y")], SCHEMA), 2)
    table.merge(spark.createDataFrame([("1", january, 3, "z")], SCHEMA), 3)
    assert rows_of(table.read(spark), "k", "v") == [("1", "z"), ("2", "y"), ("3", "x")]
    assert rows_of(table.read(spark, ["2025-01"]), "k") == [("1",)]


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("sliced", [True, False])
def test_any_order_of_changes_equals_one_newest_row_pass(spark, tmp_path, seed, sliced):
    rng = random.Random(seed)
    table = table_at(tmp_path / "t") if sliced else table_at(tmp_path / "t", None)
    rows = sample(60, seed)
    table.replace(spark.createDataFrame(rows, SCHEMA), 0)
    for mark in range(1, 7):
        more = sample(rng.choice([1, 3, 30]), 100 * seed + mark)
        change = rng.choice(["append", "append", "merge", "merge", "compact", "expire"])
        if change in ("append", "merge"):
            getattr(table, change)(spark.createDataFrame(more, SCHEMA), mark)
            rows += more
        else:
            getattr(table, change)(spark)
        assert rows_of(table.read(spark)) == brute_latest(rows), (mark, change)


@pytest.mark.parametrize("sliced", [True, False])
def test_any_order_of_changes_by_stored_batches_equals_one_newest_row_pass(spark, tmp_path, sliced):
    name = "spark.sql.files.maxPartitionBytes"
    split, rng = spark.conf.get(name), random.Random(9)
    table = table_at(tmp_path / "t") if sliced else table_at(tmp_path / "t", None)
    rows = []
    for mark, change in enumerate(["merge", "append", "merge", "append", "compact", "merge", "replace", "append", "merge"]):
        if change == "compact":
            table.compact(spark)
        else:
            path = str(tmp_path / f"batch-{mark}")
            more = sample(rng.choice([2, 40]), 50 + mark)
            spark.createDataFrame(more, SCHEMA).write.parquet(path)
            batch = spark.read.schema(SCHEMA).parquet(path)
            rows = more if change == "replace" else rows + more
            table.append(batch, mark) if change == "append" else getattr(table, change)(batch, mark, stored=True)
        assert rows_of(table.read(spark)) == brute_latest(rows), (mark, change)
    assert spark.conf.get(name) == split


def test_empty_table_and_empty_batch(spark, tmp_path):
    table = table_at(tmp_path / "t")
    assert table.mark(spark) is None
    assert table.read(spark).collect() == []
    table.merge(spark.createDataFrame([], SCHEMA), 5)
    assert table.mark(spark) == 5
    assert table.read(spark).collect() == []


def test_delete_insert_lets_the_batch_win(spark):
    target = spark.createDataFrame([("a", None, 9, "old"), ("b", None, 9, "old")], SCHEMA)
    batch = spark.createDataFrame([("b", None, 1, "new"), ("c", None, 1, "new")], SCHEMA)
    assert rows_of(upsert.delete_insert(target, batch, "k"), "k", "v") == [("a", "old"), ("b", "new"), ("c", "new")]
    assert rows_of(upsert.untouched(target, batch, "k"), "k") == [("a",)]


def test_union_goes_by_name(spark):
    left = spark.createDataFrame([("1", "2")], "a string, b string")
    right = spark.createDataFrame([("4", "3")], "b string, a string")
    assert rows_of(upsert.union_current_new(left, right)) == [("1", "2"), ("3", "4")]


def test_resolve_periods(spark):
    wanted = spark.createDataFrame([("2025-02",), ("2025-01",), ("2024-01",), ("2023-02",)], "wanted string")
    present = spark.createDataFrame([("2025-01",), ("2023-02",), ("2023-02",)], "partition string")
    assert rows_of(resolve_periods(wanted, present)) == [
        ("2023-02", "2023-02"),
        ("2024-01", "2023-02"),
        ("2025-01", "2025-01"),
        ("2025-02", "2025-01"),
    ]


def test_rows_of_period_falls_back_one_step_only(spark):
    df = spark.createDataFrame([("2024-02", 1), ("2023-01", 2)], "partition string, v int")
    assert rows_of(rows_of_period(df, "2024-02"), "v") == [(1,)]
    assert rows_of(rows_of_period(df, "2025-01"), "v") == [(1,)]
    with pytest.raises(FileNotFoundError):
        rows_of_period(df, "2025-02")


def test_resolve_namespace():
    assert resolve_namespace(" staging ", "main") == "staging"
    assert resolve_namespace(None, "main") == "main"
    assert resolve_namespace(None) == ""


def test_scratch_folder_is_the_shared_one(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

