import hashlib
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from landing import HEADER, price_file, price_line
from rows import rows_of
from tidemill.plans import archive as archive_module, ingest as ingest_module
from tidemill.plans.fuel_prices import MODEL, MODEL_ON_CLEAN_KEY, SOURCE
from tidemill.plans.ingest import ingest
from tidemill.plans.staging import build_model, full_model
from tidemill.plans.upkeep import expire_batches, pack_batches, to_pack
from tidemill.plans.warehouse import Segment, Warehouse
from tidemill.sources.periods import rows_of_period
from tidemill.sources import file_units
from tidemill.sources.csv_files import land_csv, scan_csv, scan_landing
from tidemill.sources.file_units import checksum_files, list_files, with_size_kb
from tidemill.storage import exclusive

T1, T2, T3 = datetime(2025, 7, 1), datetime(2025, 7, 2), datetime(2025, 7, 3)


@pytest.fixture
def place(tmp_path):
    class Place:
        incoming = tmp_path / "incoming"
        warehouse = Warehouse(str(tmp_path / "warehouse"))
        archive = tmp_path / "processed"

    return Place


def load(spark, place, when=T1, **options):
    return ingest(spark, SOURCE, str(place.incoming), place.warehouse, when, **options)


def raw(spark, place):
    return place.warehouse.read_raw(spark, SOURCE)


def ledger(spark, place):
    return place.warehouse.read_ledger(spark, SOURCE)


def test_each_file_once_with_its_lineage(spark, place):
    a = price_file(place.incoming, "2025-01", "a.csv", [price_line(), price_line(day="03/01/2025")])
    b = price_file(place.incoming, "2024-02", "b.csv", [price_line(cnpj="2")])
    result = load(spark, place)
    assert (result.batches, result.files_loaded) == ((1,), 2)
    assert rows_of(raw(spark, place), "partition", "source_file", "ingestion_ts", "batch_id") == [
        ("2024-02", f"file:{b}", T1, 1),
        ("2025-01", f"file:{a}", T1, 1),
        ("2025-01", f"file:{a}", T1, 1),
    ]
    expected = [
        (f"file:{p}", T1, n, hashlib.sha256(p.read_bytes()).hexdigest(), "loaded", 1) for p, n in ((b, 1), (a, 2))
    ]
    assert rows_of(ledger(spark, place)) == sorted(expected, key=repr)


def test_loading_twice_changes_nothing(spark, place):
    price_file(place.incoming, "2025-01", "a.csv", [price_line()])
    load(spark, place)
    assert load(spark, place, T2).batches == ()
    assert raw(spark, place).count() == 1
    assert ledger(spark, place).count() == 1


def test_twins_load_once_in_one_run_and_across_runs(spark, place):
    price_file(place.incoming, "2025-01", "b.csv", [price_line()])
    first = price_file(place.incoming, "2025-01", "a.csv", [price_line()])
    assert load(spark, place).files_loaded == 1
    assert rows_of(ledger(spark, place), "source_file") == [(f"file:{first}",)]
    price_file(place.incoming, "2025-02", "later.csv", [price_line()])
    assert load(spark, place, T2).files_loaded == 0
    assert raw(spark, place).count() == 1


def test_known_name_with_new_content_is_an_error_and_loads_nothing(spark, place):
    price_file(place.incoming, "2025-01", "a.csv", [price_line()])
    load(spark, place)
    price_file(place.incoming, "2025-01", "a.csv", [price_line(price="1,00")])
    price_file(place.incoming, "2025-01", "c.csv", [price_line(price="2,00")])
    with pytest.raises(ValueError, match="a.csv"):
        load(spark, place, T2)
    assert raw(spark, place).count() == 1


def test_header_only_file_counts_zero_rows(spark, place):
    empty = price_file(place.incoming, "2025-01", "a.csv", [])
    load(spark, place)
    assert rows_of(ledger(spark, place), "source_file", "rows_ingested") == [(f"file:{empty}", 0)]
    assert raw(spark, place).collect() == []


def test_swapped_header_is_an_error(spark, place):
    names = HEADER.split(";")
    names[0], names[1] = names[1], names[0]
    price_file(place.incoming, "2025-01", "a.csv", [price_line()], header=";".join(names))
    with pytest.raises(Exception, match="header"):
        load(spark, place)
    assert ledger(spark, place).collect() == []


def test_row_with_too_many_fields_is_an_error(spark, place):
    price_file(place.incoming, "2025-01", "a.csv", [price_line() + ";extra"])
    with pytest.raises(Exception, match="(?i)malformed"):
        load(spark, place)


def test_no_files_is_an_error(spark, place):
    price_file(place.incoming, "2025-01", "a.txt", [price_line()])
    with pytest.raises(FileNotFoundError):
        load(spark, place)


def test_missing_folder_is_an_error(spark, place):
    with pytest.raises(FileNotFoundError):
        load(spark, place)


def test_half_years_are_known_from_the_ledger(spark, place):
    price_file(place.incoming, "2025-01", "a.csv", [price_line()])
    price_file(place.incoming, "2024-02", "b.csv", [price_line(cnpj="2")])
    assert rows_of(place.warehouse.periods(spark, SOURCE)) == []
    load(spark, place)
    present = place.warehouse.periods(spark, SOURCE)
    assert rows_of(present) == [("2024-02",), ("2025-01",)]
    rows = rows_of_period(raw(spark, place), "2025-02", present)
    assert rows_of(rows, "partition") == [("2025-01",)]


def test_empty_fields_are_null_and_blanks_stay(spark, place):
    fields = price_line().split(";")
    fields[3:6] = ["", '""', '" "']
    price_file(place.incoming, "2025-01", "a.csv", [";".join(fields)])
    load(spark, place)
    row = raw(spark, place).first()
    assert (row["Revenda"], row["CNPJ da Revenda"], row["Nome da Rua"], row["Municipio"]) == (None, None, " ", " RIO ")


QUOTED = {
    '"POSTO ""BOM"" LTDA"': 'POSTO "BOM" LTDA',
    '"POSTO ""A;B"" LTDA"': 'POSTO "A;B" LTDA',
    '"RUA A\\"': "RUA A\\",
    "RUA \\B\\": "RUA \\B\\",
    '""""': '"',
}


def with_reseller(field):
    return ";".join([*price_line().split(";")[:3], field, *price_line().split(";")[4:]])


def test_quotes_are_doubled_and_backslashes_are_plain(spark, place):
    price_file(place.incoming, "2025-01", "a.csv", [with_reseller(field) for field in QUOTED])
    load(spark, place)
    assert rows_of(raw(spark, place), "Revenda") == sorted(((v,) for v in QUOTED.values()), key=repr)
    land_csv(raw(spark, place), SOURCE, str(place.archive))
    assert rows_of(scan_landing(spark, SOURCE, str(place.archive)), "Revenda") == rows_of(raw(spark, place), "Revenda")


def test_quoted_line_ends_need_a_contract_for_them(spark, place):
    price_file(place.incoming, "2025-01", "a.csv", [with_reseller('"two\nlines"'), price_line()])
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_csv(spark, SOURCE, str(place.incoming)).collect()
    several = replace(SOURCE, multi_line=True)
    assert rows_of(scan_csv(spark, several, str(place.incoming)), "Revenda") == [("REVENDA",), ("two\nlines",)]


def test_odd_file_names(spark, place):
    names = ["a b.csv", "p%20q.csv", "x+y.csv", "[z]{k}.csv", "é,1.csv", "q'uote.csv", "e#f*.csv"]
    paths = [price_file(place.incoming, "2025-01", n, [price_line(cnpj=str(i))]) for i, n in enumerate(names)]
    load(spark, place)
    expected = sorted((f"file:{p}", 1) for p in paths)
    assert sorted(tuple(r) for r in ledger(spark, place).select("source_file", "rows_ingested").collect()) == expected
    assert sorted(r[0] for r in raw(spark, place).select("source_file").collect()) == [p for p, _ in expected]


def test_byte_order_mark(spark, place):
    price_file(place.incoming, "2025-01", "a.csv", [price_line()], header="﻿" + HEADER)
    load(spark, place)
    assert raw(spark, place).first()["Regiao - Sigla"] == "SE"


def test_small_batches_are_committed_one_by_one(spark, place):
    for i in range(5):
        price_file(place.incoming, "2025-01", f"{i}.csv", [price_line(cnpj=str(i))])
    assert load(spark, place, files_per_batch=2).batches == (1, 2, 3)
    assert raw(spark, place).count() == 5
    assert rows_of(ledger(spark, place).groupBy("batch_id").count()) == [(1, 2), (2, 2), (3, 1)]


def test_crash_before_the_ledger_entry(spark, place, monkeypatch):
    price_file(place.incoming, "2025-01", "a.csv", [price_line()])
    load(spark, place)
    price_file(place.incoming, "2025-02", "b.csv", [price_line(cnpj="2")])

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, "ledger_entries", crash)
        with pytest.raises(OSError):
            load(spark, place, T2)
    assert raw(spark, place).count() == 1
    # The retry finds other files and must not keep rows of the lost attempt.
    price_file(place.incoming, "2025-02", "b.csv", [price_line(cnpj="3"), price_line(cnpj="4")])
    assert load(spark, place, T3).batches == (2,)
    assert rows_of(raw(spark, place), "`CNPJ da Revenda`") == [("12.345.678/0001-90",), ("3",), ("4",)]


def test_archive_moves_loaded_and_known_files(spark, place):
    price_file(place.incoming, "2025-01", "a.csv", [price_line()])
    price_file(place.incoming, "2024-02", "twin.csv", [price_line()])
    load(spark, place, archive_root=str(place.archive))
    moved = sorted(str(p.relative_to(place.archive)) for p in place.archive.rglob("*.csv"))
    assert moved == [f"{SOURCE.name}/partition=2024-02/twin.csv", f"{SOURCE.name}/partition=2025-01/a.csv"]
    assert list(place.incoming.rglob("*.csv")) == []


def test_archive_failure_keeps_the_load(spark, place):
    path = price_file(place.incoming, "2025-01", "a.csv", [price_line()])
    place.archive.write_text("a file where a folder should be")
    load(spark, place, archive_root=str(place.archive))
    assert raw(spark, place).count() == 1
    assert path.exists()


def test_checksums_of_files(spark, place, monkeypatch):
    paths = [price_file(place.incoming, "2025-01", f"{i} +%.csv", [price_line()] * (1 + 50 * i)) for i in range(4)]
    expected = sorted((f"file:{p}", p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in paths)
    assert rows_of(checksum_files(spark, str(place.incoming))) == expected
    monkeypatch.setattr(file_units, "BLOCK", 7)
    assert rows_of(checksum_files(spark, str(place.incoming))) == expected
    monkeypatch.setattr(file_units, "has_client", lambda path: False)  # a store that only Spark's client reaches
    assert rows_of(checksum_files(spark, str(place.incoming))) == expected
    sizes = with_size_kb(list_files(spark, str(place.incoming)))
    assert rows_of(sizes, "source_file", "size_kb") == [(n, round(s / 1024, 1)) for n, s, _ in expected]


def test_archive_on_another_file_system_is_copied_checked_and_deleted(tmp_path):
    from pyarrow import fs

    source, target = fs.LocalFileSystem(), fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem())
    assert not source.equals(target)
    (tmp_path / "a.csv").write_text("bytes")
    archive_module._copy_then_delete(source, str(tmp_path / "a.csv"), target, "b.csv")
    assert not (tmp_path / "a.csv").exists() and (tmp_path / "b.csv").read_text() == "bytes"

    class Short:
        def __getattr__(self, name):
            return getattr(target, name)

        def get_file_info(self, name):
            return fs.FileInfo(name, fs.FileType.File, size=1)

    with pytest.raises(OSError, match="incomplete"):
        archive_module._copy_then_delete(source, str(tmp_path / "b.csv"), Short(), "c.csv")
    assert (tmp_path / "b.csv").exists()


def test_archive_without_a_client_fails_before_any_row_is_loaded(spark, place):
    price_file(place.incoming, "2025-01", "a.csv", [price_line()])
    with pytest.raises(ValueError, match="no file system client"):
        load(spark, place, archive_root="nosuch://bucket/processed")
    assert raw(spark, place).count() == 0


def test_a_second_writer_fails(spark, place):
    price_file(place.incoming, "2025-01", "a.csv", [price_line()])
    with exclusive(spark, place.warehouse.lease_path(SOURCE.name)):
        with pytest.raises(RuntimeError, match="another writer"):
            load(spark, place)
    with exclusive(spark, place.warehouse.lease_path(MODEL.table)):
        with pytest.raises(RuntimeError, match="another writer"):
            build_model(spark, SOURCE, MODEL, place.warehouse)
    assert load(spark, place).files_loaded == 1


def test_commit_markers_must_be_on(spark, place):
    price_file(place.incoming, "2025-01", "a.csv", [price_line()])
    conf, name = spark._jsc.hadoopConfiguration(), "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf.set(name, "false")
    try:
        with pytest.raises(RuntimeError, match="_SUCCESS"):
            load(spark, place)
    finally:
        conf.unset(name)


@pytest.mark.parametrize(
    "broken, message",
    [
        (lambda e: e.withColumn("rows_ingested", F.lit(7).cast("long")), "7 of 2 raw rows"),
        (lambda e: e.withColumn("file_checksum", F.lit(None).cast("string")), "without required values.*file_checksum"),
    ],
)
def test_ledger_constraints_hold_before_the_commit(spark, place, monkeypatch, broken, message):
    price_file(place.incoming, "2025-01", "a.csv", [price_line(), price_line(cnpj="2")])
    entries = ingest_module.ledger_entries
    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, "ledger_entries", lambda *a: broken(entries(*a)))
        with pytest.raises(RuntimeError, match=message):
            load(spark, place)
    assert raw(spark, place).count() == ledger(spark, place).count() == 0
    assert load(spark, place).files_loaded == 1


def test_incremental_reads_list_only_new_batches(spark, place):
    for i in range(4):
        price_file(place.incoming, "2025-01", f"{i}.csv", [price_line(cnpj=str(i))])
        load(spark, place)
    newest = place.warehouse.read_raw(spark, SOURCE, after=3)
    assert len(newest.inputFiles()) == 1 and rows_of(newest, "batch_id") == [(4,)]
    assert place.warehouse.read_raw(spark, SOURCE, after=4).collect() == []


def test_packed_batches_read_like_single_ones(spark, place):
    for i in range(9):
        price_file(place.incoming, f"202{i % 3}-01", f"{i}.csv", [price_line(cnpj=str(i))])
        load(spark, place)
        if i in (3, 5):
            pack_batches(spark, SOURCE, place.warehouse)
    before, entries = rows_of(raw(spark, place)), rows_of(ledger(spark, place))
    assert [(s.first, s.last) for s in place.warehouse.cover(spark, SOURCE)] == [(1, 4), (5, 6), (7, 7), (8, 8), (9, 9)]
    model = rows_of(build_model(spark, SOURCE, MODEL, place.warehouse))
    pack_batches(spark, SOURCE, place.warehouse)
    assert [(s.first, s.last) for s in place.warehouse.cover(spark, SOURCE)] == [(1, 9)]
    assert rows_of(raw(spark, place)) == before and rows_of(ledger(spark, place)) == entries
    assert rows_of(place.warehouse.read_raw(spark, SOURCE, after=7), "batch_id") == [(8,), (9,)]
    assert expire_batches(spark, SOURCE, place.warehouse) > 0
    assert expire_batches(spark, SOURCE, place.warehouse) == 0
    assert rows_of(raw(spark, place)) == before and rows_of(ledger(spark, place)) == entries
    assert len({f.rsplit("/", 1)[0] for f in ledger(spark, place).inputFiles()}) == 1
    assert rows_of(build_model(spark, SOURCE, MODEL, place.warehouse, full_refresh=True)) == model
    price_file(place.incoming, "2025-01", "new.csv", [price_line(cnpj="77")])
    assert load(spark, place).batches == (10,)
    assert raw(spark, place).count() == 10


def test_segments_stay_few_after_a_thousand_batches():
    segments, most = [], 0
    for n in range(1, 1001):
        segments.append(Segment(n, n, f"batch_id={n}/run=1"))
        if n % 10 == 0 and (chosen := to_pack(segments)):
            segments = segments[: -len(chosen)] + [Segment(chosen[0].first, chosen[-1].last, "batches=")]
        most = max(most, len(segments))
    assert most <= 20 and [s.last + 1 for s in segments[:-1]] == [s.first for s in segments[1:]]


def test_a_half_year_is_read_from_its_own_folders(spark, place):
    for i, period in enumerate(("2024-01", "2024-02", "2025-01")):
        price_file(place.incoming, period, f"{i}.csv", [price_line(cnpj=str(i))])
        load(spark, place)
    rows = place.warehouse.rows_of_period(spark, SOURCE, "2025-02")
    assert rows_of(rows, "partition", "batch_id") == [("2025-01", 3)]
    assert all("batch_id=3/" in f and "partition=2025-01/" in f for f in rows.inputFiles())
    pack_batches(spark, SOURCE, place.warehouse)
    rows = place.warehouse.rows_of_period(spark, SOURCE, "2024-02")
    assert rows_of(rows, "partition", "batch_id") == [("2024-02", 2)]
    with pytest.raises(FileNotFoundError):
        place.warehouse.rows_of_period(spark, SOURCE, "2020-01")


def test_a_dead_run_needs_no_deletion_and_a_late_one_cannot_commit(spark, place, monkeypatch):
    price_file(place.incoming, "2025-01", "a.csv", [price_line()])
    path = place.warehouse.lease_path(SOURCE.name)
    late = exclusive(spark, path)
    lease = late.__enter__()  # a run that dies, or hangs, without giving its lease back
    with pytest.raises(RuntimeError, match="another writer"):
        load(spark, place)
    lease.write(0)  # as after the time that a lease is good for
    assert load(spark, place).files_loaded == 1
    with pytest.raises(RuntimeError, match="took over"):
        lease.check()
    late.__exit__(None, None, None)
    price_file(place.incoming, "2025-01", "b.csv", [price_line(cnpj="2")])

    def overtaken(*args):  # another run takes over while this one writes its rows
        lease_of_this_run = args[-1]
        lease_of_this_run.write(0)
        with exclusive(spark, path):
            pass
        return single(*args)

    single = ingest_module._load_batch
    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, "_load_batch", overtaken)
        with pytest.raises(RuntimeError, match="lost its lease"):
            load(spark, place)
    assert raw(spark, place).count() == 1
    assert load(spark, place).batches == (2,) and raw(spark, place).count() == 2


def test_a_lease_just_taken_counts_as_held(spark, tmp_path):
    (tmp_path / "token=000000001").touch()
    with pytest.raises(RuntimeError, match="another writer"):
        exclusive(spark, str(tmp_path)).__enter__()


def test_landed_bytes_are_read_twice_at_most(spark, place):
    """Once to hash, once to load: what follows the write reads what was written."""
    price_file(place.incoming, "2025-01", "a.csv", [price_line(cnpj=str(i)) for i in range(50)])
    seen = []
    scan = ingest_module.scan_landing

    def counted(*args):
        seen.append(args[2])
        return scan(*args)

    ingest_module.scan_landing = counted
    try:
        load(spark, place)
    finally:
        ingest_module.scan_landing = scan
    assert len(seen) == 1 and rows_of(ledger(spark, place), "rows_ingested") == [(50,)]


def test_views_answer_sql(spark, place):
    price_file(place.incoming, "2025-01", "a.csv", [price_line()])
    load(spark, place)
    build_model(spark, SOURCE, MODEL, place.warehouse)
    place.warehouse.register_views(spark, SOURCE, MODEL)
    assert spark.sql(f"SELECT `Produto` FROM {SOURCE.table}").collect() == [("GLP",)]
    assert spark.sql("SELECT rows_ingested FROM processed_files").collect() == [(1,)]
    assert spark.sql(f"SELECT cnpj_revenda FROM {MODEL.table}").collect() == [("12345678000190",)]


def test_model_follows_the_raw_table_step_by_step(spark, place):
    price_file(place.incoming, "2025-01", "a.csv", [price_line(), price_line(cnpj="2"), price_line(product=" GLP")])
    load(spark, place, T1)
    first = build_model(spark, SOURCE, MODEL, place.warehouse)
    assert first.count() == 2

    price_file(place.incoming, "2025-01", "b.csv", [price_line(price="1,00"), price_line(cnpj="3", day="01/08/2024")])
    load(spark, place, T2)
    second = build_model(spark, SOURCE, MODEL, place.warehouse)
    whole = rows_of(full_model(raw(spark, place).drop("batch_id"), MODEL))
    assert rows_of(second) == whole
    assert rows_of(second, "cnpj_revenda", "valor_venda")[0][0] == "12345678000190"

    # Nothing new: same version. Reading all raw rows again, or building anew: same rows.
    table = place.warehouse.model_table(MODEL)
    number = table.versions(spark)[0].number
    assert rows_of(build_model(spark, SOURCE, MODEL, place.warehouse)) == whole
    assert table.versions(spark)[0].number == number
    assert rows_of(build_model(spark, SOURCE, MODEL, place.warehouse, rescan=True)) == whole
    assert rows_of(build_model(spark, SOURCE, MODEL, place.warehouse, full_refresh=True)) == whole


def test_two_spellings_of_one_company_are_two_keys(spark, place):
    price_file(place.incoming, "2025-01", "a.csv", [price_line(), price_line(cnpj="12345678000190")])
    load(spark, place)
    model = build_model(spark, SOURCE, MODEL, place.warehouse)
    assert rows_of(model, "cnpj_revenda") == [("12345678000190",)] * 2
    assert build_model(spark, SOURCE, MODEL_ON_CLEAN_KEY, place.warehouse).count() == 1


def test_order_of_files_does_not_matter(spark, tmp_path):
    files = [("2025-01", f"{i}.csv", [price_line(price=f"{i},00"), price_line(cnpj=str(i % 2))]) for i in range(4)]
    results = []
    for run, order in enumerate((files, files[::-1])):
        incoming, warehouse = tmp_path / f"in{run}", Warehouse(str(tmp_path / f"wh{run}"))
        for file in order:
            price_file(incoming, *file)
        ingest(spark, SOURCE, str(incoming), warehouse, T1)
        model = build_model(spark, SOURCE, MODEL, warehouse)
        results.append(rows_of(model.drop("source_file")))
    assert results[0] == results[1]
