from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rows import rows_of
from tidemill.operators import ledger, quality
from tidemill.operators.describe import describe_columns
from tidemill.plans.fuel_prices import MODEL, MODEL_KEY

GOOD = {
    MODEL_KEY: "k",
    "regiao_sigla": "SE",
    "estado_sigla": "RJ",
    "municipio": "RIO",
    "nome_revenda": "R",
    "cnpj_revenda": "12345678000190",
    "bandeira": "B",
    "nome_rua": None,
    "numero_rua": None,
    "complemento": None,
    "bairro": None,
    "cep": "20000123",
    "produto": "GLP",
    "unidade_medida": "u",
    "data_coleta": date(2025, 1, 2),
    "valor_venda": Decimal("1.00"),
    "valor_compra": None,
    "partition": "2025-01",
    "source_file": "f",
    "ingestion_ts": datetime(2025, 7, 1),
}


def model_with(spark, *rows):
    return spark.createDataFrame([tuple({**GOOD, **r}[c] for c in MODEL.schema.names) for r in rows], MODEL.schema)


def failed(spark, *rows):
    report = quality.run_checks(model_with(spark, *rows), MODEL.checks)
    return {(r["column_name"], r["check_name"]): (r["failures"], r["failing_rows"]) for r in report.collect() if r["status"] == "fail"}


def test_good_rows_pass_all_checks(spark):
    report = quality.run_checks(model_with(spark, {}, {MODEL_KEY: "k2"}), MODEL.checks)
    assert rows_of(report.groupBy("status", "failures").count()) == [("pass", 0, len(MODEL.checks))]


def test_an_empty_table_passes(spark):
    assert failed(spark) == {}


@pytest.mark.parametrize(
    "broken, check",
    [
        ({"municipio": None}, ("municipio", "not_null")),
        ({"source_file": None}, ("source_file", "not_null")),
        ({"regiao_sigla": "XX"}, ("regiao_sigla", "accepted_values")),
        ({"produto": " GLP"}, ("produto", "accepted_values")),
        ({"cnpj_revenda": "1234567800019x"}, ("cnpj_revenda", "match_regex")),
        ({"cnpj_revenda": "1234567800019\n"}, ("cnpj_revenda", "match_regex")),
        ({"cnpj_revenda": "1"}, ("cnpj_revenda", "length_equals")),
        ({"cep": ""}, ("cep", "length_equals")),
        ({"valor_venda": Decimal("-0.01")}, ("valor_venda", "between")),
    ],
)
def test_one_violation_fails_one_check(spark, broken, check):
    assert failed(spark, {}, {MODEL_KEY: "k2", **broken}) == {check: (1, 1)}


def test_null_passes_all_but_not_null(spark):
    assert failed(spark, {"cep": None, "produto": None, "valor_compra": None, "nome_revenda": None}) == {}


def test_unique_counts_values_and_rows(spark):
    rows = [{MODEL_KEY: k} for k in ("a", "a", "a", "b", "b", "c")] + [{MODEL_KEY: None}] * 2
    found = failed(spark, *rows)
    assert found == {(MODEL_KEY, "unique"): (2, 5), (MODEL_KEY, "not_null"): (2, 2)}
    assert rows_of(quality.failing_rows(model_with(spark, *rows), quality.unique(MODEL_KEY))) == [("a", 3), ("b", 2)]


def test_accepted_values_counts_values_and_rows(spark):
    rows = [{MODEL_KEY: str(i), "regiao_sigla": v} for i, v in enumerate(["X", "X", "Y", "N"])]
    assert failed(spark, *rows) == {("regiao_sigla", "accepted_values"): (2, 3)}


def test_two_value_checks_on_one_column(spark):
    df = model_with(spark, {}, {"regiao_sigla": "S"})
    checks = [quality.accepted_values("regiao_sigla", ["S"]), quality.accepted_values("regiao_sigla", ["S", "SE"])]
    assert rows_of(quality.run_checks(df, checks), "failures") == [(0,), (1,)]


def test_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(0,), (5,), (10,), (11,), (-1,), (None,)], "v int")
    assert rows_of(quality.failing_rows(df, quality.between("v", 0, 10))) == [(-1,), (11,)]
    assert rows_of(quality.failing_rows(df, quality.between("v", high=10))) == [(11,)]
    with pytest.raises(ValueError):
        quality.between("v")


@pytest.mark.parametrize("days, status", [(179, "pass"), (180, "pass"), (181, "warn"), (190, "warn"), (191, "error")])
def test_freshness(spark, days, status):
    df = spark.createDataFrame([(datetime(2025, 1, 1),), (datetime(2024, 1, 1),)], "t timestamp_ntz")
    as_of = datetime.fromordinal(date(2025, 1, 1).toordinal() + days)
    assert quality.freshness(df, "t", [as_of], 180, 190).first()["status"] == status


def test_freshness_without_rows_is_an_error(spark):
    df = spark.createDataFrame([], "t timestamp_ntz")
    assert quality.freshness(df, "t", [datetime(2025, 1, 1)], 180, 190).first()["status"] == "error"


def test_ledger_constraints(spark):
    rows = [("a", None, 1, "x", "loaded"), ("a", None, 1, "y", "loaded"), ("b", None, 1, "x", "loaded")]
    df = spark.createDataFrame(rows, ledger.LEDGER_SCHEMA)
    assert rows_of(ledger.duplicate_names(df)) == [("a", 2)]
    assert rows_of(ledger.duplicate_checksums(df)) == [("x", 2)]
    loose = df.select(*[F.nullif(F.col(c), F.lit("a")).alias(c) if c == "source_file" else F.col(c) for c in df.columns])
    assert rows_of(ledger.missing_required(loose)) == [("file_checksum", 0), ("rows_ingested", 0), ("source_file", 2)]


def test_ledger_set_operations_with_a_hot_content(spark):
    files = [(f"f{i:03d}", "same" if i % 3 else f"c{i}") for i in range(300)]
    df = spark.createDataFrame(files, "source_file string, file_checksum string").repartition(8)
    known = spark.createDataFrame([("old", None, 1, "c0", "loaded")], ledger.LEDGER_SCHEMA)
    firsts = {}
    for name, checksum in files:
        firsts.setdefault(checksum, name)
    expected = sorted((name, checksum) for checksum, name in firsts.items() if checksum != "c0")
    new = ledger.skip_known(ledger.first_of_each_content(df), known)
    assert rows_of(new, "source_file", "file_checksum") == expected
    assert rows_of(ledger.only_known(df, known), "source_file") == [("f000",)]


def test_rows_per_file_counts_empty_files(spark):
    files = spark.createDataFrame([("a",), ("b",)], "source_file string")
    loaded = spark.createDataFrame([("a",), ("a",), ("z",)], "source_file string")
    assert rows_of(ledger.rows_per_file(files, loaded)) == [("a", 2), ("b", 0)]


def test_descriptions_travel_with_the_columns(spark):
    described = describe_columns(model_with(spark, {}))
    assert described.where("comment is null").count() == 0
    assert rows_of(described.where("column_name = 'valor_venda'"), "data_type", "non_null_rows") == [("decimal(10,2)", 1)]
