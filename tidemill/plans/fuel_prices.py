"""The half-yearly survey of bottled-gas retail prices: source, model and checks."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, functions as F, types as T

from tidemill.contracts import ModelColumn, ModelContract, SourceColumn, SourceContract
from tidemill.functions import blank_to_null, decimal_comma, digits_only, digits_or_null, parse_date, period_of, surrogate_key, trim
from tidemill.operators.quality import accepted_values, between, length_equals, match_regex, not_null, unique

# Table, folder and file names, file header, accepted values.
SOURCE = SourceContract(
    name="anp_glp",
    table="historico_precos_combustiveis_glp",
    file_prefix="govbr-anp-glp",
    columns=(
        SourceColumn("Regiao - Sigla", "Region code."),
        SourceColumn("Estado - Sigla", "State code."),
        SourceColumn("Municipio", "City."),
        SourceColumn("Revenda", "Name of the reseller."),
        SourceColumn("CNPJ da Revenda", "Company number of the reseller, as printed."),
        SourceColumn("Nome da Rua", "Street."),
        SourceColumn("Numero Rua", "House number."),
        SourceColumn("Complemento", "Rest of the address."),
        SourceColumn("Bairro", "District."),
        SourceColumn("Cep", "Postal code, as printed."),
        SourceColumn("Produto", "Fuel surveyed."),
        SourceColumn("Data da Coleta", "Day of the survey."),
        SourceColumn("Valor de Venda", "Retail price, decimal comma."),
        SourceColumn("Valor de Compra", "Wholesale price, decimal comma; not surveyed in later years."),
        SourceColumn("Unidade de Medida", "Unit of the prices."),
        SourceColumn("Bandeira", "Brand the reseller shows, if any."),
    ),
    csv_options={"sep": ";", "encoding": "UTF-8"},
)
PRODUCT = "GLP"
REGIONS = ("N", "NE", "S", "SE", "CO")
STATES = (
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA",
    "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
)
MODEL_TABLE = "stg_historico_precos_combustiveis_glp"
MODEL_KEY = "sk_revenda_coleta"


def raw_column(name: str) -> Column:
    return F.col(f"`{name}`")


def survey_date() -> Column:
    return parse_date(raw_column("Data da Coleta"), SOURCE.date_format)


def survey_key() -> Column:
    """Over the company number and product as printed, so two spellings are two keys."""
    return surrogate_key(raw_column("CNPJ da Revenda"), survey_date(), raw_column("Produto"))


def survey_key_of_clean_values() -> Column:
    return surrogate_key(digits_only(raw_column("CNPJ da Revenda")), survey_date(), trim(raw_column("Produto")))


def _text(name: str, raw: str, comment: str, clean=trim) -> ModelColumn:
    return ModelColumn(name, T.StringType(), comment, lambda: clean(raw_column(raw)))


MODEL = ModelContract(
    table=MODEL_TABLE,
    key=MODEL_KEY,
    keep=lambda: raw_column("Produto") == PRODUCT,
    newest_by=("ingestion_ts", "source_file"),
    slice_of=lambda: period_of("data_coleta"),
    columns=(
        ModelColumn(MODEL_KEY, T.StringType(), "Key of reseller, day and fuel.", survey_key),
        _text("regiao_sigla", "Regiao - Sigla", "Region code."),
        _text("estado_sigla", "Estado - Sigla", "State code."),
        _text("municipio", "Municipio", "City."),
        _text("nome_revenda", "Revenda", "Name of the reseller.", blank_to_null),
        _text("cnpj_revenda", "CNPJ da Revenda", "Company number, digits only.", digits_only),
        _text("bandeira", "Bandeira", "Brand the reseller shows.", blank_to_null),
        _text("nome_rua", "Nome da Rua", "Street.", blank_to_null),
        _text("numero_rua", "Numero Rua", "House number.", blank_to_null),
        _text("complemento", "Complemento", "Rest of the address.", blank_to_null),
        _text("bairro", "Bairro", "District.", blank_to_null),
        _text("cep", "Cep", "Postal code, digits only.", digits_or_null),
        _text("produto", "Produto", "Fuel surveyed."),
        _text("unidade_medida", "Unidade de Medida", "Unit of the prices."),
        ModelColumn("data_coleta", T.DateType(), "Day of the survey.", survey_date),
        ModelColumn(
            "valor_venda", T.DecimalType(10, 2), "Retail price.", lambda: decimal_comma(raw_column("Valor de Venda"))
        ),
        ModelColumn(
            "valor_compra",
            T.DecimalType(10, 2),
            "Wholesale price.",
            lambda: decimal_comma(raw_column("Valor de Compra")),
        ),
        ModelColumn("partition", T.StringType(), "Half-year of the file.", lambda: F.col("partition")),
        ModelColumn("source_file", T.StringType(), "File the row was read from.", lambda: F.col("source_file")),
        ModelColumn(
            "ingestion_ts",
            T.TimestampNTZType(),
            "Time of the load.",
            lambda: F.col("ingestion_ts").cast("timestamp_ntz"),
        ),
    ),
    checks=(
        not_null(MODEL_KEY),
        unique(MODEL_KEY),
        not_null("regiao_sigla"),
        accepted_values("regiao_sigla", REGIONS),
        not_null("estado_sigla"),
        accepted_values("estado_sigla", STATES),
        not_null("municipio"),
        not_null("cnpj_revenda"),
        match_regex("cnpj_revenda", "^[0-9]+$"),
        length_equals("cnpj_revenda", 14),
        match_regex("cep", "^[0-9]*$"),
        length_equals("cep", 8),
        accepted_values("produto", (PRODUCT,)),
        not_null("data_coleta"),
        not_null("valor_venda"),
        between("valor_venda", low=0),
        between("valor_compra", low=0),
        not_null("bandeira"),
        not_null("partition"),
        not_null("source_file"),
    ),
)

# The same model with one key per reseller however its number is printed; not the default.
MODEL_ON_CLEAN_KEY = replace(
    MODEL,
    table=f"{MODEL_TABLE}_clean_key",
    columns=(replace(MODEL.columns[0], value=survey_key_of_clean_values), *MODEL.columns[1:]),
)
