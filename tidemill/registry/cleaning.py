"""Filter, cleaning functions, surrogate key, newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.functions import (
    blank_to_null,
    decimal_comma,
    digits_only,
    digits_or_null,
    next_period,
    normalize_semester,
    parse_date,
    period_of,
    previous_period,
    semester_of,
    surrogate_key,
    trim,
)
from tidemill.operators.latest import latest_per_key as newest_row_per_key
from tidemill.operators.latest import newest_first
from tidemill.plans.fuel_prices import MODEL, MODEL_ON_CLEAN_KEY
from tidemill.plans.staging import clean, full_model
from tidemill.registry.raw_prices import TIES, raw_prices, table, with_clean, with_model, with_raw


def stg_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full_model(raw_prices(spark, sf_dir), MODEL)


def stg_clean_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full_model(raw_prices(spark, sf_dir), MODEL_ON_CLEAN_KEY)


def product_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_prices(spark, sf_dir).where(MODEL.keep())


def clean_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_prices(spark, sf_dir), MODEL)


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return newest_row_per_key(orders, "o_custkey", newest_first(["o_orderdate", "o_orderkey"]))


def fn_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    spaced = F.concat(F.lit("\u2003\u00a0 "), F.col("text"), F.lit(" \u2009\u3000"))
    tabbed = F.concat(F.lit("\t"), F.col("text"), F.lit("\n\u00a0"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.length(trim(spaced)).cast("long").alias("spaced_length"),
        F.md5(trim(spaced)).alias("spaced_md5"),
        F.md5(trim(tabbed)).alias("tabbed_md5"),
    )


def fn_blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_prices(spark, sf_dir)
    names = ["Revenda", "Bandeira", "Nome da Rua", "Numero Rua", "Complemento", "Bairro"]
    return raw.select(*[blank_to_null(f"`{n}`").alias(n.replace(" ", "_").lower()) for n in names])


def fn_digits_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_prices(spark, sf_dir)
    return raw.select(F.col("`CNPJ da Revenda`").alias("printed"), digits_only("`CNPJ da Revenda`").alias("digits"))


def fn_digits_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_prices(spark, sf_dir)
    return raw.select(F.col("Cep").alias("printed"), digits_or_null("Cep").alias("digits"))


def fn_decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    price = F.replace(F.col("l_extendedprice").cast("decimal(10,2)").cast("string"), F.lit("."), F.lit(","))
    whole = F.col("l_quantity").cast("int").cast("string")
    text = (
        F.when(line == 1, F.concat(F.lit("-"), price))
        .when(line == 2, F.concat(F.lit("1."), price))
        .when(line == 3, F.concat(F.lit("\u00a0 "), price, F.lit("5 ")))
        .when(line == 4, F.concat(whole, F.lit("e3")))
        .when(line == 5, F.concat(F.lit(","), whole))
        .when(line == 6, F.concat(whole, F.lit(",")))
        .when(line == 7, F.lit("N/D"))
        .otherwise(price)
    )
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", text.alias("printed"))
    return items.withColumn("amount", decimal_comma("printed"))


def fn_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = F.col("o_orderdate").cast("date").cast("string")
    printed = F.concat_ws("/", F.substring(iso, 9, 2), F.substring(iso, 6, 2), F.substring(iso, 1, 4))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", printed.alias("printed"))
    return orders.withColumn("day", parse_date("printed"))


def fn_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", surrogate_key("o_custkey", F.col("o_orderdate").cast("date"), status).alias("row_key")
    )


def fn_semester(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.when(F.month("o_orderdate") <= 6, 1).otherwise(2)
    printed = F.when(F.col("o_orderkey") % 2 == 0, half.cast("string")).otherwise(F.concat(F.lit("0"), half))
    period = period_of("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").cast("long").alias("year_of"),
        semester_of("o_orderdate").alias("semester"),
        normalize_semester(printed).alias("normalized"),
        period.alias("period"),
        previous_period(period).alias("period_before"),
        next_period(period).alias("period_after"),
    )


QUERIES = {
    "stg_full_refresh": stg_full_refresh,
    "stg_clean_key": stg_clean_key,
    "product_filter": product_filter,
    "clean_project": clean_project,
    "latest_per_key": latest_per_key,
    "fn_trim": fn_trim,
    "fn_blank_to_null": fn_blank_to_null,
    "fn_digits_only": fn_digits_only,
    "fn_digits_or_null": fn_digits_or_null,
    "fn_decimal_comma": fn_decimal_comma,
    "fn_parse_date": fn_parse_date,
    "fn_surrogate_key": fn_surrogate_key,
    "fn_semester": fn_semester,
}

ORACLES = {
    "stg_full_refresh": with_model("SELECT * FROM model"),
    "stg_clean_key": with_clean(f"""
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY sk_revenda_coleta ORDER BY {TIES}) AS rn FROM (
            SELECT * REPLACE (
              md5(cnpj_revenda || '-' || CAST(data_coleta AS VARCHAR) || '-' || produto) AS sk_revenda_coleta)
            FROM cleaned))
        WHERE rn = 1"""),
    "product_filter": with_raw("SELECT * FROM raw_prices WHERE \"Produto\" = 'GLP'"),
    "clean_project": with_clean("SELECT * FROM cleaned"),
    "latest_per_key": """
        SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders)
        WHERE rn = 1""",
    "fn_trim": """
        SELECT doc_id,
          CAST(length(trim(chr(8195) || chr(160) || ' ' || text || ' ' || chr(8201) || chr(12288))) AS BIGINT)
            AS spaced_length,
          md5(trim(chr(8195) || chr(160) || ' ' || text || ' ' || chr(8201) || chr(12288))) AS spaced_md5,
          md5(trim(chr(9) || text || chr(10) || chr(160))) AS tabbed_md5
        FROM documents""",
    "fn_blank_to_null": with_raw("""
        SELECT nullif(trim("Revenda"), '') AS revenda, nullif(trim("Bandeira"), '') AS bandeira,
          nullif(trim("Nome da Rua"), '') AS nome_da_rua, nullif(trim("Numero Rua"), '') AS numero_rua,
          nullif(trim("Complemento"), '') AS complemento, nullif(trim("Bairro"), '') AS bairro
        FROM raw_prices"""),
    "fn_digits_only": with_raw("""
        SELECT "CNPJ da Revenda" AS printed, regexp_replace(trim("CNPJ da Revenda"), '[^0-9]', '', 'g') AS digits
        FROM raw_prices"""),
    "fn_digits_or_null": with_raw("""
        SELECT "Cep" AS printed, regexp_replace(nullif(trim("Cep"), ''), '[^0-9]', '', 'g') AS digits
        FROM raw_prices"""),
    "fn_decimal_comma": """
        WITH priced AS (
          SELECT l_orderkey, l_partkey, l_linenumber, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS whole,
            replace(CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR), '.', ',') AS price
          FROM lineitem),
        texts AS (
          SELECT l_orderkey, l_partkey, l_linenumber,
            CASE l_linenumber WHEN 1 THEN '-' || price WHEN 2 THEN '1.' || price
              WHEN 3 THEN chr(160) || ' ' || price || '5 ' WHEN 4 THEN whole || 'e3' WHEN 5 THEN ',' || whole
              WHEN 6 THEN whole || ',' WHEN 7 THEN 'N/D' ELSE price END AS printed
          FROM priced)
        SELECT *, TRY_CAST(replace(trim(printed), ',', '.') AS DECIMAL(10,2)) AS amount FROM texts""",
    "fn_parse_date": """
        SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS printed,
          CAST(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS day
        FROM orders""",
    "fn_surrogate_key": """
        SELECT o_orderkey,
          md5(coalesce(CAST(o_custkey AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-'
            || coalesce(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-'
            || coalesce(nullif(o_orderstatus, 'P'), '_dbt_utils_surrogate_key_null_')) AS row_key
        FROM orders""",
    "fn_semester": """
        WITH halves AS (
          SELECT o_orderkey, year(o_orderdate) AS y, CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS h
          FROM orders)
        SELECT o_orderkey, CAST(y AS BIGINT) AS year_of, '0' || h AS semester,
          lpad(CASE WHEN o_orderkey % 2 = 0 THEN CAST(h AS VARCHAR) ELSE '0' || h END, 2, '0') AS normalized,
          y || '-0' || h AS period,
          CASE h WHEN 2 THEN y || '-01' ELSE (y - 1) || '-02' END AS period_before,
          CASE h WHEN 1 THEN y || '-02' ELSE (y + 1) || '-01' END AS period_after
        FROM halves""",
}
