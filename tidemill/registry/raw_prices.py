"""The given tables as raw price rows, once for Spark and once as SQL.

One raw row per ``lineitem`` row. The formulas plant what the cleaning has to cope with:
blanks around texts, blank and missing texts, quotes, separators and backslashes in names,
two spellings of one company number, other fuels, prices that are no numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.plans.fuel_prices import SOURCE, STATES

# Fixed value: first load time of the adapter.
FIRST_LOAD = "2025-01-01 00:00:00"
STATE_TEXT = "".join(STATES)
# A side is broadcast up to these sizes; texts of resellers further, as making them for every row takes twice the time.
BROADCAST_UP_TO, TEXTS_UP_TO = 64 * 1024 * 1024, 256 * 1024 * 1024
# What a built row holds at most: eleven texts of a reseller, two of a product, each in an object of its own.
RESELLER_BYTES, PRODUCT_BYTES = 600, 160
# Rows of ``lineitem`` that one task makes texts of: wide rows of so many are sorted without spilling.
ROWS_PER_TASK = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_small(rows: DataFrame, row_bytes: int, limit: int) -> bool:
    """Whether a join side with one row for each of ``rows`` may be broadcast. Counting a file reads its footers only.

    Spark takes a side that is itself a join for as large as the product of its inputs, and one that is built of a small
    file for as small as the file.
    """
    return rows.count() * row_bytes <= limit


def raw_prices(spark: SparkSession, sf_dir: str, by_period: bool = False) -> DataFrame:
    """Rows travel narrow: every exchange comes before the texts are made, those of a small reseller table once per reseller.

    The given file is one row group, so one task reads it, however many could make rows of it. The narrow rows are dealt out
    first, always, after the join with a product table too large to broadcast: partitions of a join are merged by the bytes of
    narrow rows, and the texts of that many rows don't fit a task. A raw table of many files, which the library
    itself reads, needs no such step. ``by_period`` deals them by half-year, for files of half-years, which are written without a sort.
    """
    lineitem, parts, supplier = (table(spark, sf_dir, name) for name in ("lineitem", "part", "supplier"))
    items = lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region").select("r_regionkey"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    suppliers = supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", "s_name", "n_name", "n_nationkey", "n_regionkey"
    )
    products = parts.select("p_partkey", *[v.alias(n) for n, v in _product_columns().items()])

    few_suppliers = is_small(supplier, RESELLER_BYTES, TEXTS_UP_TO)
    few_products = is_small(parts, PRODUCT_BYTES, BROADCAST_UP_TO)
    of_product, of_supplier = F.col("l_partkey") == F.col("p_partkey"), F.col("l_suppkey") == F.col("s_suppkey")

    if not few_products:
        items = items.join(products.hint("merge"), of_product).drop("l_partkey", "p_partkey")
    if not few_suppliers:
        items = items.join(suppliers.hint("merge"), of_supplier).drop("l_suppkey")
    if by_period:
        items = items.withColumn("partition", _item_columns()["partition"]).hint("rebalance", F.col("partition"))
    else:
        n_tasks = max(spark.sparkContext.defaultParallelism, -(-lineitem.count() // ROWS_PER_TASK))
        joined = not (few_products and few_suppliers)
        items = items.repartition(n_tasks, *[] if joined else ["l_orderkey"])
    texts = _reseller_columns()
    if few_suppliers:
        resellers = suppliers.select("s_suppkey", *[v.alias(n) for n, v in texts.items()])
        items = items.join(F.broadcast(resellers), of_supplier)
    if few_products:
        items = items.join(F.broadcast(products), of_product)
    rows = items if few_suppliers else items.withColumns(texts)
    return rows.withColumns(_item_columns()).select(*[F.col(f"`{name}`") for name in SOURCE.raw_schema.names])


def _reseller_columns() -> dict[str, Column]:
    key = F.col("s_suppkey")
    key8, key2 = F.lpad(key.cast("string"), 8, "0"), F.lpad((key % 100).cast("string"), 2, "0")
    printed_number = F.concat(
        F.lit(" "), F.substring(key8, 1, 2), F.lit("."), F.substring(key8, 3, 3), F.lit("."),
        F.substring(key8, 6, 3), F.lit("/0001-"), key2,
    )
    postal = F.concat(
        F.lpad((key + 20000).cast("string"), 5, "0"), F.lit("-"), F.lpad((key % 1000).cast("string"), 3, "0")
    )
    region_codes = F.array(*[F.lit(r) for r in ("N", "NE", "S", "SE", " CO ")])
    return {
        "Regiao - Sigla": F.element_at(region_codes, F.col("n_regionkey") + 1),
        "Estado - Sigla": F.substring(F.lit(STATE_TEXT), F.col("n_nationkey") * 2 + 1, F.lit(2)),
        "Municipio": F.concat(F.lit("  "), F.col("n_name"), F.lit(" ")),
        "Revenda": F.when(key % 7 == 0, "   ")
        .when(key % 7 == 1, F.concat(F.lit('POSTO "'), F.col("s_name"), F.lit('" LTDA')))
        .when(key % 7 == 2, F.concat(F.lit('POSTO "A;B" '), F.col("s_name")))
        .when(key % 7 == 3, F.concat(F.col("s_name"), F.lit(";\\")))
        .otherwise(F.col("s_name")),
        "printed_number": printed_number,
        "plain_number": F.concat(key8, F.lit("0001"), key2),
        "Nome da Rua": F.concat(F.lit("RUA "), (key % 17).cast("string")),
        "Numero Rua": F.when(key % 5 == 0, "S/N").otherwise(key.cast("string")),
        "Complemento": F.when(key % 3 == 0, "").otherwise(F.concat(F.lit(" LOJA "), (key % 4).cast("string"))),
        "Bairro": F.when(key % 9 != 0, "CENTRO"),
        "Cep": F.when(key % 11 == 0, " ").when(key % 13 == 0, "S/CEP").otherwise(postal),
    }


def _product_columns() -> dict[str, Column]:
    return {
        "Produto": F.when(F.col("p_type") == "PROMO", "GASOLINA").when(F.col("p_size") == 50, " GLP").otherwise("GLP"),
        "Bandeira": F.when(F.col("p_brand") == "Brand#1", "").otherwise(F.col("p_brand")),
    }


def _item_columns() -> dict[str, Column]:
    line, day = F.col("l_linenumber"), F.col("l_shipdate").cast("date")
    iso = day.cast("string")
    partition = F.concat(F.year(day).cast("string"), F.lit("-"), F.when(F.month(day) <= 6, "01").otherwise("02"))

    def comma(amount: str) -> Column:
        return F.replace(F.col(amount).cast("decimal(10,2)").cast("string"), F.lit("."), F.lit(","))

    return {
        "CNPJ da Revenda": F.when(line == 6, F.col("plain_number")).otherwise(F.col("printed_number")),
        "Data da Coleta": F.concat_ws("/", F.substring(iso, 9, 2), F.substring(iso, 6, 2), F.substring(iso, 1, 4)),
        "Valor de Venda": F.when(line == 7, "N/D").otherwise(comma("l_extendedprice")),
        "Valor de Compra": F.when(F.year(day) < 2000, comma("l_quantity")),
        "Unidade de Medida": F.lit("R$ / 13 kg"),
        "partition": partition,
        "source_file": F.concat(
            F.lit(f"incoming/{SOURCE.name}/partition="), partition, F.lit("/part-"), line.cast("string"), F.lit(".csv")
        ),
        "ingestion_ts": F.lit(FIRST_LOAD).cast("timestamp_ntz")
        + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("l_orderkey")),
    }


_CNPJ = """
      CASE WHEN l_linenumber = 6
           THEN lpad(CAST(s_suppkey AS VARCHAR), 8, '0') || '0001' || lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0')
           ELSE ' ' || substr(lpad(CAST(s_suppkey AS VARCHAR), 8, '0'), 1, 2)
             || '.' || substr(lpad(CAST(s_suppkey AS VARCHAR), 8, '0'), 3, 3)
             || '.' || substr(lpad(CAST(s_suppkey AS VARCHAR), 8, '0'), 6, 3)
             || '/0001-' || lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0') END"""
_PERIOD = """CAST(year(l_shipdate) AS VARCHAR) || '-' || CASE WHEN month(l_shipdate) <= 6 THEN '01' ELSE '02' END"""

RAW_SQL = f"""
  raw_prices AS (
    SELECT
      CASE n_regionkey WHEN 0 THEN 'N' WHEN 1 THEN 'NE' WHEN 2 THEN 'S' WHEN 3 THEN 'SE' WHEN 4 THEN ' CO ' END
        AS "Regiao - Sigla",
      substr('{STATE_TEXT}', CAST(n_nationkey * 2 + 1 AS BIGINT), 2) AS "Estado - Sigla",
      '  ' || n_name || ' ' AS "Municipio",
      CASE s_suppkey % 7 WHEN 0 THEN '   ' WHEN 1 THEN 'POSTO "' || s_name || '" LTDA'
           WHEN 2 THEN 'POSTO "A;B" ' || s_name WHEN 3 THEN s_name || ';' || chr(92) ELSE s_name END AS "Revenda",
      {_CNPJ} AS "CNPJ da Revenda",
      'RUA ' || CAST(s_suppkey % 17 AS VARCHAR) AS "Nome da Rua",
      CASE WHEN s_suppkey % 5 = 0 THEN 'S/N' ELSE CAST(s_suppkey AS VARCHAR) END AS "Numero Rua",
      CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE ' LOJA ' || CAST(s_suppkey % 4 AS VARCHAR) END AS "Complemento",
      CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE 'CENTRO' END AS "Bairro",
      CASE WHEN s_suppkey % 11 = 0 THEN ' ' WHEN s_suppkey % 13 = 0 THEN 'S/CEP'
           ELSE lpad(CAST(20000 + s_suppkey AS VARCHAR), 5, '0') || '-'
             || lpad(CAST(s_suppkey % 1000 AS VARCHAR), 3, '0') END AS "Cep",
      CASE WHEN p_type = 'PROMO' THEN 'GASOLINA' WHEN p_size = 50 THEN ' GLP' ELSE 'GLP' END AS "Produto",
      strftime(l_shipdate, '%d/%m/%Y') AS "Data da Coleta",
      CASE WHEN l_linenumber = 7 THEN 'N/D'
           ELSE replace(CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR), '.', ',') END AS "Valor de Venda",
      CASE WHEN year(l_shipdate) >= 2000 THEN NULL
           ELSE replace(CAST(CAST(l_quantity AS DECIMAL(10,2)) AS VARCHAR), '.', ',') END AS "Valor de Compra",
      'R$ / 13 kg' AS "Unidade de Medida",
      CASE WHEN p_brand = 'Brand#1' THEN '' ELSE p_brand END AS "Bandeira",
      {_PERIOD} AS "partition",
      'incoming/{SOURCE.name}/partition=' || {_PERIOD} || '/part-' || CAST(l_linenumber AS VARCHAR) || '.csv'
        AS source_file,
      TIMESTAMP '{FIRST_LOAD}' + to_seconds(l_orderkey) AS ingestion_ts
    FROM lineitem
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey)"""

_NULL = "'_dbt_utils_surrogate_key_null_'"
DATE_SQL = """CAST(strptime("Data da Coleta", '%d/%m/%Y') AS DATE)"""
KEY_SQL = f"""md5(coalesce("CNPJ da Revenda", {_NULL}) || '-' || coalesce(CAST({DATE_SQL} AS VARCHAR), {_NULL})
         || '-' || coalesce("Produto", {_NULL}))"""

CLEAN_SQL = f"""
  cleaned AS (
    SELECT
      {KEY_SQL} AS sk_revenda_coleta,
      trim("Regiao - Sigla") AS regiao_sigla,
      trim("Estado - Sigla") AS estado_sigla,
      trim("Municipio") AS municipio,
      nullif(trim("Revenda"), '') AS nome_revenda,
      regexp_replace(trim("CNPJ da Revenda"), '[^0-9]', '', 'g') AS cnpj_revenda,
      nullif(trim("Bandeira"), '') AS bandeira,
      nullif(trim("Nome da Rua"), '') AS nome_rua,
      nullif(trim("Numero Rua"), '') AS numero_rua,
      nullif(trim("Complemento"), '') AS complemento,
      nullif(trim("Bairro"), '') AS bairro,
      regexp_replace(nullif(trim("Cep"), ''), '[^0-9]', '', 'g') AS cep,
      trim("Produto") AS produto,
      trim("Unidade de Medida") AS unidade_medida,
      {DATE_SQL} AS data_coleta,
      TRY_CAST(replace(trim("Valor de Venda"), ',', '.') AS DECIMAL(10,2)) AS valor_venda,
      TRY_CAST(replace(trim("Valor de Compra"), ',', '.') AS DECIMAL(10,2)) AS valor_compra,
      "partition", source_file, CAST(ingestion_ts AS TIMESTAMP) AS ingestion_ts
    FROM raw_prices
    WHERE "Produto" = 'GLP')"""

# Load time, then file, then every other column: no two different rows tie.
TIES = ", ".join(
    f"{c} DESC"
    for c in (
        "ingestion_ts", "source_file", "regiao_sigla", "estado_sigla", "municipio", "nome_revenda", "cnpj_revenda",
        "bandeira", "nome_rua", "numero_rua", "complemento", "bairro", "cep", "produto", "unidade_medida",
        "data_coleta", "valor_venda", "valor_compra", '"partition"',
    )
)

MODEL_SQL = f"""
  model AS (
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY sk_revenda_coleta ORDER BY {TIES}) AS rn
      FROM cleaned)
    WHERE rn = 1)"""


def with_raw(select: str) -> str:
    return f"WITH {RAW_SQL}\n{select}"


def with_clean(select: str) -> str:
    return f"WITH {RAW_SQL},{CLEAN_SQL}\n{select}"


def with_model(select: str) -> str:
    return f"WITH {RAW_SQL},{CLEAN_SQL},{MODEL_SQL}\n{select}"
