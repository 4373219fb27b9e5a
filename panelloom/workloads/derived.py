"""Yearly tables and sheets that Spark derives from orders, line items and customers.

They have the shape the engine is made for: one row per order (or per customer and year),
layouts that change in 2018 and 2021, versioned names, missing and malformed codes, rates
out of range and text in rate columns.  Their size is that of the tables behind them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.contract import SCHOOL_RATES
from panelloom.functions.text import padded
from panelloom.operators.typing_rules import FLAGS, type_rows

RATES = ["tap_fun", "tap_f58", "tap_f04", "tap_fun_ai", "tap_fun_af", "tre_fun", "tre_mns", "tre_med_ns",
         "tab_fun", "tab_f00", "tab_fun_02", "tab_extra"]
PANEL = ["ano", "no_regiao", "sg_uf", "co_municipio", "no_municipio", "co_entidade", "no_entidade",
         "tipoloca", "dependad", *RATES, "fonte_arquivo", "fonte_caminho", "fonte_aba", "observador"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_numbers(spark: SparkSession, folder: str, per_customer: bool) -> DataFrame:
    """Per order, or per customer and year: how many lines, how many of each flag, total quantity."""
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("l_returnflag") == flag).alias(f"n_{flag.lower()}") for flag in "RAN"],
        F.sum(F.col("l_quantity").cast("long")).alias("qty"))
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", (F.year("o_orderdate") + 20).alias("y"))
    numbers = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    if per_customer:
        numbers = numbers.groupBy("y", "o_custkey").agg(
            F.min("o_orderkey").alias("o_orderkey"),
            *[F.sum(c).alias(c) for c in ("n", "n_r", "n_a", "n_n", "qty")])
    return numbers


def _tenths(amount: str, mark: str) -> Column:
    return F.expr(f"concat(CAST({amount} div 10 AS STRING), '{mark}', CAST({amount} % 10 AS STRING))")


def panel_rows(spark: SparkSession, folder: str, per_customer: bool = False) -> DataFrame:
    """Rows of all years as they would be read from yearly tables: everything is text."""
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = order_numbers(spark, folder, per_customer).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    # Spread evenly before the rows become wide text: order keys are unique, so no partition is
    # hot, and a table that is one small file does not leave everything to one task.
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    rows = rows.selectExpr("*", *[f"{c} * 1000 div n AS s{c[1:]}" for c in ("n_r", "n_a", "n_n")], "qty * 25 div n AS mean")
    key, order, year = F.col("c_custkey"), F.col("o_orderkey"), F.col("y")
    nation = F.col("n_nationkey")
    states = F.array(*[F.lit(s) for s in SCHOOL_RATES.states])
    auxiliary = order % 53 == 0
    digits = F.when(key % 31 == 0, 5).otherwise(7)
    share = {c: f"s{c[1:]}" for c in ("n_r", "n_a", "n_n")}
    mean = "mean"
    recent, middle = year >= 2021, year.between(2018, 2020)
    values = {
        "ano": F.when(key % 7 == 0, F.concat(year.cast("string"), F.lit(".0"))).otherwise(year.cast("string")),
        "no_regiao": F.concat(F.lit(" "), F.col("r_name")),
        "sg_uf": F.when(nation < 24, F.get(states, nation)).otherwise("XX"),
        "co_municipio": F.when(key % 29 != 0, F.lpad((nation * 40 + key % 40).cast("string"), digits, F.lit("0"))),
        "no_municipio": F.concat(F.lit("Município "), nation.cast("string"), F.lit("-"), (key % 40).cast("string"),
                                 F.when((year >= 2018) & (key % 40 < 10), " Novo").otherwise("")),
        "co_entidade": F.when(~auxiliary, F.concat(F.when(key % 37 == 0, "ABC").otherwise(""),
                                                   padded(key, 8))),
        "no_entidade": F.concat("c_name", F.when((year >= 2019) & (key % 3 == 0), " B").otherwise(" ")),
        "tipoloca": F.when(key % 2 == 0, "Urbana").otherwise("Rural"),
        "dependad": F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Particular")
        .when(F.col("c_mktsegment") == "MACHINERY", "Estadual").otherwise("Municipal"),
        "tap_fun": F.when(auxiliary & (order % 2 == 0), F.lit("Cabeçalho \"auxiliar\"")).otherwise(_tenths(share["n_n"], ",")),
        "tap_f58": F.when(~recent, _tenths(share["n_r"], ".")),
        "tap_f04": F.when(middle, _tenths(share["n_a"], ",")),
        "tap_fun_ai": F.when(recent, _tenths(share["n_r"], ",")),
        "tap_fun_af": F.when(recent, _tenths(share["n_a"], ",")),
        "tre_fun": F.when(auxiliary & (order % 3 == 0), "total").otherwise(_tenths(mean, ".")),
        "tre_mns": F.when(~recent, F.when(order % 4 == 0, "--").otherwise(_tenths(share["n_a"], ","))),
        "tre_med_ns": F.when(recent, F.when(order % 4 == 0, "-").otherwise(_tenths(share["n_a"], ","))),
        "tab_fun": F.concat(F.lit(" "), F.when(order % 101 == 0, "-2").when(order % 103 == 0, "inf")
                            .otherwise(_tenths(share["n_r"], ",")), F.lit(" ")),
        "tab_f00": F.when(~recent, _tenths(mean, ",")),
        "tab_fun_02": F.when(recent, _tenths(mean, ",")),
        "tab_extra": F.col("n").cast("string"),
        "fonte_arquivo": F.concat(F.lit("tx_"), year.cast("string"), F.lit(".xlsx")),
        "fonte_caminho": F.concat(F.lit("raw/tx_"), year.cast("string"), F.lit(".xlsx")),
        "fonte_aba": F.lit("ESCOLAS"),
        "observador": F.when(order % 2 == 0, F.lit("  ")).otherwise(F.concat(F.lit("o"), (order % 10).cast("string"))),
    }
    return rows.select(*[values[c].alias(c) for c in PANEL], "y", "o_orderkey", "c_custkey")


def typed_panel(spark: SparkSession, folder: str, per_customer: bool = False) -> DataFrame:
    """``panel_rows`` typed like a history, its flags included."""
    columns = SCHOOL_RATES.history_columns([PANEL])
    return type_rows(panel_rows(spark, folder, per_customer), columns, F.col("y"), F.col("o_orderkey"))


def panel_history(spark: SparkSession, folder: str, per_customer: bool = False) -> DataFrame:
    return typed_panel(spark, folder, per_customer).drop(*FLAGS)


# The order of the cells in a derived sheet, and its header rows before and from 2018 on.
OLD_HEADER = ["Ano", "Região", "UF", "Código do Município", "Nome do Município", "Código da Escola",
              "Nome da Escola", "Localização", "Rede", "Taxa de Aprovação", None, "Taxa de Reprovação",
              "TAB_FUN", "Observações"]
OLD_BELOW = [None] * 9 + ["Aprovação no Ens. Fundamental", "Aprovação - 1º ano do Ensino Fundamental", None, None, None]
NEW_HEADER = ["NU_ANO_CENSO", "NO_REGIAO", "SG_UF", "CO_MUNICIPIO", "NO_MUNICIPIO", "CO_ENTIDADE",
              "NO_ENTIDADE", "NO_CATEGORIA", "NO_DEPENDENCIA", "1_CAT_FUN", "2_CAT_FUN", "2_CAT_FUN",
              "3_CAT_FUN", "Observações"]
REGION_SHEETS = ["Norte", "Nordeste", "Sudeste", "Sul", "Centro-Oeste"]


def cell_grid(spark: SparkSession, folder: str) -> DataFrame:
    """One file per year; five regional sheets before 2018, ``ESCOLAS`` beside ``Notas`` after."""
    rows = panel_rows(spark, folder, per_customer=True)
    customer = F.col("c_custkey")
    region = F.pmod(customer, F.lit(5)).cast("int")
    old = F.col("y") < 2018
    regions = F.array(*[F.lit(r) for r in REGION_SHEETS])
    year_cell = F.when(customer % 41 == 0, "--").when(customer % 5 != 0, F.col("y").cast("string"))
    cells = F.array(year_cell, *[F.col(c) for c in PANEL[1:9]],
                    "tap_fun", F.when(customer % 13 == 0, " NaN ").otherwise(F.col("tre_fun")), "tre_fun",
                    "tab_fun", F.lit("nota"))
    data = rows.select(
        F.concat(F.lit("dados/raw/rendimento_escolas_"), F.col("y").cast("string"), F.lit(".xlsx")).alias("file"),
        F.when(old, F.get(regions, region)).otherwise(F.when(customer % 10 == 9, "Notas").otherwise("ESCOLAS")).alias("sheet"),
        F.when(old, region).otherwise(F.when(customer % 10 == 9, 0).otherwise(1)).cast("int").alias("sheet_idx"),
        (customer + 3).alias("row_idx"), cells.alias("cells"), old.alias("old"))

    def line(number: int, values: Column) -> Column:
        return F.struct(F.lit(number).cast("long").alias("row_idx"), values.alias("cells"))

    def texts(values: list[str | None]) -> Column:
        return F.array(*[F.lit(v).cast("string") for v in values])

    title = line(0, texts(["Taxas de Rendimento por Escola"]))
    heads = data.groupBy("file", "sheet", "sheet_idx", "old").agg(F.min("row_idx").alias("first"))
    heads = heads.select("file", "sheet", "sheet_idx", F.explode(
        F.when(F.col("old"), F.array(title, line(1, texts(OLD_HEADER)), line(2, texts(OLD_BELOW))))
        .otherwise(F.array(title, line(1, texts(NEW_HEADER))))).alias("line"))
    heads = heads.select("file", "sheet", "sheet_idx", "line.row_idx", "line.cells")
    return data.drop("old").unionByName(heads)
