"""Metric catalogue: which source alias feeds which canonical metric in which years."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.contract import SCHOOL_RATES, Contract

# Metric families, canonical slices and, per period, the source suffix of each
# slice in the same order.  ``f04`` and ``f58`` change their meaning in 2018.
FAMILIES = {"tap": "aprovacao", "tre": "reprovacao", "tab": "abandono"}
SLICES = ("fun fun_ai fun_af fun_01 fun_02 fun_03 fun_04 fun_05 fun_06 fun_07 fun_08 fun_09 "
          "med med_01 med_02 med_03 med_04 med_ns").split()
LAYOUTS = {
    (2007, 2010): "fundamental 1a_a_4a_serie_1o_a_5o_ano 5a_a_8a_serie_6o_ao_9o_ano 1o_aensifundamental "
                  "1a_serie_2o_ano 2a_serie_3o_ano 3a_serie_4o_ano 4a_serie_5o_ano "
                  "5a_serie_6o_ano 6a_serie_7o_ano 7a_serie_8o_ano 8a_serie_9o_ano "
                  "medio 1a_serie_medio 2a_serie_medio 3a_serie_medio 4a_serie_medio medio_nao_seriado",
    (2011, 2014): "ens_fundamental anos_iniciais_1o_ao_5o_ano anos_finais_6o_ao_9o_ano "
                  "1o_ano 2o_ano 3o_ano 4o_ano 5o_ano 6o_ano 7o_ano 8o_ano 9o_ano "
                  "ens_medio 1a_serie 2a_serie 3a_serie 4a_serie medio_nao_seriado",
    (2015, 2017): "fun f14 f58 f00 f01 f02 f03 f04 f05 f06 f07 f08 med m01 m02 m03 m04 mns",
    (2018, 2020): "fun f14 f04 f58 f00 f01 f02 f03 f05 f06 f07 f08 med m01 m02 m03 m04 mns",
    (2021, 2025): "fun fun_ai fun_af fun_01 fun_02 fun_03 fun_04 fun_05 fun_06 fun_07 fun_08 fun_09 "
                  "med med_01 med_02 med_03 med_04 med_ns",
}
STAGES = {"fun": "ensino_fundamental", "med": "ensino_medio"}
DETAILS = {"": "total", "ai": "anos_iniciais", "af": "anos_finais", "ns": "nao_seriado"}
NOTE = "Séries/anos de 8 e 9 anos conforme cabeçalho da fonte; não somar recortes."

METRICS = [f"{family}_{piece}" for family in FAMILIES for piece in SLICES]
CATALOGUE_COLUMNS = ["codigo_original", "coluna_analitica", "ano_inicio", "ano_fim", "tipo_taxa",
                     "etapa_ensino", "detalhamento", "descricao", "observacao"]


def layout_of(year: int) -> tuple[int, int]:
    for period in LAYOUTS:
        if period[0] <= year <= period[1]:
            return period
    raise ValueError(f"Layout do ano {year} ainda não validado no catálogo de métricas.")


def alias_map(year: int) -> dict[str, str]:
    """Source column to canonical metric for one year."""
    pairs = list(zip(LAYOUTS[layout_of(year)].split(), SLICES, strict=True))
    return {f"{family}_{source}": f"{family}_{piece}" for family in FAMILIES for source, piece in pairs}


def metric_catalogue(spark: SparkSession) -> DataFrame:
    """One row per period, family and slice, described from the parts of its name."""
    layouts = spark.createDataFrame(
        [(start, end, sources.split(), list(SLICES), list(FAMILIES), list(FAMILIES.values()))
         for (start, end), sources in LAYOUTS.items()],
        "ano_inicio long, ano_fim long, fontes array<string>, recortes array<string>, "
        "familias array<string>, tipos array<string>")
    rows = (layouts
            .select("ano_inicio", "ano_fim", F.arrays_zip("familias", "tipos").alias("f"),
                    F.arrays_zip("fontes", "recortes").alias("r"))
            .withColumn("f", F.explode("f"))
            .withColumn("r", F.explode("r")))
    piece = F.col("r.recortes")
    detail = F.substring_index(piece, "_", -1)
    detail = F.when(~piece.contains("_"), F.lit("")).otherwise(detail)
    known_details = F.create_map(*[F.lit(x) for pair in DETAILS.items() for x in pair])
    stage = F.when(piece.startswith("fun"), STAGES["fun"]).otherwise(STAGES["med"])
    rows = rows.select(
        F.concat_ws("_", "f.familias", "r.fontes").alias("codigo_original"),
        F.concat_ws("_", F.col("f.familias"), piece).alias("coluna_analitica"),
        "ano_inicio", "ano_fim",
        F.col("f.tipos").alias("tipo_taxa"),
        stage.alias("etapa_ensino"),
        F.coalesce(F.try_element_at(known_details, detail), detail).alias("detalhamento"))
    return rows.select(
        "*",
        F.format_string("Percentual de %s: %s, %s", "tipo_taxa", "etapa_ensino", "detalhamento").alias("descricao"),
        F.lit(NOTE).alias("observacao"))


def match_catalogue(rows: DataFrame, catalogue: DataFrame, year: str, alias: str, how: str = "inner") -> DataFrame:
    """Long-form rows joined to the catalogue row of their alias valid in their year.

    Equality on the alias keeps it a hash join; the optimizer knows the catalogue's size.
    """
    entry = catalogue
    on = ((rows[alias] == entry["codigo_original"])
          & rows[year].between(entry["ano_inicio"], entry["ano_fim"]))
    return rows.join(entry, on, how)


def column_differences(columns: Iterable[str], year: int, contract: Contract = SCHOOL_RATES) -> dict[str, str]:
    """Base columns and metrics a file lacks, and columns and rates nobody knows."""
    present, aliases, base = set(columns), set(alias_map(year)), set(contract.base)
    return {
        "colunas_ausentes": ";".join(sorted(base - present)),
        "colunas_desconhecidas": ";".join(sorted(present - base - aliases)),
        "metricas_ausentes": ";".join(sorted(aliases - present)),
        "metricas_desconhecidas": ";".join(sorted(set(contract.rates(present)) - aliases)),
    }


def sorted_difference(left: Column, right: Column) -> Column:
    """``;``-joined sorted elements of one array column missing in another."""
    return F.array_join(F.array_sort(F.array_except(left, right)), ";")


def with_column_differences(files: DataFrame, expected: Column, present: Column) -> DataFrame:
    """The same comparison for a table with one row per file and its columns as an array."""
    return files.select(
        "*",
        sorted_difference(expected, present).alias("colunas_ausentes"),
        sorted_difference(present, expected).alias("colunas_desconhecidas"),
        F.size(F.array_except(expected, present)).alias("quantidade_colunas_ausentes"))


def year_gaps(rows: DataFrame, year: str) -> DataFrame:
    """Years between the first and the last that do not occur."""
    present = rows.select(year).where(F.col(year).isNotNull()).distinct()
    bounds = present.agg(F.min(year).alias("primeiro"), F.max(year).alias("ultimo"))
    expected = (bounds.where(F.col("primeiro").isNotNull())
                .select(F.explode(F.sequence("primeiro", "ultimo")).alias(year)))
    return expected.join(present, year, "left_anti")
