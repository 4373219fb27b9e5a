"""The wide fact and its content-addressed, versioned dimensions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.contract import SCHOOL_RATES, Contract, Dimension
from panelloom.functions import hashing
from panelloom.functions.numbers import within_range
from panelloom.operators.catalog import CATALOGUE_COLUMNS, LAYOUTS, METRICS, alias_map, match_catalogue


def fact_columns(contract: Contract = SCHOOL_RATES) -> list[str]:
    """Columns of the fact files; the year is the partition."""
    names = [c for c in contract.identification if c != contract.year]
    return [*names, contract.entities.id, contract.places.id, *METRICS]


def harmonise_category(column: str, names: dict[str, str]) -> Column:
    expression = F.col(column)
    for old, new in names.items():
        expression = F.when(F.col(column) == old, new).otherwise(expression)
    return expression


def metric_sources(columns: Iterable[str]) -> dict[str, list[tuple[int, int, str]]]:
    """For each metric the present aliases with the years they feed it; equal neighbours merged."""
    present = set(columns)
    sources: dict[str, list[tuple[int, int, str]]] = {m: [] for m in METRICS}
    for start, end in LAYOUTS:
        for alias, metric in alias_map(start).items():
            if alias not in present:
                continue
            spans = sources[metric]
            if spans and spans[-1][2] == alias and spans[-1][1] == start - 1:
                spans[-1] = (spans[-1][0], end, alias)
            elif any(first == start for first, _, _ in spans):
                raise ValueError(f"Aliases conflitantes para {metric} em {start}.")
            else:
                spans.append((start, end, alias))
    return sources


def harmonise_metrics(columns: Iterable[str], year: str) -> dict[str, str]:
    """One SQL expression per metric, choosing the alias by the row's year; no join, one pass."""
    expressions = {}
    for metric, spans in metric_sources(columns).items():
        branches = " ".join(f"WHEN {year} BETWEEN {start} AND {end} THEN `{alias}`" for start, end, alias in spans)
        expressions[metric] = f"CAST(CASE {branches} END AS DOUBLE)" if spans else "CAST(NULL AS DOUBLE)"
    return expressions


def rate_rows(history: DataFrame, keys: Iterable[str], contract: Contract = SCHOOL_RATES) -> DataFrame:
    """Long form: ``keys`` with `alias` and `valor`, one row per rate that has a value.

    A row without any rate stays, as one row whose alias is NULL.
    """
    rates = [F.struct(F.lit(c).alias("alias"), F.col(f"`{c}`").alias("valor")) for c in contract.rates(history.columns)]
    given = F.filter(F.array(*rates), lambda r: r["valor"].isNotNull()) if rates else F.lit(None).cast("array<struct<alias string, valor double>>")
    return history.select(*keys, F.explode_outer(given).alias("r")).select(*keys, "r.alias", "r.valor")


def metrics_by_catalogue(history: DataFrame, catalogue: DataFrame, contract: Contract = SCHOOL_RATES) -> DataFrame:
    """Year, entity and metrics by a join with catalogue rows instead of ``harmonise_metrics``, pivoted back.

    It follows any catalogue, also a stored or altered one, and so holds the published columns against the
    published catalogue.  Rates that no entry names in their year bring nothing, values out of range become NULL,
    a row without rates stays.  Year and entity have to identify a row, as the gate asks; of repeated ones the
    highest value is given.  The catalogue is joined with the history's years and rates, a table of years times
    aliases; a row meets what that found for its year, so that it takes each metric's rates by their places instead of
    holding each of its rates against every metric.  The one shuffle is as wide as the fact.
    """
    year, rates = contract.year, contract.rates(history.columns)
    keys = [year, contract.entity]
    given = F.array(*[F.expr(within_range(f"`{c}`", contract.lowest, contract.highest)) for c in rates]) if rates else F.array().cast("array<double>")
    rows = history.where(F.col(contract.entity).isNotNull()).select(*keys, given.alias("_taxas"))
    names = F.lit(rates).cast("array<string>") if rates else F.array().cast("array<string>")
    # The years come together in one task, which then needs no shuffle to group what the catalogue has for them.
    years = rows.agg(F.collect_set(year).alias("_anos")).select(F.explode("_anos").alias(year))
    aliases = years.select(year, F.posexplode(names).alias("_lugar", "alias"))
    found = match_catalogue(aliases, F.broadcast(catalogue), year, "alias").groupBy(year).agg(
        *[F.collect_list(F.when(F.col("coluna_analitica") == m, F.col("_lugar"))).alias(f"_{m}") for m in METRICS])
    # A row per year: it goes to every task.
    placed = rows.join(F.broadcast(found), year, "left")
    taken = placed.select(*keys, *[F.expr(f"array_max(transform(`_{m}`, p -> get(_taxas, p)))").alias(m) for m in METRICS])
    return taken.groupBy(*keys).agg(*[F.max(m).alias(m) for m in METRICS])


def catalogue_coverage(history: DataFrame, catalogue: DataFrame, contract: Contract = SCHOOL_RATES) -> DataFrame:
    """Each catalogue row with the years, values and bounds of what the history holds for it; unused rows count 0.

    Values are merged per year and alias, a table of years times aliases, before the intervals are joined.
    """
    year = contract.year
    rates = rate_rows(history, [year], contract).groupBy(year, "alias").agg(
        F.count("valor").alias("n"), F.min("valor").alias("menor"), F.max("valor").alias("maior"))
    used = match_catalogue(rates, catalogue, year, "alias").groupBy("codigo_original", "ano_inicio").agg(
        F.count_distinct(year).alias("anos"), F.sum("n").alias("valores"), F.min("menor").alias("menor"), F.max("maior").alias("maior"))
    return catalogue.join(used, ["codigo_original", "ano_inicio"], "left").select(
        *CATALOGUE_COLUMNS, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("anos", "valores")], "menor", "maior")


def with_content_id(rows: DataFrame, dimension: Dimension) -> DataFrame:
    return hashing.with_content_id(rows, dimension.attributes, dimension.id)


def fact_rows(history: DataFrame, contract: Contract = SCHOOL_RATES) -> DataFrame:
    """History rows that name an entity, with harmonised metrics and dimension ids.

    A column a year's file lacked is NULL in the history, so an alias can only bring values
    the file had.  Projection and filter only: no shuffle.
    """
    year = contract.year
    metrics = harmonise_metrics(history.columns, year)
    rows = history.where(F.col(contract.entity).isNotNull())
    names = [c for c in contract.identification if c != year]
    rows = rows.withColumn(contract.category, harmonise_category(contract.category, contract.category_names))
    rows = rows.selectExpr(year, *names, *[f"{e} AS {m}" for m, e in metrics.items()])
    rows = rows.selectExpr(year, *names, *[f"{within_range(m, contract.lowest, contract.highest)} AS {m}"
                                           for m in METRICS])
    for dimension in (contract.entities, contract.places):
        rows = with_content_id(rows, dimension)
    return rows.select(year, *fact_columns(contract))


def dimension_rows(rows: DataFrame, dimension: Dimension) -> DataFrame:
    """Distinct versions.  The id follows from the attributes, so whole rows are compared:
    that keeps the aggregate free of string buffers and merges copies before the shuffle.
    It is NULL exactly where the code is, and the code is the cheaper one to test."""
    return (rows.where(F.col(dimension.code).isNotNull())
            .select(dimension.id, *dimension.attributes).distinct())


def rows_per_year(rows: DataFrame, year: str, name: str = "linhas_analiticas") -> DataFrame:
    return rows.groupBy(year).agg(F.count(F.lit(1)).alias(name))
