"""Data-quality audit of the typed history, per year and in total.

The rows are shuffled once, reduced to one narrow row per distinct content.  Grouping by
the content signature spreads even the rows without a code, and copies of one row are
already merged before the shuffle, so no hot code or year gathers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.contract import SCHOOL_RATES, Contract
from panelloom.functions.hashing import row_signature
from panelloom.functions.numbers import flag, out_of_range, total
from panelloom.functions.text import quote
from panelloom.operators.typing_rules import (
    FLAGS, NUMERIC_CODE, ORDER, TEXT_CELLS, TEXT_RATE, WRONG_YEAR,
)

COUNTERS = ["quantidade_linhas_entrada", "quantidade_linhas_consolidadas", "quantidade_linhas_descartadas",
            "escolas_ausentes", "municipios_ausentes", "codigos_escola_invalidos",
            "codigos_municipio_invalidos", "ufs_invalidas", "valores_invalidos", "valores_textuais",
            "duplicidades_ano_escola", "duplicatas_exatas", "conflitos_ano_escola"]
UNIQUES = ["quantidade_escolas", "municipios_unicos", "ufs_encontradas"]
# The counters that alone turn a year's status into a warning.
WARNING_COUNTERS = ["escolas_ausentes", "municipios_ausentes", "ufs_invalidas", "valores_invalidos",
                    "valores_textuais", "codigos_escola_invalidos", "codigos_municipio_invalidos"]


def malformed_code(column: str, digits: int) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).rlike(rf"\A[0-9]{{{digits}}}\z")


def outside_domain(column: str, domain: Sequence[str]) -> Column:
    """True for NULL too: a missing value is not in the domain."""
    return F.coalesce(~F.col(column).isin(*domain), F.lit(True))


def invalid_cells(columns: Sequence[str], lowest: float, highest: float) -> Column:
    return F.expr(total([flag(out_of_range(quote(c), lowest, highest)) for c in columns]))


def content_groups(rows: DataFrame, keys: Sequence[str], content: Sequence[str], order: Column,
                   carried: dict[str, Column] | None = None) -> DataFrame:
    """One row per distinct content: keys, signature, copies ``n``, first position ``ordem``.

    ``keys`` must be part of the content, and ``carried`` are numbers that follow from it.
    All buffers have a fixed width, so Spark keeps to hash aggregation.
    """
    carried = carried or {}
    narrow = rows.select(*keys, row_signature(content).alias("assinatura"), order.alias("ordem"),
                         *[c.alias(name) for name, c in carried.items()])
    return (narrow.groupBy(*keys, "assinatura")
            .agg(F.count(F.lit(1)).alias("n"), F.min("ordem").alias("ordem"),
                 *[F.max(name).alias(name) for name in carried]))


def duplicate_counts(groups: DataFrame, scope: Sequence[str], code: str) -> DataFrame:
    """Excess copies per scope: exact ones, repeated codes, and repeats unlike the first.

    A NULL code takes part in the exact copies only.
    """
    per_code = (groups.groupBy(*scope, code)
                .agg(F.sum("n").alias("linhas"), F.count(F.lit(1)).alias("conteudos"),
                     F.min_by("n", "ordem").alias("iguais_ao_primeiro")))
    coded = F.col(code).isNotNull()
    return (per_code.groupBy(*scope)
            .agg(F.sum(F.col("linhas") - F.col("conteudos")).alias("duplicatas_exatas"),
                 F.coalesce(F.sum(F.when(coded, F.col("linhas") - 1)), F.lit(0)).alias("duplicidades_ano_escola"),
                 F.coalesce(F.sum(F.when(coded, F.col("linhas") - F.col("iguais_ao_primeiro"))), F.lit(0))
                 .alias("conflitos_ano_escola"),
                 F.count_if(coded).alias("codigos")))


def key_excess(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys repeat, and how many rows are beyond the first of their key."""
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return repeated.agg(F.count_if(F.col("n") > 1).alias("grupos"),
                        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excedentes"))


def counts_with_total(rows: DataFrame, year: str, code: str) -> DataFrame:
    """Rows and distinct codes per year and over all years.

    The total counts the union of the codes, hence no ``rollup``; both start from one
    aggregate by year and code, so a hot code is merged before it travels.
    """
    pairs = rows.groupBy(year, code).agg(F.count(F.lit(1)).alias("n"))
    coded = F.count_if(F.col(code).isNotNull()).alias("codigos")
    yearly = pairs.groupBy(year).agg(F.sum("n").alias("linhas"), coded)
    total = pairs.groupBy(code).agg(F.sum("n").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("linhas"), coded)
    return (yearly.select(F.col(year).cast("string").alias(year), "linhas", "codigos")
            .unionAll(total.select(F.lit("TOTAL").alias(year), "linhas", "codigos")))


def history_groups(typed: DataFrame, contract: Contract = SCHOOL_RATES) -> DataFrame:
    """``content_groups`` of typed history rows with everything the audit counts."""
    columns = [c for c in typed.columns if c not in FLAGS]
    content = [c for c in columns if c not in contract.provenance]
    rates = [c for c in columns if contract.is_rate(c)]
    # Flags that depend on the input but not on the typed content are keys of their own.
    flagged = typed.withColumn(TEXT_RATE, F.coalesce(TEXT_RATE, F.lit("")))
    return content_groups(
        flagged,
        [contract.year, contract.entity, contract.place, contract.state,
         TEXT_RATE, WRONG_YEAR, NUMERIC_CODE],
        content, F.col(ORDER),
        {"celulas_invalidas": invalid_cells(rates, contract.lowest, contract.highest),
         "celulas_textuais": F.col(TEXT_CELLS)})


def contract_breaches(groups: DataFrame, contract: Contract = SCHOOL_RATES) -> DataFrame:
    """Per year, rows with a wrong year, a numeric code, or rate text in a known entity."""
    rows = F.col("n")
    return (groups.groupBy(contract.year)
            .agg(F.sum(F.when(F.col(WRONG_YEAR), rows).otherwise(0)).alias("anos_divergentes"),
                 F.sum(F.when(F.col(NUMERIC_CODE), rows).otherwise(0)).alias("codigos_numericos"),
                 F.sum(F.when(F.col(TEXT_RATE) != "", rows).otherwise(0)).alias("taxas_textuais_escola")))


def first_text_rates(groups: DataFrame, contract: Contract = SCHOOL_RATES) -> DataFrame:
    """Per year, the first rate with text in a known entity; only offending contents are grouped."""
    return (groups.where(F.col(TEXT_RATE) != "").groupBy(contract.year)
            .agg(F.min(TEXT_RATE).alias("primeira_taxa_textual")))


def _tally(groups: DataFrame, scope: list[str], contract: Contract) -> DataFrame:
    rows = F.col("n")

    def where(condition: Column) -> Column:
        return F.sum(F.when(condition, rows).otherwise(0))

    return groups.groupBy(*scope).agg(
        F.sum(rows).alias("quantidade_linhas_entrada"),
        F.sum(rows).alias("quantidade_linhas_consolidadas"),
        F.lit(0).cast("long").alias("quantidade_linhas_descartadas"),
        where(F.col(contract.entity).isNull()).alias("escolas_ausentes"),
        where(F.col(contract.place).isNull()).alias("municipios_ausentes"),
        where(malformed_code(contract.entity, contract.code_digits[contract.entity])).alias("codigos_escola_invalidos"),
        where(malformed_code(contract.place, contract.code_digits[contract.place])).alias("codigos_municipio_invalidos"),
        where(outside_domain(contract.state, contract.states)).alias("ufs_invalidas"),
        F.sum(rows * F.col("celulas_invalidas")).alias("valores_invalidos"),
        F.sum(rows * F.col("celulas_textuais")).alias("valores_textuais"))


def _distinct_places(groups: DataFrame, scope: list[str], contract: Contract) -> DataFrame:
    return (groups.where(F.col(contract.place).isNotNull()).select(*scope, contract.place).distinct()
            .groupBy(*scope).agg(F.count(F.lit(1)).alias("municipios_unicos")))


def _distinct_states(groups: DataFrame, scope: list[str], contract: Contract) -> DataFrame:
    return (groups.where(F.col(contract.state).isNotNull()).select(*scope, contract.state).distinct()
            .groupBy(*scope)
            .agg(F.array_join(F.array_sort(F.collect_list(contract.state)), ";").alias("ufs_encontradas")))


def audit_by_year(groups: DataFrame, contract: Contract = SCHOOL_RATES) -> DataFrame:
    """One row per year with every counter."""
    year = contract.year
    parts = [_distinct_places(groups, [year], contract), _distinct_states(groups, [year], contract)]
    duplicates = (duplicate_counts(groups, [year], contract.entity)
                  .withColumnRenamed("codigos", "quantidade_escolas"))
    report = _tally(groups, [year], contract).join(duplicates, year, "left")
    for part in parts:
        report = report.join(part, year, "left")
    return (report.na.fill(0, ["municipios_unicos"]).na.fill("", ["ufs_encontradas"])
            .select(year, *COUNTERS, *UNIQUES))


def audit_total(groups: DataFrame, contract: Contract = SCHOOL_RATES) -> DataFrame:
    """One row over all years: counters add up, distinct values are counted anew."""
    sums = audit_by_year(groups, contract).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS])
    entities = (groups.where(F.col(contract.entity).isNotNull()).select(contract.entity).distinct()
                .agg(F.count(F.lit(1)).alias("quantidade_escolas")))
    distinct = (entities, _distinct_places(groups, [], contract), _distinct_states(groups, [], contract))
    return sums.select(F.lit("TOTAL").alias(contract.year), *COUNTERS,
                       *[one.scalar().alias(name) for one, name in zip(distinct, UNIQUES, strict=True)])


def audit_report(groups: DataFrame, contract: Contract = SCHOOL_RATES) -> DataFrame:
    yearly = audit_by_year(groups, contract)
    return (yearly.withColumn(contract.year, F.col(contract.year).cast("string"))
            .unionByName(audit_total(groups, contract)))


def year_status(report: DataFrame, column_issues: Column | None = None) -> Column:
    """``erro`` for repeated keys, ``aviso`` for any warning counter or column issue, else ``ok``."""
    warned = F.expr(f"{total(WARNING_COUNTERS)} > 0")
    if column_issues is not None:
        warned = warned | column_issues
    return (F.when(F.col("duplicidades_ano_escola") > 0, "erro")
            .when(warned, "aviso").otherwise("ok"))


def status_counts(rows: DataFrame, status: str = "status") -> DataFrame:
    """How many rows are ``ok``, ``aviso`` and ``erro``, zeros included."""
    return rows.agg(*[F.count_if(F.col(status) == s).alias(s) for s in ("ok", "aviso", "erro")])


def rows_of_ok_files(report: DataFrame) -> DataFrame:
    lines = F.col("quantidade_linhas").try_cast("long")
    return report.agg(F.coalesce(F.sum(F.when(F.col("status") == "ok", lines)), F.lit(0)).alias("linhas_padronizadas"))


def reconcile(left: DataFrame, right: DataFrame, key: str, left_count: str, right_count: str) -> DataFrame:
    """Keys whose two counts differ, a missing side counting as zero."""
    joined = left.select(key, left_count).join(right.select(key, right_count), key, "full")
    joined = joined.na.fill(0, [left_count, right_count])
    return joined.where(F.col(left_count) != F.col(right_count))
