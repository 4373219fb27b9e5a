"""Metric catalogue by its properties: every layout renames the same metrics, each in its own years."""

import pytest
from pyspark.sql import functions as F

from panelloom.contract import SCHOOL_RATES
from panelloom.operators import analytic, catalog

YEARS = range(2007, 2026)


def test_each_year_names_every_metric_once():
    for year in YEARS:
        names = catalog.alias_map(year)
        assert sorted(names.values()) == sorted(catalog.METRICS), year
        assert all(alias[:4] == metric[:4] for alias, metric in names.items()), "an alias keeps its family"


def test_years_outside_all_layouts_are_refused():
    for year in (min(YEARS) - 1, max(YEARS) + 1):
        with pytest.raises(ValueError, match=str(year)):
            catalog.alias_map(year)


def test_names_change_at_the_borders_of_periods_only():
    changes = [year for year in YEARS[1:] if catalog.alias_map(year) != catalog.alias_map(year - 1)]
    assert changes == [start for start, _ in sorted(catalog.LAYOUTS)][1:]
    last = catalog.alias_map(max(YEARS))
    assert all(alias == metric for alias, metric in last.items()), "the last layout uses the canonical names"


@pytest.mark.parametrize("family", catalog.FAMILIES)
def test_one_name_with_two_meanings(family):
    """Two aliases exchange their place among the final years and the fourth when the grades are renamed."""
    before, after = catalog.alias_map(2017), catalog.alias_map(2018)
    moved = {a: (before[a], after[a]) for a in before.keys() & after.keys() if before[a] != after[a]}
    assert moved[f"{family}_f58"] == (f"{family}_fun_af", f"{family}_fun_01")
    assert after[f"{family}_f04"] == f"{family}_fun_af"


def test_rows_agree_with_the_alias_maps(spark):
    rows = catalog.metric_catalogue(spark).collect()
    assert rows[0].__fields__ == catalog.CATALOGUE_COLUMNS and not any(v is None for r in rows for v in r)
    told = {(y, r.codigo_original): r.coluna_analitica for r in rows for y in range(r.ano_inicio, r.ano_fim + 1)}
    assert told == {(y, alias): metric for y in YEARS for alias, metric in catalog.alias_map(y).items()}
    assert len(rows) == len(catalog.LAYOUTS) * len(catalog.METRICS)


def test_descriptions_follow_from_the_metric(spark):
    rows = catalog.metric_catalogue(spark).collect()
    for row in rows:
        family, stage, *detail = row.coluna_analitica.split("_")
        assert row.tipo_taxa == catalog.FAMILIES[family] and row.etapa_ensino == catalog.STAGES[stage]
        code = detail[0] if detail else ""
        assert row.detalhamento == catalog.DETAILS.get(code, code)
        for part in (row.tipo_taxa, row.etapa_ensino, row.detalhamento):
            assert part in row.descricao


def test_match_takes_the_meaning_of_the_year(spark):
    aliases = sorted(set().union(*(catalog.alias_map(y) for y in YEARS)))
    asked = spark.createDataFrame([(y, a) for y in (2010, 2015, 2020) for a in aliases], "ano int, alias string")
    found = catalog.match_catalogue(asked, catalog.metric_catalogue(spark), "ano", "alias").collect()
    assert {(r.ano, r.alias, r.coluna_analitica) for r in found} == {
        (y, a, m) for y in (2010, 2015, 2020) for a, m in catalog.alias_map(y).items()}
    assert len(found) == 3 * len(catalog.METRICS)


def test_sources_of_a_metric_cover_its_years():
    everything = sorted(set().union(*(catalog.alias_map(y) for y in YEARS)))
    for metric, sources in analytic.metric_sources(everything).items():
        covered = {y: alias for start, end, alias in sources for y in range(start, end + 1)}
        assert covered == {y: a for y in YEARS for a, m in catalog.alias_map(y).items() if m == metric}
    assert not any(analytic.metric_sources([]).values())


def test_column_differences_add_up():
    aliases = set(catalog.alias_map(2012))
    known = set(list(sorted(aliases))[::2]) | set(SCHOOL_RATES.base[::2])
    found = {k: set(filter(None, v.split(";"))) for k, v in
             catalog.column_differences([*known, "tre_estranha", "nota"], 2012).items()}
    assert found == {"colunas_ausentes": set(SCHOOL_RATES.base) - known, "metricas_ausentes": aliases - known,
                     "colunas_desconhecidas": {"tre_estranha", "nota"}, "metricas_desconhecidas": {"tre_estranha"}}


@pytest.mark.parametrize("years,gaps", [((2009, 2013, 2010), {2011, 2012}), ((2020, 2020), set()), ((None, 2014), set()),
                                        ((), set())])
def test_year_gaps(spark, years, gaps):
    frame = spark.createDataFrame([(y,) for y in years], "ano int")
    assert {r.ano for r in catalog.year_gaps(frame, "ano").where(F.col("ano").isNotNull()).collect()} == gaps


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def wide(spark):
    """One row per year of every layout, with all aliases of all layouts as columns; only those of its own year count."""
    aliases = sorted(set().union(*(catalog.alias_map(y) for y in YEARS)))
    rows = [(y, f"{y:08d}", *[float((y * 31 + i * 7) % 131) if (y + i) % 5 else None for i in range(len(aliases))], 7.0) for y in (2006, *YEARS, 2026)]
    rows += [(2016, "90000001", *[None] * (len(aliases) + 1)), (2016, None, *[50.0] * (len(aliases) + 1)),
             (None, "90000002", *[50.0] * (len(aliases) + 1)), (2016, "90000003", *[float("nan"), float("inf"), -1.0] * (len(aliases) // 3), *[0.0] * (len(aliases) % 3 + 1))]
    return spark.createDataFrame(rows, ", ".join(["ano int", "co_entidade string", *[f"`{a}` double" for a in aliases], "tap_nova double"]))


def test_the_join_with_the_catalogue_equals_the_choice_by_year(spark):
    history = wide(spark)
    found = analytic.metrics_by_catalogue(history, catalog.metric_catalogue(spark))
    chosen = history.where("co_entidade IS NOT NULL").selectExpr("ano", "co_entidade", *[
        f"CASE WHEN ({e}) BETWEEN 0 AND 100 THEN ({e}) END AS {m}" for m, e in analytic.harmonise_metrics(history.columns, "ano").items()])
    expected = {tuple(r) for r in chosen.collect()}
    assert found.columns == chosen.columns and {tuple(r) for r in found.collect()} == expected
    assert len(expected) == len(YEARS) + 5
    assert any(v is not None for r in expected for v in r[2:]) and {r[1] for r in expected} >= {"90000001", "90000002", "90000003"}


def test_the_join_follows_an_altered_catalogue(spark):
    history = spark.createDataFrame([(2016, "00000001", 10.0, 20.0)], "ano int, co_entidade string, tap_f14 double, tap_x double")
    altered = catalog.metric_catalogue(spark).withColumn("codigo_original", F.when(F.col("codigo_original") == "tap_f14", "tap_x").otherwise(F.col("codigo_original")))
    assert analytic.metrics_by_catalogue(history, altered).first().tap_fun_ai == 20.0
    assert analytic.metrics_by_catalogue(history, catalog.metric_catalogue(spark)).first().tap_fun_ai == 10.0


def test_without_rates_or_rows(spark):
    bare = spark.createDataFrame([(2016, "00000001")], "ano int, co_entidade string")
    row = analytic.metrics_by_catalogue(bare, catalog.metric_catalogue(spark)).first()
    assert row.co_entidade == "00000001" and not any(row[m] is not None for m in catalog.METRICS)
    assert analytic.metrics_by_catalogue(wide(spark).where("false"), catalog.metric_catalogue(spark)).count() == 0
    coverage = analytic.catalogue_coverage(bare, catalog.metric_catalogue(spark))
    assert coverage.count() == 270 and coverage.where("valores > 0 OR anos > 0").count() == 0


def test_coverage_counts_each_entry_in_its_years(spark):
    history = wide(spark)
    rows = [r.asDict() for r in history.collect()]
    for entry in analytic.catalogue_coverage(history, catalog.metric_catalogue(spark)).collect():
        held = [(r["ano"], r[entry.codigo_original]) for r in rows
                if r["ano"] is not None and entry.ano_inicio <= r["ano"] <= entry.ano_fim and r[entry.codigo_original] is not None]
        assert (entry.anos, entry.valores) == (len({y for y, _ in held}), len(held)), entry
        if entry.ano_inicio not in (2015,) and held:
            assert (entry.menor, entry.maior) == (min(v for _, v in held), max(v for _, v in held))


def test_the_pivot_shuffles_once_after_merging(spark, tmp_path):
    wide(spark).write.parquet(str(tmp_path / "h"))
    catalog.metric_catalogue(spark).write.parquet(str(tmp_path / "c"))
    text = plan(analytic.metrics_by_catalogue(spark.read.parquet(str(tmp_path / "h")), spark.read.parquet(str(tmp_path / "c"))))
    assert text.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in text
    assert "NestedLoop" not in text and "SortAggregate" not in text and "Python" not in text


def test_metrics_meet_the_catalogue_by_year(spark):
    """Repeated keys give the highest value, values out of range none; rates are joined per year, not per row."""
    history = spark.createDataFrame([(2015, "1", 10.0, 30.0), (2015, "1", 20.0, 101.0), (2018, "1", 10.0, 30.0), (2018, None, 1.0, 1.0), (None, "2", 1.0, 1.0)],
                                    "ano int, co_entidade string, tap_f58 double, tap_f04 double")
    found = analytic.metrics_by_catalogue(history, catalog.metric_catalogue(spark))
    assert {(r.ano, r.co_entidade): (r.tap_fun_af, r.tap_fun_01, r.tap_fun_04, r.tap_fun_05) for r in found.collect()} == {
        (2015, "1"): (20.0, None, None, 30.0), (2018, "1"): (30.0, 10.0, None, None), (None, "2"): (None, None, None, None)}
    # Each row used to become one row per rate.
    assert "AS alias, tap_f58" not in plan(found) and "posexplode([tap_f04,tap_f58])" in plan(found)
