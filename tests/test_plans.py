"""What the physical plans must and must not contain."""

import pytest

from panelloom.contract import SCHOOL_RATES
from panelloom.operators import analytic, audit, checks, views
from panelloom.plans import consolidate
from panelloom.workloads import derived
from test_load import products

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    origin, _ = products(spark, tmp_path_factory.mktemp("plans"), years=(2023, 2024))
    return consolidate.closed_fact(spark, str(origin))


def test_year_filter_prunes_partitions(fact):
    text = plan(views.one_year(fact, "ano", 2024).select("co_entidade"))
    assert "PartitionFilters: [isnotnull(ano" in text and "tap_fun" not in text


def test_a_join_on_years_prunes_partitions(spark, fact, tmp_path):
    spark.createDataFrame([(2023, "a"), (2024, "b")], "ano int, x string").write.parquet(str(tmp_path / "anos"))
    years = spark.read.parquet(str(tmp_path / "anos")).where("x = 'b'")
    found = views.of_years(fact, years, "ano").select("ano", "co_entidade")
    assert "PartitionFilters: [isnotnull(ano" in plan(found) and "dynamicpruning" in plan(found)
    assert [r.ano for r in found.collect()] == [2024]


def test_dimensions_read_their_columns_only(fact):
    text = plan(analytic.dimension_rows(fact, SCHOOL_RATES.places))
    assert "tap_fun" not in text and "no_entidade" not in text
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_fact_needs_no_shuffle_and_no_python(spark, tmp_path):
    derived.panel_history(spark, FOLDER).write.parquet(str(tmp_path / "h"))
    text = plan(analytic.fact_rows(spark.read.parquet(str(tmp_path / "h"))))
    assert "Exchange" not in text and "Python" not in text and "PushedFilters: [IsNotNull(co_entidade)]" in text


def test_audit_groups_hash_and_shuffle_once(spark, tmp_path):
    derived.typed_panel(spark, FOLDER).write.parquet(str(tmp_path / "t"))
    text = plan(audit.history_groups(spark.read.parquet(str(tmp_path / "t"))))
    assert text.count("Exchange") == 1 and "SortAggregate" not in text and "Python" not in text


def test_null_safe_match_is_an_equality_join(spark, fact):
    entities = analytic.dimension_rows(fact, SCHOOL_RATES.entities)
    text = plan(checks.match_places(entities, analytic.dimension_rows(fact, SCHOOL_RATES.places)))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_no_cross_joins_in_load_checks(spark, fact):
    star = {checks.FACT: fact, checks.ENTITIES: analytic.dimension_rows(fact, SCHOOL_RATES.entities),
            checks.PLACES: analytic.dimension_rows(fact, SCHOOL_RATES.places)}
    from panelloom.operators.catalog import metric_catalogue
    from panelloom.plans.load import staged_tables
    tables = staged_tables({**star, checks.CATALOGUE: metric_catalogue(spark)})
    text = plan(checks.load_checks(tables, metric_catalogue(spark)))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_breach_counts_need_no_sort(spark):
    """Counts only in the buffers: many contents of a year stay in a hash aggregate."""
    groups = audit.history_groups(derived.typed_panel(spark, FOLDER))
    text = plan(audit.contract_breaches(groups).groupBy().count()) + plan(audit.contract_breaches(groups))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_row_positions_stay_in_hash_aggregates(spark):
    """The first position of a content is a decimal, which a hash aggregate can update in place."""
    rows = spark.range(10).selectExpr("id % 3 AS k", "CAST(id AS DECIMAL(38,0)) AS o")
    text = plan(rows.groupBy("k").min("o"))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_load_checks_need_few_passes(spark, tmp_path):
    """Two passes over the fact and at most two over every other table; all aggregates hash."""
    from panelloom.operators.catalog import metric_catalogue
    from panelloom.plans.load import staged_tables
    origin, _ = products(spark, tmp_path, years=(2023, 2024))
    paths = {checks.PLACES: "dim_municipios.parquet", checks.ENTITIES: "dim_escolas.parquet", checks.CATALOGUE: "dim_metricas.parquet"}
    tables = {t: spark.read.parquet(str(origin / p)) for t, p in paths.items()}
    tables[checks.FACT] = consolidate.closed_fact(spark, str(origin))
    tables = staged_tables(tables)
    tables[checks.ENTITIES].write.parquet(str(tmp_path / "casadas"))
    tables[checks.ENTITIES] = spark.read.parquet(str(tmp_path / "casadas"))
    previous = {t: spark.read.parquet(str(origin / paths[t])) for t in (checks.ENTITIES, checks.PLACES)}
    found = checks.load_checks(tables, metric_catalogue(spark), previous)
    found.collect()
    text = plan(found)
    final = text[:text.index("== Initial Plan ==")] if "== Initial Plan ==" in text else text
    assert text.count("/taxas") <= 2 * max(1, text.count("== Initial Plan ==") + 1)
    assert final.count("FileScan parquet") <= 11 and "SortAggregate" not in final
