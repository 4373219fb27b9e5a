"""Integrity of a star, checks of a staged publication, and the building blocks under them."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.contract import SCHOOL_RATES
from panelloom.functions.numbers import out_of_range
from panelloom.operators import audit, checks
from panelloom.operators.catalog import METRICS, metric_catalogue
from panelloom.operators.checks import CATALOGUE, ENTITIES, FACT, PLACES
from panelloom.plans.load import staged_tables, validate

PLACE = {"co_municipio": "0012345", "no_municipio": "Município", "sg_uf": "SP", "no_regiao": "Sudeste"}
ENTITY = {"co_entidade": "00123456", "no_entidade": "Escola", "tipoloca": "Urbana", "dependad": "Privada", **PLACE}


@pytest.mark.parametrize("name", ["escola", "municipio"])
@pytest.mark.parametrize("fault,message", [("orphan", "Referência inválida"), ("double", "nula/duplicada"),
                                           ("null", "nula/duplicada"), ("code", "Código divergente")])
def test_broken_star(spark, name, fault, message):
    fact = spark.createDataFrame([("e", "00123456", "m", "0012345")],
                                 "id_escola string, co_entidade string, id_municipio string, co_municipio string")
    dims = {"escola": spark.createDataFrame([("e", "00123456")], "id_escola string, co_entidade string"),
            "municipio": spark.createDataFrame([("m", "0012345")], "id_municipio string, co_municipio string")}
    checks.require_integrity(checks.integrity_checks(fact, dims["escola"], dims["municipio"]))
    good, code = dims[name], dims[name].columns[1]
    dims[name] = {"orphan": good.where("false"), "double": good.unionAll(good),
                  "null": good.withColumn(f"id_{name}", F.lit(None).cast("string")),
                  "code": good.withColumn(code, F.lit("outro"))}[fault]
    with pytest.raises(checks.CheckFailed, match=message):
        checks.require_integrity(checks.integrity_checks(fact, dims["escola"], dims["municipio"]))


def test_uneven_nulls(spark):
    fact = spark.createDataFrame([("e", "1", None, "2"), (None, None, None, None), ("e", "1", None, None)],
                                 "id_escola string, co_entidade string, id_municipio string, co_municipio string")
    entities = spark.createDataFrame([("e", "1")], "id_escola string, co_entidade string")
    places = spark.createDataFrame([("m", "2")], "id_municipio string, co_municipio string")
    found = {r.validacao: r.divergencias for r in checks.integrity_checks(fact, entities, places).collect()}
    assert found["escola_referencia_nula"] == 1 and found["municipio_referencia_nula"] == 1


@pytest.fixture(scope="module")
def star(spark):
    fact_row = {**ENTITY, "id_escola": "b" * 64, "id_municipio": "a" * 64, **dict.fromkeys(METRICS), METRICS[0]: 98.125}
    fact_type = T.StructType([*checks.fact_schema().fields, T.StructField("ano", T.IntegerType())])
    return {
        PLACES: spark.createDataFrame([{"id_municipio": "a" * 64, **PLACE}], checks.dimension_schema(SCHOOL_RATES.places)),
        ENTITIES: spark.createDataFrame([{"id_escola": "b" * 64, **ENTITY}], checks.dimension_schema(SCHOOL_RATES.entities)),
        CATALOGUE: metric_catalogue(spark),
        FACT: spark.createDataFrame([{**fact_row, "ano": 2024}], fact_type)}


MANIFEST = {"anos": [2024], "ano_minimo": 2024, "ano_maximo": 2024, "quantidade_linhas": 1, "quantidade_escolas": 1,
            "quantidade_municipios": 1, "quantidade_metricas_catalogo": 270}


def put(column, value):
    return lambda df: df.withColumn(column, F.lit(value).cast(df.schema[column].dataType))


def test_sound_star_passes(star):
    results = {}
    counts = validate(staged_tables(star), MANIFEST, results)
    assert counts["quantidade_codigos_escola"] == counts["quantidade_codigos_municipio"] == 1
    assert results["por_ano"] == {2024: 1} and results["nulos_metricas"]["tap_fun"] == 0
    assert results["nulos_metricas"]["tab_med"] == 1 and results["taxas_fora_faixa"] == 0


@pytest.mark.parametrize("table,change,check", [
    (FACT, lambda df: df.unionAll(df), "duplicidade_fato"), (FACT, put("id_escola", "c" * 64), "fk_escola"),
    (FACT, put("id_municipio", "c" * 64), "fk_municipio_fato"), (FACT, put("id_municipio", None), "atributos_fato"),
    (FACT, put("no_entidade", "Divergente"), "atributos_fato"), (FACT, put("tap_fun", -1.0), "taxas_fora_faixa"),
    (FACT, put("tap_fun", 101.0), "taxas_fora_faixa"), (FACT, put("tap_fun", float("nan")), "taxas_fora_faixa"),
    (FACT, put("tap_fun", float("inf")), "taxas_fora_faixa"),
    (CATALOGUE, put("coluna_analitica", "inesperada"), "catalogo_incompativel"),
    (ENTITIES, put("co_municipio", "9999999"), "correspondencia_municipal"),
    (ENTITIES, put("id_escola", "hash_invalido"), "hash_dim_escola"), (PLACES, put("co_municipio", None), "nulos_dim_municipio")])
def test_staged_corruptions(star, table, change, check):
    tables = staged_tables({**star, table: change(star[table])})
    found = {r.validacao: r.divergencias for r in
             checks.load_checks(tables, metric_catalogue(star[FACT].sparkSession)).collect()}
    assert any(count for name, count in found.items() if name.startswith(check)), found


def test_entity_without_place_code_keeps_its_geography(star):
    tables = staged_tables({**star, ENTITIES: put("co_municipio", None)(star[ENTITIES]),
                            FACT: put("id_municipio", None)(put("co_municipio", None)(star[FACT]))})
    validate(tables, MANIFEST, {})
    row = tables[ENTITIES].first()
    assert (row.id_municipio, row.co_municipio, row.no_municipio, row.sg_uf) == (None, None, "Município", "SP")


@pytest.mark.parametrize("change", [{"quantidade_linhas": 2}, {"ano_maximo": 2025}, {"anos": [2023]}])
def test_counts_must_match_the_manifest(star, change):
    with pytest.raises(checks.CheckFailed):
        validate(staged_tables(star), {**MANIFEST, **change}, {})


@pytest.mark.parametrize("value,bad", [(-0.1, 1), (100.1, 1), (float("nan"), 1), (float("inf"), 1), (-float("inf"), 1),
                                       (None, 0), (0.0, 0), (100.0, 0)])
def test_rate_rule(spark, value, bad):
    frame = spark.createDataFrame([(value,)], "tap_fun double")
    rule = F.expr(out_of_range("tap_fun", SCHOOL_RATES.lowest, SCHOOL_RATES.highest))
    assert checks.count_violations(frame, {"faixa": rule}).first().divergencias == bad


def test_schema_differences_by_kind():
    expected = T.StructType().add("codigo", "string").add("taxa", "double").add("nome", "string")
    cases = {
        "nome string, taxa double, codigo string": {},
        "codigo string, taxa double": {"em falta": ["nome"]},
        "codigo string, taxa double, nome string, nova integer": {"a mais": ["nova"]},
        "codigo long, taxa double, nome string": {"de outro tipo": ["codigo (bigint, não string)"]},
        "codigo string, taxa double, nome string, nome string": {"repetidas": ["nome"]},
        "taxa string": {"em falta": ["codigo", "nome"], "de outro tipo": ["taxa (string, não double)"]},
    }
    for columns, different in cases.items():
        found = T.StructType()
        for column in columns.split(", "):
            found = found.add(*column.split())
        assert checks.schema_differences(found, expected) == different, columns


def test_shrinkage():
    old = {"anos": [2023, 2024], "quantidade_linhas": 5, "quantidade_escolas": 2, "quantidade_municipios": 1}
    assert checks.shrinkage(old, {**old, "anos": [2023, 2024, 2025]}) == []
    assert checks.shrinkage(old, {**old, "anos": [2024], "quantidade_linhas": 4}) == ["ano 2023", "quantidade_linhas"]


def test_gate_stops_at_the_first_violation(spark):
    rows = spark.createDataFrame([("a", 0), ("b", 2), ("c", 1)], "validacao string, divergencias long")
    results = {}
    with pytest.raises(checks.CheckFailed, match="Validação b: 2"):
        checks.gate(rows, results, order=["a", "b", "c"])
    assert results == {"a": 0, "b": 2, "c": 1}


def test_content_diff_and_multisets(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (2, None), (3, "x"), (4, "d")], "k int, v string")
    assert sorted(r.k for r in checks.content_diff(left, right, ["k"], ["k", "v"]).collect()) == [3, 4]
    assert checks.multiset_difference(left, left.unionAll(left)).count() == 3
    twice = spark.createDataFrame([(5, "a"), (5, "a"), (6, "b"), (None, "n")], "k int, v string")
    other = spark.createDataFrame([(5, "c"), (5, "c"), (6, "b"), (None, "n")], "k int, v string")
    assert [r.k for r in checks.content_diff(twice, other, ["k"], ["k", "v"]).collect()] == [5]
    assert checks.content_diff(twice, twice.repartition(3), ["k"], ["k", "v"]).isEmpty()
    assert sorted(tuple(r) for r in checks.multiset_difference(twice, other).collect()) == [(5, "a"), (5, "a"), (5, "c"), (5, "c")]


def test_audit_against_brute_force(spark):
    import random
    rng = random.Random(11)
    rows = [(rng.choice([2020, 2021]), rng.choice([None, "a", "b", "c"]), rng.choice(["x", "y"]), i) for i in range(300)]
    expected = {}
    for year in (2020, 2021):
        seen, first, exact, repeats, conflicts = set(), {}, 0, 0, 0
        for y, code, value, _ in sorted(rows, key=lambda r: r[3]):
            if y != year:
                continue
            exact += (code, value) in seen
            seen.add((code, value))
            if code is not None:
                repeats += code in first
                conflicts += code in first and first[code] != value
                first.setdefault(code, value)
        expected[year] = (exact, repeats, conflicts, len(first))
    frame = spark.createDataFrame(rows, "ano int, codigo string, v string, i long").repartition(5)
    groups = audit.content_groups(frame, ["ano", "codigo"], ["ano", "codigo", "v"], F.col("i"))
    found = {r.ano: (r.duplicatas_exatas, r.duplicidades_ano_escola, r.conflitos_ano_escola, r.codigos)
             for r in audit.duplicate_counts(groups, ["ano"], "codigo").collect()}
    assert found == expected


@pytest.mark.parametrize("counts,status", [({}, "ok"), ({"valores_textuais": 1}, "aviso"), ({"ufs_invalidas": 2}, "aviso"),
                                           ({"duplicatas_exatas": 3}, "ok"),
                                           ({"duplicidades_ano_escola": 1, "ufs_invalidas": 1}, "erro")])
def test_year_status(spark, counts, status):
    row = {**dict.fromkeys(audit.COUNTERS, 0), **counts}
    frame = spark.createDataFrame([row], ", ".join(f"{c} long" for c in audit.COUNTERS))
    assert frame.select(audit.year_status(frame).alias("s")).first().s == status


def test_status_summaries(spark):
    report = spark.createDataFrame([("ok", "5"), ("ok", ""), ("aviso", "7")], "status string, quantidade_linhas string")
    assert tuple(audit.status_counts(report).first()) == (2, 1, 0)
    assert audit.rows_of_ok_files(report).first()[0] == 5
