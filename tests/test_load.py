"""Loading a star into snapshots: preconditions, activation, failure, views."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.contract import SCHOOL_RATES
from panelloom.operators import checks, views
from panelloom.operators.catalog import METRICS, metric_catalogue
from panelloom.plans import consolidate, load
from panelloom.plans.publish import type_names
from panelloom.sources import files, reports, yearly
from test_checks import ENTITY, PLACE


def products(spark, tmp_path, rate=98.125, years=(2024,)):
    origin, control = tmp_path / "origem", tmp_path / "relatorios"
    fact_type = T.StructType([*checks.fact_schema().fields, T.StructField("ano", T.IntegerType())])
    row = {**ENTITY, "id_escola": "b" * 64, "id_municipio": "a" * 64, **dict.fromkeys(METRICS), METRICS[0]: rate}
    tables = {
        "dim_municipios.parquet": spark.createDataFrame([{"id_municipio": "a" * 64, **PLACE}], checks.dimension_schema(SCHOOL_RATES.places)),
        "dim_escolas.parquet": spark.createDataFrame([{"id_escola": "b" * 64, **ENTITY}], checks.dimension_schema(SCHOOL_RATES.entities)),
        "dim_metricas.parquet": metric_catalogue(spark)}
    for name, table in tables.items():
        table.coalesce(1).write.mode("overwrite").parquet(str(origin / name))
    fact = spark.createDataFrame([{**row, "ano": y} for y in years], fact_type)
    fact.coalesce(1).write.mode("overwrite").partitionBy("ano").parquet(str(origin / "taxas"))
    control.mkdir(exist_ok=True)
    register(spark, origin, control)
    total = {"ano": "TOTAL", "status": "ok", "publicado": True, "linhas_analiticas": len(years),
             "anos_processados": ";".join(map(str, years)), "observacao": ""}
    reports.write_csv(reports.rows_to_report(spark, [total]), str(control / load.CONSOLIDATION_REPORT))
    return origin, control


def register(spark, origin, control):
    schemas = {n: type_names(spark.read.parquet(p).schema) for n, p in consolidate.star_files(spark, str(origin)).items()}
    (control / load.SCHEMA_REGISTRY).write_text(json.dumps({"schemas": schemas}))


def run(spark, tmp_path):
    return load.load(spark, str(tmp_path / "origem"), str(tmp_path / "relatorios"), str(tmp_path / "banco"))


def published(spark, tmp_path):
    return load.read_publication(spark, str(tmp_path / "banco"))


def test_missing_products(spark, tmp_path):
    with pytest.raises(checks.CheckFailed, match="dim_municipios.*taxas.*relatorio_consolidacao"):
        load.require_present(spark, str(tmp_path), str(tmp_path))
    (tmp_path / "relatorios").mkdir()
    result = run(spark, tmp_path)
    assert result["status"] == "falha" and result["commit_confirmado"] is False
    saved = json.loads((tmp_path / "relatorios" / load.LOAD_REPORT).read_text(encoding="utf-8"))
    assert saved["id_execucao"] == result["id_execucao"]
    assert load.load_log(spark, str(tmp_path / "banco")).count() == 0


def test_capture(spark, tmp_path):
    origin, control = products(spark, tmp_path)
    manifest = load.capture(spark, str(origin), str(control))
    assert (manifest["quantidade_linhas"], manifest["anos"], manifest["quantidade_metricas_catalogo"]) == (1, [2024], 270)
    assert len(manifest["arquivos"]) == 6 and all(len(f["sha256"]) == 64 for f in manifest["arquivos"])


@pytest.mark.parametrize("change", ["publication", "schema", "count", "year"])
def test_control_mismatch(spark, tmp_path, change):
    origin, control = products(spark, tmp_path)
    if change == "schema":
        (control / load.SCHEMA_REGISTRY).write_text('{"schemas": {}}')
    else:
        total = {"ano": "TOTAL", "status": "ok", "publicado": change != "publication",
                 "linhas_analiticas": 2 if change == "count" else 1,
                 "anos_processados": "2023" if change == "year" else "2024", "observacao": ""}
        reports.write_csv(reports.rows_to_report(spark, [total]), str(control / load.CONSOLIDATION_REPORT))
    with pytest.raises(checks.CheckFailed):
        load.capture(spark, str(origin), str(control))


def test_manifest_follows_content_per_file(spark, tmp_path):
    """A row moved within its file is no change; a changed value, a NULL that changes columns or a new file is."""
    def write(name, rows):
        spark.createDataFrame(rows, "a string, b string").coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        return str(tmp_path / name)

    before = files.table_manifest(spark, write("uma tabela", [("x", None), ("y", "z")]))
    same, other = (files.table_manifest(spark, write(n, rows)) for n, rows in (
        ("outra", [("y", "z"), ("x", None)]), ("trocada", [(None, "x"), ("y", "z")])))
    first = before.first()
    assert "uma" in first.caminho and len(first.sha256) == 64 and first.tamanho > 0
    assert same.first().sha256 == first.sha256 != other.first().sha256
    kept = spark.createDataFrame(before.collect(), before.schema)
    assert files.manifest_changes(kept, before).isEmpty()
    load.require_unchanged(kept, before)
    after = files.table_manifest(spark, write("uma tabela", [("novo", "n")]))
    change = files.manifest_changes(kept, after).collect()
    assert [(c.sha256_antes, c.sha256_depois is None) for c in change] == [(None, False)]
    with pytest.raises(checks.CheckFailed, match="mudou"):
        load.require_unchanged(kept, after)
    unhashed = spark.createDataFrame([("f", None)], "caminho string, sha256 string")
    assert files.manifest_changes(unhashed, unhashed).isEmpty()
    assert files.manifest_changes(unhashed, unhashed.where("false")).count() == 1


def test_success_repeat_failure_and_shrinking(spark, tmp_path, monkeypatch):
    products(spark, tmp_path, years=(2023, 2024))
    first = run(spark, tmp_path)
    assert first["status"] == "sucesso", first.get("mensagem_erro")
    second = run(spark, tmp_path)
    assert second["status"] == "sucesso" and second["commit_confirmado"]
    log = {r.id_execucao: r for r in load.load_log(spark, str(tmp_path / "banco")).collect()}
    assert [r for r, s in log.items() if s.carga_ativa] == [second["id_execucao"]]
    tables = published(spark, tmp_path)
    assert {t: df.count() for t, df in tables.items()} == {
        "dim_municipio": 1, "dim_escola": 1, "catalogo_metricas": 270, "fato_rendimento_escolar": 2}
    assert tables["dim_escola"].first().id_municipio == "a" * 64
    assert tables["fato_rendimento_escolar"].columns == checks.COLUMNS[checks.FACT]

    write = load.write_snapshot

    def broken(staged, path):
        write(staged, path)
        raise OSError("falha injetada")

    monkeypatch.setattr(load, "write_snapshot", broken)
    third = run(spark, tmp_path)
    monkeypatch.undo()
    assert third["status"] == "falha" and "injetada" in third["mensagem_erro"]
    row = load.load_log(spark, str(tmp_path / "banco")).where(F.col("id_execucao") == third["id_execucao"]).first()
    assert (row.status, row.carga_ativa, row.quantidade_linhas) == ("falha", False, None) and "injetada" in row.mensagem_erro
    assert not (tmp_path / "banco/versoes" / f"v={third['id_execucao']}").exists()
    assert load.active_load(spark, str(tmp_path / "banco")).id_execucao == second["id_execucao"]
    assert published(spark, tmp_path)["fato_rendimento_escolar"].first().tap_fun == 98.125

    products(spark, tmp_path, years=(2024,))
    import shutil
    shutil.rmtree(tmp_path / "origem/taxas/ano=2023", ignore_errors=True)
    register(spark, tmp_path / "origem", tmp_path / "relatorios")
    fourth = run(spark, tmp_path)
    assert fourth["status"] == "falha" and "redução de ano 2023" in fourth["mensagem_erro"], fourth
    load.register_views(spark, str(tmp_path / "banco"))
    view = spark.sql("SELECT ano, co_municipio FROM vw_fato_rendimento_escolar ORDER BY ano").collect()
    assert [tuple(r) for r in view] == [(2023, "0012345"), (2024, "0012345")]
    assert spark.sql("SELECT ano_referencia FROM dim_municipio_canonica").first()[0] == 2024


def test_every_earlier_state_can_be_read(spark, tmp_path):
    store = str(tmp_path / "banco")
    seen = []
    for rate in (10.0, 20.0):
        products(spark, tmp_path, rate=rate)
        seen.append(run(spark, tmp_path)["id_execucao"])
    events = [(e.sequencia, e.id_execucao, e.status) for e in load.load_events(spark, store).orderBy("sequencia").collect()]
    assert events == [(1, seen[0], "em_execucao"), (2, seen[0], "sucesso"), (3, seen[1], "em_execucao"), (4, seen[1], "sucesso")]
    states = {n: {r.id_execucao: (r.status, r.carga_ativa) for r in load.load_log(spark, store, n).collect()} for n in range(5)}
    assert states[0] == {} and states[1] == {seen[0]: ("em_execucao", False)} and states[2] == {seen[0]: ("sucesso", True)}
    assert states[3] == {seen[0]: ("sucesso", True), seen[1]: ("em_execucao", False)}
    assert states[4] == {seen[0]: ("sucesso", False), seen[1]: ("sucesso", True)}
    rates = [load.read_publication(spark, store, n)["fato_rendimento_escolar"].first().tap_fun for n in (2, 3, 4, None)]
    assert rates == [10.0, 10.0, 20.0, 20.0]
    with pytest.raises(checks.CheckFailed, match="Nenhuma"):
        load.read_publication(spark, store, 1)
    assert load.vacuum(spark, store, keep=1) == [f"v={seen[0]}"]
    assert load.read_publication(spark, store)["fato_rendimento_escolar"].first().tap_fun == 20.0


def test_of_two_loads_one_is_activated(spark, tmp_path, monkeypatch):
    """A load that is overtaken while it checks is refused, and its snapshot goes."""
    products(spark, tmp_path)
    overtaken = load.write_snapshot

    def overtaking(tables, path):
        overtaken(tables, path)
        monkeypatch.setattr(load, "write_snapshot", overtaken)
        assert run(spark, tmp_path)["status"] == "sucesso"

    monkeypatch.setattr(load, "write_snapshot", overtaking)
    slow = run(spark, tmp_path)
    assert slow["status"] == "falha" and "Outra carga" in slow["mensagem_erro"]
    states = {r.id_execucao: (r.status, r.carga_ativa) for r in load.load_log(spark, str(tmp_path / "banco")).collect()}
    assert states.pop(slow["id_execucao"]) == ("falha", False) and list(states.values()) == [("sucesso", True)]
    assert len(list((tmp_path / "banco/versoes").iterdir())) == 1


def test_interrupted_run_is_closed(spark, tmp_path):
    from datetime import datetime, timezone
    products(spark, tmp_path)
    load.append_event(spark, str(tmp_path / "banco"), {"id_execucao": "antiga", "inicio": datetime.now(timezone.utc),
                                                       "status": load.RUNNING, "versao_pipeline": "x", "manifesto_origem": "{}"})
    assert run(spark, tmp_path)["status"] == "sucesso"
    old = load.load_log(spark, str(tmp_path / "banco")).where("id_execucao = 'antiga'").first()
    assert old.status == load.INTERRUPTED and old.fim is not None and not old.carga_ativa


def test_fact_files_name_one_year(spark, tmp_path):
    root = tmp_path / "ano=1/taxas"
    spark.createDataFrame([(1, 2024)], "v int, ano int").write.partitionBy("ano").parquet(str(root))
    assert [tuple(r) for r in yearly.read_fact(spark, str(root)).collect()] == [(1, 2024)]
    spark.createDataFrame([(2, None)], "v int, ano int").write.mode("append").partitionBy("ano").parquet(str(root))
    with pytest.raises(ValueError, match="HIVE_DEFAULT"):
        yearly.read_fact(spark, str(root))


def test_canonical_place(spark):
    places = spark.createDataFrame([(c * 64, "0012345", c, "SP", "Sudeste") for c in "abcd"],
                                   "id_municipio string, co_municipio string, no_municipio string, sg_uf string, no_regiao string")
    seen = [("a", 2007), ("b", 2024)]

    def chosen():
        fact = spark.createDataFrame([(c * 64, y) for c, y in seen] + [(None, 2024)], "id_municipio string, ano int")
        rows = views.canonical_place(places, fact, SCHOOL_RATES.places.attributes, "id_municipio", "co_municipio", "ano").collect()
        assert len(rows) == 1 and rows[0].ano_referencia == 2024
        enriched = views.enrich_fact(fact, places, "id_municipio", ["co_municipio"])
        assert enriched.count() == fact.count() and enriched.where("co_municipio is null").count() == 1
        return rows[0].no_municipio

    assert chosen() == "b"
    for observed, expected in (("c", "b"), ("c", "c"), ("b", "b")):
        seen.append((observed, 2024))
        assert chosen() == expected
    none = views.canonical_place(places, spark.createDataFrame([], "id_municipio string, ano int"),
                                 SCHOOL_RATES.places.attributes, "id_municipio", "co_municipio", "ano").first()
    assert (none.no_municipio, none.ano_referencia) == ("a", None)


def test_canonical_entity_and_codes(spark):
    versions = spark.createDataFrame([("v1", "1", "Antiga"), ("v2", "1", "Nova"), ("v3", "1", "Outra"), ("v4", "2", "B")],
                                     "id string, codigo string, nome string")
    fact = spark.createDataFrame([("v1", "1", 2020), ("v3", "1", 2024), ("v2", "1", 2024), ("v4", "2", 2020)],
                                 "id string, codigo string, ano int")
    rows = views.canonical_entity(versions, fact, "id", "codigo", "ano", ["nome", "codigo"]).collect()
    assert {(r.codigo, r.id, r.ano_referencia, r.rotulo) for r in rows} == {
        ("1", "v2", 2024, "Nova - 1"), ("2", "v4", 2020, "B - 2")}
    assert views.distinct_codes(fact, "codigo").first().codigos == 2
    assert {(r.ano, r.codigos) for r in views.distinct_codes(fact, "codigo", ["ano"]).collect()} == {(2020, 2), (2024, 1)}
