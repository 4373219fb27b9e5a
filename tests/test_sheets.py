"""Cell grids: header search, column names, standardised rows, reports and their flow."""

import pytest
from pyspark.sql import functions as F

from panelloom.operators import headers, sheets
from panelloom.plans import consolidate, standardise
from panelloom.sources import files, fs, grid as grid_source, reports

RAW = "dados/rendimento_escolar"


def grid_of(spark, *parts):
    """parts: (file, sheet, sheet_idx, [row, ...]); numbers rows from 0."""
    rows = [(file, sheet, index, number, row) for file, sheet, index, lines in parts for number, row in enumerate(lines)]
    return spark.createDataFrame(rows, grid_source.GRID_SCHEMA)


def inventory_of(spark, *paths):
    return files.inventory_of(spark.createDataFrame([(p,) for p in paths], "caminho string"))


IDS = ["Ano", "Região", "UF", "Código do Município", "Nome do Município", "Código da Escola", "Nome da Escola",
       "Localização", "Rede"]
ROW = [None, "Norte", "AC", "1200013", "Acrelândia", "12000001", "Escola A", "Urbana", "Municipal"]
OLD = f"{RAW}/tx_2009.xlsx"
NEW = f"{RAW}/tx_2024.xlsx"


@pytest.mark.parametrize("text,suffix", [
    ("taxa_de_aprovacao_-_total_ensino_fundamental", "ensifundamental"),
    ("1o_ano_do_ensino_fundamental", "1o_aensifundamental"), ("1a_serie/2o_ano", "1a_serie_2o_ano"),
    ("aprovacaona_1a_a_4a_serie/1o_a_5o_ano", "1a_a_4a_serie_1o_a_5o_ano"),
    ("medio_nao-seriado", "medio_nao_seriado"), ("total_", "coluna_07"), ("taxa_de_", "coluna_07")])
def test_rate_suffix(spark, text, suffix):
    row = spark.range(1).select(headers.rate_suffix(F.lit(text), F.lit(7)).alias("s")).first()
    assert row.s == suffix


@pytest.mark.parametrize("name,text,expected", [
    ("tap_fun", "x", "tap_fun"), ("1_cat_fun_ai", "x", "tap_fun_ai"), ("2_cat_med", "x", "tre_med"),
    ("3_cat_f00", "x", "tab_f00"), ("1_outro", "x", None), ("", "taxa_de_abandono_medio", "tab_medio"),
    ("x", "reprovacao_1o_ano", "tre_1o_ano"), ("observacao", "observacao", None)])
def test_rate_column(spark, name, text, expected):
    row = spark.range(1).select(headers.rate_column(F.lit(name), F.lit(text), F.lit(0)).alias("s")).first()
    assert row.s == expected


def test_audit_rate_is_looser(spark):
    names = ["tap_x", "1_x", "3_cat_y", "x_taxa_de_abandono", "aprovacao", "4_x"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select(headers.is_audit_rate(F.col("n")).alias("r"))
    assert [r.r for r in rows.collect()] == [True, True, True, True, False, False]


@pytest.mark.parametrize("names,chosen,note", [
    (["Notas", "Dados escola", "ESCOLAS "], "ESCOLAS ", 0), (["Notas", "Dados escola", "Minha Escola"], "Dados escola", 1),
    (["Notas", "Outra"], "Notas", 2)])
def test_choose_sheet(spark, names, chosen, note):
    grid = grid_of(spark, *[("f", n, i, [["a"]]) for i, n in enumerate(names)])
    row = headers.choose_sheet(headers.sheets_of(grid)).first()
    assert (row.sheet, row.sheet_note, row.sheet_count) == (chosen, headers.SHEET_NOTES[note], len(names))


def test_region_sheets(spark):
    names = ["Norte", "NORDESTE 1", "Centro-Oeste", "centro oeste", "Centro_Oeste", "Súl", "ESCOLAS", "Oeste"]
    grid = grid_of(spark, *[("f", n, i, [["a"]]) for i, n in enumerate(names)])
    found = headers.sheets_of(grid)
    assert {r.sheet for r in found.where("regional").collect()} == set(names[:6])
    assert {r.sheet for r in headers.sheets_to_clean(found).collect()} == set(names[:6])
    plain = grid_of(spark, ("g", "Notas", 0, [["a"]]), ("g", "ESCOLAS", 1, [["a"]]))
    assert [r.sheet for r in headers.sheets_to_clean(headers.sheets_of(plain)).collect()] == ["ESCOLAS"]
    assert headers.sheets_to_audit(headers.sheets_of(plain)).count() == 2


def test_header_row(spark):
    lines = [["Taxas"], [None], ["ano", "tap_fun"], ["ano", "co_entidade"], ["2024", "1"]]
    late = [["x"]] * 30 + [["ano", "co_entidade"]]
    grid = grid_of(spark, ("f", "A", 0, lines), ("f", "B", 1, [["x", None], ["y"]]), ("f", "C", 2, late),
                   ("f", "D", 3, [["ano", "uf"], ["ano", "uf"]]))
    found = {r.sheet: (r.header_row, r.header_note) for r in headers.detect_headers(grid).collect()}
    assert found == {"A": (3, headers.HEADER_FOUND), "B": (0, headers.HEADER_MISSING),
                     "C": (0, headers.HEADER_MISSING), "D": (0, headers.HEADER_FOUND)}


def column_targets(spark, *lines):
    found = headers.detect_headers(grid_of(spark, ("f", "A", 0, list(lines))))
    return [r.target for r in headers.map_columns(headers.header_columns(found)).orderBy("pos").collect()]


def test_two_header_rows_are_filled_and_numbered(spark):
    top = ["ANO", "Código da Escola", "Taxa de Aprovação", None, "Unnamed: 4", "Taxa de Abandono", "TAP_X", "TAP_X"]
    below = [None, None, "Aprovação Ensino Médio", None, "Aprovação Ensino Médio", None, None, None]
    assert column_targets(spark, ["título"], top, below) == [
        "ano", "co_entidade", "tap_ensimedio", "tap_aprovacao", "tap_ensimedio_2", "tab_abandono", "tap_x", "tap_x_2"]


def test_repeated_identification_is_numbered(spark):
    assert column_targets(spark, ["ANO", "UF", "uf", "Observação", "Observação"]) == [
        "ano", "sg_uf", "sg_uf_2", "observacao", "observacao_2"]


def test_forward_fill_and_numbering_in_chunks(spark):
    rows = spark.createDataFrame([(k, i, f"v{i}" if i % 7 == 3 else None, "n") for k in "ab" for i in range(50)],
                                 "k string, i int, v string, n string")
    plain = headers.forward_fill(rows, F.col("v"), ["k"], "i", "f").orderBy("k", "i").collect()
    assert headers.forward_fill_chunked(rows, F.col("v"), ["k"], "i", "f", width=6).orderBy("k", "i").collect() == plain
    plain = headers.unique_names(rows, ["k"], "i", "n", "u").orderBy("k", "i").collect()
    assert headers.unique_names_chunked(rows, ["k"], "i", "n", "u", width=6).orderBy("k", "i").collect() == plain


@pytest.fixture(scope="module")
def example(spark):
    head = [*IDS, "Taxa de Aprovação", None, "TAB_FUN", "Rede"]
    below = [None] * 9 + ["Ensino Fundamental - Aprovação", "1º ano do Ensino Fundamental - Aprovação", None, None]
    north = [["Título"], head, below,
             [*ROW, "93,1", "--", " NaN ", "x"],
             ["--", *ROW[1:], "1", "2", "3", "x"],
             ["2008", *ROW[1:5], "12000002", *ROW[6:], "7", None, "－", "x"],
             ["Fonte: censo", *[None] * 12]]
    centre = [head, ["2009", *ROW[1:5], "52000001", *ROW[6:], "50", "60", "1", "x"]]
    new = [["NU_ANO_CENSO", "CO_ENTIDADE", "1_CAT_FUN", "1_CAT_FUN", "2_CAT_MED"],
           ["2024", "00123456", "92,1", "5", "null"], ["2024", "00123457", "80", None, "4"]]
    grid = grid_of(spark, (OLD, "Norte", 0, north), (OLD, "Centro-Oeste", 1, centre), (OLD, "Notas", 2, [["x"]]),
                   (NEW, "Leia-me", 0, [["nada"]]), (NEW, "ESCOLAS", 1, new))
    return grid, inventory_of(spark, OLD, NEW, f"{RAW}/tx_2020.xlsx", f"{RAW}/sem_ano.xlsx")


RATES_FOUND = ["tab_fun", "tap_1o_aensifundamental_aprovacao", "tap_ensifundamental_aprovacao", "tap_fun", "tap_fun_2",
               "tre_med"]


def test_standardised_rows(spark, example):
    grid, inventory = example
    layouts = sheets.sheet_layouts(grid, inventory)
    rates = sorted({r.target for r in sheets.layout_names(layouts).collect()})
    assert rates == RATES_FOUND
    rows = sheets.standardised_rows(grid, layouts, rates)
    old = {r.co_entidade: r for r in rows.where(F.col("fonte_caminho") == OLD).collect()}
    # The row below the header has no year of its own, gets the file's, and stays as an auxiliary row.
    assert set(old) == {None, "12000001", "12000002", "52000001"}
    first = old["12000001"]
    assert (first.ano, first.tab_fun, first.fonte_aba, first.fonte_arquivo) == ("2009", None, "Norte", "tx_2009.xlsx")
    assert old["12000002"].ano == "2008" and old["12000002"].tab_fun is None
    assert old["52000001"].fonte_aba == "Centro-Oeste"
    new = {r.co_entidade: r for r in rows.where(F.col("fonte_caminho") == NEW).collect()}
    assert (new["00123456"].tap_fun, new["00123456"].tap_fun_2, new["00123456"].tre_med) == ("92,1", "5", None)
    assert new["00123457"].sg_uf is None


def test_reports(spark, example):
    grid, inventory = example
    ingestion = {r.caminho: r for r in sheets.ingestion_report(grid, inventory).collect()}
    assert len(ingestion) == 3
    new = ingestion[NEW]
    assert (new.aba_utilizada, new.linha_cabecalho, new.quantidade_linhas, new.quantidade_colunas) == ("ESCOLAS", "1", "2", "5")
    assert new.observacao == f"{headers.SHEET_NOTES[0]} {headers.HEADER_FOUND}"
    assert ingestion[f"{RAW}/tx_2020.xlsx"].status == "erro"
    audited = {r.caminho: r for r in sheets.file_audit(grid, inventory).collect()}
    assert audited[OLD].status == "aviso" and audited[OLD].abas_regionais == "Norte;Centro-Oeste"
    assert audited[OLD].observacao.endswith(sheets.NOTE_REGIONAL)
    assert (audited[NEW].quantidade_colunas_identificacao, audited[NEW].quantidade_colunas_taxas) == ("2", "3")
    assert audited[NEW].colunas_identificacao_ausentes == "co_municipio;dependad;no_entidade;no_municipio;no_regiao;sg_uf;tipoloca"
    by_sheet = {(r.caminho, r.aba): r for r in sheets.sheet_audit(grid, inventory).collect()}
    assert (OLD, "Notas") not in by_sheet and by_sheet[OLD, "Norte"].tipo_aba == "regional"
    readme = by_sheet[NEW, "Leia-me"]
    assert readme.status == "aviso" and sheets.NOTE_NO_ROWS in readme.observacao and sheets.NOTE_NO_RATES in readme.observacao


def test_colliding_names_fail_that_file_only(spark, tmp_path):
    bad = [["NU_ANO_CENSO", "CO_ENTIDADE", "tap_x", "tap_x_2", "tap_x"], ["2023", "1", "1", "2", "3"]]
    good = [["NU_ANO_CENSO", "CO_ENTIDADE", "tap_fun"], ["2024", "00123456", "1"]]
    paths = [f"{RAW}/tx_2023.xlsx", NEW]
    grid = grid_of(spark, (paths[0], "ESCOLAS", 0, bad), (NEW, "ESCOLAS", 0, good))
    rows = standardise.standardise(spark, grid, inventory_of(spark, *paths), str(tmp_path / "anuais"), str(tmp_path / "r.csv"))
    assert [r["status"] for r in rows] == ["erro", "ok"]


def test_colliding_sheet_is_an_error_not_left_out(spark):
    grid = grid_of(spark, (NEW, "ESCOLAS", 0, [["cabeçalho"], ["2024"]]))
    layouts = spark.createDataFrame(
        [(NEW, "ESCOLAS", 0, "2024", "tx_2024.xlsx", NEW, [("ano", 0), ("ano", 0)], True)],
        "file string, sheet string, header_row int, ano string, nome_arquivo string, caminho string, "
        "targets array<struct<target string, pos int>>, repeated boolean")
    with pytest.raises(fs.SPARK_ERRORS, match="repetidos"):
        sheets.standardised_rows(grid, layouts, ["tap_fun"]).collect()


def test_flow_from_sheets_to_star(spark, tmp_path):
    raw = tmp_path / RAW
    raw.mkdir(parents=True)
    paths = [str(raw / n) for n in ("tx_2021.xlsx", "tx_2021_b.xlsx", "tx_2022.xlsx", "LEIAME.txt")]
    for path in paths:
        open(path, "w").close()
    def sheet(year, code):
        return [["NU_ANO_CENSO", "SG_UF", "CO_MUNICIPIO", "CO_ENTIDADE", "1_CAT_FUN"], [str(year), "SP", "3500001", code, "90,5"]]
    grid = grid_of(spark, (paths[0], "ESCOLAS", 0, sheet(2021, "35000001")), (paths[1], "ESCOLAS", 0, sheet(2021, "35000009")),
                   (paths[2], "ESCOLAS", 0, sheet(2022, "35000001")))
    made = standardise.early_stages(spark, str(raw), grid, str(tmp_path / "rel"), str(tmp_path / "anuais"))
    assert made["inventario_arquivos"].count() == 3 and set(made) == {
        "inventario_arquivos", "relatorio_ingestao", "relatorio_auditoria", "relatorio_auditoria_abas", "relatorio_limpeza"}
    cleaned = [(r.status, r.quantidade_linhas, r.quantidade_colunas) for r in made["relatorio_limpeza"].orderBy("caminho").collect()]
    assert cleaned == [("ok", "1", "13"), ("erro", "", ""), ("ok", "1", "13")]
    again = standardise.standardise(spark, grid, made["inventario_arquivos"], str(tmp_path / "anuais"), str(tmp_path / "r2.csv"))
    assert [r["observacao"] for r in again if r["status"] == "ok"] == [standardise.REUSED] * 2
    assert again[0]["abas_lidas"] == "ESCOLAS"
    report = consolidate.consolidate(spark, str(tmp_path / "anuais"), str(tmp_path / "saida/h.parquet"), str(tmp_path / "rel/c.csv"))
    assert report[-1]["publicado"] and report[-1]["linhas_analiticas"] == 2


def test_inventory(spark, tmp_path):
    missing = files.discover_files(spark, str(tmp_path / "nada")).collect()
    assert [(r.status, r.observacao) for r in missing] == [("erro", files.FOLDER_MISSING)]
    folder = tmp_path / "Rendimento_Escolas"
    folder.mkdir()
    (folder / "x.pdf").write_text("x")
    assert files.discover_files(spark, str(folder)).first().observacao == files.NOTHING_FOUND
    for name in ("b_2020_2021.XLSX", "a.xls", "c.ods"):
        (folder / name).write_text("x")
    found = files.discover_files(spark, str(folder)).collect()
    assert [(r.nome_arquivo, r.ano, r.extensao, r.status) for r in found] == [
        ("a.xls", "", ".xls", "aviso"), ("b_2020_2021.XLSX", "2020", ".xlsx", "ok")]


def test_grid_formats(spark, tmp_path):
    grid = grid_of(spark, ("f", "A", 0, [["a;\"b\"", None, "c,d"], []]))
    grid.write.parquet(str(tmp_path / "p"))
    grid.withColumn("cells", F.to_json("cells")).write.csv(str(tmp_path / "c"), header=True, escape='"')
    expected = grid.orderBy("row_idx").collect()
    assert grid_source.read_cell_grid(spark, str(tmp_path / "p")).orderBy("row_idx").collect() == expected
    assert grid_source.read_cell_grid(spark, str(tmp_path / "c"), "csv").orderBy("row_idx").collect() == expected


def test_workbooks_need_a_reader(spark):
    try:
        import openpyxl  # noqa: F401
    except ImportError:
        with pytest.raises(RuntimeError, match="openpyxl"):
            grid_source.read_workbooks(inventory_of(spark, NEW))


def test_report_files(spark, tmp_path):
    path = str(tmp_path / "r.csv")
    for note in ("primeira", "com \"aspas\", vírgula\ne linha"):
        reports.write_csv(reports.rows_to_report(spark, [{"ano": 2020, "x": None}, {"ano": 2021, "nota": note}]), path)
    rows = reports.read_csv(spark, path)
    assert rows.columns == ["ano", "x", "nota"]
    assert [tuple(r) for r in rows.orderBy("ano").collect()] == [("2020", "", ""), ("2021", "", note)]
    assert [p.name for p in tmp_path.iterdir()] == ["r.csv"]
    assert reports.read_csv(spark, str(tmp_path / "nada.csv")).count() == 0
