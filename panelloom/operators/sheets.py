"""Sheets to standardised rows, and the structural reports about them.

``inventory`` has one row per file: ``ano, nome_arquivo, caminho, extensao, status,
observacao``; ``caminho`` is the ``file`` of the cell grid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.contract import SCHOOL_RATES, Contract
from panelloom.functions.text import clean_cells, column_name, fold, quote
from panelloom.operators.headers import (
    HEADER_MISSING, SHEET, alias_name, choose_sheet, detect_headers, header_columns, is_audit_rate,
    map_columns, sheets_of, sheets_to_audit, sheets_to_clean, unique_names,
)

# Report notes and the year a data row must carry.
NOTE_MISSING_IDS = "Há colunas de identificação ausentes."
NOTE_NO_RATES = "Nenhuma coluna de taxa foi identificada."
NOTE_REGIONAL = ("Arquivo parece estar dividido por abas regionais; a aba utilizada não representa "
                 "necessariamente o arquivo completo.")
NOTE_NO_ROWS = "Aba sem linhas de dados."
NOTE_UNREADABLE = "planilha ausente da grade de células."
NOTE_REPEATED = "nomes de colunas repetidos após a padronização."
DATA_YEAR = r"\A(?:19|20)\p{Nd}{2}\z"


def readable(inventory: DataFrame) -> DataFrame:
    return inventory.where(F.col("status") == "ok")


def of_inventory(grid: DataFrame, inventory: DataFrame) -> DataFrame:
    """Grid rows of the files the inventory accepts."""
    files = readable(inventory).select(F.col("caminho").alias("file")).distinct()
    return grid.join(files, "file", "left_semi")


def _note(condition: Column, text: str) -> Column:
    return F.when(condition, text)


def _file_columns(inventory: DataFrame) -> DataFrame:
    return readable(inventory).select("ano", "nome_arquivo", "caminho", F.col("caminho").alias("file"), "extensao")


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def data_rows(total_rows: Column, header_row: Column) -> Column:
    return F.greatest(total_rows - header_row - 1, F.lit(0))


def _with_header(sheets: DataFrame, headers: DataFrame) -> DataFrame:
    """Sheets with their header row; a sheet without any row counts as headed by row 0."""
    found = headers.select(*SHEET, "header_row", "header_note")
    joined = sheets.join(found, list(SHEET), "left")
    return joined.withColumns({"header_row": F.coalesce("header_row", F.lit(0)),
                               "header_note": F.coalesce("header_note", F.lit(HEADER_MISSING))})


def ingestion_report(grid: DataFrame, inventory: DataFrame) -> DataFrame:
    """Per file: the sheet used, its header row counted from 1, and its size."""
    grid = of_inventory(grid, inventory)
    sheets = sheets_of(grid)
    used = _with_header(choose_sheet(sheets).join(sheets.drop("rank"), list(SHEET)), detect_headers(grid))
    rows = _file_columns(inventory).join(used, "file", "left")
    missing = F.col("sheet").isNull()
    return rows.select(
        "ano", "nome_arquivo", "caminho",
        _text("sheet").alias("aba_utilizada"),
        F.coalesce((F.col("header_row") + 1).cast("string"), F.lit("")).alias("linha_cabecalho"),
        F.coalesce(data_rows(F.col("total_rows"), F.col("header_row")).cast("string"), F.lit("")).alias("quantidade_linhas"),
        _text("total_columns").alias("quantidade_colunas"),
        F.when(missing, "erro").otherwise("ok").alias("status"),
        F.when(missing, f"Falha ao abrir arquivo: {NOTE_UNREADABLE}")
        .otherwise(F.concat_ws(" ", "sheet_note", "header_note")).alias("observacao"))


def column_summary(grid: DataFrame, inventory: DataFrame, headers: DataFrame,
                   contract: Contract = SCHOOL_RATES) -> DataFrame:
    """Per sheet: identification columns found and missing, and how many rate columns.

    Repeated names of an ``.xlsx`` header are told apart by a number, as its reader does.
    """
    columns = header_columns(headers).join(_file_columns(inventory).select("file", "extensao"), "file")
    columns = unique_names(columns, SHEET, "pos", "raw", "numbered", separator=".", offset=-1)
    told_apart = (F.col("extensao") == ".xlsx") & (F.col("numbered") != F.col("raw"))
    columns = columns.withColumn("final", F.when(told_apart, column_name(fold("numbered"))).otherwise(F.col("name")))
    columns = columns.where(F.col("final") != "")
    summary = columns.groupBy(*SHEET).agg(
        F.collect_set(alias_name(F.col("final"), contract)).alias("found"),
        F.count_distinct(F.when(is_audit_rate(F.col("final")), F.col("final"))).alias("rate_columns"))
    every = F.array(*[F.lit(c) for c in contract.identification])
    return summary.select(*SHEET, F.array_sort("found").alias("found"),
                          F.array_sort(F.array_except(every, "found")).alias("absent"), "rate_columns")


def _with_summary(sheets: DataFrame, summary: DataFrame, contract: Contract) -> DataFrame:
    every = F.array(*[F.lit(c) for c in sorted(contract.identification)])
    joined = sheets.join(summary, list(SHEET), "left")
    return joined.withColumns({"found": F.coalesce("found", F.array().cast("array<string>")),
                               "absent": F.coalesce("absent", every),
                               "rate_columns": F.coalesce("rate_columns", F.lit(0))})


def file_audit(grid: DataFrame, inventory: DataFrame, contract: Contract = SCHOOL_RATES) -> DataFrame:
    """Structural report of the sheet each file would be read by."""
    grid = of_inventory(grid, inventory)
    headers = detect_headers(grid, contract)
    sheets = sheets_of(grid)
    used = _with_header(choose_sheet(sheets).join(sheets.select(*SHEET, "regional"), list(SHEET)), headers)
    used = _with_summary(used, column_summary(grid, inventory, headers, contract), contract)
    rows = _file_columns(inventory).join(used, "file", "left")
    missing = F.col("sheet").isNull()
    ids_missing, no_rates = F.size("absent") > 0, F.col("rate_columns") == 0
    notes = F.concat_ws(" ", "sheet_note", "header_note", _note(ids_missing, NOTE_MISSING_IDS),
                        _note(no_rates, NOTE_NO_RATES), _note(F.col("regional"), NOTE_REGIONAL))
    return rows.select(
        "ano", "nome_arquivo", "caminho",
        _text("sheet").alias("aba_utilizada"),
        F.coalesce((F.col("header_row") + 1).cast("string"), F.lit("")).alias("linha_cabecalho"),
        _text("sheet_count").alias("quantidade_abas"),
        _text("region_sheets").alias("abas_regionais"),
        F.when(missing, "").otherwise(F.size("found").cast("string")).alias("quantidade_colunas_identificacao"),
        F.coalesce(F.array_join("absent", ";"), F.lit("")).alias("colunas_identificacao_ausentes"),
        _text("rate_columns").alias("quantidade_colunas_taxas"),
        F.when(missing, "erro").when(ids_missing | no_rates | F.col("regional"), "aviso").otherwise("ok").alias("status"),
        F.when(missing, f"Falha ao auditar arquivo: {NOTE_UNREADABLE}").otherwise(notes).alias("observacao"))


def sheet_audit(grid: DataFrame, inventory: DataFrame, contract: Contract = SCHOOL_RATES) -> DataFrame:
    """Structural report of every regional sheet, or of every sheet of files without them."""
    grid = of_inventory(grid, inventory)
    headers = detect_headers(grid, contract)
    audited = _with_header(sheets_to_audit(sheets_of(grid)), headers)
    audited = _with_summary(audited, column_summary(grid, inventory, headers, contract), contract)
    rows = _file_columns(inventory).join(audited, "file", "left")
    missing = F.col("sheet").isNull()
    count = data_rows(F.col("total_rows"), F.col("header_row"))
    no_rows, ids_missing, no_rates = count == 0, F.size("absent") > 0, F.col("rate_columns") == 0
    notes = F.concat_ws(" ", "header_note", _note(no_rows, NOTE_NO_ROWS),
                        _note(ids_missing, NOTE_MISSING_IDS), _note(no_rates, NOTE_NO_RATES))
    return rows.select(
        "ano", "nome_arquivo", "caminho", _text("sheet").alias("aba"),
        F.when(missing, "").when(F.col("regional"), "regional").otherwise("principal").alias("tipo_aba"),
        F.coalesce((F.col("header_row") + 1).cast("string"), F.lit("")).alias("linha_cabecalho"),
        F.coalesce(count.cast("string"), F.lit("")).alias("quantidade_linhas"),
        _text("total_columns").alias("quantidade_colunas"),
        F.when(missing, "").otherwise(F.size("found").cast("string")).alias("quantidade_colunas_identificacao"),
        F.coalesce(F.array_join("absent", ";"), F.lit("")).alias("colunas_identificacao_ausentes"),
        _text("rate_columns").alias("quantidade_colunas_taxas"),
        F.when(missing, "erro").when(no_rows | ids_missing | no_rates, "aviso").otherwise("ok").alias("status"),
        F.when(missing, f"Falha ao listar abas do arquivo: {NOTE_UNREADABLE}").otherwise(notes).alias("observacao"))


def sheet_layouts(grid: DataFrame, inventory: DataFrame, contract: Contract = SCHOOL_RATES) -> DataFrame:
    """One row per sheet to clean: where its header is and which cell holds which output column.

    ``repeated`` marks a sheet whose numbered names still collide.
    """
    grid = of_inventory(grid, inventory)
    headers = detect_headers(grid, contract)
    sheets = sheets_to_clean(sheets_of(grid))
    kept = F.col("target").isin(*contract.identification) | F.col("target").rlike("^(tap_|tre_|tab_)")
    mapped = map_columns(header_columns(headers), contract).where(kept)
    targets = mapped.groupBy(*SHEET).agg(
        F.array_sort(F.collect_list(F.struct("pos", "target"))).alias("targets"),
        (F.count(F.lit(1)) > F.count_distinct("target")).alias("repeated"))
    located = _with_header(sheets, headers).join(targets, list(SHEET), "left")
    files = readable(inventory).select(F.col("caminho").alias("file"), "ano", "nome_arquivo", "caminho")
    empty = F.array().cast("array<struct<pos:int,target:string>>")
    return located.join(files, "file").select(
        *SHEET, "sheet_idx", "header_row", "ano", "nome_arquivo", "caminho",
        F.coalesce("targets", empty).alias("targets"), F.coalesce("repeated", F.lit(False)).alias("repeated"))


def layout_names(layouts: DataFrame, contract: Contract = SCHOOL_RATES) -> DataFrame:
    """The rate columns each year has in any of its sheets."""
    names = layouts.select("ano", F.explode("targets.target").alias("target"))
    return names.where(~F.col("target").isin(*contract.identification)).distinct()


def standardised_rows(grid: DataFrame, layouts: DataFrame, rates: Sequence[str],
                      contract: Contract = SCHOOL_RATES) -> DataFrame:
    """Data rows of all sheets under one set of columns, as clean text.

    The cell positions are resolved once per sheet; a data row only picks cells by index.  A sheet whose
    names still collide has no such positions: it is an error, not left out.
    """
    names = [*contract.identification, *rates]
    where = F.map_from_entries(F.transform("targets", lambda t: F.struct(t["target"], t["pos"])))
    collision = F.raise_error(F.concat(F.lit(f"{NOTE_REPEATED} "), F.concat_ws(" / ", *SHEET)))
    usable = layouts.withColumn("where", F.when(F.col("repeated"), collision).otherwise(where))
    usable = usable.select(*SHEET, "header_row", F.col("ano").alias("file_year"), "nome_arquivo", "caminho",
                           F.array(*[F.try_element_at("where", F.lit(n)) for n in names]).alias("positions"))
    rows = grid.join(usable, list(SHEET)).where(F.col("row_idx") > F.col("header_row"))

    def cell(name: str) -> str:
        value = f"get(cells, get(positions, {names.index(name)}))"
        return f"coalesce({value}, file_year)" if name == contract.year else value

    provenance = dict(zip(contract.provenance, ("nome_arquivo", "caminho", "sheet"), strict=True))
    picked = rows.selectExpr(
        "file_year AS _file_year", *[f"{cell(n)} AS {quote(n)}" for n in names],
        *[f"{source} AS {target}" for target, source in provenance.items()])
    cleaned = clean_cells(picked, [*names, *contract.provenance])
    return cleaned.where(F.col(contract.year).rlike(DATA_YEAR))


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of tables with different columns; what a table lacks is NULL."""
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part, allowMissingColumns=True)
    return united


def first_file_per_year(inventory: DataFrame) -> DataFrame:
    """Marks the files after the first of a year, whose output would be overwritten or lost."""
    order = F.row_number().over(Window.partitionBy("ano").orderBy("caminho"))
    return readable(inventory).withColumn("repeated_year", order > 1)
