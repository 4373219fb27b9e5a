"""Sheets to yearly standardised tables, with the reports of every step."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.contract import SCHOOL_RATES, Contract
from panelloom.operators import sheets
from panelloom.plans.scratch import Scratch
from panelloom.session import settings
from panelloom.sources import files, fs, reports

LOGGER = logging.getLogger(__name__)

# Names of outputs, report columns and notes.
TABLE_NAME = "taxas_rendimento_{0}.parquet"
REPORT = ["ano", "nome_arquivo", "caminho", "abas_lidas", "quantidade_abas_lidas", "quantidade_linhas",
          "quantidade_colunas", "quantidade_colunas_taxas", "arquivo_saida", "status", "observacao"]
WRITTEN = "Arquivo padronizado."
REUSED = "Arquivo padronizado existente reutilizado."
FAILED = "Falha ao padronizar arquivo: {0}"
SECOND_FILE = "mais de um arquivo bruto para o ano {0}."


def _report_row(file, **values) -> dict:
    base = {"ano": file.ano, "nome_arquivo": file.nome_arquivo, "caminho": file.caminho}
    return {c: {**base, **values}.get(c, "") for c in REPORT}


def describe_table(spark: SparkSession, file, path: str, note: str, sheet_names: list[str] | None = None,
                   contract: Contract = SCHOOL_RATES) -> dict:
    """Report row of a yearly table as it is on disk; sheet names from the table unless given."""
    table = spark.read.parquet(path)
    rows = table.count()
    if sheet_names is None:
        found = table.agg(F.array_sort(F.collect_set("fonte_aba"))).first()[0] if "fonte_aba" in table.columns else []
        sheet_names = found
    return _report_row(file, abas_lidas=";".join(sheet_names), quantidade_abas_lidas=str(len(sheet_names)),
                       quantidade_linhas=str(rows), quantidade_colunas=str(len(table.columns)),
                       quantidade_colunas_taxas=str(len(contract.rates(table.columns))),
                       arquivo_saida=path, status="ok", observacao=note)


def standardise(spark: SparkSession, grid: DataFrame, inventory: DataFrame, output: str, report_path: str,
                overwrite: bool = False, contract: Contract = SCHOOL_RATES) -> list[dict]:
    """Writes one table per year of the inventory and reports every file.

    An existing table is reused unless ``overwrite``.  A file that fails does not stop the
    others.  Headers are resolved once for all sheets; each year is then one scan of its own
    files with no Python on the data rows.
    """
    listed = sheets.first_file_per_year(inventory).orderBy("caminho").collect()
    report: dict[str, dict] = {}
    pending = {}
    for file in listed:
        path = fs.join(output, TABLE_NAME.format(file.ano))
        if file.repeated_year:
            report[file.caminho] = _report_row(file, status="erro", observacao=FAILED.format(SECOND_FILE.format(file.ano)))
        elif fs.exists(spark, path) and not overwrite:
            report[file.caminho] = describe_table(spark, file, path, REUSED, contract=contract)
        else:
            pending[file.caminho] = (file, path)
    if pending:
        with settings(spark), Scratch(spark, output) as scratch:
            report.update(_write_years(spark, scratch, grid, inventory, pending, contract))
    rows = [report[file.caminho] for file in listed]
    table = (reports.rows_to_report(spark, rows) if rows
             else spark.createDataFrame([], ", ".join(f"{c} string" for c in REPORT)))
    reports.write_csv(table, report_path)
    return rows


def _write_years(spark, scratch, grid, inventory, pending, contract) -> dict[str, dict]:
    wanted = inventory.where(F.col("caminho").isin(*pending))
    layouts = scratch.keep(sheets.sheet_layouts(grid, wanted, contract), "layouts")
    names: dict[str, list[str]] = {}
    for row in sheets.layout_names(layouts, contract).collect():
        names.setdefault(row.ano, []).append(row.target)
    summary = {row.file: row for row in layouts.groupBy("file").agg(
        F.array_sort(F.collect_list(F.struct("sheet_idx", "sheet"))).alias("sheets"),
        F.max("repeated").alias("repeated")).collect()}
    report = {}
    for caminho, (file, path) in pending.items():
        try:
            if caminho not in summary:
                raise ValueError(sheets.NOTE_UNREADABLE)
            if summary[caminho].repeated:
                raise ValueError(sheets.NOTE_REPEATED)
            rates = sorted(names.get(file.ano, []))
            own = layouts.where(F.col("file") == caminho)
            rows = sheets.standardised_rows(grid.where(F.col("file") == caminho), own, rates, contract)
            staged = fs.join(scratch.path, f"ano-{file.ano}")
            rows.drop("_file_year").write.parquet(staged)
            reports.replace_path(spark, staged, path)
            used = [s.sheet for s in summary[caminho].sheets]
            report[caminho] = describe_table(spark, file, path, WRITTEN, used, contract)
        except (ValueError, *fs.SPARK_ERRORS) as error:
            LOGGER.error("%s: %s", caminho, error)
            report[caminho] = _report_row(file, status="erro",
                                          observacao=FAILED.format(fs.short_message(error)))
    return report


def early_stages(spark: SparkSession, raw_folder: str, grid: DataFrame, reports_folder: str, output: str,
                 upto: int = 4, overwrite: bool = False, contract: Contract = SCHOOL_RATES) -> dict[str, DataFrame]:
    """Inventory, ingestion, structural audit and cleaning; returns the reports by name.

    The inventory is written first and read back: what follows relies on the report only.
    """
    made = {}

    def save(report: DataFrame, name: str) -> DataFrame:
        path = fs.join(reports_folder, f"{name}.csv")
        reports.write_csv(report, path)
        made[name] = reports.read_csv(spark, path)
        return made[name]

    inventory = save(files.discover_files(spark, raw_folder), "inventario_arquivos")
    if upto >= 2:
        save(sheets.ingestion_report(grid, inventory).orderBy("caminho"), "relatorio_ingestao")
    if upto >= 3:
        save(sheets.file_audit(grid, inventory, contract).orderBy("caminho"), "relatorio_auditoria")
        save(sheets.sheet_audit(grid, inventory, contract).orderBy("caminho", "aba"), "relatorio_auditoria_abas")
    if upto >= 4:
        path = fs.join(reports_folder, "relatorio_limpeza.csv")
        standardise(spark, grid, inventory, output, path, overwrite, contract)
        made["relatorio_limpeza"] = reports.read_csv(spark, path)
    return made
