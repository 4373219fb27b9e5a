"""Finding the header of a sheet and giving its columns their names.

A cell grid has one row per sheet row: ``file, sheet, sheet_idx, row_idx, cells``.  Only the
first rows of each sheet are looked at here, so folding accents in Python stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.contract import SCHOOL_RATES, Contract
from panelloom.functions.text import column_name, fold, fold_cells

# What the header search looks for, and where.
HEADER_SEARCH_ROWS = 30
REGION_SHEETS = r"^(norte|nordeste|sudeste|sul|centro[-_ ]oeste)"
SHEET_NOTES = {0: "Aba ESCOLAS encontrada.",
               1: "Aba ESCOLAS não encontrada; usada aba com termo escola.",
               2: "Aba ESCOLAS não encontrada; usada a primeira aba disponível."}
HEADER_FOUND = "Cabeçalho identificado automaticamente."
HEADER_MISSING = "Cabeçalho não identificado automaticamente; usada a primeira linha."
# Prefixes of coded rate columns, words of descriptive ones, and the pieces
# removed from a descriptive header, anywhere in it and in this order.
CODED_PREFIXES = {"1_cat_": "tap_", "2_cat_": "tre_", "3_cat_": "tab_"}
RATE_WORDS = {"aprovacao": "tap_", "reprovacao": "tre_", "abandono": "tab_"}
SUFFIX_REPAIRS = {"aprovacaona_": "aprovacao_", "reprovacaona_": "reprovacao_"}
SUFFIX_REMOVALS = "taxa_de_ aprovacao_ reprovacao_ abandono_ total_ no_ na_ de_ do_ da_".split()
AUDIT_RATE = r"^(tap_|tre_|tab_|1_|2_|3_)|taxa_de_aprovacao|taxa_de_reprovacao|taxa_de_abandono"

SHEET = ("file", "sheet")


def is_region_sheet(folded_sheet: Column) -> Column:
    return folded_sheet.rlike(REGION_SHEETS)


def sheet_rank(folded_sheet: Column) -> Column:
    return (F.when(folded_sheet == "escolas", 0)
            .when(folded_sheet.contains("escola"), 1).otherwise(2))


def sheets_of(grid: DataFrame) -> DataFrame:
    """One row per sheet: size, whether it is regional, and its rank for ``choose_sheet``."""
    sized = grid.groupBy(*SHEET, "sheet_idx").agg(
        F.coalesce(F.max("row_idx") + 1, F.lit(0)).cast("long").alias("total_rows"),
        F.coalesce(F.max(F.size("cells")), F.lit(0)).cast("long").alias("total_columns"))
    sized = sized.withColumn("folded_sheet", fold(F.col("sheet")))
    return sized.select(*SHEET, "sheet_idx", "total_rows",
                        F.greatest("total_columns", F.lit(0)).alias("total_columns"),
                        is_region_sheet(F.col("folded_sheet")).alias("regional"),
                        sheet_rank(F.col("folded_sheet")).alias("rank"))


def choose_sheet(sheets: DataFrame) -> DataFrame:
    """Per file the sheet named like the schools table, else the first one, with a note."""
    order = F.struct("rank", "sheet_idx")
    chosen = sheets.groupBy("file").agg(
        F.min_by("sheet", order).alias("sheet"), F.min("rank").alias("rank"),
        F.count(F.lit(1)).alias("sheet_count"),
        F.array_sort(F.collect_list(F.when(F.col("regional"), F.struct("sheet_idx", "sheet")))).alias("regions"))
    notes = F.create_map(*[F.lit(x) for pair in SHEET_NOTES.items() for x in pair])
    return chosen.select(
        "file", "sheet", "sheet_count",
        F.array_join(F.col("regions.sheet"), ";").alias("region_sheets"),
        F.element_at(notes, F.col("rank")).alias("sheet_note"))


def sheets_to_clean(sheets: DataFrame) -> DataFrame:
    """All regional sheets of a file, or its chosen sheet when it has none."""
    has_regions = sheets.groupBy("file").agg(F.max("regional").alias("has_regions"))
    chosen = choose_sheet(sheets).select("file", F.col("sheet").alias("chosen"))
    marked = sheets.join(has_regions, "file").join(chosen, "file")
    keep = F.when(F.col("has_regions"), F.col("regional")).otherwise(F.col("sheet") == F.col("chosen"))
    return marked.where(keep).drop("has_regions", "chosen")


def sheets_to_audit(sheets: DataFrame) -> DataFrame:
    """All regional sheets of a file, or every sheet when it has none."""
    has_regions = sheets.groupBy("file").agg(F.max("regional").alias("has_regions"))
    return (sheets.join(has_regions, "file")
            .where(F.col("regional") | ~F.col("has_regions")).drop("has_regions"))


def header_score(folded_cells: Column, contract: Contract = SCHOOL_RATES) -> Column:
    def score(text: Column) -> Column:
        known = text.isin(*contract.identification)
        rate = text.rlike("^(" + "|".join(contract.rate_prefixes) + ")")
        word = text.contains("entidade") | text.contains("municipio")
        return known.cast("int") * 3 + rate.cast("int") * 2 + word.cast("int")
    return F.aggregate(folded_cells, F.lit(0), lambda total, text: total + score(text))


def detect_headers(grid: DataFrame, contract: Contract = SCHOOL_RATES) -> DataFrame:
    """Per sheet the header row, the row below it, and a note.

    The best score in the search rows wins, the first row on a tie; without any score it is
    row 0.  A sheet contributes at most ``HEADER_SEARCH_ROWS + 1`` rows to its group.
    """
    top = grid.where(F.col("row_idx") <= HEADER_SEARCH_ROWS).withColumn("folded", fold_cells(F.col("cells")))
    searched = F.col("row_idx") < HEADER_SEARCH_ROWS
    scored = top.withColumn("score", F.when(searched, header_score(F.col("folded"), contract)))
    by_row = F.map_from_entries(F.collect_list(F.struct("row_idx", F.struct("cells", "folded"))))
    found = scored.groupBy(*SHEET).agg(
        F.max(F.when(searched, F.struct("score", (-F.col("row_idx")).alias("earliest")))).alias("best"),
        by_row.alias("rows"))
    located = found.select(
        *SHEET, "rows",
        F.when(F.col("best.score") > 0, -F.col("best.earliest")).otherwise(F.lit(0)).cast("int").alias("header_row"),
        F.when(F.col("best.score") > 0, HEADER_FOUND).otherwise(HEADER_MISSING).alias("header_note"))
    header = F.try_element_at("rows", F.col("header_row").cast("int"))
    below = F.try_element_at("rows", (F.col("header_row") + 1).cast("int"))
    empty = F.array().cast("array<string>")
    return located.select(
        *SHEET, "header_row", "header_note",
        F.coalesce(header["cells"], empty).alias("header_cells"),
        F.coalesce(header["folded"], empty).alias("header"),
        F.coalesce(below["folded"], empty).alias("subheader"))


def header_columns(headers: DataFrame) -> DataFrame:
    """One row per header cell: position, raw text, name, and the name in the row below."""
    exploded = headers.select(*SHEET, "header_row", "header_cells", "subheader",
                              F.posexplode("header").alias("pos", "folded"))
    return exploded.select(
        *SHEET, "header_row", "pos", F.get("header_cells", "pos").alias("raw"),
        column_name(F.col("folded")).alias("name"),
        column_name(F.coalesce(F.get("subheader", "pos"), F.lit(""))).alias("below"))


def forward_fill(rows: DataFrame, value: Column, scope: Sequence[str], order: str, name: str) -> DataFrame:
    """The last non-NULL value up to each row."""
    window = Window.partitionBy(*scope).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(window))


def unique_names(rows: DataFrame, scope: Sequence[str], order: str, column: str, name: str,
                 separator: str = "_", offset: int = 0) -> DataFrame:
    """The nth repeat of a name within its scope gets its number as a suffix."""
    nth = F.row_number().over(Window.partitionBy(*scope, column).orderBy(order))
    suffix = F.concat(F.lit(separator), (nth + offset).cast("string"))
    return rows.withColumn(name, F.when(nth == 1, F.col(column)).otherwise(F.concat(F.col(column), suffix)))


def _null_safe_join(rows: DataFrame, starts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row meets the one start of its range; NULL scopes, names and positions are ranges of their own."""
    on = rows[keys[0]].eqNullSafe(starts[keys[0]])
    for key in keys[1:]:
        on = on & rows[key].eqNullSafe(starts[key])
    return rows.join(starts, on)


def forward_fill_chunked(rows: DataFrame, value: Column, scope: Sequence[str], order: str, name: str,
                         width: int = 4096) -> DataFrame:
    """``forward_fill`` for scopes of any length: ``order`` is an integer.

    A scope is cut into ranges of ``order``.  Each range is filled on its own and starts from
    the last value of the ranges before it, of which only one row per range is looked at.
    """
    cut = rows.withColumns({"_chunk": F.floor(F.col(order) / width), "_value": value})
    inside = Window.partitionBy(*scope, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*scope).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    present = F.when(F.col("_value").isNotNull(), F.coalesce(F.col(order), F.lit(-(1 << 62))))
    ends = cut.groupBy(*scope, "_chunk").agg(F.max_by("_value", present).alias("_end"))
    starts = ends.select(*scope, "_chunk", F.last("_end", ignorenulls=True).over(before).alias("_start"))
    filled = cut.withColumn("_inside", F.last("_value", ignorenulls=True).over(inside))
    joined = _null_safe_join(filled, starts, [*scope, "_chunk"])
    return joined.select(*[filled[c] for c in rows.columns], F.coalesce("_inside", "_start").alias(name))


def unique_names_chunked(rows: DataFrame, scope: Sequence[str], order: str, column: str, name: str,
                         width: int = 4096) -> DataFrame:
    """``unique_names`` for names that repeat without bound: numbered per range, ranges added up."""
    keys = [*scope, column]
    cut = rows.withColumn("_chunk", F.floor(F.col(order) / width))
    sizes = cut.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, "_chunk", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    numbered = cut.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(order)))
    nth = F.col("_nth") + F.col("_start")
    final = F.when(nth == 1, numbered[column]).otherwise(F.concat(numbered[column], F.lit("_"), nth.cast("string")))
    joined = _null_safe_join(numbered, starts, [*keys, "_chunk"])
    return joined.select(*[numbered[c] for c in rows.columns], final.alias(name))


def rate_suffix(text: Column, position: Column) -> Column:
    """What a descriptive header says beyond its rate family."""
    for wrong, right in SUFFIX_REPAIRS.items():
        text = F.replace(text, F.lit(wrong), F.lit(right))
    for piece in SUFFIX_REMOVALS:
        text = F.replace(text, F.lit(piece), F.lit(""))
    text = F.regexp_replace(text, "[^a-z0-9_]+", "_")
    text = F.btrim(F.regexp_replace(text, "_+", "_"), F.lit("_"))
    numbered = F.concat(F.lit("coluna_"), F.lpad(position.cast("string"), 2, "0"))
    # Padding must not shorten a position of three digits.
    numbered = F.when(position > 99, F.concat(F.lit("coluna_"), position.cast("string"))).otherwise(numbered)
    return F.when(text == "", numbered).otherwise(text)


def rate_column(name: Column, text: Column, position: Column) -> Column:
    """Canonical name of a rate column, NULL for any other column."""
    result = F.when(name.rlike("^(tap_|tre_|tab_)"), name)
    for coded, prefix in CODED_PREFIXES.items():
        result = result.when(name.startswith(coded), F.concat(F.lit(prefix), F.substr(name, F.lit(len(coded) + 1))))
    for word, prefix in RATE_WORDS.items():
        result = result.when(text.contains(word), F.concat(F.lit(prefix), rate_suffix(text, position)))
    return result


def is_audit_rate(name: Column) -> Column:
    """The looser rate test of the structural audit."""
    return name.rlike(AUDIT_RATE)


def alias_name(name: Column, contract: Contract = SCHOOL_RATES) -> Column:
    """Identification column an alias stands for, else NULL."""
    pairs = [F.lit(x) for column, aliases in contract.header_aliases.items()
             for alias in aliases for x in (alias, column)]
    return F.try_element_at(F.create_map(*pairs), name)


def map_columns(columns: DataFrame, contract: Contract = SCHOOL_RATES) -> DataFrame:
    """Adds ``target``: the unique output name of each header cell.

    Cells that are neither identification nor rate keep their own name, as they count when
    repeated names are numbered.  A rate is described by the cell below when that has text,
    else by the nearest header text to the left.
    """
    named = (F.col("name") != "") & ~F.col("name").startswith("unnamed")
    filled = forward_fill(columns, F.when(named, F.col("name")), SHEET, "pos", "filled")
    described = (F.when(F.col("below") != "", F.col("below"))
                 .otherwise(F.coalesce("filled", F.lit(""))))
    # The description is folded again: decomposition can bring back capital letters.
    texts = fold_cells(F.array(F.col("name"), described))
    folded = filled.withColumn("again", texts)
    name, text = column_name(F.col("again")[0]), column_name(F.col("again")[1])
    target = F.coalesce(alias_name(F.col("name"), contract), rate_column(name, text, F.col("pos")), F.col("name"))
    mapped = folded.withColumn("mapped", target)
    return unique_names(mapped, SHEET, "pos", "mapped", "target").select(
        *SHEET, "header_row", "pos", "raw", "name", "target")
