"""Every operator as a query over the supplied tables: name to (session, folder) -> DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.contract import SCHOOL_RATES, Dimension
from panelloom.functions.hashing import fingerprint
from panelloom.functions.numbers import decimal_point, out_of_range, parse_number, unless_marker, within_range
from panelloom.functions.text import padded, strip
from panelloom.operators import analytic, audit, catalog, checks, headers, sheets, views
from panelloom.operators.checks import CATALOGUE, COLUMNS, ENTITIES, FACT, PLACES
from panelloom.operators.typing_rules import type_rows
from panelloom.plans.load import publication_views, published_columns, staged_tables
from panelloom.plans.scratch import keep_table
from panelloom.sources import files
from panelloom.workloads.derived import PANEL, RATES, cell_grid, panel_history, panel_rows, table, typed_panel

C = SCHOOL_RATES
GIVEN_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
                "conversations").split()


# --- the yearly panel, typed, audited and turned into a star -------------------------------------

def panel_history_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every row typed, text in rate columns set aside."""
    return panel_history(spark, folder)


def _content_groups(spark: SparkSession, folder: str, per_customer: bool = False) -> DataFrame:
    """The narrow table all counters are taken from, written once as the plan does."""
    return keep_table(audit.history_groups(typed_panel(spark, folder, per_customer)), "conteudos")


def panel_audit(spark: SparkSession, folder: str) -> DataFrame:
    """All counters per year and in total."""
    return audit.audit_report(_content_groups(spark, folder))


def panel_breaches(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows break the input contract, in files with rows of other years, words as rates of
    schools, and place codes stored as numbers."""
    order = F.col("o_orderkey")
    rows = panel_rows(spark, folder).withColumn("tre_fun", F.when(order % 89 == 0, "texto").otherwise(F.col("tre_fun")))
    file_year = F.col("y") + F.when(order % 97 == 0, 1).otherwise(0)
    numeric = rows.where(order % 10 == 0).withColumn("co_municipio", F.col("co_municipio").cast("long"))
    columns = C.history_columns([PANEL])
    typed = [type_rows(part, columns, file_year, order) for part in (rows.where(order % 10 != 0), numeric)]
    return audit.contract_breaches(audit.history_groups(typed[0].unionByName(typed[1]))).select(
        "ano", "anos_divergentes", "codigos_numericos", "taxas_textuais_escola")


def status_report(spark: SparkSession, folder: str) -> DataFrame:
    """The status of each year from its counters."""
    report = audit.audit_by_year(_content_groups(spark, folder, per_customer=True))
    return report.select("ano", "quantidade_linhas_entrada", "duplicidades_ano_escola",
                         audit.year_status(report).alias("status"))


def status_counts(spark: SparkSession, folder: str) -> DataFrame:
    """How many years have which status."""
    report = audit.audit_by_year(_content_groups(spark, folder))
    return audit.status_counts(report.select(audit.year_status(report).alias("status")))


def panel_fact(spark: SparkSession, folder: str) -> DataFrame:
    """H1-H5: the wide fact."""
    return analytic.fact_rows(panel_history(spark, folder, per_customer=True))


def school_versions(spark: SparkSession, folder: str) -> DataFrame:
    """H5, H6 for entities."""
    return analytic.dimension_rows(panel_fact(spark, folder), C.entities)


def place_versions(spark: SparkSession, folder: str) -> DataFrame:
    """H5, H6 for places."""
    return analytic.dimension_rows(panel_fact(spark, folder), C.places)


def fact_years(spark: SparkSession, folder: str) -> DataFrame:
    """H7, K5: rows of each year of the fact."""
    return analytic.rows_per_year(panel_fact(spark, folder), "ano")


def reconcile_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Years whose history and fact counts differ; here by the rows without an entity."""
    history = panel_history(spark, folder, per_customer=True)
    left = history.groupBy("ano").agg(F.count(F.lit(1)).alias("historico"))
    right = analytic.rows_per_year(history.where(F.col(C.entity).isNotNull()), "ano")
    return audit.reconcile(left, right, "ano", "historico", "linhas_analiticas")


def _star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The star as closed tables, as the publication steps read it."""
    fact = keep_table(panel_fact(spark, folder), "fato")
    return {FACT: fact, ENTITIES: keep_table(analytic.dimension_rows(fact, C.entities), "escolas"),
            PLACES: keep_table(analytic.dimension_rows(fact, C.places), "municipios"),
            CATALOGUE: catalog.metric_catalogue(spark)}


def star_checks(spark: SparkSession, folder: str) -> DataFrame:
    """I1-I4 on a star in which every rule is broken."""
    star = _star(spark, folder)
    entities = _changed(star[ENTITIES].where(~F.col("id_escola").startswith("0")), "id_escola", {
        "co_entidade": [("f", "outro"), ("d1", None)], "id_escola": [("d2", None)]})
    entities = entities.unionAll(entities.where(F.col("id_escola").startswith("e1")))
    places = _changed(star[PLACES].where(~F.col("id_municipio").startswith("0")), "id_municipio", {
        "co_municipio": [("f", "outro"), ("d1", None)], "id_municipio": [("d2", None)]})
    places = places.unionAll(places.where(F.col("id_municipio").startswith("e")))
    fact = _changed(star[FACT], "id_escola", {"id_municipio": [("c1", None)], "id_escola": [("c2", None)]})
    return checks.integrity_checks(fact, entities, places)


def _changed(rows: DataFrame, key: str, faults: dict[str, list[tuple[str, object]]]) -> DataFrame:
    """Other values in columns of the rows whose key starts in a certain way."""
    for column, changes in faults.items():
        value = F.col(column)
        for start, new in changes:
            value = F.when(F.col("_chave").startswith(start), F.lit(new).cast(dict(rows.dtypes)[column])).otherwise(value)
        rows = rows.withColumn("_chave", F.col(key) if "_chave" not in rows.columns else F.col("_chave")).withColumn(column, value)
    return rows.drop("_chave")


def load_checks(spark: SparkSession, folder: str) -> DataFrame:
    """J8, J10-J18, J26 on a staged publication in which every rule is broken."""
    star = _star(spark, folder)
    fact = _changed(star[FACT], "id_escola", {
        "tap_fun": [("1", -1.0), ("80", float("nan")), ("90", float("inf")), ("91", 100.5)], "no_entidade": [("2", "Divergente")], "co_entidade": [("a0", None)],
        "id_municipio": [("d0", "curto")], "id_escola": [("b0", None), ("c0", "curta")]})
    fact = fact.unionAll(fact.where(F.col("id_escola").startswith("e0")))
    places = _changed(star[PLACES].where(~F.col("id_municipio").startswith("4")), "id_municipio", {
        "co_municipio": [("6", None)], "id_municipio": [("7", "curto")]})
    places = places.unionAll(places.where(F.col("id_municipio").startswith("5")))
    staged = staged_tables({CATALOGUE: star[CATALOGUE], FACT: fact, PLACES: places, ENTITIES: star[ENTITIES].where(~F.col("id_escola").startswith("3"))})
    entities = _changed(staged[ENTITIES], "id_escola", {
        "co_entidade": [("50", None)], "co_municipio": [("70", None)], "id_municipio": [("71", "outro")], "id_escola": [("60", "curta")]})
    staged[ENTITIES] = keep_table(entities.unionAll(entities.where(F.col("id_escola").startswith("41"))), "escolas-casadas")
    first = F.col("ano_inicio") == 2007
    catalogue = star[CATALOGUE].withColumn("ano_fim", F.when(first & (F.col("codigo_original") == "tap_medio"), 2000).otherwise(F.col("ano_fim")))
    catalogue = catalogue.withColumn("descricao", F.when(~first | ~F.col("codigo_original").startswith("tre_"), F.col("descricao")))
    staged[CATALOGUE] = catalogue.unionAll(catalogue.where(F.col("ano_inicio") == 2011).limit(3))
    previous = {ENTITIES: star[ENTITIES].withColumn("no_entidade", F.upper("no_entidade")),
                PLACES: _changed(star[PLACES], "id_municipio", {"sg_uf": [("8", "ZZ")]})}
    return checks.load_checks(staged, catalog.metric_catalogue(spark), previous)


def counts_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the whole star."""
    return checks.counts_summary(_star(spark, folder))


def canonical_place(spark: SparkSession, folder: str) -> DataFrame:
    """K1, K2: the published view of canonical places."""
    return publication_views(_star(spark, folder))["dim_municipio_canonica"]


def fact_with_place(spark: SparkSession, folder: str) -> DataFrame:
    """K3: the published fact with its place code, shown by a few of its columns."""
    view = publication_views(published_columns(staged_tables(_star(spark, folder))))["vw_fato_rendimento_escolar"]
    return view.select("ano", "co_entidade", "id_municipio", "co_municipio", "tap_fun", "tap_fun_01", "tap_fun_af")


def history_join(spark: SparkSession, folder: str) -> DataFrame:
    """K4: fact rows beside the attributes of their own version."""
    star = _star(spark, folder)
    joined = views.history_join(star[FACT].select("ano", "id_escola", "no_entidade"), star[ENTITIES], "id_escola")
    return joined.select("ano", "id_escola", "no_entidade", "no_entidade_dim", "dependad")


def canonical_school(spark: SparkSession, folder: str) -> DataFrame:
    """K7: the latest version of each entity with its label."""
    star = _star(spark, folder)
    return views.canonical_entity(star[ENTITIES], star[FACT], "id_escola", "co_entidade", "ano",
                                  ["no_entidade", "no_municipio", "sg_uf", "co_entidade"])


def distinct_codes(spark: SparkSession, folder: str) -> DataFrame:
    """K8: distinct entity codes per year and network."""
    return views.distinct_codes(panel_fact(spark, folder), "co_entidade", ["ano", "dependad"])


def one_year(spark: SparkSession, folder: str) -> DataFrame:
    """One year of the fact by network."""
    rows = views.one_year(panel_fact(spark, folder), "ano", 2018)
    return rows.groupBy("dependad").agg(F.count(F.lit(1)).alias("linhas"), F.max("tap_fun_01").alias("maior"))


def _long_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Present rate cells with the catalogue row of their alias in their year."""
    wide = panel_history(spark, folder, per_customer=True).select("ano", *RATES)
    cells = wide.unpivot(["ano"], RATES, "alias", "valor").where(F.col("valor").isNotNull())
    return catalog.match_catalogue(cells, catalog.metric_catalogue(spark), "ano", "alias")


def alias_by_period(spark: SparkSession, folder: str) -> DataFrame:
    """Which metric each alias fed in each year, and with what values."""
    return _long_panel(spark, folder).groupBy("ano", "codigo_original", "coluna_analitica").agg(
        F.count(F.lit(1)).alias("celulas"), F.min("valor").alias("menor"), F.max("valor").alias("maior"))


def metric_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """The full description of every catalogue row the panel uses, with its number of cells."""
    return _long_panel(spark, folder).groupBy(*catalog.CATALOGUE_COLUMNS).agg(F.count(F.lit(1)).alias("celulas"))


def selectors(spark: SparkSession, folder: str) -> DataFrame:
    """K6: stages and details that have any value."""
    return views.selection_lists(_long_panel(spark, folder))


def column_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Per year, which rate columns have values and which of the others' are missing."""
    wide = panel_history(spark, folder).groupBy("ano").agg(
        *[F.max(F.col(c).isNotNull()).alias(c) for c in RATES])
    present = F.array_compact(F.array(*[F.when(F.col(c), F.lit(c)) for c in RATES]))
    by_year = wide.select("ano", present.alias("presentes"))
    known = F.array(*[F.lit(c) for c in RATES if c != "tab_extra"])
    return catalog.with_column_differences(by_year, known, F.col("presentes")).drop("presentes")


# --- sheets ----------------------------------------------------------------------------------------

def _grid(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The stored cell grid and the inventory of its files."""
    grid = keep_table(cell_grid(spark, folder), "grade")
    return grid, files.inventory_of(grid.select(F.col("file").alias("caminho")).distinct())


def sheet_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """A1-A3: inventory rows of the derived files."""
    return _grid(spark, folder)[1]


def header_detect(spark: SparkSession, folder: str) -> DataFrame:
    """The header row of every sheet."""
    grid, _ = _grid(spark, folder)
    return headers.detect_headers(grid).select("file", "sheet", "header_row", "header_note")


def column_map(spark: SparkSession, folder: str) -> DataFrame:
    """The output name of every header cell."""
    grid, _ = _grid(spark, folder)
    return headers.map_columns(headers.header_columns(headers.detect_headers(grid))).select("file", "sheet", "pos", "target")


def sheet_choice(spark: SparkSession, folder: str) -> DataFrame:
    """The sheet each file is read by, and its regional sheets."""
    grid, _ = _grid(spark, folder)
    return headers.choose_sheet(headers.sheets_of(grid))


def ingestion_report(spark: SparkSession, folder: str) -> DataFrame:
    """E4, E11."""
    return sheets.ingestion_report(*_grid(spark, folder))


def file_audit(spark: SparkSession, folder: str) -> DataFrame:
    """D6, E12, E13, E15."""
    return sheets.file_audit(*_grid(spark, folder))


def sheet_audit(spark: SparkSession, folder: str) -> DataFrame:
    """E14."""
    return sheets.sheet_audit(*_grid(spark, folder))


def sheet_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The clean rows of all sheets under one set of columns."""
    grid, inventory = _grid(spark, folder)
    layouts = keep_table(sheets.sheet_layouts(grid, inventory), "layouts")
    rates = sorted({row.target for row in sheets.layout_names(layouts).collect()})
    return sheets.standardised_rows(grid, layouts, rates).drop("_file_year")


# --- operators on the tables as they are --------------------------------------------------------------

def canonical_version(spark: SparkSession, folder: str) -> DataFrame:
    """K1, K2, H5: users by code, event types as versions, days as years."""
    version = Dimension("versao", ("usuario", "event_type"))
    events = table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("usuario"), "event_type", F.dayofmonth("ts").alias("dia"))
    fact = analytic.with_content_id(events, version)
    versions = analytic.dimension_rows(fact, version)
    return views.canonical_version(versions, fact, version.id, "usuario", "dia")


def versioned_dim(spark: SparkSession, folder: str) -> DataFrame:
    """H5, H6: customers with the attributes of their nation and region."""
    dimension = Dimension("cliente", ("codigo", "c_name", "n_name", "r_name", "c_mktsegment"))
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.withColumn("codigo", F.when(F.col("c_custkey") % 17 != 0, F.col("c_custkey").cast("string")))
    return analytic.dimension_rows(analytic.with_content_id(rows, dimension), dimension)


def fact_view(spark: SparkSession, folder: str) -> DataFrame:
    """K3: every document, with its label where there is one."""
    documents = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return views.enrich_fact(documents, table(spark, folder, "labels"), "doc_id", ["quality", "toxic"])


def dup_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated line numbers."""
    return audit.key_excess(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


def exact_dup_conflict(spark: SparkSession, folder: str) -> DataFrame:
    """Exact copies and conflicts per year of shipment."""
    lines = table(spark, folder, "lineitem").select(
        F.year("l_shipdate").alias("ano"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("codigo"),
        "l_returnflag", "l_linestatus", (F.col("l_quantity").cast("int") % 3).alias("q"),
        (F.col("l_partkey") * 1_000_000_000 + F.col("l_suppkey")).alias("ordem"))
    groups = audit.content_groups(lines, ["ano", "codigo"], ["ano", "codigo", "l_returnflag", "l_linestatus", "q"],
                                  F.col("ordem"))
    return audit.duplicate_counts(groups, ["ano"], "codigo")


def rate_parse(spark: SparkSession, folder: str) -> DataFrame:
    """numbers with a decimal comma beside whole texts that are none."""
    quantity = F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(","), F.col("l_linenumber").cast("string"))
    numbers = table(spark, folder, "lineitem").select(
        F.lit("linha").alias("origem"),
        F.when(F.col("l_returnflag") == "R", quantity)
        .when(F.col("l_linenumber") == 7, "--")
        .when(F.col("l_linenumber") == 6, F.concat(quantity, F.lit("e1")))
        .when(F.col("l_linenumber") == 5, F.concat(F.col("l_partkey").cast("string"), F.lit("d")))
        .otherwise(F.col("l_partkey").cast("string")).alias("texto"))
    texts = table(spark, folder, "documents").select(F.lit("documento").alias("origem"), F.col("text").alias("texto"))
    cells = numbers.unionAll(texts).selectExpr("origem", f"{strip('texto')} AS texto")
    cells = cells.selectExpr("origem", f"{unless_marker('texto')} AS texto")
    cells = cells.selectExpr("*", f"{decimal_point('texto')} AS ponto").selectExpr(
        "origem", "texto", f"{parse_number('ponto')} AS valor")
    textual = F.col("texto").isNotNull() & F.col("valor").isNull()
    return (cells.select("origem", F.sha2("texto", 256).alias("texto"), "valor", textual.alias("textual"))
            .groupBy("origem", "texto", "valor", "textual").agg(F.count(F.lit(1)).alias("celulas")))


def invalid_mask(spark: SparkSession, folder: str) -> DataFrame:
    """Values above 100 counted, then set to NULL."""
    rows = table(spark, folder, "lineitem").select("l_returnflag", (F.col("l_quantity") * 2.5).alias("v"))
    masked = F.expr(within_range("v", C.lowest, C.highest))
    return rows.groupBy("l_returnflag").agg(
        F.count_if(F.expr(out_of_range("v", C.lowest, C.highest))).alias("invalidas"),
        F.count_if(masked.isNull()).alias("nulas"), F.max(masked).alias("maior"), F.max("v").alias("maior_origem"))


def harmonise_category(spark: SparkSession, folder: str) -> DataFrame:
    """H2: one category renamed, the others kept."""
    renamed = analytic.harmonise_category("c_mktsegment", {"HOUSEHOLD": "HOME"})
    return (table(spark, folder, "customer").select(renamed.alias("segmento"))
            .groupBy("segmento").agg(F.count(F.lit(1)).alias("clientes")))


def code_format(spark: SparkSession, folder: str) -> DataFrame:
    """Missing and malformed codes, values outside a domain."""
    key = F.col("c_custkey")
    code = F.when(key % 13 != 0, padded(key, F.when(key % 10 == 0, 6).otherwise(8)))
    segment = F.when(key % 19 != 0, F.col("c_mktsegment"))
    rows = table(spark, folder, "customer").select("c_nationkey", code.alias("codigo"), segment.alias("segmento"))
    return rows.groupBy("c_nationkey").agg(
        F.count_if(F.col("codigo").isNull()).alias("ausentes"),
        F.count_if(audit.malformed_code("codigo", 8)).alias("malformados"),
        F.count_if(audit.outside_domain("segmento", ["AUTOMOBILE", "BUILDING", "HOUSEHOLD"])).alias("fora_dominio"))


def year_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and NULLs per year."""
    orders = table(spark, folder, "orders").select(
        F.year("o_orderdate").alias("ano"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("preco"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("prioridade"))
    return checks.year_profile(orders, "ano", ["preco", "prioridade"])


def total_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and distinct customers per year and in total."""
    orders = table(spark, folder, "orders").select(F.year("o_orderdate").alias("ano"), "o_custkey")
    return audit.counts_with_total(orders, "ano", "o_custkey")


def year_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """The years without orders once those of 1997 and 1999 are left out."""
    years = table(spark, folder, "orders").select(F.year("o_orderdate").alias("ano"))
    return catalog.year_gaps(years.where(~F.col("ano").isin(1997, 1999)), "ano")


def fk_checks(spark: SparkSession, folder: str) -> DataFrame:
    """References to parents that are missing."""
    orders = table(spark, folder, "orders")
    kept_orders = orders.where("o_orderpriority <> '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    kept_customers = table(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'")
    return checks.all_checks([
        checks.orphans(table(spark, folder, "lineitem"), kept_orders, ["l_orderkey"], "fk_linha_pedido"),
        checks.orphans(orders, kept_customers.select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"],
                       "fk_pedido_cliente")])


def null_safe_match(spark: SparkSession, folder: str) -> DataFrame:
    """Entity versions with the one place version of equal attributes, NULLs included."""
    star = _star(spark, folder)
    without = {"sg_uf": F.when(F.col("sg_uf") != "SP", F.col("sg_uf"))}
    places = star[PLACES].withColumns(without).where(~F.col("id_municipio").startswith("a"))
    matched = checks.match_places(star[ENTITIES].withColumns(without), places)
    return matched.select("id_escola", "co_municipio", "sg_uf", "id_municipio", "correspondencias")


def attr_agreement(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose copy of their customer's attributes has drifted."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    drifted = F.when(F.col("o_orderkey") % 50 == 0, "OUTRO").when(F.col("o_orderkey") % 70 != 0, F.col("c_mktsegment"))
    orders = (table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", "c_custkey", "c_name", drifted.alias("c_mktsegment")))
    changed = customers.withColumn("c_name", F.when(F.col("c_custkey") % 9 == 0, "novo").otherwise(F.col("c_name")))
    return checks.all_checks([
        checks.attribute_disagreement(orders, customers, "c_custkey", ["c_name", "c_mktsegment"], "atributos_pedido_cliente"),
        checks.content_drift(changed, customers, "c_custkey", ["c_name", "c_mktsegment"], "conteudo_anterior_cliente")])


def publish_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that differ between two copies, or are in one of them only."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    changed = F.when(F.col("o_orderkey") % 11 == 0, F.lit(None)).otherwise(F.col("o_orderstatus"))
    published = orders.withColumn("o_orderstatus", changed).where("o_orderkey % 13 <> 0")
    staged = orders.where("o_orderkey % 17 <> 0")
    return checks.content_diff(published, staged, ["o_orderkey"], orders.columns)


def multiset_equal(spark: SparkSession, folder: str) -> DataFrame:
    """Rows one of two tables has more often."""
    parts = table(spark, folder, "part").select("p_brand", "p_type", "p_size")
    return checks.multiset_difference(parts, parts.where("p_size <> 7").unionAll(parts.where("p_size = 11")))


def union_layouts(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables under the union of their columns."""
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("chave"), F.col("s_name").alias("nome"), F.col("s_acctbal").alias("saldo"))
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("chave"), F.col("c_name").alias("nome"), F.col("c_mktsegment").alias("segmento"))
    return sheets.union_by_name([suppliers, customers])


def forward_fill(spark: SparkSession, folder: str) -> DataFrame:
    """E5: the last known role of each conversation."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role")
    known = F.when(F.col("turn") % 3 == 0, F.col("role"))
    return headers.forward_fill_chunked(turns, known, ["conv_id"], "turn", "papel").select("conv_id", "turn", "papel")


def unique_names(spark: SparkSession, folder: str) -> DataFrame:
    """Customers named by their segment, repeats numbered within each nation."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return headers.unique_names_chunked(customers, ["c_nationkey"], "c_custkey", "c_mktsegment", "nome")


def rearranged(rows: DataFrame) -> DataFrame:
    """The same rows with their columns reversed, dealt anew to as many tasks as their size asks for."""
    return rows.select(*reversed(rows.columns)).hint("rebalance")


def fingerprint_check(spark: SparkSession, folder: str) -> DataFrame:
    """A table and a rearranged copy have one fingerprint; one changed row gives another."""
    lines = table(spark, folder, "lineitem")
    first_key = lines.agg(F.min("l_orderkey")).scalar()
    changed = lines.withColumn(
        "l_tax", F.when(F.col("l_orderkey") == first_key, F.col("l_tax") + 1).otherwise(F.col("l_tax")))
    names = ["linhas", "paridade", "soma", "soma_reforco"]

    def marks(rows: DataFrame, suffix: str) -> DataFrame:
        mark = fingerprint(rows, "lineitem")
        return mark.select("tabela", "linhas", F.struct(*names).alias(suffix))

    both = marks(lines, "a").join(marks(rearranged(lines), "b").drop("linhas"), "tabela")
    both = both.join(marks(changed, "c").drop("linhas"), "tabela")
    return both.select("tabela", "linhas", (F.col("a") == F.col("b")).alias("copia_igual"),
                       (F.col("a") == F.col("c")).alias("alterada_igual"))


def file_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Size, time and content hash of every part file of the tables."""
    listed = [files.table_manifest(spark, f"{folder}/{name}.parquet") for name in GIVEN_TABLES]
    return reduce(DataFrame.unionAll, listed)


def _text_hashes(spark: SparkSession, folder: str) -> DataFrame:
    def hashed(name: str, key: str, text: str) -> DataFrame:
        return table(spark, folder, name).select(
            F.concat(F.lit(f"{name}/"), F.col(key).cast("string")).alias("caminho"), key, F.col(text).alias("texto"))

    return hashed("documents", "doc_id", "text").withColumnRenamed("doc_id", "chave").unionAll(hashed("pages", "page_id", "html"))


def content_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """J1 over contents: length and hash of every document and page."""
    return _text_hashes(spark, folder).select(
        "caminho", F.octet_length("texto").cast("long").alias("tamanho"), F.sha2("texto", 256).alias("sha256"))


def content_changes(spark: SparkSession, folder: str) -> DataFrame:
    """What appeared, vanished or changed between two versions of the documents and pages."""
    rows, key = _text_hashes(spark, folder), F.col("chave")
    changed = F.when(key % 11 == 0, F.concat("texto", F.lit("#"))).otherwise(F.col("texto"))
    return files.manifest_changes(
        rows.where(key % 13 != 0).select("caminho", F.sha2("texto", 256).alias("sha256")),
        rows.where(key % 17 != 0).select("caminho", F.sha2(changed, 256).alias("sha256")))


QUERIES = {
    "panel_history": panel_history_rows, "panel_audit": panel_audit, "panel_breaches": panel_breaches,
    "status_report": status_report, "status_counts": status_counts, "panel_fact": panel_fact,
    "school_versions": school_versions, "place_versions": place_versions, "fact_years": fact_years,
    "reconcile_counts": reconcile_counts, "star_checks": star_checks, "load_checks": load_checks,
    "counts_summary": counts_summary, "canonical_place": canonical_place, "fact_with_place": fact_with_place,
    "history_join": history_join, "canonical_school": canonical_school, "distinct_codes": distinct_codes,
    "one_year": one_year, "alias_by_period": alias_by_period, "metric_catalogue": metric_catalogue,
    "selectors": selectors, "column_differences": column_differences,
    "sheet_inventory": sheet_inventory, "header_detect": header_detect, "column_map": column_map,
    "sheet_choice": sheet_choice, "ingestion_report": ingestion_report, "file_audit": file_audit,
    "sheet_audit": sheet_audit, "sheet_rows": sheet_rows,
    "canonical_version": canonical_version, "versioned_dim": versioned_dim, "fact_view": fact_view,
    "dup_audit": dup_audit, "exact_dup_conflict": exact_dup_conflict, "rate_parse": rate_parse,
    "invalid_mask": invalid_mask, "harmonise_category": harmonise_category, "code_format": code_format,
    "year_profile": year_profile, "total_rollup": total_rollup, "year_gaps": year_gaps, "fk_checks": fk_checks,
    "null_safe_match": null_safe_match, "attr_agreement": attr_agreement, "publish_diff": publish_diff,
    "multiset_equal": multiset_equal, "union_layouts": union_layouts, "forward_fill": forward_fill,
    "unique_names": unique_names, "fingerprint": fingerprint_check, "file_manifest": file_manifest,
    "content_manifest": content_manifest, "content_changes": content_changes,
}
