"""The same results in plain SQL over the supplied tables, written independently of the engine."""

from __future__ import annotations

FAMILIES = ("tap", "tre", "tab")
SLICES = ("fun", "fun_ai", "fun_af", *(f"fun_{i:02d}" for i in range(1, 10)),
          "med", *(f"med_{i:02d}" for i in range(1, 5)), "med_ns")
METRICS = [f"{f}_{s}" for f in FAMILIES for s in SLICES]
RATES = ["tap_fun", "tap_f58", "tap_f04", "tap_fun_ai", "tap_fun_af", "tre_fun", "tre_mns", "tre_med_ns",
         "tab_fun", "tab_f00", "tab_fun_02", "tab_extra"]
STATES = "AC AL AP AM BA CE DF ES GO MA MT MS MG PA PB PR PE PI RJ RN RS RO RR SC SP SE TO".split()
STATE_LIST = ", ".join(f"'{s}'" for s in STATES)
SCHOOL = ["co_entidade", "no_entidade", "co_municipio", "no_municipio", "sg_uf", "no_regiao", "tipoloca", "dependad"]
PLACE = ["co_municipio", "no_municipio", "sg_uf", "no_regiao"]
HISTORY_TEXT = ["no_regiao", "sg_uf", "co_municipio", "no_municipio", "co_entidade", "no_entidade", "tipoloca",
                "dependad", "observador"]


def _tenths(amount: str, mark: str) -> str:
    return f"(CAST({amount} // 10 AS VARCHAR) || '{mark}' || CAST({amount} % 10 AS VARCHAR))"


def _number(text: str) -> str:
    return f"TRY_CAST(replace(nullif(nullif(trim({text}), '--'), '-'), ',', '.') AS DOUBLE)"


def panel(per_customer: bool = False) -> str:
    """Common table expressions up to ``raw`` (all text) and ``hist`` (typed)."""
    numbers = """SELECT o_orderkey, o_custkey, year(o_orderdate) + 20 AS y, n, n_r, n_a, n_n, qty
        FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey"""
    if per_customer:
        sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("n", "n_r", "n_a", "n_n", "qty"))
        numbers = f"SELECT min(o_orderkey) AS o_orderkey, o_custkey, y, {sums} FROM ({numbers}) GROUP BY o_custkey, y"
    aux = "o_orderkey % 53 = 0"
    return f"""WITH lines AS (
        SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS n_r,
               count(*) FILTER (WHERE l_returnflag = 'A') AS n_a, count(*) FILTER (WHERE l_returnflag = 'N') AS n_n,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty
        FROM lineitem GROUP BY l_orderkey),
    numbers AS ({numbers}),
    base AS (
        SELECT *, n_r * 1000 // n AS s_r, n_a * 1000 // n AS s_a, n_n * 1000 // n AS s_n, qty * 25 // n AS mean
        FROM numbers JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey),
    raw AS (
        SELECT y, o_orderkey, c_custkey, r_name,
            CASE WHEN n_nationkey < 24 THEN [{STATE_LIST}][n_nationkey + 1] ELSE 'XX' END AS sg_uf,
            CASE WHEN c_custkey % 29 <> 0 THEN lpad(CAST(n_nationkey * 40 + c_custkey % 40 AS VARCHAR),
                 CASE WHEN c_custkey % 31 = 0 THEN 5 ELSE 7 END, '0') END AS co_municipio,
            'Município ' || n_nationkey || '-' || (c_custkey % 40)
                || CASE WHEN y >= 2018 AND c_custkey % 40 < 10 THEN ' Novo' ELSE '' END AS no_municipio,
            CASE WHEN NOT ({aux}) THEN CASE WHEN c_custkey % 37 = 0 THEN 'ABC' ELSE '' END
                 || CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 8 THEN lpad(CAST(c_custkey AS VARCHAR), 8, '0') ELSE CAST(c_custkey AS VARCHAR) END END AS co_entidade,
            c_name || CASE WHEN y >= 2019 AND c_custkey % 3 = 0 THEN ' B' ELSE '' END AS no_entidade,
            CASE WHEN c_custkey % 2 = 0 THEN 'Urbana' ELSE 'Rural' END AS tipoloca,
            CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Particular' WHEN 'MACHINERY' THEN 'Estadual'
                 ELSE 'Municipal' END AS dependad,
            CASE WHEN {aux} AND o_orderkey % 2 = 0 THEN 'Cabeçalho "auxiliar"' ELSE {_tenths('s_n', ',')} END AS tap_fun,
            CASE WHEN y < 2021 THEN {_tenths('s_r', '.')} END AS tap_f58,
            CASE WHEN y BETWEEN 2018 AND 2020 THEN {_tenths('s_a', ',')} END AS tap_f04,
            CASE WHEN y >= 2021 THEN {_tenths('s_r', ',')} END AS tap_fun_ai,
            CASE WHEN y >= 2021 THEN {_tenths('s_a', ',')} END AS tap_fun_af,
            CASE WHEN {aux} AND o_orderkey % 3 = 0 THEN 'total' ELSE {_tenths('mean', '.')} END AS tre_fun,
            CASE WHEN y < 2021 THEN CASE WHEN o_orderkey % 4 = 0 THEN '--' ELSE {_tenths('s_a', ',')} END END AS tre_mns,
            CASE WHEN y >= 2021 THEN CASE WHEN o_orderkey % 4 = 0 THEN '-' ELSE {_tenths('s_a', ',')} END END AS tre_med_ns,
            CASE WHEN o_orderkey % 101 = 0 THEN '-2' WHEN o_orderkey % 103 = 0 THEN 'inf'
                 ELSE {_tenths('s_r', ',')} END AS tab_fun,
            CASE WHEN y < 2021 THEN {_tenths('mean', ',')} END AS tab_f00,
            CASE WHEN y >= 2021 THEN {_tenths('mean', ',')} END AS tab_fun_02,
            CAST(n AS VARCHAR) AS tab_extra,
            CASE WHEN o_orderkey % 2 <> 0 THEN 'o' || (o_orderkey % 10) END AS observador
        FROM base),
    hist AS (
        SELECT CAST(y AS INTEGER) AS ano, o_orderkey, r_name AS no_regiao, sg_uf, co_municipio, no_municipio,
            co_entidade, no_entidade, tipoloca, dependad, observador,
            {", ".join(f"{_number(c)} AS {c}" for c in RATES)},
            'tx_' || y || '.xlsx' AS fonte_arquivo, 'raw/tx_' || y || '.xlsx' AS fonte_caminho, 'ESCOLAS' AS fonte_aba,
            CASE WHEN co_entidade IS NULL AND (tap_fun LIKE 'Cab%' OR tre_fun = 'total') THEN
                '{{' || concat_ws(',', CASE WHEN tap_fun LIKE 'Cab%' THEN '"tap_fun":"Cabeçalho \\"auxiliar\\""' END,
                                 CASE WHEN tre_fun = 'total' THEN '"tre_fun":"total"' END) || '}}' END AS taxas_textuais_origem,
            CASE WHEN co_entidade IS NULL THEN
                 coalesce(CAST(tap_fun LIKE 'Cab%' AS INTEGER), 0) + coalesce(CAST(tre_fun = 'total' AS INTEGER), 0)
                 ELSE 0 END AS textos
        FROM raw)"""


def _id(attributes: list[str], prefix: str = "") -> str:
    listed = ", ".join(prefix + a for a in attributes)
    return f"CASE WHEN {prefix}{attributes[0]} IS NOT NULL THEN sha256(CAST(to_json([{listed}]) AS VARCHAR)) END"


# Which history column feeds a metric in the years up to 2017, up to 2020, and from 2021 on.
_SOURCES = {
    "tap_fun": ("tap_fun", "tap_fun", "tap_fun"), "tap_fun_ai": (None, None, "tap_fun_ai"),
    "tap_fun_af": ("tap_f58", "tap_f04", "tap_fun_af"), "tap_fun_01": (None, "tap_f58", None),
    "tap_fun_05": ("tap_f04", None, None),
    "tre_fun": ("tre_fun", "tre_fun", "tre_fun"), "tre_med_ns": ("tre_mns", "tre_mns", "tre_med_ns"),
    "tab_fun": ("tab_fun", "tab_fun", "tab_fun"), "tab_fun_01": ("tab_f00", None, None),
    "tab_fun_02": (None, "tab_f00", "tab_fun_02"),
}


def star() -> str:
    """``panel`` per customer and year, then ``fact``, ``schools`` and ``places``."""
    columns = []
    for metric in METRICS:
        sources = [s or "NULL" for s in _SOURCES.get(metric, (None, None, None))]
        value = (f"CAST(CASE WHEN ano <= 2017 THEN {sources[0]} WHEN ano <= 2020 THEN {sources[1]} "
                 f"ELSE {sources[2]} END AS DOUBLE)")
        columns.append(f"CASE WHEN {value} BETWEEN 0 AND 100 THEN {value} END AS {metric}")
    return f"""{panel(True)},
    renamed AS (
        SELECT * REPLACE (CASE WHEN dependad = 'Particular' THEN 'Privada' ELSE dependad END AS dependad)
        FROM hist WHERE co_entidade IS NOT NULL),
    fact AS (
        SELECT ano, no_regiao, sg_uf, co_municipio, no_municipio, co_entidade, no_entidade, tipoloca, dependad,
            {_id(SCHOOL)} AS id_escola, {_id(PLACE)} AS id_municipio, {", ".join(columns)}
        FROM renamed),
    schools AS (SELECT DISTINCT id_escola, {", ".join(SCHOOL)} FROM fact),
    places AS (SELECT DISTINCT id_municipio, {", ".join(PLACE)} FROM fact WHERE id_municipio IS NOT NULL)"""


_CONTENT = ", ".join(["ano", *HISTORY_TEXT, *RATES, "taxas_textuais_origem"])
_INVALID = " + ".join(f"CAST(coalesce(NOT ({r} BETWEEN 0 AND 100), false) AS INTEGER)" for r in RATES)


def audit(per_customer: bool = False) -> str:
    """``by_year`` with every counter, after ``panel``."""
    return f"""{panel(per_customer)},
    marked AS (
        SELECT *, CAST(row({_CONTENT}) AS VARCHAR) AS content, {_INVALID} AS invalid FROM hist),
    firsts AS (
        SELECT *, first_value(content) OVER (PARTITION BY ano, co_entidade ORDER BY o_orderkey) AS first_content,
               row_number() OVER (PARTITION BY ano, co_entidade ORDER BY o_orderkey) AS nth,
               row_number() OVER (PARTITION BY ano, content ORDER BY o_orderkey) AS copy
        FROM marked),
    by_year AS (
        SELECT ano, count(*) AS quantidade_linhas_entrada, count(*) AS quantidade_linhas_consolidadas,
            CAST(0 AS BIGINT) AS quantidade_linhas_descartadas,
            count(*) FILTER (WHERE co_entidade IS NULL) AS escolas_ausentes,
            count(*) FILTER (WHERE co_municipio IS NULL) AS municipios_ausentes,
            count(*) FILTER (WHERE NOT regexp_full_match(co_entidade, '[0-9]{{8}}')) AS codigos_escola_invalidos,
            count(*) FILTER (WHERE NOT regexp_full_match(co_municipio, '[0-9]{{7}}')) AS codigos_municipio_invalidos,
            count(*) FILTER (WHERE sg_uf = 'XX') AS ufs_invalidas,
            CAST(sum(invalid) AS BIGINT) AS valores_invalidos, CAST(sum(textos) AS BIGINT) AS valores_textuais,
            count(*) FILTER (WHERE co_entidade IS NOT NULL AND nth > 1) AS duplicidades_ano_escola,
            count(*) FILTER (WHERE copy > 1) AS duplicatas_exatas,
            count(*) FILTER (WHERE co_entidade IS NOT NULL AND content <> first_content) AS conflitos_ano_escola,
            count(DISTINCT co_entidade) AS quantidade_escolas, count(DISTINCT co_municipio) AS municipios_unicos,
            array_to_string(list_sort(list_distinct(list(sg_uf))), ';') AS ufs_encontradas
        FROM firsts GROUP BY ano)"""


_COUNTERS = ["quantidade_linhas_entrada", "quantidade_linhas_consolidadas", "quantidade_linhas_descartadas",
             "escolas_ausentes", "municipios_ausentes", "codigos_escola_invalidos", "codigos_municipio_invalidos",
             "ufs_invalidas", "valores_invalidos", "valores_textuais", "duplicidades_ano_escola",
             "duplicatas_exatas", "conflitos_ano_escola"]
_WARNED = " + ".join(["escolas_ausentes", "municipios_ausentes", "ufs_invalidas", "valores_invalidos",
                      "valores_textuais", "codigos_escola_invalidos", "codigos_municipio_invalidos"])
_STATUS = f"CASE WHEN duplicidades_ano_escola > 0 THEN 'erro' WHEN {_WARNED} > 0 THEN 'aviso' ELSE 'ok' END"

# One row per catalogue entry used by the panel's columns.
_CATALOGUE_USED = """used(ano_inicio, ano_fim, codigo_original, coluna_analitica, tipo_taxa, etapa_ensino, detalhamento) AS (
    VALUES (2015, 2017, 'tap_fun', 'tap_fun', 'aprovacao', 'ensino_fundamental', 'total'),
           (2018, 2020, 'tap_fun', 'tap_fun', 'aprovacao', 'ensino_fundamental', 'total'),
           (2021, 2025, 'tap_fun', 'tap_fun', 'aprovacao', 'ensino_fundamental', 'total'),
           (2015, 2017, 'tap_f58', 'tap_fun_af', 'aprovacao', 'ensino_fundamental', 'anos_finais'),
           (2018, 2020, 'tap_f58', 'tap_fun_01', 'aprovacao', 'ensino_fundamental', '01'),
           (2018, 2020, 'tap_f04', 'tap_fun_af', 'aprovacao', 'ensino_fundamental', 'anos_finais'),
           (2021, 2025, 'tap_fun_ai', 'tap_fun_ai', 'aprovacao', 'ensino_fundamental', 'anos_iniciais'),
           (2021, 2025, 'tap_fun_af', 'tap_fun_af', 'aprovacao', 'ensino_fundamental', 'anos_finais'),
           (2015, 2017, 'tre_fun', 'tre_fun', 'reprovacao', 'ensino_fundamental', 'total'),
           (2018, 2020, 'tre_fun', 'tre_fun', 'reprovacao', 'ensino_fundamental', 'total'),
           (2021, 2025, 'tre_fun', 'tre_fun', 'reprovacao', 'ensino_fundamental', 'total'),
           (2015, 2017, 'tre_mns', 'tre_med_ns', 'reprovacao', 'ensino_medio', 'nao_seriado'),
           (2018, 2020, 'tre_mns', 'tre_med_ns', 'reprovacao', 'ensino_medio', 'nao_seriado'),
           (2021, 2025, 'tre_med_ns', 'tre_med_ns', 'reprovacao', 'ensino_medio', 'nao_seriado'),
           (2015, 2017, 'tab_fun', 'tab_fun', 'abandono', 'ensino_fundamental', 'total'),
           (2018, 2020, 'tab_fun', 'tab_fun', 'abandono', 'ensino_fundamental', 'total'),
           (2021, 2025, 'tab_fun', 'tab_fun', 'abandono', 'ensino_fundamental', 'total'),
           (2015, 2017, 'tab_f00', 'tab_fun_01', 'abandono', 'ensino_fundamental', '01'),
           (2018, 2020, 'tab_f00', 'tab_fun_02', 'abandono', 'ensino_fundamental', '02'),
           (2021, 2025, 'tab_fun_02', 'tab_fun_02', 'abandono', 'ensino_fundamental', '02'))"""
_CELLS = " UNION ALL ".join(f"SELECT ano, '{r}' AS alias, {r} AS valor FROM hist WHERE {r} IS NOT NULL" for r in RATES)
_LONG = f"""{panel(True)}, cells AS ({_CELLS}), {_CATALOGUE_USED},
    matched AS (SELECT * FROM cells JOIN used ON alias = codigo_original AND ano BETWEEN ano_inicio AND ano_fim)"""

# --- sheets ---------------------------------------------------------------------------------------
_OLD_TARGETS = ["ano", "no_regiao", "sg_uf", "co_municipio", "no_municipio", "co_entidade", "no_entidade",
                "tipoloca", "dependad", "tap_ens_fundamental", "tap_1o_aensifundamental", "tre_reprovacao",
                "tab_fun", "observacoes"]
_NEW_TARGETS = _OLD_TARGETS[:9] + ["tap_fun", "tre_fun", "tre_fun_2", "tab_fun", "observacoes"]
SHEETS = f"""{panel(True)},
    placed AS (
        SELECT *, 'dados/raw/rendimento_escolas_' || y || '.xlsx' AS file,
            CASE WHEN y < 2018 THEN ['Norte', 'Nordeste', 'Sudeste', 'Sul', 'Centro-Oeste'][c_custkey % 5 + 1]
                 WHEN c_custkey % 10 = 9 THEN 'Notas' ELSE 'ESCOLAS' END AS sheet,
            CASE WHEN y < 2018 THEN c_custkey % 5 WHEN c_custkey % 10 = 9 THEN 0 ELSE 1 END AS sheet_idx
        FROM raw),
    sized AS (
        SELECT file, sheet, sheet_idx, y, max(c_custkey) + 4 AS total_rows, 14 AS total_columns
        FROM placed GROUP BY file, sheet, sheet_idx, y),
    chosen AS (
        SELECT file, y, CASE WHEN y < 2018 THEN arg_min(sheet, sheet_idx)
                             WHEN bool_or(sheet = 'ESCOLAS') THEN 'ESCOLAS' ELSE 'Notas' END AS sheet,
            count(*) AS sheet_count,
            CASE WHEN y < 2018 THEN string_agg(sheet, ';' ORDER BY sheet_idx) ELSE '' END AS region_sheets,
            CASE WHEN y >= 2018 AND bool_or(sheet = 'ESCOLAS') THEN 'Aba ESCOLAS encontrada.'
                 ELSE 'Aba ESCOLAS não encontrada; usada a primeira aba disponível.' END AS sheet_note
        FROM sized GROUP BY file, y)"""
_FOUND = "Cabeçalho identificado automaticamente."


def _clean(text: str) -> str:
    return f"CASE WHEN lower(trim({text})) NOT IN ('', '-', '--', 'nan', 'none', 'null') THEN trim({text}) END"


_REPEATED_RATE = "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE tre_fun END"
_SHEET_IDS = ["no_regiao", "sg_uf", "co_municipio", "no_municipio", "co_entidade", "no_entidade", "tipoloca", "dependad"]
_ID_VALUES = ", ".join(f"{_clean('r_name' if c == 'no_regiao' else c)} AS {c}" for c in _SHEET_IDS)
_FILE = "'rendimento_escolas_' || y || '.xlsx' AS fonte_arquivo, file AS fonte_caminho, sheet AS fonte_aba"

_TEXTS = """SELECT 'documents/' || doc_id AS caminho, doc_id AS chave, text AS texto FROM documents
    UNION ALL SELECT 'pages/' || page_id, page_id, html FROM pages"""

_SAME = " AND ".join(f"p.{c} IS NOT DISTINCT FROM k.{c}" for c in PLACE) + " AND p.co_municipio IS NOT NULL"


def _integrity(name: str, key: str, code: str, dimension: str, missing: str) -> str:
    """The rules of one dimension and of the references of ``f`` to it."""
    d = dimension
    counts = {
        "chave_duplicada": f"FROM (SELECT 1 FROM {d} GROUP BY {key} HAVING count(*) > 1)", "chave_nula": f"FROM {d} WHERE {key} IS NULL",
        "codigo_ausente": f"FROM {d} WHERE {code} IS NULL",
        "referencia_nula": f"FROM f WHERE (f.{key} IS NULL) <> (f.{code} IS NULL) {missing}",
        "referencia_invalida": f"FROM f WHERE f.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {d} WHERE {d}.{key} = f.{key})",
        "codigo_divergente": f"FROM f WHERE EXISTS (SELECT 1 FROM {d} WHERE {d}.{key} = f.{key}) "
                             f"AND NOT EXISTS (SELECT 1 FROM {d} WHERE {d}.{key} = f.{key} AND {d}.{code} IS NOT DISTINCT FROM f.{code})"}
    return " UNION ALL ".join(f"SELECT '{name}_{rule}' AS validacao, count(*) AS divergencias {rows}" for rule, rows in counts.items())


ORACLES = {
    "panel_history": f"""{panel()}
        SELECT ano, {", ".join(HISTORY_TEXT)}, {", ".join(RATES)}, fonte_arquivo, fonte_caminho, fonte_aba,
               taxas_textuais_origem FROM hist""",
    "panel_audit": f"""{audit()},
        overall AS (SELECT count(DISTINCT co_entidade) AS quantidade_escolas, count(DISTINCT co_municipio) AS municipios_unicos,
                    array_to_string(list_sort(list_distinct(list(sg_uf))), ';') AS ufs_encontradas FROM hist)
        SELECT CAST(ano AS VARCHAR) AS ano, * EXCLUDE (ano) FROM by_year
        UNION ALL BY NAME
        SELECT 'TOTAL' AS ano, sums.*, overall.* FROM overall,
            (SELECT {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _COUNTERS)} FROM by_year) sums""",
    "panel_breaches": f"""{panel()}
        SELECT CAST(y + CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS INTEGER) AS ano, count(*) FILTER (WHERE o_orderkey % 97 = 0) AS anos_divergentes,
               count(*) FILTER (WHERE o_orderkey % 10 = 0 AND co_municipio IS NOT NULL) AS codigos_numericos,
               count(*) FILTER (WHERE o_orderkey % 89 = 0 AND co_entidade IS NOT NULL) AS taxas_textuais_escola FROM raw GROUP BY 1""",
    "status_report": f"""{audit(True)}
        SELECT ano, quantidade_linhas_entrada, duplicidades_ano_escola, {_STATUS} AS status FROM by_year""",
    "status_counts": f"""{audit()}
        SELECT count(*) FILTER (WHERE {_STATUS} = 'ok') AS ok, count(*) FILTER (WHERE {_STATUS} = 'aviso') AS aviso,
               count(*) FILTER (WHERE {_STATUS} = 'erro') AS erro FROM by_year""",
    "panel_fact": f"{star()} SELECT * FROM fact",
    "school_versions": f"{star()} SELECT * FROM schools",
    "place_versions": f"{star()} SELECT * FROM places",
    "fact_years": f"{star()} SELECT ano, count(*) AS linhas_analiticas FROM fact GROUP BY ano",
    "reconcile_counts": f"""{panel(True)}
        SELECT ano, count(*) AS historico, count(co_entidade) AS linhas_analiticas FROM hist GROUP BY ano
        HAVING count(*) <> count(co_entidade)""",
    "star_checks": f"""{star()},
        kept AS (SELECT * REPLACE (CASE WHEN id_escola LIKE 'd2%' THEN NULL ELSE id_escola END AS id_escola,
                 CASE WHEN id_escola LIKE 'f%' THEN 'outro' WHEN id_escola LIKE 'd1%' THEN NULL ELSE co_entidade END AS co_entidade)
                 FROM schools WHERE id_escola NOT LIKE '0%'),
        e AS (SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE id_escola LIKE 'e1%'),
        near AS (SELECT * REPLACE (CASE WHEN id_municipio LIKE 'd2%' THEN NULL ELSE id_municipio END AS id_municipio,
                 CASE WHEN id_municipio LIKE 'f%' THEN 'outro' WHEN id_municipio LIKE 'd1%' THEN NULL ELSE co_municipio END AS co_municipio)
                 FROM places WHERE id_municipio NOT LIKE '0%'),
        p AS (SELECT * FROM near UNION ALL SELECT * FROM near WHERE id_municipio LIKE 'e%'),
        f AS (SELECT * REPLACE (CASE WHEN id_escola LIKE 'c1%' THEN NULL ELSE id_municipio END AS id_municipio, CASE WHEN id_escola LIKE 'c2%' THEN NULL ELSE id_escola END AS id_escola)
              FROM fact)
        {_integrity('escola', 'id_escola', 'co_entidade', 'e', 'OR f.id_escola IS NULL')} UNION ALL {_integrity('municipio', 'id_municipio', 'co_municipio', 'p', '')}""",
    "load_checks": f"""{star()},
        drawn AS (SELECT * REPLACE (
            CASE WHEN id_escola LIKE '1%' THEN -1 WHEN id_escola LIKE '80%' THEN CAST('nan' AS DOUBLE) WHEN id_escola LIKE '90%' THEN CAST('inf' AS DOUBLE)
                 WHEN id_escola LIKE '91%' THEN 100.5 ELSE tap_fun END AS tap_fun,
            CASE WHEN id_escola LIKE '2%' THEN 'Divergente' ELSE no_entidade END AS no_entidade, CASE WHEN id_escola LIKE 'a0%' THEN NULL ELSE co_entidade END AS co_entidade,
            CASE WHEN id_escola LIKE 'd0%' THEN 'curto' ELSE id_municipio END AS id_municipio,
            CASE WHEN id_escola LIKE 'b0%' THEN NULL WHEN id_escola LIKE 'c0%' THEN 'curta' ELSE id_escola END AS id_escola) FROM fact),
        f AS (SELECT * FROM drawn UNION ALL SELECT * FROM drawn WHERE id_escola LIKE 'e0%'),
        near AS (SELECT * REPLACE (CASE WHEN id_municipio LIKE '6%' THEN NULL ELSE co_municipio END AS co_municipio,
            CASE WHEN id_municipio LIKE '7%' THEN 'curto' ELSE id_municipio END AS id_municipio) FROM places WHERE id_municipio NOT LIKE '4%'),
        p AS (SELECT * FROM near UNION ALL SELECT * FROM near WHERE id_municipio LIKE '5%'),
        matched AS (SELECT k.*, (SELECT min(id_municipio) FROM p WHERE {_SAME}) AS id_municipio, (SELECT count(*) FROM p WHERE {_SAME}) AS times
            FROM schools k WHERE id_escola NOT LIKE '3%'),
        altered AS (SELECT * REPLACE (CASE WHEN id_escola LIKE '50%' THEN NULL ELSE co_entidade END AS co_entidade,
            CASE WHEN id_escola LIKE '70%' THEN NULL ELSE co_municipio END AS co_municipio, CASE WHEN id_escola LIKE '71%' THEN 'outro' ELSE id_municipio END AS id_municipio,
            CASE WHEN id_escola LIKE '60%' THEN 'curta' ELSE id_escola END AS id_escola) FROM matched),
        e AS (SELECT * FROM altered UNION ALL SELECT * FROM altered WHERE id_escola LIKE '41%')
        SELECT 'duplicidade_dim_municipio' AS validacao, (SELECT count(*) FROM (SELECT 1 FROM p GROUP BY id_municipio HAVING count(*) > 1)) AS divergencias
        UNION ALL SELECT 'duplicidade_dim_escola', (SELECT count(*) FROM (SELECT 1 FROM e GROUP BY id_escola HAVING count(*) > 1))
        UNION ALL SELECT 'duplicidade_fato_rendimento_escolar', (SELECT count(*) FROM (SELECT 1 FROM f GROUP BY ano, co_entidade HAVING count(*) > 1))
        UNION ALL SELECT 'nulos_dim_municipio', (SELECT count(*) FROM p WHERE id_municipio IS NULL OR co_municipio IS NULL)
        UNION ALL SELECT 'nulos_dim_escola', (SELECT count(*) FROM e WHERE id_escola IS NULL OR co_entidade IS NULL)
        UNION ALL SELECT 'nulos_fato_rendimento_escolar', (SELECT count(*) FROM f WHERE co_entidade IS NULL OR id_escola IS NULL)
        UNION ALL SELECT 'hash_dim_municipio_id_municipio', (SELECT count(*) FROM p WHERE length(id_municipio) <> 64)
        UNION ALL SELECT 'hash_dim_escola_id_escola', (SELECT count(*) FROM e WHERE length(id_escola) <> 64)
        UNION ALL SELECT 'hash_dim_escola_id_municipio', (SELECT count(*) FROM e WHERE length(id_municipio) <> 64)
        UNION ALL SELECT 'hash_fato_rendimento_escolar_id_escola', (SELECT count(*) FROM f WHERE length(id_escola) <> 64)
        UNION ALL SELECT 'hash_fato_rendimento_escolar_id_municipio', (SELECT count(*) FROM f WHERE length(id_municipio) <> 64)
        UNION ALL SELECT 'municipio_identificado_dim_escola', (SELECT count(*) FROM e WHERE id_municipio IS NOT NULL AND co_municipio IS NULL)
        UNION ALL SELECT 'correspondencia_municipal_escola', (SELECT count(*) FROM e WHERE co_municipio IS NOT NULL AND times <> 1)
        UNION ALL SELECT 'taxas_fora_faixa', (SELECT count(*) FROM f WHERE isnan(tap_fun) OR tap_fun < 0 OR tap_fun > 100)
        UNION ALL SELECT 'hash_conteudo_anterior_dim_escola', (SELECT count(*) FROM e JOIN schools b USING (id_escola)
            WHERE upper(b.no_entidade) <> e.no_entidade OR e.co_entidade IS DISTINCT FROM b.co_entidade OR e.co_municipio IS DISTINCT FROM b.co_municipio)
        UNION ALL SELECT 'hash_conteudo_anterior_dim_municipio', (SELECT count(*) FROM p JOIN places b USING (id_municipio)
            WHERE (id_municipio LIKE '8%' AND p.sg_uf <> 'ZZ') OR p.co_municipio IS DISTINCT FROM b.co_municipio)
        UNION ALL SELECT 'fk_municipio_escola', (SELECT count(*) FROM e WHERE id_municipio IS NOT NULL AND id_municipio NOT IN (SELECT id_municipio FROM p))
        UNION ALL SELECT 'fk_escola_fato', (SELECT count(*) FROM f WHERE id_escola IS NOT NULL AND id_escola NOT IN (SELECT id_escola FROM e))
        UNION ALL SELECT 'fk_escola_codigo_fato', (SELECT count(*) FROM f WHERE id_escola IS NOT NULL AND co_entidade IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM e WHERE e.id_escola = f.id_escola AND e.co_entidade = f.co_entidade))
        UNION ALL SELECT 'fk_municipio_fato', (SELECT count(*) FROM f WHERE id_municipio IS NOT NULL AND id_municipio NOT IN (SELECT id_municipio FROM p))
        UNION ALL SELECT 'atributos_fato_escola', (SELECT count(*) FROM f JOIN e USING (id_escola) WHERE {" OR ".join(
            f"f.{c} IS DISTINCT FROM e.{c}" for c in ["id_municipio", *SCHOOL])})
        UNION ALL SELECT 'duplicidade_catalogo_metricas', 3 UNION ALL SELECT 'nulos_catalogo_metricas', 18 UNION ALL SELECT 'periodo_catalogo_metricas', 1
        UNION ALL SELECT 'catalogo_incompativel', 2 * 18 + 2 + 3""",
    "counts_summary": f"""{star()}
        SELECT (SELECT count(*) FROM places) AS quantidade_municipios, (SELECT count(*) FROM schools) AS quantidade_escolas,
            CAST(270 AS BIGINT) AS quantidade_metricas_catalogo, count(*) AS quantidade_linhas, min(ano) AS ano_minimo,
            max(ano) AS ano_maximo, (SELECT count(DISTINCT co_entidade) FROM schools) AS quantidade_codigos_escola,
            (SELECT count(DISTINCT co_municipio) FROM places) AS quantidade_codigos_municipio FROM fact""",
    "canonical_place": f"""{star()},
        seen AS (SELECT id_municipio, ano, count(*) AS n FROM fact WHERE id_municipio IS NOT NULL GROUP BY ALL),
        ranked AS (SELECT p.*, s.ano, row_number() OVER (PARTITION BY co_municipio
            ORDER BY s.ano DESC NULLS LAST, s.n DESC NULLS LAST, p.id_municipio) AS pos
            FROM places p LEFT JOIN seen s USING (id_municipio))
        SELECT {", ".join(PLACE)}, id_municipio AS id_municipio_origem, ano AS ano_referencia FROM ranked WHERE pos = 1""",
    "fact_with_place": f"""{star()}
        SELECT f.ano, f.co_entidade, f.id_municipio, p.co_municipio, f.tap_fun, f.tap_fun_01, f.tap_fun_af
        FROM fact f LEFT JOIN places p USING (id_municipio)""",
    "history_join": f"""{star()}
        SELECT f.ano, f.id_escola, f.no_entidade, s.no_entidade AS no_entidade_dim, s.dependad
        FROM fact f JOIN schools s USING (id_escola)""",
    "canonical_school": f"""{star()},
        seen AS (SELECT id_escola, max(ano) AS ano_referencia FROM fact GROUP BY id_escola),
        ranked AS (SELECT s.*, ano_referencia, row_number() OVER (PARTITION BY co_entidade
            ORDER BY ano_referencia DESC NULLS LAST, id_escola) AS pos FROM schools s LEFT JOIN seen USING (id_escola))
        SELECT * EXCLUDE (pos), concat_ws(' - ', no_entidade, no_municipio, sg_uf, co_entidade) AS rotulo
        FROM ranked WHERE pos = 1""",
    "distinct_codes": f"{star()} SELECT ano, dependad, count(DISTINCT co_entidade) AS codigos FROM fact GROUP BY ano, dependad",
    "one_year": f"""{star()}
        SELECT dependad, count(*) AS linhas, max(tap_fun_01) AS maior FROM fact WHERE ano = 2018 GROUP BY dependad""",
    "alias_by_period": f"""{_LONG}
        SELECT ano, codigo_original, coluna_analitica, count(*) AS celulas, min(valor) AS menor, max(valor) AS maior
        FROM matched GROUP BY ALL""",
    "metric_catalogue": f"""{_LONG}
        SELECT codigo_original, coluna_analitica, CAST(ano_inicio AS BIGINT) AS ano_inicio, CAST(ano_fim AS BIGINT) AS ano_fim,
            tipo_taxa, etapa_ensino, detalhamento,
            'Percentual de ' || tipo_taxa || ': ' || etapa_ensino || ', ' || detalhamento AS descricao,
            'Séries/anos de 8 e 9 anos conforme cabeçalho da fonte; não somar recortes.' AS observacao,
            count(*) AS celulas FROM matched GROUP BY ALL""",
    "selectors": f"{_LONG} SELECT DISTINCT etapa_ensino, detalhamento FROM matched",
    "column_differences": f"""{panel()}, cells AS ({_CELLS}),
        present AS (SELECT ano, list(DISTINCT alias) AS p FROM cells GROUP BY ano),
        known AS (SELECT [{", ".join(f"'{r}'" for r in RATES if r != 'tab_extra')}] AS k)
        SELECT ano, array_to_string(list_sort(list_filter(k, lambda x: NOT list_contains(p, x))), ';') AS colunas_ausentes,
            array_to_string(list_sort(list_filter(p, lambda x: NOT list_contains(k, x))), ';') AS colunas_desconhecidas,
            CAST(len(list_filter(k, lambda x: NOT list_contains(p, x))) AS INTEGER) AS quantidade_colunas_ausentes
        FROM present, known""",
    "sheet_inventory": f"""{SHEETS}
        SELECT DISTINCT CAST(y AS VARCHAR) AS ano, 'rendimento_escolas_' || y || '.xlsx' AS nome_arquivo,
            file AS caminho, '.xlsx' AS extensao, 'ok' AS status, 'Ano identificado.' AS observacao FROM sized""",
    "header_detect": f"{SHEETS} SELECT file, sheet, 1 AS header_row, '{_FOUND}' AS header_note FROM sized",
    "column_map": f"""{SHEETS}
        SELECT file, sheet, pos, CASE WHEN y < 2018 THEN {_OLD_TARGETS}[pos + 1] ELSE {_NEW_TARGETS}[pos + 1] END AS target
        FROM sized, (SELECT CAST(unnest(range(14)) AS INTEGER) AS pos)""",
    "sheet_choice": f"{SHEETS} SELECT file, sheet, sheet_count, region_sheets, sheet_note FROM chosen",
    "ingestion_report": f"""{SHEETS}
        SELECT CAST(c.y AS VARCHAR) AS ano, 'rendimento_escolas_' || c.y || '.xlsx' AS nome_arquivo, file AS caminho,
            sheet AS aba_utilizada, '2' AS linha_cabecalho, CAST(s.total_rows - 2 AS VARCHAR) AS quantidade_linhas,
            '14' AS quantidade_colunas, 'ok' AS status, sheet_note || ' {_FOUND}' AS observacao
        FROM chosen c JOIN sized s USING (file, sheet)""",
    "file_audit": f"""{SHEETS}
        SELECT CAST(y AS VARCHAR) AS ano, 'rendimento_escolas_' || y || '.xlsx' AS nome_arquivo, file AS caminho,
            sheet AS aba_utilizada, '2' AS linha_cabecalho, CAST(sheet_count AS VARCHAR) AS quantidade_abas,
            region_sheets AS abas_regionais, '9' AS quantidade_colunas_identificacao,
            '' AS colunas_identificacao_ausentes, CASE WHEN y < 2018 THEN '3' ELSE '4' END AS quantidade_colunas_taxas,
            CASE WHEN y < 2018 THEN 'aviso' ELSE 'ok' END AS status,
            sheet_note || ' {_FOUND}' || CASE WHEN y < 2018 THEN ' Arquivo parece estar dividido por abas regionais; '
                || 'a aba utilizada não representa necessariamente o arquivo completo.' ELSE '' END AS observacao
        FROM chosen""",
    "sheet_audit": f"""{SHEETS}
        SELECT CAST(y AS VARCHAR) AS ano, 'rendimento_escolas_' || y || '.xlsx' AS nome_arquivo, file AS caminho,
            sheet AS aba, CASE WHEN y < 2018 THEN 'regional' ELSE 'principal' END AS tipo_aba, '2' AS linha_cabecalho,
            CAST(total_rows - 2 AS VARCHAR) AS quantidade_linhas, '14' AS quantidade_colunas,
            '9' AS quantidade_colunas_identificacao, '' AS colunas_identificacao_ausentes,
            CASE WHEN y < 2018 THEN '3' ELSE '4' END AS quantidade_colunas_taxas, 'ok' AS status, '{_FOUND}' AS observacao
        FROM sized""",
    "sheet_rows": f"""{SHEETS},
        kept AS (SELECT * FROM placed WHERE c_custkey % 41 <> 0 AND (y < 2018 OR sheet = 'ESCOLAS')),
        below AS (SELECT DISTINCT file, sheet, y FROM placed WHERE y < 2018)
        SELECT CAST(y AS VARCHAR) AS ano, {_ID_VALUES},
            {_clean('tap_fun')} AS tap_ens_fundamental, {_REPEATED_RATE} AS tap_1o_aensifundamental,
            tre_fun AS tre_reprovacao, {_clean('tab_fun')} AS tab_fun, NULL AS tap_fun, NULL AS tre_fun, NULL AS tre_fun_2, {_FILE}
        FROM kept WHERE y < 2018
        UNION ALL BY NAME
        SELECT CAST(y AS VARCHAR) AS ano, {_ID_VALUES}, {_clean('tap_fun')} AS tap_fun, {_REPEATED_RATE} AS tre_fun,
            tre_fun AS tre_fun_2, {_clean('tab_fun')} AS tab_fun, {_FILE}
        FROM kept WHERE y >= 2018
        UNION ALL BY NAME
        SELECT CAST(y AS VARCHAR) AS ano, 'Aprovação no Ens. Fundamental' AS tap_ens_fundamental,
            'Aprovação - 1º ano do Ensino Fundamental' AS tap_1o_aensifundamental, {_FILE} FROM below""",
    "canonical_version": """WITH e AS (
            SELECT CAST(user_id AS VARCHAR) AS usuario, event_type, CAST(day(ts) AS INTEGER) AS dia,
                sha256(CAST(to_json([CAST(user_id AS VARCHAR), event_type]) AS VARCHAR)) AS id_versao FROM events),
        seen AS (SELECT id_versao, dia, count(*) AS n FROM e GROUP BY ALL),
        ranked AS (SELECT v.*, s.dia, s.n, row_number() OVER (PARTITION BY usuario
            ORDER BY s.dia DESC NULLS LAST, s.n DESC NULLS LAST, id_versao) AS pos
            FROM (SELECT DISTINCT usuario, event_type, id_versao FROM e) v LEFT JOIN seen s USING (id_versao))
        SELECT usuario, event_type, id_versao, dia AS ano_referencia, n AS observacoes_ano FROM ranked WHERE pos = 1""",
    "versioned_dim": """WITH c AS (
            SELECT CASE WHEN c_custkey % 17 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS codigo, c_name, n_name, r_name, c_mktsegment
            FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
        SELECT DISTINCT sha256(CAST(to_json([codigo, c_name, n_name, r_name, c_mktsegment]) AS VARCHAR)) AS id_cliente, c.*
        FROM c WHERE codigo IS NOT NULL""",
    "fact_view": """SELECT d.doc_id, lang, n_chars, quality, toxic FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "dup_audit": """SELECT count(*) FILTER (WHERE n > 1) AS grupos, CAST(sum(n - 1) AS BIGINT) AS excedentes
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "exact_dup_conflict": """WITH l AS (
            SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, l_orderkey || '-' || l_linenumber AS codigo,
                l_returnflag || l_linestatus || (CAST(l_quantity AS INTEGER) % 3) AS content, l_partkey, l_suppkey FROM lineitem),
        w AS (SELECT ano, codigo, content,
                first_value(content) OVER (PARTITION BY ano, codigo ORDER BY l_partkey, l_suppkey) AS first_content,
                row_number() OVER (PARTITION BY ano, codigo ORDER BY l_partkey, l_suppkey) AS nth,
                row_number() OVER (PARTITION BY ano, codigo, content) AS copy FROM l)
        SELECT ano, count(*) FILTER (WHERE copy > 1) AS duplicatas_exatas, count(*) FILTER (WHERE nth > 1) AS duplicidades_ano_escola,
            count(*) FILTER (WHERE content <> first_content) AS conflitos_ano_escola, count(DISTINCT codigo) AS codigos
        FROM w GROUP BY ano""",
    "rate_parse": """WITH q AS (SELECT *, CAST(l_quantity AS INTEGER) || ',' || l_linenumber AS quantity FROM lineitem),
        t AS (SELECT 'linha' AS origem, CASE WHEN l_returnflag = 'R' THEN quantity WHEN l_linenumber = 7 THEN '--'
                WHEN l_linenumber = 6 THEN quantity || 'e1' WHEN l_linenumber = 5 THEN l_partkey || 'd'
                ELSE CAST(l_partkey AS VARCHAR) END AS texto FROM q
            UNION ALL SELECT 'documento', regexp_replace(text, '^[ \\t\\n\\r\\f\\v\\x{1c}-\\x{1f}\\x{85}\\pZ]+|[ \\t\\n\\r\\f\\v\\x{1c}-\\x{1f}\\x{85}\\pZ]+$', '', 'g') FROM documents),
        c AS (SELECT origem, CASE WHEN texto NOT IN ('', '-', '--') THEN texto END AS texto FROM t),
        v AS (SELECT *, TRY_CAST(replace(texto, ',', '.') AS DOUBLE) AS valor FROM c)
        SELECT origem, sha256(texto) AS texto, valor, texto IS NOT NULL AND valor IS NULL AS textual, count(*) AS celulas
        FROM v GROUP BY ALL""",
    "invalid_mask": """SELECT l_returnflag, count(*) FILTER (WHERE l_quantity * 2.5 > 100) AS invalidas,
            count(*) FILTER (WHERE l_quantity * 2.5 > 100) AS nulas,
            max(l_quantity * 2.5) FILTER (WHERE l_quantity * 2.5 <= 100) AS maior, max(l_quantity * 2.5) AS maior_origem
        FROM lineitem GROUP BY l_returnflag""",
    "harmonise_category": """SELECT CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'HOME' ELSE c_mktsegment END AS segmento,
            count(*) AS clientes FROM customer GROUP BY 1""",
    "code_format": """SELECT c_nationkey, count(*) FILTER (WHERE c_custkey % 13 = 0) AS ausentes,
            count(*) FILTER (WHERE c_custkey % 13 <> 0 AND c_custkey % 10 = 0) AS malformados,
            count(*) FILTER (WHERE c_custkey % 19 = 0 OR c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD')) AS fora_dominio
        FROM customer GROUP BY c_nationkey""",
    "year_profile": """SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, count(*) AS linhas,
            count(*) FILTER (WHERE o_orderstatus = 'P' OR o_totalprice IS NULL) AS nulos_preco,
            count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS nulos_prioridade FROM orders GROUP BY 1""",
    "total_rollup": """SELECT CAST(year(o_orderdate) AS VARCHAR) AS ano, count(*) AS linhas, count(DISTINCT o_custkey) AS codigos
            FROM orders GROUP BY 1
        UNION ALL SELECT 'TOTAL', count(*), count(DISTINCT o_custkey) FROM orders""",
    "year_gaps": """WITH y AS (SELECT DISTINCT year(o_orderdate) AS ano FROM orders WHERE year(o_orderdate) NOT IN (1997, 1999)),
        b AS (SELECT min(ano) AS lo, max(ano) AS hi FROM y)
        SELECT CAST(a AS INTEGER) AS ano FROM (SELECT unnest(range(lo, hi + 1)) AS a FROM b) WHERE a NOT IN (SELECT ano FROM y)""",
    "fk_checks": """SELECT 'fk_linha_pedido' AS validacao, count(*) AS divergencias FROM lineitem WHERE l_orderkey NOT IN
            (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT')
        UNION ALL SELECT 'fk_pedido_cliente', count(*) FROM orders WHERE o_custkey NOT IN
            (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""",
    "null_safe_match": f"""{star()},
        p AS (SELECT * REPLACE (nullif(sg_uf, 'SP') AS sg_uf) FROM places WHERE id_municipio NOT LIKE 'a%'),
        s AS (SELECT * REPLACE (nullif(sg_uf, 'SP') AS sg_uf) FROM schools)
        SELECT s.id_escola, any_value(s.co_municipio) AS co_municipio, any_value(s.sg_uf) AS sg_uf,
            min(p.id_municipio) AS id_municipio, count(p.id_municipio) AS correspondencias
        FROM s LEFT JOIN p ON s.co_municipio = p.co_municipio AND s.no_municipio IS NOT DISTINCT FROM p.no_municipio
            AND s.sg_uf IS NOT DISTINCT FROM p.sg_uf AND s.no_regiao IS NOT DISTINCT FROM p.no_regiao
        GROUP BY s.id_escola""",
    "attr_agreement": """SELECT 'atributos_pedido_cliente' AS validacao, count(*) AS divergencias FROM orders
            WHERE o_orderkey % 50 = 0 OR o_orderkey % 70 = 0
        UNION ALL SELECT 'conteudo_anterior_cliente', count(*) FROM customer WHERE c_custkey % 9 = 0""",
    "publish_diff": """SELECT o_orderkey FROM orders WHERE
            (o_orderkey % 13 = 0) <> (o_orderkey % 17 = 0)
            OR (o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 AND o_orderkey % 11 = 0)""",
    "multiset_equal": """WITH a AS (SELECT p_brand, p_type, p_size FROM part),
        b AS (SELECT * FROM a WHERE p_size <> 7 UNION ALL SELECT * FROM a WHERE p_size = 11)
        (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
    "union_layouts": """SELECT s_suppkey AS chave, s_name AS nome, s_acctbal AS saldo, NULL AS segmento FROM supplier
        UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer""",
    "forward_fill": """SELECT conv_id, turn, last_value(CASE WHEN turn % 3 = 0 THEN role END IGNORE NULLS)
            OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS papel FROM conversations""",
    "unique_names": """WITH r AS (SELECT c_custkey, c_nationkey, c_mktsegment,
            row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS n FROM customer)
        SELECT c_custkey, c_nationkey, c_mktsegment, c_mktsegment || CASE WHEN n > 1 THEN '_' || n ELSE '' END AS nome FROM r""",
    "fingerprint": """SELECT 'lineitem' AS tabela, count(*) AS linhas, TRUE AS copia_igual, FALSE AS alterada_igual FROM lineitem""",
    "content_manifest": f"""SELECT caminho, strlen(texto) AS tamanho, sha256(texto) AS sha256 FROM ({_TEXTS})""",
    "content_changes": f"""WITH t AS ({_TEXTS}),
        a AS (SELECT caminho, sha256(texto) AS h FROM t WHERE chave % 13 <> 0),
        d AS (SELECT caminho, sha256(CASE WHEN chave % 11 = 0 THEN texto || '#' ELSE texto END) AS h FROM t WHERE chave % 17 <> 0)
        SELECT coalesce(a.caminho, d.caminho) AS caminho, a.h AS sha256_antes, d.h AS sha256_depois
        FROM a FULL JOIN d ON a.caminho = d.caminho
        WHERE a.caminho IS NULL OR d.caminho IS NULL OR a.h IS DISTINCT FROM d.h""",
}
