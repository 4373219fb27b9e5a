"""The results of the end-to-end plans in plain SQL over the supplied tables, written independently of the engine."""

from __future__ import annotations

from panelloom.workloads.oracles import METRICS, PLACE, SCHOOL, STATE_LIST, _id

# The layouts once more, as the columns that hold the metrics of METRICS in their order.
PERIODS = ((2007, 2010), (2011, 2014), (2015, 2017), (2018, 2020), (2021, 2025))
_OLD = ["fundamental", "1a_a_4a_serie_1o_a_5o_ano", "5a_a_8a_serie_6o_ao_9o_ano", "1o_aensifundamental",
        *(f"{i}a_serie_{i + 1}o_ano" for i in range(1, 9)), "medio", *(f"{i}a_serie_medio" for i in range(1, 5)), "medio_nao_seriado"]
_SECOND = ["ens_fundamental", "anos_iniciais_1o_ao_5o_ano", "anos_finais_6o_ao_9o_ano", *(f"{i}o_ano" for i in range(1, 10)),
           "ens_medio", *(f"{i}a_serie" for i in range(1, 5)), "medio_nao_seriado"]
_CODES = ["med", "m01", "m02", "m03", "m04", "mns"]
_THIRD = ["fun", "f14", "f58", "f00", "f01", "f02", "f03", "f04", "f05", "f06", "f07", "f08", *_CODES]
_FOURTH = ["fun", "f14", "f04", "f58", "f00", "f01", "f02", "f03", "f05", "f06", "f07", "f08", *_CODES]
_LAST = [m.removeprefix("tap_") for m in METRICS[:18]]
ALIASES = {period: [f"{family}_{suffix}" for family in ("tap", "tre", "tab") for suffix in suffixes]
           for period, suffixes in zip(PERIODS, (_OLD, _SECOND, _THIRD, _FOURTH, _LAST))}
BASE = ["ano", "no_regiao", "sg_uf", "co_municipio", "no_municipio", "co_entidade", "no_entidade", "tipoloca", "dependad",
        "fonte_arquivo", "fonte_caminho", "fonte_aba"]


def _value(j: int) -> str:
    """Rate j of a row as a number; lines without a school can say a word instead of the first one."""
    number = f"CASE WHEN (k + {j}) % 17 <> 0 THEN ((k * 7 + {13 * j} + y * 3) % 1003) / 10.0 END"
    return f"CASE WHEN NOT (k % 53 = 0 AND k % 2 = 0) THEN {number} END" if j == 0 else f"({number})"


def _history_columns() -> dict[str, str]:
    columns: dict[str, list[str]] = {}
    for (first, last), names in ALIASES.items():
        for j, alias in enumerate(names):
            gap = " AND y <> 2009" if alias == "tab_medio_nao_seriado" else ""
            columns.setdefault(alias, []).append(f"WHEN y BETWEEN {first} AND {last}{gap} THEN {_value(j)}")
    return {alias: f"CAST(CASE {' '.join(parts)} END AS DOUBLE)" for alias, parts in columns.items()}


_INVALID = " + ".join(f"CASE WHEN ({_value(j)}) > 100 THEN 1 ELSE 0 END" for j in range(54))
# What the first row of lines without a school keeps, under the name that its year has for the first rate.
_FIRST = "CASE " + " ".join(f"WHEN y BETWEEN {a} AND {b} THEN '{names[0]}'" for (a, b), names in ALIASES.items()) + " END"

ROWS = f"""WITH firsts AS (
        SELECT o_custkey, CAST(o_orderkey % 19 + 2007 AS INTEGER) AS y, min(o_orderkey) AS k, count(*) AS n FROM orders GROUP BY ALL),
    base AS (
        SELECT *, CASE WHEN n_nationkey < 24 THEN [{STATE_LIST}][n_nationkey + 1] ELSE 'XX' END AS uf,
            CASE WHEN k % 53 <> 0 THEN CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 8 THEN lpad(CAST(c_custkey AS VARCHAR), 8, '0')
                 ELSE CAST(c_custkey AS VARCHAR) END END AS code
        FROM firsts JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    hist AS (
        SELECT y, k, y AS ano, r_name AS no_regiao, uf AS sg_uf,
            CASE WHEN c_custkey % 29 <> 0 THEN lpad(CAST(n_nationkey * 40 + c_custkey % 40 AS VARCHAR), 7, '0') END AS co_municipio,
            'Município ' || n_nationkey || CASE WHEN y >= 2016 AND c_custkey % 40 < 10 THEN ' Novo' ELSE '' END AS no_municipio,
            code AS co_entidade, c_name || CASE WHEN y >= 2019 AND c_custkey % 3 = 0 THEN ' B' ELSE '' END AS no_entidade,
            CASE WHEN c_custkey % 2 = 0 THEN 'Urbana' ELSE 'Rural' END AS tipoloca,
            CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Particular' ELSE 'Municipal' END AS dependad,
            'tx_' || y || '.xlsx' AS fonte_arquivo, 'raw' AS fonte_caminho, CASE WHEN y <> 2009 THEN 'ESCOLAS' END AS fonte_aba,
            CASE WHEN y = 2012 AND k % 2 = 0 THEN 'o' || (k % 10) END AS observador, CASE WHEN y = 2024 THEN CAST(n AS DOUBLE) END AS tap_nova,
            CASE WHEN code IS NULL AND k % 2 = 0 THEN '{{"' || {_FIRST} || '":"Total"}}' END AS taxas_textuais_origem,
            {_INVALID} AS invalid
        FROM base)"""


def _star(upto: int = 2025) -> str:
    metrics = ", ".join(f"CAST(CASE WHEN ({_cut(j)}) <= 100 THEN {_cut(j)} END AS DOUBLE) AS {m}" for j, m in enumerate(METRICS))
    return f"""{ROWS},
    renamed AS (
        SELECT * REPLACE (CASE WHEN dependad = 'Particular' THEN 'Privada' ELSE dependad END AS dependad)
        FROM hist WHERE co_entidade IS NOT NULL AND y <= {upto}),
    fact AS (
        SELECT ano, {", ".join(c for c in BASE[1:9])}, {_id(SCHOOL)} AS id_escola, {_id(PLACE)} AS id_municipio, {metrics} FROM renamed),
    schools AS (SELECT DISTINCT id_escola, {", ".join(SCHOOL)} FROM fact),
    places AS (SELECT DISTINCT id_municipio, {", ".join(PLACE)} FROM fact WHERE id_municipio IS NOT NULL)"""


def _cut(j: int) -> str:
    """The metric's value; the last one of its family is in no file of 2009."""
    return f"CASE WHEN y <> 2009 THEN {_value(j)} END" if METRICS[j] == "tab_med_ns" else _value(j)


_CATALOGUE = ", ".join(f"({a}, {b}, '{alias}', '{METRICS[j]}')" for (a, b), names in ALIASES.items() for j, alias in enumerate(names))
_COUNTS = """SELECT count(*) AS quantidade_linhas, (SELECT count(*) FROM schools) AS quantidade_escolas,
    (SELECT count(*) FROM places) AS quantidade_municipios, (SELECT count(DISTINCT co_entidade) FROM schools) AS quantidade_codigos_escola,
    (SELECT count(DISTINCT co_municipio) FROM places) AS quantidade_codigos_municipio, CAST(270 AS BIGINT) AS quantidade_metricas_catalogo,
    CAST(min(ano) AS BIGINT) AS ano_minimo, CAST(max(ano) AS BIGINT) AS ano_maximo FROM fact"""


def _staged(name: str, upto: int) -> str:
    """The star up to a year as one relation ``name``, its common tables inside."""
    return f"{name} AS ({_star(upto)} {_COUNTS})"


_REPORT = f"""{ROWS},
    yearly AS (
        SELECT y, count(*) AS lines, count(co_entidade) AS named, count(*) - count(co_entidade) AS unnamed, count(*) - count(co_municipio) AS unplaced,
            count(*) FILTER (WHERE sg_uf = 'XX') AS states, count(taxas_textuais_origem) AS texts, count(DISTINCT co_municipio) AS places,
            CAST(sum(invalid - CASE WHEN y = 2009 AND ({_value(53)}) > 100 THEN 1 ELSE 0 END + CASE WHEN tap_nova > 100 THEN 1 ELSE 0 END) AS BIGINT) AS invalid
        FROM hist GROUP BY y),
    told AS (
        SELECT y, CAST(y AS VARCHAR) AS ano, lines, named, unnamed, unplaced, states, texts, places, named AS schools, invalid,
            CASE y WHEN 2009 THEN 'fonte_aba' ELSE '' END AS lacking, CASE y WHEN 2012 THEN 'observador' WHEN 2024 THEN 'tap_nova' ELSE '' END AS unknown,
            CASE y WHEN 2009 THEN 'tab_medio_nao_seriado' ELSE '' END AS missing, CASE y WHEN 2024 THEN 'tap_nova' ELSE '' END AS rates,
            '' AS published, '' AS years FROM yearly
        UNION ALL
        SELECT 9999, 'TOTAL', CAST(sum(lines) AS BIGINT), CAST(sum(named) AS BIGINT), CAST(sum(unnamed) AS BIGINT), CAST(sum(unplaced) AS BIGINT), CAST(sum(states) AS BIGINT),
            CAST(sum(texts) AS BIGINT), (SELECT count(DISTINCT co_municipio) FROM hist), (SELECT count(DISTINCT co_entidade) FROM hist), CAST(sum(invalid) AS BIGINT),
            '', '', '', '', 'True', string_agg(CAST(y AS VARCHAR), ';' ORDER BY y) FROM yearly),
    warned AS (SELECT *, unnamed + unplaced + states + texts + invalid > 0 OR lacking || unknown || missing <> '' AS warns FROM told)
    SELECT ano, CASE WHEN warns OR (y = 9999 AND (SELECT bool_or(warns) FROM warned)) THEN 'aviso' ELSE 'ok' END AS status,
        CAST(lines AS VARCHAR) AS quantidade_linhas_entrada, CAST(named AS VARCHAR) AS linhas_analiticas, lacking AS colunas_ausentes,
        unknown AS colunas_desconhecidas, missing AS metricas_ausentes, rates AS metricas_desconhecidas, CAST(unnamed AS VARCHAR) AS escolas_ausentes,
        CAST(unplaced AS VARCHAR) AS municipios_ausentes, '0' AS codigos_escola_invalidos, CAST(states AS VARCHAR) AS ufs_invalidas,
        CAST(invalid AS VARCHAR) AS valores_invalidos, CAST(texts AS VARCHAR) AS valores_textuais, '0' AS duplicidades_ano_escola,
        CAST(schools AS VARCHAR) AS quantidade_escolas, CAST(places AS VARCHAR) AS municipios_unicos, published AS publicado, years AS anos_processados
    FROM warned"""

_HISTORY = {**{c: "VARCHAR" for c in BASE}, "ano": "int", **dict.fromkeys(_history_columns(), "double"), "tap_nova": "double",
            "observador": "VARCHAR", "taxas_textuais_origem": "VARCHAR"}
_KINDS = {
    "historico": {c: "string" if t == "VARCHAR" else t for c, t in _HISTORY.items()},
    "dim_escolas.parquet": dict.fromkeys(["id_escola", *SCHOOL], "string"), "dim_municipios.parquet": dict.fromkeys(["id_municipio", *PLACE], "string"),
    "dim_metricas.parquet": {**dict.fromkeys(["codigo_original", "coluna_analitica", "tipo_taxa", "etapa_ensino", "detalhamento", "descricao", "observacao"], "string"),
                             "ano_inicio": "bigint", "ano_fim": "bigint"},
    "taxas": {**dict.fromkeys([*SCHOOL, "id_escola", "id_municipio"], "string"), **dict.fromkeys(METRICS, "double")}}
_COLUMNS = ", ".join(f"('{a}', '{c}', '{t}')" for a, columns in _KINDS.items() for c, t in columns.items())
_YEARS = "SELECT DISTINCT o_orderkey % 19 + 2007 AS y FROM orders"

_EVENTS = f"""WITH {_staged('early', 2010)}, {_staged('whole', 2025)},
    runs AS (SELECT 1 AS execucao, * FROM early UNION ALL SELECT 2, * FROM whole),
    states(carga, execucao, status, carga_ativa) AS (VALUES (1, 1, 'sucesso', TRUE), (2, 1, 'sucesso', FALSE), (2, 2, 'sucesso', TRUE),
        (3, 1, 'sucesso', FALSE), (3, 2, 'sucesso', TRUE), (3, 3, 'falha', FALSE))"""
_MEASURES = ["quantidade_linhas", "quantidade_escolas", "quantidade_municipios", "quantidade_metricas_catalogo", "ano_minimo", "ano_maximo",
             "quantidade_codigos_escola", "quantidade_codigos_municipio"]


def _results(load: int, upto: int) -> str:
    nulls = ", ".join(f"count(*) - count({m}) AS {m}" for m in METRICS)
    measures = " UNION ALL ".join(f"SELECT '{m}', {m} FROM counts" for m in _MEASURES)
    nothing = " UNION ALL ".join(f"SELECT '{m}', {m} FROM nulls" for m in METRICS)
    return f"""SELECT * FROM ({_star(upto)}, counts AS ({_COUNTS}), nulls AS (SELECT {nulls} FROM fact)
        SELECT CAST({load} AS BIGINT) AS carga, 'staging' AS resultado, nome, CAST(valor AS BIGINT) AS valor FROM ({measures}) AS m(nome, valor)
        UNION ALL SELECT {load}, 'por_ano', CAST(ano AS VARCHAR), count(*) FROM fact GROUP BY ano
        UNION ALL SELECT {load}, 'nulos_metricas', nome, valor FROM ({nothing}) AS n(nome, valor))"""


def _as_of(load: int, upto: int) -> str:
    return f"SELECT * FROM ({_star(upto)} SELECT {load} AS carga, ano, count(*) AS linhas, max(tab_fun) AS maior FROM fact GROUP BY ano)"


def _broken(entry: str, lines: str, rule: str, detail: str) -> str:
    return f"SELECT '{entry}' AS entrada, {lines} AS linhas, {rule} AS regra, {detail} AS detalhe"


# Every rate per year, then per catalogue row; details are spelt out from the metric's name.
_PER_YEAR = " UNION ALL ".join(f"SELECT y, '{m}' AS metric, count({_cut(j)}) AS n, min({_cut(j)}) AS low, max({_cut(j)}) AS high FROM hist GROUP BY y"
                               for j, m in enumerate(METRICS))
_COVERAGE = f"""{ROWS}, per_year AS ({_PER_YEAR}), entries(a, b, alias, metric) AS (VALUES {_CATALOGUE}),
    named AS (
        SELECT *, CASE left(metric, 3) WHEN 'tap' THEN 'aprovacao' WHEN 'tre' THEN 'reprovacao' ELSE 'abandono' END AS kind,
            CASE substring(metric, 5, 3) WHEN 'fun' THEN 'ensino_fundamental' ELSE 'ensino_medio' END AS stage,
            CASE substring(metric, 9) WHEN '' THEN 'total' WHEN 'ai' THEN 'anos_iniciais' WHEN 'af' THEN 'anos_finais' WHEN 'ns' THEN 'nao_seriado'
                ELSE substring(metric, 9) END AS detail FROM entries)
    SELECT alias AS codigo_original, named.metric AS coluna_analitica, CAST(a AS BIGINT) AS ano_inicio, CAST(b AS BIGINT) AS ano_fim, kind AS tipo_taxa,
        stage AS etapa_ensino, detail AS detalhamento, 'Percentual de ' || kind || ': ' || stage || ', ' || detail AS descricao,
        'Séries/anos de 8 e 9 anos conforme cabeçalho da fonte; não somar recortes.' AS observacao, count(DISTINCT y) FILTER (WHERE n > 0) AS anos,
        CAST(coalesce(sum(n), 0) AS BIGINT) AS valores, CAST(min(low) AS DOUBLE) AS menor, CAST(max(high) AS DOUBLE) AS maior
    FROM named LEFT JOIN per_year ON per_year.metric = named.metric AND y BETWEEN a AND b GROUP BY ALL"""

_ORDERS, _CUSTOMERS = "(SELECT count(*) FROM orders)", "(SELECT count(*) FROM customer)"
_INPUTS = " UNION ALL ".join([
    _broken("a/taxas_rendimento_2007.parquet", _ORDERS, "NULL", "NULL"),
    _broken("b/taxas_rendimento_2007.parquet", _ORDERS, "'repetido'", "'a/taxas_rendimento_2007.parquet'"),
    _broken("a/pedidos.parquet", _ORDERS, "'nome'", "'pedidos.parquet'"),
    _broken("a/taxas_rendimento_2031.parquet", _CUSTOMERS, "'layout'", "'2031'"),
    _broken("a/taxas_rendimento_2008.parquet", _CUSTOMERS, "'chave'", "'co_entidade'"),
    _broken("a/taxas_rendimento_2009.parquet", _CUSTOMERS, "'taxas'", "''"),
    _broken("a/taxas_rendimento_2015.parquet", "(SELECT count(*) FROM embeddings)", "'composto'", "'imagem, vetor'"),
    _broken("a/taxas_rendimento_2016.parquet", "(SELECT count(*) FROM documents)", "'chave'", "'ano, co_entidade'"),
    _broken("a/taxas_rendimento_2016.parquet", "(SELECT count(*) FROM documents)", "'taxas'", "''"),
    _broken("a/taxas_rendimento_2017.parquet", f"2 * {_CUSTOMERS}", "'ilegivel'", "'tipos diferentes em tap_fun'")])

ORACLES = {
    "consolidated_history": f"{ROWS} SELECT {', '.join(BASE)}, {', '.join(f'{v} AS {c}' for c, v in _history_columns().items())}, tap_nova, observador, "
                            "taxas_textuais_origem FROM hist",
    "consolidated_fact": f"{_star()} SELECT * FROM fact",
    "consolidated_dimensions": f"""{_star()} SELECT 'escola' AS dimensao, id_escola AS chave, no_entidade AS nome FROM schools
        UNION ALL SELECT 'municipio', id_municipio, no_municipio FROM places
        UNION ALL SELECT 'metrica', a || ':' || b || ':' || alias, metric FROM (VALUES {_CATALOGUE}) AS c(a, b, alias, metric)""",
    "consolidation_report": _REPORT,
    "schema_registry": f"""SELECT artefato, coluna, tipo FROM (VALUES {_COLUMNS}) AS c(artefato, coluna, tipo) WHERE artefato <> 'taxas'
        UNION ALL SELECT 'taxas/ano=' || y, coluna, tipo FROM (VALUES {_COLUMNS}) AS c(artefato, coluna, tipo), ({_YEARS}) WHERE artefato = 'taxas'""",
    "metrics_by_catalogue": f"{_star()} SELECT ano, co_entidade, {', '.join(METRICS)} FROM fact",
    "catalogue_coverage": _COVERAGE,
    "pruned_fact": f"""{_star()}, years AS (SELECT year(o_orderdate) + 20 AS ano FROM orders GROUP BY 1 HAVING 5 * count(*) FILTER (WHERE o_orderpriority = '1-URGENT') > count(*))
        SELECT ano, dependad, count(*) AS linhas, max(tap_fun) AS maior, count(tre_med) AS taxas FROM fact WHERE ano IN (SELECT ano FROM years) GROUP BY ano, dependad""",
    "replaced_years": f"""{_star()} SELECT ano, CASE WHEN ano IN (2015, 2018) THEN upper(dependad) ELSE dependad END AS dependad, tipoloca, count(*) AS linhas,
        max(tap_fun_af) AS maior FROM fact WHERE ano NOT IN (2015, 2018) OR tipoloca = 'Urbana' GROUP BY ALL""",
    "load_log_state": f"""{_EVENTS} SELECT carga, CAST(execucao AS BIGINT) AS execucao, status, carga_ativa, quantidade_linhas, quantidade_escolas, quantidade_municipios,
        quantidade_codigos_escola, quantidade_metricas_catalogo, status = 'falha' AS reduzida FROM states LEFT JOIN runs USING (execucao)""",
    "published_as_of": " UNION ALL ".join([_as_of(1, 2010), _as_of(2, 2025), _as_of(3, 2025)]),
    "published_snapshot": f"{_star()} SELECT ano, co_entidade, id_escola, id_municipio, {', '.join(METRICS)}, co_municipio FROM fact",
    "load_results": f"{_results(1, 2010)} UNION ALL {_results(2, 2025)}",
    "input_contract": _INPUTS,
}
