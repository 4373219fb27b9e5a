"""SQL counterparts of operators over whole tables."""

from __future__ import annotations

# CRC-32 of a short ASCII text, bit by bit: SQL knows no crc32.
CRC32 = ("xor(list_reduce(list_transform(string_split({0}, ''), lambda ch: ascii(ch)::BIGINT), lambda c, b: "
         "list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(c, b)), "
         "4294967295), 4294967295)")


def crc32_of(number: str) -> str:
    return CRC32.format(f"CAST({number} AS VARCHAR)")


def _told(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _levels(name: str, first: str, levels: int) -> str:
    """Relations {name}0 to {name}{levels} of (g, p, n, h), and the runs of children {name}_runs{k} of (g, p, hs)."""
    parts = [f"{name}0 AS ({first})"]
    for k in range(levels):
        parts.append(f"{name}_runs{k} AS (SELECT g, p // 8 AS p, any_value(n) AS n, list(h ORDER BY p) AS hs FROM {name}{k} GROUP BY g, p // 8)")
        parts.append(f"{name}{k + 1} AS (SELECT g, p, CASE WHEN n > 1 THEN (n + 7) // 8 ELSE 1 END AS n, "
                     f"CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {name}_runs{k})")
    return ",\n".join(parts)


def merkle_sql(levels: int = 8, group_levels: int = 3) -> str:
    """Up to 8 ** levels documents of a language and 8 ** group_levels languages."""
    ways = [("doc", k, "d.g") for k in range(levels)] + [("top", k, "'all'") for k in range(group_levels)]
    position = {"doc": "d.p", "top": "d.place"}
    joins, proof, fold = "", [], "d.changed"
    for name, k, g in ways:
        run, slot = f"{name}{k}_run", f"(({position[name]} // {8 ** k}) % 8)"
        joins += f"\nJOIN {name}_runs{k} AS {run} ON {run}.g = {g} AND {run}.p = {position[name]} // {8 ** (k + 1)}"
        proof.append(f"CASE WHEN {run}.n > 1 THEN array_to_string(list_concat({run}.hs[1:{slot}], {run}.hs[{slot} + 2:]), '') ELSE '' END")
    steps, previous = "", "found"
    for i, (name, k, _) in enumerate(ways):
        hs, slot = f"hs{i}", f"slot{i}"
        steps += (f",\nfold{i} AS (SELECT * REPLACE (CASE WHEN n{i} > 1 THEN sha256(array_to_string(list_concat({hs}[1:{slot}], [folded], {hs}[{slot} + 2:]), '')) "
                  f"ELSE folded END AS folded) FROM {previous})")
        previous = f"fold{i}"
    carried = ", ".join(f"{name}{k}_run.hs AS hs{i}, {name}{k}_run.n AS n{i}, (({position[name]} // {8 ** k}) % 8) AS slot{i}" for i, (name, k, _) in enumerate(ways))
    leaf = "sha256(" + " || ".join(_told(c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    changed = "sha256(" + " || ".join(_told(c) for c in ("doc_id", "source", "lang", "n_chars", lowered)) + ")"
    return f"""
WITH hashed AS (
  SELECT doc_id, coalesce(':' || lang, '-') AS g, lang, {leaf} AS leaf,
         CASE WHEN {crc32_of('doc_id')} % 3 = 0 THEN {changed} ELSE {leaf} END AS changed FROM documents),
docs AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY g) AS n FROM hashed),
{_levels('doc', 'SELECT g, p, n, leaf AS h FROM docs', levels)},
names AS (SELECT DISTINCT g, lang FROM docs),
places AS (SELECT g, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM names),
{_levels('top', f"SELECT 'all' AS g, place AS p, n, h FROM places JOIN (SELECT g, h FROM doc{levels}) USING (g)", group_levels)},
found AS (
  SELECT d.doc_id, d.leaf, d.changed AS folded, sub.h AS subroot, top.h AS root, sha256({' || '.join(proof)}) AS proof_sha256, {carried}
  FROM (SELECT docs.*, place FROM docs JOIN places USING (g)) AS d
  JOIN doc{levels} AS sub ON sub.g = d.g CROSS JOIN top{group_levels} AS top{joins}){steps}
SELECT doc_id, leaf, subroot, root, proof_sha256, folded AS folded_root, folded = root AS verified FROM {previous}"""


def trie_sql() -> str:
    return f"""
WITH turns AS (
  SELECT conv_id, list([coalesce(role, ''), coalesce(text, '')] ORDER BY turn NULLS FIRST,
           substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (SELECT *, conv_id - conv_id % 20 AS base, {crc32_of('conv_id')} % 4 AS h FROM turns),
rebuilt AS (
  SELECT c.conv_id, list_concat(CASE WHEN c.h > 0 THEN coalesce(b.own[1:c.h], []) ELSE [] END, c.own[c.h + 1:]) AS seq
  FROM hashed AS c LEFT JOIN turns AS b ON b.conv_id = c.base),
prefixes AS (SELECT conv_id, len(seq) AS n, CASE WHEN d > 0 THEN seq[1:d] ELSE [] END AS node, d
             FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)),
named AS (SELECT *, sha256(CAST(node AS VARCHAR) || '/' || array_to_string(list_transform(flatten(node), lambda x: CAST(strlen(x) AS VARCHAR)), ',')) AS id FROM prefixes),
nodes AS (
  SELECT id, any_value(node) AS node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = n), '')) AS ends_sha256
  FROM named GROUP BY id),
ways AS (SELECT DISTINCT a.id AS node, b.id AS ancestor, a.d - b.d AS up FROM named AS a JOIN named AS b ON a.conv_id = b.conv_id AND b.d <= a.d),
children AS (SELECT ancestor AS id, count(*) AS n_children FROM ways WHERE up = 1 GROUP BY ancestor),
weights AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children,
         (n_convs - 1) * CASE WHEN depth > 0 THEN len(regexp_extract_all(node[depth][2], '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS saved
  FROM nodes LEFT JOIN children USING (id)),
sums AS (SELECT ancestor AS id, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
         FROM ways JOIN weights ON weights.id = ways.node GROUP BY ancestor),
parents AS (SELECT ways.node AS id, nodes.conv_id AS parent_conv_id FROM ways JOIN nodes ON nodes.id = ways.ancestor WHERE up = 1)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM weights JOIN sums USING (id) LEFT JOIN parents USING (id)"""
