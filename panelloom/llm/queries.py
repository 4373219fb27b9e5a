"""The corpus operators as queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm import mixing, sharding, url_filter
from panelloom.llm.classifier import op5_quality_classifier
from panelloom.llm.common import table
from panelloom.llm.decontaminate import op8_decontaminate
from panelloom.llm.hmm import op1_language_model
from panelloom.llm.html_extract import op12_html_extraction
from panelloom.llm.merkle import op11_merkle_manifest
from panelloom.llm.near_dedup import op4_near_dedup
from panelloom.llm.oracles import merkle_sql, trie_sql
from panelloom.llm.pii import op10_pii
from panelloom.llm.prefix_trie import op13_prefix_trie
from panelloom.llm.quality_rules import op2_quality_rules
from panelloom.llm.suffix_dedup import op9_suffix_dedup


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    content = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    placed = sharding.shard(docs.select("doc_id", F.crc32(content).alias("text_crc32"), "text"), 40, ["text"],
                            F.octet_length(content) + 16, ["doc_id", "text_crc32"], carried=["doc_id", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def _glob_regex(glob: str) -> str:
    out, i = "", 0
    while i < len(glob):
        if glob.startswith("**", i):
            out, i = out + ".*", i + 2
        elif glob[i] == "*":
            out, i = out + "[^/?#]*", i + 1
        elif glob[i] == "\\":
            out, i = out + "[" + glob[i + 1] + "]", i + 2
        else:
            out, i = out + ("[.]" if glob[i] == "." else "." if glob[i] == "?" else glob[i]), i + 1
    return f"({out})"


def _url_sql() -> str:
    fits = [(f"({host}{path})", verdict, f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')")
            for verdict, host, path in sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))]
    rule = " ".join(f"WHEN {test} THEN '{name[1:-1]}'" for name, _, test in fits)
    verdict = " ".join(f"WHEN {test} THEN '{verdict}'" for _, verdict, test in fits)
    blocked = "|".join(map(_glob_regex, url_filter.BLOCKED))
    return f"""
WITH addresses AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS address FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(address, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(address, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(address, '^[^?#]*([?][^#]*)', 1) AS query
  FROM addresses)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {verdict} WHEN regexp_full_match('.' || host || path || query, '{blocked}', 's') THEN 'block' ELSE 'allow' END AS verdict
FROM parts"""


QUERIES = {"op1_language_model": op1_language_model, "op2_quality_rules": op2_quality_rules, "op3_mixing": op3_mixing,
           "op4_near_dedup": op4_near_dedup,
           "op5_quality_classifier": op5_quality_classifier, "op7_sharding": op7_sharding,
           "op8_decontaminate": op8_decontaminate, "op9_suffix_dedup": op9_suffix_dedup, "op10_pii": op10_pii, "op6_url_filter": op6_url_filter,
           "op11_merkle_manifest": op11_merkle_manifest, "op12_html_extraction": op12_html_extraction, "op13_prefix_trie": op13_prefix_trie}
ORACLES = {"op6_url_filter": _url_sql(), "op11_merkle_manifest": merkle_sql(), "op13_prefix_trie": trie_sql()}
