"""Provenance paths, keyword tags and added columns."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.evolve import evolve
from siltstone.operators.metadata import TAG_KEYWORDS, provenance_edges, with_keyword_tags
from workloads.registry import register, table

_PATH = """CASE
  WHEN p_type = 'PROMO' THEN NULL WHEN p_type = 'LARGE' THEN '' WHEN p_type = 'SMALL' THEN 'derived'
  ELSE concat(p_brand, '.', lower(p_type), '.items.', p_name, ' |  crm.parts.',
              CAST(p_partkey AS {text}), ' | ', 'erp.', p_type, '.', p_brand, '.size.extra') END"""


@register(f"""
WITH d AS (SELECT p_partkey, {_PATH.format(text="VARCHAR")} AS path FROM part),
edges AS (SELECT p_partkey, string_split(trim(unnest(string_split(path, ' | '))), '.') AS x
          FROM d WHERE path <> '' AND path <> 'derived')
SELECT p_partkey AS target_field, x[1] AS source_system, x[2] || '.' || x[3] AS source_table,
  x[4] AS source_column, 'parts' AS domain, 'direct_map' AS transformation
FROM edges WHERE len(x) >= 4
UNION ALL
SELECT p_partkey, 'derived', '', '', 'parts', 'derived' FROM d
WHERE path IS NULL OR path IN ('', 'derived')""")
def paths_explode(spark, directory):
    fields = table(spark, directory, "part").select(
        "p_partkey", F.expr(_PATH.format(text="STRING")).alias("path")
    )
    return provenance_edges(fields, "path", "p_partkey", "parts")


def _tag_sql(text: str, group: str) -> str:
    def hit(words):
        return " OR ".join(f"contains(lower({text}), '{w}')" for w in words)

    cases = [f"CASE WHEN {group} <> '' THEN {group} END"]
    cases += [f"CASE WHEN {hit(words)} THEN '{tag}' END" for tag, words in TAG_KEYWORDS.items()]
    return f"list_sort(list_distinct(list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)))"


@register(f"""
SELECT doc_id, array_to_string({_tag_sql("text", "lang")}, ',') AS tags FROM documents""")
def keyword_tags(spark, directory):
    tagged = with_keyword_tags(table(spark, directory, "documents"), "text", "lang")
    return tagged.select("doc_id", F.array_join("tags", ",").alias("tags"))


_WIDER = T.StructType(
    [
        T.StructField("P_NAME", T.StringType()),
        T.StructField("p_weight", T.DecimalType(12, 6)),
        T.StructField("p_listed_on", T.DateType()),
    ]
)


@register("""
SELECT *, CAST(NULL AS DECIMAL(12,6)) AS p_weight, CAST(NULL AS DATE) AS p_listed_on FROM part""")
def evolve_add_columns(spark, directory):
    """Names are compared without letter case; nothing is dropped."""
    return evolve(table(spark, directory, "part"), _WIDER)
