"""Queries of the general data problems: what changed between versions, and references that do not hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qanat.operators.orphans import corpus_orphans, orphan_report
from qanat.operators.snapshots import version_changes
from qanat.sources.tables import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_changes(table(spark, sf_dir, "articles"), table(spark, sf_dir, "law_documents"))


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_orphans(*(table(spark, sf_dir, t) for t in ("law_documents", "articles", "eval_questions")))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir).drop("made_at")


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_report(_orphans(spark, sf_dir))


QUERIES = {"p1_found": p1_found, "p6_found": p6_found, "p6_report": p6_report}

_P6 = """
WITH d AS (SELECT lower(trim(id)) AS k, bool_and(coalesce(metadata.status = 'deleted', false)) AS deleted FROM law_documents GROUP BY 1),
links AS (SELECT id AS record_id, lower(regexp_replace(superseded_by, '^\\s+|\\s+$', '', 'g')) AS ref_key, min(created_at) AS made_at FROM law_documents GROUP BY 1, 2),
a AS (SELECT lower(trim(x.id)) AS k, bool_and(coalesce(l.metadata.status = 'deleted', false)) AS deleted, min(x.created_at) AS made FROM articles x LEFT JOIN law_documents l ON l.id = x.document_id GROUP BY 1),
cited AS (SELECT id AS record_id, lower(regexp_replace(c, '^\\s+|\\s+$', '', 'g')) AS ref_key, min(created_at) AS made_at
  FROM (SELECT id, unnest(expected_citations) AS c, created_at FROM eval_questions) GROUP BY 1, 2),
o AS (
  SELECT 'law_documents' AS record_table, record_id, ref_key, CASE WHEN d.k IS NULL THEN 'missing' WHEN deleted THEN 'deleted' END AS orphan_kind, made_at
  FROM links LEFT JOIN d ON d.k = ref_key WHERE ref_key <> ''
  UNION ALL
  SELECT 'eval_questions', record_id, ref_key, CASE WHEN a.k IS NULL THEN 'missing' WHEN deleted THEN 'deleted' WHEN made > made_at THEN 'late' END, made_at
  FROM cited LEFT JOIN a ON a.k = ref_key WHERE ref_key <> '')
"""

ORACLES = {
    "p6_found": _P6 + "SELECT record_table, record_id, ref_key, orphan_kind FROM o WHERE orphan_kind IS NOT NULL",
    "p6_report": _P6 + "SELECT record_table, CAST(date_trunc('month', made_at) AS DATE) AS period, orphan_kind, count(*) AS orphans FROM o WHERE orphan_kind IS NOT NULL GROUP BY 1, 2, 3",
}
