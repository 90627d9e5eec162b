"""Queries of problem 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docmill.operators.incremental import replay
from docmill.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, doc_id): what each successful run gets."""
    return replay(table(spark, sf_dir, "documents"), table(spark, sf_dir, "meta"), table(spark, sf_dir, "load_runs"))


P2_SQL = r"""
WITH runs AS (
  SELECT run_id, min(started_at) AS started_at, row_number() OVER (ORDER BY min(started_at), run_id) AS run
  FROM load_runs GROUP BY run_id HAVING bool_or(status = 'completed') AND min(started_at) IS NOT NULL
), times AS (
  SELECT doc_id, processing.source_hash AS hash, trim(processing.ingested_at) AS t FROM meta WHERE doc_id IS NOT NULL
), parsed AS (
  SELECT doc_id, hash, CASE
    WHEN regexp_full_match(t, '-?\d{1,11}') THEN to_timestamp(CAST(t AS BIGINT))
    WHEN regexp_full_match(t, '\d{4}-?\d{2}-?\d{2}[Tt ]\d{2}:?\d{2}(:?\d{2}([.,]\d{1,9})?)?\s*([Zz]|[+-]\d{2}(:?\d{2})?)?') THEN TRY_CAST(
      regexp_replace(regexp_replace(
        regexp_replace(replace(upper(t), ',', '.'), '^(\d{4})-?(\d{2})-?(\d{2})[T ](\d{2}):?(\d{2}):?(\d{2})', '\1-\2-\3 \4:\5:\6'),
        'Z$', '+00:00'), '([+-]\d{2}):?(\d{2})$', '\1:\2')
      || CASE WHEN regexp_matches(t, '([Zz]|[T ].*[+-]\d{2}(:?\d{2})?)$') THEN '' ELSE '+00:00' END AS TIMESTAMPTZ)
    END AS ingested
  FROM times
), seen AS (
  SELECT doc_id, min(ingested) AS ingested, max(hash) AS hash FROM parsed GROUP BY doc_id
), rows_ AS (
  SELECT d.doc_id, d.path, coalesce(d.updated_at, d.last_modified) AS version, s.hash,
    (SELECT min(run) FROM runs r WHERE r.started_at >= s.ingested) AS run
  FROM documents d JOIN seen s ON d.doc_id = s.doc_id WHERE s.ingested IS NOT NULL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY path ORDER BY version NULLS FIRST, doc_id) AS rk FROM rows_ WHERE run IS NOT NULL
), at_run AS (
  SELECT path, run, max(rk) AS rk FROM ranked GROUP BY path, run
), newest AS (
  SELECT path, run, rk, max(rk) OVER (PARTITION BY path ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM at_run
)
SELECT r.run_id AS run_id, a.doc_id AS doc_id
FROM newest n JOIN ranked a ON a.path IS NOT DISTINCT FROM n.path AND a.rk = n.rk
JOIN runs r ON r.run = n.run
LEFT JOIN ranked b ON b.path IS NOT DISTINCT FROM n.path AND b.rk = n.before
WHERE n.before IS NULL OR (n.rk > n.before AND (a.hash IS NULL OR b.hash IS NULL OR a.hash <> b.hash))
"""

QUERIES = {"p2_found": p2_found}
SQL = {"p2_found": P2_SQL}
