"""Registered queries for report reshaping: log series, facets, filters, report rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reports
from ..sources import derived
from .oracle_common import G_CTE, with_ctes

# The event types of the events table play the role of the training-log metrics.
METRICS = ["view", "click", "error", "signup", "purchase"]
REPORT_FIELDS = ["rejection_reason", "object_description", "product_type", "pose", "input_prompt"]


def q_log_unpivot(spark, sf):
    ev = derived.read_table(spark, sf, "events")
    wide = ev.select(
        F.col("event_id").alias("step"),
        (F.col("event_id").cast("double") / 1000).alias("epoch"),
        *[F.when(F.col("event_type") == m, F.col("value")).alias(m) for m in METRICS],
    )
    return reports.log_series(wide, METRICS)


def _rows(spark, sf):
    g = derived.ground_truth(spark, sf).withColumnRenamed("dataset", "split")
    return reports.report_rows(g, REPORT_FIELDS)


def q_report_rows(spark, sf):
    g = derived.ground_truth(spark, sf).withColumnRenamed("dataset", "split")
    return reports.report_rows(g, REPORT_FIELDS, keep=["sample_id"])


def q_facets(spark, sf):
    return reports.facets(_rows(spark, sf).drop("sample_id"), ["split", "label_norm", "rejection_reason"])


def q_facet_filter(spark, sf):
    return reports.filter_counts(_rows(spark, sf), ["split", "label_norm", "rejection_reason"])


QUERIES = {
    "log_unpivot": q_log_unpivot,
    "report_rows": q_report_rows,
    "facets": q_facets,
    "facet_filter": q_facet_filter,
}

_ROWS = with_ctes(G_CTE) + """,
rr AS (SELECT sample_id, dataset AS split,
              CASE WHEN lower(trim(coalesce(label, ''))) IN ('accepted', 'accept') THEN 'accepted' ELSE 'rejected' END AS label_norm,
              coalesce(rejection_reason, '') AS rejection_reason, coalesce(object_description, '') AS object_description,
              '' AS product_type, '' AS pose, '' AS input_prompt
       FROM g)
"""

ORACLE = {
    "log_unpivot": """
SELECT event_type AS metric, event_id AS step, CAST(event_id AS DOUBLE) / 1000 AS epoch, value
FROM events WHERE value IS NOT NULL AND event_type IN ('view', 'click', 'error', 'signup', 'purchase')
""",
    "report_rows": _ROWS + "SELECT * FROM rr",
    "facets": _ROWS + """
SELECT 'split' AS facet, split AS value, CAST(count(*) AS BIGINT) AS n FROM rr WHERE coalesce(split, '') <> '' GROUP BY ALL
UNION ALL SELECT 'label_norm', label_norm, CAST(count(*) AS BIGINT) FROM rr WHERE coalesce(label_norm, '') <> '' GROUP BY ALL
UNION ALL SELECT 'rejection_reason', rejection_reason, CAST(count(*) AS BIGINT) FROM rr WHERE coalesce(rejection_reason, '') <> '' GROUP BY ALL
""",
    "facet_filter": _ROWS + """
SELECT CASE WHEN GROUPING(split) = 1 THEN 'all' ELSE split END AS split,
       CASE WHEN GROUPING(label_norm) = 1 THEN 'all' ELSE label_norm END AS label_norm,
       CASE WHEN GROUPING(rejection_reason) = 1 THEN 'all' ELSE rejection_reason END AS rejection_reason,
       CAST(count(*) AS BIGINT) AS n
FROM rr GROUP BY CUBE (split, label_norm, rejection_reason)
""",
}
