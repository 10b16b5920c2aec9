"""SQL fragments shared by the DuckDB oracles.

The oracles compute expected answers by arithmetic on the document id (the raw
line variant is ``v = (doc_id * a + b) % 10`` per model), never by re-implementing
the parser, so the engine and the oracle cannot share a bug.
"""

from __future__ import annotations

from ..sources.derived import GROUND_TRUTH_SQL, PARTS_ROWS_SQL, oracle_text

G_CTE = f"g AS ({oracle_text(GROUND_TRUTH_SQL)})"
S_CTE = f"s AS ({oracle_text(PARTS_ROWS_SQL)})"

GT_CTE = (
    "gt AS (SELECT dataset, sample_id, "
    "coalesce(lower(trim(label)) IN ('accept','accepted','true','yes','1'), false) AS is_positive, "
    "coalesce(trim(rejection_reason), '') AS rejection_reason FROM g)"
)

R_CTE = """r AS (
  SELECT doc_id, CASE WHEN doc_id % 20 < 10 THEN 'pairs-r' ELSE 'pairs-s' END AS dataset,
         'model-a' AS model, doc_id % 10 AS v FROM documents
  UNION ALL
  SELECT doc_id, CASE WHEN doc_id % 20 < 10 THEN 'pairs-r' ELSE 'pairs-s' END AS dataset,
         'model-b' AS model, (doc_id * 3 + 1) % 10 AS v FROM documents)"""

# contains-mode predictions (ANS-1), lines 6-8 dropped
P_CTE = """p AS (
  SELECT dataset, model, doc_id AS sample_id,
         CASE WHEN v IN (0, 2, 5, 9) THEN 'yes' ELSE 'no' END AS prediction
  FROM r WHERE v NOT IN (6, 7, 8))"""

# Per-line expected answers of every mode, for the lines that yield one.
ANSWERS_CTE = """ans AS (
  SELECT dataset, model, doc_id AS sample_id, v,
         CASE WHEN v IN (0, 2, 5, 9) THEN 'yes' ELSE 'no' END AS a_contains,
         CASE v WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN '''yes''' WHEN 3 THEN 'no'
                WHEN 4 THEN 'yes' WHEN 5 THEN 'yes' ELSE 'eyes only' END AS a_raw_tail,
         CASE v WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN 'yes' WHEN 3 THEN 'yes</reasoning> no'
                WHEN 4 THEN 'no' WHEN 5 THEN 'no' ELSE 'eyes only' END AS a_first_tag,
         CASE v WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'Yes' WHEN 3 THEN 'Yes'
                WHEN 4 THEN 'Yes' ELSE 'Unknown' END AS a_word
  FROM r WHERE v NOT IN (6, 7, 8))"""


# The odd lines (one per document): variant o, what happens to the line, its answer.
O_CTE = """o AS (
  SELECT doc_id, CASE WHEN doc_id % 20 < 10 THEN 'pairs-r' ELSE 'pairs-s' END AS dataset, 'model-odd' AS model, o,
         CASE WHEN o <= 6 THEN 'malformed' WHEN o IN (10, 11) THEN 'no_content' ELSE 'ok' END AS outcome,
         CASE WHEN o IN (7, 8) THEN 'Yes' WHEN o = 9 THEN 'No' WHEN o = 12 THEN 'yes' END AS content
  FROM (SELECT doc_id, doc_id % 13 AS o FROM documents))"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
