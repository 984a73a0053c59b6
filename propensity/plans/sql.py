"""DuckDB oracle fragments: the fixtures of ``plans.fixtures`` as CTEs.

Oracles are independent re-statements of each query in SQL; they share only
these input definitions with the Spark side. Doubles are rounded to 6 places
on both sides before the driver hashes them.
"""

from __future__ import annotations

VISITS = """
visits_g AS (
  SELECT user_id, CAST(ts AS DATE) AS day,
         count(*) FILTER (WHERE event_type = 'signup') AS adm,
         coalesce(sum(CASE WHEN event_type = 'signup' THEN value ELSE 0.0 END), 0.0) AS adm_value,
         count(*) FILTER (WHERE event_type = 'click') AS inf,
         coalesce(sum(CASE WHEN event_type = 'click' THEN value ELSE 0.0 END), 0.0) AS inf_value,
         count(*) FILTER (WHERE event_type = 'view') AS prd,
         coalesce(sum(CASE WHEN event_type = 'view' THEN value ELSE 0.0 END), 0.0) AS prd_value,
         count(*) FILTER (WHERE event_type = 'error') AS n_err,
         count(*) FILTER (WHERE event_type <> 'purchase') AS n_nonp,
         max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS label
  FROM events GROUP BY 1, 2),
visits AS (
  SELECT CAST(g.user_id AS VARCHAR) || '_' || CAST(g.day AS VARCHAR) AS visit_id,
         g.user_id, g.day,
         CASE WHEN g.day >= DATE '2024-01-22' THEN 'test' ELSE 'train' END AS period,
         g.adm, g.adm_value, g.inf, g.inf_value, g.prd, g.prd_value,
         CASE WHEN g.n_nonp = 0 THEN 0.0 ELSE g.n_err / g.n_nonp END AS err_rate,
         CASE WHEN g.user_id % 17 = 0 THEN 'Other'
              WHEN g.day = min(g.day) OVER (PARTITION BY g.user_id) THEN 'New_Visitor'
              ELSE 'Returning_Visitor' END AS visitor,
         CAST(c.c_nationkey AS VARCHAR) AS nation,
         c.c_mktsegment AS segment,
         CASE WHEN isodow(g.day) >= 6 THEN 1 ELSE 0 END AS weekend,
         CAST(g.label AS INTEGER) AS label
  FROM visits_g g LEFT JOIN customer c ON g.user_id = c.c_custkey)"""

DOCS = r"""
docs AS (
  SELECT l.doc_id, l.quality, l.toxic, d.lang, d.source, d.n_chars,
         CAST(len(regexp_extract_all(d.text, '[^ \t\r\n]+')) AS BIGINT) AS n_words,
         CASE WHEN len(regexp_extract_all(d.text, '[^ \t\r\n]+')) = 0 THEN 0.0
              ELSE len(list_distinct(regexp_extract_all(d.text, '[^ \t\r\n]+')))
                   / len(regexp_extract_all(d.text, '[^ \t\r\n]+')) END AS distinct_share,
         CASE WHEN length(d.text) = 0 THEN 0.0
              ELSE length(regexp_replace(d.text, '[^0-9]', '', 'g')) / length(d.text) END AS digit_share,
         CAST(length(d.text) - length(replace(d.text, chr(10), '')) + 1 AS BIGINT) AS n_lines
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

ORDERS = """
ords AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate,
         CAST(month(o_orderdate) AS INTEGER) AS month,
         ['Jan','Feb','Mar','Apr','May','June','Jul','Aug','Sep','Oct','Nov','Dec'][month(o_orderdate)] AS month_name,
         CASE WHEN month(o_orderdate) IN (11, 12) THEN 'test' ELSE 'train' END AS period
  FROM orders)"""


def with_(*ctes: str, body: str) -> str:
    """Assemble ``WITH cte, cte ... body``."""
    parts = [c.strip() for c in ctes if c and c.strip()]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


def rounded(inner: str, cols: list[str], places: int = 6) -> str:
    """Round the listed double columns of a query to ``places`` decimals."""
    if not cols:
        return inner
    # "+ 0.0" turns a rounded -0.0 into 0.0 (Spark's round never yields -0.0)
    rep = ", ".join(f"round({c}, {places}) + 0.0 AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{inner}\n) _r"


def unpivot(src: str, cols: list[str], ids: list[str] | tuple = (), name: str = "feature",
            value: str = "value", cast: str | None = None) -> str:
    """Wide -> long as a UNION ALL (keeps nulls, like Spark's ``unpivot``)."""
    parts = []
    for c in cols:
        v = f"CAST({c} AS {cast})" if cast else c
        head = "".join(f"{i}, " for i in ids)
        parts.append(f"SELECT {head}'{c}' AS {name}, {v} AS {value} FROM {src}")
    return "\n UNION ALL ".join(parts)
