"""Independent DuckDB SQL for every registered query.

Written from the definitions (SURVEY §2, FIXTURES §2), not from the Spark
plans.  ``STAR`` defines the star source and the silver tables as CTEs over
the pre-registered parquet views; each oracle is ``STAR`` + a final SELECT.
Conventions: SUM over BIGINT is cast back to BIGINT (DuckDB widens to
HUGEINT), DATEDIFF and ROW_NUMBER are cast to INTEGER, divisions use DOUBLE.
"""

from __future__ import annotations

STAR = r"""
WITH
ws AS (
  SELECT 'ws-' || CAST(r_regionkey AS VARCHAR) AS workspace_id, r_name AS workspace_name,
         'Capacity-P' || CAST(1 + r_regionkey % 2 AS VARCHAR) AS capacity_name
  FROM region),
anchor AS (SELECT MAX(CAST(l_shipdate AS DATE)) AS as_of FROM lineitem),
cat AS (
  SELECT p.p_partkey,
         'ws-' || CAST(CAST(regexp_extract(p.p_brand, '#(\d+)', 1) AS INTEGER) % 5 AS VARCHAR) AS workspace_id,
         p.p_brand AS report_id, 'Report ' || p.p_brand AS report_name,
         CAST(p.p_partkey AS VARCHAR) AS page_id, p.p_name AS page_name,
         CAST(ROW_NUMBER() OVER (PARTITION BY p.p_brand ORDER BY p.p_partkey) AS INTEGER) AS page_ordinal,
         CAST(COUNT(*) OVER (PARTITION BY p.p_brand) AS INTEGER) AS report_total_pages
  FROM part p),
catalog AS (
  SELECT c.workspace_id, w.workspace_name, w.capacity_name, c.report_id, c.report_name, c.page_id,
         c.page_name, c.page_ordinal, c.report_total_pages, c.p_partkey,
         CAST(a.as_of AS TIMESTAMP) AS catalog_pulled_at
  FROM cat c JOIN ws w ON w.workspace_id = c.workspace_id, anchor a),
ev AS (
  SELECT c.workspace_id, c.report_id, c.page_id, CAST(l.l_shipdate AS DATE) AS view_date,
         cu.c_name || '@example.com' AS user_upn, CAST(l.l_quantity AS BIGINT) AS views,
         CAST(l.l_linenumber * 10 AS DOUBLE) AS dwell_seconds, cu.c_mktsegment AS persona,
         CAST(l.l_orderkey AS VARCHAR) AS visit_id
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer cu ON cu.c_custkey = o.o_custkey
  JOIN cat c ON c.p_partkey = l.l_partkey),
persona_views AS (
  SELECT workspace_id, report_id, page_id, view_date, persona, SUM(views) AS v
  FROM ev GROUP BY workspace_id, report_id, page_id, view_date, persona),
top_persona AS (
  SELECT workspace_id, report_id, page_id, view_date, persona AS top_persona FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY workspace_id, report_id, page_id, view_date
                                 ORDER BY v DESC, persona DESC) AS rn
    FROM persona_views) WHERE rn = 1),
pv AS (
  SELECT e.workspace_id, c.workspace_name, c.capacity_name, e.report_id, c.report_name,
         c.report_total_pages, e.page_id, c.page_name, c.page_ordinal, e.view_date,
         CAST(SUM(e.views) AS BIGINT) AS view_count,
         COUNT(DISTINCT lower(e.user_upn)) AS unique_users,
         AVG(e.dwell_seconds) AS avg_dwell_seconds,
         MIN(t.top_persona) AS top_persona
  FROM ev e
  JOIN catalog c ON c.workspace_id = e.workspace_id AND c.report_id = e.report_id AND c.page_id = e.page_id
  JOIN top_persona t ON t.workspace_id = e.workspace_id AND t.report_id = e.report_id
                     AND t.page_id = e.page_id AND t.view_date = e.view_date
  GROUP BY e.workspace_id, c.workspace_name, c.capacity_name, e.report_id, c.report_name,
           c.report_total_pages, e.page_id, c.page_name, c.page_ordinal, e.view_date),
visits AS (
  SELECT workspace_id, report_id, visit_id, view_date, user_upn, SUM(dwell_seconds) AS session_seconds
  FROM ev GROUP BY workspace_id, report_id, visit_id, view_date, user_upn),
rv AS (
  SELECT v.workspace_id, w.workspace_name, w.capacity_name, v.report_id,
         'Report ' || v.report_id AS report_name, v.view_date,
         CAST(COUNT(*) AS BIGINT) AS view_count,
         COUNT(DISTINCT lower(v.user_upn)) AS unique_users,
         AVG(v.session_seconds) AS avg_session_seconds
  FROM visits v JOIN ws w ON w.workspace_id = v.workspace_id
  GROUP BY v.workspace_id, w.workspace_name, w.capacity_name, v.report_id, v.view_date),
uv AS (
  SELECT e.workspace_id, w.workspace_name, e.report_id, 'Report ' || e.report_id AS report_name,
         substr(sha256(lower(trim(e.user_upn))), 1, 16) AS user_id_hash, e.view_date,
         CAST(SUM(e.views) AS BIGINT) AS view_count,
         COUNT(DISTINCT e.page_id) AS distinct_pages_viewed
  FROM ev e JOIN ws w ON w.workspace_id = e.workspace_id
  GROUP BY e.workspace_id, w.workspace_name, e.report_id, user_id_hash, e.view_date),
win AS (SELECT as_of - 89 AS lo, as_of AS hi FROM anchor),
pv90 AS (SELECT pv.* FROM pv, win WHERE pv.view_date BETWEEN win.lo AND win.hi),
unused AS (
  SELECT c.workspace_id, c.workspace_name, c.report_id, c.report_name, c.page_id, c.page_name,
         c.page_ordinal, c.catalog_pulled_at
  FROM catalog c
  WHERE NOT EXISTS (SELECT 1 FROM pv90 v WHERE v.workspace_id = c.workspace_id
                    AND v.report_id = c.report_id AND v.page_id = c.page_id)),
win30 AS (SELECT as_of - 29 AS lo, as_of AS hi FROM anchor),
pv30 AS (SELECT pv.* FROM pv, win30 WHERE pv.view_date BETWEEN win30.lo AND win30.hi),
rv90 AS (SELECT rv.* FROM rv, win WHERE rv.view_date BETWEEN win.lo AND win.hi),
rv30 AS (SELECT rv.* FROM rv, win30 WHERE rv.view_date BETWEEN win30.lo AND win30.hi),
uv90 AS (SELECT uv.* FROM uv, win WHERE uv.view_date BETWEEN win.lo AND win.hi),
pt AS (
  SELECT workspace_id, report_id, page_id, MAX(workspace_name) AS workspace_name,
         MAX(report_name) AS report_name, MAX(page_name) AS page_name, MAX(page_ordinal) AS page_ordinal,
         CAST(SUM(view_count) AS BIGINT) AS views, MAX(unique_users) AS users_peak,
         CAST(SUM(unique_users) AS BIGINT) AS user_days,
         SUM(view_count * avg_dwell_seconds) AS dwell_weighted_sum,
         AVG(avg_dwell_seconds) AS avg_dwell_unweighted,
         MIN(view_date) AS first_seen, MAX(view_date) AS last_seen
  FROM pv90 GROUP BY workspace_id, report_id, page_id),
rep AS (
  SELECT workspace_id, report_id, MAX(workspace_name) AS workspace_name, MAX(capacity_name) AS capacity_name,
         MAX(report_name) AS report_name, MAX(report_total_pages) AS report_total_pages
  FROM pv90 GROUP BY workspace_id, report_id),
allp AS (
  SELECT *, CAST(UNNEST(generate_series(1, report_total_pages)) AS INTEGER) AS page_ordinal FROM rep),
miss AS (
  SELECT a.workspace_id, a.workspace_name, a.capacity_name, a.report_id, a.report_name,
         printf('%s::p%03d', a.report_id, a.page_ordinal - 1) AS page_id,
         COALESCE(c.page_name, printf('(page %d)', a.page_ordinal)) AS page_name, a.page_ordinal
  FROM allp a
  LEFT JOIN (SELECT report_id, page_ordinal, MIN(page_name) AS page_name FROM catalog
             GROUP BY report_id, page_ordinal) c
         ON c.report_id = a.report_id AND c.page_ordinal = a.page_ordinal
  WHERE NOT EXISTS (SELECT 1 FROM pv90 v WHERE v.workspace_id = a.workspace_id
                    AND v.report_id = a.report_id AND v.page_ordinal = a.page_ordinal)),
detail AS (
  SELECT workspace_id, report_id, page_id, page_name, page_ordinal, views, users_peak,
         ROUND(COALESCE(dwell_weighted_sum / NULLIF(views, 0), 0.0), 1) AS avg_dwell_seconds,
         first_seen, last_seen FROM pt
  UNION ALL
  SELECT workspace_id, report_id, page_id, page_name, page_ordinal, CAST(0 AS BIGINT), CAST(0 AS BIGINT),
         0.0::DOUBLE, CAST(NULL AS DATE), CAST(NULL AS DATE) FROM miss),
rsum AS (
  SELECT r.workspace_id, r.workspace_name, r.capacity_name, r.report_id, r.report_name,
         r.report_total_pages AS total_pages,
         CAST(COUNT(*) FILTER (WHERE p.views > 0) AS BIGINT) AS pages_with_views,
         CAST(r.report_total_pages - COUNT(DISTINCT p.page_ordinal) AS BIGINT) AS pages_never_viewed,
         CAST(SUM(p.views) AS BIGINT) AS total_views, MAX(p.users_peak) AS active_users_peak
  FROM rep r JOIN pt p ON p.workspace_id = r.workspace_id AND p.report_id = r.report_id
  GROUP BY r.workspace_id, r.workspace_name, r.capacity_name, r.report_id, r.report_name, r.report_total_pages)
"""

PV_COLS = ("workspace_id, workspace_name, capacity_name, report_id, report_name, report_total_pages, "
           "page_id, page_name, page_ordinal, view_date, view_count, unique_users, avg_dwell_seconds, top_persona")
CAT_COLS = "workspace_id, workspace_name, report_id, report_name, page_id, page_name, page_ordinal, catalog_pulled_at"

_Q: dict[str, str] = {}


def q(name: str, body: str) -> None:
    b = body.lstrip()
    if b[:4].upper() == "WITH":  # extra CTEs continue the preamble's WITH list
        _Q[name] = STAR.rstrip() + ",\n" + b[4:]
    else:
        _Q[name] = STAR + body


def all_sql() -> dict[str, str]:
    # Import the modules that register their oracles.
    from leafstat.plans import oracle_queries  # noqa: F401
    from leafstat.plans.catalogue import SURVEY_ALIASES
    out = dict(_Q)
    for alias, name in SURVEY_ALIASES.items():
        out.setdefault(alias, out[name])
    return out
