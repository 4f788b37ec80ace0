"""Oracle SQL bodies, one per catalogue query (see ``oracle.STAR``)."""

from leafstat.plans.oracle import CAT_COLS, PV_COLS, _Q, q

q("page_views_daily", f"SELECT {PV_COLS} FROM pv")
q("report_views_daily", "SELECT * FROM rv")
q("user_views_daily", "SELECT * FROM uv")
q("page_catalog", f"SELECT {CAT_COLS} FROM catalog")
q("unused_pages", "SELECT * FROM unused ORDER BY workspace_name, report_name, page_ordinal")

# -- pages and reports ------------------------------------------------------
q("missing_page_ordinals", "SELECT * FROM miss")
q("page_detail", "SELECT * FROM detail")
q("page_coverage_rate", """
SELECT d.workspace_id, d.report_id, d.workspace_name, d.report_name, d.pages_defined,
       CAST(COALESCE(v.pages_viewed, 0) AS BIGINT) AS pages_viewed,
       ROUND(CAST(100 AS DOUBLE) * COALESCE(v.pages_viewed, 0) / d.pages_defined, 1) AS coverage_pct
FROM (SELECT workspace_id, report_id, MAX(workspace_name) AS workspace_name, MAX(report_name) AS report_name,
             COUNT(DISTINCT page_id) AS pages_defined FROM catalog GROUP BY workspace_id, report_id) d
LEFT JOIN (SELECT workspace_id, report_id, COUNT(DISTINCT page_id) AS pages_viewed FROM pv90
           GROUP BY workspace_id, report_id) v
  ON v.workspace_id = d.workspace_id AND v.report_id = d.report_id
ORDER BY coverage_pct, pages_defined DESC""")
q("workspace_summary", """
SELECT workspace_id, MAX(workspace_name) AS workspace_name, COUNT(DISTINCT report_id) AS report_count,
       COUNT(DISTINCT report_id || '|' || page_id) AS page_count, CAST(SUM(view_count) AS BIGINT) AS total_views
FROM pv90 GROUP BY workspace_id ORDER BY total_views DESC""")
q("report_summary", "SELECT * FROM rsum ORDER BY total_views DESC")
q("persona_breakdown", """
SELECT workspace_id, report_id, top_persona AS persona, CAST(SUM(view_count) AS BIGINT) AS views
FROM pv90 GROUP BY workspace_id, report_id, top_persona""")
q("views_distribution", """
SELECT CAST(b.bucket_order AS INTEGER) AS bucket_order, b.bucket, CAST(COUNT(a.v) AS BIGINT) AS pages
FROM (VALUES (0, '0 (never)', 0, 0), (1, '1–10', 1, 10), (2, '11–50', 11, 50), (3, '51–200', 51, 200),
             (4, '201–1k', 201, 1000), (5, '1k–5k', 1001, 5000), (6, '5k+', 5001, 9223372036854775807))
     b(bucket_order, bucket, lo, hi)
LEFT JOIN (SELECT views AS v FROM pt UNION ALL SELECT 0 FROM miss) a ON a.v BETWEEN b.lo AND b.hi
GROUP BY b.bucket_order, b.bucket ORDER BY 1""")
q("underused_top10", """
SELECT workspace_id, report_id, page_id, workspace_name, report_name, page_name, views AS total_views,
       user_days, avg_dwell_unweighted AS avg_dwell
FROM pt WHERE views <= 10
ORDER BY total_views, report_name, page_name, workspace_id, report_id, page_id LIMIT 10""")
q("underused_dashboard", """
SELECT workspace_id, report_id, page_id, workspace_name, report_name, page_name, views
FROM pt WHERE views > 0 AND views < 100 ORDER BY views, workspace_id, report_id, page_id LIMIT 200""")
q("underused_pages_count", "SELECT COUNT(*) FILTER (WHERE views > 0 AND views <= 10) AS underused_pages FROM pt")
q("headline_kpis", """
SELECT (SELECT CAST(SUM(view_count) AS BIGINT) FROM pv90) AS total_views,
       (SELECT COUNT(*) FROM pt) AS pages_viewed,
       (SELECT COUNT(*) FROM (SELECT DISTINCT workspace_id, report_id, page_id FROM catalog)) AS pages_defined,
       (SELECT COUNT(*) FROM (SELECT DISTINCT workspace_id, report_id FROM pv90)) AS reports,
       (SELECT COUNT(DISTINCT workspace_id) FROM pv90) AS workspaces,
       (SELECT AVG(avg_dwell_seconds) FROM pv90) AS avg_dwell_unweighted""")
q("unused_kpis", """
SELECT (SELECT COUNT(*) FROM unused) AS unused_pages,
       (SELECT COUNT(*) FROM unused) / (SELECT COUNT(*) FROM catalog)::DOUBLE AS pct_pages_unused,
       (SELECT COUNT(*) FROM (SELECT DISTINCT workspace_id, report_id FROM unused)) AS reports_with_unused""")
q("viewed_keys_except", """
SELECT workspace_id, report_id, page_id FROM catalog
EXCEPT SELECT workspace_id, report_id, page_id FROM pv90""")
q("reports_with_unused", """
SELECT workspace_id, report_id, MAX(workspace_name) AS workspace_name, MAX(report_name) AS report_name,
       COUNT(DISTINCT page_id) AS unused_pages
FROM unused GROUP BY workspace_id, report_id ORDER BY unused_pages DESC""")
q("top_page_share", """
SELECT workspace_id, report_id, MAX(views) AS top_page_views, CAST(SUM(views) AS BIGINT) AS report_views,
       MAX(views) / SUM(views)::DOUBLE AS top_page_share
FROM pt GROUP BY workspace_id, report_id""")
q("avg_views_per_page", """
SELECT workspace_id, report_id, total_views, total_pages,
       CAST(ROUND(total_views / GREATEST(total_pages, 1)::DOUBLE) AS BIGINT) AS avg_views_per_page
FROM rsum""")
q("page_daily_trend", """
SELECT workspace_id, report_id, page_id, view_date, CAST(SUM(view_count) AS BIGINT) AS views
FROM pv90 GROUP BY workspace_id, report_id, page_id, view_date""")
q("top_pages", """
SELECT workspace_id, report_id, page_id, workspace_name, report_name, page_name, views
FROM pt WHERE views > 0 ORDER BY views DESC, workspace_id, report_id, page_id LIMIT 25""")
q("unused_sample", """
SELECT workspace_id, report_id, page_id, workspace_name, report_name, page_name, page_ordinal
FROM unused ORDER BY workspace_name, report_name, page_ordinal, workspace_id, report_id, page_id LIMIT 10""")
q("longest_report", """
SELECT workspace_id, report_id, report_name, report_total_pages FROM rep
ORDER BY report_total_pages DESC, workspace_id, report_id LIMIT 1""")
q("report_picker", """
SELECT workspace_name, report_name, workspace_id, report_id FROM rep
ORDER BY workspace_name, report_name, workspace_id, report_id""")
q("page_name_search", f"SELECT {CAT_COLS} FROM catalog WHERE contains(lower(page_name), 'blue')")
q("page_funnel", """
SELECT workspace_id, report_id, report_name, page_name, page_ordinal, page_views,
       page_views / (MAX(page_views) OVER (PARTITION BY workspace_id, report_id))::DOUBLE AS pct_of_max
FROM (SELECT workspace_id, report_id, page_id, MAX(report_name) AS report_name, MAX(page_name) AS page_name,
             MAX(page_ordinal) AS page_ordinal, CAST(SUM(view_count) AS BIGINT) AS page_views
      FROM pv30 GROUP BY workspace_id, report_id, page_id) t
ORDER BY workspace_id, report_id, page_ordinal""".replace(
    "SELECT workspace_id, report_id, report_name", "SELECT workspace_id, report_id, page_id, report_name", 1))
q("pct_of_first_page", """
SELECT workspace_id, report_id, page_id, page_ordinal, views,
       CAST(SUM(CASE WHEN page_ordinal = 1 THEN views END) OVER (PARTITION BY workspace_id, report_id) AS BIGINT)
         AS first_page_views,
       views / (SUM(CASE WHEN page_ordinal = 1 THEN views END) OVER (PARTITION BY workspace_id, report_id))::DOUBLE
         AS pct_of_first_page
FROM pt""")
q("cumulative_views_by_ordinal", """
SELECT workspace_id, report_id, page_ordinal, views,
       CAST(SUM(views) OVER (PARTITION BY workspace_id, report_id ORDER BY page_ordinal) AS BIGINT)
         AS cumulative_views
FROM (SELECT workspace_id, report_id, page_ordinal, CAST(SUM(view_count) AS BIGINT) AS views
      FROM pv90 GROUP BY workspace_id, report_id, page_ordinal)""")
q("page_bar_share", """
SELECT workspace_id, report_id, page_id, page_name, page_ordinal, views,
       GREATEST(1.0, (views / GREATEST(MAX(views) OVER (PARTITION BY workspace_id, report_id), 1)::DOUBLE) * 100)
         AS bar_pct
FROM detail""")
q("pages_per_session", """
WITH p AS (SELECT workspace_id, report_id, view_date, SUM(view_count) AS pviews FROM pv30
           GROUP BY workspace_id, report_id, view_date),
     r AS (SELECT workspace_id, report_id, view_date, SUM(view_count) AS sessions,
                  SUM(avg_session_seconds) AS ss, COUNT(*) AS n
           FROM rv30 GROUP BY workspace_id, report_id, view_date),
     names AS (SELECT workspace_id, report_id, MAX(workspace_name) AS workspace_name,
                      MAX(report_name) AS report_name FROM pv30 GROUP BY workspace_id, report_id)
SELECT p.workspace_id, p.report_id, names.workspace_name, names.report_name,
       CAST(SUM(p.pviews) AS BIGINT) AS total_page_views, CAST(SUM(r.sessions) AS BIGINT) AS total_report_sessions,
       ROUND(SUM(p.pviews) / SUM(r.sessions)::DOUBLE, 2) AS pages_per_session,
       SUM(r.ss) / SUM(r.n) AS avg_session_seconds
FROM p JOIN r ON r.workspace_id = p.workspace_id AND r.report_id = p.report_id AND r.view_date = p.view_date
JOIN names ON names.workspace_id = p.workspace_id AND names.report_id = p.report_id
GROUP BY p.workspace_id, p.report_id, names.workspace_name, names.report_name
HAVING SUM(r.sessions) > 0 ORDER BY pages_per_session""")
q("daily_trend", "SELECT view_date, CAST(SUM(view_count) AS BIGINT) AS views FROM pv90 GROUP BY view_date ORDER BY 1")
q("views_by_capacity", "SELECT capacity_name, CAST(SUM(view_count) AS BIGINT) AS total_views FROM pv90 GROUP BY 1")
q("report_level_kpis", """
SELECT (SELECT CAST(SUM(view_count) AS BIGINT) FROM rv90) AS report_views,
       (SELECT SUM(view_count) FROM pv90) / (SELECT SUM(view_count) FROM rv90)::DOUBLE AS pages_per_session,
       (SELECT AVG(avg_session_seconds) FROM rv90) AS avg_session_seconds""")
q("trend_page_vs_report", """
SELECT COALESCE(a.view_date, b.view_date) AS view_date, a.page_views, b.report_views
FROM (SELECT view_date, CAST(SUM(view_count) AS BIGINT) AS page_views FROM pv90 GROUP BY 1) a
FULL JOIN (SELECT view_date, CAST(SUM(view_count) AS BIGINT) AS report_views FROM rv90 GROUP BY 1) b
  ON a.view_date = b.view_date ORDER BY 1""")
q("report_matrix", """
WITH pg AS (SELECT workspace_id, report_id, MAX(workspace_name) AS workspace_name, MAX(report_name) AS report_name,
                   CAST(SUM(views) AS BIGINT) AS views, MAX(views) AS top FROM pt GROUP BY 1, 2),
     s AS (SELECT workspace_id, report_id, SUM(view_count) AS report_views,
                  AVG(avg_session_seconds) AS avg_session_seconds FROM rv90 GROUP BY 1, 2),
     u AS (SELECT workspace_id, report_id, COUNT(DISTINCT page_id) AS n FROM unused GROUP BY 1, 2)
SELECT pg.workspace_id, pg.report_id, pg.workspace_name, pg.report_name, pg.views,
       pg.views / NULLIF(s.report_views, 0)::DOUBLE AS pages_per_session, s.avg_session_seconds,
       pg.top / NULLIF(pg.views, 0)::DOUBLE AS top_page_share, COALESCE(u.n, 0) AS unused_pages,
       CASE WHEN COALESCE(u.n, 0) >= 5 THEN 'red' WHEN COALESCE(u.n, 0) >= 1 THEN 'yellow' ELSE '' END AS unused_band
FROM pg LEFT JOIN s ON s.workspace_id = pg.workspace_id AND s.report_id = pg.report_id
LEFT JOIN u ON u.workspace_id = pg.workspace_id AND u.report_id = pg.report_id""")
q("dashboard_meta", """
SELECT (SELECT MIN(view_date) FROM pv90) AS date_from, (SELECT MAX(view_date) FROM pv90) AS date_to,
       (SELECT COUNT(DISTINCT view_date) FROM pv90) AS days,
       (SELECT COUNT(DISTINCT workspace_id) FROM pv90) AS total_workspaces,
       (SELECT COUNT(*) FROM rsum) AS total_reports,
       (SELECT CAST(SUM(total_pages) AS BIGINT) FROM rsum) AS total_pages_defined,
       (SELECT CAST(SUM(pages_with_views) AS BIGINT) FROM rsum) AS total_pages_with_views,
       (SELECT CAST(SUM(pages_never_viewed) AS BIGINT) FROM rsum) AS total_pages_never_viewed,
       (SELECT CAST(SUM(view_count) AS BIGINT) FROM pv90) AS total_views,
       100 AS underused_threshold,
       (SELECT COUNT(*) FROM pt WHERE views > 0 AND views < 100) AS underused_count,
       (SELECT COUNT(*) FROM miss) AS unused_count,
       (SELECT COUNT(*) FROM (SELECT DISTINCT workspace_id, report_id FROM miss)) AS unused_reports_count""")

# -- trends, users, governance, ops -----------------------------------------
ROLLING = """
WITH rd AS (SELECT workspace_id, report_id, view_date, SUM(view_count) AS v FROM pv, anchor
            WHERE view_date <= anchor.as_of GROUP BY workspace_id, report_id, view_date),
fr AS (SELECT workspace_id, report_id, MIN(view_date) AS f FROM rd GROUP BY workspace_id, report_id),
sp AS (SELECT fr.workspace_id, fr.report_id,
              CAST(UNNEST(generate_series(CAST(fr.f AS TIMESTAMP), CAST(anchor.as_of AS TIMESTAMP), INTERVAL 1 DAY))
                   AS DATE) AS view_date
       FROM fr, anchor),
ser AS (SELECT sp.workspace_id, sp.report_id, sp.view_date, CAST(COALESCE(rd.v, 0) AS BIGINT) AS views
        FROM sp LEFT JOIN rd ON rd.workspace_id = sp.workspace_id AND rd.report_id = sp.report_id
                             AND rd.view_date = sp.view_date),
ro AS (SELECT *, CAST(SUM(views) OVER (PARTITION BY workspace_id, report_id ORDER BY view_date
                                       ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling_7d FROM ser)
"""
q("rolling_7d_views", ROLLING + "SELECT * FROM ro")
q("report_half_life", ROLLING.rstrip() + """,
pk AS (SELECT workspace_id, report_id, rolling_7d AS peak_rolling_7d, view_date AS peak_date FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY workspace_id, report_id ORDER BY rolling_7d DESC, view_date) AS rn
         FROM ro) WHERE rn = 1),
po AS (SELECT ro.workspace_id, ro.report_id, pk.peak_date, pk.peak_rolling_7d, MIN(ro.view_date) AS half_date
       FROM ro JOIN pk ON pk.workspace_id = ro.workspace_id AND pk.report_id = ro.report_id
       WHERE ro.view_date > pk.peak_date AND ro.rolling_7d < pk.peak_rolling_7d / 2.0
       GROUP BY ro.workspace_id, ro.report_id, pk.peak_date, pk.peak_rolling_7d),
nm AS (SELECT workspace_id, report_id, MAX(report_name) AS report_name FROM pv GROUP BY workspace_id, report_id)
SELECT po.workspace_id, po.report_id, nm.report_name, po.peak_date, po.half_date,
       CAST(datediff('day', po.peak_date, po.half_date) AS INTEGER) AS half_life_days, po.peak_rolling_7d
FROM po JOIN nm ON nm.workspace_id = po.workspace_id AND nm.report_id = po.report_id
ORDER BY half_life_days""")
q("capacity_long_tail", """
WITH rk AS (SELECT capacity_name, workspace_id, report_id, SUM(view_count) AS rv FROM pv30
            GROUP BY capacity_name, workspace_id, report_id),
r2 AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY capacity_name ORDER BY rv DESC, workspace_id, report_id) AS rnk FROM rk),
cu AS (SELECT *, SUM(rv) OVER (PARTITION BY capacity_name ORDER BY rnk) AS rt,
              SUM(rv) OVER (PARTITION BY capacity_name) AS tot FROM r2)
SELECT capacity_name, CAST(MIN(CASE WHEN CAST(rt AS DOUBLE) / tot >= 0.80 THEN rnk END) AS INTEGER) AS reports_for_80pct
FROM cu GROUP BY capacity_name ORDER BY reports_for_80pct""")
q("trailing_views", """
SELECT CAST(COALESCE(SUM(view_count) FILTER (WHERE view_date >= as_of - 6), 0) AS BIGINT) AS views_last_7d,
       CAST(COALESCE(SUM(view_count), 0) AS BIGINT) AS views_last_30d
FROM pv, anchor WHERE view_date BETWEEN as_of - 29 AND as_of""")
q("wow_change", """
SELECT l7 AS views_last_7d, p7 AS views_prev_7d, (l7 - p7) / NULLIF(p7, 0)::DOUBLE AS wow_change FROM (
  SELECT CAST(COALESCE(SUM(view_count) FILTER (WHERE view_date >= as_of - 6), 0) AS BIGINT) AS l7,
         CAST(COALESCE(SUM(view_count) FILTER (WHERE view_date < as_of - 6), 0) AS BIGINT) AS p7
  FROM pv, anchor WHERE view_date BETWEEN as_of - 13 AND as_of)""")
q("new_page_adoption", """
WITH a2 AS (SELECT MIN(view_date) + 89 AS a FROM pv),
f AS (SELECT pv.* FROM pv, a2 WHERE pv.view_date <= a2.a),
pd AS (SELECT workspace_id, report_id, page_id, view_date, SUM(view_count) AS dv, MAX(page_name) AS pn
       FROM f GROUP BY workspace_id, report_id, page_id, view_date),
fs AS (SELECT workspace_id, report_id, page_id, MIN(view_date) AS first_view, MAX(pn) AS page_name
       FROM pd GROUP BY workspace_id, report_id, page_id),
av AS (SELECT workspace_id, report_id, AVG(dv) AS ra FROM pd GROUP BY workspace_id, report_id)
SELECT fs.workspace_id, fs.report_id, fs.page_id, fs.page_name, fs.first_view,
       CAST(MIN(CASE WHEN pd.dv >= av.ra / 2 THEN datediff('day', fs.first_view, pd.view_date) END) AS INTEGER)
         AS days_to_half_avg
FROM pd JOIN fs ON fs.workspace_id = pd.workspace_id AND fs.report_id = pd.report_id AND fs.page_id = pd.page_id
JOIN av ON av.workspace_id = pd.workspace_id AND av.report_id = pd.report_id, a2
WHERE fs.first_view >= a2.a - 59
GROUP BY fs.workspace_id, fs.report_id, fs.page_id, fs.page_name, fs.first_view
ORDER BY days_to_half_avg NULLS LAST""")
q("idle_alert", """
WITH l AS (SELECT workspace_id, report_id, page_id, MAX(view_date) AS last_view_date FROM pv, anchor
           WHERE view_date <= anchor.as_of GROUP BY workspace_id, report_id, page_id)
SELECT c.workspace_id, c.report_id, c.page_id, c.workspace_name, c.report_name, c.page_name, l.last_view_date,
       CAST(datediff('day', l.last_view_date, a.as_of) AS INTEGER) AS idle_days
FROM catalog c LEFT JOIN l ON l.workspace_id = c.workspace_id AND l.report_id = c.report_id
                          AND l.page_id = c.page_id, anchor a
WHERE l.last_view_date IS NULL OR datediff('day', l.last_view_date, a.as_of) >= 30""")
q("idle_reports", """
WITH l AS (SELECT workspace_id, report_id, MAX(view_date) AS last_view_date FROM pv, anchor
           WHERE view_date <= anchor.as_of GROUP BY workspace_id, report_id),
r AS (SELECT DISTINCT workspace_id, report_id, report_name FROM cat)
SELECT r.workspace_id, r.report_id, r.report_name, l.last_view_date,
       CAST(datediff('day', l.last_view_date, a.as_of) AS INTEGER) AS idle_days
FROM r LEFT JOIN l ON l.workspace_id = r.workspace_id AND l.report_id = r.report_id, anchor a
WHERE l.last_view_date IS NULL OR datediff('day', l.last_view_date, a.as_of) >= 30""")
q("power_users_per_report", """
SELECT workspace_id, report_id, user_id_hash, MAX(workspace_name) AS workspace_name, MAX(report_name) AS report_name,
       CAST(SUM(view_count) AS BIGINT) AS lifetime_page_views, CAST(SUM(distinct_pages_viewed) AS BIGINT) AS page_days,
       COUNT(DISTINCT view_date) AS active_days
FROM uv90 GROUP BY workspace_id, report_id, user_id_hash HAVING SUM(view_count) >= 50
ORDER BY lifetime_page_views DESC, workspace_id, report_id, user_id_hash LIMIT 50""")
q("power_users_count", """
SELECT COUNT(*) FILTER (WHERE v > 50) AS power_users
FROM (SELECT user_id_hash, SUM(view_count) AS v FROM uv90 GROUP BY user_id_hash)""")
q("user_kpis", """
SELECT COUNT(*) AS unique_users, AVG(p) AS avg_pages_per_user
FROM (SELECT user_id_hash, SUM(distinct_pages_viewed) AS p FROM uv90 GROUP BY user_id_hash)""")
q("top_users", """
SELECT user_id_hash, CAST(SUM(view_count) AS BIGINT) AS views FROM uv90 GROUP BY user_id_hash
ORDER BY views DESC, user_id_hash LIMIT 25""")
q("multi_page_user_share", """
SELECT AVG(CASE WHEN n > 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS multi_page_user_share
FROM (SELECT lower(user_upn) AS u, COUNT(DISTINCT workspace_id || '|' || report_id || '|' || page_id) AS n
      FROM ev, win WHERE ev.view_date BETWEEN win.lo AND win.hi GROUP BY lower(user_upn))""")
OWNERS = ("own AS (SELECT 'ws-' || CAST(n_regionkey AS VARCHAR) AS workspace_id, "
          "lower(n_name) || '@example.com' AS owner_upn, n_name AS owner_name FROM nation WHERE n_nationkey < 7)")
q("owner_accountability", f"""
WITH {OWNERS},
p AS (SELECT workspace_id, report_id, page_id, SUM(view_count) AS tv FROM pv90
      GROUP BY workspace_id, report_id, page_id)
SELECT o.owner_upn, o.owner_name,
       COUNT(DISTINCT p.workspace_id || '|' || p.report_id || '|' || p.page_id) FILTER (WHERE p.tv <= 10)
         AS underused_pages,
       COUNT(DISTINCT p.workspace_id || '|' || p.report_id) AS reports_owned,
       CAST(SUM(p.tv) AS BIGINT) AS total_views_owned,
       (SELECT COUNT(*) FROM unused u WHERE u.workspace_id IN
           (SELECT o2.workspace_id FROM own o2 WHERE o2.owner_upn = o.owner_upn AND o2.owner_name = o.owner_name))
         AS unused_pages
FROM own o JOIN p ON p.workspace_id = o.workspace_id
GROUP BY o.owner_upn, o.owner_name ORDER BY underused_pages DESC""")
q("resolve_known_users", """
SELECT v.user_id_hash, v.views, p.display_name
FROM (SELECT user_id_hash, CAST(SUM(view_count) AS BIGINT) AS views FROM uv90 GROUP BY user_id_hash) v
JOIN (SELECT substr(sha256(lower(trim(c_name || '@example.com'))), 1, 16) AS h, c_name AS display_name
      FROM customer) p ON p.h = v.user_id_hash""")
q("persona_enrichment", "SELECT * FROM top_persona")
q("workspace_owner_rls", f"""
SELECT {PV_COLS} FROM pv90 WHERE workspace_id IN (
  SELECT 'ws-' || CAST(n_regionkey AS VARCHAR) FROM nation
  WHERE n_nationkey < 7 AND lower(n_name) || '@example.com' = 'nation_0@example.com')""")
q("strip_identifying_names",
  "SELECT workspace_id, report_id, user_id_hash, view_date, view_count, distinct_pages_viewed FROM uv90")
q("retain_silver", f"SELECT {PV_COLS} FROM pv, anchor WHERE view_date >= anchor.as_of - 90")
q("forget_user", """
SELECT * FROM uv WHERE user_id_hash <> substr(sha256(lower('Customer#000000001@example.com')), 1, 16)""")
q("forget_user_stored", """
SELECT * FROM uv WHERE user_id_hash <> substr(sha256(lower('Customer#000000001@example.com')), 1, 16)""")
q("pii_guard", """
SELECT COUNT(*) FILTER (WHERE NOT regexp_full_match(user_id_hash, '([0-9a-f]{16})?')
                         OR contains(user_id_hash, '@')) AS violations,
       COUNT(*) AS rows_checked FROM uv""")
q("grain_check", """
SELECT 'page_views' AS table_name, (SELECT COUNT(*) FROM (SELECT 1 FROM pv
   GROUP BY workspace_id, report_id, page_id, view_date HAVING COUNT(*) > 1)) AS duplicate_keys
UNION ALL SELECT 'page_catalog', (SELECT COUNT(*) FROM (SELECT 1 FROM catalog
   GROUP BY workspace_id, report_id, page_id HAVING COUNT(*) > 1))
UNION ALL SELECT 'report_views', (SELECT COUNT(*) FROM (SELECT 1 FROM rv
   GROUP BY workspace_id, report_id, view_date HAVING COUNT(*) > 1))
UNION ALL SELECT 'user_views', (SELECT COUNT(*) FROM (SELECT 1 FROM uv
   GROUP BY workspace_id, report_id, user_id_hash, view_date HAVING COUNT(*) > 1))
UNION ALL SELECT 'unused_pages', (SELECT COUNT(*) FROM (SELECT 1 FROM unused
   GROUP BY workspace_id, report_id, page_id HAVING COUNT(*) > 1))""")
ROLLUP = """
WITH ru AS (SELECT workspace_id, MAX(workspace_name) AS workspace_name, MAX(capacity_name) AS capacity_name,
                   report_id, MAX(report_name) AS report_name, view_date,
                   CAST(SUM(view_count) AS BIGINT) AS view_count, MAX(unique_users) AS unique_users,
                   COALESCE(SUM(view_count * avg_dwell_seconds) / NULLIF(SUM(view_count), 0), 0.0)
                     AS avg_session_seconds
            FROM pv GROUP BY workspace_id, report_id, view_date)
"""
q("report_views_rollup", ROLLUP + "SELECT * FROM ru")
q("rollup_consistency", ROLLUP.rstrip() + """,
mx AS (SELECT workspace_id, report_id, view_date, MAX(view_count) AS max_page_views FROM pv
       GROUP BY workspace_id, report_id, view_date)
SELECT ru.workspace_id, ru.report_id, ru.view_date, ru.view_count, mx.max_page_views
FROM ru JOIN mx ON mx.workspace_id = ru.workspace_id AND mx.report_id = ru.report_id AND mx.view_date = ru.view_date
WHERE ru.view_count < mx.max_page_views""")
q("stale_catalog", """
SELECT workspace_id, report_id, MAX(catalog_pulled_at) AS last_pulled_at,
       CAST(datediff('day', CAST(MAX(catalog_pulled_at) AS DATE), anchor.as_of) AS INTEGER) AS days_since_pull,
       datediff('day', CAST(MAX(catalog_pulled_at) AS DATE), anchor.as_of) > 0 AS is_stale
FROM catalog, anchor GROUP BY workspace_id, report_id, anchor.as_of""")
DROP = """
m AS (SELECT run_date, {v}, median({v}) OVER (ORDER BY run_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)
             AS median_prev FROM runs)
SELECT run_date, {v}, CAST(median_prev AS DOUBLE) AS median_prev, {v} / median_prev::DOUBLE AS ratio,
       COALESCE({v} < median_prev * 0.5, false) AS flag FROM m"""
q("rows_drop_alert", """
WITH runs AS (SELECT CAST(l_shipdate AS DATE) AS run_date, COUNT(*) AS "rows" FROM lineitem GROUP BY 1),
""" + DROP.format(v='"rows"'))
q("dau_drop_alert", """
WITH runs AS (SELECT view_date AS run_date, COUNT(DISTINCT user_id_hash) AS dau FROM uv GROUP BY 1),
""" + DROP.format(v="dau"))
ERUNS = """
er AS (SELECT CAST(ts AS DATE) AS run_date, COUNT(*) AS reports,
              COUNT(*) FILTER (WHERE event_type = 'error') AS errors, MAX(ts) AS ended_at
       FROM events GROUP BY 1)"""
q("run_severity", "WITH " + ERUNS + """,
f AS (SELECT *, errors * 100 > reports * 22 AS failed FROM er),
i AS (SELECT *, SUM(CASE WHEN failed THEN 0 ELSE 1 END) OVER (ORDER BY run_date ROWS UNBOUNDED PRECEDING) AS isl,
             MAX(CASE WHEN NOT failed THEN ended_at END) OVER (ORDER BY run_date ROWS UNBOUNDED PRECEDING) AS last_ok
      FROM f),
c AS (SELECT *, CAST(SUM(CAST(failed AS INTEGER)) OVER (PARTITION BY isl ORDER BY run_date
                     ROWS UNBOUNDED PRECEDING) AS BIGINT) AS consecutive_failures,
             (epoch_us(ended_at) - epoch_us(last_ok)) / 3600000000.0::DOUBLE AS hours_since_ok FROM i)
SELECT run_date, reports, errors, failed, consecutive_failures, hours_since_ok,
       CASE WHEN consecutive_failures >= 4 OR COALESCE(hours_since_ok > 36, false) THEN 'SEV-1'
            WHEN consecutive_failures >= 2 OR errors * 100 > reports * 25 THEN 'SEV-2'
            WHEN failed THEN 'SEV-3' ELSE '' END AS severity
FROM c""")
q("run_scope_drop", """
WITH er AS (SELECT CAST(ts AS DATE) AS run_date, COUNT(*) AS reports, COUNT(DISTINCT user_id) AS workspaces FROM events GROUP BY 1),
p AS (SELECT *, LAG(reports) OVER (ORDER BY run_date) AS prev_reports,
             LAG(workspaces) OVER (ORDER BY run_date) AS prev_workspaces FROM er)
SELECT *, COALESCE(reports < prev_reports, false) OR COALESCE(workspaces < prev_workspaces, false) AS scope_dropped FROM p""")
_FEEDS = {"page_views": "pv", "page_catalog": "catalog", "report_views": "rv", "user_views": "uv"}


def _snapshot(feed: str, table: str) -> str:
    at = (lambda back: "" if feed == "page_catalog" else f"AND t.view_date = anchor.as_of - {back}")
    return f"""
SELECT '{feed}' AS feed, COALESCE(a.workspace_id, b.workspace_id) AS workspace_id,
       COALESCE(a.report_id, b.report_id) AS report_id, a.name_before, b.name_after,
       CASE WHEN b.name_after IS NULL THEN 'missing' WHEN a.name_before IS NULL THEN 'new'
            WHEN a.name_before <> b.name_after THEN 'renamed' ELSE 'same' END AS status
FROM (SELECT DISTINCT t.workspace_id, t.report_id, t.workspace_name AS name_before FROM {table} t, anchor
      WHERE true {at(1)}) a
FULL JOIN (SELECT DISTINCT t.workspace_id, t.report_id, CASE WHEN t.workspace_id = 'ws-1' THEN t.workspace_name || ' (new)'
                  ELSE t.workspace_name END AS name_after FROM {table} t, anchor WHERE true {at(0)}) b
  ON a.workspace_id = b.workspace_id AND a.report_id = b.report_id"""


q("bronze_snapshot_diff", " UNION ALL ".join(_snapshot(f, t) for f, t in _FEEDS.items()))
q("workspace_capacity", "SELECT workspace_id, workspace_name, capacity_name FROM ws")
q("active_workspaces", "SELECT 'Workspace' AS type, 'Active' AS state, * FROM ws")
q("standard_reports", """
SELECT DISTINCT workspace_id, report_id, report_name, 'PowerBIReport' AS report_type FROM cat""")
q("usage_dataset_per_workspace", """
SELECT workspace_id, dataset_id, dataset_name FROM (
  SELECT 'ws-' || CAST(n_regionkey AS VARCHAR) AS workspace_id, 'ds-' || CAST(n_nationkey AS VARCHAR) AS dataset_id,
         n_name AS dataset_name, ROW_NUMBER() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS rn
  FROM nation WHERE starts_with(n_name, 'NATION_2')) WHERE rn = 1""")
NB = """
SELECT w.workspace_name, CAST(COUNT(*) AS BIGINT) AS reports_skipped
FROM ws w JOIN (SELECT DISTINCT workspace_id, report_id FROM cat) r ON r.workspace_id = w.workspace_id
WHERE w.workspace_id NOT IN (SELECT 'ws-' || CAST(n_regionkey AS VARCHAR) FROM nation
                             WHERE starts_with(n_name, 'NATION_5'))
GROUP BY w.workspace_name"""
q("not_bootstrapped_workspaces", NB)
SUMMARY = f"""
WITH nb AS ({NB}),
failed AS (SELECT 'event ' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS scope, event_type AS error FROM events
           WHERE event_type = 'error' AND CAST(ts AS DATE) = (SELECT MAX(CAST(ts AS DATE)) FROM events)),
summary AS (
SELECT '1.2.0' AS schema_version, win.lo AS since, win.hi AS until,
       (SELECT COUNT(*) FROM ws) AS workspaces,
       (SELECT COUNT(*) FROM (SELECT DISTINCT report_id FROM cat)) AS reports,
       (SELECT COUNT(DISTINCT n_regionkey) FROM nation WHERE starts_with(n_name, 'NATION_5')) AS datasets,
       (SELECT COUNT(*) FROM pv90) AS page_view_rows, (SELECT COUNT(*) FROM catalog) AS page_catalog_rows,
       (SELECT COUNT(*) FROM rv90) AS report_view_rows, (SELECT COUNT(*) FROM uv90) AS user_view_rows,
       (SELECT COUNT(*) FROM unused) AS unused_pages,
       (SELECT COUNT(*) FROM (SELECT DISTINCT workspace_id, report_id FROM unused)) AS reports_with_unused_pages,
       (SELECT to_json(list(struct_pack(workspace_name := workspace_name, report_name := report_name,
                                        page_name := page_name, page_ordinal := page_ordinal)
                            ORDER BY workspace_name, report_name, page_ordinal, page_id, page_name))
        FROM (SELECT * FROM unused ORDER BY workspace_name, report_name, page_ordinal, page_id, page_name LIMIT 10))
         AS unused_pages_sample,
       (SELECT COUNT(*) FROM pv90) AS "rows",
       CAST((SELECT COALESCE(SUM(reports_skipped), 0) FROM nb) AS BIGINT) AS reports_skipped_no_bootstrap,
       (SELECT COALESCE(to_json(list(workspace_name ORDER BY workspace_name)), '[]')
        FROM (SELECT workspace_name FROM nb ORDER BY workspace_name LIMIT 100)) AS workspaces_not_bootstrapped,
       '[]' AS reports_without_catalog,
       (SELECT COUNT(*) FROM (SELECT DISTINCT report_id FROM cat) r
        WHERE report_id NOT IN (SELECT report_id FROM catalog)) AS n_reports_without_catalog,
       (SELECT COALESCE(to_json(list(struct_pack(scope := scope, error := error) ORDER BY scope, error)), '[]')
        FROM (SELECT * FROM failed ORDER BY scope, error LIMIT 100)) AS errors,
       (SELECT COUNT(*) FROM failed) AS n_errors, (SELECT COUNT(*) FROM failed) = 0 AS ok
FROM win)
"""
q("run_summary", SUMMARY + "SELECT * FROM summary")
q("run_metrics_json", SUMMARY + """
SELECT to_json(struct_pack(metric := 'leafstat.run', schema_version := schema_version, workspaces := workspaces,
                           reports := reports, datasets := datasets, "rows" := "rows", errors := n_errors, ok := ok)) AS line
FROM summary""")
q("run_metrics_gauges", SUMMARY + """
SELECT printf('leafstat_run_%s{schema_version="%s"} %d', g, schema_version, v) AS line FROM (
  SELECT 'workspaces' AS g, workspaces AS v, schema_version FROM summary
  UNION ALL SELECT 'reports', reports, schema_version FROM summary
  UNION ALL SELECT 'datasets', datasets, schema_version FROM summary
  UNION ALL SELECT 'rows', "rows", schema_version FROM summary
  UNION ALL SELECT 'errors', n_errors, schema_version FROM summary
  UNION ALL SELECT 'ok', CAST(ok AS BIGINT), schema_version FROM summary)""")
q("business_unit_rls", f"""
WITH members AS (
  SELECT 'BU-' || CAST(n_regionkey % 3 AS VARCHAR) AS unit, lower(n_name) || '@example.com' AS upn FROM nation
  UNION ALL SELECT 'BU-' || CAST(n_nationkey % 2 AS VARCHAR), lower(n_name) || '@example.com' FROM nation WHERE n_nationkey < 7)
SELECT {PV_COLS} FROM pv90 WHERE workspace_id IN (
  SELECT 'ws-' || CAST(r_regionkey AS VARCHAR) FROM region
  JOIN members ON unit = 'BU-' || CAST(r_regionkey % 3 AS VARCHAR) WHERE upn = 'nation_6@example.com')""")

# -- storage, payloads, gold -------------------------------------------------
RV_COLS = ("workspace_id, workspace_name, capacity_name, report_id, report_name, view_date, view_count, unique_users, "
           "avg_session_seconds")
UV_COLS = ("workspace_id, workspace_name, report_id, report_name, user_id_hash, view_date, view_count, distinct_pages_viewed")
_SILVER = {"page_views": (PV_COLS, "pv"), "page_catalog": (CAT_COLS, "catalog"), "report_views": (RV_COLS, "rv"),
           "user_views": (UV_COLS, "uv"), "unused_pages": (CAT_COLS, "unused")}
for _mode in ("csv", "parquet"):
    for _table, (_cols, _cte) in _SILVER.items():
        q(f"silver_{_mode}_roundtrip" + ("" if _table == "page_views" else f"_{_table}"), f"SELECT {_cols} FROM {_cte}")
_STALE = "CASE WHEN view_date < win.lo + 30 THEN view_count * 2 ELSE view_count END AS view_count"
for _table in ("page_views", "report_views", "user_views"):
    _cols, _cte = _SILVER[_table]
    q(f"upsert_{_table}", f"SELECT {_cols.replace('view_count', _STALE)} FROM {_cte}, win")
q("replace_page_catalog", f"SELECT {CAT_COLS} FROM catalog")
q("replace_unused_pages", "SELECT * FROM unused")
for _feed in _FEEDS:
    _cols, _cte = _SILVER[_feed]
    _upto = "true" if _feed == "page_catalog" else "view_date <= anchor.as_of - 1"
    q("write_bronze" + ("" if _feed == "page_views" else f"_{_feed}"), f"""
SELECT {_cols}, anchor.as_of - 1 AS dt FROM {_cte}, anchor WHERE {_upto}
UNION ALL
SELECT {_cols}, anchor.as_of AS dt FROM {_cte}, anchor""")
q("retain_bronze", f"SELECT {PV_COLS}, view_date AS dt FROM pv, anchor WHERE view_date >= anchor.as_of - 90")
q("export_unused_by_workspace", "SELECT * FROM unused")
q("table_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {c}) AS row_count" for t, (_, c) in _SILVER.items()))
q("read_catalog_sidecar", """
SELECT workspace_id, workspace_name, report_id, report_name, page_id, page_name, page_ordinal, report_total_pages
FROM catalog""")
q("flatten_usage_payload", """
SELECT report_id, page_name AS page_id, page_name, view_date, view_count, unique_users, avg_dwell_seconds FROM pv""")
q("flatten_report_payload", "SELECT report_id, view_date, view_count, unique_users, avg_session_seconds FROM rv")
q("flatten_user_payload", "SELECT report_id, user_id_hash, view_date, view_count, distinct_pages_viewed FROM uv")
q("corrupt_payloads", """
SELECT CAST((SELECT COUNT(*) FROM nation) AS BIGINT) AS corrupt, (SELECT COUNT(*) FROM rv) AS "rows" """)
q("catalog_from_pages_payload", f"SELECT {CAT_COLS} FROM catalog")
q("catalog_with_overlay", f"SELECT {CAT_COLS} FROM catalog")
q("kpi_page_usage_daily", """
SELECT workspace_id, report_id, page_id, view_date, CAST(SUM(view_count) AS BIGINT) AS views,
       CAST(SUM(unique_users) AS BIGINT) AS user_days,
       COALESCE(SUM(view_count * avg_dwell_seconds) / NULLIF(SUM(view_count), 0), 0.0) AS avg_dwell_weighted
FROM pv GROUP BY workspace_id, report_id, page_id, view_date""")
q("kpi_underused_pages", """
SELECT workspace_id, report_id, page_id, workspace_name, report_name, page_name, views
FROM pt WHERE views > 0 AND views < 100""")
q("kpi_long_report_engagement", """
WITH d AS (SELECT workspace_id, report_id, COUNT(*) AS pages_defined FROM catalog GROUP BY workspace_id, report_id),
o AS (SELECT workspace_id, report_id, page_ordinal, SUM(view_count) AS views FROM pv90
      GROUP BY workspace_id, report_id, page_ordinal),
c AS (SELECT *, SUM(views) OVER (PARTITION BY workspace_id, report_id ORDER BY page_ordinal) AS cum,
             SUM(views) OVER (PARTITION BY workspace_id, report_id) AS total FROM o),
r AS (SELECT workspace_id, report_id, SUM(CASE WHEN page_ordinal = 1 THEN views END) AS first_views,
             MAX(total) AS views,
             MIN(CASE WHEN cum / CAST(total AS DOUBLE) >= 0.80 THEN page_ordinal END) AS ord80
      FROM c GROUP BY workspace_id, report_id),
v AS (SELECT workspace_id, report_id, COUNT(DISTINCT page_id) AS pages_viewed FROM pv90 GROUP BY workspace_id, report_id)
SELECT d.workspace_id, d.report_id, d.pages_defined, CAST(COALESCE(v.pages_viewed, 0) AS BIGINT) AS pages_viewed,
       COALESCE(v.pages_viewed, 0) / d.pages_defined::DOUBLE AS coverage,
       CAST(COALESCE(r.views, 0) AS BIGINT) AS views,
       r.first_views / NULLIF(r.views, 0)::DOUBLE AS first_page_share,
       CAST(r.ord80 AS INTEGER) AS ordinal_reaching_80pct
FROM d LEFT JOIN v ON v.workspace_id = d.workspace_id AND v.report_id = d.report_id
LEFT JOIN r ON r.workspace_id = d.workspace_id AND r.report_id = d.report_id
WHERE d.pages_defined >= 30""")
q("dim_workspace", """
SELECT workspace_id, MAX(workspace_name) AS workspace_name, MAX(capacity_name) AS capacity_name
FROM pv GROUP BY workspace_id""")
q("dim_report", """
SELECT workspace_id, report_id, MAX(report_name) AS report_name, MAX(report_total_pages) AS report_total_pages
FROM pv GROUP BY workspace_id, report_id""")
DIM_PAGE = """
SELECT workspace_id, report_id, page_id, MAX(page_name) AS page_name, MAX(page_ordinal) AS page_ordinal
FROM pv GROUP BY workspace_id, report_id, page_id
UNION ALL
SELECT workspace_id, report_id, page_id, page_name, page_ordinal FROM catalog c
WHERE NOT EXISTS (SELECT 1 FROM pv WHERE pv.workspace_id = c.workspace_id AND pv.report_id = c.report_id AND pv.page_id = c.page_id)"""
q("dim_page", DIM_PAGE)
q("gold_dim_page_refreshed", DIM_PAGE)
q("dim_date", """
SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS iso_day_of_week
FROM (SELECT UNNEST(generate_series(CAST(MIN(view_date) AS TIMESTAMP), CAST(MAX(view_date) AS TIMESTAMP),
                                    INTERVAL 1 DAY)) AS d FROM pv)""")
q("fact_page_views", """
SELECT workspace_id, report_id, page_id, view_date AS date, view_count, unique_users, avg_dwell_seconds FROM pv""")
q("is_unused_flag", f"""
SELECT {CAT_COLS}, CASE WHEN EXISTS (SELECT 1 FROM unused u WHERE u.workspace_id = c.workspace_id
       AND u.report_id = c.report_id AND u.page_id = c.page_id) THEN 1 ELSE 0 END AS is_unused
FROM catalog c""")
q("page_key", "SELECT workspace_id, report_id, page_id, workspace_id || '|' || report_id || '|' || page_id AS page_key "
              "FROM catalog")
q("dashboard_payload", """
WITH meta AS (
  SELECT (SELECT MIN(view_date) FROM pv90) AS date_from, (SELECT MAX(view_date) FROM pv90) AS date_to,
         (SELECT COUNT(DISTINCT view_date) FROM pv90) AS days,
         (SELECT COUNT(DISTINCT workspace_id) FROM pv90) AS total_workspaces,
         (SELECT COUNT(*) FROM rsum) AS total_reports,
         (SELECT CAST(SUM(total_pages) AS BIGINT) FROM rsum) AS total_pages_defined,
         (SELECT CAST(SUM(pages_with_views) AS BIGINT) FROM rsum) AS total_pages_with_views,
         (SELECT CAST(SUM(pages_never_viewed) AS BIGINT) FROM rsum) AS total_pages_never_viewed,
         (SELECT CAST(SUM(view_count) AS BIGINT) FROM pv90) AS total_views, 100 AS underused_threshold,
         (SELECT COUNT(*) FROM pt WHERE views > 0 AND views < 100) AS underused_count,
         (SELECT COUNT(*) FROM miss) AS unused_count,
         (SELECT COUNT(*) FROM (SELECT DISTINCT workspace_id, report_id FROM miss)) AS unused_reports_count),
wsum AS (SELECT workspace_id, MAX(workspace_name) AS workspace_name, COUNT(DISTINCT report_id) AS report_count,
                COUNT(DISTINCT report_id || '|' || page_id) AS page_count,
                CAST(SUM(view_count) AS BIGINT) AS total_views FROM pv90 GROUP BY workspace_id),
buckets AS (
  SELECT CAST(b.bucket_order AS INTEGER) AS bucket_order, b.bucket, CAST(COUNT(a.v) AS BIGINT) AS pages
  FROM (VALUES (0, '0 (never)', 0, 0), (1, '1–10', 1, 10), (2, '11–50', 11, 50), (3, '51–200', 51, 200),
               (4, '201–1k', 201, 1000), (5, '1k–5k', 1001, 5000), (6, '5k+', 5001, 9223372036854775807))
       b(bucket_order, bucket, lo, hi)
  LEFT JOIN (SELECT views AS v FROM pt UNION ALL SELECT 0 FROM miss) a ON a.v BETWEEN b.lo AND b.hi
  GROUP BY b.bucket_order, b.bucket)
SELECT 'meta' AS section, to_json(m) AS json FROM meta m
UNION ALL SELECT 'workspace', to_json(w) FROM wsum w
UNION ALL SELECT 'report', to_json(r) FROM rsum r
UNION ALL SELECT 'page', to_json(d) FROM detail d
UNION ALL SELECT 'persona', to_json(t) FROM (
  SELECT workspace_id, report_id, top_persona AS persona, CAST(SUM(view_count) AS BIGINT) AS views
  FROM pv90 GROUP BY workspace_id, report_id, top_persona) t
UNION ALL SELECT 'day', to_json(t) FROM (SELECT view_date, CAST(SUM(view_count) AS BIGINT) AS views FROM pv90
                                        GROUP BY view_date) t
UNION ALL SELECT 'top_page', to_json(t) FROM (
  SELECT workspace_id, report_id, page_id, workspace_name, report_name, page_name, views
  FROM pt WHERE views > 0 ORDER BY views DESC, workspace_id, report_id, page_id LIMIT 25) t
UNION ALL SELECT 'underused_page', to_json(t) FROM (
  SELECT workspace_id, report_id, page_id, workspace_name, report_name, page_name, views
  FROM pt WHERE views > 0 AND views < 100 ORDER BY views, workspace_id, report_id, page_id LIMIT 200) t
UNION ALL SELECT 'unused_page', to_json(t) FROM (
  SELECT workspace_name, report_name, page_name, page_ordinal FROM miss) t
UNION ALL SELECT 'bucket', to_json(b) FROM buckets b""")

_Q["gold_page_usage_refreshed"] = _Q["kpi_page_usage_daily"]
_Q["gold_fact_refreshed"] = _Q["fact_page_views"]

# -- filters and unions ------------------------------------------------------
q("report_filter", f"SELECT {PV_COLS} FROM pv90 WHERE report_id = 'Brand#1'")
q("enrich_blank_identity", f"SELECT {PV_COLS} FROM pv90")
q("catalog_union", f"""
SELECT {CAT_COLS}, 'page_catalog' AS source FROM catalog
UNION ALL SELECT {CAT_COLS}, 'unused_pages' AS source FROM unused""")
q("as_of_max_date", "SELECT MAX(view_date) AS as_of FROM pv")
q("date_window", """
SELECT MAX(view_date) - 89 AS window_start, MAX(view_date) AS window_end, 90 AS window_days FROM pv""")
