"""Registered queries for analytics tables (A1–A16) and the data-driven estimator."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.operators import analytics as A
from roadpulse.operators import estimate as D
from roadpulse.functions.rounding import py_round_sql as prs
from roadpulse.registry.common import i64, load_scored, r6, register, with_scored

_N = "CAST(count(*) AS BIGINT) AS n"


@register("a1_cause_counts", with_scored(f"SELECT event_cause, {_N} FROM sc GROUP BY 1"))
def a1(spark, sf_dir):
    return A.cause_counts(load_scored(spark, sf_dir))


@register(
    "a1_cause_type_crosstab",
    with_scored(
        "SELECT event_cause, CAST(count(*) FILTER (WHERE event_type = 'planned') AS BIGINT) AS planned,"
        " CAST(count(*) FILTER (WHERE event_type = 'unplanned') AS BIGINT) AS unplanned FROM sc GROUP BY 1"
    ),
)
def a1b(spark, sf_dir):
    return A.cause_type_crosstab(load_scored(spark, sf_dir))


def _matrix_sql(where: str) -> str:
    days = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
    cols = ", ".join(f"CAST(count(*) FILTER (WHERE day_of_week = {i}) AS BIGINT) AS {d}" for i, d in enumerate(days))
    return with_scored(f"SELECT CAST(hour AS BIGINT) AS hour, {cols} FROM sc {where} GROUP BY hour")


@register("a2_hour_weekday_matrix", _matrix_sql(""))
def a2(spark, sf_dir):
    return A.hour_weekday_matrix(load_scored(spark, sf_dir))


@register("a2_hour_weekday_high", _matrix_sql("WHERE priority = 'High'"))
def a2h(spark, sf_dir):
    return A.hour_weekday_matrix(load_scored(spark, sf_dir), high_only=True)


@register(
    "a3_hourly_all",
    with_scored(
        f"SELECT CAST(h.hour AS BIGINT) AS hour, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM range(24) h(hour)"
        f" LEFT JOIN (SELECT hour, count(*) AS n FROM sc GROUP BY hour) c ON h.hour = c.hour"
    ),
)
def a3(spark, sf_dir):
    return A.hourly_series(load_scored(spark, sf_dir))


@register(
    "a3_hourly_top5_causes",
    with_scored(
        """SELECT t.event_cause, CAST(h.hour AS BIGINT) AS hour, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT event_cause FROM sc WHERE event_cause IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, event_cause LIMIT 5) t
CROSS JOIN range(24) h(hour)
LEFT JOIN (SELECT event_cause, hour, count(*) AS n FROM sc GROUP BY 1, 2) c ON c.event_cause = t.event_cause AND c.hour = h.hour"""
    ),
)
def a3c(spark, sf_dir):
    return A.hourly_series(load_scored(spark, sf_dir), by="event_cause", top=5)


@register(
    "a3_hourly_by_priority",
    with_scored(
        """SELECT t.priority, CAST(h.hour AS BIGINT) AS hour, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT DISTINCT priority FROM sc) t CROSS JOIN range(24) h(hour)
LEFT JOIN (SELECT priority, hour, count(*) AS n FROM sc GROUP BY 1, 2) c ON c.priority = t.priority AND c.hour = h.hour"""
    ),
)
def a3p(spark, sf_dir):
    return A.hourly_series(load_scored(spark, sf_dir), by="priority")


@register("a4_weekday_counts", with_scored(f"SELECT CAST(day_of_week AS BIGINT) AS day_of_week, {_N} FROM sc GROUP BY 1"))
def a4(spark, sf_dir):
    return A.weekday_counts(load_scored(spark, sf_dir))


@register("a5_top_corridors", with_scored(f"SELECT corridor, {_N} FROM sc GROUP BY 1 ORDER BY n DESC, corridor LIMIT 15"))
def a5(spark, sf_dir):
    return A.top_corridors(load_scored(spark, sf_dir))


@register(
    "a6_corridor_high_rate",
    with_scored(
        f"SELECT corridor, {r6('avg(priority_binary)')} AS high_rate, {_N} FROM sc GROUP BY 1 HAVING count(*) >= 10"
        " ORDER BY avg(priority_binary) DESC, corridor LIMIT 15"
    ),
)
def a6(spark, sf_dir):
    return A.corridor_high_rate(load_scored(spark, sf_dir))


def _share_sql(row: str, col: str) -> str:
    return with_scored(
        f"SELECT {row}, {col}, {_N}, {r6('count(*) / sum(count(*)) OVER (PARTITION BY ' + row + ')')} AS share FROM sc GROUP BY 1, 2"
    )


@register("a7_priority_share_by_cause", _share_sql("event_cause", "priority"))
def a7(spark, sf_dir):
    return A.row_share(load_scored(spark, sf_dir), "event_cause", "priority")


@register("a7_priority_share_by_type", _share_sql("event_type", "priority"))
def a7t(spark, sf_dir):
    return A.row_share(load_scored(spark, sf_dir), "event_type", "priority")


def _hist_sql(bins: int, group: str | None) -> str:
    gsel = f"{group}, " if group else ""
    gby = f"GROUP BY {group}" if group else ""
    on = f"v.{group} = r.{group}" if group else "TRUE"
    cjoin = f" AND c.{group} = s.{group}" if group else ""
    w = f"((s.hi - s.lo) / {bins})"
    return with_scored(
        f"""SELECT {('s.' + group + ', ') if group else ''}CAST(s.bin AS BIGINT) AS bin, {r6('s.lo + s.bin * ' + w)} AS bin_lo,
  {r6('CASE WHEN s.bin = ' + str(bins - 1) + ' THEN s.hi ELSE s.lo + (s.bin + 1) * ' + w + ' END')} AS bin_hi,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT r.*, b.bin FROM r CROSS JOIN range({bins}) b(bin)) s
LEFT JOIN (
  SELECT {gsel}bin, count(*) AS n FROM (
    SELECT {('v.' + group + ', ') if group else ''}CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor((v.log_hours - r.lo) / (r.hi - r.lo) * {bins}), {bins - 1}) END AS BIGINT) AS bin
    FROM v JOIN r ON {on}) {('GROUP BY ' + group + ', bin') if group else 'GROUP BY bin'}
) c ON c.bin = s.bin{cjoin}""",
        """v AS (SELECT *, ln(1 + resolution_hours) AS log_hours FROM sc WHERE resolution_hours IS NOT NULL AND resolution_hours > 0 AND resolution_hours < 200)""",
        f"""r AS (SELECT {gsel}min(log_hours) AS lo, max(log_hours) AS hi FROM v {gby})""",
    )


def _hist(spark, sf_dir, bins, group=None):
    return A.histogram(A.valid_durations(load_scored(spark, sf_dir)), "log_hours", bins, group)


@register("a8_duration_histogram", _hist_sql(50, None))
def a8(spark, sf_dir):
    return _hist(spark, sf_dir, 50)


@register("a8_histogram_by_priority", _hist_sql(40, "priority"))
def a8p(spark, sf_dir):
    return _hist(spark, sf_dir, 40, "priority")


@register("a8_histogram_by_type", _hist_sql(40, "event_type"))
def a8t(spark, sf_dir):
    return _hist(spark, sf_dir, 40, "event_type")


@register(
    "a9_box_stats_top_causes",
    with_scored(
        f"""SELECT event_cause, {r6('q1')} AS q1, {r6('median')} AS median, {r6('q3')} AS q3,
  {r6('min(CASE WHEN h >= q1 - 1.5 * (q3 - q1) THEN h END)')} AS whisker_lo,
  {r6('max(CASE WHEN h <= q3 + 1.5 * (q3 - q1) THEN h END)')} AS whisker_hi,
  CAST(count(*) FILTER (WHERE h < q1 - 1.5 * (q3 - q1) OR h > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers, {_N}
FROM (SELECT v.event_cause, v.resolution_hours AS h, q.q1, q.median, q.q3 FROM v JOIN q ON v.event_cause = q.event_cause)
GROUP BY event_cause, q1, median, q3""",
        """v0 AS (SELECT * FROM sc WHERE resolution_hours IS NOT NULL AND resolution_hours > 0 AND resolution_hours < 200)""",
        """top8 AS (SELECT event_cause FROM v0 WHERE event_cause IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, event_cause LIMIT 8)""",
        """v AS (SELECT v0.* FROM v0 JOIN top8 ON v0.event_cause = top8.event_cause)""",
        """q AS (SELECT event_cause, quantile_cont(resolution_hours, 0.25) AS q1, quantile_cont(resolution_hours, 0.5) AS median,
                   quantile_cont(resolution_hours, 0.75) AS q3 FROM v GROUP BY 1)""",
    ),
)
def a9(spark, sf_dir):
    return A.box_stats(A.valid_durations(load_scored(spark, sf_dir)), "resolution_hours", "event_cause", 8)


@register(
    "a10_closure_rate_by_cause",
    with_scored(f"SELECT event_cause, {r6('avg(road_closure_binary)')} AS closure_rate, {_N} FROM sc GROUP BY 1 HAVING avg(road_closure_binary) > 0"),
)
def a10(spark, sf_dir):
    return A.closure_rate_by_cause(load_scored(spark, sf_dir))


@register(
    "a10_daily_closures",
    with_scored("SELECT strftime(CAST(start_local AS DATE), '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS closures FROM sc WHERE road_closure_binary = 1 GROUP BY 1"),
)
def a10d(spark, sf_dir):
    return A.daily_closures(load_scored(spark, sf_dir))


@register("a11_zone_stats", with_scored(f"SELECT zone, {_N}, {r6('avg(priority_binary)')} AS high_rate FROM sc WHERE zone <> 'unknown' GROUP BY 1"))
def a11(spark, sf_dir):
    return A.zone_stats(load_scored(spark, sf_dir))


@register(
    "a12_planned_vs_unplanned",
    with_scored(
        f"""SELECT event_type, event_cause, CAST(n AS BIGINT) AS n, {r6('closure_rate')} AS closure_rate, {r6('share')} AS share, CAST(rank AS BIGINT) AS rank
FROM (SELECT *, n / sum(n) OVER (PARTITION BY event_type) AS share,
             row_number() OVER (PARTITION BY event_type ORDER BY n DESC, event_cause) AS rank
      FROM (SELECT event_type, event_cause, count(*) AS n, avg(road_closure_binary) AS closure_rate FROM sc GROUP BY 1, 2))
WHERE rank <= 8"""
    ),
)
def a12(spark, sf_dir):
    return A.planned_vs_unplanned(load_scored(spark, sf_dir))


@register(
    "a13_kpis",
    with_scored(
        f"""SELECT CAST(count(*) AS BIGINT) AS total_events, CAST(sum(is_planned) AS BIGINT) AS planned_events,
  {r6('avg(priority_binary)')} AS high_share, CAST(sum(road_closure_binary) AS BIGINT) AS closures,
  CAST(count(DISTINCT event_cause) AS BIGINT) AS distinct_causes, CAST(count(DISTINCT corridor) AS BIGINT) AS distinct_corridors FROM sc"""
    ),
)
def a13(spark, sf_dir):
    return A.kpis(load_scored(spark, sf_dir))


@register("a14_priority_cause_counts", with_scored(f"SELECT priority, event_cause, {_N} FROM sc GROUP BY 1, 2"))
def a14(spark, sf_dir):
    return A.counts_by(load_scored(spark, sf_dir), "priority", "event_cause")


@register(
    "a15_filtered_slice",
    with_scored(
        f"""SELECT CAST(count(*) AS BIGINT) AS events, {r6('avg(priority_binary)')} AS high_share,
  {r6('avg(road_closure_binary)')} AS closure_rate, {r6('avg(resolution_hours)')} AS mean_resolution_hours
FROM sc WHERE event_cause IN ('accident', 'construction', 'protest') AND priority IN ('High') AND event_type IN ('unplanned')"""
    ),
)
def a15(spark, sf_dir):
    return A.filtered_slice(load_scored(spark, sf_dir), ["accident", "construction", "protest"], ["High"], ["unplanned"])


@register(
    "a16_map_sample",
    with_scored("SELECT id, event_cause FROM sc ORDER BY md5(id || '#42'), id LIMIT 3000"),
)
def a16(spark, sf_dir):
    return A.map_sample(load_scored(spark, sf_dir), 3000).select("id", "event_cause")


# ---------------------------------------------------------------------------
# Estimator
# ---------------------------------------------------------------------------

CTE_CAUSE_STATS = """cs AS (
  SELECT r.event_cause, r.severity_rate, r.closure_rate, d.avg_duration, d.median_duration, d.p10_duration, d.p90_duration
  FROM (SELECT event_cause, avg(priority_binary) AS severity_rate, avg(road_closure_binary) AS closure_rate
        FROM sc WHERE event_cause IS NOT NULL GROUP BY 1) r
  LEFT JOIN (SELECT event_cause, avg(resolution_hours) AS avg_duration, quantile_cont(resolution_hours, 0.5) AS median_duration,
                    quantile_cont(resolution_hours, 0.1) AS p10_duration, quantile_cont(resolution_hours, 0.9) AS p90_duration
             FROM sc WHERE resolution_hours IS NOT NULL AND resolution_hours > 0 AND event_cause IS NOT NULL GROUP BY 1) d
  ON r.event_cause = d.event_cause
),
cor AS (SELECT corridor, avg(priority_binary) AS corridor_severity_rate FROM sc WHERE corridor IS NOT NULL GROUP BY 1),
rs AS (SELECT avg(CASE WHEN hour IN (8, 9, 10, 17, 18, 19, 20) THEN priority_binary END) AS rush_severity_rate,
              avg(CASE WHEN hour NOT IN (8, 9, 10, 17, 18, 19, 20) THEN priority_binary END) AS nonrush_severity_rate FROM sc)"""


@register(
    "d1_cause_stats",
    with_scored(
        f"""SELECT event_cause, {r6('severity_rate')} AS severity_rate, {r6('closure_rate')} AS closure_rate, {r6('avg_duration')} AS avg_duration,
  {r6('median_duration')} AS median_duration, {r6('p10_duration')} AS p10_duration, {r6('p90_duration')} AS p90_duration FROM cs""",
        CTE_CAUSE_STATS,
    ),
)
def d1(spark, sf_dir):
    return D.cause_stats(load_scored(spark, sf_dir))


@register("d2_corridor_severity", with_scored(f"SELECT corridor, {r6('corridor_severity_rate')} AS corridor_severity_rate FROM cor", CTE_CAUSE_STATS))
def d2(spark, sf_dir):
    return D.corridor_stats(load_scored(spark, sf_dir))


@register("d2_rush_rates", with_scored(f"SELECT {r6('rush_severity_rate')} AS rush_severity_rate, {r6('nonrush_severity_rate')} AS nonrush_severity_rate FROM rs", CTE_CAUSE_STATS))
def d2r(spark, sf_dir):
    return D.rush_stats(load_scored(spark, sf_dir))


CTE_EST = """est0 AS (
  SELECT sc.id, sc.corridor, sc.latitude, sc.longitude, sc.is_rush_hour <> 0 AS rush, sc.is_weekend <> 0 AS wk, sc.requires_road_closure AS req,
    0.6e0 * coalesce(cs.severity_rate, 0.5e0) + 0.25e0 * coalesce(cor.corridor_severity_rate, 0.5e0) AS base,
    coalesce(rs.rush_severity_rate, 0.65e0) AS rsev, coalesce(rs.nonrush_severity_rate, 0.55e0) AS nsev,
    coalesce(cs.avg_duration, 2.0e0) AS duration_mean, coalesce(cs.median_duration, 1.5e0) AS med,
    coalesce(cs.p10_duration, 0.3e0) AS p10, coalesce(cs.p90_duration, 10.0e0) AS p90, coalesce(cs.closure_rate, 0.1e0) AS crate
  FROM sc LEFT JOIN cs ON sc.event_cause = cs.event_cause LEFT JOIN cor ON sc.corridor = cor.corridor CROSS JOIN rs
),
est1 AS (
  SELECT *,
    CASE WHEN rush THEN base + 0.15e0 * (greatest(0.0e0, rsev - nsev) / greatest(nsev, 0.01e0)) ELSE base END AS s1,
    med * CASE WHEN rush THEN 1.25e0 ELSE 1.0e0 END * CASE WHEN wk THEN 0.9e0 ELSE 1.0e0 END AS duration_p50,
    p10 * CASE WHEN rush THEN 1.15e0 ELSE 1.0e0 END AS duration_p10,
    p90 * CASE WHEN rush THEN 1.3e0 ELSE 1.0e0 END AS duration_p90,
    CASE WHEN req THEN greatest(crate, 0.85e0) ELSE crate END AS c1
  FROM est0
),
est AS (
  SELECT *,
    greatest(0.01e0, least(0.99e0, CASE WHEN req THEN least(0.99e0, s2 + 0.1e0) ELSE s2 END)) AS severity_proba,
    CASE WHEN rush THEN least(0.99e0, c1 * 1.15e0) ELSE c1 END AS closure_proba
  FROM (SELECT *, CASE WHEN wk THEN s1 * 0.95e0 ELSE s1 END AS s2 FROM est1)
)"""


@register(
    "d3_d5_estimates",
    with_scored(
        f"""SELECT id, {r6('severity_proba')} AS severity_proba, CASE WHEN severity_proba > 0.5 THEN 'High' ELSE 'Low' END AS severity,
  {r6('duration_mean')} AS duration_mean, {r6('duration_p50')} AS duration_p50, {r6('duration_p10')} AS duration_p10,
  {r6('duration_p10 * 1.5e0')} AS duration_p25, {r6('duration_p90 * 0.6e0')} AS duration_p75, {r6('duration_p90')} AS duration_p90,
  {r6('closure_proba')} AS closure_proba, {i64('req OR closure_proba > 0.5')} AS closure_needed
FROM est""",
        CTE_CAUSE_STATS, CTE_EST,
    ),
)
def d3(spark, sf_dir):
    s = load_scored(spark, sf_dir)
    base = s.select("id", "event_cause", "corridor", "is_rush_hour", "is_weekend", "requires_road_closure", "latitude", "longitude")
    e = D.estimate(base, s)
    return e.select(
        "id", "severity_proba", "severity", "duration_mean", "duration_p50", "duration_p10", "duration_p25",
        "duration_p75", "duration_p90", "closure_proba", "closure_needed",
    )


@register(
    "d6_corridor_defaults",
    with_scored(
        """SELECT z.corridor, z.default_zone, coalesce(j.default_junction, 'unknown') AS default_junction FROM
  (SELECT corridor, arg_min(zone, (-n, zone)) AS default_zone FROM (SELECT corridor, zone, count(*) AS n FROM sc WHERE corridor IS NOT NULL AND zone IS NOT NULL GROUP BY 1, 2) GROUP BY 1) z
LEFT JOIN
  (SELECT corridor, arg_min(junction, (-n, junction)) AS default_junction FROM (SELECT corridor, junction, count(*) AS n FROM sc
     WHERE corridor IS NOT NULL AND junction IS NOT NULL AND junction <> 'unknown' GROUP BY 1, 2) GROUP BY 1) j
ON z.corridor = j.corridor"""
    ),
)
def d6(spark, sf_dir):
    return D.corridor_defaults(load_scored(spark, sf_dir))


@register(
    "d7_representative_coords",
    with_scored(
        f"""SELECT corridor, junction, {r6('arg_min(latitude, (start_us, id))')} AS rep_lat, {r6('arg_min(longitude, (start_us, id))')} AS rep_lng
FROM sc WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2"""
    ),
)
def d7(spark, sf_dir):
    return D.representative_coords(load_scored(spark, sf_dir))


def _spill_sql() -> str:
    from roadpulse.registry.common import hav

    return f"""SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY delay_mins DESC, spill_corridor) AS rank FROM (
    SELECT *, severity_proba * duration_p50 * 30.0e0 / (distance_km + 1.0e0) AS delay_mins FROM (
      SELECT i.id, c.corridor AS spill_corridor, i.severity_proba, i.duration_p50,
             {hav('i.latitude', 'i.longitude', 'c.c_lat', 'c.c_lng')} AS distance_km
      FROM sc i JOIN cen c ON c.corridor <> coalesce(i.corridor, '')
      WHERE i.latitude IS NOT NULL AND i.longitude IS NOT NULL))
  WHERE delay_mins >= 3.0 AND distance_km <= 15.0)
WHERE rank <= 5"""


CTE_CEN = f"""cen AS (SELECT corridor, {prs('a_lat', D.CENTROID_DIGITS)} AS c_lat, {prs('a_lng', D.CENTROID_DIGITS)} AS c_lng FROM (
  SELECT corridor, avg(latitude) AS a_lat, avg(longitude) AS a_lng FROM sc
  WHERE corridor NOT IN ('Non-corridor', 'unknown') AND latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1))"""


@register(
    "d8_spillover",
    with_scored(
        f"SELECT id, spill_corridor, {r6('distance_km')} AS distance_km, {r6('delay_mins')} AS delay_mins, CAST(rank AS BIGINT) AS rank FROM ({_spill_sql()})",
        CTE_CEN,
    ),
)
def d8(spark, sf_dir):
    s = load_scored(spark, sf_dir)
    return D.spillover(s, D.corridor_centroids(s))


@register(
    "d8_spillover_rollup",
    with_scored(
        f"""SELECT id, CAST(count(*) AS BIGINT) AS impacted_corridors, {r6('max(delay_mins)')} AS max_delay_mins,
  {r6('sum(delay_mins)')} AS total_network_delay_mins FROM ({_spill_sql()}) GROUP BY id""",
        CTE_CEN,
    ),
)
def d8r(spark, sf_dir):
    s = load_scored(spark, sf_dir)
    return D.spillover_rollup(D.spillover(s, D.corridor_centroids(s)))
