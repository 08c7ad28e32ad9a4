"""Independent DuckDB SQL for every registered query (``__spark_entry__.oracle_sql``).

The SQL re-derives each answer from the base tables with DuckDB's own functions (regexes,
``TRY_CAST``, ``round_even``, ``QUALIFY``); only the fixed values are shared with the library.
"""

from __future__ import annotations

from hydrocal.plans.demos import EVENTS_MONTH, EVENTS_RUN_TS, EVENTS_YEAR, ORDERS_RUN_TS, SEA_WATER_DENSITY
from hydrocal.schemas import (
    DRY_COMMENT,
    FEET_TO_METRES,
    HPA_TO_PSI,
    NA_TOKENS,
    REASON_BAD_DATETIME,
    REASON_CSV_EMPTY,
    REASON_EMPTY_FILE,
    REASON_BAD_NUMERIC,
    REASON_MISSING_FILE,
    REASON_NEGATIVE,
    REASON_STALE_PREFIX,
    SENSOR_FACTOR,
)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def parse_ts(expr: str) -> str:
    """Day-first parse of a text expression with a four-digit year -> TIMESTAMP or NULL."""
    return f"(CASE WHEN regexp_matches({expr}, '/[0-9]{{4}}\\s') THEN try_strptime({expr}, '%d/%m/%Y %H:%M:%S') END)"


def parse_dt(date_expr: str, time_expr: str) -> str:
    return parse_ts(f"({date_expr} || ' ' || {time_expr})")


def to_num(expr: str) -> str:
    """Text -> DOUBLE; NA tokens, float suffixes, errors and NaN -> NULL."""
    na = ", ".join(q(t) for t in NA_TOKENS)
    t = f"trim({expr})"
    v = f"TRY_CAST({t} AS DOUBLE)"
    return (
        f"(CASE WHEN {t} NOT IN ({na}) AND NOT regexp_matches({t}, '(?i)[0-9.][df]\\s*$') "
        f"AND NOT isnan({v}) THEN {v} END)"
    )


def round2(expr: str) -> str:
    return f"(round_even(({expr}) * 100.0::DOUBLE, 0) / 100.0::DOUBLE)"


def d(x: float) -> str:
    """DOUBLE literal."""
    return f"{x!r}::DOUBLE"


def raw_depth(level: str, ctype: str) -> str:
    return round2(
        f"CASE WHEN {ctype} = 'divide_by_100' THEN {level} / 100.0::DOUBLE ELSE {level} * {d(FEET_TO_METRES)} END"
    )


def adj_depth(raw: str, baro: str, bom: str, sg: float = 1.0) -> str:
    return round2(f"{raw} + {d(SENSOR_FACTOR)} * (({baro} - {bom}) * {d(HPA_TO_PSI)}) / {d(sg)}")


def file_stem(path: str) -> str:
    name = f"regexp_extract({path}, '([^/]*)$', 1)"
    stem = f"regexp_extract({name}, '^(\\.*[^.].*)\\.[^.]*$', 1)"
    return f"(CASE WHEN {stem} = '' THEN {name} ELSE {stem} END)"


def ts_text(ts: str) -> str:
    return f"strftime({ts}, '%d/%m/%Y %H:%M:%S')"


def run(ts: str) -> str:
    return f"TIMESTAMP '{ts}'"


def reason(reason_sql: str, run_ts: str) -> str:
    return f"({reason_sql} || ' on ' || {ts_text(run(run_ts))})"


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

# --- stand-in inputs (same rendering rules as hydrocal.sources.standins) -------------------------

READINGS = f"""
readings AS (
  SELECT CAST(user_id AS VARCHAR) AS site, ts, value AS level_ft,
         985.0::DOUBLE + 0.4::DOUBLE * {K} AS baro_hpa, '' AS comment,
         CAST(user_id AS VARCHAR) || '.csv' AS src_file
  FROM events WHERE event_type <> 'signup')"""

DAILY = """
daily AS (
  SELECT * FROM readings
  QUALIFY row_number() OVER (PARTITION BY site, CAST(ts AS DATE)
    ORDER BY ts NULLS LAST, src_file NULLS LAST, level_ft NULLS LAST, baro_hpa NULLS LAST, comment NULLS LAST) = 1)"""

WEATHER = f"""
weather AS (
  SELECT strftime(ts, '%d/%m/%Y') AS date_text, strftime(ts, '%H:%M:%S') AS time_text,
         CAST(990.0::DOUBLE + value / 10.0::DOUBLE AS VARCHAR) AS hpa_text
  FROM events WHERE event_type = 'signup'),
wparsed AS (
  SELECT {parse_dt('date_text', 'time_text')} AS ts, {to_num('hpa_text')} AS bom_hpa FROM weather),
baro AS (
  SELECT CAST(ts AS DATE) AS day, bom_hpa FROM wparsed
  WHERE ts IS NOT NULL AND bom_hpa IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts NULLS LAST, bom_hpa NULLS LAST) = 1)"""

CFG = """
docs AS (
  SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS site,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL
              WHEN c_mktsegment = 'MACHINERY' THEN 'divide_by_100'
              WHEN c_mktsegment = 'AUTOMOBILE' THEN 'metres' ELSE 'default' END AS t,
         c_mktsegment
  FROM customer),
docs_json AS (
  SELECT c_custkey,
         CASE WHEN t IS NULL THEN json_object(site, 'n/a')
              ELSE json_object(site, json_object('depth_conversion_type', t)) END AS doc
  FROM docs),
cfg_all AS (
  SELECT c_custkey, key AS site,
         coalesce(json_extract_string(doc, '$."' || key || '".depth_conversion_type'), 'default')
           AS depth_conversion_type
  FROM docs_json, unnest(json_keys(doc)) AS u(key)),
cfg AS (SELECT site, depth_conversion_type FROM cfg_all)"""


def raw_rendering(with_id: bool = False) -> str:
    idc = "event_id, " if with_id else ""
    return f"""
ev AS (SELECT *, {K} AS k FROM events WHERE event_type <> 'signup'),
raw AS (
  SELECT {idc}CAST(user_id AS VARCHAR) || '.csv' AS src_file,
    CASE WHEN event_type = 'error' THEN strftime(ts, '%d/%m/%y')
         WHEN k BETWEEN 20 AND 29 THEN strftime(ts, '%-d/%-m/%Y')
         ELSE strftime(ts, '%d/%m/%Y') END AS date_text,
    CASE WHEN k BETWEEN 20 AND 29 THEN strftime(ts, '%-H:%-M:%-S') ELSE strftime(ts, '%H:%M:%S') END AS time_text,
    CASE WHEN k < 5 THEN '---'
         WHEN k < 8 THEN CAST(value AS VARCHAR) || 'd'
         WHEN k BETWEEN 10 AND 11 THEN '-' || CAST(value AS VARCHAR)
         WHEN k BETWEEN 30 AND 34 THEN printf('%.6e', value)
         ELSE CAST(value AS VARCHAR) END AS level_text,
    CASE WHEN k BETWEEN 8 AND 9 THEN '' ELSE CAST(985.0::DOUBLE + 0.4::DOUBLE * k AS VARCHAR) END AS baro_text
  FROM ev),
tagged AS (
  SELECT *, CASE WHEN ts IS NULL THEN 1 WHEN level_ft IS NULL OR baro_hpa IS NULL THEN 2
                 WHEN level_ft < 0 THEN 3 ELSE 4 END AS stage
  FROM (SELECT {idc}src_file, {file_stem('src_file')} AS site, {parse_dt('date_text', 'time_text')} AS ts,
               {to_num('level_text')} AS level_ft, {to_num('baro_text')} AS baro_hpa
        FROM raw))"""


def stage_reason(col: str) -> str:
    return (
        f"CASE WHEN {col} = 1 THEN {q(REASON_BAD_DATETIME)} WHEN {col} = 2 THEN {q(REASON_BAD_NUMERIC)} "
        f"WHEN {col} = 3 THEN {q(REASON_NEGATIVE)} END"
    )


def validation_ctes(run_ts: str) -> str:
    """CTEs ending in ``final`` for the full validation of the rendered events."""
    r = run(run_ts)
    stale_reason = reason(f"{q(REASON_STALE_PREFIX + ' ')} || strftime({r}, '%B %Y')", run_ts)
    return f"""WITH {raw_rendering()},
{WEATHER},
{CFG},
outcomes AS (
  SELECT src_file, site, max(stage) AS max_stage,
         count(*) FILTER (WHERE stage = 1) AS n_bad_datetime,
         count(*) FILTER (WHERE stage = 2) AS n_bad_numeric,
         count(*) FILTER (WHERE stage = 3) AS n_negative,
         count(*) FILTER (WHERE stage = 4) AS n_kept
  FROM tagged GROUP BY src_file, site),
candidates AS (
  SELECT site, ts, level_ft, baro_hpa, '' AS comment, src_file, CAST(NULL AS VARCHAR) AS flag
  FROM tagged WHERE stage = 4
  UNION ALL
  SELECT site, CAST(CAST({r} AS DATE) AS TIMESTAMP), NULL, NULL, {reason(stage_reason('max_stage'), run_ts)},
         src_file, 'placeholder'
  FROM outcomes WHERE max_stage < 4
  UNION ALL
  SELECT site, CAST(CAST({r} AS DATE) AS TIMESTAMP), NULL, NULL, {reason(q(REASON_MISSING_FILE), run_ts)},
         NULL, 'placeholder'
  FROM (SELECT DISTINCT site FROM cfg WHERE site NOT IN (SELECT site FROM outcomes))),
dd AS (
  SELECT * FROM candidates
  QUALIFY row_number() OVER (PARTITION BY site, CAST(ts AS DATE)
    ORDER BY ts NULLS LAST, src_file NULLS LAST, level_ft NULLS LAST, baro_hpa NULLS LAST, comment NULLS LAST) = 1),
conv AS (
  SELECT dd.*, {raw_depth('dd.level_ft', "coalesce(cfg.depth_conversion_type, 'default')")} AS depth_raw_m
  FROM dd LEFT JOIN cfg ON dd.site = cfg.site),
withbaro AS (
  SELECT conv.*, baro.bom_hpa FROM conv LEFT JOIN baro ON CAST(conv.ts AS DATE) = baro.day),
latest AS (
  SELECT site, max(ts) FILTER (WHERE NOT starts_with(coalesce(comment, ''), 'Placeholder:')) AS latest_ts
  FROM withbaro GROUP BY site),
stale_sites AS (SELECT site FROM latest WHERE latest_ts < {r} - INTERVAL 2 MONTH),
kept AS (
  SELECT * FROM withbaro
  WHERE site NOT IN (SELECT site FROM stale_sites) OR starts_with(coalesce(comment, ''), 'Placeholder:')),
stale_ph AS (
  SELECT site, CAST(CAST({r} AS DATE) AS TIMESTAMP) AS ts, CAST(NULL AS DOUBLE) AS level_ft,
         CAST(NULL AS DOUBLE) AS baro_hpa, {stale_reason} AS comment, CAST(NULL AS VARCHAR) AS src_file,
         'placeholder' AS flag, CAST(NULL AS DOUBLE) AS depth_raw_m, CAST(NULL AS DOUBLE) AS bom_hpa
  FROM stale_sites),
dry AS (
  SELECT site, ts, level_ft, baro_hpa,
         CASE WHEN depth_raw_m <= 0 AND coalesce(comment, '') = '' THEN {q(DRY_COMMENT)} ELSE comment END AS comment,
         src_file,
         CASE WHEN depth_raw_m <= 0 AND coalesce(comment, '') = '' THEN 'dry' ELSE flag END AS flag,
         depth_raw_m, bom_hpa
  FROM kept
  UNION ALL SELECT * FROM stale_ph),
final AS (
  SELECT site, ts, bom_hpa, baro_hpa, depth_raw_m, {adj_depth('depth_raw_m', 'baro_hpa', 'bom_hpa')} AS depth_adj_m,
         coalesce(comment, '') AS comment, flag, level_ft, src_file
  FROM dry)
"""


REPORT_TS = "strftime(ts, '%d/%m/%Y %I:%M:%S %p')"


def _sql() -> dict[str, str]:
    run_ev = run(EVENTS_RUN_TS)
    run_or = run(ORDERS_RUN_TS)
    out: dict[str, str] = {}

    out["first_per_site_day"] = f"WITH {READINGS},{DAILY} SELECT site, ts, level_ft, baro_hpa, comment, src_file FROM daily"
    out["stream_first_per_site_day"] = out["first_per_site_day"]
    out["first_per_day"] = f"WITH {WEATHER} SELECT day, bom_hpa FROM baro"
    out["join_daily_baro"] = (
        f"WITH {READINGS},{DAILY},{WEATHER} SELECT site, ts, level_ft, baro_hpa, bom_hpa "
        "FROM daily LEFT JOIN baro ON CAST(daily.ts AS DATE) = baro.day"
    )
    out["baro_absent"] = (
        f"WITH {READINGS},{DAILY},"
        "tables AS (SELECT regexp_extract(html, '(?i)<table\\b[^>]*?\\bclass\\s*=\\s*(?:\"(?:[^\"]*\\s)?data(?:\\s[^\"]*)?\"|''(?:[^'']*\\s)?data(?:\\s[^'']*)?''|data[\\s>])', 0) AS t FROM pages), "
        "nfeed AS (SELECT count(*) FILTER (WHERE t <> '') AS n FROM tables) "
        "SELECT site, ts, level_ft, baro_hpa, CAST(NULL AS DOUBLE) AS bom_hpa FROM daily, nfeed WHERE nfeed.n = 0"
    )
    hourly = lambda odd, name: (
        f"SELECT event_id, CAST(user_id AS VARCHAR) AS site, strftime(ts, '%d/%m/%Y') AS date_text, "
        f"strftime(ts, '%H') || ':00:00' AS time_text, CAST(value AS VARCHAR) AS {name} "
        f"FROM events WHERE event_id % 2 = {odd}"
    )
    out["merge_level_baro"] = (
        f"WITH lvl AS ({hourly('0', 'level_text')}), b AS ({hourly('1', 'baro_text')}) "
        f"SELECT lvl.event_id, lvl.site, lvl.date_text, lvl.time_text, {to_num('lvl.level_text')} AS level_ft, "
        f"{to_num('b.baro_text')} AS baro_hpa FROM lvl LEFT JOIN b ON lvl.site IS NOT DISTINCT FROM b.site "
        "AND lvl.date_text IS NOT DISTINCT FROM b.date_text AND lvl.time_text IS NOT DISTINCT FROM b.time_text"
    )
    out["config_from_json"] = f"WITH {CFG} SELECT c_custkey, site, depth_conversion_type FROM cfg_all"
    out["manifest_from_json"] = (
        "WITH docs AS (SELECT s_suppkey, CASE WHEN s_nationkey = 0 THEN 'not a manifest' WHEN s_acctbal < 0 THEN '[]' "
        "ELSE CAST(json_array("
        "json_object('name', s_name, 'nav_option', CAST(s_nationkey AS VARCHAR), 'main_csv', s_suppkey || '.csv', 'baro_csv', 'baro' || s_suppkey || '.csv'), "
        "json_object('name', s_name || ' B', 'nav_option', CAST(s_nationkey AS VARCHAR), 'main_csv', s_suppkey || 'b.csv')) AS VARCHAR) END AS doc FROM supplier), "
        "entries AS (SELECT s_suppkey, unnest(json_extract(doc, '$[*]')) AS e FROM docs WHERE json_valid(doc)) "
        "SELECT s_suppkey, e->>'name' AS name, e->>'nav_option' AS nav_option, e->>'main_csv' AS main_csv, e->>'baro_csv' AS baro_csv FROM entries"
    )
    out["site_from_path"] = f"SELECT page_id, {file_stem('url')} AS site FROM pages"
    out["convert_depth"] = (
        f"WITH {READINGS},{DAILY},{CFG} SELECT daily.site, ts, level_ft, "
        "coalesce(cfg.depth_conversion_type, 'default') AS conversion_type, "
        f"{raw_depth('level_ft', "coalesce(cfg.depth_conversion_type, 'default')")} AS depth_raw_m, "
        "coalesce(cfg.depth_conversion_type, 'default') NOT IN ('default', 'divide_by_100') AS unknown_conversion "
        "FROM daily LEFT JOIN cfg ON daily.site = cfg.site"
    )
    out["adjust_depth"] = (
        f"WITH {READINGS},{DAILY},{CFG},{WEATHER}, conv AS (SELECT daily.*, "
        f"{raw_depth('level_ft', "coalesce(cfg.depth_conversion_type, 'default')")} AS depth_raw_m "
        "FROM daily LEFT JOIN cfg ON daily.site = cfg.site) "
        f"SELECT site, ts, depth_raw_m, baro_hpa, bom_hpa, {adj_depth('depth_raw_m', 'baro_hpa', 'bom_hpa')} AS depth_adj_m "
        "FROM conv LEFT JOIN baro ON CAST(conv.ts AS DATE) = baro.day"
    )
    out["adjust_depth_density"] = (
        f"WITH {READINGS},{DAILY},{CFG},{WEATHER}, conv AS (SELECT daily.*, "
        f"{raw_depth('level_ft', "coalesce(cfg.depth_conversion_type, 'default')")} AS depth_raw_m "
        "FROM daily LEFT JOIN cfg ON daily.site = cfg.site) "
        f"SELECT site, ts, depth_raw_m, {adj_depth('depth_raw_m', 'baro_hpa', 'bom_hpa', SEA_WATER_DENSITY / 1000.0)} AS depth_adj_sea_m, "
        "CAST(NULL AS DOUBLE) AS depth_adj_invalid_m FROM conv LEFT JOIN baro ON CAST(conv.ts AS DATE) = baro.day"
    )
    out["listing_placeholders"] = (
        "WITH files AS (SELECT CAST(c_custkey AS VARCHAR) AS site, c_custkey || '.csv' AS src_file, c_mktsegment AS seg FROM customer), "
        "failed AS ("
        f"SELECT site, src_file, {q(REASON_EMPTY_FILE)} AS why FROM files WHERE seg = 'MACHINERY' UNION ALL "
        f"SELECT site, src_file, {q(REASON_CSV_EMPTY)} FROM files WHERE seg NOT IN ('MACHINERY', 'AUTOMOBILE') AND site NOT IN "
        "(SELECT CAST(user_id AS VARCHAR) FROM events WHERE event_type <> 'signup' AND user_id IS NOT NULL)) "
        f"SELECT site, CAST(CAST({run_ev} AS DATE) AS TIMESTAMP) AS ts, {reason('why', EVENTS_RUN_TS)} AS comment, src_file, "
        "'placeholder' AS flag FROM failed"
    )
    out["parse_datetime"] = (
        f"WITH {raw_rendering(True)} SELECT event_id, date_text, time_text, "
        f"{parse_dt('date_text', 'time_text')} AS ts FROM raw"
    )
    out["parse_numeric"] = (
        f"WITH {raw_rendering(True)} SELECT event_id, {to_num('level_text')} AS level_ft, "
        f"{to_num('baro_text')} AS baro_hpa FROM raw"
    )
    out["drop_invalid"] = (
        f"WITH {raw_rendering(True)} SELECT src_file, ts, level_ft, baro_hpa FROM tagged WHERE stage > 2"
    )
    out["nonneg_filter"] = (
        f"WITH {READINGS} SELECT site, ts, level_ft - 5.0::DOUBLE AS level_ft, baro_hpa, comment, src_file "
        "FROM readings WHERE level_ft - 5.0::DOUBLE >= 0"
    )
    out["missing_sites"] = (
        f"SELECT site, CAST(CAST({run_or} AS DATE) AS TIMESTAMP) AS ts, "
        f"{reason(q(REASON_MISSING_FILE), ORDERS_RUN_TS)} AS comment, 'placeholder' AS flag "
        "FROM (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS site FROM customer) e "
        f"WHERE site NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events WHERE event_type <> 'signup')"
    )
    out["latest_per_site"] = "SELECT CAST(o_custkey AS VARCHAR) AS site, max(o_orderdate) AS latest_ts FROM orders GROUP BY 1"
    stale_reason_or = reason(f"{q(REASON_STALE_PREFIX + ' ')} || strftime({run_or}, '%B %Y')", ORDERS_RUN_TS)
    out["stale_rows"] = (
        "WITH r0 AS (SELECT CAST(o_custkey AS VARCHAR) AS site, o_orderdate AS ts, o_totalprice AS level_ft, "
        "'' AS comment, CAST(o_custkey AS VARCHAR) || '.csv' AS src_file FROM orders), "
        "r AS (SELECT * FROM r0 QUALIFY row_number() OVER (PARTITION BY site, CAST(ts AS DATE) ORDER BY ts NULLS LAST, "
        "src_file NULLS LAST, level_ft NULLS LAST, comment NULLS LAST) = 1), "
        f"stale AS (SELECT site FROM r GROUP BY site HAVING max(ts) < {run_or} - INTERVAL 2 MONTH) "
        "SELECT site, ts, level_ft, comment, src_file, CAST(NULL AS VARCHAR) AS flag FROM r "
        "WHERE site NOT IN (SELECT site FROM stale) "
        f"UNION ALL SELECT site, CAST(CAST({run_or} AS DATE) AS TIMESTAMP), NULL, {stale_reason_or}, NULL, 'placeholder' "
        "FROM stale"
    )
    dry_cond = "depth_raw_m <= 0 AND coalesce(comment, '') = '' AND NOT starts_with(coalesce(comment, ''), 'Placeholder:')"
    out["flag_dry"] = (
        f"WITH {READINGS},{DAILY}, c AS (SELECT site, ts, comment, {raw_depth('level_ft', "'divide_by_100'")} AS depth_raw_m FROM daily) "
        f"SELECT site, ts, depth_raw_m, CASE WHEN {dry_cond} THEN {q(DRY_COMMENT)} ELSE comment END AS comment, "
        f"CASE WHEN {dry_cond} THEN 'dry' END AS flag FROM c"
    )
    stale_reason_ev = reason(f"{q(REASON_STALE_PREFIX + ' ')} || strftime({run_ev}, '%B %Y')", EVENTS_RUN_TS)
    out["comment_split"] = (
        "WITH r AS (SELECT CAST(user_id AS VARCHAR) AS site, ts, value / 100.0::DOUBLE AS level_ft, "
        "CAST(NULL AS DOUBLE) AS baro_hpa, "
        "CASE WHEN event_type = 'error' THEN 'Placeholder: logger reported an error' ELSE '' END AS comment, "
        "CAST(user_id AS VARCHAR) || '.csv' AS src_file FROM events WHERE event_type <> 'signup'), "
        "dd AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY site, CAST(ts AS DATE) ORDER BY ts NULLS LAST, "
        "src_file NULLS LAST, level_ft NULLS LAST, baro_hpa NULLS LAST, comment NULLS LAST) = 1), "
        f"c AS (SELECT site, ts, comment, {raw_depth('level_ft', "'default'")} AS depth_raw_m, "
        "starts_with(comment, 'Placeholder:') AS pref FROM dd), "
        f"stale AS (SELECT site FROM c GROUP BY site HAVING max(ts) FILTER (WHERE NOT pref) < {run_ev} - INTERVAL 2 MONTH), "
        "k AS (SELECT * FROM c WHERE pref OR site NOT IN (SELECT site FROM stale)) "
        f"SELECT site, ts, depth_raw_m, CASE WHEN {dry_cond} THEN {q(DRY_COMMENT)} ELSE comment END AS comment, "
        f"CASE WHEN {dry_cond} THEN 'dry' END AS flag FROM k "
        f"UNION ALL SELECT site, CAST(CAST({run_ev} AS DATE) AS TIMESTAMP), NULL, {stale_reason_ev}, 'placeholder' FROM stale"
    )
    out["union_by_name"] = "SELECT * FROM supplier UNION ALL BY NAME SELECT * FROM customer"
    report_day = lambda x: (
        f"CASE WHEN TRY_CAST({x} AS INTEGER) IN (SELECT unnest(range(1, 32))) "
        f"THEN printf('%02d/{EVENTS_MONTH:02d}/{EVENTS_YEAR}', TRY_CAST({x} AS INTEGER)) END"
    )
    pages = (
        f"WITH ev AS (SELECT event_id, event_type, {K} AS k, ts, value FROM events), "
        "r AS (SELECT event_id, CASE k WHEN 0 THEN '0' WHEN 1 THEN '123' WHEN 2 THEN '31' "
        "ELSE CASE WHEN event_type = 'view' THEN 'Mean' ELSE CAST(day(ts) AS VARCHAR) END END AS day_text, "
        "CASE WHEN event_type = 'click' THEN '0' ELSE CAST(value AS VARCHAR) END AS am, "
        "CASE WHEN event_type = 'error' THEN NULL ELSE CAST(k AS VARCHAR) END AS pm FROM ev), "
        "u AS (SELECT event_id, day_text, '12:00:00' AS time_text, am AS hpa_text FROM r "
        "UNION ALL SELECT event_id, day_text, '18:00:00', pm FROM r), "
        f"w AS (SELECT event_id, {report_day('day_text')} AS date_text, time_text, TRY_CAST(hpa_text AS DOUBLE) AS hpa FROM u "
        "WHERE regexp_full_match(day_text, '[0-9]+') AND TRY_CAST(hpa_text AS DOUBLE) <> 0), "
        "z AS (SELECT *, try_strptime(date_text || ' ' || time_text, '%d/%m/%Y %H:%M:%S') AS ts FROM w) "
    )
    out["weather_readings"] = pages + "SELECT event_id, date_text, time_text, ts, hpa FROM z"
    out["weather_daily"] = pages + (
        "SELECT day, hpa AS bom_hpa FROM (SELECT CAST(ts AS DATE) AS day, hpa, row_number() OVER "
        "(PARTITION BY CAST(ts AS DATE) ORDER BY ts, hpa) AS n FROM z WHERE ts IS NOT NULL) WHERE n = 1"
    )
    out["weather_markup"] = (
        f"WITH ev AS (SELECT event_id, {K} AS k, day(ts) AS d, CAST(value AS VARCHAR) AS am, CAST({K} AS VARCHAR) AS pm FROM events), "
        "r AS (SELECT event_id, CAST(d AS VARCHAR) AS day_text, am, pm FROM ev WHERE k % 7 <> 1 "
        "UNION ALL SELECT event_id, CAST(d + 1 AS VARCHAR), pm, am FROM ev WHERE k % 7 = 2 "
        "UNION ALL SELECT event_id, d || am || pm, '', '' FROM ev WHERE k % 7 = 1), "
        "u AS (SELECT event_id, day_text, '12:00:00' AS time_text, am AS hpa_text FROM r "
        "UNION ALL SELECT event_id, day_text, '18:00:00', pm FROM r), "
        f"w AS (SELECT event_id, {report_day('day_text')} AS date_text, time_text, TRY_CAST(hpa_text AS DOUBLE) AS hpa FROM u "
        "WHERE regexp_full_match(day_text, '[0-9]+') AND TRY_CAST(hpa_text AS DOUBLE) <> 0) "
        "SELECT event_id, date_text, time_text, try_strptime(date_text || ' ' || time_text, '%d/%m/%Y %H:%M:%S') AS ts, hpa FROM w"
    )
    out["unpivot_ampm"] = (
        f"WITH ev AS (SELECT event_id, event_type, {K} AS k, ts, value FROM events), "
        "r AS (SELECT event_id, CASE WHEN event_type = 'view' THEN 'Mean' ELSE CAST(day(ts) AS VARCHAR) END AS day_text, "
        "CASE WHEN event_type = 'click' THEN '0' ELSE CAST(value AS VARCHAR) END AS am, "
        "CASE WHEN event_type = 'error' THEN NULL ELSE CAST(k AS VARCHAR) END AS pm FROM ev), "
        "u AS (SELECT event_id, day_text, '12:00:00' AS time_text, am AS hpa_text FROM r "
        "UNION ALL SELECT event_id, day_text, '18:00:00', pm FROM r) "
        f"SELECT event_id, {report_day('day_text')} AS date_text, "
        f"time_text, {to_num('hpa_text')} AS hpa FROM u "
        f"WHERE regexp_full_match(day_text, '[0-9]+') AND {to_num('hpa_text')} IS NOT NULL AND {to_num('hpa_text')} <> 0"
    )
    strip = (
        "trim(replace(replace(replace(replace(replace(replace("
        "regexp_replace(regexp_replace(x, '<!--[\\s\\S]*?-->', '', 'g'), '\\s*<[^>]*>\\s*', '', 'g'), "
        "'&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), "
        "' ' || chr(9) || chr(10) || chr(13) || chr(12))"
    )
    out["html_items"] = (
        "WITH it AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<li\\b[^>]*>([\\s\\S]*?)</li\\s*>', 1)) AS x, "
        "generate_subscripts(regexp_extract_all(html, '(?i)<li\\b[^>]*>([\\s\\S]*?)</li\\s*>', 1), 1) - 1 AS item_pos "
        f"FROM pages) SELECT page_id, CAST(item_pos AS INTEGER) AS item_pos, {strip} AS item_text FROM it"
    )
    vctes = validation_ctes(EVENTS_RUN_TS)
    out["validate"] = vctes + "SELECT * FROM final"
    out["report_main"] = vctes + (
        f'SELECT site AS "Sample Point", {REPORT_TS} AS "Date Time (dd/mm/yyyy hh24:mi:ss)", bom_hpa AS "BomBaro", '
        'baro_hpa AS "Barometric Pressure(RAW)[Main Buffer] (hPa)", depth_raw_m AS "Depth(m)raw", '
        'depth_adj_m AS "Depth(m)adjusted", comment AS "OTHER - Comments - Text" FROM final'
    )
    out["report_upload"] = vctes + (
        f'SELECT site AS "Sample Point", {REPORT_TS} AS "Date Time (dd/mm/yyyy hh24:mi:ss)", '
        'depth_adj_m AS "LEVEL - DEPTH TO WATER - m (INPUT)", CAST(NULL AS DOUBLE) AS "LEVEL - WATER LEVEL - mAHD (INPUT)", '
        'comment AS "OTHER - Comments - Text" FROM final WHERE depth_adj_m IS NOT NULL'
    )
    out["report_files"] = vctes + (
        f"SELECT 'main_report' AS report, site, {REPORT_TS} AS ts_text, depth_adj_m AS depth, comment, TRUE AS in_order FROM final UNION ALL "
        f"SELECT 'upload_report', site, {REPORT_TS}, depth_adj_m, comment, TRUE FROM final WHERE depth_adj_m IS NOT NULL"
    )
    out["rows_per_site"] = vctes + "SELECT site, count(*) AS n_rows FROM final GROUP BY site"
    out["quality_counts"] = f"WITH {raw_rendering()} " + (
        "SELECT site, count(*) FILTER (WHERE stage = 1) AS n_bad_datetime, count(*) FILTER (WHERE stage = 2) AS n_bad_numeric, "
        "count(*) FILTER (WHERE stage = 3) AS n_negative, count(*) FILTER (WHERE stage = 4) AS n_kept, count(*) AS n_rows "
        "FROM tagged GROUP BY site"
    )
    out["file_outcomes"] = vctes + (
        f"SELECT src_file, site, max_stage, n_bad_datetime, n_bad_numeric, n_negative, n_kept, "
        f"{stage_reason('max_stage')} AS reason FROM outcomes"
    )
    out["folder_outcomes"] = f"WITH {raw_rendering()}" + (
        ", g AS (SELECT CAST(site AS INTEGER) % 24 AS file, count(*) FILTER (WHERE stage = 1) AS n_bad_datetime, "
        "count(*) FILTER (WHERE stage = 2) AS n_bad_numeric, count(*) FILTER (WHERE stage = 3) AS n_negative, "
        "count(*) FILTER (WHERE stage = 4) AS n_kept, max(stage) AS max_stage FROM tagged WHERE CAST(site AS INTEGER) % 24 < 20 GROUP BY 1) "
        f"SELECT file, n_bad_datetime, n_bad_numeric, n_negative, n_kept, FALSE AS rejected, {stage_reason('max_stage')} AS reason FROM g "
        "UNION ALL SELECT f, 0, 0, 0, 0, count(site) > 0, "  # a file without rows is empty before its columns matter
        f"CASE WHEN count(site) = 0 THEN {q(REASON_CSV_EMPTY)} END FROM (VALUES (20), (21)) v(f) LEFT JOIN tagged ON CAST(site AS INTEGER) % 24 = f GROUP BY f "
        f"UNION ALL SELECT 0, 0, 0, 0, 0, FALSE, {q(REASON_CSV_EMPTY)} UNION ALL SELECT 23, 0, 0, 0, 0, FALSE, {q(REASON_EMPTY_FILE)}"
    )
    out["folder_pairs"] = (
        f"WITH ev AS (SELECT user_id % 16 AS file, event_id, event_type, {K} AS k, strftime(ts, '%H:00:00') AS time_text, "
        f"CASE WHEN {K} >= 3 THEN strftime(ts, '%d/%m/%Y') END AS date_text FROM events WHERE user_id % 16 % 5 < 3), "
        "b AS (SELECT file, date_text, time_text, min(900 + event_id % 150) AS p FROM ev WHERE k % 3 = 0 GROUP BY ALL) "
        "SELECT CAST(ev.file AS INTEGER) AS file, ev.date_text, ev.time_text, CAST(event_id % 1000 AS VARCHAR) AS level_text, "
        "CAST(p AS VARCHAR) AS baro_text, CASE WHEN k % 10 = 0 THEN 'seen \"twice\",' || chr(10) || 'reading ' || event_id END AS comment "
        "FROM ev LEFT JOIN b ON ev.file = b.file AND ev.time_text = b.time_text AND ev.date_text IS NOT DISTINCT FROM b.date_text "
        "WHERE event_type <> 'signup'"
    )
    out["site_status"] = vctes + (
        ", ps AS (SELECT site, count(*) FILTER (WHERE flag IS NULL) AS n_data_rows, "
        "count(*) FILTER (WHERE flag IS NOT NULL) AS n_flag_rows FROM final GROUP BY site) "
        "SELECT site, n_data_rows, n_flag_rows, CASE WHEN n_flag_rows > 0 THEN 'flagged' ELSE 'data' END AS status FROM ps"
    )
    out["run_summary"] = (
        "WITH st AS (" + out["site_status"] + ") SELECT count(*) AS n_sites, "
        "count(*) FILTER (WHERE status = 'data') AS n_data_sites, "
        "count(*) FILTER (WHERE status = 'flagged') AS n_flagged_sites, "
        "count(*) FILTER (WHERE status = 'failed') AS n_failed_sites FROM st"
    )
    out["run_metrics"] = vctes + (
        "SELECT count(*) AS n_rows, count(*) FILTER (WHERE bom_hpa IS NOT NULL) AS n_with_bom, "
        "count(*) FILTER (WHERE flag = 'dry') AS n_dry, count(*) FILTER (WHERE depth_adj_m IS NOT NULL) AS n_adjusted, "
        "count(*) FILTER (WHERE flag = 'placeholder') AS n_placeholders FROM final"
    )
    return out


ORACLE_SQL = _sql()
