"""DuckDB SQL for the registered queries.

Money is held in whole cents and every rounding is an integer division, so both engines agree on
ties: half up of ``a / b`` is ``(2a + b) // 2b``.
"""

from __future__ import annotations

FARE = """fare AS (
  SELECT CAST(l_shipdate AS DATE) AS d, l_suppkey AS o,
         CASE WHEN l_quantity >= 3 THEN l_partkey // 20 END AS dst,
         greatest(l_linenumber - 3, 0) AS line_id, l_returnflag AS pt, l_linestatus AS tt,
         CASE WHEN l_discount >= 0.05 THEN 'Adult' WHEN l_discount >= 0.02 THEN 'Student' ELSE 'Senior' END AS ft,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS c
  FROM lineitem)"""

STATION = """station AS (
  SELECT s_suppkey AS id, s_name AS name, n_name AS area, n_regionkey AS line_id, r_name AS home_line
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

# Fare rows with the line and name of the origin station, as the report model sees them.
MODEL = f"""{FARE}, {STATION}, model AS (
  SELECT f.*, s.name AS station_name, s.home_line AS line_name
  FROM fare f LEFT JOIN station s ON f.o = s.id)"""

EVENT = """event AS (
  SELECT event_id AS id, ts, CAST(ts AS DATE) AS d, user_id AS o,
         CASE WHEN event_id % 5 <> 0 THEN (user_id * 7) % 150 END AS dst,
         (user_id + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END) % 6 AS line_id, event_type AS pt,
         length(event_type) * 128 + ascii(event_type) AS pt_id,
         CASE WHEN event_id % 2 = 0 THEN 'Entry' ELSE 'Exit' END AS tt,
         'Fare ' || (event_id % 4) AS ft, CAST(round(value * 100) AS BIGINT) AS c, 'TX-' || event_id AS detail
  FROM events)"""

RAW = """raw AS (
  SELECT event_id AS trx_id,
         CASE WHEN event_id % 79 = 0 THEN 'X' || user_id ELSE CAST(user_id AS VARCHAR) END AS "Sta",
         CASE WHEN event_id % 107 = 0 THEN 'ABC' WHEN event_id % 109 = 0 THEN '99999999'
              WHEN event_id % 5 = 0 THEN '' ELSE CAST((user_id * 7) % 150 AS VARCHAR) END AS "Dest",
         'Line ' || ((user_id + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END) % 6) AS "Line",
         CASE WHEN event_id % 211 = 0 THEN 'A' ELSE 'C' END
           || ((user_id + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END) % 6) AS "LineCC",
         CASE WHEN event_id % 101 <> 0 THEN event_type END AS "PrType",
         CASE WHEN event_id % 2 = 0 THEN 'Entry' ELSE 'Exit' END AS "TxT",
         'Fare ' || (event_id % 4) AS "FarT",
         CASE WHEN event_id % 97 = 0 THEN 'N/A' WHEN event_id % 89 = 0 THEN '-5.00'
              WHEN event_id % 83 = 0 THEN '' WHEN event_id % 113 = 0 THEN '123456789.00'
              ELSE CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) END AS "Value",
         'TX-' || event_id AS "TrxDetail",
         CASE WHEN event_id % 103 = 0 THEN 'not-a-time'
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "InsertionDateTime"
  FROM events)"""

SEEDS = f"""{RAW},
dim_line AS (
  SELECT row_number() OVER (ORDER BY line_name) AS line_id, line_name, line_colour_cc
  FROM (SELECT "Line" AS line_name, min("LineCC") AS line_colour_cc FROM raw WHERE "Line" IS NOT NULL GROUP BY 1)),
dim_type AS (
  SELECT row_number() OVER (ORDER BY passenger_type) AS passenger_type_id, passenger_type
  FROM (SELECT DISTINCT "PrType" AS passenger_type FROM raw WHERE "PrType" IS NOT NULL)),
dim_station AS (
  SELECT station_id, station_name, line_id FROM (
    SELECT CAST("Sta" AS BIGINT) AS station_id, 'Station ' || "Sta" AS station_name, l.line_id,
           row_number() OVER (PARTITION BY CAST("Sta" AS BIGINT) ORDER BY "Sta", l.line_id) AS k
    FROM raw JOIN dim_line l ON l.line_name = "Line" WHERE regexp_full_match("Sta", '[0-9]+'))
  WHERE k = 1)"""

LOADED = f"""{SEEDS}, typed AS (
  SELECT raw.*, l.line_id, t.passenger_type_id,
         CASE WHEN regexp_full_match("Value", '[0-9]+([.][0-9]+)?') AND CAST("Value" AS DOUBLE) < 1e8
              THEN CAST(round(CAST("Value" AS DOUBLE) * 100) AS BIGINT) END AS c,
         CASE WHEN regexp_full_match("Sta", '[0-9]+') THEN CAST("Sta" AS BIGINT) END AS o,
         TRY_CAST(nullif("Dest", '') AS INTEGER) AS dst, nullif("Dest", '') IS NOT NULL AS dst_given,
         TRY_CAST("InsertionDateTime" AS TIMESTAMP) AS ts
  FROM raw LEFT JOIN dim_line l ON l.line_name = "Line" LEFT JOIN dim_type t ON t.passenger_type = "PrType"),
judged AS (
  SELECT typed.*, CASE
    WHEN c IS NULL THEN 'fare' WHEN o IS NULL THEN 'origin' WHEN dst IS NULL AND dst_given THEN 'destination'
    WHEN ts IS NULL THEN 'timestamp' WHEN typed.line_id IS NULL THEN 'line'
    WHEN passenger_type_id IS NULL THEN 'passenger_type'
    WHEN dst IS NOT NULL AND s.station_id IS NULL THEN 'destination_fk' END AS reason
  FROM typed LEFT JOIN dim_station s ON s.station_id = typed.dst)"""


# Raw rows without the malformed lines, and what the load makes of them.
FAULTY = LOADED.replace(RAW, RAW.replace("FROM events)", "FROM events WHERE event_id % 131 <> 0)"))


def loads(parts: list[tuple[str, str]], line: str = '"Line"', changed: str = "raw") -> str:
    """Rows of several loads: ``seen(load_no, trx_id, reason, c, ts, line_name)``; a destination is known
    once any load so far had it as origin. ``changed`` is the table that loads after the first read."""
    rows = " UNION ALL ".join(
        f"SELECT {n} AS load_no, t.*, {line if n else '"Line"'} AS line_name FROM {changed if n else 'raw'} t "
        f"WHERE \"InsertionDateTime\" BETWEEN '{first}' AND '{last}'"
        for n, (first, last) in enumerate(parts)
    )
    return f"""{judge(rows)},
good AS (SELECT trx_id, min(load_no) AS load_no, any_value(c) AS c, any_value(ts) AS ts, any_value(line_name) AS line_name
  FROM seen WHERE reason IS NULL GROUP BY 1)"""


def judge(rows: str) -> str:
    """``seen``: rows of several loads (load_no, the raw columns, line_name) and what each load makes of its own."""
    return f"""part AS ({rows}), typed AS (
  SELECT part.*, CASE WHEN regexp_full_match("Value", '[0-9]+([.][0-9]+)?') AND CAST("Value" AS DOUBLE) < 1e8
              THEN CAST(round(CAST("Value" AS DOUBLE) * 100) AS BIGINT) END AS c,
         CASE WHEN regexp_full_match("Sta", '[0-9]+') THEN CAST("Sta" AS BIGINT) END AS o,
         TRY_CAST(nullif("Dest", '') AS INTEGER) AS dst, nullif("Dest", '') IS NOT NULL AS dst_given,
         TRY_CAST("InsertionDateTime" AS TIMESTAMP) AS ts FROM part),
origin AS (SELECT o, min(load_no) AS first_load FROM typed WHERE o IS NOT NULL GROUP BY 1),
seen AS (SELECT load_no, trx_id, c, ts, line_name, typed.o, dst, "PrType" AS pt, CASE
    WHEN c IS NULL THEN 'fare' WHEN typed.o IS NULL THEN 'origin' WHEN dst IS NULL AND dst_given THEN 'destination'
    WHEN ts IS NULL THEN 'timestamp' WHEN "PrType" IS NULL THEN 'passenger_type'
    WHEN dst IS NOT NULL AND (first_load IS NULL OR first_load > load_no) THEN 'destination_fk' END AS reason
  FROM typed LEFT JOIN origin ON origin.o = dst)"""


# Raw rows with ids that repeat, and the one row of each id that the load accepts.
_REPEATED = (
    RAW.replace("raw AS (", "plain AS (")
    + """, once AS (SELECT * REPLACE (CASE WHEN trx_id % 50 = 1 THEN 1 ELSE trx_id END AS trx_id) FROM plain),
raw AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE trx_id % 10 = 3
  UNION ALL SELECT * REPLACE ('1.00' AS "Value", '2024-03-01 00:00:00' AS "InsertionDateTime") FROM once WHERE trx_id % 7 = 2)"""
)
REPEATED = f"""{LOADED.replace(RAW, _REPEATED)}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY trx_id, reason IS NULL
    ORDER BY ts, "Sta", "Dest", "Line", "LineCC", "PrType", "TxT", "FarT", "Value", "TrxDetail") AS k FROM judged),
final AS (SELECT trx_id, c, CASE WHEN reason IS NULL AND k > 1 THEN 'duplicate_id' ELSE reason END AS reason FROM placed)"""

# Three loads: a part, everything, and one month again with other fares, which replaces that month.
_MOVED = (
    RAW.replace("raw AS (", "plain AS (")
    + """, raw AS (SELECT * REPLACE (CASE WHEN trx_id % 3 = 1 THEN replace("InsertionDateTime", '2024-01-', '2024-02-')
  ELSE "InsertionDateTime" END AS "InsertionDateTime") FROM plain)"""
)
_THREE_LOADS = """SELECT 0 AS load_no, raw.*, "Line" AS line_name FROM raw
  WHERE "InsertionDateTime" < '2024-01-16' OR "InsertionDateTime" LIKE '2024-02-1%'
  UNION ALL SELECT 1, raw.*, "Line" FROM raw
  UNION ALL SELECT 2, * REPLACE ('2.00' AS "Value"), "Line" FROM raw WHERE "InsertionDateTime" LIKE '2024-02-%'"""
MAINTAINED = f"""{_MOVED}, {judge(_THREE_LOADS)},
fare AS (SELECT * EXCLUDE (load_no, k), CAST(ts AS DATE) AS d FROM (
  SELECT *, row_number() OVER (PARTITION BY trx_id ORDER BY load_no) AS k FROM seen
  WHERE reason IS NULL AND (load_no = 2 OR month(ts) = 1)) WHERE k = 1),
home AS (SELECT CAST("Sta" AS BIGINT) AS id, load_no, min("Line") AS line FROM part
  WHERE regexp_full_match("Sta", '[0-9]+') GROUP BY 1, 2),
station AS (SELECT id, 'Station ' || id AS name, arg_min(line, load_no) AS home_line FROM home GROUP BY 1),
model AS (SELECT f.* EXCLUDE (line_name), s.name AS station_name, s.home_line AS line_name
  FROM fare f LEFT JOIN station s ON f.o = s.id),
calendar AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
  FROM (SELECT CAST(ts AS DATE) AS day FROM typed))"""


def sampled(id_text: str) -> str:
    """A row's place in [0, 2^52) from the hash of its id."""
    return f"CAST('0x' || substr(md5(CAST({id_text} AS VARCHAR)), 1, 13) AS BIGINT)"


def rate(value: float) -> int:
    return round(value * (1 << 52))


def money(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100e0"


def half_up(a: str, b: str, digits: int) -> str:
    """``a / b`` for a >= 0 and whole numbers; blank when b is blank or zero."""
    return (
        f"CAST((2 * CAST({a} AS HUGEINT) * {10**digits} + nullif({b}, 0)) // (2 * nullif({b}, 0)) AS DOUBLE)"
        f" / {10**digits}e0"
    )


def signed_half_up(a: str, b: str, digits: int) -> str:
    # Adding zero turns the minus zero of a small negative into plain zero.
    return f"(sign({a}) * ({half_up(f'abs({a})', b, digits)}) + 0e0)"


def share(a: str, b: str, digits: int = 2) -> str:
    return half_up(f"({a}) * 100", b, digits)


def with_lines(body: str) -> str:
    """Totals per line of the fact, then ``body`` over ``by_line``."""
    return f"""WITH {FARE}, by_line AS (
  SELECT r_name AS line_name, count(*) AS n, sum(c) AS c FROM fare JOIN region ON line_id = r_regionkey GROUP BY 1)
{body}"""


KPIS = f"""count(*) AS total_footfall, {money('sum(c)')} AS total_revenue,
  {half_up('sum(c)', 'count(*) * 100', 4)} AS avg_ticket_value, count(DISTINCT o) AS stations_covered"""

STATION_ROWS = f"""{FARE}, {STATION}, rows_ AS (
  SELECT o AS station_id, s.name AS station_name, r_name AS line_name, count(*) AS n, sum(c) AS c
  FROM fare f JOIN station s ON s.id = f.o JOIN region ON f.line_id = r_regionkey GROUP BY ALL)"""

FLOWS = f"""{FARE}, {STATION}, flows AS (
  SELECT a.name AS origin, b.name AS destination, sum(c) AS c
  FROM fare f LEFT JOIN station a ON a.id = f.o LEFT JOIN station b ON b.id = f.dst GROUP BY ALL),
best_d AS (SELECT destination AS m FROM flows GROUP BY 1 QUALIFY rank() OVER (ORDER BY sum(c) DESC) <= 10),
best_o AS (SELECT origin AS m FROM flows GROUP BY 1 QUALIFY rank() OVER (ORDER BY sum(c) DESC) <= 10),
shown AS (SELECT * FROM flows f WHERE EXISTS (SELECT 1 FROM best_d WHERE m IS NOT DISTINCT FROM f.destination))"""

DAILY = f"{FARE}, daily AS (SELECT d, count(*) AS n, sum(c) AS c FROM fare GROUP BY 1)"

CALENDAR = "calendar AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS day FROM fare)"

DATE_COLUMNS = """year(day) AS year, quarter(day) AS quarter, month(day) AS month,
  strftime(day, '%b') AS month_name, day(day) AS day_of_month, isodow(day) AS day_of_week,
  strftime(day, '%a') AS day_name, isodow(day) >= 6 AS is_weekend"""


SELECTED = """line_name IN ('ASIA', 'EUROPE') AND pt IN ('A', 'R') AND d BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'"""


def flows(where: str) -> str:
    """The ten best destinations' cells, ties kept; a journey without destination is the blank member."""
    return f"""cell AS (SELECT m.station_name AS origin, s.name AS destination, sum(c) AS c
  FROM model m LEFT JOIN station s ON m.dst = s.id WHERE {where} GROUP BY 1, 2),
best AS (SELECT destination FROM (SELECT destination, rank() OVER (ORDER BY sum(c) DESC) AS k FROM cell GROUP BY 1) WHERE k <= 10),
flow AS (SELECT cell.* FROM cell JOIN best ON cell.destination IS NOT DISTINCT FROM best.destination)"""


def dashboard(where: str, days: str, before: str, base: str = f"{MODEL}, {CALENDAR}") -> str:
    """All visuals; ``days`` are the calendar days of the trend, ``before`` the selection without dates."""
    return f"""WITH {base}, f AS (SELECT * FROM model WHERE {where}), {flows(where)},
own AS (SELECT d, sum(c) AS c FROM f GROUP BY 1),
past AS (SELECT d, sum(c) AS c FROM model WHERE {before} GROUP BY 1),
w AS (SELECT day, sum(c) AS s, count(c) AS k FROM calendar JOIN past ON d BETWEEN day - 29 AND day WHERE {days} GROUP BY 1),
station_sum AS (SELECT station_name, sum(c) AS c, rank() OVER (ORDER BY sum(c) DESC) AS k FROM f GROUP BY 1),
mix AS (SELECT line_name, pt, count(*) AS n FROM f GROUP BY 1, 2),
v AS (
  SELECT 'kpi' AS dataset, NULL AS member, NULL AS second_member, 'total_footfall' AS measure, CAST(count(*) AS DOUBLE) AS value FROM f
  UNION ALL SELECT 'kpi', NULL, NULL, 'total_revenue', {money('sum(c)')} FROM f
  UNION ALL SELECT 'kpi', NULL, NULL, 'avg_ticket_value', {half_up('sum(c)', 'count(*) * 100', 2)} FROM f
  UNION ALL SELECT 'kpi', NULL, NULL, 'stations_covered', count(DISTINCT o) FROM f
  UNION ALL SELECT 'trend', CAST(d AS VARCHAR), NULL, 'total_revenue', {money('c')} FROM own
  UNION ALL SELECT 'trend', CAST(day AS VARCHAR), NULL, 'revenue_30d_rolling_avg', {half_up('s', 'k * 100', 2)} FROM w
  UNION ALL SELECT 'line', line_name, NULL, 'total_revenue', {money('sum(c)')} FROM f GROUP BY line_name
  UNION ALL SELECT 'station', station_name, NULL, 'total_revenue', {money('c')} FROM station_sum WHERE k <= 10
  UNION ALL SELECT 'mix', line_name, pt, 'total_footfall', n FROM mix
  UNION ALL SELECT 'mix', line_name, pt, 'pct_within_line', {share('n', 'sum(n) OVER (PARTITION BY line_name)')} FROM mix
  UNION ALL SELECT 'matrix', origin, destination, 'revenue', {money('c')} FROM flow)
SELECT * FROM v"""


VALIDATION = f"""{EVENT}, m AS (
  SELECT 'hour' AS profile, CAST(hour(ts) AS VARCHAR) AS member, {sampled('id')} < {rate(0.2)} AS s FROM event
  UNION ALL SELECT 'line', CAST(line_id AS VARCHAR), {sampled('id')} < {rate(0.2)} FROM event),
g AS (SELECT profile, member, count(*) AS n, count(*) FILTER (s) AS k FROM m GROUP BY 1, 2),
p AS (SELECT profile, member, {share('n', 'sum(n) OVER (PARTITION BY profile)')} AS full_pct,
  {share('k', 'sum(k) OVER (PARTITION BY profile)')} AS sample_pct FROM g),
v AS (SELECT *, round(abs(full_pct - sample_pct), 2) AS abs_diff_pct FROM p)"""

# A fifth of the rows: each stratum's quota by largest remainder, its rows by the hash of their ids.
EXACT = f"""{EVENT}, e AS (SELECT line_id, hour(ts) AS h, c, id, {sampled('id')} AS p FROM event),
sized AS (SELECT line_id, h, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS nn FROM e GROUP BY 1, 2),
dealt AS (SELECT *, CAST(floor(nn * 0.2e0 + 0.5) AS BIGINT) AS size FROM sized),
quota AS (SELECT line_id, h, n, size * n // nn + CASE WHEN row_number() OVER (ORDER BY size * n % nn DESC, line_id, h)
  <= size - sum(size * n // nn) OVER () THEN 1 ELSE 0 END AS quota FROM dealt),
picked AS (SELECT e.* FROM e JOIN quota USING (line_id, h)
  QUALIFY row_number() OVER (PARTITION BY line_id, h ORDER BY p, id) <= quota)"""


def every_level(sum_of: str, source: str) -> str:
    return f"""SELECT line_name, pt, grouping(line_name, pt) AS level, {sum_of} FROM {source} GROUP BY CUBE (line_name, pt)"""


ORACLES: dict[str, str] = {
    "load_duplicates": f"""WITH {REPEATED}
SELECT reason AS outcome, count(*) AS row_count, CAST(NULL AS DOUBLE) AS revenue FROM final
WHERE reason = 'duplicate_id' OR reason IS NOT NULL AND trx_id NOT IN (SELECT trx_id FROM final WHERE reason IS NULL) GROUP BY 1
UNION ALL SELECT 'accepted', count(*), {money('sum(c)')} FROM final WHERE reason IS NULL""",
    "load_duplicates_reconciled": f"""WITH {REPEATED}
SELECT count(*) AS raw_rows, count(*) FILTER (reason IS NULL) AS accepted_rows,
  count(*) FILTER (reason IS NOT NULL) AS rejected_rows,
  {money('sum(c) FILTER (reason IS NULL)')} AS accepted_revenue, true AS is_reconciled FROM final""",
    "serving_views_maintained": f"""WITH {MAINTAINED}, daily AS (SELECT d, count(*) AS n, sum(c) AS c FROM fare GROUP BY 1),
w AS (SELECT d, n, c, sum(c) OVER t AS s, count(*) OVER t AS k FROM daily
  WINDOW t AS (ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
lines AS (SELECT line_name, count(*) AS n, sum(c) AS c FROM fare GROUP BY 1),
stations AS (SELECT name, line_name, count(*) AS n, sum(c) AS c FROM fare JOIN station ON id = o GROUP BY 1, 2)
SELECT 'trend' AS view_name, CAST(d AS VARCHAR) AS member, CAST(NULL AS VARCHAR) AS line_name, n AS footfall,
  {money('c')} AS revenue, {half_up('s', 'k * 100', 2)} AS figure FROM w
UNION ALL SELECT 'lines', line_name, NULL, n, {money('c')}, {share('c', 'sum(c) OVER ()')} FROM lines
UNION ALL SELECT 'stations', name, line_name, n, {money('c')}, {half_up('c', 'n * 100', 2)} FROM stations""",
    "stations_sketched": f"""WITH {MAINTAINED}
SELECT line_name, count(DISTINCT o) AS stations_covered, true AS within_bound FROM fare
WHERE d BETWEEN DATE '2024-01-05' AND DATE '2024-02-12' GROUP BY 1""",
    "dashboard_stored": dashboard(
        "pt IN ('purchase', 'click') AND d BETWEEN DATE '2024-01-10' AND DATE '2024-02-20'",
        "day BETWEEN DATE '2024-01-10' AND DATE '2024-02-20'",
        "pt IN ('purchase', 'click')",
        MAINTAINED,
    ),
    "slice_calendar": f"""WITH {MAINTAINED}
SELECT line_name, {KPIS} FROM model WHERE year(d) = 2024 AND month(d) = 2 AND isodow(d) < 6 GROUP BY 1""",
    "slice_station_clustered": f"""WITH {LOADED}, good AS (SELECT * FROM judged WHERE reason IS NULL)
SELECT 'origin_station_id' AS side, count(*) AS footfall, {money('sum(c)')} AS revenue FROM good WHERE o = 7
UNION ALL SELECT 'dest_station_id', count(*), {money('sum(c)')} FROM good WHERE dst = 7""",
    "sample_exact": f"""WITH {EXACT}
SELECT line_id, h AS hour_of_day, count(*) AS sampled, {money('sum(c)')} AS revenue FROM picked GROUP BY 1, 2""",
    "sample_error": f"""WITH {EXACT}, m AS (
  SELECT 'hour' AS profile, h AS member, 1 AS n, 0 AS k FROM e UNION ALL SELECT 'line', line_id, 1, 0 FROM e
  UNION ALL SELECT 'hour', h, 0, 1 FROM picked UNION ALL SELECT 'line', line_id, 0, 1 FROM picked),
g AS (SELECT profile, member, CAST(sum(n) AS BIGINT) AS n, CAST(sum(k) AS BIGINT) AS k FROM m GROUP BY 1, 2),
t AS (SELECT *, sum(n) OVER w AS nn, sum(k) OVER w AS kk, sum(n) OVER o AS cn, sum(k) OVER o AS ck FROM g
  WINDOW w AS (PARTITION BY profile), o AS (PARTITION BY profile ORDER BY member)),
x AS (SELECT *, n * CAST(kk AS DOUBLE) / nn AS expected FROM t)
SELECT profile, count(*) - 1 AS degrees, round(sum((k - expected) * (k - expected) / expected), 6) AS chi_square,
  round(max(abs(CAST(cn AS DOUBLE) / nn - CAST(ck AS DOUBLE) / kk)), 6) AS ks_distance FROM x GROUP BY 1""",
    "sample_estimate": f"""WITH {EXACT}, a AS (SELECT line_id, h, count(*) AS n, sum(c) AS t FROM e GROUP BY 1, 2),
b AS (SELECT line_id, h, count(*) AS k, sum(c) AS s, var_samp(c) AS v FROM picked GROUP BY 1, 2),
j AS (SELECT a.*, k, s, v FROM a LEFT JOIN b USING (line_id, h)),
r AS (SELECT sum(t) AS t, sum(n * CAST(s AS DOUBLE) / k) AS e,
  sum(CASE WHEN k > 1 THEN n * CAST(n - k AS DOUBLE) / k * v END) AS v,
  count(*) FILTER (k = 1) AS unmeasured, count(*) FILTER (k IS NULL) AS missing FROM j)
SELECT {money('t')} AS revenue, round(e / 100, 2) AS estimated_revenue, round(sqrt(v) / 100, 2) AS standard_error,
  abs(e - t) / 100 <= sqrt(v) / 100 * 1.96 AS inside_interval, unmeasured, missing FROM r""",
    "measure_totals": f"""WITH {MODEL}, f AS (SELECT * FROM model WHERE d BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'),
to_line AS (SELECT f.* EXCLUDE (line_name), s.home_line AS line_name FROM f LEFT JOIN station s ON f.dst = s.id),
a AS ({every_level("count(*) AS n, sum(c) AS c, count(DISTINCT o) AS stations, count(DISTINCT d) AS days, "
      "count(*) FILTER (pt IN ('A', 'N')) AS digital, "
      "sum(c) FILTER (d BETWEEN DATE '1998-12-31' - 29 AND DATE '1998-12-31') AS s30, "
      "count(DISTINCT d) FILTER (d BETWEEN DATE '1998-12-31' - 29 AND DATE '1998-12-31') AS k30", "f")}),
b AS ({every_level("sum(c) AS dest", "to_line")}),
w AS (SELECT a.*, sum(c) OVER (PARTITION BY level, pt) AS whole,
  CAST(sum(digital) OVER (PARTITION BY level, line_name) AS BIGINT) AS digital_all FROM a),
j AS (SELECT coalesce(w.level, b.level) AS level, coalesce(w.line_name, b.line_name) AS line_name,
  coalesce(w.pt, b.pt) AS ticket_type, w.* EXCLUDE (level, line_name, pt), dest FROM w FULL JOIN b
  ON w.level = b.level AND w.line_name IS NOT DISTINCT FROM b.line_name AND w.pt IS NOT DISTINCT FROM b.pt)
SELECT line_name, ticket_type, level, n AS total_footfall, {money('c')} AS total_revenue,
  {half_up('c', 'n * 100', 4)} AS avg_ticket_value, stations AS stations_covered,
  {half_up('c', 'days * 100', 2)} AS daily_avg_revenue, {half_up('s30', 'k30 * 100', 2)} AS revenue_30d_rolling_avg,
  {half_up('c', 'whole', 6)} AS revenue_share, {half_up('digital_all', 'n', 6)} AS digital_adoption,
  {money('dest')} AS revenue_by_destination, {half_up('c * 967', 'days * 100000', 2)} AS daily_revenue_target FROM j""",
    "catalogue_statistics": f"""WITH {FARE}, t AS (SELECT count(*) AS n, count(*) FILTER (dst IS NULL) AS blank,
  max(strlen(pt)) AS pt, max(strlen(tt)) AS tt, max(strlen(ft)) AS ft FROM fare)
SELECT name AS column_name, n AS row_count, CASE WHEN name = 'dest_station_id' THEN blank ELSE 0 END AS null_count,
  kind = 'number' AS has_histogram, CASE name WHEN 'ticket_type' THEN pt WHEN 'txn_type' THEN tt WHEN 'fare_type' THEN ft
    ELSE size END AS longest_bytes
FROM t, (VALUES ('txn_date', 'number', 4), ('origin_station_id', 'number', 4), ('dest_station_id', 'number', 4),
  ('line_id', 'number', 2), ('passenger_type_id', 'number', 2), ('ticket_type', 'text', 0), ('txn_type', 'text', 0),
  ('fare_type', 'text', 0), ('fare_amount', 'number', 8)) AS v(name, kind, size)""",
    "land_raw": f'WITH {RAW} SELECT * FROM raw',
    "chunked_landing": f"""WITH {RAW} SELECT *, NULL AS corrupt_record FROM raw
UNION ALL SELECT trx_id, 'short', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, trx_id || ',short'
FROM raw WHERE trx_id % 131 = 0""",
    "land_without_ids": f"""WITH {RAW}
SELECT "Line", 2 * count(*) AS added_rows, 2 * count(*) AS ids FROM raw
WHERE "InsertionDateTime" >= '2024-01-16' GROUP BY 1""",
    "load_twice": f"""WITH {RAW}, {loads([('', '2024-01-16'), ('2024-01-16', 'z')],
    "CASE WHEN trx_id % 7 = 0 THEN 'A line' ELSE \"Line\" END")},
named AS (SELECT line_name, row_number() OVER (ORDER BY first_load, line_name) AS line_id
  FROM (SELECT line_name, min(load_no) AS first_load FROM seen GROUP BY 1)),
span AS (SELECT min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day FROM seen)
SELECT line_id, line_name, count(*) AS footfall, {money('sum(c)')} AS revenue, min(first_day) AS first_day,
  max(last_day) AS last_day
FROM good JOIN named USING (line_name), span GROUP BY 1, 2""",
    "load_partial_month": f"""WITH {RAW}, {loads([('', '2024-01-10'), ('2024-01-10', 'z'), ('2024-01-05', '2024-01-15')])}
SELECT CAST(ts AS DATE) AS txn_date, count(*) AS footfall, {money('sum(c)')} AS revenue FROM good GROUP BY 1""",
    "load_corrected_replay": f"""WITH {RAW}, mended AS (SELECT * REPLACE (
    CASE WHEN "Value" = 'N/A' THEN '1.00' ELSE "Value" END AS "Value",
    CASE WHEN trx_id % 2 = 0 AND "InsertionDateTime" = 'not-a-time' THEN '2024-01-07 00:00:00'
         ELSE "InsertionDateTime" END AS "InsertionDateTime") FROM raw),
{loads([('', 'z'), ('', 'z')], changed='mended')}
SELECT reason AS outcome, count(*) AS row_count FROM seen WHERE load_no = 1 AND reason IS NOT NULL GROUP BY 1
UNION ALL SELECT 'accepted', count(*) FROM good""",
    "import_dimensions": f"""WITH {STATION}
SELECT id AS station_id, name AS station_name, line_id, home_line AS line_name, false AS is_interchange,
  substr(home_line, 1, 2) AS line_colour_cc, CASE WHEN line_id = 0 THEN 40e0 ELSE 15e0 END AS revenue_share_target_pct
FROM station WHERE line_id IS NOT NULL""",
    "serving_views": f"""WITH {STATION_ROWS}
SELECT 'vw_daily_revenue_trend' AS view_name, count(DISTINCT d) AS row_count, {money('sum(c)')} AS revenue FROM fare
UNION ALL SELECT 'vw_line_revenue_share', count(DISTINCT line_name), {money('sum(c)')} FROM rows_
UNION ALL SELECT 'vw_station_performance', count(*), {money('sum(c)')} FROM rows_""",
    "import_flat_extract": f"""WITH {EVENT}, home AS (SELECT DISTINCT o FROM event)
SELECT id AS transaction_id, e.o AS "Sta", 'Station ' || e.o AS "Station", dst AS "Dest",
  CASE WHEN h.o IS NOT NULL THEN 'Station ' || dst END AS dest_station_name, 'Line ' || line_id AS "Line",
  'C' || line_id AS "LineCC", pt AS "Ticket Type", tt AS "TxT", ft AS "FarT", {money('c')} AS "Value",
  detail AS "TrxDetail", d AS "InsertionDateTime"
FROM event e LEFT JOIN home h ON h.o = e.dst""",
    "flat_extract": f"""WITH {EVENT}, home AS (SELECT DISTINCT o FROM event)
SELECT id AS transaction_id, e.o AS "Sta", 'Station ' || e.o AS station_name, dst AS "Dest",
  CASE WHEN h.o IS NOT NULL THEN 'Station ' || dst END AS dest_station_name, 'Line ' || line_id AS "Line",
  'C' || line_id AS "LineCC", pt AS "PrType", tt AS "TxT", ft AS "FarT", {money('c')} AS "Value",
  detail AS "TrxDetail", ts AS "InsertionDateTime"
FROM event e LEFT JOIN home h ON h.o = e.dst""",
    "load_fact": f"""WITH {LOADED}
SELECT trx_id AS transaction_id, ts AS txn_timestamp, CAST(ts AS DATE) AS txn_date, o AS origin_station_id,
  dst AS dest_station_id, line_id, passenger_type_id, "TxT" AS txn_type, "FarT" AS fare_type,
  {money('c')} AS fare_amount, "TrxDetail" AS txn_detail
FROM judged WHERE reason IS NULL""",
    "persisted_star": f"""WITH {LOADED}
SELECT strftime(ts, '%Y-%m') AS txn_month, "Line" AS line_name, count(*) AS footfall, {money('sum(c)')} AS revenue
FROM judged WHERE reason IS NULL GROUP BY 1, 2""",
    "append_replay": f"""WITH {EVENT}
SELECT d AS txn_date, count(*) AS added_rows, {money('sum(c)')} AS added_revenue
FROM event WHERE d >= DATE '2024-01-16' GROUP BY 1""",
    "seed_dim_line": f"WITH {SEEDS} SELECT line_id, line_name, line_colour_cc, true AS is_active FROM dim_line",
    "seed_dim_passenger_type": f"""WITH {SEEDS}
SELECT passenger_type_id, passenger_type, passenger_type IN ('purchase', 'signup') AS is_digital FROM dim_type""",
    "seed_dim_station": f"""WITH {SEEDS}
SELECT station_id, station_name, line_id, false AS is_interchange FROM dim_station""",
    "dim_date": f"WITH {FARE}, {CALENDAR} SELECT day AS date_key, {DATE_COLUMNS} FROM calendar",
    "dim_date_fixed": f"""WITH {DAILY}, calendar AS (
  SELECT CAST(unnest(generate_series(DATE '1997-04-28', DATE '1997-08-04', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT day AS date_key, year(day) AS year, 'Q' || quarter(day) AS quarter_label, strftime(day, '%b') AS month_name,
  month(day) AS month_no, day(day) AS day_of_month, strftime(day, '%a') AS day_name,
  isodow(day) >= 6 AS is_weekend, n AS footfall, {money('c')} AS revenue
FROM calendar LEFT JOIN daily ON d = day""",
    "upsert_dim": f"""WITH {SEEDS}, candidate AS (
  SELECT CAST("Sta" AS BIGINT) AS station_id, 'Station ' || "Sta" AS station_name, l.line_id,
         "InsertionDateTime" < '2024-01-02' AS early
  FROM raw JOIN dim_line l ON l.line_name = "Line" WHERE regexp_full_match("Sta", '[0-9]+'))
SELECT station_id, min(station_name) AS station_name,
  coalesce(min(line_id) FILTER (early), min(line_id)) AS line_id, bool_or(early) AS is_interchange
FROM candidate GROUP BY 1""",
    "load_rejects": f"""WITH {FAULTY}, bad AS (
  SELECT CASE WHEN trx_id % 127 = 0 THEN 'transaction_id' ELSE reason END AS reason, "Value", trx_id FROM judged
  WHERE reason IS NOT NULL OR trx_id % 127 = 0
  UNION ALL SELECT 'record', "Value", trx_id FROM (WITH {RAW} SELECT * FROM raw WHERE trx_id % 131 = 0))
SELECT reason AS reject_reason, count(*) AS rejected_rows, count(DISTINCT "Value") AS distinct_fare_texts,
  arg_min("Value", CASE WHEN trx_id % 127 <> 0 THEN trx_id END) AS example_fare_text
FROM bad GROUP BY 1""",
    "load_reconciliation": f"""WITH {LOADED}
SELECT count(*) AS raw_rows, count(*) FILTER (reason IS NULL) AS accepted_rows,
  count(*) FILTER (reason IS NOT NULL) AS rejected_rows,
  {money('sum(c) FILTER (reason IS NULL)')} AS accepted_revenue, true AS is_reconciled FROM judged""",
    "integrity_report": f"""WITH {EVENT}, types AS (SELECT DISTINCT pt, pt_id FROM event),
type_dim AS (SELECT * FROM types UNION ALL SELECT pt, 51 FROM types WHERE pt = 'purchase'),
lines AS (SELECT DISTINCT line_id, 'Line ' || line_id AS name FROM event),
line_dim AS (SELECT * FROM lines UNION ALL SELECT 50, name FROM lines WHERE line_id = 0),
stations AS (SELECT DISTINCT o FROM event),
station_dim AS (SELECT * FROM stations UNION ALL SELECT * FROM stations WHERE o IN (1, 2)),
span AS (SELECT min(d) AS a, max(d) AS b FROM event),
f AS (SELECT CASE WHEN id % 97 = 0 THEN NULL WHEN id % 101 = 1 THEN id - 1 ELSE id END AS id,
  CASE WHEN id % 41 <> 0 THEN ts END AS ts,
  CASE WHEN id % 43 = 0 THEN NULL WHEN id % 47 = 0 THEN d + 1000 ELSE d END AS d,
  CASE WHEN id % 53 = 0 THEN NULL WHEN id % 59 = 0 THEN 9999999 ELSE o END AS o,
  CASE WHEN id % 89 = 0 THEN 9999999 ELSE dst END AS dst,
  CASE WHEN id % 61 = 0 THEN NULL WHEN id % 67 = 0 THEN 99 ELSE line_id END AS line_id,
  CASE WHEN id % 71 = 0 THEN NULL WHEN id % 73 = 0 THEN 99 ELSE pt_id END AS pt_id,
  CASE WHEN id % 79 = 0 THEN NULL WHEN id % 83 = 0 THEN -c ELSE c END AS c FROM event)
SELECT 'not_null:transaction_id' AS check_name, count(*) FILTER (id IS NULL) AS violations FROM f
UNION ALL SELECT 'not_null:txn_timestamp', count(*) FILTER (ts IS NULL) FROM f
UNION ALL SELECT 'not_null:txn_date', count(*) FILTER (d IS NULL) FROM f
UNION ALL SELECT 'not_null:origin_station_id', count(*) FILTER (o IS NULL) FROM f
UNION ALL SELECT 'not_null:line_id', count(*) FILTER (line_id IS NULL) FROM f
UNION ALL SELECT 'not_null:passenger_type_id', count(*) FILTER (pt_id IS NULL) FROM f
UNION ALL SELECT 'not_null:fare_amount', count(*) FILTER (c IS NULL) FROM f
UNION ALL SELECT 'fare_not_negative', count(*) FILTER (c < 0) FROM f
UNION ALL SELECT 'unique:transaction_id', count(*) FROM (SELECT id FROM f WHERE id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique:line_name', count(*) FROM (SELECT name FROM line_dim GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique:passenger_type', count(*) FROM (SELECT pt FROM type_dim GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique:station_id', count(*) FROM (SELECT o FROM station_dim GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'fk:origin_station_id', count(*) FROM f WHERE o NOT IN (SELECT o FROM station_dim)
UNION ALL SELECT 'fk:dest_station_id', count(*) FROM f WHERE dst NOT IN (SELECT o FROM station_dim)
UNION ALL SELECT 'fk:line_id', count(*) FROM f WHERE line_id NOT IN (SELECT line_id FROM line_dim)
UNION ALL SELECT 'fk:passenger_type_id', count(*) FROM f WHERE pt_id NOT IN (SELECT pt_id FROM type_dim)
UNION ALL SELECT 'fk:txn_date', count(*) FROM f, span WHERE d NOT BETWEEN a AND b""",
    "headline_kpis": f"""WITH {FARE}
SELECT count(*) AS total_transactions, {money('sum(c)')} AS total_revenue,
  {half_up('sum(c)', 'count(*) * 100', 2)} AS avg_ticket_value, count(DISTINCT o) AS stations_covered,
  min(d) AS period_start, max(d) AS period_end FROM fare""",
    "daily_revenue_rolling": f"""WITH {DAILY}, w AS (
  SELECT d, c, sum(c) OVER t AS s, count(*) OVER t AS k FROM daily
  WINDOW t AS (ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
SELECT d AS txn_date, {money('c')} AS daily_revenue, {half_up('s', 'k * 100', 4)} AS revenue_30d_rolling_avg,
  CASE WHEN c * k > s THEN 'above_trend' ELSE 'below_trend' END AS trend_flag FROM w""",
    "daily_revenue_trend": f"""WITH {DAILY}, w AS (
  SELECT d, c, n, sum(c) OVER t AS s, count(*) OVER t AS k, lag(c) OVER (ORDER BY d) AS p FROM daily
  WINDOW t AS (ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
SELECT d AS txn_date, {money('c')} AS daily_revenue, n AS daily_footfall,
  {half_up('c', 'n * 100', 2)} AS avg_ticket_value, {half_up('s', 'k * 100', 2)} AS revenue_30d_rolling_avg,
  {signed_half_up('(c - p) * 100', 'p', 2)} AS revenue_dod_pct_change FROM w""",
    "line_contribution": with_lines(f"""
SELECT line_name, n AS footfall, {money('c')} AS revenue, {share('c', 'sum(c) OVER ()')} AS revenue_share_pct,
  rank() OVER (ORDER BY c DESC) AS revenue_rank FROM by_line"""),
    "line_revenue_share": with_lines(f"""
SELECT line_name, n AS total_footfall, {money('c')} AS total_revenue,
  {share('c', 'sum(c) OVER ()')} AS revenue_share_pct FROM by_line"""),
    "passenger_mix_by_line": f"""WITH {FARE}, g AS (
  SELECT r_name AS line_name, pt AS passenger_type, count(*) AS n FROM fare JOIN region ON line_id = r_regionkey
  GROUP BY 1, 2)
SELECT line_name, passenger_type, n AS txn_count,
  {share('n', 'sum(n) OVER (PARTITION BY line_name)')} AS pct_within_line FROM g""",
    "passenger_mix_network": f"""WITH {FARE}, g AS (SELECT pt AS passenger_type, count(*) AS n FROM fare GROUP BY 1)
SELECT passenger_type, n AS txn_count, {share('n', 'sum(n) OVER ()')} AS pct_of_network FROM g""",
    "od_matrix": f"""WITH {FARE}, {STATION}, g AS (
  SELECT a.area AS origin_station, b.area AS destination_station, r_name AS line_name, count(*) AS n, sum(c) AS c
  FROM fare f JOIN station a ON a.id = f.o JOIN station b ON b.id = f.dst JOIN region ON f.line_id = r_regionkey
  GROUP BY ALL HAVING count(*) > 30)
SELECT origin_station, destination_station, line_name, n AS journeys, {money('c')} AS revenue,
  {half_up('c', 'n * 100', 2)} AS avg_fare
FROM g ORDER BY c DESC, origin_station, destination_station, line_name LIMIT 500""",
    "station_performance": f"""WITH {STATION_ROWS}
SELECT station_id, station_name, line_name, n AS footfall, {money('c')} AS revenue,
  {half_up('c', 'n * 100', 2)} AS avg_ticket_value FROM rows_""",
    "station_ranking": f"""WITH {STATION_ROWS}
SELECT station_id, station_name, line_name, n AS footfall, {money('c')} AS revenue,
  row_number() OVER (ORDER BY n DESC, station_id, line_name) AS busiest_rank,
  row_number() OVER (ORDER BY n, station_id, line_name) AS quietest_rank,
  {share('c', 'sum(c) OVER ()', 3)} AS network_revenue_pct FROM rows_""",
    "station_extremes": f"""WITH {STATION_ROWS}
SELECT extreme, station_id, station_name, line_name, n AS footfall, {money('c')} AS revenue FROM (
  SELECT 'busiest' AS extreme, * FROM rows_
  QUALIFY row_number() OVER (ORDER BY n DESC, station_id, line_name) = 1
  UNION ALL
  SELECT 'quietest', * FROM rows_ QUALIFY row_number() OVER (ORDER BY n, station_id, line_name) = 1)""",
    "daily_vs_target": f"""WITH {DAILY}, t AS (
  SELECT sum(c) AS s, count(*) AS k, count(*) FILTER (c >= 125000000) AS hits FROM daily)
SELECT {half_up('s', 'k * 100', 2)} AS actual_daily_avg, 1250000 AS target_daily_avg,
  {signed_half_up('(s - 125000000 * k) * 100', '125000000 * k', 2)} AS variance_pct,
  hits AS days_at_or_above_target, k AS days_measured FROM t""",
    "hourly_profile": f"""WITH {EVENT}, g AS (SELECT hour(ts) AS h, count(*) AS n, sum(c) AS c FROM event GROUP BY 1)
SELECT h AS hour_of_day, n AS footfall, {money('c')} AS revenue,
  {share('n', 'sum(n) OVER ()')} AS pct_of_daily_footfall FROM g""",
    "revenue_by_txn_type": f"""WITH {FARE}
SELECT tt AS txn_type, count(*) AS footfall, {money('sum(c)')} AS revenue FROM fare GROUP BY 1""",
    "revenue_by_fare_type": f"""WITH {FARE}
SELECT ft AS fare_type, count(*) AS footfall, {money('sum(c)')} AS revenue FROM fare GROUP BY 1""",
    "revenue_by_month": f"""WITH {FARE}
SELECT month(d) AS month_no, strftime(d, '%b') AS month_name, count(*) AS footfall, {money('sum(c)')} AS revenue
FROM fare GROUP BY 1, 2""",
    "revenue_date_rollup": f"""WITH {FARE}, p AS (
  SELECT year(d) AS year, quarter(d) AS quarter, month(d) AS month_no, d AS txn_date, c FROM fare)
SELECT year, quarter, month_no, txn_date,
  4 - grouping(year) - grouping(quarter) - grouping(month_no) - grouping(txn_date) AS depth,
  count(*) AS footfall, {money('sum(c)')} AS revenue
FROM p GROUP BY ROLLUP (year, quarter, month_no, txn_date)""",
    "measure_basic": f"WITH {FARE} SELECT {KPIS} FROM fare",
    "measure_basic_by_line": f"WITH {MODEL} SELECT line_name, {KPIS} FROM model GROUP BY 1",
    "daily_avg_revenue": f"""WITH {MODEL}
SELECT line_name, {half_up('sum(c)', 'count(DISTINCT d) * 100', 2)} AS daily_avg_revenue FROM model GROUP BY 1""",
    "daily_target_scaled": f"""WITH {DAILY}
SELECT year(d) AS year, {half_up('sum(c)', 'count(*) * 100', 2)} AS daily_avg_revenue,
  {half_up('sum(c) * 967', 'count(*) * 100000', 2)} AS daily_revenue_target FROM daily GROUP BY 1""",
    "daily_avg_fixed_calendar": f"""WITH {MODEL}, f AS (
  SELECT line_name, c, CASE WHEN d BETWEEN DATE '1997-04-28' AND DATE '1997-08-04' THEN d END AS d FROM model)
SELECT line_name, {half_up('sum(c)', '(count(DISTINCT d) + max(CASE WHEN d IS NULL THEN 1 ELSE 0 END)) * 100', 2)}
  AS daily_avg_revenue FROM f GROUP BY 1""",
    "revenue_by_date_outside_calendar": f"""WITH {DAILY}, days AS (
  SELECT CAST(unnest(generate_series(DATE '1997-04-28', DATE '1997-08-04', INTERVAL 1 DAY)) AS DATE) AS date),
t AS (SELECT days.date, sum(c) AS c FROM daily LEFT JOIN days ON d = days.date GROUP BY 1),
w AS (SELECT days.date, sum(c) AS s, count(c) AS k FROM days JOIN daily
  ON d BETWEEN greatest(days.date - 29, DATE '1997-04-28') AND days.date GROUP BY 1)
SELECT date, {money('c')} AS total_revenue, {half_up('s', 'k * 100', 2)} AS revenue_30d_rolling_avg
FROM t FULL JOIN w USING (date)""",
    "revenue_30d_calendar": f"""WITH {DAILY}, {CALENDAR}
SELECT day AS date, {half_up('sum(c)', 'count(c) * 100', 2)} AS revenue_30d_rolling_avg
FROM calendar JOIN daily ON d BETWEEN day - 29 AND day GROUP BY 1""",
    "revenue_30d_by_station_month": f"""WITH {MODEL}, {CALENDAR},
daily AS (SELECT station_name, d, sum(c) AS c FROM model GROUP BY 1, 2),
anchor AS (SELECT year(day) AS year, month(day) AS month_no, max(day) AS a FROM calendar GROUP BY 1, 2),
total AS (SELECT station_name, year(d) AS year, month(d) AS month_no, sum(c) AS c FROM daily GROUP BY ALL),
tail AS (SELECT station_name, year, month_no, sum(c) AS s, count(*) AS k
  FROM anchor JOIN daily ON d BETWEEN a - 29 AND a GROUP BY ALL)
SELECT station_name, year, month_no, {money('c')} AS total_revenue,
  {half_up('s', 'k * 100', 2)} AS revenue_30d_rolling_avg
FROM total FULL JOIN tail USING (station_name, year, month_no)""",
    "revenue_share_context": f"""WITH {MODEL}, whole AS (SELECT pt, sum(c) AS w FROM model GROUP BY 1)
SELECT line_name, pt AS ticket_type, {money('sum(c)')} AS total_revenue,
  {half_up('sum(c)', 'max(w)', 6)} AS revenue_share
FROM model JOIN whole USING (pt) WHERE line_name IN ('ASIA', 'EUROPE') GROUP BY 1, 2""",
    "digital_adoption": f"""WITH {MODEL}
SELECT line_name, {half_up("count(*) FILTER (pt IN ('A', 'N'))", "count(*) FILTER (pt IN ('A', 'R'))", 6)}
  AS digital_adoption FROM model GROUP BY 1""",
    "digital_adoption_by_type": f"""WITH {FARE}, digital AS (SELECT count(*) AS k FROM fare WHERE pt IN ('A', 'N'))
SELECT pt AS ticket_type, count(*) AS total_footfall, {half_up('max(k)', 'count(*)', 6)} AS digital_adoption
FROM fare, digital GROUP BY 1""",
    "revenue_by_destination": f"""WITH {FARE}, {STATION},
a AS (SELECT name, sum(c) AS c FROM fare LEFT JOIN station ON id = o GROUP BY 1),
b AS (SELECT name, sum(c) AS c FROM fare LEFT JOIN station ON id = dst GROUP BY 1)
SELECT coalesce(a.name, b.name) AS station_name, {money('a.c')} AS total_revenue,
  {money('b.c')} AS revenue_by_destination
FROM a FULL JOIN b ON a.name IS NOT DISTINCT FROM b.name""",
    "revenue_by_destination_sliced": f"""WITH {FARE}, {STATION},
a AS (SELECT pt, sum(c) AS c FROM fare JOIN station ON id = o WHERE home_line IN ('ASIA', 'EUROPE') GROUP BY 1),
b AS (SELECT pt, sum(c) AS c FROM fare JOIN station ON id = dst WHERE home_line IN ('ASIA', 'EUROPE') GROUP BY 1)
SELECT pt AS ticket_type, {money('a.c')} AS total_revenue, {money('b.c')} AS revenue_by_destination
FROM a FULL JOIN b USING (pt)""",
    "revenue_by_line_left": f"""WITH {FARE}, {STATION},
a AS (SELECT home_line, count(*) AS n FROM fare LEFT JOIN station ON id = o GROUP BY 1),
b AS (SELECT home_line, sum(c) AS c FROM fare LEFT JOIN station ON id = dst GROUP BY 1)
SELECT coalesce(a.home_line, b.home_line) AS line_name, n AS total_footfall, {money('c')} AS revenue_by_destination
FROM a FULL JOIN b ON a.home_line IS NOT DISTINCT FROM b.home_line""",
    "trend_dataset": f"""WITH {DAILY}, {CALENDAR}
SELECT day AS date, {money('max(c) FILTER (d = day)')} AS total_revenue,
  {half_up('sum(c)', 'count(c) * 100', 2)} AS revenue_30d_rolling_avg
FROM calendar JOIN daily ON d BETWEEN day - 29 AND day
WHERE day BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' GROUP BY 1""",
    "revenue_by_line": f"WITH {MODEL} SELECT line_name, {money('sum(c)')} AS total_revenue FROM model GROUP BY 1",
    "top_stations": f"""WITH {MODEL}
SELECT station_name, {money('sum(c)')} AS total_revenue FROM model GROUP BY 1
QUALIFY rank() OVER (ORDER BY sum(c) DESC) <= 10""",
    "station_flow_matrix": f"WITH {FLOWS} SELECT origin, destination, {money('c')} AS revenue FROM shown",
    "station_flow_both_axes": f"""WITH {FLOWS}
SELECT origin, destination, {money('c')} AS revenue FROM shown s
WHERE EXISTS (SELECT 1 FROM best_o WHERE m IS NOT DISTINCT FROM s.origin)""",
    "station_flow_wide": f"""WITH {FARE}, {STATION}
SELECT a.area AS origin, {", ".join(
        money(f"sum(c) FILTER (b.area = 'NATION_{k}')") + f' AS "NATION_{k}"' for k in range(25))}
FROM fare f JOIN station a ON a.id = f.o JOIN station b ON b.id = f.dst GROUP BY 1""",
    "passenger_mix_report": f"""WITH {MODEL}, g AS (
  SELECT line_name, pt AS ticket_type, count(*) AS n FROM model GROUP BY 1, 2)
SELECT line_name, ticket_type, n AS total_footfall,
  {share('n', 'sum(n) OVER (PARTITION BY line_name)')} AS pct_within_line FROM g""",
    "station_flow_totals": f"""WITH {FLOWS}
SELECT origin, destination, grouping(origin, destination) AS level, {money('sum(c)')} AS revenue
FROM shown GROUP BY CUBE (origin, destination)""",
    "slice_line": f"""WITH {MODEL}
SELECT pt AS ticket_type, {KPIS} FROM model WHERE line_name IN ('ASIA', 'EUROPE') GROUP BY 1""",
    "slice_ticket_type": f"WITH {MODEL} SELECT line_name, {KPIS} FROM model WHERE pt IN ('A', 'R') GROUP BY 1",
    "slice_date_range": f"""WITH {MODEL}
SELECT line_name, {KPIS} FROM model WHERE d BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' GROUP BY 1""",
    "slice_station": f"""WITH {MODEL}
SELECT pt AS ticket_type, {KPIS} FROM model
WHERE station_name IN ('Supplier#000000003', 'Supplier#000000007') GROUP BY 1""",
    "station_flow_filtered": f"""WITH {MODEL}, {flows(SELECTED)}
SELECT origin, destination, {money('c')} AS revenue FROM flow""",
    "dashboard_selected": dashboard(
        SELECTED,
        "day BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'",
        "line_name IN ('ASIA', 'EUROPE') AND pt IN ('A', 'R')",
    ),
    "dashboard_cleared": dashboard("true", "true", "true"),
    "dashboard_filtered": f"""WITH {MODEL}, f AS (
  SELECT * FROM model WHERE line_name IN ('ASIA', 'EUROPE') AND pt IN ('A', 'R'))
SELECT dataset, member, count(*) AS total_footfall, {money('sum(c)')} AS total_revenue FROM (
  SELECT 'kpi' AS dataset, 'all' AS member, c FROM f
  UNION ALL SELECT 'trend', CAST(d AS VARCHAR), c FROM f
  UNION ALL SELECT 'line', line_name, c FROM f
  UNION ALL SELECT 'station', station_name, c FROM f
  UNION ALL SELECT 'ticket_type', pt, c FROM f) GROUP BY 1, 2""",
    "stratified_sample": f"""WITH {EVENT}
SELECT line_id, hour(ts) AS hour_of_day, count(*) AS sampled, {money('sum(c)')} AS revenue
FROM event WHERE {sampled('id')} < CASE WHEN line_id = 3 AND hour(ts) = 5 THEN {rate(0.5)}
  WHEN line_id = 2 AND hour(ts) = 7 THEN {rate(0.00004)} ELSE {rate(0.2)} END GROUP BY 1, 2""",
    "sample_coded_ids": f"""WITH {EVENT}
SELECT line_id, hour(ts) AS hour_of_day, count(*) AS sampled, {money('sum(c)')} AS revenue
FROM event WHERE {sampled('(id * 10000 + hour(ts))')} < {rate(0.2)} GROUP BY 1, 2""",
    "sample_validation": f"""WITH {VALIDATION} SELECT * FROM v""",
    "sample_validation_worst": f"""WITH {VALIDATION}
SELECT profile, count(*) AS members, max(abs_diff_pct) AS max_abs_diff_pct FROM v GROUP BY 1""",
    "avg_ticket_vs_target": f"""WITH {FARE}, a AS (
  SELECT count(c) AS transactions, {half_up('sum(c)', 'count(c) * 100', 2)} AS avg_ticket_value FROM fare)
SELECT *, 38000e0 AS target_avg_ticket_value, round(avg_ticket_value - 38000, 2) AS difference FROM a""",
    "share_vs_target": with_lines(f"""
, s AS (SELECT line_name, c, {share('c', 'sum(c) OVER ()')} AS share_pct,
  CASE WHEN line_name = 'AFRICA' THEN 40e0 ELSE 15e0 END AS target_pct FROM by_line)
SELECT line_name, {money('c')} AS revenue, share_pct, target_pct, round(share_pct - target_pct, 2) AS difference_pct
FROM s"""),
    "distribution_profile": f"""WITH {FARE}, m AS (
  SELECT 'line' AS profile, r_name AS member, c FROM fare JOIN region ON line_id = r_regionkey
  UNION ALL SELECT 'passenger_type', pt, c FROM fare
  UNION ALL SELECT 'day', CAST(d AS VARCHAR), c FROM fare
  UNION ALL SELECT 'network', 'all', c FROM fare),
g AS (SELECT profile, member, count(*) AS n, sum(c) AS c FROM m GROUP BY 1, 2)
SELECT profile, member, n AS footfall, {money('c')} AS revenue,
  {share('n', 'sum(n) OVER (PARTITION BY profile)')} AS footfall_pct,
  {share('c', 'sum(c) OVER (PARTITION BY profile)')} AS revenue_pct FROM g""",
    "days_covered": f"""WITH {DAILY}
SELECT count(*) AS days_covered, {half_up('sum(c)', 'count(*) * 100', 2)} AS daily_avg_revenue FROM daily""",
    "reconcile_totals": f"""WITH {FARE}, t AS (SELECT count(*) AS n, sum(c) AS c FROM fare),
a AS (SELECT n, c, (2 * c + n) // (2 * n) AS avg_c FROM t)
SELECT n AS footfall, {money('c')} AS revenue, {money('avg_c')} AS avg_ticket_value,
  {money('avg_c * n')} AS rebuilt_revenue, {half_up('abs(avg_c * n - c) * 100', 'c', 4)} AS gap_pct,
  2 * abs(avg_c * n - c) <= n AS is_reconciled FROM a""",
    "blank_members": f"""WITH {FARE}, n AS (SELECT count(*) AS k FROM fare)
SELECT 'line' AS dimension, count(*) FILTER (line_id NOT IN (SELECT r_regionkey FROM region)) AS blank_rows,
  count(*) AS all_rows FROM fare
UNION ALL SELECT 'origin_station', count(*) FILTER (o NOT IN (SELECT s_suppkey FROM supplier)), count(*) FROM fare
UNION ALL SELECT 'destination_station',
  count(*) FILTER (dst IS NULL OR dst NOT IN (SELECT s_suppkey FROM supplier)), count(*) FROM fare
UNION ALL SELECT 'passenger_type', count(*) FILTER (pt IS NULL), count(*) FROM fare""",
}
