"""The registered queries in plain SQL, for a check by another engine."""

from __future__ import annotations

from factprep.plans.queries import SAMPLED_NODES

COLUMNS = "vendor_id, start_ts, end_ts, party_size, distance, from_id, to_id, fare, total"

ZONES = """
zones AS (
  SELECT CAST(n_nationkey AS BIGINT) AS location_id, r_name AS borough, n_name AS zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

SHIP = """
ship AS (
  SELECT l_orderkey AS k, l_suppkey AS vendor_id, o_orderdate AS start_ts, l_shipdate AS end_ts,
         l_linenumber AS party_size, l_quantity AS distance, c_nationkey AS from_id, s_nationkey AS to_id,
         l_extendedprice AS fare, l_extendedprice * l_tax AS total
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey)"""

DIRTY = (
    SHIP
    + """,
faulty AS (
  SELECT k,
         CASE WHEN k % 17 <> 0 THEN CAST(vendor_id AS DOUBLE) END AS vendor_id,
         CASE WHEN k % 43 = 0 THEN TIMESTAMP '1677-12-31 23:59:59' WHEN k % 19 <> 0 THEN start_ts END AS start_ts,
         CASE WHEN k % 47 = 0 THEN TIMESTAMP '2262-01-01 00:00:00' ELSE end_ts END AS end_ts,
         CAST(party_size AS DOUBLE) + CASE WHEN k % 23 = 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS party_size,
         CASE WHEN k % 29 = 0 THEN CAST('NaN' AS DOUBLE) WHEN k % 31 = 0 THEN CAST('Infinity' AS DOUBLE)
              WHEN k % 37 = 0 THEN CAST(0 AS DOUBLE) ELSE distance END AS distance,
         CAST(from_id AS DOUBLE) + CASE WHEN k % 11 = 0 THEN CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS from_id,
         CAST(to_id AS DOUBLE) + CASE WHEN k % 41 = 0 THEN CAST(4294967296 AS DOUBLE)
              WHEN k % 53 = 0 THEN CAST(-4294967296 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS to_id,
         fare,
         CASE WHEN k % 13 = 0 THEN CAST('-0.0' AS DOUBLE) ELSE total END AS total
  FROM ship),
dirty AS (
  SELECT * FROM faulty
  UNION ALL
  SELECT k, vendor_id, start_ts, end_ts, party_size, distance, from_id, to_id, fare,
         CASE WHEN total = 0 THEN CAST(0 AS DOUBLE) ELSE total END AS total
  FROM faulty WHERE k % 7 = 0)"""
)

# Every comparison with a missing value is unknown, so no rule lets one pass.
VALID = """
  isfinite(vendor_id) AND isfinite(party_size) AND isfinite(from_id) AND isfinite(to_id)
  AND isfinite(distance) AND isfinite(fare) AND isfinite(total)
  AND vendor_id = trunc(vendor_id) AND party_size = trunc(party_size)
  AND from_id = trunc(from_id) AND to_id = trunc(to_id)
  AND vendor_id >= -2147483648 AND vendor_id < 2147483648
  AND party_size >= -2147483648 AND party_size < 2147483648
  AND from_id >= -2147483648 AND from_id < 2147483648
  AND to_id >= -2147483648 AND to_id < 2147483648
  AND start_ts >= TIMESTAMP '1678-01-01' AND start_ts < TIMESTAMP '2262-01-01'
  AND end_ts >= TIMESTAMP '1678-01-01' AND end_ts < TIMESTAMP '2262-01-01'
  AND distance > 0 AND end_ts > start_ts"""


def _clean(name: str, source: str) -> str:
    return f""",
{name} AS (
  SELECT CAST(vendor_id AS BIGINT) AS vendor_id, start_ts, end_ts, CAST(party_size AS BIGINT) AS party_size,
         distance + CAST(0 AS DOUBLE) AS distance, CAST(from_id AS BIGINT) AS from_id, CAST(to_id AS BIGINT) AS to_id,
         fare + CAST(0 AS DOUBLE) AS fare, total + CAST(0 AS DOUBLE) AS total
  FROM {source} WHERE {VALID})"""


def _speed(source: str, keep: str) -> str:
    """CTEs that round distance * 3600 / duration_seconds as Python does, into ``speeds``."""
    return f""",
s1 AS (SELECT {keep}, distance * CAST(3600 AS DOUBLE) / duration_seconds AS x FROM {source}),
s2 AS (SELECT *, x * CAST(1e6 AS DOUBLE) AS p, x * CAST(134217729 AS DOUBLE) - (x * CAST(134217729 AS DOUBLE) - x) AS h FROM s1),
s3 AS (SELECT *, (h * CAST(1e6 AS DOUBLE) - p) + (x - h) * CAST(1e6 AS DOUBLE) AS e, floor(p) AS f FROM s2),
speeds AS (
  SELECT {keep},
         (f + CASE WHEN p - f > CAST(0.5 AS DOUBLE) OR (p - f = CAST(0.5 AS DOUBLE) AND e > 0) THEN CAST(1 AS DOUBLE)
                   WHEN p - f < CAST(0.5 AS DOUBLE) OR e < 0 THEN CAST(0 AS DOUBLE)
                   ELSE f % CAST(2 AS DOUBLE) END) / CAST(1e6 AS DOUBLE) AS speed
  FROM s3)"""


DIRTY_CLEAN = DIRTY + _clean("clean", "dirty")
JOINED = (
    DIRTY_CLEAN
    + f""",
dist AS (SELECT DISTINCT {COLUMNS} FROM clean),{ZONES},
joined AS (
  SELECT d.*, a.borough AS from_borough, a.zone AS from_zone, b.borough AS to_borough, b.zone AS to_zone,
         CAST(epoch_us(end_ts) - epoch_us(start_ts) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS duration_seconds,
         CAST(hour(start_ts) AS BIGINT) AS start_hour
  FROM dist d JOIN zones a ON from_id = a.location_id JOIN zones b ON to_id = b.location_id)"""
)
OUTPUT = f"{COLUMNS}, from_borough, from_zone, to_borough, to_zone, duration_seconds, start_hour"
FLAGSHIP = f"WITH {JOINED}{_speed('joined', OUTPUT)} SELECT {OUTPUT}, speed FROM speeds"

HOPS = """
hops AS (
  SELECT event_id, event_type, user_id AS vendor_id, ts AS start_ts,
         CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS end_ts, event_id % 6 + 1 AS party_size, value AS distance,
         user_id % 30 AS from_id, (event_id * 7) % 25 AS to_id, value AS fare, value AS total,
         CAST(epoch_us(CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP)) - epoch_us(ts) AS DOUBLE) / CAST(1000000 AS DOUBLE)
           AS duration_seconds,
         CAST(hour(ts) AS BIGINT) AS start_hour
  FROM events)"""

SPEEDS = f"WITH {HOPS}{_speed('hops', 'event_id')} SELECT event_id, speed FROM speeds"
CHECKSUM_SPEED = f"""WITH {HOPS}{_speed('hops', 'event_id')}
SELECT CAST(sum(CAST(speed AS DECIMAL(28,6))) AS DOUBLE) AS checksum, count(*) AS row_count FROM speeds"""


def _fails(rule: str, predicate: str, source: str) -> str:
    return f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE NOT coalesce({predicate}, false)) AS row_count FROM {source}"


def _each(template: str, names: list[str]) -> str:
    return " AND ".join(template.format(c=c) for c in names)


INTEGERS = ["vendor_id", "party_size", "from_id", "to_id"]
NUMBERS = [*INTEGERS, "distance", "fare", "total"]
TIMES = ["start_ts", "end_ts"]
# What the texts of the text form come to when read.
TEXT = (
    DIRTY
    + """,
texts AS (
  SELECT CASE WHEN party_size <> 2 THEN vendor_id END AS vendor_id,
         CASE WHEN party_size <> 3 THEN start_ts END AS start_ts, end_ts, party_size,
         CASE WHEN party_size <> 4 THEN distance END AS distance,
         CASE WHEN party_size <> 5 THEN from_id END AS from_id, to_id, fare, total
  FROM dirty)"""
)


def _rejects(tables: str, source: str, unreadable: str) -> str:
    parts = [
        _fails("number_missing", _each("{c} IS NOT NULL", NUMBERS), source),
        _fails("number_not_finite", _each("isfinite({c})", NUMBERS), source),
        _fails("integer_not_whole", _each("{c} = trunc({c})", INTEGERS), source),
        _fails("integer_out_of_range", _each("{c} >= -2147483648 AND {c} < 2147483648", INTEGERS), source),
        _fails("time_missing", _each("{c} IS NOT NULL", TIMES), source),
        _fails(
            "time_out_of_range", _each("{c} >= TIMESTAMP '1678-01-01' AND {c} < TIMESTAMP '2262-01-01'", TIMES), source
        ),
        _fails("distance_not_positive", "distance > 0", source),
        _fails("duration_not_positive", "end_ts > start_ts", source),
        _fails("any_rule", VALID, source),
        f"SELECT 'time_unreadable', count(*) FILTER (WHERE {unreadable}) FROM dirty",
        f"SELECT 'all_rows', count(*) FROM {source}",
    ]
    return f"WITH {tables}\n" + "\nUNION ALL ".join(parts)


DISTINCT = f"WITH {DIRTY_CLEAN} SELECT DISTINCT {COLUMNS} FROM clean"
CLEAN = f"WITH {DIRTY_CLEAN} SELECT {COLUMNS} FROM clean"
TEXT_CLEAN = f"WITH {TEXT}{_clean('clean', 'texts')} SELECT {COLUMNS} FROM clean"
SPLIT = f"""WITH {DIRTY_CLEAN}
SELECT count(*) AS row_groups, CAST(0 AS BIGINT) AS split_groups FROM (SELECT DISTINCT {COLUMNS} FROM clean)"""

SIDES = f"""WITH {DIRTY_CLEAN}{_clean('faultless', 'ship')},
counted AS (
  SELECT {COLUMNS}, CAST(sum(l) AS BIGINT) AS lhs, CAST(sum(r) AS BIGINT) AS rhs FROM (
    SELECT {COLUMNS}, 1 AS l, 0 AS r FROM clean UNION ALL SELECT {COLUMNS}, 0, 1 FROM faultless)
  GROUP BY {COLUMNS})"""

ORDER_FILES = """
files AS (
  SELECT 'orders/' || lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS path, count(*) * 512 AS uncompressed_bytes,
         count(*) AS row_count
  FROM orders GROUP BY o_custkey),
summed AS (
  SELECT *, CAST(sum(uncompressed_bytes) OVER (ORDER BY path) AS BIGINT) AS cumulative,
         CAST(sum(row_count) OVER (ORDER BY path) AS BIGINT) AS running,
         CAST(sum(uncompressed_bytes) OVER () AS BIGINT) AS all_bytes
  FROM files)"""

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# The output columns and how they are stored.
STORED = """('vendor_id', 'int64'), ('start_ts', 'timestamp[us]'), ('end_ts', 'timestamp[us]'), ('party_size', 'int64'),
    ('distance', 'double'), ('from_id', 'int64'), ('to_id', 'int64'), ('fare', 'double'), ('total', 'double'),
    ('from_borough', 'string'), ('from_zone', 'string'), ('to_borough', 'string'), ('to_zone', 'string'),
    ('duration_seconds', 'double'), ('start_hour', 'int64'), ('speed', 'double')"""

MIDDLE = "(list_sort(list({v}))[(count(*) + 1) // 2] + list_sort(list({v}))[count(*) // 2 + 1]) / CAST(2 AS DOUBLE)"

TRIALS = f"""WITH {HOPS},
totals AS (
  SELECT start_hour AS trial, CAST(sum(CAST(distance AS DECIMAL(18,2))) AS DOUBLE) AS baseline_seconds,
         CAST(sum(CAST(distance * CAST(2 AS DOUBLE) + party_size AS DECIMAL(18,2))) AS DOUBLE) AS udf_seconds
  FROM hops GROUP BY start_hour)"""

NODES = ", ".join(f"'{n}'" for n in SAMPLED_NODES)
PEAKS = f"""WITH samples AS (
  SELECT event_type AS run_id, epoch_us(ts) // 3600000000 AS bin, 'n' || CAST(user_id % 3 AS VARCHAR) AS node,
         max(floor(value * 4)) / CAST(4 AS DOUBLE) AS cpu_percent, user_id % 3 + 1 AS cpu_count,
         CAST(sum(CAST(floor(value * 1000000) AS BIGINT)) AS BIGINT) AS memory
  FROM events GROUP BY event_type, epoch_us(ts) // 3600000000, user_id % 3),
runs AS (SELECT run_id, min(bin) + 24 AS first_bin, max(bin) AS last_bin FROM samples GROUP BY run_id),
bins AS (
  SELECT run_id, bin, sum(cpu_percent * cpu_count) / sum(cpu_count) AS cpu,
         CAST(sum(memory) AS DOUBLE) / CAST(1073741824 AS DOUBLE) AS gib
  FROM samples JOIN runs USING (run_id)
  WHERE bin BETWEEN first_bin AND last_bin AND node IN ({NODES})
  GROUP BY run_id, bin HAVING count(*) = {len(SAMPLED_NODES)})
SELECT 'factprep' AS framework, r.run_id, max(cpu) AS peak_cpu_percent, max(gib) AS peak_memory_gib,
       count(b.bin) AS resource_samples
FROM runs r LEFT JOIN bins b ON r.run_id = b.run_id GROUP BY r.run_id"""


def _zero(*rules: str) -> str:
    return " UNION ALL ".join(f"SELECT '{r}' AS rule, CAST(0 AS BIGINT) AS violations" for r in rules)


def _violations(rule: str, predicate: str) -> str:
    return f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {predicate}) AS violations FROM speeds"


ORACLES = {
    "flagship_clean_enrich": FLAGSHIP,
    "clean_contract": CLEAN,
    "clean_in_arrow": CLEAN,
    "clean_text_fact": TEXT_CLEAN,
    "clean_text_fact_in_arrow": TEXT_CLEAN,
    "text_reject_counts": _rejects(TEXT, "texts", "party_size = 3"),
    "clean_spelled_times": f"""WITH {HOPS},
readable AS (SELECT * FROM hops WHERE event_id % 7 <> 6){_clean('clean', 'readable')}
SELECT {COLUMNS} FROM clean""",
    "time_spellings": f"""WITH {HOPS}
SELECT 'start_ts' AS column, CASE event_id % 7 WHEN 0 THEN 'iso' WHEN 1 THEN 'month/day/year' WHEN 2 THEN 'year/month/day'
         WHEN 3 THEN 'day month year' WHEN 4 THEN 'month day, year' WHEN 5 THEN 'compact' ELSE 'other' END AS spelling,
       count(*) AS row_count, count(*) FILTER (WHERE event_id % 7 = 6) AS unread
FROM hops GROUP BY ALL""",
    "reject_counts": _rejects(DIRTY, "dirty", "false"),
    "normalize_zero": f"""WITH {DIRTY}
SELECT count(*) FILTER (WHERE CAST(total AS VARCHAR) = '-0.0') AS negative_before,
       count(*) FILTER (WHERE CAST(total + CAST(0 AS DOUBLE) AS VARCHAR) = '-0.0') AS negative_after,
       count(*) FILTER (WHERE total = 0) AS zeros
FROM dirty""",
    "exact_dedup": DISTINCT,
    "bucket_dedup": DISTINCT,
    "copies_per_row": f"WITH {DIRTY_CLEAN} SELECT {COLUMNS}, count(*) AS copies FROM clean GROUP BY {COLUMNS}",
    "bucket_colocation": SPLIT,
    "key_colocation": SPLIT,
    "bucket_skew": f"""WITH {DIRTY_CLEAN},
lines AS (SELECT greatest(128, ceil(count(*) * 512 / CAST(134217728 AS DOUBLE))) AS needed FROM lineitem)
SELECT (SELECT CAST(power(2, ceil(log2(needed))) AS BIGINT) FROM lines) AS bucket_count, count(*) AS row_count,
       count(*) * 512 AS estimated_bytes, CAST(0 AS BIGINT) AS out_of_range
FROM clean""",
    "bucket_limit": f"""WITH {DIRTY},
counted AS (SELECT to_id AS bucket, count(*) AS row_count FROM dirty GROUP BY to_id)
SELECT *, row_count * 512 AS estimated_bytes,
       row_count > (SELECT sum(row_count) // count(*) FROM counted) AS over_limit
FROM counted""",
    "zone_join_start": f"""WITH {HOPS},{ZONES}
SELECT event_id, from_id, borough AS from_borough, zone AS from_zone
FROM hops JOIN zones ON from_id = location_id""",
    "zone_join_end": f"""WITH {SHIP},{ZONES}
SELECT k AS l_orderkey, party_size, CAST(to_id AS BIGINT) AS to_id, borough AS to_borough, zone AS to_zone
FROM ship JOIN zones ON to_id = location_id""",
    "zone_join_both": f"""WITH {HOPS},{ZONES}
SELECT event_id, from_id, to_id, a.borough AS from_borough, a.zone AS from_zone, b.borough AS to_borough, b.zone AS to_zone
FROM hops JOIN zones a ON from_id = a.location_id JOIN zones b ON to_id = b.location_id""",
    "unmatched_zones": f"""WITH {HOPS},{ZONES}
SELECT from_id AS location_id, count(*) AS row_count FROM hops
WHERE from_id NOT IN (SELECT location_id FROM zones) GROUP BY from_id""",
    "dimension_check": """WITH dim AS (
  SELECT c_custkey AS location_id, c_mktsegment AS borough, CASE WHEN c_acctbal >= 0 THEN c_name END AS zone FROM customer
  UNION ALL SELECT s_suppkey, 'SUPPLIER', s_name FROM supplier),
per_id AS (
  SELECT location_id, count(*) AS n, count(*) FILTER (WHERE coalesce(borough, '') = '' OR coalesce(zone, '') = '') AS blanks
  FROM dim GROUP BY location_id)
SELECT 'id_missing' AS rule, location_id, n AS "rows" FROM per_id WHERE location_id IS NULL
UNION ALL SELECT 'id_repeated', location_id, n FROM per_id WHERE location_id IS NOT NULL AND n > 1
UNION ALL SELECT 'name_missing', location_id, blanks FROM per_id WHERE blanks > 0""",
    "dimension_csv": f"WITH {ZONES} SELECT * FROM zones",
    "durations": f"WITH {HOPS} SELECT event_id, duration_seconds FROM hops",
    "start_hours": f"WITH {HOPS} SELECT event_id, start_hour FROM hops",
    "speed_native": SPEEDS,
    "speed_scalar_udf": SPEEDS,
    "speed_arrow_udf": SPEEDS,
    "hop_features": f"""WITH {HOPS},{ZONES},
joined AS (
  SELECT h.*, a.borough AS from_borough, a.zone AS from_zone, b.borough AS to_borough, b.zone AS to_zone
  FROM hops h JOIN zones a ON from_id = a.location_id JOIN zones b ON to_id = b.location_id)
{_speed('joined', 'event_id, ' + OUTPUT)} SELECT event_id, {OUTPUT}, speed FROM speeds""",
    "checksum_baseline": "SELECT CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) AS checksum, count(*) AS row_count FROM events",
    "checksum_speed": CHECKSUM_SPEED,
    "checksum_scalar_udf": CHECKSUM_SPEED,
    "checksum_arrow_udf": CHECKSUM_SPEED,
    "first_buckets": f"""WITH {HOPS}
SELECT event_id, to_id AS bucket FROM hops
WHERE to_id IN (SELECT DISTINCT to_id FROM hops ORDER BY to_id LIMIT 8)""",
    "trial_totals": f"{TRIALS} SELECT * FROM totals",
    "profile_summary": f"""{TRIALS}
SELECT {MIDDLE.format(v='baseline_seconds')} AS median_baseline_seconds,
       {MIDDLE.format(v='udf_seconds')} AS median_udf_seconds, count(*) AS trials
FROM totals""",
    "staged_roundtrip": CLEAN,
    "streamed_staging": CLEAN,
    "bucketed_dedup_in_place": DISTINCT,
    "guarded_output": f"""WITH {JOINED}
SELECT 'refused' AS run, false AS appears, CAST(0 AS BIGINT) AS output_rows
UNION ALL SELECT 'kept', true, count(*) FROM joined""",
    "streamed_two_sources": f"""WITH {DIRTY_CLEAN}{_clean('faultless', 'ship')}
SELECT {COLUMNS} FROM clean UNION ALL SELECT {COLUMNS} FROM faultless""",
    "output_roundtrip": FLAGSHIP,
    "bucket_layout": f"""WITH {JOINED}
SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(0 AS BIGINT) AS stray_files FROM joined""",
    "streamed_mixed_types": f"WITH {SHIP}{_clean('clean', 'ship')} SELECT {COLUMNS} FROM clean",
    "heterogeneous_union": f"WITH {SHIP}{_clean('clean', 'ship')} SELECT {COLUMNS} FROM clean",
    "nested_mixed_files": """WITH copies AS (
  SELECT l_linenumber FROM lineitem UNION ALL SELECT l_linenumber FROM lineitem WHERE l_linenumber = 1)
SELECT CAST(l_linenumber AS DOUBLE) AS party_size, count(*) AS row_count FROM copies GROUP BY l_linenumber
UNION ALL SELECT CAST(-1 AS DOUBLE), count(*) FROM copies""",
    "prepared_files": FLAGSHIP,
    "file_inventory": " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS filename, count(*) AS row_count FROM {t}" for t in TABLES
    ),
    "resumed_files": FLAGSHIP,
    "emptied_files": f"""WITH {DIRTY}
SELECT column_name, stored_type,
       (SELECT CAST(count(*) AS BIGINT) FROM dirty WHERE (distance = 0 OR isnan(distance)) AND {VALID}) AS row_count
FROM (VALUES {STORED}) AS t(column_name, stored_type)""",
    "file_faults": """SELECT l_linenumber AS party_size,
       CASE l_linenumber WHEN 1 THEN 'total' WHEN 3 THEN 'end_ts,total' ELSE '' END AS lacking,
       CASE WHEN l_linenumber IN (2, 3) THEN 'start_ts' ELSE '' END AS zoned
FROM lineitem WHERE l_linenumber <= 3 GROUP BY l_linenumber""",
    "lookup_fingerprint": f"""WITH {ZONES}
SELECT sha256(string_agg(concat_ws(',', location_id, borough, zone) || chr(10), '' ORDER BY location_id)) AS sha256
FROM zones""",
    "repeated_samples": f"""WITH samples AS (
  SELECT event_type AS run_id, 'n' || CAST(user_id % 3 AS VARCHAR) AS node, epoch_us(ts) // 3600000000 AS bin FROM events),
runs AS (SELECT run_id, min(bin) + 24 AS first_bin FROM samples GROUP BY run_id)
SELECT 'factprep' AS framework, run_id, bin, node, count(*) AS samples
FROM samples JOIN runs USING (run_id) WHERE bin >= first_bin AND node IN ({NODES})
GROUP BY run_id, bin, node HAVING count(*) > 1""",
    "mounted_inventory": " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS filename, count(*) AS row_count, TRUE AS same FROM {t}" for t in TABLES
    ),
    "inventory_totals": "SELECT count(*) AS files, CAST(sum(n) AS BIGINT) AS row_count FROM ("
    + " UNION ALL ".join(f"SELECT count(*) AS n FROM {t}" for t in TABLES)
    + ")",
    "file_checksums": """SELECT c_nationkey AS nation, CAST(sum(strlen(c_name) + 1) AS BIGINT) AS bytes,
       sha256(string_agg(c_name, chr(10) ORDER BY c_custkey) || chr(10)) AS sha256
FROM customer GROUP BY c_nationkey""",
    "budget_prefix": f"""WITH {ORDER_FILES}
SELECT path, uncompressed_bytes, cumulative FROM summed WHERE cumulative <= all_bytes // 2""",
    "count_prefix": f"WITH {ORDER_FILES} SELECT path, row_count FROM files ORDER BY path LIMIT 100",
    "running_totals": f"WITH {ORDER_FILES} SELECT path, row_count, running FROM summed",
    "multiset_parity": f"{SIDES} SELECT * FROM counted WHERE lhs <> rhs",
    "duplicate_audit": f"{SIDES} SELECT * FROM counted WHERE lhs > 1 OR rhs > 1",
    "bucket_parity": f"""WITH {DIRTY_CLEAN},
lefts AS (SELECT *, to_id % 16 AS bucket FROM clean),
rights AS (
  SELECT * REPLACE (CASE WHEN bucket = 3 AND party_size = 2 THEN fare + 1 WHEN bucket = 5 AND fare > 0 THEN CAST('-0.0' AS DOUBLE)
                    ELSE fare END AS fare)
  FROM lefts WHERE NOT (bucket = 7 AND party_size = 1)),
texts AS (
  SELECT bucket, CAST(row({COLUMNS}) AS VARCHAR) AS line, 1 AS l, 0 AS r FROM lefts
  UNION ALL SELECT bucket, CAST(row({COLUMNS}) AS VARCHAR), 0, 1 FROM rights),
tallied AS (SELECT bucket, line, sum(l) AS l, sum(r) AS r FROM texts GROUP BY bucket, line)
SELECT bucket, CAST(sum(l) AS BIGINT) AS left_rows, CAST(sum(r) AS BIGINT) AS right_rows, bool_and(l = r) AS equal
FROM tallied GROUP BY bucket""",
    "output_parity": f"""WITH {JOINED}
SELECT count(*) AS left_rows, count(*) AS right_rows, CAST(0 AS BIGINT) AS mismatches, CAST(0 AS BIGINT) AS repeated
FROM joined""",
    "row_audit": _zero(
        "value_missing",
        "float_not_finite",
        "not_positive",
        "duration_differs",
        "hour_differs",
        "speed_differs",
        "wrong_bucket",
    ),
    "row_audit_faults": f"WITH {JOINED}{_speed('joined', OUTPUT)}\n"
    + "\nUNION ALL ".join(
        [
            _violations("value_missing", "party_size = 4"),
            _violations("float_not_finite", "party_size = 5"),
            _violations("not_positive", "distance <= 0 OR end_ts <= start_ts"),
            _violations("duration_differs", "party_size = 3"),
            _violations("hour_differs", "party_size = 2"),
            _violations("speed_differs", "party_size = 6"),
            _violations("wrong_bucket", "party_size = 1"),
        ]
    ),
    "canonical_rows": f"""WITH {HOPS}
SELECT event_id, CAST(to_json([CAST(vendor_id AS VARCHAR), CAST(start_ts AS VARCHAR), CAST(end_ts AS VARCHAR),
       CAST(party_size AS VARCHAR), CAST(distance AS VARCHAR), CAST(from_id AS VARCHAR), CAST(to_id AS VARCHAR),
       CAST(fare AS VARCHAR), CAST(total AS VARCHAR)]) AS VARCHAR) AS row_text
FROM hops""",
    "run_accounting": f"""WITH {JOINED}
SELECT 'raw' AS stage, count(*) AS row_count FROM dirty
UNION ALL SELECT 'clean', count(*) FROM clean
UNION ALL SELECT 'distinct', count(*) FROM dist
UNION ALL SELECT 'output', count(*) FROM joined""",
    "run_summary": f"""WITH spans AS (
  SELECT event_type AS framework, count(*) AS trials, {MIDDLE.format(v='value')} AS median, min(value) AS minimum,
         max(value) AS maximum
  FROM events GROUP BY event_type)
SELECT *, median - minimum AS below_median, maximum - median AS above_median FROM spans""",
    "run_comparable": """WITH per_run AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY event_type, user_id)
SELECT * FROM (
  SELECT 'not_complete' AS reason, count(*) FILTER (WHERE event_type = 'error') AS row_count FROM events
  UNION ALL SELECT 'not_eligible', count(*) FILTER (WHERE NOT value > 1) FROM events
  UNION ALL SELECT 'different_output_rows', CAST(min(event_id % 6) <> max(event_id % 6) AS BIGINT) FROM events
  UNION ALL SELECT 'listed_twice', count(*) FILTER (WHERE n > 1) FROM per_run)
WHERE row_count > 0""",
    "resource_peaks": PEAKS,
    "benchmark_table": """
SELECT event_type AS framework, CAST(user_id AS VARCHAR) AS run_id, count(*) * 512 AS input_bytes,
       CAST(1 AS BIGINT) AS output_rows, max(value) AS total_seconds, CAST(32 AS INTEGER) AS block_mib,
       CAST(NULL AS DOUBLE) AS peak_cpu_percent, CAST(NULL AS DOUBLE) AS peak_memory_gib,
       CAST(0 AS BIGINT) AS resource_samples
FROM events GROUP BY event_type, user_id""",
    "benchmark_summary": f"""WITH per_run AS (
  SELECT event_type AS framework, max(value) AS total_seconds FROM events GROUP BY event_type, user_id)
SELECT framework, count(*) AS trials, {MIDDLE.format(v='total_seconds')} AS median, min(total_seconds) AS minimum,
       max(total_seconds) AS maximum
FROM per_run GROUP BY framework""",
}
ORACLES["zone_lookup_map"] = ORACLES["zone_join_both"]
