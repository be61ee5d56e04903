"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written as plain SQL from the documented semantics, not generated from the
Spark code.  Only the driver's views exist in DuckDB, so the Bronze adapter,
Silver, Gold and zone lookup are inlined as ``WITH`` prefixes.

Sums and averages of doubles are the engine's own, rounded in the
output (sums to 4, averages to 6 digits, half-way cases upwards).  Integer sums are cast to BIGINT, doubles become integers via
``trunc`` (Spark truncates, DuckDB rounds), numbers are in E notation.
"""

from __future__ import annotations

BRONZE = """
li AS (
  SELECT *, (l_orderkey*7919 + l_partkey*104729 + l_suppkey*1299709
             + l_linenumber*15485863) % 1000003 AS h
  FROM lineitem
),
b1 AS (
  SELECT li.*,
    CASE WHEN h%101=0 THEN NULL WHEN h%53=0 THEN 6 ELSE 1+h%2 END AS VendorID,
    CASE WHEN h%401=0 THEN NULL
         ELSE l_shipdate + to_milliseconds((h%86400)*1000 + CASE WHEN h%331=0 THEN -2678400000
           WHEN h%337=0 THEN 2678400000 ELSE 0 END) END AS tpep_pickup_datetime,
    CASE WHEN h%37=0 THEN NULL WHEN h%41=0 THEN 0E0
         ELSE CAST(1+h%5 AS DOUBLE) END AS passenger_count,
    CASE WHEN h%347=0 THEN NULL WHEN h%43=0 THEN 0E0 WHEN h%307=0 THEN 1.5E2
         WHEN h%149=0 OR h%151=0 THEN 5E-2 ELSE l_quantity/4E0 END AS trip_distance,
    CASE WHEN h%37=0 THEN NULL WHEN h%61=0 THEN 7 WHEN h%97=0 THEN 99
         ELSE 1+h%6 END AS RatecodeID,
    CASE WHEN year(l_shipdate) = 1992 OR h%37=0 THEN NULL WHEN h%199=0 THEN 'X' WHEN h%29=0 THEN 'Y'
         ELSE 'N' END AS store_and_fwd_flag,
    CASE WHEN h%503=0 THEN NULL WHEN h%251=0 THEN 300
         ELSE 1+l_partkey%265 END AS PULocationID,
    CASE WHEN h%521=0 THEN NULL WHEN h%137=0 THEN 0 WHEN h%10<6 THEN 1
         WHEN h%10<9 THEN 2 ELSE 3+(h%4) END AS payment_type,
    CASE WHEN h%353=0 THEN NULL WHEN h%73=0 THEN -5E0 WHEN h%79=0 THEN 0E0 WHEN h%149=0 OR h%151=0 THEN 1.5E2
         ELSE floor(l_extendedprice/1E1)/1E2 END AS fare_amount,
    CASE WHEN h%83=0 THEN NULL WHEN h%89=0 THEN -1E0 ELSE l_tax*1E1 END AS extra,
    CASE WHEN h%359=0 THEN -5E-1 ELSE 5E-1 END AS mta_tax,
    CASE WHEN h%367=0 THEN -1E0 WHEN h%10<6 THEN floor(l_extendedprice*l_discount/1E1)/1E2
         ELSE 0E0 END AS tip_amount,
    CASE WHEN h%373=0 THEN -6.55E0 WHEN h%17=0 THEN 6.55E0 ELSE 0E0 END AS tolls_amount,
    CASE WHEN h%379=0 THEN -3E-1 ELSE 3E-1 END AS improvement_surcharge,
    CASE WHEN year(l_shipdate) = 1992 THEN 0E0 WHEN h%383=0 THEN -2.5E0
         WHEN h%3=0 THEN 2.5E0 ELSE 0E0 END AS congestion_surcharge,
    CASE WHEN year(l_shipdate) <= 1993 THEN 0E0 WHEN h%389=0 THEN -1.25E0
         WHEN h%13=0 THEN 1.25E0 ELSE 0E0 END AS Airport_fee
  FROM (SELECT * FROM li UNION ALL SELECT * FROM li WHERE h%499=0) li
),
bronze AS (
  SELECT VendorID, tpep_pickup_datetime,
    tpep_pickup_datetime + to_milliseconds(CASE WHEN h%67=0 THEN -60000 WHEN h%71=0 THEN 0
         WHEN h%227=0 THEN 500 WHEN h%211=0 THEN 100000000 WHEN h%223=0 THEN 30000
         ELSE (120+h%5400)*1000 END) AS tpep_dropoff_datetime,
    passenger_count, trip_distance, RatecodeID, store_and_fwd_flag, PULocationID,
    CASE WHEN h%509=0 THEN NULL WHEN h%257=0 THEN 301
         WHEN h%31=0 OR h%149=0 THEN PULocationID
         ELSE 1+(l_suppkey*7+h)%265 END AS DOLocationID,
    payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
    improvement_surcharge,
    CASE WHEN h%547=0 THEN NULL WHEN h%557=0 THEN -1E0
         ELSE fare_amount + l_tax*1E1 + 8E-1 END AS total_amount,
    congestion_surcharge, Airport_fee,
    CAST(year(l_shipdate) AS VARCHAR) AS year,
    lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') AS month
  FROM b1
),
nbronze AS (
  SELECT CAST(VendorID AS BIGINT) AS VendorID, tpep_pickup_datetime, tpep_dropoff_datetime,
    CAST(passenger_count AS DOUBLE) AS passenger_count, trip_distance,
    CAST(RatecodeID AS DOUBLE) AS RatecodeID, store_and_fwd_flag,
    CAST(PULocationID AS BIGINT) AS PULocationID, CAST(DOLocationID AS BIGINT) AS DOLocationID,
    CAST(payment_type AS BIGINT) AS payment_type, fare_amount, extra, mta_tax, tip_amount,
    tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
    Airport_fee AS airport_fee, year, month
  FROM bronze
)"""

# Critical rules as one predicate (used for Silver and its complement).
CRITICAL_OK = """(
      tpep_pickup_datetime IS NOT NULL
  AND tpep_dropoff_datetime IS NOT NULL
  AND tpep_dropoff_datetime > tpep_pickup_datetime
  AND tpep_pickup_datetime >= CAST(make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), 1) AS TIMESTAMP)
  AND tpep_pickup_datetime < CAST(make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), 1) + INTERVAL 1 MONTH AS TIMESTAMP)
  AND trip_distance IS NOT NULL AND trip_distance > 0
  AND passenger_count IS NOT NULL AND passenger_count > 0
  AND fare_amount IS NOT NULL AND fare_amount >= 0
  AND total_amount IS NOT NULL AND total_amount >= 0
  AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL
  AND payment_type IS NOT NULL)"""

SILVER = BRONZE + f""",
s1 AS (
  SELECT * REPLACE (
      coalesce(extra, 0E0) AS extra, coalesce(mta_tax, 0E0) AS mta_tax,
      coalesce(tip_amount, 0E0) AS tip_amount, coalesce(tolls_amount, 0E0) AS tolls_amount,
      coalesce(improvement_surcharge, 0E0) AS improvement_surcharge,
      coalesce(congestion_surcharge, 0E0) AS congestion_surcharge,
      coalesce(Airport_fee, 0E0) AS Airport_fee),
    (CAST(floor(epoch_ms(tpep_dropoff_datetime)/1000E0) AS BIGINT)
     - CAST(floor(epoch_ms(tpep_pickup_datetime)/1000E0) AS BIGINT)) / 6E1 AS dur
  FROM bronze
  WHERE {CRITICAL_OK}
),
s2 AS (
  SELECT *,
    CASE WHEN dur > 0 THEN trip_distance / (dur / 6E1) END AS mph,
    extra < 0 OR mta_tax < 0 OR tip_amount < 0 OR tolls_amount < 0
      OR improvement_surcharge < 0 OR congestion_surcharge < 0 OR Airport_fee < 0 AS neg_fee
  FROM s1
),
s3 AS (
  SELECT *,
    VendorID IS NOT NULL AND VendorID NOT IN (1, 2) AS wf1,
    payment_type IS NOT NULL AND payment_type NOT IN (1, 2, 3, 4, 5, 6) AS wf2,
    RatecodeID IS NOT NULL AND RatecodeID NOT IN (1, 2, 3, 4, 5, 6, 99) AS wf3,
    store_and_fwd_flag IS NOT NULL AND store_and_fwd_flag NOT IN ('Y', 'N') AS wf4,
    PULocationID < 1 OR PULocationID > 265 AS wf6,
    DOLocationID < 1 OR DOLocationID > 265 AS wf7,
    trip_distance > 100 AS wf8,
    dur > 1440 AS wf9,
    mph > 120 AS of2,
    trip_distance < 1E-1 AND fare_amount > 100 AS of3,
    trip_distance > 100 AND dur < 90 AS of4,
    PULocationID = DOLocationID AND trip_distance < 1E-1 AND fare_amount > 100 AS of5
  FROM s2
),
silver AS (
  SELECT
    CAST(VendorID AS INTEGER) AS vendor_id,
    tpep_pickup_datetime AS pickup_datetime,
    tpep_dropoff_datetime AS dropoff_datetime,
    CAST(trunc(passenger_count) AS BIGINT) AS passenger_count,
    CAST(trip_distance AS DOUBLE) AS trip_distance,
    CAST(trunc(RatecodeID) AS BIGINT) AS ratecode_id,
    store_and_fwd_flag,
    CAST(PULocationID AS INTEGER) AS pickup_location_id,
    CAST(DOLocationID AS INTEGER) AS dropoff_location_id,
    CAST(payment_type AS BIGINT) AS payment_type,
    fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
    total_amount, congestion_surcharge, Airport_fee AS airport_fee,
    dur AS trip_duration_minutes,
    CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
    CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
    dayname(tpep_pickup_datetime) AS pickup_day_of_week,
    CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance END AS fare_per_mile,
    CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount END AS tip_rate,
    mph AS avg_speed_mph,
    CASE WHEN dur > 0 THEN fare_amount / dur END AS fare_per_minute,
    PULocationID = DOLocationID AS same_pickup_dropoff_zone,
    wf1 AS is_invalid_vendor,
    wf2 AS is_invalid_payment_type_domain,
    wf3 AS is_invalid_ratecode,
    wf4 AS is_invalid_store_and_fwd_flag,
    neg_fee AS has_negative_fee_component,
    wf6 AS is_pickup_location_out_of_range,
    wf7 AS is_dropoff_location_out_of_range,
    wf8 AS is_very_long_distance,
    wf9 AS is_very_long_duration,
    wf1 OR wf2 OR wf3 OR wf4 OR neg_fee OR wf6 OR wf7 OR wf8 OR wf9 AS has_warning_quality_issue,
    of2 AS is_extreme_speed,
    of3 AS is_fare_distance_mismatch,
    of4 AS is_distance_duration_mismatch,
    of5 AS is_same_zone_high_fare,
    of2 OR of3 OR of4 OR of5 AS is_analytical_outlier,
    year, month
  FROM s3
)"""

GOLD = SILVER + """,
fact_trip AS (
  SELECT
    upper(md5(concat_ws('|',
      coalesce(CAST(vendor_id AS VARCHAR), ''),
      coalesce(strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S.%f'), ''),
      coalesce(strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S.%f'), ''),
      coalesce(CAST(pickup_location_id AS VARCHAR), ''),
      coalesce(CAST(dropoff_location_id AS VARCHAR), ''),
      coalesce(CAST(TRY_CAST(fare_amount AS DECIMAL(38,10)) AS VARCHAR), CAST(fare_amount AS VARCHAR), ''),
      coalesce(CAST(TRY_CAST(total_amount AS DECIMAL(38,10)) AS VARCHAR), CAST(total_amount AS VARCHAR), ''),
      coalesce(year, ''),
      coalesce(month, '')))) AS trip_id,
    pickup_datetime, dropoff_datetime,
    CAST(strftime(pickup_date, '%Y%m%d') AS INTEGER) AS pickup_date_key,
    pickup_hour AS pickup_hour_key,
    pickup_day_of_week, vendor_id, ratecode_id,
    payment_type AS payment_type_id,
    pickup_location_id, dropoff_location_id, passenger_count, trip_distance,
    trip_duration_minutes, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
    improvement_surcharge, congestion_surcharge, airport_fee, total_amount,
    fare_per_mile, tip_rate, avg_speed_mph, fare_per_minute, same_pickup_dropoff_zone,
    has_warning_quality_issue, is_extreme_speed, is_fare_distance_mismatch,
    is_distance_duration_mismatch, is_same_zone_high_fare, year, month
  FROM silver
  WHERE coalesce(is_analytical_outlier, false) = false
),
dim_date AS (
  SELECT
    CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key,
    date,
    CAST(year(date) AS INTEGER) AS year,
    CAST(quarter(date) AS INTEGER) AS quarter,
    CAST(month(date) AS INTEGER) AS month,
    CASE month(date) WHEN 1 THEN 'Jan' WHEN 2 THEN 'Feb' WHEN 3 THEN 'Mar'
      WHEN 4 THEN 'Apr' WHEN 5 THEN 'May' WHEN 6 THEN 'Jun' WHEN 7 THEN 'Jul'
      WHEN 8 THEN 'Aug' WHEN 9 THEN 'Sep' WHEN 10 THEN 'Oct' WHEN 11 THEN 'Nov'
      WHEN 12 THEN 'Dec' END AS month_name,
    CAST(day(date) AS INTEGER) AS day_of_month,
    CAST(isodow(date) AS INTEGER) AS day_of_week,
    dayname(date) AS day_of_week_name,
    isodow(date) IN (6, 7) AS is_weekend
  FROM (SELECT DISTINCT pickup_date AS date FROM silver
        WHERE pickup_date IS NOT NULL
          AND coalesce(is_analytical_outlier, false) = false)
),
dim_hour AS (
  SELECT CAST(hour_key AS INTEGER) AS hour_key, CAST(hour_key AS INTEGER) AS hour,
    CASE WHEN hour_key BETWEEN 0 AND 5 THEN 'late_night'
         WHEN hour_key BETWEEN 6 AND 10 THEN 'morning'
         WHEN hour_key BETWEEN 11 AND 15 THEN 'midday'
         WHEN hour_key BETWEEN 16 AND 20 THEN 'evening'
         ELSE 'night' END AS time_period
  FROM range(0, 24) t(hour_key)
),
dim_payment_type AS (
  SELECT * FROM (VALUES (1, 'Credit card', true), (2, 'Cash', true),
                        (3, 'No charge', false), (4, 'Dispute', false))
    t(payment_type_id, payment_type_name, is_standard_payment)
),
dim_rate_code AS (
  SELECT * FROM (VALUES (1, 'Standard rate'), (2, 'JFK'), (3, 'Newark'),
    (4, 'Nassau or Westchester'), (5, 'Negotiated fare'), (6, 'Group ride'),
    (99, 'Unknown')) t(ratecode_id, ratecode_name)
),
dim_vendor AS (
  SELECT * FROM (VALUES (1, 'Creative Mobile Technologies'), (2, 'VeriFone'))
    t(vendor_id, vendor_name)
),
zone_lookup AS (
  SELECT CAST(id AS INTEGER) AS LocationID, r_name AS Borough,
    CASE id WHEN 1 THEN 'Newark Airport' WHEN 132 THEN 'JFK Airport'
            WHEN 138 THEN 'LaGuardia Airport'
            ELSE concat(n_name, ' ', CAST(id AS VARCHAR)) END AS Zone,
    CASE WHEN id IN (1, 132, 138) THEN 'Airports' ELSE 'Boro Zone' END AS service_zone
  FROM range(1, 266) t(id)
  JOIN nation ON n_nationkey = (id - 1) % 25
  JOIN region ON r_regionkey = n_regionkey
),
dim_zone AS (
  SELECT LocationID AS location_id, Borough AS borough, Zone AS zone, service_zone
  FROM zone_lookup WHERE LocationID IS NOT NULL
)"""


def with_gold(body: str) -> str:
    return "WITH " + GOLD.strip() + "\n" + body


def with_silver(body: str) -> str:
    return "WITH " + SILVER.strip() + "\n" + body


def with_bronze(body: str) -> str:
    return "WITH " + BRONZE.strip() + "\n" + body


def fsum(expr: str) -> str:
    """Native sum, rounded in the output."""
    return f"round(sum({expr}), 4)"


def fmean(expr: str) -> str:
    return f"round(avg({expr}) + 1E-9, 6)"


def msum(expr: str, alias: str) -> str:
    return f"{fsum(expr)} AS {alias}"


def mavg(expr: str, alias: str) -> str:
    return f"{fmean(expr)} AS {alias}"


def isum(expr: str, alias: str) -> str:
    return f"CAST(sum({expr}) AS BIGINT) AS {alias}"


def cnt(cond: str, alias: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS {alias}"


QUERIES: dict[str, str] = {}

MT1_BODY = f"""
SELECT d.date_key, d.date,
  count(f.trip_id) AS total_trips,
  {isum('coalesce(f.passenger_count, 0)', 'total_passengers')},
  {msum('coalesce(f.total_amount, 0)', 'total_revenue')},
  {msum('coalesce(f.fare_amount, 0)', 'total_fare_amount')},
  {msum('coalesce(f.tip_amount, 0)', 'total_tip_amount')},
  {msum('coalesce(f.tolls_amount, 0)', 'total_tolls_amount')},
  {msum('coalesce(f.airport_fee, 0)', 'total_airport_fee')},
  {msum('coalesce(f.congestion_surcharge, 0)', 'total_congestion_surcharge')},
  {mavg('f.total_amount', 'avg_total_amount')},
  {mavg('f.fare_amount', 'avg_fare_amount')},
  {mavg('f.tip_amount', 'avg_tip_amount')},
  {mavg('f.tip_rate', 'avg_tip_rate')},
  {mavg('f.trip_distance', 'avg_trip_distance')},
  {mavg('f.trip_duration_minutes', 'avg_trip_duration_minutes')},
  {mavg('f.fare_per_mile', 'avg_fare_per_mile')},
  {cnt('f.payment_type_id = 1', 'credit_card_trips')},
  {cnt('f.payment_type_id = 2', 'cash_trips')},
  {cnt('coalesce(f.airport_fee, 0) > 0', 'airport_fee_trips')},
  {cnt('coalesce(f.has_warning_quality_issue, false)', 'warning_trip_count')}
FROM fact_trip f JOIN dim_date d ON f.pickup_date_key = d.date_key
GROUP BY d.date_key, d.date
"""
QUERIES["mt1_daily_trip_revenue"] = with_gold(MT1_BODY)



# ---- scans and Silver ---------------------------------------------------------

QUERIES["io1_bronze_month_scan"] = with_bronze("SELECT * FROM nbronze")
QUERIES["io3_zone_lookup"] = with_gold("SELECT * FROM zone_lookup")
QUERIES["sn4_silver_trips"] = with_silver("SELECT * FROM silver")

# (id, name, predicate kept) of the 16 critical rules.
CRITICAL_RULES = [
    ("CR1", "pickup_not_null", "tpep_pickup_datetime IS NOT NULL"),
    ("CR2", "dropoff_not_null", "tpep_dropoff_datetime IS NOT NULL"),
    ("CR3", "dropoff_after_pickup", "tpep_dropoff_datetime > tpep_pickup_datetime"),
    ("CR4", "pickup_on_or_after_month_start",
     "tpep_pickup_datetime >= CAST(make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), 1) AS TIMESTAMP)"),
    ("CR5", "pickup_before_next_month",
     "tpep_pickup_datetime < CAST(make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), 1) + INTERVAL 1 MONTH AS TIMESTAMP)"),
    ("CR6", "distance_not_null", "trip_distance IS NOT NULL"),
    ("CR7", "distance_positive", "trip_distance > 0"),
    ("CR8", "passengers_not_null", "passenger_count IS NOT NULL"),
    ("CR9", "passengers_positive", "passenger_count > 0"),
    ("CR10", "fare_not_null", "fare_amount IS NOT NULL"),
    ("CR11", "fare_not_negative", "fare_amount >= 0"),
    ("CR12", "total_not_null", "total_amount IS NOT NULL"),
    ("CR13", "total_not_negative", "total_amount >= 0"),
    ("CR14", "pickup_location_not_null", "PULocationID IS NOT NULL"),
    ("CR15", "dropoff_location_not_null", "DOLocationID IS NOT NULL"),
    ("CR16", "payment_type_not_null", "payment_type IS NOT NULL"),
]


def _fails(pred: str) -> str:
    return f"NOT coalesce({pred}, false)"


QUERIES["cr_rule_failure_counts"] = with_bronze(
    "SELECT year, month,\n  " + ",\n  ".join(
        f"CAST(sum(CASE WHEN {_fails(p)} THEN 1 ELSE 0 END) AS BIGINT) "
        f"AS {i.lower()}_{n}_failures" for i, n, p in CRITICAL_RULES)
    + "\nFROM nbronze GROUP BY year, month")

QUERIES["rc1_row_reconciliation"] = with_bronze(f"""
SELECT year, month, count(*) AS bronze_count,
  CAST(sum(CASE WHEN coalesce({CRITICAL_OK}, false) THEN 1 ELSE 0 END) AS BIGINT) AS silver_count,
  count(*) - CAST(sum(CASE WHEN coalesce({CRITICAL_OK}, false) THEN 1 ELSE 0 END) AS BIGINT)
    AS dropped_count
FROM nbronze GROUP BY year, month""")

_STRICT_OK = CRITICAL_OK[:-1] + "\n  AND payment_type IN (1, 2, 3, 4))"
QUERIES["dc4_strict_payment_reconciliation"] = with_bronze(f"""
SELECT year, month, count(*) AS bronze_count,
  CAST(sum(CASE WHEN coalesce({_STRICT_OK}, false) THEN 1 ELSE 0 END) AS BIGINT) AS silver_count,
  count(*) - CAST(sum(CASE WHEN coalesce({_STRICT_OK}, false) THEN 1 ELSE 0 END) AS BIGINT)
    AS dropped_count
FROM nbronze GROUP BY year, month""")

QUERIES["dc2_rejected_rows"] = with_bronze(
    "SELECT *,\n  concat_ws(',', " + ", ".join(
        f"CASE WHEN {_fails(p)} THEN '{i}' END" for i, _, p in CRITICAL_RULES)
    + ") AS failed_rules,\n  CAST(" + " + ".join(
        f"(CASE WHEN {_fails(p)} THEN 1 ELSE 0 END)" for _, _, p in CRITICAL_RULES)
    + f" AS INTEGER) AS failed_rule_count\nFROM nbronze WHERE NOT coalesce({CRITICAL_OK}, false)")
QUERIES["dc2_rejected_read_back"] = QUERIES["dc2_rejected_rows"]


# ---- profiling ----------------------------------------------------------------------

PF1 = f"""
  count(*) AS total_rows,
  count(DISTINCT VendorID) AS distinct_vendor_count,
  count(DISTINCT payment_type) AS distinct_payment_type_count,
  count(DISTINCT RatecodeID) AS distinct_ratecode_count,
  count(DISTINCT PULocationID) AS distinct_pickup_location_count,
  count(DISTINCT DOLocationID) AS distinct_dropoff_location_count,
  min(tpep_pickup_datetime) AS min_pickup_datetime,
  max(tpep_pickup_datetime) AS max_pickup_datetime,
  min(tpep_dropoff_datetime) AS min_dropoff_datetime,
  max(tpep_dropoff_datetime) AS max_dropoff_datetime,
  min(trip_distance) AS min_trip_distance, max(trip_distance) AS max_trip_distance,
  {fmean('trip_distance')} AS avg_trip_distance,
  min(fare_amount) AS min_fare_amount, max(fare_amount) AS max_fare_amount,
  {fmean('fare_amount')} AS avg_fare_amount,
  min(total_amount) AS min_total_amount, max(total_amount) AS max_total_amount,
  {fmean('total_amount')} AS avg_total_amount"""

NULL_COLS = [("VendorID", "null_vendor_id"), ("tpep_pickup_datetime", "null_pickup_datetime"),
             ("tpep_dropoff_datetime", "null_dropoff_datetime"),
             ("passenger_count", "null_passenger_count"), ("trip_distance", "null_trip_distance"),
             ("RatecodeID", "null_ratecode_id"), ("store_and_fwd_flag", "null_store_and_fwd_flag"),
             ("PULocationID", "null_pickup_location_id"),
             ("DOLocationID", "null_dropoff_location_id"),
             ("payment_type", "null_payment_type"), ("fare_amount", "null_fare_amount"),
             ("total_amount", "null_total_amount")]

CRITICAL = [
    ("tpep_pickup_datetime IS NULL OR tpep_dropoff_datetime IS NULL "
     "OR tpep_dropoff_datetime <= tpep_pickup_datetime", "invalid_datetime_count"),
    ("trip_distance IS NULL OR trip_distance <= 0", "invalid_distance_count"),
    ("passenger_count IS NULL OR passenger_count <= 0", "invalid_passenger_count"),
    ("fare_amount IS NULL OR fare_amount < 0", "invalid_fare_count"),
    ("total_amount IS NULL OR total_amount < 0", "invalid_total_amount_count"),
    ("PULocationID IS NULL", "null_pickup_location_count"),
    ("DOLocationID IS NULL", "null_dropoff_location_count"),
    ("payment_type IS NULL", "null_payment_type_count"),
]

WARNING = [
    ("VendorID IS NOT NULL AND VendorID NOT IN (1, 2)", "invalid_vendor_count"),
    ("payment_type IS NOT NULL AND payment_type NOT IN (1, 2, 3, 4, 5, 6)",
     "invalid_payment_type_domain_count"),
    ("RatecodeID IS NOT NULL AND RatecodeID NOT IN (1, 2, 3, 4, 5, 6, 99)",
     "invalid_ratecode_count"),
    ("store_and_fwd_flag IS NOT NULL AND store_and_fwd_flag NOT IN ('Y', 'N')",
     "invalid_store_and_fwd_flag_count"),
    ("extra < 0", "negative_extra_count"),
    ("mta_tax < 0", "negative_mta_tax_count"),
    ("tip_amount < 0", "negative_tip_count"),
    ("tolls_amount < 0", "negative_tolls_count"),
    ("improvement_surcharge < 0", "negative_improvement_surcharge_count"),
    ("congestion_surcharge < 0", "negative_congestion_surcharge_count"),
    ("airport_fee < 0", "negative_airport_fee_count"),
    ("PULocationID IS NOT NULL AND (PULocationID < 1 OR PULocationID > 265)",
     "pickup_location_out_of_range_count"),
    ("DOLocationID IS NOT NULL AND (DOLocationID < 1 OR DOLocationID > 265)",
     "dropoff_location_out_of_range_count"),
    ("trip_distance > 100", "very_long_distance_count"),
    ("date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) > 1440",
     "very_long_duration_count"),
]


def _counts(pairs) -> str:
    return ",\n  ".join(cnt(c, n) for c, n in pairs)


QUERIES["pf1_summary"] = with_bronze(f"SELECT year, month, {PF1}\nFROM nbronze GROUP BY year, month")
QUERIES["pf_profile_one_pass"] = with_bronze(
    f"SELECT year, month, {PF1},\n  "
    + _counts([(f"{c} IS NULL", n) for c, n in NULL_COLS]) + ",\n  "
    + _counts(CRITICAL) + ",\n  " + _counts(WARNING)
    + "\nFROM nbronze GROUP BY year, month")
QUERIES["pf2_null_checks"] = with_bronze(
    "SELECT year, month,\n  " + _counts([(f"{c} IS NULL", n) for c, n in NULL_COLS])
    + "\nFROM nbronze GROUP BY year, month")
QUERIES["pf3_critical_quality"] = with_bronze(
    "SELECT year, month, count(*) AS total_rows,\n  " + _counts(CRITICAL)
    + "\nFROM nbronze GROUP BY year, month")
QUERIES["pf4_warning_quality"] = with_bronze(
    "SELECT year, month,\n  " + _counts(WARNING) + "\nFROM nbronze GROUP BY year, month")

for _key, _col in [("pf5_payment_type_distribution", "payment_type"),
                   ("pf5_ratecode_distribution", "RatecodeID"),
                   ("pf5_vendor_distribution", "VendorID"),
                   ("pf5_store_and_fwd_distribution", "store_and_fwd_flag")]:
    QUERIES[_key] = with_bronze(
        f"SELECT year, month, {_col}, count(*) AS total_rows FROM nbronze "
        f"GROUP BY year, month, {_col}")

QUERIES["pf5_distributions_one_pass"] = with_bronze("\nUNION ALL\n".join(
    f"SELECT year, month, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, "
    f"count(*) AS total_rows FROM nbronze GROUP BY year, month, {c}"
    for c in ["payment_type", "RatecodeID", "VendorID", "store_and_fwd_flag"]))

_CRIT_SUM = " + ".join(f"sum(CASE WHEN {c} THEN 1 ELSE 0 END)" for c, _ in CRITICAL)
_WARN_SUM = " + ".join(f"sum(CASE WHEN {c} THEN 1 ELSE 0 END)" for c, _ in WARNING)
MONTHLY_SUMMARY = f"""
monthly_summary AS (
  SELECT year || '-' || month AS period, CAST(year AS INTEGER) AS year,
    CAST(month AS INTEGER) AS month, count(*) AS total_rows,
    CAST({_CRIT_SUM} AS BIGINT) AS critical_issue_count,
    CAST({_WARN_SUM} AS BIGINT) AS warning_issue_count,
    min(tpep_pickup_datetime) AS min_pickup_datetime,
    max(tpep_pickup_datetime) AS max_pickup_datetime,
    min(tpep_dropoff_datetime) AS min_dropoff_datetime,
    max(tpep_dropoff_datetime) AS max_dropoff_datetime
  FROM nbronze GROUP BY year, month
)"""
QUERIES["pf7_monthly_summary"] = with_bronze(
    "," + MONTHLY_SUMMARY + """
SELECT *, 'bronze/' || f AS input_file, 'details' AS details_output_dir,
  'summary/' || f || ', null_checks/' || f AS generated_files
FROM (SELECT *, printf('year=%04d/month=%02d/', year, month) AS f FROM monthly_summary)""".replace(
        "SELECT *, 'bronze/'", "SELECT * EXCLUDE (f), 'bronze/'"))
QUERIES["dc6_quality_gate"] = with_bronze("," + MONTHLY_SUMMARY + """
SELECT period, year, month, total_rows, critical_issue_count,
  critical_issue_count / total_rows AS critical_issue_ratio,
  1.25E-1 AS max_critical_ratio,
  CASE WHEN critical_issue_count / total_rows <= 1.25E-1 THEN 'passed' ELSE 'failed' END AS gate
FROM monthly_summary""")
QUERIES["dc5_volume_checks"] = with_gold("""
SELECT 'bronze_row_count' AS "check", count(*) AS row_count FROM nbronze
UNION ALL
SELECT 'zone_row_count' AS "check", count(*) AS row_count FROM zone_lookup""")


# ---- Gold ------------------------------------------------------------------------------

QUERIES["gd1_dim_date"] = with_gold("SELECT * FROM dim_date")
QUERIES["gd6_dim_zone"] = with_gold("SELECT * FROM dim_zone")
QUERIES["gf4_fact_trip"] = with_gold("SELECT * FROM fact_trip")
QUERIES["qt2_duplicated_trip_ids"] = with_gold(
    "SELECT trip_id, count(*) AS trips FROM fact_trip GROUP BY trip_id HAVING count(*) > 1")

AVG7 = ["total_amount", "fare_amount", "tip_amount", "tip_rate", "trip_distance",
        "trip_duration_minutes", "fare_per_mile"]


def _avgs(cols) -> str:
    return ",\n  ".join(mavg(f"f.{c}", f"avg_{c}") for c in cols)


MARTS = {}
MARTS["mart_daily_trip_revenue"] = MT1_BODY
MARTS["mart_hourly_demand"] = f"""
SELECT d.date_key, d.date, d.year, d.month, d.day_of_week, d.is_weekend,
  h.hour_key, h.hour, h.time_period,
  count(f.trip_id) AS total_trips,
  {isum('f.passenger_count', 'total_passengers')},
  {msum('f.total_amount', 'total_amount')},
  {msum('f.fare_amount', 'total_fare_amount')},
  {msum('f.tip_amount', 'total_tip_amount')},
  {_avgs(AVG7)}
FROM fact_trip f
JOIN dim_date d ON f.pickup_date_key = d.date_key
JOIN dim_hour h ON f.pickup_hour_key = h.hour_key
GROUP BY d.date_key, d.date, d.year, d.month, d.day_of_week, d.is_weekend,
  h.hour_key, h.hour, h.time_period
"""
_ZONE_SUMS = f"""
  {isum('f.passenger_count', 'total_passengers')},
  {msum('f.total_amount', 'total_amount')},
  {msum('f.fare_amount', 'total_fare_amount')},
  {msum('f.tip_amount', 'total_tip_amount')},
  {msum('f.tolls_amount', 'total_tolls_amount')},
  {msum('f.congestion_surcharge', 'total_congestion_surcharge')},
  {msum('f.airport_fee', 'total_airport_fee')},"""
MARTS["mart_pickup_zone_performance"] = f"""
SELECT z.location_id AS pickup_location_id, z.borough AS pickup_borough,
  z.zone AS pickup_zone, z.service_zone AS pickup_service_zone,
  count(f.trip_id) AS total_trips,{_ZONE_SUMS}
  {_avgs(AVG7)}
FROM fact_trip f JOIN dim_zone z ON f.pickup_location_id = z.location_id
GROUP BY z.location_id, z.borough, z.zone, z.service_zone
"""
MARTS["mart_payment_behavior"] = f"""
SELECT p.payment_type_id, p.payment_type_name, p.is_standard_payment,
  count(f.trip_id) AS total_trips,
  {isum('f.passenger_count', 'total_passengers')},
  {msum('f.total_amount', 'total_amount')},
  {msum('f.fare_amount', 'total_fare_amount')},
  {msum('f.tip_amount', 'total_tip_amount')},
  {msum('f.tolls_amount', 'total_tolls_amount')},
  {_avgs(["total_amount", "fare_amount", "tip_amount", "tip_rate", "fare_per_mile",
          "trip_distance", "trip_duration_minutes"])}
FROM fact_trip f JOIN dim_payment_type p ON f.payment_type_id = p.payment_type_id
GROUP BY p.payment_type_id, p.payment_type_name, p.is_standard_payment
"""
_AIRPORTS = "('JFK Airport', 'LaGuardia Airport', 'Newark Airport')"
MARTS["mart_airport_trip_summary"] = f"""
SELECT airport_trip_type,
  count(f.trip_id) AS total_trips,{_ZONE_SUMS}
  {_avgs(AVG7)}
FROM (
  SELECT f.*,
    CASE WHEN pz.zone IN {_AIRPORTS} AND dz.zone IN {_AIRPORTS} THEN 'airport_to_airport'
         WHEN pz.zone IN {_AIRPORTS} THEN 'airport_pickup'
         WHEN dz.zone IN {_AIRPORTS} THEN 'airport_dropoff'
         ELSE 'non_airport' END AS airport_trip_type
  FROM fact_trip f
  JOIN dim_zone pz ON f.pickup_location_id = pz.location_id
  JOIN dim_zone dz ON f.dropoff_location_id = dz.location_id
) f
GROUP BY airport_trip_type
"""
QUERIES["mt2_hourly_demand"] = with_gold(MARTS["mart_hourly_demand"])
QUERIES["mt3_pickup_zone_performance"] = with_gold(MARTS["mart_pickup_zone_performance"])
QUERIES["mt4_payment_behavior"] = with_gold(MARTS["mart_payment_behavior"])
QUERIES["mt5_airport_trip_summary"] = with_gold(MARTS["mart_airport_trip_summary"])


# ---- ad-hoc queries ------------------------------------------------------------------------

QUERIES["aq0_smoke_read"] = with_silver("""
SELECT vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance,
  fare_amount, total_amount, pickup_location_id, dropoff_location_id, payment_type, year, month
FROM silver
ORDER BY ALL NULLS FIRST
LIMIT 25""")

# Group sizes stay below the accuracy of the quantile sketch, where it is exact.
QUERIES["dc1_distribution_profile"] = with_silver("SELECT year, month, " + ", ".join(
    f"quantile_disc({c}, {p}) AS {c}_p{n}" for c, ps in (
        ("trip_distance", ((5E-1, "50"), (9.5E-1, "95"), (9.9E-1, "99"), (9.99E-1, "999"))),
        ("trip_duration_minutes", ((9.5E-1, "95"), (9.9E-1, "99"), (9.99E-1, "999"))))
    for p, n in ps) + " FROM silver GROUP BY year, month")

# Every estimate lies within its stated error, so the checks are all true.
QUERIES["dc1_merged_years"] = with_silver("""
SELECT year, count(DISTINCT month) AS months, count(*) AS trip_count,
  min(pickup_datetime) AS min_pickup_datetime, max(pickup_datetime) AS max_pickup_datetime,
  true AS trip_distance_within_error, true AS trip_duration_minutes_within_error,
  true AS pickup_location_id_within_error, true AS dropoff_location_id_within_error
FROM silver GROUP BY year""")

QUERIES["aq1_monthly_trip_summary"] = with_silver(f"""
SELECT year, month, count(*) AS trip_count,
  {msum('total_amount', 'total_revenue')},
  {mavg('total_amount', 'avg_total_amount')},
  {mavg('trip_distance', 'avg_trip_distance')},
  {mavg('trip_duration_minutes', 'avg_trip_duration_minutes')},
  {cnt('is_analytical_outlier', 'analytical_outlier_count')}
FROM silver GROUP BY year, month ORDER BY year, month""")

QUERIES["aq2_payment_type_summary"] = with_silver(f"""
SELECT year, month, payment_type, count(*) AS trip_count,
  {msum('total_amount', 'total_revenue')},
  {mavg('fare_amount', 'avg_fare_amount')},
  {mavg('tip_amount', 'avg_tip_amount')},
  {mavg('tip_rate', 'avg_tip_rate')}
FROM silver GROUP BY year, month, payment_type""")

QUERIES["aq3_hourly_demand_pattern"] = with_silver(f"""
SELECT year, month, pickup_hour, count(*) AS trip_count,
  {msum('total_amount', 'total_revenue')},
  {mavg('trip_distance', 'avg_trip_distance')},
  {mavg('trip_duration_minutes', 'avg_trip_duration_minutes')}
FROM silver GROUP BY year, month, pickup_hour""")

QUERIES["aq4_top_pickup_zones"] = with_silver(f"""
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY year, month
                 ORDER BY trip_count DESC, pickup_location_id) AS INTEGER) AS "rank"
  FROM (
    SELECT year, month, pickup_location_id, count(*) AS trip_count,
      {msum('total_amount', 'total_revenue')},
      {mavg('total_amount', 'avg_total_amount')},
      {mavg('trip_distance', 'avg_trip_distance')}
    FROM silver GROUP BY year, month, pickup_location_id))
WHERE "rank" <= 25""")

QUERIES["dc3_top_pickup_zones_named"] = with_gold("""
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY year, month
                 ORDER BY trip_count DESC, pickup_location_id) AS INTEGER) AS "rank"
  FROM (
    SELECT c.year, c.month, c.PULocationID AS pickup_location_id,
      z.Borough AS borough, z.Zone AS zone, c.trip_count
    FROM (SELECT year, month, PULocationID, count(*) AS trip_count
          FROM nbronze GROUP BY year, month, PULocationID) c
    JOIN zone_lookup z ON c.PULocationID = z.LocationID))
WHERE "rank" <= 10""")


# ---- batch scope -----------------------------------------------------------------------------

# The stored months and the one after the last of them.
_ASKED = """(SELECT year, month FROM (SELECT DISTINCT year, month FROM bronze) UNION ALL
  SELECT CAST(year(d) AS VARCHAR), lpad(CAST(month(d) AS VARCHAR), 2, '0')
  FROM (SELECT max(make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), 1)) + INTERVAL 1 MONTH AS d FROM bronze))"""
QUERIES["io7_silver_partitions_read_back"] = with_silver(
    "SELECT * FROM silver WHERE year || month > (SELECT min(year || month) FROM bronze)")
QUERIES["dc7_run_summary"] = with_silver("""
SELECT b.year || '-' || b.month AS period, b.year, b.month,
  CASE WHEN first THEN 'skipped' ELSE 'written' END AS status,
  CASE WHEN NOT first THEN n END AS bronze_count,
  CASE WHEN NOT first THEN coalesce(k, 0) END AS silver_count,
  CASE WHEN NOT first THEN n - coalesce(k, 0) END AS dropped_count
FROM (SELECT year, month, count(*) AS n, year = (SELECT min(year) FROM bronze) AS first
      FROM bronze GROUP BY year, month) b
LEFT JOIN (SELECT year, month, count(*) AS k FROM silver GROUP BY year, month) s
  ON s.year = b.year AND s.month = b.month""")
QUERIES["sn2_missing_columns"] = with_bronze(f"""
SELECT year, month, count(airport_fee) AS airport_fee_values, {msum('airport_fee', 'airport_fee_sum')},
  count(congestion_surcharge) AS congestion_values, {msum('congestion_surcharge', 'congestion_sum')},
  count(store_and_fwd_flag) AS flag_values, {msum('extra', 'extra_sum')},
  {msum('passenger_count', 'passenger_sum')}
FROM nbronze GROUP BY year, month""")
QUERIES["io5_visible_years"] = with_silver("""
SELECT year, month, count(*) AS trip_count FROM silver
WHERE year BETWEEN '1994' AND '1996' GROUP BY year, month""")
QUERIES["io8_gold_mart_read_back"] = with_gold(MARTS["mart_payment_behavior"])
QUERIES["io9_gold_fact_read_back"] = with_gold("SELECT * FROM fact_trip")
QUERIES["io12_profile_details_read_back"] = QUERIES["pf3_critical_quality"]
QUERIES["io13_profile_summary_read_back"] = with_bronze("," + MONTHLY_SUMMARY + "\nSELECT * FROM monthly_summary")
QUERIES["bm4_january_scope"] = with_silver(f"""
SELECT year, month, count(*) AS trip_count, {msum('total_amount', 'total_revenue')}
FROM silver WHERE month = '01' GROUP BY year, month""")
QUERIES["bm5_pending_months"] = with_silver(f"""
SELECT m.year || '-' || m.month AS period, m.year, m.month,
  CASE WHEN EXISTS (SELECT 1 FROM bronze b WHERE b.year = m.year AND b.month = m.month)
       THEN 'done' ELSE 'pending' END AS status
FROM {_ASKED} m""")
QUERIES["bm6_partition_coverage"] = with_silver(f"""
SELECT m.year || '-' || m.month AS period, m.year, m.month,
  CAST(coalesce(c.n, 0) AS BIGINT) AS trip_count,
  CASE WHEN coalesce(c.n, 0) > 0 THEN 'passed' ELSE 'failed' END AS validation
FROM {_ASKED} m
LEFT JOIN (SELECT year, month, count(*) AS n FROM silver GROUP BY year, month) c
  ON c.year = m.year AND c.month = m.month""")
QUERIES["bm7_gold_completeness"] = with_gold("""
SELECT 'table_has_data' AS "check", t.target, true AS passed
FROM (VALUES ('dim_date'), ('dim_hour'), ('dim_payment_type'), ('dim_rate_code'), ('dim_vendor'),
  ('dim_zone'), ('fact_trip'), ('mart_daily_trip_revenue'), ('mart_hourly_demand'),
  ('mart_pickup_zone_performance'), ('mart_payment_behavior'), ('mart_airport_trip_summary')) t(target)
UNION ALL
SELECT 'fact_month_present', m.year || '-' || m.month,
  EXISTS (SELECT 1 FROM fact_trip f WHERE f.year = m.year AND f.month = m.month)
FROM """ + _ASKED + " m")


# ---- assertions ----------------------------------------------------------------------------------

def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def _assertion_sql(a) -> str:
    head = f"SELECT '{a.model}' AS model, '{a.column}' AS column_name, '{a.test}' AS test_name, "
    col = f'"{a.column}"'
    if a.test == "not_null":
        body = f"count(*) FILTER (WHERE {col} IS NULL) AS failures FROM {a.model}"
    elif a.test == "accepted_values":
        vals = ", ".join(_lit(v) for v in a.argument)
        body = (f"count(*) FILTER (WHERE {col} IS NOT NULL AND {col} NOT IN ({vals})) "
                f"AS failures FROM {a.model}")
    elif a.test == "unique":
        body = (f"(SELECT count(*) FROM (SELECT {col} FROM {a.model} WHERE {col} IS NOT NULL "
                f"GROUP BY {col} HAVING count(*) > 1)) AS failures")
    else:  # relationships
        parent, pcol = a.argument
        body = (f"count(*) AS failures FROM {a.model} c LEFT JOIN {parent} p "
                f"ON c.{col} = p.\"{pcol}\" WHERE c.{col} IS NOT NULL AND p.\"{pcol}\" IS NULL")
    return head + body


def assertions_sql(assertions) -> str:
    marts = ",\n".join(f"{name} AS ({body})" for name, body in MARTS.items())
    union = "\nUNION ALL\n".join(f"({_assertion_sql(a)})" for a in assertions)
    return with_gold(f""",
{marts}
SELECT model, column_name, test_name, CAST(failures AS BIGINT) AS failures,
  failures = 0 AS passed
FROM (
{union}
)""")


def _register_assertions():
    import sys
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from fareflow.operators import checks  # the declared assertion list (data)
    QUERIES["qt_core_assertions"] = assertions_sql(checks.CORE_ASSERTIONS)
    QUERIES["qt_mart_assertions"] = assertions_sql(checks.MART_ASSERTIONS)
    QUERIES["qt5_default_selection"] = assertions_sql(checks.default_selection())
    QUERIES["qt_domain_assertions"] = assertions_sql(checks.SILVER_ASSERTIONS)


_register_assertions()
