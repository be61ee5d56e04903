"""Row rules and flags held as data.

One table of critical rules (CR) drives the Silver filter, the rejected set
and the reconciliation counts; one table of warning (WF) and one of outlier
(OF) flags drives the Silver flag columns.  Each entry is a plain built-in
``Column`` so the whole set compiles into one whole-stage-codegen projection.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareflow.functions.expressions import any_of

# Accepted domains and thresholds of the flag rules.
VENDOR_DOMAIN = [1, 2]
PAYMENT_TYPE_DOMAIN = [1, 2, 3, 4, 5, 6]
RATECODE_DOMAIN = [1, 2, 3, 4, 5, 6, 99]
STORE_AND_FWD_DOMAIN = ["Y", "N"]
LOCATION_MIN, LOCATION_MAX = 1, 265
VERY_LONG_DISTANCE_MILES = 100
VERY_LONG_DURATION_MINUTES = 1440
EXTREME_SPEED_MPH = 120
SHORT_DISTANCE_MILES = 0.1
HIGH_FARE = 100
SHORT_DURATION_MINUTES = 90
# Optional stricter payment rule documented for Silver (off by default).
STRICT_PAYMENT_DOMAIN = [1, 2, 3, 4]


@dataclass(frozen=True)
class Rule:
    rule_id: str
    name: str
    keep: Callable[[], Column]  # TRUE when the row passes; NULL rejects


def _c(name: str) -> Column:
    return F.col(name)


def critical_rules(window_start: Column | None, window_end: Column | None,
                   strict_payment_domain: bool = False) -> list[Rule]:
    """The 16 Silver admission rules over raw (Bronze) column names.

    ``window_start``/``window_end`` bound the pickup to the batch month
    (half-open); pass ``None`` to leave the window rules out.
    """
    pu, do = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    rules = [
        Rule("CR1", "pickup_not_null", lambda: _c(pu).isNotNull()),
        Rule("CR2", "dropoff_not_null", lambda: _c(do).isNotNull()),
        Rule("CR3", "dropoff_after_pickup", lambda: _c(do) > _c(pu)),
    ]
    if window_start is not None:
        rules += [
            Rule("CR4", "pickup_on_or_after_month_start", lambda: _c(pu) >= window_start),
            Rule("CR5", "pickup_before_next_month", lambda: _c(pu) < window_end),
        ]
    rules += [
        Rule("CR6", "distance_not_null", lambda: _c("trip_distance").isNotNull()),
        Rule("CR7", "distance_positive", lambda: _c("trip_distance") > 0),
        Rule("CR8", "passengers_not_null", lambda: _c("passenger_count").isNotNull()),
        Rule("CR9", "passengers_positive", lambda: _c("passenger_count") > 0),
        Rule("CR10", "fare_not_null", lambda: _c("fare_amount").isNotNull()),
        Rule("CR11", "fare_not_negative", lambda: _c("fare_amount") >= 0),
        Rule("CR12", "total_not_null", lambda: _c("total_amount").isNotNull()),
        Rule("CR13", "total_not_negative", lambda: _c("total_amount") >= 0),
        Rule("CR14", "pickup_location_not_null", lambda: _c("PULocationID").isNotNull()),
        Rule("CR15", "dropoff_location_not_null", lambda: _c("DOLocationID").isNotNull()),
        Rule("CR16", "payment_type_not_null", lambda: _c("payment_type").isNotNull()),
    ]
    if strict_payment_domain:
        rules.append(Rule("DC4", "payment_type_standard",
                          lambda: _c("payment_type").isin(*STRICT_PAYMENT_DOMAIN)))
    return rules


def conjunction(rules: list[Rule]) -> Column:
    """Plain AND of the rules, for ``filter``: NULL rejects there anyway, and
    a bare conjunction lets Catalyst split it and push each rule that
    compares a column with a literal down to the parquet scan."""
    if not rules:
        return F.lit(True)
    return _and_all([r.keep() for r in rules])


def passes_all(rules: list[Rule]) -> Column:
    """Conjunction of the rules as a two-valued flag (NULL -> false), for
    counting and for selecting the rejected complement."""
    if not rules:
        return F.lit(True)
    return F.coalesce(_and_all([r.keep() for r in rules]), F.lit(False))


def _and_all(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out & c
    return out


def failed_rule_ids(rules: list[Rule]) -> Column:
    """Array of the ids of the rules a row fails (NULL counts as a failure)."""
    return F.filter(
        F.array(*[F.when(F.coalesce(r.keep(), F.lit(False)), F.lit(None))
                  .otherwise(F.lit(r.rule_id)) for r in rules]),
        lambda x: x.isNotNull())


def _out_of_domain(name: str, domain: list) -> Column:
    return _c(name).isNotNull() & ~_c(name).isin(*domain)


def warning_flags() -> list[tuple[str, Column]]:
    """WF1-WF9 over the cleaned, fee-filled Bronze names plus duration."""
    return [
        ("is_invalid_vendor", _out_of_domain("VendorID", VENDOR_DOMAIN)),
        ("is_invalid_payment_type_domain", _out_of_domain("payment_type", PAYMENT_TYPE_DOMAIN)),
        ("is_invalid_ratecode", _out_of_domain("RatecodeID", RATECODE_DOMAIN)),
        ("is_invalid_store_and_fwd_flag",
         _out_of_domain("store_and_fwd_flag", STORE_AND_FWD_DOMAIN)),
        ("has_negative_fee_component", any_of(_c(f) < 0 for f in [
            "extra", "mta_tax", "tip_amount", "tolls_amount",
            "improvement_surcharge", "congestion_surcharge", "airport_fee"])),
        ("is_pickup_location_out_of_range",
         (_c("PULocationID") < LOCATION_MIN) | (_c("PULocationID") > LOCATION_MAX)),
        ("is_dropoff_location_out_of_range",
         (_c("DOLocationID") < LOCATION_MIN) | (_c("DOLocationID") > LOCATION_MAX)),
        ("is_very_long_distance", _c("trip_distance") > VERY_LONG_DISTANCE_MILES),
        ("is_very_long_duration", _c("trip_duration_minutes") > VERY_LONG_DURATION_MINUTES),
    ]


def outlier_flags() -> list[tuple[str, Column]]:
    """OF2-OF5 (OF1 is informational and not part of the outlier OR)."""
    short_high_fare = ((_c("trip_distance") < SHORT_DISTANCE_MILES)
                       & (_c("fare_amount") > HIGH_FARE))
    return [
        ("is_extreme_speed", _c("avg_speed_mph") > EXTREME_SPEED_MPH),
        ("is_fare_distance_mismatch", short_high_fare),
        ("is_distance_duration_mismatch",
         (_c("trip_distance") > VERY_LONG_DISTANCE_MILES)
         & (_c("trip_duration_minutes") < SHORT_DURATION_MINUTES)),
        ("is_same_zone_high_fare",
         (_c("PULocationID") == _c("DOLocationID")) & short_high_fare),
    ]
