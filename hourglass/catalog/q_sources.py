"""Payload sources (S5-S8): payloads are derived from the events mapping (one
JSON document per series and day), then parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourglass.catalog import register
from hourglass.catalog.common import KEYS, TS, events, rounded
from hourglass.checks.sqlfrag import RAW_HOURLY_CTE, r6
from hourglass.sources import payloads as PL
from hourglass.sources.events import air_side

# Unit per air-quality variable, as the provider labels them.
AIR_UNITS = {
    "us_aqi": "USAQI",
    "pm2_5": "μg/m³",
    "pm10": "μg/m³",
    "carbon_monoxide": "μg/m³",
    "nitrogen_dioxide": "μg/m³",
    "sulphur_dioxide": "μg/m³",
    "ozone": "μg/m³",
}
VARS = list(AIR_UNITS)
LAT, LON = 34.0, 71.5


def _parsed(spark, sf):
    air = air_side(events(spark, sf))
    p = PL.build_payloads(air, KEYS, TS, VARS, AIR_UNITS, F.lit(LAT), F.lit(LON))
    return PL.parse_payloads(p, "payload", VARS)


@register("payload_flatten", f"WITH {RAW_HOURLY_CTE}\nSELECT location_id, timestamp, "
                             + ", ".join(r6(v, v) for v in VARS) + " FROM air")
def q_payload_flatten(spark, sf):
    """Daily JSON payloads per series, parsed and flattened back to hourly rows."""
    return rounded(PL.flatten_hourly(_parsed(spark, sf), VARS, KEYS, TS))


@register("payload_profile", f"WITH {RAW_HOURLY_CTE}\nSELECT location_id, date_trunc('day', timestamp) AS period, "
                             f"CAST({len(VARS)} AS INTEGER) AS variables, CAST(count(*) AS INTEGER) AS records, "
                             f"CAST({LAT} AS DOUBLE) AS latitude, CAST({LON} AS DOUBLE) AS longitude FROM air GROUP BY 1, 2")
def q_payload_profile(spark, sf):
    """Per payload: variables present, hourly records, coordinates."""
    return rounded(PL.payload_profile(_parsed(spark, sf), VARS, [*KEYS, "period"]))


@register("payload_units", f"WITH {RAW_HOURLY_CTE}, p AS (SELECT DISTINCT location_id, date_trunc('day', timestamp) AS period FROM air),\n"
                           "u AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in AIR_UNITS.items())
                           + ") t(variable, unit))\nSELECT variable, unit, count(*) AS payloads FROM p, u GROUP BY 1, 2")
def q_payload_units(spark, sf):
    """The unit of every variable, with the number of payloads stating it."""
    return PL.payload_units(_parsed(spark, sf)).groupBy("variable", "unit").agg(F.count(F.lit(1)).alias("payloads"))


@register("payload_preview", f"WITH {RAW_HOURLY_CTE}\nSELECT location_id, date_trunc('day', timestamp) AS period, "
                             "CAST(row_number() OVER (PARTITION BY location_id, date_trunc('day', timestamp) ORDER BY timestamp) - 1 AS INTEGER) AS pos, "
                             f"timestamp, {r6('us_aqi', 'us_aqi')}, {r6('pm2_5', 'pm2_5')} FROM air "
                             "QUALIFY pos < 5")
def q_payload_preview(spark, sf):
    """The first 5 hours of AQI and PM2.5 in each payload."""
    return rounded(PL.payload_preview(_parsed(spark, sf), ["us_aqi", "pm2_5"], [*KEYS, "period"], 5))
