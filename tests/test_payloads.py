import json

from hourglass.sources import payloads as PL


def _payload(times, aqi, pm, units=True):
    body = {"latitude": 34.0, "longitude": 71.5, "hourly": {"time": times, "us_aqi": aqi, "pm2_5": pm}}
    if units:
        body["hourly_units"] = {"time": "iso8601", "us_aqi": "USAQI", "pm2_5": "μg/m³"}
    return json.dumps(body)


def test_flatten_profile_units_preview(spark):
    docs = [
        ("a", _payload(["2024-01-01T00:00", "2024-01-01T01:00", "2024-01-01T02:00"], [10.0, None, 30.0], [1.0, 2.0, 3.0])),
        ("b", _payload([], [], [])),
    ]
    df = spark.createDataFrame(docs, "src string, doc string")
    parsed = PL.parse_payloads(df, "doc", ["us_aqi", "pm2_5"])
    flat = PL.flatten_hourly(parsed, ["us_aqi", "pm2_5"], ["src"]).orderBy("timestamp").collect()
    assert [r.us_aqi for r in flat] == [10.0, None, 30.0]
    assert str(flat[1].timestamp) == "2024-01-01 01:00:00"
    prof = {r.src: (r.variables, r.records) for r in PL.payload_profile(parsed, ["us_aqi", "pm2_5"], ["src"]).collect()}
    assert prof == {"a": (2, 3), "b": (2, 0)}
    units = {(r.variable, r.unit) for r in PL.payload_units(parsed).collect()}
    assert ("us_aqi", "USAQI") in units and ("time", "iso8601") in units
    prev = PL.payload_preview(parsed, ["us_aqi"], ["src"], 2).collect()
    assert [r.pos for r in prev] == [0, 1]


def test_join_two_providers_drops_non_overlap(spark):
    from hourglass.operators.joins import join_hourly

    w = spark.createDataFrame([("2024-01-01T00:00", 1.0), ("2024-01-01T01:00", 2.0)], "t string, temperature_2m double") \
        .selectExpr("to_timestamp_ntz(t) AS timestamp", "temperature_2m")
    a = spark.createDataFrame([("2024-01-01T01:00", 5.0), ("2024-01-01T02:00", 6.0)], "t string, us_aqi double") \
        .selectExpr("to_timestamp_ntz(t) AS timestamp", "us_aqi")
    j = join_hourly(w, a, ["timestamp"]).collect()
    assert len(j) == 1 and j[0].us_aqi == 5.0 and j[0].temperature_2m == 2.0
