"""DuckDB SQL fragments that state the same mappings as the Spark code.

These are test oracles only: plain SQL text the DuckDB twin of each
registered query is written in.
"""

from __future__ import annotations

from hourglass.schema import DEFAULT_SPEC, FeatureSpec

def qz(expr: str, digits: int) -> str:
    """SQL twin of ``hourglass.functions.numeric.quantize``."""
    s = f"CAST({10 ** digits} AS DOUBLE)"
    x = f"CAST({expr} AS DOUBLE)"
    return f"(CASE WHEN abs({x}) < CAST(9007199254740992 AS DOUBLE) THEN round_even({x} * {s}, 0) / {s} ELSE {x} END + CAST(0 AS DOUBLE))"


def r6(expr: str, alias: str | None = None) -> str:
    """Rounded double as the Spark side rounds it (6 places, no negative zero)."""
    return qz(expr, 6) + (f" AS {alias}" if alias else "")


def errors_sql(actual: str, pred: str, n: str = "n", rounded: bool = True) -> str:
    """n, skipped, mae, rmse, r2 over the rows of a group that have both sides."""
    e, own = f"({actual} - {pred})", f"CASE WHEN {pred} IS NOT NULL THEN {actual} END"
    f = r6 if rounded else (lambda x, a: f"{x} AS {a}")
    return (f"count({e}) AS {n}, count(*) - count({e}) AS skipped, {f(f'avg(abs({e}))', 'mae')}, {f(f'sqrt(avg({e} * {e}))', 'rmse')}, "
            f"{f(f'CASE WHEN var_pop({own}) > 0 THEN 1.0 - sum({e} * {e}) / (count({e}) * var_pop({own})) END', 'r2')}")


# events -> raw hourly table (see hourglass.sources.events)
def _raw_hourly_cte() -> str:
    def q(e):
        return qz(e, 9)
    return f"""
air AS (
  SELECT event_type AS location_id, date_trunc('hour', ts) AS timestamp,
         {q('avg(value)')} AS us_aqi, max(value) AS pm2_5, min(value) AS pm10, {q('sum(value)')} AS carbon_monoxide,
         CAST(count(*) AS DOUBLE) AS nitrogen_dioxide, CAST(count(DISTINCT user_id) AS DOUBLE) AS sulphur_dioxide,
         max(value) - min(value) AS ozone
  FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL
  GROUP BY 1, 2
),
weather AS (
  SELECT date_trunc('hour', ts) AS timestamp, {q('avg(value)')} AS temperature_2m, count(*) AS relative_humidity_2m,
         max(value) AS pressure_msl, {q('sum(value)')} AS precipitation, min(value) AS wind_speed_10m,
         count(DISTINCT user_id) AS wind_direction_10m
  FROM events WHERE ts IS NOT NULL
  GROUP BY 1
),
raw AS (
  SELECT a.location_id, a.timestamp, w.temperature_2m, w.relative_humidity_2m, w.pressure_msl, w.precipitation,
         w.wind_speed_10m, w.wind_direction_10m, a.us_aqi, a.pm2_5, a.pm10, a.carbon_monoxide,
         a.nitrogen_dioxide, a.sulphur_dioxide, a.ozone
  FROM air a JOIN weather w ON a.timestamp = w.timestamp
)"""


RAW_HOURLY_CTE = _raw_hourly_cte()

W = "PARTITION BY location_id ORDER BY timestamp"


def features_select(spec: FeatureSpec = DEFAULT_SPEC, src: str = "raw", w: str = W, align: str = "target") -> str:
    """SELECT producing the feature table (before dropping incomplete rows)."""
    t = spec.target_source
    cols = ["*",
            "CAST(hour(timestamp) AS INTEGER) AS hour",
            "CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week",
            "CAST(day(timestamp) AS INTEGER) AS day_of_month",
            "CAST(month(timestamp) AS INTEGER) AS month",
            "CAST(isodow(timestamp) >= 6 AS INTEGER) AS is_weekend"]
    cols += [f"lag({t}, {k}) OVER ({w}) AS {spec.target_alias}_lag_{k}" for k in spec.aqi_lags]
    cols += [f"lead({t}, 1) OVER ({w}) AS {spec.target}"]
    cols += [f"lag({p}, {k}) OVER ({w}) AS {p}_lag_{k}" for p in spec.pollutants for k in spec.pollutant_lags]
    for name, c, width in spec.mean_cols():
        if align == "reference":
            m = prior_mean(c, width - 1, w) if c == t and width > 1 else trailing_mean(c, width, w)
        else:
            m = prior_mean(c, width, w)
        cols.append(f"{m} AS {name}")
    for name, c, k in spec.change_cols():
        if align == "reference" and c == t:
            cols.append(f"lag({c}, 1) OVER ({w}) - lag({c}, {k + 1}) OVER ({w}) AS {name}")
        else:
            cols.append(f"{c} - lag({c}, {k}) OVER ({w}) AS {name}")
    return "SELECT " + ",\n  ".join(cols) + f"\nFROM {src}"


def prior_mean(c: str, width: int, w: str = W) -> str:
    """(lag w + ... + lag 1) / w: the order Spark's sliding frame sums in."""
    return "(" + " + ".join(f"lag({c}, {i}) OVER ({w})" for i in range(width, 0, -1)) + f") / CAST({width} AS DOUBLE)"


def trailing_mean(c: str, width: int, w: str = W) -> str:
    vals = [f"lag({c}, {i}) OVER ({w})" for i in range(width - 1, 0, -1)] + [c]
    tot = " + ".join(f"coalesce({v}, 0.0)" for v in vals)
    cnt = " + ".join(f"CAST({v} IS NOT NULL AS INTEGER)" for v in vals)
    return f"CASE WHEN ({cnt}) = 0 THEN NULL ELSE ({tot}) / CAST(({cnt}) AS DOUBLE) END"


def not_null_all(cols) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


FEATURES_CTE = (RAW_HOURLY_CTE + ",\nfeat_all AS (\n" + features_select() + "\n),\nfeat AS (SELECT * FROM feat_all WHERE "
                + not_null_all(DEFAULT_SPEC.feature_columns() + [DEFAULT_SPEC.target]) + ")")


def rounded_select(columns_types: dict[str, str], src: str) -> str:
    parts = [r6(c, c) if t in ("double", "float") else c for c, t in columns_types.items()]
    return "SELECT " + ", ".join(parts) + f" FROM {src}"


def dbl(v: float) -> str:
    """A DOUBLE literal that parses to exactly the same IEEE value."""
    return "%.17e" % float(v)


def exog_sql(b0: float, beta: dict, spec: FeatureSpec = DEFAULT_SPEC) -> str:
    """The part of the prediction that does not read the target's own series (whose
    features start with its alias)."""
    e = dbl(b0)
    for c in spec.feature_columns():
        if not c.startswith(f"{spec.target_alias}_") and beta.get(c, 0.0):
            e = f"{e} + {dbl(beta[c])} * CAST({c} AS DOUBLE)"
    return e


def recurrent_sql(name: str, align: str, spec: FeatureSpec, acc: str = "r.acc") -> str:
    """A feature of the target's own series from the values before the hour that is
    predicted (``acc[-1]`` is the hour before it), stated apart from the engine."""
    kind, _, size = name.removeprefix(f"{spec.target_alias}_").rpartition("_")
    at = 1 if align == "target" else 0  # the feature row is the hour before, or the hour itself
    if kind == "lag":
        return f"{acc}[-{int(size) + at}]"
    if kind == "change":
        return f"({acc}[-1] - {acc}[-{int(size.removesuffix('h')) + 1}])"
    w = int(name.removeprefix(f"{spec.target_alias}_").split("h_")[0]) - (align != "target")
    return "((" + " + ".join(f"{acc}[-{i + at}]" for i in range(1, w + 1)) + f") / CAST({w} AS DOUBLE))"


def forecast_sql(b0: float, beta: dict, horizon: int = 72, align: str = "target",
                 spec: FeatureSpec = DEFAULT_SPEC) -> str:
    """DuckDB recursive-CTE twin of ``recursive_forecast_linear`` on the events
    mapping (returns the CTE chain ending in ``fc``).  It rebuilds the target's
    lags, means and changes from the array at each step."""
    own = [c for c in spec.feature_columns() if c.startswith(f"{spec.target_alias}_") and beta.get(c, 0.0)]
    depth = 1 + max([*spec.aqi_lags, *spec.aqi_windows, *spec.aqi_changes])
    v = " + ".join(["b.e[r.step + 1]", *[f"{dbl(beta[c])} * {recurrent_sql(c, align, spec)}" for c in own]])
    if align == "target":
        ex_rows, ts_col = f"_rd >= 2 AND _rd <= {horizon + 1}", "_next_ts"
    else:
        ex_rows, ts_col = f"_rd <= {horizon}", "timestamp"
    return f"""{RAW_HOURLY_CTE},
f AS ({features_select(spec, align=align)}),
pos AS (SELECT *, lead(timestamp) OVER ({W}) AS _next_ts,
        row_number() OVER (PARTITION BY location_id ORDER BY timestamp DESC) AS _rd, {exog_sql(b0, beta, spec)} AS _exog FROM f),
hist AS (SELECT location_id, list(CAST({spec.target_source} AS DOUBLE) ORDER BY timestamp) AS h FROM pos
         WHERE _rd > {horizon} AND _rd <= {horizon + depth} GROUP BY 1),
ex AS (SELECT location_id, list(_exog ORDER BY timestamp) AS e, list({ts_col} ORDER BY timestamp) AS t FROM pos
       WHERE {ex_rows} GROUP BY 1),
base AS (SELECT ex.location_id, ex.e, ex.t, coalesce(hist.h, []) AS h FROM ex LEFT JOIN hist ON ex.location_id = hist.location_id),
rec(location_id, step, acc) AS (
  SELECT location_id, 0, h FROM base
  UNION ALL
  SELECT r.location_id, r.step + 1,
         list_append(r.acc, CASE WHEN ({v}) < CAST(0 AS DOUBLE) THEN CAST(0 AS DOUBLE) ELSE ({v}) END)
  FROM rec r JOIN base b ON r.location_id = b.location_id WHERE r.step < len(b.e)
),
fc AS (SELECT r.location_id, b.t[r.step] AS timestamp, CAST(r.step AS INTEGER) AS step,
              CAST(floor((r.step - 1) / 24) + 1 AS INTEGER) AS forecast_day, r.acc[-1] AS predicted_aqi
       FROM rec r JOIN base b ON r.location_id = b.location_id WHERE r.step > 0)"""
