"""Horizon inputs, recursive multi-step forecast and backtest.

The recursive forecast is the only sequential operator.  For a linear model,
the prediction of hour ``p`` is ``clamp(exog_p + sum_d gamma_d * A[p - d])``
where ``A`` is the AQI series (observed, then predicted) and ``gamma`` collects
every AQI-dependent feature's coefficient by offset.  Per series we gather two
bounded arrays (the last ``max_d`` observed values, the horizon's exogenous
parts) and run ``aggregate()`` as a fold: pure Catalyst, no Python rows,
parallel across series.  Tree models step the horizon once per hour over all
series (``recursive_forecast_stepwise``), with reliable checkpoints.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.functions.calendar import calendar_columns, hour_grid
from hourglass.operators.aggregates import attach_scalars
from hourglass.operators.joins import attach_one_to_one, join_hourly, keep_hours
from hourglass.operators.setops import upsert_by_time
from hourglass.plans.features import build_features
from hourglass.plans.trees import TreeModel, sum_sql
from hourglass.schema import BLOCK_HOURS, DEFAULT_SPEC, FORECAST_HORIZON, FeatureSpec


# --------------------------------------------------------------------------- recurrence weights
def aqi_dependent(spec: FeatureSpec = DEFAULT_SPEC) -> list[str]:
    """Feature names computed from the target series itself."""
    a = spec.target_alias
    return (spec.aqi_lag_cols() + [n for n, c, _ in spec.mean_cols() if c == spec.target_source]
            + [n for n, c, _ in spec.change_cols() if c == spec.target_source]) if a else []


def offset_weights(beta: dict, spec: FeatureSpec = DEFAULT_SPEC, align: str = "target") -> dict[int, float]:
    """gamma_d: weight of ``A[p - d]`` in the prediction of hour ``p``.

    ``align="target"``: hour ``p`` is predicted from the feature row of
    ``p - 1`` (training alignment: lag k -> d = k + 1, prior mean over
    d = 2..w+1, change k -> +d 1, -d k+1).
    ``align="reference"``: the row of ``p`` itself with ``A[p]`` unknown
    (lag k -> d = k, mean over the w - 1 known hours, change k -> lag 1 - lag k+1).
    """
    g: dict[int, float] = {}

    def add(d, v):
        g[d] = g.get(d, 0.0) + v

    shift = 1 if align == "target" else 0
    for k in spec.aqi_lags:
        b = beta.get(f"{spec.target_alias}_lag_{k}", 0.0)
        if b:
            add(k + shift, b)
    for name, col, w in spec.mean_cols():
        if col != spec.target_source or not beta.get(name, 0.0):
            continue
        b = beta[name]
        n = w if align == "target" else w - 1
        for i in range(1, n + 1):
            add(i + shift, b / n)
    for name, col, k in spec.change_cols():
        if col != spec.target_source or not beta.get(name, 0.0):
            continue
        b = beta[name]
        add(1, b)
        add(k + 1, -b)
    return dict(sorted((d, v) for d, v in g.items() if v != 0.0))


def exog_expr(b0: float, beta: dict, spec: FeatureSpec = DEFAULT_SPEC) -> Column:
    """Intercept plus the non-recursive part of the prediction, in feature order."""
    dep = set(aqi_dependent(spec))
    e = F.lit(float(b0))
    for c in spec.feature_columns():
        if c not in dep and beta.get(c, 0.0):
            e = e + F.lit(float(beta[c])) * F.col(c).cast("double")
    return e


def _clamp(v: Column) -> Column:
    return F.when(v < F.lit(0.0), F.lit(0.0)).otherwise(v)


# --------------------------------------------------------------------------- series that cannot be forecast
def needed_hours(spec: FeatureSpec = DEFAULT_SPEC, align: str = "target") -> dict[str, int]:
    """How many hours before the horizon each feature of the target series reads."""
    shift = 1 if align == "target" else 0
    src = spec.target_source
    out = {f"{spec.target_alias}_lag_{k}": k + shift for k in spec.aqi_lags}
    out |= {n: (w if align == "target" else w - 1) + shift for n, c, w in spec.mean_cols() if c == src}
    return out | {n: k + 1 for n, c, k in spec.change_cols() if c == src}


def forecast_status(features: DataFrame, keys: Sequence[str] = ("location_id",), ts: str = "timestamp",
                    horizon: int = FORECAST_HORIZON, align: str = "target", spec: FeatureSpec = DEFAULT_SPEC,
                    used: Sequence[str] | None = None) -> DataFrame:
    """One row per series: rows, history (hours before the horizon), null_history (those
    without a value), status (``ok``, ``short`` or ``nulls``) and the features (``used``;
    all by default) that cannot be computed at the first horizon hour."""
    need = {n: d for n, d in needed_hours(spec, align).items() if used is None or n in used}
    depth = max(need.values(), default=1)
    rd = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(ts).desc()))
    pos = features.select(*keys, F.col(spec.target_source).alias("_v"), (rd - horizon).alias("_d"))
    g = pos.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.greatest(F.lit(0), F.max("_d")).cast("long").alias("history"),
        F.count_if(F.col("_d").between(1, depth) & F.col("_v").isNull()).alias("null_history"),
        F.min(F.when((F.col("_d") >= 1) & F.col("_v").isNull(), F.col("_d"))).alias("_hole"))
    reach = F.least(F.col("history"), F.coalesce(F.col("_hole") - 1, F.col("history")))
    names = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(d).alias("d")) for n, d in sorted(need.items())])
    missing = F.transform(F.filter(names, lambda x: x["d"] > reach), lambda x: x["n"])
    status = F.when(F.col("history") < depth, "short").when(F.col("null_history") > 0, "nulls").otherwise("ok")
    return g.select(*keys, "rows", "history", "null_history", status.alias("status"), F.array_join(missing, ",").alias("missing_features"))


def _refuse(keys: Sequence[str], predicted: Column, missing: Column) -> Column:
    """``predicted``, or a failure that names the series and the features it lacks."""
    name = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    fail = F.raise_error(F.concat(F.lit("NULL features in the forecast of series "), name, F.lit(": "), missing))
    return F.when(predicted.isNotNull(), predicted).otherwise(fail.cast("double"))


# --------------------------------------------------------------------------- M14 (linear)
def recursive_forecast_linear(features: DataFrame, b0: float, beta: dict, keys: Sequence[str] = ("location_id",),
                              ts: str = "timestamp", horizon: int = FORECAST_HORIZON, align: str = "target",
                              spec: FeatureSpec = DEFAULT_SPEC, clamp: bool = True, on_null: str = "raise") -> DataFrame:
    """Roll a linear model ``horizon`` rows past each series' boundary.

    A series whose features are NULL (too short a history, or holes in it) fails the
    job, naming it and them; with ``on_null="keep"`` its hours come back without a
    prediction (``forecast_status`` lists such series).  No series is left out.

    ``features``: full feature table (``build_features(..., drop_incomplete=False)``)
    holding history *and* the ``horizon`` rows to forecast, whose exogenous
    inputs are known (observed in a backtest, provider forecasts live).  The
    boundary of each series is the row ``horizon`` rows before its end.
    Output: keys, ts, step (1..horizon), forecast_day, predicted_aqi.
    """
    keys = list(keys)
    gamma = offset_weights(beta, spec, align)
    depth = max(gamma) if gamma else 1
    src = spec.target_source
    w = Window.partitionBy(*keys).orderBy(ts)
    rd = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(ts).desc()))
    pos = features.select(*keys, ts, src, F.lead(ts, 1).over(w).alias("_next_ts"),
                          exog_expr(b0, beta, spec).alias("_exog"), rd.alias("_rd"))
    # history: A[B - depth + 1 .. B], B = row at _rd = horizon + 1
    hist = (pos.filter((F.col("_rd") > horizon) & (F.col("_rd") <= horizon + depth))
               .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(ts, src))).alias("_h"))
               .select(*keys, F.transform("_h", lambda s: s[src].cast("double")).alias("_hist")))
    if align == "target":  # rows B .. B+horizon-1 predict the following row's hour
        rows = pos.filter((F.col("_rd") >= 2) & (F.col("_rd") <= horizon + 1)).select(*keys, ts, F.col("_next_ts").alias("_ts"), "_exog")
    else:                  # rows B+1 .. B+horizon predict their own hour
        rows = pos.filter(F.col("_rd") <= horizon).select(*keys, ts, F.col(ts).alias("_ts"), "_exog")
    ex = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(ts, "_ts", "_exog"))).alias("_e"))

    def step(acc, e):
        v = e["_exog"]
        for d, gv in gamma.items():
            v = v + F.lit(float(gv)) * F.try_element_at(acc, F.lit(-d))
        return F.concat(acc, F.array(_clamp(v) if clamp else v))

    none = F.array().cast("array<double>")
    folded = ex.join(hist, keys, "left").withColumn("_hist", F.coalesce("_hist", none)).select(
        *keys, "_e", F.size("_hist").alias("_n0"),
        F.aggregate("_e", F.col("_hist"), step).alias("_acc"))
    out = folded.select(*keys, F.posexplode(F.arrays_zip(
        F.transform("_e", lambda s: s["_ts"]).alias("t"),
        F.slice("_acc", F.col("_n0") + 1, F.size("_e")).alias("p"))).alias("_i", "_z"), "_n0")
    if on_null == "raise":
        used = {n: d for n, d in needed_hours(spec, align).items() if beta.get(n)}
        short = F.filter(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(d).alias("d")) for n, d in used.items()]), lambda x: x["d"] > F.col("_n0")) if used else None
        names = F.array_join(F.transform(short, lambda x: x["n"]), ", ") if used else F.lit("")
        lack = F.concat(F.lit("history of "), F.col("_n0").cast("string"), F.lit(" hours; "), names)
        out = out.withColumn("_z", F.struct(F.col("_z.t").alias("t"), _refuse(keys, F.col("_z.p"), lack).alias("p")))
    return out.select(*keys, F.col("_z.t").alias(ts), (F.col("_i") + 1).cast("int").alias("step"),
                      (F.floor(F.col("_i") / BLOCK_HOURS) + 1).cast("int").alias("forecast_day"),
                      F.col("_z.p").alias("predicted_aqi"))


# --------------------------------------------------------------------------- M14 (any model)
def recursive_forecast_stepwise(features: DataFrame, fitted, keys: Sequence[str] = ("location_id",),
                                ts: str = "timestamp", horizon: int = FORECAST_HORIZON, align: str = "target",
                                spec: FeatureSpec = DEFAULT_SPEC, checkpoint_every: int = 8,
                                on_null: str = "raise") -> DataFrame:
    """M14 for models without a closed recurrence (trees): one distributed
    ``transform`` per horizon hour over *all* series at once.  The loop runs
    ``horizon`` times regardless of data size; lineage is cut with reliable
    checkpoints in ``spark.checkpoint.dir`` so a lost executor recomputes from
    the last checkpoint, never from the source.  Series with NULL features are
    treated as in the linear form: named in a failure, or kept without predictions."""
    from hourglass.operators.guards import ContractError
    from hourglass.session import materialize, write_table

    keys = list(keys)
    src = spec.target_source
    dep = aqi_dependent(spec)
    depth = max([*spec.aqi_lags, *[w for _, c, w in spec.mean_cols() if c == src],
                 *[k for _, c, k in spec.change_cols() if c == src]]) + 1
    w = Window.partitionBy(*keys).orderBy(ts)
    rd = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(ts).desc()))
    base = features.select("*", F.lead(ts, 1).over(w).alias("_next_ts"), rd.alias("_rd"))
    state = (base.filter((F.col("_rd") > horizon) & (F.col("_rd") <= horizon + depth))
                 .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(ts, src))).alias("_h"))
                 .select(*keys, F.transform("_h", lambda s: s[src].cast("double")).alias("_acc")))
    if align == "target":
        rows = base.filter((F.col("_rd") >= 2) & (F.col("_rd") <= horizon + 1)).withColumn("_ts", F.col("_next_ts"))
        rows = rows.withColumn("_step", (F.lit(horizon + 2) - F.col("_rd")).cast("int"))
    else:
        rows = base.filter(F.col("_rd") <= horizon).withColumn("_ts", F.col(ts))
        rows = rows.withColumn("_step", (F.lit(horizon + 1) - F.col("_rd")).cast("int"))
    rows = rows.drop(*dep)
    # Written once: every step reads its hour from these two small tables
    # (horizon rows and one state row per series), never the window plan.
    # The state keeps each prediction appended to its history array, so the
    # loop is one chain of per-hour joins with no growing union of branches.
    rows = materialize(rows)
    state = materialize(state.withColumn("_n0", F.size("_acc")))
    # A model scores complete rows only: enough known hours, no NULL in the other inputs.
    other = [c for c in spec.feature_columns() if c not in dep]
    holes = rows.groupBy(*keys).agg(F.count_if(F.greatest(*[F.col(c).isNull().cast("int") for c in other]) > 0).alias("_holes"))
    judged = holes.join(state, keys, "left").withColumn("_ok", F.coalesce(
        (F.col("_n0") >= depth) & ~F.exists("_acc", lambda v: v.isNull()) & (F.col("_holes") == 0), F.lit(False)))
    if on_null == "raise":
        bad = judged.filter(~F.col("_ok")).select(*keys, "_n0", "_holes").take(5)
        if bad:
            names = sorted(n for n, d in needed_hours(spec, align).items() if any((r["_n0"] or 0) < d for r in bad))
            raise ContractError(f"NULL features in the forecast of series {[tuple(r[k] for k in keys) for r in bad]}: {names or 'exogenous inputs'}")
    whole = rows
    ok = judged.filter("_ok").select(*keys)
    rows, state = rows.join(ok, keys, "left_semi"), state.join(ok, keys, "left_semi")
    rows, state = materialize(rows), materialize(state)
    shift = 1 if align == "target" else 0
    for h in range(1, horizon + 1):
        cur = rows.filter(F.col("_step") == h).join(state, keys, "inner")
        a = lambda d: F.try_element_at(F.col("_acc"), F.lit(-d))
        feats = {}
        for k in spec.aqi_lags:
            feats[f"{spec.target_alias}_lag_{k}"] = a(k + shift)
        for name, col, wd in spec.mean_cols():
            if col == src:
                n = wd if align == "target" else wd - 1
                tot = a(1 + shift)
                for i in range(2, n + 1):
                    tot = tot + a(i + shift)
                feats[name] = tot / F.lit(float(n))
        for name, col, k in spec.change_cols():
            if col == src:
                feats[name] = a(1) - a(k + 1)
        scored = fitted.predict(cur.withColumns(feats), "_p").withColumn("_p", _clamp(F.col("_p")))
        state = scored.select(*keys, F.concat("_acc", F.array("_p")).alias("_acc"), "_n0")
        if h % checkpoint_every == 0 or h == horizon:
            state = write_table(state)
    # A series has either all ``horizon`` step rows or none (its state is
    # empty when it is shorter), so one join reads every prediction back.
    out = whole.select(*keys, "_ts", "_step").join(state, keys, "left")
    preds = out.select(*keys, F.col("_ts").alias(ts), F.col("_step").alias("step"),
                       F.element_at("_acc", F.col("_n0") + F.col("_step")).alias("predicted_aqi"))
    return preds.withColumn("forecast_day", (F.floor((F.col("step") - 1) / BLOCK_HOURS) + 1).cast("int"))


# --------------------------------------------------------------------------- M14 (trees)
def recursive_forecast_trees(features: DataFrame, model: TreeModel, keys: Sequence[str] = ("location_id",),
                             ts: str = "timestamp", horizon: int = FORECAST_HORIZON, align: str = "target",
                             spec: FeatureSpec = DEFAULT_SPEC, clamp: bool = True, on_null: str = "raise") -> DataFrame:
    """M14 for trees as one fold per series: the model's nodes travel as arrays in one broadcast row
    (bounded, see ``trees``), a step of the fold puts the features of the target's own history beside
    the hour's other features, walks all trees and appends the prediction.  One job whatever the horizon.

    Same inputs, output and treatment of NULL features as ``recursive_forecast_linear``."""
    keys = list(keys)
    src = spec.target_source
    dep = set(aqi_dependent(spec))
    used = {n: d for n, d in needed_hours(spec, align).items() if n in model.features}
    depth = max(used.values(), default=1)
    w = Window.partitionBy(*keys).orderBy(ts)
    rd = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(ts).desc()))
    exog = F.array(*[F.lit(None).cast("double") if c in dep else F.col(c).cast("double") for c in model.features])
    pos = features.select(*keys, ts, src, F.lead(ts, 1).over(w).alias("_next_ts"), exog.alias("_x"), rd.alias("_rd"))
    hist = (pos.filter((F.col("_rd") > horizon) & (F.col("_rd") <= horizon + depth))
               .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(ts, src))).alias("_h"))
               .select(*keys, F.transform("_h", lambda s: s[src].cast("double")).alias("_hist")))
    if align == "target":
        rows = pos.filter((F.col("_rd") >= 2) & (F.col("_rd") <= horizon + 1)).select(*keys, ts, F.col("_next_ts").alias("_ts"), "_x")
    else:
        rows = pos.filter(F.col("_rd") <= horizon).select(*keys, ts, F.col(ts).alias("_ts"), "_x")
    ex = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(ts, "_ts", "_x"))).alias("_e"))
    series = ex.join(hist, keys, "left").withColumn("_hist", F.coalesce("_hist", F.array().cast("array<double>")))
    x = "array(" + ", ".join(_step_feature(c, i, spec, align) for i, c in enumerate(model.features)) + ")"
    score = f"transform(array({x}), x -> {sum_sql('x', model.base)})[0]"
    kept = f"transform(array({score}), p -> IF(p < 0D, 0D, p))[0]" if clamp else score
    folded = attach_scalars(series, model.packed()).selectExpr(
        *[f"`{k}`" for k in keys], "_e", "size(_hist) AS _n0", f"aggregate(_e, _hist, (acc, e) -> concat(acc, array({kept}))) AS _acc")
    out = folded.select(*keys, F.posexplode(F.arrays_zip(
        F.transform("_e", lambda s: s["_ts"]).alias("t"), F.slice("_acc", F.col("_n0") + 1, F.size("_e")).alias("p"))).alias("_i", "_z"), "_n0")
    if on_null == "raise":
        lacks = [F.when(F.lit(d) > F.col("_n0"), F.lit(n)) for n, d in used.items()]
        lack = F.concat(F.lit("history of "), F.col("_n0").cast("string"), F.lit(" hours; "), F.concat_ws(", ", *lacks))
        out = out.withColumn("_z", F.struct(F.col("_z.t").alias("t"), _refuse(keys, F.col("_z.p"), lack).alias("p")))
    return out.select(*keys, F.col("_z.t").alias(ts), (F.col("_i") + 1).cast("int").alias("step"),
                      (F.floor(F.col("_i") / BLOCK_HOURS) + 1).cast("int").alias("forecast_day"),
                      F.col("_z.p").alias("predicted_aqi"))


def _step_feature(name: str, place: int, spec: FeatureSpec, align: str) -> str:
    """One feature inside the fold: from the history ``acc`` (newest last), or from the hour's own array."""
    shift = 1 if align == "target" else 0
    at = lambda d: f"try_element_at(acc, {-d})"
    for k in spec.aqi_lags:
        if name == f"{spec.target_alias}_lag_{k}":
            return at(k + shift)
    for mean, col, w in spec.mean_cols():
        if mean == name and col == spec.target_source:
            n = w if align == "target" else w - 1
            return "((" + " + ".join(at(i + shift) for i in range(1, n + 1)) + f") / {float(n)!r}D)"
    for change, col, k in spec.change_cols():
        if change == name and col == spec.target_source:
            return f"({at(1)} - {at(k + 1)})"
    return f"e._x[{place}]"


def backtest_trees(raw: DataFrame, model: TreeModel, keys: Sequence[str] = ("location_id",), ts: str = "timestamp",
                   horizon: int = FORECAST_HORIZON, align: str = "target", spec: FeatureSpec = DEFAULT_SPEC) -> DataFrame:
    """M15 for trees: the fold over the last ``horizon`` rows of every series, then the actuals attached."""
    feats = build_features(raw, keys, ts, spec, drop_incomplete=False, align=align)
    return attach_actuals(recursive_forecast_trees(feats, model, keys, ts, horizon, align, spec), raw, keys, ts, spec.target_source)


# --------------------------------------------------------------------------- M12, M13, M15
def future_inputs(weather: DataFrame, air: DataFrame, grid: DataFrame, on: Sequence[str] = ("timestamp",),
                  keys: Sequence[str] = ("location_id",)) -> DataFrame:
    """J1 of the two providers restricted (J4) to the horizon grid."""
    j = join_hourly(weather, air, list(on))
    return keep_hours(j, grid, [*keys, "timestamp"])


def forecast_frame(history: DataFrame, future: DataFrame, keys: Sequence[str] = ("location_id",),
                   ts: str = "timestamp", target: str = "us_aqi") -> DataFrame:
    """History UNION future (later source wins per hour, U2), target set
    to NULL after each series' last history hour; ``is_future`` flag."""
    keys = list(keys)
    b = history.groupBy(*keys).agg(F.max(ts).alias("_boundary"))
    u = upsert_by_time(history, future, keys, ts)
    u = u.join(b, keys, "inner").withColumn("is_future", F.col(ts) > F.col("_boundary"))
    return u.withColumn(target, F.when(~F.col("is_future"), F.col(target))).drop("_boundary")


def attach_actuals(forecast: DataFrame, observed: DataFrame, keys: Sequence[str] = ("location_id",),
                   ts: str = "timestamp", target: str = "us_aqi") -> DataFrame:
    """Attach the observed value of each forecast hour one-to-one."""
    obs = observed.select(*keys, ts, F.col(target).alias("future_us_aqi"))
    return attach_one_to_one(forecast, obs, [*keys, ts], ["future_us_aqi"], check="plan")


def backtest_linear(raw: DataFrame, b0: float, beta: dict, keys: Sequence[str] = ("location_id",),
                    ts: str = "timestamp", horizon: int = FORECAST_HORIZON, align: str = "target",
                    spec: FeatureSpec = DEFAULT_SPEC) -> DataFrame:
    """Forecast the last ``horizon`` rows of every series from the data
    before them (observed exogenous inputs), then attach the actuals."""
    feats = build_features(raw, keys, ts, spec, drop_incomplete=False, align=align)
    fc = recursive_forecast_linear(feats, b0, beta, keys, ts, horizon, align, spec)
    return attach_actuals(fc, raw, keys, ts, spec.target_source)


def backtest_origins(raw: DataFrame, b0: float, beta: dict, origins: Sequence[int], keys: Sequence[str] = ("location_id",),
                     ts: str = "timestamp", horizon: int = FORECAST_HORIZON, align: str = "target",
                     spec: FeatureSpec = DEFAULT_SPEC) -> DataFrame:
    """M15 from several origins: ``origin`` o (an extra key) backtests each series without
    its last o rows."""
    keys = list(keys)
    rd = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(ts).desc()))
    each = raw.withColumn("_rd", rd).withColumn("origin", F.explode(F.array(*[F.lit(int(o)) for o in origins])))
    cut = each.filter(F.col("_rd") > F.col("origin")).drop("_rd")
    return backtest_linear(cut, b0, beta, [*keys, "origin"], ts, horizon, align, spec)


def backtest_stepwise(raw: DataFrame, fitted, keys: Sequence[str] = ("location_id",), ts: str = "timestamp",
                      horizon: int = FORECAST_HORIZON, align: str = "target", spec: FeatureSpec = DEFAULT_SPEC,
                      checkpoint_every: int = 8) -> DataFrame:
    """M15 for any fitted model (the tree champion): stepwise forecast of the
    last ``horizon`` rows of every series, then the actuals attached."""
    feats = build_features(raw, keys, ts, spec, drop_incomplete=False, align=align)
    fc = recursive_forecast_stepwise(feats, fitted, keys, ts, horizon, align, spec, checkpoint_every)
    return attach_actuals(fc, raw, keys, ts, spec.target_source)
