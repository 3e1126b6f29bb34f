"""The same questions as plain SQL for a single-node check on the same tables."""

from __future__ import annotations

import re

from chamberlens.plans.queries import DIGITS, LINEITEM_COLUMNS, PROBE_COLUMNS, SELECTED
from chamberlens.operators.charts import FIXED_LIMITS
from chamberlens.operators.clean import TRIPLETS
from chamberlens.sources.event_sensors import quality_sql, sensor_sql

FEATURES = [*PROBE_COLUMNS, "H_data"]
STATS = {"mean": "avg", "max": "max", "min": "min", "std": "stddev_samp"}


def _others(triplet, position):
    return [p for i, p in enumerate(triplet) if i != position]


def _is_off(triplet, position):
    p, (a, b) = triplet[position], _others(triplet, position)
    return f"coalesce(abs({p} - {a}) > 50 AND abs({p} - {b}) > 50, false)"


FLAGS = ", ".join(f"{_is_off(t, i)} AS flag_{p}" for t in TRIPLETS for i, p in enumerate(t))


def _repair(source: str, position: int) -> str:
    fixed = ", ".join(
        f"CASE WHEN flag_{t[position]} THEN CAST(floor(({' + '.join(_others(t, position))}) / 2.0) AS BIGINT) "
        f"ELSE {t[position]} END AS {t[position]}"
        for t in TRIPLETS
    )
    return f"SELECT * REPLACE ({fixed}) FROM {source}"


def _clip(source: str, columns: str) -> str:
    clipped = ", ".join(
        f"CASE WHEN {p} < 0 THEN 0 WHEN {p} > 1200 THEN 1200 ELSE {p} END AS {p}" for p in PROBE_COLUMNS
    )
    return f"SELECT date_time, {clipped}{columns} FROM {source}"


def _r(expression: str, digits: int = DIGITS) -> str:
    return f"round({expression}, {digits}) + 0.0"


NO_GAP = " AND ".join(f"{c} IS NOT NULL" for c in ["date_time", *FEATURES])


def _position(suffix: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST(date_time AS VARCHAR) || '|{suffix}'), 1, 13)) AS UBIGINT)"


HOURLY = ", ".join(f"{f}({c}) AS {c}_{s}" for c in FEATURES for s, f in STATS.items())
HOURLY_NAMES = [f"{c}_{s}" for c in FEATURES for s in STATS]

# Later entries may use earlier ones.
STEPS = {
    "sensors": sensor_sql("duckdb"),
    "measured": quality_sql("duckdb"),
    "flagged": f"SELECT *, {FLAGS} FROM sensors",
    "fix1": _repair("flagged", 0),
    "fix2": _repair("fix1", 1),
    "repaired": _repair("fix2", 2),
    "clipped": _clip("repaired", ", H_data"),
    "clean": f"SELECT * FROM clipped WHERE {NO_GAP}",
    "scaled": "SELECT date_time, (quality - (SELECT min(quality) FROM measured)) / "
    "((SELECT max(quality) FROM measured) - (SELECT min(quality) FROM measured)) * 100 AS quality FROM measured",
    "shifted": "SELECT date_time - INTERVAL 1 HOUR AS date_time, quality FROM scaled",
    "aligned": "SELECT clean.*, quality FROM clean JOIN shifted USING (date_time)",
    "lefted": "SELECT clean.*, quality FROM clean LEFT JOIN shifted USING (date_time)",
    "hourly": f"SELECT date_trunc('hour', date_time) AS date_time, {HOURLY} FROM clean GROUP BY 1",
    "hour_joined": "SELECT hourly.*, quality FROM hourly JOIN "
    "(SELECT date_trunc('hour', date_time) AS date_time, quality FROM shifted) USING (date_time) WHERE "
    + " AND ".join(f"{n} IS NOT NULL" for n in [*HOURLY_NAMES, "quality"]),
    "placed": f"SELECT *, row_number() OVER (ORDER BY {_position('42')}) AS place, count(*) OVER () AS n FROM aligned",
    "train": "SELECT * EXCLUDE (place, n) FROM placed WHERE place > ceil(0.2 * n)",
    "test": "SELECT * EXCLUDE (place, n) FROM placed WHERE place <= ceil(0.2 * n)",
    "long_left": " UNION ALL ".join(
        f"SELECT date_time, '{c}' AS v, CAST({c} AS DOUBLE) AS x FROM lefted" for c in [*FEATURES, "quality"]
    ),
    "pairs": "SELECT a.v AS var_i, b.v AS var_j, CASE WHEN a.v = b.v THEN 1.0 "
    "ELSE CASE WHEN isnan(corr(a.x, b.x)) THEN NULL ELSE corr(a.x, b.x) END END AS r "
    "FROM long_left a JOIN long_left b USING (date_time) GROUP BY a.v, b.v",
    "targets": "SELECT var_i AS variable, r FROM pairs WHERE var_j = 'quality' AND var_i <> 'quality'",
    "shares": "SELECT row_number() OVER w AS position, variable, abs(r) AS importance, "
    "round_even(sum(abs(r)) OVER w / sum(abs(r)) OVER () * 100, 1) AS cumul_pct FROM targets "
    "WINDOW w AS (ORDER BY abs(r) DESC, variable ROWS UNBOUNDED PRECEDING)",
    "line": "SELECT date_time, quality AS y, (SELECT regr_slope(quality, T_data_3_1) FROM aligned) * T_data_3_1 "
    "+ (SELECT regr_intercept(quality, T_data_3_1) FROM aligned) AS yhat FROM aligned",
    "h_line": "SELECT date_time, quality AS y, (SELECT regr_slope(quality, H_data) FROM aligned) * H_data "
    "+ (SELECT regr_intercept(quality, H_data) FROM aligned) AS yhat FROM aligned",
}


def _scores(source: str) -> str:
    return (
        "1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) AS r2, avg(abs(y - yhat)) AS mae, "
        f"sqrt(avg((y - yhat) * (y - yhat))) AS rmse FROM {source}"
    )


def _needs(body: str) -> list[str]:
    """The steps a query mentions, directly or through other steps, in order."""
    wanted: set[str] = set()
    waiting = [body]
    while waiting:
        words = set(re.findall(r"\w+", waiting.pop()))
        for name in STEPS:
            if name in words and name not in wanted:
                wanted.add(name)
                waiting.append(STEPS[name])
    return [n for n in STEPS if n in wanted]


def _sql(body: str, **extra: str) -> str:
    names = _needs(" ".join([body, *extra.values()]))
    steps = [(n, STEPS[n]) for n in names] + list(extra.items())
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in steps) + "\n" + body


def _rounded(columns: list[str], digits: int = DIGITS) -> str:
    return ", ".join(f"{_r(c, digits)} AS {c}" for c in columns)


SUMMARY = """SELECT 'count' AS statistic, CAST(count({c}) AS DOUBLE) AS value FROM {t}
UNION ALL SELECT 'mean', round(avg({c}), {d}) FROM {t}
UNION ALL SELECT 'std', round(stddev_samp({c}), {d}) FROM {t}
UNION ALL SELECT 'min', round(min({c}), {d}) FROM {t}
UNION ALL SELECT '25%', round(quantile_cont({c}, 0.25), {d}) FROM {t}
UNION ALL SELECT '50%', round(quantile_cont({c}, 0.5), {d}) FROM {t}
UNION ALL SELECT '75%', round(quantile_cont({c}, 0.75), {d}) FROM {t}
UNION ALL SELECT 'max', round(max({c}), {d}) FROM {t}"""


def _extremes(columns: list[str], table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, round(CAST(min({c}) AS DOUBLE), {DIGITS}) AS min, "
        f"round(CAST(max({c}) AS DOUBLE), {DIGITS}) AS max FROM {table}"
        for c in columns
    )


def _line_scores() -> str:
    metrics = "r2 mae rmse".split()
    rows = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {_r(f'b.{m}')} AS base, {_r(f't.{m}')} AS tuned, {_r(f't.{m} - b.{m}')} AS gain FROM b, t"
        for m in metrics
    )
    return _sql(rows, b=f"SELECT {_scores('h_line')}", t=f"SELECT {_scores('line')}")


def _grid(feature: str, grid: int, name: str) -> str:
    """All values if fewer than the grid, else even points between the 5% and 95% quantiles
    of the approximately unbiased rule."""
    def q(p: float) -> str:
        place = f"(len(s) * {p} + 0.4 + {p} * 0.2)"
        k = f"CAST(floor(least(greatest({place}, 1), len(s) - 1)) AS BIGINT)"
        share = f"least(greatest({place} - {k}, 0), 1)"
        return f"((1 - {share}) * s[{k}] + {share} * s[{k} + 1])"

    return (
        f"SELECT unnest(CASE WHEN len(list_distinct(s)) < {grid} THEN list_sort(list_distinct(s)) ELSE "
        f"list_transform(range({grid}), lambda i: {q(0.05)} + ({q(0.95)} - {q(0.05)}) * i / {grid - 1}) END) AS {name} "
        f"FROM (SELECT list_sort(list(CAST({feature} AS DOUBLE))) AS s FROM train)"
    )


def _stump() -> str:
    long = " UNION ALL ".join(
        f"SELECT {i} AS f, CAST({c} AS DOUBLE) AS x, quality - (SELECT avg(quality) FROM train) AS resid FROM train"
        for i, c in enumerate(FEATURES)
    )
    routed = " ".join(f"WHEN {i} THEN CAST({c} AS DOUBLE)" for i, c in enumerate(FEATURES))
    shrink = "(sign({0}) * greatest(abs({0}) - 0.5, 0))"
    score = "({} * {}) / ({} + 1)"

    def part(g: str, h: str) -> str:
        return score.format(shrink.format(g), shrink.format(g), h)

    return _sql(
        f"SELECT date_time, {_r('''(SELECT avg(quality) FROM train) + 0.3 * CASE WHEN
CASE f ''' + routed + ''' END < c THEN wl ELSE wr END''')} AS yhat FROM test, best",
        long=long,
        cuts="SELECT DISTINCT f, s[CAST(ceil(k / 64.0 * len(s)) AS BIGINT)] AS c FROM "
        "(SELECT f, list_sort(list(x)) AS s FROM long GROUP BY f), (SELECT unnest(range(1, 64)) AS k)",
        sums="SELECT f, c, -sum(CASE WHEN x < c THEN resid ELSE 0 END) AS gl, "
        "-sum(CASE WHEN x >= c THEN resid ELSE 0 END) AS gr, count(*) FILTER (WHERE x < c) AS hl, "
        "count(*) FILTER (WHERE x >= c) AS hr FROM long JOIN cuts USING (f) GROUP BY f, c",
        best=f"SELECT f, c, -{shrink.format('gl')} / (hl + 1) AS wl, -{shrink.format('gr')} / (hr + 1) AS wr "
        f"FROM sums WHERE hl >= 1 AND hr >= 1 ORDER BY {part('gl', 'hl')} + {part('gr', 'hr')} DESC, f, c LIMIT 1",
    )


def _linear_fit() -> str:
    return _sql(
        "SELECT 'T_data_3_1' AS variable, round((s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12), 6) AS coefficient FROM m "
        "UNION ALL SELECT 'H_data', round((s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12), 6) FROM m",
        z="SELECT (T_data_3_1 - (SELECT avg(T_data_3_1) FROM train)) / (SELECT stddev_pop(T_data_3_1) FROM train) AS z1, "
        "(H_data - (SELECT avg(H_data) FROM train)) / (SELECT stddev_pop(H_data) FROM train) AS z2, quality FROM train",
        m="SELECT var_pop(z1) AS s11, var_pop(z2) AS s22, covar_pop(z1, z2) AS s12, covar_pop(z1, quality) AS s1y, "
        "covar_pop(z2, quality) AS s2y FROM z",
    )


def _least_squares(columns: list[str], counts: list[int]) -> dict[str, str]:
    """Steps ``linear_<n>`` (date_time, y, yhat): the test rows under least squares on the
    first n columns, for every n wanted.

    The normal equations in long form, a row per cell with the target as column -1,
    computed in one scan and eliminated column by column.
    """
    names = [*columns, "quality"]
    cells = ", ".join(
        f"{{'i': {i}, 'j': {j if j < len(columns) else -1}, 'v': covar_pop(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))}}"
        for i, a in enumerate(columns)
        for j, b in enumerate(names)
    )
    means = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS mean_{i}" for i, c in enumerate(names))
    steps = {
        "cell": f"SELECT unnest([{cells}], recursive := true) FROM train",
        "means": f"SELECT {means} FROM train",
    }
    for n in counts:
        steps[f"s{n}_0"] = f"SELECT i, j, v FROM cell WHERE i < {n} AND j < {n}"
        for k in range(n):
            steps[f"s{n}_{k + 1}"] = (
                f"SELECT a.i, a.j, CASE WHEN a.i = {k} THEN a.v / p.v ELSE a.v - r.v * c.v / p.v END AS v FROM s{n}_{k} a "
                f"JOIN s{n}_{k} r ON r.i = a.i AND r.j = {k} JOIN s{n}_{k} c ON c.i = {k} AND c.j = a.j "
                f"JOIN s{n}_{k} p ON p.i = {k} AND p.j = {k}"
            )
        betas = ", ".join(f"max(v) FILTER (WHERE i = {i}) AS beta_{i}" for i in range(n))
        terms = " + ".join(f"beta_{i} * (CAST({c} AS DOUBLE) - mean_{i})" for i, c in enumerate(columns[:n]))
        steps[f"betas_{n}"] = f"SELECT {betas} FROM s{n}_{n} WHERE j = -1"
        steps[f"linear_{n}"] = f"SELECT date_time, quality AS y, mean_{len(columns)} + {terms} AS yhat FROM test, betas_{n}, means"
    return steps


def _least_squares_sql(body: str, columns: list[str], counts: list[int]) -> str:
    """Each elimination step is read four times, so it is computed once."""
    return re.sub(r"\b(cell|means|s\d+_\d+) AS \(", r"\1 AS MATERIALIZED (", _sql(body, **_least_squares(columns, counts)))


def _linear_selection(body: str) -> str:
    """``body`` over ``selected``: scores of least squares on the first n features by name."""
    ordered = sorted(FEATURES)
    counts = list(range(1, len(ordered) + 1))
    rows = " UNION ALL ".join(f"SELECT {n} AS n_vars, '{ordered[n - 1]}' AS last_variable, {_scores(f'linear_{n}')}" for n in counts)
    return _least_squares_sql(body.format(selected=f"({rows})"), ordered, counts)


def _standardized() -> str:
    scaled = ", ".join(
        f"{_r(f'({c} - (SELECT avg({c}) FROM train)) / (SELECT stddev_pop({c}) FROM train)')} AS {c}" for c in FEATURES
    )
    return _sql(f"SELECT date_time, {scaled}, {_r('quality')} AS quality FROM test")


def _histogram() -> str:
    return _sql(
        "SELECT CAST(b AS INTEGER) AS bin, round(lo + b * (hi - lo) / 40, 6) + 0.0 AS lo, "
        "round(CASE WHEN b = 39 THEN hi ELSE lo + (b + 1) * (hi - lo) / 40 END, 6) + 0.0 AS hi, "
        "(SELECT count(*) FROM binned WHERE bin = b) AS n FROM range(40) t(b), span",
        res="SELECT y - yhat AS e FROM line",
        span="SELECT min(e) AS lo, max(e) AS hi FROM res",
        binned="SELECT CASE WHEN g > 0 AND e < lo + g * ((hi - lo) / 40) THEN g - 1 "
        "WHEN g < 39 AND e >= lo + (g + 1) * ((hi - lo) / 40) THEN g + 1 ELSE g END AS bin FROM "
        "(SELECT e, lo, hi, least(CAST(floor((e - lo) / (hi - lo) * 40) AS BIGINT), 39) AS g FROM res, span)",
    )


def _lineitem_pairs() -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS var_i, '{b}' AS var_j, {'max(1.0)' if a == b else _r(f'corr({a}, {b})')} AS r FROM lineitem"
        for a in LINEITEM_COLUMNS
        for b in LINEITEM_COLUMNS
    )


EMBEDDING_CORRELATION = f"""WITH entry AS (
  SELECT vec_id, 'e' || (generate_subscripts(embedding, 1) - 1) AS name, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings
)
SELECT a.name AS var_i, b.name AS var_j, {_r("CASE WHEN a.name <> b.name THEN corr(a.x, b.x) WHEN stddev_pop(a.x) > 0 THEN 1.0 END")} AS r
FROM entry a JOIN entry b USING (vec_id) GROUP BY a.name, b.name"""


def _sizes() -> str:
    return _sql(
        f"SELECT 'exact' AS name, count(*) AS n_rows, {len(FEATURES) + 2} AS n_columns FROM aligned UNION ALL "
        f"SELECT 'hourly', count(*), {len(HOURLY_NAMES) + 2} FROM hour_joined"
    )


REVENUE = """SELECT row_number() OVER w AS position, p_brand AS variable, round(revenue, 2) AS importance,
round_even(sum(revenue) OVER w / sum(revenue) OVER () * 100, 1) AS cumul_pct FROM (
  SELECT p_brand, sum(l_extendedprice * (1 - l_discount)) AS revenue
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand)
WINDOW w AS (ORDER BY revenue DESC, p_brand ROWS UNBOUNDED PRECEDING)"""

PART_SHARES = """WITH sold AS (
  SELECT l_partkey AS variable, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS importance
  FROM lineitem GROUP BY l_partkey
), shares AS (
  SELECT CAST(row_number() OVER w AS INTEGER) AS position, variable, importance,
         round_even(sum(importance) OVER w / sum(importance) OVER () * 100, 1) AS cumul_pct
  FROM sold WINDOW w AS (ORDER BY importance DESC, variable ROWS UNBOUNDED PRECEDING)
)
"""

ORACLES: dict[str, str] = {
    "scan_counts": "SELECT 'sensors' AS name, count(*) AS n_rows, 17 AS n_columns FROM events UNION ALL "
    "SELECT 'quality', count(*), 2 FROM events WHERE event_id % 5 = 0",
    "sensor_anomaly_flags": _sql(
        "SELECT date_time, " + ", ".join(f"CAST(flag_{p} AS INTEGER) AS flag_{p}" for p in PROBE_COLUMNS) + " FROM flagged"
    ),
    "sensor_repair": _sql(f"SELECT date_time, {', '.join(PROBE_COLUMNS)} FROM repaired"),
    "sensor_clip": _sql(_clip("sensors", "")),
    "clean_sensors": _sql("SELECT * FROM clean"),
    "cleaning_audit": _sql(
        "SELECT count(*) AS rows_before, (SELECT count(*) FROM clean) AS rows_after, "
        "count(*) - (SELECT count(*) FROM clean) AS rows_removed, "
        + ", ".join(
            f"CAST(sum({' + '.join(f'CAST(flag_{p} AS INTEGER)' for p in t)}) AS BIGINT) AS flags_chamber_{i}"
            for i, t in enumerate(TRIPLETS, start=1)
        )
        + " FROM flagged"
    ),
    "selected_features": _sql(
        "SELECT date_time, " + ", ".join(f"{_r(f'CAST({c} AS DOUBLE)')} AS {c}" for c in [*SELECTED, "quality"]) + " FROM aligned"
    ),
    "normalize_quality": _sql(f"SELECT date_time, {_r('quality')} AS quality FROM scaled"),
    "parse_time": "SELECT event_id, date_trunc('second', ts) AS parsed, "
    "CASE WHEN event_id % 10 = 0 THEN NULL ELSE date_trunc('minute', ts) END AS lenient FROM events",
    "shift_time": _sql(f"SELECT date_time - INTERVAL 1 HOUR AS date_time, {_r('quality')} AS quality FROM measured"),
    "exact_lag_join": _sql(f"SELECT * REPLACE ({_r('H_data')} AS H_data, {_r('quality')} AS quality) FROM aligned"),
    "left_align": _sql(f"SELECT * REPLACE ({_r('H_data')} AS H_data, {_r('quality')} AS quality) FROM lefted"),
    "hourly_features": _sql(f"SELECT date_time, {_rounded(HOURLY_NAMES).replace('round(', 'round(1.0 * ')} FROM hourly"),
    "hourly_join": _sql(
        f"SELECT date_time, {_rounded([*HOURLY_NAMES, 'quality']).replace('round(', 'round(1.0 * ')} FROM hour_joined"
    ),
    "column_extremes": _sql(_extremes(FEATURES, "clean")),
    "quality_summary": _sql(SUMMARY.format(c="quality", t="scaled", d=6)),
    "correlation_matrix": _sql(f"SELECT var_i, var_j, {_r('r')} AS r FROM pairs"),
    "target_correlation": _sql(
        f"SELECT variable, {_r('r')} AS r, CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS sign FROM targets"
    ),
    "top_correlated": _sql(f"SELECT variable, {_r('abs(r)')} AS abs_r FROM targets ORDER BY abs(r) DESC, variable LIMIT 10"),
    "first_rows": _sql("SELECT * FROM clean ORDER BY date_time LIMIT 10"),
    "lineitem_extremes": _extremes(LINEITEM_COLUMNS, "lineitem"),
    "lineitem_summary": SUMMARY.format(c="l_extendedprice", t="lineitem", d=4),
    "lineitem_correlation": _lineitem_pairs(),
    "embedding_correlation": EMBEDDING_CORRELATION,
    "holdout_split": _sql(
        "SELECT date_time, CASE WHEN CAST(('0x' || substr(md5(CAST(date_time AS VARCHAR) || '|42'), 1, 8)) AS UBIGINT) % 100 < 20 "
        "THEN 'test' ELSE 'train' END AS part FROM aligned"
    ),
    "holdout_fraction": _sql(
        "SELECT date_time, CASE WHEN bucket < 1 OR (bucket = 1 AND finer < 2251799813685248) THEN 'test' ELSE 'train' END AS part FROM "
        "(SELECT date_time, CAST(('0x' || substr(md5(CAST(date_time AS VARCHAR) || '|42'), 1, 8)) AS UBIGINT) % 100 AS bucket, "
        "CAST(('0x' || substr(md5(CAST(date_time AS VARCHAR) || '|42'), 9, 13)) AS UBIGINT) AS finer FROM aligned)"
    ),
    "left_align_counts": _sql(
        "SELECT (SELECT count(*) FROM clean) AS n_sensors, count(*) AS n_aligned, "
        "CAST(sum(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_without FROM lefted"
    ),
    "holdout_split_exact": _sql("SELECT date_time, 'train' AS part FROM train UNION ALL SELECT date_time, 'test' FROM test"),
    "fold_assignment": _sql(
        f"SELECT date_time, CAST(ntile(5) OVER (ORDER BY {_position('fold-42')}) - 1 AS INTEGER) AS fold FROM aligned"
    ),
    "standardize": _standardized(),
    "linear_fit": _linear_fit(),
    "linear_predictions": _least_squares_sql(
        f"SELECT date_time, {_r('y')} AS y, {_r('yhat')} AS yhat FROM linear_{len(FEATURES)}", FEATURES, [len(FEATURES)]
    ),
    "linear_metrics": _least_squares_sql(
        f"SELECT 'linear' AS model, n, {_rounded(['r2', 'mae', 'rmse'])} FROM (SELECT count(*) AS n, {_scores(f'linear_{len(FEATURES)}')})",
        FEATURES,
        [len(FEATURES)],
    ),
    "fitted_examples": _least_squares_sql(
        "SELECT date_time, y AS actual, round_even(yhat, 1) AS predicted, round_even(y - yhat, 1) AS gap "
        f"FROM linear_{len(FEATURES)} ORDER BY date_time LIMIT 5",
        FEATURES,
        [len(FEATURES)],
    ),
    "reg_boost_stump": _stump(),
    "regression_metrics": _sql(
        f"SELECT 'line' AS model, n, {_rounded(['r2', 'mae', 'rmse'])} FROM scored",
        scored=f"SELECT count(*) AS n, {_scores('line')}",
    ),
    "model_comparison": _line_scores(),
    "actual_vs_predicted": _sql(
        f"SELECT date_time, {_rounded(['y', 'yhat'])}, {_r('y - yhat')} AS residual FROM line"
    ),
    "axis_limits": _sql(
        f"SELECT {_r('least(min(y), min(yhat)) - 2')} AS low, {_r('greatest(max(y), max(yhat)) + 2')} AS high FROM line"
    ),
    "fixed_axis_limits": _sql(
        " UNION ALL ".join(
            f"SELECT '{chart}' AS chart, CAST({low} AS DOUBLE) AS low, CAST({high} AS DOUBLE) AS high, count(*) FILTER "
            f"(WHERE NOT (y BETWEEN {low} AND {high} AND yhat BETWEEN {low} AND {high})) AS n_outside FROM line"
            for chart, (low, high) in FIXED_LIMITS.items()
        )
    ),
    "residual_histogram": _histogram(),
    "prediction_examples": _sql(
        f"SELECT date_time, {_r('y')} AS actual, round_even(yhat, 1) AS predicted, round_even(y - yhat, 1) AS gap "
        "FROM line ORDER BY date_time LIMIT 5"
    ),
    "pareto_share": _sql(f"SELECT CAST(position AS INTEGER) AS position, variable, {_r('importance')} AS importance, cumul_pct FROM shares"),
    "pareto_cut": _sql(
        "SELECT count(*) FILTER (WHERE cumul_pct <= 80) AS n_below, least(count(*) FILTER (WHERE cumul_pct < 80) + 1, count(*)) "
        "AS n_reaching, count(*) AS n_variables, (SELECT string_agg(variable, ',' ORDER BY position) FROM shares "
        "WHERE position > (SELECT count(*) FROM shares WHERE cumul_pct <= 80)) AS dispensable FROM shares"
    ),
    "revenue_pareto": REVENUE.replace("row_number() OVER w", "CAST(row_number() OVER w AS INTEGER)"),
    "part_pareto": PART_SHARES + "SELECT position, variable, round(importance, 4) AS importance, cumul_pct FROM shares",
    "part_pareto_cut": PART_SHARES + "SELECT position, variable, cumul_pct FROM shares WHERE position > (SELECT count(*) FROM shares WHERE cumul_pct <= 80)",
    "selection_threshold": _sql(
        "SELECT CAST(min(n_vars) AS INTEGER) AS n_vars FROM tried WHERE r2 >= 0.99 * (SELECT max(r2) FROM tried)",
        tried="SELECT row_number() OVER (ORDER BY abs(r), variable) AS n_vars, r * r AS r2 FROM targets",
    ),
    "cumulative_selection_linear": _linear_selection(
        f"SELECT n_vars, last_variable, {_rounded(['r2', 'mae', 'rmse'], 5)} FROM {{selected}}"
    ),
    "selection_cut_linear": _linear_selection(
        "SELECT CAST(min(n_vars) AS INTEGER) AS n_vars FROM {selected} WHERE r2 >= 0.99 * (SELECT max(r2) FROM {selected})"
    ),
    "alignment_sizes": _sizes(),
    "pdp_1d": _sql(
        f"SELECT 'T_data_3_1' AS feature, {_r('v')} AS value, "
        f"{_r('2 + 0.05 * v + (0.1 + 0.001 * v) * (SELECT avg(H_data) FROM train)')} AS pd FROM g1 UNION ALL "
        f"SELECT 'H_data', {_r('v')}, {_r('2 + 0.1 * v + (0.05 + 0.001 * v) * (SELECT avg(T_data_3_1) FROM train)')} FROM g2",
        g1=_grid("T_data_3_1", 100, "v"),
        g2=_grid("H_data", 100, "v"),
    ),
    "pdp_2d": _sql(
        f"SELECT {_r('v1', 8)} AS value_1, {_r('v2', 8)} AS value_2, {_r('2 + 0.05 * v1 + 0.1 * v2 + 0.001 * v1 * v2', 8)} AS pd FROM g1, g2",
        g1=_grid("T_data_3_1", 100, "v1"),
        g2=_grid("H_data", 100, "v2"),
    ),
}
