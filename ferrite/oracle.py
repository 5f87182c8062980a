"""Reference SQL (DuckDB dialect) for every registered query.

Each statement starts from the same `readings` CTE as the Spark source
(FIXTURES.md F1), so the driver can run it next to the Spark query and
compare rows, schema and values.
"""

from __future__ import annotations

READINGS_CTE = """
b AS (
 SELECT event_id, ts, user_id, event_type, value,
        CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k
 FROM events),
r AS (
 SELECT event_id AS reading_id, ts,
  CAST(user_id % 20 + 1 AS BIGINT) AS machine_id,
  CASE user_id % 4 WHEN 0 THEN 'CNC' WHEN 1 THEN 'Pump'
       WHEN 2 THEN 'Compressor' ELSE 'Robotic Arm' END AS machine_type,
  CASE WHEN event_type IN ('error', 'purchase') THEN 'peak'
       WHEN event_type = 'signup' THEN 'idle' ELSE 'normal' END AS operating_mode,
  CAST(0.35 AS DOUBLE) + CAST(event_id * 7919 % 1000 AS DOUBLE) / 250 AS vib,
  CAST(28 AS DOUBLE) + least(value, CAST(268 AS DOUBLE)) / 4 AS temp,
  CAST(2 AS DOUBLE) + CAST(user_id % 4 AS DOUBLE) * 4
    + CAST(event_id * 104729 % 500 AS DOUBLE) / 50 AS cur,
  CAST(10 AS DOUBLE) + CAST(user_id % 4 AS DOUBLE) * 40
    + CAST(event_id * 1299709 % 700 AS DOUBLE) / 20 AS pres,
  CAST(124 AS DOUBLE) + CAST(user_id % 4 AS DOUBLE) * 800
    + CAST(k AS DOUBLE) * 10 AS rpm0,
  CAST(event_id * 31 % 5756 AS DOUBLE) / 10 AS hours_since_maintenance,
  CAST(8 AS DOUBLE) + CAST(k % 21 AS DOUBLE) / 2 AS ambient_temp
 FROM b),
l AS (
 SELECT *, CASE WHEN (temp - 28) / 67 * 3 + (vib - 0.35) / 4 * 1.5
    + hours_since_maintenance / 575.6
    + CASE WHEN operating_mode = 'peak' THEN 0.3 ELSE 0 END
    + CAST(reading_id * 15485863 % 1000 AS DOUBLE) / 1000 * 0.6 >= 3.0
   THEN 1 ELSE 0 END AS y
 FROM r),
readings AS (
SELECT reading_id, ts, machine_id, machine_type,
 CASE WHEN reading_id % 24 = 0 THEN NULL ELSE vib END AS vibration_rms,
 CASE WHEN reading_id % 29 = 0 THEN NULL ELSE temp END AS temperature_motor,
 CASE WHEN reading_id % 33 = 0 THEN NULL ELSE cur END AS current_phase_avg,
 CASE WHEN reading_id % 26 = 0 THEN NULL ELSE pres END AS pressure_level,
 CASE WHEN reading_id % 45 = 0 THEN NULL ELSE rpm0 END AS rpm,
 operating_mode, hours_since_maintenance, ambient_temp,
 CASE WHEN y = 1 THEN CAST(0.5 AS DOUBLE)
      ELSE CAST(24 AS DOUBLE) + CAST(reading_id % 75 AS DOUBLE) END AS rul_hours,
 y AS failure_within_24h,
 CASE WHEN y = 0 THEN 'none' WHEN reading_id % 3 = 0 THEN 'bearing'
      WHEN reading_id % 3 = 1 THEN 'overheat' ELSE 'electrical' END AS failure_type,
 CASE WHEN y = 1 THEN CAST(1000 + reading_id % 7000 AS BIGINT)
      ELSE CAST(0 AS BIGINT) END AS estimated_repair_cost
FROM l)"""

SCORED_CTE = """
scored AS (
SELECT reading_id, failure_within_24h AS y,
 CAST(floor(least(greatest(((coalesce(temperature_motor, 62) - 28) / 67 * 3
   + (coalesce(vibration_rms, 2.35) - 0.35) / 4 * 1.5
   + hours_since_maintenance / 575.6) / 5, 0), 1) * 1000) AS DOUBLE) / 1000 AS s
FROM readings)"""


def with_readings(body: str, scored: bool = False, extra_ctes: str = "") -> str:
    ctes = READINGS_CTE + ("," + SCORED_CTE if scored else "")
    if extra_ctes:
        ctes += "," + extra_ctes
    return "WITH" + ctes + "\n" + body


SQL: dict[str, str] = {}


def _bigint_count_if(sql: str) -> str:
    """DuckDB types count_if as HUGEINT; Spark as BIGINT.  Cast each call."""
    out, i, tok = [], 0, "count_if("
    while True:
        j = sql.find(tok, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(tok) - 1
        while True:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if depth == 0:
                break
            k += 1
        out.append(sql[i:j])
        out.append("CAST(" + tok + _bigint_count_if(sql[j + len(tok):k]) + ") AS BIGINT)")
        i = k + 1


def register(name: str, sql: str) -> None:
    SQL[name] = _bigint_count_if(sql.strip())


register("readings_scan", with_readings("SELECT * FROM readings"))


# ---------------------------------------------------------------- profiling
from ferrite.schema import (  # noqa: E402
    CATEGORICAL_DOMAIN, FEATURE_COLS, NUMERIC_DOMAIN, NUMERIC_FEATURES, TARGET,
)

ALL_COLS = ["reading_id", "ts", "machine_id", "machine_type", "vibration_rms",
            "temperature_motor", "current_phase_avg", "pressure_level", "rpm",
            "operating_mode", "hours_since_maintenance", "ambient_temp", "rul_hours",
            "failure_within_24h", "failure_type", "estimated_repair_cost"]
# A whole row of the raw table: all columns but the key that the fixture adds.
RAW_COLS = [c for c in ALL_COLS if c != "reading_id"]
PROFILE_NUMERIC = [c for c in NUMERIC_FEATURES] + ["rul_hours", TARGET, "estimated_repair_cost"]
VALUE_COLS = ["machine_type", "operating_mode", TARGET, "failure_type"]
SENSORS5 = ["vibration_rms", "temperature_motor", "current_phase_avg", "pressure_level", "rpm"]


def _long(cols, ids=(), src="readings", cast="DOUBLE"):
    idl = "".join(f"{i}, " for i in ids)
    return "\n UNION ALL ".join(
        f"SELECT {idl}'{c}' AS column_name, CAST({c} AS {cast}) AS value FROM {src}" for c in cols)


register("feature_projection", with_readings(
    f"SELECT reading_id, {', '.join(FEATURE_COLS)}, {TARGET} FROM readings"))

register("null_profile", with_readings(
    "SELECT column_name, n_null, round(n_null * 100.0 / n, 6) AS pct_null FROM ("
    + "\n UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, count(*) AS n FROM readings"
        for c in ALL_COLS) + ") t"))

register("shape", with_readings(
    f"SELECT count(*) AS n_rows, CAST({len(ALL_COLS)} AS BIGINT) AS n_columns FROM readings"))

# Spark SQL type names of the readings columns, in order.
READINGS_TYPES = ["bigint", "timestamp_ntz", "bigint", "string", "double", "double", "double",
                  "double", "double", "string", "double", "double", "double", "int", "string",
                  "bigint"]
register("column_types", with_readings(
    "SELECT CAST(position AS INTEGER) AS position, column_name, data_type, n_non_null FROM ("
    + "\n UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS n_non_null "
        "FROM readings" for i, (c, t) in enumerate(zip(ALL_COLS, READINGS_TYPES))) + ") t"))

register("duplicate_rows", with_readings(
    "SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_distinct, "
    "CAST(sum(c - 1) AS BIGINT) AS n_duplicates FROM ("
    f"SELECT count(*) AS c FROM readings GROUP BY {', '.join(RAW_COLS)}) g"))

register("distinct_counts", with_readings(
    "\n UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM readings"
        for c in ALL_COLS)))

register("value_shares", with_readings(
    "SELECT column_name, value, n, round(n / sum(n) OVER (PARTITION BY column_name), 6) AS share FROM ("
    "SELECT column_name, value, count(*) AS n FROM ("
    + _long(VALUE_COLS, cast="VARCHAR") + ") l GROUP BY column_name, value) c"))

register("describe", with_readings(
    "SELECT column_name, count(value) AS count, round(avg(value), 6) AS mean, "
    "round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min, "
    "round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, "
    "round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS max FROM ("
    + _long(PROFILE_NUMERIC) + ") l GROUP BY column_name"))

register("kpis", with_readings(
    "SELECT n_rows, n_failures, n_non_failures, "
    "round(n_failures * 100.0 / n_rows, 6) AS failure_rate_pct, "
    "round(n_non_failures / NULLIF(n_failures, 0), 6) AS class_ratio, "
    "round(n_non_failures / n_rows, 6) AS naive_accuracy FROM ("
    f"SELECT count(*) AS n_rows, count_if({TARGET} = 1) AS n_failures, "
    f"count_if({TARGET} = 0) AS n_non_failures FROM readings) a"))

register("machine_type_profile", with_readings(
    "SELECT machine_type, n_rows, n_failures, round(n_failures / n_rows, 6) AS failure_rate, "
    f"round(nulls / (n_rows * {len(SENSORS5)}), 6) AS sensor_null_share FROM ("
    f"SELECT machine_type, count(*) AS n_rows, count_if({TARGET} = 1) AS n_failures, "
    + " + ".join(f"(count(*) - count({c}))" for c in SENSORS5)
    + " AS nulls FROM readings GROUP BY machine_type) a"))

register("domain_violations", with_readings(
    "\n UNION ALL ".join(
        [f"SELECT '{c}' AS column_name, count_if(NOT ({c} BETWEEN {lo} AND {hi})) AS n_violations, "
         "count(*) AS n_rows FROM readings" for c, (lo, hi) in NUMERIC_DOMAIN.items()]
        + [f"SELECT '{c}' AS column_name, count_if(NOT ({c} IN ({', '.join(repr(v) for v in lv)}))) "
           "AS n_violations, count(*) AS n_rows FROM readings"
           for c, lv in CATEGORICAL_DOMAIN.items()])))


def _corr_sql(cols):
    parts = []
    for a in cols:
        for b in cols:
            if a == b:
                parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, CASE WHEN stddev_pop({a}) > 0 "
                             f"THEN CAST(1.0 AS DOUBLE) END AS r FROM readings")
            else:
                parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(CAST({a} AS DOUBLE), "
                             f"CAST({b} AS DOUBLE)), 6) AS r FROM readings")
    return "\n UNION ALL ".join(parts)


register("correlation_matrix", with_readings(_corr_sql(PROFILE_NUMERIC)))


def _hist_sql(cols, bins, by=None, per_group=False, density=False, src="readings"):
    ids = [by] if by else []
    idl = "".join(f"{i}, " for i in ids)
    bkeys = ["column_name"] + (ids if per_group else [])
    bk = ", ".join(bkeys)
    long = f"(SELECT * FROM ({_long(cols, ids, src)}) x WHERE value IS NOT NULL)"
    bounds = f"(SELECT {bk}, min(value) AS lo, max(value) AS hi, count(value) AS n_values FROM {long} l GROUP BY {bk})"
    binexpr = (f"least(coalesce(CAST(floor((l.value - b.lo) * {bins} / NULLIF(b.hi - b.lo, 0)) AS BIGINT) + 1, 1), {bins})")
    on = " AND ".join(f"l.{k} = b.{k}" for k in bkeys)
    counts = (f"(SELECT {''.join(f'l.{i}, ' for i in ids)}l.column_name, {binexpr} AS bin, count(*) AS n "
              f"FROM {long} l JOIN {bounds} b ON {on} GROUP BY ALL)")
    if by and not per_group:
        gsrc = (f"(SELECT b.*, k.{by} FROM {bounds} b JOIN "
                f"(SELECT DISTINCT {by}, column_name FROM {long} l) k ON b.column_name = k.column_name)")
        ngroup = (f"(SELECT {by}, column_name, count(*) AS n_group FROM {long} l GROUP BY {by}, column_name)")
    else:
        gsrc = bounds
        ngroup = None
    grid = f"(SELECT g.*, CAST(s.bin AS BIGINT) AS bin FROM {gsrc} g, range(1, {bins} + 1) s(bin))"
    q = f"SELECT {''.join(f'g.{i}, ' for i in ids)}g.column_name, g.bin, "
    q += f"round(g.lo + (g.hi - g.lo) * (g.bin - 1) / {bins}, 6) AS bin_lo, "
    q += f"round(g.lo + (g.hi - g.lo) * g.bin / {bins}, 6) AS bin_hi, coalesce(c.n, 0) AS n"
    if density:
        ng = "ng.n_group" if ngroup else "g.n_values"
        q += f", round(coalesce(c.n, 0) / NULLIF({ng} * ((g.hi - g.lo) / {bins}), 0), 6) AS density"
    q += f" FROM {grid} g LEFT JOIN {counts} c ON "
    q += " AND ".join(f"g.{k} = c.{k}" for k in ids + ["column_name", "bin"])
    if ngroup:
        q += f" LEFT JOIN {ngroup} ng ON ng.{by} = g.{by} AND ng.column_name = g.column_name"
    return q


register("histogram", with_readings(_hist_sql(NUMERIC_FEATURES, 50)))
register("class_histogram_density", with_readings(
    _hist_sql(NUMERIC_FEATURES, 30, by=TARGET, per_group=True, density=True)))
register("class_histogram_overlay", with_readings(
    _hist_sql(NUMERIC_FEATURES, 50, by=TARGET, per_group=False, density=True)))


def _box_sql(cols, by):
    long = f"(SELECT * FROM ({_long(cols, [by])}) x WHERE value IS NOT NULL)"
    q = (f"(SELECT {by}, column_name, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, "
         f"quantile_cont(value, 0.75) AS q3 FROM {long} l GROUP BY {by}, column_name)")
    f = (f"(SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS hf FROM {q} q)")
    return (f"SELECT l.{by}, l.column_name, count(*) AS n, round(any_value(f.q1), 6) AS q1, "
            f"round(any_value(f.median), 6) AS median, round(any_value(f.q3), 6) AS q3, "
            f"round(any_value(f.q3) - any_value(f.q1), 6) AS iqr, "
            f"round(min(CASE WHEN l.value >= f.lf THEN l.value END), 6) AS whisker_lo, "
            f"round(max(CASE WHEN l.value <= f.hf THEN l.value END), 6) AS whisker_hi, "
            f"count_if(l.value < f.lf OR l.value > f.hf) AS n_outliers "
            f"FROM {long} l JOIN {f} f ON l.{by} = f.{by} AND l.column_name = f.column_name GROUP BY l.{by}, l.column_name")


register("box_stats", with_readings(_box_sql(NUMERIC_FEATURES, TARGET)))


# ------------------------------------------------------- splits / resampling
def _h(seed, extra=""):
    return f"md5(CAST(reading_id AS VARCHAR) || '-' || '{seed}'{extra})"


def split_ctes(src="readings", seed=42, frac=0.2, out="split", names=("train", "test"), where=""):
    """CTE text: `{out}` = (reading_id, y, part) with exact stratified quotas."""
    w = f" WHERE {where}" if where else ""
    return f"""
{out}_h AS (SELECT reading_id, {TARGET} AS y, {_h(seed)} AS h FROM {src}{w}),
{out}_c AS (SELECT y, count(*) AS n_c FROM {out}_h GROUP BY y),
{out}_t AS (SELECT y, n_c, sum(n_c) OVER () AS n,
   CAST(ceil(sum(n_c) OVER () * {frac}) AS BIGINT) AS n_out FROM {out}_c),
{out}_q0 AS (SELECT y, n_c, n, n_out, (n_out * n_c) // n AS base, (n_out * n_c) % n AS rem FROM {out}_t),
{out}_q AS (SELECT y, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, y) <= n_out - sum(base) OVER ()
   THEN 1 ELSE 0 END AS quota FROM {out}_q0),
{out}_r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY h, reading_id) AS rk FROM {out}_h),
{out} AS (SELECT r.reading_id, r.y, CASE WHEN r.rk <= q.quota THEN '{names[1]}' ELSE '{names[0]}' END AS part
   FROM {out}_r r JOIN {out}_q q ON r.y = q.y)"""


register("stratified_split", with_readings(
    f"SELECT reading_id, y AS {TARGET}, part AS split FROM split", extra_ctes=split_ctes()))

register("split_summary", with_readings(
    f"SELECT part AS split, y AS {TARGET}, count(*) AS n FROM split GROUP BY part, y",
    extra_ctes=split_ctes()))

register("inner_split", with_readings(
    f"SELECT reading_id, y AS {TARGET}, part AS inner_split FROM fitval",
    extra_ctes=split_ctes() + ",\ntrain_rows AS (SELECT r.* FROM readings r JOIN split s "
    "ON r.reading_id = s.reading_id WHERE s.part = 'train')," + split_ctes(
        "train_rows", out="fitval", names=("fit", "validation"))))

register("fold_assignment", with_readings(
    f"SELECT reading_id, y AS {TARGET}, CAST((rk - 1) % 5 AS INTEGER) AS fold FROM ("
    f"SELECT s.reading_id, s.y, row_number() OVER (PARTITION BY s.y ORDER BY {_h(42)}, s.reading_id) AS rk "
    "FROM split s WHERE s.part = 'train') f", extra_ctes=split_ctes()))

register("class_weights", with_readings(
    f"SELECT {TARGET}, n_class, sum(n_class) OVER () / (count(*) OVER () * n_class) AS weight FROM ("
    f"SELECT {TARGET}, count(*) AS n_class FROM readings GROUP BY {TARGET}) c"))

register("undersample", with_readings(
    f"SELECT reading_id, {TARGET} FROM ("
    f"SELECT reading_id, {TARGET}, row_number() OVER (PARTITION BY {TARGET} "
    f"ORDER BY {_h(42)}, reading_id) AS rk FROM readings) x WHERE rk <= "
    f"(SELECT min(c) FROM (SELECT count(*) AS c FROM readings GROUP BY {TARGET}))"))

register("oversample", with_readings(
    f"SELECT reading_id, {TARGET}, CAST(s.copy AS INTEGER) AS copy FROM ("
    f"SELECT r.reading_id, r.{TARGET}, CAST(floor(c.n_max / c.n_class) AS INTEGER) "
    f"+ CASE WHEN r.rk <= c.n_max % c.n_class THEN 1 ELSE 0 END AS copies FROM ("
    f"SELECT reading_id, {TARGET}, row_number() OVER (PARTITION BY {TARGET} ORDER BY {_h(42)}, reading_id) AS rk "
    f"FROM readings) r JOIN (SELECT {TARGET}, count(*) AS n_class, max(count(*)) OVER () AS n_max "
    f"FROM readings GROUP BY {TARGET}) c ON r.{TARGET} = c.{TARGET}) x, "
    "LATERAL range(1, x.copies + 1) s(copy)"))

register("hash_sample", with_readings(
    f"SELECT reading_id, {TARGET} FROM readings ORDER BY {_h(42)}, reading_id LIMIT 100"))


# ---------------------------------------------------------------- preparation
from ferrite.schema import CATEGORICAL_DOMAIN as _CD, CATEGORICAL_FEATURES  # noqa: E402


def _q(name):
    return '"' + name + '"'


def prepared_sql_body(src_split="split", digits=6):
    """SQL for G1-G5: train-fitted median + population-std scaling, one-hot (``digits`` None: not rounded)."""
    shown = (lambda x: x) if digits is None else (lambda x: f"round({x}, {digits})")
    stats = []
    for c in NUMERIC_FEATURES:
        stats.append(f"(SELECT quantile_cont({c}, 0.5) FROM tr) AS med_{c}")
    med = "SELECT " + ", ".join(stats)
    mom = "SELECT m.*, " + ", ".join(
        f"(SELECT avg(coalesce({c}, m.med_{c})) FROM tr) AS mu_{c}, "
        f"(SELECT stddev_pop(coalesce({c}, m.med_{c})) FROM tr) AS sd_{c}" for c in NUMERIC_FEATURES
    ) + " FROM med m"
    cols = []
    for c in NUMERIC_FEATURES:
        cols.append(shown(f"(coalesce(r.{c}, p.med_{c}) - p.mu_{c}) / CASE WHEN p.sd_{c} > 0 THEN p.sd_{c} ELSE 1 END")
                    + f" AS {_q('num__' + c)}")
    for c in CATEGORICAL_FEATURES:
        for lv in sorted(_CD[c]):
            cols.append(f"CASE WHEN r.{c} = '{lv}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END "
                        f"AS {_q('cat__' + c + '_' + lv)}")
    ctes = (f"tr AS (SELECT r.* FROM readings r JOIN {src_split} s ON r.reading_id = s.reading_id "
            f"WHERE s.part = 'train'),\nmed AS ({med}),\nprm AS ({mom})")
    body = (f"SELECT r.reading_id, s.part AS split, {', '.join(cols)} FROM readings r "
            f"JOIN {src_split} s ON r.reading_id = s.reading_id CROSS JOIN prm p")
    return ctes, body


_pc, _pb = prepared_sql_body()
register("impute_scale_encode", with_readings(_pb, extra_ctes=split_ctes() + ",\n" + _pc))
register("feature_names", with_readings(
    "SELECT CAST(slot AS INTEGER) AS slot, feature FROM (VALUES "
    + ", ".join(f"({i}, '{n}')" for i, n in enumerate(
        ["num__" + c for c in NUMERIC_FEATURES]
        + [f"cat__{c}_{lv}" for c in CATEGORICAL_FEATURES for lv in sorted(_CD[c])]))
    + ") v(slot, feature) WHERE (SELECT count(*) FROM readings) > 0"))


# ---------------------------------------------------------------- evaluation
SWEEP_SQL = "(VALUES " + ", ".join(f"(CAST({round(0.05 * j, 2)} AS DOUBLE))" for j in range(1, 20)) + ") g(threshold)"

MODEL_SCORES_CTE = """
model_scores AS (
SELECT reading_id, failure_within_24h AS y, 'composite' AS model,
 CAST(floor(least(greatest(((coalesce(temperature_motor, 62) - 28) / 67 * 3
   + (coalesce(vibration_rms, 2.35) - 0.35) / 4 * 1.5
   + hours_since_maintenance / 575.6) / 5, 0), 1) * 1000) AS DOUBLE) / 1000 AS score FROM readings
UNION ALL
SELECT reading_id, failure_within_24h, 'temperature',
 CAST(floor(least(greatest((coalesce(temperature_motor, 62) - 28) / 67, 0), 1) * 1000) AS DOUBLE) / 1000
 FROM readings
UNION ALL
SELECT reading_id, failure_within_24h, 'vibration',
 CAST(floor(least(greatest((coalesce(vibration_rms, 2.35) - 0.35) / 4, 0), 1) * 1000) AS DOUBLE) / 1000
 FROM readings)"""


def _rates_sql(tp="tp", fp="fp", fn="fn", tn="tn"):
    return (f"round(({tp} + {tn}) / ({tp} + {fp} + {fn} + {tn}), 6) AS accuracy, "
            f"round(coalesce({tp} / NULLIF({tp} + {fp}, 0), 0), 6) AS precision, "
            f"round(coalesce({tp} / NULLIF({tp} + {fn}, 0), 0), 6) AS recall, "
            f"round(coalesce(2 * {tp} / NULLIF(2 * {tp} + {fp} + {fn}, 0), 0), 6) AS f1")


def _conf_sql(src, t, groups=""):
    g = f"{groups}, " if groups else ""
    gb = f" GROUP BY {groups}" if groups else ""
    return (f"SELECT {g}count_if(y = 0 AND score < {t}) AS tn, count_if(y = 0 AND score >= {t}) AS fp, "
            f"count_if(y = 1 AND score < {t}) AS fn, count_if(y = 1 AND score >= {t}) AS tp FROM {src}{gb}")


SCORED_AS = "(SELECT reading_id, y, s AS score FROM scored)"

register("confusion", with_readings(
    f"SELECT tn, fp, fn, tp, {_rates_sql()} FROM ({_conf_sql(SCORED_AS, 0.5)}) c", scored=True))

register("classification_report", with_readings(
    "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, "
    "CAST(support AS BIGINT) AS support FROM ("
    "SELECT '0' AS label, coalesce(tn / NULLIF(tn + fn, 0), 0) AS precision, coalesce(tn / NULLIF(tn + fp, 0), 0) AS recall, "
    "coalesce(2 * tn / NULLIF(2 * tn + fp + fn, 0), 0) AS f1, tn + fp AS support FROM c "
    "UNION ALL SELECT '1', coalesce(tp / NULLIF(tp + fp, 0), 0), coalesce(tp / NULLIF(tp + fn, 0), 0), "
    "coalesce(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0), tp + fn FROM c "
    "UNION ALL SELECT 'accuracy', NULL, NULL, (tp + tn) / (tp + tn + fp + fn), tp + tn + fp + fn FROM c "
    "UNION ALL SELECT 'macro avg', (coalesce(tn / NULLIF(tn + fn, 0), 0) + coalesce(tp / NULLIF(tp + fp, 0), 0)) / 2, "
    "(coalesce(tn / NULLIF(tn + fp, 0), 0) + coalesce(tp / NULLIF(tp + fn, 0), 0)) / 2, "
    "(coalesce(2 * tn / NULLIF(2 * tn + fp + fn, 0), 0) + coalesce(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0)) / 2, "
    "tp + tn + fp + fn FROM c "
    "UNION ALL SELECT 'weighted avg', (coalesce(tn / NULLIF(tn + fn, 0), 0) * (tn + fp) + coalesce(tp / NULLIF(tp + fp, 0), 0) * (tp + fn)) / (tp + tn + fp + fn), "
    "(coalesce(tn / NULLIF(tn + fp, 0), 0) * (tn + fp) + coalesce(tp / NULLIF(tp + fn, 0), 0) * (tp + fn)) / (tp + tn + fp + fn), "
    "(coalesce(2 * tn / NULLIF(2 * tn + fp + fn, 0), 0) * (tn + fp) + coalesce(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0) * (tp + fn)) / (tp + tn + fp + fn), "
    "tp + tn + fp + fn FROM c) r",
    scored=True, extra_ctes=f"c AS ({_conf_sql(SCORED_AS, 0.5)})"))


def _cum_sql(src, groups=""):
    p = f"PARTITION BY {groups} " if groups else ""
    g = f"{groups}, " if groups else ""
    return (f"(SELECT {g}score, tp, fp, sum(tp) OVER ({p}ORDER BY score DESC) AS ctp, "
            f"sum(fp) OVER ({p}ORDER BY score DESC) AS cfp, sum(tp) OVER ({p.strip()}) AS n_pos, "
            f"sum(fp) OVER ({p.strip()}) AS n_neg FROM (SELECT {g}score, count_if(y = 1) AS tp, "
            f"count_if(y = 0) AS fp FROM {src} GROUP BY {g}score) d)")


def _auc_sql(src, groups=""):
    g = f"{groups}, " if groups else ""
    gb = f" GROUP BY {groups}" if groups else ""
    return (f"SELECT {g}round(sum(fp * (2 * ctp - tp)) / (2 * any_value(n_pos) * any_value(n_neg)), 6) AS roc_auc, "
            f"round(sum(tp * (ctp / (ctp + cfp))) / any_value(n_pos), 6) AS average_precision "
            f"FROM {_cum_sql(src, groups)} c{gb}")


register("roc_auc_ap", with_readings(_auc_sql(SCORED_AS), scored=True))
register("roc_curve", with_readings(
    f"SELECT score AS threshold, round(cfp / n_neg, 6) AS fpr, round(ctp / n_pos, 6) AS tpr FROM {_cum_sql(SCORED_AS)} c "
    "UNION ALL SELECT CAST(NULL AS DOUBLE), CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE)", scored=True))
register("pr_curve", with_readings(
    f"SELECT score AS threshold, round(ctp / (ctp + cfp), 6) AS precision, round(ctp / n_pos, 6) AS recall "
    f"FROM {_cum_sql(SCORED_AS)} c "
    "UNION ALL SELECT CAST(NULL AS DOUBLE), CAST(1.0 AS DOUBLE), CAST(0.0 AS DOUBLE)", scored=True))


def _sweep_sql(src, groups=""):
    g = f"{groups}, " if groups else ""
    sg = "".join(f"s.{x.strip()}, " for x in groups.split(",")) if groups else ""
    return (f"SELECT {g}threshold, round(coalesce(tp / NULLIF(tp + fp, 0), 0), 6) AS precision, "
            f"round(coalesce(tp / NULLIF(tp + fn, 0), 0), 6) AS recall, "
            f"round(coalesce(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 6) AS f1, "
            f"CAST(fn AS BIGINT) AS fn, CAST(fp AS BIGINT) AS fp FROM ("
            f"SELECT {sg}g.threshold, count_if(s.y = 1 AND s.score >= g.threshold) AS tp, "
            f"count_if(s.y = 0 AND s.score >= g.threshold) AS fp, count_if(s.y = 1 AND s.score < g.threshold) AS fn "
            f"FROM {src} s CROSS JOIN {SWEEP_SQL} GROUP BY ALL) x")


def _best_sql(sweep, groups=""):
    p = f"PARTITION BY {groups} " if groups else ""
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER ({p}ORDER BY f1 DESC, threshold ASC) AS rn "
            f"FROM ({sweep}) w) b WHERE rn = 1")


register("threshold_sweep", with_readings(_sweep_sql(SCORED_AS), scored=True))
register("best_threshold", with_readings(_best_sql(_sweep_sql(SCORED_AS)), scored=True))

register("risk_tiers", with_readings(
    "SELECT reading_id, CASE WHEN s >= 0.7 THEN 'high' WHEN s >= 0.4 THEN 'moderate' ELSE 'low' END AS tier, "
    "CAST(s >= 0.7 AS INTEGER) AS decision FROM scored", scored=True))

register("risk_tier_counts", with_readings(
    "SELECT CASE WHEN s >= 0.7 THEN 'high' WHEN s >= 0.4 THEN 'moderate' ELSE 'low' END AS tier, "
    "count(*) AS n, count_if(y = 1) AS n_failures FROM scored GROUP BY 1", scored=True))

register("model_auc", with_readings(_auc_sql("model_scores", "model"), extra_ctes=MODEL_SCORES_CTE))

# Threshold chosen on the validation part of train, applied on test.
_SEL_CTES = (split_ctes() + ",\ntrain_rows AS (SELECT r.* FROM readings r JOIN split s "
             "ON r.reading_id = s.reading_id WHERE s.part = 'train')," + split_ctes(
                 "train_rows", out="fitval", names=("fit", "validation")) + "," + MODEL_SCORES_CTE
             + ",\nval AS (SELECT m.* FROM model_scores m JOIN fitval f ON m.reading_id = f.reading_id "
             "WHERE f.part = 'validation'),\ntst AS (SELECT m.* FROM model_scores m JOIN split s "
             "ON m.reading_id = s.reading_id WHERE s.part = 'test'),\n"
             f"best AS ({_best_sql(_sweep_sql('val', 'model'), 'model')}),\n"
             "tconf AS (SELECT t.model, b.threshold, "
             "count_if(t.y = 0 AND t.score < b.threshold) AS tn, count_if(t.y = 0 AND t.score >= b.threshold) AS fp, "
             "count_if(t.y = 1 AND t.score < b.threshold) AS fn, count_if(t.y = 1 AND t.score >= b.threshold) AS tp "
             "FROM tst t JOIN best b ON t.model = b.model GROUP BY ALL),\n"
             "dconf AS (SELECT model, count_if(y = 0 AND score < 0.5) AS tn, count_if(y = 0 AND score >= 0.5) AS fp, "
             "count_if(y = 1 AND score < 0.5) AS fn, count_if(y = 1 AND score >= 0.5) AS tp FROM tst GROUP BY model),\n"
             f"areas AS ({_auc_sql('tst', 'model')})")

register("threshold_selection", with_readings(
    "SELECT b.model, b.threshold AS selected_threshold, b.precision AS validation_precision, "
    "b.recall AS validation_recall, b.f1 AS validation_f1, b.fn AS validation_fn, b.fp AS validation_fp, "
    "round(coalesce(2 * d.tp / NULLIF(2 * d.tp + d.fp + d.fn, 0), 0), 6) AS test_f1_default, "
    "CAST(d.fn AS BIGINT) AS test_fn_default, CAST(d.fp AS BIGINT) AS test_fp_default, "
    "round(coalesce(t.tp / NULLIF(t.tp + t.fp, 0), 0), 6) AS test_precision, "
    "round(coalesce(t.tp / NULLIF(t.tp + t.fn, 0), 0), 6) AS test_recall, "
    "round(coalesce(2 * t.tp / NULLIF(2 * t.tp + t.fp + t.fn, 0), 0), 6) AS test_f1, "
    "CAST(t.fn AS BIGINT) AS test_fn, CAST(t.fp AS BIGINT) AS test_fp "
    "FROM best b JOIN dconf d ON b.model = d.model JOIN tconf t ON b.model = t.model",
    extra_ctes=_SEL_CTES))

register("model_comparison", with_readings(
    "SELECT model, threshold, tn, fp, fn, tp, accuracy, precision, recall, f1, roc_auc, average_precision, "
    "CAST(row_number() OVER (ORDER BY f1 DESC, recall DESC, model ASC) AS INTEGER) AS rank FROM ("
    f"SELECT t.model, t.threshold, t.tn, t.fp, t.fn, t.tp, {_rates_sql('t.tp', 't.fp', 't.fn', 't.tn')}, "
    "a.roc_auc, a.average_precision FROM tconf t JOIN areas a ON t.model = a.model) x",
    extra_ctes=_SEL_CTES))

register("rebuild_matrix", with_readings(
    "SELECT model, CAST(n_neg - fp AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, "
    f"CAST(n_pos - fn AS BIGINT) AS tp, {_rates_sql('(n_pos - fn)', 'fp', 'fn', '(n_neg - fp)')} FROM ("
    "SELECT t.model, t.fn, t.fp, c.n_pos, c.n_neg FROM tconf t CROSS JOIN "
    "(SELECT count_if(y = 1) AS n_pos, count_if(y = 0) AS n_neg FROM split WHERE part = 'test') c) x",
    extra_ctes=_SEL_CTES))

register("fold_summary", with_readings(
    "SELECT model, round(avg(f1), 6) AS cv_f1_mean, round(stddev_pop(f1), 6) AS cv_f1_std, count(*) AS n_folds FROM ("
    "SELECT model, fold, coalesce(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0) AS f1 FROM ("
    "SELECT m.model, f.fold, count_if(m.y = 1 AND m.score >= 0.5) AS tp, count_if(m.y = 0 AND m.score >= 0.5) AS fp, "
    "count_if(m.y = 1 AND m.score < 0.5) AS fn FROM model_scores m JOIN ("
    f"SELECT reading_id, (row_number() OVER (PARTITION BY y ORDER BY {_h(42)}, reading_id) - 1) % 5 AS fold "
    "FROM split WHERE part = 'train') f ON m.reading_id = f.reading_id GROUP BY ALL) c) x GROUP BY model",
    extra_ctes=split_ctes() + "," + MODEL_SCORES_CTE))


# ---------------------------------------------------------------- explanation
PERM_COLS = list(NUMERIC_FEATURES)
_SCORE_EXPR = ("CAST(floor(least(greatest(((coalesce(temperature_motor, 62) - 28) / 67 * 3 "
               "+ (coalesce(vibration_rms, 2.35) - 0.35) / 4 * 1.5 + hours_since_maintenance / 575.6) / 5, 0), 1) "
               "* 1000) AS DOUBLE) / 1000")


def _perm_sql(repeats=10):
    test = ("tst AS (SELECT r.* FROM readings r JOIN split s ON r.reading_id = s.reading_id "
            "WHERE s.part = 'test')")
    base = (f"base AS (SELECT reading_id, row_number() OVER (ORDER BY {_h(42, chr(32) + '|| ' + repr('-base'))}, "
            "reading_id) AS rk FROM tst)")
    longv = "\n UNION ALL ".join(
        f"SELECT b.rk - 1 AS rk, '{c}' AS pc, CAST(t.{c} AS DOUBLE) AS v FROM tst t JOIN base b ON t.reading_id = b.reading_id"
        for c in PERM_COLS)
    keys = ", ".join(f"CAST('0x' || substr(d, {8 * i + 1}, 8) AS BIGINT) % 2147483647 AS k{i}" for i in range(8))
    pairs = " UNION ALL ".join(f"SELECT '{c}' AS pc" for c in PERM_COLS)
    ks = (f"ks AS (SELECT pc, rep, {keys} FROM (SELECT pc, rep, sha256('42-' || pc || '-' || CAST(rep AS VARCHAR)) AS d "
          f"FROM ({pairs}) c CROSS JOIN range(0, {repeats}) g(rep)) x)")

    def network(x):
        left, right = f"({x} // a)", f"({x} % a)"
        for i in range(0, 8, 2):
            left, right = right, (f"(({left} + ({right} + k{i}) % 2147483647 * (({right} + k{i + 1}) % 2147483647) "
                                  "% 2147483647) % a)")
        return f"{left} * a + {right}"

    size = "size AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM tst)"
    walk = (f"walk AS (SELECT l.pc, ks.rep, l.rk AS origin, {network('l.rk')} AS x FROM ({longv}) l "
            "JOIN ks ON l.pc = ks.pc CROSS JOIN size UNION ALL "
            f"SELECT w.pc, w.rep, w.origin, {network('w.x')} AS x FROM walk w JOIN ks ON w.pc = ks.pc AND w.rep = ks.rep "
            "CROSS JOIN size WHERE w.x >= n)")
    moved = (f"moved AS (SELECT b.reading_id, w.pc, w.rep, l.v FROM walk w CROSS JOIN size JOIN base b ON b.rk - 1 = w.x "
             f"JOIN ({longv}) l ON l.pc = w.pc AND l.rk = w.origin WHERE w.x < n)")
    sel = ", ".join(f"CASE WHEN m.pc = '{c}' THEN m.v ELSE CAST(t.{c} AS DOUBLE) END AS {c}" for c in PERM_COLS)
    perm = (f"perm AS (SELECT t.reading_id, t.failure_within_24h AS y, m.pc, m.rep, {sel} "
            "FROM tst t JOIN moved m ON t.reading_id = m.reading_id)")
    f1 = ("coalesce(2 * count_if(y = 1 AND score >= 0.5) / NULLIF(2 * count_if(y = 1 AND score >= 0.5) "
          "+ count_if(y = 0 AND score >= 0.5) + count_if(y = 1 AND score < 0.5), 0), 0)")
    pf1 = f"pf1 AS (SELECT pc, rep, {f1} AS f1 FROM (SELECT *, {_SCORE_EXPR} AS score FROM perm) x GROUP BY pc, rep)"
    bf1 = (f"bf1 AS (SELECT {f1} AS f1 FROM (SELECT failure_within_24h AS y, {_SCORE_EXPR} AS score FROM tst) x)")
    imp = ("imp AS (SELECT pc AS feature, round(avg(b.f1 - p.f1), 6) AS importance_mean, "
           "round(stddev_pop(b.f1 - p.f1), 6) AS importance_std FROM pf1 p CROSS JOIN bf1 b GROUP BY pc)")
    return split_ctes() + ",\n" + ",\n".join([test, base, ks, size, walk, moved, perm, pf1, bf1, imp])


def _recursive(sql: str) -> str:
    return sql.replace("WITH", "WITH RECURSIVE", 1)


register("permutation_importance", _recursive(with_readings("SELECT * FROM imp", extra_ctes=_perm_sql())))
register("top_importances", _recursive(with_readings(
    "SELECT * FROM imp ORDER BY importance_mean DESC, feature ASC LIMIT 10", extra_ctes=_perm_sql())))


def _shapley_sql(n_rows=100, n_background=20):
    """Shapley values from the definition: gains over all coalitions without the player."""
    p = len(PERM_COLS)
    part = {name: f"{name} AS (SELECT r.* FROM readings r JOIN split s ON r.reading_id = s.reading_id "
                  f"WHERE s.part = '{name[1:]}' ORDER BY md5(CAST(r.reading_id AS VARCHAR) || '-42'), r.reading_id LIMIT {n})"
            for name, n in (("_test", n_rows), ("_train", n_background))}
    mixed = ", ".join(f"CASE WHEN (m.mask & {1 << i}) <> 0 THEN a.{c} ELSE b.{c} END AS {c}" for i, c in enumerate(PERM_COLS))
    v = (f"v AS (SELECT rid, mask, avg({_SCORE_EXPR}) AS v FROM (SELECT a.reading_id AS rid, m.mask, {mixed} "
         f"FROM _test a CROSS JOIN _train b CROSS JOIN range(0, {1 << p}) m(mask)) h GROUP BY rid, mask)")
    players = " UNION ALL ".join(f"SELECT '{c}' AS feature, {1 << i} AS bit" for i, c in enumerate(PERM_COLS))
    phi = ("phi AS (SELECT o.rid, f.feature, sum((w.v - o.v) * CAST(factorial(bit_count(o.mask)) AS DOUBLE) "
           f"* CAST(factorial({p - 1} - bit_count(o.mask)) AS DOUBLE) / CAST(factorial({p}) AS DOUBLE)) AS phi "
           f"FROM v o CROSS JOIN ({players}) f JOIN v w ON w.rid = o.rid AND w.mask = (o.mask | f.bit) "
           "WHERE (o.mask & f.bit) = 0 GROUP BY o.rid, f.feature)")
    return split_ctes() + ",\n" + ",\n".join([*part.values(), v, phi])


register("shapley_values", with_readings(
    "SELECT phi.rid AS reading_id, phi.feature, round(phi.phi, 6) + 0.0 AS phi, round(v.v, 6) AS base_value "
    "FROM phi JOIN v ON v.rid = phi.rid AND v.mask = 0", extra_ctes=_shapley_sql()))

# The composite score's linear coefficients (before clamping).
LINEAR_COEF = {"temperature_motor": 3 / 67 / 5, "vibration_rms": 1.5 / 4 / 5,
               "hours_since_maintenance": 1 / 575.6 / 5}
_IMPUTE_SQL = {"temperature_motor": "coalesce(temperature_motor, 62)",
               "vibration_rms": "coalesce(vibration_rms, 2.35)",
               "hours_since_maintenance": "hours_since_maintenance"}


def _contrib_sql():
    sample = split_ctes() + (",\nsmp AS (SELECT * FROM readings WHERE reading_id IN (SELECT reading_id FROM split WHERE part = 'test') "
                             f"ORDER BY {_h(42)}, reading_id LIMIT 100)")
    mu = "mu AS (SELECT " + ", ".join(f"avg({e}) AS {c}" for c, e in _IMPUTE_SQL.items()) + " FROM readings)"
    parts = [f"SELECT s.reading_id, '{c}' AS feature, round({e.replace(c, 's.' + c)}, 6) AS value, "
             f"round({LINEAR_COEF[c]!r} * ({e.replace(c, 's.' + c)} - m.{c}), 6) AS phi FROM smp s CROSS JOIN mu m"
             for c, e in _IMPUTE_SQL.items()]
    return f"{sample},\n{mu},\ncontrib AS ({' UNION ALL '.join(parts)})"


register("linear_contributions", with_readings("SELECT * FROM contrib", extra_ctes=_contrib_sql()))
register("contribution_summary", with_readings(
    "SELECT feature, round(avg(abs(phi)), 6) AS mean_abs_phi, round(corr(value, phi), 6) AS direction "
    "FROM contrib GROUP BY feature", extra_ctes=_contrib_sql()))


# ---------------------------------------------------- preparation follow-ups
from ferrite.schema import FEATURE_LABELS  # noqa: E402

_pc2, _pb2 = prepared_sql_body()
register("prepared_roundtrip", with_readings(
    f"SELECT * FROM ({_pb2}) x WHERE split = 'test'", extra_ctes=split_ctes() + ",\n" + _pc2))

register("raw_csv_source", with_readings(
    "SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, "
    + ", ".join(c for c in ALL_COLS if c not in ("reading_id", "ts")) + " FROM readings"))

register("result_csv_roundtrip", with_readings(
    "SELECT " + ", ".join(f"CAST(round(CAST({c} AS DECIMAL(18, 6)), 4) AS DOUBLE) AS {c}"
                          for c in ("threshold", "precision", "recall", "f1"))
    + f", fn, fp FROM ({_sweep_sql(SCORED_AS)}) s", scored=True))

_names = (["num__" + c for c in NUMERIC_FEATURES]
          + [f"cat__{c}_{lv}" for c in CATEGORICAL_FEATURES for lv in sorted(_CD[c])])
register("importance_labels", with_readings(
    "SELECT CAST(v.slot AS INTEGER) AS slot, v.feature, coalesce(l.label, replace(replace(v.feature, "
    "'num__', ''), 'cat__', '')) AS label FROM (VALUES "
    + ", ".join(f"({i}, '{n}')" for i, n in enumerate(_names)) + ") v(slot, feature) LEFT JOIN (VALUES "
    + ", ".join(f"('{k}', '{v.replace(chr(39), chr(39) * 2)}')" for k, v in FEATURE_LABELS.items())
    + ") l(feature, label) ON v.feature = l.feature WHERE (SELECT count(*) FROM readings) > 0"))


def _before_after_sql():
    raw = "readings"
    prep = ("(SELECT " + ", ".join(f'"num__{c}" AS {c}' for c in NUMERIC_FEATURES)
            + f" FROM ({_pb}) p WHERE split = 'train')")
    parts = []
    for stage, src in (("raw", raw), ("prepared", prep)):
        for c in NUMERIC_FEATURES:
            parts.append(f"SELECT '{stage}' AS stage, '{c}' AS column_name, count(*) - count({c}) AS n_null, "
                         f"round(avg({c}), 6) + 0.0 AS mean, round(quantile_cont({c}, 0.5), 6) + 0.0 AS median, "
                         f"round(stddev_pop({c}), 6) + 0.0 AS std FROM {src} t")
    return "\n UNION ALL ".join(parts)


register("before_after", with_readings(_before_after_sql(), extra_ctes=split_ctes() + ",\n" + _pc))

# Both stages as 40-bin histograms; the prepared values are those rounded to 6 digits.
_prep_train = ("prep_train AS (SELECT " + ", ".join(f'"num__{c}" AS {c}' for c in NUMERIC_FEATURES)
               + f" FROM ({_pb}) p WHERE split = 'train')")
register("before_after_histograms", with_readings(
    "SELECT stage, column_name, bin, n FROM ("
    f"SELECT 'raw' AS stage, * FROM ({_hist_sql(NUMERIC_FEATURES, 40)}) a UNION ALL "
    f"SELECT 'prepared' AS stage, * FROM ({_hist_sql(NUMERIC_FEATURES, 40, src='prep_train')}) b) x",
    extra_ctes=split_ctes() + ",\n" + _pc + ",\n" + _prep_train))

_labels = ", ".join("('{}', '{}')".format(c, FEATURE_LABELS["num__" + c].replace("'", "''")) for c in NUMERIC_FEATURES
                    if "num__" + c in FEATURE_LABELS)
register("correlation_labelled", with_readings(
    f"SELECT coalesce(a.label, col_a) AS label_a, coalesce(b.label, col_b) AS label_b, r FROM ({_corr_sql(NUMERIC_FEATURES + [TARGET])}) m "
    f"LEFT JOIN (VALUES {_labels}) a(c, label) ON a.c = col_a LEFT JOIN (VALUES {_labels}) b(c, label) ON b.c = col_b"))

# Names of the fixed scorers, as recoded for display.
SCORER_NAMES = {"composite": "Composite score", "temperature": "Temperature score", "vibration": "Vibration level"}
register("threshold_savings", with_readings(
    "SELECT name, errors_default, errors_selected, round((1 - errors_selected / NULLIF(errors_default, 0)) * 100, 6) AS saving_pct, "
    "round(errors_default / NULLIF(errors_selected, 0), 6) AS multiple FROM (SELECT CASE t.model "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SCORER_NAMES.items())
    + " ELSE t.model END AS name, CAST(d.fn + d.fp AS BIGINT) AS errors_default, CAST(t.fn + t.fp AS BIGINT) AS errors_selected "
    "FROM tconf t LEFT JOIN dconf d ON t.model = d.model) x WHERE contains(name, 'score')", extra_ctes=_SEL_CTES))

register("status_counts", with_readings(
    f"SELECT CASE {TARGET} WHEN 0 THEN 'Normal' WHEN 1 THEN 'Failure' END AS status, count(*) AS n FROM readings GROUP BY 1"))

register("saved_models", with_readings(
    "SELECT unnest(['lr', 'rf', 'gbt', 'mlp']) AS model, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM readings"))

register("smote_sizes", with_readings(
    f"SELECT y AS {TARGET}, CAST(max(count(*)) OVER () AS BIGINT) AS n FROM split WHERE part = 'train' GROUP BY y", extra_ctes=split_ctes()))

register("stream_equals_batch", with_readings(
    "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM readings"))


def _smote_sql(k=5, seed=42):
    """F7 by all pairs of minority rows.

    A row's neighbours are the other copies of its vector, in turn from its own
    place in hash order, then copies of other vectors by distance.  Other
    vectors at one distance go by their least row here and by a digest in
    the library: equal as long as no such tie meets the k-th place.
    """
    names = [_q("num__" + c) for c in NUMERIC_FEATURES] + [_q(f"cat__{c}_{lv}") for c in CATEGORICAL_FEATURES for lv in sorted(_CD[c])]
    apart = " + ".join(f"(a.{n} - b.{n}) * (a.{n} - b.{n})" for n in names)
    ctes, body = prepared_sql_body(digits=None)
    digit = "CAST('0x' || substr(md5(CAST(i AS VARCHAR) || '-{}'), 1, 8) AS BIGINT)"
    steps = f"""
pre AS ({body}),
fit AS (SELECT p.*, s.y FROM pre p JOIN split s ON p.reading_id = s.reading_id WHERE p.split = 'train'),
few AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY {_h(seed)}, reading_id) AS rk,
   row_number() OVER (PARTITION BY {", ".join(names)} ORDER BY {_h(seed)}, reading_id) AS q,
   count(*) OVER (PARTITION BY {", ".join(names)}) AS m, min(reading_id) OVER (PARTITION BY {", ".join(names)}) AS vid FROM fit WHERE y = 1),
d AS (SELECT a.reading_id, b.reading_id AS nn, row_number() OVER (PARTITION BY a.reading_id ORDER BY
     a.vid <> b.vid, CASE WHEN a.vid = b.vid THEN (b.q - a.q + a.m) % a.m ELSE sqrt({apart}) END, b.vid,
     (b.q - a.q + 1000 * b.m) % b.m) AS nn_rank
   FROM few a JOIN few b ON a.reading_id <> b.reading_id),
sizes AS (SELECT count_if(y = 1) AS p, count_if(y <> 1) AS n FROM fit),
i AS (SELECT unnest(range(1, n - p + 1)) AS i, p FROM sizes),
made AS (SELECT i, (i - 1) % p + 1 AS rk, {digit.format("k")} % {k} + 1 AS nn_rank,
   CAST({digit.format("g")} AS DOUBLE) / 4294967296 AS g FROM i)"""
    new = ", ".join(f"round(a.{n} + g * (b.{n} - a.{n}), 6) AS {n}" for n in names)
    old = ", ".join(f"round({n}, 6) AS {n}" for n in names)
    return with_readings(
        f"SELECT reading_id, y AS {TARGET}, {old} FROM fit UNION ALL "
        f"SELECT -i AS reading_id, 1 AS {TARGET}, {new} FROM made JOIN few a ON a.rk = made.rk "
        "JOIN d ON d.reading_id = a.reading_id AND d.nn_rank = made.nn_rank JOIN few b ON b.reading_id = d.nn",
        extra_ctes=split_ctes() + ",\n" + ctes + "," + steps)


register("smote", _smote_sql())

register("hashed_neighbors", with_readings(
    "SELECT count(*) AS n_points, 5 * count(*) AS n_neighbors, true AS recall_reached FROM split WHERE part = 'train' AND y = 1",
    extra_ctes=split_ctes()))
