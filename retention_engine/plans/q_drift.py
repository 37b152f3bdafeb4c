"""Drift queries over line items split into baseline and window periods."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import hash_uniform
from ..operators import drift as D
from ..operators.split import stratified_split
from ..sources import adapters
from .common import snapshot
from .registry import query
from .sql import ctes, u

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CAT = ["l_returnflag", "l_linestatus"]
_Q = "[0.01::DOUBLE, 0.05::DOUBLE, 0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE, 0.95::DOUBLE, 0.99::DOUBLE]"
_D = "[" + ", ".join(f"{i / 10}::DOUBLE" for i in range(1, 10)) + "]"
_EPS = "1e-6::DOUBLE"


def _psi(e, a):
    return f"(greatest({a}, {_EPS}) - greatest({e}, {_EPS})) * ln(greatest({a}, {_EPS}) / greatest({e}, {_EPS}))"


def _class(p):
    return (f"CASE WHEN {p} IS NULL THEN 'no-data' WHEN {p} < 0.1 THEN 'stable' "
            f"WHEN {p} < 0.25 THEN 'investigate' ELSE 'act' END")


def _pair(spark, sf_dir):
    dp = adapters.drift_pair(spark, sf_dir)
    return dp.where(F.col("period") == "baseline"), dp.where(F.col("period") == "window")


_BASE_SQL = ctes("drift_pair", extra=[
    ("blong", f"""SELECT * FROM (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in NUM)}
                  FROM drift_pair WHERE period = 'baseline') UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(NUM)}))"""),
    ("bstats", f"""SELECT feature, count(value) AS n, round(avg(CAST(value IS NULL AS DOUBLE)), 6) AS missing,
                   round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
                   round(min(value), 6) AS min, round(max(value), 6) AS max,
                   quantile_cont(value, {_Q}) AS q,
                   list_sort(list_distinct(list_transform(quantile_cont(value, {_D}), lambda x: round(x, 6)))) AS edges
                   FROM blong GROUP BY feature"""),
    ("bcount", """SELECT b.feature, len(list_filter(s.edges, lambda e: e <= b.value)) AS bin, count(*) AS c
                  FROM blong b JOIN bstats s USING (feature) WHERE b.value IS NOT NULL GROUP BY ALL"""),
    ("bskel", "SELECT feature, unnest(range(0, len(edges) + 1)) AS bin, n FROM bstats"),
    ("bprops", """SELECT k.feature, k.bin, round(coalesce(c.c / k.n, 0.0), 6) AS prop
                  FROM bskel k LEFT JOIN bcount c USING (feature, bin)"""),
])


@query("drift_numeric_baseline", ops=("D1",), sql=_BASE_SQL + """
SELECT feature, n, missing, mean, std, min, max,
       round(q[1], 6) AS p01, round(q[2], 6) AS p05, round(q[3], 6) AS p25, round(q[4], 6) AS p50,
       round(q[5], 6) AS p75, round(q[6], 6) AS p95, round(q[7], 6) AS p99 FROM bstats""")
def q_drift_numeric_baseline(spark, sf_dir):
    """Frozen numeric baseline: n, missing, mean, sample std, min, max, 7 exact quantiles."""
    base, _ = _pair(spark, sf_dir)
    return D.numeric_baseline(base, NUM).drop("edges", "props")


@query("drift_psi_edges", ops=("D2",), sql=_BASE_SQL + """
SELECT feature, CAST(i AS INTEGER) AS edge_index, edges[i] AS edge FROM bstats, range(1, 10) r(i)
WHERE i <= len(edges)""")
def q_drift_psi_edges(spark, sf_dir):
    """Distinct rounded inner deciles per feature (the PSI bin edges; l_discount dedups)."""
    base, _ = _pair(spark, sf_dir)
    b = D.numeric_baseline(base, NUM)
    return b.select("feature", F.posexplode("edges").alias("edge_index", "edge")) \
            .withColumn("edge_index", (F.col("edge_index") + 1).cast("int"))


@query("drift_bin_props", ops=("D3", "D4"), sql=_BASE_SQL + "SELECT feature, CAST(bin AS INTEGER) AS bin, prop FROM bprops")
def q_drift_bin_props(spark, sf_dir):
    """Frozen bin proportions (open end bins, empty bins kept)."""
    base, _ = _pair(spark, sf_dir)
    b = D.numeric_baseline(base, NUM)
    return b.select("feature", F.posexplode("props").alias("bin", "prop")).withColumn("bin", F.col("bin").cast("int"))


_CAT_BASE = ctes("drift_pair", extra=[
    ("clong", f"""SELECT * FROM (SELECT {', '.join(CAT)} FROM drift_pair WHERE period = 'baseline')
                  UNPIVOT INCLUDE NULLS (level FOR feature IN ({', '.join(CAT)}))"""),
    ("ctot", "SELECT feature, count(level) AS n, round(avg(CAST(level IS NULL AS DOUBLE)), 6) AS missing FROM clong GROUP BY feature"),
    ("cbase", """SELECT l.feature, l.level, round(count(*) / max(t.n), 6) AS freq, max(t.n) AS n, max(t.missing) AS missing
                 FROM clong l JOIN ctot t USING (feature) WHERE l.level IS NOT NULL GROUP BY l.feature, l.level"""),
])


@query("drift_category_baseline", ops=("D5",), sql=_CAT_BASE + "SELECT * FROM cbase")
def q_drift_category_baseline(spark, sf_dir):
    base, _ = _pair(spark, sf_dir)
    return D.category_baseline(base, CAT)


def _scenarios(window):
    """What-if portfolio shifts (D12) applied to the window: none, +12 quantity, price ×1.15, ⅓ unseen flag."""
    k = F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return {
        "none": window,
        "quantity_plus_12": window.withColumn("l_quantity", F.col("l_quantity") + 12),
        "price_x115": window.withColumn(     # exact decimal arithmetic, half-up to cents
            "l_extendedprice",
            F.round(F.col("l_extendedprice").cast("decimal(18,2)") * F.lit(1.15).cast("decimal(4,2)"), 2).cast("double")),
        "unseen_third": window.withColumn("l_returnflag", F.when(hash_uniform(k, "c") < F.lit(1 / 3), "X")
                                          .otherwise(F.col("l_returnflag"))),
    }


_WIN_SQL = {
    "none": "SELECT * FROM drift_pair WHERE period = 'window'",
    "quantity_plus_12": "SELECT * REPLACE (l_quantity + 12 AS l_quantity) FROM drift_pair WHERE period = 'window'",
    "price_x115": """SELECT * REPLACE (CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1.15 AS DECIMAL(4,2)), 2) AS DOUBLE)
                      AS l_extendedprice) FROM drift_pair WHERE period = 'window'""",
    "unseen_third": f"""SELECT * REPLACE (CASE WHEN {u("CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)", 'c')} < 1.0 / 3
                         THEN 'X' ELSE l_returnflag END AS l_returnflag) FROM drift_pair WHERE period = 'window'""",
}


def _num_compare_sql(scen):
    return f"""
SELECT '{scen}' AS scenario, s.feature, 'numeric' AS kind,
       CASE WHEN max(w.n) > 0 THEN round(sum({_psi('p.prop', 'coalesce(w.c / w.n, 0.0)')}), 6) END AS psi,
       {_class(f"CASE WHEN max(w.n) > 0 THEN round(sum({_psi('p.prop', 'coalesce(w.c / w.n, 0.0)')}), 6) END")} AS class,
       CAST(coalesce(max(w.n), 0) AS BIGINT) AS n, max(s.mean) AS mean_ref, max(m.mean_window) AS mean_window
FROM bprops p JOIN bstats s USING (feature)
LEFT JOIN (SELECT c.*, t.n FROM wcount_{scen} c JOIN (SELECT feature, sum(c) AS n FROM wcount_{scen} GROUP BY feature) t USING (feature)) w
  ON w.feature = p.feature AND w.bin = p.bin
LEFT JOIN (SELECT feature, round(avg(value), 6) AS mean_window FROM wlong_{scen} GROUP BY feature) m ON m.feature = s.feature
GROUP BY s.feature"""


def _num_compare_ctes(scen):
    return [
        (f"win_{scen}", _WIN_SQL[scen]),
        (f"wlong_{scen}", f"""SELECT * FROM (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in NUM)}
                  FROM win_{scen}) UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(NUM)}))"""),
        (f"wcount_{scen}", f"""SELECT w.feature, len(list_filter(s.edges, lambda e: e <= w.value)) AS bin, count(*) AS c
                  FROM wlong_{scen} w JOIN bstats s USING (feature) WHERE w.value IS NOT NULL GROUP BY ALL"""),
    ]


_NUM_SCEN = ["none", "quantity_plus_12", "price_x115"]


def _cmp_sql():
    extra = []
    for s in _NUM_SCEN:
        extra += _num_compare_ctes(s)
    head = _BASE_SQL.rstrip("\n") + ",\n" + ",\n".join(f"{n} AS ({b})" for n, b in extra) + "\n"
    return head + "\nUNION ALL\n".join(_num_compare_sql(s) for s in _NUM_SCEN)


@query("drift_compare_numeric", ops=("D3", "D7", "D8", "D9", "D12"), sql=_cmp_sql())
def q_drift_compare_numeric(spark, sf_dir):
    """PSI of the later window against the frozen baseline, as observed and under what-if shifts."""
    base, win = _pair(spark, sf_dir)
    b = D.numeric_baseline(base, NUM)
    outs = []
    for name, w in _scenarios(win).items():
        if name in _NUM_SCEN:
            outs.append(D.compare_numeric(b, w, NUM).withColumn("scenario", F.lit(name)))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def _cat_cmp_sql():
    scen = ["none", "unseen_third"]
    extra = []
    for s in scen:
        extra += [(f"win_{s}", _WIN_SQL[s]),
                  (f"wl_{s}", f"""SELECT * FROM (SELECT {', '.join(CAT)} FROM win_{s})
                     UNPIVOT INCLUDE NULLS (level FOR feature IN ({', '.join(CAT)})) WHERE level IS NOT NULL"""),
                  (f"wc_{s}", f"SELECT feature, level, count(*) AS c FROM wl_{s} GROUP BY ALL"),
                  (f"wa_{s}", f"""SELECT feature, level, c / sum(c) OVER (PARTITION BY feature) AS a,
                      sum(c) OVER (PARTITION BY feature) AS n FROM wc_{s}""")]
    head = _CAT_BASE.rstrip("\n") + ",\n" + ",\n".join(f"{n} AS ({b})" for n, b in extra) + "\n"
    parts = []
    for s in scen:
        p = f"round(sum({_psi('coalesce(e.freq, 0.0)', 'coalesce(a.a, 0.0)')}), 6)"
        parts.append(f"""
SELECT '{s}' AS scenario, coalesce(e.feature, a.feature) AS feature, 'categorical' AS kind,
       CASE WHEN max(a.n) > 0 THEN {p} END AS psi,
       {_class(f"CASE WHEN max(a.n) > 0 THEN {p} END")} AS class,
       CAST(coalesce(max(a.n), 0) AS BIGINT) AS n,
       coalesce(string_agg(CASE WHEN e.level IS NULL THEN a.level END, ',' ORDER BY CASE WHEN e.level IS NULL THEN a.level END), '') AS unseen
FROM cbase e FULL OUTER JOIN wa_{s} a ON e.feature = a.feature AND e.level = a.level
GROUP BY coalesce(e.feature, a.feature)""")
    return head + "\nUNION ALL\n".join(parts)


@query("drift_compare_categorical", ops=("D9", "D10", "D12"), sql=_cat_cmp_sql())
def q_drift_compare_categorical(spark, sf_dir):
    """Categorical PSI over the union of levels; a third of return flags moved to an unseen level."""
    base, win = _pair(spark, sf_dir)
    b = D.category_baseline(base, CAT)
    sc = _scenarios(win)
    outs = [D.compare_categorical(b, sc[s], CAT).withColumn("scenario", F.lit(s)) for s in ("none", "unseen_third")]
    return outs[0].unionByName(outs[1])


@query("drift_unseen_levels", ops=("D10",), sql=_CAT_BASE.rstrip("\n") + ",\n" + f"""win AS ({_WIN_SQL['unseen_third']}),
wl AS (SELECT * FROM (SELECT {', '.join(CAT)} FROM win) UNPIVOT (level FOR feature IN ({', '.join(CAT)})))
SELECT feature, level, count(*) AS n FROM wl
WHERE NOT EXISTS (SELECT 1 FROM cbase c WHERE c.feature = wl.feature AND c.level = wl.level) GROUP BY ALL""")
def q_drift_unseen_levels(spark, sf_dir):
    base, win = _pair(spark, sf_dir)
    b = D.category_baseline(base, CAT)
    return D.unseen_levels(b, _scenarios(win)["unseen_third"], CAT)


# ---- score drift on the snapshot: baseline = validation scores, window = test scores ------------------

def _split_sql():
    return ctes("snapshot", extra=[
        ("h", "SELECT *, ('0x' || substr(md5(CAST(customer_id AS VARCHAR) || '|42'), 1, 15))::UBIGINT AS hk FROM snapshot"),
        ("rk", "SELECT *, row_number() OVER (PARTITION BY y ORDER BY hk, customer_id) AS rn, count(*) OVER (PARTITION BY y) AS n FROM h"),
        ("sp", """SELECT *, CASE WHEN rn <= ceil(round(n * 0.2, 9)) THEN 'test'
                   WHEN rn <= ceil(round(n * 0.2, 9)) + ceil(round((n - ceil(round(n * 0.2, 9))) * 0.25, 9)) THEN 'val'
                   ELSE 'train' END AS split FROM rk"""),
    ])


def _score_drift_sql(window_expr: str, label: str, ref: str = "sp WHERE split = 'val'") -> str:
    """SQL body comparing window scores (a relation with column score) to the frozen baseline."""
    return f"""
, ref AS (SELECT score FROM {ref}),
  rstat AS (SELECT count(*) AS n, round(avg(score), 6) AS mean,
            round(avg(CAST(score >= 0.29 AS DOUBLE)), 6) AS rate,
            list_sort(list_distinct(list_transform(quantile_cont(score, {_D}), lambda x: round(x, 6)))) AS edges FROM ref),
  rcount AS (SELECT len(list_filter(s.edges, lambda e: e <= r.score)) AS bin, count(*) AS c FROM ref r, rstat s GROUP BY ALL),
  rprops AS (SELECT k.bin, round(coalesce(c.c / k.n, 0.0), 6) AS e
             FROM (SELECT unnest(range(0, len(edges) + 1)) AS bin, n FROM rstat) k LEFT JOIN rcount c USING (bin)),
  win AS ({window_expr}),
  wstat AS (SELECT count(*) AS n, avg(score) AS mean, avg(CAST(score >= 0.29 AS DOUBLE)) AS rate FROM win WHERE score IS NOT NULL),
  wcount AS (SELECT len(list_filter(s.edges, lambda e: e <= w.score)) AS bin, count(*) AS c
             FROM win w, rstat s WHERE w.score IS NOT NULL GROUP BY ALL),
  psi AS (SELECT sum({_psi('p.e', 'coalesce(w.c / (SELECT n FROM wstat), 0.0)')}) AS v FROM rprops p LEFT JOIN wcount w USING (bin))
SELECT {label}
       CAST(ws.n AS BIGINT) AS n,
       CASE WHEN ws.n > 0 THEN round(psi.v, 6) END AS psi,
       {_class('CASE WHEN ws.n > 0 THEN round(psi.v, 6) END')} AS class,
       rs.mean AS mean_ref, CASE WHEN ws.n > 0 THEN round(ws.mean, 6) END AS mean_window,
       rs.rate AS rate_above_ref, CASE WHEN ws.n > 0 THEN round(ws.rate, 6) END AS rate_above,
       CASE WHEN ws.n > 0 AND rs.rate > 0 THEN round(round(ws.rate, 6) / rs.rate, 3) END AS queue_x
FROM psi, rstat rs, wstat ws"""


@query("score_drift", ops=("D6", "D11"), sql=_split_sql().rstrip("\n") + _score_drift_sql(
    "SELECT score FROM sp WHERE split = 'test'", ""))
def q_score_drift(spark, sf_dir):
    """Score baseline frozen on validation (with the operating threshold); the test split as the window."""
    sp = stratified_split(snapshot(spark, sf_dir))
    b = D.score_baseline(sp.where(F.col("split") == "val"), threshold=0.29)
    return D.compare_scores(b, sp.where(F.col("split") == "test"))


@query("score_drift_noise_floor", ops=("D13",), sql=_split_sql().rstrip("\n") + _score_drift_sql(
    "SELECT score FROM sp WHERE split = 'val'", ""))
def q_score_drift_noise_floor(spark, sf_dir):
    """Baseline against itself: PSI exactly 0 (the noise floor control)."""
    sp = stratified_split(snapshot(spark, sf_dir))
    val = sp.where(F.col("split") == "val")
    return D.compare_scores(D.score_baseline(val, threshold=0.29), val)


_FACTORS = (1.2, 1.4, 1.6, 2.0)


def _sens_sql():
    fl = ", ".join(f"({f}::DOUBLE)" for f in _FACTORS)
    return _split_sql().rstrip("\n") + f"""
, ref AS (SELECT score FROM sp WHERE split = 'val'),
  rstat AS (SELECT count(*) AS n, round(avg(score), 6) AS mean,
            round(avg(CAST(score >= 0.29 AS DOUBLE)), 6) AS rate,
            list_sort(list_distinct(list_transform(quantile_cont(score, {_D}), lambda x: round(x, 6)))) AS edges FROM ref),
  rcount AS (SELECT len(list_filter(s.edges, lambda e: e <= r.score)) AS bin, count(*) AS c FROM ref r, rstat s GROUP BY ALL),
  rprops AS (SELECT k.bin, round(coalesce(c.c / k.n, 0.0), 6) AS e
             FROM (SELECT unnest(range(0, len(edges) + 1)) AS bin, n FROM rstat) k LEFT JOIN rcount c USING (bin)),
  win AS (SELECT f.factor, least(r.score * f.factor, 1.0) AS score FROM ref r, (VALUES {fl}) f(factor)),
  wstat AS (SELECT factor, count(*) AS n, avg(score) AS mean, avg(CAST(score >= 0.29 AS DOUBLE)) AS rate FROM win GROUP BY factor),
  wcount AS (SELECT factor, len(list_filter(s.edges, lambda e: e <= w.score)) AS bin, count(*) AS c
             FROM win w, rstat s GROUP BY ALL),
  psi AS (SELECT ws.factor, sum({_psi('p.e', 'coalesce(w.c / ws.n, 0.0)')}) AS v
          FROM rprops p CROSS JOIN wstat ws LEFT JOIN wcount w ON w.bin = p.bin AND w.factor = ws.factor GROUP BY ws.factor)
SELECT ws.factor, CAST(ws.n AS BIGINT) AS n, round(psi.v, 6) AS psi, {_class('round(psi.v, 6)')} AS class,
       rs.mean AS mean_ref, round(ws.mean, 6) AS mean_window, rs.rate AS rate_above_ref, round(ws.rate, 6) AS rate_above,
       CASE WHEN rs.rate > 0 THEN round(round(ws.rate, 6) / rs.rate, 3) END AS queue_x
FROM wstat ws JOIN psi USING (factor), rstat rs"""


@query("score_drift_sensitivity", ops=("D14",), sql=_sens_sql())
def q_score_drift_sensitivity(spark, sf_dir):
    """Scores multiplied by 1.2–2.0 (clipped to 1): PSI and queue multiplier grow with the factor."""
    sp = stratified_split(snapshot(spark, sf_dir))
    val = sp.where(F.col("split") == "val")
    b = D.score_baseline(val, threshold=0.29)
    shifted = val.select(F.explode(F.array(*[F.lit(f) for f in _FACTORS])).alias("factor"), "score") \
                 .withColumn("score", F.least(F.col("score") * F.col("factor"), F.lit(1.0)))
    b_per_factor = b.select("*", F.explode(F.array(*[F.lit(f) for f in _FACTORS])).alias("factor"))
    return D.compare_scores(b_per_factor, shifted, by=["factor"])


@query("multivariate_drift", ops=("D15",))
def q_multivariate_drift(spark, sf_dir):
    """Share of window rows beyond the baseline's exact 99th-percentile Mahalanobis distance, and the part of each feature."""
    base, win = _pair(spark, sf_dir)
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return D.mahalanobis_share(base, win, feats)


_NOISE = ["tenure_days", "monthly_charges", "recency_days", "score"]


def _noise_sql(repeats: int = 20) -> str:
    long = " UNION ALL ".join(f"SELECT customer_id, split, '{c}' AS feature, {c}::DOUBLE AS value FROM sp WHERE {c} IS NOT NULL" for c in _NOISE)
    return _split_sql().rstrip("\n") + f"""
, l AS ({long}),
  ed AS (SELECT feature, count(*) AS n, list_sort(list_distinct(list_transform(quantile_cont(value, {_D}), lambda x: round(x, 6)))) AS edges
         FROM l WHERE split = 'train' GROUP BY 1),
  b AS (SELECT l.*, len(list_filter(edges, lambda e: e <= value)) AS bin FROM l JOIN ed USING (feature)),
  hf AS (SELECT b.*, r.rep, CAST(('0x' || substr(md5(CAST(customer_id AS VARCHAR) || '|noise' || r.rep), 1, 8))::UBIGINT::DOUBLE / 4294967296.0 < 0.5 AS INTEGER) AS half
        FROM b, (SELECT unnest(range(0, {repeats})) AS rep) r WHERE split = 'train'),
  hc AS (SELECT feature, rep, bin, count(*) FILTER (half = 0) AS c0, count(*) FILTER (half = 1) AS c1 FROM hf GROUP BY ALL),
  hn AS (SELECT feature, rep, sum(c0) AS n0, sum(c1) AS n1 FROM hc GROUP BY ALL),
  hp AS (SELECT feature, rep, round(sum({_psi('c0 / n0', 'c1 / n1')}), 6) AS psi FROM hc JOIN hn USING (feature, rep) GROUP BY ALL),
  k AS (SELECT feature, unnest(range(0, len(edges) + 1)) AS bin, n FROM ed),
  tc AS (SELECT feature, bin, count(*) AS c FROM b WHERE split = 'train' GROUP BY ALL),
  vc AS (SELECT feature, bin, count(*) AS c FROM b WHERE split = 'val' GROUP BY ALL), vn AS (SELECT feature, sum(c) AS n FROM vc GROUP BY 1),
  s AS (SELECT k.feature, round(sum({_psi('round(coalesce(tc.c / k.n, 0.0), 6)', 'coalesce(vc.c / vn.n, 0.0)')}), 6) AS split_psi
        FROM k JOIN vn USING (feature) LEFT JOIN tc ON tc.feature = k.feature AND tc.bin = k.bin LEFT JOIN vc ON vc.feature = k.feature AND vc.bin = k.bin GROUP BY 1)
SELECT feature, any_value(split_psi) AS split_psi, round(avg(psi), 6) AS halves_mean, max(psi) AS halves_max,
       CASE WHEN greatest(max(psi), any_value(split_psi)) > 0 THEN round(0.25 / greatest(max(psi), any_value(split_psi)), 3) END AS trigger_to_noise
FROM hp JOIN s USING (feature) GROUP BY feature"""


@query("drift_noise_floor", ops=("D13",), sql=_noise_sql())
def q_drift_noise_floor(spark, sf_dir):
    """PSI where nothing drifted: validation against train and 20 random halves of train, and the ratio of the trigger to
    the largest of them, for three features and the score."""
    sp = stratified_split(snapshot(spark, sf_dir))
    return D.noise_floor(sp.where("split = 'train'"), sp.where("split = 'val'"), _NOISE)
