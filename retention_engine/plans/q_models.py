"""Model queries (rows-only checks: fitted models have no SQL oracle) — M-A…M-M, V4, V11, G3–G5, Q7."""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from ..functions.columns import r6
from ..operators import contract as CO
from ..operators import ensembles as EN
from ..operators import fairness as FA
from ..operators import metrics as M
from ..operators import models as MD
from ..operators import search as SR
from ..operators import selection as SE
from ..operators.ranking import with_row
from ..operators.split import holdout_split, repeated_folds, stratified_split
from ..session import scratch_path
from .common import snapshot
from .q_split import _SPLIT as SPLIT_SQL
from .registry import query

ZERO = ["total_charges"]
NUMS = ["tenure_days", "monthly_charges", "recency_days"]
CATS = ["segment", "last_priority", "region", "balance_sign"]
LABEL = "y_signal"


def _split(spark, sf_dir):
    sp = stratified_split(snapshot(spark, sf_dir))
    return sp.where(F.col("split") == "train"), sp.where(F.col("split") == "val")


@query("lr_validation", ops=("M-B", "M-H", "M-I", "F11"))
def q_lr_validation(spark, sf_dir):
    """L2 logistic regression (C = 1) fit on train, batch-scored on validation: AP, Brier, n."""
    tr, va = _split(spark, sf_dir)
    m = MD.fit_pipeline(tr, "lr", ZERO, NUMS, CATS, label=LABEL)
    return MD.validation_metrics(m, va, LABEL)


@query("model_families", ops=("M-A", "M-B", "M-C", "M-D", "M-E", "M-F", "M-G"))
def q_model_families(spark, sf_dir):
    """Prior, LR, LR on an 85 % budget, unpruned tree, both forests, boosting and an MLP on the same split."""
    tr, va = _split(spark, sf_dir)
    budget = holdout_split(tr, 0.15, LABEL).where("part = 'fit'").drop("part")
    d = len(MD.fit_pipeline(tr, "prior", ZERO, NUMS, CATS, label=LABEL).stages[-3].feature_names())
    specs = [("prior", tr, {}), ("lr", tr, {}), ("lr_budget85", budget, {}), ("tree", tr, {}),
             ("lr_balanced", MD.balanced_weights(tr, LABEL), {"weight_col": "weight"}), ("rf", tr, {"numTrees": 300}),
             ("rf_unregularised", tr, {"numTrees": 300, "minInstancesPerNode": 1}), ("gbt", tr, {}), ("mlp_16", tr, {"layers": [d, 16, 2]})]
    rows = []
    for name, data, kw in specs:
        kind = name.split("_")[0]
        m = MD.fit_pipeline(data, kind, ZERO, NUMS, CATS, label=LABEL, **kw)
        r = MD.validation_metrics(m, va, LABEL).first()
        rows.append((name, r["ap"], r["brier"]))
    return spark.createDataFrame(rows, "model string, ap double, brier double")


@query("lr_odds_ratios", ops=("M-K", "F10"))
def q_lr_odds_ratios(spark, sf_dir):
    """exp(β) per encoded feature (names from the fitted preprocessing stage)."""
    tr, _ = _split(spark, sf_dir)
    m = MD.fit_pipeline(tr, "lr", ZERO, NUMS, CATS, label=LABEL)
    return spark.createDataFrame(MD.odds_ratios(m), "feature string, coef double, odds_ratio double") \
                .select("feature", r6("coef").alias("coef"), r6("odds_ratio").alias("odds_ratio"))


@query("impurity_importance", ops=("M-M",))
def q_impurity_importance(spark, sf_dir):
    """Top-5 impurity importances of the random forest."""
    tr, _ = _split(spark, sf_dir)
    m = MD.fit_pipeline(tr, "rf", ZERO, NUMS, CATS, label=LABEL, numTrees=300)
    return spark.createDataFrame(MD.impurity_importance(m)[:5], "feature string, importance double")


@query("permutation_importance", ops=("M-L",))
def q_permutation_importance(spark, sf_dir):
    """AP drop on validation when each raw feature is permuted (10 repeats, one grouped AP)."""
    tr, va = _split(spark, sf_dir)
    m = MD.fit_pipeline(tr, "lr", ZERO, NUMS, CATS, label=LABEL)
    return MD.permutation_importance(m, va, ZERO + NUMS + CATS, label=LABEL, repeats=10)


#: L-BFGS stops at this relative change; below it the line search fails on some folds without a better objective.
_LR = {"kind": "lr", "tol": 1e-6}
_GRID = [_LR | {"C": c, "l1_ratio": l1} for c in (0.001, 0.01, 0.1, 1.0, 10.0, 100.0) for l1 in (0.0, 0.5, 1.0)]
REPS = 3


def _encoded(spark, sf_dir, reps=REPS, encoding="onehot", folds=None):
    """Train's folds (5 of each repetition), encoded once for all candidates."""
    if folds is None:
        folds = repeated_folds(_split(spark, sf_dir)[0], k=5, reps=reps, label=LABEL)
    return SR.encode_folds(folds, ZERO, NUMS, CATS, LABEL, encoding)


def _lr_choice(spark, sf_dir, candidates, k):
    """Search over LR candidates and the 1-SE choice: smallest C, then largest l1."""
    table = SR.table(SR.run(_encoded(spark, sf_dir), candidates, spark))
    params = spark.createDataFrame([(i, c["C"], c["l1_ratio"]) for i, c in enumerate(candidates)], "candidate long, C double, l1 double")
    chosen = SR.one_se(table.join(params, "candidate"), [F.col("C").asc(), F.col("l1").desc(), F.col("candidate").asc()])
    return SR.rounded(chosen.drop("scores", "seconds").withColumn("candidates", F.lit(k)))


@query("grid_search_lr", ops=("V4", "V1", "V6", "S4"))
def q_grid_search_lr(spark, sf_dir):
    """18-config LR grid (C × l1) on the same 5 × 3 stratified folds of train, encoded once; the 1-SE choice on unrounded
    means with its train mean, gap and the number of its fits that converged."""
    return _lr_choice(spark, sf_dir, _GRID, len(_GRID))


@query("random_search_lr", ops=("V5", "V6"))
def q_random_search_lr(spark, sf_dir):
    """40 random draws (C log-uniform in 0.001 … 100, l1 uniform) on the same 5 × 3 folds: 600 fits, and the 1-SE choice."""
    draws = SE.random_search_configs(spark, 40, {"C": (1e-3, 1e2, True), "l1_ratio": (0.0, 1.0, False)}).orderBy("draw").collect()   # 40 rows
    return _lr_choice(spark, sf_dir, [_LR | {"C": r["C"], "l1_ratio": r["l1_ratio"]} for r in draws], 40)


_TABLE = [("prior", {"kind": "prior"}), ("lr", _LR), ("lr, C 0.01", _LR | {"C": 0.01}), ("lr, l1", _LR | {"C": 0.1, "l1_ratio": 1.0}),
          ("tree, unpruned", {"kind": "tree"}), ("tree, leaves of 40", {"kind": "tree", "maxDepth": 8, "minInstancesPerNode": 40})]


@query("cv_table", ops=("V1", "V2", "S4"))
def q_cv_table(spark, sf_dir):
    """Candidates on the same 5 × 3 folds: mean, std, mean on train, gap, difference from LR in its std, and the score of
    every fold."""
    table = SR.table(SR.run(_encoded(spark, sf_dir), [c for _, c in _TABLE], spark))
    names = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(_TABLE)], "candidate long, model string")
    base = table.where("candidate = 1").select(F.col("mean").alias("bm"), F.col("std").alias("bs"))
    out = with_row(table.join(names, "candidate"), base)
    return SR.rounded(out.select("model", "mean", "std", "train_mean", "gap", (F.col("mean") - F.col("bm")).alias("delta"),
                                 F.try_divide(F.col("mean") - F.col("bm"), F.col("bs")).alias("delta_in_std"), F.col("k").alias("folds"),
                                 F.transform("scores", lambda s: r6(s)).alias("scores")))


@query("ablation", ops=("V11", "P3", "V12"))
def q_ablation(spark, sf_dir):
    """Leave-one-feature-out on 5 × 3 folds: the loss of AP when a whole original column goes ('useful' when it exceeds
    half the base's std), then all columns whose loss is not positive go together and the rest is fitted once more."""
    encoded = _encoded(spark, sf_dir)
    feats = ZERO + NUMS + CATS
    first = SR.table(SR.run(encoded, [_LR] + [_LR | {"without": [f]} for f in feats], spark)).select("candidate", "mean", "std")
    rows = {r["candidate"]: (r["mean"], r["std"]) for r in first.collect()}                      # one row a candidate
    base, std = rows[0]
    useless = [f for i, f in enumerate(feats) if base - rows[i + 1][0] <= 0]
    out = [("(none)", 0, base, 0.0, False)] + [(f, 1, rows[i + 1][0], base - rows[i + 1][0], base - rows[i + 1][0] > std / 2) for i, f in enumerate(feats)]
    if useless and len(useless) < len(feats):
        joint = SR.table(SR.run(encoded, [_LR | {"without": useless}], spark)).first()["mean"]
        out.append(("+".join(useless), len(useless), joint, base - joint, base - joint > std / 2))
    return SR.rounded(spark.createDataFrame(out, "dropped string, n_dropped long, mean double, loss double, useful boolean"))


@query("promote_artifact", ops=("G3", "G4", "G5", "G7", "IO6", "IO7"))
def q_promote_artifact(spark, sf_dir):
    """Measure-then-promote: fit, gate on validation (AP ≥ 0.66, Brier ≤ 0.14); only an approved model
    is written with its baselines, re-loaded through the four checks and compared score-for-score."""
    tr, va = _split(spark, sf_dir)
    r = MD.promote(spark, tr, va, "lr", ZERO, NUMS, CATS, LABEL, threshold=0.29, lineage={"source": sf_dir})
    return spark.createDataFrame([(r["ap"], r["brier"], r["approved"], r["written"], r["round_trip_identical"])],
                                 "ap double, brier double, approved boolean, written boolean, round_trip_identical boolean")


@query("promote_approved", ops=("G3", "G4", "G5", "G7", "IO6", "IO7"), sql="""
SELECT * FROM (VALUES ('approved', true), ('written', true), ('round trip identical', true), ('same content, same fingerprint', true),
  ('load', true), ('refuses metadata missing', true), ('refuses declared features', true), ('refuses library version', true),
  ('refuses baseline missing', true)) v("check", ok)""")
def q_promote_approved(spark, sf_dir):
    """The same promotion with limits that the model meets (AP ≥ 0.1, Brier ≤ 0.5, parameters of this query), so that
    the save, the four load checks and the round trip run; then each refusal on a spoiled copy."""
    tr, va = _split(spark, sf_dir)
    r = MD.promote(spark, tr, va, "lr", ZERO, NUMS, CATS, LABEL, threshold=0.29, min_ap=0.1, max_brier=0.5, lineage={"source": sf_dir})
    model, meta, base = MD.load_artifact(spark, r["path"])
    rows = [("approved", r["approved"]), ("written", r["written"]), ("round trip identical", r["round_trip_identical"])]
    again = scratch_path(spark, "artifact-again")
    rows.append(("same content, same fingerprint", MD.save_artifact(model, meta, base, again) == r["fingerprint"]))
    rows.append(("load", MD.load_artifact(spark, again)[1]["features"] == meta["features"]))

    def refuses(what: str, path: str) -> bool:
        try:
            MD.load_artifact(spark, path)
        except MD.ArtifactError as e:
            return what in str(e)
        return False
    spoiled = {"declared features": dict(meta, features=meta["features"][1:]), "library version": dict(meta, spark_version="0")}
    rows.append(("refuses metadata missing", refuses("metadata missing", scratch_path(spark, "artifact-none"))))
    for what, m in spoiled.items():
        path = scratch_path(spark, "artifact-spoiled")
        MD.save_artifact(model, m, base, path, keep_version=True)
        rows.append((f"refuses {what}", refuses({"library version": "saved with Spark"}.get(what, what), path)))
    path = scratch_path(spark, "artifact-bare")
    MD.save_artifact(model, meta, {k: v for k, v in base.items() if k != "score"}, path)
    rows.append(("refuses baseline missing", refuses("baseline_score missing", path)))
    return spark.createDataFrame(rows, "check string, ok boolean")


#: Declared limits of the numeric fields (a business decision, wider than the data).
LIMITS = {"total_charges": (0.0, 1e8), "tenure_days": (0.0, 20000.0), "monthly_charges": (0.0, 1e6), "recency_days": (0.0, 20000.0)}


def _contract_sql() -> str:
    name = lambda c: f"'{c}' AS field, trim(lower(regexp_replace('{c}', '[^0-9a-zA-Z]+', '_', 'g')), '_') AS identifier"
    rows = [f"SELECT variant, {i} AS position, {name(c)}, 'numeric' AS kind, {LIMITS[c][0]}::DOUBLE AS lo, {LIMITS[c][1]}::DOUBLE AS hi, '' AS allowed, "
            f"{c in ZERO} AS nullable FROM fit GROUP BY variant" for i, c in enumerate(ZERO + NUMS)]
    rows += [f"SELECT variant, {i + len(ZERO + NUMS)}, {name(c)}, 'categorical', NULL, NULL, string_agg(DISTINCT {c}, ',' ORDER BY {c}), false FROM fit GROUP BY variant"
             for i, c in enumerate(CATS)]
    return " UNION ALL ".join(rows)


@query("contract_from_pipeline", ops=("P10", "P9"), sql=SPLIT_SQL + f"""
, fit AS (SELECT 'all levels' AS variant, * FROM sp WHERE split = 'train'
          UNION ALL SELECT 'a level less', * FROM sp WHERE split = 'train' AND segment > (SELECT min(segment) FROM sp WHERE split = 'train')),
  c AS ({_contract_sql()})
SELECT *, variant = 'all levels' OR (SELECT count(DISTINCT segment) FROM sp WHERE split = 'train') = 0 AS as_kept FROM c""")
def q_contract_from_pipeline(spark, sf_dir):
    """The input contract read out of two fitted pipelines, one fitted without the customers of the first segment: its
    contract does not know that level, and differs from the one kept with the artefact."""
    tr, _ = _split(spark, sf_dir)
    less = tr.where(F.col("segment") > F.lit(tr.agg(F.min("segment")).first()[0]))
    kept, out = None, None
    for variant, rows in (("all levels", tr), ("a level less", less)):
        contract = CO.contract_from_model(MD.fit_pipeline(rows, "prior", ZERO, NUMS, CATS, label=LABEL), LIMITS)
        kept = kept or CO.version(contract)
        d = CO.as_frame(spark, CO.from_json(CO.to_json(contract))).withColumn("allowed", F.array_join("allowed", ","))
        d = d.select(F.lit(variant).alias("variant"), "*", F.lit(CO.version(contract) == kept).alias("as_kept"))
        out = d if out is None else out.unionByName(d)
    return out


@query("unawareness_audit", ops=("Q7", "Q8", "G1"))
def q_unawareness_audit(spark, sf_dir):
    """Drop the sensitive attribute (region), refit, re-audit recall disparity across regions, and put both models before
    the same promotion gate."""
    tr, va = _split(spark, sf_dir)
    out = []
    for name, ex in (("aware", []), ("unaware", ["region"])):
        m = MD.fit_pipeline(tr, "lr", ZERO, NUMS, CATS, label=LABEL, exclude=ex)
        s = MD.score(m, va).withColumn("y", F.col(LABEL))
        d = FA.disparity(FA.group_rates(s, ["region"], 0.29, score="probability"))
        gated = SE.gate(MD.validation_metrics(m, va, LABEL)).select("ap", "brier", "approved", "reason")
        out.append(with_row(d.withColumn("variant", F.lit(name)), gated))
    return out[0].unionByName(out[1])


_SENSITIVE = ("region", "segment", "balance_sign")


@query("sensitive_attributes_kept", ops=("Q8",), sql=SPLIT_SQL + " UNION ALL ".join(
    f"SELECT '{a}' AS attribute, count(DISTINCT {a}) AS n_outputs, true AS kept FROM sp WHERE split = 'train'" for a in _SENSITIVE))
def q_sensitive_attributes_kept(spark, sf_dir):
    """Every sensitive attribute is among the model's inputs, with one output for each of its levels: without it the
    audit by that attribute could not be answered for."""
    tr, _ = _split(spark, sf_dir)
    names = MD.fit_pipeline(tr, "prior", ZERO, NUMS, CATS, label=LABEL).stages[-3].feature_names()
    rows = [(a, sum(n.startswith(f"{a}=") for n in names)) for a in _SENSITIVE]
    return spark.createDataFrame([(a, n, n > 0) for a, n in rows], "attribute string, n_outputs long, kept boolean")


@query("effect_decomposition", ops=("V16",))
def q_effect_decomposition(spark, sf_dir):
    """What a network without hidden layers loses against LR: the part of the smaller data budget (LR on the stratified
    85 %) and the part of the optimiser (the network on the same 85 %), which add up to the whole."""
    tr, va = _split(spark, sf_dir)
    budget = holdout_split(tr, 0.15, LABEL).where("part = 'fit'").drop("part")
    lr = MD.fit_pipeline(tr, "lr", ZERO, NUMS, CATS, label=LABEL)
    d = len(lr.stages[-3].feature_names())
    models = (lr, MD.fit_pipeline(budget, "lr", ZERO, NUMS, CATS, label=LABEL),
              MD.fit_pipeline(budget, "mlp", ZERO, NUMS, CATS, label=LABEL, layers=[d, 2]))
    full, small, net = (MD.validation_metrics(m, va, LABEL).first()["ap"] for m in models)
    rows = [("data budget", full - small), ("optimiser", small - net), ("total", full - net)]
    return spark.createDataFrame(rows, "effect string, delta double").withColumn("delta", r6("delta"))


@query("l1_selection", ops=("F15", "F16"))
def q_l1_selection(spark, sf_dir):
    """L1 logistic regression as selector (|β| > 1e-5 kept); an original column is dead only if all
    its encoded slots are zero."""
    tr, _ = _split(spark, sf_dir)
    coefs = MD.l1_selection(tr, ZERO, NUMS, CATS, label=LABEL, C=0.05)
    dead = MD.dead_columns([(n, b) for n, b, _ in coefs])
    return spark.createDataFrame(dead, "original string, max_abs_coef double, dead boolean") \
                .withColumn("max_abs_coef", r6("max_abs_coef"))


@query("rfe_selection", ops=("F14",))
def q_rfe_selection(spark, sf_dir):
    """Recursive feature elimination of encoded features down to 8 (one distributed LR fit per round)."""
    tr, _ = _split(spark, sf_dir)
    keep = MD.rfe(tr, ZERO, NUMS, CATS, k=8, label=LABEL)
    return spark.createDataFrame([(i, f) for i, f in enumerate(keep)], "position int, feature string")


@query("categorical_mask", ops=("F9", "F10", "F8"))
def q_categorical_mask(spark, sf_dir):
    """Output feature names in assembled order with a flag for those of categorical columns, for both encodings."""
    tr, _ = _split(spark, sf_dir)
    from ..operators.prep import Preprocessor, output_is_categorical
    rows = []
    for enc in ("onehot", "ordinal"):
        m = Preprocessor(zeroCols=ZERO, numCols=NUMS, catCols=CATS, encoding=enc).fit(tr)
        rows += [(enc, i, n, c) for i, (n, c) in enumerate(zip(m.feature_names(), output_is_categorical(m.fitted, enc), strict=True))]
    return spark.createDataFrame(rows, "encoding string, idx int, feature string, categorical boolean")


@query("encoding_effect", ops=("V3",))
def q_encoding_effect(spark, sf_dir):
    """LR and an unpruned tree, one-hot against ordinal encoding, on identical 5 × 3 folds: Δ mean and Δ in std units."""
    folds = repeated_folds(_split(spark, sf_dir)[0], k=5, reps=REPS, label=LABEL)
    models = [("lr", _LR), ("tree", {"kind": "tree"})]
    names = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(models)], "candidate long, model string")
    both = [SR.table(SR.run(_encoded(spark, sf_dir, encoding=e, folds=folds), [c for _, c in models], spark)).select(
        "candidate", F.col("mean").alias(e), F.col("std").alias(f"{e}_std"), "k") for e in ("onehot", "ordinal")]
    j = both[0].join(both[1].drop("k"), "candidate").join(names, "candidate")
    return SR.rounded(j.select("model", "onehot", "ordinal", (F.col("onehot") - F.col("ordinal")).alias("delta"),
                               F.try_divide(F.col("onehot") - F.col("ordinal"), F.col("onehot_std")).alias("delta_in_std"), F.col("k").alias("folds")))


KS = (5, 10, 15)


@query("selector_leakage_audit", ops=("V13", "F13"))
def q_selector_leakage_audit(spark, sf_dir):
    """The best 5, 10 and 15 encoded slots by ANOVA F, chosen inside each of 5 folds and, wrongly, once on all of train:
    the AP of both and what the second wins by having seen the held-out labels."""
    tr, _ = _split(spark, sf_dir)
    folds = repeated_folds(tr, k=5, reps=1, label=LABEL)
    encoded = _encoded(spark, sf_dir, folds=folds)
    whole, names = _encoded_whole(tr)
    f = SR.TopFSelector(labelCol=LABEL).f_values(whole)
    outside = {k: [names[j] for j in sorted(range(len(f)), key=lambda j: (f[j] is None, -(f[j] or 0.0), j))[:k]] for k in KS}
    table = SR.table(SR.run(encoded, [_LR | {"select": k} for k in KS] + [_LR | {"only": outside[k]} for k in KS], spark))
    rows = {r["candidate"]: (r["mean"], r["k"]) for r in table.collect()}
    out = [(k, rows[i][0], rows[i + len(KS)][0], rows[i + len(KS)][0] - rows[i][0], rows[i][1]) for i, k in enumerate(KS)]
    return SR.rounded(spark.createDataFrame(out, "k int, inside double, outside double, inflation double, folds long"))


def _encoded_whole(rows):
    """Rows encoded by statistics of their own, and the names of the slots."""
    model = _encoder(rows)
    return model.transform(rows), model.stages[0].feature_names()


def _slots_sql() -> str:
    """(feature, value, label) of every encoded slot before scaling, which does not change F."""
    parts = [f"SELECT '{c}_z' AS feature, coalesce({c}, 0.0) AS value, y_signal AS label FROM tr" for c in ZERO]
    parts += [f"SELECT '{c}_z', coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM tr)), y_signal FROM tr" for c in NUMS]
    parts += [f"SELECT '{c}=' || v, CAST(coalesce({c}, (SELECT {c} FROM tr WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) = v AS DOUBLE), y_signal "
              f"FROM tr, (SELECT DISTINCT {c} AS v FROM tr WHERE {c} IS NOT NULL)" for c in CATS]
    return " UNION ALL ".join(parts)


@query("selector_topk", ops=("F13",), sql=SPLIT_SQL + f"""
, tr AS (SELECT * FROM sp WHERE split = 'train'), s AS ({_slots_sql()}),
  c AS (SELECT feature, label, count(*) AS n, avg(value) AS m, coalesce(var_samp(value), 0) AS v FROM s GROUP BY ALL),
  g AS (SELECT feature, sum(n) AS n, sum(n * m) / sum(n) AS m, count(*) AS k FROM c GROUP BY 1),
  f AS (SELECT feature, CASE WHEN sum((c.n - 1) * v) > 0 THEN (sum(c.n * pow(c.m - g.m, 2)) / (any_value(g.k) - 1)) / (sum((c.n - 1) * v) / (any_value(g.n) - any_value(g.k))) END AS f
        FROM c JOIN g USING (feature) GROUP BY 1)
SELECT feature, round(f, 4) AS f_stat, row_number() OVER (ORDER BY f DESC NULLS LAST) AS place FROM f QUALIFY place <= 15""")
def q_selector_topk(spark, sf_dir):
    """The selector stage in a pipeline behind the preprocessing of train: the 15 encoded slots with the largest F."""
    tr, _ = _split(spark, sf_dir)
    encoded, names = _encoded_whole(tr)
    selector = SR.TopFSelector(labelCol=LABEL, k=15)
    kept, f = selector.fit(encoded).getIndices(), selector.f_values(encoded)
    order = sorted(kept, key=lambda j: (f[j] is None, -(f[j] or 0.0), j))
    return spark.createDataFrame([(names[j], f[j], i + 1) for i, j in enumerate(order)], "feature string, f_stat double, place long").withColumn(
        "f_stat", F.round("f_stat", 4))


# ---- boosting settings, network shapes, seeds -------------------------------------------------------------

@query("boosting_settings", ops=("M-E",))
def q_boosting_settings(spark, sf_dir):
    """The three boosting settings fitted on 85 % of train; the tuned one is stopped by the average precision of its stages
    on the other 15 %. Rounds kept, best stage score and the metrics on validation."""
    tr, va = _split(spark, sf_dir)
    parts = holdout_split(tr, 0.15, LABEL)
    encoder = _encoder(parts.where("part = 'fit'"))
    vectors = lambda d: encoder.transform(d).select("features", F.col(LABEL).cast("double").alias("label"))
    fit, hold, val = vectors(parts.where("part = 'fit'")), vectors(parts.where("part <> 'fit'")), vectors(va)
    fit = fit.persist()
    with ThreadPoolExecutor(max_workers=len(EN.BOOSTING)) as pool:              # ordinary distributed fits, at the same time
        fitted = list(pool.map(lambda setting: EN.fit_boosting(setting, fit, hold), EN.BOOSTING))
    fit.unpersist()
    out = None
    for setting, got in zip(EN.BOOSTING, fitted, strict=True):
        scored = MD.score(got.model, val).withColumnRenamed("probability", "p")
        row = with_row(M.average_precision(scored, "p", "label"), M.point_metrics(scored, "p", "label", 0.5).select("brier"))
        row = row.select(F.lit(setting).alias("setting"), F.lit(len(got.scores)).alias("fitted"), F.lit(got.rounds).alias("kept"),
                         F.lit(got.scores[got.rounds - 1]).alias("holdout_ap"), "ap", "brier")
        out = row if out is None else out.unionByName(row)
    return out


# The widths of hidden layers that are compared, and the seeds.
SHAPES = [(), (8,), (16,), (32,), (16, 16)]
SEEDS = [42, 7, 123, 2024, 31337]


@query("mlp_shapes", ops=("M-F", "V7", "V6"))
def q_mlp_shapes(spark, sf_dir):
    """Five network shapes on the same 5 × 3 folds, from none to two hidden layers, and which one the 1-SE rule takes
    (fewest layers, then fewest units)."""
    table = SR.table(SR.run(_encoded(spark, sf_dir), [{"kind": "mlp", "hidden": list(h)} for h in SHAPES], spark))
    names = spark.createDataFrame([(i, str(list(h)), len(h), sum(h)) for i, h in enumerate(SHAPES)], "candidate long, hidden string, layers int, units int")
    table = table.join(names, "candidate")
    chosen = SR.one_se(table, [F.col("layers").asc(), F.col("units").asc()]).first()["candidate"]
    return SR.rounded(table.select("hidden", "mean", "std", "train_mean", "gap", F.col("k").alias("folds"), (F.col("candidate") == chosen).alias("chosen")))


@query("seed_variance", ops=("S7", "V14", "M-F"))
def q_seed_variance(spark, sf_dir):
    """One network from five seeds on the same 5 × 3 folds: what the seed moves the mean by against what the folds do."""
    results = SR.run(_encoded(spark, sf_dir), [{"kind": "mlp", "hidden": [16], "seed": s} for s in SEEDS], spark)
    per = SR.table(results)
    return SR.rounded(per.agg(F.count(F.lit(1)).alias("seeds"), F.avg("mean").alias("mean"), F.stddev_samp("mean").alias("seed_std"),
                              F.avg("std").alias("fold_std"), F.min("mean").alias("worst_seed"), F.max("mean").alias("best_seed")))


@query("model_variance", ops=("M-N", "S7", "S5"))
def q_model_variance(spark, sf_dir):
    """How far a validation customer's score moves when only the draw changes: a network from five seeds, LR from the same
    rows five times (convex: nothing moves), and LR on ten bootstrap resamples."""
    tr, va = _split(spark, sf_dir)
    encoder = _encoder(tr)
    fit, val = (encoder.transform(d).select("customer_id", "features", F.col(LABEL).cast("double").alias("label")) for d in (tr, va))
    fit = fit.persist()
    n, width = fit.count(), len(encoder.stages[0].feature_names())
    lr = lambda data, **kw: MD.classifier("lr", n, label="label", tol=1e-6, **kw).fit(data)
    fits = {
        "network, seeds": [lambda s=s: MD.classifier("mlp", n, label="label", seed=s, layers=[width, 16, 2]).fit(fit) for s in SEEDS],
        "lr, repeated": [lambda: lr(fit) for _ in SEEDS],
        "lr, resamples": [lambda b=b: lr(fit.withColumn("w", EN.bootstrap_weight("customer_id", b)).where("w > 0"), weight_col="w") for b in range(10)]}
    with ThreadPoolExecutor(max_workers=8) as pool:                             # ordinary distributed fits, at the same time
        waiting = {name: [pool.submit(f) for f in some] for name, some in fits.items()}
        families = {name: [w.result() for w in some] for name, some in waiting.items()}
    out = None
    for name, models in families.items():
        row = EN.spread(EN.score_all(models, val), 0.29).select(F.lit(name).alias("family"), F.lit(len(models)).alias("models"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def _encoder(rows):
    from pyspark.ml import Pipeline
    from ..operators.prep import Preprocessor, build_pipeline
    return Pipeline(stages=build_pipeline(Preprocessor(), ZERO, NUMS, CATS).getStages()[:2]).fit(rows)
