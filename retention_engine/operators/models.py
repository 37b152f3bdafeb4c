"""Model catalogue, scoring, importance and the artefact life cycle (M-A…M-N, V4, V5, V11, G3–G7, IO6–IO9).

Models are Spark ML estimators inside one ``Pipeline`` with the preprocessing stages, so the persisted
``PipelineModel`` is the single object that scores. Fits are distributed (treeAggregate rounds);
several candidate fits run concurrently from a thread pool on the driver (``parallelism``), each a
normal distributed job.
"""
from __future__ import annotations

import hashlib
import json
import os
import re
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import pyspark
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import r6
from ..session import scratch_path
from . import contract as CO
from .drift import category_baseline, numeric_baseline, score_baseline
from .metrics import average_precision, point_metrics
from .prep import build_pipeline
from .ranking import running_totals, with_row


class PriorClassifier(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Constant score = training prevalence (the floor a model must beat)."""
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)

    def __init__(self, labelCol: str = "y"):
        super().__init__()
        self._set(labelCol=labelCol)

    def _fit(self, df):
        prev = df.agg(F.avg(F.col(self.getOrDefault("labelCol")).cast("double"))).first()[0]
        return PriorModel(prior=float(prev))


class PriorModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    prior = Param(Params._dummy(), "prior", "constant probability", TypeConverters.toFloat)

    def __init__(self, prior: float = 0.0):
        super().__init__()
        self._set(prior=prior)

    def _transform(self, df):
        from pyspark.ml.functions import array_to_vector
        p = float(self.getOrDefault("prior"))
        return df.withColumn("probability", array_to_vector(F.array(F.lit(1 - p), F.lit(p))))


def classifier(kind: str, n_train: int, label: str = "y", weight_col: str | None = None, seed: int = 42, **kw):
    """Catalogue entry. LR's inverse-regularisation C maps to ``regParam = 1/(C·n)`` with raw features. Deep trees keep each
    row's nodes beside it, so a level neither sends the trees grown so far to every task nor walks them from their roots."""
    if kind == "prior":
        return PriorClassifier(labelCol=label)
    if kind == "lr":
        c, l1 = kw.get("C", 1.0), kw.get("l1_ratio", 0.0)
        lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / (c * n_train),
                                elasticNetParam=l1, standardization=False, maxIter=kw.get("maxIter", 1000), tol=kw.get("tol", 1e-8))
        return lr.setWeightCol(weight_col) if weight_col else lr
    if kind == "tree":
        return DecisionTreeClassifier(featuresCol="features", labelCol=label, maxDepth=kw.get("maxDepth", 30),
                                      minInstancesPerNode=kw.get("minInstancesPerNode", 1), seed=seed, cacheNodeIds=True)
    if kind == "rf":
        return RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=kw.get("numTrees", 300),
                                      minInstancesPerNode=kw.get("minInstancesPerNode", 5),
                                      featureSubsetStrategy="sqrt", maxDepth=kw.get("maxDepth", 30),
                                      maxBins=kw.get("maxBins", 64), seed=seed, cacheNodeIds=True)
    if kind == "gbt":
        return GBTClassifier(featuresCol="features", labelCol=label, maxIter=kw.get("maxIter", 100),
                             stepSize=kw.get("stepSize", 0.1), maxDepth=kw.get("maxDepth", 3),
                             minInstancesPerNode=kw.get("minInstancesPerNode", 20), seed=seed)
    if kind == "mlp":
        return MultilayerPerceptronClassifier(featuresCol="features", labelCol=label, layers=kw["layers"],
                                              solver="l-bfgs", maxIter=kw.get("maxIter", 200), seed=seed)
    raise ValueError(f"unknown model kind {kind!r}")


def balanced_weights(df: DataFrame, label: str = "y") -> DataFrame:
    """class_weight='balanced': w = n / (classes · n_class), from one aggregate, attached as literals."""
    c = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}      # one row per class
    w = F.coalesce(*[F.when(F.col(label).eqNullSafe(F.lit(k)), F.lit(sum(c.values()) / (len(c) * v))) for k, v in c.items()])
    return df.withColumn("weight", w)


def score(model: PipelineModel, df: DataFrame, threshold: float | None = None, version: str | None = None) -> DataFrame:
    """P(y=1) for every row in one distributed pass (batch scoring); optional decision/threshold/version."""
    out = model.transform(df).withColumn("probability", vector_to_array("probability")[1])
    keep = [c for c in df.columns] + ["probability"]
    out = out.select(*keep)
    if threshold is not None:
        out = out.withColumn("decision", F.col("probability") >= F.lit(threshold)).withColumn("threshold", F.lit(threshold))
    if version is not None:
        out = out.withColumn("model_version", F.lit(version))
    return out


def fit_pipeline(train: DataFrame, kind: str, zero, nums, cats, label: str = "y", encoding: str = "onehot",
                 exclude=(), **kw) -> PipelineModel:
    n = train.count()
    return build_pipeline(classifier(kind, n, label=label, **kw), zero, nums, cats, encoding, exclude).fit(train)


def validation_metrics(model: PipelineModel, val: DataFrame, label: str = "y", threshold: float = 0.5) -> DataFrame:
    s = score(model, val).withColumn("_y", F.col(label))
    ap = average_precision(s, "probability", "_y")
    pm = point_metrics(s, "probability", "_y", threshold).select("n", "brier")
    return with_row(ap, pm)


def odds_ratios(model: PipelineModel) -> list[tuple[str, float, float]]:
    """(feature, β, exp β) per encoded feature of a fitted LR pipeline."""
    prep = model.stages[-3]
    lr = model.stages[-1]
    names = prep.feature_names()
    coef = lr.coefficients.toArray()
    import math
    return [(n, float(b), math.exp(float(b))) for n, b in zip(names, coef)]


def impurity_importance(model: PipelineModel) -> list[tuple[str, float]]:
    prep = model.stages[-3]
    imp = model.stages[-1].featureImportances.toArray()
    return sorted(zip(prep.feature_names(), map(float, imp)), key=lambda t: -t[1])


def permutation_importance(model: PipelineModel, val: DataFrame, features: Sequence[str], label: str = "y",
                           id_col: str = "customer_id", repeats: int = 10, seed: str = "perm") -> DataFrame:
    """AP drop when one original column is shuffled across rows (mean ± std over repeats).

    All (feature, repeat) variants are rows of one frame, ranked, joined and scored in one pass whatever the number of
    columns; AP is one grouped aggregate. A shuffle pairs the k-th row in id order with the k-th row in a seeded hash order —
    exact global ranks from :func:`ranking.running_totals`, so no row set collects in one task. Both sides of the pairing
    have every row features × repeats times, so it is a merge join: neither is ever sent whole through the driver.
    """
    base = score(model, val).withColumn("_y", F.col(label))
    base_ap = average_precision(base, "probability", "_y").withColumnRenamed("ap", "base_ap")
    ranked_id = running_totals(val.withColumn("_k", F.col(id_col)), "_k").withColumnRenamed("_rn", "_pos").drop("_k")
    drawn = lambda d: d.withColumn("feature", F.explode(F.array(*map(F.lit, features)))).withColumn(
        "rep", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.concat(F.lit(f"{seed}:"), "feature"),
                                             F.col("rep").cast("string"))), 1, 15), 16, 10).cast("long")
    own = F.struct(*[F.when(F.col("feature") == f, F.col(f)).alias(f) for f in features])       # the drawn column alone travels
    donors = running_totals(drawn(val.select(id_col, *features)).select(id_col, "feature", "rep", own.alias("_donor"), h.alias("_h")),
                            "_h", by=["feature", "rep"], tiebreak=[id_col]) \
        .select("feature", "rep", F.col("_rn").alias("_pos"), "_donor")
    variants = drawn(ranked_id).join(donors.hint("merge"), ["feature", "rep", "_pos"])
    variants = variants.withColumns({f: F.when(F.col("feature") == f, F.col(f"_donor.{f}")).otherwise(F.col(f)) for f in features}).drop("_donor", "_pos")
    s = score(model, variants)
    ap = average_precision(s.withColumn("_y", F.col(label)), "probability", "_y", by=["feature", "rep"])
    j = with_row(ap, base_ap)
    return j.groupBy("feature").agg(r6(F.avg(F.col("base_ap") - F.col("ap"))).alias("ap_drop_mean"),
                                    r6(F.stddev_pop(F.col("base_ap") - F.col("ap"))).alias("ap_drop_std"))


def cross_validate(folds: DataFrame, configs: Sequence[dict], zero, nums, cats, label: str = "y",
                   parallelism: int = 4) -> DataFrame:
    """Per (config, rep, fold) AP on the held-out fold; fits run concurrently (distributed each)."""
    spark = folds.sparkSession
    keys = [(i, rep, fold) for i in range(len(configs))
            for rep, fold in sorted({(r["rep"], r["fold"]) for r in folds.select("rep", "fold").distinct().collect()})]

    def run(key):
        i, rep, fold = key
        cfg = dict(configs[i])
        kind = cfg.pop("kind")
        part = folds.where(F.col("rep") == rep)
        tr, te = part.where(F.col("fold") != fold), part.where(F.col("fold") == fold)
        m = fit_pipeline(tr, kind, zero, nums, cats, label=label, **cfg)
        ap = average_precision(score(m, te).withColumn("_y", F.col(label)), "probability", "_y").first()["ap"]
        return (i, int(rep), int(fold), float(ap) if ap is not None else None)

    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        res = list(ex.map(run, keys))
    return spark.createDataFrame(res, "config long, rep int, fold int, score double")


# ---- artefact: model + metadata + frozen baselines, written and verified together -------------------

def save_artifact(model: PipelineModel, metadata: dict, baselines: dict[str, DataFrame], path: str, keep_version: bool = False) -> str:
    """Write model, metadata (versions, features, threshold, metrics, lineage) and baseline tables to
    one folder; returns a fingerprint of what the artefact says. ``keep_version`` leaves the metadata's own Spark version."""
    spark = next(iter(baselines.values())).sparkSession
    model.write().overwrite().save(os.path.join(path, "model"))
    version = metadata.get("spark_version") if keep_version else None
    meta = dict(metadata, spark_version=version or pyspark.__version__, format=1,
                saved_at=time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()))
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(os.path.join(path, "metadata"))
    for name, df in baselines.items():
        df.write.mode("overwrite").parquet(os.path.join(path, f"baseline_{name}"))
    return artifact_fingerprint(model, meta, baselines)


#: What differs between two savings of one artefact.
SAVING = ("saved_at",)


def artifact_fingerprint(model: PipelineModel, meta: dict, baselines: dict[str, DataFrame]) -> str:
    """sha256 over the fitted stages, the metadata and the rows of the baselines: one artefact saved twice has one
    fingerprint, whatever its files are called."""
    stages = []
    for st in model.stages:
        says = {p.name: v for p, v in st.extractParamMap().items()}
        for name in ("coefficients", "intercept", "toDebugString", "weights"):
            says[name] = getattr(st, name, None)
        says.pop("toDebugString") if says["toDebugString"] is None else says.update(
            toDebugString=re.sub(r"uid=[^,)]*", "", says["toDebugString"]))
        stages.append([type(st).__name__, {k: str(v) for k, v in sorted(says.items())}])
    parts = [json.dumps(stages, sort_keys=True), json.dumps({k: v for k, v in meta.items() if k not in SAVING}, sort_keys=True)]
    for name, df in sorted(baselines.items()):
        h = F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]))).cast("decimal(38,0)")
        parts.append(f"{name}:{df.agg(F.count('*'), F.sum(h)).first()}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def read_if_there(read):
    """What ``read()`` gives, or None where its path does not exist; every other error is raised."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


class ArtifactError(ValueError):
    pass


def load_artifact(spark, path: str, strict: bool = True):
    """Load with the four checks: format, library version, declared features = pipeline features (in
    order), baseline present with scores and covering exactly the numeric/categorical features."""
    text = read_if_there(lambda: spark.read.text(os.path.join(path, "metadata")))
    meta_rows = text.collect() if text is not None else []
    if not meta_rows:
        raise ArtifactError("metadata missing")
    meta = json.loads(meta_rows[0][0])
    if meta.get("format") != 1:
        raise ArtifactError("unknown artefact format")
    if strict and meta.get("spark_version") != pyspark.__version__:
        raise ArtifactError(f"saved with Spark {meta.get('spark_version')}, running {pyspark.__version__}")
    model = PipelineModel.load(os.path.join(path, "model"))
    prep = [s for s in model.stages if hasattr(s, "feature_names")][0]
    if meta.get("features") != prep.feature_names():
        raise ArtifactError("declared features differ from the pipeline's features")
    if "contract" in meta:
        kept = CO.from_json(meta["contract"])
        limits = {f.name: (f.lo, f.hi) for f in kept.fields if f.kind == "numeric"}
        if CO.contract_from_model(model, limits, kept.key, kept.target, kept.forbidden) != kept:
            raise ArtifactError("input contract differs from the pipeline's fields")
    base = {}
    for name in ("numeric", "categorical", "score"):
        base[name] = read_if_there(lambda name=name: spark.read.parquet(os.path.join(path, f"baseline_{name}")))
        if base[name] is None:
            raise ArtifactError(f"baseline_{name} missing")
    covered = {r["feature"] for r in base["numeric"].select("feature").union(base["categorical"].select("feature")).distinct().collect()}
    if covered != set(meta.get("raw_features", [])):
        raise ArtifactError("baseline does not cover exactly the raw features")
    if base["score"].count() == 0:
        raise ArtifactError("baseline has no score block")
    return model, meta, base


def promote(spark, train: DataFrame, val: DataFrame, kind: str, zero, nums, cats, label: str, threshold: float,
            path: str | None = None, min_ap: float = 0.66, max_brier: float = 0.14, lineage: dict | None = None, limits: dict | None = None, **kw):
    """Measure-then-promote the same object: fit → validation metrics → gate; only an approved model is
    written (with baselines) and re-loaded, then a round-trip check compares the two score sets. With ``limits`` of the
    numeric fields the input contract read out of the fitted pipeline is kept in the metadata."""
    model = fit_pipeline(train, kind, zero, nums, cats, label=label, **kw)
    m = validation_metrics(model, val, label, threshold).first()
    approved = (m["ap"] is not None and m["ap"] >= min_ap) and m["brier"] <= max_brier
    out = {"ap": m["ap"], "brier": m["brier"], "approved": bool(approved), "written": False,
           "round_trip_identical": None, "fingerprint": None}
    if not approved:
        return out
    path = path or scratch_path(spark, "artifact")
    prep = model.stages[-3]
    vs = score(model, val)
    meta = {"features": prep.feature_names(), "raw_features": list(zero) + list(nums) + list(cats),
            "threshold": threshold, "metrics": {"ap": m["ap"], "brier": m["brier"]}, "lineage": lineage or {}}
    if limits is not None:
        meta["contract"] = CO.to_json(CO.contract_from_model(model, limits, target=label))
    baselines = {"numeric": numeric_baseline(train, list(zero) + list(nums)),
                 "categorical": category_baseline(train, list(cats)),
                 "score": score_baseline(vs, "probability", threshold)}
    out["fingerprint"] = save_artifact(model, meta, baselines, path)
    out["written"] = True
    reloaded, _, _ = load_artifact(spark, path)
    a = vs.select("customer_id", F.col("probability").alias("p1"))
    b = score(reloaded, val).select("customer_id", F.col("probability").alias("p2"))
    diff = a.join(b, "customer_id", "full").agg(F.count_if(~F.col("p1").eqNullSafe(F.col("p2"))).alias("d")).first()["d"]
    out["round_trip_identical"] = diff == 0
    out["path"] = path
    return out


def l1_selection(train: DataFrame, zero, nums, cats, label: str = "y", C: float = 1.0, eps: float = 1e-5):
    """Embedded L1 selector: encoded features whose L1-LR coefficient magnitude exceeds ``eps``."""
    m = fit_pipeline(train, "lr", zero, nums, cats, label=label, C=C, l1_ratio=1.0)
    return [(n, b, abs(b) > eps) for n, b, _ in odds_ratios(m)]


def dead_columns(coefs: Sequence[tuple[str, float]], tol: float = 1e-8) -> list[tuple[str, float, bool]]:
    """An original column is dead only when ALL its encoded slots have |β| < tol."""
    groups: dict[str, float] = {}
    for name, b in coefs:
        orig = name.split("=")[0].removesuffix("_z").removesuffix("_code")
        groups[orig] = max(groups.get(orig, 0.0), abs(b))
    return [(g, v, v < tol) for g, v in sorted(groups.items())]


def rfe(train: DataFrame, zero, nums, cats, k: int, label: str = "y") -> list[str]:
    """Recursive feature elimination on encoded features: refit LR, drop the smallest |β|, until k remain.
    Each round is one distributed fit on an assembled vector of the surviving slots."""
    from pyspark.ml.feature import VectorAssembler
    prep = build_pipeline(classifier("lr", 1, label=label), zero, nums, cats).getStages()[0]
    pm = prep.fit(train)
    enc = pm.transform(train)
    keep = pm.feature_names()
    n = train.count()
    while len(keep) > k:
        va = VectorAssembler(inputCols=[f"`{c}`" if "=" in c else c for c in keep], outputCol="features",
                             handleInvalid="keep")
        try:
            data = va.transform(enc)
        except Exception:  # noqa: BLE001  (column names with '=' need no quoting in some versions)
            data = VectorAssembler(inputCols=keep, outputCol="features", handleInvalid="keep").transform(enc)
        lr = classifier("lr", n, label=label).fit(data)
        coef = lr.coefficients.toArray()
        drop = min(range(len(keep)), key=lambda i: (abs(coef[i]), keep[i]))
        keep = keep[:drop] + keep[drop + 1:]
    return keep
