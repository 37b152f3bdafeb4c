"""Preprocessing estimators with the reference semantics, as Spark ML stages.

Spark ML's own stages differ in the details that decide results (``Imputer`` median is approximate,
``StandardScaler`` uses the sample std, ``Bucketizer`` is left-closed), so the fitted statistics are
computed here with exact aggregates and the transform is pure column expressions (whole-stage
codegen, no UDF). Fitted state is a small JSON document (one entry per feature), persisted with the
stage through ``DefaultParamsWritable``.
"""
from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import TENURE_EDGES, tenure_bin
from .drift import long_categorical, long_numeric
from .quantiles import exact_quantiles

ENCODINGS = ("onehot", "ordinal")


def fit_stats(train: DataFrame, zero_cols: Sequence[str], num_cols: Sequence[str],
              cat_cols: Sequence[str]) -> dict:
    """Exact fitted statistics: fill value (0 or interpolated median), mean and population std of the
    imputed column (std 0 → 1), category vocabulary (sorted) and mode (most frequent, lowest on ties)."""
    stats: dict = {"numeric": {}, "categorical": {}}
    nums = list(zero_cols) + list(num_cols)
    med = {}
    if num_cols:
        q = exact_quantiles(long_numeric(train, num_cols), "value", [0.5], ["feature"])
        med = {r["feature"]: r["quantile"] for r in q.collect()}               # one row per feature
    fills = {c: 0.0 for c in zero_cols} | {c: med.get(c) for c in num_cols}
    if nums:
        imputed = train.select(*[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)),
                                            F.lit(fills[c])).alias(c) for c in nums])
        row = imputed.agg(*[F.avg(c).alias(f"m_{c}") for c in nums],
                          *[F.stddev_pop(c).alias(f"s_{c}") for c in nums]).first()
        for c in nums:
            sd = row[f"s_{c}"]
            stats["numeric"][c] = {"fill": fills[c], "mean": row[f"m_{c}"],
                                   "scale": sd if sd and sd > 0 else 1.0,
                                   "group": "zero" if c in zero_cols else "median"}
    if cat_cols:
        lv = long_categorical(train, cat_cols).where(F.col("level").isNotNull()) \
            .groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))
        rows = lv.collect()                                                   # vocabulary-sized
        for c in cat_cols:
            levels = sorted((r["level"], r["n"]) for r in rows if r["feature"] == c)
            mode = min(levels, key=lambda t: (-t[1], t[0]))[0] if levels else None
            stats["categorical"][c] = {"vocab": [lv_ for lv_, _ in levels], "mode": mode}
    return stats


def imputed(c: str, s: dict) -> Column:
    return F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(s["fill"]))


def scaled(c: str, s: dict) -> Column:
    return (imputed(c, s) - F.lit(s["mean"])) / F.lit(s["scale"])


def onehot_columns(c: str, s: dict) -> list[Column]:
    """One 0/1 column per known level (sorted); null → mode; unknown → all zeros."""
    v = F.coalesce(F.col(c), F.lit(s["mode"]))
    return [F.when(v == F.lit(level), 1.0).otherwise(0.0).alias(f"{c}={level}") for level in s["vocab"]]


def ordinal_column(c: str, s: dict) -> Column:
    """Index in the sorted vocabulary; unknown → −1 (null → mode first)."""
    v = F.coalesce(F.col(c), F.lit(s["mode"]))
    m = F.create_map(*[x for i, level in enumerate(s["vocab"]) for x in (F.lit(level), F.lit(float(i)))])
    return F.coalesce(F.element_at(m, v), F.lit(-1.0)).alias(f"{c}_code")


def output_names(stats: dict, encoding: str) -> list[str]:
    """Feature names in output order: zero group, median group, then categoricals."""
    nums = sorted(stats["numeric"], key=lambda c: stats["numeric"][c]["group"] != "zero")
    names = [f"{c}_z" for c in nums]
    for c, s in stats["categorical"].items():
        names += [f"{c}={lv}" for lv in s["vocab"]] if encoding == "onehot" else [f"{c}_code"]
    return names


def output_is_categorical(stats: dict, encoding: str) -> list[bool]:
    """For each output name, whether it stands for a categorical column (one-hot slots and ordinal codes alike)."""
    n = len(stats["numeric"])
    return [i >= n for i in range(len(output_names(stats, encoding)))]


#: Marks the columns that a fitted preprocessor makes, so that the assembler takes those and no others.
MADE = "prep_output"


def _made(c: Column, name: str, levels: list[str] | None = None) -> Column:
    """An output column; an ordinal code carries its levels as a nominal attribute, which trees read."""
    attr = {"ml_attr": {"name": name, "type": "nominal", "vals": levels}} if levels else {}
    return c.alias(name, metadata={MADE: True, **attr})


class _PrepParams(Params):
    zeroCols = Param(Params._dummy(), "zeroCols", "numeric columns whose blank means 0", TypeConverters.toListString)
    numCols = Param(Params._dummy(), "numCols", "numeric columns imputed by the median", TypeConverters.toListString)
    catCols = Param(Params._dummy(), "catCols", "categorical columns", TypeConverters.toListString)
    encoding = Param(Params._dummy(), "encoding", "onehot | ordinal", TypeConverters.toString)
    exclude = Param(Params._dummy(), "exclude", "original columns dropped before encoding", TypeConverters.toListString)


class Preprocessor(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Imputation (constant 0 / median / mode), population standardisation, one-hot or ordinal encoding."""

    @keyword_only
    def __init__(self, zeroCols=None, numCols=None, catCols=None, encoding="onehot", exclude=None):
        super().__init__()
        self._setDefault(zeroCols=[], numCols=[], catCols=[], encoding="onehot", exclude=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        if self.getOrDefault("encoding") not in ENCODINGS:
            raise ValueError(f"unknown encoding {self.getOrDefault('encoding')!r}; use one of {ENCODINGS}")

    def _fit(self, df: DataFrame) -> "PreprocessorModel":
        ex = set(self.getOrDefault("exclude"))
        keep = lambda cols: [c for c in cols if c not in ex]
        stats = fit_stats(df, keep(self.getOrDefault("zeroCols")), keep(self.getOrDefault("numCols")),
                          keep(self.getOrDefault("catCols")))
        m = PreprocessorModel(stats=json.dumps(stats), encoding=self.getOrDefault("encoding"))
        return m


class PreprocessorModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    stats = Param(Params._dummy(), "stats", "fitted statistics (JSON)", TypeConverters.toString)
    encoding = Param(Params._dummy(), "encoding", "onehot | ordinal", TypeConverters.toString)

    @keyword_only
    def __init__(self, stats=None, encoding="onehot"):
        super().__init__()
        self._setDefault(stats="{}", encoding="onehot")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def fitted(self) -> dict:
        return json.loads(self.getOrDefault("stats"))

    def feature_names(self) -> list[str]:
        return output_names(self.fitted, self.getOrDefault("encoding"))

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self.fitted
        enc = self.getOrDefault("encoding")
        nums = sorted(st["numeric"], key=lambda c: st["numeric"][c]["group"] != "zero")
        cols = [scaled(c, st["numeric"][c]) for c in nums]
        levels: list[list[str] | None] = [None] * len(nums)
        for c, s in st["categorical"].items():
            new = onehot_columns(c, s) if enc == "onehot" else [ordinal_column(c, s)]
            cols += new
            levels += [None] * len(new) if enc == "onehot" else [s["vocab"]]
        names = self.feature_names()
        clash = set(names) & set(df.columns)
        if clash:
            raise ValueError(f"input columns have the names of encoded features: {sorted(clash)}")
        return df.select("*", *[_made(c, n, v) for c, n, v in zip(cols, names, levels, strict=True)])


def build_pipeline(classifier, zero_cols, num_cols, cat_cols, encoding="onehot", exclude=(),
                   derived: Sequence[str] = ()) -> Pipeline:
    """derived features → preprocessing → assembler → classifier, persisted as one PipelineModel."""
    from pyspark.ml.feature import SQLTransformer
    stages = []
    if derived:
        stmt = "SELECT *, " + ", ".join(DERIVED[d] + f" AS {d}" for d in derived) + " FROM __THIS__"
        stages.append(SQLTransformer(statement=stmt))
    prep = Preprocessor(zeroCols=list(zero_cols), numCols=list(num_cols) + [d for d in derived if d in DERIVED_NUM],
                        catCols=list(cat_cols) + [d for d in derived if d not in DERIVED_NUM],
                        encoding=encoding, exclude=list(exclude))
    stages.append(prep)
    stages.append(_AssemblerFromPrep())
    stages.append(classifier)
    return Pipeline(stages=stages)


class _AssemblerFromPrep(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Assemble the columns that the preceding Preprocessor made, in its order, and no others."""

    inputCols = Param(Params._dummy(), "inputCols", "assembled columns (set at fit)", TypeConverters.toListString)

    def _fit(self, df: DataFrame):
        prep_cols = [f.name for f in df.schema.fields if (f.metadata or {}).get(MADE)]
        return VectorAssembler(inputCols=prep_cols, outputCol="features", handleInvalid="keep")


# Derived features (enabled by name) — SQL expressions over the snapshot columns.
DERIVED = {
    "tenure_band": ("CASE WHEN tenure_days IS NULL THEN NULL WHEN tenure_days / 30.0 <= 6 THEN '0-6m' "
                    "WHEN tenure_days / 30.0 <= 12 THEN '7-12m' WHEN tenure_days / 30.0 <= 24 THEN '13-24m' "
                    "WHEN tenure_days / 30.0 <= 48 THEN '25-48m' ELSE '49m+' END"),
    "n_flags": "(CAST(tenure_days > 365 AS INT) + CAST(recency_days < 90 AS INT) + CAST(value > 5000 AS INT))",
    "charge_per_flag": "try_divide(monthly_charges, (CAST(tenure_days > 365 AS INT) + CAST(recency_days < 90 AS INT) + CAST(value > 5000 AS INT)))",
    "urgent_flag": "CASE WHEN last_priority IN ('1-URGENT', '2-HIGH') THEN 'yes' ELSE 'no' END",
}
DERIVED_NUM = {"n_flags", "charge_per_flag"}


def tenure_months_band(df: DataFrame, days_col: str = "tenure_days") -> DataFrame:
    """Right-closed month bands (−∞,6],(6,12],(12,24],(24,48],(48,∞) of tenure (pure, null stays null)."""
    return df.withColumn("tenure_band", tenure_bin(F.col(days_col) / 30.0))


def anova_f(df: DataFrame, features: Sequence[str], label: str = "y") -> DataFrame:
    """One-way ANOVA F per feature between label classes from one grouped pass (n, Σx, Σx² per class)."""
    long = long_numeric(df, features, ids=[label]).where(F.col("value").isNotNull())
    g = long.groupBy("feature", label).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"),
                                           F.sum(F.col("value") * F.col("value")).alias("ss"))
    t = g.groupBy("feature").agg(F.sum("n").alias("N"), F.sum("s").alias("S"), F.sum("ss").alias("SS"),
                                 F.count(F.lit(1)).alias("k"),
                                 F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between_raw"))
    ssb = F.col("between_raw") - F.col("S") * F.col("S") / F.col("N")
    ssw = F.col("SS") - F.col("between_raw")
    f = (ssb / (F.col("k") - 1)) / (ssw / (F.col("N") - F.col("k")))
    return t.select("feature", F.round(f, 6).alias("f_stat"))
