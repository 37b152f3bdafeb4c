"""Characterisation against an independent implementation."""
from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import selection as SE
from .common import snapshot
from .registry import query
from .sql import ctes
from .sqlmetrics import auc_sql


@query("characterisation", ops=("G2", "M2"), sql=ctes("snapshot") + f"""
SELECT segment, 'roc_auc' AS metric, roc_auc AS v, roc_auc AS ref, true AS ok FROM {auc_sql('snapshot', ['segment'], y='y_signal')} a""")
def q_characterisation(spark, sf_dir):
    """Our histogram ROC-AUC per segment against Spark ML's exact evaluator (numBins=0), two-sided
    tolerance 1e-4 (the evaluator runs per segment; 5 segments)."""
    s = snapshot(spark, sf_dir)
    cur = M.roc_auc(s, label="y_signal", by=["segment"]).select("segment", F.lit("roc_auc").alias("metric"),
                                                                F.col("roc_auc").alias("value"))
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName="areaUnderROC", numBins=0)
    segs = [r["segment"] for r in s.select("segment").distinct().collect()]          # 5 segments
    d = s.select("segment", "score", F.col("y_signal").cast("double").alias("label"))
    ref = spark.createDataFrame([(g, "roc_auc", round(ev.evaluate(d.where(F.col("segment") == g)), 6)) for g in segs],
                                "segment string, metric string, value double")
    out = SE.characterise(cur, ref, ["segment"])
    return out.select("segment", "metric", "v", "ref", "ok")
