"""SQL text for the ranking/cost metrics over a source relation ``src(score, y, id, <by…>)``.

Written independently of the Spark operators (plain window functions over the whole relation), so it
serves as the oracle for them.
"""
from __future__ import annotations

from .sql import THRESHOLD_LIST


def _g(by):
    return ", ".join(by)


def _gc(by):  # group columns with trailing comma
    return (", ".join(by) + ", ") if by else ""


def _part(by):
    return f"PARTITION BY {_g(by)} " if by else ""


def _on(a, b, by):
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in by) if by else "TRUE"


def ap_sql(src: str, by=(), score="score", y="y") -> str:
    return f"""(SELECT {_gc(by)} round(sum(pos * cp / cn) / nullif(sum(pos), 0), 6) AS ap FROM (
      SELECT {_gc(by)} pos,
        sum(n) OVER ({_part(by)}ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cn,
        sum(pos) OVER ({_part(by)}ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cp
      FROM (SELECT {_gc(by)} CAST({score} AS DOUBLE) AS s, count(*) AS n, sum({y}) AS pos FROM {src}
            GROUP BY {_gc(by)} s) h) c {"GROUP BY " + _g(by) if by else ""})"""


def auc_sql(src: str, by=(), score="score", y="y") -> str:
    return f"""(SELECT {_gc(by)} round(sum(pos * (cneg - neg + 0.5 * neg)) / nullif(sum(pos) * sum(neg), 0), 6) AS roc_auc FROM (
      SELECT {_gc(by)} pos, neg,
        sum(neg) OVER ({_part(by)}ORDER BY s ASC ROWS UNBOUNDED PRECEDING) AS cneg
      FROM (SELECT {_gc(by)} CAST({score} AS DOUBLE) AS s, sum({y}) AS pos, count(*) - sum({y}) AS neg FROM {src}
            GROUP BY {_gc(by)} s) h) c {"GROUP BY " + _g(by) if by else ""})"""


def point_sql(src: str, by=(), threshold=0.5, score="score", y="y", cfn=194.0, cfp=62.0) -> str:
    t = f"{threshold}::DOUBLE"
    return f"""(SELECT {_gc(by)} n, round(brier, 6) AS brier, tp, fp, fn, tn,
        round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) AS precision,
        round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) AS recall,
        round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0), 6) AS f1,
        round(fn * {cfn}::DOUBLE + fp * {cfp}::DOUBLE, 6) AS error_cost,
        round(prev, 6) AS prevalence
      FROM (SELECT {_gc(by)} count(*) AS n, avg(pow({score} - {y}, 2)) AS brier,
              count(*) FILTER (WHERE {score} >= {t} AND {y} = 1) AS tp,
              count(*) FILTER (WHERE {score} >= {t} AND {y} = 0) AS fp,
              count(*) FILTER (WHERE {score} < {t} AND {y} = 1) AS fn,
              count(*) FILTER (WHERE {score} < {t} AND {y} = 0) AS tn,
              avg(CAST({y} AS DOUBLE)) AS prev
            FROM {src} {"GROUP BY " + _g(by) if by else ""}) a)"""


def recall_k_sql(src: str, by=(), ks=(0.1, 0.2), score="score", y="y", idc="customer_id") -> str:
    kl = "[" + ", ".join(f"{k}::DOUBLE" for k in ks) + "]"
    return f"""(SELECT {_gc(by)} k, recall_at_k, round(recall_at_k / k, 6) AS lift_at_k,
        round(recall_at_k / least(k / (p / n), 1.0), 6) AS pct_ceiling FROM (
      SELECT {_gc(by)} k, max(n) AS n, max(p) AS p,
             round(coalesce(sum(y) FILTER (WHERE rn <= ceil(round(k * n, 9))), 0) / nullif(max(p), 0), 6) AS recall_at_k
      FROM (SELECT {_gc(by)} {y} AS y,
              row_number() OVER ({_part(by)}ORDER BY CAST({score} AS DOUBLE) DESC, {idc}) AS rn,
              count(*) OVER ({_part(by)}) AS n, sum({y}) OVER ({_part(by)}) AS p
            FROM {src}) r, (SELECT unnest({kl}) AS k) kk
      GROUP BY {_gc(by)} k) q)"""


def cost_curve_sql(src: str, by=(), score="score", y="y", cfn=194.0, cfp=62.0) -> str:
    return f"""(SELECT {_gc(by)} t AS threshold, fn, fp, round(fn * {cfn}::DOUBLE + fp * {cfp}::DOUBLE, 6) AS cost FROM (
      SELECT {_gc(by)} t,
        CAST(count(*) FILTER (WHERE {score} < t AND {y} = 1) AS BIGINT) AS fn,
        CAST(count(*) FILTER (WHERE {score} >= t AND {y} = 0) AS BIGINT) AS fp
      FROM {src}, (SELECT unnest({THRESHOLD_LIST}) AS t) th
      GROUP BY {_gc(by)} t) c)"""
