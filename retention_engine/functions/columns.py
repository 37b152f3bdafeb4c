"""Column-expression helpers (all JVM-side built-ins, so they stay inside whole-stage codegen)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that decide results (must stay as written).
DECIMALS = 6                      # every reported double is rounded to 6 places
PSI_STABLE = 0.10                 # PSI below this: stable
PSI_ACT = 0.25                    # PSI at or above this: act
PSI_EPSILON = 1e-6                # proportions are clipped to this before the log
COST_FN = 194.0                   # cost of a missed churner
COST_FP = 62.0                    # cost of a wasted contact
GATE_MIN_AP = 0.66                # promotion gate: average precision floor
GATE_MAX_BRIER = 0.14             # promotion gate: Brier ceiling
FAIRNESS_MAX_DISPARITY = 0.10     # recall max-min across groups
FAIRNESS_MIN_POSITIVES = 30       # a group estimate is reliable from this many positives
OPERATIONAL_KS = (0.10, 0.20)     # capacity shares for recall@k
TENURE_EDGES = (6, 12, 24, 48)    # right-closed tenure bins, open top
TENURE_LABELS = ("0-6m", "7-12m", "13-24m", "25-48m", "49m+")
EDA_TENURE_EDGES = (-1, 6, 12, 24, 48, 72)
QUANTILE_LEVELS = (0.01, 0.05, 0.25, 0.50, 0.75, 0.95, 0.99)
MAX_BATCH = 5000


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c) -> Column:
    """Round a double to the reporting precision."""
    return F.round(col(c).cast("double"), DECIMALS)


def hash_uniform(key, salt: str) -> Column:
    """Portable uniform in [0,1): first 8 hex digits of md5(key|salt) / 2^32.

    The same text hashes identically in any engine with md5, so splits and samples are reproducible
    across engines (xxhash64 would not be).
    """
    h = F.md5(F.concat(col(key).cast("string"), F.lit("|"), F.lit(salt)))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def safe_div(a, b) -> Column:
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def digitize(value, edges: Column) -> Column:
    """Bin index = number of edges <= value (open ends; len(edges)+1 bins)."""
    return F.size(F.filter(edges, lambda e: e <= col(value)))


def psi_term(expected, actual) -> Column:
    e = F.greatest(col(expected), F.lit(PSI_EPSILON))
    a = F.greatest(col(actual), F.lit(PSI_EPSILON))
    return (a - e) * F.log(a / e)


def psi_class(psi) -> Column:
    p = col(psi)
    return (F.when(p.isNull(), F.lit("no-data"))
             .when(p < PSI_STABLE, F.lit("stable"))
             .when(p < PSI_ACT, F.lit("investigate"))
             .otherwise(F.lit("act")))


def tenure_bin(c) -> Column:
    """Right-closed bins (-inf,6], (6,12], (12,24], (24,48], (48,inf); null stays null."""
    x = col(c)
    e, lab = TENURE_EDGES, TENURE_LABELS
    return (F.when(x.isNull(), F.lit(None).cast("string"))
             .when(x <= e[0], lab[0]).when(x <= e[1], lab[1]).when(x <= e[2], lab[2])
             .when(x <= e[3], lab[3]).otherwise(lab[4]))


def eda_tenure_bin(c) -> Column:
    """Bounded variant: (-1,6],(6,12],(12,24],(24,48],(48,72]; outside -> null."""
    x = col(c)
    e = EDA_TENURE_EDGES
    out = F.lit(None).cast("string")
    expr = None
    for lo, hi in zip(e[:-1], e[1:]):
        cond = (x > lo) & (x <= hi)
        label = F.lit(f"({lo}, {hi}]")
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(out)


def identifier(c) -> Column:
    """Non-alphanumeric runs -> '_', trim '_' at both ends, lower case."""
    return F.lower(F.expr(f"trim(BOTH '_' FROM regexp_replace({c}, '[^0-9a-zA-Z]+', '_'))")) \
        if isinstance(c, str) else F.lower(F.btrim(F.regexp_replace(c, "[^0-9a-zA-Z]+", "_"), F.lit("_")))


def is_finite(c) -> Column:
    x = col(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def hash_key(key, salt: str) -> Column:
    """60-bit portable hash (first 15 hex digits of md5(key|salt)) as a long: a reproducible random order."""
    h = F.md5(F.concat(col(key).cast("string"), F.lit("|"), F.lit(salt)))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")
