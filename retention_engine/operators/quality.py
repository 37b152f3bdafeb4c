"""Input contract, row validation and quarantine (P9–P19, IO2).

Validation is one projection: an ``errors`` array of (type, field) structs built from column
expressions (never carrying the offending value), so it runs inside whole-stage codegen and needs
no shuffle; request atomicity is one grouped ``bool_and`` joined back by request id.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import MAX_BATCH, is_finite


@dataclass(frozen=True)
class FieldRule:
    name: str
    kind: str                      # "numeric" | "categorical"
    lo: float | None = None
    hi: float | None = None
    allowed: tuple[str, ...] = ()
    nullable: bool = False


@dataclass(frozen=True)
class TableContract:
    """Ordered features with their rules; roles keep forbidden columns (leakage, audit, target) out."""
    fields: tuple[FieldRule, ...]
    key: str = "customer_id"
    target: str = "y"
    forbidden: tuple[str, ...] = field(default_factory=tuple)

    @property
    def features(self) -> list[str]:
        return [f.name for f in self.fields]

    def check_roles(self) -> None:
        bad = (set(self.forbidden) | {self.target}) & set(self.features)
        if bad:
            raise ValueError(f"forbidden columns used as features: {sorted(bad)}")

    def missing_columns(self, df: DataFrame) -> list[str]:
        return [f for f in self.features if f not in df.columns]


def contract_from_levels(levels: DataFrame, numeric: dict[str, tuple[float, float, bool]],
                         categorical: Sequence[str], key: str = "customer_id") -> TableContract:
    """Contract whose category sets are the fitted vocabulary (``levels``: feature, level — bounded by
    the vocabulary, so collecting it is cheap)."""
    voc: dict[str, list[str]] = {c: [] for c in categorical}
    for r in levels.collect():
        voc.setdefault(r["feature"], []).append(r["level"])
    rules = [FieldRule(c, "categorical", allowed=tuple(sorted(voc.get(c, [])))) for c in categorical]
    rules += [FieldRule(n, "numeric", lo, hi, nullable=nb) for n, (lo, hi, nb) in numeric.items()]
    return TableContract(tuple(rules), key=key)


def _err(cond: Column, typ: str, name: str) -> Column:
    return F.when(cond, F.struct(F.lit(typ).alias("type"), F.lit(name).alias("field")))


def validation_errors(df: DataFrame, contract: TableContract) -> Column:
    """ARRAY<STRUCT<type, field>> of every rule a row breaks (empty when valid)."""
    errs = []
    for f in contract.fields:
        c = F.col(f.name)
        if f.kind == "categorical":
            errs.append(_err(c.isNull(), "missing", f.name) if not f.nullable else None)
            errs.append(_err(c.isNotNull() & ~c.isin(list(f.allowed)), "unknown_category", f.name))
        else:
            errs.append(_err(c.isNull(), "missing", f.name) if not f.nullable else None)
            errs.append(_err(c.isNotNull() & ~is_finite(f.name), "not_finite", f.name))
            rng = F.lit(False)
            if f.lo is not None:
                rng = rng | (c < f.lo)
            if f.hi is not None:
                rng = rng | (c > f.hi)
            errs.append(_err(c.isNotNull() & is_finite(f.name) & rng, "out_of_range", f.name))
    return F.filter(F.array(*[e for e in errs if e is not None]), lambda x: x.isNotNull())


def validate(df: DataFrame, contract: TableContract) -> DataFrame:
    return df.withColumn("errors", validation_errors(df, contract)).withColumn("valid", F.size("errors") == 0)


def validate_requests(validated: DataFrame, request_col: str = "request_id", max_batch: int = MAX_BATCH) -> DataFrame:
    """Request atomicity: one invalid row (or a batch outside 1..max_batch rows) rejects the request."""
    req = validated.groupBy(request_col).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("valid")).alias("n_invalid"),
        F.bool_and("valid").alias("_all"))
    return req.select(request_col, "n_rows", "n_invalid",
                      (F.col("_all") & (F.col("n_rows") >= 1) & (F.col("n_rows") <= max_batch)).alias("accepted"),
                      F.when(~F.col("_all") | (F.col("n_rows") > max_batch), F.lit(422)).otherwise(F.lit(200))
                      .alias("status_code"))


def split_accepted(validated: DataFrame, requests: DataFrame, request_col: str = "request_id"):
    """(accepted rows, quarantined rows) by request verdict (left semi / left anti on accepted ids)."""
    ok = requests.where("accepted").select(request_col)
    return (validated.join(ok, request_col, "left_semi"), validated.join(ok, request_col, "left_anti"))


def unknown_fields(json_col: Column, allowed: Sequence[str]) -> Column:
    """Keys of a JSON object that the contract does not know (``extra = forbid``)."""
    return F.array_sort(F.array_except(F.json_object_keys(json_col), F.array(*[F.lit(a) for a in allowed])))


def expectations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One pass: (expectation, violations) for each named boolean violation predicate."""
    row = df.agg(*[F.count_if(c).alias(n) for n, c in checks.items()])
    return row.unpivot([], list(checks), "expectation", "violations")


def non_finite_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, non_finite) over unpivoted numeric columns (NaN / ±inf; nulls counted apart)."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in features]).unpivot([], list(features), "feature", "v")
    return long.groupBy("feature").agg(
        F.count_if(F.col("v").isNotNull() & ~is_finite("v")).alias("non_finite"),
        F.count_if(F.col("v").isNull()).alias("nulls"))


def fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Order-insensitive content fingerprint: row count plus the sum of a per-row md5 prefix.

    Identical for any permutation or partitioning of the same rows; one aggregate, no shuffle of rows.
    """
    cols = list(cols or df.columns)
    txt = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in cols])
    h = F.conv(F.substring(F.md5(txt), 1, 8), 16, 10).cast("long")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h).alias("hash_sum"),
                  F.bit_xor(h).alias("hash_xor"))
