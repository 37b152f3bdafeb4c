"""Input contract read out of a fitted pipeline (P10) and versioned with the artefact.

The pipeline that will score a row says which fields it reads, in which order, which levels it knows and which blanks
mean something (the zero-imputed group). Only the business limits of numeric fields are declared beside it: limits
taken from the training data would refuse a legitimate value just beyond them. A numeric field without a declared limit
is an error, so a new column never passes unchecked.
"""
from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import identifier
from .prep import PreprocessorModel
from .quality import FieldRule, TableContract


def fitted_preprocessor(model: PipelineModel) -> PreprocessorModel:
    stages = [s for s in model.stages if isinstance(s, PreprocessorModel)]
    if len(stages) != 1:
        raise ValueError(f"expected one fitted preprocessing stage, found {len(stages)}")
    return stages[0]


def contract_from_model(model: PipelineModel, limits: Mapping[str, tuple[float, float]], key: str = "customer_id",
                        target: str = "y", forbidden: tuple[str, ...] = ()) -> TableContract:
    """The contract of a fitted pipeline: numeric fields with their declared limits (blank allowed in the zero group only),
    then categorical fields with the levels the pipeline was fitted on."""
    fitted = fitted_preprocessor(model).fitted
    missing = sorted(set(fitted["numeric"]) - set(limits))
    if missing:
        raise ValueError(f"numeric fields without declared limits: {missing}")
    rules = [FieldRule(c, "numeric", float(limits[c][0]), float(limits[c][1]), nullable=s["group"] == "zero")
             for c, s in sorted(fitted["numeric"].items(), key=lambda t: t[1]["group"] != "zero")]
    rules += [FieldRule(c, "categorical", allowed=tuple(s["vocab"])) for c, s in fitted["categorical"].items()]
    contract = TableContract(tuple(rules), key=key, target=target, forbidden=tuple(forbidden))
    contract.check_roles()
    return contract


def to_json(contract: TableContract) -> str:
    """One text for one contract, so that equal contracts have equal versions."""
    fields = [{"name": f.name, "kind": f.kind, "lo": f.lo, "hi": f.hi, "allowed": list(f.allowed), "nullable": f.nullable} for f in contract.fields]
    return json.dumps({"fields": fields, "key": contract.key, "target": contract.target, "forbidden": list(contract.forbidden)}, sort_keys=True)


def from_json(text: str) -> TableContract:
    d = json.loads(text)
    return TableContract(tuple(FieldRule(f["name"], f["kind"], f["lo"], f["hi"], tuple(f["allowed"]), f["nullable"]) for f in d["fields"]),
                         key=d["key"], target=d["target"], forbidden=tuple(d["forbidden"]))


def version(contract: TableContract) -> str:
    return hashlib.sha256(to_json(contract).encode()).hexdigest()


def as_frame(spark: SparkSession, contract: TableContract) -> DataFrame:
    """(position, field, identifier, kind, lo, hi, allowed, nullable): the contract as a table, one row a field."""
    rows = [(i, f.name, f.kind, f.lo, f.hi, list(f.allowed), f.nullable) for i, f in enumerate(contract.fields)]
    out = spark.createDataFrame(rows, "position int, field string, kind string, lo double, hi double, allowed array<string>, nullable boolean")
    return out.select("position", "field", identifier(F.col("field")).alias("identifier"), "kind", "lo", "hi", "allowed", "nullable")
