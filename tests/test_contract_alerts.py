import json

import pytest
from pyspark.sql import functions as F

from retention_engine.operators import alerts as AL
from retention_engine.operators import contract as CO
from retention_engine.operators import models as MD
from retention_engine.operators import quality as QU
from retention_engine.session import scratch_path
from retention_engine.streaming import service as ST

LIMITS = {"total": (0.0, 1e4), "months": (0.0, 120.0)}


def customers(spark, n=200, drop=None):
    rows = [(i, None if i % 11 == 0 else float(i % 50), float(i % 7), "abc"[i % 3], "xy"[i % 2], int((i * 7) % 5 < 2)) for i in range(n)]
    return spark.createDataFrame([r for r in rows if r[3] != drop], "customer_id long, total double, months double, plan string, area string, y int")


def fitted(spark, drop=None):
    return MD.fit_pipeline(customers(spark, drop=drop), "prior", ["total"], ["months"], ["plan", "area"])


def test_contract_comes_from_the_fitted_pipeline(spark):
    contract = CO.contract_from_model(fitted(spark), LIMITS)
    assert [f.name for f in contract.fields] == ["total", "months", "plan", "area"]
    assert [f.nullable for f in contract.fields] == [True, False, False, False]     # a blank means something in the zero group only
    assert contract.fields[2].allowed == ("a", "b", "c") and (contract.fields[1].lo, contract.fields[1].hi) == LIMITS["months"]
    assert CO.from_json(CO.to_json(contract)) == contract
    less = CO.contract_from_model(fitted(spark, drop="c"), LIMITS)
    assert less.fields[2].allowed == ("a", "b") and CO.version(less) != CO.version(contract)
    row = spark.createDataFrame([(1, None, 3.0, "c", "x"), (2, 5.0, None, "a", "z"), (3, -1.0, 121.0, "b", "y")],
                                "customer_id long, total double, months double, plan string, area string")
    errors = {r["customer_id"]: sorted((e["type"], e["field"]) for e in r["errors"]) for r in QU.validate(row, less).collect()}
    assert errors == {1: [("unknown_category", "plan")], 2: [("missing", "months"), ("unknown_category", "area")],
                      3: [("out_of_range", "months"), ("out_of_range", "total")]}
    assert QU.validate(row, contract).where("customer_id = 1").first()["valid"]


def test_undeclared_limits_and_forbidden_fields_are_errors(spark):
    with pytest.raises(ValueError, match="months"):
        CO.contract_from_model(fitted(spark), {"total": (0, 1)})
    with pytest.raises(ValueError, match="area"):
        CO.contract_from_model(fitted(spark), LIMITS, forbidden=("area",))


def test_artefact_keeps_its_contract(spark):
    data = customers(spark)
    out = MD.promote(spark, data, data, "lr", ["total"], ["months"], ["plan", "area"], "y", 0.3, min_ap=0.0, max_brier=1.0, limits=LIMITS)
    model, meta, base = MD.load_artifact(spark, out["path"])
    assert CO.from_json(meta["contract"]) == CO.contract_from_model(model, LIMITS)
    spoiled = json.loads(meta["contract"])
    spoiled["fields"][2]["allowed"].remove("a")
    path = scratch_path(spark, "artifact-contract")
    MD.save_artifact(model, dict(meta, contract=json.dumps(spoiled, sort_keys=True)), base, path)
    with pytest.raises(MD.ArtifactError, match="contract"):
        MD.load_artifact(spark, path)


POLICIES = [("up", "s", "above", 10.0, 5.0, 2, "look"), ("down", "s", "below", 2.0, 4.0, 1, "call"), ("other", "t", "above", 1.0, 1.0, 3, "wait")]
VALUES = {("s", "a"): [1, 11, 12, 7, 11, 4, 11, None, 11, 11, 6, 5, 4.9, 1.9, 3, 4, 4.1],
          ("s", "b"): [10, 11, 10, 12, 13], ("t", "a"): [2, 2, 1, 2, 2, 2, 1, 0.5], ("u", "a"): [100] * 5}


def by_hand(values, direction, trigger, disarm, k):
    run, on, out = 0, False, []
    for v in values:
        beyond = v is not None and (v > trigger if direction == "above" else v < trigger)
        back = v is not None and (v < disarm if direction == "above" else v > disarm)
        run = run + 1 if beyond else 0
        on = True if run >= k else False if back else on
        out.append(on)
    return out


def metrics(spark):
    rows = [(s, e, i, float(v) if v is not None else None) for (s, e), vs in VALUES.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "signal string, entity string, i int, value double").withColumn(
        "window_start", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("i") * 3600)).drop("i")


def test_policies_by_hand_and_as_a_stream(spark, tmp_path):
    pol, m = AL.policy_table(spark, POLICIES), metrics(spark)
    got = {}
    for r in AL.evaluate(m, pol).orderBy("window_start").collect():
        got.setdefault((r["policy"], r["entity"]), []).append(r["alert"])
    want = {(p, e): by_hand(vs, d, t, c, k) for p, s, d, t, c, k, _ in POLICIES for (sig, e), vs in VALUES.items() if sig == s}
    assert got == want and any(any(v) for v in got.values())
    for part in ("window_start < timestamp_seconds(1700000000 + 6 * 3600)", "window_start >= timestamp_seconds(1700000000 + 6 * 3600)"):
        m.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "m"))
    stream = spark.readStream.schema(m.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "m"))
    out = ST.run_available_now(AL.evaluate_stream(stream, pol), "t_policies")
    assert sorted(map(str, out.collect())) == sorted(map(str, AL.evaluate(m, pol).select(*out.columns).collect()))


def test_episodes(spark):
    pol, m = AL.policy_table(spark, POLICIES), metrics(spark)
    rows = AL.episodes(AL.evaluate(m, pol).where("entity = 'a'")).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("opened", "closed")}).select("policy", F.unix_timestamp("opened").alias("o"), F.unix_timestamp("closed").alias("c"),
                                                                             "n_windows", "lowest", "highest", "action").collect()
    at = lambda t: None if t is None else (t - 1_700_000_000) // 3600
    assert sorted((r["policy"], at(r["o"]), at(r["c"]), r["n_windows"], r["lowest"], r["highest"], r["action"]) for r in rows) == [
        ("down", 0, 1, 1, 1.0, 1.0, "call"), ("down", 13, 16, 3, 1.9, 4.0, "call"), ("other", 5, 7, 2, 1.0, 2.0, "wait"),
        ("up", 2, 5, 3, 7.0, 12.0, "look"), ("up", 9, 12, 3, 5.0, 11.0, "look")]


def test_policy_table_refuses_nonsense(spark):
    with pytest.raises(ValueError, match="close"):
        AL.policy_table(spark, [("p", "s", "above", 1.0, 2.0, 1, "")])
    with pytest.raises(ValueError, match="different names"):
        AL.policy_table(spark, [POLICIES[0], POLICIES[0]])
    with pytest.raises(ValueError, match="direction"):
        AL.policy_table(spark, [("p", "s", "beside", 1.0, 2.0, 1, "")])
    assert AL.policy_table(spark).count() == 10
