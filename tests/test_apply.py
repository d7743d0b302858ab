"""The closed forms against a loop over batches, on random logs."""

import random

import pytest
from pyspark.sql import types as T

from tidemark.operators import apply
from tidemark.streaming.replica import Replica

SCHEMA = "log int, seq long, batch_id long, op string, pk long, v double"


def logs(n):
    rng = random.Random(3)
    out = []
    for log in range(n):
        batch = 0
        for seq in range(rng.randint(1, 14)):
            batch += rng.random() < 0.3
            op = rng.choice("IIUUDDT" if rng.random() < 0.5 else "IUD")
            out.append((log, seq, batch, op, None if op == "T" else rng.randint(1, 3), float(seq)))
    return out


def loop(rows, batchwise):
    state = {}
    if not batchwise:
        for _, seq, _, op, pk, v in rows:
            state = {} if op == "T" else {k: x for k, x in state.items() if op != "D" or k != pk}
            if op in "IU":
                state[pk] = v
        return state
    for batch in sorted({r[2] for r in rows}):
        own = [r for r in rows if r[2] == batch]
        if any(r[3] == "T" for r in own):
            state = {}
        state |= {r[4]: r[5] for r in own if r[3] in "IU"}
        for r in own:
            if r[3] == "D":
                state.pop(r[4], None)
    return state


@pytest.mark.parametrize("batchwise", [False, True])
def test_closed_forms(spark, batchwise):
    rows = logs(40)
    df = spark.createDataFrame(rows, SCHEMA).cache()
    for log in range(0, 40, 4):
        own = df.filter(f"log = {log}")
        got = apply.batchwise(own, ["pk"], ["v"]) if batchwise else apply.ordered(own, ["pk"])
        assert {r["pk"]: r["v"] for r in got.select("pk", "v").collect()} == loop([r for r in rows if r[0] == log], batchwise), log


@pytest.mark.parametrize("mode", ["ordered", "batchwise"])
def test_replica(spark, tmp_path, mode):
    rows = [r for r in logs(8) if r[0] == 5]
    schema = T.StructType([T.StructField("pk", T.LongType()), T.StructField("v", T.DoubleType())])
    replica = Replica(spark, str(tmp_path), schema, ["pk"], mode)
    assert replica.view().count() == 0
    df = spark.createDataFrame(rows, SCHEMA)
    for batch in sorted({r[2] for r in rows}):
        for _ in range(2):  # written again, as after a failure
            replica.append(df.filter(f"batch_id = {batch}").drop("log", "batch_id"), batch)
        if batch == 1:
            replica.compact()
        got = {r["pk"]: r["v"] for r in replica.view().collect()}
        assert got == loop([r for r in rows if r[2] <= batch], mode == "batchwise")
    replica.compact()
    assert {r["pk"]: r["v"] for r in replica.view().collect()} == loop(rows, mode == "batchwise")
