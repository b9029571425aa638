from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from riskweave import schemas
from riskweave.operators import sketches
from riskweave.sources import readers
from riskweave.streaming import stateful, unified, upsert


def drop(path, records):
    path.mkdir(parents=True, exist_ok=True)
    name = f"r{len(list(path.iterdir()))}.json"
    (path / name).write_text("\n".join(json.dumps(r) for r in records))


def test_unified_stream_restarts_without_repeats(spark, tmp_path):
    dirs = {layer: tmp_path / layer for layer in schemas.STREAM_KIND}
    drop(dirs["market"], [{"symbol": "A", "price": 1.0, "type": "tick"}, {"stream_type": "quote", "payload": {"symbol": "B", "price": 2.0}}])
    drop(dirs["banking"], [{"date": "2024-01-01", "indicator_name": "rate", "series_id": "s", "value": 3.0, "layer": "old"}])
    drop(dirs["fdic"], [{"CERT": "7", "NAME": "Up"}])
    drop(dirs["fred"], [{"series_id": "DGS10", "value": 4.0}])
    drop(dirs["sedc"], [{"record_type": "13f", "filer_cik": "9"}])
    paths = {k: str(v) for k, v in dirs.items()}

    def run():
        unified.run_unified_stream(spark, paths, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out")

    first = run()
    assert {(r["layer"], r["stream"]) for r in first.collect()} == {
        ("market", "tick"), ("market", "quote"), ("banking", "rate"), ("fdic", "Up"), ("fred", "DGS10"), ("sedc", "13f")}
    assert {r["symbol"] for r in first.where("layer = 'market'").collect()} == {"A", "B"}
    assert run().count() == 6
    drop(dirs["fred"], [{"series_id": "VIXCLS", "value": 31.0}])
    assert run().count() == 7


def rows(n=300, seed=4):
    rng = random.Random(seed)
    return [(i, f"k{rng.randrange(20)}", rng.choice(["x", None, "y"]), rng.choice([None, 1.0, 2.0, 3.0])) for i in range(n)]


SCHEMA = "seq long, node_id string, a string, b double"


def expected(data):
    out = {}
    for _, key, a, b in sorted(data):
        old = out.get(key, (None, None))
        out[key] = (a if a is not None else old[0], b if b is not None else old[1])
    return out


def values(df):
    return {r["node_id"]: (r["a"], r["b"]) for r in df.collect()}


def test_upsert_in_any_order_and_twice(spark):
    data = rows()
    parts = [spark.createDataFrame(data[i::3], SCHEMA) for i in range(3)]
    state = None
    for part in (parts[2], parts[0], parts[2], parts[1]):
        state = upsert.upsert(state, part, ["node_id"], "seq")
    assert values(upsert.state_values(state, ["node_id"])) == expected(data)


def test_node_upsert_stream(spark, tmp_path):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    state, ck = f"{tmp_path}/state", f"{tmp_path}/ck"
    stream = readers.replay_stream(spark, df, f"{tmp_path}/in", 4, "seq")
    upsert.run_node_upsert(stream, state, ck, "seq").awaitTermination()
    assert values(upsert.state_values(upsert.read_state(spark, state, ["node_id"]), ["node_id"])) == expected(data)
    before = upsert.child_names(spark, state)
    upsert.run_node_upsert(stream, state, ck, "seq").awaitTermination()
    assert upsert.child_names(spark, state) == before


def test_batches_are_merged_and_repeats_replace_themselves(spark, tmp_path):
    data, folder = rows(200), f"{tmp_path}/state"
    for i in [0, 1, 2, 2, 3, 4, 5, 5, 6]:
        upsert.apply_batch(spark, spark.createDataFrame(data[i::7], SCHEMA), i, folder, ["node_id"], "seq", merge_every=2)
        part = [r for j in range(i + 1) for r in data[j::7]]
        assert values(upsert.state_values(upsert.read_state(spark, folder, ["node_id"]), ["node_id"])) == expected(part)
    names = sorted(n for n in upsert.child_names(spark, folder))
    assert names == ["batch=000000000004", "batch=000000000005", "batch=000000000006", "merged=000000000003", "merged=000000000005"]


def test_edge_upsert_creates_end_nodes(spark, tmp_path):
    edges = spark.createDataFrame(
        [(1, "a", "b", "repo loan", 1.0), (2, "a", "b", "REPO LOAN", 2.0), (3, "b", "c", None, None)],
        "seq long, source_id string, target_id string, relationship_type string, weight double")
    stream = readers.replay_stream(spark, edges, f"{tmp_path}/in", 2, "seq")
    upsert.run_edge_upsert(stream, f"{tmp_path}/e", f"{tmp_path}/n", f"{tmp_path}/ck", "seq").awaitTermination()
    out = upsert.state_values(upsert.read_state(spark, f"{tmp_path}/e", upsert.EDGE_KEY), upsert.EDGE_KEY)
    assert sorted(tuple(r) for r in out.collect()) == [("a", "b", "REPO_LOAN", 2.0), ("b", "c", "REL", None)]
    nodes = spark.createDataFrame([(1, "a", "Bank A")], "seq long, node_id string, name string")
    known = readers.replay_stream(spark, nodes, f"{tmp_path}/nin", 1, "seq")
    upsert.run_node_upsert(known, f"{tmp_path}/ns", f"{tmp_path}/nck", "seq").awaitTermination()
    every = upsert.graph_nodes(spark, f"{tmp_path}/ns", f"{tmp_path}/n")
    assert {(r["node_id"], r["name"]) for r in every.collect()} == {("a", "Bank A"), ("b", None), ("c", None)}


def finish(stream, out, ck, mode="append"):
    def write(batch, batch_id):
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/b={batch_id}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", ck).foreachBatch(write).trigger(
        availableNow=True).start().awaitTermination()


def test_dedupe_with_and_without_watermark(spark, tmp_path):
    df = spark.range(200).selectExpr("id as seq", "id % 13 as k", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id) as ts")
    for i, (ts, delay) in enumerate(((None, None), ("ts", "1 hour"))):
        stream = readers.replay_stream(spark, df, f"{tmp_path}/in{i}", 3, "seq")
        finish(stateful.stream_dedupe(stream, ["k"], ts, delay), f"{tmp_path}/o{i}", f"{tmp_path}/c{i}")
        assert sorted(r["k"] for r in spark.read.parquet(f"{tmp_path}/o{i}").collect()) == list(range(13))


def test_stream_dgim_equals_the_batch_state(spark, tmp_path):
    rng = random.Random(1)
    data = [(i, rng.choice("aab"), int(rng.random() < 0.7)) for i in range(600)] + [(600, "late", 0)]
    df = spark.createDataFrame(data, "seq long, shard string, bit int")
    stream = readers.replay_stream(spark, df, f"{tmp_path}/in", 4, "seq")
    stateful.run_stream_dgim(stream, "bit", "seq", ["shard"], f"{tmp_path}/s", f"{tmp_path}/ck", 64, span=40).awaitTermination()
    state = stateful.stream_dgim_state(spark, f"{tmp_path}/s", ["shard"])
    cols = ["shard", "bucket_size", "bucket_end", "current_time"]
    batch = sketches.dgim(df, "bit", "seq", 64, ["shard"])
    assert sorted(state.where("ones is not null").select(*cols).collect()) == sorted(batch.select(*cols).collect())
    assert state.where("shard = 'late'").first()["total_ones"] == 0
    for r in sketches.dgim_stats(batch, 64, ["shard"]).collect():
        truth = sum([b for _, k, b in data if k == r["shard"]][-64:])
        assert abs(r["estimated_count"] - truth) <= truth / 2


def test_stream_distinct_and_reservoir_equal_the_batch(spark, tmp_path):
    df = spark.range(500).selectExpr("id as seq", "id % 90 as k")
    stream = readers.replay_stream(spark, df, f"{tmp_path}/in", 3, "seq")
    finish(stateful.stream_distinct(stream, "k"), f"{tmp_path}/out", f"{tmp_path}/ck", "update")
    last = spark.read.parquet(f"{tmp_path}/out").orderBy(F.desc("batch")).first()
    batch = sketches.fm_distinct(df, "k").first()
    assert last["max_trailing_zeros"] == batch["max_trailing_zeros"]
    assert abs(last["approx_distinct"] - 90) < 10
    stateful.run_stream_reservoir(stream, ["seq"], f"{tmp_path}/r", f"{tmp_path}/rck", k=20, seed=3).awaitTermination()
    kept = spark.read.parquet(stateful.latest_version(spark, f"{tmp_path}/r"))
    assert {r["seq"] for r in kept.collect()} == {r["seq"] for r in sketches.reservoir(df, ["seq"], 20, 3).collect()}


def test_graph_files_arrive_as_a_stream(spark, tmp_path):
    folder = tmp_path / "nodes"
    folder.mkdir()
    names = ",".join(schemas.NODES.names)
    cells = ["BANK_1", "bank", "banking", '"A, B"'] + [""] * (len(schemas.NODES.names) - 4)
    (folder / "a.csv").write_text(f"{names}\n{','.join(cells)}\n")
    finish(readers.graph_stream(spark, str(folder), schemas.NODES), f"{tmp_path}/out", f"{tmp_path}/ck")
    row = spark.read.parquet(f"{tmp_path}/out").first()
    assert (row["node_id"], row["name"], row["total_assets"]) == ("BANK_1", "A, B", None)


def test_edge_upsert_keeps_no_batch_in_memory(spark, tmp_path, monkeypatch):
    """The ends come from the delta just written, missing ones included."""
    from pyspark.sql.classic.dataframe import DataFrame

    def kept(self, *args):
        raise AssertionError("a batch of any size does not fit the memory")

    monkeypatch.setattr(DataFrame, "persist", kept)
    rows = [("a", "b", "x", 1, 5.0), ("b", None, "x", 2, 1.0), (None, "c", None, 3, 2.0), ("a", "b", "x", 4, None)]
    df = spark.createDataFrame(rows, "source_id string, target_id string, relationship_type string, seq bigint, weight double")
    stream = readers.replay_stream(spark, df, f"{tmp_path}/replay", 2, "seq")
    upsert.run_edge_upsert(stream, f"{tmp_path}/e", f"{tmp_path}/n", f"{tmp_path}/ck", "seq").awaitTermination()
    ends = upsert.read_state(spark, f"{tmp_path}/n", upsert.NODE_KEY)
    assert {r.node_id for r in ends.collect()} == {"a", "b", "c", None} and ends.count() == 4
    found = upsert.state_values(upsert.read_state(spark, f"{tmp_path}/e", upsert.EDGE_KEY), upsert.EDGE_KEY)
    assert found.where("source_id = 'a'").first().weight == 5.0
