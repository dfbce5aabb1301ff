"""Probes of fingerprint halves and runs of line hashes are never broadcast, however small their files are."""

import random

from tessera.llm import line_dedup, simhash


def test_probes_are_not_broadcast(spark, monkeypatch):
    rng = random.Random(11)
    fps = simhash.stored(spark.createDataFrame([(rng.getrandbits(63),) for _ in range(400)], "fp long"), "test-fps")
    plans, stored = {}, simhash.stored

    def seen(df, label, *a):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, label, *a)

    monkeypatch.setattr(simhash, "stored", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        simhash.links(fps)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plans["simhash-fetched"] and "Broadcast" not in plans["simhash-fetched"]


def test_line_runs_are_not_broadcast(spark, monkeypatch):
    plans, run = [], line_dedup.LineRuns._run

    def seen(self, df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return run(self, df)

    monkeypatch.setattr(line_dedup.LineRuns, "_run", seen)
    docs = spark.createDataFrame([(i, f"a line that is long enough, number {i % 40}") for i in range(200)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        got = line_dedup.dedup_lines(docs)
        assert got.where("n_dropped = 1").count() == 160
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [p for p in plans if "Join" in p]
    assert joins and all("SortMergeJoin" in p and "Broadcast" not in p for p in joins)
