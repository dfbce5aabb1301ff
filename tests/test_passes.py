"""How often a frame is run, and how it is dealt out."""

from pyspark.sql import functions as F

from tessera.operators import groups, models
from tessera.operators import hypothesis as hyp
from tessera.session import persist_sized

SPECS = [{"id": "A", "statement": "a", "kind": "group_mean", "key": "g", "target": "t", "expected_direction": "positive"},
         {"id": "B", "statement": "b", "kind": "group_mean_count", "key": "h", "target": "t", "expected_direction": "none"}]


def counted(spark, rows):
    """A frame of ``rows`` that counts how often each of its rows is made."""
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b
    df = spark.createDataFrame(rows, "g int, h string, t double, cls double, proba double")
    return df.mapInArrow(run, df.schema), made


def rows(n):
    return [(i % 4 if i % 9 else None, f"h{i % 3}", None if i % 11 == 0 else float(i % 2), float(i % 2), 0.5 + i % 5 / 10) for i in range(n)]


def test_verdicts_run_their_results_once(spark):
    df, made = counted(spark, rows(400))
    got = hyp.hypothesis_verdict(hyp.run_hypotheses(df, SPECS), hyp.specs_frame(spark, SPECS)).orderBy("id").collect()
    assert made.value == 400
    assert [(r["groups"], r["supported"]) for r in got] == [(4, 4), (3, 3)]


def test_verdicts_by_test_share_one_pass(spark):
    df, made = counted(spark, rows(400))
    both = hyp.results_and_statistics(df, SPECS)
    got = hyp.verdict_by_test(*both, hyp.specs_frame(spark, SPECS)).orderBy("id").collect()
    assert made.value <= 800  # the groups are written once; at most the size of the shuffle is asked before
    plain = spark.createDataFrame(rows(400), df.schema)
    want = hyp.verdict_by_test(hyp.run_hypotheses(plain, SPECS), hyp.test_statistics(plain, SPECS), hyp.specs_frame(spark, SPECS)).orderBy("id").collect()
    assert got == want


def test_unsupported_groups_stay_counted(spark):
    res = spark.createDataFrame([("A", "0", 0.0, 0.1, 40), ("A", "1", 1.0, 0.5, 50), ("A", "2", 2.0, 9.0, 5), ("B", "x", None, None, 0)], hyp.RESULT_SCHEMA)
    a, b = hyp.hypothesis_verdict(res, hyp.specs_frame(spark, SPECS)).orderBy("id").collect()
    assert (a["groups"], a["supported"], round(a["spread"], 6), round(a["direction_corr"], 6), a["verdict"]) == (3, 2, 0.4, 1.0, "TRUE")
    assert (b["groups"], b["supported"], b["spread"], b["direction_corr"], b["verdict"]) == (1, 0, None, None, "INCONCLUSIVE")


def test_dashboard_runs_its_rows_once(spark):
    df, made = counted(spark, rows(300))
    got = {(r["section"], r["name"]): r["value"] for r in groups.dashboard_summary(df, "h", "cls", "proba").collect()}
    assert made.value == 300
    assert got[("kpi", "rows")] == 300 and got[("distribution", "0.0")] == 150 and got[("by_category", "h1")] == 50


def test_sized_frames_are_dealt_out_anew_when_they_have_too_few_partitions(spark):
    df = spark.range(1000).coalesce(1).withColumn("v", F.col("id") * 2)
    d = persist_sized(df, 100, keep_slots=False)
    sizes = d.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert len(sizes) == 10 and max(sizes) <= 120
    assert d.agg(F.sum("v")).first()[0] == 999000
    d.unpersist()


def test_rungs_of_a_tuning_have_partitions_by_their_rows(spark, monkeypatch):
    seen = []

    def scored(cases, part, *_):
        seen.append((part.count(), part.rdd.getNumPartitions()))
        return [{"mean": 0.0, "std": 0.0, "reason": None} for _ in cases]
    monkeypatch.setattr(models, "_cv_all", scored)
    monkeypatch.setattr(models, "TUNING_ROWS", 300)
    prepared = spark.range(2700).withColumnRenamed("id", "_src_idx").repartition(9).persist()
    models.tune_halving(prepared, "classification", "LogisticRegression", models.model_catalog("classification")["LogisticRegression"], 2, 9, 3)
    prepared.unpersist()
    assert [p for _, p in seen] == [-(-n // 300) for n, _ in seen]
    assert seen[0][1] < 3 and seen[-1] == (2700, 9)


def test_shadows_are_the_neighbours_of_packed_blocks(spark):
    from pyspark.sql import functions as F

    from tessera.operators import permute

    rows = spark.createDataFrame([(i, float(i % 2), [float(i), i * 10.0, i * 100.0]) for i in range(41)], "_src_idx long, label double, x array<double>")
    base = permute.blocked(rows, "_src_idx", ["label", "x"], 7, 41, rows=10)
    own, turn = [2, 0], [3, 1 << 29]
    got = sorted((r.label, *r.x) for r in permute.with_shadows(permute.packed(base), own, turn).collect())
    each = base.select("r", F.posexplode("r").alias("place", "row"))
    want = each.select("row.c0", *[F.get("row.c1", F.lit(c)) for c in own],
                       *[F.get(permute.neighbour(F.col("r"), F.col("place"), F.lit(o))["c1"], F.lit(c)) for c, o in zip(own, turn)])
    assert got == sorted(map(tuple, want.collect())) and len(got) == 41
