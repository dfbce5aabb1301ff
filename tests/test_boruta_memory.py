"""The rows of a Boruta round are kept once, on disk; the executors' memory is the forest's."""

from tessera.operators import models, permute


def test_rounds_hold_no_rows_in_memory(spark, monkeypatch):
    met, fit = [], models.RandomForestClassifier.fit
    kept = lambda: {i: r.getStorageLevel().useMemory() for i, r in spark.sparkContext._jsc.getPersistentRDDs().items()}
    before = set(kept())

    def seen(self, d, *a):
        met.append((d.storageLevel, d.rdd.getNumPartitions(), d.count(), [m for i, m in kept().items() if i not in before]))
        return fit(self, d, *a)

    monkeypatch.setattr(models.RandomForestClassifier, "fit", seen)
    monkeypatch.setattr(models, "ROWS_PER_TRAINING_TASK", 50)
    df = spark.createDataFrame([(i, float(i % 7), float(i % 3), int(i % 2)) for i in range(600)], "_src_idx long, a double, b double, late int")
    models.boruta_select(df, ["a", "b"], "late", rounds=2, trees=3)
    assert len(met) == 2
    for level, parts, rows, held in met:
        assert level.useDisk and not level.useMemory
        assert parts >= 12 and rows == 600  # as many as its rows need, above the session's 8 shuffle partitions
        assert held and not any(held)


def test_blocks_are_the_same_in_more_partitions(spark):
    df = spark.range(3_000).selectExpr("id", "id * 2 as v")
    few, more = (permute.blocked(df, "id", ["v"], 7, 3_000, rows=100, tasks=t) for t in (0, 40))
    assert sorted(map(str, few.collect())) == sorted(map(str, more.collect()))
    assert more.rdd.getNumPartitions() > 8
