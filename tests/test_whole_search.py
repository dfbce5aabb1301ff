"""``fit_best_and_score`` compares its models on every training row, whatever the bound of the other searches."""

import pytest
from pyspark.sql import functions as F
from test_orders_once import _tables

from tessera.plans import catalog_ml
from tessera.plans.facts import order_frame


def test_baselines_are_compared_on_all_training_rows(spark, tmp_path, monkeypatch):
    d, met = str(tmp_path), []
    _tables(spark, d)

    class Stop(Exception):
        pass

    def compared(prepared, *_):
        met.extend(prepared.select("_src_idx", "fold").collect())
        prepared.unpersist()
        raise Stop

    monkeypatch.setattr(catalog_ml, "FIT_ROWS", 10)
    monkeypatch.setattr(catalog_ml.models, "cv_compare", compared)
    with pytest.raises(Stop):
        catalog_ml.q_fit_best_and_score(spark, d)
    sp = catalog_ml._train_frame(spark, d, order_frame(spark, d))
    want = {r["_src_idx"] for r in sp.where(F.col("split") == "train").select("_src_idx").collect()}
    assert {r["_src_idx"] for r in met} == want and len(met) == len(want) > 40
    assert {r["fold"] for r in met} == set(range(catalog_ml.FOLDS))
