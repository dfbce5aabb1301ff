"""tessera: end-to-end tabular analysis and modelling as Spark jobs.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a small
result frame) built from the DataFrame API so Catalyst can push filters,
prune columns and plan shuffles.
"""

from tessera.session import get_spark, checkpoint_dir, cut_lineage, checked_broadcast

__all__ = ["get_spark", "checkpoint_dir", "cut_lineage", "checked_broadcast"]
