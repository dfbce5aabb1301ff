"""A preparation fitted on training rows only (imputation, features and pruning of inventory 48-56, 44, 45).

Every statistic that preparing a table needs (fill values, which columns are
skewed, which are redundant) is taken from the rows given to ``fit_preparation``; ``apply``
then is a row-wise projection without a shuffle, so the same fitted preparation serves test rows, new
tables and streams, and no test row has a say in it. It is a small record: one fill value
per column and lists of names, and it is saved as one JSON row.

Edge cases: NaN counts as missing; a numeric column without any value in the fitted rows is filled with 0, a text
column with ``missing``; categories that the fitted rows do not hold stay as they are. Rows with a missing target
are prepared like others. A frame that lacks a fitted column raises Spark's error. Other columns pass through, but an
input column that has the name of a feature is replaced.
"""

from __future__ import annotations

import dataclasses
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.quantile import mode_table, quantile_row
from tessera.functions.safe import nan_to_null, numeric_columns, string_columns
from tessera.operators.assoc import prune_columns
from tessera.operators.features import feat_pair, log_candidates

#: Names that are always features; an input column of such a name (or of ``log_`` or ``sq_`` before another's) is no input.
NEW = ("feat_ratio", "feat_sum", "feat_product", "feat_diff", "feat_interact")


def _q(c: str):
    return F.col(f"`{c}`")


@dataclasses.dataclass(frozen=True)
class Preparation:
    key: str
    target: str
    numeric: dict  # column -> fill value, in schema order
    text: dict  # column -> fill value
    logs: tuple = ()  # columns whose log1p is a feature
    dropped: tuple = ()

    def _filled(self, df: DataFrame) -> DataFrame:
        df = nan_to_null(df, list(self.numeric))
        fill = {**{c: F.coalesce(_q(c).cast("double"), F.lit(float(v))) for c, v in self.numeric.items()},
                **{c: F.coalesce(_q(c), F.lit(v)) for c, v in self.text.items()}}
        return df.select(*[fill[c].alias(c) if c in fill else _q(c) for c in df.columns])

    def _features(self) -> dict:
        """The expression of every new column, over filled columns."""
        num = list(self.numeric)
        out = {f"log_{c}": F.log1p(F.greatest(_q(c), F.lit(0.0))) for c in self.logs}
        if len(num) >= 3:
            out["feat_interact"] = _q(num[0]) * _q(num[2])
        out.update({f"sq_{c}": _q(c) * _q(c) for c in num[:2] if len(num) >= 2})
        return out

    def apply(self, df: DataFrame) -> DataFrame:
        """``df`` filled, with the features, without the dropped columns."""
        num, made = list(self.numeric), self._features()
        out = self._filled(df.drop(*NEW, *made))
        if len(num) >= 2:
            out = feat_pair(out, num[0], num[1])
        return out.select("*", *[e.alias(c) for c, e in made.items()]).drop(*self.dropped)

    def numeric_inputs(self, df: DataFrame) -> list[str]:
        """The numeric model inputs among the columns of a prepared ``df``."""
        return [c for c in numeric_columns(df) if c not in (self.key, self.target)]

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(dataclasses.asdict(self)),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preparation:
        rec = json.loads(spark.read.text(path, wholetext=True).first()[0])
        return cls(**{**rec, "logs": tuple(rec["logs"]), "dropped": tuple(rec["dropped"])})


def fit_preparation(train: DataFrame, key: str, target: str, threshold: float = 0.95, missing: str = "MISSING",
                    exclude: tuple[str, ...] = ()) -> Preparation:
    """Medians, modes, skewed columns and redundant columns of the rows of ``train``.

    ``exclude`` names further columns that are neither filled nor inputs (a split or fold column).
    """
    out_of = {key, target, *exclude}
    num = [c for c in numeric_columns(train) if c not in out_of and c not in NEW]
    num = [c for c in num if not any(c in (f"log_{b}", f"sq_{b}") for b in num)]
    text = [c for c in string_columns(train) if c not in out_of and c not in NEW]
    med = quantile_row(nan_to_null(train.select(*[_q(c) for c in num]), num), num, [0.5]) if num else {}
    modes = {r["name"]: r["value"] for r in mode_table(train, text).collect()}
    first = Preparation(key, target, {c: 0.0 if med.get((c, 0.5)) is None else float(med[(c, 0.5)]) for c in num},
                        {c: missing if modes.get(c) is None else modes[c] for c in text})
    logs = tuple(log_candidates(first._filled(train), num[:8]))
    second = dataclasses.replace(first, logs=logs)
    _, drop = prune_columns(second.apply(train).drop(*exclude), target, threshold, keep=(key,))
    return dataclasses.replace(second, dropped=tuple(drop))
