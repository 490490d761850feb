"""A labelled risk dataset derived from the driver's ``lineitem`` table.

The clinical datasets are not available at scale, so the tree queries train on
``lineitem``: three features with few distinct values (so every split
candidate is a midpoint between neighbouring values and the learned tree is
exactly reproducible in SQL) and a label that is a deterministic function
of the row. Train/test membership is a hash of the order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.model import fit_tree
from riskloom.operators.prepare import assemble, hash_split_flag
from riskloom.session import data_version, session_key, table_path
from riskloom.specs import DIABETES, DatasetSpec, TreeParams, _schema

FEATURES = ["l_quantity", "l_discount", "l_tax"]
# few-valued columns only (7, 11 and 9 distinct values): exact under the
# learner's default 32 bins
CODED_FEATURES = ["l_linenumber", "l_discount", "l_tax"]
# more values than bins, but for the last
CONTINUOUS_FEATURES = ["l_extendedprice", "l_quantity", "l_discount"]
LABEL = "risk"
KEY = "l_orderkey"
TRAIN_FRACTION = 0.8

STUMP = TreeParams(max_depth=1, max_bins=64, seed=42)
MAJORITY = TreeParams(max_depth=0, max_bins=64, seed=42)
DEPTH2 = TreeParams(max_depth=2, max_bins=64, seed=42)
DEEP = TreeParams(max_depth=5, max_bins=64, seed=42)
DEFAULTS = TreeParams(seed=42)  # the learner's defaults: depth 5, 32 bins

LINEITEM_RISK = DatasetSpec(
    name="lineitem_risk",
    schema=_schema([("l_quantity", "double"), ("l_discount", "double"), ("l_tax", "double"), (LABEL, "int")]),
    label=LABEL,
    table="lineitem_risk",
    verdict=DIABETES.verdict,  # 0 -> negative, anything else -> positive
    params=STUMP,
    num_classes=2,
)


def risk_label(quantity: str = "l_quantity", key: str = KEY) -> Column:
    q = F.col(quantity).cast("int")
    return ((((q * 7) + F.col(key) * 13) % 50) + q > 40).cast("int")


def separable_label(quantity: str = "l_quantity") -> Column:
    return (F.col(quantity) > 17).cast("int")


def coded_label() -> Column:
    """A label from line number, discount and tax codes plus the order key."""
    d = F.floor(F.col("l_discount") * 100 + 0.5)
    t = F.floor(F.col("l_tax") * 100 + 0.5)
    return ((d + t * 2 + F.col("l_linenumber") + F.col(KEY) % 4) > 14).cast("int")


# label kind -> (label column, feature columns)
LABELS = {
    "risk": (risk_label, FEATURES),
    "separable": (separable_label, FEATURES),
    "coded": (coded_label, CODED_FEATURES),
}


def lineitem_risk(spark: SparkSession, sf_dir: str, label: Column | None = None) -> DataFrame:
    """l_orderkey, l_linenumber, features, label ``risk`` and ``is_train``.

    Only the five needed columns are read from the Parquet scan.
    """
    cols = [KEY, "l_linenumber", *FEATURES]
    li = spark.read.parquet(table_path(sf_dir, "lineitem")).select(*cols)
    return li.select(
        *cols,
        (label if label is not None else risk_label()).alias(LABEL),
        hash_split_flag(KEY, TRAIN_FRACTION).alias("is_train"),
    )


_MODELS: dict[tuple, object] = {}


def fitted(spark: SparkSession, sf_dir: str, kind: str, params: TreeParams, label_kind: str = "risk"):
    """Fit once per (session, data version, kind, params, label) and reuse in-process.

    Each fit costs several Spark jobs; the query catalogue shares models.
    """
    version = data_version(spark.read.parquet(table_path(sf_dir, "lineitem")))
    key = (session_key(spark), version, kind, params, label_kind)
    if key not in _MODELS:
        label, features = LABELS[label_kind]
        train = lineitem_risk(spark, sf_dir, label()).where(F.col("is_train"))
        vec = assemble(train, features, keep=[LABEL])
        _MODELS[key] = fit_tree(vec, kind, LABEL, params, num_classes=2)
    return _MODELS[key]


def scored_test(spark: SparkSession, sf_dir: str, model, label_kind: str = "risk") -> DataFrame:
    """The test side of the split with the model's output columns."""
    label, features = LABELS[label_kind]
    test = lineitem_risk(spark, sf_dir, label()).where(~F.col("is_train"))
    return model.transform(assemble(test, features))
