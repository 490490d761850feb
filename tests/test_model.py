"""Trees: exactness against a brute-force stump, save/load, edge cases."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskloom.operators.model import current_model, fit_tree, load_model, model_kind, publish_model, save_model
from riskloom.operators.prepare import assemble
from riskloom.plans import fixture as fx
from riskloom.specs import TreeParams


def _brute_force_stump():
    """Exhaustive depth-1 gini stump over midpoints, on the small fixture."""
    t = pq.read_table(f"{SF_SMALL}/lineitem.parquet", columns=["l_orderkey"] + fx.FEATURES).to_pandas()
    q = t.l_quantity.astype(int)
    y = ((((q * 7) + t.l_orderkey * 13) % 50) + q > 40).astype(int).to_numpy()
    train = np.array([hashlib.md5(str(k).encode()).hexdigest()[:4] < "cccc" for k in t.l_orderkey])
    X = t[fx.FEATURES].to_numpy()
    best = None
    for f in range(3):
        vals = np.unique(X[train, f])
        for thr in (vals[:-1] + vals[1:]) / 2:
            left = X[train, f] <= thr
            imp = 0.0
            for side in (left, ~left):
                n = side.sum()
                p = y[train][side].mean()
                imp += n / train.sum() * (1 - p * p - (1 - p) ** 2)
            if best is None or imp < best[0]:
                best = (imp, f, thr)
    _, f, thr = best
    left_tr = X[train, f] <= thr
    lpred = int(y[train][left_tr].mean() > 0.5)
    rpred = int(y[train][~left_tr].mean() > 0.5)
    pred = np.where(X[:, f] <= thr, lpred, rpred)
    return pred[~train], y[~train]


def test_stump_equals_brute_force(spark):
    model = fx.fitted(spark, SF_SMALL, "classifier", fx.STUMP)
    scored = fx.scored_test(spark, SF_SMALL, model)
    got = sorted((int(r.prediction), r.risk) for r in scored.select("prediction", "risk").collect())
    pred, y = _brute_force_stump()
    assert got == sorted(zip(pred.tolist(), y.tolist()))


def test_save_overwrite_load_by_metadata(spark, workdir):
    model = fx.fitted(spark, SF_SMALL, "classifier", fx.STUMP)
    path = f"{workdir}/m"
    save_model(model, path)
    with pytest.raises(Exception):
        save_model(model, path)  # exists, no overwrite
    save_model(model, path, overwrite=True)
    assert model_kind(spark, path) == "classifier"
    loaded = load_model(spark, path)
    a = fx.scored_test(spark, SF_SMALL, model).select("prediction").collect()
    b = fx.scored_test(spark, SF_SMALL, loaded).select("prediction").collect()
    assert a == b
    with pytest.raises(Exception):
        load_model(spark, path, kind="regressor")  # wrong class


def test_regressor_predicts_leaf_means(spark, workdir):
    model = fx.fitted(spark, SF_SMALL, "regressor", fx.MAJORITY)
    train = fx.lineitem_risk(spark, SF_SMALL).where(F.col("is_train"))
    mean = train.agg(F.avg("risk")).first()[0]
    preds = {round(r[0], 9) for r in fx.scored_test(spark, SF_SMALL, model).select("prediction").distinct().collect()}
    assert preds == {round(mean, 9)}
    path = f"{workdir}/r"
    save_model(model, path)
    assert model_kind(spark, path) == "regressor"


def test_single_class_and_bad_labels(spark):
    one = spark.createDataFrame([(0, 1.0), (0, 2.0), (0, 3.0)], "y int, x double")
    m = fit_tree(assemble(one, ["x"], keep=["y"]), "classifier", "y", TreeParams(max_depth=2))
    assert {r.prediction for r in m.transform(assemble(one, ["x"])).collect()} == {0.0}
    three = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 3.0)], "y int, x double")
    with pytest.raises(Exception):  # declared binary, label 2 present
        fit_tree(assemble(three, ["x"], keep=["y"]), "classifier", "y", num_classes=2)
    m3 = fit_tree(assemble(three, ["x"], keep=["y"]), "classifier", "y")
    assert m3.numClasses == 3
    nul = spark.createDataFrame([(None, 1.0), (1, 2.0)], "y int, x double")
    with pytest.raises(Exception):
        fit_tree(assemble(nul, ["x"], keep=["y"]), "classifier", "y")


def test_evaluator_accuracy_equals_aggregate(spark):
    from riskloom.operators.evaluate import accuracy, evaluator_accuracy

    model = fx.fitted(spark, SF_SMALL, "classifier", fx.STUMP)
    scored = fx.scored_test(spark, SF_SMALL, model)
    agg = accuracy(scored, fx.LABEL).first().accuracy
    assert abs(evaluator_accuracy(scored, fx.LABEL) - agg) < 1e-12
    assert accuracy(scored.limit(0), fx.LABEL).first().accuracy is None


def _grow(X, y, thresholds, depth, impurity):
    """Greedy level-wise tree over fixed candidate thresholds (numpy)."""

    def imp(n, p):
        if impurity == "gini":
            f0, f1 = (n - p) / n, p / n
            return 1.0 - f0 * f0 - f1 * f1
        return (p - p * p / n) / n

    def node(idx, level):
        n, p = float(len(idx)), float(y[idx].sum())
        leaf = {"pred": int(2 * p > n), "mean": p / n}
        if level == depth or p == 0 or p == n:
            return leaf
        parent, best = imp(n, p), None
        for f in range(X.shape[1]):
            xs = X[idx, f]
            for t in thresholds[f]:
                left = xs <= t
                ln = float(left.sum())
                if ln == 0 or ln == n:
                    continue
                lp = float(y[idx][left].sum())
                gain = parent - (ln / n) * imp(ln, lp) - ((n - ln) / n) * imp(n - ln, p - lp)
                if best is None or gain > best[0]:
                    best = (gain, f, t)
        if best is None or best[0] <= 0:
            return leaf
        _, f, t = best
        go = X[idx, f] <= t
        return {"f": f, "t": t, "l": node(idx[go], level + 1), "r": node(idx[~go], level + 1)}

    return node(np.arange(len(y)), 0)


def _predict(tree, x, key):
    while "f" in tree:
        tree = tree["l"] if x[tree["f"]] <= tree["t"] else tree["r"]
    return tree[key]


@pytest.mark.parametrize("kind", ["classifier", "regressor"])
def test_depth5_tree_equals_brute_force(spark, kind):
    t = pq.read_table(f"{SF_SMALL}/lineitem.parquet", columns=["l_orderkey"] + fx.FEATURES).to_pandas()
    q = t.l_quantity.astype(int)
    y = ((((q * 7) + t.l_orderkey * 13) % 50) + q > 40).astype(int).to_numpy()
    train = np.array([hashlib.md5(str(k).encode()).hexdigest()[:4] < "cccc" for k in t.l_orderkey])
    X = t[fx.FEATURES].to_numpy()
    thresholds = []
    for f in range(3):
        vals = np.unique(X[train, f])
        thresholds.append((vals[:-1] + vals[1:]) / 2)
    tree = _grow(X[train], y[train], thresholds, 5, "gini" if kind == "classifier" else "variance")
    key = "pred" if kind == "classifier" else "mean"
    want = sorted(
        (int(k), round(float(_predict(tree, x, key)), 9))
        for k, x in zip(t.l_orderkey[~train], X[~train])
    )
    model = fx.fitted(spark, SF_SMALL, kind, fx.DEEP)
    got = sorted(
        (r.l_orderkey, round(float(r.prediction), 9))
        for r in fx.scored_test(spark, SF_SMALL, model).select("l_orderkey", "prediction").collect()
    )
    assert got == want


def test_deep_tree_uses_checkpointed_node_cache(spark):
    from riskloom.operators.model import estimator

    est = estimator("classifier", "y", TreeParams(max_depth=12))
    assert est.getCacheNodeIds() and est.getCheckpointInterval() == 10
    df = spark.createDataFrame([((i // 4) % 2, float(i)) for i in range(64)], "y int, x double")
    m = fit_tree(assemble(df, ["x"], keep=["y"]), "classifier", "y", TreeParams(max_depth=12))
    assert m.depth >= 1 and spark.sparkContext.getCheckpointDir()


def test_publishing_swaps_whole_models(spark, workdir):
    path = f"{workdir}/published-models"
    rows = spark.createDataFrame([(float(i), int(i > 4)) for i in range(10)], "a double, y int")
    first, second = (fit_tree(assemble(rows, ["a"], keep=["y"]), kind, "y") for kind in ("classifier", "regressor"))
    with pytest.raises(ValueError, match="no model"):
        current_model(spark, path)
    own = publish_model(first, path)
    reader = current_model(spark, path)
    second.save(f"{path}/models/unfinished")  # a publisher that is lost before it names its model
    assert current_model(spark, path).uid == first.uid
    publish_model(second, path)
    assert current_model(spark, path).uid == second.uid
    assert load_model(spark, f"{path}/models/{own}").uid == first.uid  # the old one stays readable
    scored = reader.transform(assemble(rows, ["a"], keep=["y"]))
    assert scored.where("prediction <> y").isEmpty()
