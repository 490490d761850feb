"""Scaling check: the same steps on sf lineitem and on N key-shifted copies.

    python tools/scale_check.py [SF_DIR] [COPIES]

The enlarged table is written below the session's shared checkpoint folder.
Prints one line per step with the time at 1x and at COPIESx (best of 2).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from riskloom.operators.evaluate import accuracy  # noqa: E402
from riskloom.operators.prepare import assemble  # noqa: E402
from riskloom.operators.score import score_requests  # noqa: E402
from riskloom.plans import fixture as fx  # noqa: E402
from riskloom.plans.queries.serving import lineitem_requests  # noqa: E402
from riskloom.session import build_session, shared_path  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _best(fn, repeats: int = 2) -> float:
    best = float("inf")
    for _ in range(repeats):
        t0 = time.time()
        fn()
        best = min(best, time.time() - t0)
    return best


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    copies = int(argv[1]) if len(argv) > 1 else 10
    spark = build_session("local[8]", shuffle_partitions=16, extra_conf={"spark.driver.memory": "16g"})
    src = spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet"))
    shift = src.agg(F.max("l_orderkey")).first()[0] + 1
    big = None
    for i in range(copies):
        part = src.withColumn("l_orderkey", F.col("l_orderkey") + F.lit(i * shift))
        big = part if big is None else big.unionByName(part)
    big_dir = shared_path(spark, f"lineitem-x{copies}")
    # even files, as a large table has (ten single-row-group files would run
    # as 10 tasks on 8 cores: two waves)
    big.repartition(16).write.parquet(os.path.join(big_dir, "lineitem.parquet"))

    for label, d in (("1x", sf_dir), (f"{copies}x", big_dir)):
        model = {}

        def fit():
            fx._MODELS.clear()
            model["m"] = fx.fitted(spark, d, "classifier", fx.DEEP)

        t_fit = _best(fit)
        m = model["m"]
        t_pred = _best(lambda: _run(accuracy(m.transform(assemble(fx.lineitem_risk(spark, d, balanced=False),
                                                                   fx.FEATURES)), fx.LABEL)))
        reqs = lineitem_requests(spark.read.parquet(os.path.join(d, "lineitem.parquet")))
        t_score = _best(lambda: _run(score_requests(m, reqs, fx.LINEITEM_RISK, strict=False,
                                                    keep=["l_orderkey", "l_linenumber"])))
        print(f"{label}: depth-5 fit {t_fit:.2f}s, predict+accuracy {t_pred:.2f}s, scoring {t_score:.2f}s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
