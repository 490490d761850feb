"""What a Python worker holds stays that of one slice of text, with the results of the whole."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from riskloom.llm import common, language_id, tokens

from .conftest import prose


def peak_mb(run) -> float:  # noqa: ANN001
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_powers_of_a_long_sequence_are_not_kept():
    rolling, long = common.Rolling(0x5851F42D4C957F2D), np.arange(1 << 21, dtype=np.uint64)
    start, end = np.array([0, 7, 1 << 20]), np.array([5, 1 << 20, 1 << 21])
    found = rolling.ranges(long, start, end)
    assert len(rolling.up) <= common.KEPT_POWERS and len(rolling.down) <= common.KEPT_POWERS
    for h, lo, hi in zip(found, start, end, strict=True):  # alone, at another place
        assert h == common.Rolling(0x5851F42D4C957F2D).ranges(long[lo:hi], np.array([0]), np.array([hi - lo]))[0]


def test_a_batch_is_taken_slice_by_slice(spark, monkeypatch):
    rng = random.Random(8)
    texts = [prose(rng, 12_000) + f" own{i}" for i in range(70)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], names=["lang", "text"])
    docs = spark.createDataFrame([], "lang string, text string")
    models = language_id.fit(spark.createDataFrame([("en", prose(rng, 200)) for _ in range(30)], "lang string, text string"))
    kept = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: (kept.append(f), spark.createDataFrame([], schema))[1])
    language_id.identify(docs, models)
    language_id.gram_counts(docs, 2)
    tokens.encode(docs)
    predict, count, encode = kept
    assert batch.nbytes > 6 * common.SLICE_BYTES
    assert peak_mb(lambda: [b.num_rows for b in predict(iter([batch]))]) < 60
    assert peak_mb(lambda: [b.num_rows for b in count(iter([batch]))]) < 60
    assert peak_mb(lambda: [b.num_rows for b in encode(iter([batch]))]) < 45

    scored = pa.Table.from_batches(predict(iter([batch])))
    whole = models.predict(texts)
    assert scored.column("score").to_pylist() == whole["score"] and scored.column("bits").to_pylist() == whole["bits"]
    encoded, encoder = pa.Table.from_batches(encode(iter([batch]))), tokens.Encoder(tokens.load_model())
    assert encoded.column("ids").to_pylist() == encoder.encode(texts).lists()
    counted, words = Counter(), language_id.Words(texts)
    for row in pa.Table.from_batches(count(iter([batch]))).to_pylist():
        counted[row["ord"], row["gram"]] += row["cnt"]
    times = np.bincount(words.kind)
    for n in (1, 2):
        at, gram, _, _ = words.grams(n)
        want = Counter()
        for g, k in zip(gram.view(np.int64).tolist(), times[words.word[at]].tolist(), strict=True):
            want[n, g] += k
        assert want == Counter({key: v for key, v in counted.items() if key[0] == n})
