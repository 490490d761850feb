"""Source mixing, revisits, neighbours, the pipeline, and queries against their SQL."""

from __future__ import annotations

import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import ann, mixing, queries, warc

from .conftest import SF, prose

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(corpus_pipeline.__file__)), "tools"))
from check_oracles import _rows, duck  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    res = duck(SF).execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, res.fetchall())


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """The targets as they are told: share by weight, cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, target = share * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] >= cap * sizes[s]}
        if not over:
            return target | {s: level * w[s] for s in free}
        target |= {s: cap * sizes[s] for s in over}
        left -= sum(cap * sizes[s] for s in over)
        free -= over
    return target


def check_mix(rows):
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = brute_targets(sizes)
    for s in sizes:
        own = [r for r in rows if r.source == s]
        assert all(abs(r.target - want[s]) < 1e-6 * max(1, want[s]) and r.source_size == sizes[s] for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) < 1
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    assert all((r.first_slot is None) == (r.taken == 0) for r in rows)


def test_mix_meets_targets_and_reruns_agree(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix_sources(docs).documents.collect()
    assert len(rows) == docs.count()
    check_mix(rows)
    again = mixing.mix_sources(docs.repartition(7), block_words=mixing.BLOCK_WORDS).documents.collect()
    key = lambda r: (r.doc_id, r.size, r.taken, r.first_slot or -1)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    odd = mixing.mix_sources(odd_docs, block_words=64).documents.collect()
    assert len(odd) == odd_docs.count()
    check_mix(odd)
    assert mixing.mix_sources(no_docs).documents.count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_mix_schedule_is_even_at_every_scale(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mix = mixing.mix_sources(docs, block_words=32)
    slots = sorted((r.slot, r.source, r.words) for r in mix.schedule.collect())
    assert len({s for s, _, _ in slots}) == len(slots)
    target = {r.source: r.target for r in mix.sources.collect()}
    total = sum(target.values())
    half = slots[: len(slots) // 2]
    for source in target:
        got = sum(w for _, s, w in half if s == source)
        assert abs(got / sum(w for *_, w in half) - target[source] / total) < 0.02


def test_mixed_documents_repeat_whole_rows(spark, odd_docs):
    out = mixing.mixed_documents(odd_docs)
    assert out.columns == odd_docs.columns
    texts = {r.text for r in odd_docs.collect()}
    assert {r.text for r in out.collect()} <= texts


def test_canonical_urls(spark):
    pairs = {
        "http://WWW.Example.com:80/a/b/?utm_source=x&b=2&a=1#top": "example.com/a/b?a=1&b=2",
        "https://example.com/a/b?a=1&b=2": "example.com/a/b?a=1&b=2",
        "//example.com": "example.com",
        "https://user@www2.example.com/index.html?ref=k": "example.com",
        "no host": None,
        "": None,
    }
    df = spark.createDataFrame([(u,) for u in pairs], "u string").select("u", warc.canonical_url(F.col("u")).alias("k"))
    assert {r.u: r.k for r in df.collect()} == pairs


def brute_resolve(rows):
    """Latest earlier response of each revisit by looking at all of them."""
    out = []
    for v in rows:
        if v["type"] == "revisit":
            best = max(((r["ts"], r["record_id"]) for r in rows if r["type"] == "response" and r["status"] == 200 and None not in (v["ts"], r["ts"], v["url"]) and r["url"] == v["url"] and r["ts"] < v["ts"]), default=None)
            stored = next((r["headers"] or {} for r in rows if best and r["record_id"] == best[1]), {})
            own = v["headers"] or {}
            strip = lambda t: t.removeprefix("W/") if t else t
            if "etag" in own:
                agree = strip(own["etag"]) == strip(stored.get("etag"))
            elif "last-modified" in own:
                agree = own["last-modified"] == stored.get("last-modified")
            else:
                agree = not {"etag", "last-modified"} & set(stored)
            verdict = "no_response" if best is None else "resolved" if agree else "validator_mismatch"
            merged = {**stored, **{k: x for k, x in own.items() if k not in warc.NOT_MERGED}} if verdict == "resolved" else None
            out.append((v["record_id"], best and best[1], verdict, merged))
    return out


def test_revisits_are_brute_force(spark):
    import random

    rng = random.Random(3)
    schema = "record_id long, type string, url string, ts long, status int, headers map<string,string>, body string, key string, bucket int"
    urls = ["https://hot.example.com/x"] * 6 + [f"https://h{i}.example.com/" for i in range(6)] + [None]
    rows = []
    for i in range(600):
        headers = {k: v for k, v in {"etag": rng.choice(['"a"', 'W/"a"', '"b"', None]), "last-modified": rng.choice(["d1", "d2", None]), "content-type": f"t{i}", "x": str(i)}.items() if v}
        rows.append((i, rng.choice(["response", "revisit"]), rng.choice(urls), rng.choice([None, *range(60)]), rng.choice([200, 200, 404]), rng.choice([headers, headers, headers, None]), f"body {i}", "clash", 1))
    rows += [r for r in rows if r[1] == "response"][:5]  # repeated records
    df = spark.createDataFrame(rows, schema).repartition(5)
    got = sorted((r.record_id, r.refers_to, r.verdict, r.headers) for r in warc.resolve_revisits(df).collect())
    names = [f.name for f in df.schema]
    want = sorted(brute_resolve([dict(zip(names, r, strict=True)) for r in rows]))
    assert [w[:3] for w in want] == [g[:3] for g in got] and [w[3] for w in want] == [g[3] for g in got]
    assert warc.resolve_revisits(df.where("false")).count() == 0


def exact_neighbours(rows, k=5):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    size = max(set(len(v) for _, v in ok), key=lambda n: sum(len(v) == n for _, v in ok)) if ok else 0
    ok = [(i, v / np.linalg.norm(v)) for i, v in ok if len(v) == size]
    return {i: sorted((-round(float(v @ w), 10), j) for n, (j, w) in enumerate(ok) if n != m)[:k] for m, (i, v) in enumerate(ok)}


def test_neighbours_recall_and_scores(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    found = ann.nearest_neighbours(vectors, F.col("vec_id") % 10 == 0).collect()
    want = exact_neighbours([(r.vec_id, r.embedding) for r in vectors.collect()])
    asked = [i for i in want if i % 10 == 0]
    hits = sum(len({r.vec_id for r in found if r.query_id == i} & {j for _, j in want[i]}) for i in asked)
    assert hits >= 0.95 * 5 * len(asked) and len(found) == 5 * len(asked)
    scores = {(i, j): -s for i in asked for s, j in want[i]}
    assert all(abs(r.score - scores[r.query_id, r.vec_id]) < 1e-9 for r in found if (r.query_id, r.vec_id) in scores)


def test_neighbours_in_a_tight_group(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((3000, 64))
    vectors[::3] = rng.standard_normal(64) * (1 + 0.005 * rng.standard_normal((1000, 64)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = ann.nearest_neighbours(df, F.col("vec_id") % 30 == 0).collect()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    for i in range(0, 3000, 30):
        near = unit @ unit[i]
        near[i] = -2
        hits += len({r.vec_id for r in found if r.query_id == i} & set(np.argsort(-near)[:5].tolist()))
    assert hits >= 0.9 * 5 * 100, hits


def test_neighbours_odd_vectors(spark):
    rng = np.random.default_rng(2)
    hot = rng.standard_normal(8).tolist()
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(60)] + [(100 + i, hot) for i in range(40)]
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [None] * 8), (204, [float("nan")] + [1.0] * 7), (205, [float("inf")] * 8), (206, [1.0]), (None, hot)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, node string")
    found = ann.nearest_neighbours(df, F.col("vec_id") % 5 == 0).collect()
    want = exact_neighbours(rows)
    for i in [i for i in want if i % 5 == 0]:
        assert [r.vec_id for r in sorted((r for r in found if r.query_id == i), key=lambda r: r.rank)] == [j for _, j in want[i]]
    few = ann.nearest_neighbours(df.where("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]
    assert ann.nearest_neighbours(df.where("vec_id between 200 and 205"), F.lit(True)).count() == 0
    assert ann.nearest_neighbours(df.where("false"), F.lit(True)).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        sizes.append((name, docs.count()))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    counts = dict(sizes)
    assert counts["language"] >= 195 and counts["near_dups"] < counts["language"] and counts["secrets"] == counts["near_dups"]
    assert counts["mix"] > counts["secrets"] and counts["tokens"] == counts["mix"]
    assert all(r.parity and r.round_trip and r.n_tokens == len(r.ids) for r in docs.collect())


def test_pipeline_of_no_documents(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_pipeline_keeps_one_row_of_each_near_duplicate_group(spark):
    rng = random.Random(31)
    a, b, c = (prose(rng, 200) for _ in range(3))
    rows = [(1, a), (2, b), (2, a + " tail"), (None, c), (None, c + " tail"), (None, a), (3, b + " end"), (3, b + " end"), (4, None), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", None, 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row_key int").repartition(4)
    kept = corpus_pipeline.near_dups(spark, docs, SF)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == 5 and (1, a) in got and (2, b) in got and [t in (c, c + " tail") for i, t in got if i is None] == [True]
