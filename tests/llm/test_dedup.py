"""Near-duplicate and substring dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from riskloom.llm import near_dedup, substring_dedup
from riskloom.llm.components import components

from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute_components(rows):
    """Component (smallest non-null id) of each row, by all pairs."""
    sets, parent = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if same and 100 * same >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[root(i)] = min(ids.get(root(i), d), d)
    return [(d, len(s), ids.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def brute_removed(rows, window=50):
    first, words = {}, [WORD.findall(t or "") for _, t in rows]
    for (d, _), w in zip(rows, words, strict=True):
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i : i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def edited(rng, text, share):
    words = text.split(" ")
    return " ".join(rng.choice(["ZZ", "Yy", "Xx", "Ww"]) + w if rng.random() < share else w for w in words)


@pytest.fixture(scope="module")
def copies():
    """Groups of edited copies around the threshold, a passage that most documents share, chains of copies."""
    rng = random.Random(11)
    passage, rows = prose(rng, 70), []
    for _ in range(6):
        text = prose(rng, rng.randint(60, 200))
        rows += [edited(rng, text, rng.choice([0, 0.01, 0.03, 0.05])) for _ in range(12)]
    for _ in range(40):
        rows.append(prose(rng, rng.randint(5, 60)) + " " + passage + " " + prose(rng, rng.randint(5, 60)))
    text = prose(rng, 120)
    for _ in range(15):  # each like the one before, the last unlike the first
        text = edited(rng, text, 0.02)
        rows.append(text)
    run = prose(rng, 3)
    rows += [(run + " ") * n for n in (30, 40, 90)] + ["", "a b", "a b", "A B", prose(rng, 30)]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows, strict=True))


def near(df):
    return sorted(map(tuple, near_dedup.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_near_duplicates_are_the_brute_force_components(spark, copies):
    df = spark.createDataFrame(copies, "doc_id long, text string").repartition(4)
    assert near(df) == sorted(brute_components(copies), key=str)


def test_large_buckets_compare_in_blocks(spark, copies, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 3)
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    df = spark.createDataFrame(copies, "doc_id long, text string").repartition(4)
    assert near(df) == sorted(brute_components(copies), key=str)


def test_near_duplicates_refuse_what_the_sketches_would_miss(no_docs):
    with pytest.raises(ValueError, match="75"):
        near_dedup.near_duplicates(no_docs, percent=50)


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert near(odd_docs) == sorted(brute_components(rows), key=str)
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_prefix_step_alone_finds_every_link(spark, copies):
    """The exact index of step 5: similar sets share a key."""
    df = spark.createDataFrame(copies, "node long, text string")
    keys = {}
    for r in near_dedup.prefix_keys(df).collect():
        keys.setdefault(r.node, set()).add(r.key)
    sets = {d: shingle_set(t) for d, t in copies}
    for a in sets:
        for b in sets:
            same = len(sets[a] & sets[b])
            if a < b and same and 100 * same >= 75 * len(sets[a] | sets[b]):
                assert keys[a] & keys[b]


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 2**63, 900).astype(np.uint64), rng.integers(0, 2**63, 900).astype(np.uint64)
    b[:600] = a[:600]
    one = lambda x: near_dedup.registers(x, np.array([0, len(x)]))
    assert (np.maximum(one(a), one(b)) == one(np.concatenate([a, b]))).all()
    true = 600 / 1200
    got = near_dedup.estimate(one(a), one(b), np.array([900.0]), np.array([900.0]))[0]
    assert abs(got - true) < 0.15
    assert near_dedup.estimate(one(a), one(a), np.array([900.0]), np.array([900.0]))[0] > 0.99


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (300, 200), (300, 250)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert all(found[i] == 0 for i in range(41)) and all(found[100 + i] == 100 for i in range(20))
    assert found[300] == found[250] == found[200] == 200
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def substring(df):
    from pyspark.sql import functions as F

    out = substring_dedup.substring_dedup(df).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    return sorted(map(tuple, out.collect()), key=str)


def test_substring_dedup_is_brute_force(spark):
    rng = random.Random(2)
    pool = [prose(rng, n) for n in (49, 50, 51, 80, 200)]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randint(0, 40)), rng.choice(pool), prose(rng, rng.randint(0, 30)), rng.choice(pool)]
        whole = " ".join(parts).split(" ")
        rows.append((rng.randint(0, 80), " ".join(whole[rng.randint(0, 30) : len(whole) - rng.randint(0, 30)])))
    rows += [(90, "ha " * 400), (91, "ha " * 60), (92, "ho ha " * 100), (93, "ha " * 49), (94, None), (95, "")]
    rows = list({d: (d, t) for d, t in rows}.values())
    assert substring(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == sorted(brute_removed(rows), key=str)


def test_substring_dedup_odd_rows(odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert substring(odd_docs) == sorted(brute_removed(rows), key=str)
    assert substring(no_docs) == []


def test_factors_are_whole_windows_of_earlier_documents(spark):
    rng = random.Random(8)
    a, b = prose(rng, 90), prose(rng, 70)
    rows = [(1, a), (2, b), (3, prose(rng, 9) + " " + a + " " + b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in substring_dedup.factors(substring_dedup.copied_windows(df)).collect()]
    assert sorted((d, s, n, o) for d, _, s, n, o in found) == [(3, 9, 90, 1), (3, 99, 70, 2)]
