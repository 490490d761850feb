"""Near-duplicate components by SetSketch registers.

A document's set is its distinct 5-word shingles. Register ``j`` holds the
smallest of the set's hashes under function ``j``, read as an exponential
variate and truncated to a whole power of the base: ``floor(1 - log_b(min))``.
Registers merge by maximum, and equal registers are likelier the larger the
Jaccard similarity.

1. Equal sets form one class; only one row per class goes on.
2. Four registers make a band. Each band bucket links its members to its
   smallest one (a star, not all pairs).
3. A pair's similarity is estimated by the joint likelihood of "register
   larger / smaller / equal" given both set sizes; hopeless pairs go.
4. Every component verifies its best pairs on the full texts, components are
   merged, and all pairs that still join two components are verified.
5. A bucket that still holds two components may hide links between members
   other than the smallest. Its documents are indexed again by an exact
   prefix filter (two sets with the wanted similarity share one of their first
   shingles under any common order; frequent shingles come last, so a passage
   that many documents share is no key). Members of small buckets are paired
   and sifted by size and estimate. Documents that meet in large ones form
   groups, compared on their sets block by block: a task sees two bounded
   blocks and reports only links that join components.

Texts move only for documents with an open pair. Nothing is capped: the list
of frequent shingles is bounded, but it only sets the order of step 5, which
is exact under every order.

Defined results: null or wordless text has no set and no link; fewer words
than a shingle make one shingle; repeated rows are linked; a null doc_id never
names a component (a component of only such rows has null); other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import U64, Rolling, buffers, mix64, python_stage, slices, staged, word_hashes
from riskloom.llm.components import components
from riskloom.session import table_path

SHINGLE = 5
PERCENT = 75
REGISTERS = 128
BAND = 4  # registers of 16 bits: a band is one 64-bit word
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 2
HOPE = 0.56  # a pair estimated below this is five standard errors from the threshold
FREQUENT = 100_000  # shingles at most in the list that orders step 5
BEST = 2  # pairs of a component that are verified first
SMALL = 64  # members of a bucket in step 5 that are paired; larger ones are compared in blocks
BLOCK, BLOCK_SHINGLES = 192, 150_000  # documents and shingles of a block, about
COLUMNS = 4096  # shingles multiplied at a time
SEND_IDS = 500_000  # ids at most that are broadcast to pick texts; beyond, a shuffled join

_SHINGLE = Rolling(0x9FB21C651E98DF25)
_RNG = np.random.default_rng(20240607)
_MUL = _RNG.integers(0, 2**31, REGISTERS).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(0, 2**32, REGISTERS, dtype=np.uint32)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles (not distinct) of some texts, and the shingles before each text."""
    words, before = word_hashes(data, offsets, lower=True)
    n = np.diff(before)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    cuts = np.concatenate([[0], np.cumsum(count)])
    start = np.arange(cuts[-1]) + np.repeat(before[:-1] - cuts[:-1], count)
    return _SHINGLE.ranges(words, start, np.minimum(start + size, np.repeat(before[1:], count))), cuts


def registers(hashes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """SetSketch registers (uint16, one row per text); texts without shingles get zeros."""
    out = np.zeros((len(cuts) - 1, REGISTERS), dtype=np.uint16)
    full = np.flatnonzero(np.diff(cuts))
    if len(full):
        x, at = (hashes >> U64(32)).astype(np.uint32), cuts[:-1][full]
        low = np.empty((len(full), REGISTERS), dtype=np.uint32)
        for j in range(REGISTERS):
            low[:, j] = np.minimum.reduceat(x * _MUL[j] + _ADD[j], at)
        variate = -np.log1p(-(low + 0.5) / 2.0**32) / RATE
        out[full] = np.clip(np.floor(1.0 - np.log(variate) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)
    return out


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of register rows with known set sizes."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    scale = (BASE - 1.0) / BASE
    p = lambda x: -np.log1p(-np.clip(x, 0.0, 1.0) * scale) / np.log(BASE)
    lo, hi = np.zeros(len(a)), np.minimum(u / v, v / u)
    for _ in range(30):  # the log likelihood is concave in the similarity
        one, two = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        fit = []
        for j in (one, two):
            up, down = p(u - v * j), p(v - u * j)
            fit.append(more * np.log(up + 1e-12) + less * np.log(down + 1e-12) + (REGISTERS - more - less) * np.log(np.maximum(1 - up - down, 1e-12)))
        better = fit[0] < fit[1]
        lo, hi = np.where(better, one, lo), np.where(better, hi, two)
    return (lo + hi) / 2


def _sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text."""
    hashes, cuts = shingles(data, offsets)
    for i in range(len(cuts) - 1):
        own = np.sort(hashes[cuts[i] : cuts[i + 1]])
        yield own[np.append(True, own[1:] != own[:-1])] if len(own) else own


def _set_key(own: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        return int(own.sum(dtype=U64).view(np.int64)), int(mix64(own ^ U64(0x5555)).sum(dtype=U64).view(np.int64))


def sketches(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) to doc_id, n (set size), a, b (128-bit set key), sketch."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for lo, hi in slices(offsets):
                part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                hashes, cuts = shingles(part, at)
                sizes, keys = [], []
                for i in range(hi - lo):
                    own = np.sort(hashes[cuts[i] : cuts[i + 1]])
                    own = own[np.append(True, own[1:] != own[:-1])] if len(own) else own
                    sizes.append(len(own))
                    keys.append(_set_key(own))
                rows = registers(hashes, cuts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(sizes, pa.int64()),
                        pa.array([k[0] for k in keys], pa.int64()),
                        pa.array([k[1] for k in keys], pa.int64()),
                        pa.array([r.tobytes() for r in rows], pa.binary()),
                    ],
                    names=["doc_id", "n", "a", "b", "sketch"],
                )

    return docs.mapInArrow(sketch, "doc_id long, n long, a long, b long, sketch binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)


def band_keys(reps: DataFrame) -> DataFrame:
    """(key, node): one row for each band of each class."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = np.ascontiguousarray(_matrix(batch.column(1))).view(U64)
            with np.errstate(over="ignore"):
                key = mix64(bands + mix64(np.arange(1, bands.shape[1] + 1, dtype=U64)))
            nodes = np.repeat(batch.column(0).to_numpy(), bands.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(nodes)], names=["key", "node"])

    return reps.select("node", "sketch").mapInArrow(keys, "key long, node long")


def hopeful(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """``pairs`` (u, v) whose estimate leaves a chance, with it."""
    side = lambda x: reps.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    joined = pairs.join(side("v"), "v").join(side("u"), "u").select("u", "v", "n_u", "n_v", "s_u", "s_v")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n_u, n_v = batch.column(2).to_numpy().astype(float), batch.column(3).to_numpy().astype(float)
                est = estimate(_matrix(batch.column(4)), _matrix(batch.column(5)), n_u, n_v)
                good = est >= HOPE
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), batch.column(1).filter(pa.array(good)), pa.array(est[good])], names=["u", "v", "est"])

    return joined.mapInArrow(judge, "u long, v long, est double")


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``pairs`` (u, v) that are similar on their full sets."""
    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"t_{x}"))
    joined = pairs.join(side("v"), "v").join(side("u"), "u").select("u", "v", "t_u", "t_v")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (data_u, at_u), (data_v, at_v) = buffers(batch.column(2)), buffers(batch.column(3))
            good = np.zeros(batch.num_rows, dtype=bool)
            for lo, hi in slices(at_u + at_v):
                of = lambda data, at: _sets(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])  # noqa: B023, E731
                for i, (x, y) in enumerate(zip(of(data_u, at_u), of(data_v, at_v), strict=True), lo):
                    both = len(x) + len(y)
                    same = both - len(np.unique(np.concatenate([x, y])))
                    good[i] = 100 * same >= percent * (both - same)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), batch.column(1).filter(pa.array(good))], names=["u", "v"])

    return joined.mapInArrow(check, "u long, v long")


class _Search:
    """Links found so far and the components they make."""

    def __init__(self, docs: DataFrame, reps: DataFrame, percent: int) -> None:
        self.docs, self.reps, self.percent = docs, reps, percent
        self.links = docs.sparkSession.createDataFrame([], "u long, v long")
        self.labels = docs.sparkSession.createDataFrame([], "node long, comp long")

    def labelled(self, rows: DataFrame, node: str, name: str) -> DataFrame:
        names = self.labels.select(F.col("node").alias(node), F.col("comp").alias(name))
        return rows.join(names, node, "left").withColumn(name, F.coalesce(name, node))

    def open(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose ends are in different components (cu, cv)."""
        return self.labelled(self.labelled(pairs, "u", "cu"), "v", "cv").where("cu <> cv")

    def texts(self, nodes: DataFrame) -> DataFrame:
        """node, text of ``nodes``; rows that repeat a doc_id are told apart by their set key."""
        named = staged(self.reps.join(nodes.distinct(), "node").select("node", "doc_id", "a"), "near-named")
        if named.count() <= SEND_IDS:
            named = F.broadcast(named)
        found = self.docs.join(named.withColumnRenamed("doc_id", "own"), F.col("doc_id").eqNullSafe(F.col("own"))).select("node", "a", "text")

        def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = buffers(batch.column(2))
                keys = batch.column(1).to_pylist()
                right = [_set_key(x)[0] == keys[lo + i] for lo, hi in slices(offsets) for i, x in enumerate(_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]))]
                right = pa.array(right, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(right), batch.column(2).filter(right)], names=["node", "text"])

        return staged(found.mapInArrow(own, "node long, text string"), "near-texts")

    def merge(self) -> None:
        self.labels = staged(components(self.links), "near-labels")

    def settle(self, pairs: DataFrame) -> None:
        """Find the links among ``pairs`` (u, v, est), a component's likeliest first.

        The first round verifies a few pairs of each component. They join most
        of what belongs together, so few pairs are left for the second, which
        verifies all that still join two components.
        """
        best = W.partitionBy("v").orderBy(F.desc("est"), "u")
        ranked = staged(pairs.withColumn("first", F.row_number().over(best) <= BEST).select("u", "v", "first"), "near-open")
        if ranked.isEmpty():
            return
        texts = self.texts(ranked.select(F.explode(F.array("u", "v")).alias("node")))
        self.links = staged(verified(ranked.where("first").select("u", "v"), texts, self.percent), "near-links")
        self.merge()
        more = verified(self.open(ranked.where("not first")).select("u", "v"), texts, self.percent)
        self.links = self.links.union(staged(more, "near-links"))

    def mixed(self, members: DataFrame) -> DataFrame:
        """Members (with comp) of the buckets that hold two components, and their number."""
        with_comp = self.labelled(members, "node", "comp")
        keys = with_comp.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count(F.lit(1)).alias("size"))
        return with_comp.join(keys.where("c0 < c1").select("key", "size"), "key")

    def exhaust(self, keys: DataFrame) -> None:
        """Find every link between components among the documents that share a key.

        In small buckets members are paired, if their sizes allow a link, and
        sifted by estimate. Documents that meet in large buckets form groups;
        a group is compared block by block on the sets, and only links leave
        a block.
        """
        left = staged(self.mixed(keys).join(self.reps.select("node", "n"), "node"), "near-mixed")
        small = left.where(F.col("size") <= SMALL)
        other = small.select("key", F.col("node").alias("u"), F.col("comp").alias("cu"), F.col("n").alias("nu"))
        like = F.lit(100) * F.least("n", "nu") >= F.lit(self.percent) * F.greatest("n", "nu")
        pairs = small.join(other, "key").where("u < node and comp <> cu").where(like).select("u", F.col("node").alias("v")).distinct()
        pairs = staged(hopeful(pairs, self.reps).select("u", "v"), "near-pairs")
        large = left.where(F.col("size") > SMALL).select("key", "node")
        stars = large.join(large.groupBy("key").agg(F.min("node").alias("u")), "key").where("u <> node").select("u", F.col("node").alias("v"))
        groups = components(stars)
        texts = self.texts(pairs.select(F.explode(F.array("u", "v")).alias("node")).union(groups.select("node")))
        found = verified(pairs, texts, self.percent).union(self.blocks(groups, texts))
        self.links = self.links.union(staged(found, "near-links"))
        self.merge()

    def blocks(self, groups: DataFrame, texts: DataFrame) -> DataFrame:
        """Links (u, v) inside ``groups`` (node, comp: the group) between components.

        A group's documents are dealt to blocks; each pair of blocks is one
        bounded task, which reports enough links to join what it finds linked.
        """
        percent = self.percent
        size = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)
        count = groups.join(self.reps.select("node", "n"), "node").groupBy("comp").agg(F.ceil(size).alias("blocks"))
        dealt = groups.join(count, "comp").withColumnRenamed("comp", "group")
        dealt = self.labelled(dealt, "node", "comp").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
        dealt = dealt.join(texts, "node").withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        dealt = dealt.select("group", F.least("own", "to").alias("lo"), F.greatest("own", "to").alias("hi"), "node", "comp", "text")

        def compare(table: pa.Table) -> pa.Table:
            data, offsets = buffers(table.column("text"))
            sets = [x for lo, hi in slices(offsets) for x in _sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])]
            nodes, comps = table.column("node").to_numpy(), table.column("comp").to_numpy()
            size = np.array([len(x) for x in sets])
            _, kind, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            row, shared = np.repeat(np.arange(len(sets)), size), times > 1
            row, kind = row[shared[kind]], (np.cumsum(shared) - 1)[kind[shared[kind]]]
            same = np.zeros((len(sets), len(sets)), dtype=np.float32)
            order = np.argsort(kind, kind="stable")
            row, kind = row[order], kind[order]
            for first in range(0, int(shared.sum()), COLUMNS):  # products of a part of the shingles at a time
                lo, hi = np.searchsorted(kind, [first, first + COLUMNS])
                part = np.zeros((len(sets), COLUMNS), dtype=np.float32)
                part[row[lo:hi], kind[lo:hi] - first] = 1.0
                same += part @ part.T
            linked = (100 * same >= percent * (size[:, None] + size[None, :] - same)) & (comps[:, None] != comps[None, :])
            parent: dict[int, int] = {}

            def root(c: int) -> int:
                while c in parent:
                    c = parent[c]
                return c

            out = []
            for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
                a, b = root(int(comps[i])), root(int(comps[j]))
                if a != b:
                    parent[a] = b
                    out.append((int(nodes[i]), int(nodes[j])))
            return pa.table({"u": pa.array([x for x, _ in out], pa.int64()), "v": pa.array([x for _, x in out], pa.int64())})

        return dealt.groupBy("group", "lo", "hi").applyInArrow(compare, "u long, v long")


def prefix_keys(texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(key, node): the first shingles of each set, frequent ones last: similar sets share one."""
    spark = texts.sparkSession

    def emit(common: np.ndarray | None):
        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = buffers(batch.column(1))
                nodes = batch.column(0).to_numpy()
                for lo, hi in slices(offsets):
                    found = []
                    for own in _sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]):
                        if common is not None:
                            often = np.append(common, U64(0))[np.searchsorted(common, own)] == own
                            own = np.concatenate([own[~often], own[often]])
                            own = own[: len(own) - (percent * len(own) + 99) // 100 + 1]
                        found.append(own)
                    key = np.concatenate(found) if found else np.zeros(0, U64)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.repeat(nodes[lo:hi], [len(x) for x in found]))], names=["key", "node"])

        return keys

    counts = texts.mapInArrow(emit(None), "key long, node long").groupBy("key").count().where("count > 8")
    rows = counts.orderBy(F.desc("count"), "key").limit(FREQUENT).select("key").collect()  # bounded by FREQUENT
    common = spark.sparkContext.broadcast(np.sort(np.array([r["key"] for r in rows], dtype=np.int64).view(U64)))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from emit(common.value)(batches)

    return texts.mapInArrow(prefixes, "key long, node long")


def _shared(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of keys that several nodes have, and the pairs of each with its key's smallest node."""
    buckets = keys.groupBy("key").agg(F.min("node").alias("u"), F.max("node").alias("last")).where("u < last").drop("last")
    members = staged(keys.join(buckets, "key"), "near-members")
    return members.select("key", "node"), members.where("node <> u").select("u", F.col("node").alias("v")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and class_id (rows with equal sets share one)."""
    if percent < PERCENT:
        raise ValueError(f"percent must be {PERCENT} or more: HOPE and the bands would miss pairs below it")
    python_stage(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = staged(sketches(docs).withColumn("row", F.monotonically_increasing_id()), "near-sketches")
    classes = staged(rows.where("n > 0").groupBy("a", "b").agg(F.min("row").alias("node")), "near-classes")
    reps = staged(rows.join(classes.select("node"), rows["row"] == classes["node"]).select("node", "doc_id", "a", "n", "sketch"), "near-reps")

    search = _Search(docs, reps, percent)
    members, stars = _shared(staged(band_keys(reps), "near-bands"))
    search.settle(hopeful(stars, reps))
    doubtful = staged(search.mixed(members).select("node").distinct(), "near-doubtful")
    if not doubtful.isEmpty():
        search.exhaust(staged(prefix_keys(search.texts(doubtful), percent), "near-prefixes").distinct())

    named = rows.select("doc_id", "n", "a", "b").join(classes, ["a", "b"], "left").withColumn("node", F.when(F.col("n") > 0, F.col("node")))
    named = staged(search.labelled(named, "node", "comp").select("doc_id", "n", "node", "comp"), "near-rows")
    ids = named.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    out = named.where("n > 0").join(ids, "comp").select("doc_id", "n", "component_id", "node")
    out = out.unionByName(named.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("node")))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"), F.col("node").alias("class_id"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE
    WHEN len(words) >= 5 THEN list_distinct(list_transform(range(1, len(words) - 3), lambda i: md5(array_to_string(words[i:i + 4], ' '))))
    WHEN len(words) > 0 THEN [md5(array_to_string(words, ' '))] ELSE [] END AS sh
  FROM w
), e AS (
  SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s
), c AS (
  SELECT a.doc_id AS u, b.doc_id AS v, a.n AS nu, b.n AS nv, count(*) AS same
  FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT u, v FROM c WHERE 100 * same >= 75 * (nu + nv - same)
), ends AS (
  SELECT u, v FROM l UNION ALL SELECT v, u FROM l
), reach AS (
  SELECT doc_id AS u, doc_id AS r FROM s
  UNION
  SELECT reach.u, ends.v FROM reach JOIN ends ON ends.u = reach.r
)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, min(reach.r) AS component_id, s.doc_id = min(reach.r) AS kept
FROM s JOIN reach ON reach.u = s.doc_id GROUP BY s.doc_id, s.sh
"""
