"""Approximate nearest neighbours by NN-descent and greedy graph search.

Rows with equal vectors form one node, so a vector that a third of all rows
share is one point of the graph. The neighbour graph starts from random
hyperplane buckets and improves by joins of neighbours of neighbours: every
node gathers its neighbours and reverse neighbours (a bounded number each, as
in the published method), all of them are compared with each other where one
is new, and every node keeps the best it has met. It stops when few entries
change.

A query walks the graph greedily: the nearest nodes found so far that were not
expanded yet are joined with their neighbour lists, until a whole round finds
nothing nearer. Every row is in the graph; queries are a stated part of the
rows. Graph building and the walk compare vectors kept in single precision by
cosines in double precision, so that near-equal vectors stay apart; the whole
beam is then ranked by cosines of the original vectors in double precision.

Defined results: vectors that are null, empty, zero, hold a null or a
non-finite component, or have another length than most rows take no part; ties
go to the smaller vec_id; repeated rows are separate candidates; fewer
candidates than asked for are all returned; no valid vector gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import python_stage, staged
from riskloom.session import table_path

NEIGHBOURS = 32
GATHER = 32  # neighbours and as many reverse neighbours that meet at a node in a round
REPORT = 4  # better neighbours that a node hears of at one meeting
TABLES, CHUNK, FIRST = 8, 64, 8  # hyperplane tables, nodes compared at once, neighbours kept from each
ROUNDS = 8
SETTLED = 0.05  # share of entries changed in a round below which the graph is done
BEAM, EXPAND = 160, 80

_EDGES = "node long, nbr long, sim double"


def valid(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id and vec (array of double) of the rows that take part."""
    v = F.col("vec")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(finite).where(F.exists(v, lambda x: x != 0))
    usual = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size(v) == (usual["n"] if usual else 0))


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """A column of equally long lists or byte strings as rows."""
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1)


def codes(nodes: DataFrame) -> DataFrame:
    """node and its vector in single precision, scaled by its largest component."""

    def rounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1), float)
                x = (x / np.abs(x).max(axis=1, keepdims=True)).astype(np.float32)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["node", "code"])

    return nodes.select("node", "vec").mapInArrow(rounded, "node long, code binary")


def _buckets(coded: DataFrame, bits: int) -> DataFrame:
    """tbl, bucket, node, code: the side of random hyperplanes on which each node lies."""

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1), np.float32)
                planes = np.random.default_rng(11).standard_normal((x.shape[1], TABLES * bits)).astype(np.float32)
                side = ((x @ planes) > 0).reshape(len(x), TABLES, bits) @ (1 << np.arange(bits, dtype=np.int64))
                for t in range(TABLES):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(side[:, t]), batch.column(0), batch.column(1)], names=["tbl", "bucket", "node", "code"])

    return coded.mapInArrow(sides, "tbl int, bucket long, node long, code binary")


def local_join(groups: DataFrame, most: int) -> DataFrame:
    """Compares the members of each group (array of node, code, floor, fresh): (node, nbr, sim).

    Pairs with a fresh end count; each member reports at most ``most`` others
    that beat its floor.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            if not len(lists):
                continue
            cuts, flat = lists.offsets.to_numpy(), lists.values
            x = _matrix(flat.field("code"), np.float32).astype(float)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            nodes, floor = flat.field("node").to_numpy(), flat.field("floor").to_numpy()
            fresh = flat.field("fresh").to_numpy(zero_copy_only=False)
            out: list[tuple[np.ndarray, ...]] = []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                own, ids = x[lo:hi], nodes[lo:hi]
                sim = own @ own.T
                use = (fresh[lo:hi, None] | fresh[None, lo:hi]) & (ids[:, None] != ids[None, :]) & (sim > floor[lo:hi, None])
                if hi - lo > most:
                    use &= sim >= np.partition(np.where(use, sim, -2.0), -most, axis=1)[:, -most, None]
                a, b = np.nonzero(use)
                out.append((ids[a], ids[b], sim[a, b]))
            if out:
                cols = [np.concatenate(c) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["node", "nbr", "sim"])

    return groups.select("members").mapInArrow(compare, _EDGES)


def _best(edges: DataFrame, most: int) -> DataFrame:
    """The ``most`` best neighbours of each node; ``fresh`` if an entry is new."""
    one = edges.groupBy("node", "nbr").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(W.partitionBy("node").orderBy(F.desc("sim"), "nbr"))
    return one.withColumn("nth", rank).where(F.col("nth") <= most)


def _member(floor: Column, fresh: Column) -> Column:
    return F.struct("node", "code", floor.cast("double").alias("floor"), fresh.alias("fresh"))


def descend(coded: DataFrame, neighbours: int = NEIGHBOURS, gather: int = GATHER, rounds: int = ROUNDS) -> DataFrame:
    """The neighbour graph of ``coded`` (node, code): node, nbr, sim, nth."""
    n = coded.count()
    bits = max(1, min(40, int(np.log2(max(n, 2) / CHUNK)) + 1)) if n > CHUNK else 1
    dealt = _buckets(coded, bits)
    sizes = dealt.groupBy("tbl", "bucket").agg(F.count(F.lit(1)).alias("c"))
    chunk = F.pmod(F.xxhash64("node", "tbl"), F.ceil(F.col("c") / CHUNK))
    groups = dealt.join(sizes, ["tbl", "bucket"]).withColumn("chunk", chunk).groupBy("tbl", "bucket", "chunk")
    start = local_join(groups.agg(F.collect_list(_member(F.lit(-2.0), F.lit(True))).alias("members")), FIRST)
    graph = staged(_best(start.withColumn("fresh", F.lit(True)), neighbours), "ann-graph")
    for turn in range(rounds):
        # forward and reverse neighbours that meet at each node, new ones first
        ahead = graph.select(F.col("node").alias("centre"), F.col("nbr").alias("node"), "fresh", "sim")
        behind = graph.select(F.col("nbr").alias("centre"), "node", "fresh", "sim")
        pick = lambda x: x.withColumn("m", F.row_number().over(W.partitionBy("centre").orderBy(F.desc("fresh"), F.xxhash64("node", F.lit(turn))))).where(F.col("m") <= gather)  # noqa: B023, E731
        met = pick(ahead).unionByName(pick(behind)).groupBy("centre", "node").agg(F.max("fresh").alias("fresh"))
        floors = graph.groupBy("node").agg(F.when(F.count(F.lit(1)) >= neighbours, F.min("sim")).otherwise(F.lit(-2.0)).alias("floor"))
        sent = met.join(coded.join(floors, "node"), "node")
        groups = sent.groupBy("centre").agg(F.collect_list(_member(F.col("floor"), F.col("fresh"))).alias("members"))
        found = local_join(groups, REPORT)
        # entries that met as new in this round are old in the next
        used = met.where("fresh").select(F.col("centre").alias("node"), F.col("node").alias("nbr"), F.lit(True).alias("done"))
        old = graph.join(used, ["node", "nbr"], "left").select("node", "nbr", "sim", (F.col("fresh") & F.col("done").isNull()).alias("fresh"))
        graph = staged(_best(old.unionByName(found.withColumn("fresh", F.lit(True))), neighbours), "ann-graph")
        if graph.where("fresh").count() <= SETTLED * neighbours * n:
            break
    return graph


def _cosines(pairs: DataFrame) -> DataFrame:
    """``pairs`` (query, node, a, b) with the cosine of vectors a and b in double precision."""

    def cosine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = _matrix(batch.column(2), float), _matrix(batch.column(3), float)
                score = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], names=["query", "node", "score"])

    return pairs.select("query", "node", "a", "b").mapInArrow(cosine, "query long, node long, score double")


def _near_cosines(pairs: DataFrame) -> DataFrame:
    """``pairs`` (query, node, a, b) with the cosine of codes a and b."""

    def cosine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (_matrix(batch.column(i), np.float32).astype(float) for i in (2, 3))
                score = (a * b).sum(axis=1) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], names=["query", "node", "score"])

    return pairs.select("query", "node", "a", "b").mapInArrow(cosine, "query long, node long, score double")


def walk(coded: DataFrame, graph: DataFrame, queries: DataFrame, beam: int = BEAM, expand: int = EXPAND) -> DataFrame:
    """Greedy search from each query's own node: (query, node), the ``beam`` nearest nodes met.

    ``coded`` has node, code; ``queries`` has query, the node of its vector.
    """
    queries = queries.select("query").distinct()
    links = staged(graph.select("node", "nbr").union(graph.select("nbr", "node")).distinct(), "ann-links")
    goals = staged(queries.join(coded, F.col("query") == F.col("node")).select("query", F.col("code").alias("a")), "ann-goals")
    best = W.partitionBy("query").orderBy(F.desc("score"), "node")
    met = goals.select("query", F.col("query").alias("node"))
    front = staged(met.select("query", "node", F.lit(2.0).alias("score"), F.lit(True).alias("open")), "ann-beam")
    while True:
        rank = F.row_number().over(W.partitionBy("query", "open").orderBy(F.desc("score"), "node"))
        front = front.withColumn("now", F.col("open") & (rank <= expand))
        reached = front.where("now").select("query", "node").join(links, "node").select("query", F.col("nbr").alias("node")).distinct()
        reached = reached.join(met, ["query", "node"], "left_anti")
        fresh = staged(_near_cosines(reached.join(coded.withColumnRenamed("code", "b"), "node").join(goals, "query")), "ann-met")
        met = met.union(fresh.select("query", "node"))
        kept = front.select("query", "node", "score", (F.col("open") & ~F.col("now")).alias("open"))
        merged = kept.unionByName(fresh.withColumn("open", F.lit(True))).withColumn("r", F.row_number().over(best))
        front = staged(merged.where(F.col("r") <= beam).drop("r"), "ann-beam")
        if front.where("open").isEmpty():
            return front.select("query", "node")


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", **graph_options: int) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest other rows of every row where ``is_query`` (over vec_id)."""
    python_stage(vectors.sparkSession)
    rows = valid(vectors, id_col, vec_col).withColumn("h", F.xxhash64("vec")).withColumn("g", F.hash("vec"))
    rows = staged(rows, "ann-rows")
    classes = rows.groupBy("h", "g").agg(F.min("vec_id").alias("node"))
    members = staged(rows.select("vec_id", "h", "g").join(classes, ["h", "g"]).select("vec_id", "node"), "ann-members")
    nodes = staged(rows.join(classes.select("node"), rows["vec_id"] == F.col("node")).select("node", "vec").dropDuplicates(["node"]), "ann-nodes")
    coded = staged(codes(nodes), "ann-codes")
    graph = descend(coded, **graph_options)
    asked = members.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
    found = walk(coded, graph, asked)
    side = lambda name, vec: nodes.select(F.col("node").alias(name), F.col("vec").alias(vec))
    found = _cosines(found.join(side("node", "b"), "node").join(side("query", "a"), "query"))
    few = W.partitionBy("node").orderBy("vec_id")
    smallest = members.withColumn("m", F.row_number().over(few)).where(F.col("m") <= k + 1).select("node", "vec_id")
    pairs = asked.distinct().join(found, "query").join(smallest, "node").where("vec_id <> query_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(table_path(sf_dir, "embeddings"))
    return nearest_neighbours(vectors, F.col("vec_id") % 50 == 0)
