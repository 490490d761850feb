"""Merkle manifest of a dataset: one hash tree per language, a tree over their roots, a proof per row.

A leaf is the sha256 of a row's fields, each written with its length. Leaves
are ranked per tree by a range sort, whose positions need only one count per
partition and tree. ``fanout ** levels`` consecutive leaves are a block, which
hashes its own subtree. The blocks then exchange roots as a butterfly: in
round r, blocks that differ only in digit r of their number (to the base
``fanout``) meet, each hears the subtree roots of the others and all hash the
same ancestor. After the last round every block holds the siblings of its
whole upper path and the tree's root, and nothing is passed down again. In a
last subtree with fewer blocks than lanes, a block serves several lanes. The
trees' roots become leaves of one more tree by the same functions.

Every step is a DataFrame function; groups hold at most one block's leaves or
``fanout`` roots, however many rows one tree or one repeated row has.

Defined results: a null field is written ``-``, so null and empty differ; rows
without an id come first; rows that agree in id are ordered by leaf, and equal
rows are interchangeable but each has a place; a single leaf is its tree's
root, and with a single tree that is the root of all; no siblings give the
hash of nothing; an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import staged
from riskloom.session import table_path

FANOUT = 8
LEVELS = 4  # a block holds FANOUT ** LEVELS leaves
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
PATH = "array<struct<left:string,right:string>>"
_PARTITION_BITS = 33  # how monotonically_increasing_id splits: partition above, row below


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def leaf_hash(values: dict[str, Column]) -> Column:
    """Hash of a row's fields in order: ``-`` for null, else byte count, ``:`` and value."""
    text = [v.cast("string") for v in values.values()]
    return digest(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]))


def tree_key(c: str) -> Column:
    """A tree's name that is never null; null sorts first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))


def _joined(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` (tree and any columns) with ``rank`` in their tree, from 0, and the tree's ``size``.

    A salt in the sort spreads equal rows; positions are counted per partition.
    """
    salted = staged(leaves.withColumn("salt", F.monotonically_increasing_id()), "manifest-leaves")
    keys = ["tree", *order, "salt"]
    dealt = salted.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = staged(dealt.drop("salt").withColumn("at", F.monotonically_increasing_id()), "manifest-sorted")
    part = F.shiftright("at", _PARTITION_BITS)
    runs = placed.groupBy("tree", part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("tree")
    before = F.sum("n").over(whole.orderBy("part")) - F.col("n") - F.col("first")
    runs = staged(runs.select("tree", "part", before.alias("shift"), F.sum("n").over(whole).alias("size")), "manifest-runs")
    numbered = placed.withColumn("part", part).join(runs, ["tree", "part"])
    return numbered.select(*leaves.columns, (F.col("at") + F.col("shift")).alias("rank"), "size")


def blocks_of(leaves: DataFrame, order: list[str], fanout: int, levels: int) -> DataFrame:
    """One row a block: tree, size, block, and its leaves' rows by rank."""
    own = [c for c in leaves.columns if c != "tree"]
    placed = ranked(leaves, order).withColumn("block", F.expr(f"rank div {fanout**levels}"))
    rows = F.sort_array(F.collect_list(F.struct("rank", *own)))
    return staged(placed.groupBy("tree", "size", "block").agg(rows.alias("rows")), "manifest-blocks")


def with_levels(blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``blocks`` with the hashes of each level of their own subtree: l0 (leaves) to the one of the last."""
    out = blocks.withColumn("l0", F.transform("rows", lambda r: r["leaf"]))
    for k in range(levels):
        # several nodes remain in the tree: every run of them, this block's last one too, becomes its hash
        parents = f"transform(sequence(0, (size(l{k}) - 1) div {fanout}), i -> sha2(array_join(slice(l{k}, i * {fanout} + 1, {fanout}), ''), 256))"
        out = out.withColumn(f"l{k + 1}", F.expr(f"case when size > {fanout**k} then {parents} else l{k} end"))
    return out


def _step(hashes: Column, at: Column, start: Column, fanout: int) -> Column:
    """The hashes before and after place ``at`` (from 0) in the run that begins at ``start``."""
    left = F.slice(hashes, start + 1, at - start)
    return F.struct(_joined(left).alias("left"), _joined(F.slice(hashes, at + 2, start + (fanout - 1) - at)).alias("right"))


def _swap(state: DataFrame, stride: int, fanout: int) -> DataFrame:
    """One round: blocks whose numbers differ in one digit meet and hash their common ancestor."""
    subtree = f"(block div {stride})"
    last = f"{subtree} = (blocks - 1) div {stride}"
    sent = state.where(F.col("blocks") > stride).selectExpr(
        "*",
        f"block div {stride * fanout} as parent",
        f"cast({subtree} % {fanout} as int) as place",
        f"block % {stride} as lane",
        # the last subtree may have fewer blocks than lanes: its blocks serve the lanes between them
        f"case when {last} and {subtree} % {fanout} > 0 then sequence(block % {stride}, {stride - 1}L, blocks - {subtree} * {stride})"
        f" else array(block % {stride}) end as lanes",
    )
    message = F.struct("place", "h", F.when(F.col("to") == F.col("lane"), F.struct("block", "blocks", "path")).alias("own"))
    met = sent.withColumn("to", F.explode("lanes")).groupBy("tree", "parent", "to").agg(F.sort_array(F.collect_list(message)).alias("met"))
    heard = met.select("tree", "met", F.transform("met", lambda m: m["h"]).alias("hashes"))
    heard = heard.select("tree", "hashes", digest(_joined(F.col("hashes"))).alias("up"), F.posexplode("met").alias("pos", "m")).where("m.own is not null")
    step = _step(F.col("hashes"), F.col("pos"), F.lit(0), fanout)
    moved = heard.select("tree", "m.own.block", "m.own.blocks", F.col("up").alias("h"), F.concat("m.own.path", F.array(step).cast(PATH)).alias("path"))
    return moved.unionByName(state.where(F.col("blocks") <= stride))


def butterfly(blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """tree, block, h (the tree's root) and path (the siblings above the block), for every block."""
    roots = with_levels(blocks, fanout, levels).select(
        "tree", "block", F.expr(f"(size - 1) div {fanout**levels} + 1").alias("blocks"), F.col(f"l{levels}")[0].alias("h"), F.array().cast(PATH).alias("path")
    )
    state = staged(roots, "manifest-roots")
    most = state.agg(F.max("blocks")).first()[0] or 0
    stride = 1
    while stride < most:
        state = staged(_swap(state, stride, fanout), "manifest-round")
        stride *= fanout
    return state.drop("blocks")


def leaf_paths(blocks: DataFrame, roots: DataFrame, own: list[str], fanout: int, levels: int) -> DataFrame:
    """tree, the leaves' ``own`` columns, root of the tree (h) and path: all siblings from the leaf to that root."""
    grown = with_levels(blocks, fanout, levels).join(roots, ["tree", "block"])

    def one(row: Column, i: Column) -> Column:
        steps = []
        for k in range(levels):
            at = F.floor(i / fanout**k).cast("int")
            start = at - at % fanout
            step = F.array(_step(F.col(f"l{k}"), at, start, fanout)).cast(PATH)
            steps.append(F.when(F.col("size") > fanout**k, step).otherwise(F.array().cast(PATH)))
        return F.struct(*[row[c].alias(c) for c in own], F.concat(*steps).alias("low"))

    return grown.select("tree", "h", "path", F.inline(F.transform("rows", one))).select("tree", *own, "h", F.concat("low", "path").alias("path"))


def proofs(leaves: DataFrame, order: list[str], fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """``leaves`` (tree, leaf and others) with their tree's ``subroot``, the ``root`` and the ``path`` between leaf and root."""
    own = [c for c in leaves.columns if c != "tree"]
    blocks = blocks_of(leaves, order, fanout, levels)
    roots = butterfly(blocks, fanout, levels)
    tops = roots.where("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("h").alias("leaf"))
    top_blocks = blocks_of(tops, ["name"], fanout, levels)
    top = leaf_paths(top_blocks, butterfly(top_blocks, fanout, levels), ["name"], fanout, levels)
    top = staged(top.select(F.col("name").alias("tree"), F.col("h").alias("root"), F.col("path").alias("top")), "manifest-top")
    whole = roots.join(top, "tree").select("tree", "block", F.struct("h", "root").alias("h"), F.concat("path", "top").alias("path"))
    found = leaf_paths(blocks, staged(whole, "manifest-uppers"), own, fanout, levels)
    return found.select("tree", *own, F.col("h.h").alias("subroot"), F.col("h.root").alias("root"), "path")


def siblings_hash(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return digest(_joined(F.transform(path, lambda p: F.concat(p["left"], p["right"]))))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, p: digest(F.concat(p["left"], h, p["right"])))


def manifest(docs: DataFrame, tree: str = "lang", order: str = "doc_id", fields: list[str] = FIELDS, changed: dict[str, Column] | None = None, only: Column | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Per row: ``order``, leaf, subroot, root, path; ``seen``, the leaf with the ``changed`` columns where ``only`` holds (else null)."""
    values = {c: F.col(c) for c in fields}
    seen = leaf_hash(values | changed) if changed else F.lit(None).cast("string")
    if only is not None:
        seen = F.when(only, seen)
    leaves = docs.select(tree_key(tree).alias("tree"), F.col(order).alias("id"), leaf_hash(values).alias("leaf"), seen.alias("seen"))
    return proofs(leaves, ["id", "leaf"], fanout, levels).withColumnRenamed("id", order).drop("tree")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = manifest(docs, changed={"text": lowered}, only=tampered)
    out = found.select("doc_id", "leaf", "subroot", "root", siblings_hash(F.col("path")).alias("proof_sha256"), fold(F.coalesce("seen", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_SQL_LEVELS = 8  # the SQL grows so many levels: up to 8 ** 8 rows a language
_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE concat(strlen(CAST({0} AS VARCHAR)), ':', CAST({0} AS VARCHAR)) END"


def _sql_leaf(text: str) -> str:
    return "sha256(concat(" + ", ".join(_FIELD.format(text if f == "text" else f) for f in FIELDS) + "))"


def _sql_tree(name: str, tree: str, path: str, seen: str) -> str:
    """CTEs that grow the trees over ``name``0 (tree, idx, h) and walk the leaves of ``path``0 (tree, idx, own columns) up."""
    parts = []
    for k in range(_SQL_LEVELS):
        parts.append(f"""{name}_s{k} AS (SELECT {tree}, count(*) > 1 AS more FROM {name}{k} GROUP BY {tree}),
{name}{k + 1} AS (
  SELECT {tree}, CASE WHEN more THEN idx // 8 ELSE idx END AS idx, CASE WHEN any_value(more) THEN sha256(string_agg(h, '' ORDER BY n.idx)) ELSE any_value(h) END AS h
  FROM {name}{k} n JOIN {name}_s{k} s USING ({tree}) GROUP BY {tree}, 2),
{path}{k + 1} AS (
  SELECT p.pid, p.{tree}, CASE WHEN any_value(s.more) THEN any_value(p.idx) // 8 ELSE any_value(p.idx) END AS idx,
         any_value(p.proof) || coalesce(string_agg(n.h, '' ORDER BY n.idx) FILTER (s.more AND n.idx <> p.idx), '') AS proof,
         CASE WHEN any_value(s.more) THEN sha256(string_agg(CASE WHEN n.idx = p.idx THEN p.{seen} ELSE n.h END, '' ORDER BY n.idx)) ELSE any_value(p.{seen}) END AS {seen}
  FROM {path}{k} p JOIN {name}_s{k} s ON s.{tree} = p.{tree} JOIN {name}{k} n ON n.{tree} = p.{tree} AND CASE WHEN s.more THEN n.idx // 8 = p.idx // 8 ELSE n.idx = p.idx END
  GROUP BY p.pid, p.{tree})""")
    return ",\n".join(parts)


_CRC_STEP = "xor(xor(c, e) >> 1, 3988292384::UBIGINT * (xor(c, e) & 1))"
_CRC_BITS = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: [ascii(d)::UBIGINT] || list_resize([]::UBIGINT[], 7, 0::UBIGINT)))"
_CRC = f"xor(list_reduce([4294967295::UBIGINT] || {_CRC_BITS}, lambda c, e: {_CRC_STEP}), 4294967295::UBIGINT)"
_LOWER = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_sql_leaf("text")} AS leaf,
         CASE WHEN {_CRC} % 3 = 0 THEN {_sql_leaf(_LOWER)} ELSE {_sql_leaf("text")} END AS seen
  FROM documents
), r AS (
  SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS pid,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM d
), a0 AS (SELECT tree, idx, leaf AS h FROM r),
p0 AS (SELECT pid, tree, idx, '' AS proof, seen FROM r),
{_sql_tree("a", "tree", "p", "seen")},
b0 AS (SELECT 0 AS one, row_number() OVER (ORDER BY tree) - 1 AS idx, h, tree FROM a{_SQL_LEVELS}),
q0 AS (SELECT p.pid, 0 AS one, b.idx, p.proof, p.seen FROM p{_SQL_LEVELS} p JOIN b0 b USING (tree)),
{_sql_tree("b", "one", "q", "seen")}
SELECT r.doc_id, r.leaf, s.h AS subroot, t.h AS root, sha256(q.proof) AS proof_sha256, q.seen AS folded_root, q.seen = t.h AS verified
FROM r JOIN a{_SQL_LEVELS} s USING (tree) JOIN q{_SQL_LEVELS} q USING (pid) CROSS JOIN b{_SQL_LEVELS} t
"""
