"""Merkle manifest of a dataset, by nested-struct rollup.

Every document is a leaf; per group (source) the leaves in order form a tree
of fixed fan-out, and the groups' roots form one more tree above them.  A
leaf's rank, written in digits to the base of the fan-out, is its way down
the tree.  The digit columns are grouped away one after the other, last
digit first, and each grouping nests the children as structs in their
parent's row, so a row ends up holding a whole subtree.  Exploding it again
gives every leaf the siblings on its way: inside a subtree no row is joined.

Subtrees are blocks of ``FANOUT ** DIGITS`` leaves, so a row stays small
however large a group is; the roots of the blocks are the leaves of the
next storey, a table 256 times smaller.  From the top storey down, a block
gets the way from its root upwards (one row a block).  Ranks come from a
range sort of all groups together, so a hot source is many partitions.

Only SQL functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import cut, prepare, ranked

FANOUT = 16
DIGITS = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the inputs, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A field's text in a leaf: its length in bytes and the value, ``-`` for null."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _width(total: Column, digits: int) -> Column:
    """Nodes left of ``total`` after ``digits`` levels."""
    return F.ceil(total / F.lit(float(FANOUT ** digits))).cast("long")


def _node(total: Column, hashes: Column) -> Column:
    """Hash of the parent of a run; a level of one node has no parent."""
    return F.when(total > 1, digest(F.array_join(hashes, ""))).otherwise(hashes[0])


def blocks_of(nodes: DataFrame, extra: list[str]) -> DataFrame:
    """Nodes (g, rank, total, hash, and ``extra``) rolled up into blocks:
    (g, rank, total, width, hash, runs), where rank is the block's, hash its
    root, width the number of blocks of the group, and runs the nested
    children."""
    d = nodes.withColumn("block", F.floor(F.col("rank") / F.lit(FANOUT ** DIGITS)))
    d = d.withColumn("d1", F.pmod(F.floor(F.col("rank") / F.lit(FANOUT)), F.lit(FANOUT)))
    d = d.withColumn("d0", F.pmod("rank", F.lit(FANOUT)))
    # dealt once by block, which serves both groupings
    d = d.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "g", "block")
    d = d.groupBy("g", "total", "block", "d1").agg(
        F.sort_array(F.collect_list(F.struct("d0", "hash", *extra))).alias("kids"))
    d = d.withColumn("hash", _node(F.col("total"), F.col("kids.hash")))
    d = d.groupBy("g", "total", "block").agg(F.sort_array(F.collect_list(F.struct("d1", "hash", "kids"))).alias("runs"))
    return d.select("g", F.col("block").alias("rank"), "total", _width(F.col("total"), DIGITS).alias("width"),
                    _node(_width(F.col("total"), 1), F.col("runs.hash")).alias("hash"), "runs")


def storeys(nodes: DataFrame, extra: list[str]) -> list[DataFrame]:
    """Tables of blocks from the leaves up, until every group is one block."""
    out = [cut(blocks_of(nodes, extra))]
    while (out[-1].agg(F.max("width")).first()[0] or 0) > 1:
        b = out[-1].select("g", "rank", F.col("width").alias("total"), "hash")
        out.append(cut(blocks_of(b, [])))
    return out


def _siblings(hashes: Column, at: Column, level: Column) -> Column:
    """The step past one level: siblings before and after, none if there is no level."""
    step = F.struct(F.array_join(F.slice(hashes, F.lit(1), at), "").alias("left"),
                    F.array_join(F.slice(hashes, at + 2, F.lit(FANOUT)), "").alias("right"))
    return F.when(level > 1, F.array(step)).otherwise(F.array().cast("array<struct<left:string,right:string>>"))


def unrolled(blocks: DataFrame, extra: list[str], down: list[str]) -> DataFrame:
    """The nodes of blocks that hold ``path``, the way from their root up:
    (g, rank, hash, path, and the columns ``extra`` and ``down``)."""
    d = blocks.select("g", "rank", "total", "path", *down, F.col("runs.hash").alias("level1"), F.posexplode("runs").alias("i", "run"))
    d = d.select("g", "rank", "total", "path", *down, "i",
                 _siblings(F.col("level1"), F.col("i"), _width(F.col("total"), 1)).alias("step1"),
                 F.col("run.kids.hash").alias("level0"), F.posexplode("run.kids").alias("j", "kid"))
    step0 = _siblings(F.col("level0"), F.col("j"), F.col("total"))
    rank = (F.col("rank") * F.lit(FANOUT) + F.col("i")) * F.lit(FANOUT) + F.col("j")
    return d.select("g", rank.alias("rank"), F.col("kid.hash").alias("hash"), F.concat(step0, "step1", "path").alias("path"),
                    *[F.col(f"kid.{c}").alias(c) for c in extra], *down)


def climbed(tops: list[DataFrame], above: DataFrame, extra: list[str], down: list[str]) -> DataFrame:
    """The leaves of all storeys with their whole way up; ``above`` holds
    (g, path, and the columns ``down``) of every group's root."""
    top = tops[-1].alias("t").join(above.alias("a"), F.col("t.g").eqNullSafe(F.col("a.g")))
    d = top.select("t.*", "a.path", *[f"a.{c}" for c in down])
    for k in range(len(tops) - 1, -1, -1):
        d = unrolled(d, extra if not k else [], down)
        if k:
            on = F.col("t.g").eqNullSafe(F.col("a.g")) & (F.col("t.rank") == F.col("a.rank"))
            d = tops[k - 1].alias("t").join(d.alias("a"), on).select("t.*", "a.path", *[f"a.{c}" for c in down])
    return d


def _no_path() -> Column:
    return F.array().cast("array<struct<left:string,right:string>>")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda acc, p: digest(p["left"], acc, p["right"]))


def manifest(leaves: DataFrame, extra: list[str]) -> DataFrame:
    """Proofs of ``leaves`` (g, id, hash, and ``extra``): g, hash, extra,
    path (array of siblings before and after, from the leaf up to the root
    of all groups), subroot and root.

    In a group leaves ascend by id, null first, and leaves of one id by
    their hash; groups ascend by name, null first.  Empty table: no rows."""
    prepare(leaves.sparkSession)
    nodes = ranked(leaves, ["g"], [F.col("id").asc_nulls_first(), F.col("hash")])
    inner = storeys(nodes.drop("id"), extra)
    roots = inner[-1].select(F.col("g").alias("name"), "hash")
    outer = storeys(ranked(roots, [], [F.col("name").asc_nulls_first()]).withColumn("g", F.lit(0)), ["name"])
    root = outer[-1].select("g", F.col("hash").alias("root"), _no_path().alias("path"))
    groups = climbed(outer, root, ["name"], ["root"]).select(F.col("name").alias("g"), F.col("hash").alias("subroot"), "root", "path")
    return climbed(inner, groups, extra, ["subroot", "root"])


def document_leaves(docs: DataFrame) -> DataFrame:
    """(g, id, doc_id, hash, tampered): ``tampered`` is the leaf of a document
    whose text was lower-cased (A-Z), where the checksum of its id says so."""
    *head, text = [F.col(c) for c in FIELDS]
    lowered = F.translate(text, _UPPER, _LOWER)
    changed = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(TAMPER_EVERY)) == 0
    start = F.concat(*[field(c) for c in head])
    return docs.select(F.col("source").alias("g"), F.col("doc_id").alias("id"), "doc_id",
                       digest(start, field(text)).alias("hash"),
                       F.when(changed, digest(start, field(lowered))).alias("tampered"))


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, source, lang, n_chars, text): doc_id,
    leaf, subroot, root, proof_sha256, folded_root, verified.

    A null field is ``-`` in its leaf, an empty one ``0:``; a null source is
    a group of its own, the first; a null doc_id comes first in its source
    and is never tampered.  Rows of one doc_id follow each other by leaf;
    repeated rows are leaves of their own.  A single document is its own
    root with the digest of nothing as proof.  Empty table: no rows.  Other
    columns are not read."""
    d = manifest(document_leaves(docs), ["doc_id", "tampered"])
    siblings = F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), "")
    d = d.withColumn("folded_root", folded(F.coalesce("tampered", "hash"), F.col("path")))
    return d.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", digest(siblings).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
