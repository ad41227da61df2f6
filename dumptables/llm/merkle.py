"""Merkle manifest of a dataset: a hash tree for each language, and one tree over their roots.

A leaf is the SHA-256 of a row's fields, each written as its UTF-8 byte count, ``:`` and value,
or ``-`` for null. Leaves of a language ascend by doc_id (null first; rows that share an id by
leaf). Two consecutive nodes become the hash of their joined hex digests, a last one alone the
hash of itself, until one is left.

The tree is persistent: a changed leaf starts a version that copies only the leaf's ancestors and
shares every other node with the original. Trees are cut into aligned blocks of ``2**bits`` nodes:
a block's inner levels follow from its nodes alone, so versions copy their path inside the block,
and blocks' top nodes are the leaves of the next tier. A block knows its path through the
tiers above from one join with as many rows as there are blocks; versions go on along that path,
each for itself, wherever their block lies. No task ever holds more than one block of a tree,
however many rows a language or a version of it has.

Texts are hashed on the scan and never moved. Positions come from a range sort of the leaves and
sums over one row per partition and language. An empty table gives no rows; equal rows have equal
leaves at different positions; a null language is a language, first in order; columns beyond the
five of ``FIELDS`` are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dumptables.llm.common import written

BITS = 8  # levels, and so 256 nodes, of a block
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def row_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of all fields of a row."""
    marked = []
    for field in fields:
        value = field.cast("string")
        marked.append(
            F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
        )
    return F.sha2(F.concat(*marked), 256)


def leaves_of(docs: DataFrame, changes: dict[str, Column], changed: Column) -> DataFrame:
    """``tree`` (the language as a name that is never null), ``doc_id``, ``leaf`` and ``new_leaf``:
    the leaf with ``changes`` made to its fields, null where ``changed`` does not hold."""
    plain = [F.col(name) for name in FIELDS]
    made = [changes.get(name, F.col(name)) for name in FIELDS]
    return docs.select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("tree"),
        "doc_id",
        row_digest(plain).alias("leaf"),
        F.when(changed, row_digest(made)).alias("new_leaf"),
    )


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Rows with ``pos``, their place among the ``n`` rows of their ``tree`` by ``order``.

    Rows alike in all of ``order`` are dealt out by where they were read, so that they too spread.
    """
    salted = rows.withColumn("row", F.monotonically_increasing_id())
    place = ("tree", *order, "row")
    dealt = salted.repartitionByRange(*place).sortWithinPartitions(*place)
    kept = written(dealt.withColumn("row", F.monotonically_increasing_id()), name)
    part = F.shiftright("row", 33).alias("part")
    here = kept.groupBy("tree", part).agg(F.min("row").alias("first"), F.count("*").alias("m"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = here.select(
        "tree",
        "part",
        (F.col("first") - F.coalesce(F.sum("m").over(before), F.lit(0))).alias("zero"),
        F.sum("m").over(tree).alias("n"),
    )
    return (
        kept.withColumn("part", part)
        .join(starts, ["tree", "part"])
        .withColumn("pos", F.col("row") - F.col("zero"))
        .drop("row", "part", "zero")
    )


def _blocks(nodes: DataFrame, name: str, bits: int) -> DataFrame:
    """Nodes (``tree, n, pos, digest`` and more) gathered by aligned block, in order."""
    more = [c for c in nodes.columns if c not in ("tree", "n", "pos", "digest")]
    slot = F.expr(f"CAST(pos & {2**bits - 1} AS INT)").alias("slot")
    blocks = nodes.groupBy("tree", "n", F.shiftright("pos", bits).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct(slot, "digest", *more))).alias("nodes")
    )
    return written(blocks, name)


# The levels of a block, from its nodes up to its top: level j of a tree with n leaves has
# ceil(n / 2**j) nodes, and the tree ends where that is one.
LEVELS = """
    aggregate(sequence(0, bits - 1), array(nodes.digest), (levels, j) ->
        CASE WHEN shiftright(n + shiftleft(1L, j) - 1, j) > 1 THEN concat(levels, array(
            transform(
                sequence(0, (size(element_at(levels, -1)) - 1) DIV 2),
                i -> sha2(concat(
                    element_at(levels, -1)[2 * i],
                    coalesce(get(element_at(levels, -1), 2 * i + 1), '')), 256))))
        ELSE levels END)
"""

# The siblings met on the way up from ``node`` inside its block: what stands left of the path and
# what right of it at each level, the other being empty, or both where a node is alone.
PATH = """
    CASE WHEN size(levels) = 1 THEN array() ELSE
        transform(sequence(0, size(levels) - 2), j -> struct(
            CASE WHEN shiftright(node.slot, j) % 2 = 1
                 THEN levels[j][shiftright(node.slot, j) - 1] ELSE '' END AS left,
            CASE WHEN shiftright(node.slot, j) % 2 = 0
                 THEN coalesce(get(levels[j], shiftright(node.slot, j) + 1), '') ELSE '' END
                AS right))
    END
"""


def copied(path: Column, leaf: Column) -> Column:
    """The nodes of a version: ``leaf`` and its ancestors along ``path``, the last one on top."""
    up = lambda nodes, at: F.concat(
        nodes,
        F.array(F.sha2(F.concat(at["left"], F.element_at(nodes, -1), at["right"]), 256)),
    )
    return F.aggregate(path, F.array(leaf), up)


class _Tiers:
    """Trees built block by block, tier by tier, up to one node for each tree."""

    def __init__(self, nodes: DataFrame, most: int, name: str, bits: int):
        """most: no tree has more nodes than this."""
        self.blocks = []
        self.bits = bits
        while True:
            tier = _blocks(nodes, f"{name}_{len(self.blocks)}", bits)
            tier = tier.withColumn("bits", F.lit(bits)).withColumn("levels", F.expr(LEVELS))
            self.blocks.append(tier)
            nodes = tier.select(
                "tree",
                F.shiftright(F.col("n") + (2**bits - 1), bits).alias("n"),
                F.col("block").alias("pos"),
                F.element_at("levels", -1)[0].alias("digest"),
            )
            if most <= 2**bits:
                break
            most = (most + 2**bits - 1) >> bits
        self.roots = nodes.select("tree", "digest")

    def down(self, tier: int, above: DataFrame) -> DataFrame:
        """The nodes of a tier with ``near``, their path inside their block, and ``far``, that
        above it. ``above`` has ``tree, pos, path`` of the tier's blocks, and more."""
        more = [c for c in above.columns if c not in ("tree", "pos", "path")]
        joined = self.blocks[tier].join(above.withColumnRenamed("pos", "block"), ["tree", "block"])
        parts = F.expr(f"transform(nodes, node -> struct(node, {PATH} AS near))")
        return joined.select(
            "tree", "block", F.col("path").alias("far"), *more, F.explode(parts).alias("at")
        ).select(
            "tree", "far", *more, "at.node.*", "at.near",
            (F.shiftleft("block", self.bits) + F.col("at.node.slot")).alias("pos"),
        ).drop("slot")

    def paths(self, above: DataFrame, to: int) -> DataFrame:
        """``above`` (of the top tier's blocks) carried down to the nodes of tier ``to``."""
        columns = above.columns
        for tier in range(len(self.blocks) - 1, to - 1, -1):
            nodes = self.down(tier, above).withColumn("path", F.concat("near", "far"))
            above = nodes.select(*columns)
        return above if to >= len(self.blocks) else nodes


def manifest(
    docs: DataFrame, changes: dict[str, Column], changed: Column, bits: int = BITS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, leaf, new_leaf, subroot, root``, the siblings on the
    way to the root of all (``path``), and ``version``: the nodes on that way after the change
    (from the leaf up), which are those of the original tree where nothing was changed.
    """
    leaves = written(leaves_of(docs, changes, changed), "merkle_leaves")
    placed = numbered(leaves, ("doc_id", "leaf"), "merkle_order").withColumnRenamed("leaf", "digest")
    trees = _Tiers(placed, leaves.count(), "merkle_tier", bits)
    roots = written(trees.roots, "merkle_subroots")
    # The tree over all: a leaf for each language.
    named = roots.withColumnsRenamed({"tree": "of", "digest": "subroot"})
    top = numbered(named.withColumn("tree", F.lit("")), ("of",), "merkle_languages")
    over = _Tiers(
        top.select("tree", "n", "pos", F.col("subroot").alias("digest"), "of"),
        roots.count(), "merkle_top", bits,
    )
    empty = F.expr("CAST(array() AS ARRAY<STRUCT<left: STRING, right: STRING>>)")
    start = over.roots.select(
        "tree", F.lit(0).cast("bigint").alias("pos"), empty.alias("path"),
        F.col("digest").alias("root"),
    )
    whole = over.paths(start, 0).select(
        F.col("of").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "path", "root",
        F.col("digest").alias("subroot"),
    )
    blocks = trees.paths(written(whole, "merkle_whole"), 1).select(
        "tree", "pos", "path", "root", "subroot"
    )
    found = trees.down(0, written(blocks, "merkle_paths"))
    near = copied(F.col("near"), F.coalesce("new_leaf", "digest"))
    stepped = found.withColumn("inside", near)
    beyond = F.slice(copied(F.col("far"), F.element_at("inside", -1)), 2, 2**30)
    return stepped.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "new_leaf",
        "subroot",
        "root",
        F.concat("near", "far").alias("path"),
        F.concat("inside", beyond).alias("version"),
    )
