"""A Merkle manifest of a table: digests of rows, their trees and the proofs of every row.

Nodes are labelled by nested intervals: a node carries the leaf ranks ``[lo, hi)``
that it covers. Ancestors are found by containment of these intervals, joined on
the level and the bucket ``lo >> level`` of a level's equally wide intervals, and
siblings by the difference between a parent's interval and a child's.

A digest ``H`` is a lower-case hex SHA-256 of concatenated text. A leaf is H of its
row's fields, each ``-`` if null and otherwise its UTF-8 byte count, ``:`` and the
value. Per tree the leaves ascend by their order columns; every two consecutive
nodes, or a last one alone, become one node, until one remains. The trees' roots,
ordered by the tree's name (null first, then bytewise), form the tree above them.

Rows whose order columns tie are ordered by their leaf; rows that are equal in all
fields have equal leaves, and which of their places each takes is fixed once per
run. Null names of trees and null order columns come first. Empty and long texts
are hashed whole. An empty table gives no rows. Other columns are not read, so
their names do not matter.

Nothing is ordered or gathered per tree: ranks come from one range partitioning of
all leaves, digests from blocks of 2^10 nodes and paths from bands of six levels,
so a tree that holds all rows is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import written

#: Levels whose digests are made from one block of nodes, and levels of a path that are joined in one go.
BLOCK_LEVELS = 10
BAND_LEVELS = 6
#: Name of the tree over all trees' roots; names of others start with a blank or are empty for null.
TOP = "-"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("", *parts), 256)


def field(value: Column) -> Column:
    """A value with its length, so that no two rows concatenate alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``rank`` (from 0) and ``leaves`` (their number) within ``tree``, by the order columns.

    The rows are range-partitioned and written with their place in their partition;
    a rank is that place plus the rows of the tree in earlier partitions, of which
    there is one number per tree and partition.
    """
    placed = leaves.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = placed.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    placed = written(placed, "merkle-ranks")
    runs = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    by_part = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(by_part), F.lit(0))
    total = F.sum("rows").over(Window.partitionBy("tree"))
    runs = runs.select("tree", "part", (before - F.col("first")).alias("shift"), total.alias("leaves"))
    rows = placed.join(runs, ["tree", "part"])
    return rows.withColumn("rank", F.col("place") + F.col("shift")).drop("part", "place", "shift", *order)


def _height(leaves: Column) -> Column:
    """Levels above the leaves: the number of halvings, rounded up, until one node remains."""
    return F.when(leaves > 1, F.length(F.bin(leaves - 1))).otherwise(0)


def _next_level(digests: Column) -> Column:
    pairs = F.sequence(F.lit(0), F.ceil(F.size(digests) / 2).cast("int") - 1)
    return F.transform(pairs, lambda i: digest(F.get(digests, 2 * i), F.get(digests, 2 * i + 1)))


def tree_nodes(leaves: DataFrame) -> DataFrame:
    """All nodes (tree, level, lo, hi, height, digest) over leaves (tree, rank, leaves, digest).

    Each round takes the nodes of one level in blocks of 2^BLOCK_LEVELS and adds the levels up to the block's root.
    """
    height = _height(F.col("leaves"))
    base = leaves.select("tree", "leaves", height.alias("height"), F.col("rank").alias("number"), "digest")
    highest = base.agg(F.max("height")).first()[0] or 0
    rounds, level = [], 0
    while True:
        block = F.shiftright("number", BLOCK_LEVELS)
        blocks = base.groupBy("tree", "leaves", "height", block.alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("number", "digest"))).alias("members")
        )
        steps = F.least(F.lit(BLOCK_LEVELS), F.col("height") - level)
        levels = F.aggregate(
            F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")),
            F.array(F.col("members.digest")),
            lambda made, _: F.concat(made, F.array(_next_level(F.element_at(made, -1)))),
        )
        nodes = blocks.select("tree", "leaves", "height", "block", F.posexplode(levels).alias("up", "digests"))
        nodes = nodes.select("tree", "leaves", "height", "block", "up", F.posexplode("digests").alias("within", "digest"))
        # the root of a full block is the next round's leaf
        nodes = nodes.filter((F.col("up") < BLOCK_LEVELS) | (F.lit(level) + F.col("up") == F.col("height")))
        number = F.expr(f"shiftleft(block, {BLOCK_LEVELS} - up)") + F.col("within")
        nodes = nodes.select("tree", "leaves", "height", (F.lit(level) + F.col("up")).alias("level"), number.alias("number"), "digest")
        rounds.append(written(nodes, "merkle-nodes"))
        level += BLOCK_LEVELS
        if level >= highest:
            break
        # one more level on top of the last that was kept
        last = rounds[-1].filter((F.col("level") == level - 1) & (F.col("height") > level))
        pairs = last.groupBy("tree", "leaves", "height", F.shiftright("number", 1).alias("number")).agg(
            F.sort_array(F.collect_list(F.struct("number", "digest"))).alias("pair")
        )
        base = pairs.select("tree", "leaves", "height", "number", F.sha2(F.array_join("pair.digest", ""), 256).alias("digest"))
    nodes = rounds[0]
    for more in rounds[1:]:
        nodes = nodes.unionByName(more)
    lo = F.expr("shiftleft(number, level)")
    hi = F.least(F.expr("shiftleft(number + 1, level)"), F.col("leaves"))
    return nodes.select("tree", "level", lo.alias("lo"), hi.alias("hi"), "height", "digest")


def siblings(nodes: DataFrame) -> DataFrame:
    """Every node below a root with the digests that fill its parent's interval to its left and to its right.

    A parent's interval less the node's own leaves ``[parent.lo, lo)`` and ``[hi, parent.hi)``;
    the children inside these are its siblings. Digests are bytes here.
    """
    below = nodes.filter("level < height").withColumn("digest", F.unhex("digest"))
    family = Window.partitionBy("tree", "level", F.expr("shiftright(lo, level + 1)"))
    children = below.withColumn("children", F.collect_list(F.struct("lo", "hi", "digest")).over(family))

    def filling(inside) -> Column:
        found = F.filter("children", inside)
        return F.when(F.size(found) > 0, found[0]["digest"])

    left = filling(lambda c: c["hi"] <= F.col("lo"))
    right = filling(lambda c: c["lo"] >= F.col("hi"))
    return children.select("tree", "level", "lo", "hi", left.alias("left"), right.alias("right"))


def paths(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Each leaf's siblings from the leaf up, over the path that its root has.

    ``roots`` holds per tree the path above its root and what else belongs to it.
    Returns tree, rank, path and the other columns of ``roots``. The leaves, and the
    nodes at every BAND_LEVELS-th level, are joined to the nodes that contain them within
    their band; bands are then put together from the top, where there are few nodes.
    """
    anchor = (F.col("level") % BAND_LEVELS == 0) & ((F.col("level") < F.col("height")) | (F.col("level") == 0))
    top = F.least(F.col("level") + BAND_LEVELS, "height")
    anchors = nodes.filter(anchor).select("tree", "level", "lo", "hi", "height", top.alias("top"))
    climbing = anchors.filter("level < height")
    climbing = climbing.select(
        "tree", F.col("level").alias("base"), F.col("lo").alias("from_lo"), F.col("hi").alias("from_hi"),
        F.explode(F.sequence("level", F.col("top") - 1)).alias("level"),
    )
    climbing = climbing.withColumn("bucket", F.expr("shiftright(from_lo, level)"))
    around = siblings(nodes).withColumn("bucket", F.expr("shiftright(lo, level)"))
    met = climbing.join(around, ["tree", "level", "bucket"]).filter("lo <= from_lo and from_hi <= hi")
    steps = met.groupBy("tree", F.col("base").alias("level"), F.col("from_lo").alias("lo")).agg(
        F.sort_array(F.collect_list(F.struct("level", "left", "right"))).alias("steps")
    )
    steps = written(anchors.join(steps, ["tree", "level", "lo"], "left"), "merkle-paths")
    highest = steps.agg(F.max("level")).first()[0]
    extra = [c for c in roots.columns if c not in ("tree", "path")]
    ends = roots.select("tree", F.lit(True).alias("is_root"), F.lit(0).cast("long").alias("number"), "path", *extra)
    upper = None
    for level in range(highest or 0, -1, -BAND_LEVELS):
        number = F.expr("shiftright(lo, top)")
        here = steps.filter(F.col("level") == level).select(
            "tree", "lo", "steps", (F.col("top") == F.col("height")).alias("is_root"), number.alias("number")
        )
        above = ends if upper is None else ends.unionByName(upper)
        joined = here.join(above, ["tree", "is_root", "number"])
        own = F.coalesce(F.transform("steps", lambda s: F.struct(s["left"].alias("left"), s["right"].alias("right"))), F.array())
        path = F.concat(own.cast("array<struct<left:binary,right:binary>>"), "path")
        if level == 0:
            return joined.select("tree", F.col("lo").alias("rank"), path.alias("path"), *extra)
        upper = joined.select(
            "tree", F.lit(False).alias("is_root"), F.expr(f"shiftright(lo, {level})").alias("number"), path.alias("path"), *extra
        )
    raise AssertionError("the last band starts at the leaves")


def _lower_hex(data: Column) -> Column:
    return F.lower(F.hex(data))


def manifest(
    docs: DataFrame, fields: list[str], tree: str, order: str, tampered: dict[str, Column], where: Column
) -> DataFrame:
    """One row per row of ``docs``: its leaf, its tree's root, the root of all, its path and what a changed row folds to.

    ``tampered`` replaces fields in the rows that ``where`` holds for (a null counts as
    no). Columns: the order column, leaf, subroot, root, path (siblings from the leaf
    up, left and right of it, as bytes), folded_root and verified.
    """
    leaf = digest(*[field(F.col(c)) for c in fields])
    changed = digest(*[field(tampered.get(c, F.col(c))) for c in fields])
    name = F.coalesce(F.concat(F.lit(" "), F.col(tree).cast("string")), F.lit(""))
    leaves = docs.select(
        name.alias("tree"), F.col(order).alias("key"), leaf.alias("digest"),
        F.when(where, changed).alias("changed"), F.monotonically_increasing_id().alias("copy"),
    )
    leaves = written(leaves, "merkle-leaves")
    leaves = leaves.withColumn("by_key", F.col("key")).withColumn("by_digest", F.col("digest"))
    leaves = written(ranked(leaves, ["by_key", "by_digest", "copy"]), "merkle-ranked")
    nodes = tree_nodes(leaves)
    subroots = nodes.filter("level = height").select(F.lit(TOP).alias("tree"), "digest", F.col("tree").alias("of"))
    subroots = written(ranked(subroots.withColumn("by_of", F.col("of")), ["by_of"]), "merkle-subroots")
    top_nodes = tree_nodes(subroots)
    empty = F.array().cast("array<struct<left:binary,right:binary>>")
    root = top_nodes.filter("level = height").select("tree", empty.alias("path"), F.col("digest").alias("root"))
    tops = paths(top_nodes, root).join(subroots, ["tree", "rank"])
    tops = tops.select(F.col("of").alias("tree"), "path", "root", F.col("digest").alias("subroot"))
    rows = leaves.join(paths(nodes, written(tops, "merkle-tops")), ["tree", "rank"])
    folded = F.aggregate(
        "path", F.coalesce("changed", "digest"),
        lambda node, s: digest(_lower_hex(s["left"]), node, _lower_hex(s["right"])),
    )
    rows = rows.select(
        F.col("key").alias(order), F.col("digest").alias("leaf"), "subroot", "root", "path", folded.alias("folded_root")
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def proof(path: Column) -> Column:
    """H of all siblings of a path, from the leaf up and left to right."""
    beside = F.transform(path, lambda s: F.concat_ws("", _lower_hex(s["left"]), _lower_hex(s["right"])))
    return F.sha2(F.array_join(beside, ""), 256)


def tamper_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of documents in which every seventh id has one character more than stated."""
    digits = F.col("doc_id").cast("string")
    rows = manifest(
        docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id",
        {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}, F.crc32(digits) % 7 == 0,
    )
    return rows.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), "folded_root", "verified")
