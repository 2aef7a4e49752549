"""Merkle manifest of a dataset: ternary trees of SHA-256 digests, and each row's proof climbed by a recursive query.

Every row is a leaf. The leaves of a group (``source``) form a tree; the trees' roots form the top tree. Built levels are
stored as node rows that name their parent and hold the digests of the siblings before and after them. A recursive query
then ascends from every leaf: a step joins the node row, appends its siblings to the proof and folds the digest the leaf
has now. A row is verified when the fold ends in the stored root.

Scale: texts are read once and become digests at once. Positions inside a group come from one range partitioning and the
counts of its partitions, so a group that holds a third of all rows is spread over many tasks. A level is one aggregation
of at most ``FANOUT`` rows a key and has a third of the rows below it; the driver counts levels, never nodes. Each step of
the recursion deals its rows out anew, so it climbs ``2 ** DOUBLINGS`` levels and its digests and proofs are bytes. The climb has two recursions: the lower joins the levels of many nodes by shuffle, while proofs are short; the
upper broadcasts the levels that together have at most ``BROADCAST_NODES`` nodes, a bound checked on their count.

Defined results: a null field enters the leaf as ``-``; null groups are one group, the first; within a group null ids
come first, and rows of one id are ordered by their leaf digest; repeated rows are leaves of their own; an empty table
gives no row; a group of one row has the leaf as its root, and one group only has its root as the dataset's. Other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import save

FANOUT = 3
BROADCAST_NODES = 1 << 12  # nodes of the upper climb
ROWS_A_TASK = 20_000
BROADCAST_ROWS = 1 << 16  # rows of another side whose count is checked
DOUBLINGS = 3  # a step of the recursion climbs 2 ** DOUBLINGS levels: its rows are dealt out anew, with their proofs so far
LEVEL_BITS = 48
LEVEL = 1 << LEVEL_BITS  # a node's number in its tree: level * LEVEL + position; numbers grow towards the root
TOP, TOP_LEVEL = 0, 64  # the tree over the groups' roots and its lowest level; groups' trees count from 1
ROW_BITS = (1 << 33) - 1


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of the fields, each as its UTF-8 byte count, ``:`` and its value, or ``-`` for null."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return digest(F.concat(*parts))


def _side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table as a broadcast side while it has at most ``rows`` rows; otherwise joined by shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def numbered(rows: DataFrame, group: Column, order: Sequence[Column]) -> DataFrame:
    """``rows`` with ``position`` (from 0) and ``group_rows`` inside each group (nulls are one group), without a window over
    a group: sorted ranges, plus the counts of the ranges before."""
    spread = F.monotonically_increasing_id()  # equal rows may be cut between two ranges
    keyed = rows.withColumn("_group", group).withColumn("_spread", spread)
    keys = [F.col("_group").asc_nulls_first(), *order, F.col("_spread")]
    ranged = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_spread")
    at = F.monotonically_increasing_id()  # range number and row number, in the order of the sort
    ranged = save(ranged.withColumn("_at", at), "numbered")
    found = ranged.groupBy("_group", F.shiftright("_at", 33).alias("_range")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col("_at").bitwiseAND(F.lit(ROW_BITS))).alias("first")
    )
    own = Window.partitionBy("_group")  # one row a range of the group
    before = F.coalesce(F.sum("n").over(own.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = found.select(
        F.col("_group").alias("_g"), F.col("_range").alias("_r"), (before - F.col("first")).alias("_shift"), F.sum("n").over(own).alias("_rows")
    )
    found = _side(save(found, "ranges"))
    on = F.col("_group").eqNullSafe(F.col("_g")) & (F.shiftright("_at", 33) == F.col("_r"))
    position = (F.col("_at").bitwiseAND(F.lit(ROW_BITS)) + F.col("_shift")).alias("position")
    return ranged.join(found, on).select(*[c for c in ranged.columns if c not in ("_group", "_at")], position, F.col("_rows").alias("group_rows"))


def _few(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of about ``rows`` rows in no more tasks than they need: upper levels are small, and there are many."""
    return df.coalesce(rows // ROWS_A_TASK + 1)


def _level_above(children: DataFrame, rows: int, carried: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """One level's nodes (of trees with more than one at that level; ``rows`` in all) as linked node rows, and the level
    above them."""
    runs = children.groupBy("tree", "n", F.floor((F.col("node") % LEVEL) / FANOUT).cast("long").alias("run")).agg(
        F.array_sort(F.collect_list(F.struct("node", "digest", *carried))).alias("own")  # at most FANOUT rows
    )
    digests = F.transform("own", lambda c: c["digest"])
    parent = F.shiftleft(F.shiftright(F.col("own")[0]["node"], LEVEL_BITS) + 1, LEVEL_BITS) + F.col("run")
    n = F.ceil(F.col("n") / FANOUT).cast("long").alias("n")
    runs = runs.select("tree", n, parent.alias("parent"), "own", digest(_text(digests)).alias("up"))
    runs = save(_few(runs, rows), "merkle-runs")
    linked = runs.select("tree", "parent", digests.alias("all"), F.posexplode("own").alias("slot", "child")).select(
        "tree", "child.node", "child.digest", F.col("tree").alias("parent_tree"), "parent",
        F.unhex(_text(F.slice("all", F.lit(1), F.col("slot")))).alias("before"),
        F.unhex(_text(F.slice("all", F.col("slot") + 2, F.lit(FANOUT)))).alias("after"), *[f"child.{c}" for c in carried],
    )
    return linked, runs.select("tree", F.col("parent").alias("node"), F.col("up").alias("digest"), "n")


def _text(parts: Column) -> Column:
    return F.array_join(parts, "")


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _levels(children: DataFrame, most: int, rows: int, carried: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """The linked nodes of every level above and with ``children`` (``rows``, at most ``most`` a tree), and the trees' roots."""
    levels, roots = [], [children.filter("n = 1").drop("n")]
    while most > 1:
        linked, children = _level_above(children.filter("n > 1"), rows, carried)
        levels.append(linked)
        roots.append(children.filter("n = 1").drop("n"))
        most, rows, carried = -(-most // FANOUT), -(-rows // FANOUT), ()
    return levels, _union(roots)


@dataclass
class Manifest:
    """Written tables: ``leaves`` and ``nodes``, each row with its parent's number and its siblings' digests before and
    after it (nulls at the root), and the groups' ``subroots``; ``root`` is the root's ``tree``, ``node`` and ``digest``,
    None without rows."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: Row | None


def build(rows: DataFrame, group: str, order: Sequence[Column], leaf: str, carried: Sequence[str] = ()) -> Manifest:
    """The manifest of ``rows``: a tree of the ``leaf`` digests for each ``group``, and the top tree over the groups in
    ascending order. ``carried`` columns stay with the leaves."""
    rows = numbered(rows, F.col(group), [*order, F.col(leaf)])
    groups = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    groups = save(numbered(groups, F.lit(0), [F.col(group).asc_nulls_first()]).withColumn("tree", F.col("position") + 1), "merkle-groups")
    size = groups.agg(F.count(F.lit(1)).alias("groups"), F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    known = _side(groups.select(F.col(group).alias("_g"), "tree"))
    children = rows.join(known, F.col(group).eqNullSafe(F.col("_g"))).select(
        "tree", F.col("position").alias("node"), F.col(leaf).alias("digest"), F.col("group_rows").alias("n"), *carried
    )
    lower, subroots = _levels(save(children, "merkle-leaves"), size["most"] or 0, size["rows"] or 0, carried)
    subroots = save(_few(subroots, size["groups"]), "merkle-subroots")
    tops = subroots.select(
        F.lit(TOP).alias("tree"), (F.lit(TOP_LEVEL) * LEVEL + F.col("tree") - 1).alias("node"), "digest",
        F.lit(size["groups"]).cast("long").alias("n"),
    )
    upper, root = _levels(tops, size["groups"], size["groups"])
    # a group's root takes its parent and siblings from its place in the top tree
    up = ["parent_tree", "parent", "before", "after"]
    if upper:
        place = (F.col("node") - F.lit(TOP_LEVEL) * LEVEL + 1).alias("tree")
        joints = subroots.join(_side(save(_few(upper[0].select(place, *up), size["groups"]), "merkle-places")), "tree")
    else:
        joints = subroots.select("*", *[F.lit(None).cast(t).alias(c) for c, t in zip(up, ("long", "long", "binary", "binary"))])
    joints = save(_few(joints, size["groups"]), "merkle-joints")
    leaves = _union([joints.filter(F.col("node") < LEVEL), *lower[:1]])  # the root of a group of one row is its leaf
    nodes = _union([x.select("tree", "node", *up) for x in (joints.filter(F.col("node") >= LEVEL), *lower[1:], *upper[1:])])
    leaves, nodes = _few(leaves, size["rows"] or 0), _few(nodes, size["rows"] or 0)
    return Manifest(save(leaves, "merkle-leaves-linked"), save(nodes, "merkle-nodes"), subroots, (root if upper else subroots).first())


def _strides(nodes: DataFrame) -> DataFrame:
    """``tree, node`` and the next ``2 ** DOUBLINGS`` steps up from it (fewer at the root): the ``path`` of siblings and
    where it ends, found by joining paths to the paths that go on where they end."""
    out = nodes.select(
        "tree", "node", F.col("parent_tree").alias("to_tree"), F.col("parent").alias("to_node"),
        F.array(F.struct("before", "after")).alias("path"),
    )
    rows = nodes.count()
    for _ in range(DOUBLINGS):
        on = (F.col("a.to_tree") == F.col("b.tree")) & (F.col("a.to_node") == F.col("b.node"))
        path = F.when(F.col("b.node").isNull(), F.col("a.path")).otherwise(F.concat("a.path", "b.path"))
        ends = [F.coalesce(f"b.{c}", f"a.{c}").alias(c) for c in ("to_tree", "to_node")]
        out = out.alias("a").join(out.alias("b"), on, "left").select("a.tree", "a.node", *ends, path.alias("path"))
        out = save(_few(out, rows), "merkle-strides")
    return out


def _ascend(start: DataFrame, strides: DataFrame, ended: str, hint: str = "") -> DataFrame:
    """Climbs from ``start``'s nodes, whose digest is ``folded`` by now, up the ``strides``; the rows that have ``ended``."""
    spark = start.sparkSession
    carried = [c for c in start.columns if c not in ("tree", "node", "folded", "proof")]
    views = [f"merkle_{uuid.uuid4().hex}" for _ in range(2)]
    for view, df in zip(views, (start, strides)):
        df.createOrReplaceTempView(view)
    # every leaf climbs to the root: no limit on the recursion's rows
    fold = "unhex(sha2(CAST(lower(concat(hex(s.before), hex(f), hex(s.after))) AS BINARY), 256))"
    try:
        return spark.sql(
            f"""
            WITH RECURSIVE climb({', '.join(carried)}, tree, node, folded, proof) AS (
              SELECT {', '.join(carried)}, tree, node, folded, proof FROM {views[0]}
              UNION ALL
              SELECT {hint} {', '.join('c.' + x for x in carried)}, n.to_tree, n.to_node,
                     aggregate(n.path, c.folded, (f, s) -> {fold}),
                     concat(c.proof, unhex(array_join(transform(n.path, s -> concat(hex(s.before), hex(s.after))), '')))
              FROM climb c JOIN {views[1]} n ON n.tree = c.tree AND n.node = c.node)
            SELECT * FROM (SELECT * FROM climb LIMIT ALL) WHERE {ended}"""
        )
    finally:
        for view in views:
            spark.catalog.dropTempView(view)


def _cut(nodes: DataFrame) -> int:
    """The lowest node number from which on there are at most ``BROADCAST_NODES`` nodes."""
    level = F.shiftright("node", LEVEL_BITS).alias("level")
    sizes = nodes.groupBy(level).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect()  # some dozens
    cut, total = (sizes[0]["level"] + 1 if sizes else 1), 0
    for size in sizes:
        total += size["n"]
        if total > BROADCAST_NODES:
            break
        cut = size["level"]
    return cut * LEVEL


def prove(manifest: Manifest, now: str, carried: Sequence[str]) -> DataFrame:
    """``carried`` columns, ``leaf``, ``subroot``, ``root``, ``proof`` (sibling digests up to the root), ``folded_root``
    of the digest in column ``now`` and whether it is ``verified``."""
    lone = F.col("parent").isNull()  # the dataset is one row
    fold = digest(F.lower(F.concat(F.hex("before"), F.hex(F.unhex(F.col(now))), F.hex("after"))))
    start = manifest.leaves.select(
        *carried, F.unhex("digest").alias("leaf"), F.col("tree").alias("own_tree"),
        F.coalesce("parent_tree", "tree").alias("tree"), F.coalesce("parent", "node").alias("node"),
        F.unhex(F.when(lone, F.col(now)).otherwise(fold)).alias("folded"),
        F.when(lone, F.lit(b"")).otherwise(F.concat("before", "after")).alias("proof"),
    )
    strides = _strides(manifest.nodes.filter(F.col("parent").isNotNull()))
    cut = _cut(manifest.nodes)
    if cut > LEVEL:
        start = save(_ascend(start, strides.filter(F.col("node") < cut), f"node >= {cut}"), "merkle-climbed")
    at_root = f"tree = {manifest.root['tree']} AND node = {manifest.root['node']}"
    # the count of the nodes from ``cut`` on is checked
    climbed = _ascend(start, strides.filter(F.col("node") >= cut), at_root, "/*+ BROADCAST(n) */")
    subroots = _side(manifest.subroots.select(F.col("tree").alias("own_tree"), F.col("digest").alias("subroot")))
    root = F.lit(manifest.root["digest"])
    folded = F.lower(F.hex("folded"))
    return climbed.join(subroots, "own_tree").select(
        *carried, F.lower(F.hex("leaf")).alias("leaf"), "subroot", root.alias("root"), F.lower(F.hex("proof")).alias("proof"),
        folded.alias("folded_root"), (folded == root).alias("verified"),
    )


def verify_tampered(docs: DataFrame, tampered: Column, altered_text: Column) -> DataFrame:
    """Manifest of ``docs`` and the proof of every row, where the rows with ``tampered`` have ``altered_text`` by now."""
    fields = ["doc_id", "source", "lang", "n_chars"]
    rows = docs.select(
        F.col("doc_id").cast("long"), *[F.col(c).cast("string") for c in ("source", "lang")], F.col("n_chars").cast("long"),
        F.col("text").cast("string"),
    )
    whole = [F.col(c) for c in fields]
    leaf = leaf_digest([*whole, F.col("text")])
    now = F.when(tampered & (altered_text != F.col("text")), leaf_digest([*whole, altered_text]))  # else null: as stored
    rows = save(rows.select("doc_id", "source", leaf.alias("digest"), now.alias("altered")), "merkle-digests")
    rows = rows.select("doc_id", "source", F.col("digest").alias("leaf"), F.coalesce("altered", "digest").alias("now"))
    manifest = build(rows, "source", [F.col("doc_id").asc_nulls_first()], "leaf", ["doc_id", "now"])
    if manifest.root is None:
        text = [F.lit(None).cast("string").alias(c) for c in ("leaf", "subroot", "root", "proof", "folded_root")]
        return rows.limit(0).select("doc_id", *text, F.lit(None).cast("boolean").alias("verified"))
    return prove(manifest, "now", ["doc_id"])
