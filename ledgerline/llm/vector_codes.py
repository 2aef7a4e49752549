"""Product quantisation of vectors by Lloyd rounds over cover trees.

Vectors become integers and are cut into ``PARTS`` parts; every part position has a codebook. Each block of rows holds a
cover tree a part position: nested nets of halving radius, where a node knows its centre, the distance of its farthest
point, and the count and sum of its points. A round walks the trees from the top: entries that the triangle inequality
rules out for a whole subtree are dropped, a subtree with one entry left is assigned at once by its count and sum, and
only nodes between two entries descend, at the leaves to exact integer comparisons of single points.

Scale: blocks are cut from each task's own rows (``BLOCK_ROWS`` at most), the trees are built once and written, and every
round is one pass over them without a shuffle of vectors: a task sends at most ``PARTS * ENTRIES`` partial sums a
dimension, added up in Spark; the driver gets the ``PARTS * ENTRIES`` new entries. All arithmetic that decides is on integers.

Defined results: rows whose vector is null or holds null or non-finite components take no part; components beyond
``LIMIT`` become it; vectors of other lengths than the longest are filled up with zeros, as is the longest to a multiple
of ``PARTS``; null ids come last, and rows of one id are ordered by their vectors, so that repeated rows may give equal
entries, of which the first is used; fewer than ``ENTRIES`` rows give fewer entries; an entry without points stays; empty
vectors have code 0 and error 0; an empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import save

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LIMIT = 1 << 24  # a component's size after scaling; sums of its squares stay exact
BLOCK_ROWS = 4096
LEAF = 8  # points that are compared one by one
LABELS_BROADCAST = 1_000_000


@dataclass
class CoverTree:
    """Nodes in breadth-first order. ``order`` lists the points so that a node's are ``start`` to ``stop``; ``child`` is
    its first child's number, of ``children`` (0: a leaf). ``reach`` is the distance of its farthest point, rounded up."""

    centre: np.ndarray
    reach: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    child: np.ndarray
    children: np.ndarray
    order: np.ndarray
    sums: np.ndarray  # of the points' vectors, by node


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` and ``b``."""
    difference = a[:, None, :] - b[None, :, :]
    return np.einsum("ijk,ijk->ij", difference, difference)


def _net(points: np.ndarray, radius: float) -> list[np.ndarray]:
    """Groups of points within ``radius`` of their centre, which comes first; centres are farther than that apart."""
    left, groups = np.arange(len(points)), []
    while len(left):
        own = squared(points[left], points[left[:1]])[:, 0]
        near = own <= radius * radius
        near[0] = True
        groups.append(left[near])
        left = left[~near]
    return groups


def cover_tree(points: np.ndarray) -> CoverTree:
    """A cover tree of integer points: children are a net of half their parent's radius around its first point."""
    nodes: list[list] = []  # centre, reach, start, stop, first child, children
    order = np.arange(len(points))
    level = [(0, len(points))] if len(points) else []
    while level:
        below, first = [], len(nodes) + len(level)
        for start, stop in level:
            own = order[start:stop]
            far = int(squared(points[own], points[own[:1]])[:, 0].max())
            node = [own[0], np.nextafter(np.sqrt(far) * (1 + 1e-12), np.inf) if far else 0.0, start, stop, 0, 0]
            if far and stop - start > LEAF:
                groups = _net(points[own], 2.0 ** np.floor(np.log2(np.sqrt(far)) - 1e-9))
                node[4], node[5] = first + len(below), len(groups)
                order[start:stop] = own[np.concatenate(groups)]
                for group in groups:
                    below.append((start, start + len(group)))
                    start += len(group)
            nodes.append(node)
        level = below
    columns = list(zip(*nodes)) if nodes else [()] * 6
    centre, start, stop, child, children = (np.array(columns[k], np.int64) for k in (0, 2, 3, 4, 5))
    running = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points[order], axis=0)])
    return CoverTree(centre, np.array(columns[1], float), start, stop, child, children, order, running[stop] - running[start])


def assign(tree: CoverTree, points: np.ndarray, book: np.ndarray, codes: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Count and sum of the points nearest to each entry of ``book`` (ties to the lower index); with ``codes``, also each
    point's entry; and the number of exact comparisons of points."""
    count, total = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)
    compared = 0
    nodes = np.zeros(min(1, len(tree.centre)), np.int64)
    open_entries = np.ones((len(nodes), len(book)), bool)
    while len(nodes):
        own = np.sqrt(squared(points[tree.centre[nodes]], book).astype(float))
        own[~open_entries] = np.inf
        # an entry is out if each point of the subtree is nearer to the best one, with room for rounding
        room = 2 * tree.reach[nodes] + 1e-9 * (1 + own.min(axis=1))
        open_entries = own <= (own.min(axis=1) + room)[:, None]
        left = open_entries.sum(axis=1)
        sure = left == 1
        best = open_entries[sure].argmax(axis=1)
        done = nodes[sure]
        np.add.at(count, best, tree.stop[done] - tree.start[done])
        np.add.at(total, best, tree.sums[done])
        if codes is not None:
            for node, entry in zip(done.tolist(), best.tolist()):
                codes[tree.order[tree.start[node] : tree.stop[node]]] = entry
        leaf = ~sure & (tree.children[nodes] == 0)
        if leaf.any():
            sizes = tree.stop[nodes[leaf]] - tree.start[nodes[leaf]]
            places = np.repeat(tree.start[nodes[leaf]] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            own = tree.order[places]
            compared += len(own)
            exact = squared(points[own], book)
            exact[~np.repeat(open_entries[leaf], sizes, axis=0)] = np.iinfo(np.int64).max
            best = exact.argmin(axis=1)
            np.add.at(count, best, 1)
            np.add.at(total, best, points[own])
            if codes is not None:
                codes[own] = best
        inner = ~sure & ~leaf
        n = tree.children[nodes[inner]]
        first = np.repeat(tree.child[nodes[inner]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) if len(n) else n
        open_entries = np.repeat(open_entries[inner], n, axis=0)
        nodes = first + np.arange(n.sum())
    return count, total, compared


def _integers(batch: pa.RecordBatch, column: int, width: int) -> np.ndarray:
    vectors = batch.column(column)
    out = np.zeros((len(vectors), width), np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(vectors.offsets.to_numpy())
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    scaled = np.floor(SCALE * flat.astype(float))
    out[np.repeat(np.arange(len(vectors)), sizes), at] = np.clip(scaled, -LIMIT, LIMIT).astype(np.int64)
    return out


def kept(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """``id, label, vector`` of the rows that take part."""
    v = F.col(vector_column).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), v.alias("vector")
    ).filter(F.col("vector").isNotNull() & ~F.coalesce(bad, F.lit(False)))


def build_blocks(rows: DataFrame, width: int) -> DataFrame:
    """``ids, labels, block``: rows of one task, their integer vectors and a cover tree a part position (pickled)."""
    size = width // PARTS

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(a, BLOCK_ROWS)
                points = _integers(part, 2, width)
                trees = [cover_tree(points[:, k * size : (k + 1) * size]) for k in range(PARTS)]
                block = pickle.dumps((points.astype(np.int32), trees), protocol=5)
                lists = [pa.array([part.column(k).to_pylist()], pa.list_(part.column(k).type)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([block], pa.binary())], names=["ids", "labels", "block"])

    label = rows.schema["label"].dataType.simpleString()
    return rows.select("id", "label", "vector").mapInArrow(run, f"ids array<long>, labels array<{label}>, block binary")


def first_entries(rows: DataFrame, width: int) -> np.ndarray:
    """The integer vectors of the first ``ENTRIES`` rows by id."""
    found = rows.select(F.col("id").isNull().alias("last"), "id", "vector").orderBy("last", "id", "vector").limit(ENTRIES)
    vectors = [r["vector"] for r in found.collect()]
    out = np.zeros((len(vectors), width), np.int64)
    for row, vector in enumerate(vectors):
        out[row, : len(vector)] = np.clip(np.floor(SCALE * np.array(vector, float)), -LIMIT, LIMIT)
    return out


def _parts(book: np.ndarray) -> list[np.ndarray]:
    size = book.shape[1] // PARTS
    return [book[:, k * size : (k + 1) * size] for k in range(PARTS)]


def lloyd_round(blocks: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebooks after one assignment of every part and the update of the entries."""

    def run(batches):
        count, total = np.zeros((PARTS, len(book)), np.int64), [np.zeros(b.shape, np.int64) for b in _parts(book)]
        for batch in batches:
            for block in batch.column(0):
                points, trees = pickle.loads(block.as_py())
                for k, (own, tree, entries) in enumerate(zip(_parts(points.astype(np.int64)), trees, _parts(book))):
                    n, s, _ = assign(tree, own, entries, None)
                    count[k] += n
                    total[k] += s
        part, entry = np.nonzero(count)
        sums = [total[k][e].tolist() for k, e in zip(part, entry)]
        columns = [pa.array(part), pa.array(entry), pa.array(count[part, entry]), pa.array(sums, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "sums"])

    partial = blocks.select("block").mapInArrow(run, "part long, entry long, n long, sums array<long>")
    found = (
        partial.select("part", "entry", "n", F.posexplode("sums").alias("at", "s"))
        .groupBy("part", "entry", "at")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        .collect()  # one number a component of the codebooks
    )
    out, size = book.copy(), book.shape[1] // PARTS
    for r in found:
        out[r["entry"], r["part"] * size + r["at"]] = r["s"] // r["n"]
    return out


def encode(blocks: DataFrame, book: np.ndarray) -> DataFrame:
    """``id, label, codes, error`` of every row by the codebooks."""

    def run(batches):
        for batch in batches:
            for ids, labels, block in zip(*batch.columns):
                points, trees = pickle.loads(block.as_py())
                points = points.astype(np.int64)
                codes = np.zeros((len(points), PARTS), np.int64)
                error = np.zeros(len(points), np.int64)
                for k, (own, tree, entries) in enumerate(zip(_parts(points), trees, _parts(book))):
                    assign(tree, own, entries, codes[:, k])
                    error += ((own - entries[codes[:, k]]) ** 2).sum(axis=1)
                listed = pa.array(codes.tolist(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, listed, pa.array(error)], names=["id", "label", "codes", "error"])

    label = blocks.schema["labels"].dataType.elementType.simpleString()
    return blocks.mapInArrow(run, f"id long, label {label}, codes array<long>, error long")


@dataclass
class Codebooks:
    entries: np.ndarray  # one row an entry, the parts one after the other

    def sha256(self) -> str:
        listed = [str(x) for part in _parts(self.entries) for x in part.ravel().tolist()]
        return hashlib.sha256(",".join(listed).encode()).hexdigest()


def compress(vectors: DataFrame, id_column: str, vector_column: str, label_column: str, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """``id, label, codes, error`` of every row that takes part, and the codebooks after ``rounds`` Lloyd rounds."""
    rows = kept(vectors, id_column, vector_column, label_column)
    longest = rows.agg(F.max(F.size("vector")).alias("n")).first()["n"] or 0
    width = -(-longest // PARTS) * PARTS
    book = first_entries(rows, width)
    blocks = save(build_blocks(rows, width), "cover-trees")
    for _ in range(rounds if len(book) and width else 0):
        book = lloyd_round(blocks, book)
    return encode(blocks, book), Codebooks(book)


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the errors summed over equal labels (nulls are equal)."""
    coded = save(coded, "vector-codes")
    sums = save(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    sums = F.broadcast(sums) if sums.count() <= LABELS_BROADCAST else sums
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def digests(coded: DataFrame, books: Codebooks, id_column: str) -> DataFrame:
    """Contract columns of ``label_errors``."""
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return coded.select(
        F.col("id").alias(id_column), code.alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
