"""N-gram Jaccard join by chosen paths.

A document's set is its distinct shingles of ``SHINGLE`` words. Equal sets form one class, and classes are joined: all
pairs of classes whose Jaccard similarity is ``THRESHOLD`` or more are links.

Each run splits the classes recursively: a node picks one of ``COORDINATES`` shared min-hashes (a sampled shared token)
and, with the chance that keeps a pair at the threshold on one path in expectation, a second; classes that
agree on it go to the same child. Nodes of at most ``SMALL`` classes are compared by brute force; those that a
split does not shrink, groups of near copies, are compared in blocks. Runs are repeated until a pair at the threshold
is met and passes the sketches' limit with chance ``RECALL`` even if all its nodes are split through all levels
(``runs_as_coded``), and pairs above it are met more often.

A bucket's pairs are first compared by sketches, whose limit lies ``SLACK`` standard errors under the threshold, and a
pair counts only in the first bucket its classes share; only classes with a candidate there have their exact sets compared.
No pair is emitted: a bucket returns each class's number of links and the class's smallest partner, from which
components are found by repeated joins on written tables.

Scale: features are fixed-size; texts are shuffled at most once, for classes with a candidate, and their sets once a block
pair. A hot bucket becomes blocks of ``BLOCK`` classes; whole block pairs are dealt to groups of about ``ROWS`` rows, and where
sets are compared to groups of about ``SET_ROWS`` rows and ``SET_BYTES``; block pairs of more bytes are cut into pairs of
parts, a group each. So no group grows with the data; a part holds one class at least.

Defined results: words are lower-cased and split at white space; a text of fewer than ``SHINGLE`` words is one shingle; null
texts and texts without words take no part and are their own class; repeated rows are copies; rows without a ``doc_id``
are copies like others, and a class of such rows alone has a null id. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Memo, pieces, save

SHINGLE = 5
THRESHOLD = 0.8
COORDINATES = 64
RECALL = 0.999
LEVELS = 5
SMALL = 256
BLOCK = 512
SHRUNK = 0.5  # a split that leaves a larger share of a node together does not shrink it
ROWS = 5000  # rows a group of sketches
SET_ROWS = 1000  # rows and bytes of sets a group
SET_BYTES = 16_000_000
SLACK = 3.5
SECOND = 1 / THRESHOLD - 1  # the share of nodes that are split by a second coordinate too
_TOKENS = Memo(lambda w: xxhash.xxh3_64_intdigest(w), 300_000)
FEATURES = "uid long, doc_id long, key binary, size int, signature array<int>, sketch binary"
_rng = np.random.default_rng(20_240_607)
_MULTIPLY = (_rng.integers(0, 1 << 32, COORDINATES, dtype=np.uint32) | 1).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, COORDINATES, dtype=np.uint32)


def missed(levels: int, similarity: float = THRESHOLD) -> float:
    """The chance that one run of so many levels separates a pair of the similarity, were each node's coordinate fresh."""
    out = 0.0
    for _ in range(levels):
        apart = 1 - similarity * (1 - out)
        out = apart * (1 - SECOND + SECOND * apart)
    return out


def runs_needed(levels: int = LEVELS, recall: float = RECALL) -> int:
    """The runs needed if they were independent; as they share their coordinates, ``runs_as_coded`` are more."""
    return math.ceil(math.log(1 - recall) / math.log(missed(levels)))


def roots(runs: int) -> list[tuple[int, int]]:
    """``run, coordinate`` of the first splits; a share of ``SECOND`` of the runs has two. All differ, as far as they can."""
    order = np.random.default_rng(7).permutation(COORDINATES)
    return [(r, int(order[i % COORDINATES])) for i, r in enumerate([*range(runs), *range(math.ceil(runs * SECOND))])]


def _binomial(n: int, p: float) -> list[float]:
    return [math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)]


def _sketch_fails(shared: int, limit: int) -> float:
    """The chance that sketches of so many equal min-hashes agree in fewer than ``limit`` bytes."""
    return sum(_binomial(COORDINATES - shared, 1 / 256)[: max(0, limit - shared)])


def sketch_limit(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Equal bytes from which sketches are candidates: ``SLACK`` standard errors under the threshold, or less where that
    would lose more than half of what ``recall`` allows to be missed."""
    limit = math.floor(COORDINATES * (threshold - SLACK * math.sqrt(threshold * (1 - threshold) / COORDINATES)))
    chances = _binomial(COORDINATES, threshold)
    while sum(c * _sketch_fails(shared, limit) for shared, c in enumerate(chances)) > (1 - recall) / 2:
        limit -= 1
    return limit


def pair_missed(runs: int, levels: int, similarity: float, limit: int) -> float:
    """The chance that a pair of the similarity is not compared in any run, as coded: all nodes draw from the same min-hashes,
    of which the pair shares some number, roots draw without repetition, and sketches have to reach ``limit``."""
    n, lost = COORDINATES, 0.0
    often, extra = divmod(len(roots(runs)), n)  # each coordinate is the root's so often, and of ``extra`` ones once more
    for shared, chance in enumerate(_binomial(n, similarity)):
        both, none = shared * (shared - 1) / (n * (n - 1)), (n - shared) * (n - shared - 1) / (n * (n - 1))
        out = 0.0
        for _ in range(levels - 1):
            one = 1 - shared / n * (1 - out)
            out = (1 - SECOND) * one + SECOND * (none + (1 - none - both) * out + both * out**2)
        apart = sum(
            math.comb(shared, k) * math.comb(n - shared, extra - k) / math.comb(n, extra) * out ** (k + often * shared)
            for k in range(max(0, extra - n + shared), min(shared, extra) + 1)
        )
        fails = _sketch_fails(shared, limit)
        lost += chance * (fails + (1 - fails) * apart)
    return lost


def runs_as_coded(levels: int = LEVELS, recall: float = RECALL, threshold: float = THRESHOLD) -> int:
    """The fewest runs that compare a pair at the threshold with chance ``recall``."""
    runs, limit = runs_needed(levels, recall), sketch_limit(threshold, recall)
    while pair_missed(runs, levels, threshold, limit) > 1 - recall:
        runs += 1
    return runs


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = text.lower().split() if text else []
    ids = np.fromiter(map(_TOKENS.__getitem__, words), np.uint64, len(words))
    n = max(1, len(ids) - SHINGLE + 1) if len(ids) else 0
    h = np.full(n, min(len(ids), SHINGLE), np.uint64)
    for k in range(min(SHINGLE, len(ids))):
        h = (h ^ ids[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return np.unique(h)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Min-hashes, a row for each (non-empty) set."""
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    low = np.concatenate(sets)
    low = (low ^ (low >> np.uint64(29))).astype(np.uint32)
    out = np.empty((len(sets), COORDINATES), np.uint32)
    for c in range(COORDINATES):
        x = low * _MULTIPLY[c] + _ADD[c]
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        out[:, c] = np.minimum.reduceat(x, starts)
    return out


def _key(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def features(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in pieces(batches, 2):
            sets = [shingles(t) for t in batch.column(2).to_pylist()]
            filled = [i for i, s in enumerate(sets) if len(s)]
            signature = [None] * len(sets)
            sketch: list[bytes | None] = [None] * len(sets)
            if filled:
                found = signatures([sets[i] for i in filled])
                for i, own in zip(filled, found):
                    signature[i] = own.view(np.int32)
                    sketch[i] = (own >> np.uint32(8)).astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1),
                    pa.array([_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(signature, pa.list_(pa.int32())), pa.array(sketch, pa.binary()),
                ],
                names=[c.split()[0] for c in FEATURES.split(", ")],
            )

    rows = docs.select(F.xxhash64("doc_id", "text").alias("uid"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, FEATURES)


def _child(bucket: Column, coordinate: Column) -> Column:
    return F.xxhash64(bucket, coordinate, F.element_at("signature", coordinate.cast("int") + 1))


def buckets(classes: DataFrame, runs: int, levels: int) -> DataFrame:
    """``key, run, bucket, n``: where each class is compared, for nodes of two classes or more."""
    root = [F.struct(F.lit(r).alias("run"), _child(F.lit(r), F.lit(c)).alias("bucket")) for r, c in roots(runs)]
    rows = classes.select("key", F.inline(F.array(*root))).withColumn("parent_n", F.lit(None).cast("long"))
    done = None
    for level in range(1, levels + 1):
        rows = save(rows, "paths")
        counts = rows.groupBy(F.col("bucket").alias("_bucket")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        stays = (F.col("n") <= SMALL) | (F.coalesce(F.col("n") > SHRUNK * F.col("parent_n"), F.lit(False)))
        met = save(
            rows.join(counts, F.col("bucket") == F.col("_bucket"))
            .withColumn("stays", stays | F.lit(level == levels))
            .select("key", "run", "bucket", "n", "stays"),
            "nodes",
        )
        own = met.filter("stays").select("key", "run", "bucket", "n")
        done = own if done is None else done.unionByName(own)
        large = met.filter(~F.col("stays"))
        if level == levels or large.isEmpty():
            return done
        first = F.pmod(F.xxhash64("bucket", F.lit(1)), F.lit(COORDINATES))
        second = F.when(
            F.pmod(F.xxhash64("bucket", F.lit(2)), F.lit(1000)) < round(1000 * SECOND),
            F.pmod(first + 1 + F.pmod(F.xxhash64("bucket", F.lit(3)), F.lit(COORDINATES - 1)), F.lit(COORDINATES)),
        )
        rows = (
            large.join(classes.select("key", "signature"), "key")
            .withColumn("coordinate", F.explode(F.array_compact(F.array(first, second))))
            .select("key", "run", _child(F.col("bucket"), F.col("coordinate")).alias("bucket"), F.col("n").alias("parent_n"))
        )
    return done


def in_blocks(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """A row for each class, node and block pair: ``bucket, a, b, block, key, size, sketch, earlier``; ``earlier``: the
    nodes that come before this one among the class's own."""
    own = nodes.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("run", "bucket", "n"))).alias("own"))
    n = F.ceil(F.col("node.n") / BLOCK)
    return (
        own.join(classes.select("key", "size", "sketch"), "key")
        .select("key", "size", "sketch", "own", F.posexplode("own").alias("place", "node"))
        .withColumn("block", F.pmod(F.xxhash64("key"), n).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))))
        .select(
            F.col("node.bucket").alias("bucket"),
            F.least("block", "other").alias("a"),
            F.greatest("block", "other").alias("b"),
            "block",
            "key",
            "size",
            "sketch",
            F.transform(F.slice("own", F.lit(1), F.col("place")), lambda x: x["bucket"]).alias("earlier"),
        )
    )


def _met_before(earlier: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each row of ``left`` and ``right``: do they share an earlier node?"""
    owner = np.repeat(np.arange(len(earlier)), [len(e) for e in earlier])
    ids = np.concatenate(earlier) if len(owner) else np.empty(0, np.int64)
    _, ids, counts = np.unique(ids, return_inverse=True, return_counts=True)
    twice = counts[ids] > 1
    ids, owner = ids[twice], owner[twice]
    _, ids = np.unique(ids, return_inverse=True)
    member = np.zeros((len(earlier), int(ids.max()) + 1 if len(ids) else 1), np.float32)
    member[owner, ids] = 1
    return member[left] @ member[right].T > 0


CANDIDATES = "bucket long, a int, b int, block int, key binary, size int, earlier array<long>"


def in_tasks(rows: DataFrame, total: int, each: int, alone: Column | None = None):
    """``rows`` (of ``bucket, a, b``) grouped so that a group holds many block pairs, about ``each`` rows: whole block
    pairs, dealt by hash; those that are ``alone`` are a group each and not among the ``total`` rows."""
    pair = F.xxhash64("bucket", "a", "b")
    group = F.pmod(pair, F.lit(max(1, math.ceil(total / each))))
    return rows.withColumn("task", group if alone is None else F.when(alone, pair).otherwise(group)).groupBy("task")


def sketch_tasks(nodes: DataFrame, classes: DataFrame):
    """The rows of ``in_blocks``, grouped; a node of n classes has n rows a block."""
    total = nodes.agg(F.sum(F.ceil(F.col("n") / BLOCK))).first()[0] or 0
    return in_tasks(in_blocks(nodes, classes), total, ROWS)


def pair_parts(near: DataFrame) -> DataFrame:
    """``bucket, a, b, n, nbytes, parts`` of the block pairs in ``near`` (of ``CANDIDATES``); ``parts``: those that each of its
    blocks is cut into, so that two parts' sets stay under ``SET_BYTES``."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("nbytes") / (SET_BYTES // 2)).cast("int")).alias("parts")
    held = near.groupBy("bucket", "a", "b").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("size").cast("long") * 8).alias("nbytes"))
    return held.select("*", parts)


def in_parts(near: DataFrame, held: DataFrame) -> DataFrame:
    """``near`` with the block pairs of several parts turned into block pairs of parts."""
    large = held.filter("parts > 1").select("bucket", "a", "b", "parts")
    on = ["bucket", "a", "b"]
    part = F.pmod(F.xxhash64("key", F.lit("part")), F.col("parts")).cast("int")
    cut = near.join(large, on).withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    inner, first = F.col("a") == F.col("b"), F.col("block") == F.col("a")
    # within a block each two parts meet once; across two blocks the second one's parts have the numbers from ``parts`` on
    left = F.when(inner, F.least("part", "other")).when(first, F.col("part")).otherwise(F.col("other"))
    right = F.when(inner, F.greatest("part", "other")).otherwise(F.col("parts") + F.when(first, F.col("other")).otherwise(F.col("part")))
    own = F.when(inner | first, F.col("part")).otherwise(F.col("parts") + F.col("part"))
    cut = cut.select(
        F.xxhash64("bucket", "a", "b").alias("bucket"), left.alias("a"), right.alias("b"), own.alias("block"), "key", "size", "earlier"
    ).withColumn("alone", F.lit(True))
    return near.join(large, on, "left_anti").withColumn("alone", F.lit(False)).select(cut.columns).unionByName(cut)


def set_tasks(near: DataFrame, sets: DataFrame):
    """The candidates of ``near`` with their ``sets`` (``key, members``), grouped by rows and bytes."""
    held, whole = pair_parts(near), F.col("parts") == 1
    most, n, nbytes = held.agg(F.max("parts"), F.sum(F.when(whole, F.col("n"))), F.sum(F.when(whole, F.col("nbytes")))).first()
    cut = (most or 1) > 1
    rows = in_parts(near, held) if cut else near
    total = max(n or 0, (nbytes or 0) * SET_ROWS // SET_BYTES)
    return in_tasks(rows.join(sets.dropDuplicates(["key"]), "key"), total, SET_ROWS, F.col("alone") if cut else None)


def _block_pairs(rows: pd.DataFrame):
    """The places of each block pair's rows: all, of its first block, and of its second."""
    pair = rows[["bucket", "a", "b"]].to_numpy()
    order = np.lexsort(pair.T)
    pair = pair[order]
    cuts = np.flatnonzero((pair[1:] != pair[:-1]).any(axis=1)) + 1
    block, firsts, seconds = (rows[c].to_numpy() for c in ("block", "a", "b"))
    for own in np.split(order, cuts):
        if len(own) > 1:
            yield own, np.flatnonzero(block[own] == firsts[own[0]]), np.flatnonzero(block[own] == seconds[own[0]])


def _candidates(limit: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sketches = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), COORDINATES)
        earlier = rows["earlier"].to_numpy()
        active = np.zeros(len(rows), bool)
        for own, left, right in _block_pairs(rows):
            sketch = sketches[own]
            close = np.empty((len(left), len(right)), bool)
            for i, place in enumerate(left):
                close[i] = (sketch[right] == sketch[place]).sum(axis=1, dtype=np.uint8) >= limit
            close &= left[:, None] != right[None, :]
            if close.any():
                close &= ~_met_before(list(earlier[own]), left, right)
                active[own[left[close.any(axis=1)]]] = True
                active[own[right[close.any(axis=0)]]] = True
        return rows.loc[active, ["bucket", "a", "b", "block", "key", "size", "earlier"]]

    return run


def similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """For each row of ``left`` and ``right``: is the sets' Jaccard similarity the threshold or more?"""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, ids, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[ids] > 1
    owner = owner[shared]
    _, ids = np.unique(ids[shared], return_inverse=True)
    common = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(ids, kind="stable")
    owner, ids = owner[order], ids[order]
    for first in range(0, int(ids[-1]) + 1 if len(ids) else 0, 2048):
        a, b = np.searchsorted(ids, [first, first + 2048])
        member = np.zeros((len(sets), 2048), np.float32)
        member[owner[a:b], ids[a:b] - first] = 1
        common += member[left] @ member[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - common
    return common >= threshold * union - 1e-6


def _linked(threshold: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        members, earlier, keys = (rows[c].to_numpy() for c in ("members", "earlier", "key"))
        out: list[tuple[bytes, int, bytes]] = []
        for own, left, right in _block_pairs(rows):
            sets = [np.frombuffer(s, np.uint64) for s in members[own]]
            found = similar(sets, left, right, threshold) & (left[:, None] != right[None, :])
            if found.any():
                found &= ~_met_before(list(earlier[own]), left, right)
            linked = np.zeros((len(own), len(own)), bool)
            linked[np.ix_(left, right)] = found
            linked |= linked.T
            root = np.arange(len(own))
            while True:  # the smallest row that each can reach
                step = np.minimum(root, np.where(linked, root[None, :], len(own)).min(axis=1))
                if (step == root).all():
                    break
                root = step
            links = linked.sum(axis=1)
            out += [(keys[own[i]], int(links[i]), keys[own[root[i]]]) for i in np.flatnonzero(links)]
        return pd.DataFrame(out, columns=["key", "links", "root"])

    return run


def exact_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``key, members`` of the classes in ``wanted`` (``doc_id, key``), from the texts of their first documents."""

    def run(batches):
        for batch in pieces(batches, 0):
            sets = [shingles(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(_key, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["key", "members"],
            )

    first = wanted.select(F.col("doc_id").alias("_first")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string"))
    return texts.join(first, F.col("_id").eqNullSafe(F.col("_first")), "left_semi").select("text").mapInArrow(
        run, "key binary, members binary"
    )


def components(edges: DataFrame) -> DataFrame:
    """``key, component`` (the smallest key) for every end of ``edges`` (``key, root``), by alternating stars."""
    now = save(edges.filter("key <> root").select(F.col("key").alias("u"), F.col("root").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("least"))
        low = low.select("_u", F.least("least", "_u").alias("least"))
        large = both.filter("v > u").join(low, F.col("u") == F.col("_u"))
        now = save(large.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct(), "edges")
        low = now.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("least"))
        star = now.join(low, F.col("u") == F.col("_u"))
        moved = star.filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        now = save(star.select("u", F.col("least").alias("v")).unionByName(moved).distinct(), "edges")
        mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        seen = tuple(now.agg(F.count(F.lit(1)), mark).first())
        if seen == state or not seen[0]:
            break
        state = seen
    ends = now.select(F.col("u").alias("key"), F.col("v").alias("component"))
    return ends.unionByName(now.select(F.col("v").alias("key"), F.col("v").alias("component"))).distinct()


def join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``uid, doc_id, class_id, n_links, copy_of, n_copies, component`` of every row of ``docs``.

    ``class_id``: the smallest document id that links lead to; ``n_links``: links of the row's text to different
    texts; ``copy_of``: the smallest id with an equal set."""
    rows = save(features(docs), "features")
    classes = save(
        rows.filter("key is not null")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_copies"),
            F.first("size").alias("size"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch"),
        ),
        "classes",
    )
    nodes = buckets(classes, runs_as_coded(LEVELS, recall, threshold), LEVELS)
    limit = sketch_limit(threshold, recall)
    near = save(sketch_tasks(nodes, classes).applyInPandas(_candidates(limit), CANDIDATES), "candidates")
    wanted = near.select("key").distinct().join(classes.select("key", "doc_id"), "key")
    links = save(set_tasks(near, exact_sets(docs, wanted)).applyInPandas(_linked(threshold), "key binary, links long, root binary"), "links")
    member = components(links)
    counted = links.groupBy("key").agg(F.sum("links").alias("n_links"))
    linked = member.join(counted, "key").join(classes.select("key", F.col("doc_id").alias("rep")), "key")
    least = linked.groupBy("component").agg(F.min("rep").alias("class_id"))
    of_key = linked.join(least, "component").select("key", "component", "class_id", "n_links")
    known = classes.select("key", "doc_id", "n_copies").join(of_key, "key", "left").select(
        F.col("key").alias("_key"), F.coalesce("component", "key").alias("component"), "n_copies",
        F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.col("doc_id").alias("copy_of"),
    )
    return rows.select("uid", "doc_id", "key").join(known, F.col("key") == F.col("_key"), "left").select(
        "uid", "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("copy_of")).alias("copy_of"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"), "component",
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns: of each component the one with the smallest document id; rows without
    words stay."""
    found = save(join(docs).select("uid", "doc_id", "component"), "joined")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")
    chosen = found.filter("component is not null").groupBy("component").agg(F.min(order).alias("first")).select("first.uid")
    kept = save(chosen.unionByName(found.filter("component is null").select("uid")).distinct(), "kept")
    again = found.filter("component is not null").groupBy("uid").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    again = save(again.join(kept, "uid").select("uid"), "repeated")
    def rows_of(frame: DataFrame, uids: DataFrame, how: str) -> DataFrame:
        on = F.xxhash64("d.doc_id", "d.text") == F.col("other.uid")
        return frame.alias("d").join(uids.alias("other"), on, how)

    stays = rows_of(docs, kept, "left_semi")
    if again.isEmpty():
        return stays
    twice = rows_of(stays, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return rows_of(stays, again, "left_anti").unionByName(twice)
