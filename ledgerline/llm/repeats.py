"""Removal of long repeated passages: a count-min prefilter over windows of words, then exact counts of what it lets through.

A window is a run of consecutive words of one document. Every word covered by a window whose words start anywhere else
too is removed. First pass: each task counts windows in a count-min sketch of its own; the partition sketches are added up
and give, for every window, an estimate that is never below its count. Second pass: windows with an estimate over one are
counted exactly by 128 bits of hash, and those found once are the sketch's mistakes. Third pass: words under windows that
are left are removed.

Windows are sketched by anchors, so that the sketch has one entry for some ten windows: the anchor of a window is the
smallest hash among its runs of ``ANCHOR`` words, and a place counts once however many windows share it. Equal windows have
equal anchors at different places, so a repeated window always has a repeated anchor, and none is lost.

Scale: the sketch has ``2 ** bits`` cells, sized from the bytes of all texts and at most ``MOST_BITS``; partitions send the
cells they touched, and a task merges one block of cells from a sorted stream, so neither memory follows the input. Beyond
that size more windows pass on to the exact count, which loses nothing either. Broadcast: one bit a cell (256 MB at most).
The exact count is one aggregation with partial sums, so a passage in a third of all documents leaves each task as one
row; a window found once carries its only place with it, so no second join of windows is needed. Texts are shuffled once,
if at all: the windows found once come back a list a text, broadcast while their number is small.

Defined results: null and empty texts have no word and keep an empty text; texts of fewer words than a window lose none
(a window of other documents cannot be covered by them); repeated rows repeat each other's windows, so they are removed
alike; words are bytes between ASCII blanks, taken unchanged; a null ``doc_id`` is kept; other columns are not read. Two
texts or windows count as equal if 128 bits of their hashes are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Memo, pieces, save

LENGTH = 35
ANCHOR = 18
DEPTH = 2  # rows of the sketch
BLOCK_BITS = 22  # cells merged at once
BYTES_PER_CELL = 4  # of text; an anchor for about 60 bytes, so 16 cells an anchor
MOST_BITS = 31
LONGEST_MEMO = 64  # words over so many bytes are hashed anew each time
BROADCAST_PLACES = 4_000_000
SPAN = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

_MULTIPLIERS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]
_WORDS: Memo = Memo(xxhash.xxh3_128_digest, 200_000)  # one per worker process


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Two 64-bit hashes a word, as rows."""
    known = [_WORDS[w] if len(w) <= LONGEST_MEMO else xxhash.xxh3_128_digest(w) for w in words]
    return np.frombuffer(b"".join(known), np.uint64).reshape(-1, 2)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def runs(hashes: np.ndarray, length: int, multiplier: np.uint64) -> np.ndarray:
    """A hash of every run of ``length`` words, from the runs of half the length."""
    if length == 1:
        return hashes
    half = runs(hashes, length // 2, multiplier)
    n = len(hashes) - length + 1
    left, right = half[:n] * _power(multiplier, length // 2), half[length // 2 : length // 2 + n]
    return (left + right) * multiplier + hashes[length - 1 :] if length % 2 else left + right


def _power(x: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(x), n, 1 << 64))


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values, by runs of doubled width."""
    own, have = values, 1
    while have < width:
        step = min(have, width - have)
        own = pick(own[: len(own) - step], own[step:])
        have += step
    return own


def anchors(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor hash of every window, and the hashes at the places that are an anchor of some window, one a place."""
    shorter = min(ANCHOR, length)
    places = mixed(runs(hashes[:, 0], shorter, _MULTIPLIERS[0])) | np.uint64(1)
    width = length - shorter + 1
    own = sliding(places, width, np.minimum)
    # the windows of a place start at it or up to ``width`` - 1 places before; 0 where none starts
    padded = np.concatenate([np.zeros(width - 1, np.uint64), own, np.zeros(width - 1, np.uint64)])
    chosen = sliding(padded, width, np.maximum) == places
    return own, places[chosen]


def cells(found: np.ndarray, bits: int) -> np.ndarray:
    """A cell in each row of the sketch, for each hash; the rows share ``2 ** bits`` cells."""
    row = np.uint64(bits - DEPTH.bit_length() + 1)
    out = np.empty((DEPTH, len(found)), np.uint64)
    for k in range(DEPTH):
        out[k] = (mixed(found * np.uint64(2 * k + 1) + np.uint64(k)) >> (np.uint64(64) - row)) + (np.uint64(k) << row)
    return out


class Sketch:
    """The bits of cells that were counted at least twice."""

    def __init__(self, twice: np.ndarray, bits: int):
        self.twice, self.bits = twice, bits

    def repeated(self, own: np.ndarray) -> np.ndarray:
        """Whether each hash's estimate, the least of its cells, is over one."""
        at = cells(own, self.bits)
        out = np.ones(len(own), bool)
        for row in at:
            out &= (self.twice[row >> np.uint64(3)] >> (row & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def partition_sketches(texts: DataFrame, length: int, bits: int) -> DataFrame:
    """``block, once, twice``: for every task and block of cells the cells (inside the block) that its part of the texts
    counts once, and those it counts more often."""

    def run(batches):
        held: list[np.ndarray] = []
        for batch in pieces(batches, 0):
            for text in _texts(batch, 0):
                words = text.split() if text else ()
                if len(words) >= length:
                    held.append(cells(anchors(word_hashes(words), length)[1], bits).ravel())
            if sum(map(len, held)) >= 1 << 21:
                yield from flush(held)
                held = []
        if held:
            yield from flush(held)

    def flush(held):
        found, n = np.unique(np.concatenate(held), return_counts=True)
        blocks = found >> np.uint64(BLOCK_BITS)
        at = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(found)]
        inside = (found & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.uint32)
        for a, b in zip(at, at[1:]):
            if b > a:
                own, often = inside[a:b], n[a:b] > 1
                columns = [[int(blocks[a])], [own[~often].tobytes()], [own[often].tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "once", "twice"])

    return texts.mapInArrow(run, "block long, once binary, twice binary")


def merge(sketches: DataFrame, bits: int) -> DataFrame:
    """``block, bits``: the partition sketches added up; a bit a cell that was counted at least twice."""

    def run(batches):
        block, counts = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != block:
                    if counts is not None:
                        yield packed(block, counts)
                    block, counts = row["block"], np.zeros(1 << BLOCK_BITS, np.uint8)
                once = np.frombuffer(row["once"], np.uint32)  # no cell twice in a row
                counts[once] = np.minimum(counts[once] + 1, 2)
                counts[np.frombuffer(row["twice"], np.uint32)] = 2
        if counts is not None:
            yield packed(block, counts)

    def packed(block, counts):
        own = np.packbits(counts > 1, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([own], pa.binary())], names=["block", "bits"])

    blocks = max(1, 1 << (bits - BLOCK_BITS))
    streams = sketches.repartition(blocks, "block").sortWithinPartitions("block")  # a task holds one block's cells at a time
    return streams.mapInArrow(run, "block long, bits binary")


def build_sketch(texts: DataFrame, length: int):
    """Broadcast of the merged sketch of all texts' windows."""
    size = texts.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    bits = min(MOST_BITS, max(BLOCK_BITS, int(np.ceil(np.log2(max(1, size / BYTES_PER_CELL))))))
    twice = np.zeros(1 << (bits - 3), np.uint8)
    share = 1 << (BLOCK_BITS - 3)
    merged = save(merge(partition_sketches(texts, length, bits), bits), "repeat-sketch")
    for row in merged.toLocalIterator():  # half a MB each, at most 2 ** (MOST_BITS - BLOCK_BITS)
        twice[row["block"] * share : (row["block"] + 1) * share] = np.frombuffer(row["bits"], np.uint8)
    return texts.sparkSession.sparkContext.broadcast(Sketch(twice, bits))


def _key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("key"), F.xxhash64(F.concat(F.lit("\x01"), text)).alias("key2")]


def estimated_repeated(texts: DataFrame, sketch, length: int) -> DataFrame:
    """``h1, h2, key, key2, at``: the windows of ``text, key, key2`` with an estimate over one."""

    def run(batches):
        for batch in pieces(batches, 0):
            parts = []
            for row, text in enumerate(_texts(batch, 0)):
                words = text.split() if text else ()
                if len(words) < length:
                    continue
                hashes = word_hashes(words)
                at = np.flatnonzero(sketch.value.repeated(anchors(hashes, length)[0]))
                if len(at):
                    own = [runs(hashes[:, k], length, _MULTIPLIERS[k])[at] for k in (0, 1)]
                    parts.append((*own, np.full(len(at), row), at))
            if parts:
                h1, h2, row, at = map(np.concatenate, zip(*parts))
                row = pa.array(row)
                for a in range(0, len(at), 50_000):
                    cut = slice(a, a + 50_000)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(h1[cut].view(np.int64)), pa.array(h2[cut].view(np.int64)),
                            batch.column(1).take(row[cut]), batch.column(2).take(row[cut]), pa.array(at[cut].astype(np.int32)),
                        ],
                        names=["h1", "h2", "key", "key2", "at"],
                    )

    return texts.mapInArrow(run, "h1 long, h2 long, key long, key2 long, at int")


def found_once(windows: DataFrame) -> DataFrame:
    """``key, key2, single``: places of the windows that exact counts find only once, a list a text."""
    exact = windows.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("key"), F.min("key2").alias("key2"), F.min("at").alias("at")
    )
    # of a single window the minima are its own values
    return exact.filter("n = 1").groupBy("key", "key2").agg(F.collect_list("at").alias("single"))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, spans``: every row's text without the words that repeated windows of ``length``
    words cover, joined by single blanks, and the spans (word numbers) of what was removed."""
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    rows = rows.select("text", *_key(F.col("text")), "doc_id")
    sketch = build_sketch(rows.select("text"), length)
    single = save(found_once(estimated_repeated(rows.select("text", "key", "key2"), sketch, length)), "windows-once")
    size = single.agg(F.count(F.lit(1)).alias("texts"), F.sum(F.size("single")).alias("places")).first()
    if (size["places"] or 0) + 8 * size["texts"] <= BROADCAST_PLACES:
        single = F.broadcast(single)
    both = rows.join(single, ["key", "key2"], "left").select("text", "single", "doc_id")

    def run(batches):
        for batch in pieces(batches, 0):
            out = [_without(t, s, length, sketch.value) for t, s in zip(_texts(batch, 0), batch.column(1))]
            n, removed, kept, spans = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(2), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()), pa.array(spans, SPAN),
                ],
                names=["doc_id", "n_words", "n_removed", "kept", "spans"],
            )

    return both.mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:int,stop:int>>"
    )


def _without(text: bytes | None, single: pa.Scalar, length: int, sketch: Sketch) -> tuple[int, int, bytes, list[dict]]:
    words = text.split() if text else []
    if len(words) < length:
        return len(words), 0, b" ".join(words), []
    own = sketch.repeated(anchors(word_hashes(words), length)[0])
    if single.is_valid:
        own[single.values.to_numpy(zero_copy_only=False)] = False
    edge = np.zeros(len(words) + 1, np.int32)
    at = np.flatnonzero(own)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + length, -1)
    covered = np.cumsum(edge[:-1]) > 0
    if not covered.any():
        return len(words), 0, b" ".join(words), []
    turns = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    spans = [{"start": a, "stop": b} for a, b in turns.reshape(-1, 2).tolist()]
    kept, last = [], 0
    for span in spans:
        kept += words[last : span["start"]]
        last = span["stop"]
    kept += words[last:]
    return len(words), int(covered.sum()), b" ".join(kept), spans


def digests(found: DataFrame) -> DataFrame:
    """Contract columns of ``remove_repeats``."""
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
