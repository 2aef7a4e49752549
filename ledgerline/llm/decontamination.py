"""Benchmark decontamination with spaced seeds.

Fixed masks name token positions that a window's hash ignores, so a window still matches where a word was substituted
at an ignored place. Hashes of the benchmark's and of the documents' windows are joined; around each hit the
item is laid along the document at the hit's diagonal and compared word by word: of all stretches of ``MIN_WORDS`` words
or more with a share of ``MIN_EQUAL`` equal ones, the one with most equal words is the overlap.

Scale: documents are read once. A sieve of fixed size (``SIEVE_BITS`` bits, set from the benchmark's hashes by Spark) drops
nearly all windows of clean documents before anything is shuffled; what passes, rightly or not, is joined by hash, and
that join is exact for a benchmark of any size. A passage that very many documents share is a hot hash of narrow rows,
which a skewed join can split.

Defined results: words are lower-cased runs of letters, digits and underscores. Null and empty texts overlap with
nothing. Items of under ``MIN_WORDS`` words are no evidence and take no part, nor do overlaps of fewer words. Equal
items each get a row. Repeated documents give one row for each document id and item; the overlap with most equal words
counts, the earliest on ties. Other columns are not read.
"""

from __future__ import annotations

import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Memo, list_array, pieces, save

#: 1 marks a position that counts. Each stretch of 13 to 25 words with a fifth of them changed, at any places,
#: holds a window that a mask matches; a longer one holds such a stretch, so no overlap is without a hit.
MASKS = ("1101111", "111010000011", "1101000111", "1111011")
MIN_WORDS = 13
MIN_EQUAL = 0.8
SIEVE_BITS = 25
PROBES = 3
_WORD = re.compile(r"\w+")
_TOKENS = Memo(lambda w: xxhash.xxh3_64_intdigest(w), 300_000)
HIT = "struct<mask:int,hash:long,pos:int>"
OVERLAP = "doc_id long, item_id long, n_equal int, n_aligned int, doc_pos int, item_pos int"


def tokens(text: str | None) -> np.ndarray:
    words = _WORD.findall(text.lower()) if text else []
    return np.fromiter(map(_TOKENS.__getitem__, words), np.uint64, len(words))


def windows(ids: np.ndarray) -> list[np.ndarray]:
    """For each mask, the hashes of all windows of its span."""
    out = []
    for number, mask in enumerate(MASKS):
        n = max(0, len(ids) - len(mask) + 1)
        h = np.full(n, number + 1, np.uint64)
        for offset, counts in enumerate(mask):
            if counts == "1" and n:
                h = (h ^ ids[offset : offset + n]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
        out.append(h)
    return out


def _probe(hashes: np.ndarray, k: int) -> np.ndarray:
    return (hashes * np.uint64((0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)[k])) >> np.uint64(64 - SIEVE_BITS)


def passing(sieve: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes that the sieve lets through."""
    at = np.arange(len(hashes))
    for k in range(PROBES):
        bits = _probe(hashes[at], k)
        at = at[(sieve[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return at


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``item_id, words, hits`` of every item with at least ``MIN_WORDS`` words."""

    def run(batches):
        for batch in pieces(batches, 1):
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = tokens(text)
                if len(ids) >= MIN_WORDS:
                    hits = [
                        {"mask": m, "hash": h, "pos": p}
                        for m, own in enumerate(windows(ids))
                        for p, h in enumerate(own.view(np.int64).tolist())
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item], pa.int64()), pa.array([ids.view(np.int64)]), pa.array([hits], _HITS)],
                        names=["item_id", "words", "hits"],
                    )

    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text is not null")
    return rows.mapInArrow(run, f"item_id long, words array<long>, hits array<{HIT}>")


_HITS = pa.list_(pa.struct([("mask", pa.int32()), ("hash", pa.int64()), ("pos", pa.int32())]))


def build_sieve(items: DataFrame):
    """Broadcast of the bits that the benchmark's hashes set; 2 ** SIEVE_BITS bits at any size."""

    def run(batches):
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            bits = np.unique(np.concatenate([_probe(hashes, k) for k in range(PROBES)])).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bits >> 6), pa.array(np.int64(1) << (bits & 63))], names=["word", "bit"])

    spark = items.sparkSession
    rows = items.select(F.explode("hits.hash").alias("hash")).mapInArrow(run, "word long, bit long")
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()  # at most 2 ** (SIEVE_BITS - 6) rows
    sieve = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    sieve[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return spark.sparkContext.broadcast(sieve.view(np.uint8))


def document_hits(docs: DataFrame, sieve) -> DataFrame:
    """``uid, doc_id, words, hits`` of the documents with a window that passes the sieve."""

    def run(batches):
        bits = sieve.value
        for batch in pieces(batches, 2):
            rows = []
            for row, text in enumerate(batch.column(2).to_pylist()):
                ids = tokens(text)
                if len(ids) < MIN_WORDS:
                    continue
                hits = []
                for mask, own in enumerate(windows(ids)):
                    at = passing(bits, own)
                    hits += [{"mask": mask, "hash": h, "pos": p} for h, p in zip(own[at].view(np.int64).tolist(), at.tolist())]
                if hits:
                    rows.append((row, ids.view(np.int64), hits))
            if rows:
                at = pa.array([r[0] for r in rows])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at), batch.column(1).take(at),
                        list_array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], _HITS),
                    ],
                    names=["uid", "doc_id", "words", "hits"],
                )

    rows = docs.select(uid(), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, f"uid long, doc_id long, words array<long>, hits array<{HIT}>")


def uid():
    """A row's key: equal rows share it, and it tells apart rows that share a document id."""
    return F.xxhash64("doc_id", "text").alias("uid")


def best_stretch(same: np.ndarray) -> tuple[int, int]:
    """Of all stretches (start, stop) of ``MIN_WORDS`` words or more with a share of ``MIN_EQUAL`` equal ones, the one with
    most equal words, the shortest and then the earliest on ties; (0, 0) if there is none."""
    n = len(same)
    if n < MIN_WORDS:
        return 0, 0
    share = Fraction(MIN_EQUAL).limit_denominator(1000)
    equal = np.concatenate([[0], np.cumsum(same, dtype=np.int64)])
    total = share.denominator * equal - share.numerator * np.arange(n + 1)  # a stretch qualifies if its sum is not negative
    ahead = np.maximum.accumulate(total[::-1])  # from the end: the highest sum at a place or after it
    starts = np.arange(n + 1 - MIN_WORDS)
    stops = n - np.searchsorted(ahead, total[starts], side="left")  # the last place that is as high as the start
    starts = starts[stops - starts >= MIN_WORDS]
    if not len(starts):
        return 0, 0
    stops = n - np.searchsorted(ahead, total[starts], side="left")
    most = equal[stops] - equal[starts]
    starts, stops = starts[most == most.max()], stops[most == most.max()]
    stops = np.maximum(starts + MIN_WORDS, np.searchsorted(equal, equal[stops], side="left"))
    best = int((stops - starts).argmin())
    return int(starts[best]), int(stops[best])


def _verify(batches):
    names = ["uid", *(c.split()[0] for c in OVERLAP.split(", "))]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            item, part, lead = np.array(r["item_words"]), np.array(r["part"]), r["lead"]
            n = min(len(item) - lead, len(part))
            same = item[lead : lead + n] == part[:n]
            start, stop = best_stretch(same)
            if stop > start:
                equal, at = int(same[start:stop].sum()), max(0, r["diagonal"]) + start
                rows.append((r["uid"], r["doc_id"], r["item_id"], equal, stop - start, at, lead + start))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The best verified overlap of each document row (``uid``) and item."""
    items = save(benchmark_windows(benchmark), "benchmark-windows")
    found = save(document_hits(docs, build_sieve(items)), "window-hits")
    theirs = items.select("item_id", F.inline("hits")).select(
        "item_id", "mask", "hash", F.col("pos").alias("item_pos")
    )
    ours = found.select("uid", F.inline("hits"))
    diagonals = (
        ours.join(theirs, ["mask", "hash"])
        .select("uid", "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal"))
        .distinct()
    )
    lines = diagonals.join(items.select("item_id", F.col("words").alias("item_words")), "item_id")
    words = found.select("uid", "doc_id", "words").dropDuplicates(["uid"])
    laid = lines.join(words, "uid").select(
        "uid", "doc_id", "item_id", "diagonal", "item_words",
        F.greatest(F.lit(0), -F.col("diagonal")).alias("lead"),
        F.slice("words", F.greatest(F.lit(0), F.col("diagonal")) + 1, F.size("item_words")).alias("part"),
    )
    order = F.struct(-F.col("n_equal"), "doc_pos", "item_pos", "n_aligned")
    return (
        laid.mapInArrow(_verify, "uid long, " + OVERLAP)
        .groupBy("uid", "doc_id", "item_id")
        .agg(F.min(order).alias("best"))
        .select(
            "uid", "doc_id", "item_id", (-F.col("best.col1")).alias("n_equal"), "best.n_aligned", "best.doc_pos", "best.item_pos"
        )
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row a document id and item that overlap."""
    order = F.struct(-F.col("n_equal"), "doc_pos", "item_pos", "n_aligned")
    return (
        overlaps(docs, benchmark)
        .groupBy("doc_id", "item_id")
        .agg(F.min(order).alias("best"))
        .select("doc_id", "item_id", (-F.col("best.col1")).alias("n_equal"), "best.n_aligned", "best.doc_pos", "best.item_pos")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, that overlap with no item."""
    flagged = overlaps(docs, benchmark).select("uid").distinct()
    on = F.xxhash64("d.doc_id", "d.text") == F.col("flagged.uid")
    return docs.alias("d").join(flagged.alias("flagged"), on, "left_anti")
