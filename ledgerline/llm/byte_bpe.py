"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one is a minimal perfect hash (hash and displace) over the vocabulary: a pre-token that is itself a
vocabulary entry resolves with one probe and one comparison. Tier two, for the misses, merges pairs by rank
with a heap over a linked list of byte ranges, O(n log n) for a pre-token of n bytes.

Defined results: a null text encodes like an empty one (no ids, empty bytes); a null ``doc_id`` is kept; repeated
rows give repeated rows; columns besides ``doc_id`` and ``text`` are not read, so their names cannot clash.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Memo, list_array, pieces, slices

KEYS_PER_BUCKET = 4
MEMO = 300_000  # pre-tokens a task remembers
LONGEST_MEMO = 64  # characters; longer pre-tokens are encoded anew each time, so that the memo's bytes are bounded too
ENCODED = "doc_id long, ids array<int>"
DECODED = ENCODED + ", decoded binary"


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file: one base64 token and its rank a line. Its size is the vocabulary's, not the data's."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@dataclass
class PerfectHash:
    """Minimal perfect hash from token bytes to id. ``shift[bucket]`` >= 0 is the seed that places the bucket's
    keys; below 0 it names the slot of a bucket's only key directly."""

    shift: np.ndarray
    slot_id: list[int]
    slot_key: list[bytes]

    def __post_init__(self):
        self.shifts = self.shift.tolist()

    def get(self, key: bytes) -> int | None:
        n = len(self.slot_id)
        if not n:
            return None
        h = xxhash.xxh3_64_intdigest(key)
        s = self.shifts[h % len(self.shifts)]
        slot = -s - 1 if s < 0 else _place(h, s, n)
        return self.slot_id[slot] if self.slot_key[slot] == key else None


def _place(h: int, seed: int, n: int) -> int:
    h = (h + seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    return ((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF) % n


SEEDS_AT_ONCE = 64


def _places(h: np.ndarray, first: int, n: int) -> np.ndarray:
    """``_place`` of each hash (columns) under ``SEEDS_AT_ONCE`` seeds (rows)."""
    seeds = np.arange(first, first + SEEDS_AT_ONCE, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = h[None, :] + seeds[:, None]
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) % np.uint64(n)).astype(np.int64)


def build_perfect_hash(ranks: dict[bytes, int]) -> PerfectHash:
    n = len(ranks)
    keys = list(ranks)
    hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
    buckets: list[list[int]] = [[] for _ in range(max(1, n // KEYS_PER_BUCKET))]
    for i, b in enumerate((hashes % np.uint64(len(buckets))).tolist()):
        buckets[b].append(i)
    taken = np.full(n, -1, np.int64)
    shift = np.zeros(len(buckets), np.int64)
    for b in sorted(range(len(buckets)), key=lambda b: -len(buckets[b])):
        members = buckets[b]
        if len(members) < 2:
            break
        first, found = 0, ()
        while not len(found):
            slots = _places(hashes[members], first, n)
            fits = (taken[slots] < 0).all(axis=1)
            fits &= (np.diff(np.sort(slots, axis=1), axis=1) > 0).all(axis=1)
            found = np.flatnonzero(fits)
            first += SEEDS_AT_ONCE
        shift[b] = first - SEEDS_AT_ONCE + found[0]
        taken[slots[found[0]]] = members
    singles = [b for b in range(len(buckets)) if len(buckets[b]) == 1]
    for b, slot in zip(singles, np.flatnonzero(taken < 0)):
        taken[slot], shift[b] = buckets[b][0], -slot - 1
    return PerfectHash(shift, [ranks[keys[i]] for i in taken], [keys[i] for i in taken])


def merge(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: repeatedly joins the neighbouring parts of lowest rank, leftmost first."""
    n = len(token)
    rank_of = ranks.get
    end = list(range(1, n + 1))  # end of the part that starts here; 0 once it was absorbed
    before = list(range(-1, n - 1))
    bits = n.bit_length()
    low = (1 << bits) - 1
    heap = []  # rank, start and end of a joined part in one number
    for i in range(n - 1):
        rank = rank_of(token[i : i + 2])
        if rank is not None:
            heap.append((((rank << bits) | i) << bits) | (i + 2))
    heapify(heap)
    while heap:
        first = heappop(heap)
        stop = first & low
        left = (first >> bits) & low
        middle = end[left]
        if not middle or middle >= n or end[middle] != stop:
            continue  # one of the two parts has changed since
        end[left] = stop
        end[middle] = 0
        if stop < n:
            before[stop] = left
            rank = rank_of(token[left : end[stop]])
            if rank is not None:
                heappush(heap, (((rank << bits) | left) << bits) | end[stop])
        prior = before[left]
        if prior >= 0:
            rank = rank_of(token[prior:stop])
            if rank is not None:
                heappush(heap, (((rank << bits) | prior) << bits) | stop)
    ids, at = [], 0
    while at < n:
        ids.append(ranks[token[at : end[at]]])
        at = end[at]
    return ids


class Codec:
    """What a task needs: the pre-token pattern, both lookup tiers and the bytes of each id."""

    def __init__(self, ranks: dict[bytes, int], table: PerfectHash, pattern: str):
        self.split = regex.compile(pattern).findall
        self.ranks, self.table = ranks, table
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.stop = np.cumsum([len(t) for t in tokens], dtype=np.int64)
        self.size = np.diff(self.stop, prepend=0)
        self.forget()

    def ids_of(self, piece: str) -> bytes:
        """The ids of one pre-token as packed 32-bit integers."""
        token = piece.encode()
        whole = self.table.get(token)
        return array("i", (whole,) if whole is not None else merge(token, self.ranks)).tobytes()

    def forget(self) -> None:
        """Drop what was encoded so far, at a task's end: workers outlive their tasks."""
        self.memo = Memo(self.ids_of, MEMO)

    def ids_of_long(self, piece: str) -> bytes:
        return self.ids_of(piece) if len(piece) > LONGEST_MEMO else self.memo[piece]

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        pieces = self.split(text)
        own = self.memo.__getitem__ if max(map(len, pieces), default=0) <= LONGEST_MEMO else self.ids_of_long
        return np.frombuffer(b"".join(map(own, pieces)), np.int32)

    def decode(self, ids: list[int]) -> bytes:
        return self.decode_all(np.array(ids, np.int64), np.array([0, len(ids)]))[0].as_py()

    def decode_all(self, ids: np.ndarray, cuts: np.ndarray) -> pa.BinaryArray:
        """The bytes of many id lists at once, laid end to end in ``ids`` and cut at ``cuts`` (one more than lists)."""
        size = self.size[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.stop[ids] - ends[1:], size) + np.arange(ends[-1])
        offsets = pa.py_buffer(ends[cuts].astype(np.int64))
        whole = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(self.bytes[at])])
        return whole.cast(pa.binary())


_CODECS: dict[tuple[int, str], Codec] = {}  # one per worker process


def _codec(shared, pattern: str) -> Codec:
    key = (id(shared.value), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(*shared.value, pattern)
    return _CODECS[key]


def share_vocabulary(spark: SparkSession, path: str):
    """Broadcast of the ranks and their perfect hash; bounded by the vocabulary file."""
    ranks = read_ranks(path)
    return spark.sparkContext.broadcast((ranks, build_perfect_hash(ranks)))


def encode(docs: DataFrame, vocabulary, pattern: str) -> DataFrame:
    """``doc_id, ids`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, pattern)
        for batch in pieces(batches, 1):
            ids = [codec.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), list_array(ids, pa.int32())], names=["doc_id", "ids"])
        codec.forget()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, vocabulary, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded`` (bytes) of every row of ``doc_id, ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, pattern)
        for batch in slices(batches, 64):
            yield _decoded(codec, batch.column(0), batch.column(1))

    return encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(run, DECODED)


def _decoded(codec: Codec, doc_id: pa.Array, ids: pa.ListArray) -> pa.RecordBatch:
    offsets = ids.offsets.to_numpy().astype(np.int64)
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    return pa.RecordBatch.from_arrays([doc_id, ids, codec.decode_all(flat, offsets - offsets[0])], names=["doc_id", "ids", "decoded"])


def round_trip(docs: DataFrame, vocabulary, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded``: encodes every text, then decodes the ids, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, pattern)
        for batch in pieces(batches, 1):
            ids = [codec.encode(t) for t in batch.column(1).to_pylist()]
            yield _decoded(codec, batch.column(0), list_array(ids, pa.int32()))
        codec.forget()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, DECODED)


def digests(coded: DataFrame) -> DataFrame:
    """Contract columns of ``doc_id, ids, decoded``."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
