"""Bloom filters of keys, one a partition, built and probed by Spark's own functions.

A table that is partitioned by another column than its key can hold a key twice in different partitions. Each commit
keeps, for every partition it writes, a blocked Bloom filter of its keys and their least and greatest value: a key falls
into one block of ``BLOCK`` bits, by its hash, and sets ``PROBES`` of them (``bitmap_construct_agg``). A batch is probed
against all filters by a join on (number of blocks, block); only partitions that are hit are read, and there only the
keys that hit.

Scale: a filter takes ``BITS_A_KEY`` bits a key and is spread over rows of 4 KB, so that no task or join row grows with a
partition. A build has a task for every ``TASK_KEYS`` keys, so that more keys need more tasks and no larger ones. About one key in a hundred thousand hits a partition that doesn't hold it; such a hit costs a read, no error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 15  # bits, as many as one of Spark's bitmaps has
BITS_A_KEY = 32
PROBES = 6
TASK_KEYS = 250_000  # keys of one task of a build: it sorts PROBES rows a key


def _positions(key: str) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(BLOCK)) for i in range(PROBES)])


def _block(key: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(-1), F.col(key)), blocks)


def build(rows: DataFrame, part: str, key: str) -> DataFrame:
    """``part, blocks, block, bits, lo, hi`` of every partition's keys (nulls are no keys). Reads ``rows`` twice: now, to
    count the keys, and for the filters."""
    keys = rows.select(part, F.col(key).cast("long").alias("key")).filter("key is not null")
    sizes = keys.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
    # one row a partition written by a commit: months or days, bounded by the calendar
    counted = sizes.collect()
    tasks = max(1, -(-sum(r["n"] for r in counted) // TASK_KEYS))
    sizes = rows.sparkSession.createDataFrame(counted, sizes.schema)
    power = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") * BITS_A_KEY / BLOCK)))
    sizes = sizes.select(F.col(part).alias("_part"), F.pow(F.lit(2), power).cast("long").alias("blocks"), "lo", "hi")
    sized = keys.join(F.broadcast(sizes), F.col(part).eqNullSafe(F.col("_part"))).drop("_part")
    # whole blocks in one task, before a key becomes PROBES rows that are sorted there
    dealt = sized.withColumn("block", _block("key", F.col("blocks"))).repartition(tasks, part, "block").distinct()
    set_bits = dealt.select(part, "blocks", "lo", "hi", "block", F.explode(_positions("key")).alias("at"))
    return set_bits.groupBy(part, "blocks", "block", "lo", "hi").agg(F.call_function("bitmap_construct_agg", F.col("at")).alias("bits"))


def _is_set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, F.pmod(at, F.lit(8)).cast("int")) == 1


def probe(keys: DataFrame, filters: DataFrame, part: str) -> DataFrame:
    """``key, part``: the partitions that may hold each ``key`` of ``keys``; none that does is missing."""
    sizes = [r[0] for r in filters.select("blocks").distinct().collect()]  # powers of two: some dozens
    if not sizes:
        return keys.select("key", F.lit(None).cast(filters.schema[part].dataType).alias(part)).limit(0)
    asked = keys.select("key", _positions("key").alias("at"), F.explode(F.array(*[F.lit(s).cast("long") for s in sorted(sizes)])).alias("blocks"))
    asked = asked.withColumn("block", _block("key", F.col("blocks")))
    found = asked.join(filters, ["blocks", "block"]).filter(F.col("key").between(F.col("lo"), F.col("hi")))
    hit = reduce(lambda a, b: a & b, [_is_set(F.col("bits"), F.col("at")[i]) for i in range(PROBES)])
    return found.filter(hit).select("key", part).distinct()
