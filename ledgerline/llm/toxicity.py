"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed character n-grams inside the words of a text (present or not). Each feature is scaled by the log
ratio of its smoothed counts in toxic and other documents, and a logistic regression is fitted on the scaled features.

Scale: fitting uses at most about ``per_class`` labelled documents a class (drawn by hash from exact counts, and weighted
back to the classes' true shares). Counts, ratios and the regression run in Spark; the driver gets the features with a
ratio, numbered densely for the regression. Its two settings are chosen by a split of the learnable rows.
Scoring is one pass without a shuffle over whole texts; the n-grams of many texts are hashed at once, whether their
words are frequent or seen once.

Defined results: null and empty texts have no feature and get the score of the intercept; null labels are not
learned; a document labelled more than once counts as toxic if one label says so; with labels of one kind only, or
none, every score is the share of toxic labels (0 without any); repeated rows give repeated rows; a null ``doc_id`` is
kept, not held out and not learned. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import pieces, save, slices

BITS = 18
LENGTHS = (3, 4, 5, 6)
PER_CLASS = 3000
SIGNIFICANT = (3.0, 2.0, 4.0)  # standard errors; of these settings the one that does best on learnable rows is taken
REGULARISATION = (1e-4, 1e-3)
CHECKED = 5  # one in so many learnable rows is kept back to choose the setting
ITERATIONS = 30
BLOCK = 1 << 17  # characters hashed at a time


def _crc_table() -> np.ndarray:
    """What ``zlib.crc32`` does with a byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()
_MASK = np.uint32((1 << BITS) - 1)


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def features(texts: list[str | None], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of texts and their distinct features, both ascending: the hashed n-grams of their words between word
    marks; only features that ``wanted`` has as true, if given. A block of characters is hashed at a time, all n-grams
    that start in it at once, a character longer in each step."""
    marked = ["\x02" + "\x03 \x02".join(set(text.lower().split())) + "\x03 " if text else " " for text in texts]
    data = np.frombuffer("".join([*marked, " " * LENGTHS[-1]]).encode(), np.uint8)
    chars = np.flatnonzero((data & 0xC0) != 0x80)  # where they start
    row = np.repeat(np.arange(len(texts)), [len(m) for m in marked])
    blocks = []
    for start in range(0, len(row), BLOCK):
        n = min(BLOCK, len(row) - start)
        at = chars[start : start + n + LENGTHS[-1]]
        first = data[at]
        follow = [np.flatnonzero(first >= lead) for lead in (0xC0, 0xE0, 0xF0)]  # characters of over 1, 2 and 3 bytes
        spaces = np.append(np.flatnonzero(first == 0x20), len(at))
        room = np.repeat(spaces, np.diff(spaces, prepend=-1))[:n] - np.arange(n)  # characters left of the word
        keys, crc = [], np.full(n, 0xFFFFFFFF, np.uint32)
        for length in range(1, LENGTHS[-1] + 1):
            crc = _CRC[(crc ^ first[length - 1 : length - 1 + n]) & 0xFF] ^ (crc >> 8)
            for i, longer in enumerate(follow):
                if len(longer):
                    own = longer[(longer >= length - 1) & (longer < length - 1 + n)]
                    then = crc[own - length + 1]
                    crc[own - length + 1] = _CRC[(then ^ data[at[own] + i + 1]) & 0xFF] ^ (then >> 8)
            if length in LENGTHS:
                feature = ~crc & _MASK
                here = np.flatnonzero(room >= length if wanted is None else wanted[feature] & (room >= length))
                keys.append((row[start + here] << BITS) | feature[here])
        blocks.append(_distinct(np.concatenate(keys)))
    found = _distinct(np.concatenate(blocks)) if blocks else np.empty(0, np.int64)
    return found >> BITS, found & int(_MASK)


@dataclass
class Classifier:
    """``weights``: regression weight times log-count ratio, by feature; its size is fixed by ``BITS``."""

    weights: np.ndarray
    intercept: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        at, found = features(texts, self.weights != 0)
        margin = self.intercept + np.bincount(at, self.weights[found], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -700, 700)))


def log_count_ratios(rows: DataFrame, significant: float) -> tuple[np.ndarray, np.ndarray]:
    """Features and their smoothed log ratio of shares among toxic and among other documents, from rows of ``label`` and
    ``found``; without those whose ratio lies within ``significant`` standard errors of none, as it does for nearly all
    features of unrelated words, so that long texts don't add up their noise."""
    counts = rows.select("label", F.explode("found").alias("feature")).groupBy("feature").agg(
        (F.sum("label") + 1).alias("toxic"), (F.sum(1 - F.col("label")) + 1).alias("other")
    )
    counts = save(counts, "toxicity-counts")  # at most 2 ** BITS rows
    total = counts.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.count(F.lit(1)).alias("n")).first()
    unseen = (1 << BITS) - total["n"]  # each counts as one
    shift = float(np.log(((total["toxic"] or 0) + unseen) / ((total["other"] or 0) + unseen)))
    ratio = F.log(F.col("toxic") / F.col("other")) - F.lit(shift)
    error = F.sqrt(1 / F.col("toxic") + 1 / F.col("other"))
    found = counts.select("feature", ratio.alias("ratio")).filter(F.abs(ratio) > significant * error).orderBy("feature").collect()
    return np.array([r["feature"] for r in found], np.int64), np.array([r["ratio"] for r in found], float)


def _extract(batches):
    for batch in pieces(batches, 0):
        at, found = features(batch.column(0).to_pylist())
        ends = np.searchsorted(at, np.arange(batch.num_rows + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(found, type=pa.int32()))
        columns = [batch.column(1), batch.column(2), lists]
        yield pa.RecordBatch.from_arrays(columns, names=["label", "weight", "found"])


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, per_class: int = PER_CLASS) -> Classifier:
    """A classifier of the labelled rows of ``docs`` where ``learnable`` (over ``labels.doc_id``) holds."""
    known = (
        labels.filter(learnable & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.when(F.col("toxic") == 1, 1.0).otherwise(0.0)).alias("label"))
    )
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    if len(sizes) < 2:
        share = float(next(iter(sizes), 0.0))
        margin = {0.0: -700.0, 1.0: 700.0}[share]
        return Classifier(np.zeros(1 << BITS), margin)
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = F.when(F.col("label") == 1, min(1.0, per_class / sizes[1.0])).otherwise(min(1.0, per_class / sizes[0.0]))
    drawn = known.withColumn("share", share).filter(chance < F.col("share"))
    # ``drawn`` holds about 2 * per_class ids whatever the input: the bound that allows the broadcast
    sample = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    rows = save(
        sample.select("text", "label", (1 / F.col("share")).alias("weight")).mapInArrow(
            _extract, "label double, weight double, found array<int>"
        ),
        "toxicity-sample",
    )
    if rows.agg(F.count_distinct("label").alias("n")).first()["n"] < 2:
        total = sum(sizes.values())
        return Classifier(np.zeros(1 << BITS), float(np.log(sizes[1.0] / total) - np.log(sizes[0.0] / total)))
    significant, regularisation = _chosen(rows)
    return _regression(Scaled(rows, significant), regularisation)


def _chosen(rows: DataFrame) -> tuple[float, float]:
    """The setting of ``SIGNIFICANT`` and ``REGULARISATION`` with the least log loss on ``CHECKED`` of the learnable rows
    when learned from the others; the first of equal ones."""
    kept_back = F.pmod(F.xxhash64("found"), F.lit(CHECKED)) == 0  # equal texts fall to the same side
    checked, others = rows.filter(kept_back), rows.filter(~kept_back)
    if others.agg(F.count_distinct("label").alias("n")).first()["n"] < 2:
        return SIGNIFICANT[0], REGULARISATION[0]
    losses = {}
    for significant in SIGNIFICANT:
        scaled = Scaled(others, significant)
        for regularisation in REGULARISATION:
            losses[significant, regularisation] = _loss(checked, _regression(scaled, regularisation))
    return min(losses, key=losses.__getitem__)


def _loss(rows: DataFrame, model: Classifier) -> float:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches):
            weights, intercept = shared.value.weights, shared.value.intercept
            margin = np.array([weights[x.values.to_numpy()].sum() + intercept for x in batch.column(2)])
            label, weight = (batch.column(k).to_numpy() for k in (0, 1))
            lost = weight * np.logaddexp(0, np.where(label > 0, -margin, margin))
            yield pa.RecordBatch.from_arrays([pa.array(lost)], names=["lost"])

    return rows.select("label", "weight", "found").mapInArrow(run, "lost double").agg(F.sum("lost").alias("lost")).first()["lost"] or 0.0


class Scaled:
    """Written rows ``label, weight, x``: the features with a ratio, numbered densely and scaled by it."""

    def __init__(self, rows: DataFrame, significant: float):
        self.features, self.ratio = log_count_ratios(rows, significant)
        shared = rows.sparkSession.sparkContext.broadcast((self.features, self.ratio))

        def run(batches):
            features, ratio = shared.value
            for batch in slices(batches):
                vectors = []
                for found in batch.column(2):
                    own = found.values.to_numpy()
                    at = np.searchsorted(features, own[np.isin(own, features)])
                    vectors.append({"type": 0, "size": len(features), "indices": at, "values": ratio[at]})
                columns = [batch.column(0), batch.column(1), pa.array(vectors, _SPARSE)]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "weight", "x"])

        kind = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("weight", T.DoubleType()), T.StructField("x", VectorUDT())])
        self.rows = save(rows.select("label", "weight", "found").mapInArrow(run, kind), "toxicity-vectors")


def _regression(scaled: Scaled, regularisation: float) -> Classifier:
    weights = np.zeros(1 << BITS)
    if not len(scaled.features):
        share = scaled.rows.agg((F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).alias("share")).first()["share"]
        return Classifier(weights, float(np.log(share / (1 - share))))
    regression = LogisticRegression(
        featuresCol="x", labelCol="label", weightCol="weight", maxIter=ITERATIONS, regParam=regularisation, standardization=False
    )
    model = regression.fit(scaled.rows)
    weights[scaled.features] = model.coefficients.toArray() * scaled.ratio
    return Classifier(weights, float(model.intercept))


#: A sparse vector as ``VectorUDT`` stores it.
_SPARSE = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """``doc_id, text`` and its ``score`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in pieces(batches, 1):
            scores = shared.value.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Classifier, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all their columns, that score under ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index("text")
    schema = docs.schema

    def run(batches):
        for batch in pieces(batches, text_at):
            scores = shared.value.scores(batch.column(text_at).to_pylist())
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, schema)
