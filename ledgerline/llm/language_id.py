"""Language identification with interpolated Kneser-Ney character models.

One order-``ORDER`` model a language, stored in sorted arrays of n-gram hashes; a text gets the language of lowest
length-normalised cross-entropy. On a slice of the training rows that the models do not see, ``fit`` chooses the
temperature that turns cross-entropies into a score, and each language's limit of cross-entropy beyond which a text is rejected.

Scale: the models are fitted on a bounded sample (``per_language`` rows a language, drawn by hash from exact counts);
n-grams of the sample are counted in Spark. Scoring is one pass without a shuffle over whole texts.

Defined results: a null text, or one without a letter, gets ``und``, score 0 and is rejected; a null ``doc_id`` is kept
and not held out; null languages are never learned; without any training row every text is ``und``; repeated rows give
repeated rows; equal cross-entropies go to the language that sorts first. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import pieces, save

ORDER = 4
PER_LANGUAGE = 1000
CALIBRATION_SHARE = 5  # one sampled row in so many is kept from the models
ACCEPTED = 0.995  # share of a language's calibration texts that its limit accepts
DISCOUNT = 0.75  # where the counts of counts give none
UNDETERMINED = "und"
SPACE = 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER: list[np.ndarray] = []


def _lower_letters() -> np.ndarray:
    """Code point -> lower-cased letter, or a space for anything else."""
    if not _LOWER:
        table = np.full(0x110000, SPACE, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _LOWER.append(table)
    return _LOWER[0]


def grams(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the 1..ORDER-grams that end at each character of the normalised texts, and the characters a text.

    A text is lower-cased, runs without letters become one space, and it starts after ``ORDER - 1`` spaces."""
    table = _lower_letters()
    lengths = np.array([len(t) if t else 0 for t in texts], np.int64)
    points = np.frombuffer("".join(t for t in texts if t).encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = table[points]
    owner = np.repeat(np.arange(len(texts)), lengths)
    keep = np.ones(len(chars), bool)
    if len(chars):
        first = np.concatenate([[True], owner[1:] != owner[:-1]])
        before = np.concatenate([[SPACE], chars[:-1]])
        before[first] = SPACE
        keep = (chars != SPACE) | (before != SPACE)
    chars, owner = chars[keep].astype(np.uint64), owner[keep]
    counts = np.bincount(owner, minlength=len(texts))
    start = np.concatenate([[0], np.cumsum(counts)[:-1]])
    place = np.arange(len(chars)) - start[owner]
    out, code = [], (chars + np.uint64(1)) * _BASE
    out.append(code)
    for back in range(1, ORDER):
        shifted = np.full(len(chars), SPACE, np.uint64)
        if len(chars) > back:
            shifted[back:] = chars[:-back]
        shifted[place < back] = SPACE
        code = _extend(code, shifted, back)
        out.append(code)
    return out, counts


def _extend(code: np.ndarray, char: np.ndarray, back: int) -> np.ndarray:
    """Hash of the n-gram one character longer to the left."""
    x = code ^ ((char + np.uint64(back << 21)) * np.uint64(0xD6E8FEB86659FD93))
    return (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)


@dataclass
class Language:
    """``keys[n]`` and ``mass[n]``: sorted hashes of the (n+1)-grams and their discounted probabilities; ``contexts[n]``
    and ``rest[n]``: the same for what a context leaves to the shorter model. ``floor``: an unseen character."""

    keys: list[np.ndarray] = field(default_factory=list)
    mass: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    rest: list[np.ndarray] = field(default_factory=list)
    floor: float = 1.0
    limit: float = np.inf

    def probability(self, codes: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
        p = np.full(len(codes[0]), self.floor)
        for n in range(len(self.keys)):
            p = _find(self.keys[n], self.mass[n], codes[n], 0.0) + p * (
                _find(self.contexts[n], self.rest[n], contexts[n], 1.0) if n else 1.0
            )
        return p


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def _discount(counts: np.ndarray) -> float:
    ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
    return ones / (ones + 2 * twos) if ones and twos else DISCOUNT


def kneser_ney(rows: np.ndarray) -> Language:
    """The model of one language. ``rows``: distinct ORDER-grams as ``code1..codeN, context2..contextN, count``.

    The longest n-grams count occurrences, shorter ones the distinct characters before them."""
    model = Language()
    n_codes = ORDER
    codes = [rows[:, i].astype(np.uint64) for i in range(n_codes)]
    contexts = [None, *[rows[:, n_codes + i].astype(np.uint64) for i in range(ORDER - 1)]]
    weights = rows[:, -1].astype(np.float64)
    levels = []
    for n in range(ORDER - 1, -1, -1):
        keys, first, inverse = np.unique(codes[n], return_index=True, return_inverse=True)
        counts = np.bincount(inverse, weights, len(keys))
        if n:
            ctx, where = np.unique(contexts[n][first], return_inverse=True)
            d = _discount(counts)
            total = np.bincount(where, counts, len(ctx))
            kinds = np.bincount(where, minlength=len(ctx))
            levels.append((keys, np.maximum(counts - d, 0) / total[where], ctx, d * kinds / total))
            # each distinct n-gram counts once for the n-gram without its first character
            codes = [c[first] for c in codes]
            contexts = [None if c is None else c[first] for c in contexts]
            weights = np.ones(len(keys))
        else:
            d, total = _discount(counts), counts.sum()
            model.floor = d * len(keys) / total / (len(keys) + 1)
            levels.append((keys, np.maximum(counts - d, 0) / total, np.empty(0, np.uint64), np.empty(0)))
    for keys, mass, ctx, rest in reversed(levels):
        model.keys.append(keys)
        model.mass.append(mass)
        model.contexts.append(ctx)
        model.rest.append(rest)
    return model


@dataclass
class Identifier:
    """All languages' models, and how cross-entropies become scores. Part of what is broadcast, so it is bounded by
    the sample it was fitted on."""

    names: list[str]
    models: list[Language]
    sharpness: float = 8.0

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits a character, by text and language, and the characters a text."""
        codes, counts = grams(texts)
        bits = np.zeros((len(texts), len(self.names)))
        if not len(codes[0]):
            return bits, counts
        _, first, inverse = np.unique(codes[-1], return_index=True, return_inverse=True)
        own = [c[first] for c in codes]
        contexts = self._contexts(texts, first)
        filled = np.flatnonzero(counts)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[filled]
        for k, model in enumerate(self.models):
            cost = -np.log2(model.probability(own, contexts))
            bits[filled, k] = np.add.reduceat(cost[inverse], starts) / counts[filled]
        return bits, counts

    @staticmethod
    def _contexts(texts, first):
        return [None, *[c[first] for c in context_codes(texts)]]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy and rejection of each text."""
        table = _lower_letters()
        letters = np.array([bool(t) and any(table[ord(c)] != SPACE for c in t) for t in texts], bool)
        if not self.names or not len(texts):
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan), np.ones(len(texts), bool)
        bits, _ = self.entropies(texts)
        best = bits.argmin(axis=1)
        share = np.exp2(-self.sharpness * (bits - bits.min(axis=1, keepdims=True)))
        score = np.where(letters, 1 / share.sum(axis=1), 0.0)
        lowest = bits[np.arange(len(texts)), best]
        limits = np.array([m.limit for m in self.models])
        names = [self.names[k] if ok else UNDETERMINED for k, ok in zip(best, letters)]
        return names, score, np.where(letters, lowest, np.nan), ~letters | (lowest > limits[best])


def context_codes(texts: list[str | None]) -> list[np.ndarray]:
    """Hashes of the 1..ORDER-1 characters before each character, aligned with ``grams``."""
    codes, counts = grams(texts)
    start = np.concatenate([[0], np.cumsum(counts)[:-1]])[counts > 0]
    blank = (np.array([SPACE], np.uint64) + np.uint64(1)) * _BASE
    out = []
    for n in range(ORDER - 1):
        if n:
            blank = _extend(blank, np.array([SPACE], np.uint64), n)
        before = np.empty(len(codes[n]), np.uint64)
        before[1:] = codes[n][:-1]
        before[start] = blank
        out.append(before)
    return out


GRAM_COLUMNS = [f"g{i}" for i in range(2 * ORDER - 1)]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct ORDER-grams with their shorter hashes and counts, by language, of each batch."""
    for batch in pieces(batches, 1):
        langs = np.array(batch.column(0).to_pylist(), object)
        texts = batch.column(1).to_pylist()
        for lang in dict.fromkeys(langs):
            own = [t for t, x in zip(texts, langs) if x == lang]
            codes, _ = grams(own)
            if not len(codes[0]):
                continue
            _, first, n = np.unique(codes[-1], return_index=True, return_counts=True)
            found = [c[first].view(np.int64) for c in codes + context_codes(own)]
            columns = [pa.array([lang] * len(first)), *map(pa.array, found), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", *GRAM_COLUMNS, "n"])


def draw(rows: DataFrame, by: str, most: int) -> DataFrame:
    """About ``most`` rows of each value of ``by`` (all, where there are fewer), drawn by a hash of the row. The counts
    are one number a language, of which the models hold far more."""
    counts = {r[by]: r["n"] for r in rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return rows
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    total = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])
    return rows.filter(chance * total[F.col(by)] < most)


def fit(docs: DataFrame, learnable: Column, per_language: int = PER_LANGUAGE) -> Identifier:
    """The models of the rows where ``learnable`` holds, from at most about ``per_language`` rows a language."""
    rows = docs.filter(learnable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sample = save(draw(rows.select("doc_id", "lang", "text"), "lang", per_language), "language-sample")
    kept_back = F.pmod(F.xxhash64("text"), F.lit(CALIBRATION_SHARE)) == 0
    # a language whose texts all fall into the calibration slice is learned from them, and not calibrated
    several = sample.filter(~kept_back & F.col("text").rlike(r"\p{L}")).select("lang").distinct().collect()
    calibrated = kept_back & F.col("lang").isin([r["lang"] for r in several])
    schema = "lang string, " + ", ".join(f"{c} long" for c in GRAM_COLUMNS) + ", n long"
    counted = (
        sample.filter(~calibrated)
        .select("lang", "text")
        .mapInArrow(_count_grams, schema)
        .groupBy("lang", *GRAM_COLUMNS)
        .agg(F.sum("n").alias("n"))
        .toPandas()  # distinct n-grams of the bounded sample
    )
    names = sorted(counted["lang"].unique())
    models = []
    for name in names:
        own = counted[counted["lang"] == name]
        models.append(kneser_ney(own[[*GRAM_COLUMNS, "n"]].to_numpy()))
    found = Identifier(list(names), models)
    if names:
        _calibrate(found, sample.filter(calibrated).select("lang", "text"))
    return found


def _calibrate(model: Identifier, rows: DataFrame) -> None:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in pieces(batches, 1):
            bits, counts = shared.value.entropies(batch.column(1).to_pylist())
            ok = np.flatnonzero(counts)
            for i in ok:
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([bits[i]])], names=["lang", "bits"])

    held = rows.mapInArrow(run, "lang string, bits array<double>").toPandas()  # a row for each calibration text
    held = held[held["lang"].isin(model.names)]
    if not len(held):
        return
    bits = np.stack(held["bits"].to_numpy())
    truth = held["lang"].map(model.names.index).to_numpy()
    gaps = bits - bits[np.arange(len(bits)), truth][:, None]

    def loss(sharpness: float) -> float:
        return float(np.mean(np.log2(np.exp2(np.minimum(-sharpness * gaps, 500)).sum(axis=1))))

    model.sharpness = min((2.0**e for e in range(-2, 7)), key=loss)
    for k, own in enumerate(model.models):
        costs = np.sort(bits[truth == k, k])
        if len(costs):
            own.limit = float(np.quantile(costs, ACCEPTED) * 1.05)


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, bits_per_char double, rejected boolean"


def predict(docs: DataFrame, model: Identifier, held_out: Column) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in pieces(batches, 2):
            names, score, bits, rejected = shared.value.predict(batch.column(2).to_pylist())
            columns = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score)]
            columns += [pa.array(bits, from_pandas=True), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PREDICTED.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, PREDICTED)
