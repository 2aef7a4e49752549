"""Byte-level BPE, language identification, token counts and toxicity."""

import base64
import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from ledgerline.llm import byte_bpe, language_id, queries, token_counts, toxicity
from ledgerline.llm.common import Memo, crc_mod
from pyspark.sql import functions as F

from tests.llm.conftest import SF

PATH, PATTERN = queries.VOCABULARY, public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    ranks = byte_bpe.read_ranks(PATH)
    return byte_bpe.Codec(ranks, byte_bpe.build_perfect_hash(ranks), PATTERN)


def test_perfect_hash_is_minimal_and_exact(codec):
    assert sorted(codec.table.slot_id) == sorted(codec.ranks.values())
    assert all(codec.table.get(t) == i for t, i in codec.ranks.items())
    assert codec.table.get(b"no such token of the vocabulary") is None
    assert byte_bpe.build_perfect_hash({}).get(b"a") is None


def test_ids_equal_the_library_on_random_text(codec, reference):
    rng = random.Random(5)
    ranges = [(32, 127), (0, 32), (0x80, 0x3000), (0x3000, 0xD7FF), (0x1F000, 0x20000)]
    for _ in range(500):
        text = "".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(80)))
        ids = codec.encode(text).tolist()
        assert ids == reference.encode_ordinary(text)
        assert codec.decode(ids).decode() == text


def test_long_pre_token(codec, reference):
    assert codec.encode("ab" * 3000).tolist() == reference.encode_ordinary("ab" * 3000)


def test_bpe_query_equals_the_library(spark, reference):
    got = {r["doc_id"]: r for r in queries.byte_level_bpe(spark, SF).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        ids = reference.encode_ordinary(text)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_odd_rows(spark, odd_documents, no_documents):
    words = byte_bpe.share_vocabulary(spark, PATH)
    rows = byte_bpe.round_trip(odd_documents, words, PATTERN).collect()
    texts = sorted((r["text"] or "") for r in odd_documents.collect())
    assert sorted(bytes(r["decoded"]).decode() for r in rows) == texts
    assert byte_bpe.round_trip(no_documents, words, PATTERN).count() == 0


def _wordpiece(word, starts, inside):
    """Greedy longest match, piece by piece."""
    at, count = 0, 0
    while at < len(word):
        known = inside if at else starts
        stop = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if stop is None:
            return 0
        at, count = stop, count + 1
    return count


def test_automaton_equals_greedy_matching():
    rng = random.Random(3)
    for _ in range(60):
        pieces = {bytes(rng.choices(b"abc", k=rng.randrange(1, 6))) for _ in range(rng.randrange(1, 25))}
        starts = {bytes(rng.choices(b"abc", k=rng.randrange(1, 5))) for _ in range(rng.randrange(1, 25))}
        automaton = token_counts.Automaton([*pieces, *(b" " + s for s in starts)])
        for _ in range(60):
            word = bytes(rng.choices(b"abc", k=rng.randrange(1, 14)))
            assert automaton.count(word) == _wordpiece(word, starts, pieces)


def test_token_counts(spark, odd_documents, no_documents):
    words = token_counts.share_vocabulary(spark, PATH)
    vocabulary = byte_bpe.read_ranks(PATH)
    starts = {t[1:] for t in vocabulary if t[:1] == b" " and len(t) > 1}
    inside = {t for t in vocabulary if t[:1] != b" "}
    rows = token_counts.count_tokens(odd_documents, words).collect()
    expected = []
    for r in odd_documents.collect():
        found = token_counts.WORD.findall(r["text"] or "")
        if r["doc_id"] != 5:  # greedy matching is quadratic there
            counts = [_wordpiece(w.encode(), starts, inside) for w in found]
            expected.append((r["doc_id"], len(found), sum(counts) + counts.count(0), counts.count(0)))
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in rows if r["doc_id"] != 5)
    assert token_counts.count_tokens(no_documents, words).count() == 0


def test_kneser_ney_sums_to_one():
    texts = ["abracadabra and cabbage", "a bad cab", "dab the crab"]
    codes, _ = language_id.grams(texts)
    _, first, n = np.unique(codes[-1], return_index=True, return_counts=True)
    rows = np.stack([c[first].view(np.int64) for c in codes + language_id.context_codes(texts)] + [n], axis=1)
    model = language_id.kneser_ney(rows)
    alphabet = [*sorted(set("".join(texts))), "q"]  # and a character that it has not seen
    for context in ("abr", "the", " ba", "zzz"):
        texts = [context + c for c in alphabet]
        codes, counts = language_id.grams(texts)
        last = np.cumsum(counts) - 1
        contexts = [None, *[c[last] for c in language_id.context_codes(texts)]]
        total = model.probability([c[last] for c in codes], contexts).sum()
        assert total == pytest.approx(1, abs=1e-9)


def test_language_held_out_accuracy(spark):
    got = queries.language(spark, "/root/testdata/sf0.01").toPandas()
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    assert len(got) == len(truth) and got["score"].between(0, 1).all()
    held = both[both["held_out"]]
    assert len(held) and (held["lang_pred"] == held["lang"]).mean() > 0.98
    assert both["rejected"].mean() < 0.1


def test_language_odd_rows(spark, odd_documents, no_documents):
    held_out = crc_mod("doc_id", 4) == 2
    model = language_id.fit(odd_documents, ~held_out)
    rows = language_id.predict(odd_documents, model, held_out).collect()
    texts = {r["doc_id"]: r["text"] for r in odd_documents.collect()}
    assert len(rows) == odd_documents.count()
    for r in rows:
        letters = any(c.isalpha() for c in texts[r["doc_id"]] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (letters or r["rejected"])
    empty = language_id.fit(no_documents, ~held_out)
    assert {r["lang_pred"] for r in language_id.predict(odd_documents, empty, held_out).collect()} == {"und"}
    assert language_id.predict(no_documents, model, held_out).count() == 0


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.toxicity_scores(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").toPandas()
    held = got[got["held_out"]].merge(labels, on="doc_id")
    assert (held["predicted"] == held["toxic"]).mean() > 0.95
    assert got["score"].between(0, 1).all() and got["doc_id"].is_unique


def test_toxicity_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame(
        [(1, 1, 1), (1, 1, 0), (3, 1, 0), (6, 1, 0), (7, None, None), (None, 1, 1), (9, 1, 0), (8, 1, 1)], "doc_id long, quality int, toxic int"
    )
    learnable = F.col("doc_id").isNotNull()
    model = toxicity.fit(odd_documents, labels, learnable)
    rows = toxicity.score(odd_documents, model).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (2, 3, 4)}) == 1
    kept = toxicity.keep_clean(odd_documents, model, 2.0)
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count()
    none = toxicity.fit(odd_documents, labels.limit(0), learnable)
    assert toxicity.score(odd_documents, none).agg(F.max("score")).first()[0] < 1e-6
    assert toxicity.score(no_documents, model).count() == 0
    assert toxicity.keep_clean(no_documents, model).count() == 0


def _toxicity_features(text):
    """Word by word: the features of a text's words between word marks."""
    words = [f"\x02{w}\x03" for w in set((text or "").lower().split())]
    lengths = toxicity.LENGTHS
    return {zlib.crc32(w[i : i + n].encode()) % (1 << toxicity.BITS) for w in words for n in lengths for i in range(max(1, len(w) - n + 1))}


def _toxicity_model():
    rng = np.random.default_rng(4)
    return toxicity.Classifier(np.where(rng.random(1 << toxicity.BITS) < 0.1, rng.normal(size=1 << toxicity.BITS), 0.0), -0.25)


def test_toxicity_scores_of_odd_texts():
    rng = random.Random(6)
    ranges = [(32, 127), (0, 40), (0x80, 0x800), (0x3000, 0xD7FF), (0x1F000, 0x20000)]
    texts = ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(200))) for _ in range(300)]
    texts += [None, "", " \n", "a", "x" * 300_000, "naïve " * 50_000, "\U0001f600" * 140_000, "İ Σας \x02\x03 a\x85b\x1cc", "same same"]
    model = _toxicity_model()
    margins = np.array([model.intercept + model.weights[sorted(_toxicity_features(t))].sum() for t in texts])
    np.testing.assert_allclose(model.scores(texts), 1 / (1 + np.exp(-margins)), rtol=1e-9)
    assert not len(model.scores([]))


def test_toxicity_scores_rare_words_faster_than_word_by_word():
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randrange(3, 12))) for _ in range(300)) for _ in range(300)]
    model = _toxicity_model()
    model.scores(texts[:5])
    times = [time.process_time()]
    scores = model.scores(texts)
    times.append(time.process_time())
    margins = np.array([model.intercept + model.weights[sorted(_toxicity_features(t))].sum() for t in texts])
    times.append(time.process_time())
    np.testing.assert_allclose(scores, 1 / (1 + np.exp(-margins)), rtol=1e-9)
    assert times[1] - times[0] < (times[2] - times[1]) / 2


def test_memo_is_bounded():
    calls = []
    memo = Memo(lambda k: calls.append(k) or k * 2, limit=3)
    assert [memo[k] for k in (1, 2, 3, 1, 4, 1, 5)] == [2, 4, 6, 2, 8, 2, 10]
    assert len(memo) <= 3 and len(memo.older) <= 3 and calls == [1, 2, 3, 4, 5]
