"""Repeated passages, vector codes and the Merkle manifest, each against a brute-force version."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from ledgerline.llm import merkle, queries, repeats, vector_codes
from pyspark.sql import functions as F

from tests.llm.conftest import SF


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# --- repeated passages ----------------------------------------------------------


def _without_repeats(texts, length):
    """(words, removed, kept text) by counting every window."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    windows = collections.Counter(tuple(w[i : i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - length + 1):
            if windows[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def _passages(rng, length):
    words = [f"w{i}" for i in range(30)]
    shared = [[rng.choice(words) for _ in range(rng.randrange(length - 2, 4 * length))] for _ in range(8)]
    texts = []
    for _ in range(80):
        own = []
        for _ in range(rng.randrange(0, 4)):
            own += [rng.choice(words) for _ in range(rng.randrange(0, 2 * length))]
            own += rng.choice(shared)[rng.randrange(0, 3) :]
        texts.append(rng.choice([" ", "\n", "\t\x0b"]).join(own))
    texts += texts[:5] + ["same " * (length + 3), "once " * (length - 1), None, "", " \r\n", "a b  c" * length]
    return texts


@pytest.mark.parametrize("length", [1, 2, 5, 19, 35])
def test_repeats_equal_brute_force(spark, length):
    texts = _passages(random.Random(length), length)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = sorted(repeats.remove_repeats(docs, length).collect(), key=lambda r: r["doc_id"])
    assert [(r["n_words"], r["n_removed"], r["kept"]) for r in rows] == _without_repeats(texts, length)
    for r, text in zip(rows, texts):
        assert sum(s["stop"] - s["start"] for s in r["spans"]) == r["n_removed"]
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        inside = {i for s in r["spans"] for i in range(s["start"], s["stop"])}
        assert r["kept"] == " ".join(w for i, w in enumerate(words) if i not in inside)


def test_a_full_sketch_only_costs_time(spark, monkeypatch):
    """With far too few cells every estimate is over one; the exact count still decides."""
    monkeypatch.setattr(repeats, "BLOCK_BITS", 6)
    monkeypatch.setattr(repeats, "MOST_BITS", 6)
    monkeypatch.setattr(repeats, "BROADCAST_PLACES", -1)  # texts are joined by shuffle
    texts = _passages(random.Random(1), 7)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(repeats.remove_repeats(docs, 7).collect(), key=lambda r: r["doc_id"])
    assert [(r["n_words"], r["n_removed"], r["kept"]) for r in rows] == _without_repeats(texts, 7)


def test_sketch_never_underestimates():
    rng = np.random.default_rng(3)
    for length in (3, 20, 35):
        words = [str(x).encode() for x in rng.integers(0, 4, 3000)]
        windows = collections.Counter(tuple(words[i : i + length]) for i in range(len(words) - length + 1))
        own, places = repeats.anchors(repeats.word_hashes(words), length)
        counts = collections.Counter(places.tolist())
        for i, anchor in enumerate(own.tolist()):
            assert counts[anchor] >= windows[tuple(words[i : i + length])]


def test_repeats_of_odd_rows(spark, odd_documents, no_documents):
    rows = repeats.remove_repeats(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], len(r["kept"])) for r in rows)
    assert ("6", 40_000, 40_000, 0) in got and ("5", 1, 0, 200_000) in got and ("2", 0, 0, 0) in got
    assert {x[:3] for x in got if x[0] in ("1", "8")} == {("1", 12, 0), ("8", 12, 0)}  # copies shorter than a window stay
    assert repeats.remove_repeats(no_documents).count() == 0


# --- vector codes ---------------------------------------------------------------


def _lloyd(rows, rounds=vector_codes.ROUNDS):
    """Codes, errors and codebooks of (id, vector, label) by exhaustive comparisons."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    width = -(-max((len(r[1]) for r in rows), default=0) // 8) * 8
    points = [[int(np.floor(4096 * float(np.float32(x)))) for x in r[1]] + [0] * (width - len(r[1])) for r in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, points[i]))
    size = width // 8
    cut = [[tuple(p[k * size : (k + 1) * size]) for k in range(8)] for p in points]
    books = [[cut[i][k] for i in order[:16]] for k in range(8)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(book))

    for _ in range(rounds):
        for k in range(8):
            groups = collections.defaultdict(list)
            for c in cut:
                groups[nearest(c[k], books[k])[1]].append(c[k])
            books[k] = [tuple(sum(x) // len(groups[j]) for x in zip(*groups[j])) if j in groups else b for j, b in enumerate(books[k])]
    found = [[nearest(c[k], books[k]) for k in range(8)] for c in cut]
    errors, labels = [sum(d for d, _ in f) for f in found], collections.Counter()
    for r, e in zip(rows, errors):
        labels[r[2]] += e
    listed = sha(",".join(str(x) for book in books for entry in book for x in entry))
    return sorted(
        (str(r[0]), "".join(f"{j:02x}" for _, j in f), e, labels[r[2]], listed) for r, f, e in zip(rows, found, errors)
    )


def _coded(vectors):
    coded, books = vector_codes.compress(vectors, "vec_id", "embedding", "label")
    rows = vector_codes.digests(vector_codes.label_errors(coded), books, "vec_id").collect()
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in rows)


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("codes", F.lit("clash"))


def test_codes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 40)  # several trees, with inner nodes
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 16))
    rows = [(i, (centres[i % 6] + 0.05 * rng.normal(size=16)).tolist(), int(i % 4) or None) for i in range(300)]
    rows += [(5, rows[5][1], 1), (None, rows[9][1], 2), (900, None, 1), (901, [None] * 16, 1), (902, [float("nan")] * 16, 1)]
    rows += [(903, [float("inf")] + [0.0] * 15, 1), (904, [1.5] * 16, None)]
    assert _coded(_vectors(spark, rows)) == _lloyd(rows)


def test_codes_of_few_equal_and_uneven_vectors(spark):
    cases = [
        [(1, [0.5] * 8, 1)] * 40,  # one value: the first entry gets all, the others stay
        [(i, [float(i)] * (3 + i % 3), None) for i in range(30)],  # filled up with zeros
        [(1, [], 1), (2, [], None)],
        [(3, [0.25, -0.25], 1)],
    ]
    for rows in cases:
        assert _coded(_vectors(spark, rows)) == _lloyd(rows)
    assert _coded(_vectors(spark, cases[0]).limit(0)) == []


def test_cover_tree_invariants_and_pruning():
    rng = np.random.default_rng(2)
    points = np.concatenate([c + rng.integers(-40, 40, (300, 4)) for c in rng.integers(-9000, 9000, (8, 4))])
    tree = vector_codes.cover_tree(points)
    for node in range(len(tree.centre)):
        own = points[tree.order[tree.start[node] : tree.stop[node]]]
        assert (tree.sums[node] == own.sum(axis=0)).all()
        far = np.sqrt(((own - points[tree.centre[node]]) ** 2).sum(axis=1).max())
        assert far <= tree.reach[node]
        below = range(tree.child[node], tree.child[node] + tree.children[node])
        if below:
            assert tree.start[below[0]] == tree.start[node] and tree.stop[below[-1]] == tree.stop[node]
            assert tree.centre[below[0]] == tree.centre[node]  # nets are nested
    codes = np.full(len(points), -1)
    n, total, compared = vector_codes.assign(tree, points, points[::300].copy(), codes)
    expected = vector_codes.squared(points, points[::300]).argmin(axis=1)
    assert (codes == expected).all() and (n == np.bincount(expected, minlength=8)).all()
    assert compared < len(points) / 10  # whole subtrees were assigned


# --- Merkle manifest ------------------------------------------------------------


def _field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def _tree(digests):
    """Root, and for each digest the siblings before and after it, level by level."""
    paths, level, at = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(level) > 1:
        for i, path in enumerate(paths):
            run = at[i] // 3
            path.append(("".join(level[3 * run : at[i]]), "".join(level[at[i] + 1 : 3 * run + 3])))
            at[i] = run
        level = [sha("".join(level[k : k + 3])) for k in range(0, len(level), 3)]
    return level[0], paths


def _manifest(rows):
    """Contract rows by hand."""
    sources = collections.defaultdict(list)
    for r in rows:
        head = "".join(_field(r[c]) for c in ("doc_id", "source", "lang", "n_chars"))
        leaf = now = sha(head + _field(r["text"]))
        if r["doc_id"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
            now = sha(head + _field(r["text"].replace("\n", "")))
        sources[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf, now, r["doc_id"]))
    if not sources:
        return []
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = [_tree([x[2] for x in sorted(sources[s])]) for s in names]
    root, tops = _tree([t[0] for t in trees])
    out = []
    for name, (subroot, paths), top in zip(names, trees, tops):
        for (_, _, leaf, now, doc_id), path in zip(sorted(sources[name]), paths):
            folded, proof = now, ""
            for before, after in path + top:
                folded, proof = sha(before + folded + after), proof + before + after
            out.append((str(doc_id), leaf, subroot, root, sha(proof), folded, folded == root))
    return sorted(out)


def _documents(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    return frame.select("*", *[F.lit("clash").alias(c) for c in ("tree", "node", "digest", "proof", "position", "_group", "now")])


def _proved(docs):
    found = merkle.verify_tampered(docs, F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", ""))
    columns = ["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
    return sorted((str(r[0]), *r[1:4], sha(r[4]), *r[5:]) for r in found.select(*columns).collect())


def _odd_rows(n, sources):
    rng = random.Random(n)
    rows = []
    for i in range(n):
        source = rng.choice(sources) if rng.random() < 0.6 else sources[0]  # one source holds most rows
        text = rng.choice([None, "", "one line", "two\nlines\n", "äöü\n\U0001f600"])
        rows.append((rng.choice([i, i // 2, None]), source, rng.choice([None, "en"]), rng.choice([None, 5]), text))
    return rows + rows[: n // 3]


@pytest.mark.parametrize("n, sources", [(1, ["a"]), (1, [None]), (2, ["a"]), (3, ["a", "b"]), (40, ["b", None, "ä", "", "c", "d", "e"]), (150, ["x"])])
def test_manifest_equals_brute_force(spark, n, sources):
    rows = _odd_rows(n, sources)
    names = ("doc_id", "source", "lang", "n_chars", "text")
    assert _proved(_documents(spark, rows)) == _manifest([dict(zip(names, r)) for r in rows])


def test_manifest_climbs_by_shuffle_where_nodes_are_many(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_NODES", 4)
    rows = _odd_rows(120, ["b", None, "c", "d", "e"])
    names = ("doc_id", "source", "lang", "n_chars", "text")
    assert _proved(_documents(spark, rows)) == _manifest([dict(zip(names, r)) for r in rows])


def test_manifest_of_no_rows(spark):
    assert _proved(_documents(spark, []).limit(0)) == []


def test_equal_rows_are_cut_between_ranges(spark):
    """A third of all rows being one row repeated doesn't make one range."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit("s").alias("g"))
    found = merkle.numbered(rows.repartition(4), F.col("g"), [F.col("k")])
    got = sorted((r["k"], r["position"]) for r in found.collect())
    assert sorted(p for _, p in got) == list(range(3000)) and got == sorted(got, key=lambda x: x[1])
    assert {r["group_rows"] for r in found.collect()} == {3000}


def test_new_queries_keep_every_row(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    for query in (queries.substring_dedup, queries.merkle_manifest):
        assert query(spark, SF).count() == documents.count()
