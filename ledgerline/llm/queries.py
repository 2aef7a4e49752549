"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    byte_bpe, decontamination, exact_topk, jaccard_join, language_id, merkle, repeats, surrogates, token_counts, tool_calls,
    toxicity, vector_codes, warc,
)
from ledgerline.llm.common import crc_mod, ship

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PRE_TOKENS = public_tokenizers.PATTERN
Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of ``conversations``, linked, ordered, validated and serialised."""
    return tool_calls.link(tool_calls.messages_of(_table(spark, sf_dir, "conversations")), tool_calls.SCHEMAS)


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class of near copies (by its smallest document id) and its number of links."""
    found = jaccard_join.join(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "copy_of", "n_copies")


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 4) == 2
    return language_id.predict(docs, language_id.fit(docs, ~held_out), held_out)


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return exact_topk.top_k(vectors, "vec_id", "embedding", F.col("vec_id") % 20 == 0)


def wordpiece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, token_counts.share_vocabulary(spark, VOCABULARY))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    model = toxicity.fit(docs, labels, crc_mod("doc_id", 5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document and benchmark item that overlap."""
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf_dir, "pages"))


def pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates for its personal data."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.pseudonymise(docs, count_as="n_entities")


def byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return byte_bpe.digests(byte_bpe.round_trip(docs, byte_bpe.share_vocabulary(spark, VOCABULARY), PRE_TOKENS))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document once repeated passages are removed."""
    return repeats.digests(repeats.remove_repeats(_table(spark, sf_dir, "documents")))


def vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    coded, books = vector_codes.compress(vectors, "vec_id", "embedding", "label")
    return vector_codes.digests(vector_codes.label_errors(coded), books, "vec_id")


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, where line feeds were deleted from some texts since the manifest was built."""
    found = merkle.verify_tampered(
        _table(spark, sf_dir, "documents"), crc_mod("doc_id", 2) == 0, F.translate("text", "\n", "")
    )
    return found.withColumn("proof", merkle.digest(F.col("proof"))).withColumnRenamed("proof", "proof_sha256")


REGISTRY: dict[str, Query] = {
    "op1_tool_call_linking": tool_call_linking,
    "op2_ngram_jaccard_join": ngram_jaccard_join,
    "op3_language_id": language,
    "op4_exact_top_k": exact_top_k,
    "op5_token_counts": wordpiece_counts,
    "op6_toxicity": toxicity_scores,
    "op7_decontamination": benchmark_overlap,
    "op8_warc_normaliser": warc_normaliser,
    "op9_pii_surrogates": pii_surrogates,
    "op10_byte_level_bpe": byte_level_bpe,
    "op11_substring_dedup": substring_dedup,
    "op12_vector_codes": vector_code_compression,
    "op13_merkle_manifest": merkle_manifest,
}


def _substring_dedup_sql() -> str:
    return f"""
        WITH d AS (
          SELECT row_number() OVER () AS u, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        windows AS (
          SELECT u, p, sha256(array_to_string(w[p : p + {repeats.LENGTH - 1}], ' ')) AS h
          FROM (SELECT u, w, unnest(range(1, len(w) - {repeats.LENGTH - 2})) AS p FROM d WHERE len(w) >= {repeats.LENGTH})),
        again AS (SELECT u, p FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
        words AS (SELECT u, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
        marked AS (
          SELECT words.*, coalesce(max(again.p) OVER (
                   PARTITION BY words.u ORDER BY words.p ROWS BETWEEN {repeats.LENGTH - 1} PRECEDING AND CURRENT ROW), 0) > 0 AS gone
          FROM words LEFT JOIN again ON again.u = words.u AND again.p = words.p),
        kept AS (
          SELECT u, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS text
          FROM marked GROUP BY u)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (u)"""


def _vector_codes_sql() -> str:
    size = "(len(e) // 8)"
    steps = ["""
        v AS (
          SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""
        s AS (
          SELECT row_number() OVER () AS u, vec_id, label, e FROM v),
        p AS (SELECT u, vec_id, label, k AS part, e[k * {size} + 1 : (k + 1) * {size}] AS x FROM s, range(0, 8) AS r(k))""",
        """
        b0 AS (
          SELECT part, dense_rank() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM p
          QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= 16)"""]  # fmt: skip

    def nearest(book: int) -> str:
        return f"""
        a{book} AS (
          SELECT u, part, x, min(entry) AS entry, min(dist) AS dist FROM (
            SELECT p.u, p.part, p.x, b.entry, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - b.x[i]) * (p.x[i] - b.x[i]))) AS dist
            FROM p JOIN b{book} b ON b.part = p.part
            QUALIFY dist = min(dist) OVER (PARTITION BY p.u, p.part))
          GROUP BY u, part, x)"""

    for i in range(vector_codes.ROUNDS):
        steps += [nearest(i), f"""
        m{i} AS (
          SELECT part, entry, i, CAST(floor(sum(x[i])::HUGEINT / count(*)) AS BIGINT) AS mean FROM a{i}, range(1, 9) AS r(i)
          WHERE i <= len(x) GROUP BY part, entry, i),
        c{i} AS (SELECT part, entry, list(mean ORDER BY i) AS x FROM m{i} GROUP BY part, entry),
        b{i + 1} AS (SELECT b.part, b.entry, coalesce(c.x, b.x) AS x FROM b{i} b LEFT JOIN c{i} c USING (part, entry))"""]  # fmt: skip
    last = vector_codes.ROUNDS
    return "WITH " + ",".join([*steps, nearest(last)]) + f""",
        coded AS (
          SELECT u, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error FROM a{last} GROUP BY u),
        listed AS (
          SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{last})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM s JOIN coded USING (u), listed"""


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text (polynomial 0xEDB88320), bit by bit."""
    step = "lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1))"
    byte = f"lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), {step})"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::UBIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::UBIGINT], {codes}), {byte}), 4294967295::UBIGINT)"


def _merkle_sql(lower: int = 10, upper: int = 8) -> str:
    """``lower`` and ``upper``: levels of the sources' trees and of the top tree (3 ** levels leaves are covered)."""

    def leaf(text: str) -> str:
        fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(" + " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE octet_length(encode({f})) || ':' || {f} END" for f in fields) + ")"

    # a table of ascending nodes: l<level>(tree, node, h), where trees of one node stay as they are
    def levels(name: str, n: int) -> list[str]:
        return [f"""
        {name}{i} AS (
          SELECT tree, node // 3 AS node, CASE WHEN max(m) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY node)) END AS h
          FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS m FROM {name}{i - 1}) GROUP BY tree, node // 3)""" for i in range(1, n + 1)]  # fmt: skip

    # a leaf's siblings and its fold, level by level
    def climb(out: str, start: str, name: str, n: int) -> list[str]:
        steps = []
        for i in range(n):
            before, after = (f"coalesce((SELECT string_agg(s.h, '' ORDER BY s.node) FROM {name}{i} s WHERE s.tree = c.tree "
                             f"AND s.node // 3 = c.node // 3 AND s.node {op} c.node), '')" for op in "<>")  # fmt: skip
            steps.append(f"""
        {out}{i + 1} AS (
          SELECT u, tree, node // 3 AS node, proof || b || a AS proof,
                 CASE WHEN m = 1 THEN fold ELSE sha256(b || fold || a) END AS fold
          FROM (SELECT c.*, (SELECT count(*) FROM {name}{i} s WHERE s.tree = c.tree) AS m, {before} AS b, {after} AS a
                FROM {out if i else start}{i or ''} c))""")
        return steps

    steps = [f"""
        d AS (
          SELECT row_number() OVER () AS u, doc_id, source, {leaf('text')} AS leaf, {leaf("replace(text, chr(10), '')")} AS other,
                 dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree FROM documents),
        docs AS (
          SELECT u, doc_id, leaf, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS node,
                 CASE WHEN {_crc32_sql('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN other ELSE leaf END AS now FROM d),
        l0 AS (SELECT tree, node, leaf AS h FROM docs)""", *levels("l", lower), f"""
        t0 AS (SELECT 0 AS tree, tree - 1 AS node, h FROM l{lower})""", *levels("t", upper), """
        begin AS (SELECT u, tree, node, '' AS proof, now AS fold FROM docs)""", *climb("c", "begin", "l", lower), f"""
        middle AS (SELECT u, 0 AS tree, tree - 1 AS node, proof, fold FROM c{lower})""", *climb("e", "middle", "t", upper)]  # fmt: skip
    return "WITH " + ",".join(steps) + f"""
        SELECT docs.doc_id, docs.leaf, l{lower}.h AS subroot, t{upper}.h AS root, sha256(e{upper}.proof) AS proof_sha256,
               e{upper}.fold AS folded_root, e{upper}.fold = t{upper}.h AS verified
        FROM docs JOIN e{upper} USING (u) JOIN l{lower} ON l{lower}.tree = docs.tree, t{upper}"""


ORACLE_SQL = {
    "op11_substring_dedup": _substring_dedup_sql(),
    "op12_vector_codes": _vector_codes_sql(),
    "op13_merkle_manifest": _merkle_sql(),
    "op1_tool_call_linking": """
        WITH RECURSIVE m AS (
          SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE role IN ('user', 'assistant', 'system')),
        calls AS (SELECT * FROM m WHERE role <> 'assistant'),
        lv AS (
          SELECT c.conv_id, c.turn, 0 AS level FROM calls c
          WHERE c.role = 'system' OR c.turn % 8 < 2
             OR NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
          UNION ALL
          SELECT c.conv_id, c.turn, lv.level + 2 FROM calls c JOIN lv ON lv.conv_id = c.conv_id AND lv.turn = c.turn - 2
          WHERE c.role = 'user' AND c.turn % 8 >= 2),
        x AS (
          SELECT m.*, CASE WHEN role = 'assistant' THEN 'result' ELSE 'call' END AS kind,
                 CASE WHEN role = 'assistant' THEN turn - 1 ELSE turn END AS call_turn FROM m),
        y AS (
          SELECT x.*, 'call_' || conv_id || '_' || call_turn AS call_id,
                 CASE role WHEN 'user' THEN 'answer' WHEN 'system' THEN 'configure' END AS tool,
                 EXISTS (SELECT 1 FROM calls c WHERE c.conv_id = x.conv_id AND c.turn = x.call_turn) AS called,
                 EXISTS (SELECT 1 FROM m r WHERE r.role = 'assistant' AND r.conv_id = x.conv_id AND r.turn = x.call_turn + 1) AS answered,
                 (SELECT level FROM lv WHERE lv.conv_id = x.conv_id AND lv.turn = x.call_turn) + CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS level,
                 role = 'user' AND turn % 8 >= 2
                   AND NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = x.conv_id AND p.turn = x.turn - 2) AS dangling
          FROM x),
        z AS (
          SELECT y.*, array_to_string(list_filter([
              CASE WHEN role = 'user' AND text IS NULL THEN 'prompt: missing'
                   WHEN role = 'user' AND length(text) < 40 THEN 'prompt: too short' END,
              CASE WHEN role = 'user' AND turn < 0 THEN 'turn: too small' WHEN role = 'user' AND turn > 1000 THEN 'turn: too large' END,
              CASE WHEN role = 'system' AND text IS NULL THEN 'instructions: missing'
                   WHEN role = 'system' AND length(text) > 400 THEN 'instructions: too long' END,
              CASE WHEN dangling THEN 'unknown call call_' || conv_id || '_' || (turn - 2) END], lambda e: e IS NOT NULL), '; ') AS errors
          FROM y)
        SELECT conv_id, turn, kind, call_id, tool,
               CASE WHEN kind = 'call' AND NOT answered THEN 'unanswered'
                    WHEN kind = 'result' AND NOT called THEN 'orphan' ELSE 'linked' END AS status,
               CAST(level AS INTEGER) AS level,
               row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(level, 1073741824), turn, kind, call_id) AS position,
               errors = '' AS valid, errors,
               CASE role WHEN 'user' THEN '{' || CASE WHEN text IS NULL THEN '' ELSE '"prompt":' || CAST(to_json(text) AS VARCHAR) || ',' END
                                          || '"turn":' || turn || '}'
                         WHEN 'system' THEN CASE WHEN text IS NULL THEN '{}' ELSE '{"instructions":' || CAST(to_json(text) AS VARCHAR) || '}' END
                         ELSE CASE WHEN text IS NOT NULL THEN '{"content":' || CAST(to_json(text) AS VARCHAR) || '}' END END AS canonical
        FROM z""",
    "op8_warc_normaliser": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
        d AS (SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d),
        r AS (SELECT *, payload_bytes >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id AS again FROM f)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN first_id END AS refers_to, TRUE AS intact
        FROM r""",
    "op4_exact_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        q AS (SELECT * FROM v WHERE vec_id % 20 = 0),
        s AS (
          SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
          FROM q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e)),
        k AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 20""",
}
