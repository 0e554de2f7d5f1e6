"""The named queries of this subpackage, each over its whole table, and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import (
    block_topk, collocations, compression_quality, merkle, minhash, mixing, ppm, range_join, relative_lz, secret_scan,
    simple8b, suffix_pieces, text_cnn,
)
from tarmac.llm.common import fold, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _held_out(parts: int, which: int):
    """Rows that nothing is learned from; those without an id are among them."""
    return F.coalesce(fold("doc_id", parts) == which, F.lit(True))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_join.link_similar(table(spark, sf_dir, "embeddings"), 0.98)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", _held_out(3, 1))
    model = ppm.learn(docs.filter(~F.col("held_out")))
    return ppm.identify(docs.select("doc_id", "held_out", "text"), model)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.round_trip(table(spark, sf_dir, "documents"), TOKENIZER)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_pieces.encode(docs, suffix_pieces.load_pieces(PIECES))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", _held_out(5, 0))
    labels = table(spark, sf_dir, "labels").filter(~_held_out(5, 0))
    model, share = compression_quality.learn(docs, labels, "quality")
    return compression_quality.assess(docs.select("doc_id", "held_out", "text"), model, share)


def op8_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_topk.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", _held_out(4, 2))
    labels = table(spark, sf_dir, "labels").filter(~_held_out(4, 2))
    model, share = text_cnn.learn(docs, labels, "toxic")
    return text_cnn.classify(docs.select("doc_id", "held_out", "text"), model, share)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_manifest(table(spark, sf_dir, "documents"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = relative_lz.without_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents").select("lang", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_embedding_near_dedup, op2_mixing, op3_minhash_near_dedup, op4_language_id, op5_token_files,
             op6_sentencepiece, op7_quality, op8_top_products, op9_secret_scan, op10_toxicity, op11_merkle_manifest,
             op12_substring_dedup, op13_collocations)
    return {f.__name__: f for f in found}


OP1_SQL = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), linked AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reached AS (
    SELECT a, b FROM linked UNION SELECT r.a, l.b FROM reached r JOIN linked l ON r.b = l.a
), least AS (
    SELECT a, least(a, min(b)) AS m FROM reached GROUP BY a
), counted AS (
    SELECT a, count(*) AS n FROM linked GROUP BY a
)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(m, e.vec_id) AS component_id,
       e.vec_id = coalesce(m, e.vec_id) AS kept
FROM embeddings e LEFT JOIN least ON least.a = e.vec_id LEFT JOIN counted ON counted.a = e.vec_id
"""

OP8_SQL = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
    FROM whole q JOIN whole d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v) WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


# crc32 bit by bit: a list entry below 256 is the next byte, 256 asks for a shift
OP11_SQL = """
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(' ' || lang, '') AS k,
           (CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END)
           || (CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END)
           || (CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END) AS head,
           n_chars::HUGEINT AS chars,
           CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
           xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
               lambda c: [ascii(c)::BIGINT, 256, 256, 256, 256, 256, 256, 256, 256]))),
               lambda a, b: CASE WHEN b < 256 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END),
               4294967295) % 7 = 0 AS tampered
    FROM documents
), leaves AS (
    SELECT r, doc_id, k, tampered,
           sha256(head || (CASE WHEN chars IS NULL THEN '-' ELSE strlen(chars::VARCHAR) || ':' || chars END) || tail) AS leaf,
           sha256(head || (CASE WHEN chars IS NULL THEN '-' ELSE strlen((chars + 1)::VARCHAR) || ':' || (chars + 1) END) || tail) AS other
    FROM docs
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS idx, count(*) OVER (PARTITION BY k) AS n
    FROM leaves
), nodes AS (
    SELECT k, 0 AS lvl, idx, n, leaf AS h FROM placed
    UNION ALL
    SELECT k, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1
    GROUP BY k, lvl, idx // 2, n
), tops AS (
    SELECT k, h AS subroot, row_number() OVER (ORDER BY k) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper AS (
    SELECT 0 AS lvl, idx, n, subroot AS h FROM tops
    UNION ALL
    SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM upper WHERE n > 1 GROUP BY lvl, idx // 2, n
), climb AS (
    SELECT r, k, 0 AS lvl, idx, n, CASE WHEN tampered THEN other ELSE leaf END AS folded, '' AS beside FROM placed
    UNION ALL
    SELECT c.r, c.k, c.lvl + 1, c.idx // 2, (c.n + 1) // 2,
           sha256(CASE WHEN c.idx % 2 = 1 THEN s.h || c.folded ELSE c.folded || coalesce(s.h, '') END), c.beside || coalesce(s.h, '')
    FROM climb c LEFT JOIN nodes s ON s.k = c.k AND s.lvl = c.lvl AND s.idx = xor(c.idx, 1) WHERE c.n > 1
), rise AS (
    SELECT c.r, 0 AS lvl, t.idx, t.n, c.folded, c.beside FROM climb c JOIN tops t ON t.k = c.k WHERE c.n = 1
    UNION ALL
    SELECT c.r, c.lvl + 1, c.idx // 2, (c.n + 1) // 2,
           sha256(CASE WHEN c.idx % 2 = 1 THEN s.h || c.folded ELSE c.folded || coalesce(s.h, '') END), c.beside || coalesce(s.h, '')
    FROM rise c LEFT JOIN upper s ON s.lvl = c.lvl AND s.idx = xor(c.idx, 1) WHERE c.n > 1
)
SELECT p.doc_id, p.leaf, t.subroot, u.h AS root, sha256(e.beside) AS proof_sha256, e.folded AS folded_root, e.folded = u.h AS verified
FROM placed p JOIN rise e ON e.r = p.r AND e.n = 1 JOIN tops t ON t.k = p.k CROSS JOIN (SELECT h FROM upper WHERE n = 1) u
"""


OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), grams AS (
    SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2), lambda i: words[i : i + size - 1])) AS gram
    FROM worded, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE len(words) >= size
), counted AS (
    SELECT lang, size, gram, count(*) AS f FROM grams GROUP BY lang, size, gram HAVING size = 1 OR count(*) >= 100
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT * FROM counted WHERE size > 1
), contained AS (
    SELECT lang, f AS longer_f, unnest(flatten(list_transform(range(2, size),
        lambda m: list_transform(range(1, size - m + 2), lambda i: gram[i : i + m - 1])))) AS gram
    FROM candidates
), dropped AS (
    SELECT DISTINCT c.lang, c.gram FROM candidates c JOIN contained d ON d.lang = c.lang AND d.gram = c.gram
    WHERE 100 * d.longer_f >= 100 * c.f
), cuts AS (
    SELECT lang, gram, f, unnest(range(1, size)) AS k FROM candidates
), scored AS (
    SELECT c.lang, c.gram, c.f AS a, c.k, l.f AS l, r.f AS r, n, (1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS score
    FROM cuts c JOIN totals t ON t.lang = c.lang
    JOIN counted l ON l.lang = c.lang AND l.gram = c.gram[1 : c.k]
    JOIN counted r ON r.lang = c.lang AND r.gram = c.gram[c.k + 1 :]
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1
), ranked AS (
    SELECT lang, array_to_string(gram, ' ') AS phrase, a, l, r, n, score::BIGINT AS score,
           row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(gram, ' ')) AS rank
    FROM lowest WHERE NOT EXISTS (SELECT 1 FROM dropped d WHERE d.lang = lowest.lang AND d.gram = lowest.gram)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    """Only what SQL can express; the others are tested against brute force, libraries or held-out rows."""
    return {"op1_embedding_near_dedup": OP1_SQL, "op8_top_products": OP8_SQL, "op11_merkle_manifest": OP11_SQL,
            "op13_collocations": OP13_SQL}
