"""The pipeline operators as queries over the driver tables, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faresettle.llm import chat, collocations, decontaminate, language, lsh, mixing, pieces, quality, secrets, shards, simhash, warc, whitening

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score_documents(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents")).drop("n_linked")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        run.__name__: run
        for run in (
            op1_embedding_near_dedup, op2_sharding, op3_sentencepiece, op4_lm_scoring, op5_quality, op6_warc, op7_simhash, op8_secrets, op9_chat,
            op10_decontamination, op11_collocations, op12_language, op13_whitening,
        )
    }


WARC_SQL = """
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digests AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM payloads
), largest AS (
    SELECT payload_digest, max(page_id) AS page_id FROM digests WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT d.page_id, d.payload_bytes::BIGINT AS payload_bytes, d.payload_digest,
       CASE WHEN l.page_id <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN l.page_id <> d.page_id THEN l.page_id END AS refers_to
FROM digests d LEFT JOIN largest l ON d.payload_bytes >= 1000 AND l.payload_digest = d.payload_digest
"""

# All pairs of a label, which is for small tables only. Where hashing missed a pair, the query would differ.
NEAR_SQL = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
        AND len([c FOR c IN embedding IF c <> 0]) > 0
), links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
), reach(x, y) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT r.x AS vec_id, (SELECT count(*) FROM links WHERE links.x = r.x) AS n_links, min(r.y) AS component_id, min(r.y) = r.x AS kept
FROM reach r GROUP BY r.x
"""

# Here prefixes are compared as whole texts, not as hashes. Turns are numbered without gaps from 0 in the tables.
CHAT_SQL = """
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS size,
           '<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS line
    FROM conversations
), prefixes AS (
    SELECT conv_id, size, string_agg(line, '') OVER (PARTITION BY conv_id ORDER BY size) AS text FROM turns
), whole AS (
    SELECT conv_id, max(size) AS n_turns, arg_max(text, size) AS text FROM prefixes GROUP BY conv_id
), proper AS (
    SELECT DISTINCT p.size, p.text FROM prefixes p JOIN whole w ON p.conv_id = w.conv_id AND p.size < w.n_turns
), ends AS (
    SELECT min(conv_id) AS conv_id, n_turns, text, count(*) AS n_same FROM whole GROUP BY n_turns, text
)
SELECT conv_id, 0 AS part, n_turns, n_same, text
FROM ends WHERE NOT EXISTS (SELECT 1 FROM proper p WHERE p.size = ends.n_turns AND p.text = ends.text)
"""

# Every phrase is counted, nothing is left out on the way.
COLLOCATIONS_SQL = """
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
    SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts
), worded AS (
    SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') AS words FROM pieces
), phrases AS (
    SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase
    FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM worded, range(1, 6) AS sizes(size))
), f AS (
    SELECT lang, size, phrase, count(*) AS f FROM phrases GROUP BY ALL
), n AS (
    SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
), frequent AS (
    SELECT lang, size, phrase, f, string_split(phrase, ' ') AS words FROM f WHERE f >= 100
), inner_ones AS (
    SELECT lang, array_to_string(words[i : j], ' ') AS phrase, max(f) AS most
    FROM (SELECT lang, words, f, size, i, unnest(range(i + 1, size + 1)) AS j FROM (SELECT *, unnest(range(1, size)) AS i FROM frequent))
    WHERE j - i + 1 < size GROUP BY ALL
), candidates AS (
    SELECT c.* FROM frequent c LEFT JOIN inner_ones o ON o.lang = c.lang AND o.phrase = c.phrase
    WHERE size > 1 AND (most IS NULL OR 100 * most < 100 * f)
), cuts AS (
    SELECT lang, phrase, f AS a, k, array_to_string(words[1 : k], ' ') AS head, array_to_string(words[k + 1 : size], ' ') AS rest
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), scored AS (
    SELECT c.lang, c.phrase, a, k, h.f AS l, r.f AS r, n, (1000::HUGEINT * a * n) // (h.f::HUGEINT * r.f) AS score
    FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f r ON r.lang = c.lang AND r.phrase = c.rest JOIN n ON n.lang = c.lang
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""


def check_sql() -> dict[str, str]:
    return {"op1_embedding_near_dedup": NEAR_SQL, "op6_warc": WARC_SQL, "op9_chat": CHAT_SQL, "op11_collocations": COLLOCATIONS_SQL}
