"""Queries over the driver's tables, one for each training-data operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strataflow.llm.bpe import codec_digests
from strataflow.llm.crf import quality_scores
from strataflow.llm.fertility import fitted_rules
from strataflow.llm.jaccard import near_duplicates
from strataflow.llm.nnpu import toxicity_scores
from strataflow.llm.reshard import shard_digests
from strataflow.llm.sequences import sequence_round_trip
from strataflow.llm.tokens import count_tokens
from strataflow.llm.warc import warc_round_trip
from strataflow.llm.winnow import contamination_digests


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(_table(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence_round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op4_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_digests(_table(spark, sf_dir, "documents"))


def op5_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_token_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    vocabularies = tuple(map(public_tokenizers.path, ("piece_bpe_32k.model", "byte_bpe_50k.json")))
    return fitted_rules(docs, _table(spark, sf_dir, "labels"), vocabularies, carry=["doc_id"])


def op8_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digests(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return codec_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, carry=["doc_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_token_counts": op2_token_counts,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_flow_resharding": op4_flow_resharding,
    "op5_line_crf": op5_line_crf,
    "op6_token_fertility": op6_token_fertility,
    "op7_arrow_sequences": op7_arrow_sequences,
    "op8_nnpu_toxicity": op8_nnpu_toxicity,
    "op9_winnowing": op9_winnowing,
    "op10_byte_bpe": op10_byte_bpe,
}

_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op1_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
        d AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
        f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM d LEFT JOIN f USING (payload_digest)
    """,
    "op3_ngram_jaccard": f"""
        WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 0 THEN 'text ' || text WHEN len(w) < 5 THEN 'words ' || array_to_string(w, ' ') ELSE array_to_string(w[i : i + 4], ' ') END AS g
              FROM (SELECT doc_id, text, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * shared >= 4 * (x.n + y.n - shared)),
        reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, l.b FROM reach r JOIN l ON l.a = r.other),
        classes AS (SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id),
        sets AS (SELECT doc_id, md5(string_agg(g, chr(31) ORDER BY g)) AS k FROM s GROUP BY doc_id)
        SELECT d.doc_id, class_id, CAST(coalesce(k.links, 0) AS BIGINT) AS n_links, CAST(count(*) OVER (PARTITION BY sets.k) - 1 AS BIGINT) AS n_copies
        FROM d JOIN classes USING (doc_id) JOIN sets USING (doc_id) LEFT JOIN (SELECT a, count(*) AS links FROM l GROUP BY a) k ON k.a = d.doc_id
    """,
    "op9_winnowing": f"""
        WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format("text")} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
        bw AS (SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS k
               FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i
                     FROM (SELECT *, least(10, len(w)) AS n FROM b WHERE len(w) > 0))),
        dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS k
               FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                     FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
        hits AS (SELECT doc_id, i, n, item FROM dw JOIN bw USING (n, k)),
        marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
        named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
}
