"""The queries of this subpackage over the provided tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgstream.llm import (
    filteraudit,
    importance,
    linededup,
    mixing,
    neardup,
    packing,
    phrases,
    pieces,
    surrogates,
    topk,
    toxicity,
    urlrules,
    warc,
)
from msgstream.llm.common import table
from msgstream.scratch import shared_folder

TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def op1_keyed_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replaced(table(spark, sf_dir, "documents")).select("doc_id", "text", "entities")


def op2_locally_consistent_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.fingerprints(table(spark, sf_dir, "documents"))


def op3_b_bit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op4_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op5_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def packed(docs: DataFrame) -> DataFrame:
    """Pieces with a checksum of their ids in place of the ids."""
    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op6_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op7_url_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judged(table(spark, sf_dir, "pages"))


def op8_line_site_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = linededup.without_boilerplate(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "text", "n_chars", "lines_removed")


def op9_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(table(spark, sf_dir, "pages"), shared_folder(spark, "warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = toxicity.judged(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "p_low_quality", "p_toxic", "rejected")


def op11_sentencepiece_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pieces.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL), decode=True)
    ids, text = F.sha2("token_ids", 256), F.sha2(F.encode("decoded", "UTF-8"), 256)
    return rows.select("doc_id", "n_tokens", ids.alias("ids_sha256"), text.alias("decoded_sha256"))


def op12_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_keyed_surrogates,
        op2_locally_consistent_parsing,
        op3_b_bit_minhash,
        op4_pivotal_mixing,
        op5_ball_tree_top_k,
        op6_cost_balanced_packing,
        op7_url_association_rules,
        op8_line_site_spread,
        op9_zip_warc,
        op10_toxicity_chain,
        op11_sentencepiece_rounds,
        op12_filter_interactions,
        op13_importance_resampling,
    )
}

ORACLES = {
    # A line of 20 code points or more on five sources or more stays in the document of smallest id only.
    "op8_line_site_spread": """
        WITH lines AS (
            SELECT doc_id, source, n_chars, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS nr
            FROM documents
        ),
        common AS (
            SELECT line, min(doc_id) AS first_id FROM lines WHERE length(line) >= 20
            GROUP BY line HAVING count(DISTINCT coalesce(source, chr(1))) >= 5
        ),
        marked AS (
            SELECT l.*, c.line IS NOT NULL AND c.first_id <> l.doc_id AS common
            FROM lines l LEFT JOIN common c ON l.line = c.line
        ),
        texts AS (
            SELECT doc_id, any_value(n_chars) AS n_chars, sum(CASE WHEN common THEN 1 ELSE 0 END) AS lines_removed,
                   array_to_string(list(line ORDER BY nr) FILTER (NOT common), chr(10)) AS text
            FROM marked GROUP BY doc_id
        )
        SELECT doc_id, coalesce(text, '') AS text, CAST(lines_removed AS BIGINT) AS lines_removed,
               CASE WHEN lines_removed = 0 THEN n_chars ELSE length(coalesce(text, '')) END AS n_chars
        FROM texts
    """,
    # Failures as letters; a step removes what fails its filter and none before it.
    "op12_filter_interactions": r"""
        WITH texts AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ),
        labelled AS (
            SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
            FROM labels GROUP BY doc_id
        ),
        judged AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
                   || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
                   || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
                   || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                   || CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
            FROM texts d LEFT JOIN labelled l ON d.doc_id = l.doc_id
        ),
        counted AS (SELECT part, good, toxic, fails, count(*) AS n FROM judged GROUP BY ALL),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ),
        steps AS (
            SELECT filter_order, step, substring(filter_order, step, 1) AS filter,
                   '[' || substring(filter_order, 1, step) || ']' AS upto, '[-' || substring(filter_order, 1, step - 1) || ']' AS before
            FROM orders, (SELECT unnest(range(1, 6)) AS step)
        ),
        outcomes AS (
            SELECT part, filter_order, step, filter, n, good, toxic, fails = filter AS only_this,
                   NOT regexp_matches(fails, upto) AS stays, contains(fails, filter) AS failing,
                   regexp_matches(fails, before) AS gone
            FROM counted, steps
        ),
        summed AS (
            SELECT part, filter_order, step, filter, sum(CASE WHEN stays THEN n ELSE 0 END) AS kept,
                   sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END) AS removed,
                   sum(CASE WHEN failing AND gone THEN n ELSE 0 END) AS redundant,
                   sum(CASE WHEN only_this THEN n ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN failing AND NOT gone AND good THEN n ELSE 0 END) AS good_lost,
                   sum(CASE WHEN failing AND NOT gone AND toxic THEN n ELSE 0 END) AS toxic_lost
            FROM outcomes GROUP BY ALL
        )
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
        FROM summed
    """,
}
