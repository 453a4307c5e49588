"""The registered queries of this subpackage, each over its whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleskeep.llm import (
    context_mixing,
    decontamination,
    dual_tree,
    jaccard_tree,
    language_crf,
    packing,
    passages,
    quality_pu,
    sentencepiece_scan,
    sharding,
    token_counts,
    topk,
    whitening,
)
from saleskeep.llm.common import held_out, table
from saleskeep.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality by positive-unlabelled learning: doc_id, held_out, score, predicted."""
    scored = quality_pu.score_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out("doc_id", 3, 1), Workspace(spark)
    )
    return scored.select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies: doc_id, n_shingles, component_id, class_size, n_links."""
    return jaccard_tree.near_copies(table(spark, sf_dir, "documents"), Workspace(spark))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that repeat an earlier document."""
    return passages.find_passages(table(spark, sf_dir, "documents"), Workspace(spark))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and the number of tokens of every text."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded: doc_id, n_tokens, a hash of the ids, round_trip."""
    marked = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
    )
    encoded = sentencepiece_scan.encode(marked, Workspace(spark), keep=("doc_id", "text_hash")).select(
        "doc_id", "text_hash", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"), "ids"
    )
    same = F.xxhash64("decoded") == F.col("text_hash")
    return sentencepiece_scan.decode(encoded).select("doc_id", "n_tokens", "ids_hash", same.alias("round_trip"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every query: query_id, rank, vec_id, score."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, Workspace(spark))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every text: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = decontamination.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.hits(found).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text: doc_id, held_out, lang_pred, score."""
    documents = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 3, 1)
    found = language_crf.identify(documents, language_crf.fit(documents, ~out))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of all texts under a model of the training texts."""
    out = held_out("doc_id", 7, 2)
    scored = context_mixing.score_texts(table(spark, sf_dir, "documents"), ~out, Workspace(spark))
    return scored.withColumn("held_out", out)


def op11_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in sequences of 2048: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    cut = packing.pieces(table(spark, sf_dir, "documents"))
    marked = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(marked, Workspace(spark))


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item: item_id, rank, doc_id, score."""
    return dual_tree.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Workspace(spark))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the four components of largest variance, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), Workspace(spark))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_jaccard_join, op3_substring_dedup, op4_token_counts, op5_sentencepiece, op6_sharding, op7_topk_search,
        op8_benchmark_decontamination, op9_language_id, op10_lm_scoring, op11_bestfit_packing,
        op12_ranked_lexical_search, op13_embedding_whitening,
    )
}

ORACLES: dict[str, str] = {
    "op7_topk_search": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)::BIGINT) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS (
            SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS n FROM vectors
        ), scores AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(SUM(q.x * c.x) AS BIGINT) AS score
            FROM parts q JOIN parts c ON q.n = c.n AND q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
            GROUP BY q.vec_id, c.vec_id
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM scores
        QUALIFY rank <= 5
    """,
    "op8_benchmark_decontamination": r"""
        WITH texts AS (
            SELECT 'd' AS kind, doc_id AS id, text FROM documents
            UNION ALL
            SELECT 'b', item_id, text FROM benchmark
        ), worded AS (
            SELECT kind, id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM texts
        ), windows AS (
            SELECT DISTINCT id AS item_id, len(part) AS n, array_to_string(part, ' ') AS win
            FROM (SELECT id, list_slice(w, s, s + least(10, len(w)) - 1) AS part
                  FROM (SELECT id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS s
                        FROM worded WHERE kind = 'b' AND len(w) > 0))
        ), places AS (
            SELECT id AS doc_id, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS win
            FROM (SELECT id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
                  FROM worded, (SELECT DISTINCT n FROM windows) WHERE kind = 'd')
        ), found AS (
            SELECT doc_id, s, n, item_id FROM places JOIN windows USING (n, win)
        ), hit AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM found))
            GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found)
            GROUP BY doc_id
        )
        SELECT d.id AS doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM worded d LEFT JOIN hit ON hit.doc_id = d.id LEFT JOIN items ON items.doc_id = d.id
        WHERE d.kind = 'd'
    """,
    "op12_ranked_lexical_search": r"""
        WITH documents_terms AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), items AS (
            SELECT item_id, unnest(regexp_extract_all(
                translate(min(text), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id
        ), asked AS (
            SELECT item_id, term, count(*) AS repeats FROM items GROUP BY ALL
        ), counts AS (
            SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM documents_terms WHERE len(w) > 0
        ), places AS (
            SELECT row, doc_id, len(w)::BIGINT AS n, unnest(w) AS term
            FROM (SELECT row_number() OVER () AS row, doc_id, w FROM documents_terms)
        ), held AS (
            SELECT row, doc_id, n, term, count(*)::BIGINT AS tf
            FROM places WHERE term IN (SELECT term FROM asked) GROUP BY ALL
        ), weighed AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
            FROM (SELECT term, count(*) AS df FROM held GROUP BY term), counts
        ), scores AS (
            SELECT item_id, row, doc_id, sum(repeats * weight * ((1000000000 * tf) //
                (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // n_terms)))))::BIGINT AS score
            FROM held JOIN weighed USING (term) JOIN asked USING (term), counts
            WHERE doc_id IS NOT NULL
            GROUP BY item_id, row, doc_id
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
               doc_id, score
        FROM scores WHERE score > 0
        QUALIFY rank <= 10
    """,
}
