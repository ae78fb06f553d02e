"""The registered queries of this folder: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from .byte_bpe import decode, encode
from .common import session_of
from .html_extract import extract_pages
from .language_id import identify
from .lexical_search import search_documents
from .packing import pack
from .quality import score_quality
from .secret_scan import find_secrets, spans_text
from .sharding import shard_digests
from .simhash_dedup import simhash_components
from .spelling import spelling_groups
from .substring_dedup import drop_repeats
from .topk_search import top_products
from .winnowing import CHARACTERS, compare_with_next, with_fingerprint_texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table_query(name: str, table: str):
    """Registers a function of (spark, table, folder) under `name`."""

    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(session_of(spark), spark.read.parquet(f"{folder}/{table}.parquet"), folder)

        run.__name__ = name
        run.__doc__ = function.__doc__
        QUERIES[name] = run
        return function

    return register


@table_query("op1_substring_dedup", "documents")
def op1(spark, documents, folder):
    found = drop_repeats(documents)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op1_substring_dedup"] = """
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), g AS (
    SELECT r, doc_id, p, array_to_string(w[p:p + 49], ' ') AS passage
    FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE doc_id IS NOT NULL AND len(w) >= 50)
), f AS (
    SELECT passage, min(doc_id) AS least FROM g GROUP BY passage
), gone AS (
    SELECT DISTINCT r, unnest(range(p, p + 50)) AS i FROM g JOIN f USING (passage) WHERE least < doc_id
), words AS (
    SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
), k AS (
    SELECT r, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""


@table_query("op2_best_fit_packing", "documents")
def op2(spark, documents, folder):
    return pack(documents, public_tokenizers.path("byte_bpe_50k.json"))


@table_query("op3_document_fingerprints", "documents")
def op3(spark, documents, folder):
    found = with_fingerprint_texts(compare_with_next(documents, k=CHARACTERS, unit="characters"), "fingerprint", "edited_fingerprint")
    edited = F.sha2("edited", 256).alias("edited_sha256")
    return found.select("doc_id", "n_chars", edited, "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@table_query("op4_secret_scan", "documents")
def op4(spark, documents, folder):
    found = find_secrets(documents)

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = spans_text(F.col("spans"), ("assign", "access", "hex"))
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), count("checked"),
        F.sha2(base, 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"),
    )


@table_query("op5_byte_bpe", "documents")
def op5(spark, documents, folder):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = decode(encode(documents, path, public_tokenizers.PATTERN), path)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@table_query("op6_html_extraction", "pages")
def op6(spark, pages, folder):
    return extract_pages(pages)


@table_query("op7_quality_classifier", "documents")
def op7(spark, documents, folder):
    return score_quality(documents, spark.read.parquet(f"{folder}/labels.parquet"))


@table_query("op8_language_id", "documents")
def op8(spark, documents, folder):
    return identify(documents)


@table_query("op9_topk_search", "embeddings")
def op9(spark, embeddings, folder):
    return top_products(embeddings, F.col("vec_id") % 20 == 0, k=20)


ORACLE["op9_topk_search"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@table_query("op10_simhash_dedup", "documents")
def op10(spark, documents, folder):
    found = simhash_components(documents, shingle=3, most_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@table_query("op11_sharding", "documents")
def op11(spark, documents, folder):
    placed = shard_digests(documents, shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@table_query("op12_spelling_variants", "documents")
def op12(spark, documents, folder):
    return spelling_groups(documents, drop_every=97)


@table_query("op13_lexical_search", "documents")
def op13(spark, documents, folder):
    return search_documents(documents, spark.read.parquet(f"{folder}/benchmark.parquet"))


ORACLE["op13_lexical_search"] = """
WITH terms AS (SELECT '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' AS pattern),
d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), (SELECT pattern FROM terms)) AS t FROM documents
), i AS (
    SELECT row_number() OVER () AS item, item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), (SELECT pattern FROM terms)) AS t FROM benchmark
), asked AS (
    SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(t) AS term FROM i) GROUP BY ALL
), p AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term
), s AS (
    SELECT count(*) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0
), w AS (
    SELECT term, CAST(floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s
), scored AS (
    SELECT item, item_id, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(t) * n) // l)))) AS BIGINT) AS score
    FROM asked JOIN w USING (term) JOIN p USING (term) JOIN d USING (r), s GROUP BY item, item_id, r
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
    FROM scored JOIN d USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
