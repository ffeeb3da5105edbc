"""The registered queries, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import read
from starloom.llm.decontaminate import find_leaks
from starloom.llm.divergence import source_divergence
from starloom.llm.exact_dedup import exact_dedup
from starloom.llm.language import identify_language
from starloom.llm.pieces import encode_pieces
from starloom.llm.pseudo_likelihood import score_documents
from starloom.llm.quality import score_quality
from starloom.llm.resampling import importance_ranks
from starloom.llm.simhash import as_hex, simhash_components
from starloom.llm.token_files import token_digests, write_token_files
from starloom.llm.toxicity import classify_toxicity
from starloom.llm.warc import read_warc, write_warc
from starloom.llm.word_bpe import encode_words
from starloom.scratch import scratch_path


def tokenizer_file(name: str) -> str:
    """Where the public tokenizer files lie; every worker has them in the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_file("piece_bpe_32k.model")
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_pieces(documents, model, decoded_column="decoded").drop("text")
    return encoded.withColumn("n_ids", F.size("ids").cast("long"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return find_leaks(documents, items)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"), digest_all=True)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_files")
    documents = read(spark, sf_dir, "documents")
    write_token_files(documents, path, tokenizer_file("byte_bpe_50k.json"))
    return token_digests(spark, path)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(read(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(read(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(read(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", as_hex(F.col("fingerprint")))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, target = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return importance_ranks(documents, target).drop("n_words", "text_md5")


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_words(documents, tokenizer_file("word_bpe_49k.json"))
    return encoded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_decontamination": op3_decontamination,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_token_files": op5_token_files,
    "op6_warc": op6_warc,
    "op7_language": op7_language,
    "op8_toxicity": op8_toxicity,
    "op9_pseudo_likelihood": op9_pseudo_likelihood,
    "op10_simhash": op10_simhash,
    "op11_resampling": op11_resampling,
    "op12_word_bpe": op12_word_bpe,
    "op13_divergence": op13_divergence,
}

ORACLE_SQL: dict[str, str] = {
    "op4_exact_dedup": """
        WITH texts AS (
            SELECT doc_id,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ), grouped AS (
            SELECT text, max(doc_id) AS keep_id, count(*) AS group_size
            FROM texts GROUP BY text
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept,
               sha256(text) AS text_sha256
        FROM texts JOIN grouped USING (text)
    """,
    "op6_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS html FROM pages
        ), sized AS (
            SELECT page_id, octet_length(encode(html)) AS payload_bytes,
                   sha1(html) AS payload_digest,
                   max(page_id) OVER (PARTITION BY html) AS largest
            FROM payloads
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> largest
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN largest END AS refers_to
        FROM sized
    """,
    "op13_divergence": """
        WITH rows AS (
            SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang,
                   coalesce(source, '') AS source,
                   regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x00-\\x60\\x7B-\\x7F]+') AS words
            FROM documents
        ), words AS (
            SELECT row, lang, source, unnest(words) AS term FROM rows
        ), counts AS (
            SELECT lang, source, term, count(*) AS n, count(DISTINCT row) AS docs
            FROM words GROUP BY ALL
        ), kept AS (
            SELECT lang, term, sum(n)::HUGEINT AS whole FROM counts
            GROUP BY lang, term HAVING sum(docs) >= 10
        ), langs AS (
            SELECT lang, count(*) AS v, sum(whole)::HUGEINT AS total FROM kept GROUP BY lang
        ), totals AS (
            SELECT lang, source, sum(n)::HUGEINT AS total
            FROM counts JOIN kept USING (lang, term) GROUP BY lang, source
        ), sources AS (
            SELECT lang, source, coalesce(t.total, 0)::HUGEINT AS total
            FROM (SELECT DISTINCT lang, source FROM rows) LEFT JOIN totals t USING (lang, source)
        ), shares AS (
            SELECT k.lang, s.source, k.term, coalesce(c.n, 0) AS n,
                   1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (s.total + 2 * l.v) AS p,
                   1 + 1000000000::HUGEINT * (k.whole + 2) // (l.total + 2 * l.v) AS q
            FROM kept k JOIN langs l USING (lang) JOIN sources s USING (lang)
            LEFT JOIN counts c ON c.lang = k.lang AND c.source = s.source AND c.term = k.term
        ), sums AS (
            SELECT a.lang, a.source, b.source AS item,
                   sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
            FROM shares a JOIN shares b USING (lang, term)
            WHERE a.source <> b.source GROUP BY ALL
        ), found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                   coalesce(s.value, 0)::BIGINT AS value
            FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT
            FROM shares WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, row_number() OVER (
                PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank
            FROM found
        )
        SELECT lang, source, part, item, value, rank FROM ranked
        WHERE part = 'pair' OR rank <= 10
    """,
}
