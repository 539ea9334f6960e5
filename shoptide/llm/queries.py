"""The registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.llm.alignment import align_tokenizers
from shoptide.llm.decontaminate import items_digest, scan_benchmark
from shoptide.llm.html_text import extract_text
from shoptide.llm.licenses import scan_licenses
from shoptide.llm.linededup import dropped_lines
from shoptide.llm.nearcopies import near_duplicates
from shoptide.llm.neighbours import nearest_neighbours
from shoptide.llm.packing import pack
from shoptide.llm.periodic import find_runs
from shoptide.llm.quality import MAX_DOCS, MEASURES, quality_rules, words_of
from shoptide.llm.tokens import count_tokens
from shoptide.llm.toxicity import grade_toxicity, train
from shoptide.llm.warc import round_trip

CONTEXT = 4096
NOTICE_WORDS = 40


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dropped_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), F.col("toxic"))
    graded = grade_toxicity(docs, model)
    return graded.select("doc_id", "expected_severity", "p_toxic", "grade", (F.col("grade") > 0).alias("toxic"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_benchmark(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        items_digest(F.col("hit_items")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def packed_digest(docs: DataFrame) -> DataFrame:
    pieces = pack(docs, tokenizer_path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source"
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return packed_digest(docs)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "text")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, tokenizer_path("piece_bpe_32k.model"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long")).alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > CONTEXT).alias("over_limit"),
    )


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), size=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return read.select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files in directories by source and language. A document of at most NOTICE_WORDS words stands for a
    licence file: if it states a licence, that holds for its directory."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    files = docs.withColumn("path", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))
    short = F.size(F.split("text", r"\s+")) <= NOTICE_WORDS
    found = scan_licenses(files.select("doc_id", "path", "text"), licence_file=short)
    return found.select("doc_id", "license", "score", "origin", "license_path")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_neighbours(vectors, F.col("vec_id") % 100 == 0)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return quality_rules(docs).select("doc_id", *MEASURES, "base_failed", "kept")


def with_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the texts of one document in ten made to repeat a stretch of their words up to their end, as the contract says."""
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, words_of(F.coalesce("text", F.lit("")))))
    rows = rows.withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("if(n > 0, int(g % n), null)"))
    rows = rows.withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    again = F.expr("slice(concat(slice(w, 1, a), flatten(array_repeat(slice(w, a + 1, p), int((n - a + p - 1) div p)))), 1, n)")
    return rows.select("doc_id", F.when(F.col("n") > 0, F.concat_ws(" ", again)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_copies(table(spark, sf_dir, "documents"))
    # the words left take the text's column
    found = find_runs(docs.withColumnRenamed("text", "collapsed"), "collapsed")
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.start",
        "strongest.length",
        "strongest.period",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align_tokenizers(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))[0]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_packing": op4_packing,
    "op5_html_text": op5_html_text,
    "op6_token_counts": op6_token_counts,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_warc": op8_warc,
    "op9_licenses": op9_licenses,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_quality_rules": op11_quality_rules,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

ORACLES: dict[str, str] = {
    "op8_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS size FROM pages
        ), shared AS (
            SELECT *, CASE WHEN size >= 100 THEN min(page_id) OVER (PARTITION BY payload) END AS first FROM payloads
        )
        SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest,
            CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id > first THEN first END AS refers_to
        FROM shared
    """,
    "op11_quality_rules": rf"""
        WITH docs AS (
            SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS text FROM documents
        ), lines AS (
            SELECT k, doc_id, source, line,
                regexp_replace(regexp_replace(lower(trim(line, e' \t\n\x0b\f\r')), '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]', '0', 'g') AS plain
            FROM (SELECT *, unnest(string_split(text, e'\n')) AS line FROM docs)
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
        ), frequent AS (
            SELECT source, plain FROM lines GROUP BY ALL HAVING count(DISTINCT doc_id) > {MAX_DOCS}
        ), by_line AS (
            SELECT k, count(*) - count(DISTINCT line) AS n_dup_lines,
                sum(CASE WHEN frequent.plain IS NOT NULL THEN len(string_split(lines.plain, ' ')) ELSE 0 END) AS removed
            FROM lines LEFT JOIN frequent ON lines.source IS NOT DISTINCT FROM frequent.source AND lines.plain = frequent.plain
            GROUP BY k
        ), words AS (
            SELECT k, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs
        ), windows AS (
            SELECT k, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS three
            FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM words WHERE len(words) > 2)
        ), repeated AS (
            SELECT k, count(DISTINCT place) AS n_repeat_words FROM (
                SELECT k, unnest([i, i + 1, i + 2]) AS place FROM (SELECT *, count(*) OVER (PARTITION BY k, three) AS n FROM windows) WHERE n > 1
            ) GROUP BY k
        ), measured AS (
            SELECT docs.doc_id, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
                len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
                coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed, 0) AS removed
            FROM docs JOIN words USING (k) LEFT JOIN by_line USING (k) LEFT JOIN repeated USING (k)
        )
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
            CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
            n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_words - removed < 50 OR removed * 100 > n_words * 50) AS kept
        FROM measured
    """,
}
