"""One query per operator over its whole table, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontamination, jaccard_join, language_id, media, packing, personal_data, quality, secret_scan, spelling, token_counts, url_filters, warc_zip
from .common import table
from .oracles import OP11_SQL, OP12_SQL


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.model_of(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.archived(table(spark, sf_dir, "pages"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digest(personal_data.personal_data(table(spark, sf_dir, "documents")))


#: Only the pages' own rules decide in the driver's tables, whose html names no alias; the SQL says so much.
OP2_SQL = r"""
WITH cut AS (
    SELECT page_id, COALESCE(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           COALESCE(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages
), judged AS (
    SELECT *, CASE
        WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM cut
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM judged
"""

OP9_SQL = """
WITH sized AS (
    SELECT page_id, CAST(strlen(COALESCE(html, '')) AS BIGINT) AS payload_bytes, sha1(COALESCE(html, '')) AS payload_digest FROM pages
), first AS (
    SELECT payload_digest, max(page_id) AS first FROM sized WHERE payload_bytes >= 1000 GROUP BY 1
)
SELECT s.page_id, s.payload_bytes, s.payload_digest, CASE WHEN f.first <> s.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> s.page_id THEN f.first END AS refers_to
FROM sized s LEFT JOIN first f USING (payload_digest)
"""


def queries():
    return {f.__name__: f for f in (op1_token_counts, op2_url_filters, op3_best_fit_packing, op4_decontamination, op5_media_columns, op6_jaccard_join, op7_secret_scan, op8_language_id, op9_warc_packages, op10_quality_classifier, op11_conversation_repair, op12_spelling_variants, op13_personal_data)}


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filters": OP2_SQL, "op9_warc_packages": OP9_SQL, "op11_conversation_repair": OP11_SQL, "op12_spelling_variants": OP12_SQL}


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a known language; learns from the documents given.

    Null, empty and letterless texts go. Each row is judged by its own text, whatever its id; repeated rows share their
    fate; very long texts are read whole; an empty table stays empty; columns of any name pass through.
    """
    return language_id.known_language_only(docs, language_id.model_of(docs))


def stage_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near copies: five-word shingles, similarity 0.8.

    Null, empty and blank texts are copies of nothing and stay. Of repeated rows one stays, of a group one row of its
    smallest id, a null id only if there is no other. Very long texts are compared whole; an empty table stays empty; columns
    of any name pass through.
    """
    return jaccard_join.one_of_each(docs, width=5, percent=80)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs.

    Null and empty texts stay, as does everything if the benchmark is empty. Each row is judged by its own text; repeated
    rows share their fate; very long texts are read whole; an empty table stays empty; columns of any name pass through.
    """
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def stage_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts; the number of characters follows.

    No row goes. Null texts stay null and keep their number; empty ones stay empty. Repeated rows get equal texts; very long
    texts are masked throughout; an empty table stays empty; other columns pass through.
    """
    masked = secret_scan.redacted(docs)
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))).select(*docs.columns)


def stage_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens.

    Null texts count as empty, and an empty text is its end mark alone. Repeated rows are packed again; very long texts are
    cut into pieces of 2048 tokens; ties of length go by a hash; an empty table gives an empty one; further columns don't count.
    """
    return packing.pack(packing.token_pieces(docs, tokenizer_path("byte_bpe_50k.json")))


def run_stages(stages, spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each stage's rows are written to the shared folder and read as the next one's documents."""
    import uuid

    from .common import remove, shared_dir

    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(stages):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:  # what the stage before wrote is read by no one any more
            remove(spark, f"{folder}/{k - 1}")
    return docs
