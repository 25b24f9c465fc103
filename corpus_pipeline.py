"""Five stages that turn raw documents into token ids. Each takes (spark, docs, sf_dir), works on all rows its
predecessor kept, and is written and read again before the next; all but the last return the columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tableprep.llm.bpe import encode_bpe
from tableprep.llm.components import stored
from tableprep.llm.decontaminate import find_leaks
from tableprep.llm.language import UNDETERMINED, fit_context_trees, held_out, identify_language
from tableprep.llm.names import fresh
from tableprep.llm.secret_scan import find_secrets, redact
from tableprep.llm.simhash import near_duplicates

RANKS = "byte_bpe_50k.tiktoken"
#: A blind guess costs 8 bits a byte. Escapes make text of a script or tongue that no trees know cost 12 and more, odd text
#: of a known one costs up to 9.
MOST_BITS = 10.0
LEAST_SHARE = 0.5


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key, and its name: doc_id, which may be null, and 128 bits of hash of the text. It is never null,
    and in order of doc_id with null last. Only rows of the same id and text share it, and what a stage decides."""
    key = fresh(docs, "row_key")
    made = F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"),
        F.xxhash64(F.lit(1), "text").alias("more"))
    return docs.withColumn(key, made), key


def without(docs: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose key is not among ``dropped``."""
    gone = fresh(docs, "gone")
    return docs.join(dropped.select(F.col(key).alias(gone)), F.col(key) == F.col(gone), "left_anti")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text is judged, in small letters, by trees that were fitted on the other half of the ids, all if that half has
    no labelled text. Drops texts that are null or have no letter, those whose best language has less than ``LEAST_SHARE`` of probability, and
    those that cost ``MOST_BITS`` a byte or more, as text of a language that was not learned does. ``lang``, where there is such a
    column, becomes the language found."""
    rows, key = keyed(docs)
    small = rows.withColumn("text", F.lower("text"))
    judged = []
    for fold in (0, 1):
        own = held_out("doc_id", 2, fold)
        trees = fit_context_trees(small.where(~own))
        judged.append(identify_language(small.where(own), trees if trees.languages else fit_context_trees(small), key))
    found = judged[0].unionByName(judged[1])
    sure = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SHARE) & (F.col("bits_per_byte") < MOST_BITS)
    kept_key, language = fresh(rows, "kept_key"), fresh(rows, "language")
    kept = found.where(sure).select(F.col(key).alias(kept_key), F.col("lang_pred").alias(language)).distinct()
    named = rows.join(kept, F.col(key) == F.col(kept_key))
    return named.select(*[F.col(language).alias(c) if c == "lang" else F.col(c) for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, once if its row is repeated. Of rows
    that share id and text but differ elsewhere, the one of smallest hash stays."""
    rows, key = keyed(docs)
    found = stored(near_duplicates(rows, key), "groups")
    first = F.col(key) == F.col("component_id")
    kept = without(rows, key, found.where(~first).select(key).distinct())
    repeated = found.where(first).groupBy(key).count().where("count > 1").select(key)
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    again = kept.join(repeated, key, "left_semi").groupBy(key).agg(
        F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row")).select("row.*")
    return without(kept, key, repeated).select(*docs.columns).unionByName(again)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that repeat a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, key = keyed(docs)
    return without(rows, key, find_leaks(rows, benchmark, key).select(key).distinct()).select(*docs.columns)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document; secrets in its text give way to a mark, and n_chars counts the text as it then is."""
    clean = redact(docs, find_secrets(docs))
    if "n_chars" not in docs.columns:
        return clean
    counted = F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", counted.cast(docs.schema["n_chars"].dataType))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang as the first stage found it, n_tokens, token_ids, and the bytes that the ids decode to: n_bytes and
    decoded_sha256."""
    path = public_tokenizers.path(RANKS)
    both = F.struct("doc_id", (F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")).alias("lang"))
    rows = docs.select(both.alias("row"), "text")
    return encode_bpe(rows, path, public_tokenizers.PATTERN, id_column="row", decoded=True).select(
        "row.doc_id", "row.lang", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
        F.octet_length("decoded").cast("long").alias("n_bytes"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", known_language),
    ("SimHash near-dedup", one_of_each),
    ("benchmark decontamination", uncontaminated),
    ("secret scans", redacted),
    ("byte-level BPE encoding and decoding", tokenised),
]

#: The stages count code lengths, fingerprints and merges, which SQL cannot express. tests/llm/test_pipeline_run.py holds
#: run() and every stage against plain Python on sf0.001.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return docs
