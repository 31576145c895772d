"""From raw documents to packed sequences in five stages, each applying one operator of `tidemark.llm`.

language ID        drops texts that are in no learned language (no letters, null, or mostly unknown 3-grams)
n-gram Jaccard     keeps the document with the smallest doc_id of each group (five-word shingles, similarity 0.8)
decontamination    drops documents that hold benchmark passages
secret scan        replaces secrets in the text
packing            deals the documents' tokens over sequences

All but the last return the columns of `docs`. Defined results for unusual input are the operators' own; beyond them:
where no row is labelled with a language only texts without a letter are dropped; of equal rows one stays, and of near copies
the one with the smallest doc_id (of one id, the smallest hash of its text); a row without a doc_id comes after all others;
very long texts are worked on whole, in one task each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import language_id, secrets
from tidemark.llm.decontamination import decontaminate
from tidemark.llm.jaccard_join import jaccard_components
from tidemark.llm.packing import pack
from tidemark.llm.queries import tokenizer_file
from tidemark.session import cut

#: A text is in no learned language where the learned sample has less than this part of its words' 3-grams, measured
#: against what a text of the learned languages reaches, whatever the number of labels. Code-switched texts stay. Texts of
#: fewer words say too little to be rejected for that.
MIN_KNOWN, MIN_JUDGED_WORDS = 0.75, 6
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def _prefix(docs: DataFrame, name: str) -> str:
    """A prefix that no column of `docs` begins with."""
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs)
    if not model.labels:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    p = _prefix(docs, "_language_")
    found = language_id.label(docs, model, docs.columns, prefix=p, known=True)
    fits = (F.col(f"{p}known") >= MIN_KNOWN) | (F.col(f"{p}n_labelled") < MIN_JUDGED_WORDS)
    return found.where((F.col(f"{p}lang_pred") != language_id.UNKNOWN) & fits).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are told apart by doc_id and text, so each row of an id that several texts have is judged by itself; the first of a
    group stays, rows without an id coming last."""
    key = [F.col("doc_id").isNull().alias("nameless"), F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType)).alias("id"), F.xxhash64("text").alias("h")]
    found = jaccard_components(docs.select(F.struct(*key).alias("doc_id"), "text"), n=SHINGLE_WORDS, percent=SIMILARITY_PERCENT)
    p = _prefix(docs, "_near_")
    stays = found.where("doc_id = component_id").select(F.col("doc_id").alias(f"{p}key")).distinct()
    once = docs.withColumn(f"{p}key", F.struct(*key)).dropDuplicates([f"{p}key"])  # repeated rows are dropped before they are shuffled
    return once.join(stays, f"{p}key", "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    p = _prefix(docs, "_benchmark_")
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), docs.columns, prefix=p)
    return found.where(~F.col(f"{p}contaminated")).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs, secrets.fit(docs))
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(clean.schema["n_chars"].dataType))
    return clean


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_file(), end_id=0, capacity=2048)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

# Tokens, learned models and the packing program have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
