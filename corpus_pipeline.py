"""A corpus pipeline: quality rules, line dedup, near-duplicate documents, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before it kept.
Stages hand over the columns of ``documents``; the last one gives token ids. The near-duplicate
stage takes five words and 80 percent. Rows with an equal id and text share every decision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arenalake.llm import line_templates, mixing, quality_rules, signature_join, unigram
from arenalake.llm.components import written
from arenalake.llm.queries import tokenizer_file
from arenalake.sources.tables import read_table
from arenalake.storage import fresh_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned list rejects."""
    rules = quality_rules.fit_rules(docs, read_table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(docs, rules, "__q_")
    return judged.where("__q_kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines whose template an earlier document has; ``n_chars`` follows the text.

    Documents that lost lines are judged by the base rule of stage one again: what is left of a copy, or
    nothing, goes. Documents that lost none stay.
    """
    done = line_templates.drop_recurring_lines(docs)
    lost = F.col("__n_dropped") > 0
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    sound = quality_rules.passes_base_rule(F.when(lost, F.col("text")))
    kept = done.where(~lost | sound)
    return kept.withColumn("n_chars", F.when(lost, size).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the text of the lowest id (null ids last) and, of several
    texts of that id, of the lowest hash.

    Rows without words are in no group, and stay.
    """
    groups = written(
        signature_join.document_groups(docs, signature_join.Rule(words=5, percent=80)),
        "groups",
        "doc_id long, text_hash long, n_shingles long, root long",
    )
    chosen = signature_join.representatives(groups).select(
        F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("n").alias("__n")
    )
    own = F.xxhash64("text")
    kept = docs.join(chosen, F.col("doc_id").eqNullSafe(F.col("__doc")) & (own == F.col("__hash")))
    # Only texts that come in several equal rows are shuffled for it.
    again = Window.partitionBy("__doc", "__hash").orderBy(F.xxhash64(*(c for c in docs.columns if c != "text")))
    first = kept.where("__n > 1").withColumn("__rank", F.row_number().over(again)).where("__rank = 1")
    wordless = docs.where(~F.coalesce(F.col("text"), F.lit("")).rlike(line_templates.NO_BREAK))
    return kept.where("__n = 1").select(*docs.columns).unionByName(first.select(*docs.columns)).unionByName(wordless)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, and those of small sources up to one and a half times on average."""
    return mixing.mix_sources(docs, repetition_limit=1.5).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents but for the text, with its token ids and what they decode to."""
    vocabulary = unigram.load_vocabulary(tokenizer_file("piece_bpe_32k.model"))
    carried = [c for c in docs.columns if c != "text"]
    done = unigram.encode_documents(docs, vocabulary, carried)
    return done.select(*carried, "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("source mix", mix),
    ("SentencePiece", tokens),
]

#: SQL can express neither the learned rules nor the vocabulary; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each result is stored in the shared folder."""
    docs = read_table(spark, sf_dir, "documents").select(*COLUMNS)
    for k, (name, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        path = fresh_path(spark, f"pipeline-{k}")
        done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
    return docs
