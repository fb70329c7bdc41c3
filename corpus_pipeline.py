"""Corpus pipeline: documents -> packed training sequences.

STAGES run in order, each on all rows its predecessor kept; all but the last
give rows with the columns of documents.  Cleaned texts replace ``text`` and
``n_chars`` (where the table has it); documents without a word left go.

Defined cases: null and empty texts are rejected by the first stage.  Rows
that repeat an id and text are copies, of which one stays; rows without an
id are told apart by their text.  Extra columns pass through.  An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.llm import language_id, line_templates, packing, repeats, weighted_minhash
from lakeweave.llm.common import fresh, read, staged

HAS_WORD = r"[^ \t-\r]"


def _with_text(out: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` with ``text`` as the new text, where a word is left."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return out.filter(F.col(text).rlike(HAS_WORD)).select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents whose language is rejected go."""
    model = language_id.train(docs.filter(~language_id.held_out(F.col("doc_id"))))
    kept = language_id.predict(docs, model).filter(~F.col("rejected"))
    return kept.select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: lines of recurring templates go."""
    return _with_text(line_templates.without_templates(docs), docs, "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of each class of near-duplicates the document with the smallest id stays
    (of several texts with one id each is a document)."""
    key, one = fresh(docs, "key"), fresh(docs, "class_id")
    print_ = F.xxhash64("text")
    # ids that name one text are used as they are; rows without one, or of an id with several
    # texts, get a negative one of id and text
    plain = (docs.groupBy("doc_id").agg(F.min(print_).alias("_lo"), F.max(print_).alias("_hi"))
             .filter("doc_id is not null and _lo = _hi").select(F.col("doc_id").alias(one)))
    ident = F.when(F.col(one).isNotNull(), F.col("doc_id").cast("long")).otherwise(
        -1 - F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2))
    keyed = docs.join(plain, F.col("doc_id") == F.col(one), "left").select(*[docs[c] for c in docs.columns], ident.alias(key))
    # written once: the operator reads its input several times, and each time would join all texts anew
    keyed = staged(keyed, "near-keyed")
    kept = weighted_minhash.classes(keyed.select(key, "text"), id_col=key).filter("doc_id = class_id").select(
        F.col("doc_id").alias(one)).distinct()
    # both sides of the join lie by the key, so taking one row a key needs no further shuffle
    return keyed.join(kept, F.col(key) == F.col(one)).dropDuplicates([key]).select(*docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: repeated passages go, of each the earliest stays."""
    return _with_text(repeats.without_repeats(docs, as_text=True), docs, "kept")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one row a piece of a document in a sequence of 1024 tokens."""
    return packing.packed(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", drop_repeats),
    ("packing", pack),
]

ORACLE_SQL = None      # learned and index-based stages have no SQL; tests hold them against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
