"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)``.  All but the last return documents
with the columns of ``docs``: toxic and poor documents go, one document of each
near-duplicate group stays, and secrets are replaced in the text.  The last
stage returns the pieces of the packed sequences.  ``run`` writes what a stage
returns to the shared folder and gives the next stage what it reads there.
"""

import public_tokenizers
from pyspark.sql import functions as F

from millrace.llm.near_duplicates import Settings, near_duplicates
from millrace.llm.frames import listed, load
from millrace.llm.packing import pack_documents
from millrace.llm.quality import kept_documents
from millrace.llm.secret_scan import redacted
from millrace.llm.toxicity import labelled_texts, learn, score
from millrace.session import materialise, pin_settings, unused_name


#: Whole texts go to Python a thousand at a time: workers, and what hands rows to
#: them, hold that many at once.
BATCH_ROWS = 1_000


def _small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def drop_toxic(spark, docs, sf_dir):
    """Documents that score below a half; learned from all labelled documents.

    A null or empty text has no hit and stays unless most labelled documents are
    toxic; rows that repeat, also an id, and rows without an id are scored each
    on its own; an empty table stays empty.
    """
    _small_batches(spark)
    model = learn(labelled_texts(docs, load(spark, sf_dir, "labels"), F.lit(True)))
    name = unused_name(docs, "_score")
    return score(docs, model, name=name).filter(F.col(name) < 0.5).drop(name)


def drop_poor(spark, docs, sf_dir):
    """Documents that the quality rules keep.

    Null, empty and short texts go; rows that repeat, also an id, and rows
    without an id are judged each on its own; an empty table stays empty.
    """
    return kept_documents(docs)


def drop_near_duplicates(spark, docs, sf_dir):
    """The document with the smallest id of each group of at least 80 % common shingles.

    Of rows with one and the same id, the one stays whose columns have the
    smallest hash, in every run the same.  Rows without an id all stay, as do
    null and empty texts, which resemble nothing.
    """
    _small_batches(spark)
    groups = near_duplicates(docs, settings=Settings(percent=80))
    gone = listed(groups.filter("not kept").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    kept = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    return _one_per_id(kept)


def _one_per_id(docs):
    repeated = docs.filter("doc_id is not null").groupBy(F.col("doc_id").alias("_again")).count().filter("count > 1")
    repeated, rows = materialise(repeated.select("_again"), "repeated")
    if not rows:
        return docs
    single = docs.join(repeated, docs["doc_id"] == repeated["_again"], "left_anti")
    again = docs.join(repeated, docs["doc_id"] == repeated["_again"], "left_semi")
    first = F.min_by(F.struct(*docs.columns), F.xxhash64(F.to_json(F.struct(*docs.columns)))).alias("first")
    chosen = again.groupBy(F.col("doc_id").alias("_again")).agg(first).select("first.*")
    return single.unionByName(chosen)


def hide_secrets(spark, docs, sf_dir):
    """All documents, with a mark in place of each secret; n_chars follows.

    Null and empty texts hold none and stay as they are; so does every row,
    repeated or without an id.
    """
    clean = redacted(docs)
    if "n_chars" not in clean.columns:
        return clean
    kind = clean.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.length("text").cast(kind))


def pack_sequences(spark, docs, sf_dir):
    """The pieces of all documents in sequences of at most 2048 tokens.

    A null or empty text is a piece of one token, the end; rows that repeat are
    packed each on its own; an empty table gives no pieces.
    """
    _small_batches(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("near_duplicates", drop_near_duplicates),
    ("secret_scan", hide_secrets),
    ("best_fit_packing", pack_sequences),
]

# Learned lexicons, MinHash and tokenizers are beyond SQL; the tests compare each
# stage with a plain version instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows for the table of documents."""
    pin_settings(spark)
    sf_dir = sf_dir.rstrip("/")
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = materialise(stage(spark, docs, sf_dir), name)
    return docs
