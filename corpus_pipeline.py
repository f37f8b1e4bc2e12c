"""From raw documents to token ids: five stages, each written and read again.

The stages call the operators of ``ridgeline.llm`` with their production
parameters. A stage sees all that the one before kept, and all but the last return
the columns of ``documents``; other columns are left behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm import decontaminate, language, pieces, simhash, substrings
from ridgeline.llm.queries import PIECE_MODEL, table
from ridgeline.runtime import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null texts, texts with no letter) go; a missing ``lang`` is filled in."""
    told = language.predict(docs, language.train(docs), carry=COLUMNS).where(F.col("lang_pred") != language.UNKNOWN)
    return told.select(*[f"row.{c}" for c in COLUMNS], "lang_pred").withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document that names it stays. Rows sharing an id stay or go together."""
    near = simhash.near_copies(docs)
    stay = near.where(F.col("component_id").eqNullSafe(F.col("doc_id"))).select(F.col("doc_id").alias("kept_id"))
    return docs.select(*COLUMNS).join(stay, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated windows are cut out of the texts; a document with nothing left goes."""
    rest = [c for c in COLUMNS if c != "text"]
    made = substrings.repeated_words(docs, carry=rest)
    left = made.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("cut_text").cast("long")).otherwise(F.col("row.n_chars"))
    return left.select(
        "row.doc_id", F.col("cut_text").alias("text"), "row.lang", "row.source", n_chars.alias("n_chars")
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents holding benchmark passages go."""
    made = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), carry=COLUMNS, unnamed=True)
    return made.where(~F.col("contaminated")).select(*[f"row.{c}" for c in COLUMNS])


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, and digests of the ids and of what they decode to."""
    made = pieces.encode(docs, PIECE_MODEL)
    return made.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_copies),
    ("substring dedup", cut_repeated_passages),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: Fingerprints, trained judges and pieces have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
    return docs
