"""From raw documents to packed training sequences, in stages that each keep what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns the columns of documents; the last one returns the
packed pieces. run() writes each stage's rows in the shared scratch folder and rereads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.llm import common, language, packing, quality, simhash


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents whose language is not determined or whose text fits no language's limit.

    Null and empty texts and texts without a letter go. Long texts are read whole. Rows that repeat an id or a
    text are judged each for itself, alike. Columns keep their names, whatever they are; no rows give no rows.
    """
    model = language.fit(docs.filter(~common.held_out()))
    lang, score, accepted = common.free_names(docs, "_lang", "_score", "_accepted")
    return language.identify(docs, model, names=(lang, score, accepted)).filter(F.col(accepted)).select(*docs.columns)


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that the quality model scores under its threshold.

    Null texts are scored as empty ones. Long texts are read whole. Rows that repeat an id or a text are scored each
    for itself, alike. Without labels all score 0.5 and stay. Columns keep their names,
    whatever they are; no rows give no rows.
    """
    labels = common.table(spark, sf_dir, "labels").filter(~common.held_out())
    model = quality.learn(docs, labels)
    (score,) = common.free_names(docs, "_score")
    return quality.score(docs, model, name=score).filter(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates.

    A change of one word touches five shingles of five words, but one word: texts whose five-word
    shingles agree to 0.8 differ by some 10 of 64 bits in fingerprints over such shingles, too many for
    covering hashing, and by some 4 bits in fingerprints over their different words. So the stage takes
    sixteen fingerprints over different words, each of them over hashes mixed anew, links what differs in
    up to 2 bits in any of them, and keeps the links whose texts share at least 0.8 of their five-word
    shingles.
    """
    return simhash.drop_near_duplicates(docs, radius=2, shingle=1, distinct=True, count=16, words=5, least=0.8)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece.

    Null and empty texts are pieces of the one closing id. Long texts are cut into pieces. Repeated rows are packed as
    often as they stand there; equal pieces are ranked alike by all their columns. Other columns are not read; no rows
    give no pieces.
    """
    pieces = packing.tokenised_pieces(docs)
    return packing.pack(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))


STAGES = [
    ("language", keep_known_languages),
    ("quality", keep_good_quality),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("packing", pack_sequences),
]

#: Models, fingerprints and tokens are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return docs
