"""From raw documents to packed training sequences, in five stages.

1. language_id drops documents that are in no language: those whose text has no
   letter, whatever their length.
2. line_dedup drops lines that a document with a smaller id has.
3. near_dedup keeps one document of each class of near-duplicates.
4. mix_sources repeats or drops documents, so that sources meet their targets.
5. pack cuts and packs what is left into sequences of 2048 tokens.

run() writes each stage's result to the shared folder and reads it again. A
repeated document of stage 4 is a repeated row, and is packed once for each.

All stages: an empty table gives an empty result; a null doc_id is kept and
stays null; rows that repeat an id are documents of their own, but share their
lines; columns beside doc_id, text, lang and source travel along, whatever their
names, and texts of any length are read whole.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.llm import langid, line_dedup, mixing, near_dedup, packing
from estatelake.llm.common import keep, table
from estatelake.ship import ship


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in a language; columns stay as they are. One rule holds for texts of all lengths: what is ``und`` goes.

    Null, empty and letterless texts go. Without any labelled document none has a
    language, and all go. Ties go to the language that sorts first.
    """
    return langid.identify(docs).filter("lang_pred <> 'und'").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that a document with a smaller id has; n_chars follows. No row goes.

    A text may become empty; a null text becomes an empty one. Documents without
    an id come after all others; among themselves, and rows of one id, they keep
    what they share.
    """
    out = line_dedup.dedup_lines(docs)
    return out.select(F.col("row").withField("text", F.col("kept")).withField("n_chars", F.length("kept").cast("long")).alias("row")).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, the one with the smallest id; columns stay as they are.

    Texts without a word (null, empty, white space) are no duplicates and all
    stay. Of rows that repeat id and text one stays, and any of them may.
    """
    return near_dedup.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes, none to three of a document; columns stay as they are.

    A null source is a source of its own; null and empty texts have size 0 and are
    taken at their source's rate, at no cost to its target. Reruns agree.
    """
    return mixing.take_copies(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the closing id alone; repeated rows are packed each.
    """
    return packing.pack(docs)


def _ready(stage):
    """A stage that first gives the library to executors that lack it."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language_id", _ready(identify_language)),
    ("line_dedup", _ready(drop_repeated_lines)),
    ("near_dedup", _ready(drop_near_duplicates)),
    ("mix_sources", _ready(mix_sources)),
    ("pack", _ready(pack_sequences)),
]

#: SQL can't express language models, MinHash and best fit: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
