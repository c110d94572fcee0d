"""The corpus pipeline: a list of stages, each one operator over all documents it is given."""

from __future__ import annotations

from collections.abc import Callable

from barfold.llm import bpe, jaccard, labelled, language, mixing, toxicity  # first: the one import that may fail
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barfold.llm.queries import BLOCK_ROWS, REST_WEIGHT, WEIGHTS, table
from barfold.llm.texts import quoted, spare
from barfold.sources.scratch import materialise, release

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document whose share of known n-grams is below this is in none of the learned languages.
LEAST_LANGUAGE_SHARE = 0.4
#: Fewer characters are too little to say so; such a text goes only if it has no letter.
LEAST_CHARS = 20
#: The column that carries a document's place in the mixture.
PLACE = "position"
#: A document with this score or more is toxic.
TOXIC = 0.5


def _columns(docs: DataFrame) -> list[str]:
    return [quoted(c) for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those that resemble no learned language."""
    predicted, share = spare(docs, "lang_pred"), spare(docs, "score")
    scored = language.predict(docs, language.fit(docs, F.lit(True)), to=(predicted, share))
    short = F.char_length("text") < LEAST_CHARS
    kept = (F.col(predicted) != language.UNDETERMINED) & ((F.col(share) >= LEAST_LANGUAGE_SHARE) | short)
    return scored.where(kept).select(*_columns(docs))


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score as toxic, by a model of the labelled ones."""
    model = toxicity.fit(labelled.sample(docs, table(spark, sf_dir, "labels"), "toxic", F.lit(True), 5000))
    score = spare(docs, "score")
    return toxicity.score(docs, model, to=score).where(F.col(score) < TOXIC).select(*_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: the one with the smallest number.

    Rows that repeat that number are copies too, of which the first by text stays. Documents without a
    word or a number belong to no group and stay.
    """
    groups = jaccard.join(docs, jaccard.Rule(words=5, percent=80)).where("n_shingles > 0 and doc_id is not null")
    dropped = groups.where("component_id <> doc_id").select("doc_id").distinct()
    row, several = spare(docs, "row"), spare(docs, "several")
    repeated = groups.groupBy("doc_id").agg(F.count("*").alias(several)).where(F.col(several) > 1)
    first = Window.partitionBy("doc_id").orderBy(F.col("text"), *[F.col(c) for c in _columns(docs)])
    left = docs.join(dropped, "doc_id", "left_anti").select(*_columns(docs))
    once = (
        left.where("doc_id is not null").join(repeated.select("doc_id"), "doc_id", "left_semi")
        .withColumn(row, F.row_number().over(first)).where(F.col(row) == 1).select(*_columns(docs))
    )
    return left.join(repeated.select("doc_id"), "doc_id", "left_anti").select(*_columns(docs)).unionByName(once)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their place in the mixture, ``position``, from 0.

    The place is the decision of this stage, so it travels as a column; the order of rows and files means
    nothing. A column of that name is replaced. A null source, like one without a weight of its own, shares
    the rest's; rows that agree in their number are dealt by a hash of the row; no documents give none.
    """
    block = spare(docs, "block")
    return mixing.mix(docs, WEIGHTS, rest=REST_WEIGHT, block_rows=BLOCK_ROWS, to=(block, PLACE)).drop(block)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with its place in the mixture; documents that have none keep a null place.

    A null or empty text has no ids, other columns than those named are left out, rows that repeat are all kept.
    """
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"))
    place = F.col(PLACE) if PLACE in docs.columns else F.lit(None).cast("long").alias(PLACE)
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", place, "text"), tokenizer)
    return encoded.select("doc_id", "lang", "source", PLACE, F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("toxicity", toxic_documents),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: SQL cannot express the learned stages; tests/llm holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has stored."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir))
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
