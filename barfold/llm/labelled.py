"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def draw(*key: Column | str) -> Column:
    """A number from 0 to below 1 by a hash of ``key``, in 2^53 steps, so that shares of any table are kept to."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11) / float(1 << 53)


def sample(
    documents: DataFrame,
    labels: DataFrame,
    target: str,
    usable: Column,
    per_class: int,
    *,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """About ``per_class`` rows (``text``, ``label``) of each of the classes 0 and 1.

    The rows are chosen by a hash of their key, so the choice does not depend on order or layout.
    Labels other than 0 and 1 and keys with two different labels are left out; a null text is empty.
    The chosen keys are bounded by ``per_class``, so they are broadcast.
    """
    clear = (
        labels.where(usable & F.col(target).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.min(target).alias("label"), F.max(target).alias("other"))
        .where("label = other").select("key", F.col("label").cast("int"))
    )
    counts = {r[0]: r[1] for r in clear.groupBy("label").count().collect()}
    share = F.when(F.col("label") == 1, min(1.0, per_class / counts.get(1, 1))).otherwise(
        min(1.0, per_class / counts.get(0, 1)))
    chosen = F.broadcast(clear.where(draw("key", F.lit(3)) < share))
    rows = documents.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.join(chosen, "key").select("text", "label")
