"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

Rows of a source are dealt into blocks of ``block_rows`` by a hash order. Weights are integers, and a
frame is the time in which each source with rows left gets as many blocks as its weight says, so
all sources are exactly on target at frame boundaries. Within a frame, block k (from 0) of a source with
weight w is released when an ideal fluid schedule has served k of its blocks and is due when it has
served k + 1: at fluid time u (a share of the frame) source i has had min(w_i u, m_i) blocks, m_i
being what it has left, and slots are counted by the sum of these. Earliest deadline first over
released blocks gives each block a slot between the two, so no source is ever a whole block away
from its share. A source that runs out leaves its share to the others, in proportion to their weights; no row is
dropped or repeated.

Only the frame of a source's last block and the one after it differ from the frame before, so there are
at most two kinds of frame for each source. Each kind is scheduled once, by a fold over its slots; the number of sources and
the sum of weights are bounded by the parameter ``weights``, whatever the size of the data. Blocks
find their slot by a join with that small table. Rows of one source are numbered through counts per
hash range, so a source of any size is spread over ``RANGES`` parts.

Defined cases: a source not in ``weights`` (null included) belongs to the source ``REST``, with
weight ``rest``; a source's last block may be short; no rows give no rows. Rows that agree in the
order columns are dealt by a hash of the whole row, so only equal rows are interchangeable. Other columns are kept, and a
column with an output's name is replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barfold.llm.texts import quoted

REST = "*"
RANGES = 4096


def _frames(sources: DataFrame) -> DataFrame:
    """One row per kind of frame: its first frame and slot, the next kind's, and the blocks each source has."""
    every = sources.select(F.struct("source", "weight", "blocks").alias("s")).agg(F.sort_array(F.collect_list("s")).alias("sources"))
    # A kind of frame begins at 0, with the frame of a source's last block, and after that frame.
    cuts = every.select(
        "sources",
        F.explode(F.array_sort(F.array_distinct(F.flatten(F.transform("sources", lambda s: F.array(
            F.lit(0).cast("long"),
            F.floor((s["blocks"] - 1) / s["weight"]),
            F.floor((s["blocks"] - 1) / s["weight"]) + 1,
        )))))).alias("frame"),
    )
    ordered = Window.orderBy("frame")  # a few rows, two for each source
    left = F.transform("sources", lambda s: F.struct(
        s["source"].alias("source"), s["weight"].alias("weight"),
        F.greatest(F.lit(0).cast("long"), F.least(s["weight"], s["blocks"] - s["weight"] * F.col("frame"))).alias("blocks")))
    before = F.aggregate(F.transform("sources", lambda s: F.least(s["blocks"], s["weight"] * F.col("frame"))),
                         F.lit(0).cast("long"), lambda a, b: a + b)
    kinds = cuts.select("frame", before.alias("first_slot"), F.filter(left, lambda s: s["blocks"] > 0).alias("present"))
    return kinds.withColumn("next_frame", F.lead("frame").over(ordered)).where(F.size("present") > 0)


def _schedule(kinds: DataFrame) -> DataFrame:
    """``frame``, ``source``, ``k``, ``slot``: earliest deadline first within each kind of frame."""
    fluid = lambda k, w: F.aggregate(  # noqa: E731  weight w times the slots at fluid time k / w
        F.transform("present", lambda s: F.least(s["weight"] * k, s["blocks"] * w)),
        F.lit(0).cast("long"), lambda a, b: a + b)
    jobs = F.flatten(F.transform("present", lambda s: F.transform(
        F.sequence(F.lit(0).cast("long"), s["blocks"] - 1),
        lambda k: F.struct(
            F.ceil(fluid(k + 1, s["weight"]) / s["weight"]).alias("due"),
            s["source"].alias("source"), k.alias("k"),
            F.floor(fluid(k, s["weight"]) / s["weight"]).alias("release")))))
    # Sorted by deadline, so the first job that is released and not yet served is the one to run.
    listed = kinds.select("frame", "first_slot", "next_frame", F.array_sort(jobs).alias("jobs"))
    step = lambda state, slot: F.get(F.transform(
        F.slice(F.filter(state["open"], lambda j: j["release"] <= slot), 1, 1),
        lambda run: F.struct(
            F.filter(state["open"], lambda j: (j["source"] != run["source"]) | (j["k"] != run["k"])).alias("open"),
            F.concat(state["run"], F.array(F.struct(run["source"].alias("source"), run["k"].alias("k")))).alias("run"))), 0)
    start = F.struct(F.col("jobs").alias("open"),
                     F.expr("cast(array() as array<struct<source:string,k:bigint>>)").alias("run"))
    slots = F.aggregate(F.sequence(F.lit(0), F.size("jobs") - 1), start, step, lambda s: s["run"])
    return (
        listed.select("frame", "first_slot", "next_frame", F.size("jobs").cast("long").alias("slots"), slots.alias("run"))
        .select("frame", "first_slot", "next_frame", "slots", F.posexplode("run").alias("slot", "run"))
        .select("frame", "first_slot", "next_frame", "slots", F.col("slot").cast("long").alias("slot"),
                F.col("run.source").alias("source"), F.col("run.k").alias("k"))
    )


def mix(
    frame: DataFrame,
    weights: dict[str, int],
    *,
    rest: int = 1,
    block_rows: int = 64,
    source: str = "source",
    order: tuple[str, ...] = ("doc_id",),
    to: tuple[str, str] = ("block", "position"),
) -> DataFrame:
    """``frame`` with the number of the row's block among its source's, and the row's place in the mixture,
    from 0, under the names ``to``."""
    if any(w < 1 for w in [rest, *weights.values()]):
        raise ValueError("weights are positive integers")
    # The row travels as one column, so its own columns cannot clash with those of the plan.
    kept = frame.select(
        F.struct(*[quoted(c) for c in frame.columns if c not in to]).alias("_whole"),
        F.col(source).alias("_name"), F.array(*[F.col(c).cast("string") for c in order]).alias("_key"),
        # Maps have no hash; rows that differ in maps alone may change places.
        F.xxhash64(*[quoted(f.name) for f in frame.schema.fields if "map<" not in f.dataType.simpleString()]).alias("_row_hash"))
    known = F.array(*map(F.lit, weights)) if weights else F.expr("cast(array() as array<string>)")
    named = F.when(F.array_contains(known, F.coalesce("_name", F.lit(REST))), F.col("_name")).otherwise(REST)
    text = F.array_join("_key", "\x1f", "")
    keyed = kept.withColumns({"_source": named, "_order": F.md5(text)}).drop("_name")
    keyed = keyed.withColumn("_range", F.conv(F.substring("_order", 1, 3), 16, 10).cast("int"))

    counts = keyed.groupBy("_source", "_range").agg(F.count("*").alias("n"))
    by_range = Window.partitionBy("_source").orderBy("_range")
    offsets = counts.select(
        "_source", "_range", (F.sum("n").over(by_range) - F.col("n")).alias("_before"))
    in_range = Window.partitionBy("_source", "_range").orderBy("_order", "_key", "_row_hash")
    numbered = (
        keyed.withColumn("_row", F.row_number().over(in_range).cast("long") - 1)
        .join(F.broadcast(offsets), ["_source", "_range"])
        .withColumn("_row", F.col("_row") + F.col("_before"))
        .withColumn("block", F.floor(F.col("_row") / block_rows))
    )

    weight = reduce(lambda w, item: w.when(F.col("source") == item[0], F.lit(item[1])), weights.items(),
                    F.when(F.col("source") == REST, F.lit(weights.get(REST, rest)))).cast("long")
    sources = (
        counts.groupBy(F.col("_source").alias("source")).agg(F.sum("n").alias("rows"))
        .withColumns({"blocks": F.ceil(F.col("rows") / block_rows), "weight": weight})
    )
    plan = _with_missing(_schedule(_frames(sources)), sources, block_rows)
    entry = plan.select(
        F.col("source").alias("_source"), F.col("k").alias("_k"), "slot", "slots", "first_slot", "missing",
        F.col("frame").alias("_from"), F.coalesce("next_frame", F.lit(1 << 62)).alias("_to"))
    return (
        numbered.join(F.broadcast(sources.select(F.col("source").alias("_source"), "weight")), "_source")
        .withColumns({"_frame": F.floor(F.col("block") / F.col("weight")), "_k": F.col("block") % F.col("weight")})
        .join(F.broadcast(entry), ["_source", "_k"])
        .where((F.col("_frame") >= F.col("_from")) & (F.col("_frame") < F.col("_to")))
        .withColumn("position", (
            F.col("first_slot") + (F.col("_frame") - F.col("_from")) * F.col("slots") + F.col("slot")
        ) * block_rows - F.col("missing") + F.col("_row") % block_rows)
        .select("_whole.*", F.col("block").alias(to[0]), F.col("position").alias(to[1]))
    )


def _with_missing(plan: DataFrame, sources: DataFrame, block_rows: int) -> DataFrame:
    """``plan`` with ``missing``: the rows that short last blocks in earlier slots lack.

    The frame of a last block is a kind by itself, so the sum runs over the small plan.
    """
    last = sources.select(
        "source", F.floor((F.col("blocks") - 1) / F.col("weight")).alias("frame"),
        ((F.col("blocks") - 1) % F.col("weight")).alias("k"),
        (F.col("blocks") * block_rows - F.col("rows")).alias("lost"),
    )
    earlier = Window.orderBy("frame", "slot").rowsBetween(Window.unboundedPreceding, -1)
    return plan.join(F.broadcast(last), ["source", "frame", "k"], "left").withColumn(
        "missing", F.coalesce(F.sum("lost").over(earlier), F.lit(0)))
