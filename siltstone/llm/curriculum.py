"""Mixing sources to target weights on a time-varying curriculum.

Every source has a share of all words and a weight schedule over training time ``t`` in
[0, 1]. Integrating the schedule gives the source's cumulative token demand; the inverse of
that demand turns the place of a document in its source into a training position. Sorting all
documents by position interleaves the sources as the schedule asks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import content, words, written

#: Rows (of all sources) per range of the hash, in which running sums are taken.
ROWS_PER_BUCKET = 5_000


def targets(sizes: DataFrame, max_repeat: int) -> DataFrame:
    """Target words of each source (one row per source: ``source``, ``source_size``).

    Sources in code point order, NULL last, weigh 1, 2, 3, 1, 2, 3, ... of all words. A source
    cannot give more than ``max_repeat`` times its words; what it cannot take is reshared by
    weight among the others until none is above its limit. Sorting by limit per weight finds
    the fixed point in one pass: a source is limited iff the level at which it fills up lies
    under the level of all sources that fill up later.
    """
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    by_fill = Window.orderBy(F.col("fill"), F.col("source").asc_nulls_last())
    s = (sizes.withColumn("weight", ((n - 1) % 3 + 1).cast("double"))
         .withColumn("limit_", F.col("source_size").cast("double") * max_repeat)
         .withColumn("fill", F.col("limit_") / F.col("weight"))
         .withColumn("total", F.sum(F.col("source_size")).over(Window.partitionBy()).cast("double")))
    before = F.coalesce(F.sum("limit_").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0.0))
    left = F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("level", (F.col("total") - before) / left)
    s = s.withColumn("full", F.col("fill") <= F.col("level"))
    free = F.max(F.when(~F.col("full"), F.col("level"))).over(Window.partitionBy())
    return s.select("source", "source_size", "weight", "total", F.when(
        F.col("full"), F.col("limit_")).otherwise(F.col("weight") * free).alias("target"))


def position(share: Column, slope: Column) -> Column:
    """Training time at which a share of a source's demand has been met.

    The schedule is the line ``1 + slope * (2 t - 1)``; its integral, the cumulative demand,
    is ``(1 - slope) t + slope t^2``, inverted here. Slope -1 .. 1: falling .. rising.
    """
    a, b = slope, F.lit(1.0) - slope
    root = (F.sqrt(b * b + F.lit(4.0) * a * share) - b) / (F.lit(2.0) * a)
    return F.when(F.abs(a) < 1e-9, share).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), root)))


def plan(docs: DataFrame, max_repeat: int = 3, seed: int = 17, text: str = "text",
         key: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """How many words of each document the mix takes, and where its copies stand.

    One row per input row: ``doc_id, source, size, source_size, target, taken, copies,
    before, slope`` and the ``carry`` columns. Documents stand in each source in the order of
    a seeded hash of id and text (so reruns agree; equal rows tie and are told apart by their
    order only, which changes nothing); ``before`` is the words ahead of it. Whole passes over
    a source repeat every document; the last, partial pass takes the documents whose middle
    lies under the target, so a source misses its target by half a document at most. No
    document is taken more than ``max_repeat`` times.

    NULL text or no words: size 0, never taken. NULL source: a source of its own, last. An
    empty table gives an empty result. The running sums are taken per source and hash bucket
    (a bucket holds about ROWS_PER_BUCKET rows), then shifted by the sums of earlier buckets:
    no task sees a whole source.
    """
    size = F.size(words(F.col(text))).cast("long")
    sized = written(docs.select(
        F.col(key).alias("doc_id"), F.col("source"), size.alias("size"),
        F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("h"), *(carry or [])))
    per_source = sized.groupBy("source").agg(
        F.sum("size").cast("long").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    goal = targets(per_source.drop("rows"), max_repeat).withColumn(
        "slope", F.col("weight") / F.lit(2.0) - F.lit(1.0))
    total_rows = sized.count()
    buckets = max(1, -(-total_rows // ROWS_PER_BUCKET))
    # Hash bits are spread evenly, so equal ranges of the hash hold equal shares of a source.
    bucket = F.floor((F.shiftrightunsigned("h", 12).cast("double") / F.lit(2.0**52)) * buckets)
    sized = sized.withColumn("bucket", bucket.cast("long"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = (sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
            .withColumn("bucket_before", F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0)))
            .drop("bucket_size"))
    shifts = sums.alias("s").join(goal.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source"))).select(
        F.col("s.source").alias("k_source"), F.col("s.bucket").alias("k_bucket"), "bucket_before",
        "source_size", "target", "slope")
    order = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size")
    inside = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    d = sized.withColumn("inside", inside).join(
        shifts, F.col("source").eqNullSafe(F.col("k_source")) & (F.col("bucket") == F.col("k_bucket")))
    d = d.withColumn("before", F.col("bucket_before") + F.col("inside"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(
        F.lit(0)).cast("long")
    passes = F.least(passes, F.lit(max_repeat).cast("long"))
    rest = F.col("target") - passes * F.col("source_size")
    last = (passes < max_repeat) & (F.col("before") + F.col("size") / F.lit(2.0) <= rest)
    copies = F.when(F.col("size") > 0, passes + F.when(last, 1).otherwise(0)).otherwise(F.lit(0))
    return d.withColumn("copies", copies.cast("long")).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies", "before", "slope",
        *(carry or []))


def schedule(planned: DataFrame) -> DataFrame:
    """One row per copy that the mix takes, with its ``position`` in training (0 to 1).

    Copy c of a document stands at ``c * source_size + before`` words of its source's stream;
    that over the target is the share of the demand met, inverted by the schedule.
    """
    copy = planned.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    at = (F.col("copy") - 1) * F.col("source_size") + F.col("before")
    share = F.least(F.lit(1.0), at / F.col("target"))
    return copy.withColumn("position", position(share, F.col("slope")))


#: The training order of copies; k1 and k2 are two hashes of a row's doc_id, source and text.
ORDER = ("position", "k1", "k2", "copy", "before")


def _keys(*more: Column) -> list[Column]:
    return [F.xxhash64(F.lit(n), "doc_id", F.lit("|"), "source", F.lit("|"), "text", *more).alias(f"k{n}") for n in (1, 2)]


def deal(docs: DataFrame, max_repeat: int = 3, seed: int = 17) -> DataFrame:
    """What training sees of each document: one row per input row, from the copies in training order.

    ``doc_id, size, source_size, target, taken, copies, source``, then ``first_position``,
    ``positions`` and ``places``. Every copy gets its position; the copies are range-sorted as
    in ``mix`` and numbered from 1 in that order (its ``place``), by their number in their
    range and the rows of earlier ranges. ``taken`` and ``copies`` are counted from the sorted
    copies. A document left out has 0, 0, NULL and empty lists.

    The words ahead tell the taken rows of a source apart (each has a word or more), also
    rows that are equal.
    """
    planned = written(plan(docs.select("doc_id", "source", "text", *_keys()), max_repeat, seed, carry=["k1", "k2"]))
    row = ["doc_id", "size", "source_size", "target", "source", "before"]
    placed = written(schedule(planned).orderBy(*ORDER).select(
        *row, "copy", "position", F.monotonically_increasing_id().alias("id")))
    part, inside = F.shiftright("id", 33), F.col("id").bitwiseAND((1 << 33) - 1)
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    copies = placed.withColumn("part", part).join(F.broadcast(ranges), "part").withColumn(
        "place", F.col("ahead") + inside + 1)
    seen = F.sort_array(F.collect_list(F.struct("copy", "position", "place")))
    dealt = copies.groupBy(*row).agg(
        F.sum("size").alias("taken"), F.count(F.lit(1)).alias("copies"), F.min("position").alias("first_position"),
        seen["position"].alias("positions"), seen["place"].alias("places"))
    left_out = planned.where("copies = 0").select(
        *row, F.lit(0).cast("long").alias("taken"), F.lit(0).cast("long").alias("copies"),
        F.lit(None).cast("double").alias("first_position"), F.array().cast("array<double>").alias("positions"),
        F.array().cast("array<long>").alias("places"))
    return dealt.unionByName(left_out).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "source", "first_position", "positions", "places")


def mix(docs: DataFrame, max_repeat: int = 3, seed: int = 17) -> DataFrame:
    """The documents in training order: a row per copy taken, range-sorted by position.

    The plan is made without the texts; they meet their copies in one join on a 128-bit key of
    all columns, and move once more in the sort. Only rows equal in every column share a key:
    the copies of one stand for the others. A text of NULL or without words has size 0 and is
    never taken; a NULL doc_id or source is a value like others; empty table: empty result.
    Without other columns the keys are those of ``deal``, so both give copies the same order.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "source", "text")]
    keyed = docs.select(F.struct("*").alias("_row"), "doc_id", "source", "text",
                        *_keys(*([content(docs, "doc_id", "source", "text")] if others else [])))
    copies = schedule(plan(keyed, max_repeat, seed, carry=["k1", "k2"])).select("k1", "k2", "position", "copy", "before")
    rows = keyed.select("_row", "k1", "k2").dropDuplicates(["k1", "k2"])
    return rows.join(copies, ["k1", "k2"]).orderBy(*ORDER).select("_row.*")
