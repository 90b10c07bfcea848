"""Mixing sources to target weights with a low-discrepancy schedule, in SQL functions only.

Slots of ``block`` words are numbered; slot i stands at the golden-ratio point
frac(i * 0.618...) and belongs to the source whose interval of cumulative target
weight holds that point. The slots of a source are ranked in schedule order. Its
documents, in hash order, form a stream that is cut into blocks of equal size; the
slot of rank r takes block r mod (number of blocks), so a source is read again from
its start once it is used up. The last slot of a source takes what is left of its
target; ranks the schedule did not reach close it.

Ranks and stream positions are sums inside bounded ranges (65,536 slots, one of
4,096 hash buckets) on top of sums of the ranges before, so a source that holds a
third of all rows is spread over many tasks.

Targets: sources by code point, null last, weigh ``weights`` in turn and share all
words; a target stops at ``most`` times its source's size and the excess is shared
again by weight. Defined cases: a null text has size 0 and nothing is taken from
it; an empty table gives an empty result; rows that repeat a document are documents
of their own; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patrona.session import materialize

SLOTS_PER_RANGE = 1 << 16
POINT_BITS, CELL_BITS = 31, 10
#: 2**31 / golden ratio, odd
GOLDEN_STEP = 1327217885


def word_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, h, bucket): words of each text and its place in hash order."""
    h = F.xxhash64(F.col("doc_id"), F.lit("mix"))
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), h.alias("h"),
                       F.shiftrightunsigned(h, 52).alias("bucket"))


def source_targets(sized: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """(sid, source, source_size, target, need words, point interval) of each source; one row per source."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("sid") % len(weights) + 1)
    rows = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("sid", (F.row_number().over(order) - 1).cast("int")).withColumn("weight", turn)
            .withColumn("top", most * F.col("source_size")))
    # Sources in the order in which they reach their limit: one is held there when the level at its turn is above it.
    turns = W.orderBy(F.col("top") / F.col("weight"), "sid")
    whole = W.partitionBy()
    rows = rows.withColumns({
        "words": F.sum("source_size").over(whole),
        "tops": F.coalesce(F.sum("top").over(turns.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)),
        "left": F.sum("weight").over(turns.rowsBetween(W.currentRow, W.unboundedFollowing))})
    level = (F.col("words") - F.col("tops")) / F.col("left")
    rows = rows.withColumn("level", level).withColumn("nth", F.row_number().over(turns))
    free = F.col("top") >= F.col("weight") * F.col("level")
    rows = rows.withColumn("first_free", F.min(F.when(free, F.struct("nth", "level"))).over(whole))
    held = F.coalesce(F.col("nth") < F.col("first_free.nth"), F.lit(True))
    rows = rows.withColumn("target", F.when(held, F.col("top")).otherwise(
        F.col("weight") * F.col("first_free.level")))
    running = F.sum("target").over(W.orderBy("sid").rowsBetween(W.unboundedPreceding, W.currentRow))
    all_of = F.greatest(F.sum("target").over(whole), F.lit(1e-9))
    scale = float(1 << POINT_BITS)
    rows = rows.withColumn("upto", running).withColumn("hi", F.floor(F.col("upto") / all_of * scale + 1e-6))
    return rows.select("sid", "source", "source_size", "target", F.floor(F.col("target") + 1e-6).alias("need"),
                       F.coalesce(F.lag("hi").over(W.orderBy("sid")), F.lit(0)).alias("lo"), "hi")


def schedule(targets: DataFrame, total: int, block: int) -> DataFrame:
    """(sid, rank): slots of the low-discrepancy schedule, ranked per source."""
    shift = POINT_BITS - CELL_BITS
    # The step times a slot number stays below 2**62; the schedule has period 2**31.
    point = (F.col("slot") % (1 << POINT_BITS)) * GOLDEN_STEP % (1 << POINT_BITS)
    slots = (targets.sparkSession.range(-(-total // block)).withColumnRenamed("id", "slot")
             .withColumn("point", point).withColumn("cell", F.shiftright("point", shift)))
    cells = targets.where("hi > lo").select("sid", "lo", "hi", F.explode(F.sequence(
        F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift))).alias("cell"))
    owned = (slots.join(cells, "cell").where("point >= lo and point < hi")
             .select("sid", "slot", F.expr(f"slot div {SLOTS_PER_RANGE}").alias("part")))
    before = W.partitionBy("sid").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    earlier = owned.groupBy("sid", "part").count().select(
        "sid", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    inside = F.row_number().over(W.partitionBy("sid", "part").orderBy("slot"))
    return (owned.select("sid", "part", inside.alias("place")).join(earlier, ["sid", "part"])
            .select("sid", (F.col("earlier") + F.col("place") - 1).alias("rank")))


def taken_ranges(targets: DataFrame, ranked: DataFrame, block: int) -> DataFrame:
    """(sid, block, start, stop): stream ranges the slots take, one row per slot that takes anything."""
    plan = targets.where("need > 0").withColumns({
        "blocks": F.expr(f"(source_size + {block} - 1) div {block}"),
        "passes": F.expr("need div source_size")}).withColumn(
        "slots", F.expr(f"passes * blocks + (need - passes * source_size + {block} - 1) div {block}"))
    plan = plan.select("sid", "source_size", "need", "blocks", "slots")
    reached = ranked.groupBy("sid").agg((F.max("rank") + 1).alias("reached"))
    closing = (plan.join(reached, "sid", "left").withColumn("reached", F.coalesce("reached", F.lit(0)))
               .where("reached < slots")
               .select("sid", F.explode(F.sequence(F.col("reached"), F.col("slots") - 1)).alias("rank")))
    used = ranked.unionByName(closing).join(plan, "sid").where("rank < slots")
    start = F.col("block") * block
    left = F.col("need") - F.expr("rank div blocks") * F.col("source_size")
    return (used.withColumn("block", F.col("rank") % F.col("blocks"))
            .select("sid", "block", start.alias("start"),
                    F.least(start + block, F.col("source_size"), left).alias("stop")).where("stop > start"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0,
                block: int = 1024) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) for every document (doc_id, text, source).

    ``taken`` counts the document's words in the mix, repeats included; ``copies``
    how often the mix takes its first word.
    """
    sized = materialize(word_sizes(docs), "mix-sizes")
    targets = materialize(source_targets(sized, weights, most), "mix-targets")
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    same = sized["source"].eqNullSafe(targets["source"])
    placed = sized.join(targets.select("sid", "source", "source_size", "target"), same).drop(targets["source"])
    before = W.partitionBy("sid").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    earlier = placed.groupBy("sid", "bucket").agg(F.sum("size").alias("n")).select(
        "sid", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    inside = W.partitionBy("sid", "bucket").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    stream = (placed.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .withColumn("place", F.row_number().over(W.partitionBy("sid", "bucket").orderBy("h", "doc_id", "size")))
              .join(earlier, ["sid", "bucket"])
              .withColumn("at", F.col("earlier") + F.col("within")))
    stream = materialize(stream.select("doc_id", "size", "source_size", "target", "sid", "bucket", "place", "at"),
                         "mix-stream")
    pieces = stream.where("size > 0").select("sid", "bucket", "place", "at", "size", F.explode(F.sequence(
        F.expr(f"at div {block}"), F.expr(f"(at + size - 1) div {block}"))).alias("block"))
    ranges = taken_ranges(targets, schedule(targets, total, block), block)
    overlap = F.least(F.col("at") + F.col("size"), "stop") - F.greatest("at", "start")
    first = (F.col("at") >= F.col("start")) & (F.col("at") < F.col("stop"))
    taken = (pieces.join(ranges, ["sid", "block"]).where(overlap > 0)
             .groupBy("sid", "bucket", "place").agg(F.sum(overlap).alias("taken"),
                                                    F.sum(first.cast("long")).alias("copies")))
    zero = F.lit(0).cast("long")
    return stream.join(taken, ["sid", "bucket", "place"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", zero).alias("taken"),
        F.coalesce("copies", zero).alias("copies"))
