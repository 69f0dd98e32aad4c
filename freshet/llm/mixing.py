"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, how often the mix takes it, as close to 1 as possible in
relative entropy such that the taken words of each source meet its target and no
rate exceeds a limit. The dual of that problem has one number per source, the rates
are ``min(limit, exp(tilt * size))``, and Newton steps find the tilts: each step sums
the rates' words and their slope per source over all documents. The steps run on the
number of documents of each (source, size), which loses nothing.

Rates become whole copies by carrying the remainder along a source's documents in
order of size, so that its words miss the target by one document at most, and by
far less for the best beginning of that running sum.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.ranks import ranked, spread
from freshet.llm.staging import staged

WORD = r"[^\x20\x09-\x0D]+"
STEPS = 60  # of Newton's method, about eight are usual; then the brackets are halved
NEAR = 1e-6  # of a target, by which taken words may miss it
SLACK = 1e-9  # of a source's words, within which a target counts as its limit
#: A source is its text and whether it has one: null is a source of its own, the last.
KEY = ["named", "source"]
POINT = 20  # binary places of a rate
STARTS = 32  # beginnings of the running sum, of which each source takes the one nearest its target
EXACT = "decimal(38,6)"  # sums that do not depend on the order of rows


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def target_sizes(
    sizes: DataFrame, weights: tuple[int, ...], share: float, limit: float
) -> DataFrame:
    """Targets of sources (``named``, ``source``, ``source_size``): weights cycle in code-point order.

    The sources share ``share`` times all words by weight; none gets more than
    ``limit`` times its own, the excess goes to the others by weight. In order of
    words per weight those at their limit come first, so the level at which the rest
    share evenly follows from running sums.
    """
    by_name = Window.orderBy(F.desc("named"), "source")
    tight = Window.orderBy("room", F.desc("named"), "source")
    upto = tight.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    cycle = F.array(*map(F.lit, weights))
    place = (F.row_number().over(by_name) - 1) % len(weights)
    most = F.col("source_size") * F.lit(float(limit))
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0))
    return (
        sizes.withColumn("weight", F.element_at(cycle, (place + 1).cast("int")))
        .withColumn("most", most)
        .withColumn("room", F.col("most") / F.col("weight"))
        .withColumn("total", total)
        .withColumn("level", (total - F.coalesce(F.sum("most").over(upto), F.lit(0.0))) / open_weight)
        # Levels fall from the first source whose room reaches them: that one holds.
        .withColumn(
            "level", F.max(F.when(F.col("level") <= F.col("room"), F.col("level"))).over(everything)
        )
        .withColumn(
            "target",
            F.coalesce(F.least("most", F.col("level") * F.col("weight")), F.col("most")),
        )
        .select(*KEY, "source_size", "target")
    )


def _part() -> Column:
    return F.col("size") / F.greatest(F.col("largest"), F.lit(1))


def _rate(tilt: Column, limit: float) -> Column:
    """Copies of a document before rounding, given its size over the source's largest."""
    return F.least(F.lit(float(limit)), F.exp(F.least(tilt * F.col("part"), F.lit(50.0))))


def balance(spark: SparkSession, counts: DataFrame, targets: DataFrame, limit: float) -> DataFrame:
    """The tilt of each source, by Newton's method on the dual.

    ``counts`` has named, source, size and docs. A source whose target is its limit (or that
    has no words) needs no tilt: its rates are the limit. The dual's slope is the
    missing words, its curvature the words of the documents below the limit, weighted
    by size. Steps are held within a bracket, so that a source far from its target
    cannot run away. After ``STEPS`` steps the brackets are halved until the targets are met or
    no number is left within, which ends whatever the sizes. Each step is one aggregation to a line per source, written before
    the next; only the number of sources still off passes to the driver.
    """
    spans = counts.groupBy(*KEY).agg(F.max("size").alias("largest"))
    state = (
        targets.join(spans, KEY)
        .withColumn("full", F.col("target") >= F.col("source_size") * F.lit(limit * (1 - SLACK)))
        .withColumn("tilt", F.lit(0.0))
        .withColumn("low", F.lit(None).cast("double"))
        .withColumn("high", F.lit(None).cast("double"))
        .withColumn("off", ~F.col("full"))
    )
    state = staged(spark, state, "tilts")
    for turn in count():
        if not state.where("off").limit(1).count():
            break
        met = counts.join(state.where("off"), KEY).withColumn("part", _part())
        met = met.withColumn("rate", _rate(F.col("tilt"), limit))
        words = F.col("rate") * F.col("size") * F.col("docs")
        bends = F.when(F.col("rate") < limit, words * F.col("part")).otherwise(F.lit(0.0))
        sums = met.groupBy(*KEY).agg(
            F.sum(words.cast(EXACT)).cast("double").alias("words"),
            F.sum(bends.cast(EXACT)).cast("double").alias("bend"),
        )
        short = F.col("target") - F.col("words")
        low = F.when(short > 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(short < 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") + F.when(F.col("bend") > 0, short / F.col("bend")).otherwise(
            F.signum(short)
        )
        # Outside the bracket halve it; with one end open go twice as far, plus one.
        middle, bounded = (low + high) / 2, low.isNotNull() & high.isNotNull()
        halved = bounded & (F.lit(turn >= STEPS) | ~step.between(low, high))
        inside = (
            F.when(halved, middle)
            .when(high.isNull(), F.least(step, F.col("tilt") + F.abs("tilt") + 1))
            .when(low.isNull(), F.greatest(step, F.col("tilt") - F.abs("tilt") - 1))
            .otherwise(step)
        )
        narrow = F.coalesce((middle <= low) | (middle >= high), F.lit(False))
        done = (F.abs(short) <= F.col("target") * NEAR) | narrow
        moved = state.join(sums, KEY, "left").select(
            *KEY,
            "source_size",
            "target",
            "largest",
            "full",
            F.when(F.col("off") & ~done, inside).otherwise(F.col("tilt")).alias("tilt"),
            F.when(F.col("off"), low).otherwise(F.col("low")).alias("low"),
            F.when(F.col("off"), high).otherwise(F.col("high")).alias("high"),
            (F.col("off") & ~F.coalesce(done, F.lit(False))).alias("off"),
        )
        state = staged(spark, moved, "tilts")
    return state


def mix_documents(
    spark: SparkSession,
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    limit: int = 2,
) -> DataFrame:
    """How many words of each document the mix takes.

    ``docs`` has doc_id, text and source; other columns are not read. The size of a
    document is its number of words (null text: 0). Returns doc_id, source, size,
    source_size, target, copies and taken = copies * size. A null source is a source of
    its own, ordered last. Documents without words get no copy. Repeated rows count
    each for itself; rows alike in id, source and size may swap their copies. An empty
    table gives no rows. Equal tables give equal mixes, whatever their partitions.
    """
    sized = docs.select(
        F.col("doc_id").cast("long"),
        F.col("source").isNotNull().alias("named"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        word_count("text").alias("size"),
        spread("doc_id").alias("place"),
    )
    sized = staged(spark, sized, "sizes")
    counts = sized.groupBy(*KEY, "size").agg(F.count("*").alias("docs"))
    counts = staged(spark, counts, "size-counts")
    sums = counts.groupBy(*KEY).agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    tilts = balance(spark, counts, target_sizes(sums, weights, share, limit), limit)

    rate = F.when(F.col("full"), F.lit(float(limit))).otherwise(_rate(F.col("tilt"), limit))
    # Fixed-point rates: their running sums are exact, so reruns agree.
    fixed = F.when(F.col("size") > 0, F.round(rate * (1 << POINT))).otherwise(F.lit(0)).cast("long")
    before = Window.partitionBy(*KEY).orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    lines = (
        counts.join(tilts, KEY)
        .withColumn("part", _part())
        .withColumn("rate", fixed)
        .withColumn(
            "carried", F.coalesce(F.sum(F.col("rate") * F.col("docs")).over(before), F.lit(0))
        )
        .select(*KEY, "size", "docs", "source_size", "target", "rate", "carried")
    )
    lines = staged(spark, lines, "rates")
    numbered = ranked(sized, [*KEY, "size"], "place", ["doc_id"], sized.count(), "nth")

    def whole(docs_before: Column, start: Column) -> Column:
        """Copies given out to a source's documents up to here, if the sum began at start."""
        return F.shiftright(F.col("carried") + F.col("rate") * docs_before + start, POINT)

    def missed(start: int) -> Column:
        given = whole(F.col("docs"), F.lit(start)) - whole(F.lit(0), F.lit(start))
        return F.abs(F.sum(given * F.col("size")) - F.first("target"))

    tried = [(2 * k + 1 << POINT) // (2 * STARTS) for k in range(STARTS)]
    best = F.array_min(F.array(*(F.struct(missed(u), F.lit(u).alias("start")) for u in tried)))
    starts = lines.groupBy(*KEY).agg(best.alias("best")).select(*KEY, "best.start")
    start = F.col("start").cast("long")
    copies = whole(F.col("nth") + 1, start) - whole(F.col("nth"), start)
    return numbered.join(lines.drop("docs").join(starts, KEY), [*KEY, "size"]).select(
        "doc_id",
        F.when(F.col("named"), F.col("source")).alias("source"),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
