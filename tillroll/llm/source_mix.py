"""Mixing sources to target weights by a time-varying curriculum, in DataFrame functions only.

A source has weights at equally spaced times of the run. At each of those times
the weights of all sources that have documents are divided by their sum; between
them the shares run straight, so they add up to 1 all the time. The integral of a
source's share is what it gets of the budget, its demand up to a time the
integral up to there. A target stops at ``repeats`` times the words of its
source; the excess is shared anew by weight until no target is above.

The documents of a source stand in a fixed order (by a digest of id and text) and
are read over and over. The copy of a document before which the source has given
x words is due when the source's demand has reached x: the integral, quadratic
between two times, is inverted there, and time times the words of the run is the
copy's position. The last copy of a source ends at its target, within a document
if need be, so what it gives is the target without its fraction.

How it scales: words are counted once into a narrow table, summed by source and
by the first digits of the digest, of which there are about as many as the square
root of the number of rows. Sums before a bucket come from that small table, sums
within it from its rows, so a source that holds a third of all rows is spread
over all its buckets. Only scalars reach the driver (words, rounds of the sharing,
one sum for each time of the schedule).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import staged

WORD = r"[^\x20\x09-\x0D]+"
REPEATS = 3
#: Fixed-point unit of the weights, so that sums are the same in any order.
WHOLE = 2.0 ** 52


def _same(column: str) -> Column:
    """A text that is never null and tells null from every value."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def shared_out(sources: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """``sources`` (columns source_size and weight, both long) with ``target`` and ``whole``, the words to take.

    All words are shared by weight; targets above ``repeats`` times their
    source stop there and the excess goes to the others by weight, until none
    is above. Each round is one aggregate over the sources.
    """
    most = F.col("source_size") * repeats
    total, weights = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    left, rest, stopped = total, weights, 0
    while True:
        # ``rest`` and ``left`` belong to the sources below; a stopped one stays above the line as it rises.
        above = most * F.lit(float(rest)) < F.col("weight") * F.lit(float(left))
        n, words, weight = sources.agg(F.count_if(above), F.sum(F.when(above, most)), F.sum(F.when(above, F.col("weight")))).first()
        if n == stopped:
            break
        stopped, left, rest = n, total - words, weights - weight
    by_weight = F.col("weight") * F.lit(float(left)) / F.lit(float(rest)) if rest else F.lit(0.0)
    target = F.when(above, most.cast("double")).otherwise(by_weight)
    return sources.withColumns({"target": target, "whole": F.floor(target).cast("long")})


def plan_mix(docs: DataFrame, schedule: DataFrame, keep: list[str] | None = None, text_col: str = "text",
             source_col: str = "source", id_col: str = "doc_id", repeats: int = REPEATS) -> DataFrame:
    """One row per row of ``docs``: its columns (or those in ``keep``), size, source_size, target, taken and
    ``copies``, an array of (epoch, position, words) by epoch.

    ``schedule`` has a column of ``source_col``'s name (null is a source like
    any other) and ``weights``, an array of the weights at equally spaced times
    from begin to end; one value holds all the time. Missing, null and negative
    weights are 0, as are sources that the schedule doesn't name; several rows
    of one source add up. Null and empty texts have no words and are never
    taken. Rows that agree in id, text and source get places next to each
    other. Columns of ``docs`` with a name given above are replaced. An empty
    table gives an empty result. The same rows give the same result, however
    they are partitioned.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("size", "source_size", "target", "taken", "copies")]
    digest = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    sized = staged(docs.select(F.struct(*keep).alias("doc"), _same(source_col).alias("s"), digest.alias("key"),
                               word_count(text_col).alias("size")), "mix-sizes")
    digits = max(1, math.ceil(math.log2(max(sized.count(), 2)) / 8))  # 16 ** digits: about the root of the rows
    sized = sized.withColumn("bucket", F.substring("key", 1, digits))
    buckets = staged(sized.groupBy("s", "bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    sources = staged(buckets.groupBy("s").agg(F.sum("words").alias("source_size")), "mix-sources")

    # Shares at each time, and their integrals.
    weights = F.transform("weights", lambda w: F.greatest(F.coalesce(w.cast("double"), F.lit(0.0)), F.lit(0.0)))
    plan = schedule.select(_same(source_col).alias("s"), weights.alias("w")).join(sources, "s")
    at = plan.select("s", F.posexplode("w").alias("i", "w")).withColumn("w", F.col("w").cast("decimal(28,10)"))  # sums in any order agree
    sums = {i: float(x) for i, x in at.groupBy("i").agg(F.sum("w")).collect()}
    knots = max(sums, default=0) + 1
    step = 1.0 / max(knots - 1, 1)
    share = at.groupBy("s").pivot("i", list(range(knots))).agg(F.sum("w"))
    shares = [F.coalesce(F.col(str(i)).cast("double"), F.lit(0.0)) / F.lit(sums[i]) if sums.get(i) else F.lit(0.0) for i in range(knots)]
    share = share.select("s", F.array(*(shares if knots > 1 else shares * 2)).alias("p"))
    areas = F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda i: (F.get("p", i - 1) + F.get("p", i)) * F.lit(step / 2))
    share = share.withColumn("areas", areas)
    parts = F.transform("areas", lambda a, i: F.struct(
        (i * F.lit(step)).alias("begin"), F.get("p", i).alias("p0"), F.get("p", i + 1).alias("p1"),
        F.aggregate(F.slice("areas", 1, i), F.lit(0.0), lambda x, y: x + y).alias("before")))
    share = share.select("s", parts.alias("parts"), F.aggregate("areas", F.lit(0.0), lambda x, y: x + y).alias("area"))
    weight = F.coalesce(F.floor(F.col("area") * F.lit(WHOLE)), F.lit(0)).cast("long").alias("weight")
    sources = staged(shared_out(sources.join(share, "s", "left").select("*", weight), repeats), "mix-targets")
    run = sources.agg(F.coalesce(F.sum("whole"), F.lit(0))).first()[0]

    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("s", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset")).join(sources, "s")
    within = Window.partitionBy("s", "bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.join(offsets, ["s", "bucket"]).withColumn("start", F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0)))

    def copy(epoch: Column) -> Column:
        given = epoch * F.col("source_size") + F.col("start")
        due = given / F.col("target") * F.col("area")
        part = F.element_at(F.filter("parts", lambda x: x["before"] <= due), -1)
        area = due - part["before"]
        bend = F.greatest(part["p0"] * part["p0"] + (part["p1"] - part["p0"]) * 2.0 * area / F.lit(step), F.lit(0.0))
        time = part["begin"] + F.when(area > 0, F.least(area * 2.0 / (part["p0"] + F.sqrt(bend)), F.lit(step))).otherwise(0.0)
        words = F.least(F.col("size"), F.col("whole") - given)
        return F.struct(epoch.cast("int").alias("epoch"), F.floor(time * F.lit(float(run))).cast("long").alias("position"), words.alias("words"))

    wanted = F.filter(F.sequence(F.lit(0), F.lit(repeats - 1)), lambda e: (F.col("size") > 0) & (e * F.col("source_size") + F.col("start") < F.col("whole")))
    out = placed.withColumn("copies", F.transform(wanted, copy))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda x, c: x + c["words"])
    return out.select("doc.*", "size", "source_size", "target", taken.alias("taken"), "copies")


def mix_sources(docs: DataFrame, schedule: DataFrame, text_col: str = "text", source_col: str = "source",
                id_col: str = "doc_id", repeats: int = REPEATS) -> DataFrame:
    """The training sequence: a row for each copy that the mix takes, range-sorted by position.

    All columns of ``docs`` and epoch, position, words (how many of the text's
    words count: all but for the last copy of a source). Cases as in plan_mix.
    """
    plan = plan_mix(docs, schedule, None, text_col, source_col, id_col, repeats)
    columns = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken", "copies", "epoch", "position", "words")]
    out = plan.select(*columns, F.explode("copies").alias("c")).select(*columns, "c.*")
    return out.orderBy("position", source_col, id_col, "epoch")
