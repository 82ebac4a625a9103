"""Percentiles of very large numeric columns: exact distributed multi-select, and mergeable summaries of bounded relative error."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.runtime import Scratch, is_small, small_side

#: Values up to which a range is read out rather than parted once more.
LEAF = 16
#: What a partition proposes of a range: its median, the medians of the two halves, and those of the four quarters.
PROPOSED = 7
#: Relative error of a summary's percentiles.
ALPHA = 0.005
#: Buckets of a summary for zero, and for values too small or too large for a logarithm of ordinary size.
ZERO, INFINITE = -(2**31), 2**31 - 1


def measured(x: Column) -> Column:
    """True for a measurement: neither null nor NaN nor negative; zero and infinity count."""
    return x.isNotNull() & ~F.isnan(x) & (x >= 0)


def rank_of(q: float, n: Column) -> Column:
    """The nearest rank: max(1, ceil(q n)); q is taken as a fraction of a million, so that 0.99 x 100 is 99 and not 100."""
    million = F.lit(1_000_000).cast("long")
    return F.greatest(F.lit(1).cast("long"), F.call_function("div", n * F.lit(round(q * 1_000_000)).cast("long") + million - 1, million))


def multi_select(df: DataFrame, by: list[str], value: str, quantiles: list[float], leaf: int = LEAF) -> DataFrame:
    """The exact nearest-rank percentiles of value in each group: by..., q, n, value. The result's attribute rounds tells how often ranges were parted.

    Only values for which measured() holds take part; a group without any gives no row. Null keys form groups of their own; repeated rows
    count as often as they occur; ties are one value. Extra columns, whatever their names, are not read; an empty table gives an empty result.

    Distributed multi-select: a range of values still in play is (group, seg). In each round every partition proposes the median of its own values of
    each range, and the medians of the parts that this leaves (PROPOSED in all); the weighted median of each proposal becomes a pivot; all values are counted below,
    at, between and above the pivots; each wanted rank moves to its part, and parts that hold none are discarded. At least about a quarter of a range goes in a round, as a
    rule seven eighths, so a group of n values takes about log8(n / leaf) rounds over shrinking tables. Ranges of at most leaf values are read out.
    Pivots and ranges are broadcast while their measured size allows it, and the values then stay where they lie; a table of too many groups for that is joined by shuffles,
    in which the planner splits hot groups."""
    scratch = Scratch(df.sparkSession, "select")
    key = ["g", "seg"]
    g = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(1).alias("all"))
    x = F.col(value).cast("double")
    rows = scratch.write(df.filter(measured(x)).select(g.alias("g"), F.lit(0).alias("seg"), (x + 0.0).alias("x")))  # minus zero is zero
    counts = rows.groupBy("g").agg(F.count("*").alias("n"))
    ks = F.array(*[F.struct(F.lit(i).alias("i"), rank_of(q, F.col("n")).alias("k")) for i, q in enumerate(quantiles)])
    ranges = lambda df: scratch.write(df, small=True, few=F.count_if((F.col("n") <= leaf) & (F.col("lo") < F.col("hi"))), many=F.count_if((F.col("n") > leaf) & (F.col("lo") < F.col("hi"))))
    whole = counts.select("g", F.lit(0).alias("seg"), F.lit(0).alias("part"), "n", F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"), ks.alias("ks"))
    segs = first = ranges(whole)
    found: list[DataFrame] = []
    rounds = 0
    while True:
        hint = F.broadcast if is_small(segs) else lambda df: df
        live = segs.filter("lo < hi").select("g", "seg", "n", "ks")
        if segs.told["few"]:
            held = rows.join(hint(live.filter(F.col("n") <= leaf)), key).groupBy(*key).agg(F.sort_array(F.collect_list("x")).alias("xs"), F.first("ks").alias("ks"))
            found.append(held.select("g", "xs", F.inline("ks")).select("g", "i", F.element_at("xs", F.col("k").cast("int")).alias("x")))
        if not segs.told["many"]:
            break
        rounds += 1
        big = live.filter(F.col("n") > leaf)
        pivots = small_side(scratch.write(_pivots(rows.join(hint(big.select(*key)), key)), small=True))
        ps = [F.col(f"p{j}") for j in range(PROPOSED)]
        at = sum((F.when(F.col("x") > p, 2).otherwise(0) for p in ps[1:]), F.when(F.col("x") > ps[0], 2).otherwise(0))
        part = at + F.when(functools.reduce(lambda a, b: a | b, [F.col("x") == p for p in ps]), 1).otherwise(0)
        parted = rows.join(pivots, key).select(*key, "x", part.alias("part"))
        c = parted.groupBy(*key, "part").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        upto = F.sum("n").over(Window.partitionBy(*key).orderBy("part"))
        told = c.withColumn("upto", upto).join(hint(big.select(*key, "ks")), key).select(*key, "part", "n", "lo", "hi", "upto", F.inline("ks"))
        told = told.filter((F.col("k") <= F.col("upto")) & (F.col("k") > F.col("upto") - F.col("n"))).withColumn("k", F.col("k") - F.col("upto") + F.col("n"))
        # a range is named by its smallest wanted percentile, which no other range of the group holds
        each = told.groupBy(*key, "part").agg(F.min("i").alias("to"), F.first("n").alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.collect_list(F.struct("i", "k")).alias("ks"))
        left = ranges(each)
        found.append(left.filter("lo = hi").select("g", "lo", F.inline("ks")).select("g", "i", F.col("lo").alias("x")))
        left_hint = F.broadcast if is_small(left) else lambda df: df
        rows = scratch.write(parted.join(left_hint(left.filter("lo < hi").select(*key, "part", "to")), [*key, "part"]).select("g", F.col("to").alias("seg"), "x"))
        segs = _named(left)
    out = functools.reduce(DataFrame.unionByName, found) if found else first.select("g", F.lit(0).alias("i"), F.lit(0.0).alias("x"))
    q = F.element_at(F.array(*[F.lit(float(q)) for q in quantiles]), F.col("i") + 1)
    cols = [F.col("g")[c].alias(c) for c in by]
    out = out.join(first.select("g", F.col("n").alias("total")), "g").select(*cols, q.alias("q"), F.col("total").alias("n"), F.col("x").alias("value"))
    out.rounds = rounds
    return out


def _named(left: DataFrame) -> DataFrame:
    """The ranges that are left under their new names, with what was told of them."""
    out = left.select("g", F.col("to").alias("seg"), "n", "lo", "hi", "ks")
    out.told = left.told
    return out


def _pivots(rows: DataFrame) -> DataFrame:
    """g, seg, p0, p1 ...: for each range the weighted medians of what its partitions propose, which are values of the range."""
    tiles = [(j + 1) / (PROPOSED + 1) for j in range(PROPOSED)]
    own = rows.groupBy("g", "seg", F.spark_partition_id().alias("pid")).agg(F.percentile_approx("x", tiles, 200).alias("m"), F.count("*").alias("w"))
    each = own.select("g", "seg", "w", F.posexplode("m").alias("j", "m"))
    over = Window.partitionBy("g", "seg", "j")
    reached = F.sum("w").over(over.orderBy("m").rangeBetween(Window.unboundedPreceding, 0)) * 2 >= F.sum("w").over(over)
    best = each.withColumn("reached", reached).filter("reached").groupBy("g", "seg")
    return best.agg(*[F.min(F.when(F.col("j") == j, F.col("m"))).alias(f"p{j}") for j in range(PROPOSED)])


def summarise(df: DataFrame, by: list[str], value: str, alpha: float = ALPHA) -> DataFrame:
    """A mergeable summary: by..., bucket, n. Summaries of parts (partitions, days) are combined by combine().

    A bucket holds the values whose logarithm to base (1 + alpha) / (1 - alpha) rounds up to it, so its size is at most about 1,500 / alpha rows a group
    however many values there are. Rows that are no measurements are left out; null keys form groups of their own; empty tables give no row."""
    x = F.col(value).cast("double")
    log = F.ceil(F.ln(x) / F.lit(math.log((1 + alpha) / (1 - alpha)))).cast("int")
    bucket = F.when(x == 0, ZERO).when(x == F.lit(math.inf), INFINITE).otherwise(log)
    return df.filter(measured(x)).select(*by, bucket.alias("bucket")).groupBy(*by, "bucket").agg(F.count("*").alias("n"))


def combine(parts: list[DataFrame], by: list[str]) -> DataFrame:
    """The summary of several parts' values together, grouped by `by`, which may leave out keys of the parts (such as the day)."""
    out = parts[0].select(*by, "bucket", "n")
    for p in parts[1:]:
        out = out.unionByName(p.select(*by, "bucket", "n"))
    return out.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))


def from_summary(summary: DataFrame, by: list[str], quantiles: list[float], alpha: float = ALPHA) -> DataFrame:
    """Percentiles from a summary, each within the relative error alpha of the exact nearest-rank one: by..., q, n, value."""
    gamma = (1 + alpha) / (1 - alpha)
    over = Window.partitionBy(*by)
    s = summary.withColumn("upto", F.sum("n").over(over.orderBy("bucket"))).withColumn("total", F.sum("n").over(over))
    mid = F.when(F.col("bucket") == ZERO, 0.0).when(F.col("bucket") == INFINITE, math.inf).otherwise(F.pow(F.lit(gamma), F.col("bucket")) * 2 / (gamma + 1))
    each = s.select(*by, "n", "upto", "total", mid.alias("mid"), F.explode(F.array(*[F.struct(F.lit(float(q)).alias("q"), rank_of(q, F.col("total")).alias("k")) for q in quantiles])).alias("w"))
    hit = each.filter((F.col("upto") >= F.col("w.k")) & (F.col("upto") - F.col("n") < F.col("w.k")))
    return hit.select(*by, F.col("w.q").alias("q"), F.col("total").alias("n"), F.col("mid").alias("value"))


def current_results(results: DataFrame) -> DataFrame:
    """The row of each (doc_id, batch_id, seed_version, stage) that counts: the latest created_at, a null one being the oldest; among rows of the same time the largest latency."""
    key = ["doc_id", "batch_id", "seed_version", "stage"]
    return results.groupBy(*key).agg(F.max(F.struct("created_at", "latency_ms")).alias("last")).select(*key, "last.created_at", "last.latency_ms")


def misstated_batches(batches: DataFrame, results: DataFrame, tolerance: float = 0.10) -> DataFrame:
    """batch_id, seed_version, git_sha, stage of each batch row whose latency_p99_ms is more than tolerance of the exact 99th percentile away from it.

    Distinct rows. Batches without a measured result, or without a stored figure, can't be compared and don't come out; null keys match nothing; a stored NaN differs."""
    key = ["batch_id", "seed_version", "stage"]
    wanted = batches.select(*key).distinct()
    now = current_results(results.join(wanted, key, "left_semi"))
    p99 = multi_select(now, key, "latency_ms", [0.99]).select(*key, F.col("value").alias("exact"))
    stored = F.col("latency_p99_ms").cast("double")
    off = F.isnan(stored) | (F.abs(stored - F.col("exact")) > F.col("exact") * F.lit(tolerance))
    return batches.join(p99, key).filter(stored.isNotNull() & off).select("batch_id", "seed_version", "git_sha", "stage").distinct()
