"""Scoring: counts, precision, recall and F1, percentiles, funnels and series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COUNTS = ["tp", "fp", "fn", "blank"]


def ratio(top: Column, bottom: Column, empty: float = 1.0) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(empty))


def precision(empty: float = 1.0) -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fp"), empty)


def recall(empty: float = 1.0) -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fn"), empty)


def f1(p: Column, r: Column) -> Column:
    return F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))


def rated(counts: DataFrame, empty: float = 1.0, digits: int = 6) -> DataFrame:
    """counts with precision, recall and f1, rounded; empty is what a ratio of nothing counts as."""
    p, r = precision(empty), recall(empty)
    return counts.withColumns({"precision": F.round(p, digits), "recall": F.round(r, digits), "f1": F.round(f1(p, r), digits)})


def cell_counts(value: Column, tier: Column, token: Column, truth: Column) -> dict[str, Column]:
    """The counts of one cell: a wrong value is both a false positive and a missed truth; blank is one that was tried, where there is no truth."""
    right = F.coalesce(token == truth, F.lit(False))
    n = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    return {
        "tp": n(value.isNotNull() & truth.isNotNull() & right), "fp": n(value.isNotNull() & ~right),
        "fn": n(truth.isNotNull() & ~right), "blank": n(value.isNull() & truth.isNull() & tier.isNotNull()),
    }


def summed(df: DataFrame, by: list[str], sets: list[list[str]]) -> DataFrame:
    """Counts summed for several groupings in one pass: by columns, one row set a list of sets; columns that a set leaves out are null."""
    counts = [F.sum(F.col(c).cast("long")).alias(c) for c in COUNTS]
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in by]).agg(F.count("*").alias("doc_count"), *counts)


def nearest_rank(column: str, q: float) -> Column:
    """The nearest-rank percentile, 0 for no values; for groups that fit an aggregate."""
    return F.coalesce(F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {column})"), F.lit(0.0))


def loose_stats(column: str) -> list[Column]:
    """Mean, interpolating median and maximum, to 3 digits; null for no values."""
    return [F.round(F.avg(column), 3).alias("mean"), F.round(F.expr(f"percentile({column}, 0.5)"), 3).alias("median"), F.round(F.max(column), 3).alias("maximum")]


def spread_stats(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """by..., n, mean, median, maximum, to 3 digits, of a column that holds no negative numbers; exact, with an interpolating median, for groups of any size.

    Values are counted in classes 1 % wide, by partial aggregates; only the one or two classes that hold the middle are then looked at, and of these nothing is collected where all values are equal."""
    x = F.col(column).cast("double")
    rows = df.select(*by, x.alias("_x"), F.ceil(F.log1p(x) * 100).cast("long").alias("_c"))
    c = rows.groupBy(*by, "_c").agg(F.count("*").alias("n"), F.sum("_x").alias("s"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    w = Window.partitionBy(*by)
    c = c.withColumns({"upto": F.sum("n").over(w.orderBy("_c")), "all": F.sum("n").over(w), "total": F.sum("s").over(w), "maximum": F.max("hi").over(w)})
    a, b = F.call_function("div", F.col("all") - 1, F.lit(2).cast("long")), F.call_function("div", F.col("all"), F.lit(2).cast("long"))  # the places of the middle, from 0
    at = F.array_distinct(F.array(a, b))
    mid = c.withColumn("places", F.filter(at, lambda k: (k < F.col("upto")) & (k >= F.col("upto") - F.col("n")))).filter(F.size("places") > 0)
    mid = mid.select(*by, "_c", "all", "total", "maximum", "lo", "hi", F.transform("places", lambda k: (k - F.col("upto") + F.col("n")).cast("int")).alias("places"))
    same = mid.filter("lo = hi").select(*by, "all", "total", "maximum", F.transform("places", lambda k: F.col("lo")).alias("m"))
    keys = mid.filter("lo < hi").select(*[F.struct(*by, F.lit(1)).alias("_g")], "_c", "all", "total", "maximum", "places")
    held = rows.withColumn("_g", F.struct(*by, F.lit(1))).join(F.broadcast(keys), ["_g", "_c"])  # two rows a group
    sorted_ = held.groupBy(*by, "_c").agg(F.first("all").alias("all"), F.first("total").alias("total"), F.first("maximum").alias("maximum"), F.first("places").alias("places"), F.sort_array(F.collect_list("_x")).alias("xs"))
    each = same.unionByName(sorted_.select(*by, "all", "total", "maximum", F.transform("places", lambda k: F.get("xs", k)).alias("m")))
    out = each.select(*by, "all", "total", "maximum", F.explode("m").alias("m")).groupBy(*by).agg(F.max("all").alias("n"), F.max("total").alias("total"), F.max("maximum").alias("maximum"), F.avg("m").alias("median"))
    return out.select(*by, "n", F.round(F.col("total") / F.col("n"), 3).alias("mean"), F.round("median", 3).alias("median"), F.round("maximum", 3).alias("maximum"))


def timing(replies: DataFrame) -> DataFrame:
    """measure, n, mean, median, maximum of a reader's calls: tokens a second, seconds a call, of loading and of reading the prompt, and tokens, to 3 digits; a measure that no call has is null.

    replies: eval_count, eval_duration, prompt_eval_count, prompt_eval_duration, load_duration, total_duration; durations in nanoseconds, 0 being none but for loading."""
    seconds = lambda c: F.when(F.col(c) != 0, F.col(c) / 1e9)
    each = {
        "tokens_per_s": F.when((F.col("eval_count") != 0) & (F.col("eval_duration") != 0), F.col("eval_count") / (F.col("eval_duration") / 1e9)), "seconds_per_call": seconds("total_duration"), "load_seconds": F.col("load_duration") / 1e9,
        "prompt_seconds": seconds("prompt_eval_duration"), "prompt_tokens": F.col("prompt_eval_count").cast("double"), "output_tokens": F.col("eval_count").cast("double"),
    }
    rows = replies.select(F.inline(F.array(*[F.struct(F.lit(n).alias("measure"), c.cast("double").alias("x")) for n, c in each.items()])))
    return rows.groupBy("measure").agg(F.count("x").alias("n"), *loose_stats("x"))


def form_confidence(value: Column, tier: Column, confidence: Column) -> list[Column]:
    """Aggregates of a form's fields: lowest and mean confidence of populated ones (1 for none), and how many are populated, blank and unattempted."""
    filled = F.when(value.isNotNull(), confidence)
    return [
        F.round(F.coalesce(F.min(filled), F.lit(1.0)), 6).alias("min_confidence"), F.round(F.coalesce(F.avg(filled), F.lit(1.0)), 6).alias("mean_confidence"),
        F.count_if(value.isNotNull()).alias("populated"), F.count_if(value.isNull() & tier.isNotNull()).alias("blank"), F.count_if(tier.isNull()).alias("unattempted"),
    ]


def cumulative(df: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Running total of value by order within by, whose groups are few rows."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("cumulative", F.sum(value).over(w))


def dips(series: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Steps of a series that are below the step before, and whether they are below the best so far."""
    w = Window.partitionBy(*by).orderBy(order)
    out = series.withColumn("before", F.lag(value).over(w)).withColumn("best_before", F.max(value).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return out.filter(F.col(value) < F.col("before"))


def ends(series: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """First, last and mean value of each series."""
    return series.groupBy(*by).agg(F.min_by(value, order).alias("first_value"), F.max_by(value, order).alias("last_value"), F.round(F.avg(value), 6).alias("mean_value"))


def mixed_keys(df: DataFrame, key: str, split: str) -> DataFrame:
    """Keys whose rows are in more than one split, with the splits in order."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_set(split)).alias("splits")).filter(F.size("splits") > 1)
