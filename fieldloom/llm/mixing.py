"""Mixing sources to target token shares by subset-sum budget fitting."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.llm.tokens import count_tokens
from fieldloom.runtime import Scratch, small_side

#: Tokens up to which a remaining budget is fitted by dynamic programming; what exceeds it is first filled class by class.
FIT_TOKENS = 1 << 15
#: Documents a bucket of the distributed ranking holds on average.
RANK_BUCKET = 1000


def fit(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each length to take, at most counts, so that the tokens come as near below budget as can be.

    Bounded knapsack: copies in binary parts, one bit a reachable sum."""
    take = [0] * len(lengths)
    parts: list[tuple[int, int]] = []  # class, copies
    for k, (size, most) in enumerate(zip(lengths, counts)):
        left, step = min(most, budget // size if size else 0), 1
        while left > 0:
            parts.append((k, min(step, left)))
            left, step = left - step, step * 2
    mask, reach = (1 << (budget + 1)) - 1, [1]
    for k, copies in parts:
        reach.append((reach[-1] | reach[-1] << (copies * lengths[k])) & mask)
        if reach[-1] >> budget & 1:
            break
    at, row = reach[-1].bit_length() - 1, len(reach) - 1
    while at:
        while reach[row - 1] >> at & 1:
            row -= 1
        k, copies = parts[row - 1]
        take[k] += copies
        at -= copies * lengths[k]
        row -= 1
    return take


def plan(lengths: np.ndarray, counts: np.ndarray, budget: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each length class the uses that every document gets, and how many documents get one more.

    Whole passes come first, then the same part of every class, so that lengths keep their spread; a rest beyond FIT_TOKENS is taken
    class by class, and the last rest is fitted exactly."""
    whole = int((lengths * counts).sum())
    passes = min(most, budget // whole)
    every, extra = np.full(len(lengths), passes, np.int64), np.zeros(len(lengths), np.int64)
    rest = budget - passes * whole
    if passes == most or rest <= 0:
        return every, extra
    kept = max(0, rest - FIT_TOKENS)
    extra = np.array([int(c) * kept // whole for c in counts], np.int64)
    rest -= int((extra * lengths).sum())
    for k in np.argsort(-lengths):
        if rest <= FIT_TOKENS:
            break
        add = min(int(counts[k] - extra[k]), max(0, (rest - FIT_TOKENS) // int(lengths[k])))
        extra[k] += add
        rest -= add * int(lengths[k])
    free = counts - extra
    last = fit([int(x) for x in lengths], [int(x) for x in free], int(rest))
    return every, extra + np.array(last, np.int64)


def mix(docs: DataFrame, targets: DataFrame, seed: int = 0, total: int | None = None, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The mix (doc_id, source, n_tokens, uses) and its report, one row a target (source, target_share, aimed_share, max_repeats, documents,
    longest, available_tokens, budget, tokens, share).

    docs: doc_id, source, text. targets: source, target_share, max_repeats; a small table, one row a source. total: tokens of the whole;
    None takes the most at which every source that has tokens can give its share. Sources without any tokens can give none; the
    shares aimed at are those of the others, scaled to 1. A source too small for its share of a given total gives all it may, and the report
    shows it. Documents of other or null sources are not used, nor empty and null texts, which hold no token; a target whose share or
    max_repeats is null or not positive gives none; of a source named twice the first target by share holds. Repeated rows of docs are documents
    each; empty tables give an empty mix and a report of zeros. Which documents of a length get one use more depends on doc_id and seed only.

    The texts are encoded once, where they lie. Only counts by exact length are shuffled to the fitting, which has one task a source: n distinct
    lengths need n(n+1)/2 tokens, so a source of 10^12 tokens has below 1.5 million of them. Documents are ranked within their length in
    buckets of their hash, so no task holds a whole class."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    goal = (
        targets.select("source", F.col("target_share").cast("double"), F.col("max_repeats").cast("long"))
        .filter(F.col("source").isNotNull())
        .withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy(F.desc_nulls_last("target_share"), F.desc_nulls_last("max_repeats"))))
        .filter("r = 1").drop("r")
    )
    goal = small_side(scratch.write(goal, 1))
    # doc_id and source travel as one column beside the text
    wanted = docs.select("doc_id", "source", "text").join(goal.filter("target_share > 0 and max_repeats > 0").select("source"), "source", "left_semi")
    packed = wanted.select(F.struct("doc_id", "source").alias("k"), "text")
    sized = scratch.write(count_tokens(packed, "k", path=path).filter("n_tokens > 0").select("k.doc_id", "k.source", "n_tokens"))
    by_length = scratch.write(sized.groupBy("source", "n_tokens").agg(F.count("*").alias("n")))
    have = by_length.groupBy("source").agg(F.sum("n").alias("documents"), F.sum(F.col("n") * F.col("n_tokens")).alias("available"), F.max("n_tokens").alias("longest"))
    known = goal.join(have, "source", "left").withColumn("usable", F.coalesce(F.col("available"), F.lit(0)) > 0)
    sums = known.filter("usable").agg(F.sum("target_share").alias("s"), F.min(F.col("available") * F.col("max_repeats") / F.col("target_share")).alias("m")).first()
    share_sum = sums["s"] or 1.0
    whole = total if total is not None else int((sums["m"] or 0.0) * share_sum)
    known = known.withColumn("aimed_share", F.when(F.col("usable"), F.col("target_share") / F.lit(share_sum)).otherwise(0.0)).withColumn(
        "budget", F.least(F.round(F.col("aimed_share") * F.lit(whole)).cast("long"), F.coalesce(F.col("available") * F.col("max_repeats"), F.lit(0)))
    )
    known = scratch.write(known, 1)

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("n_tokens")
        every, extra = plan(pdf["n_tokens"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), int(pdf["budget"].iloc[0]), int(pdf["max_repeats"].iloc[0]))
        return pd.DataFrame({"source": pdf["source"], "n_tokens": pdf["n_tokens"], "n": pdf["n"], "every": every, "extra": extra})

    plans = by_length.join(small_side(known.filter("usable").select("source", "budget", "max_repeats")), "source")
    plans = scratch.write(plans.groupBy("source").applyInPandas(fitted, "source string, n_tokens long, n long, every long, extra long"))

    # rank by hash within a length class, in buckets: below the bucket where the wanted number is reached all are taken
    keyed = sized.join(small_side(plans), ["source", "n_tokens"]).withColumn("h", F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed)))
    keyed = keyed.withColumn("b", F.pmod("h", F.ceil(F.col("n") / F.lit(RANK_BUCKET))))
    split_ = keyed.filter("extra > 0 and extra < n")
    sizes = split_.groupBy("source", "n_tokens", "b").agg(F.count("*").alias("in_b"), F.first("extra").alias("extra"))
    before = F.sum("in_b").over(Window.partitionBy("source", "n_tokens").orderBy("b")) - F.col("in_b")
    edges = sizes.withColumn("before", before).filter("before < extra").select("source", "n_tokens", "b", "before", "in_b")
    edges = scratch.write(edges)
    mine = split_.join(small_side(edges), ["source", "n_tokens", "b"], "left")
    inside = mine.filter("before is not null")
    full = inside.filter("before + in_b <= extra").withColumn("uses", F.col("every") + 1)
    edge = inside.filter("before + in_b > extra").withColumn("r", F.row_number().over(Window.partitionBy("source", "n_tokens", "b").orderBy("h", "doc_id")) + F.col("before"))
    edge = edge.withColumn("uses", F.col("every") + F.when(F.col("r") <= F.col("extra"), 1).otherwise(0))
    outside = mine.filter("before is null").withColumn("uses", F.col("every"))
    rest = keyed.filter("extra = 0 or extra = n").withColumn("uses", F.col("every") + F.when(F.col("extra") > 0, 1).otherwise(0))
    out = ["doc_id", "source", "n_tokens", "uses"]
    chosen = rest.select(out).unionByName(full.select(out)).unionByName(edge.select(out)).unionByName(outside.select(out)).filter("uses > 0")
    got = plans.groupBy("source").agg(F.sum(F.col("n_tokens") * (F.col("n") * F.col("every") + F.col("extra"))).alias("tokens"))
    all_tokens = got.agg(F.sum("tokens")).first()[0] or 0
    report = known.join(got, "source", "left").select(
        "source", "target_share", "aimed_share", "max_repeats", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("longest", F.lit(0)).alias("longest"),
        F.coalesce("available", F.lit(0)).alias("available_tokens"), "budget", F.coalesce("tokens", F.lit(0)).alias("tokens"),
        F.when(F.lit(all_tokens > 0), F.coalesce("tokens", F.lit(0)) / F.lit(float(max(all_tokens, 1)))).otherwise(0.0).alias("share"),
    )
    return chosen, report
