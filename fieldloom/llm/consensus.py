"""Consensus from several readers' values: iteratively reweighted voting, chance-corrected agreement and reliability of readers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.llm.lookalike import not_plain, remembering, shared
from fieldloom.runtime import Scratch, is_small, small_side, spread

#: Accuracy that a reader is taken to have before anything is known, and the number of readings that this counts as.
PRIOR, PRIOR_N = 0.9, 10.0
#: Largest accuracy that a reader can be given.
TOP = 0.995
#: Upper bounds of the classes of confidence.
LEVELS = (0.65, 0.75, 0.85)
#: Readers up to which each gets a column of its own when votes are brought together.
WIDE = 4
#: Groups up to which their readers' odds, at most WIDE numbers each, are broadcast.
GROUPS = 100_000
#: Other values that a wrong reading is taken to be spread over, at most.
SPREAD = 10
#: Largest change of an accuracy between two rounds at which they stop, and the round from which steps shrink.
STILL, DAMPED = 2e-3, 10
# Spelt-out sexes.
SEXES = {"male": "m", "female": "f", "unknown": "u"}


def _folding(table):
    """What folds a series of texts: canonical characters, case folded, without spaces. table: lookalike.shared()."""

    def run(s: pd.Series) -> pd.Series:
        of = remembering(lambda t: "".join(table.value.examine(t)[0].casefold().split()))
        return pd.Series([None if t is None else of(t) for t in s], dtype=object)

    return run


def _notation(c: Column, field: Column) -> Column:
    """Dates of the four notations in one, a spelt-out sex as its letter; c: folded. Only values of a date's length are matched, and only matching ones taken apart."""
    t = F.translate(c, "/", "-")
    month, day = F.substring_index(t, "-", 1), F.substring_index(F.substring_index(t, "-", 2), "-", -1)
    date = F.concat_ws("-", F.right(t, F.lit(4)), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    us = F.length(c).between(8, 10) & c.rlike(r"^\d{1,2}[/-]\d{1,2}[/-]\d{4}$")
    sexes = F.create_map(*[F.lit(x) for kv in SEXES.items() for x in kv])
    return F.when(us, date).when(field == "sex", F.coalesce(F.try_element_at(sexes, c), c)).otherwise(c)


def comparable(df: DataFrame, value: str, field: str, name: str = "v") -> DataFrame:
    """df with a column name: the value without differences of case, spaces, look-alike characters, date notation and a spelt-out sex. Null stays null.

    Plain ASCII values, nearly all, are folded in the JVM; two disjoint filters send only the others through Python."""
    c = F.col(value)
    odd = F.coalesce(not_plain(c), F.lit(False))
    plain = df.filter(~odd).withColumn(name, _notation(F.lower(F.replace(c, F.lit(" "), F.lit(""))), F.col(field)))
    fold = F.pandas_udf(_folding(shared(df.sparkSession)), T.StringType())
    return plain.unionByName(df.filter(odd).withColumn("__f", fold(c)).withColumn(name, _notation(F.col("__f"), F.col(field))).drop("__f"))


def level(confidence: Column) -> Column:
    """The class of a confidence: 0 for null or NaN, else 1 up to len(LEVELS) + 1."""
    out = F.lit(len(LEVELS) + 1)
    for i, most in reversed(list(enumerate(LEVELS))):
        out = F.when(confidence < most, i + 1).otherwise(out)
    return F.when(confidence.isNull() | F.isnan(confidence), 0).otherwise(out)


class Consensus:
    """Consensus over items (group, item) read by readers.

    votes: group, item (any columns named in item), reader, v (comparable value, not null), lev (class of confidence). Repeated rows count once; if a reader gives
    several values for an item, the one with the largest 64-bit hash counts. Items with fewer than two votes have no consensus of their own. Null groups and items are groups and items of their own.

    Values of an item are compared by their 64-bit hashes, so the votes are brought together as numbers; two different values of one item would have to share a hash,
    at 5e-20 a pair, to be taken for one.

    The readings of an item are reduced to a pattern: who read, with which class of confidence, and who agrees with whom. Items of a
    group with equal patterns are counted, and the rounds run over patterns only, which are exact for the items. A round gives each pattern its consensus by the readers' log odds,
    and each reader its accuracy: how often it agrees with the consensus of the others (its own vote left out), for as often as that consensus is likely
    to be right, smoothed towards PRIOR; likewise each class of confidence over all groups. Rounds end when no accuracy moves by more than STILL; from round DAMPED on
    steps shrink, so that they end; rounds and moved tell how many there were and what moved last.

    Up to WIDE readers the hashes of an item have a column a reader, and a group has at most some thousands of patterns (12,175 for four readers with five classes), so a
    group's rounds run in its one row; more readers are held in lists, whose rounds are joins and aggregates over all patterns. Both have the same rule and the same fixed point."""

    def __init__(self, votes: DataFrame, group: str, item: list[str], readers: list[str] | None = None, values: bool = False):
        """readers: all readers there are, if known; else they are looked up. values: keep what decided() needs."""
        spark = votes.sparkSession
        self.group, self.item = group, item
        self.scratch = scratch = Scratch(spark, "consensus")
        keys = ["g", *item]
        self._votes = votes.select(F.col(group).alias("g"), *item, F.col("reader").cast("string").alias("reader"), F.xxhash64("v").alias("h"), F.col("lev").cast("int").alias("lev"), "v")
        if readers is None:
            readers = [x[0] for x in votes.select(F.col("reader").cast("string")).filter("reader is not null").distinct().limit(WIDE + 1).collect()]
        self.readers = readers = sorted(readers) or [""]  # without any reader there are no votes
        self.wide = len(readers) <= WIDE
        # a pattern's code is what items are counted by: a reader's place, class and cluster, a cluster being named by the place of its first vote
        if self.wide:
            one = [F.max(F.when(F.col("reader") == r, F.col(c))).alias(f"__{c}{i}") for i, r in enumerate(readers) for c in ("h", "lev")]
            packed = self._votes.groupBy(*keys).agg(*one)
            hs = [F.col(f"__h{i}") for i in range(len(readers))]
            first = lambda i: F.coalesce(*[F.when(hs[j] == hs[i], F.lit(f".{j + 1}")) for j in range(i + 1)])
            code = F.concat_ws("|", *[F.when(h.isNotNull(), F.concat(F.lit(f"{i}."), F.col(f"__lev{i}").cast("string"), first(i))) for i, h in enumerate(hs)])
            n = sum((F.when(h.isNotNull(), 1).otherwise(0) for h in hs), F.lit(0))
            differ = F.least(*hs) != F.greatest(*hs) if len(hs) > 1 else F.lit(False)
            some = F.coalesce(*hs, F.lit(0))
            extra = [F.array(*hs).alias("hs"), F.array(*[F.col(f"__lev{i}") for i in range(len(hs))]).alias("levs")]
        else:
            of_reader = self._votes.filter("reader is not null").groupBy(*keys, "reader").agg(F.max("lev").alias("lev"), F.max("h").alias("h"))
            packed = of_reader.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("reader", "lev", "h"))).alias("__rs"))
            clusters = F.col("__rs.h")
            code = F.to_json(F.transform("__rs", lambda r: F.struct(r["reader"].alias("reader"), r["lev"].alias("lev"), F.array_position(clusters, r["h"]).cast("int").alias("c"))))
            some = F.get(clusters, F.lit(0))
            n, differ = F.size("__rs"), F.array_min(clusters) != F.array_max(clusters)
            extra = [clusters.alias("hs")] if values else []
        # as a struct a null group equals itself in joins
        self.items = scratch.write(packed.filter(n > 1).select(F.struct("g").alias("g"), *item, code.alias("code"), differ.alias("differ"), F.pmod(some, F.lit(1 << 20)).cast("int").alias("some"), *extra))
        counted = self.items.groupBy("g", "code").agg(F.count("*").alias("n"))
        kinds = self.items.groupBy("g").agg(F.approx_count_distinct("some").alias("k"))
        self.spread = kinds.select("g", F.log(F.greatest(F.lit(1), F.least(F.lit(SPREAD), F.col("k") - 1)).cast("double")).alias("spread"))
        self.rounds, self.moved, self.levels = 0, 0.0, {}
        if self.wide:
            self._fit_wide(counted)
        else:
            parse = F.from_json("code", "array<struct<reader string, lev int, c int>>")
            self.patterns = scratch.write(counted.select("g", "code", "n", parse.alias("p")))
            self.spread = scratch.write(self.spread, small=True)
            self._fit_lists()

    def _step(self) -> float:
        """How far accuracies go to where a round puts them: all the way at first, ever less from DAMPED on, so that rounds that swing come to rest."""
        return 1.0 / (1 + max(0, self.rounds - DAMPED))

    def _shift(self, sums: DataFrame) -> None:
        """Sets levels, what a class of confidence adds to the odds that its readers have anyway, and moved. sums: lev, ok, n, accuracy, moved; a row a group, reader and class."""
        told = sums.groupBy("lev").agg(
            ((F.sum("ok") + PRIOR * PRIOR_N) / (F.sum("n") + PRIOR_N)).alias("a"), ((F.sum(F.col("accuracy") * F.col("n")) + PRIOR * PRIOR_N) / (F.sum("n") + PRIOR_N)).alias("b"), F.max("moved").alias("moved"),
        ).collect()  # fmt: skip  a row a class, of which there are few
        bound = lambda x: min(TOP, max(1 - TOP, x))
        self.moved = max((x["moved"] for x in told), default=0.0)
        self.levels = {int(x["lev"]): _log_odds(bound(x["a"])) - _log_odds(bound(x["b"])) for x in told}

    def _fit_wide(self, counted: DataFrame) -> None:
        """All rounds of a group between two looks at the classes of confidence run in the one row that holds its patterns."""
        readers, cells = self.readers, "array<struct<reader int, lev int, ok double, n double, votes double>>"
        schema = f"g {counted.schema['g'].dataType.simpleString()}, codes array<string>, ns array<bigint>, spread double, accuracy array<double>, moved double, cells {cells}"
        per_group = counted.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("code", "n"))).alias("x"))
        start = F.array_repeat(F.lit(PRIOR), len(readers))
        state = per_group.join(self.spread, "g").select("g", F.col("x.code").alias("codes"), F.col("x.n").alias("ns"), "spread", start.alias("accuracy"), F.lit(0.0).alias("moved"), F.array().cast(cells).alias("cells"))
        state = self.scratch.write(spread(state))
        while state.told["rows"]:
            self.rounds += 1
            shifts, step = dict(self.levels), self._step()
            nxt = self.scratch.write(state.mapInArrow(lambda batches, shifts=shifts, step=step: _fitted(batches, len(readers), shifts, step), schema), small=True)
            self.scratch.drop(state)
            state = nxt
            c = state.select("accuracy", "moved", F.inline("cells"))
            self._shift(c.select("lev", "ok", "n", F.get("accuracy", F.col("reader")).alias("accuracy"), "moved"))
            if self.moved <= STILL:
                break
        self.state = state
        names = F.array(*[F.lit(r) for r in readers])
        c = state.select("g", "accuracy", F.inline("cells")).groupBy("g", "reader", F.get("accuracy", F.col("reader")).alias("accuracy")).agg(F.sum("votes").alias("votes"))
        self.reliability = c.select("g", F.get(names, F.col("reader")).alias("reader"), "accuracy", "votes")

    def _chosen(self) -> DataFrame:
        """items with winner, the hash of the consensus, votes and votes_for. Only a group's few numbers are joined to its items, and the sums are over its readers' columns."""
        r = range(len(self.readers))
        odds = F.transform("accuracy", lambda a: F.log(a / (1 - a)) + F.col("spread"))
        known = self.state.select("g", *[F.get(odds, F.lit(i)).alias(f"o{i}") for i in r])
        few = is_small(self.state)  # with its patterns it is far larger than the numbers alone
        moved = F.create_map(*[F.lit(x) for k, v in sorted(self.levels.items()) for x in (k, v)]) if self.levels else F.lit(None).cast("map<int,double>")
        d = self.items.join(F.broadcast(known) if few or known.count() <= GROUPS else known, "g")
        d = d.withColumns({f"h{i}": F.get("hs", F.lit(i)) for i in r} | {f"w{i}": F.col(f"o{i}") + F.coalesce(F.try_element_at(moved, F.get("levs", F.lit(i))), F.lit(0.0)) for i in r})
        total = lambda i: sum((F.when(F.col(f"h{j}") == F.col(f"h{i}"), F.col(f"w{j}")).otherwise(0.0) for j in r), F.lit(0.0))
        votes = lambda i: sum((F.when(F.col(f"h{j}") == F.col(f"h{i}"), 1).otherwise(0) for j in r), F.lit(0))
        each = [F.when(F.col(f"h{i}").isNotNull(), F.struct(F.round(total(i), 9).alias("s"), votes(i).alias("n"), F.lit(-i).alias("m"), F.col(f"h{i}").alias("h"))) for i in r]
        best = F.array_max(F.array(*each))
        return d.withColumn("__best", best).select("g", *self.item, "differ", "hs", F.col("__best.h").alias("winner"), F.size(F.array_compact("hs")).alias("votes"), F.col("__best.n").alias("votes_for"))

    @staticmethod
    def _odds(a: Column) -> Column:
        return F.log(a / (1 - a))

    def _weighted(self, df: DataFrame, acc: DataFrame | None) -> DataFrame:
        """df (g, p ...) with spread and w, the weight of each vote of p: log odds of the reader's accuracy in the group, moved by its class of confidence, plus the log of the number of other values."""
        votes = df.select("*", F.posexplode("p").alias("__i", "__r")).select("g", "code", "__i", F.col("__r.reader").alias("reader"), F.col("__r.lev").alias("lev"))
        known = small_side(self.spread)
        moved = F.create_map(*[F.lit(x) for k, v in sorted(self.levels.items()) for x in (k, v)]) if self.levels else F.lit(None).cast("map<int,double>")
        if acc is None:
            odds = votes.withColumn("o", F.lit(_log_odds(PRIOR)))
        else:
            odds = votes.join(small_side(acc), ["g", "reader"], "left").withColumn("o", F.coalesce(self._odds(F.col("accuracy")), F.lit(_log_odds(PRIOR))))
        w = odds.join(known, "g").select("g", "code", "__i", "spread", (F.col("o") + F.col("spread") + F.coalesce(F.try_element_at(moved, F.col("lev")), F.lit(0.0))).alias("w"))
        w = w.groupBy("g", "code").agg(F.first("spread").alias("spread"), F.array_sort(F.collect_list(F.struct("__i", "w")))["w"].alias("w"))
        return df.join(w, ["g", "code"])

    @staticmethod
    def _winner(p: Column, w: Column, without: Column | None = None) -> Column:
        """The cluster with the largest sum of weights (without: leaving one vote out); among equal sums the one with more votes, then the first reader's."""
        idx = F.sequence(F.lit(1), F.size(p))
        total = lambda c: F.aggregate(idx, F.lit(0.0), lambda s, i: s + F.when((F.get(p, i - 1)["c"] == c) & (F.lit(True) if without is None else i != without), F.get(w, i - 1)).otherwise(0.0))
        votes = lambda c: F.size(F.filter(idx, lambda i: (F.get(p, i - 1)["c"] == c) & (F.lit(True) if without is None else i != without)))
        cs = F.array_distinct(F.transform(p, lambda r: r["c"]))
        best = F.array_max(F.filter(F.transform(cs, lambda c: F.struct(F.round(total(c), 9).alias("s"), votes(c).alias("n"), (-c).alias("m"))), lambda x: x["n"] > 0))
        return -best["m"]

    @staticmethod
    def _sureness(p: Column, w: Column, spread: Column, without: Column) -> Column:
        """How likely the consensus of the others is the true value, by their weights: its likelihood against those of the other clusters and of the values nobody gave."""
        idx = F.sequence(F.lit(1), F.size(p))
        cs = F.array_distinct(F.transform(F.filter(idx, lambda i: i != without), lambda i: F.get(p, i - 1)["c"]))
        likely = F.transform(cs, lambda c: F.exp(F.least(F.lit(50.0), F.aggregate(idx, F.lit(0.0), lambda s, i: s + F.when((F.get(p, i - 1)["c"] == c) & (i != without), F.get(w, i - 1)).otherwise(0.0)))))
        rest = F.greatest(F.lit(0.0), F.exp(spread) + 1 - F.size(cs))
        return F.array_max(likely) / (F.aggregate(likely, F.lit(0.0), lambda a, b: a + b) + rest)

    def _fit_lists(self) -> None:
        s = self.scratch
        acc: DataFrame | None = None
        sums: DataFrame | None = None
        while True:
            self.rounds += 1
            each = self._weighted(self.patterns, acc).select("g", "n", "p", "w", "spread", F.posexplode("p").alias("i", "r"))
            agrees = self._winner(F.col("p"), F.col("w"), F.col("i") + 1) == F.col("r.c")
            sure = self._sureness(F.col("p"), F.col("w"), F.col("spread"), F.col("i") + 1)
            told = each.select("g", "r.reader", "r.lev", "n", agrees.alias("ok"), sure.alias("sure"))
            # wrong values seldom agree, so the chance to agree is the accuracy times the chance that the others are right
            s.drop(sums)
            sums = s.write(told.groupBy("g", "reader", "lev").agg(F.sum(F.when(F.col("ok"), F.col("n")).otherwise(0)).alias("ok"), F.sum(F.col("n") * F.round("sure", 9)).alias("n"), F.sum("n").alias("votes")))
            goal = F.least(F.lit(TOP), (F.sum("ok") + PRIOR * PRIOR_N) / (F.sum("n") + PRIOR_N))
            new = sums.groupBy("g", "reader").agg(goal.alias("goal"), F.sum("votes").cast("double").alias("votes"))
            new = new.withColumn("was", F.lit(PRIOR)) if acc is None else new.join(acc.select("g", "reader", F.col("accuracy").alias("was")), ["g", "reader"])
            new = new.select("g", "reader", (F.col("was") + (F.col("goal") - F.col("was")) * self._step()).alias("accuracy"), "was", "votes")
            now = s.write(new.select("g", "reader", "accuracy", "votes", F.abs(F.col("accuracy") - F.col("was")).alias("moved")), small=True)
            s.drop(acc)
            acc = now
            self._shift(sums.join(acc.drop("votes"), ["g", "reader"]))
            if self.moved <= STILL:
                break
        self.reliability = acc.select("g", "reader", "accuracy", "votes")
        self._acc = acc

    def _list_winners(self, patterns: DataFrame) -> DataFrame:
        return self._weighted(patterns, self._acc).select("g", "code", "p", self._winner(F.col("p"), F.col("w")).alias("winner"))

    def decided(self) -> DataFrame:
        """group, item..., v (the consensus), votes, votes_for."""
        if self.wide:
            known = self._chosen().select("g.g", *self.item, F.col("winner").alias("h"), "votes", "votes_for")
        else:
            votes_for = F.size(F.filter("p", lambda r: r["c"] == F.col("winner")))
            d = self.scratch.write(self._list_winners(self.patterns).select("g", "code", "winner", F.size("p").alias("votes"), votes_for.alias("votes_for")))
            known = self.items.join(small_side(d), ["g", "code"]).select("g.g", *self.item, F.element_at("hs", F.col("winner")).alias("h"), "votes", "votes_for")
        keys = ["g", *self.item, "h"]
        values = self._votes.groupBy(*keys).agg(F.min("v").alias("v"))
        on = [known[k].eqNullSafe(values[k]) for k in keys]
        return known.join(values, on).select(known["g"].alias(self.group), *[known[c] for c in self.item], values["v"], "votes", "votes_for")

    def dissent(self) -> DataFrame:
        """group, item..., reader of each vote that is not the consensus. Only items with more than one value are looked at."""
        if self.wide:
            names = F.array(*[F.lit(r) for r in self.readers])
            against = F.filter(F.transform("hs", lambda h, i: F.when(h != F.col("winner"), F.get(names, i))), lambda x: x.isNotNull())
            return self._chosen().filter("differ").select(F.col("g.g").alias(self.group), *self.item, F.explode(against).alias("reader"))
        d = self._list_winners(self.patterns.filter(F.array_max(F.transform("p", lambda r: r["c"])) > F.array_min(F.transform("p", lambda r: r["c"]))))
        against = F.filter("p", lambda r: r["c"] != F.col("winner"))
        d = self.scratch.write(d.select("g", "code", F.transform(against, lambda r: r["reader"]).alias("readers")))
        return self.items.filter("differ").join(small_side(d), ["g", "code"]).select(F.col("g.g").alias(self.group), *self.item, F.explode("readers").alias("reader"))

    def reliabilities(self) -> DataFrame:
        """group, reader, accuracy (smoothed, leave-one-out), votes."""
        return self.reliability.select(F.col("g.g").alias(self.group), "reader", "accuracy", F.col("votes").cast("long").alias("votes"))


def _log_odds(a: float) -> float:
    import math

    return math.log(a / (1 - a))


def _fitted(batches, readers: int, shifts: dict[int, float], step: float):
    """The state's rows with accuracy, moved and cells of the group's readers, come to rest under the given shifts of the classes of confidence; a first step of less than 1 is one of many."""
    import pyarrow as pa

    for b in batches:
        at = b.schema.get_field_index
        acc, moved, cells = [], [], []
        for codes, ns, spread_, was in zip(*(b.column(at(c)).to_pylist() for c in ("codes", "ns", "spread", "accuracy"))):
            a, m, c = fit_patterns(codes, ns, spread_, was, readers, shifts, step)
            acc.append(a), moved.append(m), cells.append(c)
        made = {"accuracy": acc, "moved": moved, "cells": cells}
        yield pa.RecordBatch.from_arrays([pa.array(made[f.name], type=f.type) if f.name in made else b.column(i) for i, f in enumerate(b.schema)], schema=b.schema)


def fit_patterns(codes: list[str], ns: list[int], spread_: float, was: list[float], readers: int, shifts: dict[int, float], step: float) -> tuple[list[float], float, list[dict]]:
    """(accuracy of each reader, how far it is from was, sums of each reader and class) of one group's patterns. The rounds are those of Consensus, for all patterns at once."""
    import numpy as np

    m, r = len(codes), readers
    place, lev = np.full((m, r), -1), np.zeros((m, r), np.int64)
    for i, code in enumerate(codes):
        for vote in code.split("|"):
            k, l, c = vote.split(".")
            place[i, int(k)], lev[i, int(k)] = int(c) - 1, int(l)
    n, there = np.asarray(ns, float), place >= 0
    moved = np.zeros((m, r))
    for k, v in shifts.items():
        moved[lev == k] = v
    same = np.stack([place == k for k in range(r)], axis=2)  # pattern, vote, cluster
    count = same.sum(axis=1)
    acc, row = np.asarray(was, float), np.arange(m)
    turn = 0
    while True:
        turn += 1
        w = np.where(there, np.log(acc / (1 - acc)) + spread_ + moved, 0.0)
        score = (same * w[:, :, None]).sum(axis=1)
        ok, sure = np.zeros((m, r)), np.zeros((m, r))
        for i in range(r):
            on = there[:, i]
            mine = np.where(on, place[:, i], 0)
            left, votes = score.copy(), count.copy()
            left[row[on], mine[on]] -= w[on, i]
            votes[row[on], mine[on]] -= 1
            open_ = votes > 0
            best = np.where(open_, np.round(left, 9), -np.inf)
            top = best == best.max(axis=1, keepdims=True)
            most = np.where(top, votes, -1)
            winner = (top & (most == most.max(axis=1, keepdims=True))).argmax(axis=1)
            ok[:, i] = on & (winner == mine)
            likely = np.where(open_, np.exp(np.minimum(50.0, left)), 0.0)
            rest = np.maximum(0.0, np.exp(spread_) + 1 - open_.sum(axis=1))
            with np.errstate(invalid="ignore", divide="ignore"):
                sure[:, i] = np.where(on, np.round(likely.max(axis=1) / (likely.sum(axis=1) + rest), 9), 0.0)
        hit, base = (ok * n[:, None]).sum(axis=0), (sure * n[:, None]).sum(axis=0)
        goal = np.where(there.any(axis=0), np.minimum(TOP, (hit + PRIOR * PRIOR_N) / (base + PRIOR_N)), PRIOR)
        new = acc + (goal - acc) * step / (1 + max(0, turn - DAMPED))
        far = np.abs(new - acc).max()
        acc = new
        if far <= STILL / 2:
            break
    cells = []
    for i in range(r):
        for k in sorted(set(lev[there[:, i], i].tolist())):
            on = there[:, i] & (lev[:, i] == k)
            cells.append({"reader": i, "lev": k, "ok": float((ok[on, i] * n[on]).sum()), "n": float((sure[on, i] * n[on]).sum()), "votes": float(n[on].sum())})
    return acc.tolist(), float(np.abs(acc - np.asarray(was, float)).max()), cells


def agreement(votes: DataFrame, group: str, item: list[str]) -> DataFrame:
    """group, items, votes, observed, alpha: Krippendorff's alpha for nominal values over the items with at least two votes, which allows for missing readings.

    alpha is null where no disagreement could be expected (fewer than two votes, or one value only). Repeated rows count once. Counts are exact, by partial aggregates only."""
    keys = [group, *item]
    one = votes.select(*keys, "reader", "v").distinct()
    per_value = one.groupBy(*keys, "v").agg(F.count("*").alias("n"))
    per_item = per_value.groupBy(*keys).agg(F.sum("n").alias("m"), F.sum(F.col("n") * (F.col("n") - 1)).alias("same"), F.collect_list(F.struct("v", "n")).alias("vs")).filter("m > 1")
    observed = per_item.groupBy(group).agg(F.count("*").alias("items"), F.sum("m").alias("votes"), F.sum(F.col("same") / (F.col("m") - 1)).alias("same"))
    values = per_item.select(group, F.inline("vs")).groupBy(group, "v").agg(F.sum("n").cast("double").alias("n"))
    expected = values.groupBy(group).agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs"))
    n = F.col("votes").cast("double")
    do, de = 1 - F.col("same") / n, 1 - F.col("pairs") / (n * (n - 1))
    return observed.join(expected.withColumnRenamed(group, "__g"), F.col(group).eqNullSafe(F.col("__g"))).select(group, "items", "votes", (1 - do).alias("observed"), F.when(de > 0, 1 - do / de).alias("alpha"))


def domain_votes(attempts: DataFrame) -> DataFrame:
    """doc_id, field_name, reader, v, lev of the non-null readings."""
    a = attempts.select("doc_id", "field_name", F.col("tier").alias("reader"), "value", "confidence").filter("value is not null and tier is not null")
    return comparable(a, "value", "field_name").select("doc_id", "field_name", "reader", "v", level(F.col("confidence")).alias("lev"))


def domain_consensus(attempts: DataFrame, values: bool = False) -> Consensus:
    """The consensus of the form fields' readers, that is tiers; a tier is looked up in its column alone."""
    tiers = [x[0] for x in attempts.select(F.col("tier").cast("string").alias("t")).filter("t is not null").distinct().limit(WIDE + 1).collect()]
    return Consensus(domain_votes(attempts), "field_name", ["doc_id"], tiers, values)


def misreadings(attempts: DataFrame) -> DataFrame:
    """doc_id, field_name, tier of each non-null reading that is not the consensus of its item, as distinct rows; items with fewer than two readings have none."""
    return domain_consensus(attempts).dissent().select("doc_id", "field_name", F.col("reader").alias("tier")).distinct()
