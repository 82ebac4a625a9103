"""Train, dev and test splits that keep related records together: an incrementally kept table of components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.runtime import Scratch, hadoop

#: Shares of the splits, in the order in which ties are broken.
RATIOS = {"train": 0.70, "dev": 0.15, "test": 0.15}
#: Components that weigh more than the whole divided by this are placed one by one, so there are fewer of them than this.
HEAVY = 1000
#: Hash buckets in which the other components are placed.
BUCKETS = 4096
#: Spellings of the splits.
SPELLINGS = {"train": "train", "training": "train", "dev": "dev", "val": "dev", "validation": "dev", "test": "test"}


def split_name(c: Column) -> Column:
    """train, dev or test of a spelling in any case and with white space around; null for null and blank; another word in lower case as it is."""
    w = F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    known = F.create_map(*[F.lit(x) for kv in SPELLINGS.items() for x in kv])
    return F.when(w != "", F.coalesce(F.try_element_at(known, w), w))


def entity_of(doc_id: Column) -> Column:
    """The part of doc_id before its last hyphen (the patient), or the whole doc_id where it has none (the business document)."""
    return F.regexp_replace(doc_id, r"-[^-]*$", "")


def roots(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root for each node of edges (a, b): root is the smallest node of its connected component.

    Each round every node points at its smallest neighbour or itself, pointers are doubled until they stand still, and the edges are contracted
    to the roots reached, repeated ones and loops falling away. Every component that still has an edge at least halves, so n nodes take at most log2 n rounds.
    A node of very many edges meets them in partial aggregates; the joins are left to the planner's skew handling."""
    return _rooted(edges, scratch)[0]


def _rooted(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """roots(), and the rounds that it took."""
    both = edges.filter("a != b").select("a", "b").distinct()
    edges = scratch.write(both.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))).distinct())
    known: DataFrame | None = None
    rounds = 0
    while edges.told["rows"]:
        rounds += 1
        p = scratch.write(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")))
        while True:
            up = p.filter("a != p").select(F.col("a").alias("p"), F.col("p").alias("pp"))  # a root's pointer leads nowhere
            nxt = scratch.write(p.join(up, "p", "left").select("a", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")), moved=F.count_if("moved"))
            scratch.drop(p)
            p = nxt
            if not nxt.told["moved"]:
                break
        p = p.select("a", "p")
        if known is None:
            known = p
        else:  # later rounds are of contracted nodes, each a root of the round before
            now = p.select(F.col("a").alias("was"), F.col("p").alias("now"))
            known = scratch.write(known.join(now, F.col("p") == F.col("was"), "left").select("a", F.coalesce("now", "p").alias("p")))
        ends = edges.join(p, "a").select(F.col("p").alias("a"), "b").join(p.select(F.col("a").alias("b"), F.col("p").alias("pb")), "b").select("a", F.col("pb").alias("b"))
        contracted = scratch.write(ends.filter("a != b").distinct())
        scratch.drop(edges)
        edges = contracted
    if known is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")), 0
    return known.select(F.col("a").alias("node"), F.col("p").alias("root")), rounds


class ComponentTable:
    """The persisted table of components: node, comp, weight, seen (the splits its rows carry), given (the one it was ever given), split, status.

    A node is a key in its name space: "0:" and the value for the first key of absorb(), "1:" for the second, and so on.
    status is "kept" (all that its parts carried or were given is one split), "filled" (given a split where there was a deficit), "quarantined" (its parts carry or were
    given different splits: it has no split, and as what was given is remembered, it stays so however often fill() runs) or "open" (no split yet).

    With a path the table lives there: each absorb() or fill() writes a new version beside the earlier ones, which are never changed, and a table opened with the
    path of an earlier one goes on from its latest whole version. Without a path it lives as long as the application."""

    COLUMNS = ["node", "comp", "weight", "seen", "given", "split", "status"]
    SCHEMA = "node string, comp string, weight long, seen array<string>, given string, split string, status string"

    def __init__(self, spark: SparkSession, path: str | None = None, label: str = "components"):
        self.spark, self.scratch, self.path, self.version = spark, Scratch(spark, label), path, 0
        if path:
            folder, fs = hadoop(spark, path)
            if fs.exists(folder):
                names = [s.getPath().getName() for s in fs.listStatus(folder)]
                whole = [int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit() and fs.exists(hadoop(spark, f"{path}/{n}/_SUCCESS")[0])]
                self.version = max(whole, default=0)
        self.empty = self.version == 0
        self.df = spark.createDataFrame([], self.SCHEMA) if self.empty else spark.read.schema(self.SCHEMA).parquet(f"{path}/v={self.version}")

    def _keep(self, table: DataFrame) -> None:
        table = table.select(*self.COLUMNS)
        self.version += 1
        if self.path:
            table.write.mode("overwrite").parquet(f"{self.path}/v={self.version}")  # over what an attempt that failed left
            self.df = self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/v={self.version}")
        else:
            self.df = self.scratch.write(table)
        self.empty = False

    def absorb(self, records: DataFrame, keys: list[Column], split: Column | None = None, weight: Column | int = 1) -> "ComponentTable":
        """Adds records: all keys of one record (document, author, source, entity ...) belong together. Existing components are looked up and merged.

        Keys are compared as strings, each column of keys in a name space of its own; null keys link nothing, and a record without any key is left out.
        split: the split that the record carries, in any spelling, or null. Repeated rows add to the weight, which matters for shares only. Extra columns don't matter.
        Rows are first reduced to one for each distinct set of keys and split, by partial aggregates, so a hot key is one row an input partition."""
        none = F.array().cast("array<string>")
        tagged = F.filter(F.array(*[F.concat(F.lit(f"{i}:"), k.cast("string")) for i, k in enumerate(keys)]), lambda x: x.isNotNull())
        r = records.select(tagged.alias("ks"), split_name(split if split is not None else F.lit(None).cast("string")).alias("s"), (weight if isinstance(weight, Column) else F.lit(weight)).cast("long").alias("w"))
        one = r.filter(F.size("ks") > 0).groupBy("ks", "s").agg(F.sum("w").alias("w"))
        if len(keys) > 1:
            one = self.scratch.write(one)
        # the first key that there is carries what the record has; the others only link
        nodes, edges = one.groupBy(F.col("ks")[0].alias("node")).agg(F.sum("w").alias("w2"), F.collect_set("s").alias("s2")), None
        if len(keys) > 1:
            edges = one.filter(F.size("ks") > 1).select(F.col("ks")[0].alias("a"), F.explode(F.slice("ks", 2, len(keys))).alias("b")).distinct()
            others = edges.select(F.col("b").alias("node")).distinct().select("node", F.lit(0).cast("long").alias("w2"), none.alias("s2"))
            nodes = nodes.unionByName(others).groupBy("node").agg(F.sum("w2").alias("w2"), F.flatten(F.collect_list("s2")).alias("s2"))
        seen = F.array_sort(F.array_union(F.coalesce("seen", none), F.coalesce("s2", none)))
        before = self.df if not self.empty else self.spark.createDataFrame([], self.SCHEMA)
        table = before.join(nodes, "node", "full_outer").select(
            "node", F.coalesce("comp", "node").alias("comp"), (F.coalesce("weight", F.lit(0)) + F.coalesce("w2", F.lit(0))).alias("weight"), seen.alias("seen"), "given", "split", F.coalesce("status", F.lit("open")).alias("status"),
        )
        if edges is not None:
            table = self.scratch.write(table)
            of = table.select("node", "comp")
            lifted = edges.join(of.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a").join(of.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b")
            root, self.rounds = _rooted(lifted.select(F.col("ca").alias("a"), F.col("cb").alias("b")), self.scratch)
            table = table.join(root.select(F.col("node").alias("comp"), "root"), "comp", "left").withColumn("comp", F.coalesce("root", "comp"))
        self._keep(table)
        return self

    def components(self) -> DataFrame:
        """comp, weight, seen (all splits carried or ever given in it), split, status: a row a component. More than one split is a conflict."""
        part = self.df.groupBy("comp", "seen", "given").agg(F.sum("weight").alias("weight"))  # few rows a component, however many nodes it has
        every = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array_union("seen", F.array_compact(F.array("given")))))))
        c = part.groupBy("comp").agg(F.sum("weight").alias("weight"), every.alias("seen"))
        return c.withColumns({
            "split": F.when(F.size("seen") == 1, F.get("seen", F.lit(0))),
            "status": F.when(F.size("seen") > 1, "quarantined").when(F.size("seen") == 1, "kept").otherwise("open"),
        })

    def conflicts(self) -> DataFrame:
        """node, comp, seen of the components whose rows carry, or that were given, more than one split."""
        bad = self.components().filter("status = 'quarantined'").select("comp", "seen")
        return self.df.select("node", "comp").join(bad, "comp").select("node", "comp", "seen")

    def fill(self, ratios: dict[str, float] | None = None, salt: str = "fieldloom-1") -> "ComponentTable":
        """Gives each component its split. One that carries, or was given, a single split keeps it; one with several is quarantined; the others fill the deficits
        against ratios of the whole weight (quarantined ones apart). Heavy ones, of which there are fewer than HEAVY, go first, each to the largest deficit; the
        rest go by buckets of their hash, each bucket to the largest deficit, so only BUCKETS sums reach the driver. Components of weight 0 count as 1 here.
        Splits kept under a name that ratios lacks count in the whole. The outcome depends on the table, the ratios and the salt only."""
        ratios = ratios or RATIOS
        comps = self.components().withColumn("w", F.greatest("weight", F.lit(1)))
        comps = self.scratch.write(comps.withColumn("bucket", F.pmod(F.xxhash64("comp", F.lit(salt)), F.lit(BUCKETS)).cast("int")))
        live = comps.filter("status != 'quarantined'")
        whole = live.agg(F.sum("w")).first()[0] or 0
        sums = dict(map(tuple, live.filter(F.col("split").isin(*ratios)).groupBy("split").agg(F.sum("w")).collect()))  # a row a name in ratios
        short = {s: whole * r - sums.get(s, 0) for s, r in ratios.items()}
        open_ = comps.filter("status = 'open'")
        heavy = open_.filter(F.col("w") * HEAVY > F.lit(whole))
        given: list[tuple[str, str]] = []
        for x in sorted(heavy.select("comp", "w").collect(), key=lambda x: (-x["w"], x["comp"])):
            s = max(short, key=lambda k: short[k])
            short[s] -= x["w"]
            given.append((x["comp"], s))
        placed: list[tuple[int, str]] = []
        for b, w in sorted(map(tuple, open_.filter(F.col("w") * HEAVY <= F.lit(whole)).groupBy("bucket").agg(F.sum("w")).collect()), key=lambda x: (-x[1], x[0])):
            s = max(short, key=lambda k: short[k])
            short[s] -= w
            placed.append((b, s))
        one = self.spark.createDataFrame(given, "comp string, of_comp string")
        many = self.spark.createDataFrame(placed, "bucket int, of_bucket string")
        out = comps.join(F.broadcast(one), "comp", "left").join(F.broadcast(many), "bucket", "left")
        filled = F.when(F.col("status") == "open", F.coalesce("of_comp", "of_bucket"))
        status = F.when(F.col("status") == "open", "filled").otherwise(F.col("status"))
        out = out.select("comp", F.coalesce("split", filled).alias("now"), status.alias("status"))
        table = self.df.drop("split", "status").join(out, "comp").withColumns({"given": F.coalesce("given", "now"), "split": F.col("now")})
        self._keep(table)
        return self


def domain_table(manifest: DataFrame, results: DataFrame, path: str | None = None) -> ComponentTable:
    """The components of the manifest's documents and their results, absorbed one after the other. A record's keys are its document and its entity, so all documents of one
    patient, and the results of each document wherever they are, are merged into one component.

    The entity is derived from doc_id, as the stored partition_key is sometimes wrong; rows without a doc_id are left out."""
    keys = [F.col("doc_id"), entity_of(F.col("doc_id"))]
    t = ComponentTable(manifest.sparkSession, path)
    t.absorb(manifest, keys, F.col("split"))
    t.merges = t.rounds
    return t.absorb(results, keys, F.col("split"), weight=0)


def violations(manifest: DataFrame, results: DataFrame) -> DataFrame:
    """partition_key of each entity whose rows in both tables together carry more than one split."""
    bad = domain_table(manifest, results).conflicts().filter("node LIKE '1:%'")
    return bad.select(F.expr("substring(node, 3)").alias("partition_key")).distinct()


def assigned(manifest: DataFrame, results: DataFrame, ratios: dict[str, float] | None = None, path: str | None = None) -> DataFrame:
    """doc_id, partition_key, split, status of each distinct document of the manifest; split is null for a quarantined entity."""
    t = domain_table(manifest, results, path).fill(ratios)
    docs = manifest.filter("doc_id is not null").select("doc_id", entity_of(F.col("doc_id")).alias("partition_key")).distinct()
    of = t.df.select(F.col("node").alias("n"), "split", "status")
    return docs.join(of, F.concat(F.lit("0:"), "doc_id") == F.col("n")).select("doc_id", "partition_key", "split", "status")
