"""The label dictionary: flattening, batches, distinctive and generic aliases, label matching, routing, and what corrections add to it."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.functions.text import label_words, stripped, title, without_box_number

#: Similarity from which a label counts as matched, score from which a document is routed at once, characters of a label looked at.
MATCH_FLOOR, ROUTE_AT, LABEL_CHARS = 0.3, 1.0, 512
#: Aliases that a task holds at once; larger vocabularies come in blocks.
VOCABULARY_ROWS = 10_000


def aliases(dictionary: DataFrame) -> DataFrame:
    """field, vertical, alias_pos, alias: a row an alias, in the order of the dictionary."""
    return dictionary.select(F.col("canonical_name").alias("field"), "vertical", F.posexplode("aliases").alias("alias_pos", "alias"))


def alias_map(dictionary: DataFrame) -> DataFrame:
    """As aliases(), a field without any having its title as one; the first of equal aliases (in any case) of a field counts."""
    bare = dictionary.filter(F.size(F.coalesce("aliases", F.array().cast("array<string>"))) == 0).select(F.col("canonical_name").alias("field"), "vertical", F.lit(0).alias("alias_pos"), title(F.col("canonical_name")).alias("alias"))
    every = aliases(dictionary).unionByName(bare)
    return every.groupBy("field", "vertical", F.upper("alias").alias("upper")).agg(F.min(F.struct("alias_pos", "alias")).alias("a")).select("field", "vertical", "a.alias_pos", "a.alias")


def batches(dictionary: DataFrame) -> DataFrame:
    """batch, records, aliases: what the dictionary holds in batch n, that is the first n aliases of each record. One range a alias, no job a batch."""
    top = F.max(F.size("aliases")).alias("top")
    last = dictionary.agg(top).first()["top"] or 0
    a = aliases(dictionary).select("field", "vertical", F.explode(F.sequence(F.col("alias_pos") + 1, F.lit(max(last, 1)))).alias("batch"))
    return a.groupBy("batch").agg(F.count_distinct("field", "vertical").alias("records"), F.count("*").alias("aliases"))


def distinctive(dictionary: DataFrame) -> DataFrame:
    """alias, weight: upper-cased healthcare aliases that base, insurance and hr records don't have, weighing 1 / number of healthcare records with it."""
    a = aliases(dictionary).withColumn("alias", F.upper(stripped(F.col("alias")))).select("field", "vertical", "alias").distinct()
    other = a.filter(F.col("vertical").isin("base", "insurance", "hr")).select("alias").distinct()
    return a.filter("vertical = 'healthcare'").groupBy("alias").agg(F.count("*").alias("n")).join(other, "alias", "left_anti").select("alias", (1 / F.col("n")).alias("weight"))


def score_texts(docs: DataFrame, vocabulary: DataFrame, text: str = "text", block: int = VOCABULARY_ROWS) -> DataFrame:
    """docs with score: the sum of the weights of the aliases that its upper-cased text contains, each once; null texts score 0.

    The vocabulary comes in blocks of that many aliases, in order; each is searched for in one walk over a text where it lies, without join or shuffle."""
    rows = vocabulary.select("alias", F.col("weight").cast("double").alias("weight")).orderBy("alias").toLocalIterator()
    out, parts = docs.withColumn("_upper", F.upper(F.coalesce(F.col(text), F.lit("")))), []
    while chunk := [(r["alias"], r["weight"]) for _, r in zip(range(block), rows)]:
        parts.append(f"_score{len(parts)}")
        out = out.withColumn(parts[-1], _scored(dict(chunk))(F.col("_upper")))
    total = sum((F.col(p) for p in parts), F.lit(0.0))
    return out.withColumn("score", total).drop("_upper", *parts)


def _scored(weights: dict[str, float]):
    """What sums up the weights of the words in a text, as an Arrow UDF: by an automaton over all of them where there is one, else word by word."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        always = weights.get("", 0.0)  # every text contains nothing
        try:
            import ahocorasick

            search = ahocorasick.Automaton()
            for a in weights:
                if a:
                    search.add_word(a, a)
            search.make_automaton()
            found = (lambda t: {a for _, a in search.iter(t)}) if len(search) else (lambda t: ())
        except ImportError:
            found = lambda t: {a for a in weights if a and a in t}
        for s in batches:
            yield s.map(lambda t: always + sum(weights[a] for a in sorted(found(t)))).astype("float64")

    return F.pandas_udf(run, T.DoubleType())


def routed(score: Column, second: Column) -> tuple[Column, Column]:
    """(stage, vertical): healthcare at once from ROUTE_AT on, else the second stage's word, where anything but business is healthcare."""
    first = F.coalesce(score >= ROUTE_AT, F.lit(False))
    return F.when(first, 1).otherwise(2), F.when(first | F.coalesce(F.lower(second) != "business", F.lit(True)), "healthcare").otherwise("business")


def generic(dictionary: DataFrame) -> DataFrame:
    """field, vertical, alias of one-word aliases whose word occurs in aliases of at least two other fields."""
    a = aliases(dictionary).select("field", "vertical", "alias", label_words(F.col("alias")).alias("words"))
    uses = a.select("field", F.explode("words").alias("word")).distinct()
    single = a.filter(F.size("words") == 1).select("field", "vertical", "alias", F.col("words")[0].alias("word"))
    others = single.join(uses.withColumnRenamed("field", "other"), "word").filter(F.col("field") != F.col("other"))
    return others.groupBy("field", "vertical", "alias").agg(F.count_distinct("other").alias("n")).filter("n >= 2").select("field", "vertical", "alias")


def match_labels(labels: DataFrame, dictionary: DataFrame, label: str = "label", free: bool = False) -> DataFrame:
    """label, field, vertical, alias, score: the best alias of each distinct label, by the part of the label that it is.

    An alias has to be in the label, and its words in a row among the label's words. So the words of a label are joined with the first words of aliases by equality,
    and no label meets every alias. free: the label is free text, of which nothing is cut off and no box number taken away. Ties go to the first field and the first of its aliases; below MATCH_FLOOR there is no match."""
    fields = dictionary.select(F.col("canonical_name").alias("field"), "vertical").distinct()
    pos = fields.withColumn("field_pos", F.row_number().over(Window.orderBy("vertical", "field")))  # a dictionary's fields: few rows
    a = aliases(dictionary).join(pos, ["field", "vertical"]).withColumn("words", label_words(F.col("alias"))).filter(F.size("words") > 0)
    a = a.select("field", "vertical", "field_pos", "alias_pos", "alias", F.upper("alias").alias("upper"), F.array_join("words", " ").alias("run"), F.size("words").alias("len"))
    most = a.agg(F.max("len")).first()[0] or 1
    one = labels.filter(F.col(label).isNotNull()).select(F.col(label).alias("label")).distinct().withColumn("clean", F.upper("label") if free else F.substring(without_box_number(F.upper("label")), 1, LABEL_CHARS)).withColumn("words", label_words(F.col("clean")))
    # each word with those that follow it, as many as the longest alias has, meets the aliases that begin with it
    at = F.transform(F.sequence(F.lit(1), F.size("words")), lambda i: F.struct(F.element_at("words", i).alias("first"), F.slice("words", i, F.lit(most)).alias("tail")))
    each = one.filter(F.size("words") > 0).select("label", "clean", F.inline(F.array_distinct(at)))
    a = a.withColumn("first", F.substring_index("run", " ", 1))
    hits = each.join(F.broadcast(a) if a.limit(VOCABULARY_ROWS + 1).count() <= VOCABULARY_ROWS else a, "first")
    hits = hits.filter((F.array_join(F.slice("tail", F.lit(1), F.col("len")), " ") == F.col("run")) & F.contains("clean", "upper"))
    score = F.least(F.lit(1.0), F.length("upper") / F.length(F.trim("clean")))
    best = hits.withColumn("score", score).groupBy("label").agg(F.min(F.struct((-F.col("score")).alias("s"), "field_pos", "alias_pos", "field", "vertical", "alias")).alias("b"))
    return best.select("label", "b.field", "b.vertical", "b.alias", F.round(-F.col("b.s"), 6).alias("score")).filter(F.col("score") >= MATCH_FLOOR)


def learned(corrections: DataFrame, dictionary: DataFrame) -> DataFrame:
    """field, vertical, alias: phrasings from corrections that the dictionary has neither as an alias of that field nor so in another case, each once in its first form."""
    fields = dictionary.select(F.col("canonical_name").alias("field"), "vertical")
    c = corrections.select(F.lower(stripped(F.col("field_name"))).alias("field"), stripped(F.col("learned_alias")).alias("alias")).filter("alias <> ''")
    new = c.join(fields, "field").groupBy("field", "vertical", F.upper("alias").alias("upper")).agg(F.min("alias").alias("alias"))
    known = aliases(dictionary).select("field", "vertical", F.upper(stripped(F.col("alias"))).alias("upper")).distinct()
    return new.join(known, ["field", "vertical", "upper"], "left_anti").select("field", "vertical", "alias")


def metadata(dictionary: DataFrame) -> DataFrame:
    """field, vertical, label, kind (string_like or coerced; null where a reader can't be asked for it), protected (personal health or card data)."""
    kind = F.when(F.col("data_type").isin("string", "enum"), "string_like").when(F.col("data_type").isin("boolean", "integer", "float", "date"), "coerced")
    return dictionary.select(F.col("canonical_name").alias("field"), "vertical", title(F.col("canonical_name")).alias("label"), kind.alias("kind"), F.lower("data_class").isin("phi", "pci").alias("protected"))


def with_overlay(dictionary: DataFrame, learned_: DataFrame) -> DataFrame:
    """aliases() of a dictionary and, after them, those of an overlay (field, vertical, alias): a snapshot that is passed on, not a state."""
    base = aliases(dictionary)
    top = base.groupBy("field", "vertical").agg((F.max("alias_pos") + 1).alias("top"))
    more = learned_.select("field", "vertical", "alias").distinct().withColumn("r", F.row_number().over(Window.partitionBy("field", "vertical").orderBy("alias")) - 1)
    more = more.join(top, ["field", "vertical"], "left").select("field", "vertical", (F.coalesce("top", F.lit(0)) + F.col("r")).cast("int").alias("alias_pos"), "alias")
    return base.unionByName(more)


def totals(dictionary: DataFrame) -> DataFrame:
    """records, aliases of a dictionary."""
    return dictionary.agg(F.count("*").alias("records"), F.coalesce(F.sum(F.size(F.coalesce("aliases", F.array().cast("array<string>")))), F.lit(0)).cast("long").alias("aliases"))


META = ["data_type", "description", "data_class", "sensitivity", "source_standard"]
#: Order of the verticals in a seed, the base first; others follow by name.
VERTICALS = ["base", "insurance", "healthcare", "hr"]


def build_seed(fields: DataFrame, alias_lists: DataFrame, base: str = "base") -> DataFrame:
    """canonical_name, vertical, META, aliases, rank: the records of a dictionary, by rank of the vertical and name.

    fields: canonical_name, vertical, META of every form, those that a form takes over from the base included. alias_lists: canonical_name, vertical, aliases. A field taken over from the base is a record of
    its own only if it has aliases of its own or other metadata there; its aliases are its own, else those of the base, else none."""
    key = ["canonical_name", "vertical"]
    one = fields.groupBy(*key).agg(F.max(F.struct(*META)).alias("m"))
    own = alias_lists.groupBy(*key).agg(F.max("aliases").alias("own"))
    of_base = one.filter(F.col("vertical") == base).select("canonical_name", F.col("m").alias("base_m"))
    base_aliases = alias_lists.filter(F.col("vertical") == base).groupBy("canonical_name").agg(F.max("aliases").alias("base_own"))
    j = one.join(own, key, "left").join(of_base, "canonical_name", "left").join(base_aliases, "canonical_name", "left")
    kept = (F.col("vertical") == base) | F.col("base_m").isNull() | F.col("own").isNotNull() | ~F.col("m").eqNullSafe(F.col("base_m"))
    rank = F.array_position(F.array(*[F.lit(v) for v in VERTICALS]), F.col("vertical"))
    rank = F.when(rank == 0, len(VERTICALS)).otherwise(rank - 1).cast("int")
    none = F.array().cast("array<string>")
    return j.filter(kept).select(*key, *[F.col("m")[c].alias(c) for c in META], F.coalesce("own", "base_own", none).alias("aliases"), rank.alias("rank")).orderBy("rank", "vertical", "canonical_name")


def sweep(docs: DataFrame, dictionary: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """batch, key, score: what score_texts() gives with the first n aliases of each record, for every n at once; documents without any distinctive alias in a batch have no row there.

    A text is searched once for all aliases; what it holds is joined with the batches in which an alias is distinctive, and its weight there."""
    a = aliases(dictionary).withColumn("alias", F.upper(stripped(F.col("alias"))))
    last = dictionary.agg(F.max(F.size("aliases"))).first()[0] or 0
    each = a.select("field", "vertical", "alias", F.explode(F.sequence(F.col("alias_pos") + 1, F.lit(max(last, 1)))).alias("batch")).distinct()
    other = each.filter(F.col("vertical").isin("base", "insurance", "hr")).select("batch", "alias").distinct()
    mine = each.filter("vertical = 'healthcare'").groupBy("batch", "alias").agg((1 / F.count("*")).alias("weight")).join(other, ["batch", "alias"], "left_anti")
    words = [r[0] for r in mine.select("alias").distinct().orderBy("alias").toLocalIterator()]
    found = docs.filter(F.col(text).isNotNull()).select(key, F.explode(_held(words)(F.upper(F.col(text)))).alias("alias"))
    return found.join(F.broadcast(mine), "alias").groupBy("batch", key).agg(F.sum("weight").alias("score"))


def _held(words: list[str]):
    """Which of the words a text contains, each once, as an Arrow UDF."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            import ahocorasick

            search = ahocorasick.Automaton()
            for w in words:
                search.add_word(w, w)
            search.make_automaton()
            found = (lambda t: sorted({w for _, w in search.iter(t)})) if words else (lambda t: [])
        except ImportError:
            found = lambda t: [w for w in words if w in t]
        for s in batches:
            yield s.map(found)

    return F.pandas_udf(run, T.ArrayType(T.StringType()))
