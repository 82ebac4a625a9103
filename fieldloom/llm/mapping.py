"""Mapping of freely typed values to a reference list by a prefix-filter set-similarity join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.lookalike import with_forms
from fieldloom.runtime import Scratch, is_small, small_side

#: Jaccard similarity of words from which a value is taken for a phrase of the reference list.
WORDS = 0.60
#: For the values that are then left, Jaccard similarity of letters from which a pair is a candidate; from SURE on it needs no further check; below, the edit distance may be at most this part of the reference's length.
CANDIDATE, SURE, EDITS = 0.45, 0.60, 0.40

#: What stands before a label: a path of one name, or a number, with the name of what is numbered or a sign.
BEFORE = r"^(?:\p{L}{4,}[./:] ?(?=\S))|^(?:\p{L}{3} \d+[a-z]?|§ ?\d+|\(\d+\)|\d+[a-z]?[).:]?)\s+"
#: What stands in brackets.
REMARK = r"[(\[][^)\]]*[)\]]"


def words_of(c: Column) -> Column:
    """The words of a typed value, as they can be compared: camel case and underscores parted, lower case, a few signs as the words they stand for. c: in canonical characters."""
    t = F.lower(F.regexp_replace(c, r"(\p{Ll})(\p{Lu})", "$1 $2"))
    t = F.replace(t, F.lit("_"), F.lit(" "))
    for mark, word in (("#", " number "), ("&", " and "), ("+", " and "), ("'", "")):
        t = F.replace(t, F.lit(mark), F.lit(word))
    return F.regexp_extract_all(t, F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))


def bare(c: Column) -> Column:
    """A typed value without what stands before it and in brackets."""
    t = F.trim(F.regexp_replace(F.replace(c, F.lit("_"), F.lit(" ")), r"\s+", " "))
    t = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace(t, r"(\p{Ll})(\p{Lu})", "$1 $2")), BEFORE, ""), BEFORE, "")
    return F.regexp_replace(t, REMARK, " ")


def word_keys(w: Column, of_list: bool) -> Column:
    """What two words have in common of which one is the other misspelt or cut short: a form that lacks one letter; a beginning; a beginning of the consonants; the first and last letter.

    A misspelt word and the one meant share the first, a short form (nbr, addr, dt) and the whole word one of the others. of_list: w is a word of the list, which short forms are made of."""
    n = F.length(w)
    lacking = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("d:"), w.substr(F.lit(1), i - 1), w.substr(i + 1, n)))
    consonants = F.concat(w.substr(F.lit(1), F.lit(1)), F.regexp_replace(F.regexp_replace(w.substr(F.lit(2), n), "[aeiou]", ""), r"(.)\1", "$1"))
    begins = lambda x, mark: F.when(F.length(x) > 1, F.transform(F.sequence(F.lit(2), F.length(x)), lambda i: F.concat(F.lit(mark), x.substr(F.lit(1), i)))).otherwise(F.array().cast("array<string>"))
    short = F.concat(begins(w, "p:"), begins(consonants, "c:")) if of_list else F.array(F.concat(F.lit("p:"), w), F.concat(F.lit("c:"), consonants))
    ends = F.array(F.concat(F.lit("e:"), w.substr(F.lit(1), F.lit(1)), w.substr(n, F.lit(1))))
    return F.array_distinct(F.concat(lacking, F.array(F.concat(F.lit("d:"), w)), short, ends))


def meant_words(typed: DataFrame, known: DataFrame) -> DataFrame:
    """w, v: for each word w of typed the words v of known (v, rep) that it can stand for, as their rep: itself, or those that it is within one slip of (a letter wrong, missing, too many, or two swapped) or a short form of.

    An equi-join on word_keys, of which a word has about as many as letters; a word that known has stands for itself only."""
    itself = typed.join(known, F.col("w") == F.col("v")).select("w", F.col("rep").alias("v"))
    left = typed.join(known, F.col("w") == F.col("v"), "left_anti").filter((F.length("w") > 1) & ~F.col("w").rlike(r"\d{2}"))
    a = left.select("w", F.explode(word_keys(F.col("w"), False)).alias("key"))
    b = known.filter(F.length("v") > 1).select("v", "rep", F.explode(word_keys(F.col("v"), True)).alias("key"))
    pairs = a.join(b, "key").select("w", "v", "rep").distinct()
    lev = F.levenshtein("w", "v")
    letters = lambda c: F.array_sort(F.split(c, ""))
    slip = (F.length("w") > 2) & ((lev == 1) | ((lev == 2) & (letters("w") == letters("v"))))
    short = (F.length("w") < F.length("v")) & (F.left("w", F.lit(1)) == F.left("v", F.lit(1))) & F.regexp_like("v", F.array_join(F.split("w", ""), ".*"))
    return itself.unionByName(pairs.filter(slip | short).select("w", F.col("rep").alias("v"))).distinct()


def list_words(refs: DataFrame) -> DataFrame:
    """v, rep of the words of the reference list (entry, phrase, canonical). A word that the list itself writes with a full stop (no.) is a short form; its rep is the longer word of
    the same first letter that occurs in most of the entries with it. The rep of any other word is the word."""
    each = refs.select("entry", "canonical", F.explode(words_of(F.col("canonical"))).alias("v"))
    words = each.select("v").distinct()
    dotted = refs.select("entry", F.explode(F.regexp_extract_all(F.lower("canonical"), F.lit(r"(\p{L}{2,4})[.]"), F.lit(1))).alias("v")).distinct()
    long = each.select("entry", F.col("v").alias("rep")).distinct()
    with_it = dotted.join(long, "entry").filter((F.left("v", F.lit(1)) == F.left("rep", F.lit(1))) & (F.length("rep") > F.length("v")))
    best = with_it.groupBy("v", "rep").agg(F.count("*").alias("n")).groupBy("v").agg(F.min(F.struct((-F.col("n")).alias("n"), "rep"))["rep"].alias("rep"))
    return words.join(best, "v", "left").select("v", F.coalesce("rep", "v").alias("rep"))


def token_set(words: Column) -> Column:
    """The tokens of a value: the letter pairs of each word with its edges, and each letter with its how-manieth occurrence. Neither depends on the order of the words; the letters outlive swaps."""
    framed = F.transform(words, lambda w: F.concat(F.lit("^"), w, F.lit("$")))
    pairs = F.flatten(F.transform(framed, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: w.substr(i, F.lit(2)))))
    letters = F.filter(F.split(F.array_join(words, ""), ""), lambda x: x != "")
    times = F.transform(F.array_distinct(letters), lambda x: F.transform(F.sequence(F.lit(1), F.size(F.filter(letters, lambda y: y == x))), lambda k: F.concat(x, F.lit("#"), k.cast("string"))))
    return F.array_union(pairs, F.flatten(times))


def by_rarity(sets: DataFrame, key: str, ranks: DataFrame) -> DataFrame:
    """key, toks: the tokens of each set as structs (df, t), globally rare ones first."""
    each = sets.select(key, F.explode("tokens").alias("t")).join(small_side(ranks), "t")
    return each.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("toks"))


def similarity_join(left: DataFrame, right: DataFrame, t: float, scratch: Scratch) -> DataFrame:
    """All pairs (l, r, jaccard) of left (l, tokens) and right (r, tokens) whose token sets have a Jaccard similarity of at least t. right is the reference list.

    Prefix filter: with tokens ordered by global rarity, a pair that reaches t shares a token among the first |x| - ceil(t |x|) + 1 of either side, so only these are joined;
    then the length filter t |x| <= |y| <= |x| / t, the positional filter on the overlap still possible, and the exact Jaccard similarity. Each pair comes out once."""
    both = left.select("tokens").unionByName(right.select("tokens"))
    ranks = scratch.write(both.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("df")))
    lo = scratch.write(by_rarity(left, "l", ranks).select("l", "toks", F.size("toks").alias("nl")))
    ro = scratch.write(by_rarity(right, "r", ranks).select("r", "toks", F.size("toks").alias("nr")))
    size = lambda n: F.greatest(F.lit(0), n - F.ceil(n * t - F.lit(1e-9)).cast("int") + 1)
    head = lambda d, key, n, last, i: d.withColumn("h", F.slice("toks", 1, size(F.col(n)))).select(key, n, F.element_at("h", -1).alias(last), F.posexplode("h").alias(i, "tok"))
    # with the sets themselves laid out by l, which is distinct, what is counted a pair needs no shuffle of pairs
    spark = left.sparkSession
    lo = lo.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "l")
    lp = head(lo.filter("nl > 0"), "l", "nl", "ll", "i")
    rp = scratch.write(head(ro.filter("nr > 0"), "r", "nr", "lr", "j"))
    need = F.ceil((F.col("nl") + F.col("nr")) * (t / (1 + t)) - F.lit(1e-9))
    pairs = lp.join(small_side(rp), "tok").filter((F.col("nr") >= F.col("nl") * t - 1e-9) & (F.col("nl") >= F.col("nr") * t - 1e-9))
    # where one head ends before the other, none of its tokens is in the rest of the other set: the overlap is what the heads share and at most the rest of its own set
    met = pairs.withColumn("rest", F.when(F.col("ll") <= F.col("lr"), F.col("nl") - size(F.col("nl"))).otherwise(F.col("nr") - size(F.col("nr"))))
    met = met.groupBy("l", "r").agg(F.count("*").alias("m"), F.first("rest").alias("rest"), F.first(need).alias("need"), F.least(F.first("nl") - F.min("i"), F.first("nr") - F.min("j")).alias("upto"))
    found = met.filter((F.col("upto") >= F.col("need")) & (F.col("m") + F.col("rest") >= F.col("need"))).select("l", "r")
    full = found.join(lo, "l").select("l", "nl", F.col("toks.t").alias("lt"), "r")
    full = full.join(small_side(ro.select("r", "nr", F.col("toks.t").alias("rt"))), "r")
    common = F.size(F.array_intersect("lt", "rt"))
    return full.select("l", "r", (common / (F.col("nl") + F.col("nr") - common)).alias("jaccard")).filter(F.col("jaccard") >= t - 1e-12)


def word_join(left: DataFrame, right: DataFrame, meant: DataFrame, t: float, scratch: Scratch) -> DataFrame:
    """All pairs (l, r, jaccard) of left (l, words) and right (r, words, in reps) with a Jaccard similarity of words of at least t, a word of left being equal to any that it can stand for by meant (w, v).

    Prefix filter: of the words of a reference, globally rare ones first, one of the first |r| - ceil(t |r|) + 1 must be met, so only these are joined; then the length filter
    t |l| <= |r| <= |l| / t, the positional filter on the overlap still possible, and the exact similarity. Each pair comes out once."""
    each = left.select("l", F.explode(F.array_distinct("words")).alias("w")).join(small_side(meant), "w", "left")
    lo = each.groupBy("l").agg(F.count_distinct("w").alias("nl"), F.array_compact(F.collect_set("v")).alias("lv"))
    lo = scratch.write(lo)
    rare = lo.select(F.explode("lv").alias("v")).groupBy("v").agg(F.count("*").alias("df"))
    rw = right.select("r", F.explode(F.array_distinct("words")).alias("v")).join(rare, "v", "left").groupBy("r").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "v")))["v"].alias("rv"))
    rw = scratch.write(rw.withColumn("nr", F.size("rv")), small=True)
    head = F.slice("rv", 1, F.col("nr") - F.ceil(F.col("nr") * t - F.lit(1e-9)).cast("int") + 1)
    heads = rw.select("r", "nr", "rv", F.posexplode(head).alias("j", "v"))
    need = F.ceil((F.col("nl") + F.col("nr")) * (t / (1 + t)) - F.lit(1e-9))
    met = lo.select("l", "nl", "lv", F.explode("lv").alias("v")).join(F.broadcast(heads) if is_small(rw) else heads, "v")
    met = met.filter((F.col("nr") >= F.col("nl") * t - 1e-9) & (F.col("nl") >= F.col("nr") * t - 1e-9) & (F.least(F.col("nr") - F.col("j"), F.col("nl")) >= need))
    common = F.least(F.size(F.array_intersect("lv", "rv")), "nl")
    pairs = met.withColumn("jaccard", common / (F.col("nl") + F.col("nr") - common)).filter(F.col("jaccard") >= t - 1e-12)
    return pairs.select("l", "r", "jaccard").distinct()


def references(dictionary: DataFrame) -> DataFrame:
    """entry, phrase of each canonical name and alias; null aliases and names are left out."""
    names = dictionary.filter("canonical_name is not null").select(F.col("canonical_name").alias("entry"), F.explode(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("phrase"))
    return names.filter("phrase is not null").distinct()


def map_values(values: DataFrame, refs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """value, entry, phrase, jaccard for each distinct value of values (column value), entry being null where it stands for no entry of refs (entry, phrase).

    Values are brought to canonical characters and equal ones are compared once, as they are and without what stands before them and in brackets. Their words are set right by the words of the list
    (meant_words); then a prefix-filter similarity join on words finds the phrases that reach WORDS. Values that reach none (words run together, torn apart or badly misspelt) go through a second
    similarity join, on letters. The best entry is kept: the most similar; among equally similar ones the least edits, then the first name. Null values are left out; an empty value or one without
    letters and digits stands for none. An empty reference list maps nothing. Values longer than any that could reach the threshold are left out of the joins, which loses no pair."""
    scratch = scratch or Scratch(values.sparkSession, "map")
    raw = values.select(F.col("value").cast("string").alias("value")).filter("value is not null").groupBy("value").agg(F.count("*").alias("n_rows")).drop("n_rows")
    formed = with_forms(raw, "value").select("value", words_of(F.col("canonical")).alias("words"), words_of(bare(F.col("canonical"))).alias("less"))
    formed = scratch.write(formed)
    r = with_forms(refs.select("entry", F.col("phrase").cast("string").alias("phrase")), "phrase").select("entry", "phrase", "canonical", words_of(F.col("canonical")).alias("words"))
    r = scratch.write(r.withColumn("tokens", token_set(F.col("words"))), 1, small=True, longest=F.max(F.size("tokens")), most=F.max(F.size("words")))
    known = scratch.write(list_words(r), 1, small=True)
    # a reference in reps; phrases of equal words are one
    reps = r.select("entry", "phrase", "words", F.posexplode("words").alias("at", "v")).join(small_side(known), "v").groupBy("entry", "phrase").agg(F.first("words").alias("rw"), F.array_sort(F.collect_list(F.struct("at", "rep")))["rep"].alias("words"))
    reps = scratch.write(reps.withColumn("r", F.array_join(F.array_sort(F.array_distinct("words")), " ")), 1, small=True)
    longest = r.told["longest"] or 0
    fits = lambda c: (F.size(c) > 0) & (F.size(F.array_distinct(c)) <= int((r.told["most"] or 0) / WORDS) + 1)
    two = formed.select("value", F.explode(F.array_distinct(F.array("words", "less"))).alias("words")).filter(fits("words"))
    two = scratch.write(two.withColumn("l", F.array_join("words", " ")))
    left = two.groupBy("l").agg(F.first("words").alias("words"))
    typed = left.select(F.explode("words").alias("w")).distinct()
    meant = scratch.write(meant_words(typed, small_side(known)), small=True)
    found = word_join(left, reps.groupBy("r").agg(F.first("words").alias("words")), meant, WORDS, scratch)
    edits = F.levenshtein("l", F.array_join("rw", " "))
    scored = found.join(small_side(reps).select("r", "entry", "phrase", "rw"), "r").select("l", "entry", "phrase", "jaccard", edits.alias("edits"))
    best = lambda df, key: df.groupBy(key).agg(F.min(F.struct((-F.col("jaccard")).alias("j"), "edits", "entry", "phrase")).alias("b")).select(key, "b.entry", "b.phrase", (-F.col("b.j")).alias("jaccard"), F.col("b.edits").alias("edits"))
    by_words = scratch.write(best(two.join(best(scored, "l"), "l").select("value", "entry", "phrase", "jaccard", "edits"), "value"))
    rest = formed.join(by_words, "value", "left_anti").withColumn("norm", F.array_join("less", " "))
    rest = scratch.write(rest.filter((F.col("norm") != "") & (F.length(F.replace("norm", F.lit(" "), F.lit(""))) <= int(longest / CANDIDATE) + 1)).select("value", "norm", F.col("less").alias("words")))
    by_letters = rest.select("value", "norm").join(_by_letters(rest, r, scratch), "norm").select("value", "entry", "phrase", "jaccard")
    table = by_words.drop("edits").unionByName(by_letters)
    return formed.select("value").join(table, "value", "left").select("value", "entry", "phrase", "jaccard")


def _by_letters(rest: DataFrame, r: DataFrame, scratch: Scratch) -> DataFrame:
    """norm, entry, phrase, jaccard: the second join, on letter pairs and letters, for values (norm, words) that share too few words with any reference (entry, phrase, words, tokens)."""
    r = r.withColumn("r", F.array_join("words", " ")).filter("r != ''")
    left = rest.groupBy(F.col("norm").alias("l")).agg(F.first("words").alias("words"))
    left = scratch.write(left.select("l", "words", token_set(F.col("words")).alias("tokens")))
    pairs = similarity_join(left, r.groupBy("r").agg(F.first("tokens").alias("tokens")), CANDIDATE, scratch)
    joined = pairs.join(F.broadcast(r) if is_small(r) else r, "r").select("l", "r", "jaccard", "entry", "phrase", F.col("words").alias("rw")).join(left.select("l", F.col("words").alias("lw")), "l")
    lev = lambda f: F.levenshtein(F.array_join(f(F.col("lw")), ""), F.array_join(f(F.col("rw")), ""))
    edits = F.least(lev(lambda w: w), lev(F.array_sort))
    chars = lambda w: F.array_sort(F.split(F.array_join(w, ""), ""))
    edits = F.when((edits == 2) & (chars(F.col("lw")) == chars(F.col("rw"))), 1).otherwise(edits)  # two neighbours swapped
    size = F.length(F.replace("r", F.lit(" "), F.lit("")))
    good = joined.withColumn("edits", edits).filter((F.col("jaccard") >= SURE) | (F.col("edits") <= size * EDITS))
    best = good.groupBy("l").agg(F.min(F.struct((-F.col("jaccard")).alias("j"), "edits", "entry", "phrase")).alias("b"))
    return scratch.write(best.select(F.col("l").alias("norm"), "b.entry", "b.phrase", (-F.col("b.j")).alias("jaccard")))


def typed_values(outcomes: DataFrame) -> DataFrame:
    """correction_id, source_field, value of the two typed columns, without nulls."""
    pairs = F.array(*[F.struct(F.lit(c).alias("source_field"), F.col(c).alias("value")) for c in ("learned_alias", "field_name")])
    return outcomes.select("correction_id", F.inline(pairs)).filter("value is not null")


def mapped(outcomes: DataFrame, dictionary: DataFrame) -> DataFrame:
    """correction_id, source_field, value, entry of each typed value; entry is null where it stands for none. A popular value is mapped once; its rows are joined by broadcast, or with skew handling where values are many."""
    scratch = Scratch(outcomes.sparkSession, "map")
    typed = typed_values(outcomes)
    table = scratch.write(map_values(typed, references(dictionary), scratch), small=True)
    return typed.join(small_side(table), "value").select("correction_id", "source_field", "value", "entry")


def meant_entries(outcomes: DataFrame, dictionary: DataFrame) -> DataFrame:
    """correction_id, source_field, canonical_name of each typed value that stands for an entry, as distinct rows."""
    m = mapped(outcomes, dictionary).filter("entry is not null")
    return m.select("correction_id", "source_field", F.col("entry").alias("canonical_name")).distinct()


def unmatched(outcomes: DataFrame, dictionary: DataFrame) -> DataFrame:
    """source_field, value, n_rows of the values that stand for no entry."""
    m = mapped(outcomes, dictionary).filter("entry is null")
    return m.groupBy("source_field", "value").agg(F.count("*").alias("n_rows"))
