"""Keyword-stuffed and link-list pages: block-wise compression ratio, normalised by length and language, confirmed by how little of a block is sentences."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.runtime import Scratch, small_side, spread

#: Characters of a block; a longer run is cut into equal parts.
BLOCK = 2000
#: A block is extremely redundant up to this part of the ratio usual for its language, length and figures; up to SOMEWHAT only text (of next to no figures) with next to no sentence ends, which in lists of figures tell nothing.
EXTREME, SOMEWHAT = 0.62, 0.80
#: Sentence ends a word: below FEW for somewhat redundant blocks; text of sentences has about 0.06.
FEW, USUAL = 0.03, 0.10
#: Up to this part of the usual ratio, each different sentence taken once, a block is about few keywords whatever its punctuation.
KEYED = 0.54
#: The ratio usual for lists of figures, which are of many makes, is that of the most redundant part of them; that of text is the median.
REDUNDANT = 0.05
#: Parts of words with digits that part blocks into kinds: text, code lists, invoices and logs each have a usual ratio of their own.
FIGURES = (0.16, 0.30, 0.50)
#: Part of a line within well-formed sentences from which the line counts as sentences.
SENTENCES = 0.80
#: Blocks that the next wider class counts as in the usual ratio of a class; the more blocks a class has the less the wider one tells.
WEIGHT = 30
#: Ratios of ordinary text by floor(log2(bytes)), the widest class of all: what a corpus is taken to be before it is seen; and the part of them that lists of figures are taken to have.
DEFAULT, LISTS = {5: 0.95, 6: 0.90, 7: 0.80, 8: 0.69, 9: 0.60, 10: 0.50, 11: 0.45}, 0.5

LINK = re.compile(
    r"(?:https?://|www\.)[^\s<>\"]+"
    r"|\b[\w-]{1,60}(?:\.[\w-]{1,60}){0,5}\.[a-z]{2,12}(?:/[^\s<>\"]*)?(?=[\s)\]>\"',|»•]|$)"
    r"|\b[\w-]{1,60} dot \w{2,12}(?: slash \S*)?",
    re.I,
)
#: What every link holds; texts without it need no search for links.
LINKISH = re.compile(r"\.[a-z]{2}|www\.|://| dot ", re.I)
#: Words with a figure, but for hash tags, in words parted by single spaces.
FIGURE = re.compile(r"(?<!\S)(?!#)\S*\d")
MARKUP = re.compile(r"<[^<>]{0,500}>")
END = re.compile(r"[.!?…。！？]+[\"”»')\]]*(?=\s|$)")
WORD = re.compile(r"[^\s|•·»«,;:()\[\]{}\"“”]*\w[^\s|•·»«,;:()\[\]{}\"“”]*")


def sentences(text: str) -> list[str]:
    """The sentences of a text: what ends at sentence punctuation before white space or at the end, unless a small letter follows in the same line, as after a short form. What follows the last end is none."""
    out, at = [], 0
    for m in END.finditer(text):
        gap = text[m.end() : m.end() + 3]
        if gap[:1] == "\n" or not gap.strip()[:1].islower():
            out.append(text[at : m.end()].strip())
            at = m.end()
    return out


def well_formed(s: str) -> bool:
    return (s[:1].isupper() or s[:1] in "¿¡\"“«(„") and len(s.split()) >= 6


def pieces(text: str) -> Iterator[str]:
    """The lines of a text that hold anything, those longer than BLOCK in equal parts."""
    for line in text.splitlines():
        if not line.strip():
            continue
        n = math.ceil(len(line) / BLOCK)
        for k in range(n):
            if part := line[len(line) * k // n : len(line) * (k + 1) // n].strip():
                yield part


def runs(parts: list[str]) -> Iterator[list[str]]:
    """Parts joined into blocks of about equal size, BLOCK characters at most but for a single part."""
    whole = sum(len(p) for p in parts)
    n = max(1, math.ceil(whole / BLOCK))
    cur: list[str] = []
    size = 0
    for p in parts:
        if cur and size + len(p) > max(1, whole / n) * 1.05:
            yield cur
            cur, size = [], 0
        cur.append(p)
        size += len(p)
    if cur:
        yield cur


def ratio_of(words: list[str]) -> tuple[int, float]:
    """(bytes, compression ratio) of words; (0, 0.0) for none."""
    kept = " ".join(words).encode("utf-8", "replace")
    return len(kept), max(0, len(zlib.compress(kept, 6)) - 8) / len(kept) if kept else 0.0


def measure(parts: list[str], is_sentences: bool) -> dict:
    """What is counted of a block. n: characters without white space; bytes, ratio: of its words, links and markup left out, as compressed; ends: sentence ends a word;
    figures: part of words with digits; once_bytes, once: as bytes and ratio, with each different sentence taken once, so that repeated boilerplate isn't redundant."""
    text = "\n".join(parts)
    n = len("".join(text.split()))
    bare = MARKUP.sub(" ", text) if "<" in text else text
    bare = LINK.sub(" ", bare) if LINKISH.search(bare) else bare
    words = WORD.findall(bare.lower())
    said = sentences(bare)
    different = dict.fromkeys(s.lower() for s in said)
    size, ratio = ratio_of(words)
    once_bytes, once = ratio_of(WORD.findall(" ".join(different))) if len(different) < len(said) or different and not is_sentences else (size, ratio)
    figures = len(FIGURE.findall(" ".join(words))) / max(1, len(words))
    return {"sentences": is_sentences, "n": n, "bytes": size, "ratio": ratio, "ends": len(said) / max(1, len(words)), "figures": figures, "once_bytes": once_bytes, "once": once}


def blocks(text: str | None) -> list[dict]:
    """The measured blocks of a text. Lines made mostly of well-formed sentences and other lines are taken apart, so that headings and
    links between sentences, or sentences between lists, don't blur either. None for a null or blank text."""
    if not text:
        return []
    kinds: tuple[list[str], list[str]] = ([], [])
    for p in pieces(text):
        kinds[sum(len(s) for s in sentences(p) if well_formed(s)) >= SENTENCES * len(p)].append(p)
    return [measure(r, k == 1) for k in (0, 1) for r in runs(kinds[k])]


BLOCKS = "array<struct<sentences boolean, n int, bytes int, ratio double, ends double, figures double, once_bytes int, once double>>"


def measured_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id_col, lang, blocks of each row with a text. lang in lower case, "und" for null and blank. Whole texts, in Arrow batches; no shuffle but where the table has fewer partitions than there are cores."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_type

    kind = T._parse_datatype_string(BLOCKS)
    schema = T.StructType([docs.schema[id_col], T.StructField("lang", T.StringType()), T.StructField("blocks", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = list(to_arrow_type(kind).value_type)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                of = [blocks(t) for t in b.column(2).slice(at, 1000).to_pylist()]
                flat = [x for bs in of for x in bs]
                columns = [pa.array([x[f.name] for x in flat], type=f.type) for f in fields]
                ends = np.concatenate([[0], np.cumsum([len(bs) for bs in of])]).astype(np.int32)
                made = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, fields=fields))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, 1000), b.column(1).slice(at, 1000), made], names=schema.names)

    lang = F.coalesce(F.nullif(F.lower(F.trim(lang_col)), F.lit("")), F.lit("und"))
    some = docs.select(F.col(id_col), lang.alias("lang"), F.col(text_col)).filter(F.col(text_col).isNotNull())
    return spread(some).mapInArrow(run, schema)


def figure_class(figures: Column) -> Column:
    """0 for text of next to no figures, up to len(FIGURES) for text of mostly figures."""
    return sum((F.when(figures >= f, 1).otherwise(0) for f in FIGURES), F.lit(0))


def length_class(n: Column) -> Column:
    return F.least(F.lit(11), F.greatest(F.lit(5), F.floor(F.log2(F.greatest(F.lit(1), n))))).cast("int")


def usual_ratios(measured: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(lang, figured, cls, usual) and, for all languages together, (figured, cls, of_all): the ratio usual for a class of blocks, by language, part of figures, and length. The median of the class (lists of figures: the quantile REDUNDANT) is drawn towards that of all languages,
    and this towards DEFAULT, by their numbers of blocks and WEIGHT. Ordinary text is made of sentences; ordinary lists of figures are not.

    A row a language and class, of which there are few; a class that a corpus lacks has no row, and nothing to be looked up for it."""
    each = measured.select("lang", F.inline("blocks")).filter("bytes > 0").withColumn("figured", figure_class(F.col("figures"))).filter("sentences = (figured = 0)")
    each = each.select("lang", "figured", length_class(F.col("bytes")).alias("cls"), "ratio")
    median = F.when(F.col("figured") > 0, F.percentile_approx("ratio", REDUNDANT, 1000)).otherwise(F.percentile_approx("ratio", 0.5, 1000)).alias("median")
    two = each.groupingSets([["lang", "figured", "cls"], ["figured", "cls"]], "lang", "figured", "cls").agg(median, F.count("*").alias("m"), F.grouping("lang").alias("wide"))
    two = scratch.write(two, 1)
    prior = F.element_at(F.create_map(*[F.lit(x) for kv in DEFAULT.items() for x in kv]), F.col("cls")) * F.when(F.col("figured") > 0, LISTS).otherwise(1.0)
    drawn = lambda m, own, to: (m * own + WEIGHT * to) / (m + WEIGHT)
    wide = two.filter("wide = 1").select("figured", "cls", drawn(F.col("m"), F.col("median"), prior).alias("of_all"))
    return two.filter("wide = 0").join(F.broadcast(wide), ["figured", "cls"]).select("lang", "figured", "cls", drawn(F.col("m"), F.col("median"), F.col("of_all")).alias("usual")), wide


def is_stuffed(b: Column, relative: Column, once: Column) -> Column:
    """Whether a block b (BLOCKS) is stuffing. relative: its ratio against the usual one; once: the same with each different sentence taken once.

    Extreme redundancy is confirmed by few sentence ends; keywords put into sentences, which do have full stops, are redundant even if no sentence is taken twice."""
    listed = ~b["sentences"] & (((relative <= EXTREME) & (b["ends"] < USUAL)) | ((relative <= SOMEWHAT) & (b["ends"] < FEW) & (b["figures"] < FIGURES[0])))
    return listed | (once <= KEYED)


def stuffing_scores(docs: DataFrame) -> DataFrame:
    """doc_id, chars, stuffed_chars, share of each row of docs (doc_id, text, lang) with a text that isn't blank; characters without white space.

    Null and blank texts have no row; repeated rows have one each; a null or wrong lang only changes what is usual; extra columns don't matter. The blocks of a row are summed up where they lie."""
    scratch = Scratch(docs.sparkSession, "stuffing")
    m = scratch.write(measured_blocks(docs))
    of_lang, of_all = usual_ratios(m, scratch)
    key = lambda figures, n: figure_class(figures) * 100 + length_class(n)
    named = F.col("figured") * 100 + F.col("cls")
    as_map = lambda df, by, value, name: df.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(named, value))).alias(name))
    # a row a language, each of at most 28 numbers; languages are few, and the size is checked all the same
    maps = small_side(scratch.write(as_map(of_lang, ["lang"], "usual", "of"), 1, small=True))
    every = as_map(of_all, [], "of_all", "of").first()["of"] or {}
    every = {k * 100 + c: v * (LISTS if k else 1.0) for k in range(len(FIGURES) + 1) for c, v in DEFAULT.items()} | every
    other = F.create_map(*[F.lit(x) for kv in sorted(every.items()) for x in kv])
    usual = lambda b, n: F.coalesce(F.try_element_at(F.col("of"), key(b["figures"], n)), F.try_element_at(other, key(b["figures"], n)))
    stuffed = lambda b: is_stuffed(b, b["ratio"] / usual(b, b["bytes"]), b["once"] / usual(b, b["once_bytes"]))
    total = lambda keep: F.aggregate("blocks", F.lit(0).cast("long"), lambda s, b: s + F.when(keep(b), b["n"]).otherwise(0))
    s = m.filter(F.size("blocks") > 0).join(maps, "lang", "left").select("doc_id", total(lambda b: F.lit(True)).alias("chars"), total(stuffed).alias("stuffed_chars"))
    return s.select("doc_id", "chars", "stuffed_chars", (F.col("stuffed_chars") / F.col("chars")).alias("share"))


def stuffed_documents(docs: DataFrame) -> DataFrame:
    """doc_id of each document the larger part of whose text is stuffing, as distinct rows."""
    return stuffing_scores(docs).filter("share > 0.5").select("doc_id").distinct()
