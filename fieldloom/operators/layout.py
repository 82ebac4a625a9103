"""Layout blocks: HTML tables to cells, cells to label-value pairs, lines, readings of a cell, and the best reading of a field."""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.functions.text import finalizes, verdict
from fieldloom.operators import forms, packed
from fieldloom.operators.dictionary import VOCABULARY_ROWS, aliases, generic, match_labels

#: Rows, columns and characters of a table that are read; confidence of a reading that its rule confirms, and the most that another gets.
ROWS, COLUMNS, CELL_CHARS = 200, 32, 512
CONFIRMED, UNCONFIRMED = 0.9, 0.84

# Fixed value: what stands between a label and its value in one text.
SEPARATOR = r"^[\s:\-–—\t]+"
CELLS = "array<struct<row_no int, cell_no int, text string, first_col int, end_col int>>"


class _Cells(HTMLParser):
    """Collects the cells of a table with the grid columns that they span."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[tuple[str, int]]] = []
        self.open: list[str] | None = None
        self.span = 1

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.close()
            if len(self.rows) < ROWS + 1:
                self.rows.append([])
        elif tag in ("td", "th"):
            self.close()
            raw = (dict(attrs).get("colspan") or "1").strip()
            self.span = min(COLUMNS, max(1, int(raw))) if re.fullmatch(r"[0-9]{1,9}", raw) else 1
            self.open = []
        elif tag == "br" and self.open is not None:
            self.open.append("\n")

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr", "table"):
            self.close()

    def handle_data(self, data):
        if self.open is not None:
            self.open.append(data)

    def close(self):
        if self.open is not None and self.rows:
            self.rows[-1].append(("".join(self.open).strip()[:CELL_CHARS], self.span))
        self.open = None


def table_rows(html: str | None) -> list[dict]:
    """The cells of an HTML table; none for text that holds no table or can't be parsed."""
    if not html or "<t" not in html.lower():
        return []
    p = _Cells()
    try:
        p.feed(html)
        p.close()
    except Exception:  # noqa: BLE001  malformed markup of any kind is no table
        return []
    out = []
    for r, row in enumerate(p.rows[:ROWS]):
        col = 0
        for c, (text, span) in enumerate(row):
            if col >= COLUMNS:
                break
            end = min(COLUMNS, col + span)
            out.append({"row_no": r, "cell_no": c, "text": text, "first_col": col, "end_col": end})
            col = end
    return out


def cells(blocks: DataFrame, content: str = "content") -> DataFrame:
    """The columns of blocks but content, with row_no, cell_no, text, first_col, end_col of each cell of its tables."""
    read = F.pandas_udf(lambda s: s.map(table_rows), CELLS)
    keep = [c for c in blocks.columns if c != content]
    return blocks.filter(F.col(content).isNotNull()).select(*keep, F.inline(read(F.col(content))))


def table_pairs(grid: DataFrame, block: list[str]) -> DataFrame:
    """block..., row_no, label, value, aligned: each cell with each cell of the row above that it overlaps on the grid; aligned where it begins within the label's span.

    An equi-join on block and row with a range condition on columns, of which there are at most COLUMNS. Equal pairs of a row count once, aligned if any is."""
    low = grid.filter("text <> ''").select(*block, "row_no", F.col("text").alias("value"), F.col("first_col").alias("a"), F.col("end_col").alias("b"))
    top = grid.filter("text <> ''").select(*block, (F.col("row_no") + 1).alias("row_no"), F.col("text").alias("label"), F.col("first_col").alias("c"), F.col("end_col").alias("d"))
    j = low.join(top, [*block, "row_no"]).filter((F.col("c") < F.col("b")) & (F.col("d") > F.col("a")))
    return j.groupBy(*block, "row_no", "label", "value").agg(F.max((F.col("c") <= F.col("a")) & (F.col("a") < F.col("d"))).alias("aligned"))


def lines(blocks: DataFrame, key: list[str], label: str = "label", content: str = "content") -> DataFrame:
    """key..., line: non-blank cells of tables and non-blank lines of other blocks."""
    tables = cells(blocks.filter(F.col(label) == "table").select(*key, content), content).select(*key, F.col("text").alias("line"))
    other = blocks.filter(F.coalesce(F.col(label) != "table", F.lit(True))).select(*key, F.explode(F.split(content, "\n")).alias("line"))
    return tables.unionByName(other).withColumn("line", F.trim("line")).filter("line <> ''")


def value_after(text: Column, alias: Column) -> Column:
    """What follows the first whole-word alias in a text, separators left out; null where it does not occur or nothing follows. For text whose upper case keeps its length."""
    quoted = F.concat(F.lit(r"(?i)(?<!\w)\Q"), alias, F.lit(r"\E(?!\w)"))
    at = F.regexp_instr(text, quoted)
    rest = text.substr(at + F.length(alias), F.length(text))
    return F.when(at > 0, F.nullif(F.rtrim(F.regexp_replace(rest, SEPARATOR, "")), F.lit("")))


def single_passing(field: Column, value: Column) -> Column:
    """The value itself where its rule holds or there is none; else the only word of it for which the rule holds; else the value."""
    words = F.split(F.trim(value), r"\s+")
    good = F.filter(words, lambda w: F.coalesce(verdict(field, w), F.lit(False)))
    whole = verdict(field, value)
    return F.when(F.coalesce(whole, F.lit(True)), value).when(F.size(good) == 1, good[0]).otherwise(value)


def offers(pairs: DataFrame, dictionary: DataFrame, block: list[str], grid: DataFrame | None = None) -> DataFrame:
    """block..., row_no, label, field, value, score, aligned, validates, raw_text, generic: a pair whose label matches an alias offers its value to the alias's field, and the parts of a packed value to the fields that the label names too.

    generic: the alias is one word that other fields' aliases hold too, so it tells little. grid: the cells; one that holds its own label and value offers the value as well, as an aligned one, with the cell as its label."""
    read = packed.reader(dictionary)
    loose = F.broadcast(generic(dictionary).withColumn("generic", F.lit(True)))  # some of a dictionary's aliases
    m = match_labels(pairs, dictionary).join(loose, ["field", "vertical", "alias"], "left")
    j = pairs.join(m, "label").withColumn("r", packed.pair_readings(read, F.col("label"), F.col("value"), F.col("field")))
    out = j.select(*block, "row_no", "label", "score", "aligned", F.col("value").alias("raw_text"), F.coalesce("generic", F.lit(False)).alias("generic"), F.explode("r").alias("r"))
    if grid is not None:
        c = grid.filter("text <> ''").select(*block, "row_no", "text").distinct().withColumn("r", packed.cell_readings(read, F.col("text")))
        own = c.select(*block, "row_no", F.col("text").alias("label"), F.col("text").alias("raw_text"), F.explode("r").alias("r"))
        out = out.unionByName(own.select(*block, "row_no", "label", F.round("r.score", 6).alias("score"), F.lit(True).alias("aligned"), "raw_text", F.lit(False).alias("generic"), "r"))
    v = single_passing(F.col("r.field"), F.col("r.value"))
    return out.select(*block, "row_no", "label", F.col("r.field").alias("field"), v.alias("value"), "score", "aligned", F.coalesce(verdict(F.col("r.field"), v), F.lit(False)).alias("validates"), "raw_text", "generic")


def best_offers(offered: DataFrame, block: list[str], dictionary: DataFrame | None = None) -> DataFrame:
    """The best offer of each field: valid ones first, then aligned ones, then by score, then the first. A confirmed value has CONFIRMED, any other its score, at most UNCONFIRMED.

    dictionary: a winner whose value its field's type can't hold is dropped, and the next one does not take its place."""
    w = Window.partitionBy(*block, "field").orderBy(F.desc("validates"), F.desc("aligned"), F.desc("score"), "row_no", "label", "value")
    top = offered.withColumn("r", F.row_number().over(w)).filter("r = 1").drop("r")
    if dictionary is not None:
        kinds = dictionary.groupBy(F.col("canonical_name").alias("field")).agg(F.min("data_type").alias("_kind"))
        top = top.join(F.broadcast(kinds), "field", "left").filter(forms.cast_valid(F.coalesce("_kind", F.lit("string")), F.col("value")).isNotNull()).drop("_kind")
    return top.withColumn("confidence", F.when(finalizes(F.col("field"), F.col("value")), CONFIRMED).otherwise(F.least(F.lit(UNCONFIRMED), F.col("score"))))


def block_matches(lines: DataFrame, dictionary: DataFrame, line: str = "line", held: int = VOCABULARY_ROWS) -> DataFrame:
    """lines with field, vertical, alias, score and value: the best alias in each line, and what follows it there. Lines with no alias, or nothing after it, are left out; null lines too.

    A dictionary of up to held aliases is searched for in each line where it lies, without a shuffle; for a larger one the different lines are joined with it by match_labels()."""
    a = aliases(dictionary).select("field", "vertical", "alias_pos", "alias").filter("alias is not null")
    if a.count() <= held:
        rows = [tuple(r) for r in a.orderBy("vertical", "field", "alias_pos").select("field", "vertical", "alias").collect()]
        m = lines.withColumn("_m", packed.line_matches(rows, F.col(line))).filter("_m.field is not null")
        return m.select(*lines.columns, *[F.col(f"_m.{c}").alias(c) for c in ("field", "vertical", "alias", "score", "value")])
    m = match_labels(lines, dictionary, line, free=True)
    return lines.join(m.withColumnRenamed("label", "_line"), F.col(line) == F.col("_line")).withColumn("value", value_after(F.col(line), F.col("alias"))).filter("value is not null").drop("_line")
