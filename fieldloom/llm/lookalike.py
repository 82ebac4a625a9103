"""One consistent form for text that looks the same: confusables skeleton, canonical form and evidence of foreign characters."""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters that show nothing, besides those of category Cf.
UNSEEN = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}
# Letters that have Latin look-alikes but are ordinary letters of words in their own script; alone they make no word look Latin.
WEAK = set("αγικυχгμ")
# Fixed value: what the public table has otherwise, as the palochka stands in for l far more than for i.
OWN_PROTOTYPES = {"ӏ": "l"}
#: From here on letters of the Latin script are phonetic and the like, not those of any orthography's names.
PHONETIC = 0x250
#: Scripts whose letters mix within a word.
EAST_ASIAN = {"CJK", "HIRAGANA", "KATAKANA", "KATAKANA-HIRAGANA", "HANGUL", "BOPOMOFO", "IDEOGRAPHIC"}
#: Values a worker remembers.
REMEMBERED = 50_000


@lru_cache(maxsize=20_000)
def script(c: str) -> str:
    """The first word of a letter's name, that is its script (LATIN, GREEK, CYRILLIC, CJK ...); empty for what is no letter."""
    if not (c.isalpha() or unicodedata.category(c) == "Nl"):
        return ""
    return unicodedata.name(c, "UNKNOWN").split()[0]


def unseen(c: str) -> bool:
    return unicodedata.category(c) == "Cf" or ord(c) in UNSEEN or (unicodedata.category(c) == "Cc" and not c.isspace())


def _words(plain: str) -> list[list[int]]:
    """The positions of each run of letters and marks."""
    out: list[list[int]] = []
    last = -2
    for i, c in enumerate(plain):
        if script(c) or unicodedata.combining(c):
            if last != i - 1:
                out.append([])
            out[-1].append(i)
            last = i
    return out


class Confusables:
    """The public table of confusable characters, as far as text in compatibility decomposition needs it, and what follows from it.

    proto: the prototype of each character that has another one. ASCII characters are their own prototypes (what tells 0 from O in plain text is a misreading, not another
    character); a character of a class that has ASCII members has as its prototype the one of its case, or else the first.
    latin: the letters, not of the Latin script or phonetic, whose prototype is an ASCII letter."""

    def __init__(self, table: dict[str, str]):
        """table: characters and their prototypes in the public table, ASCII ones included."""
        classes: dict[str, list[str]] = {}
        for a in map(chr, range(0x21, 0x7F)):
            classes.setdefault(table.get(a, a), []).append(a)
        self.proto: dict[str, str] = {}
        for c, p in table.items():
            if not c.isascii():
                same = classes.get(p, [])
                alike = [a for a in same if a.isalpha() and (a.isupper() == c.isupper() or not c.lower() != c.upper() and a.islower())]
                self.proto[c] = next(iter(alike or [a for a in same if a.isalpha() == c.isalpha()] or same), p)
        self.proto |= OWN_PROTOTYPES
        self.latin = {c: p for c, p in self.proto.items() if len(p) == 1 and p.isascii() and p.isalpha() and script(c) and (script(c) != "LATIN" or ord(c) >= PHONETIC)}
        self._back: dict[str, dict[str, str]] = {}

    def skeleton(self, text: str | None) -> str | None:
        """Decompose, replace every character by its prototype, decompose again. Texts that look alike have equal skeletons.

        The prototype of an unseen character is nothing, of any space the ordinary one, of a compatibility character its plain form, of others that of the table.
        Case is kept. Null gives null, an empty text an empty one."""
        if text is None or text.isascii() and text.isprintable():
            return text
        out = []
        for c in unicodedata.normalize("NFKD", text):
            if not unseen(c):
                out.append(" " if c.isspace() else self.proto.get(c, c))
        return unicodedata.normalize("NFD", "".join(out))

    def counterparts(self, name: str) -> dict[str, str]:
        """The letters of a script by the Latin letter they look like."""
        if name not in self._back:
            back: dict[str, str] = {}
            for c, p in sorted(self.latin.items()):
                if script(c) == name:
                    back.setdefault(p, c)
            self._back[name] = back
        return self._back[name]

    def _foreign(self, word: list[str], genuine: set[str]) -> bool:
        """Whether a word is truly written in a script other than Latin. genuine: scripts that other words of the value surely are in."""
        scripts = {s for c in word if (s := script(c))}
        if not scripts or "LATIN" in scripts:
            return False
        if scripts <= EAST_ASIAN:
            return True
        if len(scripts) > 1:
            return False
        if any(c not in self.latin and script(c) for c in word):
            return True
        return bool(scripts & genuine) or len(word) > 1 and all(c in WEAK for c in word)

    def _own(self, word: list[str]) -> str:
        """The script of a word of several: the one most of its letters are of, if that isn't Latin and some of them look like no Latin letter; else empty, for Latin."""
        counts = Counter(s for c in word if (s := script(c)))
        sure = {script(c) for c in word if c not in self.latin and script(c) not in ("", "LATIN")}
        most = [s for s in sure if counts[s] > sum(counts.values()) - counts[s]]
        return most[0] if most else ""

    def plainest(self, text: str) -> str:
        """The plainest text of text's skeleton class: compatibility forms resolved, accents composed, unseen characters left out, ordinary spaces, and look-alike letters in the
        script of their word. No letter of a word that is mostly Latin becomes one of another script. The number of spaces and the case stay."""
        plain = unicodedata.normalize("NFKC", "".join(" " if c.isspace() else c for c in text if not unseen(c)))
        if plain.isascii():
            return plain
        letters = list(plain)
        words = [(w, [plain[i] for i in w]) for w in _words(plain)]
        genuine = {script(c) for _, cs in words if self._foreign(cs, set()) for c in cs if script(c)}
        for w, cs in words:
            if all(script(c) in ("LATIN", "") and c not in self.latin for c in cs) or self._foreign(cs, genuine):
                continue
            own = self._own([c for c in unicodedata.normalize("NFD", "".join(cs))])
            back = self.counterparts(own) if own else {}
            for i in w:
                d = unicodedata.normalize("NFD", plain[i])
                if own:
                    d = "".join(c if script(c) == own else back.get(self.latin.get(c, c), c) for c in d)
                else:
                    d = "".join(self.latin.get(c, c) for c in d)
                letters[i] = unicodedata.normalize("NFC", d)
        return unicodedata.normalize("NFC", "".join(letters))

    def mixed(self, text: str) -> bool:
        """Whether a word of text has letters of several scripts, East Asian ones counting as one."""
        return any(len({"EAST ASIAN" if s in EAST_ASIAN else s for i in w if (s := script(text[i]))}) > 1 for w in _words(text))

    def examine(self, text: str | None) -> tuple[str | None, str]:
        """The canonical form of a text, that is the plainest of its skeleton class, and by what it differs: of "compat", "decomposed", "unseen", "space", "lookalike", by commas;
        empty for a plain text. Words truly written in another script keep their letters. A word of several scripts that no plainer form is known of counts as "lookalike" all the same,
        and an accent without a composed form as "decomposed". A null gives (null, "")."""
        if text is None or text.isascii() and text.isprintable():
            return text, ""
        plain = self.plainest(text)
        why = set()
        if any(unseen(c) for c in text):
            why.add("unseen")
        if any(c.isspace() and c != " " for c in text):
            why.add("space")
        shown = "".join(" " if c.isspace() else c for c in text if not unseen(c))
        composed = unicodedata.normalize("NFC", shown)
        if composed != shown or any(0x300 <= ord(c) <= 0x36F for c in composed):
            why.add("decomposed")
        folded = unicodedata.normalize("NFKC", composed)
        if folded != composed:
            why.add("compat")
        if folded != plain or self.mixed(folded):
            why.add("lookalike")
        return plain, ",".join(sorted(why))


def read_table(spark: SparkSession) -> dict[str, str]:
    """The public table of confusables, read in one call from the Unicode library that Spark itself ships: the skeletons of all characters that compatibility decomposition leaves as they are."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    kind = jvm.java.lang.Class.forName("com.ibm.icu.text.SpoofChecker$Builder")
    checker = kind.getConstructor(gateway.new_array(jvm.java.lang.Class, 0)).newInstance(gateway.new_array(jvm.java.lang.Object, 0)).build()
    chars = [c for c in map(chr, range(0x21, 0x20000)) if unicodedata.category(c) not in ("Cc", "Cf", "Cn", "Co", "Cs", "Zs", "Zl", "Zp") and unicodedata.normalize("NFKD", c) == c]
    parts = checker.getSkeleton("\n".join(chars)).split("\n")
    if len(parts) != len(chars):
        raise RuntimeError("the table of confusables can't be read")
    return {c: p for c, p in zip(chars, parts) if c != p}


_shared: dict[str, tuple] = {}


def shared(spark: SparkSession):
    """The Confusables as a broadcast variable, made once an application; some thousand entries."""
    app = spark.sparkContext.applicationId
    if app not in _shared:
        _shared.clear()
        _shared[app] = spark.sparkContext.broadcast(Confusables(read_table(spark)))
    return _shared[app]


def remembering(f: Callable[[str], object]) -> Callable[[str], object]:
    """f with a memory of REMEMBERED texts, emptied when full."""
    known: dict[str, object] = {}

    def of(t: str) -> object:
        if t not in known:
            if len(known) >= REMEMBERED:
                known.clear()
            known[t] = f(t)
        return known[t]

    return of


RESULT = T.StructType([T.StructField("canonical", T.StringType()), T.StructField("why", T.StringType()), T.StructField("skeleton", T.StringType())])


def examined(c: Column, table) -> Column:
    """struct(canonical, why, skeleton) of a text, by an Arrow UDF; ask it only for texts for which not_plain() holds, others are their own form. table: shared()."""

    def run(s: pd.Series) -> pd.DataFrame:
        of = remembering(lambda t: (*table.value.examine(t), table.value.skeleton(t)))
        return pd.DataFrame([(None, "", None) if t is None else of(t) for t in s], columns=["canonical", "why", "skeleton"])

    return F.pandas_udf(run, RESULT)(c)


def not_plain(c: Column) -> Column:
    """True for a text with any character outside printable ASCII. Runs in the JVM, so plain texts never reach Python."""
    return c.rlike(r"[^\x20-\x7E]")


def with_forms(df: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """df with columns prefix + canonical, why and skeleton for the column text. Other columns must not have these names; give a prefix where they do.

    Null texts have null forms and an empty why. Rows of plain texts and of others are taken from the input by two disjoint filters, so only the latter go through Python."""
    names = [prefix + n for n in ("canonical", "why", "skeleton")]
    if clash := set(names) & {c.lower() for c in df.columns}:
        raise ValueError(f"columns {sorted(clash)} are there already")
    c = F.col(text)
    odd = F.coalesce(not_plain(c), F.lit(False))
    plain = df.filter(~odd).withColumns(dict(zip(names, (c, F.lit(""), c))))
    e = "__examined"
    seen = df.filter(odd).withColumn(e, examined(c, shared(df.sparkSession)))
    seen = seen.withColumns({n: F.col(e)[k] for n, k in zip(names, ("canonical", "why", "skeleton"))}).drop(e)
    return plain.unionByName(seen)


def skeleton_groups(df: DataFrame, text: str) -> DataFrame:
    """Originals grouped by equal skeleton: skeleton, n_forms (different originals), n_rows, plainest (the smallest of the shortest in code points). Null texts are left out.

    Equal originals are counted together before they are examined, so each is examined once and a frequent one costs one row."""
    forms = with_forms(df.filter(F.col(text).isNotNull()).groupBy(F.col(text).alias("original")).agg(F.count("*").alias("n")), "original")
    plainest = F.min(F.struct(F.length("original"), "original"))["original"]
    return forms.groupBy("skeleton").agg(F.count("*").alias("n_forms"), F.sum("n").alias("n_rows"), plainest.alias("plainest"))


def domain_values(attempts: DataFrame, sidecars: DataFrame) -> DataFrame:
    """origin, doc_id, field_name, tier, value of both tables; tier is empty for sidecars; a null array of fields gives no row."""
    a = attempts.select(F.lit("field_attempts").alias("origin"), "doc_id", "field_name", "tier", "value")
    s = sidecars.select("doc_id", F.explode(F.arrays_zip("fields.name", "fields.value")).alias("f"))  # of the structs only these two are read
    return a.unionByName(s.select(F.lit("sidecars").alias("origin"), "doc_id", F.col("f.name").alias("field_name"), F.lit("").alias("tier"), F.col("f.value").alias("value")))


def odd_values(attempts: DataFrame, sidecars: DataFrame) -> DataFrame:
    """origin, doc_id, field_name, tier of each value whose skeleton class holds a plainer form than the value, or that mixes scripts within a word, as distinct rows."""
    v = domain_values(attempts, sidecars).filter(not_plain(F.col("value")))
    # the condition on value holds for every row here; it keeps the Python step, and what follows, from being asked of plain values
    e = v.withColumn("e", examined(F.col("value"), shared(attempts.sparkSession))).filter((F.col("e.canonical") != F.col("value")) | (F.col("e.why") != ""))
    return e.select("origin", "doc_id", "field_name", "tier").distinct()
