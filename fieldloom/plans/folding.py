"""SQL of how readings are compared: NFKC, case folding and white space, for values outside printable ASCII by a table of characters that is made by rule."""

from __future__ import annotations

import unicodedata
from functools import cache

#: Ranges of characters that forms hold: letters of European scripts, signs, East Asian and full-width forms.
RANGES = ((0x80, 0x590), (0x13A0, 0x1400), (0x1E00, 0x2C00), (0x3000, 0x3400), (0xAB70, 0xABC0), (0xFB00, 0xFB07), (0xFE10, 0xFFF0))


@cache
def _characters() -> str:
    """A row for each character that compatibility composition or case folding changes."""
    chars = [chr(i) for a, b in RANGES for i in range(a, b)] + [chr(i) for i in range(0x41, 0x5B)]
    changed = {c: unicodedata.normalize("NFKC", c).casefold() for c in chars}
    return ", ".join(f"({ord(c)}, '{f.replace(chr(39), chr(39) * 2)}')" for c, f in changed.items() if f != c)


def ascii_norm(c: str) -> str:
    """Of a value in printable ASCII: lower case, runs of spaces as one, none at the ends; null where nothing is left."""
    return f"nullif(trim(regexp_replace(lower({c}), ' +', ' ', 'g')), '')"


def date(c: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({c}), '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}|\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}|\\d{{1,2}}-\\d{{1,2}}-\\d{{4}}') THEN strftime(coalesce("
        f"CASE WHEN contains({c}, '/') THEN try_strptime(trim({c}), '%m/%d/%Y') END, CASE WHEN regexp_full_match(trim({c}), '\\d{{4}}-.*') THEN try_strptime(trim({c}), '%Y-%m-%d') END,"
        f" CASE WHEN regexp_full_match(trim({c}), '\\d{{1,2}}-.*') THEN try_strptime(trim({c}), '%m-%d-%Y') END), '%Y-%m-%d') END"
    )


def folded(values: str) -> str:
    """CTEs chars, fold and folded (v, f, k) of the distinct values of the select `values` (one column v): f the folded text, k the day of a date, else f."""
    return f"""chars(code, f) AS (VALUES {_characters()}),
given AS (SELECT DISTINCT v FROM ({values}) WHERE v IS NOT NULL),
each AS (SELECT v, unnest(cs) AS c, generate_subscripts(cs, 1) AS i FROM (SELECT v, regexp_extract_all(v, '(?s).') AS cs FROM given WHERE regexp_matches(v, '[^\\x20-\\x7E]'))),
fold AS (SELECT v, nullif(regexp_replace(regexp_replace(nfc_normalize(string_agg(coalesce(chars.f, c), '' ORDER BY i)), '[\\s\\p{{Z}}\\x{{85}}\\x0b\\x1c-\\x1f]+', ' ', 'g'), '^ | $', '', 'g'), '') AS f
  FROM each LEFT JOIN chars ON chars.code = unicode(c) GROUP BY v),
folded AS (SELECT v, f, coalesce({date('f')}, f) AS k
  FROM (SELECT given.v, CASE WHEN regexp_matches(given.v, '[^\\x20-\\x7E]') THEN fold.f ELSE {ascii_norm('given.v')} END AS f FROM given LEFT JOIN fold ON fold.v = given.v))"""
