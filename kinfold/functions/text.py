"""Text normalisation as column expressions.

Word and blank classes are spelled out, because Java's shorthands are ASCII only. Only
letters outside ASCII and Latin need decomposition that Spark lacks; those few values go
through one Arrow function, all others stay in generated code.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from kinfold.functions.lexicon import PUNCTUATION

WORD = r"[\p{L}\p{N}_]"
BLANK = r"[\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: A word border: a word character on exactly one side.
BORDER = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
#: Dots of runs of two or more "letter." at the start of a word (runs of up to 31).
_DOTS = rf"(?<=(?<!{WORD})(?:[a-z]\.){{1,30}}[a-z])\.|(?<=(?<!{WORD})[a-z])\.(?=[a-z]\.)"


def _plain(text: str) -> str:
    """Compatibility decomposition without Latin accents."""
    parts = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", text))
    return "".join(c for c in parts if not (0x300 <= ord(c) <= 0x36F and unicodedata.combining(c)))


def _latin() -> tuple[str, str]:
    """Latin letters with accents, and what is left of each; by rule, those that stay one letter."""
    pairs = [(chr(c), _plain(chr(c))) for c in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if len(b) == 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_FROM, _TO = _latin()


@F.pandas_udf(StringType())
def _decompose(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else _plain(x))


def fold(c: Column) -> Column:
    """Decomposed, without accents of U+0300 to U+036F, lower case. Null stays null."""
    latin = c.rlike(rf"\A[\x00-\x7F{_FROM}]*+\z")
    rest = _decompose(F.when(~latin, c))
    return F.lower(F.when(c.rlike(r"\A[\x00-\x7F]*+\z"), c).when(latin, F.translate(c, _FROM, _TO)).otherwise(rest))


def squeeze(c: Column) -> Column:
    """Runs of white space to one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{BLANK}+", " "))


def base_normalize(c: Column) -> Column:
    """Folded text with quotes, dashes, '&' and '+' unified; null and empty give ''."""
    s = F.translate(fold(F.coalesce(c, F.lit(""))), "’‘`–—", "'''--")
    s = F.regexp_replace(s, rf"{BLANK}*&{BLANK}*", " and ")
    s = F.regexp_replace(s, rf"{BLANK}*\+{BLANK}*", " and ")
    s = F.regexp_replace(s, rf"({WORD})'s(?!{WORD})", "$1s")
    s = F.regexp_replace(s, _DOTS, "")
    return squeeze(F.replace(s, F.lit("'"), F.lit("")))


def remove_punct(c: Column, keep: str = "") -> Column:
    """Punctuation to blanks, except ``keep``; dotted acronyms and closing dots just go."""
    marks = "".join("\\" + m if ord(m) < 128 else m for m in PUNCTUATION if m not in keep)
    s = F.regexp_replace(c, _DOTS, "")
    s = F.regexp_replace(s, rf"(?<=[a-z])\.(?={BLANK}|$)", "")
    return squeeze(F.regexp_replace(s, f"[{marks}]", " "))


def tokens(c: Column) -> Column:
    """Tokens between blanks."""
    return F.array_remove(F.split(c, " "), "")


def literal_map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def apply_token_map(words: Column, table: dict[str, str]) -> Column:
    """Each token replaced by its value, which may be several tokens or none."""
    known = literal_map(table)
    return tokens(F.array_join(F.transform(words, lambda t: F.coalesce(F.element_at(known, t), t)), " "))


def is_digits(c: Column) -> Column:
    return c.rlike(r"\A\p{Nd}+\z")


def translit(t: Column) -> Column:
    """Folds spelling variants of transliterated words; digits and short tokens stay."""
    s = F.replace(t, F.lit("ph"), F.lit("f"))
    for a, b in (("ck", "k"), ("q", "k")):
        s = F.replace(s, F.lit(a), F.lit(b))
    s = F.regexp_replace(s, f"aa|ah(?!{WORD})", "a")
    for a, b in (("ee", "i"), ("oo", "u"), ("ou", "u"), ("au", "o"), ("ow", "o"), ("th", "t"), ("dh", "d"), ("bh", "b"),
                 ("kh", "k"), ("gh", "g"), ("sh", "s"), ("ch", "c")):
        s = F.replace(s, F.lit(a), F.lit(b))
    s = F.regexp_replace(s, f"y(?!{WORD})", "i")
    s = F.regexp_replace(s, r"(.)\1+", "$1")
    return F.when(is_digits(t) | (F.length(t) <= 2), t).otherwise(s)


def parse_id_list(c: Column) -> Column:
    """Comma-separated ids: trimmed, without empty ones, each once, in order; null gives none."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: squeeze(x))
    return F.array_distinct(F.array_remove(parts, ""))
