"""Column functions over texts and protected tokens."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The code points that count as white space at a text's ends.
SPACES = "".join(map(chr, [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
WORD = r"[\p{L}\p{N}_]"
LINE_ENDS = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(SPACES))


def count_of(text: Column, token: Column) -> Column:
    """Occurrences of a literal that don't overlap; an empty one stands before and after each character."""
    return F.when(token == "", F.length(text) + 1).otherwise(F.floor((F.length(text) - F.length(F.replace(text, token, F.lit("")))) / F.length(token)))


def closed(f: Callable[..., Column], *columns: Column) -> Column:
    """f(*columns), where lambdas inside f find the columns in a lambda's variable and not outside.

    When Spark infers filters it numbers a lambda's variables anew, from 0 on. A column with such a number,
    as the first plans of a session have, is taken for one of them: the condition it stands in is put where
    there is no such column, and fails.
    """
    row = F.struct(*(c.alias(f"_{i}") for i, c in enumerate(columns)))
    return F.transform(F.array(row), lambda r: f(*(r[f"_{i}"] for i in range(len(columns)))))[0]


def miscounted(text: Column, tokens: Column) -> Column:
    """The distinct tokens that text doesn't have as often as the array."""
    return closed(lambda s, ts: F.filter(F.array_distinct(ts), lambda t: count_of(s, t) != F.size(F.filter(ts, lambda u: u == t))), text, tokens)


def in_order(text: Column, tokens: Column) -> Column:
    """Whether all tokens occur one after another, each found from the end of the last."""

    def end(s, ts):
        find = lambda at, t: F.when(t == "", at).otherwise(F.call_function("locate", t, s, at))
        return F.aggregate(ts, F.lit(1), lambda at, t: F.when(at == 0, 0).otherwise(F.when(find(at, t) == 0, 0).otherwise(find(at, t) + F.length(t))))

    return closed(end, text, tokens) > 0


def without_all(text: Column, tokens: Column) -> Column:
    """text with every occurrence of every token taken out, longest tokens first."""
    longest = F.array_sort(F.filter(tokens, lambda t: t != ""), lambda a, b: F.length(b) - F.length(a))
    return F.aggregate(longest, text, lambda s, t: F.replace(s, t, F.lit("")))


def without_once(text: Column, tokens: Column) -> Column:
    """text with the first occurrence of each token taken out, in the array's order."""

    def step(s, t):
        at = F.call_function("locate", t, s)
        return F.when((t == "") | (at == 0), s).otherwise(F.concat(F.substr(s, F.lit(1), at - 1), F.substr(s, at + F.length(t))))

    return F.aggregate(tokens, text, step)


def newlines(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def has_invalid(text: Column) -> Column:
    return F.contains(text, F.lit("�")) | F.contains(text, F.lit("\0"))


def is_semantic(text: Column) -> Column:
    """Whether there is a letter, digit, underscore or CJK character."""
    return text.rlike(r"[\p{L}\p{N}_㐀-鿿]")


def slug(text: Column, most: int = 60) -> Column:
    s = F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}_.-]+", "-"), F.lit("-._"))
    return F.substr(F.when(s == "", "scene").otherwise(s), F.lit(1), F.lit(most))


def quoted(text: Column) -> Column:
    """A pattern that matches the text literally."""
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def estimated_tokens(chars: Column, per_char: float = 1.15) -> Column:
    return F.ceil(chars.cast("double") * F.lit(per_char)).cast("long")


def codepoint_label(cp: Column) -> Column:
    """U+ and at least four hexadecimal digits."""
    digits = F.hex(cp)
    return F.concat(F.lit("U+"), F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits))


def is_visible(char: Column) -> Column:
    """Neither white space nor control, format, surrogate, private or unassigned, by the JVM's tables."""
    return ~char.rlike(r"^[\p{C}\p{Z}\x09-\x0D\x1C-\x20\x85]$")


def meaningful(markdown: Column, least: int = 10) -> Column:
    """Whether the lines that are neither blank, nor headings, nor a bare fence have enough characters in all."""
    lines = F.transform(F.split(F.ltrim(markdown, F.lit("\ufeff")), LINE_ENDS), strip)
    kept = F.filter(lines, lambda x: (x != "") & ~x.startswith("#") & (x != "```"))
    return F.coalesce(F.length(F.array_join(kept, "")) >= least, F.lit(False))


@F.pandas_udf(T.BooleanType())
def is_nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t is None or unicodedata.is_normalized("NFC", t))


@F.pandas_udf(T.StringType())
def casefolded(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else t.casefold())


@F.pandas_udf(T.StringType())
def codepoint_name(cps: pd.Series) -> pd.Series:
    return cps.map(lambda cp: unicodedata.name(chr(int(cp)), "UNNAMED"))


@F.pandas_udf(T.BooleanType())
def is_visible_exact(chars: pd.Series) -> pd.Series:
    """By Python's Unicode tables, which are newer than the JVM's."""
    return chars.map(lambda c: c is not None and len(c) == 1 and not c.isspace() and not unicodedata.category(c).startswith("C"))
