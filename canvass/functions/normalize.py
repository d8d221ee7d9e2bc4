"""Normalisers of messy identifiers, names and numbers, as Column expressions.

Blank and missing are one: every text normaliser maps null to ''.  Normalisers that look alike differ on
purpose (digits_code('10.0') is '100', decimal_code('10.0') is '10'), because their sources differ.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def blank(c: Column) -> Column:
    """Null as ''."""
    return F.coalesce(c.cast("string"), F.lit(""))


def present(c: Column) -> Column:
    """Trimmed text, null where blank: the form that coalesce() can choose from."""
    return F.nullif(F.trim(c), F.lit(""))


def first_present(*columns: Column) -> Column:
    """The first that is not blank, else ''."""
    return F.coalesce(*map(present, columns), F.lit(""))


def spaces(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(blank(c), r"(?U)\s+", " "))


def digits_code(c: Column) -> Column:
    """All digits run together, without leading zeros; '' if there are none, '0' if all are zero."""
    digits = F.regexp_replace(blank(c), "[^0-9]", "")
    return F.when(digits == "", "").otherwise(F.regexp_replace(digits, "^0+(?=.)", ""))


def decimal_code(c: Column) -> Column:
    """The whole part of a decimal; what is no number goes by its digits."""
    number = present(c).try_cast("decimal(38,6)")
    return F.coalesce(F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).cast("bigint").cast("string"), digits_code(c))


def locality_code(c: Column) -> Column:
    """A whole number without its fraction (10.0 is 10); what is none goes by its digits (12.5 is 125); nan is blank."""
    text = F.trim(blank(c))
    number = text.try_cast("double")
    whole = number.isNotNull() & (F.abs(number) < 1e15) & (F.floor(number) == number)
    return F.when(F.lower(text) == "nan", "").when(whole, number.cast("bigint").cast("string")).otherwise(digits_code(text))


def number_text(c: Column) -> Column:
    """A number's shortest decimal text (1.10 is 1.1, 3.0 is 3); '' for anything else."""
    text = present(c).try_cast("decimal(38,6)").cast("string")
    return F.coalesce(F.regexp_replace(F.regexp_replace(text, r"(\.[0-9]*?)0+$", "$1"), r"\.$", ""), F.lit(""))


def ballot_text(c: Column) -> Column:
    """The first number of the text, comma as decimal point, without trailing zeros of a fraction."""
    number = F.regexp_extract(F.replace(blank(c), F.lit(","), F.lit(".")), r"[0-9]+(?:\.[0-9]+)?", 0)
    return F.regexp_replace(F.regexp_replace(number, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def int_value(c: Column) -> Column:
    """The first whole number after commas are dropped (so 3.9 gives 3); 0 if there is none."""
    return F.coalesce(F.regexp_extract(F.replace(blank(c), F.lit(","), F.lit("")), "-?[0-9]+", 0).try_cast("bigint"), F.lit(0).cast("bigint"))


def banker_int(c: Column) -> Column:
    """A number rounded half to even; 0 if it is none."""
    return F.coalesce(F.rint(c.cast("string").try_cast("double")).cast("bigint"), F.lit(0).cast("bigint"))


def strict_number(c: Column) -> Column:
    """A number; anything else fails the job."""
    number = present(c).try_cast("double")
    return F.when(number.isNotNull(), number).otherwise(F.raise_error(F.concat(F.lit("not a number: "), blank(c))).cast("double"))


def drop_zero_fraction(c: Column) -> Column:
    return F.regexp_replace(blank(c), r"\.0+$", "")


def name_key(c: Column) -> Column:
    """A name for matching: no bracketed part, no quotes, punctuation or space, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(blank(c), r"\[[^\]]*\]", ""), r"[^\p{L}\p{N}]+", ""))


def bracket_code(c: Column) -> Column:
    """The digits of a trailing [digits]; '' if there are none."""
    return F.regexp_extract(blank(c), r"\[([0-9]+)\]\s*$", 1)


def bracket_name(c: Column) -> Column:
    """What stands before a trailing [digits]."""
    return F.trim(F.regexp_replace(blank(c), r"\[[0-9]+\]\s*$", ""))


def ballot_base(ballot: Column, tenths: Column) -> Column:
    """The ballot a subdivision belongs to: a tenth of numbers in tenths encoding, else the whole part."""
    whole = ballot_text(ballot).try_cast("decimal(38,6)").cast("bigint")
    return F.when(tenths, F.floor(whole / 10).cast("bigint")).otherwise(whole)


def pipe_list(c: Column) -> Column:
    """'a|b|a' as an array: trimmed, blanks dropped, first occurrences in order."""
    return F.array_distinct(F.filter(F.transform(F.split(blank(c), r"\|"), lambda x: F.trim(x)), lambda x: x != ""))


def slug(c: Column) -> Column:
    """Lower-case file name: runs of other characters as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(blank(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def truthy(c: Column) -> Column:
    return F.lower(F.trim(blank(c))).isin("true", "1", "yes")


def fnv1a(c: Column) -> Column:
    """32-bit FNV-1a over the code points of a text."""
    step = lambda h, ch: ((h.bitwiseXOR(F.ascii(ch).cast("bigint"))).cast("decimal(20,0)") * F.lit(16777619) % F.lit(4294967296)).cast("bigint")
    return F.aggregate(F.filter(F.split(blank(c), ""), lambda x: x != ""), F.lit(2166136261).cast("bigint"), step)


def stable_hue(c: Column) -> Column:
    """A hue of 0 to 359 from the size of the signed 32-bit hash."""
    h = fnv1a(c)
    return (F.abs(F.when(h >= 2147483648, h - 4294967296).otherwise(h)) % 360).cast("int")


def round6(c: Column) -> Column:
    """Six places, halves to even on the scaled value."""
    return F.rint(c * 1e6) / 1e6


def share(part: Column, whole: Column) -> Column:
    """part / whole at six places; null where whole is 0 or null."""
    return round6(part.cast("double") / F.nullif(whole, F.lit(0)).cast("double"))


def https_url(c: Column) -> Column:
    """The URL where it is https with a host; null otherwise."""
    return F.when(c.rlike(r"^https://[^\s/?#]+([/?#]\S*)?$"), c)


def grouped_number(c: Column) -> Column:
    """A whole number with commas between thousands."""
    return F.format_number(c, 0)


def percent(c: Column) -> Column:
    """A share as a percentage of one place."""
    return F.concat(F.format_number(F.rint(c * 1000) / 10, 1), F.lit("%"))


def _label(names: pd.Series) -> pd.Series:
    return names.map(lambda name: "".join(ch for ch in unicodedata.normalize("NFKC", name or "").lower() if ch.isascii() and ch.isalnum() or "\u0590" <= ch <= "\u05ff"))


_PLAIN = r"^[\x00-\x7F]*$"


def _unless_plain(c: Column, plain: Column, rest) -> Column:
    """``plain``, by built-ins, for ASCII texts; only the others go to Python, which sees nulls in their place."""
    is_plain = blank(c).rlike(_PLAIN)
    return F.when(is_plain, plain).otherwise(F.pandas_udf(rest, "string")(F.when(~is_plain, c)))


def label_key(c: Column) -> Column:
    """A label for comparison: compatibility form, lower case, only digits, a-z and Hebrew letters."""
    return _unless_plain(c, F.regexp_replace(F.lower(blank(c)), "[^0-9a-z]+", ""), _label)


def _nfkc(names: pd.Series) -> pd.Series:
    def one(name: str | None) -> str:
        text = "".join(ch for ch in unicodedata.normalize("NFKC", name or "") if unicodedata.category(ch) != "Cf")
        return "".join("-" if unicodedata.category(ch) == "Pd" else ch for ch in text if ch.isalnum() or ch == "_" or unicodedata.category(ch) == "Pd").lower()

    return names.map(one)


def nfkc_name(c: Column) -> Column:
    """Compatibility form without format characters, dashes alike, other than word characters dropped.

    Spark has no Unicode normalisation, hence the pandas function for texts beyond ASCII.
    """
    return _unless_plain(c, F.lower(F.regexp_replace(blank(c), "[^0-9A-Za-z_-]+", "")), _nfkc)
