"""Normalised names and addresses, and the blocking keys made of them, as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Address words and their short forms, and the endings of company names.
ADDRESS_ALIASES = {
    "street": "st",
    "road": "rd",
    "avenue": "ave",
    "boulevard": "blvd",
    "drive": "dr",
    "lane": "ln",
    "highway": "hwy",
    "suite": "ste",
    "apartment": "apt",
}
LEGAL_ENDINGS = ("incorporated", "inc", "llc", "ltd", "limited", "corp", "corporation", "gmbh", "co", "pvt", "private")
LEGAL_SUFFIX = r"[,\. ]+(incorporated|inc[.]?|llc|ltd[.]?|limited|corp[.]?|corporation|gmbh|co[.]?|pvt[.]?|private)[,\. ]*$"

NOT_WORD = r"[^\p{L}\p{N}]+"
FIRST_WORD = r"^[\p{L}\p{N}]+"
NUMBER = "[0-9]+"


@F.pandas_udf(T.StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Unicode composition (NFC), which Spark has no function for. ASCII texts pass as they are."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def normalize_name(text: Column) -> Column:
    """Composed, lower-cased, & as "and", runs of anything but letters and numbers as one space; '' for null."""
    low = nfc(F.lower(F.coalesce(text, F.lit(""))))
    return F.trim(F.regexp_replace(F.replace(low, F.lit("&"), F.lit(" and ")), NOT_WORD, " "))


def abbreviate(normalized: Column) -> Column:
    """Each address word in its short form, token by token."""
    short = F.create_map(*[F.lit(x) for pair in ADDRESS_ALIASES.items() for x in pair])
    return F.array_join(F.transform(F.split(normalized, " "), lambda t: F.coalesce(F.element_at(short, t), t)), " ")


def abbreviate_by_replacement(normalized: Column) -> Column:
    """The same by replacing in the padded text, alias after alias, which misses the second of two equal neighbours."""
    aliases = F.array(*[F.struct(F.lit(f" {x} ").alias("long"), F.lit(f" {y} ").alias("short")) for x, y in ADDRESS_ALIASES.items()])
    return F.aggregate(aliases, F.concat(F.lit(" "), normalized, F.lit(" ")), lambda t, alias: F.replace(t, alias["long"], alias["short"]), lambda t: F.trim(t))


def normalize_address(text: Column) -> Column:
    return abbreviate(normalize_name(text))


def strip_legal_suffix(normalized: Column) -> Column:
    """A normalised name without its last one or two legal endings."""
    return F.trim(F.regexp_replace(F.regexp_replace(normalized, LEGAL_SUFFIX, ""), LEGAL_SUFFIX, ""))


def first_word(normalized: Column) -> Column:
    return F.regexp_extract(normalized, FIRST_WORD, 0)


def first_number(raw: Column) -> Column:
    return F.regexp_extract(F.coalesce(raw, F.lit("")), NUMBER, 0)


def filled(text: Column) -> Column:
    """Null instead of an empty key, so that it never joins."""
    return F.when(text != "", text)


def word_digit(normalized_name: Column, raw_address: Column) -> Column:
    """First word and first number, if there are both."""
    word, number = first_word(normalized_name), first_number(raw_address)
    return F.when((word != "") & (number != ""), F.concat_ws("_", word, number))


def id_list(text: Column) -> Column:
    """The trimmed, non-empty parts of a comma-separated list."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
