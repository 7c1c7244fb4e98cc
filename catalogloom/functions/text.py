"""Text keys and cleanup as column expressions (no UDF except NFKC)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def squeeze(c: Column) -> Column:
    """Collapse every run of Unicode white space and trim."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


#: Characters that NFKC leaves as they are in any order: ASCII, Latin and Cyrillic letters without compatibility
#: forms, plain punctuation and common invisible marks. None of them combines with another.
NFKC_STABLE = (r"\x00-\x7F\u00A1-\u00A7\u00A9\u00AB-\u00AE\u00B0\u00B1\u00B6\u00B7\u00BB\u00BF-\u0131\u0134-\u013E"
               r"\u0141-\u0148\u014A-\u017E\u0400-\u0482\u048A-\u052F\u200B-\u2010\u2012-\u2015\u2018-\u2023\u202A-\u202E"
               r"\u2060-\u2064\u20AC\uFEFF")


def clean_unicode(c: Column) -> Column:
    """NFKC, drop invisible format characters, squeeze.

    Only rows with a character that NFKC may change are handed to Python; the
    rest pass a null.
    """
    plain = F.when(c.rlike(f"[^{NFKC_STABLE}]"), c)
    return squeeze(F.regexp_replace(F.coalesce(_nfkc(plain), c), r"\p{Cf}", ""))


def compact_key(c: Column) -> Column:
    """Lower-case letters and digits only."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")


def title_key(c: Column) -> Column:
    """Key of a series entry title: no leading zeros, one spelling of yo."""
    text = F.translate(F.lower(squeeze(c)), "ё", "е")
    text = F.regexp_replace(text, r"(?<!\d)0+(\d+)", "$1")
    return F.regexp_replace(text, r"[^a-zа-я0-9]", "")


def word_list(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(squeeze(c)), F.lit(r"([a-zа-яё0-9]+)"), 1)


def person_key(c: Column) -> Column:
    """Names with the same words in any order share this key."""
    return F.array_join(F.sort_array(word_list(c)), " ")


def title_words(c: Column) -> Column:
    """Distinct words longer than one character."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"([a-zа-яё0-9]{2,})"), 1))


def natural_key(c: Column) -> Column:
    """Sortable array: digit runs compare as numbers, text case-folded.

    A digit run becomes its length (zero padded) followed by its digits, which
    orders like the number itself for any length.
    """
    pieces = F.regexp_extract_all(F.lower(c), F.lit(r"(\d+|\D+)"), 1)

    def encode(piece: Column) -> Column:
        digits = F.regexp_replace(piece, r"^0+(?=\d)", "")
        return F.when(piece.rlike(r"^\d+$"),
                      F.concat(F.lpad(F.length(digits).cast("string"), 6, "0"), digits)
                      ).otherwise(piece)

    encoded = F.transform(pieces, encode)
    return F.when(c.rlike(r"^\d"), F.concat(F.array(F.lit("")), encoded)).otherwise(encoded)


def hint_id(series: Column, position: Column, title: Column) -> Column:
    """Stable id of a series entry that has no page of its own."""
    payload = F.concat_ws("|", title_key(series), position.cast("string"), title_key(title))
    return F.concat(F.lit("series-hint:"), F.substring(F.sha1(payload.cast("binary")), 1, 24))


def positive_int(c: Column) -> Column:
    """Integer >= 1, else null."""
    value = c.cast("string").try_cast("int")
    return F.when(value >= 1, value)


def none_if_blank(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))
