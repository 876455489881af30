"""Normalization and extraction.

Unicode normal forms have no built-in function, so one Arrow UDF folds what is not ASCII; all else is built in.
"""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Legal forms.
LEGAL_FORMS = {
    "private limited": "pvt ltd",
    "private ltd": "pvt ltd",
    "pvt limited": "pvt ltd",
    "pvt ltd": "pvt ltd",
    "p ltd": "pvt ltd",
    "public limited": "public ltd",
    "public ltd": "public ltd",
    "limited": "ltd",
    "corporation": "corp",
    "incorporated": "inc",
    "company": "co",
}
# Street words.
STREET_WORDS = {
    "street": "st",
    "str": "st",
    "road": "rd",
    "avenue": "ave",
    "boulevard": "blvd",
    "drive": "dr",
    "lane": "ln",
    "place": "pl",
    "highway": "hwy",
    "apartment": "unit",
    "apt": "unit",
    "suite": "unit",
    "ste": "unit",
}

# Patterns of numbers, postal codes and units.
NUMBER = r"(?U)\b\p{Nd}+[a-z]?\b"
POSTAL = r"(?U)\b\p{Nd}{4,10}\b"
UNIT = r"(?U)\b(?:apt|apartment|unit|suite|ste|floor|fl)\s*([\w-]+)"

_SIGNS = re.compile(r"[^\w\s]")
_SPACE = re.compile(r"\s+")


def fold(value: str | None) -> str:
    """Compatibility forms unified, accents and format characters dropped, lower case, signs and spaces to one space."""
    if not value:
        return ""
    if not value.isascii():
        value = unicodedata.normalize("NFKC", value).replace("\u200b", " ").replace("\ufeff", " ")
        value = "".join(c for c in value if unicodedata.category(c) != "Cf")
        value = "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))
    return _SPACE.sub(" ", _SIGNS.sub(" ", value.lower())).strip()


@F.pandas_udf(T.StringType())
def fold_text(values: pd.Series) -> pd.Series:
    return pd.Series([fold(v) if isinstance(v, str) else "" for v in values], dtype=object)


def normalize_text(raw: Column | str) -> Column:
    """fold of a column; texts of ASCII characters stay in the JVM."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    plain = F.octet_length(raw) == F.char_length(raw)
    words = F.trim(F.regexp_replace(F.lower(raw), "[^a-z0-9_]+", " "))
    return F.when(raw.isNull(), "").when(plain, words).otherwise(fold_text(F.when(~plain, raw)))


def fold_legal_forms(normalized: Column) -> Column:
    """Whole-word phrases replaced, longest first, each on the result of the one before."""
    ordered = sorted(LEGAL_FORMS.items(), key=lambda kv: -len(kv[0]))
    return reduce(lambda c, kv: F.regexp_replace(c, rf"(?U)\b{kv[0]}\b", kv[1]), ordered, normalized)


def fold_street_words(normalized: Column) -> Column:
    words = F.create_map(*[F.lit(x) for kv in STREET_WORDS.items() for x in kv])
    return F.array_join(F.transform(F.split(normalized, " "), lambda t: F.coalesce(F.try_element_at(words, t), t)), " ")


def numeric_tokens(normalized: Column) -> Column:
    return F.regexp_extract_all(normalized, F.lit(NUMBER), F.lit(0))


def postal_code(normalized: Column) -> Column:
    """The last number of four to ten digits."""
    return F.coalesce(F.try_element_at(F.regexp_extract_all(normalized, F.lit(POSTAL), F.lit(0)), F.lit(-1)), F.lit(""))


def house_number(normalized: Column) -> Column:
    """The first numeric token."""
    return F.coalesce(F.get(numeric_tokens(normalized), F.lit(0)), F.lit(""))


def unit_number(normalized: Column) -> Column:
    return F.regexp_extract(normalized, UNIT, 1)


def add_normalized_columns(df: DataFrame) -> DataFrame:
    """business_name, business_address and country to the eight derived columns; each raw column is folded once."""
    df = df.withColumns(
        {
            "name_normalized": normalize_text("business_name"), "address_normalized": normalize_text("business_address"),
            "country_normalized": normalize_text("country")
        }
    )
    df = df.withColumns(
        {
            "name_normalized": fold_legal_forms(F.col("name_normalized")),
            "address_normalized": fold_street_words(F.col("address_normalized"))
        }
    )
    name, address = F.col("name_normalized"), F.col("address_normalized")
    return df.withColumns(
        {
            "postal_code": postal_code(address), "house_number": house_number(address), "unit_number": unit_number(address),
            "name_numeric_tokens": numeric_tokens(name), "address_numeric_tokens": numeric_tokens(address)
        }
    )


def sql_normalize(raw: Column) -> Column:
    """The plain normalizer of the asymmetric mode: runs of other characters to a space, lower case, nothing trimmed."""
    return F.lower(F.regexp_replace(F.coalesce(raw.cast("string"), F.lit("")), r"[^\p{Alnum}\s]+", " "))


def add_sql_normalized_columns(df: DataFrame) -> DataFrame:
    df = df.withColumns(
        {
            "name_normalized": sql_normalize(F.col("business_name")),
            "address_normalized": sql_normalize(F.col("business_address")),
            "country_normalized": F.lower(F.trim(F.coalesce("country", F.lit(""))))
        }
    )
    return df.withColumns(
        {
            "house_number": F.regexp_extract("address_normalized", r"(^| )([0-9]+[a-z]?)", 2),
            "postal_code": F.regexp_extract("address_normalized", r"([0-9]{4,10})", 1)
        }
    )


def tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, " "), lambda x: x != ""))


def char_ngrams(text: Column, sizes: tuple[int, ...]) -> Column:
    """Distinct character grams of the text with two spaces on either side."""
    padded = F.concat(F.lit("  "), text, F.lit("  "))
    none = F.array().cast("array<string>")

    def of(n: int) -> Column:
        return F.when(
            F.length(padded) >= n,
            F.transform(F.sequence(F.lit(1), F.length(padded) - (n - 1)), lambda i: F.substring(padded, i, F.lit(n)))
        ).otherwise(none)

    return F.array_distinct(F.flatten(F.array(*[of(n) for n in sizes])))


def gram_codes(text: Column) -> Column:
    """char_ngrams of size 3 as numbers, three characters of 21 bits each, which are met faster than strings."""
    codes = F.transform(F.split(F.concat(F.lit("  "), text, F.lit("  ")), ""), lambda c: F.ascii(c).cast("long"))
    at = lambda i, k: F.get(codes, i + k)
    starts = F.sequence(F.lit(0), F.length(text) + 1)
    return F.array_distinct(F.transform(starts, lambda i: at(i, 0) * (1 << 42) + at(i, 1) * (1 << 21) + at(i, 2)))
