"""String functions: slugs, folds and classifiers as columns; Unicode folding as a vectorised function."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType


def ascii_slug(name: Column) -> Column:
    """Lower case, each run of other characters than a-z and 0-9 as one hyphen, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), F.lit("-"))


def upper_simple(text: Column) -> Column:
    """Upper case character by character: one that has no single capital (ß) stays."""
    return F.array_join(F.transform(F.split(text, "", -1), lambda c: F.when(F.length(F.upper(c)) == 1, F.upper(c)).otherwise(c)), "")


@F.pandas_udf(StringType())
def nfkd_ascii(names: pd.Series) -> pd.Series:
    """Compatibility-decomposed names without what ASCII lacks; null stays null."""
    known: dict[str, str] = {}

    def fold(x):
        if x is None:
            return None
        if x not in known:
            known[x] = unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode()
        return known[x]

    return names.map(fold, na_action="ignore")


@F.pandas_udf(StringType())
def nfkc(names: pd.Series) -> pd.Series:
    return names.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


@F.pandas_udf(StringType())
def unmarked(names: pd.Series) -> pd.Series:
    """Compatibility-decomposed names without combining marks; null stays null."""
    return names.map(lambda x: "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)), na_action="ignore")


def slug(name: Column) -> Column:
    """ascii_slug of the front face (before //) after Unicode folding."""
    return ascii_slug(nfkd_ascii(F.trim(F.split_part(name, F.lit("//"), F.lit(1)))))


def punctuation_free_slug(name: Column) -> Column:
    """Punctuation dropped first, then white space as hyphens."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), r"[^a-z0-9\s-]", ""), r"[\s-]+", "-"), F.lit("-"))


def key(name: Column) -> Column:
    """Only the letters and digits, in lower case."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


#: Cyrillic letters that look like Latin ones, and those.
LOOKALIKES = ("АВЕКМНОРСТХаеорсух", "ABEKMHOPCTXaeopcyx")


def unmask(name: Column) -> Column:
    """Look-alike Cyrillic letters as Latin ones."""
    return F.translate(name, *LOOKALIKES)


def shorten(x: Column, limit: int) -> Column:
    """At most limit characters, cut before a word, with an ellipsis."""
    return F.when(F.length(x) <= limit, x).otherwise(F.concat(F.regexp_replace(F.substring(x, 1, limit), r"\s+\S*\z", ""), F.lit("…")))


def fragment(quote: Column) -> Column:
    """A quote as a URL text fragment: spaces as %20 and hyphens as %2D."""
    return F.concat(F.lit("#:~:text="), F.replace(F.replace(F.url_encode(quote), F.lit("+"), F.lit("%20")), F.lit("-"), F.lit("%2D")))


def words(x: Column, least: int = 1) -> Column:
    """Distinct lower-case words of least letters or more."""
    return F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit(f"[a-z]{{{least},}}"), F.lit(0)))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(both.cast("double"), F.size(F.array_union(a, b)).cast("double")), F.lit(0.0))


def stems(x: Column, stop: list[str], size: int = 5) -> Column:
    """Distinct stems of the words that aren't stop words: their first size letters."""
    kept = F.filter(words(x, 3), lambda w: ~w.isin(*stop))
    return F.array_distinct(F.transform(kept, lambda w: F.substring(w, 1, size)))


def listing(items: Column) -> Column:
    """'a', 'a and b', 'a, b and c'."""
    n = F.size(items)
    return F.when(n <= 1, F.array_join(items, "")).otherwise(F.concat(F.array_join(F.slice(items, 1, F.greatest(n - 1, F.lit(0))), ", "), F.lit(" and "), F.element_at(items, -1)))


def natural(number: Column) -> Column:
    """A sort key of collector numbers: the leading digits as a number, then the text."""
    return F.struct(F.coalesce(F.regexp_extract(number, r"(\d+)", 1).try_cast("int"), F.lit(0)).alias("n"), number.alias("t"))
