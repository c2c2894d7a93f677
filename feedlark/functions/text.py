"""Text normalisation as native column expressions; every function takes and returns a Column."""

from __future__ import annotations

import string
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from feedlark.functions.stopwords import PROFILES

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The characters that count as white space, and the patterns to remove.
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
TAG = r"</?[^>]+>"
URL = rf"http[^{SPACE}]+|www[^{SPACE}]+"
# White space below and above U+0100. Single characters below it are one table to the regex engine, where each range is
# one more test for every character.
NEAR_SPACE = r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0"
FAR_SPACE = r"\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BAG = ArrayType(StructType().add("term", StringType()).add("tf", IntegerType()))
COUNT_ROWS = 500  # token arrays that are counted at a time


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _delete(c: Column | str, pattern: str) -> Column:
    """Delete every match; splitting and joining is faster than `regexp_replace`."""
    return F.array_join(F.split(_col(c), pattern), "")


def strip_html(c: Column | str) -> Column:
    """Delete tags; what stood before and after a tag is joined without a space."""
    c = _col(c)
    return F.when(F.contains(c, F.lit("<")), _delete(c, TAG)).otherwise(c)


def strip_urls(c: Column | str) -> Column:
    """Delete everything from `http` or `www` up to the next white space."""
    c = _col(c)
    some = F.contains(c, F.lit("http")) | F.contains(c, F.lit("www"))
    return F.when(some, _delete(c, URL)).otherwise(c)


def strip(c: Column | str) -> Column:
    """Remove white space of any kind from both ends (`trim` removes only spaces)."""
    return F.regexp_replace(_col(c), f"^[{SPACE}]+|[{SPACE}]+$", "")


def collapse_space(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(c), f"[{SPACE}]+", " "))


def keep_alnum(c: Column | str, upper: bool = False) -> Column:
    """Delete all but ASCII letters, digits and white space.

    Collects the runs that stay and joins them: several times as fast as deleting the others.
    """
    letters = string.ascii_lowercase + (string.ascii_uppercase if upper else "") + string.digits
    return F.array_join(F.regexp_extract_all(_col(c), F.lit(f"[{letters}{NEAR_SPACE}]+|[{FAR_SPACE}]+"), F.lit(0)), "")


def split_tokens(c: Column | str) -> Column:
    """Words between white space, empty ones dropped."""
    return F.array_remove(F.split(_col(c), f"[{SPACE}]+"), "")


def alnum_tokens(c: Column | str, min_len: int = 1) -> Column:
    """Words of text that went through `keep_alnum`."""
    return F.regexp_extract_all(_col(c), F.lit(f"[{string.ascii_lowercase}{string.digits}]{{{min_len},}}"), F.lit(0))


def word_tokens(c: Column | str) -> Column:
    r"""Lower-cased `\b\w+\b` tokens, where a word character may be any Unicode letter."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(r"(?U)(\b\w+\b)"), F.lit(1))


def drop_stop_words(tokens: Column | str, *profiles: str) -> Column:
    """Drop the stop words of every profile named, in one pass over the array.

    The lambda is SQL text: hundreds of literals made one by one would slow down planning.
    """
    stop = ", ".join(f"'{w}'" for w in sorted({w for p in profiles for w in PROFILES[p][0]}))
    return F.call_function("filter", _col(tokens), F.expr(f"t -> t NOT IN ({stop})"))


def filter_tokens(tokens: Column | str, *profiles: str) -> Column:
    """Drop the stop words of the profiles named, and tokens below their longest minimum length."""
    shortest = max(PROFILES[p][1] for p in profiles)
    return F.filter(drop_stop_words(tokens, *profiles), lambda t: F.length(t) >= shortest)


def clean_tokens(c: Column | str, profile: str) -> Column:
    """Tokens left after tags, URLs, punctuation, stop words and short words are gone."""
    text = F.lower(_col(c))
    if profile != "mapping":  # the mapping stage gets text that has no tags or URLs any more
        text = strip_urls(strip_html(text))
    return drop_stop_words(alnum_tokens(keep_alnum(text), PROFILES[profile][1]), profile)


def clean_text(c: Column | str, profile: str) -> Column:
    """Normalised text of a profile; never null: nothing left, or null, gives ''."""
    return F.coalesce(F.array_join(clean_tokens(c, profile), " "), F.lit(""))


def normalise_name(c: Column | str) -> Column:
    """Trim, single spaces, and no white space around hyphens and slashes."""
    c = collapse_space(c)
    return F.regexp_replace(F.regexp_replace(c, " *- *", "-"), " */ *", "/")


def join_texts(texts: Column | str) -> Column:
    """A list of comments as one text; null gives ''."""
    return F.coalesce(F.array_join(_col(texts), " "), F.lit(""))


def is_blank(c: Column | str) -> Column:
    c = _col(c)
    return c.isNull() | (F.trim(c) == "")


def text_key(c: Column | str) -> Column:
    """A 32-byte key that stands for a text in joins; SHA-256, so equal keys mean equal texts."""
    return F.unhex(F.sha2(_col(c), 256))


def _counted(tokens: pa.ListArray) -> pa.ListArray:
    """Arrays of tokens as arrays of (term, tf), by term; null tokens are left out."""
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    rows, found = np.repeat(np.arange(len(tokens)), sizes), tokens.flatten().dictionary_encode()
    known = found.is_valid().to_numpy(zero_copy_only=False)
    codes = found.indices.drop_null().to_numpy(zero_copy_only=False)
    order = pc.sort_indices(found.dictionary).to_numpy()
    n = max(1, len(order))
    place = np.zeros(n, np.int64)
    place[order] = np.arange(len(order))
    keys, tf = np.unique(rows[known] * n + place[codes], return_counts=True)
    terms = found.dictionary.take(pa.array(order[keys % n].astype(np.int64)))
    starts = np.searchsorted(keys, np.arange(len(tokens) + 1) * n).astype(np.int32)
    runs = pa.StructArray.from_arrays([terms, pa.array(tf, pa.int32())], ["term", "tf"])
    return pa.ListArray.from_arrays(pa.array(starts), runs, mask=tokens.is_null())


@F.arrow_udf(BAG)
def _term_counts(tokens: pa.Array) -> pa.Array:
    parts = [_counted(tokens.slice(i, COUNT_ROWS)) for i in range(0, len(tokens), COUNT_ROWS)]
    return pa.concat_arrays(parts or [_counted(tokens)])


def with_term_counts(df: DataFrame, tokens: str, bag: str = "bag") -> DataFrame:
    """Replace a token array by array<struct<term, tf>> in order of the terms, without leaving the row.

    Counted by Arrow, a few hundred arrays at a time: sorting and array lambdas call a function for every token.
    """
    return df.withColumn(bag, _term_counts(tokens)).drop(tokens)
