"""Scalar functions on text, as Column expressions; UDFs only where Spark has no equivalent."""

from __future__ import annotations

import difflib
import hashlib
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters that extraction leaves behind, and typographic ones with a plain form.
ZERO_WIDTH = "[\\u200B-\\u200F\\u00AD\\uFEFF]"
SMART, PLAIN = "‘’“”–—−", "''\"\"---"

# Frequent words by language, each with its spaces.
COMMON_WORDS = {
    "en": (" the ", " and ", " of ", " to ", " you ", " in ", " for "),
    "es": (" el ", " la ", " los ", " las ", " de ", " que ", " para "),
    "fr": (" le ", " la ", " les ", " des ", " du ", " et ", " une "),
    "de": (" der ", " die ", " das ", " und ", " den ", " ist ", " fur "),
    "pt": (" o ", " a ", " os ", " as ", " de ", " que ", " para "),
    "it": (" il ", " la ", " di ", " che ", " per ", " del ", " una "),
}
MIN_COMMON_PER_1K, MIN_JUDGED_CHARS, MIN_CHARS_PER_PAGE = 3.0, 500, 200

# The last digit of a semester's code.
SEMESTERS = {"spring": 2, "summer": 6, "fall": 9}


def squeeze(c: Column) -> Column:
    """Runs of Unicode white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip(c: Column) -> Column:
    """Without Unicode white space at the ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else t if t.isascii() else unicodedata.normalize("NFKC", t))


def folded(c: Column) -> Column:
    """The steps of ``normalize`` after NFKC."""
    c = F.translate(F.regexp_replace(c, ZERO_WIDTH, ""), SMART, PLAIN)
    return F.lower(squeeze(F.regexp_replace(c, r"(?U)-\s*", "")))


def normalize(c: Column) -> Column:
    """NFKC; no zero-width characters or hyphens; plain quotes and dashes; single spaces; lower case. Null gives ''."""
    return folded(nfkc(F.coalesce(c, F.lit(""))))


def as_quotes(c: Column) -> Column:
    """Array of non-blank quotes; null gives an empty array."""
    return F.coalesce(F.filter(c, lambda q: q.isNotNull() & (strip(q) != "")), F.array().cast("array<string>"))


def quotes_of_variant(c: Column) -> Column:
    """A JSON value to quotes: a non-blank string is one, a list gives its non-blank strings, all else none."""
    one = F.try_variant_get(c, "$", "string")
    kind = F.schema_of_variant(c)
    many = F.transform(F.try_variant_get(c, "$", "array<variant>"), lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))
    return as_quotes(F.when(kind == "STRING", F.array(one)).when(kind.startswith("ARRAY"), many))


def split_quotes(c: Column) -> Column:
    """Joined evidence back to its quotes: parts between blank lines that aren't blank."""
    return as_quotes(F.split(c, "\n\n"))


def pct(n: Column, total: Column) -> Column:
    """100 * n / total in full precision; null when total is 0."""
    return F.try_divide(n.cast("double") * 100.0, total.cast("double"))


def filename(disposition: Column) -> Column:
    """The file name in a Content-Disposition header, URL-decoded; a plus sign stays."""
    raw = F.regexp_extract(disposition, r"filename\*?=(?:UTF-8'')?[\"']?([^\"';]+)", 1)
    return F.nullif(F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), F.lit(""))


def media_type(header: Column) -> Column:
    """A Content-Type without its parameters."""
    return F.trim(F.split_part(header, F.lit(";"), F.lit(1)))


def last_updated(page: Column) -> Column:
    """What follows "Last updated" in a rendered page, as text."""
    return F.nullif(F.trim(F.regexp_extract(page, r"(?i)last updated:?\s*([^\n]+)", 1)), F.lit(""))


def semester_code(label: Column) -> Column:
    """'2026 Fall' to 20269."""
    season = F.create_map(*[F.lit(x) for kv in SEMESTERS.items() for x in kv])
    part = F.split(F.trim(label), r"\s+")
    return (F.try_element_at(part, F.lit(1)).cast("int") * 10 + season[F.lower(F.try_element_at(part, F.lit(2)))]).cast("int")


def occurrences(text: Column, needle: str) -> Column:
    """How often ``needle`` occurs, occurrences not overlapping; bytes are counted, which takes no pass over the text."""
    gone = F.replace(text, F.lit(needle), F.lit(""))
    return (F.octet_length(text) - F.octet_length(gone)) / F.lit(len(needle.encode()))


def common_word_rate(text: Column) -> Column:
    """The best language's count of frequent words per 1,000 characters."""

    def most(low: Column) -> Column:
        return F.greatest(*[sum((occurrences(low, w) for w in words), F.lit(0.0)) for words in COMMON_WORDS.values()])

    # The text is lowered once: the lambda binds it, where a plain expression would name it for every word.
    return F.try_divide(F.element_at(F.transform(F.array(F.lower(text)), most), 1), F.length(text) / F.lit(1000.0))


def looks_like_words(text: Column, rate: Column | None = None) -> Column:
    """Prose in some language; texts under 500 characters are not judged and pass. ``rate``: the text's common_word_rate, where a column has it."""
    rate = common_word_rate(text) if rate is None else rate
    return F.when(F.length(text) < MIN_JUDGED_CHARS, True).otherwise(rate >= MIN_COMMON_PER_1K)


def is_pdf(content: Column) -> Column:
    """The file begins with the PDF signature."""
    return F.substring(content, 1, 5) == F.lit(b"%PDF-")


@F.pandas_udf(T.StringType())
def blake2b_64(s: pd.Series) -> pd.Series:
    """The 8-byte BLAKE2b digest as 16 hex digits, whose order is that of the unsigned number."""
    return s.map(lambda t: None if t is None else hashlib.blake2b(t.encode(), digest_size=8).hexdigest())


def best_window_ratio(quote: str, body: str, enough: float = 0.92) -> bool:
    """Whether a window of the quote's length in ``body`` resembles it; windows step by a quarter quote."""
    size = len(quote)
    stop, step = max(1, len(body) - size + 1), max(1, size // 4)
    matcher = difflib.SequenceMatcher(None)
    matcher.set_seq1(quote)
    for at in range(0, stop, step):
        matcher.set_seq2(body[at : at + size])
        if matcher.real_quick_ratio() >= enough and matcher.quick_ratio() >= enough and matcher.ratio() >= enough:
            return True
    return False


@F.pandas_udf(T.BooleanType())
def resembles(quote: pd.Series, body: pd.Series) -> pd.Series:
    """Fuzzy tier of quote matching on normalized strings; only for pairs that failed the exact tier."""
    return pd.Series([bool(q) and best_window_ratio(q, b or "") for q, b in zip(quote, body)])


_WORD = re.compile(r"[^a-z]+")


def letters_only(text: str) -> list[str]:
    """Lower-case words of the letters a to z."""
    return [w for w in _WORD.split(text.lower()) if w]
