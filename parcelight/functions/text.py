"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that separate words (all Unicode white space
# that a plain whitespace split uses).
SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + (
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regular expression class.
WHITESPACE = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# Age bucket labels in display order, with their upper age.
AGE_BUCKETS = (("<25", 24), ("25-34", 34), ("35-44", 44), ("45-54", 54))
LAST_AGE_BUCKET = "55+"


def words(text: Column) -> Column:
    """Words of a text, empty strings left out.

    Mapping all separators to the blank and splitting at that one character is
    faster than a regular expression over the whole class.
    """
    blanks = F.translate(text, SPACES, " " * len(SPACES))
    return F.array_remove(F.split(blanks, " "), "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, f"^{WHITESPACE}+|{WHITESPACE}+$", "")


def strip_code_fence(text: Column) -> Column:
    """Unwrap an answer that a model put in a fenced block.

    Only a text that starts with a fence changes: its first line goes, and its
    last line goes if there is nothing but a fence on it.
    """
    trimmed = strip_space(text)
    body = F.regexp_replace(trimmed, r"\A```[^\r\n]*(\r\n|\r|\n|\z)", "")
    body = F.regexp_replace(body, r"(\A|\r\n|\r|\n)[ \t]*```[ \t]*\z", "")
    return F.when(trimmed.startswith("```"), strip_space(body)).otherwise(trimmed)


def age_bucket(age: Column) -> Column:
    """Age band; an unknown age falls into the last one."""
    label = F.lit(LAST_AGE_BUCKET)
    for name, upper in reversed(AGE_BUCKETS):
        label = F.when(F.floor(age) <= upper, name).otherwise(label)
    return label


def age_bucket_rank(bucket: Column) -> Column:
    names = [name for name, _ in AGE_BUCKETS] + [LAST_AGE_BUCKET]
    return F.array_position(F.array(*[F.lit(n) for n in names]), bucket).cast("int")


def yes_no(flag: Column) -> Column:
    return F.when(flag == 1, "Yes").otherwise("No")


def late_label(flag: Column) -> Column:
    return F.when(flag == 1, "LATE").otherwise("ON TIME")
