"""Cleaning, number tokens and block types as column expressions; no Python runs on rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Zero-width code points that cleaning removes.
ZERO_WIDTH = "\u200b\u200c\u200d\ufeff"
#: The code points that end a line (as Python's str.splitlines has them).
LINE_END = r"\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
#: White space inside a line.
BLANK = r"[ \t\x1f\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"
#: A number with its brackets and signs, not inside a word.
NUMBER = r"(?U)(?<![A-Za-z0-9])(?:\(?\$?\s*[+-]?\s*\d[\d,]*(?:\.\d+)?%?\)?)(?![A-Za-z0-9])"

#: Terms that mark a financial statement, and how notes and other parts are named.
STATEMENT_TERMS = ("balance sheet", "income statement", "cash flow", "statement of operations", "statement of comprehensive")
NOTE, NOTES, PART = r"\bnote\s+\d+\b", "notes to", r"\b(?:item|part)\s+[0-9ivx]+\b"
BLOCK_TYPES = ("financial_statement", "note", "other_context", "unknown")


def clean_line(line: Column) -> Column:
    """One line without zero-width marks, its white space single, its ends stripped."""
    return F.trim(F.regexp_replace(F.translate(line, ZERO_WIDTH, ""), f"{BLANK}+", " "))


def clean(text: Column) -> Column:
    """Without zero-width marks; each line's white space made single, lines and their order kept, ends stripped."""
    one = F.regexp_replace(F.translate(text, ZERO_WIDTH, ""), LINE_END, "\n")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(one, f"{BLANK}+", " "), "(?d) *\n *", "\n"), r"^[\n ]+|[\n ]+\z", "")


def numbers(text: Column) -> Column:
    """The number tokens in order, white space removed."""
    return F.transform(F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0)), lambda x: F.regexp_replace(x, r"(?U)\s+", ""))


def keeps_numbers(before: Column, after: Column) -> Column:
    """Whether cleaning left the sequence of numbers as it was."""
    return numbers(before).eqNullSafe(numbers(after))


def block_type(text: Column, kind: Column) -> Column:
    """financial_statement, note, other_context or unknown; the first rule that holds."""
    low = F.lower(text)
    statement = (kind == "table") | low.rlike("|".join(STATEMENT_TERMS))
    return F.when(statement, "financial_statement").when(low.rlike(NOTE) | low.startswith(NOTES), "note").when(low.rlike(PART), "other_context").otherwise("unknown")


def paragraphs(text: Column) -> Column:
    """array<struct<first, text>>: runs of nonblank lines with the number of their first line, from 1.

    Lines get their numbers in front and are joined again; the numbered blank lines are where
    this text is split, so the work grows with its length only.
    """
    numbered = F.array_join(F.transform(F.split(text, LINE_END), lambda x, i: F.concat((i + 1).cast("string"), F.lit(":"), x)), "\n")
    runs = F.filter(F.split(numbered, rf"(?dm)^[0-9]+:{BLANK}*(?:\n|\z)"), lambda x: x != "")
    bare = lambda x: F.regexp_replace(F.regexp_replace(x, r"\n\z", ""), "(?dm)^[0-9]+:", "")
    return F.transform(runs, lambda x: F.struct(F.regexp_extract(x, "^([0-9]+):", 1).cast("int").alias("first"), bare(x).alias("text")))
