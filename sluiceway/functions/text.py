"""Splitting text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of the two splitters.
LETTERS = r"\p{L}+"
BLANKS = r"\s+"
LEADING_SEPARATOR = r"\A[^\p{L}]+\p{L}"
# A line break before a line that is empty, or that starts with separators and has a letter later on.
BREAK_BEFORE_EMPTY_TOKEN = r"(?>\r\n|[\r\n])(?=[\r\n]|[^\p{L}\r\n]++\p{L})"


def line_tokens(line: Column) -> Column:
    """Tokens of one line between runs of non-letters.

    A leading empty token is kept, trailing ones are dropped, and an empty line is one empty token.
    """
    opens_empty = (line == "") | line.rlike(LEADING_SEPARATOR)
    lead = F.when(opens_empty, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.concat(lead, F.regexp_extract_all(line, F.lit(LETTERS), F.lit(0)))


def text_tokens(body: Column) -> Column:
    """Tokens of all lines of a text, empty ones where they stand; a final line break does not open another line.

    The text is not cut into lines: a break is no letter, so words never cross it. One search finds the words, and the
    breaks before an empty token, whose group is then empty.
    """
    return F.regexp_extract_all(F.concat(F.lit("\n"), body), F.lit(f"{BREAK_BEFORE_EMPTY_TOKEN}|({LETTERS})"), F.lit(1))


def kv_words(text: Column) -> Column:
    """``key:value`` words of a message as structs, up to the first word without a colon."""
    words = F.split(F.regexp_replace(text, BLANKS + "$", ""), BLANKS)
    bad = F.array_position(F.transform(words, lambda w: F.contains(w, F.lit(":"))), F.lit(False))
    good = F.when(bad == 0, words).otherwise(F.slice(words, F.lit(1), F.greatest(bad - 1, F.lit(0)).cast("int")))
    return F.transform(
        good,
        lambda w: F.struct(
            F.split_part(w, F.lit(":"), F.lit(1)).alias("key"),
            F.substring(w, F.instr(w, ":") + 1, F.length(w)).alias("value"),
        ),
    )
