"""Tokenizers as column expressions (no Python UDF).

Two rules exist in the reference:

* ``whitespace``: split on runs of the five default tokenizer delimiters
  (space, tab, newline, carriage return, form feed); empty tokens never occur.
* ``space``: split one line on the single space character, keeping leading and
  interior empty tokens and dropping trailing ones. An empty line yields one
  empty token; a line of only spaces yields none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The delimiters of the whitespace rule besides the space, and the line breaks of a text file
# besides \n (longest first). All are replaced before a split at one plain character: a pattern would be
# compiled for every line and tried at every character.
OTHER_DELIMITERS = ("\t", "\n", "\r", "\f")
OTHER_BREAKS = ("\r\n", "\r")


def _replaced(text: Column, parts: tuple[str, ...], by: str) -> Column:
    for part in parts:
        text = F.replace(text, F.lit(part), F.lit(by))
    return text


def whitespace_tokens(text: Column) -> Column:
    """array<string> of non-empty whitespace-delimited tokens, case kept."""
    return F.array_remove(F.split(_replaced(text, OTHER_DELIMITERS, " "), " "), "")


def space_tokens(line: Column, drop_empty: bool = False) -> Column:
    """array<string> of single-space tokens of one line (see module doc); ``drop_empty`` leaves out empty ones."""
    if drop_empty:
        return F.array_remove(F.split(line, " "), "")
    trimmed = F.rtrim(line)  # spaces only
    return (
        F.when(line == F.lit(""), F.array(F.lit("")))
        .when(trimmed == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " "))
    )


def text_lines(text: Column) -> Column:
    """array<string> of the lines of a text value, as a line reader sees them.

    A final line break does not start an extra (empty) line; an empty text has
    no lines.
    """
    last = F.when(F.endswith(text, F.lit("\r\n")), 2).when(F.endswith(text, F.lit("\n")) | F.endswith(text, F.lit("\r")), 1).otherwise(0)
    body = F.substring(text, F.lit(1), F.length(text) - last)
    return F.when(text == F.lit(""), F.array().cast("array<string>")).otherwise(
        F.split(_replaced(body, OTHER_BREAKS, "\n"), "\n")
    )


def counted(tokens: Column) -> Column:
    """array<struct<word, n>>: every different token of one array with the times it occurs there.

    The sorted tokens are cut where one differs from the one before, so no table of counts is kept.
    """
    def runs(s: Column) -> Column:
        starts = F.array_compact(F.transform(s, lambda x, i: F.when((i == 0) | (x != F.get(s, i - 1)), i)))
        return F.element_at(F.transform(F.array(starts), lambda b: F.transform(b, lambda i, k: F.struct(
            F.get(s, i).alias("word"), (F.coalesce(F.get(b, k + 1), F.size(s)) - i).cast("bigint").alias("n")))), 1)

    return F.element_at(F.transform(F.array(F.sort_array(tokens)), runs), 1)
