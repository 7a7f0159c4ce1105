"""Whitespace, tokens and bags of words as array expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Java trim strips, and ASCII whitespace.
TRIMMED = "".join(chr(c) for c in range(0x21))
WHITESPACE = " \t\n\x0b\f\r"
WHITESPACE_RUN = r"[ \t\n\x0B\f\r]+"

# A token runs from the first to the last letter of a maximal run of letters, digits and
# apostrophes, which is the same as splitting on everything else and stripping non-letters
# from both ends.
CLEAN_TOKEN = r"\p{L}(?:[\p{L}\p{Nd}']*\p{L})?"
# A maximal run of at least four ASCII letters and digits with a letter in it.
TRAINING_TOKEN = r"(?<![A-Za-z0-9])(?=[A-Za-z0-9]{4})[0-9]*+[A-Za-z][A-Za-z0-9]*+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind an expensive expression to a lambda variable, so it is evaluated once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trim_all(col: Column) -> Column:
    return F.btrim(col, F.lit(TRIMMED))


def collapse_whitespace(col: Column) -> Column:
    return trim_all(F.regexp_replace(col, WHITESPACE_RUN, " "))


def is_blank(col: Column) -> Column:
    return col.isNull() | (trim_all(col) == "")


def clean_tokens(col: Column) -> Column:
    """Lower-cased tokens of running text, in order."""
    return F.transform(F.regexp_extract_all(col, F.lit(CLEAN_TOKEN), F.lit(0)), F.lower)


def training_tokens(col: Column) -> Column:
    """Lower-cased ASCII tokens with a letter and at least four characters, in order."""
    return F.transform(F.regexp_extract_all(col, F.lit(TRAINING_TOKEN), F.lit(0)), F.lower)


def without_words(tokens: Column, words: Iterable[str]) -> Column:
    """Drop the given words; a long literal list is probed as a hash set."""
    words = list(words)
    return F.filter(tokens, lambda t: ~t.isin(words)) if words else tokens


def run_lengths(tokens: Column) -> Column:
    """ARRAY<STRUCT<token, n>> ordered by token: a multiset count inside the row.

    Sorting the row's own array and measuring runs needs no explode and no shuffle.
    """

    def count_runs(ordered: Column) -> Column:
        numbered = F.transform(ordered, lambda t, i: F.struct(t.alias("token"), i.alias("at")))
        starts = F.filter(
            numbered,
            lambda s: (s["at"] == 0) | (s["token"] != F.get(ordered, s["at"] - 1)),
        )
        return let(
            starts,
            lambda st: F.transform(
                st,
                lambda s, k: F.struct(
                    s["token"].alias("token"),
                    (F.coalesce(F.get(st, k + 1)["at"], F.size(ordered)) - s["at"])
                    .cast("long")
                    .alias("n"),
                ),
            ),
        )

    return let(F.sort_array(tokens), count_runs)


def bag_string(counts: Column) -> Column:
    """token:n pairs joined by a space."""
    pairs = F.transform(counts, lambda c: F.concat(c["token"], F.lit(":"), c["n"].cast("string")))
    return F.array_join(pairs, " ")


HAN_RUN = "[\\p{IsHan}]+"


def han_bigrams(text: Column) -> Column:
    """Tokens of unsegmented text: overlapping pairs of Han characters (a single one by itself), and
    the usual training tokens of what is between them."""
    pairs = F.transform(
        F.regexp_extract_all(text, F.lit(HAN_RUN), F.lit(0)),
        lambda run: F.when(F.char_length(run) == 1, F.array(run)).otherwise(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.char_length(run) - 1, F.lit(1))),
                lambda i: F.substring(run, i, F.lit(2)),
            )
        ),
    )
    return F.concat(F.flatten(pairs), training_tokens(F.regexp_replace(text, HAN_RUN, " ")))
