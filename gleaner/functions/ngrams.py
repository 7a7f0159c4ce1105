"""Character n-grams of words for language detection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{M}]+"
MAX_N = 3
# Every three characters of a padded word, taken by a lookahead capture so that windows overlap
# and the work is linear in the word. A window ending in two capitals is skipped, so acronyms do
# not count.
_WINDOW = r"(?!.\p{Lu}{2})(?=(.{3}))"

# Scripts the profiles fold to one representative letter each.
FOLDED_SCRIPTS = {
    r"\p{IsHiragana}": "あ",
    r"\p{IsKatakana}": "ア",
    r"\p{IsHangul}": "가",
    r"\p{IsBopomofo}": "ㄅ",
}


# Ranges that hold all characters of these scripts, and are much faster to look for.
_NEAR_FOLDED = r"[\x{2EA}\x{2EB}\x{1100}-\x{11FF}\x{302E}-\x{10FFFF}]"


def fold_scripts(text: Column) -> Column:
    """The scripts are looked up only in texts that have a character in their ranges."""
    folded = text
    for script, letter in FOLDED_SCRIPTS.items():
        folded = F.regexp_replace(folded, script, letter)
    wide = F.octet_length(text) > F.char_length(text)
    wanted = wide & text.rlike(_NEAR_FOLDED) & text.rlike("[" + "".join(FOLDED_SCRIPTS) + "]")
    return F.when(wanted, folded).otherwise(text)


def language_words(text: Column) -> Column:
    return F.regexp_extract_all(fold_scripts(text), F.lit(WORD), F.lit(0))


def word_windows(word: Column) -> Column:
    """One window of three characters per character of the word and its closing space."""
    padded = F.concat(F.lit("  "), word, F.lit(" "))
    return F.regexp_extract_all(padded, F.lit(_WINDOW), F.lit(1))


def window_ngrams(window: Column) -> Column:
    """The n-grams ending with a window; null in place of those that would span a space."""
    last, middle = F.substring(window, 3, 1), F.substring(window, 2, 1)
    return F.array(
        F.when(last != " ", last),
        F.substring(window, 2, 2),
        F.when(middle != " ", window),
    )
