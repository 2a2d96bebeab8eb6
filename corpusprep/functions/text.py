"""Column expressions over text. All run inside the JVM and on streams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{M}\p{N}_"
ALPHA = r"\p{L}"
# Characters of ``letter_text``.
LETTERS = r"\p{L}\p{M}"
# What Python's str.split() treats as white space.
_SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"


def words(text: Column) -> Column:
    """Every run of letters, marks, digits and underscores."""
    return F.regexp_extract_all(text, F.lit(f"([{WORD}]+)"), F.lit(1))


def alpha_words(text: Column) -> Column:
    """``words`` whose characters are all letters; ``abc1`` is left out, not split."""
    return F.regexp_extract_all(text, F.lit(rf"(?<![{WORD}])([{ALPHA}]++)(?![{WORD}])"), F.lit(1))


def run_pattern(inner: str = "") -> str:
    word = r"[\p{L}\p{N}_]+"
    return f"{word}(?:[{inner}]{word})*" if inner else word


def runs(text: Column, inner: str = "", compounds: list[str] | tuple[str, ...] = (), any_case: bool = True) -> Column:
    """Split text into word runs and the stretches between them; nothing is lost.

    ``inner`` lists characters that may stand inside a word, such as apostrophes.
    ``compounds`` are entries with other characters inside, such as ``R&D``; where
    one stands as a whole word it is one piece, the longest first.
    """
    other = r"[^\p{L}\p{N}_]"
    if not compounds:
        return F.regexp_extract_all(text, F.lit(rf"({run_pattern(inner)}|{other}+)"), F.lit(1))
    listed = "|".join(rf"\Q{c}\E" for c in sorted(compounds, key=lambda c: (-len(c), c)))
    entry = rf"(?<![\p{{L}}\p{{N}}_])(?{'iu' if any_case else ''}:{listed})(?![\p{{L}}\p{{N}}_])"
    pattern = rf"({entry}|{run_pattern(inner)}|(?:(?!{entry}){other})+)"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def word_count(text: Column) -> Column:
    """Number of white-space separated words."""
    return F.regexp_count(text, F.lit(f"[^{_SPACE}]+"))


def letter_text(text: Column) -> Column:
    """The lowercased letters of a text; other characters between them become one space."""
    return F.array_join(F.regexp_extract_all(F.lower(text), F.lit(f"([{LETTERS}]+)"), F.lit(1)), " ")


def letter_trigrams(text: Column) -> Column:
    """Overlapping three-character pieces of ``letter_text``.

    The text is padded with spaces, so that word starts and ends count. A text
    without letters has none.
    """
    padded = F.concat(F.lit(" "), letter_text(text), F.lit(" "))
    return F.regexp_extract_all(padded, F.lit("(?=(...))"), F.lit(1))


def next_pairs(tokens: Column) -> Column:
    """Array of (token, following token); the last token is followed by null."""
    return F.arrays_zip(tokens, F.slice(tokens, 2, F.size(tokens)))


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def truncate(tokens: Column, max_tokens: int | None) -> Column:
    """The encoder's input limit; None means no limit."""
    return tokens if max_tokens is None else F.slice(tokens, 1, max_tokens)


def part_number(path: Column) -> Column:
    """Number at the end of a part file's name, as in ``…_part_12.parquet``."""
    return F.regexp_extract(path, r"part_(\d+)\.parquet$", 1).try_cast("int")
