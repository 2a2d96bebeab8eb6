"""Whole-word replacement from dictionaries: acronyms and contractions.

A text is split once into words and the stretches between them, each word is
looked up, and the pieces are put together again. A dictionary of checked size
is held in the expression, so no row moves. A larger one is joined. Entries that
are not one word run, such as ``COVID-19``, are kept whole by the split; there may
be 10,000 of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.text import run_pattern, runs
from corpusprep.work import LITERAL_ENTRIES, broadcast_if_small, explode_each, keyed, small_rows, unkeyed

_APOSTROPHES = "'’"


def expand_acronyms(
    docs: DataFrame,
    text_col: str,
    acronyms: DataFrame,
    lang: Column,
    *,
    case_sensitive: bool = False,
    key: str | None = None,
    literal_entries: int = LITERAL_ENTRIES,
) -> DataFrame:
    """Replace whole-word acronyms (lang, acronym, expansion) by their expansion.

    Each row uses the acronyms of its own language ``lang``; a language without
    any is left unchanged. Upper and lower case are alike unless ``case_sensitive``.
    Entries may hold any characters; of those that fit at one place the longest counts.
    """
    match = (lambda run: run) if case_sensitive else F.lower
    table = acronyms.select("lang", match(F.col("acronym")).alias("word"), "expansion")
    return _replace(docs, text_col, table, lang, "", match, lambda run, found: found, key, literal_entries, case_sensitive)


def expand_contractions(
    docs: DataFrame,
    text_col: str,
    contractions: DataFrame,
    lang: Column,
    *,
    key: str | None = None,
    literal_entries: int = LITERAL_ENTRIES,
) -> DataFrame:
    """Replace contractions (lang, contraction, expansion) such as ``isn't``.

    Straight and curved apostrophes and upper and lower case are alike; an
    initial capital is kept.
    """

    def match(run: Column) -> Column:
        return F.lower(F.translate(run, "’", "'"))

    def render(run: Column, found: Column) -> Column:
        first = F.substring(run, 1, 1)
        capital = F.concat(F.upper(F.substring(found, 1, 1)), found.substr(F.lit(2), F.length(found)))
        return F.when(first != F.lower(first), capital).otherwise(found)

    table = contractions.select("lang", match(F.col("contraction")).alias("word"), "expansion")
    return _replace(docs, text_col, table, lang, _APOSTROPHES, match, render, key, literal_entries)


def _replace(
    docs: DataFrame,
    text_col: str,
    table: DataFrame,
    lang: Column,
    inner: str,
    match: Callable[[Column], Column],
    render: Callable[[Column, Column], Column],
    key: str | None,
    literal_entries: int,
    case_sensitive: bool = False,
) -> DataFrame:
    table = table.dropna()
    compounds = _compounds(table, inner)

    def split(text: Column, code: str) -> Column:
        return runs(text, inner, compounds.get(code, ()), not case_sensitive)

    entries = small_rows(table, literal_entries)
    text = F.col(text_col)
    if entries is None:
        pieces = runs(text, inner)
        for code in compounds:
            pieces = F.when(lang == code, split(text, code)).otherwise(pieces)
        return _replace_by_join(docs, text_col, table, lang, pieces, match, render, key)

    # Texts without any of the marks that every entry has are left as they are.
    marked = inner and all(set(inner) & set(row["word"]) for row in entries)
    has_mark = text.rlike(f"[{inner}]") if marked else F.lit(True)

    # A word that is listed twice has the first of its expansions in sort order.
    by_lang: dict[str, dict[str, str]] = {}
    for row in sorted(entries):
        by_lang.setdefault(row["lang"], {}).setdefault(row["word"], row["expansion"])
    branches = None
    for code, words in by_lang.items():
        replaced = F.array_join(F.transform(split(text, code), _lookup(words, match, render)), "")
        fits = (lang == code) & has_mark
        branches = F.when(fits, replaced) if branches is None else branches.when(fits, replaced)
    return docs if branches is None else docs.withColumn(text_col, branches.otherwise(text))


def _compounds(table: DataFrame, inner: str) -> dict[str, list[str]]:
    """The words of each language that a split into runs would take apart."""
    rows = small_rows(table.where(~F.col("word").rlike(f"^{run_pattern(inner)}$")).select("lang", "word").distinct())
    if rows is None:
        raise ValueError(f"more than {LITERAL_ENTRIES} entries are not one word")
    found: dict[str, list[str]] = {}
    for code, word in sorted(rows):
        if word:
            found.setdefault(code, []).append(word)
    return found


def _lookup(words: dict[str, str], match, render) -> Callable[[Column], Column]:
    expansions = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])

    def replace(run: Column) -> Column:
        # The set test is a hash lookup; the map is searched for hits only.
        word = match(run)
        return F.when(word.isin(list(words)), render(run, expansions[word])).otherwise(run)

    return replace


def _replace_by_join(docs, text_col, table, lang, pieces, match, render, key) -> DataFrame:
    given, columns = key, docs.columns
    docs, key = keyed(docs, key)
    single = table.groupBy("lang", "word").agg(F.min("expansion").alias("found"))
    pieces = explode_each(docs, [key, lang.alias("lang")], pieces, "run")
    pieces = pieces.withColumn("word", match(F.col("run")))
    looked_up = pieces.join(broadcast_if_small(single, measured=table), ["lang", "word"], "left").select(
        key, "pos", F.when(F.col("found").isNull(), F.col("run")).otherwise(render(F.col("run"), F.col("found"))).alias("run")
    )
    parts = F.array_sort(F.collect_list(F.struct("pos", "run")))
    texts = looked_up.groupBy(key).agg(F.array_join(F.transform(parts, lambda e: e["run"]), "").alias("_new"))
    joined = docs.join(texts, key, "left")
    return unkeyed(joined.withColumn(text_col, F.coalesce("_new", text_col)).drop("_new"), given).select(columns)
