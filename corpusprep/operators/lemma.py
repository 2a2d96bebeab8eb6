"""Tokens, stopwords, lemmas and parts of speech.

Everything that needs only one row and a small word list stays inside the row.
A lemma lexicon is a table of any size. One that can be broadcast is joined with
the tokens in long form, which are regrouped by the row key. With a larger one the
tokens stay in arrays and meet their entries in chunks of documents (``lookup``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.text import alpha_words
from corpusprep.operators.lookup import annotated
from corpusprep.operators.tagger import TagModel, tagged_texts
from corpusprep.work import (
    LITERAL_ENTRIES, attach, broadcast_if_small, explode_each, is_small, keyed, regroup, small_rows, unkeyed, written,
)

# Parts of speech that are kept.
CONTENT_POS = ("VERB", "NOUN", "ADJ", "PROPN")


def tokenise(docs: DataFrame, text_col: str, out: str = "tokens") -> DataFrame:
    """Tokens made of letters only, in text order."""
    return docs.withColumn(out, alpha_words(F.col(text_col)))


def drop_stopwords(
    docs: DataFrame,
    tokens: str,
    stopwords: DataFrame,
    lang: Column,
    *,
    lower: bool,
    key: str | None = None,
    literal_entries: int = LITERAL_ENTRIES,
) -> DataFrame:
    """Remove tokens that are stopwords (lang, word) of the row's language.

    ``lower`` compares the lowercased token, as is done for surface words;
    without it the comparison is case-sensitive, as is done for lemmas.
    """
    fold = F.lower if lower else (lambda token: token)
    stopwords = stopwords.select("lang", "word").dropna()
    words = _words_by_language(stopwords, literal_entries)
    if words is None:
        given = key
        docs, key = keyed(docs, key)
        long = explode_each(docs, [key, lang.alias("lang")], F.col(tokens), "token")
        kept = _anti(long.withColumn("word", fold(F.col("token"))), stopwords)
        return unkeyed(attach(docs, regroup(kept, key, "token", tokens), key, tokens), given)
    branches = None
    for code, listed in words.items():
        kept = F.filter(tokens, _not_in(listed, fold))
        branches = F.when(lang == code, kept) if branches is None else branches.when(lang == code, kept)
    return docs if branches is None else docs.withColumn(tokens, branches.otherwise(F.col(tokens)))


def _not_in(listed: list[str], fold):
    return lambda token: ~fold(token).isin(listed)


def lookup_lemmas(
    docs: DataFrame,
    tokens: str,
    lexicon: DataFrame,
    lang: Column,
    *,
    key: str | None = None,
) -> tuple[DataFrame, DataFrame, str]:
    """Annotate every token from a lexicon (lang, form, lemma, pos).

    Returns the keyed documents, the tokens in long form (key, lang, pos, form,
    lemma, upos) and the key's name. Forms are found in any case. A form with
    several readings takes the first in the order of lemma and part of speech.
    A form that is not listed is its own lemma and has no part of speech.
    """
    docs, key = keyed(docs, key)
    found = _found_in_chunks(docs, tokens, lexicon, lang, key)
    if found is not None:
        return docs, found.select(key, "lang", F.inline("found")), key
    long = explode_each(docs, [key, lang.alias("lang")], F.col(tokens), "form")
    table = broadcast_if_small(_first_readings(lexicon), measured=_measured(lexicon))
    found = long.withColumn("folded", F.lower("form")).join(table, ["lang", "folded"], "left")
    found = found.select(key, "lang", "pos", "form", F.coalesce("lemma", "form").alias("lemma"), "upos")
    return docs, found, key


def _first_readings(lexicon: DataFrame) -> DataFrame:
    reading = F.min(F.struct("lemma", "pos")).alias("reading")
    table = lexicon.dropna(subset=["lang", "form"]).groupBy("lang", F.lower("form").alias("folded")).agg(reading)
    return table.select("lang", "folded", "reading.lemma", F.col("reading.pos").alias("upos"))


def _measured(lexicon: DataFrame) -> DataFrame:
    return lexicon.dropna(subset=["lang", "form"]).select("lang", "form", "lemma", "pos")


def _found_in_chunks(docs: DataFrame, tokens: str, lexicon: DataFrame, lang: Column, key: str) -> DataFrame | None:
    """(key, lang, found, repeated) of a lexicon that is too large for a broadcast, see ``lookup.annotated``."""
    if is_small(_measured(lexicon)):
        return None
    return annotated(_token_table(docs, tokens, lang, key), "tokens", _first_readings(lexicon), F.col("lang"), key)


def _token_table(docs: DataFrame, tokens: str, lang: Column, key: str) -> DataFrame:
    return written(docs.select(key, lang.alias("lang"), F.col(tokens).alias("tokens")), "tokens")


def content_lemmas(
    docs: DataFrame,
    tokens: str,
    lang: Column,
    *,
    lexicon: DataFrame | None = None,
    surface_stopwords: DataFrame | None = None,
    lemma_stopwords: DataFrame | None = None,
    keep_pos: tuple[str, ...] | None = CONTENT_POS,
    keep_unlisted: bool = True,
    model: TagModel | None = None,
    key: str | None = None,
    literal_entries: int = LITERAL_ENTRIES,
) -> DataFrame:
    """Tokens → lowercased lemmas of content words, in the same column.

    A token stays when its part of speech is in ``keep_pos`` (unlisted forms
    follow ``keep_unlisted``), its lowercased surface is not in
    ``surface_stopwords``, and its lemma is not in ``lemma_stopwords``. The last
    test comes before lowercasing and is case-sensitive. Documents that lose
    every token keep their row, with an empty array. A ``model`` of the lexicon
    (``tagger.train_tagger``) chooses among the readings of a form by its context;
    without one the first counts.
    """
    if lexicon is None:
        # Surface and lemma are the same here, so the case-sensitive list goes
        # first and the other one compares tokens that are lowercased already.
        if lemma_stopwords is not None:
            docs = drop_stopwords(
                docs, tokens, lemma_stopwords, lang, lower=False, key=key, literal_entries=literal_entries
            )
        docs = docs.withColumn(tokens, F.transform(tokens, F.lower))
        if surface_stopwords is not None:
            docs = drop_stopwords(
                docs, tokens, surface_stopwords, lang, lower=False, key=key, literal_entries=literal_entries
            )
        return docs

    given = key
    docs, key = keyed(docs, key)
    kept = lemma_arrays(
        docs, tokens, lang, lexicon=lexicon, surface_stopwords=surface_stopwords, lemma_stopwords=lemma_stopwords,
        keep_pos=keep_pos, keep_unlisted=keep_unlisted, model=model, key=key, literal_entries=literal_entries,
    )
    return unkeyed(attach(docs, kept, key, tokens), given)


def lemma_arrays(
    docs: DataFrame,
    tokens: str,
    lang: Column,
    *,
    lexicon: DataFrame,
    surface_stopwords: DataFrame | None = None,
    lemma_stopwords: DataFrame | None = None,
    keep_pos: tuple[str, ...] | None = CONTENT_POS,
    keep_unlisted: bool = True,
    model: TagModel | None = None,
    key: str,
    literal_entries: int = LITERAL_ENTRIES,
) -> DataFrame:
    """(key, ``tokens``) as ``content_lemmas`` has them, for the documents that keep a token."""
    stopwords = [(t, w) for t, w in ((surface_stopwords, lambda t: F.lower(t("form"))), (lemma_stopwords, lambda t: t("lemma"))) if t is not None]
    if model is None:
        found = _found_in_chunks(docs, tokens, lexicon, lang, key)
    else:
        found = tagged_texts(_token_table(docs, tokens, lang, key), "tokens", model, F.col("lang"), key, "found")
    if found is not None:
        lists = [(_words_by_language(_pairs(table), literal_entries), word) for table, word in stopwords]
        if all(words is not None for words, _ in lists):
            return _kept_arrays(found, key, tokens, lists, keep_pos, keep_unlisted)
        long = found.select(key, "lang", F.inline("found"))
    else:
        _, long, key = lookup_lemmas(docs, tokens, lexicon, lang, key=key)
    if keep_pos is not None:
        long = keep_parts_of_speech(long, keep_pos, keep_unlisted)
    for table, word in stopwords:
        long = _drop_long(long.withColumn("word", word(F.col)), table, literal_entries)
    return regroup(long.select(key, "pos", F.lower("lemma").alias("lemma")), key, "lemma", tokens)


def _kept_arrays(found: DataFrame, key: str, tokens: str, lists: list, keep_pos, keep_unlisted: bool) -> DataFrame:
    """What the long form gives, without a row for each token: (key, ``tokens``) for keys that keep a token."""

    def keeps(token: Column) -> Column:
        kept = F.lit(True) if keep_pos is None else _is_kept(token["upos"], keep_pos, keep_unlisted)
        for words, word in lists:
            kept = kept & ~_is_stopword(words, word(lambda name: token[name]))
        return kept

    kept = found.select(key, "repeated", F.filter("found", keeps).alias("kept")).where(F.size("kept") > 0)
    # Tokens of several rows with one key are merged by place, so only those need their places.
    places = F.when(F.col("repeated"), F.transform("kept", lambda t: t["pos"]))
    kept = kept.select(key, places.alias("places"), F.transform("kept", lambda t: F.lower(t["lemma"])).alias("lemmas"))
    rows = kept.groupBy(key).agg(F.collect_list(F.struct("places", "lemmas")).alias("rows"))
    placed = F.flatten(F.transform("rows", lambda r: F.arrays_zip(r["places"], r["lemmas"])))
    merged = F.transform(F.array_sort(placed), lambda t: t["lemmas"])
    one = F.get("rows", F.lit(0))["lemmas"]
    return rows.select(key, F.when(F.size("rows") == 1, one).otherwise(merged).alias(tokens))


def keep_parts_of_speech(long: DataFrame, keep_pos=CONTENT_POS, keep_unlisted: bool = True) -> DataFrame:
    """Long-form tokens whose ``upos`` is one of ``keep_pos``."""
    return long.where(_is_kept(F.col("upos"), keep_pos, keep_unlisted))


def _is_kept(upos: Column, keep_pos, keep_unlisted: bool) -> Column:
    return F.coalesce(upos.isin(*keep_pos), F.lit(keep_unlisted))


def _pairs(stopwords: DataFrame) -> DataFrame:
    return stopwords.select("lang", "word").dropna()


def _drop_long(long: DataFrame, stopwords: DataFrame, literal_entries: int) -> DataFrame:
    stopwords = _pairs(stopwords)
    words = _words_by_language(stopwords, literal_entries)
    return _anti(long, stopwords) if words is None else long.where(~_is_stopword(words, F.col("word")))


def _is_stopword(words: dict[str, list[str]], word: Column) -> Column:
    stop = F.lit(False)
    for code, listed in words.items():
        stop = stop | F.coalesce((F.col("lang") == code) & word.isin(listed), F.lit(False))
    return stop


def _anti(long: DataFrame, stopwords: DataFrame) -> DataFrame:
    listed = stopwords.select("lang", "word")
    return long.join(broadcast_if_small(listed.distinct(), measured=listed), ["lang", "word"], "left_anti")


def _words_by_language(stopwords: DataFrame, limit: int) -> dict[str, list[str]] | None:
    rows = small_rows(stopwords.select("lang", "word"), limit)
    if rows is None:
        return None
    by_lang: dict[str, list[str]] = {}
    for row in sorted(set(rows)):
        by_lang.setdefault(row["lang"], []).append(row["word"])
    return by_lang
