"""Parts of speech by context: a bigram tag model and its best path, and lemmas of forms that no lexicon lists.

The model needs no tagged corpus. Most forms of a lexicon have one part of speech,
so tokens next to each other that are both of that kind tag themselves: how often
one tag follows another is a grouped count over the corpus. How often a form has a
tag is a grouped count over the lexicon, where a reading may have a weight. Both
are counted in parts before anything is shuffled.

Reading a text then means choosing one tag for each ambiguous token. A token with
one possible tag separates what is left of it from what is right of it, so only
runs of ambiguous tokens have to be decoded. Documents meet the readings of their
forms in chunks (``lookup``), and a task decodes the runs of a chunk together
(``viterbi``). A long run takes time in proportion to its length.

Scores are whole millionths, so results do not depend on the order of additions.
Equal scores go to the tag that sorts first, at each token on its own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.operators.lookup import by_chunk, chunk_entries, chunked, found_lists, match, texts_of, whole, with_found
from corpusprep.operators.viterbi import best_path
from corpusprep.work import broadcast_if_small, explode_each, small_rows, written

_MILLION = 1_000_000
# Tags that a model may have; a score for each pair of them is held in the expression.
MAX_TAGS = 64
# Pairs of readings that are compared at once.
BLOCK = 1 << 20
# What the model has for the start and the end of a text, and for tokens without a known tag.
EDGE = ""


@dataclass(frozen=True)
class TagModel:
    """``tags`` are sorted; ``follows[a][b]`` is the score of tag ``b`` after ``a``, the last index being the edge.

    ``readings`` (lang, folded, n_tags, readings) has an array of (tag, score, lemma) for each form, by tag.
    """

    tags: list[str]
    follows: list[list[int]]
    readings: DataFrame


def form_readings(lexicon: DataFrame) -> DataFrame:
    """(lang, folded, tag, n, lemma) from a lexicon (lang, form, lemma, pos), with a weight ``n`` if it has one.

    Forms are found in any case. Of several lemmas for one tag the first in sort order counts.
    """
    weight = F.col("n") if "n" in lexicon.columns else F.lit(1)
    rows = lexicon.dropna(subset=["lang", "form", "pos"])
    return rows.groupBy("lang", F.lower("form").alias("folded"), F.col("pos").alias("tag")).agg(
        F.sum(weight).cast("bigint").alias("n"), F.min("lemma").alias("lemma")
    )


def tag_pairs(docs: DataFrame, tokens: str, lang: Column, readings: DataFrame, key: str) -> DataFrame:
    """(tag, next, n): how often a token with the one tag is followed by one with the other.

    A form with several tags, or with none, counts as neither; the start and the end of a text count as an edge.
    Rows of one key count as one text, in which the greater of two tags stands at a place.
    """
    sure = readings.groupBy("lang", "folded").agg(F.min("tag").alias("tag"), F.max("tag").alias("last"))
    sure = sure.where(F.col("tag") == F.col("last")).drop("last")
    chunks = chunked(docs, tokens, lang, key)
    schema = T.StructType().add("tag", "string").add("next", "string").add("n", "long")
    pairs = by_chunk(chunks, chunk_entries(chunks, sure), _count_pairs, schema)
    return pairs.groupBy("tag", "next").agg(F.sum("n").alias("n"))


def _count_pairs(docs: pa.Table, entries: pa.Table) -> pa.Table:
    at = match(docs, entries)
    names = sorted(set(entries["tag"].to_pylist()))
    number = np.append(pc.index_in(whole(entries["tag"]), value_set=pa.array(names, pa.string())).to_numpy(zero_copy_only=False), -1)
    text, places, tag = texts_of(docs, ["key"])[at.doc], at.pos, number[at.entry].astype(np.int64)
    # The tokens of a text by place, the greatest tag last; only that one stays.
    order = np.lexsort((tag, places, text))
    text, places, tag = text[order], places[order], tag[order]
    last = np.append((text[1:] != text[:-1]) | (places[1:] != places[:-1]), True)
    text, tag = text[last], tag[last]
    # Between two texts stands an edge; pairs of two edges do not occur, because every text has a token.
    breaks = np.append(0, np.append(np.flatnonzero(text[1:] != text[:-1]) + 1, len(text)))
    edge = len(names)
    tag = np.insert(tag, breaks, edge)
    first, second = tag[:-1], tag[1:]
    pairs, n = np.unique((first * (edge + 1) + second)[(first >= 0) & (second >= 0)], return_counts=True)
    names = pa.array([*names, EDGE], pa.string())
    return pa.table({"tag": names.take(pa.array(pairs // (edge + 1))), "next": names.take(pa.array(pairs % (edge + 1))), "n": n.astype(np.int64)})


def train_tagger(docs: DataFrame, tokens: str, lexicon: DataFrame, lang: Column, key: str) -> TagModel:
    """The model of a corpus and its lexicon. Counts are written; the driver gets one row for each pair of tags."""
    readings = written(form_readings(lexicon), "readings")
    names = small_rows(readings.select("tag").distinct(), MAX_TAGS)
    if names is None:
        raise ValueError(f"the lexicon has more than {MAX_TAGS} parts of speech")
    tags = sorted(r["tag"] for r in names)
    pairs = tag_pairs(docs, tokens, lang, readings, key)
    counts = {(r["tag"], r["next"]): r["n"] for r in pairs.collect()}
    total = readings.groupBy("tag").agg(F.sum("n").alias("total"))
    return TagModel(tags, _follow_scores(tags, counts), written(_scored(readings, total, tags), "scored_readings"))


def _follow_scores(tags: list[str], counts: dict[tuple[str, str], int]) -> list[list[int]]:
    """Logarithms of shares, one added to every count."""
    edges = [*tags, EDGE]
    scores = []
    for tag in edges:
        total = sum(counts.get((tag, other), 0) + 1 for other in edges)
        scores.append([round(math.log((counts.get((tag, other), 0) + 1) / total) * _MILLION) for other in edges])
    return scores


def _scored(readings: DataFrame, total: DataFrame, tags: list[str]) -> DataFrame:
    score = F.round(F.log(F.col("n") / F.col("total")) * _MILLION).cast("bigint")
    number = F.array_position(F.array(*map(F.lit, tags)), F.col("tag")).cast("int") - 1
    scored = readings.join(F.broadcast(total), "tag")  # a row for each tag
    reading = F.struct(number.alias("tag"), score.alias("score"), "lemma")
    grouped = scored.groupBy("lang", "folded").agg(F.array_sort(F.collect_list(reading)).alias("readings"))
    return grouped.select("lang", "folded", F.size("readings").alias("n_tags"), "readings")


def tag_tokens(docs: DataFrame, tokens: str, model: TagModel, lang: Column, key: str, out: str = "tagged") -> DataFrame:
    """(key, lang, ``out``): for each document an array of (pos, form, lemma, upos) in text order.

    A token without a reading is its own lemma and has no part of speech. Documents without tokens have no row.
    Rows of one key and language are one text, with their tokens by place and form.
    """
    return tagged_texts(docs, tokens, model, lang, key, out).drop("repeated")


def tagged_texts(docs: DataFrame, tokens: str, model: TagModel, lang: Column, key: str, out: str) -> DataFrame:
    """``tag_tokens`` with a column ``repeated``: whether there are rows of the key in other languages."""
    tags, follows, block = model.tags, np.array(model.follows, np.int64), BLOCK

    def tagged(docs: pa.Table, entries: pa.Table) -> pa.Table:
        return _tag_chunk(docs, entries, tags, follows, block)

    chunks = chunked(docs, tokens, lang, key)
    other = F.transform("readings", lambda r: F.struct(r["tag"].alias("tag"), r["score"].alias("score"), F.nullif(r["lemma"], F.col("form")).alias("lemma")))
    entries = chunk_entries(chunks, model.readings.drop("n_tags")).withColumn("readings", other)
    return with_found(chunks, entries, tagged, key, out)


def _tag_chunk(docs: pa.Table, entries: pa.Table, tags: list[str], follows: np.ndarray, block: int) -> pa.Table:
    at = match(docs, entries)
    texts = texts_of(docs, ["key", "lang"])
    form, pos, entry, text = at.form, at.pos, at.entry, texts[at.doc]
    if len(np.unique(texts)) < len(docs):
        words = pc.rank(form, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
        order = np.lexsort((words, pos, text))
        form, pos, entry, text = form.take(pa.array(order)), pos[order], entry[order], text[order]
    rows, sizes = np.unique(text, return_counts=True)
    r = _flat_readings(whole(entries["readings"]), len(tags))
    starts, counts = np.append(r.starts, 0)[entry], np.append(r.counts, 0)[entry]
    chosen = best_path(starts, counts, r.tags, r.scores, r.missing, sizes, follows, block)
    # The readings of a form have different tags; the one that was chosen has the lemma.
    at = np.full(len(entry), -1, np.int64)
    for k in range(counts.max(initial=0)):
        own = np.flatnonzero(counts > k)
        own = own[r.tags[starts[own] + k] == chosen[own]]
        at[own] = starts[own] + k
    lemma = r.flat.field(r.flat.type.get_field_index("lemma")).take(pa.array(at, mask=at < 0))
    upos = pa.array(tags, pa.string()).take(pa.array(chosen, mask=chosen < 0))
    found = found_lists(sizes, pos, form, lemma, upos)
    return pa.table({"key": docs["key"].take(pa.array(rows)), "lang": docs["lang"].take(pa.array(rows)), "found": found})


def best_tags(readings: Column, model: TagModel) -> Column:
    """The number of the best tag for each token, null for a token without readings.

    ``readings`` is an array with an array of (tag, score, …) for each token, by tag.
    """
    follows, block = np.array(model.follows, np.int64), BLOCK

    @F.arrow_udf("array<int>")
    def decoded(texts: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False)
        r = _flat_readings(texts.flatten(), len(follows) - 1)
        tags = best_path(r.starts, r.counts, r.tags, r.scores, r.missing, sizes.astype(np.int64), follows, block)
        ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
        # A null where a list starts makes the list null.
        ends = pa.array(ends, mask=np.append(texts.is_null().to_numpy(zero_copy_only=False), False))
        return pa.ListArray.from_arrays(ends, pa.array(tags, pa.int32(), mask=tags < 0))

    return decoded(readings)


@dataclass(frozen=True)
class _Readings:
    """Lists of readings (tag, score, …), one after the other."""

    counts: np.ndarray
    starts: np.ndarray
    tags: np.ndarray
    scores: np.ndarray
    missing: np.ndarray
    flat: pa.StructArray


def _flat_readings(lists: pa.Array, edge: int) -> _Readings:
    flat = lists.flatten()
    tags, scores = (flat.field(flat.type.get_field_index(name)) for name in ("tag", "score"))
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    missing = scores.is_null().to_numpy(zero_copy_only=False)
    tags, scores = pc.fill_null(tags, edge).to_numpy().astype(np.int64), pc.fill_null(scores, 0).to_numpy()
    return _Readings(counts, np.cumsum(counts) - counts, tags, scores, missing, flat)


# Lemmas of forms that are not listed

# Letters of an ending that a rule looks at, and entries that have to agree with it.
LONGEST_SUFFIX = 5
LEAST_SUPPORT = 3
# Letters that a form keeps.
LEAST_STEM = 2


def _endings(form: Column, longest: int) -> Column:
    """The endings of a form, with the part that stays long enough."""
    most = F.least(F.lit(longest), F.length(form) - LEAST_STEM)
    lengths = F.when(most >= 1, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>"))
    return F.transform(lengths, lambda n: F.right(form, n))


def suffix_rules(
    lexicon: DataFrame, longest: int = LONGEST_SUFFIX, least_support: int = LEAST_SUPPORT
) -> DataFrame:
    """(lang, ending, cut, added, n): for each ending the change that most forms with it have.

    A change cuts ``cut`` letters from the end and adds ``added``. It is counted for every ending of a form that is at
    least as long as what it cuts. Equal counts go to the shorter cut, then to the first addition in sort order.
    """
    entries = lexicon.select("lang", F.lower("form").alias("form"), F.lower("lemma").alias("lemma")).dropna().distinct()
    shorter = F.least(F.length("form"), F.length("lemma"))
    same = F.size(
        F.filter(
            F.sequence(F.lit(0), shorter),
            lambda i: (i > 0) & (F.substr(F.col("form"), F.lit(1), i) == F.substr(F.col("lemma"), F.lit(1), i)),
        )
    )
    changed = entries.select(
        "lang",
        "form",
        (F.length("form") - same).alias("cut"),
        F.substr(F.col("lemma"), same + 1, F.length("lemma")).alias("added"),
    )
    counted = changed.select("lang", "cut", "added", F.explode(_endings(F.col("form"), longest)).alias("ending"))
    counted = counted.where(F.length("ending") >= F.col("cut")).groupBy("lang", "ending", "cut", "added").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), "cut", "added")).alias("best")
    rules = counted.groupBy("lang", "ending").agg(best)
    rules = rules.select("lang", "ending", "best.cut", "best.added", (-F.col("best.n")).alias("n"))
    return rules.where(F.col("n") >= least_support)


def with_guesses(docs: DataFrame, tokens: str, lang: Column, lexicon: DataFrame) -> DataFrame:
    """The lexicon, and a row without a part of speech for each form of the corpus that it does not list."""
    listed = lexicon.dropna(subset=["lang", "form"]).select("lang", F.lower("form").alias("form")).distinct()
    said = explode_each(docs, [lang.alias("lang")], F.col(tokens), "form").select("lang", F.lower("form").alias("form")).distinct()
    guessed = guess_lemmas(said.join(listed, ["lang", "form"], "left_anti"), suffix_rules(lexicon))
    rows = guessed.where("ending IS NOT NULL").select("lang", "form", "lemma", F.lit(None).cast("string").alias("pos"))
    return written(lexicon.unionByName(rows, allowMissingColumns=True), "lexicon")


def guess_lemmas(forms: DataFrame, rules: DataFrame, longest: int = LONGEST_SUFFIX) -> DataFrame:
    """(lang, form, lemma, ending): lemmas of the distinct forms (lang, form) by the rule with the longest ending.

    A form that no rule fits is its own lemma, and its ending is null. Work goes with the vocabulary, not with the texts.
    """
    forms = forms.select("lang", F.lower("form").alias("form")).dropna().distinct()
    asked = forms.select("lang", "form", F.explode_outer(_endings(F.col("form"), longest)).alias("ending"))
    found = asked.join(broadcast_if_small(rules), ["lang", "ending"], "left")
    rule = F.struct(F.length("ending").alias("size"), "ending", "cut", "added")
    longest_rule = F.max(F.when(F.col("cut").isNotNull(), rule)).alias("rule")
    guessed = found.groupBy("lang", "form").agg(longest_rule)
    stem = F.substr(F.col("form"), F.lit(1), F.length("form") - F.col("rule.cut"))
    lemma = F.coalesce(F.concat(stem, F.col("rule.added")), F.col("form"))
    return guessed.select("lang", "form", lemma.alias("lemma"), F.col("rule.ending").alias("ending"))
