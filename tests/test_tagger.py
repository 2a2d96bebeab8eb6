import math
import random
import re
from itertools import product

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import lemma, tagger
from tests.conftest import plan_text

TAGS = ["ADJ", "NOUN", "VERB"]


def plain_score(model, readings, tags):
    """Score of one way to tag a text; tokens without a reading have the edge beside them, as have both ends."""
    edge = len(model.tags)
    beside = [edge, *[edge if t is None else t for t in tags], edge]
    total = sum(model.follows[a][b] for a, b in zip(beside, beside[1:]))
    return total + sum(dict(r)[t] for r, t in zip(readings, tags) if t is not None)


def every_path(model, readings):
    """The best path of all; of equal ones the one whose tags sort first, seen from the last token."""
    options = [[t for t, _ in r] or [None] for r in readings]
    paths = list(product(*options))
    best = max(plain_score(model, readings, p) for p in paths)
    return min((p for p in paths if plain_score(model, readings, p) == best), key=lambda p: [(-1 if t is None else t) for t in p[::-1]])


def run(spark, model, texts):
    kind = "array<array<struct<tag:int,score:bigint,lemma:string>>>"
    rows = [(i, [[(t, s, "x") for t, s in r] for r in text]) for i, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, f"id int, readings {kind}")
    found = frame.select("id", tagger.best_tags(F.col("readings"), model).alias("tags")).collect()
    return {r["id"]: r["tags"] for r in found}


def random_model(rnd):
    follows = [[-rnd.randrange(1, 9) for _ in range(len(TAGS) + 1)] for _ in range(len(TAGS) + 1)]
    return tagger.TagModel(TAGS, follows, None)


def random_text(rnd, n):
    return [sorted((t, -rnd.randrange(1, 6)) for t in rnd.sample(range(3), rnd.choice((0, 1, 2, 2, 3, 3)))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_best_path_of_all_paths(spark, seed):
    rnd = random.Random(seed)
    model = random_model(rnd)
    texts = [random_text(rnd, rnd.randrange(0, 8)) for _ in range(150)]
    found = run(spark, model, texts)
    for i, text in enumerate(texts):
        best = every_path(model, text)
        assert plain_score(model, text, found[i]) == plain_score(model, text, best)
        assert all((t is None) == (not r) and (t is None or t in dict(r)) for t, r in zip(found[i], text))


def test_blocks_and_long_runs(spark, monkeypatch):
    rnd = random.Random(3)
    model = random_model(rnd)
    text = [sorted((t, -rnd.randrange(1, 6)) for t in rnd.sample(range(3), 2)) for _ in range(3_000)]
    whole = run(spark, model, [text])[0]
    monkeypatch.setattr(tagger, "BLOCK", 7)
    assert run(spark, model, [text])[0] == whole
    # The ordinary algorithm, on numbers.
    edge = len(TAGS)
    state = {t: model.follows[edge][t] + s for t, s in text[0]}
    for r in text[1:]:
        state = {t: s + max(v + model.follows[p][t] for p, v in state.items()) for t, s in r}
    assert plain_score(model, text, whole) == max(v + model.follows[t][edge] for t, v in state.items())


LEXICON = [
    ("en", "the", "the", "DET"), ("en", "a", "a", "DET"), ("en", "dogs", "dog", "NOUN"), ("en", "cats", "cat", "NOUN"),
    ("en", "eat", "eat", "VERB"), ("en", "see", "see", "VERB"), ("en", "run", "run", "VERB"), ("en", "run", "run", "NOUN"),
    ("en", "saw", "see", "VERB"), ("en", "saw", "saw", "NOUN"),
]
LEXICON_SCHEMA = "lang string, form string, lemma string, pos string"


def test_context_decides(spark):
    lexicon = spark.createDataFrame(LEXICON, LEXICON_SCHEMA)
    corpus = [(i, "en", t.split()) for i, t in enumerate(["the dogs eat the cats", "a cats see the dogs", "the cats eat a dogs"] * 5)]
    docs = spark.createDataFrame(corpus, "id bigint, lang string, tokens array<string>")
    model = tagger.train_tagger(docs, "tokens", lexicon, F.col("lang"), "id")
    assert model.tags == ["DET", "NOUN", "VERB"]
    asked = [(1, "en", ["Dogs", "saw", "the", "saw"]), (2, "en", "the run eat zzz a run".split()), (3, "de", ["run"]), (4, "en", []), (5, "en", None)]
    asked = spark.createDataFrame(asked, "id bigint, lang string, tokens array<string>")
    found = {r["id"]: [(t["form"], t["lemma"], t["upos"]) for t in r["tagged"]] for r in tagger.tag_tokens(asked, "tokens", model, F.col("lang"), "id").collect()}
    assert found == {
        1: [("Dogs", "dog", "NOUN"), ("saw", "see", "VERB"), ("the", "the", "DET"), ("saw", "saw", "NOUN")],
        2: [("the", "the", "DET"), ("run", "run", "NOUN"), ("eat", "eat", "VERB"), ("zzz", "zzz", None), ("a", "a", "DET"), ("run", "run", "NOUN")],
        3: [("run", "run", None)],
    }


def test_pairs_of_tags_against_a_loop(spark):
    lexicon = spark.createDataFrame(LEXICON, LEXICON_SCHEMA)
    sure = {"the": "DET", "a": "DET", "dogs": "NOUN", "cats": "NOUN", "eat": "VERB", "see": "VERB"}
    rnd = random.Random(4)
    texts = [[rnd.choice(["the", "The", "dogs", "eat", "run", "saw", "zzz"]) for _ in range(rnd.randrange(9))] for _ in range(80)]
    docs = spark.createDataFrame([(i, "en", t) for i, t in enumerate(texts)], "id bigint, lang string, tokens array<string>")
    counts = {}
    for text in texts:
        tags = ["", *[sure.get(w.lower()) for w in text], ""] if text else []
        for pair in zip(tags, tags[1:]):
            if None not in pair:
                counts[pair] = counts.get(pair, 0) + 1
    found = tagger.tag_pairs(docs, "tokens", F.col("lang"), tagger.form_readings(lexicon), "id").collect()
    assert {(r["tag"], r["next"]): r["n"] for r in found} == counts


def test_too_many_tags_are_refused(spark):
    rows = [("en", f"f{i}", "x", f"T{i}") for i in range(tagger.MAX_TAGS + 1)]
    docs = spark.createDataFrame([(1, "en", ["f1"])], "id bigint, lang string, tokens array<string>")
    with pytest.raises(ValueError, match="parts of speech"):
        tagger.train_tagger(docs, "tokens", spark.createDataFrame(rows, LEXICON_SCHEMA), F.col("lang"), "id")


def plain_rules(entries, longest=5, support=3, stem=2):
    counts = {}
    for lang, form, lemma in {(a, b.lower(), c.lower()) for a, b, c, *_ in entries}:
        same = 0
        while same < min(len(form), len(lemma)) and form[same] == lemma[same]:
            same += 1
        cut, added = len(form) - same, lemma[same:]
        for n in range(1, min(longest, len(form) - stem) + 1):
            if n >= cut:
                by = counts.setdefault((lang, form[-n:]), {})
                by[cut, added] = by.get((cut, added), 0) + 1
    best = {k: min(((-n, *c) for c, n in by.items())) for k, by in counts.items()}
    return {k: (c, a, -n) for k, (n, c, a) in best.items() if -n >= support}


def test_suffix_rules_and_guesses_against_plain_versions(spark):
    rnd = random.Random(5)
    stems = ["".join(rnd.choices("abcdeé", k=rnd.randrange(1, 6))) for _ in range(300)]
    endings = [("ing", ""), ("ies", "y"), ("s", ""), ("ed", "e"), ("en", "en"), ("", "")]
    entries = [("en" if i % 3 else "de", s + e, s + l, "X") for i, s in enumerate(stems) for e, l in [rnd.choice(endings)]]
    rules = tagger.suffix_rules(spark.createDataFrame(entries, LEXICON_SCHEMA))
    expected = plain_rules(entries)
    assert {(r["lang"], r["ending"]): (r["cut"], r["added"], r["n"]) for r in rules.collect()} == expected
    forms = [("en", s + e) for s in ("zu", "z", "zabba", "") for e, _ in endings] + [("fr", "zubing"), ("de", "Quies"), (None, "x"), ("en", None)]
    found = tagger.guess_lemmas(spark.createDataFrame(forms, "lang string, form string"), rules).collect()
    guesses = {}
    for lang, form in forms:
        if lang is None or form is None:
            continue
        form = form.lower()
        fits = [form[-n:] for n in range(1, min(5, len(form) - 2) + 1) if (lang, form[-n:]) in expected]
        if fits:
            cut, added, _ = expected[lang, max(fits, key=len)]
            guesses[lang, form] = (form[: len(form) - cut] + added, max(fits, key=len))
        else:
            guesses[lang, form] = (form, None)
    assert {(r["lang"], r["form"]): (r["lemma"], r["ending"]) for r in found} == guesses


def test_lemmas_of_a_text_by_context_and_by_rules(spark):
    lexicon = spark.createDataFrame([*LEXICON, *[("en", f"b{v}zzes", f"b{v}z", "NOUN") for v in "aeiou"]], LEXICON_SCHEMA)
    rows = [(1, "en", ["Dogs", "saw", "the", "saw"]), (2, "en", ["the", "jazzes", "run"]), (3, "en", None), (4, "en", [])]
    docs = spark.createDataFrame(rows, "id bigint, lang string, tokens array<string>")
    corpus = [(i, "en", t.split()) for i, t in enumerate(["the dogs eat the cats", "a cats see the dogs"] * 5)]
    model = tagger.train_tagger(spark.createDataFrame(corpus, docs.schema), "tokens", lexicon, F.col("lang"), "id")
    found = lemma.content_lemmas(docs, "tokens", F.col("lang"), lexicon=lexicon, keep_pos=("NOUN",), keep_unlisted=False, model=model, key="id")
    assert {r["id"]: r["tokens"] for r in found.collect()} == {1: ["dog", "saw"], 2: ["run"], 3: None, 4: []}
    more = tagger.with_guesses(docs, "tokens", F.col("lang"), lexicon)
    found = lemma.content_lemmas(docs, "tokens", F.col("lang"), lexicon=more, key="id")
    assert {r["id"]: r["tokens"] for r in found.collect()}[2] == ["jaz", "run"]


def test_rows_of_one_key_and_odd_tokens(spark):
    lexicon = spark.createDataFrame(LEXICON, LEXICON_SCHEMA)
    schema = "id bigint, lang string, tokens array<string>"
    rows = [(1, "en", ["run", "dogs"]), (1, "en", ["eat", "a", "cats"]), (2, None, ["run"]), (None, "en", ["the", None, "", "naïve", "RUN"])]
    docs = spark.createDataFrame(rows, schema)
    pairs = {(r["tag"], r["next"]): r["n"] for r in tagger.tag_pairs(docs, "tokens", F.col("lang"), tagger.form_readings(lexicon), "id").collect()}
    # Rows with the key 1 read VERB, NOUN, NOUN: the greater tag at each place.
    assert pairs == {("", "VERB"): 1, ("VERB", "NOUN"): 1, ("NOUN", "NOUN"): 1, ("NOUN", ""): 1, ("", "DET"): 1}
    model = tagger.train_tagger(docs, "tokens", lexicon, F.col("lang"), "id")
    found = {(r["id"], r["lang"]): [(t["pos"], t["form"], t["lemma"]) for t in r["tagged"]] for r in tagger.tag_tokens(docs, "tokens", model, F.col("lang"), "id").collect()}
    assert found == {
        (1, "en"): [(0, "eat", "eat"), (0, "run", "run"), (1, "a", "a"), (1, "dogs", "dog"), (2, "cats", "cat")],
        (2, None): [(0, "run", "run")],
        (None, "en"): [(0, "the", "the"), (1, None, None), (2, "", ""), (3, "naïve", "naïve"), (4, "RUN", "run")],
    }


def test_tokens_do_not_move_one_by_one(spark):
    """What is shuffled for the readings are the distinct forms of chunks, and documents as they are."""
    docs = spark.createDataFrame([(i, "en", ["run", "dogs"] * 200) for i in range(300)], "id bigint, lang string, tokens array<string>")
    model = tagger.train_tagger(docs, "tokens", spark.createDataFrame(LEXICON, LEXICON_SCHEMA), F.col("lang"), "id")
    tagged = tagger.tag_tokens(docs, "tokens", model, F.col("lang"), "id")
    plan = plan_text(tagged)
    assert not re.search(r"\(\d+\) (Exchange|Sort)\b[^\n]*\nInput \[\d+\]: \[[^\]]*\b(pos|key)#[^\]]*\bform#", plan)
    assert tagged.count() == 300
