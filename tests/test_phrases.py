import random
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusprep.operators import phrases as ph


def frame(spark, docs):
    rows = list(enumerate(docs))
    return spark.createDataFrame(rows, "id bigint, tokens array<string>")


def merged(spark, docs, pairs):
    table = spark.createDataFrame([tuple(p) for p in pairs], "w string, nx string")
    out = ph.merge_phrases(frame(spark, docs), table, key="id").collect()
    return {r["id"]: r["lemmas"] for r in out}


def one_by_one(tokens, pairs):
    """Merging as it is described: go along, join a pair, continue after it."""
    out, i = [], 0
    while i < len(tokens):
        if tuple(tokens[i : i + 2]) in pairs:
            out.append("_".join(tokens[i : i + 2]))
            i += 2
        else:
            out.append(tokens[i])
            i += 1
    return " ".join(out)


def test_runs_of_two_three_and_four_hits(spark):
    pairs = {("a", "b"), ("b", "c"), ("c", "d"), ("d", "e")}
    docs = [[], ["x"], ["a", "b"], list("abc"), list("abcd"), list("abcde"), list("xabcdx"), list("aab")]
    assert merged(spark, docs, pairs) == {i: one_by_one(d, pairs) for i, d in enumerate(docs)}
    assert merged(spark, docs, pairs)[3] == "a_b c"


def test_repeated_token_pairs(spark):
    docs = [["a"] * n for n in range(1, 8)]
    assert merged(spark, docs, {("a", "a")}) == {i: one_by_one(d, {("a", "a")}) for i, d in enumerate(docs)}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "ñu", "d$1"]), max_size=30), min_size=20, max_size=60), st.data())
def test_merging_equals_a_sequential_loop(spark, docs, data):
    names = ["a", "b", "c", "ñu", "d$1"]
    pairs = data.draw(st.sets(st.tuples(st.sampled_from(names), st.sampled_from(names)), min_size=1, max_size=8))
    assert merged(spark, docs, pairs) == {i: one_by_one(d, pairs) for i, d in enumerate(docs)}


def test_join_without_broadcast_gives_the_same(spark, monkeypatch):
    rng = random.Random(1)
    docs = [[rng.choice("abcd") for _ in range(rng.randrange(40))] for _ in range(100)]
    pairs = {("a", "b"), ("c", "c"), ("b", "a")}
    usual = merged(spark, docs, pairs)
    monkeypatch.setattr(ph, "broadcast_if_small", lambda df, *_, **__: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert merged(spark, docs, pairs) == usual
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def brute_scores(docs, min_count, threshold):
    counts = {}
    for d in docs:
        for key in d + ["_".join(p) for p in zip(d, d[1:])]:
            counts[key] = counts.get(key, 0) + 1
    found = {}
    for d in docs:
        for a, b in zip(d, d[1:]):
            score = (counts[f"{a}_{b}"] - min_count) / (counts[a] * counts[b]) * len(counts)
            if score > threshold:
                found[a, b] = score
    return found


@pytest.mark.parametrize("odd_token", ["a_b", "ab"])
@pytest.mark.parametrize("min_count,threshold", [(2, 0.5), (1, 1.0), (2, -1.0)])
def test_scores_against_brute_force(spark, min_count, threshold, odd_token):
    rng = random.Random(7)
    docs = [[rng.choice(["a", "b", "c", "d", odd_token, "e"]) for _ in range(rng.randrange(30))] for _ in range(60)]
    docs += [["new", "york", "is"]] * 5
    learned = ph.learn_phrases(frame(spark, docs), "tokens", min_count, threshold).collect()
    expected = brute_scores(docs, min_count, threshold)
    assert {(r["w"], r["nx"]) for r in learned} == set(expected)
    for r in learned:
        assert r["score"] == pytest.approx(expected[r["w"], r["nx"]])


def test_a_score_equal_to_the_threshold_is_no_phrase(spark):
    docs = [["a", "b"]] * 4
    # Three dictionary entries: (4 - 2) / (4 * 4) * 3
    exact = 0.375
    assert ph.learn_phrases(frame(spark, docs), "tokens", 2, exact).count() == 0
    assert ph.learn_phrases(frame(spark, docs), "tokens", 2, exact - 1e-9).count() == 1


def test_a_token_that_looks_like_a_pair_shares_its_entry(spark):
    docs = [["a", "b"], ["a_b"], ["a_b", "a", "b"]]
    follows = ph.follow_counts(frame(spark, docs))
    counts = {r["key"]: r["n"] for r in ph.vocabulary(follows).collect()}
    assert counts == {"a": 2, "b": 2, "a_b": 4, "a_b_a": 1}


def test_scores_of_very_large_counts(spark):
    """Products of counts go beyond a bigint."""
    follows = spark.createDataFrame([("a", "b", 4 * 10**12), ("b", None, 4 * 10**12)], "w string, nx string, n bigint")
    scored = ph.score_phrases(ph.bigram_counts(follows), ph.unigram_counts(follows), 3, 2, 0.0).collect()
    assert scored[0]["score"] == pytest.approx(3 / (4 * 10**12))


def test_documents_with_equal_ids_stay_apart(spark):
    docs = spark.createDataFrame([(1, ["a", "b"]), (1, ["b", "a"]), (1, [])], "id bigint, tokens array<string>")
    table = spark.createDataFrame([("a", "b")], "w string, nx string")
    out = ph.merge_phrases(docs, table).select("id", "lemmas").collect()
    assert sorted(r["lemmas"] for r in out) == ["", "a_b", "b a"]


def test_counting_shuffles_partial_counts_only(spark):
    from tests.conftest import plan_text

    text = plan_text(ph.follow_counts(frame(spark, [["a"]])))
    assert "partial_count" in text
    assert "SinglePartition" not in text and "Window" not in text


def test_any_token_may_stand_beside_a_phrase(spark):
    tokens = ["", "a\u0001", "b", "c", "", "\u0002", "b", "c", "b", "c"]
    docs = spark.createDataFrame([(1, tokens), (2, [""]), (3, []), (4, None)], "id int, tokens array<string>")
    table = spark.createDataFrame([("b", "c"), ("c", "b")], "w string, nx string")
    out = {r["id"]: r["lemmas"] for r in ph.merge_phrases(docs, table, key="id").collect()}
    assert out[1] == " ".join(["", "a\u0001", "b_c", "", "\u0002", "b_c", "b_c"])
    assert (out[2], out[3]) == ("", "")


def test_merging_takes_time_in_proportion_to_the_hits(spark):
    """160,000 hits in one text, in runs and alone."""
    tokens = ["a"] * 80_001 + ["x"] + ["a", "b"] * 80_000
    docs = spark.createDataFrame([(0, tokens)], "id bigint, tokens array<string>")
    pairs = {("a", "a"), ("a", "b")}
    table = spark.createDataFrame(sorted(pairs), "w string, nx string")
    began = time.perf_counter()
    out = ph.merge_phrases(docs, table, key="id").first()["lemmas"]
    assert time.perf_counter() - began < 20
    assert out == one_by_one(tokens, pairs)


def test_dictionary_size_from_sketches(spark):
    ten = F.sequence(F.lit(0), F.lit(9))
    words = F.transform(ten, lambda i: F.concat(F.lit("w"), (F.col("id") * 7 + i * i) % 6_000))
    docs = spark.range(4_000).select(words.alias("tokens"))
    halves = docs.randomSplit([0.5, 0.5], 1)
    exact = ph.vocabulary(ph.follow_counts(docs)).count()
    sketches = [ph.vocabulary_sketch(ph.follow_counts(x)) for x in (*halves, docs)]
    together = ph.vocabulary_size(sketches[0].unionAll(sketches[1]).unionAll(sketches[2]))
    assert abs(together - exact) <= 0.04 * exact and exact > 20_000
    assert ph.vocabulary_size(ph.vocabulary_sketch(ph.follow_counts(docs.where("false")))) == 0
    follows = ph.written(ph.follow_counts(docs), "follows")
    usual = ph.learn_from_counts(follows, 0, 0.0)
    close = ph.learn_from_counts(follows, 0, 0.0, estimated_size=True)
    ratio = F.col("other") / F.col("score")
    both = usual.join(close.withColumnRenamed("score", "other"), ["w", "nx"])
    assert 0.96 <= both.agg(F.min(ratio)).first()[0] <= both.agg(F.max(ratio)).first()[0] <= 1.04


def test_a_sketch_takes_uncounted_pairs(spark):
    docs = spark.createDataFrame([(["a", "b", "a", "b"],), (["b"],), ([],), (None,)], "tokens array<string>")
    follows = ph.follows(docs)
    assert sorted(map(tuple, follows.collect()), key=str) == [("a", "b"), ("a", "b"), ("b", "a"), ("b", None), ("b", None)]
    assert ph.vocabulary_size(ph.vocabulary_sketch(follows)) == ph.vocabulary(ph.follow_counts(docs)).count() == 4


def test_rare_pairs_are_counted_but_not_written(spark, monkeypatch):
    """Pairs that cannot score are most of all pairs; only their number is needed."""
    docs = frame(spark, [["a", "b", f"c{i}", f"d{i}"] for i in range(40)] + [[], None])
    tables = {}

    def write(df, name, *args):
        table = written(df, name, *args)
        tables[name] = table.count()
        return table

    written = ph.written
    monkeypatch.setattr(ph, "written", write)
    learned = ph.learn_phrases(docs, threshold=1.0).collect()
    assert [(r["w"], r["nx"], r["n"], r["n_w"], r["n_nx"]) for r in learned] == [("a", "b", 40, 40, 40)]
    assert learned[0]["score"] == pytest.approx((40 - 2) / (40 * 40) * (82 + 81))
    assert tables == {"unigram_counts": 82, "frequent_pairs": 1, "phrases": 1}
