import itertools

import numpy as np
import pytest

from corpusprep.llm import quality_rules as qr
from corpusprep.llm.queries import QUERIES
from tests.llm.frames import PROSE, no_documents, odd_documents


def plain_counts(text):
    text = text or ""
    table = {9: 32, 10: 32, 11: 32, 12: 32, 13: 32}
    words = [w for w in text.translate(table).split(" ") if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.translate(table).strip(" "):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


TEXTS = [
    None, "", " \n\t", "a b a b a b", "one two three\none two three\n\n \none two three", "a|b #x é\x1c\x0b🙂 <>&", "x\r\nx\r\n\nx",
    (PROSE + "\n") * 3, PROSE + " " + PROSE + " words that come once " + " ".join(map(str, range(60))), "!\n?\n",
]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    assert qr.judge(text, qr.PRIOR, 0.5)[:6] == plain_counts(text)


def test_viterbi_finds_the_best_labelling():
    rng = np.random.default_rng(1)
    for _ in range(200):
        scores, stay = rng.normal(size=rng.integers(1, 8)).tolist(), float(rng.normal())

        def total(labels):
            return sum(s * y for s, y in zip(scores, labels)) + stay * sum(a == b for a, b in zip(labels, labels[1:]))

        best = max(map(total, itertools.product((0, 1), repeat=len(scores))))
        assert total(qr.viterbi(scores, stay)) == pytest.approx(best)


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(2)
    x, y = rng.random((3, 4, 2)), rng.integers(0, 2, (3, 4)).astype(float)
    real = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 0, 0, 0]], bool)

    def likelihood(theta):
        out = 0.0
        for xs, ys, rs in zip(x, y, real):
            n = rs.sum()
            score = lambda z: sum((xs[t] @ theta[:2]) * z[t] for t in range(n)) + theta[2] * sum(z[t] == z[t + 1] for t in range(n - 1))  # noqa: E731, B023
            out += score(ys) - np.logaddexp.reduce([score(z) for z in itertools.product((0, 1), repeat=int(n))])
        return out

    theta = np.array([0.3, -0.7, 0.5])
    by_feature, by_stay = qr.sequence_gradient(x, y, real, theta[:2], theta[2])
    steps = np.eye(3) * 1e-5
    numeric = [(likelihood(theta + s) - likelihood(theta - s)) / 2e-5 for s in steps]
    assert [*by_feature, by_stay] == pytest.approx(numeric, abs=1e-6)


def test_without_labels_of_both_kinds_the_weights_are_the_prior(spark):
    assert qr.fit_weights([]) == qr.PRIOR
    assert qr.fit_weights([([[1.0] * len(qr.FEATURES)], 1)]) == qr.PRIOR
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert qr.train(odd_documents(spark), labels) == qr.PRIOR


def test_trained_weights_split_documents_that_mix_both(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    weights = qr.train(docs, labels)
    assert weights[1] == qr.PRIOR_STAY and weights[0] != qr.PRIOR[0]
    rows = docs.join(labels.select("doc_id", "quality"), "doc_id").where("length(text) > 200").orderBy("doc_id").collect()
    good, bad = ([r["text"].replace("\n", " ") for r in rows if r["quality"] == q][:10] for q in (1, 0))
    assert len(good) == len(bad) == 10
    split = 0
    for x, y in zip(good, bad):
        for lines, marks in (([x, x + " .", y, y + " !"], "ccbb"), ([y, x, x + " ."], "bcc")):
            split += qr.judge("\n".join(lines), weights, 0.5)[6] == marks
    assert split >= 18, split


def test_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None), (6, 0), (2, 1)], "doc_id bigint, quality int")
    weights = qr.train(docs, labels)
    rows = qr.apply_rules(docs, weights=weights).collect()
    assert len(rows) == docs.count()
    for row in rows:
        got = row["quality_rules"]
        assert tuple(got)[:6] == plain_counts(row["text"])
        assert not (got["base_failed"] and got["kept"])
    kept = qr.keep_good(docs, weights=weights)
    assert kept.columns == docs.columns
    assert qr.apply_rules(no_documents(spark)).count() == 0 and qr.keep_good(no_documents(spark)).count() == 0


def test_query_keeps_good_documents_and_rejects_others(spark, data):
    found = QUERIES["op3_quality_rules"](spark, data)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = found.join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == plain_counts(row["text"])
    marks = spark.read.parquet(f"{data}/labels.parquet").join(found.where("NOT base_failed"), "doc_id").collect()
    assert marks and all(r["kept"] == (r["quality"] == 1) for r in marks)
