import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import line_dedup
from corpusprep.llm.queries import QUERIES
from tests.llm.frames import no_documents, odd_documents, without_copied_lines


def test_bins_agree_with_the_probability_of_the_similarity():
    draw = random.Random(1)
    for size in (8, 20, 60, 300):
        seen, real = [], []
        for _ in range(150):
            a = "".join(draw.choice("abcdefghijk ") for _ in range(size))
            b = a[: draw.randint(size - size // 4, size)]
            x, y = line_dedup._shingles(a), line_dedup._shingles(b)
            s = line_dedup.sketches([a, "other line", b])
            seen.append((s[0] == s[2]).mean())
            real.append(len(x & y) / len(x | y))
        assert abs(np.mean(seen) - np.mean(real)) < 0.03


def test_sketches_do_not_depend_on_the_lines_beside():
    lines = ["a", "", "short", "a longer line of text " * 9, "éß🙂 x"]
    alone = np.concatenate([line_dedup.sketches([x]) for x in lines])
    assert (line_dedup.sketches(lines) == alone).all()


def variants(n, seed=5):
    """Documents with copies, near copies and chains of near copies."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9))) for _ in range(300)]
    base = [" ".join(draw.choice(words) for _ in range(30)) for _ in range(12)]
    docs = []
    for i in range(n):
        lines = []
        for _ in range(draw.randint(1, 5)):
            tokens = draw.choice(base).split()
            for _ in range(draw.choice([0, 0, 1, 2, 3])):
                tokens[draw.randrange(len(tokens))] = draw.choice(words)
            lines.append(draw.choice(["x.", "", " ", " ".join(tokens), " ".join(tokens), " ".join(tokens)]))
        docs.append((i, "\n".join(lines)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    docs = variants(120, seed)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = dict((r["doc_id"], r["text"]) for r in line_dedup.drop_copies(df).collect())
    assert got == dict(without_copied_lines(docs))


@pytest.mark.parametrize("block", [3, 512])
def test_members_of_other_groups_with_a_shared_key_are_compared(spark, monkeypatch, block):
    """With one key for all lines, everything hangs on the two rounds of verification."""
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", block)
    monkeypatch.setattr(line_dedup, "band_keys", lambda rows: np.ones((len(rows), line_dedup.BANDS), np.int64))
    docs = variants(25, 3)
    schema = "id bigint, text_hash bigint, pos int, line bigint, tail bigint, keys array<bigint>"
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    frames = df.selectExpr("doc_id AS id", "xxhash64(text) AS text_hash", "text")
    rows = [r for b in line_dedup._sketch_lines(frames.toArrow().to_batches()) for r in b.to_pylist()]
    sketched = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    roots = {r["node"]: r["root"] for r in line_dedup.line_links(sketched, df, "text", 0.8).collect()}
    lines = {r["line"]: docs[r["id"]][1].split("\n")[r["pos"]] for r in rows}
    sets = {h: line_dedup._shingles(x) for h, x in lines.items()}
    from tests.llm.frames import components

    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    expected = components(sets, links)
    assert {h: roots.get(h, h) for h in sets} == expected


def test_odd_documents(spark):
    docs = odd_documents(spark)
    out = line_dedup.drop_copies(docs, counts=True)
    assert out.columns == [*docs.columns, "n_lines", "n_copies"]
    rows = out.collect()
    assert len(rows) == docs.count()
    text = {}
    for r in rows:
        text.setdefault(r["doc_id"], []).append(r["text"])
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert text[3] == [None] and text[4] == [""] and text[5] == [" \t\n "] and text[6] == [given[6]]
    assert text[2] == ["", ""]  # every line is one of document 1, or of the row without an id
    prose = given[1].split("\n")
    assert text[1] == [prose[1]] and prose[0] in text[None]  # a null id sorts first
    assert len(text[7]) == 2 and all(text[7])
    assert {(r["n_lines"], r["n_copies"]) for r in rows if r["doc_id"] == 2} == {(2, 2)}
    assert {(r["n_lines"], r["n_copies"]) for r in rows if r["doc_id"] in (3, 4, 5)} == {(0, 0)}
    assert line_dedup.drop_copies(no_documents(spark)).count() == 0


def test_a_line_in_every_document_is_one_row_of_each_task(spark):
    docs = spark.range(0, 3000, 1, 6).select(F.col("id").alias("doc_id"), F.lit("the same line in all of them").alias("text"))
    out = line_dedup.drop_copies(docs)
    assert out.where("text <> ''").collect()[0]["doc_id"] == 0 and out.where("text = ''").count() == 2999


def test_query(spark, data):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    got = {r["doc_id"]: r["text"] for r in QUERIES["op1_line_dedup"](spark, data).collect()}
    assert got == dict(without_copied_lines(docs))


def test_outlines_never_rule_out_similar_lines():
    draw = random.Random(4)
    ruled_out = 0
    for _ in range(300):
        a = "".join(draw.choice("abcd ") for _ in range(draw.randint(7, 400)))
        b = "".join(draw.choice("abcd ") if draw.random() < draw.choice([0, 0.01, 0.1]) else c for c in a)
        x, y = line_dedup._shingles(a), line_dedup._shingles(b)
        outlines = line_dedup.outlines([a, b])
        assert [n for n, _ in outlines] == [len(x), len(y)]
        possible = line_dedup.may_be_similar(*outlines)
        assert possible or not line_dedup.similar(x, y)
        ruled_out += not possible
    assert ruled_out > 50


def test_a_stray_line_among_copies_is_dealt_out_in_proportion(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", 100)
    rows = [(1, i, 0) for i in range(3_000)] + [(1, 9_000, 9_000)] + [(2, i, i % 7) for i in range(40)] + [(3, 1, 5), (3, 2, 5)]
    dealt = line_dedup.deal_out(spark.createDataFrame(rows, "key bigint, line bigint, root bigint")).collect()
    assert sum(r["key"] == 1 for r in dealt) <= 3_000 + 30 + 1
    pairs = {}
    for r in dealt:
        pairs.setdefault((r["key"], r["i"], r["j"]), []).append((r["own"], r["line"], r["root"]))
    met = set()
    for (key, i, j), lines in pairs.items():
        met |= {(key, *sorted((x[1], y[1]))) for x in lines for y in lines if x[2] != y[2] and {x[0], y[0]} == {i, j}}
    assert met == {(k, a, b) for k, a, r in rows for q, b, s in rows if k == q and r != s and a < b}


def test_results_do_not_depend_on_broadcasts(spark, data, monkeypatch):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").where("doc_id < 60")
    usual = sorted(map(tuple, line_dedup.drop_copies(docs, counts=True).collect()))
    monkeypatch.setattr(line_dedup, "broadcast_if_small", lambda df, *_, **__: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, line_dedup.drop_copies(docs, counts=True).collect())) == usual
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
