import hashlib
import random

import numpy as np
import pytest

from corpusprep.llm import decontaminate as dc
from corpusprep.llm.fm_index import FMIndex, suffix_array
from corpusprep.llm.queries import QUERIES
from tests.llm.frames import cut_words, hit_words, no_documents, odd_documents


def test_index_counts_and_locates_every_pattern():
    rng = np.random.default_rng(1)
    for _ in range(60):
        k = int(rng.choice([1, 2, 5, 40]))
        text = rng.integers(1, k + 1, rng.choice([1, 2, 5, 30, 200]))
        ended = np.append(text, 0)
        assert suffix_array(ended).tolist() == sorted(range(len(ended)), key=lambda i: ended[i:].tolist())
        index = FMIndex(text)
        patterns = list({tuple(text[i : i + n].tolist()) for i in range(len(text)) for n in (1, 2, 3, 4) if i + n <= len(text)})
        patterns += [(k + 5,), (1, k + 9), (0,)]
        rows = np.zeros((len(patterns), 4), np.int64)
        for row, p in zip(rows, patterns):
            row[4 - len(p) :] = p
        low, high = index.search(rows, np.array(list(map(len, patterns))))
        for p, a, b in zip(patterns, low, high):
            places = [i for i in range(len(text) - len(p) + 1) if tuple(text[i : i + len(p)].tolist()) == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == places


def test_search_against_every_place():
    draw = random.Random(2)
    for _ in range(100):
        words = draw.choice([list("ab"), list("abcdefgh"), ["é", "Ab", "aB", "x1"]])
        items = [(str(i), " ".join(draw.choices(words, k=draw.choice([0, 1, 3, 4, 6])))) for i in range(draw.choice([0, 1, 5]))]
        texts = [draw.choice([None, "", ", ".join(draw.choices([*words, "zz"], k=draw.choice([1, 5, 30])))]) for _ in range(8)]
        for text, (n, hit, found) in zip(texts, dc.Phrases(items, 4).search(texts)):
            assert (n, hit.tolist(), found) == hit_words(text, items, 4)


PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
ITEMS = [(1, PASSAGE), (2, "Short item"), (2, "short ITEM"), (None, "no id for these words"), (3, None), (4, ""), (10, PASSAGE.upper())]
TEXTS = [
    f"before {PASSAGE}, after",
    f"{PASSAGE} {PASSAGE}",
    "a SHORT-item here; no id? no id for these words",
    " ".join(PASSAGE.split()[:9]),
    " ".join(PASSAGE.split()[1:11]) + " and",
    None,
    "",
]


@pytest.mark.parametrize("block", [dc.BLOCK_BYTES, 40])
def test_results_do_not_depend_on_the_blocks(spark, block):
    docs = spark.createDataFrame(list(enumerate([*TEXTS, TEXTS[0]])), "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = {r["doc_id"]: r for r in dc.find_overlaps(docs, bench, max_block_bytes=block).collect()}
    clean = {r["doc_id"]: r["text"] for r in dc.remove_overlaps(docs, bench, max_block_bytes=block).collect()}
    assert len(rows) == len(clean) == len(TEXTS) + 1
    for i, text in enumerate([*TEXTS, TEXTS[0]]):
        n, hit, found = hit_words(text, ITEMS)
        got = rows[i]["overlap"]
        assert (got["n_words"], got["n_hit"]) == (n, len(hit))
        assert sorted(got["items"]) == [x for x in found if x != "None"]
        assert clean[i] == cut_words(text, hit)


@pytest.mark.parametrize("block", [dc.BLOCK_BYTES, 3])
def test_what_cutting_brings_together_is_cut_too(spark, block):
    docs = spark.createDataFrame([(1, "x a, a b b. y"), (2, "a c c b"), (3, "a b")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "a b"), (2, "c c")], "item_id bigint, text string")
    clean = {r["doc_id"]: r["text"].split() for r in dc.remove_overlaps(docs, bench, max_block_bytes=block).collect()}
    assert clean == {1: ["x", ".", "y"], 2: [], 3: []}


def test_odd_documents(spark):
    docs, bench = odd_documents(spark), spark.createDataFrame([(1, "an item that is nowhere")], "item_id bigint, text string")
    out = dc.remove_overlaps(docs, bench)
    assert set(out.columns) == set(docs.columns)  # its own column is called overlap, as one of theirs
    assert sorted(map(str, (r["text"] for r in out.collect()))) == sorted(map(str, (r["text"] for r in docs.collect())))
    several = dc.find_overlaps(docs, bench.unionAll(bench.selectExpr("2L", "'quick brown fox'")), max_block_bytes=8, out="o")
    assert several.columns == [*docs.columns, "o"]
    assert several.where("o.n_hit > 0").count() == 4
    none = bench.where("false")
    assert dc.find_overlaps(docs, none).where("overlap.n_hit > 0").count() == 0
    assert dc.find_overlaps(no_documents(spark), bench).count() == 0


def test_query(spark, data):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = QUERIES["op6_decontamination"](spark, data).collect()
    assert len(rows) == len(docs) and any(r["contaminated"] for r in rows)
    for row in rows:
        text = docs[row["doc_id"]]
        if row["contaminated"] or row["doc_id"] % 10 == 0:  # the plain version is slow
            n, hit, found = hit_words(text, items)
            digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
            assert (row["n_words"], row["n_hit"], row["n_items"], row["items_sha256"]) == (n, len(hit), len(found), digest)
            assert row["contaminated"] == bool(hit)


def test_blocks_of_the_benchmark_do_not_change_what_is_cut(spark):
    items = spark.createDataFrame([("1", "a b c d"), ("2", "c d e f"), ("3", "p q")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "a b p q c d p q e f"), (2, "x a b c p q d e f y"), (3, "a b c")], "doc_id bigint, text string")
    results = []
    for size in (3, 1 << 20):
        rows = dc.remove_overlaps(docs, items, window=4, max_block_bytes=size).collect()
        results.append({r["doc_id"]: r["text"].split() for r in rows})
    assert results[0] == results[1] == {1: [], 2: ["x", "y"], 3: ["a", "b", "c"]}
