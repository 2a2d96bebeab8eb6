import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import language_id as li
from corpusprep.llm.queries import QUERIES
from tests.llm.frames import CLASHES, no_documents, odd_documents

DOCS = [(i, "the cat and the dog of this house", "en") for i in range(5)] + [(9, "le chat et le chien de la maison", "fr"), (10, None, "fr"), (11, "x", None), (None, "y", "en")]
PAGES = [
    (1, "http://www.a.fr/1", '<html lang="fr"><p>le chat et le chien'),
    (2, "http://www.a.fr/2", '<html lang="en"><p>le chat de la maison'),
    (3, "http://b.a.fr/3", "<p>xyz"),
    (4, "http://c.com:80/4", "<html LANG=en-GB><p>the dog of the house"),
    (5, None, None),
    (6, "no address", ""),
    (7, "http://www.a.fr/7", ""),
    (7, "http://www.a.fr/7", ""),
    (None, "http://www.a.fr./", "<p>le chat"),
]


def plain(model, pages):
    """The same fusion page by page."""
    n = len(model.languages)
    rows = []
    for page_id, url, page in pages:
        host = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", url or "")
        host = re.sub(r"^.*@|:\d*$|\.$", "", host[1].lower()) if host else ""
        declared = re.search(r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", page or "")
        logs = li.TEMPER * model.score(li.page_text(page))
        p = np.exp(logs - logs.max())
        own = np.floor(p / p.sum() * li.UNIT + 0.5)
        domain = re.search(r"([^.]*\.[^.]*)$", host)
        rows.append((page_id, host, domain[1] if domain else "", host.split(".")[-1], declared[1].lower() if declared else "", logs, own))
    sums = [Counter() for _ in range(4)]
    for r in rows:
        for k in range(4):
            sums[k][r[1 + k]] = sums[k].get(r[1 + k], 0) + r[6]
    total = sum(r[6] for r in rows) / li.UNIT
    kinds = {k: len(sums[k]) for k in (2, 3)}
    out = []
    for page_id, host, domain, suffix, declared, logs, own in rows:
        overall = (total + 1) / (total.sum() + n)
        prior = overall
        for k, value in ((1, domain), (0, host)):
            others = (sums[k][value] - own) / li.UNIT
            prior = (others + li.PRIOR_PAGES * prior) / (others.sum() + li.PRIOR_PAGES)
        score = logs + np.log(prior)
        for k, value in ((3, declared), (2, suffix)):
            score = score + np.log((sums[k][value] / li.UNIT + li.SMOOTHING) / (total + li.SMOOTHING * kinds[k]))
        post = np.exp(score - score.max())
        post /= post.sum()
        out.append((str(page_id), host, declared, model.languages[int(post.argmax())], round(float(post.max()), 5)))
    return sorted(out)


def test_fusion_against_page_by_page(spark):
    model = li.train(spark.createDataFrame(DOCS, "doc_id bigint, text string, lang string"))
    assert model.languages == ("en", "fr")
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumns({c: F.lit("clash") for c in CLASHES})
    rows = li.identify(pages.repartition(3), model).collect()
    got = sorted((str(r["page_id"]), r["host"], r["declared"], r["lang"], round(r["posterior"], 5)) for r in rows)
    want = plain(model, PAGES)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want], abs=2e-5)
    by_id = {r["page_id"]: r for r in rows}
    assert by_id[7]["lang"] == "fr" and by_id[7]["text_lang"] == "en"  # nothing but its host speaks for it
    assert li.identify(pages.where("false"), model).count() == 0


def test_weights_are_those_of_naive_bayes(spark):
    model = li.train(spark.createDataFrame(DOCS, "doc_id bigint, text string, lang string"))
    found = li.trigram_buckets("the cat and the dog of this house")
    counts = np.bincount(found, minlength=li.BUCKETS) * 5 + 0.5
    assert model.weights[:, 0] == pytest.approx(np.log(counts / counts.sum()))
    assert math.isclose(np.exp(model.weights[:, 1]).sum(), 1)


def test_without_labelled_documents(spark):
    for docs in (no_documents(spark), spark.createDataFrame([(1, None, "en"), (2, "a", None)], "doc_id bigint, text string, lang string")):
        model = li.train(docs)
        assert model.languages == ()
        rows = li.identify(spark.createDataFrame(PAGES, "page_id bigint, url string, html string"), model).collect()
        assert len(rows) == len(PAGES) and all(r["lang"] is None and r["posterior"] is None for r in rows)
    assert set(li.train(odd_documents(spark)).languages) == {"en", "fr", "xx"}


def test_query(spark, data):
    rows = QUERIES["op5_language_id"](spark, data).collect()
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    assert len(rows) == len(urls)
    told = [(r["lang"], m[1]) for r in rows if (m := re.search(r"/(en|fr|de|es)/", urls[r["page_id"]]))]
    assert np.mean([a == b for a, b in told]) > 0.97
