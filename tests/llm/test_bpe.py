import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusprep.llm import bpe
from corpusprep.llm.queries import BPE_RANKS, QUERIES
from tests.llm.frames import no_documents, odd_documents

PATH = public_tokenizers.path(BPE_RANKS)


@pytest.fixture(scope="module")
def ours():
    with open(PATH) as lines:
        return bpe.Vocabulary.from_text(lines.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def theirs(ours):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})


def numbers(packed):
    return np.frombuffer(packed, "<u4").tolist()


LETTERS = st.sampled_from(list("abtheon  \n'sré01-=") + ["🙂", "՘", "\U0003250f", " ", "\x1c"])


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(LETTERS, max_size=200)))
def test_any_text(ours, theirs, text):
    packed = ours.encode(text)
    assert numbers(packed) == theirs.encode_ordinary(text)
    assert ours.decode(packed).decode() == text


@pytest.mark.parametrize("unit", ["a", "ab", "é", " ", "theon", "=-"])
def test_long_pieces(ours, theirs, unit):
    text = unit * (6_000 // len(unit))
    assert numbers(ours.encode(text)) == theirs.encode_ordinary(text)


def test_joins_of_any_cut_give_the_whole(ours):
    draw = random.Random(1)
    for _ in range(300):
        data = "".join(draw.choice("abcdetheinon") for _ in range(draw.randint(2, 120))).encode()
        cut = draw.randint(1, len(data) - 1)
        assert ours.joined(ours.merged(data[:cut]), ours.merged(data[cut:])) == ours.merged(data) == ours.reduced(data)


def test_what_is_remembered_does_not_matter(theirs, ours, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_PIECES", 3)
    monkeypatch.setattr(bpe, "REMEMBERED_RUNS", 2)
    small = bpe.Vocabulary(ours.ranks, public_tokenizers.PATTERN)
    for text in ("one two three four five six seven one two", "anotherwordthatisnew and one more"):
        assert numbers(small.encode(text)) == theirs.encode_ordinary(text)


def test_odd_documents(spark, theirs):
    docs = odd_documents(spark)
    out = bpe.round_trip(docs, PATH, public_tokenizers.PATTERN)
    assert set(docs.columns) <= set(out.columns)
    rows = out.collect()
    assert len(rows) == docs.count()
    for row in rows:
        text = row["text"] or ""
        assert numbers(bytes(row["token_ids"])) == theirs.encode_ordinary(text)
        assert (row["n_tokens"], bytes(row["decoded"]).decode(), row["exact"]) == (len(row["token_ids"]) // 4, text, True)
        assert row["coded"] == "clash"
    apart = bpe.decode_documents(bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    assert sorted(bytes(r["decoded"]) for r in apart.collect()) == sorted((r["text"] or "").encode() for r in rows)
    assert bpe.round_trip(no_documents(spark), PATH, public_tokenizers.PATTERN).count() == 0


def test_query(spark, data, theirs):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = QUERIES["op7_byte_bpe"](spark, data).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = np.array(theirs.encode_ordinary(texts[row["doc_id"]]), "<u4")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
