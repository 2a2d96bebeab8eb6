"""The tokens of documents and their entries in a table of any size, brought together in chunks of documents.

Joining every token with the table would move each of them twice, and all of a
frequent word to one task. Here documents are dealt into chunks of bounded size,
the distinct forms of a chunk are joined with the table, and each chunk meets its
own entries in one task. What is shuffled goes with the distinct forms of chunks,
and documents move as arrays.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.work import explode_each

# Bytes of tokens in a chunk, on average.
CHUNK_BYTES = 32 * 1024 * 1024

FOUND = T.ArrayType(T.StructType().add("pos", "integer").add("form", "string").add("lemma", "string").add("upos", "string"))


def chunked(docs: DataFrame, tokens: str, lang: Column, key: str) -> DataFrame:
    """(chunk, key, lang, tokens) of the documents with tokens. They are read three times, so write them before."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), lang.cast("string").alias("lang"), F.col(tokens).alias("tokens")).where("size(tokens) > 0")
    size = rows.agg(F.sum(F.octet_length(F.array_join("tokens", " ")).cast("bigint"))).first()[0] or 0
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The hash and its remainder are those of ``staged``: a chunk is a part of one bucket, or some buckets together, so
    # that the distinct forms of a chunk are mostly found by one task.
    n = -(-size // CHUNK_BYTES)
    if n > buckets:
        n = buckets * -(-n // buckets)
    else:
        least = min(buckets, max(n, 2 * spark.sparkContext.defaultParallelism))
        n = next(d for d in range(least, buckets + 1) if buckets % d == 0)
    return rows.select(F.pmod(F.hash("key"), F.lit(n)).alias("chunk"), "key", "lang", "tokens")


def chunk_entries(chunks: DataFrame, table: DataFrame) -> DataFrame:
    """(chunk, lang, form, …): the forms of each chunk that ``table`` (lang, folded, …) has, in whatever case."""
    forms = explode_each(chunks, ["chunk", "lang"], F.col("tokens"), "form").select("chunk", "lang", "form").distinct()
    # Most forms are in lower case already and travel once.
    folded = forms.select("chunk", "lang", F.lower("form").alias("folded"), F.nullif(F.col("form"), F.lower("form")).alias("form"))
    found = folded.join(table, ["lang", "folded"]).withColumn("form", F.coalesce("form", "folded")).drop("folded")
    # Names of their own, because the documents have the same columns.
    return found.select(*[F.col(name).alias(name) for name in found.columns])


def by_chunk(chunks: DataFrame, entries: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: T.StructType) -> DataFrame:
    """``work`` on the documents and the entries of each chunk.

    Tokens move as one text and their sizes, which is less than half of an array of strings.
    """
    sizes = F.transform("tokens", F.octet_length)
    packed = chunks.select("chunk", "key", "lang", F.array_join("tokens", "").cast("binary").alias("text"), sizes.alias("sizes"))
    return packed.groupBy("chunk").cogroup(entries.groupBy("chunk")).applyInArrow(work, schema)


def with_found(chunks: DataFrame, entries: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], key: str, out: str) -> DataFrame:
    """(key, lang, ``out``, repeated): ``work`` gives an array of (pos, form, lemma, upos) for each document.

    ``repeated`` says that the key has several rows here; rows of one key are in one chunk.
    """

    def found(docs: pa.Table, entries: pa.Table) -> pa.Table:
        rows = work(docs, entries)
        _, text, n = np.unique(texts_of(rows, ["key"]), return_inverse=True, return_counts=True)
        return rows.append_column("repeated", pa.array(n[text] > 1))

    names = T.StructType([chunks.schema["key"], chunks.schema["lang"]]).add("found", FOUND).add("repeated", "boolean")
    return by_chunk(chunks, entries, found, names).toDF(key, "lang", out, "repeated")


def texts_of(docs: pa.Table, by: list[str]) -> np.ndarray:
    """A number for each row, equal for rows that are equal in ``by``: that of the first such row."""
    codes = np.zeros(len(docs), np.int64)
    for name in by:
        column = whole(docs[name]).dictionary_encode(null_encoding="encode")
        codes = np.unique(codes * (len(column.dictionary) + 1) + column.indices.to_numpy(), return_inverse=True)[1]
    return np.unique(codes, return_index=True)[1][codes]


@dataclass(frozen=True)
class Matched:
    """Flat tokens of a chunk: row of the document, place in it, form, and row in the entries or -1."""

    doc: np.ndarray
    pos: np.ndarray
    form: pa.Array
    entry: np.ndarray


def match(docs: pa.Table, entries: pa.Table) -> Matched:
    lists = whole(docs["sizes"])
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    form = _forms(whole(docs["text"]), lists.flatten())
    doc = np.repeat(np.arange(len(sizes)), sizes)
    pos = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    entry = np.full(len(doc), -1, np.int64)
    langs = whole(docs["lang"])
    for lang in langs.unique():
        if lang.is_valid:
            own = np.flatnonzero(pc.equal(entries["lang"], lang).to_numpy())
            spoken = pc.fill_null(pc.equal(langs, lang), False).to_numpy(zero_copy_only=False)[doc]
            found = pc.index_in(form.filter(pa.array(spoken)), value_set=whole(entries["form"]).take(pa.array(own)))
            entry[spoken] = np.append(own, -1)[pc.fill_null(found, -1).to_numpy()]
    return Matched(doc, pos, form, entry)


def _forms(texts: pa.Array, sizes: pa.Array) -> pa.Array:
    """The tokens that follow each other in ``texts``, null where the size is."""
    ends = np.append(0, np.cumsum(pc.fill_null(sizes, 0).to_numpy().astype(np.int64)))
    letters = np.concatenate([np.frombuffer(t.as_buffer(), np.uint8) for t in texts] or [np.empty(0, np.uint8)])
    valid = np.packbits(sizes.is_valid().to_numpy(zero_copy_only=False), bitorder="little")
    buffers = [pa.py_buffer(valid), pa.py_buffer(ends), pa.py_buffer(letters)]
    return pa.Array.from_buffers(pa.large_string(), len(sizes), buffers, sizes.null_count).cast(pa.string())


def whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def taken(column: pa.ChunkedArray, rows: np.ndarray) -> pa.Array:
    """The values at ``rows``, null for -1."""
    return whole(column).take(pa.array(rows, mask=rows < 0))


def found_lists(sizes: np.ndarray, pos: np.ndarray, form: pa.Array, lemma: pa.Array, upos: pa.Array) -> pa.Array:
    parts = {"pos": pa.array(pos, pa.int32()), "form": form, "lemma": pc.coalesce(lemma, form), "upos": upos}
    ends = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(list(parts.values()), list(parts)))


def annotated(docs: DataFrame, tokens: str, table: DataFrame, lang: Column, key: str, out: str = "found") -> DataFrame:
    """(key, lang, ``out``, repeated): for each document with tokens an array of (pos, form, lemma, upos), in text order.

    ``table`` is (lang, folded, lemma, upos) with one row for each folded form. A form that it does not have, or has
    without a lemma, is its own lemma.
    """
    chunks = chunked(docs, tokens, lang, key)
    entries = chunk_entries(chunks, table).withColumn("lemma", F.nullif("lemma", "form"))
    return with_found(chunks, entries, _annotate, key, out)


def _annotate(docs: pa.Table, entries: pa.Table) -> pa.Table:
    at = match(docs, entries)
    lemma, upos = (taken(entries[name], at.entry) for name in ("lemma", "upos"))
    found = found_lists(np.bincount(at.doc, minlength=len(docs)), at.pos, at.form, lemma, upos)
    return pa.table({"key": docs["key"], "lang": docs["lang"], "found": found})
