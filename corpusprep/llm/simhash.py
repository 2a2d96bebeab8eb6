"""SimHash near-duplicates, with candidates pruned by the pigeonring principle.

A document's fingerprint has 64 bits: bit b is 1 when it is 1 in more than half of the hashes of the document's word
shingles. Documents are linked when their fingerprints differ in at most ``max_bits`` bits, and links are followed.

Pigeonring: lay the fingerprint's segments in a ring. If two fingerprints differ in at most t bits over m segments,
there is a segment from which every chain of l consecutive segments has at most l * t / m differences. Chains of two go
into the join key: the first segment as it is and every variant of the second that the budget allows. Chains of three
and more, and the full distance, are the join's condition. So only real links leave the join.

Copies of one fingerprint are folded into one row before the search and after it share the label by a join. Fingerprints
go through written tables; nothing is gathered by the driver, and keys meet behind a shuffle whatever their number.

Defined results: a null or empty text, or one of white space, has the fingerprint 0 and is linked like any other.
``component_id`` is the smallest id that can be reached; ids that are null are in no minimum, and the component has a
null id if all of its ids are. The component's first row is the one with the smallest id, ids that are null behind all
others, and of those with the smallest hash of the text. Rows that repeat an id each get a row. Texts of any length are read whole. Only the two
columns named are read, so other columns do not matter; an empty table gives an empty result.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import col, fresh, strings, text_hash
from corpusprep.llm.components import components
from corpusprep.work import broadcast_if_small, written

BITS = 64
SEGMENTS = 4
WIDTH = BITS // SEGMENTS
HASH_SEED = 42
AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint as a signed number. Words end at ASCII white space, A-Z are lower-cased."""
    words = (text or "").encode().lower().split()
    n = max(1, len(words) - shingle + 1)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, np.int64)
    for i in range(0, n, AT_ONCE):
        part = list(zip(starts[i : i + AT_ONCE], last[i : i + AT_ONCE]))
        hashes = np.fromiter((digest(joined[a:b], HASH_SEED) for a, b in part), np.uint64, len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.int64)[0])


def fingerprints(text: Column, shingle: int) -> Column:
    @F.pandas_udf("bigint")
    def apply(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, shingle) for t in strings(batch)], dtype="int64")

    return apply(text)


def _segment(fp: str, i: int) -> Column:
    return F.shiftrightunsigned(F.col(fp), WIDTH * (i % SEGMENTS)).bitwiseAND(F.lit((1 << WIDTH) - 1).cast("bigint"))


def _key(start: int, first: Column, second: Column) -> Column:
    return F.shiftleft(F.lit(start).cast("bigint"), 2 * WIDTH) + F.shiftleft(first, WIDTH) + second


def _ring_condition(start: int, max_bits: int) -> Column:
    """All chains from ``start`` within budget; the last of them is the whole ring, so this is the distance check too."""
    differences, within = F.lit(0), F.lit(True)
    for length in range(1, SEGMENTS + 1):
        i = start + length - 1
        differences = differences + F.bit_count(_segment("x", i).bitwiseXOR(_segment("y", i)))
        within = within & (differences <= length * max_bits // SEGMENTS)
    return within


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """(u, v), u < v: the pairs of fingerprints in ``prints`` (fp, each once) that differ in at most ``max_bits`` bits."""
    if not 0 <= max_bits < BITS:
        raise ValueError(f"max_bits must be from 0 to {BITS - 1}")
    first_budget, budget = max_bits // SEGMENTS, 2 * max_bits // SEGMENTS
    masks = [sum(1 << b for b in bits) for k in range(budget + 1) for bits in combinations(range(WIDTH), k)]
    if first_budget or len(masks) > 200:
        raise ValueError("the first segment of a chain must agree: max_bits below 4")
    pairs = None
    stored = F.array(*[_key(i, _segment("fp", i), _segment("fp", i + 1)) for i in range(SEGMENTS)])
    asked = F.array(
        *[
            _key(i, _segment("fp", i), _segment("fp", i + 1).bitwiseXOR(F.lit(mask).cast("bigint")))
            for i in range(SEGMENTS)
            for mask in masks
        ]
    )
    index = prints.select(F.col("fp").alias("x"), F.explode(stored).alias("key"))
    probes = prints.select(F.col("fp").alias("y"), F.explode(asked).alias("key"))
    start = F.shiftrightunsigned("key", 2 * WIDTH)
    within = F.lit(False)
    for i in reversed(range(SEGMENTS)):
        within = F.when(start == i, _ring_condition(i, max_bits)).otherwise(within)
    # Spark sizes both sides as if nothing were exploded, and would broadcast the probes of very many fingerprints.
    pairs = index.hint("merge").join(probes, "key").where((F.col("x") < F.col("y")) & within)
    return pairs.select(F.col("x").alias("u"), F.col("y").alias("v")).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3
) -> DataFrame:
    """One row per row of ``docs``: the id, ``fp`` (signed number), ``fingerprint`` (16 hexadecimal digits),
    ``component_id``, ``text_hash``, which tells apart rows that share an id, and ``component_hash``, the ``text_hash`` of
    the component's first row."""
    own = docs.select(
        col(id_col).alias("id"),
        text_hash(col(text_col)).alias("text_hash"),
        fingerprints(col(text_col), shingle).alias("fp"),
    )
    own = written(own, "fingerprints")
    row = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    prints = written(own.groupBy("fp").agg(F.min(row).alias("least")), "prints")
    roots = components(written(links(prints, max_bits), "links"))
    rooted = prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = written(rooted, "rooted")
    groups = rooted.groupBy("root").agg(F.min("least").alias("first"))
    named = [F.col("first.id").alias("component_id"), F.col("first.text_hash").alias("component_hash")]
    groups = written(groups.select("root", *named), "groups")
    labels = written(rooted.join(groups, "root").select("fp", "component_id", "component_hash"), "labels")
    return own.join(labels, "fp").select(
        F.col("id").alias(id_col),
        "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "text_hash",
        "component_hash",
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3
) -> DataFrame:
    """The first row of each group, with the columns it had.

    Of rows that are equal in id and text one stays; a null text equals an empty one. Rows that share an id but not a group
    do not touch each other. A row without an id can stay only if its group has no id at all.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, max_bits)
    first = F.col("id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("component_hash"))
    found = written(found.select(col(id_col).alias("id"), "text_hash", "component_id", "component_hash"), "near_duplicates")
    losers = found.where(~first).select("id", "text_hash").distinct()
    losers = broadcast_if_small(written(losers, "losers"))
    hash_col = fresh("text_hash", docs)
    hashed = docs.withColumn(hash_col, text_hash(col(text_col)))
    same = hashed[f"`{id_col}`"].eqNullSafe(losers["id"]) & (hashed[hash_col] == losers["text_hash"])
    kept = hashed.join(losers, same, "left_anti")
    if found.where(first).groupBy("id", "text_hash").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates([id_col, hash_col])
    return kept.drop(hash_col)
