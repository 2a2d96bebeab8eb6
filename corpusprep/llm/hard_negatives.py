"""Hard-negative mining with an inverted multi-index: exact results from cells that certify when to stop.

Vectors are made of whole numbers and scored by their inner product. An anchor's positives are the rows of its label with the
highest scores. Its hard negatives for a positive are the highest-scored rows of other labels in a window below the score of
that positive.

1. Each half of the vectors has a codebook, fitted on a bounded sample; every row is in the cell of its two nearest
   codewords. A codeword's radius is the largest distance of any of its rows, a grouped maximum over all rows.
2. Cells are written in blocks of about ``BLOCK_ROWS`` rows: small cells share one, large ones are dealt out over several by
   hash. Anchors are put together in groups of about ``GROUP_ROWS`` in the same way.
3. For an anchor, no row of a cell can score above the sum of two half-scores: anchor half times codeword, plus the anchor
   half's length times the radius. A heap over the two sorted lists of half-scores (a multi-sequence) yields the cells by that
   sum, highest first.
4. A search has two rounds. The first visits cells until they hold ``SEED_ROWS`` rows. The second goes on from the scores
   found so, which are certified lower bounds, and stops at the first cell whose sum is below what every window still needs.
   Cells that lie above all windows are passed over. The rows behind that stop cannot change the result, so it is exact.
   Positives are searched first, then windows.

A visit joins the blocks that a group asks for with the group, multiplies two matrices and keeps the best few rows for each
anchor and window. Tasks hold one block and one group. What the driver holds are the codebooks and one row for each cell, of
which there are at most ``MOST_CODEWORDS`` squared. On vectors without structure the bounds rule out little, and a visit of
nearly every block by every group is what exact results then need.

Defined results: rows without an id, label or vector, and rows with a null or non-finite component, take no part. Rows equal
in id, label and vector count once; a row is not its own positive, but another row of the same id may be. Ties go to the
smaller id. A short vector is filled with zeros; an empty one scores zero with all. Scores beyond 64 bits count as the
largest or smallest number of 64 bits. An empty table gives an empty result. Only the columns named are read.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import col
from corpusprep.work import broadcast_if_small, written

SCALE = 256
BLOCK_ROWS = 2_048
GROUP_ROWS = 4_096
SEED_ROWS = 2_048
#: Rows that the codebooks are fitted on, those with the least hashes of their id.
SAMPLE_ROWS = 4_096
FIT_ROUNDS = 8
MOST_CODEWORDS = 128
#: Scores that a task works out at once.
SLICE = 1 << 20
LEAST, MOST = -(1 << 63), (1 << 63) - 1

_ROWS = "id bigint, label bigint, vector binary"
_GROUP = "grp int, ids binary, labels binary, vectors binary, lows binary, highs binary"
_FOUND = "grp int, idx int, anchor bigint, slot int, score bigint, id bigint"


@dataclass(frozen=True)
class Index:
    """Codebooks, radii, and for each cell how many rows it has and which blocks they are in."""

    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    rows: dict[tuple[int, int], int]
    blocks: dict[tuple[int, int], tuple[int, int]]  # first, how many

    @property
    def half(self) -> int:
        return self.books[0].shape[1]


def _numbers(blob: bytes, dims: int | None = None) -> np.ndarray:
    found = np.frombuffer(blob, np.int64)
    return found if dims is None else found.reshape(-1, dims)


def usable(rows: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, vector array<bigint>) for the rows that take part, each once."""
    raw = F.transform(col(vector_col), lambda v: v.cast("double"))
    named = rows.select(col(id_col).cast("bigint").alias("id"), col(label_col).cast("bigint").alias("label"), raw.alias("raw"))
    odd = F.exists("raw", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = named.where("id IS NOT NULL AND label IS NOT NULL AND raw IS NOT NULL").where(~odd)
    return good.select("id", "label", F.transform("raw", lambda v: F.floor(v * SCALE)).alias("vector")).distinct()


def fitted(sample: np.ndarray, codewords: int) -> np.ndarray:
    """Codewords of the sample's rows by Lloyd's rounds from rows that are evenly spaced in the order of their first axis."""
    rows = sample.astype(np.float64)
    if not len(rows):
        return np.zeros((1, sample.shape[1]))
    spread = rows[np.argsort(rows @ np.linspace(1, 2, rows.shape[1]) if rows.shape[1] else np.zeros(len(rows)), kind="stable")]
    book = np.unique(spread[np.linspace(0, len(rows) - 1, codewords).astype(int)], axis=0)
    for _ in range(FIT_ROUNDS):
        own = nearest(rows, book)[0]
        sizes = np.bincount(own, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, own, rows)
        book = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], book)
    return book


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest codeword of each row, and the distance to it."""
    own = ((book**2).sum(axis=1) - 2 * (rows @ book.T)).argmin(axis=1)
    return own, np.sqrt(((rows - book[own]) ** 2).sum(axis=1))


def _assign(frames: Iterator[pd.DataFrame], books: tuple[np.ndarray, np.ndarray], dims: int) -> Iterator[pd.DataFrame]:
    half = books[0].shape[1]
    for frame in frames:
        whole = np.zeros((len(frame), dims), np.int64)
        for i, vector in enumerate(frame["vector"]):
            whole[i, : len(vector)] = vector
        rows = whole.astype(np.float64)
        a, da = nearest(rows[:, :half], books[0])
        b, db = nearest(rows[:, half:], books[1])
        vectors = pd.Series([v.tobytes() for v in whole], dtype=object, index=frame.index)
        yield frame[["id", "label"]].assign(vector=vectors, a=a, b=b, da=da, db=db)


def packed(sizes: dict[tuple[int, int], int], most: int) -> dict[tuple[int, int], tuple[int, int]]:
    """(first block, number of blocks) for each cell: large cells have blocks of their own, small ones share."""
    found, block, room = {}, -1, 0
    for cell, n in sorted(sizes.items()):
        if n > most:
            parts = -(-n // most)
            found[cell] = (block + 1, parts)
            block, room = block + parts, 0
            continue
        if n > room:
            block, room = block + 1, most
        found[cell] = (block, 1)
        room -= n
    return found


def _gathered(frame: pd.DataFrame, key: str) -> pd.DataFrame:
    frame = frame.sort_values(["id", "label", "vector"])
    joined = {
        key: [int(frame[key].iloc[0])],
        "ids": [frame["id"].to_numpy(np.int64).tobytes()],
        "labels": [frame["label"].to_numpy(np.int64).tobytes()],
        "vectors": [b"".join(frame["vector"])],
    }
    return pd.DataFrame(joined)


def _dealt(cells: DataFrame, places: dict, key: str) -> DataFrame:
    """Rows of cells put together by ``places``; one small row for each cell is all that is sent to the tasks."""
    spark = cells.sparkSession
    directory = spark.createDataFrame(
        [(a, b, first, parts) for (a, b), (first, parts) in places.items()], "a int, b int, first int, parts int"
    )
    part = F.pmod(F.xxhash64("id", "vector"), F.col("parts")).cast("int")
    dealt = cells.join(F.broadcast(directory), ["a", "b"]).select("id", "label", "vector", (F.col("first") + part).alias(key))
    schema = f"{key} int, ids binary, labels binary, vectors binary"
    return dealt.groupBy(key).applyInPandas(partial(_gathered, key=key), schema)


def sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) over all pairs of entries of two lists, highest sum first."""
    x, y = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    p, q = first[x].tolist(), second[y].tolist()
    x, y = x.tolist(), y.tolist()
    heap = [(-(p[0] + q[0]), 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        yield -total, x[i], y[j]
        if j + 1 < len(q):
            heapq.heappush(heap, (-(p[i] + q[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(p):
            heapq.heappush(heap, (-(p[i + 1] + q[0]), i + 1, 0))


def visited(
    anchor: np.ndarray, lows: np.ndarray, highs: np.ndarray, index: Index, seed: int | None
) -> Iterator[tuple[int, int]]:
    """The cells to visit for an anchor's windows: those that hold the first ``seed`` rows, or all that the windows need."""
    wanted = lows <= highs
    if not wanted.any():
        return
    low, high = float(lows[wanted].min()), float(highs[wanted].max())
    halves = anchor[: index.half].astype(np.float64), anchor[index.half :].astype(np.float64)
    middle = [book @ h for book, h in zip(index.books, halves)]
    spread = [np.linalg.norm(h) * r for h, r in zip(halves, index.radii)]
    tops = [m + s for m, s in zip(middle, spread)]
    ends = [m - s for m, s in zip(middle, spread)]
    slack = 1e-9 * (1 + sum(float(np.abs(t).max()) for t in (*tops, *ends)))
    held = 0
    for bound, a, b in sequence(*tops):
        if bound + slack < low or (seed is not None and held >= seed):
            return
        n = index.rows.get((a, b), 0)
        if n and ends[0][a] + ends[1][b] - slack <= high:
            held += n
            yield a, b


def _asked(frames: Iterator[pd.DataFrame], index: Index, dims: int, seed: int | None) -> Iterator[pd.DataFrame]:
    """(grp, block) for the blocks that a group's anchors need: of the first round, or else those beyond it."""
    for frame in frames:
        for row in frame.itertuples(index=False):
            vectors = _numbers(row.vectors, dims)
            slots = len(_numbers(row.lows)) // len(vectors)
            lows, highs = _numbers(row.lows, slots), _numbers(row.highs, slots)
            blocks: set[int] = set()
            cells: set[tuple[int, int]] = set()
            for i, anchor in enumerate(vectors):
                cells.update(visited(anchor, lows[i], highs[i], index, seed))
            for cell in cells:
                first, parts = index.blocks[cell]
                blocks.update(range(first, first + parts))
            yield pd.DataFrame({"grp": [row.grp] * len(blocks), "block": sorted(blocks)}, dtype="int32")


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two whole-number matrices."""
    largest = float(np.abs(x.astype(np.float64)).max(initial=0)) * float(np.abs(y.astype(np.float64)).max(initial=0))
    largest *= max(1, x.shape[1])
    if largest < 2**53:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    if largest < 2**62:
        return x @ y.T
    exact = x.astype(object) @ y.astype(object).T
    return np.clip(exact, LEAST, MOST).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, fits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` highest scores of each row among those that fit, ties by the smaller id."""
    if scores.shape[1] > k:
        held = np.where(fits, scores, LEAST)
        least = np.partition(held, -k, axis=1)[:, -k]
        fits = fits & (held >= least[:, None])
    rows, columns = np.nonzero(fits)
    order = np.lexsort((ids[columns], ~scores[rows, columns], rows))  # ~x falls as x rises, without overflow
    rows, columns = rows[order], columns[order]
    starts = np.searchsorted(rows, rows, side="left")
    kept = np.arange(len(rows)) - starts < k
    return rows[kept], columns[kept]


def _scored(frame: pd.DataFrame, dims: int, same: bool, k: int) -> pd.DataFrame:
    """The best rows of a block for the windows of a group's anchors."""
    row = next(frame.itertuples(index=False))
    anchors, ids, labels = _numbers(row.vectors, dims), _numbers(row.ids), _numbers(row.labels)
    slots = len(_numbers(row.lows)) // len(ids)
    lows, highs = _numbers(row.lows, slots), _numbers(row.highs, slots)
    vectors, names, classes = _numbers(row.block_vectors, dims), _numbers(row.block_ids), _numbers(row.block_labels)
    step = max(1, SLICE // max(1, len(names)))
    found = []
    for start in range(0, len(ids), step):
        part = slice(start, start + step)
        scores = _products(anchors[part], vectors)
        fits = (labels[part, None] == classes) == same
        if same:
            for i, j in zip(*np.nonzero(fits & (ids[part, None] == names))):
                if (anchors[start + i] == vectors[j]).all():
                    fits[i, j] = False
        for slot in range(slots):
            inside = fits & (scores >= lows[part, slot, None]) & (scores <= highs[part, slot, None])
            i, j = _best(scores, names, inside, k)
            found.append(
                pd.DataFrame(
                    {"grp": row.grp, "idx": start + i, "anchor": ids[start + i], "slot": slot, "score": scores[i, j], "id": names[j]}
                )
            )
    return pd.concat(found)


def _visit(groups: DataFrame, asked: DataFrame, blocks: DataFrame, dims: int, same: bool, k: int) -> DataFrame:
    held = blocks.select("block", *(F.col(c).alias(f"block_{c}") for c in ("ids", "labels", "vectors")))
    pairs = asked.join(held, "block").join(broadcast_if_small(groups), "grp")
    scored = pairs.groupBy("grp", "block").applyInPandas(partial(_scored, dims=dims, same=same, k=k), _FOUND)
    return _top(scored, k)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("grp", "idx", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def _raised(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """A group whose windows start at the ``k``-th best score that is known."""
    if left.empty:
        return left
    n = len(_numbers(left["ids"].iloc[0]))
    lows = _numbers(left["lows"].iloc[0]).reshape(n, -1).copy()
    for (idx, slot), scores in right.groupby(["idx", "slot"])["score"]:
        if len(scores) >= k:
            lows[idx, slot] = max(lows[idx, slot], scores.min())
    return left.assign(lows=[lows.tobytes()])


def _search(groups: DataFrame, blocks: DataFrame, index: Index, dims: int, same: bool, k: int) -> DataFrame:
    """The ``k`` best rows for each window of each anchor: (grp, idx, anchor, slot, score, id)."""

    def asked(frame: DataFrame, seed: int | None) -> DataFrame:
        return frame.mapInPandas(partial(_asked, index=index, dims=dims, seed=seed), "grp int, block int")

    seeds = written(asked(groups, SEED_ROWS), "seeds")
    first = written(_visit(groups, seeds, blocks, dims, same, k), "first")
    raised = groups.groupBy("grp").cogroup(first.groupBy("grp")).applyInPandas(partial(_raised, k=k), _GROUP)
    raised = written(raised, "raised")
    rest = asked(raised, None).join(seeds, ["grp", "block"], "left_anti")
    more = _visit(raised, written(rest, "rest"), blocks, dims, same, k)
    return written(_top(first.unionByName(more), k), "found")


def _windows(left: pd.DataFrame, right: pd.DataFrame, slots: int, low: int, high: int) -> pd.DataFrame:
    """A group with one window for each positive; anchors with fewer have windows that nothing is in."""
    if left.empty:
        return left
    n = len(_numbers(left["ids"].iloc[0]))
    lows, highs = np.full((n, slots), 1, np.int64), np.zeros((n, slots), np.int64)
    for idx, place, score in zip(right["idx"], right["place"], right["score"].tolist()):
        lows[idx, place] = -(-low * score // 100)
        highs[idx, place] = high * score // 100
    return left.assign(lows=[lows.tobytes()], highs=[highs.tobytes()])


def build(cells: DataFrame, books: tuple[np.ndarray, np.ndarray]) -> tuple[Index, DataFrame, DataFrame]:
    """The index, its blocks, and the anchors in groups, from ``cells`` (id, label, vector, a, b, da, db, anchor)."""
    found = cells.groupBy("a", "b").agg(
        F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), F.max("da").alias("da"), F.max("db").alias("db")
    )
    found = found.collect()  # at most one row for each pair of codewords
    radii = tuple(np.zeros(len(book)) for book in books)
    for r in found:
        radii[0][r["a"]] = max(radii[0][r["a"]], r["da"])
        radii[1][r["b"]] = max(radii[1][r["b"]], r["db"])
    sizes = {(r["a"], r["b"]): r["n"] for r in found}
    places = packed(sizes, BLOCK_ROWS)
    blocks = written(_dealt(cells, places, "block"), "blocks")
    anchors = {(r["a"], r["b"]): r["anchors"] for r in found if r["anchors"]}
    groups = _dealt(cells.where("anchor"), packed(anchors, GROUP_ROWS), "grp")
    return Index(books, radii, sizes, places), blocks, groups


def mine(
    rows: DataFrame,
    anchors: Column,
    id_col: str = "id",
    label_col: str = "label",
    vector_col: str = "vector",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchors`` is true for,
    a condition on the column ``id``. Windows are from ``low`` to ``high`` hundredths of a positive's score."""
    table = written(usable(rows, id_col, label_col, vector_col), "usable")
    n, dims = table.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    sample = table.orderBy(F.xxhash64("id"), "id", "label", "vector").limit(SAMPLE_ROWS).select("vector").collect()
    known = np.zeros((len(sample), dims), np.int64)
    for i, (vector,) in enumerate(sample):
        known[i, : len(vector)] = vector
    half = dims // 2
    codewords = min(MOST_CODEWORDS, max(2, round(n**0.25)))
    books = fitted(known[:, :half], codewords), fitted(known[:, half:], codewords)
    schema = f"{_ROWS}, a int, b int, da double, db double"
    cells = table.mapInPandas(partial(_assign, books=books, dims=dims), schema)
    cells = written(cells.withColumn("anchor", F.coalesce(anchors, F.lit(False))), "cells")
    index, blocks, groups = build(cells, books)

    def everything(frame: pd.DataFrame) -> pd.DataFrame:
        n = len(_numbers(frame["ids"].iloc[0]))
        return frame.assign(lows=[np.full(n, LEAST, np.int64).tobytes()], highs=[np.full(n, MOST, np.int64).tobytes()])

    groups = written(groups.groupBy("grp").applyInPandas(everything, _GROUP), "groups")
    liked = _search(groups, blocks, index, dims, True, positives)
    order = Window.partitionBy("grp", "idx").orderBy(F.desc("score"), "id")
    liked = written(liked.withColumn("place", F.row_number().over(order) - 1), "positives")
    asked = groups.groupBy("grp").cogroup(liked.groupBy("grp"))
    asked = asked.applyInPandas(partial(_windows, slots=positives, low=low, high=high), _GROUP)
    hard = _search(written(asked, "windows"), blocks, index, dims, False, negatives)
    order = Window.partitionBy("grp", "idx", "slot").orderBy(F.desc("score"), "id")
    hard = hard.withColumn("rank", F.row_number().over(order))
    pairs = liked.select(
        "grp", "idx", F.col("place").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return hard.join(pairs, ["grp", "idx", "slot"]).select(
        F.col("anchor").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
