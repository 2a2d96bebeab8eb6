"""Fuzzy line dedup over a corpus: MinHash, banding, exact Jaccard verification, distributed union-find.

Lines with a character other than white space are compared as sets of their character shingles. Two lines are linked when
the Jaccard similarity of the sets is at least ``similarity``; links are followed, and one line of each component stays:
the first by id, text hash and place in the text. Equal lines are one node of the graph.

1. The tasks that read the documents sketch each line: every shingle falls into one of ``BANDS * ROWS`` bins and the least
   hash of a bin counts; what finds no shingle is filled by further rounds, so short lines work too. Two lines agree in a
   bin with the probability of their similarity. The sketches are cut into bands.
2. A band key is kept when two different lines have it. Its leader is the line that meets most lines over all of its keys
   (in a group of copies that is the text which the others were made from): every other line with the key is verified
   against the leader, which is one candidate per line and band, however many lines share the key.
3. Links found so are followed. Then the other lines of a key are compared with each other too, where their components
   differ; so no link between lines that share a key is lost. They are compared inside the tasks, in blocks of
   ``BLOCK_LINES`` lines against blocks, and only links come out. A large group of copies is one component by then: its
   lines are not compared with each other and not dealt out more than once for each block of lines outside of it.

Verification is exact: a bound from bit patterns of the shingles rules out most pairs, and the sets decide the others.
With 4 rows and 11 bands, lines of similarity 0.8 share a key with a probability of 0.997.

Only hashes are grouped and joined; texts are fetched for candidate lines alone. Minima are worked out in the tasks
before anything is shuffled. A line that is one third of the corpus leaves one row in each task. Steps are written to the
shared folder. Equal lines are told by two 64-bit hashes, candidates by one of them and then by their texts.

Defined results: lines of nothing but white space always stay. A null text stays null, and an empty one empty. A document
of which every line is a copy keeps its row, with an empty text. Rows that are equal in id and text are one document to
this operator, so they get the same result. A null id sorts before others. Lines shorter than a shingle are their own
shingle. Texts of any length are read whole. Empty tables give empty results. Columns that are not named stay as they are.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import WHITESPACE, col, fresh, strings, text_hash
from corpusprep.llm.components import components
from corpusprep.work import broadcast_if_small, written

SHINGLE = 7
SIMILARITY = 0.8
ROWS, BANDS = 4, 11
BINS = ROWS * BANDS

#: Lines of a sketching step, and lines that a task remembers so as to sketch equal ones once. Results do not depend on them.
STEP_LINES = 600
STEP_CHARS = 500_000
REMEMBERED_LINES = 200_000
#: Lines and shingles that a verifying task remembers. Results do not depend on them.
REMEMBERED_OUTLINES = 20_000
REMEMBERED_SHINGLES = 200_000
#: Bits of a line's outline, see ``outlines``.
OUTLINE_BITS = 4_096
#: Pairs whose outlines are compared at once. Results do not depend on it.
STEP_PAIRS = 4_096
#: Lines of a block, in the comparison of lines that share a key.
BLOCK_LINES = 512

_BLANK = WHITESPACE.decode()
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[3]
    return x ^ (x >> np.uint64(29))


def shingle_hashes(lines: list[str], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all lines one after the other, and how many each line has."""
    padded = [line if len(line) >= width else line + "\0" * (width - len(line)) for line in lines]
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    hashes, covered = codes, 1
    while covered < width:  # of two shorter runs, which overlap if need be
        step = min(covered, width - covered)
        hashes = hashes[:-step] * _ODD[covered % 3] + hashes[step:]
        hashes ^= hashes >> np.uint64(31)
        covered += step
    counts = sizes - width + 1
    starts = np.cumsum(sizes) - sizes
    places = np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return _mixed(hashes[places]), counts


def sketches(lines: list[str], width: int = SHINGLE, bins: int = BINS) -> np.ndarray:
    """A row of ``bins`` least hashes for each line."""
    hashes, counts = shingle_hashes(lines, width)
    owner = np.repeat(np.arange(len(lines)), counts)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    least = np.full(len(lines) * bins, empty)
    low = np.uint64(0xFFFFFFFF)
    for i in range(2 * bins):
        x = _mixed(hashes + np.uint64((i + 1) * int(_ODD[0]) & int(empty)))
        value = (np.uint64(i) << np.uint64(32)) | (x & low)
        chosen = ((x >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32) if i < bins else np.uint64(i - bins)
        np.minimum.at(least, owner * bins + chosen.astype(np.int64), value)
        open_ = (least.reshape(-1, bins) == empty).any(axis=1)
        if not open_.any():
            break
        still = open_[owner]
        if not still.all():
            hashes, owner = hashes[still], owner[still]
    return least.reshape(-1, bins)


def band_keys(rows: np.ndarray) -> np.ndarray:
    """A signed 64-bit key for each band of each sketch; keys of different bands differ."""
    bands = rows.reshape(len(rows), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(rows), BANDS)).copy()
    for r in range(ROWS):
        keys = _mixed(keys * _ODD[0] + bands[:, :, r])
    return keys.view(np.int64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _sketch_lines(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (id, text_hash, text) a row for each line that is not blank; keys only for lines not seen before."""
    seen: set[int] = set()
    digest = xxhash.xxh64_intdigest
    for frame in frames:
        ids, hashes = frame.column(0).to_pylist(), frame.column(1).to_pylist()
        rows: list[tuple] = []
        fresh_lines: list[str] = []
        for id_, hash_, text in zip(ids, hashes, frame.column(2).to_pylist()):
            for pos, line in enumerate((text or "").split("\n")):
                if not line.strip(_BLANK):
                    continue
                data = line.encode()
                h = digest(data, 42)
                new = h not in seen
                if new:
                    if len(seen) < REMEMBERED_LINES:
                        seen.add(h)
                    fresh_lines.append(line)
                rows.append((id_, hash_, pos, _signed(h), _signed(digest(data, 43)), new))
                if len(fresh_lines) == STEP_LINES or len(rows) == 8 * STEP_LINES:
                    yield _as_batch(rows, fresh_lines)
                    rows, fresh_lines = [], []
        if rows:
            yield _as_batch(rows, fresh_lines)


def _as_batch(rows: list[tuple], lines: list[str]) -> pa.RecordBatch:
    ids, hashes, places, h, tails, new = zip(*rows)
    keys = band_keys(sketches(lines)).ravel() if lines else np.zeros(0, np.int64)
    offsets = np.concatenate(([0], np.cumsum(np.array(new, np.int64) * BANDS))).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(hashes, pa.int64()),
            pa.array(places, pa.int32()),
            pa.array(h, pa.int64()),
            pa.array(tails, pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys, pa.int64())),
        ],
        names=["id", "text_hash", "pos", "line", "tail", "keys"],
    )


def drawn_outlines(lines: list[str], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """For each line how many different shingles it has, and a row of the bits at which their hashes stand."""
    sizes, rows = [np.zeros(0, np.int64)], [np.zeros((0, OUTLINE_BITS // 64), np.uint64)]
    start = 0
    while start < len(lines):
        stop, chars = start, 0
        while stop < len(lines) and stop - start < STEP_LINES and (stop == start or chars + len(lines[stop]) <= STEP_CHARS):
            chars += len(lines[stop])
            stop += 1
        hashes, counts = shingle_hashes(lines[start:stop], width)
        owner = np.repeat(np.arange(stop - start, dtype=np.uint64), counts)
        # One sort of whole numbers: the line above, 54 bits of the hash below.
        marked = np.sort((owner << np.uint64(54)) | (hashes >> np.uint64(10)))
        marked = marked[np.concatenate(([True], marked[1:] != marked[:-1]))]
        owner = (marked >> np.uint64(54)).astype(np.int64)
        sizes.append(np.bincount(owner, minlength=stop - start))
        bits = np.zeros((stop - start, OUTLINE_BITS), bool)
        bits[owner, (marked % np.uint64(OUTLINE_BITS)).astype(np.int64)] = True
        rows.append(np.packbits(bits, axis=1).view(np.uint64))
        start = stop
    return np.concatenate(sizes), np.concatenate(rows)


def outlines(lines: list[str], width: int = SHINGLE) -> list[tuple[int, int]]:
    """``drawn_outlines`` as a size and a whole number for each line."""
    sizes, rows = drawn_outlines(lines, width)
    return [(n, int.from_bytes(row.tobytes(), "big")) for n, row in zip(sizes.tolist(), rows)]


def may_be_similar(x: tuple[int, int], y: tuple[int, int], least: float = SIMILARITY) -> bool:
    """Whether outlines leave it open that two lines are similar: a bit that only one of them has stands for a shingle
    that only it has, so the lines share no more than what is left."""
    (n, a), (m, b) = x, y
    most = min(n - (a & ~b).bit_count(), m - (b & ~a).bit_count())
    return most >= least * (n + m - most)


def _shingles(line: str, width: int = SHINGLE) -> frozenset[str]:
    """The shingles of a line; one that is shorter is its own."""
    return frozenset(line[i : i + width] for i in range(max(1, len(line) - width + 1)))


def similar(x: frozenset[str], y: frozenset[str], least: float = SIMILARITY) -> bool:
    """Whether two sets have a Jaccard similarity of at least ``least``."""
    if min(len(x), len(y)) < least * max(len(x), len(y)):
        return False
    both = len(x & y)
    return both >= least * (len(x) + len(y) - both)


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose texts are similar."""

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        drawn: dict[int, tuple[int, int]] = {}
        known: dict[int, frozenset[str]] = {}
        size = 0

        def shingles(key: int, line: str) -> frozenset[str]:
            nonlocal size
            found = known.get(key)
            if found is None:
                if size > REMEMBERED_SHINGLES:
                    known.clear()
                    size = 0
                found = known[key] = _shingles(line)
                size += len(found)
            return found

        for frame in frames:
            first, second = frame["u"].tolist(), frame["v"].tolist()
            texts = dict(zip(first, strings(frame["a"]))) | dict(zip(second, strings(frame["b"])))
            if len(drawn) > REMEMBERED_OUTLINES:
                drawn.clear()
            new = [key for key in texts if key not in drawn]
            for start in range(0, len(new), STEP_LINES):
                part = new[start : start + STEP_LINES]
                drawn.update(zip(part, outlines([texts[key] for key in part])))
            rows = [
                may_be_similar(drawn[u], drawn[v], least)
                and similar(shingles(u, texts[u]), shingles(v, texts[v]), least)
                for u, v in zip(first, second)
            ]
            yield frame.loc[rows, ["u", "v"]]

    with_first = pairs.join(texts.select(F.col("line").alias("u"), F.col("text").alias("a")), "u")
    with_both = with_first.join(texts.select(F.col("line").alias("v"), F.col("text").alias("b")), "v")
    return with_both.select("u", "v", "a", "b").mapInPandas(apply, "u bigint, v bigint")


def _compared(dealt: DataFrame, least: float) -> DataFrame:
    """Links (u, v) between lines of different roots that meet in a pair (i, j) of blocks of a key."""

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []  # rows whose last pair may go on in the next frame
        for frame in frames:
            held += frame.itertuples(index=False, name=None)
            last = len(held)
            while last and held[last - 1][:3] == held[-1][:3]:
                last -= 1
            yield pd.DataFrame(_links_in(held[:last], least), columns=["u", "v"], dtype="int64")
            held = held[last:]
        yield pd.DataFrame(_links_in(held, least), columns=["u", "v"], dtype="int64")

    ordered = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "line")
    return ordered.mapInPandas(apply, "u bigint, v bigint")


def _links_in(rows: list[tuple], least: float) -> list[tuple[int, int]]:
    """The links among the lines of each block, or between two; lines that are connected already need none."""
    if not rows:
        return []
    lines, roots = [r[4] for r in rows], np.array([r[5] for r in rows])
    own = np.array([r[3] for r in rows])
    text_of = {r[4]: r[6] for r in rows}
    place = {line: n for n, line in enumerate(text_of)}
    at = np.array([place[line] for line in lines])
    sizes, bits = drawn_outlines(list(text_of.values()))
    ones = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    parent = {r[5]: r[5] for r in rows}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    sets: dict[int, frozenset[str]] = {}
    links = []
    for a, b in _pairs(rows, own):
        n, m = sizes[at[a]], sizes[at[b]]
        fit = (roots[a] != roots[b]) & (np.minimum(n, m) >= least * np.maximum(n, m))
        a, b, n, m = a[fit], b[fit], n[fit], m[fit]
        for start in range(0, len(a), STEP_PAIRS):
            some = slice(start, start + STEP_PAIRS)
            x, y, n_some, m_some = at[a[some]], at[b[some]], n[some], m[some]
            both = np.bitwise_count(bits[x] & bits[y]).sum(axis=1, dtype=np.int64)
            most = np.minimum(n_some - (ones[x] - both), m_some - (ones[y] - both))
            possible = start + np.flatnonzero(most >= least * (n_some + m_some - most))
            for i, j in zip(a[possible].tolist(), b[possible].tolist()):
                p, q = root(rows[i][5]), root(rows[j][5])
                if p != q:
                    for line in (lines[i], lines[j]):
                        if line not in sets:
                            sets[line] = _shingles(text_of[line])
                    if similar(sets[lines[i]], sets[lines[j]], least):
                        links.append((lines[i], lines[j]))
                        parent[max(p, q)] = min(p, q)
    return links


def _pairs(rows: list[tuple], own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places of the lines to compare, a step at a time, for rows that are in the order of their pairs of blocks."""
    firsts, seconds, waiting = [], [], 0
    start = 0
    while start < len(rows):
        key = rows[start][:3]
        stop = start + 1
        while stop < len(rows) and rows[stop][:3] == key:
            stop += 1
        if key[1] == key[2]:
            a, b = np.triu_indices(stop - start, 1)
        else:
            second = own[start:stop] == key[2]
            x, y = np.flatnonzero(~second), np.flatnonzero(second)
            a, b = np.repeat(x, len(y)), np.tile(y, len(x))
        firsts.append(start + a)
        seconds.append(start + b)
        waiting += len(a)
        start = stop
        if waiting >= 16 * STEP_PAIRS or start == len(rows):
            yield np.concatenate(firsts), np.concatenate(seconds)
            firsts, seconds, waiting = [], [], 0


def _texts_of(wanted: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """(line, text) for the line hashes in ``wanted`` (line, each once)."""
    lines = docs.select(F.explode(F.split(col(text_col), "\n")).alias("text"))
    lines = lines.select(F.xxhash64("text").alias("line"), "text")
    found = lines.join(broadcast_if_small(wanted), "line")
    return written(found.groupBy("line").agg(F.min("text").alias("text")), "texts")


def deal_out(placed: DataFrame) -> DataFrame:
    """(key, i, j, own, line, root): the lines of ``placed`` (key, line, root) in pairs of blocks that have to be compared.

    The lines of the largest root under a key need no comparison among themselves. Their blocks are paired with those of
    the other lines only, so a stray line among very many copies adds one row for each block of them.
    """
    open_keys = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    open_keys = written(open_keys.select("key"), "open_keys")
    rest = written(placed.join(broadcast_if_small(open_keys), "key"), "open_lines")
    by_root = rest.groupBy("key", "root").agg(F.count("*").alias("n"))
    largest = F.max(F.struct("n", F.col("root")))
    blocks = by_root.groupBy("key").agg(F.sum("n").alias("n"), largest.alias("largest"))
    several = F.ceil((F.col("n") - F.col("largest.n")) / BLOCK_LINES).cast("int")
    blocks = blocks.select(
        "key",
        F.col("largest.root").alias("bulk"),
        several.alias("several"),
        F.ceil(F.col("largest.n") / BLOCK_LINES).cast("int").alias("alike"),
    )
    rest = rest.join(broadcast_if_small(written(blocks, "blocks")), "key")
    place = F.xxhash64("line")
    in_bulk = F.col("root") == F.col("bulk")
    own = F.when(in_bulk, F.col("several") + F.pmod(place, F.col("alike"))).otherwise(F.pmod(place, F.col("several")))
    last = F.when(in_bulk, F.col("several")).otherwise(F.col("several") + F.col("alike")) - 1
    rest = rest.withColumn("own", own.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return rest.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "line", "root")


def line_links(sketched: DataFrame, docs: DataFrame, text_col: str, similarity: float) -> DataFrame:
    """(node, root) for lines that are similar to others, from ``sketched`` (line, keys)."""
    entries = sketched.where(F.size("keys") > 0).select("line", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.min("line").alias("lead"), F.max("line").alias("last"))
    shared = written(shared.where("lead < last").select("key"), "shared_keys")
    members = written(entries.join(broadcast_if_small(shared), "key").distinct(), "members")

    sizes = written(members.groupBy("key").agg(F.count("*").alias("n")), "sizes")
    met = members.join(broadcast_if_small(sizes), "key").groupBy("line").agg(F.sum("n").alias("met"))
    ranked = members.join(broadcast_if_small(written(met, "met")), "line")
    leads = ranked.groupBy("key").agg(F.max(F.struct("met", "line"))["line"].alias("lead"))
    leads = broadcast_if_small(written(leads, "leads"))
    led = members.select("key", "line").join(leads, "key").where("line <> lead")
    leading = led
    leading = leading.select(F.least("lead", "line").alias("u"), F.greatest("lead", "line").alias("v"))
    leading = written(leading.distinct(), "leading")
    nodes = members.select("line").distinct()
    texts = _texts_of(written(nodes, "nodes"), docs, text_col)
    links = written(_verified(leading, texts, similarity), "links")
    roots = written(components(links), "roots")

    # Leaders have been compared with all others of their key.
    placed = led.select("key", "line").join(broadcast_if_small(roots), F.col("line") == F.col("node"), "left")
    placed = written(placed.select("key", "line", F.coalesce("root", "line").alias("root")), "placed")
    dealt = deal_out(placed).join(texts, "line")
    dealt = dealt.select("key", "i", "j", "own", "line", "root", "text")
    more = written(_compared(dealt, similarity).distinct(), "more_links")
    if more.limit(1).count() == 0:
        return roots
    stars = roots.select(F.col("node").alias("u"), F.col("root").alias("v"))
    return written(components(stars.union(more)), "roots")


def copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """(id, text_hash, n_lines, n_copies, copies) for each document with a line that is not blank; ``copies`` are the
    places (from 0) of the lines that go."""
    narrow = docs.select(
        col(id_col).cast("bigint").alias("id"), text_hash(col(text_col)).alias("text_hash"), col(text_col).alias("text")
    )
    schema = "id bigint, text_hash bigint, pos int, line bigint, tail bigint, keys array<bigint>"
    sketched = written(narrow.mapInArrow(_sketch_lines, schema), "sketched")
    roots = broadcast_if_small(line_links(sketched.select("line", "keys"), docs, text_col, similarity))
    lines = sketched.drop("keys").join(roots, F.col("line") == F.col("node"), "left")
    group = {"root": F.coalesce("root", "line"), "tail": F.when(F.col("root").isNull(), F.col("tail")).otherwise(0)}
    lines = lines.withColumns(group).withColumn("place", F.struct("id", "text_hash", "pos"))
    groups = lines.groupBy("root", "tail").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    groups = written(groups.where(~F.col("first").eqNullSafe(F.col("last"))).drop("last"), "groups")
    joined = lines.select("root", "tail", "place").join(broadcast_if_small(groups), ["root", "tail"])
    gone = joined.where(~F.col("place").eqNullSafe(F.col("first"))).select("place.*").distinct()
    return written(gone.groupBy("id", "text_hash").agg(F.sort_array(F.collect_list("pos")).alias("copies")), "copies")


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, counts: bool = False
) -> DataFrame:
    """``docs`` without the lines that are copies; with ``counts`` also ``n_lines`` (not blank ones) and ``n_copies``."""
    gone = broadcast_if_small(copies(docs, id_col, text_col, similarity))
    id_, hash_, places = (fresh(c, docs) for c in ("gone_id", "gone_hash", "gone_places"))
    gone = gone.select(F.col("id").alias(id_), F.col("text_hash").alias(hash_), F.col("copies").alias(places))
    same = col(id_col).cast("bigint").eqNullSafe(F.col(id_)) & (text_hash(col(text_col)) == F.col(hash_))
    joined = docs.join(gone, same, "left")
    out = joined
    if counts:
        full = F.regexp_count(col(text_col), F.lit(f"[^{_BLANK}][^\n]*"))
        out = out.withColumn("n_lines", F.coalesce(full, F.lit(0)).cast("bigint"))
        out = out.withColumn("n_copies", F.greatest(F.size(places), F.lit(0)).cast("bigint"))
    lines = fresh("lines", out)
    split = F.when(F.col(places).isNotNull(), F.split(col(text_col), "\n"))
    kept = F.coalesce(_without(F.col(lines), F.col(places)), col(text_col))
    return out.withColumn(lines, split).withColumn(text_col, kept).drop(id_, hash_, places, lines)


def _without(lines: Column, places: Column) -> Column:
    """The text of ``lines`` without those at ``places``, which are sorted; null if either is."""
    before = F.concat(F.array(F.lit(-1)), places)
    behind = F.concat(places, F.array(F.size(lines)))
    stretches = F.zip_with(before, behind, lambda last, following: F.slice(lines, last + 2, following - last - 1))
    return F.array_join(F.flatten(stretches), "\n")
