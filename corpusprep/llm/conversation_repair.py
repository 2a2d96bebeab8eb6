"""Conversation structure repair by a dynamic program with square-root checkpoints.

A conversation is repaired when the initials of its roles read ``(s?(ua)+)?``. Its rows are kept, given another role, or
deleted, and empty turns are inserted. Blank rows and repeats must go. The cheapest edits are found by a shortest path over
four states: nothing yet, after a system turn, after a user turn, after an assistant turn. The cost of what is still to come
is worked out from the end, walking backward; the edits are read off walking forward, taking in each state the edit whose
initial comes first in ASCII among those that lose nothing (the tight ones). Each initial leads to one state, so this gives
the least string of all that cost the same.

Walking forward needs the cost vectors that walking backward has passed. Only those at checkpoints are stored, one for each
square root of the number of rows; the vectors of a block between two checkpoints are worked out again when the walk
reaches it.

Rows are sorted over the cluster by ranges of (conversation, turn, role, text), so one conversation may lie in many tasks.
Conversations in the middle of a task are finished there, one after the other. The first and the last of each task, and
those longer than ``HELD_ROWS``, go on as open rows, since they may continue in another task. They are cut into segments of
``SEGMENT_ROWS`` rows:

1. each segment becomes a matrix, the least cost from each state before it to each state after it;
2. the matrices of a conversation, one small row for each segment, give the cost vectors at the ends of its segments: the
   checkpoints of the whole conversation;
3. each segment is walked forward from every state it may be entered in, by the method above;
4. following the states from segment to segment chooses one walk of each.

So no task holds more than a segment of a long conversation, or one number a row. Whether a row repeats an earlier one is
found by least places for each (conversation, digest), which tasks work out before anything is shuffled. The digest of a
repaired conversation is that of one text from its start to its end; its lines are sorted and pass through one task, which
holds a batch of them at a time.

Defined results: a null role or text is one space. Rows are ordered by turn, nulls first; rows of one turn by role and text.
Rows without a conversation id are one conversation. A role other than system, user and assistant is known by its first
character, and a row whose role is empty has no initial: neither can be kept unless the initial fits. Texts are read whole.
An empty table gives an empty result. Columns that are not named do not matter.
"""

import hashlib
from collections.abc import Iterator
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import WHITESPACE, col
from corpusprep.work import written

BLANK = WHITESPACE.decode()
#: Rows, and characters, of a conversation that a sorting task finishes by itself; longer ones are open. Results do not depend on these.
HELD_ROWS = 20_000
HELD_CHARS = 16_000_000
SEGMENT_ROWS = 16_384
#: Bytes that a sorting task gets.
TASK_BYTES = 16_000_000

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
#: States from which a user turn may follow; an assistant turn follows USER.
_AFTER = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Codes of rows: the initial's number (0 for others), plus 4 if truncated; 8 for rows that must go.
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
GONE = 8
_NAMES = {USER: "user", ASSISTANT: "assistant"}

Vector = tuple[int, int, int, int]
#: Costs at the end of a conversation: what still has to be inserted.
AT_END: Vector = (0, 2 * INSERT, INSERT, 0)


def _inserting(costs: list[int]) -> Vector:
    """The costs when turns may be inserted before going on."""
    s, y, u, a = costs
    user, assistant = min(u, INSERT + a), min(a, INSERT + u)
    return min(s, INSERT + user), min(y, INSERT + user), user, assistant


def _kept_in(state: int, code: int) -> int | None:
    """The state after keeping a row of this code, if it can be kept."""
    role = code & 3
    if role == SYSTEM:
        return SYSTEM if state == START else None
    return role if role and _AFTER[state] == role else None


def before(code: int, after: Vector) -> Vector:
    """The cost vector before a row, from the one after it."""
    if code == GONE:
        s, y, u, a = after
        return s + DELETE, y + DELETE, u + DELETE, a + DELETE
    late = TRUNCATED if code & 4 else 0
    costs = []
    for state in range(4):
        best = min(after[state] + DELETE, after[_AFTER[state]] + REROLE + late)
        kept = _kept_in(state, code)
        costs.append(best if kept is None else min(best, after[kept] + late))
    return _inserting(costs)


def walk(codes: bytes, state: int, end: Vector = AT_END) -> tuple[str, int]:
    """The edits over rows entered in ``state``, ASCII-least among the cheapest, and the state they lead to.

    ``end`` is the cost vector behind the rows. Cost vectors are stored at every checkpoint and worked out again for one
    block at a time.
    """
    step = max(1, int(len(codes) ** 0.5))
    starts = range(0, len(codes), step)
    checkpoints = [end]
    for start in reversed(starts):
        vector = checkpoints[-1]
        for code in reversed(codes[start : start + step]):
            vector = before(code, vector)
        checkpoints.append(vector)
    checkpoints.pop()
    edits: list[str] = []
    for start in starts:
        vectors = [checkpoints.pop()]
        block = codes[start : start + step]
        for code in reversed(block):
            vectors.append(before(code, vectors[-1]))
        left = vectors.pop()
        for code in block:
            after = vectors.pop()
            while True:
                if left[state] == after[state] + DELETE:
                    edits.append("D")
                    break
                following = _AFTER[state]
                if left[state] == left[following] + INSERT:
                    edits.append("I")
                    state = following
                    continue
                late = TRUNCATED if code & 4 else 0
                kept = _kept_in(state, code)
                if kept is not None and left[state] == after[kept] + late:
                    edits.append("K")
                    state = kept
                else:
                    edits.append("R")
                    state = following
                break
            left = after
    return "".join(edits), state


def closing(state: int) -> str:
    """The insertions at the end of a conversation."""
    return "I" * (AT_END[state] // INSERT)


def matrix(codes: bytes) -> list[int]:
    """The least costs from each state before the rows to each state after them, row by row."""
    ends = [tuple(0 if s == end else NEVER for s in range(4)) for end in range(4)]
    columns = []
    for vector in ends:
        for code in reversed(codes):
            vector = before(code, vector)
        columns.append(vector)
    return [columns[end][start] for start in range(4) for end in range(4)]


def repaired(edits: str, state: int, rows: Iterator[tuple[str, str]]) -> Iterator[str]:
    """The lines ``role:text`` that edits leave of rows (role, text) entered in ``state``."""
    for edit in edits:
        if edit == "I":
            state = _AFTER[state]
            yield f"{_NAMES[state]}:"
            continue
        role, text = next(rows)
        if edit == "K":
            state = INITIALS[role[:1]]
            yield f"{role}:{text}"
        elif edit == "R":
            state = _AFTER[state]
            yield f"{_NAMES[state]}:{text}"


_LEGAL = ("su", "ua", "au")
_RESULT = (
    "key string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string,"
    " repaired_sha256 string"
)
_OPEN = "pos bigint, turn bigint, role string, text string, digest binary, fault int"


def _cost(edits: str, codes: bytes) -> int:
    total, at = 0, 0
    for edit in edits:
        if edit == "I":
            total += INSERT
            continue
        total += DELETE if edit == "D" else (REROLE if edit == "R" else 0) + (TRUNCATED if codes[at] & 4 else 0)
        at += 1
    return total


def _gaps(turns: list[int | None]) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def _code(role: str, fault: int) -> int:
    """``fault``: 1 must go, 2 truncated, 0 none."""
    return GONE if fault == 1 else INITIALS.get(role[:1], 0) + (4 if fault == 2 else 0)


def _finished(key: str, rows: list[tuple]) -> tuple:
    """The result for a whole conversation; rows are (pos, turn, role, text, digest, fault) with fault 1 blank, 2 truncated."""
    seen: set[bytes] = set()
    counts = [0, 0, 0]
    codes = bytearray()
    for _, _, role, _, digest, fault in rows:
        repeat = digest in seen
        seen.add(digest)
        if fault == 1 or repeat:
            counts[0 if fault == 1 else 1] += 1
            codes.append(GONE)
        else:
            counts[2] += fault == 2
            codes.append(_code(role, fault))
    initials = [row[2][:1] for row in rows]
    illegal = sum(x + y not in _LEGAL for x, y in zip(initials, initials[1:]))
    edits, state = walk(bytes(codes), START)
    edits += closing(state)
    digest = hashlib.sha256()
    for i, line in enumerate(repaired(edits, START, ((r[2], r[3]) for r in rows))):
        digest.update((("\n" if i else "") + line).encode("utf-8", "surrogatepass"))
    return key, _gaps([r[1] for r in rows]), *counts, illegal, _cost(edits, bytes(codes)), edits, digest.hexdigest()


def _finish_inner(frames: Iterator[pa.RecordBatch], held_rows: int, held_chars: int) -> Iterator[pa.RecordBatch]:
    """Results of the conversations inside a sorted task; the rows of its first and last one, and of long ones, as they are."""
    n_results = _RESULT.count(",") + 1
    n_open = _OPEN.count(",") + 1
    schema = pa.schema(
        [(f.split()[0], pa.string() if f.split()[1] == "string" else pa.int64()) for f in _RESULT.split(",")]
        + [("pos", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("digest", pa.binary()), ("fault", pa.int32())]
    )
    ready: list[tuple] = []
    size = 0

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def as_open(key: str, rows: list[tuple]) -> list[tuple]:
        return [(key, *[None] * (n_results - 1), *row) for row in rows]

    current: str | None = None
    held: list[tuple] | None = None  # None: the rows of this conversation are open
    chars = 0
    for frame in frames:
        for key, *rest in zip(*(c.to_pylist() for c in frame.columns)):
            if key != current:
                if held is not None and current is not None:
                    ready.append(_finished(current, held) + (None,) * n_open)
                held, chars = (None if current is None else []), 0
                current = key
            row = tuple(rest)
            if held is not None:
                held.append(row)
                chars += len(row[3])
                if len(held) > held_rows or chars > held_chars:
                    ready += as_open(key, held)
                    held, size = None, size + chars
            else:
                ready += as_open(key, [row])
                size += len(row[3])
            if len(ready) >= 2_000 or size > 4_000_000:
                yield out(ready)
                ready, size = [], 0
    if held:
        ready += as_open(current, held)
    if ready:
        yield out(ready)


def _frame(columns: dict) -> pd.DataFrame:
    """A frame of plain Python values, which Arrow takes as they are."""
    return pd.DataFrame({name: pd.Series(list(values), dtype=object) for name, values in columns.items()})


def _sha(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, repaired_sha256) from the lines of conversations, sorted by key and place."""
    current, digest = None, None
    for frame in frames:
        done: list[tuple[str, str]] = []
        for key, line in zip(frame["key"].tolist(), frame["line"].tolist()):
            if key != current:
                if current is not None:
                    done.append((current, digest.hexdigest()))
                current, digest = key, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(line.encode("utf-8", "surrogatepass"))
        yield _frame({"key": [k for k, _ in done], "repaired_sha256": [h for _, h in done]})
    if current is not None:
        yield _frame({"key": [current], "repaired_sha256": [digest.hexdigest()]})


def _segment(frame: pd.DataFrame) -> pd.DataFrame:
    """One row for a segment: its matrix, counts, and what its neighbours need to know of its ends."""
    frame = frame.sort_values("pos")
    codes = bytes(frame["code"].tolist())
    initials, kinds = frame["initial"].tolist(), frame["kind"].tolist()
    turns = frame["turn"].dropna()
    low, high = (int(turns.min()), int(turns.max())) if len(turns) else (None, None)
    return _frame(
        {
            "key": [frame["key"].iloc[0]],
            "segment": [int(frame["segment"].iloc[0])],
            "matrix": [matrix(codes)],
            "blank": [kinds.count(1)],
            "duplicate": [kinds.count(2)],
            "truncated": [kinds.count(3)],
            "illegal": [sum(x + y not in _LEGAL for x, y in zip(initials, initials[1:]))],
            "first": [initials[0]],
            "last": [initials[-1]],
            "low": [low],
            "high": [high],
            "distinct": [int(turns.nunique())],
        }
    )


def _ends(frame: pd.DataFrame) -> pd.DataFrame:
    """The cost vector behind each segment of a conversation, by its matrices from the last to the first."""
    frame = frame.sort_values("segment")
    vector, found = AT_END, []
    for m in reversed(frame["matrix"].tolist()):
        found.append(list(vector))
        vector = tuple(min(int(m[4 * s + e]) + vector[e] for e in range(4)) for s in range(4))
    return _frame({"key": frame["key"], "segment": frame["segment"], "end": found[::-1]})


def _walks(frame: pd.DataFrame) -> pd.DataFrame:
    """The edits of a segment, and the state they lead to, for every state it may be entered in."""
    frame = frame.sort_values("pos")
    codes = bytes(frame["code"].tolist())
    end = tuple(int(x) for x in frame["end"].iloc[0])
    found = [walk(codes, state, end) for state in range(4)]
    return _frame(
        {
            "key": [frame["key"].iloc[0]],
            "segment": [int(frame["segment"].iloc[0])],
            "edits": [[e for e, _ in found]],
            "leads": [[s for _, s in found]],
            "costs": [[_cost(e, codes) for e, _ in found]],
        }
    )


def _chained(frame: pd.DataFrame) -> pd.DataFrame:
    """For each segment of a conversation the state it is entered in; the last also has the insertions at the end."""
    frame = frame.sort_values("segment")
    state, entered = START, []
    for leads in frame["leads"]:
        entered.append(state)
        state = int(leads[state])
    tails = [""] * (len(entered) - 1) + [closing(state)]
    return _frame({"key": frame["key"], "segment": frame["segment"], "state": entered, "tail": tails})


def _lines(frame: pd.DataFrame) -> pd.DataFrame:
    """The repaired lines of a segment."""
    frame = frame.sort_values("pos")
    rows = zip(frame["role"].tolist(), frame["text"].tolist())
    lines = list(repaired(frame["edits"].iloc[0], int(frame["state"].iloc[0]), rows))
    n = len(lines)
    return _frame({"key": [frame["key"].iloc[0]] * n, "segment": [int(frame["segment"].iloc[0])] * n, "n": range(n), "line": lines})


def _finish_open(rows: DataFrame, segment_rows: int) -> DataFrame:
    """The results of open conversations, from their rows (key and the columns of ``_OPEN``)."""
    first = rows.groupBy("key", "digest").agg(F.min("pos").alias("least"))
    fault = F.col("fault")
    kind = F.when(fault == 1, 1).when(F.col("pos") > F.col("least"), 2).when(fault == 2, 3).otherwise(0)
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(0)
    code = F.when(F.col("kind").isin(1, 2), GONE).otherwise(role + F.when(F.col("kind") == 3, 4).otherwise(0))
    # Places count on from the start of a task, so rows of equal quotient are neighbours.
    rows = rows.withColumn("segment", F.expr(f"pos div {segment_rows}"))
    coded = rows.join(first, ["key", "digest"]).withColumns({"kind": kind, "initial": initial}).withColumn("code", code)
    coded = written(coded.select("key", "segment", "pos", "turn", "initial", "kind", "code"), "coded")
    schema = (
        "key string, segment bigint, matrix array<bigint>, blank bigint, duplicate bigint, truncated bigint, illegal bigint,"
        " first string, last string, low bigint, high bigint, distinct bigint"
    )
    segments = written(coded.groupBy("key", "segment").applyInPandas(_segment, schema), "segments")
    matrices = segments.select("key", "segment", "matrix")
    ends = matrices.groupBy("key").applyInPandas(_ends, "key string, segment bigint, end array<bigint>")
    walks = coded.select("key", "segment", "pos", "code").join(ends, ["key", "segment"]).groupBy("key", "segment")
    walks = walks.applyInPandas(
        _walks, "key string, segment bigint, edits array<string>, leads array<bigint>, costs array<bigint>"
    )
    walks = written(walks, "walks")
    entered = walks.select("key", "segment", "leads").groupBy("key").applyInPandas(
        _chained, "key string, segment bigint, state int, tail string"
    )
    chosen = walks.join(entered, ["key", "segment"]).select(
        "key",
        "segment",
        "state",
        F.concat(F.get("edits", F.col("state")), "tail").alias("edits"),
        (F.get("costs", F.col("state")) + INSERT * F.length("tail")).alias("cost"),
    )
    chained = written(chosen, "chained")
    lines = rows.select("key", "segment", "pos", "role", "text").join(chained, ["key", "segment"])
    lines = lines.groupBy("key", "segment").applyInPandas(_lines, "key string, segment bigint, n bigint, line string")
    lines = lines.repartition("key").sortWithinPartitions("key", "segment", "n").select("key", "line")
    hashes = lines.mapInPandas(_sha, "key string, repaired_sha256 string")

    ordered = F.array_sort(F.collect_list(F.struct("segment", "first", "last", "low", "high")))
    facts = segments.groupBy("key").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "distinct")),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        ordered.alias("parts"),
    )
    pairs = F.transform(F.sequence(F.lit(1), F.size("parts") - 1), lambda i: F.struct(
        F.concat(F.get("parts", i - 1)["last"], F.get("parts", i)["first"]).alias("roles"),
        F.coalesce(F.get("parts", i - 1)["high"] == F.get("parts", i)["low"], F.lit(False)).alias("same_turn"),
    ))
    pairs = F.when(F.size("parts") > 1, pairs).otherwise(F.array().cast("array<struct<roles:string,same_turn:boolean>>"))
    facts = facts.withColumn("pairs", pairs)
    illegal = F.col("illegal") + F.size(F.filter("pairs", lambda p: ~p["roles"].isin(*_LEGAL)))
    distinct = F.col("distinct") - F.size(F.filter("pairs", lambda p: p["same_turn"]))
    facts = facts.select(
        "key",
        F.coalesce(F.col("high") - F.col("low") + 1 - distinct, F.lit(0)).alias("gaps"),
        "blank",
        "duplicate",
        "truncated",
        illegal.cast("bigint").alias("illegal"),
    )
    audits = chained.groupBy("key").agg(
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "edits"))), lambda s: s["edits"]), "").alias(
            "audit"
        ),
    )
    empty = F.sha2(F.lit(""), 256)
    joined = facts.join(audits, "key").join(hashes, "key", "left")
    return joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", empty))


def _keyed(id_: Column) -> Column:
    """A conversation's id as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), id_.cast("string")), F.lit(""))


def repair(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    held_rows: int = HELD_ROWS,
    held_chars: int = HELD_CHARS,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """(conv_col, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for each conversation of ``rows``."""
    role, text = (F.coalesce(col(c), F.lit(" ")) for c in (role_col, text_col))
    plain = rows.select(
        _keyed(col(conv_col)).alias("key"), col(turn_col).cast("bigint").alias("turn"), role.alias("role"), text.alias("text")
    )
    trimmed = F.rtrim("text", F.lit(BLANK))
    fault = F.when(trimmed == "", 1).when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), 2).otherwise(0)
    length = F.coalesce(F.sum(F.octet_length("text") + F.octet_length("role") + 100), F.lit(0))
    tasks = max(plain.sparkSession.sparkContext.defaultParallelism, -(-plain.agg(length).first()[0] // TASK_BYTES))
    # Long texts stay out of the sample that the ranges are taken from.
    ranges = [F.col("key"), F.asc_nulls_first("turn"), F.col("role"), F.substring("text", 1, 32)]
    ordered = plain.repartitionByRange(tasks, *ranges)
    ordered = ordered.sortWithinPartitions("key", F.asc_nulls_first("turn"), "role", "text")
    named = F.concat_ws(":", F.length("role"), "role", "text")
    placed = ordered.select(
        "key",
        F.monotonically_increasing_id().alias("pos"),
        "turn",
        "role",
        "text",
        F.unhex(F.sha2(named, 256)).alias("digest"),
        fault.alias("fault"),
    )
    finish = partial(_finish_inner, held_rows=held_rows, held_chars=held_chars)
    done = written(placed.mapInArrow(finish, f"{_RESULT}, {_OPEN}"), "conversations")
    inner = done.where("pos IS NULL").select(*(c.split()[0] for c in _RESULT.split(",")))
    rest = done.where("pos IS NOT NULL").select("key", *(c.split()[0] for c in _OPEN.split(",")))
    both = inner.unionByName(_finish_open(rest, segment_rows))
    id_ = F.when(F.col("key") != "", F.substring("key", 2, 2**31 - 1)).cast(rows.select(col(conv_col)).schema[0].dataType)
    return both.select(id_.alias(conv_col), *(c for c in both.columns if c != "key"))


def damage(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``rows`` with faults by the checksum of conversation and turn: of 20 kinds, 0 drops a row, 1 empties its text, 2
    takes out its sentence ends, 3 repeats it, 4 makes it the user's. Nulls count as one space."""
    space = F.lit(" ")
    name = F.concat_ws(":", *(F.coalesce(col(c).cast("string"), space) for c in (conv_col, turn_col)))
    kind = F.crc32(F.encode(name, "utf-8")) % 20
    role, text = F.coalesce(col(role_col), space), F.coalesce(col(text_col), space)
    damaged = rows.select(
        col(conv_col),
        col(turn_col),
        F.when(kind == 4, "user").otherwise(role).alias(role_col),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias(text_col),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )
    copies = F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("copy")
    return damaged.select(*damaged.columns, copies).drop("times", "copy")


def with_all(result: DataFrame, rows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``result`` with a row of zeros for each conversation of ``rows`` that has lost all its rows."""
    names = rows.select(col(conv_col)).distinct()
    other = result.withColumnRenamed(conv_col, "_conv")
    joined = names.join(other, col(conv_col).eqNullSafe(F.col("_conv")), "left").drop("_conv")
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return joined.withColumns(
        counts
        | {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))}
    )
