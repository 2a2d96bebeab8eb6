import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import cache

import pytest
from pyspark.sql import functions as F

from corpusprep.llm import conversation_repair as cr
from corpusprep.llm.queries import op11_conversation_repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?")
BLANK = " \t\n\x0b\x0c\r"


def faults(rows):
    """The first fault of each row (turn, role, text)."""
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip(BLANK)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def in_order(rows):
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def plain(rows):
    """The result for one conversation: a forward search that keeps the least (cost, audit) with its lines."""
    rows = in_order(rows)
    found = faults(rows)
    best = {"": (0, "", ())}  # by role initials so far, cut to what the grammar needs: the last one, and none at all

    def put(table, roles, entry):
        if roles not in table or entry[:2] < table[roles][:2]:
            table[roles] = entry

    def grown(roles, initial):
        if initial == "s":
            return "s" if roles == "" else None
        if initial == "u":
            return "u" if roles in ("", "s", "a") else None
        return "a" if initial == "a" and roles == "u" else None

    def inserted(table):
        out = dict(table)
        for _ in range(3):
            for roles, (cost, audit, lines) in list(out.items()):
                for name in ("user", "assistant"):
                    if (new := grown(roles, name[0])) is not None:
                        put(out, new, (cost + 3, audit + "I", lines + (f"{name}:",)))
        return out

    for (_, role, text), fault in zip(rows, found):
        after = {}
        for roles, (cost, audit, lines) in inserted(best).items():
            put(after, roles, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            late = 3 * (fault == "truncated")
            if (new := grown(roles, role[:1])) is not None:
                put(after, new, (cost + late, audit + "K", lines + (f"{role}:{text}",)))
            for name in ("user", "assistant"):
                if (new := grown(roles, name[0])) is not None:
                    put(after, new, (cost + late + 3, audit + "R", lines + (f"{name}:{text}",)))
        best = after
    ends = [e for roles, e in inserted(best).items() if roles in ("", "a")]
    cost, audit, lines = min(ends, key=lambda e: e[:2])
    turns = {t for t, *_ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        found.count("blank"), found.count("duplicate"), found.count("truncated"),
        sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def grouped(rows):
    found = defaultdict(list)
    for conv, *row in rows:
        found[conv].append(tuple(row))
    return found


def results(frame):
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv_id"]: tuple(r[c] for c in columns) for r in frame.collect()}


def random_rows(rnd, n_conv, longest):
    texts = ["Yes.", "No!", "Why?", "well", " ", "", "and so on \n", "Fine. \t", "é…", "🙂."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"]
    rows = []
    for conv in range(n_conv):
        for i in range(rnd.randrange(1, longest)):
            turn = None if rnd.random() < 0.03 else i + rnd.randrange(3)
            text = None if rnd.random() < 0.02 else rnd.choice(texts) + ("" if rnd.random() < 0.4 else f"{i}.")
            rows.append((conv, turn, rnd.choice(roles[: rnd.choice((2, 5, 9))]), text))
    return rows


@cache
def all_audits(codes):
    """Cost and audit of every way to edit up to four rows, with up to three insertions at each place."""
    best = (4 * len(codes), "D" * len(codes))  # what deleting everything costs

    def go(i, roles, cost, audit, room):
        nonlocal best
        if cost > best[0]:
            return
        if i == len(codes) and GOOD.fullmatch(roles):
            best = min(best, (cost, audit))
        if room:
            for x in "ua":
                go(i, roles + x, cost + 3, audit + "I", room - 1)
        if i < len(codes):
            initial, fault = codes[i]
            go(i + 1, roles, cost + 4, audit + "D", 3)
            if fault != "gone":
                late = 3 * (fault == "truncated")
                go(i + 1, roles + initial, cost + late, audit + "K", 3)
                for x in "ua":
                    go(i + 1, roles + x, cost + late + 3, audit + "R", 3)

    go(0, "", 0, "", 3)
    return best


def test_walk_finds_the_least_of_all_edits():
    rnd = random.Random(1)
    for _ in range(150):
        rows = tuple((rnd.choice("suax"), rnd.choice(("", "", "truncated", "gone"))) for _ in range(rnd.randrange(5)))
        codes = bytes(cr.GONE if f == "gone" else cr.INITIALS.get(x, 0) + 4 * (f == "truncated") for x, f in rows)
        edits, state = cr.walk(codes, cr.START)
        edits += cr.closing(state)
        assert (cr._cost(edits, codes), edits) == all_audits(rows)


def test_checkpoints_and_matrices_agree_with_one_long_vector():
    rnd = random.Random(2)
    codes = bytes(rnd.choice((0, 1, 2, 3, 4, 5, 6, 7, 8)) for _ in range(5_000))
    vector = cr.AT_END
    for code in reversed(codes):
        vector = cr.before(code, vector)
    m = cr.matrix(codes)
    assert vector == tuple(min(m[4 * s + e] + cr.AT_END[e] for e in range(4)) for s in range(4))
    for state in range(4):
        edits, last = cr.walk(codes, state)
        assert cr._cost(edits, codes) + cr.AT_END[last] == vector[state]


@pytest.mark.parametrize("limits", [{}, {"held_rows": 4, "segment_rows": 3}, {"held_rows": 0, "segment_rows": 7}])
def test_against_a_plain_version(spark, limits):
    rows = random_rows(random.Random(3), 60, 25)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert results(cr.repair(frame, **limits)) == {c: plain(r) for c, r in grouped(rows).items()}


def test_one_conversation_over_many_tasks(spark):
    rows = random_rows(random.Random(4), 3, 30)
    rnd = random.Random(5)
    rows += [(77, i, rnd.choice(("user", "assistant")), f"line {rnd.randrange(900)}{rnd.choice(('.', ''))}") for i in range(3_000)]
    rows += [(78, 5, "user", "the same row.")] * 500 + [(None, None, None, None), (None, 2, "user", "Hi."), (None, 3, "assistant", "Hi.")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("key", "pos", "fault", "segment", "n")})
    assert results(cr.repair(frame, segment_rows=64)) == {c: plain(r) for c, r in grouped(rows).items()}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def test_query(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left = grouped(damaged(rows))
    assert results(op11_conversation_repair(spark, data)) == {c: plain(left[c]) for c in grouped(rows)}


def test_damage_of_odd_rows_and_lost_conversations(spark):
    rows = random_rows(random.Random(6), 80, 4) + [(None, None, None, None), (None, None, "user", None)]
    lost = next(i for i in range(10**6, 2 * 10**6) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows += [(lost, 0, "user", "gone.")]
    frame = spark.createDataFrame(rows, SCHEMA)
    left = grouped(damaged(rows))
    found = results(cr.with_all(cr.repair(cr.damage(frame)), frame))
    assert found == {c: plain(left[c]) for c in grouped(rows)}
    assert found[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cr.with_all(cr.repair(cr.damage(none)), none).count() == 0
