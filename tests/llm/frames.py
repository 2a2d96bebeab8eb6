"""Documents and pages with everything that may be odd about them, and plain versions of what operators compute."""

import re
from collections import defaultdict

from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}x{i % 89}" for i in range(60_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards make toxic brew for the evil queen and jack"

#: Names that operators use inside.
CLASHES = (
    "id", "fp", "text_hash", "row", "node", "root", "coded", "overlap", "verdict", "lines", "pos", "keys", "gone_id",
    "gone_places", "shared_id", "extracted", "page_hash", "findings", "key", "u", "v", "label", "digest", "payload", "_row",
)

DOCUMENTS = [
    (1, PROSE + "\n" + PROSE[::-1], "en", "a", 1),
    (2, PROSE + "\n" + PROSE[::-1], "en", "a", 1),
    (2, PROSE + "\n" + PROSE[::-1], "en", "a", 1),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \t\n ", "en", "a", 4),
    (6, LONG, "xx", "b", len(LONG)),
    (None, "no id here at all", "en", None, 3),
    (None, PROSE, None, None, 3),
    (7, "É ß 🙂 \U0003250f ՘ á\r\nx", "fr", "c", 5),
    (7, "the same id with another text", "en", "c", 5),
]
DOCUMENT_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def odd_documents(spark, clashes=True):
    docs = spark.createDataFrame(DOCUMENTS, DOCUMENT_SCHEMA)
    return docs.withColumns({c: F.lit("clash") for c in CLASHES}) if clashes else docs


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENT_SCHEMA)


def components(nodes, links):
    """Node to the smallest node that can be reached."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def without_copied_lines(docs, width=7, least=0.8):
    """(id, text) pairs without copied lines, by comparing all lines that share a shingle."""
    places = defaultdict(set)
    for id_, text in docs:
        for pos, line in enumerate((text or "").split("\n")):
            if line.strip(" \t\n\x0b\x0c\r"):
                places[line].add((id_, pos))
    lines = list(places)
    sets = [{x[i : i + width] for i in range(max(1, len(x) - width + 1))} for x in lines]
    having, links = defaultdict(list), []
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for j in having[g]:
                shared[j] += 1
            having[g].append(i)
        links += [(i, j) for j, n in shared.items() if n >= least * (len(s) + len(sets[j]) - n)]
    roots = components(range(len(lines)), links)
    first = {}
    for i, line in enumerate(lines):
        first[roots[i]] = min(first.get(roots[i], min(places[line])), min(places[line]))
    gone = {p for i, line in enumerate(lines) for p in places[line] if p != first[roots[i]]}
    return [
        (d, None if t is None else "\n".join(x for pos, x in enumerate(t.split("\n")) if (d, pos) not in gone)) for d, t in docs
    ]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def hit_words(text, items, window=10):
    """(number of words, places of the hit ones, ids of the items) by trying every window at every place."""
    words = [lowered(w) for w in WORD.findall(text or "")]
    hit, found = set(), set()
    for item, passage in items:
        phrase = [lowered(w) for w in WORD.findall(passage or "")]
        for start in range(max(1, len(phrase) - window + 1) if phrase else 0):
            part = phrase[start : start + window]
            for at in range(len(words) - len(part) + 1):
                if words[at : at + len(part)] == part:
                    hit.update(range(at, at + len(part)))
                    found.add(str(item))
    return len(words), sorted(hit), sorted(found)


def cut_words(text, hit):
    """The text without the runs of hit words."""
    places = [m.span() for m in WORD.finditer(text or "")]
    out, at, k = [], 0, 0
    while k < len(hit):
        end = k
        while end + 1 < len(hit) and hit[end + 1] == hit[end] + 1:
            end += 1
        out.append(text[at : places[hit[k]][0]])
        at, k = places[hit[end]][1], end + 1
    return text if text is None else "".join(out) + text[at:]
