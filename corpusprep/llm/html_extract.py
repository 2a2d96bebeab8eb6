"""Main text of web pages: page differencing against the page with the nearest address, and what the markup says.

Pages of a host stand in the order of their paths. Each page is compared with the neighbour whose path shares the longer
beginning with its own (the one before, if both are equal): the longest common subsequence of their text lines is what the
two have in common, menus and notices rather than text, and is deleted. A page whose lines are all found in its neighbour
is a copy of it, and nothing is deleted.

Markup goes first. Lines inside elements that by their name, role or class are menus, headers, footers, sidebars, notices,
adverts, forms or comments are never text. Where the page says what its article is (``article``, else ``main``), the
article is the text, and a line of it that the neighbour quotes stays. Elsewhere differencing decides: on pages without
an article, among the lines of several articles, and, where markup drops every line, among all lines, if the neighbour
shares any. An article inside a dropped element counts only on pages that have no other, and only if that element is
a form, a div or a paragraph not marked as holding other texts (comments, related, sidebar and the like), or was left open.

The neighbours' lines are compared by hash, so only addresses and hashes move. Hosts are not groups: all pages are sorted
by range partitioning into one order, which is cut into blocks of ``BLOCK`` pages that share their outermost pages; so a
host with a third of all pages is spread as evenly as others. Pages are extracted where they are read.

Defined results: a null page counts as empty; a page without text gives an empty text. Pages without an address are a
host of their own. Texts of any length are read whole. Rows that are equal in id and page get equal results. An empty
table gives an empty result. Other columns of the input stay; those with the names of the results are replaced.
"""

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.llm.common import col, fresh, strings, text_hash
from corpusprep.work import broadcast_if_small, written

BLOCK = 500
#: Cells of an alignment that is worked out in one piece.
ALIGN_CELLS = 400_000_000

#: Names of elements.
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary "
    "table tbody tfoot thead tr ul".split()
)
NOT_TEXT = frozenset(
    "nav header footer aside form menu head button select option svg dialog canvas object audio video math fieldset search".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NOT_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog toolbar".split())
NOT_TEXT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr header masthead menu menubar modal nav navbar navigation newsletter notice pager pagination popup promo "
    "promoted promotion related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe toolbar "
    "topbar widget".split()
)

#: Marks of elements whose articles are not the page's own.
OTHERS_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising comment comments disqus newsletter promo promoted promotion related "
    "replies reply respond sidebar social sponsor sponsored widget".split()
)
OTHERS_ROLES = frozenset(("complementary", "navigation"))

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)[^>]*>|<[!?][^>]*>",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")

#: SEVERAL: in one of several articles that stand side by side.
DROPPED, OPEN, MAIN, ARTICLE, SEVERAL = range(5)


def _is_boilerplate(name: str, attributes: str) -> bool:
    if name in NOT_TEXT:
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    if _HIDDEN.search(attributes):
        return True
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if key.lower() == "role":
            if value.strip() in NOT_TEXT_ROLES:
                return True
        elif not NOT_TEXT_WORDS.isdisjoint(_PARTS.split(value)):
            return True
    return False


def _holds_others(name: str, attributes: str) -> bool:
    """Whether articles inside this dropped element are not the page's own, even if the page has no other."""
    if name == "aside":
        return True
    return any(
        "".join(values).lower().strip() in OTHERS_ROLES
        if key.lower() == "role"
        else not OTHERS_WORDS.isdisjoint(_PARTS.split("".join(values).lower()))
        for key, *values in _ATTRIBUTE.findall(attributes)
    )


def lines_of(page: str | None) -> tuple[list[str], list[int]]:
    """The text lines of a page (one per block with text, in page order) and what each is: dropped by its markup, inside
    the article, inside the main element, inside one of several articles, or open."""
    page = page or ""
    lines: list[str] = []
    kinds: list[int] = []
    text: list[str] = []
    # Open elements that matter, and the kind of what is in them; negative in an article inside a dropped element.
    stack: list[tuple[str, int]] = []
    holders: list[tuple[int, bool]] = []  # places in the stack of what is dropped, and whether it holds other texts
    needs: list[frozenset] = []  # for each line, the names that must have been left open for its negative kind to count
    need: frozenset = frozenset()
    numbers: list[int] = []  # for each line, the number of its article
    article = 0
    left_open: set[str] = set()
    kind = OPEN

    def flush() -> None:
        if text:
            line = " ".join("".join(text).split())
            if line:
                lines.append(line)
                kinds.append(kind)
                needs.append(need)
                numbers.append(article)
            text.clear()

    at = 0
    while True:
        tag = _TAG.search(page, at)
        if tag is None:
            text.append(html.unescape(page[at:]))
            break
        if tag.start() > at:
            text.append(html.unescape(page[at : tag.start()]))
        at = tag.end()
        name = tag[2] or tag[5]
        if name is None:
            continue
        name, closing, attributes = name.lower(), tag[1] or tag[4], tag[3] or ""
        if name in RAW and not closing:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in BLOCKS:
            flush()
        elif name in ("br", "td", "th"):
            text.append(" ")
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    flush()
                    left_open.update(n for n, _ in stack[depth + 1 :])
                    del stack[depth:]
                    break
        elif name not in VOID:
            if name in BLOCKS and stack and stack[-1][0] == "p":
                stack.pop()
            within = stack[-1][1] if stack else OPEN
            while holders and holders[-1][0] >= len(stack):
                holders.pop()
            if name == "article" and within != DROPPED:
                if abs(within) != ARTICLE:
                    article += 1
                stack.append((name, ARTICLE if within > 0 else -ARTICLE))
            elif name == "main" and within == OPEN:
                stack.append((name, MAIN))
            elif name in ("article", "main") and within == DROPPED and _may_be_own(stack, holders):
                if name == "article":
                    article += 1
                need = frozenset(stack[i][0] for i, _ in holders) - {"form", "div", "p"}
                stack.append((name, -ARTICLE if name == "article" else -MAIN))
            elif name in HEADINGS and within == DROPPED and _title_in_article(stack):
                stack.append((name, next(k for _, k in reversed(stack) if k != DROPPED)))
            elif _is_boilerplate(name, attributes):
                flush()
                holders.append((len(stack), _holds_others(name, attributes)))
                stack.append((name, DROPPED))
            elif name in BLOCKS and name not in ("p", "li", "dt", "dd", "tr", "tbody", "thead", "tfoot", "html"):
                stack.append((name, within))
        kind = stack[-1][1] if stack else OPEN
    flush()
    left_open.update(n for n, _ in stack)
    own = any(k >= MAIN for k in kinds)
    kinds = [k if k >= 0 else -k if not own and n <= left_open else DROPPED for k, n in zip(kinds, needs)]
    if len({n for k, n in zip(kinds, numbers) if k == ARTICLE}) > 1:
        kinds = [SEVERAL if k == ARTICLE else k for k in kinds]
    return lines, kinds


def _may_be_own(stack: list[tuple[str, int]], holders: list[tuple[int, bool]]) -> bool:
    """Whether an article that starts here inside dropped elements may be the page's own, if there is no other."""
    return not any(others for _, others in holders) and all(DROPPED <= k <= MAIN for _, k in stack)


def _title_in_article(stack: list[tuple[str, int]]) -> bool:
    """Whether the only thing that drops what comes is the header of an article, whose headings are text."""
    start = max((i + 1 for i, (_, k) in enumerate(stack) if k < 0), default=0)
    dropped = [i for i, (_, k) in enumerate(stack) if k == DROPPED and i >= start]
    first = dropped[0]
    return stack[first][0] == "header" and first > 0 and abs(stack[first - 1][1]) == ARTICLE and all(
        stack[i][0] in ("header", "div") for i in dropped
    )


def _lengths(a: list, b: list) -> list[int]:
    """Bit vectors of the longest common subsequences of the beginnings of ``a`` with those of ``b``: a zero at j where
    one more line of ``b`` makes it longer."""
    masks: dict = defaultdict(int)
    for j, y in enumerate(b):
        masks[y] |= 1 << j
    full = (1 << len(b)) - 1
    v, rows = full, []
    for x in a:
        u = v & masks.get(x, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    return rows


def shared_lines(a: list, b: list) -> list[int]:
    """The places in ``a`` of a longest common subsequence of ``a`` and ``b``."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    middle = _aligned(a[start : len(a) - end], b[start : len(b) - end])
    return [*range(start), *(start + i for i in middle), *range(len(a) - end, len(a))]


def _aligned(a: list, b: list) -> list[int]:
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > ALIGN_CELLS:  # by halves of a, with the best cut of b
        half = len(a) // 2
        front, back = _counts(a[:half], b), _counts(a[half:][::-1], b[::-1])
        cut = max(range(len(b) + 1), key=lambda j: front[j] + back[len(b) - j])
        return _aligned(a[:half], b[:cut]) + [half + i for i in _aligned(a[half:], b[cut:])]
    rows = _lengths(a, b)
    found, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            found.append(i - 1)
            i, j = i - 1, j - 1
        elif rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
    return found[::-1]


def _counts(a: list, b: list) -> list[int]:
    """The length of the longest common subsequence of ``a`` with each beginning of ``b``."""
    masks: dict = defaultdict(int)
    for j, y in enumerate(b):
        masks[y] |= 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & masks.get(x, 0)
        v = ((v + u) | (v - u)) & full
    counts, n = [0], 0
    for bit in reversed(bin(v | 1 << len(b))[3:]):
        n += bit == "0"
        counts.append(n)
    return counts


def _line_hashes(page: Column) -> Column:
    @F.pandas_udf("array<bigint>")
    def apply(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            yield pd.Series(
                [[xxhash.xxh64_intdigest(x) >> 1 for x in lines_of(p)[0]] for p in strings(batch)], dtype=object
            )

    return apply(page)


def _extracted(page: Column) -> Column:
    schema = "lines array<string>, kinds array<int>"

    @F.pandas_udf(schema)
    def apply(pages: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in pages:
            yield pd.DataFrame([lines_of(p) for p in strings(batch)], columns=["lines", "kinds"])

    return apply.asNondeterministic()(page)


def _common_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _difference(frame: pd.DataFrame) -> pd.DataFrame:
    """The shared lines of the pages of a block that are its own, against the nearest page before or behind."""
    frame = frame.sort_values("rank")
    rows = list(frame.itertuples(index=False))
    out = []
    for i, row in enumerate(rows):
        if not row.own:
            continue
        near = [rows[k] for k in (i - 1, i + 1) if 0 <= k < len(rows) and rows[k].host == row.host]
        if not near:
            continue
        other = max(near, key=lambda r: _common_start(r.path, row.path))
        lines = list(row.lines)
        shared = shared_lines(lines, list(other.lines))
        if shared and len(shared) < len(lines):
            out.append((row.id, row.page_hash, shared))
    return pd.DataFrame(out, columns=["id", "page_hash", "shared"])


def shared_with_nearest(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(id, page_hash, shared): the places of the lines that a page shares with the nearest one, where there are any."""
    url = F.coalesce(col(url_col), F.lit(""))
    narrow = pages.select(
        col(id_col).cast("bigint").alias("id"),
        text_hash(col(html_col)).alias("page_hash"),
        F.lower(F.regexp_extract(url, "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)).alias("host"),
        F.regexp_replace(F.regexp_replace(url, "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*", ""), "[?#].*$", "").alias("path"),
        _line_hashes(col(html_col)).alias("lines"),
    )
    narrow = written(narrow, "narrow")
    keys = ["host", "path", "id", "page_hash"]
    ordered = narrow.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = T.StructType([*narrow.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType())])

    def numbered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, n = TaskContext.get().partitionId(), 0
        for frame in frames:
            yield frame.assign(part=part, place=range(n, n + len(frame)))
            n += len(frame)

    ordered = written(ordered.mapInPandas(numbered, schema), "ordered")
    sizes = sorted(ordered.groupBy("part").count().collect())  # a row for each partition
    first, offsets = 0, []
    for part, n in sizes:
        offsets.append((part, first))
        first += n
    if not offsets:
        return ordered.select("id", "page_hash", F.array().cast("array<int>").alias("shared"))
    starts = F.broadcast(pages.sparkSession.createDataFrame(offsets, "part int, first bigint"))
    ranked = ordered.join(starts, "part").withColumn("rank", F.col("first") + F.col("place")).drop("part", "place", "first")
    block = F.floor(F.col("rank") / BLOCK)
    inside = F.col("rank") % BLOCK
    also = F.array_compact(F.array(F.when(inside == 0, block - 1), F.when(inside == BLOCK - 1, block + 1)))
    dealt = ranked.withColumn("own_block", block).withColumn("block", F.explode(F.concat(F.array(block), also)))
    dealt = dealt.withColumn("own", F.col("block") == F.col("own_block")).drop("own_block")
    found = dealt.groupBy("block").applyInPandas(_difference, "id bigint, page_hash bigint, shared array<int>")
    return written(found.dropDuplicates(["id", "page_hash"]), "shared_lines")


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``pages`` with ``text``, the lines of the main text joined by line feeds, ``n_chars``, its code points, and
    ``n_shared``, the lines of the page that its neighbour has too."""
    shared = shared_with_nearest(pages, id_col, url_col, html_col)
    id_, hash_, places = (fresh(c, pages) for c in ("shared_id", "shared_hash", "shared_places"))
    page = fresh("extracted", pages)
    shared = broadcast_if_small(shared)
    shared = shared.select(F.col("id").alias(id_), F.col("page_hash").alias(hash_), F.col("shared").alias(places))
    hash_here = fresh("page_hash", pages)
    read = pages.withColumn(hash_here, text_hash(col(html_col))).withColumn(page, _extracted(col(html_col)))
    same = col(id_col).cast("bigint").eqNullSafe(F.col(id_)) & (F.col(hash_here) == F.col(hash_))
    joined = read.join(shared, same, "left")
    kinds, lines = F.col(f"{page}.kinds"), F.col(f"{page}.lines")
    best = F.coalesce(F.array_max(kinds), F.lit(DROPPED))
    numbers = F.filter(F.sequence(F.lit(0), F.size(lines)), lambda i: F.get(kinds, i) == best)
    none = F.array().cast("array<int>")
    declared = best.isin(MAIN, ARTICLE)
    unknown = (best == DROPPED) & F.col(places).isNull()
    numbers = F.when(declared, numbers).when(unknown, none).otherwise(
        F.array_except(numbers, F.coalesce(F.col(places), none))
    )
    text = F.array_join(F.transform(numbers, lambda i: F.get(lines, i)), "\n")
    out = joined.withColumn("text", text).withColumn("n_chars", F.length("text").cast("bigint"))
    out = out.withColumn("n_shared", F.coalesce(F.size(places), F.lit(0)).cast("bigint"))
    return out.drop(id_, hash_, places, page, hash_here)
