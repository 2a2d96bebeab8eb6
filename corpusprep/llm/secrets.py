"""Secret scans that ask who else has the value: DataFrame functions only.

Three patterns find candidates in a text: values assigned to a name that sounds secret, access keys, and long hexadecimal
numbers. A fourth finds opaque runs of letters and digits that none of the three covers. A pattern says little about
whether a value is alive: documentation and copied code are full of example keys. So every candidate's digest is counted
over the whole corpus, by distinct repositories and by distinct owners. A value that more than ``max_owners`` owners have is
a widely copied example; one that few owners have, and that looks random, is a live-looking credential. Opaque runs become
spans only if they are live-looking; what the three patterns find stays either way and is told apart by ``live``.

1. The tasks that read the texts leave, for each match, its length, the length of the text before it since the last match,
   the digest and the look of its value. Nothing else of a text moves on, and the step is written.
2. Places are running sums of those lengths within the row. Opaque runs that overlap another span go.
3. Distinct counts are worked out in parts before they are shuffled, so a value that a third of all documents have is one
   entry in each part. Counts go back over (value, slice): a value has one row for each of ``SLICES`` slices, and the spans of
   a frequent value are dealt out over as many keys.

Defined results: a null text counts as empty and has no spans. Places count code points, ends are exclusive. A null owner
or repository is one unknown owner or repository. Repeated rows have a result each, and a row that is repeated makes its
values no more frequent, because owners and repositories are counted once. Texts are read whole. An empty table gives an
empty result. Only the columns named are read.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import col
from corpusprep.work import written


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: The names that assigned values have, and the patterns.
NAMES = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = f"({'|'.join(map(_any_case, NAMES))})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: The matches of these two are as long as the run of their characters, so the least length can be part of the pattern.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
OPAQUE = "[A-Za-z0-9]{20,}"
#: Words that stand in values which nobody meant to be secret.
PLACEHOLDER = "(?i)example|sample|dummy|placeholder|changeme|your|test|x{4}|0{6}|123456"

KINDS = ("assign", "access", "hex", "opaque")
BASE = 3
LEAST_VALUE = 6
#: A value looks random if it has as many characters, different characters, and digits.
LOOKS = (16, 8, 2)
MAX_OWNERS = 2
SLICES = 64


def looks_random(value: Column) -> Column:
    """Whether a value may be a generated one: long, varied, with digits and letters, and no word of a placeholder."""
    length, varied, digits = LOOKS
    return (
        (F.length(value) >= length)
        & (F.size(F.array_distinct(F.split(value, ""))) >= varied)
        & (F.length(F.regexp_replace(value, "[^0-9]", "")) >= digits)
        & value.rlike("[A-Za-z]")
        & ~value.rlike(PLACEHOLDER)
    )


def _matches(text: Column, kind: int, pattern: str) -> Column:
    """(kind, i, skip, size, kept, digest, random) for each match of a pattern, from left to right."""

    def mark(pair: Column, i: Column) -> Column:
        match = pair["match"]
        value = F.regexp_extract(match, pattern, 2) if kind == 0 else match
        random = looks_random(value)
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.length(pair["skip"]).alias("skip"),
            F.length(match).alias("size"),
            ((F.length(value) >= LEAST_VALUE) if kind < BASE else random).alias("kept"),
            F.sha2(value, 256).alias("digest"),
            random.alias("random"),
        )

    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("skip"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match")
    )
    return F.when(text.rlike(pattern), F.transform(F.filter(pieces, lambda p: p["match"].isNotNull()), mark))


def _marked(docs: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str) -> DataFrame:
    text = F.coalesce(col(text_col), F.lit(""))
    found = [_matches(text, k, p) for k, p in enumerate((ASSIGN, ACCESS, HEX, OPAQUE))]
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        col(id_col).alias("id"),
        F.coalesce(col(repo_col).cast("string"), F.lit("")).alias("repo"),
        F.coalesce(col(owner_col).cast("string"), F.lit("")).alias("owner"),
        F.flatten(F.array_compact(F.array(*found))).alias("marks"),
    )


def _placed(marked: DataFrame) -> DataFrame:
    """(row, repo, owner, kind, start, end, digest, random) for each match that is kept."""
    marks = marked.where(F.size("marks") > 0).select("row", "repo", "owner", F.explode("marks").alias("m"))
    marks = marks.select("row", "repo", "owner", "m.*")
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    ends = marks.withColumn("end", F.sum(F.col("skip") + F.col("size")).over(so_far))
    spans = ends.withColumn("start", F.col("end") - F.col("size")).where("kept")
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("kind") < BASE
    spans = spans.withColumns(
        {"left": F.max(F.when(base, F.col("end"))).over(before), "right": F.min(F.when(base, F.col("start"))).over(after)}
    )
    alone = (F.coalesce("left", "start") <= F.col("start")) & (F.coalesce("right", "end") >= F.col("end"))
    return spans.where(base | alone).select("row", "repo", "owner", "kind", "start", "end", "digest", "random")


def ownership(spans: DataFrame) -> DataFrame:
    """(digest, n_repos, n_owners) for each value among the candidates."""
    return spans.groupBy("digest").agg(
        F.count_distinct("repo").alias("n_repos"), F.count_distinct("owner").alias("n_owners")
    )


def find(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repo_col: str = "doc_id",
    owner_col: str = "source",
    max_owners: int = MAX_OWNERS,
) -> tuple[DataFrame, DataFrame]:
    """(row, id) for each row of ``docs``, and (row, kind, start, end, digest, n_repos, n_owners, live, span) for each
    candidate. ``repo_col`` and ``owner_col`` name the repository a document is from and that repository's owner."""
    marked = written(_marked(docs, id_col, text_col, repo_col, owner_col), "marks")
    spans = written(_placed(marked), "candidates").withColumn("slice", F.pmod("row", F.lit(SLICES)))
    counts = spans.select("digest", "slice").distinct().join(ownership(spans), "digest")
    judged = spans.join(counts, ["digest", "slice"])
    live = F.col("random") & (F.col("n_owners") <= max_owners)
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    judged = judged.withColumns({"live": live, "span": F.concat_ws(":", name, "start", "end")})
    return marked.select("row", "id"), judged.select(
        "row", "kind", "start", "end", "digest", "n_repos", "n_owners", "live", "span"
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: s["span"]), ",")


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repo_col: str = "doc_id",
    owner_col: str = "source",
    max_owners: int = MAX_OWNERS,
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_assign``, ``n_access``, ``n_hex``, ``n_opaque``, ``base_sha256`` of the spans
    of the three patterns, ``spans`` (those and the live-looking opaque ones), ``live`` (the live-looking among all),
    and ``n_copied`` (candidates that more than ``max_owners`` owners have). Spans are kind:start:end by start and kind."""
    rows, found = find(docs, id_col, text_col, repo_col, owner_col, max_owners)
    whole = found.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "span", "live"))).alias("all"),
        F.sum((F.col("n_owners") > max_owners).cast("bigint")).alias("n_copied"),
    )
    each = rows.join(whole, "row", "left")
    spans = F.coalesce("all", F.array().cast(whole.schema["all"].dataType))
    shown = F.filter(spans, lambda s: (s["kind"] < BASE) | s["live"])
    base = F.filter(spans, lambda s: s["kind"] < BASE)

    def count(kind: int) -> Column:
        return F.size(F.filter(shown, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    return each.select(
        F.col("id").alias(id_col),
        *(count(k) for k in range(len(KINDS))),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(shown).alias("spans"),
        _joined(F.filter(spans, lambda s: s["live"])).alias("live"),
        F.coalesce("n_copied", F.lit(0)).cast("bigint").alias("n_copied"),
    )
