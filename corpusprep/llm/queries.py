"""The numbered operators as queries over the driver's tables, and their SQL where SQL can say it."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import (
    bpe,
    conversation_repair,
    decontaminate,
    hard_negatives,
    html_extract,
    language_id,
    licences,
    line_dedup,
    quality_classifier,
    quality_rules,
    secrets,
    simhash,
    warc,
)
from corpusprep.llm.common import table
from corpusprep.work import new_path


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_copies(docs, counts=True).select("doc_id", "n_lines", "n_copies", "text")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", "fingerprint", "component_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    judged = quality_rules.apply_rules(docs.select("doc_id", "text"), weights=weights)
    return judged.select("doc_id", "quality_rules.*")


def op4_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archive(table(spark, sf_dir, "pages"), new_path(spark, "archive"))
    back = warc.parse_records(warc.read_records(spark, path))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_id.train(table(spark, sf_dir, "documents"))
    return language_id.identify(table(spark, sf_dir, "pages"), model)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_overlaps(docs, table(spark, sf_dir, "benchmark"))
    items = F.col("overlap.items")
    return found.select(
        "doc_id",
        "overlap.n_words",
        "overlap.n_hit",
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.sort_array(items), ","), 256).alias("items_sha256"),
        (F.col("overlap.n_hit") > 0).alias("contaminated"),
    )


BPE_RANKS = "byte_bpe_50k.tiktoken"


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.round_trip(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)
    return both.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    scores = quality_classifier.score_documents(docs, trees)
    return scores.select(
        "doc_id",
        quality_classifier.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", "n_chars", "n_shared")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.with_all(conversation_repair.repair(conversation_repair.damage(rows)), rows)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives.mine(rows, F.col("id") % 50 == 0)


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), repo_col="doc_id", owner_col="source")


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_simhash_near_dedup,
        op3_quality_rules,
        op4_warc_archive,
        op5_language_id,
        op6_decontamination,
        op7_byte_bpe,
        op8_licence_scan,
        op9_quality_classifier,
        op10_html_extraction,
        op11_conversation_repair,
        op12_hard_negatives,
        op13_secret_scan,
    )
}


def _canonical_line_sql(line: str) -> str:
    plain = f"trim(regexp_replace(lower({line}), '{licences.NOT_WORD}', ' ', 'g'))"
    changed = plain
    for pattern, spelling in licences.SPELLINGS:
        changed = f"regexp_replace({changed}, '{pattern}', '{spelling.replace('$', chr(92))}', 'g')"
    return (
        f"CASE WHEN regexp_matches(lower({line}), '{licences.COPYRIGHT_LINE}') THEN NULL "
        f"WHEN regexp_matches({plain}, '{licences.MAY_CHANGE}') THEN {changed} ELSE {plain} END"
    )


def _known_sql() -> str:
    texts = [*licences.TEXTS.items(), *licences.full_texts()]
    quoted = [(licence, text.replace("'", "''")) for licence, text in texts]
    quoted += [(i, form.format(name)) for i, names in licences.NAMES.items() for name in names for form in licences.NOTICES]
    return ", ".join(f"('{licence}', '{text}')" for licence, text in quoted)


def _lines_sql(text: str) -> str:
    lines = f"list_transform(string_split({text}, chr(10)), lambda l: {_canonical_line_sql('l')})"
    return f"list_filter({lines}, lambda l: l IS NOT NULL AND l <> '')"


def _whole_form_sql(lines: str) -> str:
    rest = f"list_filter({lines}, lambda l: l <> '{licences.RIGHTS_LINE}')"
    titled = f"len({rest}) > 1 AND regexp_matches({rest}[1], '{licences.TITLE_LINE}')"
    return f"array_to_string(CASE WHEN {titled} THEN {rest}[2:] ELSE {rest} END, ' ')"


def _secret_matches_sql() -> str:
    """row, kind, i, skip, size, value for each match, as one SELECT for each kind."""
    patterns = (secrets.ASSIGN, secrets.ACCESS, secrets.HEX, secrets.OPAQUE)
    each = []
    for kind, pattern in enumerate(p.replace("'", "''") for p in patterns):
        value = f"regexp_extract(match, '{pattern}', 2)" if kind == 0 else "match"
        each.append(f"""
            SELECT row, {kind} AS kind, i, length(skip) AS skip, length(match) AS size, {value} AS value FROM (
                SELECT row, unnest(regexp_extract_all(body, '{pattern}')) AS match,
                       unnest(string_split_regex(body, '{pattern}')[:-2]) AS skip,
                       unnest(range(len(regexp_extract_all(body, '{pattern}')))) AS i
                FROM texts WHERE regexp_matches(body, '{pattern}'))""")
    return " UNION ALL ".join(each)


ORACLE_SQL: dict[str, str] = {
    "op4_warc_archive": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS n FROM pages
        ), m AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS last FROM p)
        SELECT page_id, n AS payload_bytes, sha1(body) AS payload_digest,
               CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to
        FROM m""",
    "op8_licence_scan": f"""
        WITH known AS (
            SELECT sha256({_whole_form_sql("lines")}) AS digest, min(licence) AS licence
            FROM (SELECT licence, {_lines_sql("text")} AS lines FROM (VALUES {_known_sql()}) AS k(licence, text)) GROUP BY 1
        ), forms AS (
            SELECT row_number() OVER () AS row, doc_id, {_lines_sql("text")} AS lines FROM documents
        ), whole AS (
            SELECT *, CASE WHEN form <> '' THEN sha256(form) END AS text_digest
            FROM (SELECT *, {_whole_form_sql("lines")} AS form FROM forms)
        ), by_line AS (
            SELECT row, licence FROM (SELECT row, sha256(unnest(lines)) AS digest FROM forms) JOIN known USING (digest)
        ), by_text AS (SELECT row, licence FROM whole JOIN known ON text_digest = digest
        ), counted AS (SELECT row, count(*) AS n FROM by_line GROUP BY row
        ), named AS (
            SELECT row, string_agg(licence, ',' ORDER BY licence) AS licences
            FROM (SELECT * FROM by_line UNION SELECT * FROM by_text) GROUP BY row
        )
        SELECT doc_id, text_digest, by_text.licence AS licence, coalesce(n, 0) AS n_licence_lines,
               coalesce(licences, '') AS licences
        FROM whole LEFT JOIN by_text USING (row) LEFT JOIN counted USING (row) LEFT JOIN named USING (row)""",
    "op12_hard_negatives": """
        WITH v AS (
            SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
                   list_inner_product(a.v, b.v)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        ), positive AS (
            SELECT * FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
        )
        SELECT p.anchor_id, p.id AS positive_id,
               row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INT AS rank,
               n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
             AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
        QUALIFY rank <= 3""",
    "op13_secret_scan": f"""
        WITH texts AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS body
            FROM documents
        ), matches AS ({_secret_matches_sql()}), looked AS (
            SELECT *, sum(skip + size) OVER (PARTITION BY row, kind ORDER BY i) AS "end",
                   length(value) >= {secrets.LOOKS[0]} AND len(list_distinct(string_split(value, ''))) >= {secrets.LOOKS[1]}
                   AND length(regexp_replace(value, '[^0-9]', '', 'g')) >= {secrets.LOOKS[2]}
                   AND regexp_matches(value, '[A-Za-z]') AND NOT regexp_matches(value, '{secrets.PLACEHOLDER}') AS random
            FROM matches
        ), kept AS (
            SELECT row, kind, "end" - size AS "start", "end", value, random FROM looked
            WHERE CASE WHEN kind < {secrets.BASE} THEN length(value) >= {secrets.LEAST_VALUE} ELSE random END
        ), spans AS (
            SELECT * FROM kept k WHERE kind < {secrets.BASE} OR NOT EXISTS (
                SELECT * FROM kept b WHERE b.row = k.row AND b.kind < {secrets.BASE}
                AND b."start" < k."end" AND k."start" < b."end")
        ), owners AS (
            SELECT value, count(DISTINCT owner) AS n_owners FROM spans JOIN texts USING (row) GROUP BY value
        ), judged AS (
            SELECT row, kind, "start", n_owners > {secrets.MAX_OWNERS} AS copied,
                   random AND n_owners <= {secrets.MAX_OWNERS} AS live,
                   concat(string_split('{' '.join(secrets.KINDS)}', ' ')[kind + 1], ':', "start"::BIGINT, ':', "end"::BIGINT) AS span
            FROM spans JOIN owners USING (value)
        ), listed AS (
            SELECT row, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
                   count(*) FILTER (WHERE kind = 2) AS n_hex, count(*) FILTER (WHERE kind = 3 AND live) AS n_opaque,
                   count(*) FILTER (WHERE copied) AS n_copied,
                   string_agg(span, ',' ORDER BY "start", kind) FILTER (WHERE kind < {secrets.BASE}) AS base,
                   string_agg(span, ',' ORDER BY "start", kind) FILTER (WHERE kind < {secrets.BASE} OR live) AS spans,
                   string_agg(span, ',' ORDER BY "start", kind) FILTER (WHERE live) AS live
            FROM judged GROUP BY row
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               coalesce(n_opaque, 0) AS n_opaque, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
               coalesce(live, '') AS live, coalesce(n_copied, 0) AS n_copied
        FROM texts LEFT JOIN listed USING (row)""",
}
