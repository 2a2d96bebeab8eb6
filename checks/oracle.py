"""The queries of the catalogue as SQL for an independent engine.

The formulations differ from the Spark plans where that is possible: phrases are
merged with window functions, for instance, and lookups are joins.
"""

from __future__ import annotations

from corpusprep.plans.catalog import COMPOUND_ACRONYMS
from corpusprep.sources import lexicons

WORD = r"[\p{L}\p{M}\p{N}_]+"
RUN = r"[\p{L}\p{N}_]+"
GAP = r"[^\p{L}\p{N}_]+"
CONTENT = "('VERB', 'NOUN', 'ADJ', 'PROPN')"


def _values(rows) -> str:
    quoted = (", ".join("'" + cell.replace("'", "''") + "'" for cell in row) for row in rows)
    return "(VALUES " + ", ".join(f"({row})" for row in quoted) + ")"


STOP = f"stop AS (SELECT * FROM {_values(lexicons.stopword_rows())} t(lang, word))"
ACRONYMS = f"acr AS (SELECT * FROM {_values(lexicons.acronym_rows())} t(lang, word, found))"
CONTRACTIONS = f"con AS (SELECT * FROM {_values(lexicons.contraction_rows())} t(lang, word, found))"

TITLED = "titled AS (SELECT doc_id, lang, text, source || ' ' || text AS raw_text FROM documents)"
TURNS = "turns AS (SELECT conv_id || '-' || turn AS turn_id, role, text FROM conversations)"


def tokens(name: str, table: str, key: str, text: str = "text", lang: str = "lang") -> str:
    """CTE (key, lang, pos, form): alphabetic tokens in order."""
    return f"""
    {name}_w AS (SELECT {key}, {lang} AS lang, regexp_extract_all({text}, '{WORD}') AS ws FROM {table}),
    {name}_p AS (SELECT {key}, lang, unnest(ws) AS form, generate_subscripts(ws, 1) AS pos FROM {name}_w),
    {name} AS (SELECT * FROM {name}_p WHERE regexp_full_match(form, '\\p{{L}}+'))"""


def filtered(name: str, source: str) -> str:
    """CTE (…, w): lowercased tokens that are not stopwords."""
    return f"""
    {name} AS (SELECT t.*, lower(form) AS w FROM {source} t
      WHERE NOT EXISTS (SELECT 1 FROM stop s WHERE s.lang = t.lang AND s.word = lower(t.form)))"""


def phrases(p: str, source: str, key: str) -> str:
    """CTEs {p}_phr (w, nx, n, n_w, n_nx, score) and {p}_out (key, pos, token) from (key, pos, w)."""
    return f"""
    {p}_seq AS (SELECT {key}, row_number() OVER d AS i, w, lead(w) OVER d AS nx FROM {source}
      WINDOW d AS (PARTITION BY {key} ORDER BY pos)),
    {p}_uni AS (SELECT w AS token, count(*) AS n FROM {p}_seq GROUP BY 1),
    {p}_big AS (SELECT w, nx, count(*) AS n FROM {p}_seq WHERE nx IS NOT NULL GROUP BY 1, 2),
    {p}_dict AS (SELECT k, sum(n)::BIGINT AS n FROM
      (SELECT token AS k, n FROM {p}_uni UNION ALL SELECT w || '_' || nx, n FROM {p}_big) GROUP BY 1),
    {p}_all AS (SELECT b.w, b.nx, ab.n, a.n AS n_w, c.n AS n_nx,
        (ab.n - 2) / (a.n::DOUBLE * c.n) * (SELECT count(*) FROM {p}_dict)::DOUBLE AS score
      FROM {p}_big b JOIN {p}_dict ab ON ab.k = b.w || '_' || b.nx
      JOIN {p}_dict a ON a.k = b.w JOIN {p}_dict c ON c.k = b.nx),
    {p}_phr AS (SELECT * FROM {p}_all WHERE score > 20),
    {p}_hit AS (SELECT s.{key}, s.i, s.i - row_number() OVER (PARTITION BY s.{key} ORDER BY s.i) AS island
      FROM {p}_seq s JOIN {p}_phr p ON s.w = p.w AND s.nx = p.nx),
    {p}_start AS (SELECT {key}, i FROM
      (SELECT *, row_number() OVER (PARTITION BY {key}, island ORDER BY i) AS r FROM {p}_hit) WHERE r % 2 = 1),
    {p}_out AS (SELECT s.{key}, s.i AS pos, CASE WHEN b.i IS NULL THEN s.w ELSE s.w || '_' || s.nx END AS token
      FROM {p}_seq s LEFT JOIN {p}_start b ON b.{key} = s.{key} AND b.i = s.i
      LEFT JOIN {p}_start e ON e.{key} = s.{key} AND e.i = s.i - 1 WHERE e.i IS NULL)"""


def joined(table: str, source: str, key: str, token: str, out: str, columns: str = "", order: str = "pos") -> str:
    """Select: tokens of ``source`` per row of ``table``; rows without tokens get an empty text."""
    extra = "".join(f", any_value(d.{c}) AS {c}" for c in columns.split())
    return f"""SELECT d.{key}{extra}, coalesce(string_agg({token}, ' ' ORDER BY t.{order}), '') AS {out}
    FROM {table} d LEFT JOIN {source} t ON t.{key} = d.{key} GROUP BY d.{key}"""


def grams(name: str, table: str, columns: str, text: str = "text") -> str:
    """CTE (columns, gram): overlapping trigrams of letters."""
    return f"""
    {name}_c AS (SELECT {columns}, regexp_extract_all(
      ' ' || trim(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{M}}]+', ' ', 'g')) || ' ', '.') AS cs FROM {table}),
    {name} AS (SELECT {columns},
      unnest(list_transform(range(1, len(cs) - 1), lambda i: cs[i] || cs[i + 1] || cs[i + 2])) AS gram FROM {name}_c)"""


def language(table: str, key: str) -> str:
    """CTE pred (key, pred_lang): trigram model trained on the documents, applied to ``table``."""
    return (
        grams("train", "documents", "lang")
        + ","
        + grams("spoken", table, key)
        + f""",
    counts AS (SELECT lang, gram, count(*) AS n FROM train GROUP BY 1, 2),
    totals AS (SELECT lang, round(-ln(sum(n) + (SELECT count(DISTINCT gram) FROM counts)) * 1000000)::BIGINT AS unknown
      FROM counts GROUP BY 1),
    per_doc AS (SELECT {key}, gram, count(*) AS m FROM spoken GROUP BY 1, 2),
    score AS (SELECT p.{key}, t.lang,
        sum(m * (t.unknown + coalesce(round(ln(c.n + 1) * 1000000)::BIGINT, 0))) AS s
      FROM per_doc p CROSS JOIN totals t LEFT JOIN counts c ON c.gram = p.gram AND c.lang = t.lang GROUP BY 1, 2),
    best AS (SELECT {key}, lang FROM
      (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY s DESC, lang) AS r FROM score) WHERE r = 1),
    pred AS (SELECT d.{key}, coalesce(b.lang, 'Other') AS pred_lang FROM {table} d LEFT JOIN best b ON b.{key} = d.{key})"""
    )


def expand(
    name: str, table: str, key: str, dictionary: str, keep: str, inner: str = "", text: str = "text", whole: str = ""
) -> str:
    """CTE (key, keep, text): whole-word replacement. ``whole``: a pattern of entries that are not one run."""
    run = f"{RUN}(?:[{inner}]{RUN})*" if inner else RUN
    run = f"{whole}|{run}" if whole else run
    run = run.replace("'", "''")
    shown = "found"
    if inner:
        shown = """CASE WHEN lower(run[1]) <> run[1] THEN upper(found[1]) || found[2:] ELSE found END"""
    return f"""
    {name}_r AS (SELECT {key}, lang, regexp_extract_all({text}, '{run}|{GAP}') AS rs FROM {table}),
    {name}_p AS (SELECT {key}, lang, unnest(rs) AS run, generate_subscripts(rs, 1) AS pos FROM {name}_r),
    {name}_x AS (SELECT p.{key}, pos, CASE WHEN found IS NULL THEN run ELSE {shown} END AS piece FROM {name}_p p
      LEFT JOIN {dictionary} d ON d.lang = p.lang AND lower(d.word) = lower(replace(run, '’', ''''))),
    {name} AS (SELECT t.{key}, {', '.join(f't.{c}' for c in keep.split())}, coalesce(x.text, t.{text}) AS text FROM {table} t LEFT JOIN
      (SELECT {key}, string_agg(piece, '' ORDER BY pos) AS text FROM {name}_x GROUP BY 1) x ON x.{key} = t.{key})"""


def hashed(table: str, key: str, max_tokens: int | None = None) -> str:
    """CTE cells (key, dim, val)."""
    cut = f"[1:{max_tokens}]" if max_tokens else ""
    return f"""
    enc AS (SELECT {key}, unnest(regexp_extract_all(lower(text), '{WORD}'){cut}) AS token FROM {table}),
    sums AS (SELECT {key}, ((('0x' || substr(md5(token), 1, 8))::BIGINT) % 64)::INTEGER AS dim,
        sum(CASE WHEN substr(md5(token), 9, 1) < '8' THEN 1 ELSE -1 END)::BIGINT AS total FROM enc GROUP BY 1, 2),
    norms AS (SELECT {key}, sqrt(sum(total * total)::DOUBLE) AS norm FROM sums GROUP BY 1),
    cells AS (SELECT s.{key}, dim, round(total / norm, 6) AS val
      FROM sums s JOIN norms n ON n.{key} = s.{key} WHERE total <> 0)"""


LEXICON = f"""
    lex_f AS (SELECT lang, unnest(regexp_extract_all(lower(text), '{WORD}')) AS form FROM documents),
    lex_n AS (SELECT lang, form FROM lex_f WHERE regexp_full_match(form, '\\p{{L}}+') GROUP BY 1, 2 HAVING count(*) >= 2),
    lex_s AS (SELECT *, regexp_replace(form, '(ing|ed|es|s|en)$', '') AS stem FROM lex_n),
    lex AS (SELECT lang, form, CASE WHEN length(stem) >= 3 THEN stem ELSE form END AS lemma,
      ['NOUN', 'VERB', 'ADJ', 'PROPN', 'ADP', 'DET'][length(form) % 6 + 1] AS pos FROM lex_s)"""


def annotated(name: str, source: str) -> str:
    """CTE (…, lemma, upos) from the lexicon; unlisted forms are their own lemma."""
    return f"""
    {name} AS (SELECT t.*, coalesce(x.lemma, t.form) AS lemma, x.pos AS upos FROM {source} t
      LEFT JOIN lex x ON x.lang = t.lang AND x.form = lower(t.form))"""


# Tags by context. A run of ambiguous tokens is decoded step by step, all runs of the corpus side by side.
TAGGED = """
    lex2 AS (SELECT lang, form, lemma, pos AS tag FROM lex UNION ALL
      SELECT lang, form, form, CASE WHEN pos = 'NOUN' THEN 'VERB' ELSE 'NOUN' END FROM lex WHERE length(form) IN (3, 4, 6)),
    readings AS (SELECT lang, form, tag, count(*) AS n, min(lemma) AS lemma FROM lex2 GROUP BY 1, 2, 3),
    emit AS (SELECT *, round(ln(n / (sum(n) OVER (PARTITION BY tag))::DOUBLE) * 1000000)::BIGINT AS score,
      count(*) OVER (PARTITION BY lang, form) AS n_tags FROM readings),
    seq AS (SELECT doc_id, lang, form, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM tok),
    known AS (SELECT s.*, coalesce(e.n_tags, 0) AS n_tags, CASE WHEN e.n_tags = 1 THEN e.tag END AS sure FROM seq s
      LEFT JOIN (SELECT lang, form, max(n_tags) AS n_tags, min(tag) AS tag FROM emit GROUP BY 1, 2) e
      ON e.lang = s.lang AND e.form = lower(s.form)),
    beside AS (SELECT *, lag(i) OVER d AS before, lead(i) OVER d AS behind, lag(sure) OVER d AS sure_before,
        lead(sure) OVER d AS sure_behind, lag(n_tags) OVER d AS n_before, lead(n_tags) OVER d AS n_behind FROM known
      WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
    pairs AS (SELECT CASE WHEN before IS NULL THEN '' ELSE sure_before END AS a, sure AS b FROM beside UNION ALL
      SELECT sure, '' FROM beside WHERE behind IS NULL),
    counted AS (SELECT a, b, count(*) AS n FROM pairs WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1, 2),
    edges AS (SELECT DISTINCT tag FROM emit UNION SELECT ''),
    follow AS (SELECT x.tag AS a, y.tag AS b, round(ln((coalesce(n, 0) + 1) /
        (sum(coalesce(n, 0) + 1) OVER (PARTITION BY x.tag))::DOUBLE) * 1000000)::BIGINT AS score
      FROM edges x CROSS JOIN edges y LEFT JOIN counted c ON c.a = x.tag AND c.b = y.tag),
    unsure AS (SELECT b.doc_id, b.i, b.i - row_number() OVER (PARTITION BY b.doc_id ORDER BY b.i) AS run, lower(b.form) AS form,
        b.lang, coalesce(b.sure_before, '') AS left_tag, coalesce(b.sure_behind, '') AS right_tag,
        coalesce(n_before, 0) < 2 AS first, coalesce(n_behind, 0) < 2 AS last FROM beside b WHERE n_tags > 1),
    path AS (
      SELECT u.doc_id, u.run, u.i, u.last, u.right_tag, e.tag, e.score + f.score AS score, [e.tag] AS tags
      FROM unsure u JOIN emit e USING (lang, form) JOIN follow f ON f.a = u.left_tag AND f.b = e.tag WHERE u.first
      UNION ALL
      SELECT * FROM (
        SELECT u.doc_id, u.run, u.i, u.last, u.right_tag, e.tag, max(p.score + f.score) + any_value(e.score) AS score,
          list_append(arg_max(p.tags, (p.score + f.score) * 100 + 99 - k.rank), e.tag) AS tags
        FROM path p JOIN unsure u ON u.doc_id = p.doc_id AND u.run = p.run AND u.i = p.i + 1 JOIN emit e USING (lang, form)
        JOIN follow f ON f.a = p.tag AND f.b = e.tag JOIN ranked k ON k.tag = p.tag
        GROUP BY u.doc_id, u.run, u.i, u.last, u.right_tag, e.tag)),
    won AS (SELECT p.doc_id, p.i, arg_max(p.tags, (p.score + f.score) * 100 + 99 - k.rank) AS tags FROM path p
      JOIN follow f ON f.a = p.tag AND f.b = p.right_tag JOIN ranked k ON k.tag = p.tag WHERE p.last GROUP BY 1, 2),
    decided AS (SELECT doc_id, i - len(tags) + unnest(range(1, len(tags) + 1)) AS i, unnest(tags) AS tag FROM won),
    tagged AS (SELECT k.*, coalesce(sure, d.tag) AS tag FROM known k LEFT JOIN decided d ON d.doc_id = k.doc_id AND d.i = k.i),
    chosen AS (SELECT t.*, r.lemma FROM tagged t
      LEFT JOIN readings r ON r.lang = t.lang AND r.form = lower(t.form) AND r.tag = t.tag)"""
TAGGED = TAGGED.replace("    path AS (", "    ranked AS (SELECT tag, row_number() OVER (ORDER BY tag) AS rank FROM edges),\n    path AS (", 1)

GUESSED = """
    held AS (SELECT * FROM lex WHERE ('0x' || substr(md5(form), 1, 8))::BIGINT % 5 = 0),
    same AS (SELECT lang, form, lower(lemma) AS lemma, list_max(list_transform(range(0, length(form) + 1),
        lambda i: CASE WHEN i <= length(lemma) AND form[1:i] = lower(lemma)[1:i] THEN i END)) AS n
      FROM lex WHERE ('0x' || substr(md5(form), 1, 8))::BIGINT % 5 <> 0),
    change AS (SELECT lang, form, length(form) - n AS cut, lemma[n + 1:] AS added FROM same),
    ended AS (SELECT lang, cut, added, unnest(list_transform(range(1, least(5, length(form) - 2) + 1), lambda k: form[-k:])) AS ending
      FROM change),
    rule AS (SELECT lang, ending, cut, added, count(*) AS n FROM ended WHERE length(ending) >= cut GROUP BY 1, 2, 3, 4
      QUALIFY row_number() OVER (PARTITION BY lang, ending ORDER BY n DESC, cut, added) = 1),
    fits AS (SELECT h.lang, h.form, {'ending': r.ending, 'cut': r.cut, 'added': r.added} AS r FROM held h JOIN rule r
      ON r.lang = h.lang AND r.n >= 3 AND length(h.form) >= length(r.ending) + 2 AND suffix(h.form, r.ending))"""


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ", ".join(c.strip() for c in ctes) + "\n" + select


DOC_TOKENS = tokens("tok", "documents", "doc_id")
DOC_FILTERED = (STOP, DOC_TOKENS, filtered("fil", "tok"))
DOC_PHRASES = (*DOC_FILTERED, phrases("ph", "fil", "doc_id"))


def build() -> dict[str, str]:
    sql = {}
    everything = "SELECT doc_id, text, lang, source, n_chars FROM documents"
    sql["scan_parquet"] = everything
    sql["csv_round_trip"] = "SELECT doc_id, text, lang FROM documents"
    sql["csv_split"] = sql["csv_round_trip"]
    sql["saved_result"] = _with(
        tokens("tok", "(SELECT doc_id, lang, lower(text) AS text FROM documents)", "doc_id"),
        select=joined("(SELECT doc_id, text AS raw_text FROM documents)", "tok", "doc_id", "form", "lemmas", "raw_text"),
    )
    sql["input_parts"] = """SELECT doc_id % 6 AS part, count(*) AS n_rows FROM documents GROUP BY 1
      UNION ALL SELECT 6, 0"""
    sql["stopword_load"] = f"""SELECT word, count(*) AS n_given, true AS listed FROM
      (SELECT unnest(regexp_extract_all(lower(text), '{WORD}')) AS word FROM documents)
      WHERE length(word) <= 4 GROUP BY word"""
    sql["resume_parts"] = "SELECT doc_id, length(text) AS n_chars, 2::INTEGER AS n_taken FROM documents"
    sql["embed_word2vec"] = f"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS word FROM documents),
      v AS (SELECT word FROM w GROUP BY 1 HAVING count(*) >= 2)
      SELECT doc_id, 16::INTEGER AS n_dims, doc_id IN (SELECT doc_id FROM w JOIN v USING (word)) AS has_vector FROM documents"""
    sql["apply_mapping"] = "SELECT doc_id, text AS raw_text FROM documents"
    sql["title_concat"] = "SELECT doc_id, source || ' ' || text AS raw_text FROM documents"
    sql["multi_field"] = _with(
        TURNS,
        tokens("a", "(SELECT turn_id, '' AS lang, lower(role) AS text FROM turns)", "turn_id"),
        tokens("b", "(SELECT turn_id, '' AS lang, lower(text) AS text FROM turns)", "turn_id"),
        f"ra AS ({joined('turns', 'a', 'turn_id', 'form', 'role_lemmas', 'role text')})",
        f"rb AS ({joined('turns', 'b', 'turn_id', 'form', 'text_lemmas')})",
        select="SELECT turn_id, role AS role_raw_text, text AS text_raw_text, role_lemmas, text_lemmas FROM ra JOIN rb USING (turn_id)",
    )
    sql["null_fill"] = "SELECT doc_id, CASE WHEN n_chars > 500 THEN text ELSE '' END AS text, source FROM documents"
    sql["drop_unusable"] = """SELECT doc_id, text AS raw_text, lang AS lang_raw_text,
      CASE WHEN source <> 'src4' THEN source END AS source FROM documents WHERE source <> 'src3' AND n_chars > 300
      AND text <> 'nan'"""

    sql["lang_model_counts"] = _with(
        grams("train", "documents", "lang"), select="SELECT lang, gram, count(*) AS n FROM train GROUP BY 1, 2"
    )
    sql["lang_predict_nb"] = _with(language("documents", "doc_id"), select="SELECT doc_id, pred_lang FROM pred")
    sql["lang_predict_turns"] = _with(
        TURNS, language("turns", "turn_id"), select="SELECT turn_id, pred_lang FROM pred"
    )
    sql["lang_filter"] = _with(
        language("documents", "doc_id"),
        select="SELECT doc_id, text, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM pred WHERE pred_lang = 'es')",
    )
    sql["lang_vote"] = _with(
        STOP,
        f"said AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS word FROM documents)",
        "votes AS (SELECT doc_id, s.lang, count(*) AS n FROM said JOIN stop s USING (word) GROUP BY 1, 2)",
        "won AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, lang) AS r FROM votes)",
        select="""SELECT d.doc_id, coalesce(w.lang, 'Other') AS pred_lang
      FROM documents d LEFT JOIN won w ON w.doc_id = d.doc_id AND r = 1""",
    )

    acronym_text = """replace(replace(replace(replace(text, ' nd ', ' DNA '), ' os ', ' OMS '), ' of ', ' R&D '), ' the ',
      ' Covid-19 ')"""
    compounds = _values(COMPOUND_ACRONYMS)
    sql["acronym_expand"] = _with(
        ACRONYMS,
        f"acx AS (SELECT * FROM acr UNION ALL SELECT * FROM {compounds} t(lang, word, found))",
        # The other languages have no such entries, and their pieces are looked up one by one.
        f"src AS (SELECT doc_id, lang, {acronym_text} AS text FROM documents)",
        "src_en AS (SELECT * FROM src WHERE lang = 'en')",
        "src_other AS (SELECT * FROM src WHERE lang <> 'en')",
        expand("ex", "src_en", "doc_id", "acx", "lang", whole="(?i:R&D|COVID-19)"),
        expand("eo", "src_other", "doc_id", "acx", "lang"),
        select="SELECT doc_id, lang, text FROM ex UNION ALL SELECT doc_id, lang, text FROM eo",
    )
    contraction_text = "replace(replace(replace(text, ' is ', ' isn''t '), ' it ', ' ''it’s'' '), ' he ', ' He''ll ')"
    sql["contraction_expand"] = _with(
        CONTRACTIONS,
        f"src AS (SELECT doc_id, lang, {contraction_text} AS text FROM documents)",
        expand("ex", "src", "doc_id", "con", "lang", inner="'’"),
        select="SELECT doc_id, lang, text FROM ex",
    )
    sql["tokens_alpha"] = _with(
        DOC_TOKENS,
        f"j AS ({joined('documents', 'tok', 'doc_id', 'form', 'tokens')})",
        select="SELECT doc_id, len(ws)::INTEGER AS n_words, tokens FROM tok_w JOIN j USING (doc_id)",
    )
    sql["stopword_filter"] = _with(
        STOP,
        DOC_TOKENS,
        """a AS (SELECT * FROM tok t WHERE NOT EXISTS (SELECT 1 FROM stop s WHERE s.lang = t.lang
          AND length(s.word) > 2 AND upper(s.word[1]) || s.word[2:] = t.form))""",
        filtered("b", "a"),
        f"ja AS ({joined('documents', 'a', 'doc_id', 'form', 'after_lemma_list')})",
        f"jb AS ({joined('documents', 'b', 'doc_id', 'form', 'after_both_lists')})",
        select="SELECT * FROM ja JOIN jb USING (doc_id)",
    )
    sql["lemma_lookup"] = _with(
        LEXICON, DOC_TOKENS, annotated("ann", "tok"),
        select="SELECT lang, form, lemma, upos, count(*) AS n FROM ann GROUP BY 1, 2, 3, 4",
    )
    sql["pos_filter"] = _with(
        LEXICON, DOC_TOKENS, annotated("ann", "tok"),
        f"kept AS (SELECT * FROM ann WHERE upos IN {CONTENT})",
        f"j AS ({joined('documents', 'kept', 'doc_id', 'lower(lemma)', 'lemmas')})",
        select="SELECT j.doc_id, (SELECT count(*) FROM kept k WHERE k.doc_id = j.doc_id)::INTEGER AS n_lemmas, lemmas FROM j",
    )
    sql["pos_context"] = _with(LEXICON, DOC_TOKENS, TAGGED, select="""SELECT doc_id,
      string_agg(coalesce(tag, '-'), ' ' ORDER BY i) AS tags,
      coalesce(string_agg(lower(coalesce(lemma, form)), ' ' ORDER BY i) FILTER (tag IN ('VERB', 'NOUN', 'ADJ', 'PROPN')), '')
        AS lemmas FROM chosen GROUP BY doc_id""").replace("WITH", "WITH RECURSIVE", 1)
    sql["lemma_guess"] = _with(LEXICON, GUESSED, select="""SELECT f.lang, f.form,
      coalesce(f.form[1:length(f.form) - b.cut] || b.added, f.form) AS lemma, b.ending
      FROM held f LEFT JOIN (SELECT lang, form, unnest(arg_max(r, length(r.ending))) FROM fits GROUP BY 1, 2) b
      ON b.lang = f.lang AND b.form = f.form""")
    sql["lemmas_column"] = _with(*DOC_FILTERED, select=joined("documents", "fil", "doc_id", "w", "lemmas"))

    sql["unigram_counts"] = _with(*DOC_FILTERED, select="SELECT w AS token, count(*) AS n FROM fil GROUP BY 1")
    sql["bigram_counts"] = _with(*DOC_PHRASES, select="SELECT w, nx, n FROM ph_big")
    sql["phrase_vocab"] = _with(
        *DOC_PHRASES, select="SELECT count(*) AS vocab_size, sum(n)::BIGINT AS n_counted FROM ph_dict"
    )
    sql["phrase_scores"] = _with(
        *DOC_PHRASES, select="SELECT w, nx, n, n_w, n_nx, round(score, 6) AS score FROM ph_phr"
    )
    sql["phrase_vocab_estimate"] = _with(*DOC_PHRASES, select="SELECT count(*) AS vocab_size, true AS close FROM ph_dict")
    sql["phrases_incremental"] = sql["phrase_scores"]
    sql["phrase_merge"] = _with(*DOC_PHRASES, select=joined("documents", "ph_out", "doc_id", "token", "lemmas"))

    sql["max_length"] = """SELECT max(length(text))::INTEGER AS max_text, max(length(source))::INTEGER AS max_source,
      greatest(max(length(text)), max(length(source)))::INTEGER AS max_length FROM documents"""
    sql["overlength_report"] = r"""SELECT max(n)::BIGINT AS max_words, count(*) FILTER (n > 384) AS n_above_limit,
      count(*) AS n_texts FROM (SELECT len(regexp_extract_all(text, '[^\t-\r\x1c-\x20\x{85}\p{Z}]+')) AS n FROM documents)"""
    sql["duplicate_ids"] = "SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1"

    sql["truncate_tokens"] = f"""SELECT doc_id,
      array_to_string(regexp_extract_all(lower(text), '{WORD}')[1:384], ' ') AS encoder_input FROM documents"""
    sql["embed_hash"] = _with(hashed("documents", "doc_id"), select="SELECT doc_id, dim, val FROM cells")
    sql["incremental_embed"] = sql["embed_hash"]
    number = "CAST(CAST(x AS DOUBLE) AS DECIMAL(23, 5))::VARCHAR"
    as_text = f"array_to_string(list_transform(embedding, lambda x: {number}), '{{}}')"
    sql["embedding_join"] = f"""SELECT doc_id, lang, label, len(embedding)::INTEGER AS n_dims,
      {as_text.format(' ')} AS embeddings FROM documents JOIN embeddings ON doc_id = vec_id"""
    sql["embedding_text"] = f"""SELECT vec_id, {as_text.format(' ')} AS spaced, '[' || {as_text.format(', ')} || ']' AS listed,
      round(list_sum(list_transform(embedding, lambda x: CAST(CAST(CAST(x AS DOUBLE) AS DECIMAL(23, 5)) AS DOUBLE))), 5) AS total
      FROM embeddings"""
    sql["unprocessed_docs"] = """SELECT doc_id, source FROM documents d
      WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""
    sql["user_model"] = """SELECT doc_id, len(list_distinct(regexp_extract_all(lower(text), '[a-z]')))::INTEGER AS n_letters
      FROM documents"""

    sql["prepare_titled"] = _with(
        ACRONYMS, CONTRACTIONS, STOP, LEXICON, TITLED, language("documents", "doc_id"),
        "eng AS (SELECT doc_id, 'en' AS lang, raw_text FROM titled JOIN pred USING (doc_id) WHERE pred_lang = 'en')",
        expand("e1", "eng", "doc_id", "acr", "lang raw_text", text="raw_text"),
        expand("e2", "e1", "doc_id", "con", "lang raw_text", inner="'’"),
        tokens("tok", "e2", "doc_id"),
        annotated("ann", "tok"),
        f"cont AS (SELECT * FROM ann WHERE upos IS NULL OR upos IN {CONTENT})",
        """fil AS (SELECT doc_id, pos, lower(lemma) AS w FROM cont t
          WHERE NOT EXISTS (SELECT 1 FROM stop s WHERE s.lang = t.lang AND s.word = lower(t.form)))""",
        phrases("ph", "fil", "doc_id"),
        select=joined("eng", "ph_out", "doc_id", "token", "lemmas", "raw_text"),
    )
    sql["prepare_fields"] = _with(
        ACRONYMS, CONTRACTIONS, STOP, TURNS, language("turns", "turn_id"),
        "spa AS (SELECT turn_id, 'es' AS lang, role, turns.text FROM turns JOIN pred USING (turn_id) WHERE pred_lang = 'es')",
        expand("t1", "spa", "turn_id", "acr", "lang", text="text"),
        expand("r1", "spa", "turn_id", "acr", "lang", text="role"),
        tokens("tt", "t1", "turn_id"), filtered("tf", "tt"), phrases("tp", "tf", "turn_id"),
        tokens("rt", "r1", "turn_id"), filtered("rf", "rt"), phrases("rp", "rf", "turn_id"),
        f"jt AS ({joined('spa', 'tp_out', 'turn_id', 'token', 'text_lemmas', 'text role')})",
        f"jr AS ({joined('spa', 'rp_out', 'turn_id', 'token', 'role_lemmas')})",
        select="""SELECT split_part(turn_id, '-', 1)::BIGINT AS conv_id, text AS text_raw_text, role AS role_raw_text,
          text_lemmas, role_lemmas FROM jt JOIN jr USING (turn_id)""",
    )
    sql["prepare_embedded"] = _with(
        STOP,
        "deu AS (SELECT doc_id, lang, text FROM documents WHERE lang = 'de' AND text <> 'nan')",
        tokens("tok", "deu", "doc_id"),
        filtered("fil", "tok"),
        f"j AS ({joined('deu', 'fil', 'doc_id', 'w', 'lemmas')})",
        hashed("deu", "doc_id"),
        select="SELECT doc_id, length(lemmas)::INTEGER AS n_lemma_chars, dim, val FROM j JOIN cells USING (doc_id)",
    )
    sql["prepare_csv"] = _with(
        STOP,
        "deu AS (SELECT doc_id, lang, replace(text, chr(10), ' ') AS text FROM documents WHERE lang = 'de' AND text <> 'nan')",
        tokens("tok", "deu", "doc_id"),
        filtered("fil", "tok"),
        select=joined("deu", "fil", "doc_id", "w", "lemmas"),
    )
    return sql


ORACLE_SQL = build()
