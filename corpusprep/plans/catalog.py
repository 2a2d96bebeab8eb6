"""Every operator as a query over the tables of one data folder.

Each function takes (spark, folder) and returns a DataFrame. All rows and whole
texts are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.functions.vectors import parse_vector, vector_list_text, vector_text
from corpusprep.operators import embed, extend, language, lemma, phrases, quality, rewrite, shape, tagger
from corpusprep.operators.tallies import word_tallies
from corpusprep.plans import prepare as prep
from corpusprep.sources import lexicons, tables
from corpusprep.sources.mapping import FieldMapping
from corpusprep.streaming.incremental import PART, process_missing_parts, process_new_files, read_processed
from corpusprep.streaming.phrase_counts import count_new_files, counts_so_far
from corpusprep.work import new_path, staged, written

DIMS = 64


def table(spark: SparkSession, folder: str, name: str, spread: bool = False) -> DataFrame:
    return tables.read_table(spark, f"{folder}/{name}.parquet", spread=spread)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents for steps that work hard on each text."""
    return table(spark, folder, "documents", spread=True)


def staged_texts(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Documents in buckets of their key, for steps that join or group by it."""
    return staged(documents(spark, folder).select("doc_id", *columns), "doc_id", "documents")


# Sources and sinks


def scan_parquet(spark, folder):
    return documents(spark, folder).select("doc_id", "text", "lang", "source", "n_chars")


def csv_round_trip(spark, folder):
    """Documents written as csv and read back, line breaks and quotes included."""
    path = new_path(spark, "documents_csv")
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    docs.write.csv(path, header=True, quote='"', escape='"')
    return tables.read_table(spark, path, "csv", schema="doc_id bigint, text string, lang string")


def csv_split(spark, folder):
    """Documents in one large csv file, line breaks and quotes included, that many tasks read in splits."""
    path = new_path(spark, "documents_csv")
    docs = documents(spark, folder).select("doc_id", F.concat(F.lit('"'), "text", F.lit('"')).alias("text"), "lang")
    docs.write.csv(path, header=True, quote='"', escape='"')
    back = tables.read_table(spark, path, "csv", schema="doc_id bigint, text string, lang string", multi_line="split")
    return back.select("doc_id", F.expr("substring(text, 2, length(text) - 2)").alias("text"), "lang")


def saved_result(spark, folder):
    """A result with lemmas is saved, found by its column names and taken up again."""
    docs = documents(spark, folder)
    result = docs.select(
        "doc_id", F.col("text").alias("raw_text"), tx.join_tokens(tx.alpha_words(F.lower("text"))).alias("lemmas")
    )
    path = tables.save_parquet(result, new_path(spark, "result.parquet"), inputs=[f"{folder}/documents.parquet"])
    earlier, texts = tables.reuse_result(spark, path)
    return earlier.select("doc_id", *texts, "lemmas")


def input_parts(spark, folder):
    """Documents are written in six parts of several files each, and a seventh without rows; rows are counted by file."""
    path = new_path(spark, "parts.parquet")
    kept = documents(spark, folder).select("doc_id", F.pmod("doc_id", F.lit(6)).alias("part"))
    kept.repartition("part", F.pmod(F.hash("doc_id"), F.lit(4))).write.partitionBy("part").parquet(path)
    kept.where("false").select("doc_id").write.parquet(f"{path}/part=6")
    parts = tables.input_parts(spark, path)
    part = F.regexp_extract("file", r"part=(\d+)/", 1).cast("bigint")
    return parts.groupBy(part.alias("part")).agg(F.sum("n_rows").alias("n_rows"))


def stopword_load(spark, folder):
    """Lists made of the documents' words: both kinds of line ends, repeats, a header; read back, distinct and given."""
    path = new_path(spark, "lists")
    words = texts(spark, folder).select("doc_id", F.explode(tx.words(F.lower("text"))).alias("word"))
    ends = {"\n": "doc_id % 2 = 0", "\r\n": "doc_id % 2 = 1"}
    for end, which in ends.items():
        rows = words.where(which).where("length(word) <= 4").select("word")
        rows.write.option("lineSep", end).mode("append").text(f"{path}/en")
    given = lexicons.stopword_lines(spark, path, "en").groupBy("word").agg(F.count(F.lit(1)).alias("n_given"))
    distinct = lexicons.read_stopwords(spark, path, "en").withColumn("listed", F.lit(True))
    return given.join(distinct.drop("lang"), "word").select("word", "n_given", "listed")


def resume_parts(spark, folder):
    """Four part files, two of them done before: the rest is processed, and all results are read together."""
    base = new_path(spark, "resume")
    docs = documents(spark, folder).select("doc_id", F.col("text").alias("raw_text"))
    for part in range(4):
        path = f"{base}/in/documents_part_{part}.parquet"
        docs.where(F.pmod("doc_id", F.lit(4)) == part).write.parquet(path)

    def step(df):
        return df.select("doc_id", F.length("raw_text").cast("bigint").alias("n_chars"), *([PART] if PART in df.columns else []))

    for part in (0, 2):
        step(spark.read.parquet(f"{base}/in/documents_part_{part}.parquet")).write.parquet(f"{base}/out/documents_part_{part}.parquet")
    taken = process_missing_parts(spark, f"{base}/in", f"{base}/out", step)
    done = spark.read.option("recursiveFileLookup", True).parquet(f"{base}/out")
    return done.withColumn("n_taken", F.lit(len(taken)))


# Projections and filters

DOCUMENT_MAPPING = FieldMapping("doc_id", "text")
TITLED_MAPPING = FieldMapping("doc_id", "text", "source")
TURN_MAPPING = FieldMapping("turn_id", ("role", "text"))


def turns(spark, folder):
    conversations = table(spark, folder, "conversations", spread=True)
    return conversations.withColumn("turn_id", F.concat_ws("-", "conv_id", "turn"))


def apply_mapping(spark, folder):
    return shape.apply_mapping(documents(spark, folder), DOCUMENT_MAPPING)


def title_concat(spark, folder):
    return shape.apply_mapping(documents(spark, folder), TITLED_MAPPING)


def multi_field(spark, folder):
    corpus = shape.apply_mapping(turns(spark, folder), TURN_MAPPING)
    texts = shape.corpus_text_columns(TURN_MAPPING)
    for column, name in zip(texts, shape.derived_names(texts, "lemmas")):
        corpus = corpus.withColumn(name, tx.join_tokens(tx.alpha_words(F.lower(column))))
    return corpus


def null_fill(spark, folder):
    """Short texts are made null first, since the table has no nulls of its own."""
    docs = documents(spark, folder).select("doc_id", F.when(F.col("n_chars") > 500, F.col("text")).alias("text"), "source")
    return shape.null_fill(docs)


def drop_unusable(spark, folder):
    """Sentinel and null texts, made from the source name and the length, are dropped."""
    docs = documents(spark, folder).select(
        "doc_id",
        F.when(F.col("source") == "src3", "nan").otherwise(F.col("text")).alias("raw_text"),
        F.when(F.col("n_chars") > 300, F.col("lang")).alias("lang_raw_text"),
        F.when(F.col("source") == "src4", "nan").otherwise(F.col("source")).alias("source"),
    )
    return shape.drop_unusable(docs, ["raw_text", "lang_raw_text"])


# Language


def lang_model_counts(spark, folder):
    return language.trigram_counts(texts(spark, folder), "text", "lang")


def lang_predict_nb(spark, folder):
    docs = staged_texts(spark, folder, "text", "lang")
    model = language.train_language_model(docs, "text", "lang")
    return language.predict_language(docs.select("doc_id", "text"), "text", model, key="doc_id").select(
        "doc_id", "pred_lang"
    )


def lang_predict_turns(spark, folder):
    """The model of the documents labels the turns of conversations, unseen in training."""
    model = language.train_language_model(texts(spark, folder), "text", "lang")
    unlabelled = turns(spark, folder).select("turn_id", "text")
    return language.predict_language(unlabelled, "text", model, key="turn_id").select("turn_id", "pred_lang")


def lang_filter(spark, folder):
    docs = staged_texts(spark, folder, "text", "lang", "n_chars")
    model = language.train_language_model(docs, "text", "lang")
    labelled = language.predict_language(docs.select("doc_id", "text", "n_chars"), "text", model, key="doc_id")
    return language.keep_language(labelled, "es").select("doc_id", "text", "n_chars")


def lang_vote(spark, folder):
    docs = texts(spark, folder).select("doc_id", "text")
    return language.vote_language(docs, "text", lexicons.default_stopwords(spark)).select("doc_id", "pred_lang")


# Text

# Acronyms that are not one word.
COMPOUND_ACRONYMS = [
    ("en", "R&D", "research and development"),
    ("en", "COVID-19", "coronavirus disease"),
    ("en", "COVID", "coronavirus"),
]


def acronym_expand(spark, folder):
    """Acronyms of the row's language; some words are turned into acronyms first."""
    text = F.regexp_replace(F.regexp_replace("text", " nd ", " DNA "), " os ", " OMS ")
    text = F.regexp_replace(F.regexp_replace(text, " of ", " R&D "), " the ", " Covid-19 ")
    docs = texts(spark, folder).select("doc_id", "lang", text.alias("text"))
    table = lexicons.acronyms(spark).unionByName(lexicons.local_table(spark, COMPOUND_ACRONYMS, "lang", "acronym", "expansion"))
    return rewrite.expand_acronyms(docs, "text", table, F.col("lang"))


def contraction_expand(spark, folder):
    """Contractions of the row's language; some words are turned into contractions first."""
    text = F.regexp_replace("text", " is ", " isn't ")
    text = F.regexp_replace(text, " it ", " 'it’s' ")
    text = F.regexp_replace(text, " he ", " He'll ")
    docs = texts(spark, folder).select("doc_id", "lang", text.alias("text"))
    return rewrite.expand_contractions(docs, "text", lexicons.contractions(spark), F.col("lang"))


def tokens_alpha(spark, folder):
    tokens = tx.alpha_words(F.col("text"))
    return texts(spark, folder).select(
        "doc_id", F.size(tx.words(F.col("text"))).alias("n_words"), tx.join_tokens(tokens).alias("tokens")
    )


def stopword_filter(spark, folder):
    """Surface stopwords go in any case, lemma stopwords only as they are written."""
    docs = lemma.tokenise(texts(spark, folder).select("doc_id", "lang", "text"), "text")
    stopwords = lexicons.default_stopwords(spark)
    strict = F.struct(F.initcap("word").alias("word"), "lang")
    capital = stopwords.where(F.length("word") > 2).select(strict["lang"].alias("lang"), strict["word"].alias("word"))
    docs = lemma.drop_stopwords(docs, "tokens", capital, F.col("lang"), lower=False)
    shown = docs.select("doc_id", "lang", "tokens", tx.join_tokens(F.col("tokens")).alias("after_lemma_list"))
    both = lemma.drop_stopwords(shown, "tokens", stopwords, F.col("lang"), lower=True)
    return both.select("doc_id", "after_lemma_list", tx.join_tokens(F.col("tokens")).alias("after_both_lists"))


def corpus_lexicon(spark, folder):
    """(lang, form, lemma, pos) for forms that occur twice or more, from the documents.

    Endings are cut for the lemma and the length decides the part of speech: a
    lexicon that grows with the corpus, and leaves rare forms unlisted.
    """
    forms = word_tallies(texts(spark, folder), F.lower("text"), F.col("lang")).toDF("lang", "form", "n")
    listed = forms.groupBy("lang", "form").agg(F.sum("n").alias("count")).where(F.col("count") >= 2)
    stem = F.regexp_replace("form", "(ing|ed|es|s|en)$", "")
    kinds = F.array(*[F.lit(p) for p in ("NOUN", "VERB", "ADJ", "PROPN", "ADP", "DET")])
    return listed.select(
        "lang",
        "form",
        F.when(F.length(stem) >= 3, stem).otherwise(F.col("form")).alias("lemma"),
        F.get(kinds, F.length("form") % 6).alias("pos"),
    )


def lemma_lookup(spark, folder):
    """Lemmas of every token, counted."""
    docs = lemma.tokenise(texts(spark, folder).select("doc_id", "lang", "text"), "text")
    lexicon = written(corpus_lexicon(spark, folder), "lexicon")
    _, found, _ = lemma.lookup_lemmas(docs, "tokens", lexicon, F.col("lang"), key="doc_id")
    return found.groupBy("lang", "form", "lemma", "upos").agg(F.count(F.lit(1)).alias("n"))


def pos_filter(spark, folder):
    """Listed content words only, as lowercased lemmas per document."""
    docs = lemma.tokenise(staged_texts(spark, folder, "lang", "text"), "text").drop("text")
    lexicon = written(corpus_lexicon(spark, folder), "lexicon")
    docs = lemma.content_lemmas(docs, "tokens", F.col("lang"), lexicon=lexicon, keep_unlisted=False, key="doc_id")
    return docs.select("doc_id", F.size("tokens").alias("n_lemmas"), tx.join_tokens(F.col("tokens")).alias("lemmas"))


def ambiguous_lexicon(spark, folder):
    """``corpus_lexicon`` with a second part of speech for forms of some lengths, whose lemma is the form itself."""
    lexicon = corpus_lexicon(spark, folder)
    other = F.when(F.col("pos") == "NOUN", "VERB").otherwise("NOUN")
    second = lexicon.where("length(form) IN (3, 4, 6)").select("lang", "form", F.col("form").alias("lemma"), other.alias("pos"))
    return written(lexicon.unionByName(second), "ambiguous_lexicon")


def pos_context(spark, folder):
    """Parts of speech by context where a form has several, and the lemmas of content words."""
    docs = lemma.tokenise(staged_texts(spark, folder, "lang", "text"), "text").drop("text")
    docs = staged(docs, "doc_id", "tokens", dealt=True)
    model = tagger.train_tagger(docs, "tokens", ambiguous_lexicon(spark, folder), F.col("lang"), "doc_id")
    tagged = tagger.tag_tokens(docs, "tokens", model, F.col("lang"), "doc_id")
    content = F.filter("tagged", lambda t: t["upos"].isin(*lemma.CONTENT_POS))
    return tagged.select(
        "doc_id",
        F.array_join(F.transform("tagged", lambda t: F.coalesce(t["upos"], F.lit("-"))), " ").alias("tags"),
        F.array_join(F.transform(content, lambda t: F.lower(t["lemma"])), " ").alias("lemmas"),
    )


def lemma_guess(spark, folder):
    """A fifth of the lexicon is held out; its lemmas are guessed by rules from the rest."""
    lexicon = written(corpus_lexicon(spark, folder), "lexicon")
    held_out = F.conv(F.substring(F.md5("form"), 1, 8), 16, 10).cast("bigint") % 5 == 0
    rules = written(tagger.suffix_rules(lexicon.where(~held_out)), "rules")
    return tagger.guess_lemmas(lexicon.where(held_out), rules)


def _filtered(spark, folder, lang: str | None = None):
    """Tokens without stopwords, lowercased."""
    docs = texts(spark, folder)
    if lang is not None:
        docs = docs.where(F.col("lang") == lang)
    docs = lemma.tokenise(docs.select("doc_id", "lang", "text"), "text").drop("text")
    return lemma.content_lemmas(
        docs, "tokens", F.col("lang"), surface_stopwords=lexicons.default_stopwords(spark)
    )


def lemmas_column(spark, folder):
    return _filtered(spark, folder).select("doc_id", tx.join_tokens(F.col("tokens")).alias("lemmas"))


# Counts and phrases


def unigram_counts(spark, folder):
    return phrases.unigram_counts(phrases.follow_counts(_filtered(spark, folder)))


def bigram_counts(spark, folder):
    return phrases.bigram_counts(phrases.follow_counts(_filtered(spark, folder)))


def phrase_vocab(spark, folder):
    follows = written(phrases.follow_counts(_filtered(spark, folder)), "follow_counts")
    return phrases.vocabulary(follows).agg(F.count(F.lit(1)).alias("vocab_size"), F.sum("n").alias("n_counted"))


def phrase_scores(spark, folder):
    learned = phrases.learn_phrases(_filtered(spark, folder))
    return learned.withColumn("score", F.round("score", 6))


def phrase_vocab_estimate(spark, folder):
    """The size of the dictionary, and whether its estimate from the sketches of two halves of the corpus is close."""
    docs = written(_filtered(spark, folder).select("doc_id", "tokens"), "tokens")
    halves = [phrases.follows(docs.where(F.pmod("doc_id", F.lit(2)) == half)) for half in (0, 1)]
    sketches = phrases.vocabulary_sketch(halves[0]).unionAll(phrases.vocabulary_sketch(halves[1]))
    estimate = phrases.vocabulary_size(sketches)
    size = phrases.vocabulary(phrases.follow_counts(docs)).agg(F.count(F.lit(1)).alias("vocab_size"))
    return size.withColumn("close", F.abs(F.lit(estimate) - F.col("vocab_size")) <= 0.04 * F.col("vocab_size"))


def phrases_incremental(spark, folder):
    """Phrases from counts that are kept while documents arrive in three steps."""
    base = new_path(spark, "phrases")
    docs = _filtered(spark, folder).select("doc_id", "tokens")
    for n in range(3):
        docs.where(F.pmod("doc_id", F.lit(3)) == n).write.mode("append").parquet(f"{base}/in")
        count_new_files(spark, f"{base}/in", f"{base}/counts", f"{base}/checkpoint", lambda batch: batch)
    learned = phrases.learn_from_counts(counts_so_far(spark, f"{base}/counts"))
    return learned.withColumn("score", F.round("score", 6))


def phrase_merge(spark, folder):
    """Flagship: phrases of the whole corpus, merged into every document."""
    docs = staged(_filtered(spark, folder).select("doc_id", "tokens"), "doc_id", "tokens")
    learned = phrases.learn_phrases(docs)
    return phrases.merge_phrases(docs, learned, key="doc_id").select("doc_id", "lemmas")


# Lengths


def max_length(spark, folder):
    return quality.max_length(documents(spark, folder), ["text", "source"])


def overlength_report(spark, folder):
    return quality.overlength_report(documents(spark, folder), "text")


def duplicate_ids(spark, folder):
    """Orders share their customer, so customer keys repeat."""
    return quality.duplicate_ids(table(spark, folder, "orders"), "o_custkey")


# Embeddings


def truncate_tokens(spark, folder):
    tokens = embed.encoder_tokens(F.col("text"), embed.MAX_TOKENS)
    return texts(spark, folder).select("doc_id", tx.join_tokens(tokens).alias("encoder_input"))


def embed_hash(spark, folder):
    docs = embed.embed_hash(staged_texts(spark, folder, "text"), "text", DIMS, key="doc_id")
    cells = docs.select("doc_id", F.posexplode("embeddings").alias("dim", "val")).where("val <> 0")
    return cells.select("doc_id", "dim", F.round("val", 6).alias("val"))


def embed_word2vec(spark, folder):
    docs = texts(spark, folder).select("doc_id", "text")
    vectors = embed.train_word_vectors(docs, "text", dims=16, min_count=2)
    coded = vectors.encode(docs, "text")
    zero = F.forall("embeddings", lambda x: x == 0)
    return coded.select("doc_id", F.size("embeddings").alias("n_dims"), (~zero).alias("has_vector"))


def embedding_join(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    docs = documents(spark, folder).select("doc_id", "lang")
    joined = embed.attach_embeddings(docs, vectors, "doc_id", "vec_id")
    return joined.select("doc_id", "lang", "label", F.size("embedding").alias("n_dims"), vector_text(F.col("embedding"), 5).alias("embeddings"))


def embedding_text(spark, folder):
    """Both text forms, and the sum of the numbers read back from the list form."""
    vectors = table(spark, folder, "embeddings")
    as_list = vector_list_text(F.col("embedding"), 5)
    total = F.aggregate(parse_vector(as_list), F.lit(0.0), lambda acc, x: acc + x)
    return vectors.select(
        "vec_id", vector_text(F.col("embedding"), 5).alias("spaced"), as_list.alias("listed"), F.round(total, 5).alias("total")
    )


def unprocessed_docs(spark, folder):
    return embed.unprocessed(documents(spark, folder), table(spark, folder, "labels"), "doc_id").select("doc_id", "source")


def incremental_embed(spark, folder):
    """Documents arrive in three steps; each run of the stream takes only what is new, however old its files are."""
    base = new_path(spark, "incremental")
    docs = documents(spark, folder).select("doc_id", F.col("text").alias("raw_text"), "lang")
    step = prep.hash_encoder(DIMS, None, "doc_id")

    def take(batch):
        return step(staged(batch, "doc_id", "batch"), "raw_text", "embeddings")

    steps = (docs.where("lang = 'en'"), docs.where("lang IN ('fr', 'de')"), docs.where("lang NOT IN ('en', 'fr', 'de')"))
    for n, arrived in enumerate(steps):
        arrived.write.mode("append").parquet(f"{base}/in")
        if n == 1:
            _make_older(spark, f"{base}/in", days=30)
        process_new_files(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", take, docs.schema)
    cells = read_processed(spark, f"{base}/out").select("doc_id", F.posexplode("embeddings").alias("dim", "val"))
    return cells.where("val <> 0").select("doc_id", "dim", F.round("val", 6).alias("val"))


def _make_older(spark, path: str, days: int) -> None:
    """Set back the times of all files in a folder, as copies that keep their times have them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in system.listStatus(folder):
        if found.isFile():
            system.setTimes(found.getPath(), found.getModificationTime() - days * 86_400_000, -1)


def user_model(spark, folder):
    """A user's function over batches of texts: here, the number of distinct letters."""

    def open_model():
        return lambda texts: [len({c for c in t.lower() if "a" <= c <= "z"}) for t in texts]

    docs = texts(spark, folder).select("doc_id", "text")
    return extend.apply_model(docs, "text", "n_letters", "int", open_model).select("doc_id", "n_letters")


# Whole runs


def _preparation(spark, folder, mapping, lang, unique_id=True, **options):
    docs = texts(spark, folder)
    return prep.Preparation(
        mapping=mapping,
        lang=lang,
        language_by=language.train_language_model(docs, "text", "lang"),
        acronyms=lexicons.acronyms(spark),
        contractions=lexicons.contractions(spark),
        surface_stopwords=lexicons.default_stopwords(spark),
        unique_id=unique_id,
        **options,
    )


def prepare_titled(spark, folder):
    """English documents with their title: language model, rewriting, lexicon, phrases."""
    plan = _preparation(
        spark, folder, TITLED_MAPPING, "en", lexicon=written(corpus_lexicon(spark, folder), "lexicon")
    )
    return prep.prepare(texts(spark, folder), plan)


def prepare_fields(spark, folder):
    """Two text columns of conversations, each with phrases of its own. Ids repeat."""
    plan = _preparation(spark, folder, FieldMapping("conv_id", ("text", "role")), "es", unique_id=False)
    return prep.prepare(turns(spark, folder), plan)


def prepare_csv(spark, folder):
    """A run over csv files whose rows are one line each, with a schema: nothing is inferred, and files can be split."""
    docs = documents(spark, folder)
    source = new_path(spark, "documents_csv")
    flat = docs.select("doc_id", F.regexp_replace("text", r"\n", " ").alias("text"), "lang")
    flat.write.csv(source, header=True, quote='"', escape='"')
    plan = prep.Preparation(
        mapping=DOCUMENT_MAPPING,
        lang="de",
        language_by="lang",
        surface_stopwords=lexicons.default_stopwords(spark),
        ngrams=False,
        unique_id=True,
    )
    target = new_path(spark, "german.parquet")
    (path,) = prep.run(
        spark, source, target, plan, "csv", schema="doc_id bigint, text string, lang string", multi_line=False
    )
    return tables.read_table(spark, path).select("doc_id", "lemmas")


def prepare_embedded(spark, folder):
    """A saved run without phrases, taken up again for embeddings in text form."""
    plan = prep.Preparation(
        mapping=DOCUMENT_MAPPING,
        lang="de",
        language_by="lang",
        surface_stopwords=lexicons.default_stopwords(spark),
        ngrams=False,
        unique_id=True,
    )
    target = new_path(spark, "german.parquet")
    source = f"{folder}/documents.parquet"
    prep.run(spark, source, target, plan)
    encode = prep.hash_encoder(DIMS, None, "doc_id")
    (path,) = prep.run(spark, source, target, plan, preprocess=False, encode=encode)
    cells = tables.read_table(spark, path).select("doc_id", "lemmas", F.posexplode("embeddings").alias("dim", "val"))
    return cells.where("val <> 0").select("doc_id", F.length("lemmas").alias("n_lemma_chars"), "dim", F.round("val", 6).alias("val"))


QUERIES = {
    f.__name__: f
    for f in (
        scan_parquet, csv_round_trip, csv_split, saved_result, input_parts, stopword_load, resume_parts,
        apply_mapping, title_concat, multi_field, null_fill, drop_unusable,
        lang_model_counts, lang_predict_nb, lang_predict_turns, lang_filter, lang_vote,
        acronym_expand, contraction_expand, tokens_alpha, stopword_filter,
        lemma_lookup, pos_filter, pos_context, lemma_guess, lemmas_column,
        unigram_counts, bigram_counts, phrase_vocab, phrase_vocab_estimate, phrase_scores,
        phrases_incremental, phrase_merge,
        max_length, overlength_report, duplicate_ids,
        truncate_tokens, embed_hash, embed_word2vec, embedding_join, embedding_text,
        unprocessed_docs, incremental_embed, user_model,
        prepare_titled, prepare_fields, prepare_embedded, prepare_csv,
    )
}
