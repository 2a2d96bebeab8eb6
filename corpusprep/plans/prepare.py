"""The whole run: source table → corpus → lemmas with phrases → embeddings."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions.text import join_tokens
from corpusprep.functions.vectors import vector_text
from corpusprep.operators.embed import embed_hash
from corpusprep.operators.language import LanguageModel, keep_language, predict_language, vote_language
from corpusprep.operators.lemma import CONTENT_POS, content_lemmas, lemma_arrays, tokenise
from corpusprep.operators.phrases import MIN_COUNT, THRESHOLD, learn_phrases, merge_phrases
from corpusprep.operators.quality import overlength_report
from corpusprep.operators.rewrite import expand_acronyms, expand_contractions
from corpusprep.operators.shape import apply_mapping, check_columns, corpus_text_columns, derived_names
from corpusprep.operators.shape import drop_unusable, null_fill
from corpusprep.operators.tagger import TagModel
from corpusprep.sources.mapping import FieldMapping
from corpusprep.sources.tables import embeddings_path, path_exists, read_table, refuse_overlap, reuse_result, save_parquet
from corpusprep.work import keyed, staged

LANGUAGES = ("en", "es", "de")


@dataclass(frozen=True)
class Preparation:
    """What to do with a source table.

    ``language_by`` decides which rows are in ``lang``: the name of a column with
    stored labels, a trained ``LanguageModel``, or a stopword table for a vote.
    Dictionaries left as None are not applied. ``tagger`` reads ambiguous forms of
    the ``lexicon`` by their context. Set ``unique_id`` when no id is
    missing or occurs twice; otherwise rows are numbered.
    """

    mapping: FieldMapping
    language_by: str | LanguageModel | DataFrame
    lang: str = "en"
    acronyms: DataFrame | None = None
    contractions: DataFrame | None = None
    lexicon: DataFrame | None = None
    tagger: TagModel | None = None
    surface_stopwords: DataFrame | None = None
    lemma_stopwords: DataFrame | None = None
    keep_pos: tuple[str, ...] | None = CONTENT_POS
    keep_unlisted: bool = True
    ngrams: bool = True
    min_count: int = MIN_COUNT
    threshold: float = THRESHOLD
    unique_id: bool = False
    phrases: dict[str, DataFrame] = field(default_factory=dict)
    """Phrase tables learned before, by text column; others are learned now."""

    @property
    def joins(self) -> bool:
        """Whether steps after the language find tokens by the key of their row."""
        return self.ngrams or self.lexicon is not None


def shape_corpus(df: DataFrame, plan: Preparation) -> tuple[DataFrame, str, list[str]]:
    """Rows in the wanted language with id and text columns; the key; the text columns."""
    mapping = plan.mapping
    check_columns(df, mapping)
    stored = plan.language_by if isinstance(plan.language_by, str) else None
    if stored is not None:
        df = df.where(F.col(stored) == plan.lang)
    df = null_fill(df.select(*mapping.used_columns))
    if not plan.unique_id:
        df, key = keyed(df, None)
    else:
        key = mapping.id
        if stored is None or plan.joins:
            df = staged(df, key, "source")
    if stored is None:
        by = plan.language_by
        label = predict_language if isinstance(by, LanguageModel) else vote_language
        # Labels are worked out once; the rows stay in their stage and are found there by each later step.
        labels = label(df.select(key, mapping.language_field), mapping.language_field, by, "pred_lang", key)
        labels = staged(labels.select(key, "pred_lang"), key, "labels", dealt=True)
        df = keep_language(df.join(labels, key), plan.lang)
    texts = corpus_text_columns(mapping)
    corpus = apply_mapping(df, mapping, keep=() if key == mapping.id else (key,))
    return drop_unusable(corpus, texts), key, texts


def rewritten(corpus: DataFrame, plan: Preparation, key: str, text_col: str, tokens: str) -> DataFrame:
    """Add ``tokens``, those of one text column after acronyms and contractions are written out."""
    lang = F.lit(plan.lang)
    df = corpus.withColumn("_text", F.col(text_col))
    if plan.acronyms is not None:
        df = expand_acronyms(df, "_text", plan.acronyms, lang, key=key)
    if plan.contractions is not None:
        df = expand_contractions(df, "_text", plan.contractions, lang, key=key)
    return tokenise(df, "_text", tokens).drop("_text")


def add_tokens(corpus: DataFrame, plan: Preparation, key: str, text_col: str, tokens: str) -> DataFrame:
    """Rewrite, tokenise, lemmatise and filter one text column into ``tokens``."""
    return content_lemmas(rewritten(corpus, plan, key, text_col, tokens), tokens, F.lit(plan.lang), **_choices(plan), key=key)


def token_table(corpus: DataFrame, plan: Preparation, key: str, text_col: str, tokens: str) -> DataFrame:
    """(key, ``tokens``) of one text column; with a lexicon only documents that keep a token."""
    df = rewritten(corpus.select(key, text_col), plan, key, text_col, tokens).select(key, tokens)
    make = content_lemmas if plan.lexicon is None else lemma_arrays
    return make(df, tokens, F.lit(plan.lang), **_choices(plan), key=key)


def _choices(plan: Preparation) -> dict:
    names = ("lexicon", "surface_stopwords", "lemma_stopwords", "keep_pos", "keep_unlisted")
    return {name: getattr(plan, name) for name in names} | {"model": plan.tagger}


def prepare(df: DataFrame, plan: Preparation) -> DataFrame:
    """Id, raw text column(s) and lemmas column(s).

    Texts are moved once, when their rows are staged by key. Tokens are a table of
    their own, staged by the same key, since learning and merging phrases read them
    three times. Each text column gets its own phrases.
    """
    corpus, key, texts = shape_corpus(df, plan)
    result = corpus
    for text, name in zip(texts, derived_names(texts, "lemmas")):
        if not plan.joins:
            result = add_tokens(result, plan, key, text, name).withColumn(name, join_tokens(F.col(name)))
            continue
        tokens = token_table(corpus, plan, key, text, "_tokens")
        if plan.ngrams:
            tokens = staged(tokens, key, "tokens", dealt=True)
            phrases = plan.phrases.get(text)
            if phrases is None:
                phrases = learn_phrases(tokens, "_tokens", plan.min_count, plan.threshold)
            lemmas = merge_phrases(tokens, phrases, "_tokens", name, key)
        else:
            lemmas = tokens.withColumn(name, join_tokens(F.col("_tokens")))
        result = result.join(lemmas.select(key, name), key, "left").withColumn(name, F.coalesce(name, F.lit("")))
    return result.select(plan.mapping.id, *texts, *derived_names(texts, "lemmas"))


Encoder = Callable[[DataFrame, str, str], DataFrame]
"""(df, text column, output column) → df with an array of numbers in the output column."""


def hash_encoder(dims: int = 64, max_tokens: int | None = None, key: str | None = None) -> Encoder:
    return lambda df, text, out: embed_hash(df, text, dims, out, key, max_tokens)


def add_embeddings(
    df: DataFrame,
    text_columns: list[str],
    encode: Encoder,
    max_words: int | None = None,
    as_text: bool = False,
) -> DataFrame:
    """Add one vector column per text column.

    With ``max_words`` each column is scanned first and a warning tells when the
    encoder will cut its longest text. ``as_text`` stores numbers separated by
    spaces instead of an array.
    """
    for text, name in zip(text_columns, derived_names(text_columns, "embeddings")):
        if max_words is not None:
            longest = overlength_report(df, text, max_words).first()["max_words"]
            if longest > max_words:
                warnings.warn(
                    f"the longest text of {text} has {longest} words; the encoder reads the first {max_words} tokens",
                    stacklevel=2,
                )
        df = encode(df, text, name)
        if as_text:
            df = df.withColumn(name, vector_text(F.col(name)))
    return df


def run(
    spark: SparkSession,
    source_path: str,
    destination_path: str,
    plan: Preparation,
    source_type: str = "parquet",
    preprocess: bool = True,
    encode: Encoder | None = None,
    max_words: int | None = None,
    as_text: bool = False,
    schema=None,
    multi_line: bool = True,
) -> list[str]:
    """Read, prepare, optionally embed, and write; returns the paths written.

    ``schema`` and ``multi_line`` are for csv sources, see ``read_table``.

    With ``preprocess=False`` an earlier result at ``destination_path`` is taken
    up if it has lemmas, and the source is read otherwise.
    """
    if not preprocess and encode is None:
        raise ValueError("nothing to do: switch on preprocessing, embeddings or both")
    if plan.lang not in LANGUAGES:
        raise ValueError(f"language {plan.lang!r} is not supported; supported: {', '.join(LANGUAGES)}")
    if not path_exists(spark, source_path):
        raise ValueError(f"source path {source_path} does not exist")
    refuse_overlap(spark, destination_path, [source_path])
    refuse_overlap(spark, embeddings_path(destination_path), [source_path])

    def source() -> DataFrame:
        return read_table(spark, source_path, source_type, schema, multi_line, spread=True)

    paths = []
    if preprocess:
        df = prepare(source(), plan)
        paths.append(save_parquet(df, destination_path, inputs=[source_path]))
    if encode is not None:
        earlier = reuse_result(spark, destination_path)
        if earlier is None:
            shaped, _, texts = shape_corpus(source(), plan)
            df = shaped.select(plan.mapping.id, *texts)
        else:
            df, texts = earlier
        df = add_embeddings(df, texts, encode, max_words, as_text)
        paths.append(save_parquet(df, embeddings_path(destination_path), inputs=[source_path, destination_path]))
    return paths
