"""A preparation as a Spark application: ``python -m corpusprep --help``, or with spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from corpusprep.operators.extend import model_encoder, named_model
from corpusprep.operators.language import train_language_model
from corpusprep.plans import prepare as prep
from corpusprep.sources import lexicons, mapping, tables
from corpusprep.work import clear_work


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="corpusprep", description="Prepare a document table for topic modelling.")
    parser.add_argument("--source_path", required=True)
    parser.add_argument("--source_type", default="parquet", choices=tables.FORMATS)
    parser.add_argument("--source", required=True, help="name of the source, as in the mappings")
    parser.add_argument("--config_file", help="json file of mappings; known sources otherwise")
    parser.add_argument("--destination_path", required=True)
    parser.add_argument("--lang", default="en", choices=prep.LANGUAGES)
    parser.add_argument("--lang_column", help="column with stored language codes")
    parser.add_argument("--lang_training", help="parquet table (text, lang) to train the language model on")
    parser.add_argument("--stw_path", help="folder of stopword lists, <folder>/<lang>/*.txt; short defaults otherwise")
    parser.add_argument("--stw_skip_lines", type=int, default=0)
    parser.add_argument("--lexicon_path", help="parquet table (lang, form, lemma, pos)")
    parser.add_argument("--no_ngrams", action="store_true")
    parser.add_argument("--no_preproc", action="store_true")
    parser.add_argument("--do_embeddings", action="store_true")
    parser.add_argument("--embeddings_dims", type=int, default=64)
    parser.add_argument("--encoder", help="module:function that opens a model (texts -> lists of numbers); hashed words otherwise")
    parser.add_argument("--max_sequence_length", type=int, help="tokens that the encoder reads; whole texts otherwise")
    parser.add_argument("--csv_schema", help="columns and types of a csv source, as in 'id bigint, text string'")
    parser.add_argument("--csv_one_line_rows", action="store_true", help="no csv field has a line break; files can be split")
    parser.add_argument("--unique_id", action="store_true", help="no id occurs twice; saves one write")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    mappings = mapping.read_mappings(spark, args.config_file) if args.config_file else mapping.KNOWN_SOURCES
    defaults = lexicons.default_stopwords(spark)
    if args.lang_column:
        language_by = args.lang_column
    elif args.lang_training:
        language_by = train_language_model(spark.read.parquet(args.lang_training), "text", "lang")
    else:
        language_by = defaults
    listed = None
    if args.stw_path:
        listed = lexicons.read_stopwords(spark, args.stw_path, args.lang, args.stw_skip_lines)
    plan = prep.Preparation(
        mapping=mapping.find_mapping(args.source, mappings),
        language_by=language_by,
        lang=args.lang,
        acronyms=lexicons.acronyms(spark),
        contractions=lexicons.contractions(spark),
        lexicon=spark.read.parquet(args.lexicon_path) if args.lexicon_path else None,
        surface_stopwords=defaults,
        lemma_stopwords=listed,
        ngrams=not args.no_ngrams,
        unique_id=args.unique_id,
    )
    encode = None
    if args.do_embeddings and args.encoder:
        encode = model_encoder(named_model(args.encoder))
    elif args.do_embeddings:
        encode = prep.hash_encoder(args.embeddings_dims, args.max_sequence_length)
    return prep.run(
        spark, args.source_path, args.destination_path, plan, args.source_type, not args.no_preproc, encode,
        max_words=args.max_sequence_length, as_text=True, schema=args.csv_schema, multi_line=not args.csv_one_line_rows,
    )


if __name__ == "__main__":
    session = SparkSession.builder.appName("corpusprep").getOrCreate()
    for path in run(session, arguments()):
        print(path)
    clear_work(session)
