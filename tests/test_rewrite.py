import random
import re

import pytest
from pyspark.sql import functions as F

from corpusprep.operators.rewrite import expand_acronyms, expand_contractions
from corpusprep.sources import lexicons


def rewritten(spark, fn, texts, table, lang="en", **options):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id bigint, t string")
    out = fn(df, "t", table, F.lit(lang), key="id", **options).orderBy("id").collect()
    return [r["t"] for r in out]


SENTENCES = [
    "The MRI and ct, then it_ and éit; CO2/O2 (H2O)!",
    "WHO said us: It is IT.\n\tPETs pet-CT",
    "",
    "no acronym here",
    "x ray XR DNA-RNA, 'MBA'",
]


@pytest.mark.parametrize("literal_entries", [10_000, 1])
def test_one_pass_equals_replacing_one_acronym_after_another(spark, literal_entries):
    rng = random.Random(3)
    words = list(lexicons.EN_ACRONYMS) + ["the", "it", "x", "éit", "it_", "a1", "ñ"]
    made = ["".join(rng.choice(words) + rng.choice([" ", ", ", "-", "/", "'", "\n", ""]) for _ in range(30)) for _ in range(40)]
    texts = SENTENCES + made
    expected = []
    for text in texts:
        for acronym, expansion in lexicons.EN_ACRONYMS.items():
            text = re.sub(rf"\b{acronym}\b", expansion, text, flags=re.IGNORECASE)
        expected.append(text)
    got = rewritten(spark, expand_acronyms, texts, lexicons.acronyms(spark), literal_entries=literal_entries)
    assert got == expected


def test_upper_and_lower_case_can_be_told_apart(spark):
    texts = ["it and IT", "bx Bx BX"]
    table = lexicons.acronyms(spark)
    assert rewritten(spark, expand_acronyms, texts, table, case_sensitive=True) == [
        "it and information technology",
        "bx biopsy BX",
    ]


def test_other_languages_are_left_alone(spark):
    assert rewritten(spark, expand_acronyms, ["ISO UCI MRI"], lexicons.acronyms(spark), "de") == ["ISO UCI MRI"]
    spanish = rewritten(spark, expand_acronyms, ["la uci MRI"], lexicons.acronyms(spark), "es")
    assert spanish == ["la Unidad de Cuidados Intensivos MRI"]
    assert rewritten(spark, expand_contractions, ["it's"], lexicons.contractions(spark), "es") == ["it's"]


@pytest.mark.parametrize("literal_entries", [10_000, 1])
def test_contractions(spark, literal_entries):
    texts = ["You're right, it’s 'isn't' and I'm; they'd've rock'n'roll", "CAN'T won't ’tis dogs'", "", None]
    got = rewritten(spark, expand_contractions, texts, lexicons.contractions(spark), literal_entries=literal_entries)
    assert got == [
        "You are right, it is 'is not' and I am; they'd've rock'n'roll",
        "Cannot will not ’tis dogs'",
        "",
        None,
    ]


def test_a_word_listed_twice_has_one_expansion(spark):
    table = spark.createDataFrame([("en", "AB", "second"), ("en", "ab", "first")], "lang string, acronym string, expansion string")
    for limit in (10, 1):
        assert rewritten(spark, expand_acronyms, ["x ab"], table, literal_entries=limit) == ["x first"]


def test_an_empty_dictionary_changes_nothing(spark):
    table = lexicons.acronyms(spark).where("false")
    assert rewritten(spark, expand_acronyms, ["MRI"], table) == ["MRI"]


def test_small_dictionaries_move_no_rows(spark):
    from tests.conftest import plan_text

    df = spark.createDataFrame([(1, "MRI")], "id int, t string")
    text = plan_text(expand_acronyms(df, "t", lexicons.acronyms(spark), F.lit("en")))
    assert "Exchange" not in text and "Join" not in text
