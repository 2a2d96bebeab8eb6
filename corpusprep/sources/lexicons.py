"""Word lists and dictionaries as tables.

=============  ==========================================
stopwords      lang, word
acronyms       lang, acronym, expansion
contractions   lang, contraction, expansion
lemma lexicon  lang, form, lemma, pos
=============  ==========================================

Users bring their own tables of these shapes. The defaults below are short.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# English acronyms and what they stand for.
EN_ACRONYMS = {
    "MRI": "magnetic resonance image",
    "CT": "computed tomography",
    "PET": "positron emission tomography",
    "SPECT": "single photon emission computed tomography",
    "US": "ultrasound",
    "ALS": "amyotrophic lateral sclerosis",
    "ECG": "electrocardiogram",
    "EKG": "electrocardiogram",
    "EEG": "electroencephalogram",
    "EMG": "electromyogram",
    "HR": "heart rate",
    "ABX": "antibiotics",
    "AF": "atrial fibrillation",
    "XR": "x ray",
    "BLS": "basic life support",
    "BMD": "bone mass density",
    "BMI": "body mass index",
    "BP": "blood pressure",
    "Bx": "biopsy",
    "CAD": "coronary artery disease",
    "CAT": "computed axial tomography",
    "CBF": "cerebral blood flow",
    "CO2": "carbon dioxide",
    "O2": "oxygen",
    "H2O": "water",
    "CV": "cardiovascular",
    "DNA": "deoxyribonucleic acid",
    "RNA": "ribonucleic acid",
    "Dx": "diagnosis",
    "EOC": "emergency operations center",
    "FX": "fracture",
    "GI": "gastrointestinal",
    "GP": "general practitioner",
    "ICU": "intensive care unit",
    "IQ": "intelligence quotient",
    "IT": "information technology",
    "IV": "intravenous",
    "LOF": "loss of fluid",
    "LTC": "long term care",
    "LV": "left ventricle",
    "RV": "right ventricle",
    "MG": "milligram",
    "ML": "milliliter",
    "NIH": "national institutes of health",
    "NM": "neuromuscular",
    "OCD": "obsessive compulsive disorder",
    "OT": "occupational therapy",
    "PHS": "public health service",
    "PPE": "personal protective equipment",
    "QA": "quality assurance",
    "QI": "quality improvement",
    "RF": "risk factor",
    "Rx": "treatment",
    "SSA": "social security administration",
    "TB": "tuberculosis",
    "TLC": "total lung capacity",
    "VF": "ventricular fibrillation",
    "WHO": "world health organization",
    "MBA": "Master of Business Administration",
}

# Spanish acronyms and what they stand for.
ES_ACRONYMS = {
    "ADN": "ácido desoxirribonucleico",
    "ARN": "ácido ribonucleico",
    "ACV": "accidente cerebrovascular",
    "AEMPS": "Agencia Española de Medicamentos y Productos Sanitarios",
    "AIOS": "Asociación Española de Cirujanos",
    "COPD": "Enfermedad Pulmonar Obstructiva Crónica",
    "CTE": "Traumatismo Craneoencefálico",
    "EPOC": "Enfermedad Pulmonar Obstructiva Crónica",
    "GVA": "Gasto Ventilatorio Asistido",
    "HEPA": "Filtro de Aire de Partículas de Alta Eficiencia",
    "HIV": "Virus de Inmunodeficiencia Humana",
    "IBV": "Instituto de Biomecánica de Valencia",
    "INSALUD": "Instituto Nacional de la Salud",
    "IRAS": "Infecciones Respiratorias Agudas Severas",
    "IRSST": "Instituto Regional de Seguridad y Salud en el Trabajo",
    "ISO": "Organización Internacional de Normalización",
    "MSPE": "Informe de Evaluación del Progreso del Estudiante en Medicina",
    "NEUMO": "Neumología",
    "OMS": "Organización Mundial de la Salud",
    "OTAN": "Organización del Tratado del Atlántico Norte",
    "PCR": "Reacción en Cadena de la Polimerasa",
    "POC": "Punto de Atención",
    "SATSE": "Sindicato de Enfermería",
    "SNS": "Sistema Nacional de Salud",
    "STEMI": "Infarto de Miocardio con Elevación del Segmento ST",
    "SUAP": "Servicio de Urgencia de Atención Primaria",
    "TAC": "Tomografía Axial Computarizada",
    "TSI": "Trabajador Social Sanitario",
    "UCI": "Unidad de Cuidados Intensivos",
    "UCIN": "Unidad de Cuidados Intensivos Neonatales",
    "UCP": "Unidad de Cuidados Paliativos",
    "UVI": "Unidad de Vigilancia Intensiva",
    "ADE": "Administración y Dirección de Empresas",
    "ETSIT": "Escuela Técnica Superior de Ingenieros de Telecomunicación",
    "GREM": "Gestión de Recursos Humanos y Emprendimiento",
}

# Short function-word lists, written for this library.
DEFAULT_STOPWORDS = {
    "en": "a about after all also an and any are as at be been but by can could did do does for from had has "
    "have he her his how i if in into is it its may more most no not of on one or other our out over she so "
    "some such than that the their them then there these they this those to under up us was we were what when "
    "which while who will with would you your",
    "es": "a al algo ante antes como con contra cual cuando de del desde donde dos e el ella ellas ellos en entre "
    "era es esa ese eso esta este esto fue ha han hasta hay la las le les lo los más me mi muy no nos o otra otro "
    "para pero por porque que quien se ser si sin sobre son su sus también te todo tu un una uno unos y ya yo",
    "de": "aber als am an auch auf aus bei bin bis das dass dem den der des die dies doch du durch ein eine einem "
    "einen einer eines er es für hat ich ihr im in ist ja kann mit nach nicht noch nur ob oder ohne sein sich sie "
    "sind so über um und uns unter vom von vor war was wenn wer wie wir wird zu zum zur",
}


def default_stopwords(spark: SparkSession) -> DataFrame:
    return local_table(spark, stopword_rows(), "lang", "word")


def local_table(spark: SparkSession, rows: list[tuple[str, ...]], *names: str) -> DataFrame:
    """A short table of strings that is part of the plan and needs no job to be read."""
    columns = zip(*rows) if rows else [[] for _ in names]
    return spark.createDataFrame(pa.table({n: pa.array(list(c), pa.string()) for n, c in zip(names, columns)}))


def stopword_rows() -> list[tuple[str, str]]:
    return [(lang, word) for lang, text in DEFAULT_STOPWORDS.items() for word in text.split()]


def read_stopwords(spark: SparkSession, folder: str, lang: str, skip_lines: int = 0) -> DataFrame:
    """Words in all ``*.txt`` files of ``<folder>/<lang>``, one per line, each once.

    ``skip_lines`` leaves out that many lines at the start of every file, for
    lists that begin with a header.
    """
    return stopword_lines(spark, folder, lang, skip_lines).select("lang", "word").dropDuplicates(["lang", "word"])


def stopword_lines(spark: SparkSession, folder: str, lang: str, skip_lines: int = 0) -> DataFrame:
    """The lines behind ``read_stopwords`` with repeats, for counting what was given."""
    pattern = f"{folder.rstrip('/')}/{lang}/*.txt"
    if skip_lines:
        files = spark.read.text(pattern, wholetext=True)
        lines = files.select(F.posexplode(F.split("value", r"\r?\n")).alias("pos", "word"))
        lines = lines.where(F.col("pos") >= skip_lines)
    else:
        lines = spark.read.text(pattern).withColumnRenamed("value", "word")
    return lines.where("word <> ''").select(F.lit(lang).alias("lang"), "word")


def acronyms(spark: SparkSession, lang: str | None = None) -> DataFrame:
    """The default acronyms, of one language or of all."""
    table = local_table(spark, acronym_rows(), "lang", "acronym", "expansion")
    return table if lang is None else table.where(F.col("lang") == lang)


def acronym_rows() -> list[tuple[str, str, str]]:
    return [("en", a, e) for a, e in EN_ACRONYMS.items()] + [("es", a, e) for a, e in ES_ACRONYMS.items()]


def contractions(spark: SparkSession) -> DataFrame:
    """The default contractions: common English ones."""
    return local_table(spark, contraction_rows(), "lang", "contraction", "expansion")


def contraction_rows() -> list[tuple[str, str, str]]:
    """(lang, contraction, expansion), built from pronouns, verbs and endings."""
    pronouns = "i you he she it we they that there who what".split()
    endings = {"'ll": "will", "'d": "would", "'ve": "have"}
    rows = [(p + e, f"{p} {full}") for p in pronouns for e, full in endings.items()]
    rows += [(p + "'re", p + " are") for p in ("you", "we", "they", "who", "what", "there")]
    rows += [(p + "'s", p + " is") for p in ("he", "she", "it", "that", "there", "who", "what", "here", "where")]
    negated = "are could did do does had has have is might must need should was were would"
    rows += [(verb + "n't", verb + " not") for verb in negated.split()]
    rows += [("i'm", "i am"), ("can't", "cannot"), ("won't", "will not"), ("shan't", "shall not"), ("let's", "let us")]
    fixed = [(c, "I" + e[1:] if e.startswith("i ") else e) for c, e in rows]
    return [("en", c, e) for c, e in fixed]
