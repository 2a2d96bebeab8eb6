"""Which columns of a named source hold the id, the text and the title."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class FieldMapping:
    """Column roles of one source.

    ``raw_text`` is one column name, or a tuple of names when each text column
    is to be prepared on its own. ``title`` is optional and only used with a
    single text column.
    """

    id: str
    raw_text: str | tuple[str, ...]
    title: str = ""

    @property
    def text_fields(self) -> tuple[str, ...]:
        return (self.raw_text,) if isinstance(self.raw_text, str) else self.raw_text

    @property
    def several(self) -> bool:
        return not isinstance(self.raw_text, str)

    @property
    def language_field(self) -> str:
        """The text column that decides a row's language: the first one."""
        return self.text_fields[0]

    @property
    def used_columns(self) -> list[str]:
        title = [self.title] if self.title and not self.several else []
        return list(dict.fromkeys([self.id, *self.text_fields, *title]))

    @classmethod
    def from_dict(cls, roles: Mapping) -> FieldMapping:
        """From ``{"id": …, "raw_text": name or list, "title": …}``; other keys are ignored."""
        text = roles["raw_text"]
        return cls(roles["id"], text if isinstance(text, str) else tuple(text), roles.get("title", ""))


# Sources known by name, with their id, text and title columns.
KNOWN_SOURCES = {
    "cordis": FieldMapping("projectID", "summary", "title"),
    "scholar": FieldMapping("corpusid", "abstract", "title"),
    "scholar-ai": FieldMapping("id", "text", ""),
    "unis": FieldMapping("iden", "Texto", "Nombre"),
    "scopus": FieldMapping("id", "description", "title"),
    "es_2025-02-08_segmented_dataset.parquet.gzip": FieldMapping("id", "text", "title"),
    "en_2025-02-08_segmented_dataset.parquet.gzip": FieldMapping("id", "text", "title"),
    "en_2025-02-20_segmented_dataset.parquet.gzip": FieldMapping("id_preproc", "text", "title"),
    "es_2025-02-20_segmented_dataset.parquet.gzip": FieldMapping("id_preproc", "text", "title"),
}


def read_mappings(spark: SparkSession, path: str) -> dict[str, FieldMapping]:
    """Mappings from a json file ``{source: {"id": …, "raw_text": …, "title": …}}``."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return {name: FieldMapping.from_dict(roles) for name, roles in json.loads(text).items()}


def find_mapping(source: str, mappings: Mapping[str, FieldMapping | Mapping] = KNOWN_SOURCES) -> FieldMapping:
    """The mapping of a named source; an unknown name is an error."""
    if source not in mappings:
        raise ValueError(f"unknown source {source!r}; known: {', '.join(sorted(mappings))}")
    found = mappings[source]
    return found if isinstance(found, FieldMapping) else FieldMapping.from_dict(found)
