import json

import pytest

from corpusprep.__main__ import arguments, run


def test_application(spark, tmp_path):
    rows = [(i, "the new york has it and is not far", "title", "en") for i in range(5)] + [(9, "la casa de los perros", "t", "es")]
    spark.createDataFrame(rows, "key bigint, body string, head string, code string").write.parquet(str(tmp_path / "in"))
    (tmp_path / "config.json").write_text(json.dumps({"mine": {"id": "key", "raw_text": "body", "title": "head"}}))
    for lang in ("en", "es"):
        (tmp_path / "stw" / lang).mkdir(parents=True)
        (tmp_path / "stw" / lang / "list.txt").write_text("x\ny\nz\nfar\n")
    base = ["--source_path", str(tmp_path / "in"), "--source", "mine", "--config_file", str(tmp_path / "config.json")]
    base += ["--destination_path", str(tmp_path / "out"), "--stw_path", str(tmp_path / "stw"), "--stw_skip_lines", "3"]
    paths = run(spark, arguments([*base, "--do_embeddings", "--embeddings_dims", "4"]))
    assert paths == [str(tmp_path / "out"), str(tmp_path / "out_embeddings")]
    out = spark.read.parquet(paths[0])
    assert out.columns == ["key", "raw_text", "lemmas"] and out.count() == 5
    assert out.first()["lemmas"] == "title new york information technology"
    assert dict(spark.read.parquet(paths[1]).dtypes)["embeddings"] == "string"

    spanish = run(spark, arguments([*base, "--lang", "es", "--lang_column", "code", "--no_ngrams", "--unique_id"]))
    assert [tuple(r) for r in spark.read.parquet(spanish[0]).collect()] == [(9, "t la casa de los perros", "t casa perros")]


def test_arguments_are_checked():
    with pytest.raises(SystemExit):
        arguments(["--source_path", "x"])
    with pytest.raises(SystemExit):
        arguments(["--source_path", "x", "--source", "s", "--destination_path", "d", "--lang", "fr"])
