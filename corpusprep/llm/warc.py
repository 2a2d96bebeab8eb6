"""A content-addressed WARC archive.

Two tables make the archive. ``payloads`` has each payload once, under its SHA-256. ``records`` has the exact header of
each WARC record and the key of its payload. Joining the two gives the original records back, byte for byte, and every
payload is checked against its key when it is read. ``read_records`` rebuilds the records, ``parse_records`` reads them.

Of records with equal payloads of at least ``min_bytes`` bytes, the one with the largest id is the response and the others
are revisits of it; smaller ones are all responses. Headers say so as WARC/1.1 does.

Only ids, digests and lengths are compared and grouped, after partial aggregation. Payloads are written by the tasks that
read them: the rows not to be stored (copies of others) are taken out by a join, which is a broadcast while they are few.

Defined results: a null payload counts as empty. A null id comes below every other; its record names no id. Rows with the
same payload that share the largest id are all responses, and a row that repeats id and payload gets an equal record.
A null address is left out of the header; line breaks in one are percent-encoded. Other columns of the input are not
archived. An empty table gives an archive without records.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusprep.llm.common import col
from corpusprep.work import broadcast_if_small, written

NEW_LINE = "\r\n"
#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

PAYLOADS_SCHEMA = "digest string, payload binary"
RECORDS_SCHEMA = "header string, digest string"


def _described(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    value = col(payload_col)
    if isinstance(pages.schema[payload_col].dataType, StringType):
        value = F.encode(value, "UTF-8")
    payload = F.coalesce(value, F.lit(b""))
    return pages.select(
        col(id_col).cast("bigint").alias("id"),
        col(url_col).alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )


def _field(name: str, value: Column) -> Column:
    """A header line; none when the value is null."""
    return F.concat(F.lit(f"{name}: "), value, F.lit(NEW_LINE))


def _record_id(id_: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), id_.cast("string"), F.lit(">"))


def _header(date: str) -> Column:
    """The header of a record from id, url, n_bytes, sha1 and refers_to, including that of the HTTP message inside."""
    revisit = F.col("is_revisit")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{NEW_LINE}Content-Type: text/html; charset=UTF-8{NEW_LINE}Content-Length: "),
        F.col("n_bytes").cast("string"),
        F.lit(NEW_LINE + NEW_LINE),
    )
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n_bytes"))
    address = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    parts = [
        F.lit(VERSION + NEW_LINE),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _record_id(F.col("id"))),
        _field("WARC-Target-URI", address),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        _field("WARC-Profile", F.when(revisit, PROFILE)),
        _field("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to")))),
        _field("Content-Type", F.lit("application/http;msgtype=response")),
        _field("Content-Length", length.cast("string")),
    ]
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts], F.lit(NEW_LINE), http)


def write_archive(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 1_000,
    date: str = DATE,
) -> str:
    """Write the rows of ``pages`` as an archive below ``path``, where nothing may be yet; returns ``path``."""
    found = _described(pages, id_col, url_col, payload_col)
    own = found.select("id", "url", "digest", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("n_bytes"))
    own = written(own, "described")
    shared = own.groupBy("digest", "n_bytes").agg(F.max("id").alias("last"), F.count("*").alias("times"))
    shared = broadcast_if_small(written(shared.where("times > 1").select("digest", "last", "n_bytes"), "shared"))

    marked = own.join(shared.select("digest", "last"), "digest", "left")
    copy = F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last"))
    marked = marked.withColumn("is_revisit", copy & (F.col("n_bytes") >= min_bytes))
    marked = marked.withColumn("refers_to", F.when(F.col("is_revisit"), F.col("last")))
    marked.select(_header(date).alias("header"), "digest").write.parquet(f"{path}/records")

    others = own.select("id", "digest").join(shared.select("digest", "last"), "digest").where(copy)
    others = broadcast_if_small(written(others.select("id", "digest").distinct(), "others"))
    same = found["id"].eqNullSafe(others["id"]) & (found["digest"] == others["digest"])
    stored = found.join(others, same, "left_anti").select("digest", "payload")
    stays = own.join(others, own["id"].eqNullSafe(others["id"]) & (own["digest"] == others["digest"]), "left_anti")
    if stays.groupBy("digest").count().where("count > 1").limit(1).count():  # rows that repeat id and payload
        stored = stored.dropDuplicates(["digest"])
    stored.write.parquet(f"{path}/payloads")
    return path


def _from_header(name: str, pattern: str) -> Column:
    found = F.regexp_extract("header", rf"(?m)^{name}: {pattern}\r?$", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, read from the header and the payload, which is joined by its key.

    page_id, url, record_type, refers_to, payload_bytes, payload_digest (SHA-1 of the payload in lower-case hexadecimal
    digits), payload, and record: the bytes as they would stand in a WARC file. A payload that does not have its digest
    fails the query. Columns that are not asked for are not read: without ``payload`` and ``record`` no payload moves.
    """
    payloads = spark.read.schema(PAYLOADS_SCHEMA).parquet(f"{path}/payloads")
    wrong = F.raise_error(F.concat(F.lit("payload is not what its digest says: "), "digest"))
    checked = payloads.select(
        "digest",
        "payload",
        F.when(F.sha2("payload", 256) == F.col("digest"), F.octet_length("payload"))
        .otherwise(wrong.cast("int"))
        .cast("bigint")
        .alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )
    records = spark.read.schema(RECORDS_SCHEMA).parquet(f"{path}/records")
    kind = _from_header("WARC-Type", "(\\w+)")
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return (
        records.withColumns(
            {
                "page_id": _from_header("WARC-Record-ID", "<urn:x-page:(-?\\d+)>").cast("bigint"),
                "url": _from_header("WARC-Target-URI", "([^\r\n]*)"),
                "record_type": kind,
                "refers_to": _from_header("WARC-Refers-To", "<urn:x-page:(-?\\d+)>").cast("bigint"),
            }
        )
        .join(checked, "digest")
        .select(
            "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload",
            F.concat(F.encode("header", "UTF-8"), block, F.lit((NEW_LINE + NEW_LINE).encode())).alias("record"),
        )
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): each record of an archive, byte for byte as it would stand in a WARC file.

    Only responses are joined with payloads; a revisit is a header, however many of them refer to one payload.
    """
    records = spark.read.schema(RECORDS_SCHEMA).parquet(f"{path}/records")
    payloads = spark.read.schema(PAYLOADS_SCHEMA).parquet(f"{path}/payloads")
    wrong = F.raise_error(F.concat(F.lit("payload is not what its digest says: "), "digest"))
    body = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(wrong.cast("binary"))
    response = _from_header("WARC-Type", "(\\w+)").eqNullSafe("response")
    header, ends = F.encode("header", "UTF-8"), F.lit((NEW_LINE + NEW_LINE).encode())
    whole = records.where(response).join(payloads, "digest").select(F.concat(header, body, ends).alias("record"))
    return whole.unionAll(records.where(~response).select(F.concat(header, ends).alias("record")))


def parse_records(records: DataFrame) -> DataFrame:
    """What the bytes of ``records`` (record) say: page_id, url, record_type, refers_to, payload_bytes, payload_digest.

    Length and SHA-1 of a response are those of the bytes behind its headers, and a response whose header states another
    digest fails the query. A revisit has those of the response that it refers to, or nulls if that is not there.
    """
    blank = NEW_LINE + NEW_LINE
    # Without the copy of a decoded text: both headers are what stands before the second blank line.
    head = F.substring_index(F.col("record").cast("string"), blank, 2)
    start = F.octet_length(head) + len(blank)
    body = F.substring(F.col("record"), start + 1, F.octet_length("record") - start - len(blank))
    kind = _from_header("WARC-Type", "(\\w+)")
    stated = _from_header("WARC-Payload-Digest", "sha1:([0-9a-f]+)")
    wrong = F.raise_error(F.concat(F.lit("payload is not what its header says: sha1:"), "stated"))
    parts = records.select(head.alias("header"), body.alias("body"))
    parsed = parts.select(
        _from_header("WARC-Record-ID", "<urn:x-page:(-?\\d+)>").cast("bigint").alias("page_id"),
        _from_header("WARC-Target-URI", "([^\r\n]*)").alias("url"),
        kind.alias("record_type"),
        _from_header("WARC-Refers-To", "<urn:x-page:(-?\\d+)>").cast("bigint").alias("refers_to"),
        stated.alias("stated"),
        F.when(kind == "response", F.octet_length("body").cast("bigint")).alias("n_bytes"),
        F.when(kind == "response", F.sha1("body")).alias("sha1"),
    )
    checked = F.when(F.col("sha1").isNull() | (F.col("sha1") == F.col("stated")), F.col("sha1")).otherwise(wrong)
    parsed = written(parsed.withColumn("sha1", checked), "parsed")
    # Many revisits may refer to one response; distinct references are worked out in the tasks first.
    wanted = parsed.where("record_type = 'revisit'").select(F.col("refers_to").alias("to_id"), F.col("stated").alias("to_sha1"))
    responses = parsed.where("record_type = 'response'").select("page_id", "sha1", F.col("n_bytes").alias("to_bytes"))
    found = F.col("page_id").eqNullSafe(F.col("to_id")) & (F.col("sha1") == F.col("to_sha1"))
    targets = wanted.distinct().join(responses, found).select("to_id", "to_sha1", "to_bytes").distinct()
    targets = broadcast_if_small(written(targets, "targets"))
    same = F.col("refers_to").eqNullSafe(F.col("to_id")) & (F.col("stated") == F.col("to_sha1"))
    same = (F.col("record_type") == "revisit") & same
    return parsed.join(targets, same, "left").select(
        "page_id", "url", "record_type", "refers_to",
        F.coalesce("n_bytes", "to_bytes").alias("payload_bytes"),
        F.coalesce("sha1", "to_sha1").alias("payload_digest"),
    )


def export_warc(spark: SparkSession, path: str, target: str, compression: str = "none") -> None:
    """Write the records of an archive of text payloads as WARC files, one per partition, below ``target``."""
    text = F.decode("record", "UTF-8")
    ends = NEW_LINE + NEW_LINE
    lines = read_records(spark, path).select(F.substring(text, F.lit(1), F.length(text) - len(ends)).alias("value"))
    lines.write.option("lineSep", ends).option("compression", compression).text(target)
