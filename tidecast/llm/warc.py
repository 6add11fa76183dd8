"""Content-addressed web archive: payloads once, exact record headers, records by joins.

Every page becomes a WARC record. Its payload is stored under the SHA-256 of its bytes,
once however many pages share it: the page with the smallest id is the response, the
others revisit it. The header of every record, WARC fields and HTTP head, is stored
apart, byte by byte. Reading joins headers and payloads by digest and recovers the
records; every digest is computed again from the bytes and compared.

Payloads and the headers of responses lie in equally bucketed tables, so that payloads
are shuffled once, when they are written, and not for the join. Revisits of a much copied
page are dealt over many tasks by a salt.

A null payload is an empty one. Rows that repeat an id are records of their own, of which
one is the response. Null ids come last and make the record id without a number. Other
columns may have any name. An empty table makes an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from .common import query, table, written


@dataclass(frozen=True)
class Settings:
    """Payloads of fewer bytes than ``min_bytes`` stay with their header. The date is that
    of the capture, which a table of pages does not hold. A key's rows are dealt over
    ``salts`` tasks."""

    min_bytes: int = 0
    date: str = "1970-01-01T00:00:00Z"
    salts: int = 64


@dataclass(frozen=True)
class Archive:
    """The three tables of an archive below ``path``.

    ``payloads`` (key, payload), ``responses`` (key, header, inline) and ``revisits``
    (header); ``inline`` is a payload too small to be shared.
    """

    path: str
    payloads: DataFrame
    responses: DataFrame
    revisits: DataFrame


# Fixed values of the WARC 1.1 and base32 formats.
END = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_OF_SPARK = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
RECORD_ID = ("<urn:page:", ">")


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of bytes in base32: twenty bits of the hexadecimal form are four digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), *BASE32_OF_SPARK)


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit(RECORD_ID[0]), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(RECORD_ID[1]))


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; a field without a value is left out."""
    lines = [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit("")) for name, value in fields]
    return F.concat(*lines)


def _header(settings: Settings) -> Column:
    """WARC fields and HTTP head of a typed page, as bytes."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}"),
        _lines(("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", F.col("bytes").cast("string"))),
        F.lit(END),
    )
    is_response = F.col("record_type") == "response"
    # Characters that would end a header line are written as in an address.
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    fields = _lines(
        ("WARC-Type", F.col("record_type")),
        ("WARC-Record-ID", _record_id(F.col("page_id"))),
        ("WARC-Target-URI", target),
        ("WARC-Date", F.lit(settings.date)),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        ("WARC-Profile", F.when(~is_response, F.lit(REVISIT_PROFILE))),
        ("WARC-Refers-To", F.when(~is_response, _record_id(F.col("refers_to")))),
        ("Content-Type", F.lit("application/http;msgtype=response")),
        ("Content-Length", (F.length(http) + F.when(is_response, F.col("bytes")).otherwise(0)).cast("string")),
    )
    return F.concat(F.lit(f"WARC/1.1{END}"), fields, F.lit(END), http).cast("binary")


def _looked_up(rows: DataFrame, row: str, key: str, found: DataFrame, salts: int) -> DataFrame:
    """``rows`` left joined with ``found`` (one row per key) by ``key``.

    A key may have most of the rows. Rows are salted by ``row``, the salts that a key has
    are joined with ``found``, at most ``salts`` rows a key, and the rows with those.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(row), F.lit(salts)))
    used = salted.groupBy(key, "_salt").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    used = used.select(F.col(key).alias("_key"), F.col("_salt").alias("_at"))
    used = used.join(found.withColumnRenamed(key, "_found"), F.col("_key") == F.col("_found")).drop("_found")
    met = salted.join(used, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_at")), "left")
    return met.drop("_key", "_at", "_salt")


def typed_pages(facts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Facts of pages (row, page_id, key, bytes, sha1) with ``record_type`` and ``refers_to``."""
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "row")
    groups = facts.where(F.col("bytes") >= settings.min_bytes).groupBy("key").agg(
        F.min(order).alias("first"),
        F.count(F.lit(1)).alias("copies"),
        *[f(c).alias(f"{name}_{c}") for c in ("bytes", "sha1") for name, f in (("min", F.min), ("max", F.max))],
    )
    # Equal SHA-256 with another length or SHA-1 would be two payloads.
    same = (F.col("min_bytes") == F.col("max_bytes")) & (F.col("min_sha1") == F.col("max_sha1"))
    first = F.when(same, F.col("first")).otherwise(
        F.raise_error(F.concat(F.lit("payloads of one digest differ: "), F.hex("key")))
    )
    shared = groups.where(F.col("copies") > 1).select("key", first.alias("first"))
    met = _looked_up(facts, "row", "key", shared, settings.salts)
    revisits = (F.col("first.row") != F.col("row")) & (F.col("bytes") >= settings.min_bytes)
    revisits = F.coalesce(revisits, F.lit(False))
    return met.withColumns(
        {
            "record_type": F.when(revisits, "revisit").otherwise("response"),
            "refers_to": F.when(revisits, F.col("first.page_id")),
        }
    ).drop("first")


def _bucketed(rows: DataFrame, path: str, buckets: int) -> DataFrame:
    """``rows`` written in buckets of ``key`` below ``path``, as a table of the session."""
    name = f"archive_{uuid.uuid4().hex}"
    writer = rows.write.bucketBy(buckets, "key").sortBy("key").option("compression", "zstd")
    writer.option("path", path).saveAsTable(name)
    return rows.sparkSession.table(name)


def write_archive(
    pages: DataFrame,
    payload: str = "html",
    page_id: str = "page_id",
    url: str = "url",
    path: str | None = None,
    settings: Settings = Settings(),
) -> Archive:
    """Store ``pages`` as an archive below ``path``, by default a new shared folder."""
    spark = pages.sparkSession
    path = path or shared_folder(spark, "archive")
    data = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    keyed = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"),
        data.alias("payload"),
    ).withColumn("key", F.unhex(F.sha2("payload", 256)))
    facts = keyed.select(
        F.monotonically_increasing_id().alias("row"), "page_id", "url", "key",
        F.octet_length("payload").cast("bigint").alias("bytes"), base32_sha1(F.col("payload")).alias("sha1"),
    )
    # Row numbers are read again, not computed again.
    typed = typed_pages(written(facts, "page-facts"), settings)
    is_small = F.col("bytes") < settings.min_bytes
    heads = written(
        typed.select("record_type", "row", "key", is_small.alias("small"), _header(settings).alias("header")),
        "record-heads",
    )
    # As many buckets as the shuffle has partitions: each is written by one task.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    large = keyed.where(F.octet_length("payload") >= settings.min_bytes)
    # Copies fold within their task first; one of them crosses the shuffle from each task.
    once = large.select("key", "payload").dropDuplicates(["key"])
    payloads = _bucketed(once, f"{path}/payloads", buckets)
    responses = heads.where("record_type = 'response'").select("key", "header", "small", "row")
    if settings.min_bytes > 0:
        small = keyed.where(F.octet_length("payload") < settings.min_bytes).groupBy("key").agg(
            F.min("payload").alias("inline")
        )
        responses = _looked_up(responses, "row", "key", small, settings.salts)
    else:
        responses = responses.withColumn("inline", F.lit(None).cast("binary"))
    responses = responses.select("key", "header", F.when(F.col("small"), F.col("inline")).alias("inline"))
    responses = _bucketed(responses, f"{path}/responses", buckets)
    heads.where("record_type = 'revisit'").select("header").write.option("compression", "zstd").parquet(
        f"{path}/revisits"
    )
    return Archive(path, payloads, responses, spark.read.schema("header binary").parquet(f"{path}/revisits"))


def records(archive: Archive) -> DataFrame:
    """(key, record): every record as the bytes of a WARC file, its end included.

    Key is the payload's SHA-256, null for revisits, whose record has no payload.
    """
    stored = archive.payloads.withColumnRenamed("key", "_key")
    met = archive.responses.join(stored, F.col("key") == F.col("_key"), "left")
    payload = F.coalesce("inline", "payload")
    lost = F.raise_error(F.concat(F.lit("no payload of digest "), F.hex("key"))).cast("binary")
    end = F.lit(END + END).cast("binary")
    whole = F.concat("header", F.when(payload.isNull(), lost).otherwise(payload), end)
    return met.select("key", whole.alias("record")).unionByName(
        archive.revisits.select(
            F.lit(None).cast("binary").alias("key"), F.concat("header", end).alias("record")
        )
    )


RECORD = (
    "record_id string, record_type string, refers_to string, target string,"
    " payload binary, payload_bytes bigint, payload_digest string"
)


def _field(fields: dict[str, str], name: str) -> str | None:
    return fields.get(name.lower())


def parse_record(record: bytes, key: bytes | None = None) -> tuple:
    """The fields of :data:`RECORD` of one record. Digests and lengths are verified."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogateescape").split(END)
    fields = {n.lower(): v for n, _, v in (line.partition(": ") for line in lines[1:])}
    length = int(fields["content-length"])
    block = rest[:length]
    if not lines[0].startswith("WARC/") or len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"no whole record: {lines[:3]}")
    kind, stated = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    name, refers_to = fields["warc-record-id"], _field(fields, "WARC-Refers-To")
    target = _field(fields, "WARC-Target-URI")
    if kind == "revisit":
        return name, kind, refers_to, target, None, None, stated
    payload = block.partition(b"\r\n\r\n")[2]
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if digest != stated or key is not None and hashlib.sha256(payload).digest() != key:
        raise ValueError(f"payload and digest of {name} differ")
    return name, kind, refers_to, target, payload, len(payload), digest


def read_records(rows: DataFrame, payloads: bool = True) -> DataFrame:
    """The :data:`RECORD` of each of :func:`records`; without ``payload`` if not asked for."""
    schema = RECORD if payloads else RECORD.replace(" payload binary,", "")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"payload": pa.binary(), "payload_bytes": pa.int64()}
        names = [part.split()[0] for part in RECORD.split(",")]
        for batch in batches:
            parsed = []
            for key, record in zip(batch["key"], batch["record"]):
                row = parse_record(record.as_py(), key.as_py())
                parsed.append(row if payloads else row[:4] + (None,) + row[5:])
            columns = list(zip(*parsed)) or [()] * len(names)
            arrays = [pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, columns)]
            kept = [i for i, n in enumerate(names) if payloads or n != "payload"]
            yield pa.RecordBatch.from_arrays([arrays[i] for i in kept], [names[i] for i in kept])

    return rows.select("key", "record").mapInArrow(parse, schema)


def _page_of(record_id: str) -> Column:
    inner = F.col(record_id)
    inner = F.substring(inner, len(RECORD_ID[0]) + 1, F.length(inner) - len("".join(RECORD_ID)))
    return inner.try_cast("bigint")


def archived_pages(archive: Archive, settings: Settings = Settings()) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) read from an archive.

    The size and digest of a revisit are those of the payload it refers to.
    """
    read = written(read_records(records(archive), payloads=False), "records-read")
    # A page's copies have one key, so its response is the only one that is referred to.
    sizes = read.where("record_type = 'response'").groupBy("record_id", "payload_digest").agg(
        F.max("payload_bytes").alias("size")
    )
    sizes = sizes.withColumn("refers_to", F.concat_ws(" ", "record_id", "payload_digest")).select("refers_to", "size")
    wanted = read.where("record_type = 'revisit'").withColumn("page", F.col("refers_to")).withColumn(
        "refers_to", F.concat_ws(" ", "refers_to", "payload_digest")
    ).withColumn("at", F.monotonically_increasing_id())
    revisits = _looked_up(wanted, "at", "refers_to", sizes, settings.salts)
    plain = ("payload_digest", "record_type")
    responses = read.where("record_type = 'response'").select(
        _page_of("record_id").alias("page_id"), "payload_bytes", *plain, F.lit(None).cast("bigint").alias("refers_to")
    )
    size = F.coalesce("size", F.raise_error(F.concat(F.lit("nothing to revisit: "), "refers_to")).cast("bigint"))
    return responses.unionByName(
        revisits.select(
            _page_of("record_id").alias("page_id"), size.alias("payload_bytes"), *plain,
            _page_of("page").alias("refers_to"),
        )
    )


SETTINGS = Settings()

_DIGEST = " || ".join(
    f"to_base(('0x' || substr(sha1(html), {1 + 5 * i}, 5))::BIGINT, 32, 4)" for i in range(8)
)

ARCHIVE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
k AS (SELECT page_id, html, strlen(html)::BIGINT AS payload_bytes,
             translate({_DIGEST}, '{BASE32_OF_SPARK[0]}', '{BASE32_OF_SPARK[1]}') AS payload_digest,
             row_number() OVER (PARTITION BY html ORDER BY page_id NULLS LAST) AS nth,
             first_value(page_id) OVER (PARTITION BY html ORDER BY page_id NULLS LAST) AS first_id
      FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN nth > 1 AND payload_bytes >= {SETTINGS.min_bytes} THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN nth > 1 AND payload_bytes >= {SETTINGS.min_bytes} THEN first_id END AS refers_to
FROM k"""


@query("op13_content_addressed_warc", ARCHIVE_SQL)
def content_addressed_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages, archived and read back."""
    return archived_pages(write_archive(table(spark, folder, "pages"), settings=SETTINGS), SETTINGS)
