"""WARC records of pages in a content-addressed archive.

``headers`` keeps the exact header block of every record, ``payloads`` each distinct
payload once under its SHA-256. A digest is verified when payloads are stored, where equal
digests must mean equal bytes, and again when they are read. Records are header, blank
line, payload and two line ends; a join by digest brings them back byte for byte.

Of equal payloads of at least ``min_bytes`` bytes the record with the largest key is the
response and the others revisit it; shorter ones are all responses. A null payload is
empty. Repeated keys are separate records. An empty table gives an empty archive. Only the
key, URL and payload columns are read, so others may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legwork.llm.key_filter import maybe_in

MIN_BYTES = 1000
LINE_END = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
RECORD_DATE = "2024-01-01T00:00:00Z"


def record_id(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), key.cast("string"), F.lit(">"))


def plan_records(pages: DataFrame, key: str, url: str, html: str) -> tuple[DataFrame, DataFrame]:
    """``page_id, url, payload, digest, sha1, bytes`` of the pages, and per digest the largest key as ``owner``."""
    payload = F.coalesce(F.encode(F.col(html).cast("string"), "UTF-8"), F.lit("").cast("binary"))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload")).select(
        "*",
        F.sha2("payload", 256).alias("digest"),
        F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("bigint").alias("bytes"),
    )
    owners = (
        rows.groupBy("digest")
        .agg(
            F.max("page_id").alias("owner"),
            F.min(F.concat_ws(":", "sha1", "bytes")).alias("_low"),
            F.max(F.concat_ws(":", "sha1", "bytes")).alias("_high"),
        )
        .select(
            "digest",
            F.when(F.col("_low") == F.col("_high"), F.col("owner"))
            .otherwise(F.raise_error(F.lit("two payloads share a SHA-256 digest")))
            .alias("owner"),
        )
    )
    return rows, owners


def header_block(record_type: Column, key: Column, url: Column, sha1: Column, n_bytes: Column, refers_to: Column) -> Column:
    """The header of a record, up to and with the blank line."""
    revisit = record_type == "revisit"
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), record_type),
        F.concat(F.lit("WARC-Record-ID: "), record_id(key)),
        F.lit(f"WARC-Date: {RECORD_DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(url, r"[\r\n]+", " ")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), sha1),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_id(refers_to))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(n_bytes).cast("string")),
    ]
    return F.concat(F.concat_ws(LINE_END, *lines), F.lit(LINE_END * 2))


def write_archive(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = MIN_BYTES
) -> None:
    """Write ``headers`` and ``payloads`` under a new folder."""
    rows, owners = plan_records(pages, key, url, html)
    light = rows.select("page_id", "url", "digest", "sha1", "bytes").join(owners, "digest")
    revisit = (F.col("bytes") >= min_bytes) & (F.col("page_id") != F.col("owner"))
    kind = F.when(F.coalesce(revisit, F.lit(False)), "revisit").otherwise("response")
    header = header_block(kind, F.col("page_id"), F.col("url"), F.col("sha1"), F.col("bytes"), F.col("owner"))
    light.select("page_id", "digest", header.alias("header")).write.parquet(f"{path}/headers")
    # Payloads that occur once stay where they are; only those that may be copies move
    copied = rows.groupBy("digest").agg(F.count("*").alias("_n")).where("_n > 1").select("digest")
    body = rows.select("page_id", "digest", "payload").withColumn("_copied", maybe_in("digest", copied))
    held = owners.select(F.col("digest").alias("_digest"), "owner")
    apart = body.where("_copied").join(held, (F.col("digest") == F.col("_digest")) & F.col("page_id").eqNullSafe(F.col("owner")), "left_semi")
    once = apart.dropDuplicates(["digest"]).select("digest", "payload")
    body.where("not _copied").select("digest", "payload").unionByName(once).write.parquet(f"{path}/payloads")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads; reading one whose bytes do not match its digest fails."""
    rows = spark.read.parquet(f"{path}/payloads")
    sound = F.sha2("payload", 256) == F.col("digest")
    checked = F.when(sound, F.col("payload")).otherwise(F.raise_error(F.lit("payload does not match its digest")))
    return rows.select("digest", checked.alias("payload"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, header, payload, record``: the full payload of each page and its record's bytes.

    Payloads are verified before the join that brings them to their headers.
    """
    headers = spark.read.parquet(f"{path}/headers")
    rows = headers.join(read_payloads(spark, path), "digest")
    body = F.when(header_field("WARC-Type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    record = F.concat(F.encode("header", "UTF-8"), body, F.lit(LINE_END * 2).cast("binary"))
    return rows.select("page_id", "header", "payload", record.alias("record"))


def header_field(name: str, header: Column | str = "header") -> Column:
    """Value of a header line; null where the header lacks it."""
    found = F.regexp_extract(header, rf"(?m)^{name}: ([^\r\n]*)$", 1)
    return F.when(F.regexp_like(header, F.lit(rf"(?m)^{name}: ")), found)


def record_body() -> Column:
    """The bytes between a record's header and its end, from ``header`` and ``record``."""
    start = F.octet_length(F.encode("header", "UTF-8"))
    return F.substring("record", start + 1, F.octet_length("record") - start - 2 * len(LINE_END))


def page_records(records: DataFrame) -> DataFrame:
    """What the rebuilt records say of each page, checked against their own bytes.

    A response's length and digest are taken from the body of its record, a revisit's from
    the payload of the record it refers to.
    """
    revisit = header_field("WARC-Type") == "revisit"
    rows = records.withColumn("_body", record_body())
    payload = F.when(revisit, F.col("payload")).otherwise(F.col("_body"))
    rows = rows.withColumns({"payload_bytes": F.octet_length(payload).cast("bigint"), "payload_sha1": F.sha1(payload)})
    said = F.regexp_replace(header_field("WARC-Payload-Digest"), "^sha1:", "")
    agree = (said == F.col("payload_sha1")) & (header_field("Content-Length") == F.octet_length("_body").cast("string"))
    checked = F.when(agree, said).otherwise(F.raise_error(F.lit("record and payload disagree")))
    target = F.regexp_extract(header_field("WARC-Refers-To"), r"^<urn:page:(.*)>$", 1)
    return rows.select(
        "page_id",
        "payload_bytes",
        checked.alias("payload_digest"),
        header_field("WARC-Type").alias("record_type"),
        F.when(target != "", target).cast("bigint").alias("refers_to"),
    )
