"""A content-addressed archive of WARC records.

The archive has two tables in one folder. ``payloads`` stores each payload's bytes once, under
their SHA-256. ``headers`` stores for every record its exact header bytes (WARC and HTTP
headers, with the blank lines) and the address of its payload. A record is the header followed
by the payload; ``read_records`` puts records together again through a join, and
``read_headers`` parses what the headers say without moving a payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from halyard.llm.tables import discard, stored

# --- fixed values: record layout ------------------------------------------------
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "1970-01-01T00:00:00Z"
# --- end of fixed values ----------------------------------------------------

END = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 160 bits are 32 letters of 5 bits, without padding."""
    digits = F.sha1(payload)
    letters = []
    for block in range(4):  # ten hex digits are forty bits, eight letters
        number = F.conv(F.substring(digits, block * 10 + 1, 10), 16, 10).cast("long")
        for place in range(8):
            index = F.shiftright(number, 35 - 5 * place).bitwiseAND(F.lit(31))
            letters.append(F.substring(F.lit(BASE32), index.cast("int") + 1, F.lit(1)))
    return F.concat(*letters)


def record_id(key: Column) -> Column:
    """A URN made of the record's key, so that a rerun writes the same bytes."""
    digits = F.md5(F.concat(F.lit("record:"), F.coalesce(key.cast("string"), F.lit(""))))
    parts = [F.substring(digits, a + 1, n) for a, n in ((0, 8), (8, 4), (12, 4), (16, 4), (20, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _lines(*lines: Column | str) -> Column:
    return F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in lines])


def _index(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Per record its key, address, digests and size, and the record that its payload is kept in.

    Only digests and keys are shuffled. Copies are folded before they move (a partial maximum
    per digest); the join back is one that adaptive execution splits where a digest is hot.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    narrow = stored(
        pages.select(
            F.col("page_id"),
            F.col("url"),
            F.sha2(payload, 256).alias("address"),
            base32_sha1(payload).alias("payload_digest"),
            F.octet_length(payload).cast("long").alias("payload_bytes"),
        ),
        "warc-index",
    )
    keepers = narrow.groupBy("address").agg(
        F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")
    )
    repeated = stored(keepers.where(F.col("n") > 1).select("address", "keeper"), "warc-keepers")
    joined = narrow.join(repeated, "address", "left")
    other = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    revisit = other & (F.col("payload_bytes") >= F.lit(min_bytes))
    index = stored(
        joined.select(
            *narrow.columns,
            F.coalesce(F.col("keeper"), F.col("page_id")).alias("keeper"),
            revisit.alias("revisit"),
        ),
        "warc-records",
    )
    discard(narrow)
    discard(repeated)
    return index


def _headers(index: DataFrame) -> DataFrame:
    http = F.when(
        F.col("revisit"), F.lit("HTTP/1.1 200 OK" + END + "Content-Type: text/html" + END + END)
    ).otherwise(
        _lines(
            "HTTP/1.1 200 OK" + END + "Content-Type: text/html; charset=utf-8" + END,
            "Content-Length: ", F.col("payload_bytes").cast("string"), END + END,
        )
    )
    block = F.length(http) + F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("payload_bytes"))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    header = _lines(
        VERSION + END + "WARC-Type: ",
        F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")),
        END + "WARC-Record-ID: ", record_id(F.col("page_id")),
        END + "WARC-Date: " + DATE + END + "WARC-Target-URI: ", url,
        END + "WARC-Payload-Digest: sha1:", F.col("payload_digest"),
        END + "X-Page-Id: ", page,
        F.when(
            F.col("revisit"),
            _lines(
                END + "WARC-Profile: " + REVISIT_PROFILE + END + "WARC-Refers-To: ",
                record_id(F.col("keeper")),
                END + "X-Refers-To-Page-Id: ", F.col("keeper").cast("string"),
            ),
        ).otherwise(F.lit("")),
        END + "Content-Type: application/http; msgtype=response" + END + "Content-Length: ",
        block.cast("string"),
        END + END, http,
    )
    return index.select(
        "address", F.encode(header, "UTF-8").alias("header"), F.col("revisit").alias("bare")
    )


def write_archive(pages: DataFrame, path: str, *, min_bytes: int = 0) -> str:
    """Write one record per row of ``pages`` (page_id, url, html) to the archive at ``path``.

    A null html is an empty payload, a null url an empty target. Of records with equal payloads
    of at least ``min_bytes`` bytes the one with the largest page_id is a response, others
    revisit it; smaller payloads are all responses. Their bytes are stored once all the same.
    Rows that repeat a page_id with the same payload are records of their own, and of the rows
    that share the largest page_id each is a response. A null page_id is a record without an
    id; it can revisit but is never revisited, and stays a response where all ids are null. An
    empty table gives an empty archive. Other columns are not archived.
    """
    index = _index(pages, min_bytes)
    _headers(index).write.option("compression", "zstd").parquet(f"{path}/headers")
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("key")
    kept = index.where(F.col("page_id").eqNullSafe(F.col("keeper"))).select(key, "address")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    own = pages.select(key, payload.alias("payload")).withColumn("own", F.sha2("payload", 256))
    kept = kept.dropDuplicates(["address"])
    matched = own.join(kept.withColumnRenamed("address", "own"), ["key", "own"])
    # dealt as the join was, so payloads move once
    first = F.row_number().over(Window.partitionBy("key", "own").orderBy("key"))
    once = matched.withColumn("place", first).where(F.col("place") == 1)
    once.select(F.col("own").alias("address"), "payload").write.option("compression", "zstd").parquet(
        f"{path}/payloads"
    )
    discard(index)
    return path


def _field(name: str, pattern: str) -> Column:
    found = F.regexp_extract(F.col("text"), rf"(?md)^{name}: ({pattern})\r?$", 1)
    return F.nullif(found, F.lit(""))


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """What the archived headers say, a row per record: ``page_id``, ``url``, ``record_type``,
    ``record_id``, ``refers_to`` (page_id of the response that a revisit refers to),
    ``payload_digest`` and ``address``."""
    text = F.decode("header", "UTF-8").alias("text")
    return spark.read.parquet(f"{path}/headers").select("address", text).select(
        _field("X-Page-Id", "-?[0-9]+").cast("long").alias("page_id"),
        _field("WARC-Target-URI", "[^\\r\\n]*").alias("url"),
        _field("WARC-Type", "[a-z]+").alias("record_type"),
        _field("WARC-Record-ID", "<[^>]*>").alias("record_id"),
        _field("X-Refers-To-Page-Id", "-?[0-9]+").cast("long").alias("refers_to"),
        _field("WARC-Payload-Digest", "sha1:[A-Z2-7]+").alias("payload_digest"),
        "address",
    )


def payload_facts(spark: SparkSession, path: str) -> DataFrame:
    """Per stored payload its address, its size and its SHA-1, all computed from the bytes. A
    payload that does not have the digest it is stored under fails the job."""
    stored_payloads = spark.read.parquet(f"{path}/payloads")
    broken = F.raise_error(F.concat(F.lit("damaged payload "), F.col("address")))
    intact = F.sha2("payload", 256) == F.col("address")
    return stored_payloads.select(
        F.when(intact, F.col("address")).otherwise(broken).alias("address"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
    )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Read the archive back: ``page_id``, ``payload_bytes``, ``payload_digest`` (both from the
    stored payload), ``record_type`` and ``refers_to`` per record. Payloads are read and
    checked where they lie; only their digests are joined to the headers."""
    facts = payload_facts(spark, path).withColumnRenamed("payload_digest", "digest")
    read = read_headers(spark, path).join(facts, "address")
    wrong = F.raise_error(F.concat(F.lit("header and payload differ at "), F.col("address")))
    agrees = F.col("payload_digest") == F.concat(F.lit("sha1:"), F.col("digest"))
    return read.select(
        "page_id",
        "payload_bytes",
        F.when(agrees, F.col("digest")).otherwise(wrong).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The original records: ``page_id``, ``record`` (the exact bytes that a WARC file holds,
    with the two line ends after it) and ``html``. A revisit's record has no payload, while
    ``html`` is the payload it refers to."""
    payloads = spark.read.parquet(f"{path}/payloads")
    headers = spark.read.parquet(f"{path}/headers")
    text = F.decode("header", "UTF-8")
    named = headers.withColumn(
        "page_id", F.nullif(F.regexp_extract(text, r"(?md)^X-Page-Id: (-?[0-9]*)\r?$", 1), F.lit("")).cast("long")
    )
    tail = F.encode(F.lit(END + END), "UTF-8")
    body = F.when(F.col("bare"), F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload"))
    return named.join(payloads, "address").select(
        "page_id",
        F.concat("header", body, tail).alias("record"),
        F.decode("payload", "UTF-8").alias("html"),
    )
