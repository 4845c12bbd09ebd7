"""Zstandard WARC archives: written by Spark, one frame per record, and read back with full validation.

An archive begins with a skippable frame that holds the compression dictionary; each record is a frame of its own, and an empty
skippable frame stands between records, which lets a reader find them without decoding. Archives are written through Spark's
text writer (a row is a frame, the separator is the empty skippable frame), so the output committer and any store Spark can reach
are used, and lost tasks are repeated safely. Pages are dealt to archives of about ``ARCHIVE_BYTES`` bytes of payload by hash.

Of pages with equal payloads of at least ``revisit_from`` bytes the one with the largest id is a response and the others are revisits: they
carry the HTTP header, with the payload's length, but not the payload. Equal means equal length and SHA-1.

Odd input: null html is an empty payload, a null url an empty one; pages with a null id are revisits of the largest id of their
group if there is one, else responses; rows that repeat the largest id are all responses; an empty table gives no archive and
an empty result. Only the named columns are read. A damaged archive raises ValueError with the reason.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import urllib.parse
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.text import table
from millrace.scratch import scratch_path

ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
DICTIONARY_PAGES = 400
DICTIONARY_MAGIC = 0x184D2A5D
BETWEEN = struct.pack("<II", 0x184D2A50, 0)  # an empty skippable frame
DATE = "2024-01-01T00:00:00Z"
LEVEL = 3


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: str | None) -> str:
    """A null id and an empty one are told apart by the colon."""
    return "<urn:page>" if page_id is None else f"<urn:page:{urllib.parse.quote(page_id, safe='')}>"


def page_of(record: str) -> str | None:
    if record == "<urn:page>":
        return None
    if not (record.startswith("<urn:page:") and record.endswith(">")):
        raise ValueError(f"not a record id of a page: {record[:80]}")
    return urllib.parse.unquote(record[10:-1])


def record(page_id: str | None, url: str, payload: bytes, response: str | None) -> bytes:
    """A response record, or with ``response`` a revisit of that page's record."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if response is not None else http + payload
    fields = [("WARC-Type", "response" if response is None else "revisit"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE),
              ("WARC-Target-URI", urllib.parse.quote(url, safe=":/?#[]@!$&'()*+,;=%~")), ("Content-Type", "application/http;msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{sha1(payload)}"), ("WARC-Block-Digest", f"sha1:{sha1(block)}")]
    if response is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(response))]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of a record; ValueError if anything is amiss."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or lines[0] != "WARC/1.1":
        raise ValueError("no WARC/1.1 header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"not a header field: {line[:80]}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-block-digest"):
        if name not in fields:
            raise ValueError(f"{name} is missing")
    length = fields["content-length"]
    if not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError(f"content-length {length} does not fit a record of {len(rest)} bytes")
    block = rest[:-4]
    if fields["warc-block-digest"] != f"sha1:{sha1(block)}":
        raise ValueError("the block does not have its digest")
    return fields, block


def read_record(raw: bytes) -> tuple[str | None, int, str, str, str | None]:
    """(page, payload bytes, payload digest, type, page referred to)."""
    fields, block = parsed(raw)
    http, gap, payload = block.partition(b"\r\n\r\n")
    lengths = [line.split(b":")[1] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    if not gap or len(lengths) != 1:
        raise ValueError("no HTTP header with one content-length")
    size, digest, kind = int(lengths[0]), fields.get("warc-payload-digest", "").removeprefix("sha1:"), fields["warc-type"]
    if kind == "response":
        if len(payload) != size or sha1(payload) != digest:
            raise ValueError("the payload does not have its length and digest")
        return page_of(fields["warc-record-id"]), size, digest, kind, None
    if kind != "revisit" or payload or "warc-refers-to" not in fields:
        raise ValueError(f"not a response and not a revisit: {kind}")
    return page_of(fields["warc-record-id"]), size, digest, kind, page_of(fields["warc-refers-to"])


def frames(data: bytes) -> Iterator[bytes]:
    """The records of one archive, decoded with the dictionary of its leading frame."""
    import zstandard
    if len(data) < 8:
        raise ValueError("too short for an archive")
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC or len(data) < 8 + size:
        raise ValueError("no dictionary in the leading frame")
    words = data[8: 8 + size]
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)
    at = 8 + size
    while at < len(data):
        if data.startswith(BETWEEN, at):
            at += len(BETWEEN)
            continue
        end = data.find(BETWEEN, at)
        while True:
            if end < 0:
                raise ValueError("a frame is cut off")
            try:
                whole = decoder.decompress(data[at:end])
                break
            except zstandard.ZstdError:  # the separator's bytes stood inside a frame, or the frame is damaged
                end = data.find(BETWEEN, end + 1)
        yield whole
        at = end


def dictionary(pages: DataFrame, html_col: str = "html") -> bytes:
    """Trained on about DICTIONARY_PAGES pages, chosen by hash; empty if there is too little to learn from."""
    import zstandard
    full = pages.select(F.col(html_col).alias("html")).filter(F.length("html") > 0)
    share = min(1.0, DICTIONARY_PAGES / max(1, full.count()))
    rows = (full.filter(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else full)
    rows = rows.select(F.substring("html", 1, 20_000).alias("html")).limit(2 * DICTIONARY_PAGES).collect()
    samples = [r.html.encode() for r in rows]
    if len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 10 + 1024), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   revisit_from: int = 0) -> None:
    """One record per row of ``pages`` into archives in the folder ``path``."""
    src = pages.select(F.col(id_col).cast("string").alias("page"), F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                       F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    src = src.withColumn("bytes", F.octet_length("html")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    groups = (src.filter(F.col("bytes") >= revisit_from).groupBy("digest", "bytes").agg(F.max("id").alias("first"))
              .withColumn("response", F.col("first").cast("string")))
    # the payloads move once, to their archives; which of them revisit is worked out on digests and follows them there
    src = src.withColumn("row", F.concat(F.when(F.col("page").isNull(), "-").otherwise("+"), F.coalesce("page", F.lit(""))))
    revisits = (src.select("row", "page", "digest", "bytes").distinct().join(groups.drop("first"), ["digest", "bytes"])
                .filter(~F.col("page").eqNullSafe(F.col("response"))).select("row", "digest", "response"))
    revisits = revisits.filter("response IS NOT NULL")
    total = src.agg(F.sum("bytes").alias("b")).first().b or 0
    archives = max(1, -(-total // ARCHIVE_BYTES))
    placed = src.select("row", "digest", "page", "url", "html").repartition(archives, "row", "digest").hint("merge").join(
        revisits.repartition(archives, "row", "digest"), ["row", "digest"], "left")
    rows = placed.select("page", "url", "html", "response")
    words = dictionary(pages, html_col)

    def run(batches):
        import zstandard
        known = zstandard.ZstdCompressionDict(words) if words else None
        encoder = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=True)
        begun = False
        for batch in batches:
            out = [] if begun or not batch.num_rows else [struct.pack("<II", DICTIONARY_MAGIC, len(words)) + words]
            begun = begun or batch.num_rows > 0
            for page, url, html, response in zip(*(c.to_pylist() for c in batch.columns)):
                out.append(encoder.compress(record(page, url, html.encode(), response)))
            yield table("frame binary", [out])

    (rows.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", BETWEEN.decode("latin-1")).text(path))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page, payload_bytes, payload_digest, record_type, refers_to) per record; page ids are text."""
    schema = "page string, payload_bytes long, payload_digest string, record_type string, refers_to string"

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                rows = [read_record(r) for r in frames(data.as_py())]
                yield table(schema, [list(c) for c in zip(*rows)] or [[]] * 5)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, schema)


def round_trip(pages: DataFrame, id_col: str = "page_id", revisit_from: int = 0) -> DataFrame:
    """Pages written to archives in the scratch folder and read back."""
    path = scratch_path(pages.sparkSession, f"archives-{uuid.uuid4().hex[:8]}")
    write_archives(pages, path, id_col=id_col, revisit_from=revisit_from)
    kind = pages.schema[id_col].dataType
    out = read_archives(pages.sparkSession, path)
    return out.select(F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
