"""WARC archives with segmented records and revisits (operator 12).

Writing is DataFrame code: a page's HTTP response goes in chunked transfer framing into a ``response`` record, or, if it is
long, into a first segment and ``continuation`` records; a page whose payload another one has too becomes a ``revisit`` of
the one with the largest key. Spark's text sink writes the records, so the folder may lie wherever Spark can write.

Reading takes any .warc.gz files: Spark's text source cuts them at the version line, and a streaming parser puts pieces
together again up to each record's Content-Length, since a payload may hold that text too. Continuation records are grouped
by their origin's identifier, ordered by segment number and checked against the total length; then the chunked framing is
decoded and the payload digest compared. Only segments are shuffled, and a task holds one record at a time.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotally.llm.common import checkpointed, join_lookup, remove_folder, shared_folder

CRLF = "\r\n"
#: Bytes of payload in a chunk and of a block in a segment, and from which a repeated payload is not written again.
CHUNK, SEGMENT, LEAST_REVISIT = 8 * 1024, 32 * 1024, 1000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: What every record starts with; the text source cuts files here.
START = "WARC/1."
PARSED = "headers map<string,string>, segment int, body binary, problem string"


def _text(binary: Column) -> Column:
    return binary.cast("string")  # any bytes: Spark's strings are not checked on the way to the sink


def _bytes_of(payload: str) -> Column:
    return F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))


def chunked(payload: Column, size: int = CHUNK) -> Column:
    """A binary in chunked transfer framing."""
    n = F.octet_length(payload)
    chunk = lambda i: F.concat(F.lower(F.hex((F.least(n - i, F.lit(size))).cast("long"))), F.lit(CRLF), _text(F.substring(payload, i + 1, F.lit(size))), F.lit(CRLF))
    chunks = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(size)), chunk)).otherwise(F.array().cast("array<string>"))
    return F.concat(F.array_join(chunks, ""), F.lit("0" + CRLF * 2))


def _header(**fields: Column | str) -> Column:
    """Header lines of the fields that are not null; ``_`` stands for ``-``."""
    line = lambda name, v: F.concat(F.lit(name.replace("_", "-") + ": "), F.lit(v) if isinstance(v, str) else v, F.lit(CRLF))
    return F.concat(*[F.coalesce(line(name, v), F.lit("")) for name, v in fields.items()])


def _uri(url: str) -> Column:
    return F.replace(F.replace(F.col(f"`{url}`").cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def kept_responses(pages: DataFrame, *, key: str = "page_id", payload: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """sha256, winner: the largest key of every payload of at least ``least`` bytes that several rows hold. Digests are
    aggregated before the shuffle, so that one payload's many copies are a row per task."""
    rows = pages.select(F.col(f"`{key}`").alias("key"), _bytes_of(payload).alias("body"))
    rows = rows.where(F.octet_length("body") >= least).select("key", F.sha2("body", 256).alias("sha256"))
    return rows.groupBy("sha256").agg(F.max("key").alias("winner"), F.count("*").alias("n")).where("n > 1 and winner is not null").drop("n")


def record_texts(pages: DataFrame, *, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_REVISIT, chunk: int = CHUNK, segment: int = SEGMENT) -> DataFrame:
    """value: the WARC records of all rows, without the two line ends after each."""
    kept = checkpointed(kept_responses(pages, key=key, payload=payload, least=least))
    rows = pages.select(F.col(f"`{key}`").alias("key"), _uri(url).alias("uri"), _bytes_of(payload).alias("body")).withColumn("sha256", F.sha2("body", 256))
    rows = join_lookup(rows, kept, "sha256", F.struct("key", "uri"), kept.count())
    again = F.col("winner").isNotNull() & ~F.col("key").eqNullSafe(F.col("winner"))
    http = F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Transfer-Encoding: chunked" + CRLF * 2)
    rows = rows.select("key", "uri", again.alias("again"), "winner", F.sha1("body").alias("sha1"), F.concat(http, F.when(again, "").otherwise(chunked(F.col("body"), chunk))).cast("binary").alias("block"), F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")).alias("id"))
    n = F.octet_length("block")
    cut = F.transform(F.sequence(F.lit(0), n - 1, F.lit(segment)), lambda i: F.substring(F.col("block"), i + 1, F.lit(segment)))
    rows = rows.withColumns({"total": n, "pieces": cut}).withColumn("n_pieces", F.size("pieces")).drop("block")  # cut first: exploding must not repeat the block
    rows = rows.select("*", F.posexplode("pieces").alias("k", "piece")).drop("pieces")
    first, several, number = F.col("k") == 0, F.col("n_pieces") > 1, (F.col("k") + 1).cast("string")
    kind = F.when(~first, "continuation").when(F.col("again"), "revisit").otherwise("response")
    only = lambda when, v: F.when(when, v)
    head = _header(
        WARC_Type=kind, WARC_Record_ID=F.when(first, F.col("id")).otherwise(F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))), WARC_Date=DATE,
        WARC_Target_URI=F.col("uri"), X_Key=only(first, F.col("key").cast("string")), WARC_Payload_Digest=only(first, F.concat(F.lit("sha1:"), F.col("sha1"))),
        WARC_Profile=only(first & F.col("again"), F.lit(PROFILE)), X_Refers_To_Key=only(first & F.col("again"), F.col("winner").cast("string")),
        WARC_Segment_Number=only(several, number), WARC_Segment_Origin_ID=only(~first, F.col("id")),
        WARC_Segment_Total_Length=only(several & (F.col("k") + 1 == F.col("n_pieces")), F.col("total").cast("string")),
        Content_Type=only(first, F.lit("application/http; msgtype=response")), Content_Length=F.octet_length("piece").cast("string"),
    )
    return rows.select(F.concat(F.lit(START + "1" + CRLF), head, F.lit(CRLF), _text(F.col("piece"))).alias("value"))


def write_archives(pages: DataFrame, folder: str, **options) -> None:
    """Write a record per row of pages into .gz files of ``folder``; options as for ``record_texts``.

    A null or empty payload is an empty response. A row whose key is null is never the one that others revisit (unless no
    row has a key: then all are responses); rows that share the largest key are all responses. Repeated rows are a record
    each. Other columns are ignored, an empty table gives a folder without records."""
    record_texts(pages, **options).write.option("lineSep", CRLF * 2).option("compression", "gzip").text(folder)


# reading


def decoded(headers: dict[str, str], block: bytes) -> tuple[bytes | None, str | None]:
    """Payload of a record's block, and what is wrong with it: without the HTTP head and the chunked framing."""
    if not headers.get("content-type", "").startswith("application/http"):
        return block, None
    head, parted, body = block.partition(b"\r\n\r\n")
    if not parted:
        return None, "no HTTP head"
    if headers.get("warc-type") == "revisit":
        return None, None
    fields = [x.lower().partition(b":") for x in head.split(b"\r\n")[1:]]
    if any(name.strip() == b"transfer-encoding" and b"chunked" in value for name, _, value in fields):
        body, problem = unchunked(body)
        if problem:
            return None, problem
    algorithm, _, digest = headers.get("warc-payload-digest", "").partition(":")
    wrong = algorithm == "sha1" and len(digest) == 40 and hashlib.sha1(body, usedforsecurity=False).hexdigest() != digest.lower()
    return body, "payload digest differs" if wrong else None


def unchunked(body: bytes) -> tuple[bytes, str | None]:
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at : max(end, at)].split(b";")[0], 16)
        except ValueError:
            return b"", "bad chunk size"
        at = end + 2
        if size == 0:
            return b"".join(parts), None  # what follows are trailers
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            return b"", "bad chunk"
        parts.append(body[at : at + size])
        at += size + 2


class _Parser:
    """Records of a file from its pieces between version lines, one at a time."""

    def __init__(self) -> None:
        self.held: list[bytes] = []
        self.size = 0
        self.need: int | None = None

    def add(self, piece: bytes) -> tuple[dict[str, str], bytes, str | None] | None:
        """The record that a piece completes, if any."""
        if self.held:
            self.held.append(START.encode())
            self.size += len(START)
        elif not piece.strip():
            return None  # before the first record
        self.held.append(piece)
        self.size += len(piece)
        if self.need is None:
            whole = b"".join(self.held)
            self.held, end = [whole], whole.find(b"\r\n\r\n")
            if end < 0:
                return None
            length = next((v for n, v in self._fields(whole[:end]) if n == "content-length"), "")
            self.need = end + 8 + int(length) if length.isdigit() else 0
        return self.end() if self.size >= self.need else None

    def end(self) -> tuple[dict[str, str], bytes, str | None] | None:
        """What is held, as a record."""
        whole, need = b"".join(self.held), self.need
        self.held, self.size, self.need = [], 0, None
        if not whole.strip():
            return None
        head, _, rest = whole.partition(b"\r\n\r\n")
        headers = dict(self._fields(head))
        if not need or len(whole) < need:
            return headers, b"", "no length" if need == 0 else "truncated"
        return headers, rest[: need - len(head) - 8], None

    @staticmethod
    def _fields(head: bytes) -> list[tuple[str, str]]:
        lines = [x.partition(b":") for x in head.split(b"\r\n")[1:]]
        return [(n.strip().lower().decode("latin-1"), v.strip().decode("utf-8", "replace")) for n, _, v in lines]


def _batches(rows: Iterable[tuple], most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Rows (headers, segment, body, problem) as batches of bounded size."""
    schema = pa.schema([("headers", pa.map_(pa.string(), pa.string())), ("segment", pa.int32()), ("body", pa.binary()), ("problem", pa.string())])
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2] or b"") + 500
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def parsed_records(spark: SparkSession, folder: str, *, segmented: bool) -> DataFrame:
    """headers, segment, body, problem of all records that are (or are not) segments: the payload, or a segment's block."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        parser, file = _Parser(), None
        for batch in batches:
            for piece, path, start in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if path != file:
                    yield parser.end()
                    file = path
                    if start:
                        raise ValueError(f"{path} is read in splits, at whose start no record need begin: compress archives with gzip")
                yield parser.add(piece)
        yield parser.end()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for headers, block, problem in filter(None, records(batches)):
                number = headers.get("warc-segment-number", "")
                segment = int(number) if number.isdigit() else None
                if (segment is not None) == segmented:
                    body, wrong = (block, None) if segmented or problem else decoded(headers, block)
                    yield list(headers.items()), segment, body, problem or wrong

        return _batches(rows())

    pieces = spark.read.option("lineSep", START).text(folder).select(F.col("value").cast("binary"), "_metadata.file_path", "_metadata.file_block_start")
    return pieces.mapInArrow(parse, PARSED)


def reassembled(segments: DataFrame) -> DataFrame:
    """The segmented records whole: grouped by the identifier of their origin, in the order of their numbers, with the
    total length verified. A task goes through its segments in order and holds those of one record."""

    def whole(parts: list[tuple]) -> tuple:
        headers = dict(parts[0][1])
        problem = next((p[4] for p in parts if p[4]), None)
        total = next((v for p in parts for n, v in p[1] if n == "warc-segment-total-length"), None)
        block = b"".join(p[3] for p in parts)
        if not problem and [p[2] for p in parts] != list(range(1, len(parts) + 1)):
            problem = "segments missing or repeated"
        if not problem and str(len(block)) != total:
            problem = "no total length" if total is None else "total length differs"
        body, wrong = (None, None) if problem else decoded(headers, block)
        return list(headers.items()), None, body, problem or wrong

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            parts: list[tuple] = []
            for batch in batches:
                for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    if parts and parts[0][0] != row[0]:
                        yield whole(parts)
                        parts = []
                    parts.append(row)
            if parts:
                yield whole(parts)

        return _batches(rows())

    origin = F.coalesce(F.col("headers")["warc-segment-origin-id"], F.col("headers")["warc-record-id"])
    rows = segments.select(origin.alias("origin"), "headers", "segment", "body", "problem")
    return rows.repartition("origin").sortWithinPartitions("origin", "segment").mapInArrow(join, PARSED)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """headers (lower-case names), payload, problem of every record of the .gz files in ``folder``, segmented ones whole.

    A revisit's payload is null. ``problem`` says why a payload is missing or does not match its digest, and is null for
    sound records: truncated, no length, no HTTP head, bad chunk size, bad chunk, payload digest differs, segments missing or
    repeated, no total length, total length differs. No record is dropped; a folder without records gives none."""
    single = parsed_records(spark, folder, segmented=False)
    whole = reassembled(parsed_records(spark, folder, segmented=True))
    return single.unionByName(whole).select("headers", F.col("body").alias("payload"), "problem")


def summarised(records: DataFrame) -> DataFrame:
    """key, uri, payload_bytes, payload_digest, record_type, refers_to (key), problem of every record; a revisit takes
    length and digest from the response that it refers to, found by key and digest, or says that there is none."""
    field = lambda name: F.col("headers")[name]
    rows = records.select(
        field("x-key").alias("key"), field("warc-target-uri").alias("uri"), field("warc-type").alias("record_type"), field("x-refers-to-key").alias("refers_to"),
        F.regexp_replace(field("warc-payload-digest"), "^sha1:", "").alias("claimed"), F.octet_length("payload").cast("long").alias("n"), F.sha1("payload").alias("sha1"), "problem",
    )
    rows = checkpointed(rows)
    target = lambda key: F.concat_ws(" ", F.col(key), F.col("claimed")).alias("target")
    wanted = rows.where("record_type = 'revisit'").select(target("refers_to")).distinct()
    found = rows.where("record_type = 'response' and problem is null").select(target("key"), "n").groupBy("target").agg(F.max("n").alias("found"))
    found = checkpointed(found.join(wanted, "target", "left_semi"))
    rows = rows.withColumn("target", F.when(F.col("record_type") == "revisit", target("refers_to")))
    rows = join_lookup(rows, found, "target", F.col("key"), found.count())
    again = F.col("record_type") == "revisit"
    problem = F.coalesce("problem", F.when(again & F.col("found").isNull(), "no response"))
    return rows.select("key", "uri", F.when(again, F.col("found")).otherwise(F.col("n")).alias("payload_bytes"), F.when(again, F.col("claimed")).otherwise(F.col("sha1")).alias("payload_digest"), "record_type", "refers_to", problem.alias("problem"))


def round_trip(pages: DataFrame, *, key: str = "page_id", url: str = "url", payload: str = "html", **options) -> DataFrame:
    """Write pages to archives in the shared folder, read them back and summarise: page_id, payload_bytes, payload_digest,
    record_type, refers_to, problem. The archives are deleted when all are read."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder, key=key, url=url, payload=payload, **options)
    rows = summarised(read_archives(spark, folder))
    remove_folder(spark, folder)  # the summary lies in a checkpoint
    kind = pages.schema[key].dataType
    return rows.select(F.col("key").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "problem")


SQL = f"""
with p as (select page_id, coalesce(html, '') as body, strlen(coalesce(html, '')) as n from pages),
w as (select body, max(page_id) as winner, count(*) as m from p where n >= {LEAST_REVISIT} group by body having count(*) > 1 and max(page_id) is not null)
select page_id, n as payload_bytes, sha1(p.body) as payload_digest, case when winner is not null and page_id is distinct from winner then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from winner then winner end as refers_to, cast(null as varchar) as problem
from p left join w on p.body = w.body
"""
