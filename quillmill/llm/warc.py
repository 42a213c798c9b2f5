"""WARC records, and their assembly into captures through WARC-Concurrent-To.

A capture is a set of records that refer to one another, directly or through others: the connected component of the
links between record ids. Links are read from the record headers alone. Each record that refers to another is joined to
it, and to what that one refers to; only links that still lead elsewhere go through the rounds of a component search. A
record that refers to none, as a response with its payload, is a capture's home unless such a link says otherwise, so it
moves once, to meet the records that refer to it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillmill.llm.components import connected_components
from quillmill.llm.scratch import Scratch

_PAIRS = "array<struct<name:string,value:string>>"
_PAIRS_ARROW = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
RECORD = f"record_id string, type string, target_uri string, date string, concurrent_to array<string>, headers {_PAIRS}, http_start string, http_headers {_PAIRS}, body binary"
_BREAK = "\r\n"


#: Records of links beyond the second step up to which they are sent to every executor.
BROADCAST_LINKS = 500_000
#: Bytes read at a time, and bytes of records handed over at once.
READ_BYTES, BATCH_BYTES = 1 << 20, 16 << 20


def _record_id(kind: str) -> Column:
    """Made of all that a page holds, and the number of the row among equal ones."""
    digest = F.md5(F.concat_ws(":", F.lit(kind), F.col("page_id").cast("string"), F.col("copy").cast("string"), F.md5(F.coalesce("url", F.lit(""))), F.md5("html")))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def _raw(kind: str, record_id: Column, to: Column | None, url: Column, content_type: str, block: Column) -> Column:
    head = [F.lit(f"WARC/1.1{_BREAK}WARC-Type: {kind}{_BREAK}WARC-Record-ID: "), record_id]
    if to is not None:
        head += [F.lit(f"{_BREAK}WARC-Concurrent-To: "), to]
    head += [F.lit(f"{_BREAK}WARC-Target-URI: "), url, F.lit(f"{_BREAK}WARC-Date: 2024-01-01T00:00:00Z{_BREAK}Content-Type: {content_type}{_BREAK}Content-Length: ")]
    return F.concat(*head, F.octet_length(block).cast("string"), F.lit(_BREAK * 2), block, F.lit(_BREAK * 2)).cast("binary")


def _numbered(page: DataFrame) -> DataFrame:
    """page (page_id, url, html) with copy, 1 but for rows that occur more than once. Those alone are shuffled."""
    key = ["page_id", F.md5(F.concat_ws(":", F.md5("url"), "html")).alias("digest")]
    again = page.select(*key).groupBy("page_id", "digest").count().where("count > 1").select("page_id").distinct()
    few = again.limit(BROADCAST_LINKS + 1).count()
    if not few:
        return page.withColumn("copy", F.lit(1).cast("long"))
    side = F.broadcast(again) if few <= BROADCAST_LINKS else again
    more = page.join(side, "page_id", "left_semi").groupBy("page_id", "url", "html").agg(F.count("*").alias("n"))
    more = more.select("page_id", "url", "html", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
    return page.join(side, "page_id", "left_anti").withColumn("copy", F.lit(1).cast("long")).unionByName(more)


def pages_to_warc(pages: DataFrame) -> DataFrame:
    """(raw): three WARC records per page: its response, the request for it, and metadata that names the request.

    A null url or html becomes an empty one. Rows with a null page_id are left out. Rows that repeat a page_id, or are
    equal in all, give records of their own. Other columns aren't read.
    """
    page = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html")).where("page_id IS NOT NULL")
    page = _numbered(page)
    url, response, request, metadata = F.col("url"), _record_id("response"), _record_id("request"), _record_id("metadata")
    path = F.coalesce(F.nullif(F.regexp_extract(url, r"^[a-z]+://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/"))
    host = F.regexp_extract(url, r"^[a-z]+://([^/?#]*)", 1)
    answer = F.concat(F.lit(f"HTTP/1.1 200 OK{_BREAK}Content-Type: text/html; charset=utf-8{_BREAK}Content-Length: "), F.octet_length("html").cast("string"), F.lit(_BREAK * 2), F.col("html"))
    ask = F.concat(F.lit("GET "), path, F.lit(f" HTTP/1.1{_BREAK}Host: "), host, F.lit(_BREAK * 2))
    fields = F.concat(F.lit("page_id: "), F.col("page_id").cast("string"), F.lit(_BREAK))
    records = F.array(
        _raw("response", response, None, url, "application/http; msgtype=response", answer),
        _raw("request", request, response, url, "application/http; msgtype=request", ask),
        _raw("metadata", metadata, request, url, "application/warc-fields", fields),
    )
    return page.select(F.explode(records).alias("raw"))


def _inflated(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """Chunks of a file, decompressed if it is in gzip's format, member after member; what follows damage is left out."""
    unpack = None
    for k, chunk in enumerate(chunks):
        if k == 0 and chunk[:2] == b"\x1f\x8b":
            unpack = zlib.decompressobj(31)
        if unpack is None:
            yield chunk
            continue
        while chunk:
            try:
                data = unpack.decompress(chunk, READ_BYTES)
            except zlib.error:
                return
            if data:
                yield data
            chunk = unpack.unconsumed_tail
            if unpack.eof:
                chunk = unpack.unused_data.lstrip(b"\0")
                unpack = zlib.decompressobj(31)


def split_warc(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The records of a WARC file given in chunks, plain or compressed; a cut-off last record is left out.

    Only the record at hand is held in memory. What lies between records is passed over.
    """
    held = bytearray()
    size = None  # of the record at the start of what is held, once its head is known
    for chunk in _inflated(chunks):
        held += chunk
        while True:
            if size is None:
                at = held.find(b"WARC/")
                del held[: at if at >= 0 else max(0, len(held) - 4)]
                head = held.find(b"\r\n\r\n")
                if at < 0 or head < 0:
                    break
                lengths = (x[15:] for x in bytes(held[:head]).split(b"\r\n") if x[:15].lower() == b"content-length:")
                size = head + 4 + next((int(x) for x in lengths if x.strip().isdigit()), 0)
            if len(held) < size:
                break
            yield bytes(held[:size])
            del held[:size]
            size = None


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(raw) of all records in the .warc and .warc.gz files below a path, which are read as streams."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.warc*").load(path).select("path")

    def chunks(uri: str) -> Iterator[bytes]:
        system, at = fs.FileSystem.from_uri(uri)
        with system.open_input_stream(at, compression=None) as f:
            while chunk := f.read(READ_BYTES):
                yield chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                held, size = [], 0
                for record in split_warc(chunks(uri)):
                    held.append(record)
                    size += len(record)
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["raw"])
                        held, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["raw"])

    return files.mapInArrow(run, "raw binary")


def _fields(lines: list[bytes]) -> list[tuple[str, str]]:
    """Named fields; a line that starts with white space continues the one before."""
    out: list[tuple[str, str]] = []
    for line in lines:
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {text.strip()}")
        elif (cut := text.find(":")) > 0:
            out.append((text[:cut].strip(), text[cut + 1 :].strip()))
    return out


def parse_record(raw: bytes) -> tuple | None:
    """The columns of RECORD; None if this isn't a WARC record with an id and a type."""
    head, found, block = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        return None
    headers = _fields(lines[1:])
    named = {name.lower(): value for name, value in reversed(headers)}
    record_id, kind = named.get("warc-record-id"), named.get("warc-type")
    if not record_id or not kind:
        return None
    size = named.get("content-length", "")
    body = block[: int(size)] if size.isdigit() else block
    start, http = None, []
    if named.get("content-type", "").startswith("application/http"):
        front, found, rest = body.partition(b"\r\n\r\n")
        first, *more = front.split(b"\r\n")
        start, http, body = first.decode("utf-8", "replace"), _fields(more), rest
    elif named.get("content-type", "").startswith("application/warc-fields"):
        http = _fields(body.split(b"\r\n"))
    to = [value for name, value in headers if name.lower() == "warc-concurrent-to" and value]
    return record_id, kind.lower(), named.get("warc-target-uri"), named.get("warc-date"), to, headers, start, http, body


def parse_warc(raw: DataFrame) -> DataFrame:
    """Rows of RECORD from rows (raw), and label if they have one. What isn't a record, or is null, is left out."""
    kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), _PAIRS_ARROW, pa.string(), _PAIRS_ARROW, pa.binary())
    labelled = "label" in raw.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_pylist() if labelled else [None] * batch.num_rows
            rows = [(*r, label) for x, label in zip(batch.column(0).to_pylist(), labels) if x and (r := parse_record(x))]
            columns = list(zip(*rows)) or [()] * (len(kinds) + 1)
            for at in (5, 7):
                columns[at] = [[{"name": a, "value": b} for a, b in x] for x in columns[at]]
            arrays = [pa.array(c, k) for c, k in zip(columns, (*kinds, *[pa.binary()] * labelled))]
            yield pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in RECORD.split(", ")] + ["label"] * labelled)

    return raw.select("raw", *["label"] * labelled).mapInArrow(run, RECORD + ", label binary" * labelled)


_FIELD = r"(?im)^{}:[ \t]*(\S+)[ \t]*\r?$"


def _head() -> Column:
    return F.substring_index(F.col("raw").cast("string"), _BREAK * 2, 1)


def _key(record_id: Column) -> Column:
    """A third of an id's length, so that the rounds over links move less."""
    return F.unhex(F.md5(record_id))


def _refers() -> Column:
    return _head().rlike(_FIELD.format("WARC-Concurrent-To"))


def _links(raw: DataFrame) -> DataFrame:
    """(u, v): which record refers to which, by key, from the headers alone; without Python."""
    ids = raw.where(F.startswith(F.col("raw"), F.lit(b"WARC/"))).select(
        F.regexp_extract(_head(), _FIELD.format("WARC-Record-ID"), 1).alias("u"), F.explode(F.regexp_extract_all(_head(), F.lit(_FIELD.format("WARC-Concurrent-To")), F.lit(1))).alias("v")
    )
    return ids.where("u <> '' AND v <> ''").select(_key(F.col("u")).alias("u"), _key(F.col("v")).alias("v"))


def record_labels(links: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """(id, label) of every record that refers to another; and of every other record that isn't a label itself, or None.

    A record goes to the least id that it names, and on to the least id that this one names: enough for a request and
    metadata of one response. Links whose ends are then apart join the labels by connected components.
    """
    links = scratch.write(links, "links")
    parent = links.groupBy("u").agg(F.min("v").alias("p"))
    above = parent.select(F.col("u").alias("p"), F.col("p").alias("g"))
    two = scratch.write(parent.join(above, "p", "left").select(F.col("u").alias("id"), F.coalesce("g", "p").alias("label")), "labels")
    ends = links.join(two.select(F.col("id").alias("u"), F.col("label").alias("lu")), "u").join(two.select(F.col("id").alias("v"), F.col("label").alias("lv")), "v", "left")
    apart = scratch.write(ends.select(F.col("lu").alias("u"), F.coalesce("lv", "v").alias("v")).where("u <> v"), "apart")
    scratch.drop("links")
    if apart.isEmpty():
        return two, None
    joined = connected_components(apart, scratch).select(F.col("id").alias("label"), F.col("label").alias("root"))
    moved = two.join(joined, "label", "left").select("id", F.coalesce("root", "label").alias("label"))
    return moved, joined.select(F.col("label").alias("id"), F.col("root").alias("label"))


def assemble(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """One nested row per capture: (capture_id, target_uri, date, page_id, response, request, metadata, others).

    capture_id is the least id of its responses, or of its records if it has none. response and request are the ones
    with the least id; metadata and others (further records) are sorted by id. page_id is that of the metadata, null if
    it isn't a number. A record that nothing refers to is a capture of its own; warcinfo records are left out. Of
    records that agree in every part, one counts. An id that no record has still ties those that refer to it. Null rows,
    empty ones and what isn't a record are left out; no record gives an empty table. All records of a capture meet in
    one row, so a capture must fit into one.
    """
    scratch = Scratch(spark, "warc")
    labels, roots = record_labels(_links(raw), scratch)
    # Records are labelled as they are, in one piece, and taken apart only on the way to their capture.
    keyed = raw.where("raw IS NOT NULL").select("raw", _key(F.regexp_extract(_head(), _FIELD.format("WARC-Record-ID"), 1)).alias("id"))
    referring = keyed.where(_refers()).join(labels, "id", "left").select("raw", F.coalesce("label", "id").alias("label"))
    alone = keyed.where(~_refers())
    if roots is None:
        alone = alone.select("raw", F.col("id").alias("label"))
    else:
        small = roots.limit(BROADCAST_LINKS + 1).count() <= BROADCAST_LINKS
        alone = alone.join(F.broadcast(roots) if small else roots, "id", "left").select("raw", F.coalesce("label", "id").alias("label"))
    records = parse_warc(alone.unionByName(referring)).where("type <> 'warcinfo'")
    whole = F.struct("record_id", "type", "target_uri", "date", "concurrent_to", "headers", "http_start", "http_headers", "body")
    grouped = records.groupBy("label").agg(F.array_sort(F.collect_list(whole)).alias("r"))

    def of(kind: str) -> Column:
        return F.filter("r", lambda x: x["type"] == kind)

    got = grouped.select(F.array_distinct("r").alias("r")).select("r", of("response").alias("p"), of("request").alias("q"), of("metadata").alias("m"))
    http = "struct(x.record_id as record_id, x.http_start as start_line, x.http_headers as headers, x.body as body)"
    fields = "transform(m, x -> struct(x.record_id as record_id, x.concurrent_to as concurrent_to, x.http_headers as fields))"
    page = "try_cast(try_element_at(transform(filter(flatten(transform(m, x -> x.http_headers)), f -> lower(f.name) = 'page_id'), f -> f.value), 1) as bigint)"
    main = "coalesce(try_element_at(p, 1), r[0])"
    return got.selectExpr(
        f"{main}.record_id as capture_id",
        f"{main}.target_uri as target_uri",
        f"{main}.date as date",
        f"{page} as page_id",
        f"try_element_at(transform(p, x -> {http}), 1) as response",
        f"try_element_at(transform(q, x -> {http}), 1) as request",
        f"{fields} as metadata",
        "concat(slice(p, 2, greatest(size(p) - 1, 0)), slice(q, 2, greatest(size(q) - 1, 0)), filter(r, x -> x.type not in ('response', 'request', 'metadata'))) as others",
    )


def captures(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Captures of the WARC records made of a table of pages: see pages_to_warc and assemble.

    Every row with a page_id gives one capture, repeated rows and texts of any length included; rows without one give
    none, and an empty table gives an empty one. A null url or html counts as empty; other columns aren't read.
    """
    return assemble(spark, pages_to_warc(pages))


def capture_fields(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The captures of pages with their parts side by side, for comparison with SQL."""
    status = F.split("response.start_line", " ")
    return captures(spark, pages).select(
        "page_id", F.col("target_uri").alias("url"), status[1].cast("int").alias("status"), F.col("response.body").cast("string").alias("html"),
        F.col("request.start_line").alias("request_line"), F.size("metadata").alias("n_metadata"), F.size("others").alias("n_others"),
    )


CAPTURE_FIELDS_SQL = r"""
    SELECT page_id, url, 200 AS status, html,
        'GET ' || coalesce(nullif(regexp_extract(url, '^[a-z]+://[^/?#]*([^#]*)', 1), ''), '/') || ' HTTP/1.1' AS request_line,
        1 AS n_metadata, 0 AS n_others
    FROM pages
"""
