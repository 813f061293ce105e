"""WARC 1.1 archives: write with an index, then read selected records through the index.

Writing: each task writes one archive into the shared folder (one gzip member for a record, so that every record can
be read alone) and returns an index row for each record: archive, offset, length, URL, payload digest. A task that is
run again writes another file; the index names only files of tasks that succeeded.

Reading is index first: select index rows, deal them out by archive and 8 MB stretch, sort by offset, coalesce byte
ranges that are close together into one read, and parse the records of each read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, lean, materialize, parallelism, shared_dir

STRETCH = 8 << 20
#: Ranges with at most this many unwanted bytes between them are read at once.
GAP = 64 << 10
#: A coalesced read holds no more than this, unless one record alone is larger.
READ = 4 << 20
DATE = "2024-01-01T00:00:00Z"
INDEX_SCHEMA = "page_id {id}, url string, record_type string, digest string, archive string, offset bigint, length bigint"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value: line breaks would end it."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(kind: str, url: str | None, payload: bytes, more: dict[str, str | None]) -> bytes:
    """One record as a gzip member."""
    body = b"" if kind == "revisit" else payload
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": DATE, "WARC-Target-URI": None if url is None else _clean(url), **more,
            "Content-Type": "text/html; charset=utf-8" if kind != "warcinfo" else "application/warc-fields", "Content-Length": str(len(body))}
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None) + "\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(text.encode() + body + b"\r\n\r\n") + pack.flush()


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, body) of one gzip member; a damaged record raises ValueError."""
    raw = zlib.decompress(data, 31)
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not sep or lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a WARC record's length is wrong")
    return fields, rest[:size]


#: Salts over which the rows of one payload are spread.
SALTS = 16


def revisit_plan(pages: DataFrame, *, salts: int = SALTS) -> DataFrame:
    """(_key, _salt, _refers) of payloads that several ids have; _refers is the largest of those ids. pages: _id, _key, _salt.

    Copies are combined by salt before they meet, and the plan has a row for each salt: no key holds a whole group.
    """
    salted = pages.groupBy("_key", "_salt").agg(F.max("_id").alias("_most"), F.min("_id").alias("_least"))
    groups = salted.groupBy("_key").agg(F.max("_most").alias("_refers"), F.min("_least").alias("_first")).filter("_refers > _first").select("_key", "_refers")
    return salted.filter("_most is not null or _least is null").select("_key", "_salt").join(groups, "_key")


def write_warc(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write archives into `folder` (a URI all executors see) and return the index, already written there as Parquet.

    A null payload is empty, a null URL is left out of the header (an empty one is not). Payloads are equal when their
    SHA-256 digests are. Of payloads of at least `min_bytes` that are equal,
    the record with the largest id is a response and the others are revisits without a body; smaller payloads are all
    responses. Rows that repeat an id and a payload have the same type. A null id is smaller than any other and is
    never referred to; if all ids of a group are null, all are responses. Columns other than the three are not read;
    an empty table gives an empty index.
    """
    arrow_rows(pages.sparkSession, 1000)
    spark = pages.sparkSession
    id_type = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").alias("_url"), F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).alias("_p"))
    # a payload below min_bytes is its own key, so that small ones do not meet
    small = F.concat(F.lit("-"), F.xxhash64("_id", "_url").cast("string"))
    keyed = rows.withColumns({"_key": F.coalesce(F.when(F.octet_length("_p") >= min_bytes, F.sha2("_p", 256)).otherwise(small), F.lit("")), "_salt": F.coalesce(F.pmod(F.xxhash64("_id", "_url"), F.lit(SALTS)).cast("int"), F.lit(0))})
    plan = revisit_plan(keyed.filter(F.octet_length("_p") >= min_bytes).select("_id", "_key", "_salt"))
    joined = keyed.join(plan, ["_key", "_salt"], "left").select("_id", "_url", F.col("_p").cast("binary"), F.when(F.col("_id").isNull() | (F.col("_id") < F.col("_refers")), F.col("_refers")).alias("_refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        name = f"{path}/{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        for batch in batches:
            index = [[] for _ in range(7)]
            for page, url, payload, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out = fs.open_output_stream(name, compression=None)
                    head = record_bytes("warcinfo", None, b"software: docloom\r\n", {})
                    out.write(head)
                    at += len(head)
                kind, digest = "response" if refers is None else "revisit", base32_sha1(payload)
                more = {"WARC-Payload-Digest": f"sha1:{digest}", "X-Payload-Length": str(len(payload)), "X-Page-Id": None if page is None else str(page)}
                if kind == "revisit":
                    more |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "X-Refers-To-Page-Id": str(refers)}
                data = record_bytes(kind, url, payload, more)
                out.write(data)
                for column, value in zip(index, (page, url, kind, digest, name.rpartition("/")[2], at, len(data))):
                    column.append(value)
                at += len(data)
            yield pa.RecordBatch.from_arrays([pa.array(index[0], batch.schema.field(0).type), *(pa.array(x, pa.string()) for x in index[1:5]), *(pa.array(x, pa.int64()) for x in index[5:])],
                                             names=["page_id", "url", "record_type", "digest", "archive", "offset", "length"])
        if out is not None:
            out.close()

    return materialize(joined.mapInArrow(lean(run), INDEX_SCHEMA.format(id=id_type)), "warc-index")


def read_warc(index: DataFrame, folder: str, *, with_payload: bool = True) -> DataFrame:
    """The records of the given index rows: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    Of a response the length and digest are computed from the payload read and must agree with its header; of a
    revisit they are those of its header. Filter the index first: only the byte ranges of its rows are read.
    `with_payload=False` leaves the payload null. An empty index gives an empty result.
    """
    id_type = index.schema["page_id"].dataType.simpleString()
    spark = index.sparkSession
    dealt = index.select("archive", "offset", "length").withColumn("_stretch", F.expr(f"offset div {STRETCH}")).repartition(parallelism(spark), "archive", "_stretch").sortWithinPartitions("archive", "offset")
    number = id_type in ("bigint", "int", "smallint", "tinyint")
    out_type = pa.int64() if number else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        file, name = None, None
        for batch in batches:
            out = [[] for _ in range(7)]
            rows = list(zip(*(c.to_pylist() for c in batch.columns[:3])))
            at = 0
            while at < len(rows):
                archive, begin, size = rows[at]
                to, end = at + 1, begin + size
                while to < len(rows) and rows[to][0] == archive and rows[to][1] - end <= GAP and rows[to][1] + rows[to][2] - begin <= READ:
                    end = max(end, rows[to][1] + rows[to][2])
                    to += 1
                if archive != name:
                    if file is not None:
                        file.close()
                    file, name = fs.open_input_file(f"{path}/{archive}"), archive
                file.seek(begin)
                data = file.read(end - begin)
                for _, offset, length in rows[at:to]:
                    fields, body = parse_record(data[offset - begin:offset - begin + length])
                    digest, n, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"]), fields["WARC-Type"]
                    if kind == "response" and (base32_sha1(body) != digest or len(body) != n):
                        raise ValueError(f"record at {offset} of {archive} is damaged")
                    ids = [x if x is None or not number else int(x) for x in (fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id"))]
                    for column, value in zip(out, (ids[0], fields.get("WARC-Target-URI"), n, digest, kind, ids[1], body if with_payload and kind == "response" else None)):
                        column.append(value)
                at = to
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (out_type, pa.string(), pa.int64(), pa.string(), pa.string(), out_type, pa.binary()))],
                                             names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
        if file is not None:
            file.close()

    kind = "bigint" if number else "string"
    return dealt.mapInArrow(lean(run), f"page_id {kind}, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to {kind}, payload binary").withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def warc_round_trip(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """Write all pages, read all records back through the index, and return what was read."""
    folder = shared_dir(pages.sparkSession, "warc")
    index = write_warc(pages, folder, min_bytes=min_bytes)
    return read_warc(index, folder, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
