"""WARC records in seekable Zstandard bundles.

A bundle is one file: frames that can be read by themselves, each of some records, and at
the end a seek table in a skippable frame, as the public seekable format has it. Records are
found by the table that maps their ids to bundle, frame and offset within the frame. Bundles
are written by the tasks, whole and under their final name only when complete, into a folder
that all executors share; they are read by Spark.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import partitions
from termloom.operators.staging import stage

#: Bytes of records in a frame, and of frames in a bundle, about.
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 32 << 20
#: Copies of one row that are written from one row of the plan, at most.
COPIES = 10_000
LEVEL = 3

# Fixed values of the formats.
SEEK_MAGIC, SEEK_TABLE_MAGIC = 0x8F92EAB1, 0x184D2A5E
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"

INDEX_SCHEMA = "record_id string, page_id long, bundle string, frame int, offset long, length long"
PARSED_SCHEMA = "record_id string, page_id long, record_type string, payload_digest string, refers_to_id string, url string, payload binary"


def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, payload_digest: str, url: str | None, copy: int) -> str:
    """Rows that are equal in all but their number among equal ones have different ids too."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{payload_digest}:{copy}:{url!r}')}"


def record(fields: dict[str, str], block: bytes) -> bytes:
    """One WARC record. Line breaks in values become blanks, so no value can end its header."""
    lines = [f"{k}: {' '.join(v.splitlines())}".encode() for k, v in fields.items()]
    return b"\r\n".join([VERSION, *lines, b"Content-Length: %d" % len(block), b"", block]) + b"\r\n\r\n"


def page_record(page_id, url, payload: bytes, payload_digest: str, own_id: str, refers_to_id: str | None) -> bytes:
    """A response with the payload, or a revisit of the record that has it."""
    fields = {"WARC-Type": "revisit" if refers_to_id else "response", "WARC-Record-ID": f"<{own_id}>", "WARC-Date": DATE}
    if page_id is not None:
        fields["Page-ID"] = str(page_id)
    if url is not None:
        fields["WARC-Target-URI"] = url
    fields["WARC-Payload-Digest"] = f"sha1:{payload_digest}"
    if refers_to_id:
        fields |= {"WARC-Refers-To": f"<{refers_to_id}>", "WARC-Profile": PROFILE}
    fields["Content-Type"] = "application/http; msgtype=response"
    return record(fields, HTTP_HEAD + (b"" if refers_to_id else payload))


def parse(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, fields, block) of the records in a frame."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].split(b"\r\n")
        fields = {k.decode().lower(): v.decode() for k, _, v in (line.partition(b": ") for line in lines[1:])}
        start = head_end + 4
        end = start + int(fields["content-length"])
        yield at, end + 4 - at, fields, data[start:end]
        at = end + 4


class Bundle:
    """A bundle being written: closed frames, the open one, and what the seek table needs."""

    def __init__(self) -> None:
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open = bytearray()
        self.total = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame and offset of a record that is added."""
        if len(self.open) >= FRAME_BYTES:
            self.close_frame()
        place = len(self.frames), len(self.open)
        self.open += data
        return place

    def close_frame(self) -> None:
        if self.open:
            frame = zstandard.ZstdCompressor(level=LEVEL).compress(bytes(self.open))
            self.sizes.append((len(frame), len(self.open)))
            self.frames.append(frame)
            self.total += len(frame)
            self.open = bytearray()

    def content(self) -> bytes:
        self.close_frame()
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEK_MAGIC)
        head = struct.pack("<II", SEEK_TABLE_MAGIC, len(entries) + len(footer))
        return b"".join(self.frames) + head + entries + footer


def seek_table(tail: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, size) of every frame, from the end of a bundle."""
    count, flags, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    width = 12 if flags & 0x80 else 8
    entries, frames, start = tail[-9 - count * width : -9], [], 0
    for i in range(count):
        packed, size = struct.unpack_from("<II", entries, i * width)
        frames.append((start, packed, size))
        start += packed
    return frames


def _file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """Where a folder is: any store that Arrow knows, or a path that all executors mount."""
    return fs.FileSystem.from_uri(folder) if urlsplit(folder).scheme else (fs.LocalFileSystem(), folder)


def _write_file(folder: str, name: str, data: bytes) -> None:
    """Write under a name of this attempt and move it, so a lost or doubled task leaves no half file."""
    store, base = _file_system(folder)
    store.create_dir(base, recursive=True)
    part = f"{base}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, f"{base}/{name}")


def planned_records(pages: DataFrame, least_bytes: int, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(page_id, url, sha1, payload, first_page, first_url, low, high): the records to write, a row for the copies `low` to `high` - 1.

    Rows that are equal in id, url and payload are counted on digests and numbered from there,
    so no row's record depends on which task it comes to. Equal payloads are told by SHA-1 and
    size, as the record format does. Revisits are made of digests; a payload moves once for
    each distinct row, so one that a third of all rows have is spread, and is written once.
    """
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "utf-8")
    marked = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumns(
        {"sha1": F.unhex(F.sha1("payload")), "bytes": F.octet_length("payload").cast("long")})
    told = F.sha1(F.to_json(F.struct("page_id", "url", F.hex("sha1").alias("sha1"), "bytes")))
    marked = marked.withColumn("row", told)
    rows = stage(marked.groupBy("row", "sha1", "bytes", "page_id", "url").agg(F.count("*").alias("copies")), "digests")
    smallest = F.min(F.struct(F.isnull("page_id").alias("n"), "page_id", F.isnull("url").alias("u"), "url", "row"))
    groups = rows.groupBy("sha1", "bytes").agg(smallest.alias("first"), F.sum("copies").alias("of"))
    several = groups.filter((F.col("of") > 1) & (F.col("bytes") >= least_bytes)).select(
        "sha1", "bytes", F.col("first.row").alias("first_row"), F.col("first.page_id").alias("first_page"), F.col("first.url").alias("first_url"))
    known = stage(rows.join(several, ["sha1", "bytes"], "left"), "originals")
    shared, is_first = F.col("first_row").isNotNull(), F.col("row") == F.col("first_row")
    whole = known.filter(~shared | is_first).select("row", F.when(shared, 1).otherwise(F.col("copies")).alias("high"))
    # each row once, by its key, and met by that key: whatever a join splits, a row's copies are numbered already
    responses = marked.drop("bytes").dropDuplicates(["row"]).join(whole.hint("merge"), "row").select(
        "page_id", "url", "sha1", "payload", F.lit(None).cast("long").alias("first_page"), F.lit(None).cast("string").alias("first_url"),
        F.lit(0).cast("long").alias("low"), "high")
    start = F.when(is_first, 1).otherwise(0).cast("long")
    steps = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES))
    revisits = known.filter(shared & (F.col("copies") > start)).withColumn("step", F.explode(steps)).repartition(partitions(pages.sparkSession)).select(
        "page_id", "url", "sha1", F.lit(None).cast("binary").alias("payload"), "first_page", "first_url",
        F.greatest(start, F.col("step") * COPIES).alias("low"), F.least("copies", (F.col("step") + 1) * COPIES).alias("high"))
    return responses.union(revisits.withColumn("high", F.col("high").cast("long")))


def write_bundles(pages: DataFrame, folder: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html") -> DataFrame:
    """Write a record per row of `pages` to `folder`/bundles; returns the index, stored in `folder`/index.

    Of equal payloads of at least `least_bytes` bytes the row with the smallest id is a
    response with the payload, the others are revisits of it. Defined cases: a null payload
    is empty; a null url or id leaves its field out of the record, and of rows without an id
    the response is one that has one, if any; rows with the same id and payload are records
    of their own, with their own ids, one of them the response (that with the smallest url); an empty table gives no bundle and an empty
    index; further columns are ignored.
    """

    def bundles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number, bundle, index = TaskContext.get().partitionId(), 0, Bundle(), []

        def finish() -> pd.DataFrame:
            name = f"bundle-{task:06d}-{number:05d}.warc.zst"
            _write_file(f"{folder}/bundles", name, bundle.content())
            rows = pd.DataFrame(index, columns=["record_id", "page_id", "frame", "offset", "length"])
            return rows.assign(page_id=rows["page_id"].astype("Int64"), bundle=name)[["record_id", "page_id", "bundle", "frame", "offset", "length"]]

        for batch in batches:
            for page, url, sha1, payload, first_page, first_url, low, high in zip(*(batch[c].array for c in batch.columns)):
                page, first_page = (None if pd.isna(i) else int(i) for i in (page, first_page))
                url, first_url = (None if pd.isna(u) else u for u in (url, first_url))
                name = base64.b32encode(sha1).decode()
                refers = record_id(first_page, name, first_url, 0) if payload is None else None
                for copy in range(low, high):
                    own = record_id(page, name, url, copy)
                    data = page_record(page, url, b"" if payload is None else bytes(payload), name, own, refers)
                    index.append((own, page, *bundle.add(data), len(data)))
                    if bundle.total >= BUNDLE_BYTES:
                        yield finish()
                        number, bundle, index = number + 1, Bundle(), []
        if index:
            yield finish()

    rows = planned_records(pages, least_bytes, id_col, url_col, payload_col)
    rows.mapInPandas(bundles, INDEX_SCHEMA).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")


def _parsed(fields: dict[str, str], block: bytes) -> tuple:
    payload = block.partition(b"\r\n\r\n")[2]
    page, refers = fields.get("page-id"), fields.get("warc-refers-to")
    return (
        fields["warc-record-id"].strip("<>"), None if page is None else int(page), fields["warc-type"],
        fields["warc-payload-digest"].removeprefix("sha1:"), refers and refers.strip("<>"), fields.get("warc-target-uri"), payload,
    )


def _frame_of(rows: list[tuple]) -> pd.DataFrame:
    found = pd.DataFrame(rows, columns=["record_id", "page_id", "record_type", "payload_digest", "refers_to_id", "url", "payload"])
    return found.assign(page_id=found["page_id"].astype("Int64"))


def read_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the bundles (see `PARSED_SCHEMA`), frame by frame."""

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                for start, packed, size in seek_table(content):
                    data = zstandard.ZstdDecompressor().decompress(content[start : start + packed], max_output_size=size)
                    yield _frame_of([_parsed(fields, block) for _, _, fields, block in parse(data)])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(f"{folder}/bundles")
    return files.select("content").mapInPandas(records, PARSED_SCHEMA)


def lookup(wanted: DataFrame, folder: str) -> DataFrame:
    """The records with the ids of `wanted(record_id)`, by reading only the frames they lie in.

    Each frame is read once, by offset, whatever the bundle's size. Ids that no record has,
    and nulls, give no row; an id that is asked for twice gives one.
    """
    spark = wanted.sparkSession
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")

    def fetch(places: pd.DataFrame) -> pd.DataFrame:
        store, base = _file_system(f"{folder}/bundles")
        with store.open_input_file(f"{base}/{places['bundle'].iloc[0]}") as file:
            size = file.size()
            count = struct.unpack("<I", file.read_at(9, size - 9)[:4])[0]
            tail = min(size, 9 + 12 * count)
            start, packed, plain = seek_table(file.read_at(tail, size - tail))[int(places["frame"].iloc[0])]
            data = zstandard.ZstdDecompressor().decompress(file.read_at(packed, start), max_output_size=plain)
        rows = []
        for offset, length in zip(places["offset"], places["length"]):
            for _, _, fields, block in parse(data[offset : offset + length]):
                rows.append(_parsed(fields, block))
        return _frame_of(rows)

    found = index.join(wanted.select("record_id").distinct(), "record_id")
    return found.groupBy("bundle", "frame").applyInPandas(fetch, PARSED_SCHEMA)


def page_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) per record, as read back.

    A response's digest is that of the payload as it was read; a revisit has its own header's
    digest and the size of the response it refers to.
    """
    read = read_bundles(spark, folder)
    own = F.when(F.col("record_type") == "response", F.octet_length("payload").cast("long"))

    @F.pandas_udf("string")
    def sha1(payloads: pd.Series) -> pd.Series:
        return payloads.map(digest)

    records = stage(read.select(
        "record_id", "page_id", "record_type", "refers_to_id", "url", own.alias("own_bytes"),
        F.when(F.col("record_type") == "response", sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
    ), "records")
    responses = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("own_bytes").alias("first_bytes"))
    return records.join(responses, "refers_to_id", "left").select(
        "page_id", F.coalesce("own_bytes", "first_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "url")
