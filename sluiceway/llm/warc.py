"""WARC archives: a writer of gzip members with revisit records, and a reader that splits files by bytes."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.arrow import saved
from sluiceway.llm.files import Output, opened
from sluiceway.session import fresh_dir

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a file that one task searches for record starts.
SPLIT = 16 << 20
READ = 1 << 16
#: The revisit profile of the WARC 1.1 standard, and the name space of the record ids.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
DATE = "2024-01-01T00:00:00Z"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, file string, at long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {url.encode('unicode_escape').decode()}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
        if refers_to is not None:
            head.append(f"X-Refers-To-Page: {refers_to}")
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record; a payload that does not agree with its digest is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    length = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (digest(payload) != said or len(payload) != length):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload is damaged")
    number = lambda name: int(fields[name]) if name in fields else None
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": number("X-Page-Id"), "url": None if url is None else url.encode().decode("unicode_escape"), "record_type": fields["WARC-Type"],
        "refers_to": number("X-Refers-To-Page"), "payload_bytes": length, "payload_digest": said, "payload": None if revisit else payload,
    }


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name = None, f"part-{TaskContext.get().partitionId():06d}.warc.gz"
        for batch in batches:
            for row in batch.to_pylist():
                out = out or Output(folder, name)
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                out.write(pack.compress(record(row["page_id"], row["url"], row["payload"], row["refers_to"], row["revisit"])) + pack.flush())
        if out:
            out.close()
            yield pa.RecordBatch.from_pylist([{"file": name, "bytes": out.size}], pa.schema([("file", pa.string()), ("bytes", pa.int64())]))

    return run


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", revisit_from: int = 0) -> DataFrame:
    """Writes a record per row, one file per partition, and returns the manifest ``(file, bytes)``.

    Of rows with equal payloads of at least ``revisit_from`` bytes the one with the largest id is the response and the
    others are revisits. Only the ids of equal payloads are compared, after partial aggregation, so that very many
    copies are no single group. Null html is an empty payload. A null id ranks below all; among equal ids at the top
    every row is a response. A null url leaves its header out. An empty table writes no file.
    """
    payload = F.coalesce(F.encode(F.col(html_col), "utf-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.when(F.length("payload") >= revisit_from, F.unhex(F.sha1("payload"))))
    tops = rows.where("sha is not null").groupBy("sha").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1").drop("n")
    marked = rows.join(tops, "sha", "left")
    revisit = F.coalesce(F.col("top").isNotNull() & ~F.col("top").eqNullSafe(F.col("page_id")), F.lit(False))
    out = marked.select("page_id", "url", "payload", F.when(revisit, F.col("top")).alias("refers_to"), revisit.alias("revisit"))
    # A file's order is fixed, so a task that runs again writes the same bytes.
    out = out.sortWithinPartitions("page_id", "url")
    return saved(out.mapInArrow(_write(folder), "file string, bytes long"), "manifest")


class _Window:
    """A file read forwards, from which whole gzip members are taken."""

    def __init__(self, source, start: int, size: int):
        self.source, self.size = source, size
        self.data, self.base = b"", start

    def more(self) -> bool:
        at = self.base + len(self.data)
        if at >= self.size:
            return False
        self.source.seek(at)
        got = self.source.read(min(max(READ, len(self.data)), self.size - at))  # doubles, for a long member
        self.data += got
        return bool(got)

    def find(self, stop: int) -> int | None:
        """The next position below ``stop`` that has gzip's magic; what lies before is let go."""
        while True:
            i = self.data.find(MAGIC)
            if i >= 0:
                self.drop(i)
                return self.base if self.base < stop else None
            self.drop(max(0, len(self.data) - len(MAGIC) + 1))
            if self.base >= stop or not self.more():
                return None

    def drop(self, n: int) -> None:
        self.data, self.base = self.data[n:], self.base + n

    def member(self) -> tuple[bytes, int] | None:
        """The gzip member that begins here and holds a record, and its length; None if it is none."""
        unpack, out, fed = zlib.decompressobj(31), [], 0
        begun = b""
        try:
            while not unpack.eof:
                if fed == len(self.data) and not self.more():
                    return None
                out.append(unpack.decompress(self.data[fed:]))
                fed = len(self.data)
                begun = begun if len(begun) >= 5 else b"".join(out)[:5]
                if len(begun) >= 5 and begun != b"WARC/":
                    return None
        except zlib.error:
            return None
        whole = b"".join(out)
        return (whole, fed - len(unpack.unused_data)) if whole.startswith(b"WARC/") else None


def records(source, start: int, stop: int, size: int) -> Iterator[tuple[int, bytes]]:
    """Records that begin in ``[start, stop)``: magic bytes are candidates, a member that decodes to a record is one.

    After a record the next begins where it ends, so bytes inside members are searched only before the first.
    """
    window = _Window(source, start, size)
    while (at := window.find(stop)) is not None:
        if got := window.member():
            yield at, got[0]
            window.drop(got[1])
        else:
            window.drop(1)


def _read(folder: str, payloads: bool):
    fields = [x.split(" ") for x in RECORD.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[k]) for n, k in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = opened(folder)
        for batch in batches:
            for part in batch.to_pylist():
                rows, held = [], 0
                with fs.open_input_file(f"{base}/{part['file']}") as source:
                    for at, data in records(source, part["start"], min(part["start"] + part["split"], part["bytes"]), part["bytes"]):
                        row = parse(data) | {"file": part["file"], "at": at}
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"") + 200
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read(spark: SparkSession, folder: str, manifest: DataFrame, split: int = SPLIT, payloads: bool = True) -> DataFrame:
    """The records of the manifest's files, a task for every ``split`` bytes; responses are checked by their digest."""
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split).cast("long")))
    parts = manifest.where("bytes > 0").select("file", "bytes", at.alias("start"), F.lit(split).alias("split"))
    # A number given is kept; by the size of these few small rows all of them would become one task.
    return parts.repartition(max(1, parts.count())).mapInArrow(_read(folder, payloads), RECORD)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of all pages, from archives written and read."""
    spark = pages.sparkSession
    folder = fresh_dir(spark, "warc")
    found = read(spark, folder, write(pages, folder, id_col, url_col, html_col), payloads=False)
    return found.select(F.col("page_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
