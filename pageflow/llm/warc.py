"""Web archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with the WARC records of about a megabyte, and a skippable frame
at its end that lists the sizes of all frames. The map of records (record, bundle, frame, offset in the frame) is a table.
Any record is read by one seek, one frame and its offset. Payloads that occur again are written once; their other records
are revisits.
"""

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from pageflow.llm.common import opened, prepared, saved, share_of, table
from pageflow.session import scratch_dir

# Fixed values of the Zstandard seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
# Bytes of records in a frame, and of frames in a bundle, at least.
FRAME, BUNDLE = 1 << 20, 256 << 20
LEVEL = 3
# Frames a task reads, about, and those it reads one after another from a bundle.
READ, RUN = 64, 8


class BundleWriter:
    """Frames one after another, and the table of their sizes at the end."""

    def __init__(self, out):
        self.out, self.sizes, self.records, self.written = out, [], bytearray(), 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, record: bytes) -> tuple[int, int]:
        """The frame the record is in, and its offset there."""
        place = len(self.sizes), len(self.records)
        self.records += record
        if len(self.records) >= FRAME:
            self.flush()
        return place

    def flush(self) -> None:
        if self.records:
            packed = self.packer.compress(bytes(self.records))
            self.out.write(packed)
            self.sizes.append((len(packed), len(self.records)))
            self.written += len(packed)
            self.records = bytearray()

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()


class BundleReader:
    """Frames of a bundle by their number, found through the seek table."""

    def __init__(self, source):
        self.source, size = source, source.size()
        source.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE:
            raise ValueError("not a seekable Zstandard file")
        width = 12 if flags & 0x80 else 8
        source.seek(size - 9 - count * width)
        entries = source.read(count * width)
        self.sizes = [struct.unpack_from("<II", entries, k * width) for k in range(count)]
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)
        self.unpacker = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        packed, size = self.sizes[number]
        self.source.seek(self.starts[number])
        return self.unpacker.decompress(self.source.read(packed), max_output_size=size)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def uri_of(url: str | None) -> str:
    """A target URI that fits on a header line."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url or "")


def record(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    """A response with its payload, or a revisit that refers to the page whose payload is the same."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
             f"WARC-Date: {date}", f"WARC-Target-URI: {uri_of(url)}", f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes, offset: int) -> tuple[dict[str, str], bytes]:
    """Headers and block of the record at an offset."""
    end = data.index(b"\r\n\r\n", offset)
    first, *lines = data[offset:end].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no record at {offset}")
    headers = dict(line.split(": ", 1) for line in lines)
    return headers, data[end + 4:end + 4 + int(headers["Content-Length"])]


def number(name: str | None) -> int | None:
    """The page in a record's name."""
    digits = name[len("<urn:page:"):-1] if name else "None"
    return None if digits == "None" else int(digits)


def with_first(pages: DataFrame, least: int = 0) -> DataFrame:
    """The pages with `refers_to`: the smallest page_id with the same payload, null for that page itself.

    Payloads under `least` bytes refer to none. Minima are combined before their shuffle, and the join back is one that
    adaptive execution can split where a payload is very frequent.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("html"), F.sha1(payload.cast("binary")).alias("digest"))
    first = rows.where(F.octet_length("html") >= least).groupBy("digest").agg(F.min("page_id").alias("first"))
    joined = rows.join(first, "digest", "left")
    return joined.select("page_id", "url", "html", F.when(F.col("first") != F.coalesce(
        "page_id", F.col("first") - 1), F.col("first")).alias("refers_to"))


def archive(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", least: int = 0) -> DataFrame:
    """Writes all pages as bundles into a folder all executors share; the map of the records: page_id, bundle, frame, at.

    Every attempt of a task writes files of its own name, and only those of the attempt that counted are in the map: what
    a lost executor leaves behind is never read. A null html has an empty payload, a null url an empty target. Pages with a null
    page_id are records without a number: revisits of a numbered page if one has their payload, else responses. Rows with one page_id
    and the same payload are all responses, or all revisits of the same page. Empty pages write no file and give an empty map.
    """
    def run(batches):
        def closed():
            bundle.close()
            columns = list(zip(*places)) or [()] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array([name] * len(places), pa.string()),
                 pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64())], ["page_id", "bundle", "frame", "at"])

        files, path = opened(folder)
        bundle, name, places = None, None, []
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle is None:
                    files.create_dir(path, recursive=True)
                    name, places = f"{uuid.uuid4().hex}.warc.zst", []
                    bundle = BundleWriter(files.open_output_stream(f"{path}/{name}", compression=None))
                places.append((page_id, *bundle.add(record(page_id, url, html.encode("utf-8", "replace"), refers_to, date))))
                if bundle.written >= BUNDLE:
                    yield closed()
                    bundle = None
        if bundle is not None:
            yield closed()

    return saved(with_first(pages, least).mapInArrow(run, "page_id bigint, bundle string, frame int, at bigint"), "warc-map")


def read_back(places: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of the mapped records, read from the bundles.

    The records of a frame are read together: one seek, one decompression. A task has some `READ` frames whatever their number of
    records; a long record makes its frame longer. An empty map gives no rows, a map with repeated rows repeats them.
    """
    def run(batches):
        files, path = opened(folder)
        name = reader = frame = data = None
        for batch in batches:
            rows = []
            for bundle, number_, at in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle != name:
                    name, frame = bundle, None
                    reader = BundleReader(files.open_input_file(f"{path}/{bundle}"))
                if number_ != frame:
                    frame, data = number_, reader.frame(number_)
                headers, block = parsed(data, at)
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(http.rpartition(b"Content-Length: ")[2])
                revisit = headers["WARC-Type"] == "revisit"
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                if not revisit and (len(payload) != size or digest_of(payload) != digest):
                    raise ValueError(f"record at {at} of frame {number_} of {bundle} is damaged")
                rows.append((number(headers["WARC-Record-ID"]), size, digest, headers["WARC-Type"], number(headers.get("WARC-Refers-To"))))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    # The number of tasks follows the frames: what is shuffled is only the map, which says nothing of the bytes to read.
    frames = places.groupBy("bundle").agg((F.max("frame") + 1).alias("frames"))
    tasks = share_of(frames, F.col("frames"), READ, places.sparkSession.sparkContext.defaultParallelism)
    dealt = places.select("bundle", "frame", "at").repartition(tasks, "bundle", F.expr(f"frame div {RUN}"))
    return dealt.sortWithinPartitions("bundle", "frame", "at").mapInArrow(
        run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def op4_warc(spark, sf_dir: str) -> DataFrame:
    pages = table(prepared(spark), sf_dir, "pages")
    folder = scratch_dir(spark, "warc")
    return read_back(archive(pages, folder), folder)


# Payloads, their digests in base32, and the first page with each, counted by an engine of its own.
OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT hex, min(page_id) AS first FROM p GROUP BY hex),
b AS (SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ('0b' || v)::INT, 1), '' ORDER BY i) AS b32 FROM (
  SELECT hex, i, substr(bits, 5 * i + 1, 5) AS v FROM (
    SELECT hex, unnest(range(32)) AS i, list_aggregate(list_transform(range(1, 41),
      lambda k: substr('0000000100100011010001010110011110001001101010111100110111101111',
                  4 * (strpos('0123456789abcdef', substr(hex, k, 1)) - 1) + 1, 4)), 'string_agg', '') AS bits
    FROM (SELECT DISTINCT hex FROM p))) GROUP BY hex)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, b32 AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (hex) JOIN b USING (hex)
"""
