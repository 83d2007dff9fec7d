"""WARC records in ZIP packages: writer, and a reader that range-reads records without extraction.

A package is a ZIP file with two stored (uncompressed) members: ``archive/data.warc.gz``,
one gzip member per record, and ``indexes/index.jsonl``, one line per record with its
offset and length inside the archive member. A reader needs three kinds of range reads:
the tail of the file (end record, ZIP64 locator and record, central directory), the index
member, and runs of neighbouring records at ``member start + offset``. Nothing is unpacked
to disk, and no file is read whole.

Writer and readers are Spark tasks over splits. Packages are written to the shared folder
under names made of a random token, one set for each task attempt; the table of packages
is stored before anything reads it, so a repeated attempt only leaves an unread file.

Equal payloads (by SHA-1 and length) of at least ``min_bytes`` are stored once: the row with
the largest id is a ``response``, the others are ``revisit`` records without payload that name
it. Defined results: null payload is empty; smaller payloads and rows without id are always
responses; rows that repeat id and payload of a response are responses too; an empty table
gives no packages and no records; a null url writes no target; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.common import materialize, pick, scratch_path, ship, slices

MEMBER, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
DATE = "2000-01-01T00:00:00Z"  # fixed, so that equal inputs give equal records
PACKAGE_BYTES = 64 << 20  # a new package starts beyond this
RUN_BYTES = 4 << 20  # neighbouring records read at once

# ---- records -------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has no block."""
    kind = "response" if refers_to is None else "revisit"
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    block = payload if refers_to is None else b""
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", " ".join(url.split())))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("X-Payload-Length", str(len(payload)))]
    head += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    n = int(headers["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    return headers, rest[:n]


def _page(urn: str | None) -> int | None:
    """The id inside <urn:page:ID>."""
    return int(urn[10:-1]) if urn and urn[10:-1] else None


# ---- ZIP: writer ---------------------------------------------------------------------


class PackageWriter:
    """Streams records into one ZIP package on any file system pyarrow can open."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        import zipfile
        self.path, self.index, self.at = path, [], 0
        self.raw = fs.open_output_stream(path)
        self.zip = zipfile.ZipFile(_Forward(self.raw), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(MEMBER, (1980, 1, 1, 0, 0, 0)), "w", force_zip64=True)

    def add(self, page_id: int | None, raw: bytes) -> None:
        squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
        data = squeeze.compress(raw) + squeeze.flush()
        self.member.write(data)
        self.index.append((page_id, self.at, len(data)))
        self.at += len(data)

    def close(self) -> None:
        import zipfile
        self.member.close()
        with self.zip.open(zipfile.ZipInfo(INDEX, (1980, 1, 1, 0, 0, 0)), "w", force_zip64=True) as out:
            for i, at, n in self.index:
                out.write(json.dumps({"id": i, "offset": at, "length": n}).encode() + b"\n")
        self.zip.close()
        self.raw.close()


class _Forward:
    """A write-only view; zipfile then writes sizes behind each member instead of seeking back."""

    def __init__(self, out):
        self.out = out

    def write(self, data) -> int:
        self.out.write(bytes(data))
        return len(data)

    def flush(self) -> None:
        pass


# ---- ZIP: reader ---------------------------------------------------------------------


class RangeFile:
    """Range reads of one file."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        self.size = self.file.size()

    def read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        data = self.file.read(n)
        if len(data) != n:
            raise ValueError("the file ends too early")
        return data

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def central_directory(f: RangeFile) -> dict[str, tuple[int, int]]:
    """Name -> (first byte, length) of the stored members, from the central directory (ZIP64 included)."""
    tail_at = max(0, f.size - 22 - 65535)
    tail = f.read(tail_at, f.size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, dir_size, dir_at = struct.unpack_from("<HII", tail, end + 10)
    end_at = tail_at + end
    if 0xFFFF == count or 0xFFFFFFFF in (dir_size, dir_at):
        sign, _, where, _ = struct.unpack("<IIQI", f.read(end_at - 20, 20))
        if sign != 0x07064B50:
            raise ValueError("no ZIP64 locator")
        record64 = f.read(where, 56)
        if record64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        count, dir_size, dir_at = struct.unpack_from("<QQQ", record64, 32)
    data, at, out = f.read(dir_at, dir_size), 0, {}
    for _ in range(count):
        if data[at:at + 4] != b"PK\x01\x02":
            raise ValueError("a damaged central directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        packed, size, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", data, at + 20)
        (local,) = struct.unpack_from("<I", data, at + 42)
        name = data[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = data[at + 46 + n_name:at + 46 + n_name + n_extra]
        packed, size, local = _wide(extra, packed, size, local)
        if method == 0 and packed == size:  # stored
            n_name2, n_extra2 = struct.unpack("<HH", f.read(local + 26, 4))
            out[name] = (local + 30 + n_name2 + n_extra2, size)
        at += 46 + n_name + n_extra + n_note
    return out


def _wide(extra: bytes, packed: int, size: int, local: int) -> tuple[int, int, int]:
    """Put in the 64-bit values of the ZIP64 extra field: size, packed size and offset, those that are 0xFFFFFFFF."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            size = next(values) if size == 0xFFFFFFFF else size
            packed = next(values) if packed == 0xFFFFFFFF else packed
            local = next(values) if local == 0xFFFFFFFF else local
        at += 4 + n
    return packed, size, local


def index_runs(uri: str, run_bytes: int = RUN_BYTES):
    """(member start + offset, [lengths]) of neighbouring records, from the package's index."""
    with RangeFile(uri) as f:
        members = central_directory(f)
        start, _ = members[MEMBER]
        at, size = members[INDEX]
        runs, first, lengths, rest, end = [], None, [], b"", at + size
        while at < end or rest:
            step = f.read(at, min(1 << 20, end - at))
            at += len(step)
            lines = (rest + step).split(b"\n")
            rest = lines.pop() if at < end else b""
            for line in filter(None, lines):
                x = json.loads(line)
                if lengths and (x["offset"] != first + sum(lengths) or sum(lengths) + x["length"] > run_bytes):
                    runs.append((start + first, lengths))
                    lengths = []
                if not lengths:
                    first = x["offset"]
                lengths.append(x["length"])
        if lengths:
            runs.append((start + first, lengths))
    return runs


def read_run(uri: str, at: int, lengths: list[int]):
    """Records of one run: one range read, each gzip member unpacked by itself."""
    with RangeFile(uri) as f:
        data = f.read(at, sum(lengths))
    pos = 0
    for n in lengths:
        yield parse_record(zlib.decompress(data[pos:pos + n], 31))
        pos += n


# ---- Spark ---------------------------------------------------------------------------


def plan_records(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """(id, url, html) -> the same with sha1 and refers_to (null: response)."""
    sha = F.sha1(F.coalesce("html", F.lit("")).cast("binary"))
    keyed = pages.select("id", sha.alias("sha1"), F.octet_length(F.coalesce("html", F.lit(""))).alias("n"))
    groups = keyed.where((F.col("n") >= min_bytes) & F.col("id").isNotNull()).groupBy("sha1", "n").agg(F.max("id").alias("keep"), F.count("*").alias("copies"))
    refs = (keyed.join(groups.where("copies > 1"), ["sha1", "n"]).where("id <> keep")
            .select("id", "sha1", F.col("keep").alias("refers_to")).distinct())
    full = pages.select("id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("html"), sha.alias("sha1"))
    return full.join(refs, ["id", "sha1"], "left").select("id", "url", "html", "sha1", "refers_to")


def write_packages(planned: DataFrame, folder: str) -> DataFrame:
    """Write packages below folder; one row per package: uri, n_records. The table is stored before it is returned."""
    ship(planned.sparkSession)

    def run(batches):
        fs, root = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        fs.create_dir(root, recursive=True)
        scheme = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
        token, writer, no = uuid.uuid4().hex, None, 0

        def done():
            writer.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{scheme.rstrip('/')}/{name}"]), pa.array([len(writer.index)], pa.int64())], names=["uri", "n_records"])

        for batch in slices(batches):
            for i, url, html, sha1, ref in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if writer is None:
                    name, no = f"{token}-{no}.wacz", no + 1
                    writer = PackageWriter(fs, f"{root.rstrip('/')}/{name}")
                writer.add(i, record(i, url, html, sha1, ref))
                if writer.at >= PACKAGE_BYTES:
                    yield done()
                    writer = None
        if writer is not None:
            yield done()

    return materialize(planned.select("id", "url", "html", "sha1", "refers_to").mapInArrow(run, "uri string, n_records long"), "packages")


RUN_SCHEMA = "uri string, at long, lengths array<long>"
READ_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_packages(spark: SparkSession, packages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records of the packages named in column uri; with_payload adds the payload (null for revisits)."""
    ship(spark)

    def runs(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                found = index_runs(uri)
                yield pa.RecordBatch.from_arrays([pa.array([uri] * len(found), pa.string()), pa.array([a for a, _ in found], pa.int64()),
                                                  pa.array([n for _, n in found], pa.list_(pa.int64()))], names=["uri", "at", "lengths"])

    def records(batches):
        for batch in slices(batches, 1 << 12):
            for uri, at, lengths in zip(*(batch.column(c).to_pylist() for c in range(3))):
                rows = []
                for head, block in read_run(uri, at, lengths):
                    sha1 = base64.b32decode(head["warc-payload-digest"][5:]).hex()
                    revisit = head["warc-type"] == "revisit"
                    if not revisit and hashlib.sha1(block).hexdigest() != sha1:
                        raise ValueError("a payload differs from its digest")
                    rows.append((_page(head["warc-record-id"]), head.get("warc-target-uri"), int(head["x-payload-length"]) if revisit else len(block),
                                 sha1, head["warc-type"], _page(head.get("warc-refers-to")), block if with_payload and not revisit else None))
                types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    located = packages.select("uri").mapInArrow(runs, RUN_SCHEMA).repartition(n)
    out = located.mapInArrow(records, READ_SCHEMA + ", payload binary")
    return out if with_payload else out.drop("payload")


def archive_pages(pages: DataFrame, folder: str | None = None, min_bytes: int = 1000, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """Write all pages as WARC records in packages, then read the packages back: one row per record."""
    spark = pages.sparkSession
    src = pick(pages, id=id_col, url=url_col, html=html_col).withColumn("id", F.col("id").cast("long"))
    packages = write_packages(plan_records(src, min_bytes), folder or scratch_path(spark, "warc"))
    return read_packages(spark, packages)
