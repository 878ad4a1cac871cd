"""WARC records in ZIP packages: written by tasks, listed from the ZIP directories, read by range.

A package holds stored members: `archive/data-N.warc.gz`, one gzip member per record, and
`indexes/index-N.cdxj`, a line per record with its place. The reader parses the end record, the
ZIP64 end record and the central directory, finds the indexes, and reads each record's bytes at
their offset in the package; no member is ever extracted.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pandas as pd
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from acreage.llm.common import partitions, stage
from acreage.session import shared_dir

# Signatures and records of the ZIP format.
END, END64_LOCATOR, END64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
END_SIZE, LOCATOR_SIZE, END64_SIZE, CENTRAL_SIZE, LOCAL_SIZE = 22, 20, 56, 46, 30
ZIP64_EXTRA, FULL16, FULL32 = 0x0001, 0xFFFF, 0xFFFFFFFF

RECORDS_PER_PACKAGE = 50_000
MEMBER_BYTES = 16 << 20
READ_BYTES = 4 << 20
#: Bytes of packed records that a task reads, on average, once there are more than the shuffle partitions take.
TASK_BYTES = 64 << 20


class Member(NamedTuple):
    name: str
    method: int
    crc: int
    packed: int
    size: int
    header: int


def read_at(file, offset: int, size: int) -> bytes:
    file.seek(offset)
    data = file.read(size)
    if len(data) != size:
        raise ValueError(f"package ends at {offset + len(data)}, {size} bytes wanted at {offset}")
    return bytes(data)


def directory(file, size: int) -> list[Member]:
    """Members of the package, from its end record, the ZIP64 one where there is one, and the directory."""
    tail = read_at(file, start := max(0, size - END_SIZE - FULL16), size - start)
    at = tail.rfind(END)
    while at >= 0 and at + END_SIZE + int.from_bytes(tail[at + 20:at + 22], "little") != len(tail):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP package")
    count, length, offset = struct.unpack("<HII", tail[at + 10:at + 20])
    locator = start + at - LOCATOR_SIZE
    if locator >= 0 and (found := read_at(file, locator, LOCATOR_SIZE))[:4] == END64_LOCATOR:
        wide = read_at(file, struct.unpack("<Q", found[8:16])[0], END64_SIZE)
        if wide[:4] != END64:
            raise ValueError("the ZIP64 locator points to no ZIP64 end record")
        count, length, offset = struct.unpack("<QQQ", wide[32:56])
    elif FULL16 == count or FULL32 in (length, offset):
        raise ValueError("a ZIP64 package without a ZIP64 locator")
    entries, members, at = read_at(file, offset, length), [], 0
    for _ in range(count):
        if entries[at:at + 4] != CENTRAL:
            raise ValueError("broken central directory")
        flags, method = struct.unpack("<HH", entries[at + 8:at + 12])
        crc, packed, plain, names, extras, notes = struct.unpack("<IIIHHH", entries[at + 16:at + 34])
        header = struct.unpack("<I", entries[at + 42:at + 46])[0]
        name = entries[at + CENTRAL_SIZE:at + CENTRAL_SIZE + names]
        extra = entries[at + CENTRAL_SIZE + names:at + CENTRAL_SIZE + names + extras]
        plain, packed, header = widened(extra, plain, packed, header)
        members.append(Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, crc, packed, plain, header))
        at += CENTRAL_SIZE + names + extras + notes
    return members


def widened(extra: bytes, *values: int) -> list[int]:
    """Replace the 32-bit values that are full by those of the ZIP64 extra field, in their order."""
    out, at = list(values), 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack("<HH", extra[at:at + 4])
        if kind == ZIP64_EXTRA:
            wide = iter(struct.unpack(f"<{size // 8}Q", extra[at + 4:at + 4 + size // 8 * 8]))
            out = [next(wide) if v == FULL32 else v for v in out]
        at += 4 + size
    return out


def data_start(file, member: Member) -> int:
    """Place of a stored member's first byte in the package."""
    if member.method != zipfile.ZIP_STORED:
        raise ValueError(f"{member.name} is compressed by the package; only stored members can be read by range")
    head = read_at(file, member.header, LOCAL_SIZE)
    if head[:4] != LOCAL:
        raise ValueError(f"{member.name} has no local header")
    return member.header + LOCAL_SIZE + sum(struct.unpack("<HH", head[26:30]))


def record_id(page_id: int) -> str:
    return f"<urn:x-page:{page_id}>"


def warc_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record; a revisit keeps the HTTP head, which has the length, and drops the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: {record_id(page_id)}")
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(refers_to)}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC header, HTTP header and payload of a record, keys in lower case."""
    def fields(lines: str) -> dict[str, str]:
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.split("\r\n")[1:])}

    head, _, rest = data.partition(b"\r\n\r\n")
    warc = fields(head.decode())
    block = rest[:int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, fields(http.decode()), payload


def page_of(urn: str | None) -> int | None:
    return int(urn.rpartition(":")[2].rstrip(">")) if urn else None


def open_fs(uri: str):
    return pafs.FileSystem.from_uri(uri)


class Package:
    """Streams records into stored members of one package; only index lines are held."""

    def __init__(self, uri: str):
        self.uri, (store, path) = uri, open_fs(uri)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member, self.members, self.at, self.records, self.bytes, self.lines = None, 0, 0, 0, 0, []

    def add(self, record: bytes) -> None:
        if self.member is None:
            self.name, self.at = f"archive/data-{self.members:05d}.warc.gz", 0
            self.member = self.zip.open(zipfile.ZipInfo(self.name), "w", force_zip64=True)
            self.members += 1
        packed = gzip.compress(record, 1, mtime=0)
        self.member.write(packed)
        self.lines.append(json.dumps({"member": self.name, "offset": self.at, "length": len(packed)}))
        self.at += len(packed)
        self.bytes += len(packed)
        self.records += 1
        if self.at >= MEMBER_BYTES:
            self.end_member()

    def end_member(self) -> None:
        if self.member is not None:
            self.member.close()
            self.member = None

    def close(self) -> tuple[str, int, int]:
        self.end_member()
        self.zip.writestr(zipfile.ZipInfo("indexes/index-00000.cdxj"), "\n".join(self.lines))
        self.zip.close()
        self.out.close()
        return self.uri, self.records, self.bytes


def roles(pages: DataFrame, least: int, share: float = 1 / 1024) -> DataFrame:
    """`pages` (page_id, url, html) with payload digest and the page that a revisit refers to.

    Payloads that hold over `share` of all rows are joined by broadcast, at most 1 / share digests;
    the rest by a shuffle in which no key is larger.
    """
    raw = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.withColumns({"digest": F.sha1(raw), "bytes": F.octet_length(raw)})
    groups = (
        pages.where(F.col("bytes") >= least).groupBy("digest", "bytes")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1 and keeper is not null")
    )
    groups = stage(groups, "payloads")
    bar = pages.count() * share
    heavy = groups.where(F.col("n") >= bar).select("digest", "bytes", F.col("keeper").alias("heavy"))
    light = groups.where(F.col("n") < bar).select(F.col("digest").alias("near"), F.col("keeper").alias("light"))
    near = F.when(F.col("heavy").isNull() & (F.col("bytes") >= least), F.col("digest")).otherwise(
        F.concat(F.lit("-"), F.xxhash64("page_id", "digest")))
    found = pages.join(F.broadcast(heavy), ["digest", "bytes"], "left").withColumn("near", near)
    keeper = F.coalesce("heavy", "light")
    return found.join(light.hint("shuffle_hash"), "near", "left").select(
        "page_id", "url", "html", "digest", F.when(~keeper.eqNullSafe(F.col("page_id")), keeper).alias("refers_to"))


def write_packages(pages: DataFrame, folder: str, least: int = 1000, page_id: str = "page_id", url: str = "url",
                   html: str = "html") -> DataFrame:
    """Write a WARC record per row into packages below `folder`; returns the packages (uri, records, bytes of records).

    Of payloads of at least `least` bytes that are equal, the largest page_id is a response and the
    rows with another id revisit it (a repeated row of that id is a response too). A null html is an empty payload; a null url or page_id leaves
    its header out, and rows without page_id that repeat only each other are responses. A task writes
    under names of its own attempt, and only names of finished attempts are in the result.
    """
    pages = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        package, task, done = None, TaskContext.get(), 0
        for frame in frames:
            ids, refers = ([None if v is None or v != v else int(v) for v in frame[c].astype(object)]
                           for c in ("page_id", "refers_to"))
            for i, u, text, digest, to in zip(ids, frame["url"], frame["html"], frame["digest"], refers):
                if package is None:
                    package = Package(f"{folder}/part-{task.partitionId():05d}-{done:04d}-{uuid.uuid4().hex}.zip")
                package.add(warc_record(i, u, (text or "").encode(), digest, to))
                if package.records >= RECORDS_PER_PACKAGE:
                    yield pd.DataFrame([package.close()], columns=["uri", "records", "bytes"])
                    package, done = None, done + 1
        if package is not None:
            yield pd.DataFrame([package.close()], columns=["uri", "records", "bytes"])

    return stage(roles(pages, least).mapInPandas(write, "uri string, records long, bytes long"), "packages")


def record_places(packages: DataFrame) -> DataFrame:
    """Place of every record (uri, start, length) from the indexes of the packages."""
    def places(frames):
        for frame in frames:
            for uri in frame["uri"]:
                store, path = open_fs(uri)
                with store.open_input_file(path) as file:
                    members = {m.name: m for m in directory(file, file.size())}
                    starts: dict[str, int] = {}
                    for member in members.values():
                        if not member.name.startswith("indexes/"):
                            continue
                        lines = read_at(file, data_start(file, member), member.size).decode().splitlines()
                        rows = []
                        for line in map(json.loads, lines):
                            name = line["member"]
                            if name not in starts:
                                starts[name] = data_start(file, members[name])
                            rows.append((uri, starts[name] + line["offset"], line["length"]))
                        yield pd.DataFrame(rows, columns=["uri", "start", "length"])

    return packages.select("uri").mapInPandas(places, "uri string, start long, length long")


def read_packages(packages: DataFrame, payload: bool = True) -> DataFrame:
    """Every record of the packages: page_id, url, record_type, refers_to, payload_bytes, payload_digest
    and, if asked for, the payload. Digest and length of a response come from the payload read, those
    of a revisit from its headers."""
    def records(frames):
        uri, file = None, None
        for frame in frames:
            rows = []
            starts, sizes, uris = frame["start"].tolist(), frame["length"].tolist(), frame["uri"].tolist()
            i = 0
            while i < len(starts):
                j, end = i, starts[i]
                while j < len(starts) and uris[j] == uris[i] and starts[j] == end and (j == i or end + sizes[j] - starts[i] <= READ_BYTES):
                    end += sizes[j]
                    j += 1
                if uris[i] != uri:
                    if file is not None:
                        file.close()
                    uri, (store, path) = uris[i], open_fs(uris[i])
                    file = store.open_input_file(path)
                data = read_at(file, starts[i], end - starts[i])
                for k in range(i, j):
                    at = starts[k] - starts[i]
                    rows.append(unpacked(gzip.decompress(data[at:at + sizes[k]]), payload))
                i = j
            yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
        if file is not None:
            file.close()

    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", *(["payload"] if payload else [])]
    kinds = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
    total = packages.agg(F.sum("bytes")).first()[0] or 0
    parts = max(partitions(packages), -(-total // TASK_BYTES))  # a stated count, as places are far smaller than their records
    places = record_places(packages).repartition(parts, "uri", F.floor(F.col("start") / MEMBER_BYTES))
    return places.sortWithinPartitions("uri", "start").mapInPandas(records, kinds + (", payload binary" if payload else ""))


def unpacked(record: bytes, payload: bool) -> tuple:
    warc, http, body = parse_record(record)
    revisit = warc["warc-type"] == "revisit"
    digest = base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:")).hex()
    if not revisit and hashlib.sha1(body).hexdigest() != digest:
        raise ValueError(f"payload of {warc.get('warc-record-id')} does not match its digest")
    row = (page_of(warc.get("warc-record-id")), warc.get("warc-target-uri"), warc["warc-type"],
           page_of(warc.get("warc-refers-to")), int(http["content-length"]) if revisit else len(body), digest)
    return (*row, None if revisit else body) if payload else row


def round_trip(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Write the pages as packages in the shared folder and read every record back, without payloads.

    An empty table writes nothing and gives an empty result; extra columns are not read.
    """
    folder = shared_dir(pages.sparkSession)
    folder = f"{folder}/warc-{uuid.uuid4().hex}"
    return read_packages(write_packages(pages, folder, least), payload=False)
