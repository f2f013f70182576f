"""WARC archives: tasks write one gzip member per record and read archives back as streams."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.llm.common import SMALL_KEYS, columns_of, discard, staged

LEAST = 1000  # bytes of a payload from which on equal ones are written once
ARCHIVE_BYTES = 256 << 20  # a task starts a new archive beyond this
PIECE = 1 << 16  # bytes read or decompressed at once
HEAD_BYTES = 1 << 20  # most bytes of a record's or a message's header lines
NAMES = uuid.UUID("7d0b1f0e-32a5-4b0c-9a63-3f2a51c6f0aa")  # record ids of responses that others refer to

# Fixed values of the format.
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"

RECORDS = ("archive string, offset long, length long, record_type string, record_id string, refers_to_record string, target_uri string, "
           "page_id long, refers_to long, payload_bytes long, payload_digest string, error string")


# ---- writing -----------------------------------------------------------------------------------------------

def _first_of_equals(rows: DataFrame, least: int) -> DataFrame:
    """`rows` with `same`, `is_revisit`, and the `refers_to`, `refers_row` of the response that equal payloads share."""
    rows = rows.withColumn("same", F.when(F.length("payload") >= least, F.unhex(F.sha2("payload", 256))))

    def groups_of(rows: DataFrame) -> DataFrame:
        # One row per payload and page first, so a group of copies is small before its rows meet.
        pages = rows.where("same IS NOT NULL").groupBy("same", "page_id").agg(F.count(F.lit(1)).alias("n"), F.max("row").alias("row"))
        last = pages.groupBy("same").agg(F.max(F.struct("page_id", "row", "n")).alias("last"), F.sum("n").alias("n"))
        return staged(last.where("n > 1").select("same", F.col("last.page_id").alias("refers_to"), F.col("last.row").alias("refers_row"), F.col("last.n").alias("tied")), "equal-payloads")

    groups = groups_of(rows)
    if not groups.where("tied > 1").isEmpty():  # rows of one page and payload: only a number of their own tells them apart
        discard(groups)
        rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "numbered-pages")
        groups = groups_of(rows)
    groups = groups.drop("tied")
    if groups.count() <= SMALL_KEYS:  # rows of 48 bytes
        found = rows.join(F.broadcast(groups), "same", "left")
    else:
        short = rows.where("same IS NULL").withColumns({"refers_to": F.lit(None).cast("long"), "refers_row": F.lit(None).cast("long")})
        found = rows.where("same IS NOT NULL").join(groups, "same", "left").unionByName(short)
    mine = F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("row").eqNullSafe(F.col("refers_row"))
    # A group's NULL page is a group all the same: the row says so.
    return found.withColumn("is_revisit", F.col("refers_row").isNotNull() & ~mine)


def _digest(raw) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def _clean(text: str) -> str:
    """A header value: control characters and blanks would end the line or the address."""
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", text)


def _record_id(page, same: bytes | None, row) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page} {row} {same.hex()}') if same else uuid.uuid4()}>"


class ArchiveWriter:
    """Appends records to archives under names no other attempt of a task uses; `done` lists (path, records, bytes)."""

    def __init__(self, folder: str, archive_bytes: int, date: str, level: int):
        self.fs, self.root = pafs.FileSystem.from_uri(folder)
        self.folder, self.archive_bytes, self.date, self.level = folder.rstrip("/"), archive_bytes, date, level
        self.fs.create_dir(self.root, recursive=True)
        self.stream, self.done = None, []

    def _open(self) -> None:
        name = f"pages-{uuid.uuid4().hex}.warc.gz"
        self.stream = self.fs.open_output_stream(f"{self.root.rstrip('/')}/{name}", compression=None, buffer_size=1 << 20)
        self.name, self.records = name, 0
        self._member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(None, None, None)), ("WARC-Filename", name),
                      ("Content-Type", "application/warc-fields")], [b"format: WARC File Format 1.1\r\n"])

    def _member(self, headers: list[tuple[str, str]], block: list) -> None:
        z = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        sha = hashlib.sha1()
        for part in block:
            sha.update(part)
        lines = [*headers, ("WARC-Date", self.date), ("WARC-Block-Digest", "sha1:" + base64.b32encode(sha.digest()).decode()),
                 ("Content-Length", str(sum(len(part) for part in block)))]
        self.stream.write(z.compress(VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n"))
        for part in block:
            self.stream.write(z.compress(part))
        self.stream.write(z.compress(b"\r\n\r\n") + z.flush())

    def add(self, page, url: str | None, payload, same: bytes | None, row, revisit: bool, refers_to, refers_row) -> None:
        if self.stream is None:
            self._open()
        led = same is not None and refers_row is not None
        headers = [("WARC-Type", "revisit" if revisit else "response"),
                   ("WARC-Record-ID", _record_id(page, same, row) if led and not revisit else _record_id(None, None, None)),
                   ("WARC-Target-URI", _clean(url) if url else f"urn:page:{page}"), ("WARC-Payload-Digest", _digest(payload)),
                   ("Content-Type", "application/http;msgtype=response")]
        if page is not None:
            headers.append(("Page-ID", str(page)))
        if revisit:
            headers += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", _record_id(refers_to, same, refers_row))]
            if refers_to is not None:
                headers.append(("Refers-To-Page-ID", str(refers_to)))
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        self._member(headers, [head] if revisit else [head, payload])
        self.records += 1
        if self.stream.tell() >= self.archive_bytes:
            self.close()

    def close(self) -> None:
        if self.stream is not None:
            size = self.stream.tell()
            self.stream.close()
            self.done.append((f"{self.folder}/{self.name}", self.records, size))
            self.stream = None


def write_archives(pages: DataFrame, folder: str, least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES,
                   date: str = "2024-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Write one record per row of `pages` (page_id, url, html) to archives in `folder`; returns (archive, records, bytes).

    The payload is the html in UTF-8. Of equal payloads of at least `least` bytes the row with the largest page_id is a
    response, the others are revisits of it, without a payload; smaller ones are all responses. Equality is that of length and
    SHA-256. NULL html is an empty payload; a NULL page_id is the smallest; of rows with one page_id and payload any one
    counts as the larger; an empty table gives no archive; other columns are ignored.

    A task writes its rows one after the other, so it holds one payload at a time. An attempt of a task names its archives
    anew, and only those of attempts that succeeded are returned: a lost executor leaves files that nothing lists. `folder`
    must be one that Arrow's file systems reach from every executor. Equal payloads meet as rows of (digest, page_id), added
    up before the shuffle; pages are not moved unless more than SMALL_KEYS payloads repeat.
    """
    rows = columns_of(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long"), "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"), F.lit(0).cast("long").alias("row"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = ArchiveWriter(folder, archive_bytes, date, level)
        for batch in batches:
            page, url, row, same, to, to_row, revisit = (batch.column(c).to_pylist() for c in ("page_id", "url", "row", "same", "refers_to", "refers_row", "is_revisit"))
            for i, payload in enumerate(batch.column("payload")):
                out.add(page[i], url[i], memoryview(payload.as_buffer()), same[i], row[i], revisit[i], to[i], to_row[i])
        out.close()
        if out.done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out.done)], ["archive", "records", "bytes"])

    return staged(_first_of_equals(rows, least).mapInArrow(write, "archive string, records long, bytes long"), "archives")


# ---- reading -----------------------------------------------------------------------------------------------

class WarcError(ValueError):
    pass


class Source:
    """A stream of bytes with a place to put back what was read too far; `at` is the offset of the next byte."""

    def __init__(self, stream):
        self.stream, self.back, self.at = stream, b"", 0

    def take(self) -> bytes:
        raw, self.back = self.back or bytes(self.stream.read(PIECE)), b""
        self.at += len(raw)
        return raw

    def put_back(self, raw: bytes) -> None:
        self.back = bytes(raw) + self.back
        self.at -= len(raw)

    def skip_to_member(self, raw: bytes) -> None:
        """Go on at the next place, from the second byte of `raw`, where a gzip member may begin."""
        raw = raw[1:]
        while True:
            found = raw.find(MAGIC)
            if found >= 0:
                self.put_back(raw[found:])
                return
            more = self.take()
            if not more:
                return
            raw = raw[-2:] + more


class Member:
    """The content of one gzip member, decompressed piece by piece."""

    def __init__(self, source: Source):
        self.source, self.z, self.ready, self.raw = source, zlib.decompressobj(31), bytearray(), b""

    def more(self) -> bool:
        while not self.z.eof:
            self.raw = self.z.unconsumed_tail or self.source.take()
            piece = self.z.decompress(self.raw, PIECE)
            if self.z.eof:
                self.source.put_back(self.z.unused_data)
            elif not piece and not self.raw:
                raise WarcError("archive ends inside a member")
            if piece:
                self.ready += piece
                return True
        return False

    def until(self, mark: bytes, most: int = HEAD_BYTES) -> bytes:
        """Everything up to `mark`, which is passed over."""
        searched = 0
        while (found := self.ready.find(mark, searched)) < 0:
            searched = max(0, len(self.ready) - len(mark) + 1)
            if len(self.ready) > most or not self.more():
                raise WarcError("header lines without an end")
        out = bytes(self.ready[:found])
        del self.ready[:found + len(mark)]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.ready and not self.more():
                raise WarcError("record is shorter than its content length")
            piece = bytes(self.ready[:n])
            del self.ready[:n]
            n -= len(piece)
            yield piece

    def drain(self) -> None:
        self.ready.clear()
        while self.more():
            self.ready.clear()


def _fields(lines: bytes) -> dict[str, str]:
    out = {}
    for line in lines.split(b"\r\n") if lines else []:
        name, colon, value = line.partition(b":")
        if not colon:
            raise WarcError("header line without a colon")
        out[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def _hex(digest: str | None) -> str | None:
    """The bare hexadecimal form of `sha1:...` in base 32 or 16; None for other algorithms."""
    algorithm, _, value = (digest or "").partition(":")
    if algorithm.lower() != "sha1":
        return None
    try:
        return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()
    except ValueError:
        raise WarcError("digest is not base 32") from None


def _number(value: str | None, what: str) -> int:
    if value is None or not re.fullmatch(r"[0-9]{1,18}", value):
        raise WarcError(f"no sound {what}")
    return int(value)


def read_member(member: Member, payloads: bool) -> dict:
    """One record: header fields, then exactly the declared bytes, whose digests are taken on the way, then the end."""
    head = member.until(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not version.startswith(b"WARC/1."):
        raise WarcError("no record at the start of a member")
    fields = _fields(lines)
    left = _number(fields.get("content-length"), "content length")
    kind = fields.get("warc-type", "")
    block, payload, kept, size = hashlib.sha1(), hashlib.sha1(), [], 0
    http = {}
    is_http = fields.get("content-type", "").startswith("application/http")
    held = bytearray() if is_http else None  # the message's head, as far as it is known
    for piece in member.pieces(left):
        block.update(piece)
        if held is not None:
            held += piece
            end = held.find(b"\r\n\r\n")
            if end < 0:
                if len(held) > HEAD_BYTES:
                    raise WarcError("message without an end of its head")
                continue
            http = _fields(bytes(held[:end]).partition(b"\r\n")[2])
            piece, held = bytes(held[end + 4:]), None
        payload.update(piece)
        size += len(piece)
        if payloads and piece:
            kept.append(piece)
    if held is not None:
        raise WarcError("message without an end of its head")
    if bytes(b"".join(member.pieces(4))) != b"\r\n\r\n" or member.ready or member.more():
        raise WarcError("record does not end where its content length says")
    if fields.get("warc-block-digest") and _hex(fields["warc-block-digest"]) not in (None, block.hexdigest()):
        raise WarcError("block digest differs")
    told = _hex(fields.get("warc-payload-digest"))
    if kind == "revisit":  # its payload is that of the record it refers to
        size, digest = _number(http.get("content-length"), "length of the payload"), told
    else:
        digest = payload.hexdigest()
        if told not in (None, digest):
            raise WarcError("payload digest differs")
        if "content-length" in http and _number(http["content-length"], "length of the payload") != size:
            raise WarcError("payload length differs")

    def number(name: str) -> int | None:
        if name in fields and not re.fullmatch(r"-?[0-9]{1,19}", fields[name]):
            raise WarcError(f"no sound {name}")
        return int(fields[name]) if name in fields else None

    return {"record_type": kind, "record_id": fields.get("warc-record-id"), "refers_to_record": fields.get("warc-refers-to"), "target_uri": fields.get("warc-target-uri"),
            "page_id": number("page-id"), "refers_to": number("refers-to-page-id"), "payload_bytes": size, "payload_digest": digest, "error": None,
            **({"payload": b"".join(kept) if kind == "response" else None} if payloads else {})}


def read_stream(stream, payloads: bool = False, report: bool = False) -> Iterator[dict]:
    """The records of an archive in their order, with offset and length of each member.

    A member that is not a sound record raises `WarcError`; with `report` it becomes a row with `error`, and reading goes on
    at the next member: behind this one if it could be decompressed, else where the next one may begin.
    """
    source = Source(stream)
    while True:
        start = source.at
        raw = source.take()
        if not raw:
            return
        source.put_back(raw)
        member = Member(source)
        try:
            record = read_member(member, payloads)
        except (WarcError, zlib.error) as problem:
            if not report:
                raise WarcError(f"at byte {start}: {problem}") from None
            record = {"error": str(problem)}
            broken = isinstance(problem, zlib.error)
            try:
                if not broken:
                    member.drain()
            except (WarcError, zlib.error):
                broken = True
            if broken:
                source.skip_to_member(member.raw)
        yield {"offset": start, "length": source.at - start, **record}


def read_archives(archives: DataFrame, payloads: bool = False, report: bool = False, files: int = 1) -> DataFrame:
    """One row per record of the archives named in the column `archive`; with `payloads` also that of each response.

    Each archive is one stream: a task reads PIECE bytes at a time, decompresses a gzip member as it goes, takes the block by
    its content length and compares digests, so it holds one piece, or one payload if those are asked for. About `files`
    archives make a task. An unsound record fails the job and names archive and offset; with `report` it gives a row with
    `error`. Warcinfo records are rows too.
    """
    schema = RECORDS + (", payload binary" if payloads else "")
    arrow = pa.schema([(name, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[kind]) for name, kind in (c.split() for c in schema.split(", "))])
    names = columns_of(archives, "archive").distinct()
    parts = max(1, -(-names.count() // files))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, where = pafs.FileSystem.from_uri(path)
                rows, held = [], 0
                with fs.open_input_stream(where, compression=None, buffer_size=1 << 20) as stream:
                    try:
                        for record in read_stream(stream, payloads, report):
                            rows.append({"archive": path, **record})
                            held += 500 + len(record.get("payload") or b"")
                            if held > 1 << 22:
                                yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                                rows, held = [], 0
                    except WarcError as problem:
                        raise WarcError(f"{path}: {problem}") from None
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return names.repartition(parts).mapInArrow(read, schema)


def check_revisits(records: DataFrame) -> None:
    """Raise unless each revisit's length, digest and page are those of a response among `records` (read twice).

    Revisits of one response are one row before they meet it."""
    same = ["payload_bytes", "payload_digest"]
    asked = records.where("record_type = 'revisit'").select(F.col("refers_to_record").alias("record_id"), F.col("refers_to").alias("page_id"), *same).distinct()
    held = records.where("record_type = 'response'").select("record_id", "page_id", *same)
    agree = [asked["record_id"] == held["record_id"], asked["page_id"].eqNullSafe(held["page_id"]), *[asked[c] == held[c] for c in same]]
    lost = asked.join(held, agree, "left_anti").limit(1).collect()
    if lost:
        raise WarcError(f"no response {lost[0].record_id} with this payload")


def round_trip(pages: DataFrame, folder: str, least: int = LEAST) -> DataFrame:
    """Write `pages`, read the archives back, check what revisits refer to; one row per page as the archives tell it."""
    archives = write_archives(pages, folder, least)
    records = staged(read_archives(archives).where("record_type <> 'warcinfo'"), "records")
    check_revisits(records)
    discard(archives)
    return records
