"""Web archives (WARC 1.1) and a two-level capture index over them.

Tasks write archives of one gzip member per record, so that a record can be read by its
place alone, and hand back one row per record. These rows, sorted by reversed-host URL key,
are cut into compressed blocks that follow each other in index files; each file ends in a
sparse directory with the first key of every block. A lookup finds the file by the first
keys of all files, the block by binary search in that file's directory, and the captures by
binary search in the block; only then the ranges of the archives are read.

Files are named anew by every attempt of a task, and only files of attempts whose rows were
committed are ever read, so a task that is lost and run again leaves nothing wrong behind.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstats.llm.tables import settle, shared_folder

#: An archive is closed when it has this many bytes, and a new one begun.
ARCHIVE_BYTES = 1 << 30
#: Captures in a block of the index.
BLOCK_LINES = 3000
#: Payloads with more captures than this are written by several tasks.
HOT_CAPTURES = 1000
SLICES = 64
#: Records at most ``GAP`` bytes apart are fetched in one read of at most about ``READ_BYTES``;
#: a task fetches about ``SPAN`` bytes of records, never less than those of one span of an archive.
GAP = 1 << 16
READ_BYTES = 8 << 20
SPAN = 16 << 20

GZIP = 31  # zlib's number for a gzip member


def storage(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that Spark names by a path or an address."""
    address = re.sub(r"^file:/(?!/)", "file:///", folder)
    if "://" not in address:
        return pafs.LocalFileSystem(), address
    return pafs.FileSystem.from_uri(address)


def capture_key(url: Column) -> Column:
    """Key that sorts captures of a host together: host names reversed, then the path.

    Scheme, user, port, a leading ``www.``, the part after ``#`` and differences in case do
    not count. An address without a host is its own key, null has the empty key.
    """
    text = F.lower(F.trim(F.coalesce(url, F.lit(""))))
    start = r"^(?:[a-z][a-z0-9+.\-]*:)?//([^/?#]*)"
    host = F.regexp_replace(F.regexp_extract(text, start, 1), r"^.*@|:[0-9]*$", "")
    host = F.regexp_replace(host, r"^www[0-9]*\.", "")
    names = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    names = F.when(host.rlike(r"^[0-9.]+$"), host).otherwise(names)
    rest = F.regexp_replace(F.regexp_replace(text, start, ""), "#.*$", "")
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(host != "", F.concat(names, F.lit(")"), rest)).otherwise(text)


def digest(payload: bytes) -> str:
    """Base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# -- records -------------------------------------------------------------------------------


def _headed(first: str, headers: list[tuple[str, str]]) -> bytes:
    return "\r\n".join([first, *(f"{name}: {value}" for name, value in headers), "", ""]).encode()


def record(
    kind: str, name: str, url: str | None, payload_digest: str, n_bytes: int, payload: bytes,
    date: str, refers_to: str | None = None,
) -> bytes:
    """One WARC record. A revisit has the HTTP header of the response and no payload."""
    http = [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(n_bytes))]
    block = _headed("HTTP/1.1 200 OK", http) + payload
    # Blanks and control characters would end a header or a field.
    target = re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url or "about:blank")
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
    ]
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        headers += [("WARC-Profile", profile), ("WARC-Refers-To", f"<{refers_to}>")]
    headers += [
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return _headed("WARC/1.1", headers) + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {name.lower(): value for name, value in (line.split(": ", 1) for line in lines if line)}


@dataclass(frozen=True)
class Capture:
    """What a record says; the payload of a revisit is empty, its size and digest are not."""

    page: int | None
    kind: str
    url: str
    payload_bytes: int
    payload_digest: str
    refers_to: int | None
    payload: bytes


def page_of(name: str) -> int | None:
    page = name.strip("<>").split(":")[2]
    return None if page == "none" else int(page)


def parsed(raw: bytes) -> Capture:
    """Read one record; its payload must have the size and digest that it states."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    size, stated = int(_fields(http)["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
    refers_to = fields.get("warc-refers-to")
    if refers_to is None and (len(payload), digest(payload)) != (size, stated):
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    return Capture(
        page_of(fields["warc-record-id"]), fields["warc-type"], fields["warc-target-uri"], size, stated,
        None if refers_to is None else page_of(refers_to), payload,
    )


# -- archives ------------------------------------------------------------------------------


class Appender:
    """Appends compressed pieces to files of a folder; tells each piece's file, place and length."""

    def __init__(self, folder: str, suffix: str, most: int | None = None, opening: bytes = b""):
        self.files, self.path = storage(folder)
        self.suffix, self.most, self.opening = suffix, most, opening
        self.name, self.out, self.place = "", None, 0

    def add(self, piece: bytes) -> tuple[str, int, int]:
        if self.out is None:
            self.name = f"{uuid.uuid4().hex}{self.suffix}"
            self.out = self.files.open_output_stream(f"{self.path}/{self.name}", compression=None)
            self.place = self.out.write(self.opening) or 0
        at = self.place
        self.out.write(piece)
        self.place += len(piece)
        where = (self.name, at, len(piece))
        if self.most and self.place >= self.most:
            self.close()
        return where

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def compressed(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    return packer.compress(data) + packer.flush()


CAPTURES = "id long, url string, kind string, file string, offset long, length long"


def _write(folder: str, date: str):
    """Records of rows sorted by payload and id: the first of a payload responds, the others revisit."""
    about = b"software: parcelstats\r\nformat: WARC File Format 1.1\r\n"
    headers = [("WARC-Type", "warcinfo"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")]

    def opening() -> bytes:
        own = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("Content-Length", str(len(about)))]
        return compressed(_headed("WARC/1.1", headers + own) + about + b"\r\n\r\n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Appender(folder, ".warc.gz", ARCHIVE_BYTES, opening())
        group, responded, again, last = None, None, 0, None
        for batch in batches:
            rows = []
            for id, url, payload, sha, n_bytes, slice_, hot, first in zip(*(c.to_pylist() for c in batch.columns)):
                if (sha, slice_) != group:
                    group, responded, last = (sha, slice_), None, None
                again = again + 1 if last == (id,) else 0
                last = (id,)
                code = base64.b32encode(bytes.fromhex(sha)).decode()
                page = "none" if id is None else id
                alone = slice_ is None
                if alone or (responded is None and (not hot or id == first)):
                    name = f"urn:capture:{page}:{code}" + (f":{again}" if alone and again else "")
                    responded = name
                    piece = record("response", name, url, code, n_bytes, payload, date)
                    kind = "response"
                else:
                    origin = responded or f"urn:capture:{'none' if first is None else first}:{code}"
                    name = f"urn:capture:{page}:{code}:r{again}"
                    piece = record("revisit", name, url, code, n_bytes, b"", date, origin)
                    kind = "revisit"
                rows.append((id, url, kind, *out.add(compressed(piece))))
            yield _batch(rows, CAPTURES)
        out.close()

    return run


KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(field.strip().split(" ") for field in schema.split(",")))
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    arrays = [pa.array(c, KINDS[k]) for c, k in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=list(names))


@dataclass(frozen=True)
class Archives:
    """Folder of the archives and index files, one row per record, one row per index file."""

    folder: str
    captures: DataFrame
    index: DataFrame


def write_archives(
    pages: DataFrame,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    date: str = "2000-01-01T00:00:00Z",
) -> Archives:
    """One record per row in WARC files of the shared folder, and the index over them.

    Of the rows whose payloads (UTF-8 bytes; null counts as empty) are equal and have at
    least ``least_bytes``, the one with the smallest id is written as a response, all others as
    revisits of it; rows with smaller payloads are all responses. Ids are whole numbers; rows
    without one come last. Of rows that repeat an id and a payload the first by url
    is the smallest. Every record carries ``date``, since the rows have none. Other columns are
    ignored; an empty table gives an index without files.

    Equal payloads meet by their SHA-1. Of a payload with more than ``HOT_CAPTURES`` rows only
    the smallest id is looked for beforehand, in partial minima; its rows are then spread over
    slices, and their payloads stay behind where only a revisit is written.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id).cast("long").alias("id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload")).withColumn("n_bytes", F.octet_length("payload").cast("long"))
    shared = F.col("n_bytes") >= least_bytes
    counted = rows.filter(shared).groupBy("sha").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    hot = settle(counted.filter(F.col("n") > HOT_CAPTURES).select("sha", "first", F.lit(True).alias("hot")))
    is_hot = F.coalesce("hot", F.lit(False))
    # Rows of the smallest id stay together; others go anywhere. Without any id, one slice.
    anywhere = F.pmod(F.xxhash64("id", F.when(F.col("id").isNull(), F.col("url"))), F.lit(SLICES))
    slice_ = F.when(~shared, None).when(is_hot & F.col("first").isNotNull(), anywhere).otherwise(F.lit(0))
    needed = ~shared | ~is_hot | F.col("id").eqNullSafe(F.col("first"))
    placed = rows.join(hot, "sha", "left").select(
        "id", "url", F.when(needed, F.col("payload")).alias("payload"), "sha", "n_bytes",
        slice_.cast("long").alias("slice"), is_hot.alias("hot"), "first",
    )
    spread = F.when(F.col("slice").isNull(), F.xxhash64("id", "url")).otherwise(F.col("slice"))
    placed = placed.repartition("sha", spread).sortWithinPartitions(
        "sha", "slice", F.col("id").asc_nulls_last(), "url"
    )
    folder = shared_folder(pages.sparkSession)
    files, path = storage(folder)
    files.create_dir(path, recursive=True)
    captures = settle(placed.mapInArrow(_write(folder, date), CAPTURES))
    return Archives(folder, captures, build_index(captures, folder))


# -- index ---------------------------------------------------------------------------------

INDEX = "file string, key string, id long, n_blocks int, offset long, length long"
#: Order of ids within a key: rows without an id first.
Place = tuple[str, tuple[int, int]]


def place_of(key: str, id: int | None) -> Place:
    return key, ((0, 0) if id is None else (1, id))


def _write_index(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Appender(folder, ".cdx")
        directory: list[tuple] = []
        lines: list[str] = []
        first = None

        def flush() -> None:
            _, at, length = out.add(zlib.compress("\n".join(lines).encode()))
            directory.append((*first, at, length))
            lines.clear()

        for batch in batches:
            for key, id, kind, file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if not lines:
                    first = (key, id)
                lines.append(json.dumps([key, id, kind, file, offset, length]))
                if len(lines) == BLOCK_LINES:
                    flush()
        if lines:
            flush()
        if directory:
            name, at, length = out.add(zlib.compress(json.dumps(directory).encode()))
            out.add(struct.pack("<QQ", at, length))  # for readers that have the file alone
            out.close()
            yield _batch([(name, *directory[0][:2], len(directory), at, length)], INDEX)

    return run


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Index files over captures, sorted by key and id across files: one row per file.

    A key with a third of all captures is cut by its ids; only captures of one key and id
    stay in one file.
    """
    lines = captures.select(capture_key(F.col("url")).alias("key"), "id", "kind", "file", "offset", "length")
    ordered = lines.repartitionByRange("key", "id").sortWithinPartitions("key", "id", "file", "offset")
    return settle(ordered.mapInArrow(_write_index(folder), INDEX))


class Index:
    """Captures by key and id. Holds one directory and one block at a time."""

    def __init__(self, folder: str, files: list[tuple]):
        self.files, self.path = storage(folder)
        self.heads = sorted((place_of(key, id), file, offset, length) for file, key, id, _, offset, length in files)
        self.firsts = [head[0] for head in self.heads]
        self.number, self.handle, self.directory, self.places = -1, None, [], []
        self.block, self.lines, self.keys = (-1, -1), [], []

    def _range(self, offset: int, length: int) -> bytes:
        return zlib.decompress(self.handle.read_at(length, offset))

    def _open(self, number: int) -> None:
        if number != self.number:
            _, file, offset, length = self.heads[number]
            self.close()
            self.handle = self.files.open_input_file(f"{self.path}/{file}")
            self.directory = json.loads(self._range(offset, length))
            self.places = [place_of(key, id) for key, id, _, _ in self.directory]
            self.number = number

    def _load(self, block: int) -> None:
        if (self.number, block) != self.block:
            _, _, offset, length = self.directory[block]
            text = self._range(offset, length).decode()
            self.lines = [json.loads(line) for line in text.split("\n")]
            self.keys = [place_of(key, id) for key, id, *_ in self.lines]
            self.block = (self.number, block)

    def find(self, low: Place, high: Place) -> Iterator[list]:
        """[key, id, kind, file, offset, length] of the captures from ``low`` to ``high``."""
        for number in range(*_reach(self.firsts, low, high)):
            self._open(number)
            for block in range(*_reach(self.places, low, high)):
                self._load(block)
                start, end = bisect.bisect_left(self.keys, low), bisect.bisect_right(self.keys, high)
                yield from self.lines[start:end]

    def close(self) -> None:
        if self.handle is not None:
            self.handle.close()


def _reach(firsts: list[Place], low: Place, high: Place) -> tuple[int, int]:
    """Parts, known by their first places, that can hold places from ``low`` to ``high``."""
    return max(0, bisect.bisect_left(firsts, low) - 1), bisect.bisect_right(firsts, high)


FOUND = "id long, kind string, file string, offset long, length long"


def _look_up(folder: str, files: list[tuple], by_id: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(folder, files)
        for batch in batches:
            rows = []
            for key, id in zip(*(c.to_pylist() for c in batch.columns)):
                low = place_of(key, id) if by_id else (key, (0, 0))
                high = low if by_id else (key, (2, 0))
                rows.extend((own, *rest) for _, own, *rest in index.find(low, high))
            yield _batch(rows, FOUND)
        index.close()

    return run


def look_up(archives: Archives, requests: DataFrame, url: str = "url", id: str | None = "page_id") -> DataFrame:
    """Captures of the requested urls, (id, kind, file, offset, length); with ``id``, only of that id.

    Requests are sorted by key, so that each block of the index is read by one or two tasks
    and once by each. Repeated requests count once. What the driver hands to the tasks is one
    row per index file, as many as tasks wrote the index.
    """
    wanted = requests.select(
        capture_key(F.col(url).cast("string")).alias("key"),
        (F.col(id) if id else F.lit(None)).cast("long").alias("id"),
    ).distinct()
    files = [tuple(row) for row in archives.index.collect()]
    ordered = wanted.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    return ordered.mapInArrow(_look_up(archives.folder, files, id is not None), FOUND)


# -- reading -------------------------------------------------------------------------------

RECORDS = (
    "page long, kind string, url string, payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def _runs(places: list[tuple[str, int, int]]) -> Iterator[list[tuple[str, int, int]]]:
    """Neighbouring places of one file that are fetched together."""
    run: list[tuple[str, int, int]] = []
    for file, offset, length in places:
        if run:
            end = run[-1][1] + run[-1][2]
            near = file == run[0][0] and end <= offset <= end + GAP
            if not near or offset + length - run[0][1] > READ_BYTES:
                yield run
                run = []
        run.append((file, offset, length))
    if run:
        yield run


def _read(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = storage(folder)
        name, handle = None, None
        for batch in batches:
            for places in _runs(list(zip(*(c.to_pylist() for c in batch.columns)))):
                file, start, _ = places[0]
                if file != name:
                    if handle is not None:
                        handle.close()
                    name, handle = file, files.open_input_file(f"{path}/{file}")
                data = handle.read_at(places[-1][1] + places[-1][2] - start, start)
                rows = []
                for _, offset, length in places:
                    c = parsed(zlib.decompress(data[offset - start : offset - start + length], GZIP))
                    payload = c.payload if with_payload else None
                    rows.append((c.page, c.kind, c.url, c.payload_bytes, c.payload_digest, c.refers_to, payload))
                yield _batch(rows, RECORDS)
        if handle is not None:
            handle.close()

    return run


def fetch(archives: Archives, found: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records at the places that ``look_up`` gives, read in ranges and checked.

    (page, kind, url, payload_bytes, payload_digest, refers_to, payload); ``refers_to`` is the
    page whose record a revisit refers to. Places are sorted by archive and offset, neighbours
    are read together, and an archive of any length is read by several tasks. A record whose
    payload does not have its stated size or digest is an error.
    """
    found = settle(found.select("file", "offset", "length"))
    # As many tasks as the archives' bytes ask for: the places alone would look like little work.
    n_tasks = -(-(found.agg(F.sum("length")).first()[0] or 0) // SPAN) or 1
    ordered = found.repartition(n_tasks, "file", F.expr(f"offset div {SPAN}"))
    ordered = ordered.sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(_read(archives.folder, with_payload), RECORDS)
