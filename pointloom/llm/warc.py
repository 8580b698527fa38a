"""Web archives and a capture index of two levels.

Pages become WARC records, one compressed member each, in archives that tasks write to the
shared folder. Captures are sorted by a URL key with the host turned around; each task packs its
range of them into compressed blocks, one shard file, and notes the first key of each block in
a directory file. A lookup searches the shards' ranges, then a directory, and reads only
the blocks that can have the key; a record is read by its range in the archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointloom.llm.common import by_task, folder_of, pick, scratch_dir, utf8, written

# Payloads below this size are stored in full even if others are equal.
LEAST_SHARED = 1000
# Bytes after which a task begins another archive, captures in an index block, bytes of an archive
# that are read front to back, and bytes that one task reads.
ARCHIVE_BYTES, BLOCK_CAPTURES, STRETCH_BYTES, READ_BYTES = 1 << 30, 1024, 1 << 21, 1 << 24

# What WARC 1.1 prescribes.
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"  # pages carry no time

_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def escaped(url: str | None) -> str:
    """The URL as one word: white space and control characters as percent codes."""
    return _CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", (url or "").strip())


def url_key(url: str | None) -> str:
    """The key that sorts captures by site: ``com,example,www)/path``.

    Host and scheme do not tell upper from lower case, default ports are left out. What has
    no host keeps its text, without URL it is empty.
    """
    word = escaped(url)
    scheme, found, rest = word.partition("://")
    if not found:
        return word
    at = re.search(r"[/?#]", rest)
    place, path = (rest[: at.start()], rest[at.start() :]) if at else (rest, "/")
    host, _, port = place.rpartition("@")[2].lower().partition(":")
    port = "" if (scheme.lower(), port) in (("http", "80"), ("https", "443")) else port
    turned = ",".join(reversed(host.split(".")))
    return f"{turned}{':' * bool(port)}{port}){path.partition('#')[0] or '/'}"


def record(page: dict[str, object]) -> bytes:
    """The WARC record of a page, not yet compressed. A revisit keeps the header of the
    response, with the payload's length, and leaves the payload out."""
    payload, uri = page["payload"], escaped(page["url"])
    digest = base64.b32encode(bytes.fromhex(page["digest"])).decode()
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page['page_id']} {uri} {digest}")
    head = [
        "WARC/1.1",
        f"WARC-Type: {page['kind']}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if page["page_id"] is not None:
        head.append(f"Page-ID: {page['page_id']}")
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    body = http + payload
    if page["kind"] == "revisit":
        head += [f"WARC-Profile: {_REVISIT}", f"Refers-To-Page-ID: {page['refers_to']}"]
        body = http
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> dict[str, object]:
    """A page from its record; raises where the payload is not the one that was written."""
    head, body = _fields(data)
    http, payload = _fields(body[: int(head["content-length"])])
    digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
    kind = head["warc-type"]
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"damaged record {head['warc-record-id']}")
    page, refers = head.get("page-id"), head.get("refers-to-page-id")
    return {
        "page_id": None if page is None else int(page),
        "payload_bytes": int(http["content-length"]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": None if refers is None else int(refers),
    }


def _fields(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = data.partition(b"\r\n\r\n")
    lines = (line.partition(": ") for line in head.decode().split("\r\n")[1:])
    return {name.lower(): value for name, _, value in lines}, body


def with_roles(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest``, ``kind``, ``refers_to`` of every page.

    Of equal payloads of ``LEAST_SHARED`` bytes or more the one with the largest id is the
    response, the others revisit it; rows that share this id are all responses, and so are
    pages without an id where no equal one has any. A null payload is empty. Only digests
    that occur more than once are joined to the pages, counted before they are shuffled.
    """
    payload = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), utf8("html").alias("payload")
    )
    hashed = payload.withColumn("digest", F.sha1("payload"))
    shared = (
        hashed.filter(F.octet_length("payload") >= LEAST_SHARED)
        .groupBy("digest")
        .agg(F.max("page_id").alias("leader"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND leader IS NOT NULL")
        .select("digest", "leader")
    )
    revisit = F.col("leader").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("leader"))
    return hashed.join(shared, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("leader")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write records of :func:`with_roles` rows; returns their captures: ``key``, ``page_id``,
    ``file``, ``start``, ``length``.

    Each attempt of a task writes files of its own name, and captures name only those of the
    attempt that counted; what a lost one left behind is never read.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        system, base = folder_of(folder)
        system.create_dir(base, recursive=True)
        part, out, size, name = TaskContext.get().partitionId(), None, 0, ""
        try:
            for batch in batches:
                found: dict[str, list] = {n: [] for n in ("key", "page_id", "file", "start", "length")}
                for page in batch.to_pylist():
                    if out is None or size >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, size = f"pages-{part:05d}-{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{base}/{name}", compression=None)
                    member = zlib.compressobj(wbits=31)
                    data = member.compress(record(page)) + member.flush()
                    out.write(data)
                    values = (url_key(page["url"]), page["page_id"], name, size, len(data))
                    for column, value in zip(found.values(), values):
                        column.append(value)
                    size += len(data)
                yield found
        finally:
            if out is not None:
                out.close()

    schema = "key string, page_id long, file string, start long, length long"
    return written(by_task(pages, schema, convert), "captures")


class Shard(NamedTuple):
    """A range of captures: its first and last key, and the files of blocks and directory."""

    first: bytes
    last: bytes
    name: str


class CaptureIndex(NamedTuple):
    """Sorted shards; one per task that built them, so they are few. ``n_bytes`` is the size of
    all captures in the archives."""

    spark: SparkSession
    folder: str
    archives: str
    shards: list[Shard]
    n_bytes: int


def build_index(captures: DataFrame, archives: str) -> CaptureIndex:
    """Sort captures by key and pack them into blocks with a directory.

    The range is over key and place, so captures of one key spread over tasks like others.
    """
    folder = scratch_dir(captures.sparkSession, "capture-index")
    order = ["key", "file", "start"]
    lines = F.concat_ws("\t", "key", "file", "start", "length").cast("binary")
    ordered = captures.repartitionByRange(*order).sortWithinPartitions(*order)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        system, base = folder_of(folder)
        system.create_dir(base, recursive=True)
        name = f"shard-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        directory: list[bytes] = []
        first = last = b""
        start = 0
        out = None
        for lines in _in_blocks(batches):
            if out is None:
                out = system.open_output_stream(f"{base}/{name}.blocks", compression=None)
                first = _key(lines[0])
            data = zlib.compress(b"\n".join(lines))
            out.write(data)
            directory.append(b"%s\t%d\t%d" % (_key(lines[0]), start, len(data)))
            start, last = start + len(data), _key(lines[-1])
        if out is None:
            return
        out.close()
        with system.open_output_stream(f"{base}/{name}.directory", compression=None) as file:
            file.write(b"\n".join(directory))
        yield {"first": [first], "last": [last], "name": [name]}

    shards = by_task(ordered.select(lines.alias("line")), "first binary, last binary, name string", convert)
    found = sorted(Shard(bytes(r["first"]), bytes(r["last"]), r["name"]) for r in shards.collect())
    n_bytes = captures.agg(F.sum("length")).first()[0] or 0
    return CaptureIndex(captures.sparkSession, folder, archives, found, n_bytes)


def _key(line: bytes) -> bytes:
    return line.partition(b"\t")[0]


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    held: list[bytes] = []
    for batch in batches:
        held += batch["line"].to_pylist()
        while len(held) >= BLOCK_CAPTURES:
            yield held[:BLOCK_CAPTURES]
            held = held[BLOCK_CAPTURES:]
    if held:
        yield held


def _blocks_with(keys: list[bytes], key: bytes) -> range:
    """Blocks that can have a key: from the last that begins before it to the last that
    begins with it."""
    return range(max(bisect_left(keys, key) - 1, 0), bisect_right(keys, key))


def lookup(index: CaptureIndex, keys: DataFrame) -> DataFrame:
    """All captures with one of the keys (a column ``key``): ``key``, ``file``, ``start``,
    ``length``. A key asked for more than once gives its captures once; null ones give none.

    Two binary searches lead to the blocks of a key; each block that is asked for is read once, by
    range, and searched for all its keys. A key with very many captures has many blocks, which
    different tasks read.
    """
    folder, shards = index.folder, index.shards
    asked = pick(keys, "key").filter(F.col("key").isNotNull()).distinct()

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        system, base = folder_of(folder)
        lasts, firsts = [s.last for s in shards], [s.first for s in shards]
        name, directory, begins = "", [], []
        for batch in batches:
            found: dict[str, list] = {"shard": [], "block": [], "size": [], "key": []}
            for text in batch["key"].to_pylist():
                key = text.encode()
                for shard in shards[bisect_left(lasts, key) : bisect_right(firsts, key)]:
                    if shard.name != name:
                        name = shard.name
                        with system.open_input_stream(f"{base}/{name}.directory", compression=None) as file:
                            directory = [line.split(b"\t") for line in file.read().split(b"\n")]
                        begins = [d[0] for d in directory]
                    for at in _blocks_with(begins, key):
                        values = (name, int(directory[at][1]), int(directory[at][2]), text)
                        for column, value in zip(found.values(), values):
                            column.append(value)
            yield found

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        system, base = folder_of(folder)
        name, file, at, lines = "", None, -1, []
        for batch in batches:
            found: dict[str, list] = {"key": [], "file": [], "start": [], "length": []}
            for row in batch.to_pylist():
                if row["shard"] != name:
                    if file is not None:
                        file.close()
                    name, at = row["shard"], -1
                    file = system.open_input_file(f"{base}/{name}.blocks")
                if row["block"] != at:
                    at = row["block"]
                    lines = zlib.decompress(file.read_at(row["size"], at)).split(b"\n")
                key = row["key"].encode()
                i = bisect_left(lines, key, key=_key)
                while i < len(lines) and _key(lines[i]) == key:
                    _, archive, start, length = lines[i].split(b"\t")
                    values = (row["key"], archive.decode(), int(start), int(length))
                    for column, value in zip(found.values(), values):
                        column.append(value)
                    i += 1
            yield found
        if file is not None:
            file.close()

    # Neighbouring keys are asked for by one task, which then reads few directories.
    wanted = by_task(
        asked.sortWithinPartitions("key"), "shard string, block long, size long, key string", locate
    )
    dealt = wanted.repartition("shard", "block").sortWithinPartitions("shard", "block", "key")
    return by_task(dealt, "key string, file string, start long, length long", search)


def read_records(index: CaptureIndex, captures: DataFrame) -> DataFrame:
    """The pages behind captures: ``page_id``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to``.

    A task reads stretches of archives from front to back, one record at a time. The number of
    tasks follows the bytes of the archives: rows that stand for records are too small to tell.
    """
    folder = index.archives

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        system, base = folder_of(folder)
        name, file = "", None
        for batch in batches:
            pages = []
            for row in batch.to_pylist():
                if row["file"] != name:
                    if file is not None:
                        file.close()
                    name, file = row["file"], system.open_input_file(f"{base}/{row['file']}")
                data = file.read_at(row["length"], row["start"])
                pages.append(parse(zlib.decompress(data, wbits=31)))
            yield {n: [p[n] for p in pages] for n in _PAGE}
        if file is not None:
            file.close()

    stretch = F.floor(F.col("start") / STRETCH_BYTES)
    tasks = -(-index.n_bytes // READ_BYTES) or 1
    dealt = captures.repartition(tasks, "file", stretch).sortWithinPartitions("file", "start")
    schema = ", ".join(f"{n} {kind}" for n, kind in _PAGE.items())
    return by_task(dealt.select("file", "start", "length"), schema, convert)


_PAGE = {
    "page_id": "long",
    "payload_bytes": "long",
    "payload_digest": "string",
    "record_type": "string",
    "refers_to": "long",
}


def archived(pages: DataFrame) -> CaptureIndex:
    """Archives and capture index of a table of pages, in the shared folder.

    Null URLs and payloads count as empty, null ids stay null, rows alike are records each,
    no rows give an index without shards; extra columns are not read.
    """
    folder = scratch_dir(pages.sparkSession, "archives")
    return build_index(write_archives(with_roles(pages), folder), folder)


def keys_of(pages: DataFrame) -> DataFrame:
    """The keys of the pages' URLs, each once."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        for batch in batches:
            yield {"key": [url_key(u) for u in batch["url"].to_pylist()]}

    urls = pick(pages, "url").select(F.col("url").cast("string"))
    return by_task(urls, "key string", convert).distinct()
