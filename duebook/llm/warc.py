"""WARC archives and their merged index.

Each task writes its pages as one gzip member per record into archives in the shared folder, under
a name of its own; only a task that ends lists its files, so an attempt that is lost leaves
nothing that is read. Payloads of `least` bytes and more that are equal share one response, that
of the largest id, and the others are revisits of it. What is equal is found on narrow rows
(id, SHA-1, bytes) with map-side combination; pages then meet their decision by id, so a payload
that a third of the pages carry is no hot key.

Reading an archive gives its capture run: one row per record, sorted by URL key, time and id.
The runs are range-partitioned by those three, so the captures of one URL may span partitions,
and each partition merges its parts of the runs with a loser tree. The partitions in order are
the history of all captures.

Cases. Null html is an empty payload, a null URL has an empty key and no target header, a null id
is written as `-`, is never referred to and comes back as null. Rows of one id and one payload are
all responses if that id is the largest. Ties in URL and time go by id, then by place. An empty
table writes nothing and gives an empty result. Other columns do not take part.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.llm import common

#: Payloads from this size on are compared; an archive is closed when it has grown so large.
LEAST, ARCHIVE_BYTES = 1000, 1 << 30
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "urlkey string, captured string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, archive string, at long, size long"


def revisits(pages: DataFrame, least: int) -> DataFrame:
    """id, digest, refers_to of the pages whose payload another page's response holds."""
    sized = pages.where("page_id is not null").where(F.octet_length("html") >= least).select("page_id", F.unhex(F.sha1(F.encode("html", "UTF-8"))).alias("digest"))
    sized = common.settle(sized, "digests")
    shared = sized.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("low")).where("low < refers_to").drop("low")
    return sized.join(shared, "digest").where("page_id <> refers_to").distinct()


def uri(url: str) -> str:
    """A URL as it may stand in a header: white space and control characters as escapes."""
    return re.sub(r"[\x00-\x20\x7f-\xa0]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def record(page_id, url, html, refers_to, captured: str) -> bytes:
    payload = (html or "").encode("utf-8", "replace")
    name = "-" if page_id is None else str(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {captured}",
        f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {uri(url)}")
    body = http + payload
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
        body = http
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def when(page_id) -> str:
    """The capture time of a page whose table has none: a second per id, always the same."""
    return (START + dt.timedelta(seconds=(page_id or 0) % 3_000_000_000)).strftime("%Y-%m-%dT%H:%M:%SZ")


def written(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        out, size, names = None, 0, []
        for b in batches:
            for page_id, url, html, refers_to in zip(*(b.column(n).to_pylist() for n in ("page_id", "url", "html", "refers_to"))):
                if out is None:
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(f"{root}/{names[-1]}"), 0
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packer.compress(record(page_id, url, html, refers_to, when(page_id))) + packer.flush()
                out.write(member)
                size += len(member)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["archive"])

    return run


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> tuple[str, DataFrame]:
    """The folder of the archives, and a table of their names."""
    spark = common.ready(pages.sparkSession)
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    again = common.settle(revisits(pages, least), "revisits")
    digest = F.when(F.octet_length("html") >= least, F.unhex(F.sha1(F.encode("html", "UTF-8"))))
    decided = pages.withColumn("digest", digest).join(again, ["page_id", "digest"], "left").select("page_id", "url", "html", "refers_to")
    folder = common.scratch(spark, "warc")
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    return folder, common.settle(decided.mapInArrow(written(folder), "archive string"), "archives")


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """Place, length and content of each gzip member of a stream."""
    at, left = 0, b""
    while True:
        unpack, parts, used = zlib.decompressobj(31), [], 0
        while not unpack.eof:
            chunk = left or stream.read(1 << 20)
            left = b""
            if not chunk:
                break
            parts.append(unpack.decompress(chunk))
            used += len(chunk)
        if not used:
            return
        if not unpack.eof:
            raise ValueError("an archive ends inside a record")
        left = unpack.unused_data
        used -= len(left)
        yield at, used, b"".join(parts)
        at += used


def parsed(raw: bytes) -> dict:
    """The fields of one record; payload facts are taken from the payload where it is there."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    page = lambda name: None if (v := fields[name][len("<urn:page:") : -1]) == "-" else int(v)
    out = {"page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "captured": fields["WARC-Date"], "record_type": fields["WARC-Type"], "refers_to": None}
    stated = int(re.search(rb"Content-Length: (\d+)", http)[1])
    out["payload_digest"] = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if out["record_type"] == "revisit":
        out["refers_to"], out["payload_bytes"] = page("WARC-Refers-To"), stated
    else:
        out["payload_bytes"] = len(payload)
        if hashlib.sha1(payload).hexdigest() != out["payload_digest"] or stated != len(payload):
            raise ValueError(f"the payload of {out['page_id']} is not what its record states")
    out["urlkey"] = urlkey(out["url"] or "")
    return out


def urlkey(url: str) -> str:
    """Host labels backwards, then path and query, in lower case and without the fragment."""
    m = re.match(r"(?i)[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(:\d+)?([^#]*)", url)
    if not m:
        return url.lower()
    host = m[1].lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + (m[2] or "") + ")" + (m[3].lower() or "/")


def order(row: tuple) -> tuple:
    """(URL key, time, id, archive, place); a missing id comes first."""
    return row[0], row[1], -1 if row[2] is None else row[2], row[8], row[9]


NAMES = [f.strip().split(" ")[0] for f in CAPTURE.split(",")]
TYPES = {"string": pa.string(), "long": pa.int64()}
ARROW = pa.schema([(n, TYPES[f.strip().split(" ")[1]]) for n, f in zip(NAMES, CAPTURE.split(","))])


def rows_out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 4096):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 4096]), ARROW.types)], schema=ARROW)


def read_runs(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for b in batches:
            for name in b.column("archive").to_pylist():
                rows = []
                with store.open_input_stream(f"{root}/{name}") as stream:
                    for at, size, raw in members(stream):
                        x = parsed(raw) | {"archive": name, "at": at, "size": size}
                        rows.append(tuple(x[n] for n in NAMES))
                rows.sort(key=order)  # the run: rows of one archive, without payloads
                yield from rows_out(rows)

    return run


def runs(folder: str, archives: DataFrame) -> DataFrame:
    """The capture run of each archive, read back from it."""
    n = max(1, archives.count())
    found = archives.repartitionByRange(n, "archive").mapInArrow(read_runs(folder), CAPTURE)
    return common.settle(found, "runs")


class LoserTree:
    """k sorted runs as one. Inner node i holds the loser of the match of its children; the
    winner of all goes on, and its run plays its way up again."""

    END = (True,)

    def __init__(self, sources: list[Iterator[tuple]]):
        self.sources = sources
        self.k = len(sources)
        self.rows = [next(s, None) for s in sources]
        self.keys = [self.key(r) for r in self.rows]
        self.losers = [0] * self.k
        winners = [0] * self.k + list(range(self.k))
        for i in range(self.k - 1, 0, -1):
            a, b = winners[2 * i], winners[2 * i + 1]
            winners[i], self.losers[i] = (a, b) if self.keys[a] <= self.keys[b] else (b, a)
        self.winner = winners[1] if self.k > 1 else 0

    def key(self, row):
        return self.END if row is None else (False, *order(row))

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.rows[self.winner] is not None:
            w = self.winner
            yield self.rows[w]
            self.rows[w] = next(self.sources[w], None)
            self.keys[w] = self.key(self.rows[w])
            i = (w + self.k) // 2
            while i:
                if self.keys[self.losers[i]] < self.keys[w]:
                    self.losers[i], w = w, self.losers[i]
                i //= 2
            self.winner = w


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of the index: its parts of the runs, merged. The range is bounded by the partitioning."""
    parts: dict[str, list] = {}
    for b in batches:
        for row in zip(*(b.column(n).to_pylist() for n in NAMES)):
            parts.setdefault(row[8], []).append(row)
    for rows in parts.values():
        if any(order(a) > order(b) for a, b in zip(rows, rows[1:])):  # blocks of one run may arrive out of turn
            rows.sort(key=order)
    out = []
    for row in LoserTree([iter(r) for r in parts.values()]):
        out.append(row)
        if len(out) == 4096:
            yield from rows_out(out)
            out = []
    yield from rows_out(out)


def index(found: DataFrame) -> DataFrame:
    """All captures in global order of URL key, time and id: a partition's rows follow those of the last."""
    return found.repartitionByRange("urlkey", "captured", "page_id", "archive", "at").mapInArrow(merged, CAPTURE)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> DataFrame:
    """Write the pages, read the archives back and return the merged index."""
    folder, names = write(pages, id_col, url_col, html_col, least)
    return index(runs(folder, names))
