"""Operator 9: WARC archives with a two-level capture index.

Tasks write the records of their rows as archives in a shared folder, one
compressed member a record, and return where each record lies.  The index sorts
captures by reversed-host URL key; consecutive lines form compressed blocks in one
index part per task, and each part has a sparse directory, the first key of each
block.  A look-up finds the part among the parts' first keys (one string a part, the
only thing that travels whole), the block in the part's directory, the line in the block --
each by binary search -- and then reads the record's byte range, and only that.

Look-up keys are sorted by range first, so a task reads few parts and each block
once; records are then read file by file in order of offset.

Files get names of their own for each task attempt and are only referred to by
rows of attempts that Spark committed, so lost executors leave at most files
that nothing refers to.

Defined results: null html is an empty payload, a null url has the key ``)``, a null page
id stays null; pages repeated wholly are records of their own, each found; of
equal payloads of at least ``least_bytes`` the rows with the largest page id are responses; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentispark.llm.common import shared_folder, written

DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# Names that Hadoop has for schemes that Arrow knows under another one.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def arrow_uri(uri: str) -> str:
    """A Hadoop-style URI as Arrow writes it: local paths bare, other schemes by Arrow's names."""
    if uri.startswith("file:"):
        return "/" + uri[len("file:"):].lstrip("/")
    scheme, colon, rest = uri.partition("://")
    return SCHEMES.get(scheme, scheme) + colon + rest


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a Hadoop-style URI."""
    uri = arrow_uri(uri)
    return pafs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (pafs.LocalFileSystem(), uri)


def url_key(url: str | None, page_id: int | None) -> str:
    """``com,example,www)/path?query 00000000000000000042``: sorts captures of a
    site, then of a page, together."""
    url = url or ""
    try:
        parts = urlsplit(url)
        host = ",".join(reversed((parts.hostname or "").split(".")))
        rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    except ValueError:
        host, rest = "", url
    rest = quote(rest if url else "", safe="/?&=#%:;,.~@!$'()*+-_")
    number = "~" if page_id is None else f"{page_id + (1 << 63):020d}"
    return f"{quote(host, safe=',:')}){rest} {number}"


def record(page_id, url, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    """One record, uncompressed; a revisit (``refers_to``) holds the payload's HTTP
    header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Date", DATE), ("WARC-Target-URI", quote(url or "", safe="/?&=#%:;,.~@!$'()*+-_[]")),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", len(block))])
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers, payload (None in revisits) and full payload size of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record here")
    out = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[:int(out["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    return out | {"size": int(sizes[0]), "payload": None if out["WARC-Type"] == "revisit" else payload}


def _pack(data: bytes) -> bytes:
    return gzip.compress(data, 6, mtime=0)


def _maybe(x):
    return None if pd.isna(x) else int(x)


def with_revisits(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """``page_id, url, html, digest, refers_to``: rows to write, ``refers_to`` set for revisits."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    large = rows.where(F.octet_length("html") >= least_bytes).groupBy("digest").agg(
        F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return (rows.join(large, "digest", "left")
            .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")))
            .select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"),
                    F.octet_length("html").cast("long").alias("size"), "digest", "refers_to"))


def write_archives(rows: DataFrame, folder: str, file_bytes: int = 1 << 30) -> DataFrame:
    """Write :func:`with_revisits`' rows; the captures' ``key, file, offset, length``, as a
    table in the shared folder."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for b in batches:
                lines = []
                for page_id, url, html, size, digest, refers in b.itertuples(index=False):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    page_id, refers = _maybe(page_id), _maybe(refers)
                    data = _pack(record(page_id, url, (html or "").encode(), size, digest, refers))
                    out.write(data)
                    lines.append((url_key(url, page_id), name, at, len(data)))
                    at += len(data)
                if lines:
                    yield pd.DataFrame(lines, columns=["key", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return written(rows.mapInPandas(run, "key string, file string, offset long, length long"), "captures")


def build_index(captures: DataFrame, folder: str, block_lines: int = 300) -> list[tuple[str, str]]:
    """Write the sorted index below ``folder``; ``(first key, part name)`` of every part, sorted."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        name, held, directory, at, out = uuid.uuid4().hex, [], [], 0, None

        def flush():
            nonlocal at, held
            data = _pack("\n".join("\t".join(map(str, x)) for x in held).encode())
            out.write(data)
            directory.append((held[0][0], at, len(data)))
            at += len(data)
            held = []

        for b in batches:
            for line in b.itertuples(index=False):
                out = out or fs.open_output_stream(f"{root}/{name}.blocks", compression=None)
                held.append(tuple(line))
                if len(held) == block_lines:
                    flush()
        if out is None:
            return
        if held:
            flush()
        out.close()
        with fs.open_output_stream(f"{root}/{name}.directory", compression=None) as f:
            f.write(_pack(json.dumps(directory).encode()))
        yield pd.DataFrame([(directory[0][0], name)], columns=["key", "part"])

    parts = (captures.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
             .mapInPandas(run, "key string, part string"))
    return sorted((r[0], r[1]) for r in written(parts, "parts").collect())


class Index:
    """Reader of one index, for one task: keeps the last directory and block."""

    def __init__(self, folder: str, parts: list[tuple[str, str]]):
        self.fs, self.root = filesystem(folder)
        self.parts, self.firsts = parts, [k for k, _ in parts]
        self.part, self.directory, self.heads = None, [], []
        self.at, self.lines, self.keys = None, [], []

    def _read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        with self.fs.open_input_file(f"{self.root}/{name}") as f:
            return gzip.decompress(f.read_at(length, offset) if length is not None else f.read())

    def _open_part(self, p: int) -> None:
        if self.part != p:
            self.directory = json.loads(self._read(f"{self.parts[p][1]}.directory"))
            self.heads = [d[0] for d in self.directory]
            self.part, self.at = p, None

    def _open_block(self, p: int, b: int) -> None:
        if self.at != b:
            _, offset, length = self.directory[b]
            data = self._read(f"{self.parts[p][1]}.blocks", offset, length).decode()
            self.lines = [x.split("\t") for x in data.split("\n")]
            self.keys = [x[0] for x in self.lines]
            self.at = b

    def find(self, key: str) -> list[tuple[str, int, int]]:
        """``(file, offset, length)`` of all captures with the key."""
        found = []
        p = max(0, bisect_left(self.firsts, key) - 1)  # equal keys may begin in the part before
        while p < len(self.parts) and self.firsts[p] <= key:
            self._open_part(p)
            b = max(0, bisect_left(self.heads, key) - 1)
            while b < len(self.heads) and self.heads[b] <= key:
                self._open_block(p, b)
                for x in self.lines[bisect_left(self.keys, key):bisect_right(self.keys, key)]:
                    found.append((x[1], int(x[2]), int(x[3])))
                b += 1
            p += 1
        return found


def look_up(keys: DataFrame, folder: str, parts: list[tuple[str, str]]) -> DataFrame:
    """``key, file, offset, length`` of the captures of ``keys`` (column ``key``; each key once)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(folder, parts)
        for b in batches:
            rows = [(k, *hit) for k in b["key"] for hit in index.find(k)]
            yield pd.DataFrame(rows, columns=["key", "file", "offset", "length"])

    ordered = keys.select("key").distinct().repartitionByRange("key").sortWithinPartitions("key")
    return ordered.mapInPandas(run, "key string, file string, offset long, length long")


_RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
            "url string, payload binary")


def read_records(places: DataFrame, folder: str) -> DataFrame:
    """Records at ``file, offset, length``, by range reads; digests are taken from the
    payload read (of revisits: from the header)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = filesystem(folder)
        name, file = None, None
        for b in batches:
            for lo in range(0, len(b), 500):
                out = []
                for n, offset, length in b.iloc[lo:lo + 500][["file", "offset", "length"]].itertuples(index=False):
                    if n != name:
                        if file is not None:
                            file.close()
                        name, file = n, fs.open_input_file(f"{root}/{n}")
                    r = parse_record(zlib.decompress(file.read_at(int(length), int(offset)), 31))
                    number = r["WARC-Record-ID"][len("<urn:page:"):-1]
                    refers = r.get("WARC-Refers-To")
                    payload = r["payload"]
                    digest = r["WARC-Payload-Digest"].split(":")[1] if payload is None else hashlib.sha1(payload).hexdigest()
                    out.append((int(number) if number else None, r["size"] if payload is None else len(payload), digest,
                                r["WARC-Type"], int(refers[len("<urn:page:"):-1]) if refers else None,
                                r["WARC-Target-URI"], payload))
                yield pd.DataFrame(out, columns=_NAMES).astype({"page_id": "Int64", "refers_to": "Int64"})
        if file is not None:
            file.close()

    # by hash: a range exchange would look everything up once more to sample it
    return places.repartition("file").sortWithinPartitions("file", "offset").mapInPandas(run, _RECORDS)


_NAMES = [x.split()[0] for x in _RECORDS.split(", ")]


def archive_pages(pages: DataFrame, folder: str | None = None) -> tuple[str, list[tuple[str, str]], DataFrame]:
    """Write and index ``pages``: the folder, the index's parts, the captures table."""
    folder = folder or shared_folder(pages.sparkSession, "warc")
    captures = write_archives(with_revisits(pages), f"{folder}/archives")
    return folder, build_index(captures, f"{folder}/index"), captures


def page_keys(pages: DataFrame) -> DataFrame:
    """Look-up keys of pages."""
    @F.pandas_udf("string")
    def key(url: pd.Series, page_id: pd.Series) -> pd.Series:
        return pd.Series([url_key(u, int(p) if p else None) for u, p in zip(url, page_id)])

    return pages.select(key("url", F.col("page_id").cast("string")).alias("key"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Every page written, looked up by its key and read back (without the payload)."""
    folder, parts, _ = archive_pages(pages)
    places = look_up(page_keys(pages), f"{folder}/index", parts)
    return read_records(places, f"{folder}/archives").drop("url", "payload")
