"""WARC archives with a two-level capture index.

Archives: one gzip member per record; a payload that an earlier page has is a revisit record. Index: captures sorted
by reversed-host key (and id) into zlib-compressed blocks; each index file ends in its sparse block directory, and a
list of the index files' first keys is the level above. A look-up bisects that list, then a file's directory, range-
reads one block, bisects in it, and range-reads the record.
"""

from __future__ import annotations

import bisect
import hashlib
import struct
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import filesystem, if_small, shared_dir, ship, written
from factloom.llm.url_filter import url_parts

#: payloads from this size on may be revisits; captures in a block; rows of repeated digests that are broadcast
REVISIT_BYTES, BLOCK_LINES, BROADCAST_DIGESTS = 100, 256, 100_000
DATE = "1970-01-01T00:00:00Z"
#: marks a target URI that had line breaks
ESCAPED = "X-Target-URI-Escaped: yes"
#: records that a writer or a reader holds at once
SLICE = 256
#: the id of captures without one, in keys
NO_ID = -(1 << 63)


def surt(url: Column) -> Column:
    """Reversed-host key: com,example,www)/path?query; empty for a null url."""
    host, _ = url_parts(url)
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1), F.lit(""))
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    return F.when(url.isNull(), F.lit("")).when(host == "", F.concat(F.lit(")"), url)).otherwise(key)


def record(page_id, url, payload: bytes, digest: str, refers_to, spare: str = "0") -> bytes:
    """One record as a gzip member; a revisit keeps the HTTP header (with the payload's length), not the payload.

    The target URI is the url as it is, but for one with a line break, which a header cannot hold: its %, CR and LF are
    written as %25, %0D and %0A and a header says so. ``spare`` makes the record ID of a page without id.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}",
            f"WARC-Record-ID: <urn:page:{page_id}>" if page_id is not None else f"WARC-Record-ID: <urn:capture:{spare}>"]
    if url is not None and ("\r" in url or "\n" in url):
        head += ["WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"), ESCAPED]
    elif url is not None:
        head.append("WARC-Target-URI: " + url)
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def parse(member: bytes) -> dict:
    """The record of a gzip member; a response's payload must have the digest that its header names."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    h = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    http, _, payload = rest[: int(h["Content-Length"])].partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    urn = lambda k: int(h[k][10:-1]) if h.get(k, "").startswith("<urn:page:") else None
    digest = h["WARC-Payload-Digest"][7:]
    if h["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {h.get('WARC-Record-ID')} is damaged")
    url = h.get("WARC-Target-URI")
    if ESCAPED.split(": ")[0] in h:
        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return {"page_id": urn("WARC-Record-ID"), "url": url, "payload": payload,
            "payload_bytes": size, "payload_digest": digest, "record_type": h["WARC-Type"], "refers_to": urn("WARC-Refers-To")}


@dataclass
class Index:
    """The upper level: first (key, id) of each index file, ascending, and the files."""

    firsts: list[tuple[str, int]]
    files: list[str]


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the archives; returns their captures as a table: key, id, file, offset, length.

    Among equal payloads of at least REVISIT_BYTES bytes, rows with the smallest id are responses, the others
    revisit it; rows without an id are responses. A null payload is empty.
    """
    ship(pages.sparkSession)
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    t = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    t = t.withColumn("digest", F.sha2("payload", 256))
    again = t.filter(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = written(again.select("digest", "first"), "digests")
    t = t.join(if_small(again, again.count(), BROADCAST_DIGESTS), "digest", "left")
    t = t.select("id", "url", "payload", "digest", F.when(F.col("first") < F.col("id"), F.col("first")).alias("refers_to"), surt(F.col("url")).alias("key"))

    def write(batches):
        task, fs, f, at, uri = TaskContext.get(), None, None, 0, ""
        for b in batches:
            if f is None and b.num_rows:  # the name is the attempt's own: rows of a lost attempt name no other's file
                uri = f"{folder}/pages-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
                fs, path = filesystem(uri)
                fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                f = fs.open_output_stream(path, compression=None)
            offsets, lengths = [], []
            for x in range(0, b.num_rows, SLICE):
                cols = [b.column(n).slice(x, SLICE).to_pylist() for n in ("id", "url", "payload", "digest", "refers_to")]
                for row in zip(*cols, strict=True):
                    m = record(*row, spare=f"{task.partitionId()}-{task.taskAttemptId()}-{at}")
                    f.write(m)
                    offsets.append(at)
                    lengths.append(len(m))
                    at += len(m)
            yield pa.record_batch([b.column("key"), b.column("id").fill_null(NO_ID), pa.array([uri] * b.num_rows), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], ["key", "id", "file", "offset", "length"])
        if f is not None:
            f.close()

    return written(t.mapInArrow(write, "key string, id long, file string, offset long, length long"), "captures")


def build_index(captures: DataFrame, folder: str) -> Index:
    """Sorted, blocked and written; the driver gets one row per index file."""
    ordered = captures.repartitionByRange("key", "id").sortWithinPartitions("key", "id", "file", "offset")

    def build(batches):
        task, lines, directory, f, at, uri = TaskContext.get(), [], [], None, 0, ""

        def flush():
            nonlocal at
            z = zlib.compress("\n".join("\t".join((str(i), w, str(o), str(n), k.replace("%", "%25").replace("\n", "%0A"))) for k, i, w, o, n in lines).encode("utf-8", "surrogatepass"))
            directory.append((lines[0][0], lines[0][1], at, len(z)))
            f.write(z)
            at += len(z)
            lines.clear()

        for b in batches:
            if f is None and b.num_rows:
                uri = f"{folder}/index-{task.partitionId():06d}-{task.taskAttemptId()}.cdx"
                fs, path = filesystem(uri)
                fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                f = fs.open_output_stream(path, compression=None)
            for row in zip(*(b.column(n).to_pylist() for n in ("key", "id", "file", "offset", "length")), strict=True):
                lines.append(row)
                if len(lines) == BLOCK_LINES:
                    flush()
        if f is not None:
            if lines:
                flush()
            parts = [struct.pack("<qqqI", i, o, n, len(e := k.encode("utf-8", "surrogatepass"))) + e for k, i, o, n in directory]
            foot = zlib.compress(b"".join(parts))
            f.write(foot + struct.pack("<QQ", at, len(foot)))
            f.close()
            yield pa.record_batch([pa.array([directory[0][0]]), pa.array([directory[0][1]]), pa.array([uri])], ["key", "id", "file"])

    rows = sorted((r["key"], r["id"], r["file"]) for r in ordered.mapInArrow(build, "key string, id long, file string").collect())
    return Index([r[:2] for r in rows], [r[2] for r in rows])


class Reader:
    """Look-ups in an index; the last directory and block stay in memory, so sorted look-ups read each once."""

    def __init__(self, index: Index):
        self.index, self.handles, self.at, self.block = index, {}, None, None

    def _open(self, uri: str):
        if uri not in self.handles:
            if len(self.handles) >= 16:
                self.close()
            fs, path = filesystem(uri)
            self.handles[uri] = fs.open_input_file(path)
        return self.handles[uri]

    def close(self) -> None:
        for f in self.handles.values():
            f.close()
        self.handles.clear()

    def _range(self, uri: str, offset: int, length: int) -> bytes:
        f = self._open(uri)
        f.seek(offset)
        return f.read(length)

    def _directory(self, k: int):
        if self.at != k:
            uri = self.index.files[k]
            size = self._open(uri).size()
            start, n = struct.unpack("<QQ", self._range(uri, size - 16, 16))
            raw, p, keys, spans = zlib.decompress(self._range(uri, start, n)), 0, [], []
            while p < len(raw):
                i, o, m, e = struct.unpack_from("<qqqI", raw, p)
                p += 28
                keys.append((raw[p : p + e].decode("utf-8", "surrogatepass"), i))
                spans.append((o, m))
                p += e
            self.at, self.keys, self.spans, self.block = k, keys, spans, None
        return self.keys, self.spans

    def _lines(self, k: int, j: int):
        _, spans = self._directory(k)
        if self.block != j:
            lines = [x.split("\t", 4) for x in zlib.decompress(self._range(self.index.files[k], *spans[j])).decode("utf-8", "surrogatepass").split("\n")]
            self.block, self.rows = j, [((e.replace("%0A", "\n").replace("%25", "%"), int(i)), w, int(o), int(n)) for i, w, o, n, e in lines]
        return self.rows

    def captures(self, key: str, page_id: int) -> list[tuple[str, int, int]]:
        """(archive, offset, length) of every capture with this key and id."""
        want, out = (key, page_id), []
        k = max(0, bisect.bisect_left(self.index.firsts, want) - 1)
        while k < len(self.index.files) and self.index.firsts[k] <= want:
            keys, _ = self._directory(k)
            j = max(0, bisect.bisect_left(keys, want) - 1)
            while j < len(keys) and keys[j] <= want:
                rows = self._lines(k, j)
                a = bisect.bisect_left(rows, want, key=lambda r: r[0])
                while a < len(rows) and rows[a][0] == want:
                    out.append(rows[a][1:])
                    a += 1
                if a < len(rows):
                    return out
                j += 1
            k += 1
        return out

    def record(self, file: str, offset: int, length: int) -> dict:
        return parse(self._range(file, offset, length))


def read_back(pages: DataFrame, index: Index, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Looks up every distinct (url, id) of ``pages``: one row per record found, from the archives.

    Rows that repeat url and id have a record each, all of which are found; a null url or id is looked up as such. An
    empty table gives none; extra columns are ignored.
    """
    keys = pages.select(surt(F.col(url_col)).alias("key"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id")).distinct()
    keys = keys.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]

    def look(batches):
        reader = Reader(index)
        for b in batches:
            spans = [c for k, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for c in reader.captures(k, i)]
            spans.sort()  # archive order: neighbouring ranges are read one after the other
            got = []
            for s in spans:
                r = reader.record(*s)  # its payload has been checked against its digest and is not kept
                got.append([r[n] for n in names])
            cols = zip(*got, strict=True) if got else [[]] * len(names)
            yield pa.record_batch([pa.array(c, pa.string() if n in ("payload_digest", "record_type", "url") else pa.int64()) for n, c in zip(names, cols, strict=True)], [id_col, *names[1:]])
        reader.close()

    return keys.mapInArrow(look, f"`{id_col}` long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def archive_and_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None) -> DataFrame:
    """Writes ``pages`` as archives with their index into the shared folder and reads every record back through the index.

    One row per row of ``pages``: page_id, payload_bytes, payload_digest, record_type, refers_to, url. Extra columns are
    ignored, whatever their names; an empty table gives none.
    """
    folder = folder or shared_dir(pages.sparkSession, "warc")
    return read_back(pages, build_index(write_archives(pages, folder, id_col, url_col, html_col), folder), id_col, url_col)
