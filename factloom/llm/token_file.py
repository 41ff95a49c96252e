"""Token-ID files: ids of documents in ascending id order, Simple-8b coded, with block and document tables.

Layout (little endian): magic, the coded words of all blocks, the block table (first word of each block and the
end, uint64), the document table (id int64, null flag uint8, first id uint64), then a tail of fixed size: words,
blocks, documents, ids as uint64 and the magic again. A reader takes the tail, then the tables, then only the
blocks it wants.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm import simple8b
from factloom.llm.common import filesystem, shared_dir, ship, trim
from factloom.llm.tokens import encoder, groups

MAGIC = b"FLTOKID1"


#: ids that are coded together
STEP = 128 * simple8b.BLOCK


class TokenWriter:
    """Writes one file as documents come; it gets its name when it is complete (renamed from the attempt's own)."""

    def __init__(self, uri: str, attempt: str):
        self.fs, self.path = filesystem(uri)
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.part = f"{self.path}.{attempt}"
        self.f = self.fs.open_output_stream(self.part, compression=None)
        self.f.write(MAGIC)
        self.doc_ids, self.starts, self.first, self.held, self.n_held, self.total = [], [], [np.zeros(1, np.int64)], [], 0, 0

    def add(self, doc_ids: list, bounds: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.starts.append(bounds[:-1] + self.total)
        self.total += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= STEP:
            self._code(False)

    def _code(self, last: bool) -> None:
        ids = np.concatenate([np.zeros(0, np.uint32), *self.held])
        done = 0
        while len(ids) - done >= STEP or last and done < len(ids):
            words, first = simple8b.encode(ids[done : done + STEP])
            self.f.write(words.tobytes())
            self.first.append(first[1:] + self.first[-1][-1])
            done += STEP
        self.held, self.n_held = [ids[done:]], max(0, len(ids) - done)

    def close(self) -> int:
        """Writes the rest and the tables; the number of ids."""
        self._code(True)
        first, docs = np.concatenate(self.first), self.doc_ids
        null = np.array([x is None for x in docs], np.uint8)
        starts = np.concatenate([np.zeros(0, np.int64), *self.starts])
        for part in (first.astype(np.uint64), np.array([x or 0 for x in docs], np.int64), null, starts.astype(np.uint64), np.array([first[-1], len(first), len(docs), self.total], np.uint64)):
            self.f.write(part.tobytes())
        self.f.write(MAGIC)
        self.f.close()
        self.fs.move(self.part, self.path)
        return self.total


@dataclass
class TokenFile:
    """An open file: its tables in memory, ids decoded on demand."""

    handle: object
    first: np.ndarray
    doc_ids: np.ndarray
    null: np.ndarray
    starts: np.ndarray
    total: int

    @classmethod
    def open(cls, uri: str) -> TokenFile:
        fs, path = filesystem(uri)
        f = fs.open_input_file(path)
        size = f.size()
        f.seek(size - 40)
        tail = f.read(40)
        words, n_first, docs, total = (int(x) for x in np.frombuffer(tail[:32], np.uint64))
        if tail[32:] != MAGIC:
            raise ValueError(f"{uri} is no token file")
        f.seek(8 + 8 * words)
        first = np.frombuffer(f.read(8 * n_first), np.uint64).astype(np.int64)
        ids = np.frombuffer(f.read(8 * docs), np.int64)
        null = np.frombuffer(f.read(docs), np.uint8)
        starts = np.frombuffer(f.read(8 * docs), np.uint64).astype(np.int64)
        return cls(f, first, ids, null, np.append(starts, total), total)

    def ids(self, a: int, b: int) -> np.ndarray:
        """Ids a..b of the file; only the blocks that hold them are read and decoded."""
        if a >= b:
            return np.zeros(0, np.uint32)
        p, q = a // simple8b.BLOCK, -(-b // simple8b.BLOCK)
        self.handle.seek(8 + 8 * int(self.first[p]))
        words = np.frombuffer(self.handle.read(8 * int(self.first[q] - self.first[p])), np.uint64)
        start = p * simple8b.BLOCK
        got = simple8b.decode(words, self.first[p : q + 1] - self.first[p], min(self.total, q * simple8b.BLOCK) - start)
        return got[a - start : b - start].astype(np.uint32)


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) in ascending id order over the partitions; equal ids by text."""
    t = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return t.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end: int = 0) -> list[tuple[str, int]]:
    """Writes one file for each partition; returns (uri, ids before the file) in ascending id order.

    A null text has only the end id; null ids come first. The list has an entry for each file, not each document.
    """
    ship(docs.sparkSession)
    folder = folder or shared_dir(docs.sparkSession, "tokens")

    def write(batches):
        trim()
        enc, task, out, uri = encoder(tokenizer), TaskContext.get(), None, f"{folder}/part-{TaskContext.get().partitionId():06d}.ids"
        for b in batches:
            if out is None and b.num_rows:
                out = TokenWriter(uri, f"tmp-{task.taskAttemptId()}")
            names, texts = b.column(0).to_pylist(), b.column(1)
            for i, j in groups(texts):
                ids, bounds = enc.encode(texts.slice(i, j - i), end)
                out.add(names[i:j], bounds, ids)
        if out is not None:
            yield pa.record_batch([pa.array([task.partitionId()]), pa.array([uri]), pa.array([out.close()])], ["part", "uri", "n"])

    rows = sorted((r["part"], r["uri"], r["n"]) for r in in_order(docs, id_col, text_col).mapInArrow(write, "part long, uri string, n long").collect())
    before = np.concatenate([[0], np.cumsum([r[2] for r in rows], dtype=np.int64)]) if rows else [0]
    return [(r[1], int(k)) for r, k in zip(rows, before, strict=False)]


def read_tokens(spark, files: list[tuple[str, int]], id_col: str = "doc_id") -> DataFrame:
    """One row per document of the files: id, start, n_tokens, ids_crc32."""
    ship(spark)

    def read(batches):
        for b in batches:
            for uri, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                f = TokenFile.open(uri)
                step = 1 << 20  # ids decoded at once, more for a longer document
                i, n = 0, len(f.doc_ids)
                while i < n:
                    j = max(i + 1, int(np.searchsorted(f.starts, f.starts[i] + step, "right")) - 1)
                    own, at = f.ids(int(f.starts[i]), int(f.starts[j])), f.starts[i : j + 1] - f.starts[i]
                    crc = [zlib.crc32(own[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]
                    yield pa.record_batch([pa.array(f.doc_ids[i:j], mask=f.null[i:j].astype(bool)), pa.array(f.starts[i:j] + before), pa.array(np.diff(at)), pa.array(crc, pa.int64())], [id_col, "start", "n_tokens", "ids_crc32"])
                    i = j

    df = spark.createDataFrame(files, "uri string, before long")
    return df.repartition(max(1, len(files)), F.col("uri")).mapInArrow(read, f"{id_col} long, start long, n_tokens long, ids_crc32 long")
