"""Shared helpers: the cluster's shared folder, Arrow text buffers, vectorised hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators.names import unused  # noqa: F401
from factloom.session import discard, shared_dir, ship, written  # noqa: F401

#: odd multipliers of the vectorised hashes
K1, K2, K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a URI, usable on the driver and on executors."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


#: tables that operators keep in a Python worker between tasks
KEPT_TABLES: list[dict] = []


def trim(release: bool = False) -> None:
    """Gives memory that earlier tasks of this Python worker have freed back to the system.

    ``release``: tables kept for tasks of other operators go as well; these build them anew when they come again.
    """
    import ctypes

    if release:
        for kept in KEPT_TABLES:
            kept.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps what it keeps
        pass


def tidy(work, release: bool = False):
    """``work`` (a function of the batches of a task, or of a group's key and table) so that its Python worker gives freed
    memory back before and after it: idle workers count, too. ``release``: see ``trim``."""

    def batches_run(batches):
        trim(release)
        yield from work(batches)
        trim()

    def group_run(key, tab):
        trim(release)
        out = work(key, tab)
        trim()
        return out

    return group_run if work.__code__.co_argcount == 2 else batches_run


def if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Broadcast only if the counted ``rows`` are within ``limit``; otherwise the join shuffles."""
    return F.broadcast(df) if rows <= limit else df


def crc32_mod(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n: the folds of the fixed contracts."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(n)


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary array without decoding; a null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, offs, data = arr.buffers()
    if offs is None or len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A finalising bit mixer over uint64 (in place)."""
    h ^= h >> np.uint64(30)
    h *= K2
    h ^= h >> np.uint64(27)
    h *= K3
    h ^= h >> np.uint64(31)
    return h


_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i modulo 2^64, i < n."""
    if "p" not in _POW or len(_POW["p"]) < n:
        size = max(n, 1 << 20)
        base, inv = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
        for key, b in (("p", base), ("q", inv)):
            full = np.full(size, b, np.uint64)
            full[0] = 1
            _POW[key] = np.multiply.accumulate(full)
    return _POW["p"][:n], _POW["q"][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans data[start:end]; equal bytes give equal hashes wherever they lie."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    p, q = _powers(len(data) + 1)
    c = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:-1], out=c[1:])
    h = (c[ends] - c[starts]) * q[starts]
    h += (ends - starts).astype(np.uint64) * K1
    return mix(h)
