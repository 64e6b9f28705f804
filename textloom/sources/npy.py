"""``.npy`` shards as a Spark data source (S6): ``spark.read.format("npy_shards")`` and ``df.write.format("npy_shards")``.

A file is a one-dimensional array of ``uint16`` ids named ``{name}_{split}_{shard:06d}.npy``.

Reading: the folder is listed once, every file is cut into ranges of whole chunks by its size, and ranges are put together
to input partitions of about equal size (small files share one). A task reads a file's header and then its own bytes, a few
megabytes at a time, as Arrow batches.

Writing: rows (split, shard, chunk, tokens, shard_tokens), each shard whole in one task and in chunk order. The length in
the header comes with the rows. Tasks write into a staging folder of the job; files get their names only in the commit,
after every task has succeeded, so a failed job or a lost attempt leaves nothing behind under a shard's name. A shard
whose rows are out of order, split over tasks or of another length than announced is an error, as are nulls and ids
outside [0, 65536).
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from textloom.session import ship_package

FORMAT = "npy_shards"
DTYPE = "<u2"  # little-endian uint16, as the reference's shard files
SCHEMA = "split string, shard long, chunk_in_shard long, tokens array<int>"
CHUNK_SIZE = 62_500
#: Bytes that one input partition covers, what opening a file counts as, and ids in an Arrow batch.
PARTITION_BYTES = 128 << 20
OPEN_BYTES = 4 << 20
BATCH_IDS = 4 << 20


def header(n: int) -> bytes:
    """Version 1.0 header of a one-dimensional array of ``n`` ids."""
    d = "{'descr': '%s', 'fortran_order': False, 'shape': (%d,), }" % (DTYPE, n)
    pad = 64 - (10 + len(d) + 1) % 64
    body = (d + " " * pad + "\n").encode("latin1")
    return b"\x93NUMPY\x01\x00" + len(body).to_bytes(2, "little") + body


def read_header(fh, path: str) -> tuple[int, int]:
    """(bytes before the first id, number of ids) of an open file."""
    start = fh.read(12)
    if start[:6] != b"\x93NUMPY":
        raise ValueError(f"{path} is no .npy file")
    size = 2 if start[6] == 1 else 4  # the length of the header has four bytes from version 2.0 on
    length = int.from_bytes(start[8:8 + size], "little")
    fh.seek(8 + size)
    text = fh.read(length).decode("latin1")
    shape = re.search(r"'shape': \((\d+),\)", text)
    if f"'{DTYPE}'" not in text or shape is None:
        raise ValueError(f"{path} does not hold one row of {DTYPE} ids: {text.strip()}")
    return 8 + size + length, int(shape.group(1))


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path inside it) of a local path, a ``file:`` URI or any URI that pyarrow knows."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), urlparse(path).path
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), os.path.abspath(path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme Spark itself would take for it, so that driver and executors mean the same folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def shard_of(path: str) -> tuple[str, int]:
    found = re.search(r"_([^_/]+)_(\d+)\.npy$", path)
    if found is None:
        raise ValueError(f"not the name of a shard file: {path}")
    return found.group(1), int(found.group(2))


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, and the package to its Python workers."""
    ship_package(spark)
    spark.dataSource.register(NpyShards)


class NpyShards(DataSource):
    """Options: ``path``; for reading ``chunk_size`` (ids a row), ``partition_bytes``; for writing ``name``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        o = self.options
        return Reader(o["path"], int(o.get("chunk_size", CHUNK_SIZE)), int(o.get("partition_bytes", PARTITION_BYTES)))

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], self.options.get("name", "corpus"), schema.fieldNames(), overwrite)


@dataclass
class Ranges(InputPartition):
    """Files with their chunks ``lo`` up to ``hi``."""

    parts: list[tuple[str, int, int]]


class Reader(DataSourceReader):
    def __init__(self, path: str, chunk_size: int, partition_bytes: int):
        if chunk_size < 1:
            raise ValueError(f"chunk_size must be positive, got {chunk_size}")
        self.path, self.chunk_size, self.partition_bytes = path, chunk_size, partition_bytes
        self.step = max(1, partition_bytes // (2 * chunk_size))

    def partitions(self) -> list[Ranges]:
        fs, base = file_system(self.path)
        files = [i for i in fs.get_file_info(pafs.FileSelector(base)) if i.type == pafs.FileType.File and i.path.endswith(".npy")]
        out, room = [], 0
        for i in sorted(files, key=lambda i: i.path):
            most = -(-i.size // (2 * self.chunk_size))  # the header counts as ids here: at most one range without rows
            for lo in range(0, most, self.step):
                cost = min(2 * self.chunk_size * self.step, i.size - 2 * self.chunk_size * lo) + min(OPEN_BYTES, self.partition_bytes)
                if cost > room:
                    out.append(Ranges([]))
                    room = self.partition_bytes
                out[-1].parts.append((i.path, lo, lo + self.step))
                room -= cost
        return out

    def read(self, partition: Ranges | None) -> Iterator[pa.RecordBatch]:
        for path, lo, hi in partition.parts if partition is not None else ():  # None: an empty folder
            yield from self._read(path, lo, hi)

    def _read(self, path: str, first_chunk: int, last_chunk: int) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.path)
        split, shard = shard_of(path)
        with fs.open_input_file(path) as fh:
            first, n = read_header(fh, path)
            c = self.chunk_size
            last = min(last_chunk, -(-n // c))
            step = max(1, BATCH_IDS // c)
            for lo in range(first_chunk, last, step):
                hi = min(lo + step, last)
                fh.seek(first + 2 * c * lo)
                ids = np.frombuffer(fh.read(2 * (min(c * hi, n) - c * lo)), DTYPE).astype(np.int32)
                if len(ids) != min(c * hi, n) - c * lo:
                    raise ValueError(f"{path} ends before its {n} ids")
                ends = np.minimum(np.arange(hi - lo + 1) * c, len(ids)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([split] * (hi - lo)), pa.array([shard] * (hi - lo), pa.int64()), pa.array(np.arange(lo, hi, dtype=np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], ["split", "shard", "chunk_in_shard", "tokens"])


@dataclass
class Staged(WriterCommitMessage):
    """Files of one successful task: where they are and what they are to be called."""

    files: list[tuple[str, str]]


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, name: str, columns: list[str], overwrite: bool):
        missing = {"split", "shard", "chunk", "tokens", "shard_tokens"} - set(columns)
        if missing:
            raise ValueError(f"columns are missing: {sorted(missing)}")
        self.path, self.name, self.overwrite = path, name, overwrite
        self.staging = f"_staging-{uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        fs, base = file_system(self.path)
        folder = f"{base}/{self.staging}"
        fs.create_dir(folder, recursive=True)
        done, now, fh, left, before = [], None, None, 0, None

        def close():
            fh.close()
            if left:
                raise ValueError(f"shard {now} lacks {left} of its announced ids")

        for b in iterator:
            cols = {k: b.column(b.schema.get_field_index(k)) for k in ("split", "shard", "chunk", "tokens", "shard_tokens")}
            if any(c.null_count for c in cols.values()):
                raise ValueError("a row of a shard holds a null")
            keys = zip(*(cols[k].to_pylist() for k in ("split", "shard", "chunk", "shard_tokens")))
            for i, (split, shard, chunk, total) in enumerate(keys):
                if (split, shard) != now:
                    if fh is not None:
                        close()
                    now, left, before = (split, shard), total, None
                    staged = f"{folder}/{uuid4().hex}"
                    done.append((staged, f"{base}/{self.name}_{split}_{shard:06d}.npy"))
                    fh = fs.open_output_stream(staged)
                    fh.write(header(total))
                ids = cols["tokens"][i].values
                left -= len(ids)
                if ids.null_count or left < 0 or (before is not None and chunk <= before):
                    raise ValueError(f"shard {now}: a null id, more ids than announced, or chunks out of order")
                x = ids.to_numpy(zero_copy_only=False)
                if len(x) and (x.min() < 0 or x.max() > 0xFFFF):
                    raise ValueError(f"shard {now} holds ids outside [0, 65536)")
                fh.write(x.astype(DTYPE).tobytes())
                before = chunk
        if fh is not None:
            close()
        return Staged(done)

    def commit(self, messages: list[Staged | None]) -> None:
        fs, base = file_system(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        names = [final for _, final in files]
        if len(set(names)) < len(names):
            self._clear(fs, base)
            raise ValueError("rows of one shard came to several tasks")
        fs.create_dir(base, recursive=True)
        if self.overwrite:
            for i in fs.get_file_info(pafs.FileSelector(base)):
                if i.type == pafs.FileType.File and i.path.endswith(".npy") and i.path not in names:
                    fs.delete_file(i.path)
        for staged, final in files:
            fs.move(staged, final)
        self._clear(fs, base)

    def abort(self, messages: list[Staged | None]) -> None:
        self._clear(*file_system(self.path))

    def _clear(self, fs: pafs.FileSystem, base: str) -> None:
        """The job's own staging folder goes, with what lost attempts left in it."""
        folder = f"{base}/{self.staging}"
        if fs.get_file_info(folder).type != pafs.FileType.NotFound:
            fs.delete_dir(folder)
