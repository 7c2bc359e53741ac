"""A data source for NPZ files: a row for each entry along an array's first axis, read in ranges by many tasks.

Reading plans partitions from the array headers alone: a file of many frames is
several partitions, and a frame is read where it lies, without the rest of its
file.  A file that cannot be read is one row with its error and stops no other.
Writing puts each task's rows into files under a temporary name; the commit
moves those of the tasks that succeeded and leaves nothing else behind.

    spark.dataSource.register(NpzSource)
    frames = spark.read.format("npz").option("array", "frames").option("ndim", 4).load(folder)
    vectors.select("id", "values").write.format("npz").mode("overwrite").save(folder)

Paths are those that every task can open: a shared file system, or a URI that
pyarrow knows.  :func:`tessella.sources.readers.read_arrays` reads whole files
through Spark itself.
"""

from __future__ import annotations

import fnmatch
import io
import json
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

#: What a range of a file holds: its place along the first axis, the shape of one entry, its numbers in row order.
SCHEMA = "path string, entry long, shape array<int>, values array<{kind}>, error string"
_KINDS = {"float": (np.float32, pa.float32()), "double": (np.float64, pa.float64()), "long": (np.int64, pa.int64())}
#: Bytes of numbers in a partition and in a batch of rows, and rows of a written file.
PARTITION_BYTES, BATCH_BYTES, FILE_ROWS = 64 << 20, 8 << 20, 10_000


def _system(path: str) -> tuple[pafs.FileSystem, str]:
    path = path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


@dataclass
class Range(InputPartition):
    path: str
    first: int
    last: int
    error: str | None = None


def _member(path: str, array: str):
    """The array's open member, its shape and type, placed at its first number."""
    system, name = _system(path)
    opened = zipfile.ZipFile(system.open_input_file(name))
    if f"{array}.npy" not in opened.namelist():
        raise ValueError(f"there is no array {array}")
    f = opened.open(f"{array}.npy")
    version = np.lib.format.read_magic(f)
    read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
    shape, fortran, dtype = read(f)
    if dtype.hasobject or dtype.kind not in "biuf":
        raise ValueError(f"{array} has no numbers")
    if fortran and len(shape) > 1:
        raise ValueError(f"{array} is in column order")
    return f, shape, dtype


class NpzReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options.get("path")
        self.pattern, self.array = options.get("pattern", "*.npz"), options.get("array", "embeddings")
        self.ndim, self.strict = int(options.get("ndim", 2)), options.get("strict", "false").lower() == "true"
        self.number, self.arrow = _KINDS[options.get("type", "float")]
        self.partition_bytes = int(options.get("partitionbytes", options.get("partitionBytes", PARTITION_BYTES)))

    def partitions(self) -> list[Range]:
        system, root = _system(self.path)
        info = system.get_file_info(root)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.is_file else system.get_file_info(pafs.FileSelector(root, recursive=True))
        scheme = self.path.split("://")[0] + "://" if "://" in self.path else ""
        out = []
        for f in sorted(found, key=lambda f: f.path):
            hidden = any(p.startswith(("_", ".")) for p in f.path.removeprefix(root).split("/"))
            if not f.is_file or hidden or not fnmatch.fnmatch(f.base_name, self.pattern):
                continue
            path = scheme + f.path
            try:
                member, shape, dtype = _member(path, self.array)
                member.close()
                if len(shape) != self.ndim:
                    raise ValueError(f"{self.array} has {len(shape)} dimensions, not {self.ndim}")
            except Exception as e:  # noqa: BLE001  what is wrong with a file is told in its row
                if self.strict:
                    raise ValueError(f"{path}: {e}") from e
                out.append(Range(path, 0, 0, str(e)))
                continue
            each = max(1, self.partition_bytes // max(1, 4 * int(np.prod(shape[1:], dtype=np.int64))))
            out += [Range(path, at, min(at + each, shape[0])) for at in range(0, shape[0], each)]
        return out or [Range("", 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        types = pa.schema([("path", pa.string()), ("entry", pa.int64()), ("shape", pa.list_(pa.int32())), ("values", pa.list_(self.arrow)), ("error", pa.string())])

        def batch(entries: list[int], shape, rows: list, error: str | None) -> pa.RecordBatch:
            n = max(len(entries), 1 if error else 0)
            return pa.RecordBatch.from_arrays(
                [pa.array([part.path] * n, pa.string()), pa.array(entries or [None] * n, pa.int64()), pa.array([list(shape)] * n if shape is not None else [None] * n, types.field("shape").type),
                 pa.array(rows or [None] * n, types.field("values").type), pa.array([error] * n, pa.string())], schema=types,
            )

        if part.error:
            yield batch([], None, [], part.error)
            return
        if part.first >= part.last:
            return
        at, entries, rows = part.first, [], []
        try:
            member, shape, dtype = _member(part.path, self.array)
            size = int(np.prod(shape[1:], dtype=np.int64)) * dtype.itemsize
            member.seek(member.tell() + at * size)
            while at < part.last:
                data = member.read(size)
                if len(data) != size:
                    raise ValueError(f"{self.array} ends in entry {at}")
                entries.append(at)
                rows.append(np.frombuffer(data, dtype).astype(self.number))
                at += 1
                if len(rows) * size >= BATCH_BYTES:
                    yield batch(entries, shape[1:], rows, None)
                    entries, rows = [], []
        except Exception as e:  # noqa: BLE001
            if self.strict:
                raise ValueError(f"{part.path}: {e}") from e
            if rows:
                yield batch(entries, shape[1:], rows, None)
            yield batch([], None, [], str(e))
            return
        if rows:
            yield batch(entries, shape[1:], rows, None)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class NpzWriter(DataSourceWriter):
    """Files of ``embeddings`` (rows of equal length) and ``ids``, and a list of them with their rows."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex
        self.rows = int(options.get("filerows", options.get("fileRows", FILE_ROWS)))

    def write(self, rows: Iterator) -> Written:
        system, root = _system(self.path)
        system.create_dir(f"{root}/_temporary-{self.job}", recursive=True)
        files: list[tuple[str, int]] = []
        ids, values = [], []

        def flush() -> None:
            data, name = io.BytesIO(), f"{uuid.uuid4().hex}.npz"
            np.savez_compressed(data, embeddings=np.array(values, np.float32).reshape(len(values), -1), ids=np.array(ids, np.int64))
            with system.open_output_stream(f"{root}/_temporary-{self.job}/{name}") as out:
                out.write(data.getvalue())
            files.append((name, len(ids)))
            ids.clear()
            values.clear()

        for r in rows:
            if r["id"] is None or r["values"] is None:
                raise ValueError("a row without an id or without values cannot be written")
            if values and len(values[0]) != len(r["values"]):
                raise ValueError(f"row {r['id']} has {len(r['values'])} values, not {len(values[0])}")
            ids.append(r["id"])
            values.append(r["values"])
            if len(ids) == self.rows:
                flush()
        if ids:
            flush()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _system(self.path)
        system.create_dir(root, recursive=True)
        old = [f.path for f in system.get_file_info(pafs.FileSelector(root)) if f.is_file and f.base_name.endswith(".npz")] if self.overwrite else []
        listed = []
        for i, (name, n) in enumerate(f for m in messages if m for f in m.files):
            system.move(f"{root}/_temporary-{self.job}/{name}", f"{root}/part-{i:05}-{self.job}.npz")
            listed.append({"file": f"part-{i:05}-{self.job}.npz", "rows": n})
        for f in old:
            system.delete_file(f)
        with system.open_output_stream(f"{root}/_files.json") as out:
            out.write(json.dumps(listed).encode())
        self._clear(system, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*_system(self.path))

    def _clear(self, system: pafs.FileSystem, root: str) -> None:
        """What attempts left that did not count."""
        if system.get_file_info(f"{root}/_temporary-{self.job}").type == pafs.FileType.Directory:
            system.delete_dir(f"{root}/_temporary-{self.job}")


class NpzSource(DataSource):
    """Options: ``array``, ``ndim``, ``type`` (of ``values``: float, double or long), ``pattern``, ``partitionBytes``, ``strict`` to read; ``fileRows`` to write ``id, values``."""

    @classmethod
    def name(cls) -> str:
        return "npz"

    def schema(self) -> str:
        return SCHEMA.format(kind=self.options.get("type", "float"))

    def reader(self, schema: StructType) -> NpzReader:
        return NpzReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> NpzWriter:
        if not {"id", "values"} <= set(schema.names):
            raise ValueError("the columns id and values are written")
        return NpzWriter(dict(self.options), overwrite)
