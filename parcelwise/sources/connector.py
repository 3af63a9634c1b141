"""A warehouse connector: tables behind a format name, by the Python Data Source API.

``register(spark)`` makes the format ``parcelwise_table`` known to a session;
``read_table(fmt=)`` and ``publish_table(fmt=)`` then work as with any other
connector. A table is a folder ``{warehouse}/{table}``: Parquet files below
``data`` and one small file per commit below ``log``.

- Writing: every task writes files of its own, at most FILE_BYTES each, under
  names that no other attempt has; the driver then writes one log entry that
  names the files of the attempts that succeeded. Files that no entry names
  are no part of the table, so a failed or repeated attempt adds no row, and a
  failed job changes nothing (its files are removed where they are known).
- An overwrite is an entry that starts the table anew, so readers see the old
  rows or the new ones. Entries are ordered by their name (time, then a random
  id). Appends of several jobs all stay; of two overwrites the later one does.
- Reading: a table is planned from its log; files whose value ranges exclude a
  filter are left out, small ones share a partition, and Parquet skips row
  groups inside. Comparisons, IN, IS NULL, prefixes and negations on whole
  numbers, text, booleans, dates and decimals are pushed and not run again by
  Spark; anything else stays with Spark.
- Columns: the API does not tell a reader which columns a query uses, so
  option ``columns`` (names with commas) names them; all by default.

The log entries of a table are read on the driver: one line per file, so its
size follows the number of files (of up to 256 MB), not the rows. The folder
is reached through ``pyarrow.fs``, so it must lie on one of its stores.
"""

from __future__ import annotations

import contextlib
import datetime
import decimal
import json
import time
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import types as T

FORMAT = "parcelwise_table"
#: Bytes after which a task starts its next file, and bytes that one reading task is given.
FILE_BYTES = 256 << 20
SPLIT_BYTES = 128 << 20
#: Most rows of a row group and of a batch that a task holds at once.
BATCH_ROWS = 10_000
#: Types whose order and equality are the same in Spark and Arrow.
COMPARABLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.BooleanType, T.DateType, T.DecimalType)


def register(spark: SparkSession) -> str:
    """Make the format known to this session and let Spark hand it filters; returns the format's name."""
    spark.dataSource.register(WarehouseTable)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return FORMAT


@dataclass
class Folder:
    """A table's folder; opened anew in every process."""

    uri: str

    def store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.uri)

    def entries(self) -> list[dict]:
        """The log from its last overwrite on."""
        store, base = self.store()
        found = store.get_file_info(fs.FileSelector(f"{base}/log", allow_not_found=True))
        kept: list[dict] = []
        for info in sorted((i for i in found if i.base_name.endswith(".json")), key=lambda i: i.base_name, reverse=True):
            with store.open_input_stream(info.path) as f:
                kept.insert(0, json.loads(f.read()))
            if kept[0]["overwrite"]:
                break
        return kept

    def commit(self, entry: dict) -> None:
        """Add one log entry; it appears whole or not at all."""
        store, base = self.store()
        store.create_dir(f"{base}/log", recursive=True)
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        with store.open_output_stream(f"{base}/log/{name}.part") as f:
            f.write(json.dumps(entry).encode())
        store.move(f"{base}/log/{name}.part", f"{base}/log/{name}.json")


def _plain(value):
    """A value of a range as JSON holds it."""
    if isinstance(value, (datetime.date, decimal.Decimal)):
        return str(value)
    return value


def _typed(value, kind: T.DataType):
    if value is None:
        return None
    if isinstance(kind, T.DateType):
        return datetime.date.fromisoformat(value)
    return decimal.Decimal(value) if isinstance(kind, T.DecimalType) else value


class Ranges:
    """Smallest and largest value and number of nulls per comparable column of a file, gathered as it is written."""

    def __init__(self, schema: T.StructType) -> None:
        self.columns = [f.name for f in schema.fields if isinstance(f.dataType, COMPARABLE)]
        self.seen: dict[str, list] = {c: [None, None, 0] for c in self.columns}

    def add(self, batch: pa.RecordBatch) -> None:
        for name in self.columns:
            values = batch.column(name)
            low, high, nulls = self.seen[name]
            nulls += values.null_count
            if values.null_count < len(values):
                found = pc.min_max(values)
                a, b = found["min"].as_py(), found["max"].as_py()
                low, high = (a, b) if low is None else (min(low, a), max(high, b))
            self.seen[name] = [low, high, nulls]

    def plain(self) -> dict[str, list]:
        return {c: [_plain(low), _plain(high), nulls] for c, (low, high, nulls) in self.seen.items()}


@dataclass
class Written(D.WriterCommitMessage):
    """What one task attempt has written."""

    files: list[dict]


class TableWriter(D.DataSourceArrowWriter):
    def __init__(self, folder: Folder, schema: T.StructType, overwrite: bool) -> None:
        self.folder, self.schema, self.overwrite = folder, schema, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = self.folder.store()
        store.create_dir(f"{base}/data", recursive=True)
        done: list[dict] = []
        path = out = sink = ranges = None
        rows = 0

        def close() -> None:
            nonlocal out
            out.close()
            sink.close()
            size = store.get_file_info(path).size
            done.append({"name": path.rsplit("/", 1)[1], "rows": rows, "bytes": size, "ranges": ranges.plain()})
            out = None

        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    path, rows, ranges = f"{base}/data/{uuid.uuid4().hex}.parquet", 0, Ranges(self.schema)
                    sink = store.open_output_stream(path)
                    out = pq.ParquetWriter(sink, batch.schema, compression="zstd")
                out.write_batch(batch, row_group_size=BATCH_ROWS)
                ranges.add(batch)
                rows += batch.num_rows
                if sink.tell() >= FILE_BYTES:
                    close()
            if out is not None:
                close()
        except BaseException:
            for opened in (out, sink):
                with contextlib.suppress(Exception):
                    opened.close()
            self._remove([f["name"] for f in done] + ([path.rsplit("/", 1)[1]] if path else []))
            raise
        return Written(done)

    def _remove(self, names: Iterable[str]) -> None:
        store, base = self.folder.store()
        for name in set(names):
            with contextlib.suppress(OSError):
                store.delete_file(f"{base}/data/{name}")

    def commit(self, messages: list[D.WriterCommitMessage | None]) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        self.folder.commit({"overwrite": self.overwrite, "schema": self.schema.json(), "files": files})

    def abort(self, messages: list[D.WriterCommitMessage | None]) -> None:
        self._remove(f["name"] for m in messages if m is not None for f in m.files)


def condition(wanted: D.Filter, schema: T.StructType) -> pc.Expression | None:
    """A pushed filter as an Arrow expression; None where the two might differ."""
    if isinstance(wanted, D.Not):
        inner = condition(wanted.child, schema)
        return None if inner is None else ~inner
    path = wanted.attribute
    if len(path) != 1 or path[0] not in schema.fieldNames() or not isinstance(schema[path[0]].dataType, COMPARABLE):
        return None
    column = pc.field(path[0])
    match wanted:
        case D.EqualTo():
            return column == wanted.value
        case D.GreaterThan():
            return column > wanted.value
        case D.GreaterThanOrEqual():
            return column >= wanted.value
        case D.LessThan():
            return column < wanted.value
        case D.LessThanOrEqual():
            return column <= wanted.value
        case D.In() if all(v is not None for v in wanted.value):
            # isin has no null result, so a negated IN would keep nulls: compare one by one
            found = pc.scalar(False)
            for v in wanted.value:
                found = found | (column == v)
            return found
        case D.IsNull():
            return column.is_null()
        case D.IsNotNull():
            return column.is_valid()
        case D.StringStartsWith():
            return pc.starts_with(column, wanted.value)
    return None


def excluded(file: dict, wanted: D.Filter, schema: T.StructType) -> bool:
    """True if a file's value ranges show that no row of it passes a (pushed) filter."""
    if isinstance(wanted, D.Not) or wanted.attribute[0] not in file["ranges"]:
        return False
    low, high, nulls = file["ranges"][wanted.attribute[0]]
    kind = schema[wanted.attribute[0]].dataType
    low, high = _typed(low, kind), _typed(high, kind)
    if isinstance(wanted, D.IsNull):
        return nulls == 0
    if low is None:  # nulls only
        return True
    match wanted:
        case D.EqualTo():
            return not low <= wanted.value <= high
        case D.In():
            return not any(low <= v <= high for v in wanted.value)
        case D.GreaterThan():
            return high <= wanted.value
        case D.GreaterThanOrEqual():
            return high < wanted.value
        case D.LessThan():
            return low >= wanted.value
        case D.LessThanOrEqual():
            return low > wanted.value
    return False


@dataclass
class Files(D.InputPartition):
    """Files that one task reads."""

    names: list[str]


class TableReader(D.DataSourceReader):
    def __init__(self, folder: Folder, schema: T.StructType, entries: list[dict]) -> None:
        self.folder, self.schema, self.entries = folder, schema, entries
        self.filters: list[D.Filter] = []

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:
        for wanted in filters:
            if condition(wanted, self.schema) is None:
                yield wanted
            else:
                self.filters.append(wanted)

    def planned(self) -> list[dict]:
        """The files that the filters leave."""
        files = [f for e in self.entries for f in e["files"]]
        return [f for f in files if not any(excluded(f, w, self.schema) for w in self.filters)]

    def partitions(self) -> list[D.InputPartition]:
        found: list[Files] = []
        size = SPLIT_BYTES
        for file in self.planned():
            if size + file["bytes"] > SPLIT_BYTES:
                found.append(Files([]))
                size = 0
            found[-1].names.append(file["name"])
            size += file["bytes"]
        self.entries = []  # tasks get their own files only
        return found or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        if not partition.names:
            return
        store, base = self.folder.store()
        wanted = None
        for pushed in self.filters:
            one = condition(pushed, self.schema)
            wanted = one if wanted is None else wanted & one
        # one row group at a time, nothing read ahead: what a task holds does not grow with its files
        for name in partition.names:
            found = ds.dataset(f"{base}/data/{name}", format=ds.ParquetFileFormat(pre_buffer=False), filesystem=store)
            for fragment in found.get_fragments(filter=wanted):
                for group in fragment.split_by_row_group(filter=wanted, schema=found.schema):
                    batches = group.to_batches(schema=found.schema, columns=self.schema.fieldNames(), filter=wanted, batch_size=BATCH_ROWS,
                                               batch_readahead=0, fragment_readahead=0, use_threads=False)
                    yield from (b for b in batches if b.num_rows)


class WarehouseTable(D.DataSource):
    """Options: ``warehouse`` (a folder or URI), ``table`` (its name) and, for reading, ``columns``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def folder(self) -> Folder:
        return Folder(f"{self.options['warehouse'].rstrip('/')}/{self.options['table']}")

    def schema(self) -> T.StructType:
        entries = self.folder().entries()
        if not entries:
            raise ValueError(f"no table {self.options['table']} in {self.options['warehouse']}")
        known = T.StructType.fromJson(json.loads(entries[-1]["schema"]))
        wanted = [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]
        return T.StructType([known[c] for c in wanted]) if wanted else known

    def reader(self, schema: T.StructType) -> D.DataSourceReader:
        return TableReader(self.folder(), schema, self.folder().entries())

    def writer(self, schema: T.StructType, overwrite: bool) -> D.DataSourceWriter:
        if not overwrite and (entries := self.folder().entries()):
            known = T.StructType.fromJson(json.loads(entries[-1]["schema"]))
            if [(f.name, f.dataType) for f in known] != [(f.name, f.dataType) for f in schema]:
                raise ValueError(f"rows of {schema.simpleString()} cannot be appended to {known.simpleString()}")
        return TableWriter(self.folder(), schema, overwrite)
