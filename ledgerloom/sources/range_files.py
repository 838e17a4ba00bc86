"""Tables in range files: <path>/<source>/<name>/<start>-<end>.parquet, both ends inclusive.

`spark.read.format("block_ranges").load(path)` reads them with a plan-time choice of files: filters on block_number, source_name and
event_name are taken from the query, and only files whose folders fit and whose ranges overlap are opened, each by a task of its own,
of which only the row groups that overlap. Rows are filtered again by Spark. `write_range_files` writes them.

register(spark) makes the format known and turns the push-down of filters on.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StringType, StructType

_NAME = re.compile(r"(\d+)-(\d+)\.parquet")
BLOCK, SOURCE, EVENT = "block_number", "source_name", "event_name"


def open_path(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)


def overlaps(start: int, end: int, first: int | None, last: int | None) -> bool:
    """Whether a file of blocks start to end holds some of first to last (inclusive; None: open)."""
    return (first is None or end >= first) and (last is None or start <= last)


class RangeFile(InputPartition):
    def __init__(self, path: str, source: str, event: str, start: int, end: int):
        super().__init__((source, event, start))
        self.path, self.source, self.event, self.start, self.end = path, source, event, start, end


def listed(path: str) -> list[RangeFile]:
    """All range files below the path, in order."""
    files, root = open_path(path)
    out = []
    for f in files.get_file_info(pyarrow.fs.FileSelector(root, recursive=True, allow_not_found=True)):
        m = _NAME.fullmatch(f.base_name)
        if m and f.is_file:
            *_, source, event, _ = f.path.split("/")
            out.append(RangeFile(f.path, source, event, int(m.group(1)), int(m.group(2))))
    return sorted(out, key=lambda f: f.value)


class BlockRanges(DataSource):
    """Options: path (load's argument). The schema is that of the first file, if none is given, and the two names."""

    @classmethod
    def name(cls) -> str:
        return "block_ranges"

    def schema(self) -> StructType:
        found = listed(self.options["path"])
        if not found:
            raise ValueError(f"no range files below {self.options['path']}; give a schema to read none")
        files, _ = open_path(self.options["path"])
        with files.open_input_file(found[0].path) as f:
            known = from_arrow_schema(pq.read_schema(f))
        return known.add(SOURCE, StringType()).add(EVENT, StringType())

    def reader(self, schema: StructType) -> RangeReader:
        return RangeReader(self.options["path"], schema)


class RangeReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.arrow = path, to_arrow_schema(schema)
        self.first: int | None = None
        self.last: int | None = None
        self.names: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds of the blocks and the names that are asked for. Spark still applies the filters on blocks to the rows."""
        for f in filters:
            column = f.attribute if hasattr(f, "attribute") else ()
            if column == (BLOCK,) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                at = f.value + isinstance(f, GreaterThan)
                self.first = at if self.first is None else max(self.first, at)
            if column == (BLOCK,) and isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                at = f.value - isinstance(f, LessThan)
                self.last = at if self.last is None else min(self.last, at)
            if column in ((SOURCE,), (EVENT,)) and isinstance(f, (EqualTo, In)):
                asked = set(f.value) if isinstance(f, In) else {f.value}
                self.names[column[0]] = self.names.get(column[0], asked) & asked
                continue  # a file's rows have its folders' names: nothing is left to do
            yield f

    def partitions(self) -> list[RangeFile]:
        fits = lambda f: all(getattr(f, {SOURCE: "source", EVENT: "event"}[c]) in asked for c, asked in self.names.items())
        found = [f for f in listed(self.path) if fits(f) and overlaps(f.start, f.end, self.first, self.last)]
        return found or [RangeFile("", "", "", 0, -1)]

    def read(self, partition: RangeFile) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        files, _ = open_path(self.path)
        table = ds.dataset(partition.path, filesystem=files, format="parquet")
        known = [f.name for f in self.arrow if f.name in table.schema.names]
        keep = None
        for bound, test in ((self.first, lambda c, v: c >= v), (self.last, lambda c, v: c <= v)):
            if bound is not None and BLOCK in known:
                keep = test(ds.field(BLOCK), bound) if keep is None else keep & test(ds.field(BLOCK), bound)
        fixed = {SOURCE: partition.source, EVENT: partition.event}
        for b in table.to_batches(columns=known, filter=keep):
            columns = [
                b.column(f.name).cast(f.type) if f.name in known else pa.array([fixed.get(f.name)] * len(b), f.type) for f in self.arrow
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=self.arrow)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BlockRanges)


def write_range_files(rows: DataFrame, path: str, size: int) -> list[str]:
    """rows (block_number, source_name, event_name, ..) as range files of `size` blocks, and the files' names.

    A range of a name is one task's work, put to its file batch by batch under another name, which is changed when it is whole: a task
    that is run again writes the same file.
    """
    names = [c for c in rows.columns if c not in (SOURCE, EVENT)]
    arrow = to_arrow_schema(rows.select(*names).schema)
    keys = [SOURCE, EVENT, "_range"]
    dealt = rows.withColumn("_range", F.floor(F.col(BLOCK) / size)).repartition(*keys).sortWithinPartitions(*keys, BLOCK)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_path(path)
        writer, target, sink = None, None, None

        def finish() -> Iterator[pa.RecordBatch]:
            writer.close()
            sink.close()
            files.move(f"{target}.{mark}", target)
            yield pa.RecordBatch.from_arrays([pa.array([target])], names=["file"])

        mark = uuid.uuid4().hex
        for b in batches:
            key = pa.Table.from_batches([b]).select(keys).to_pylist()
            cuts = [i for i in range(len(key)) if i == 0 or key[i] != key[i - 1]]
            for lo, hi in zip(cuts, [*cuts[1:], len(key)]):
                source, event, n = (key[lo][k] for k in keys)
                name = f"{root}/{source}/{event}/{n * size}-{n * size + size - 1}.parquet"
                if name != target:
                    if writer is not None:
                        yield from finish()
                    target = name
                    files.create_dir(f"{root}/{source}/{event}", recursive=True)
                    sink = files.open_output_stream(f"{target}.{mark}")
                    writer = pq.ParquetWriter(sink, arrow)
                part = b.slice(lo, hi - lo).select(names)
                writer.write_batch(pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(part.columns, arrow)], schema=arrow))
        if writer is not None:
            yield from finish()

    return sorted(r["file"] for r in dealt.mapInArrow(write, "file string").collect())  # a name per range
