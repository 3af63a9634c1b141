"""What a connector task holds at once does not grow with its files."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import types as T

from parcelwise.sources import connector as CN

SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])


def test_row_groups_and_read_ahead_are_bounded(tmp_path):
    folder = CN.Folder(f"{tmp_path.as_uri()}/t")
    rows = pa.RecordBatch.from_pydict({"n": list(range(25_000)), "s": [str(i) for i in range(25_000)]})
    written = CN.TableWriter(folder, SCHEMA, True).write(iter([rows, rows]))
    names = [f["name"] for f in written.files]
    meta = pq.ParquetFile(tmp_path / "t" / "data" / names[0]).metadata
    assert all(meta.row_group(g).num_rows <= CN.BATCH_ROWS for g in range(meta.num_row_groups))
    reader = CN.TableReader(folder, SCHEMA, [])
    got = list(reader.read(CN.Files(names)))
    assert max(b.num_rows for b in got) <= CN.BATCH_ROWS and sum(b.num_rows for b in got) == 50_000
    assert sorted(v for b in got for v in b.column(0).to_pylist()) == sorted(2 * list(range(25_000)))
