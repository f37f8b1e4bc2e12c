"""Streams over given tables, which may be one file or a folder of files."""

import pytest
from pyspark.sql import functions as F

from ridgeline.workloads import QUERIES
from ridgeline.workloads.registry import arriving

ROWS = [(i, [float((i * 7 + j) % 11) / 11 for j in range(64)], i % 3) for i in range(60)]


@pytest.mark.parametrize("files", [1, 3])
def test_score_of_a_folder(spark, df, tmp_path, files):
    rows = df(ROWS, "vec_id long, embedding array<float>, label int")
    rows.repartition(files).write.parquet(f"{tmp_path}/embeddings.parquet")
    made = {r.subject_id: r.prediction for r in QUERIES["stream_score"](spark, str(tmp_path)).collect()}
    want = {r.subject_id: r.prediction for r in QUERIES["score_table"](spark, str(tmp_path)).collect()}
    assert len(made) == 60 and made == want


def test_one_file_and_other_tables_beside_it(spark, df, tmp_path):
    df([(1,)], "n int").coalesce(1).write.parquet(str(tmp_path / "made"))
    (part,) = (tmp_path / "made").glob("part-*.parquet")
    for name in ("events.parquet", "other.parquet", "events.parquet.old"):
        (tmp_path / name).write_bytes(part.read_bytes())
    sink = str(tmp_path / "out")
    stream = arriving(spark, str(tmp_path), "events").withColumn("m", F.col("n") + 1)
    stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(sink).collect()] == [(1, 2)]
