"""Splits, batches, caps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.operators import splits as sp
from ridgeline.workloads.adapters import FILES_SQL, files, split_sql
from ridgeline.workloads.registry import query, table

BATCH = 64


@query(f"WITH {split_sql('events', 'event_id')} SELECT event_id, split FROM parts")
def exact_split(spark, sf):
    return sp.exact_split(table(spark, sf, "events"), "event_id").select("event_id", "split")


@query(f"""WITH {split_sql('(SELECT DISTINCT user_id FROM events)', 'user_id')}
SELECT event_id, split FROM events JOIN parts USING (user_id)""")
def grouped_split(spark, sf):
    return sp.grouped_split(table(spark, sf, "events"), "user_id").select("event_id", "split")


@query(f"""WITH {split_sql('events', 'event_id')},
placed AS (SELECT event_id, row_number() OVER (ORDER BY md5('42:1:' || event_id)) - 1 AS i, count(*) OVER () AS n
  FROM parts WHERE split = 'train')
SELECT event_id, i // {BATCH} AS batch_id FROM placed WHERE i // {BATCH} < n // {BATCH}""")
def batch_assign(spark, sf):
    train = sp.exact_split(table(spark, sf, "events"), "event_id").where("split = 'train'")
    return sp.assign_batches(train, "event_id", BATCH, epoch=1, drop_last=True).select(
        "event_id", "batch_id"
    )


_ORDERED = f"""{split_sql('events', 'event_id')},
placed AS (SELECT event_id, split,
  (row_number() OVER (PARTITION BY split ORDER BY md5('42:' || event_id)) - 1) // {BATCH} AS batch_id
  FROM parts)"""


def _ordered(spark, sf):
    parts = sp.exact_split(table(spark, sf, "events"), "event_id").select("event_id", "split")
    return sp.assign_batches(parts, "event_id", BATCH, within=["split"])


@query(f"WITH {_ORDERED} SELECT event_id, split, batch_id FROM placed")
def batch_ordered(spark, sf):
    return _ordered(spark, sf)


@query(f"""WITH {_ORDERED} SELECT split, batch_id, count(*) AS n,
  string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS event_ids FROM placed GROUP BY split, batch_id""")
def collate(spark, sf):
    batches = sp.collate(_ordered(spark, sf), ["split", "batch_id"], "event_id")
    ids = F.array_join(F.transform("rows", lambda r: r["event_id"].cast("string")), ",")
    return batches.select("split", "batch_id", "n", ids.alias("event_ids"))


@query(f"WITH {FILES_SQL} SELECT name FROM files WHERE modality = 'iris' ORDER BY name LIMIT 500")
def sample_cap(spark, sf):
    iris = files(spark, sf).where("modality = 'iris'").select("name")
    return sp.sample_cap(iris, "name", 500)
