"""Names, corpora, pairing, labels."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.functions.names import (
    MAX_STRICT_SUBJECTS,
    name_attributes,
    subject_id_prefix,
)
from ridgeline.operators import labels as lb
from ridgeline.operators import pairing as pr
from ridgeline.runtime import materialize, scratch_path
from ridgeline.sources.bucketed import joined_in_place, write_bucketed
from ridgeline.sources.corpus import split_modalities, verify_corpus, with_subject
from ridgeline.workloads.adapters import FILES_SQL, SIDES_SQL, files
from ridgeline.workloads.registry import query


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Iris and fingerprint files with their subject."""
    return split_modalities(with_subject(files(spark, sf_dir)))


@query(f"WITH {FILES_SQL} SELECT event_id, regexp_extract(name, '^[0-9]{{3}}') AS subject_id FROM files "
       "WHERE regexp_matches(name, '^[0-9]{3}')")
def subject_id_strict_(spark, sf):
    return with_subject(files(spark, sf)).select("event_id", "subject_id")


@query(f"WITH {FILES_SQL} SELECT event_id, split_part(name, '_', 1) AS subject_id FROM files")
def subject_id_prefix_(spark, sf):
    return files(spark, sf).select("event_id", subject_id_prefix("name").alias("subject_id"))


@query(f"""WITH {FILES_SQL} SELECT event_id, split_part(name, '_', 2) AS side,
  CASE modality WHEN 'fingerprint' THEN split_part(name, '_', 3) END AS finger,
  CAST(split_part(split_part(name, '_', CASE modality WHEN 'iris' THEN 3 ELSE 4 END), '.', 1) AS BIGINT)
    AS sample_number FROM files""")
def name_attributes_(spark, sf):
    return name_attributes(files(spark, sf), "name").select(
        "event_id", "side", "finger", "sample_number"
    )


@query(f"""WITH {FILES_SQL} SELECT count(*) FILTER (WHERE modality = 'iris') AS iris,
  count(*) FILTER (WHERE modality = 'fingerprint') AS fingerprint,
  count(*) FILTER (WHERE modality = 'iris') > 0 AND count(*) FILTER (WHERE modality = 'fingerprint') > 0
    AS valid FROM files""")
def corpus_verify(spark, sf):
    return verify_corpus(files(spark, sf))


@query(f"""WITH {FILES_SQL} SELECT substr(name, 1, 3) AS subject_id,
  count(*) FILTER (WHERE modality = 'iris') AS iris,
  count(*) FILTER (WHERE modality = 'fingerprint') AS fingerprint FROM files GROUP BY 1""")
def subject_counts(spark, sf):
    return pr.subject_counts(with_subject(files(spark, sf)))


@query(f"""WITH {FILES_SQL}, per AS (SELECT substr(name, 1, 3) AS s,
  count(*) FILTER (WHERE modality = 'iris') AS i, count(*) FILTER (WHERE modality = 'fingerprint') AS f
  FROM files GROUP BY 1)
SELECT CAST(sum(i) AS BIGINT) AS iris_files, CAST(sum(f) AS BIGINT) AS fingerprint_files,
  count(*) AS subjects, count(*) FILTER (WHERE i > 0 AND f > 0) AS num_classes,
  CAST(sum(i * f) AS BIGINT) AS pairs FROM per""")
def corpus_counts(spark, sf):
    return pr.corpus_counts(with_subject(files(spark, sf)))


@query(f"""WITH {SIDES_SQL} SELECT subject_id, iris.path AS iris_path, fingerprint.path AS fingerprint_path
FROM iris JOIN fingerprint USING (subject_id)""")
def pair_samples(spark, sf):
    return pr.pair_samples(*_sides(spark, sf))


@query(f"""WITH {SIDES_SQL} SELECT subject_id, iris.path AS iris_path, fingerprint.path AS fingerprint_path
FROM iris JOIN fingerprint USING (subject_id)""")
def pair_samples_grid(spark, sf):
    """The same with subjects of more than a thousandth of a side, or two rows, cut into a grid."""
    return pr.pair_samples(*_sides(spark, sf), min_hot_rows=2)


# Pairs that one bucket should make, and buckets at least.
PAIRS_PER_BUCKET = 10_000_000
MIN_BUCKETS = 8
# A subject that makes more pairs than so many buckets on average is cut.
CELL_BUCKETS = 2


def _stored(spark, *tables, buckets=MIN_BUCKETS, key="subject_id"):
    """Each ``(rows, name)`` as a table of so many buckets by subject, or by other keys."""
    return [
        write_bucketed(rows, f"{name}_{uuid.uuid4().hex}", scratch_path(spark, name), key, buckets) for rows, name in tables
    ]


def pair_buckets(pairs: int) -> int:
    """Buckets for a join of so many pairs; more than there are strict subjects would stay empty."""
    return min(MAX_STRICT_SUBJECTS, max(MIN_BUCKETS, -(-pairs // PAIRS_PER_BUCKET)))


@query(f"""WITH {SIDES_SQL} SELECT subject_id, iris.path AS iris_path, fingerprint.path AS fingerprint_path
FROM iris JOIN fingerprint USING (subject_id)""")
def pair_samples_bucketed(spark, sf):
    """The same over tables that were stored by subject: the join has no exchange, and a task for each bucket.

    A subject of more pairs than two buckets should make is stored as a grid of cells, each dealt to a bucket by itself.
    """
    named = with_subject(files(spark, sf))
    iris, finger = split_modalities(named)
    pairs = pr.corpus_counts(named).first()["pairs"]
    buckets = pair_buckets(pairs)
    most = CELL_BUCKETS * max(PAIRS_PER_BUCKET, -(-pairs // buckets))
    left, right = pr.in_cells(iris, finger, presence=materialize(pr.subject_counts(named), "presence"), cell_pairs=most)
    a, b = _stored(spark, (left, "iris"), (right, "fingerprint"), buckets=buckets, key=pr.CELL)
    return joined_in_place(a, b, pr.CELL).select("subject_id", "iris_path", "fingerprint_path")


@query(f"""WITH {FILES_SQL}, ids AS (SELECT DISTINCT substr(name, 1, 3) AS subject_id FROM files),
dict AS (SELECT subject_id, CAST(row_number() OVER (ORDER BY subject_id) - 1 AS INTEGER) AS label FROM ids)
SELECT event_id, subject_id, label FROM files JOIN dict ON substr(name, 1, 3) = subject_id""")
def label_index_bucketed(spark, sf):
    """Labels joined to stored rows in place."""
    named = with_subject(files(spark, sf)).select("event_id", "subject_id")
    rows, labels = _stored(spark, (named, "rows"), (lb.build_label_index(named, "subject_id"), "labels"))
    return joined_in_place(rows, labels, "subject_id").select("event_id", "subject_id", "label")


@query(f"""WITH {SIDES_SQL} SELECT subject_id FROM iris INTERSECT SELECT subject_id FROM fingerprint""")
def common_subjects(spark, sf):
    return pr.common_subjects(*_sides(spark, sf))


@query(f"""WITH {SIDES_SQL}
SELECT subject_id, 'iris' AS side, count(*) AS files FROM iris
WHERE subject_id NOT IN (SELECT subject_id FROM fingerprint) GROUP BY subject_id
UNION ALL
SELECT subject_id, 'fingerprint', count(*) FROM fingerprint
WHERE subject_id NOT IN (SELECT subject_id FROM iris) GROUP BY subject_id""")
def unpaired_subjects(spark, sf):
    return pr.unpaired_subjects(*_sides(spark, sf))


@query(f"""WITH {SIDES_SQL}, first AS (SELECT subject_id, min(path) AS fingerprint_path FROM fingerprint
  GROUP BY subject_id)
SELECT subject_id, path AS iris_path, fingerprint_path FROM iris JOIN first USING (subject_id)""")
def first_match_pair(spark, sf):
    return pr.first_match_pair(*_sides(spark, sf))


@query(f"""WITH {FILES_SQL}, ids AS (SELECT DISTINCT substr(name, 1, 3) AS subject_id FROM files),
dict AS (SELECT subject_id, CAST(row_number() OVER (ORDER BY subject_id) - 1 AS INTEGER) AS label FROM ids)
SELECT event_id, subject_id, label FROM files JOIN dict ON substr(name, 1, 3) = subject_id""")
def label_index(spark, sf):
    named = with_subject(files(spark, sf)).select("event_id", "subject_id")
    dictionary = lb.build_label_index(named, "subject_id")
    return lb.attach_label(named, dictionary, max_ids=MAX_STRICT_SUBJECTS).select("event_id", "subject_id", "label")


@query(f"""WITH {FILES_SQL}, ids AS (SELECT DISTINCT substr(name, 1, 3) AS subject_id FROM files),
dict AS (SELECT subject_id, CAST(row_number() OVER (ORDER BY subject_id) - 1 AS INTEGER) AS label FROM ids)
SELECT event_id, subject_id, label FROM files JOIN dict ON substr(name, 1, 3) = subject_id""")
def label_index_salted(spark, sf):
    """The same with no bound on the ids: subjects of more than a thousandth of the rows are spread over salts."""
    named = with_subject(files(spark, sf)).select("event_id", "subject_id")
    dictionary = lb.build_label_index(named, "subject_id")
    return lb.attach_label(named, dictionary, spread=["event_id"], min_hot_rows=5).select("event_id", "subject_id", "label")


@query(f"""WITH {FILES_SQL}, ids AS (SELECT DISTINCT split_part(name, '_', 1) AS subject_id FROM files)
SELECT subject_id, CAST(row_number() OVER (ORDER BY subject_id) - 1 AS INTEGER) AS label FROM ids""")
def label_index_unbounded(spark, sf):
    named = files(spark, sf).select(subject_id_prefix("name").alias("subject_id"))
    return lb.build_label_index(named, "subject_id")


@query(f"WITH {FILES_SQL} SELECT count(DISTINCT substr(name, 1, 3)) AS num_classes FROM files")
def class_count(spark, sf):
    named = with_subject(files(spark, sf))
    return lb.num_classes(lb.build_label_index(named, "subject_id"))
