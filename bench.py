"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` name the tables and the local cores. Queries
run to the last row but keep nothing. The image job works on a corpus of bitmap
files derived from the embeddings table and reports images per second.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ridgeline.plans.preprocessing import image_feature_job  # noqa: E402
from ridgeline.runtime import build_session, scratch_path  # noqa: E402
from ridgeline.workloads import QUERIES  # noqa: E402
from ridgeline.workloads.adapters import pixel_array  # noqa: E402
from ridgeline.workloads.bitmaps import write_bitmaps  # noqa: E402

HEADLINE = (
    "subject_counts", "corpus_counts", "pair_samples", "unpaired_subjects", "first_match_pair",
    "label_index", "label_index_unbounded", "exact_split", "grouped_split", "batch_assign",
    "evaluation_record", "confusion_matrix", "classification_report", "running_average",
    "image_stats", "pair_features", "ks_pvalue", "wasserstein_drift", "column_share_drift",
    "windowed_drift", "monitoring_report", "alias_holder", "should_promote", "promote_state",
    "rollback_state", "list_versions", "early_stop", "history_pivot", "centroid_classify",
    "evaluate_split", "preprocess_job", "fusion_attention", "train_classifier", "stream_score",
)

# Size of the images in the corpus, as eye images commonly come.
HEIGHT, WIDTH = 240, 320


def _corpus(spark, sf_dir: str) -> tuple[str, int]:
    """Files of 320x240 images: the 64 pixels of a vector, repeated."""
    px = pixel_array()
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", px.alias("px"))
    row = F.array_join(F.transform("px", lambda v: F.lpad(F.hex(v), 2, "0")), "")
    data = F.unhex(F.repeat(row, HEIGHT * WIDTH // 64))
    sides = F.explode(F.array(F.lit("iris"), F.lit("fingerprint")))
    images = vectors.select("vec_id", sides.alias("modality"), data.alias("data")).select(
        F.concat(
            "modality", F.lit("/"), F.lpad((F.col("vec_id") % 1000).cast("string"), 3, "0"), F.lit("_L_"),
            F.lpad(F.col("vec_id").cast("string"), 12, "0"), F.lit(".bmp"),
        ).alias("path"),
        F.struct(F.lit(HEIGHT).alias("height"), F.lit(WIDTH).alias("width"), "data").alias("image"),
    )
    root = scratch_path(spark, "bench-corpus")
    return root, write_bitmaps(images.repartition(8), root)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "20g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM paths and the Python workers before the clock.
    QUERIES["centroid_classify"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)

    # The same code on the smallest corpus first.
    image_feature_job(spark, _corpus(spark, "/root/testdata/sf0.001")[0])
    root, images = _corpus(spark, sf_dir)
    started = time.perf_counter()
    features, _ = image_feature_job(spark, root)
    took = time.perf_counter() - started
    seconds["image_feature_job"] = round(took, 3)
    made = features.where("ok").count()
    if made != images:
        raise RuntimeError(f"{images} images, {made} feature rows")
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
        "images": images,
        "images_per_sec": round(images / took, 1),
    }))


if __name__ == "__main__":
    main()
