"""ridgeline: two-modality recognition data as Spark jobs.

Scan and pair an image corpus, turn images into feature tables, split and
batch, fuse and score vectors, evaluate, watch for drift, and keep a log of
model versions. Every operator takes and returns DataFrames.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
