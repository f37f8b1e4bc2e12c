"""Training histories."""

from __future__ import annotations

from ridgeline.operators import history as hs
from ridgeline.workloads.adapters import HISTORY_SQL, long_history, runs, stored_runs
from ridgeline.workloads.registry import query, r6

# The fold over epochs, row by row.
STOP_SQL = f"""WITH RECURSIVE {HISTORY_SQL},
lengths AS (SELECT run_id, max(epoch) AS epochs FROM runs GROUP BY run_id),
fold AS (
  SELECT run_id, epoch, loss AS best_loss, epoch AS best_epoch, 0 AS waited FROM runs WHERE epoch = 1
  UNION ALL
  SELECT r.run_id, r.epoch,
    CASE WHEN r.loss < f.best_loss - 0.001::DOUBLE THEN r.loss ELSE f.best_loss END,
    CASE WHEN r.loss < f.best_loss - 0.001::DOUBLE THEN r.epoch ELSE f.best_epoch END,
    CASE WHEN r.loss < f.best_loss - 0.001::DOUBLE THEN 0 ELSE f.waited + 1 END
  FROM fold f JOIN runs r ON r.run_id = f.run_id AND r.epoch = f.epoch + 1 WHERE f.waited < 10
),
ends AS (
  SELECT run_id, best_epoch, best_loss, epoch AS last_epoch, waited >= 10 AS stopped_early FROM fold
  QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY epoch DESC) = 1
)"""

WIDE_SQL = """
wide AS (SELECT run_id, epoch, loss * 0.9::DOUBLE AS train_loss, 1 / (1 + loss * 0.9::DOUBLE) AS train_acc,
  loss AS val_loss, 1 / (1 + loss) AS val_acc FROM runs)"""


@query(f"{STOP_SQL} SELECT run_id, best_epoch, best_loss, last_epoch, stopped_early FROM ends")
def early_stop(spark, sf):
    return hs.early_stop(stored_runs(spark, sf))


@query(f"WITH {HISTORY_SQL}, {WIDE_SQL} SELECT run_id, epoch, "
       + ", ".join(f"round({m}, 6) AS {m}" for m in hs.METRICS) + " FROM wide")
def history_pivot(spark, sf):
    return hs.history_pivot(long_history(runs(spark, sf))).select(
        "run_id", "epoch", *[r6(m).alias(m) for m in hs.METRICS]
    )


@query(f"""{STOP_SQL}, {WIDE_SQL}
SELECT ends.run_id, best_epoch, round(best_loss, 6) AS val_loss, round(val_acc, 6) AS val_acc,
  round(train_loss, 6) AS train_loss FROM ends JOIN wide ON wide.run_id = ends.run_id AND epoch = best_epoch""")
def final_metrics(spark, sf):
    history = stored_runs(spark, sf)
    df = hs.final_metrics(hs.history_pivot(long_history(history)), hs.early_stop(history))
    return df.select("run_id", "best_epoch", *[r6(c).alias(c) for c in ("val_loss", "val_acc", "train_loss")])
