"""Model versions: aliases, promotion, rollback, retraining decisions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ridgeline.operators import versions as vs
from ridgeline.operators.skew import merged
from ridgeline.workloads.adapters import LOG_SQL, stored_log, version_log
from ridgeline.workloads.registry import query, table

# Later than every order.
AT = datetime(2030, 1, 1)

DECISIONS_SQL = LOG_SQL + """,
improved AS (
  SELECT *, CASE WHEN champion IS NOT NULL AND challenger IS NOT NULL THEN
    CASE WHEN champion_f1 > 0 THEN (challenger_f1 - champion_f1) / champion_f1 ELSE 0 END END AS improvement
  FROM finalists
),
decisions AS (
  SELECT *, CASE WHEN challenger IS NULL THEN false WHEN champion IS NULL THEN true
    ELSE improvement > 0.01::DOUBLE END AS promote FROM improved
)"""


@query(f"""WITH {LOG_SQL}, highest AS (SELECT model, max(version) AS h FROM log GROUP BY model),
fresh AS (SELECT c_custkey AS model, floor(c_acctbal) / 123456 AS f1, c_mktsegment AS segment FROM customer)
SELECT fresh.model, CAST(coalesce(h, 0) + 1 AS INTEGER) AS version, 'challenger' AS alias,
  segment AS owner, 'challenger' AS tag_alias, 'spark-ml' AS framework,
  round(CAST(round(f1, 4) AS DOUBLE), 4) AS metric_f1_macro FROM fresh LEFT JOIN highest USING (model)""")
def register_versions(spark, sf):
    fresh = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("model"),
        F.lit(AT).cast("timestamp").alias("event_ts"), F.col("c_custkey").alias("run"),
        F.create_map(F.lit("owner"), F.col("c_mktsegment")).alias("tags"),
        F.create_map(F.lit("f1_macro"), F.floor("c_acctbal") / 123456).alias("metrics"),
    )
    return vs.register(version_log(spark, sf), fresh, "run").select(
        "model", "version", "alias", F.col("tags.owner").alias("owner"),
        F.col("tags.alias").alias("tag_alias"), F.col("tags.framework").alias("framework"),
        F.round(F.col("tags.metric_f1_macro").cast("double"), 4).alias("metric_f1_macro"),
    )


@query(f"WITH {LOG_SQL} SELECT model, alias, version, f1 FROM holders")
def alias_holder(spark, sf):
    return vs.alias_holders(version_log(spark, sf)).select(
        "model", "alias", "version", F.col("metrics.f1_macro").alias("f1")
    )


@query(f"WITH {LOG_SQL} SELECT model, max(version) AS version FROM log WHERE priority = '1-URGENT' GROUP BY model")
def tag_lookup(spark, sf):
    return vs.by_tag(version_log(spark, sf), "priority", "1-URGENT")


@query(f"""WITH {LOG_SQL}, kept AS (SELECT model, version, alias, f1,
  row_number() OVER (PARTITION BY model ORDER BY version DESC) AS position FROM log WHERE alias <> 'archived')
SELECT model, version, alias, f1, CAST(position AS INTEGER) AS position FROM kept""")
def list_versions(spark, sf):
    return vs.list_versions(version_log(spark, sf)).select(
        "model", "version", "alias", F.col("metrics.f1_macro").alias("f1"), "position"
    )


@query(f"""WITH {LOG_SQL}, pairs AS (SELECT a.model, a.version AS version_a, b.version AS version_b,
  a.f1 AS value_a, b.f1 AS value_b FROM log a JOIN log b ON a.model = b.model AND b.version = a.version + 1)
SELECT model, version_a, version_b, 'f1_macro' AS metric, value_a, value_b,
  CASE WHEN value_a > 0 THEN (value_b - value_a) / value_a ELSE 0 END AS improvement,
  CASE WHEN value_b > value_a THEN 'B' ELSE 'A' END AS winner FROM pairs""")
def compare_versions(spark, sf):
    log = stored_log(spark, sf)
    # Each version with the next one of its model.
    pairs = log.select("model", F.col("version").alias("version_a"), (F.col("version") + 1).alias("version_b"))
    return vs.compare_versions(log, pairs).select(
        "model", "version_a", "version_b", "metric", "value_a", "value_b", "improvement", "winner",
    )


@query(f"""WITH {DECISIONS_SQL} SELECT model, champion, challenger,
  improvement, promote,
  CASE WHEN challenger IS NULL THEN 'no challenger' WHEN champion IS NULL THEN 'no champion'
    WHEN promote THEN 'improved' ELSE 'not improved' END AS reason FROM decisions""")
def should_promote(spark, sf):
    return vs.should_promote(version_log(spark, sf))


@query(f"""WITH {DECISIONS_SQL}
SELECT model, version, CASE WHEN promote AND version = champion THEN 'archived'
  WHEN promote AND version = challenger THEN 'champion' ELSE alias END AS alias,
  CASE WHEN promote AND version = challenger THEN 'challenger' END AS previous_alias
FROM log LEFT JOIN decisions USING (model)""")
def promote_state(spark, sf):
    after = vs.promote(stored_log(spark, sf), None, AT)
    return vs.current_versions(after).select(
        "model", "version", "alias", F.col("tags")["previous_alias"].alias("previous_alias")
    )


@query(f"""WITH {DECISIONS_SQL}
SELECT model, 'champion' AS alias, CASE WHEN promote THEN challenger ELSE champion END AS version FROM decisions
WHERE promote OR champion IS NOT NULL
UNION ALL SELECT model, 'challenger', challenger FROM decisions WHERE NOT promote AND challenger IS NOT NULL""")
def promote_holders(spark, sf):
    """Who holds the two aliases after promotion: a promoted challenger leaves none behind."""
    log = stored_log(spark, sf)
    after = vs.promote(log, vs.should_promote(log), AT)
    return vs.alias_holders(after).where("alias <> 'archived'").select("model", "alias", "version")


@query(f"""WITH {LOG_SQL}, goals AS (SELECT model, max(version) AS target FROM log WHERE alias = 'archived' GROUP BY model)
SELECT model, 'champion' AS alias, coalesce(target, champion) AS version FROM finalists LEFT JOIN goals USING (model)
WHERE coalesce(target, champion) IS NOT NULL
UNION ALL SELECT model, 'challenger', challenger FROM finalists WHERE challenger IS NOT NULL""")
def rollback_holders(spark, sf):
    after = vs.rollback(stored_log(spark, sf), AT)
    return vs.alias_holders(after).where("alias <> 'archived'").select("model", "alias", "version")


# Earlier than every order: such steps act like others, and only show another time.
BACK = datetime(1980, 1, 1)


@query(f"""WITH {DECISIONS_SQL}, moved AS (SELECT * FROM decisions WHERE promote)
SELECT log.model, log.version, CASE WHEN log.version = m.champion THEN 'archived' WHEN log.version = m.challenger THEN 'champion'
    ELSE alias END AS alias,
  CASE WHEN log.version IN (m.champion, m.challenger) THEN '1980-01-01' ELSE strftime(event_ts, '%Y-%m-%d') END AS shown,
  coalesce(log.version IN (m.champion, m.challenger), false) AS moved
FROM log LEFT JOIN moved m ON m.model = log.model""")
def promote_backdated(spark, sf):
    """Promotion dated before all other events."""
    after = vs.promote(stored_log(spark, sf), None, BACK)
    return vs.current_versions(after).select(
        "model", "version", "alias", F.date_format("event_ts", "yyyy-MM-dd").alias("shown"), (F.col("seq") > 0).alias("moved")
    )


@query(f"""WITH {LOG_SQL}, goals AS (SELECT model, max(version) AS target FROM log WHERE alias = 'archived' GROUP BY model),
champions AS (SELECT model, version AS champion FROM holders WHERE alias = 'champion')
SELECT model, log.version, CASE WHEN log.version = target THEN 'champion'
  WHEN target IS NOT NULL AND log.version = champion THEN 'archived' ELSE log.alias END AS alias,
  coalesce(log.version = target OR (target IS NOT NULL AND log.version = champion), false) AS moved
FROM log LEFT JOIN goals USING (model) LEFT JOIN champions USING (model)""")
def rollback_backdated(spark, sf):
    """Going back, dated before all other events."""
    after = vs.rollback(stored_log(spark, sf), BACK)
    return vs.current_versions(after).select("model", "version", "alias", (F.col("event_ts") == F.lit(BACK)).alias("moved"))


@query(f"""WITH {LOG_SQL}, highest AS (SELECT model, max(version) AS h FROM log GROUP BY model)
SELECT model, 'challenger' AS alias, CAST(h + 1 AS INTEGER) AS version, '1980-01-01' AS shown FROM highest
UNION ALL SELECT model, alias, version, strftime(event_ts, '%Y-%m-%d') FROM holders WHERE alias <> 'challenger'""")
def register_late(spark, sf):
    """A version registered for an earlier time takes the alias from its holder: the newest call counts."""
    log = stored_log(spark, sf)
    fresh = log.select("model").distinct().select(
        "model", F.lit(BACK).cast("timestamp").alias("event_ts"), F.lit(0).alias("run"),
        F.lit(None).cast("map<string,string>").alias("tags"), F.create_map(F.lit("f1_macro"), F.lit(0.5)).alias("metrics"),
    )
    holders = vs.alias_holders(vs.registered(log, fresh, "run"))
    return holders.select("model", "alias", "version", F.date_format("event_ts", "yyyy-MM-dd").alias("shown"))


# Every third order names its own version, the others one that does not exist.
@query(f"""WITH {LOG_SQL}, goals AS (SELECT model, CASE WHEN model % 3 = 0 THEN 1 ELSE 1000000 END AS target FROM log GROUP BY model)
SELECT model, 'champion' AS alias, CASE WHEN target = 1 THEN 1 ELSE champion END AS version, target = 1 AS done
FROM finalists JOIN goals USING (model) WHERE target = 1 OR champion IS NOT NULL""")
def rollback_targets(spark, sf):
    """Going back to versions that may not exist: those models keep their champion."""
    log = stored_log(spark, sf)
    targets = log.select("model").distinct().withColumn("version", F.when(F.col("model") % 3 == 0, 1).otherwise(1000000))
    holders = vs.alias_holders(vs.rollback(log, AT, targets)).where("alias = 'champion'")
    done = vs.rollback_outcome(log, targets).select("model", "done")
    return merged(holders, done, "model").select("model", "alias", "version", "done")


@query(f"""WITH {LOG_SQL}, highest AS (SELECT model, max(version) AS h FROM log GROUP BY model),
fresh AS (SELECT o_custkey AS model, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nth,
  count(*) OVER (PARTITION BY o_custkey) AS all_new FROM orders),
placed AS (SELECT model, h + nth AS version, nth = all_new AS is_last, o_orderkey FROM fresh JOIN highest USING (model))
SELECT model, CAST(version AS INTEGER) AS version, CASE WHEN is_last THEN 'challenger' END AS alias, CAST(o_orderkey AS VARCHAR) AS run
FROM placed
UNION ALL SELECT model, challenger, NULL, NULL FROM finalists WHERE challenger IS NOT NULL""")
def register_many(spark, sf):
    """Many versions of a model at one time: numbered by their run; the last one holds the alias, its old holder none."""
    log = stored_log(spark, sf)
    fresh = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("model"), F.lit(AT).cast("timestamp").alias("event_ts"), "o_orderkey",
        F.create_map(F.lit("run"), F.col("o_orderkey").cast("string")).alias("tags"),
        F.create_map(F.lit("f1_macro"), F.lit(0.5)).alias("metrics"),
    )
    after = vs.registered(log, fresh, "o_orderkey")
    return after.where(F.col("event_ts") >= F.lit(AT)).select("model", "version", "alias", F.col("tags")["run"].alias("run"))


@query(f"""WITH {LOG_SQL}, goals AS (SELECT model, max(version) AS target FROM log WHERE alias = 'archived'
  GROUP BY model)
SELECT model, log.version, CASE WHEN log.version = target THEN 'champion'
  WHEN target IS NOT NULL AND log.version = holders.version THEN 'archived' ELSE log.alias END AS alias
FROM log LEFT JOIN goals USING (model)
LEFT JOIN (SELECT model, version FROM holders WHERE alias = 'champion') holders USING (model)""")
def rollback_state(spark, sf):
    after = vs.rollback(stored_log(spark, sf), AT)
    return vs.current_versions(after).select("model", "version", "alias")


_SIDES_SQL = f"""{LOG_SQL},
champ AS (SELECT model, f1 FROM holders WHERE alias = 'champion'),
chall AS (SELECT model, f1 FROM holders WHERE alias = 'challenger')"""


@query(f"""WITH {_SIDES_SQL}, changes AS (SELECT model, champ.f1 AS a, chall.f1 AS b,
  CASE WHEN champ.f1 > 0 THEN (chall.f1 - champ.f1) / champ.f1 ELSE 'inf'::DOUBLE END AS change
  FROM chall LEFT JOIN champ USING (model))
SELECT model, a AS champion_value, b AS challenger_value,
  CASE WHEN a IS NULL OR change > 0.01 THEN 'challenger' ELSE 'champion' END AS winner,
  a IS NULL OR change > 0.01 AS promoted, a IS NULL AS first_champion,
  CASE WHEN a IS NOT NULL THEN change * 100 END AS improvement FROM changes""")
def retrain_decision(spark, sf):
    holders = vs.alias_holders(stored_log(spark, sf)).withColumn("value", F.col("metrics.f1_macro"))
    df = vs.retrain_decision(
        holders.where("alias = 'champion'"), holders.where("alias = 'challenger'")
    )
    first = F.col("improvement") == float("inf")
    return df.select(
        "model", "champion_value", "challenger_value", "winner", "promoted",
        first.alias("first_champion"), F.when(~first, F.col("improvement")).alias("improvement"),
    )


@query(f"""WITH {LOG_SQL} SELECT model, max('champion_' || strftime(event_ts, '%Y%m%d') || '_'
  || lpad(CAST(version AS VARCHAR), 9, '0')) AS name, true AS found FROM log WHERE alias = 'archived' GROUP BY model""")
def archive_choice(spark, sf):
    archives = version_log(spark, sf).where("alias = 'archived'").select(
        "model",
        F.concat_ws(
            "_", F.lit("champion"), F.date_format("event_ts", "yyyyMMdd"),
            F.lpad(F.col("version").cast("string"), 9, "0"),
        ).alias("name"),
    )
    return vs.choose_archive(archives)


@query(f"""WITH {LOG_SQL} SELECT model, CAST(coalesce(
    max(holders.version) FILTER (WHERE holders.alias = 'champion'), max(log.version)) AS INTEGER) AS version
FROM log JOIN holders USING (model) GROUP BY model""")
def model_pick(spark, sf):
    return vs.pick_model(version_log(spark, sf))
