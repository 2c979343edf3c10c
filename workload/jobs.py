"""Jobs that go on from what is there, and preparation fitted in one pass."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from barograph.operators.derive import with_calendar
from barograph.operators.history import HISTORY_COLUMNS, attach_history
from barograph.operators.prepare import code_stage, fit_categories, fused_plan
from barograph.plans.incremental import run_incremental_cleaning
from barograph.plans.resume import Stages
from barograph.session import scratch_path
from barograph.sources.buckets import Buckets, joins_by_bucket, write_bucketed
from barograph.sources.tables import read_table, write_table
from workload.analytics import _HISTORY_SQL, _HOURLY_SQL, _history, _stations
from workload.cleaning import GAPS, GAPS_SQL, packed, with_gaps
from workload.common import Registry, hash_bucket_sql, load, r, rounded
from workload.learning import _TYPED_SQL, _typed_parts
from workload.packed import DERIVED_SQL, KEPT_SQL, PACKED_SQL, decoded_sql

registry = Registry()
query = registry.query


@query(f"""WITH {PACKED_SQL.replace('strftime(ts,', 'strftime(ts + to_months(CAST(event_id % 6 AS INTEGER)),')}, {decoded_sql()},
  {DERIVED_SQL}, {KEPT_SQL}
  SELECT year, month, count(*) AS rows, {r('avg(temperature)', 'temperature')}, {r('sum(precipitation)', 'precipitation')},
    TRUE AS idle FROM kept GROUP BY 1, 2""")
def incremental_cleaning_job(spark, sf_dir):
    """A third of the files, then one more third and a changed one, then no change at all."""
    raw, table, ledger = (scratch_path(spark, name) for name in ("raw", "clean", "ledger"))
    moved = F.expr("date_format(to_timestamp(DATE) + make_ym_interval(0, int(event_id % 6)), \"yyyy-MM-dd'T'HH:mm:ss\")")
    rows = packed(spark, sf_dir).withColumn("DATE", moved)

    def put(name, part):
        rows.where(part).drop("event_id").write.mode("overwrite").csv(f"{raw}/{name}", header=True, emptyValue="", nullValue="")

    third = F.col("event_id") % 3
    put("a", third == 0)
    put("b", (third == 1) & (F.col("event_id") % 2 == 0))
    run_incremental_cleaning(spark, f"{raw}/*", table, ledger)
    put("b", third == 1)
    put("c", third == 2)
    run_incremental_cleaning(spark, f"{raw}/*", table, ledger)
    last = run_incremental_cleaning(spark, f"{raw}/*", table, ledger)
    return rounded(read_table(spark, table).groupBy("year", "month").agg(
        F.count("*").alias("rows"), F.avg("temperature").alias("temperature"), F.sum("precipitation").alias("precipitation"),
        F.lit(last.months == 0 and last.files_new == 0).alias("idle")))


@query(f"""WITH {_HOURLY_SQL}, {_HISTORY_SQL}
  SELECT e.event_id, {', '.join(r(f'h.{c}', c) for c in HISTORY_COLUMNS)}
  FROM events e LEFT JOIN history h ON e.user_id = h.user_id
    AND CAST(floor(epoch(e.ts) / 3600) * 3600 AS BIGINT) = h.hour_epoch""")
def observation_history_bucketed(spark, sf_dir):
    """The history of every observation from a table bucketed by station: no shuffle after it is written."""
    path = scratch_path(spark, "stations")
    table = write_bucketed(_stations(spark, sf_dir), path, f"stations_{path[-12:]}", Buckets("user_id", 8))
    out = scratch_path(spark, "history")
    with joins_by_bucket(spark):
        write_table(attach_history(table, _history(table), "user_id", "ts").select("event_id", *HISTORY_COLUMNS), out)
    return rounded(read_table(spark, out))


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS orders,
  'totals' AS ran_again FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2""")
def resumed_job(spark, sf_dir):
    """A job whose last stage fails at first: the rerun builds only that one."""
    source, folder = scratch_path(spark, "orders"), scratch_path(spark, "stages")
    write_table(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus"), source)

    def job(broken: bool):
        stages = Stages(spark, "orders", source, folder=folder)
        whole = stages.table("whole", lambda: read_table(spark, source).where("o_orderstatus <> 'P'"), without="P")
        dated = stages.table("dated", lambda: with_calendar(whole, "o_orderdate").select("year", "month"))

        def totals():
            if broken:
                raise InterruptedError
            return dated.groupBy("year", "month").agg(F.count("*").alias("orders"))

        return stages, stages.table("totals", totals)

    try:
        job(broken=True)
    except InterruptedError:
        pass
    stages, found = job(broken=False)
    return found.withColumn("ran_again", F.lit(",".join(stages.ran)))


@query(f"""WITH {GAPS_SQL}, filled AS (SELECT l_orderkey, l_linenumber, {', '.join(
    f"coalesce({c}, (SELECT quantile_disc({c}, 0.5) FROM gaps)) AS {c}" for c in GAPS)} FROM gaps)
  SELECT l_orderkey, l_linenumber, {', '.join(r(f'{c} / (SELECT stddev_samp({c}) FROM filled)', f'{c}_scaled') for c in GAPS)} FROM filled""")
def fused_preparation(spark, sf_dir):
    """Gaps filled and columns scaled, all fitted in one pass; a column without values is left out."""
    rows = with_gaps(load(spark, sf_dir, "lineitem")).withColumn("absent", F.lit(None).cast("double"))
    plan = fused_plan(rows, [*GAPS, "absent"], scale=True, relative_error=1e-6)
    values = Pipeline(stages=plan.stages).fit(rows).transform(rows).withColumn("v", vector_to_array("features"))
    return rounded(values.select("l_orderkey", "l_linenumber", *[
        F.get("v", F.lit(i)).alias(f"{c}_scaled") for i, c in enumerate(GAPS)]))


@query(f"""WITH {_TYPED_SQL} SELECT p_partkey, t.kind, CAST(CASE WHEN t.kind IS NULL THEN 12 WHEN idx < 4 THEN idx
    ELSE 4 + {hash_bucket_sql('t.kind', 8)} END AS DOUBLE) AS kind_idx FROM typed t LEFT JOIN ranked ON t.kind = ranked.kind""")
def bounded_categories(spark, sf_dir):
    """The four commonest kinds have codes of their own, all others share eight."""
    parts = _typed_parts(spark, sf_dir)
    return code_stage([fit_categories(parts, "kind", top=4, hashed=8)]).transform(parts)
