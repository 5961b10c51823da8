"""

The given ``events`` table has other column and type names than the event log the operators
work on; ``GIVEN_EVENTS`` maps one to the other. Every query reads the whole table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce
from importlib import import_module
from importlib.util import find_spec

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmetrics import AnalyticsConfig
from clickmetrics import operators as op
from clickmetrics.config import FUNNEL_STAGES, PURCHASE
from clickmetrics.operators.segments import SegmentModel
from clickmetrics.plans import (
    dashboard_snapshot,
    run_local_profile,
    run_metrics,
    run_warehouse_profile,
)
from clickmetrics.plans.profiles import SQL_RUN
from clickmetrics.session import SESSION_CONF, new_folder
from clickmetrics.sinks import append_csv, append_messages, compact_events, load_events
from clickmetrics.sources import (
    EventMapping,
    csv_events,
    encode_messages,
    events_table,
    map_events,
)
from clickmetrics.streaming import (
    file_messages,
    ingest_messages,
    load_staged_csv,
    quarantined,
)

#: Stated, so that no job has to read it from the files first.
GIVEN_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)
TYPE_NAMES = {"signup": "login", "view": "product_view", "click": "add_to_cart"}
GIVEN_EVENTS = EventMapping(
    timestamp="ts", amount="value", type_names=TYPE_NAMES, money_types=("purchase",)
)
#: The same with the table's value as the amount of every event, not of purchases only.
GIVEN_EVENTS_ALL_AMOUNTS = EventMapping(timestamp="ts", amount="value", type_names=TYPE_NAMES)


def given_events(
    spark: SparkSession,
    sf_dir: str,
    mapping: EventMapping = GIVEN_EVENTS,
    only_types: tuple[str, ...] | None = None,
) -> DataFrame:
    """The given events table as an event log, days and hours in UTC.

    ``only_types`` repeats an operator's own type filter on the table's type names, where the
    scan can use it.
    """
    spark.conf.set("spark.sql.session.timeZone", SESSION_CONF["spark.sql.session.timeZone"])
    stored = spark.read.schema(GIVEN_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    return map_events(stored, mapping, only_types)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: lifetime value in detail, highest first."""
    return queries()["ltv_detail"](spark, "/root/testdata/sf0.001")


def _over_events(
    build: Callable[[DataFrame], DataFrame],
    mapping: EventMapping = GIVEN_EVENTS,
    only_types: tuple[str, ...] | None = None,
) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(given_events(spark, sf_dir, mapping, only_types))


#: Money is rounded in these queries, so that the order of double sums does not show.
REPORT = AnalyticsConfig(money_digits=2)


def _scratch_database(spark: SparkSession, name: str) -> tuple[AnalyticsConfig, str]:
    """A database of its own for a query that writes tables, and its folder in the shared one.

    A query's next call drops what its last one left, so there is one copy per query.
    """
    database = f"clickmetrics_{name}"
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    folder = new_folder(spark, name)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    return replace(REPORT, database=database), folder


def csv_events_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given events written to CSV staging files and read back."""
    _, folder = _scratch_database(spark, "csv_events_scan")
    append_csv(given_events(spark, sf_dir), f"{folder}/staging")
    return csv_events(spark, f"{folder}/staging")


def staged_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given events through CSV staging into the events table."""
    config, folder = _scratch_database(spark, "staged_csv_load")
    append_csv(given_events(spark, sf_dir), f"{folder}/staging")
    load_staged_csv(spark, f"{folder}/staging", f"{folder}/offsets", "staged", config)
    return events_table(spark, config)


def _ingested(spark: SparkSession, messages: DataFrame, name: str) -> AnalyticsConfig:
    config, folder = _scratch_database(spark, name)
    messages.write.text(f"{folder}/landing")
    ingest_messages(
        file_messages(spark, f"{folder}/landing"), "given", f"{folder}/offsets", config, True
    ).awaitTermination()
    return config


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given events as JSON messages, through the stream into the events table."""
    messages = encode_messages(given_events(spark, sf_dir))
    return events_table(spark, _ingested(spark, messages, "stream_ingest"))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages set aside by reason: clicks have their amount made text, views lack a time."""
    events = given_events(spark, sf_dir)
    event_type = F.regexp_extract("value", '"event_type":"([^"]*)"', 1)
    amount_as_text = F.regexp_replace("value", '"amount":([^,]*)', '"amount":"$1"')
    without_time = F.regexp_replace("value", ',"timestamp":"[^"]*"', "")
    messages = encode_messages(events).select(
        F.when(event_type == "add_to_cart", amount_as_text)
        .when(event_type == "product_view", without_time)
        .otherwise(F.col("value"))
        .alias("value")
    )
    config = _ingested(spark, messages, "stream_quarantine")
    stored = events_table(spark, config).agg(
        F.lit("stored").alias("reason"), F.count(F.lit(1)).alias("messages")
    )
    aside = quarantined(spark, config).groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))
    return stored.union(aside)


def events_table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given events loaded twice under one load id, which stores them once."""
    config, _ = _scratch_database(spark, "events_table_load")
    for _ in range(2):
        load_events(given_events(spark, sf_dir), "given", config)
    return events_table(spark, config)


def events_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given events in a load per type, all days but the last folded together."""
    config, _ = _scratch_database(spark, "events_compacted")
    events = given_events(spark, sf_dir)
    for event_type in FUNNEL_STAGES:
        load_events(events.filter(F.col("event_type") == event_type), event_type, config)
    known = F.coalesce(F.col("event_type").isin(*FUNNEL_STAGES), F.lit(False))
    load_events(events.filter(~known), "others", config)
    compact_events(spark, date(2024, 1, 30), config)
    return events_table(spark, config)


def _two_loads(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events up to a day, and the others, those without a time among them."""
    earlier = F.coalesce(F.col("timestamp") < "2024-01-20", F.lit(False))
    return events.filter(earlier), events.filter(~earlier)


def _profile(
    run: Callable[[SparkSession, AnalyticsConfig], list[str]], name: str
) -> Callable[[SparkSession, str], DataFrame]:
    """A whole batch run over the given events, in two loads with a run after each; every table's
    rows as text, so that whole tables are compared."""

    def tables_of_run(spark: SparkSession, sf_dir: str) -> DataFrame:
        config, _ = _scratch_database(spark, name)
        events = given_events(spark, sf_dir)
        earlier, later = _two_loads(events)
        load_events(earlier, "earlier", config)
        run(spark, config)
        load_events(later, "later", config)
        shown = []
        for table in run(spark, config):
            rows = spark.table(config.table(table))
            if table == "user_segments":
                rows = op.segment_check(rows)
            values = [_as_text(rows, column) for column in sorted(rows.columns)]
            shown.append(rows.select(F.lit(table).alias("table_name"), F.concat_ws("|", *values).alias("row")))
        return reduce(DataFrame.unionByName, shown)

    return tables_of_run


def _as_text(rows: DataFrame, column: str) -> Column:
    """A value as both engines show it: doubles by hundredths, times by microseconds."""
    value = F.col(column)
    kind = rows.schema[column].dataType.simpleString()
    if kind == "double":
        value = F.round(value * 100).cast("bigint")
    elif kind == "timestamp":
        value = F.unix_micros(value)
    return F.coalesce(value.cast("string"), F.lit("-"))


def dashboard_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts of the dashboard after a local run, figures as text; a load came in since."""
    config, _ = _scratch_database(spark, "dashboard_parts")
    events = given_events(spark, sf_dir)
    earlier, later = _two_loads(events)
    load_events(earlier, "earlier", config)
    run_local_profile(spark, config)
    load_events(later, "later", config)
    shown = []
    for part, frame in dashboard_snapshot(spark, config).items():
        if part == "segments":
            frame = frame.agg(F.sum("count").alias("users"), F.count(F.lit(1)).alias("segments"))
        values = [_as_text(frame, column) for column in sorted(frame.columns)]
        shown.append(frame.select(F.lit(part).alias("part"), F.concat_ws("|", *values).alias("row")))
    return reduce(DataFrame.unionByName, shown)


def segment_model_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users scored by a segment model that was saved and loaded, next to the fitted one."""
    features = op.segment_features(given_events(spark, sf_dir), REPORT)
    fitted = op.fit_segments(features, REPORT)
    path = new_folder(spark, "segment-model")
    fitted.model.save(path)
    loaded = SegmentModel.load(path).transform(features)
    both = fitted.users.alias("a").join(loaded.alias("b"), "user_id")
    same = F.col("a.segment_label").eqNullSafe(F.col("b.segment_label"))
    return both.select("user_id", "a.frequency", "a.monetary", same.alias("same_label"))


#: One user per user and day, so that thresholds have values on both sides; purchases of an odd
#: event lose their amount, so that there are nulls; retained is who does more than three things.
def daily_user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = spark.read.schema(GIVEN_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    spark.conf.set("spark.sql.session.timeZone", SESSION_CONF["spark.sql.session.timeZone"])
    day = F.date_format(F.col("ts").cast("timestamp"), "yyyyMMdd")
    no_amount = (F.col("event_type") == PURCHASE) & (F.col("event_id") % 2 == 1)
    return map_events(
        stored.withColumn("user_id", F.concat_ws("-", F.col("user_id").cast("string"), day)).withColumn(
            "value", F.when(~no_amount, F.col("value"))
        ),
        GIVEN_EVENTS,
    )


def _over_daily(build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(daily_user_events(spark, sf_dir))


def _installed(module: str) -> bool:
    """Whether a module is there; an emptied folder, which has no file of its own, is not."""
    spec = find_spec(module)
    return spec is not None and spec.origin is not None


def _training_data(name: str) -> dict:
    """``QUERIES`` or ``ORACLE_SQL`` of the training-data operators, where they are installed."""
    if not _installed("clickmetrics.llm"):
        return {}
    return getattr(import_module("clickmetrics.llm.queries"), name)


def _pipeline() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if not (_installed("clickmetrics.llm") and _installed("corpus_pipeline")):
        return {}
    return {"pipeline": import_module("corpus_pipeline").run}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _training_data("QUERIES") | _pipeline() | _event_queries()


def oracle_sql() -> dict[str, str]:
    return _training_data("ORACLE_SQL") | _event_sql()


def _event_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # Sources, sinks and streams.
        "events_canonical": _over_events(lambda events: events),
        "csv_events_scan": csv_events_scan,
        "events_to_json": _over_events(encode_messages),
        "events_table_load": events_table_load,
        "staged_csv_load": staged_csv_load,
        "stream_ingest": stream_ingest,
        "stream_quarantine": stream_quarantine,
        "events_compacted": events_compacted,
        # Metrics.
        "ltv_basic": _over_events(lambda e: op.in_read_order(op.ltv_basic(e, REPORT), "ltv_metrics")),
        "ltv_basic_all_amounts": _over_events(
            lambda e: op.in_read_order(op.ltv_basic(e, REPORT), "ltv_metrics"), GIVEN_EVENTS_ALL_AMOUNTS
        ),
        "ltv_detail": _over_events(lambda e: op.in_read_order(op.ltv_detail(e, REPORT), "ltv_detail")),
        "user_engagement": _over_events(op.user_engagement),
        "retention_summary": _over_events(op.retention_summary),
        "user_daily_activity": _over_events(
            lambda e: op.in_read_order(op.user_daily_activity(e), "user_daily_activity")
        ),
        "user_signup": _over_events(op.user_signup),
        "cohort_daily": _over_events(
            lambda e: op.in_read_order(op.cohort_daily(e), "cohort_metrics")
        ),
        "cohort_daily_keep_null_day": _over_events(
            lambda e: op.in_read_order(op.cohort_daily(e, "keep_null_day"), "cohort_metrics")
        ),
        "funnel_fixed": _over_events(op.funnel_fixed, only_types=FUNNEL_STAGES),
        "funnel_users": _over_events(
            lambda e: op.in_read_order(op.funnel_users(e), "funnel_metrics")
        ),
        "funnel_volume": _over_events(
            lambda e: op.in_read_order(op.funnel_volume(e), "funnel_volume")
        ),
        "revenue_hourly": _over_events(
            lambda e: op.in_read_order(op.revenue_hourly(e, REPORT), "revenue_trend"),
            only_types=(PURCHASE,),
        ),
        # Churn and segments.
        "churn_risk": _over_events(op.churn_risk),
        "segment_features": _over_events(lambda e: op.segment_features(e, REPORT)),
        "segment_features_scaled": _over_events(
            lambda e: op.segment_features_scaled(op.segment_features(e, REPORT), digits=6)
        ),
        "customer_segments": _over_events(
            lambda e: op.fit_segments(op.segment_features(e, REPORT), REPORT).users
        ),
        "segment_distribution": _over_events(
            lambda e: op.segment_distribution(op.fit_segments(op.segment_features(e, REPORT), REPORT).users)
        ),
        # Dashboard.
        "kpi_global": _over_events(lambda e: op.kpi_global(e, REPORT)),
        "top_customers": _over_events(lambda e: op.top_customers(op.ltv_basic(e, REPORT))),
        "funnel_display": _over_events(
            lambda e: op.funnel_display(op.funnel_fixed(e)), only_types=FUNNEL_STAGES
        ),
        "churn_summary": _over_events(lambda e: op.churn_summary(op.churn_risk(e))),
        "conversion_rate": _over_events(
            lambda e: op.conversion_rate(op.funnel_users(e)),
            only_types=(FUNNEL_STAGES[0], PURCHASE),
        ),
        "retention_row": _over_events(lambda e: op.retention_row(op.retention_summary(e))),
        "segment_check": _over_events(
            lambda e: op.segment_check(
                op.fit_segments(op.segment_features(e, REPORT), REPORT).users
            )
        ),
        "segment_model_reload": segment_model_reload,
        "dashboard_parts": dashboard_parts,
        # The same metrics where users lie on both sides of the thresholds and amounts can be null.
        "daily_retention": _over_daily(op.retention_summary),
        "daily_cohorts": _over_daily(op.cohort_daily),
        "daily_churn_summary": _over_daily(lambda e: op.churn_summary(op.churn_risk(e))),
        "daily_churn_risk": _over_daily(op.churn_risk),
        "daily_conversion": _over_daily(lambda e: op.conversion_rate(op.funnel_users(e))),
        "daily_ltv_detail": _over_daily(lambda e: op.ltv_detail(e, REPORT)),
        "daily_features": _over_daily(lambda e: op.segment_features(e, REPORT)),
        "daily_features_scaled": _over_daily(
            lambda e: op.segment_features_scaled(op.segment_features(e, REPORT), digits=6)
        ),
        # Whole batch runs.
        "local_profile": _profile(run_local_profile, "local_profile"),
        "warehouse_profile": _profile(run_warehouse_profile, "warehouse_profile"),
        "sql_profile": _profile(
            lambda spark, config: run_metrics(spark, list(SQL_RUN), config), "sql_profile"
        ),
    }


# The mapping of the given table, for DuckDB.
_LOG = """
WITH log AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id,
         CASE event_type WHEN 'signup' THEN 'login' WHEN 'view' THEN 'product_view'
                         WHEN 'click' THEN 'add_to_cart' ELSE event_type END AS event_type,
         {amount} AS amount,
         CAST(ts AS TIMESTAMP) AS "timestamp"
  FROM events
)"""
_PURCHASE_AMOUNTS = _LOG.format(
    amount="CASE WHEN event_type = 'purchase' THEN value ELSE CAST(0 AS DOUBLE) END"
)
_ALL_AMOUNTS = _LOG.format(amount="value")
_DAILY_USERS = _LOG.format(
    amount="CASE WHEN event_type <> 'purchase' THEN 0.0 WHEN event_id % 2 = 0 THEN value END"
).replace(
    "CAST(user_id AS VARCHAR) AS user_id",
    "CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS user_id",
)

_LTV_BASIC = """
SELECT user_id, round(SUM(amount), 2) AS total_ltv, COUNT(user_id) AS event_count
FROM log GROUP BY user_id HAVING SUM(amount) > 0"""

_FUNNEL_FIXED = """
SELECT s.stage AS stage, COUNT(DISTINCT l.user_id) AS user_count
FROM (VALUES ('login'), ('product_view'), ('add_to_cart'), ('purchase')) AS s(stage)
LEFT JOIN log l ON l.event_type = s.stage GROUP BY s.stage"""

_CHURN_RISK = """
SELECT user_id, event_count, purchase_count,
       CAST(CASE WHEN event_count <= 2 AND purchase_count = 0 THEN 1 ELSE 0 END AS INTEGER)
         AS is_at_risk
FROM (SELECT user_id, COUNT("timestamp") AS event_count,
             CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT)
               AS purchase_count
      FROM log GROUP BY user_id)"""

_FEATURES = """
SELECT user_id, COUNT("timestamp") AS frequency, round(SUM(amount), 2) AS monetary
FROM log GROUP BY user_id"""

_AS_IT_IS = 'SELECT user_id, event_type, amount, "timestamp" FROM log'

_RETENTION = """
SELECT COUNT(*) AS total_users,
       COUNT(*) FILTER (WHERE n > 3) AS retained_users,
       round(CAST(COUNT(*) FILTER (WHERE n > 3) AS DOUBLE) * 100.0 / NULLIF(COUNT(*), 0), 2)
         AS retention_rate
FROM (SELECT user_id, COUNT("timestamp") AS n FROM log GROUP BY user_id)"""

_DAILY_ACTIVITY = """
SELECT user_id, COUNT(DISTINCT d) AS active_days, MIN(d) AS first_active, MAX(d) AS last_active
FROM (SELECT user_id, CAST(date_trunc('day', "timestamp") AS TIMESTAMP) AS d FROM log)
GROUP BY user_id"""

_COHORTS = """
SELECT strftime(first_at, '%Y-%m-%d') AS cohort_day, COUNT(*) AS user_count
FROM (SELECT user_id, MIN("timestamp") AS first_at FROM log GROUP BY user_id)
WHERE first_at IS NOT NULL GROUP BY 1"""

_LTV_DETAIL = """
SELECT user_id, first_order_date, last_order_date, total_orders,
       round(spent, 2) AS total_ltv,
       CAST(round(spent, 2) AS DOUBLE) / NULLIF(total_orders, 0) AS avg_order_value,
       date_sub('day', first_order_date, last_order_date) AS customer_lifespan_days
FROM (SELECT user_id, MIN("timestamp") AS first_order_date, MAX("timestamp") AS last_order_date,
             COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS total_orders,
             SUM(CASE WHEN event_type = 'purchase' THEN amount ELSE 0 END) AS spent
      FROM log GROUP BY user_id)
WHERE spent > 0"""

_FUNNEL_VOLUME = """
SELECT event_type AS stage, COUNT(user_id) AS total_events,
       COUNT(DISTINCT user_id) AS unique_users
FROM log GROUP BY event_type"""

_REVENUE = """
SELECT CAST(date_trunc('hour', "timestamp") AS TIMESTAMP) AS revenue_hour,
       COUNT(*) AS purchase_count, round(SUM(amount), 2) AS total_revenue
FROM log WHERE event_type = 'purchase' GROUP BY 1"""


_COHORTS_KEEP_NULL = """
SELECT strftime(first_at, '%Y-%m-%d') AS cohort_day, COUNT(user_id) AS user_count
FROM (SELECT user_id, MIN("timestamp") AS first_at FROM log GROUP BY user_id)
GROUP BY 1"""

_FUNNEL_USERS = """
SELECT event_type AS stage, COUNT(DISTINCT user_id) AS user_count FROM log GROUP BY event_type"""

# K-means from the same stated start: three means drawn by hash races with ten seeds, moved until they
# stay, the best of the ten, segments in order of spend. Spend counts by millionths.
_SEGMENTS = f"""
WITH RECURSIVE features AS ({_FEATURES}),
points AS (
  SELECT frequency AS f, CAST(round(coalesce(monetary, 0) * 1000000) AS BIGINT) AS m,
         COUNT(*) AS w, COUNT(monetary) AS paid
  FROM features GROUP BY ALL),
spreads AS (
  SELECT CASE WHEN vf = 0 THEN 1 ELSE sqrt(vf) END AS f, CASE WHEN vm = 0 THEN 1 ELSE sqrt(vm) END AS m
  FROM (SELECT CAST(n * ff - sf * sf AS DOUBLE) / CAST(n * n AS DOUBLE) AS vf,
               CAST(n * mm - sm * sm AS DOUBLE) / CAST(n * n AS DOUBLE) AS vm
        FROM (SELECT SUM(w) AS n, SUM(f * w) AS sf, SUM(m * w) AS sm, SUM(f::HUGEINT * f * w) AS ff,
                     SUM(m::HUGEINT * m * w) AS mm FROM points))),
draws AS (
  SELECT seed, 0 AS i, CAST([] AS STRUCT(f DOUBLE, m DOUBLE)[]) AS means
  FROM (SELECT unnest(range(42, 52)) AS seed)
  UNION ALL
  SELECT seed, i + 1, list_append(means, arg_min({{'f': f, 'm': m}}, -ln(uniform) / rate) FILTER (rate > 0))
  FROM (
    SELECT seed, i, means, CAST(p.f AS DOUBLE) AS f, CAST(p.m AS DOUBLE) AS m,
           (CAST('0x' || substr(md5(concat_ws(':', seed, i, p.f, p.m)), 1, 13) AS BIGINT) + 1) / 2.0 ** 52
             AS uniform,
           p.w * CASE WHEN i = 0 THEN 1 ELSE list_min(list_transform(means, lambda c:
             ((p.f - c.f) / s.f) * ((p.f - c.f) / s.f) + ((p.m - c.m) / s.m) * ((p.m - c.m) / s.m))) END AS rate
    FROM draws, points p, spreads s WHERE i < 3)
  GROUP BY seed, i, means),
moves AS (
  SELECT seed, 0 AS step, means, CAST(NULL AS STRUCT(f DOUBLE, m DOUBLE)[]) AS before FROM draws WHERE i = 3
  UNION ALL
  SELECT seed, step + 1,
         list_transform([1, 2, 3], lambda j: CASE WHEN sums[j].w > 0
           THEN {{'f': sums[j].f::DOUBLE / sums[j].w, 'm': sums[j].m::DOUBLE / sums[j].w}} ELSE means[j] END),
         means
  FROM (
    SELECT seed, step, means, [
      {{'w': SUM(w) FILTER (c = 1), 'f': SUM(f * w) FILTER (c = 1), 'm': SUM(m * w) FILTER (c = 1)}},
      {{'w': SUM(w) FILTER (c = 2), 'f': SUM(f * w) FILTER (c = 2), 'm': SUM(m * w) FILTER (c = 2)}},
      {{'w': SUM(w) FILTER (c = 3), 'f': SUM(f * w) FILTER (c = 3), 'm': SUM(m * w) FILTER (c = 3)}}] AS sums
    FROM (
      SELECT seed, step, means, f, m, w, list_position(distances, list_min(distances)) AS c
      FROM (
        SELECT seed, step, means, p.f, p.m, p.w, list_transform(means, lambda c:
          ((p.f - c.f) / s.f) * ((p.f - c.f) / s.f) + ((p.m - c.m) / s.m) * ((p.m - c.m) / s.m)) AS distances
        FROM moves, points p, spreads s WHERE means IS DISTINCT FROM before AND step < 300))
    GROUP BY seed, step, means)),
placed AS (
  SELECT seed, f, m, w, paid, list_position(distances, list_min(distances)) AS c
  FROM (
    SELECT seed, p.*, list_transform(means, lambda c:
      ((p.f - c.f) / s.f) * ((p.f - c.f) / s.f) + ((p.m - c.m) / s.m) * ((p.m - c.m) / s.m)) AS distances
    FROM (SELECT seed, arg_max(means, step) AS means FROM moves GROUP BY seed), points p, spreads s)),
clusters AS (
  SELECT seed, c, SUM(w) AS w, SUM(f * w) AS f, SUM(m * w) AS m, SUM(paid) AS paid FROM placed GROUP BY ALL),
best AS (
  SELECT seed FROM clusters, spreads s GROUP BY seed
  ORDER BY SUM(((clusters.f / w / s.f) ** 2 + (clusters.m / w / s.m) ** 2) * w) DESC, seed LIMIT 1),
ranked AS (
  SELECT c, row_number() OVER (ORDER BY paid = 0, m::DOUBLE / nullif(paid, 0), f::DOUBLE / w) AS rank
  FROM clusters WHERE seed = (SELECT seed FROM best)),
segments AS (
  SELECT u.user_id, u.frequency, u.monetary, CAST(rank - 1 AS INTEGER) AS segment_id,
         ['Low Value', 'Medium Value', 'High Value'][rank] AS segment_label
  FROM features u
  JOIN placed p ON p.seed = (SELECT seed FROM best) AND p.f = u.frequency
    AND p.m = CAST(round(coalesce(u.monetary, 0) * 1000000) AS BIGINT)
  JOIN ranked USING (c))
"""

# What a proper K-means result over all users shows; see segment_check.
_SEGMENT_CHECK = f"""
SELECT COUNT(*) AS users, CAST(3 AS BIGINT) AS segments, round(SUM(monetary), 2) AS spend,
       CAST(0 AS BIGINT) AS misplaced, CAST(0 AS BIGINT) AS disordered
FROM ({_FEATURES})"""

_KPI = """
SELECT COUNT(DISTINCT user_id) AS total_users, COALESCE(round(SUM(amount), 2), 0.0)
         AS total_revenue,
       COUNT(*) AS total_events
FROM log"""

_TOP = f"""
SELECT CAST(row_number() OVER (ORDER BY total_ltv DESC, user_id) AS INTEGER) AS rank,
       user_id, total_ltv
FROM ({_LTV_BASIC}) ORDER BY total_ltv DESC, user_id LIMIT 5"""

_CHURN_SUMMARY = f"""
SELECT CAST(COALESCE(SUM(is_at_risk), 0) AS BIGINT) AS at_risk_count,
       COUNT(*) AS total_evaluated,
       COALESCE(round(CAST(SUM(is_at_risk) AS DOUBLE) * 100.0 / NULLIF(COUNT(*), 0), 2), 0.0)
         AS churn_rate
FROM ({_CHURN_RISK})"""

_CONVERSION = """
SELECT round(CAST(COUNT(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS DOUBLE)
             * 100.0
             / NULLIF(COUNT(DISTINCT CASE WHEN event_type = 'login' THEN user_id END), 0), 2)
         AS conversion_rate
FROM log"""

_FEATURES_SCALED = f"""
SELECT user_id,
       round((frequency - AVG(frequency) OVER ())
             / COALESCE(NULLIF(stddev_pop(frequency) OVER (), 0), 1), 6) AS frequency_scaled,
       round((monetary - AVG(monetary) OVER ())
             / COALESCE(NULLIF(stddev_pop(monetary) OVER (), 0), 1), 6) AS monetary_scaled
FROM (SELECT user_id, frequency, COALESCE(monetary, 0) AS monetary FROM ({_FEATURES}))"""

#: Tables of the runs: SQL, and the columns in order of name with how they are shown as text.
_TABLES = {
    "ltv_metrics": (_LTV_BASIC, "event_count total_ltv:money user_id"),
    "ltv_detail": (
        _LTV_DETAIL,
        "avg_order_value:money customer_lifespan_days first_order_date:time last_order_date:time "
        "total_ltv:money total_orders user_id",
    ),
    "retention_metrics": (_RETENTION, "retained_users retention_rate:money total_users"),
    "cohort_metrics": (_COHORTS, "cohort_day user_count"),
    "cohort_metrics_keep_null_day": (_COHORTS_KEEP_NULL, "cohort_day user_count"),
    "funnel_metrics": (_FUNNEL_FIXED, "stage user_count"),
    "funnel_observed": (_FUNNEL_USERS, "stage user_count"),
    "funnel_volume": (_FUNNEL_VOLUME, "stage total_events unique_users"),
    "user_daily_activity": (
        _DAILY_ACTIVITY, "active_days first_active:time last_active:time user_id"
    ),
    "revenue_trend": (_REVENUE, "purchase_count revenue_hour:time total_revenue:money"),
    "churn_metrics": (_CHURN_RISK, "event_count is_at_risk purchase_count user_id"),
    "user_segments": (_SEGMENT_CHECK, "disordered misplaced segments spend:money users"),
}
_PARTS = {
    "stats": (_KPI, "total_events total_revenue:money total_users"),
    "top_customers": (_TOP, "rank total_ltv:money user_id"),
    "funnel": (f"SELECT upper(stage) AS stage, user_count FROM ({_FUNNEL_FIXED})", "stage user_count"),
    "conversion": (_CONVERSION, "conversion_rate:money"),
    "segments": (
        f"SELECT CAST(3 AS BIGINT) AS segments, COUNT(*) AS users FROM ({_FEATURES})", "segments users"
    ),
    "cohorts": (_COHORTS, "cohort_day user_count"),
    "retention": (_RETENTION, "retained_users retention_rate:money total_users"),
    "churn": (_CHURN_SUMMARY, "at_risk_count churn_rate:money total_evaluated"),
}


def _rows_as_text(name_column: str, tables: dict[str, tuple[str, str]]) -> str:
    """All rows of some tables as text, as ``_as_text`` makes it."""

    def shown(column: str) -> str:
        name, _, kind = column.partition(":")
        value = {"money": f"CAST(round({name} * 100) AS BIGINT)", "time": f"epoch_us({name})"}
        return f"COALESCE(CAST({value.get(kind, name)} AS VARCHAR), '-')"

    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS {name_column}, concat_ws('|', {', '.join(map(shown, columns.split()))}) "
        f"AS row FROM ({sql})"
        for name, (sql, columns) in tables.items()
    )


def _run_sql(*names: str) -> str:
    return _rows_as_text("table_name", {name: _TABLES[name] for name in names})


def _before(day: str, sql: str) -> str:
    return sql.replace("FROM log", f"FROM (SELECT * FROM log WHERE \"timestamp\" < '{day}') log")


def _dashboard_sql() -> str:
    """The parts read from tables show the run before the last load; the key figures show all."""
    since_run = {name: part for name, part in _PARTS.items() if name != "stats"}
    of_run = _rows_as_text("part", since_run)
    # The funnel joins the log under a short name.
    of_run = of_run.replace("JOIN log l", "JOIN (SELECT * FROM log WHERE \"timestamp\" < '2024-01-20') l")
    return _rows_as_text("part", {"stats": _PARTS["stats"]}) + "\nUNION ALL\n" + _before("2024-01-20", of_run)


def _event_sql() -> dict[str, str]:
    over_purchases = {
        "events_canonical": _AS_IT_IS,
        "csv_events_scan": _AS_IT_IS,
        "events_to_json": """
SELECT CAST(to_json({
         'user_id': user_id, 'event_type': event_type, 'amount': amount,
         'timestamp': CAST("timestamp" AS VARCHAR)}) AS VARCHAR) AS value
FROM log""",
        "events_table_load": _AS_IT_IS,
        "staged_csv_load": _AS_IT_IS,
        "stream_ingest": _AS_IT_IS,
        "events_compacted": _AS_IT_IS,
        "stream_quarantine": """
SELECT CASE event_type WHEN 'add_to_cart' THEN 'malformed' WHEN 'product_view' THEN 'missing field'
                       ELSE 'stored' END AS reason, COUNT(*) AS messages
FROM log GROUP BY 1""",
        "local_profile": _run_sql(
            "ltv_metrics", "retention_metrics", "cohort_metrics", "funnel_metrics",
            "churn_metrics", "user_segments",
        ),
        "warehouse_profile": _run_sql(
            "ltv_detail", "funnel_volume", "user_daily_activity", "revenue_trend",
            "churn_metrics", "user_segments",
        ),
        "sql_profile": _run_sql(
            "ltv_detail", "retention_metrics", "cohort_metrics_keep_null_day", "funnel_observed"
        ),
        "dashboard_parts": _dashboard_sql(),
        "customer_segments": f"SELECT * FROM ({_SEGMENTS} SELECT * FROM segments)",
        "segment_distribution": f"""
SELECT segment_label AS label, COUNT(user_id) AS count
FROM ({_SEGMENTS} SELECT * FROM segments) GROUP BY 1""",
        "segment_check": _SEGMENT_CHECK,
        "segment_model_reload": (
            f"SELECT user_id, frequency, monetary, TRUE AS same_label FROM ({_FEATURES})"
        ),
        "ltv_basic": _LTV_BASIC,
        "ltv_detail": _LTV_DETAIL,
        "user_engagement": """
SELECT user_id, COUNT(DISTINCT event_type) AS unique_actions,
       COUNT("timestamp") AS total_interactions
FROM log GROUP BY user_id""",
        "retention_summary": _RETENTION,
        "retention_row": _RETENTION,
        "user_daily_activity": _DAILY_ACTIVITY,
        "user_signup": 'SELECT user_id, MIN("timestamp") AS signup_date FROM log GROUP BY user_id',
        "cohort_daily": _COHORTS,
        "cohort_daily_keep_null_day": _COHORTS_KEEP_NULL,
        "funnel_fixed": _FUNNEL_FIXED,
        "funnel_users": _FUNNEL_USERS,
        "funnel_volume": _FUNNEL_VOLUME,
        "revenue_hourly": _REVENUE,
        "churn_risk": _CHURN_RISK,
        "segment_features": _FEATURES,
        "segment_features_scaled": _FEATURES_SCALED,
        "kpi_global": _KPI,
        "top_customers": _TOP,
        "funnel_display": f"SELECT upper(stage) AS stage, user_count FROM ({_FUNNEL_FIXED})",
        "churn_summary": _CHURN_SUMMARY,
        "conversion_rate": _CONVERSION,
    }
    over_daily = {
        "daily_retention": _RETENTION,
        "daily_cohorts": _COHORTS,
        "daily_churn_summary": _CHURN_SUMMARY,
        "daily_churn_risk": _CHURN_RISK,
        "daily_conversion": _CONVERSION,
        "daily_ltv_detail": _LTV_DETAIL,
        "daily_features": _FEATURES,
        "daily_features_scaled": _FEATURES_SCALED,
    }
    over_all = {"ltv_basic_all_amounts": _LTV_BASIC}
    logs = ((_PURCHASE_AMOUNTS, over_purchases), (_ALL_AMOUNTS, over_all), (_DAILY_USERS, over_daily))
    return {key: log + sql for log, over in logs for key, sql in over.items()}
