"""Queries over the driver tables, one per operator, each with equivalent SQL where SQL can express it.

``events`` stands in for the usage log (user = key, event type = category, value in cents = measure, day = date) and
``orders`` for the order-grained variant. Measures are integer cents, so sums do not depend on their order.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow import schemas
from tierflow.functions.recode import recode_with_table
from tierflow.operators import pivot, quality, ranking, rfm
from tierflow.operators.enrich import hot_key_lookup, left_lookup
from tierflow.plans import layers
from tierflow.plans.config import APP_NAMES, LayerConfig
from tierflow.plans.player_log import player_sessions
from tierflow.plans.run import run
from tierflow.runtime import delete_path, local_frame, materialize, scratch_path, session_conf
from tierflow.sinks.buckets import save_layers_bucketed
from tierflow.sinks import catalog, maintenance, partitions
from tierflow.sinks import snapshots as sink
from tierflow.sinks.lake import Lake, read_snapshot
from tierflow.sources import (
    catalog_table,
    flatten_hits,
    infer_json_lines,
    on_days,
    parse_keyed_tsv,
    read_date_range,
    read_json_logs,
    read_player_log,
    read_table,
    read_text_lines,
    split_corrupt,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

EVENT_MAPPING = {
    "view": "TVDuration",
    "click": "MovieDuration",
    "purchase": "SportDuration",
    "signup": "ChildDuration",
}
EVENTS = LayerConfig(report_date=dt.date(2024, 2, 1), mapping=EVENT_MAPPING)
ORDER_REPORT_DATE = dt.date(2001, 8, 2)
PRIORITY_TARGETS = {
    "UrgentCents": ["1-URGENT", "2-HIGH"],
    "NormalCents": ["3-MEDIUM"],
    "LowCents": ["4-NOT SPECIFIED", "5-LOW"],
}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# ---------------------------------------------------------------------------------------------------------------------
# Inputs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in the shape of the bronze table."""
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("Index"),
        F.lit("_doc").alias("Type"),
        F.col("event_id").cast("string").alias("Id"),
        F.length("props").cast("bigint").alias("Score"),
        F.col("event_type").alias("AppName"),
        F.col("user_id").cast("string").alias("Contract"),
        F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("Mac"),
        F.round(F.col("value") * 100).cast("bigint").alias("TotalDuration"),
        F.to_date("ts").alias("Date"),
    )


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("Contract"),
        F.col("o_orderpriority").alias("AppName"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("TotalDuration"),
        F.to_date("o_orderdate").alias("Date"),
    )


def new_lake(spark: SparkSession) -> Lake:
    """An empty lake in the shared scratch folder, with its own database."""
    return Lake(spark, scratch_path(spark, "lake"), database=f"tierflow_{uuid.uuid4().hex[:12]}")


BRONZE_SQL = """
SELECT 'events' AS "Index", '_doc' AS "Type", CAST(event_id AS VARCHAR) AS "Id",
       CAST(length(props) AS BIGINT) AS "Score", event_type AS "AppName",
       CAST(user_id AS VARCHAR) AS "Contract", 'M' || CAST(user_id AS VARCHAR) AS "Mac",
       CAST(round(value * 100) AS BIGINT) AS "TotalDuration", CAST(ts AS DATE) AS "Date"
FROM events
"""


def typed_sql(rows: str, mapping: Mapping[str, str]) -> str:
    cases = " ".join(f"WHEN '{source}' THEN '{target}'" for source, target in mapping.items())
    return f"""SELECT *, CASE "AppName" {cases} ELSE 'Unknown' END AS "Label" FROM ({rows}) b"""


def usable_sql(typed: str) -> str:
    return f"""
SELECT "Contract", "TotalDuration", "Label" FROM ({typed}) t
WHERE "Contract" <> '0' AND "Label" <> 'Unknown' AND "TotalDuration" > 0
"""


def _sum_sql(target: str) -> str:
    return f"""CAST(sum("TotalDuration") FILTER ("Label" = '{target}') AS BIGINT) AS "{target}\""""


def pivot_sql(usable: str) -> str:
    return f"""
SELECT "Contract", {", ".join(_sum_sql(c) for c in schemas.DURATION_COLUMNS)}
FROM ({usable}) u GROUP BY "Contract"
"""


def silver_sql(pivoted: str) -> str:
    """Rank the five columns of each row: value descending with nulls last, then label descending."""
    return f"""
WITH p AS ({pivoted}),
long AS (
  {" UNION ALL ".join(f'SELECT "Contract", "{c}" AS v, ' + f"'{c[:-8]}' AS k FROM p" for c in schemas.DURATION_COLUMNS)}
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY "Contract" ORDER BY v DESC NULLS LAST, k DESC) AS rn FROM long
)
SELECT p.*,
       (SELECT max(k) FROM ranked r WHERE r."Contract" = p."Contract" AND rn = 1) AS "MostWatch",
       (SELECT max(k) FROM ranked r WHERE r."Contract" = p."Contract" AND rn = 2 AND v IS NOT NULL) AS "SecondMostWatch",
       (SELECT max(k) FROM ranked r WHERE r."Contract" = p."Contract" AND rn = 3 AND v IS NOT NULL) AS "ThirdMostWatch"
FROM p
"""


def metrics_sql(rows: str, report: str, total: str | None = None) -> str:
    total = total or f'(SELECT count(DISTINCT "Date") FROM ({rows}) d)'
    return f"""
SELECT "Contract", CAST(date_diff('day', max("Date"), DATE '{report}') AS INTEGER) AS "Recency",
       round(count(DISTINCT "Date") / CAST({total} AS DOUBLE) * 100, 2) AS "Frequency",
       CAST(sum("TotalDuration") AS BIGINT) AS "MonetaryDuration"
FROM ({rows}) r WHERE "Contract" IS NOT NULL GROUP BY "Contract"
"""


def scores_sql(metrics: str, buckets: int = 4, partition: str = "") -> str:
    scored = ", ".join(
        f'CAST(ntile({buckets}) OVER ({partition} ORDER BY "{m}" ASC NULLS FIRST, "Contract" ASC) AS INTEGER) AS "{s}"'
        for m, s in zip(rfm.METRICS, rfm.SCORES)
    )
    return f"SELECT *, {scored} FROM ({metrics}) m"


ORDERS_SQL = """
SELECT o_custkey AS "Contract", o_orderpriority AS "AppName",
       CAST(round(o_totalprice * 100) AS BIGINT) AS "TotalDuration", CAST(o_orderdate AS DATE) AS "Date"
FROM orders
"""

EVENT_SCORES_SQL = scores_sql(metrics_sql(BRONZE_SQL, "2024-02-01"))


def gold_sql(silver: str, scores: str) -> str:
    return f"""
SELECT s.*, r."RecencyScore", r."FrequencyScore", r."MonetaryDurationScore"
FROM ({silver}) s JOIN ({scores}) r ON s."Contract" = r."Contract"
"""


TYPED_SQL = typed_sql(BRONZE_SQL, EVENT_MAPPING)
USABLE_SQL = usable_sql(TYPED_SQL)
PIVOT_SQL = pivot_sql(USABLE_SQL)
SILVER_SQL = silver_sql(PIVOT_SQL)
GOLD_SQL = gold_sql(SILVER_SQL, EVENT_SCORES_SQL)


# ---------------------------------------------------------------------------------------------------------------------
# Projections and filters


@query("bronze_projection", BRONZE_SQL)
def bronze_projection(spark, sf_dir):
    return bronze_events(spark, sf_dir)


@query("distinct_categories", 'SELECT DISTINCT event_type AS "AppName" FROM events')
def distinct_categories(spark, sf_dir):
    return bronze_events(spark, sf_dir).select("AppName").distinct()


@query("recode_usable_rows", USABLE_SQL)
def recode_usable_rows(spark, sf_dir):
    return layers.categorized(bronze_events(spark, sf_dir), EVENTS, alias="Label")


@query(
    "recode_by_table",
    """
SELECT o_orderkey, coalesce(c_mktsegment, 'Unknown') AS segment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""",
)
def recode_by_table(spark, sf_dir):
    """Recoding through a mapping table: customer key to market segment."""
    mapping = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return recode_with_table(orders, "o_custkey", mapping, "c_custkey", "c_mktsegment", "segment").select("o_orderkey", "segment")


@query("date_range_scan", f"""SELECT * FROM ({BRONZE_SQL}) b WHERE "Date" BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'""")
def date_range_scan(spark, sf_dir):
    """Range read of a table partitioned by date."""
    path = scratch_path(spark, "by-date")
    sink.write_files(bronze_events(spark, sf_dir), path, partition_by=["Date"], layout=sink.Layout(compact=True))
    return read_date_range(spark, path, "2024-01-05", "2024-01-12").select(*schemas.BRONZE.fieldNames())


@query("calendar_days_scan", f"""SELECT * FROM ({BRONZE_SQL}) b WHERE dayofweek("Date") IN (0, 6)""")
def calendar_days_scan(spark, sf_dir):
    """The partitions of the days that a filter on a calendar table leaves."""
    path, calendar = scratch_path(spark, "by-date"), scratch_path(spark, "calendar")
    rows = bronze_events(spark, sf_dir)
    sink.write_files(rows, path, partition_by=["Date"], layout=sink.Layout(compact=True))
    rows.select(F.col("Date").alias("day")).distinct().withColumn("weekday", F.dayofweek("day")).write.parquet(calendar)
    weekends = read_table(spark, calendar).filter(F.col("weekday").isin(1, 7))
    return on_days(read_table(spark, path), weekends).select(*schemas.BRONZE.fieldNames())


@query("missing_files_ignored", f"""SELECT * FROM ({BRONZE_SQL}) b WHERE "Date" <> DATE '2024-01-10'""")
def missing_files_ignored(spark, sf_dir):
    """A scan planned before one of its directories goes away."""
    path = scratch_path(spark, "by-date")
    sink.write_files(bronze_events(spark, sf_dir), path, partition_by=["Date"], layout=sink.Layout(compact=True))
    rows = read_table(spark, path, ignore_missing=True).select(*schemas.BRONZE.fieldNames())
    delete_path(spark, f"{path}/Date=2024-01-10")
    return rows


@query(
    "orc_by_path",
    f"""SELECT "AppName", count(*) AS "rows", CAST(sum("TotalDuration") AS BIGINT) AS total FROM ({BRONZE_SQL}) b GROUP BY "AppName\"""",
)
def orc_by_path(spark, sf_dir):
    """Another file format read by its path, and queried through a temporary view."""
    path = scratch_path(spark, "orc")
    sink.write_files(bronze_events(spark, sf_dir), path, fmt="orc")
    view = f"events_{uuid.uuid4().hex}"
    catalog.register_temp_view(read_table(spark, path, fmt="orc"), view)
    return spark.sql(f"SELECT AppName, count(*) AS rows, sum(TotalDuration) AS total FROM {view} GROUP BY AppName")


# ---------------------------------------------------------------------------------------------------------------------
# Pivots and per-row rankings


@query("category_pivot_events", PIVOT_SQL)
def category_pivot_events(spark, sf_dir):
    usable = layers.categorized(bronze_events(spark, sf_dir), EVENTS)
    return pivot.category_pivot(usable, "Contract", "Type", "TotalDuration", schemas.DURATION_COLUMNS)


@query(
    "category_pivot_orders",
    f"""
SELECT "Contract",
       CAST(sum("TotalDuration") FILTER ("AppName" IN ('1-URGENT', '2-HIGH')) AS BIGINT) AS "UrgentCents",
       CAST(sum("TotalDuration") FILTER ("AppName" = '3-MEDIUM') AS BIGINT) AS "NormalCents",
       CAST(sum("TotalDuration") FILTER ("AppName" IN ('4-NOT SPECIFIED', '5-LOW')) AS BIGINT) AS "LowCents"
FROM ({ORDERS_SQL}) o GROUP BY "Contract" ORDER BY "UrgentCents" DESC NULLS LAST, "Contract"
""",
)
def category_pivot_orders(spark, sf_dir):
    pivoted = pivot.grouped_pivot(customer_orders(spark, sf_dir), "Contract", "AppName", "TotalDuration", PRIORITY_TARGETS)
    return pivot.ordered_by(pivoted, "UrgentCents", "Contract")


def _zero_sum_sql(source: str, target: str) -> str:
    return f"""CAST(sum(CASE WHEN "AppName" = '{source}' THEN "TotalDuration" ELSE 0 END) AS BIGINT) AS "{target}\""""


@query(
    "conditional_pivot_zero",
    f"""
SELECT "Contract", {", ".join(_zero_sum_sql(s, t) for s, t in EVENT_MAPPING.items())}, CAST(0 AS BIGINT) AS "RelaxDuration"
FROM ({BRONZE_SQL}) b GROUP BY "Contract" ORDER BY "TVDuration" DESC, "Contract"
""",
)
def conditional_pivot_zero(spark, sf_dir):
    pivoted = pivot.conditional_pivot(
        bronze_events(spark, sf_dir), "Contract", "AppName", "TotalDuration", EVENTS.targets, fill=0
    )
    return pivot.ordered_by(pivoted, "TVDuration", "Contract")


@query("top3_categories", SILVER_SQL)
def top3_categories(spark, sf_dir):
    """Watch time per key and category with the three largest categories."""
    return layers.silver(bronze_events(spark, sf_dir), EVENTS)


_FILLED = {c: f'coalesce("{c}", 0)' for c in EVENTS.ranked}


@query(
    "argmax_category",
    f"""
SELECT "Contract", {", ".join(f'{v} AS "{c}"' for c, v in _FILLED.items())},
       CASE {" ".join(f"WHEN {v} = greatest({', '.join(_FILLED.values())}) THEN '{EVENTS.ranked[c]}'" for c, v in _FILLED.items())}
       ELSE 'Error' END AS "MostWatch"
FROM ({PIVOT_SQL}) p
""",
)
def argmax_category(spark, sf_dir):
    pivoted = category_pivot_events(spark, sf_dir).na.fill(0, subset=list(EVENTS.columns))
    return pivoted.select("Contract", *EVENTS.ranked, ranking.argmax_column(EVENTS.ranked).alias("MostWatch"))


# ---------------------------------------------------------------------------------------------------------------------
# Recency, frequency, monetary


@query("period_days", f"""SELECT count(DISTINCT "Date") AS period_days FROM ({BRONZE_SQL}) b""")
def period_days(spark, sf_dir):
    return rfm.period_days(bronze_events(spark, sf_dir), "Date")


@query("rfm_metrics_events", metrics_sql(BRONZE_SQL, "2024-02-01"))
def rfm_metrics_events(spark, sf_dir):
    """One month of days: counted as bits."""
    rows = bronze_events(spark, sf_dir)
    period = rfm.date_bounds(rows, "Date")
    return rfm.rfm_metrics(rows, "Contract", "Date", "TotalDuration", EVENTS.report_date, period=period)


@query("rfm_metrics_customers", metrics_sql(ORDERS_SQL, "2001-08-02"))
def rfm_metrics_customers(spark, sf_dir):
    """Six years of days: listed per customer."""
    rows = customer_orders(spark, sf_dir)
    return rfm.rfm_metrics(rows, "Contract", "Date", "TotalDuration", ORDER_REPORT_DATE, period=rfm.date_bounds(rows, "Date"))


@query("rfm_metrics_fixed_period", metrics_sql(BRONZE_SQL, "2024-02-01", total="30"))
def rfm_metrics_fixed_period(spark, sf_dir):
    return rfm.rfm_metrics(
        bronze_events(spark, sf_dir), "Contract", "Date", "TotalDuration", "20240201", total_days=30
    )


@query(
    "activeness",
    f"""
SELECT "Contract", CAST(count(DISTINCT "Date") / CAST(30 AS DOUBLE) AS FLOAT) AS "Activeness"
FROM ({BRONZE_SQL}) b GROUP BY "Contract"
""",
)
def activeness(spark, sf_dir):
    rows = bronze_events(spark, sf_dir)
    return rfm.activeness(rows, "Contract", "Date", period=rfm.date_bounds(rows, "Date"))


@query(
    "activeness_customers",
    f"""
SELECT "Contract", CAST(count(DISTINCT "Date") / CAST(2405 AS DOUBLE) AS FLOAT) AS "Activeness"
FROM ({ORDERS_SQL}) o GROUP BY "Contract"
""",
)
def activeness_customers(spark, sf_dir):
    """Share of the days of six years on which a customer ordered, with one exchange on the customer."""
    rows = customer_orders(spark, sf_dir)
    return rfm.activeness(rows, "Contract", "Date", days=2405, period=rfm.date_bounds(rows, "Date"))


@query("rfm_scores_global", EVENT_SCORES_SQL)
def rfm_scores_global(spark, sf_dir):
    rows = bronze_events(spark, sf_dir)
    return layers.rfm_table(rows, EVENTS, rfm.date_bounds(rows, "Date"))


@query("rfm_scores_exact", scores_sql(metrics_sql(ORDERS_SQL, "2001-08-02")))
def rfm_scores_exact(spark, sf_dir):
    """Scores over six years of orders."""
    metrics = materialize(rfm_metrics_customers(spark, sf_dir))
    return rfm.score(metrics, "Contract")


SEGMENT_METRICS_SQL = f"""
SELECT m.*, c_mktsegment AS segment FROM ({metrics_sql(ORDERS_SQL, "2001-08-02")}) m
JOIN customer ON m."Contract" = c_custkey
"""


def _segment_metrics(spark, sf_dir) -> DataFrame:
    segments = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Contract"), F.col("c_mktsegment").alias("segment")
    )
    return materialize(rfm_metrics_customers(spark, sf_dir).join(segments, "Contract"))


@query("rfm_scores_by_segment", scores_sql(SEGMENT_METRICS_SQL, 4, "PARTITION BY segment"))
def rfm_scores_by_segment(spark, sf_dir):
    return rfm.score(_segment_metrics(spark, sf_dir), "Contract", partition_by=["segment"])


@query("rfm_scores_hot_segment", scores_sql(SEGMENT_METRICS_SQL, 10, "PARTITION BY segment"))
def rfm_scores_hot_segment(spark, sf_dir):
    """Deciles per segment with segments that exceed one task."""
    return rfm.score(
        _segment_metrics(spark, sf_dir), "Contract", buckets=10, partition_by=["segment"]
    )


@query("rfm_scores_within_key", scores_sql(metrics_sql(BRONZE_SQL, "2024-02-01"), 3, 'PARTITION BY "Contract"'))
def rfm_scores_within_key(spark, sf_dir):
    return rfm.score(materialize(rfm_metrics_events(spark, sf_dir)), "Contract", buckets=3, partition_by=["Contract"])


# ---------------------------------------------------------------------------------------------------------------------
# Layers


def event_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bronze_events(spark, sf_dir)
    return layers.profile(rows, EVENTS, rfm.date_bounds(rows, "Date"))


@query("gold_profile", GOLD_SQL)
def gold_profile(spark, sf_dir):
    """Gold from one scan and one aggregation."""
    return layers.gold_of(event_profile(spark, sf_dir), EVENTS)


@query("gold_join", GOLD_SQL)
def gold_join(spark, sf_dir):
    """Gold as the join of separately built silver and rfm tables."""
    rows = bronze_events(spark, sf_dir)
    return layers.gold(layers.silver(rows, EVENTS), layers.rfm_table(rows, EVENTS), EVENTS)


@query("bucketed_gold_join", GOLD_SQL)
def bucketed_gold_join(spark, sf_dir):
    """The same from silver and rfm tables that are stored in buckets of the key: the join reads them side by side."""
    rows = bronze_events(spark, sf_dir)
    lake = new_lake(spark)
    built = {"silver": layers.silver(rows, EVENTS), "rfm": layers.rfm_table(rows, EVENTS, rfm.date_bounds(rows, "Date"))}
    stored = save_layers_bucketed(spark, lake.database, lake.base, built, EVENTS.key, buckets=8)
    return layers.gold(stored["silver"], stored["rfm"], EVENTS)


@query(
    "silver_activeness",
    f"""
SELECT s.*, a."Activeness" FROM ({SILVER_SQL}) s JOIN ({ORACLES["activeness"]}) a ON s."Contract" = a."Contract"
""",
)
def silver_activeness(spark, sf_dir):
    return bronze_events(spark, sf_dir).transform(layers.silver, EVENTS).join(activeness(spark, sf_dir), "Contract")


def _codes(spark, sf_dir, statement: str) -> DataFrame:
    lake = new_lake(spark)
    sink.publish(lake, gold_profile(spark, sf_dir), "gold", rules=quality.RULES["gold"])
    return spark.sql(statement.format(gold=f"{lake.database}.gold"))


RFM_CODE_STATEMENT = """
WITH coded AS (
  SELECT Contract, concat({scores}) AS rfm_score FROM {{gold}}
)
SELECT Contract, rfm_score FROM coded WHERE rfm_score NOT LIKE '111'
"""


def _code_oracle(*scores: str) -> str:
    code = " || ".join(f'CAST("{s}" AS VARCHAR)' for s in scores)
    return f"""SELECT * FROM (SELECT "Contract", {code} AS rfm_score FROM ({GOLD_SQL}) g) c WHERE rfm_score NOT LIKE '111'"""


@query("rfm_code_sql", _code_oracle(*rfm.SCORES))
def rfm_code_sql(spark, sf_dir):
    """SQL over the published gold table: scores as a code, without the lowest code."""
    return _codes(spark, sf_dir, RFM_CODE_STATEMENT.format(scores=", ".join(rfm.SCORES)))


@query("rfm_code_frequency_twice", _code_oracle("FrequencyScore", "FrequencyScore", "MonetaryDurationScore"))
def rfm_code_frequency_twice(spark, sf_dir):
    """The code with the frequency score in the first two places."""
    scores = "FrequencyScore, FrequencyScore, MonetaryDurationScore"
    return _codes(spark, sf_dir, RFM_CODE_STATEMENT.format(scores=scores))


@query("rfm_code_columns", _code_oracle(*rfm.SCORES))
def rfm_code_columns(spark, sf_dir):
    coded = gold_profile(spark, sf_dir).select("Contract", rfm.rfm_code().alias("rfm_score"))
    return coded.filter(rfm.exclude_code("rfm_score"))


@query(
    "user_lookup_left",
    """
SELECT event_id, user_id, event_type, c_name, c_mktsegment
FROM events LEFT JOIN customer ON user_id = c_custkey
""",
)
def user_lookup_left(spark, sf_dir):
    """Left lookup in the whole table by the repeated user key."""
    users = table(spark, sf_dir, "customer")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return left_lookup(events, users, "user_id", "c_custkey", ["c_name", "c_mktsegment"])


@query(
    "hot_user_lookup",
    """
SELECT event_id, payer, c_name, c_mktsegment
FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN 1 WHEN event_type <> 'click' THEN user_id END AS payer FROM events) e
LEFT JOIN customer ON payer = c_custkey
""",
)
def hot_user_lookup(spark, sf_dir):
    """Lookup by a key that stands for one user in all views and is missing for clicks: both are dealt over several tasks."""
    users = table(spark, sf_dir, "customer")
    payer = F.when(F.col("event_type") == "view", F.lit(1).cast("bigint")).when(F.col("event_type") != "click", F.col("user_id"))
    events = table(spark, sf_dir, "events").select("event_id", payer.alias("payer"))
    return hot_key_lookup(events, users, "payer", "c_custkey", ["c_name", "c_mktsegment"])


# ---------------------------------------------------------------------------------------------------------------------
# Raw sources, written from the events first


def _write_hits(spark, sf_dir, broken=None, rows=None) -> str:
    """The events, or other bronze ``rows``, as nested JSON lines below one folder per day; lines matching ``broken`` lose their second half."""
    path = scratch_path(spark, "hits")
    rows = bronze_events(spark, sf_dir) if rows is None else rows
    hit = F.to_json(
        F.struct(
            F.col("Id").alias("_id"),
            F.col("Index").alias("_index"),
            F.col("Score").alias("_score"),
            F.struct("AppName", "Contract", "Mac", "TotalDuration").alias("_source"),
            F.col("Type").alias("_type"),
        )
    )
    if broken is not None:
        hit = F.when(broken, F.left(hit, (F.length(hit) / 2).cast("int"))).otherwise(hit)
    lines = rows.select(hit.alias("value"), F.date_format("Date", "yyyyMMdd").alias("day"))
    with session_conf(spark, {"spark.sql.maxConcurrentOutputFileWriters": "64"}):  # no sort of the lines by day
        lines.write.partitionBy("day").text(path)
    return path


HIT_READ = {"glob": "part-*", "recursive": True}
HIT_FLATTEN = {"date_pattern": r"day=(\d{8})", "whole_path": True}


@query("json_logs_roundtrip", BRONZE_SQL)
def json_logs_roundtrip(spark, sf_dir):
    hits = read_json_logs(spark, _write_hits(spark, sf_dir), keep_corrupt=False, **HIT_READ)
    return flatten_hits(hits, **HIT_FLATTEN)


@query(
    "json_inferred_schema",
    """
SELECT CAST(event_id AS VARCHAR) AS "Id", event_type AS "AppName", CAST(user_id AS VARCHAR) AS "Contract",
       CAST(round(value * 100) AS BIGINT) AS "TotalDuration", CAST(ts AS DATE) AS "Date" FROM events
""",
)
def json_inferred_schema(spark, sf_dir):
    hits = read_json_logs(spark, _write_hits(spark, sf_dir), schema=None, **HIT_READ)
    return flatten_hits(hits, **HIT_FLATTEN).select("Id", "AppName", "Contract", "TotalDuration", "Date")


@query(
    "json_variant_schema",
    """
SELECT CAST(event_id AS VARCHAR) AS "Id", CAST(user_id AS BIGINT) AS "Contract",
       CASE event_type WHEN 'view' THEN CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)
                       WHEN 'click' THEN 'n/a'
                       WHEN 'purchase' THEN '{"cents":' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || '}'
       END AS "Total",
       CASE event_type WHEN 'signup' THEN event_type END AS "Tag", CAST(NULL AS VARCHAR) AS "_corrupt_record"
FROM events WHERE event_type <> 'error'
UNION ALL
SELECT NULL, NULL, NULL, NULL, left('{"Id":"' || CAST(event_id AS VARCHAR) || '","Contract":', 10)
FROM events WHERE event_type = 'error'
""",
)
def json_variant_schema(spark, sf_dir):
    """Lines of four shapes: one field is a number, a text, an object or absent; lines of errors are cut."""
    rows = bronze_events(spark, sf_dir)
    of_type = {name: F.col("AppName") == name for name in ("view", "click", "purchase", "signup", "error")}
    known = F.struct("Id", F.col("Contract").cast("bigint").alias("Contract"))
    cents = F.col("TotalDuration")
    line = (
        F.when(of_type["view"], F.to_json(F.struct(known["Id"], known["Contract"], cents.alias("Total"))))
        .when(of_type["click"], F.to_json(F.struct(known["Id"], known["Contract"], F.lit("n/a").alias("Total"))))
        .when(of_type["purchase"], F.to_json(F.struct(known["Id"], known["Contract"], F.struct(cents.alias("cents")).alias("Total"))))
        .when(of_type["signup"], F.to_json(F.struct(known["Id"], known["Contract"], F.array("AppName").alias("Tags"))))
        .otherwise(F.left(F.to_json(known), F.lit(10)))
    )
    path = scratch_path(spark, "shapes")
    rows.select(line.alias("value")).write.text(path)
    found = infer_json_lines(spark, path, glob="part-*")
    tag = F.array_join("Tags", ",").alias("Tag")
    return found.select("Id", "Contract", "Total", tag, schemas.CORRUPT_COLUMN)


@query(
    "json_corrupt_lines",
    f"""
SELECT "Date", count(*) FILTER ("AppName" <> 'error') AS parsed, count(*) FILTER ("AppName" = 'error') AS corrupt
FROM ({BRONZE_SQL}) b GROUP BY "Date"
""",
)
def json_corrupt_lines(spark, sf_dir):
    """Lines that do not parse are set apart with their date."""
    hits = read_json_logs(spark, _write_hits(spark, sf_dir, F.col("AppName") == "error"), **HIT_READ)
    good, bad = split_corrupt(materialize(flatten_hits(hits, **HIT_FLATTEN)))
    both = good.select("Date", F.lit(1).alias("ok")).unionByName(bad.select("Date", F.lit(0).alias("ok")))
    return both.groupBy("Date").agg(
        F.count_if(F.col("ok") == 1).alias("parsed"), F.count_if(F.col("ok") == 0).alias("corrupt")
    )


PLAYER_LOG_SQL = """
SELECT 'M' || CAST(user_id AS VARCHAR) AS "Mac", strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS "SessionMainMenu",
       CAST(event_id AS VARCHAR) AS "LogId",
       CASE WHEN event_type = 'error' THEN 'it''s a "' || event_type || '"' ELSE event_type END AS "Event",
       CASE WHEN event_type = 'view' THEN NULL ELSE props END AS "ItemId",
       CASE WHEN event_type = 'click' THEN 'true' ELSE 'false' END AS "RealTimePlaying"
FROM events
"""


def _write_player_log(spark, sf_dir) -> str:
    """The events as dictionary-literal lines with bare words, quotes in strings, integers and escapes."""
    events = table(spark, sf_dir, "events")
    mac = F.concat(F.lit("M"), F.col("user_id").cast("string"))
    session = F.concat(mac, F.lit(":"), F.date_format("ts", "yyyy:MM:dd:HH:mm:ss:SSS"))
    event = F.when(F.col("event_type") == "error", F.concat(F.lit(r"it\'s a "), F.lit('"'), "event_type", F.lit('"')))
    line = F.concat(
        F.lit("{'Mac': '"), mac,
        F.lit("', 'SessionMainMenu': '"), session,
        F.lit("', 'LogId': "), F.col("event_id").cast("string"),
        F.lit(", 'Event': '"), F.coalesce(event, "event_type"),
        F.lit("', 'ItemId': "),
        F.when(F.col("event_type") == "view", "None").otherwise(F.concat(F.lit("'"), "props", F.lit("'"))),
        F.lit(", 'RealTimePlaying': "), F.when(F.col("event_type") == "click", "True").otherwise("False"),
        F.lit("}"),
    )
    path = scratch_path(spark, "player-log")
    events.select(line.alias("value")).write.text(path)
    return path


def _write_user_info(spark, sf_dir, lead="ABCD") -> str:
    """The customers as key/value lines, with ``lead`` before each key; some values are no numbers."""
    customers = table(spark, sf_dir, "customer")
    days = F.when(F.col("c_acctbal") > 0, F.col("c_nationkey").cast("string")).otherwise("#days")
    path = scratch_path(spark, "user-info")
    box = F.concat(F.lit(lead), F.col("c_custkey").cast("string"))
    customers.select(F.concat(box, F.lit("\t"), days).alias("value")).write.text(path)
    return path


@query("literal_lines_parse", PLAYER_LOG_SQL)
def literal_lines_parse(spark, sf_dir):
    """Dictionary-literal lines with bare words, quotes in strings, integers and escapes."""
    shown = F.date_format("SessionMainMenu", "yyyy-MM-dd HH:mm:ss.SSS")
    return read_player_log(spark, _write_player_log(spark, sf_dir)).withColumn("SessionMainMenu", shown)


@query(
    "keyed_tsv_parse",
    """
SELECT CAST(c_custkey AS VARCHAR) AS "MacId", c_nationkey AS "Days" FROM customer WHERE c_acctbal > 0
""",
)
def keyed_tsv_parse(spark, sf_dir):
    """Key/value lines; lines whose value is not a number drop."""
    return parse_keyed_tsv(read_text_lines(spark, _write_user_info(spark, sf_dir)))


@query(
    "player_log_job",
    f"""
SELECT l.*, CASE WHEN c_acctbal > 0 THEN c_nationkey END AS "Days"
FROM ({PLAYER_LOG_SQL}) l LEFT JOIN customer ON "Mac" = 'M' || CAST(c_custkey AS VARCHAR)
""",
)
def player_log_job(spark, sf_dir):
    """Literal lines, escaped ones among them, and key/value lines, joined on the box; boxes without a readable value keep a null."""
    sessions = player_sessions(spark, _write_player_log(spark, sf_dir), _write_user_info(spark, sf_dir, "ABCDM"))
    return sessions.withColumn("SessionMainMenu", F.date_format("SessionMainMenu", "yyyy-MM-dd HH:mm:ss.SSS"))


# ---------------------------------------------------------------------------------------------------------------------
# Quality

EVENT_RULES = quality.TableRules.from_schema(
    "bronze", schemas.BRONZE, ranges={"TotalDuration": (100, 20_000)}, required=("Contract", "Date")
)


def _rule_sql(column: str, rule: str, condition: str) -> str:
    return f"""
SELECT 'bronze' AS "table", '{column}' AS "column", '{rule}' AS "rule", count(*) FILTER ({condition}) AS failures,
       count(*) AS "rows" FROM ({BRONZE_SQL}) b"""


QUALITY_SQL = " UNION ALL ".join(
    [_rule_sql(name, "type", "false") for name in schemas.BRONZE.fieldNames()]
    + [_rule_sql(name, "not_null", f'"{name}" IS NULL') for name in ("Contract", "Date")]
    + [_rule_sql("TotalDuration", "in_range", '"TotalDuration" < 100 OR "TotalDuration" > 20000')]
)


@query("quality_report", QUALITY_SQL)
def quality_report(spark, sf_dir):
    return quality.check(bronze_events(spark, sf_dir), EVENT_RULES)


@query("audit_of_write", QUALITY_SQL)
def audit_of_write(spark, sf_dir):
    """The same counts, taken by the job that writes the table by date; the files are not read for them."""
    found = []

    def watch(rows):
        observed, result = quality.audited(rows, EVENT_RULES)
        found.append(result)
        return observed

    sink.write_files(bronze_events(spark, sf_dir), scratch_path(spark, "audited"), partition_by=["Date"], watch=watch)
    audit = found[0]()
    lines = [(EVENT_RULES.table, *count, audit.rows) for count in audit.counts]
    return local_frame(spark, lines, T.StructType.fromDDL("`table` string, `column` string, `rule` string, `failures` bigint, `rows` bigint"))


@query(
    "quarantine_rows",
    f"""
SELECT *, 'TotalDuration:in_range' AS broken_rules FROM ({BRONZE_SQL}) b
WHERE "TotalDuration" < 100 OR "TotalDuration" > 20000
""",
)
def quarantine_rows(spark, sf_dir):
    """Publishing under the quarantine policy; the rows set apart, with the rules they break."""
    lake = new_lake(spark)
    sink.publish(lake, bronze_events(spark, sf_dir), "bronze", rules=EVENT_RULES, policy="quarantine")
    broken = read_snapshot(lake, "bronze" + sink.QUARANTINE_SUFFIX)
    return broken.withColumn("broken_rules", F.array_join("broken_rules", ","))


@query("quarantine_kept_rows", f"""SELECT * FROM ({BRONZE_SQL}) b WHERE "TotalDuration" BETWEEN 100 AND 20000""")
def quarantine_kept_rows(spark, sf_dir):
    lake = new_lake(spark)
    sink.publish(lake, bronze_events(spark, sf_dir), "bronze", rules=EVENT_RULES, policy="quarantine")
    return read_snapshot(lake, "bronze")


# ---------------------------------------------------------------------------------------------------------------------
# Publishing, catalog and maintenance


@query("publish_read_back", BRONZE_SQL)
def publish_read_back(spark, sf_dir):
    """Publish partitioned by date with an audit, read by name."""
    lake = new_lake(spark)
    sink.publish(lake, bronze_events(spark, sf_dir), "bronze", partition_by=["Date"], rules=quality.RULES["bronze"])
    return catalog_table(spark, f"{lake.database}.bronze")


@query("load_append", BRONZE_SQL)
def load_append(spark, sf_dir):
    """A catalog table filled by an append, a partition overwrite and another append."""
    rows = bronze_events(spark, sf_dir)
    first = F.col("Date") < F.lit(dt.date(2024, 1, 16))
    lake = new_lake(spark)
    name = f"{lake.database}.raw"
    catalog.ensure_database(spark, lake.database, f"{lake.base}/_catalog")
    catalog.create_table(spark, name, schemas.ddl_columns(schemas.BRONZE), lake.table_root("raw"), ["Date"])
    sink.load_table(rows.filter(first), name)
    sink.load_table(rows.filter(first & (F.col("Date") >= F.lit(dt.date(2024, 1, 8)))), name, "overwrite_partitions")
    sink.load_table(rows.filter(~first), name)
    return spark.table(name)


@query("snapshot_append", BRONZE_SQL)
def snapshot_append(spark, sf_dir):
    """A published table grown by an append; the first directory is kept, not rewritten."""
    rows = bronze_events(spark, sf_dir)
    first = F.col("Date") < F.lit(dt.date(2024, 1, 16))
    lake = new_lake(spark)
    sink.publish(lake, rows.filter(first), "bronze", partition_by=["Date"])
    sink.publish(lake, rows.filter(~first), "bronze", append=True)
    return spark.table(f"{lake.database}.bronze")


@query(
    "schema_evolution",
    f"""
SELECT *, CAST(NULL AS BIGINT) AS "Bonus" FROM ({BRONZE_SQL}) b WHERE "Date" < DATE '2024-01-16'
UNION ALL
SELECT *, "TotalDuration" * 2 AS "Bonus" FROM ({BRONZE_SQL}) b WHERE "Date" >= DATE '2024-01-16'
""",
)
def schema_evolution(spark, sf_dir):
    """An append that brings a new column; earlier rows show null."""
    rows = bronze_events(spark, sf_dir)
    first = F.col("Date") < F.lit(dt.date(2024, 1, 16))
    lake = new_lake(spark)
    sink.publish(lake, rows.filter(first), "bronze")
    later = rows.filter(~first).withColumn("Bonus", F.col("TotalDuration") * 2)
    sink.publish(lake, later, "bronze", append=True, evolve=True)
    return spark.table(f"{lake.database}.bronze")


@query("delete_where", f"""SELECT * FROM ({BRONZE_SQL}) b WHERE "AppName" <> 'error'""")
def delete_where(spark, sf_dir):
    lake = new_lake(spark)
    sink.publish(lake, bronze_events(spark, sf_dir), "bronze")
    sink.delete_where(lake, "bronze", F.col("AppName") == "error")
    return spark.table(f"{lake.database}.bronze")


@query("time_travel_read", BRONZE_SQL)
def time_travel_read(spark, sf_dir):
    """The first version, after a later version has deleted every row."""
    lake = new_lake(spark)
    sink.publish(lake, bronze_events(spark, sf_dir), "bronze")
    sink.delete_where(lake, "bronze")
    return read_snapshot(lake, "bronze", version=1)


@query(
    "snapshot_history",
    """
SELECT 'bronze' AS "table", 1 AS version, 'overwrite' AS operation, count(*) AS "rows" FROM events
UNION ALL SELECT 'bronze', 2, 'append', 2 * count(*) FROM events
UNION ALL SELECT 'bronze', 3, 'delete', 2 * count(*) FILTER (event_type <> 'error') FROM events
UNION ALL SELECT 'bronze', 4, 'compact', 2 * count(*) FILTER (event_type <> 'error') FROM events
""",
)
def snapshot_history(spark, sf_dir):
    lake = new_lake(spark)
    rows = bronze_events(spark, sf_dir)
    sink.publish(lake, rows, "bronze")
    sink.publish(lake, rows, "bronze", append=True)
    sink.delete_where(lake, "bronze", "AppName = 'error'")
    maintenance.compact(lake, "bronze")
    return sink.history(lake, "bronze").select("table", "version", "operation", "rows")


@query(
    "expired_snapshots",
    """
SELECT 'bronze' AS "table", 1 AS version, count(*) AS "rows", CAST(30 AS DOUBLE) AS age_days FROM events
UNION ALL SELECT 'bronze', 2, count(*) FILTER (event_type <> 'error'), CAST(20 AS DOUBLE) FROM events
""",
)
def expired_snapshots(spark, sf_dir):
    """Versions older than a week, the current one kept."""
    now = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    lake = new_lake(spark)
    sink.publish(lake, bronze_events(spark, sf_dir), "bronze", ts=now - dt.timedelta(days=30))
    sink.delete_where(lake, "bronze", "AppName = 'error'", ts=now - dt.timedelta(days=20))
    sink.delete_where(lake, "bronze", "AppName = 'view'", ts=now - dt.timedelta(days=10))
    return maintenance.expired_snapshots(lake, 7, "bronze", now).select("table", "version", "rows", "age_days")


LINEITEM_SQL = "SELECT * FROM lineitem"


@query("compact_keeps_rows", LINEITEM_SQL)
def compact_keeps_rows(spark, sf_dir):
    """Many small files rewritten into few."""
    lake = new_lake(spark)
    sink.publish(lake, table(spark, sf_dir, "lineitem").repartition(32), "lineitem")
    maintenance.compact(lake, "lineitem")
    return spark.table(f"{lake.database}.lineitem")


@query("zorder_keeps_rows", LINEITEM_SQL)
def zorder_keeps_rows(spark, sf_dir):
    """Rewritten along a z-order curve of part and supplier."""
    lake = new_lake(spark)
    sink.publish(lake, table(spark, sf_dir, "lineitem"), "lineitem")
    maintenance.zorder(lake, "lineitem", ["l_partkey", "l_suppkey"], target_bytes=256 * 1024)
    return spark.table(f"{lake.database}.lineitem")


@query("maintenance_metrics", """SELECT 'lineitem' AS "table", 'zorder' AS operation, 2 AS version, count(*) AS "rows", true AS clustered FROM lineitem""")
def maintenance_metrics(spark, sf_dir):
    lake = new_lake(spark)
    first = sink.publish(lake, table(spark, sf_dir, "lineitem"), "lineitem")
    metrics = maintenance.zorder(lake, "lineitem", "l_partkey", target_bytes=max(1, first.bytes // 8))
    clustered = F.col("files_after").between(8, 9) & (F.col("bytes_before") == first.bytes) & (F.col("bytes_after") > 0)
    return metrics.select("table", "operation", "version", "rows", clustered.alias("clustered"))


@query(
    "register_layers",
    f"""
SELECT 'silver' AS layer, count(*) AS "rows" FROM ({SILVER_SQL}) s
UNION ALL SELECT 'gold', count(*) FROM ({GOLD_SQL}) g
""",
)
def register_layers(spark, sf_dir):
    """Views rebuilt from the publish log alone, as in a new session, and queried by name."""
    lake = new_lake(spark)
    profiled = event_profile(spark, sf_dir)
    sink.publish(lake, layers.silver_of(profiled, EVENTS), "silver")
    sink.publish(lake, layers.gold_of(profiled, EVENTS), "gold")
    for name in ("silver", "gold"):
        catalog.drop_table(spark, f"{lake.database}.{name}")
    catalog.register_layers(lake)
    return spark.sql(
        f"""
        SELECT 'silver' AS layer, count(*) AS rows FROM {lake.database}.silver
        UNION ALL SELECT 'gold', count(*) FROM {lake.database}.gold
        """
    )


GOLD_COLUMNS_SQL = "SELECT * FROM (VALUES {}) c(col_name, data_type)".format(
    ", ".join(f"('{f.name}', '{f.dataType.simpleString()}')" for f in schemas.GOLD.fields)
)


@query("describe_layers", GOLD_COLUMNS_SQL)
def describe_layers(spark, sf_dir):
    """Columns of the published gold table as the catalog shows them."""
    lake = new_lake(spark)
    sink.publish(lake, gold_profile(spark, sf_dir), "gold")
    return catalog.describe(spark, f"{lake.database}.gold").select("col_name", "data_type")


@query("layered_run", GOLD_SQL)
def layered_run(spark, sf_dir):
    """Raw JSON files to bronze, silver, rfm and gold tables; the published gold table."""
    lake = new_lake(spark)
    return run(lake, _write_hits(spark, sf_dir), EVENTS, read_options=HIT_READ, flatten_options=HIT_FLATTEN)


# The applications of the default mapping and one that it does not know, dealt over the events.
APPLICATIONS = (*APP_NAMES, "OTHER")
REAL_ROWS = """"Contract" <> '' AND "Contract" <> '0' AND "TotalDuration" > 0"""
APPLICATION_SQL = f"""
SELECT * REPLACE (['{"', '".join(APPLICATIONS)}'][1 + (CAST("Id" AS BIGINT) + length("AppName")) % {len(APPLICATIONS)}] AS "AppName")
FROM ({BRONZE_SQL}) b
"""
APPLICATION_RUN = LayerConfig(report_date="2024-02-01", total_days=30, population="usable")


def _usable_scores_sql(rows: str) -> str:
    return scores_sql(metrics_sql(f"SELECT * FROM ({rows}) x WHERE {REAL_ROWS}", "2024-02-01", "30"))


@query(
    "layered_run_applications",
    gold_sql(silver_sql(pivot_sql(usable_sql(typed_sql(APPLICATION_SQL, APPLICATION_RUN.mapping)))), _usable_scores_sql(APPLICATION_SQL)),
)
def layered_run_applications(spark, sf_dir):
    """The whole job with the default mapping of eight applications, a fixed period of 30 days and only usable rows scored."""
    place = (F.col("Id").cast("bigint") + F.length("AppName")) % len(APPLICATIONS)
    names = F.array(*[F.lit(name) for name in APPLICATIONS])
    rows = bronze_events(spark, sf_dir).withColumn("AppName", F.get(names, place.cast("int")))
    return run(new_lake(spark), _write_hits(spark, sf_dir, rows=rows), APPLICATION_RUN, read_options=HIT_READ, flatten_options=HIT_FLATTEN)


@query("rfm_usable_range", _usable_scores_sql(f"""SELECT * FROM ({BRONZE_SQL}) b WHERE "Date" BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'"""))
def rfm_usable_range(spark, sf_dir):
    """Scores over the usable rows of a range of date partitions, as shares of 30 days."""
    path = scratch_path(spark, "bronze")
    sink.write_files(bronze_events(spark, sf_dir), path, partition_by=["Date"])
    rows = read_date_range(spark, path, "2024-01-05", "2024-01-12")
    return layers.rfm_table(rows, APPLICATION_RUN, rfm.date_bounds(rows, "Date"))


@query(
    "compact_fragmented_days",
    f"""
SELECT "Date", count(*) AS "rows", CAST(1 AS BIGINT) AS files, "Date" < DATE '2024-01-16' AS untouched
FROM ({BRONZE_SQL}) b GROUP BY "Date"
""",
)
def compact_fragmented_days(spark, sf_dir):
    """Days of one file keep it, days of many small files get one; read from the files of the compacted table."""
    path = scratch_path(spark, "fragmented")
    rows = bronze_events(spark, sf_dir)
    whole = F.col("Date") < F.lit(dt.date(2024, 1, 16))
    rows.filter(whole).repartition("Date").write.partitionBy("Date").parquet(path)
    rows.filter(~whole).repartition(8).write.partitionBy("Date").mode("append").parquet(path)
    before = materialize(partitions.data_files(spark, path).select("file", F.lit(True).alias("old")))
    partitions.compact_partitions(spark, path, ["Date"])
    found = read_table(spark, path).groupBy("Date", F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
    return found.join(before, "file", "left").groupBy("Date").agg(
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("files"),
        F.bool_and(F.coalesce("old", F.lit(False))).alias("untouched"),
    )


@query(
    "delete_in_days",
    f"""
SELECT *, "Date" <> DATE '2024-01-20' AS untouched FROM ({BRONZE_SQL}) b
WHERE "Date" <> DATE '2024-01-10' AND NOT ("Date" = DATE '2024-01-20' AND "AppName" = 'error')
""",
)
def delete_in_days(spark, sf_dir):
    """One day deleted, another stripped of its errors; every row with whether it is still in the file it was in."""
    path = scratch_path(spark, "by-date")
    sink.write_files(bronze_events(spark, sf_dir), path, partition_by=["Date"])
    before = materialize(partitions.data_files(spark, path).select("file", F.lit(True).alias("old")))
    gone = "Date = DATE'2024-01-10' OR (Date = DATE'2024-01-20' AND AppName = 'error')"
    partitions.delete_in_partitions(spark, path, gone, ["Date"])
    left = read_table(spark, path).withColumn("file", F.col("_metadata.file_path")).join(before, "file", "left")
    return left.select(*schemas.BRONZE.fieldNames(), F.coalesce("old", F.lit(False)).alias("untouched"))


@query(
    "zorder_files_opened",
    """
SELECT c."column", l."layout", (SELECT count(*) FROM lineitem) AS "rows", l."layout" = 'zorder' AS few
FROM (VALUES ('l_partkey'), ('l_suppkey')) c("column"), (VALUES ('dealt'), ('zorder')) l("layout")
""",
)
def zorder_files_opened(spark, sf_dir):
    """Whether a filter on a sixteenth of a column's span opens fewer than half of the files, before and after."""
    lake, keys = new_lake(spark), ["l_partkey", "l_suppkey"]
    first = sink.publish(lake, table(spark, sf_dir, "lineitem").repartition(16), "lineitem")

    def opened(layout: str) -> DataFrame:
        scan = read_table(spark, lake.snapshot("lineitem").paths)
        shares = maintenance.opened_share(materialize(maintenance.zone_map(scan, keys)), keys)
        few = (F.col("files") >= 8) & (F.col("opened") < 0.5)
        return shares.select("column", F.lit(layout).alias("layout"), "rows", few.alias("few"))

    dealt = opened("dealt")
    maintenance.zorder(lake, "lineitem", keys, target_bytes=max(1, first.bytes // 16))
    return dealt.unionByName(opened("zorder"))


@query(
    "metrics_json",
    """SELECT '{"table":"lineitem","operation":"compact","version":2,"rows":' || CAST(count(*) AS VARCHAR) || '}' AS metrics FROM lineitem""",
)
def metrics_json(spark, sf_dir):
    """Metrics of a compaction as JSON text."""
    lake = new_lake(spark)
    sink.publish(lake, table(spark, sf_dir, "lineitem").repartition(16), "lineitem")
    return maintenance.metrics_json(maintenance.compact(lake, "lineitem").select("table", "operation", "version", "rows"))


def _external_events(spark, sf_dir) -> str:
    """The events by date as an external table; the second half of the days is written after the table was made."""
    lake = new_lake(spark)
    name, path = f"{lake.database}.events", lake.table_root("events")
    rows = bronze_events(spark, sf_dir)
    first = F.col("Date") < F.lit(dt.date(2024, 1, 16))
    sink.write_files(rows.filter(first), path, partition_by=["Date"])
    catalog.ensure_database(spark, lake.database, f"{lake.base}/_catalog")
    catalog.external_table(spark, name, path, ["Date"])
    rows.filter(~first).repartition("Date").write.partitionBy("Date").mode("append").parquet(path)
    catalog.sync_partitions(spark, name)
    return name


@query("external_table_read", BRONZE_SQL)
def external_table_read(spark, sf_dir):
    """Files with a table over them, read by its plain name in its database."""
    database, name = _external_events(spark, sf_dir).split(".")
    current = spark.catalog.currentDatabase()
    catalog.use_database(spark, database)
    try:
        return catalog_table(spark, name)
    finally:
        catalog.use_database(spark, current)


def _statistics_sql(column: str) -> str:
    ends = f"""CAST(min("{column}") AS VARCHAR) AS least, CAST(max("{column}") AS VARCHAR) AS greatest"""
    return f"""SELECT '{column}' AS "column", {ends}, count(*) FILTER ("{column}" IS NULL) AS nulls FROM ({BRONZE_SQL}) b"""


@query("external_table_statistics", " UNION ALL ".join(_statistics_sql(c) for c in ("TotalDuration", "Score", "Date")))
def external_table_statistics(spark, sf_dir):
    """What the catalog knows of an analyzed table's columns."""
    name, columns = _external_events(spark, sf_dir), ["TotalDuration", "Score", "Date"]
    catalog.analyze(spark, name, columns)
    return catalog.column_statistics(spark, name, columns).drop("distinct")
