"""Load queries: manifests, progress, plans, loads into files, streaming loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsluice.operators.progress import load_tally, progress_percent, progress_totals
from rowsluice.operators.spec import ColumnSpec, TableSpec
from rowsluice.plans import derived
from rowsluice.plans.catalog_queries import READY_SQL, walk_sql
from rowsluice.plans.derived import MANIFEST_SQL
from rowsluice.plans.feed_queries import DAMAGE_SQL, damaged_feed
from rowsluice.plans.push import LoadAborted, Source, push_plan, push_table, push_tables
from rowsluice.plans.registry import ORACLES, Tables, query
from rowsluice.session import scratch_path
from rowsluice.sources import manifest as manifests
from rowsluice.sources.jsonl import kept_lines, rows_from_lines, split_lines
from rowsluice.sources.sinks import ParquetSink
from rowsluice.sources.versions import VersionedSink
from rowsluice.streaming.ingest import Ingest
from rowsluice.streaming.keyed import KeyedIngest
from rowsluice.streaming.related import RelatedIngest

# ---- manifests ------------------------------------------------------------


@query(
    "manifest_list",
    f"""
SELECT schema_id, min(name) AS name, count(*) AS tables, min(created_at) AS created_at
FROM ({MANIFEST_SQL}) GROUP BY schema_id HAVING bool_or(table_name = '5-low')
""",
)
def manifest_list(t: Tables) -> DataFrame:
    return manifests.list_schemas(derived.manifest(t), containing="5-low")


@query(
    "manifest_list_json",
    f"""
SELECT '{{"schema_id":"' || schema_id || '","name":"' || min(name) || '","tables":' || count(*)
       || ',"created_at":"' || min(created_at) || '"}}' AS json
FROM ({MANIFEST_SQL}) GROUP BY schema_id
""",
)
def manifest_list_json(t: Tables) -> DataFrame:
    return manifests.as_json(manifests.list_schemas(derived.manifest(t)))


@query("manifest_show", MANIFEST_SQL)
def manifest_show(t: Tables) -> DataFrame:
    return manifests.show_schema(derived.manifest(t))


@query(
    "ready_tables",
    f"SELECT schema_id, table_name, rows, status FROM ({MANIFEST_SQL}) WHERE status IN ('', 'ready')",
)
def ready_tables(t: Tables) -> DataFrame:
    return manifests.ready_tables(derived.manifest(t)).select("schema_id", "table_name", "rows", "status")


@query(
    "table_sample",
    """
SELECT o_orderpriority, CAST(position AS INT) AS position,
       '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS sample
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS position FROM orders)
WHERE position <= 5
""",
)
def table_sample(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return manifests.sample_rows(rows, ["o_orderkey"], ["o_orderpriority"])


@query(
    "table_sample_whole",
    """
SELECT o_orderkey, '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS sample
FROM orders ORDER BY o_orderkey LIMIT 5
""",
)
def table_sample_whole(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return manifests.sample_rows(rows, ["o_orderkey"])


# ---- progress and tallies -------------------------------------------------

PROGRESS_SQL = """
SELECT c_custkey, count(*) AS generated, CAST(sum(CAST(floor(o_totalprice / 50000) AS BIGINT) - 3) AS BIGINT) AS requested,
       CASE max(o_orderstatus) WHEN 'F' THEN 'ready' ELSE 'generating' END AS overall,
       CASE WHEN min(c_mktsegment) = 'BUILDING' THEN CAST(floor(min(c_acctbal) / 50) AS INT) ELSE 0 END AS reported
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY c_custkey
"""


def _progress(t: Tables) -> DataFrame:
    totals = progress_totals(
        t.orders.select(
            F.col("o_custkey").alias("c_custkey"),
            "o_orderstatus",
            F.lit(1).cast("bigint").alias("generated"),
            (F.floor(F.col("o_totalprice") / 50000) - 3).alias("requested"),
        )
        .groupBy("c_custkey", "o_orderstatus")
        .agg(F.sum("generated").alias("generated"), F.sum("requested").alias("requested")),
        ["c_custkey"],
    )
    states = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.when(F.max("o_orderstatus") == "F", "ready").otherwise("generating").alias("overall")
    )
    reported = F.when(F.col("c_mktsegment") == "BUILDING", F.floor(F.col("c_acctbal") / 50)).otherwise(0)
    return (
        totals.join(states, "c_custkey")
        .join(t.customer, "c_custkey")
        .select("c_custkey", "generated", "requested", "overall", reported.cast("int").alias("reported"))
    )


@query(
    "progress_totals",
    """
SELECT o_orderpriority AS table_name, count(*) AS generated,
       CAST(sum(CAST(floor(o_totalprice / 50000) AS BIGINT) - 3) AS BIGINT) AS requested
FROM orders GROUP BY o_orderpriority
""",
)
def progress_totals_query(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.col("o_orderpriority").alias("table_name"),
        F.lit(1).cast("bigint").alias("generated"),
        (F.floor(F.col("o_totalprice") / 50000) - 3).alias("requested"),
    )
    return progress_totals(rows, ["table_name"])


@query(
    "progress_percent",
    f"""
SELECT *, CAST(CASE WHEN reported > 0 OR overall = 'ready' THEN greatest(0, least(100, reported))
               WHEN requested <= 0 THEN 0 ELSE least(100, generated * 100 // requested) END AS INT) AS percent
FROM ({PROGRESS_SQL})
""",
)
def progress_percent_query(t: Tables) -> DataFrame:
    percent = progress_percent(
        F.col("generated"), F.col("requested"), F.col("reported"), F.col("overall")
    )
    return _progress(t).withColumn("percent", percent)


@query(
    "load_tally",
    "SELECT event_type AS table_name, count(*) AS rows FROM events GROUP BY ROLLUP (event_type)",
)
def load_tally_query(t: Tables) -> DataFrame:
    return load_tally(t.events.select(F.col("event_type").alias("table_name")))


@query(
    "push_plan",
    walk_sql(READY_SQL)
    + """
SELECT n."database", CAST(CASE WHEN NOT stuck THEN p.pass END AS INT) AS pass, n.position, n.table_name, n.rows,
       'TRUNCATE + INSERT' AS action
FROM nodes n JOIN passes p ON p.table_name = n.table_name
""",
)
def push_plan_query(t: Tables) -> DataFrame:
    tables = derived.tables(t).select("database", "table_name", "position", "rows", "status")
    return push_plan(tables, derived.columns(t))


# ---- loads ----------------------------------------------------------------

CUSTOMERS = TableSpec(
    "customer",
    (
        ColumnSpec("c_custkey", "bigint", nullable=False, is_pk=True),
        ColumnSpec("c_nationkey", "int"),
        ColumnSpec("c_mktsegment", "varchar", length=9),
    ),
)
PLACED = TableSpec(
    "orders",
    (
        ColumnSpec("o_orderkey", "bigint", nullable=False, is_pk=True),
        ColumnSpec("o_custkey", "bigint", fk_ref="customer.c_custkey"),
        ColumnSpec("o_orderstatus", "enum", values=("F", "O")),
    ),
)


STREAMED_CUSTOMERS = TableSpec("customer", CUSTOMERS.columns[:2] + (ColumnSpec("c_mktsegment", "varchar"),))
PLAIN_ORDERS = TableSpec("orders", PLACED.columns[:2] + (ColumnSpec("o_orderstatus", "varchar"),))


@query(
    "push_files",
    """
WITH c AS (SELECT length(c_mktsegment) > 9 AS bad FROM customer),
     o AS (SELECT coalesce(o_orderstatus NOT IN ('F', 'O'), false) AS bad FROM orders)
SELECT 'customer' AS table_name, count(*) FILTER (NOT coalesce(bad, false)) AS loaded, count(*) FILTER (bad) AS rejected FROM c
UNION ALL
SELECT 'orders', count(*) FILTER (NOT bad), count(*) FILTER (bad) FROM o
""",
)
def push_files(t: Tables) -> DataFrame:
    """Load two tables into folders, parents first, bad rows set aside; read both back and count."""
    root = scratch_path(t.spark, "push")
    sink, aside = ParquetSink(t.spark, f"{root}/loaded"), ParquetSink(t.spark, f"{root}/aside")
    sources = [
        Source(spec, getattr(t, spec.name).select(*[c.name for c in spec.columns]), (spec.primary_key[0],))
        for spec in (PLACED, CUSTOMERS)
    ]
    for source in sources:
        sink.create(source.spec)
    push_tables(sources, sink, policy="quarantine", quarantine=aside)
    parts = []
    for spec in (CUSTOMERS, PLACED):
        count = lambda s, name: s.read(spec.name).agg(F.count("*").alias(name))  # noqa: B023, E731
        both = count(sink, "loaded").join(count(aside, "rejected"))  # one row each
        parts.append(both.select(F.lit(spec.name).alias("table_name"), "loaded", "rejected"))
    return parts[0].unionByName(parts[1])


@query(
    "push_atomic",
    """
WITH c AS (SELECT count(*) AS n FROM customer), o AS (SELECT count(*) AS n FROM orders),
     f AS (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F')
SELECT 'loaded' AS step, 'customer' AS table_name, n AS rows FROM c UNION ALL SELECT 'loaded', 'orders', n FROM o
UNION ALL SELECT 'failed', 'customer', n FROM c UNION ALL SELECT 'failed', 'orders', n FROM o
UNION ALL SELECT 'replaced', 'customer', n FROM c UNION ALL SELECT 'replaced', 'orders', n FROM f
UNION ALL SELECT 'appended', 'customer', n FROM c UNION ALL SELECT 'appended', 'orders', o.n FROM o
""",
)
def push_atomic(t: Tables) -> DataFrame:
    """Load two tables as one version; fail in the last table of the next load; replace both; append to one.

    Rows that readers of the newest version see after each step.
    """
    sink = VersionedSink(t.spark, scratch_path(t.spark, "versions"))
    specs = (PLAIN_ORDERS, STREAMED_CUSTOMERS)
    seen = []

    def load(step: str, orders: DataFrame, append: bool = False) -> None:
        sources = [Source(specs[0], orders, ("o_orderkey",))]
        if not append:
            sources.append(Source(specs[1], t.customer.select(*[c.name for c in specs[1].columns]), ("c_custkey",)))
        try:
            push_tables(sources, sink, append=append, policy="report")
        except LoadAborted:
            step = "failed"
        seen.extend(sink.read(s.name).agg(F.count("*").alias("rows")).select(F.lit(step).alias("step"), F.lit(s.name).alias("table_name"), "rows") for s in specs)

    for spec in specs:
        sink.create(spec)
    orders = t.orders.select(*[c.name for c in PLAIN_ORDERS.columns])
    broken = F.when(F.col("o_orderkey") % 2 == 0, F.raise_error(F.lit("lost on the way")).cast("string")).otherwise(F.col("o_orderstatus"))
    load("loaded", orders)
    load("broken", orders.withColumn("o_orderstatus", broken))
    load("replaced", orders.filter("o_orderstatus = 'F'"))
    load("appended", orders.filter("o_orderstatus <> 'F'"), append=True)
    return reduce(DataFrame.unionAll, seen)


# ---- streaming ------------------------------------------------------------

STREAMED = TableSpec(
    "events",
    (
        ColumnSpec("event_id", "bigint", nullable=False, is_pk=True),
        ColumnSpec("event_type", "enum", values=("click", "purchase", "signup", "view")),
        ColumnSpec("slot", "bigint", unique=True),
        ColumnSpec("user_id", "int"),
    ),
)


FEED_BATCHES, FEED_FILES, FEED_ROWS = 4, 4, 20_000


def feed(t: Tables, rows: DataFrame, batch: Column, **options) -> DataFrame:
    """``rows`` as a stream of FEED_BATCHES batches, told apart by ``batch``; each is as many
    files, FEED_FILES at least and else one for every FEED_ROWS rows of the largest batch: a file is read by one task."""
    path = scratch_path(t.spark, "feed")
    largest = rows.groupBy(batch).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    files = max(FEED_FILES, -(-largest // FEED_ROWS))
    for i in range(FEED_BATCHES):
        rows.filter(batch == i).repartition(files).write.mode("append").parquet(path)
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def _event_rows(t: Tables) -> DataFrame:
    """The events as a stream of JSON lines, parsed into raw rows, every fourth id in a batch.

    Every 5 ids share a slot, which has to be unique over the whole stream.
    """
    source = feed(t, t.events, F.pmod("event_id", F.lit(FEED_BATCHES)))
    line = F.to_json(
        F.struct(
            "event_id",
            "event_type",
            derived.div(F.col("event_id"), 5).alias("slot"),
            F.struct(F.col("user_id").cast("string").alias("date")).alias("user_id"),
        )
    )
    return rows_from_lines(source.select("event_id", line.alias("value")))


def _streamed(t: Tables, kind: type[Ingest] | type[KeyedIngest] = Ingest) -> Ingest | KeyedIngest:
    """Stream the events through validation into a new folder."""
    load = kind(STREAMED, scratch_path(t.spark, "stream"), ("event_id",))
    load.start(_event_rows(t)).awaitTermination()
    return load


# The first valid event of a slot, by batch and id, owns it.
STREAM_SQL = """
  SELECT *, event_type = 'error' AS bad,
         row_number() OVER (PARTITION BY event_id // 5, event_type = 'error' ORDER BY event_id % 4, event_id) AS nth
  FROM events
"""


@query(
    "stream_loaded",
    f"""
SELECT event_id, event_type, event_id // 5 AS slot, CAST(user_id AS INT) AS user_id
FROM ({STREAM_SQL}) WHERE NOT bad AND nth = 1
""",
)
def stream_loaded(t: Tables) -> DataFrame:
    return _streamed(t).loaded(t.spark)


@query(
    "stream_rejected",
    f"""
SELECT event_id, 'event_type' AS column_name, 'enum' AS rule FROM events WHERE event_type = 'error'
UNION ALL
SELECT event_id, 'slot', 'unique' FROM ({STREAM_SQL}) WHERE NOT bad AND nth > 1
""",
)
def stream_rejected(t: Tables) -> DataFrame:
    return _streamed(t).rejected(t.spark).select("event_id", "column_name", "rule")


@query("stream_loaded_state", ORACLES["stream_loaded"])
def stream_loaded_state(t: Tables) -> DataFrame:
    return _streamed(t, KeyedIngest).loaded(t.spark)


@query("stream_rejected_state", ORACLES["stream_rejected"])
def stream_rejected_state(t: Tables) -> DataFrame:
    return _streamed(t, KeyedIngest).rejected(t.spark).select("event_id", "column_name", "rule")


# ---- streams of related tables ---------------------------------------------

# Every 7th customer never comes. The others come with batch (key % 4), their orders one batch earlier.
RELATED_SQL = """
  SELECT o_orderkey, o_custkey, o_orderstatus NOT IN ('F', 'O') AS bad, o_custkey % 7 = 0 AS lone,
         (o_custkey + 3) % 4 AS batch FROM orders
"""


def _related(t: Tables) -> RelatedIngest:
    """Stream customers and orders as JSON lines, most orders one batch before their customer."""
    key = F.col("c_custkey")
    parents = t.customer.filter(key % 7 != 0).select(
        F.lit("customer").alias("table_name"), key.alias("id"), (key % FEED_BATCHES).alias("batch"),
        F.to_json(F.struct("c_custkey", "c_nationkey", "c_mktsegment")).alias("value"),
    )
    customer = F.col("o_custkey")
    children = t.orders.select(
        F.lit("orders"), "o_orderkey", (customer + FEED_BATCHES - 1) % FEED_BATCHES,
        F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus")),
    )
    source = feed(t, parents.unionAll(children), F.col("batch"))
    load = RelatedIngest((PLACED, STREAMED_CUSTOMERS), scratch_path(t.spark, "related"), ("id",))
    load.start(rows_from_lines(source.drop("batch"))).awaitTermination()
    load.finish(t.spark)
    return load


@query(
    "stream_related",
    f"""
SELECT 'customer' AS table_name, c_custkey AS id, 'loaded' AS outcome FROM customer WHERE c_custkey % 7 <> 0
UNION ALL
SELECT 'orders', o_orderkey, CASE WHEN bad THEN 'enum' WHEN lone THEN 'reference' ELSE 'loaded' END FROM ({RELATED_SQL})
""",
)
def stream_related(t: Tables) -> DataFrame:
    """What became of every row: loaded, or the rule it was rejected by."""
    load, parts = _related(t), []
    for name, key in (("customer", "c_custkey"), ("orders", "o_orderkey")):
        loaded = load.loaded(t.spark, name).select(F.lit(name).alias("table_name"), F.col(key).alias("id"), F.lit("loaded").alias("outcome"))
        rejected = load.rejected(t.spark, name).select(F.lit(name), "id", "rule")
        parts += [loaded, rejected]
    return reduce(DataFrame.unionAll, parts)


@query(
    "stream_waiting",
    f"""
SELECT CAST(b AS INT) AS batch_id, count(*) AS waiting
FROM ({RELATED_SQL}) JOIN range(4) r(b) ON batch <= b AND (lone OR batch = b AND batch < 3) WHERE NOT bad GROUP BY b
""",
)
def stream_waiting(t: Tables) -> DataFrame:
    """How many orders wait for their customer after each batch."""
    return _related(t).waiting(t.spark, "orders").groupBy("batch_id").agg(F.count(F.lit(1)).alias("waiting"))


# ---- feeds with lines that hold no row -------------------------------------

# Further damage to lines that are whole otherwise.
ODD_SQL = f"""
SELECT *, CASE WHEN damage <> 'good' THEN damage WHEN event_id % 29 = 0 THEN 'huge' WHEN event_id % 31 = 0 THEN 'shown' ELSE 'good' END AS state
FROM (SELECT *, {DAMAGE_SQL} AS damage FROM events)
"""
LINED = TableSpec(
    "events",
    (
        ColumnSpec("event_id", "bigint", is_pk=True), ColumnSpec("user_id", "int"), ColumnSpec("value", "double"),
        ColumnSpec("event_type", "enum", values=("click", "purchase", "signup", "view")), ColumnSpec("props", "json"),
    ),
)


def _odd_lines(t: Tables) -> DataFrame:
    """The damaged feed, with numbers that are too large, as numbers and inside texts (those are good)."""
    whole = F.col("value").rlike("[}]\r$")
    huge = F.regexp_replace("value", '"user_id":[0-9]+', '"user_id":1e400')
    shown = F.regexp_replace("value", '"props":"', '"props":"1e400 ')
    key = F.regexp_extract("value", '"event_id":([0-9]+)', 1).try_cast("long")
    line = F.when(whole & (key % 29 == 0), huge).when(whole & (key % 31 == 0), shown).otherwise(F.col("value"))
    return damaged_feed(t).select(line.alias("value"))


@query(
    "push_lines",
    f"""
WITH s AS (SELECT state, event_type = 'error' AS bad FROM ({ODD_SQL}))
SELECT 'written' AS outcome, count(*) AS n FROM s WHERE state IN ('good', 'shown') AND NOT bad
UNION ALL SELECT 'rejected', count(*) FROM s WHERE state IN ('good', 'shown') AND bad
UNION ALL SELECT 'malformed', count(*) FROM s WHERE state NOT IN ('good', 'shown', 'blank')
""",
)
def push_lines(t: Tables) -> DataFrame:
    """Load a feed of lines: rows to the target, rejected rows and lines without a row set aside."""
    root = scratch_path(t.spark, "lines")
    sink, aside = ParquetSink(t.spark, f"{root}/loaded"), ParquetSink(t.spark, f"{root}/aside")
    rows, malformed = split_lines(_odd_lines(t))
    rows = rows.withColumn("id", F.try_variant_get(F.col("row")["event_id"], "$", "bigint"))
    sink.create(LINED)
    result = push_table(Source(LINED, rows, ("id",), "row", malformed=malformed), sink, "quarantine", quarantine=aside)
    found = {"written": "loaded/events", "rejected": "aside/events", "malformed": "aside/events_malformed"}
    counts = {"written": result.written, "rejected": result.rejected, "malformed": result.malformed}
    parts = [t.spark.read.parquet(f"{root}/{path}").agg(F.count("*").alias("n")).select(F.lit(k).alias("outcome"), "n") for k, path in found.items()]
    seen = reduce(DataFrame.unionAll, parts)
    told = t.spark.createDataFrame([(k, v["events"]) for k, v in counts.items()], "outcome string, n long")
    return seen.join(F.broadcast(told), ["outcome", "n"])  # both have to agree


@query(
    "stream_malformed",
    f"""
SELECT 'loaded' AS outcome, count(*) AS n FROM ({ODD_SQL}) WHERE state IN ('good', 'shown') AND event_type <> 'error'
UNION ALL SELECT 'malformed', count(*) FROM ({ODD_SQL}) WHERE state NOT IN ('good', 'shown', 'blank')
""",
)
def stream_malformed(t: Tables) -> DataFrame:
    """The same feed as a stream of four batches; lines without a row are set aside by the same pass."""
    lines = _odd_lines(t)
    source = feed(t, lines, F.pmod(F.xxhash64("value"), F.lit(FEED_BATCHES)))
    rows = kept_lines(source).withColumn("id", F.try_variant_get(F.col("row")["event_id"], "$", "bigint"))
    load = Ingest(LINED, scratch_path(t.spark, "stream"), ("id",))
    load.start(rows).awaitTermination()
    loaded = load.loaded(t.spark).agg(F.count("*").alias("n")).select(F.lit("loaded").alias("outcome"), "n")
    return loaded.unionAll(load.malformed(t.spark).agg(F.count("*").alias("n")).select(F.lit("malformed"), "n"))
