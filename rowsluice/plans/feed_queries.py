"""Feed queries: JSON Lines made of the events table, read back as raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsluice.functions.variants import inferred_type, writable_as, writable_text
from rowsluice.operators.match import keys_outside
from rowsluice.operators.project import (
    all_columns,
    first_row_columns,
    row_keys,
    write_projection,
)
from rowsluice.operators.spec import ColumnSpec, TableSpec
from rowsluice.plans.push import dry_run
from rowsluice.plans.registry import Tables, query
from rowsluice.sources.jsonl import line_counts, rows_from_lines

# ---- a feed with damaged lines --------------------------------------------

# What happened to a line of the feed, from the columns of its event. Every
# event stays in the feed; only the state of its line varies.
DAMAGE_SQL = """
CASE WHEN event_id % 7 = 0 THEN 'cut' WHEN event_id % 11 = 0 THEN 'blank'
     WHEN event_id % 13 = 0 THEN 'trailing' WHEN event_id % 17 = 0 THEN 'twice'
     WHEN event_id % 19 = 0 THEN 'array' WHEN event_id % 23 = 0 THEN 'null' ELSE 'good' END
"""


def damaged_feed(t: Tables) -> DataFrame:
    """One line per event, some of them cut, blank, doubled or otherwise bad."""
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value", "props"))
    feed = t.events.select(line.alias("line"), F.expr(DAMAGE_SQL).alias("damage"))
    damage, text = F.col("damage"), F.col("line")
    return feed.select(
        F.when(damage == "cut", F.substring(text, F.lit(1), F.call_function("div", F.length(text), F.lit(2)).cast("int")))
        .when(damage == "blank", " \t ")
        .when(damage == "trailing", F.concat(text, F.lit(" end")))
        .when(damage == "twice", F.concat(text, text))
        .when(damage == "array", F.concat(F.lit("["), text, F.lit("]")))
        .when(damage == "null", "null")
        .otherwise(F.concat(F.lit("  "), text, F.lit("\r")))
        .alias("value")
    )


@query(
    "jsonl_parse",
    f"""
SELECT event_id, event_type, user_id, 5 AS n_keys
FROM (SELECT *, {DAMAGE_SQL} AS damage FROM events) WHERE damage = 'good'
""",
)
def jsonl_parse(t: Tables) -> DataFrame:
    rows = rows_from_lines(damaged_feed(t))
    spec = TableSpec(
        "events",
        (ColumnSpec("event_id", "bigint"), ColumnSpec("event_type", "text"), ColumnSpec("user_id", "bigint")),
    )
    counted = rows.withColumn("n_keys", F.size(F.map_keys("row")))
    return write_projection(counted, spec, "row", keep=("n_keys",))


@query(
    "jsonl_stats",
    f"""
SELECT count(*) AS lines, count(*) FILTER (damage = 'good') AS rows,
       count(*) FILTER (damage = 'blank') AS blank,
       count(*) FILTER (damage NOT IN ('good', 'blank')) AS malformed
FROM (SELECT *, {DAMAGE_SQL} AS damage FROM events)
""",
)
def jsonl_stats(t: Tables) -> DataFrame:
    return line_counts(damaged_feed(t))


# ---- a feed with values of every kind -------------------------------------

MIXED_SQL = """
SELECT event_id, event_type, value, user_id,
  '{"Event_ID":' || event_id || ',"flag":' || CASE WHEN value > 50 THEN 'true' ELSE 'false' END
  || ',"note":null,"payload":'
  || CASE event_type
       WHEN 'click' THEN props
       WHEN 'view' THEN '"user ' || user_id || '"'
       WHEN 'error' THEN '{"date":"2024-01-02 03:04:05","timezone":"UTC","timezone_type":3}'
       WHEN 'signup' THEN '{"date":"2024-05-0' || (user_id % 9 + 1) || '"}'
       ELSE '[' || user_id || ',"a"]' END
  || CASE WHEN value < 20 THEN ',"user_id":' || user_id ELSE '' END
  || CASE WHEN value > 50 THEN ',"extra":{"date":5,"n":' || user_id || '}' ELSE '' END
  || '}' AS line
FROM events
"""


def mixed_feed(t: Tables) -> DataFrame:
    """Raw rows whose keys and value kinds vary from row to row."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    payload = (
        F.when(kind == "click", F.col("props"))
        .when(kind == "view", F.concat(F.lit('"user '), user, F.lit('"')))
        .when(kind == "error", '{"date":"2024-01-02 03:04:05","timezone":"UTC","timezone_type":3}')
        .when(
            kind == "signup",
            F.concat(F.lit('{"date":"2024-05-0'), (F.col("user_id") % 9 + 1).cast("string"), F.lit('"}')),
        )
        .otherwise(F.concat(F.lit("["), user, F.lit(',"a"]')))
    )
    line = F.concat(
        F.lit('{"Event_ID":'), F.col("event_id").cast("string"),
        F.lit(',"flag":'), F.when(F.col("value") > 50, "true").otherwise("false"),
        F.lit(',"note":null,"payload":'), payload,
        F.when(F.col("value") < 20, F.concat(F.lit(',"user_id":'), user)).otherwise(""),
        F.when(F.col("value") > 50, F.concat(F.lit(',"extra":{"date":5,"n":'), user, F.lit("}"))).otherwise(""),
        F.lit("}"),
    )
    return rows_from_lines(t.events.select("event_id", "event_type", line.alias("value")))


@query(
    "infer_schema",
    f"""
WITH feed AS ({MIXED_SQL}),
cells AS (SELECT line, unnest(json_keys(line)) AS key FROM feed)
SELECT lower(key) AS name,
       CASE json_type(line, '$."' || key || '"')
         WHEN 'BOOLEAN' THEN 'boolean' WHEN 'UBIGINT' THEN 'numeric' WHEN 'BIGINT' THEN 'numeric'
         WHEN 'DOUBLE' THEN 'numeric' WHEN 'OBJECT' THEN 'json' WHEN 'ARRAY' THEN 'json'
         ELSE 'text' END AS type,
       count(*) AS n
FROM cells GROUP BY ALL
""",
)
def infer_schema(t: Tables) -> DataFrame:
    cells = mixed_feed(t).select(F.explode("row").alias("name", "value"))
    return (
        cells.select("name", inferred_type(F.col("value")).alias("type"))
        .groupBy("name", "type")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "normalize_value",
    f"""
SELECT event_id, flag, note, CASE
         WHEN date_kind = 'VARCHAR' AND (n_keys = 1 OR has_zone) THEN payload->>'$.date'
         WHEN kind IN ('OBJECT', 'ARRAY') THEN CAST(json(payload) AS VARCHAR)
         ELSE payload->>'$' END AS payload,
       extra
FROM (SELECT event_id, line->>'$.flag' AS flag, line->>'$.note' AS note,
             CAST(line->'$.extra' AS VARCHAR) AS extra, line->'$.payload' AS payload,
             json_type(line, '$.payload') AS kind, json_type(line, '$.payload.date') AS date_kind,
             CASE WHEN json_type(line, '$.payload') = 'OBJECT' THEN len(json_keys(line, '$.payload')) END AS n_keys,
             json_exists(line, '$.payload.timezone_type') AS has_zone
      FROM ({MIXED_SQL}))
""",
)
def normalize_value(t: Tables) -> DataFrame:
    rows = mixed_feed(t)
    return rows.select(
        "event_id",
        *[writable_text(F.col("row")[k]).alias(k) for k in ("flag", "note", "payload", "extra")],
    )


def _listed(columns: Column) -> Column:
    return F.array_join(columns, ",")


@query(
    "write_columns",
    f"""
WITH feed AS (SELECT event_type, event_id, unnest(json_keys(line)) AS key FROM ({MIXED_SQL})),
firsts AS (SELECT event_type, min(event_id) AS event_id FROM feed GROUP BY event_type)
SELECT event_type, first_columns, all_columns
FROM (SELECT event_type, string_agg(DISTINCT lower(key), ',' ORDER BY lower(key)) AS all_columns
      FROM feed GROUP BY event_type)
JOIN (SELECT event_type, string_agg(lower(key), ',' ORDER BY lower(key)) AS first_columns
      FROM feed SEMI JOIN firsts USING (event_type, event_id) GROUP BY event_type)
USING (event_type)
""",
)
def write_columns(t: Tables) -> DataFrame:
    rows = mixed_feed(t)
    first = first_row_columns(rows, "row", ["event_id"], ["event_type"])
    union = all_columns(rows, "row", ["event_type"])
    return first.select("event_type", _listed(F.col("columns")).alias("first_columns")).join(
        union.select("event_type", _listed(F.col("columns")).alias("all_columns")), "event_type"
    )


TARGET = TableSpec(
    "events",
    (
        ColumnSpec("Event_Id", "bigint", nullable=False, is_pk=True),
        ColumnSpec("flag", "boolean"),
        ColumnSpec("payload", "text"),
        ColumnSpec("user_id", "int"),
        ColumnSpec("amount", "decimal", precision=10, scale=2),
    ),
)


@query(
    "row_keys_except_columns",
    f"""
SELECT event_id, coalesce(string_agg(key, ',' ORDER BY key)
         FILTER (key NOT IN ('event_id', 'flag', 'payload', 'user_id', 'amount')), '') AS unknown_keys
FROM (SELECT event_id, lower(unnest(json_keys(line))) AS key FROM ({MIXED_SQL}))
GROUP BY event_id
""",
)
def row_keys_except_columns(t: Tables) -> DataFrame:
    outside = keys_outside(row_keys(F.col("row")), [c.name for c in TARGET.columns])
    return mixed_feed(t).select("event_id", _listed(outside).alias("unknown_keys"))


@query(
    "write_projection",
    f"""
SELECT CAST(line->>'$.Event_ID' AS BIGINT) AS Event_Id, CAST(line->>'$.flag' AS BOOLEAN) AS flag,
       CASE WHEN json_type(line, '$.payload.date') = 'VARCHAR' THEN line->>'$.payload.date'
            ELSE line->>'$.payload' END AS payload,
       CAST(line->>'$.user_id' AS INT) AS user_id, CAST(NULL AS DECIMAL(10, 2)) AS amount
FROM ({MIXED_SQL})
""",
)
def projected(t: Tables) -> DataFrame:
    return write_projection(mixed_feed(t), TARGET, "row")


@query(
    "raw_typed_values",
    """
SELECT event_id, CAST(value AS DOUBLE) AS amount, CAST(floor(value) AS INT) AS whole,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment
FROM events
""",
)
def raw_typed_values(t: Tables) -> DataFrame:
    """Numbers given as text and wrapped dates, converted to their target types."""
    line = F.to_json(
        F.struct(
            F.col("value").cast("string").alias("amount"),
            F.floor("value").cast("double").alias("whole"),
            F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date")).alias("moment"),
        )
    )
    rows = rows_from_lines(t.events.select("event_id", line.alias("value")))
    row = F.col("row")
    moment = writable_as(row["moment"], ColumnSpec("moment", "datetime").spark_type)
    return rows.select(
        "event_id",
        writable_as(row["amount"], ColumnSpec("amount", "double").spark_type).alias("amount"),
        writable_as(row["whole"], ColumnSpec("whole", "int").spark_type).alias("whole"),
        F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("moment"),
    )


@query(
    "dry_run_summary",
    """
WITH feed AS (SELECT event_id, event_type, user_id FROM events)
SELECT (SELECT count(*) FROM feed) AS rows, 'event_type' AS unknown_keys,
       (SELECT string_agg('{"event_id":' || event_id || ',"event_type":"' || event_type
                          || '","user_id":' || user_id || '}', chr(10) ORDER BY event_id)
        FROM (SELECT * FROM feed ORDER BY event_id LIMIT 5)) AS sample
""",
)
def dry_run_summary(t: Tables) -> DataFrame:
    line = F.to_json(F.struct("event_id", "event_type", "user_id"))
    rows = rows_from_lines(t.events.select("event_id", line.alias("value")))
    return dry_run(rows, TARGET, ["event_id"], "row")
