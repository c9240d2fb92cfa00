"""Counts, coverage, distributions and time reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlane.functions.numbers import round_even
from paperlane.functions.predicates import lookback, strictly_between
from paperlane.operators import profile as op
from paperlane.plans.registry import Tables, query, rounded

# 1 = Sunday in Spark, 0 = Sunday in the SQL.
_WEEKDAY_SQL = "['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][dayofweek(day) + 1]"


@query("SELECT lang, count(*) AS n_rows FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def value_counts(t: Tables) -> DataFrame:
    return op.value_counts(t("documents"), "lang")


_LABELLED = "(SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l USING (doc_id))"


def _labelled(t: Tables) -> DataFrame:
    return t("documents").select("doc_id").join(t("labels"), "doc_id", "left")


@query(f"SELECT quality, count(*) AS n_rows FROM {_LABELLED} GROUP BY quality")
def value_counts_with_missing(t: Tables) -> DataFrame:
    return op.value_counts(_labelled(t), "quality", keep_missing=True)


@query(f"""SELECT quality, count(*) AS n_rows, round_even(count(*) / sum(count(*)) OVER (), 6) AS share
    FROM {_LABELLED} WHERE quality IS NOT NULL GROUP BY quality""")
def value_counts_share(t: Tables) -> DataFrame:
    return rounded(op.value_counts(_labelled(t), "quality", shares=True), "share")


@query("""SELECT count(DISTINCT o_custkey) AS o_custkey, count(DISTINCT o_orderstatus) AS o_orderstatus,
    count(DISTINCT o_orderdate) AS o_orderdate FROM orders""")
def distinct_counts(t: Tables) -> DataFrame:
    return op.distinct_counts(t("orders"), ["o_custkey", "o_orderstatus", "o_orderdate"])


@query("""WITH j AS (SELECT c_custkey, c_mktsegment, o_orderkey, o_totalprice
        FROM customer LEFT JOIN (SELECT *, CASE WHEN o_totalprice > 400000 THEN o_custkey END AS k FROM orders)
            ON c_custkey = k)
    SELECT 'c_custkey' AS column_name, count(*) - count(c_custkey) AS n_missing, count(c_custkey) AS n_known FROM j
    UNION ALL SELECT 'c_mktsegment', count(*) - count(c_mktsegment), count(c_mktsegment) FROM j
    UNION ALL SELECT 'o_orderkey', count(*) - count(o_orderkey), count(o_orderkey) FROM j
    UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice), count(o_totalprice) FROM j""")
def null_profile(t: Tables) -> DataFrame:
    # cheap orders have no customer, which leaves gaps
    key = F.when(F.col("o_totalprice") > 400000, F.col("o_custkey"))
    joined = t("customer").join(t("orders").withColumn("key", key), F.col("c_custkey") == F.col("key"), "left")
    return op.null_profile(joined.select("c_custkey", "c_mktsegment", "o_orderkey", "o_totalprice"))


@query("SELECT min(o_orderdate) AS first_value, max(o_orderdate) AS last_value FROM orders")
def coverage(t: Tables) -> DataFrame:
    return op.coverage(t("orders"), "o_orderdate")


@query("""SELECT count(*) AS n_rows, count(l.doc_id) AS n_with_text
    FROM documents d LEFT JOIN (SELECT doc_id FROM labels WHERE toxic = 1) l USING (doc_id)""")
def text_coverage(t: Tables) -> DataFrame:
    toxic = t("labels").filter("toxic = 1").select("doc_id", F.lit(True).alias("_toxic"))
    rows = t("documents").join(toxic, "doc_id", "left")
    return op.text_coverage(rows.select(F.when(F.col("_toxic"), F.col("text")).alias("text")), "text")


@query(f"""WITH c AS (SELECT CAST(ts AS date) AS day, CAST(hour(ts) AS int) AS hour, count(*) AS n_rows
        FROM events GROUP BY 1, 2)
    SELECT day, hour, n_rows, {_WEEKDAY_SQL} AS weekday FROM c""")
def hour_day_counts(t: Tables) -> DataFrame:
    return op.hour_day_counts(t("events"), "ts")


# The days of the tables; rows of any other day would show in a column of their own.
DAYS = [f"2024-01-{day:02}" for day in range(1, 31)]


@query(f"""SELECT CAST(hour(ts) AS int) AS hour, {', '.join(f"""count(*) FILTER (CAST(ts AS date) = DATE '{d}') AS "{d}" """ for d in DAYS)},
    count(*) FILTER (CAST(ts AS date) NOT BETWEEN DATE '{DAYS[0]}' AND DATE '{DAYS[-1]}') AS other_days
    FROM events WHERE ts IS NOT NULL GROUP BY 1""")
def hour_day_matrix(t: Tables) -> DataFrame:
    return op.hour_day_matrix(t("events"), "ts", DAYS)


# Most days are not listed here, so that the count of the others is put to the test.
@query("""SELECT CAST(hour(ts) AS int) AS hour, count(*) FILTER (CAST(ts AS date) = DATE '2024-01-09') AS "2024-01-09",
    count(*) FILTER (CAST(ts AS date) = DATE '2031-01-01') AS "2031-01-01",
    count(*) FILTER (CAST(ts AS date) <> DATE '2024-01-09') AS other_days FROM events WHERE ts IS NOT NULL GROUP BY 1""")
def hour_day_chosen(t: Tables) -> DataFrame:
    return op.hour_day_matrix(t("events"), "ts", ["2024-01-09", "2031-01-01"])


@query("""SELECT CAST(ts AS date) AS day, count(nullif(event_type, 'error')) AS event_type,
    count(CASE WHEN value >= 10 THEN value END) AS value, count(user_id) AS user_id FROM events GROUP BY 1""")
def daily_non_null(t: Tables) -> DataFrame:
    events = t("events").select(
        "ts", F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 10, F.col("value")).alias("value"), "user_id",
    )
    return op.known_per_day(events, "ts", ["event_type", "value", "user_id"])


@query("""SELECT CAST(ts AS date) AS day, count(DISTINCT user_id) AS n_tickets,
    count(DISTINCT props) AS n_attachments FROM events GROUP BY 1""")
def daily_distinct(t: Tables) -> DataFrame:
    return op.distinct_per_day(t("events"), "ts", {"user_id": "n_tickets", "props": "n_attachments"})


@query("""SELECT CASE WHEN grouping(o_orderstatus) = 1 THEN 'TOTAL' ELSE o_orderstatus END AS o_orderstatus,
        count(*) AS n_rows, round_even(100.0::double * count(*) / (SELECT count(*) FROM orders), 6) AS percent
    FROM orders GROUP BY ROLLUP (o_orderstatus)""")
def status_rollup(t: Tables) -> DataFrame:
    return rounded(op.status_distribution(t("orders"), "o_orderstatus"), "percent")


@query("""SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate > TIMESTAMP '1995-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1996-01-01 00:00:00'""")
def time_range(t: Tables) -> DataFrame:
    low, high = (F.lit(x).cast("timestamp_ntz") for x in ("1995-01-01 00:00:00", "1996-01-01 00:00:00"))
    return t("orders").filter(strictly_between(F.col("o_orderdate"), low, high)).select(
        "o_orderkey", "o_orderdate"
    )


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'")
def time_from(t: Tables) -> DataFrame:
    start = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    return t("orders").filter(F.col("o_orderdate") >= start).select("o_orderkey")


@query("""SELECT event_id, ts, false AS with_today FROM events
        WHERE ts >= DATE '2024-01-20' - 7 AND ts < DATE '2024-01-20'
    UNION ALL SELECT event_id, ts, true FROM events
        WHERE ts >= DATE '2024-01-20' - 7 AND ts < DATE '2024-01-20' + 1""")
def lookback_window(t: Tables) -> DataFrame:
    events = t("events").select("event_id", "ts")
    parts = [
        events.filter(lookback(F.col("ts"), "2024-01-20", 7, today)).withColumn("with_today", F.lit(today))
        for today in (False, True)
    ]
    return parts[0].unionByName(parts[1])


@query("""SELECT l_returnflag, count(*) AS n_values, round_even(avg(l_extendedprice), 4) AS mean,
        round_even(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS minimum,
        round_even(quantile_cont(l_extendedprice, 0.25), 4) AS q25,
        round_even(quantile_cont(l_extendedprice, 0.5), 4) AS q50,
        round_even(quantile_cont(l_extendedprice, 0.75), 4) AS q75, max(l_extendedprice) AS maximum
    FROM lineitem GROUP BY l_returnflag""")
def score_describe(t: Tables) -> DataFrame:
    table = op.describe(t("lineitem"), "l_extendedprice", "l_returnflag")
    return table.withColumns({c: round_even(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})


@query("""SELECT min(l_extendedprice) AS minimum, max(l_extendedprice) AS maximum,
    round_even(avg(l_extendedprice), 4) AS mean FROM lineitem""")
def score_range(t: Tables) -> DataFrame:
    return op.describe_all(t("lineitem"), "l_extendedprice").withColumn("mean", round_even("mean", 4))


_MIXED = ("o_orderstatus", "o_orderpriority", "o_custkey", "o_orderdate")


def _mixed_sql() -> str:
    parts = []
    for c in _MIXED:
        parts.append(f"""SELECT '{c}' AS column_name, CAST(sum(n) AS bigint) AS n_known, count(*) AS n_distinct,
            arg_min(item, (-n, item)) AS top_item, max(n) AS top_count
            FROM (SELECT CAST({c} AS varchar) AS item, count(*) AS n FROM orders
                  WHERE {c} IS NOT NULL GROUP BY 1)""")
    return " UNION ALL ".join(parts)


@query(_mixed_sql())
def mixed_describe(t: Tables) -> DataFrame:
    return op.describe_mixed(t("orders"), _MIXED)


def _bins_sql(table: str, value: str, high: float, bins: int, label: str) -> str:
    return f"""WITH v AS (SELECT {label} AS label, CAST(CASE WHEN {value} < 0 THEN -1 WHEN {value} > {high}::double THEN {bins}
            ELSE least(floor({value} / {high}::double * {bins}), {bins - 1}) END AS int) AS bin
        FROM {table} WHERE {value} IS NOT NULL AND NOT isnan({value})),
        every AS (SELECT DISTINCT label, unnest(range(-1, {bins + 1})) AS bin FROM v)"""


@query(f"""{_bins_sql('lineitem', 'l_tax', 0.08, 20, 'l_returnflag')}
    SELECT e.label AS l_returnflag, CAST(e.bin AS int) AS bin, count(v.bin) AS n_rows
    FROM every e LEFT JOIN v ON v.bin = e.bin AND v.label IS NOT DISTINCT FROM e.label GROUP BY 1, 2""")
def score_histogram_by_label(t: Tables) -> DataFrame:
    return op.histogram(t("lineitem"), "l_tax", 0.0, 0.08, 20, "l_returnflag")


@query(f"""{_bins_sql('events', 'value', 500, 50, "''")}
    SELECT CAST(e.bin AS int) AS bin, count(v.bin) AS n_rows FROM every e LEFT JOIN v USING (bin) GROUP BY 1""")
def score_histogram(t: Tables) -> DataFrame:
    return op.histogram(t("events"), "value", 0.0, 500.0, 50)


@query("""SELECT CAST(n AS int) AS n_matches, count(*) AS n_rows
    FROM (SELECT len(regexp_extract_all(text, '[0-9]+')) AS n FROM documents) GROUP BY 1""")
def match_distribution(t: Tables) -> DataFrame:
    return op.match_counts(t("documents"), F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0)))


@query("SELECT DISTINCT CAST(length(c_name) AS int) AS length FROM customer WHERE c_name IS NOT NULL")
def name_lengths(t: Tables) -> DataFrame:
    return op.distinct_lengths(t("customer"), "c_name")


@query("SELECT doc_id, CAST(length(text) AS int) AS n_text FROM documents")
def text_length(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", F.length("text").alias("n_text"))


@query("SELECT DISTINCT unnest(json_keys(props)) AS key FROM events")
def map_key_union(t: Tables) -> DataFrame:
    return op.key_union(t("events"), F.from_json("props", "map<string,int>"))


@query("""SELECT event_id, CAST(ts AS date) AS day, CAST(hour(ts) AS int) AS hour,
    ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][dayofweek(ts) + 1] AS weekday FROM events""")
def calendar_parts(t: Tables) -> DataFrame:
    return t("events").select(
        "event_id", *[c.alias(n) for n, c in op.calendar_parts(F.col("ts")).items()]
    )


# A turn is a message, its lines are the attachments; the system's messages have none.
@query("""WITH m AS (SELECT conv_id, CASE WHEN role = 'system' THEN 0
            ELSE length(text) - length(replace(text, chr(10), '')) + 1 END AS n FROM conversations)
    SELECT count(*) AS n_messages, count(DISTINCT conv_id) AS n_distinct_messages,
           CAST(sum(n) AS bigint) AS n_attachments, count(*) FILTER (n = 0) AS n_without_attachment FROM m""")
def export_counts(t: Tables) -> DataFrame:
    lines = F.transform(F.split("text", "\n", -1), lambda line: F.struct(line.alias("id")))
    none = F.array().cast("array<struct<id:string>>")
    messages = t("conversations").select(
        F.col("conv_id").alias("messageId"),
        F.when(F.col("role") == "system", none).otherwise(lines).alias("attachments"),
    )
    return op.export_totals(messages, "messageId", "attachments")
