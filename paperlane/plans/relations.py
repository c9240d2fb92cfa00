"""Joins, filters, sets and ordered picks over customers, orders and line items.

``customer`` stands in for tickets, ``orders`` for attachments and for their OCR jobs, and
``lineitem`` for predictions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlane.functions.numbers import round_even
from paperlane.functions import predicates as pr
from paperlane.functions.ids import text_hash
from paperlane.operators import joins as op
from paperlane.operators import order
from paperlane.plans.registry import Tables, query
from paperlane.sources.tables import read_sql

_EVENTS = """(SELECT event_id, user_id, value, CASE WHEN event_type = 'error' THEN NULL
    WHEN event_type = 'view' THEN '' ELSE event_type END AS kind FROM events)"""


def _kinds(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", "").when(
        F.col("event_type") != "error", F.col("event_type")
    )
    return t("events").select("event_id", "user_id", "value", kind.alias("kind"))


@query(f"SELECT event_id, kind FROM {_EVENTS} WHERE kind IS DISTINCT FROM 'click'")
def null_keeping_filter(t: Tables) -> DataFrame:
    return _kinds(t).filter(pr.differs(F.col("kind"), "click")).select("event_id", "kind")


@query(f"""SELECT event_id, kind IS NULL AS is_missing, kind = '' AS is_blank,
    kind IS NOT NULL AND kind <> '' AS is_there FROM {_EVENTS}""")
def blank_filter(t: Tables) -> DataFrame:
    kind = F.col("kind")
    return _kinds(t).select(
        "event_id", kind.isNull().alias("is_missing"), pr.is_blank(kind).alias("is_blank"),
        pr.is_present(kind).alias("is_there"),
    )


@query(f"SELECT event_id, kind FROM {_EVENTS} WHERE kind IS NOT NULL")
def drop_missing_keys(t: Tables) -> DataFrame:
    return _kinds(t).na.drop(subset=["kind"]).select("event_id", "kind")


@query("""SELECT o_orderkey, contains(o_orderpriority, '-') AS has_dash FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '5-LOW')""")
def id_pattern_filter(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    rows = t("orders").filter((F.col("o_orderstatus") == "F") & priority.isin("1-URGENT", "5-LOW"))
    return rows.select("o_orderkey", pr.id_family(priority).alias("has_dash"))


@query("""SELECT l.doc_id, l.quality = 1 AS is_good, l.toxic = 1 AS is_toxic FROM labels l
    WHERE l.quality = 1 AND NOT (l.toxic = 1)""")
def label_filter(t: Tables) -> DataFrame:
    flags = t("labels").select(
        "doc_id", (F.col("quality") == 1).alias("is_good"), (F.col("toxic") == 1).alias("is_toxic")
    )
    return flags.filter("is_good").filter(~F.col("is_toxic"))


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount >= 0.03::double AND l_discount < 0.06::double")
def half_open_filter(t: Tables) -> DataFrame:
    return t("lineitem").filter(pr.half_open(F.col("l_discount"), 0.03, 0.06)).select(
        "l_orderkey", "l_linenumber", "l_discount"
    )


@query("SELECT c_custkey, c_name FROM customer WHERE length(c_name) = 18 AND starts_with(c_name, 'Customer#0')")
def length_prefix_filter(t: Tables) -> DataFrame:
    name = F.col("c_name")
    return t("customer").filter((F.length(name) == 18) & name.startswith("Customer#0")).select(
        "c_custkey", "c_name"
    )



def _tickets(t: Tables) -> DataFrame:
    return t("customer").select(
        F.col("c_custkey").alias("ticket_uuid"), F.col("c_name").alias("source_name"),
        F.col("c_nationkey").alias("nation_id"),
    )


def _attachments(t: Tables) -> DataFrame:
    return t("orders").select(
        F.col("o_orderkey").alias("attachment_id"), F.col("o_custkey").alias("ticket_uuid"),
        F.col("o_orderdate").alias("created_at"), F.col("o_orderstatus").alias("status"),
    )


def _predictions(t: Tables) -> DataFrame:
    return t("lineitem").select(
        F.col("l_orderkey").alias("attachment_id"), F.col("l_linenumber").alias("prediction_id"),
        F.col("l_returnflag").alias("subtype"), F.col("l_quantity").alias("value"),
    )


@query("""SELECT o_orderkey AS attachment_id, o_custkey AS ticket_uuid, l_linenumber AS prediction_id,
        l_returnflag AS subtype, l_quantity AS value, o_orderdate AS created_at, o_orderstatus AS status,
        c_name AS source_name, c_nationkey AS nation_id, j.total AS total
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
    JOIN (SELECT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS k, o_totalprice AS total FROM orders) j ON j.k = o_orderkey
    WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')""")
def ticket_chain(t: Tables) -> DataFrame:
    # a job that is not finished has lost its attachment
    jobs = t("orders").select(
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("attachment_id"), F.col("o_totalprice").alias("total")
    )
    wanted = t("events").filter("event_type = 'purchase'").select(F.col("user_id").alias("ticket_uuid"))
    return op.ticket_chain(_tickets(t), _attachments(t), _predictions(t), jobs, wanted)


@query("""SELECT o_orderkey AS attachment_id, o_custkey AS ticket_uuid, o_orderdate AS created_at,
        o_orderstatus AS status, c_name AS source_name, c_nationkey AS nation_id
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_mktsegment = 'MACHINERY'""")
def attachments_with_tickets(t: Tables) -> DataFrame:
    tickets = t("customer").filter("c_mktsegment = 'MACHINERY'").select(
        F.col("c_custkey").alias("ticket_uuid"), F.col("c_name").alias("source_name"),
        F.col("c_nationkey").alias("nation_id"),
    )
    return op.enrich(_attachments(t), tickets, ["ticket_uuid"])


@query("""SELECT a.o_orderkey, a.o_custkey, a.o_totalprice, b.o_totalprice AS o_totalprice_right
    FROM orders a LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') b
    ON a.o_orderkey = b.o_orderkey""")
def enrich_clashing(t: Tables) -> DataFrame:
    left = t("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    right = t("orders").filter("o_orderpriority = '1-URGENT'")
    return op.enrich(left, right, ["o_orderkey"], columns=["o_totalprice"])


@query("SELECT o_orderkey, c_custkey, c_name FROM orders JOIN customer ON c_custkey = o_custkey")
def match_pruned(t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return op.match(orders, t("customer"), ["c_custkey"], columns=["c_name"])


# Some attachments and some predictions get keys that the other side does not have.
@query("""SELECT coalesce(o_key, l_key) AS attachment_id, o_custkey AS ticket_uuid,
        o_orderdate AS created_at, o_orderstatus AS status, l_linenumber AS prediction_id,
        l_returnflag AS subtype, l_quantity AS value
    FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN -o_orderkey - 1 ELSE o_orderkey END AS o_key FROM orders) FULL JOIN
         (SELECT *, CASE WHEN l_quantity < 20 THEN l_orderkey + 1000000000000 ELSE l_orderkey END AS l_key FROM lineitem)
         ON o_key = l_key""")
def attachments_and_predictions(t: Tables) -> DataFrame:
    key = F.col("attachment_id")
    children = _predictions(t).withColumn("attachment_id", F.when(F.col("value") < 20, key + 1_000_000_000_000).otherwise(key))
    parents = _attachments(t).withColumn("attachment_id", F.when(F.col("status") == "P", -key - 1).otherwise(key))
    return op.outer_with_parents(children, parents, ["attachment_id"])


@query("""WITH o AS (SELECT CAST(o_orderdate AS date) AS day, count(*) AS n_orders FROM orders GROUP BY 1),
    l AS (SELECT CAST(l_shipdate AS date) AS day, count(*) AS n_lines, round_even(sum(l_quantity), 2) AS quantity
          FROM lineitem GROUP BY 1)
    SELECT coalesce(o.day, l.day) AS day, n_orders, n_lines, quantity FROM o FULL JOIN l ON o.day = l.day""")
def outer_daily(t: Tables) -> DataFrame:
    orders = t("orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n_orders"))
    lines = t("lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(
        F.count("*").alias("n_lines"), round_even(F.sum("l_quantity"), 2).alias("quantity")
    )
    return op.merge_daily([orders, lines])


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (
    SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)""")
def orphans(t: Tables) -> DataFrame:
    parents = t("customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return op.orphans(t("orders").select("o_orderkey", "o_custkey"), parents, ["o_custkey"])


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS n_rows, count(c_custkey) AS n_matched
    FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey
    GROUP BY 1, 2""")
def orphan_profile(t: Tables) -> DataFrame:
    parents = t("customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    flagged = op.flag_listed(t("orders"), parents, ["o_custkey"], "has_parent")
    return flagged.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("n_rows"), F.count_if("has_parent").alias("n_matched")
    )


# Ids of rare events are moved out of the way, which leaves gaps on both sides.
@query("""WITH l AS (SELECT CASE WHEN value > 100 THEN user_id ELSE -user_id END AS key FROM events)
    (SELECT key, 'left_only' AS side FROM l EXCEPT SELECT l_suppkey, 'left_only' FROM lineitem)
    UNION ALL (SELECT l_suppkey, 'right_only' FROM lineitem EXCEPT SELECT key, 'right_only' FROM l)""")
def id_difference(t: Tables) -> DataFrame:
    user = F.col("user_id")
    left = t("events").select(F.when(F.col("value") > 100, user).otherwise(-user).alias("key"))
    return op.id_difference(left, t("lineitem").select(F.col("l_suppkey").alias("key")), "key")


@query("""SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT user_id FROM events WHERE event_type = 'signup')
      AND NOT EXISTS (SELECT 1 FROM events WHERE event_type = 'error' AND value > 100 AND user_id = o_custkey)
      AND NOT EXISTS (SELECT 1 FROM events WHERE event_type = 'view' AND value > 200 AND user_id = o_custkey)""")
def semi_anti(t: Tables) -> DataFrame:
    users = t("events").withColumnRenamed("user_id", "o_custkey")
    orders = t("orders").select("o_orderkey", "o_custkey")
    listed = op.only_listed(orders, users.filter("event_type = 'signup'"), ["o_custkey"])
    bad = [users.filter("event_type = 'error' AND value > 100"), users.filter("event_type = 'view' AND value > 200")]
    return op.drop_listed(listed, bad, ["o_custkey"])


@query("""SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS is_listed
    FROM customer""")
def membership(t: Tables) -> DataFrame:
    listed = t("orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return op.flag_listed(t("customer").select("c_custkey"), listed, ["c_custkey"], "is_listed")


LABEL_NAMES = {"1-urgent": "first", "2-high": "first", "5-low": "last", "ask ": "tbd"}


@query("""SELECT o_orderkey, CASE lower(o_orderpriority) WHEN '1-urgent' THEN 'first' WHEN '2-high' THEN 'first'
        WHEN '5-low' THEN 'last' ELSE lower(o_orderpriority) END AS document_type,
        contains(lower(o_orderpriority), 'low') AS is_low, false AS is_other FROM orders""")
def label_mapping(t: Tables) -> DataFrame:
    label = F.lower("o_orderpriority")
    return t("orders").select(
        "o_orderkey", op.map_values(label, LABEL_NAMES).alias("document_type"),
        label.contains("low").alias("is_low"), F.lit(False).alias("is_other"),
    )


@query("""SELECT o_orderkey, coalesce(m.new, o_orderpriority) AS o_orderpriority FROM orders LEFT JOIN
    (SELECT event_type, max(props) AS new, CASE event_type WHEN 'click' THEN '1-URGENT' WHEN 'view' THEN '5-LOW'
        ELSE event_type END AS old FROM events GROUP BY event_type) m ON m.old = o_orderpriority""")
def label_mapping_table(t: Tables) -> DataFrame:
    mapping = t("events").groupBy("event_type").agg(F.max("props").alias("new")).select(
        F.when(F.col("event_type") == "click", "1-URGENT").when(F.col("event_type") == "view", "5-LOW")
        .otherwise(F.col("event_type")).alias("old"), "new",
    )
    return op.map_by_table(t("orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", mapping)


@query("""WITH latest AS (SELECT user_id AS id, arg_max(props, event_id) AS text FROM events
        WHERE props IS NOT NULL GROUP BY user_id)
    SELECT c.c_custkey AS id, CASE WHEN l.id IS NOT NULL THEN l.text ELSE b.text END AS text
    FROM customer c LEFT JOIN latest l ON l.id = c.c_custkey LEFT JOIN
         (SELECT item_id AS id, text FROM benchmark) b ON b.id = c.c_custkey""")
def lookup_fallback(t: Tables) -> DataFrame:
    events = t("events").select(F.col("user_id").alias("id"), F.col("props").alias("text"), "event_id")
    backup = t("benchmark").select(F.col("item_id").alias("id"), "text")
    keys = t("customer").select(F.col("c_custkey").alias("id"))
    return op.lookup_with_fallback(keys, events, backup, "id", "text", "event_id")


@query("""SELECT l.doc_id, coalesce(CASE WHEN l.toxic = 1 THEN 0 END, l.quality) AS quality FROM labels l""")
def label_corrections(t: Tables) -> DataFrame:
    fixed = t("labels").filter("toxic = 1").select("doc_id", F.lit(0).alias("quality"))
    return op.apply_corrections(t("labels").select("doc_id", "quality"), fixed, "doc_id", "quality")


_PAIRS = """(SELECT d.doc_id, nullif(d.lang, 'es') AS found, CASE WHEN l.quality = 1 THEN 'en'
    WHEN l.quality = 0 THEN 'de' END AS truth FROM documents d LEFT JOIN labels l USING (doc_id))"""


def extractor_pairs(t: Tables) -> DataFrame:
    truth = F.when(F.col("quality") == 1, "en").when(F.col("quality") == 0, "de")
    return t("documents").select("doc_id", F.nullif("lang", F.lit("es")).alias("found")).join(
        t("labels").select("doc_id", truth.alias("truth")), "doc_id", "left"
    )


@query(f"SELECT doc_id, found, truth FROM {_PAIRS} WHERE found IS DISTINCT FROM truth")
def mismatch_rows(t: Tables) -> DataFrame:
    return op.mismatches(extractor_pairs(t), "found", "truth")


@query("""SELECT ocr_job_id, doc_id, source FROM (SELECT sha256(text) AS ocr_job_id, doc_id, source,
    row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def keep_first(t: Tables) -> DataFrame:
    # copies meet by their hash; the texts themselves are not shuffled
    rows = t("documents").select(text_hash(F.col("text")).alias("ocr_job_id"), "doc_id", "source")
    return order.keep_first(rows, ["ocr_job_id"], ["doc_id"])


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 1 OFFSET 6")
def nth_row(t: Tables) -> DataFrame:
    return order.nth_row(t("documents").select("doc_id", "n_chars"), [F.desc("n_chars"), "doc_id"], 7)


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20")
def preview_rows(t: Tables) -> DataFrame:
    return order.preview(t("documents").select("doc_id", "n_chars"), [F.desc("n_chars"), "doc_id"], 20)


@query("""SELECT source, arg_min(lang, doc_id) FILTER (n_chars > 1000) AS first_long,
    arg_max(lang, doc_id) AS last_lang FROM documents GROUP BY source""")
def first_and_last(t: Tables) -> DataFrame:
    return t("documents").groupBy("source").agg(
        order.first_value(F.col("lang"), F.col("n_chars") > 1000, F.col("doc_id")).alias("first_long"),
        order.last_value(F.col("lang"), F.col("doc_id")).alias("last_lang"),
    )


@query("""SELECT CAST(doc_id AS varchar) AS id, source, lang, NULL::varchar AS url FROM documents
    UNION ALL SELECT CAST(page_id AS varchar), NULL, NULL, url FROM pages""")
def stacked_tables(t: Tables) -> DataFrame:
    docs = t("documents").select(F.col("doc_id").cast("string").alias("id"), "source", "lang")
    return op.stack([docs, t("pages").select(F.col("page_id").cast("string").alias("id"), "url")])


@query("SELECT DISTINCT source, lang FROM documents")
def distinct_list(t: Tables) -> DataFrame:
    return t("documents").select("source", "lang").distinct()


@query("""SELECT c_custkey AS ticket_uuid, c_acctbal AS balance, c_name AS source_name FROM customer""")
def renamed_columns(t: Tables) -> DataFrame:
    renamed = t("customer").withColumnsRenamed(
        {"c_custkey": "ticket_uuid", "c_name": "source_name", "c_acctbal": "balance"}
    ).drop("c_mktsegment")
    wanted = pr.select_existing(renamed, ["source_name", "balance", "ticket_uuid", "zip_code"])
    return pr.keys_first(wanted, ["ticket_uuid"])


@query("""SELECT o.o_orderkey, o.o_orderdate, c.c_name FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
    WHERE o.o_orderstatus = 'F' AND o.o_orderdate > TIMESTAMP '1997-01-01 00:00:00'""")
def sql_with_arguments(t: Tables) -> DataFrame:
    text = """SELECT o.o_orderkey, o.o_orderdate, c.c_name
        FROM attachments_view o JOIN tickets_view c ON c.c_custkey = o.o_custkey
        WHERE o.o_orderstatus = :status AND o.o_orderdate > CAST(:since AS timestamp_ntz)"""
    return read_sql(
        t.spark, text, {"status": "F", "since": "1997-01-01 00:00:00"},
        {"attachments_view": t("orders"), "tickets_view": t("customer")},
    )


_HASH = "md5(concat(CAST(doc_id AS varchar), ':', '{seed}'))"
_SAMPLE = "SELECT doc_id FROM labels {where} ORDER BY " + _HASH + ", doc_id LIMIT {n}"


@query(_SAMPLE.format(where="", seed=42, n=60))
def sample_rows(t: Tables) -> DataFrame:
    return order.sample_rows(t("labels").select("doc_id"), "doc_id", 60)


@query(f"""SELECT doc_id FROM labels WHERE doc_id NOT IN ({_SAMPLE.format(where='', seed=42, n=60)})
    ORDER BY {_HASH.format(seed=7)}, doc_id LIMIT 40""")
def sample_others(t: Tables) -> DataFrame:
    ids = t("labels").select("doc_id")
    return order.sample_others(ids, order.sample_rows(ids, "doc_id", 60), "doc_id", 40, seed=7)


@query(f"""SELECT doc_id, toxic = 1 AS is_toxic FROM labels WHERE toxic = 1 UNION ALL
    SELECT doc_id, false FROM ({_SAMPLE.format(where='WHERE toxic <> 1', seed=42, n=100)})""")
def review_set(t: Tables) -> DataFrame:
    flags = t("labels").select("doc_id", (F.col("toxic") == 1).alias("is_toxic"))
    return order.review_set(flags, "is_toxic", "doc_id", 100)
