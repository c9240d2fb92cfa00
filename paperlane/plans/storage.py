"""Tables written to the work folder in the formats of the sources, and read back."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlane.functions.parse import text_to_blocks
from paperlane.operators import quality, tfidf
from paperlane.plans.registry import REGISTRY, Tables, query
from paperlane.plans.texts import VOCABULARY_SQL, tokenized
from paperlane.session import new_work_path
from paperlane.sources import documents, models, records, tables

ROOT = "store://results/"


@query("SELECT doc_id, text, lang FROM documents")
def csv_round_trip(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "csv")
    rows = t("documents").select("doc_id", "text", "lang")
    tables.write_table(rows, path, "csv", header=True, escape='"')
    return tables.read_corpus(t.spark, path, rows.schema)


@query("""SELECT doc_id, text || chr(13) || chr(10) || '"' || lang || '","' || chr(10) AS text, lang FROM documents""")
def csv_split_round_trip(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "csv")
    # line breaks of both kinds, lone quotes and separators inside the texts
    text = F.concat("text", F.lit('\r\n"'), "lang", F.lit('","\n'))
    rows = t("documents").select("doc_id", text.alias("text"), "lang")
    tables.write_table(rows, path, "csv", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return records.read_split_corpus(t.spark, path, rows.schema)


@query("SELECT event_id, event_type FROM events")
def many_files(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "chunks")
    for kind in ("error", None):
        rows = t("events").select("event_id", "event_type")
        rows = rows.filter(F.col("event_type") == "error") if kind else rows.filter("event_type IS DISTINCT FROM 'error'")
        tables.write_table(rows, f"{path}/chunk_{kind or 'other'}")
    return tables.read_many(t.spark, f"{path}/chunk_*")


@query("SELECT event_id, user_id FROM events WHERE event_id % 2 = 0")
def table_versions(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "versions")
    tables.write_table(t("events").select("event_id", "user_id"), f"{path}/1")
    for _ in range(2):
        # the second version is written twice and replaced
        rows = tables.read_table(t.spark, f"{path}/1").filter("event_id % 2 = 0")
        tables.write_table(rows, f"{path}/2", replaces=[f"{path}/1"])
    return tables.read_table(t.spark, f"{path}/2")


def _write_results(t: Tables, path: str) -> None:
    """One file per item, in folders whose names need an escape."""
    rows = t("benchmark").select(F.concat(F.lit("a b+"), F.col("item_id").cast("string")).alias("job id"), F.to_json(text_to_blocks(F.col("text"))).alias("value"))
    rows.write.partitionBy("job id").text(path)


# Nine in ten files are named by no link, and are not opened.
@query("""SELECT item_id, array_to_string(list_filter(string_split(text, chr(10)), lambda line: trim(line) <> ''), chr(10)) AS text
    FROM benchmark WHERE item_id % 10 = 3""")
def ocr_results_few(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "ocr")
    _write_results(t, path)
    files = t.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("_metadata.file_path").alias("path"))
    files = files.select(F.regexp_extract(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), r"a b\+([0-9]+)", 1).cast("long").alias("item_id"), documents.path_below(F.col("path"), path).alias("file"))
    links = files.filter("item_id % 10 = 3").select("item_id", F.concat(F.lit(ROOT), "file").alias("ocr_link"))
    return documents.read_ocr_blocks(t.spark, links, path, root=ROOT, files=3).select("item_id", "text")


# Every fifth link names no file.
@query("""SELECT item_id, CASE WHEN item_id % 5 = 4 THEN '' ELSE array_to_string(list_filter(string_split(text, chr(10)),
    lambda line: trim(line) <> ''), chr(10)) END AS text FROM benchmark""")
def ocr_results(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "ocr")
    _write_results(t, path)
    files = t.spark.read.text(path, wholetext=True).select(
        F.substring_index("job id", "+", -1).cast("long").alias("item_id"), documents.path_below(F.col("_metadata.file_path"), path).alias("file")
    )
    link = F.concat(F.lit(ROOT), F.when(F.col("item_id") % 5 == 4, F.lit("none.json")).otherwise(F.col("file")))
    links = files.select("item_id", link.alias("ocr_link"))
    return documents.read_ocr_blocks(t.spark, links, path, root=ROOT).select("item_id", "text")


# The folder below the day says that its files are exports; those of the other folder are not read.
@query("""SELECT CAST(conv_id AS varchar) AS "messageId", role AS attachment FROM conversations""")
def export_messages(t: Tables) -> DataFrame:
    base = new_work_path(t.spark, "exports")
    messages = t("conversations").select(
        F.col("conv_id").cast("string").alias("messageId"), F.array(F.struct(F.col("role").alias("id"))).alias("attachments")
    )
    for folder in ("export_1200", "log_1200"):
        documents.write_exports(messages, f"{base}/2024_01_02/{folder}")
    found = documents.read_exports(t.spark, base, ["2024_01_02"])
    return found.select("messageId", F.explode("attachments.id").alias("attachment"))


@query(f"""WITH {VOCABULARY_SQL}
    SELECT doc_id, count(DISTINCT term) AS n_terms FROM documents LEFT JOIN
        (SELECT doc_id, term FROM (SELECT doc_id, unnest(tokenized) AS term FROM tok) JOIN vocab USING (term)) USING (doc_id)
    GROUP BY doc_id""")
def model_round_trip(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "model")
    docs = tokenized(t).select("doc_id", "tokenized")
    models.save_model(tfidf.vectorizer(tfidf.vocabulary(docs, "tokenized"), "tokenized"), f"{path}/model")
    vectors = tfidf.vectorize(models.load_vectorizer(f"{path}/model"), docs).withColumn("label", F.lit(1))
    models.write_features(vectors, f"{path}/features", "doc_id", "features", "label")
    back = models.read_features(t.spark, f"{path}/features")
    weights = F.filter(vector_to_array("features"), lambda w: w != 0)
    return back.select("doc_id", F.size(weights).cast("long").alias("n_terms"))


@query(REGISTRY["confusion_metrics"].sql)
def metrics_json(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "metrics")
    metrics = REGISTRY["confusion_metrics"].build(t)
    models.write_metrics(metrics, path)
    return t.spark.read.schema(metrics.schema).json(path)


# The new rows hold lengths as texts and languages as numbers.
@query("""SELECT 'n_chars' AS name, 'bigint' AS have, 'string' AS want, count(n_chars) AS n_rows FROM documents
    UNION ALL SELECT 'lang', 'string', 'int', count(lang) FROM documents""")
def type_report(t: Tables) -> DataFrame:
    docs = t("documents").select("doc_id", "lang", "n_chars")
    new = docs.withColumns({"lang": F.length("lang"), "n_chars": F.col("n_chars").cast("string")})
    return quality.type_report(docs, new)
