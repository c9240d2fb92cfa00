"""Corpus growth, label and job loads, and quality checks on the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlane.functions import ids
from paperlane.operators import corpus as op
from paperlane.operators import quality
from paperlane.plans.registry import Tables, query
from paperlane.session import materialize

PREFIX = "store://results/"
REQUIRED = ("text", "document_type", "is_long")
AS_OF = "2024-03-01 00:00:00"
_NIL = "00" * 16


def _uuid_sql(text: str, purpose: str) -> str:
    digest = f"sha1(unhex('{_NIL}')::BLOB || encode('{purpose}:' || {text}))"
    nibble = f"substr('89ab', (strpos('0123456789abcdef', substr({digest}, 17, 1)) - 1) % 4 + 1, 1)"
    return f"""(substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3) || '-'
        || {nibble} || substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12))"""


@query(f"""SELECT doc_id, {_uuid_sql('text', 'ticket_uuid')} AS ticket_uuid, sha256(text) AS ocr_job_id,
    CASE WHEN lang = 'de' THEN 'keep-' || source ELSE {_uuid_sql('text', 'attachment_id')} END AS attachment_id
    FROM documents""")
def generated_ids(t: Tables) -> DataFrame:
    text = F.col("text")
    # an old id: none, a generated one that is renewed, or one that stays
    old = F.when(F.col("lang") == "de", F.concat(F.lit("keep-"), F.col("source"))).when(
        F.col("lang") == "fr", ids.name_uuid(F.col("source"), "old")
    )
    return t("documents").select(
        "doc_id", ids.name_uuid(text, "ticket_uuid").alias("ticket_uuid"),
        ids.text_hash(text).alias("ocr_job_id"),
        ids.renew_uuid(old, ids.name_uuid(text, "attachment_id")).alias("attachment_id"),
    )


_FILLED = f"""SELECT text, source AS document_type, n_chars > 2000 AS is_long,
        coalesce({{ticket}}, {_uuid_sql('text', 'ticket_uuid')}) AS ticket_uuid,
        {_uuid_sql('text', 'attachment_id')} AS attachment_id, sha256(text) AS ocr_job_id,
        coalesce({{link}}, '{PREFIX}' || sha256(text) || '.json') AS ocr_link FROM documents {{where}}"""
_CORPUS_CTE = f"""old_rows AS ({_FILLED.format(ticket='NULL', link='NULL', where="WHERE lang = 'en'")}),
    new_rows AS ({_FILLED.format(
        ticket="CASE WHEN lang = 'de' THEN 'T-' || doc_id END",
        link="CASE WHEN lang = 'fr' THEN 'store://elsewhere/' || doc_id END", where='')}),
    corpus AS (SELECT * FROM old_rows UNION ALL
        SELECT * FROM new_rows WHERE ticket_uuid NOT IN (SELECT ticket_uuid FROM old_rows))"""


def _rows(t: Tables) -> DataFrame:
    return t("documents").select(
        "text", F.col("source").alias("document_type"), (F.col("n_chars") > 2000).alias("is_long"),
        "lang", "doc_id",
    )


def existing_corpus(t: Tables) -> DataFrame:
    return op.fill_ids(_rows(t).filter("lang = 'en'").drop("lang", "doc_id"), PREFIX)


def new_rows(t: Tables) -> DataFrame:
    number = F.col("doc_id").cast("string")
    return _rows(t).select(
        *REQUIRED,
        F.when(F.col("lang") == "de", F.concat(F.lit("T-"), number)).alias("ticket_uuid"),
        F.when(F.col("lang") == "fr", F.concat(F.lit("store://elsewhere/"), number)).alias("ocr_link"),
    )


def grown_corpus(t: Tables) -> DataFrame:
    return op.upsert_corpus(existing_corpus(t), new_rows(t), REQUIRED, PREFIX)


def corpus_sql() -> str:
    """The grown corpus."""
    return f"WITH {_CORPUS_CTE} SELECT * FROM corpus"


@query(corpus_sql())
def corpus_upsert(t: Tables) -> DataFrame:
    return grown_corpus(t)


@query(f"""WITH {_CORPUS_CTE}, report AS (SELECT count(*) - count(document_type) AS missing_document_type,
        count(*) - count(ticket_uuid) AS missing_ticket_uuid,
        count(*) FILTER (ocr_link IS DISTINCT FROM '{PREFIX}' || ocr_job_id || '.json') AS link_ocr_link FROM corpus)
    SELECT 'missing_document_type' AS check_name, missing_document_type AS n_rows FROM report
    UNION ALL SELECT 'missing_ticket_uuid', missing_ticket_uuid FROM report
    UNION ALL SELECT 'link_ocr_link', link_ocr_link FROM report
    UNION ALL SELECT 'repeated_ticket_uuid', CAST(coalesce(sum(n), 0) AS bigint) FROM
        (SELECT count(*) AS n FROM corpus GROUP BY ticket_uuid HAVING count(*) > 1)""")
def quality_report(t: Tables) -> DataFrame:
    link = ids.result_link(F.col("ocr_job_id"), PREFIX)
    return quality.quality_report(
        grown_corpus(t), ["document_type", "ticket_uuid"], ["ticket_uuid"], "ocr_link", link
    )


@query("""SELECT count(*) - count(text) AS text, count(*) - count(quality) AS quality, count(*) - count(toxic) AS toxic
    FROM documents LEFT JOIN labels USING (doc_id)""")
def required_counts(t: Tables) -> DataFrame:
    joined = t("documents").join(t("labels"), "doc_id", "left")
    return quality.missing_counts(joined, ["text", "quality", "toxic"])


@query("SELECT sha256(text) AS ocr_job_id, count(*) AS n_rows FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_keys(t: Tables) -> DataFrame:
    rows = t("documents").select(ids.text_hash(F.col("text")).alias("ocr_job_id"))
    return quality.duplicate_keys(rows, ["ocr_job_id"])


# Label definitions in use, and the rows of a load: some types known, some new, some missing.
_DEFS = """SELECT min(doc_id) AS id, lang || '/' || source AS type, 'none' AS subtype,
        CASE WHEN toxic = 1 THEN 'other' ELSE 'review' END AS nature
    FROM labels JOIN documents USING (doc_id) GROUP BY 2, 3, 4"""
_LOAD_CTE = f"""defs AS ({_DEFS}), load_rows AS (
        SELECT doc_id, nullif(lang, 'es') || '/' || source AS document_type,
            {_uuid_sql('text', 'ticket_uuid')} AS ticket_uuid, {_uuid_sql('text', 'attachment_id')} AS attachment_id,
            sha256(text) AS ocr_job_id, '{PREFIX}' || sha256(text) || '.json' AS ocr_link
        FROM documents WHERE (nullif(lang, 'es') || '/' || source) IS DISTINCT FROM 'en/src5'
    ), labelled AS (
        SELECT {_uuid_sql('text', 'ticket_uuid')} AS ticket_uuid FROM documents JOIN labels USING (doc_id) WHERE toxic = 1
    ), known AS (SELECT type AS document_type, min(id) AS label_id FROM defs
        WHERE subtype = 'none' AND nature = 'review' GROUP BY type
    ), missing AS (SELECT DISTINCT document_type FROM load_rows
        WHERE document_type IS NOT NULL AND document_type NOT IN (SELECT document_type FROM known)
    ), numbered AS (SELECT document_type, (SELECT max(id) FROM defs)
            + row_number() OVER (ORDER BY md5(document_type || ':42'), document_type) AS label_id FROM missing
    ), label_ids AS (SELECT * FROM numbered UNION ALL SELECT document_type, label_id FROM known
        WHERE document_type IN (SELECT document_type FROM load_rows)
    ), new_rows AS (SELECT * FROM load_rows WHERE ticket_uuid NOT IN (SELECT ticket_uuid FROM labelled))"""
_STAMPS = f"TIMESTAMP '{AS_OF}' AS created_at, TIMESTAMP '{AS_OF}' AS updated_at"


def _load(t: Tables, dry_run: bool = False) -> dict[str, DataFrame]:
    docs = t("documents").select("doc_id", "text", "lang", "source")
    joined = t("labels").join(docs, "doc_id")
    defs = joined.groupBy(
        F.concat_ws("/", "lang", "source").alias("type"), F.lit("none").alias("subtype"),
        F.when(F.col("toxic") == 1, "other").otherwise("review").alias("nature"),
    ).agg(F.min("doc_id").alias("id"))
    kind = F.concat(F.nullif("lang", F.lit("es")), F.lit("/"), F.col("source"))
    # ids are computed once and stored without the texts, which a load does not need
    rows = materialize(op.fill_ids(docs.select("text", kind.alias("document_type")), PREFIX).drop("text"), "load")
    labelled = joined.filter("toxic = 1").select(ids.name_uuid(F.col("text"), "ticket_uuid").alias("ticket_uuid"))
    return op.plan_load(rows, defs, labelled, "review", "en/src5", AS_OF, dry_run)


@query(f"""WITH {_LOAD_CTE} SELECT label_id AS id, document_type AS type, 'none' AS subtype, 'review' AS nature,
    {_STAMPS}, NULL::varchar AS datatype FROM numbered""")
def label_defs(t: Tables) -> DataFrame:
    return _load(t)["label_defs"]


@query(f"WITH {_LOAD_CTE} SELECT * FROM label_ids")
def label_ids(t: Tables) -> DataFrame:
    return _load(t)["label_ids"]


@query(f"""WITH {_LOAD_CTE} SELECT document_type, NULL::bigint AS label_id FROM numbered UNION ALL
    SELECT document_type, label_id FROM known WHERE document_type IN (SELECT document_type FROM load_rows)""")
def label_ids_dry_run(t: Tables) -> DataFrame:
    return _load(t, dry_run=True)["label_ids"]


_ASSIGN = """SELECT ticket_uuid, NULL::varchar AS source_id, NULL::varchar AS comment_id, attachment_id, label_id,
    'True' AS value, {stamps} FROM new_rows JOIN {ids} USING (document_type)"""


@query(f"WITH {_LOAD_CTE} {_ASSIGN.format(stamps=_STAMPS, ids='label_ids')}")
def label_assign(t: Tables) -> DataFrame:
    return _load(t)["ticket_labels"]


@query(f"WITH {_LOAD_CTE} {_ASSIGN.format(stamps=_STAMPS, ids='known')}")
def label_assign_dry_run(t: Tables) -> DataFrame:
    return _load(t, dry_run=True)["ticket_labels"]


@query(f"""WITH {_LOAD_CTE} SELECT attachment_id, ocr_job_id AS job_id, 'SUCCEEDED' AS status, ocr_link, {_STAMPS}
    FROM new_rows""")
def job_register(t: Tables) -> DataFrame:
    return _load(t)["ocr_jobs"]
