import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from paperlane.functions import ids
from paperlane.operators import corpus, quality
from paperlane.operators.quality import QualityError

NIL = uuid.UUID(int=0)
PREFIX = "store://results/"
REQUIRED = ("text", "document_type", "is_a", "is_b")
SCHEMA = "text string, document_type string, is_a boolean, is_b boolean"


def new_id(text, purpose):
    return str(uuid.uuid5(NIL, f"{purpose}:{text}"))


@pytest.fixture
def new(spark):
    rows = [("Hello world", "alpha", False, True), ("Foo bar baz", "beta", True, False)]
    return spark.createDataFrame(rows, SCHEMA)


def existing(spark, texts):
    rows = [(text, "alpha", False, True) for text in texts]
    return corpus.fill_ids(spark.createDataFrame(rows, SCHEMA), PREFIX)


@pytest.mark.parametrize("text", ["", "a", "Ünïcode ß €", "line\nbreak", "🙂", "x" * 5000])
def test_ids_equal_the_standard_library(one, text):
    assert one(lambda c: ids.name_uuid(c, "ticket_uuid"), text) == new_id(text, "ticket_uuid")
    assert one(ids.text_hash, text) == hashlib.sha256(text.encode()).hexdigest()


def test_id_of_a_missing_text_is_missing(one):
    assert one(lambda c: ids.name_uuid(c, "ticket_uuid"), None) is None


@pytest.mark.parametrize("column", REQUIRED)
def test_missing_value_in_a_required_column_fails(new, column):
    holed = new.withColumn(
        column, F.when(F.col("text") == "Hello world", None).otherwise(F.col(column))
    )
    with pytest.raises(QualityError, match="empty entry"):
        quality.check_required(holed, REQUIRED)


def test_complete_rows_pass(new):
    quality.check_required(new, REQUIRED)


def test_generated_columns_have_no_gaps(new):
    filled = corpus.fill_ids(new, PREFIX)
    counts = quality.missing_counts(filled, corpus.GENERATED).first()
    assert list(counts) == [0, 0, 0, 0]
    assert {len(r.ocr_job_id) for r in filled.collect()} == {64}
    assert all(r.ocr_link == f"{PREFIX}{r.ocr_job_id}.json" for r in filled.collect())


def test_existing_ids_and_links_stay(new):
    known = F.when(F.col("text") == "Hello world", "mine")
    filled = corpus.fill_ids(new.withColumn("ticket_uuid", known).withColumn("ocr_link", known), PREFIX)
    rows = {r.text: r for r in filled.collect()}
    assert rows["Hello world"].ticket_uuid == "mine"
    assert rows["Hello world"].ocr_link == "mine"
    assert rows["Foo bar baz"].ticket_uuid == new_id("Foo bar baz", "ticket_uuid")
    assert rows["Foo bar baz"].ocr_link.endswith(f"{rows['Foo bar baz'].ocr_job_id}.json")


def test_renewed_uuid(spark):
    rows = [(None,), ("x" * 36,), ("keep",)]
    out = spark.createDataFrame(rows, "old string").select(
        ids.renew_uuid(F.col("old"), F.lit("new")).alias("id")
    )
    assert sorted(r.id for r in out.collect()) == ["keep", "new", "new"]


def test_upsert_adds_new_rows(spark, new):
    grown = corpus.upsert_corpus(existing(spark, ["existing text 0"]), new, REQUIRED, PREFIX)
    assert grown.count() == 3


def test_upsert_drops_known_texts(spark, new):
    grown = corpus.upsert_corpus(existing(spark, ["Hello world"]), new, REQUIRED, PREFIX)
    assert sorted(r.text for r in grown.collect()) == ["Foo bar baz", "Hello world"]


def test_upsert_keeps_copies_inside_the_new_rows_unless_told(spark, new):
    old = existing(spark, ["existing text 0"])
    doubled = new.unionAll(new)
    assert corpus.upsert_corpus(old, doubled, REQUIRED, PREFIX).count() == 5
    assert corpus.upsert_corpus(old, doubled, REQUIRED, PREFIX, dedupe_new=["text"]).count() == 3


def test_upsert_fails_on_a_missing_text(spark, new):
    with pytest.raises(QualityError):
        corpus.upsert_corpus(
            existing(spark, ["a"]), new.withColumn("text", F.lit(None).cast("string")), REQUIRED, PREFIX
        )


def test_type_check_names_both_types(spark, new):
    wrong = new.withColumn("is_a", F.col("is_a").cast("int"))
    with pytest.raises(QualityError, match="is_a.*boolean.*int"):
        corpus.upsert_corpus(existing(spark, ["a"]), wrong, REQUIRED, PREFIX)


def test_link_check(spark, new):
    filled = corpus.fill_ids(new, PREFIX)
    link = ids.result_link(F.col("ocr_job_id"), PREFIX)
    quality.check_links(filled, "ocr_link", link)
    with pytest.raises(QualityError):
        quality.check_links(filled.withColumn("ocr_link", F.lit("x")), "ocr_link", link)


@pytest.fixture
def definitions(spark):
    rows = [
        (7, "alpha", "none", "review"), (5, "alpha", "none", "review"),
        (9, "beta", "none", "other"), (3, "gamma", "sub", "review"),
    ]
    return spark.createDataFrame(rows, "id long, type string, subtype string, nature string")


def typed(spark, types):
    rows = [(f"text {i}", t, True, False) for i, t in enumerate(types)]
    return corpus.fill_ids(spark.createDataFrame(rows, SCHEMA), PREFIX)


def test_labels_are_found_or_numbered(spark, definitions):
    rows = typed(spark, ["alpha", "beta", "gamma", "beta", None])
    found, new_defs = corpus.ensure_labels(definitions, rows, "review", "2024-03-01")
    by_type = {r.document_type: r.label_id for r in found.collect()}
    assert by_type["alpha"] == 5
    # a type under another nature or subtype does not count as defined
    assert sorted([by_type["beta"], by_type["gamma"]]) == [10, 11]
    assert len(by_type) == 3
    assert sorted(r.type for r in new_defs.collect()) == ["beta", "gamma"]


def test_dry_run_gives_no_ids_and_skips_rows(spark, definitions):
    rows = typed(spark, ["alpha", "beta"])
    nothing = spark.createDataFrame([], "ticket_uuid string")
    plan = corpus.plan_load(rows, definitions, nothing, "review", "mail", "2024-03-01", dry_run=True)
    assert [r.label_id for r in plan["ticket_labels"].collect()] == [5]
    assert plan["ocr_jobs"].count() == 2


def test_load_skips_known_tickets_and_keeps_missing_types(spark, definitions):
    rows = typed(spark, ["alpha", "mail", None, "beta"])
    known = rows.filter("document_type = 'alpha'").select("ticket_uuid")
    plan = corpus.plan_load(rows, definitions, known, "review", "mail", "2024-03-01")
    assert plan["ocr_jobs"].count() == 2  # the missing type and beta
    assert [r.value for r in plan["ticket_labels"].collect()] == ["True"]
