"""The tagger of person names against all sequences of tags."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from paperlane.functions.extract import name_context
from paperlane.operators import persons

TEXTS = [
    "Klage gegen\nFrau Dr. Eva Muster\nMusterweg 12\n10115 Berlin", "gegen Herrn\nMax Beispiel\nAm Markt 3", "gegen die Firma\nBeispiel, Anna\nWeg 7 in Bonn",
    "./. Peter Klein\nHauptstr. 9 im zweiten Stock", "nichts gegen das", None, "",
]


NAMES = ("Frau Eva Muster", "Max Beispiel", "Herrn Dr. Paul Anders", "Klein, Anna")
TRAINING = [f"Klage gegen\n{NAMES[i % 4]}\nwohnhaft in der strasse {i} nahe dem bahnhof" for i in range(20)]


def best_spans(shapes, tagger):
    """Spans of the first name on each best sequence."""
    scored = []
    for tags in itertools.product((0, 1), repeat=len(shapes)):
        score = sum(tagger.shapes[t][s] for t, s in zip(tags, shapes, strict=True))
        score += sum(tagger.steps[a][b] for a, b in zip((0, *tags), tags))
        first = tags.index(1) if 1 in tags else -1
        end = next((i for i in range(first, len(tags)) if not tags[i]), len(tags)) if first >= 0 else -1
        scored.append((score, (first, end)))
    top = max(s for s, _ in scored)
    return {span for score, span in scored if score == top}


def test_the_best_of_all_sequences_is_found(spark):
    pick = random.Random(6)
    for _ in range(6):
        tagger = persons.Tagger(
            tuple(tuple(pick.randint(-4000, -50) for _ in range(persons.SHAPES)) for _ in range(2)),
            tuple(tuple(pick.randint(-3000, -50) for _ in range(2)) for _ in range(2)),
        )
        rows = [([pick.randrange(persons.SHAPES) for _ in range(n)],) for n in (0, 1, 2, 5, 9, 10) for _ in range(6)]
        df = spark.createDataFrame(rows, "s array<int>").withColumn("span", persons.first_name_span(F.col("s"), tagger))
        for r in df.collect():
            assert (r["span"]["first"], r["span"]["end"]) in best_spans(r["s"], tagger)


def test_names_without_a_cue(spark):
    texts = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    tagger = persons.learn_tagger(spark.createDataFrame([(t,) for t in TRAINING], "text string"), "text")
    # capital words are part of names, numbers and line breaks are not
    other, name = tagger.shapes
    assert name[persons.CAPITAL] > other[persons.CAPITAL] and name[persons.BREAK] < other[persons.BREAK] and name[persons.NUMBER] < other[persons.NUMBER]
    found = persons.person_names(texts.unionByName(spark.createDataFrame([("im auftrag von Frau Eva Anders\nund 12 weiteren",)], "text string")), "text", tagger)
    rows = {r["text"]: (r["cue_name"], r["tagged_name"]) for r in found.collect()}
    assert rows[TEXTS[0]] == ("Dr Eva Muster", None) and rows[TEXTS[2]][0] is not None
    assert rows[None] == (None, None) and rows[""] == (None, None)
    assert rows["im auftrag von Frau Eva Anders\nund 12 weiteren"] == (None, "Eva Anders")


def test_marks_follow_the_line_of_the_name(spark):
    texts = spark.createDataFrame([(t,) for t in TEXTS[:5]], "text string")
    marked = [[(t["shape"], t["name"]) for t in r["tags"]] for r in persons.marked_contexts(texts, "text").collect()]
    assert marked[1] == [
        (persons.SALUTED, True), (persons.BREAK, False), (persons.CAPITAL, False), (persons.CAPITAL, False), (persons.BREAK, False),
        (persons.CAPITAL, False), (persons.CAPITAL, False), (persons.NUMBER, False),
    ]


@pytest.mark.parametrize("token,shape", [
    ("\n", persons.BREAK), ("Frau", persons.SALUTED), ("HERRN,", persons.SALUTED), ("Muster,", persons.WITH_COMMA), ("Muster-Frau", persons.CAPITAL),
    ("Dr.", persons.SHORT), ("3a", persons.NUMBER), ("ärger", persons.LOWER), ("(x", persons.ANYTHING),
])
def test_shapes(spark, token, shape):
    assert spark.createDataFrame([(token,)], "t string").select(persons.shape(F.col("t")).alias("s")).first()["s"] == shape


def test_nothing_to_learn_from(spark):
    tagger = persons.learn_tagger(spark.createDataFrame([(None,), ("",)], "text string"), "text")
    assert len(set(tagger.shapes[0] + tagger.shapes[1])) == 1


def test_long_texts_take_linear_time(spark):
    tagger = persons.learn_tagger(spark.createDataFrame([(t,) for t in TEXTS], "text string"), "text")
    df = spark.createDataFrame([("wort " * 200_000 + "Eva Muster",)], "text string")
    assert persons.person_names(df, "text", tagger).drop("text").first()["cue_name"] is None


def test_each_text_is_searched_once(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for table in (persons.tagger_scores(df, "text"), persons.marked_contexts(df, "text")):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        # each search for a cue names the pattern
        assert plan.count("gegen") == 1


@pytest.mark.parametrize("text,context", [
    ("gegen", None), ("gegen a", "a"), ("xgegen a", None), ("x GEGEN b\nc", "b\nc"), ("gegen gegen x", "gegen x"), (".gegen a ./. q", "q"),
    ("\u00a0gegen\u2003a", "a"), ("", None), (None, None), ("\U0001f600gegen a ./. b", "b"),
])
def test_cues_follow_a_blank(one, text, context):
    assert one(name_context, text) == context
