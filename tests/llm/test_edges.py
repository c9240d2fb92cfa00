"""Very long items, addresses and ties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperlane.llm import decontamination, langid, urls


def test_a_very_long_benchmark_item(spark):
    words = [f"w{i * 7919 % 20011}" for i in range(20_000)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "short one"), (None, " ".join(words[100:115]))], "item_id int, text string")
    texts = [" ".join(["x", *words[5000:5012], "y"]), " ".join(words), " ".join(words[40:49]), "a short one b", " ".join(words[19_990:]), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontamination.contamination(docs, items).collect()}
    assert found == {
        0: (14, 12, ["1"]), 1: (20_000, 20_000, ["1"]), 2: (9, 0, []), 3: (4, 2, ["2"]), 4: (10, 10, ["1"]), 5: (0, 0, []),
    }


def test_an_item_that_hangs_over_both_ends(spark):
    item = [f"t{i}" for i in range(60)]
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item[30:45] * 2))], "item_id int, text string")
    docs = spark.createDataFrame([(1, " ".join(item[25:50])), (2, " ".join(item[:11])), (3, " ".join(item[51:]))], "doc_id int, text string")
    found = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontamination.contamination(docs, items).collect()}
    assert found == {1: (25, ["1", "2"]), 2: (11, ["1"]), 3: (0, [])}


def test_near_matches_of_odd_tables(spark):
    item = " ".join(f"t{i}" for i in range(10))
    rows = [(1, item), (1, item), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    items = spark.createDataFrame([(1, item), (1, item), (None, item), (4, None)], "item_id int, text string")
    found = decontamination.near_matches(docs, items, slop=2)
    # repeated texts and items are one match
    assert [(r["item_id"], r["first"]) for r in found.collect()] == [("1", 0)]
    assert decontamination.near_matches(docs.limit(0), items, slop=2).count() == 0
    assert decontamination.near_matches(docs, items.limit(0), slop=2).count() == 0


def test_a_very_long_address(spark):
    rules = (urls.pattern_rule("^ads^", urls.BLOCK), urls.host_rule("example.com", "/", urls.ALLOW))
    long = "http://other.org/" + "a1-" * 300_000
    rows = [(1, long), (2, long + "/ads/"), (3, "http://www.example.com/" + "x" * 500_000), (4, "http://" + "h" * 100_000)]
    df = spark.createDataFrame(rows, "page_id int, url string")
    found = {r["page_id"]: (r["verdict"], r["rule"]) for r in urls.judge(df, "url", rules).collect()}
    assert found == {1: ("allow", None), 2: ("block", "^ads^"), 3: ("allow", "example.com/"), 4: ("allow", None)}


def test_no_python_decides_about_addresses(spark):
    df = spark.createDataFrame([(1, "http://a.b/ads/")], "page_id int, url string")
    table = urls.rule_table(spark, (urls.pattern_rule('^a"d\\s^', urls.BLOCK), urls.pattern_rule("*", urls.ALLOW)))
    assert [(r["rule"], r["tokens"]) for r in table.orderBy("rule").collect()] == [("*", []), ('^a"d\\s^', ["a", "d", "s"])]
    assert "Python" not in table._jdf.queryExecution().executedPlan().toString()
    judged = urls.judge(df, "url", (urls.pattern_rule("*", urls.BLOCK),))
    assert judged.first()["verdict"] == urls.BLOCK


@pytest.mark.parametrize("names", [("aa", "bb"), ("zz", "yy")])
def test_equal_cosines_go_to_the_first_label(spark, names):
    profile = np.random.default_rng(1).normal(size=langid.DIMENSIONS)
    df = spark.createDataFrame([(1, "some words of a text")], "doc_id int, text string")
    found = langid.identify(df, "text", {n: profile for n in names}).first()
    assert found["lang_pred"] == min(names)


def test_labels_and_cosines_equal_a_plain_version(spark):
    rows = [("the cat and the dog", "en"), ("der hund und die katze", "de"), ("the house", "en"), ("das haus ist rot", "de"), ("x", None), ("", "en"), (None, "de")]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(2)

    def vector(text):
        letters = [" ", *text.lower(), " "]
        letters = [c for i, c in enumerate(letters) if c != " " or i == 0 or letters[i - 1] != " "]
        numbers = langid.Letters(langid.DIMENSIONS)
        total = np.zeros(langid.DIMENSIONS)
        for i in range(len(letters) - langid.ORDER + 1):
            gram = np.ones(langid.DIMENSIONS)
            for place, c in enumerate(letters[i : i + langid.ORDER]):
                own = numbers._random(32 if c == " " else ord(c)).astype(float)
                gram *= np.roll(own, langid.ORDER - 1 - place)
            total += gram
        return total / max(1.0, np.linalg.norm(total))

    profiles = {"en": vector(rows[0][0]) + vector(rows[2][0]), "de": vector(rows[1][0]) + vector(rows[3][0])}
    known = langid.profiles(df, "text", "lang")
    for r in langid.identify(df.withColumn("id", F.monotonically_increasing_id()), "text", known).collect():
        if not r["text"]:
            assert (r["lang_pred"], r["score"]) == (langid.UNKNOWN, 0.0)
            continue
        cosines = {n: vector(r["text"]) @ p / np.linalg.norm(p) for n, p in profiles.items()}
        best = max(sorted(cosines), key=cosines.get)
        assert r["lang_pred"] == best and abs(r["score"] - max(0.0, cosines[best])) < 1e-5
