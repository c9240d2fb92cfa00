import datetime
import time

import pytest
from pyspark.sql import functions as F

from paperlane.functions import extract, keys, parse, predicates, text


@pytest.mark.parametrize(("answer", "first", "last"), [
    ("text {'is_a': True, 'is_b': False} {\"is_a\": false}", (True, False), (False, None)),
    ("no object", (None, None), (None, None)),
    ('{bad}{"is_a":null}', (None, None), (None, None)),
    ('{"a":{"is_a":true}}', (None, None), (None, None)),
    ('{"is_a": tr\nue}', (True, None), (True, None)),
    ('{"is_a": "true"}', (None, None), (None, None)),
    ('{"is_a":true,}', (None, None), (None, None)),
])
def test_answers(one, answer, first, last):
    for is_last, expected in ((False, first), (True, last)):
        found = tuple(
            one(lambda c: parse.answer_flag(parse.answer_object(c, is_last), key), answer)
            for key in ("is_a", "is_b")
        )
        assert found == expected


@pytest.mark.parametrize(("answer", "expected"), [
    ("nothing", False), ('{"is_a": null}', None), ('{"is_b": true}', False), ('{"is_a": true}', True),
])
def test_missing_flag_has_a_default_but_null_stays(one, answer, expected):
    assert one(lambda c: parse.answer_flag(parse.answer_object(c), "is_a", False), answer) is expected


@pytest.mark.parametrize(("value", "number"), [
    ("'0.97'", 0.97), ("0.5", 0.5), ("n/a", None), ("'nan'", None), (None, None), ("'1'", 1.0),
])
def test_quoted_numbers(one, value, number):
    assert one(parse.quoted_double, value) == number


def test_quoted_booleans(one):
    assert one(parse.quoted_true, "'True'") is True
    assert one(parse.quoted_true, "True") is False
    assert one(parse.mentions_true, "xTruex") is True


@pytest.mark.parametrize(("literal", "expected"), [
    ("{'a': 'x', 'b': None}", {"a": "x", "b": None}),
    ("{'a': \"D'A None, x\", 'b': None, 'c': None}", {"a": "D'A None, x", "b": None, "c": None}),
    ("not a dict", None),
])
def test_dict_literals(one, literal, expected):
    assert one(parse.dict_literal, literal) == expected


def test_blocks_to_text(spark):
    def block(kind, words):
        return (kind, words, "x", 1.0)

    rows = [
        (1, [block("PAGE", None), block("LINE", "a"), block("WORD", "a"), block("LINE", "b")]),
        (2, []), (3, None),
    ]
    frame = spark.createDataFrame(rows, f"id int, blocks {parse.BLOCK_TYPE}")
    found = {r.id: r.t for r in frame.select("id", parse.blocks_to_text(F.col("blocks")).alias("t")).collect()}
    assert found == {1: "a\nb", 2: "", 3: ""}


def test_text_to_blocks_numbers_all_lines_and_drops_blank_ones(one):
    blocks = one(parse.text_to_blocks, "a\n \xa0\nb")
    assert [(b.Text, b.Id, b.Confidence) for b in blocks] == [("a", "line_0", 99.0), ("b", "line_2", 99.0)]


def test_prompt_inserts_text_as_it_is(one):
    made = one(lambda c: parse.render_prompt("<${clean_text}|$clean_text|$other>", {"clean_text": c}), "$clean_text")
    assert made == "<$clean_text|$clean_text|$other>"


@pytest.mark.parametrize(("raw", "clean"), [
    (None, ""), ("<p>A  b</p>", "a b"), ("abc\nxy\ndef", "abc\ndef"),
    ("  Ab\xa0 c \r\n\n x \nEnd", "ab c\nend"), ("ab\ncd", ""), ("a<br\n/>bc", "abc"),
])
def test_cleaning(one, raw, clean):
    assert one(text.clean_text, raw) == clean


def test_cleaning_switches(one):
    assert one(lambda c: text.clean_text(c, lowercase=False, remove_short_lines=False), "A\n<b>B</b>") == "A\nB"


@pytest.mark.parametrize(("raw", "tagged"), [
    ("see https://x.example/a?b=1 now", "see <URL> now"), ("to a.b@c.example.org!", "to <EMAIL>!"),
    ("art. 5 abs. 2", "<LEGAL_ARTICLE>"), ("dr ii 123/24", "<DR_REFERENCE>"), ("12,50 eur", "<CUR>"),
    ("+49 30 1234567", "<PHONE>"), ("in 1.234,5 ways", "in <NUMBER> ways"),
])
def test_tags(one, raw, tagged):
    assert one(text.replace_with_tags, raw) == tagged


def test_tokens(one):
    words = "The <URL> cat, 12 x1 m " + "y" * 45 + " ÄPFEL"
    assert one(lambda c: text.tokens(c, ["the", "m"]), words) == ["cat", "x1", "m", "äpfel"]


def test_stop_words(spark):
    assert "und" in text.default_stop_words("german")


@pytest.mark.parametrize(("raw", "expected"), [
    ("Az 112345678901 x", "112345678901"), ("Az 11234567890 x", "11234567890"),
    ("11234567890123", None), ("212345678901", None), ("a 1123456789012", "1123456789012"),
])
def test_case_ids(one, raw, expected):
    assert one(extract.case_id, raw) == expected


@pytest.mark.parametrize(("raw", "valid"), [
    ("01.02.2024", True), ("31.02.2024", False), ("05.06.1999", False), ("3. Mai 2024", True),
    ("24. MÄRZ 2021", True), ("2024-05-17", True), ("2024-13-01", False),
])
def test_dates(one, raw, valid):
    found = one(extract.date_matches, f"am {raw} um")
    assert (found is not None) == valid
    if valid:
        assert [(m.text, m.start, m.end) for m in found] == [(raw, 3, 3 + len(raw))]


def test_parsed_day(one):
    assert one(extract.parse_day, "24. März 2021") == datetime.date(2021, 3, 24)


def test_date_context_is_clipped_and_distinct(one):
    words = "1.2.2024 und " + "x" * 100 + " 1.2.2024"
    contexts = one(lambda c: extract.date_contexts(c, extract.date_matches(c)), words)
    assert contexts == [words[:48]]


def test_marked_spans(one):
    marked = one(lambda c: text.mark_spans(c, extract.date_matches(c)), "a 1.2.2024, 3.4.2024")
    assert marked == "a [[1.2.2024]], [[3.4.2024]]"
    assert one(lambda c: text.mark_spans(c, extract.date_matches(c)), "none") == "none"


@pytest.mark.parametrize(("raw", "name"), [
    ("gegen\nMustermann, Max\nMusterweg 1", "Max Mustermann"),
    ("x ./. herr c/o max-peter müller 12\nWeg", "Max-peter Müller"),
    ("GEGEN\nFrau Eva Muster!\nOrt", "Eva Muster"), ("gegen\n\nEva Muster", None),
    ("gegen Max Muster", None), ("nothing here", None), ("gegen", None),
])
def test_names(one, raw, name):
    found = one(lambda c: extract.clean_name(extract.pick_name(extract.name_context(c))), raw)
    assert found == name


def test_name_context_has_at_most_fifteen_words(one):
    words = " ".join(f"w{i}" for i in range(40))
    assert len(one(extract.name_context, f"gegen {words}").split()) == 15


def test_salutation_and_punctuation(one):
    assert one(extract.has_salutation, "an HERRN X") is True
    assert one(extract.has_salutation, "herrlich") is False
    assert one(extract.main_punctuation, "a, b; c, d") == ","
    assert one(extract.main_punctuation, "a; b, c") == ";"
    assert one(extract.main_punctuation, "abc") is None


@pytest.mark.parametrize(("key", "time"), [
    ("b/2024_01_31/2359/export_data.json", datetime.datetime(2024, 1, 31, 23, 59)),
    ("x/y/z", None), ("b/2024_02_31/0000/f", None), ("b/2024_01_31/2460/f", None), (None, None),
])
def test_export_keys(one, key, time):
    assert one(keys.export_key_time, key) == time


def test_export_key_goes_both_ways(one):
    assert one(lambda c: keys.export_key(keys.export_key_time(c), "b"), "b/2024_01_31/2359/export_data.json") == \
        "b/2024_01_31/2359/export_data.json"


def test_addresses(one):
    assert one(keys.uri_bucket, "s3://bucket/a/b.pdf") == "bucket"
    assert one(keys.uri_key, "s3://bucket/a/b.pdf") == "a/b.pdf"
    assert one(keys.uri_key, "bucket/a") is None
    assert one(keys.file_name, "a/b/c.pdf") == "c.pdf"
    assert one(keys.file_name, None) is None
    assert [one(keys.file_route, n) for n in ("a.GIF", "a.html", "a.pdf")] == ["irrelevant", "unsupported", "process"]


def test_null_rules(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,), ("",)], "x string")
    x = F.col("x")
    assert rows.filter(predicates.differs(x, "a")).count() == 3
    assert rows.filter(predicates.is_blank(x)).count() == 1
    assert rows.filter(predicates.is_present(x)).count() == 2


def test_lookback_bounds(spark):
    stamps = ["2024-01-01 00:00:00", "2024-01-07 23:59:59.999999", "2024-01-08 00:00:00", "2023-12-31 23:59:59"]
    rows = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
    assert rows.filter(predicates.lookback(F.col("t"), "2024-01-08", 7)).count() == 2
    assert rows.filter(predicates.lookback(F.col("t"), "2024-01-08", 7, True)).count() == 3


@pytest.mark.parametrize("junk", ["a", "<", "1", "1.", "§", "a@", "dr ", "gegen ", "1.1.2024 ", ".", "€", "<a"])
def test_text_functions_take_linear_time(spark, junk):
    long = junk * (1_000_000 // len(junk) if len(junk) < 6 else 5_000)
    frame = spark.createDataFrame([(long,)], "t string")
    spans = extract.date_matches(F.col("t"))
    start = time.perf_counter()
    frame.select(
        F.length(text.replace_with_tags(text.clean_text(F.col("t")))),
        F.length(text.mark_spans(F.col("t"), spans)), F.size(extract.date_contexts(F.col("t"), spans)),
        extract.main_punctuation(F.substring("t", 1, 20_000)), F.length(extract.name_context(F.col("t"))),
    ).collect()
    assert time.perf_counter() - start < 30


@pytest.mark.parametrize("pattern", text.LINEAR_PATTERNS)
def test_linear_patterns_match_the_same(spark, pattern):
    import random

    plain, rng = dict(text.TAG_PATTERNS)[pattern], random.Random(pattern)
    signs = "ab@.12,-5 €$eur§% art.5x"
    rows = [("".join(rng.choice(signs) for _ in range(rng.randint(0, 30))),) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "t string")
    different = F.regexp_replace("t", plain, "#") != F.regexp_replace("t", text.LINEAR_PATTERNS[pattern], "#")
    assert frame.filter(different).count() == 0


def test_tags_are_cut_as_by_a_pattern(spark):
    import random

    rng = random.Random(1)
    rows = [("".join(rng.choice("<>ab\n") for _ in range(rng.randint(0, 14))),) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "t string")
    assert frame.filter(F.regexp_replace("t", "<[^>]*>", "") != text.without_tags(F.col("t"))).count() == 0


@pytest.mark.parametrize("value, number", [
    ("'0.95'", 0.95), ("'0.95d'", None), ("'1f'", None), ("'1e0'", 1.0), ("' .5 '", 0.5), ("'-3.'", -3.0), ("'nan'", None), ("''", None), ("'1 2'", None), (None, None),
])
def test_quoted_numbers(one, value, number):
    assert one(parse.quoted_double, value) == number


@pytest.mark.parametrize("context, picked, name", [
    ("Muster, Max, jun.\nWeg 1", "Max Muster", "Max Muster"), (" \nFrau Dr. Eva Muster-Frau!\nOrt", "Frau Dr. Eva Muster-Frau!", "Dr Eva Muster-frau"),
    ("Herr c/o max-peter MÜLLER 12\nx", "Herr c/o max-peter MÜLLER 12", "Max-peter Müller"), ("one line", None, None), ("x\ny\nName", None, None), ("12\n", "12", None),
])
def test_names(one, context, picked, name):
    assert one(extract.pick_name, context) == picked
    assert one(lambda c: extract.clean_name(extract.pick_name(c)), context) == name
