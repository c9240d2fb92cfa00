"""Cleaning, tags, tokens, TF-IDF, extraction, keys and OCR blocks on documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlane.functions import extract, keys, parse, text as tx
from paperlane.functions.predicates import differs
from paperlane.operators import lemmas, persons, profile, tfidf, tokens as op
from paperlane.plans.registry import Tables, query, rounded
from paperlane.session import materialize, new_work_path
from paperlane.sources.documents import blocks_json, text_from_json

_B = tx.BLANKS
_Q = "'"
STOP_WORDS = ("the", "and", "der", "die", "und", "la", "de", "el", "m")


def sql_text(value: str) -> str:
    """SQL literal of a text."""
    return "'" + value.replace("'", "''") + "'"


def _clean_sql(column: str) -> str:
    return f"""lower(array_to_string(list_filter(list_transform(
        string_split(regexp_replace(coalesce({column}, ''), '<[^>]*>', '', 'g'), chr(10)),
        lambda line: trim(regexp_replace(line, '[{_B}]+', ' ', 'g'), ' ')),
        lambda line: length(line) >= 3), chr(10)))"""


def _tags_sql(column: str) -> str:
    for tag, pattern in tx.TAG_PATTERNS:
        column = f"regexp_replace({column}, {sql_text(pattern)}, '{tag}', 'g')"
    return column


def _tokens_sql(column: str) -> str:
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS if w != "m")
    return f"""list_filter(regexp_split_to_array(lower({column}), '{tx.TOKEN_GAP}'),
        lambda w: w <> '' AND length(w) < 45 AND NOT regexp_full_match(w, '[0-9]+')
                  AND NOT starts_with(w, '<') AND NOT ends_with(w, '>') AND w NOT IN ({stops}))"""


@query(f"SELECT page_id, {_clean_sql('html')} AS cleaned_text FROM pages")
def clean_text(t: Tables) -> DataFrame:
    return t("pages").select("page_id", tx.clean_text(F.col("html")).alias("cleaned_text"))


@query("""SELECT page_id, coalesce(html, '') AS untouched,
    regexp_replace(coalesce(html, ''), '<[^>]*>', '', 'g') AS no_tags FROM pages""")
def clean_text_switches(t: Tables) -> DataFrame:
    off = dict(normalize_whitespace=False, remove_short_lines=False, lowercase=False)
    return t("pages").select(
        "page_id", tx.clean_text(F.col("html"), strip_html=False, **off).alias("untouched"),
        tx.clean_text(F.col("html"), **off).alias("no_tags"),
    )


# Adds what the tags stand for to every text; valid in both SQL dialects.
TAGGABLE = """concat(text, chr(10), 'Art. 5 Abs. 2, DR II ', doc_id, '/24, ', n_chars, ' EUR, € 12,50, ',
    'mail.', doc_id, '@', lang, '.example.com, https://', source, '.example.com/a?b=', doc_id,
    ', Tel. +49 30 1234567, 00', n_chars, ' 555')"""


def _tagged(t: Tables) -> DataFrame:
    return t("documents").select(
        "doc_id", "lang", tx.replace_with_tags(F.expr(TAGGABLE)).alias("text_w_tags")
    )


@query(f"SELECT doc_id, lang, {_tags_sql(TAGGABLE)} AS text_w_tags FROM documents")
def tag_text(t: Tables) -> DataFrame:
    return _tagged(t)


@query(" UNION ALL ".join(f"""SELECT lang, '{tag}' AS tag, CAST(sum(n) AS bigint) AS n_found,
        round_even(ln(sum(n) + 1), 6) AS log_count
    FROM (SELECT lang, len(string_split({_tags_sql(TAGGABLE)}, '{tag}')) - 1 AS n FROM documents) GROUP BY lang
    """ for tag in tx.TAGS))
def tag_counts(t: Tables) -> DataFrame:
    return rounded(op.tag_counts(_tagged(t), "text_w_tags", "lang"), "log_count")


def tokenized(t: Tables) -> DataFrame:
    return t("documents").select(
        "doc_id", "lang", "text", tx.tokens(F.col("text"), STOP_WORDS).alias("tokenized")
    )


_TOKENS_CTE = f"tok AS (SELECT doc_id, lang, text, {_tokens_sql('text')} AS tokenized FROM documents)"


@query(f"WITH {_TOKENS_CTE} SELECT doc_id, array_to_string(tokenized, ' ') AS tokenized FROM tok")
def tokenize(t: Tables) -> DataFrame:
    return tokenized(t).select("doc_id", F.array_join("tokenized", " ").alias("tokenized"))


@query(f"""WITH {_TOKENS_CTE}
    SELECT token, count(*) AS n_total, round_even(count(*) / (SELECT count(*) FROM documents), 2) AS frequency
    FROM (SELECT unnest(tokenized) AS token FROM tok) GROUP BY token""")
def token_frequency(t: Tables) -> DataFrame:
    return op.token_frequency(tokenized(t), "tokenized")


@query(f"""WITH {_TOKENS_CTE}
    SELECT doc_id, replace(text, 'que', '[[que]]') AS marked FROM tok
    WHERE list_contains(tokenized, 'que') AND lang = 'fr'""")
def token_search(t: Tables) -> DataFrame:
    found = op.rows_with_token(tokenized(t), "tokenized", "que", F.col("lang") == "fr")
    return found.select("doc_id", tx.mark_tokens(F.col("text"), ["que"]).alias("marked"))


@query("""SELECT doc_id, replace(replace(lower(text), 'ein', '[[ein]]'), source, '[[' || source || ']]') AS marked
    FROM documents""")
def mark_tokens(t: Tables) -> DataFrame:
    text = F.lower("text")
    return t("documents").select(
        "doc_id", tx.mark_tokens(text, ["ein", "", F.col("source")]).alias("marked")
    )


@query("SELECT doc_id, replace(text, chr(10), '<LINE_BREAK>') AS visible FROM documents")
def visible_breaks(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", tx.show_line_breaks(F.col("text")).alias("visible"))


VOCABULARY_SQL = f"""{_TOKENS_CTE}, terms AS (
        SELECT term, count(*) AS cf, count(DISTINCT doc_id) AS df
        FROM (SELECT doc_id, unnest(tokenized) AS term FROM tok) GROUP BY term
    ), n AS (SELECT count(*) AS n FROM documents), kept AS (
        SELECT term, cf, df, ln((1.0::double + n) / (1.0::double + df)) + 1.0 AS idf
        FROM terms, n WHERE df >= 2 AND df <= 0.95::double * n ORDER BY cf DESC, term LIMIT 200
    ), vocab AS (SELECT *, row_number() OVER (ORDER BY term) - 1 AS idx FROM kept)"""


@query(f"""WITH {VOCABULARY_SQL}
    SELECT term, CAST(idx AS int) AS idx, cf, df, round_even(idf, 6) AS idf FROM vocab""")
def tfidf_vocabulary(t: Tables) -> DataFrame:
    return rounded(tfidf.vocabulary(tokenized(t), "tokenized"), "idf")


# Three batches, one of which comes twice, with the sums merged in between; the last one is empty.
@query(f"""WITH {VOCABULARY_SQL}
    SELECT term, CAST(idx AS int) AS idx, cf, df, round_even(idf, 6) AS idf FROM vocab""")
def tfidf_vocabulary_growing(t: Tables) -> DataFrame:
    growing = tfidf.GrowingCounts(t.spark, new_work_path(t.spark, "terms"))
    docs = tokenized(t)
    for number, part in enumerate(("lang = 'en'", "lang = 'en'", "lang = 'de'", "lang <> 'en' AND lang <> 'de'", "lang IS NULL")):
        growing.add(docs.filter(part), "tokenized", part)
        if number == 2:
            growing.merge()
    return rounded(growing.vocabulary(), "idf")


@query(f"""WITH {VOCABULARY_SQL}, tf AS (
        SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokenized) AS term FROM tok) GROUP BY 1, 2
    ), raw AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN vocab USING (term))
    SELECT doc_id, term, round_even(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight
    FROM documents LEFT JOIN raw USING (doc_id)""")
def tfidf_weights(t: Tables) -> DataFrame:
    # the tokens are read twice, by the vocabulary and by the weights
    docs = materialize(tokenized(t).select("doc_id", "tokenized"), "tokens")
    return rounded(tfidf.weights(docs, "doc_id", "tokenized", tfidf.vocabulary(docs, "tokenized")), "weight")


LEMMA_SQL = rf"""{_TOKENS_CTE}, w AS (SELECT DISTINCT word FROM (SELECT unnest(tokenized) AS word FROM tok)
        WHERE length(word) >= 3 AND regexp_matches(word, '^\p{{L}}+$')
    ), parted AS (SELECT left(word, length(word) - k) AS stem, right(word, k) AS ending
        FROM (SELECT word, unnest(range(1, least(length(word) - 3, 4) + 1)) AS k FROM w WHERE length(word) > 3)
    ), paying AS (SELECT ending FROM (
            SELECT ending, count(*) AS words, sum(length(stem) - 2) - length(ending) AS gain FROM parted
            WHERE stem IN (SELECT word FROM w) GROUP BY ending) WHERE words > 1 AND gain > 0 ORDER BY gain DESC, ending LIMIT 200
    ), sets AS (SELECT stem, list(ending ORDER BY length(ending), ending) AS endings
        FROM (SELECT stem, ending FROM parted JOIN paying USING (ending) UNION ALL SELECT word, '' FROM w) GROUP BY stem HAVING count(*) > 1
    ), paradigms AS (SELECT endings, count(*) AS stems, (len(endings) - 1) * sum(length(stem))
            + (count(*) - 1) * length(array_to_string(endings, '')) - 2 * count(*) AS gain FROM sets GROUP BY endings HAVING count(*) > 1
    ), ranked AS (SELECT ending, endings[1] AS replacement, gain, row_number() OVER
            (PARTITION BY ending ORDER BY gain DESC, array_to_string(endings, ',') DESC) AS place
        FROM (SELECT unnest(endings) AS ending, endings, gain FROM paradigms WHERE gain > 0)
    ), rules AS (SELECT ending, replacement, CAST(gain AS bigint) AS gain FROM ranked WHERE place = 1 AND ending <> replacement)"""


@query(f"WITH {LEMMA_SQL} SELECT * FROM rules")
def lemma_rules(t: Tables) -> DataFrame:
    return lemmas.learn_rules(materialize(tokenized(t).select("tokenized"), "tokens"), "tokenized")


@query(f"""WITH {LEMMA_SQL}, words AS (SELECT word, count(*) AS n FROM (SELECT unnest(tokenized) AS word FROM tok) GROUP BY word),
    found AS (SELECT word, arg_max(left(word, length(word) - length(ending)) || replacement, length(ending)) AS lemma
        FROM words JOIN rules ON ends_with(word, ending) AND length(word) - length(ending) >= 3 GROUP BY word)
    SELECT coalesce(lemma, word) AS lemma, count(*) AS n_words, CAST(sum(n) AS bigint) AS n_total FROM words LEFT JOIN found USING (word) GROUP BY 1""")
def lemma_counts(t: Tables) -> DataFrame:
    docs = materialize(tokenized(t).select("tokenized"), "tokens")
    endings = lemmas.Endings.from_rules(lemmas.learn_rules(docs, "tokenized"))
    words = docs.select(F.explode("tokenized").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    based = words.groupBy(endings(F.col("word")).alias("lemma"))
    return based.agg(F.count("*").alias("n_words"), F.sum("n").alias("n_total"))


# Adds an id, a date and a name with a cue to every text; valid in both SQL dialects.
ENRICHED = """concat(text, chr(10), 'Az 1', lpad(CAST(doc_id AS string), 11, '0'), ' vom ',
    CASE lang WHEN 'en' THEN '31.02.2024' WHEN 'de' THEN '3. Mai 2024' WHEN 'fr' THEN '2024-05-17'
              ELSE '05.06.1999' END, ' bis 1.12.2023, 1.12.2023 und 24. Dezember 2022 ',
    CASE lang WHEN 'de' THEN concat('gegen', chr(10), 'Mustermann, Max', chr(10), 'Musterweg 1')
              WHEN 'en' THEN concat('./. Herr c/o max-peter müller 12', chr(10), 'Weg 3 (links)')
              WHEN 'fr' THEN 'gegen Frau Anna Beispiel'
              ELSE concat('Gegen', chr(10), chr(10), 'Frau Dr. Eva Muster-Frau!', chr(10), 'Ort, Land') END)"""
_ENRICHED_CTE = f"src AS (SELECT doc_id, {ENRICHED} AS text FROM documents)"


def enriched(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", F.expr(ENRICHED).alias("text"))


@query(f"""WITH {_ENRICHED_CTE}
    SELECT doc_id, nullif(regexp_extract(text, '(?:^|[^\\p{{L}}\\p{{N}}_])(1[0-9]{{10,12}})(?:$|[^\\p{{L}}\\p{{N}}_])', 1), '')
        AS case_id FROM src""")
def case_id(t: Tables) -> DataFrame:
    return enriched(t).select("doc_id", extract.case_id(F.col("text")).alias("case_id"))


_DATE_RE = extract.DATE_PATTERN.replace("(?=[0-9])", "")


def _parse_day_sql(column: str) -> str:
    spelled = f"lower({column})"
    for number, month in enumerate(extract.MONTHS, start=1):
        spelled = f"regexp_replace({spelled}, '\\. ?{month} ', '.{number}.')"
    return f"""CASE WHEN contains({column}, '-') THEN try_strptime({column}, '%Y-%m-%d')
        ELSE try_strptime({spelled}, '%d.%m.%Y') END"""


_DATES_CTE = f"""{_ENRICHED_CTE}, hits AS (
        SELECT doc_id, text, regexp_extract_all(text, '{_DATE_RE}') AS found,
               regexp_split_to_array(text, '{_DATE_RE}') AS gaps FROM src
    ), numbered AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM hits
    ), spans AS (
        SELECT doc_id, text AS whole, found[i] AS hit,
               CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g)))
                    + coalesce(list_sum(list_transform(found[1:i - 1], lambda h: length(h))), 0) AS int) AS start
        FROM numbered
    ), valid AS (
        SELECT *, start + CAST(length(hit) AS int) AS "end" FROM spans WHERE year({_parse_day_sql('hit')}) >= 2000)"""


@query(f"""WITH {_DATES_CTE} SELECT doc_id, hit AS text, start, "end" FROM valid""")
def date_matches(t: Tables) -> DataFrame:
    spans = extract.date_matches(F.col("text"))
    return enriched(t).select("doc_id", F.inline(spans))


@query(f"""WITH {_DATES_CTE} SELECT doc_id, hit, CAST({_parse_day_sql('hit')} AS date) AS day FROM spans""")
def date_parse(t: Tables) -> DataFrame:
    spans = extract.date_matches(F.col("text"), valid_only=False)
    found = enriched(t).select("doc_id", F.explode(spans).alias("span"))
    hit = F.col("span.text")
    return found.select("doc_id", hit.alias("hit"), extract.parse_day(hit).alias("day"))


@query(f"""WITH {_DATES_CTE}, firsts AS (
        SELECT doc_id, whole, hit, min(start) AS start FROM valid GROUP BY doc_id, whole, hit)
    SELECT doc_id, substr(whole, greatest(start - 40, 0) + 1,
           least(start + length(hit) + 40, length(whole)) - greatest(start - 40, 0)) AS context FROM firsts""")
def date_context(t: Tables) -> DataFrame:
    spans = enriched(t).withColumn("spans", extract.date_matches(F.col("text")))
    contexts = extract.date_contexts(F.col("text"), F.col("spans"))
    return spans.select("doc_id", F.explode(contexts).alias("context"))


@query(f"""WITH {_DATES_CTE}, joined AS (
        SELECT doc_id, whole, list(hit ORDER BY start) AS h, list(start ORDER BY start) AS s FROM valid GROUP BY 1, 2)
    SELECT doc_id, list_aggregate(list_transform(h, lambda x, i:
            substr(whole, 1 + CASE WHEN i = 1 THEN 0 ELSE s[i - 1] + length(h[i - 1]) END,
                   s[i] - CASE WHEN i = 1 THEN 0 ELSE s[i - 1] + length(h[i - 1]) END) || '[[' || x || ']]'),
            'string_agg', '')
        || substr(whole, 1 + s[len(s)] + length(h[len(h)])) AS marked FROM joined
    UNION ALL SELECT doc_id, text FROM src WHERE doc_id NOT IN (SELECT doc_id FROM valid)""")
def mark_dates(t: Tables) -> DataFrame:
    spans = enriched(t).withColumn("spans", extract.date_matches(F.col("text")))
    return spans.select("doc_id", tx.mark_spans(F.col("text"), F.col("spans")).alias("marked"))


_ANY = f"[{_B}\n]"
_NO = f"[^{_B}\n]"
_CONTEXT = f"""nullif(regexp_replace(regexp_extract(text,
    '(?i)(?:^|{_ANY})(?:gegen|\\./\\.)((?:{_ANY}+{_NO}+){{1,15}})', 1), '^[{_B}]+', ''), '')"""


@query(f"WITH {_ENRICHED_CTE} SELECT doc_id, {_CONTEXT} AS context FROM src")
def name_context(t: Tables) -> DataFrame:
    return enriched(t).select("doc_id", extract.name_context(F.col("text")).alias("context"))


_SALUTED = ", ".join(f"'{w}'" for w in extract.SALUTATION_WORDS)


@query(f"""WITH {_ENRICHED_CTE}, ctx AS (SELECT doc_id, string_split({_CONTEXT}, chr(10)) AS l FROM src),
    p AS (SELECT doc_id, CASE WHEN len(l) > 1 THEN
        list_filter(list_transform(l[1:2], lambda x: trim(x)), lambda x: length(x) > 1)[1] END AS line FROM ctx),
    q AS (SELECT doc_id, CASE WHEN contains(line, ',')
        THEN trim(split_part(line, ',', 2)) || ' ' || trim(split_part(line, ',', 1)) ELSE line END AS picked FROM p),
    w AS (SELECT doc_id, picked, list_filter(list_transform(list_filter(
        regexp_split_to_array(lower(picked), '{_ANY}+'), lambda x: x <> 'c/o'),
        lambda x: regexp_replace(x, '[^\\p{{L}}-]+', '', 'g')), lambda x: x <> '' AND x NOT IN ({_SALUTED})) AS words FROM q)
    SELECT doc_id, picked, nullif(array_to_string(list_transform(words,
        lambda x: upper(substr(x, 1, 1)) || substr(x, 2)), ' '), '') AS name FROM w""")
def name_extraction(t: Tables) -> DataFrame:
    # one step per column, so that Spark evaluates each of them once
    contexts = enriched(t).select("doc_id", extract.name_context(F.col("text")).alias("context"))
    picked = contexts.select("doc_id", extract.pick_name(F.col("context")).alias("picked"))
    return picked.withColumn("name", extract.clean_name(F.col("picked")))


# Some texts name a person without a cue.
MIXED = f"CASE WHEN lang = 'fr' THEN replace({ENRICHED}, 'gegen Frau', 'an Frau') ELSE {ENRICHED} END"
_SHAPE = f"""CASE WHEN tok = chr(10) THEN 0 WHEN regexp_replace(lower(tok), '[^\\p{{L}}]+', '', 'g') IN ({_SALUTED}) THEN 1
    WHEN regexp_matches(tok, '^\\p{{Lu}}[\\p{{L}}-]+,$') THEN 2 WHEN regexp_matches(tok, '^\\p{{Lu}}[\\p{{L}}-]+$') THEN 3
    WHEN regexp_matches(tok, '^\\p{{Lu}}\\p{{L}}{{0,3}}\\.$') THEN 4 WHEN regexp_matches(tok, '[0-9]') THEN 5
    WHEN regexp_matches(tok, '^\\p{{Ll}}') THEN 6 ELSE 7 END"""
_PERSON_CTE = f"""src AS (SELECT doc_id, {MIXED} AS text FROM documents),
    ctx AS (SELECT row_number() OVER () AS r, doc_id, text, string_split({_CONTEXT}, chr(10)) AS l FROM src),
    named AS (SELECT r, l, CASE WHEN len(l) < 2 THEN NULL WHEN length(trim(l[1])) > 1 THEN 1 WHEN length(trim(l[2])) > 1 THEN 2 END AS pick FROM ctx),
    lines AS (SELECT r, pick, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM named WHERE pick IS NOT NULL),
    toks AS (SELECT r, i, unnest(t) AS tok, unnest(range(len(t))) AS k, i = pick AS own FROM
        (SELECT r, i, pick, CASE WHEN i > 1 THEN [chr(10)] ELSE [] END || regexp_extract_all(line, '{_NO}+') AS t FROM lines)),
    tags AS (SELECT {_SHAPE} AS shape, CAST(own AND tok <> chr(10) AS int) AS tag,
        coalesce(lag(CAST(own AND tok <> chr(10) AS int)) OVER (PARTITION BY r ORDER BY i, k), 0) AS before FROM toks),
    possible AS (SELECT 'shape' AS kind, g AS given, w AS what FROM range(2) AS a(g), range(8) AS b(w) UNION ALL SELECT 'step', g, w FROM range(2) AS a(g), range(2) AS b(w)),
    counts AS (SELECT 'shape' AS kind, tag AS given, shape AS what, count(*) AS n FROM tags GROUP BY ALL
        UNION ALL SELECT 'step', before, tag, count(*) FROM tags GROUP BY ALL),
    filled AS (SELECT kind, given, what, coalesce(n, 0) + 1 AS n FROM possible LEFT JOIN counts USING (kind, given, what)),
    scores AS (SELECT kind, CAST(given AS int) AS given, CAST(what AS int) AS what,
        CAST(round(ln(CAST(n AS double) / sum(n) OVER (PARTITION BY kind, given)) * 1000) AS bigint) AS score FROM filled)"""


def mixed_texts(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", F.expr(MIXED).alias("text"))


@query(f"WITH {_PERSON_CTE} SELECT * FROM scores")
def person_tagger(t: Tables) -> DataFrame:
    return persons.tagger_scores(mixed_texts(t), "text")


_NONE = "-1000000000000000"
_FROM_NAME = {tag: f"acc.score1 + steps[{3 + tag}] > acc.score0 + steps[{1 + tag}]" for tag in (0, 1)}
_STEP_SQL = f"""{{'shape': x.shape, 'place': acc.place + 1,
    'score0': greatest(acc.score0 + steps[1], acc.score1 + steps[3]) + other[x.shape + 1],
    'first0': CASE WHEN {_FROM_NAME[0]} THEN acc.first1 ELSE acc.first0 END,
    'end0': CASE WHEN {_FROM_NAME[0]} THEN CASE WHEN acc.end1 < 0 THEN acc.place ELSE acc.end1 END ELSE acc.end0 END,
    'score1': greatest(acc.score0 + steps[2], acc.score1 + steps[4]) + name[x.shape + 1],
    'first1': CASE WHEN CASE WHEN {_FROM_NAME[1]} THEN acc.first1 ELSE acc.first0 END < 0 THEN acc.place
        WHEN {_FROM_NAME[1]} THEN acc.first1 ELSE acc.first0 END,
    'end1': CASE WHEN {_FROM_NAME[1]} THEN acc.end1 ELSE acc.end0 END}}"""


def _start_sql(shape: str) -> str:
    parts = {"score0": 0, "first0": -1, "end0": -1, "score1": _NONE, "first1": -1, "end1": -1}
    return f"{{'shape': {shape}, 'place': CAST(0 AS bigint), " + ", ".join(f"'{k}': CAST({v} AS bigint)" for k, v in parts.items()) + "}"


@query(f"""WITH {_PERSON_CTE}, model AS (SELECT
        (SELECT list(score ORDER BY what) FROM scores WHERE kind = 'shape' AND given = 0) AS other,
        (SELECT list(score ORDER BY what) FROM scores WHERE kind = 'shape' AND given = 1) AS name,
        (SELECT list(score ORDER BY given, what) FROM scores WHERE kind = 'step') AS steps),
    plain AS (SELECT r, doc_id, regexp_extract_all(text, '
|{_NO}+') AS t FROM ctx WHERE l IS NULL),
    walk AS (SELECT r, doc_id, t, list_reduce(list_concat([{_start_sql('0')}], list_transform(list_transform(t, lambda tok: {_SHAPE}), lambda s: {_start_sql('s')})),
        lambda acc, x: {_STEP_SQL}) AS z FROM plain, model),
    span AS (SELECT r, doc_id, t, CASE WHEN z.score1 > z.score0 THEN z.first1 ELSE z.first0 END AS a,
        CASE WHEN z.score1 > z.score0 THEN CASE WHEN z.end1 < 0 THEN z.place ELSE z.end1 END ELSE z.end0 END AS e FROM walk),
    line AS (SELECT r, 'cue' AS found_by, CASE WHEN contains(line, ',') THEN trim(split_part(line, ',', 2)) || ' ' || trim(split_part(line, ',', 1)) ELSE line END AS picked
        FROM (SELECT r, trim(l[pick]) AS line FROM named WHERE pick IS NOT NULL)
        UNION ALL SELECT r, 'tagger', array_to_string(t[a + 1 : e], ' ') FROM span WHERE a >= 0),
    w AS (SELECT r, found_by, list_filter(list_transform(list_filter(regexp_split_to_array(lower(picked), '{_ANY}+'), lambda x: x <> 'c/o'),
        lambda x: regexp_replace(x, '[^\\p{{L}}-]+', '', 'g')), lambda x: x <> '' AND x NOT IN ({_SALUTED})) AS words FROM line),
    clean AS (SELECT r, found_by, nullif(array_to_string(list_transform(words, lambda x: upper(substr(x, 1, 1)) || substr(x, 2)), ' '), '') AS name FROM w)
    SELECT doc_id, c.name AS cue_name, g.name AS tagged_name FROM ctx LEFT JOIN clean AS c ON c.r = ctx.r AND c.found_by = 'cue'
        LEFT JOIN clean AS g ON g.r = ctx.r AND g.found_by = 'tagger'""")
def person_names(t: Tables) -> DataFrame:
    texts = mixed_texts(t)
    return persons.person_names(texts, "text", persons.learn_tagger(texts, "text")).drop("text")


@query(f"""WITH {_ENRICHED_CTE}
    SELECT doc_id, regexp_matches(text, '(?i)\\b(herrn?|frau|fräulein)\\b') AS has_salutation FROM src""")
def salutation(t: Tables) -> DataFrame:
    return enriched(t).select("doc_id", extract.has_salutation(F.col("text")).alias("has_salutation"))


@query(f"""WITH {_ENRICHED_CTE}, ctx AS (SELECT doc_id, regexp_extract_all({_CONTEXT}, '\\p{{P}}') AS signs FROM src),
    c AS (SELECT doc_id, sign, count(*) AS n, min(i) AS pos FROM (
        SELECT doc_id, unnest(signs) AS sign, unnest(range(1, len(signs) + 1)) AS i FROM ctx) GROUP BY 1, 2)
    SELECT x.doc_id, s.sign FROM ctx x LEFT JOIN
        (SELECT doc_id, arg_min(sign, (-n, pos)) AS sign FROM c GROUP BY doc_id) s USING (doc_id)""")
def delimiter(t: Tables) -> DataFrame:
    contexts = enriched(t).select("doc_id", extract.name_context(F.col("text")).alias("context"))
    return contexts.select("doc_id", extract.main_punctuation(F.col("context")).alias("sign"))


@query("""SELECT c_custkey, split_part(n, ' ', 1) AS first_name,
        CASE WHEN contains(n, ' ') THEN substr(n, strpos(n, ' ') + 1) END AS rest,
        replace(replace('2024-' || c_nationkey || '/x', '/', '.'), '-', '.') AS day
    FROM (SELECT *, replace(replace(c_name, '#', ' '), '00', ' ') AS n FROM customer)""")
def split_names(t: Tables) -> DataFrame:
    name = F.replace(F.replace("c_name", F.lit("#"), F.lit(" ")), F.lit("00"), F.lit(" "))
    first, rest = parse.split_full_name(name)
    day = F.concat(F.lit("2024-"), F.col("c_nationkey").cast("string"), F.lit("/x"))
    return t("customer").select(
        "c_custkey", first.alias("first_name"), rest.alias("rest"), parse.unify_date(day).alias("day")
    )


_STAMP = "concat(CASE WHEN o_orderstatus = 'P' THEN 'x' ELSE '' END, substr(CAST(o_orderdate AS string), 1, 10))"


@query(f"SELECT o_orderkey, try_strptime({_STAMP}, '%Y-%m-%d') AS parsed FROM orders")
def safe_dates(t: Tables) -> DataFrame:
    return t("orders").select(
        "o_orderkey", parse.safe_timestamp(F.expr(_STAMP), ["yyyy-MM-dd", "dd.MM.yyyy"]).alias("parsed")
    )


@query("""SELECT page_id, nullif(regexp_extract(url, '^[a-z0-9]+://([^/]+)/', 1), '') AS bucket,
        nullif(regexp_extract(url, '(?s)^[a-z0-9]+://[^/]+/(.+)$', 1), '') AS object_key,
        list_last(string_split(url, '/')) AS file_name, 'https://review.example.com/' || url AS link,
        list_last(string_split(url, '.')) = 'html' AS has_extension FROM pages""")
def uri_parts(t: Tables) -> DataFrame:
    url = F.col("url")
    return t("pages").select(
        "page_id", keys.uri_bucket(url).alias("bucket"), keys.uri_key(url).alias("object_key"),
        keys.file_name(url).alias("file_name"), keys.review_link(url, "https://review.example.com/").alias("link"),
        (keys.file_extension(url) == "html").alias("has_extension"),
    )


_FILE = """concat(substr(p_name, 1, 3), '.', CASE p_type WHEN 'ECONOMY' THEN 'GIF' WHEN 'STANDARD' THEN 'html'
    WHEN 'PROMO' THEN 'p7s' ELSE 'pdf' END)"""


@query(f"""SELECT p_partkey, CASE WHEN lower(list_last(string_split({_FILE}, '.'))) IN ('vcf', 'gif', 'p7s', 'asc', 'ics', 'bin')
        THEN 'irrelevant' WHEN lower(list_last(string_split({_FILE}, '.'))) IN ('html', 'mp4') THEN 'unsupported'
        ELSE 'process' END AS route FROM part""")
def file_route(t: Tables) -> DataFrame:
    return t("part").select("p_partkey", keys.file_route(F.expr(_FILE)).alias("route"))


@query("""SELECT page_id, 'files/2024-03-01/page_id_' || page_id || '/' || list_last(string_split(url, '/')) AS object_key
    FROM pages""")
def dated_key(t: Tables) -> DataFrame:
    day = F.lit("2024-03-01").cast("date")
    name = keys.file_name(F.col("url"))
    key = keys.dated_key(day, F.col("page_id").cast("string"), name, "files", "page_id")
    return t("pages").select("page_id", key.alias("object_key"))


_KEY = """CASE WHEN event_type = 'error' THEN concat('x/y/', event_type)
    WHEN event_type = 'view' THEN concat('exports/2024_13_40/9999/', event_type) ELSE key END"""


@query("""SELECT event_id, key, CASE WHEN event_type NOT IN ('error', 'view')
        THEN date_trunc('minute', ts) END AS created_at
    FROM (SELECT *, CASE WHEN event_type = 'error' THEN concat('x/y/', event_type)
        WHEN event_type = 'view' THEN concat('exports/2024_13_40/9999/', event_type)
        ELSE concat('exports/', strftime(ts, '%Y_%m_%d'), '/', strftime(ts, '%H%M'), '/export_data.json') END AS key
      FROM events)""")
def export_key_time(t: Tables) -> DataFrame:
    made = t("events").withColumn("key", keys.export_key(F.col("ts"), "exports"))
    keyed = made.withColumn("key", F.expr(_KEY))
    return keyed.select("event_id", "key", keys.export_key_time(F.col("key")).alias("created_at"))


@query("""SELECT conv_id, turn, array_to_string(list_filter(string_split(text, chr(10)),
    lambda x: NOT contains(x, 'le ')), chr(10)) AS text FROM conversations""")
def blocks_to_text(t: Tables) -> DataFrame:
    # lines that hold 'le ' play the part of words, which do not belong to the text
    blocks = F.transform(
        F.split("text", "\n", -1),
        lambda line: F.struct(
            F.when(line.contains("le "), "WORD").otherwise("LINE").alias("BlockType"), line.alias("Text"),
            F.lit("x").alias("Id"), F.lit(1.0).alias("Confidence"),
        ),
    )
    return t("conversations").select("conv_id", "turn", parse.blocks_to_text(blocks).alias("text"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents)
    SELECT doc_id, line AS "Text", 'line_' || i AS "Id", 'LINE' AS "BlockType", 99.0::double AS "Confidence"
    FROM l WHERE regexp_replace(line, '[%s]+', '', 'g') <> ''""" % _B)
def text_to_blocks(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", F.inline(parse.text_to_blocks(F.col("text"))))


@query("""SELECT doc_id, CAST(to_json(list_filter(list_transform(string_split(text, chr(10)), lambda line, i:
        {'BlockType': 'LINE', 'Text': line, 'Id': 'line_' || (i - 1), 'Confidence': 99.0::double}),
        lambda b: regexp_replace(b."Text", '[%s]+', '', 'g') <> '')) AS varchar) AS blocks FROM documents""" % _B)
def blocks_as_json(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", blocks_json(F.col("text")).alias("blocks"))


@query("""SELECT doc_id, CASE WHEN source = 'src3' THEN '' ELSE array_to_string(list_filter(string_split(text, chr(10)),
    lambda line: regexp_replace(line, '[%s]+', '', 'g') <> ''), chr(10)) END AS text FROM documents""" % _B)
def text_from_blocks_json(t: Tables) -> DataFrame:
    stored = F.when(differs(F.col("source"), "src3"), blocks_json(F.col("text")))
    return t("documents").select("doc_id", text_from_json(stored).alias("text"))


PROMPT = "Classify $lang text.\n--- START ---\n${clean_text}\n--- END --- $unknown ${lang}"


@query("""SELECT doc_id, 'Classify ' || lang || ' text.' || chr(10) || '--- START ---' || chr(10) || text || chr(10)
    || '--- END --- $unknown ' || lang AS prompt FROM documents""")
def prompt_table(t: Tables) -> DataFrame:
    values = {"clean_text": F.col("text"), "lang": F.col("lang")}
    return t("documents").select("doc_id", parse.render_prompt(PROMPT, values).alias("prompt"))


@query("""SELECT conv_id, turn, CAST(to_json([{'role': 'user', 'content': text}]) AS varchar) AS messages
    FROM conversations""")
def chat_messages(t: Tables) -> DataFrame:
    return t("conversations").select("conv_id", "turn", parse.chat_messages(F.col("text")).alias("messages"))


@query(f"""WITH {_DATES_CTE}, c AS (SELECT doc_id, count(*) AS n FROM valid GROUP BY 1)
    SELECT CAST(coalesce(n, 0) AS int) AS n_matches, count(*) AS n_rows FROM src LEFT JOIN c USING (doc_id) GROUP BY 1""")
def dates_per_document(t: Tables) -> DataFrame:
    spans = enriched(t).select(extract.date_matches(F.col("text")).alias("spans"))
    return profile.match_counts(spans, F.transform("spans", lambda span: span["text"]))
