"""The registered queries: each operator over the whole of its table."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlane.llm import bpe, decontamination, divergence, jaccard, langid, mixing, ngramlm, pii, prefixes, repeats, topk, unigram, urls
from paperlane.llm.registry import QUERIES, SQL, query, table

__all__ = ["QUERIES", "SQL"]

# Folder of the public vocabulary files; it must exist on every executor.
VOCABULARIES = os.environ.get("PAPERLANE_VOCABULARIES", "/opt/tokenizers")


SPACED_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


@query(f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({SPACED_SQL}, []) AS w FROM documents),
    s AS (SELECT DISTINCT r, array_to_string(w[k + 1 : k + 5], ' ') AS g
        FROM (SELECT r, w, unnest(range(0, greatest(len(w) - 4, 1))) AS k FROM d WHERE len(w) > 0)),
    n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
    pairs AS (SELECT a.r AS a, b.r AS b, count(*) AS i FROM s a JOIN s b USING (g) WHERE a.r < b.r GROUP BY 1, 2),
    links AS (SELECT a, b FROM pairs JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
    around AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach(a, b) AS (SELECT r, r FROM d UNION SELECT reach.a, around.b FROM reach JOIN around ON around.a = reach.b),
    least AS (SELECT reach.a AS r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY 1)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d JOIN least USING (r) LEFT JOIN n USING (r)""")
def op1_jaccard_classes(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicate_classes(table(spark, folder, "documents"), keep=["doc_id"], links=None)


@query(SQL["op1_jaccard_classes"].rpartition("SELECT")[0] + """SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
    FROM d JOIN least USING (r) LEFT JOIN n USING (r) LEFT JOIN (SELECT a AS r, count(*) AS n_links FROM around GROUP BY a) USING (r)""")
def op1_jaccard_links(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicate_classes(table(spark, folder, "documents"), keep=["doc_id"])


WORDS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({WORDS_SQL}, []) AS w FROM documents),
    i AS (SELECT CAST(item_id AS varchar) AS item_id, {WORDS_SQL} AS w FROM benchmark WHERE text IS NOT NULL),
    windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(CASE WHEN len(w) = 0 THEN [] ELSE
        list_transform(range(0, len(w) - least(len(w), 10) + 1), lambda k: array_to_string(w[k + 1 : k + least(len(w), 10)], ' ')) END) AS g FROM i),
    lengths AS (SELECT DISTINCT n FROM windows),
    grams AS (SELECT r, n, k, array_to_string(w[k + 1 : k + n], ' ') AS g
        FROM (SELECT r, w, n, unnest(range(0, len(w) - n + 1)) AS k FROM d, lengths WHERE len(w) >= n)),
    hits AS (SELECT r, item_id, k, n FROM grams JOIN windows USING (n, g)),
    places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM hits) GROUP BY r),
    items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)""")
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark")
    found = decontamination.contamination(docs, items)
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), "contaminated",
    )


@query("""WITH b AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS (SELECT r, p, md5(substr(h, 2 * p + 1, 400)) AS k FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 199)) AS p FROM b WHERE length(h) >= 400)),
    hit AS (SELECT r, p FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
    part AS (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 200 THEN 0 ELSE 1 END AS new FROM hit),
    run AS (SELECT r, min(p) AS a, max(p) + 200 AS z FROM (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS i FROM part) GROUP BY r, i),
    gap AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM run),
    cut AS (SELECT r, CAST(sum(z - a) AS bigint) AS n_removed, count(*) AS n_spans,
        string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(z) + 1) AS kept
        FROM gap JOIN b USING (r) GROUP BY r)
    SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
        sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM b LEFT JOIN cut USING (r)""")
def op3_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    found = repeats.remove_repeats(docs.withColumn("n_bytes", n_bytes), keep=["doc_id", "n_bytes"])
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query()
def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = pii.detect(docs, "text", pii.learn(docs, "text"), spans="found", keep=["doc_id"])

    def joined(spans: str) -> Column:
        return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')")

    counts = [F.expr(f"CAST(size(filter(found, x -> x.base AND x.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in pii.KINDS]
    base = F.sha2(joined("filter(found, x -> x.base)"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, joined("found").alias("spans"))


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS double) * 64) AS bigint)) AS c FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(CAST(q.c AS double[]), CAST(v.c AS double[])) AS bigint) AS score
        FROM v AS q, v WHERE q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS int) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""")
def op5_top_inner_products(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return topk.top_inner_products(vectors, F.col("vec_id") % 20 == 0)


@query()
def op6_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return bpe.round_trip_digests(docs, "text", f"{VOCABULARIES}/byte_bpe_50k.json", keep=["doc_id"])


@query()
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return unigram.token_counts(docs, "text", f"{VOCABULARIES}/piece_bpe_32k.model", keep=["doc_id"])


@query()
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", langid.held_out(F.col("doc_id"), 4, 2))
    known = langid.profiles(docs.filter("NOT held_out"), "text", "lang")
    return langid.identify(docs, "text", known, keep=["doc_id", "held_out"])


# Rules for hosts, which come first, and patterns for pages that are rarely worth reading.
HOST_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)
BLOCKED_PATTERNS = (
    "^ads^", "^adserver^", "^banner^", "^casino^", "^poker^", "^porn^", "^xxx^", "^warez^", "^torrent^",
    "^login^", "^logout^", "^signup^", "^cart^", "^checkout^", "^doubleclick^", "^tag/*/page^", "^wp-admin^",
    "^adult^", "^bets^", "^pills^", "^spam^", "^track^", "^tracker^",
)
URL_RULES = (
    *(urls.host_rule(*r) for r in HOST_RULES), *(urls.pattern_rule(p, urls.BLOCK) for p in BLOCKED_PATTERNS),
)
FITTING_SQL = " UNION ALL ".join(
    f"SELECT '{h}{p}' AS rule, '{v}' AS verdict, '{h}' AS rule_host, '{p}' AS rule_path" for h, p, v in HOST_RULES
)
PATTERN_SQL = " OR ".join(f"regexp_matches(host || path, '{r.regex}')" for r in URL_RULES if r.grade == 0)


@query(f"""WITH rules AS ({FITTING_SQL}), u AS (SELECT row_number() OVER () AS r, page_id,
        coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    fits AS (SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM u, rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY r)
    SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN {PATTERN_SQL} THEN 'block' ELSE 'allow' END) AS verdict
    FROM u LEFT JOIN fits USING (r)""")
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = urls.judge(pages, "url", URL_RULES)
    # a pattern is part of the method: only rules for hosts are named
    named = F.when(F.col("rule").isin([h + p for h, p, _ in HOST_RULES]), F.col("rule"))
    return judged.select("page_id", "host", "path", named.alias("rule"), "verdict")


@query()
def op9_ngram_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", langid.held_out(F.col("doc_id"), 7, 2))
    return ngramlm.score_texts(docs, "text", ~F.col("held_out"), keep=["doc_id", "held_out"], order=3)


SIZE_SQL = r"CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS bigint)"


@query(f"""WITH d AS (SELECT doc_id, source, {SIZE_SQL} AS size,
        CAST('0x' || substr(md5(coalesce(CAST(doc_id AS varchar), '') || ':' || coalesce(text, '') || ':42'), 1, 13) AS bigint) / CAST(4503599627370496 AS double) AS chance FROM documents),
    s AS (SELECT source, CAST(sum(size) AS hugeint) AS size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM d GROUP BY source),
    o AS (SELECT *, sum(size) OVER () - 3 * coalesce(sum(size) OVER w, 0) AS words, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weights
        FROM s WINDOW w AS (ORDER BY 6 * size // weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    level AS (SELECT words, weights FROM o WHERE words * weight <= 3 * size * weights ORDER BY weights DESC LIMIT 1),
    t AS (SELECT source, CAST(size AS bigint) AS source_size, CASE WHEN words * weight > 3 * size * weights THEN CAST(3 * size AS double)
        ELSE CAST(words * weight AS double) / CAST(weights AS double) END AS target FROM (SELECT source, size, weight FROM s), level),
    r AS (SELECT *, CASE WHEN source_size > 0 THEN least(target / CAST(source_size AS double), 3) ELSE 0 END AS rate FROM t)
    SELECT doc_id, d.size, source_size, target, d.size * CAST(floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END AS bigint) AS taken
    FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source""")
def op11_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = mixing.repetitions(docs, "text", "source", ["doc_id", "text"], keep=["doc_id"])
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


TERMS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"


@query(f"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {TERMS_SQL} AS w FROM documents),
    t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
    kept AS (SELECT lang, term, CAST(count(*) AS hugeint) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
    c AS (SELECT lang, source, term, CAST(count(*) AS hugeint) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
    g AS (SELECT DISTINCT lang, source FROM d),
    totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
    langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
    p AS (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000 * (coalesce(n, 0) + 5)) // (total + 5 * v) AS p,
        1 + (1000000000 * (lang_n + 5)) // (lang_total + 5 * v) AS q
        FROM totals JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
    sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM p AS a JOIN p AS b USING (lang, term) GROUP BY a.lang, a.source, b.source),
    found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS value FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums AS s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
    ranked AS (SELECT lang, source, part, item, CAST(value AS bigint) AS value,
        CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS int) AS rank FROM found)
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50""")
def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


# CRC-32 of the digits of a number, bit by bit
CRC_SQL = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST({0} AS varchar), ''), lambda x: CAST(ord(x) AS bigint))),
    lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""


@query(f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    o AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || ':' || text)) AS own FROM t GROUP BY conv_id),
    h AS (SELECT conv_id, own, {CRC_SQL.format("conv_id")} % 6 AS h FROM o),
    c AS (SELECT h.conv_id, list_concat(coalesce(b.own, [])[1 : h.h], h.own[h.h + 1 :]) AS turns FROM h LEFT JOIN o AS b ON b.conv_id = h.conv_id - h.conv_id % 100),
    p AS (SELECT conv_id, len(turns) AS n, d, md5(to_json(turns[1 : d])) AS k,
        md5(to_json(turns[1 : d - 1])) AS parent, length(turns[d].text) AS chars FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM c)),
    node AS (SELECT d, k, min(CASE WHEN d > 0 THEN parent END) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, max(coalesce(chars, 0)) AS chars,
        sha256(coalesce(string_agg(CAST(conv_id AS varchar), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256 FROM p GROUP BY d, k),
    childs AS (SELECT d - 1 AS d, parent AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2),
    whole AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN childs USING (d, k)),
    -- each node lies on the path of its smallest conversation
    sums AS (SELECT p.d, p.k, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((u.n_convs - 1) * u.chars) AS saved
        FROM whole AS u JOIN p ON p.conv_id = u.conv_id AND p.d <= u.d GROUP BY p.d, p.k)
    SELECT w.conv_id, w.d AS depth, up.conv_id AS parent_conv_id, w.n_convs, w.n_children, CAST(s.n_leaves AS bigint) AS n_leaves,
        CAST(s.saved AS bigint) AS saved_tokens, w.ends_sha256
    FROM whole AS w JOIN sums AS s USING (d, k) LEFT JOIN node AS up ON up.d = w.d - 1 AND up.k = w.parent""")
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, folder, "conversations"))
