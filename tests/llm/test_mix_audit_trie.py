"""Source mix, divergence audit and prefix trie against plain versions, with all odd cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from paperlane.llm import divergence, mixing, prefixes
from paperlane.llm.numbering import numbered
from paperlane.llm.sizes import broadcast_within
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, size string, TARGET string"


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# numbers and sizes


def test_numbers_follow_the_order(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5003).alias("x"), F.lit(None).cast("int").alias("_n"))
    found = {r["x"]: r["n"] for r in numbered(df, [F.col("x")], "n", "test").collect()}
    assert [found[x] for x in sorted(found)] == list(range(5000))
    assert numbered(df.limit(0), [F.col("x")], "n", "test").count() == 0


def test_only_few_bytes_are_broadcast(spark):
    small = spark.createDataFrame([(1, "a" * 1000)], "k int, t string")
    assert "broadcast" in broadcast_within(small)._jdf.queryExecution().logical().toString().lower()
    assert broadcast_within(small, 1000) is small
    with pytest.raises(TypeError):
        broadcast_within(small.select(F.array("k").alias("a")))


# 11


def plain_mix(rows, weights=(1, 2, 3), most=3):
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    totals = Counter()
    for r, n in zip(rows, sizes, strict=True):
        totals[r[3]] += n
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    free, target = set(order), dict.fromkeys(order, Fraction(0))
    while free:
        left = sum(totals.values()) - sum(target[s] for s in order if s not in free)
        share = {s: Fraction(left * weight[s], sum(weight[f] for f in free)) for s in free}
        above = {s for s in free if share[s] > most * totals[s]}
        target.update(share if not above else {s: Fraction(most * totals[s]) for s in above})
        if not above:
            break
        free -= above
    out = []
    for r, n in zip(rows, sizes, strict=True):
        rate = target[r[3]] / totals[r[3]] if totals[r[3]] else Fraction(0)
        key = f"{'' if r[0] is None else r[0]}:{r[1] or ''}:42"
        chance = Fraction(int(hashlib.md5(key.encode()).hexdigest()[:13], 16), 16**13)
        out.append((r[0], n, totals[r[3]], float(target[r[3]]), int(rate) + (chance < rate - int(rate))))
    return sorted(out, key=repr), {s: float(t) for s, t in target.items()}


MIX = [
    (1, None, "x", "b", "s", "t"), (2, "", "x", "b", "s", "t"), (3, " \t ", "x", "c", "s", "t"), (None, "One two", None, None, "s", "t"),
    (5, "a b c  d", "x", "", "s", "t"), (5, "a b c  d", "x", "", "s", "t"), (6, "w " * 50_000, "x", "big", None, None),
    *((i, "one two three " * (i % 7), "en", f"s{i % 5}" if i % 3 else "hot", "s", "t") for i in range(10, 200)),
]


def test_mix_equals_a_plain_one(spark):
    docs = spark.createDataFrame(MIX, DOCS).repartition(5)
    found = mixing.repetitions(docs, "text", "source", ["doc_id", "text"])
    expected, targets = plain_mix(MIX)
    got = [(r[0], r[1], r[2], pytest.approx(r[3], rel=1e-12), r[4]) for r in rows_of(found, "doc_id", "size", "source_size", "target", "copies")]
    assert got == expected
    assert sum(targets.values()) == pytest.approx(sum(len((r[1] or "").split()) for r in MIX), rel=0.001)
    # added columns replace those of the same name, others stay
    assert found.columns == ["doc_id", "text", "lang", "source", "size", "source_size", "target", "copies"]
    assert rows_of(found, "doc_id", "copies") == rows_of(mixing.repetitions(docs.repartition(2), "text", "source", ["doc_id", "text"]), "doc_id", "copies")
    emitted = mixing.mixed(found)
    assert emitted.count() == sum(r[4] for r in expected) and emitted.filter("copy > copies").count() == 0


def test_mix_comes_near_the_targets(spark):
    rows = [(i, "a b c d e " * (1 + i % 4), "en", f"s{i % 12 if i % 3 else 0}", "s", "t") for i in range(9000)]
    found = mixing.repetitions(spark.createDataFrame(rows, DOCS), "text", "source", ["doc_id"], keep=["source"])
    sums = found.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target"), F.max("copies").alias("most"))
    for r in sums.collect():
        assert abs(r["taken"] - r["target"]) < 0.15 * r["target"] and r["most"] <= 3


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    assert mixing.repetitions(docs, "text", "source", ["doc_id"]).count() == 0
    wordless = spark.createDataFrame([(1, None, "x", "b", "s", "t"), (2, " ", "x", None, "s", "t")], DOCS)
    assert rows_of(mixing.repetitions(wordless, "text", "source", ["doc_id"]), "doc_id", "target", "copies") == [(1, 0.0, 0), (2, 0.0, 0)]


# 12


def plain_audit(rows, least, top):
    terms = [Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r[1] or "").translate({c: c + 32 for c in range(65, 91)}))) for r in rows]
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for r, t in zip(rows, terms, strict=True):
        groups[r[2] or "", r[3] or ""].update(t)
        docs[r[2] or ""].update(t.keys())
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least]
        own = {s: c for (g, s), c in groups.items() if g == lang}
        whole = sum(own.values(), Counter())

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in own.items()}, shares(whole)
        for s in own:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in own if o != s]
            raised = [(p[s][t] - q[t], t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", raised, top)):
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ordered)]
    return sorted(out, key=repr)


COLUMNS = ("lang", "source", "part", "item", "value", "rank")
WORDS = ["the", "The", "of", "Straße", "ÉTÉ", "été", "日本", "x1y", "a-b", "co_op", "end."]
AUDIT = [
    (None, None, None, None, "s", "t"), (1, "", "en", "s1", "s", "t"), (1, "", "en", "s1", "s", "t"), (2, "only once", "zz", "lonely", "s", "t"),
    (3, "123 456", "zz", None, "s", "t"), (4, "q" * 2_000_000 + " the " + "the of " * 30_000, "en", "s9", "s", "t"),
    *((i, " ".join(WORDS[(i * k + k) % len(WORDS)] for k in range(1, i % 13)), ("en", "de", None)[i % 3], f"s{i * 7 % 6}" if i % 2 else "hot", "s", "t") for i in range(10, 160)),
]


@pytest.mark.parametrize("group_block,term_block", [(32, 4096), (2, 3)])
def test_audit_equals_a_plain_one(spark, group_block, term_block):
    docs = spark.createDataFrame(AUDIT, DOCS).repartition(4)
    found = divergence.audit(docs, least_documents=12, top_terms=4, group_block=group_block, term_block=term_block)
    assert rows_of(found, *COLUMNS) == plain_audit(AUDIT, 12, 4)


def test_audit_without_kept_terms_and_without_rows(spark):
    docs = spark.createDataFrame(AUDIT, DOCS)
    found = divergence.audit(docs, least_documents=10_000)
    assert rows_of(found, *COLUMNS) == plain_audit(AUDIT, 10_000, 50) and found.filter("value <> 0").count() == 0
    assert divergence.audit(docs.limit(0)).count() == 0


def test_shares_are_exact_beyond_a_long(spark):
    n, total, kept = 10**13 + 7, 10**15 + 3, 10**6
    found = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(kept)).alias("p")).first()["p"]
    assert found == 1 + 10**9 * (n + 5) // (total + 5 * kept)


def test_terms_of_long_texts_are_not_cut(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE_BYTES", 5)
    found = sum(divergence.words_of("abcDEFgh ij klm 12no É".encode()), [])
    assert found == [x.encode() for x in ("abcdefgh", "ij", "klm", "no", "É")]


# 13


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}:{text}".encode()).digest()), (role, text)))
    turns = {c: [t for _, t in sorted(x)] for c, x in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        before = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(turns.get(before, [])[:h] + turns[c][h:])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(built):
        ends[built[c]].append(c)
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
            if d:
                children[built[c][: d - 1]].add(built[c][:d])
    out = []
    for node in members:
        below = [n for n in members if n[: len(node)] == node]
        leaves = sum(not children[n] for n in below)
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        digest = hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
        parent = members[node[:-1]][0] if node else None
        out.append((members[node][0], len(node), parent, len(members[node]), len(children[node]), leaves, saved, digest))
    return sorted(out, key=repr)


def hello(c):
    """A common first turn, few second ones, and many copies."""
    return [(c, 0, "system", "hello"), (c, 1, "user", f"q{c % 3}"), (c, 2, "assistant", f"a{c % 2}"), *((c, 3 + k, "user", "same") for k in range(c % 9))]


TURNS = [
    (None, 0, "user", "nobody"), (300, None, None, None), (300, 0, "user", None), (301, 5, "user", "x"), (301, 5, "user", "x"), (301, 5, "user", "é\U0001f600"),
    (302, 9, "a", "late"), (302, None, "a", "early"), (777, 0, "user", "no earlier one"), (-205, 1, "u", "below"), (-200, 1, "u", "zero"),
    (450, 0, "user", "z" * 300_000), *((451, k, "user", "long") for k in range(300)), *(t for c in range(0, 130) for t in hello(c)),
]
TRIE = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("most", [1, 7, 100, 50_000])
def test_trie_equals_a_plain_one(spark, most, monkeypatch):
    monkeypatch.setattr(prefixes, "SPAN", 16)
    monkeypatch.setattr(prefixes, "CHUNK_IDS", 3)
    turns = spark.createDataFrame(TURNS, TRIE).withColumn("depth", F.lit("clash")).repartition(6)
    assert rows_of(prefixes.prefix_trie(turns, most), *prefixes.FACTS) == plain_trie(TURNS)


def test_trie_of_few_conversations(spark):
    empty = spark.createDataFrame([], TRIE)
    assert prefixes.prefix_trie(empty).count() == 0
    # no earlier conversation to take turns from, and none left of its own
    alone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(alone, 0, "user", "gone")]
    assert rows_of(prefixes.prefix_trie(spark.createDataFrame(rows, TRIE)), *prefixes.FACTS) == plain_trie(rows)
