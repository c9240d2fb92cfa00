"""Each operator against a plain version on a small table with all odd cases."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperlane.llm import decontamination, jaccard, langid, ngramlm, pii, repeats, topk, unigram, urls
from paperlane.llm.bpe import ByteBpe, round_trip, round_trip_digests
from paperlane.llm.components import components
from paperlane.llm.queries import URL_RULES, VOCABULARIES

RNG = random.Random(5)
WORDS = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(1, 6))) for _ in range(60)]
BASE = [RNG.choice(WORDS) for _ in range(80)]


def varied(words, changes):
    out = list(words)
    for _ in range(changes):
        out[RNG.randrange(len(out))] = RNG.choice(WORDS) + "x"
    return " ".join(out)


TEXTS = [
    None, "", "   ", "one", "One two", "ONE two", "a b c d e", "A\tb\nc  d e", " ".join(BASE), " ".join(BASE),
    *(varied(BASE, k) for k in (1, 1, 2, 3, 4, 8)), varied(BASE, 2).upper(), "é ß 日本 \U0001f600 end", "x" * 30_000,
    " ".join(RNG.choice(WORDS) for _ in range(9_000)), "ab " * 3_000, *(" ".join(RNG.choice(WORDS) for _ in range(40)) for _ in range(12)),
]
SCHEMA = "doc_id bigint, text string, score string, Lang string"
SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with a repeated row, a missing id and columns whose names clash with results."""
    rows = [(i, t, "kept?", "en" if i % 2 else None) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[8], (None, TEXTS[8], None, "en")], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# 1


def plain_classes(rows):
    def shingles(text):
        words = SPACES.findall(lower(text))
        return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (own, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((own, len(sets[i]), min(ids) if sets[i] and ids else own))
    return sorted(out, key=repr)


def test_jaccard_classes(docs, nothing):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = jaccard.near_duplicate_classes(docs).select("doc_id", "n_shingles", "component_id")
    assert collected(found) == plain_classes(rows)
    assert jaccard.near_duplicate_classes(nothing).count() == 0


def test_links_of_very_large_sets_are_exact():
    # sizes and overlaps that single precision does not tell apart
    for size in (1_565_893, 2_000_003, 40_000_001, 10**12 + 39):
        least = -(-75 * 2 * size // 175)
        overlap = np.array([[least - 1, least]], dtype=np.int64)
        linked = jaccard.alike(overlap, np.array([size]), np.array([size, size]), 75)
        assert linked.tolist() == [[False, True]]


def test_overlaps_are_whole_numbers():
    values = np.tile(np.arange(70_000, dtype=np.uint64), 40)
    side = np.repeat(np.arange(40), 70_000)
    found = jaccard.shared_counts(values, side, side, (40, 40))
    assert found.dtype == np.int64 and (found == 70_000).all()


def test_jaccard_threshold_and_chains(spark):
    # a chain of neighbours that are linked, though its ends are not; overlap of exactly 75 %
    words = [f"w{i}" for i in range(60)]
    chain = [" ".join(words[k : k + 40]) for k in range(0, 20, 2)]
    exact = ["p q r s t u v", "p q r s t u v y"]
    rows = [(i, t) for i, t in enumerate([*chain, *exact])]
    found = jaccard.near_duplicate_classes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert collected(found.select("doc_id", "n_shingles", "component_id")) == plain_classes(rows)
    assert {r["component_id"] for r in found.filter("doc_id >= 10").collect()} == {10}


def plain_links(rows):
    """Number of rows linked with each, and the linked pairs of different sets by smallest id."""
    sets = []
    for _, t in rows:
        w = SPACES.findall(lower(t))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())

    def linked(x, y):
        return bool(x and y) and 100 * len(x & y) >= 75 * len(x | y)

    numbers = [sum(linked(x, y) for y in sets) - bool(x) for x in sets]
    least = {x: min((i for (i, _), y in zip(rows, sets) if y == x and i is not None), default=None) for x in sets}
    pairs = [(*sorted((least[x], least[y])), len(x & y)) for k, x in enumerate(least) for y in list(least)[:k] if linked(x, y)]
    return sorted([(i, n) for (i, _), n in zip(rows, numbers)], key=repr), sorted(pairs, key=repr)


def test_links(spark, docs, nothing, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    # copies, near copies that share lists of many heads, and chains
    words = [f"w{i}" for i in range(90)]
    near = [" ".join(words[k : k + 40]) for k in range(0, 40, 2) for _ in range(1 + k % 3)]
    near += [" ".join([*words[:30], f"v{k}", *words[31:60]]) for k in range(60)]
    many = spark.createDataFrame([*rows, *((100 + i, t) for i, t in enumerate(near))], "doc_id bigint, text string")
    for blocks in (256, 7):
        monkeypatch.setattr(jaccard, "BLOCK_SETS", blocks)
        for table in (docs, many):
            own = [(r["doc_id"], r["text"]) for r in table.collect()]
            numbers, pairs = plain_links(own)
            assert collected(jaccard.near_duplicate_classes(table).select("doc_id", "n_links")) == numbers
            assert collected(jaccard.near_duplicate_pairs(table)) == pairs
    assert sum(n for _, n in numbers) > 2 * len(pairs) > 2 * len(near)
    assert jaccard.near_duplicate_classes(nothing).columns[-1] == "n_links"
    assert jaccard.near_duplicate_pairs(nothing).count() == 0


def test_one_of_each(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = [r["doc_id"] for r in jaccard.one_of_each(docs).collect()]
    classes = plain_classes(rows)
    assert sorted(kept) == sorted({c for i, n, c in classes if n} | {i for i, n, _ in classes if not n})


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (5, 5), (2, 1)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert collected(found.select("node", "root")) == [(11, 10), (12, 10), (2, 1), (3, 1), (4, 1)]
    path = [(i, i + 1) for i in range(200)]
    found = components(spark.createDataFrame(path, "a bigint, b bigint"))
    assert {r["root"] for r in found.collect()} == {0}


# 2

ASCII = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_contamination(texts, items, size=10):
    windows = []
    for item, text in items:
        w = ASCII.findall(lower(text))
        n = min(size, len(w))
        windows += [(item, tuple(w[k : k + n])) for k in range(len(w) - n + 1) if n]
    out = []
    for text in texts:
        w = ASCII.findall(lower(text))
        hit, ids = set(), set()
        for item, window in windows:
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit.update(range(k, k + len(window)))
                    ids.add(item)
        out.append((len(w), len(hit), sorted(str(i) for i in ids)))
    return out


def test_contamination(spark, docs, nothing):
    items = [
        (7, " ".join(BASE[5:30])), (8, " ".join(BASE[20:33]).upper()), (9, "one two"), (10, None), (11, ""), (12, "no such words here"),
        (13, "ab ab ab"), (7, " ".join(BASE[5:30])), (14, "A-b.c"), (100, "é ß"),
    ]
    items = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, words string")
    found = decontamination.contamination(docs, items)
    rows = found.collect()
    expected = plain_contamination([r["text"] for r in rows], [(r["item_id"], r["text"]) for r in items.collect()])
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in rows] == expected
    assert [r["contaminated"] for r in rows] == [e[1] > 0 for e in expected]
    assert {"score", "Lang"} <= set(found.columns)
    assert decontamination.contamination(nothing, items).count() == 0
    clean = decontamination.contamination(docs, items.limit(0))
    assert clean.filter("contaminated OR n_hit > 0 OR size(items) > 0").count() == 0
    assert clean.count() == docs.count()


def test_near_matches(spark):
    item = [f"t{i}" for i in range(10)]
    shuffled = " ".join(["a", "b", *item[5:], "gap", *item[:5], "c"])
    texts = spark.createDataFrame([(1, " ".join(item)), (2, shuffled), (3, " ".join(item[:9])), (4, None)], "doc_id int, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id int, text string")
    found = decontamination.near_matches(texts, items, slop=3)
    keys = {bytes(r["key"]) for r in found.collect()}
    assert keys == {hashlib.md5(t.encode()).digest() for t in (" ".join(item), shuffled)}


# 3


def plain_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    places = Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for b in raw:
        covered = np.zeros(len(b) + 1, dtype=bool)
        for k in range(len(b) - length + 1):
            if places[b[k : k + length]] > 1:
                covered[k : k + length] = True
        runs = int((covered[:-1] & ~np.roll(covered, 1)[: len(b)]).sum()) if len(b) else 0
        out.append((bytes(c for c, x in zip(b, covered) if not x), runs))
    return out


@pytest.mark.parametrize("length", [200, 50])
def test_repeats(spark, docs, nothing, length):
    shared = " ".join(RNG.choice(WORDS) for _ in range(70))
    more = [f"{RNG.choice(WORDS)} {i} {shared[RNG.randrange(40):]} tail {i}" for i in range(9)]
    rows = [*((r["doc_id"], r["text"]) for r in docs.collect()), *((100 + i, t) for i, t in enumerate([*more, "é" * 150, "日本" * 120, "z" * 199, "z" * 200]))]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    rows = repeats.remove_repeats(table, length=length).collect()
    expected = plain_repeats([r["text"] for r in rows], length)
    assert [(bytes(r["kept"]), len(r["removed"])) for r in rows] == expected
    assert repeats.remove_repeats(nothing).count() == 0


def test_repeats_in_long_texts(spark):
    # longer than a chunk, with a repeat that lies across its border
    rng = np.random.default_rng(3)
    long = rng.integers(97, 123, (1 << 20) + 5_000, dtype=np.uint8).tobytes().decode()
    inside = long[(1 << 20) - 400 : (1 << 20) + 300]
    rows = repeats.remove_repeats(spark.createDataFrame([(1, long), (2, "-" + inside + "-")], "doc_id int, text string")).collect()
    runs = {r["doc_id"]: [tuple(x) for x in r["removed"]] for r in rows}
    assert runs == {1: [((1 << 20) - 400, (1 << 20) + 300)], 2: [(1, 701)]}


# 4

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_base(text):
    out = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", m[0])
            good = (
                k == 0 or (k == 1 and all(int(p) <= 255 for p in m[0].split(".")))
                or (k == 2 and 12 <= len(digits) <= 19 and pii.luhn(digits)) or (k == 3 and 9 <= len(digits) <= 15)
            )
            if good:
                out.append((m.start(), m.end(), k + 1))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_patterns():
    rng = random.Random(2)
    signs = "a1@.+- (9)4%_\n" + "0123456789" * 2
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["a@b.c@d.e.f", "1.2.3.4.5.6.7.8", "256.1.1.1 001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 123-4567.", "x@y", "é a.b@c.de 日本"]
    assert [pii.base_spans(t) for t in texts] == [plain_base(t) for t in texts]


@pytest.mark.parametrize("junk", ["a", "1", "a@", "1.", "+1 ", "1 ", "@", "("])
def test_patterns_take_linear_time(junk):
    pii.find([junk * 200_000], pii.fit(np.zeros(0, dtype=np.int64), np.zeros((0, pii.FEATURES + 3 * pii.LABELS))))


PERSONAL = "Call +49 30 1234567 today, or later call 030 1234567 again. Order 20240117 and 55667788."


def test_skip_links_add_spans(spark, docs):
    # numbers that look like base spans elsewhere, so that shapes alone say little
    rows = [(i, f"Call +49 {RNG.randint(10, 99)} {RNG.randint(1000000, 9999999)} today. Number {RNG.randint(10**6, 10**11)} or x{i}@y.org") for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    weights = pii.learn(table, "text")
    texts = spark.createDataFrame([(1, PERSONAL), (2, PERSONAL.replace("+49 30 1234567", "us")), (3, None)], "doc_id int, text string")
    found = {r["doc_id"]: r for r in pii.detect(texts, "text", weights, masked="masked").collect()}
    spans = [(PERSONAL[s["start"] : s["end"]], s["kind"], s["base"]) for s in found[1]["spans"]]
    assert spans == [("+49 30 1234567", "phone", True), ("030 1234567", "phone", False)]
    assert found[1]["masked"] == "Call [PHONE] today, or later call [PHONE] again. Order 20240117 and 55667788."
    assert found[2]["spans"] == [] and found[3]["spans"] == []
    # base spans are the same with or without the field
    everything = pii.detect(docs, "text", weights)
    assert all([(s["start"], s["end"]) for s in r["spans"] if s["base"]] == [x[:2] for x in plain_base(r["text"] or "")] for r in everything.collect())


def exact_marginals(g, w):
    """Sums over all labelings of the nodes and of one node for each group of alike ones."""
    n = len(g.spans)
    group = pii.groups(g).tolist()
    hubs = sorted({x for x in group if group.count(x) > 1})
    theta = g.features @ w.unary
    for i in np.flatnonzero(g.label >= 0):
        theta[i, g.label[i]] += pii.CLAMP
    total = np.zeros((n, pii.LABELS))
    for labels in itertools.product(range(pii.LABELS), repeat=n + len(hubs)):
        p = sum(theta[i, labels[i]] for i in range(n)) + sum(w.chain[labels[a], labels[b]] for a, b in g.chain)
        p += sum(w.alike[labels[i], labels[n + hubs.index(group[i])]] for i in range(n) if group[i] in hubs)
        total[np.arange(n), labels[:n]] += math.exp(p)
    return total / total.sum(axis=1, keepdims=True)


def small_field(seed, n, chain, alike, label, size=0.5):
    rng = np.random.default_rng(seed)
    links = [np.array(x, dtype=np.int64).reshape(len(x), 2) for x in (chain, alike)]
    g = pii.Graph([(0, 1)] * n, [0] * n, np.array(label), rng.normal(size=(n, pii.FEATURES)).astype(np.float32), *links)
    return g, pii.Weights(rng.normal(size=(pii.FEATURES, 5)) * 0.1, rng.normal(size=(5, 5)) * size, rng.normal(size=(5, 5)) * size)


def test_messages_are_exact_without_loops():
    for seed, chain, alike, label in ((1, [(0, 1)], [(1, 2)], [-1, 3, -1]), (2, [(0, 1), (1, 2)], [], [-1, -1, -1]), (3, [(1, 2)], [(0, 1), (1, 3)], [2, -1, -1, -1])):
        g, w = small_field(seed, len(label), chain, alike, label, 1.0)
        assert np.allclose(pii.marginals(g, w), exact_marginals(g, w), atol=1e-3)


def test_messages_are_close_with_loops():
    # neighbours that are alike as well, and two groups that cross
    for seed in range(4):
        for chain, alike in (([(0, 1), (1, 2)], [(0, 2)]), ([(0, 1), (1, 2), (2, 3)], [(0, 2), (1, 3)])):
            n = 1 + max(b for _, b in chain)
            g, w = small_field(seed, n, chain, alike, [4] + [-1] * (n - 1))
            assert np.abs(pii.marginals(g, w) - exact_marginals(g, w)).max() < 0.05


def test_alike_nodes_agree_over_any_distance():
    n = 400
    g, w = small_field(5, n, [(i, i + 1) for i in range(n - 1)], [(i, i + 1) for i in range(n - 1)], [3] + [-1] * (n - 1))
    g.features[:] = 0
    strong = pii.Weights(w.unary, np.zeros((5, 5)), np.eye(5) * 6)
    assert (pii.marginals(g, strong)[:, 3] > 0.9).all()


def test_addresses_of_any_length():
    rng = random.Random(8)
    texts = ["".join(rng.choice("a@b \n.") for _ in range(30)) for _ in range(3000)] + ["x" * 5000 + "@" + "y" * 5000, "@@a@@b@c@d"]
    for text in texts:
        assert list(pii.addresses(text)) == [m.span() for m in re.finditer(r"[^\s@]+@[^\s@]+", text)]


def test_personal_data_in_odd_tables(spark, nothing):
    weights = pii.fit(np.zeros(0, dtype=np.int64), np.zeros((0, pii.FEATURES + 3 * pii.LABELS)))
    assert pii.learn(nothing, "text").unary.shape == weights.unary.shape
    found = pii.detect(nothing, "text", weights, masked="masked")
    assert found.count() == 0 and found.columns[-2:] == ["spans", "masked"]
    # columns of the same names in other letters are replaced, and repeated rows stay
    rows = spark.createDataFrame([("a@b.cd", 1, "old", "old")] * 2 + [(None, 2, "old", None), ("", 3, None, None)], "text string, doc_id int, Spans string, MASKED string")
    found = pii.detect(rows, "text", weights, masked="masked")
    assert found.columns == ["text", "doc_id", "spans", "masked"]
    assert [(r["doc_id"], len(r["spans"]), r["masked"]) for r in found.orderBy("doc_id").collect()] == [(1, 1, "[EMAIL]"), (1, 1, "[EMAIL]"), (2, 0, ""), (3, 0, "")]


# 5


def test_top_inner_products(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(300 + i, rows[40][1]) for i in range(60)] + [(rows[20][0], rows[20][1])]
    rows += [(1000, None), (1020, [1.0, None]), (1040, [1.0, float("nan")]), (1060, [float("inf")]), (None, [1.0]), (1080, []), (1100, [0.5]), (1120, [-3.0] * 9)]
    found = topk.top_inner_products(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 20 == 0, top=15)
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = set()
    for q, a in dict((i, v) for i, v in good if i % 20 == 0).items():
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:15]
        expected |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)}
    assert {tuple(r) for r in found.collect()} == expected
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert topk.top_inner_products(empty, F.col("vec_id") % 20 == 0).count() == 0


def test_large_components(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(120)]
    rows += [(i, [float(x) for x in rng.normal(size=4) * 10.0 ** rng.integers(5, 8)]) for i in range(120, 180)]
    rows += [(180, [2.0**21, 0.0, 0.0, 0.0]), (181, [-(2.0**21), 0.0, 0.0, 0.0]), (182, [2.0**57 - 64, 0.0, 0.0, 0.0])]
    rows = [(i, [0.0, *v[1:]] if i % 20 == 0 and i < 180 else v) for i, v in rows if i != 180] + [(200, [0.0, 0.0, 0.0, -(2.0**25)])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = topk.top_inner_products(table, F.col("vec_id") % 20 == 0, top=15)
    whole = {i: [math.floor(64 * x) for x in v] for i, v in rows}
    expected = set()
    for q, a in whole.items():
        if q % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole.items() if i != q)[:15]
            expected |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)}
    assert any(i >= 120 for _, _, i, _ in expected)
    assert {tuple(r) for r in found.collect()} == expected

    def top(rows, n):
        table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
        return [tuple(r) for r in topk.top_inner_products(table, F.col("vec_id") % 20 == 0, top=n).collect()]

    # the ends of the range, and a score below it that is not among the best
    ends = [(0, [2.0**25]), (1, [2.0**26 - 1]), (2, [-(2.0**26)]), (3, [-(2.0**40)])]
    assert top(ends, 2) == [(0, 1, 1, 2**31 * (2**32 - 64)), (0, 2, 2, -(2**63))]
    assert top([(0, [1 / 64]), (1, [-(2.0**57)])], 1) == [(0, 1, 1, -(2**63))]
    for bad in ([(0, [2.0**30]), (1, [2.0**30])], [(0, [2.0**30]), (1, [-(2.0**30)])], [(0, [1.0]), (1, [1e300])]):
        with pytest.raises(Exception, match="does not fit a long"):
            top(bad, 2)


# 6


@pytest.fixture(scope="module")
def codec():
    return ByteBpe(f"{VOCABULARIES}/byte_bpe_50k.json")


def test_bpe_equals_the_library(codec):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(f"{VOCABULARIES}/byte_bpe_50k.json")
    rng = random.Random(1)
    signs = "ab eE's tTn\n\t   éß日本\U0001f600'll'd12²٣<|endoftext|>_-…\x1c\x85​"
    pieces = [t.decode() for t in list(codec.ids)[:20000] if all(c < 128 for c in t)]
    texts = [t or "" for t in TEXTS]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    texts += ["".join(rng.choice(pieces) for _ in range(6)) for _ in range(1500)]
    texts += ["<|endoftext|>" * 2, "  <|endoftext|>  x", "a" * 5000, " " * 3000]
    found = codec.encode(texts)
    for text, ids in zip(texts, found, strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<u4").tolist() == expected
        assert codec.decode(ids) == library.decode(expected, skip_special_tokens=False) == text
    assert codec.decode(np.array([codec.ids[b"\xe6"], 64], dtype="<u4").tobytes()) == library.decode([codec.ids[b"\xe6"], 64], skip_special_tokens=False)


def test_round_trip(docs, nothing):
    path = f"{VOCABULARIES}/byte_bpe_50k.json"
    rows = round_trip(docs, "text", path, decoded="SCORE").collect()
    assert len(rows) == len(TEXTS) + 2 and all(r["SCORE"] == (r["text"] or "") for r in rows)
    digests = round_trip_digests(docs, "text", path, keep=["doc_id"]).filter("doc_id < 3").collect()
    assert {(r["n_tokens"], r["ids_sha256"]) for r in digests if r["doc_id"] < 2} == {(0, hashlib.sha256(b"").hexdigest())}
    assert round_trip(nothing, "text", path).count() == 0


# 7


def test_token_counts_equal_the_library(docs, nothing):
    tokenizers = pytest.importorskip("tokenizers")
    path = f"{VOCABULARIES}/piece_bpe_32k.model"
    pieces, _ = unigram.read_pieces(path)
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    lowest = min(pieces.values())
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    library = tokenizers.Tokenizer(tokenizers.models.Unigram([(n, pieces.get(n, lowest)) for n in names], unk_id=0, byte_fallback=True))
    library.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)
    rng = random.Random(1)
    signs = "ab eE's tTn\n\t   éß日本\U0001f600llre▁஥஦"
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    counter = unigram.UnigramCounter(pieces, True)
    assert [counter(t)[1] for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    rows = unigram.token_counts(docs, "text", path, score="SCORE").collect()
    assert all((r["SCORE"], r["n_tokens"]) == counter(r["text"] or "") for r in rows)
    assert unigram.token_counts(nothing, "text", path).count() == 0


def test_best_path_of_small_vocabularies():
    def plain(text, pieces, byte_pieces, unknown):
        best = {0: (0.0, 0, False)}
        for end in range(1, len(text) + 1):
            for start in range(end):
                piece, (score, n, fused) = text[start:end], best[start]
                if piece in pieces:
                    option = (score + pieces[piece], n + 1, False)
                elif end - start == 1:
                    option = (score + unknown, n + (len(piece.encode()) if byte_pieces else not fused), True)
                else:
                    continue
                if end not in best or option[0] > best[end][0]:
                    best[end] = option
        return best[len(text)][0], int(best[len(text)][1])

    rng = random.Random(3)
    for _ in range(300):
        pieces = {"".join(rng.choice("ab▁") for _ in range(rng.randint(1, 4))): float(-rng.randint(0, 4)) for _ in range(8)}
        for byte_pieces in (True, False):
            counter = unigram.UnigramCounter(pieces, byte_pieces)
            text = "".join(rng.choice("aabb▁é") for _ in range(12))
            assert counter.best(text) == plain(text, pieces, byte_pieces, min(pieces.values()) - 10)


# 8


def test_url_rules(spark):
    cases = [
        ("http://a.com", "a.com", "", None, "allow"), ("http://a.com/", "a.com", "/", "com/", "allow"),
        ("https://EXAMPLE.com/en/1?x=/en/", "example.com", "/en/1", "example.com/en/", "block"),
        ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("https://m.www.example.com/en/x", "m.www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("x://notexample.com/en/x", "notexample.com", "/en/x", "com/", "allow"), ("x://a.net/EN/fr/", "a.net", "/EN/fr/", None, "allow"),
        ("x://a.net/es/#/fr/", "a.net", "/es/", "net/es/", "block"), ("x://net/fr/", "net", "/fr/", "net/fr/", "block"),
        ("x://a.net/es", "a.net", "/es", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("a.com/x", "", "", None, "allow"),
        ("a://b://c.net/es/", "b:", "//c.net/es/", None, "allow"), ("x://casino.org/a", "casino.org", "/a", "^casino^", "block"),
        ("x://a.org?casino", "a.org", "", None, "allow"), ("x://a.org/tag/x/page/2", "a.org", "/tag/x/page/2", "^tag/*/page^", "block"), ("x://a\n.com/\n?", "a\n.com", "/\n", "com/", "allow"),
    ]
    rows = [(i, u, "old") for i, (u, *_) in enumerate(cases)]
    pages = spark.createDataFrame([*rows, rows[2]], "page_id int, url string, Verdict string")
    found = urls.judge(pages, "url", URL_RULES)
    assert collected(found.select("page_id", "host", "path", "rule", "verdict")) == sorted(((i, *c[1:]) for i, c in [*enumerate(cases), (2, cases[2])]), key=repr)
    assert urls.judge(pages.limit(0), "url", URL_RULES).count() == 0


def test_rules_without_tokens_and_rarest_tokens(spark):
    rules = [urls.pattern_rule("q*z", urls.BLOCK), urls.pattern_rule("/rare/common/", urls.BLOCK)]
    assert [r.tokens for r in rules] == [(), ("rare", "common")]
    pages = spark.createDataFrame([(1, "x://h/common/a"), (2, "x://h/rare/common/"), (3, "x://h/q1z"), (4, "x://h/RARE/common/b")], "page_id int, url string")
    verdicts = {r["page_id"]: r["rule"] for r in urls.judge(pages, "url", rules).collect()}
    assert verdicts == {1: None, 2: "/rare/common/", 3: "q*z", 4: "/rare/common/"}
    index = urls.index_rules(urls.rule_table(spark, rules), spark.createDataFrame([("h/common/a",), ("h/rare/common/",)], "address string"))
    assert {r["rule"]: r["token"] for r in index.collect()} == {"q*z": "", "/rare/common/": "rare"}


# 9


def test_elias_fano():
    rng = np.random.default_rng(2)
    for n, universe in ((0, 10), (1, 1), (50, 60), (1000, 10**12), (5000, 5100), (64, 64 * 64)):
        values = np.sort(rng.choice(universe, n, replace=n > universe)).astype(np.uint64)
        sequence = ngramlm.EliasFano(values, universe)
        assert (sequence.get(np.arange(n)) == values).all()
        asked = np.concatenate([values, rng.integers(0, universe, 200).astype(np.uint64)])
        places, held = sequence.successor(asked)
        assert (places == np.searchsorted(values, asked)).all()
        assert (held == np.isin(asked, values)).all()


def test_scores(docs, nothing):
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    rows = ngramlm.score_texts(docs, "text", train, keep=["doc_id", "text", "score"], order=2).collect()
    assert len(rows) == len(TEXTS) + 2

    def tokens(row):
        return [*SPACES.findall(lower(row["text"])), None]

    single, pairs = Counter(), Counter()
    for r in rows:
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            single.update(tokens(r))
            pairs.update(zip([None, *tokens(r)], tokens(r)))
    total, distinct, weight = sum(single.values()), len(single), ngramlm.WEIGHT
    for r in rows:
        own = tokens(r)
        p = [(single[w] + 1) / (total + distinct + 1) for w in own]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(single[w] > 0 for w in own), total)
        assert math.isclose(r["base_score"], sum(map(math.log10, p)), rel_tol=1e-9)
        exact = sum(math.log10((pairs[v, w] + weight * q) / (single[v] + weight)) for v, w, q in zip([None, *own], own, p))
        assert abs(r["score"] - exact) <= 0.04 * len(own)
    assert ngramlm.score_texts(nothing, "text", train).count() == 0


def test_shares_of_a_context_add_up_to_at_most_one():
    rng = np.random.default_rng(3)
    for total in (1, 5, 300, 10**6, 10**13):
        counts = np.append(rng.integers(1, max(2, total // 1000), 50), total)
        for c in (counts[:-1], counts[-1:]):
            # a corpus has at least the tokens of one of its contexts
            span = ngramlm.decades(int(c.sum()), ngramlm.WEIGHT)
            share = ngramlm.restore(ngramlm.quantise(c / (c.sum() + ngramlm.WEIGHT), span), span)
            exact, rest = c / (c.sum() + ngramlm.WEIGHT), ngramlm.WEIGHT / (c.sum() + ngramlm.WEIGHT)
            assert (share <= exact).all() and share.sum() + rest <= 1
            assert (share >= exact * 10 ** (-1.001 * span / ngramlm.LEVELS)).all()


def test_no_text_is_more_than_certain(spark):
    # after each word the next one is sure, as often as counts lead to shares close to 1
    rows = [(i, "a b c d e f " * 300) for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id int, text string")
    for order in (2, 3, 4):
        assert all(r["score"] < 0 for r in ngramlm.score_texts(table, "text", F.lit(True), order=order).collect())


def test_small_ranges_and_hot_contexts(spark, monkeypatch):
    rows = [(i, " ".join(["hot", RNG.choice(WORDS)] * RNG.randint(1, 30))) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    one = {r["doc_id"]: r["score"] for r in ngramlm.score_texts(table, "text", F.lit(True)).collect()}
    monkeypatch.setattr(ngramlm, "LEAST_RANGES", 3)
    monkeypatch.setattr(ngramlm, "HOT_SHARE", 1000)
    other = {r["doc_id"]: r["score"] for r in ngramlm.score_texts(table, "text", F.lit(True)).collect()}
    assert all(math.isclose(one[i], other[i], rel_tol=1e-12) for i in one)


@pytest.mark.parametrize("order", [3, 4])
def test_longer_contexts(spark, docs, nothing, monkeypatch, order):
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    rows = ngramlm.score_texts(docs, "text", train, keep=["doc_id", "text"], order=order).collect()
    # several slices ask about the same n-grams, ranges are small, and contexts are spread
    monkeypatch.setattr(ngramlm, "PACK_BYTES", 1 << 10)
    monkeypatch.setattr(ngramlm, "LEAST_RANGES", 3)
    monkeypatch.setattr(ngramlm, "HOT_SHARE", 100)
    others = ngramlm.score_texts(docs, "text", train, keep=["doc_id", "text"], order=order).collect()
    assert len(rows) == len(others) == len(TEXTS) + 2

    def grams(row, n):
        own = [None, *SPACES.findall(lower(row["text"])), None]
        return [tuple(own[max(0, k + 1 - n) : k + 1]) for k in range(1, len(own))]

    counts, single = Counter(), Counter()
    for r in rows:
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            single.update(g[-1] for g in grams(r, 1))
            for n in range(2, order + 1):
                counts.update(g for g in grams(r, n) if len(g) == n)
    before = Counter()
    for g, n in counts.items():
        before[g[:-1]] += n
    total, weight = sum(single.values()), ngramlm.WEIGHT

    def p(gram):
        if len(gram) == 1:
            return (single[gram[0]] + 1) / (total + len(single) + 1)
        return (counts[gram] + weight * p(gram[1:])) / (before[gram[:-1]] + weight)

    for r in [*rows, *others]:
        own = grams(r, order)
        exact, pairs = (sum(math.log10(p(g)) for g in x) for x in (own, grams(r, 2)))
        assert abs(r["score"] - exact) <= 0.04 * len(own)
        if r["doc_id"] == 8:
            assert abs(exact - pairs) > 0.04 * len(own)  # a model of pairs is told apart
    assert ngramlm.score_texts(nothing, "text", train, order=order).count() == 0


# 10


def test_language_profiles(spark, docs, nothing):
    alphabets = {"xx": "abcde", "yy": "defgh", "zz": "äöüßi"}
    rows = []
    for i in range(240):
        name = list(alphabets)[i % 3]
        rows.append((i, " ".join("".join(RNG.choice(alphabets[name]) for _ in range(5)) for _ in range(RNG.randint(4, 30))), name))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("held_out", langid.held_out(F.col("doc_id"), 4, 2))
    known = langid.profiles(table.filter("NOT held_out"), "text", "lang")
    found = langid.identify(table, "text", known).filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) / len(found) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)
    odd = {r["doc_id"]: r for r in langid.identify(docs, "text", known, score="SCORE").filter("doc_id < 4").collect()}
    assert [odd[i]["lang_pred"] for i in range(3)] == ["und"] * 3 and odd[3]["lang_pred"] in alphabets
    assert langid.profiles(nothing, "text", "Lang") == {}
    assert {r["lang_pred"] for r in langid.identify(docs, "text", {}).collect()} == {"und"}
    assert langid.identify(nothing, "text", known).count() == 0


def test_bundles_are_sums_of_bound_letters():
    profiler = langid.Profiler(64)
    letters = [profiler.letters("ab, ab"), profiler.letters("b" * 700_000)]
    vectors, base = profiler.letters.vectors.astype(int), len(profiler.letters.vectors)
    assert base > 3
    expected = np.zeros((2, 64))
    for i, text in enumerate(letters):
        grams = Counter(zip(text[:-2].tolist(), text[1:-1].tolist(), text[2:].tolist()))
        for (a, b, c), n in grams.items():
            expected[i] += n * np.roll(vectors[a], 2) * np.roll(vectors[b], 1) * vectors[c]
    assert (profiler.block(letters) == expected).all()


def test_held_out(spark):
    rows = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id bigint").select("doc_id", langid.held_out(F.col("doc_id"), 4, 2).alias("x")).collect()
    assert all(r["x"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
