"""Endings learned from a corpus, against a plain version."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from paperlane.operators import lemmas


def plain_rules(texts, most=lemmas.MAX_ENDINGS):
    words = {w for t in texts for w in t if len(w) >= 3 and w.isalpha()}
    parted = [(w[:-n], w[-n:]) for w in words for n in range(1, min(len(w) - 3, 4) + 1)]
    saved, count = defaultdict(int), defaultdict(int)
    for stem, ending in parted:
        if stem in words:
            saved[ending] += len(stem) - 2
            count[ending] += 1
    gains = sorted((-(saved[e] - len(e)), e) for e in saved if count[e] > 1 and saved[e] > len(e))
    chosen = {e for _, e in gains[:most]}
    sets = defaultdict(set)
    for stem, ending in parted:
        if ending in chosen:
            sets[stem].add(ending)
    for w in words:
        sets[w].add("")
    members = defaultdict(list)
    for stem, endings in sets.items():
        if len(endings) > 1:
            members[tuple(sorted(endings, key=lambda e: (len(e), e)))].append(stem)
    best = {}
    for endings, stems in members.items():
        letters, written = sum(map(len, stems)), sum(map(len, endings))
        whole = len(endings) * letters + len(stems) * written
        gain = whole - (letters + written + 2 * len(stems))
        if len(stems) > 1 and gain > 0:
            for e in endings:
                best[e] = max(best.get(e, (0, "", "")), (gain, ",".join(endings), endings[0]))
    return {e: (base, gain) for e, (gain, _, base) in best.items() if e != base}


def plain_lemma(word, rules):
    for n in range(min(len(word) - 3, 4), 0, -1):
        if word[-n:] in rules:
            return word[:-n] + rules[word[-n:]]
    return word


def corpus(seed):
    pick = random.Random(seed)
    stems = ["".join(pick.choice("abdeklmnorstuä") for _ in range(pick.randint(3, 7))) for _ in range(120)]
    groups = (["", "en", "st", "t"], ["e", "en", "er"], ["", "s"], ["ung", "ungen"])
    words = [s + e for i, s in enumerate(stems) for e in groups[i % 4] if pick.random() < 0.9]
    return [pick.choices(words + ["12", "a1b", "x", "日本語です"], k=60) for _ in range(40)]


def test_rules_equal_a_plain_version(spark):
    for seed in (1, 2):
        texts = corpus(seed)
        df = spark.createDataFrame([(t,) for t in texts] + [(None,), ([],)], "w array<string>")
        rules = {r["ending"]: (r["replacement"], r["gain"]) for r in lemmas.learn_rules(df, "w").collect()}
        assert rules == plain_rules(texts) and rules
        endings = lemmas.Endings({e: base for e, (base, _) in rules.items()})
        words = sorted({w for t in texts for w in t}) + ["unbekannten", "en", "ent", ""]
        found = spark.createDataFrame([(w,) for w in words], "w string").select("w", endings(F.col("w")).alias("l")).collect()
        assert {r["w"]: r["l"] for r in found} == {w: plain_lemma(w, {e: b for e, (b, _) in rules.items()}) for w in words}


def test_the_corpus_decides(spark):
    # endings come back only where stems share them
    words = [s + e for s in ("rechn", "mahn", "zahl", "lief", "stund") for e in ("ung", "ungen")] + ["jung", "lunge"]
    df = spark.createDataFrame([(words,)], "w array<string>")
    endings = lemmas.Endings.from_rules(lemmas.learn_rules(df, "w"))
    found = df.select(lemmas.lemmas(F.col("w"), endings).alias("l")).first()["l"]
    assert found[:4] == ["rechnung", "rechnung", "mahnung", "mahnung"] and found[-2:] == ["jung", "lunge"]


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(["ab", "12"],), (None,)], "w array<string>")
    assert lemmas.learn_rules(df, "w").count() == 0
    same = lemmas.Endings({})
    assert [r["l"] for r in df.select(lemmas.lemmas(F.col("w"), same).alias("l")).collect()] == [["ab", "12"], None]
