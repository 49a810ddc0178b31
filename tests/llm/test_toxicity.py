"""Toxicity features against a slow twin, lexicons per fold, and repeated ids."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import toxicity
from palimpsest.llm.toxicity import FEATURES, SECOND, SEEDS, Lexicon

GAP = re.compile(r"[\x20\x09-\x0D]+")
LEARNT = {"gruff": 2.0, "moron": 1.7, "blarg": 0.5, "snarks*": 3.0, "snark*": 2.5, "grumm*": 1.6, "ñandu*": 1.9}


def words_in(text):
    return [w for w in GAP.split(text) if w]


def slow_bare(word):
    return re.sub(r"^\W+|\W+$", "", word).lower()


def slow_features(text, learnt):
    """One word after another, as the features are defined."""
    words = words_in(text)
    n = max(1, len(words))
    hits, second, kinds, stems = [], [], [], Counter()
    masked = hidden = seeds = 0
    weight = most = 0.0
    for i, w in enumerate(words):
        b = slow_bare(w)
        odd = re.search(r"\w[*@$#!%&]+\w|[a-zA-Z]\d+[a-zA-Z]", w) is not None
        masked += odd
        if odd and b not in learnt and b not in SEEDS:
            plain = b.translate(str.maketrans("013457@$!", "oieastasi"))
            if plain in SEEDS or learnt.get(plain, 0) > 1:
                b = plain
                hidden += 1
        for k in (7, 6, 5):
            if len(b) > k and b[:k] + "*" in learnt:
                stems[b[:k] + "*"] += 1
                break
        if b in SEEDS or b in learnt:
            hits.append(i)
            kinds.append(b)
            seeds += b in SEEDS
            weight += learnt.get(b, 0.0)
            most = max(most, learnt.get(b, 0.0))
        if b in SECOND:
            second.append(i)
    near = max((1 / (1 + min(abs(h - s) for s in second)) for h in hits), default=0.0) if second else 0.0
    letters = [c for c in text if c.isascii() and c.isalpha()]
    upper = [c for c in letters if c.isupper()]
    marks = [c for c in text if c.isascii() and 32 < ord(c) < 127 and not c.isalnum()]
    chars = max(1, len(text))
    known = {b for b in kinds if b in learnt}
    out = [seeds / n, seeds, len(hits) / n, weight / n, most, len(known), min(1, len(set(kinds)) / 5), near, len(second) / n]
    out += [len(upper) / max(1, len(letters)), sum(w.isupper() for w in words) / n, len(marks) / chars, text.count("!") / chars, masked / n, hidden / n, np.log1p(len(words))]
    return out + [sum(stems.values()) / n, sum(stems.values()), max(stems.values(), default=0), max((learnt[s] for s, k in stems.items() if k > 1), default=0.0)]


def some_texts(seed, n=300):
    rng = random.Random(seed)
    bag = ["you", "DU", "the", "a", "idiot", "IDIOT!", "id1ot", "m0r0n,", "gruff", "Gruff.", "snarksome", "snarkiest", "grummeln", "ñanduland", "x9y", "f**l", "é", "müll", "!!!", "...", "A1", "plain", "words", "\x85", "你好"]
    gaps = [" ", "\n", "\t ", "\x0b", "  "]
    return ["".join(rng.choice(bag) + rng.choice(gaps) for _ in range(rng.randrange(30))) for _ in range(n)] + ["", " ", "\n\n", "idiot", "you idiot " * 3000]


@pytest.mark.parametrize(("block", "words"), [(4_000_000, 100_000), (200, 3)])
def test_features_against_slow_twin(monkeypatch, block, words):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    monkeypatch.setattr(toxicity, "WORDS", words)
    texts = some_texts(1)
    got = toxicity.features(pa.array([*texts, None]), Lexicon(LEARNT))
    want = np.array([slow_features(t, LEARNT) for t in [*texts, ""]], float)
    assert got.shape == (len(texts) + 1, len(FEATURES))
    for j, name in enumerate(FEATURES):
        assert np.allclose(got[:, j], want[:, j]), name
    assert toxicity.features(pa.array([], pa.string()), Lexicon({})).shape == (0, len(FEATURES))


def slow_lexicon(rows, limit):
    n, t = len(rows), sum(y for _, y in rows)
    seen, toxic = Counter(), Counter()
    for text, y in rows:
        counts = Counter(slow_bare(w) for w in words_in(text or ""))
        twice = Counter()
        for b, k in counts.items():
            for size in (7, 6, 5):
                if len(b) > size:
                    twice[b[:size] + "*"] += k
        for u in [b for b in counts if b] + [s for s, k in twice.items() if k > 1]:
            seen[u] += 1
            toxic[u] += y
    found = []
    for u, k in seen.items():
        odds = np.log(((toxic[u] + 0.5) / (t + 1)) / ((k - toxic[u] + 0.5) / (n - t + 1)))
        sure = toxic[u] - k * t / n - 3.5 * np.sqrt(k * t / n)
        if toxic[u] >= 4 and odds > 1.5 and sure > 0:
            found.append((-sure, u, odds))
    return {u: o for _, u, o in sorted(found)[:limit]}


def test_lexicons_leave_their_fold_out(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        toxic = int(rng.random() < 0.2)
        text = " ".join(rng.choice(["one", "two", "three", "yellowish", "yellowest"]) for _ in range(20))
        rows.append((text + (" grobian grobianisch!" if toxic and rng.random() < 0.9 else "") + (f" only{i % 4}" if toxic else ""), toxic, i % 4))
    df = spark.createDataFrame([*rows, (None, 0, 1)], "text string, toxic int, fold int")
    every, *without = toxicity.learnt_words(df, 50)
    plain = [(t, y) for t, y, _ in rows]
    assert every == pytest.approx(slow_lexicon([*plain, (None, 0)], 50)) and "grobian" in every
    for k, got in enumerate(without):
        # A word that only this fold's rows have is not in its lexicon.
        assert got == pytest.approx(slow_lexicon([(t, y) for t, y, f in [*rows, (None, 0, 1)] if f != k], 50))
        assert f"only{k}" not in got and f"only{(k + 1) % 4}" in got


def test_repeated_ids_do_not_crowd_out_the_sample(spark):
    """A third of the rows repeat one id; every labelled id is still in the sample, each once."""
    docs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("some text "), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    seen = []
    plain = toxicity.learnt_words

    def spy(rows, limit=toxicity.LEXICON):
        seen.append(rows.groupBy().agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("d")).first())
        return plain(rows, limit)

    toxicity.learnt_words = spy
    try:
        toxicity.fit_toxicity(docs, labels, 200)
    finally:
        toxicity.learnt_words = plain
    assert seen[0]["n"] == seen[0]["d"] == 200
