r"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text, whose words are ``[^\x20\x09-\x0D]+``: densities of lexicon words (a seed list, and words and stems that the training labels show to be
toxic: a stem is what five to seven letters begin, and counts for a text that has it twice), how near they stand to a second-person word, capitals, punctuation, and words that symbols or
digits obfuscate. Each distinct word of some texts is looked at once; the rest is sums over arrays.

Trees are fitted on at most ``sample`` labelled rows. These are dealt to folds by a hash of doc_id. A row's features come from a lexicon that is learnt on
the other folds, so neither the trees nor the calibration, which is fitted on margins of rows left out of the trees, take a
word for toxic because of the row's own label. Texts are scored with the lexicon of all folds.

Rows with ``crc32(doc_id) mod 3 = 1`` are held out and nothing is learnt from them. Labels, language, source and
doc_id are no inputs of a score.

Defined results: null and empty texts get the score of a text without words; a null doc_id counts as held out = false and has no label; of several
labels of a document the largest counts, null labels are skipped; without labels every score is 0.5; repeated rows are scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import boosting
from palimpsest.llm.common import first_by_hash, own_columns, spans, strings, table, words_of, written

#: Labelled rows that the model is fitted on at most, and learnt lexicon words at most.
SAMPLE, LEXICON = 6000, 400
THRESHOLD = 0.7
FOLDS = 4
#: Bytes of texts looked at together, and words that a task remembers at least and, twice over, at most.
BLOCK, WORDS = 4_000_000, 100_000
# Words of insult, and second-person words of the four languages.
SEEDS = frozenset("asshole bastard bitch clown coward creep disgusting dumb fool garbage idiot idiotic imbecile jerk loser moron moronic pathetic pig scum stupid sucker trash ugly useless vermin worthless idiota estúpido imbécil basura asqueroso tonto idioten dumm dummkopf abschaum müll wertlos ekelhaft imbécile stupide ordure minable".split())
SECOND = frozenset("you your yours yourself youre u ur tu tú te ti usted ustedes vosotros vos du dich dir dein deine ihr euch vous toi ton votre vos".split())
_EDGE = re.compile(r"^\W+|\W+$")
_MASKED = re.compile(r"\w[*@$#!%&]+\w|[a-zA-Z]\d+[a-zA-Z]")
_LEET = str.maketrans("013457@$!", "oieastasi")
FEATURES = ("seed_density", "seed_hits", "learnt_density", "learnt_weight", "learnt_most", "learnt_kinds", "hit_share", "near_second", "second_density", "capitals", "shouted", "punctuation", "exclamations", "obfuscated", "hidden_hits", "words", "stem_density", "stem_hits", "stem_most", "stem_weight")


def bare(word: str) -> str:
    """The word in lower case without symbols at its ends."""
    return _EDGE.sub("", word).lower()


def stems(word: str) -> list[str]:
    """The word's stems, marked so that they differ from words."""
    return [f"{word[:k]}*" for k in (7, 6, 5) if len(word) > k]


_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_ENDS = punctuation.replace("_", "")
_MARKS = bytes(c for c in range(33, 127) if c not in _LETTERS and not 48 <= c <= 57)
# What a word is, as bits: in the seed list, learnt, only in lexicons once symbols are read as letters, second person, with symbols inside, all capitals.
SEED, LEARNT, HIDDEN, ADDRESS, MASKED, SHOUTED = 1, 2, 4, 8, 16, 32


class Lexicon:
    """Seed words, and learnt words and stems with their weights; tells what each word is and remembers it."""

    def __init__(self, learnt: dict[str, float]) -> None:
        self.learnt = learnt
        self.entries = sorted(SEEDS.union(learnt))
        self.number = {w: i + 1 for i, w in enumerate(self.entries)}
        #: By the number of an entry; 0 stands for none.
        self.weight = np.array([0.0, *(learnt.get(w, 0.0) for w in self.entries)])
        self.is_learnt = np.array([False, *(w in learnt for w in self.entries)])
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def look(self, word: str) -> int:
        """Bits of a word, the number of its entry and that of its longest learnt stem, in one integer."""
        core = word.strip(_ENDS)
        # Letters alone between marks need no pattern.
        b, bits = (core.lower(), 0) if core.isalpha() else (bare(word), MASKED if _MASKED.search(word) else 0)
        if bits and b not in self.number:
            plain = b.translate(_LEET)
            if plain in SEEDS or self.learnt.get(plain, 0.0) > 1.0:
                b, bits = plain, MASKED | HIDDEN
        bits |= (SEED if b in SEEDS else 0) | (LEARNT if b in self.learnt else 0) | (ADDRESS if b in SECOND else 0) | (SHOUTED if word.isupper() else 0)
        stem = next((self.number[s] for s in stems(b) if s in self.learnt), 0)
        return bits | self.number.get(b, 0) << 8 | stem << 24

    def known(self, words: list[str]) -> np.ndarray:
        if len(self.young) > WORDS:
            self.old, self.young = self.young, {}
        out = np.empty(len(words), np.int64)
        for i, w in enumerate(words):
            x = self.young.get(w)
            if x is None:
                x = self.old.get(w)
                self.young[w] = x = self.look(w) if x is None else x
            out[i] = x
        return out


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the values of each text."""
    return np.diff(np.r_[np.zeros(1, values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values)][starts])


def _features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    words, index, starts = words_of(texts)
    many = np.diff(starts)
    n, rows = np.maximum(1, many), len(texts)
    known = lexicon.known(words)
    bits, entry, stem = (known & 0xFF)[index], (known >> 8 & 0xFFFF)[index], (known >> 24)[index]
    count = lambda bit: _sums((bits & bit) > 0, starts)
    owner = np.repeat(np.arange(rows), many)
    hit = np.flatnonzero(bits & (SEED | LEARNT))
    doc, what = owner[hit], entry[hit]
    size = len(lexicon.weight)
    # Kinds of entries that each text has, and its stems with the times that it has them.
    kinds = np.unique(doc * size + what)
    kinds_of, learnt_of = np.bincount(kinds // size, minlength=rows), np.bincount(kinds // size, lexicon.is_learnt[kinds % size], rows)
    weights = np.where(bits[hit] & LEARNT, lexicon.weight[what], 0.0)
    most = np.zeros(rows)
    np.maximum.at(most, doc, weights)
    # How near a hit stands to a second-person word of its text: the last before it or the next.
    near = np.zeros(rows)
    second = np.flatnonzero(bits & ADDRESS)
    if len(second) and len(hit):
        at = np.searchsorted(second, hit)
        for other in (second[np.minimum(at, len(second) - 1)], second[np.maximum(at - 1, 0)]):
            np.maximum.at(near, doc, np.where(owner[other] == doc, 1 / (1 + np.abs(hit - other)), 0.0))
    stemmed = np.flatnonzero(stem)
    pair, times = np.unique(owner[stemmed] * size + stem[stemmed], return_counts=True)
    stem_most, stem_weight = np.zeros(rows), np.zeros(rows)
    np.maximum.at(stem_most, pair // size, times)
    twice = pair[times > 1]
    np.maximum.at(stem_weight, twice // size, lexicon.weight[twice % size])
    stem_hits = np.bincount(pair // size, times, rows)
    raw = strings(texts.fill_null("").cast(pa.binary()))
    without = lambda x, some: len(x) - len(x.translate(None, some))
    upper, letters, marks, calls = np.array([(without(x, _UPPER), without(x, _LETTERS), without(x, _MARKS), x.count(b"!")) for x in raw]).reshape(-1, 4).T
    chars = np.maximum(1, pc.utf8_length(texts.fill_null("")).to_numpy(zero_copy_only=False))
    hits = np.bincount(doc, minlength=rows)
    columns = [
        count(SEED) / n, count(SEED), hits / n, np.bincount(doc, weights, rows) / n, most, learnt_of, np.minimum(1.0, kinds_of / 5), near, count(ADDRESS) / n,
        upper / np.maximum(1, letters), count(SHOUTED) / n, marks / chars, calls / chars, count(MASKED) / n, count(HIDDEN) / n, np.log1p(many),
        stem_hits / n, stem_hits, stem_most, stem_weight,
    ]
    return np.stack([c.astype(float) for c in columns], axis=1)


def features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """The features of each text, a row per text."""
    size = pc.binary_length(texts.fill_null("")).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate([np.zeros((0, len(FEATURES))), *(_features(texts.slice(at, end - at), lexicon) for at, end in spans(size, BLOCK))])


@dataclass
class ToxicityModel:
    learnt: dict[str, float]
    trees: boosting.Boosted
    knots: tuple[np.ndarray, np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.trees.margin(x), *self.knots), 0.0, 1.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def units(texts: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Words without symbols at their ends that each text has, and stems that it has twice or more: numbers of texts, and what they have."""
    words, index, starts = words_of(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    number: dict[str, int] = {}
    plain = np.array([number.setdefault(bare(w), len(number)) for w in words], np.int64)
    names = list(number)
    have, times = np.unique(owner * max(1, len(names)) + plain[index], return_counts=True)
    out: list[tuple[int, str]] = []
    for doc, word, n in zip((have // max(1, len(names))).tolist(), (have % max(1, len(names))).tolist(), times.tolist(), strict=True):
        if names[word]:
            out.append((doc, names[word], n))
    twice: Counter[tuple[int, str]] = Counter()
    for doc, word, n in out:
        for s in stems(word):
            twice[doc, s] += n
    found = [(doc, word) for doc, word, _ in out] + [k for k, n in twice.items() if n > 1]
    return np.array([d for d, _ in found], np.int64), [w for _, w in found]


def learnt_words(labelled: DataFrame, limit: int = LEXICON) -> list[dict[str, float]]:
    """Log-odds of toxic to other documents for words and stems that mark toxic ones; ``labelled``: text, toxic, fold.

    First the lexicon of all rows, then for each fold that of the rows outside it; all from one count.
    """
    sizes = {r["fold"]: (r["n"], r["t"] or 0) for r in labelled.groupBy("fold").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, found = units(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("toxic").take(pa.array(doc)), b.column("fold").take(pa.array(doc)), pa.array(found, pa.string())], ["toxic", "fold", "word"])

    words = labelled.select("text", "toxic", "fold").mapInArrow(run, "toxic int, fold int, word string")
    in_fold = [F.count_if(F.col("fold") == k).alias(f"n{k}") for k in range(FOLDS)] + [F.coalesce(F.sum(F.when(F.col("fold") == k, F.col("toxic"))), F.lit(0)).alias(f"t{k}") for k in range(FOLDS)]
    counts = written(words.groupBy("word").agg(*in_fold).where(" + ".join(f"t{k}" for k in range(FOLDS)) + " >= 4"), "units")
    out = []
    for left in (None, *range(FOLDS)):
        folds = [k for k in range(FOLDS) if k != left]
        n, t = (sum(sizes.get(k, (0, 0))[i] for k in folds) for i in range(2))
        some = counts.select("word", sum((F.col(f"n{k}") for k in folds), F.lit(0)).alias("n"), sum((F.col(f"t{k}") for k in folds), F.lit(0)).alias("t"))
        odds = F.log(((F.col("t") + 0.5) / F.lit(t + 1.0)) / ((F.col("n") - F.col("t") + 0.5) / F.lit(n - t + 1.0)))
        # A unit must be seen in several toxic documents, and beyond what its count can give by chance.
        by_chance = F.col("n") * F.lit(t / max(n, 1))
        sure = F.col("t") - by_chance - 3.5 * F.sqrt(by_chance)
        found = some.where(F.col("t") >= 4).select("word", odds.alias("odds"), sure.alias("sure")).where("odds > 1.5 and sure > 0")
        out.append({r["word"]: float(r["odds"]) for r in found.orderBy(F.desc("sure"), "word").limit(limit).collect()})
    return out


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Fit on the documents of at most ``sample`` labelled ids that are not held out, the first by a hash of doc_id; of rows that repeat an id the first by text."""
    known = own_columns(labels, "doc_id", "toxic").where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # At most ``sample`` pairs of numbers are broadcast.
    known = known.join(F.broadcast(first_by_hash(known, "doc_id", sample)), "doc_id")
    fold = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(FOLDS)).cast("int")
    rows = own_columns(docs, "doc_id", "text").join(F.broadcast(written(known, "labelled")), "doc_id")
    rows = written(rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).withColumn("fold", fold), "sample")
    everything, *without = learnt_words(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicons = [Lexicon(w) for w in without]
        for b in batches:
            own = b.column("fold").to_numpy()
            x = np.zeros((len(own), len(FEATURES)))
            for k, lexicon in enumerate(lexicons):
                x[own == k] = features(b.column("text").filter(pa.array(own == k)), lexicon)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("doc_id", "toxic", "fold")] + [pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "toxic", "fold", "x"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    got = rows.mapInArrow(run, f"doc_id {kind}, toxic int, fold int, x array<double>").orderBy("doc_id").collect()
    x = np.array([r["x"] for r in got]).reshape(-1, len(FEATURES))
    y, fold = np.array([r["toxic"] for r in got], float), np.array([r["fold"] for r in got], int)
    out = np.zeros(len(y))
    for k in range(FOLDS):
        out[fold == k] = boosting.fit(x[fold != k], y[fold != k]).margin(x[fold == k])
    return ToxicityModel(everything, boosting.fit(x, y), boosting.isotonic(out, y))


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """All columns of ``docs`` and ``score``, from the text alone."""
    names = docs.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.learnt)
        for b in batches:
            x = features(b.column("text"), lexicon)
            keep = [c for c in names if c != "score"]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(model.score(x))], [*keep, "score"])

    return docs.mapInArrow(run, f"{kinds}, score double")


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, in its columns."""
    names = [c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)]
    slim = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)])
    kept = score_documents(slim, model).where(F.col("score") < threshold)
    return kept.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = own_columns(table(spark, sf_dir, "documents"), "doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = score_documents(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
