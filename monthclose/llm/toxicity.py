"""Toxicity by a weighted lexicon.

Texts are folded (case, wide and other forms of letters, homoglyphs of other scripts, digits that stand for letters) to words
of letters. A lexicon of whole words and word beginnings with weights is matched with one Aho-Corasick automaton; in a word the
longest entry counts, and repetitions of an entry count by their logarithm. Matches inside an exception phrase do not count. The
sum of weights, plain and per word of text, goes through a logistic curve.

The lexicon and the curve are learned from a bounded sample of labelled rows. An entry must be much more frequent in toxic
texts, and must be followed by many different words: words of a passage that was only copied a lot are followed by one.

Defined results: NULL and empty texts are scored as texts without matches. A row repeated is scored each time. A document with
several labels counts as toxic if any label says so. Without toxic labels nothing is learned, and every score is 0.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthclose.llm.common import BATCH_BYTES, small_batches
from monthclose.sources.encoding import session_settings

#: Bounds of the training sample, rows of each label, and of the lexicon.
TOXIC_ROWS, CLEAN_ROWS, ENTRIES = 3000, 6000, 4000
#: An entry needs this many toxic texts, different following words, and log odds.
LEAST_TEXTS, LEAST_FOLLOWERS, LEAST_WEIGHT = 8, 8, 3.5
#: Entries that a worker counts before it passes them on.
COUNTED_AT_ONCE = 100_000
#: Lengths of word beginnings that may become entries.
BEGINNINGS = range(4, 9)

# Letters of other scripts, digits and signs that stand for a Latin letter.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "в": "b", "к": "k", "м": "m", "н": "h", "т": "t", "ё": "e", "ї": "i", "ɡ": "g", "ո": "n", "ӏ": "l", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "γ": "y", "ω": "w",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
}
# Phrases whose words are no insult.
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "take out the trash", "clown fish", "circus clown", "rodeo clown", "pond scum",
    "soap scum", "sore loser rule", "stupid simple", "the idiot by dostoevsky", "worthless stock", "worthless currency",
)
_OTHERS = re.compile(r"[\W\d_]+")


def _fold_table() -> dict[int, str]:
    """Homoglyphs, wide and mathematical letters by their compatibility form; invisible characters vanish."""
    table = {}
    for code in [*range(0x2100, 0x2190), *range(0x2460, 0x2500), *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800)]:
        plain = unicodedata.normalize("NFKC", chr(code)).lower()
        table[code] = "".join(HOMOGLYPHS.get(c, c) for c in plain)
    return table | {c: "" for c in (0xAD, *range(0x200B, 0x2010), 0xFEFF)} | {ord(k): v for k, v in HOMOGLYPHS.items()}


_FOLD = _fold_table()


def folded(text: str | None) -> str:
    """Words of letters with one space before, between and after them."""
    return f" {_OTHERS.sub(' ', (text or '').lower().translate(_FOLD)).strip()} "


@dataclass
class Lexicon:
    """Entries with weights (``" word "`` whole, ``" begin"`` a beginning), exception phrases, and the curve."""

    weights: dict[str, float]
    curve: tuple[float, float, float] = (-30.0, 0.0, 0.0)
    exceptions: tuple[str, ...] = EXCEPTIONS
    _automaton: object = field(default=None, repr=False)

    def automaton(self):
        if self._automaton is None:
            automaton = ahocorasick.Automaton()
            for phrase in self.exceptions:
                automaton.add_word(folded(phrase), (len(folded(phrase)), None))
            for entry, weight in self.weights.items():
                automaton.add_word(entry, (len(entry), weight))
            if len(automaton):
                automaton.make_automaton()
            self._automaton = automaton
        return self._automaton

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def matched(self, text: str | None) -> tuple[float, int]:
        """Sum of the weights that count, and the number of words."""
        plain = folded(text)
        words = max(plain.count(" ") - 1, 0)
        automaton = self.automaton()
        if not len(automaton):
            return 0.0, words
        at: dict[int, tuple[int, float]] = {}
        spans = []
        for end, (length, weight) in automaton.iter(plain):
            start = end - length + 1
            if weight is None:
                spans.append((start, end))
            elif start not in at or at[start][0] < length:
                at[start] = (length, weight)
        if spans:
            spans.sort()
            starts, ends = [a for a, _ in spans], list(accumulate((b for _, b in spans), max))
            at = {s: v for s, v in at.items() if not (k := bisect_right(starts, s)) or ends[k - 1] <= s}
        counts = Counter((plain[s : s + n], w) for s, (n, w) in at.items())
        return sum(w * (1 + math.log(k)) for (_, w), k in counts.items()), words

    def features(self, text: str | None) -> tuple[float, float]:
        total, words = self.matched(text)
        return math.log1p(total), math.log1p(100 * total / max(words, 1))

    def score(self, text: str | None) -> float:
        a, b = self.features(text)
        z = self.curve[0] + self.curve[1] * a + self.curve[2] * b
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def training_sample(
    docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS,
) -> DataFrame:
    """(text, toxic) of a bounded number of labelled rows of each label, in hash order of the id.

    Only ids are sorted; the texts are found by a join with the at most ``toxic_rows + clean_rows`` chosen ids. Of rows that share an
    id, that with the smallest checksum of its text is taken.
    """
    by_id = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col)).alias("toxic"))
    )
    by_id = by_id.where(train_on("id", train, id_col)) if train is not None else by_id
    order = [F.xxhash64("id"), F.col("id")]
    chosen = (
        by_id.where("toxic = 1").orderBy(*order).limit(toxic_rows)
        .unionByName(by_id.where("toxic = 0").orderBy(*order).limit(clean_rows))
    )
    # A bound by construction: at most toxic_rows + clean_rows rows of two numbers.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = texts.join(F.broadcast(chosen), "id")
    first = F.row_number().over(Window.partitionBy("id").orderBy(F.xxhash64("text"), "text"))
    return found.withColumn("row", first).where("row = 1").select("id", "text", "toxic")


def train_on(alias: str, condition, id_col: str) -> Column:
    """The training condition is given as a function of the id column's name."""
    return condition(alias)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per partition: entry, toxic texts and clean texts that have it, and hashes of the words that follow."""
    seen: dict[str, list] = {}
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic"), strict=True):
            words = folded(text.as_py()).split()
            found: dict[str, set] = {}
            for word, after in zip(words, [*words[1:], ""], strict=True):
                for entry in {f" {word} ", *(f" {word[:k]}" for k in BEGINNINGS if k <= len(word))}:
                    found.setdefault(entry, set()).add(after)
            for entry, followers in found.items():
                counts = seen.setdefault(entry, [0, 0, set()])
                counts[0 if toxic.as_py() else 1] += 1
                if toxic.as_py() and len(counts[2]) < LEAST_FOLLOWERS:
                    counts[2] |= followers
        if len(seen) > COUNTED_AT_ONCE:
            yield _counted(seen)
            seen = {}
    yield _counted(seen)


def _counted(seen: dict[str, list]) -> pa.RecordBatch:
    rows = [(e, t, c, sorted(f)[:LEAST_FOLLOWERS]) for e, (t, c, f) in seen.items()]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["entry", "toxic", "clean", "followers"])


def learn(sample: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS, entries: int = ENTRIES) -> Lexicon:
    """Lexicon and curve from the bounded sample of (id, text, toxic)."""
    # What one batch adds to the counts stays small; the session gets its own settings back.
    with session_settings(sample.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "64",
                                                "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}):
        return _learned(sample, exceptions, entries)


def _learned(sample: DataFrame, exceptions: tuple[str, ...], entries: int) -> Lexicon:
    spark = sample.sparkSession
    sample = sample.select("text", "toxic").repartition(2 * max(spark.sparkContext.defaultParallelism, 1))
    texts = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = texts.get(1, 0), texts.get(0, 0)
    if not toxic:
        return Lexicon({}, exceptions=exceptions)
    weight = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    counted = (
        sample.mapInArrow(_candidates, "entry string, toxic long, clean long, followers array<string>")
        .groupBy("entry")
        .agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"),
             F.size(F.array_distinct(F.flatten(F.collect_list(
                 F.when(F.size("followers") > 0, F.col("followers")))))).alias("followers"))
        .where((F.col("t") >= LEAST_TEXTS) & (F.col("followers") >= LEAST_FOLLOWERS))
        .withColumn("weight", weight).where(F.col("weight") >= LEAST_WEIGHT)
    )
    best = counted.orderBy(F.desc("weight"), F.length("entry"), "entry").limit(entries).collect()
    kept: dict[str, float] = {}
    better: dict[str, float] = {}  # the highest weight of a longer entry that has nearly all the toxic texts of a shorter one
    texts_of = {row["entry"]: row["t"] for row in best}
    for row in best:
        for k in range(2, len(row["entry"])):
            if 0.8 * texts_of.get(row["entry"][:k], math.inf) <= row["t"]:
                better[row["entry"][:k]] = max(better.get(row["entry"][:k], 0.0), row["weight"])
    for row in sorted(best, key=lambda r: (len(r["entry"]), r["entry"])):
        if better.get(row["entry"], 0.0) > row["weight"] + 1:
            continue
        covering = [kept[row["entry"][:k]] for k in range(2, len(row["entry"])) if row["entry"][:k] in kept]
        if not covering or row["weight"] > max(covering) + 3:
            kept[row["entry"]] = float(row["weight"])
    lexicon = Lexicon(kept, exceptions=exceptions)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [lexicon.features(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.float64()), pa.array([p[1] for p in pairs], pa.float64()),
                 batch.column("toxic").cast(pa.int64())], names=["a", "b", "toxic"])

    points = sample.mapInArrow(measured, "a double, b double, toxic long")
    grouped = points.groupBy(F.round("a", 2).alias("a"), F.round("b", 2).alias("b"), "toxic").count()
    lexicon.curve = _fit(sorted(tuple(r) for r in grouped.collect()))
    return lexicon


def _fit(points: list[tuple[float, float, int, int]], ridge: float = 0.1) -> tuple[float, float, float]:
    """Logistic regression on (a, b, label, count) by Newton's method; slopes below 0 are set to 0."""
    x = np.array([(1.0, a, b) for a, b, _, _ in points])
    y, n = np.array([p[2] for p in points], float), np.array([p[3] for p in points], float)
    w = np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (y - p)) - ridge * w
        hessian = (x * (n * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + ridge * np.eye(3)
        step = np.linalg.solve(hessian, gradient)
        w += step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
    return float(w[0]), float(max(w[1], 0.0)), float(max(w[2], 0.0))


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row, from its whole text alone."""
    small_batches(docs.sparkSession)
    schema = docs.select(id_col).schema.simpleString()[7:-1] + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([lexicon.score(t.as_py()) for t in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def without_toxic(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that score below the threshold, with all their columns."""
    small_batches(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array([lexicon.score(t.as_py()) < threshold for t in batch.column(place)], pa.bool_())
            yield batch.filter(keep)

    return docs.mapInArrow(run, docs.schema)
