"""Toxicity: a counterfactual-regularised classifier.

Features of a text are its distinct words and their beginnings (4 and 5 letters). Training keeps the features whose
log odds differ significantly between the classes, scales each by its log ratio, and fits a logistic regression with
an extra penalty: identity terms of a labelled text are swapped for others of their group, and the squared change of
the logit is added to the loss, so that a mention of a group does not move the score.

The fit takes MAX_ROWS labelled texts at most (the smallest by a hash of doc_id, whole texts), so the one task that
fits holds a bounded number of rows and the driver its weights only; scoring runs over every row, one word at a time through a bounded cache.

Defined cases: null and empty texts score the bias; very long texts are scored whole, by their distinct words; a score
of exactly 0.5 is predicted 1; rows of equal hash are taken by doc_id; repeated texts score alike; doc_ids with conflicting or null labels are not trained on, nor
are null doc_ids; repeated labels count once; without labels of both classes every score is that of the one class, or 0.0 without labels; score and predicted replace columns of that name, other columns stay; an empty table gives an
empty table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwise.llm.memory import released

#: Labelled rows that a fit takes at most.
MAX_ROWS = 20_000
#: Terms that are swapped for each other, group by group.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"), ("she", "he"), ("her", "his"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"), ("black", "white", "asian", "latino"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("immigrant", "citizen", "refugee"), ("immigrants", "citizens", "refugees"), ("disabled", "able"), ("old", "young"),
    ("mujeres", "hombres"), ("frauen", "männer"), ("femmes", "hommes"),
)
SWAP = {term: group[(i + 1) % len(group)] for group in IDENTITY_GROUPS for i, term in enumerate(group)}
WORD = re.compile(r"\w+")
LEAST_DOCS, LEAST_Z, STEPS, RIDGE, FAIRNESS = 3, 2.0, 150, 1e-3, 1.0
CACHE = 150_000


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def features_of(word: str) -> tuple[str, ...]:
    """The word and its beginnings; a beginning ends in a mark that no word holds."""
    return (word, *(f"{word[:n]}*" for n in (4, 5) if len(word) > n))


class Model:
    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.kept: dict[str, float] = {}

    def __getstate__(self) -> tuple:
        return self.weights, self.bias

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def score(self, text: str | None) -> float:
        kept, total = self.kept, self.bias
        for w in words_of(text):
            if (x := kept.get(w)) is None:
                if len(kept) >= CACHE:
                    kept.clear()
                x = kept[w] = sum(self.weights.get(f, 0.0) for f in features_of(w))
            total += x
        return 0.0 if total <= -500 else 1 / (1 + math.exp(-total))


class _Numbered:
    """Features of texts as numbers: texts are let go at once, so memory follows the distinct words and the counts."""

    def __init__(self):
        self.features: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self.of_word: list[tuple[int, ...]] = []

    def counts(self, words: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers and how many of the words have each."""
        found: list[int] = []
        for w in words:
            if (k := self.words.get(w)) is None:
                k = self.words[w] = len(self.of_word)
                self.of_word.append(tuple(self.features.setdefault(f, len(self.features)) for f in features_of(w)))
            found.extend(self.of_word[k])
        number, count = np.unique(np.array(found, np.int32), return_counts=True)
        return number, count.astype(np.float32)


def _sparse(rows: list[tuple[np.ndarray, np.ndarray]], index: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and scaled value of the features that have an index."""
    row, col, val = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, np.float32)]
    for i, (number, count) in enumerate(rows):
        at = index[number]
        kept = at >= 0
        row.append(np.full(int(kept.sum()), i, np.int32))
        col.append(at[kept])
        val.append((count[kept] * scale[at[kept]]).astype(np.float32))
    return np.concatenate(row), np.concatenate(col), np.concatenate(val)


def fit(texts: Iterable[str | None], toxic: list[int], fairness: float = FAIRNESS) -> Model:
    """A model of labelled texts; fairness is the weight of the counterfactual penalty."""
    numbered, rows, changes = _Numbered(), [], []
    for text in texts:
        words = words_of(text)
        rows.append(numbered.counts(sorted(words)))
        if words & SWAP.keys():
            n, c = numbered.counts(sorted({SWAP.get(x, x) for x in words}))
            changes.append((np.concatenate((n, rows[-1][0])), np.concatenate((c, -rows[-1][1]))))

    y = np.array(toxic, float)  # read after the texts, which may fill it
    if not len(y) or y.min() == y.max():
        return Model({}, 500.0 if len(y) and y[0] else -500.0)
    size = len(numbered.features)
    n_one, n_zero = y.sum(), len(y) - y.sum()
    one = np.zeros(size)
    zero = np.zeros(size)
    for (number, _), label in zip(rows, toxic, strict=True):
        (one if label else zero)[number] += 1
    enough = one + zero >= LEAST_DOCS
    one, zero = one + 0.5, zero + 0.5
    ratio = np.log(one / (n_one + 1) / (zero / (n_zero + 1)))
    named = np.array([f in SWAP for f in numbered.features])
    chosen = np.flatnonzero(enough & (named | (np.abs(ratio) >= LEAST_Z * np.sqrt(1 / one + 1 / zero))))
    index = np.full(size, -1, np.int32)
    index[chosen] = np.arange(len(chosen))
    scale = ratio[chosen]
    row, col, val = _sparse(rows, index, scale)
    c_row, c_col, c_val = _sparse(changes, index, scale)
    del rows

    weight, bias = np.zeros(len(chosen)), math.log(n_one / n_zero)
    mean, power, b_mean, b_power = np.zeros(len(chosen)), np.zeros(len(chosen)), 0.0, 0.0
    for step in range(1, STEPS + 1):  # Adam on all rows
        z = np.bincount(row, val * weight[col], len(y)) + bias
        error = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
        grad = np.bincount(col, val * error[row], len(chosen)) / len(y) + RIDGE * weight
        if changes:
            moved = np.bincount(c_row, c_val * weight[c_col], len(changes))
            grad += fairness * np.bincount(c_col, c_val * moved[c_row], len(chosen)) / len(changes)
        mean, power = 0.9 * mean + 0.1 * grad, 0.999 * power + 0.001 * grad**2
        b_mean, b_power = 0.9 * b_mean + 0.1 * error.mean(), 0.999 * b_power + 0.001 * error.mean() ** 2
        rate = 0.1 * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        weight -= rate * mean / (np.sqrt(power) + 1e-8)
        bias -= rate * b_mean / (math.sqrt(b_power) + 1e-8)
    names = list(numbered.features)
    return Model({names[k]: float(w * s) for k, w, s in zip(chosen, weight, scale, strict=True) if w}, float(bias))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on labelled documents that are not held out."""
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("label"), F.max("toxic").alias("other"))
        .where("label = other")
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).select("doc_id", "label")
    # max_rows ids and labels at most are broadcast, so texts are read without a shuffle
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    distinct = rows.mapInArrow(released(_distinct_words), "doc_id long, label int, words string").groupBy("doc_id").agg(F.min(F.struct("label", "words")).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic: list[int] = []

        def texts() -> Iterator[str]:
            for b in batches:
                toxic.extend(b.column(0).to_pylist())
                yield from (w.as_py() for w in b.column(1))

        model = fit(texts(), toxic)
        weights = list(model.weights.items())
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in weights] + [None], pa.string()), pa.array([w for _, w in weights] + [model.bias], pa.float64())], ["feature", "weight"])

    # one task holds max_rows rows at most; the driver gets the weights
    weights = distinct.select("doc_id", "x.label", "x.words").coalesce(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").select("label", "words").mapInArrow(released(run), "feature string, weight double").toArrow()
    found = dict(zip(weights.column(0).to_pylist(), weights.column(1).to_pylist(), strict=True))
    return Model(found, found.pop(None, -500.0))


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), pa.array([" ".join(sorted(words_of(t))) for t in b.column("text").to_pylist()], pa.string())], ["doc_id", "label", "words"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score and predicted."""
    docs = docs.drop("score", "predicted")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = np.array([shared.value.score(t.as_py()) for t in b.column(at)], np.float64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], [*b.schema.names, "score", "predicted"])

    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.mapInArrow(released(run, lambda: shared.value.kept.clear()), schema)
