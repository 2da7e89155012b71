"""Quality classifier: logistic regression over hashed word n-grams, trained
with follow-the-regularised-leader (FTRL-proximal) updates.

Features of a text: its words in lower case and pairs of them, and runs of one
to three word classes (lower case, capitalised, upper case, digits, a run of a
symbol, or the same word as the one before).  Each n-gram is hashed to one of
2**BITS coordinates; a coordinate's value is the share of the text's n-grams of
that family.  A score is the logistic function of one sparse dot product, so the
whole text counts, whatever its length.

Training takes every labelled row that is not held out.  They are written to the
shared folder, dealt into groups of about GROUP_ROWS by a hash of their place
there (repeated rows spread), and each group's task runs EPOCHS passes of FTRL
in an order that a hash of the text fixes.  The model is the mean of the groups'
weights by their rows: added up by coordinate in Spark, 2**BITS numbers at most.
There is no sample of rows.  A task reads its rows as they come and keeps their
feature vectors, not their texts.

The labels meet the documents by a broadcast where they are counted at no more
than BROADCAST_LABELS rows (16 bytes each), else by a shuffled join.

Cases: a null or empty text has no features and gets the score of the intercept
alone; rows without an id take no part in training and are not held out; repeated
rows and rows that share an id are scored one by one, and each labelled one is
learned; a text labelled both ways is learned both ways; null labels are left
out.  Without any labelled row the score is 0.5.  A long text is cut into words
in slices.  Other columns are never inputs; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import U64, mix
from .common import bound_batches, written

BITS = 18
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.0, 0.01
GROUP_ROWS = 16_384
BROADCAST_LABELS = 1_000_000
#: Distinct words a worker remembers; it starts anew beyond this.
CACHE_WORDS = 1_000_000
SLICE_CHARS = 1 << 20
TEXTS_AT_ONCE = 64
_WORD = re.compile(r"[^\W_]+|(?:([^\w\s]|_)\1*)")
#: Salts of the families: words, word pairs, classes, class pairs and triples.
_FAMILY = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9), U64(0x27D4EB2F165667C5), U64(0x85EBCA77C2B2AE63)]
_SAME = U64(7)


def _class(word: str) -> str:
    if word[0].isalnum():
        if word.isdigit():
            return f"9{min(len(word), 4)}"
        if word.islower():
            return "a"
        if word.isupper():
            return "AA" if len(word) > 1 else "A"
        return "Aa" if word[0].isupper() and word[1:].islower() else "aA"
    return word[:1] * min(len(word), 3)


def _hash(text: str) -> int:
    data = text.encode()
    return zlib.crc32(data) << 32 | zlib.crc32(data[::-1] + b"#")


class Features:
    """Texts as coordinates.  A worker hashes each distinct word once."""

    def __init__(self, bits: int = BITS):
        self.mask = U64((1 << bits) - 1)
        self._clear()

    def _clear(self):
        self.index: dict[str, int] = {}
        self.hashes: list[int] = []
        self.classes: list[int] = []
        self._arrays = np.zeros((2, 0), U64)

    def _numbers(self, words: list[str]) -> np.ndarray:
        index = self.index
        for w in dict.fromkeys(words):
            if w not in index:
                index[w] = len(self.hashes)
                self.hashes.append(_hash(w.lower()))
                self.classes.append(_hash(_class(w)))
        return np.fromiter(map(index.__getitem__, words), np.int64, len(words))

    def _words(self, text: str) -> np.ndarray:
        parts, at = [], 0
        while at < len(text):
            cut = len(text)
            if cut - at > SLICE_CHARS:
                space = text.find(" ", at + SLICE_CHARS)
                cut = space if space >= 0 else cut
            parts.append(self._numbers([m.group() for m in _WORD.finditer(text, at, cut)]))
            at = cut
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def of(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each family: (text, coordinate) of every n-gram."""
        if len(self.index) > CACHE_WORDS:
            self._clear()
        words = [self._words(t or "") for t in texts]
        if len(self.hashes) > self._arrays.shape[1]:
            new = slice(self._arrays.shape[1], None)
            self._arrays = np.concatenate([self._arrays, np.array([self.hashes[new], self.classes[new]], U64)], axis=1)
        doc = np.repeat(np.arange(len(texts)), [len(w) for w in words])
        number = np.concatenate(words) if words else np.zeros(0, np.int64)
        h, c = self._arrays[0][number], self._arrays[1][number].copy()
        if len(number):
            c[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])] = _SAME
        for values, n, salt in ((h, 1, _FAMILY[0]), (h, 2, _FAMILY[1]), (c, 1, _FAMILY[2]), (c, 2, _FAMILY[3]), (c, 3, _FAMILY[4])):
            m = max(len(values) - n + 1, 0)
            own = doc[:m] == doc[n - 1:n - 1 + m]
            total = np.full(m, salt, U64)
            for j in range(n):
                total = total * _FAMILY[0] + values[j:j + m]
            yield doc[:m][own], (mix(total[own]) & self.mask).astype(np.int64)

    def vectors(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(coordinates, values) of each text, coordinates distinct."""
        docs, places, shares = [], [], []
        for doc, place in self.of(texts):
            n = np.bincount(doc, minlength=len(texts))
            docs.append(doc)
            places.append(place)
            shares.append(1.0 / n[doc])
        key = np.concatenate(docs) * (int(self.mask) + 1) + np.concatenate(places)
        own, inverse = np.unique(key, return_inverse=True)
        value = np.bincount(inverse, weights=np.concatenate(shares), minlength=len(own))
        doc, place = np.divmod(own, int(self.mask) + 1)
        at = np.searchsorted(doc, np.arange(len(texts) + 1))
        return [(place[i:j], value[i:j]) for i, j in zip(at, at[1:])]

    def dot(self, texts: list[str | None], weights: np.ndarray) -> np.ndarray:
        """The dot product of each text's vector with ``weights``."""
        total = np.zeros(len(texts))
        for doc, place in self.of(texts):
            n = np.bincount(doc, minlength=len(texts))
            total += np.bincount(doc, weights=weights[place], minlength=len(texts)) / np.maximum(n, 1)
        return total


class Ftrl:
    """FTRL-proximal for logistic loss; the last coordinate is the intercept."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def _at(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) > L1, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, place: np.ndarray, value: np.ndarray, label: float) -> None:
        place, value = np.append(place, len(self.z) - 1), np.append(value, 1.0)
        z, n = self.z[place], self.n[place]
        w = self._at(z, n)
        g = (logistic(w @ value) - label) * value
        grown = n + g * g
        self.z[place] = z + g - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * w
        self.n[place] = grown

    def weights(self) -> np.ndarray:
        return self._at(self.z, self.n)


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def _held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _train(bits: int, epochs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, rows = Features(bits), []
        for batch in batches:
            texts, labels = batch.column("text").to_pylist(), batch.column("label").to_pylist()
            for i in range(0, len(texts), TEXTS_AT_ONCE):
                some = texts[i:i + TEXTS_AT_ONCE]
                rows += [(zlib.crc32((t or "").encode()), y, place.astype(np.int32), value.astype(np.float32))
                         for t, y, (place, value) in zip(some, labels[i:i + TEXTS_AT_ONCE], features.vectors(some))]
        # the order does not depend on how the rows came
        rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
        model = Ftrl(1 << bits)
        for epoch in range(epochs):
            for i in np.random.default_rng(epoch).permutation(len(rows)).tolist():
                _, label, place, value = rows[i]
                model.learn(place, value.astype(np.float64), label)
        w = model.weights()
        some = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(w[some] * len(rows), pa.float64())], names=["place", "w"])
    return run


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", bits: int = BITS, epochs: int = EPOCHS, group_rows: int = GROUP_ROWS) -> np.ndarray:
    """The weights (2**bits and the intercept) learned from the rows of
    ``labels`` (doc_id, ``label`` 0 or 1) that are not held out."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("double").alias("label")).dropna()
    known = known.where(~F.coalesce(F.pmod(F.crc32(F.col("__id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(True)))
    if labels.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    rows = written(docs.select("doc_id", F.col("text").cast("string")).join(known, F.col("doc_id") == F.col("__id")).select("text", "label"), "classify-rows")
    n = rows.count()
    weights = np.zeros((1 << bits) + 1)
    if n:
        groups = -(-n // group_rows)
        dealt = bound_batches(rows).withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
        learned = dealt.groupBy("part").applyInArrow(_grouped(bits, epochs), "place long, w double")
        # at most 2**bits rows
        for place, w in learned.groupBy("place").agg(F.sum("w")).collect():
            weights[place] = w / n
    return weights


def _grouped(bits: int, epochs: int):
    run = _train(bits, epochs)

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(batches)
    # Spark reads the kind of function from its hints
    group.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return group


OUT = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs``; no shuffle."""
    bits = (len(weights) - 1).bit_length() - 1
    learned, intercept = weights[:-1].astype(np.float64), float(weights[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(bits)
        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(i, TEXTS_AT_ONCE)
                p = logistic(features.dot(some.column("text").to_pylist(), learned) + intercept)
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("held_out"), pa.array(p, pa.float64()),
                                                  pa.array(p >= 0.5).cast(pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    given = bound_batches(docs).select(F.col("doc_id").cast("long"), _held_out().alias("held_out"), F.col("text").cast("string"))
    return given.mapInArrow(run, OUT)


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    return score(docs, train(docs, labels, label))
