"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of WINDOW consecutive words (an item of fewer is
one window).  A window is the set of its shingles of SHINGLE words.  The
shingles of all windows are counted over the whole corpus and ordered by
rarity; a window that a text contains must have every shingle there, so its
rarest one is a necessary prefix of length one.  The join looks up only prefix
shingles; a match fixes where the window would begin, the length bound drops
windows that would leave the text, and the words of what is left are compared
in full.

The benchmark is the query set: it is cut into blocks of at most BLOCK_WINDOWS
windows, each block is broadcast (its size is that bound) and joined with all
documents, and the hits of several blocks are merged by id and text.

Cases: a null or empty text or item has no words, no windows and no hits;
items without an id count as the empty id, repeated items once; each row of
documents gives one row, also where rows repeat, share an id or have none (a
null id is kept); other columns are not looked at; an empty benchmark hits
nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .arrays import LOWER, NOT_ALNUM, U64, Words, blocks, utf8
from .common import BLOCK_BYTES, bound_batches, written

WINDOW = 10
SHINGLE = 3
#: Windows of one broadcast block: about 200 bytes each.
BLOCK_WINDOWS = 200_000
SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def windows_of(item_id, text: str | None) -> list[tuple]:
    """(item_id, words as bytes) of each window of an item."""
    data = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    found = Words(data, np.array([0, len(data)]), NOT_ALNUM)
    raw = data.tobytes()
    words = [raw[a:b] for a, b in zip(found.start.tolist(), found.end.tolist())]
    if not words:
        return []
    return [(item_id, tuple(words[i:i + WINDOW])) for i in range(max(1, len(words) - WINDOW + 1))]


def word_hashes(words: tuple) -> np.ndarray:
    data = np.frombuffer(b"\0".join(words), np.uint8)
    return Words(data, np.array([0, len(data)]), NOT_ALNUM).hash


class Block:
    """The windows of one block, with the prefix shingle of each."""

    def __init__(self, windows: list[tuple]):
        by_words: dict[tuple, set] = {}
        for item, words in windows:
            by_words.setdefault(words, set()).add(item)
        self.words = list(by_words)
        self.items = [sorted(by_words[w], key=str) for w in self.words]
        self.hashes = [word_hashes(w) for w in self.words]
        # the shingles of each window, by how many words they take
        self.shingles = []
        for h in self.hashes:
            size = min(SHINGLE, len(h))
            held = _bare(h)
            at, key = held.grams(size)
            self.shingles.append((size, key))
        self.vocabulary = {size: np.unique(np.concatenate([k for s, k in self.shingles if s == size]))
                           for size in {s for s, _ in self.shingles}}

    def order(self, counts: dict[tuple[int, int], int]) -> None:
        """Fix each window's prefix: its shingle with the lowest count."""
        table: dict[int, list[tuple]] = {}
        for w, (size, key) in enumerate(self.shingles):
            rarity = [(counts.get((size, int(k)), 0), int(k)) for k in key]
            at = min(range(len(key)), key=rarity.__getitem__)
            table.setdefault(size, []).append((int(key[at]), at, w))
        self.prefix = {}
        for size, rows in table.items():
            rows.sort()
            self.prefix[size] = (np.array([r[0] for r in rows], U64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
        # words of every window in one array, for the full comparison
        self.length = np.array([len(h) for h in self.hashes])
        self.matrix = np.zeros((len(self.hashes), int(self.length.max())), U64)
        for i, h in enumerate(self.hashes):
            self.matrix[i, :len(h)] = h


def _bare(hashes: np.ndarray) -> Words:
    w = object.__new__(Words)
    w.hash, w.doc = hashes, np.zeros(len(hashes), np.int64)
    return w


def _members(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which ``keys`` are in the sorted ``table``, and the first place."""
    # most keys are in no window: a bit table of the low bits drops them first
    low = U64((1 << 16) - 1)
    seen = np.zeros(1 << 16, bool)
    seen[table & low] = True
    maybe = np.flatnonzero(seen[keys & low])
    place = np.searchsorted(table, keys[maybe])
    place[place == len(table)] = 0
    hit = table[place] == keys[maybe]
    return maybe[hit], place[hit]


def _block_texts(batch, text_col):
    data, off = utf8(batch.column(text_col))
    for i, j in blocks(off, BLOCK_BYTES):
        part, at = LOWER[data[off[i]:off[j]]], off[i:j + 1] - off[i]
        yield i, j, part, Words(part, at, NOT_ALNUM)


def shingle_counts(docs: DataFrame, text_col: str, sent) -> dict[tuple[int, int], int]:
    """Occurrences in all documents of each shingle that a window holds."""
    def run(batches):
        sizes = sent.value.vocabulary
        total = {s: np.zeros(len(v), np.int64) for s, v in sizes.items()}
        for batch in batches:
            for _, _, _, words in _block_texts(batch, text_col):
                for s, v in sizes.items():
                    _, place = _members(words.grams(s)[1], v)
                    total[s] += np.bincount(place, minlength=len(v))
        for s, v in sizes.items():
            some = np.flatnonzero(total[s])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), s)), pa.array(v[some].view(np.int64)), pa.array(total[s][some])], ["size", "key", "n"])

    # at most the block's own shingles come back
    rows = docs.select(text_col).mapInArrow(run, "size long, key long, n long").groupBy("size", "key").agg(F.sum("n").alias("n")).collect()
    return {(r["size"], r["key"] & 0xFFFFFFFFFFFFFFFF): r["n"] for r in rows}


def find(block: Block, words: Words, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of each occurrence of a window in a block of texts."""
    firsts, found = [], []
    n = len(words.hash)
    for size, (keys, offset, window) in block.prefix.items():
        at, grams = words.grams(size)
        hit, place = _members(grams, keys)
        last = np.searchsorted(keys, grams[hit], "right")
        times = last - place                                # windows that share the prefix
        at = np.repeat(at[hit], times)
        row = np.repeat(place, times) + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
        w = window[row]
        begin, size_w = at - offset[row], block.length[w]
        # positional and length bound: the window must lie inside one text
        fits = (begin >= 0) & (begin + size_w <= n)
        begin, w, size_w = begin[fits], w[fits], size_w[fits]
        fits = words.doc[begin] == words.doc[begin + size_w - 1]
        begin, w, size_w = begin[fits], w[fits], size_w[fits]
        equal = np.ones(len(w), bool)
        for k in range(block.matrix.shape[1]):
            inside = k < size_w
            equal &= ~inside | (words.hash[np.minimum(begin + k, n - 1)] == block.matrix[w, k])
        for b, x in zip(begin[equal].tolist(), w[equal].tolist()):
            # the words themselves, not only their hashes
            if all(text[words.start[b + k]:words.end[b + k]] == v for k, v in enumerate(block.words[x])):
                firsts.append(b)
                found.append(x)
    return np.array(firsts, np.int64), np.array(found, np.int64)


def _digest(items: list) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def _hits(block: Block, part: np.ndarray, words: Words):
    """Of each text of a block with an occurrence: hit words and item ids."""
    begin, window = find(block, words, part.tobytes())
    edge = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + block.length[window], -1)
    hit = np.cumsum(edge)[:-1] > 0
    items: dict[int, set] = {}
    for d, x in zip(words.doc[begin].tolist(), window.tolist()):
        items.setdefault(d, set()).update(block.items[x])
    return hit, items


def benchmark_blocks(spark: SparkSession, benchmark: DataFrame, docs: DataFrame, text_col: str,
                     item_col: str, item_text: str) -> list:
    """Broadcast blocks of windows, each ordered by the corpus's rarity."""
    out, held = [], []

    def close():
        if held:
            block = Block(held)
            first = spark.sparkContext.broadcast(block)
            block.order(shingle_counts(docs, text_col, first))
            out.append(spark.sparkContext.broadcast(block))
            held.clear()

    # the query set is read item by item; one block is held at a time
    for row in benchmark.select(item_col, item_text).distinct().toLocalIterator():
        for window in windows_of(row[0], row[1]):
            held.append(window)
            if len(held) >= BLOCK_WINDOWS:
                close()
    close()
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: its words, hit words and items."""
    spark = docs.sparkSession
    benchmark = benchmark.withColumn(item_col, F.coalesce(F.col(item_col).cast("string"), F.lit("")))
    bound_batches(docs)
    found = benchmark_blocks(spark, benchmark, docs, text_col, item_col, item_text)
    if len(found) > 1:
        return _merged(docs, found, id_col, text_col)
    block = found[0] if found else None

    def run(batches):
        for batch in batches:
            ids = batch.column(id_col).cast(pa.int64())
            for i, j, part, words in _block_texts(batch, text_col):
                n = j - i
                hit, items = _hits(block.value, part, words) if block is not None else (np.zeros(len(words.hash), bool), {})
                n_hit = np.bincount(words.doc[hit], minlength=n)
                named = [sorted(items.get(d, ())) for d in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, n), pa.array(np.diff(words.first).astype(np.int64)), pa.array(n_hit.astype(np.int64)),
                     pa.array([len(x) for x in named], pa.int64()), pa.array([_digest(x) for x in named]), pa.array(n_hit > 0)],
                    ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return docs.select(id_col, text_col).mapInArrow(run, SCHEMA)


def _merged(docs: DataFrame, found: list, id_col: str, text_col: str) -> DataFrame:
    """The blocks' hits merged by id and text, and joined to every row that
    has them: equal rows have equal hits, so each keeps its own result."""
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    keyed = docs.select(F.md5(F.concat(ident, F.lit("\0"), F.coalesce(F.col(text_col), F.lit("")))).alias("__key"), id_col, text_col)

    def scan(block, first):
        def run(batches):
            for batch in batches:
                ids, keys = batch.column(id_col).cast(pa.int64()), batch.column("__key")
                for i, j, part, words in _block_texts(batch, text_col):
                    hit, items = _hits(block.value, part, words)
                    counts = np.diff(words.first)
                    for d in range(j - i):
                        own = hit[words.first[d]:words.first[d + 1]]
                        if first or own.any():
                            yield pa.RecordBatch.from_arrays(
                                [keys.slice(i + d, 1), ids.slice(i + d, 1), pa.array([counts[d]], pa.int64()), pa.array([np.flatnonzero(own)], pa.list_(pa.int64())),
                                 pa.array([sorted(items.get(d, ()))], pa.list_(pa.string()))], ["key", "doc_id", "n_words", "at", "items"])
        return keyed.mapInArrow(run, "key string, doc_id long, n_words long, at array<long>, items array<string>")

    parts = [written(scan(b, k == 0), "leaks") for k, b in enumerate(found)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    # rows that repeat give one and the same array a block
    by_key = union.where(F.size("at") > 0).groupBy("key").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("at")))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    rows = parts[0].select("key", "doc_id", "n_words").join(by_key, "key", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                       F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents without any hit, with all their columns.  Each block of
    the benchmark filters what the block before it left: no shuffle."""
    bound_batches(docs)
    benchmark = benchmark.withColumn(item_col, F.coalesce(F.col(item_col).cast("string"), F.lit("")))
    out = docs
    for block in benchmark_blocks(docs.sparkSession, benchmark, docs, text_col, item_col, item_text):
        def run(batches, block=block):
            for batch in batches:
                for i, j, part, words in _block_texts(batch, text_col):
                    hit, _ = _hits(block.value, part, words)
                    clean = np.bincount(words.doc[hit], minlength=j - i) == 0
                    yield batch.slice(i, j - i).filter(pa.array(clean))
        out = out.mapInArrow(run, docs.schema)
    return out
