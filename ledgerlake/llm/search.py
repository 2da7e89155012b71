"""Ranked lexical search: a sharded inverted index read by Block-Max MaxScore.

``build_index`` cuts every input partition into shards of about SHARD_BYTES of
text.  A shard numbers its documents by length, shortest first, so that a block
of postings holds documents of like length.  Its terms become rows (shard,
term) with postings in blocks of BLOCK (variable-byte document gaps and counts)
and, uncompressed beside them, each block's last document, largest count and
smallest document length: with these the block's highest possible score is
known for any corpus statistics.

``search`` joins the terms of the queries with the index rows by term.  Queries
are dealt into blocks of QUERY_BLOCK; a (query block, shard) group gets only
those lists that its queries name, so it is bounded by the shard's size.  For
each query the group keeps a heap of the k best.  Lists are ordered by their
highest possible score.  Those whose bounds together cannot reach the heap's
least score are non-essential: candidates come from the other (essential) lists
only.  A candidate's score so far plus the block maxima of the non-essential
lists decides whether it is rejected before any of their blocks is
decompressed.  The heap starts from the documents of the lists with the highest
bounds, scored in full; a list that several queries of a group read whole is
decompressed once.  Shard heaps are merged by a rank window that keeps k rows of a query
before they are shuffled.

The statistics (documents with a term, terms, documents of a term) are counted
over the whole index.  The driver gets two numbers; nothing is broadcast by
hand.  All scores are 64-bit integers.

Cases: a null or empty text, or one without terms, is no document; a query
without terms has no rows.  A long text is a shard of its own, its terms taken
from slices.  Equal scores go by ascending doc_id, rows without an id last;
repeated rows and rows that share an id are ranked one by one; rows of the query
table that share an id are searched one by one and ranked together, the rank
still unique.  Other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import bound_batches, written

SHARD_BYTES = 16 << 20
BLOCK = 64
QUERY_BLOCK = 256
SLICE_CHARS = 1 << 20
#: Terms: maximal runs of 0-9, a-z and all beyond ASCII, A-Z lower-cased.
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_FOLD = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))
_TERM_END = re.compile("[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")


def terms_of(text: str | None) -> Iterator[list[str]]:
    """The terms of a text in order, a list for each slice."""
    at, text = 0, text or ""
    while at < len(text):
        cut = len(text)
        if cut - at > SLICE_CHARS:
            found = _TERM_END.search(text, at + SLICE_CHARS)
            cut = found.start() if found else cut
        yield TERM.findall(text[at:cut].encode().translate(_FOLD).decode())
        at = cut


# ---- variable-byte coding ---------------------------------------------------------------
def vbyte(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, length of each): seven bits a byte, the last one marked."""
    lens = np.ones(len(values), np.int64)
    for k in range(1, 9):
        lens += values >> (7 * k) > 0
    at = np.cumsum(lens) - lens
    out = np.zeros(int(lens.sum()), np.uint8)
    for k in range(int(lens.max()) if len(lens) else 0):
        has = lens > k
        out[at[has] + k] = (values[has] >> (7 * k)) & 0x7F
    out[at + lens - 1] |= 0x80
    return out, lens


def unvbyte(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data & 0x80)
    first = np.append(0, last[:-1] + 1)
    step = np.arange(len(data)) - np.repeat(first, last - first + 1)
    return np.add.reduceat((data & 0x7F).astype(np.int64) << (7 * step), first) if len(last) else np.zeros(0, np.int64)


# ---- index -----------------------------------------------------------------------------
#: kind 0: a shard's documents (ids and lengths); kind 1: a term's postings.
INDEX = pa.schema([("shard", pa.int64()), ("kind", pa.int32()), ("term", pa.string()), ("df", pa.int64()), ("postings", pa.binary()),
                   ("block_bytes", pa.list_(pa.int32())), ("block_last", pa.list_(pa.int32())), ("block_tf", pa.list_(pa.int32())),
                   ("block_n", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))])
INDEX_COLUMNS = ("shard long, kind int, term string, df long, postings binary, block_bytes array<int>, block_last array<int>,"
                 "block_tf array<int>, block_n array<int>, doc_ids array<long>, lengths array<long>")
OUT_TERMS = 20_000


def _shard_rows(number: int, ids: list, lengths: list[int], words: list[np.ndarray], names: list[str], block: int) -> Iterator[pa.RecordBatch]:
    """``words``: of each document the numbers of its terms in ``names``."""
    n = np.array(lengths, np.int64)
    order = np.argsort(n, kind="stable")
    place = np.empty(len(n), np.int64)
    place[order] = np.arange(len(n))
    none = pa.nulls(1, pa.list_(pa.int32()))
    ids = [ids[i] for i in order]
    n = n[order]
    yield pa.RecordBatch.from_arrays([
        pa.array([number]), pa.array([0], pa.int32()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), none, none, none, none,
        pa.array([ids], pa.list_(pa.int64())), pa.array([n.tolist()], pa.list_(pa.int64()))], schema=INDEX)
    key = np.concatenate(words).astype(np.int64) * len(n) + np.repeat(place, lengths)
    key.sort()
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    tf = np.diff(np.append(first, len(key)))
    term, doc = np.divmod(key[first], len(n))
    head = np.flatnonzero(np.append(True, term[1:] != term[:-1]))       # of each term, its first posting
    df = np.diff(np.append(head, len(term)))
    gap = np.diff(doc, prepend=0)
    nth = np.arange(len(doc)) - np.repeat(head, df)
    start = np.flatnonzero(nth % block == 0)                             # of each block
    gap[start] = doc[start]                                              # a block is read without the one before
    pair = np.empty(2 * len(doc), np.int64)
    pair[::2], pair[1::2] = gap, tf - 1
    data, lens = vbyte(pair)
    bytes_of = np.add.reduceat(lens, 2 * start)
    last = np.append(start[1:], len(doc)) - 1
    block_tf, block_n = np.maximum.reduceat(tf, start), n[doc[start]]    # documents go by length
    blocks = -(-df // block)
    at = np.append(0, np.cumsum(blocks))
    byte_at = np.append(0, np.cumsum(np.add.reduceat(bytes_of, at[:-1])))
    raw = data.tobytes()
    for i in range(0, len(df), OUT_TERMS):
        j = min(i + OUT_TERMS, len(df))
        p, q = at[i], at[j]
        ragged = lambda v: pa.ListArray.from_arrays(pa.array(at[i:j + 1] - p, pa.int32()), pa.array(v[p:q], pa.int32()))
        m = j - i
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(m, number)), pa.array(np.ones(m, np.int32)), pa.array([names[t] for t in term[head[i:j]]], pa.string()),
            pa.array(df[i:j], pa.int64()), pa.array([raw[byte_at[x]:byte_at[x + 1]] for x in range(i, j)], pa.binary()),
            ragged(bytes_of), ragged(doc[last]), ragged(block_tf), ragged(block_n),
            pa.nulls(m, pa.list_(pa.int64())), pa.nulls(m, pa.list_(pa.int64()))], schema=INDEX)


def _indexer(shard_bytes: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, lengths, words, size = [], [], [], 0
        numbers = defaultdict(count().__next__)

        def close():
            yield from _shard_rows(number, ids, lengths, words, list(numbers), block)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                got = [np.fromiter(map(numbers.__getitem__, some), np.int32, len(some)) for some in terms_of(text)]
                n = sum(map(len, got))
                if not n:
                    continue
                ids.append(doc_id)
                lengths.append(n)
                words += got
                size += len(text)
                if size >= shard_bytes:
                    yield from close()
                    number, size = number + 1, 0
                    ids, lengths, words, numbers = [], [], [], defaultdict(count().__next__)
        if ids:
            yield from close()
    return run


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES, block: int = BLOCK) -> DataFrame:
    """The index of ``docs`` (doc_id, text), written to the shared folder."""
    given = bound_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return written(given.mapInArrow(_indexer(shard_bytes, block), INDEX_COLUMNS), "search-index")


# ---- search ----------------------------------------------------------------------------
class Postings:
    """A term's postings in one shard; impacts are scores before the weight."""

    def __init__(self, data, block_bytes, block_last, block_tf, block_n, m: np.ndarray, m_of):
        self.data, self.m = np.frombuffer(data, np.uint8), m
        self.byte_at = np.append(0, np.cumsum(block_bytes))
        self.last = np.asarray(block_last, np.int64)
        self.bound = np.append(_impact(np.asarray(block_tf, np.int64), m_of(np.asarray(block_n, np.int64))), 0)
        self.most = int(self.bound.max())
        self._whole: tuple[np.ndarray, np.ndarray] | None = None

    def read(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, impacts) of ascending ``blocks``, decompressed."""
        if not len(blocks):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sizes = self.byte_at[blocks + 1] - self.byte_at[blocks]
        if blocks[-1] - blocks[0] + 1 == len(blocks):
            data = self.data[self.byte_at[blocks[0]]:self.byte_at[blocks[-1] + 1]]
        else:
            data = np.concatenate([self.data[self.byte_at[b]:self.byte_at[b + 1]] for b in blocks.tolist()])
        # a posting is two numbers; the first gap of a block is the document itself
        values = unvbyte(data)
        doc, tf = np.cumsum(values[::2]), values[1::2] + 1
        if len(blocks) > 1:
            ends = np.cumsum(np.add.reduceat((data >> 7).astype(np.int64), np.cumsum(sizes) - sizes)) // 2
            doc -= np.repeat(np.append(0, doc[ends[:-1] - 1]), np.diff(ends, prepend=0))
        return doc, _impact(tf, self.m[doc])

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        if self._whole is None:
            self._whole = self.read(np.arange(len(self.last)))
        return self._whole

    def block_of(self, doc: np.ndarray) -> np.ndarray:
        """The block that would hold each document; the number of blocks for none."""
        return np.searchsorted(self.last, doc, "left")

    def at(self, doc: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Impacts of ascending documents, 0 for those without the term; only
        blocks that may hold one are decompressed."""
        need = np.unique(block[block < len(self.last)])
        if self._whole is not None or 2 * len(need) > len(self.last):
            found, impact = self.whole()
        else:
            found, impact = self.read(need)
        j = np.searchsorted(found, doc)
        hit = j < len(found)
        hit[hit] = found[j[hit]] == doc[hit]
        out = np.zeros(len(doc), np.int64)
        out[hit] = impact[j[hit]]
        return out


def _impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def best_of_shard(lists: list[tuple[int, Postings]], ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the k best documents, by score and then id.

    ``lists``: (weight times repeats, postings) of the query's terms; ``ids``:
    the rank of each document by id."""
    lists = sorted(lists, key=lambda x: x[0] * x[1].most)
    upto = np.cumsum([w * p.most for w, p in lists])            # what the first lists can give together
    total, held = np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)

    def take(i: int) -> None:
        doc, impact = lists[i][1].whole()
        total[doc] += lists[i][0] * impact
        held[doc] = True

    # the heap starts from the lists with the highest bounds
    rest, least = len(lists), 0
    while rest and np.count_nonzero(held) < k:
        rest -= 1
        take(rest)
    some = np.flatnonzero(held)
    if len(some) >= k:
        some = np.sort(some[np.argpartition(-total[some], k - 1)[:k]])
        least = int((total[some] + sum((w * p.at(some, p.block_of(some)) for w, p in lists[:rest]), np.zeros(k, np.int64))).min())
    # a document that only equals the least score can still come first by its id
    least = max(least, 1)
    essential = int(np.searchsorted(upto, least, "left"))
    while rest > essential:
        rest -= 1
        take(rest)
    doc = np.flatnonzero(held)
    score = total[doc]
    # block maxima of the non-essential lists, before anything of them is read
    blocks = [p.block_of(doc) for _, p in lists[:rest]]
    highest = [w * p.bound[b] for (w, p), b in zip(lists, blocks)]
    ahead = np.sum(highest, axis=0) if highest else np.zeros(len(doc), np.int64)
    for i in range(rest - 1, -1, -1):
        alive = score + ahead >= least
        if not alive.all():
            doc, score, ahead = doc[alive], score[alive], ahead[alive]
            blocks, highest = [b[alive] for b in blocks[:i + 1]], [h[alive] for h in highest[:i + 1]]
        if not len(doc):
            break
        w, p = lists[i]
        score = score + w * p.at(doc, blocks[i])
        ahead = ahead - highest[i]
    best = np.lexsort((ids[doc], -score))[:k]
    best = best[score[best] > 0]
    return doc[best], score[best]


HITS = "q long, item_id string, doc_id long, score long"


def _searcher(docs: int, length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def m_of(n):
            return 100 - 75 + (75 * n * docs) // length

        for batch in batches:
            for row in batch.to_pylist():
                n = np.array(row["lengths"], np.int64)
                m = m_of(n)
                # by ascending id, rows without one last
                rank = np.empty(len(n), np.int64)
                rank[sorted(range(len(n)), key=lambda i: (row["doc_ids"][i] is None, row["doc_ids"][i] or 0))] = np.arange(len(n))
                queries = defaultdict(list)
                for t in row["lists"]:
                    postings = Postings(t["postings"], t["block_bytes"], t["block_last"], t["block_tf"], t["block_n"], m, m_of)
                    for use in t["uses"] if t["w"] else ():
                        queries[(use["q"], use["item_id"])].append((t["w"] * use["times"], postings))
                out = [(q, item, row["doc_ids"][p], s) for (q, item), lists in queries.items()
                       for p, s in zip(*(x.tolist() for x in best_of_shard(lists, rank, k)))]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                                                     names=["q", "item_id", "doc_id", "score"])
    return run


QUERY_TERMS = "q long, item_id string, term string"


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(q, item, t) for q, item, text in zip(*(c.to_pylist() for c in batch.columns)) for some in terms_of(text) for t in some]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))],
                                             names=["q", "item_id", "term"])


def search(index: DataFrame, queries: DataFrame, k: int = 10, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` best documents of ``index`` for each row of ``queries``
    (item_id, text): item_id, rank, doc_id, score."""
    spark = index.sparkSession
    shards = index.where("kind = 0").select("shard", "doc_ids", "lengths")
    stats = shards.select(F.size("doc_ids").cast("long").alias("n"), F.expr("aggregate(lengths, 0L, (a, x) -> a + x)").alias("l")).agg(F.sum("n"), F.sum("l")).first()
    docs, length = stats[0] or 0, stats[1] or 0
    if not docs:
        return spark.createDataFrame([], f"item_id {queries.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    # each query row has a number; blocks take neighbours of it
    rows = written(queries.select(F.monotonically_increasing_id().alias("q"), F.col("item_id").cast("string"), F.col("text").cast("string")), "search-queries")
    uses = (bound_batches(rows).mapInArrow(_query_terms, QUERY_TERMS)
            .groupBy("term", "q", "item_id").agg(F.count(F.lit(1)).alias("times"))
            .withColumn("query_block", F.pmod(F.xxhash64("q"), F.ceil(F.lit(_n(rows)) / query_block).cast("long"))))
    # at most a query block's uses in one row
    wanted = written(uses.groupBy("query_block", "term").agg(F.collect_list(F.struct("q", "item_id", "times")).alias("uses")), "search-terms")
    lists = index.where("kind = 1").select("shard", "term", "df", "postings", "block_bytes", "block_last", "block_tf", "block_n")
    df = (lists.select("term", "df").join(wanted.select("term").distinct(), "term", "left_semi")
          .groupBy("term").agg(F.sum("df").alias("df")))
    ratio = F.lit(2 * docs + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    wanted = wanted.join(df, "term").withColumn("w", F.floor(1000 * F.log(ratio)).cast("long")).drop("df")
    group = (lists.drop("df").join(wanted, "term")
             .groupBy("query_block", "shard")
             .agg(F.collect_list(F.struct("w", "uses", "postings", "block_bytes", "block_last", "block_tf", "block_n")).alias("lists")))
    # the work grows with queries and shards, not with bytes: as many tasks as the session deals to
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hits = group.join(shards, "shard").repartition(parts, "query_block", "shard").select("lists", "doc_ids", "lengths")
    heaps = hits.mapInArrow(_searcher(docs, length, k), HITS)
    merged = heaps.withColumn("nth", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).where(F.col("nth") <= k)
    # rows of the query table that share an id are ranked together
    ranked = merged.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "q")))
    return ranked.select(F.col("item_id").cast(queries.schema["item_id"].dataType), F.col("rank").cast("int"), "doc_id", "score")


def _n(df: DataFrame) -> int:
    return max(df.count(), 1)
