"""Exact substring deduplication by two-stage suffix sorting.

A byte goes where a string of LENGTH bytes that covers it starts anywhere else
too.  Which suffixes can matter is found first: every LENGTH-byte string has
an anchor, the GRAM bytes in it with the smallest hash, and equal strings have
the same anchor at the same distance.  So only anchors whose gram occurs twice
are kept, and only the text around them (its context) is sorted.

Equal contexts are counted and collapsed before any text moves.  The contexts
left, of grams that occur in several contexts, are sorted in blocks, less those
that share no HALF bytes beside the anchor with another.  Of the suffixes that
begin a string, only those smaller than their successors are sorted directly
(equal ones as one), the others follow from one scan over the buckets of first
bytes, and comparing neighbours gives the common prefixes.  Strings are equal where neighbours share LENGTH bytes;
the distance to the anchor must agree as well, so that a string is never taken
for its own repetition.  A gram with more than BLOCK_CONTEXTS contexts would
not fit a block; its strings are counted by hash instead, which spreads them.

Cases: a null or empty text, or one shorter than LENGTH, loses nothing; rows
that repeat, with or without an id, are documents of their own and lose every
byte that LENGTH bytes cover; a null id is kept; other columns are not looked
at; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import U64, blocks, mix, powers, utf8
from .common import BLOCK_BYTES, bound_batches, written

LENGTH, GRAM = 200, 64
#: Starts of grams in a string, and so the furthest a string begins before its anchor.
STARTS = LENGTH - GRAM + 1
REACH = STARTS - 1
#: A string has so many bytes before its anchor or behind it.
HALF = (LENGTH - GRAM) // 2
#: Bytes of contexts that are sorted together, and contexts of one gram that may be.
SORT_BYTES = 1 << 20
BLOCK_CONTEXTS = 1 << 14
_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_inverse = np.ones(1, U64)


def _inverse_powers(n: int) -> np.ndarray:
    global _inverse
    if len(_inverse) < n:
        grown = np.full(max(n, 2 * len(_inverse)), _INVERSE, U64)
        grown[0] = 1
        _inverse = np.multiply.accumulate(grown)
    return _inverse[:n]


class Rolling:
    """Hashes of byte ranges of a block from one prefix sum."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * powers(n + 1)[:n], out=self.sums[1:])
        self.back = _inverse_powers(n + 1)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.back[a] + (b - a).astype(U64))


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, Rolling]:
    """(text, byte position) of the anchors of all LENGTH-byte strings."""
    size = np.diff(off)
    roll = Rolling(data)
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), roll
    at = np.arange(n - GRAM + 1)
    bits = U64(max(24, int(n).bit_length()))
    key = (roll(at, at + GRAM) >> bits << bits) | at.astype(U64)       # equal hashes: the first
    padded = np.full(-(-len(key) // STARTS) * STARTS, ~U64(0))
    padded[:len(key)] = key
    rows = padded.reshape(-1, STARTS)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n - LENGTH + 1], ahead[STARTS - 1:STARTS - 1 + n - LENGTH + 1])
    inside = np.zeros(n + 1, np.int64)
    long = size >= LENGTH
    np.add.at(inside, off[:-1][long], 1)
    np.add.at(inside, off[1:][long] - LENGTH + 1, -1)
    starts = np.cumsum(inside)[:n - LENGTH + 1] > 0
    found = least[starts]
    found = np.unique(found & ((U64(1) << bits) - U64(1))).astype(np.int64)
    doc = np.searchsorted(off, found, "right") - 1
    return doc, found, roll


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts with a key of their row: a hash of id and text, and the size."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
            .select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"), F.octet_length("text").alias("size")))


def anchor_rows(base: DataFrame) -> DataFrame:
    """(gram, context, row, size, at) of every anchor."""
    def run(batches):
        for batch in batches:
            data, off = utf8(batch.column("text"))
            rows = batch.column("row").to_numpy()
            for i, j in blocks(off, BLOCK_BYTES):
                part, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
                doc, at, roll = anchors(part, o)
                begin, end = np.maximum(at - REACH, o[doc]), np.minimum(at + LENGTH, o[doc + 1])
                context = mix(roll(begin, end) ^ ((at - begin).astype(U64) << U64(32)) ^ U64(7))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(roll(at, at + GRAM).view(np.int64)), pa.array(context.view(np.int64)), pa.array(rows[i:j][doc]),
                     pa.array(np.diff(o)[doc].astype(np.int32)), pa.array((at - o[doc]).astype(np.int32))], ["gram", "context", "row", "size", "at"])

    return base.select("text", "row").mapInArrow(run, "gram long, context long, row long, size int, at int")


# -- two-stage sorting ---------------------------------------------------------------
def word_keys(text: np.ndarray) -> np.ndarray:
    """Eight bytes from each position as one number, first byte highest."""
    padded = np.zeros(len(text) + LENGTH + 8, U64)
    padded[:len(text)] = text
    out = np.zeros(len(text) + LENGTH, U64)
    for k in range(8):
        out = (out << U64(8)) | padded[k:k + len(out)]
    return out


def direct_sort(at: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """``at`` ordered by the LENGTH bytes from each position."""
    order, group = at, np.zeros(len(at), np.int64)
    open_ = np.arange(len(at))                   # places in groups that are still tied
    for k in range(0, LENGTH, 8):
        if not len(open_):
            break
        key = keys[order[open_] + k]
        by = np.lexsort((key, group[open_]))
        order[open_] = order[open_][by]
        key, g = key[by], group[open_]
        new = np.ones(len(open_), bool)
        new[1:] = (key[1:] != key[:-1]) | (g[1:] != g[:-1])
        group[open_] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        alone = new & np.append(new[1:], True)
        open_ = open_[~alone]
    return order


def collapsed_sort(at: np.ndarray, keys: np.ndarray, string: np.ndarray) -> np.ndarray:
    """``direct_sort`` of positions whose LENGTH bytes are mostly repeated:
    one position of each string (by the hash ``string``) is sorted, and the
    others follow it.  Hashes are checked against the bytes."""
    _, lead, own = np.unique(string[at], return_index=True, return_inverse=True)
    alike = at[lead][own]
    for k in range(0, LENGTH, 8):
        if (keys[at + k] != keys[alike + k]).any():
            return direct_sort(at, keys)
    leads = at[lead]
    by = np.argsort(leads)
    rank = np.empty(len(leads), np.int64)
    rank[by[np.searchsorted(leads[by], direct_sort(leads.copy(), keys))]] = np.arange(len(leads))
    return at[np.argsort(rank[own], kind="stable")]


def suffix_order(text: np.ndarray, starts: np.ndarray | None = None, string: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order to a depth of LENGTH bytes, the eight-byte keys).

    With ``starts`` only those suffixes are ordered, and the ones behind them
    up to the next that is smaller than its successor, from which they are
    induced.  ``string``: hashes of the LENGTH bytes from each position."""
    n = len(text)
    keys = word_keys(text)
    # a suffix is smaller than its successor by the first byte that differs
    smaller = np.zeros(n, bool)
    differs = np.flatnonzero(text[:-1] != text[1:])
    if len(differs):
        following = np.searchsorted(differs, np.arange(n))
        some = following < len(differs)
        at = differs[following[some]]
        smaller[some] = text[at] < text[at + 1]
    wanted = np.ones(n, bool)
    if starts is not None:
        ends = np.append(np.flatnonzero(smaller), n - 1)
        edge = np.bincount(starts, minlength=n + 1) - np.bincount(ends[np.searchsorted(ends, starts)] + 1, minlength=n + 1)
        wanted = np.cumsum(edge)[:n] > 0
    # stage one: only these are compared
    direct = np.flatnonzero(smaller & wanted)
    direct = direct_sort(direct, keys) if string is None else collapsed_sort(direct, keys, string)
    counts = np.bincount(text[wanted], minlength=256)
    first = np.cumsum(counts) - counts
    order = np.full(int(wanted.sum()), -1, np.int64)
    per_byte = np.bincount(text[direct], minlength=256)
    tail = first + counts - per_byte
    order[np.repeat(tail, per_byte) + np.arange(len(direct)) - np.repeat(np.cumsum(per_byte) - per_byte, per_byte)] = direct
    # stage two: scan the buckets in order; what stands before a placed suffix
    # and is larger than it goes to the next free place of its own bucket
    head = first.copy()

    def induce(places: np.ndarray) -> None:
        before = places - 1
        before = before[before >= 0]
        before = before[wanted[before] & ~smaller[before]]
        if len(before):
            byte = text[before]
            by = np.argsort(byte, kind="stable")
            before, byte = before[by], byte[by]
            size = np.bincount(byte, minlength=256)
            order[np.repeat(head, size) + np.arange(len(before)) - np.repeat(np.cumsum(size) - size, size)] = before
            head[:] = head + size

    # the last suffix has no successor to be compared with: it is the first of its bucket
    if wanted[-1]:
        order[head[text[-1]]] = n - 1
        head[text[-1]] += 1
    for c in np.flatnonzero(counts):
        done = first[c]
        while done < head[c]:           # suffixes of this bucket that the scan itself adds
            done, now = head[c], order[done:head[c]]
            induce(now)
        induce(order[tail[c]:first[c] + counts[c]])
    return order, keys


def repeated_strings(text: np.ndarray, starts: np.ndarray, distance: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Which of ``starts`` begin a LENGTH-byte string that occurs twice with
    the same distance to its anchor, each start standing for ``times``."""
    roll, at = Rolling(text), np.arange(len(text))
    string = roll(at, np.minimum(at + LENGTH, len(text)))
    order, keys = suffix_order(text, starts, string)
    place = np.full(len(text), -1, np.int64)
    place[starts] = np.arange(len(starts))
    ranked = place[order]
    ranked = ranked[ranked >= 0]
    at = starts[ranked]
    same = string[at[1:]] == string[at[:-1]] if len(at) else np.zeros(0, bool)
    live = np.flatnonzero(same)
    for k in range(0, LENGTH, 8):       # common prefix of neighbours
        equal = keys[at[live] + k] == keys[at[live + 1] + k]
        same[live[~equal]] = False
        live = live[equal]
    string = np.concatenate([[0], np.cumsum(~same)]) if len(at) else np.zeros(0, np.int64)
    own = string * STARTS + distance[ranked]
    _, back = np.unique(own, return_inverse=True)
    total = np.bincount(back, weights=times[ranked])
    out = np.zeros(len(starts), bool)
    out[ranked] = total[back] >= 2
    return out


def _likely(rows: list[tuple]) -> list[tuple]:
    """Rows that can share a string with another context of their gram.  A
    string of LENGTH bytes that covers the anchor holds HALF bytes before it or
    HALF bytes behind it, so contexts that share one share the gram with these."""
    text = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
    size = np.array([len(r[4]) for r in rows])
    begin = np.cumsum(size) - size
    at = begin + np.array([r[3] for r in rows])
    roll, gram = Rolling(text), np.array([r[0] for r in rows], np.int64).view(U64)
    keep = np.array([r[2] for r in rows]) > 1
    for a, b in ((at - HALF, at + GRAM), (at, at + GRAM + HALF)):
        fits = np.flatnonzero((a >= begin) & (b <= begin + size))
        _, own, n = np.unique(mix(roll(a[fits], b[fits]) ^ mix(gram[fits])), return_inverse=True, return_counts=True)
        keep[fits[n[own] > 1]] = True
    return [r for r, k in zip(rows, keep.tolist()) if k]


def _block(rows: list[tuple]) -> list[tuple]:
    """(gram, context, from, to) of the removed ranges, relative to the anchor,
    for rows of (gram, context, times, before, bytes)."""
    rows = _likely(rows)
    if not rows:
        return []
    text = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
    size = np.array([len(r[4]) for r in rows])
    begin = np.cumsum(size) - size
    before = np.array([r[3] for r in rows])
    many = np.maximum(0, np.minimum(before, size - LENGTH) + 1)       # strings that begin at the anchor or before it
    row = np.repeat(np.arange(len(rows)), many)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    if not len(row):
        return []
    distance = before[row] - inner
    hit = repeated_strings(text, begin[row] + inner, distance, np.array([r[2] for r in rows])[row])
    row, distance = row[hit], distance[hit]
    if not len(row):
        return []
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (distance[1:] != distance[:-1] - 1)
    lead = np.flatnonzero(fresh)
    last = np.append(lead[1:], len(row)) - 1
    return [(rows[r][0], rows[r][1], -a, LENGTH - b) for r, a, b in zip(row[lead].tolist(), distance[lead].tolist(), distance[last].tolist())]


def sort_contexts(contexts: DataFrame) -> DataFrame:
    """Removed ranges of contexts, which lie together by gram."""
    def table(found):
        cols = list(zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32())],
                                          ["gram", "context", "from", "to"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("gram", "context", "times", "before", "bytes")]
            for row in zip(*cols):
                if size >= SORT_BYTES and row[0] != held[-1][0]:
                    if found := _block(held):
                        yield table(found)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held and (found := _block(held)):
            yield table(found)

    return (contexts.repartition("gram").sortWithinPartitions("gram")
            .mapInArrow(run, "gram long, context long, `from` int, `to` int"))


def count_strings(contexts: DataFrame) -> DataFrame:
    """The same for grams of too many contexts: strings counted by hash."""
    def run(batches):
        for batch in batches:
            for gram, context, times, before, data in zip(*[batch.column(c).to_pylist() for c in ("gram", "context", "times", "before", "bytes")]):
                many = min(before, len(data) - LENGTH) + 1
                if many > 0:
                    digest = [hashlib.blake2b(data[k:k + LENGTH], digest_size=16).digest() for k in range(many)]
                    yield pa.RecordBatch.from_arrays([pa.array([x] * many, t) for x, t in ((gram, pa.int64()), (context, pa.int64()), (times, pa.int64()))]
                                                     + [pa.array(range(before, before - many, -1), pa.int32()), pa.array(digest, pa.binary())],
                                                     ["gram", "context", "times", "distance", "string"])

    strings = contexts.mapInArrow(run, "gram long, context long, times long, distance int, string binary")
    twice = strings.groupBy("gram", "distance", "string").agg(F.sum("times").alias("n")).where("n >= 2").drop("n")
    return (strings.join(twice, ["gram", "distance", "string"])
            .select("gram", "context", (-F.col("distance")).alias("from"), (F.lit(LENGTH) - F.col("distance")).alias("to")))


def ranges(base: DataFrame) -> DataFrame:
    """(row, size, from, to): removed byte ranges, which may overlap."""
    every = anchor_rows(base)
    shared = every.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("gram")
    hits = written(every.join(shared, "gram"), "anchors")
    contexts = written(hits.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("row", "size", "at")).alias("of")), "contexts")
    grams = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # one context, several times: every string in it is repeated
    alone = contexts.join(grams.where("n = 1"), "gram").select("gram", "context", F.lit(None).cast("int").alias("from"), F.lit(None).cast("int").alias("to"))
    several = contexts.join(grams.where("n > 1"), "gram")

    def cut(batches):
        for batch in batches:
            data, off = utf8(batch.column("text"))
            out = []
            for k, found in enumerate(batch.column("found").to_pylist()):
                text = data[off[k]:off[k + 1]]
                for f in found:
                    begin = max(0, f["at"] - REACH)
                    out.append((f["gram"], f["context"], f["times"], f["at"] - begin, text[begin:f["at"] + LENGTH].tobytes(), f["n"]))
            cols = list(zip(*out)) if out else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["gram", "context", "times", "before", "bytes", "n"])

    places = several.groupBy(F.col("of.row").alias("row"), F.col("of.size").alias("size")).agg(
        F.collect_list(F.struct(F.col("of.at").alias("at"), "gram", "context", "times", "n")).alias("found"))
    texts = base.join(places, ["row", "size"]).select("doc_id", "text", "row", "size", "found")
    cuts = written(texts.dropDuplicates(["row", "size"]).mapInArrow(cut, "gram long, context long, times long, before int, bytes binary, n long"), "cuts")
    small, large = cuts.where(F.col("n") <= BLOCK_CONTEXTS), cuts.where(F.col("n") > BLOCK_CONTEXTS)
    found = alone.unionByName(sort_contexts(small.drop("n"))).unionByName(count_strings(large.drop("n")))
    begin = F.greatest(F.lit(0), F.col("at") - REACH)
    last = F.least(F.col("at"), F.col("size") - LENGTH)
    return (hits.join(found, ["gram", "context"])
            .select("row", "size", F.coalesce(F.col("at") + F.col("from"), begin).alias("from"), F.coalesce(F.col("at") + F.col("to"), last + LENGTH).alias("to")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: how much of it went, and what is left.

    ``with_text`` adds the remaining bytes as ``kept``."""
    bound_batches(docs)
    base = keyed(docs, id_col, text_col)
    spans = (ranges(base).groupBy("row", "size").agg(F.collect_set(F.struct("from", "to")).alias("spans")))

    def finish(batches):
        for batch in batches:
            data, off = utf8(batch.column("text"))
            out = []
            for k, spans in enumerate(batch.column("spans").to_pylist()):
                text = data[off[k]:off[k + 1]]
                edge = np.zeros(len(text) + 1, np.int64)
                for s in spans or ():
                    edge[s["from"]] += 1
                    edge[s["to"]] -= 1
                gone = np.cumsum(edge)[:-1] > 0
                kept = text[~gone].tobytes()
                runs = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                out.append((len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            cols = list(zip(*out)) if out else [()] * 5
            arrays = [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(cols[4], pa.binary())] * with_text,
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return base.join(spans, ["row", "size"], "left").select("doc_id", "text", "spans").mapInArrow(finish, schema)
