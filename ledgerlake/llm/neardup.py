"""Near-duplicate documents by SetSketch registers.

A document is the set of its distinct 5-word shingles.  A register holds the
exponentially spaced, truncated minimum of the shingles' hash values; sketches
of two sets merge by the larger register.  Bands of register values put likely
links into common buckets; documents that share buckets, directly or in a
chain, form a group.  Inside a group, every pair's similarity is estimated
jointly by likelihood from the registers that are larger, smaller and equal,
and what could reach the threshold is verified on the full sets.

Groups are cut into blocks of about BLOCK_SET_BYTES and BLOCK_DOCS documents; a
task holds two blocks and emits only links that join two parts, never all pairs.  Blocks whose
documents are already joined never meet, so a large family of near copies
costs its own size, not its square.  Equal sets are one node throughout, so
exact copies cost one row.

Misses: a link at similarity 0.75 shares a band except with probability
(1 - 0.75**4)**40, 2.5e-7; a link's estimate falls below FLOOR (five standard
errors) less often still.  Both fall fast with similarity.

Cases: a null or empty text, or one without words, has no shingles, is linked
with nothing and is kept.  Rows that share an id count as one node of the
graph.  A row without an id is linked with nothing and kept; its component is
null.  Other columns are not looked at.  An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .arrays import LOWER, SPACES, U64, Words, blocks, mix, utf8
from .common import BLOCK_BYTES, bound_batches, written
from .graph import components

SHINGLE = 5
LINK_PERCENT = 75
ROWS, BANDS = 4, 40
REGISTERS = ROWS * BANDS
#: Sketch parameters: base, rate, largest register.
BASE, RATE, TOP = 1.001, 20.0, 65535
#: Pairs whose estimate is lower are not verified: 0.75 less five standard errors.
FLOOR = 0.58
#: Sets of one block of a group.
BLOCK_SET_BYTES = 8 << 20
#: Documents of one block at most, and so pairs of one task; a shorter
#: document weighs as much as its share of a full block.
BLOCK_DOCS = 4096
LEAST_WEIGHT = BLOCK_SET_BYTES // 8 // BLOCK_DOCS

SIGNATURES = "doc_id long, n_shingles long, s1 long, s2 long, registers binary"


def shingles(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of each text, sorted by both."""
    words = Words(LOWER[data], off, SPACES)
    at, key = words.grams(SHINGLE)
    doc = words.doc[at]
    count = np.diff(words.first)
    for n in range(1, SHINGLE):
        # fewer words: the whole sequence is the one shingle
        short = np.flatnonzero(count == n)
        doc = np.concatenate([doc, short])
        key = np.concatenate([key, words.grams_at(words.first[short], n)])
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], key[new]


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U64(12)).astype(np.float64) + 0.5) * 2.0 ** -52


def sketch(doc: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """Registers of ``n`` sets, one row each; an empty set has zeros.

    Each shingle is a random process: points at exponential distances, each in
    a random register, so every register sees independent exponential values
    of rate RATE and only the first few points of a shingle matter.  Points
    beyond a limit are not drawn; where a register is then still empty, the
    limit of that set doubles and its processes go on.
    """
    size = np.bincount(doc, minlength=n)
    low = np.full(n * REGISTERS, np.inf)
    limit = np.where(size > 0, (math.log(REGISTERS) + 6) / (RATE * np.maximum(size, 1)), 0.0)
    time, step = np.zeros(len(key)), np.zeros(len(key), np.int64)
    todo = np.arange(len(key))
    waiting = []
    while len(todo):
        ahead = int(np.clip(8192 // len(todo), 1, 256))
        draw = step[todo][:, None] + np.arange(1, ahead + 1)
        seed = mix(key[todo][:, None] + draw.astype(U64) * U64(0x9E3779B97F4A7C15))
        points = time[todo][:, None] - np.cumsum(np.log(_uniform(seed)), axis=1) / (RATE * REGISTERS)
        register = (mix(seed ^ U64(0x5851F42D4C957F2D)) % U64(REGISTERS)).astype(np.int64)
        np.minimum.at(low, (doc[todo][:, None] * REGISTERS + register).ravel(), points.ravel())
        time[todo], step[todo] = points[:, -1], step[todo] + ahead
        going = time[todo] <= limit[doc[todo]]
        waiting.append(todo[~going])
        todo = todo[going]
        if not len(todo):
            empty = np.isinf(low).reshape(n, REGISTERS).any(axis=1) & (size > 0)
            limit[empty] *= 2
            rest = np.concatenate(waiting)
            again = empty[doc[rest]]
            todo, waiting = rest[again], [rest[~again]]
    with np.errstate(divide="ignore"):
        value = np.floor(1 - np.log(low) / math.log(BASE))
    return np.clip(np.where(np.isinf(low), 0, value), 0, TOP).astype(np.uint16).reshape(n, REGISTERS)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of a union is the larger register of each place."""
    return np.maximum(a, b)


def estimate(more: np.ndarray, less: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches, from how
    many registers of a are larger and smaller and the known set sizes."""
    share_a = size_a / (size_a + size_b)
    share_b = 1 - share_a

    def larger(x):      # probability that a register is larger, for a share x of own elements
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    def likelihood(j):
        up, down = larger(share_a - share_b * j), larger(share_b - share_a * j)
        tiny = 1e-12
        return more * np.log(up + tiny) + less * np.log(down + tiny) + (REGISTERS - more - less) * np.log(np.maximum(1 - up - down, tiny))

    lo, hi = np.zeros(len(share_a)), np.minimum(share_a / share_b, share_b / share_a)
    cut = (math.sqrt(5) - 1) / 2
    for _ in range(16):     # golden section: the likelihood has one peak
        x, y = hi - cut * (hi - lo), lo + cut * (hi - lo)
        left = likelihood(x) > likelihood(y)
        lo, hi = np.where(left, lo, x), np.where(left, y, hi)
    return (lo + hi) / 2


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each sketch."""
    part = registers.reshape(len(registers), BANDS, ROWS).astype(U64)
    key = np.zeros(part.shape[:2], U64) + np.arange(BANDS, dtype=U64)
    for k in range(ROWS):
        key = mix(key * U64(65537) + part[:, :, k] + U64(1))
    return key


def _blocks(batch, text_col):
    data, off = utf8(batch.column(text_col))
    for i, j in blocks(off, BLOCK_BYTES):
        yield i, j, *shingles(data[off[i]:off[j]], off[i:j + 1] - off[i])


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids = batch.column(id_col).cast(pa.int64())
            for i, j, doc, key in _blocks(batch, text_col):
                n = j - i
                size = np.bincount(doc, minlength=n)
                sums = []
                for salt in (1, 2):
                    total = np.zeros(n + 1, U64)
                    total[1:] = np.cumsum(size)
                    run_sum = np.concatenate([[U64(0)], np.cumsum(mix(key ^ U64(salt * 0x9E3779B97F4A7C15 % 2**64)), dtype=U64)])
                    sums.append((run_sum[total[1:].astype(np.int64)] - run_sum[total[:-1].astype(np.int64)]).view(np.int64))
                regs = sketch(doc, key, n)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, n), pa.array(size.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]), pa.array([r.tobytes() for r in regs], pa.binary())],
                    ["doc_id", "n_shingles", "s1", "s2", "registers"])

    return docs.select(id_col, text_col).mapInArrow(run, SIGNATURES)


def band_rows(nodes: DataFrame) -> DataFrame:
    """(key, doc_id) of each band of each node."""
    def run(batches):
        for batch in batches:
            regs = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            ids = np.repeat(batch.column("doc_id").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(band_keys(regs).ravel().view(np.int64)), pa.array(ids)], ["key", "doc_id"])

    return nodes.select("doc_id", "registers").mapInArrow(run, "key long, doc_id long")


def sets_of(docs: DataFrame, placed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The full shingle set and sketch of each document of ``placed``, once for
    every pair of blocks that it takes part in."""
    def run(batches):
        for batch in batches:
            for i, j, doc, key in _blocks(batch, "text"):
                regs = sketch(doc, key, j - i)
                edge = np.searchsorted(doc, np.arange(j - i + 1))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in place],
                     pa.array([key[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary()),
                     pa.array([r.tobytes() for r in regs], pa.binary())],
                    [*place, "shingles", "registers"])

    place = ["doc_id", "grp", "part", "own", "meets"]
    # dealt by id at every size, with the small rows as the hashed side: the
    # number of members grows with the corpus, so no broadcast
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(placed.select(*place).hint("shuffle_hash"), "doc_id")
    sets = texts.select(*place, "text").mapInArrow(run, "doc_id long, grp long, part long, own long, meets array<long>, shingles binary, registers binary")
    return (sets.withColumn("meets", F.explode("meets"))
            .select("grp", F.least("own", "meets").alias("first"), F.greatest("own", "meets").alias("second"), "own", "part", "doc_id", "shingles", "registers"))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity, on the full sets."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if 100 * len(small) < LINK_PERCENT * len(large):
        return False
    place = np.searchsorted(large, small)
    place[place == len(large)] = 0
    both = int((large[place] == small).sum())
    return 100 * both >= LINK_PERCENT * (len(a) + len(b) - both)


def block_links(table: pa.Table) -> pa.Table:
    """Links between documents of two blocks of a group (or of one block),
    fewest that join what any link joins: a pair already joined is skipped."""
    ids = table.column("doc_id").to_numpy()
    own, first, second = table.column("own").to_numpy(), table.column("first")[0].as_py(), table.column("second")[0].as_py()
    sets = [np.frombuffer(x, U64) for x in table.column("shingles").to_pylist()]
    regs = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
    size = np.array([len(s) for s in sets], np.float64)
    part = np.unique(table.column("part").to_numpy(), return_inverse=True)[1]      # what is joined so far
    found = []
    left = np.flatnonzero(own == first)
    right = np.flatnonzero(own == second)
    for k, x in enumerate(left.tolist()):
        ys = right if first != second else left[k + 1:]
        ys = ys[part[ys] != part[x]]
        # sizes alone rule out most pairs of a mixed group
        small, large = np.minimum(size[ys], size[x]), np.maximum(size[ys], size[x])
        ys = ys[(100 * small >= LINK_PERCENT * large) & (size[ys] > 0) & (size[x] > 0)]
        if not len(ys):
            continue
        other = regs[ys]
        equal = np.count_nonzero(other == regs[x], axis=1)
        maybe = equal >= (FLOOR - 0.15) * REGISTERS
        ys, other, equal = ys[maybe], other[maybe], equal[maybe]
        if not len(ys):
            continue
        less = np.count_nonzero(other > regs[x], axis=1)
        more = REGISTERS - equal - less
        value = estimate(more, less, size[x], size[ys])
        near = np.flatnonzero(value >= FLOOR)
        for y in ys[near[np.argsort(-value[near], kind="stable")]].tolist():
            if part[x] != part[y] and linked(sets[x], sets[y]):
                part[part == part[y]] = part[x]
                found.append((ids[x], ids[y]))
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def compared(docs: DataFrame, placed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Links (a, b) that the block pairs of ``placed`` give."""
    return written(sets_of(docs, placed, id_col, text_col).groupBy("grp", "first", "second").applyInArrow(block_links, "a long, b long"), "verified")


def blocks_for(size: Column) -> Column:
    return F.ceil(size * 8 / F.lit(BLOCK_SET_BYTES))


def alone(members: DataFrame) -> DataFrame:
    """Blocks of each group, every one compared with itself only."""
    weight = members.groupBy("grp").agg(blocks_for(F.sum("n")).alias("n_blocks"))
    return (members.join(weight, "grp").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("n_blocks")))
            .withColumn("meets", F.array("own")))


def across(members: DataFrame) -> DataFrame:
    """Blocks that hold one part of a group or, for parts smaller than a
    block, several; every two blocks meet but those of one part."""
    size = members.groupBy("grp", "part").agg(blocks_for(F.sum("n")).alias("k"), F.sum("n").alias("n"))
    big, small = F.col("k") > 1, F.col("k") <= 1
    total = size.groupBy("grp").agg(blocks_for(F.sum(F.when(small, F.col("n")).otherwise(0))).alias("pooled"), F.sum(F.when(big, F.col("k")).otherwise(0)).alias("more"))
    # parts larger than a block: as many rows as blocks at most
    placed = (size.where(big).select("grp", F.col("part"), "k", F.sum("k").over(Window.partitionBy("grp").orderBy("part")).alias("upto"))
              .join(total.select("grp", "pooled"), "grp").select("grp", "part", "k", (F.col("pooled") + F.col("upto") - F.col("k")).alias("low")))
    held = members.join(total, "grp").join(placed, ["grp", "part"], "left")
    own = F.when(F.col("k").isNull(), F.pmod(F.xxhash64("part"), F.greatest("pooled", F.lit(1)))).otherwise(F.col("low") + F.pmod(F.xxhash64("doc_id"), F.greatest("k", F.lit(1))))
    meets = F.filter(F.sequence(F.lit(0).cast("long"), F.col("pooled") + F.col("more") - 1), lambda b: F.col("k").isNull() | (b < F.col("low")) | (b >= F.col("low") + F.col("k")))
    return held.withColumn("own", own).withColumn("meets", meets).where(F.size("meets") > 0)


def group_links(docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Links that join whatever any link inside a group joins.

    Each block is compared with itself, which settles every group of one
    block.  In wider groups, one representative for each part found so far
    goes on, as long as that leaves a third fewer; then blocks of different
    parts meet.
    So a family of near copies, however large, is compared once with itself in
    blocks and then only with what is not joined to it."""
    links = compared(docs, alone(members.withColumn("part", F.col("doc_id"))), id_col, text_col)
    weight = members.groupBy("grp").agg(blocks_for(F.sum("n")).alias("n_blocks")).where("n_blocks > 1").select("grp")
    wide = written(members.join(weight, "grp"), "wide")
    before = wide.count()
    while before:
        own = links.join(wide.select(F.col("doc_id").alias("a")), "a", "left_semi")
        parts = wide.join(components(own), F.col("doc_id") == F.col("node"), "left").select("doc_id", "grp", "n", F.coalesce("component", "doc_id").alias("part"))
        heads = written(parts.where("doc_id = part"), "heads")
        after = heads.count()
        if 3 * after > 2 * before:
            return links.union(compared(docs, across(parts), id_col, text_col))
        links = links.union(compared(docs, alone(heads), id_col, text_col))
        before = after
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id
    it is linked with, directly or in a chain) and kept."""
    bound_batches(docs)
    signed = written(signatures(docs, id_col, text_col), "signatures")
    some = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # equal sets are one node, named by their smallest id
    classes = some.groupBy("n_shingles", "s1", "s2").agg(F.min("doc_id").alias("node"))
    same = ["n_shingles", "s1", "s2"]
    nodes = written(some.join(classes.select("node", *same), [*same]).where("doc_id = node").select("doc_id", "n_shingles", "registers"), "nodes")

    bands = band_rows(nodes)
    leads = bands.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z").select("key", "a")
    near = bands.join(leads, "key").where("doc_id > a").select("a", F.col("doc_id").alias("b")).distinct()
    groups = components(near)
    size = nodes.groupBy(F.col("doc_id").alias("node")).agg(F.greatest(F.sum("n_shingles"), F.lit(LEAST_WEIGHT)).alias("n"))
    members = written(groups.join(size, "node").select(F.col("node").alias("doc_id"), F.col("component").alias("grp"), "n"), "members")
    found = components(group_links(docs, members, id_col, text_col))

    return (signed.drop("registers").join(classes, same, "left").join(found, "node", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of near duplicates (its smallest id), and
    every document that is linked with nothing; all columns stay.  A document
    is an id with its text: rows that share both are one (one of them stays),
    rows that share only the id are several, the one with the smaller hash of
    the text first."""
    version = F.xxhash64(text_col)
    given = docs.select(F.col(id_col).alias("__id"), version.alias("__h")).where("__id IS NOT NULL")
    shared = given.groupBy("__id").agg((F.min("__h") < F.max("__h")).alias("several")).where("several")
    if shared.isEmpty():
        keep = near_duplicates(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
        out = docs.join(keep, docs[id_col].eqNullSafe(keep["__kept"]), "left_semi")
        named, unnamed = out.where(F.col(id_col).isNotNull()), out.where(F.col(id_col).isNull())
        return named.dropDuplicates([id_col]).unionByName(unnamed)
    # documents numbered in order of id and text; written, so that every later
    # pass sees the same numbers
    numbered = written(given.distinct().repartitionByRange("__id", "__h").sortWithinPartitions("__id", "__h")
                       .withColumn("__n", F.monotonically_increasing_id()), "near-numbers")
    marked = docs.join(numbered, (docs[id_col] == numbered["__id"]) & (version == numbered["__h"]), "left")
    keep = near_duplicates(marked.select("__n", text_col), "__n", text_col).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    out = marked.join(keep, marked["__n"].eqNullSafe(keep["__kept"]), "left_semi")
    named, unnamed = out.where("__n IS NOT NULL").dropDuplicates(["__n"]), out.where("__n IS NULL")
    return named.unionByName(unnamed).select(*docs.columns)
