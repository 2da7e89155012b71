"""Shards by a minimax contiguous partition, in DataFrame functions only.

Documents with equal texts form an atomic group.  Groups lie in the order of
their text's SHA-256; a shard is a run of groups, and the largest shard is as
small as any such cut allows: a binary search over the capacity, each tried
greedily.

The search needs sums only where a cut can fall.  It starts from the sums of
UNITS runs of groups (by leading hex digits), which bound the capacity from
both sides; only the runs that hold a possible cut are split further, until
each of those is a single group.  The driver holds these sums, a number fixed
by UNITS and the shard count, never the groups.  Within the capacity found,
cuts are placed as evenly as it allows.

Law: `bytes`.  Sizes are near equal as far as atomic groups allow: a group
larger than the mean is a shard's lower bound.

Cases: a null text is empty (size 8); repeated rows are group members of their
own and get slots of their own; a null id is kept; other columns are not
looked at; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, Window, functions as F

from .common import written

ROW_BYTES = 8
#: Leading hex digits of a group's key: of the first units, and added at a split.
FIRST_DIGITS, MORE_DIGITS = 4, 2
#: A slot is counted inside a cell: a run of groups by its two leading digits,
#: cut by the hash of the id so that a large group is spread.
CELL_DIGITS, CELL_SALTS = 2, 256


def sized(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(data) + ROW_BYTES).cast("long").alias("size"),
                       F.crc32(data).alias("text_crc32"), F.sha2(data, 256).alias("key"))


class Units:
    """Runs of groups in order: (prefix of their keys, bytes, groups)."""

    def __init__(self, rows: list[tuple[str, int, int]], shards: int):
        self.rows, self.shards = sorted(rows), shards
        self.ends = [0]
        for _, size, _ in self.rows:
            self.ends.append(self.ends[-1] + size)
        self.total = self.ends[-1]

    def greedy(self, capacity: int) -> list[int]:
        """How many units lie before the end of each shard."""
        cuts, at = [], 0
        for _ in range(self.shards):
            at = max(at, bisect_right(self.ends, self.ends[at] + capacity) - 1)
            cuts.append(at)
        return cuts

    def capacity(self) -> int:
        """The smallest capacity for which the greedy cut reaches the end."""
        low, high = -(-self.total // self.shards), max(1, self.total)
        while low < high:
            mid = (low + high) // 2
            if self.greedy(mid)[-1] == len(self.rows):
                high = mid
            else:
                low = mid + 1
        return low

    def open(self, capacity: int) -> list[str]:
        """Units of several groups in which a cut may fall, for any capacity
        between the least possible and ``capacity``."""
        least = max([-(-self.total // self.shards), *(s for _, s, n in self.rows if n == 1)])
        out = []
        for k, start in enumerate(self.greedy(least)[:-1]):
            last = bisect_left(self.ends, min((k + 1) * capacity, self.total))
            out += [self.rows[u][0] for u in range(start, min(last, len(self.rows))) if self.rows[u][2] > 1]
        return sorted(set(out))

    def even_cuts(self, capacity: int) -> list[int]:
        """Cuts within the capacity, each as near an equal share of what is
        left as the shards behind it allow."""
        furthest = self.greedy(capacity)
        nearest, at = [], len(self.rows)
        for _ in range(self.shards - 1):
            at = min(at, bisect_left(self.ends, self.ends[at] - capacity))
            nearest.append(at)
        nearest.reverse()
        cuts, at = [], 0
        for k in range(self.shards - 1):
            share = self.ends[at] + (self.total - self.ends[at]) / (self.shards - k)
            goal = bisect_left(self.ends, share)
            if goal > 0 and goal < len(self.ends) and share - self.ends[goal - 1] < self.ends[goal] - share:
                goal -= 1
            reach = max(at, bisect_right(self.ends, self.ends[at] + capacity) - 1)
            at = max(at, min(max(goal, nearest[k]), reach, furthest[k]))
            cuts.append(at)
        return cuts


def boundaries(groups: DataFrame, shards: int) -> list[str]:
    """The largest key of each shard but the last (as an upper bound)."""
    def units(digits: int, within: list[str] | None = None) -> list[tuple]:
        part = groups
        if within is not None:
            part = part.where(F.substring("key", 1, len(within[0])).isin(within))
        found = part.groupBy(F.substring("key", 1, digits).alias("unit")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        return [tuple(r) for r in found.collect()]

    held = Units(units(FIRST_DIGITS), shards)
    while True:
        capacity = held.capacity()
        todo = held.open(capacity)
        if not todo:
            break
        # units of one length at a time, so that one filter names them
        digits = len(todo[0])
        todo = [u for u in todo if len(u) == digits]
        gone = set(todo)
        held = Units([r for r in held.rows if r[0] not in gone] + units(digits + MORE_DIGITS, todo), shards)
    after = "~"     # sorts behind every hex digit
    return [held.rows[c - 1][0] + after if c else "" for c in held.even_cuts(capacity)]


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its size, shard and slot in it."""
    rows = written(sized(docs, id_col, text_col), "sized")
    groups = written(rows.groupBy("key").agg(F.sum("size").alias("size")), "groups")
    bounds = boundaries(groups, shards)
    number = F.lit(0)
    for b in bounds:
        number = number + (F.col("key") > b).cast("int")
    placed = (rows.withColumn("shard", number)
              .withColumn("cell", F.concat(F.substring("key", 1, CELL_DIGITS), F.lit("-"), F.pmod(F.xxhash64("doc_id"), F.lit(CELL_SALTS)).cast("string"))))
    counts = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    # at most 16**CELL_DIGITS * CELL_SALTS cells, and one more run per shard
    before = counts.select("shard", "cell", (F.sum("n").over(Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    slot = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("key", "doc_id")) - 1
    return (placed.withColumn("__slot", slot).join(before, ["shard", "cell"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("before") + F.col("__slot")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
