"""All matches of patterns in a text, with their places, in SQL functions.

Spark's functions give the matches of a pattern and the pieces between them;
the places follow from their lengths in code points.  Both walk a text once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CONTEXT = 32


def with_matches(df: DataFrame, text: str, patterns: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds for each name an array column ``__m_<name>`` of (start, end, hit,
    left, right): the leftmost non-overlapping matches, the characters before
    (at most CONTEXT, back to the last match) and the one behind.  ``patterns``
    gives the pattern and a cheap condition without which it cannot match."""
    hits = {n: F.when(gate, F.regexp_extract_all(text, F.lit(p), F.lit(0))) for n, (p, gate) in patterns.items()}
    df = df.withColumns({f"__h_{n}": c for n, c in hits.items()})
    some = {n: F.size(f"__h_{n}") > 0 for n in patterns}
    df = df.withColumns({f"__g_{n}": F.when(some[n], F.split(text, p, -1)) for n, (p, _) in patterns.items()})
    out = {}
    for n in patterns:
        h, g = F.col(f"__h_{n}"), F.col(f"__g_{n}")
        rows = F.arrays_zip(h.alias("hit"), F.slice(g, F.lit(1), F.size(h)).alias("left"), F.slice(g, F.lit(2), F.size(h)).alias("right"))
        kind = "array<struct<start:bigint,end:bigint,hit:string,left:string,right:string>>"

        def step(acc, x):
            start = acc["at"] + F.length(x["left"])
            end = start + F.length(x["hit"])
            one = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"),
                           F.right(x["left"], F.lit(CONTEXT)).alias("left"), F.left(x["right"], F.lit(1)).alias("right"))
            return F.struct(end.alias("at"), F.concat(acc["all"], F.array(one)).alias("all"))

        found = F.aggregate(rows, F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(kind).alias("all")), step, lambda acc: acc["all"])
        out[f"__m_{n}"] = F.when(some[n], found).otherwise(F.array().cast(kind))
    return df.withColumns(out).drop(*[f"__{x}_{n}" for x in "hg" for n in patterns])


def joined(spans: Column) -> Column:
    """kind:start:end of sorted (start, rank, end, kind), comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def ranked(matches: Column, kind: str, rank: int) -> Column:
    return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")))
