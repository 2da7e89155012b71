"""Personal data by weak supervision, in DataFrame functions only.

Candidate spans come from patterns.  Four labelers vote on each, for, against
or not at all: a strict format or checksum, a gazetteer (top-level domains,
issuer and country prefixes), cue words in the text before, and how the span
sits between its neighbours.  The votes are counted by pattern over the whole
corpus, and expectation-maximisation estimates from these counts how reliable
each labeler is and how likely each span is personal.  A span classifier is
then trained on those likelihoods over every span's features.

Base spans (e-mail, IP, card and phone by the fixed rules) always stay; the
classifier decides on candidates of the other kinds.

What reaches the driver is one count for each combination of votes and
features, a number fixed by the lists below.

Cases: a null or empty text has no spans; repeated rows and rows without an id
are scanned one by one; other columns are not looked at; an empty table gives
no rows, and a corpus without candidates trains nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import written
from .spans import joined, with_matches

#: The base rules, fixed by the task.  Lookbehinds and possessive repeats keep
#: them linear on long runs; what they match is the same.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![0-9])(?![\x20-][0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
EXTRA = {
    "ssn": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "local_phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
}
KINDS = (*BASE, *EXTRA)
OCTET = "^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"

#: Gazetteers: fixed public lists.
DOMAINS = "com|org|net|edu|gov|int|info|io|de|fr|es|it|uk|us|eu|ch|at|nl|example|test"
COUNTRIES = "1|7|20|27|3[0-469]|4[0134-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
IBAN_COUNTRIES = "AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE"
CUES = {
    "email": "mail|contact|write|schreib|correo|courriel", "ip": r"\bip\b|address|server|host|adresse", "card": "card|visa|master|amex|karte|tarjeta|carte",
    "phone": "phone|call|tel|mobile|fax|anruf|appel|llam", "ssn": "ssn|social|security", "local_phone": "phone|call|tel|mobile|fax|anruf|appel|llam", "iban": "iban|account|bank|konto|cuenta|compte",
}
VOTES = ("format", "gazetteer", "cue", "place")
FEATURES = ("size", "left", "right")
ROUNDS = 40
#: A candidate of another kind is a span from this probability on.
ACCEPT = 0.9

CANDIDATE = ("array<struct<start:bigint,end:bigint,kind:string,rank:int,base:boolean,"
             + ",".join(f"{v}:int" for v in VOTES) + "," + ",".join(f"{f}:string" for f in FEATURES) + ">>")


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    each = F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0)),
                       lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _vote(yes: Column) -> Column:
    return F.when(yes, F.lit(1)).otherwise(F.lit(-1))


def _valid(kind: str, hit: Column) -> Column:
    """The rule beyond the pattern."""
    if kind == "ip":
        return F.forall(F.split(hit, r"\.", -1), lambda p: p.rlike(OCTET))
    if kind == "card":
        return luhn(digits_of(hit))
    if kind == "phone":
        return F.length(digits_of(hit)).between(9, 15)
    if kind == "email":
        return F.lit(True)
    if kind == "ssn":
        return ~hit.rlike("^(000|666|9)|-00-|-0000$")
    if kind == "local_phone":
        return digits_of(hit).rlike("^[2-9][0-9]{2}[2-9]")
    return F.length(F.replace(hit, F.lit(" "), F.lit(""))).between(15, 34)


def _gazetteer(kind: str, hit: Column) -> Column:
    known = {
        "email": lambda: F.lower(hit).rlike(rf"\.({DOMAINS})$"), "phone": lambda: hit.rlike(rf"^\+({COUNTRIES})"),
        "card": lambda: digits_of(hit).rlike("^(4|5[1-5]|2[2-7]|3[47]|6)"), "iban": lambda: hit.rlike(f"^({IBAN_COUNTRIES})"),
    }.get(kind)
    return _vote(known()) if known else F.lit(0)


def _side(char: Column) -> Column:
    return F.when(char == "", "edge").when(char.rlike(r"^\s$"), "space").when(char.rlike(r"^[\p{L}\p{N}_]$"), "word").otherwise("mark")


def _candidate(kind: str, rank: int):
    def one(m: Column) -> Column:
        hit, left, right = m["hit"], F.right(m["left"], F.lit(1)), m["right"]
        valid = _valid(kind, hit)
        strict = valid & hit.rlike(r"^[A-Za-z0-9].*\.[A-Za-z]{2,}$") if kind == "email" else valid
        return F.struct(
            m["start"].alias("start"), m["end"].alias("end"), F.lit(kind).alias("kind"), F.lit(rank).alias("rank"),
            (valid if kind in BASE else F.lit(False)).alias("base"),
            _vote(strict).alias("format"), _gazetteer(kind, hit).alias("gazetteer"),
            F.when(F.lower(m["left"]).rlike(CUES[kind]), 1).otherwise(0).alias("cue"),
            _vote(~(_side(left) == "word") & ~(_side(right) == "word")).alias("place"),
            F.least(F.floor(F.length(hit) / 4), F.lit(9)).cast("string").alias("size"), _side(left).alias("left"), _side(right).alias("right"))
    return one


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``found``: every candidate span with its votes and features.
    Candidates of other kinds that overlap a base span are left out."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    gates = {"email": text.contains("@"), "phone": text.contains("+")}
    found = with_matches(docs, "text", {k: (p, gates.get(k, text.rlike(p))) for k, p in (BASE | EXTRA).items()})
    found = found.select("doc_id", *[F.transform(f"__m_{k}", _candidate(k, n)).cast(CANDIDATE).alias(k) for n, k in enumerate(KINDS)])
    found = found.withColumn("__base", F.concat(*BASE)).withColumn("__fixed", F.filter("__base", lambda s: s["base"]))
    free = F.filter(F.concat(*EXTRA), lambda c: ~F.exists("__fixed", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return found.select("doc_id", F.concat("__base", free).alias("found"))


# -- reliabilities and classifier, from counts -------------------------------------------
def reliabilities(cells: dict[tuple, int]) -> dict[tuple, float]:
    """Probability of each (kind, votes) by expectation-maximisation: a prior
    for each kind and, for each labeler, how it votes on either class."""
    prior = {k: 0.5 for k, *_ in cells}
    table = {v: {1: {1: 0.7, 0: 0.2, -1: 0.1}, 0: {1: 0.2, 0: 0.4, -1: 0.4}} for v in VOTES}
    post: dict[tuple, float] = {}
    for _ in range(ROUNDS):
        for cell in cells:
            score = math.log(prior[cell[0]] / (1 - prior[cell[0]]))
            score += sum(math.log(table[v][1][x] / table[v][0][x]) for v, x in zip(VOTES, cell[1:]))
            post[cell] = 1 / (1 + math.exp(-max(-50.0, min(50.0, score))))
        for kind in prior:
            own = [(c, n) for c, n in cells.items() if c[0] == kind]
            prior[kind] = (sum(post[c] * n for c, n in own) + 1) / (sum(n for _, n in own) + 2)
        for at, v in enumerate(VOTES):
            for z in (0, 1):
                total = {x: 1.0 for x in (1, 0, -1)}
                for cell, n in cells.items():
                    total[cell[1 + at]] += n * (post[cell] if z else 1 - post[cell])
                table[v][z] = {x: w / sum(total.values()) for x, w in total.items()}
    return post


def train(cells: dict[tuple, int]) -> dict[str, dict[str, float]]:
    """Naive Bayes weights over kind, votes and features, from counts by
    (kind, votes, features) weighed by the estimated probabilities."""
    votes: dict[tuple, int] = {}
    width = 1 + len(VOTES)
    for cell, n in sorted(cells.items()):
        votes[cell[:width]] = votes.get(cell[:width], 0) + n
    post = reliabilities(votes)
    names = ("kind", *VOTES, *FEATURES)
    good: dict[str, dict[str, float]] = {f: {} for f in names}
    bad: dict[str, dict[str, float]] = {f: {} for f in names}
    for cell, n in sorted(cells.items()):
        p = post[cell[:width]]
        for f, value in zip(names, cell):
            good[f][str(value)] = good[f].get(str(value), 0.0) + p * n
            bad[f][str(value)] = bad[f].get(str(value), 0.0) + (1 - p) * n
    out: dict[str, dict[str, float]] = {}
    for f in names:
        values = sorted(good[f])
        up, down = sum(good[f].values()) + len(values), sum(bad[f].values()) + len(values)
        out[f] = {v: math.log((good[f][v] + 1) / up) - math.log((bad[f][v] + 1) / down) for v in values}
    if cells:
        out["prior"] = {"": math.log((sum(good["kind"].values()) + 1) / (sum(bad["kind"].values()) + 1))}
    return out


def _score(span: Column, weights: dict[str, dict[str, float]]) -> Column:
    total = F.lit(weights["prior"][""])
    for f in ("kind", *VOTES, *FEATURES):
        one = F.lit(0.0)
        for value, w in weights[f].items():
            one = F.when(span[f].cast("string") == value, F.lit(w)).otherwise(one)
        total = total + one
    return total


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts, the base digest and all spans."""
    held = written(candidates(docs, id_col, text_col), "candidates")
    names = ("kind", *VOTES, *FEATURES)
    counted = held.select(F.explode("found").alias("s")).groupBy(*[F.col(f"s.{f}").alias(f) for f in names]).agg(F.count(F.lit(1)).alias("n"))
    cells = {tuple(r[f] for f in names): r["n"] for r in counted.collect()}
    base = F.filter("found", lambda s: s["base"])
    if any(c[0] in EXTRA for c in cells):
        weights, least = train(cells), math.log(ACCEPT / (1 - ACCEPT))
        every = F.filter("found", lambda s: s["base"] | (s["kind"].isin(*EXTRA) & (_score(s, weights) >= least)))
    else:
        every = base

    def placed(spans: Column) -> Column:
        return joined(F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"])))

    counts = [_count(k).alias(f"n_{k}") for k in BASE]
    return held.select("doc_id", *counts, F.sha2(placed(base), 256).alias("base_sha256"), placed(every).alias("spans"))


def _count(kind: str) -> Column:
    return F.size(F.filter("found", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
