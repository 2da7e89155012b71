"""Secret scans over a trigram inverted index, in DataFrame functions only.

From each rule's pattern a Boolean query over trigrams is derived: an OR of
alternatives, each the trigrams that every match of it must contain.  The
index holds, for the trigrams that some rule asks for, the documents that
contain them; a rule's candidates are the documents in all postings of one of
its alternatives.  Candidates are verified with the pattern itself.  A rule
without mandatory trigrams (a run of hex digits) scans every document.

Cases: a null or empty text has no spans; rows that share an id are candidates
together and verified one by one, and the same holds for rows without an id;
other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as sre, _parser as parser

from pyspark.sql import Column, DataFrame, functions as F

from .spans import joined, ranked, with_matches

#: More alternatives than this are not told apart: the part counts as unknown.
MOST_ALTERNATIVES = 32


@dataclass(frozen=True)
class Rule:
    """``least``: (group, characters) that a match must reach, or it is dropped."""
    kind: str
    pattern: str
    base: bool = False
    least: tuple[int, int] | None = None


#: The base rules, fixed by the task, then formats of well-known credentials.
#: In ``assign`` either case of a letter is spelt out, so that only ASCII
#: letters match; a match of ``hex`` or ``access`` that is long enough is a
#: whole run, so their least lengths are part of the pattern.
#: A private key reaches to its END line; its body has single dashes only (in
#: headers).  Without that line it reaches to the last long run of base64
#: characters and one shorter line.  Single character classes repeat, not
#: groups, so that a long body needs no deep stack; all of it is also RE2.
_KEY_LINE = "[A-Z ]{0,20}PRIVATE KEY-----"
_KEY_END = "[^-]*(?:-[^-]+){0,9}-----END " + _KEY_LINE
_KEY_HEADERS = r"(?:[\x20\t\r\n\\nr]*Proc-Type: 4,ENCRYPTED[\x20\t\r\n\\nr]*DEK-Info: [A-Z0-9-]+,[0-9A-Fa-f]+)?"
_KEY_LINES = _KEY_HEADERS + r"[A-Za-z0-9+/=\x20\t\r\n\\]*[A-Za-z0-9+/=]{32}[A-Za-z0-9+/=]*(?:\x20*(?:\r?\n|(?:\\r)?\\n)[\x20\t]*[A-Za-z0-9+/=]+)?"
_ANY_CASE = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api")) + "_?[kK][eE][yY]"
RULES = (
    Rule("assign", "(" + _ANY_CASE + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", True, (2, 6)),
    Rule("access", "AKIA[A-Z0-9]{16,}", True),
    Rule("hex", "[0-9a-f]{24,}", True),
    Rule("github", "(ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", f"-----BEGIN {_KEY_LINE}(?:{_KEY_END}|{_KEY_LINES})?"),
)


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives, each the lower-case trigrams that a match of it contains;
    None where some match need not contain any."""
    def runs(tokens) -> list[list[str]]:
        """Each alternative as its literal runs; "" ends a run."""
        ways: list[list[str]] = [[""]]
        for op, arg in tokens:
            if op is sre.LITERAL:
                more = [[chr(arg).lower()]]
            elif op is sre.IN and {chr(a).lower() for o, a in arg if o is sre.LITERAL} and len({chr(a).lower() if o is sre.LITERAL else o for o, a in arg}) == 1:
                more = [[chr(arg[0][1]).lower()]]       # one letter in either case
            elif op is sre.SUBPATTERN:
                more = runs(arg[3])
            elif op is sre.BRANCH:
                more = [w for part in arg[1] for w in runs(part)]
            elif op is sre.MAX_REPEAT and arg[:2] == (0, 1):
                more = [[""], *runs(arg[2])] if len(runs(arg[2])) == 1 and all(o is sre.LITERAL for o, _ in arg[2]) else [["", ""]]
            else:
                more = [["", ""]]       # unknown text: it ends the run before and begins another
            if len(ways) * len(more) > MOST_ALTERNATIVES:
                more = [["", ""]]
            ways = [[*w[:-1], w[-1] + m[0], *m[1:]] for w in ways for m in more]
        return ways

    out = []
    for way in runs(parser.parse(pattern)):
        grams = frozenset(run[i:i + 3] for run in way for i in range(len(run) - 2))
        if not grams:
            return None
        out.append(grams)
    return sorted(set(out), key=sorted)


def postings(docs: DataFrame, trigrams: list[str], text: str) -> DataFrame:
    """(trigram, doc_id) for the trigrams that the rules ask for."""
    quoted = "|".join("\\Q" + t + "\\E" for t in trigrams)
    held = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"(?=({quoted}))"), F.lit(1)))
    return docs.select("doc_id", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(doc_id, kinds): the rules of which a document may hold a match."""
    asked = [(k, n, t, len(way)) for k, ways in queries.items() for n, way in enumerate(ways) for t in sorted(way)]
    wanted = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(n).alias("way"), F.lit(size).alias("size"), F.lit(t).alias("t")) for k, n, t, size in asked])
    hits = index.withColumn("q", F.explode(F.filter(wanted, lambda w: w["t"] == F.col("trigram")))).select("doc_id", "q.kind", "q.way", "q.size", "trigram")
    met = hits.distinct().groupBy("doc_id", "kind", "way", "size").agg(F.count(F.lit(1)).alias("n")).where("n = size")
    return met.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def _verified(held: DataFrame, id_col: str, text_col: str, rules: tuple[Rule, ...]) -> DataFrame:
    """``held`` with an array of matches for each rule: candidates from the
    index, verified with the rule's pattern."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    trigrams = sorted({t for ways in queries.values() for way in ways for t in way})
    index = postings(held.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), trigrams, "text")
    found = candidates(index, queries).select(F.col("doc_id").alias("__id"), F.col("kinds").alias("__kinds"))
    held = held.join(found, F.col(id_col).eqNullSafe(F.col("__id")), "left").drop("__id")

    def gate(r: Rule) -> Column:
        return F.coalesce(F.array_contains("__kinds", r.kind), F.lit(False)) if r.kind in queries else F.col(text_col).rlike(r.pattern)

    out = with_matches(held, text_col, {r.kind: (r.pattern, gate(r)) for r in rules})
    return out.withColumns({f"__m_{r.kind}": _long_enough(r) for r in rules}).drop("__kinds")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, ``text`` and, for each rule, an array of its (start, end, ...)."""
    held = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return _verified(held, "doc_id", "text", rules)


def _long_enough(rule: Rule) -> Column:
    """The rule's matches without those that fail its least length."""
    found = F.col(f"__m_{rule.kind}")
    if not rule.least:
        return found
    group, least = rule.least
    return F.filter(found, lambda m: F.length(F.regexp_extract(m["hit"], rule.pattern, group)) >= least)


def secrets_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: base counts, the base digest and all spans."""
    found = scan(docs, id_col, text_col, rules)
    every = [(r, ranked(F.col(f"__m_{r.kind}"), r.kind, k)) for k, r in enumerate(rules)]
    counts = [F.size(f"__m_{r.kind}").cast("long").alias(f"n_{r.kind}") for r in rules if r.base]
    return found.select("doc_id", *counts, F.sha2(joined(F.concat(*[s for r, s in every if r.base])), 256).alias("base_sha256"),
                        joined(F.concat(*[s for _, s in every])).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents with every secret replaced by `[kind]`; all columns stay.
    Spans that overlap become one replacement, named by the first."""
    names = {c: f"__c{k}" for k, c in enumerate(docs.columns)}
    text = names[text_col]
    found = _verified(docs.toDF(*names.values()), names[id_col], text, rules)
    parts = [ranked(F.col(f"__m_{r.kind}"), r.kind, k) for k, r in enumerate(rules)]
    found = found.withColumn("__spans", F.array_sort(F.concat(*parts)))
    t = F.col(text)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        whole, begin = s["start"] >= acc["at"], F.greatest(s["start"], acc["at"])
        gap = F.substring(t, (acc["at"] + 1).cast("int"), (begin - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(whole, F.concat(acc["out"], gap, F.lit("["), s["kind"], F.lit("]"))).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("__spans", start, step, lambda acc: F.concat(acc["out"], F.substring(t, (acc["at"] + 1).cast("int"), F.length(t))))
    found = found.withColumn(text, F.when(F.size("__spans") > 0, clean).otherwise(t))
    return found.select(*[F.col(v).alias(c) for c, v in names.items()])

