"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import align, chat, classify, decontaminate, neardup, packing, passages, pii, quality, search, secrets, sharding, suffixes
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def word_bpe_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), word_bpe_path)


@query
def op2_quality_rules(spark, sf_dir):
    return quality.quality_report(table(spark, sf_dir, "documents"))


@query
def op3_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_suffix_dedup(spark, sf_dir):
    return suffixes.dedup(table(spark, sf_dir, "documents"))


@query
def op7_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


#: A conversation of control strings, which every run formats too.
CONTROL_ROWS = """SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)"""


@query
def op8_shared_passages(spark, sf_dir):
    return passages.shared_passages(table(spark, sf_dir, "documents"))


@query
def op9_chat_formatting(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    records = chat.records_of(said.unionByName(spark.sql(CONTROL_ROWS)))
    return chat.digest(chat.read_back(chat.formatted(chat.canonical_turns(records))))


def _escaped_length(text: str, pairs) -> str:
    for a, b in pairs:
        a, b = (f"'{x}'" if x != "\n" else "chr(10)" for x in (a, b))
        text = f"replace({text}, {a}, {b})"
    return f"length({text})"


ORACLES["op9_chat_formatting"] = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
loss AS (SELECT conv_id, string_agg(text, '' ORDER BY turn, role, text) AS t FROM said WHERE role = 'assistant' GROUP BY conv_id)
SELECT said.conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  length(coalesce(any_value(loss.t), '')) AS loss_chars, sha256(coalesce(any_value(loss.t), '')) AS loss_sha256,
  CAST(sum({len(chat.OPEN) + len(chat.CLOSE) + 2} + {_escaped_length('role', chat.ROLE_ESCAPES)} + {_escaped_length('text', chat.ESCAPES)}) AS BIGINT) AS formatted_chars
FROM said LEFT JOIN loss ON said.conv_id = loss.conv_id GROUP BY said.conv_id
"""


@query
def op6_secret_scan(spark, sf_dir):
    return secrets.secrets_report(table(spark, sf_dir, "documents"))


def _places(kind: str, rank: int, pattern: str, keep: str = "true") -> str:
    """DuckDB: the places of a pattern's matches, from their lengths and those
    of the pieces between them."""
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""SELECT doc_id, '{kind}' AS kind, {rank} AS rank, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0) AS s, length(h[i]) AS n
      FROM (SELECT doc_id, h, g, unnest(range(1, len(h) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, {p}) AS h, string_split_regex(text, {p}) AS g FROM docs)) WHERE {keep.format(p=p)}"""


def _span_sql(parts: list[str], base: list[str]) -> str:
    one = "kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT)"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in base)
    inside = ", ".join(f"'{k}'" for k in base)
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), found AS ({' UNION ALL '.join(parts)})
SELECT docs.doc_id, {counts},
  sha256(coalesce(string_agg({one}, ',' ORDER BY s, rank) FILTER (kind IN ({inside})), '')) AS base_sha256,
  coalesce(string_agg({one}, ',' ORDER BY s, rank), '') AS spans
FROM docs LEFT JOIN found ON docs.doc_id = found.doc_id GROUP BY docs.doc_id"""


ORACLES["op6_secret_scan"] = _span_sql(
    [_places(r.kind, k, r.pattern, f"length(regexp_extract(h[i], {{p}}, {r.least[0]})) >= {r.least[1]}" if r.least else "true") for k, r in enumerate(secrets.RULES)],
    [r.kind for r in secrets.RULES if r.base])


@query
def op10_personal_data(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


@query
def op11_lexical_search(spark, sf_dir):
    return search.search(search.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def byte_bpe_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op12_tokenizer_alignment(spark, sf_dir):
    return align.align(table(spark, sf_dir, "documents"), byte_bpe_path, piece_bpe_path)


@query
def op13_quality_classifier(spark, sf_dir):
    return classify.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# ---- SQL of the word operators -------------------------------------------------------------
#: Words between white space, and words of digits, a-z and all beyond ASCII.
SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A-Z to a-z, nothing else.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _windows(words: str, size: str) -> str:
    """DuckDB: each window of ``size`` consecutive words, joined by a character
    that no word holds."""
    return f"list_transform(range(1, len({words}) - {size} + 2), lambda i: array_to_string({words}[i:i + {size} - 1], ' '))"


def _quality_sql() -> str:
    lengths = [3, *quality.GRAMS]
    union = " UNION ALL ".join(
        f"SELECT doc_id, {n} AS n, unnest({_windows('w', str(n))}) AS g, unnest(range(1, len(w) - {n} + 2)) AS pos FROM docs" for n in lengths)
    dups = ", ".join(f"coalesce(sum(length(w[k])) FILTER (n = {n}), 0) AS dup{n}_chars" for n in quality.GRAMS)
    bad = " OR ".join([f"100 * dup_line_chars > {quality.MAX_LINE_PERCENT} * line_chars", f"100 * n_symbols > {quality.MAX_SYMBOL_PERCENT} * n_words",
                       *[f"100 * dup{n}_chars > {most} * word_chars" for n, most in quality.MAX_GRAM_PERCENT.items()]])
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w FROM documents),
places AS ({union}),
twice AS (SELECT doc_id, n, pos FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, n, g) > 1),
covered AS (SELECT DISTINCT doc_id, n, k FROM (SELECT doc_id, n, unnest(range(pos, pos + n)) AS k FROM twice)),
grams AS (SELECT doc_id, count(*) FILTER (n = 3) AS n_repeat_words, {dups} FROM covered JOIN docs USING (doc_id) GROUP BY doc_id),
lines AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) AS nth
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '{SPACED}')),
lined AS (SELECT doc_id, count(*) FILTER (nth > 1) AS n_dup_lines, coalesce(sum(length(line)) FILTER (nth > 1), 0) AS dup_line_chars, sum(length(line)) AS line_chars FROM lines GROUP BY doc_id),
measured AS (SELECT docs.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, {', '.join(f'coalesce({c}, 0) AS {c}' for c in ['n_dup_lines', 'n_repeat_words', 'dup_line_chars', 'line_chars', *[f'dup{n}_chars' for n in quality.GRAMS]])}
  FROM docs LEFT JOIN grams ON docs.doc_id = grams.doc_id LEFT JOIN lined ON docs.doc_id = lined.doc_id),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, {', '.join(f'CAST({m} AS BIGINT) AS {m}' for m in quality.MEASURES)}, base_failed, NOT base_failed AND NOT ({bad}) AS kept FROM judged"""


ORACLES["op2_quality_rules"] = _quality_sql()

ORACLES["op3_near_duplicates"] = f"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{SPACED}') AS w FROM documents),
sets AS (SELECT doc_id, list_sort(list_distinct({_windows('w', f'least({neardup.SHINGLE}, len(w))')})) AS s FROM docs WHERE len(w) > 0),
node AS (SELECT doc_id, len(s) AS n, min(doc_id) OVER (PARTITION BY s) AS rep FROM sets),
grams AS (SELECT rep AS doc_id, n, unnest(s) AS g FROM node JOIN sets USING (doc_id) WHERE rep = doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
    AND 100 * a.n >= {neardup.LINK_PERCENT} * b.n AND 100 * b.n >= {neardup.LINK_PERCENT} * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {neardup.LINK_PERCENT} * (a.n + b.n - count(*))),
reach AS (SELECT rep AS x, rep AS y FROM node
  UNION SELECT reach.x, ways.b FROM reach JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) AS ways ON reach.y = ways.a),
least_of AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, documents.doc_id) AS component_id, coalesce(component_id, documents.doc_id) = documents.doc_id AS kept
FROM documents LEFT JOIN node ON documents.doc_id = node.doc_id LEFT JOIN least_of ON rep = x"""

ORACLES["op4_decontamination"] = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{ALNUM}') AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, '{ALNUM}') AS w FROM benchmark),
sought AS (SELECT DISTINCT item_id, least({decontaminate.WINDOW}, len(w)) AS n, unnest({_windows('w', f'least({decontaminate.WINDOW}, len(w))')}) AS g FROM items WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM sought),
places AS (SELECT doc_id, n, unnest({_windows('w', 'n')}) AS g, unnest(range(1, len(w) - n + 2)) AS pos FROM docs, sizes),
found AS (SELECT doc_id, item_id, n, pos FROM places JOIN sought USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS k FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT docs.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit ON docs.doc_id = hit.doc_id LEFT JOIN named ON docs.doc_id = named.doc_id"""

ORACLES["op5_suffix_dedup"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
starts AS (SELECT r, unnest(range(1, octet_length(b) - {suffixes.LENGTH - 2})) AS i, b FROM docs WHERE octet_length(b) >= {suffixes.LENGTH}),
keyed AS (SELECT r, i, md5_number(b[i:i + {suffixes.LENGTH - 1}]) AS g FROM starts),
twice AS (SELECT r, i FROM keyed WHERE g IN (SELECT g FROM keyed GROUP BY g HAVING count(*) > 1)),
steps AS (SELECT r, i, i > coalesce(max(i) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -{suffixes.LENGTH}) + {suffixes.LENGTH} AS fresh FROM twice),
runs AS (SELECT r, k, min(i) AS a, max(i) + {suffixes.LENGTH} AS z FROM (SELECT r, i, sum(CAST(fresh AS INT)) OVER (PARTITION BY r ORDER BY i) AS k FROM steps) GROUP BY r, k),
pieces AS (SELECT r, a, z, lag(z, 1, 1) OVER (PARTITION BY r ORDER BY a) AS before FROM runs),
cut AS (SELECT pieces.r, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS last, string_agg(hex(b[before:a - 1]), '' ORDER BY a) AS head FROM pieces JOIN docs ON docs.r = pieces.r GROUP BY pieces.r)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || hex(b[coalesce(last, 1):]))) AS kept_sha256
FROM docs LEFT JOIN cut ON docs.r = cut.r"""

_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ORACLES["op11_lexical_search"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_TERMS}') AS w FROM documents),
lens AS (SELECT r, doc_id, len(w) AS n FROM docs WHERE len(w) > 0),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS l FROM lens),
posts AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) GROUP BY r, t),
freq AS (SELECT t, count(*) AS df FROM posts GROUP BY t),
items AS (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERMS}')) AS t FROM benchmark),
uses AS (SELECT item_id, t, count(*) AS times FROM items GROUP BY item_id, t),
weighed AS (SELECT item_id, t, times * CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM uses JOIN freq USING (t), total),
scored AS (SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // l)))) AS BIGINT) AS score
  FROM weighed JOIN posts USING (t) JOIN lens USING (r), total GROUP BY item_id, r),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored JOIN lens USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""
