"""Packing, quality rules and decontamination against plain-Python versions."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest

from ledgerlake.llm import decontaminate, packing, quality, queries

EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one two three one two three"), (5, "a\nb c\na\nb c\n\n \n"),
    (6, "é ñandú é ñandú é ñandú\x0bx\x1cy"), (7, "w " * 3000), (8, "rep eat ed line here\n" * 40), (9, "x" * 50000),
    (10, "CAPS'S don't I'LL we've №5 ½ ﬁ İstanbul Σίσυφος <|endoftext|> 日本語 naïve²"), (10, "same id again"), (None, "no id"),
]
FOLDED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def edges(spark):
    rows = [(i, t, "n_words clash", True) for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, kept boolean")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def rows(df):
    return [r.asDict() for r in df.collect()]


def docs_of(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


SF = "/root/testdata/sf0.001"


# -- packing -------------------------------------------------------------------
def check_pieces(pieces, docs):
    tokenizers = pytest.importorskip("tokenizers")
    tok = tokenizers.Tokenizer.from_file(queries.word_bpe_path())
    tok.encode_special_tokens = True
    want = Counter()
    for i, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        want[(i, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))] += 1
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p["length"] > 0 and p["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(p['ids'])}I", *p["ids"]))
        by_doc[(p["doc_id"], p["doc_tokens"])].append(p)
        by_seq[p["sequence_id"]].append(p)
    got = Counter()
    for (i, n), ps in by_doc.items():
        ps.sort(key=lambda p: p["start"])
        if sum(p["length"] for p in ps) != n:
            continue    # repeated rows share these keys; counted by their ids elsewhere
        ids = [x for p in ps for x in p["ids"]]
        assert [p["start"] for p in ps] == [sum(q["length"] for q in ps[:k]) for k in range(len(ps))]
        got[(i, n, zlib.crc32(struct.pack(f"<{n}I", *ids)))] += 1
    assert got == want
    for ps in by_seq.values():
        ps.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in ps] == [sum(q["length"] for q in ps[:k]) for k in range(len(ps))]
        assert sum(p["length"] for p in ps) <= packing.CAPACITY
    return [sum(p["length"] for p in ps) for ps in by_seq.values()]


def test_packing_edges_and_corpus(spark):
    check_pieces(rows(packing.pack(edges(spark), queries.word_bpe_path, with_ids=True)), EDGES)
    used = check_pieces(rows(packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), queries.word_bpe_path, with_ids=True)), docs_of(spark, SF))
    padding = sum(packing.CAPACITY - n for n in used if n & (n - 1))
    assert padding <= 0.05 * sum(used)
    assert packing.pack(empty(spark), queries.word_bpe_path).count() == 0


def test_classes_hold_a_fixed_count():
    bins, done = packing.HarmonicBins(2048, 0), []
    for k in range(100):
        done += bins.add((k, 0, 60, 0, 60, None))
    counts = Counter(r[-2] for r in done)
    assert set(counts.values()) == {2048 // 60}
    done += bins.finish()
    assert sorted(r[0] for r in done) == list(range(100))


# -- quality -------------------------------------------------------------------
def plain_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup, dup_chars, chars = set(), 0, 0, 0
    for line in text.split("\n"):
        if not re.search(r"[^\x20\x09-\x0D]", line):
            continue
        chars += len(line)
        if line in seen:
            dup, dup_chars = dup + 1, dup_chars + len(line)
        seen.add(line)

    def inside(n):
        grams = [tuple(words[k:k + n]) for k in range(len(words) - n + 1)]
        counts = Counter(grams)
        return {k + j for k, g in enumerate(grams) if counts[g] > 1 for j in range(n)}

    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
           "n_dup_lines": dup, "n_repeat_words": len(inside(3)), "dup_line_chars": dup_chars, "line_chars": chars}
    for n in quality.GRAMS:
        out[f"dup{n}_chars"] = sum(len(words[k]) for k in inside(n))
    out["base_failed"] = out["n_words"] < 50 or 100 * out["n_repeat_words"] > 50 * out["n_words"]
    bad = 100 * dup_chars > 20 * chars or 100 * out["n_symbols"] > 10 * out["n_words"] \
        or any(100 * out[f"dup{n}_chars"] > m * out["word_chars"] for n, m in quality.MAX_GRAM_PERCENT.items())
    return out | {"kept": not out["base_failed"] and not bad}


def test_quality_matches_plain_python(spark):
    for docs, df in ((EDGES, edges(spark)), (docs_of(spark, SF), spark.read.parquet(f"{SF}/documents.parquet"))):
        want = Counter(tuple(sorted((plain_quality(t) | {"doc_id": i}).items(), key=lambda x: x[0])) for i, t in docs)
        got = Counter(tuple(sorted(r.items(), key=lambda x: x[0])) for r in rows(quality.quality_report(df)))
        assert got == want
    assert quality.quality_report(empty(spark)).count() == 0


def test_quality_filter_keeps_all_columns(spark):
    df = edges(spark)
    out = quality.quality_filter(df)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == {i for i, t in EDGES if plain_quality(t)["kept"]}


# -- decontamination -------------------------------------------------------------
def alnum(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(FOLDED))


def plain_contamination(docs, items):
    windows = defaultdict(set)
    for i, t in items:
        w = alnum(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k:k + 10])].add(str(i))
    sizes = {len(w) for w in windows}
    for i, t in docs:
        w = alnum(t)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k:k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[g]
        yield (i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))


ITEMS = [(1, "rep eat ed LINE here rep eat ed line here again"), (2, None), (3, ""), (10, "two three"), (11, "w"), (12, "Ñandú é"), (12, "no id"), (7, "one, two - three; one")]


def test_contamination_matches_plain_python(spark, monkeypatch):
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")
    want = Counter(plain_contamination(EDGES, ITEMS))
    assert Counter(tuple(r) for r in decontaminate.contamination(edges(spark), items).collect()) == want
    clean = decontaminate.decontaminate(edges(spark), items)
    assert Counter(r.doc_id for r in clean.collect()) == Counter(w[0] for w in want.elements() if not w[5])
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = Counter(plain_contamination(docs_of(spark, SF), [tuple(r) for r in bench.select("item_id", "text").collect()]))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert Counter(tuple(r) for r in decontaminate.contamination(docs, bench).collect()) == want
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 40)       # several blocks of the query set
    assert Counter(tuple(r) for r in decontaminate.contamination(docs, bench).collect()) == want
    assert any(w[5] for w in want)


def test_contamination_of_rows_that_share_an_id_or_have_none(spark, monkeypatch):
    rng = random.Random(4)
    vocab = [f"w{k}" for k in range(400)]
    items = [(f"i{k}", " ".join(rng.choice(vocab) for _ in range(25))) for k in range(6)]
    docs = []
    for k, doc in enumerate((None, None, None, 7, 7, 7, 8, 9)):
        own = [rng.choice(vocab) for _ in range(30 + k)]
        docs.append((doc, " ".join([*own, *(items[k % 6][1].split()[:12] if k % 3 else []), *(items[(k + 2) % 6][1].split()[3:20] if k % 2 else [])])))
    docs += [docs[1], docs[1], docs[4], (7, None), (None, None), (None, ""), (None, items[0][1])]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = Counter(plain_contamination(docs, items))
    assert len(docs) == sum(want.values()) and any(r[0] is None and r[-1] for r in want)
    for size in (200_000, 20, 7):
        monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", size)
        assert Counter(tuple(r) for r in decontaminate.contamination(table, bench).collect()) == want


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.contamination(edges(spark), none).collect())
    some = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination(empty(spark), some).count() == 0
