"""Near duplicates against all pairs of sets on a small corpus."""

import random
import re

import numpy as np

from ledgerlake.llm import neardup
from ledgerlake.llm.arrays import utf8

import pyarrow as pa

FOLDED = {c: c + 32 for c in range(65, 91)}


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLDED))
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def plain(docs):
    """component of every id, over all pairs that share a shingle"""
    sets = [shingle_set(t) for _, t in docs]
    parent = {i: i for i, _ in docs if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for k, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(k)
    for a in range(len(docs)):
        for b in {k for g in sets[a] for k in where[g] if k > a}:
            both = len(sets[a] & sets[b])
            if None not in (docs[a][0], docs[b][0]) and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(docs[a][0]), root(docs[b][0])))
                parent[y] = x
    return sorted(((i, len(s), None if i is None else root(i)) for (i, _), s in zip(docs, sets)), key=str)


def got(df):
    out = neardup.near_duplicates(df).collect()
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in out)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str)


def corpus():
    rng = random.Random(5)
    vocab = [f"w{k}" for k in range(900)]
    docs = [(1000, None), (1001, ""), (1002, "a b"), (1003, "A  b\n"), (1004, "a b c"), (None, "a b c"), (1005, "x" * 3000), (1006, "z " * 4000)]
    base = [rng.choice(vocab) for _ in range(220)]
    for k in range(60):         # copies of one text, with more and more words changed
        w = list(base)
        for _ in range(k // 4):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        docs.append((k * 7 % 60, " ".join(w)))
    for k in range(40):         # texts that share one passage
        docs.append((100 + k, " ".join([*base[:30], *(rng.choice(vocab) for _ in range(150))])))
    return docs + [(200, docs[20][1]), (201, docs[20][1].upper()), (99, docs[60][1])]


def test_components_match_all_pairs(spark, monkeypatch):
    docs = corpus()
    df = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, component_id long")
    want = plain(docs)
    assert got(df) == want
    monkeypatch.setattr(neardup, "BLOCK_SET_BYTES", 16_000)     # a group of many blocks
    assert got(df) == want
    kept = neardup.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({str(i) for i, _, c in want if i == c})


def test_large_family_is_not_compared_blockwise_with_itself(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"v{rng.randrange(5000)}" for _ in range(200)]
    docs = []
    for k in range(240):        # near copies of one text, each with a word of its own
        w = list(base)
        w[rng.randrange(len(w))] = f"own{k}"
        docs.append((k, " ".join(w)))
    docs += [(1000 + k, " ".join([*base[:110], *(f"far{k}x{n}" for n in range(90))])) for k in range(3)]
    seen, inner = [], neardup.compared

    def counted(texts, placed, *cols):
        seen.append(placed.selectExpr("coalesce(sum(size(meets)), 0)").first()[0])
        return inner(texts, placed, *cols)

    monkeypatch.setattr(neardup, "compared", counted)
    monkeypatch.setattr(neardup, "BLOCK_SET_BYTES", 16_000)     # some 24 blocks
    assert got(spark.createDataFrame(docs, "doc_id long, text string")) == plain(docs)
    assert sum(seen) < 4 * len(docs)


def test_short_texts_of_one_template_take_bounded_blocks(spark):
    """Thousands of short texts that share bands but are no links: no task
    holds more than BLOCK_DOCS of each side, and the whole stays quick."""
    rng = random.Random(2)
    base = [f"t{k}" for k in range(14)]
    docs = [(k, " ".join([*base[:10], *(f"own{k}x{n}" for n in range(1 + rng.randrange(4)))])) for k in range(9000)]
    from time import time
    began = time()
    rows = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert time() - began < 150
    short = {i: shingle_set(t) for i, t in docs}
    own = {r.doc_id: r.component_id for r in rows}
    for i, j in ((rng.randrange(9000), rng.randrange(9000)) for _ in range(3000)):
        if i != j and 100 * len(short[i] & short[j]) >= 75 * len(short[i] | short[j]):
            assert own[i] == own[j]


def test_rows_that_share_an_id_are_kept_by_their_text(spark):
    rng = random.Random(6)
    text = lambda: " ".join(f"v{rng.randrange(9000)}" for _ in range(80))
    a, b, c = text(), text(), text()
    docs = [(1, a), (1, b), (1, a), (2, b + " end"), (3, c), (3, None), (None, a), (None, a), (4, "")]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, __clash string")
    kept = sorted(((r.doc_id, r.text) for r in neardup.drop_near_duplicates(df).collect()), key=str)
    # a and b of id 1 are different documents; 2 is a near copy of one of them
    assert kept == sorted([(1, a), (1, b), (3, c), (3, None), (None, a), (None, a), (4, "")], key=str)
    assert neardup.drop_near_duplicates(df).columns == df.columns
    assert neardup.drop_near_duplicates(df.limit(0)).count() == 0


def test_corpus_and_empty(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(df) == plain([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 900).astype(np.uint64)

    def sketch(k):
        return neardup.sketch(np.zeros(len(k), np.int64), np.sort(k), 1)[0]

    a, b = keys[:600], keys[300:]
    ra, rb = sketch(a), sketch(b)
    assert (neardup.merge(ra, rb) == sketch(keys)).all()
    one = np.array([600.0])
    j = neardup.estimate(np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]), one, one)[0]
    assert abs(j - 1 / 3) < 0.15


def test_utf8_slices():
    data, off = utf8(pa.array(["a", None, "éé", ""]).slice(1, 3))
    assert data.tobytes() == "éé".encode() and off.tolist() == [0, 0, 4, 4]
