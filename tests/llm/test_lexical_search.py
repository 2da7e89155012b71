"""Ranked search against scores of every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import search

SF = "/root/testdata/sf0.001"
DOCS = [
    (1, "the cat sat on the mat"), (2, "The CAT"), (3, None), (4, ""), (5, "!!! ---"), (6, "the " * 500), (7, "mat cat dog"), (8, "mat cat dog"),
    (8, "mat dog cat"), (None, "mat cat dog"), (9, "Ünïcode CAFÉ ünïcode"), (10, "filler words only here"), (11, "x" * 3000 + " cat"),
]
ITEMS = [(1, "cat mat"), (2, "cat cat the"), (3, None), (4, "?"), (5, "ünïcode"), (6, "absent words"), (1, "dog"), (7, "the the the the")]


def terms(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", folded)


def plain(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = {}
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 25 + 75 * sum(b.values()) * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in terms(text) if b[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out.setdefault(item, []).extend([(i if not none else None, -s) for s, none, i in sorted(scores)[:k]])
    return out


def check(spark, docs, items, n=1, k=10, **kw):
    d = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, rank string").repartition(n)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    got = {}
    for r in search.search(search.build_index(d, **kw), q, k).collect():
        got.setdefault(r.item_id, {})[r["rank"]] = (r.doc_id, r.score)
    want = {i: x for i, x in plain(docs, items, k).items() if x}
    assert set(got) == set(want)
    for item, x in want.items():
        ranks = got[item]
        assert sorted(ranks) == list(range(1, len(x) + 1))
        if sum(i == item for i, _ in items) > 1:
            x = sorted(x, key=lambda p: (-p[1], p[0] is None, p[0] or 0))
        assert [ranks[j] for j in sorted(ranks)] == x


def test_edges(spark):
    check(spark, DOCS, ITEMS)
    check(spark, DOCS, ITEMS, 4, shard_bytes=20, block=2)


def test_many_documents_any_shards(spark):
    rng = np.random.default_rng(5)
    words = [f"t{int(i)}" for i in (rng.pareto(0.7, 60_000) * 3) % 4000]
    docs, at = [], 0
    for i, n in enumerate(rng.integers(1, 120, 900).tolist()):
        docs.append((i, " ".join(words[at % 50_000:at % 50_000 + n])))
        at += n
    items = [(j, " ".join(rng.choice(words, 12))) for j in range(25)]
    check(spark, docs, items, 1)
    check(spark, docs, items, 3, shard_bytes=4000, block=8)
    check(spark, docs, items, 2, k=1)


def test_blocks_are_rejected_before_they_are_read(monkeypatch):
    """Candidates whose bound cannot reach the heap leave blocks of the
    frequent, low-weight list unread, and nothing changes."""
    n = 6400
    words, names = [], ["rare", "common", "pad"]
    for i in range(n):
        rare = 3 if i < 20 else int(i % 64 == 1)
        words.append(np.array([0] * rare + [1] + [2] * (3 - rare), np.int32))      # all of one length
    batches = list(search._shard_rows(0, list(range(n)), [len(w) for w in words], words, names, 64))
    rows = {r["term"]: r for b in batches for r in b.to_pylist()}
    m = np.full(n, 100, np.int64)
    reads, plain_read = Counter(), search.Postings.read
    blocks = len(rows["common"]["block_last"])

    def lists():
        made = [(w, search.Postings(r["postings"], r["block_bytes"], r["block_last"], r["block_tf"], r["block_n"], m, lambda k: np.full(len(k), 100)))
                for w, r in ((9000, rows["rare"]), (3, rows["common"]))]
        names.update({id(p): w for w, p in made})
        return made

    def read(self, some):
        reads[names[id(self)]] += len(some)
        return plain_read(self, some)

    names = {}
    monkeypatch.setattr(search.Postings, "read", read)
    place, score = search.best_of_shard(lists(), np.arange(n), 10)
    assert 0 < reads[3] < blocks / 10
    every = [(w * int(i), d) for w, p in lists() for d, i in zip(*p.whole())]
    total = Counter()
    for s, d in every:
        total[int(d)] += s
    want = sorted(total.items(), key=lambda x: (-x[1], x[0]))[:10]
    assert list(zip(place.tolist(), score.tolist())) == want


def test_codec():
    values = np.array([0, 1, 127, 128, 300, 2**20, 2**34, 5, 2**62], np.int64)
    data, lens = search.vbyte(values)
    assert search.unvbyte(data).tolist() == values.tolist() and lens.sum() == len(data)


def test_long_text_and_slices(monkeypatch):
    text = " ".join(f"W{i}é" for i in range(300_000))
    whole = [t for some in search.terms_of(text) for t in some]
    assert whole == terms(text) and len(list(search.terms_of(text))) > 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search.search(search.build_index(none), items).count() == 0
    some = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert search.search(search.build_index(some), items.limit(0)).count() == 0


@pytest.mark.parametrize("items", [7])
def test_whole_table(spark, items):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    asked = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][:items]
    check(spark, docs, asked, 3, shard_bytes=60_000)
