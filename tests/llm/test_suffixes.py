"""Two-stage suffix sorting and exact substring removal against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np

from ledgerlake.llm import suffixes


def plain(docs):
    seen = Counter()
    data = [(t or "").encode() for _, t in docs]
    for b in data:
        seen.update(b[k:k + 200] for k in range(len(b) - 199))
    for (i, _), b in zip(docs, data):
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k:k + 200]] > 1:
                gone[k:k + 200] = b"\1" * 200
        runs = sum(1 for k, x in enumerate(gone) if x and (not k or not gone[k - 1]))
        yield i, len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, x in zip(b, gone) if not x)).hexdigest()


def corpus():
    rng = random.Random(3)

    def prose(n):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(n))

    passage, short, base = prose(60), prose(25), prose(300)
    docs = [(1, None), (2, ""), (3, "x" * 199), (4, "x" * 200), (5, "x" * 450), (6, "ab" * 300), (7, "\0" * 300), (None, prose(90))]
    docs += [(10 + k, prose(30) + passage + prose(40)) for k in range(12)]
    docs += [(40 + k, prose(20) + short + prose(20)) for k in range(12)]
    docs += [(60 + k, base) for k in range(3)] + [(60, base), (None, base)]
    for k in range(10):
        w = base.split()
        for _ in range(k):
            w[rng.randrange(len(w))] = "edited"
        docs.append((80 + k, " ".join(w)))
    docs.append((99, (p := prose(45)) + prose(3) + p))
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id long, text string, row string, n_bytes int")


def test_order_of_some_starts_is_that_of_all():
    rng = np.random.default_rng(4)
    piece = rng.integers(97, 101, 260)
    for text in (rng.integers(97, 100, 3000), np.tile(piece, 9), np.concatenate([piece, rng.integers(97, 101, 300), piece]), np.full(900, 97), np.repeat(rng.integers(97, 103, 60), 30)):
        text = text.astype(np.uint8)
        raw, at = text.tobytes(), np.arange(len(text))
        string = suffixes.Rolling(text)(at, np.minimum(at + 200, len(text)))
        for starts in (np.arange(0, len(raw) - 199, 7), np.arange(50, 120), np.array([0])):
            order, _ = suffixes.suffix_order(text, starts, string)
            assert set(starts.tolist()) <= set(order.tolist()) and len(set(order.tolist())) == len(order)
            cut = [raw[k:k + 200] for k in order.tolist()]
            assert all(a <= b for a, b in zip(cut, cut[1:]))


def test_contexts_without_a_shared_half_are_left_out():
    gram = bytes(range(64))
    shared, other = b"s" * 136, b"o" * 136
    rows = [(1, 1, 1, 136, shared + gram + b"a" * 136), (1, 2, 1, 136, shared + gram + b"b" * 136), (1, 3, 1, 136, other + gram + b"c" * 136),
            (2, 4, 1, 136, other + gram + b"d" * 136), (1, 5, 2, 0, gram + b"e" * 136), (1, 6, 1, 40, b"f" * 40 + gram + b"a" * 136)]
    assert [r[1] for r in suffixes._likely(rows)] == [1, 2, 5, 6]


def test_suffix_order():
    rng = np.random.default_rng(0)
    for text in (rng.integers(97, 100, 3000), rng.integers(0, 256, 3000), np.full(700, 97), np.tile([98, 97], 400), np.repeat(rng.integers(97, 103, 40), 30), np.array([5])):
        text = text.astype(np.uint8)
        order, _ = suffixes.suffix_order(text)
        raw = text.tobytes()
        assert sorted(order.tolist()) == list(range(len(raw)))
        cut = [raw[k:k + 200] for k in order.tolist()]
        assert all(a <= b for a, b in zip(cut, cut[1:]))


def test_removal_matches_brute_force(spark, monkeypatch):
    docs = corpus()
    want = Counter(plain(docs))
    assert Counter(tuple(r) for r in suffixes.dedup(frame(spark, docs)).collect()) == want
    monkeypatch.setattr(suffixes, "BLOCK_CONTEXTS", 2)      # large groups counted by hash
    assert Counter(tuple(r) for r in suffixes.dedup(frame(spark, docs)).collect()) == want
    assert sum(w[2] > 0 for w in want) > 20


def test_corpus_and_empty(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = Counter(plain([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]))
    assert Counter(tuple(r) for r in suffixes.dedup(df).collect()) == want
    assert suffixes.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    kept = {r.doc_id: r for r in suffixes.dedup(df, with_text=True).collect()}
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in kept.values())
