"""Tokenizer alignment against whole-text encodings compared byte by byte."""

from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from ledgerlake.llm import align, queries

SF = "/root/testdata/sf0.001"
EDGES = [
    (1, None), (2, ""), (3, " "), (4, "\n"), (5, "  two  spaces "), (6, "don't it's 'tis we'll x'sy ('re) \"s 12's"), (7, "a\nb c\n\nd \n e\n"),
    (8, "tab\there nbsp x  em 日本語 naïve 👩‍👩‍👧 \U0001F9FF café é ½² ªº"), (9, "has ▁ in it"), (10, "<s> </s> <0x41> <|endoftext|> <unk>"),
    (11, "x" * 5000), (12, "word " * 3000), (13, "Ünïted ÷ × 3rd 4.5e6 a.b.c --- ... $$$ ### e.g., U.S.A."), (14, "\u0000\u0001\x7f"),
    (15, " lead"), (16, "trail "), (17, "мир Ελλάδα عربى"), (None, "no id"), (13, "same id"), (15, " lead"),
]


def plain(texts, vocabulary):
    """The contract, from the encodings of whole texts."""
    pieces, counts = [], Counter()
    for text in texts:
        data = (" " + (text or "")).encode()
        a = vocabulary.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = vocabulary.b.encode(text) if text else []
        ab, bb = [vocabulary.a_bytes[i] for i in a], [vocabulary.b_bytes[i] for i in b]
        if not text or b"".join(ab) != data or b"".join(bb) != data:
            pieces.append(None)
            continue
        spans = [(i, e - len(x), e) for i, x, e in zip(a, ab, np.cumsum([len(x) for x in ab]).tolist())]
        other = [(i, e - len(x), e) for i, x, e in zip(b, bb, np.cumsum([len(x) for x in bb]).tolist())]
        links = [(i, j) for i, s, e in spans for j, u, v in other if s < v and u < e] if len(spans) * len(other) < 4_000_000 else None
        if links is None:       # the same, walking both
            links, x, y = [], 0, 0
            while x < len(spans):
                links.append((spans[x][0], other[y][0]))
                d = spans[x][2] - other[y][2]
                x, y = x + (d <= 0), y + (d >= 0)
        counts.update(links)
        ends = {e for _, _, e in spans} & {e for _, _, e in other}
        groups, ga, gb = [], [], []
        at = iter(other)
        for i, _, e in spans:
            ga.append(i)
            if e in ends:
                for j, _, v in at:
                    gb.append(j)
                    if v == e:
                        break
                groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                ga, gb = [], []
        pieces.append((len(spans), len(other), groups, links))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for p in pieces:
        if p is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = p
        out.append((n_a, n_b, len(groups), len(links), sum(counts[k] == most[k[1]] for k in links), sum(counts[k] for k in links),
                    sha256(";".join(groups).encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def vocabulary():
    pytest.importorskip("tokenizers"), pytest.importorskip("sentencepiece")
    return align.Vocabulary(queries.byte_bpe_path(), queries.piece_bpe_path())


def check(df, docs, vocabulary, **kw):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = align.align(df, queries.byte_bpe_path, queries.piece_bpe_path, **kw)
    assert got.columns == ["doc_id", *names]
    want = [(i, *r) for (i, _), r in zip(docs, plain([t for _, t in docs], vocabulary))]
    rows = [(r.doc_id, *[r[c] for c in names]) for r in got.collect()]
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r)
    assert sorted(rows, key=key) == sorted(want, key=key)


def test_edges(spark, vocabulary):
    df = spark.createDataFrame([(i, t, "clash") for i, t in EDGES], "doc_id long, text string, n_a string").repartition(3)
    check(df, EDGES, vocabulary)
    check(df, EDGES, vocabulary, bundle_bytes=200)


def test_whole_table(spark, vocabulary):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    check(df, docs, vocabulary)


def test_slices_and_small_caches_change_nothing(spark, vocabulary, monkeypatch):
    text = " ".join(f"word{i} höher, x\n{i}" for i in range(400)) + "  end\t."
    units = align.Units(vocabulary)

    def all_ids(u, seq):
        u.settle()
        return [u.text[k] for k in seq]

    first = all_ids(units, align.units_of(units, text))
    monkeypatch.setattr(align, "SLICE_CHARS", 100)
    monkeypatch.setattr(align, "CHUNK", 3)
    units = align.Units(vocabulary)
    assert ";".join(all_ids(units, align.units_of(units, text))) == ";".join(first) and len(first) > 1000


def test_without_safe_cuts_texts_are_encoded_whole(vocabulary, monkeypatch):
    units = align.Units(vocabulary)
    monkeypatch.setattr(vocabulary, "plain", False)
    for _, text in EDGES:
        if text:
            assert len(align.units_of(units, text)) == 1


def test_long_text(spark, vocabulary):
    text = " ".join(f"w{i % 977} lorem" for i in range(700_000))        # 8 MB
    got = align.align(spark.createDataFrame([(1, text)], "doc_id long, text string"), queries.byte_bpe_path, queries.piece_bpe_path).first()
    assert got.n_links == got.n_a + got.n_b - got.n_groups and got.n_a > 1_400_000 and got.n_groups >= 1_400_000


def test_spans_of_groups(spark, vocabulary):
    df = spark.createDataFrame(EDGES, "doc_id long, text string")
    for r in align.aligned_groups(df, queries.byte_bpe_path, queries.piece_bpe_path).collect():
        if r.start:
            data = b"".join(vocabulary.a_bytes[i] for g in r.a for i in g)
            assert [data[s:e] for s, e in zip(r.start, r.end)] == [b"".join(vocabulary.a_bytes[i] for i in g) for g in r.a]
            assert [data[s:e] for s, e in zip(r.start, r.end)] == [b"".join(vocabulary.b_bytes[i] for i in g) for g in r.b]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert align.align(none, queries.byte_bpe_path, queries.piece_bpe_path).count() == 0
