"""Personal data: base spans against plain Python, and the learnt part."""

import hashlib
import re
from collections import Counter

from ledgerlake.llm import pii

TEXTS = [
    (1, None), (2, ""), (3, "🙂 mail a.b+c@x-y.example.com, a@b@c.de a@b.com.x_y@d.ee .@.@x.y @no.pe a@b. é@q.de"),
    (4, "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0255.000.1.1 9.9.9 10.0.0.1:80 v1.2.3.999"),
    (5, "4111 1111 1111 1111 4111111111111111 4111-1111-1111-1112 12345678901234567890 5  4111111111111111 0 4242424242424242"),
    (6, "+1 (743) 555-3824, +49 30 1234567. +1 +12 +123456789012345678 ++33 1 23 45 67 89- +1  ("),
    (7, "a" * 100_000), (7, "1" * 50_000), (8, "1-" * 30_000), (9, "." * 5000 + "@" + "a." * 3000), (None, "x@y.zz"), (10, "+1 (743) 555-3824\n" * 50),
    (11, "ssn 123-45-6789, call (212) 555-0199 or 212-555-0199, iban DE89 3704 0044 0532 0130 00; 666-00-0000"),
]


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def plain(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)] if "@" in text else []
    found += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))] if "." in text else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end(), "phone"))
    n = Counter(f[3] for f in found)
    spans = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))
    return n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(spans.encode()).hexdigest(), spans


def check(df, docs):
    rows = pii.personal_data(df).collect()
    want = Counter((i, *plain(t)[:5]) for i, t in docs)
    assert Counter(tuple(r)[:6] for r in rows) == want
    spans = Counter((i, s) for i, t in docs for s in plain(t)[5].split(",") if s)
    got = Counter((r.doc_id, s) for r in rows for s in r.spans.split(",") if s)
    assert not spans - got                          # base spans stay
    return got - spans


def test_base_spans_match_plain_python(spark):
    added = check(spark.createDataFrame([(i, t, "clash", True) for i, t in TEXTS], "doc_id long, text string, kind string, base boolean"), TEXTS)
    assert {i for i, _ in added} <= {11}
    assert pii.personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_corpus(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    added = check(df, docs)
    assert len({i for i, _ in added}) < 0.01 * len(docs)


def test_other_kinds_are_learnt(spark):
    docs = [(k, f"Write to user{k}@mail.example.com or call +1 (212) 555-{1000 + k}. My ssn is {100 + k}-45-{6000 + k}, thanks") for k in range(200)]
    docs += [(1000 + k, f"part no x{k}: 000-00-0000z and code 4000{k:08d}7x8") for k in range(100)]
    added = check(spark.createDataFrame(docs, "doc_id long, text string"), docs)
    assert {i for i, s in added if s.startswith("ssn:")} == set(range(200))
    assert not {i for i, _ in added if i >= 1000}


def test_reliabilities_follow_agreement():
    cells = {("a", 1, 1, 1, 1): 500, ("a", -1, -1, 0, -1): 500, ("a", 1, 1, 0, 1): 300, ("a", -1, 1, 0, -1): 50}
    post = pii.reliabilities(cells)
    assert post[("a", 1, 1, 0, 1)] > 0.95 and post[("a", -1, -1, 0, -1)] < 0.05 and post[("a", -1, 1, 0, -1)] < 0.5
