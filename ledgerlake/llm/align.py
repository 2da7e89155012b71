"""Alignment of two tokenizers over the same bytes.

Tokenizer A (byte-level BPE, ``tokenizers``) reads a space and the text,
tokenizer B (BPE with byte fallback, ``sentencepiece``) reads the text and adds
that space itself.  A token's place is found in two steps.  Character offsets
of A and proto spans of B are coarse cuts: they place every token that ends
with a character.  Tokens inside a character (pieces of a multi-byte character
in A, byte-fallback tokens in B) share its span; they are placed by the bytes
that their entries decode to, counted from the coarse cut before them.  (The
installed sentencepiece has withdrawn ``immutable_proto``; ``proto`` gives the
same spans.)

Byte offsets where a token of A and one of B both end cut a text into groups.
Any two tokens that overlap share exactly one stretch between neighbouring
ends of either kind, so the links of a text are the distinct ends.

Work: a worker cuts its texts into units at places that neither tokenizer joins
over (``Vocabulary.plain``) and encodes each distinct unit once.  About
BUNDLE_BYTES of texts form a bundle.  A bundle is written to the shared folder
with its distinct id pairs and their numbers.  Spark adds up the pairs of all
bundles, finds the highest count of each B id, and joins these totals back to
the bundles by id pair; no table of pairs is broadcast or held by one task, and
a key's rows are at most one a bundle.  A bundle gets back only its own pairs.

Cases: a null or empty text has no tokens (zeros, and '' as digest); so has one
whose joined token bytes differ from a space and the text, for example one that
holds U+2581.  A long text is cut into slices of SLICE_CHARS at spaces and forms
a bundle of its own; only a stretch without any space between printable
characters is encoded whole.  Repeated rows and rows that share an id are
counted and returned one by one.  Ties for the highest count all count.  Other
columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import bound_batches, written

BUNDLE_BYTES = 6 << 20
SLICE_CHARS = 1 << 20
#: Units joined into one text for the tokenizers.
CHUNK = 512
#: Distinct units a worker remembers; it starts anew with the next bundle beyond this.
CACHE_UNITS = 300_000
PAIR = 1 << 32

#: Latin letters, and printable ASCII.
_L = "A-Za-zÀ-ÖØ-öø-ɏ"
_NOT_PLAIN = re.compile(f"[^!-~{_L} \n]")
_UNITS = re.compile(f" ?[{_L}]+|\n| ?[^{_L} \n]+[{_L}]*")
_SAFE_CUT = re.compile(f"(?<=[!-~{_L}]) (?=[!-~{_L}])")


def byte_ends(span_end: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: the coarse cut where a token has one (``span_end``
    >= 0), else the cut before it plus the decoded bytes since."""
    total = np.cumsum(lens)
    known = np.flatnonzero(span_end >= 0)
    if not len(known):
        return total
    drift = np.concatenate([[0], span_end[known] - total[known]])
    return total + drift[np.searchsorted(known, np.arange(len(lens)), "right")]


class Vocabulary:
    """The two tokenizers with the bytes of each entry."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            if all(c in byte_of for c in entry):
                self.a_bytes[i] = bytes(map(byte_of.__getitem__, entry))
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_len = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_len = np.array(list(map(len, self.b_bytes)), np.int64)
        #: Whether no piece of B goes over a place where units are cut: a
        #: letter and a non-letter, anything and a space, a line end.  A's own
        #: pattern always cuts at these places.
        over = re.compile(f"[{_L}][^{_L}]|[^▁]▁|\n")
        self.plain = not any(over.search(p) for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i)))

    def a_tokens(self, text: str, data: bytes) -> tuple[np.ndarray, np.ndarray, bool]:
        """(ids, byte ends, whether the joined bytes equal ``data``)."""
        got = self.a.encode(text, add_special_tokens=False)
        ids = np.array(got.ids, np.int64)
        spans = np.array(got.offsets, np.int64).reshape(-1, 2)
        if len(text) == len(data):
            end = spans[:, 1].copy()
        else:
            width = np.frombuffer(data, np.uint8)
            first = np.append(np.flatnonzero((width & 0xC0) != 0x80), len(data))    # of each character
            end = first[spans[:, 1]]
        end[:-1][spans[1:, 0] < spans[:-1, 1]] = -1         # the next token begins inside this one's last character
        return ids, byte_ends(end, self.a_len[ids]), b"".join(map(self.a_bytes.__getitem__, got.ids)) == data

    def b_tokens(self, text: str, data: bytes) -> tuple[np.ndarray, np.ndarray, bool]:
        """The same for B; ``data`` begins with the space that B adds."""
        pieces = self.b.encode(text, return_type="proto").pieces
        ids = [p.id for p in pieces]
        end = np.array([p.end + 1 if p.end > p.begin else -1 for p in pieces], np.int64)
        joined = b"".join(map(self.b_bytes.__getitem__, ids))
        ids = np.array(ids, np.int64)
        return ids, byte_ends(end, self.b_len[ids]), joined == data


class _Index(dict):
    """Units by number; a new unit takes the next number and waits."""

    def __init__(self, waiting: list[str]):
        self.waiting = waiting

    def __missing__(self, unit: str) -> int:
        n = self[unit] = len(self)
        self.waiting.append(unit)
        return n


class Units:
    """Distinct units with their tokens: groups as text, and the id pair of
    each link.  Units get numbers as they are met; ``settle`` encodes those
    that wait, CHUNK at a time."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        a, b = len(vocabulary.a_bytes), len(vocabulary.b_bytes)
        self._ids = a, a + b
        # an id with what follows it: its own side, the other side, a group, a unit
        self._strings = [f"{i}{end}" for end in ",|;\0" for n in (a, b) for i in range(n)]
        self.clear()

    def clear(self) -> None:
        self._waiting: list[str] = []
        self.index, self._raw = _Index(self._waiting), set()
        self.text: list[str] = []                  # a1,a2|b1;...
        self.sizes, self.links = np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
        self.at, self.good = np.zeros(1, np.int64), np.zeros(0, bool)
        self._new: list[tuple] = []

    def of(self, units: list[str]) -> np.ndarray:
        """Numbers of units cut by _UNITS."""
        return np.fromiter(map(self.index.__getitem__, units), np.int32, len(units))

    def raw(self, part: str) -> int:
        """Number of a part that begins with a space, to be encoded by itself."""
        if part not in self.index:
            self._raw.add(part)
        return self.index[part]

    def settle(self) -> None:
        """Encode the units that wait."""
        some: list[str] = []
        for unit in [*self._waiting, None]:
            alone = unit is None or unit == "\n" or unit in self._raw
            if some and (alone or len(some) == CHUNK):
                self._chunk(some)
                some = []
            if unit is not None and alone:
                self._alone(unit)
            elif unit is not None:
                some.append(unit)
        self._waiting.clear()
        if self._new:
            sizes, counts, links, good = zip(*self._new)
            self.sizes = np.concatenate([self.sizes, *sizes])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(np.concatenate(counts))])
            self.links, self.good = np.concatenate([self.links, *links]), np.concatenate([self.good, *good])
            self._new = []

    def _chunk(self, units: list[str]) -> None:
        # a line end before each unit: both tokenizers cut around it
        text = "\n" + "\n".join(units)
        data = text.encode()
        a, a_end, a_good = self.v.a_tokens(text, data)
        b, b_end, b_good = self.v.b_tokens(text, b" " + data)
        b_end = b_end - 1
        ends = np.cumsum([len(u.encode()) + 1 for u in units])
        starts = np.append(0, ends[:-1]) + 1
        cuts = np.concatenate([starts, ends])
        if a_good and b_good and b_end[0] == 0 and np.isin(cuts, a_end).all() and np.isin(cuts, b_end).all():
            self._add(a, a_end, b[1:], b_end[1:], ends, starts)
            return
        for u in units:
            self._alone(u)

    def _alone(self, unit: str) -> None:
        """A unit by itself; one without a space before it stands behind a
        line end."""
        bare = not unit.startswith(" ")
        text = "\n" + unit if bare and unit != "\n" else unit
        data = text.encode()
        a, a_end, a_good = self.v.a_tokens(text, data)
        b, b_end, b_good = self.v.b_tokens(text if bare else text[1:], b" " + data if bare else data)
        if not (a_good and b_good):
            self.text.append("")
            self._new.append((np.zeros((1, 3), np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(1, bool)))
        elif bare:      # less the space that B adds
            self._add(a, a_end, b[1:], b_end[1:] - 1, np.array([len(data)]), np.array([1] if unit != "\n" else [], np.int64))
        else:
            self._add(a, a_end, b, b_end, np.array([len(data)]), np.zeros(0, np.int64))

    def _add(self, a, a_end, b, b_end, unit_end, between) -> None:
        """Units of one text: ``unit_end`` are their ends, ``between`` those of
        the tokens between them, which belong to none."""
        n = len(unit_end)
        a_own, b_own = ~np.isin(a_end, between), ~np.isin(b_end, between)
        a, a_end, b, b_end = a[a_own], a_end[a_own], b[b_own], b_end[b_own]
        ends, common = np.union1d(a_end, b_end), np.intersect1d(a_end, b_end)
        a_unit, b_unit = np.searchsorted(unit_end, a_end), np.searchsorted(unit_end, b_end)
        count = lambda of: np.bincount(of, minlength=n)
        sizes = np.stack([count(a_unit), count(b_unit), count(np.searchsorted(unit_end, common))], axis=1)
        links = a[np.searchsorted(a_end, ends)] * PAIR + b[np.searchsorted(b_end, ends)]
        self._new.append((sizes, count(np.searchsorted(unit_end, ends)), links, np.ones(n, bool)))
        # the groups as text: ids in order of group and side, each with what follows
        place = np.concatenate([np.searchsorted(common, a_end) * 2, np.searchsorted(common, b_end) * 2 + 1])
        order = np.argsort(place, kind="stable")
        place, unit = place[order], np.concatenate([a_unit, b_unit])[order]
        after, next_unit = np.append(place[1:], -2), np.append(unit[1:], -1)
        follows = np.where(next_unit != unit, 3, np.where(after == place, 0, np.where(after >> 1 == place >> 1, 1, 2)))
        code = follows * self._ids[1] + np.concatenate([a, b + self._ids[0]])[order]
        self.text += "".join(map(self._strings.__getitem__, code.tolist())).split("\0")[:-1]


def _slices(joined: str) -> Iterator[str]:
    """``joined`` cut before spaces between printable characters."""
    at = 0
    while len(joined) - at > SLICE_CHARS:
        cut = _SAFE_CUT.search(joined, at + SLICE_CHARS)
        if cut is None:
            break
        yield joined[at:cut.start()]
        at = cut.start()
    yield joined[at:]


def units_of(units: Units, text: str) -> np.ndarray:
    """Numbers of the units of a space and the text, in order."""
    out = []
    for part in _slices(" " + text):
        bare = part.startswith(" \n") or part.endswith(" ") or "  " in part or "\n\n" in part or " \n" in part
        if units.v.plain and not bare and not _NOT_PLAIN.search(part):
            out.append(units.of(_UNITS.findall(part)))
        else:
            cuts = [0, *[m.start() for m in _SAFE_CUT.finditer(part)], len(part)] if units.v.plain else [0, len(part)]
            out.append(np.array([units.raw(part[i:j]) for i, j in zip(cuts, cuts[1:])], np.int32))
    return np.concatenate(out)


DOC = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
       ("groups_sha256", pa.string()), ("n_units", pa.int64())]
#: units: of all documents one after the other, commonest first in number;
#: unit_sizes, unit_links: how many links a unit has, and their places in a, b, n.
BUNDLES = pa.schema([
    ("bundle", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("n", pa.list_(pa.int64())),
    ("units", pa.binary()), ("unit_sizes", pa.binary()), ("unit_links", pa.binary()), ("docs", pa.list_(pa.struct(DOC)))])
BUNDLE_COLUMNS = ("bundle long, a array<int>, b array<int>, n array<long>, units binary, unit_sizes binary, unit_links binary, docs array<struct<"
                  "doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string,n_units:bigint>>")


def _packed(values: np.ndarray) -> bytes:
    """Non-negative integers by byte planes, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 4 * n, "zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(n).astype(np.int64)


def _gather(at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the slices ``at[i]:at[i + 1]`` one after the other, and their lengths."""
    lens = at[which + 1] - at[which]
    return np.repeat(at[which] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum()), lens


def _bundle(number: int, units: Units, docs: list[tuple]) -> pa.RecordBatch:
    """One row: the distinct id pairs of a bundle, the pairs of each unit, and
    the units of each document."""
    units.settle()
    rows, held = [], []
    for doc_id, seq in docs:
        ok = seq is not None and len(seq) > 0 and bool(units.good[seq].all())
        held.append(seq if ok else np.zeros(0, np.int32))
        n_a, n_b, n_groups = units.sizes[seq].sum(axis=0).tolist() if ok else (0, 0, 0)
        digest = sha256(";".join(map(units.text.__getitem__, seq.tolist())).encode()).hexdigest() if ok else ""
        rows.append(dict(zip((name for name, _ in DOC), (doc_id, n_a, n_b, n_groups, n_a + n_b - n_groups, digest, len(held[-1])))))
    used = np.concatenate(held) if held else np.zeros(0, np.int32)
    own, inverse, times = np.unique(used, return_inverse=True, return_counts=True)
    order = np.argsort(-times, kind="stable")
    rank = np.empty(len(own), np.int64)
    rank[order] = np.arange(len(own))
    own, times = own[order], times[order]
    place, lens = _gather(units.at, own)
    keys, link = np.unique(units.links[place], return_inverse=True)
    n = np.zeros(len(keys), np.int64)
    np.add.at(n, link, np.repeat(times, lens))
    one = lambda values, of: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, of))
    return pa.RecordBatch.from_arrays([
        pa.array([number], pa.int64()), one(keys // PAIR, pa.int32()), one(keys % PAIR, pa.int32()), one(n, pa.int64()),
        pa.array([_packed(rank[inverse])], pa.binary()), pa.array([_packed(lens)], pa.binary()), pa.array([_packed(link)], pa.binary()),
        one(rows, pa.struct(DOC))], schema=BUNDLES)


def _bundles(a_path: Callable[[], str], b_path: Callable[[], str], bundle_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(Vocabulary(a_path(), b_path()))
        number = TaskContext.get().partitionId() << 32
        docs, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                docs.append((doc_id, units_of(units, text) if text else None))
                size += len(text or "")
                if size >= bundle_bytes:
                    yield _bundle(number, units, docs)
                    number, docs, size = number + 1, [], 0
                    if len(units.text) > CACHE_UNITS:
                        units.clear()
            del batch
        if docs:
            yield _bundle(number, units, docs)
    return run


OUT = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                 ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])
OUT_COLUMNS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of neighbouring slices of the given sizes."""
    total = np.append(0, np.cumsum(values))
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _scored(bundle: pa.Table, totals: pa.Table) -> pa.Table:
    """The documents of one bundle, given the totals of its id pairs."""
    out = []
    at = totals.column("place").to_numpy()
    total, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    total[at] = totals.column("total").to_numpy()
    best[at] = totals.column("best").to_numpy().astype(np.int64)
    for row in bundle.combine_chunks().to_batches():
        link, sizes = _unpacked(row.column("unit_links")[0].as_py()), _unpacked(row.column("unit_sizes")[0].as_py())
        units = _unpacked(row.column("units")[0].as_py())
        fields = dict(zip((name for name, _ in DOC), row.column("docs").flatten().flatten()))
        of_docs = [_sums(_sums(values[link], sizes)[units], fields["n_units"].to_numpy()) for values in (best, total)]
        out.append(pa.RecordBatch.from_arrays([
            *[fields[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")],
            *[pa.array(x, pa.int64()) for x in of_docs], fields["groups_sha256"]], schema=OUT))
    return pa.Table.from_batches(out, schema=OUT)


def _totals(bundles: DataFrame) -> DataFrame:
    """(a, b, total, best): how many links of the corpus hold each id pair, and
    whether that is the most of any pair with this B id."""
    pairs = bundles.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("p.a", "p.b", "p.n")
    totals = pairs.groupBy("a", "b").agg(F.sum("n").alias("total"))
    most = totals.groupBy(F.col("b").alias("__b")).agg(F.max("total").alias("__most"))
    return totals.join(most, F.col("b") == F.col("__b")).select("a", "b", "total", (F.col("total") == F.col("__most")).alias("best"))


def corpus_bundles(docs: DataFrame, a_path: Callable[[], str], b_path: Callable[[], str], bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """``docs`` (doc_id, text) as bundles, written to the shared folder."""
    given = bound_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return written(given.mapInArrow(_bundles(a_path, b_path, bundle_bytes), BUNDLE_COLUMNS), "align-bundles")


def pair_counts(bundles: DataFrame) -> DataFrame:
    """(a, b, total, best): the corpus-wide translation table between the two
    vocabularies that the links give."""
    return _totals(bundles)


def align(docs: DataFrame, a_path: Callable[[], str], b_path: Callable[[], str], bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """One row for each row of ``docs`` with the numbers of its tokens, groups
    and links, and what the corpus-wide counts say of its links."""
    bundles = corpus_bundles(docs, a_path, b_path, bundle_bytes)
    totals = written(_totals(bundles), "align-totals")
    wanted = bundles.select("bundle", F.posexplode(F.arrays_zip("a", "b")).alias("place", "p")).select(F.col("bundle").alias("of"), "place", "p.a", "p.b")
    found = wanted.join(totals, ["a", "b"]).select("of", "place", "total", "best")
    return (bundles.select("bundle", "units", "unit_sizes", "unit_links", "docs").groupBy("bundle")
            .cogroup(found.groupBy("of")).applyInArrow(_scored, OUT_COLUMNS))


SPANS = "doc_id long, start array<long>, end array<long>, a array<array<int>>, b array<array<int>>"


def aligned_groups(docs: DataFrame, a_path: Callable[[], str], b_path: Callable[[], str]) -> DataFrame:
    """The groups themselves: for each row of ``docs`` the byte places (in a
    space and the text) and the ids of both tokenizers, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(Vocabulary(a_path(), b_path()))
        for batch in batches:
            rows = []
            found = [(i, units_of(units, t).tolist() if t else []) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            units.settle()
            for doc_id, seq in found:
                if not all(units.good[u] for u in seq):
                    seq = []
                groups = [[[int(i) for i in side.split(",")] for side in g.split("|")] for u in seq for g in units.text[u].split(";")]
                ends = np.cumsum([sum(len(units.v.a_bytes[i]) for i in a) for a, _ in groups]).tolist() if groups else []
                rows.append((doc_id, [0, *ends[:-1]] if ends else [], ends, [g[0] for g in groups], [g[1] for g in groups]))
            names = ["doc_id", "start", "end", "a", "b"]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int32())), pa.list_(pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)
            if len(units.text) > CACHE_UNITS:
                units.clear()

    given = bound_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return given.mapInArrow(run, SPANS)
