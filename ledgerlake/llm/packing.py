"""Harmonic packing of tokenised documents into fixed-length sequences.

A document's ids are cut into pieces whose lengths fall into
reciprocal-capacity classes: a piece of length n belongs to class
``capacity // n``, and a sequence of class j takes exactly j pieces.  Cutting
at powers of two down to MIN_CUT makes the classes of the larger pieces fit
without a gap; the short rest of a document keeps its own length.  Each worker
fills its classes alone and holds at most one open sequence per class.  The
open sequences that a worker has left at its end are packed together, longest
piece first.  No shuffle; a sequence belongs to one input partition.

Cases: a null or empty text is the end id alone; repeated rows are packed one
by one; other columns are not looked at; an empty table gives no rows.  A
sequence id holds the number of its input partition, so a task that runs again
gives the same ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .arrays import utf8
from .common import bound_batches

CAPACITY = 2048
END_ID = 1
MIN_CUT = 64
#: Distinct words a worker remembers the ids of; it starts anew beyond this.
CACHE_WORDS = 1_200_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
OUT_ROWS = 20_000


def word_encoder(path: str) -> Callable[[bytes], bytes]:
    """Text (UTF-8) to token ids (little-endian unsigned 32 bit, packed).

    The tokenizer drops white space and never joins over it, so a text's ids
    are those of its words in a row, and each distinct word is encoded once.
    A word of ASCII and Latin-1 letters is cut as the tokenizer's own pattern
    cuts it and its pieces go straight to the model; any other word goes
    through the whole tokenizer.
    """
    import regex
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    model = tok.model
    plain = regex.compile("[!-~À-ÖØ-öø-ÿ]+")
    pieces = regex.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")
    # the byte-level alphabet: printable Latin-1 as itself, the others from 256 on
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(shown)]
    alphabet = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    cache: dict = {}

    def pack(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def piece(p: str) -> bytes:
        got = cache.get(p)
        if got is None:
            spelt = p if p.isascii() else p.encode().decode("latin-1").translate(alphabet)
            got = cache[p] = pack([t.id for t in model.tokenize(spelt)])
        return got

    def word(w: bytes) -> bytes:
        s = w.decode()
        if plain.fullmatch(s):
            got = b"".join([piece(p) for p in pieces.findall(s.lower())])
        else:
            got = pack(tok.encode(s, add_special_tokens=False).ids)
        cache[w] = got
        return got

    def encode(text: bytes) -> bytes:
        if len(cache) > CACHE_WORDS:
            cache.clear()
        get = cache.get
        return b"".join([get(w) or word(w) for w in text.split()])

    return encode


def cuts(length: int, capacity: int, min_cut: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``length`` ids."""
    at = 0
    while length - at >= capacity:
        yield at, capacity
        at += capacity
    size = capacity // 2
    while size >= min_cut:
        if length - at >= size:
            yield at, size
            at += size
        size //= 2
    if at < length:
        yield at, length - at


class HarmonicBins:
    """The open sequences of one worker, one for each class."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[tuple]] = {}

    def _closed(self, pieces: list[tuple]) -> list[tuple]:
        sequence, offset, rows = self.next_id, 0, []
        self.next_id += 1
        for p in pieces:
            rows.append((*p, sequence, offset))
            offset += p[2]
        return rows

    def add(self, piece: tuple) -> list[tuple]:
        """``piece``: (doc_id, start, length, ...).  The rows of the sequence
        that this piece completes, if it does."""
        j = self.capacity // piece[2]
        if j == 1:
            return self._closed([piece])
        held = self.open.setdefault(j, [])
        held.append(piece)
        return self._closed(self.open.pop(j)) if len(held) == j else []

    def finish(self) -> list[tuple]:
        """The classes' open sequences, packed together first-fit by falling
        length: at most one open sequence per class, so a bounded rest."""
        bins: list[list] = []
        for p in sorted((p for held in self.open.values() for p in held), key=lambda p: -p[2]):
            fit = next((b for b in bins if b[0] >= p[2]), None)
            if fit is None:
                bins.append(fit := [self.capacity, []])
            fit[0] -= p[2]
            fit[1].append(p)
        self.open = {}
        return [row for b in bins for row in self._closed(b[1])]


def pack(docs: DataFrame, tokenizer_path: str | Callable[[], str], id_col: str = "doc_id",
         text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: its place in its document and in its sequence.

    ``tokenizer_path`` is a path on the executors, or a function giving it.
    ``with_ids`` adds the piece's ids as an array column."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        ids = cols.pop(5)
        arrays = [pa.array(c, pa.int64()) for c in cols]
        if with_ids:
            arrays.append(pa.array([np.frombuffer(b, "<u4").astype(np.int64) for b in ids], pa.list_(pa.int64())))
        return pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

    def run(batches):
        encode = word_encoder(tokenizer_path() if callable(tokenizer_path) else tokenizer_path)
        bins = HarmonicBins(capacity, TaskContext.get().partitionId() << 40)
        end, rows = np.uint32(END_ID).astype("<u4").tobytes(), []
        for batch in batches:
            data, off = utf8(batch.column(text_col))
            data = data.tobytes()
            for doc_id, a, b in zip(batch.column(id_col).to_pylist(), off[:-1].tolist(), off[1:].tolist()):
                ids = encode(data[a:b]) + end
                n = len(ids) // 4
                for at, size in cuts(n, capacity, MIN_CUT):
                    part = ids[4 * at:4 * (at + size)]
                    rows += bins.add((doc_id, at, size, zlib.crc32(part), n, part if with_ids else None))
                if len(rows) >= OUT_ROWS:
                    yield table(rows)
                    rows = []
        rows += bins.finish()
        if rows:
            yield table(rows)

    return bound_batches(docs).select(id_col, text_col).mapInArrow(run, SCHEMA + ", ids array<long>" * with_ids)
