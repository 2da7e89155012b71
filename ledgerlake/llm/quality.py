"""Quality rules by repetition coverage.

Rolling hashes of word windows of several lengths, in numpy, find the windows
and lines that occur twice or more inside one text; the rule is the share of
characters that lie inside them.  One map pass: no shuffle, and memory is one
block of texts.

Cases: a null or empty text has no words and fails the base rule; repeated
rows are judged one by one; other columns of the input are not looked at, so
their names cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import NEWLINE, SPACES, Words, blocks, per_text, repeated, utf8
from .common import BLOCK_BYTES, bound_batches

#: Largest share, in percent, of word characters inside duplicated windows of
#: so many words; of characters inside repeated lines; of symbols to words.
MAX_GRAM_PERCENT = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
MAX_LINE_PERCENT = 20
MAX_SYMBOL_PERCENT = 10
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

GRAMS = sorted(MAX_GRAM_PERCENT)
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "dup_line_chars", "line_chars", *[f"dup{n}_chars" for n in GRAMS]]
SCHEMA = ", ".join(["doc_id long", *[f"{m} long" for m in MEASURES], "base_failed boolean", "kept boolean"])


def measure(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of each text of a block."""
    n = len(off) - 1
    words = Words(data, off, SPACES, want_chars=True)
    out = {"n_words": np.diff(words.first), "word_chars": per_text(words.chars, words.doc, n)}
    marks = np.flatnonzero(SYMBOLS[data])
    out["n_symbols"] = np.bincount(np.searchsorted(off, marks, "right") - 1, minlength=n)

    lines = Words(data, off, NEWLINE, want_chars=True)
    if len(lines.start):
        held = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
        doc, chars = lines.doc[held], lines.chars[held]
        _, later = repeated(doc, lines.hash[held])
        out["n_dup_lines"] = per_text(later, doc, n)
        out["dup_line_chars"], out["line_chars"] = per_text(chars * later, doc, n), per_text(chars, doc, n)
    else:
        out |= {k: np.zeros(n, np.int64) for k in ("n_dup_lines", "dup_line_chars", "line_chars")}

    def covered(at: np.ndarray, size: int) -> np.ndarray:
        edge = np.zeros(len(words.hash) + 1, np.int64)
        edge[at] += 1
        edge[at + size] -= 1
        return np.cumsum(edge)[:-1] > 0

    at, key = words.grams(3)
    at = at[repeated(words.doc[at], key)[0]]
    out["n_repeat_words"] = per_text(covered(at, 3), words.doc, n)
    for size in GRAMS:
        # a window can only repeat where the shorter one at its start does
        at = at[at + size <= len(words.hash)]
        at = at[words.doc[at] == words.doc[at + size - 1]]
        at = at[repeated(words.doc[at], words.grams_at(at, size))[0]]
        out[f"dup{size}_chars"] = per_text(words.chars * covered(at, size), words.doc, n)
    return out


def verdict(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) from the measures; whole numbers throughout."""
    failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    bad = (100 * m["dup_line_chars"] > MAX_LINE_PERCENT * m["line_chars"]) \
        | (100 * m["n_symbols"] > MAX_SYMBOL_PERCENT * m["n_words"])
    for size, most in MAX_GRAM_PERCENT.items():
        bad |= 100 * m[f"dup{size}_chars"] > most * m["word_chars"]
    return failed, ~failed & ~bad


def judged(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, dict, np.ndarray, np.ndarray]]:
    """Blocks of a batch, each with its measures and verdicts."""
    data, off = utf8(batch.column(text))
    for i, j in blocks(off, BLOCK_BYTES):
        m = measure(data[off[i]:off[j]], off[i:j + 1] - off[i])
        yield batch.slice(i, j - i), m, *verdict(m)


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its measures, ``base_failed`` and ``kept``."""
    def run(batches):
        for batch in batches:
            for part, m, failed, kept in judged(batch, text_col):
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col).cast(pa.int64()), *[pa.array(m[k].astype(np.int64)) for k in MEASURES], pa.array(failed), pa.array(kept)],
                    ["doc_id", *MEASURES, "base_failed", "kept"])

    return bound_batches(docs).select(id_col, text_col).mapInArrow(run, SCHEMA)


def quality_filter(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    def run(batches):
        for batch in batches:
            for part, _, _, kept in judged(batch, text_col):
                yield part.filter(pa.array(kept))

    return bound_batches(docs).mapInArrow(run, docs.schema)
