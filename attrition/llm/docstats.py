"""Counts and statistics of documents, computed for a chunk of texts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from attrition.llm.textbatch import (
    Texts,
    doc_of,
    hash_prefix,
    mix64,
    per_doc,
    repeated,
    seen_before,
    shingles,
    span_hashes,
    words,
)

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20


@dataclass
class Parsed:
    """A chunk with its word spans and hashes."""

    t: Texts
    prefix: np.ndarray
    ws: np.ndarray
    we: np.ndarray
    bounds: np.ndarray
    wh: np.ndarray

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.bounds)


def parse(t: Texts) -> Parsed:
    ws, we, bounds = words(t)
    prefix = hash_prefix(t.data)
    return Parsed(t, prefix, ws, we, bounds, span_hashes(prefix, ws, we))


def byte_flags(values: bytes) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[list(values)] = True
    return flags


_SYMBOL = byte_flags(SYMBOLS)


def doc_salt(doc: np.ndarray) -> np.ndarray:
    return mix64(doc.astype(np.uint64) + np.uint64(1))


def lines(p: Parsed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every \\n-split line that has a word."""
    t = p.t
    cut = np.flatnonzero(t.data == 0x0A)
    doc_cut = np.searchsorted(t.ends, cut, "right")  # the document that holds the cut
    s = np.concatenate([t.starts, cut + 1])
    e = np.concatenate([cut, t.ends])
    s_doc = np.concatenate([np.arange(len(t)), doc_cut])
    order = np.lexsort((s, s_doc))
    s, s_doc = s[order], s_doc[order]
    e_doc = np.concatenate([doc_cut, np.arange(len(t))])
    e = e[np.lexsort((e, e_doc))]
    has_word = np.searchsorted(p.ws, e) > np.searchsorted(p.ws, s)
    return s[has_word], e[has_word], s_doc[has_word]


def base_counts(p: Parsed) -> dict[str, np.ndarray]:
    """The base columns: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t, n = p.t, len(p.t)
    in_word = np.zeros(len(t.data) + 1, dtype=np.int8)
    in_word[p.ws] += 1
    in_word[p.we] -= 1
    in_word = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)
    first_byte = (t.data & 0xC0) != 0x80
    ls, le, ld = lines(p)
    dup_line = seen_before(span_hashes(p.prefix, ls, le) ^ doc_salt(ld))
    count = p.n_words
    doc = doc_of(p.bounds)
    repeat = np.zeros(len(p.wh), dtype=bool)
    windows = len(p.wh) - WINDOW + 1
    if windows > 0:
        inside = np.flatnonzero(doc[:windows] == doc[WINDOW - 1 :])
        h, where = shingles(p.wh, p.bounds, WINDOW)
        long_doc = count[where] >= WINDOW
        again = inside[repeated(h[long_doc] ^ doc_salt(where[long_doc]))]
        for k in range(WINDOW):
            repeat[again + k] = True
    return {
        "n_words": count.astype(np.int64),
        "word_chars": per_doc(first_byte & in_word, t.starts, t.ends),
        "n_symbols": per_doc(_SYMBOL[t.data], t.starts, t.ends),
        "n_dup_lines": np.bincount(ld[dup_line], minlength=n).astype(np.int64),
        "n_repeat_words": per_doc(repeat, p.bounds[:-1], p.bounds[1:]),
    }


def base_failed(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > REPEAT_PERCENT * c["n_words"])
