"""Token counts of whole texts under a public byte-level BPE vocabulary.

Two-tier lookup on the map side.  A text is split into pre-tokens with the
vocabulary's own pattern; a byte-level BPE never merges across pre-tokens, so
the number of tokens of a text is the sum over its pre-tokens.

* Tier 1: a table (pre-token -> number of tokens) of the ``TABLE_SIZE`` most
  frequent pre-tokens of at most ``TABLE_CHARS`` characters, found on a bounded
  sample of ``SAMPLE_DOCS`` documents and broadcast.  Its size is bounded by
  those constants whatever the input holds.  The table only saves work: any
  table gives the same counts.
* Tier 2: pre-tokens outside it are encoded by the library, once for every
  worker, in a cache that is emptied at ``CACHE_SIZE`` entries.

No pre-token is shuffled on the counting path; it is one ``mapInArrow`` over
the documents.

Special strings of the vocabulary inside a text are cut out first and count as
one token each (the library's default).  A text with a character whose class
differs between the splitting pattern and the library (code points assigned by
a newer Unicode version) is handed to the library whole.

Defined results: null and empty texts have 0 bytes and 0 tokens; a null id is
kept; repeated rows give repeated rows; an empty table gives no rows; columns
other than the two that are named are not read.  Texts of any length are taken whole; words
of equal frequency enter the broadcast table by their order, which changes no count.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_DOCS = 2_000
TABLE_SIZE = 65_536
TABLE_CHARS = 32
CACHE_SIZE = 200_000
GROUP_CHARS = 1 << 20

SCHEMA = "doc_id long, n_bytes long, n_tokens long"


class PreTokenCounter:
    """Counts tokens of texts by looking up pre-tokens; misses go to the library."""

    def __init__(self, path: str, table: dict[str, int] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.pat = regex.compile(public_tokenizers.PATTERN)
        with open(path, encoding="utf-8") as f:
            special = [t["content"] for t in json.load(f)["added_tokens"]]
        # longest first, so that of two specials at one place the longer is taken
        special.sort(key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.table = table or {}
        self.lengths = dict(self.table)  # tier 1 and the misses seen so far
        self.same: set[str] = set()  # non-ASCII characters of one class in both splitters
        self.other: set[str] = set()

    def _library_only(self, text: str) -> bool:
        if text.isascii():
            return False
        chars = set(text)
        for c in chars - self.same - self.other:
            if c.isascii():
                self.same.add(c)
                continue
            probe = f"a{c}1{c}b !{c}"
            mine = [m.span() for m in self.pat.finditer(probe)]
            theirs = [span for _, span in self.tok.pre_tokenizer.pre_tokenize_str(probe)]
            (self.same if mine == theirs else self.other).add(c)
        return not chars.isdisjoint(self.other)

    def split(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text without its special strings, and how many of those it has."""
        if self.special is None or self.special.search(text) is None:
            return self.pat.findall(text), 0
        parts = self.special.split(text)
        return list(chain.from_iterable(map(self.pat.findall, parts))), len(parts) - 1

    def counts(self, texts: list[str]) -> list[int]:
        out, todo = [0] * len(texts), []
        for i, text in enumerate(texts):
            if not text:
                continue
            if self._library_only(text):
                out[i] = len(self.tok.encode(text, add_special_tokens=False).ids)
            else:
                pre, out[i] = self.split(text)
                todo.append((i, pre))
        wanted = set(chain.from_iterable(pre for _, pre in todo))
        missing = wanted.difference(self.lengths)
        if len(self.lengths) + len(missing) > len(self.table) + CACHE_SIZE:
            self.lengths = dict(self.table)
            missing = wanted.difference(self.lengths)
        new = list(missing)
        for k in range(0, len(new), 8192):
            part = new[k : k + 8192]
            self.lengths.update(zip(part, map(len, self.tok.encode_batch(part, add_special_tokens=False)), strict=True))
        for i, pre in todo:
            out[i] += sum(map(self.lengths.__getitem__, pre))
        return out


_worker: dict[str, PreTokenCounter] = {}


def _counter(path: str, key: str, table: dict[str, int]) -> PreTokenCounter:
    """One counter for each worker process and table."""
    if key not in _worker:
        _worker.clear()
        _worker[key] = PreTokenCounter(path, table)
    return _worker[key]


def text_groups(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``GROUP_CHARS`` bytes in all, with the place of the first."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    end = np.cumsum(size)
    i, n = 0, len(texts)
    while i < n:
        base = end[i - 1] if i else 0
        j = min(n, max(i + 1, int(np.searchsorted(end, base + GROUP_CHARS, "right"))))
        yield i, texts.slice(i, j - i).to_pylist()
        i = j


def frequent_table(docs: DataFrame, path: str, id_col: str, text_col: str) -> dict[str, int]:
    """Tier 1: token counts of the most frequent pre-tokens of a bounded sample."""
    total = docs.count()
    every = max(1, -(-total // SAMPLE_DOCS))
    sample = docs.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(every)) == 0).select(F.col(text_col).alias("text"))

    def local_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen = PreTokenCounter(path), Counter()
        for batch in batches:
            for _, texts in text_groups(batch.column(0)):
                for text in texts:
                    if text:
                        seen.update(p for p in counter.split(text)[0] if len(p) <= TABLE_CHARS)
        top = seen.most_common(TABLE_SIZE)
        yield pa.RecordBatch.from_pydict({"p": pa.array([p for p, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())})

    rows = (
        sample.mapInArrow(local_counts, "p string, n long")
        .groupBy("p")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "p")
        .limit(TABLE_SIZE)
        .collect()
    )
    words = [r["p"] for r in rows]
    tok = PreTokenCounter(path).tok
    return {p: len(e) for k in range(0, len(words), 8192) for p, e in zip(words[k : k + 8192], tok.encode_batch(words[k : k + 8192], add_special_tokens=False), strict=True)}


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row of ``docs`` under the vocabulary file ``path``."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_table(docs, path, id_col, text_col))
    key = f"{path}#{table.id if hasattr(table, 'id') else id(table)}"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        counter = _counter(path, key, table.value)
        for batch in batches:
            texts = batch.column(1)
            n = [c for _, group in text_groups(texts) for c in counter.counts(group)]
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(count, SCHEMA)
