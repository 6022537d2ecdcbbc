"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

A text is normalised as its model says (dummy prefix, ``U+2581`` for a space)
and cut into marked words: a run of marks with the characters up to the next
mark.  No piece crosses such a border (checked when the model is loaded), so a
text is the sequence of its words' pieces.  The distinct words of an Arrow
batch that the worker has not met yet are sorted, which lays them out as a trie
in depth-first order: a stack holds the forward state of every prefix of the
current word, and the next word goes on from the longest common prefix.

Forward state.  For a unigram model it is the Viterbi score and last piece of
the best path to each prefix.  For a BPE model the score of a path is 0 if all
its neighbouring pieces are ones that the merges leave apart, and minus
infinity otherwise; exactly one path to each prefix has score 0, and it is the
one that greedy merging gives.  Whether two pieces stay apart follows from
undoing their last merges in order of rank.  Words that start with two or more
marks (pieces of marks alone share one score) are merged directly.

Characters outside the vocabulary become byte pieces, or the unknown piece.

Defined results: null and empty texts have no pieces and decode to an empty
text; a mark character in the input decodes to a space, as in the library; null
ids and repeated rows are kept; an empty table gives no rows; other columns are
not read by :func:`encode` and pass unchanged through :func:`with_pieces`.  Of paths
with equal scores the one with the longest last piece is taken; texts of any length are taken whole, and a
word of n characters takes n steps (n log n if it begins with several marks).
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from attrition.llm.token_counts import text_groups

MARK = "▁"
CACHE_WORDS = 300_000
PAIR_CACHE = 200_000
UNK_PENALTY = 10.0

# Fixed values of the model file format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, BYTE = 1, 2, 6


class Pieces:
    """Tables of a model file, built once on the driver and broadcast."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or not norm.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only identity normalisation with marks before words is supported")
        self.kind = proto.trainer_spec.model_type
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        self.prefix, self.squeeze = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        self.byte_fallback = proto.trainer_spec.byte_fallback
        self.ids: dict[str, int] = {}
        self.score: list[float] = [p.score for p in proto.pieces]
        self.surface: list[bytes] = [b""] * len(proto.pieces)
        self.bytes: list[int] = [0] * 256
        self.unknown = 0
        for i, p in enumerate(proto.pieces):
            if p.type == NORMAL:
                self.ids[p.piece] = i
                self.surface[i] = p.piece.replace(MARK, " ").encode()
            elif p.type == UNKNOWN:
                self.unknown = i
                self.surface[i] = proto.trainer_spec.unk_surface.encode()
            elif p.type == BYTE:
                value = int(p.piece[1:-1], 16)
                self.bytes[value] = i
                self.surface[i] = bytes([value])
            elif p.type not in (3,):  # control pieces have no surface
                raise ValueError("user-defined and unused pieces are not supported")
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("a piece crosses a word border")
        inside = set(chain.from_iterable(p for p in self.ids if len(p) > 1))
        alone = "".join(c for c in map(chr, range(0x80)) if c not in inside and c != " ")
        cls = re.escape(alone)
        self.pattern = (f"[{cls}]|" if alone else "") + f"{MARK}*[^{MARK}{cls}]+|{MARK}+"
        if self.kind == BPE:
            self._merge_tables()

    def _merge_tables(self) -> None:
        """Rank and last merge of every piece; pieces that merging never makes are dropped."""
        marks = {p for p in self.ids if not p.strip(MARK)}
        order = sorted((p for p in self.ids if len(p) > 1), key=lambda p: (-self.score[self.ids[p]], p))
        plain = [p for p in order if p not in marks]
        scores = [self.score[self.ids[p]] for p in plain]
        if len(set(scores)) != len(scores):
            raise ValueError("two pieces share a score")
        self.rank = {p: r for r, p in enumerate(order)}
        self.last: dict[str, tuple[str, str]] = {}
        for p in plain:
            parts = self.merge(p, keep_last=True)
            if len(parts) == 2:
                self.last[p] = (parts[0], parts[1])
                if max(self.rank.get(x, -1) for x in parts) > self.rank[p]:
                    raise ValueError("a piece is made of later pieces")

    def merge(self, word: str, keep_last: bool = False) -> list[str]:
        """Greedy merging: best score first, leftmost of equals; ``keep_last`` stops before the last merge into one.

        Neighbouring pairs wait in a heap, so a word of n characters takes n log n steps.
        """
        parts: list[str | None] = list(word)
        n = left = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ids, score = self.ids, self.score
        heap: list[tuple[float, int, str, str]] = []

        def offer(i: int, j: int) -> None:
            k = ids.get(parts[i] + parts[j])
            if k is not None:
                heapq.heappush(heap, (-score[k], i, parts[i], parts[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap and not (keep_last and left == 2):
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue  # one of them was merged since
            parts[i], parts[j] = a + b, None
            left -= 1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p is not None]


class Encoder:
    """Encodes and decodes texts with the tables of a model; caches words it has met."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.find = re.compile(pieces.pattern).findall
        self.cache: dict[str, int] = {}  # word -> place in the flat arrays below
        self.pairs: dict[tuple[str, str], bool] = {}
        self._reset()
        # trie of the reachable pieces: children by character, and the piece that ends at the node
        self.trie: dict = {}
        reach = pieces.ids if pieces.kind == UNIGRAM else [*pieces.last, *(c for c in pieces.ids if len(c) == 1)]
        for p in reach:
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[""] = p
        self.unk_score = min(pieces.score, default=0.0) - UNK_PENALTY

    def _reset(self) -> None:
        self.cache.clear()
        self.flat = np.zeros(0, dtype=np.int32)  # pieces of the words met so far
        self.offset = np.zeros(1, dtype=np.int64)
        self.new: list[int] = []  # pieces of the words that are being added
        self.new_ends: list[int] = []

    def normalise(self, text: str) -> str:
        if self.p.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        text = text.replace(" ", MARK)
        return MARK + text if self.p.prefix else text

    def apart(self, a: str, b: str) -> bool:
        """Whether merging ``a + b`` ends with the two pieces ``a`` and ``b`` (each reachable)."""
        ids, rank, last = self.p.ids, self.p.rank, self.p.last
        limit = len(rank)
        while True:
            joined = a + b
            if joined in ids and rank[joined] < limit:
                return False
            ra, rb = rank.get(a, -1) if a in last else -1, rank.get(b, -1) if b in last else -1
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, last[a][1]
            else:  # equal pieces: the left one was merged first
                limit, b = rb + 1, last[b][0]

    def _emit(self, parts: list[str]) -> None:
        ids, p, out = self.p.ids, self.p, self.new
        unknown_before = False
        for part in parts:
            i = ids.get(part)
            if i is not None:
                out.append(i)
            elif p.byte_fallback:
                out.extend(p.bytes[x] for x in part.encode("utf-8", "replace"))
            elif not unknown_before:  # a run of unknown characters is one unknown piece
                out.append(p.unknown)
            unknown_before = i is None
        self.new_ends.append(len(out))

    def _add_words(self, words: list[str]) -> None:
        """Depth-first walk over the trie of the sorted words."""
        bpe, trie, apart, pairs = self.p.kind == BPE, self.trie, self.apart, self.pairs
        ids, score, known = self.p.ids, self.p.score, len(self.offset) - 1
        if len(pairs) > PAIR_CACHE:
            pairs.clear()
        last: list[str] = [""]  # last piece of the best path to each prefix
        best: list[float] = [0.0]
        active: list[list] = [[]]  # (start, node) of the pieces that may go on, by prefix
        before = ""
        for word in words:
            if bpe and word.startswith(MARK + MARK):
                self._emit(self.p.merge(word))
                self.cache[word] = known + len(self.new_ends) - 1
                continue
            n, k = len(word), 0
            top = min(len(before), n)
            while k < top and word[k] == before[k]:
                k += 1
            del last[k + 1 :], best[k + 1 :], active[k + 1 :]
            open_now = active[k]
            for i in range(k, n):
                c = word[i]
                going = [(s, node[c]) for s, node in open_now if c in node]
                if c in trie:
                    going.append((i, trie[c]))
                choice = None
                if bpe:
                    for s, node in going:  # longest piece first
                        piece = node.get("")
                        if piece is None:
                            continue
                        if s:
                            pair = (last[s], piece)
                            ok = pairs.get(pair)
                            if ok is None:
                                ok = pairs[pair] = apart(*pair)
                            if not ok:
                                continue
                        choice = piece
                        break
                    last.append(c if choice is None else choice)
                    best.append(0.0)
                else:
                    top_score, single = -np.inf, False
                    for s, node in going:
                        piece = node.get("")
                        if piece is not None:
                            single |= s == i
                            value = best[s] + score[ids[piece]]
                            if value > top_score:
                                top_score, choice = value, piece
                    if not single and best[i] + self.unk_score > top_score:
                        top_score, choice = best[i] + self.unk_score, c
                    last.append(choice)
                    best.append(top_score)
                active.append(going)
                open_now = going
            before = word
            parts, i = [], n
            while i:
                parts.append(last[i])
                i -= len(last[i])
            self._emit(parts[::-1])
            self.cache[word] = known + len(self.new_ends) - 1
        self.offset = np.concatenate([self.offset, len(self.flat) + np.array(self.new_ends, dtype=np.int64)])
        self.flat = np.concatenate([self.flat, np.array(self.new, dtype=np.int32)])
        self.new, self.new_ends = [], []

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts in one flat array, and the bounds of each text in it."""
        words = [self.find(self.normalise(t)) if t else [] for t in texts]
        wanted = set(chain.from_iterable(words))
        new = wanted.difference(self.cache)
        if len(self.cache) + len(new) > CACHE_WORDS and self.cache:
            self._reset()
            new = wanted
        self._add_words(sorted(new))
        flat, offset = self.flat, self.offset
        per_text = np.array([len(w) for w in words], dtype=np.int64)
        at = np.fromiter(map(self.cache.__getitem__, chain.from_iterable(words)), dtype=np.int64, count=int(per_text.sum()))
        size = offset[at + 1] - offset[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        place = np.repeat(offset[at] - ends[:-1], size) + np.arange(ends[-1])
        return flat[place], ends[np.concatenate([[0], np.cumsum(per_text)])]

    def decode(self, ids: np.ndarray) -> str:
        """Text of a sequence of piece ids."""
        surface = self.p.surface
        text = b"".join([surface[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if self.p.prefix and text.startswith(" ") else text


_worker: dict[str, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder for each worker process and model."""
    key = str(shared.value[0])
    if key not in _worker:
        _worker.clear()
        _worker[key] = Encoder(shared.value[1])
    return _worker[key]


def load(path: str) -> tuple[str, Pieces]:
    """Tables of a model file (read on the driver; the workers get them by broadcast)."""
    import hashlib

    with open(path, "rb") as f:
        model = f.read()
    return hashlib.sha256(model).hexdigest(), Pieces(model)


def _encode_batch(enc: Encoder, texts: pa.Array) -> Iterator[tuple[int, list[str | None], np.ndarray, np.ndarray]]:
    for first, group in text_groups(texts):
        flat, bounds = enc.encode(group)
        yield first, group, flat, bounds


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pieces, pieces, restored`` of every row.

    ``restored`` tells that decoding the pieces gives the text back (null: empty).
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared)
        for batch in batches:
            for first, texts, flat, bounds in _encode_batch(enc, batch.column(1)):
                back = [enc.decode(flat[a:b]) == (t or "") for t, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array(np.diff(bounds)),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat)),
                        pa.array(back),
                    ],
                    names=["doc_id", "n_pieces", "pieces", "restored"],
                )

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInArrow(run, "doc_id long, n_pieces long, pieces array<int>, restored boolean")


def decode(pieces: DataFrame, path: str, id_col: str = "doc_id", pieces_col: str = "pieces") -> DataFrame:
    """``doc_id, text`` from sequences of piece ids (null: an empty text)."""
    shared = pieces.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared)
        for batch in batches:
            texts = [enc.decode(np.array(x.as_py() or [], dtype=np.int64)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    named = pieces.select(F.col(id_col).cast("long").alias("doc_id"), F.col(pieces_col).alias("pieces"))
    return named.mapInArrow(run, "doc_id long, text string")


def with_pieces(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the piece ids of each text (``pieces``) and whether decoding restores it (``restored``).

    Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    docs = docs.drop("pieces", "restored")
    at = docs.columns.index(text_col)
    schema = StructType([*docs.schema, StructField("pieces", ArrayType(IntegerType())), StructField("restored", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared)
        for batch in batches:
            for first, texts, flat, bounds in _encode_batch(enc, batch.column(at)):
                part = batch.slice(first, len(texts))
                found = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))
                back = [enc.decode(flat[a:b]) == (t or "") for t, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, found, pa.array(back, pa.bool_())], names=[*part.schema.names, "pieces", "restored"])

    return docs.mapInArrow(run, schema)
