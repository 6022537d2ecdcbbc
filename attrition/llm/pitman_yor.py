"""Hierarchical Pitman-Yor language model, sampled by Gibbs sweeps over table counts.

The model is over small integer symbols with contexts of up to ``ORDER - 1``
symbols.  A context's restaurant shares its parent with all contexts of the same
suffix; the root's parent is uniform.  Counts come as cells (level, context,
symbol, n): n symbols whose longest opened context is the given one.

State: customers c and tables t of every cell.  A sweep goes from the longest
contexts to the root and draws the tables of each cell from their distribution
given the tables of all other cells: for c customers, t tables have the weight

    S(c, t) * product over j < t of (theta + d (T + j)) P(symbol | parent)

with S the number of seatings (generalised Stirling numbers), T the tables of the
restaurant's other cells and P the parent's predictive probability.  This is
exact up to ``EXACT`` customers; beyond, customers are seated in
Chinese-restaurant order in growing blocks (one binomial draw for a block of an
eighth of those seated), each opening a table with probability ``A / (A + i - d t)``,
``A = (theta + d T) P``.  All cells of a level are drawn at once, T and P being those of
the last state.  The tables of a cell are the
customers of its parent's cell.  After ``BURN`` sweeps the predictive
probabilities of each sweep are averaged, over ``CHAINS`` independent chains.
Given the root, contexts are independent, so a sweep can be split by context
(``seat_contexts``, ``seat_root``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from attrition.llm.textbatch import mix64

ORDER = 2
BITS = 16  # of a symbol inside a packed key
CHAINS = 4
BURN = 2
SAMPLES = 4
DISCOUNT = 0.6
STRENGTH = 1.0
EXACT = 128  # most customers of a cell whose tables are drawn from the exact distribution
HELD = 1 << 19  # weights that are held at a time


def suffix_mask(n: int) -> np.uint64:
    return np.uint64((1 << (BITS * n)) - 1)


@dataclass
class Level:
    """Cells of the contexts of one length, sorted by (context, symbol)."""

    cell: np.ndarray  # context << BITS | symbol
    direct: np.ndarray  # customers that do not come from longer contexts
    parent: np.ndarray  # cell of the next level
    group: np.ndarray  # restaurant of each cell
    context: np.ndarray  # context of each restaurant


def build_levels(level: np.ndarray, cell: np.ndarray, n: np.ndarray) -> list[Level]:
    """Levels 0..ORDER-1 from counted cells; every cell gets its cell in the parent's restaurant."""
    out: list[Level] = [None] * ORDER
    above = np.zeros(0, dtype=np.uint64)
    for k in range(ORDER - 1, -1, -1):
        mine = level == k
        cells = np.union1d(cell[mine].astype(np.uint64), above)
        direct = np.zeros(len(cells))
        np.add.at(direct, np.searchsorted(cells, cell[mine].astype(np.uint64)), n[mine])
        context, group = np.unique(cells >> np.uint64(BITS), return_inverse=True)
        out[k] = Level(cells, direct, np.zeros(0, np.int64), group, context)
        above = np.unique(cells & suffix_mask(k)) if k else above  # drop the oldest symbol
    for k in range(1, ORDER):
        out[k].parent = np.searchsorted(out[k - 1].cell, out[k].cell & suffix_mask(k))
    return out


_stirling: list[np.ndarray] = []


def log_stirling() -> np.ndarray:
    """``[c, t]``: log of the generalised Stirling number of c customers at t tables, up to EXACT."""
    if not _stirling:
        out = np.full((EXACT + 1, EXACT + 1), -np.inf)
        out[0, 0] = 0.0
        t = np.arange(EXACT + 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            for c in range(EXACT):
                stay = np.where(c - DISCOUNT * t > 0, np.log(np.maximum(c - DISCOUNT * t, 1e-300)), -np.inf) + out[c]
                out[c + 1] = np.logaddexp(stay, np.append(-np.inf, out[c, :-1]))
        _stirling.append(out)
    return _stirling[0]


def exact_tables(u: np.ndarray, c: np.ndarray, others: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tables of cells with 1 <= c <= EXACT customers: a draw by the uniform number u of each, and the mean."""
    drawn, mean = np.ones(len(c)), np.ones(len(c))
    table = log_stirling()
    order = np.argsort(c, kind="stable")
    cuts = np.searchsorted(c[order], np.arange(2, EXACT + 2))
    for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True), 2):
        some = max(1, HELD // k)
        for x in range(i, j, some):
            rows = order[x : min(j, x + some)]
            step = np.log((STRENGTH + DISCOUNT * (others[rows, None] + np.arange(k))) * base[rows, None])
            w = table[k, 1 : k + 1] + np.cumsum(step, axis=1)
            w = np.exp(w - w.max(axis=1, keepdims=True))
            w /= w.sum(axis=1, keepdims=True)
            up = np.cumsum(w, axis=1)
            drawn[rows] = np.minimum((up < u[rows, None]).sum(axis=1), k - 1) + 1
            mean[rows] = w @ np.arange(1, k + 1)
    return drawn, mean


def block_tables(rng: np.random.Generator, c: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Tables of cells with c customers, seated in blocks; a: weight of a new table."""
    t = (c > 0).astype(float)
    at = np.flatnonzero(c > 1)
    seated = 1.0
    while len(at):
        block = max(1.0, np.floor(seated / 8))
        n = np.minimum(block, c[at] - seated)
        mid = seated + (n - 1) / 2
        q = a[at] / (a[at] + np.maximum(mid - DISCOUNT * t[at], 1 - DISCOUNT))
        t[at] += rng.binomial(n.astype(np.int64), q)
        seated += block
        at = at[c[at] > seated]
    return t


def seat(rng: np.random.Generator, c: np.ndarray, others: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Tables of cells with c customers, given the tables of the restaurants' other cells and the parent's probabilities."""
    t = (c > 0).astype(float)
    u = rng.random(len(c))
    few = np.flatnonzero((c > 1) & (c <= EXACT))
    t[few] = exact_tables(u[few], c[few].astype(np.int64), others[few], base[few])[0]
    many = np.flatnonzero(c > EXACT)
    t[many] = block_tables(rng, c[many], (STRENGTH + DISCOUNT * others[many]) * base[many])
    return t


def seat_by_key(keys: np.ndarray, c: np.ndarray, others: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tables of cells, drawn by the cell's key alone, and their mean (of a large cell: the draw).

    A cell gets the same tables whatever other cells it is drawn with.
    """
    drawn, mean = (c > 0).astype(float), (c > 0).astype(float)
    few = np.flatnonzero((c > 1) & (c <= EXACT))
    u = (mix64(keys[few].view(np.uint64)) >> np.uint64(11)).astype(float) / (1 << 53)
    drawn[few], mean[few] = exact_tables(u, c[few].astype(np.int64), others[few], base[few])
    for k in np.flatnonzero(c > EXACT):
        rng = np.random.default_rng(int(keys[k].view(np.uint64)))
        drawn[k] = mean[k] = block_tables(rng, c[k : k + 1], (STRENGTH + DISCOUNT * others[k : k + 1]) * base[k : k + 1])[0]
    return drawn, mean


def predictive(levels: list[Level], symbols: int, c: list[np.ndarray], t: list[np.ndarray]) -> list[np.ndarray]:
    """Predictive probability of every cell, from the root down."""
    p, above = [], np.zeros(0)
    for k, lv in enumerate(levels):
        total = np.bincount(lv.group, c[k], len(lv.context))[lv.group]
        tables = np.bincount(lv.group, t[k], len(lv.context))[lv.group]
        base = above[lv.parent] if k else np.full(len(lv.cell), 1 / symbols)
        above = (c[k] - DISCOUNT * t[k] + (STRENGTH + DISCOUNT * tables) * base) / (STRENGTH + total)
        p.append(above)
    return p


def run_chain(levels: list[Level], symbols: int, seed: int) -> list[np.ndarray]:
    """Predictive probabilities of all cells, averaged over the sweeps after the burn-in: a whole model in one process."""
    rng = np.random.default_rng(seed)
    c, t = [lv.direct.copy() for lv in levels], [None] * ORDER
    for k in range(ORDER - 1, -1, -1):  # start: one table for each dish
        t[k] = (c[k] > 0).astype(float)
        if k:
            c[k - 1] = levels[k - 1].direct + np.bincount(levels[k].parent, t[k], len(levels[k - 1].cell))
    p = predictive(levels, symbols, c, t)
    mean = [np.zeros(len(lv.cell)) for lv in levels]
    for sweep in range(BURN + SAMPLES):
        for k in range(ORDER - 1, -1, -1):
            lv = levels[k]
            tables = np.bincount(lv.group, t[k], len(lv.context))[lv.group] - t[k]
            base = p[k - 1][lv.parent] if k else np.full(len(lv.cell), 1 / symbols)
            t[k] = seat(rng, c[k], tables, base)
            if k:
                c[k - 1] = levels[k - 1].direct + np.bincount(lv.parent, t[k], len(levels[k - 1].cell))
        p = predictive(levels, symbols, c, t)
        if sweep >= BURN:
            for m, x in zip(mean, p, strict=True):
                m += x / SAMPLES
    return mean


def root_probabilities(c: np.ndarray, t: np.ndarray, symbols: int) -> np.ndarray:
    """Predictive probability of every symbol in the root, for each chain (customers and tables by chain and symbol)."""
    weight = STRENGTH + DISCOUNT * t.sum(axis=-1, keepdims=True)
    return (c - DISCOUNT * t + weight / symbols) / (STRENGTH + c.sum(axis=-1, keepdims=True))


def seat_root(rng: np.random.Generator, c: np.ndarray, t: np.ndarray, symbols: int) -> np.ndarray:
    """New tables of the root's cells, for each chain."""
    others = t.sum(axis=-1, keepdims=True) - t
    return seat(rng, c.ravel(), others.ravel(), np.full(c.size, 1 / symbols)).reshape(c.shape)


def seat_contexts(rng: np.random.Generator, lv: Level, t: np.ndarray, p: np.ndarray) -> np.ndarray:
    """New tables of the cells of some contexts, for each chain; p: the root's probabilities by chain and symbol."""
    base = p[:, (lv.cell & suffix_mask(1)).astype(np.int64)]
    return seat(rng, np.tile(lv.direct, len(t)), (tables_of(lv, t)[:, lv.group] - t).ravel(), base.ravel()).reshape(t.shape)


def tables_of(lv: Level, t: np.ndarray) -> np.ndarray:
    """Tables of each restaurant, for each chain."""
    return np.stack([np.bincount(lv.group, x, len(lv.context)) for x in t])


def context_rows(lv: Level, t: np.ndarray, tables: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Predictive probabilities of all symbols after each of some contexts, averaged over samples.

    t: mean tables of the cells; tables, p: tables of the restaurants and the root's probabilities, for each sample.
    """
    customers = STRENGTH + np.bincount(lv.group, lv.direct, len(lv.context))
    out = ((STRENGTH + DISCOUNT * tables) / customers).T @ p / len(p)
    out[lv.group, (lv.cell & suffix_mask(1)).astype(np.int64)] += (lv.direct - DISCOUNT * t) / customers[lv.group]
    return out


@dataclass
class SymbolModel:
    """Probability of each symbol after each context: a row for each that has customers, the last is the root's."""

    rows: np.ndarray
    row: np.ndarray  # of each symbol before

    def probability(self, grams: np.ndarray) -> np.ndarray:
        """Probability of the last symbol of each gram (ORDER symbols packed into a uint64)."""
        before, symbol = (grams >> np.uint64(BITS)) & suffix_mask(1), grams & suffix_mask(1)
        return self.rows[self.row[before.astype(np.int64)], symbol.astype(np.int64)].astype(float)

    def log10(self, grams: np.ndarray) -> np.ndarray:
        return np.log10(self.probability(grams))


def symbol_model(context: np.ndarray, rows: np.ndarray, root: np.ndarray) -> SymbolModel:
    row = np.full(len(root), len(context))
    row[context.astype(np.int64)] = np.arange(len(context))
    return SymbolModel(np.concatenate([rows, root[None]]).astype(np.float32), row.astype(np.int32))


def build_model(levels: list[Level], symbols: int, mean: list[np.ndarray]) -> SymbolModel:
    """The model of averaged probabilities of cells; a context's weight for unseen symbols makes it sum to one."""
    above = np.full((1, symbols), 1 / symbols)
    for k, lv in enumerate(levels):
        out = np.repeat(above, len(lv.context), axis=0)  # the parent's: uniform, then the root's
        at = lv.group, (lv.cell & suffix_mask(1)).astype(np.int64)
        rest = 1 - np.bincount(lv.group, out[at], len(lv.context))
        # a context that has seen all the symbols its parent gives any weight needs none for others
        seen = np.bincount(lv.group, mean[k], len(lv.context))
        out *= np.where(rest > 1e-12, np.maximum(1 - seen, 1e-12) / np.maximum(rest, 1e-12), 1.0)[:, None]
        out[at] = np.maximum(mean[k], 1e-30)
        if not k:
            above = out if len(out) else above
    return symbol_model(levels[-1].context, out, above[0])
