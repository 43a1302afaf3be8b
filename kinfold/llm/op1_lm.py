"""LM scoring by a weighted backoff automaton.

Smoothed n-grams become arcs between states (histories) with failure arcs to shorter histories; each text is read once
from left to right, carrying its state and adding log probabilities. With c the training counts, over V + 1 types:

    P(w)     = (c(w) + 1/2) / (N + (V + 1) / 2)
    P(w | h) = (c(h w) + K(h) P(w | h')) / (c(h) + K(h)),   K(h) = A + B c(h),   h' = h without its first token

so that a history's arcs hold P(w | h), its failure arc K(h) / (c(h) + K(h)), and the probabilities after any history add up
to one. Of the pairs A, B that were tried, 5 and 1 give held-out texts the most. Texts begin in the state of a start mark and end with an end token, which is counted.

Counts cover all training texts and grow with them. No table of n-grams ever meets in one place: rows are dealt to
blocks of about `BLOCK_BYTES`; each block sends its sorted distinct n-gram hashes and counts, cut into ranges of hashes,
to the reducers of the ranges; these add them up and answer each block with the corpus's counts of just its n-grams,
with which the block builds its part of the automaton and reads its texts. A frequent n-gram is one entry a block.
Words and n-grams are told apart by 64-bit hashes.

Null text is empty: it has the end token only. A null doc_id trains. Repeated rows count and are scored each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import mix64, packed, shuffle_width, table, texts_of, unpacked

ORDER = 2
A, B = 5.0, 1.0
BLOCK_BYTES = 16_000_000
FOLDS, HELD_OUT = 5, 1
_END, _START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


class Block:
    """The tokens of a block's texts and, for each order, its distinct n-grams."""

    def __init__(self, texts: pa.Array, order: int):
        parts, many = [], []
        for _, _, t in texts_of(texts):
            parts.append(np.insert(t.hashes(), t.first[1:], _END))
            many.append(np.diff(t.first) + 1)
        self.many = np.concatenate([*many, np.zeros(0, np.int64)]).astype(np.int64)
        self.start = np.cumsum(self.many) - self.many
        words = np.concatenate([*parts, np.zeros(0, np.uint64)])
        place = np.arange(len(words)) - np.repeat(self.start, self.many)
        gram, self.names, self.own, self.at = words, [], [], []
        for k in range(1, order + 1):
            if k > 1:
                longer = np.empty_like(gram)
                longer[1:] = gram[:-1]
                if k == 2:
                    longer[self.start] = _START
                gram = mix64(longer * np.uint64(0x2545F4914F6CDD1D) + words + np.uint64(k))
            at = np.flatnonzero(place >= k - 2)  # the start mark counts as one token of history
            names, own = np.unique(gram[at], return_inverse=True)
            full = np.full(len(words), -1)
            full[at] = own
            self.names.append(names)
            self.own.append(full)
            self.at.append(at)
        self.size = len(words)

    def counts(self, held: np.ndarray) -> list[np.ndarray]:
        """Of each order, how often its n-grams occur in training texts."""
        trains = np.repeat(~held, self.many)
        return [np.bincount(own[at][trains[at]], minlength=len(names)) for names, own, at in zip(self.names, self.own, self.at, strict=True)]


def _ranges(names: np.ndarray, width: int) -> np.ndarray:
    """Where each of `width` equal ranges of hashes begins among sorted names; one more at the end."""
    edges = [(i << 64) // width for i in range(width)]
    return np.append(np.searchsorted(names, np.array(edges, np.uint64)), len(names))


def _lists(width: int, order: int):
    """A block's n-grams with their training counts, by range."""

    def run(key, rows):
        block = Block(rows.column("text"), order)
        held = rows.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        out: dict[str, list] = {"range": [], "block": [], "names": [], "counts": [], "sizes": [], "starts": []}
        counts = block.counts(held)
        cuts = [_ranges(names, width) for names in block.names]
        for r in range(width):
            parts = [(n[c[r] : c[r + 1]], k[c[r] : c[r + 1]]) for n, k, c in zip(block.names, counts, cuts, strict=True)]
            gaps = [np.diff(n, prepend=np.uint64(0)) for n, _ in parts]
            out["range"].append(r)
            out["block"].append(key[0].as_py())
            out["names"].append(packed(np.concatenate(gaps)))
            out["counts"].append(packed(np.concatenate([k for _, k in parts]).astype(np.uint32)))
            out["sizes"].append([len(n) for n, _ in parts])
            out["starts"].append(int((~held).sum()) if r == 0 else 0)
        return pa.Table.from_pydict(out, schema=_LISTS)

    return run


_LISTS = pa.schema({"range": pa.int32(), "block": pa.int64(), "names": pa.binary(), "counts": pa.binary(), "sizes": pa.list_(pa.int32()), "starts": pa.int64()})
_ANSWERS = pa.schema({"block": pa.int64(), "range": pa.int32(), "counts": pa.binary(), "tokens": pa.int64(), "types": pa.int64(), "starts": pa.int64()})


def _added(order: int):
    """A range's counts over all blocks, in the order of each block's list; and its tokens and types (training texts, from the first range)."""

    def run(key, rows):
        sizes = np.array(rows.column("sizes").to_pylist(), np.int64).reshape(-1, order)
        names = [unpacked(x.as_py(), np.uint64) for x in rows.column("names")]
        counts = [unpacked(x.as_py(), np.uint32) for x in rows.column("counts")]
        ends = np.cumsum(sizes, 1)
        totals: list[list[np.ndarray]] = [[] for _ in names]
        tokens = types = 0
        for k in range(order):
            parts = [slice(ends[i, k] - sizes[i, k], ends[i, k]) for i in range(len(names))]
            every = np.concatenate([np.cumsum(n[p], dtype=np.uint64) for n, p in zip(names, parts, strict=True)])
            distinct, own = np.unique(every, return_inverse=True)
            total = np.bincount(own, np.concatenate([c[p] for c, p in zip(counts, parts, strict=True)]), len(distinct)).astype(np.uint64)
            if k == 0:
                tokens, types = int(total.sum()), int((total > 0).sum())
            for held, x in zip(totals, np.split(total[own], np.cumsum(sizes[:, k])[:-1]), strict=True):
                held.append(x)
        starts = sum(rows.column("starts").to_pylist())
        n = len(names)
        return pa.Table.from_pydict(
            {"block": rows.column("block"), "range": [key[0].as_py()] * n, "counts": [packed(np.concatenate(x)) for x in totals], "tokens": [tokens] * n, "types": [types] * n, "starts": [starts] * n}, schema=_ANSWERS
        )

    return run


class Automaton:
    """A block's part of the automaton. State 0 is the empty history, 1 the start mark; the others are known n-grams below the order."""

    def __init__(self, block: Block, counts: list[np.ndarray], tokens: int, types: int, starts: int, smoothing: tuple[float, float]):
        a, b = smoothing
        self.order = len(counts)
        self.unigram = (counts[0] + 0.5) / (tokens + 0.5 * (types + 1))
        base = np.cumsum([2, *(len(n) for n in block.names)])
        states = [np.where(c > 0, first + np.arange(len(c)), 0) for c, first in zip(counts, base[:-1], strict=True)]
        size = int(base[self.order - 1]) if self.order > 1 else 2
        self.fails_to, self.fail = np.zeros(size, np.int64), np.zeros(size)
        self.fail[1] = math.log10((a + b * starts) / (starts + a + b * starts))
        self.root_weight, self.root_next = np.log10(self.unigram), states[0] if self.order > 1 else np.zeros(len(counts[0]), np.int64)
        self.symbols = len(counts[0])
        keys, weights, nexts = [], [], []
        lower = self.unigram
        for n in range(1, self.order):  # arcs by n-grams of n + 1 tokens
            _, example = np.unique(block.own[n][block.at[n]], return_index=True)
            at = block.at[n][example]
            first = np.isin(at, block.start)
            before = np.where(first, 0, np.maximum(at - 1, 0))
            history = np.where(first, 1, states[n - 1][block.own[n - 1][before]])
            seen = np.where(first, starts, counts[n - 1][block.own[n - 1][before]])
            below = lower[block.own[n - 1][at]]
            chance = np.where(seen > 0, (counts[n] + (a + b * seen) * below) / (seen + a + b * seen), below)
            known = counts[n] > 0
            keys.append((history * self.symbols + block.own[0][at])[known])
            weights.append(np.log10(chance[known]))
            nexts.append((states[n] if n + 1 < self.order else states[n - 1][block.own[n - 1][at]])[known])
            held = states[n - 1] > 0
            c = counts[n - 1][held]
            self.fail[states[n - 1][held]] = np.log10((a + b * c) / (c + a + b * c))
            if n > 1:
                _, example = np.unique(block.own[n - 1][block.at[n - 1]], return_index=True)
                shorter = states[n - 2][block.own[n - 2][block.at[n - 1][example]]]
                self.fails_to[states[n - 1][held]] = shorter[held]
            lower = chance
        order = np.argsort(np.concatenate([*keys, np.zeros(0, np.int64)]), kind="stable")
        self.keys = np.concatenate([*keys, np.zeros(0, np.int64)])[order]
        self.weights, self.nexts = np.concatenate([*weights, np.zeros(0)])[order], np.concatenate([*nexts, np.zeros(0, np.int64)])[order]

    def read(self, symbols: np.ndarray, start: np.ndarray, many: np.ndarray) -> np.ndarray:
        """The log10 probability of each text: all texts are read side by side, each once from left to right."""
        by_size = np.argsort(-many, kind="stable")
        start, many = start[by_size], many[by_size]
        state, total = np.full(len(many), 1 if self.order > 1 else 0, np.int64), np.zeros(len(many))
        last = max(len(self.keys) - 1, 0)
        active = len(many)
        for t in range(int(many[0]) if len(many) else 0):
            while many[active - 1] <= t:
                active -= 1
            now = symbols[start[:active] + t]
            here = state[:active]
            rest = np.flatnonzero(here)
            lost = np.flatnonzero(here == 0)
            if len(rest) and len(self.keys):
                while len(rest):
                    key = here[rest] * self.symbols + now[rest]
                    at = np.minimum(np.searchsorted(self.keys, key), last)
                    hit = self.keys[at] == key
                    got = rest[hit]
                    total[got] += self.weights[at[hit]]
                    here[got] = self.nexts[at[hit]]
                    rest = rest[~hit]
                    total[rest] += self.fail[here[rest]]
                    here[rest] = self.fails_to[here[rest]]
                    to_root = here[rest] == 0
                    lost = np.concatenate([lost, rest[to_root]])
                    rest = rest[~to_root]
            elif len(rest):
                total[rest] += self.fail[here[rest]]
                lost = np.arange(active)
            total[lost] += self.root_weight[now[lost]]
            here[lost] = self.root_next[now[lost]]
        out = np.empty(len(many))
        out[by_size] = total
        return out


def _scored(width: int, order: int, smoothing: tuple[float, float]):
    def run(docs, answers):
        block = Block(docs.column("text"), order)
        answers = answers.sort_by("range")
        cuts = [_ranges(names, width) for names in block.names]
        parts: list[list[np.ndarray]] = [[] for _ in range(order)]
        for r, data in enumerate(answers.column("counts")):
            sizes = [c[r + 1] - c[r] for c in cuts]
            for held, x in zip(parts, np.split(unpacked(data.as_py(), np.uint64), np.cumsum(sizes)[:-1]), strict=True):
                held.append(x)
        counts = [np.concatenate(p).astype(np.int64) for p in parts]
        tokens, types, starts = (sum(answers.column(c).to_pylist()) for c in ("tokens", "types", "starts"))
        machine = Automaton(block, counts, tokens, types, starts, smoothing)
        symbols = block.own[0]
        rows = np.repeat(np.arange(len(block.many)), block.many)
        return pa.Table.from_pydict({
            "doc_id": docs.column("doc_id"),
            "held_out": docs.column("held_out"),
            "n_tokens": block.many,
            "n_known": np.bincount(rows, counts[0][symbols] > 0, len(block.many)).astype(np.int64),
            "train_tokens": np.full(len(block.many), tokens),
            "base_score": np.bincount(rows, np.log10(machine.unigram)[symbols], len(block.many)),
            "score": machine.read(symbols, block.start, block.many),
        })

    return run


def lm_scores(docs: DataFrame, *, text: str = "text", order: int = ORDER, smoothing: tuple[float, float] = (A, B), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores of all rows of docs by a model of those whose crc32(doc_id) mod `FOLDS` is not `HELD_OUT`."""
    spark = docs.sparkSession
    width = shuffle_width(spark)
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(-(-total // block_bytes), width)
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), held.alias("held_out"), F.pmod(F.xxhash64("doc_id", text), F.lit(blocks)).alias("block"))
    lists = rows.groupBy("block").applyInArrow(_lists(width, order), "range int, block long, names binary, counts binary, sizes array<int>, starts long")
    answers = lists.groupBy("range").applyInArrow(_added(order), "block long, range int, counts binary, tokens long, types long, starts long")
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scored(width, order, smoothing), out)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
