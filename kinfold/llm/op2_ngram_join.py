"""N-gram Jaccard join by count vectors.

A text's set of k-word shingles is hashed into groups; the group counts are a point. For two sets the sum of the
coordinates' minima bounds the intersection, so it bounds the Jaccard similarity: pairs below the threshold by that
bound are given up, the others verified on the sets themselves.

Which points meet is exact, too. Two sets of similarity t differ in d <= (1 - t) / (1 + t) * (|A| + |B|) shingles. Sizes
fall into classes; for each class the hash space is cut into more than d blocks, so that linked sets agree in a whole
block. A block's content is a cell's name, and the sets in one cell meet there (a set with so many empty blocks
that it could agree in these alone also gives their names). Cells travel by range of name as sorted, packed arrays, and
with them each set's point, once a range; there are as many ranges as the shingles need (`ENTRIES` cells' entries each).

1. Each cell's points are joined with themselves (small cells all at once, larger ones by an R-tree: points packed by size
   and leading counts, nodes with their coordinates' extremes). The pairs within the bound are verified, and the cell is
   done. Only a cell with more than `FEW` such pairs a member, as many near copies make, gives less: its least member
   against the others. Verified links make components.
2. Those large cells that still hold several components go into R-trees once more, of points of different components,
   and what the points allow is bounded by the sets' fine points (below) at once, so that sets that are almost similar
   enough are told apart where they meet. Cells of one least member are dealt to `SPREAD` tasks, to which a set's fine point
   travels once. In the first `FORESTS` rounds a cell with more than `FEW` pairs a member sends only as many as could join its
   components, the most similar first; they are verified, components grow together, and only such cells come back,
   without the pairs that failed. The last round sends all that remain. After that every pair of linked sets is in one component.

Verification bounds the overlap a second time, by counts in `FINE` groups a shingle or more: such a fine point takes an
eighth of its set's bytes, and what it allows is nearly always a link. Only for these pairs do the sets travel.

Equal sets are one class from the start, so exact copies cost nothing more. Similarity is compared in integers.
A text without words has no set and links with nothing; null text is such a text; an empty table gives no rows. Rows
without a key get their set's size and a null component. Repeated rows are alike; where rows share
a key but not their text, sets of the same least key are joined. Other columns are not read. Classes and shingles are told apart by 64-bit hashes (48 bits
where two given sets are compared).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  as pa.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import dropped, free_name, kept, mix64, packed, row_hashes, shuffle_width, table, texts_of, trimmed, trimmed_cogroup, trimmed_group, unpacked

SHINGLE, PER_CENT = 4, 85
GROUPS = 256
FANOUT = 32
FLUSH = 1_500_000
ENTRIES = 4_000_000
LEAST_RANGES = 8
BROADCAST_KEYS = 1_000_000
FORESTS = 3
FINE = 16
FEW = 8
SPREAD = 8
FINE_BYTES = 64_000_000
_GROWTH = 1.5


class Classes:
    """Size classes for a threshold of `per_cent`, and the number of blocks and of empty ones that they allow."""

    def __init__(self, per_cent: int, most: int = 1 << 40):
        self.per_cent, self.edges, at = per_cent, [1], 1
        while at < most:
            at = max(at + 1, int(at * _GROWTH))
            self.edges.append(at)
        self.blocks, self.spare = [], []
        for lo, hi in zip(self.edges[:-1], self.edges[1:], strict=True):
            d = (100 - per_cent) * 2 * (hi - 1) // (100 + per_cent)
            spare = 0 if d == 0 else 2 + math.ceil(0.06 * d)
            self.blocks.append(d + 1 + spare)
            self.spare.append(spare)

    def of(self, n: int) -> list[int]:
        """The classes in which a set of n shingles meets others: its own, and the next if that holds sets it can link with."""
        own = int(np.searchsorted(self.edges, n, "right")) - 1
        return [own, own + 1] if 100 * n >= self.per_cent * self.edges[own + 1] else [own]

    def groups(self, c: int) -> int:
        """The groups of a point that travels with a cell of class c: about one for twelve shingles, so that most chance meetings fail the bound."""
        return min(GROUPS, max(16, 1 << ((self.edges[c + 1] - 1) // 16).bit_length()))


def class_of(hashes: np.ndarray) -> int:
    """The name of a set: equal for equal sets."""
    x = hashes.sum(dtype=np.uint64) if len(hashes) else np.uint64(0)
    return int(mix64(np.array([x, x ^ np.uint64(len(hashes))], np.uint64) + np.array([0, 0x632BE59BD9B4E019], np.uint64)).sum(dtype=np.uint64).view(np.int64))


def cell_names(hashes: np.ndarray, classes: Classes) -> list[tuple[int, np.ndarray]]:
    """By class, the names of the cells of a set, given as sorted distinct hashes."""
    out = []
    for c in classes.of(len(hashes)):
        k = classes.blocks[c]
        if k == 1:
            continue  # only equal sets could link, and these are one class
        block = ((hashes >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(block, prepend=-1))
        sums = np.add.reduceat(mix64(hashes), first)
        full = block[first].astype(np.uint64)
        salt = np.uint64((c * 0x9E3779B97F4A7C15) & (2**64 - 1))
        names = mix64(sums + salt + full * np.uint64(0xC2B2AE3D27D4EB4F))
        if k - len(first) > classes.spare[c]:
            empty = np.setdiff1d(np.arange(k, dtype=np.uint64), full)
            names = np.append(names, mix64(mix64(salt + empty * np.uint64(0xC2B2AE3D27D4EB4F)) + np.uint64(1)))
        out.append((c, names))
    return out


def counts_of(hashes: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    return np.bincount((hashes & np.uint64(groups - 1)).astype(np.int64), minlength=groups).astype(np.uint32)


def _sets(batches_text, k: int):
    """(row in batch, hashes) of each row of a text column."""
    for at, to, t in texts_of(batches_text):
        for i, h in enumerate(row_hashes(t.first, t.hashes(), k)):
            yield at + i, h


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """key, n_shingles, cls (0 without a set)."""

    def run(batches):
        for batch in batches:
            n, names = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for i, h in _sets(batch.column(1), k):
                n[i] = len(h)
                names[i] = class_of(h) if len(h) else 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(names)], names=["key", "n_shingles", "cls"])

    return docs.mapInArrow(trimmed(run), "key long, n_shingles long, cls long")


_CELLS = pa.schema({"range": pa.int32(), "size_class": pa.int32(), "names": pa.binary(), "cls": pa.binary(), "points": pa.binary()})


def _cells(docs: DataFrame, k: int, per_cent: int, width: int) -> DataFrame:
    """range, size_class, names, cls, points: packed entries of cells by range of name, and the sets that have them."""
    edges = np.array([(i << 64) // width for i in range(width)], np.uint64)

    def packed_class(c: int, names: list[np.ndarray], owners: list[int], points: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(names)
        number = np.repeat(np.arange(len(owners), dtype=np.int32), [len(x) for x in names])
        order = np.argsort(every)
        every, number = every[order], number[order]
        held, counts = np.array(owners, np.int64), np.stack(points).astype(np.uint32)
        rows: dict[str, list] = {x: [] for x in _CELLS.names}
        cuts = np.append(np.searchsorted(every, edges), len(every))
        for r in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[r], cuts[r + 1]
            used, at = np.unique(number[a:b], return_inverse=True)
            rows["range"].append(r)
            rows["size_class"].append(c)
            rows["names"].append(packed(np.diff(every[a:b] >> np.uint64(16), prepend=np.uint64(0))))  # 48 bits: a chance meeting is only verified
            rows["cls"].append(len(used).to_bytes(4, "little") + held[used].tobytes() + packed(at.astype(np.uint32)))
            rows["points"].append(packed(counts[used].reshape(-1)))
        return pa.RecordBatch.from_pydict(rows, schema=_CELLS)

    def run(batches):
        classes, seen = Classes(per_cent), set()
        held: dict[int, tuple[list, list, list]] = {}
        total = 0
        for batch in batches:
            for _, h in _sets(batch.column(1), k):
                if not len(h) or (name := class_of(h)) in seen:
                    continue
                seen.add(name)
                for c, names in cell_names(h, classes):
                    for x, of in zip(held.setdefault(c, ([], [], [])), (names, name, counts_of(h, classes.groups(c))), strict=True):
                        x.append(of)
                    total += len(names)
                if total > FLUSH:
                    for c in sorted(held):
                        yield packed_class(c, *held.pop(c))
                    total = 0
        for c in sorted(held):
            yield packed_class(c, *held.pop(c))

    return docs.mapInArrow(trimmed(run), "range int, size_class int, names binary, cls binary, points binary")


def _within(points: np.ndarray, sizes: np.ndarray, pairs: np.ndarray, per_cent: int) -> np.ndarray:
    """Of pairs (numbers of points) those within the bound."""
    ok = np.zeros(len(pairs), bool)
    step = max(1, 4_000_000 // points.shape[1])
    for at in range(0, len(pairs), step):
        x, y = pairs[at : at + step].T
        ok[at : at + step] = _bound(np.minimum(points[x], points[y]).sum(1), sizes[x], sizes[y], per_cent)
    return pairs[ok]


def _cell_pairs(name: np.ndarray, own: np.ndarray, points: np.ndarray, per_cent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (name of the cell, number of the set; sorted, distinct) to pairs within the bound, and the members of cells that aren't done: their cells' names and numbers."""
    sizes = points.sum(1).astype(np.int64)
    first = np.flatnonzero(np.diff(name, prepend=~name[:1]))
    many = np.diff(np.append(first, len(name)))
    cell = np.add.reduceat(mix64(own.astype(np.uint64)), first)
    held = np.flatnonzero(many >= 2)
    held = held[np.unique(cell[held], return_index=True)[1]]  # cells of the same sets are one
    first, many = first[held], many[held]
    pairs, left = [np.zeros((0, 2), np.int64)], [np.zeros(0, np.int64)]
    for s in np.unique(many[many <= 2 * FEW + 1]).tolist():
        i, j = np.triu_indices(s, 1)
        members = own[first[many == s][:, None] + np.arange(s)]
        pairs.append(np.stack([members[:, i].reshape(-1), members[:, j].reshape(-1)], 1))
    pairs = [_within(points, sizes, np.unique(np.concatenate(pairs), axis=0), per_cent)]
    for at in np.flatnonzero(many > 2 * FEW + 1).tolist():
        members = own[first[at] : first[at] + many[at]]
        found = Tree(points[members], sizes[members]).pairs(per_cent, np.arange(len(members)), FEW * len(members))
        if found is not None:
            pairs.append(members[found[0]])
        else:
            pairs.append(_within(points, sizes, np.stack([np.full(len(members) - 1, members[0]), members[1:]], 1), per_cent))
            left.append(members)
    return np.unique(np.sort(np.concatenate(pairs), 1), axis=0), np.repeat(np.arange(len(left) - 1), np.array([len(x) for x in left[1:]], np.int64)), np.concatenate(left)


_MET = pa.schema({"cell": pa.int64(), "a": pa.int64(), "b": pa.int64()})


def _met(per_cent: int):
    """A range's cells: pairs of classes to verify (cell null), and the members of cells that aren't done."""

    def run(key, rows):
        out = [_MET.empty_table()]
        in_class, classes = np.array(rows.column("size_class").to_pylist()), Classes(per_cent)
        for c in np.unique(in_class).tolist():
            names, owners, points = [], [], []
            for i in np.flatnonzero(in_class == c).tolist():
                raw = rows.column("cls")[i].as_py()
                used = int.from_bytes(raw[:4], "little")
                held = np.frombuffer(raw, np.int64, used, 4)
                names.append(np.cumsum(unpacked(rows.column("names")[i].as_py(), np.uint64), dtype=np.uint64))
                owners.append(held[unpacked(raw[4 + 8 * used :], np.uint32)])
                points.append((held, unpacked(rows.column("points")[i].as_py(), np.uint32).reshape(used, classes.groups(c))))
            cls, example = np.unique(np.concatenate([x for x, _ in points]), return_index=True)
            count = np.concatenate([x for _, x in points])[example].astype(np.int32)
            name, own = np.concatenate(names), np.searchsorted(cls, np.concatenate(owners))
            order = np.lexsort((own, name))
            name, own = name[order], own[order]
            new = np.ones(len(name), bool)
            new[1:] = (name[1:] != name[:-1]) | (own[1:] != own[:-1])
            pairs, number, left = _cell_pairs(name[new], own[new], count, per_cent)
            members = cls[left]
            first = np.flatnonzero(np.diff(number, prepend=-1))
            called = np.add.reduceat(mix64(members.view(np.uint64)), first).view(np.int64) if len(first) else np.zeros(0, np.int64)
            out.append(pa.table([pa.nulls(len(pairs), pa.int64()), pa.array(cls[pairs[:, 0]]), pa.array(cls[pairs[:, 1]])], schema=_MET))
            out.append(pa.table([pa.array(called[number]), pa.array(members), pa.nulls(len(members), pa.int64())], schema=_MET))
        return pa.concat_tables(out).combine_chunks()

    return run


def _bound(both: np.ndarray, n: np.ndarray, m: np.ndarray, per_cent: int) -> np.ndarray:
    """Whether sets of n and m shingles with an intersection of `both` at most can be similar enough."""
    return 100 * both >= per_cent * (n + m - both)


class Tree:
    """An R-tree of points: leaves of FANOUT points packed by size and leading counts; nodes know their extremes. Points of one mark that most have lie together."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, marks: np.ndarray | None = None):
        keys = [points[:, 1], points[:, 0], sizes] if len(sizes) else []
        if marks is not None and len(sizes):
            names, many = np.unique(marks, return_counts=True)
            keys.append(marks == names[many.argmax()])
        self.order = np.lexsort(keys) if keys else np.zeros(0, np.int64)
        self.points, self.sizes = points[self.order].astype(np.int32), sizes[self.order].astype(np.int64)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = [(self.points, self.sizes)]
        while len(self.levels[-1][1]) > 1:
            high, low = self.levels[-1]
            starts = np.arange(0, len(low), FANOUT)
            self.levels.append((np.maximum.reduceat(high, starts), np.minimum.reduceat(low, starts)))

    def pairs(self, per_cent: int, apart: np.ndarray, limit: int | None = None) -> tuple[np.ndarray, np.ndarray] | None:
        """Pairs of points (as numbered on the way in) within the bound and with different marks in `apart`; their similarity at most. None where there are more than `limit`."""
        ends, count = [(apart[self.order],) * 2], 0  # of each level, the nodes' least and greatest marks
        for _, low in self.levels[:-1]:
            starts = np.arange(0, len(low), FANOUT)
            ends.append((np.minimum.reduceat(ends[-1][0], starts), np.maximum.reduceat(ends[-1][1], starts)))
        out, most = [np.zeros((0, 2), np.int64)], [np.zeros(0)]
        stack = [(len(self.levels) - 1, 0, 0)] if len(self.sizes) > 1 else []
        while stack:
            level, i, j = stack.pop()
            (high, low), (least, greatest) = self.levels[level - 1], ends[level - 1]
            x = slice(i * FANOUT, min((i + 1) * FANOUT, len(low)))
            y = slice(j * FANOUT, min((j + 1) * FANOUT, len(low)))
            differ = (least[x, None] != greatest[None, y]) | (greatest[x, None] != least[None, y])
            if not differ.any():
                continue
            both = np.minimum(high[x, None], high[None, y]).sum(2)
            both = np.minimum(both, high[x].sum(1)[:, None])
            fit = _bound(both, low[x, None], low[None, y], per_cent) & differ
            a, b = np.nonzero(fit)
            a, b = a + x.start, b + y.start
            if level > 1:
                stack += [(level - 1, p, q) for p, q in zip(a.tolist(), b.tolist(), strict=True) if p <= q]
            else:
                ok = a < b
                out.append(np.stack([self.order[a[ok]], self.order[b[ok]]], 1))
                count += len(out[-1])
                if limit is not None and count > limit:
                    return None
                shared = both[a[ok] - x.start, b[ok] - y.start]
                most.append(shared / (low[a[ok]] + low[b[ok]] - shared))
        return np.concatenate(out), np.concatenate(most)


def _forest(pairs: np.ndarray, most: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Those pairs, most similar first, that join what no pair before has joined."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    held, apart = [], len(np.unique(marks[pairs]))
    for i in np.lexsort((pairs[:, 1], pairs[:, 0], -most)).tolist():
        a, b = root(int(marks[pairs[i, 0]])), root(int(marks[pairs[i, 1]]))
        if a != b:
            up[b] = a
            held.append(i)
            if len(held) + 1 == apart:
                break
    return pairs[held]


def _fine_within(fine: list[np.ndarray], sizes: np.ndarray, pairs: np.ndarray, per_cent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs (numbers of sets with these fine points), whether each is within the fine points' bound, and its similarity at most."""
    ok, most = np.zeros(len(pairs), bool), np.zeros(len(pairs))
    if not len(pairs):
        return ok, most
    used, at = np.unique(pairs, return_inverse=True)
    at = at.reshape(-1, 2)
    own = [fine_bits(int(sizes[i])) for i in used]
    bits = min(own)
    while bits > 8 and (len(used) << bits) > FINE_BYTES:
        bits -= 1
    counts = [np.bincount((fine[i] >> np.uint64(k - bits)).astype(np.int64), minlength=1 << bits) for i, k in zip(used, own, strict=True)]
    kind = np.uint8 if max(int(c.max()) for c in counts) < 256 else np.uint32
    table, n = np.stack([c.astype(kind) for c in counts]), sizes[used]
    step = max(1, 8_000_000 >> bits)
    for i in range(0, len(pairs), step):
        x, y = at[i : i + step].T
        both = np.minimum(table[x], table[y]).sum(1, dtype=np.int64)
        ok[i : i + step] = _bound(both, n[x], n[y], per_cent)
        most[i : i + step] = both / (n[x] + n[y] - both)
    return ok, most


def _tree_pairs(per_cent: int, forest: bool):
    """part, a, b: pairs to verify in a part's cells; not those that failed there before. A cell that holds more gives its name as a, b null.

    rows: cell, cls, comp of the members, and the failed pairs as cls, comp where cell is null; points: cls, n, fine."""

    def run(key, rows, points):
        cls, example = np.unique(points.column("cls").to_numpy(), return_index=True)
        size = points.column("n").to_numpy()[example]
        fine = [np.cumsum(unpacked(x.as_py(), np.uint64), dtype=np.uint64) for x in points.column("fine").combine_chunks().take(pa.array(example))]
        count = np.array([np.bincount((f >> np.uint64(fine_bits(int(n)) - 8)).astype(np.int64), minlength=256) for f, n in zip(fine, size, strict=True)], np.int32).reshape(-1, 256)
        inside = rows.filter(pa.compute.is_valid(rows.column("cell")))
        gone = rows.filter(pa.compute.is_null(rows.column("cell")))
        cell, member, mark = (inside.column(c).to_numpy() for c in ("cell", "cls", "comp"))
        member = np.searchsorted(cls, member)
        order = np.lexsort((member, cell))
        cell, member, mark = cell[order], member[order], mark[order]
        first = np.flatnonzero(np.diff(cell, prepend=~cell[:1]))
        code = lambda x, y: np.minimum(x, y) * len(cls) + np.maximum(x, y)
        known = np.isin(gone.column("cls").to_numpy(), cls) & np.isin(gone.column("comp").to_numpy(), cls)
        seen = np.unique(code(*(np.searchsorted(cls, gone.column(c).to_numpy()[known]) for c in ("cls", "comp"))))
        passing, best = np.zeros(0, np.int64), np.zeros(0)
        found, more = [np.zeros((0, 2), np.int64)], []
        for a, b in zip(first, np.append(first, len(cell))[1:], strict=True):
            own = member[a:b]
            pairs, _ = Tree(count[own], size[own], mark[a:b]).pairs(per_cent, mark[a:b])
            codes = code(*own[pairs].T)
            new = np.flatnonzero(~np.isin(codes, seen))
            ok, most = _fine_within(fine, size, own[pairs[new]], per_cent)
            seen = np.union1d(seen, codes[new])
            passing, best = np.concatenate([passing, codes[new[ok]]]), np.concatenate([best, most[ok]])
            line = np.argsort(passing)
            passing, best = passing[line], best[line]
            held = np.isin(codes, passing)
            pairs, most = pairs[held], best[np.searchsorted(passing, codes[held])]
            if forest and len(pairs) > FEW * (b - a):
                pairs = _forest(pairs, most, mark[a:b])
                more.append(int(cell[a]))
            found.append(np.sort(cls[own[pairs]].reshape(-1, 2), 1))
        pairs = np.unique(np.concatenate(found), axis=0)
        a, b = [*pairs[:, 0].tolist(), *more], [*pairs[:, 1].tolist(), *[None] * len(more)]
        return pa.Table.from_arrays([pa.array([key[0].as_py()] * len(a), pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["part", "a", "b"])

    return run


def fine_point(hashes: np.ndarray) -> np.ndarray:
    """The groups of a set's shingles among `FINE` groups a shingle or more (a power of two): a sparse count vector, in order."""
    return hashes >> np.uint64(64 - fine_bits(len(hashes)))


def fine_bits(n: int) -> int:
    return max(8, (FINE * n - 1).bit_length())


def fine_overlap(x: np.ndarray, y: np.ndarray) -> int:
    """The sum of the coordinates' minima of two fine points: never less than the intersection of their sets."""
    bits = [fine_bits(len(v)) for v in (x, y)]
    x, y = ((v >> np.uint64(own - min(bits))).astype(np.int64) for v, own in zip((x, y), bits, strict=True))
    return int(np.minimum(np.bincount(x, minlength=1 << min(bits)), np.bincount(y, minlength=1 << min(bits))).sum())


def set_overlap(x: np.ndarray, y: np.ndarray) -> int:
    return len(np.intersect1d(x, y, assume_unique=True))


def _checked(pairs: DataFrame, sets: DataFrame, per_cent: int, column: str) -> DataFrame:
    """The pairs whose fine points (column "fine": a bound) or sets (column "hashes": exact) are similar enough."""
    left, right = (sets.select(F.col("cls").alias(c), F.col(column).alias(f"v{c}")) for c in "ab")
    overlap = {"fine": fine_overlap, "hashes": set_overlap}[column]

    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.cumsum(unpacked(v.as_py(), np.uint64), dtype=np.uint64) for v in (x, y))
                ok.append(bool(_bound(overlap(x, y), len(x), len(y), per_cent)))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(right, "b").join(left, "a").select("a", "b", "va", "vb").mapInArrow(trimmed(run), "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Distinct pairs whose sets are similar enough. Whole sets travel only for pairs that the fine points allow."""
    allowed = kept(_checked(pairs, sets, per_cent, "fine"), "allowed")
    return _checked(allowed, sets, per_cent, "hashes").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, comp (the least node reachable) of each node of the edges (a, b), written: alternating large and small stars."""

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    now = kept(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before, here, held = None, state(now), [now]
    while here != before:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        now = kept(small.filter("a <> b").distinct(), "edges")
        before, here = here, state(now)
        held.append(now)
    out = kept(now.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()), "components")
    dropped(*held)
    return out


def _few(keys: DataFrame) -> DataFrame:
    """keys (written before), to be broadcast where they are `BROADCAST_KEYS` rows at most; else Spark shuffles both sides."""
    return F.broadcast(keys) if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else keys


def _packed_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """cls, n, fine, hashes of the sets of a column of texts."""

    def run(batches):
        seen = {0}
        for batch in batches:
            out: dict[str, list] = {"cls": [], "n": [], "fine": [], "hashes": []}
            for _, h in _sets(batch.column(0), shingle):
                if len(h) and (name := class_of(h)) not in seen:
                    seen.add(name)
                    out["cls"].append(name)
                    out["n"].append(len(h))
                    out["fine"].append(packed(np.diff(fine_point(h), prepend=np.uint64(0))))
                    out["hashes"].append(packed(np.diff(h >> np.uint64(16), prepend=np.uint64(0))))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema({"cls": pa.int64(), "n": pa.int64(), "fine": pa.binary(), "hashes": pa.binary()}))

    return texts.mapInArrow(trimmed(run), "cls long, n long, fine binary, hashes binary")


def _links(named: DataFrame, classes: DataFrame, shingle: int, per_cent: int) -> DataFrame:
    """a, b: verified pairs of classes, enough of them to join what links join. classes: cls, least (key) of the rows in named."""
    spark = named.sparkSession
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    ranges = max(LEAST_RANGES, -(-total // (2 * ENTRIES)))
    met = kept(_cells(named, shingle, per_cent, ranges).groupBy("range").applyInArrow(trimmed_group(_met(per_cent)), "cell long, a long, b long"), "met")
    first = kept(met.filter("cell is null").select("a", "b").distinct(), "first-pairs")
    touched = met.select(F.explode(F.array("a", "b")).alias("cls")).filter("cls is not null").distinct()  # of pairs, and all members of cells that aren't done
    holders = kept(classes.join(touched, "cls").select(F.col("least").alias("key")).distinct(), "holders")
    sets = kept(_packed_sets(named.join(_few(holders), "key", "left_semi").select("text"), shingle).dropDuplicates(["cls"]), "sets")
    links = kept(_verified(first, sets, per_cent), "links")
    cells = kept(met.filter("cell is not null").select("cell", F.col("a").alias("cls")).distinct(), "cells")
    failed, n_round, width = first.limit(0).select(F.lit(0).cast("long").alias("part"), "a", "b"), 0, shuffle_width(spark)
    held = [met, first, holders, sets, links, cells]
    while cells.limit(1).count():
        comps = components(links)
        marked = cells.join(comps, cells["cls"] == comps["node"], "left").select("cell", "cls", F.coalesce("comp", "cls").alias("comp"))
        mixed = marked.groupBy("cell").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("cls").alias("center")).filter("lo <> hi")
        open_ = marked.join(mixed.select("cell", "center"), "cell").filter("cls <> center")
        dealt = open_.select(F.pmod(F.xxhash64("center", F.pmod(F.col("cell"), F.lit(SPREAD))), F.lit(width)).alias("part"), "cell", "cls", "comp")
        dealt = kept(dealt, "open-cells")
        again = spark.read.schema(dealt.schema).parquet(dealt.kept_at)  # else Spark takes both sides' columns for the same
        points = again.select(F.col("part").alias("to"), "cls").distinct().join(sets.select("cls", "n", "fine"), "cls").select("to", "cls", "n", "fine")
        rows = dealt.unionByName(failed.join(dealt.select("part").distinct(), "part", "left_semi").select("part", F.lit(None).cast("long").alias("cell"), F.col("a").alias("cls"), F.col("b").alias("comp")))
        sent = kept(rows.groupBy("part").cogroup(points.groupBy("to")).applyInArrow(trimmed_cogroup(_tree_pairs(per_cent, n_round < FORESTS)), "part long, a long, b long"), "pairs")
        pairs = sent.filter("b is not null")
        more = kept(_verified(pairs.select("a", "b").distinct(), sets, per_cent), "more-links")
        links = links.unionByName(more)
        cells = kept(cells.join(sent.filter("b is null").select(F.col("a").alias("cell")), "cell", "left_semi"), "cells")
        n_round = n_round + 1 if more.limit(1).count() else FORESTS  # where a forest joined nothing, the rest goes at once
        failed = failed.unionByName(pairs.join(more, ["a", "b"], "left_anti").select("part", "a", "b"))
        held += [comps, dealt, sent, more, cells]
    out = kept(links, "all-links")
    dropped(*held)
    return out


def linked(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, per_cent: int = PER_CENT) -> DataFrame:
    """key, n_shingles, component_id (the least key reachable), class_id (of its set): one row for each row of docs."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    named = rows.filter(F.col("key").isNotNull())
    signed = kept(signatures(rows, shingle), "signatures")
    classes = kept(signed.filter("n_shingles > 0 and key is not null").groupBy("cls").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n_rows"), F.first("n_shingles").alias("n_shingles")), "classes")
    links = _links(named, classes, shingle, per_cent)
    one, two = (classes.select(F.col("cls").alias(c), F.col("least").alias(f"key_{c}")) for c in "ab")
    comps = components(links.join(one, "a").join(two, "b").select(F.col("key_a").alias("a"), F.col("key_b").alias("b")))
    # of classes of a single row without links the row itself tells the component
    moved = classes.join(comps, classes["least"] == comps["node"], "left").filter("n_rows > 1 or comp is not null").select("cls", F.coalesce("comp", "least").alias("component"))
    moved = kept(moved, "moved")
    own = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    out = kept(signed.join(_few(moved), "cls", "left").select("key", "n_shingles", own.alias("component_id"), F.col("cls").alias("class_id")), "linked")
    dropped(signed, classes, links, comps, moved)
    return out


def first_of_each(docs: DataFrame, *, shingle: int, per_cent: int, text: str = "text") -> DataFrame:
    """The rows of docs but those that another of their component stands for: that of the least doc_id (nulls last; of several texts with that id, of the least hash; of equal rows, one).

    A row is named by a hash of doc_id and text, so that rows with one id, or none, are told apart by their texts.
    Texts without words all stay. Texts aren't shuffled where the rows to drop are few enough to be broadcast."""
    name = F.xxhash64(F.col("doc_id").cast("long"), F.col(text))
    named = docs.select(name.alias("__name"), F.col(text).alias("__text"))
    every = linked(named, key="__name", text="__text", shingle=shingle, per_cent=per_cent)
    found = every.filter("n_shingles > 0")
    groups = kept(found.groupBy(F.col("component_id").alias("component")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("component"), "groups")
    inside = found.join(_few(groups), found["component_id"] == groups["component"]).select(F.col("key").alias("__name"), "component")
    inside = kept(inside.groupBy("__name").agg(F.first("component").alias("component"), F.count(F.lit(1)).alias("n")), "inside")
    ids = docs.select(name.alias("__name"), F.col("doc_id").cast("long").alias("id")).join(_few(inside), "__name")
    lead = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("__name"))).alias("lead")
    leads = kept(ids.groupBy("component").agg(lead).select(F.col("lead.__name").alias("__name")), "leads")
    named_here, once_here = (free_name(docs, x) for x in ("__name", "__once"))
    gone = inside.join(leads.withColumn("first", F.lit(True)), "__name", "left").filter("first is null or n > 1").select(F.col("__name").alias(named_here), F.coalesce("first", F.lit(False)).alias(once_here))
    gone = kept(gone, "gone")
    dropped(every, groups, inside, leads)
    marked = docs.withColumn(named_here, name).join(_few(gone), named_here, "left")
    once = marked.filter(F.col(once_here)).dropDuplicates([named_here])
    return marked.filter(F.col(once_here).isNull()).unionByName(once).select(*(F.col(f"`{c}`") for c in docs.columns))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")
