"""Byte-level BPE: length-bucketed padded matrices in which every row merges its leftmost minimum-rank pair each round.

The texts of a batch are cut by the vocabulary's pattern; distinct pieces (by 64-bit hash) are encoded once, and what is
known of pieces is held in sorted arrays of `KEPT_BYTES` at most. Pieces that are no token themselves go to buckets by
length: a padded matrix has a piece a row, and in each round every row that still has a known pair merges the leftmost
one of least rank. Pairs are looked up in a sorted table of hashed pairs, and rows close their gap (compaction) after the
merge. Only pieces above `LONG` bytes, for which rounds would cost the square of the length (a second for 25,000 bytes,
half an hour for a million), are merged by a heap instead, with the same result. Rows do not depend on each other: there is no shuffle.

Null and empty text have no tokens; special tokens are not recognised; repeated rows and ids give repeated rows; an empty
table gives none. Columns whose names clash with new ones are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import raw_slices, span_hashes, table, trimmed

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LONG = 1024
KEPT_BYTES = 16_000_000
SLICE = 500_000
#: The pattern that `cut` knows how to apply to arrays; any other is applied by its library.
USUAL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BUCKETS = (3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 16, 18, 20, 24, 32, 48, 96, 192, 384, 640, LONG)
_NONE = np.int32(2**31 - 1)


class Codec:
    """Encodes and decodes by the ranks of a tiktoken file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
        self.size = max(self.ranks.values(), default=-1) + 1
        self.tokens: list[bytes] = [b""] * self.size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        import regex

        self.split, self.usual = regex.compile(pattern).findall, pattern == USUAL_PATTERN
        self.byte = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.byte < 0).any():
            raise ValueError("a byte-level vocabulary has a token for each byte")
        pairs: dict[int, int] = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = rank
        self.pair_rank = pairs
        self._hash(pairs)
        pair = np.arange(65536)
        self.byte_pair = self.rank_of(self.byte[pair >> 8], self.byte[pair & 255])
        self.lengths = np.fromiter(map(len, self.tokens), np.int64, self.size)
        self.places = np.concatenate([[0], np.cumsum(self.lengths)])
        self.flat = np.frombuffer(b"".join(self.tokens), np.uint8)
        self._forget()

    def _forget(self) -> None:
        """Empties the table of known pieces: their hashes, sorted; where the ids of each begin in `ids`, and how many there are."""
        self.names, self.starts, self.many, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def _keep(self, names: np.ndarray, ids: list[bytes]) -> None:
        many = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        starts = len(self.ids) + np.cumsum(many, dtype=np.int64) - many
        every = np.concatenate([self.names, names])
        order = np.argsort(every, kind="stable")
        self.names, self.starts, self.many = every[order], np.concatenate([self.starts, starts])[order], np.concatenate([self.many, many])[order]
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), "<u4")])

    def _hash(self, pairs: dict[int, int]) -> None:
        """An open-addressing table of the pairs, probed for whole arrays at once."""
        bits = max(4, int(np.ceil(np.log2(4 * len(pairs) + 2))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int32)
        keys, values = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = self._slot(keys)
        self.probes = 0
        while len(keys):
            self.probes += 1
            free = self.keys[slots] < 0
            _, first = np.unique(slots[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.keys[slots[put]], self.values[slots[put]] = keys[put], values[put]
            left = np.ones(len(keys), bool)
            left[put] = False
            keys, values, slots = keys[left], values[left], (slots[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids; `_NONE` where the two don't merge."""
        keys = left.astype(np.int64) * self.size + right
        slots, out = self._slot(keys), np.full(keys.shape, _NONE, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        flat_keys, flat_slots, flat_out = keys.reshape(-1), slots.reshape(-1), out.reshape(-1)
        for _ in range(self.probes):
            if not len(open_):
                break
            at = flat_slots[open_]
            found = self.keys[at]
            hit = found == flat_keys[open_]
            flat_out[open_[hit]] = self.values[at[hit]]
            more = ~hit & (found >= 0)
            open_ = open_[more]
            flat_slots[open_] = (flat_slots[open_] + 1) & self.mask
        return out

    def merge_bucket(self, pieces: list[bytes]) -> list[bytes]:
        """All rows of one padded matrix at once: the ids of each, as little-endian 32-bit integers."""
        width = max(map(len, pieces))
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        rows = np.where(np.arange(width) < lengths[:, None], self.byte[data], np.int32(-1))
        ranks = np.where(np.arange(1, width) < lengths[:, None], self.byte_pair[data[:, :-1].astype(np.int32) * 256 + data[:, 1:]], _NONE)
        out: list[bytes] = [b""] * len(pieces)
        own = np.arange(len(pieces))

        def finish(rows: np.ndarray, own: np.ndarray) -> None:
            full = rows >= 0
            ends = np.cumsum(full.sum(1)) * 4
            flat = rows[full].astype("<u4").tobytes()
            for i, a, b in zip(own.tolist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                out[i] = flat[a:b]

        while len(own):
            if rows.shape[1] < 2:
                finish(rows, own)
                break
            at = ranks.argmin(1)
            line = np.arange(len(own))
            best = ranks[line, at]
            done = best == _NONE
            if done.any():
                finish(rows[done], own[done])
                go = ~done
                rows, ranks, own, at, best = rows[go], ranks[go], own[go], at[go], best[go]
                if not len(own):
                    break
                used = int((rows >= 0).any(0).sum())
                rows, ranks, line = rows[:, :used], ranks[:, : max(used - 1, 1)], np.arange(len(own))
            rows[line, at] = best
            column = np.arange(rows.shape[1] - 1)
            rows = np.where(column > at[:, None], rows[:, 1:], rows[:, :-1])
            if rows.shape[1] < 2:
                continue
            ranks = np.where(column[:-1] > at[:, None], ranks[:, 1:], ranks[:, :-1])
            inside = np.flatnonzero(at < rows.shape[1] - 1)
            ranks[inside, at[inside]] = self.rank_of(rows[inside, at[inside]], rows[inside, at[inside] + 1])
            inside = np.flatnonzero(at > 0)
            ranks[inside, at[inside] - 1] = self.rank_of(rows[inside, at[inside] - 1], rows[inside, at[inside]])
        return out

    def merge_long(self, piece: bytes) -> bytes:
        """The same merges in n log n: a heap of pairs by rank and place over a linked list."""
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        n, size, ranks = len(ids), self.size, self.pair_rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := ranks.get(ids[i] * size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get(rank * size + ids[k])) is not None:
                    heapq.heappush(heap, (r, i, rank, ids[k]))
            if (h := before[i]) >= 0 and (r := ranks.get(ids[h] * size + rank)) is not None:
                heapq.heappush(heap, (r, h, ids[h], rank))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, data in enumerate(pieces):
            if (rank := self.ranks.get(data)) is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(data) > LONG:
                out[i] = self.merge_long(data)
            else:
                buckets.setdefault(next(x for x in _BUCKETS if len(data) <= x), []).append(i)
        for width, own in buckets.items():
            step = max(64, 200_000 // width)
            for at in range(0, len(own), step):
                part = own[at : at + step]
                for i, ids in zip(part, self.merge_bucket([pieces[i] for i in part]), strict=True):
                    out[i] = ids
        return out

    def encode_column(self, column: pa.Array, most: int = SLICE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For slices of a text column: the ids of all its rows, and how many each row has."""
        for _, _, data, offsets in raw_slices(column, most):
            places, first = self.cut(data, offsets)
            yield self.encode_pieces(data, places, first)

    def encode_pieces(self, data: np.ndarray, places: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """places: where each piece starts, and the end; first: of each row, the number of its first piece."""
        names, example, own = np.unique(span_hashes(data, places[:-1], places[1:]), return_index=True, return_inverse=True)
        if self.names.nbytes + self.starts.nbytes + self.many.nbytes + self.ids.nbytes > KEPT_BYTES:
            self._forget()
        at = np.searchsorted(self.names, names)
        new = np.flatnonzero((np.append(self.names, 0)[at] != names) | (at == len(self.names)))
        if len(new):
            body, ends = data.tobytes(), places[example[new] + 1].tolist()
            self._keep(names[new], self.merged([body[a:b] for a, b in zip(places[example[new]].tolist(), ends, strict=True)]))
            at = np.searchsorted(self.names, names)
        ends = np.concatenate([[0], np.cumsum(self.many[at][own], dtype=np.int64)])
        ids = self.ids[np.arange(ends[-1]) + np.repeat(self.starts[at][own] - ends[:-1], np.diff(ends))]
        return ids, ends[first[1:]] - ends[first[:-1]]

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces that the pattern finds, whole arrays at once where it is the usual pattern.

        That pattern is: a contraction; letters, numbers or other signs, each with a space before them or without; and
        white space, of which a run leaves its last character to what follows."""
        if not len(data):
            return np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
        if not self.usual:
            return self._cut_by_pattern(data, offsets)
        signs = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        n = len(signs)
        place = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        rows = np.searchsorted(place, offsets)
        kind = _kinds()[signs]
        head = np.zeros(n + 1, bool)
        head[rows] = True
        head[1:n] |= kind[1:] != kind[:-1]
        head[n] = True
        start = head[:n].copy()
        space, run = kind == 0, np.flatnonzero(head[:n])
        run_end = np.append(run[1:], n)
        new_row = np.zeros(n + 1, bool)
        new_row[rows] = True
        # white space: the last of a longer run stands alone or goes with what follows
        blank = space[run] & ~new_row[run_end]
        start[run_end[blank] - 1] = True
        joined = run_end[blank & (signs[run_end - 1] == 0x20)]
        start[joined] = False
        # contractions: an apostrophe that is a run of its own, without a space before it
        quote = np.flatnonzero((signs == 0x27) & head[:n] & head[1:] & start)
        quote = quote[~new_row[quote + 1]]
        one = signs[quote + 1]
        two = np.where(new_row[np.minimum(quote + 2, n)], 0, signs[np.minimum(quote + 2, n - 1)])
        size = np.select([np.isin(one, [115, 116, 109, 100]), ((one == 114) | (one == 118)) & (two == 101), (one == 108) & (two == 108)], [1, 2, 2], 0)
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        rest = quote + 1 + size
        start[rest[rest < n]] = True
        at = np.flatnonzero(start)
        return np.append(place[at], len(data)), np.searchsorted(at, rows)

    def _cut_by_pattern(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places, first = [0], [0]
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            pieces = [len(x.encode()) for x in self.split(data[a:b].tobytes().decode())]
            if sum(pieces) != b - a:
                raise ValueError("the pattern leaves out a part of a text")
            for x in pieces:
                places.append(places[-1] + x)
            first.append(len(places) - 1)
        return np.array(places), np.array(first)

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, in order."""
        out: list[np.ndarray] = []
        for ids, many in self.encode_column(pa.array(texts, pa.string())):
            out += np.split(ids, np.cumsum(many)[:-1])
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of all tokens, gathered at once from one flat table."""
        out = []
        for at in range(0, len(ids), 1 << 18):
            part = ids[at : at + (1 << 18)].astype(np.int64)
            sizes = self.lengths[part]
            ends = np.cumsum(sizes)
            out.append(self.flat[np.arange(ends[-1]) + np.repeat(self.places[part] - (ends - sizes), sizes)].tobytes())
        return b"".join(out)


_KINDS: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """Of each code point: 0 white space, 1 letter, 2 number, 3 other, as the pattern's library has them."""
    if not _KINDS:
        import regex

        every = "".join(map(chr, [*range(0xD800), *([0x21] * 0x800), *range(0xE000, 0x110000)]))
        out = np.full(0x110000, 3, np.uint8)
        for kind, of in enumerate((r"\s+", r"\p{L}+", r"\p{N}+")):
            for m in regex.finditer(of, every):
                out[m.start() : m.end()] = kind
        _KINDS.append(out)
    return _KINDS[0]


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(vocabulary: str = VOCABULARY) -> Codec:
    """The codec of a vocabulary file (a name among the public tokenizers, or a path), made once in a process."""
    import public_tokenizers

    path = vocabulary if "/" in vocabulary else str(public_tokenizers.path(vocabulary))
    key = (path, public_tokenizers.PATTERN)
    if key not in _CODECS:
        _CODECS[key] = Codec(*key)
    return _CODECS[key]


def encode(docs: DataFrame, *, text: str = "text", vocabulary: str = VOCABULARY, ids: str = "token_ids") -> DataFrame:
    """docs with a column `ids` of token ids (array<int>), replacing one of that name. Null text has none."""
    held = [c for c in docs.columns if c != ids]
    source = docs.select(*(F.col(f"`{c}`") for c in held))

    def run(batches):
        tool = codec(vocabulary)
        for batch in batches:
            column = batch.column(held.index(text))
            for at in range(0, max(1, batch.num_rows), 256):
                part = batch.slice(at, 256)
                got = list(tool.encode_column(column.slice(at, 256)))
                values = np.concatenate([*(x for x, _ in got), np.zeros(0, np.uint32)]).astype(np.int32)
                offsets = np.concatenate([[0], *(x for _, x in got)]).cumsum().astype(np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=[*held, ids])

    from pyspark.sql import types as T

    return source.mapInArrow(trimmed(run), T.StructType([*source.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, *, ids: str = "token_ids", out: str = "decoded", vocabulary: str = VOCABULARY) -> DataFrame:
    """df with a binary column `out`, the bytes of its token ids. Null ids give null; an id out of the vocabulary fails."""
    held = [c for c in df.columns if c != out]
    source = df.select(*(F.col(f"`{c}`") for c in held))

    def run(batches):
        tool = codec(vocabulary)
        for batch in batches:
            column = batch.column(held.index(ids))
            got = [None if x is None else tool.decode(np.array(x, np.int64)) for x in column.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.binary())], names=[*held, out])

    from pyspark.sql import types as T

    return source.mapInArrow(trimmed(run), T.StructType([*source.schema.fields, T.StructField(out, T.BinaryType())]))


def digests(docs: DataFrame, *, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of what they decode to: the round trip without moving the ids."""

    def run(batches):
        tool = codec(vocabulary)
        for batch in batches:
            n, a, b = [], [], []
            for ids, many in tool.encode_column(batch.column(1)):
                n += many.tolist()
                body, ends = ids.astype("<u4").tobytes(), (np.cumsum(many) * 4).tolist()
                a += [hashlib.sha256(body[x:y]).hexdigest() for x, y in zip([0, *ends[:-1]], ends, strict=True)]
                text_ends = np.concatenate([[0], np.cumsum(tool.lengths[ids])])[np.cumsum(many)].tolist()
                back = tool.decode(ids)
                b += [hashlib.sha256(back[x:y]).hexdigest() for x, y in zip([0, *text_ends[:-1]], text_ends, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text)).mapInArrow(trimmed(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def round_trip(docs: DataFrame, *, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, token_ids, round_trip (the ids decode to the text's bytes). Null text has no ids."""

    def run(batches):
        tool = codec(vocabulary)
        for batch in batches:
            for at, to, data, offsets in raw_slices(batch.column(1), SLICE):
                places, first = tool.cut(data, offsets)
                ids, many = tool.encode_pieces(data, places, first)
                ends = np.concatenate([[0], np.cumsum(many)])
                back, text_ends = tool.decode(ids), np.concatenate([[0], np.cumsum(tool.lengths[ids])])[ends]
                body = data.tobytes()
                same = [back[text_ends[i] : text_ends[i + 1]] == body[offsets[i] : offsets[i + 1]] for i in range(to - at)]
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(many), lists, pa.array(same, pa.bool_())], names=["doc_id", "n_tokens", "token_ids", "round_trip"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text)).mapInArrow(trimmed(run), "doc_id long, n_tokens long, token_ids array<int>, round_trip boolean")


def token_counts(docs: DataFrame, *, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens."""

    def run(batches):
        tool = codec(vocabulary)
        for batch in batches:
            n = [x for _, many in tool.encode_column(batch.column(1)) for x in many.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text)).mapInArrow(trimmed(run), "doc_id long, n_tokens long")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
