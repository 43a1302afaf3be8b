"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text.

A document's grade is 0 (low quality), 1 (good but toxic) or 2 (good and clean). One weight vector over hashed features
is shared by all grades: P(grade > k) = sigmoid(w.x - t[k]) with ordered thresholds t[0] < t[1]. Features are words
(hashed to 2**22 places, square roots of their shares, so that a text has length one) and bins of the text's surface:
signs, capitals, digits, bars, word length, repeated lines. Scoring gives the expected grade and the tail probability
P(grade >= `GOOD`), by which documents are selected.

The model is fitted on a bounded sample: the `SAMPLE` labelled doc_ids of least hash, of each the row of least text
hash, as far as their features together are `FIT_ENTRIES` at most (a row that would exceed them is passed over); a label
that occurs several times counts once, at its lowest quality and highest toxicity; rows without a grade are left out.
The driver takes the entries a part after another, holds eight bytes an entry and computes gradients by blocks. Everything is scored, whole.
Without labels (or documents) nothing is known and everything is kept. Null and empty texts are scored by their surface
alone. Repeated rows score alike. An empty table gives no rows; columns whose names clash with new ones are replaced.
Scoring needs no shuffle; the weights that are sent are those of words in `LEAST_DOCS` sampled documents at least, so
their number is bounded by the sample's.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Texts, dropped, give_back, kept, raw_slices, table, trimmed

SAMPLE = 20_000
FIT_ENTRIES = 16_000_000
BLOCK = 400_000
PART = 1_000_000
LEAST_DOCS = 8
PLACES = 1 << 22
BINS = 12
SURFACE = 8
GRADES = 3
GOOD = 2
KEEP_AT = 0.5


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, value) of a slice's words, and the surface bins of its rows."""
    texts = Texts(data, offsets)
    rows = np.repeat(np.arange(len(texts)), np.diff(texts.first))
    place = (texts.hashes() >> np.uint64(42)).astype(np.int64)
    names, count = np.unique(rows * PLACES + place, return_counts=True)
    row, place, n = names // PLACES, names % PLACES, np.maximum(np.diff(texts.first), 1)
    value = np.sqrt(count / n[row])

    def share(flag: np.ndarray, of: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flag)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(of, 1)

    size = np.diff(offsets)
    upper, lower = (data >= 65) & (data < 91), (data >= 97) & (data < 123)
    sums = np.concatenate([[0], np.cumsum(upper | lower)])
    letters = sums[offsets[1:]] - sums[offsets[:-1]]
    signs = np.isin(data, np.frombuffer(b"#*$%&<>@^~=_{}[]\\!", np.uint8))
    lines = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        own = data[a:b].tobytes().split(b"\n")
        lines.append(1 - len(set(own)) / len(own))
    small = lambda x: np.minimum(np.ceil(np.sqrt(x) * BINS), BINS - 1)
    bins = np.stack([
        small(share(signs, size)),
        small(share(upper, letters)),
        small(share((data >= 48) & (data < 58), size)),
        small(share(data == 124, size)),
        small(share(data >= 128, size)),
        np.minimum(size / n, BINS - 1),
        small(np.array(lines)),
        np.minimum(np.log2(np.diff(texts.first) + 1), BINS - 1),
    ], 1).astype(np.int64)
    return row, place, value, bins + np.arange(SURFACE) * BINS


@dataclass
class Model:
    """Weights of the places in `places` (sorted), of the surface bins, and the ordered thresholds."""

    places: np.ndarray
    weights: np.ndarray
    surface: np.ndarray
    thresholds: np.ndarray

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, place, value, bins = _features(data, offsets)
        out = self.surface[bins].sum(1)
        if len(self.places):
            at = np.minimum(np.searchsorted(self.places, place), len(self.places) - 1)
            known = self.places[at] == place
            out += np.bincount(row[known], self.weights[at[known]] * value[known], len(out))
        return out

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - scores[:, None], -50, 50)))


def _blocks(first: np.ndarray) -> list[tuple[int, int, slice]]:
    """First row, row after the last and entries of blocks of `BLOCK` entries or so."""
    out, a, n = [], 0, len(first) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(first, first[a] + BLOCK, "right")) - 1)
        out.append((a, b, slice(first[a], first[b])))
        a = b
    return out


def train(grade: np.ndarray, first: np.ndarray, place: np.ndarray, value: np.ndarray, bins: np.ndarray, rounds: int = 200, rate: float = 0.3, decay: float = 2e-6) -> Model:
    """Full-batch Adam on the penalised likelihood of the grades. first: where each row's entries (place, value: overwritten) begin, and their end."""
    n = len(grade)
    if not n:
        return Model(np.zeros(0, np.int64), np.zeros(0), np.zeros(SURFACE * BINS), np.array([-50.0, -50.0]))
    blocks = _blocks(first)
    # block by block and in place, so that the driver holds nothing twice
    count = np.zeros(PLACES, np.int32)
    for _, _, part in blocks:
        np.add.at(count, place[part], 1)
    names = np.flatnonzero(count >= LEAST_DOCS)
    number = np.full(PLACES, -1, np.int32)
    number[names] = np.arange(len(names), dtype=np.int32)
    starts, end = np.zeros(n + 1, np.int64), 0
    for a, b, part in blocks:
        found = number[place[part]]
        held = found >= 0
        to = end + int(held.sum())
        place[end:to], value[end:to] = found[held], value[part][held]
        starts[a + 1 : b + 1] = end + np.concatenate([[0], np.cumsum(held)])[first[a + 1 : b + 1] - first[a]]
        end = to
    first, at, value = starts, place[:end], value[:end]
    blocks = _blocks(first)
    del count, number
    size = np.bincount(grade, minlength=GRADES)
    weight = np.sqrt(n / (GRADES * np.maximum(size, 1)))[grade]
    weight /= weight.sum()
    line = np.arange(n)
    x = {"w": np.zeros(len(names)), "s": np.zeros(SURFACE * BINS), "t": np.array([-2.0, 0.0])}  # t: first threshold, log of the step to the next
    m, v = ({k: np.zeros_like(a) for k, a in x.items()} for _ in range(2))
    for step in range(1, rounds + 1):
        s = x["s"][bins].sum(1)
        for a, b, part in blocks:
            row = np.repeat(np.arange(b - a), np.diff(first[a : b + 1]))
            s[a:b] += np.bincount(row, x["w"][at[part]] * value[part], b - a)
        t = np.array([x["t"][0], x["t"][0] + np.exp(x["t"][1])])
        up = 1 / (1 + np.exp(np.clip(t - s[:, None], -50, 50)))
        edge = np.concatenate([np.ones((n, 1)), up, np.zeros((n, 1))], 1)
        slope = edge * (1 - edge)
        p = np.maximum(edge[line, grade] - edge[line, grade + 1], 1e-9)
        ds = weight * (slope[line, grade] - slope[line, grade + 1]) / p
        dt = np.zeros((n, GRADES + 1))
        dt[line, grade] -= slope[line, grade] / p
        dt[line, grade + 1] += slope[line, grade + 1] / p
        d1, d2 = (dt[:, 1:3] * weight[:, None]).sum(0)
        dw = -decay * x["w"]
        for a, b, part in blocks:
            dw += np.bincount(at[part], np.repeat(ds[a:b], np.diff(first[a : b + 1])) * value[part], len(names))
        grads = {"w": dw, "s": np.bincount(bins.reshape(-1), np.repeat(ds, SURFACE), SURFACE * BINS) - decay * x["s"], "t": np.array([d1 + d2, d2 * np.exp(x["t"][1])])}
        for k, g in grads.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            x[k] += rate * (0.1 if k == "t" else 1) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return Model(names, x["w"], x["s"], np.array([x["t"][0], x["t"][0] + np.exp(x["t"][1])]))


def graded(labels: DataFrame) -> DataFrame:
    """doc_id, grade of each labelled document."""
    rated = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    one = rated.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("q"), F.max(F.coalesce(F.col("toxic"), F.lit(0))).alias("x"))
    return one.select("doc_id", F.when(F.col("q") < 1, 0).when(F.col("x") > 0, 1).otherwise(2).cast("int").alias("grade"))


def _within(order: np.ndarray, many: np.ndarray, most: int) -> np.ndarray:
    """Which rows to take, in this order, so that their entries are `most` at most; a row that would exceed that is passed over."""
    out, total = np.zeros(len(many), bool), 0
    for i in order.tolist():
        if total + many[i] <= most:
            out[i], total = True, total + int(many[i])
    return out


def fit(docs: DataFrame, labels: DataFrame, *, text: str = "text", sample: int = SAMPLE, entries: int = FIT_ENTRIES) -> Model:
    """A model fitted on the `sample` labelled documents of least hash, of each one row, and on `entries` of their features at most."""
    key = F.xxhash64(F.lit("grades"), F.col("doc_id"))
    chosen = F.broadcast(graded(labels).orderBy(key, "doc_id").limit(sample))  # `sample` rows at most
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("named")).join(chosen, "doc_id").select("doc_id", "grade", "text", "named")

    def run(batches):
        for batch in batches:
            for at, to, data, offsets in raw_slices(batch.column(2), 1_000_000):
                row, place, value, bins = _features(data, offsets)
                first = np.searchsorted(row, np.arange(to - at + 1)).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(first), pa.array(place.astype(np.int32)))
                values = pa.ListArray.from_arrays(pa.array(first), pa.array(value.astype(np.float32)))
                shown = pa.array(bins.astype(np.int32).tolist(), pa.list_(pa.int32()))
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), ids, values, shown], names=["doc_id", "grade", "named", "place", "value", "bins"])

    made = rows.mapInArrow(trimmed(run), "doc_id long, grade int, named long, place array<int>, value array<float>, bins array<int>")
    made = kept(made.withColumn("many", F.size("place")), "features")
    # of each document the row of least text hash; only names and sizes are compared, so that a doc_id of many rows is cheap
    one = made.groupBy("doc_id").agg(F.min(F.struct("named", "many")).alias("least")).select("doc_id", "least.named", "least.many", key.alias("key"))
    sizes = one.toArrow()
    take = _within(np.lexsort((sizes.column("doc_id").to_numpy(), sizes.column("key").to_numpy())), sizes.column("many").to_numpy(), entries)
    wanted = docs.sparkSession.createDataFrame(sizes.select(["doc_id", "named"]).filter(pa.array(take))) if take.any() else one.select("doc_id", "named").limit(0)
    ids, many = (sizes.column(c).to_numpy()[take] for c in ("doc_id", "many"))
    order = np.argsort(ids)
    ids, many = ids[order], many[order].astype(np.int64)
    del sizes, take, order
    if not len(ids):
        dropped(made)
        return train(np.zeros(0, int), np.zeros(1, int), *(np.zeros(0, int) for _ in range(2)), np.zeros((0, SURFACE), int))
    got = kept(made.join(F.broadcast(wanted), ["doc_id", "named"]).groupBy("doc_id").agg(*(F.first(c).alias(c) for c in ("grade", "place", "value", "bins"))), "fitted")
    dropped(made)
    first = np.concatenate([[0], np.cumsum(many)])
    grade, bins = np.zeros(len(ids), int), np.zeros((len(ids), SURFACE), np.int32)
    place, value = np.empty(first[-1], np.int32), np.empty(first[-1], np.float32)  # eight bytes an entry
    parts = 1 + int(first[-1]) // PART  # the driver takes `PART` entries or so at once
    for k in range(parts):
        some = got.filter(F.pmod(F.xxhash64(F.lit("parts"), "doc_id"), F.lit(parts)) == k).toArrow()
        for batch in some.to_batches():
            row = np.searchsorted(ids, batch.column("doc_id").to_numpy())
            grade[row], bins[row] = batch.column("grade").to_numpy(), batch.column("bins").flatten().to_numpy().reshape(-1, SURFACE)
            to = np.concatenate([[0], np.cumsum(many[row])])
            flat = [batch.column(c).flatten().to_numpy() for c in ("place", "value")]
            for i, r in enumerate(row.tolist()):
                for out, x in zip((place, value), flat, strict=True):
                    out[first[r] : first[r + 1]] = x[to[i] : to[i + 1]]
            del batch, flat
        del some
        give_back()
    dropped(got)
    model = train(grade, first, place, value, bins)
    del place, value, bins
    give_back()
    return model


def score(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """docs with `expected_grade`, `tail_probability` (of grade `GOOD` or more) and `keep`; columns of these names are replaced."""
    new = ("expected_grade", "tail_probability", "keep")
    held = [c for c in docs.columns if c not in new]
    source = docs.select(*(F.col(f"`{c}`") for c in held))
    parts = (model.places, model.weights.astype(np.float32), model.surface, model.thresholds)

    def run(batches):
        own = Model(*parts)
        for batch in batches:
            up = [own.tails(own.scores(data, offsets)) for _, _, data, offsets in raw_slices(batch.column(held.index(text)), 1_500_000)]
            tails = np.concatenate(up) if up else np.zeros((0, GRADES - 1))
            tail = tails[:, GOOD - 1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tails.sum(1)), pa.array(tail), pa.array(tail >= KEEP_AT)], names=[*held, *new])

    from pyspark.sql import types as T

    fields = [T.StructField(new[0], T.DoubleType()), T.StructField(new[1], T.DoubleType()), T.StructField(new[2], T.BooleanType())]
    return source.mapInArrow(trimmed(run), T.StructType([*source.schema.fields, *fields]))


def select(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The rows of docs, with their columns, whose tail probability is `KEEP_AT` or more."""
    parts, at = (model.places, model.weights.astype(np.float32), model.surface, model.thresholds), docs.columns.index(text)

    def run(batches):
        own = Model(*parts)
        for batch in batches:
            keep = [own.tails(own.scores(data, offsets))[:, GOOD - 1] >= KEEP_AT for _, _, data, offsets in raw_slices(batch.column(at), 1_500_000)]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(trimmed(run), docs.schema)


def op6_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).drop("text")
