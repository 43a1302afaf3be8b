"""Secret scans by a linear-chain conditional random field: tokens are tagged secret begin, inside or outside.

Texts are cut into tokens (runs without white space); a token's features are its shape (character classes, length,
how mixed it is), the neighbouring words' shapes and cue words, and features of the whole file. Features are looked up
once for each distinct token of a slice and added by gathering, for all tokens of the slice at once. Viterbi decoding
is exact: where the score of `outside` exceeds the others by more than any transition can give back, every best path
passes through `outside`, so that the sequence falls apart there, and only the short rests are decoded.

The weights maximise the conditional likelihood (forward-backward) of tags in windows of a bounded sample of documents:
the `SAMPLE` least hashes of doc_id. The tags come from the base patterns, and from secrets that those patterns do not
find: made ones (`made_secret`: other cue words, other alphabets, prefixes and groups) are put in place of words of the
sample's own windows, some of them without a cue. A token that looks like a secret (`_secretive`) though no pattern takes
it is neither taught as a secret nor as none: it is left out. The sample is the only thing that is bounded. Every text is scanned whole, by the patterns and by
the model; the model adds spans and removes none. Null and empty texts have no spans; repeated rows have equal spans; an
empty table gives no rows; of its columns only doc_id and the text are read (`redact` carries the others, whatever their
names). There is no shuffle but the sample's.
"""

from __future__ import annotations

import random
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Texts, give_back, parts, raw_slices, table, trimmed

SLICE = 4000  # windows a step of training holds at once
PART = 200_000  # bytes of text that are scanned at once, a text at least; arrays over them take about a hundred times as much
SAMPLE = 4000
WINDOW = 24
WINDOWS_A_DOC = 24
MADE_A_DOC = 3
SHAPES, WORDS, FILES = 1728, 8192, 32
KINDS = ("assign", "access", "hex", "crf")
_OUT, _BEGIN, _IN = 0, 1, 2
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_CUES = (b"passw", b"secret", b"token", b"apikey", b"api_key")
_TRIM = frozenset(b"\"'`.,;:!?()[]{}<>|#*$%&=")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns' matches in code points, by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text) if m.end() - m.start() >= 16]
    return sorted(found)


def _flags() -> dict[str, np.ndarray]:
    code = np.arange(256)
    digit = (code >= 48) & (code < 58)
    upper = (code >= 65) & (code < 91)
    lower = (code >= 97) & (code < 123)
    return {"digit": digit, "upper": upper, "hex": digit | ((code >= 97) & (code < 103)) | ((code >= 65) & (code < 71)), "letter": upper | lower, "wide": code >= 128, "at": code == 64, "dot": code == 46}


_FLAGS = _flags()
_LENGTH = np.digitize(np.arange(27), [2, 3, 6, 9, 13, 17, 25]).astype(np.int32)


class Tokens:
    """The tokens of a slice with the numbers of their features."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        texts = Texts(data, offsets)
        self.starts, self.ends, self.first, self.data = texts.starts, texts.ends, texts.first, data
        size = self.ends - self.starts

        def count(name: str) -> np.ndarray:
            sums = np.zeros(len(data) + 1, np.int32)
            np.cumsum(_FLAGS[name][data], out=sums[1:])
            return sums[self.ends] - sums[self.starts]

        digit, upper, hexes, letter, wide = (count(n) for n in ("digit", "upper", "hex", "letter", "wide"))
        alnum = np.maximum(digit + letter, 1)
        mark = size - digit - letter - wide
        shape = _LENGTH[np.minimum(size, 26)]
        shape = shape * 4 + np.where(digit == 0, 0, np.where(digit * 10 <= 3 * size, 1, np.where(digit * 10 <= 8 * size, 2, 3)))
        shape = shape * 3 + np.where(upper == 0, 0, np.where(2 * upper < size, 1, 2))
        shape = shape * 3 + np.where(hexes == alnum, 2, np.where(10 * hexes >= 8 * alnum, 1, 0))
        shape = shape * 3 + np.where(mark == 0, 0, np.where(3 * mark <= size, 1, 2))
        self.shape = shape * 2 + (wide > 0)
        mail = (count("at") == 1) & (count("dot") > 0)  # addresses are alike as words
        self.word = np.where(mail, 0, (texts.hashes() >> np.uint64(51)).astype(np.int32))
        self.odd = (digit > 0) & (size >= 6)
        many = np.diff(self.first)
        odd = np.concatenate([[0], np.cumsum(self.odd)])
        share = (odd[self.first[1:]] - odd[self.first[:-1]]) / np.maximum(many, 1)
        self.file = np.minimum(np.log2(many + 1).astype(np.int64), 15) * 2 + (share > 0.02)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _scan(data: np.ndarray, offsets: np.ndarray) -> dict[int, tuple[str, list]]:
    """Rows of a slice with base spans: their texts and spans. Rows that hold no cue, no AKIA and no long run of hex digits are passed by."""
    body = data.tobytes()
    low = body.lower()
    hits: list[int] = []
    for cue, where in (*((c, low) for c in _CUES), (b"AKIA", body)):
        at = where.find(cue)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, "right")) - 1
            hits.append(row)
            at = where.find(cue, int(offsets[row + 1]) if row + 1 < len(offsets) else len(body))
    plain = _FLAGS["hex"][data] & ~_FLAGS["upper"][data]
    fresh = np.zeros(len(data) + 1, bool)  # runs end at the edges of rows
    fresh[offsets] = True
    begins = np.flatnonzero(plain & (fresh[:-1] | ~np.concatenate([[False], plain[:-1]])))
    ends = np.flatnonzero(plain & (fresh[1:] | ~np.concatenate([plain[1:], [False]]))) + 1
    hits += (np.searchsorted(offsets, begins[ends - begins >= 16], "right") - 1).tolist()
    out = {}
    for row in sorted(set(hits)):
        text = body[offsets[row] : offsets[row + 1]].decode()
        if spans := base_spans(text):
            out[row] = (text, spans)
    return out


def _tags(tokens: Tokens, found: dict, offsets: np.ndarray) -> np.ndarray:
    """Begin, inside or outside for each token, from base spans; overlapping spans are one."""
    tags = np.zeros(len(tokens.starts), np.int8)
    for row, (text, spans) in found.items():
        a, b = tokens.first[row], tokens.first[row + 1]
        base = int(offsets[row])
        end_before = -1
        for start, _, end in spans:
            if start < end_before:
                continue
            end_before = end
            x, y = base + len(text[:start].encode()), base + len(text[:end].encode())
            i = a + int(np.searchsorted(tokens.ends[a:b], x, "right"))
            j = a + int(np.searchsorted(tokens.starts[a:b], y, "left"))
            tags[i:j] = _IN
            tags[i : i + 1] = _BEGIN
    return tags


#: Cue words and prefixes of made secrets. The base patterns know none of these.
MADE_CUES = ("passphrase", "auth", "auth_key", "credential", "credentials", "private_key", "access_key", "client_key", "bearer", "pwd", "authorization", "signing_key", "session_key", "license_key")
MADE_PREFIXES = ("sk-", "sk_live_", "pk_", "ghp_", "gho_", "xoxb-", "glpat-", "AIza", "ya29.", "eyJ", "npm_", "rk_", "shp-")
_MIXED, _UPPER, _LOWER = string.ascii_letters + string.digits, string.ascii_uppercase + string.digits, string.ascii_lowercase + string.digits


def made_secret(rng: random.Random, cues: tuple[str, ...] = MADE_CUES, prefixes: tuple[str, ...] = MADE_PREFIXES) -> str:
    """A made secret as it stands in a text: a value, mostly with a cue word, an assignment sign and perhaps quotes before and around it."""
    draw = lambda letters, a, b: "".join(rng.choices(letters, k=rng.randint(a, b)))
    kind = rng.randrange(6)
    if kind == 0:
        value = draw(_MIXED + "+/", 20, 48) + rng.choice(["", "=", "=="])
    elif kind == 1:
        value = rng.choice(prefixes) + draw(_MIXED, 16, 40)
    elif kind == 2:
        value = draw("0123456789ABCDEF", 24, 64)
    elif kind == 3:
        value = "-".join(draw(rng.choice([_UPPER, _LOWER]), 4, 8) for _ in range(rng.randint(3, 5)))
    elif kind == 4:
        value = draw(_MIXED + "_-", 22, 43)
    else:
        value = draw(_MIXED + "!@%^&*_-+", 12, 24)
    if kind in (0, 1, 4) and rng.random() < 0.35:
        return value  # recognisable by itself
    quote, cue = rng.choice(["", "", '"', "'"]), rng.choice(cues)
    return rng.choice([cue, cue, cue.upper(), cue.capitalize()]) + rng.choice([" = ", ": ", "=", ":", " := ", " : "]) + quote + value + quote


def _secretive(tokens: Tokens) -> np.ndarray:
    """Tokens of 16 bytes or more with letters and digits in turn and hardly a sign: what may be a secret, and may be none."""
    size = tokens.ends - tokens.starts
    out = np.zeros(len(size), bool)
    for i in np.flatnonzero(tokens.odd & (size >= 16)).tolist():
        raw = tokens.data[tokens.starts[i] : tokens.ends[i]]
        digit, letter = int(_FLAGS["digit"][raw].sum()), int(_FLAGS["letter"][raw].sum())
        out[i] = digit >= 3 and letter >= 3 and digit + letter >= 0.8 * len(raw)
    return out


def _evenly(places: np.ndarray, most: int) -> list[int]:
    """`most` of the places at most, evenly spread over all of them."""
    return places.tolist() if len(places) <= most else places[np.linspace(0, len(places) - 1, most).astype(int)].tolist()


def _windows(batches) -> Iterator[pa.RecordBatch]:
    """Training windows, spread over the whole text: around begins, around other tokens with digits, at even distances; and with made secrets."""
    for batch in batches:
        out: dict[str, list] = {"key": [], "shape": [], "word": [], "tag": [], "file": []}
        for at, _, data, offsets in raw_slices(batch.column(1), 1_000_000):
            tokens = Tokens(data, offsets)
            tags = _tags(tokens, _scan(data, offsets), offsets)
            tags[_secretive(tokens) & (tags == _OUT)] = -1
            for row in range(len(offsets) - 1):
                a, b = int(tokens.first[row]), int(tokens.first[row + 1])
                if a == b:
                    continue
                begin, odd = a + np.flatnonzero(tags[a:b] == _BEGIN), a + np.flatnonzero(tokens.odd[a:b] & (tags[a:b] == _OUT))
                middles = [*_evenly(begin, WINDOWS_A_DOC // 2), *_evenly(odd, WINDOWS_A_DOC // 3)]
                middles += np.linspace(a, b - 1, 4).astype(int).tolist()
                name = f"{batch.column(0)[at + row].as_py()}"
                rng = random.Random(zlib.crc32(f"{name}:{b - a}".encode()))
                places = [*((m, None) for m in dict.fromkeys(middles)), *((rng.randrange(a, b), made_secret(rng)) for _ in range(MADE_A_DOC))]
                for k, (m, made) in enumerate(places):
                    x = max(a, min(m - WINDOW // 2, b - WINDOW))
                    y = min(b, x + WINDOW)
                    shape, word, tag = tokens.shape[x:y].tolist(), tokens.word[x:y].tolist(), tags[x:y].tolist()
                    if made:
                        raw = np.frombuffer(made.encode(), np.uint8)
                        own, i = Tokens(raw, np.array([0, len(raw)])), m - x
                        new = len(own.starts)
                        shape[i : i + 1], word[i : i + 1], tag[i : i + 1] = own.shape.tolist(), own.word.tolist(), [_BEGIN, *[_IN] * (new - 1)]
                        shape, word, tag = shape[:WINDOW], word[:WINDOW], tag[:WINDOW]
                    pad = [-1] * (WINDOW - len(tag))
                    out["key"].append(f"{name}:{k}")
                    out["shape"].append(shape + pad)
                    out["word"].append(word + pad)
                    out["tag"].append(tag + pad)
                    out["file"].append(int(tokens.file[row]))
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema({"key": pa.string(), "shape": pa.list_(pa.int32()), "word": pa.list_(pa.int32()), "tag": pa.list_(pa.int32()), "file": pa.int32()}))


class Field:
    """Weights: of shapes and words for the token itself, for its right and for its left neighbour; of files; of transitions."""

    def __init__(self):
        self.shape, self.word = np.zeros((SHAPES, 9)), np.zeros((WORDS, 9))
        self.file, self.edge = np.zeros((FILES, 3)), np.zeros((3, 3))
        self.edge[_OUT, _IN] = -4.0
        self.file[:, _BEGIN] = self.file[:, _IN] = -1.0

    def light(self) -> tuple[np.ndarray, ...]:
        return tuple(x.astype(np.float32) for x in (self.shape, self.word, self.file, self.edge))

    def emissions(self, shape: np.ndarray, word: np.ndarray, file: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Scores of the three tags for each token of a run of rows; `first` has the first token of each row."""
        own = self.shape[shape] + self.word[word]
        out = own[:, :3] + self.file[file]
        left, right = own[:-1, 3:6].copy(), own[1:, 6:].copy()
        inner = first[(first > 0) & (first < len(shape))]
        left[inner - 1] = right[inner - 1] = 0
        out[1:] += left
        out[:-1] += right
        return out


def _gradient(field: Field, windows: dict[str, np.ndarray], often: np.ndarray) -> dict[str, np.ndarray]:
    """The gradient of the conditional log-likelihood of some windows, by forward and backward sums."""
    tag = windows["tag"]
    n = len(tag)
    real = tag >= 0
    shape, word = np.where(real, windows["shape"], 0), np.where(real, windows["word"], 0)
    gold = np.zeros((n, WINDOW, 3))
    np.put_along_axis(gold, np.where(real, tag, 0)[..., None], 1.0, 2)
    gold *= real[..., None]
    pairs = real[:, 1:] & real[:, :-1]
    own = field.shape[shape] + field.word[word] * often[word][..., None]
    e = own[..., :3] + field.file[windows["file"]][:, None]
    e[:, 1:] += own[:, :-1, 3:6] * pairs[..., None]
    e[:, :-1] += own[:, 1:, 6:] * pairs[..., None]
    e = np.where(real[..., None], e, [0.0, -1e3, -1e3])
    chance = np.exp(np.maximum(e - e.max(2, keepdims=True), -60.0))
    turn = np.exp(field.edge)
    ahead, back = np.empty_like(e), np.ones_like(e)  # forward and backward sums, scaled at each token
    ahead[:, 0] = chance[:, 0]
    for t in range(1, WINDOW):
        x = (ahead[:, t - 1] @ turn) * chance[:, t]
        ahead[:, t] = x / x.sum(1, keepdims=True)
    after = np.empty_like(e)
    after[:, -1] = chance[:, -1]
    for t in range(WINDOW - 2, -1, -1):
        x = after[:, t + 1] @ turn.T
        back[:, t] = x / x.sum(1, keepdims=True)
        after[:, t] = chance[:, t] * back[:, t]
    own = ahead * back
    miss = (gold - own / own.sum(2, keepdims=True)) * real[..., None]
    weight = pairs / np.einsum("nti,ij,ntj->nt", ahead[:, :-1], turn, after[:, 1:], optimize=True)
    both = turn * np.einsum("nti,ntj->ij", ahead[:, :-1] * weight[..., None], after[:, 1:], optimize=True)
    step = {"edge": np.einsum("nti,ntj->ij", gold[:, :-1] * pairs[..., None], gold[:, 1:], optimize=True) - both}
    step["file"] = np.zeros((FILES, 3))
    np.add.at(step["file"], windows["file"], miss.sum(1))
    wide = np.zeros((n, WINDOW, 9))
    wide[..., :3] = miss
    wide[:, :-1, 3:6] = miss[:, 1:] * pairs[..., None]
    wide[:, 1:, 6:] = miss[:, :-1] * pairs[..., None]
    flat = wide[real]
    for k, ids, size in (("shape", shape, SHAPES), ("word", word, WORDS)):
        at = ids[real]
        g = np.stack([np.bincount(at, flat[:, c], size) for c in range(9)], 1)
        step[k] = g * often[:, None] if k == "word" else g
    return step


def train(windows: dict[str, np.ndarray], rounds: int = 80, rate: float = 0.5, decay: float = 2e-4) -> Field:
    """Full-batch AdaGrad on the conditional log-likelihood. Without windows the field tags everything outside."""
    field = Field()
    tag = windows["tag"]
    n = len(tag)
    if not n:
        return field
    often = np.bincount(windows["word"][tag >= 0], minlength=WORDS) >= 5
    total = {k: np.full_like(getattr(field, k), 1e-6) for k in ("shape", "word", "file", "edge")}
    for _ in range(rounds):
        step = {k: np.zeros_like(w) for k, w in total.items()}
        for at in range(0, n, SLICE):
            for k, g in _gradient(field, {k: w[at : at + SLICE] for k, w in windows.items()}, often).items():
                step[k] += g
        for k, g in step.items():
            w = getattr(field, k)
            g = g - decay * n * w
            total[k] += g * g
            w += rate * g / np.sqrt(total[k])
    return field


def decode(scores: np.ndarray, edge: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The best tags of each row. Tokens whose `outside` leads by more than transitions can make up split the rows."""
    out = np.zeros(len(scores), np.int8)
    give = max(0.0, *(edge[a, x] + edge[x, b] - edge[a, _OUT] - edge[_OUT, b] for a in range(3) for b in range(3) for x in (_BEGIN, _IN)), *(edge[x, b] - edge[_OUT, b] for b in range(3) for x in (_BEGIN, _IN)), *(edge[a, x] - edge[a, _OUT] for a in range(3) for x in (_BEGIN, _IN)))
    open_ = scores[:, 0] - scores[:, 1:].max(1) <= give
    if not open_.any():
        return out
    at = np.flatnonzero(open_)
    new_row = np.zeros(len(scores) + 1, bool)
    new_row[first] = True
    starts = np.flatnonzero(np.concatenate([[True], (np.diff(at) > 1) | new_row[at[1:]]]))
    stops = np.append(starts[1:], len(at))
    rows = scores.tolist() if len(at) > len(scores) // 4 else None
    edges = edge.tolist()
    for i, j in zip(at[starts].tolist(), (at[stops - 1] + 1).tolist(), strict=True):
        part = rows[i:j] if rows else scores[i:j].tolist()
        best = list(part[0]) if new_row[i] else [edges[_OUT][x] + part[0][x] for x in range(3)]
        came = []
        for e in part[1:]:
            prev, nxt, frm = best, [], []
            for x in range(3):
                c = [prev[a] + edges[a][x] for a in range(3)]
                a = c.index(max(c))
                frm.append(a)
                nxt.append(c[a] + e[x])
            best = nxt
            came.append(frm)
        if j < len(scores) and not new_row[j]:
            best = [best[x] + edges[x][_OUT] for x in range(3)]
        x = best.index(max(best))
        for k in range(j - 1, i - 1, -1):
            out[k] = x
            if k > i:
                x = came[k - i - 1][x]
    return out


def _model_spans(tags: np.ndarray, tokens: Tokens, offsets: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """Byte spans (within the row) of begin-inside runs, without marks at their ends; an inside without a begin is one."""
    at = np.flatnonzero(tags)
    out: dict[int, list[tuple[int, int]]] = {}
    if not len(at):
        return out
    row = np.searchsorted(tokens.first, at, "right") - 1
    cut = np.concatenate([[True], (tags[at[1:]] == _BEGIN) | (np.diff(at) > 1) | (np.diff(row) > 0)])
    starts = np.flatnonzero(cut)
    for i, j in zip(starts, np.append(starts[1:], len(at)), strict=True):
        x, y = int(tokens.starts[at[i]]), int(tokens.ends[at[j - 1]])
        while x < y and int(tokens.data[x]) in _TRIM:
            x += 1
        while y > x and int(tokens.data[y - 1]) in _TRIM:
            y -= 1
        if x < y:
            r = int(row[i])
            out.setdefault(r, []).append((x - int(offsets[r]), y - int(offsets[r])))
    return out


def sample_of(docs: DataFrame, n: int = SAMPLE) -> DataFrame:
    """At most about n rows of docs: those of the n least hashes of doc_id (rows that share one come together)."""
    key = F.xxhash64(F.lit("secrets"), F.col("doc_id"))
    least = docs.select(key.alias("k")).orderBy("k").limit(n).agg(F.max("k")).first()[0]
    return docs.filter(key <= (least if least is not None else 0)).limit(2 * n)


def fit(docs: DataFrame, *, text: str = "text", sample: int = SAMPLE) -> Field:
    """A field trained on a bounded sample of docs."""
    rows = sample_of(docs, sample).select(F.col("doc_id").cast("string").alias("doc_id"), text)
    got = rows.mapInArrow(trimmed(_windows), "key string, shape array<int>, word array<int>, tag array<int>, file int").toArrow().sort_by("key")
    wide = lambda c, kind: np.array(got.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) if len(got) else [], kind).reshape(-1, WINDOW)
    windows = {"shape": wide("shape", np.int16), "word": wide("word", np.int16), "tag": wide("tag", np.int8), "file": np.array(got.column("file").to_pylist(), np.int16)}
    del got
    field = train(windows)
    give_back()
    return field


def _found(batch_text, weights) -> Iterator[tuple[bytes | None, list[tuple[int, int, int]]]]:
    """Of each row of a text column: its bytes if it has spans, and the spans (start, kind, end) in code points."""
    own = Field()
    own.shape, own.word, own.file, own.edge = weights
    for _, _, data, offsets in raw_slices(batch_text, PART):
        found = _scan(data, offsets)
        tokens = Tokens(data, offsets)
        scores = own.emissions(tokens.shape, tokens.word, tokens.file[tokens.rows()], tokens.first) if len(tokens.starts) else np.zeros((0, 3))
        more = _model_spans(decode(scores, own.edge.astype(float), tokens.first), tokens, offsets)
        for row in range(len(offsets) - 1):
            spans = found[row][1] if row in found else []
            if row in more:
                raw = data[offsets[row] : offsets[row + 1]].tobytes()
                held, added = list(spans), []
                for x, y in more[row]:
                    a = len(raw[:x].decode(errors="ignore"))
                    b = a + len(raw[x:y].decode(errors="ignore"))
                    if not any(s < b and a < e for s, _, e in held):
                        added.append((a, 3, b))
                spans = sorted(held + added)
            yield data[offsets[row] : offsets[row + 1]].tobytes() if spans else None, spans


def scan(docs: DataFrame, field: Field | None = None, *, text: str = "text") -> DataFrame:
    """doc_id and `spans`: an array of (kind, start, end), code points, by start, then kind; base spans, and the field's where none overlaps."""
    weights = (field or fit(docs, text=text)).light()

    def run(batches):
        for batch in batches:
            rows = [spans for _, spans in _found(batch.column(1), weights)]
            flat = [s for spans in rows for s in spans]
            item = pa.StructArray.from_arrays([pa.array([KINDS[k] for _, k, _ in flat], pa.string()), pa.array([s for s, _, _ in flat], pa.int64()), pa.array([e for _, _, e in flat], pa.int64())], names=["kind", "start", "end"])
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, item)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(trimmed(run), "doc_id long, spans array<struct<kind:string,start:bigint,end:bigint>>")


def redact(docs: DataFrame, field: Field | None = None, *, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """docs with each secret of its texts replaced by `mark`; overlapping spans are one. Null stays null."""
    weights, at, schema = (field or fit(docs, text=text)).light(), docs.columns.index(text), docs.schema

    def cut(raw: bytes, spans: list[tuple[int, int, int]]) -> str:
        whole, out, done = raw.decode(), [], 0
        for start, _, end in spans:
            if start >= done:
                out += [whole[done:start], mark]
            done = max(done, end)
        return "".join([*out, whole[done:]])

    def run(batches):
        for batch in batches:
            for part in parts(batch, at, PART):
                old = part.column(at)
                new = [old[i].as_py() if raw is None else cut(raw, spans) for i, (raw, spans) in enumerate(_found(old, weights))]
                yield part.set_column(at, part.schema.field(at), pa.array(new, old.type))

    return docs.mapInArrow(trimmed(run), schema)


def op10_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(line(base), 256).alias("base_sha256"),
        line(F.col("spans")).alias("spans"),
        count("crf").alias("n_crf"),
    )
