"""String similarities, 0 to 100 (Jaro-Winkler 0 to 1), re-implemented from their public definitions.

`ratio` is 200 * LCS / (length of both), by a bit-parallel longest common subsequence. Spark has no such built-in, so
these run as Arrow-batched pandas UDFs; all similarities of a pair come from one call, and a batch computes each
distinct pair of strings once. The functions of one pair define what `combing` computes for many.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import combing as C
from .combing import lcs


def ratio(a: str, b: str) -> float:
    if a == b:
        return 100.0
    return 200.0 * lcs(a, b) / (len(a) + len(b))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """The best of: common words with either side's, and both sides with each other. 100 if one set holds the other, 0 if a side is empty."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = x & y
    if both and (both == x or both == y):
        return 100.0
    common, own, other = (" ".join(sorted(s)) for s in (both, x - both, y - both))
    left, right = (f"{common} {s}".strip() for s in (own, other))
    best = ratio(left, right)
    if both:
        best = max(best, ratio(common, left), ratio(common, right))
    return best


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter string with a window of the longer, windows at its ends included; 100 if both are empty, 0 if one is."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    if short in long:
        return 100.0
    n, letters = len(short), set(short)
    windows = {long[max(0, i) : i + n] for i in range(1 - n, len(long)) if long[min(i + n, len(long)) - 1] in letters or long[max(0, i)] in letters}
    best = max((ratio(short, w) for w in windows), default=0.0)
    if len(a) == len(b):
        windows = {short[max(0, i) : i + n] for i in range(1 - n, n)}
        best = max(best, *(ratio(long, w) for w in windows))
    return best


def jaro_winkler(a: str | bytes, b: str | bytes) -> float:
    """Jaro similarity, raised by a tenth of the rest for each of up to four common first letters where it is above 0.7."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, matched = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                matched.append(c)
                break
    if not matched:
        return 0.0
    moved = sum(x != y for x, y in zip(matched, (c for c, t in zip(b, taken, strict=True) if t), strict=True)) // 2
    m = len(matched)
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    if jaro <= 0.7:
        return jaro
    first = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(len(a), len(b), 4))
    return jaro + 0.1 * first * (1 - jaro)


def jaro_winkler_bytes(a: str, b: str) -> float:
    """Jaro-Winkler of the UTF-8 bytes, as DuckDB has it; the same for ASCII."""
    return jaro_winkler(a.encode(), b.encode())


KINDS = {"ratio": ratio, "token_sort": token_sort_ratio, "token_set": token_set_ratio, "partial": partial_ratio, "jaro_winkler": jaro_winkler, "jaro_winkler_bytes": jaro_winkler_bytes}


def scores(kinds: set[str], a: list[str], b: list[str]) -> dict[str, np.ndarray]:
    """The similarities of many pairs, as KINDS defines them for one; ratio and partial ratio come from one comparison."""
    out = {}
    if "partial" in kinds:
        out["ratio"], out["partial"] = C.ratios_and_partial(a, b)
    elif "ratio" in kinds:
        out["ratio"] = C.ratios(a, b)
    if "jaro_winkler_bytes" in kinds:
        out["jaro_winkler_bytes"] = C.jaro_winklers(*([s.encode().decode("latin-1") for s in x] for x in (a, b)))
    for kind, score in (("token_sort", C.token_sorts), ("token_set", C.token_sets), ("jaro_winkler", C.jaro_winklers)):
        if kind in kinds:
            out[kind] = score(a, b)
    return out


def similarities(pairs: dict[str, tuple[str, Column, Column]]) -> Column:
    """A struct of similarities: field -> (kind, a, b). Nulls are empty strings. Columns that are one object are sent once."""
    sent: dict[int, Column] = {}
    for _, a, b in pairs.values():
        sent |= {id(a): a, id(b): b}
    place = {k: i for i, k in enumerate(sent)}
    fields = [(name, kind, (place[id(a)], place[id(b)])) for name, (kind, a, b) in pairs.items()]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out, columns = {}, [frame.iloc[:, i].fillna("").tolist() for i in range(frame.shape[1])]
        for sides in dict.fromkeys(x for _, _, x in fields):
            number: dict[tuple[str, str], int] = {}
            row = [number.setdefault(key, len(number)) for key in zip(*(columns[i] for i in sides), strict=True)]
            a, b = ([key[i] for key in number] for i in (0, 1))
            found = scores({kind for _, kind, x in fields if x == sides}, a, b)
            out |= {name: found[kind][row] for name, kind, x in fields if x == sides}
        return pd.DataFrame(out, columns=[name for name, _, _ in fields], dtype="float64")

    run.__annotations__ = {"frame": pd.DataFrame, "return": pd.DataFrame}
    udf = F.pandas_udf(run, ", ".join(f"{name} double" for name, _, _ in fields))
    return udf(F.struct(*(c.alias(f"c{i}") for i, c in enumerate(sent.values()))))


def similarity(kind: str, a: Column, b: Column) -> Column:
    return similarities({"v": (kind, a, b)})["v"]


def register(spark) -> None:
    """The similarities as SQL functions."""
    for kind in KINDS:
        spark.udf.register(kind if kind.startswith(("ratio", "jaro_winkler")) else f"{kind}_ratio", F.pandas_udf(_bound(kind), "double"))


def _bound(kind):
    def run(a, b):
        return pd.Series(scores({kind}, a.fillna("").tolist(), b.fillna("").tolist())[kind], dtype="float64")

    run.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    return run
