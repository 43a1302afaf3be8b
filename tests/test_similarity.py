from difflib import SequenceMatcher

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.functions import similarity as S

WORDS = st.text("abc d", max_size=14)
PAIRS = st.lists(st.tuples(*[st.one_of(st.text("abc d", max_size=14), st.text("ab ßи日\U0001F600", max_size=80))] * 2), max_size=30)


def lcs_by_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@given(WORDS, WORDS)
def test_lcs(a, b):
    assert S.lcs(a, b) == lcs_by_table(a, b)


@given(WORDS, WORDS)
def test_ranges(a, b):
    for kind in ("ratio", "token_sort", "token_set", "partial"):
        assert 0 <= S.KINDS[kind](a, b) <= 100
    assert S.token_set_ratio(a, b) == pytest.approx(S.token_set_ratio(b, a))
    assert S.partial_ratio(a, b) >= S.ratio(a, b) - 1e-9 or len(a) != len(b)
    assert 0 <= S.jaro_winkler(a, b) <= 1 + 1e-9


def test_edges():
    assert S.ratio("", "") == 100 and S.token_set_ratio("", "a") == 0 and S.partial_ratio("", "a") == 0 and S.partial_ratio("", "") == 100
    assert S.token_set_ratio("a b c", "c a") == 100 and S.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert SequenceMatcher(None, "abcd", "bcde").ratio() * 100 == S.ratio("abcd", "bcde")


def test_registered(spark):
    S.register(spark)
    row = spark.range(1).select(F.expr("token_set_ratio('a b', 'b')").alias("x"), F.expr("jaro_winkler('a', 'a')").alias("y"), F.expr("ratio(null, '')").alias("z")).first()
    assert (row.x, row.y, row.z) == (100, 1, 100)


@given(WORDS, WORDS)
def test_partial_ratio_against_all_windows(a, b):
    def best(short, long):
        n = len(short)
        return max(200 * lcs_by_table(short, w) / (n + len(w)) for w in (long[max(0, i) : i + n] for i in range(1 - n, len(long))))

    short, long = sorted((a, b), key=len)
    if short:
        assert S.partial_ratio(a, b) == pytest.approx(max(best(short, long), best(long, short) if len(a) == len(b) else 0))


@given(st.text("abc", max_size=9), st.text("abc", max_size=9))
def test_jaro_winkler_against_duckdb(a, b):
    import duckdb

    if a and b:
        assert S.jaro_winkler(a, b) == pytest.approx(duckdb.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0])


@given(st.text("abßи", max_size=9), st.text("abßи", max_size=9))
def test_jaro_winkler_of_bytes_against_duckdb(a, b):
    import duckdb

    if a and b:
        assert S.jaro_winkler_bytes(a, b) == pytest.approx(duckdb.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0])


@given(PAIRS)
def test_many_pairs_as_one_by_one(pairs):
    a, b = ([p[i] for p in pairs] for i in (0, 1))
    found = S.scores({*S.KINDS}, a, b)
    for kind, one in S.KINDS.items():
        assert found[kind].tolist() == [one(x, y) for x, y in pairs]
    assert S.scores({"ratio"}, a, b)["ratio"].tolist() == found["ratio"].tolist()


def test_long_strings_and_many_letters():
    a = ["ab" * 400, "".join(map(chr, range(200, 900))), "abc " * 30, "x"]
    b = ["ba" * 300 + "c", "".join(map(chr, range(201, 700))), "bca " * 33, "x" * 600]
    for kind in ("ratio", "token_sort", "token_set", "jaro_winkler"):
        assert S.scores({kind}, a, b)[kind].tolist() == [S.KINDS[kind](x, y) for x, y in zip(a, b, strict=True)]
    assert S.scores({"partial"}, a[2:], b[2:])["partial"].tolist() == [S.partial_ratio(x, y) for x, y in zip(a[2:], b[2:], strict=True)]


def test_time_of_long_partial_ratios():
    """Work grows with the strings' lengths, not with windows times lengths (one window at a time, 60 pairs took 2.0 s)."""
    import random
    import time

    draw = random.Random(1)
    a, b = (["".join(draw.choices("abcdefgh ", k=n)) for _ in range(240)] for n in (150, 400))
    began = time.process_time()
    found = S.scores({"partial"}, a, b)["partial"]
    assert time.process_time() - began < 2 and found[0] == S.partial_ratio(a[0], b[0])
