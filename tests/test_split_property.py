"""Java String.split equivalence on random strings (N1), both code paths."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.functions import strings as S


def java_split_reference(s: str, pat: str) -> list[str]:
    """java.lang.String.split(regex) with limit 0, written from its contract."""
    out, index, found = [], 0, False
    for m in re.finditer(pat, s, flags=re.ASCII):
        if m.start() == 0 and m.end() == 0:
            continue                       # no leading empty token for a zero-width match
        found = True
        out.append(s[index:m.start()])
        index = m.end()
    if not found:
        return [s]
    out.append(s[index:])
    while out and out[-1] == "":
        out.pop()
    return out


PATTERNS = [r"\W+", r"[^\w']", r"\s*,\s*", r"\s*\|\s*", " ", "::", r"\s+", r"\s*[^\d]+\s*"]
ALPHABET = list("ab'_ ,:-.|/\t\n") + ["é", "Z", "9", "1"]


def random_strings(n: int, seed: int) -> list[str]:
    rnd = random.Random(seed)
    out = ["", " ", ",", "::", ":::", "a:::", "--", "a", "'"]
    while len(out) < n:
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 12))))
    return out


@pytest.mark.parametrize("pat", PATTERNS)
def test_split_matches_java(spark, pat):
    strings = random_strings(600, seed=sum(map(ord, pat)))
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, s string")
    cols = [S.java_split(F.col("s"), pat).alias("fast"),
            S._split_general(F.col("s"), pat, False).alias("general")]
    unit = S._strip_unit(pat)
    if unit is not None:
        cols.append(S._split_class(F.col("s"), pat, unit, False).alias("cls"))
    rows = {r["i"]: r for r in df.select("i", *cols).collect()}
    for i, s in enumerate(strings):
        want = java_split_reference(s, pat)
        r = rows[i]
        assert r["general"] == want, (pat, s, r["general"], want)
        assert r["fast"] == want, (pat, s, r["fast"], want)
        if unit is not None:
            assert r["cls"] == want, (pat, s, r["cls"], want)


def test_fast_path_selection():
    assert S._strip_unit(r"\W+") == r"\W"
    assert S._strip_unit(r"[^\w']") == r"[^\w']"
    assert S._strip_unit(" ") == " "
    assert S._strip_unit(r"\s*,\s*") == r"\s*,\s*"
    assert S._strip_unit(r"\s*\|\s*") == r"\s*\|\s*"
    assert S._strip_unit("::") is None
    assert S._strip_unit(r"\s*[^\d]+\s*") is None
