"""Removal of repeated passages against a dictionary of all windows."""

import hashlib
import re

import numpy as np
import pytest

from herdframe.llm import repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def direct(rows, window=50):
    order = lambda i: (i is None, i or 0)
    words = [(i, WORD.findall(t or "")) for i, t, _ in rows]
    least = {}
    for i, ws in words:
        for a in range(len(ws) - window + 1):
            key = tuple(ws[a : a + window])
            least[key] = min(least.get(key, order(i)), order(i))
    out = []
    for i, ws in words:
        gone = set()
        for a in range(len(ws) - window + 1):
            if least[tuple(ws[a : a + window])] < order(i):
                gone.update(range(a, a + window))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        edges = sorted(k for k in gone if k - 1 not in gone), sorted(k + 1 for k in gone if k + 1 not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest(), *edges))
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "begins", "ends"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows(prose):
    passage, other = prose(80, 1), prose(50, 2)
    out = [(i, f"{prose(30 + i, i + 10)} {passage}\n {prose(20, i + 50)}", "a") for i in range(3, 12)]
    out += [(20, other, "a"), (15, other.upper(), "a"), (16, f"x {other} y", "a"), (17, f"{other} {other}", "a"), (18, other[:-1], "a")]
    out += [(30, f"{prose(60, 3)} {prose(60, 3)}", "a"), (31, prose(49, 4), "a"), (32, prose(49, 4), "b")]  # repeats inside one text, and too short ones
    out += [(40 + i, out[0][1], "c") for i in range(60)] + [(2, out[0][1].replace(" ", "\t\t"), "c")]  # copies, one in other spacing
    out += [(33, out[2][1], "d"), (33, out[2][1], "d"), (33, f"{prose(90, 5)}", "d"), (33, f"{prose(90, 5)}", "d")]
    out += [(None, f"{prose(55, 6)}", "e"), (None, f"{prose(55, 6)} tail", "e"), (None, passage, "e"), (50, None, "f"), (51, "", "f"), (52, " \n\t", "f")]
    long = prose(20_000, 7)
    out += [(60, long, "g"), (61, " ".join(long.split()[5000:5200]), "g"), (1, " ".join(long.split()[9000:9050]), "g")]
    same = "word " * 120
    return out + [(70, same, "h"), (71, same + "end", "h"), (72, "word " * 49, "h")]


@pytest.mark.parametrize("window", [50, 7, 1])
def test_against_all_windows(docs_of, rows, window):
    assert got(repeats.remove_repeats(docs_of(rows), window)) == direct(rows, window)


def test_empty_table(docs_of):
    assert got(repeats.remove_repeats(docs_of([]))) == []


def test_rolling_hash_depends_on_the_run_only():
    draw = np.random.default_rng(1)
    words = draw.integers(0, 1 << 63, 500, dtype=np.uint64)
    words[300:340] = words[100:140]
    for size in (1, 5, 40):
        h = repeats.rolling(words, size)
        assert len(h) == 500 - size + 1 and (h[300 : 341 - size] == h[100 : 141 - size]).all()
        assert len(np.unique(h)) == len(h) - (41 - size)
    assert len(repeats.rolling(words[:3], 5)) == 0


def test_anchors_of_equal_windows_are_equal():
    draw = np.random.default_rng(2)
    values = draw.integers(0, 1000, 300)
    for width in (1, 2, 13, 35):
        assert repeats._sliding_least(values, width).tolist() == [values[i : i + width].min() for i in range(301 - width)]


def test_merged_intervals_are_maximal():
    begin, end = repeats.merged(np.array([0, 1, 50, 99, 151, 200]), 50)
    assert begin.tolist() == [0, 151] and end.tolist() == [149, 250]
    assert len(repeats.merged(np.zeros(0, np.int64), 50)[0]) == 0
