"""The Jaccard join against all pairs compared directly."""

import random

from herdframe.llm import similar
from herdframe.llm.similar import expected_recall, first_depth


def shingle_set(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """{position: (class id, links)} over all pairs."""
    sets = [shingle_set(t) for _, t, _ in rows]
    near = lambda a, b: a == b or (a and b and len(a & b) >= 0.8 * len(a | b))
    links = [[j for j in range(len(rows)) if j != i and near(sets[i], sets[j])] for i in range(len(rows))]
    low = list(range(len(rows)))
    for _ in rows:
        low = [min([low[i], *[low[j] for j in links[i]]]) for i in range(len(rows))]
    members = {}
    for i, g in enumerate(low):
        members.setdefault(g, []).append(rows[i][0])
    first = lambda ids: None if None in ids else min(ids)
    return sorted((rows[i][0] is not None, rows[i][0], first(members[low[i]]), len(links[i])) for i in range(len(rows)))


def sample(prose):
    rnd = random.Random(5)
    rows = [(i, prose(rnd.randint(30, 120), i), f"s{i % 3}") for i in range(40)]
    for i in range(40, 70):  # edited copies at all distances, some in chains
        words = rows[rnd.randrange(i)][1].split()
        for _ in range(rnd.choice([1, 1, 2, 4])):
            words[rnd.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), "s0"))
    rows += [(100 + i, rows[3][1], "s1") for i in range(5)]
    rows += [(200, "", None), (201, None, "s1"), (202, "  \n ", "s1"), (203, "one two", None), (204, "One  two", "s2"), (None, rows[4][1], "s1"), (4, rows[4][1], "s1")]
    return [*rows, (300, prose(30_000, 9), "s1"), (301, prose(30_000, 9) + " more", "s1")]


def got(df):
    return sorted((r.doc_id is not None, r.doc_id, r.class_id, r.n_links) for r in df.collect())


def test_against_all_pairs(docs_of, prose):
    rows = sample(prose)
    assert got(similar.jaccard_join(docs_of(rows))) == brute(rows)


def test_blocks_of_a_large_group(docs_of, prose):
    base = prose(200, 1).split()
    rows = [(i, " ".join([*base[:i], f"w{i}", *base[i + 1 :]]), "s") for i in range(60)]
    assert got(similar.jaccard_join(docs_of(rows), block_rows=16)) == brute(rows)


def test_keeps_one_row_of_each_group(docs_of, prose):
    rows = sample(prose)
    df = docs_of(rows)
    kept = similar.keep_one(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len({c for *_, c, _ in brute(rows) if c is not None}) + 1  # and one group with a null id
    assert len(ids) == len(set(ids))


def test_empty_table(docs_of):
    assert similar.jaccard_join(docs_of([])).count() == 0
    assert similar.keep_one(docs_of([])).count() == 0


def test_prefixes_reach_the_recall():
    depth = first_depth(0.8, 0.9995)
    assert expected_recall(0.8, depth) >= 0.9995
    assert first_depth(0.6, 0.9995) < depth
