"""Scores against counts made directly, and what a language model has to fulfil."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from herdframe.llm import suffix_tree


def tokens(text):
    import re

    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")] + [None]


def base_scores(rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t, _ in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return {
        (i, t): (held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t, _ in rows
    }


@pytest.fixture(scope="module")
def rows(prose):
    made = [(i, prose(60, i) + f" Rare{i} ÄRGER", "a") for i in range(60)]
    made += [(100 + i, "alpha beta gamma delta " * 20, "a") for i in range(20)]
    return [*made, (300, "", "b"), (301, None, "b"), (None, "alpha beta", "b"), (5, made[5][1], "a"), (302, prose(40_000, 3), "b")]


def test_base_and_counts(docs_of, rows):
    want = base_scores(rows)
    got = suffix_tree.score_texts(docs_of(rows)).collect()
    text = dict((i, t) for i, t, _ in rows)
    assert len(got) == len(rows)
    for r in got:
        held, n, known, total, base = want[(r.doc_id, text[r.doc_id])]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-6)


def test_contexts_help_on_held_out_texts(docs_of, rows):
    got = {r.doc_id: r for r in suffix_tree.score_texts(docs_of(rows)).collect()}
    repeated = [got[100 + i] for i in range(20) if got[100 + i].held_out]
    assert repeated and all(r.score > 0.5 * r.base_score for r in repeated)


def test_probabilities_after_every_state_sum_to_one(docs_of, rows):
    df = docs_of(rows).selectExpr("doc_id", "coalesce(text, '') as text").withColumn("held_out", suffix_tree.held_out())
    tree, words = suffix_tree.learn(df)
    known = np.arange(len(tree.hashes))
    others = words.count() - len(known)
    rest = sum(r.n + 1 for r in words.collect()) - (tree.counts + 1).sum()  # words without a place in the tree
    assert others >= 0 and any(level.kept.any() for level in tree.levels)
    for depth, level in enumerate(tree.levels):
        for state in np.flatnonzero(level.kept)[:20]:
            p, tail, at = (tree.counts + 1) / tree.spread, (rest + 1) / tree.spread, state
            chain = [at]
            for k in range(depth, 0, -1):
                at = tree.levels[k].parent[at]
                chain.append(at)
            for k, s in enumerate(reversed(chain)):
                entry = suffix_tree._find(tree.levels[k].keys, (s << 32) | known)
                p = suffix_tree._step(tree.levels[k], np.full(len(known), s), entry, p)
                tail *= tree.levels[k].mass[s] if tree.levels[k].kept[s] else 1
            assert p.sum() + tail == pytest.approx(1)


def test_empty_tables(docs_of):
    assert suffix_tree.score_texts(docs_of([])).count() == 0
    only = suffix_tree.score_texts(docs_of([(next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2), "a b", "s")])).collect()
    assert [(r.train_tokens, r.n_known, r.base_score, r.score) for r in only] == [(0, 0, 0.0, 0.0)]


def direct_scores(rows):
    """Scores from a tree that is held in dictionaries, whatever the size."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    train = [tokens(t) for i, t, _ in rows if not held(i)]
    count = Counter(w for t in train for w in t)
    spread = sum(count.values()) + len(count) + 1
    kept = {}

    def prob(context, w):
        if not context:
            return (count[w] + 1) / spread
        below = prob(context[1:], w)
        if context not in kept:
            return below
        follow, total, mass = kept[context]
        return (follow[w] if follow[w] >= 2 else 0) / total + mass * below

    candidates, length = {(w,) for w in count if count[w] >= 2 and w is not None}, 1
    while candidates:
        follow = {}
        for t in train:
            for i in range(length, len(t)):
                if (c := tuple(t[i - length : i])) in candidates:
                    follow.setdefault(c, Counter())[t[i]] += 1
        new = {}
        for c, f in follow.items():
            n, entries = sum(f.values()), {w: k for w, k in f.items() if k >= 2}
            rest = n - sum(entries.values())
            q = {w: prob(c[1:], w) for w in entries}
            saved = sum(k * math.log2(k / n / q[w]) for w, k in entries.items()) + (rest * math.log2(rest / n / max(1 - sum(q.values()), 1e-12)) if rest else 0)
            if n >= 2 and entries and saved > 8 + 0.5 * math.log2(n + 1) * len(entries):
                spare = len(f) + max(rest, 1)
                new[c] = (f, n + spare, (rest + spare) / (n + spare))
        kept |= new
        candidates = {(*c, w) for c, f in follow.items() for w, k in f.items() if k >= 2 and w is not None and (*c, w)[1:] in new}
        length += 1
    best = lambda t, i: next((tuple(t[i - k : i]) for k in range(i, 0, -1) if tuple(t[i - k : i]) in kept), ())
    scores = {(i, t): sum(math.log10(prob(best(x, k), x[k])) for k in range(len(x))) for i, t, _ in rows for x in [tokens(t)]}
    return scores, max(map(len, kept))


def test_scores_against_direct_ones_with_rare_and_long_contexts(docs_of, prose):
    """Contexts that stand three times in a long corpus, and one of four words, count as well."""
    made = [(i, prose(500, i), "a") for i in range(30)]
    made += [(1000 + i, f"unusual pairing number{i % 6} follows{i % 6} " * 3, "a") for i in range(40)]
    rng, line = np.random.default_rng(5), [0, 1, 0, 1]
    for coin in rng.random(16_000):  # the next word leans on the last four
        line.append(int(coin < 1 / (1 + math.exp(-sum(w * (2 * x - 1) for w, x in zip((1.5, -0.8, 0.8, -0.6), line[-4:], strict=True))))))
    made += [(2000 + i, " ".join("ab"[x] for x in line[i * 800 : (i + 1) * 800]), "a") for i in range(20)]
    want, longest = direct_scores(made)
    got = suffix_tree.score_texts(docs_of(made)).collect()
    text = {i: t for i, t, _ in made}
    assert longest >= 4 and len(got) == len(made)
    for r in got:
        assert r.score == pytest.approx(want[(r.doc_id, text[r.doc_id])], rel=1e-9)


@pytest.mark.parametrize("tail_rows", [0, 400_000])
def test_scores_with_contexts_of_all_lengths_one_by_one_and_together(docs_of, prose, monkeypatch, tail_rows):
    """Short contexts are tested length by length in tables; the last ones, long in texts that repeat themselves, in one task."""
    monkeypatch.setattr(suffix_tree, "_TAIL_ROWS", tail_rows)
    monkeypatch.setattr(suffix_tree, "_TAIL_LENGTHS", 2)
    monkeypatch.setattr(suffix_tree, "_BLOCK_TOKENS", 5000)
    made = [(i, prose(700, i % 25), "a") for i in range(30)]
    rng, line = np.random.default_rng(5), [0, 1, 0, 1]
    for coin in rng.random(16_000):
        line.append(int(coin < 1 / (1 + math.exp(-sum(w * (2 * x - 1) for w, x in zip((1.5, -0.8, 0.8, -0.6), line[-4:], strict=True))))))
    made += [(100 + i, " ".join("ab"[x] for x in line[i * 800 : (i + 1) * 800]), "a") for i in range(20)]
    want, longest = direct_scores(made)
    got = suffix_tree.score_texts(docs_of(made)).collect()
    text = {i: t for i, t, _ in made}
    assert longest >= 4 and len(got) == len(made)
    for r in got:
        assert r.score == pytest.approx(want[(r.doc_id, text[r.doc_id])], rel=1e-9)


def test_runs_that_occur_once_are_never_stored(docs_of, monkeypatch):
    """Beside the words, tables hold rows for runs of two occurrences only; what is single is known from the context's count."""
    rng = np.random.default_rng(1)
    made = [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 4000) % 5000), "a") for i in range(10)]
    train = [tokens(t) for i, t, _ in made if zlib.crc32(str(i).encode()) % 7 != 2]
    pairs = Counter(p for t in train for p in zip(t, t[1:], strict=False))
    most = sum(n >= 2 for n in pairs.values()) + len({w for t in train for w in t})
    rows, store = [], suffix_tree.cut_lineage

    def counted(df, **options):
        stored = store(df, **options)
        if {"key", "n"} <= set(stored.columns):
            lists = dict(stored.dtypes)["key"].startswith("array")
            rows.append(sum(len(r.key) for r in stored.select("key").collect()) if lists else stored.count())
        return stored

    monkeypatch.setattr(suffix_tree, "cut_lineage", counted)
    monkeypatch.setattr(suffix_tree, "_TAIL_ROWS", 0, raising=False)
    assert suffix_tree.score_texts(docs_of(made)).count() == 10
    assert len(rows) > 1 and most < len(pairs) / 2 and max(rows) <= most


def test_bins_batches_and_look_ups_stay_small_whatever_the_corpus(docs_of, spark, monkeypatch):
    """A task's share: there are as many bins as the tokens need, batches are bounded by bytes, and a part of the blocks looks its runs up at a time."""
    rng = np.random.default_rng(2)
    made = [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 60) % 500), "a") for i in range(400)]
    bins, asked, limits, blocks, store = [], [], set(), [], suffix_tree.cut_lineage

    def watched(df, **options):
        limits.add((spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"), spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")))
        stored = store(df, **options)
        if {"bin", "key"} <= set(stored.columns):
            bins.append(stored.select("bin").distinct().count())
        if {"block", "codes"} <= set(stored.columns):
            blocks.append(stored.count())
        if {"block", "bin", "v"} <= set(stored.columns):
            asked.append(stored.select("block").distinct().count())
        return stored

    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    for name, value in (("_BIN_TOKENS", 600), ("_BLOCK_TOKENS", 2000), ("cut_lineage", watched)):
        monkeypatch.setattr(suffix_tree, name, value, raising=False)
    want, _ = direct_scores(made)
    got = suffix_tree.score_texts(docs_of(made)).collect()
    text = {i: t for i, t, _ in made}
    assert len(got) == 400 and all(r.score == pytest.approx(want[(r.doc_id, text[r.doc_id])], rel=1e-9) for r in got)
    assert max(bins) >= 30 and blocks[0] >= 8 and 0 < max(asked) < blocks[0]
    assert limits == {("4m", "16")} and spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
