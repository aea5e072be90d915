"""License scans and decontamination against direct searches."""

import random
import re
import string

import numpy as np
import pyarrow as pa

from herdframe.llm import decontaminate, licenses
from herdframe.llm.licenses import TEMPLATES


def words(text):
    return [w for w in (x.strip(string.punctuation + "«»“”„‘’–—…¿¡") for x in re.split(r"[ \t\n\r\f\v]+", (text or "").lower())) if w]


def shingle_list(w):
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else ([tuple(w)] if w else [])


def licensed(text, templates, containment=0.8):
    """Licenses of which some window of the text, up to twice as long, has enough shingles."""
    have = shingle_list(words(text))
    out = set()
    for name, t in templates.items():
        want = set(shingle_list(words(t)))
        for i in range(len(have)):
            if len(want & set(have[i : i + len(want) + 2])) >= containment * len(want) - 1e-9:
                out.add(name)
                break
    return out


def test_licenses_against_direct_search(docs_of, prose):
    rnd = random.Random(1)
    rows = []
    for i in range(60):
        name = rnd.choice(list(TEMPLATES))
        notice = TEMPLATES[name].split()
        if i % 3 == 1 and len(notice) > 12:
            notice[rnd.choice([0, len(notice) - 1])] = "other"
        if i % 3 == 2:
            notice = notice[: len(notice) // 2]
        rows.append((i, prose(rnd.randint(0, 80), i) + "\n# " + " ".join(notice).upper() + "\n" + prose(30, 500 + i), "s"))
    rows += [(100, None, None), (101, "", "s"), (102, TEMPLATES["MIT"], "s"), (None, TEMPLATES["ISC"] + " x", "s"), (3, rows[3][1], "s"), (103, prose(40_000, 2) + " " + TEMPLATES["CC0-1.0"], "s")]
    got = licenses.scan(docs_of(rows)).collect()
    found = {(r.doc_id, r.license) for r in got}
    assert found == {(i, n) for i, t, _ in rows for n in licensed(t, TEMPLATES)}
    text = dict((i, t) for i, t, _ in rows)
    for r in got:
        here = set(shingle_list(words(text[r.doc_id])[r.word_from : r.word_to]))
        want = set(shingle_list(words(TEMPLATES[r.license])))
        assert r.containment >= 0.8 and len(here & want) >= r.containment * len(want) - 1e-9
    assert sum(r.doc_id == 3 for r in got) == 2 * len(licensed(rows[3][1], TEMPLATES))


def test_complete_texts_with_a_tenth_rewritten(docs_of, prose):
    """Texts far longer than a notice, of which a tenth in a row is other words, deep inside long texts; with a fifth rewritten they are no longer found."""
    rows, want = [], set()
    for k, name in enumerate(n for n in TEMPLATES if n.endswith("-full")):
        notice = TEMPLATES[name].split()
        for j, share in enumerate((0, 0.1, 0.25)):
            cut = int(len(notice) * share)
            at = len(notice) // 3
            edited = notice[:at] + prose(cut, 900 + k).split() + notice[at + cut :] if cut else notice
            rows.append((10 * k + j, f"{prose(700 + 77 * j, k)} {' '.join(edited)} {prose(300, 50 + k)}", "s"))
            want |= {(10 * k + j, name)} if share < 0.2 else set()
    got = {(r.doc_id, r.license) for r in licenses.scan(docs_of(rows)).collect() if r.license.endswith("-full")}
    assert got == want and got == {(i, n) for i, t, _ in rows for n in licensed(t, {k: v for k, v in TEMPLATES.items() if k.endswith("-full")})}


def test_bands_follow_the_least_similarity():
    """However little of a template has to be there, the bands are as many as its collision probability needs."""
    text = " ".join(f"w{i}" for i in range(130))
    scanner = licenses.Scanner({"long": text}, 0.01, 0.9999)
    (width, (_, bands)), = scanner.classes.items()
    similarity = 2 / (2 * width + 126 - 2)
    assert bands > 1500 and 1 - (1 - similarity) ** bands >= 0.9999
    factors = {int(licenses._multiplier(k)) for k in range(4000, 4300)}
    assert len(factors) == 300 and all(f % 2 for f in factors)


def test_license_places_and_empty_inputs(docs_of):
    twice = f"a b c {TEMPLATES['MIT']} {' x y z' * 20} {TEMPLATES['MIT']}"
    got = licenses.scan(docs_of([(1, twice, "s")])).collect()
    assert sorted((r.word_from, r.word_to) for r in got) == [(3, 8), (68, 73)]
    assert licenses.scan(docs_of([])).count() == 0
    assert licenses.scan(docs_of([(1, twice, "s")]), templates={}).count() == 0


def smith_waterman(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1, j + 1] = max(0, table[i, j] + (2 if a[i] == b[j] else -1), table[i, j + 1] - 1, table[i + 1, j] - 1)
    return table.max()


def test_alignment_against_the_plain_table():
    rnd = np.random.default_rng(1)
    a, b = rnd.integers(0, 6, (40, 12)).astype(np.uint64), rnd.integers(0, 6, (40, 20)).astype(np.uint64)
    la, lb = rnd.integers(1, 13, 40), rnd.integers(1, 21, 40)
    score, end_a, end_b = decontaminate.align(a, b, la, lb)
    for k in range(40):
        assert score[k] == smith_waterman(a[k, : la[k]], b[k, : lb[k]])
        if score[k]:
            assert smith_waterman(a[k, : end_a[k] + 1], b[k, : end_b[k] + 1]) == score[k]


def leak_rows(prose):
    rnd = random.Random(3)
    items = [(i, " ".join(f"q{rnd.randrange(400)}" for _ in range(rnd.randint(12, 45)))) for i in range(25)]
    rows = []
    for i in range(90):
        passage = items[rnd.randrange(25)][1].split()
        for _ in range(rnd.choice([0, 2, 4, 8])):
            at = rnd.randrange(len(passage))
            passage[at : at + 1] = rnd.choice([["new"], [], [passage[at], "added"]])
        rows.append((i, prose(rnd.randint(0, 60), i) + " " + " ".join(passage if i % 3 else passage[: len(passage) // 3]) + ". " + prose(20, 300 + i), "s"))
    rows += [(200 + i, f"{items[0][1]} {prose(5, i)}", "hot") for i in range(80)]  # an item that is copied often
    rows += [(400, None, None), (401, "", "s"), (None, items[1][1], "s"), (1, rows[1][1], "s"), (402, prose(40_000, 1) + " " + items[2][1], "s")]
    return rows, [*items, (50, None), (51, ""), (52, items[3][1]), (None, items[4][1])]


def test_leaks_against_whole_alignments(spark, docs_of, prose):
    rows, items = leak_rows(prose)
    benchmark = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, doc_id string")
    got = decontaminate.find_leaks(docs_of(rows), benchmark).collect()
    found = {(r.doc_id, r.item_id): r.score for r in got}
    for i, t, _ in rows:
        if t and len(t) > 20_000:
            assert (402, 2) in found
            continue
        for k, q in items:
            w = words(q)
            score = smith_waterman(w, words(t)) / (2 * len(w)) if w else 0
            runs = lambda x: {tuple(x[n : n + 3]) for n in range(len(x) - 2)}
            if score >= 0.5 and (runs(w) & runs(words(t)) or len(w) < 3):
                assert found[(i, k)] >= 0.5 and abs(found[(i, k)] - score) < 1e-9, (i, k, score)
            else:
                assert (i, k) not in found
    text = dict((i, t) for i, t, _ in rows)
    for r in got:
        q = words(dict(items)[r.item_id])
        assert abs(smith_waterman(q, words(text[r.doc_id])[r.word_from : r.word_to]) / (2 * len(q)) - r.score) < 1e-9
    df = docs_of(rows)
    left = decontaminate.drop_leaks(df, benchmark)
    assert left.columns == df.columns
    bad = {r.doc_id for r in got}
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, _, _ in rows if i not in bad)


def test_blocks_of_items_and_empty_inputs(spark, docs_of, prose, monkeypatch):
    rows, items = leak_rows(prose)
    schema = "item_id long, text string"
    benchmark = spark.createDataFrame(items, schema)
    want = sorted((str(r.doc_id), str(r.item_id)) for r in decontaminate.find_leaks(docs_of(rows), benchmark).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1500)
    assert sorted((str(r.doc_id), str(r.item_id)) for r in decontaminate.find_leaks(docs_of(rows), benchmark).collect()) == want
    none = spark.createDataFrame([], schema)
    assert decontaminate.find_leaks(docs_of(rows), none).count() == 0
    assert decontaminate.drop_leaks(docs_of(rows), none).count() == len(rows)
    assert decontaminate.find_leaks(docs_of([]), benchmark).count() == 0
    assert decontaminate.matches(decontaminate.Items.of([1], pa.array(["a b"]), 3), pa.array(["x y", "a b"]), 3, 0.5, np.ones(1 << 20, bool)) == [(1, 0, 1.0, 0, 2)]


def test_an_edited_copy_that_stands_in_many_texts(spark, docs_of, prose):
    """The runs that survive the edits are the most frequent of the corpus; most runs of the item stand in no text."""
    item = [f"w{k}" for k in range(40)]
    copy = " ".join(f"other{k}" if k % 5 == 4 else w for k, w in enumerate(item))
    share = smith_waterman(item, words(copy)) / 80
    rows = [(i, f"{prose(20, i)} {copy} {prose(10, 900 + i)}", "s") for i in range(400)]
    rows += [(1000 + i, f"{prose(30, 2000 + i)} {' '.join(item[:3])}", "s") for i in range(50)]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r.score for r in decontaminate.find_leaks(docs_of(rows), benchmark).collect()}
    assert set(got) == set(range(400)) and share > 0.65
    assert all(abs(s - share) < 1e-9 for s in got.values())
    assert {r.doc_id for r in decontaminate.drop_leaks(docs_of(rows), benchmark).collect()} == {1000 + i for i in range(50)}
