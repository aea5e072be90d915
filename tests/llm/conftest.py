import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import pytest  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ra", "si", "to") for b in ("bar", "den", "fil", "gos", "han", "jek", "lum", "nor", "pit", "ruv")]


@pytest.fixture(scope="module")
def docs_of(spark):
    def make(rows, extra=True):
        """Documents from (doc_id, text, source); extra columns have names that clash with inner ones."""
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        df = spark.createDataFrame(full, DOCS)
        if not extra:
            return df
        names = ("cls", "row", "key", "x", "held_out", "component", "size", "shard", "copies", "source_key", "n", "__key", "label", "bucket")
        return df.selectExpr("*", *[f"'{c}' as `{c}`" for c in names])

    return make


@pytest.fixture(scope="module")
def prose():
    import random

    def make(n, seed):
        rnd = random.Random(seed)
        return " ".join(rnd.choice(WORDS) for _ in range(n))

    return make
