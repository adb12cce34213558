"""Ranked search against a plain version."""

import math
import random
import re

import pytest

from merchlake.llm import op12_search
from tests.llm import docs as made

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in TERM.findall(text or "")]


def brute(items, docs, k=10):
    counted = [(doc, terms(text)) for doc, text in docs]
    counted = [(doc, words) for doc, words in counted if words]
    n_docs, n_terms = len(counted), sum(len(w) for _, w in counted)
    found = []
    for item, text in items:
        scores = []
        for doc, words in counted:
            m = 25 + 75 * len(words) * n_docs // n_terms
            score = 0
            for t in terms(text):
                df = sum(t in w for _, w in counted)
                tf = words.count(t)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc))
        found += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


def asked(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")


def result(frame):
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    pool = made.words(rng, 60) + ["Éa", "ÉA", "日本", "x1", "X1"]
    docs = [(k, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))) for k in range(90)]
    # Many equal scores: copies under falling and rising ids.
    docs += [(200 - k, docs[k % 7][1]) for k in range(60)] + [(300, None), (301, ""), (302, "-- !")]
    items = [(k, " ".join(rng.choice(pool) for _ in range(rng.randint(1, 25)))) for k in range(30)]
    return [*items, (50, None), (51, ""), (52, "zzzz unknown")], docs


@pytest.mark.parametrize("sizes", [(1024, 256, 1024, 1 << 19), (5, 4, 3, 40)])
def test_ranks(spark, corpus, monkeypatch, sizes):
    """In one tile, and in many tiles, blocks and passes."""
    for name, value in zip(("DOCUMENTS", "ITEMS", "TERMS"), sizes, strict=False):
        monkeypatch.setattr(op12_search, name, value)
    items, docs = corpus
    found = op12_search.search(asked(spark, items), made.frame(spark, docs), entries=sizes[3])
    assert result(found) == brute(items, docs)


def test_tiles_stay_exact(monkeypatch):
    """A tile ends before its sums could pass the bound."""
    monkeypatch.setattr(op12_search, "EXACT", 10 * op12_search.MOST)
    import numpy as np

    item, term = np.repeat([0, 1], 6), np.tile(np.arange(6), 2)
    weight = np.array([4, 4, 4, 9, 1, 30, 1, 1, 1, 1, 1, 1])
    (block,) = op12_search.blocks(item, term, weight)
    assert sum(len(v) for v, _ in block.tiles) == 6
    assert all(len(v) == 1 or w.max(axis=1).sum() <= 10 for v, w in block.tiles)


def test_awkward_rows(spark):
    docs = made.awkward(spark)
    words = docs.filter("doc_id = 1").first().text.split()
    items = asked(spark, [(1, words[0]), (1, words[0]), (1, words[1]), (None, words[0])])
    found = op12_search.search(items, docs).collect()
    # Two items share the id 1; the null id is an item; four rows hold the text, the one without id last.
    by_item = [r for r in found if r.item_id is None]
    assert [r.doc_id for r in sorted(by_item, key=lambda r: r["rank"])][:4] == [1, 2, 2, None]
    assert len([r for r in found if r.item_id == 1 and r["rank"] == 1]) == 2
    assert op12_search.search(items.filter("false"), docs).count() == 0
    assert op12_search.search(items, docs.filter("false")).count() == 0
