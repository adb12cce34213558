"""Operators that SQL cannot express, against plain versions on small tables."""

import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from merchlake.llm import gru, linking, op01_quality, op02_urls, op03_minhash, op04_lines, op05_language, op06_substrings
from merchlake.llm import op08_fertility, op09_covertree, op10_pieces, sketch
from merchlake.llm.automaton import SuffixAutomaton, spans
from merchlake.llm.common import Scratch
from merchlake.llm.transducer import Transducer
from tests.llm import docs as made

SF = "/root/testdata/sf0.001"


class Groups:
    def __init__(self, items):
        self.parent = {x: x for x in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def test_near_duplicates(spark):
    rows = made.near_copies()
    sets = {}
    for doc, text in rows:
        w = text.lower().split()
        sets[doc] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    groups = Groups(sets)
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                groups.join(a, b)
    found = op03_minhash.near_duplicates(made.frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {
        d: (len(s), groups.find(d), groups.find(d) == d) for d, s in sets.items()
    }


def test_lines(spark):
    rng = random.Random(5)
    pool = [" ".join(made.words(rng, rng.randint(6, 30))) for _ in range(25)] + ["short", "ab"]
    rows = []
    for doc in range(30):
        lines = []
        for _ in range(rng.randint(1, 6)):
            line = rng.choice(pool)
            if rng.random() < 0.4:
                at = rng.randrange(len(line))
                line = line[:at] + rng.choice("xyz") + line[at + 1 :]
            lines.append(line)
        rows.append((doc, "\n".join([*lines, ""])))
    places = [(d, i, x) for d, text in rows for i, x in enumerate(text.split("\n")) if x.strip()]
    sets = [{x[i : i + 8] for i in range(max(1, len(x) - 7))} for _, _, x in places]
    groups = Groups(range(len(places)))
    for a in range(len(places)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                groups.join(a, b)
    gone = {(d, i) for k, (d, i, _) in enumerate(places) if groups.find(k) != k}
    wanted = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in rows}
    found = op04_lines.deduplicate_lines(made.frame(spark, rows)).collect()
    assert {r.doc_id: r.text for r in found} == wanted
    assert sum(r.n_removed for r in found) == len(gone)


def test_suffix_automaton():
    rng = random.Random(1)
    for _ in range(60):
        texts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 12))] for _ in range(3)]
        automaton = SuffixAutomaton()
        for text in texts:
            automaton.add(text)
        query = [rng.choice([b"a", b"b", b"c"]) for _ in range(15)]
        runs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        wanted = [max(k for k in range(e + 1) if k == 0 or tuple(query[e - k : e]) in runs) for e in range(1, 16)]
        assert automaton.matches(query) == wanted
    assert spans([0, 1, 2, 3, 4, 1, 2, 3], 3) == [(1, 8)]
    assert spans([1, 2, 3, 0, 1, 2, 3], 3) == [(0, 3), (4, 7)]


def test_repeats_of_words(spark):
    """Chains of partial matches: the anchor's owner does not hold every window."""
    rng = random.Random(2)
    passages = [made.words(rng, rng.randint(12, 40)) for _ in range(8)]
    rows = []
    for doc in range(40):
        w = made.words(rng, rng.randint(0, 20))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            start = rng.randrange(max(1, len(p) - 14))
            w += p[start : start + rng.randint(10, 30)] + made.words(rng, rng.randint(0, 4))
        rows.append((doc, " ".join(w)))
    first, wanted = {}, {}
    for doc, text in rows:
        w = text.split()
        gone = set()
        for i in range(len(w) - 12):
            if first.setdefault(tuple(w[i : i + 13]), doc) < doc:
                gone |= set(range(i, i + 13))
        wanted[doc] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    found = op06_substrings.remove_repeats(made.frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in found} == wanted


def test_vectors(spark):
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((12, 16))
    vectors = [c + rng.standard_normal(16) * s for c in centers for s in (0, 0, 0.05, 0.1, 0.2, 0.25, 0.3) for _ in range(8)]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    e = np.array(vectors)
    near = (e @ e.T) / np.outer(np.linalg.norm(e, axis=1), np.linalg.norm(e, axis=1)) >= 0.95
    np.fill_diagonal(near, False)
    groups = Groups(range(len(rows)))
    for a, b in zip(*np.nonzero(near), strict=True):
        groups.join(int(a), int(b))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    block, op09_covertree.BLOCK = op09_covertree.BLOCK, 100
    try:
        found = op09_covertree.near_vectors(frame).collect()
    finally:
        op09_covertree.BLOCK = block
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == {
        i: (int(near[i].sum()), groups.find(i)) for i in range(len(rows))
    }


def test_cover_tree_prunes():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.standard_normal((200, 8)) * 0.01 + c for c in np.eye(8)[:5]])
    points /= np.linalg.norm(points, axis=1)[:, None]
    tree = op09_covertree.cover_tree(points)
    pairs = list(op09_covertree.node_pairs(tree, tree, 0.3))
    assert sum(len(a.members) * len(b.members) for a, b in pairs) < 0.5 * len(points) ** 2
    met = np.zeros((len(points), len(points)), bool)
    for a, b in pairs:
        met[np.ix_(a.members, b.members)] = True
    away = np.linalg.norm(points[:, None] - points[None], axis=2)
    assert met[away <= 0.3].all()


@pytest.fixture(scope="module")
def codec():
    return op10_pieces.Codec(Transducer.load(f"{op10_pieces.TOKENIZERS}/{op10_pieces.PIECES}"))


def test_pieces(spark, codec):
    pieces = sentencepiece.SentencePieceProcessor(model_file=f"{op10_pieces.TOKENIZERS}/{op10_pieces.PIECES}")
    rng = random.Random(3)
    pool = "  \t\n▁aabbteh inger日本語執😀é .,0123"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    texts += [" " * k for k in range(40)] + ["a" * 300, " a " * 40, "", "\n", "hello   world"]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    ids, counts = codec.encode([x.encode() for x in texts])
    ends = np.append(0, np.cumsum(counts))
    wanted = pieces.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == wanted
    assert codec.decode(ids, counts) == pieces.decode(wanted)


def test_shortest_path_of_unigrams():
    pieces = ["<unk>", "a", "b", "ab", "▁a", "▁", "ba", "▁ab"]
    scores = np.array([0.0, -3.0, -3.0, -4.0, -2.5, -2.0, -3.5, -9.0])
    t = Transducer._compiled(pieces, scores, [2] + [1] * 7, False, {})
    for text in ("▁ab", "▁aba", "▁abab", "▁bb▁a", "▁aczb"):
        best = {0: (0.0, [])}
        for end in range(1, len(text) + 1):
            options = [(best[s][0] - scores[i], [*best[s][1], i]) for i, p in enumerate(pieces[1:], 1) for s in [end - len(p)] if s >= 0 and text[s:end] == p]
            if text[end - 1] not in "ab▁":
                options.append((best[end - 1][0] + (-scores).max() + 10, [*best[end - 1][1], 0]))
            best[end] = min(options)
        ids, _ = t.shortest([text])
        assert ids.tolist() == best[len(text)][1]


def test_fertility(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r.doc_id: r for r in op08_fertility.judge(table).collect()}
    pieces = sentencepiece.SentencePieceProcessor(model_file=f"{op08_fertility.TOKENIZERS}/{op08_fertility.PIECES}")
    for row in table.collect():
        w = row.text.encode().split()
        runs = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {i + k for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in row.text.split("\n") if x.encode().split()]
        r = found[row.doc_id]
        chars = sum(len(x.decode()) for x in w)
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), chars, len(covered))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in row.text)
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.base_failed and r.kept)
        if w:
            ids = pieces.encode([x.decode() for x in w])
            assert r.chars_per_piece == pytest.approx(chars / sum(map(len, ids)))
            shares = np.array(list(Counter(i for x in ids for i in x).values())) / sum(map(len, ids))
            assert r.token_entropy == pytest.approx(-(shares * np.log2(shares)).sum())


def test_fertility_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = op08_fertility.op8_fertility(spark, sf).join(labels, "doc_id").filter("NOT base_failed")
    rows = judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in rows}
    assert kept[1] > 0.98 and kept[0] < kept[1]


def test_language_model(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text.encode().lower().split() + [None] for r in table.collect()}
    counts = Counter(w for d, x in texts.items() if zlib.crc32(str(d).encode()) % 7 != 2 for w in x)
    n, v = sum(counts.values()), len(counts)
    frequent, op05_language.FREQUENT = op05_language.FREQUENT, 3000
    try:
        found = op05_language.score_texts(table).collect()
    finally:
        op05_language.FREQUENT = frequent
    gain = held = 0
    for r in found:
        x = texts[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(x), sum(counts[w] > 0 for w in x), n)
        assert r.base_score == pytest.approx(sum(log10((counts[w] + 1) / (n + v + 1)) for w in x))
        held += r.held_out
        gain += r.held_out * (r.score - r.base_score)
    # Log10 probability gained per held-out document, from 170 training documents.
    assert gain > 50 * held > 0


def _plain_score(learned, counts, words):
    """Log10 probability of one text, token by token."""
    w, n, total = learned.model.weights, learned.model.hidden, 0.0
    h, before = np.zeros(n), gru.END
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for word in words:
        digest = np.array([xxhash.xxh3_64_intdigest(word or b" ")], np.uint64).view(np.int64)
        place = learned.frequent.find(digest)[0]
        token = learned.frequent.tokens[place] if place >= 0 else gru.RARE
        a, rec = w["gates"][before], h @ w["state"]
        r, z = sigmoid(a[:n] + rec[:n]), sigmoid(a[n : 2 * n] + rec[n : 2 * n])
        fresh = np.tanh(a[2 * n :] + r * rec[2 * n :])
        h, before = (1 - z) * fresh + z * h, token
        of = max(k for k, start in enumerate(learned.model.starts) if start <= token)
        first, last = learned.model.starts[of], learned.model.starts[of + 1]
        p = np.exp(h @ w["class"] + w["class_bias"])
        inside = np.exp(w["word"][first:last] @ h + w["word_bias"][first:last])
        total += log10(p[of] / p.sum()) + log10(inside[token - first] / inside.sum())
        if token == gru.RARE:
            rare = learned.rare
            share = counts[word] - rare.discount if counts[word] else rare.discount * rare.distinct + 0.5
            total += log10(share / (rare.n + 0.5))
    return total


def test_language_scores_by_a_plain_forward_pass(spark, monkeypatch):
    """Also with weights averaged in several levels, and few words known to every task."""
    learned, inner = [], op05_language._scored
    monkeypatch.setattr(op05_language, "_scored", lambda docs, known: learned.append(known) or inner(docs, known))
    monkeypatch.setattr(op05_language, "FREQUENT", 500)
    monkeypatch.setattr(op05_language, "VOCABULARY", 300)
    monkeypatch.setattr(op05_language, "SHARD", 10)
    monkeypatch.setattr(op05_language, "AVERAGED", 3)
    table = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text.encode().lower().split() + [None] for r in table.collect()}
    counts = Counter(w for d, x in texts.items() if zlib.crc32(str(d).encode()) % 7 != 2 for w in x)
    found = op05_language.score_texts(table).collect()
    for row in found[::10]:
        assert row.score == pytest.approx(_plain_score(learned[0], counts, texts[row.doc_id]), rel=1e-4)


def test_even_lanes():
    texts = [np.arange(2, 2 + n) for n in (4, 1, 9, 3)]
    packed = gru.Lanes.even(texts, 3)
    assert packed.token.shape == (6, 3) and list(packed.active) == [3, 3, 3, 3, 3, 2]
    stream = packed.token.T.ravel()[:17]
    assert list(stream) == list(np.concatenate(texts))
    assert list(np.flatnonzero(packed.before.T.ravel()[:17] < 0)) == [0, 4, 5, 14]
    assert list(packed.before[0]) == [-1, stream[5], stream[11]]


def _recall(shared, own, bins, bands, rows, short):
    """Share of pairs of sets with ``shared`` common elements and ``own`` of each that meet in a band."""
    rng, pairs = np.random.default_rng(3), 3000
    common = rng.integers(0, 1 << 63, (pairs, shared), np.uint64)
    left, right = (np.hstack([common, rng.integers(0, 1 << 63, (pairs, own), np.uint64)]) for _ in range(2))
    sizes = np.full(pairs, shared + own)
    a, b = (short(sketch.sketch(x.ravel(), sizes, bins))[:, : bands * rows].reshape(pairs, bands, rows) for x in (left, right))
    return (a == b).all(axis=2).any(axis=1).mean()


def test_recall_just_at_the_threshold():
    """The share of pairs that meet in a band, at a similarity of exactly 0.75 and 0.80."""
    assert _recall(180, 30, op03_minhash.BINS, op03_minhash.BANDS, op03_minhash.ROWS, sketch.short) >= 0.999
    bins = op04_lines.ROWS * op04_lines.BANDS
    assert _recall(160, 20, bins, op04_lines.BANDS, op04_lines.ROWS, lambda x: x) >= 0.997


@pytest.mark.parametrize("block", [3, 2048])
def test_components_over_several_blocks(spark, monkeypatch, block):
    """Near copies of one text, of which many are not similar to each other; whatever the blocks, the
    links are those of all pairs."""
    monkeypatch.setattr(linking, "BLOCK", block)
    rng = random.Random(9)
    base = made.words(rng, 200)
    rows = []
    for doc in range(40):
        words = list(base)
        for at in rng.sample(range(200), rng.randint(3, 9)):
            words[at] = f"w{doc}x{at}"
        rows.append((doc, " ".join(words)))
    sets = {d: {tuple(t.split()[i : i + 5]) for i in range(196)} for d, t in rows}
    groups = Groups(sets)
    for a in sets:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                groups.join(a, b)
    assert 2 < len({groups.find(d) for d in sets}) < 39
    found = op03_minhash.near_duplicates(made.frame(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in found} == {d: groups.find(d) for d in sets}


def test_recurrent_model_is_a_distribution_and_learns():
    counts = np.array([5, 7, 40, 30, 20, 10, 10, 5, 5, 5])
    model = gru.Model.initial(counts, 8, 3, 4)
    h = np.random.default_rng(0).standard_normal((1, 8)).astype(np.float32)
    log_p = [model.outputs(h, np.array([k]))[0] for k in range(len(counts))]
    assert np.exp(log_p).sum() == pytest.approx(1.0, abs=1e-5)
    # Scoring a text does not depend on lanes, windows or its neighbours.
    rng = np.random.default_rng(1)
    texts = [np.append(rng.integers(2, 10, n), gru.END) for n in (0, 3, 50, 17, 200)]
    alone = [gru.score(model, [t], 1, 7)[0] for t in texts]
    assert gru.score(model, texts, 3, 32) == pytest.approx(alone, rel=1e-4)
    # A cycle is learnt.
    cycle = [np.append(np.tile([2, 5, 7, 3], 30), gru.END) for _ in range(30)]
    before = gru.score(model, cycle).sum()
    trainer = gru.Trainer(model, 0.1)
    for _ in range(5):
        trainer.train(cycle)
    assert gru.score(model, cycle).sum() > 0.5 * before


def test_gradients():
    model = gru.Model.initial(np.array([3, 3, 9, 8, 7, 6, 5, 4]), 5, 3, 3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    texts = [np.array([2, 4, 3, 6, 2, 1]), np.array([5, 1])]
    found = {name: np.zeros_like(w) for name, w in model.weights.items()}
    trainer = gru.Trainer(model, 0.0)

    def climb(name, grad, rows):
        found[name][rows] += grad

    trainer._climb = climb
    trainer.train(texts, lanes=1, window=100)
    for name in ("gates", "state", "class", "word", "class_bias", "word_bias"):
        whole = found[name]
        at = np.unravel_index(np.abs(whole).argmax(), whole.shape)
        step = 1e-4
        model.weights[name][at] += step
        up = gru.score(model, texts, 1, 100).sum()
        model.weights[name][at] -= 2 * step
        down = gru.score(model, texts, 1, 100).sum()
        model.weights[name][at] += step
        assert whole[at] == pytest.approx((up - down) / (2 * step), rel=2e-2)


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = op01_quality.op1_quality(spark, sf)
    assert scored.count() == 1000
    held = scored.filter("held_out").join(labels.filter("quality IS NOT NULL"), "doc_id").collect()
    good = [r for r in held if r.quality == 1]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert np.mean([r.predicted for r in good]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in held)


def test_cascade_is_exact_on_its_universe(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("h"), "id")
    listed = keys.filter("id % 50 = 0").select("h")
    others = keys.filter("id % 50 <> 0").select("h")
    cascade = op02_urls.build_cascade(Scratch(spark, "test"), listed, others)
    rows = keys.collect()
    found = cascade.listed(np.array([r.h for r in rows], np.int64).view(np.uint64))
    assert found.tolist() == [r.id % 50 == 0 for r in rows]
    assert len(cascade.levels) > 1
    assert sum(level.size for level in cascade.levels) < 20 * listed.count()
