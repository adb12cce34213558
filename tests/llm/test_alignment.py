"""Alignment of two tokenizers against whole texts encoded by their libraries."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tokenizers

from merchlake.llm import csr, op11_alignment
from merchlake.llm.common import Scratch
from tests.llm import docs as made

FOLDER = op11_alignment.TOKENIZERS


@pytest.fixture(scope="module")
def vocabularies():
    a = tokenizers.Tokenizer.from_file(f"{FOLDER}/{op11_alignment.BYTE_LEVEL}")
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=f"{FOLDER}/{op11_alignment.PIECES}")


def aligned(vocabularies, text):
    """Ids and ends of both tokenisations, or None if a vocabulary does not give the text back."""
    a, b = vocabularies
    if not text:
        return None
    raw = (" " + text).encode()
    # Visible bytes stand for themselves, the others for the code points from 256 on.
    kept = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174]
    letter = {chr(x): x for x in kept}
    letter.update((chr(256 + k), x) for k, x in enumerate(x for x in range(256) if x not in kept))
    sides = []
    for ids, spelled in (
        (a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(letter[c] for c in a.id_to_token(i))),
        (b.encode(text), lambda i: bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()),
    ):
        spelling = [spelled(i) for i in ids]
        if b"".join(spelling) != raw:
            return None
        sides.append((ids, np.cumsum([len(x) for x in spelling]).tolist()))
    return sides


def brute(vocabularies, rows):
    found, counts = [], Counter()
    for doc, text in rows:
        sides = aligned(vocabularies, text)
        if sides is None:
            found.append((doc, 0, 0, 0, 0, 0, "", []))
            continue
        (a, ends_a), (b, ends_b) = sides
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, links, shared, i0, j0 = [], [], 0, 0, 0
        for cut in cuts:
            ours = range(i0, ends_a.index(cut, i0) + 1)
            theirs = range(j0, ends_b.index(cut, j0) + 1)
            i0, j0 = ours.stop, theirs.stop
            groups.append(",".join(str(a[k]) for k in ours) + "|" + ",".join(str(b[k]) for k in theirs))
            shared += len(ours) * len(theirs)
            for i in ours:
                for j in theirs:
                    if (ends_a[i - 1] if i else 0) < ends_b[j] and (ends_b[j - 1] if j else 0) < ends_a[i]:
                        links.append((a[i], b[j]))
        counts.update(set(links))
        found.append((doc, len(a), len(b), len(cuts), len(links), shared, ";".join(groups), links))
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(most.get(a, 0), n)
    wanted = []
    for doc, n_a, n_b, n_groups, n_links, shared, text, links in found:
        digest = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
        best = sum(counts[x] == most[x[0]] for x in links)
        wanted.append((doc, n_a, n_b, n_groups, n_links, best, sum(counts[x] for x in links), digest, shared))
    return sorted(wanted, key=str)


def odd_texts():
    rng = random.Random(4)
    parts = ["the", " a", "  ", "\n", "\t", " \n ", "é", "日本", "😀", "<|endoftext|>", "<s>", "<0x41>", "don't", "12345", "...", "\xa0", " ", "\x1c", " ", "_", "ﬁ", "x" * 40]
    rows = [(k, "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(1, 30)))) for k in range(120)]
    return [*rows, (200, " "), (201, "   "), (202, "\n"), (203, "a ▁ b"), (204, "a "), (205, " a"), (206, "ends  \n\n"), (207, "\x00\x01 z")]


def result(frame):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"]
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=str)


@pytest.mark.parametrize("known", [1 << 20, 40, 0])
def test_documents(spark, vocabularies, folder, known, monkeypatch):
    """With all pair counts sent out, with some, and with none, when every pair is joined."""
    awkward = [(r.doc_id, r.text) for r in made.awkward(spark).collect()]
    rows = odd_texts() + awkward + [(300 + k, " ".join(made.words(random.Random(k), 40))) for k in range(20)]
    made.frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    inner = op11_alignment.weigh
    monkeypatch.setattr(op11_alignment, "weigh", lambda found, scratch: inner(found, scratch, known))
    assert result(op11_alignment.op11_alignment(spark, folder)) == brute(vocabularies, rows)


def test_supplied_documents(spark, vocabularies):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    short = {d: t for d, t in rows if len(t or "") < 1500}
    found = op11_alignment.align(spark.read.parquet(f"{folder}/documents.parquet"))
    some = {r.doc_id: r for r in found.collect()}
    wanted = brute(vocabularies, list(short.items()))
    assert len(some) == len(rows) and len(wanted) > 50
    for doc, n_a, n_b, n_groups, n_links, _, _, digest, shared in wanted:
        r = some[doc]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_group_links) == (n_a, n_b, n_groups, n_links, shared)
        assert hashlib.sha256(r.groups.encode()).hexdigest() == digest
        assert sum(r.link_n) == n_links


def test_empty_table(spark):
    empty = op11_alignment.align(made.awkward(spark).filter("false"))
    assert op11_alignment.weigh(empty, Scratch(spark, "none")).count() == 0


def test_products(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(csr, "STEP", 7)
    for _ in range(30):
        n, k, m = rng.integers(1, 12, 3)
        left, right = rng.random((n, k)) < 0.3, rng.random((k, m)) < 0.3

        def sparse(x):
            return csr.Csr(np.append(0, np.cumsum(x.sum(axis=1))), np.nonzero(x)[1], x.shape[1])

        wanted = left.astype(int) @ right.astype(int)
        found = np.zeros_like(wanted)
        for rows, columns, values in csr.products(sparse(left), sparse(right)):
            found[rows, columns] += values
        assert (found == wanted).all() and (csr.row_sums(sparse(left), sparse(right)) == wanted.sum(axis=1)).all()
        assert (csr.transposed(sparse(left)).indices == np.nonzero(left.T)[1]).all()


def test_long_part_without_spaces(spark):
    """One unit of a hundred thousand characters, in groups of its own."""
    rows = [(1, "ab1" * 40_000), (2, "ab1" * 40_000)]
    found = op11_alignment.align(made.frame(spark, rows)).select("doc_id", "n_a", "n_links").collect()
    assert len(found) == 2 and found[0].n_a == found[1].n_a > 40_000
