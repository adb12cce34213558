"""Cases in which an operator once did less than the whole job."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from merchlake.llm import gru, op04_lines, op05_language, op06_substrings
from merchlake.llm.common import beside, within
from tests.llm import docs as made


def joins_of(df):
    """The joins of the optimised plan, the last one first."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if "Join " in line]


def test_rows_leave_before_the_shuffle(spark):
    """Spark must not move the join by the key below the bitmap, or every text is shuffled for it."""
    rows = made.frame(spark, [(k % 50, f"text {k}") for k in range(100)] + [(None, "x")]).select("doc_id", "text")
    wanted = spark.range(0, 200, 7).select(F.col("id").alias("doc_id"), F.lit(1).alias("one"))
    found = within(rows, "doc_id", wanted)
    last, first = joins_of(found)
    assert "shiftright" in first and "shiftright" not in last
    assert sorted(r.doc_id for r in found.collect()) == sorted(2 * [k for k in range(50) if k % 7 == 0])
    some, others = (x.collect() for x in beside(rows, "doc_id", wanted))
    assert all(r.doc_id is None or r.doc_id % 7 for r in others)
    assert {r.doc_id for r in some if r.one} == set(range(0, 50, 7))
    assert len(some) + len(others) == 101


def test_untouched_texts_do_not_move(spark):
    rows = made.frame(spark, [(k, f"text {k}") for k in range(9)]).select("doc_id", "text", F.lit(0).alias("carried"))
    removed = spark.createDataFrame([(3, [])], "doc_id long, removed array<struct<pos int, h1 long>>")
    rebuilt = op04_lines._rebuilt(rows, removed)
    assert not any("Anti" in x or "Semi" in x for x in joins_of(rebuilt))
    assert rebuilt.count() == 9


def test_steps_of_few_lanes_go_together(monkeypatch):
    """A text far longer than the others is not scored in windows of one lane and a few steps."""
    rng = np.random.default_rng(4)
    model, calls, outputs = gru.Model.initial(np.arange(40, 0, -1), 8, 4, 16), [], gru.Model.outputs
    texts = [np.append(rng.integers(2, 40, n), gru.END) for n in (3000, 5, 0, 40)]
    apart = [gru.score(model, [x], lanes=1)[0] for x in texts]
    monkeypatch.setattr(gru.Model, "outputs", lambda *a, **b: calls.append(1) or outputs(*a, **b))
    np.testing.assert_allclose(gru.score(model, texts), apart, rtol=1e-5)
    assert len(calls) < 10


def without_repeats(rows, window=13):
    """doc_id: n_words, n_removed, kept; rows by rising id."""
    first, wanted = {}, {}
    for doc, text in rows:
        w = text.split()
        gone = set()
        for i in range(len(w) - window + 1):
            if first.setdefault(tuple(w[i : i + window]), doc) < doc:
                gone |= set(range(i, i + window))
        wanted[doc] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return wanted


def test_repeats_of_copied_shards(spark, monkeypatch):
    """A hot and a rare passage of one owner, apart there and joined in later documents."""
    rng = random.Random(11)
    hot, rare = made.words(rng, 30), made.words(rng, 30)
    rows = [(0, [*hot, *made.words(rng, 100), *rare])]
    rows += [(k, [*made.words(rng, 5), *hot, *(rare if k % 5 == 0 else []), *made.words(rng, 5)]) for k in range(1, 81)]
    # Windows that the anchors' owner does not have, one of them in many documents.
    joined = [*rare[5:20], *hot[:15]]
    rows += [(k, [*joined, *(rare[20:] if k % 4 == 0 else []), *made.words(rng, 3)]) for k in range(81, 141)]
    rows = [(k, " ".join(w)) for k, w in rows]
    monkeypatch.setattr(op06_substrings, "STREAMED", 2)
    found = op06_substrings.remove_repeats(made.frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in found} == without_repeats(rows)


def test_repeats_come_out_as_they_are_matched():
    """One owner's shard: results leave before the whole group has been read."""
    text = b" ".join(b"w%d" % k for k in range(20))
    rows = [(0, 0, False, 0, 0, text, [], [])] + [(0, 0, True, k, 0, text, [0], [1]) for k in range(1, 40)]
    read = 0

    def batches():
        nonlocal read
        for k in range(0, len(rows), 4):
            read += 1
            columns = zip(*rows[k : k + 4], strict=True)
            types = op06_substrings._FRAGMENT_TYPES
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types, strict=True)], schema=types)

    found, most = [], 0
    for batch in op06_substrings._streamed(batches(), 13):
        most = max(most, 4 * read - len(found) - batch.num_rows)
        found += batch.to_pylist()
    assert most <= 4
    assert [(r["doc_id"], r["found"]) for r in found] == [(k, [{"start": 0, "end": 20}]) for k in range(1, 40)]


def test_language_model_trains_on_all_training_documents(spark, monkeypatch):
    rows = [(k, " ".join(made.words(random.Random(k), 5))) for k in range(300)]
    trained, inner = [], op05_language._trained

    def recorded(docs, learned):
        trained.extend(r.doc_id for r in docs.select("doc_id").collect())
        return inner(docs, learned)

    monkeypatch.setattr(op05_language, "_trained", recorded)
    op05_language.score_texts(made.frame(spark, rows)).collect()
    assert sorted(trained) == [k for k in range(300) if zlib.crc32(str(k).encode()) % 7 != 2]
