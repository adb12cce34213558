"""Nulls, empty and long texts, repeated rows, clashing names, empty tables."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from merchlake.llm import op01_quality, op02_urls, op03_minhash, op04_lines, op05_language, op06_substrings
from merchlake.llm import op07_mixing, op08_fertility, op09_covertree, op10_pieces
from tests.llm import docs as made


@pytest.fixture(scope="module")
def awkward(spark):
    return made.awkward(spark)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 0), (None, 1, None), (3, None, None), (4, 0, 1), (6, 1, 0), (8, 0, 0), (8, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def operators(labels):
    return {
        "quality": lambda d: op01_quality.classify(d, labels),
        "near": op03_minhash.near_duplicates,
        "lines": op04_lines.deduplicate_lines,
        "language": op05_language.score_texts,
        "repeats": op06_substrings.remove_repeats,
        "fertility": op08_fertility.judge,
        "pieces": lambda d: op10_pieces.encode(d, checked_column="ok"),
    }


NAMES = sorted(operators(None))


@pytest.mark.parametrize("name", NAMES)
def test_one_result_per_row(awkward, labels, name):
    found = operators(labels)[name](awkward).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r.doc_id) for r in awkward.collect())


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(awkward, labels, name):
    assert operators(labels)[name](awkward.filter("false")).count() == 0


def test_near_duplicates_of_awkward_rows(awkward):
    found = op03_minhash.near_duplicates(awkward).collect()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert (by_id[2].component_id, by_id[2].kept) == (1, False)
    assert all((by_id[k].n_shingles, by_id[k].component_id, by_id[k].kept) == (0, k, True) for k in (3, 4, 5))
    assert by_id[7].n_shingles == by_id[8].n_shingles == 1
    assert all(r.component_id is None and r.kept for r in found if r.doc_id is None)


def test_lines_of_awkward_rows(awkward):
    found = {r.doc_id: r for r in op04_lines.deduplicate_lines(awkward, carry=["lang", "n", "kept"]).collect()}
    assert (found[1].n_removed, found[2].text, found[2].n_removed) == (0, "", 1)
    assert (found[3].text, found[3].n_lines) == (None, 0)
    assert found[5].text == " \n\t \n" and found[9].n_removed == 1


def test_repeats_of_awkward_rows(awkward):
    rows = op06_substrings.remove_repeats(awkward).collect()
    found = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (found[1].n_removed, found[2].n_removed, found[2].kept) == (0, 80, "")
    assert (found[3].n_words, found[3].kept) == (0, "")
    assert sorted(r.n_words for r in rows if r.doc_id is None) == [0, 80]
    assert all(r.n_removed == 0 for r in rows if r.doc_id is None)


def test_quality_without_labels(awkward, labels):
    assert {r.score for r in op01_quality.classify(awkward, labels.filter("false")).collect()} == {0.5}


def test_pieces_of_awkward_rows(awkward):
    rows = op10_pieces.decode(op10_pieces.encode(awkward, checked_column="ok")).collect()
    assert all(r.ok for r in rows)
    assert all(r.piece_ids == [] and r.decoded == "" for r in rows if not r.text)
    assert {r.lang for r in rows} == {"en", None}


def test_mixing(spark, awkward):
    rows = op07_mixing.mix(awkward, {"s": 1.0, "": 1.0}).collect()
    assert {r.mix_rate for r in rows if r.source == "s"} <= {12 * 0.5 / 10}
    assert op07_mixing.mix(awkward.filter("false")).count() == 0
    assert op07_mixing.mix(awkward, {}).count() == 0
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 200, "a").otherwise("b").alias("source"))
    mixed = op07_mixing.mix(many, {"a": 0.8, "b": 0.2})
    sizes = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    # Standard deviations are 57 and 28.
    assert abs(sizes["a"] - 3200) < 230 and abs(sizes["b"] - 800) < 120
    per_doc = mixed.filter("source = 'b'").groupBy("doc_id").count().groupBy("count").count().collect()
    once = {r[0]: r[1] for r in per_doc}
    assert once[1] > once[2] > once.get(4, 0)
    order = [r.mix_order for r in mixed.collect()]
    assert order == sorted(order) and len(set(order)) == len(order)


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://Example.ORG/es/x?q#f", "https://a.example.org/en/12", "https://a.example.org/en/2",
        "http://x.com/fr/", "http://x.com/de/1", "http://x.com/de", "http://com/fr/1", "http://xcom/fr/1", "a://b://c.org/d", "http://org",
    ]
    pages = spark.createDataFrame([(k, u, "id") for k, u in enumerate(urls)] + [(None, urls[4], None)], "page_id long, url string, host string")
    found = op02_urls.judge(pages).collect()
    by_id = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}
    assert by_id[0] == by_id[1] == by_id[2] == ("", "", None, "allow")
    assert by_id[4] == by_id[None] == ("example.org", "/es/x", "example.org/es/", "block")
    assert by_id[5][2:] == ("example.org/en/1", "block") and by_id[6][2:] == ("org/", "allow")
    assert by_id[7][2:] == ("com/fr/", "allow") and by_id[8][2:] == ("com/de/", "block") and by_id[9][2] is None
    assert by_id[10][2] == "com/fr/" and by_id[11][2] is None and by_id[12][:2] == ("b:", "//c.org/d") and by_id[13][2] is None
    assert op02_urls.judge(pages.filter("false")).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (2, [2.0, 0.1]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [1.0, None]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = op09_covertree.near_vectors(frame).collect()
    assert len(found) == len(rows)
    links = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}
    assert links[1] == (2, 1, True) and links[2] == (2, 1, False)
    assert all(links[k] == (0, k, True) for k in (3, 4, 5, 6, 7, 8, 9, 10)) and links[None] == (0, None, True)
    assert op09_covertree.near_vectors(frame.filter("false")).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage(spark, awkward, folder, labels, name, stage):
    labels.write.parquet(f"{folder}/labels.parquet")
    docs = awkward
    out = stage(spark, docs, folder)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == docs.columns
    out.write.parquet(f"{folder}/out")
    stage(spark, docs.filter("false"), folder).write.parquet(f"{folder}/none")
    if name == "near_copies":
        kept = [r.doc_id for r in out.collect() if r.doc_id is not None]
        assert 1 in kept and 2 not in kept and len(kept) == len(set(kept))
    if name == "lines":
        assert 2 not in {r.doc_id for r in out.collect()} and 4 in {r.doc_id for r in out.collect()}


def test_repeated_rows_do_not_multiply(spark, monkeypatch):
    """Many rows of one id and of its near copy; every body is fetched once."""
    from merchlake.llm import linking

    rng = random.Random(5)
    base = made.words(rng, 120)
    other = [*base[:60], "changed", *base[61:]]
    rows = [(1, " ".join(base))] * 40 + [(2, " ".join(other))] * 40
    seen, inner = [], linking._checked

    def counted(*args):
        links = inner(*args)
        seen.append(links.count())
        return links

    monkeypatch.setattr(linking, "_checked", counted)
    found = op03_minhash.near_duplicates(made.frame(spark, rows)).collect()
    assert len(found) == 80 and {r.component_id for r in found} == {1}
    assert max(seen) == 1


@pytest.mark.parametrize("turned", [False, True])
def test_lines_of_an_id_with_two_texts(spark, turned):
    """Whichever text comes first, a line is compared by its own text."""
    line = "a line of some length that is repeated with one more word"
    rows = [(1, "another beginning\n" + "y" * 30), (1, "another beginning\n" + line), (2, line + "x")]
    found = op04_lines.deduplicate_lines(made.frame(spark, rows[::-1] if turned else rows)).collect()
    assert [r.text for r in found if r.doc_id == 2] == [""]
    assert sorted(r.n_removed for r in found) == [0, 0, 1]


def test_mixing_with_clashing_names(spark):
    names = ["__sums", "__parts", "__count", "__source", "row", "key", "n", "parts", "sums", "mix_rate"]
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), *[F.lit("x").alias(c) for c in names])
    mixed = op07_mixing.mix(docs)
    assert mixed.columns == ["doc_id", "source", *names[:-1], "mix_rate", "mix_copy", "mix_order"]
    assert {r["__sums"] for r in mixed.collect()} == {"x"}
