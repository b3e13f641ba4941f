"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import pytest
from pyspark.sql import functions as F

from grantlens.llm import ann, exact_dedup, langid, line_dedup, lm_scoring, mixing, packing, sharding, simhash_dedup, warc
from grantlens.llm.common import fresh_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, h string, key string, node int, __gone int, mix_level int, `Shard` int, word string, level int, id int"
LONG = " ".join(f"w{i % 997}" for i in range(20_000))


def rows():
    base = [
        (1, "the cat sat on the mat with the hat", "en", "a"), (2, "the cat sat on the mat with the hat", "en", "a"), (2, "the cat sat on the mat with the hat", "en", "a"),
        (3, "", "en", "a"), (4, None, "de", "b"), (None, "der Hund und die Katze sind im Haus", "de", None), (None, None, None, None), (5, "   ", "fr", "b"), (6, LONG, "en", "b"),
        (7, "der Hund und die Katze sind im Haus", None, "b"), (8, "!!! ??? ...", "es", "c"), (9, "der Hund und die Katze\nthe cat sat\nthe cat sat\n\n", "de", "c"),
    ]
    return [(*r, 0, "x", "k", 1, 2, 3, 4, "w", 5, 6) for r in base]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


FILTERS = {"mix": lambda d: mixing.mix_filter(d, 1.0), "exact": exact_dedup.exact_dedup, "near": simhash_dedup.near_dedup, "lang": langid.keep_identified}


@pytest.mark.parametrize("name", FILTERS)
def test_filters(docs, none, name):
    out = FILTERS[name](docs)
    assert out.columns == docs.columns
    got = out.collect()
    every = {tuple(r) for r in docs.collect()}
    assert got and all(tuple(r) in every for r in got)
    texts = [(r.doc_id, r.text) for r in got]
    if name == "exact":
        assert sorted(x for x, t in texts if t and t.startswith("the cat sat on")) == [1]
        assert sum(t is None for _, t in texts) == 2 and sum(t == "" for _, t in texts) == 1
        assert [x for x, t in texts if t and t.startswith("der Hund") and "\n" not in t] == [7]  # NULL ids come last
    if name == "near":
        assert [x for x, t in texts if t and t.startswith("the cat sat on")] == [1]
        assert {3, 4, 5, 6, 8, None} <= {x for x, _ in texts}
    if name == "lang":
        assert {3, 4, 5}.isdisjoint({x for x, _ in texts}) and all(t and t.strip() for _, t in texts)
    empty = FILTERS[name](none)
    assert empty.columns == docs.columns and empty.count() == 0


def test_mixing_keeps_clashing_names(docs):
    clash = docs.withColumns({"__mix_level": F.lit(77), "__mix_source": F.lit("s"), "__h": F.lit(1), "__level": F.lit(5)})
    got = mixing.mix_filter(clash, 1.0).collect()
    assert got and {(r["__mix_level"], r["__mix_source"], r["__h"], r["__level"]) for r in got} == {(77, "s", 1, 5)}
    assert mixing.mix_levels(docs.limit(0), [0.5]).count() == 0


def test_labels(docs, none):
    got = langid.label_documents(docs).collect()
    assert len(got) == 12 and all(r.detected == "und" and not r.accepted for r in got if r.doc_id in (3, 4, 5))
    assert len({(r.detected, r.posterior) for r in got if r.doc_id == 2}) == 1
    assert langid.label_documents(none).count() == 0


def test_sharding(docs, none):
    out = sharding.assign_shards(docs, 7).collect()
    assert len(out) == 12 and len({r.shard for r in out if r.doc_id is None}) == 1
    assert sharding.reshard(docs, 7, 9).filter("moved and shard < 7").count() == 0
    assert sharding.assign_shards(none, 7).count() == 0


def test_packing(docs, none):
    got = packing.pack_documents(docs, 64).collect()
    assert sum(r.n_tokens for r in got) == sum(len((r.text or "").split()) for r in docs.collect())
    assert sum(r.start == 0 for r in got) == 12
    assert packing.pack_documents(none).count() == 0


def test_lines(docs, none):
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs.filter("doc_id is not null and doc_id <> 2")).collect()}
    assert got[4].text is None and got[3].text == "" and got[9].lines_removed == 1
    assert got[9].text == "der Hund und die Katze\nthe cat sat\n\n" and got[6].text == LONG
    every = line_dedup.dedup_lines(docs.withColumn("lines_removed", F.lit("x")))  # NULL ids last, repeated rows alike, a clashing name
    assert every.columns.count("lines_removed") == 1
    assert sorted((str(r.doc_id), str(r.text), r.lines_removed) for r in every.collect() if r.doc_id in (1, 2, None)) == [
        ("1", "the cat sat on the mat with the hat", 0), ("2", "", 1), ("2", "", 1), ("None", "", 1), ("None", "None", 0)
    ]
    assert line_dedup.dedup_lines(none).count() == 0
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(docs.withColumn("doc_id", F.lit("u-1")))


def test_scoring(docs, none):
    items = docs.select(F.col("doc_id").alias("item_id"), "text", "word", "h").withColumn("log_prob", F.lit("x")).filter("doc_id is null or doc_id <> 6")
    got = lm_scoring.score_texts(docs, items).collect()
    assert len(got) == 11 and {r.item_id for r in got if r.n_tokens == 0} == {None, 3, 4, 5}
    assert all(r.log_prob is None for r in got if r.n_tokens == 0)
    assert lm_scoring.score_texts(docs, items.limit(0)).count() == 0
    assert all(r.log_prob in (0.0, None) for r in lm_scoring.score_texts(none, items).collect())


def test_neighbours(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (3, [0.0, 1.0]), (4, None), (None, [1.0, 1.0]), (5, []), (6, [0.0, 0.0]), (7, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("id", F.lit("x")).withColumn("v", F.lit(1))
    got = {}
    for r in ann.nearest(df, k=2).collect():
        got.setdefault(r.vec_id, {})[r.rank] = (r.neighbour, r.similarity)
    assert got == {1: {1: (2, 1.0), 2: (3, 0.0)}, 2: {1: (1, 1.0), 2: (3, 0.0)}, 3: {1: (1, 0.0), 2: (2, 0.0)}, 6: {1: (1, 0.0), 2: (2, 0.0)}}
    assert ann.nearest(df.limit(0), k=2).count() == 0
    odd = spark.createDataFrame([(10 + i, [float("nan") if i % 2 else float("inf"), 1.0]) for i in range(40)], "vec_id bigint, embedding array<float>")
    assert {(r.vec_id, r.rank): r.neighbour for r in ann.nearest(df.select("vec_id", "embedding").unionByName(odd), k=2).collect()} == {(q, r): n[0] for q, x in got.items() for r, n in x.items()}
    with pytest.raises(ValueError):
        ann.nearest(spark.createDataFrame([("u-1", [1.0])], "vec_id string, embedding array<float>"))
    with pytest.raises(ValueError):
        ann.nearest(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id bigint, embedding array<float>"))


def test_pages(spark):
    rows = [(1, "http://a.de/x", '<html lang="de"><p>der Hund und die Katze'), (1, "http://a.de/x", '<html lang="de"><p>der Hund und die Katze'), (2, None, None), (None, "nonsense url", ""), (3, "http://b.fr/ü x", "x" * 50_000), (4, "", "é"), (5, "http://a/b\nc", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("key", F.lit(1)).withColumn("file", F.lit("f"))
    to = fresh_path(spark, "t")
    index = warc.write_warc(pages, to, roll_bytes=900, range_bytes=20_000)
    assert index.count() == 7
    back = warc.read_warc(spark, to).collect()
    assert sorted(((r.page_id, r.url, r.html) for r in back), key=str) == sorted(((r.page_id, r.url, r.html) for r in pages.collect()), key=str)
    same = pages.limit(1).crossJoin(spark.range(400).select())  # one address and id: cut by size all the same
    assert warc.write_warc(same.withColumn("html", F.concat("html", F.rand(1).cast("string"))), fresh_path(spark, "t"), range_bytes=20_000).select("file").distinct().count() > 5
    assert warc.write_warc(pages.limit(0), fresh_path(spark, "t")).count() == 0
    labelled = spark.createDataFrame([(r[0], r[1], r[2], r[3]) for r in [(1, "der Hund und die Katze", "de", 1), (2, "the cat and the dog", "en", 1)]], "doc_id bigint, text string, lang string, source int")
    got = langid.label_pages(pages, labelled).collect()
    assert len(got) == 7 and [r.detected for r in got if r.page_id == 1] == ["de", "de"] and [r.accepted for r in got if r.page_id == 2] == [False]
