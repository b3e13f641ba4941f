"""Sources, sinks, streams, funder parsing, evaluation, errors, the fleet and text mending on small cases."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantlens import sinks, sources, streaming
from grantlens.functions import funders as J
from grantlens.functions import healing as H
from grantlens.functions import patterns as P
from grantlens.functions import similarity as S
from grantlens.functions import text as T
from grantlens.operators import entities as E
from grantlens.operators import errors as X
from grantlens.operators import fleet as K
from grantlens.operators import relational as R
from grantlens.operators import retrieval as Q


def funder(name, *ids):
    return {"funder_name": name, "awards": [{"award_ids": list(ids), "funding_scheme": [], "award_title": []}] if ids else []}


# ---- sources and sinks


@pytest.fixture
def folder(spark, tmp_path):
    (tmp_path / "docs/sub").mkdir(parents=True), (tmp_path / "docs/.hidden").mkdir()
    for name, text in (("b.md", "two"), ("sub/a.md", "one"), (".hidden/c.md", "no"), ("x.txt", "no")):
        (tmp_path / "docs" / name).write_text(text)
    rows = [("i1", " text \n"), (None, "second"), ("", None), ("i4", "   ")]
    spark.createDataFrame(rows, "DOI string, Content string").coalesce(1).write.parquet(f"{tmp_path}/rows.parquet")
    return str(tmp_path)


def test_listings_and_documents(spark, folder):
    assert [os.path.basename(r.path) for r in sources.list_files(spark, f"{folder}/docs", "*.md").collect()] == ["b.md", "a.md"]
    docs = {r.document_id: r.content for r in sources.markdown_documents(spark, f"{folder}/docs").collect()}
    assert docs == {"b.md": "two", "a.md": "one"}
    assert sources.markdown_documents(spark, f"{folder}/docs/b.md").count() == 1
    with pytest.raises(FileNotFoundError):
        sources.list_files(spark, f"{folder}/nothing")
    assert sources.list_files(spark, f"{folder}/nothing", missing_ok=True).count() == 0
    assert sources.input_format("x", ["a.parquet", "b.md"]) == "markdown" and sources.input_format("x.parquet", []) == "parquet" and sources.input_format("x", ["a.parquet"]) == "parquet"
    got = {r.document_id: r.content for r in sources.parquet_documents(spark, f"{folder}/rows.parquet").collect()}
    assert got.pop("i1") == "text" and list(got.values()) == ["second"] and next(iter(got)).endswith("-row-1")
    assert sources.resolve_column(["A", "Text"], None, ["text"]) == ("Text", True) and sources.resolve_column(["A"], "a", []) == ("A", False)
    with pytest.raises(ValueError):
        sources.resolve_column(["A"], None, ["text"])
    names = {r.name for r in sources.healing_rows(spark, f"{folder}/rows.parquet").collect()}
    assert names == {"row_0.md", "row_1.md", "row_2.md", "row_3.md"}
    assert sources.row_count(spark, f"{folder}/rows.parquet") == 4


def test_json_sources(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"results": {"f1": {"funding_statements": [{"statement": "a"}, "b", {"statement": ""}]}, "f2": {"funding_statements": []}}}))
    assert sorted(tuple(r) for r in sources.predicted_statements(spark, str(tmp_path / "p.json")).collect()) == [("f1", "a"), ("f1", "b")]
    for f, rows in (("x", [{"id": 1, "t": "a"}]), ("y", [{"id": 2, "u": 5}])):
        (tmp_path / f).mkdir()
        (tmp_path / f / "train.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n\n")
    got = sources.merged_split(spark, str(tmp_path), ["x", "y"], "train")
    assert got.count() == 2 and {"id", "t", "u"} == set(got.columns)
    chat = [(1, "d1", [("user", "q"), ("assistant", "[1]")]), (2, "d1", [("assistant", "[2]")]), (3, "d2", [("user", "q")]), (4, "d3", [("assistant", "{")]), (5, None, [])]
    good, bad = sources.rollouts(spark.createDataFrame(chat, "line int, doi string, messages array<struct<role: string, content: string>>"))
    assert [tuple(r) for r in good.collect()] == [("d1", "[2]")]
    assert sorted(tuple(r) for r in bad.collect()) == [(3, "d2", "No assistant message"), (4, "d3", "JSON parse error")]
    assert sources.existing_results(spark, str(tmp_path / "none"), "a string").count() == 0
    one = spark.createDataFrame([(None, "f")], "predicted_funders string, funders string")
    assert sources.predictions_of(one).first().predicted_funders == "f" and sources.predictions_of(one.drop("predicted_funders")).first().predicted_funders == "f"


def test_positions_and_shards(spark, tmp_path):
    rows = spark.range(1000).repartition(7).withColumn("k", (F.col("id") * 37) % 1000)
    assert all(r.position == r.k for r in sources.with_position(rows, ["k"]).collect())
    parts = [sorted(r.k for r in sources.contiguous_shard(rows, ["k"], i, 3, 100).collect()) for i in range(3)]
    assert parts == [list(range(34)), list(range(34, 68)), list(range(68, 100))]
    assert sources.with_position(rows.limit(0), ["k"]).count() == 0
    sinks.write_shards(rows, str(tmp_path / "s"), ["k"], 300)
    got = spark.read.parquet(str(tmp_path / "s"))
    assert {r["shard"]: r["n"] for r in got.groupBy("shard").agg(F.count("*").alias("n")).collect()} == {"shard-00000": 300, "shard-00001": 300, "shard-00002": 300, "shard-00003": 100}
    assert [r.shards for r in sinks.commit_groups(got, 3).orderBy("commit").collect()] == [["shard-00000", "shard-00001", "shard-00002"], ["shard-00003"]]
    split = {r["split"]: r["n"] for r in R.split_by_id(rows, "id", (("sft", 0.7), ("rl", 0.2)), "rest").groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert split == {"sft": 700, "rl": 200, "rest": 100}


def test_resume_and_manifest(spark, tmp_path):
    at = str(tmp_path / "out")
    rows = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert sources.processed_keys(spark, at, ["k"]).count() == 0
    assert sinks.resume_into(rows, at, ["k"]) == 2 and sinks.resume_into(rows, at, ["k"]) == 0
    assert sinks.resume_into(spark.createDataFrame([("a", 9), ("b", 3)], "k string, v int"), at, ["k"]) == 1
    assert {r.k for r in sources.processed_keys(spark, at, ["k"]).collect()} == {"a", "b", None}
    with pytest.raises(FileExistsError):
        sinks.resume_into(rows, at, ["k"], resume=False)
    m = spark.createDataFrame([("in/2024/a", "done", 5, 7200.0, 1), ("in/2024/b", "failed", None, None, 3)], "input_file string, status string, rows bigint, elapsed_s double, attempts int")
    sinks.write_manifest(m, str(tmp_path / "m"))
    assert sources.read_manifest(spark, str(tmp_path / "m")).count() == 2
    sinks.write_manifest(m.limit(0), str(tmp_path / "m0"))
    assert len(sources.read_manifest(spark, str(tmp_path / "m0")).columns) == 12
    assert sinks.write_run_summary(m, str(tmp_path / "run")) == {"files": 2, "by_status": {"done": 1, "failed": 1}, "rows": 5, "seconds": 7200.0, "cost": 10.0}
    sinks.write_routed(spark.createDataFrame([("a", "success"), ("b", "encoding"), ("c", None)], "t string, category string"), str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r/cleaned")).count() == 1 and spark.read.parquet(str(tmp_path / "r/failed")).count() == 2
    sinks.write_by_year(m.withColumn("year", F.lit(2024)), str(tmp_path / "y"))
    assert os.path.isdir(tmp_path / "y/year=2024")
    assert sinks.save_checkpoint(spark.createDataFrame([("x",), ("x",)], "checkpoint string"), str(tmp_path / "c")) == 1


def test_stream_equals_batch(spark, tmp_path):
    src, out, at = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "at")
    schema = "doc_id bigint, text string, seq int"
    write = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    write([(1, "a b", 1), (2, "", 1)]), write([(1, "a b c", 2), (3, "boom", 1)])

    def words(t):
        if t == "boom":
            raise ValueError("no")
        return str(len(t.split()))

    def step(rows):
        return rows.select("doc_id", "seq", streaming.guarded(words)(F.col("text")).alias("r")).select("doc_id", "seq", "r.value", "r.error")

    def run(done=None):
        q = streaming.process_stream(streaming.document_stream(spark, src, schema), step, out, at, "doc_id", "seq", done)
        q.awaitTermination(120)
        return {r.doc_id: (r.value, r.error) for r in spark.read.parquet(out).collect()}

    want = {1: ("3", None), 2: ("0", None), 3: (None, "ValueError: no")}
    assert run() == want and run() == want  # nothing is read twice
    write([(2, "later", 2), (4, "x", 1)])
    assert run(spark.createDataFrame([(4,)], "doc_id bigint")) == want | {2: ("1", None)}
    streaming.upsert(step(spark.createDataFrame([(2, "old", 1)], schema)), out, "doc_id", "seq")
    assert spark.read.parquet(out).filter("doc_id = 2").first().seq == 2
    summary = R.result_summary(spark.read.parquet(out).select(F.col("value").cast("int").alias("n_statements")))
    assert tuple(summary.first()) == (3, 2, 4)


# ---- funders


def test_strict_and_lenient_json(spark):
    one = json.dumps([funder("NSF", "AB-1")])
    cases = {"list": one, "empty": "[]", "null": '[{"funder_name": null}]', "bad": "nope", "object": json.dumps(funder("NSF", "AB-1")), "fenced": f"```json\n{one}\n```", "wrapped": json.dumps({"funders": [funder("NSF", "AB-1")]}), "number": '[{"funder_name": "x", "awards": [{"award_ids": [123]}]}]'}
    rows = spark.createDataFrame(list(cases.items()), "name string, raw string")
    got = {r.name: r for r in rows.select("name", J.strict_funders(rows.raw).alias("s"), J.lenient_funders(rows.raw).alias("l")).collect()}
    strict = {k: None if r.s.funders is None else len(r.s.funders) for k, r in got.items()}
    assert strict == {"list": 1, "empty": 0, "null": 1, "bad": None, "object": None, "fenced": 1, "wrapped": None, "number": None}
    assert {k: len(r.l) for k, r in got.items()} == {"list": 1, "empty": 0, "null": 1, "bad": 0, "object": 1, "fenced": 1, "wrapped": 1, "number": 1}
    assert all((r.s.error is None) == (strict[k] is not None) and (r.s.error or "ParseError").startswith("ParseError") for k, r in got.items())
    assert got["list"].l[0].awards[0].award_ids == ["AB-1"] and got["null"].s.funders[0].funder_name is None
    assert J.parse_lenient('[{"funder_name": "a", "award_ids": "7"}, 5, null]') == [funder("a", "7")] and J.as_list(["", None, "x"]) == ["x"]


def test_rewards():
    g = [funder("National Science Foundation", "AB-123456"), funder("ERC", "X1")]
    assert E.reward(g, g)["reward"] > 0.95 and E.reward([], [])["reward"] == 1.0 and E.reward([], g)["reward"] < 0.3 and E.reward(g, [])["reward"] == 0.0
    swapped = [funder("National Science Foundation", "X1"), funder("ERC", "AB-123456")]
    assert E.reward(g, swapped)["association_gap"] == 1.0
    near = E.shaped_reward([funder("NSF", "AB-123456")], [funder("NSF", "AB-12345")])
    assert near["reward"] == pytest.approx(0.75) and E.reward([funder("NSF", "AB-123456")], [funder("NSF", "AB-12345")])["award_id_f0_5"] == 0.0
    assert E.set_f1(g, g) == (1.0, "correct") and E.set_f1(g, [])[0] == 0.0


def test_matching_and_merging():
    assert E.match_ids(["a-1", "A1", "b"], ["a 1", "c"]) == [(0, 0, 1.0)]
    assert E.match_ids(["ab-1"], ["AB1"], exact=True) == [] and E.match_ids(["ABCDEF1"], ["ABCDEF"], soft=True) == [(0, 0, 0.5)]
    merged = E.merge_funders([funder("National Science Foundation (NSF)", "1"), funder(None, "9"), funder("NSF", "2"), funder("Other", "3")])
    assert [(f["funder_name"], [a["award_ids"][0] for a in f["awards"]]) for f in merged] == [("National Science Foundation (NSF)", ["1", "2"]), ("Other", ["3"]), (None, ["9"])]
    counts = E.evaluate_funders([funder("A council", "1", "2")], [funder("A council", "2"), funder("B trust", "1")])
    assert counts[:2] == [(1.0, 2.0, 1.0), (2.0, 2.0, 1.0)]
    assert S.balanced("NSF", "National Science Foundation (NSF)") == 0.9 and S.balanced("", "x") == 0.0 and S.acronyms("a (AB) (no) (ABCDEFGHIJKL)") == ["AB"]
    assert S.balanced("Science Foundation", "Science Foundation Ireland") >= 0.85 and S.fuzzy("A", "a") == 100.0 and S.best_score("x", []) == 0.0
    assert S.greedy_match(["aa", "ab"], ["aa", "b"], 50) == [("aa", "aa", 100.0), ("ab", "b", pytest.approx(100.0))]


def test_statement_metrics(spark):
    rows = spark.createDataFrame([("x", ["the grant was given", "zzzz qqqq"], ["the grant was given now"]), ("y", [], ["extra"]), ("y", None, None)], "b string, gold array<string>, predicted array<string>")
    got = {r.b: r for r in E.statement_metrics(E.statement_scores(rows), by="b").collect()}
    assert (got["x"].gold_matched, got["x"].predicted_matched, got["x"].recall, got["x"].precision) == (1, 1, 0.5, 1.0) and got["overall"].predicted_n == 2 and got["y"].f1 == 0.0
    gold = spark.createDataFrame([(" D1 ", 1, "a"), ("d1", 2, "b"), ("d3", 3, "c")], "doi string, n int, v string")
    said = spark.createDataFrame([("d1",), ("d2",)], "doi string")
    assert [E.join_gold(said, gold, "doi", ["n"], last=k, fold=True).orderBy("doi").first().v for k in (False, True)] == ["a", "b"]
    assert {r.side: r.n for r in E.coverage(said, gold.filter("n > 1"), "doi").collect()} == {"both": 1, "gold_only": 1, "predicted_only": 1}


def test_errors_exact_and_fuzzy(spark):
    gold = [funder("Alpha Fund", "1", "2"), funder(None, "9"), funder("Beta")]
    said = [funder("alpha fund", "2", "3"), funder("Gamma", "7")]
    rows = spark.createDataFrame([("d", gold, said), ("same", gold, gold), ("none", [], [])], f"doi string, funders {J.FUNDERS}, predicted_funders {J.FUNDERS}")
    exact, fuzzy = X.compare_exact(rows), X.compare_fuzzy(rows)
    want = {("missing_funder", "beta", ""), ("extra_funder", "", "gamma"), ("missing_award_id", "1", ""), ("extra_award_id", "", "3"), ("null_funder_count_mismatch", "1 null funders", "0 null funders"), ("funder_count_mismatch", "3", "2")}
    for errors in (exact, fuzzy):
        assert {(r.error_type, r.gold_value, r.pred_value) for r in errors.collect()} == want and {r.doi for r in errors.collect()} == {"d"}
    close = spark.createDataFrame([("d", [funder("National Science Foundation", "1")], [funder("National Science Foundatio", "1")])], rows.schema)
    assert X.compare_fuzzy(close).count() == 0 and X.compare_exact(close).count() == 2
    assert [tuple(r)[:2] for r in X.document_summary(rows, exact).collect()] == [("d", 6), ("none", 0), ("same", 0)] and tuple(X.perfect_count(rows, exact).first()) == (3, 2)


# ---- the fleet


def test_fleet_runs_to_the_end(spark, tmp_path):
    rows = [(f"in/2024/{i}.parquet", 100 * i, 1.0 * i, "pending", None, 0, None, None, None, None) for i in range(1, 8)]
    m = spark.createDataFrame(rows, "input_file string, size_bytes bigint, est_seconds double, status string, job_id string, attempts int, rows bigint, elapsed_s double, output_path string, error string")
    jobs, n = {}, [0]

    def submit(files):
        n[0] += 1
        jobs[f"j{n[0]}"] = files
        return f"j{n[0]}"

    def poll(job):
        return "COMPLETED", [(f, 5, 1.5) for f in jobs[job] if "/3." not in f]  # one file never ends

    def save(df):
        at = str(tmp_path / f"m{len(os.listdir(tmp_path))}")
        df.write.parquet(at)
        return spark.read.parquet(at)

    out = {r.input_file: r for r in K.run_fleet(m, submit, poll, save, most_in_flight=2, most_attempts=2).collect()}
    assert {f for f, r in out.items() if r.status == "failed"} == {"in/2024/3.parquet"} and sum(r.status == "done" for r in out.values()) == 6
    assert out["in/2024/3.parquet"].attempts == 2 and out["in/2024/1.parquet"].output_path == "predictions/2024/1.parquet"
    assert [r.input_file for r in K.assign(m, "j", 11.0, 5).filter("job_id = 'j'").orderBy("input_file").collect()] == ["in/2024/7.parquet"]


# ---- text


def test_extraction_rules(spark, tmp_path):
    texts = {1: "Intro.\n\nThis work was supported by a research grant award (grant number RG-55).\n\nNothing.", 2: "", 3: None, 4: "Мы благодарим.\n\nThe end.", 5: "x\n\n" * 3000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = Q.extract_statements(docs, rescue_too=True).collect()
    assert {r.doc_id for r in got} == {1} and {r.query for r in got} == {"grant_acknowledgment"} and len(got) == 1
    assert Q.extract_statements(docs, post_filter=True).count() == 1 and Q.rescue(docs).first().para_idx == 1
    assert Q.rescue(docs, Q.extract_statements(docs).select("doc_id", "statement")).count() == 0
    assert Q.score_floor(True) == 11.0 and Q.score_floor(False) == 3.0 and Q.score_floor(True, 5.0) == 5.0
    tokens = spark.createDataFrame([(1, 0, [[1.0, 0.0], [0.0, -1.0]]), (1, 1, [])], "doc_id int, para_idx int, vectors array<array<float>>")
    asked = spark.createDataFrame([(0, [[2.0, 0.0], [0.0, 1.0]])], "q_pos int, vectors array<array<float>>")
    assert [r.score for r in Q.max_similarity(tokens, asked).orderBy("para_idx").collect()] == [2.0, 0.0]
    sizes = []

    def encode(batch):
        if len(batch) > 2:
            raise MemoryError
        sizes.append(len(batch))
        return [np.full((len(t.split()) + 1, 2), len(t)) for t in batch]

    rows = spark.createDataFrame([(i, "w " * i) for i in range(5)], "i int, paragraph string").coalesce(1)
    assert [len(r.vectors) for r in Q.encoded(rows, encode, batch=4).orderBy("i").collect()] == [1, 2, 3, 4, 5]
    (tmp_path / "q.json").write_text('{"one": "grant"}')
    assert P.load(None, P.QUERIES, "queries") is P.QUERIES and P.load(str(tmp_path / "q.json"), {}, "queries") == {"one": "grant"}
    with pytest.raises(FileNotFoundError):
        P.load(str(tmp_path), {}, "queries")


def test_statement_text():
    assert T.plain_funding_statement("We thank 101\nthe fund 102\nand the 103\ncouncil\\_x 7") == "We thank the fund and the council_x 7"
    assert T.plain_funding_statement("grants 1, 5 and 7 of n~o") == "grants 1, 5 and 7 of ño" and T.integer_runs([1, 2, 3, 9, 10, 4]) == [(0, 3)]


def test_mending(spark):
    assert H.merge_broken_lines("this is a line that is bro-\nken here\n# Head\n- a\n- b\n\n\nend") == "this is a line that is broken here\n# Head\n- a\n- b\n\nend"
    assert H.recover_words("thisisthemethodofourwork\nthedataareshowninthispaper") == ("this is the method of our work\nthe data are shown in this paper", 3, 2)
    assert H.recover_words("has blanks " * 10)[1] == 0 and H.split_words("zzzzqqqqxxxxyyyywwww")[1] == 0
    assert H.repair_tables("| a | b |\n| 1 | 2 |\nx") == "| a | b |\n|:--|:--|\n| 1 | 2 |\nx" and H.repair_tables("a  b\nlast") == "a  b\nlast"
    assert H.merge_fragments("a\nb\n\nc\nd\ne\nf\na long line of text") == "a b c d e f\na long line of text"
    rows = spark.createDataFrame([(1, "--\nThe first line\nfoo\nfoo\n12\n\n\n\n\nbody text here"), (2, None), (3, "")], "i int, text string")
    got = {r.i: r for r in H.restored(rows, least_count=2).collect()}
    assert got[1].text == "The first line body text here" and got[1].warnings == ["Trimmed leading noise before first paragraph"] and got[2].text is None
    lines = spark.createDataFrame([("ABSTRACT",), ("2.1 Methods and so on it goes",), ("a lower line",), ("Ends.",), ("It really ends here.",)], "s string")
    assert [(r[0], r[1]) for r in lines.select(H.is_section_header(lines.s), H.is_complete_sentence(lines.s)).collect()] == [(True, False), (True, False), (False, False), (True, False), (False, True)]
