"""The reference's operators: every query beside its SQL, and small cases."""

import glob
import itertools
import os

import duckdb
import numpy as np
import pytest

from grantlens.functions import healing as H
from grantlens.functions import similarity as S
from grantlens.functions import text as T
from grantlens.operators import relational as R
from grantlens.operators import retrieval as X
from grantlens.plans import healing, queries, records  # noqa: F401
from grantlens.plans.registry import ORACLE, QUERIES
from verify import canonical

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in ORACLE:
        want = duck.execute(ORACLE[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert canonical(got).equals(canonical(want))
    assert len(got) or name == "rollout_errors"


def test_paragraph_rules(spark):
    df = spark.createDataFrame([(1, "a\n \nwe got grants\n\nb\n\nc"), (2, ""), (3, None), (4, "only")], "doc_id bigint, text string")
    assert [(r.doc_id, r.para_idx, r.paragraph) for r in X.split_documents(df).orderBy("doc_id", "para_idx").collect()] == [(1, 0, "a"), (1, 1, "we got grants"), (1, 2, "b"), (1, 3, "c"), (4, 0, "only")]
    assert sorted(r.para_idx for r in X.prefilter(df).collect()) == [0, 1, 2]
    assert X.extract_statements(df.limit(0)).count() == 0


def test_text_functions(spark):
    df = spark.createDataFrame([("a-\nb ﬁx  y", "AB-123 4", "AB-1235", "x/2001-00-1.md", "Please retry this in about 3 minutes")], "t string, a string, b string, f string, r string")
    got = df.select(T.preprocess_statement(df.t), T.normalize_award_id(df.a), T.soft_award_score(df.a, df.b), T.canonical_filename(df.f), T.retry_seconds(df.r)).first()
    assert tuple(got) == ("ab fix y", "AB1234", 0.5, "2001.00-1.md", 180)


def test_resume_nulls_equal(spark):
    rows = spark.createDataFrame([("A", None), ("A", 1), ("B", 2)], "k string, n int")
    assert [tuple(r) for r in R.resume(rows, rows.filter("n is null or n = 2"), ["k", "n"]).collect()] == [("A", 1)]


def test_similarity():
    assert S.ratio("", "") == 1.0 and S.ratio("abc", "") == 0.0 and abs(S.ratio("kitten", "sitting") - 8 / 13) < 1e-9
    assert S.token_sort_ratio("b a", "a b") == 1.0 and S.token_set_ratio("a b c", "a b") == 1.0 and S.partial_ratio("bcd", "abcde") == 1.0


def test_assignment_is_optimal():
    rng = np.random.default_rng(0)
    for n, m in ((1, 1), (3, 5), (5, 3), (5, 5)):
        score = rng.random((n, m))
        best = max(sum(score[i, j] for i, j in zip(range(n), p)) for p in itertools.permutations(range(m), n)) if n <= m else max(sum(score[i, j] for i, j in zip(p, range(m))) for p in itertools.permutations(range(n), m))
        assert abs(sum(score[i, j] for i, j in S.assign(score)) - best) < 1e-9
    assert S.assign(np.array([[0.3]]), 0.5) == [] and S.assign(np.zeros((0, 2))) == []


def test_bullets_of_the_reference(spark):
    texts = ["·one\n  ▫▪ two\n••three", "‣ four"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.x for r in rows.orderBy("i").select(H.normalize_bullets(rows.t).alias("x")).collect()]
    assert got == ["- one\n  - two\n- three", "- four"]
