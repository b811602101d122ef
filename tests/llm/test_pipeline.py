"""The pipeline stage by stage against plain versions, and planted cases."""

import os
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from kempt.llm import toxicity
from kempt.llm.common import stored
from tests.llm.brute import components_of, simhash_fp
from tests.llm.test_mixing import brute as mixture

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def stages(spark):
    """Documents before and after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), "stage"))
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "SimHash near-dedup",
                                                      "mixing sources to target weights", "packing"]


def test_columns_stay(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_toxicity_stage(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rejected = {r.doc_id for r in toxicity.score(stages[0], labels).filter("predicted = 1").collect()}
    assert ids(stages[1]) == Counter(set(ids(stages[0])) - rejected)


def test_exact_stage(stages):
    first = {}
    for r in sorted(stages[1].collect()):
        first.setdefault(re.sub("[\x20\x09-\x0D]+", " ", r.text), r.doc_id)
    assert ids(stages[2]) == Counter(first.values())


def test_near_stage(stages):
    docs = sorted(stages[2].collect())
    fps = [simhash_fp(d.text) for d in docs]
    root = components_of(len(docs), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    assert ids(stages[3]) == Counter({docs[r].doc_id for r in root})


def test_mixing_stage(stages):
    want = Counter()
    for (doc_id, _, _), n in mixture([(r.doc_id, r.text, r.source) for r in stages[3].collect()], 0.999, 1.5).items():
        want[doc_id] += n
    assert ids(stages[4]) == want


def test_packing_stage(stages):
    copies, pieces = ids(stages[4]), stages[5].collect()
    tokens = defaultdict(int)
    for p in pieces:
        tokens[p.doc_id] += p.length
    size = {p.doc_id: p.doc_tokens for p in pieces}
    assert tokens == {i: n * size[i] for i, n in copies.items()}


def test_run_is_all_stages(spark, stages):
    cols = ["doc_id", "start", "length", "ids_crc32"]
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).select(*cols).collect())
    assert sum(got.values()) >= stages[5].count() * 0.9
    whole = {r.doc_id for r in stages[5].collect()}
    assert {k[0] for k in got} == whole


def test_planted(spark):
    """Extra columns, nulls and repeated rows pass through; copies and insults go."""
    text = "plain words that nobody else uses in this order " * 3
    rows = [(1, text, "en", "a", 1), (2, text.replace(" ", "  "), "en", "a", 1), (3, text.upper(), "en", "b", 1),
            (4, "you are a stupid idiot and a worthless moron, you scum", "en", "a", 1), (5, None, None, None, None),
            (6, "another text altogether with its own words here", "de", "b", 1), (6, "another text altogether with its own words here", "de", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), "planted")
    got = ids(docs)
    assert set(got) == {1, 5, 6} and {r.doc_id: r.n_chars for r in docs.collect()}[1] == 1
    assert corpus_pipeline.pack(spark, docs, SF).count() >= 3
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_any_columns_pass_all_stages(spark):
    """Columns whose names the operators use themselves, other letter cases, and types that cannot be ordered or sent to Python."""
    sql = """SELECT doc_id, text AS Text, lang, source, n_chars, 'p' AS __plan, 'c' AS __copy, 'k' AS key_id, 'e' AS epochs, 'w' AS row, 's' AS score,
             map('a', doc_id) AS m, parse_json('{"a": 1}') AS v, make_dt_interval(1, 2) AS i, make_interval(1) AS ci FROM d"""
    base = spark.read.parquet(f"{SF}/documents.parquet")
    base.createOrReplaceTempView("d")
    docs = spark.sql(sql)
    docs = docs.unionByName(docs.filter("doc_id % 10 = 0"))  # repeated rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.dtypes == docs.dtypes, name
        assert after.filter("__plan <> 'p' OR __copy <> 'c' OR key_id <> 'k' OR epochs <> 'e' OR row <> 'w' OR score <> 's' OR m['a'] <> doc_id").count() == 0, name
        if name == "toxicity":
            docs = after
    assert corpus_pipeline.pack(spark, docs, SF).count() > 0
