"""The toxicity grammar, its learning, and held-out accuracy."""

import itertools
import os
import random
import re
import zlib

import pytest

from kempt.llm import toxicity as T

SF = "/root/testdata/sf0.01"


def weight(text):
    return sum(T.clause_score(c) for c in T.Lexicon({}).symbols(text).split("|"))


def test_clauses_not_words():
    plain = weight("what an idiot")
    assert weight("you are an idiot") > plain > weight("you are not an idiot") > 0
    assert weight("they said you are an idiot") < weight("you are an idiot")
    assert weight("not here. an idiot came") == plain  # a negation does not reach the next clause
    assert weight("not here\nan idiot came") == plain
    assert weight("I will kill you") > 0 == weight("I kill time")
    assert weight("a fine day") == 0 == weight("")


def by_patterns(clause):
    """A clause's weight by regular expressions around each match."""
    total = 0.0
    for m in re.finditer("[1-9t]", clause):
        before, after = clause[:m.start()], clause[m.end():]
        if m[0] == "t":
            weight = 5.0 if re.search("^.{0,3}y", after) else 0.0
        else:
            weight = float(m[0]) * (1.25 if re.search("y.{0,2}$", before) or re.search("^.{0,2}y", after) else 1.0)
        weight *= 0.3 if re.search("n.{0,2}$", before) else 1.0
        total += weight * (0.5 if re.search("r.{0,6}$", before) else 1.0)
    return total


def clauses():
    rng = random.Random(8)
    yield from ("".join(c) for n in range(4) for c in itertools.product("o6tynr", repeat=n))
    for _ in range(3000):
        yield "".join(rng.choices(T.SYMBOLS, [8, *[1] * 9, 3, 4, 3, 2], k=rng.randint(0, 40)))


def test_grammar_against_patterns():
    for c in clauses():
        assert T.clause_score(c) == pytest.approx(by_patterns(c)), c


def test_composition_is_the_parts_one_after_another():
    for c in clauses():
        tape = T.annotated(c)
        found = [a + b for a, b in zip(T.INSULT.weights(tape), T.THREAT.weights(tape), strict=True)]
        for part in (T.TARGET, T.NEGATION, T.REPORTED):
            found = [a * b for a, b in zip(found, part.weights(tape), strict=True)]
        assert T.GRAMMAR.weights(tape) == pytest.approx(found) and sum(found) == pytest.approx(T.clause_score(c)), c
    left = T.compose(T.compose(T.INSULT, T.NEGATION), T.REPORTED)
    right = T.compose(T.INSULT, T.compose(T.NEGATION, T.REPORTED))
    assert all(left.weights(T.annotated(c)) == pytest.approx(right.weights(T.annotated(c))) for c in clauses())


def test_scores_against_a_plain_version(spark):
    """The whole way of a text, word by word and clause by clause, from a fixed model."""
    import math
    prefixes, w = {"vequ": 8, "vequx": 0, "tox": 5}, [1.0, 2.0, 0.5, 1.5, -3.0]
    texts = ["", "you vequment are", "he said: you are a toxic idiot. I will kill you!", "no vequxy here\nI kill time", "fine day " * 30 + "you moron", "- \u00a0 -"]

    def symbol(word):
        bare = re.sub(r"^\W+|\W+$", "", word).lower()
        for s, words in (("6", T.INSULTS), ("t", T.THREATS), ("y", T.TARGETS), ("n", T.NEGATIONS), ("r", T.REPORTS)):
            if bare in words:
                return s
        best = max((p for p in prefixes if bare.startswith(p)), key=len, default="")
        return str(prefixes[best]) if prefixes.get(best) else "o"

    def plain(text):
        clauses = [""]
        for line in text.split("\n"):
            for word in line.split():
                clauses[-1] += symbol(word)
                if re.search(r"[.!?;:][\"')\]]*$", word):
                    clauses.append("")
            clauses.append("")
        clauses = [c for c in clauses if c]
        hits = [by_patterns(c) for c in clauses if re.search("[1-9t]", c)]
        x = [math.log1p(sum(hits)), max(hits) / 9, 10 * sum(hits) / sum(map(len, clauses)), sum(h > 0 for h in hits) / len(clauses)] if hits else [0.0] * 4
        return 1 / (1 + math.exp(-sum(a * b for a, b in zip([*x, 1.0], w, strict=True))))

    import numpy as np
    import pyarrow as pa
    got = next(T._scores(prefixes, np.array(w))(iter([pa.array(texts)]))).to_pylist()
    assert got == pytest.approx([plain(t) for t in texts])


def test_words_as_written():
    lex = T.Lexicon({"vequ": 8, "vequx": 0})
    assert lex.symbols('"Idiot!" (vequment) vequx vequxy, the end.') == "6|8oooo|"
    assert lex.symbols("a\nb") == "o|o"


def test_beginnings():
    rows = [("tox", 90, 0), ("toxi", 90, 0), ("com", 50, 300), ("wor", 60, 600), ("word", 55, 0), ("worth", 30, 0), ("few", 1, 0)]
    got = T.strengths(rows, 100, 1000)
    assert got["tox"] >= 5 and "toxi" not in got and "com" not in got and "few" not in got
    assert "wor" not in got and got["word"] >= 5


def test_edge_rows(spark):
    rows = [(i, "you stupid idiot" if i % 3 == 0 else "a fine day it is", "x", 0.0) for i in range(90)]
    rows += [(None, "you idiot", "x", 0.0), (200, None, "x", 0.0), (201, "", "x", 0.0), (3, "you stupid idiot", "x", 0.0),
             (202, "a fine day " * 50000 + "you moron", "x", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(None, 1), (7, None), (8, 5), (999, 1)],
                                   "doc_id long, toxic int")
    got = T.score(docs, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].predicted == (i % 3 == 0) for i in range(90))
    assert by[None].predicted == 1 and by[200].predicted == by[201].predicted == 0
    assert 0 <= min(r.score for r in got) <= max(r.score for r in got) <= 1
    kept = T.drop_toxic(docs, labels)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} >= {200, 201, 1, 2} and not {r.doc_id for r in kept.collect()} & {0, 3, None}
    assert T.score(docs.limit(0), labels).count() == 0
    assert T.score(docs, labels.limit(0)).filter("predicted = 1").count() > 0  # the fixed grammar alone


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_held_out_accuracy(spark):
    from kempt.llm.queries import QUERIES
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = QUERIES["op5_toxicity"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [(toxic[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in toxic]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    assert not any(a == 0 and b == 1 for a, b in held)
