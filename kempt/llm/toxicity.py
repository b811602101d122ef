"""Toxicity by a weighted finite-state pattern grammar.

Texts pass through a cascade of finite-state transducers:

1. Words to symbols. A word is an insult of strength 1 to 9, a threat, a target, a negation, a
   reporting word or other. Insults are a fixed list and word beginnings whose weights are
   learned (a weighted trie over the first letters). A word that ends a sentence also closes
   the clause, as does a line end.
2. Symbols to clause matches. Clauses with neither insult nor threat end here. The others are
   read once from the end, which notes how near the next target is, and then by one weighted
   automaton: insult and threat transducers united, composed with those of target, negation
   and reported speech. An insult counts with its strength: more if a target stands close,
   little if it is negated, half if reported ("he said ..."). A threat counts only if it
   reaches a target. A clause scores the summed weight of its path.
3. Matched clauses to a score: logistic regression on how strong, how many and how dense
   the matched clauses are, never on words alone.

Learning reads labelled rows that are not held out, at most ``limit`` of label 1 and four
times as many of label 0; the word beginnings are learned from one half of them, the regression from the other.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kempt.llm.common import held_out, id_text, on_workers, slices, stored

# The words of the grammar, in the languages of the corpus.
INSULTS = """idiot idiots moron morons stupid scum loser losers trash worthless pathetic clown clowns disgusting imbecile
jerk filth vermin dumb idiotisch dumm trottel abschaum idiota estúpido basura escoria imbécile crétin ordure""".split()
THREATS = "kill hurt destroy crush beat burn shoot stab töten schlagen matar golpear tuer frapper".split()
TARGETS = """you your yours yourself u he she they them him her his their du dich dir ihr euch tu tú te usted ustedes
vous toi ils elles""".split()
NEGATIONS = "not no never none nobody isn't aren't wasn't don't doesn't nicht kein keine nie nunca jamás pas jamais".split()
REPORTS = """said says say called calls wrote writes quoted claimed claims reported sagte nannte schrieb dijo llamó escribió
dit appelé écrit""".split()

_FIXED = 6  # strength of the listed insults
_MIN, _MAX = 3, 8  # letters of a learned word beginning
_EDGES = re.compile(r"^\W+|\W+$")
_END = re.compile(r"[.!?;:][\"')\]]*$")
REMEMBER = 1 << 17  # words that a task remembers before it starts over

_HIT = re.compile(r"[1-9t]")


# ------------------------------------------------------------------ transducers
class Transducer:
    """Arcs by state and input: (weight put out, next state). Inputs are a symbol and how near the
    next target is; a missing arc puts out 0 and leads back to the start."""

    def __init__(self, start, arcs: dict):
        self.start, self.arcs = start, arcs

    def weights(self, tape: list[tuple[str, int]]) -> list[float]:
        state, out = self.start, []
        for x in tape:
            weight, state = self.arcs.get((state, x), (0.0, self.start))
            out.append(weight)
        return out


SYMBOLS = "o123456789tynr"
STRENGTHS = "123456789"
_FAR = 5  # targets are looked for up to four words ahead
TAPE = [(c, n) for c in SYMBOLS for n in range(1, _FAR + 1)]


def annotated(clause: str) -> list[tuple[str, int]]:
    """The first transducer of the cascade, read from the end: each symbol with the distance to the
    next target after it (``_FAR``: none near)."""
    near, out = _FAR, []
    for c in reversed(clause):
        out.append((c, near))
        near = 1 if c == "y" else min(near + 1, _FAR)
    return out[::-1]


def stateless(weight) -> Transducer:
    return Transducer(0, {(0, x): (weight(x), 0) for x in TAPE})


def since(mark: str, reach: int, weight) -> Transducer:
    """States: words since ``mark``, 0 beyond ``reach``; puts out ``weight(input, whether it is near)``."""
    arcs = {}
    for state in range(reach + 1):
        for x in TAPE:
            arcs[state, x] = (weight(x, state > 0), 1 if x[0] == mark else (state + 1) % (reach + 1) if state else 0)
    return Transducer(0, arcs)


#: An insult weighs its strength.
INSULT = stateless(lambda x: float(x[0]) if x[0] in STRENGTHS else 0.0)
#: A threat weighs 5 if it reaches a target at most four words ahead.
THREAT = stateless(lambda x: 5.0 if x[0] == "t" and x[1] < _FAR else 0.0)
#: An insult at most three words before or behind a target counts more.
TARGET = since("y", 3, lambda x, near: 1.25 if x[0] in STRENGTHS and (near or x[1] <= 3) else 1.0)
#: Negated at most three words before, little is left; reported at most seven words before, half.
NEGATION = since("n", 3, lambda x, near: 0.3 if near else 1.0)
REPORTED = since("r", 7, lambda x, near: 0.5 if near else 1.0)


def _product(a: Transducer, b: Transducer, combine) -> Transducer:
    """The transducer whose states are the pairs that can be reached, whose arcs combine weights."""
    start = (a.start, b.start)
    arcs, queue, seen = {}, [start], {start}
    while queue:
        state = queue.pop()
        for x in TAPE:
            (wa, na), (wb, nb) = a.arcs[state[0], x], b.arcs[state[1], x]
            arcs[state, x] = (combine(wa, wb), (na, nb))
            if (na, nb) not in seen:
                seen.add((na, nb))
                queue.append((na, nb))
    return Transducer(start, arcs)


def union(a: Transducer, b: Transducer) -> Transducer:
    """Matches of either: weights add."""
    return _product(a, b, lambda x, y: x + y)


def compose(a: Transducer, b: Transducer) -> Transducer:
    """``b`` reweighs what ``a`` puts out: weights multiply."""
    return _product(a, b, lambda x, y: x * y)


def _numbered(t: Transducer) -> list[dict[tuple[str, int], tuple[float, int]]]:
    """A table of arcs by state number; the start is 0."""
    names = {t.start: 0}
    for state, _ in t.arcs:
        names.setdefault(state, len(names))
    table: list[dict] = [{} for _ in names]
    for (state, x), (weight, after) in t.arcs.items():
        table[names[state]][x] = (weight, names[after])
    return table


#: The whole grammar as one weighted automaton.
GRAMMAR = compose(compose(compose(union(INSULT, THREAT), TARGET), NEGATION), REPORTED)
_ARCS = _numbered(GRAMMAR)


class Lexicon(dict):
    """Word as written to its symbol, remembered by word; ``|`` after it closes the clause."""

    def __init__(self, prefixes: dict[str, int]):
        super().__init__()
        self.prefixes = prefixes
        self.words = {w: str(_FIXED) for w in INSULTS}
        for symbol, words in (("t", THREATS), ("y", TARGETS), ("n", NEGATIONS), ("r", REPORTS)):
            self.words.update({w: symbol for w in words})

    def __missing__(self, word: str) -> str:
        bare = _EDGES.sub("", word).lower()
        symbol = self.words.get(bare)
        if symbol is None:
            # the longest learned beginning decides: deeper in the trie is more specific
            symbol = "o"
            for n in range(min(len(bare), _MAX), _MIN - 1, -1):
                if (strength := self.prefixes.get(bare[:n])) is not None:
                    symbol = str(strength) if strength else "o"
                    break
        got = sys.intern(symbol + "|" if _END.search(word) else symbol)
        if len(self) >= REMEMBER:
            self.clear()
        self[word] = got
        return got

    def symbols(self, text: str) -> str:
        return "|".join(["".join(map(self.__getitem__, line.split())) for line in text.split("\n")])


def clause_score(clause: str) -> float:
    """Weight of one clause of symbols: of its path through the grammar, summed."""
    total, state = 0.0, 0
    for x in annotated(clause):
        weight, state = _ARCS[state][x]
        total += weight
    return total


def features(symbols: str) -> list[float]:
    """Of the matched clauses: log of their total, the strongest, strength for each word,
    share of clauses that match."""
    if not _HIT.search(symbols):
        return [0.0, 0.0, 0.0, 0.0]
    clauses = [c for c in symbols.split("|") if c]
    scores = [clause_score(c) for c in clauses if _HIT.search(c)]
    words = len(symbols) - symbols.count("|")
    return [float(np.log1p(sum(scores))), max(scores) / 9, 10 * sum(scores) / words,
            sum(s > 0 for s in scores) / len(clauses)]


# ------------------------------------------------------------------ learning
def _beginnings(batches):
    """Documents of the task's sample by beginning of a word and label."""
    toxic, clean = Counter(), Counter()
    for b in batches:
        for text, label in zip(b["text"].to_pylist(), b["toxic"].to_pylist(), strict=True):
            words = {_EDGES.sub("", w).lower() for w in text.split()}
            found = {w[:n] for w in words for n in range(_MIN, min(len(w), _MAX) + 1)}
            (toxic if label else clean).update(found)
    keys = [k for k in toxic]
    yield pa.record_batch([pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()),
                           pa.array([clean[k] for k in keys], pa.int64())], names=["prefix", "toxic", "clean"])


def strengths(rows: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> dict[str, int]:
    """Beginning to strength 0 to 9 from its numbers of toxic and clean documents: log odds
    at the careful end of both counts' errors. A beginning that says the same as a shorter
    one is left out, one that speaks against a shorter one gets 0."""
    found: dict[str, int] = {}
    for prefix, toxic, clean in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        odds = (np.log((toxic - np.sqrt(toxic) + 0.1) / (n_toxic + 1))
                - np.log((clean + np.sqrt(clean) + 1) / (n_clean + 1)))
        strength = int(np.clip(round(1.6 * odds), 0, 9))
        if strength < 5:
            strength = 0
        shorter = next((found[prefix[:n]] for n in range(len(prefix) - 1, _MIN - 1, -1) if prefix[:n] in found), 0)
        if strength != shorter:
            found[prefix] = strength
    return found


def _features(prefixes: dict[str, int]):
    def run(batches):
        lexicon = Lexicon(prefixes)
        for b in slices(batches):
            x = np.array([features(lexicon.symbols(t)) for t in b["text"].to_pylist()]).reshape(-1, 4)
            yield pa.record_batch([b["toxic"], *[pa.array(c) for c in x.T]], names=["toxic", "f0", "f1", "f2", "f3"])
    return run


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Weighted logistic regression by Newton's method; the last coefficient is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (y - p)) - penalty @ w
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + penalty
        step = np.linalg.solve(h, g)
        w += step / max(1.0, np.abs(step).max() / 3)
        if np.abs(step).max() < 1e-6:
            break
    return w


#: Used when a label is missing from the sample: an insult in the text is enough.
DEFAULT = np.array([2.0, 1.0, 0.0, 0.0, -3.0])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        limit: int = 3000) -> tuple[dict[str, int], np.ndarray]:
    """(word beginnings, regression) from at most ``limit`` rows of label 1 and four times as
    many of label 0, chosen by a hash of the id among labelled rows that are not held out."""
    on_workers(docs.sparkSession)
    lab = (labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
           .filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    totals = {r["toxic"]: r["n"] for r in lab.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals.get(1) or not totals.get(0):
        return {}, DEFAULT
    most = {1: limit, 0: 4 * limit}
    # a hash range that holds about twice as many rows as needed spares sorting the others
    chance = {k: min(1.0, (2 * most[k] + 64) / totals[k]) for k in most}
    near = (lab.withColumn("h", F.xxhash64("doc_id"))
            .filter(F.pmod("h", F.lit(1 << 20)) < F.when(F.col("toxic") == 1, chance[1]).otherwise(chance[0]) * (1 << 20)))
    nth = F.row_number().over(Window.partitionBy("toxic").orderBy("h", "doc_id"))
    chosen = near.withColumn("nth", nth).filter(F.col("nth") <= F.when(F.col("toxic") == 1, most[1]).otherwise(most[0])).select("doc_id", "toxic", (F.col("nth") % 2).alias("half"))
    chosen = stored(chosen, "toxicity-sample")  # at most 5 * limit rows of three numbers
    sample = stored(id_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
                    .select("toxic", "half", "text"), "toxicity-texts")
    n = {(r["half"], r["toxic"]): r["n"] for r in sample.groupBy("half", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = (sample.filter("half = 0").select("text", "toxic").mapInArrow(_beginnings, "prefix string, toxic long, clean long")
            .groupBy("prefix").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    enough = max(3, n.get((0, 1), 0) // 200)
    prefixes = strengths([tuple(r) for r in rows.filter(F.col("toxic") >= enough).collect()], n.get((0, 1), 0), n.get((0, 0), 0))
    x = (sample.filter("half = 1").select("toxic", "text")
         .mapInArrow(_features(prefixes), "toxic int, f0 double, f1 double, f2 double, f3 double").toPandas())
    y = x["toxic"].to_numpy()
    if len(set(y)) < 2:
        return prefixes, DEFAULT
    # back to the labels' own shares
    share = {k: totals[k] / sum(totals.values()) for k in (0, 1)}
    weight = np.where(y == 1, share[1] / (y == 1).mean(), share[0] / (y == 0).mean())
    return prefixes, logistic(x[["f0", "f1", "f2", "f3"]].to_numpy(), y, weight)


def _score(prefixes: dict[str, int], w: np.ndarray):
    def run(batches):
        lexicon = Lexicon(prefixes)
        for b in slices(batches):
            x = np.array([features(lexicon.symbols(t)) for t in b["text"].to_pylist()]).reshape(-1, 4)
            p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            yield b.drop_columns(["text"]).append_column("score", pa.array(p)).append_column(
                "predicted", pa.array((p >= 0.5).astype(np.int32)))
    return run


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          limit: int = 3000) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 if score >=
    0.5), text_key (XXH64 of the text, to tell rows apart).

    Null text counts as empty; a text without any match has the lowest score. held_out: crc32
    of the id as text is divisible by 5 (also for a null id). Labels other than 0 and 1, null
    labels and labels of ids without a document are not used; an id labelled twice is toxic
    if one of its labels is."""
    on_workers(docs.sparkSession)
    prefixes, w = fit(docs, labels, id_col, text_col, label_col, limit)
    rows = (id_text(docs, id_col, text_col)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.xxhash64("text").alias("text_key"), "text"))
    return rows.mapInArrow(_score(prefixes, w), "doc_id long, held_out boolean, text_key long, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns unchanged. Scores the rows in
    the pass that filters them."""
    spark = docs.sparkSession
    on_workers(spark)
    prefixes, w = fit(docs, labels, id_col, text_col)
    on_texts = F.arrow_udf(_scores(prefixes, w), "double")
    # only the text goes to Python; the other columns, whatever their types, stay where they are
    return docs.filter(on_texts(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))) < 0.5)


def _scores(prefixes: dict[str, int], w: np.ndarray):
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lexicon = Lexicon(prefixes)
        for part in texts:
            x = np.array([features(lexicon.symbols(t)) for t in part.to_pylist()]).reshape(-1, 4)
            yield pa.array(1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30))))
    return run
