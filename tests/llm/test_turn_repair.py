"""Repair of conversations against all edit scripts, a best-first search and plain Python."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from kempt.llm import turn_repair as T

GRAMMAR = re.compile(r"(s?(ua)+)?")


def solved(signature):
    a = T.Automaton()
    a.add(signature[::-1])
    return a.best()


def every_script(signature):
    """The best of all scripts with up to two turns inserted in a gap."""
    gaps = ["", "u", "a", "ua", "au"]
    turns = []
    for c in signature:
        options = [("D", "", 3)]
        if c != "x":
            extra = c.isupper()
            options += [("R", r, 2 + extra) for r in "ua"]
            options.append(("K", c.lower(), int(extra)))
        turns.append(options)
    best = None
    for chosen in itertools.product(*turns):
        for put in itertools.product(gaps, repeat=len(signature) + 1):
            roles = put[0] + "".join(r + g for (_, r, _), g in zip(chosen, put[1:], strict=True))
            if GRAMMAR.fullmatch(roles):
                audit = "I" * len(put[0]) + "".join(e + "I" * len(g) for (e, _, _), g in zip(chosen, put[1:], strict=True))
                found = (sum(c for _, _, c in chosen) + 2 * sum(map(len, put)), audit)
                best = min(best, found) if best else found
    return best


def best_first(turns):
    """(cost, audit, lines) of (role, text, gone, truncated) turns: the cheapest script by a heap."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, state, lines = heapq.heappop(heap)
        if (at, state) in seen:
            continue
        seen.add((at, state))
        if at == len(turns) and state in ("", "a"):
            return cost, audit, lines
        after = "a" if state == "u" else "u"
        full = {"u": "user", "a": "assistant"}[after]
        heapq.heappush(heap, (cost + 2, audit + "I", at, after, (*lines, f"{full}:")))
        if at < len(turns):
            role, text, gone, truncated = turns[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, state, lines))
            if not gone:
                heapq.heappush(heap, (cost + 2 + truncated, audit + "R", at + 1, after, (*lines, f"{full}:{text}")))
                if role[:1] == after or (role[:1] == "s" and state == ""):
                    heapq.heappush(heap, (cost + truncated, audit + "K", at + 1, role[:1], (*lines, f"{role}:{text}")))
    raise AssertionError


@pytest.mark.parametrize("n", range(4))
def test_every_short_signature(n):
    for s in itertools.product(T.SYMBOLS, repeat=n) if n < 3 else random.Random(1).sample(list(itertools.product(T.SYMBOLS, repeat=3)), 60):
        cost, audit, roles = solved("".join(s))
        assert (cost, audit) == every_script("".join(s)), s
        assert GRAMMAR.fullmatch(roles.replace("-", ""))


def test_nodes_are_shared():
    rng = random.Random(0)
    signatures = {"".join(rng.choices("xsuaUA", k=rng.randint(0, 12))) + "uaua" for _ in range(300)}
    a = T.Automaton()
    for backward in sorted(s[::-1] for s in signatures):
        a.add(backward)
        assert a.best() == solved(backward[::-1])
    rests = {s[i:] for s in signatures for i in range(len(s))}
    assert a.made == len(rests)  # one node for each different rest


def expected(rows):
    """The registered query in plain Python."""
    space = " \t\n\x0b\x0c\r"
    convs = {}
    for conv, turn, role, text in rows:
        left = convs.setdefault(conv, [])
        f = lambda v: " " if v is None else v
        code = zlib.crc32(f"{f(conv)}:{f(turn)}".encode()) % 20
        role, text = f(role), f(text)
        if code == 1:
            text = ""
        elif code == 2:
            text = re.sub("[.!?]", "", text)
        elif code == 4:
            role = "user"
        left += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    out = []
    for conv, left in convs.items():
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, turns, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in left:
            cut = text.rstrip(space)
            fault = "blank" if not cut else "duplicate" if (role, text) in seen else "truncated" if cut[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            turns.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        numbers = [t for t, _, _ in left if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(left))
        cost, audit, lines = best_first(turns)
        out.append((conv, gaps, *count.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, n=120):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "And then", " why? ", "", None, " \t\n", "é?\x0b", "Same.", "Same.", "a ", "x\nuser:y.", "ok? "]
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", None, "User", "aide"]
    rows = []
    for conv in [*range(n), None]:
        last = rng.choice([1, 3, 6, 9, 40])
        for turn in range(last):
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.7 else rng.choice(roles)
            text = f"turn {turn}." if rng.random() < 0.5 else rng.choice(texts)
            if rng.random() < 0.9:
                rows.append((conv, rng.choice([turn, turn, turn, None, turn + 2]), role, text))
    return rows + rows[:5]  # repeated rows


@pytest.mark.parametrize("seed", range(2))
def test_query_against_plain(spark, seed):
    rows = conversations(seed)
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, pos int, audit string").repartition(5)
    got = T.summary(df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_general_interface(spark):
    rows = [(7, 1, "assistant", "Hello."), (7, 2, "user", "Hi"), (7, 3, "user", "Hi"), (7, 5, "Tool", "Done."), (8, None, None, None)]
    df = spark.createDataFrame(rows, "Conv int, n int, who string, said string")
    report, repaired = T.repair(df, "conv", "n", "who", "said")
    assert sorted(map(tuple, report.collect())) == [(7, 1, 0, 1, 1, 2, 8, "IKKDR"),
                                                    (8, 0, 1, 0, 0, 0, 3, "D")]
    turns = sorted(map(tuple, repaired.collect()))
    assert turns == [(7, 0, "user", "", "I"), (7, 1, "assistant", "Hello.", "K"), (7, 2, "user", "Hi", "K"), (7, 3, "assistant", "Done.", "R")]
    empty = df.limit(0)
    assert T.repair(empty, "conv", "n", "who", "said")[0].count() == 0 and T.repair(empty, "conv", "n", "who", "said")[1].count() == 0


def test_long_conversation(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"t{i}.") for i in range(30_000)]
    report, repaired = T.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert tuple(report.first()) == (1, 0, 0, 0, 0, 0, 0, "K" * 30_000)
    assert repaired.count() == 30_000
