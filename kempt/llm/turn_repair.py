"""Repair of conversation structure over a suffix-shared automaton.

Every turn becomes one symbol: its role and whether it has to go (blank or repeated), is
truncated, or neither. A conversation is the string of its symbols, its signature. What the
cheapest repair costs from a turn on depends on the rest of the signature and on what the
grammar ``(s?(ua)+)?`` has read so far, so equal rests are one node of an automaton. Different
signatures are sorted by their reverse, range by range; a worker keeps the path of the last
one, and the next shares the nodes of the common rest. Each new node gets, for each of the four
grammar states, its cost-to-go and the first edit of the best audit, which goes on in the node
after it.

Edits: Keep (0), Rerole to user or assistant (2), Delete (3), Insert a turn with empty text (2);
a truncated turn that is not deleted adds 1. From one node and state each initial leads to one
place only, so of equally cheap audits the ASCII-least takes the smaller initial at once.

A conversation's turns are put in order by a window and read as a stream of sorted rows; only
signatures and audits, a character for a turn, are ever whole.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kempt.llm.common import n_parts, on_workers, slices, stored

_SPACE = " \t\n\x0b\x0c\r"
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)  # the turn that Rerole or Insert gives in each state
_ROLE = {_SYSTEM: "s", _USER: "u", _ASSISTANT: "a"}
_REROLE, _DELETE, _INSERT, _TRUNCATED = 2, 3, 2, 1
#: Symbols: x has to go; s, u, a and o (any other role) may stay, in capitals if truncated.
SYMBOLS = "xsuaoSUAO"
_END = ((0, ""), (2 * _INSERT, "I"), (_INSERT, "I"), (0, ""))


def node(symbol: str, after):
    """(cost-to-go, first initial) in each grammar state, before ``symbol`` and the node ``after``."""
    base = []
    for q in range(4):
        options = [(_DELETE + after[q][0], "D")]
        if symbol != "x":
            extra = _TRUNCATED if symbol.isupper() else 0
            kept = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}.get(symbol.lower())
            if kept == _NEXT[q] or (kept == _SYSTEM and q == _START):
                options.append((extra + after[kept][0], "K"))
            options.append((_REROLE + extra + after[_NEXT[q]][0], "R"))
        base.append(min(options))
    # an Insert stays before the same turn; two in a row only if the second state has a way on
    # that is cheaper without one
    out = list(base)
    for q in (_USER, _ASSISTANT):
        out[q] = min(base[q], (_INSERT + base[_NEXT[q]][0], "I"))
    for q in (_START, _SYSTEM):
        out[q] = min(base[q], (_INSERT + out[_USER][0], "I"))
    return tuple(out)


class Automaton:
    """The nodes on the path of the last signature added, from the end of it."""

    def __init__(self):
        self.symbols: list[str] = []
        self.nodes = [_END]
        self.made = 0

    def add(self, backward: str) -> None:
        """Signatures come by their reverse, in ascending order."""
        known = self.symbols
        n, most = 0, min(len(backward), len(known))
        while n < most and backward[n] == known[n]:
            n += 1
        del known[n:], self.nodes[n + 1:]
        for c in backward[n:]:
            known.append(c)
            self.nodes.append(node(c, self.nodes[-1]))
            self.made += 1

    def best(self) -> tuple[int, str, str]:
        """(cost, audit, role initial of each edit's turn, - where it is deleted)."""
        q, at = _START, len(self.symbols)
        audit, roles = [], []
        while True:
            edit = self.nodes[at][q][1]
            if not edit:
                return self.nodes[-1][_START][0], "".join(audit), "".join(roles)
            if edit == "K":
                q = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[self.symbols[at - 1].lower()]
            elif edit != "D":
                q = _NEXT[q]
            audit.append(edit)
            roles.append("-" if edit == "D" else _ROLE[q])
            at -= edit != "I"


def _solve(batches):
    automaton = Automaton()
    for big in batches:
        for b in slices([big], 256):
            found = []
            for backward in b["backward"].to_pylist():
                automaton.add(backward)
                found.append(automaton.best())
            cost, audit, roles = zip(*found, strict=True) if found else ((), (), ())
            yield pa.record_batch([b["backward"], pa.array(cost, pa.int64()), pa.array(audit, pa.string()), pa.array(roles, pa.string())],
                                  names=["backward", "cost", "audit", "roles"])


def _edit(batches):
    """Rows by conversation and place, the audit of each before its turns, to the repaired turns."""
    full = {"s": "system", "u": "user", "a": "assistant"}
    conv, audit, roles, at, place = (), "", "", 0, 0
    out: list[tuple] = []

    def inserts():
        nonlocal at, place
        while at < len(audit) and audit[at] == "I":
            out.append((conv, place, full[roles[at]], "", "I"))
            at, place = at + 1, place + 1

    def flush():
        cols = list(zip(*out, strict=True)) if out else [()] * 5
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["conv_id", "place", "role", "text", "edit"])

    for big in batches:
        for b in slices([big], 1024):
            for c, pos, role, text, a, r in zip(*(b[k].to_pylist() for k in ("conv_id", "pos", "role", "text", "audit", "roles")), strict=True):
                if pos == 0:  # the audit
                    conv, audit, roles, at, place = c, a, r, 0, 0
                    inserts()
                    continue
                if audit[at] != "D":
                    out.append((conv, place, full[roles[at]] if audit[at] == "R" else role, text, audit[at]))
                    place += 1
                at += 1
                inserts()
            yield flush()
            out.clear()


def faults(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Every turn with conv_id, turn, role, text, pos (from 1, by turn, nulls first, then role and
    text), its symbol, its fault if any, and whether its number is a new one; null roles and texts
    count as one space."""
    def filled(c):
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))

    rows = turns.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                        filled(role_col).alias("role"), filled(text_col).alias("text"))
    # one shuffle serves both windows: rows of one conversation are together for either
    rows = rows.repartition(n_parts(turns.sparkSession), "conv_id")
    order = [F.asc_nulls_first("turn"), "role", "text"]
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("pos"))
    line = Window.partitionBy("conv_id").orderBy(*order)
    fresh = F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.lag("turn").over(line))
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
    text = F.rtrim("text", F.lit(_SPACE))
    fault = F.when(text == "", "blank").when(F.col("seen") > 1, "duplicate").when(~F.right(text, F.lit(1)).isin(".", "!", "?"), "truncated")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    return (rows.withColumn("pos", F.row_number().over(line).cast("long")).withColumn("fresh", fresh).withColumn("seen", seen)
            .withColumn("fault", fault).withColumn("initial", initial)
            .select("conv_id", "turn", "role", "text", "pos", "initial", "fault", "fresh", symbol.alias("symbol")))


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(report, repaired): one row per conversation of ``turns`` with conv_id, gaps, blank, duplicate,
    truncated, illegal, cost and audit; and the repaired turns with conv_id, place (from 0), role,
    text and edit, which partitions hold by conversation and place.

    A turn's first fault counts: blank (no character but white space), duplicate (role and text
    occurred before), truncated (the last character that is not white space is none of ``.!?``).
    gaps: turn numbers missing between the smallest and the largest, nulls aside (all null: 0).
    illegal: neighbours whose role initials are not su, ua or au. Repairs give the initials
    ``(s?(ua)+)?``; a role that begins with s, u or a counts as such, any other cannot be kept.
    Nulls: a null conversation id is one conversation, null turn numbers come first, null roles
    and texts are one space. Turns of the same number are ordered by role and text. Other columns
    are left behind; an empty table gives no rows."""
    spark = turns.sparkSession
    on_workers(spark)
    rows = stored(faults(turns, conv_col, turn_col, role_col, text_col), "turns")
    count = F.count_if
    line = F.array_sort(F.collect_list(F.struct("pos", "symbol", "initial")))
    per = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - count("fresh"), F.lit(0)).alias("gaps"),
        *[count(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")], line.alias("line"))
    initials = F.concat_ws("", "line.initial")
    # neighbours overlap, so legal pairs are counted by a look behind each place
    legal = F.regexp_count(initials, F.lit("(?<=u)a|(?<=[sa])u"))
    per = stored(per.select("conv_id", "gaps", "blank", "duplicate", "truncated", (F.size("line") - 1 - legal).cast("long").alias("illegal"),
                            F.reverse(F.concat_ws("", "line.symbol")).alias("backward")), "signatures")
    different = per.groupBy("backward").agg(F.count(F.lit(1)).alias("n"))
    solved = stored(different.repartitionByRange(n_parts(spark), "backward").sortWithinPartitions("backward").select("backward")
                    .mapInArrow(_solve, "backward string, cost long, audit string, roles string"), "audits")
    report = stored(per.join(solved, "backward").drop("backward"), "repairs")
    both = report.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("string").alias("role"),
                         F.lit(None).cast("string").alias("text"), "audit", "roles").unionByName(
        rows.select("conv_id", "pos", "role", "text"), allowMissingColumns=True)
    repaired = (both.repartition(n_parts(spark), "conv_id").sortWithinPartitions("conv_id", "pos")
                .mapInArrow(_edit, "conv_id long, place long, role string, text string, edit string"))
    return report.drop("roles"), repaired


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the turns ``repair`` gives: SHA-256 of their ``role:text`` lines.
    Reads each partition as it comes, one line at a time; conversations without turns have no row."""
    def run(batches):
        held, state = (), None

        def flush(done):
            return pa.record_batch([pa.array([c for c, _ in done], pa.int64()), pa.array([h for _, h in done], pa.string())],
                                   names=["conv_id", "repaired_sha256"])

        for b in batches:
            done = []
            for c, place, role, text in zip(*(b[k].to_pylist() for k in ("conv_id", "place", "role", "text")), strict=True):
                if place == 0:
                    if state is not None:
                        done.append((held, state.hexdigest()))
                    held, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            yield flush(done)
        if state is not None:
            yield flush([(held, state.hexdigest())])

    return repaired.mapInArrow(run, "conv_id long, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """The faults that the registered query plants, by crc32 of ``conv_id:turn`` (nulls: one space)
    modulo 20: 0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row,
    4 sets the role to user. Null roles and texts become one space."""
    def filled(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    rows = turns.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), code.alias("code"))
    copies = F.when(F.col("code") == 0, 0).when(F.col("code") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(True), copies)).alias("copy")).drop("copy")


def summary(turns: DataFrame) -> DataFrame:
    """The registered query: every conversation of ``turns``, damaged and repaired. One of which
    nothing is left has zeros, an empty audit and the digest of the empty string."""
    report, repaired = repair(damaged(turns))
    every = turns.select(F.col("conv_id").cast("long").alias("conv")).distinct()
    out = every.join(report, F.col("conv").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    out = out.join(digests(repaired), F.col("conv").eqNullSafe(F.col("conv_id")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(F.col("conv").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
