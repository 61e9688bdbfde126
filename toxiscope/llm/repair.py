"""Conversation structure repair by an automaton of shared signature suffixes.

A conversation's turns, in order, become a signature: one symbol a turn for its role
(s, u, a, other) and its fault (none, truncated, to be deleted). The repaired roles must
read ``(s?(ua)+)?``; edits are Keep (0), Rerole to user or assistant (3), Delete (4) and
Insert an empty user or assistant turn (3), and a truncated turn that stays adds 3.

Signatures are minimised from the end: equal suffixes of all conversations are one node of
an acyclic automaton (symbol, node of the rest). Each node gets, once per grammar state
(nothing yet, after s, after u, after a), its cost to go and the first letter of the best
audit with its successor, so a best audit suffix is stored once and read by following
letters. In a grammar state a letter settles the next state, so the least letter that
keeps the cost is the first of the least audit. Distinct signatures are range-partitioned
and sorted by their reverse; a task then holds the nodes of one signature at a time and
builds each suffix of its range once.

No conversation is gathered into one task. Turns are put in order by a range sort over all
rows, and a conversation is cut into blocks of at most B turns, where B is a power of two
from ``LEAST_BLOCK`` and at least the square root of the longest conversation's turns. Block
costs between grammar states are (min, +) matrices; a conversation's blocks (at most some
square root of its turns) are chained over those, from the end for the costs and from the
start for the states. Inside a block the automaton's end then carries those costs.

Order: turn (nulls first), then role and text digest. Null conversation ids are one
conversation, null roles and texts one blank. A conversation has no row here without turns.
Ties and repeated rows are turns of their own (the later ones duplicates). Other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toxiscope.llm.common import stored

BLANKS = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
LEAST_BLOCK = 1024
#: Grammar states: 0 nothing yet, 1 after s, 2 after u, 3 after a. The role that may be
#: inserted (or reroled to) in each, and the state after it.
NEXT_ROLE, NEXT_STATE = "uuau", (2, 2, 3, 2)
#: Cost and inserts from each state at the end of a conversation.
END = (0, 2 * INSERT, INSERT, 0)
N = len(END)


def kept_state(symbol: str, state: int) -> int | None:
    """State after keeping a turn; None where its role does not fit or it must go."""
    role = symbol.lower()
    if role == "s":
        return 1 if state == 0 else None
    if role == NEXT_ROLE[state]:
        return NEXT_STATE[state]
    return None


def best_step(symbol: str, rest: tuple[int, ...]) -> tuple[tuple[int, ...], str]:
    """Cost to go and first letter per state before a turn, given the costs after it."""
    extra = TRUNCATED if symbol.isupper() else 0
    options = []
    for state in range(N):
        o = {"D": DELETE + rest[state]}
        if symbol != "x":
            if (after := kept_state(symbol, state)) is not None:
                o["K"] = extra + rest[after]
            o["R"] = REROLE + extra + rest[NEXT_STATE[state]]
        options.append(o)
    cost = [min(o.values()) for o in options]
    for _ in range(N):  # inserts before the turn
        cost = [min(c, INSERT + cost[NEXT_STATE[s]]) for s, c in enumerate(cost)]
    for state, o in enumerate(options):
        o["I"] = INSERT + cost[NEXT_STATE[state]]
    return tuple(cost), "".join(min(k for k, c in o.items() if c == cost[s]) for s, o in enumerate(options))


class Suffixes:
    """Nodes of the suffixes of one signature at a time; a node is a place in the stack."""

    def __init__(self) -> None:
        self.ending: tuple = ()
        self.symbols: list[str] = []  # from the end
        self.costs: list[tuple[int, ...]] = []
        self.letters: list[str] = []
        self.steps: dict = {}

    def read(self, signature: str, ending: tuple[int, ...]) -> None:
        """Keep the nodes of the common suffix with the signature before, add the others."""
        back = signature[::-1]
        same = 0
        if ending == self.ending:
            while same < min(len(back), len(self.symbols)) and back[same] == self.symbols[same]:
                same += 1
        self.ending = ending
        for held in (self.symbols, self.letters, self.costs):
            del held[same:]
        for symbol in back[same:]:
            after = self.costs[-1] if self.costs else ending
            least = min(after)
            key = symbol, tuple(c - least for c in after)
            if key not in self.steps:
                self.steps[key] = best_step(*key)
            cost, letters = self.steps[key]
            self.symbols.append(symbol)
            self.costs.append(tuple(c + least for c in cost))
            self.letters.append(letters)

    def follow(self, state: int, last: bool) -> tuple[int, int, str, list[str], str]:
        """Cost to go, state at the end, audit, and each turn's fix (the roles inserted
        before it, then D, K, or the new role in upper case) and the roles inserted last."""
        cost = (self.costs[-1] if self.costs else self.ending)[state]
        audit, fixes, before = [], [], ""
        for symbol, letters in zip(reversed(self.symbols), reversed(self.letters)):
            while (letter := letters[state]) == "I":
                audit.append(letter)
                before += NEXT_ROLE[state]
                state = NEXT_STATE[state]
            audit.append(letter)
            if letter == "R":
                fixes.append(before + NEXT_ROLE[state].upper())
                state = NEXT_STATE[state]
            else:
                fixes.append(before + letter)
                state = kept_state(symbol, state) if letter == "K" else state
            before = ""
        while last and END[state]:
            audit.append("I")
            before += NEXT_ROLE[state]
            state = NEXT_STATE[state]
        return cost, state, "".join(audit), fixes, before


def block_matrix(signature: str) -> list[int]:
    """Least cost from each state before a block to each state after it (row by row; inserts
    before its turns only)."""
    nodes, far, columns = Suffixes(), 1 << 40, []
    for out in range(N):
        nodes.read(signature, tuple(0 if s == out else far for s in range(N)))
        columns.append(nodes.costs[-1])
    return [columns[out][s] for s in range(N) for out in range(N)]


def _matrices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        yield f.assign(matrix=[block_matrix(s) for s in f["sig"]])


def _block_ends(f: pd.DataFrame) -> pd.DataFrame:
    """Costs after each block of one conversation (less their least), and whether the pair of
    turns across the cut before it is illegal."""
    f = f.sort_values("block").reset_index(drop=True)
    ends, now = [None] * len(f), END
    for i in range(len(f) - 1, -1, -1):
        least = min(now)
        ends[i] = [int(c - least) for c in now]
        m = f.at[i, "matrix"]
        now = tuple(min(int(m[N * s + t]) + ends[i][t] for t in range(N)) for s in range(N))
    pairs = f["last_role"].shift(1, fill_value="") + f["first_role"]
    cut = [int(i > 0 and p not in ("su", "ua", "au")) for i, p in enumerate(pairs)]
    return pd.DataFrame({"block": f["block"], "ending": ends, "last": f.index == len(f) - 1, "cut": cut})


def _block_states(f: pd.DataFrame) -> pd.DataFrame:
    """The grammar state before each block of one conversation."""
    f, state, states = f.sort_values("block"), 0, []
    for exits in f["exits"]:
        states.append(state)
        state = int(exits[state])
    return pd.DataFrame({"block": f["block"], "state": states})


def _answers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    nodes = Suffixes()
    for f in frames:
        out = []
        for sig, ending, last, several in zip(f["sig"], f["ending"], f["last"], f["several"]):
            ending = tuple(int(c) for c in ending)
            nodes.read(sig, ending)
            for state in range(N if several else 1):
                cost, end, audit, fixes, tail = nodes.follow(state, last)
                out.append((sig, list(ending), last, state, cost - (0 if last else ending[end]), end, audit, fixes, tail))
        names = ["sig", "ending", "last", "state", "cost", "exit", "audit", "fixes", "tail"]
        yield pd.DataFrame(out, columns=names)


class Repaired(NamedTuple):
    """``conversations``: id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    ``turns``: id, place and part (their order), edit (K, R or I), role, text."""

    conversations: DataFrame
    turns: DataFrame


def _symbols(role: Column, text: Column, seen: Column) -> Column:
    """Of a turn: role s, u, a or o; upper case if truncated, a digit if it must go."""
    initial = F.substring(role, 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    body = F.rtrim(text, F.lit(BLANKS))
    blank = F.length(body) == 0
    cut = ~F.right(body, F.lit(1)).isin(".", "!", "?")
    return F.struct(
        F.when(blank | seen, F.translate(kind, "suao", "0123")).when(cut, F.upper(kind)).otherwise(kind).alias("symbol"),
        blank.alias("blank"), (~blank & seen).alias("duplicate"), (~blank & ~seen & cut).alias("truncated"),
    )


def repair_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    block: int | None = None,
) -> Repaired:
    """Faults, cheapest edits and repaired turns of every conversation; see the module."""
    spark = rows.sparkSession
    blank = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(" "))
    plain = rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), blank(role).alias("role"), blank(text).alias("text")
    ).withColumn("digest", F.sha2("text", 256))
    order = ["conv", F.asc_nulls_first("turn"), "role", "digest"]
    # the last key only deals out rows that agree in all the others
    turns = stored(
        plain.withColumn("deal", F.xxhash64(F.monotonically_increasing_id()))
        .repartitionByRange(*order, "deal").sortWithinPartitions(*order).drop("deal")
        .withColumn("uid", F.monotonically_increasing_id()), "repair-turns",
    )
    per_conv = turns.groupBy("conv").agg(
        F.count(F.lit(1)).alias("n"), F.min("turn").alias("low"), F.max("turn").alias("high"),
        F.count_distinct("turn").alias("turns"),
    )
    per_conv = stored(per_conv, "repair-conversations")
    if block is None:
        longest = per_conv.agg(F.max("n")).first()[0] or 1
        block = max(LEAST_BLOCK, 1 << math.ceil(math.log2(longest) / 2))

    first = turns.groupBy("conv", "role", "digest").agg(F.min("uid").alias("uid")).select("uid", F.lit(True).alias("first"))
    marks = turns.select("uid", "conv", "role", "text").join(first, "uid", "left").select(
        "uid", "conv", _symbols(F.col("role"), F.col("text"), F.col("first").isNull()).alias("mark")
    )
    chars = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("uid", "mark.symbol"))), lambda x: x["symbol"]), "")
    blocks = marks.groupBy("conv", F.floor(F.col("uid") / block).alias("chunk")).agg(
        F.min("uid").alias("block"), chars.alias("symbols"),
        *[F.sum(F.col(f"mark.{k}").cast("long")).alias(k) for k in ("blank", "duplicate", "truncated")],
    )
    roles = F.translate("symbols", "SUAO0123", "suaosuao")
    blocks = stored(
        blocks.select(
            "conv", "block", F.translate("symbols", "0123", "xxxx").alias("sig"), "blank", "duplicate", "truncated",
            (F.length(roles) - 1 - F.regexp_count(roles, F.lit("s(?=u)|u(?=a)|a(?=u)"))).cast("long").alias("illegal"),
            F.substring(roles, 1, 1).alias("first_role"), F.right(roles, F.lit(1)).alias("last_role"),
        ), "repair-blocks",
    )

    # conversations of several blocks: the costs after each block
    lone = blocks.groupBy("conv").agg(F.count(F.lit(1)).alias("blocks"), F.min("block").alias("block"))
    several = lone.where("blocks > 1").select(F.col("conv").alias("owner"))
    chained = blocks.join(several, F.col("conv").eqNullSafe(F.col("owner")), "left_semi")
    matrices = chained.select("sig").distinct().mapInPandas(_matrices, "sig string, matrix array<bigint>")
    ends = stored(
        chained.select("conv", "block", "sig", "first_role", "last_role").join(matrices, "sig").groupBy("conv")
        .applyInPandas(_block_ends, "block bigint, ending array<bigint>, last boolean, cut bigint"), "repair-ends",
    )
    cut = blocks.join(ends, "block", "left").select(
        *blocks.columns, F.coalesce("ending", F.array(*[F.lit(c).cast("long") for c in END])).alias("ending"),
        F.coalesce("last", F.lit(True)).alias("last"), F.coalesce("cut", F.lit(0)).alias("cut"),
        F.col("cut").isNotNull().alias("several"),
    )
    cut = stored(cut, "repair-cut")

    # every distinct signature once, sorted from its end
    backwards = [F.reverse("sig"), F.to_json("ending"), F.col("last")]
    asked = cut.groupBy("sig", "ending", "last").agg(F.max("several").alias("several"))
    answers = stored(
        asked.repartitionByRange(*backwards).sortWithinPartitions("ending", "last", backwards[0]).mapInPandas(
            _answers,
            "sig string, ending array<bigint>, last boolean, state int, cost bigint, exit int, audit string, "
            "fixes array<string>, tail string",
        ), "repair-answers",
    )
    exits = answers.groupBy("sig", "ending", "last").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("state", "exit"))), lambda x: x["exit"]).alias("exits")
    )
    states = (
        cut.where("several").join(exits, ["sig", "ending", "last"]).select("conv", "block", "exits")
        .groupBy("conv").applyInPandas(_block_states, "block bigint, state int")
    )
    done = cut.join(states, "block", "left").withColumn("state", F.coalesce("state", F.lit(0)))
    done = stored(done.join(answers, ["sig", "ending", "last", "state"]).drop("sig", "ending", "exit"), "repair-done")

    sums = done.groupBy("conv").agg(
        *[F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated")], F.sum(F.col("illegal") + F.col("cut")).alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    other = per_conv.select(F.col("conv").alias("owner"), F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps"))
    found = sums.join(other, F.col("conv").eqNullSafe(F.col("owner"))).select(
        F.col("conv").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )

    # each turn's fix; uids of a block follow each other
    fixes = done.select(
        "block", F.size("fixes").alias("size"), "tail", F.posexplode("fixes").alias("at", "fix")
    ).select(
        (F.col("block") + F.col("at")).alias("uid"), "fix",
        F.when(F.col("at") == F.col("size") - 1, F.col("tail")).otherwise(F.lit("")).alias("tail"),
    )
    act = F.right("fix", F.lit(1))
    name = lambda c: F.when(F.lower(c) == "u", F.lit("user")).otherwise(F.lit("assistant"))
    added = lambda c: F.transform(
        F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.struct(F.lit("I").alias("edit"), name(x).alias("role"), F.lit("").alias("text"))
    )
    own = F.array(F.struct(
        F.when(act == "K", F.lit("K")).otherwise(F.lit("R")).alias("edit"),
        F.when(act == "K", F.col("role")).otherwise(name(act)).alias("role"), F.col("text").alias("text"),
    ))
    before = F.expr("substring(fix, 1, length(fix) - 1)")
    lines = F.concat(added(before), F.when(act == "D", F.filter(own, lambda x: F.lit(False))).otherwise(own), added(F.col("tail")))
    repaired = turns.select("uid", "conv", "role", "text").join(fixes, "uid").select(
        F.col("conv").alias(conv), F.col("uid").alias("place"), F.posexplode(lines).alias("part", "line")
    ).select(conv, "place", "part", "line.edit", "line.role", "line.text")
    return Repaired(found, repaired)
