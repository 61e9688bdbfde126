import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from toxiscope.llm import queries, repair


def fits(roles):
    return re.fullmatch(r"(s?(ua)+)?", roles) is not None


def cheapest(turns):
    """(cost, audit, lines) by uniform-cost search over whole edit sequences; a turn is
    (role, text, must go, truncated)."""
    def prefix(r):
        return re.fullmatch(r"s?(ua)*u?", r) is not None

    heap, seen = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        if i == len(turns) and fits(roles):
            return cost, audit, list(lines)
        state = (i, "" if not roles else roles[-1])
        if seen.setdefault(state, cost) < cost:
            continue
        options = [("I", 3, i, r, n + ":") for r, n in (("u", "user"), ("a", "assistant"))]
        if i < len(turns):
            role, text, gone, cut = turns[i]
            options.append(("D", 4, i + 1, "", None))
            if not gone:
                options.append(("K", 3 * cut, i + 1, role[:1], f"{role}:{text}"))
                options += [("R", 3 + 3 * cut, i + 1, n[0], f"{n}:{text}") for n in ("user", "assistant")]
        for letter, price, j, r, line in options:
            if line is not None and (r not in ("s", "u", "a") or not prefix(roles + r)):
                continue
            heapq.heappush(heap, (cost + price, audit + letter, j, roles + r, lines + ((line,) if line is not None else ())))
    raise AssertionError


def brute(rows):
    """Rows (conv, turn, role, text), nulls as None → result rows of the query."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    found = []
    for conv, now in out.items():
        now.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        numbers = [t for t, _, _ in now if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        seen, turns, counts = set(), [], [0, 0, 0]
        for _, role, text in now:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            turns.append((role, text, fault in (0, 1), fault == 2))
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(now)]
        cost, audit, lines = cheapest(turns)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        found.append((conv, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest))
    return found


def random_rows(rng, convs, longest):
    texts = ["Fine.", "no end", "", " \t", "What?", "Go!  ", "Fine. ", None, "é…", "a:b\nc."]
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, longest)):
            if rng.random() < 0.1:
                continue
            role = rng.choices(["user", "assistant", "system", "tool", None, ""], [8, 8, 2, 1, 1, 1])[0]
            text = rng.choice(texts) if rng.random() < 0.6 else f"text {rng.random()}."
            rows.append((c if c else None, None if rng.random() < 0.03 else t, role, text))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block", [None, 4])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, block):
    rows = random_rows(random.Random(block or 3), 120, 14)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    if block:  # many blocks a conversation
        keep = repair.repair_conversations
        monkeypatch.setattr(repair, "repair_conversations", lambda r: keep(r, block=block))
    found = [tuple(r) for r in queries.op13_repair(spark, str(tmp_path)).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(found, key=key) == sorted(brute(rows), key=key)


def test_one_long_conversation_equals_its_single_block(spark):
    rng = random.Random(9)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), rng.choice(["A.", "b", ""]) + str(rng.choice(["", i]))) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    one, many = (repair.repair_conversations(df, block=b) for b in (1 << 20, 16))
    assert one.conversations.collect() == many.conversations.collect()
    lines = lambda t: [tuple(r)[3:] for r in t.orderBy("place", "part").collect()]
    assert lines(one.turns) == lines(many.turns)


def test_suffix_nodes_are_shared_and_fresh_ones_agree():
    rng = random.Random(2)
    sigs = sorted({"".join(rng.choice("suaoSUAOx") for _ in range(rng.randint(0, 9))) for _ in range(400)}, key=lambda s: s[::-1])
    shared = repair.Suffixes()
    for s in sigs:
        shared.read(s, repair.END)
        fresh = repair.Suffixes()
        fresh.read(s, repair.END)
        assert shared.follow(0, True) == fresh.follow(0, True)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    found = repair.repair_conversations(empty)
    assert found.conversations.count() == 0 and found.turns.count() == 0
    rows = spark.createDataFrame([(7, 1, "user", "Hi.", 1, 2, "x"), (7, 1, "user", "Hi.", 1, 2, "x")], SCHEMA + ", uid int, block int, sig string")
    r = repair.repair_conversations(rows).conversations.first()
    assert (r.duplicate, r.cost, r.audit) == (1, 7, "KDI")
