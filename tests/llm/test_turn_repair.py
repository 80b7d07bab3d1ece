import hashlib
import itertools
import random
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from asklens.llm import turn_repair as t
from asklens.llm.queries import damaged, op12_conversation_repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
LEGAL = re.compile("(s?(ua)+)?")


def repairs(rows, costs):
    """Every repair of a few rows (role, text, fault) with up to two insertions in a place: (cost, audit, repaired)."""
    roles = ["", "u", "a", "ua", "au", "uu", "aa"]
    choices = []
    for role, text, fault in rows:
        own = [(costs.delete, "D", [])]
        if fault not in ("blank", "duplicate"):
            extra = costs.truncated * (fault == "truncated")
            own += [(extra, "K", [(role, text)]), (extra + costs.rerole, "R", [("user", text)]), (extra + costs.rerole, "R", [("assistant", text)])]
        choices.append([(c + costs.insert * len(g), "I" * len(g) + e, [("user" if x == "u" else "assistant", "") for x in g] + out)
                        for g in roles for c, e, out in own])
    choices.append([(costs.insert * len(g), "I" * len(g), [("user" if x == "u" else "assistant", "") for x in g]) for g in roles])
    for way in itertools.product(*choices):
        turns = [turn for _, _, out in way for turn in out]
        if LEGAL.fullmatch("".join(role[:1] if role[:1] in ("s", "u", "a") else "?" for role, _ in turns)):
            yield sum(c for c, _, _ in way), "".join(e for _, e, _ in way), turns


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        fault = t.plain_fault(text)
        if fault != "blank" and (role, text) in seen:
            fault = "duplicate"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


@pytest.mark.parametrize("costs", [t.Costs(), t.Costs(insert=1), t.Costs(rerole=3, delete=3, insert=1, truncated=1), t.Costs(2, 2, 2, 0)])
def test_cheapest_repair_against_all_repairs(costs):
    rng = random.Random(5)
    texts = ["Fine.", "Good!", "cut off", " \n", "", "Really? ", "x"]
    for _ in range(60):
        rows = [(rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", " "]), rng.choice(texts))
                for _ in range(rng.randrange(0, 4))]
        marked = faults(rows)
        want = min((c, a, o) for c, a, o in repairs(marked, costs))
        out = list(t._streamed(iter([(1, i, r, x) for i, (r, x) in enumerate(rows)]), costs)) if rows else []
        audit = "".join(r[4] for r in out)
        kept = [(r[6], r[7]) for r in out if r[4] != "D"]
        price = sum({"K": 0, "R": costs.rerole, "D": costs.delete, "I": costs.insert}[r[4]] + costs.truncated * (r[8] == "truncated" and r[4] != "D") for r in out)
        assert (price, audit) == want[:2] and kept == want[2], rows


def report(conv, rows, costs=t.Costs()):
    """One conversation by dynamic programming over whole strings, rows (turn, role, text) in order."""
    marked = faults([(r, x) for _, r, x in rows])
    best = {t.NOTHING: (0, "", [])}
    for role, text, fault in marked:
        new = {}
        for before, after, cost, word in t.ways(costs, role[:1], fault):
            if before in best:
                c, a, o = best[before]
                added, state = t.inserted(before, word)
                keep = [] if word[-1] == "D" else [(role if word[-1] == "K" else t.ROLE_OF[after]) + ":" + text]
                way = (c + cost, a + word, o + [r + ":" for r in added] + keep)
                if after not in new or way[:2] < new[after][:2]:
                    new[after] = way
        best = new
    cost, audit, out = min((best[s][0] + c, best[s][1] + w, best[s][2] + [r + ":" for r in t.inserted(s, w)[0]])
                           for s, c, w in t.endings(costs) if s in best)
    turns = [n for n, _, _ in rows if n is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    kinds = [f for _, _, f in marked]
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds.count("blank"), kinds.count("duplicate"),
            kinds.count("truncated"), sum(p not in t.LEGAL_PAIRS for p in pairs), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def in_order(rows):
    def key(r):
        hashed = xxhash.xxh64(r[2].encode(), seed=42).intdigest()
        return (r[0] is not None, r[0] or 0, r[1], hashed - (1 << 64) * (hashed >> 63), r[2])
    return sorted(rows, key=key)


def expected(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn, " " if role is None else role, " " if text is None else text))
    return sorted((report(c, in_order(v)) for c, v in convs.items()), key=str)


def odd_rows():
    rng = random.Random(12)
    rows = []
    for c in [*range(30), None]:
        for turn in range(rng.choice([1, 2, 3, 5, 40, 90])):
            rows.append((c, rng.choice([turn, turn, turn, None, 3]), rng.choice(["user", "assistant", "system", "User", "tool", "", None]),
                         rng.choice([f"Text {turn}.", f"Text {turn}.", "Same.", "cut off", "", " \x0b", None, "nb ", "end?\n"])))
    rows += [(40, i, "user" if i % 2 else "assistant", f"t{i}." if rng.random() < 0.8 else "t") for i in range(1500)]  # a third of all
    rows += [(41, 7, "user", "Same row.")] * 600
    rows += [(42, 0, "user", "long " * 50_000 + "end."), (42, 1, "assistant", "x" * 200_000)]
    return rows


@pytest.mark.parametrize("long_rows", [7, 64, 256, 10**6])
def test_odd_conversations_on_both_paths(spark, long_rows):
    clash = ["key", "pos", "one", "content", "word", "state", "block", "n"]
    df = spark.createDataFrame(odd_rows(), SCHEMA).select("*", *[F.lit("x").alias(c) for c in clash]).repartition(4)
    done = t.conversation_report(df, long_rows=long_rows)
    assert done.columns == t.REPORT
    assert sorted((tuple(r) for r in done.collect()), key=str) == expected(odd_rows())


def test_repaired_turns_are_legal_and_whole(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    for long_rows in (16, 10**6):
        convs = defaultdict(list)
        for r in t.repair_turns(df, long_rows=long_rows).collect():
            convs[r["conv_id"]].append(r)
        for rows in convs.values():
            rows.sort(key=lambda r: (r["pos"], r["place"]))
            assert LEGAL.fullmatch("".join(r["role"][0] for r in rows if r["edit"] != "D"))
        assert sum(r["edit"] != "I" for rows in convs.values() for r in rows) == len(odd_rows())


def test_query_against_whole_strings(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in damaged(turns.select("conv_id", "turn", "role", "text")).collect()]
    want = {r[0]: r for r in expected(rows)}
    got = op12_conversation_repair(spark, SF)
    assert got.columns == t.REPORT
    out = got.collect()
    assert len(out) == turns.select("conv_id").distinct().count()
    for r in out:
        assert tuple(r) == want.get(r["conv_id"], (r["conv_id"], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))


def test_edits_are_final_soon_and_the_tree_stays_small():
    table, survivors, most = t.Ways(t.Costs()), t.Survivors(t.NOTHING, t.behind(t.Costs())), 0
    rng, out, given, unresolved = random.Random(1), 0, 0, 0

    def size(node):
        todo, n = [node], 0
        while todo:
            n += 1
            todo += todo.pop().children
        return n

    for i in range(20_000):
        symbol = (rng.choice("uuaas?"), rng.choice([None, None, None, "truncated", "blank"]))
        out += len(survivors.step(table[symbol]))
        given += 1
        most, unresolved = max(most, size(survivors.root)), max(unresolved, given - out)
    assert unresolved < 100 and most < 200
    _, rest, _ = survivors.finish(t.endings(t.Costs()))
    assert out + len(rest) == given


def test_damage(spark):
    import zlib

    rows = [(c, n, "assistant", "One. Two! Three? ok") for c in range(40) for n in (0, None, 2)] + [(None, 1, None, None)]
    got = defaultdict(list)
    for r in damaged(spark.createDataFrame(rows, SCHEMA)).collect():
        got[r["conv_id"], r["turn"]].append((r["role"], r["text"]))
    kinds = set()
    for c, n, role, text in rows:
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if n is None else n}".encode()) % 20
        kinds.add(hit)
        role, text = role or " ", text or " "
        want = {0: [], 1: [(role, "")], 2: [(role, re.sub("[.!?]", "", text))], 3: [(role, text)] * 2, 4: [("user", text)]}.get(hit, [(role, text)])
        assert got[c, n] == want
    assert {0, 1, 2, 3, 4} <= kinds


def test_empty_table(spark):
    assert t.conversation_report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert t.repair_turns(spark.createDataFrame([], SCHEMA)).collect() == []
