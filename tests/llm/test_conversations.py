import functools
import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from siltlake.llm.conversations import (SuffixGraph, best_audits, damaged, plan_repairs, repair_digest, repaired_rows)

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def word(x):
    return " " if x is None else str(x)


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20
        role, text = word(role), word(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def brute_repair(rows, faults):
    """(cost, audit, repaired rows) of the cheapest edits, least in ASCII, by trying every edit."""
    grammar, begun = re.compile("(s?(ua)+)?"), re.compile("s?(ua)*u?")

    def shorten(initials):  # what the grammar cannot tell apart
        return initials[:-2] if len(initials) > 3 and initials[-2:] == initials[-4:-2] else initials

    @functools.cache
    def best(i, initials, put_in):
        found = []
        if i == len(rows):
            if grammar.fullmatch(initials):
                found.append((0, "", ()))
        else:
            _, role, text = rows[i]
            extra = 3 if faults[i] == "truncated" else 0
            edits = [("D", 4, None, None)]
            if faults[i] not in ("blank", "duplicate"):
                edits += [("K", extra, role, text), *(("R", 3 + extra, r, text) for r in ("user", "assistant"))]
            for letter, cost, r, t in edits:
                then = initials if r is None else initials + (r[:1] or "?")
                if begun.fullmatch(then):
                    c, a, rest = best(i + 1, shorten(then), 0)
                    found.append((cost + c, letter + a, rest if r is None else ((r, t), *rest)))
        for r in ("user", "assistant"):
            if put_in < 3 and begun.fullmatch(initials + r[0]):
                c, a, rest = best(i, shorten(initials + r[0]), put_in + 1)
                found.append((3 + c, "I" + a, ((r, ""), *rest)))
        return min(found) if found else (10 ** 9, "", ())

    return best(0, "", 0)


def order(row):
    return (row[0] is not None, row[0] or 0)


def brute(rows, damage=True):
    left = defaultdict(list)
    for conv, turn, role, text in (brute_damage(rows) if damage else rows):
        left[conv].append((turn, word(role), word(text)))
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(left[conv], key=lambda r: (order(r), r[1]))
        faults = faults_of(own)
        turns = [t for t, _, _ in own if t is not None]
        cost, audit, repaired = brute_repair(own, faults)
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(own)]
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def digest(df):
    rows = df.collect()
    found = {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"]) for r in rows}
    assert len(found) == len(rows)
    return found


TEXTS = ["Yes.", "No!", "What?", "cut off", "  ", "", "Yes. ", "end.\n", "日本。", "a.b", None]


def random_rows(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 7)):
            rows.append((conv, turn if rng.random() < 0.95 else None, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None]), rng.choice(TEXTS) if rng.random() < 0.5 else f"text {rng.random()}."))
    return rows


def test_against_brute_force(spark):
    rows = random_rows(1)
    rng = random.Random(2)
    rng.shuffle(rows)
    # rows of one turn stand in an order of their own: keep them apart here
    rows = list({(r[0], r[1]): r for r in rows}.values()) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Hello."), (None, 3, "user", "Hi.")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert digest(repair_digest(df, damaged(df))) == brute(rows)


def test_all_short_signatures():
    """Each signature of up to four symbols against brute force, in sorted order with one shared graph."""
    symbols = {"s": ("system", "a."), "u": ("user", "b."), "a": ("assistant", "c."), "o": ("tool", "d."), "U": ("user", "e"), "A": ("assistant", "f"), "x": ("user", " ")}
    all_of = ["".join(p) for k in range(5) for p in itertools.product(symbols, repeat=k)]
    all_of.sort(key=lambda s: s[::-1])
    graph = SuffixGraph()
    for sig, (cost, audit) in zip(all_of, best_audits(iter(all_of), graph)):
        rows = [(i, symbols[c][0], symbols[c][1]) for i, c in enumerate(sig)]
        faults = ["blank" if c == "x" else "truncated" if c.isupper() else "" for c in sig]
        assert (cost, audit) == brute_repair(rows, faults)[:2], sig
    assert len(graph.costs) < 64  # nodes with equal futures are one


def test_graph_is_shared_across_signatures():
    class Counting(SuffixGraph):
        calls = 0

        def before(self, node, symbol):
            self.calls += 1
            return super().before(node, symbol)

    sigs = sorted({"".join(p) + "uaua" * 50 for p in itertools.product("sua", repeat=3)}, key=lambda s: s[::-1])
    graph = Counting()
    assert len(list(best_audits(iter(sigs), graph))) == 27
    assert graph.calls == 200 + 3 + 9 + 27  # one node for each distinct suffix


def test_repaired_rows_follow_the_grammar(spark):
    rows = random_rows(5, 60)
    df = spark.createDataFrame(rows, SCHEMA)
    plan = plan_repairs(df)
    by = defaultdict(list)
    for r in repaired_rows(df, plan).collect():
        by[r["conv_id"]].append((r["position"], r["role"], r["text"]))
    for conv in by:
        own = sorted(by[conv])
        assert [p for p, _, _ in own] == list(range(len(own)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for _, r, _ in own))


def test_long_conversation_over_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"text {i}." if i % 9 else "cut") for i in range(90)] + [(2, 0, "user", "Q?"), (2, 4, "assistant", "A.")]
        df = spark.createDataFrame(rows, SCHEMA)
        assert digest(repair_digest(df, df)) == brute(rows, damage=False)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_edge_rows(spark):
    extra = SCHEMA + ", audit string, sig string, _row long, cost long, _h string"
    rows = [(1, 1, "user", "same."), (1, 1, "user", "same."), (1, 1, "user", "same."), (1, 2, "assistant", "x" * 200_000 + "."), (2, None, None, None),
            (2, None, None, None), (None, None, None, None), (3, 5, "", "."), (4, 3, "user", "a."), (4, 3, "assistant", "b.")]
    df = spark.createDataFrame([(*r, "a", "b", 1, 2, "c") for r in rows], extra)
    found = digest(repair_digest(df, df))
    assert found == brute(rows, damage=False)
    assert found[1][2] == 2 and found[4][0] == 0
    empty = df.where("false")
    assert repair_digest(empty, empty).collect() == []
    none_left = digest(repair_digest(df, empty))
    assert set(none_left.values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())} and set(none_left) == set(found)


@pytest.mark.parametrize("text,blank,cut", [(" \t\r\n\x0b\x0c", 1, 0), (" ", 0, 1), ("a.\n\n", 0, 0), ("a. ", 0, 1), (".", 0, 0), ("a?\x1c", 0, 1)])
def test_white_space_is_ascii(spark, text, blank, cut):
    df = spark.createDataFrame([(1, 1, "user", text)], SCHEMA)
    row = plan_repairs(df).first()
    assert (row["blank"], row["truncated"]) == (blank, cut)
