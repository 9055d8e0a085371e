import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tallyframe.llm import conversation_repair as C
from tallyframe.llm.queries import op13_conversation_repair

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def plain_damage(rows):
    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        rule = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if rule == 1 else re.sub("[.!?]", "", text) if rule == 2 else text
        out[conv_id] += [(turn, "user" if rule == 4 else role, text)] * {0: 0, 3: 2}.get(rule, 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest())) for c, r in out.items()}


def step(state, letter):
    return {"0s": "1", "0u": "2", "1u": "2", "2a": "3", "3u": "2"}.get(state + letter)


def plain_repair(rows, faults):
    """The least (cost, audit) by going through all states, row by row, with whole audits in hand."""
    name = {"u": "user", "a": "assistant"}
    best = {"0": (0, "", ())}

    def put(into, state, entry):
        if state not in into or entry[:2] < into[state][:2]:
            into[state] = entry

    def with_inserts(states):
        for _ in range(4):
            for s, (cost, audit, kept) in list(states.items()):
                for letter in "ua":
                    if to := step(s, letter):
                        put(states, to, (cost + 3, audit + "I", (*kept, name[letter] + ":")))
        return states

    for (_, role, text), fault in zip(rows, faults):
        then = {}
        for s, (cost, audit, kept) in with_inserts(best).items():
            put(then, s, (cost + 4, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            if role and (to := step(s, role[0])):
                put(then, to, (cost + more, audit + "K", (*kept, f"{role}:{text}")))
            for letter in "ua":
                if to := step(s, letter):
                    put(then, to, (cost + 3 + more, audit + "R", (*kept, f"{name[letter]}:{text}")))
        best = then
    states = with_inserts(best)
    return min(states[s] for s in "03" if s in states)


def brute(rows):
    out = []
    for conv_id, kept in plain_damage(rows).items():
        seen, faults = set(), []
        for _, role, text in kept:
            core = text.strip(" \t\n\v\f\r")
            faults.append("blank" if not core else "duplicate" if (role, text) in seen else "" if core[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = {t for t, _, _ in kept if t is not None}
        counts = Counter(faults)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(kept))
        cost, audit, said = plain_repair(kept, faults)
        out.append((conv_id, max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def test_every_conversation(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    wanted = brute(rows)
    assert found(op13_conversation_repair(spark, data)) == wanted
    assert any("I" in r[7] for r in wanted) and any("R" in r[7] for r in wanted) and any("D" in r[7] for r in wanted)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_random_conversations(spark):
    rng = random.Random(4)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "Ärzte", "uncle"], ["Yes.", "No", " ", "", None, "Why? ", "a\n", "…", "b.\t", "\x0bz"]
    rows = [(rng.choice((None, *range(60))), rng.choice((None, *range(12))), rng.choice(roles[:3] * 3 + roles), rng.choice(texts)) for _ in range(600)]
    rows += rows[:40]
    docs = frame(spark, rows).selectExpr("*", "1 as copies", "2 as digest", "'x' as audit").repartition(5)
    assert found(C.conversation_repair(docs)) == brute(rows)


def test_one_conversation_with_most_rows_and_very_long_texts(spark):
    rng = random.Random(6)
    rows = [(7, t, rng.choice(("user", "assistant")), "same." if t % 3 else f"{t}") for t in range(1500)] + [(7, 5, "user", "x" * 300_000 + "!")] + [(8, 1, "user", "Hi.")] * 700
    rows += [(9, t, "assistant", f"{t}.") for t in range(900)]
    assert found(C.conversation_repair(frame(spark, rows))) == brute(rows)


def test_empty_table_and_conversations_without_rows(spark):
    dropped = next((c, t) for c in range(100) for t in range(100) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    assert C.conversation_repair(frame(spark, []).limit(0)).count() == 0
    assert found(C.conversation_repair(frame(spark, [(*dropped, "user", "Hi.")]))) == [(dropped[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("seed", range(4))
def test_runs_give_what_single_rows_give(seed):
    rng = random.Random(seed)
    symbols = [rng.randrange(12) for _ in range(12)]
    runs = [(s, rng.choice((1, 2, 63, 64, 65, 200))) for s in symbols]
    rows = [(None, {0: "s", 1: "u", 2: "a"}.get(s // 3, "x"), f"{i}") for i, s in enumerate(s for s, n in runs for _ in range(n))]
    faults = [("", "truncated", "blank")[s % 3] for s, n in runs for _ in range(n)]
    assert C.repaired(runs) == plain_repair(rows, faults)[:2]
