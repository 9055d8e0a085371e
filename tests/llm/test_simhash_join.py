import random
import re

import numpy as np
import pytest
import xxhash

from tallyframe.llm import simhash_join as S
from tallyframe.llm.queries import op11_simhash_join


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def components_of(fps, distance=2):
    """The component of every fingerprint, by comparing all pairs."""
    fps = sorted(set(fps))
    x, root = np.array(fps, np.uint64), list(range(len(fps)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(x[i + 1:] ^ x[i]) <= distance) + i + 1:
            root[top(int(j))] = top(i)
    return {f: top(i) for i, f in enumerate(fps)}


def brute(rows, fingerprint=plain_fingerprint):
    fp = [fingerprint(t) for _, t in rows]
    part = components_of(fp)
    least = {}
    for (doc_id, _), f in zip(rows, fp):
        if doc_id is not None:
            least[part[f]] = min(least.get(part[f], doc_id), doc_id)
    return sorted(((doc_id, f"{f:016x}", least.get(part[f])) for (doc_id, _), f in zip(rows, fp)), key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_every_document(spark, data):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    wanted = brute(rows)
    assert found(op11_simhash_join(spark, data)) == wanted
    assert len({c for _, _, c in wanted}) < len(rows)


def test_nulls_short_texts_copies_and_other_columns(spark):
    rows = [(None, "one two"), (4, "ONE  two"), (4, "one two"), (9, None), (7, " \n"), (8, ""), (None, "x"), (3, "É b c d"), (2, "é b c d"), (1, "a b c " * 4000), (5, "w" * 70_000 + " v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as value", "'x' as least_id")
    assert found(S.simhash_join(docs)) == brute(rows)
    assert S.simhash_join(docs.limit(0)).count() == 0


@pytest.mark.parametrize("small", [64, 3])
@pytest.mark.parametrize(("distance", "parts"), [(2, (2, 3, 4)), (2, (1,)), (1, (3,)), (3, (2, 3)), (0, (2,))])
def test_links_of_clustered_fingerprints(spark, monkeypatch, small, distance, parts):
    monkeypatch.setattr(S, "SMALL_BUCKET", small)
    rng = random.Random(distance)
    fps = {rng.getrandbits(64) & ~0xFF00 for _ in range(60)}
    for centre in list(fps)[:8]:
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))) for _ in range(60)}
    fps |= {rng.getrandbits(20) for _ in range(100)}
    signed = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    links = [(int(np.int64(a).astype(np.uint64)), int(np.int64(b).astype(np.uint64))) for a, b in S.near_links(signed, distance, parts).collect()]
    assert all((a ^ b).bit_count() <= distance for a, b in links)
    root = {f: f for f in fps}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in links:
        root[top(a)] = top(b)
    wanted = components_of(fps, distance)
    assert len({(top(f), wanted[f]) for f in fps}) == len({top(f) for f in fps}) == len(set(wanted.values()))


def test_thresholds_are_the_cheapest_and_add_up(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 63, 500, dtype=np.uint64) & np.uint64(0xFFFF0000FFFFFFFF)
    fps = spark.createDataFrame([(int(v),) for v in x], "fp long")
    plan = S.best_plan(fps, 2, (4,))
    bits = S.bits_of(x)
    allowed, cost = plan.allocated(bits)
    assert ((allowed + 1).sum(axis=0) == 3).all() and (allowed >= -1).all()
    costs = plan.costs(bits)
    every = [sum(costs[i, u] for i, u in enumerate(us)) for us in np.ndindex(4, 4, 4, 4) if sum(us) == 3]
    assert np.allclose(cost, np.min(every, axis=0))
    assert sorted(b for g in plan.groups for b in g) == list(range(64))
    still = set(range(32, 48))
    assert any(set(g) == still for g in plan.groups) and len(set(map(tuple, allowed.T))) >= 1
    assert (allowed[[set(g) == still for g in plan.groups]] == -1).all()


def test_numbers_at_a_distance():
    count = np.array([5.0, 0, 2, 1, 0, 0, 0, 7])
    for d, row in enumerate(S.at_distance(count, 2)):
        assert row.tolist() == [sum(count[w] for w in range(8) if (v ^ w).bit_count() == d) for v in range(8)]


def test_long_text_in_pieces():
    text = " ".join(f"w{i % 977}" for i in range(600_000))
    assert sum(1 for _ in S.pieces(text.encode())) > 2
    assert S.simhash(text.encode()) == plain_fingerprint(text)
    assert [S.simhash(t.encode()) for t in ("", "a", "a b")] == [plain_fingerprint(t) for t in ("", "a", "a b")]
