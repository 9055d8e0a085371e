import hashlib
import re

from tallyframe.llm import secret_scan as S
from tallyframe.llm.queries import op10_secret_scan


def base(text):
    """The strong kinds by scanning from every place."""
    out = []
    for kind, pattern, good in (("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
                                ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24)):
        at, compiled = 0, re.compile(pattern)
        while m := compiled.search(text, at):
            at = m.end()
            if good(m):
                out.append((m.start(), S.KINDS.index(kind), m.end()))
    return sorted(out)


def test_every_document(spark, data):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    found = op10_secret_scan(spark, data).collect()
    assert len(found) == len(texts) and sum(r["n_assign"] + r["n_access"] + r["n_hex"] for r in found) > 0
    for r in found:
        spans = base(texts[r["doc_id"]])
        said = ",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in spans) for i in range(3)]
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert set(said.split(",")) - {""} <= set(r["spans"].split(","))


WEAK = "wJalrXUtnFEMIK7MDENGbPxRfiCYzzzz09abQ"
TEXTS = {1: None, 2: "", 3: "é password: 'abcdefg' token=abc secret=token=abcdef PASSWD=x:abcdef", 4: "AKIAAKIA AKIA" + "A" * 16 + " AKIA" + "B" * 15, 5: "0" * 23 + " " + "a1" * 12, 6: "api_key=abcdef " * 30_000,
         7: "toKen=abcdef ſecret=abcdef", 8: "password=token:abcdefg"}


def test_odd_texts(spark):
    rows = spark.createDataFrame(list(TEXTS.items()) + [(3, TEXTS[3])], "doc_id long, text string").selectExpr("*", "1 as spans", "2 as n_hex2")
    for r in S.secret_scan(rows).collect():
        spans = base(TEXTS[r["doc_id"]] or "")
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in spans) for i in range(3)]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
    assert S.secret_scan(rows.limit(0)).count() == 0


def test_weak_parts_need_a_complement(spark):
    near, far, split = f"client_id = app7 key {WEAK}", f"client_id = app7 {'x ' * 300} {WEAK}", f"client_id = app7\n\n{WEAK}"
    texts = {1: WEAK, 2: near, 3: far, 4: split, 5: "client_id = app7", 6: "see https://example.com/x", 7: f"https://example.com/x {WEAK}", 8: f"AKIA{'A' * 16} {WEAK}", 9: f"client_id = app7 {WEAK} https://example.com/x"}
    found = {r["doc_id"]: [x.split(":")[0] for x in r["spans"].split(",") if x] for r in S.secret_scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert found == {1: [], 2: ["identifier", "secret"], 3: [], 4: [], 5: [], 6: [], 7: ["endpoint", "secret"], 8: ["access", "secret"], 9: ["identifier", "secret", "endpoint"]}


def test_long_weak_parts_are_seen_whole(spark):
    name, key, place = "client_id = " + "z" * 300, "aB3" * 500, "https://" + "x" * 9000
    texts = {1: f"{name} {key}", 2: f"{place} {key}", 3: f"{name} {'aB3_' * 500_000}====", 4: "aB3" * 1_000_000}
    found = {r["doc_id"]: r["spans"] for r in S.secret_scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert found == {1: f"identifier:0:{len(name)},secret:{len(name) + 1}:{len(texts[1])}", 2: f"endpoint:0:{len(place)},secret:{len(place) + 1}:{len(texts[2])}", 3: "", 4: ""}


def test_linking_matches_all_pairs():
    import random
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("xxxxx\n\n") for _ in range(120))
        parts = {(rng.choice(S.KINDS), (s := rng.randrange(110)), s + rng.randrange(1, 8)) for _ in range(rng.randrange(12))}
        strong, weak = [p for p in parts if p[0] not in S.COMPLEMENTS], [p for p in parts if p[0] in S.COMPLEMENTS]
        broken = lambda low, high: any(low <= m.start() < high for m in S.BLANK_LINE.finditer(text))

        def near(p, q):
            (_, a, b), (_, c, d) = sorted((p, q), key=lambda x: (x[1], x[2], x[0]))
            return c - b <= 20 and not broken(b, c)

        linked = set(S.linked(text, strong, weak, 20))
        pairs = {p for p in weak if any(q != p and q[0] in S.COMPLEMENTS[p[0]] and near(p, q) for q in parts)}
        assert linked <= pairs
        assert not {p for p in pairs - linked if len({q[1:] for q in parts}) == len(parts) and all(not (a[1] <= b[1] and b[2] <= a[2]) for a in parts for b in parts if a != b)}
