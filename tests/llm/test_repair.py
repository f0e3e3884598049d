import hashlib
import random
import zlib
from collections import defaultdict

from marquee.llm import queries, repair
from tests.compare import compare

SF = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def cheapest(rows):
    """Row by row, all states: the least (cost, audit, repaired) by plain dynamic programming."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def put(best, q, value):
        if q not in best or value < best[q]:
            best[q] = value

    def inserts(best):
        for _ in range(3):
            for q, (c, a, r) in list(best.items()):
                for x in after[q]:
                    if x in names:
                        put(best, x, (c + 3, a + "I", (*r, names[x] + ":")))
        return best

    best = inserts({"": (0, "", ())})
    for role, text, fault in rows:
        new = {}
        for q, (c, a, r) in best.items():
            put(new, q, (c + 4, a + "D", r))
            if fault in ("", "truncated"):
                extra = 3 * (fault == "truncated")
                if role[:1] and role[:1] in after[q]:
                    put(new, role[:1], (c + extra, a + "K", (*r, role + ":" + text)))
                for x in after[q]:
                    if x in names:
                        put(new, x, (c + 3 + extra, a + "R", (*r, names[x] + ":" + text)))
        best = inserts(new)
    return min(best[q] for q in ("", "a") if q in best)


def brute(rows):
    """rows of (conv, turn, role, text)"""
    groups = defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append((t, " " if r is None else r, " " if x is None else x))
    out = {}
    for c, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        seen, faults = set(), []
        for _, role, text in own:
            core = text.rstrip(WHITE)
            faults.append("blank" if not core else "duplicate" if (role, text) in seen else
                          "" if core[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        cost, audit, left = cheapest([(r, x, f) for (_, r, x), f in zip(own, faults, strict=True)])
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                  *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                  sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False)),
                  cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest())
    return out


def found(df):
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"],
                           r["repaired_sha256"]) for r in df.collect()}


def drawn(rng, convs, longest, hot=0):
    rows = []
    for c in range(convs):
        n = hot if c == 7 and hot else rng.randrange(1, longest)
        turns = sorted(rng.sample(range(3 * n), n)) if rng.random() < 0.8 else [None] + list(range(n - 1))
        for k, t in enumerate(turns):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("assistant" if k % 2 else "user")
            if rng.random() < 0.1:
                role = rng.choice(["system", "tool", "", None, "umpire"])
            text = rng.choice([f"text {c} {k}.", f"text {c} {k}.", f"cut {k}", "same.", "", " \t", None, "end?\n", "x!\u0085"])
            rows += [(c, t, role, text)] * (2 if rng.random() < 0.1 else 1)
    return rows


def test_as_brute_force_with_a_hot_conversation(spark, monkeypatch):
    """It holds more than a third of all rows, more than a block, and lies in several tasks."""
    rng = random.Random(3)
    rows = drawn(rng, 120, 10, 700)
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    made = []
    parts = repair._parts
    monkeypatch.setattr(repair, "_parts", lambda faulty: made.append(parts(faulty)) or made[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(repair.repair(docs)) == brute(rows)
        assert made[0].filter("conv = 7").count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_search_as_brute_force(monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(repair, "BLOCK", 4)
    for n in [*range(9)] * 60 + [30, 60]:
        rows = [(rng.choice(["system", "user", "assistant", "x", ""]), "t", rng.choice(["", "", "blank", "truncated"])) for _ in range(n)]
        got = repair.whole([repair.row_edges(r[:1], f) for r, _, f in rows])
        assert got == cheapest(rows)[:2]


def test_parts_join_to_the_whole():
    rng = random.Random(6)
    for _ in range(40):
        rows = [(rng.choice("suax"), rng.choice(["", "", "blank", "truncated"]), rng.choice([1, 1, 3])) for _ in range(12)]
        layers = [repair.row_edges(*r) for r in rows]
        cut = rng.randrange(13)
        parts = [repair.table_of(layers[:cut]), repair.table_of(layers[cut:])]
        assert repair.search(parts, repair.START, repair.GOALS) == repair.search(layers, repair.START, repair.GOALS)


def test_query_as_sql(spark):
    ok, message = compare(queries.op11_conversation_repair(spark, SF), queries.ORACLE["op11_conversation_repair"], SF)
    assert ok, message


def test_query_with_nulls_and_lost_conversations(spark, scratch):
    rng = random.Random(9)
    rows = drawn(rng, 60, 6) + [(None, t, "user", f"text {t}.") for t in range(6)]
    lost = [c for c in range(1000, 1200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows += [(c, 0, "user", "gone.") for c in lost]
    spark.createDataFrame(rows, SCHEMA).write.parquet(scratch + "/sf/conversations.parquet")
    after = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if code == 1:
            x = ""
        elif code == 2:
            x = "".join(ch for ch in x if ch not in ".!?")
        elif code == 4:
            r = "user"
        after += [(c, t, r, x)] * (0 if code == 0 else 2 if code == 3 else 1)
    want = brute(after)
    for c, *_ in rows:
        want.setdefault(c, (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))
    assert len(lost) > 2 and found(queries.op11_conversation_repair(spark, scratch + "/sf")) == want


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair(empty).count() == 0
    clash = spark.createDataFrame([(1, 0, "user", "long " * 100_000 + "end.", 5, "x"), (1, 1, "assistant", "é.", 6, "y")],
                                  SCHEMA + ", number int, audit string")
    assert found(repair.repair(clash)) == brute([(1, 0, "user", "long " * 100_000 + "end."), (1, 1, "assistant", "é.")])
    other = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, None, None)], "id bigint, n bigint, who string, what string")
    assert found(repair.repair(other, "id", "n", "who", "what")) == brute([(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, None, None)])
