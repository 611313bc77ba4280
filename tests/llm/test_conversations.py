import hashlib
import heapq
import random
import zlib

from pyspark.sql import functions as F

from indicata.llm import conversations as c

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, key string, present string, fault string"


def brute(rows, insert=5):
    """Summary of one conversation's rows (turn, role, text): all lists of edits, cheapest and least first."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    faults, seen = [], set()
    for _, r, x in rows:
        bare = x.rstrip(SPACE)
        faults.append("b" if not bare else "d" if (r, x) in seen else "" if bare[-1] in ".!?" else "t")
        seen.add((r, x))
    legal = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, at, last, out = heapq.heappop(heap)
        if at == len(rows) and last in ("", "a"):
            break
        if (at, last) in done:   # the first to come is the cheapest and, of these, the least
            continue
        done.add((at, last))
        for role in ("user", "assistant"):
            if role[0] in legal[last]:
                heapq.heappush(heap, (cost + insert, audit + "I", at, role[0], (*out, f"{role}:")))
        if at < len(rows):
            _, r, x = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, last, out))
            if faults[at] in ("", "t"):
                more = cost + 5 * (faults[at] == "t")
                if r[:1] in legal[last]:
                    heapq.heappush(heap, (more, audit + "K", at + 1, r[0], (*out, f"{r}:{x}")))
                for role in ("user", "assistant"):
                    if role[0] in legal[last]:
                        heapq.heappush(heap, (more + 1, audit + "R", at + 1, role[0], (*out, f"{role}:{x}")))
    turns = [t for t, _, _ in rows if t is not None]
    pairs = zip(rows, rows[1:])
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"),
            faults.count("t"), sum(p[1][:1] + q[1][:1] not in ("su", "ua", "au") for p, q in pairs), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest()), list(out)


def damage(rows):
    out = {}
    for key, turn, role, text in rows:
        own = out.setdefault(key, [])
        name = f"{' ' if key is None else key}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(name.encode()) % 20
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        own.extend([(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    return out


def table(spark, rows):
    return spark.createDataFrame([(*x, "k", "p", "f") for x in rows], SCHEMA)


def corpus():
    r = random.Random(12)
    rows = []
    for key in [*range(400), None]:
        for turn in range(r.randint(1, 9)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ux"])
            text = r.choice(["Yes.", "no", "Why?", "fine! \n", " ", "", None, "cut off", "Yes.", f"T{turn}."])
            rows.append((key, r.choice([turn, turn, turn, None, 3, turn + 2, 1 << 60]), role, text))
    rows += [(500 + i, j, "ua"[j % 2] + "x", "Good.") for i in range(40) for j in range(6)]
    rows += rows[:50]
    return rows


def test_damaged_conversations_equal_brute_force(spark):
    rows = corpus()
    want = {k: brute(v)[0] for k, v in damage(rows).items()}
    df = c.damaged(table(spark, rows).repartition(7))
    got = {x[0]: tuple(x[1:]) for x in c.summarise(df, key="key", present=F.col("present")).collect()}
    assert got == want
    assert any(v[6] == "" for v in want.values())          # all rows dropped
    assert {x for v in want.values() for x in v[6]} == set("DKR")   # at these costs no insertion is worth it


def test_insertions_where_they_are_cheap(monkeypatch):
    monkeypatch.setattr(c, "INSERT", 1)
    r, seen = random.Random(5), set()
    for _ in range(300):
        rows = [(i, r.choice("usaaut") + "x", f"{i}.") for i in range(r.randint(0, 9))]
        one = c._Conversation("k", c.Steps())
        for x in rows:
            one.add(x[0], True, x[1], x[2], c.FINE)
        assert one.summary()[1:] == brute(rows, 1)[0]
        seen |= set(one.summary()[7])
    assert seen == set("DIKR")


def test_rows_of_the_repair(spark):
    rows = corpus()
    own = {}
    for key, *row in rows:
        own.setdefault(key, []).append(tuple(row))
    want = {k: brute(v)[1] for k, v in own.items()}
    got = {}
    for x in sorted(c.repair(table(spark, rows)).collect(), key=lambda x: (x.conv_id is not None, x.conv_id, x.seq)):
        assert x.seq == len(got.setdefault(x.conv_id, []))
        got[x.conv_id].append(f"{x.role}:{x.text}")
    assert got == {k: v for k, v in want.items() if v}


def test_one_giant_conversation_spills_and_spans_batches(spark, monkeypatch):
    r = random.Random(3)
    rows = [(r.choice("usaat") + "x", r.choice(["A.", "b", " ", "long text " * 20 + "!"]) + f" {i}.") for i in
            range(3000)]
    monkeypatch.setattr(c, "IN_MEMORY", 100)
    monkeypatch.setattr(c, "SPILL_BYTES", 5000)
    one = c._Conversation("k", c.Steps())
    for i, (role, text) in enumerate(rows):
        one.add(i, True, role, text, c.FINE)
    assert one.pointers.file and one.rows.file
    monkeypatch.undo()
    two = c._Conversation("k", c.Steps())
    for i, (role, text) in enumerate(rows):
        two.add(i, True, role, text, c.FINE)
    assert one.summary() == two.summary()
    df = table(spark, [(1, i, *x) for i, x in enumerate(rows)] + [(2, 0, "user", "Hi.")])
    got = {x[0]: tuple(x[1:]) for x in c.summarise(df).collect()}
    assert got[1] == two.summary()[1:] and got[1][6].count("K") > 500
    few = [(i, *x) for i, x in enumerate(rows[:60])]
    one = c._Conversation("k", c.Steps())
    for x in few:
        one.add(x[0], True, x[1], x[2], c.FINE)
    assert one.summary()[1:] == brute(few)[0]


def test_nothing_and_only_nulls(spark):
    assert c.summarise(table(spark, [])).collect() == []
    assert c.repair(table(spark, [])).collect() == []
    got = c.summarise(table(spark, [(None, None, None, None)] * 2)).collect()
    assert [tuple(x) for x in got] == [(None, *brute([(None, None, None)] * 2)[0])]


def test_one_shuffle(spark, sf_small):
    rows = c.damaged(spark.read.parquet(f"{sf_small}/conversations.parquet"))
    plan = c.summarise(rows, key="key", present=F.col("present"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1, plan
