import heapq
import random
from hashlib import sha256

from pyspark.sql import functions as F

from lodestar.llm import conversations as C

ROWS = "conv_id long, turn long, role string, text string, conv string, part string, pos string, seg string, audit string"


def table(spark, rows):
    return spark.createDataFrame([(*r, *["own"] * 5) for r in rows], ROWS)


def uniform_cost(initials, kinds, start, ends, most=1 << 20):
    """The least (cost, edits), by a search in order of cost and edits."""
    heap, seen = [(0, "", 0, start)], set()
    while heap:
        cost, edits, i, state = heapq.heappop(heap)
        if i == len(kinds) and state in ends:
            return cost, edits
        if (i, state) in seen or cost > most:
            continue
        seen.add((i, state))
        after = "a" if state == C.USER else "u"
        target = C.ASSISTANT if state == C.USER else C.USER
        moves = [("I", 3, i, target)]
        if i < len(kinds):
            moves.append(("D", 4, i + 1, state))
            if kinds[i] != C.DEAD:
                extra = 3 if kinds[i] == C.TRUNCATED else 0
                moves.append(("R", 3 + extra, i + 1, target))
                if initials[i] == after:
                    moves.append(("K", extra, i + 1, target))
                if initials[i] == "s" and state == C.START:
                    moves.append(("K", extra, i + 1, C.SYSTEM))
        for edit, more, j, t in moves:
            heapq.heappush(heap, (cost + more, edits + edit, j, t))
    return None


def reference(rows):
    """Plain Python over damaged (turn, role, text) rows in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen
                      else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    kinds = [C.DEAD if f in ("blank", "duplicate") else C.TRUNCATED if f else C.SOUND for f in faults]
    cost, audit = uniform_cost(initials, kinds, C.START, (C.START, C.ASSISTANT))
    out, state, i = [], C.START, 0
    for e in audit:
        role, text = ("", "") if e == "I" else rows[i][1:]
        i += e != "I"
        if e == "K":
            out.append(f"{role}:{text}")
            state = C.SYSTEM if role[0] == "s" else C.USER if role[0] == "u" else C.ASSISTANT
        elif e in "IR":
            new = "assistant" if state == C.USER else "user"
            out.append(f"{new}:{text}")
            state = C.ASSISTANT if new == "assistant" else C.USER
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            sha256("\n".join(out).encode()).hexdigest())


def as_dict(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_search_is_the_cheapest_and_least():
    rng = random.Random(1)
    for _ in range(1500):
        n = rng.randrange(0, 8)
        initials = [rng.choice("suuuaaax") for _ in range(n)]
        kinds = [rng.choice((C.SOUND, C.SOUND, C.TRUNCATED, C.DEAD)) for _ in range(n)]
        p, q = rng.randrange(4), rng.randrange(4)
        assert C.cheapest(initials, kinds, p, q) == uniform_cost(initials, kinds, p, (q,), 60)


def test_whole_conversations_against_plain_python(spark):
    """Long and short conversations in segments of four rows: segments join to the one least answer."""
    rng = random.Random(2)
    made, texts = {}, ["Yes.", "No!", "cut", " ", "", "one two. ", "x?\n\n", "a\nb."]
    for c in range(120):
        n = rng.choice((1, 2, 3, 5, 9, 30))
        made[c] = [(t + rng.choice((0, 0, 1)), rng.choice(("system", "user", "assistant", "user", "assistant", "tool", "")),
                    rng.choice(texts) + ("" if rng.random() < 0.3 else f" {rng.randrange(40)}."))
                   for t in sorted(rng.sample(range(60), n))]
        made[c].sort(key=lambda r: (r[0], r[1], r[2]))
    rows = [(c, *r) for c, rs in made.items() for r in rs]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select(
        "*", F.col("role").alias("tie_role"), F.left("text", F.lit(128)).alias("tie_head"),
        F.sha2("text", 256).alias("tie_sha"), F.lit(0).alias("copies"))
    found = as_dict(C.repaired(df.select("conv_id").distinct(), df, segment=4))
    assert found == {c: reference(rs) for c, rs in made.items()}


def test_one_conversation_over_many_segments(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", f"text {t}" + ("." if t % 5 else "")) for t in range(700)]
    rows += [(1, 700 + t, "user", "again.") for t in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select(
        "*", F.lit("").alias("tie_role"), F.lit("").alias("tie_head"), F.lit("").alias("tie_sha"), F.lit(0).alias("copies"))
    found = as_dict(C.repaired(df.select("conv_id").distinct(), df))
    assert found == {1: reference([r[1:] for r in rows])}


def test_edge_cases(spark):
    """Nulls in every column, repeated rows, a conversation that is dropped whole, long and blank texts."""
    crc = {t: spark.range(1).select(F.crc32(F.lit(f"9:{t}").cast("binary")) % 20).first()[0] for t in range(60)}
    gone = next(t for t, h in crc.items() if h == 0)
    rows = [(9, gone, "user", "Hello."), (1, None, "user", "Hi."), (1, None, None, None), (1, 2, "assistant", "Long. " * 50_000),
            (None, 1, "user", "Hi."), (None, None, None, None), (2, 1, "user", "Same."), (2, 1, "user", "Same."),
            (3, 5, "", "x."), (4, 1, "usher", " \n\t"), (5, 1, "assistant", "ok." + " " * 1000)]
    df = table(spark, rows)
    found = as_dict(C.repaired(df.select("conv_id").distinct(), C.damaged(df)))
    assert found[9] == (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    damaged = C.damaged(df).orderBy("turn", "tie_role", "tie_head", "tie_sha", "copies").collect()
    for c in {r[0] for r in rows} - {9}:
        mine = [(r["turn"], r["role"], r["text"]) for r in damaged if r["conv_id"] == c]
        assert found[c] == reference(mine), c


def test_empty(spark):
    df = table(spark, [])
    out = C.repaired(df.select("conv_id").distinct(), C.damaged(df))
    assert out.count() == 0 and out.columns[0] == "conv_id" and out.columns[-1] == "repaired_sha256"
