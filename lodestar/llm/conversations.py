"""Repair of damaged conversations by iterative-deepening A* (operator 12).

A conversation is repaired when the initials of its roles read
``(s?(ua)+)?``. Edits, in row order: Keep (0), Rerole to user or assistant (3), Delete
(4, required for blank and duplicate rows), Insert an empty user or assistant
row anywhere (3); a truncated row that stays adds 3. The answer is the cheapest
list of edits, the ASCII-least one (D, I, K, R) of equal cost.

1. Narrow rows (no texts) get their position in the conversation by a range
   sort and distributed prefix sums, so a conversation may hold any share of all
   rows. A row is a duplicate if the first position of its role and text (a
   128-bit digest) in the conversation, a partial aggregate, is an earlier one.
2. A conversation is cut into segments of ``SEGMENT`` rows. For every pair of a
   state before and a state after the segment (nothing yet, after system, after
   user, after assistant) a task searches the cheapest edits: depth first in ASCII
   order under a cost bound, which rises to the least cost that the last search
   proved necessary. A table keeps what each failed state (row, state) was proved to
   cost at least, so it is not entered again under a bound that cannot do. The
   first accepting path is the answer.
3. The segments' answers, as one short row each, and the texts are sorted by
   conversation and read as a stream: the answers of the segments are joined state by
   state, the least (cost, edits) of each kept, then the rows are read once in
   order, repaired and hashed. Of two equally cheap edits of the same rows between the
   same states none is a prefix of the other, so the least whole is made of
   least parts. The stream holds one row of text and the edits of one conversation
   (a byte a row, which the result's own cell holds too); SHA-256 reads a
   conversation in order, so this last step is one pass a conversation.

Defined cases: null roles and texts are one space; rows with a null conversation
id are one conversation; rows of equal turn follow each other by role, first 128
characters and SHA-256 of the text as given; roles are told by their first
character, an empty role or another character fits nowhere; a conversation without
rows after the damage has zeros, no edits and the hash of the empty string; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os.path
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm._common import scratch, small, stage
from lodestar.llm._rank import ranked

SEGMENT = 64
#: States of the grammar: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: State after an inserted or reroled row, and that row's role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = ("user", "user", "assistant", "user")
#: States that can follow a state; START leads to SYSTEM only by keeping a system row.
REACH = ((START, SYSTEM, USER, ASSISTANT), (SYSTEM, USER, ASSISTANT), (USER, ASSISTANT), (USER, ASSISTANT))
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = ("su", "ua", "au")
#: Kinds of rows.
SOUND, TRUNCATED, DEAD = range(3)
#: Repeated (role, text) rows up to this many are broadcast to the rows.
MAX_BROADCAST_REPEATS = 100_000

_SPACES = " \t\n\x0b\x0c\r"
_TIES = ["tie_role", "tie_head", "tie_sha"]


# --------------------------------------------------------------------------
# one segment


def lower_bounds(initials: list[str], kinds: list[int]) -> list[int]:
    """For each row a lower bound of the edits of the rows from it on.

    Dead rows cost 4 and truncated ones 3 at least. Beyond that, an edit mends
    at most two of the illegal neighbours among the rows that may stay; it
    costs 3 at least, or 1 more if it deletes a truncated row.
    """
    out, base, cheap, illegal, after = [0], 0, 0, 0, ""
    for x, kind in zip(reversed(initials), reversed(kinds), strict=True):
        if kind == DEAD:
            base += 4
        else:
            illegal += bool(after) and x + after[1:] not in LEGAL
            after = "." + x
            if kind == TRUNCATED:
                base, cheap = base + 3, cheap + 1
        edits = (illegal + 1) // 2
        out.append(base + min(edits, cheap) + 3 * max(0, edits - cheap))
    return out[::-1]


def cheapest(initials: list[str], kinds: list[int], start: int, end: int) -> tuple[int, str] | None:
    """The least cost and the edits that lead from state ``start`` to ``end``; None if none do."""
    n = len(kinds)
    system = [False] * (n + 1)  # a system row that may stay from here on
    for i in reversed(range(n)):
        system[i] = system[i + 1] or (kinds[i] != DEAD and initials[i] == "s")
    bounds = lower_bounds(initials, kinds)
    proved: dict[tuple[int, int], int] = {}
    path: list[str] = []

    def open_(i: int, state: int) -> bool:
        return end in REACH[state] and (end != SYSTEM or state == SYSTEM or system[i])

    def moves(i: int, state: int):
        if i < n:
            yield "D", 4, i + 1, state
        yield "I", 3, i, NEXT[state]
        if i < n and kinds[i] != DEAD:
            more = 3 * (kinds[i] == TRUNCATED)
            if (state, initials[i]) in KEEP:
                yield "K", more, i + 1, KEEP[state, initials[i]]
            yield "R", 3 + more, i + 1, NEXT[state]

    def search(i: int, state: int, left: int) -> int:
        """-1 if a path of at most ``left`` was found, else the cost proved necessary."""
        if i == n and state == end:
            return -1
        least = 1 << 60
        for edit, cost, j, t in moves(i, state):
            if not open_(j, t):
                continue
            need = cost + proved.get((j, t), bounds[j])
            if need <= left:
                path.append(edit)
                need = search(j, t, left - cost)
                if need < 0:
                    return -1
                path.pop()
                need += cost
            least = min(least, need)
        proved[i, state] = least
        return least

    if not open_(0, start):
        return None
    bound = bounds[0]
    while (need := search(0, start, bound)) >= 0:
        bound = need
    return bound, "".join(path)


_SEGMENT = "conv string, seg long, counts array<long>, ends string, table array<struct<p:int,q:int,cost:long,audit:string>>"


def _runs(batches, keys: tuple[str, ...]):
    """(key, rows as column lists) of consecutive equal keys in a stream of record batches."""
    key, held = None, None
    for rb in batches:
        cols = {c: rb.column(c).to_pylist() for c in rb.schema.names}
        ks = list(zip(*[cols[k] for k in keys], strict=True))
        begin = 0
        for end in range(1, len(ks) + 1):
            if end < len(ks) and ks[end] == ks[begin]:
                continue
            part = {c: v[begin:end] for c, v in cols.items()}
            if held is not None and key == ks[begin]:
                for c in held:
                    held[c] += part[c]
            else:
                if held is not None:
                    yield key, held
                key, held = ks[begin], part
            begin = end
    if held is not None:
        yield key, held


_SEGMENT_ARROW = pa.schema([
    ("conv", pa.string()), ("seg", pa.int64()), ("counts", pa.list_(pa.int64())), ("ends", pa.string()),
    ("table", pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])


def _search(segment: int):
    """Rows sorted by (conv, seg, pos) to one row a segment of at most ``segment`` rows."""
    def f(batches):
        out = []
        for (conv, seg), rows in _runs(batches, ("conv", "seg")):
            initials, faults = rows["initial"], rows["fault"]
            kinds = [DEAD if x in ("blank", "duplicate") else TRUNCATED if x == "truncated" else SOUND for x in faults]
            last = (seg + 1) * segment >= rows["group_rows"][0]
            table = []
            for p in STATES if seg else (START,):
                for q in (START, ASSISTANT) if last else STATES:
                    found = cheapest(initials, kinds, p, q)
                    if found is not None:
                        table.append({"p": p, "q": q, "cost": found[0], "audit": found[1]})
            illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
            counts = [faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal]
            ends = (initials[0] or "?") + (initials[-1] or "?")
            out.append({"conv": conv, "seg": seg, "counts": counts, "ends": ends, "table": table})
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, _SEGMENT_ARROW)
                out = []
        yield pa.RecordBatch.from_pylist(out, _SEGMENT_ARROW)
    return f


# --------------------------------------------------------------------------
# one conversation, as a stream


class _Conversation:
    """What is known of the conversation that the stream stands in."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.counts, self.last = [0, 0, 0, 0], ""
        #: Edits common to all states, then per state (cost, further edits).
        self.done, self.best = [], {START: (0, "")}
        self.audit, self.at, self.cost = None, 0, 0
        self.hash, self.rows, self.state = sha256(), 0, START
        self.turns, self.low, self.high = 0, None, None

    def segment(self, counts, ends, table):
        self.counts = [a + b for a, b in zip(self.counts, counts, strict=True)]
        if self.last:
            self.counts[3] += self.last + ends[0] not in LEGAL
        self.last = ends[1]
        now = {}
        for e in table:
            if e["p"] in self.best:
                cost, edits = self.best[e["p"]]
                new = (cost + e["cost"], edits + e["audit"])
                if e["q"] not in now or new < now[e["q"]]:
                    now[e["q"]] = new
        common = os.path.commonprefix([e for _, e in now.values()])
        self.done.append(common)
        self.best = {q: (c, e[len(common):]) for q, (c, e) in now.items()}

    def decide(self):
        if self.audit is None:
            self.cost, rest = min(v for q, v in self.best.items() if q in (START, ASSISTANT))
            self.audit = "".join(self.done) + rest

    def emit(self, role: str, text: str):
        self.hash.update(f"{chr(10) if self.rows else ''}{role}:{text}".encode())
        self.rows += 1

    def inserts(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.emit(ROLES[self.state], "")
            self.state = NEXT[self.state]
            self.at += 1

    def row(self, turn, role: str, text: str):
        self.decide()
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.emit(role, text)
            self.state = KEEP[self.state, role[:1]]
        elif edit == "R":
            self.emit(ROLES[self.state], text)
            self.state = NEXT[self.state]

    def result(self) -> dict:
        self.decide()
        self.inserts()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        names = ("blank", "duplicate", "truncated", "illegal")
        return {"conv_id": self.conv_id, "gaps": gaps, **dict(zip(names, self.counts, strict=True)),
                "cost": self.cost, "audit": self.audit, "repaired_sha256": self.hash.hexdigest()}


_LONGS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_RESULT = "conv_id string, " + ", ".join(f"{c} long" for c in _LONGS) + ", audit string, repaired_sha256 string"
_RESULT_ARROW = pa.schema([("conv_id", pa.string()), *[(c, pa.int64()) for c in _LONGS],
                           ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _repair(batches):
    """Heads, segments and rows sorted by conversation to one row a conversation."""
    now, key = None, None
    for rb in batches:
        out = []
        for r in rb.to_pylist():
            if now is None or r["conv"] != key:
                if now is not None:
                    out.append(now.result())
                now, key = _Conversation(r["conv_id"]), r["conv"]
            if r["part"] == 1:
                now.segment(r["counts"], r["ends"], r["table"])
            elif r["part"] == 2:
                now.row(r["turn"], r["role"], r["text"])
        yield pa.RecordBatch.from_pylist(out, _RESULT_ARROW)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.result()], _RESULT_ARROW)


def _given(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(" "))


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows after a damage fixed by crc32(``conv:turn``) % 20, with the columns that order equal turns."""
    conv, turn, role, text = rows[conv_col], rows[turn_col], _given(rows[role_col]), _given(rows[text_col])
    hit = F.crc32(F.concat(_given(conv), F.lit(":"), _given(turn))) % 20
    new = (F.when(hit == 1, F.lit("")).when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text))
    out = rows.where(hit != 0).select(
        conv.alias("conv_id"), turn.cast("long").alias("turn"),
        F.when(hit == 4, F.lit("user")).otherwise(role).alias("role"), new.alias("text"), role.alias("tie_role"),
        F.left(text, F.lit(128)).alias("tie_head"), F.sha2(text, 256).alias("tie_sha"),
        F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"))
    return out.withColumn("copies", F.explode("copies"))


def repaired(ids: DataFrame, rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """A row for each id of ``ids`` (conv_id, distinct) from the damaged ``rows`` of the conversations."""
    spark = rows.sparkSession
    root = scratch(spark, "conversations")
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    last = F.right(F.rtrim("text", F.lit(_SPACES)), F.lit(1))
    narrow = rows.select(
        conv.alias("conv"), "turn", *_TIES, "copies", F.left("role", F.lit(1)).alias("initial"),
        F.when(last == "", "blank").when(~last.isin(".", "!", "?"), "truncated").alias("fault"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("same"))
    at = stage(spark, ranked(spark, narrow, "conv", ["turn", *_TIES, "copies"], root, "rank")
               .select("conv", "pos", "group_rows", "initial", "fault", "same"), root, "ranked")
    repeats = stage(spark, at.groupBy("conv", "same").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
                    .where("n > 1").drop("n"), root, "repeats")
    at = at.join(small(repeats, MAX_BROADCAST_REPEATS), ["conv", "same"], "left")
    fault = F.when(F.col("fault") == "blank", "blank").when(F.col("pos") > F.col("first"), "duplicate")
    segments = stage(spark, at.select("conv", F.floor(F.col("pos") / segment).cast("long").alias("seg"), "pos", "group_rows",
                                      "initial", fault.otherwise(F.col("fault")).alias("fault"))
                     .repartition("conv", "seg").sortWithinPartitions("conv", "seg", "pos")
                     .mapInArrow(_search(segment), _SEGMENT), root, "segments")

    heads = ids.select(conv.alias("conv"), F.lit(0).alias("part"), F.col("conv_id").cast("string").alias("conv_id"))
    stream = (heads.unionByName(segments.withColumn("part", F.lit(1)), allowMissingColumns=True)
              .unionByName(rows.select(conv.alias("conv"), F.lit(2).alias("part"), "turn", *_TIES, "copies",
                                       "role", "text"), allowMissingColumns=True))
    stream = (stream.repartition("conv").sortWithinPartitions("conv", "part", "seg", "turn", *_TIES, "copies")
              .select("conv", "part", "conv_id", "counts", "ends", "table", "turn", "role", "text"))
    found = stream.mapInArrow(_repair, _RESULT)
    return found.withColumn("conv_id", F.col("conv_id").cast(ids.schema["conv_id"].dataType))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repaired(rows.select("conv_id").distinct(), damaged(rows))


OP12_SQL = r"""
WITH RECURSIVE crc8 AS (
  SELECT range AS i, range::BIGINT AS c, 0 AS k FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc8 WHERE k < 8),
g AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS cid, conv_id, turn, coalesce(role, ' ') AS role,
         coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
crc AS (
  SELECT DISTINCT k AS s, 0 AS k, 4294967295 AS c FROM g
  UNION ALL
  SELECT s, crc.k + 1, xor(crc.c >> 8, crc8.c)
  FROM crc JOIN crc8 ON crc8.k = 8 AND crc8.i = xor(crc.c, ascii(substr(s, crc.k + 1, 1))) & 255
  WHERE crc.k < length(s)),
h AS (
  SELECT g.*, xor(crc.c, 4294967295) % 20 AS hit FROM g JOIN crc ON crc.s = g.k AND crc.k = length(g.k)),
d AS (
  SELECT cid, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, left(text, 128), sha256(text), copy) AS pos
  FROM h JOIN (VALUES (0), (1)) v(copy) ON copy = 0 OR hit = 3
  WHERE hit <> 0),
f AS (
  SELECT *, left(role, 1) AS x, lead(left(role, 1)) OVER (PARTITION BY cid ORDER BY pos) AS y,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY cid, role, text ORDER BY pos) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM d),
st AS (
  SELECT cid, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (y IS NOT NULL AND x || y NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM f GROUP BY cid),
ins(s, t, c, e) AS (
  VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 3, 'I'), (1, 2, 3, 'I'), (2, 3, 3, 'I'),
         (3, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 3, 6, 'II')),
ed(e, s, x, t, c) AS (
  VALUES ('D', 0, '', 0, 4), ('D', 1, '', 1, 4), ('D', 2, '', 2, 4), ('D', 3, '', 3, 4), ('R', 0, '', 2, 3),
         ('R', 1, '', 2, 3), ('R', 2, '', 3, 3), ('R', 3, '', 2, 3), ('K', 0, 's', 1, 0), ('K', 0, 'u', 2, 0),
         ('K', 1, 'u', 2, 0), ('K', 2, 'a', 3, 0), ('K', 3, 'u', 2, 0)),
dp AS (
  SELECT cid, 0::BIGINT AS pos, 0 AS s, {'c': 0, 'e': ''} AS b FROM st
  UNION ALL
  SELECT f.cid, f.pos, ed.t, min({'c': b.c + ins.c + ed.c + CASE WHEN f.fault = 'truncated' AND ed.e <> 'D' THEN 3 ELSE 0 END,
                                  'e': b.e || ins.e || ed.e})
  FROM dp JOIN f ON f.cid = dp.cid AND f.pos = dp.pos + 1 JOIN ins ON ins.s = dp.s JOIN ed ON ed.s = ins.t
  WHERE (ed.e = 'D' OR f.fault NOT IN ('blank', 'duplicate')) AND (ed.e <> 'K' OR ed.x = f.x)
  GROUP BY f.cid, f.pos, ed.t),
best AS (
  SELECT dp.cid, min({'c': b.c + ins.c, 'e': b.e || ins.e}) AS b
  FROM dp JOIN st ON st.cid = dp.cid AND st.n = dp.pos JOIN ins ON ins.s = dp.s WHERE ins.t IN (0, 3) GROUP BY dp.cid),
ch AS (SELECT cid, unnest(range(1, length(b.e) + 1)) AS i, b.e AS e FROM best),
op AS (
  SELECT cid, i, substr(e, i, 1) AS o, length(replace(left(e, i), 'I', '')) AS pos,
         length(replace(left(e, i), 'D', '')) AS k FROM ch),
em AS (
  SELECT op.*, f.role, CASE WHEN o = 'I' THEN '' ELSE f.text END AS text,
         max(CASE WHEN op.k = 1 AND o = 'K' AND f.x = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY op.cid) AS sys
  FROM op LEFT JOIN f ON f.cid = op.cid AND f.pos = op.pos WHERE o <> 'D'),
out AS (
  SELECT cid, sha256(string_agg(CASE WHEN o = 'K' THEN role WHEN (k + sys) % 2 = 1 THEN 'user' ELSE 'assistant' END
                                || ':' || text, chr(10) ORDER BY i)) AS sha FROM em GROUP BY cid),
ids AS (SELECT DISTINCT cid, conv_id FROM g)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.b.c, 0)::BIGINT AS cost, coalesce(best.b.e, '') AS audit,
       coalesce(out.sha, sha256('')) AS repaired_sha256
FROM ids LEFT JOIN st ON st.cid = ids.cid LEFT JOIN best ON best.cid = ids.cid LEFT JOIN out ON out.cid = ids.cid
"""
