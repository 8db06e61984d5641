"""Repair of conversations: the cheapest edits after which roles take turns, by a scan of min-plus matrices.

A repaired conversation is empty, or a system turn or none and then pairs of a user's and an assistant's. Four states tell how far such a sequence is: nothing, system, user (an answer is due), whole. A turn is
a 4x4 matrix: from state to state, the least (cost, audit) of what may be done with it, with insertions before it closed in. An audit is the edits' initials; costs and then audits are compared, and joined by addition.
The matrix product is associative, so a conversation is a tree of products: within a task for all that it holds whole, and over chunk records for those that lie across parts (``turns``).

Two audits of the same turns that cost the same never begin one another, since letters settle costs; so least audits stay least when joined, as the products need.

Defined results: turns in order of turn (null first), then role, then text. Null roles and texts are one space; a role's initial counts, whatever it is. A null conv_id is a conversation of its own. Rows with ``absent`` only make
their conversation known. Repeated rows are duplicates. Long texts are read whole. Further columns aren't looked at; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import save
from .turns import columns, in_order, over_rows, part

NONE, SYSTEM, USER, WHOLE = range(4)
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
_GO = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): WHOLE, (WHOLE, "u"): USER}
#: What is said next if a turn is inserted or given another role.
_NEXT = {NONE: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", WHOLE), WHOLE: ("user", USER)}
_LEGAL = frozenset(("su", "ua", "au"))
BLANK, DUPLICATE, CUT, FINE = "bdtf"
FAN = 8
#: Repaired text goes on in pieces of so many characters.
PIECE = 1 << 20

#: From each state: to which, at what cost, by which audit.
Matrix = list[list[tuple[int, int, str]]]


def product(a: Matrix, b: Matrix) -> Matrix:
    out = []
    for row in a:
        best: dict[int, tuple[int, str]] = {}
        for k, c, x in row:
            for q, d, y in b[k]:
                old = best.get(q)
                if old is None or c + d < old[0] or (c + d == old[0] and x + y < old[1]):
                    best[q] = (c + d, x + y)
        out.append([(q, c, x) for q, (c, x) in sorted(best.items())])
    return out


def _insertions() -> Matrix:
    """Any insertions, the closure of a single one."""
    one = [[(p, 0, ""), (_NEXT[p][1], INSERT, "I")] for p in range(4)]
    return product(one, product(one, one))


INSERTIONS = _insertions()


@lru_cache(256)
def turn_matrix(initial: str, fault: str) -> Matrix:
    rows = []
    for p in range(4):
        row = [(p, DELETE, "D")]
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED if fault == CUT else 0
            options = {_NEXT[p][1]: (REROLE + more, "R")}
            if (p, initial) in _GO:
                q = _GO[p, initial]
                options[q] = min(options.get(q, (99, "")), (more, "K"))
            row += [(q, c, x) for q, (c, x) in options.items()]
        best: dict[int, tuple[int, str]] = {}
        for q, c, x in row:
            best[q] = min(best.get(q, (99, "")), (c, x))
        rows.append([(q, c, x) for q, (c, x) in sorted(best.items())])
    return product(INSERTIONS, rows)


def _of(turns: tuple[tuple[str, str], ...]) -> Matrix:
    """The product of turns, each (initial, fault), as a balanced tree."""
    if len(turns) == 1:
        return turn_matrix(*turns[0])
    if len(turns) <= FAN:
        return _short(turns)
    half = len(turns) // 2
    return product(_of(turns[:half]), _of(turns[half:]))


@lru_cache(1 << 14)
def _short(turns: tuple[tuple[str, str], ...]) -> Matrix:
    half = len(turns) // 2
    return product(_of(turns[:half]), _of(turns[half:]))


def cheapest(m: Matrix | None) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    if m is None:
        return 0, ""
    return min((c, x) for q, c, x in product(m, INSERTIONS)[NONE] if q in (NONE, WHOLE))


def repaired(rows: Iterator[tuple[str, str]], audit: str, state: int = NONE) -> Iterator[tuple[str, str]]:
    """The turns (role, text) that the edits leave."""
    rows = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "K":
            state = _GO[state, role[:1]]
        elif edit != "D":
            role, state = _NEXT[state]
        if edit != "D":
            yield role, text


def state_after(initials: Iterator[str], audit: str, state: int) -> int:
    initials = iter(initials)
    for edit in audit:
        initial = "" if edit == "I" else next(initials)
        state = _GO[state, initial] if edit == "K" else state if edit == "D" else _NEXT[state][1]
    return state


class Chunk:
    """What is known of some turns of one conversation that follow each other."""

    def __init__(self) -> None:
        self.turns: list[tuple[str, str]] = []
        self.count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "n", "turns"), 0)
        self.low = self.high = None
        self.first: str | None = None
        self.last = ""

    def add(self, turn: int | None, role: str, fault: str) -> None:
        initial, c = role[:1], self.count
        c["n"] += 1
        for name, kind in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", CUT)):
            c[name] += fault == kind
        if self.first is None:
            self.first = initial
        else:
            c["illegal"] += self.last + initial not in _LEGAL
        self.last = initial
        if turn is not None:
            c["turns"] += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.turns.append((initial, fault))

    def record(self) -> dict:
        return {**self.count, "low": self.low, "high": self.high, "first": self.first, "last": self.last, "matrix": _of(tuple(self.turns)) if self.turns else None, "initials": "".join(i or " " for i, _ in self.turns)}


def joined(a: dict, b: dict) -> dict:
    """Of two chunks that follow each other the whole."""
    if not a["n"] or not b["n"]:
        return b if not a["n"] else a
    out = {k: a[k] + b[k] for k in ("blank", "duplicate", "truncated", "illegal", "n", "turns")}
    out["illegal"] += a["last"] + b["first"] not in _LEGAL
    out["turns"] -= a["high"] is not None and a["high"] == b["low"]
    low = [x["low"] for x in (a, b) if x["low"] is not None]
    return {**out, "low": low[0] if low else None, "high": b["high"] if b["high"] is not None else a["high"], "first": a["first"], "last": b["last"], "matrix": product(a["matrix"], b["matrix"])}


def _result(r: dict) -> tuple:
    """gaps, blank, duplicate, truncated, illegal, cost, audit."""
    cost, audit = cheapest(r["matrix"])
    gaps = 0 if r["low"] is None else r["high"] - r["low"] + 1 - r["turns"]
    return gaps, r["blank"], r["duplicate"], r["truncated"], r["illegal"], cost, audit


def _fault(blank: bool, ends: bool, again: bool) -> str:
    return BLANK if blank else DUPLICATE if again else FINE if ends else CUT


def _whole(rows: list[tuple]) -> tuple:
    """The result of a conversation all of whose rows are here: turn, role, text, blank, ends, absent."""
    chunk, seen, texts = Chunk(), set(), []
    for turn, role, text, blank, ends, absent in rows:
        if not absent:
            chunk.add(turn, role, _fault(blank, ends, (role, text) in seen))
            seen.add((role, text))
            texts.append((role, text))
    result = _result(chunk.record())
    return *result, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired(iter(texts), result[-1])).encode()).hexdigest()


def _first_pass(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Results of conversations that are whole in this part; of its first and last one, which may not be, the rows as they are."""
    me, seq, now, number = part(), 0, None, 0
    held: list[tuple] = []

    def raw() -> Iterator[tuple]:
        for k, r in enumerate(held):
            yield (True, me, seq - len(held) + k, *r, *[None] * 8)
        held.clear()

    for r in rows:
        if not number or r[0] != now:
            if number > 1:
                yield False, None, None, now, *[None] * 6, *_whole([x[1:] for x in held])
                held.clear()
            else:
                yield from raw()
            now, number = r[0], number + 1
        held.append(r)
        seq += 1
        if number == 1:
            yield from raw()
    yield from raw()


def _chunks(rows: Iterator[tuple]) -> Iterator[tuple]:
    """From rows (part, conversation's key, seq, conv, turn, role, blank, ends, absent, again) in order: a record for each part's share of each conversation, with the place where it begins."""
    now, chunk, start, conv = None, None, 0, None
    for p, key, seq, c, turn, role, blank, ends, absent, again in rows:
        if (p, key) != now:
            if now is not None:
                yield *now, conv, start, json.dumps(chunk.record())
            now, chunk, start, conv = (p, key), Chunk(), seq, c
        if not absent:
            chunk.add(turn, role, _fault(blank, ends, again))
    if now is not None:
        yield *now, conv, start, json.dumps(chunk.record())


def _reduced(rows: Iterator[tuple]) -> Iterator[tuple]:
    """From (key, group, place, record) in order: a group's records joined."""
    now, held = None, []
    for key, group, _, record in rows:
        if (key, group) != now:
            if held:
                yield *now, json.dumps(_tree(held))
            now, held = (key, group), []
        held.append(json.loads(record))
    if held:
        yield *now, json.dumps(_tree(held))


def _tree(records: list[dict]) -> dict:
    while len(records) > 1:
        records = [joined(*records[i : i + 2]) if i + 1 < len(records) else records[i] for i in range(0, len(records), 2)]
    return records[0]


def _slices(rows: Iterator[tuple]) -> Iterator[tuple]:
    """From (key, record of the whole, shares in order with part, start, n and initials): each share's state and edits."""
    for key, record, shares in rows:
        audit = cheapest(json.loads(record)["matrix"])[1]
        at, state = 0, NONE
        for k, share in enumerate(shares):
            end, left = at, share["n"]
            while left:
                left -= audit[end] != "I"
                end += 1
            if k == len(shares) - 1 or not any(s["n"] for s in shares[k + 1 :]):
                end = len(audit)
            edits = audit[at:end]
            yield share["part"], share["start"], key, state, edits
            state, at = state_after(iter(share["initials"]), edits, state), end


def _pieces(rows: Iterator[tuple]) -> Iterator[tuple]:
    """From (part, seq, kind, key, state, edits, role, text, absent), a share's edits (kind 0) before its rows: what the edits leave of it, as text that begins with a newline for each turn."""
    share: tuple | None = None
    turns: list[tuple[str, str]] = []
    for p, seq, kind, key, state, edits, role, text, absent in rows:
        if kind == 0:
            if share:
                yield from _cut(share, turns)
            share, turns = (key, p, seq, state, edits), []
        elif not absent:
            turns.append((role, text))
    if share:
        yield from _cut(share, turns)


def _cut(share: tuple, turns: list[tuple[str, str]]) -> Iterator[tuple]:
    key, p, seq, state, edits = share
    held, size = [], 0
    for n, (role, text) in enumerate(repaired(iter(turns), edits, state)):
        held.append(f"\n{role}:{text}")
        size += len(held[-1])
        if size >= PIECE:
            yield key, p, seq, n, "".join(held)
            held, size = [], 0
    if held:
        yield key, p, seq, 1 << 40, "".join(held)


def _hashes(rows: Iterator[tuple]) -> Iterator[tuple]:
    """From (key, text) in order: a conversation's hash, without its first newline."""
    now, sha = None, None
    for key, text in rows:
        if key != now:
            if now is not None:
                yield now, sha.hexdigest()
            now, sha, text = key, hashlib.sha256(), text[1:]
        sha.update(text.encode())
    if now is not None:
        yield now, sha.hexdigest()


_RESULT = "gaps bigint, blanks bigint, duplicates bigint, cuts bigint, illegals bigint, cost bigint, audit string, sha string"
_RAW = f"raw boolean, part int, seq bigint, conv bigint, turn bigint, role string, text string, blank boolean, ends boolean, absent boolean, {_RESULT}"
EMPTY = hashlib.sha256(b"").hexdigest()


def repair(spark: SparkSession, rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", absent: Column | None = None) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    gone = F.lit(False) if absent is None else F.coalesce(absent, F.lit(False))
    turns = rows.select(F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), role.alias("role"), F.when(gone, "").otherwise(text).alias("text"), gone.alias("absent"))
    turns = turns.select("conv", "turn", "role", "text", (~F.col("text").rlike("[^\\x20\\x09-\\x0D]")).alias("blank"), F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z").alias("ends"), "absent")
    turns = in_order(turns, F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"))
    first = save(spark, turns.mapInArrow(over_rows(lambda r: columns(_first_pass(r), _RAW)), _RAW), "repairs")
    done = first.where("not raw").select("conv", *[c.split()[0] for c in _RESULT.split(", ")])
    out = done.unionByName(_across(spark, first.where("raw").withColumn("key", F.coalesce(F.col("conv").cast("string"), F.lit("")))))
    return out.select(F.col("conv").alias(conv_col), "gaps", F.col("blanks").alias("blank"), F.col("duplicates").alias("duplicate"), F.col("cuts").alias("truncated"), F.col("illegals").alias("illegal"), "cost", "audit", F.col("sha").alias("repaired_sha256"))


def _across(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """Results of conversations that may lie across parts, from their rows: a record for each part's share, a tree of products over records, and the edits dealt back to the shares."""
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    seen = raw.where("not absent").groupBy("key", digest.alias("d")).agg(F.min(F.struct("part", "seq")).alias("at")).select("at.part", "at.seq", F.lit(True).alias("new"))
    rows = raw.drop("text").join(seen, ["part", "seq"], "left").select("part", "key", "seq", "conv", "turn", "role", "blank", "ends", "absent", F.col("new").isNull().alias("again"))
    rows = rows.repartitionByRange("part").sortWithinPartitions("part", "seq")
    schema = "part int, key string, conv bigint, start bigint, record string"
    shares = save(spark, rows.mapInArrow(over_rows(lambda r: columns(_chunks(r), schema)), schema), "shares")
    n = F.get_json_object("record", "$.n").cast("bigint")
    placed = shares.select("key", "part", "start", "record", (F.row_number().over(W.partitionBy("key").orderBy("part")) - 1).alias("place"))
    level, most = placed.select("key", "place", "record"), placed.agg(F.max("place")).first()[0] or 0
    tree = "key string, place int, record string"
    while True:
        deal = level.select("key", F.floor(F.col("place") / FAN).cast("int").alias("group"), "place", "record").repartition("key", "group").sortWithinPartitions("key", "group", "place")
        level = save(spark, deal.mapInArrow(over_rows(lambda r: columns(_reduced(r), tree)), tree), "products")
        if most < FAN:
            break
        most //= FAN
    whole = level.select("key", "record")
    parts = shares.select("key", F.struct("part", "start", n.alias("n"), F.get_json_object("record", "$.initials").alias("initials")).alias("s")).groupBy("key").agg(F.sort_array(F.collect_list("s")).alias("shares"))
    cut = "part int, seq bigint, key string, state int, edits string"
    edits = whole.join(parts, "key").select("key", "record", "shares").mapInArrow(over_rows(lambda r: columns(_slices(r), cut)), cut)
    none = lambda kind: F.lit(None).cast(kind)
    stream = edits.select("part", "seq", F.lit(0).alias("kind"), "key", "state", "edits", none("string").alias("role"), none("string").alias("text"), none("boolean").alias("absent"))
    stream = stream.unionByName(raw.select("part", "seq", F.lit(1).alias("kind"), "key", none("int").alias("state"), none("string").alias("edits"), "role", "text", "absent"))
    stream = stream.repartitionByRange("part").sortWithinPartitions("part", "seq", "kind")
    text = "key string, part int, seq bigint, n bigint, text string"
    pieces = stream.mapInArrow(over_rows(lambda r: columns(_pieces(r), text)), text)
    pieces = pieces.repartition("key").sortWithinPartitions("key", "part", "seq", "n").select("key", "text")
    shas = pieces.mapInArrow(over_rows(lambda r: columns(_hashes(r), "key string, sha string")), "key string, sha string")

    def results(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, conv, record in rows:
            yield key, conv, *_result(json.loads(record))

    final = f"key string, conv bigint, {_RESULT.rpartition(',')[0]}"
    conv = shares.groupBy("key").agg(F.first("conv").alias("conv"))
    got = whole.join(conv, "key").select("key", "conv", "record").mapInArrow(over_rows(lambda r: columns(results(r), final)), final)
    return got.join(shas, "key", "left").withColumn("sha", F.coalesce("sha", F.lit(EMPTY))).drop("key")


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows damaged by crc32 of "conversation:turn" modulo 20, nulls being one space: 0 marks a row absent, 1 empties its text, 2 removes [.!?] from it, 3 repeats the row, 4 makes its role user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(space(conv_col), F.lit(":"), space(turn_col)).cast("binary")) % 20
    t = rows.select(F.col(conv_col), F.col(turn_col), space(role_col).alias(role_col), space(text_col).alias(text_col), k.alias("__k"))
    t = t.withColumn(role_col, F.when(F.col("__k") == 4, "user").otherwise(F.col(role_col)))
    t = t.withColumn(text_col, F.when(F.col("__k") == 1, "").when(F.col("__k") == 2, F.translate(F.col(text_col), ".!?", "")).otherwise(F.col(text_col)))
    copies = F.explode(F.when(F.col("__k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return t.select(conv_col, turn_col, role_col, text_col, (F.col("__k") == 0).alias("absent"), copies.alias("__copy")).drop("__copy")


def _sql() -> str:
    """The same row by row: of each state the least (cost, audit), with the text that the edits leave."""
    from .prefix_trie import CRC, CRC_TABLE

    def plus(x: str, cost: str, edit: str, text: str = "''") -> str:
        return f"CASE WHEN {x} IS NOT NULL THEN {{'c': {x}.c + {cost}, 'a': {x}.a || '{edit}', 't': {x}.t || {text}}} END"

    least = lambda *xs: f"list_min([{', '.join(xs)}])"
    said = lambda role: f"chr(10) || '{role}:'"
    closed = f"""SELECT *, {least('w', plus('u1', '2', 'I', said('assistant')))} AS w1 FROM (SELECT *, {least('u', *[plus(x, '2', 'I', said('user')) for x in 'nsw'])} AS u1 FROM {{0}})"""
    kept, as_user, as_assistant = "chr(10) || role || ':' || text", "chr(10) || 'user:' || text", "chr(10) || 'assistant:' || text"
    cut, ok = "(fault = 't')::INTEGER", "fault NOT IN ('b', 'd')"
    when = lambda test, x: f"CASE WHEN {test} THEN {x} END"
    due = least("n", "s", "w1")
    before = f"SELECT *, {due} AS due FROM ({closed})"
    step = f"""SELECT c, i, {plus('n', '3', 'D')} AS n, {least(plus('s', '3', 'D'), when(ok + " AND ini = 's'", plus('n', cut, 'K', kept)))} AS s,
{least(plus('u1', '3', 'D'), when(ok, plus('due', '2 + ' + cut, 'R', as_user)), when(ok + " AND ini = 'u'", plus('due', cut, 'K', kept)))} AS u, {least(plus('w1', '3', 'D'), when(ok, plus('u1', '2 + ' + cut, 'R', as_assistant)), when(ok + " AND ini = 'a'", plus('u1', cut, 'K', kept)))} AS w"""
    space = r"[^\x20\x09-\x0D]"
    key = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    return f"""
WITH RECURSIVE crc AS (SELECT {CRC_TABLE} AS t),
o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {CRC.format('(' + key + ')')} % 20 AS k FROM conversations, crc),
d AS (SELECT conv_id AS c, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM o WHERE k <> 0),
r AS (SELECT *, row_number() OVER w AS i, substr(role, 1, 1) AS ini, lag(substr(role, 1, 1)) OVER w AS prev, row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM d WINDOW w AS (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy)),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '{space}') THEN 'b' WHEN again THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 't' ELSE 'f' END AS fault FROM r),
p AS (SELECT DISTINCT conv_id AS c, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': ''}} AS n, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS s, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS u, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS w FROM conversations
    UNION ALL {step} FROM ({before.replace("{0}", "(SELECT p.c, p.i + 1 AS i, n, s, u, w, role, text, ini, fault FROM p JOIN f ON f.c IS NOT DISTINCT FROM p.c AND f.i = p.i + 1)")})),
e AS (SELECT c, {least('n', 'w1')} AS best FROM ({closed.replace("{0}", "(SELECT * FROM p QUALIFY i = max(i) OVER (PARTITION BY c))")})),
g AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (prev || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY c)
SELECT e.c AS conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit, sha256(substr(best.t, 2)) AS repaired_sha256
FROM e LEFT JOIN g ON g.c IS NOT DISTINCT FROM e.c
"""


ORACLE = _sql()
