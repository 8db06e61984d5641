"""A trie over conversations: which beginnings they share, and what sharing them would save.

Conversations are rebuilt first (``heads``): the first h turns of conversation c - c % FAMILY, h being crc32 of c as text modulo 4, and then c's own turns from its h-th on. A node is a distinct
sequence of first turns. It is known by two 64-bit sums over its turns' hashes, each times a power of an odd number by place, so the sums of a conversation that goes over several parts can be put together.

Each task makes a small trie of the turns that it has (they come in order), flushed when it is full: node, members, smallest member, and the ids of those that end there. Partial tries are merged by node:
numbers are summed, lists of ends put one behind the other. Nodes with one member need no more: below them is a path. Only among the others are sums carried from the bottom up, by jumping from ancestor to
ancestor, twice as far each time, so a deep trie takes few rounds.

Defined results: null roles and texts are empty. Turns come in order of turn (null first), then role, then the md5 of the text, so ties have an order. Rows of a null conv_id belong to no conversation.
Repeated rows are turns of their own. Long texts are hashed whole. Further columns aren't looked at. An empty table gives no row (there is no conversation for the root to have).
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import HOT_KEYS, save
from .turns import MASK, carried, columns, in_order, over_rows, part

FAMILY, HEADS = 20, 4
#: A task's trie is flushed at so many nodes.
FULL = 20_000
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_INVERSE = tuple(pow(b, -1, 1 << 64) for b in _BASES)
EMPTY = hashlib.sha256(b"").hexdigest()

#: A turn: two hashes and its words.
Turn = tuple[int, int, int]


def family(conv: int, size: int = FAMILY) -> int:
    return conv - (conv % size if conv >= 0 else -(-conv % size))


def head_size(conv: int) -> int:
    """How many turns a conversation takes from its family's first one; that one takes none."""
    return 0 if conv == family(conv) else zlib.crc32(str(conv).encode()) % HEADS


def _joined(a: tuple[int, int], n: int, b: tuple[int, int]) -> tuple[int, int]:
    """The sums of n turns with sum a and then others with sum b."""
    return tuple((x + pow(base, n, 1 << 64) * y) & MASK for x, y, base in zip(a, b, _BASES, strict=True))


def _without_first(a: tuple[int, int], t: Turn) -> tuple[int, int]:
    return tuple(((x - y) * inv) & MASK for x, y, inv in zip(a, t, _INVERSE, strict=False))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _sorted_turns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """side (0: ids from 0 on, 1: negative ones), conv, h1, h2, words, in order of the size of the id, so that a family's first conversation comes before the others."""
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    c = F.col(conv_col).cast("bigint")
    words = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint")
    t = rows.where(c.isNotNull()).select(
        (c < 0).cast("int").alias("side"), c.alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), F.unhex(F.md5(text.cast("binary"))).alias("digest"),
        F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(7), text, role).alias("h2"), words.alias("words"),
    )
    return in_order(t, F.col("side"), F.when(F.col("conv") < 0, -F.col("conv")).otherwise(F.col("conv")), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")).select("conv", "h1", "h2", "words")


def _summary(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows with their part and place, and at the end the part's record: the last conversation, how many of its turns are here, their sum, the first of them, whether it began with the part; the last family and the first turns here of its first conversation."""
    me, n, begin = part(), 0, None
    conv, size, sum_, first, start, fam, fam_first = None, 0, (0, 0), [], 0, None, []
    power = [1, 1]
    for c, h1, h2, w in rows:
        t = (h1 & MASK, h2 & MASK, w)
        begin = c if n == 0 else begin
        if c != conv:
            conv, size, sum_, first, start, power = c, 0, (0, 0), [], n, [1, 1]
            if family(c) != fam:
                fam, fam_first = family(c), []
        sum_ = tuple((x + p * y) & MASK for x, p, y in zip(sum_, power, t, strict=False))
        power = [p * b & MASK for p, b in zip(power, _BASES, strict=True)]
        size += 1
        if len(first) < HEADS:
            first.append(t)
        if c == fam and len(fam_first) < HEADS:
            fam_first.append(t)
        yield me, n, c, h1, h2, w, None
        n += 1
    if n:
        yield me, n, None, None, None, None, json.dumps({"begin": begin, "conv": conv, "n": size, "sum": sum_, "first": first, "whole": start == 0, "family": fam, "fam_first": fam_first})


_TURNS = "part int, seq bigint, conv bigint, h1 bigint, h2 bigint, words bigint, record string"


def _step(state: dict, r: dict) -> dict:
    """What holds after a part with this record: the last conversation, how many of its turns there were, their sum from the head_size-th on; the last family and the first turns of its first conversation."""
    h = head_size(r["conv"])
    before, sum_ = (state["n"], tuple(state["sum"])) if r["whole"] and state.get("conv") == r["conv"] else (0, (0, 0))
    add = tuple(r["sum"])
    for t in r["first"][: max(h - before, 0)]:
        add = _without_first(add, t)
    n = before + r["n"]
    first = (state.get("first", []) if state.get("family") == r["family"] else []) + r["fam_first"]
    return {"conv": r["conv"], "n": n, "sum": _joined(sum_, max(before - h, 0), add) if n > h else (0, 0), "family": r["family"], "first": first[: HEADS - 1]}


class _Path:
    """Where a rebuilt conversation stands."""

    def __init__(self) -> None:
        self.depth, self.key, self.up, self.words, self.power = 0, (0, 0), (0, 0), 0, (1, 1)

    def go(self, t: Turn) -> None:
        self.up, self.words = self.key, t[2]
        self.key = tuple((x + p * y) & MASK for x, p, y in zip(self.key, self.power, t, strict=False))
        self.power = tuple(p * b & MASK for p, b in zip(self.power, _BASES, strict=True))
        self.depth += 1

    def jump(self, n: int, sum_: tuple[int, int]) -> None:
        """Over n turns; what came last isn't known then."""
        self.key = _joined(self.key, self.depth, sum_)
        self.depth += n
        self.power = tuple(pow(b, self.depth, 1 << 64) for b in _BASES)


def _bytes(key: tuple[int, int]) -> bytes:
    return key[0].to_bytes(8, "big") + key[1].to_bytes(8, "big")


def _partial(carry: dict[int, dict], goes_on: dict[int, bool], zero: list[Turn]):
    """From parts' rows in order: partial nodes (key, up, depth, words, least, n, ends). goes_on: whether a part's last conversation has turns in the next one; zero: the first turns of conversation 0."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        nodes: dict[tuple[int, int], list] = {}
        path, conv, n, h, fam, first, now = _Path(), None, 0, 0, None, [], None

        def put(member: bool, end: bool) -> None:
            x = nodes.get(path.key)
            if x is None:
                x = nodes[path.key] = [path.up, path.depth, path.words, conv, 0, []]
            x[3] = min(x[3], conv)
            x[4] += member
            if end:
                x[5].append(conv)

        def flush() -> Iterator[tuple]:
            for key, (up, depth, words, least, members, ends) in nodes.items():
                yield _bytes(key), _bytes(up), depth, words, least, members, sorted(ends) or None
            nodes.clear()

        def lead(c: int) -> list[Turn]:
            f = family(c)
            return (zero if f == 0 and c < 0 else first)[: head_size(c)] if f == fam else []

        for me, _, c, h1, h2, w in rows:
            if me != now:
                if conv is not None and not goes_on[now]:
                    put(False, True)
                now, state, conv = me, carry[me], None
                fam, first = state.get("family"), [tuple(t) for t in state.get("first", [])]
                if state.get("conv") == c:
                    conv, n, h, path = c, state["n"], head_size(c), _Path()
                    for t in lead(c):
                        path.go(t)
                    if n > h:
                        path.jump(n - h, tuple(state["sum"]))
            if c != conv:
                if conv is not None:
                    put(False, True)
                # a list of ends is in order as long as signs don't change
                if len(nodes) > FULL or (conv is not None and (conv < 0) != (c < 0)):
                    yield from flush()
                if family(c) != fam:
                    fam, first = family(c), []
                conv, n, h, path = c, 0, head_size(c), _Path()
                put(True, False)
                for t in lead(c):
                    path.go(t)
                    put(True, False)
            t = (h1 & MASK, h2 & MASK, w)
            if c == fam and len(first) < HEADS - 1 and n == len(first):
                first.append(t)
            if n >= h:
                path.go(t)
                put(True, False)
                if len(nodes) > FULL:
                    yield from flush()
            n += 1
        if conv is not None and not goes_on[now]:
            put(False, True)
        yield from flush()

    return run


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    """From lists of ends in order, of which a node may have several: node and hash."""
    now, sha, some = None, None, False
    for key, ends in rows:
        if key != now:
            if now is not None:
                yield now, sha.hexdigest()
            now, sha, some = key, hashlib.sha256(), False
        sha.update((("," if some else "") + ",".join(map(str, ends))).encode())
        some = True
    if now is not None:
        yield now, sha.hexdigest()


_NODES = "key binary, up binary, depth bigint, words bigint, least bigint, n bigint, ends array<bigint>"
_ENDS = "key binary, ends_sha256 string"


def partial_tries(spark: SparkSession, rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The nodes of every task's own trie: key, up (its parent), depth, words of its last text, least (smallest member), n members, ends. A node may have several rows."""
    turns = _sorted_turns(rows, conv_col, turn_col, role_col, text_col)
    turns = save(spark, turns.mapInArrow(over_rows(lambda r: columns(_summary(r), _TURNS)), _TURNS), "turns")
    records = sorted((r.part, json.loads(r.record)) for r in turns.where("record is not null").select("part", "record").collect())
    carry = carried(records, {}, _step)
    following = {a: b for (a, _), (_, b) in zip(records, records[1:], strict=False)}
    goes_on = {n: n in following and following[n]["begin"] == r["conv"] for n, r in records}
    zero = [(r.h1 & MASK, r.h2 & MASK, r.words) for r in turns.where("conv = 0").orderBy("part", "seq").limit(HEADS - 1).collect()]
    rows = turns.where("record is null").drop("record").repartitionByRange("part").sortWithinPartitions("part", "seq")
    make = _partial(carry, goes_on, zero)
    return rows.mapInArrow(over_rows(lambda r: columns(make(r), _NODES)), _NODES)


def trie(spark: SparkSession, rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    parts = save(spark, partial_tries(spark, rows, conv_col, turn_col, role_col, text_col), "tries")
    nodes = parts.groupBy("key").agg(F.first("up").alias("up"), F.first("depth").alias("depth"), F.max("words").alias("words"), F.min("least").alias("least"), F.sum("n").alias("n"), F.sum(F.coalesce(F.size("ends"), F.lit(0))).alias("n_ends"))
    nodes = save(spark, nodes.withColumn("n_ends", F.greatest("n_ends", F.lit(0))), "nodes")
    n_nodes = nodes.count()
    below = nodes.where("depth > 0").groupBy(F.col("up").alias("key")).agg(F.count(F.lit(1)).alias("n_children"), F.count(F.when(F.col("n") == 1, 1)).alias("single"))
    many = nodes.where("n > 1 or depth = 0").join(below, "key", "left").na.fill(0, ["n_children", "single"])
    many = save(spark, many.withColumn("leaves", F.col("single") + F.when(F.col("n_children") == 0, 1).otherwise(0)).withColumn("saved", (F.col("n") - 1) * F.col("words")), "shared")

    def with_parent(some: DataFrame) -> DataFrame:
        """Nodes with the smallest member of their parent. Parents of very many are sent to every task, HOT_KEYS of them at most."""
        most = max(n_nodes // HOT_KEYS, 1)
        up = many.select(F.col("key").alias("up"), F.col("least").alias("parent_conv_id"), "n_children")
        hot, cold = up.where(F.col("n_children") > most).drop("n_children"), up.where(F.col("n_children") <= most).drop("n_children")
        rest = some.join(F.broadcast(hot.select("up")), "up", "left_anti").join(cold, "up", "left")
        return some.join(F.broadcast(hot), "up").unionByName(rest)

    # from the bottom up: after the round with this step, a node has the sums of all that are less than 2 * step below it
    deepest = many.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]
    sums, step = many.select("key", F.when(F.col("depth") > 0, F.col("up")).alias("up"), "depth", "leaves", "saved"), 1
    while step <= deepest:
        got = sums.where("up is not null").groupBy(F.col("up").alias("key")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"), F.count(F.lit(1)).alias("times"))
        sums = save(spark, sums.join(got, "key", "left").select("key", "up", "depth", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), F.coalesce("times", F.lit(0)).alias("times")), "sums")
        # an ancestor twice as far, where there is one
        most = max(n_nodes // HOT_KEYS, 1)
        next_ = sums.select(F.col("key").alias("up"), F.col("up").alias("next"), "times").where("times > 0 and next is not null")
        hot, cold = next_.where(F.col("times") > most).drop("times"), next_.where(F.col("times") <= most).drop("times")
        far = sums.where(F.col("depth") >= 2 * step).drop("times")
        far = far.join(F.broadcast(hot), "up").unionByName(far.join(F.broadcast(hot.select("up")), "up", "left_anti").join(cold, "up"))
        near = sums.where(F.col("depth") < 2 * step).select("key", F.lit(None).cast("binary").alias("up"), "depth", "leaves", "saved")
        sums = save(spark, far.select("key", F.col("next").alias("up"), "depth", "leaves", "saved").unionByName(near), "jumps")
        step *= 2

    ends = parts.where("ends is not null").select("key", "ends").join(many.where("n_ends > 0").select("key"), "key", "left_semi")
    ends = ends.repartition("key").sortWithinPartitions("key", F.col("ends")[0]).mapInArrow(over_rows(lambda r: columns(_digests(r), _ENDS)), _ENDS)

    shared = with_parent(many.where("depth > 0")).unionByName(many.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint")))
    shared = shared.drop("up", "leaves", "saved").join(sums.select("key", "leaves", "saved"), "key").join(ends, "key", "left")
    shared = shared.select(F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
    one = with_parent(nodes.where("n = 1 and depth > 0"))
    one = one.select(
        F.col("least").alias("conv_id"), "depth", F.coalesce("parent_conv_id", "least").alias("parent_conv_id"), F.col("n").alias("n_convs"), (1 - F.col("n_ends")).alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_tokens"), F.when(F.col("n_ends") > 0, F.sha2(F.col("least").cast("string").cast("binary"), 256)).otherwise(EMPTY).alias("ends_sha256"),
    )
    return shared.unionByName(one)


#: A table t for crc32, and with it crc32 of a text of ASCII characters; ``{0}`` is the text.
CRC_TABLE = "(SELECT list(" + "(list_reduce([n, 1, 2, 3, 4, 5, 6, 7, 8], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))" + " ORDER BY n) FROM (SELECT unnest(range(256)) AS n))"
CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split({0}, ''), lambda x: unicode(x)::BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"

ORACLE = f"""
WITH crc AS (SELECT {CRC_TABLE} AS t),
o AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS n, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, c - c % 20 AS f, CASE WHEN c % 20 = 0 THEN 0 ELSE {CRC.format('c::VARCHAR')} % 4 END AS h FROM (SELECT DISTINCT c FROM o), crc),
r AS (SELECT h.c, 0 AS own, n, role, text FROM h JOIN o ON o.c = h.f AND n <= h.h UNION ALL SELECT h.c, 1, n, role, text FROM h JOIN o ON o.c = h.c AND n > h.h),
d AS (SELECT c, row_number() OVER w AS depth, list(md5(length(role) || ':' || role || text)) OVER w AS path, text FROM r WINDOW w AS (PARTITION BY c ORDER BY own, n ROWS UNBOUNDED PRECEDING)),
m AS (SELECT c, depth, md5(array_to_string(path, '')) AS k, CASE WHEN depth = 1 THEN '' ELSE md5(array_to_string(path[1:depth - 1], '')) END AS up, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM d UNION ALL SELECT c, 0, '', NULL, 0 FROM h),
e AS (SELECT k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ends FROM m QUALIFY_ GROUP BY k),
n AS (SELECT k, depth, any_value(up) AS up, any_value(words) AS words, min(c) AS conv_id, count(*) AS n FROM m GROUP BY k, depth),
l AS (SELECT n.*, (n.n - 1) * n.words AS v, NOT EXISTS (SELECT 1 FROM n x WHERE x.up = n.k) AS leaf FROM n),
s AS (SELECT m.k, sum(l.v)::BIGINT AS saved, count(*) FILTER (l.leaf) AS leaves FROM l JOIN m ON m.c = l.conv_id AND m.depth <= l.depth GROUP BY m.k)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, (SELECT count(*) FROM n x WHERE x.up = n.k) AS n_children, s.leaves AS n_leaves, s.saved AS saved_tokens, sha256(coalesce(e.ends, '')) AS ends_sha256
FROM n LEFT JOIN n p ON p.k = n.up JOIN s ON s.k = n.k LEFT JOIN e ON e.k = n.k
""".replace("FROM m QUALIFY_ GROUP BY k", "FROM (SELECT c, k FROM m QUALIFY depth = max(depth) OVER (PARTITION BY c)) GROUP BY k")
