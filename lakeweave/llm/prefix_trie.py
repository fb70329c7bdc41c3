"""Operator 12: the prefix trie of conversations.

A conversation is a sequence of turns; every distinct sequence of its first d
turns is a node of depth d.  Sorted sequences have their common prefixes side
by side: with an edge between sorted neighbours, as deep as their longest
common prefix, a union-find that takes the edges in descending depth builds
the trie bottom-up -- every merge of components makes (or extends) a
branching node.  That is done for one bounded run of sorted sequences at a
time (a forest); the nodes on a forest's first and last path may go on in its
neighbours and are handed over as partial nodes, merged by key in Spark, and
the small contracted trie that they form gets its subtree totals by pointer
doubling.

Scale:

* turns are reduced to a 128-bit fingerprint and a length before any shuffle;
* the place of a turn in its conversation comes from a range sort over
  (conversation, turn) and one carry a range, so a conversation of any size
  is spread over tasks;
* conversations are cut into segments of ``SEGMENT`` turns.  A segment's
  anchor is the fingerprint of all turns before it (a sum of 126-bit hashes of
  the earlier segments and their numbers), so segments with equal anchors
  hang below the same node.  Rows stay bounded; conversations that go on
  below a segment make its path partial;
* segments are range-sorted by (anchor, turns, conversation): copies of one
  conversation, however many, are spread over ranges by their id;
* a forest is one Arrow batch, so memory does not follow the partition; it
  hands over at most two paths besides those of longer conversations;
* the digest of the conversations that end at a node is a hash of one string:
  inside a forest it is made there; for partial nodes the ids travel as
  pieces of text, in order, and are hashed as a stream, piece by piece.

Defined cases: rows without a conversation id belong to none and are left
out.  Turns are ordered by number, those without one first; turns of equal
number by the fingerprint of (role, text).  A null role or text is empty.
Repeated rows are turns of their own.  A conversation left without turns is
a member of the root.  An empty table gives an empty result.  Columns other
than the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fields, read, ship, staged, trimmed

SEGMENT = 64             # turns a segment
PRINT = 16               # bytes of a turn's fingerprint
ROOT = b"\0" * 16        # anchor of first segments
NOTHING = hashlib.sha256(b"").hexdigest()
_HALF = (1 << 63) - 1


# --- keys of nodes -----------------------------------------------------------

def seg_hash(number: int, turns: bytes) -> tuple[int, int]:
    """Two 63-bit hashes of a full segment and its number."""
    d = hashlib.sha256(b"segment" + number.to_bytes(8, "little") + turns).digest()
    return int.from_bytes(d[:8], "little") & _HALF, int.from_bytes(d[8:16], "little") & _HALF


def next_anchor(anchor: bytes, number: int, turns: bytes) -> bytes:
    """Anchor below a full segment: halves add up modulo 2**63."""
    a = int.from_bytes(anchor[:8], "big"), int.from_bytes(anchor[8:], "big")
    return b"".join(((x + h) & _HALF).to_bytes(8, "big") for x, h in zip(a, seg_hash(number, turns)))


def node_key(anchor: bytes, number: int, turns: bytes, d: int) -> bytes:
    """Key of the node ``d`` turns into a segment."""
    if d == 0:
        return anchor
    if d == SEGMENT:
        return next_anchor(anchor, number, turns)
    return hashlib.sha256(b"node" + anchor + turns[:d * PRINT]).digest()[:16]


# --- one forest --------------------------------------------------------------

class Forest:
    """The trie of one run of sorted segments.

    ``rows``: (anchor, number, turns, sizes, conv, more), sorted by anchor,
    turns and conv; ``more``: the conversation goes on below the segment.
    """

    def __init__(self, rows: list[tuple]):
        self.rows = rows
        self.nodes: list[tuple] = []      # finished nodes
        self.parts: list[tuple] = []      # partial nodes
        self.ends: list[tuple] = []       # (key, text) of the ids that end at partial nodes
        self.length = [len(r[2]) // PRINT for r in rows]
        self.lcp = [-1] * (len(rows) + 1)                 # of a row and the one before it; -1: another anchor
        for r in range(1, len(rows)):
            self.lcp[r] = self._common(r - 1, r)
        self._open()

    def _common(self, a: int, b: int) -> int:
        if self.rows[a][0] != self.rows[b][0]:
            return -1
        x, y = self.rows[a][2], self.rows[b][2]
        n = min(len(x), len(y))
        if x[:n] == y[:n]:
            return n // PRINT
        u, v = (np.frombuffer(z[:n], np.uint64).reshape(-1, 2) for z in (x, y))
        return int(np.argmax((u != v).any(1)))

    def _open(self) -> None:
        """How deep each row's path is partial: what it shares with the
        first or last row, or with one that goes on below."""
        n = len(self.rows)
        deep = [self.length[r] if r in (0, n - 1) or self.rows[r][5] else 0 for r in range(n)]
        for order, step in ((range(1, n), -1), (range(n - 2, -1, -1), 1)):
            for r in order:
                shared = self.lcp[r] if step < 0 else self.lcp[r + 1]
                deep[r] = max(deep[r], min(deep[r + step], shared))
        self.partial = deep

    def build(self) -> None:
        n = len(self.rows)
        # one component a distinct sequence: [first row, one past the last]
        self.parent = list(range(n))
        self.top = [None] * n             # of a component, by its root: the node on top
        edges = []
        for r in range(n):
            same = r and self.lcp[r] == self.length[r] == self.length[r - 1]
            if same:
                self.parent[r] = self._find(r - 1)
            else:
                edges.append((r, self.lcp[r]))
        starts = [r for r, _ in edges]
        for k, r in enumerate(starts):
            end = starts[k + 1] if k + 1 < len(starts) else n
            self.top[r] = self._leaf(r, end)
        for r, depth in sorted(edges, key=lambda e: -e[1]):
            if depth >= 0:
                self._merge(self._find(r - 1), self._find(r), depth)
        for r in starts:
            if self._find(r) == r:        # a segment's own root ends the component
                self._close(self._lift(self.top[r], 0), None)

    def _find(self, r: int) -> int:
        while self.parent[r] != r:
            self.parent[r] = self.parent[self.parent[r]]
            r = self.parent[r]
        return r

    def _leaf(self, lo: int, hi: int) -> dict:
        """The node where rows lo to hi - 1, equal sequences, end."""
        members = [r for r in range(lo, hi) if not self.rows[r][5]]
        return self._node(lo, self.length[lo], hi - lo, min(self.rows[r][4] for r in range(lo, hi)), [self.rows[r][4] for r in members])

    def _node(self, row: int, depth: int, n: int, conv: int, ends: list) -> dict:
        return {"row": row, "depth": depth, "n": n, "conv": conv, "ends": ends, "kids": [], "children": 0, "leaves": 0, "saved": 0}

    def _adopt(self, parent: dict, child: dict) -> None:
        """Hangs a finished component's top below ``parent``, one turn above it."""
        self._close(child, parent)
        parent["children"] += not child["open"]
        if not child["open"]:
            parent["leaves"] += child["leaves"]
            parent["saved"] += child["saved"]

    def _lift(self, node: dict, depth: int) -> dict:
        """Nodes with one child above ``node``, up to ``depth``."""
        while node["depth"] > depth:
            above = self._node(node["row"], node["depth"] - 1, node["n"], node["conv"], [])
            self._adopt(above, node)
            node = above
        return node

    def _merge(self, a: int, b: int, depth: int) -> None:
        """Union of two neighbouring components at their common prefix."""
        left, right = self.top[a], self.top[b]
        if left["depth"] == depth:                        # it is the branching node already, or ends there
            node = left
        else:
            node = self._node(left["row"], depth, 0, left["conv"], [])
            self._join(node, left)
        self._join(node, right)
        self.parent[b], self.top[b] = a, None
        self.top[a] = node

    def _join(self, node: dict, other: dict) -> None:
        below = self._lift(other, node["depth"] + 1)
        node["n"] += below["n"]
        node["conv"] = min(node["conv"], below["conv"])
        self._adopt(node, below)

    def _close(self, node: dict, parent: dict | None) -> None:
        """A node is complete once it gets its parent: it is written, and its
        children learn their parent's conversation."""
        anchor, number, turns, sizes, _, more = self.rows[node["row"]]
        d = node["depth"]
        chars = sizes[d - 1] if d else 0
        node["open"] = d <= self.partial[node["row"]]
        key = node_key(anchor, number, turns, d) if node["open"] else None
        if node["open"]:
            up = node_key(anchor, number, turns, d - 1) if d else None
            below = d == 0 and number > 0                 # the same node as the end of the segment before
            self.parts.append((key, up, None if below else number * SEGMENT + d, None if below else node["conv"],
                               0 if below else node["n"], chars, node["children"], node["leaves"], node["saved"]))
            if node["ends"]:
                self.ends.append((key, ",".join(map(str, node["ends"]))))
        else:
            node["leaves"] += not node["children"]
            node["saved"] += (node["n"] - 1) * chars
            digest = hashlib.sha256(",".join(map(str, node["ends"])).encode()).hexdigest() if node["ends"] else NOTHING
            node["line"] = (node["conv"], number * SEGMENT + d, node["n"], node["children"], node["leaves"], node["saved"], digest)
        for kid in node["kids"]:
            self.nodes.append((*kid, None if node["open"] else node["conv"], key))
        if parent is not None and not node["open"]:
            parent["kids"].append(node["line"])
        node["kids"] = node["ends"] = ()


FOREST = ("kind string, at long, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
          "ends_sha256 string, parent_conv_id long, key binary, parent_key binary, chars long, ids string")
_COLUMNS = [c.split()[0] for c in FOREST.split(", ")]
_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(lines: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x.get(c) for x in lines], _TYPES[t]) for c, t in (f.split() for f in FOREST.split(", "))], names=_COLUMNS)


def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One forest a batch of sorted segments; ``at`` numbers them in the order of the sort."""
    at = TaskContext.get().partitionId() << 32
    for batch in batches:
        if not batch.num_rows:
            continue
        f = Forest(list(zip(*(batch.column(c).to_pylist() for c in ("anchor", "number", "turns", "sizes", "conv", "more")))))
        f.build()
        # children of partial nodes learn their parent's conversation from (at, key)
        lines = [{"kind": "node", "at": at, "conv_id": c, "depth": d, "n_convs": n, "n_children": k, "n_leaves": lv, "saved_tokens": s,
                  "ends_sha256": e, "parent_conv_id": p, "parent_key": up} for c, d, n, k, lv, s, e, p, up in f.nodes]
        lines += [{"kind": "part", "at": at, "key": k, "parent_key": up, "depth": d, "conv_id": c, "n_convs": n, "chars": ch,
                   "n_children": kids, "n_leaves": lv, "saved_tokens": s} for k, up, d, c, n, ch, kids, lv, s in f.parts]
        lines += [{"kind": "ends", "at": at, "key": k, "ids": t} for k, t in f.ends]
        for lo in range(0, len(lines), 10_000):
            yield _batch(lines[lo:lo + 10_000])
        at += 1


# --- Spark -------------------------------------------------------------------

def prints(conversations: DataFrame) -> DataFrame:
    """``conv, turn, print, size`` of each turn: fingerprint of (role, text)
    and code points of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                                F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * PRINT)).alias("print"),
                                F.length(text).cast("long").alias("size")).filter(F.col("conv").isNotNull())


def numbered(turns: DataFrame) -> DataFrame:
    """``conv, pos, print, size``: pos counts a conversation's turns from 1.
    Equal rows are counted before the sort, so no range is made of copies."""
    counted = turns.groupBy("conv", "turn", "print", "size").agg(F.count(F.lit(1)).alias("n"))
    key = ["conv", F.col("turn").asc_nulls_first(), "print"]

    def run(batches):
        part, conv, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            c, n = b.column("conv").to_numpy(), b.column("n").to_numpy()
            if not len(c):
                continue
            new = np.ones(len(c), bool)
            new[1:] = c[1:] != c[:-1]
            new[0] = c[0] != conv
            total = np.cumsum(n)
            first = np.flatnonzero(new)
            base = np.full(len(c), -seen, np.int64)       # what lies before the conversation's first row here
            if len(first):
                own = np.zeros(len(c), np.int64)
                own[first] = np.arange(1, len(first) + 1)
                group = np.maximum.accumulate(own)
                starts = np.concatenate([[0], (total - n)[first]])
                base = np.where(group > 0, starts[group], -seen)
            before = total - n - base
            conv, seen = c[-1], int(before[-1] + n[-1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), part, np.int64)), b.column("conv"), pa.array(before), b.column("n"),
                                              b.column("print"), b.column("size")], names=["part", "conv", "before", "n", "print", "size"])

    ship(turns.sparkSession)
    local = staged(counted.repartitionByRange(*key).sortWithinPartitions(*key).select("conv", "n", "print", "size")
                   .mapInArrow(trimmed(run), fields("part long, conv long, before long, n long, print binary, size long")), "turns")
    # conversations that lie in several ranges: at most two a range, so the carries are a bounded table
    share = local.groupBy("conv", "part").agg(F.sum("n").alias("n"))
    edge = share.groupBy("part").agg(F.min("conv").alias("lo"), F.max("conv").alias("hi"))
    at_edges = edge.select(F.explode(F.array("lo", "hi")).alias("conv"), "part").distinct().join(share, ["conv", "part"])
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = F.broadcast(at_edges.select("conv", "part", F.sum("n").over(before).alias("carry")).filter("carry is not null"))
    out = local.join(carry, ["conv", "part"], "left")
    start = F.col("before") + F.coalesce("carry", F.lit(0)) + 1
    return out.select("conv", F.explode(F.sequence(start, start + F.col("n") - 1)).alias("pos"), "print", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The query's conversations, from ``numbered`` turns: the first h turns
    of conversation c - c % 100 (remainders truncate, as in SQL), then c's own
    after its first h, with h = crc32(decimal c) % 6.  Returns turns as
    ``trie`` takes them."""
    c = F.col("conv")
    h = (F.crc32(c.cast("string").cast("binary")) % 6).cast("long")
    n = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    donors = (turns.filter((c % 100 == 0) & (F.col("pos") <= 5)).groupBy(c.alias("donor"))
              .agg(F.array_sort(F.collect_list(F.struct("pos", "print", "size"))).alias("lead")))      # at most 5 turns
    none = F.array().cast("array<struct<pos:long,print:binary,size:long>>")
    plan = (n.withColumn("h", h).withColumn("donor", c - c % 100).join(donors, "donor", "left")
            .withColumn("lead", F.slice(F.coalesce("lead", none), F.lit(1), F.col("h").cast("int"))))
    plan = plan.select("conv", "h", "lead", (F.size("lead") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long").alias("total"))
    lead = plan.select("conv", "total", F.explode_outer("lead").alias("t")).filter((F.col("total") == 0) | F.col("t").isNotNull())
    own = (turns.join(plan.select("conv", "h", "total", F.size("lead").alias("led")), "conv").filter(F.col("pos") > F.col("h"))
           .select("conv", "total", (F.col("pos") - F.col("h") + F.col("led")).cast("long").alias("pos"), "print", "size"))
    return lead.select("conv", "total", "t.pos", "t.print", "t.size").unionByName(own)


def segments(turns: DataFrame) -> DataFrame:
    """``anchor, number, turns, sizes, conv, more`` of every segment of at
    most SEGMENT turns; a conversation without turns has one, empty."""
    number = F.coalesce(F.floor((F.col("pos") - 1) / SEGMENT), F.lit(0)).cast("long")
    turn = F.when(F.col("pos").isNotNull(), F.struct("pos", "print", "size"))         # collect_list leaves nulls out
    whole = turns.groupBy("conv", number.alias("number")).agg(F.max("total").alias("total"), F.array_sort(F.collect_list(turn)).alias("t"))
    out = whole.select(
        "conv", "number", (F.col("total") > (F.col("number") + 1) * SEGMENT).alias("more"),
        F.aggregate(F.col("t"), F.lit(b""), lambda acc, x: F.concat(acc, x["print"])).alias("turns"),
        F.transform("t", lambda x: x["size"]).alias("sizes"))
    return with_anchors(staged(out, "segments"))


def with_anchors(segs: DataFrame) -> DataFrame:
    """Adds ``anchor``: for segments after the first, the hashes of the
    earlier ones added up (in two steps, so no task takes a whole conversation)."""
    spark = segs.sparkSession
    first = segs.filter("number = 0").withColumn("anchor", F.lit(ROOT))
    later = segs.filter("number > 0")
    if later.isEmpty():
        return first
    ship(spark)

    def run(batches):
        for b in batches:
            pair = [seg_hash(n, t) for n, t in zip(b.column("number").to_pylist(), b.column("turns").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("number"), pa.array([p[0] for p in pair], pa.int64()),
                                              pa.array([p[1] for p in pair], pa.int64())], names=["conv", "number", "x", "y"])

    hashes = segs.filter("more").select("conv", "number", "turns").mapInArrow(trimmed(run), fields("conv long, number long, x long, y long"))
    hashes = staged(hashes.withColumn("block", F.floor(F.col("number") / 1024)), "segment-hashes")
    wide = [F.col(c).cast("decimal(38,0)") for c in ("x", "y")]
    inside = Window.partitionBy("conv", "block").orderBy("number")
    run_in = hashes.select("conv", "block", (F.col("number") + 1).alias("number"), *[F.sum(w).over(inside).alias(f"i{k}") for k, w in enumerate(wide)])
    per_block = hashes.groupBy("conv", "block").agg(*[F.sum(w).alias(f"s{k}") for k, w in enumerate(wide)])
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per_block = per_block.select("conv", "block", *[F.coalesce(F.sum(f"s{k}").over(before), F.lit(0).cast("decimal(38,0)")).alias(f"b{k}") for k in (0, 1)])
    half = [F.lpad(F.hex(F.pmod(F.col(f"i{k}") + F.col(f"b{k}"), F.lit(Decimal(1 << 63))).cast("long")), 16, "0") for k in (0, 1)]
    anchors = run_in.join(per_block, ["conv", "block"]).select("conv", "number", F.unhex(F.concat(*half)).alias("anchor"))
    return first.unionByName(later.join(anchors, ["conv", "number"]))


def _streamed_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's texts, joined by commas, from rows sorted by key and order."""
    key, digest, keys, out = None, None, [], []

    def done():
        if key is not None:
            keys.append(key)
            out.append(digest.hexdigest())

    for b in batches:
        for k, text in zip(b.column("key").to_pylist(), b.column("ids").to_pylist()):
            if k != key:
                done()
                key, digest = k, hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        if len(keys) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out)], names=["key", "ends_sha256"])
            keys, out = [], []
    done()
    if keys:
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out)], names=["key", "ends_sha256"])


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """``nodes`` (key, parent_key, leaves, saved; parent_key null at the top)
    -> ``key, leaves, saved`` summed over each node's subtree, by pointer
    doubling: after k rounds a node holds what lies less than 2**k below."""
    now = staged(nodes.select("key", F.col("parent_key").alias("up"), "leaves", "saved"), "sums")
    while not now.filter(F.col("up").isNotNull()).isEmpty():
        given = now.filter(F.col("up").isNotNull()).groupBy(F.col("up").alias("key")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        jump = now.select(F.col("key").alias("up"), F.col("up").alias("far"))
        now = staged(now.join(given, "key", "left").join(jump, "up", "left").select(
            "key", F.col("far").alias("up"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")), "sums")
    return now.drop("up")


RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(turns: DataFrame) -> DataFrame:
    """One row a node of the trie of the conversations given by ``turns``:
    conv, total (turns of the conversation), pos (from 1; null in the only
    row of a conversation without turns), print, size."""
    spark = turns.sparkSession
    order = ["anchor", "turns", "conv"]
    segs = segments(turns).select("anchor", "number", "turns", "sizes", "conv", "more")
    ship(spark)
    built = staged(segs.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(trimmed(forests), fields(FOREST)), "forests")
    parts = built.filter("kind = 'part'")
    merged = staged(parts.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.max("chars").alias("chars"), F.sum("n_children").alias("inner"), F.sum("n_leaves").alias("inner_leaves"),
        F.sum("saved_tokens").alias("inner_saved")), "merged")
    kids = merged.filter(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("kids"))
    known = staged(merged.join(kids, "key", "left").withColumn("n_children", F.col("inner") + F.coalesce("kids", F.lit(0))), "known")
    own = known.select("key", "parent_key", (F.col("inner_leaves") + (F.col("n_children") == 0).cast("long")).alias("leaves"),
                       (F.col("inner_saved") + F.greatest(F.col("n_convs") - 1, F.lit(0)) * F.col("chars")).alias("saved"))
    ends = (built.filter("kind = 'ends'").select("key", "at", "ids").repartition("key").sortWithinPartitions("key", "at")
            .mapInArrow(trimmed(_streamed_digests), fields("key binary, ends_sha256 string")))
    above = known.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    partial = (known.join(subtree_sums(own), "key").join(ends, "key", "left").join(above, "parent_key", "left")
               .withColumns({"n_leaves": F.col("leaves"), "saved_tokens": F.col("saved"),
                             "ends_sha256": F.coalesce("ends_sha256", F.lit(NOTHING))}))
    # a finished node below a partial one: few partial nodes a forest, so the join's keys hold one forest's rows at most
    named = parts.select("at", "key").join(known.select("key", F.col("conv_id").alias("above")), "key").select("at", F.col("key").alias("parent_key"), "above").distinct()
    inner = built.filter("kind = 'node'")
    below = inner.filter(F.col("parent_key").isNotNull()).join(named, ["at", "parent_key"]).withColumn("parent_conv_id", F.col("above"))
    return (inner.filter(F.col("parent_key").isNull()).select(RESULT).unionByName(below.select(RESULT)).unionByName(partial.select(RESULT)))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = staged(numbered(prints(read(spark, sf_dir, "conversations"))), "numbered")
    return trie(rebuilt(turns))
