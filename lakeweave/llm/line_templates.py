"""Operator 5: line deduplication by a log-template tree.

A line is parsed down a tree of fixed depth: its number of tokens, its two
leading tokens, and three more tokens at fixed places of lines of that
length.  Tokens with a digit are variable fields (one wildcard); all tokens
off the path are generalised.  A node is a recurring template when enough
different documents reach it; its tokens are then the ones most of its
lines have at each place, the others wildcards, and most places must be
constant.  Lines that agree with a template's constants are dropped.  Two
trees with different places catch templates whose variable fields lie on
one path.  A line of one or two tokens is its own template, digits included,
and is parsed down the first tree only.

Copies of whole documents are not boilerplate (near-duplicates are another
operator's work), so a node's documents are counted after copies are
collapsed: what is left of a document without the line has ``BANDS``
fingerprints, each of ``ROWS`` smallest hashes of its 3-word shingles, and a
document counts when no smaller one of the node shares any of them.  However
many copies one of the documents has, the others count.

A template must be reached by at least ``MIN_DOCS`` documents, at every size
of the corpus.

Scale: nodes, templates and marks of lines are tables in Spark, joined and
never collected.  A pass over the texts counts the lines of each node; nodes
with enough go into a bitmap of ``BITS`` bits, the only thing sent to tasks,
and only their lines (and the few others that the bitmap cannot tell) leave
the texts in the next pass.  What decides is exact: counts of different
documents, the tokens of templates by distinct lines, the lines that agree.
A template's tokens come from a majority vote over whole token arrays that
merges batch by batch, and one counting pass; no row is made of a token.
Those lines are marked by document fingerprint and joined to the texts, which
is the only time texts are shuffled.

Defined cases: a null text stays null, an empty one empty, both without
lines.  Lines without a token are kept and not counted.  A line that repeats inside one
document counts once.  Repeated rows count as documents.  An empty table
gives an empty result.  Own columns of the table are passed through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import fields, fresh, on_text, read, ship, staged, trimmed
from .pieces import spread

MIN_DOCS = 10
SHORT = 2              # tokens of lines that are compared as they are
BITS = 1 << 26         # bits of the bitmap of node and line hashes that tasks get
AGREE = 0.8            # share of a template's constants that a line must have
CONSTANT = 0.6         # share of places that must be constant
BANDS, ROWS = 5, 3     # fingerprints of a document's rest, and smallest hashes in each
PLACES = ((1 / 6, 1 / 2, 5 / 6), (0.34, 0.67, 0.99))

_WILD = np.uint64(0x5851F42D4C957F2D)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(5).integers(0, 1 << 63, BANDS * ROWS, dtype=np.int64).astype(np.uint64)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


class Lines:
    """Lines with a token of one slice."""

    def __init__(self, b: np.ndarray, off: np.ndarray):
        w = tb.Words(b, off)
        digits = np.concatenate([[0], np.cumsum(_DIGIT[b])])
        self.raw = w.hash
        start, end = tb.runs(b != 10, off)
        first = np.searchsorted(w.start, start)
        count = np.searchsorted(w.start, end) - first
        variable = (digits[w.end] > digits[w.start]) & np.repeat(count > SHORT, count)
        self.token = np.where(variable, _WILD, w.hash)
        has = count > 0
        self.start, self.end, self.first, self.count = start[has], end[has], first[has], count[has]
        self.doc = np.searchsorted(off, self.start, "right") - 1

    def documents(self) -> np.ndarray:
        """Fingerprint of the document of each line."""
        begin = np.flatnonzero(np.diff(self.doc, prepend=-1))
        place = np.arange(len(self.raw)) - np.repeat(self.first[begin], np.diff(np.append(self.first[begin], len(self.raw))))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tb.mix(self.raw + place.astype(np.uint64) * _STEP))])
        last = np.append(begin[1:], len(self.doc)) - 1
        return np.repeat(tb.mix(total[self.first[last] + self.count[last]] - total[self.first[begin]]), last - begin + 1)

    def hashes(self) -> np.ndarray:
        """Fingerprint of each line's tokens."""
        place = spread(np.zeros(len(self.count), np.int64), self.count).astype(np.uint64)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tb.mix(self.token + place * _STEP))])
        return tb.mix((total[self.first + self.count] - total[self.first]) * _STEP + self.count.astype(np.uint64))

    def bands(self) -> np.ndarray:
        """``BANDS`` fingerprints of each line's document without that line
        (and its repetitions); similar rests share most of them."""
        if not len(self.doc):
            return np.zeros((0, BANDS), np.uint64)
        n = len(self.raw)
        left = np.repeat(self.first + self.count, self.count) - np.arange(n)
        h = self.raw
        for j in (1, 2):
            after = np.zeros(n, np.uint64)
            after[:max(n - j, 0)] = self.raw[j:]
            h = tb.mix(h * _STEP + np.where(left > j, after, np.uint64(0)) + np.uint64(j))
        short = np.repeat(self.count < 3, self.count) & (left == np.repeat(self.count, self.count))
        h = h[(left >= 3) | short]
        at = np.concatenate([[0], np.cumsum(np.maximum(self.count - 2, 1))])[:-1]
        begin = np.flatnonzero(np.diff(self.doc, prepend=-1))
        size = np.diff(np.append(begin, len(self.doc)))
        out = np.repeat(np.arange(BANDS, dtype=np.uint64)[None, :], len(self.doc), axis=0)
        for i, seed in enumerate(_SEEDS):
            least = np.minimum.reduceat(tb.mix(h ^ seed), at)
            own = least == np.repeat(np.minimum.reduceat(least, begin), size)
            rest = np.repeat(np.minimum.reduceat(np.where(own, _NONE, least), begin), size)
            rest = np.where(own, rest, np.repeat(np.minimum.reduceat(least, begin), size))
            out[:, i // ROWS] = tb.mix(out[:, i // ROWS] * _STEP + rest)
        return out

    def nodes(self, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """Lines of one tree, and their node in it."""
        at = np.flatnonzero((self.count > SHORT) | (tree == 0))
        first, count = self.first[at], self.count[at]
        end = first + count - 1
        h = tb.mix(count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tree + 1))
        for place in (first, first + 1, *(first + 2 + ((count - 2) * f).astype(np.int64) for f in PLACES[tree])):
            h = tb.mix(h * np.uint64(0x9E3779B97F4A7C15) + self.token[np.clip(place, first, end)])
        return at, h


def _slices(batch, column: int):
    data, off = tb.flat(batch.column(column))
    return tb.slices(data, off)


def _first(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct row of ``keys`` occurs first, and how often."""
    if not len(keys[0]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    at = np.flatnonzero(new)
    return order[at], np.diff(np.append(at, len(order)))


def _lists(values: np.ndarray, size: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(tb.signed(values)))


def bitmap(keys: DataFrame) -> np.ndarray:
    """``BITS`` bits, those of the hashes in the only column of ``keys`` set."""
    key = F.col(keys.columns[0])
    bit = F.expr(f"shiftleft(1L, cast(`{keys.columns[0]}` & 63 as int))")
    words = (keys.select(F.shiftrightunsigned(key.bitwiseAND(F.lit(BITS - 1)), 6).cast("int").alias("word"), bit.alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow())          # at most BITS / 64 rows
    out = np.zeros(BITS >> 6, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bit").to_numpy().view(np.uint64)
    return out


def _hit(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    h = h & np.uint64(BITS - 1)
    return (bits[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) > 0


def different(held: DataFrame) -> DataFrame:
    """``node, n``: documents of each node that are no copies of each other,
    from the rows ``node, doc, band``."""
    first = held.groupBy("node", "band").agg(F.min("doc").alias("doc"))
    return (first.groupBy("node", "doc").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == BANDS)
            .groupBy("node").agg(F.count(F.lit(1)).alias("n")))


def often(src: DataFrame, min_docs: int) -> DataFrame:
    """Nodes of both trees that enough documents reach, copies included."""

    def run(batch):
        for _, b, o in _slices(batch, 0):
            x = Lines(b, o)
            for tree in range(len(PLACES)):
                at, node = x.nodes(tree)
                once, _ = _first(node, x.doc[at])
                first, n = _first(node[once])
                yield pa.RecordBatch.from_arrays([pa.array(tb.signed(node[once][first])), pa.array(n)], names=["node", "n"])

    return (on_text(src, run, fields("node long, n long")).groupBy("node").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= min_docs).select("node"))


def held(src: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, line, doc, bands, tokens`` of the lines of ``nodes`` (and of a
    few more nodes, each with all its lines); a line that repeats in a document
    is there once."""
    shared = src.sparkSession.sparkContext.broadcast(bitmap(nodes))

    def run(batch):
        for _, b, o in _slices(batch, 0):
            x = Lines(b, o)
            found = [(at, node) for at, node in map(x.nodes, range(len(PLACES)))]
            found = [(at[hit], node[hit]) for at, node in found for hit in [_hit(shared.value, node)]]
            if not any(len(at) for at, _ in found):
                continue
            docs, lines, bands = x.documents(), x.hashes(), x.bands()
            for at, node in found:
                once, _ = _first(node, lines[at], docs[at])
                at, node = at[once], node[once]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tb.signed(node)), pa.array(tb.signed(lines[at])), pa.array(tb.signed(docs[at])),
                     _lists(bands[at].ravel(), np.full(len(at), BANDS)), _lists(x.token[spread(x.first[at], x.count[at])], x.count[at])],
                    names=["node", "line", "doc", "bands", "tokens"])

    return on_text(src, run, fields("node long, line long, doc long, bands array<long>, tokens array<long>"))


def _tokens(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of an array column, and their number in each row."""
    col = batch.column(name)
    return col.flatten().to_numpy(zero_copy_only=False), pa.compute.list_value_length(col).to_numpy(zero_copy_only=False).astype(np.int64)


def _by_place(node: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different nodes of some rows, where each occurs first, its number for
    every row, and for every token its place among all nodes' places (the
    lines of a node are equally long)."""
    nodes, first, which = np.unique(node, return_index=True, return_inverse=True)
    begin = np.concatenate([[0], np.cumsum(size[first])])
    return nodes, first, which, np.repeat(begin[which], size) + spread(np.zeros(len(size), np.int64), size)


def _vote(node: np.ndarray, tokens: np.ndarray, size: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
    """``node, tokens, weights``: each place's heaviest token of each node,
    with how much it outweighs all others together (0 if it does not).

    Such votes may be voted on again: a token of more than half of all weight
    outweighs the others in the sum of any parts' votes (the majority vote of
    Boyer and Moore, merged), so it comes out of them; whether it has half
    is counted afterwards."""
    nodes, first, _, at = _by_place(node, size)
    order = np.lexsort((tokens, at))
    new = np.ones(len(order), bool)
    new[1:] = (at[order][1:] != at[order][:-1]) | (tokens[order][1:] != tokens[order][:-1])
    begin = np.flatnonzero(new)
    sums = np.add.reduceat(weight[order], begin) if len(begin) else np.zeros(0, np.int64)
    place, token = at[order][begin], tokens[order][begin]
    heavy = np.lexsort((-sums, place))
    lead = np.ones(len(heavy), bool)
    lead[1:] = place[heavy][1:] != place[heavy][:-1]
    top = heavy[lead]
    all_ = np.bincount(place, weights=sums, minlength=len(top)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(nodes), _lists(token[top], size[first]), _lists(np.maximum(2 * sums[top] - all_, 0), size[first])],
                                      names=["node", "tokens", "weights"])


def _sum(node: np.ndarray, values: np.ndarray, size: np.ndarray, lines: np.ndarray) -> pa.RecordBatch:
    """``node, right, lines`` added up by node."""
    nodes, first, which, at = _by_place(node, size)
    total = np.bincount(at, weights=values, minlength=int(size[first].sum())).astype(np.int64)
    n = np.bincount(which, weights=lines, minlength=len(nodes)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(nodes), _lists(total, size[first]), pa.array(n)], names=["node", "right", "lines"])


def _merged(parts: DataFrame, merge) -> DataFrame:
    """Rows of one node merged: first in every batch where they lie (so a hot
    node gives a row a batch), then with all rows of the node together."""

    def local(batches):
        for batch in batches:
            if batch.num_rows:
                yield merge(batch)

    def whole(batches):
        held = None                                      # rows of the node that may go on
        for batch in batches:
            table = pa.Table.from_batches([b for b in (held, batch) if b is not None]).combine_chunks()
            if not table.num_rows:
                continue
            node = table.column("node").to_numpy()
            done = int(np.searchsorted(node, node[-1]))
            if done:
                yield merge(table.slice(0, done).combine_chunks().to_batches()[0])
            held = merge(table.slice(done).combine_chunks().to_batches()[0])
        if held is not None:
            yield held

    spark, schema = parts.sparkSession, parts.schema
    ship(spark)
    near = parts.mapInArrow(trimmed(local), schema)
    return near.repartition("node").sortWithinPartitions("node").mapInArrow(trimmed(whole), schema)


def dropped(src: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``line``: the lines that agree with a template."""
    rows = staged(held(src, often(src, min_docs)), "held")
    nodes = staged(different(rows.select("node", "doc", F.explode("bands").alias("band")))
                   .filter(F.col("n") >= min_docs).select("node"), "nodes")
    # each different line once, with the number of different texts that have it
    lines = staged(rows.join(nodes, "node", "left_semi").groupBy("node", "line", "doc").agg(F.first("tokens").alias("tokens"))
                   .groupBy("node", "line").agg(F.count(F.lit(1)).alias("n"), F.first("tokens").alias("tokens")), "lines")

    # the token that may be the one of most lines of a node at each place
    def vote(batch):
        tokens, size = _tokens(batch, "tokens")
        return _vote(batch.column("node").to_numpy(), tokens, size, _tokens(batch, "weights")[0])

    votes = _merged(lines.select("node", "tokens", F.transform("tokens", lambda _: F.col("n")).alias("weights")), vote)
    # whether it is: its lines, counted
    both = lines.join(votes.select("node", F.col("tokens").alias("often")), "node")

    def add(batch):
        right, size = _tokens(batch, "right")
        return _sum(batch.column("node").to_numpy(), right, size, batch.column("lines").to_numpy())

    counts = _merged(both.select("node", F.zip_with("tokens", "often", lambda t, o: F.when(t == o, F.col("n")).otherwise(F.lit(0).cast("long"))).alias("right"),
                                 F.col("n").alias("lines")), add)
    constant = counts.select("node", F.transform("right", lambda r: r * 2 > F.col("lines")).alias("constant"))
    fixed = F.size(F.filter("constant", lambda c: c))
    templates = constant.withColumn("fixed", fixed).filter(F.col("fixed") >= CONSTANT * F.size("constant"))
    agree = F.size(F.filter(F.arrays_zip(F.col("tokens"), F.col("often"), F.col("constant")), lambda x: x["constant"] & (x["tokens"] == x["often"])))
    return both.join(templates, "node").filter(agree >= AGREE * F.col("fixed")).select("line").distinct()


def _fingerprint(text) -> list:
    return [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2")]


def marks(src: DataFrame, lines: DataFrame) -> DataFrame:
    """``_h1, _h2, _gone``: fingerprint of each different text with lines to
    drop, and those lines."""
    shared = src.sparkSession.sparkContext.broadcast(bitmap(lines))

    def run(batch):
        h1, h2 = (batch.column(i).to_numpy() for i in (1, 2))
        for i, b, o in _slices(batch, 0):
            x = Lines(b, o)
            line = x.hashes()
            at = np.flatnonzero(_hit(shared.value, line))
            line, one, two = line[at], h1[i + x.doc[at]], h2[i + x.doc[at]]
            at, _ = _first(line, one, two)
            yield pa.RecordBatch.from_arrays([pa.array(one[at]), pa.array(two[at]), pa.array(tb.signed(line[at]))],
                                             names=["_h1", "_h2", "line"])

    found = on_text(src.select("text", *_fingerprint(F.col("text"))), run, fields("_h1 long, _h2 long, line long")).distinct()
    return found.join(lines, "line", "left_semi").groupBy("_h1", "_h2").agg(F.collect_set("line").alias("_gone"))


def _flat_lists(col: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and begins of the lists of a column; a null is empty."""
    size = pa.compute.fill_null(pa.compute.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    return col.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.concatenate([[0], np.cumsum(size)]).astype(np.int64)


def _in(doc: np.ndarray, line: np.ndarray, in_doc: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Which of the lines are marked in their document."""
    order = np.lexsort((np.concatenate([np.zeros(len(in_doc)), np.ones(len(doc))]), np.concatenate([marked, line]),
                        np.concatenate([in_doc, doc])))
    d, h = np.concatenate([in_doc, doc])[order], np.concatenate([marked, line])[order]
    new = np.ones(len(order), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    lead = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
    hit = (order >= len(marked)) & (lead < len(marked))
    return np.sort(order[hit] - len(marked))


def without_templates(df: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """Every row of ``df`` with ``n_lines, n_dropped`` put before its own
    columns, and the text without recurring lines; columns of ``df`` named
    like the new ones are dropped."""
    spark = df.sparkSession
    ship(spark)
    src = df.select(F.col(text_col).cast("string").alias("text"))
    gone_by_text = staged(marks(src, staged(dropped(src, min_docs), "dropped")), "marks")
    mine = ("n_lines", "n_dropped")
    own = df.select(*[F.col(c).cast("string").alias(c) if c == text_col else F.col(c) for c in df.columns if c.lower() not in mine])
    at = own.columns.index(text_col)
    schema = fields("n_lines long, n_dropped long")
    for f in own.schema.fields:
        schema = schema.add(f)
    n_own = len(own.columns)
    key, gone_col = [fresh(own, x) for x in ("_h1", "_h2")], fresh(own, "_gone")
    keyed = own.select("*", *[h.alias(k) for h, k in zip(_fingerprint(F.col(text_col)), key)])
    right = gone_by_text.select(*[F.col(h).alias(f"{k}_r") for h, k in zip(("_h1", "_h2"), key)], F.col("_gone").alias(gone_col))
    marked = (keyed.join(right, [F.col(k) == F.col(f"{k}_r") for k in key], "left")
              .select(*[F.col(c) for c in own.columns], gone_col))

    def run(batch):
        text, lines, dropped = [], [], []
        marked_lines, begin = _flat_lists(batch.column(n_own))
        for i, b, o in _slices(batch, at):
            n = len(o) - 1
            x = Lines(b, o)
            which = marked_lines[begin[i]:begin[i + n]]
            doc = np.repeat(np.arange(n), np.diff(begin[i:i + n + 1]))
            gone = _in(x.doc, x.hashes(), doc, which)
            start, end = x.start[gone].copy(), x.end[gone].copy()
            after = end < o[x.doc[gone] + 1]                          # a line feed follows in the same text
            end[after] += 1
            before = ~after & (start > o[x.doc[gone]])               # the last line: the one in front goes
            start[before] -= 1
            cut = np.zeros(len(b) + 1, np.int64)
            np.add.at(cut, start, 1)
            np.add.at(cut, end, -1)
            keep = np.cumsum(cut[:-1]) == 0
            size = np.concatenate([[0], np.cumsum(keep)])[o]
            text.append(pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(size.astype(np.int64)),
                                                                     pa.py_buffer(np.ascontiguousarray(b[keep]))]).cast(pa.string()))
            lines.append(np.bincount(x.doc, minlength=n))
            dropped.append(np.bincount(x.doc[gone], minlength=n))
        cols = list(batch.columns)[:n_own]
        old = cols[at]
        new = pa.concat_arrays(text)
        cols[at] = pa.compute.if_else(old.is_null(), pa.scalar(None, pa.string()), new) if old.null_count else new
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lines)), pa.array(np.concatenate(dropped)), *cols], names=schema.names)

    return on_text(marked, run, schema)


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_templates(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars_kept"),
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
