"""Operator 2: exact repeats by a run-length index.

A byte is removed when a string of ``LENGTH`` bytes that covers it also
starts earlier: in a document with a smaller id, or earlier in the same one.
Strings are judged on the input.

1. Every window of LENGTH bytes picks the smallest hash of its GRAM-byte
   grams as anchor, so equal windows have the same anchor at the same
   place.  Neighbouring windows with one anchor are a context.  Equal
   contexts are told by fingerprints of anchor and content; all but the
   earliest are wholly repeated.  This is done inside each share of
   8 MB first, so a passage that many documents share is shuffled once a
   share, not once a document.
2. Different contexts of one anchor may still share windows.  Only those are
   fetched, and a run-length index of blocks of such groups (``RunIndex``)
   streams matching statistics over them: windows whose match reaches
   LENGTH form classes, of which the earliest window stays.
3. Marked stretches go back to their documents.

Scale: about one row of 32 bytes for every 35 bytes of text is shuffled,
texts only if their document has a context to look at or a mark (known from
a bitmap of fixed size; what it lets through too much costs time only).
Blocks hold ``BLOCK`` bytes; an anchor with more contexts than that is
settled by counting window fingerprints in Spark instead, which needs no
group in one place.

Defined cases: a null text is empty; texts shorter than LENGTH are kept
whole.  Rows that repeat an id and text are one document, and none of them
is earlier.  Rows without an id come before all others.  An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import fields, fresh, on_text, read, ship, staged, trimmed
from .pieces import spread
from .run_index import RunIndex

LENGTH = 100
GRAM = 32
BLOCK = 1 << 20
SHARE = 1 << 23          # bytes of text whose contexts a task settles among themselves
BITS = 24
NO_ID = -(1 << 63)

# one number for a context: start, windows in it (less one), 24 bits of the text's fingerprint
_START, _SPAN = 31, 24


def contexts(b: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Contexts of one slice: document, first and last window start (in the
    slice), anchor fingerprint, content fingerprint."""
    n, windows = len(b), length - gram + 1
    per_doc = np.maximum(np.diff(off) - length + 1, 0)
    if not per_doc.any():
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    p, inv = tb.powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(tb.TABLE[b] * p, out=sums[1:])
    grams = tb.mix((sums[gram:] - sums[:-gram]) * inv[:n - gram + 1])
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while span * 2 <= windows:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = windows - span
    if rest:
        low = np.minimum(low[:-rest], low[rest:])
    start = spread(off[:-1], per_doc)
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    anchor = (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.ones(len(start), bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    s1, s2, at_anchor = start[at], start[np.append(at[1:], len(start)) - 1], anchor[at]
    content = (sums[s2 + length] - sums[s1]) * inv[s1]
    content = tb.mix(content + tb.mix(((s2 - s1) * 256 + (at_anchor - s1) + 1).astype(np.uint64)))
    content[content == 0] = 1                            # 0 marks a row that is settled already
    return doc[at], s1, s2, grams[at_anchor], content


MARK, LOOK, WINDOW = 0, 1, 2
_ROWS = "kind int, a long, c long, doc_id long, place long"


def _merge_marks(doc, start, end, print_):
    """Rows (doc, fingerprint, start, length) of merged stretches."""
    order = np.lexsort((start, print_, doc))
    doc, start, end, print_ = doc[order], start[order], end[order], print_[order]
    if not len(doc):
        return doc, print_, start, end
    group = np.ones(len(doc), bool)
    group[1:] = (doc[1:] != doc[:-1]) | (print_[1:] != print_[:-1])
    number = np.cumsum(group) - 1
    shift = number * (int(end.max()) + 1)                # keeps groups apart in one running maximum
    reach = np.maximum.accumulate(end + shift)
    new = group.copy()
    new[1:] |= (start + shift)[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], print_[at], start[at], np.maximum.reduceat(end, at) - start[at]


def _batch(kind, a, c, doc, place):
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(kind, np.int32)), pa.array(np.asarray(a).view(np.int64)),
                                       pa.array(np.asarray(c).view(np.int64)), pa.array(np.asarray(doc, np.int64)),
                                       pa.array(np.asarray(place, np.int64))], names=["kind", "a", "c", "doc_id", "place"])


def _mark_rows(doc, print_, start, length):
    """A settled stretch: a = start and length, place = fingerprint of the text."""
    return _batch(np.zeros(len(doc)), (start << 31) | length, np.zeros(len(doc), np.int64), doc, print_)


def first_pass(src: DataFrame) -> DataFrame:
    """Contexts of ``doc_id, text, print`` and marks settled inside batches."""

    def run(batch):
        data, off = tb.flat(batch.column(1))
        ids = batch.column(0).to_numpy()
        prints = batch.column(2).to_numpy()
        for first, piece, piece_off in tb.slices(data, off, SHARE):
            parts = []
            for i, b, o in tb.slices(piece, piece_off):
                doc, s1, s2, a, c = contexts(b, o)
                parts.append((doc + first + i, s1 - o[doc], s2 - s1, a, c))
            doc, start, more, a, c = (np.concatenate(x) for x in zip(*parts))
            if len(doc):
                yield from settled_here(ids[doc], prints[doc], start, more, a, c)

    def settled_here(who, print_, start, more, a, c):
        order = np.lexsort((start, who, c, a))
        same = np.zeros(len(order), bool)
        same[1:] = (a[order][1:] == a[order][:-1]) & (c[order][1:] == c[order][:-1])
        # rows of one id at one start are the same place (repeated rows): not earlier than each other
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        lead = order[first]
        later = same & ((who[order] != who[lead]) | (start[order] != start[lead]))
        done = order[later]
        keep = order[~same]
        yield _batch(np.ones(len(keep)), a[keep], c[keep], who[keep], (start[keep] << _START) | (more[keep] << _SPAN) | print_[keep])
        if len(done):
            d, p, s, n = _merge_marks(who[done], start[done], start[done] + more[done] + LENGTH, print_[done])
            yield _mark_rows(d, p, s, n)

    return on_text(src, run, fields(_ROWS))


def settle(rows: DataFrame) -> DataFrame:
    """Marks contexts equal to an earlier one; keeps, of anchors with several
    different contexts, the earliest of each (kind LOOK)."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "a").sortWithinPartitions("a", "c", "doc_id", "place")

    def run(batches):
        held = None                                      # open anchor: rows that may still be needed
        held_out = False                                 # its contexts are known to differ, and held was given out
        for batch in batches:
            a, c, doc, place = (batch.column(i).to_numpy() for i in (1, 2, 3, 4))
            old = 0
            if held is not None:
                old = len(held[0])
                a, c, doc, place = (np.concatenate([h, x]) for h, x in zip(held, (a, c, doc, place)))
            n = len(a)
            settled = c == 0
            new_a = np.ones(n, bool)
            new_a[1:] = a[1:] != a[:-1]
            new_c = new_a.copy()
            new_c[1:] |= c[1:] != c[:-1]
            group = np.cumsum(new_a) - 1
            several = np.bincount(group, new_c & ~settled) > 1
            if old and held_out:
                several[0] = True
            lead = np.maximum.accumulate(np.where(new_c, np.arange(n), 0))
            later = ~new_c & ~settled & ((doc != doc[lead]) | ((place >> _START) != (place[lead] >> _START)))
            later[:old] = False
            last = group == group[-1]
            look = new_c & ~settled & several[group]
            if old and held_out:
                look[:old] = False
            if look.any():
                yield _batch(np.ones(int(look.sum())), a[look], c[look], doc[look], place[look])
            if later.any():
                s = place[later] >> _START
                d, p, s, m = _merge_marks(doc[later], s, s + ((place[later] >> _SPAN) & 127) + LENGTH, place[later] & 0xFFFFFF)
                yield _mark_rows(d, p, s, m)
            out = settled.copy()
            out[:old] = False
            if out.any():
                yield _batch(np.zeros(int(out.sum())), a[out], c[out], doc[out], place[out])
            # of the last anchor the newest leading row is enough: its contexts come in order
            held_out = bool(several[group[-1]])
            keep = np.flatnonzero(last & new_c)[-1:]
            held = tuple(x[keep] for x in (a, c, doc, place))

    ship(spark)
    return rows.mapInArrow(trimmed(run), fields(_ROWS))


def fetch(look: DataFrame, src: DataFrame) -> DataFrame:
    """``a, doc_id, place, data``: the bytes of the contexts to look at."""
    wanted = look.groupBy("doc_id", (F.col("place").bitwiseAND(F.lit(0xFFFFFF))).alias("print")).agg(
        F.collect_list(F.struct("a", "place")).alias("c"))           # at most a 35th of the document's bytes
    texts = possible(src, look, "doc_id")
    joined = texts.join(wanted, ["doc_id", "print"]).select("doc_id", "text", F.col("c.a").alias("a"), F.col("c.place").alias("place"))

    def run(batch):
        data, off = tb.flat(batch.column(1))
        n = np.diff(batch.column(2).offsets.to_numpy())
        a, place = (batch.column(i).flatten().to_numpy() for i in (2, 3))
        doc = np.repeat(np.arange(len(n)), n)
        start, size = place >> _START, ((place >> _SPAN) & 127) + LENGTH
        for i in range(0, len(a), 20_000):
            s, z, d = start[i:i + 20_000], size[i:i + 20_000], doc[i:i + 20_000]
            raw = data[spread(off[d] + s, z)]
            at = np.concatenate([[0], np.cumsum(z)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[i:i + 20_000]), batch.column(0).take(pa.array(d)), pa.array(place[i:i + 20_000]),
                 pa.Array.from_buffers(pa.binary(), len(z), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(raw))])],
                names=["a", "doc_id", "place", "data"])

    return on_text(joined, run, fields("a long, doc_id long, place long, data binary"))


def _indexed(doc, place, data, off):
    """Marks of one block: windows whose class has an earlier window."""
    index = RunIndex(data, off)
    text, start, cls = index.classes(LENGTH)
    if not len(text):
        return None
    who, at = doc[text], (place[text] >> _START) + start
    order = np.lexsort((at, who, cls))
    same = np.zeros(len(order), bool)
    same[1:] = cls[order][1:] == cls[order][:-1]
    lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    later = order[same & ((who[order] != who[lead]) | (at[order] != at[lead]))]
    return _merge_marks(who[later], at[later], at[later] + LENGTH, place[text[later]] & 0xFFFFFF)


def match(found: DataFrame, block: int = BLOCK) -> DataFrame:
    """Runs the index over blocks of whole anchor groups; groups larger than a
    block give fingerprints of their windows (kind WINDOW)."""
    spark = found.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = found.repartition(parts, "a").sortWithinPartitions("a")

    def windows(a, doc, place, data, off):
        size = np.diff(off)
        n = size - LENGTH + 1
        at = spread(off[:-1], n)
        p, inv = tb.powers(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(tb.TABLE[data] * p, out=sums[1:])
        h = tb.mix((sums[at + LENGTH] - sums[at]) * inv[at])
        t = np.repeat(np.arange(len(n)), n)
        return _batch(np.full(len(at), WINDOW), h, a[t], doc[t], (((place[t] >> _START) + at - off[t]) << _START) | (place[t] & 0xFFFFFF))

    def run(batches):
        parts_, size, large = [], 0, None                # groups waiting; large: an anchor beyond a block

        def cut(upto):
            nonlocal parts_, size
            a, doc, place = (np.concatenate([x[i] for x in parts_]) for i in range(3))
            data, off = tb.flat(pa.chunked_array([x[3] for x in parts_]))
            k = len(a) if upto is None else int(np.searchsorted(a, upto))
            head = (a[:k], doc[:k], place[:k], data[:off[k]], off[:k + 1])
            rest = pa.chunked_array([x[3] for x in parts_]).combine_chunks()
            rest = rest if isinstance(rest, pa.Array) else pa.concat_arrays(rest.chunks)
            parts_ = [(a[k:], doc[k:], place[k:], rest.slice(k))] if k < len(a) else []
            size = int(off[-1] - off[k])
            return head

        for batch in batches:
            a, doc, place = (batch.column(i).to_numpy() for i in range(3))
            parts_.append((a, doc, place, batch.column(3)))
            size += int(batch.column(3).nbytes)
            if size < block:
                continue
            last = a[-1]
            if parts_[0][0][0] != last:                  # all groups before the open one
                g = cut(last)
                for x in _blocks(*g, block):
                    yield from large_or_index(x, windows, block, large)
                large = None
            if size >= block:                            # the open group alone is larger
                large = last
                yield windows(*cut(None))
        if parts_:
            for x in _blocks(*cut(None), block):
                yield from large_or_index(x, windows, block, large)

    ship(spark)
    return found.mapInArrow(trimmed(run), fields(_ROWS))


def _blocks(a, doc, place, data, off, block):
    """Cuts ordered groups into blocks of whole groups."""
    i, n = 0, len(a)
    while i < n:
        j = int(np.searchsorted(off, off[i] + block, "right")) - 1
        j = max(j, i + 1)
        if j < n:
            k = int(np.searchsorted(a, a[j]))            # not inside a group
            j = k if k > i else int(np.searchsorted(a, a[i], "right"))
        yield a[i:j], doc[i:j], place[i:j], data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def large_or_index(x, windows, block, large):
    a, doc, place, data, off = x
    k = int(np.searchsorted(a, large, "right")) if large is not None else 0
    if k:                                                # the end of a group that has given windows before
        yield windows(a[:k], doc[:k], place[:k], data[:off[k]], off[:k + 1])
        a, doc, place, data, off = a[k:], doc[k:], place[k:], data[off[k]:], off[k:] - off[k]
    if not len(a):
        return
    if off[-1] > block and a[0] == a[-1]:
        yield windows(a, doc, place, data, off)
        return
    marks = _indexed(doc, place, data, off)
    if marks is not None and len(marks[0]):
        d, p, s, n = marks
        yield _mark_rows(d, p, s, n)


def by_windows(rows: DataFrame) -> DataFrame:
    """Marks of window fingerprints that occur earlier (anchors beyond a block)."""
    place = F.struct(F.col("doc_id"), F.shiftright("place", _START).alias("start"))
    rows = rows.select("a", "c", "doc_id", "place", place.alias("at"))
    first = rows.groupBy("a", "c").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = rows.join(first, ["a", "c"]).filter(F.col("at") != F.col("first"))
    return later.select("doc_id", (F.col("place").bitwiseAND(F.lit(0xFFFFFF))).alias("print"),
                        F.col("at.start").alias("start"), F.lit(LENGTH).cast("long").alias("length"))


def possible(src: DataFrame, ids: DataFrame, col: str, outside: bool = False) -> DataFrame:
    """Rows of ``src`` (its column ``doc_id``) whose id is in a bitmap of
    2 ** BITS hashed ids, or, with ``outside``, those surely not in ``ids``."""
    rows = ids.select(F.pmod(F.xxhash64(col), F.lit(1 << BITS)).alias("at")).select(
        F.expr("cast(at div 32 as int)").alias("w"), F.expr("shiftleft(1L, cast(at % 32 as int))").alias("b"))
    words = rows.groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()      # at most 2 ** (BITS - 5) rows
    bitmap = np.zeros(1 << (BITS - 5), np.uint32)
    bitmap[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).astype(np.uint32)
    shared = src.sparkSession.sparkContext.broadcast(bitmap)
    at = fresh(src, "at")

    def pick(batch):
        i = batch.column(batch.num_columns - 1).to_numpy()
        hit = (shared.value[i >> 5] >> (i & 31).astype(np.uint32)) & 1 == 1
        hit = ~hit if outside else hit
        if hit.any():
            yield batch.filter(pa.array(hit)).select(list(range(batch.num_columns - 1)))

    return on_text(src.withColumn(at, F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITS))), pick, src.schema)


def marks(src: DataFrame) -> DataFrame:
    """``doc_id, print, start, length`` of repeated stretches of ``doc_id, text, print``."""
    settled = staged(settle(first_pass(src)), "contexts")
    look = settled.filter(F.col("kind") == LOOK)
    matched = staged(match(fetch(look, src)), "matches")
    done = settled.filter(F.col("kind") == MARK).unionByName(matched.filter(F.col("kind") == MARK)).select(
        "doc_id", F.col("place").alias("print"), F.shiftright("a", 31).alias("start"), F.col("a").bitwiseAND(F.lit((1 << 31) - 1)).alias("length"))
    return done.unionByName(by_windows(matched.filter(F.col("kind") == WINDOW)))


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False) -> DataFrame:
    """Every row of ``df`` with ``kept, n_bytes, n_removed, n_spans`` put before
    its own columns but the text; columns of ``df`` with these names are
    dropped.  ``kept`` is binary, or with ``as_text`` a string without the
    characters that a cut left incomplete."""
    spark = df.sparkSession
    mine = ("kept", "n_bytes", "n_removed", "n_spans")
    own = [c for c in df.columns if c.lower() not in mine]
    # own columns are packed, so that no name can clash on the way
    src = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                    F.struct(*[F.lit(None).cast("string").alias(c) if c == text_col else F.col(c) for c in own]).alias("row"))
    src = src.select("doc_id", "text", F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFF)).alias("print"), "row")
    found = staged(marks(src.select("doc_id", "text", "print")), "marks")
    lists = found.groupBy("doc_id", "print").agg(F.collect_list(F.struct("start", "length")).alias("m"))
    empty = F.array().cast("array<struct<start:bigint,length:bigint>>")
    hit = possible(src, found, "doc_id").join(lists, ["doc_id", "print"], "left").select("text", F.coalesce("m", empty).alias("m"), "row")
    rest = possible(src, found, "doc_id", outside=True).select("text", empty.alias("m"), "row")
    schema = fields(f"kept {'string' if as_text else 'binary'}, n_bytes long, n_removed long, n_spans long").add("row", src.schema["row"].dataType)

    def run(batch):
        data, off = tb.flat(batch.column(0))
        lists = batch.column(1)
        begin = lists.offsets.to_numpy()
        stretch = lists.flatten()
        start, size = (stretch.field(i).to_numpy() for i in (0, 1))
        begin = begin - begin[0]
        for first, piece, o in tb.slices(data, off, SHARE):
            kept, removed, spans = [], [], []
            raw = memoryview(piece)
            for i in range(len(o) - 1):
                x, y = o[i], o[i + 1]
                s, e = begin[first + i], begin[first + i + 1]
                last, out, at, n = 0, [], (), np.zeros(0, np.int64)
                if s < e:
                    zero = np.zeros(e - s, np.int64)
                    _, _, at, n = _merge_marks(zero, start[s:e], start[s:e] + size[s:e], zero)
                    for p, q in zip(at.tolist(), n.tolist()):
                        out.append(raw[x + last:x + p])
                        last = p + q
                out.append(raw[x + last:y])
                out = b"".join(out)
                kept.append(out.decode("utf-8", "ignore") if as_text else out)
                removed.append(int(n.sum()))
                spans.append(len(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(np.diff(o)), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), batch.column(2).slice(first, len(o) - 1)],
                names=["kept", "n_bytes", "n_removed", "n_spans", "row"])

    out = on_text(hit, run, schema).unionByName(on_text(rest, run, schema))
    ship(spark)
    return out.select(*mine, *[F.col(f"row.`{c}`").alias(c) for c in own if c != text_col])


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
