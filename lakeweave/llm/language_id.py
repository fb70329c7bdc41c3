"""Operator 10: language identification.

A text is the average of embeddings of its hashed subwords (byte 3-grams
and 4-grams of lower-cased words with their edges); a linear softmax on the
average gives the language.  Embeddings and softmax are trained together by
stochastic gradient descent in numpy.  Part of the learning rows is kept
back to fit a temperature, so that the score is a calibrated probability,
and texts are rejected when it says that the prediction is more likely
wrong than right.

Scale: learning uses a sample of labelled rows (about ``PER_LANG`` different
texts a language and ``LANG_FEATURES`` counted subwords of them -- documented
bounds of the fit, not of predictions); every language is learned, from whole
texts of any length.  The sample's subwords are counted where the texts lie.
Prediction is one pass over the whole texts without a shuffle.

Defined cases: a null text, or one without a letter, is ``und`` with score
0 and rejected.  Without labelled rows every text is ``und``.  Equal texts
get equal results, row by row; ids may be null or repeated.  An empty table
gives an empty result.  Only the text is an input of a prediction.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import fields, on_text, read, staged

BUCKETS = 1 << 15
DIM = 16
PER_LANG = 600           # different texts a language that the fit uses, about
LANG_FEATURES = 1 << 20  # and (subword, count) pairs of them: what reaches the driver a language
EPOCHS = 6
UNKNOWN = "und"
HAS_LETTER = r"\p{L}"

# lower-cased ASCII; bytes that are no letter become a space
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def subwords(b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of every subword of one slice."""
    n = len(b)
    f = _FOLD[b]
    v = f.astype(np.uint32)
    doc = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(off))
    gram = np.zeros(n, np.uint32)
    out_b, out_d = [], []
    for size in (3, 4):
        m = n - size + 1
        if m <= 0:
            continue
        if size == 3:
            gram = (v[:m] << 16) | (v[1:m + 1] << 8) | v[2:m + 2]
        else:
            gram = (v[:m] << 24) | (v[1:m + 1] << 16) | (v[2:m + 2] << 8) | v[3:m + 3]
        # inside one document, and at most the first and last byte outside a word
        keep = doc[:m] == doc[size - 1:]
        for j in range(1, size - 1):
            keep &= f[j:m + j] != 32
        g = gram[keep] * np.uint32(0x9E3779B1 + 2 * size)
        g ^= g >> np.uint32(15)
        g *= np.uint32(0x85EBCA77)
        out_b.append((g >> np.uint32(17)).astype(np.int32))
        out_d.append(doc[:m][keep])
    if not out_b:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(out_b), np.concatenate(out_d)


@dataclass
class Model:
    """Embeddings of subwords (BUCKETS x DIM) and of languages (DIM x
    languages): its size hardly follows the number of languages."""

    langs: list[str]
    emb: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    temperature: float

    def logits(self, b: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Logits before the temperature, one row a document of the slice."""
        bucket, doc = subwords(b, off)
        n = len(off) - 1
        count = np.maximum(np.bincount(doc, minlength=n), 1)
        # the narrower of (embedding, then languages) and (each subword's share of the logits): the same product
        table = self.emb @ self.out if len(self.langs) <= DIM else self.emb
        mean = np.stack([np.bincount(doc, table[bucket, j], minlength=n) for j in range(table.shape[1])], 1) / count[:, None]
        return (mean if len(self.langs) <= DIM else mean @ self.out) + self.bias

    def probabilities(self, b: np.ndarray, off: np.ndarray) -> np.ndarray:
        return softmax(self.logits(b, off) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def counted(b: np.ndarray, off: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Different subwords of each document of a slice, and how often they occur."""
    bucket, doc = subwords(b, off)
    order = np.argsort(doc, kind="stable")
    at = np.searchsorted(doc[order], np.arange(len(off)))
    return [np.unique(bucket[order[at[i]:at[i + 1]]], return_counts=True) for i in range(len(off) - 1)]


def fit(texts: list[str], langs: list[str], seed: int = 7, epochs: int = EPOCHS) -> Model | None:
    """``fit_counted`` of texts at hand."""
    data, off = tb.flat(pa.array(texts, pa.large_string()))
    return fit_counted([row for _, b, o in tb.slices(data, off) for row in counted(b, o)], langs, seed, epochs)


def fit_counted(found: list[tuple[np.ndarray, np.ndarray]], langs: list[str], seed: int = 7, epochs: int = EPOCHS) -> Model | None:
    """SGD over averaged subword embeddings of counted texts, then the temperature on each fifth kept back."""
    names = sorted(set(langs))
    if not names:
        return None
    number = {x: i for i, x in enumerate(names)}
    y = np.array([number[x] for x in langs])
    rows = [(k, (c / max(c.sum(), 1)).astype(np.float32)) for k, c in found]
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = rng.normal(0, 0.1, (DIM, len(names))).astype(np.float32)
    bias = np.zeros(len(names), np.float32)
    learn = np.array([i for i in range(len(rows)) if i % 5], int) if len(rows) >= 10 else np.arange(len(rows))
    weight = (len(y) / (len(names) * np.bincount(y, minlength=len(names)))).astype(np.float32)
    for epoch in range(epochs):
        rate = np.float32(20.0 * (1 - epoch / epochs))
        for i in rng.permutation(learn):
            k, x = rows[i]
            if not len(k):
                continue
            mean = x @ emb[k]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= weight[y[i]]
            back = out @ p
            step = rate * np.float32(0.02)
            out -= step * np.outer(mean, p)
            bias -= np.float32(0.1) * step * p
            emb[k] -= (rate * x)[:, None] * back
    model = Model(names, emb.astype(np.float64), out.astype(np.float64), bias.astype(np.float64), 1.0)
    held = [i for i in range(len(rows)) if i % 5 == 0] or list(range(len(rows)))
    z = np.stack([rows[i][1] @ model.emb[rows[i][0]] @ model.out + model.bias for i in held])
    grid = np.geomspace(0.25, 20, 60)
    loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(held)), y[held]], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    return model


def chosen(df: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """``lang, h, text``: about ``per_lang`` different texts of each language,
    chosen by a hash of the text (the same ones every time); copies come
    once, so a language of few texts has all."""
    ok = df.filter(F.col("lang").isNotNull() & F.col("text").rlike(HAS_LETTER)).withColumn("h", F.xxhash64("text"))
    sizes = ok.groupBy("lang", "h").agg(F.count(F.lit(1)).alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("texts"))
    u = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    # sizes: one row a language
    picked = ok.join(F.broadcast(staged(sizes, "languages")), "lang").filter(u * F.col("texts") < per_lang)
    return picked.select("lang", "h", "text").dropDuplicates(["lang", "h"])


def learning_rows(df: DataFrame, per_lang: int = PER_LANG) -> tuple[list[str], list[str]]:
    """Texts and languages of the sample, to look at; learning takes ``learning_counts``."""
    rows = chosen(df, per_lang).collect()
    return [r["text"] for r in rows], [r["lang"] for r in rows]


def learning_counts(df: DataFrame, per_lang: int = PER_LANG, features: int = LANG_FEATURES) -> tuple[list, list[str]]:
    """Counted subwords and languages of the sample.  Texts are counted whole
    where they lie; a language gives at most about ``features`` pairs (at
    least one text), so of long texts fewer are taken."""

    def run(batch):
        data, off = tb.flat(batch.column(2))
        for i, b, o in tb.slices(data, off):
            rows = counted(b, o)
            n = len(rows)
            at = pa.array(np.concatenate([[0], np.cumsum([len(k) for k, _ in rows])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(part).astype(np.int32))) for part in zip(*rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), batch.column(1).slice(i, n), *lists], names=["lang", "h", "k", "c"])

    found = on_text(chosen(df, per_lang), run, fields("lang string, h long, k array<int>, c array<int>"))
    before = F.coalesce(F.sum(F.size("k")).over(Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    table = staged(found, "subwords").withColumn("before", before).filter(F.col("before") < features).drop("before").toArrow()
    order = np.lexsort((table.column("h").to_numpy(), np.array(table.column("lang").to_pylist(), object).astype(str)))
    k, c, langs = (table.column(x).combine_chunks() for x in ("k", "c", "lang"))
    order = order[np.random.default_rng(3).permutation(len(order))]
    return [(k[i].values.to_numpy(), c[i].values.to_numpy()) for i in order.tolist()], [langs[i].as_py() for i in order.tolist()]


def train(df: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model | None:
    """Fit on the rows of ``df`` with a language."""
    return fit_counted(*learning_counts(df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))))


def predict_batch(model: Model | None, texts) -> tuple[list[str], np.ndarray]:
    """Language and calibrated score of each text of an Arrow column
    (of texts without a letter too; see ``has_letter``)."""
    n = len(texts)
    if model is None:
        return [UNKNOWN] * n, np.zeros(n)
    data, off = tb.flat(texts)
    p = np.concatenate([model.probabilities(b, o) for _, b, o in tb.slices(data, off)])
    best = p.argmax(1)
    return [model.langs[i] for i in best], p[np.arange(n), best]


def predict(df: DataFrame, model: Model | None, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` and ``rejected`` put before its
    own columns; columns of ``df`` with these names are dropped."""
    spark = df.sparkSession
    mine = ("lang_pred", "score", "rejected")
    src = df.select(F.coalesce(F.col(text_col).cast("string").rlike(HAS_LETTER), F.lit(False)).alias("rejected"),
                    *[c for c in df.columns if c.lower() not in mine])
    at = src.columns.index(text_col)
    shared = spark.sparkContext.broadcast(model)      # BUCKETS x DIM doubles, and DIM a language
    schema = fields("lang_pred string, score double, rejected boolean")
    for f in src.schema.fields[1:]:
        schema = schema.add(f)

    def run(batch):
        letter = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
        lang, score = predict_batch(shared.value, batch.column(at).cast(pa.string()))
        score = np.clip(np.where(letter, score, 0.0), 0.0, 1.0)
        lang = [x if ok else UNKNOWN for x, ok in zip(lang, letter)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score), pa.array((~letter) | (score < threshold)), *batch.columns[1:]],
            names=schema.names)

    return on_text(src, run, schema)


def held_out(doc_id):
    """crc32 of the id as text, modulo 3, is 1 (null ids are not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
