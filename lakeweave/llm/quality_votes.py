"""Operator 3: quality by weak supervision.

Rules look at a document's counts and vote good (+1), bad (-1) or abstain
(0).  Expectation-maximisation over the whole corpus estimates, without
labels, how often each rule's votes are right in good and in bad documents
and the share of good ones; the posterior probability of "good" replaces
filtering by all rules at once.

Scale: one pass computes the counts per document (no shuffle of texts).
Documents with equal votes are interchangeable, so EM runs on the number of
documents per vote pattern -- at most ``3 ** N_RULES`` rows whatever the
corpus size -- and the posterior of each pattern is joined back by a
broadcast of that bounded table.

Defined cases: a null or empty text, or one without words, has all counts 0
and fails the base filter.  Repeated rows and equal texts get equal
results, row by row; ids may be null or repeated.  An empty table gives an
empty result.  Columns other than the id and text are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import fields, on_text, read, staged

SYMBOLS = b"#*$%&|<>"
FUNCTION_WORDS = ("the of and to in is that for it on with as was by at are or from this be "
                  "le la les des et un une que en dans pour est pas qui sur au avec de "
                  "der die und das ist ein eine nicht mit den von zu auf sich auch "
                  "el los las y del una por con para es se lo no").split()

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_unique_words", "n_function_words", "n_upper", "n_letters"]

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def _word_hashes(words: list[str]) -> np.ndarray:
    d, o = tb.flat(pa.array(words))
    return np.sort(tb.Words(d, o).hash)


def _repeated(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For (doc, key) pairs in row order: equal to an earlier one of the same
    document; occurs more than once in its document."""
    n = len(keys)
    if not n:
        return np.zeros(0, bool), np.zeros(0, bool)
    order = np.lexsort((keys, docs))                      # stable: rows of a group stay in order
    k, d = keys[order], docs[order]
    same = np.zeros(n, bool)
    same[1:] = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    later, many = np.zeros(n, bool), np.zeros(n, bool)
    later[order] = same
    any_ = same.copy()
    any_[:-1] |= same[1:]
    many[order] = any_
    return later, many


def count_slice(b: np.ndarray, off: np.ndarray, stop: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every document of one slice."""
    n_doc = len(off) - 1
    w = tb.Words(b, off)
    n_words = np.diff(w.at)
    out = {"n_words": n_words,
           "word_chars": tb.per_doc_sum(w.mask & ((b & 0xC0) != 0x80), off),
           "n_symbols": tb.per_doc_sum(_IS_SYMBOL[b], off)}
    upper = (b >= 65) & (b <= 90)
    out["n_upper"] = tb.per_doc_sum(upper, off)
    out["n_letters"] = out["n_upper"] + tb.per_doc_sum((b >= 97) & (b <= 122), off)
    out["n_function_words"] = tb.per_doc_sum(np.isin(w.hash, stop), w.at)
    later, _ = _repeated(w.hash, w.doc)
    out["n_unique_words"] = n_words - tb.per_doc_sum(later, w.at)
    # lines: runs of bytes other than \n, of which those with a word count
    line_mask = b != 10
    ls, le = tb.runs(line_mask, off)
    lh = tb.run_hash(b, line_mask, ls, le)
    has = np.searchsorted(w.start, le) > np.searchsorted(w.start, ls)
    ls, lh = ls[has], lh[has]
    ldoc = np.searchsorted(off, ls, "right") - 1
    later, _ = _repeated(lh, ldoc)
    out["n_lines"] = np.bincount(ldoc, minlength=n_doc)
    out["n_dup_lines"] = np.bincount(ldoc[later], minlength=n_doc)
    # words covered by a 3-word window that occurs twice or more
    n = len(w.hash)
    if n >= 3:
        tri = tb.mix(tb.mix(w.hash[:-2] * tb.U(3) + tb.U(1)) + tb.mix(w.hash[1:-1] * tb.U(5) + tb.U(2)) * tb.U(7)
                     + tb.mix(w.hash[2:] * tb.U(9) + tb.U(3)) * tb.U(11))
        inside = np.flatnonzero(w.doc[:-2] == w.doc[2:])
        _, many = _repeated(tri[inside], w.doc[inside])
        hit = np.zeros(n, bool)
        for j in range(3):
            hit[inside[many] + j] = True
        out["n_repeat_words"] = tb.per_doc_sum(hit, w.at)
    else:
        out["n_repeat_words"] = np.zeros(n_doc, np.int64)
    return out


def counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the columns ``COUNTS`` (long) of each row's whole text."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batch):
        stop = _word_hashes(FUNCTION_WORDS)
        data, off = tb.flat(batch.column(1))
        parts = [count_slice(b, o, stop) for _, b, o in tb.slices(data, off)]
        cols = [pa.array(np.concatenate([p[c] for p in parts]).astype(np.int64)) for c in COUNTS]
        yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", *COUNTS])

    return on_text(src, run, fields("doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def _share(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))



def rules() -> dict[str, tuple[Column, Column]]:
    """Each rule's (good, bad) conditions; between them it abstains."""
    words = F.col("n_words")
    mean = _share("word_chars", "n_words")
    never = F.lit(False)
    return {
        "length": (words >= 200, never),
        "word_length": (mean.between(3.5, 6.5), (mean > 7.5) | (mean < 2.5)),
        "symbols": (never, _share("n_symbols", "n_words") > 0.2),
        "repeats": (never, (words >= 20) & (_share("n_repeat_words", "n_words") > 0.4)),
        "line_copies": (never, (F.col("n_lines") >= 4) & (_share("n_dup_lines", "n_lines") > 0.3)),
        "vocabulary": ((words >= 50) & (_share("n_unique_words", "n_words") > 0.4),
                       (words >= 50) & (words <= 1000) & (_share("n_unique_words", "n_words") < 0.15)),
        "function_words": ((words >= 20) & (_share("n_function_words", "n_words") > 0.06),
                           (words >= 50) & (_share("n_function_words", "n_words") < 0.01)),
        "capitals": (never, (F.col("n_letters") >= 100) & (_share("n_upper", "n_letters") > 0.5)),
    }


N_RULES = 8
PATTERNS = 3 ** N_RULES      # proven bound of the table EM works on and that is broadcast


def with_votes(df: DataFrame) -> DataFrame:
    """Adds ``pattern``: the votes as a base-3 number (one digit a rule)."""
    votes = [_vote(g, b) for g, b in rules().values()]
    code = reduce(lambda a, v: a * 3 + (v + 1), votes, F.lit(0))
    return df.withColumn("pattern", code.cast("int"))


def unpack(patterns: np.ndarray, n_rules: int = N_RULES) -> np.ndarray:
    return np.stack([(patterns // 3 ** (n_rules - 1 - j)) % 3 - 1 for j in range(n_rules)], axis=1)


def em(votes: np.ndarray, weight: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, dict]:
    """Posterior of "good" for each vote pattern, and the estimates.

    Two classes; in each, a rule votes good, abstains or votes bad with its
    own three probabilities (so a rule that only ever accuses, or that is
    often wrong, is weighed as such).  The start says that accusations come
    mostly from bad documents; 20 pseudo-votes a rule and class hold on to
    it, so rarely heard rules keep it and the classes cannot swap.
    """
    outcome = [votes == 1, votes == 0, votes == -1]
    start = np.array([[0.2, 0.4, 0.4], [0.5, 0.49, 0.01]])            # rows: bad, good; columns: good, abstain, bad
    theta = np.repeat(start[:, None, :], votes.shape[1], axis=1)       # class, rule, outcome
    prior, post = 0.8, np.zeros(len(votes))
    for _ in range(rounds):
        like = [sum(o @ np.log(theta[c, :, k]) for k, o in enumerate(outcome)) for c in (0, 1)]
        odds = np.log(prior) + like[1] - np.log(1 - prior) - like[0]
        new = 1 / (1 + np.exp(np.clip(-odds, -60, 60)))
        moved, post = np.abs(new - post).max(initial=0), new
        if moved < 1e-9:
            break
        for c, w in enumerate((weight * (1 - post), weight * post)):
            seen = np.stack([o.T @ w for o in outcome], axis=1)
            theta[c] = (seen + 20 * start[c]) / (w.sum() + 20)
        prior = float(np.clip((weight @ post + 16) / (weight.sum() + 20), 0.02, 0.98))
    return post, {"prior": prior, "outcomes": theta}


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Counts, ``base_failed``, ``p_good`` (posterior) and ``kept`` for each row."""
    spark = df.sparkSession
    voted = staged(with_votes(counts(df, id_col, text_col)), "votes")
    tally = voted.groupBy("pattern").count().toPandas()   # at most PATTERNS rows
    tally = tally.sort_values("pattern")                  # EM sums in one order
    post, _ = em(unpack(tally["pattern"].to_numpy(np.int64)), tally["count"].to_numpy(float))
    table = spark.createDataFrame([(int(p), float(q)) for p, q in zip(tally["pattern"], post)], "pattern int, p_good double")
    base = (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))
    return (voted.join(F.broadcast(table), "pattern", "left")
            .withColumn("base_failed", base)
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold)))


def op3_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", F.round("p_good", 6).alias("p_good"))
