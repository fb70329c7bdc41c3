"""Operator 11: toxicity by weak supervision.

Voters (word lists and patterns) look at a text and vote toxic (+1), clean
(-1) or abstain (0); two of them are lists induced from labelled rows: whole
words, and word beginnings of ``STEMS`` bytes (languages inflect).
A generative label model explains the votes of all documents by a hidden
class: given the class, every voter answers by its own probabilities, and by
those of the voter that it is most correlated with (a tree over the voters,
chosen by mutual information within the classes), all estimated by
expectation-maximisation.  Its posteriors are the training labels of a linear
classifier over word features and votes, whose margin is calibrated on
labelled rows.  Labels are learned from rows with crc32(decimal id) % 3 <> 1
only, and neither labels, language, source nor ids take part in a score.

Scale: texts are read where they lie and never shuffled as a whole.  Equal
votes are interchangeable, so the label model works on the counts of vote
patterns (at most ``3 ** len(VOTERS)`` rows) over all documents.  Fitting
uses bounded samples, taken by hash: at most ``PER_CLASS`` labelled ids a
class, and at most ``PER_BIN`` different texts above and below a posterior of
1/2; of their words and word beginnings the ``N_FEATURES`` most telling are
kept.  Words are 64-bit hashes of maximal runs of letters (ASCII letters in
lower case, and all bytes above 127).

Defined cases: a null or empty text, or one without a word, is scored like a
text in which nothing is found (the calibrated floor).  Rows of labels without id or
label are left out; an id labelled twice is toxic if one of its rows says so.
A row without an id is never held out nor labelled.  Without labels of both
classes the score is the classifier's own probability.  Repeated rows and
equal texts get equal scores, row by row.  An empty table gives an empty
result.  Columns other than the id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import fields, on_text, read, staged

PER_CLASS = 3000         # labelled ids a class that the fit may use
PER_BIN = 3000           # different texts a side of the posterior that train the classifier
N_FEATURES = 1024        # words and word beginnings that the classifier weighs
N_INDUCED = 1024         # words and word beginnings of the induced lists
MIN_DOCS = 5             # documents of the sample that one must occur in
MIN_INFO = 0.02          # nats that two voters must share within the classes to count as correlated
STEMS = (4, 5, 6, 7, 8)  # bytes of word beginnings
THRESHOLD = 0.7

# Word lists of the voters.
LEXICONS = {
    "mind": "stupid idiot idiots idiotic moron moronic imbecile dumb dumbass fool foolish dimwit brainless retarded dunce",
    "worth": "worthless loser losers useless pathetic trash garbage scum scumbag filth vermin parasite waste nobody lowlife",
    "disgust": "disgusting vile gross repulsive revolting nasty filthy sickening rotten hideous ugly creepy",
    "contempt": "clown clowns jerk creep freak coward liar pig rat snake weirdo douche troll hypocrite",
    "profanity": "damn crap bastard bitch asshole bullshit shit shitty fuck fucking fucked piss dick slut whore",
    "foreign": "trottel abschaum dummkopf arschloch idiota imbécile crétin ordure connard salope estúpido estúpida "
               "basura imbécil asqueroso payaso perdedor idioten wertlos widerlich",
}
SECOND_PERSON = "you your yours yourself ur u du dich dir euch tu toi vous te usted ustedes"

VOTERS = [*LEXICONS, "induced_words", "induced_stems", "several", "density", "address", "shouting"]
PATTERNS = 3 ** len(VOTERS)      # proven bound of the table that the label model works on and that is broadcast

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Tokens:
    """Letter runs of one slice: ``hash``, ``doc``, and ``at``: the first of each document."""

    def __init__(self, b: np.ndarray, off: np.ndarray):
        mask = _LETTER[b]
        self.low = _LOWER[b]
        self.start, self.end = tb.runs(mask, off)
        self.hash = tb.run_hash(self.low, mask, self.start, self.end)
        self.at = np.searchsorted(self.start, off)
        self.doc = np.repeat(np.arange(len(off) - 1), np.diff(self.at))
        self.letters = tb.per_doc_sum(mask, off)
        self.capitals = tb.per_doc_sum((b >= 65) & (b <= 90), off)

    def parts(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(tokens, hashes) of the whole words, then of the beginnings of each
        size of ``STEMS`` of longer words; even hashes are words, odd ones stems."""
        yield np.arange(len(self.hash)), self.hash & ~tb.U(1)
        if not len(self.hash):
            return
        p, inv = tb.powers(len(self.low))
        run = np.concatenate([np.zeros(1, tb.U), np.cumsum(tb.TABLE[self.low] * p)])
        size = self.end - self.start
        for k in STEMS:
            long = np.flatnonzero(size > k)
            a = self.start[long]
            yield long, tb.mix((run[a + k] - run[a]) * inv[a] + tb.U(k << 32)) | tb.U(1)


def word_hashes(words: list[str]) -> np.ndarray:
    if not words:
        return np.zeros(0, tb.U)
    b, off = tb.flat(pa.array(words))
    return Tokens(b, off).hash & ~tb.U(1)


@dataclass
class Lists:
    """Sorted hashes of all listed words and stems and the list of each."""

    hash: np.ndarray
    which: np.ndarray

    @classmethod
    def build(cls, induced: np.ndarray) -> Lists:
        induced, odd = induced.astype(tb.U), (induced & tb.U(1)).astype(bool)
        parts = [word_hashes(text.split()) for text in LEXICONS.values()] + [induced[~odd], induced[odd]]
        h, which = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        h, first = np.unique(h, return_index=True)        # a word of two lists counts for the first
        return cls(h, which[first])


def look_up(table: np.ndarray, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, entries) of the words and stems of ``t`` found in the sorted ``table``."""
    found = [np.zeros((2, 0), np.int64)]
    for token, h in t.parts() if len(table) else ():
        k = np.minimum(np.searchsorted(table, h), len(table) - 1)
        hit = np.flatnonzero(table[k] == h)
        found.append(np.stack([token[hit], k[hit]]))
    token, entry = np.concatenate(found, axis=1)
    return token, entry


def present(table: np.ndarray, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(document, entry) of every entry of ``table`` found in a document, by document, once each."""
    at, k = look_up(table, t)
    pair = np.unique(t.doc[at] * (len(table) + 1) + k)
    return pair // (len(table) + 1), pair % (len(table) + 1)


def vote(t: Tokens, lists: Lists) -> np.ndarray:
    """Votes (document, voter) of one slice."""
    n_doc = len(t.at) - 1
    n = np.diff(t.at)
    at, entry = look_up(lists.hash, t)
    out = np.zeros((n_doc, len(VOTERS)), np.int64)
    n_lists = len(LEXICONS) + 2
    hits = np.bincount(t.doc[at] * n_lists + lists.which[entry], minlength=n_doc * n_lists).reshape(n_doc, n_lists)
    out[:, :n_lists] = hits > 0
    at = np.unique(at)                                    # words with any hit
    doc = t.doc[at]
    total = np.bincount(doc, minlength=n_doc)
    order = np.lexsort((t.hash[at], doc))
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(t.hash[at][order]) != 0) | (np.diff(doc[order]) != 0)
    distinct = np.bincount(doc[order][new], minlength=n_doc)
    out[:, n_lists] = np.where(distinct >= 2, 1, np.where((total == 0) & (n >= 20), -1, 0))
    out[:, n_lists + 1] = np.where((total > 0) & (500 * total >= n), 1, np.where((total == 0) & (n >= 50), -1, 0))
    second = np.isin(t.hash & ~tb.U(1), word_hashes(SECOND_PERSON.split()))
    near = np.zeros(len(at), bool)
    for step in (-3, -2, -1, 1, 2, 3):
        other = np.clip(at + step, 0, max(len(t.hash) - 1, 0))
        near |= second[other] & (t.doc[other] == doc) if len(at) else near
    out[:, n_lists + 2] = np.bincount(doc[near], minlength=n_doc) > 0
    out[:, n_lists + 3] = (t.letters >= 100) & (2 * t.capitals > t.letters)
    return out


def encode(votes: np.ndarray) -> np.ndarray:
    return (votes + 1) @ (3 ** np.arange(votes.shape[1])[::-1])


def decode(patterns: np.ndarray, n: int = len(VOTERS)) -> np.ndarray:
    return np.stack([(patterns // 3 ** (n - 1 - j)) % 3 - 1 for j in range(n)], axis=1)


# --- the label model ---------------------------------------------------------

@dataclass
class LabelModel:
    prior: float
    parent: list[int]                                     # of each voter in the forest, -1: none
    table: np.ndarray                                     # class, voter, outcome of the parent, outcome
    accuracy: np.ndarray = field(default=None)            # of each voter, where it votes
    correlation: np.ndarray = field(default=None)         # mutual information of two voters within the classes


def _posterior(m: LabelModel, outcome: np.ndarray) -> np.ndarray:
    like = []
    for c in (0, 1):
        s = np.zeros(len(outcome))
        for v, p in enumerate(m.parent):
            s += np.log(m.table[c, v, outcome[:, p] if p >= 0 else 0, outcome[:, v]])
        like.append(s)
    odds = np.log(m.prior) + like[1] - np.log(1 - m.prior) - like[0]
    return 1 / (1 + np.exp(np.clip(-odds, -60, 60)))


def _shared(joint: np.ndarray) -> np.ndarray:
    """Mutual information of every two voters within the classes; ``joint``:
    class, voter, voter, outcome, outcome."""
    p = joint / joint.sum(axis=(3, 4), keepdims=True).clip(1e-300)
    both = p.sum(4, keepdims=True) * p.sum(3, keepdims=True)
    inside = np.where(p > 0, p * np.log(np.where(p > 0, p, 1) / np.where(both > 0, both, 1)), 0).sum((3, 4))
    weight = joint[:, 0, 0].sum((1, 2))
    return np.tensordot(weight / max(weight.sum(), 1e-300), inside, 1)


def _parents(n: int, edges: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """(parent, tree) of each voter in the forest of ``edges``."""
    parent, tree = [-1] * n, [-1] * n
    for root in range(n):
        todo = [root] if tree[root] < 0 else []
        while todo:
            v = todo.pop()
            tree[v] = root
            for a, b in edges:
                for x, y in ((a, b), (b, a)):
                    if x == v and tree[y] < 0:
                        parent[y] = v
                        todo.append(y)
    return parent, tree


def label_model(votes: np.ndarray, weight: np.ndarray, rounds: int = 60, strength: float = 20.0) -> tuple[np.ndarray, LabelModel]:
    """Posterior of "toxic" for each vote pattern, and the estimates.

    Voters start out independent given the class.  After every ``rounds``
    rounds of EM the two voters that share most information within the
    classes become dependent (if it is ``MIN_INFO`` or more, and the
    dependencies stay a forest), one pair at a time: a pair left out makes
    others look dependent.  ``strength`` pseudo-votes hold each row of a table
    to the start, in which toxic votes come mostly from toxic texts, so the
    classes cannot swap and rarely heard voters keep it.
    """
    n = votes.shape[1]
    outcome = votes + 1
    start = np.array([[0.3, 0.68, 0.02], [0.05, 0.65, 0.3]])           # rows: clean, toxic; columns: clean, abstain, toxic
    m = LabelModel(0.1, [-1] * n, np.broadcast_to(start[:, None, None, :], (2, n, 3, 3)).copy())
    flat = (outcome[:, :, None] == np.arange(3)).astype(float).reshape(len(votes), -1)
    edges: list[tuple[int, int]] = []
    while True:
        for _ in range(rounds):
            post = _posterior(m, outcome)
            joint = np.stack([((flat * w[:, None]).T @ flat).reshape(n, 3, n, 3).transpose(0, 2, 1, 3)
                              for w in (weight * (1 - post), weight * post)])
            for c in (0, 1):
                for v, p in enumerate(m.parent):
                    seen = joint[c, p, v] if p >= 0 else np.repeat(np.diag(joint[c, v, v])[None], 3, 0)
                    m.table[c, v] = (seen + strength * start[c]) / (seen.sum(1, keepdims=True) + strength)
            m.prior = float(np.clip((weight @ post + 2) / (weight.sum() + 20), 0.005, 0.9))
        m.correlation = _shared(joint)
        _, tree = _parents(n, edges)
        pairs = [(m.correlation[a, b], -a, -b) for a in range(n) for b in range(a + 1, n) if tree[a] != tree[b]]
        if not pairs or max(pairs)[0] < MIN_INFO:
            break
        edges.append((-max(pairs)[1], -max(pairs)[2]))
        m.parent, _ = _parents(n, edges)
    post = _posterior(m, outcome)
    right = weight @ np.where(votes == 1, post[:, None], np.where(votes == -1, 1 - post[:, None], 0))
    m.accuracy = right / np.maximum(weight @ (votes != 0), 1e-9)
    return post, m


# --- the classifier ----------------------------------------------------------

@dataclass
class Model:
    """What a score needs: word lists, words and stems (sorted hashes), their
    weights and those of the votes."""

    lists: Lists
    words: np.ndarray
    word_weight: np.ndarray
    vote_weight: np.ndarray
    bias: float
    labels: LabelModel | None = None

    def margin(self, t: Tokens) -> np.ndarray:
        n_doc = len(t.at) - 1
        doc, k = present(self.words, t)
        words = np.bincount(doc, weights=self.word_weight[k], minlength=n_doc) if len(doc) else np.zeros(n_doc)
        return words + vote(t, self.lists) @ self.vote_weight + self.bias


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 30, l2: float = 1e-4,
             seed: int = 11) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft targets, by
    stochastic gradient descent with averaged iterates."""
    rng, w, bias = np.random.default_rng(seed), np.zeros(x.shape[1]), 0.0
    mean_w, mean_b, seen = np.zeros(x.shape[1]), 0.0, 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), 64):
            k = order[lo:lo + 64]
            p = 1 / (1 + np.exp(-np.clip(x[k] @ w + bias, -30, 30)))
            g = (p - y[k]) * weight[k]
            rate = 0.5 / (1 + 0.2 * epoch)
            w -= rate * (x[k].T @ g / len(k) + l2 * w)
            bias -= rate * g.mean()
            if epoch >= epochs // 2:
                mean_w, mean_b, seen = mean_w + w, mean_b + bias, seen + 1
    return mean_w / max(seen, 1), mean_b / max(seen, 1)


def calibrate(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of a logistic curve through labelled margins (Newton,
    smoothed targets; the slope stays positive)."""
    pos, neg = (weight * y).sum(), (weight * (1 - y)).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, h = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-9)
        grad = np.array([g @ margin, g.sum()])
        hess = np.array([[h @ margin ** 2, h @ margin], [h @ margin, h.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        a, b = max(a - step[0], 0.05), b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


# --- Spark -------------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    """crc32(decimal id) % 3 = 1; a row without an id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _input(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def _patterns(src: DataFrame, lists: Lists) -> DataFrame:
    """``doc_id, key`` (hash of the text) and ``pattern`` of its votes."""

    def run(batch):
        data, off = tb.flat(batch.column(2))
        votes = [encode(vote(Tokens(b, o), lists)) for _, b, o in tb.slices(data, off)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(votes).astype(np.int64))],
                                         names=["doc_id", "key", "pattern"])

    return on_text(src.select("doc_id", F.xxhash64("text").alias("key"), "text"), run, fields("doc_id long, key long, pattern long"))


def _telling_words(sample: DataFrame, k: int, share: float = 0.0) -> np.ndarray:
    """Hashes of the ``k`` words and stems whose documents' ``target`` differs
    most from the sample's mean (in standard errors; with ``share``, only
    those of at least that mean target).  ``sample``: key, target, text."""

    def run(batch):
        data, off = tb.flat(batch.column(1))
        target = batch.column(0).to_numpy(zero_copy_only=False)
        for i, b, o in tb.slices(data, off):
            t, n_doc = Tokens(b, o), len(o) - 1
            for token, h in t.parts():
                name, which = np.unique(h, return_inverse=True)
                pair = np.unique(which.astype(np.int64) * n_doc + t.doc[token])
                which, doc = pair // n_doc, pair % n_doc
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tb.signed(name)), pa.array(np.bincount(which, minlength=len(name)).astype(np.int64)),
                     pa.array(np.bincount(which, weights=target[i + doc], minlength=len(name)).astype(float))], names=["word", "n", "s"])

    n, mean = sample.agg(F.count(F.lit(1)), F.avg("target")).first()
    if not n or not 0 < mean < 1:
        return np.zeros(0, tb.U)
    words = on_text(sample.select("target", "text"), run, fields("word long, n long, s double"))
    stat = words.groupBy("word").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).filter(F.col("n") >= MIN_DOCS)
    z = (F.col("s") - F.col("n") * F.lit(mean)) / F.sqrt(F.col("n") * F.lit(mean * (1 - mean)))
    top = (stat.withColumn("z", F.round(z, 6)).filter((F.col("z") >= 5) & (F.col("s") >= share * F.col("n")) if share else F.abs("z") >= 3)
           .orderBy(F.abs("z").desc(), "word").limit(k).select("word"))
    return np.sort(np.array([r.word for r in top.collect()], np.int64).view(tb.U))


def _features(sample: DataFrame, lists: Lists, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, target, key) of the sample's rows, ordered by key: presence
    of each word and stem, then the votes.  At most 2 * PER_BIN rows."""

    def run(batch):
        data, off = tb.flat(batch.column(2))
        for i, b, o in tb.slices(data, off):
            t, n = Tokens(b, o), len(o) - 1
            doc, k = present(words, t)
            per_doc = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(per_doc), pa.array(k.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), batch.column(1).slice(i, n), found,
                                              pa.array(encode(vote(t, lists)).astype(np.int64))], names=["key", "target", "found", "pattern"])

    rows = on_text(sample.select("key", "target", "text"), run, fields("key long, target double, found array<int>, pattern long")).collect()
    rows.sort(key=lambda r: (r.key, r.target))
    x = np.zeros((len(rows), len(words) + len(VOTERS)), np.float32)
    for i, r in enumerate(rows):
        x[i, r.found] = 1
    if rows:
        x[:, len(words):] = decode(np.array([r.pattern for r in rows]))
    return x, np.array([r.target for r in rows]), np.array([r.key for r in rows])


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int = PER_CLASS) -> tuple[DataFrame, dict[int, int]]:
    """``key, target, text`` of at most ``per_class`` labelled ids a class that
    are not held out (different texts only), and the classes' sizes."""
    spark = docs.sparkSession
    one = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).dropna()
           .filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y")))
    size = {int(r.y): int(r["count"]) for r in one.groupBy("y").count().collect() if r.y in (0, 1)}
    few = [one.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    ids = spark.createDataFrame(few[0].unionByName(few[1]).collect(), "doc_id long, y int")     # at most 2 * per_class rows
    joined = docs.join(F.broadcast(ids), "doc_id").select(F.xxhash64("text").alias("key"), F.col("y").cast("double").alias("target"), "text")
    return staged(joined.dropDuplicates(["key", "target"]), "labelled"), size


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        per_bin: int = PER_BIN) -> Model:
    """Learns the model from the texts of ``df`` and ``labels`` (doc_id, ``label_col``)."""
    spark, src = df.sparkSession, _input(df, id_col, text_col)
    known, size = labelled_sample(src, labels, label_col)
    lists = Lists.build(_telling_words(known, N_INDUCED, share=0.9))
    voted = staged(_patterns(src, lists), "votes")
    tally = voted.groupBy("pattern").count().toPandas().sort_values("pattern")    # at most PATTERNS rows
    if not len(tally):
        return Model(lists, np.zeros(0, tb.U), np.zeros(0), np.zeros(len(VOTERS)), 0.0)
    post, estimates = label_model(decode(tally["pattern"].to_numpy(np.int64)), tally["count"].to_numpy(float))
    table = spark.createDataFrame([(int(p), float(q)) for p, q in zip(tally["pattern"], post)], "pattern long, target double")
    judged = voted.filter(~held_out(F.col("doc_id"))).join(F.broadcast(table), "pattern").select("key", "target").distinct()
    bins = [judged.filter(side).orderBy(F.hash("key"), "key").limit(per_bin) for side in (F.col("target") >= 0.5, F.col("target") < 0.5)]
    chosen = spark.createDataFrame(bins[0].unionByName(bins[1]).collect(), "key long, target double")   # at most 2 * per_bin rows
    texts = src.withColumn("key", F.xxhash64("text")).join(F.broadcast(chosen), "key").select("key", "target", "text")
    sample = staged(texts.dropDuplicates(["key"]), "sample")
    words = _telling_words(sample, N_FEATURES)
    x, y, _ = _features(sample, lists, words)
    if not len(x):
        return Model(lists, words, np.zeros(len(words)), np.zeros(len(VOTERS)), 0.0, estimates)
    # each side of the sample stands for all texts of that side
    w, bias = logistic(x, y, np.ones(len(x)))
    model = Model(lists, words, w[:len(words)], w[len(words):], float(bias), estimates)
    if size.get(0) and size.get(1):
        x, y, _ = _features(known, lists, words)
        share = {c: size[c] / max((y == c).sum(), 1) for c in (0, 1)}
        a, b = calibrate(x @ w + bias, y, np.where(y > 0, share[1], share[0]))
        model.word_weight, model.vote_weight, model.bias = model.word_weight * a, model.vote_weight * a, model.bias * a + b
    return model


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score`` (0 to 1) and ``predicted`` (0 / 1) of each row's whole text."""

    def run(batch):
        data, off = tb.flat(batch.column(1))
        margins = [model.margin(Tokens(b, o)) for _, b, o in tb.slices(data, off)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(np.concatenate(margins), -60, 60))))],
                                         names=["doc_id", "score"])

    out = on_text(_input(df, id_col, text_col), run, fields("doc_id long, score double"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = score(docs, fit(docs, read(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
