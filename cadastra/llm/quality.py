"""Quality classifier: a linear-chain conditional random field over the lines of a document."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel
from .shared import lean, small_batches

#: The byte classes that line features count.
UPPER, DIGITS, BANG, PIPE, SYMBOLS, PUNCT = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b"!",
    b"|",
    b"#$%&*~^=<>{}[]\\/@_+",
    b".,;:?'\"()-",
)
#: Documents of each class that training takes at most, and the longest of them in bytes; the only bounds, and only for training.
SAMPLE, SAMPLE_BYTES = 1200, 20_000
THRESHOLD = 0.7


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


CLASSES = [_class(x) for x in (UPPER, DIGITS, BANG, PIPE, SYMBOLS, PUNCT)]


def features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature matrix, weight (bytes that aren't white space) and row of every line that isn't blank."""
    starts, ends, rows = kernel.lines(buf, offsets)
    ws, we = kernel.words(buf, offsets)
    h = kernel.range_hashes(buf, ws, we)
    first, last = np.searchsorted(ws, starts), np.searchsorted(ws, ends)
    seen = first < last
    starts, ends, rows, first, last = starts[seen], ends[seen], rows[seen], first[seen], last[seen]
    n_words = last - first
    run = np.zeros(len(ws) + 1, np.int64)
    if len(ws) > 1:  # a word equal to the one before it
        np.cumsum(h[1:] == h[:-1], out=run[2:])
    again = run[last] - run[np.minimum(first + 1, last)]
    size = np.zeros(len(ws) + 1, np.int64)
    np.cumsum(we - ws, out=size[1:])
    n = (size[last] - size[first]).astype(float)
    upper, digits, bang, pipe, symbols, punct = (c / n for c in kernel.class_counts(buf, CLASSES, starts, ends))
    mean = n / n_words
    x = np.stack(
        [
            np.ones(len(n)),
            upper,
            upper > 0.3,
            digits,
            digits > 0.3,
            np.minimum(bang * 5, 1),
            np.minimum(pipe * 10, 1),
            pipe > 0.02,
            np.minimum(symbols * 5, 1),
            symbols > 0.05,
            punct,
            again / n_words,
            again / n_words > 0.15,
            np.minimum(np.log1p(n) / 8, 1.5),
            n_words <= 3,
            np.minimum(np.abs(mean - 6) / 6, 2),
        ],
        axis=1,
    ).astype(float)
    return x, n, rows


def with_neighbours(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A line's own features, those of the line before and of the line after (zeros beyond the document)."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    if len(x) > 1:
        same = (rows[1:] == rows[:-1])[:, None]
        before[1:], after[:-1] = x[:-1] * same, x[1:] * same
    return np.concatenate([x, before, after], axis=1)


def _steps(rows: np.ndarray) -> list[np.ndarray]:
    """Line numbers by place in their document: the k-th lines of all documents that have one."""
    if not len(rows):
        return []
    begin = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    length = np.diff(np.r_[begin, len(rows)])
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    return [begin[: np.searchsorted(-length, -k, "left")] + k for k in range(int(length[0]))]


def marginals(unary: np.ndarray, rows: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all chains at once. unary: log-odds of good against bad; trans[i, j]: log-potential from i to j.
    Gives P(good) of each line, the expected transitions (2 x 2), and P(i, j) is not kept a line."""
    steps = _steps(rows)
    fwd, bwd, expected = unary.copy(), np.zeros_like(unary), np.zeros((2, 2))
    t = trans
    for k in range(1, len(steps)):
        i = steps[k]
        r = fwd[i - 1]
        fwd[i] += np.logaddexp(r + t[1, 1], t[0, 1]) - np.logaddexp(r + t[1, 0], t[0, 0])
    for k in range(len(steps) - 1, 0, -1):
        i = steps[k]
        r = unary[i] + bwd[i]
        bwd[i - 1] = np.logaddexp(r + t[1, 1], t[1, 0]) - np.logaddexp(r + t[0, 1], t[0, 0])
        a = fwd[i - 1]
        joint = np.stack([np.full(len(i), t[0, 0]), r + t[0, 1], a + t[1, 0], a + r + t[1, 1]])
        joint = np.exp(joint - joint.max(0))
        expected += (joint / joint.sum(0)).sum(1).reshape(2, 2)
    return 1 / (1 + np.exp(-np.clip(fwd + bwd, -60, 60))), expected, fwd


def aggregate(p: np.ndarray, weight: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Length-weighted mean of the lines' P(good); 0 for documents without any."""
    total = np.bincount(rows, weight, n)
    return np.bincount(rows, weight * p, n) / np.maximum(total, 1)


def fit(x: np.ndarray, weight: np.ndarray, rows: np.ndarray, quality: np.ndarray, steps: int = 120) -> dict:
    """Trains the field by gradient ascent on its conditional log-likelihood. Lines first bear their document's label; then lines of
    bad documents that the model takes for good by their own features are relabelled (never more than half of a document's length)
    and training goes on. A logistic fit turns the aggregated marginals into a score."""
    wide = with_neighbours(x, rows)
    y = quality[rows].astype(float)
    by_class = np.bincount(quality, minlength=2).astype(float)
    share = weight / np.maximum(np.bincount(rows, weight, len(quality)), 1)[rows]
    chain = (0.5 / np.maximum(by_class, 1))[quality]  # both classes count alike
    w, trans = np.zeros(wide.shape[1]), np.zeros((2, 2))
    m, v, k = np.zeros(w.size + 4), np.zeros(w.size + 4), 0
    inner = np.r_[False, rows[1:] == rows[:-1]] if len(rows) else np.zeros(0, bool)
    lines = np.bincount(rows, minlength=len(quality)).astype(float)
    scale = chain[rows] / np.maximum(lines, 1)[rows]
    for again in range(2):
        for _ in range(steps):
            p, expected, _ = marginals(wide @ w, rows, trans)
            g = ((y - p) * (scale + chain[rows] * share) / 2) @ wide - 1e-4 * w
            seen = np.zeros((2, 2))
            if inner.any():
                np.add.at(seen, (y[:-1][inner[1:]].astype(int), y[1:][inner[1:]].astype(int)), 1)
            gt = (seen - expected) / max(len(rows), 1) - 1e-3 * trans
            g, k = np.r_[g, gt.ravel()], k + 1
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            step = 0.15 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
            w, trans = w + step[:-4], trans + 0.3 * step[-4:].reshape(2, 2)
        if not again:
            own = 1 / (1 + np.exp(-np.clip(x @ w[: x.shape[1]], -60, 60)))
            turn = (quality[rows] == 0) & (own > 0.8)
            most = np.bincount(rows, weight * turn, len(quality)) <= 0.5 * np.bincount(rows, weight, len(quality))
            y = np.where(turn & most[rows], 1.0, quality[rows])
    p, _, _ = marginals(wide @ w, rows, trans)
    mean, a, b = aggregate(p, weight, rows, len(quality)), 6.0, -3.0
    for _ in range(500):
        s = 1 / (1 + np.exp(-(a * mean + b)))
        e = (quality - s) * chain
        a, b = a + 5 * (e @ mean) - 1e-3 * a, b + 5 * e.sum()
    return {"w": w, "trans": trans, "a": max(a, 1e-3), "b": b}


def score_batch(model: dict, column: pa.Array) -> np.ndarray:
    data, offsets = kernel.buffers(column)
    out = np.zeros(len(column))
    for i, j in kernel.chunks(offsets):
        o = offsets[i : j + 1] - offsets[i]
        x, weight, rows = features(data[offsets[i] : offsets[j]], o)
        if len(x):
            p, _, _ = marginals(with_neighbours(x, rows) @ model["w"], rows, model["trans"])
            mean = aggregate(p, weight, rows, j - i)
            got = 1 / (1 + np.exp(-(model["a"] * mean + model["b"])))
            out[i:j] = np.where(np.bincount(rows, minlength=j - i) > 0, got, 0.0)
    return out


def _fitted(batches):
    """The model of a sample (text, quality) as one row; none without both classes."""
    batches = list(batches)
    if not batches:
        return
    rows = pa.Table.from_batches(batches).combine_chunks()
    quality = rows.column(1).to_numpy().astype(int)
    if len(set(quality.tolist())) == 2:
        data, offsets = kernel.buffers(rows.column(0).chunk(0))
        m = fit(*features(data, offsets), quality)
        yield pa.record_batch([pa.array([m["w"].tolist()]), pa.array([m["trans"].ravel().tolist()]), pa.array([m["a"]]), pa.array([m["b"]])], ["w", "trans", "a", "b"])


def train(docs: DataFrame, labels: DataFrame) -> dict | None:
    """Model from a bounded sample: of each class the SAMPLE labelled documents first in hash order, among those of at most
    SAMPLE_BYTES; the sample joins the documents as a broadcast of at most twice that many ids. One task trains on it, the driver gets
    the weights only. None without both classes."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold != 2))
    usable = usable.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    pick = [usable.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * SAMPLE) for q in (0, 1)]
    sample = F.broadcast(pick[0].unionAll(pick[1]))
    text = F.coalesce(F.col("text"), F.lit(""))
    got = docs.select("doc_id", "text").join(sample, "doc_id").where(F.octet_length(text).between(1, SAMPLE_BYTES))
    first = lambda q: got.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(SAMPLE)
    rows = first(0).unionAll(first(1)).select("text", F.col("quality").cast("int").alias("quality"))
    found = rows.coalesce(1).mapInArrow(lean(_fitted), "w array<double>, trans array<double>, a double, b double").first()
    return found and {"w": np.array(found.w), "trans": np.array(found.trans).reshape(2, 2), "a": found.a, "b": found.b}


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, score of every document, whole texts, one pass without a shuffle. Null, empty and blank texts score 0; without a
    model (labels of one class only or none) every score is 0.5."""
    if model is None:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0.5).alias("score"))

    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(score_batch(model, batch.column(1)))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        lean(run), "doc_id long, score double"
    )


def keep(docs: DataFrame, model: dict | None) -> DataFrame:
    """The rows of docs whose score reaches THRESHOLD, with all columns; all rows without a model. One pass, no join."""
    if model is None:
        return docs
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(score_batch(model, batch.column(at)) >= THRESHOLD))

    return docs.mapInArrow(lean(run), docs.schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    return score(docs, train(docs, labels)).select(
        "doc_id",
        F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
