"""Document quality by a regularised quadratic discriminant.

Every whole text gives a fixed vector of statistics (lengths, character classes, repetition, line shape), transformed so that
shares and counts are closer to normal. Each class of the labelled rows has a mean and a covariance, shrunk towards the pooled
covariance and towards its diagonal, as much as serves rows of the training folds that the fit has not seen. The score is the posterior of class 1: the difference of the two log densities, from
Mahalanobis distances by Cholesky factors that are computed once and sent along.

The moments are sums over all labelled rows, so training needs no sample. Null and empty texts have the statistics of a text
of no words and get a score like any other. Repeated label rows each count; null labels count nowhere. If a class has no
labelled row, the score is the smoothed share of the other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, small_batches, stored
from .tokens import SPACES, Words, shingles, slices, utf8

# How far covariances may be shrunk, to the pooled one and to the diagonal; which pair is used, folds of the training rows say.
SHRINKAGE = [(pooled, diagonal) for pooled in (0.05, 0.1, 0.3, 0.6) for diagonal in (0.05, 0.3, 0.6, 0.9)]
FOLDS = 4
THRESHOLD = 0.7
_EPS = 1e-3
# Weight, in words, bytes and lines, of a usual value that steadies the shares of short texts.
WORDS, BYTES, LINES = 15, 80, 2
_SYMBOLS = b"#$%&*|<>{}[]=\\~^_@+/`"
_STOPS = b".,;:!?"


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    run = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=run[1:])
    return (run[offsets[1:]] - run[offsets[:-1]]).astype(float)


def _by_owner(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n)


def _top_share(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each text, and how often its most frequent one occurs."""
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(keys)))
    top = np.zeros(n)
    np.maximum.at(top, owner[at], runs)
    return np.bincount(owner[at], minlength=n).astype(float), top


def statistics(column: pa.Array) -> np.ndarray:
    """A row of transformed statistics for each text."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    words = Words(data, offsets, SPACES, lower=False)
    count, owner = words.counts.astype(float), words.owners()
    length = (words.ends - words.starts).astype(float)
    some, bytes_ = np.maximum(count, 1), np.maximum(size, 1)

    def of(chars: bytes) -> np.ndarray:
        table = np.zeros(256, bool)
        table[list(chars)] = True
        return table[data]

    upper, lower = of(bytes(range(65, 91))), of(bytes(range(97, 123)))
    letters = np.maximum(_per_text(upper | lower, offsets), 1)
    mean = _by_owner(length, owner, n) / some
    spread = np.sqrt(np.maximum(_by_owner(length**2, owner, n) / some - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, owner, length)
    distinct, top = _top_share(words.keys(), owner, n)
    lines = Words(data, offsets, b"\n\r", lower=False)
    line_count = np.maximum(lines.counts, 1).astype(float)
    line_distinct, _ = _top_share(lines.keys(), lines.owners(), n)
    line_top = np.zeros(n)
    np.maximum.at(line_top, lines.owners(), (lines.ends - lines.starts).astype(float))
    grams = shingles(words, 3)[1].astype(float)
    ends = np.isin(data[words.ends - 1], list(_STOPS)) if len(words) else np.zeros(0, bool)
    odd_end = np.isin(data[words.ends - 1], list(_SYMBOLS)) if len(words) else np.zeros(0, bool)
    capital = upper[words.starts] if len(words) else np.zeros(0, bool)
    run = np.concatenate([[0], np.cumsum(upper)])
    shout = (run[words.ends] - run[words.starts]) * 2 > length
    single = length == 1

    def share(x: np.ndarray, whole: np.ndarray, usual: float, weight: float) -> np.ndarray:
        return np.log((x + weight * usual) / (whole + weight) + _EPS)

    return np.stack(
        [
            np.log1p(count),
            (mean * count + 5 * WORDS) / (count + WORDS),
            np.log((spread**2 * count + 9 * WORDS) / (count + WORDS)),
            np.log((longest * count + 10 * WORDS) / (count + WORDS)),
            share(_per_text(upper, offsets), letters, 0.03, BYTES),
            share(_per_text(of(b"0123456789"), offsets), bytes_, 0.001, BYTES),
            share(_per_text(of(_SYMBOLS), offsets), bytes_, 0.001, BYTES),
            share(_per_text(of(b"!?"), offsets), bytes_, 0.001, BYTES),
            share(_per_text(of(b".,;:"), offsets), bytes_, 0.02, BYTES),
            share(_per_text(of(SPACES), offsets), bytes_, 0.16, BYTES),
            share(_per_text(data >= 0x80, offsets), bytes_, 0.02, BYTES),
            share(line_count - 1, some, 0.02, WORDS),
            np.log1p(line_top / bytes_ * np.minimum(size, 1000)),
            share(line_distinct, line_count, 1.0, LINES),
            share(distinct, some, 0.8, WORDS),
            share(top, some, 0.05, WORDS),
            share(grams, np.maximum(some - 2, 1), 1.0, WORDS),
            share(_by_owner(ends, owner, n), some, 0.1, WORDS),
            share(_by_owner(odd_end, owner, n), some, 0.001, WORDS),
            share(_by_owner(capital, owner, n), some, 0.1, WORDS),
            share(_by_owner(shout, owner, n), some, 0.005, WORDS),
            share(_by_owner(single, owner, n), some, 0.02, WORDS),
            share(_by_owner(length <= 3, owner, n), some, 0.4, WORDS),
        ],
        axis=1,
    )


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of its text."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                x = statistics(part.column("text"))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "x"])

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(released(run), "doc_id long, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)) if len(column) else np.zeros((0, 1))


Sums = dict[int, tuple[float, np.ndarray, np.ndarray]]


def moments(labelled: DataFrame) -> dict[int, Sums]:
    """Per fold and label: rows, sum of x, sum of the outer products. labelled: label, fold, x."""

    def run(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x, y, f = _matrix(batch.column("x")), batch.column("label").to_numpy(), batch.column("fold").to_numpy()
            for label, part in set(zip(y.tolist(), f.tolist(), strict=True)):
                own = x[(y == label) & (f == part)]
                own = np.hstack([np.ones((len(own), 1)), own])
                sums[label, part] = sums.get((label, part), 0) + own.T @ own
        for (label, part), s in sums.items():
            at = pa.array(np.arange(s.size), pa.int32())
            label, part = (pa.array(np.full(s.size, v), pa.int32()) for v in (label, part))
            yield pa.RecordBatch.from_arrays([label, part, at, pa.array(s.ravel())], ["label", "fold", "at", "s"])

    total = labelled.select("label", "fold", "x").mapInArrow(released(run), "label int, fold int, at int, s double")
    total = total.groupBy("label", "fold", "at").agg(F.sum("s").alias("s"))
    found: dict[tuple[int, int], dict[int, float]] = {}
    for label, part, at, s in total.collect():  # one row per label, fold and pair of statistics
        found.setdefault((part, label), {})[at] = s
    out: dict[int, Sums] = {}
    for (part, label), sums in found.items():
        d = round(len(sums) ** 0.5)
        s = np.array([sums[i] for i in range(len(sums))]).reshape(d, d)
        out.setdefault(part, {})[label] = float(s[0, 0]), s[0, 1:], s[1:, 1:]
    return out


def _added(parts: list[Sums]) -> Sums:
    out: Sums = {}
    for sums in parts:
        for label, own in sums.items():
            out[label] = tuple(a + b for a, b in zip(out[label], own, strict=True)) if label in out else own
    return out


class Discriminant:
    """Quadratic discriminant of labels 0 and 1."""

    def __init__(self, sums: Sums, to_pooled: float = 0.3, to_diagonal: float = 0.3):
        self.n = {k: sums[k][0] if k in sums else 0.0 for k in (0, 1)}
        self.prior = (self.n[1] + 1) / (self.n[0] + self.n[1] + 2)
        self.parts = None
        if min(self.n.values()) < 2:
            return
        mean = {k: sums[k][1] / self.n[k] for k in (0, 1)}
        scatter = {k: sums[k][2] - self.n[k] * np.outer(mean[k], mean[k]) for k in (0, 1)}
        pooled = (scatter[0] + scatter[1]) / (self.n[0] + self.n[1])
        pooled += np.eye(len(pooled)) * (1e-6 + 1e-3 * np.trace(pooled) / len(pooled))
        self.parts = []
        for k in (0, 1):
            own = (1 - to_pooled) * scatter[k] / self.n[k] + to_pooled * pooled
            own = (1 - to_diagonal) * own + to_diagonal * np.diag(np.diag(own))
            factor = np.linalg.cholesky(own)
            self.parts.append((mean[k], np.linalg.inv(factor), np.log(np.diag(factor)).sum(), self.n[k]))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        if self.parts is None:
            return np.full(len(x), np.log(self.prior / (1 - self.prior)))
        logs = []
        for mean, inverse, half_log_det, n in self.parts:
            z = (x - mean) @ inverse.T
            logs.append(-0.5 * (z * z).sum(axis=1) - half_log_det + np.log(n))
        return logs[1] - logs[0]


def score(x: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id, score (posterior of label 1) for each row of features."""

    def run(batches):
        for batch in batches:
            odds = model.log_odds(_matrix(batch.column("x"))) if batch.num_rows else np.zeros(0)
            p = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    return x.mapInArrow(run, "doc_id long, score double")


def fold(of: int) -> F.Column:
    """crc32 of the id as text, by which rows are held out; rows without an id fall to 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % of, F.lit(0))


def _unseen_loss(labelled: DataFrame, folds: dict[int, Sums]) -> np.ndarray:
    """Log loss of each shrinkage over all rows, each row scored by the fit of the other folds."""
    models = {
        part: [Discriminant(_added([s for f, s in folds.items() if f != part]), *pair) for pair in SHRINKAGE] for part in folds
    }

    def run(batches):
        loss = np.zeros(len(SHRINKAGE))
        for batch in batches:
            x, y, f = _matrix(batch.column("x")), batch.column("label").to_numpy(), batch.column("fold").to_numpy()
            for part in np.unique(f):
                here = f == part
                for k, model in enumerate(models[int(part)]):
                    loss[k] += np.logaddexp(0, np.where(y[here] == 1, -1, 1) * model.log_odds(x[here])).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(loss)), pa.int32()), pa.array(loss)], ["k", "loss"])

    rows = labelled.select("label", "fold", "x").mapInArrow(released(run), "k int, loss double")
    out = np.zeros(len(SHRINKAGE))
    for row in rows.groupBy("k").agg(F.sum("loss").alias("loss")).collect():
        out[row["k"]] = row["loss"]
    return out


def fit(x: DataFrame, labels: DataFrame, label: str, held: F.Column) -> Discriminant:
    """The discriminant of the labelled rows that are not held out, shrunk as serves folds of these rows best."""
    known = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    labelled = stored(x.where(~held).join(known, "doc_id").select("label", part, "x"), "labelled")
    folds = moments(labelled)
    whole = _added(list(folds.values()))
    if len(folds) < 2 or Discriminant(whole).parts is None:
        return Discriminant(whole)
    return Discriminant(whole, *SHRINKAGE[int(np.argmin(_unseen_loss(labelled, folds)))])


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for each document. Rows of crc32 remainder 2 by 4 teach nothing."""
    held = fold(4) == 2
    x = stored(features(docs), "statistics")
    model = fit(x, labels, "quality", held)
    out = score(x, model)
    return out.select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, all columns as they are.

    The score is computed where the text is, so no text is shuffled.
    """
    model = fit(stored(features(docs), "statistics"), labels, "quality", fold(4) == 2)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                keep = 1 / (1 + np.exp(-np.clip(model.log_odds(statistics(part.column("text"))), -700, 700))) >= THRESHOLD
                yield part.filter(pa.array(keep))

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(released(run), docs.schema)
