"""Document rates that bring a corpus to target token shares of domains, with soft membership.

A multinomial logistic regression over the words of labelled documents gives every document a posterior over the domains of
the labelled table (each combination of its label columns is a domain). A document of n tokens and rate r counts n * r * p
tokens towards each domain. The rates are those nearest to 1 found by projected gradient steps on the squared misfit of the
domain totals: each step moves a document along its posterior and cuts at 0. The misfit is weighted by the inverse of
`sum(n * p * p')` over the documents whose rate is above 0, which makes a single step exact while no rate is cut.

Each round is one job that returns one number per domain; a document's rate is a function of its posterior and the rounds'
steps, so nothing per document is kept between rounds.

The classifier is fitted on about `FIT_ROWS` labelled documents at most (by a hash of their ids, under a threshold that follows
from their number) and on the `VOCABULARY` most frequent of their words; posteriors, totals and rates cover all documents. A
domain that has a target but no row to learn from cannot be aimed at: it is named in a warning, and the others share its part. Null and empty texts have no
tokens and the posterior of a text without known words. Without labelled rows there is one domain and every rate is 1, and
with a single domain the posterior is 1. Repeated rows each get a rate. Columns of documents named like the results are
replaced.
"""

from __future__ import annotations

import re
import warnings

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .common import released, small_batches, stored
from .tokens import SPACES, Words, slices, utf8, words_of

FIT_ROWS = 20_000
VOCABULARY = 1 << 15
ROUNDS = 50
REGULARISATION = 0.0002
CLOSE = 1e-6
# Shares of tokens by (quality, toxic).
TARGETS = {"1/0": 0.96, "1/1": 0.02, "0/0": 0.015, "0/1": 0.005}
# Tokens are runs of ASCII letters and of characters beyond ASCII, and every other sign that is no space.
_TOKEN = re.compile(rb"[a-z\x80-\xff]+|[^ \t-\r]")
_APART = bytes(b for b in range(128) if not chr(b).isalpha())
_SIGN = np.zeros(256, bool)
_SIGN[[b for b in _APART if b not in SPACES]] = True


def labelled_domains(labels: DataFrame, columns: list[str]) -> DataFrame:
    """doc_id and domain, the label columns joined by a slash. Rows with a null label have none."""
    known = labels.dropna(subset=["doc_id", *columns])
    return known.select(
        F.col("doc_id").cast("long"), F.concat_ws("/", *[F.col(c).cast("string") for c in columns]).alias("domain")
    ).distinct()


def _term_lists(batches):
    """The distinct tokens of each text."""
    for batch in batches:
        found = (sorted(set(_TOKEN.findall(t.encode().lower()))) for t in batch.column("text").to_pylist())
        terms = [[w.decode() for w in own] for own in found]
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.list_(pa.string())), batch.column("label")], ["terms", "label"])


class Scorer:
    """Token counts and posteriors of whole batches. A word is found by its 64-bit key; no Python object is made per token."""

    def __init__(self, vocabulary: list[str], weights: np.ndarray, start: np.ndarray):
        """weights: a row per word of the vocabulary, a column per domain; start: the intercepts."""
        self.start = start
        self.signs = np.zeros((128, len(start)))
        is_sign = np.array([len(w) == 1 and ord(w) < 128 and bool(_SIGN[ord(w)]) for w in vocabulary], bool)
        for j in np.flatnonzero(is_sign):
            self.signs[ord(vocabulary[j])] = weights[j]
        words = np.flatnonzero(~is_sign)
        keys = words_of(pa.array([vocabulary[j] for j in words], pa.string()), _APART).keys()
        order = np.argsort(keys)
        self.keys, self.weights = keys[order], weights[words[order]]

    def score(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each text, and its posterior."""
        n, m = len(column), len(self.keys)
        raw = np.tile(self.start, (n, 1))
        data, offsets = utf8(column)
        words = Words(data, offsets, _APART)
        at = np.flatnonzero(_SIGN[data])
        owner = np.searchsorted(offsets, at, "right") - 1
        seen = np.zeros((n, 128), bool)
        seen[owner, data[at]] = True
        raw += seen @ self.signs
        if m and len(words):
            keys = words.keys()
            place = np.minimum(np.searchsorted(self.keys, keys), m - 1)
            hit = self.keys[place] == keys
            pair = np.unique(words.owners()[hit] * m + place[hit])
            for c in range(raw.shape[1]):
                raw[:, c] += np.bincount(pair // m, weights=self.weights[pair % m, c], minlength=n)
        p = np.exp(raw - raw.max(axis=1, keepdims=True))
        return words.counts + np.bincount(owner, minlength=n), p / p.sum(axis=1, keepdims=True)


class Membership:
    """Posteriors over domains from the words of a text."""

    def __init__(self, docs: DataFrame, domains: DataFrame):
        domains = stored(domains, "domains")
        n = domains.count()
        if n > FIT_ROWS:
            domains = domains.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit((FIT_ROWS << 30) // n))
        small = stored(domains, "labelled")
        self.domains = [r["domain"] for r in small.select("domain").distinct().orderBy("domain").collect()]
        self.model = Scorer([], np.zeros((0, 1)), np.zeros(1))
        if len(self.domains) < 2:
            return
        names = F.array(*[F.lit(d) for d in self.domains])
        # About FIT_ROWS ids travel to the tasks at most.
        rows = docs.select(F.col("doc_id").cast("long"), self._text(docs).alias("text"))
        rows = rows.join(F.broadcast(small), "doc_id")
        rows = rows.select("text", (F.array_position(names, F.col("domain")) - 1).cast("double").alias("label"))
        rows = stored(rows.mapInArrow(released(_term_lists), "terms array<string>, label double"), "fit")
        try:
            vector = CountVectorizer(inputCol="terms", outputCol="x", vocabSize=VOCABULARY, minDF=2.0, binary=True).fit(rows)
        except Exception as error:  # no word is in two labelled texts
            if "vocabulary" not in str(error):
                raise
            self.domains = self.domains[:1]
            return
        regression = LogisticRegression(
            featuresCol="x", family="multinomial", regParam=REGULARISATION, elasticNetParam=0.9, maxIter=60, standardization=False
        )
        # At most FIT_ROWS short vectors: few tasks make each pass of the fit cheap.
        fitted = stored(vector.transform(rows).select("x", "label").coalesce(4), "vectors")
        if fitted.select("label").distinct().count() < len(self.domains):
            missing = {int(r["label"]) for r in fitted.select("label").distinct().collect()}
            self.domains = [d for k, d in enumerate(self.domains) if k in missing] or self.domains[:1]
            if len(self.domains) < 2:
                return
            order = F.array(*[F.lit(float(k)) for k in sorted(missing)])
            fitted = fitted.withColumn("label", (F.array_position(order, F.col("label")) - 1).cast("double"))
        model = regression.fit(fitted)
        weights = model.coefficientMatrix.toArray().T
        used = np.flatnonzero(np.any(weights != 0, axis=1))
        # At most VOCABULARY words, those with a weight.
        vocabulary = vector.vocabulary
        self.model = Scorer([vocabulary[j] for j in used], weights[used], model.interceptVector.toArray())

    @staticmethod
    def _text(docs: DataFrame) -> F.Column:
        return F.coalesce(F.col("text").cast("string"), F.lit(""))

    def posteriors(self, docs: DataFrame) -> DataFrame:
        """docs with n_tokens and posterior, an array in the order of domains."""
        out = docs.drop("n_tokens", "posterior")
        name = next(c for c in out.columns if c.lower() == "text")
        sent = docs.sparkSession.sparkContext.broadcast(self.model)

        def run(batches):
            for batch in batches:
                for part in slices(batch, name):
                    n, p = sent.value.score(part.column(name))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(n, pa.int64()), pa.array(list(p), pa.list_(pa.float64()))],
                        [*part.schema.names, "n_tokens", "posterior"],
                    )

        added = [StructField("n_tokens", LongType()), StructField("posterior", ArrayType(DoubleType()))]
        return out.mapInArrow(released(run), StructType([*out.schema.fields, *added]))


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    p = np.stack(batch.column("posterior").to_numpy(zero_copy_only=False))
    return p, batch.column("n_tokens").to_numpy().astype(float)


def _rate(p: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    r = np.ones(len(p))
    for s in steps:
        r = np.maximum(0, r - p @ s)
    return r


def _sums(members: DataFrame, steps: list[np.ndarray], d: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of n * r * p over all documents, and of n * p * p' over those whose rate is not cut."""

    def run(batches):
        total = np.zeros(d + d * d)
        for batch in batches:
            if batch.num_rows:
                p, n = _matrix(batch)
                r = _rate(p, steps)
                total[:d] += (n * r) @ p
                total[d:] += ((p * (n * (r > 0))[:, None]).T @ p).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["at", "s"])

    out = np.zeros(d + d * d)
    for r in members.mapInArrow(run, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect():
        out[r["at"]] = r["s"]
    return out[:d], out[d:].reshape(d, d)


def fit_rates(members: DataFrame, targets: np.ndarray) -> list[np.ndarray]:
    """The steps of the projected gradient descent. members: posterior, n_tokens; targets: tokens by domain.

    It ends when the totals match the targets, when a round gains nothing more (targets out of reach), or after ROUNDS.
    """
    steps: list[np.ndarray] = []
    best = np.inf
    for _ in range(ROUNDS):
        totals, gram = _sums(members, steps, len(targets))
        miss = totals - targets
        off = np.abs(miss).sum() / max(targets.sum(), 1)
        if off <= CLOSE or off > 0.999 * best:
            return steps if off <= best else steps[:-1]
        best = off
        steps.append(np.linalg.pinv(gram, rcond=1e-9, hermitian=True) @ miss)
    return steps


def mix(
    docs: DataFrame,
    domains: DataFrame,
    shares: dict[str, float],
    tokens: int | None = None,
    examples: DataFrame | None = None,
) -> tuple[DataFrame, list[str]]:
    """docs with n_tokens, posterior, rate and copies, and the domains in the posterior's order.

    shares: target share of tokens by domain; domains that are not named get 0, and the shares are scaled to 1. examples: the
    documents that the labels are of, if not docs. tokens: the
    total to reach, that of docs if not given. copies is the rate rounded up or down by a hash of the document, so that its
    mean over documents is the rate.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("n_tokens", "posterior", "rate", "copies")
    member = Membership(docs if examples is None else examples, domains)
    absent = sorted(d for d, share in shares.items() if share > 0 and d not in member.domains)
    if absent:
        warnings.warn(f"no labelled document of {', '.join(absent)}: the other domains share these targets", stacklevel=2)
    # Written once: texts are tokenised in one pass, whatever number of rounds follows.
    whole = stored(member.posteriors(docs), "members")
    slim = whole.select("n_tokens", "posterior")
    total = slim.agg(F.sum("n_tokens")).first()[0] or 0
    wanted = np.array([shares.get(d, 0.0) for d in member.domains] or [1.0])
    wanted = wanted / wanted.sum() if wanted.sum() else np.ones(len(wanted)) / len(wanted)
    steps = fit_rates(slim, wanted * (total if tokens is None else tokens)) if total else []

    rate = F.lit(1.0)
    for s in steps:
        move = sum((F.lit(float(v)) * F.col("posterior")[k] for k, v in enumerate(s)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate - move)
    out = whole.withColumn("rate", rate)
    dealt = F.pmod(F.xxhash64(F.lit("mix"), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor("rate") + (dealt < F.col("rate") - F.floor("rate")).cast("long")
    return out.withColumn("copies", copies), member.domains
