"""Documents mixed to target weights by soft membership.

A classifier learned from a labelled table gives every document a probability of each
domain. A document's rate is how often it should be drawn, so rate x tokens x
probability, summed over all documents, is a domain's expected number of tokens. The
rates that bring these totals nearest to the targets are found by projected gradient
(with momentum) on the squared distance, over all documents:

    y = r + momentum * (r - before);  r = max(0, y - step * sum_d p_d * miss_d)

where miss_d is the domain's excess over its target, relative to its size. All a document
needs to follow this is its probabilities and the numbers miss_d of every round, so rates
are never stored: each round is one pass that replays the rounds before and sums the
domains' totals, and only these totals reach the driver.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.batches import extend, map_arrow, received, send
from daymark.llm.learning import bounded, held_out
from daymark.llm.words import plain_word_numbers
from daymark.session import stage

# Domains of the labelled table and their shares of the mixture.
TARGETS = {"sound": 0.92, "poor": 0.06, "toxic": 0.02}
SAMPLE = 8_000  # labelled documents the classifier learns from, at most about so many
BINS, COLUMNS = 2**15, 500  # hashed words, and how many of the bins the classifier looks at
ROUNDS, CLOSE = 40, 1e-3
SEED = 1
# Sizes of the classifier's other features.
_LOOKS = ("length", "distinct", "repeated", "upper", "digits", "marks", "lines")
WIDTH = COLUMNS + len(_LOOKS) + 1
# Bytes by kind: 1 upper case, 2 digit, 3 other mark, 4 line end, 0 the rest.
_KINDS = np.array(
    [1 if 65 <= c < 91 else 2 if 48 <= c < 58 else 4 if c == 10 else 3 if 32 < c < 127 and not 97 <= c < 123 else 0 for c in range(256)]
)


def domain_of(quality: Column, toxic: Column) -> Column:
    return F.when(toxic > 0, "toxic").when(quality > 0, "sound").when(quality <= 0, "poor")


def bins_of(numbers: np.ndarray) -> np.ndarray:
    """The distinct hash bins of the words with these numbers."""
    return np.unique((numbers >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64))


def look(text: bytes | None, column: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of tokens, and the features: which chosen bins the words meet, and how the text looks.

    `column` has the feature of each bin, -1 for those not chosen.
    """
    words = plain_word_numbers(text)
    x = np.zeros(WIDTH, np.float32)
    x[-1] = 1.0
    if not len(words):
        return 0, x
    met = column[bins_of(words)]
    x[met[met >= 0]] = 1.0
    n, size = len(words), len(text)
    upper, digits, marks, lines = np.bincount(_KINDS[np.frombuffer(text, np.uint8)], minlength=5)[1:]
    x[COLUMNS:-1] = (
        np.log(n) / 10,
        len(np.unique(words)) / n,
        (words[1:] == words[:-1]).sum() / n,
        upper / size,
        digits / size,
        marks / size,
        10 * lines / size,
    )
    return n, x


def choose_columns(found: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The COLUMNS bins that tell most about the domain (G squared), from documents per bin and domain."""
    rate = found.sum(axis=1, keepdims=True) / max(sizes.sum(), 1)
    gain = np.zeros(len(found))
    for n, share in ((found, rate), (sizes - found, 1 - rate)):
        expected = np.maximum(share * sizes, 1e-9)
        gain += np.where(n > 0, n * np.log(np.maximum(n, 1e-9) / expected), 0.0).sum(axis=1)
    column = np.full(len(found), -1, np.int32)
    best = np.argsort(-gain, kind="stable")[:COLUMNS]
    column[best[gain[best] > 0]] = np.arange((gain[best] > 0).sum())
    return column


class Classifier:
    """Softmax over the features of `look`."""

    def __init__(self, column: np.ndarray, weights: np.ndarray):
        self.column, self.weights = column, weights

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.weights
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def learn_domains(docs: DataFrame, labelled: DataFrame, domains: list[str], sample: int = SAMPLE) -> Classifier:
    """From `labelled` (doc_id, domain), held-out ids left out; even odds without usable labels."""
    known = labelled.where(~held_out() & F.col("domain").isin(domains)).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    chosen = F.broadcast(bounded(known, sample, "doc_id"))  # bounded above
    taught = stage(docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "domain"), "sample")
    place = {d: k for k, d in enumerate(domains)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((BINS + 1, len(domains)), np.int64)  # the last line counts documents
        for batch in batches:
            for text, domain in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist()):
                found[bins_of(plain_word_numbers(text.as_py())), place[domain]] += 1
                found[BINS, place[domain]] += 1
        bins, kinds = np.nonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(kinds), pa.array(found[bins, kinds])], ["bin", "k", "n"])

    found = np.zeros((BINS + 1, len(domains)))
    for r in map_arrow(taught, count, "bin long, k long, n long").groupBy("bin", "k").agg(F.sum("n").alias("n")).toLocalIterator():
        found[r.bin, r.k] = r.n
    column = choose_columns(found[:BINS], found[BINS])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [look(t.as_py(), column)[1].tobytes() for t in batch.column(0).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.binary())], ["domain", "x"])

    rows = map_arrow(taught, features, "domain string, x binary").collect()  # the bounded sample: 2 KB a row
    weights = np.zeros((WIDTH, len(domains)))
    if rows:
        x = np.frombuffer(b"".join(r.x for r in rows), np.float32).reshape(-1, WIDTH)
        y = np.eye(len(domains), dtype=np.float32)[[place[r.domain] for r in rows]]
        weights = _softmax_fit(x, y)
    return Classifier(column, weights.astype(np.float32))


def _softmax_fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.1, decay: float = 1e-3) -> np.ndarray:
    """Adam on the whole sample."""
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = x.T @ (p - y) / len(x) + decay * w
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return w


def replay(p: np.ndarray, misses: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the rounds given, and the point where the next round looks."""
    rates = before = np.ones(len(p))
    ahead = rates
    for t, miss in enumerate(misses, 1):
        before, rates = rates, np.maximum(0.0, ahead - p @ miss)
        ahead = rates + (t - 1) / (t + 2) * (rates - before)
    return rates, ahead


def _posteriors(rows: pa.StructArray) -> np.ndarray:
    own = rows.field("p")
    return own.flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1)


def fit_rates(memberships: DataFrame, targets: np.ndarray, rounds: int = ROUNDS) -> list[np.ndarray]:
    """What every round subtracts, from `memberships` (n, p) and the tokens each domain should have.

    Stops when every domain is within CLOSE of its target, or after `rounds`, with a warning that
    names the shares reached: targets may be out of reach for memberships that overlap.
    """

    def totals(misses: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, ahead = np.zeros(len(targets)), np.zeros(len(targets))
            for batch in batches:
                p = _posteriors(batch.column(0))
                n = batch.column(0).field("n").to_numpy(zero_copy_only=False)
                rates, next_look = replay(p, misses)
                at += (rates * n) @ p
                ahead += (next_look * n) @ p
            yield pa.RecordBatch.from_arrays([pa.array([*at, *ahead]), pa.array(np.arange(2 * len(targets)))], ["total", "k"])

        rows = map_arrow(memberships.select(F.struct("n", "p")), sums, "total double, k long")
        found = np.zeros(2 * len(targets))
        for r in rows.groupBy("k").agg(F.sum("total").alias("total")).collect():
            found[r.k] = r.total
        return found[: len(targets)], found[len(targets) :]

    misses: list[np.ndarray] = []
    size, ahead = totals(misses)
    scale = np.maximum(size, 1e-9)
    at = size
    while len(misses) < rounds and np.abs(at - targets).max() > CLOSE * max(targets.sum(), 1e-9):
        misses.append((ahead - targets) / scale)
        at, ahead = totals(misses)
    if np.abs(at - targets).max() > CLOSE * max(targets.sum(), 1e-9):
        got, wanted = ((x / max(x.sum(), 1e-9)).round(3).tolist() for x in (at, targets))
        warnings.warn(f"mixing: after {len(misses)} rounds the shares are {got}, wanted {wanted}", stacklevel=2)
    return misses


def reached(mixed: DataFrame, domains: list[str]) -> DataFrame:
    """(domain, tokens, share): the expected tokens of each domain in what `mix` returned."""
    names = sorted(domains)
    sums = [F.coalesce(F.sum(F.col("n_tokens") * F.col("rate") * F.get("p", F.lit(k))), F.lit(0.0)).alias(d) for k, d in enumerate(names)]
    tokens = mixed.agg(*sums).withColumn("_all", sum((F.col(f"`{d}`") for d in names), F.lit(0.0)))
    return tokens.unpivot(["_all"], names, "domain", "tokens").select("domain", "tokens", F.try_divide("tokens", "_all").alias("share"))


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    shares: dict[str, float] | None = None,
    budget: float | None = None,
    keep: list[str] | None = None,
    seed: int = SEED,
    sample: int = SAMPLE,
) -> DataFrame:
    """`row` (the `keep` columns), `n_tokens`, `p` (by domain), `domain`, `rate` and `copies` of every document.

    `labelled` has doc_id and domain; `shares` are the domains' parts of the mixture, `budget` its
    tokens (default: as many as there are). `copies` is the rate rounded up or down at random, so that its
    mean is the rate; equal rows get equal copies. Texts without tokens weigh nothing;
    they get the probabilities of an empty text and the rate these lead to. Without usable labels every
    domain is equally likely. Ties go to the domain first by name. Empty tables give no rows.
    """
    domains = sorted(shares or TARGETS)
    wanted = np.array([(shares or TARGETS)[d] for d in domains])
    spark = docs.sparkSession
    model = send(spark, learn_domains(docs, labelled, domains, sample))
    kept = list(docs.columns if keep is None else keep)
    needed = list(dict.fromkeys([*kept, *(c for c in ("doc_id", "text") if c in docs.columns)]))

    def start() -> Callable:
        classifier = received(model)

        def compute(rows: pa.StructArray):
            texts = rows.field("text").cast(pa.binary()).to_pylist()
            seen = [look(t, classifier.column) for t in texts]
            p = classifier.posteriors(np.array([x for _, x in seen])) if seen else np.zeros((0, len(domains)))
            draws = [
                xxhash.xxh3_64_intdigest(f"{seed} {i} ".encode() + (t or b"")) / 2**64
                for i, t in zip(rows.field("doc_id").to_pylist(), texts)
            ]
            # Rounded, so that both passes see the same numbers however rows are batched.
            return [
                pa.array([n for n, _ in seen], pa.int64()),
                pa.array(list(np.round(p.astype(np.float64), 6)), pa.list_(pa.float64())),
                pa.array(draws, pa.float64()),
            ]

        return compute

    judged = extend(docs.select(*needed), start, "n long, p array<double>, draw double", kept)
    judged = stage(judged, "memberships")
    total = judged.agg(F.sum("n")).first()[0] or 0
    misses = fit_rates(judged, wanted / wanted.sum() * (budget or total))
    rounds = spark.sparkContext.broadcast(misses)  # ROUNDS x domains

    def rates() -> Callable:
        def compute(rows: pa.StructArray):
            p = _posteriors(rows)
            rate = np.round(replay(p, rounds.value)[0], 6)
            draw = rows.field("draw").to_numpy(zero_copy_only=False)
            copies = np.floor(rate) + (draw < rate - np.floor(rate))
            names = [domains[k] for k in p.argmax(axis=1)] if len(p) else []
            return [pa.array(names, pa.string()), pa.array(rate), pa.array(copies.astype(np.int64))]

        return compute

    done = extend(judged, rates, "domain string, rate double, copies long", ["row", "n", "p"])
    return done.select("row.row", F.col("row.n").alias("n_tokens"), F.col("row.p").alias("p"), "domain", "rate", "copies")


def mixing_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    labelled = labels.select("doc_id", domain_of(F.col("quality"), F.col("toxic")).alias("domain"))
    mixed = mix(docs, labelled, keep=["doc_id"])
    parts = [F.get("p", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(sorted(TARGETS))]
    return mixed.select("row.doc_id", "n_tokens", "domain", *parts, "rate", "copies")


def mixed_documents(docs: DataFrame, labels: DataFrame, shares: dict[str, float]) -> DataFrame:
    """The documents drawn at least once, in their own columns, with `rate` and `copies`."""
    labelled = labels.select("doc_id", domain_of(F.col("quality"), F.col("toxic")).alias("domain"))
    return mix(docs, labelled, shares).where("copies > 0").select("row.*", "rate", "copies")
