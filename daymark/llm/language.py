"""Language identification as a mixture: shares of languages in every document.

Each language has a model of byte trigrams of lower-cased letters, learned from a bounded sample of
labelled training documents. A document's shares are fitted by expectation-maximisation
to its trigram counts. The set of languages is chosen by penalised likelihood: beginning
with the best single language, the one that raises the likelihood most is added while
the gain exceeds the penalty. The prediction is the language with the largest share.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.batches import extend, map_arrow
from daymark.llm.learning import held_out

# Labelled training documents of one language, at most about so many, are learned from.
SAMPLE = 2000
BINS = 2**15
ROUNDS = 30
# Log-likelihood a further language must add, per log of the number of trigrams.
PENALTY = 8.0
# Languages learned, at most; the model is BINS numbers for each. More are refused.
MOST_LANGUAGES = 1000
_NO_LETTER = re.compile(r"[\W\d_]+")


def trigrams(text: str | None) -> np.ndarray:
    """Bins of the byte trigrams of the text's letters, words set apart by spaces; empty without letters."""
    letters = _NO_LETTER.sub(" ", (text or "").lower()).strip()
    if not any(map(str.isalpha, letters)):
        return np.empty(0, np.int64)
    b = np.frombuffer(f" {letters} ".encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    h = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((h * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def learn(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and, for each, the log-probability of every bin. Reads text and lang of training rows only."""
    rows = docs.where(~held_out() & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    counts = [(r.lang, r.n) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return [], np.zeros((0, BINS))
    share = F.create_map(*(F.lit(v) for lang, n in counts for v in (lang, int(min(1.0, sample / n) * 2**31))))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**31)) < share[F.col("lang")])
    names = [lang for lang, _ in counts]
    place = {lang: k for k, lang in enumerate(names)}

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # A long text counts as much as any: its frequencies, not its length.
                found = trigrams(text)
                if len(found):
                    own = total.setdefault(lang, np.zeros(BINS))
                    own += np.bincount(found, minlength=BINS) * min(1.0, 5000 / len(found))
        for lang, own in total.items():
            bins = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(bins)), pa.array(bins), pa.array(own[bins])], ["lang", "bin", "n"]
            )

    found = map_arrow(chosen.select("lang", "text"), count, "lang string, bin long, n double")
    table = np.full((len(names), BINS), 0.05)
    # At most BINS rows per language.
    for r in found.groupBy("lang", "bin").agg(F.sum("n").alias("n")).toLocalIterator():
        table[place[r.lang], r.bin] += r.n
    return names, np.log(table / table.sum(axis=1, keepdims=True))


def _fit(likely: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Shares of the rows of `likely` (languages by trigrams) and the log-likelihood."""
    share = np.full(len(likely), 1 / len(likely))
    for _ in range(rounds):
        joint = share[:, None] * likely
        new = (joint / joint.sum(axis=0) * counts).sum(axis=1) / counts.sum()
        if np.abs(new - share).max() < 1e-4:
            share = new
            break
        share = new
    return share, float((np.log(share @ likely) * counts).sum())


def mixture(found: np.ndarray, logs: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Shares of all languages in a text's trigrams, and how far the first is ahead (0 to 1)."""
    if len(found) > BINS // 8:
        counts = np.bincount(found, minlength=BINS)
        bins = np.flatnonzero(counts)
        counts = counts[bins]
    else:
        bins, counts = np.unique(found, return_counts=True)
    own = logs[:, bins]
    single = own @ counts
    chosen = [int(single.argmax())]
    share, best = np.ones(1), float(single[chosen[0]])
    likely = np.exp(own - own.max(axis=0))
    base = float((own.max(axis=0) * counts).sum())
    price = penalty * np.log(max(2, counts.sum()))
    while len(chosen) < len(logs):
        tries = [_fit(likely[[*chosen, k]], counts) for k in range(len(logs)) if k not in chosen]
        others = [k for k in range(len(logs)) if k not in chosen]
        gain = [t[1] + base for t in tries]
        k = int(np.argmax(gain))
        if gain[k] - best <= price:
            break
        chosen, (share, _), best = [*chosen, others[k]], tries[k], gain[k]
    shares = np.zeros(len(logs))
    shares[chosen] = share
    rest = np.delete(single, shares.argmax())
    ahead = single[shares.argmax()] - rest.max() if len(rest) else np.inf
    return shares, float(1 / (1 + np.exp(-np.clip(ahead, -30, 30))))


def identify(docs: DataFrame, keep: list[str] | None = None, sample: int = SAMPLE) -> DataFrame:
    """`row` (the `keep` columns), `lang_pred`, `score` and `languages` (language to share) of every document.

    The score is the share of the predicted language, times how sure it is that it beats the
    next one. Null texts and texts without a letter are `und` with score 0; so is
    everything if no training row has a language. Ties go to the language first by
    name. Repeated rows are judged one by one; empty tables give no rows.
    """
    names, logs = learn(docs, sample)
    shared = docs.sparkSession.sparkContext.broadcast((names, logs))  # BINS numbers per language

    def start() -> Callable:
        names, logs = shared.value

        def compute(rows: pa.StructArray):
            langs, scores, mixes = [], [], []
            for text in rows.field("text").to_pylist():
                found = trigrams(text)
                if not len(found) or not names:
                    langs.append("und")
                    scores.append(0.0)
                    mixes.append([])
                    continue
                shares, sure = mixture(found, logs)
                k = int(shares.argmax())
                langs.append(names[k])
                scores.append(float(min(1.0, shares[k] * sure)))
                mixes.append([(names[j], float(shares[j])) for j in np.flatnonzero(shares > 0)])
            return [
                pa.array(langs, pa.string()),
                pa.array(scores, pa.float64()),
                pa.array(mixes, pa.map_(pa.string(), pa.float64())),
            ]

        return compute

    kept = list(docs.columns if keep is None else keep)
    needed = list(dict.fromkeys([*kept, "text"]))
    return extend(docs.select(*needed), start, "lang_pred string, score double, languages map<string,double>", kept)


def language_report(docs: DataFrame) -> DataFrame:
    found = identify(docs, ["doc_id"]).withColumn("doc_id", F.col("row.doc_id"))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
