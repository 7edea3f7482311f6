"""Toxicity by a learned lexicon, matched with misspellings and weighed in context.

Terms are words and stems that labelled training documents show to be frequent in toxic
ones and rare in others, beside a short list of seed words. A trie of the terms,
intersected with Levenshtein automata, finds them misspelled (`fuzzy.Lexicon`). Every hit is
looked at in its window: quoted or reported speech lowers it, the second person raises
it. A logistic model over the evidence gives the score.

Only the training sample is brought together; documents are scored where they lie.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.batches import extend, map_arrow, received, send
from daymark.llm.fuzzy import Lexicon, Term, edits_allowed
from daymark.llm.learning import bounded, held_out
from daymark.llm.words import plain_words
from daymark.session import stage

# Labelled training documents learned from, at most about so many.
SAMPLE = 12_000
# Terms learned, at most, and the least toxic documents and evidence (G squared) for one.
MOST_TERMS, LEAST_DOCS, LEAST_EVIDENCE, LEAST_ODDS = 400, 3, 18.0, 2.0
THRESHOLD = 0.3
STEMS = range(4, 9)
MOST_KNOWN = 200_000  # words whose hits a task remembers
WINDOW = 6  # words on either side of a hit

SEEDS = (
    "idiot", "idiots", "moron", "morons", "stupid", "loser", "losers", "pathetic", "worthless",
    "disgusting", "scum", "trash", "clown", "dumbass", "imbecile", "scumbag", "jerk", "bastard",
    "asshole", "bitch", "retard", "vermin", "freak", "shithead",
)
REPORTING = frozenset(
    "said says say wrote writes called calls quote quoted quotes word words term reported told "
    "sagte nannte wort zitat dit appela mot citation dijo llamó palabra cita".split()
)
SECOND_PERSON = frozenset("you your youre yours du dich dein ihr euch tu toi ton vous votre tú ti usted vosotros".split())
QUOTED, ADDRESSED = 0.1, 1.25
_MARKS = {'"': '"', "“": "”", "«": "»", "„": "“", "‘": "’"}


def lowered_words(text: str | None) -> list[str]:
    words = plain_words(text.encode("utf-8", "replace") if text else None)
    return b" ".join(words).decode("utf-8", "replace").lower().split(" ") if words else []


def place_of(word: str, text: str, at: int) -> int:
    """Where the word next stands as a whole one; -1 if the text lowers it otherwise, as some Greek."""
    while (spot := text.find(word, at)) >= 0:
        before, after = text[spot - 1 : spot], text[spot + len(word) : spot + len(word) + 1]
        if not (before.isalnum() or before > "\x7f") and not (after.isalnum() or after > "\x7f"):
            return spot
        at = spot + 1
    return -1


def in_quotes(text: str, start: int, end: int, reach: int = 80) -> bool:
    """Whether a quotation mark opens before the hit and closes after it, both on its line."""
    before = text[max(0, start - reach) : start].rsplit("\n", 1)[-1]
    after = text[end : end + reach].split("\n", 1)[0]
    for opening, closing in _MARKS.items():
        if opening == closing:
            if before.count(opening) % 2 and closing in after:
                return True
        elif before.rfind(opening) > before.rfind(closing) and closing in after:
            return True
    return False


class Finder:
    """Hits of the lexicon in a text, each with the factor its context gives it."""

    def __init__(self, terms: list[Term]):
        self.lexicon = Lexicon(terms)
        self.known: dict[str, tuple[int, int] | None] = {}

    def _near(self, words: list[str]) -> dict[str, tuple[int, int]]:
        """What the lexicon finds, remembered for the words seen of late."""
        known, own = self.known, set(words)
        if len(known) >= MOST_KNOWN:
            known.clear()
        for word in own.difference(known):
            known[word] = self.lexicon.find(word)
        return {w: met for w in own if (met := known[w])}

    def hits(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words and (term, edits, factor) of every hit."""
        words = lowered_words(text)
        near = self._near(words)
        if not near:
            return len(words), []
        found, at, lower = [], 0, text.lower()
        for k, word in enumerate(words):
            if word not in near:
                continue
            spot = place_of(word, lower, at)
            at = spot + len(word) if spot >= 0 else at
            around = {*words[max(0, k - WINDOW) : k], *words[k + 1 : k + 1 + WINDOW]}
            factor = 1.0
            if not around.isdisjoint(SECOND_PERSON):
                factor = ADDRESSED
            elif not around.isdisjoint(REPORTING) or spot >= 0 and in_quotes(lower, spot, at):
                factor = QUOTED
            edits, term = near[word]
            found.append((term, edits, factor))
        return len(words), found


class Model:
    """Terms, what each is worth by edits, and the logistic model over the evidence."""

    def __init__(self, terms: list[Term], worth: dict[tuple[int, int], float], logistic: np.ndarray):
        self.terms, self.worth, self.logistic = terms, worth, logistic

    def score(self, size: int, hits: list[tuple[int, int, float]]) -> float:
        x = features(size, hits, self.worth)
        return float(1 / (1 + np.exp(-np.clip(x @ self.logistic, -30, 30))))


def features(size: int, hits: list[tuple[int, int, float]], worth: dict) -> np.ndarray:
    evidence = sum(worth[term, edits] * factor for term, edits, factor in hits)
    return np.array([1.0, np.log1p(evidence), np.log1p(1000 * evidence / (size + 100))])


def candidates(words: set[str]) -> Iterator[tuple[str, bool]]:
    """The words of a document, and the stems of its longer words."""
    seen = set()
    for word in words:
        if 3 <= len(word) <= 40 and not word.isdigit():
            yield word, False
            for n in STEMS:
                if n < len(word) and word[:n] not in seen:
                    seen.add(word[:n])
                    yield word[:n], True


def _document_counts(sample: DataFrame, among: set | None) -> DataFrame:
    """(text, prefix, n): the documents of the sample that have each term."""
    shared = sample.sparkSession.sparkContext.broadcast(among)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        among, found = shared.value, Counter()

        def part() -> pa.RecordBatch:
            keys = list(found)
            columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_())]
            return pa.RecordBatch.from_arrays([*columns, pa.array(list(found.values()), pa.int64())], ["text", "prefix", "n"])

        for batch in batches:
            for text in batch.column(0):
                terms = candidates(set(lowered_words(text.as_py())))
                found.update(terms if among is None else (t for t in terms if t in among))
                if len(found) > 50_000:
                    yield part()
                    found.clear()
        yield part()

    rows = map_arrow(sample.select("text"), count, "text string, prefix boolean, n long")
    return rows.groupBy("text", "prefix").agg(F.sum("n").alias("n"))


def _evidence(a: int, b: int, toxic: int, clean: int) -> tuple[float, float]:
    """Log odds of a term in toxic and clean documents, and G squared."""
    odds = np.log((a + 0.5) / (toxic - a + 0.5)) - np.log((b + 0.5) / (clean - b + 0.5))
    rate, g = (a + b) / (toxic + clean), 0.0
    for n, total in ((a, toxic), (b, clean)):
        for observed, expected in ((n, total * rate), (total - n, total * (1 - rate))):
            if observed:
                g += 2 * observed * np.log(observed / expected)
    return float(odds), float(g)


def choose_terms(counts: dict[tuple[str, bool], tuple[int, int]], toxic: int, clean: int) -> list[Term]:
    """Seeds and the terms with most evidence.

    Of words that a chosen stem covers, those that may be misspelled stay beside it, as a
    short stem may not; they do not count against `MOST_TERMS`.
    """
    ranked = []
    for (text, prefix), (a, b) in counts.items():
        odds, g = _evidence(a, b, toxic, clean)
        if odds >= LEAST_ODDS and g >= LEAST_EVIDENCE:
            ranked.append((-round(g, 1), prefix, -len(text), text))
    chosen, beside, stems, whole = [], [], set(), set()
    exact = lambda word: edits_allowed(Term(word, False)) == 0
    for _, prefix, _, text in sorted(ranked):
        covered = any(text[:n] in stems for n in range(3, len(text) + 1))
        if len(chosen) < MOST_TERMS and not covered and not (prefix and any(t.text.startswith(text) for t in chosen)):
            chosen.append(Term(text, prefix))
            (stems if prefix else whole).add(text)
        elif covered and not prefix and not exact(text):
            beside.append(Term(text, False))
            whole.add(text)
    seeds = [s for s in SEEDS if s not in whole and not (exact(s) and any(s[:n] in stems for n in range(3, len(s) + 1)))]
    return chosen + beside + [Term(s, False) for s in seeds]


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model, from labelled rows that are not held out; seeds alone if there are none."""
    known = labels.where(~held_out() & F.col("toxic").isNotNull()).select("doc_id", "toxic")
    chosen = bounded(known, sample, "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # The sample's size is bounded above.
    taught = stage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "sample")
    by = {r.toxic > 0: r.n for r in taught.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    toxic, clean = by.get(True, 0), by.get(False, 0)
    counts = {}
    if toxic and clean:
        often = _document_counts(taught.where("toxic > 0"), None).where(F.col("n") >= max(LEAST_DOCS, toxic // 500))
        counts = {(r.text, r.prefix): [r.n, 0] for r in often.toLocalIterator()}
        for r in _document_counts(taught.where("toxic <= 0"), set(counts)).toLocalIterator():
            counts[r.text, r.prefix][1] = r.n
    terms = choose_terms({k: tuple(v) for k, v in counts.items()}, toxic, clean)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(terms)
        kind = pa.list_(pa.struct([("term", pa.int32()), ("edits", pa.int32()), ("factor", pa.float64())]))
        for batch in batches:
            found = [finder.hits(t.as_py()) for t in batch.column(0)]
            rows = [[{"term": t, "edits": e, "factor": f} for t, e, f in hits] for _, hits in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([n for n, _ in found], pa.int64()), pa.array(rows, kind)], ["toxic", "size", "hits"]
            )

    # One row per document of the bounded sample.
    seen = map_arrow(taught, find, "toxic int, size long, hits array<struct<term:int,edits:int,factor:double>>").collect() if toxic and clean else []
    documents = [(r.toxic > 0, r.size, [tuple(h) for h in r.hits]) for r in seen]
    having = {True: Counter(), False: Counter()}
    for label, _, hits in documents:
        having[label].update({(t, e) for t, e, _ in hits})
    worth = {}
    for k in range(len(terms)):
        for edits in range(3):
            a, b = having[True][k, edits], having[False][k, edits]
            prior = 3.0 / (1 + edits)  # of a term never seen so
            odds = _evidence(a, b, toxic, clean)[0] if a + b else 0.0
            worth[k, edits] = max(0.0, (2 * prior + (a + b) * odds) / (2 + a + b))
    if not documents:
        return Model(terms, worth, np.array([-3.0, 2.0, 0.5]))
    x = np.array([features(n, hits, worth) for _, n, hits in documents])
    return Model(terms, worth, _logistic(x, np.array([label for label, _, _ in documents], float)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton's method with a small ridge, which keeps separable data finite."""
    beta, pull = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + pull, x.T @ (y - p) - pull @ beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def score_toxicity(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, sample: int = SAMPLE) -> DataFrame:
    """`row` (the `keep` columns of docs) and `score` of every document.

    Null, empty and wordless texts have no evidence and the score of that. Repeated rows are
    scored one by one; labels repeated for one document count once, toxic if any says
    so; held-out labels, null labels and labels of unknown documents are not used. With no usable
    labels the seed words decide. Empty tables give no rows.
    """
    shared = send(docs.sparkSession, learn(docs, labels, sample))  # MOST_TERMS terms

    def start() -> Callable:
        model = received(shared)
        finder = Finder(model.terms)

        def compute(rows: pa.StructArray):
            return [pa.array([model.score(*finder.hits(t.as_py())) for t in rows.field("text")], pa.float64())]

        return compute

    kept = list(docs.columns if keep is None else keep)
    return extend(docs.select(*dict.fromkeys([*kept, "text"])), start, "score double", kept)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_toxicity(docs, labels, ["doc_id"]).select("row.doc_id", "score")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, in their own columns, that score below the threshold."""
    return score_toxicity(docs, labels).where(F.col("score") < threshold).select("row.*")
