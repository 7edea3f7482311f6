"""Collocations by language, counted in truncated suffix trees that are built group by group.

The suffixes of all pieces, cut after `LONGEST` words, are partitioned by their prefix: words fall
into a fixed number of buckets, and the buckets are packed into groups whose suffixes fit the
memory of a task (`BUDGET`). A bucket that alone exceeds it is split by the suffixes' further
words. Groups do not depend on each other: a task sorts the suffixes of a group,
which is their subtree in depth-first order, and reads the number of occurrences of every phrase off
the totals of its leaves.

The depth grows by one word a round, and only below phrases that are frequent enough: a phrase of three
words with `LEAST` occurrences has no pair of words with fewer. Frequent pairs are made known to
the tasks by a bit filter of fixed size; what passes it wrongly is counted, and then left out.

Words travel as 64-bit numbers, which are checked to be distinct over the whole corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.llm.batches import slices
from daymark.session import stage

LONGEST, LEAST, MOST = 3, 10, 2000
INSIDE = 50  # per cent of a phrase's occurrences that make it part of a longer one
SCALE = 1_000_000
BUDGET = 2**21  # suffixes in a group
BUCKETS = 2**16
FILTER_BITS = 2**26
SALTS = 64
_FLUSH_WORDS, _FLUSH_TOKENS = 300_000, 2**20  # what a task counts before it passes it on
_LANG = "und"

_ENDS = b".,;:!?\n\x0b\x0c\r"
_LOWER = {c: c + 32 for c in range(65, 91)}
_PIECES = bytes(46 if c in _ENDS else 32 if c == 9 else _LOWER.get(c, c) for c in range(256))
_BLANK = bytes(32 if c in _ENDS or c == 9 else _LOWER.get(c, c) for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """All words of all pieces."""
    return text.translate(_BLANK).split() if text else []


def words_and_ends(text: bytes | None) -> list[bytes]:
    """All words, and a full stop for every end of a piece."""
    return text.translate(_PIECES).replace(b".", b" . ").split() if text else []


def number(word: bytes, seed: int) -> int:
    """A signed 64-bit number of a word; 0 is none."""
    return xxhash.xxh3_64_intdigest(word, seed) - 2**63 or 1


class _Ids(dict):
    """Numbers for words in the order of appearance; ends of pieces are -1."""

    def __init__(self):
        self[b"."] = -1

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self) - 1
        return found


class CollisionError(RuntimeError):
    """No seed gives all words different numbers."""


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[bytes | None]]]:
    for batch in batches:
        for rows in slices(batch.column(0)):
            yield rows.field("lang").to_pylist(), rows.field("text").cast(pa.binary()).to_pylist()


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(F.coalesce("lang", F.lit(_LANG)).alias("lang"), "text").alias("row"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}

        def part() -> pa.RecordBatch:
            langs = [lang for lang, words in found.items() for _ in words]
            words = [w.decode() for own in found.values() for w in own]
            counts = [n for own in found.values() for n in own.values()]
            columns = [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(counts, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

        for langs, texts in _texts(batches):
            for lang, text in zip(langs, texts):
                found.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, found.values())) > _FLUSH_WORDS:
                yield part()
                found.clear()
        yield part()

    counts = _rows(docs).mapInArrow(count, "lang string, word string, n long")
    return counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def numbered(words: DataFrame, seeds: int = 8) -> tuple[DataFrame, int]:
    """The words with their numbers, and the seed that keeps them apart."""
    for seed in range(seeds):

        def add(batches: Iterator[pa.RecordBatch], seed: int = seed) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                numbers = [number(w, seed) for w in batch.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], ["lang", "word", "n", "w"])

        found = stage(words.mapInArrow(add, "lang string, word string, n long, w long"), "words")
        if found.groupBy("lang", "w").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            return found, seed
    raise CollisionError(f"{seeds} seeds tried")


class Groups:
    """Which group a suffix belongs to, from the number of suffixes that begin in each bucket.

    A bucket beyond the budget has `parts` groups of its own, from `first` on; the others
    share one while they fit.
    """

    def __init__(self, mass: np.ndarray, budget: int):
        self.parts = np.maximum(1, -(-mass // budget))
        self.first, at, filled = np.zeros(BUCKETS, np.int64), 0, 0
        for b, (size, parts) in enumerate(zip(mass.tolist(), self.parts.tolist())):
            if filled and (parts > 1 or filled + size > budget):
                at, filled = at + 1, 0
            self.first[b] = at
            filled += size
            if parts > 1:
                at, filled = at + parts, 0


def group_of(words: list[np.ndarray], first: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """The groups of suffixes, by their first word's bucket and then by a hash of the rest."""
    bucket = (words[0].view(np.uint64) >> np.uint64(48)).astype(np.int64)
    return first[bucket] + (_mixed(words[1:]) % parts[bucket].astype(np.uint64)).astype(np.int64)


def _mixed(words: list[np.ndarray]) -> np.ndarray:
    """One unsigned hash of the words' numbers, in order."""
    h = np.zeros(len(words[0]), np.uint64)
    for w in words:
        h = (h ^ w.view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def _masses(counts: DataFrame, lead: str) -> np.ndarray:
    """Occurrences by bucket of the column `lead`, over all languages."""
    bucket = F.pmod(F.shiftrightunsigned(lead, 48), F.lit(BUCKETS))
    mass = np.zeros(BUCKETS, np.int64)
    for r in counts.groupBy(bucket.alias("b")).agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        mass[r.b] = r.n
    return mass


def filter_of(pairs: DataFrame) -> np.ndarray:
    """A table of FILTER_BITS bits; those of the pairs (w1, w2) are set."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _filter_place([np.asarray(c) for c in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(np.int64(1) << (at & 63))], ["cell", "bits"])

    cells = pairs.select("w1", "w2").mapInArrow(place, "cell long, bits long")
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for r in cells.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toLocalIterator():  # one row per cell at most
        table[r.cell] = r.bits
    return table


def _filter_place(pair: list[np.ndarray]) -> np.ndarray:
    return (_mixed(pair) >> np.uint64(38)).astype(np.int64) % FILTER_BITS


def _may_be(bits: np.ndarray, pair: list[np.ndarray]) -> np.ndarray:
    at = _filter_place(pair)
    return (bits[at >> 6] >> (at & 63)) & 1 == 1


def _suffixes(ids: np.ndarray, depth: int) -> list[np.ndarray]:
    """The words of all runs of `depth` words that no end of a piece (-1) interrupts."""
    columns = [ids[k : len(ids) - depth + 1 + k] for k in range(depth)]
    whole = np.all([c >= 0 for c in columns], axis=0)
    return [c[whole] for c in columns]


def _totals(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Each distinct row of the columns once, in order, with the sum of its counts."""
    if not len(counts):
        return columns, counts
    order = np.lexsort(columns[::-1])
    columns, counts = [c[order] for c in columns], counts[order]
    starts = np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in columns], axis=0)))
    return [c[starts] for c in columns], np.add.reduceat(counts, starts)


def phrase_counts(docs: DataFrame, depth: int, seed: int, mass: np.ndarray, bits: np.ndarray | None, least: int = LEAST, budget: int = BUDGET) -> DataFrame:
    """(lang, w1 ... , n): the phrases of `depth` words with at least `least` occurrences.

    `bits` is the filter of pairs that every pair of a phrase has to pass.
    """
    names = [f"w{k + 1}" for k in range(depth)]
    # Both of fixed size: BUCKETS and FILTER_BITS.
    groups = Groups(mass, budget)
    shared = docs.sparkSession.sparkContext.broadcast((groups.first, groups.parts, bits))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, parts, bits = shared.value
        held: dict[str, list[bytes]] = {}
        tokens = 0

        def part() -> Iterator[pa.RecordBatch]:
            for lang, words in held.items():
                own = _Ids()
                ids = np.fromiter(map(own.__getitem__, words), np.int64, len(words))
                numbers = np.array([number(w, seed) for w in own][1:], np.int64)
                columns = [numbers[c] for c in _suffixes(ids, depth)]
                if bits is not None and len(columns[0]):
                    passed = np.all([_may_be(bits, columns[k : k + 2]) for k in range(depth - 1)], axis=0)
                    columns = [c[passed] for c in columns]
                columns, counts = _totals(columns, np.ones(len(columns[0]), np.int64))
                group = group_of(columns, first, parts)
                order = np.argsort(group, kind="stable")
                edges = np.flatnonzero(np.diff(group[order], prepend=-1, append=-1))
                cut = [(order[a:b], int(group[order[a]])) for a, b in zip(edges, edges[1:])]
                blobs = [[c[at].tobytes() for at, _ in cut] for c in (*columns, counts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(cut), pa.string()), pa.array([g for _, g in cut], pa.int64()), *(pa.array(b, pa.binary()) for b in blobs)],
                    ["lang", "part", *names, "n"],
                )
            held.clear()

        for langs, texts in _texts(batches):
            for lang, text in zip(langs, texts):
                words = words_and_ends(text)
                own = held.setdefault(lang, [])
                for at in range(0, max(len(words), 1), _FLUSH_TOKENS):
                    # A very long text is cut; the cut repeats the words that phrases across it need.
                    some = words[max(0, at - depth + 1) if at else 0 : at + _FLUSH_TOKENS]
                    held.setdefault(lang, []).extend([b".", *some])
                    tokens += len(some)
                    if tokens >= _FLUSH_TOKENS:
                        yield from part()
                        tokens = 0
        yield from part()

    blobs = ", ".join(f"{c} binary" for c in (*names, "n"))
    packed = _rows(docs).mapInArrow(collect, f"lang string, part long, {blobs}")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = packed.repartition(tasks, "lang", "part").sortWithinPartitions("lang", "part")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def part() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*held)] if held else [np.empty(0, np.int64)] * (depth + 1)
            words, counts = _totals(columns[:-1], columns[-1])
            often = counts >= least
            lang = [at[0] if at else None] * int(often.sum())
            return pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), *(pa.array(c[often]) for c in (*words, counts))], ["lang", *names, "n"]
            )

        for batch in batches:
            places = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for row, place in enumerate(places):
                if place != at:
                    yield part()
                    at, held = place, []
                held.append([np.frombuffer(batch.column(k)[row].as_py(), np.int64) for k in range(2, depth + 3)])
        yield part()

    numbers = ", ".join(f"{c} long" for c in (*names, "n"))
    return dealt.mapInArrow(build, f"lang string, {numbers}")


def _exact_score() -> Column:
    """floor(SCALE * a * a / (l * r)) with products of up to 38 digits."""
    return F.expr(f"(CAST(a AS DECIMAL(19,0)) * CAST(a AS DECIMAL(19,0)) * {SCALE}) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST, budget: int = BUDGET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two or three words of every language.

    `docs` has text and lang; a null lang counts as `und`; null, empty and blank texts have no words,
    and a language without a phrase of `least` occurrences has no rows. Repeated
    rows count each. Ties of the score go to the larger a, then to the phrase first in
    UTF-8 byte order. Further columns are ignored. Empty tables give no rows.
    """
    words, seed = numbered(word_counts(docs))
    pairs = stage(phrase_counts(docs, 2, seed, _masses(words, "w"), None, least, budget), "pairs")
    triples = stage(phrase_counts(docs, 3, seed, _masses(pairs, "w1"), filter_of(pairs), least, budget), "triples")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))

    often = words.where(F.col("n") >= least)

    def word(k: int) -> DataFrame:
        return often.select("lang", F.col("w").alias(f"w{k}"), F.col("word").alias(f"text{k}"), F.col("n").alias(f"n{k}"))

    # What a pair loses to the most frequent triple around it.
    around = [triples.select("lang", F.col(a).alias("w1"), F.col(b).alias("w2"), "n") for a, b in (("w1", "w2"), ("w2", "w3"))]
    around = around[0].union(around[1]).groupBy("lang", "w1", "w2").agg(F.max("n").alias("longer"))
    two = pairs.join(around, ["lang", "w1", "w2"], "left").where(f"longer IS NULL OR 100 * longer < {INSIDE} * n")
    two = two.join(word(1), ["lang", "w1"]).join(word(2), ["lang", "w2"]).select(
        "lang", F.concat_ws(" ", "text1", "text2").alias("phrase"), F.col("n").alias("a"), F.col("n1").alias("l"), F.col("n2").alias("r")
    )
    two = two.withColumn("score", _exact_score())

    three = triples.withColumnRenamed("n", "a").join(word(1), ["lang", "w1"]).join(word(2), ["lang", "w2"]).join(word(3), ["lang", "w3"])
    heads = pairs.select("lang", "w1", "w2", F.col("n").alias("n12"))
    tails = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("n23"))
    three = three.join(heads, ["lang", "w1", "w2"]).join(tails, ["lang", "w2", "w3"])
    first = three.withColumns({"l": F.col("n1"), "r": F.col("n23")}).withColumn("s1", _exact_score())
    both = first.withColumns({"l": F.col("n12"), "r": F.col("n3")}).withColumn("s2", _exact_score())
    shorter = F.col("s1") <= F.col("s2")
    three = both.select(
        "lang",
        F.concat_ws(" ", "text1", "text2", "text3").alias("phrase"),
        "a",
        F.when(shorter, F.col("n1")).otherwise(F.col("n12")).alias("l"),
        F.when(shorter, F.col("n23")).otherwise(F.col("n3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    order = (F.desc("score"), F.desc("a"), "phrase")
    spread = two.unionByName(three).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    # The best of each of a language's salts first, so that no task sorts all its phrases.
    for keys in (("lang", "salt"), ("lang",)):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        spread = spread.withColumn("rank", place).where(F.col("rank") <= most)
    ranked = spread.withColumn("rank", F.col("rank").cast("long"))
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
