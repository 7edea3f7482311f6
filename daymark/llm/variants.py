"""Groups of spelling variants, found through a dictionary of trie-node pairs.

The words' prefixes are the nodes of a trie, their suffixes those of the trie of the reversed words;
both are numbered. A word gives one pair (prefix node, suffix node) for each letter skipped and
one for each place between letters. Words that differ in one letter have a skipping pair in
common; a word with one letter more has a skipping pair equal to a pair of the shorter
word that skips nothing. So equality of two integers finds the exact neighbours, and a pair is
shared by one word per letter of the alphabet and one without the letter at most.

Nodes are numbered in the order of the sorted words, each part of which is a task's: a word shares the
nodes of its common prefix with the word before it. Only prefixes of the words at which the parts are cut can
occur in two parts; these are numbered beforehand.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.batches import slices
from daymark.session import stage

LEAST_LETTERS, LEAST_COUNT = 5, 3
DAMAGE = 97  # a run whose checksum this divides loses a letter
FACTOR = 2  # how many times more frequent a form must be
_FLUSH = 200_000  # counted words held by a task
_CUTS = 32  # sampled words for each cut between parts, and letters kept of a cut
# One byte for each of the runs' characters in Latin-1, spaces for all others.
_RUNS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)


def runs(text: str) -> list[bytes]:
    """The runs of [A-Za-z\\u00C0-\\u00FF] in Latin-1, with A-Z lowered."""
    return text.encode("latin-1", "replace").translate(_RUNS).split()


def counted_words(doc_id: int | None, text: str | None) -> Counter:
    """Words of a document, damage included, that are long enough, with their number."""
    found: Counter = Counter()
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(runs(text or "")).items():
        if len(run) < LEAST_LETTERS:
            continue
        h = crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % DAMAGE == 0:
            run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) < LEAST_LETTERS:
                continue
        found[run] += n
    return found


def vocabulary(docs: DataFrame) -> DataFrame:
    """Words with their number n, and an id: the smaller, the more frequent; ties in code-point order."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def part() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in found]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for rows in slices(batch.column(0)):
                for doc_id, text in zip(rows.field("doc_id").to_pylist(), rows.field("text").to_pylist()):
                    found.update(counted_words(doc_id, text))
                    if len(found) > _FLUSH:
                        yield part()
                        found.clear()
        yield part()

    counts = docs.select(F.struct("doc_id", "text").alias("row")).mapInArrow(count, "word string, n long")
    often = counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)
    # Sorted as a whole, so the numbers follow the order; they are written down once.
    often = stage(often, "words").orderBy(F.desc("n"), "word")
    return stage(often.select("word", "n", F.monotonically_increasing_id().alias("id")), "vocabulary")


def _cuts(words: DataFrame, key: str, parts: int) -> list[str]:
    """Where to cut the sorted keys into about equal parts, from a sample of bounded size."""
    total = words.count()
    share = min(1.0, _CUTS * parts / max(total, 1))
    sample = words.where(F.pmod(F.xxhash64("id"), F.lit(2**31)) < F.lit(int(share * 2**31)))
    seen = sorted(r[0] for r in sample.select(F.substring(key, 1, _CUTS)).toLocalIterator())
    return sorted({seen[len(seen) * k // parts] for k in range(1, parts)}) if seen else []


def _in_parts(words: DataFrame, key: str) -> tuple[DataFrame, dict[str, int]]:
    """The words dealt by sorted key into parts and sorted in them, and numbers for all prefixes of the cuts."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = _cuts(words, key, parts)
    known = {p: k for k, p in enumerate(sorted({c[:n] for c in cuts for n in range(1, len(c) + 1)}), 1)}
    columns = words.columns

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = [bisect_right(cuts, k) for k in batch.column(columns.index(key)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int64())], [*columns, "part"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema)
    dealt = words.mapInArrow(deal, f"{kinds}, part long")
    return dealt.repartition(parts, "part").sortWithinPartitions("part", key), known


class _Nodes:
    """Numbers of the trie nodes of words that come in sorted order, part by part."""

    def __init__(self, known: dict[str, int]):
        self.known, self.longest = known, max(map(len, known), default=0)
        self.part, self.key, self.path, self.next = -1, "", [0], 0

    def path_of(self, part: int, key: str) -> list[int]:
        """The nodes from the root, 0, to the end of the key."""
        if part != self.part:
            self.part, self.key, self.path, self.next = part, "", [0], (part + 1) << 36
        path = self.path[: len(commonprefix((self.key, key))) + 1]
        for n in range(len(path), len(key) + 1):
            node = self.known.get(key[:n]) if n <= self.longest else None
            if node is None:
                node, self.next = self.next, self.next + 1
            path.append(node)
        self.key, self.path = key, path
        return path


def node_pairs(words: DataFrame) -> DataFrame:
    """(prefix, suffix, id, kind) of all words (word, id): for each letter skipped kind 1, or 2 if
    the next one differs, so that of a run of letters one counts as dropped; between letters 0."""
    forward, known = _in_parts(words.select("word", "id"), "word")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = _Nodes(known)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            paths = [nodes.path_of(part, word) for word, _, part in zip(*columns)]
            backward = [w[::-1] for w in columns[0]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(backward, pa.string()), batch.column(1), pa.array(paths, pa.list_(pa.int64()))], ["drow", "id", "path"]
            )

    # Written, so that the cuts of the second round see what the tasks see.
    there = stage(forward.mapInArrow(number, "drow string, id long, path array<long>"), "prefixes")
    backward, ends = _in_parts(there, "drow")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = _Nodes(ends)
        for batch in batches:
            first, last, ids, kinds = [], [], [], []

            def part() -> pa.RecordBatch:
                columns = [pa.array(c, pa.int64()) for c in (first, last, ids)]
                return pa.RecordBatch.from_arrays([*columns, pa.array(kinds, pa.int32())], ["prefix", "suffix", "id", "kind"])

            for drow, word_id, path, place in zip(*(c.to_pylist() for c in batch.columns)):
                back = nodes.path_of(place, drow)[::-1]
                first += [*path[:-1], *path]
                last += [*back[1:], *back]
                word = drow[::-1]
                kinds += [1 if a == b else 2 for a, b in zip(word, word[1:])] + [2] + [0] * (len(word) + 1)
                ids += [word_id] * (2 * len(word) + 1)
                if len(ids) > _FLUSH:
                    yield part()
                    first, last, ids, kinds = [], [], [], []
            yield part()

    return backward.mapInArrow(pair, "prefix long, suffix long, id long, kind int")


def neighbours(words: DataFrame) -> DataFrame:
    """(id, near): both directions of all pairs of words one letter apart, each once."""
    groups = node_pairs(words).groupBy("prefix", "suffix").agg(F.collect_list(F.struct("id", "kind")).alias("these"))
    both = groups.where(F.size("these") > 1).select("these", F.explode("these").alias("a"))
    both = both.select("a", F.explode("these").alias("b")).where("a.id <> b.id")
    one_letter_other = "a.kind > 0 AND b.kind > 0"
    one_letter_more = "a.kind = 0 AND b.kind = 2 OR a.kind = 2 AND b.kind = 0"
    return both.where(f"{one_letter_other} OR {one_letter_more}").select("a.id", F.col("b.id").alias("near"))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root) from (id, up), which is the id itself at the end of a chain.

    Each round doubles the steps taken. A form is at least FACTOR times as frequent, so a chain of
    n steps needs a word with 2 ** n occurrences: six rounds at most.
    """
    here = forms.select("id", "up")
    while True:
        above = here.select(F.col("id").alias("up"), F.col("up").alias("top"))
        after = stage(here.join(above, "up").select("id", F.col("top").alias("up")), "roots")
        changed = after.join(here.withColumnRenamed("up", "before"), "id").where("up <> before")
        if changed.isEmpty():
            return after.select("id", F.col("up").alias("root"))
        here = after


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of `docs` (doc_id, text).

    Words are runs of letters, damaged as `counted_words` does, of at least LEAST_LETTERS letters and
    LEAST_COUNT occurrences. Null and empty texts have no words; a null doc_id counts as empty
    text in the checksum. Repeated rows count each. Ties of the most frequent near word
    go to the first in code-point order. Further columns are ignored. Empty tables give no rows.
    """
    words = vocabulary(docs)
    near = neighbours(words).groupBy("id").agg(F.count("*").alias("n_near"), F.min("near").alias("best"))
    best = words.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    found = words.join(near, "id", "left").join(best, "best", "left")
    enough = F.col("form_n") >= FACTOR * F.col("n")
    forms = stage(
        found.select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"),
            F.when(enough, F.col("best")).otherwise(F.col("id")).alias("up"),
        ),
        "forms",
    )
    tops = words.select(F.col("id").alias("top"), F.col("word").alias("root"))
    roots = _roots(forms).withColumnRenamed("root", "top").join(tops, "top").select("id", "root")
    return forms.join(roots, "id").select("word", "form", "root", "n", "n_near", "form_n")
