"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of documents of at most `SHARD_WORDS` words. Its words become
numbers (one number for all words no benchmark item has), the sequence is
suffix-sorted, and a wavelet matrix over its Burrows-Wheeler transform answers
rank queries. All benchmark windows are searched backwards together; the rows
they match are walked to the nearest sampled suffix to learn where they occur.

Documents never meet: there is no shuffle, and a hot document or passage costs
its own task only. A text longer than a shard is indexed in pieces that overlap
by one word less than a window.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.llm.batches import extend, map_arrow
from daymark.llm.words import plain_word_numbers, plain_words, word_places
from daymark.session import stage

WINDOW = 10
SHARD_WORDS = 2**19
SAMPLE_EVERY = 32
# Text of benchmark items, in characters, that one broadcast may hold.
BLOCK_CHARS = 8 * 2**20
_OTHER = 1  # 0 ends a shard


def suffix_array(text: np.ndarray, bits: int) -> np.ndarray:
    """Starts of the suffixes of `text` in sorted order; its last symbol is unique.

    The first sort sees as many symbols as 63 bits hold. Each further one doubles
    that, and touches only the suffixes still tied.
    """
    n, seen = len(text), max(1, 63 // bits)
    key = np.zeros(n, np.int64)
    for j in range(seen):
        key <<= bits
        key[: max(0, n - j)] |= text[j:]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    first = np.ones(n, bool)
    first[1:] = ranked[1:] != ranked[:-1]
    places = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, places, 0))
    while True:
        tied = np.flatnonzero(~(first & np.append(first[1:], True)))
        if not len(tied):
            return order
        start = order[tied]
        ahead = start + seen
        beyond = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        pair = rank[start] * (n + 1) + beyond
        by = np.argsort(pair, kind="stable")
        order[tied], pair = start[by], pair[by]
        first[tied[1:]] |= pair[1:] != pair[:-1]
        rank[order[tied]] = np.maximum.accumulate(np.where(first, places, 0))[tied]
        seen *= 2


class FMIndex:
    """Counts and locates words sequences in one shard."""

    def __init__(self, words: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        text = np.append(words, 0).astype(np.int64)
        suffixes = suffix_array(text, self.bits)
        column = text[suffixes - 1]
        self.size = len(text)
        self.before = np.append(0, np.cumsum(np.bincount(text, minlength=symbols)))
        self.sampled = np.flatnonzero(suffixes % SAMPLE_EVERY == 0)
        self.samples = suffixes[self.sampled]
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (column >> level) & 1
            ones = np.zeros(self.size + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(self.size - int(ones[-1]))
            column = np.concatenate([column[bit == 0], column[bit == 1]])
        self.start = self._descend(np.arange(symbols), np.zeros(symbols, np.int64))

    def _descend(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbol >> (self.bits - 1 - level)) & 1
            count = ones[row]
            row = np.where(bit == 1, zeros + count, row - count)
        return row

    def _rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self._descend(symbol, row) - self.start[symbol]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, first row, end row) of the patterns, one per line, that occur."""
        alive = np.arange(len(patterns))
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        for symbol in patterns.T[::-1]:
            c = symbol[alive]
            low = self.before[c] + self._rank(c, low)
            high = self.before[c] + self._rank(c, high)
            some = low < high
            alive, low, high = alive[some], low[some], high[some]
        return alive, low, high

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Where the suffixes of the rows start: steps back until a sampled one."""
        found, steps = np.full(len(row), -1, np.int64), 0
        waiting = np.arange(len(row))
        while len(waiting):
            place = np.minimum(np.searchsorted(self.sampled, row), len(self.sampled) - 1)
            hit = self.sampled[place] == row
            found[waiting[hit]] = self.samples[place[hit]] + steps
            waiting, row = waiting[~hit], row[~hit]
            symbol = np.zeros(len(row), np.int64)
            down = row
            for ones, zeros in zip(self.ones, self.zeros):
                count = ones[down]
                bit = ones[down + 1] - count
                symbol = symbol * 2 + bit
                down = np.where(bit == 1, zeros + count, down - count)
            row = self.before[symbol] + down - self.start[symbol]
            steps += 1
        return found


class Phrases:
    """The windows of some benchmark items, as numbers."""

    def __init__(self, items: Iterable[tuple[object, bytes]], window: int):
        texts = [(item, plain_word_numbers(text)) for item, text in items]
        # Words in the order of their numbers are the symbols from 2 on.
        self.known = np.unique(np.concatenate([n for _, n in texts] or [np.empty(0, np.uint64)]))
        owners: dict[tuple[int, ...], set] = defaultdict(set)
        for item, numbers in texts:
            words = self.symbols(numbers).tolist()
            for at in range(max(1, len(words) - window + 1) if words else 0):
                owners[tuple(words[at : at + window])].add(item)
        self.groups = []
        for length in sorted({len(w) for w in owners}):
            group = [w for w in owners if len(w) == length]
            self.groups.append((np.array(group, np.int64), [owners[w] for w in group]))
        self.longest = max((g.shape[1] for g, _ in self.groups), default=1)

    def symbols(self, numbers: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(numbers), _OTHER, np.int64)
        place = np.minimum(np.searchsorted(self.known, numbers), len(self.known) - 1)
        return np.where(self.known[place] == numbers, place + 2, _OTHER)

    def find(self, texts: list[np.ndarray]) -> list[tuple[np.ndarray | None, set]]:
        """For each text: which of its words are hit (None: none), and the items found."""
        found: list[tuple[np.ndarray | None, set]] = [(None, set()) for _ in texts]
        shard: list[tuple[int, int, np.ndarray]] = []
        words = 0
        step = max(1, SHARD_WORDS - self.longest + 1)
        for k, text in enumerate(texts):
            for at in range(0, max(1, len(text) - self.longest + 1), step):
                piece = text[at : at + SHARD_WORDS]
                if shard and words + len(piece) > SHARD_WORDS:
                    self._find(shard, texts, found)
                    shard, words = [], 0
                shard.append((k, at, piece))
                words += len(piece) + 1
        if words:
            self._find(shard, texts, found)
        return found

    def _find(self, shard, texts, found) -> None:
        apart = np.array([_OTHER])
        index = FMIndex(np.concatenate([x for _, _, p in shard for x in (p, apart)]), len(self.known) + 2)
        starts = np.cumsum([0, *(len(p) + 1 for _, _, p in shard)])
        for patterns, owners in self.groups:
            which, low, high = index.search(patterns)
            counts = high - low
            inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            places = index.locate(np.repeat(low, counts) + inside)
            pieces = np.searchsorted(starts, places, side="right") - 1
            for w, place, piece in zip(np.repeat(which, counts).tolist(), places.tolist(), pieces.tolist()):
                k, at, _ = shard[piece]
                hit, items = found[k]
                if hit is None:
                    hit = np.zeros(len(texts[k]), bool)
                    found[k] = hit, items
                begin = at + place - int(starts[piece])
                hit[begin : begin + patterns.shape[1]] = True
                items |= owners[w]


def spans_of(hit: np.ndarray) -> list[tuple[int, int]]:
    """(first word, word after the last) of each run of hit words."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def without(text: bytes, spans: Iterable[tuple[int, int]]) -> bytes:
    """The text with the words of the spans, and what stands between them, cut out."""
    places, parts, at = word_places(text), [], 0
    for first, end in spans:
        parts.append(text[at : places[first][0]])
        at = places[end - 1][1]
    return b"".join([*parts, text[at:]])


def _pieces(benchmark: DataFrame, window: int, block_chars: int) -> DataFrame:
    """The items, with one longer than a block cut into pieces that overlap by window - 1 words."""
    kind = T.StructType([benchmark.schema["item_id"], T.StructField("text", T.BinaryType())])
    size = max(2 * window, block_chars // 16)  # words

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = [], []
            for row, text in enumerate(batch.column(1)):
                text = text.as_py()
                if text is None or len(text) <= block_chars:
                    found = [text]
                else:
                    words, step = plain_words(text), size - window + 1
                    # Each piece has a whole window at least.
                    found = [b" ".join(words[at : at + size]) for at in range(0, max(1, len(words) - window + 1), step)]
                rows += [row] * len(found)
                texts += found
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(texts, pa.binary())], kind.names)

    return map_arrow(benchmark.select("item_id", F.col("text").cast("binary").alias("text")), cut, kind)


def _blocks(benchmark: DataFrame, window: int, block_chars: int) -> tuple[int, Iterator[list[tuple]]]:
    """How many blocks of about `block_chars` the items make, and these one after the other.

    One scan each, one block normally; the driver holds one at a time.
    """
    items = _pieces(benchmark, window, block_chars)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return blocks, ([tuple(r) for r in items.where(part == b).toLocalIterator()] for b in range(blocks))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: Iterable[str] | None = None,
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """`row` (the `keep` columns of docs), `n_words`, `spans` and `items` of every document.

    `spans` are the merged runs of hit words as (start, end), `items` the ids of the
    benchmark items with a window in the text, sorted as strings. Null and empty
    texts have no words; null item ids are left out of `items`, though their words
    are hit; repeated rows are judged one by one; empty tables give no rows or no
    hits; further columns of docs stay inside `row`.

    Benchmarks larger than `block_chars` are searched block by block, each block
    broadcast on its own and adding to the spans of those before it, which are written
    before the next block is read.
    """
    kept = list(docs.columns if keep is None else keep)
    needed = list(dict.fromkeys([*kept, "text"]))
    fields = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"

    def search(df: DataFrame, block: list[tuple], keep: list[str]) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(block)

        def start() -> Callable:
            phrases = Phrases(shared.value, window)

            def compute(rows: pa.StructArray):
                texts = [phrases.symbols(plain_word_numbers(t)) for t in rows.field("text").cast(pa.binary()).to_pylist()]
                found = phrases.find(texts)
                spans = [spans_of(hit) if hit is not None else [] for hit, _ in found]
                items = [sorted(str(i) for i in items if i is not None) for _, items in found]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                spans = [[{"start": a, "end": b} for a, b in s] for s in spans]
                return [
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(spans, kind),
                    pa.array(items, pa.list_(pa.string())),
                ]

            return compute

        return extend(df, start, fields, keep)

    number, blocks = _blocks(benchmark, window, block_chars)
    found = search(docs.select(*needed), next(blocks), kept if number == 1 else needed)
    for k, block in enumerate(blocks, 2):
        packed = stage(found, "blocks").select("row.*", F.struct("spans", "items").alias("_found"))
        found = search(packed, block, [*(kept if k == number else needed), "_found"])
        found = found.select(
            found.row.dropFields("_found").alias("row"),
            "n_words",
            _merged(F.concat("row._found.spans", "spans")).alias("spans"),
            F.array_sort(F.array_union("row._found.items", "items")).alias("items"),
        )
    return found


def _merged(spans):
    """Overlapping or touching spans as one."""
    last = lambda a: F.element_at(a, -1)
    return F.aggregate(
        F.array_sort(spans),
        F.slice(spans, 1, 0),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.try_element_at(done, F.lit(-1))["start"].alias("start"),
                        F.greatest(F.try_element_at(done, F.lit(-1))["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, hit words, items found and their digest."""
    found = find_contamination(docs, benchmark, ["doc_id"])
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "row.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def remove_contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs with the hit spans cut out of `text` (and `n_chars` counted anew if present)."""
    found = find_contamination(docs, benchmark, **options)

    def start() -> Callable:
        def compute(rows: pa.StructArray):
            texts = rows.field("row").field("text").cast(pa.binary())
            spans = rows.field("spans").to_pylist()
            cut = [
                without(texts[k].as_py(), [(s["start"], s["end"]) for s in x]).decode() if x else None
                for k, x in enumerate(spans)
            ]
            return [pa.array(cut, pa.string())]

        return compute

    done = extend(found, start, "cut string", ["row"])
    text = F.coalesce("cut", "row.row.text")
    counted = {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return done.select(*(counted.get(c, F.col(f"row.row.`{c}`")).alias(c) for c in docs.columns))

