"""MinHash near-deduplication by a signature-coordinate inverted join.

Texts with the same shingle set form a class and go on as one. A signature has
`COORDINATES` minima; two classes are candidates if they collide in at least
`MATCHES` of them. Classes are posted under the coordinate-value pairs of a prefix of
`PREFIX` coordinates; two texts at the bar share none of these with a probability of
0.25 ** PREFIX, 6e-8, and pairs with one posting are skipped. For counting collisions
eight bits of each coordinate do.

A posting list is never expanded into its pairs. Instead, in three rounds:

1. every class is compared with the smallest class of each of its lists;
2. with a random class of each list that is not yet in its component;
3. what is left: in each list that still holds several components, classes
   outside the list's largest component are compared with all classes of other
   components, in blocks, at the first coordinate two classes share (so each pair
   comes up once).

Every comparison counts collisions on the signatures first and is then confirmed
on the full shingle sets. Only pairs known to be connected anyway are left out, so
all links between candidates count. A pair at the bar itself collides in fewer than
MATCHES coordinates with a probability of 5e-6, and far less above it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.batches import extend, map_arrow
from daymark.llm.components import components
from daymark.llm.words import spaced_word_numbers
from daymark.session import stage

SHINGLE = 5
SIMILARITY = 75  # per cent
COORDINATES = 64
MATCHES = 32
PREFIX = 12
# What one task holds in memory while others stream past: texts, their shingles (in the last
# round), signatures; and rows that stream past.
_HELD_TEXTS, _HELD_SHINGLES, _HELD_SIGNS, _STREAMED = 1024, 2**22, 2048, 4096
# A key with more than one in so many rows of all posting lists is long; so fewer keys than that are.
_LONG = 1000
# Candidates a task gathers before it passes them on: one streamed row can have as many as are held.
_FLUSH = 2**18

_RANDOM = np.random.default_rng(7)
_STEPS = _RANDOM.integers(1, 2**63, SHINGLE, np.uint64) | np.uint64(1)
_FACTORS = _RANDOM.integers(1, 2**63, COORDINATES, np.uint64) | np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; short texts are one shingle."""
    h = spaced_word_numbers(text)
    if not len(h):
        return h
    if len(h) < SHINGLE:
        return _mixed((h * _STEPS[: len(h)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(h)))
    n = len(h) - SHINGLE + 1
    total = h[:n] * _STEPS[0]
    for k in range(1, SHINGLE):
        total += h[k : k + n] * _STEPS[k]
    total = np.sort(_mixed(total))
    return total[np.append(True, total[1:] != total[:-1])]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The upper 32 bits of the least product of each factor with the shingles."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        np.minimum(least, (shingles[None, at : at + 512] * _FACTORS[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether 100 * intersection >= SIMILARITY * union."""
    if 100 * min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[place] == a).sum())
    return 100 * both >= SIMILARITY * (len(a) + len(b) - both)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, the 128-bit digest (`high`, `low`) of the shingle set, and its
    signature: the `prefix` in full and the low byte of all coordinates (`marks`)."""

    def start() -> Callable:
        def compute(rows: pa.StructArray):
            sizes, high, low, prefixes, marks = [], [], [], [], []
            for text in rows.field("text").cast(pa.binary()):
                found = shingle_set(text.as_py())
                sizes.append(len(found))
                digest = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64)
                high.append(int(digest[0]) if len(found) else None)
                low.append(int(digest[1]) if len(found) else None)
                sign = signature(found)
                prefixes.append(sign[:PREFIX].view(np.int32) if len(found) else None)
                marks.append(sign.astype(np.uint8).tobytes() if len(found) else None)
            return [
                pa.array(sizes, pa.int64()),
                pa.array(high, pa.int64()),
                pa.array(low, pa.int64()),
                pa.array(prefixes, pa.list_(pa.int32())),
                pa.array(marks, pa.binary()),
            ]

        return compute

    fields = "n_shingles long, high long, low long, prefix array<int>, marks binary"
    found = extend(docs.select("doc_id", "text"), start, fields, ["doc_id"])
    return found.select("row.doc_id", "n_shingles", "high", "low", "prefix", "marks")


def _marks(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDINATES)


def _matching(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """The rows with a pair (x, y) that collides in MATCHES coordinates and whose sizes allow the bar."""
    columns = pairs.columns
    for c in "xy":
        sign = signs.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("marks").alias(f"m{c}"))
        pairs = pairs.join(sign, c)
    fits = pairs.where(100 * F.least("nx", "ny") >= SIMILARITY * F.greatest("nx", "ny"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            enough = (_marks(batch.column("mx")) == _marks(batch.column("my"))).sum(axis=1) >= MATCHES
            yield batch.select(columns).filter(pa.array(enough))

    return map_arrow(fits.select(*columns, "mx", "my"), count, ", ".join(f"{c} long" for c in columns))


def _listed(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (x, y, home) as xs to hold (block, id) and lists (y, block, xs).

    A home is a block; one with more than `_HELD_TEXTS` xs is cut into several.
    """
    pairs = stage(pairs, "pairs")
    cuts = pairs.select("home", "x").distinct().groupBy("home").agg(F.ceil(F.count("*") / _HELD_TEXTS).alias("cuts"))
    block = F.xxhash64("home", F.pmod(F.xxhash64("x"), "cuts"))
    dealt = pairs.join(cuts, "home").select("x", "y", block.alias("block"))
    held = dealt.select("block", F.col("x").alias("id")).distinct()
    return held, dealt.groupBy("y", "block").agg(F.collect_set("x").alias("xs"))


def _confirmed(dealt: tuple[DataFrame, DataFrame], texts: DataFrame) -> DataFrame:
    """The pairs (x, y) that are similar on their full shingle sets, of held xs and lists (y, block, xs).

    A text y is sent once to each block that holds an x of its; a block with many ys is
    split and its xs are copied to each part. A task holds one block's sets while ys stream by.
    """
    held, lists = (stage(d, "dealt") for d in dealt)
    spark = lists.sparkSession
    parts = lists.groupBy("block").agg(F.ceil(F.count("*") / _STREAMED).alias("parts"))
    streamed = lists.join(parts, "block").select(
        "block",
        F.pmod(F.xxhash64("y"), "parts").alias("part"),
        F.lit(1).alias("kind"),
        F.col("y").alias("id"),
        "xs",
    )
    held = held.join(parts, "block").select(
        "block",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        F.lit(0).alias("kind"),
        "id",
        F.lit(None).cast("array<long>").alias("xs"),
    )
    # Both sides grow with the corpus: a merge join at every size.
    rows = held.union(streamed).join(texts.hint("merge"), "id").select("block", "part", "kind", "id", "xs", "text")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(max(tasks, 1), "block", "part").sortWithinPartitions("block", "part", "kind")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sets = None, {}
        for batch in batches:
            xs_found, ys_found = [], []
            block, part, kind, ids, lists = (batch.column(i).to_pylist() for i in range(5))
            for i, text in enumerate(batch.column(5).cast(pa.binary())):
                if (block[i], part[i]) != at:
                    at, sets = (block[i], part[i]), {}
                own = shingle_set(text.as_py())
                if kind[i] == 0:
                    sets.setdefault(ids[i], []).append(own)
                    continue
                for x in lists[i]:
                    if any(similar(s, own) for s in sets[x]):
                        xs_found.append(x)
                        ys_found.append(ids[i])
            yield pa.RecordBatch.from_arrays([pa.array(xs_found, pa.int64()), pa.array(ys_found, pa.int64())], ["x", "y"])

    return map_arrow(rows, compare, "x long, y long")


def _with_facts(lists: DataFrame, facts: DataFrame) -> DataFrame:
    """Posting lists joined by key with `facts`: one row per key, with the length `ids` of its list.

    A long list stays where its rows lie: the facts of the long ones, fewer than `_LONG` rows
    at any size of the corpus, are sent to them. All other lists are shuffled by key.
    """
    facts = stage(facts, "facts")
    rows = facts.agg(F.sum("ids")).first()[0] or 0
    is_long = F.col("ids") * _LONG > rows
    long = F.broadcast(facts.where(is_long))
    short = lists.join(long.select("key"), "key", "left_anti").join(facts.where(~is_long), "key")
    return lists.join(long, "key").unionByName(short)


def _remaining(lists: DataFrame, signs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates of different components, from posting lists (key, id, comp), dealt as by `_listed`.

    In each posting list, the ids outside its largest component are held in slices, and all
    its ids stream past each slice in parts. Slices and the blocks the xs are dealt into follow
    the same order of hashes, so a slice meets few blocks.
    """
    spark = lists.sparkSession
    sizes = lists.groupBy("key", "comp").agg(F.count("*").alias("ids"))
    largest = sizes.groupBy("key").agg(
        F.max(F.struct("ids", "comp"))["comp"].alias("main"),
        F.sum("ids").alias("ids"),
        (F.sum("ids") - F.max("ids")).alias("outside"),
    )
    spread = _with_facts(lists, largest).withColumns(
        {
            "slices": F.ceil(F.col("outside") / _HELD_SIGNS),
            "parts": F.ceil(F.col("ids") / _STREAMED),
            "spot": F.pmod(F.xxhash64("id"), F.lit(2**31)) / F.lit(2.0**31),
        }
    )
    outside = spread.where("comp <> main")
    shingles = outside.select("id").distinct().join(signs.select("id", "n"), "id").agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-shingles // _HELD_SHINGLES))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    held = outside.select(
        "key", F.floor(F.col("spot") * F.col("slices")).alias("slice"), every("parts").alias("part"),
        F.lit(0).alias("kind"), "id", "comp", "main", (F.col("spot") * blocks).cast("int").alias("block"),
    )
    streamed = spread.withColumn("part", F.pmod(F.xxhash64("id"), "parts")).select(
        "key", every("slices").alias("slice"), "part", F.lit(1).alias("kind"), "id", "comp", "main", F.lit(0).alias("block")
    )
    rows = held.union(streamed).join(signs, "id")
    rows = rows.select("key", "slice", "part", "kind", "id", "comp", "main", "block", "n", "marks", "prefix")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, "key", "slice", "part").sortWithinPartitions("key", "slice", "part", "kind")

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, block, used, found, waiting = None, [], None, None, [], 0

        def part() -> pa.RecordBatch:
            columns = [[f[k] for f in found] for k in range(3)]
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["id", "block", "xs"])

        def close() -> None:
            if block is not None:
                for k in np.flatnonzero(used).tolist():
                    found.append((int(block[0][k]), int(block[3][k]), None))

        for batch in batches:
            *place, kind, ids, comps, main, blocks, sizes = (batch.column(i).to_pylist() for i in range(9))
            marks = _marks(batch.column(9))
            prefix = np.asarray(batch.column(10).values).reshape(-1, PREFIX)
            for i, spot in enumerate(zip(*place)):
                if spot != at:
                    close()
                    at, held, block = spot, [], None
                if kind[i] == 0:
                    held.append((ids[i], comps[i], sizes[i], blocks[i], marks[i].copy(), prefix[i].copy()))
                    continue
                if block is None:
                    block = [np.array([h[k] for h in held]) for k in range(6)]
                    used = np.zeros(len(held), bool)
                n = sizes[i]
                fits = (100 * np.minimum(block[2], n) >= SIMILARITY * np.maximum(block[2], n)) & (block[1] != comps[i])
                if comps[i] != main[i]:  # both are held: once is enough
                    fits &= block[0] < ids[i]
                fits = np.flatnonzero(fits)
                fits = fits[(block[4][fits] == marks[i]).sum(axis=1) >= MATCHES]
                fits = fits[(block[5][fits] == prefix[i]).argmax(axis=1) == spot[0] >> 32]
                used[fits] = True
                for b in np.unique(block[3][fits]).tolist():
                    found.append((ids[i], b, block[0][fits[block[3][fits] == b]]))
                waiting += len(fits)
                if waiting > _FLUSH:
                    yield part()
                    found.clear()
                    waiting = 0
            yield part()
            found.clear()
            waiting = 0
        close()
        yield part()

    found = stage(map_arrow(rows, candidates, "id long, block long, xs array<long>"), "candidates")
    xs = found.where("xs IS NULL").select("block", "id").distinct()
    ys = found.where("xs IS NOT NULL").groupBy(F.col("id").alias("y"), "block")
    return xs, ys.agg(F.flatten(F.collect_list("xs")).alias("xs"))


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Links that have the components so far and the further links in them."""
    return comps.select(F.col("node").alias("x"), F.col("component").alias("y")).union(links)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of `docs` (doc_id, text).

    Null, empty and blank texts have no shingles and are linked with nothing; texts
    of fewer than five words are one shingle. Rows with the same doc_id are one node
    with several texts, and each comes out. Rows without a doc_id are linked with
    nothing and have neither component nor verdict. Further columns are ignored. Ties
    cannot arise: the component is its smallest doc_id. Empty tables give no rows.
    """
    marked = stage(signatures(docs), "signatures")
    linked = marked.where("high IS NOT NULL AND doc_id IS NOT NULL")
    classes = stage(
        linked.groupBy("high", "low").agg(
            F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("marks").alias("marks"), F.first("prefix").alias("prefix")
        ),
        "classes",
    )
    signs = classes.select("id", "n", "marks", "prefix")
    value = F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    posted = signs.select("id", F.posexplode("prefix").alias("at", "value")).select(
        F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(value).alias("key"), "id"
    )
    crowds = posted.groupBy("key").agg(F.count("*").alias("ids"), F.min("id").alias("lead")).where("ids > 1")
    lists = stage(_with_facts(posted, crowds).select("key", "id", "lead"), "postings")
    crowd = lists.select("id").distinct()
    # The crowd grows with the corpus: a merge join at every size, never a broadcast of it.
    own = docs.select(F.col("doc_id").alias("id"), "text").join(crowd.hint("merge"), "id", "left_semi")
    texts = stage(own.distinct(), "texts")

    # 1: the smallest class of each list. What meets one leader is at home with the least of its leaders.
    led = lists.where("lead <> id").select(F.col("lead").alias("x"), F.col("id").alias("y")).distinct()
    tried = stage(_matching(led, signs), "pairs")
    homes = tried.groupBy("y").agg(F.min("x").alias("home"))
    comps = components(stage(_confirmed(_listed(tried.join(homes, "y")), texts), "links"))

    def mixed_lists() -> DataFrame:
        """Posting lists that hold several components."""
        known = comps.select(F.col("node").alias("id"), F.col("component"))
        own = lists.select("key", "id").join(known, "id", "left").select("key", "id", F.coalesce("component", "id").alias("comp"))
        mixed = own.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.count("*").alias("ids"))
        return stage(_with_facts(own, mixed.where("a <> b")).select("key", "id", "comp"), "lists")

    # 2: a random class of each list, where that is in another component.
    own = mixed_lists()
    mask = F.xxhash64("key")
    picked = own.groupBy("key").agg(F.min(F.col("id").bitwiseXOR(mask)).alias("least"), F.count("*").alias("ids"))
    picked = picked.select("key", F.col("least").bitwiseXOR(mask).alias("x"), "ids")
    met = _with_facts(own, picked.join(own.select("key", F.col("id").alias("x"), F.col("comp").alias("other")), ["key", "x"]))
    met = met.where("comp <> other").select("x", F.col("id").alias("y"), F.least("comp", "other").alias("home"))
    met = met.groupBy("x", "y").agg(F.min("home").alias("home"))
    untried = met.join(tried.union(tried.select("y", "x")), ["x", "y"], "left_anti")
    second = _matching(untried, signs)
    comps = components(_joined(comps, stage(_confirmed(_listed(second), texts), "links")))

    # 3: all others.
    links = stage(_confirmed(_remaining(mixed_lists(), signs), texts), "links")
    comps = components(_joined(comps, links))

    member = classes.select("high", "low", "id").join(comps, F.col("id") == F.col("node"), "left")
    member = member.select("high", "low", F.coalesce("component", "id").alias("component"))
    alone = marked.where("high IS NULL OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component"))
    grouped = linked.join(member, ["high", "low"]).select("doc_id", "n_shingles", "component")
    return grouped.union(alone).select(
        "doc_id", "n_shingles", F.col("component").alias("component_id"), (F.col("doc_id") == F.col("component")).alias("kept")
    )
