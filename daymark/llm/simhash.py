"""SimHash near-deduplication with Gray-order hierarchical indexes.

Equal fingerprints form a class. Two fingerprints at most `DISTANCE` bits apart agree in at
least `SEGMENTS - DISTANCE` of `SEGMENTS` segments of their bits, so every class is posted once
for each choice of that many segments, under their bits, and pairs are looked for among the
classes with one key only.

A task holds the classes of a key in an index: sorted by Gray rank, so that neighbours share bits;
each node keeps the bits that all below it share and its parent does not have yet. A search goes
down from the top, adds up the differences with the shared bits, and leaves a whole group as soon as
they are too many, or if the group is known to be connected with the query already.

A key with more than `HELD` classes is cut into parts, which some `LEADS` random classes visit
all. After that, the classes outside the largest component of such a key are compared, slice
by slice, with all of its classes, part by part. So no pair is left out but those known to be
connected, and what a task holds does not grow with the key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.batches import extend
from daymark.llm.components import components
from daymark.session import stage

SHINGLE = 3
SEED = 42
BITS = 64
DISTANCE = 3
SEGMENTS = 5
HELD, LEADS = 1024, 64
FAN = 8  # children of a node
QUERIES = 128  # searched for at once
_PIECE = 2**14  # shingles hashed at once
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: bytes | None) -> int:
    """A bit is 1 if it is set in over half of the hashes of the text's shingles, repeats included.

    Texts of one or two words are one shingle; null, empty and blank texts have fingerprint 0.
    """
    spaced = b" ".join(text.translate(_LOWER).split()) if text else b""
    if not spaced:
        return 0
    spaces = np.flatnonzero(np.frombuffer(spaced, np.uint8) == 32)
    starts, ends = np.append(0, spaces + 1), np.append(spaces, len(spaced))
    n = max(1, len(starts) - SHINGLE + 1)
    ends = ends[-n:]
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _PIECE):
        places = zip(starts[at : min(n, at + _PIECE)].tolist(), ends[at : at + _PIECE].tolist())
        h = np.array([digest(spaced[a:b], SEED) for a, b in places], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Fingerprints under a tree of the bit patterns that groups of them share."""

    def __init__(self, codes: np.ndarray):
        self.order = np.argsort(gray_rank(codes), kind="stable")
        self.codes = codes[self.order]
        levels = []
        both = either = self.codes
        while len(both) > 1 or not levels:
            starts = np.arange(0, len(both), FAN)
            both, either = np.bitwise_and.reduceat(both, starts), np.bitwise_or.reduceat(either, starts)
            levels.append((~(both ^ either), both))
        levels.reverse()
        # From the top: which bits a node adds to those of its parent, and their values.
        self.levels, above = [], np.zeros(1, np.uint64)
        for shared, bits in [*levels, (np.full(len(codes), ~np.uint64(0)), self.codes)]:
            parent = np.arange(len(shared)) // FAN if len(shared) > 1 or self.levels else np.zeros(1, np.int64)
            self.levels.append((shared & ~above[parent], bits))
            above = shared

    def uniform(self, labels: np.ndarray) -> list[np.ndarray]:
        """For each level the label that all below a node have, or -1."""
        low = high = labels[self.order]
        found = [low]
        for _ in self.levels[1:]:
            starts = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            found.append(np.where(low == high, low, -1))
        return found[::-1]

    def near(self, codes: np.ndarray, most: int, known: np.ndarray | None = None, groups: list[np.ndarray] | None = None):
        """(query, place) of all pairs at most `most` bits apart; groups whose label is the query's `known` one are left out."""
        query = np.arange(len(codes))
        node = np.zeros(len(codes), np.int64)
        apart = np.zeros(len(codes), np.int64)
        for depth, (mask, bits) in enumerate(self.levels):
            if depth:
                query, apart = np.repeat(query, FAN), np.repeat(apart, FAN)
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                there = node < len(mask)
                query, node, apart = query[there], node[there], apart[there]
            apart = apart + np.bitwise_count((codes[query] ^ bits[node]) & mask[node])
            go_on = apart <= most
            if groups is not None:
                go_on &= groups[depth][node] != known[query]
            query, node, apart = query[go_on], node[go_on], apart[go_on]
        return query, self.order[node]


def merged(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The labels after those of `a` and `b`, pair by pair, are made one; the smaller label stays."""
    root = np.arange(labels.max() + 1)
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return root[labels]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]


def tile_links(ids: np.ndarray, codes: np.ndarray, comps: np.ndarray, asks: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the pairs of an `asks` row and a `held` row at most DISTANCE bits apart connect.

    Rows of one component count as connected. Every link is between the first id of a group and
    that of a component in it, so there are fewer links than components.
    """
    _, own = np.unique(comps, return_inverse=True)
    labels = own
    places = np.flatnonzero(held)
    queries = np.flatnonzero(asks)
    if not len(places) or not len(queries):
        return ids[:0], ids[:0]
    index = GrayIndex(codes[places])
    groups = index.uniform(labels[places])
    for at in range(0, len(queries), QUERIES):
        some = queries[at : at + QUERIES]
        query, place = index.near(codes[some], DISTANCE, labels[some], groups)
        if len(query):
            labels = merged(labels, labels[some[query]], labels[places[place]])
            groups = index.uniform(labels[places])
    first = np.full(own.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, own, ids)
    of = np.empty(len(first), np.int64)
    of[own] = labels
    lead = np.full(labels.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(lead, of, first)
    other = first != lead[of]
    return lead[of][other], first[other]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and `code`, the fingerprint's 64 bits as a long, of every row."""

    def start() -> Callable:
        def compute(rows: pa.StructArray):
            found = [fingerprint(t.as_py()) for t in rows.field("text").cast(pa.binary())]
            return [pa.array(np.array(found, np.uint64).view(np.int64))]

        return compute

    return extend(docs.select("doc_id", "text"), start, "code long", ["doc_id"]).select("row.doc_id", "code")


def _segment_keys() -> Column:
    """The keys of column `code`: the number of the choice of segments, then their bits."""
    edges = [BITS * k // SEGMENTS for k in range(SEGMENTS + 1)]
    parts = [
        (F.shiftrightunsigned("code", low).bitwiseAND(F.lit(2 ** (high - low) - 1)), high - low)
        for low, high in zip(edges, edges[1:])
    ]
    keys = []
    for number, choice in enumerate(combinations(parts, SEGMENTS - DISTANCE)):
        key = F.lit(number).cast("long")
        for bits, width in choice:
            key = F.shiftleft(key, width).bitwiseOR(bits)
        keys.append(key)
    return F.array(*keys)


def _linked(tiles: DataFrame) -> DataFrame:
    """Links (x, y) of tiles (key, slice, part, asks, held, id, code, comp)."""
    place = ["key", "slice", "part"]
    tasks = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = tiles.select(*place, "asks", "held", "id", "code", "comp")
    tiles = tiles.repartition(tasks, *place).sortWithinPartitions(*place)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part(found: list) -> pa.RecordBatch:
            columns = [np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["x", "y"])

        rest: list[np.ndarray] = []  # the columns of a tile that the last batch may have cut
        for batch in batches:
            columns = [np.asarray(c.cast(pa.int64())) for c in batch.columns]
            if rest:
                columns = [np.concatenate(c) for c in zip(rest, columns)]
            new = np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)
            edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(columns[0])]
            found = [_tile(columns, a, b) for a, b in zip(edges, edges[1:-1])]
            rest = [c[edges[-2] :] for c in columns]
            yield part(found)
        if rest:
            yield part([_tile(rest, 0, len(rest[0]))])

    return tiles.mapInArrow(search, "x long, y long")


def _tile(columns: list[np.ndarray], a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    asks, held, ids, codes, comps = (c[a:b] for c in columns[3:])
    return tile_links(ids, codes.view(np.uint64), comps, asks == 1, held == 1)


def _same_id(known: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (x, y) from a doc_id with several fingerprints to the class of each."""
    several = known.groupBy("doc_id").agg(F.min("code").alias("a"), F.max("code").alias("b")).where("a <> b")
    found = known.join(several.select("doc_id"), "doc_id").join(classes, "code")
    return found.select(F.col("doc_id").cast("long").alias("x"), F.col("id").alias("y"))


def _every(count: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))


def simhash_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id for every row of `docs` (doc_id, text).

    Null, empty and blank texts have fingerprint zero and are linked as any other; texts of
    one or two words are one shingle. Rows with the same doc_id are one node with several
    fingerprints, and each row comes out. Rows without a doc_id link nothing and have no
    component. Further columns are ignored. Ties cannot arise: the component is its
    smallest doc_id. Empty tables give no rows.
    """
    marked = stage(fingerprints(docs), "fingerprints")
    known = marked.where("doc_id IS NOT NULL")
    classes = stage(known.groupBy("code").agg(F.min("doc_id").cast("long").alias("id")), "classes")
    posted = classes.select("id", "code", F.explode(_segment_keys()).alias("key"))
    crowds = posted.groupBy("key").agg(F.count("*").alias("ids")).where("ids > 1")
    lists = stage(posted.join(crowds.withColumn("parts", F.ceil(F.col("ids") / HELD)), "key"), "postings")

    yes, no = F.lit(1), F.lit(0)
    lead = (F.col("parts") > 1) & (F.pmod(F.xxhash64("id", F.lit(1)), "ids") < LEADS)
    every, own = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), F.array(F.pmod(F.xxhash64("id"), "parts"))
    tiles = lists.withColumns({"slice": F.lit(0).cast("long"), "asks": yes, "held": yes, "comp": F.col("id")})
    tiles = tiles.withColumn("part", F.explode(F.when(lead, every).otherwise(own)))
    comps = components(_same_id(known, classes).union(stage(_linked(tiles), "links")))

    # Keys of several parts: what is outside the largest component, against all.
    crowded = lists.where("parts > 1").select("key", "id", "code", "parts")
    crowded = crowded.join(comps, F.col("id") == F.col("node"), "left").select(
        "key", "id", "code", "parts", F.coalesce("component", "id").alias("comp")
    )
    crowded = stage(crowded, "crowded")
    sizes = crowded.groupBy("key", "comp").agg(F.count("*").alias("ids"))
    main = sizes.groupBy("key").agg(
        F.max(F.struct("ids", "comp"))["comp"].alias("main"),
        F.ceil((F.sum("ids") - F.max("ids")) / HELD).alias("slices"),
    )
    left = crowded.join(main.where("slices > 0"), "key")
    asking = left.where("comp <> main").withColumns({"slice": F.pmod(F.xxhash64("id"), "slices"), "asks": yes, "held": no})
    holding = left.withColumns({"part": F.pmod(F.xxhash64("id"), "parts"), "asks": no, "held": yes})
    tiles = asking.withColumn("part", _every("parts")).unionByName(holding.withColumn("slice", _every("slices")))
    links = stage(_linked(tiles), "links")
    comps = components(comps.select(F.col("node").alias("x"), F.col("component").alias("y")).union(links))

    member = classes.join(comps, F.col("id") == F.col("node"), "left").select("code", F.coalesce("component", "id").alias("component_id"))
    digits = F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint")
    alone = marked.where("doc_id IS NULL").select("doc_id", digits, F.lit(None).cast("long").alias("component_id"))
    # Classes grow with the corpus: a merge join at every size.
    return known.join(member.hint("merge"), "code").select("doc_id", digits, "component_id").union(alone)
