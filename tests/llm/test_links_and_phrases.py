"""SimHash, spelling variants and collocations against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from daymark.llm import collocations, simhash, variants

LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, lang string"
ODD = [
    (900, None, "en"), (901, "", "en"), (902, " \t\n ", None), (903, "Word", None), (904, "two words", "xx"),
    (905, "same same same same " * 3000, "en"), (905, "another text of this id", "en"), (None, "no id here at all", None),
    (906, "same same same same " * 3000, "en"),
]


def docs_of(spark, rows):
    df = spark.createDataFrame(list(rows), DOCS)
    for name in ("row", "id", "code", "key", "part", "word", "n", "w1", "phrase", "score", "rank"):
        df = df.withColumn(name, F.lit("mine"))
    return df


def near_copies(n=120, seed=3):
    """Long texts in families that differ in a word or two, and texts of their own."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(n):
        if k % 3 and rows:
            text = rng.choice(rows)[1].split()
            text[rng.randrange(len(text))] = rng.choice(words)
        else:
            text = [rng.choice(words) for _ in range(rng.randint(30, 200))]
        rows.append((k, " ".join(text).capitalize(), "en"))
    return rows


# --- 11: SimHash ------------------------------------------------------------


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    found = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def linked(nodes, pairs):
    """Smallest node reachable, by node."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


def test_fingerprints_of_pieces_are_those_of_the_whole(monkeypatch):
    text = " ".join(f"w{k % 97}" for k in range(2000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "_PIECE", 7)
    assert simhash.fingerprint(text.encode()) == whole == fingerprint(text)


@pytest.mark.parametrize("held", [1024, 8])
def test_simhash_equals_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(simhash, "HELD", held)
    monkeypatch.setattr(simhash, "LEADS", 2)
    rows = [*near_copies(), *ODD]
    got = simhash.simhash_duplicates(docs_of(spark, rows)).collect()
    codes = [(i, fingerprint(t)) for i, t, _ in rows]
    known = [(i, c) for i, c in codes if i is not None]
    pairs = [(a, b) for a, x in known for b, y in known if (x ^ y).bit_count() <= 3]
    component = linked({i for i, _ in known}, pairs)
    expected = sorted(((i, f"{c:016x}", component.get(i)) for i, c in codes), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == expected
    assert len(set(component.values())) < len(component)


@pytest.mark.parametrize("held", [4096, 16, 1])
def test_dense_crowds_are_linked_like_brute_force(spark, monkeypatch, held):
    """Fingerprints a few bits from each other, so that keys hold many and form several components."""
    monkeypatch.setattr(simhash, "HELD", held)
    monkeypatch.setattr(simhash, "LEADS", 3)
    rng = random.Random(held)
    centres = [rng.getrandbits(64) for _ in range(3)]
    codes = {}
    for k in range(150):
        code = centres[k % 3]
        for _ in range(rng.randint(0, 6)):
            code ^= 1 << rng.choice(range(0, 64, 3))
        codes[k] = code
    rows = spark.createDataFrame([(k, c - 2**64 if c >= 2**63 else c) for k, c in codes.items()], "doc_id long, code long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs: docs)
    got = {r.doc_id: r.component_id for r in simhash.simhash_duplicates(rows).collect()}
    assert got == linked(codes, [(a, b) for a in codes for b in codes if (codes[a] ^ codes[b]).bit_count() <= 3])


def test_gray_index_finds_what_a_scan_finds():
    rng = np.random.default_rng(5)
    for n in (1, 2, 9, 300):
        codes = rng.integers(0, 2**12, n, np.uint64)
        index = simhash.GrayIndex(codes)
        query, place = index.near(codes, 2)
        apart = np.bitwise_count(codes[:, None] ^ codes[None, :])
        assert sorted(zip(query.tolist(), place.tolist())) == [tuple(x) for x in np.argwhere(apart <= 2).tolist()]
        assert (np.diff(simhash.gray_rank(codes)[index.order].astype(np.int64)) >= 0).all()


# --- 12: spelling variants --------------------------------------------------


def expected_variants(rows):
    counts = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def one_apart(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    best = {w: min(found, key=lambda v: (-words[v], v)) for w, found in near.items() if found}
    form = {w: v for w, v in best.items() if words[v] >= 2 * words[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()), key=repr)


def variant_rows():
    rng = random.Random(9)
    letters = "abÄé"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 8))) for _ in range(60)]
    base += ["aaaaa", "aaaaaa", "aaaaaaa", "Müller", "müller", "muller", "Mueller", "x" * 3000, "x" * 2999]
    weights = [rng.randint(1, 40) for _ in base]
    rows = [(k, " 1,".join(rng.choices(base, weights, k=150)), None) for k in range(40)]
    return [*rows, rows[3], *ODD, (907, "naïve — 中文 Straße's STRASSE", "de")]


@pytest.mark.parametrize("flush", [200_000, 5])
def test_variants_equal_brute_force(spark, monkeypatch, flush):
    monkeypatch.setattr(variants, "_FLUSH", flush)
    rows = variant_rows()
    got = variants.spelling_variants(docs_of(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected_variants(rows)


def test_trie_nodes_are_one_per_prefix():
    words = sorted({w for text in variant_rows() for w in (text[1] or "").split(" 1,")} | {"ab", "abc", "abd"})
    cuts = {words[len(words) // 2][:n] for n in range(1, 4)}
    nodes, of = variants._Nodes({p: k for k, p in enumerate(sorted(cuts), 1)}), defaultdict(set)
    for k, word in enumerate(words):
        path = nodes.path_of(2 * k // len(words), word)
        assert len(path) == len(word) + 1
        for n, node in enumerate(path):
            of[node].add(word[:n])
    assert all(len(found) == 1 for found in of.values())


# --- 13: collocations -------------------------------------------------------


def expected_phrases(rows, least, most):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(zip(*(words[j:] for j in range(k))))
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in often.items():
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in often.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def phrase_rows():
    rng = random.Random(4)
    words = ["the", "of", "New", "York", "City", "ünï", "a.b", "x\ty", "中文", "don't", "|", "end!", "l\nm", "A", "B"]
    rows = []
    for k in range(120):
        text = " ".join(rng.choice(["new york city", "the", *words, *words]) for _ in range(rng.randint(0, 60)))
        rows.append((k, text, [None, "en", "en", "de"][k % 4]))
    return [*rows, rows[5], *ODD]


@pytest.mark.parametrize("least, most, budget, flush", [(10, 2000, 2**21, 2**20), (2, 30, 50, 100), (3, 7, 1, 3)])
def test_collocations_equal_brute_force(spark, monkeypatch, least, most, budget, flush):
    monkeypatch.setattr(collocations, "_FLUSH_TOKENS", flush)
    monkeypatch.setattr(collocations, "_FLUSH_WORDS", flush)
    rows = phrase_rows()
    got = collocations.collocations(docs_of(spark, rows), least, most, budget).collect()
    assert sorted(tuple(r) for r in got) == expected_phrases(rows, least, most)


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 3_000_000_019, 4_000_000_007, 5_000_000_029
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(collocations._exact_score().alias("s")).first()
    assert row.s == 10**6 * a * a // (left * right)


def test_words_that_share_a_number_are_told_apart(spark, monkeypatch):
    rows = [(k, "alpha beta, gamma delta", "en") for k in range(12)]
    number = collocations.number
    monkeypatch.setattr(collocations, "number", lambda w, seed: 7 if seed == 0 else number(w, seed))
    got = {r.phrase: r.a for r in collocations.collocations(docs_of(spark, rows)).collect()}
    assert got == {"alpha beta": 12, "gamma delta": 12}


def test_groups_fit_the_budget_and_split_large_buckets():
    mass = np.zeros(collocations.BUCKETS, np.int64)
    mass[:6] = [5, 4, 30, 2, 9, 1]
    groups = collocations.Groups(mass, 10)
    assert groups.first[:6].tolist() == [0, 0, 1, 4, 5, 5] and groups.parts[:6].tolist() == [1, 1, 3, 1, 1, 1]


# --- all of them ------------------------------------------------------------


@pytest.mark.parametrize("operator", [simhash.simhash_duplicates, variants.spelling_variants, collocations.collocations])
def test_empty_tables_and_blank_texts_give_no_rows_or_no_finds(spark, operator):
    assert operator(docs_of(spark, ODD).limit(0)).count() == 0
    blank = operator(docs_of(spark, [(1, None, None), (2, " ", "en")])).collect()
    assert blank == [] or {(r.fingerprint, r.component_id) for r in blank} == {("0" * 16, 1)}
