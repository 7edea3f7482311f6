"""The data-preparation operators against brute force, round trips and planted cases."""

import hashlib
import os
import random
import re
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daymark.llm import batches, decontaminate, language, licenses, main_text, mixing, near_dedup, surrogates, top_k, toxicity, warc
from daymark.llm.fuzzy import Lexicon, Term
from daymark.llm.oracle import SQL
from daymark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
ODD = [(900, None), (901, ""), (902, "  \n"), (903, "word"), (904, "x" * 70000), (904, "x" * 70000), (None, "no id here")]


def docs_of(spark, rows, extra=False):
    df = spark.createDataFrame(list(rows), DOCS)
    if extra:  # names the operators give their own columns
        for name in ("row", "score", "n_words", "signature", "id", "rate", "spans", "new_text"):
            df = df.withColumn(name, F.lit("mine"))
    return df


def plain(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def some_texts(n=60, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(200)]
    return [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 120)))) for k in range(n)]


# --- 10: decontamination ----------------------------------------------------


def planted_benchmark(spark):
    texts = dict(some_texts())
    items = [(1, " ".join(texts[3].split()[:14])), (2, "w1 w2"), (3, ""), (4, None), (5, texts[9]), (5, texts[9])]
    rows = [*texts.items(), (70, f"Lead. {items[0][1].upper()}, tail w1, W2 end"), (71, items[0][1] + " x " + items[0][1]), *ODD]
    return rows, items, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_chars", [2**20, 200])
@pytest.mark.parametrize("shard", [2**19, 40])
def test_decontamination_equals_brute_force(spark, monkeypatch, block_chars, shard):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    rows, items, benchmark = planted_benchmark(spark)
    found = decontaminate.find_contamination(docs_of(spark, rows, extra=True), benchmark, ["doc_id"], block_chars=block_chars)
    windows = defaultdict(set)
    for item, text in items:
        w = plain(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(str(item))
    expected = Counter()
    for doc, text in rows:
        w, hit, names = plain(text), set(), set()
        for length in {len(x) for x in windows}:
            for k in range(len(w) - length + 1):
                if own := windows.get(tuple(w[k : k + length])):
                    names |= own
                    hit.update(range(k, k + length))
        expected[doc, len(w), len(hit), tuple(sorted(names))] += 1
    got = Counter((r.row.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), tuple(r["items"])) for r in found.collect())
    assert got == expected


def test_spans_are_cut_out_of_the_text(spark):
    rows, items, benchmark = planted_benchmark(spark)
    cut = {r.doc_id: r.text for r in decontaminate.remove_contamination(docs_of(spark, rows, extra=True), benchmark).collect()}
    assert cut[70] == "Lead. , tail  end"
    assert all(cut[d] == t for d, t in rows if d in (900, 901, 902, 903))
    empty = benchmark.where("false")
    assert decontaminate.contamination_report(docs_of(spark, rows), empty).where("contaminated").count() == 0
    assert decontaminate.contamination_report(docs_of(spark, []), benchmark).count() == 0


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    text = np.append(np.tile(rng.integers(1, 4, 50), 4), 0)
    order = decontaminate.suffix_array(text, 2)
    suffixes = [tuple(text[k:]) for k in order]
    assert suffixes == sorted(suffixes)


# --- 7: near-deduplication --------------------------------------------------


def test_near_duplicates_equal_brute_force(spark):
    rng, base = random.Random(3), [f"w{k}" for k in range(80)]
    rows = []
    for k in range(120):  # a group of near copies, some of them not quite near
        words = list(base)
        for _ in range(rng.randint(0, 7)):
            words[rng.randrange(80)] = f"z{rng.randrange(9999)}"
        rows.append((k, " ".join(words)))
    rows += [(k + 200, t) for k, t in some_texts(40)] + ODD + [(800, rows[0][1]), (801, "A b"), (802, "a\tB ")]
    sets, parent = [], {}
    for doc, text in rows:
        w = (text or "").lower().split()
        own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        if doc is not None:
            sets.append((doc, own))
            parent[doc] = doc

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                u, v = find(a), find(b)
                parent[max(u, v)] = min(u, v)
    got = near_dedup.near_duplicates(docs_of(spark, rows, extra=True)).collect()
    assert len(got) == len(rows)
    size = Counter((d, len(s)) for d, s in sets)
    assert Counter((r.doc_id, r.n_shingles) for r in got if r.doc_id is not None) == size
    assert all(r.component_id == find(r.doc_id) and r.kept == (r.doc_id == find(r.doc_id)) for r in got if r.doc_id is not None)
    assert near_dedup.near_duplicates(docs_of(spark, [])).count() == 0


# --- 2: licenses ------------------------------------------------------------


def test_license_scan(spark):
    rows = [
        (1, "cc by cc by x CC-BY all rights reserved all all rights reserved"),
        (2, "Released under the new MIT License."),
        (3, "the GNU General Public License, version 2"),
        (3, "another text of the same id, cc by"),
        (5, "general public public license"),
        *ODD,
    ]
    got = licenses.scan(docs_of(spark, rows, extra=True)).collect()
    by = {(r.doc_id, r.n_words): r for r in got}
    assert len(got) == len(rows)
    assert (by[1, 14].n_base, by[1, 14].first_word, by[1, 14].last_word, by[1, 14].base_labels) == (5, 0, 11, "cc-by,reserved")
    assert (by[2, 6].labels, by[2, 6].n_base, by[2, 6].first_word) == ("mit", 0, None)
    assert by[3, 7].base_labels == "gpl" and by[3, 8].base_labels == "cc-by"
    assert (by[5, 4].labels, by[5, 4].n_base) == ("", 0)
    assert (by[900, 0].n_base, by[900, 0].score, by[900, 0].labels) == (0, 0.0, "")
    assert all(0 <= r.score <= 1 for r in got)
    plan = licenses.scan(docs_of(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_a_long_license_is_found_with_words_changed_and_added(spark):
    rng = random.Random(8)
    body = [f"term{rng.randrange(300)}" for _ in range(500)]
    changed = body[:]
    for at in rng.sample(range(500), 10):
        changed[at] = "other"
    added = body[:100] + ["more"] + body[100:]
    half = body[:200]
    rows = [(k, "lead in " + " ".join(t) + " end") for k, t in enumerate((body, changed, added, half, body))] + [(4, "lead in " + " ".join(body) + " end")]
    got = licenses.scan(docs_of(spark, rows), {" ".join(body).upper(): "own"}).collect()
    assert sorted((r.doc_id, r.labels) for r in got) == [(0, "own"), (1, "own"), (2, "own"), (3, ""), (4, "own"), (4, "own")]
    assert {round(r.score, 3) for r in got if r.doc_id in (0, 4)} == {1.0}


# --- 8: top-k ---------------------------------------------------------------


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    vectors = [(k, [float(x) for x in rng.normal(0, 0.3, 5)]) for k in range(130)]
    vectors += [vectors[3], vectors[3], vectors[20], (60, vectors[7][1])]
    vectors += [(200, vectors[0][1]), (201, vectors[0][1]), (202, None), (203, [1.0, None, 0.0, 0.0, 0.0]), (204, [float("nan")] * 5), (205, [float("inf")] * 5), (206, [])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    sound = [(k, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for k, v in vectors if k not in (202, 203, 204, 205, 206)]
    expected = []
    for q in {q for q, _ in sound if q % 20 == 0}:
        pairs = [(a, k, b) for i, a in sound if i == q for k, b in sound if k != q]
        scored = sorted((-sum(x * y for x, y in zip(a, b)), k) for a, k, b in pairs)[:20]
        expected += [(q, n, k, -s) for n, (s, k) in enumerate(scored, 1)]
    got = top_k.top_k(df, F.col("vec_id") % 20 == 0).collect()
    assert sorted(tuple(r) for r in got) == sorted(expected)
    assert top_k.top_k(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_large_components_take_part_or_fail(spark):
    vectors = [(k, [float(x) for x in np.random.default_rng(k).normal(0, 1, 4)]) for k in range(40)]
    vectors += [(100, [2.0**21, -3.0, 1.0, 0.0]), (101, [-(2.0**30), 2.0**20, 0.5, 7.0]), (102, [1.0, 2.0**40, 0.0, 0.0])]
    schema = "vec_id long, embedding array<float>"
    whole = [(k, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for k, v in vectors]
    expected = set()
    for q, a in whole:
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), k) for k, b in whole if k != q)[:20]
            expected |= {(q, n, k, -s) for n, (s, k) in enumerate(scored, 1)}
    got = top_k.top_k(spark.createDataFrame(vectors, schema), F.col("vec_id") % 20 == 0).collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected) and {100, 101, 102} <= {r.vec_id for r in got}
    for large in (2.0**40, 2.0**60):
        far = spark.createDataFrame([(0, [large]), (1, [large])], schema)
        with pytest.raises(Exception, match="64 bits|beyond"):
            top_k.top_k(far, F.col("vec_id") % 20 == 0).collect()


def test_top_k_of_small_blocks_equals_brute_force(spark, monkeypatch):
    for name, value in {"INDEX_ROWS": 40, "INDEX_VALUES": 120, "QUERY_ROWS": 6, "TILE_QUERIES": 4, "TILE_ROWS": 9}.items():
        monkeypatch.setattr(top_k, name, value)
    rng = np.random.default_rng(5)
    vectors = []
    for _ in range(300):  # plain numbers, some whole, some too large for single floats, some for double ones
        x = rng.normal(0, 0.3, int(rng.choice([1, 2, 7]))) * rng.choice([1, 1, 1, 2.0**14, 2.0**23])
        vectors.append((int(rng.integers(-200, 200)), [float(np.float32(v)) for v in (np.round(x) if rng.random() < 0.4 else x)]))
    vectors += [vectors[3]] * 25 + [(40, [0.0] * 7)] * 2 + [(k, vectors[9][1]) for k in range(500, 540)]
    sound = [(k, [int(np.floor(64 * x)) for x in v]) for k, v in vectors]
    expected = []
    for q in {q for q, _ in sound if q % 20 == 0}:
        pairs = [(-sum(map(int.__mul__, a, b)), k) for i, a in sound if i == q for k, b in sound if k != q and len(a) == len(b)]
        expected += [(q, n, k, -s) for n, (s, k) in enumerate(sorted(pairs)[:20], 1)]
    got = top_k.top_k(spark.createDataFrame(vectors, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).collect()
    assert sorted(tuple(r) for r in got) == sorted(expected)


def test_top_k_neither_shuffles_nor_sorts_pairs_of_blocks(spark):
    vectors = [(k, [float(k % 7), 1.0]) for k in range(50)]
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(broadcast)
    spark.conf.set(broadcast, "-1")
    try:
        df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
        plan = top_k.top_k(df, F.col("vec_id") % 20 == 0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(broadcast, before)
    # A row of a whole block must not be held, sorted or copied once for each block that it meets.
    assert "collect_list" not in plan and "SortMergeJoin" not in plan
    assert re.search(r"MapInArrow best\(.*\n[ :+-]*CartesianProduct", plan)


def test_blocks_of_the_index_are_bounded_by_their_numbers_too(spark):
    wide = spark.range(2000).select(
        F.col("id").alias("vec_id"), F.expr("transform(sequence(1, 3000), x -> float((id * 31 + x * 17) % 64) / 64)").alias("embedding")
    )
    rows = top_k.map_arrow(top_k.quantised(wide), top_k._shortened, "vec_id long, v binary, dims int").withColumn("copies", F.lit(1).cast("long"))
    blocks, number = top_k._blocks(rows, top_k.INDEX_ROWS, top_k.INDEX_VALUES)
    sizes = blocks.select(F.length("ids") / 8, F.length("bits"), "low", "most").collect()
    assert len(sizes) == number == 6 and sum(r[0] for r in sizes) == 2000
    assert all(r[1] < 2**20 and r[2:] == (0, 63) for r in sizes)  # some 350 rows of 3,000 numbers of six bits


# --- 4: WARC ----------------------------------------------------------------


def test_archives_round_trip(spark, tmp_path):
    long = "é\r\n\r\n" * 900
    pages = [(1, "u", long), (2, "u", long), (3, None, None), (4, "u v", ""), (5, "u", "\r\n"), (6, "u", "short"), (7, "u", "short"), (None, "u", long), (8, "u", "y" * 5000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    warc.write_archives(df, str(tmp_path / "a"), chunk=700)
    got = warc.read_archives(spark, str(tmp_path / "a")).collect()
    assert all(r.sound for r in got)
    expected = Counter()
    for page, _, html in pages:
        body = (html or "").encode()
        revisit = len(body) >= 1000 and body == long.encode() and page != 2
        expected[f"urn:page:{'' if page is None else page}", "revisit" if revisit else "response", len(body), hashlib.sha1(body).hexdigest(), "urn:page:2" if revisit else None] += 1
    assert Counter((r.record_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in got) == expected


def test_rows_of_one_page_id_are_archived_by_their_own_payload(spark, tmp_path):
    a, b, c, d = ("a" * 1500, "b" * 1600, "c" * 1700, "d" * 1800)
    pages = [(5, a), (9, a), (5, b), (5, a), (7, d), (7, c), (None, a), (None, d), (None, c), (None, b + "x"), (None, "short"), (None, "short"), (None, None)]
    df = spark.createDataFrame([(k, "u", t) for k, t in pages], "page_id long, url string, html string")
    responses = {a: 9, d: 7, c: 7}
    expected = Counter()
    for page, html in pages:
        refers = responses.get(html) if page is None or html == a and page == 5 else None
        body = (html or "").encode()
        expected[page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if refers else "response", refers] += 1
    for broadcast in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        got = Counter(tuple(r) for r in warc.archive_report(df, str(tmp_path / broadcast)).collect())
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == expected


def test_oversized_payloads_become_segments():
    records = list(warc.page_records(1, "u", ("é" * 1000).encode(), None, chunk=333))
    assert len(records) > 1 and b"WARC-Segment-Number: 2" in records[1]
    assert all(len(r.partition(b"\r\n\r\n")[2]) <= 333 for r in records)
    reader = warc.PayloadReader()
    stream = b"".join(r + b"\r\n\r\n" for r in records)
    for step in (1, 7, len(stream)):
        found = [f for k in range(0, len(stream), step) for f in reader.feed(stream[k : k + step])]
        assert [(f[3], f[4]) for f in found] == [(2000, hashlib.sha1(("é" * 1000).encode()).hexdigest())]


# --- 3: toxicity ------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng, terms = random.Random(5), [Term("idiot", False), Term("scum", False), Term("worthless", False), Term("réeux", True)]
    lexicon = Lexicon(terms)
    for _ in range(3000):
        word = list(rng.choice([t.text for t in terms]))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(word) + 1)
            word[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "t", "st"])
        word = "".join(word)
        near = [(distance(word, t.text), k) for k, t in enumerate(terms) if not t.prefix and distance(word, t.text) <= (0, 0, 0, 0, 0, 1, 1, 1, 1, 2)[len(t.text)]]
        near += [(0, k) for k, t in enumerate(terms) if t.prefix and word.startswith(t.text)]
        assert lexicon.find(word) == min(near, default=None), word


def test_toxicity_scores(spark):
    rows = [(k, f"{t} and more words here {'you idiot scum' if k % 4 == 0 else ''}") for k, t in some_texts(200)]
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(200)], "doc_id long, quality int, toxic int")
    asked = [(1000, "you are an idiott"), (1001, "w1 w2 w3"), (1002, 'He said the word "idiot" is old.'), *ODD]
    got = {r.doc_id: r for r in toxicity.toxicity_report(docs_of(spark, rows + asked), labels).collect()}
    assert got[1000].predicted == 1 and got[1001].predicted == 0 and got[900].predicted == 0
    assert got[1002].score < got[1000].score
    assert all((got[k].predicted == 1) == (k % 4 == 0) for k in range(200))
    none = toxicity.toxicity_report(docs_of(spark, asked), labels.where("false")).collect()
    assert len(none) == len(asked) and {r.doc_id: r.predicted for r in none}[1000] == 1


def test_misspellings_are_found_beside_a_learned_stem(spark):
    forms = ["idiot", "idiots", "idiott", "idiotic", "blarken", "blarkens", "blarkened"]
    rows = [(k, f"{t} and more words here {forms[k // 4 % 7] + ' indeed' if k % 4 == 0 else ''}") for k, t in some_texts(560)]
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(560)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs_of(spark, rows), labels)
    stems = [t.text for t in model.terms if t.prefix]
    assert any("idiot".startswith(t) for t in stems) and any("blarken".startswith(t) for t in stems), stems
    finder = toxicity.Finder(model.terms)
    for word in ("idot", "idlot", "stupd", "idiot", "blorken", "blarkned"):
        assert [m[1] for m in finder.hits(f"such {word} here")[1]] == [int(word != "idiot")], word
    asked = [(1000, "you are an idot"), (1001, "w1 w2 w3")]
    got = {r.doc_id: r for r in toxicity.toxicity_report(docs_of(spark, rows + asked), labels).collect()}
    assert got[1000].predicted == 1 and got[1001].predicted == 0


# --- 5: language ------------------------------------------------------------


def test_language_mixture(spark):
    words = {"aa": "the and of that with from this", "bb": "der und die das nicht ein auf", "cc": "que los las para con una por"}
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choice(words[lang].split()) for _ in range(40)), lang) for k, lang in enumerate(list(words) * 40)]
    asked = [(500, rows[0][1] + " " + rows[1][1], None), (501, None, "aa"), (502, "12 34!", None), (503, "", None)]
    df = spark.createDataFrame(rows + asked, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.language_report(df).collect()}
    assert all(got[k].lang_pred == lang for k, _, lang in rows)
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (501, 502, 503))
    mixed = language.identify(df, ["doc_id"]).where("row.doc_id = 500").first().languages
    assert set(mixed) == {"aa", "bb"} and abs(sum(mixed.values()) - 1) < 1e-6
    assert {r.lang_pred for r in language.language_report(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# --- 6: surrogates ----------------------------------------------------------


def test_surrogates_keep_type_format_and_identity(spark):
    text = (
        "Bob.Smith@Mail.example.com, +1 (499) 555-6503 or (499) 555-6503, 4111 1111 1111 1111, 192.168.1.7, 078-05-1120, "
        'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", Mrs. Anna Schmidt, Mr Schmidt, Госпожа Анна, DE89 3704 0044 0532 0130 00'
    )
    rows = [(1, text), (2, "again bob.smith@mail.example.com"), (3, "2024-01-15 v 1.2.3 and 3.14159"), *ODD]
    got = {r.doc_id: r for r in surrogates.surrogate_report(docs_of(spark, rows, extra=True)).collect()}
    old, new = surrogates.detect(text), surrogates.detect(got[1].text)
    assert [e.kind for e in old] == [e.kind for e in new]
    assert not {e.canonical for e in old} & {e.canonical for e in new}
    same = defaultdict(set)
    for a, b in zip(old, new):
        same[a.kind, a.canonical].add(b.canonical)
    assert all(len(v) == 1 for v in same.values()) and len({(k[0], *v) for k, v in same.items()}) == len(same)
    assert [e.canonical for e in new if e.kind == "email"][0] in got[2].text
    card = [e.canonical for e in new if e.kind == "card"][0]
    assert surrogates.luhn_sum(card) == 0 and "192.168." in got[1].text and "+1 (" in got[1].text
    assert got[3].text == rows[2][1] and got[900].text is None and got[901].text == ""


def test_surrogates_that_meet_are_told_apart(spark, monkeypatch):
    make = surrogates.Surrogates._make
    monkeypatch.setattr(surrogates.Surrogates, "_make", lambda s, k, c, a: "same@x.example" if a == 0 else make(s, k, c, a))
    found = spark.createDataFrame([("email", f"a{k}@b.org") for k in range(4)], "kind string, canonical string")
    odd = surrogates.exceptions(found, b"k").collect()
    assert len(odd) == 3 and all(r.attempt == 1 for r in odd)


def test_untitled_mentions_get_the_surrogate_of_the_titled_name(spark):
    text = "Mrs Anna Schmidt came. Schmidt said no; ANNA's bag. Schmidt-led, Annabel stays, Mr Schmidt's too. Herr Dr. Meyer: Meyer."
    got = {r.doc_id: r for r in surrogates.surrogate_report(docs_of(spark, [(1, text), (2, "Schmidt and Anna, Dr No")])).collect()}
    given, last, meyer = re.match(r"Mrs (\w+) (\w+) came.*Herr Dr. (\w+):", got[1].text).groups()
    want = f"Mrs {given} {last} came. {last} said no; {given.upper()}'s bag. {last}-led, Annabel stays, Mr {last}'s too. Herr Dr. {meyer}: {meyer}."
    assert got[1].text == want and got[1].n_entities == 8
    assert not {given, last, meyer} & {"Anna", "Schmidt", "Meyer"} and got[2].text.startswith("Schmidt and Anna, Dr ")


@pytest.mark.parametrize(
    "kind, found, canonical",
    [
        ("email", "Ünal.Bob@x.com", "ünal.bob@x.com"),
        ("email", "иван@почта.рф", "иван@почта.рф"),
        ("phone", "4995556503", "4995556503"),
        ("phone", "06 12 34 56 78", "0612345678"),
        ("phone", "030 12 34 56 78", "03012345678"),
        ("ipv6", "2001:db8::1", "2001:0db8:0000:0000:0000:0000:0000:0001"),
        ("ipv6", "FE80:0:0:0:0:0:0:1", "fe80:0000:0000:0000:0000:0000:0000:0001"),
    ],
)
def test_further_formats_are_found_and_kept(kind, found, canonical):
    text = f"at {found}, x[1::2] 12:34:56 1700000000 v1.2"
    assert surrogates.detect(text) == [(3, 3 + len(found), kind, canonical)]
    new = surrogates.render(found, kind, surrogates.Surrogates(b"k").make(kind, canonical))
    assert [e.kind for e in surrogates.detect(f"at {new}.")] in ([kind], []) and new.isupper() == found.isupper()
    assert not set(re.findall(r"[^\W\d]{3,}", found.lower())) & set(re.findall(r"[^\W\d]{3,}", new.lower())) - {"com", "fe"}


def test_more_entities_than_the_first_space_holds(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    found = [("given-f", a + b + c) for a in letters for b in letters for c in letters][:9000]
    found += [("ip", f"192.168.{a}.{b}") for a in range(256) for b in range(256)]
    found += [("email", f"{c}@b.org") for c in letters] + [("phone", f"{n}") for n in range(1000, 9999)]
    odd = surrogates.exceptions(spark.createDataFrame(found, "kind string, canonical string"), b"k").collect()
    attempts, make = {(r.kind, r.canonical): r.attempt for r in odd}, surrogates.Surrogates(b"k").make
    given = {(k, make(k, c, attempts.get((k, c), 0))) for k, c in found}
    assert len(given) == len(found) and given.isdisjoint(found)
    assert 2 <= max(attempts.values()) <= 8
    assert surrogates.render("(12) 34", "phone", "987651") == "(98) 7651"
    assert all(s.startswith("10.") for k, s in given if k == "ip")
    # Later attempts draw from large spaces, whatever the kind.
    for kind, canonical in [("ip", "10.1.2.3"), ("ipv6", "fe80" + ":0000" * 7), ("secret", "-" * 14 + "a1"), ("card", "4111111111111111"), ("iban", "DE89370400440532013000"), ("email", "_@b.org")]:
        assert len({make(kind, canonical, n) for n in range(2, 300)}) == 298


# --- 9: main text -----------------------------------------------------------


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; only", "plain & only"),
        ("<body><nav><a>x</a></nav></body>", ""),
        ("<body><article><h1>Ti</h1><p>One  &lt;b&gt;.<p>Two</article><div class=ad>Buy. Now.</div><footer>x</footer>", "Ti\nOne <b>.\nTwo"),
        (
            "<body><div id=cookie-banner><p>We use cookies. Accept.</p></div><main><h1>Title</h1><p>Text one is here.</p>"
            "<aside class=sidebar><p>Related is here.</p></aside><script>var a='</p>';</script><p>Text two.</p></main>"
            "<section id=comments><p>User says hello. Nice.</p></section></body>",
            "Title\nText one is here.\nText two.",
        ),
        ("<body><article><p>cut off <b", "cut off"),
    ],
)
def test_main_text(html, text):
    assert main_text.extract(html, main_text.train(list(main_text.labelled_pages()))) == text


@pytest.mark.parametrize("before", ["<svg>", "<template>", "<noscript>", "<div><SVG class=x></div>", "<svg><path d='m'/>", "İ<SCRIPT>var a;</script>"])
def test_an_unclosed_element_takes_nothing_with_it(before):
    from daymark.llm.dom import parse

    article = "<article><p>Text one.</p><svg><text>in</text></svg><noscript><p>no</p></NoScript ><p>Text two.</p></article><svg/>"
    _, pieces = parse(f"<body>{before}{article}<template><template>x</template>y</template></body>")
    assert [t for _, t in pieces if t and t != "İ"] == ["Text one.", "Text two."]


def test_messages_equal_the_sum_over_all_labellings():
    nodes, pieces = main_text.parse("<body><div><p>One. Two.</p><a>x</a></div></body>")
    potentials = main_text.train(list(main_text.labelled_pages())[:30])
    seen = main_text.describe(nodes, pieces)
    n, total, on = len(nodes), 0.0, np.zeros(len(nodes))
    local = [np.exp(np.clip(sum(potentials.weights.get(f, 0.0) for f in s), -12, 12)) for s in seen]
    for bits in range(2**n):
        y = [bits >> k & 1 for k in range(n)]
        value = np.prod([local[k] if y[k] else 1.0 for k in range(n)])
        for k in range(1, n):
            edge = potentials.edges.get(main_text.relation(nodes, nodes[k]), [1.0] * 4)
            value *= edge[2 * y[nodes[k].parent] + y[k]]
        total += value
        on += value * np.array(y)
    assert np.allclose(potentials.marginals(nodes, seen), on / total, atol=1e-6)


# --- 1: mixing --------------------------------------------------------------


def test_rates_reach_the_targets(spark):
    rows = [(k, "junk | mark | " * 20 if k % 3 == 0 else "plain words make up this text " * 6) for k in range(150)]
    labelled = spark.createDataFrame([(k, "poor" if k % 3 == 0 else "sound") for k in range(150)], "doc_id long, domain string")
    mixed = mixing.mix(docs_of(spark, rows + ODD, extra=True), labelled, {"sound": 0.8, "poor": 0.2}, keep=["doc_id"]).collect()
    assert len(mixed) == len(rows) + len(ODD) and all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in mixed)
    total = sum(r.n_tokens for r in mixed)
    for k, share in enumerate((0.2, 0.8)):
        assert abs(sum(r.rate * r.n_tokens * r.p[k] for r in mixed) / total - share) < 0.01
    assert mixing.mix(docs_of(spark, []), labelled, {"sound": 1.0, "poor": 0.0}).count() == 0


# --- shared: batches, executors ---------------------------------------------


def test_slices_are_bounded_by_rows_and_bytes(monkeypatch):
    monkeypatch.setattr(batches, "SLICE_ROWS", 4)
    monkeypatch.setattr(batches, "SLICE_BYTES", 10)
    texts = ["x" * n for n in (3, 3, 3, 3, 50, 0, 0, 0, 0, 0, 1, 10)] + [None]
    rows = pa.StructArray.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["k", "text"])
    cut = [s.field("text").to_pylist() for s in batches.slices(rows)]
    assert [t for part in cut for t in part] == texts
    assert all(len(part) <= 4 and (len(part) == 1 or sum(len(t or "") for t in part) <= 10) for part in cut)
    assert list(batches.slices(rows.slice(0, 0))) == []
    assert [s.field("k").to_pylist() for s in batches.slices(rows.slice(4, 2))] == [[4], [5]]


def test_python_gets_long_texts_in_small_batches(spark):
    """One partition of 24 MB of text: Spark's own batch of it would be held whole by executor and worker."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    texts = lambda session: session.range(0, 240, 1, 1).select("id", F.repeat(F.lit("abcdefghij"), 10_000).alias("text"))

    def start():
        # A slice shares the buffers of the whole batch that it was cut from.
        return lambda rows: [pa.array([rows.field("text").buffers()[2].size] * len(rows), pa.int64())]

    own = spark.newSession()
    seen = batches.extend(texts(own), start, "size long", ["id"]).agg(F.count("*"), F.max("size")).first()
    assert seen[0] == 240
    assert seen[1] < 3 * batches.SLICE_BYTES

    given = spark.newSession()
    given.conf.set(setting, "1m")
    batches.extend(texts(given), start, "size long", ["id"])
    assert given.conf.get(setting) == "1m"



def test_operators_run_on_executors_without_the_package(tmp_path):
    """The workers' own path does not hold the package: all they know comes with the tasks."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = tmp_path / "bare.py"
    script.write_text(
        f"""
import sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
def lacks(rows):
    try:
        import daymark
    except ModuleNotFoundError:
        return [1]
    return [0]
assert spark.sparkContext.parallelize([1], 1).mapPartitions(lacks).collect() == [1]
sys.path.insert(0, {root!r})
from daymark.llm.queries import QUERIES
for name in ("op1_mixing", "op3_toxicity", "op5_language", "op9_main_text", "op10_decontaminate", "op11_simhash", "op12_variants", "op13_collocations"):
    QUERIES[name](spark, {SF!r}).write.format("noop").mode("overwrite").save()
    print("done", name)
"""
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert ran.returncode == 0 and ran.stdout.count("done") == 8, ran.stderr[-3000:]


# --- registration -----------------------------------------------------------


def test_every_operator_is_registered():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    from checks.compare import canonical, oracle

    df = QUERIES[name](spark, SF)
    cursor = oracle(SF).execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(df.columns, df.collect()) == canonical(columns, cursor.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = step(spark, docs, SF)
        assert after.columns == docs.columns and after.count() <= docs.count()
        docs = corpus_pipeline.stage(after, name)
    assert decontaminate.contamination_report(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.where("copies < 1").count() == 0 and last.count() > 0
