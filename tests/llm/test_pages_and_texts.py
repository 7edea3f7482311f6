"""Cases that earlier versions of the page, archive, toxicity and decontamination operators got wrong."""

import re
import time
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.llm import decontaminate, dom, fuzzy, main_text, mixing, toxicity, warc

TEXT = "The quick brown fox jumps over the lazy dog in the park. "
NAV = "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>About us</a></li></ul></nav>"
FOOT = "<footer>&copy; 2020 Some Corp</footer>"
LINE = TEXT.strip()

PAGES = {
    "a paragraph that is a link": (
        "<article><p>Hello there.</p><p>Text. Two.</p><p><a href=a>all of it</a></p></article>",
        ["Hello there.", "Text. Two.", "all of it"],
    ),
    "nested divs": (f"<div><div><div>{TEXT}</div><div>{TEXT * 2}</div></div><div><div>{TEXT}</div></div></div>", [LINE, f"{LINE} {LINE}", LINE]),
    "lines in a div": (f"<div>{'<br><br>'.join([TEXT * 3] * 6)}</div>", [" ".join([LINE] * 18)]),
    "lone quotes": (
        "<article><p data-x=it's>Hello there my friend.</p><p title=\"5\" inch\">Second text here now.</p>"
        "<p><a href=/it's>x</a> and more text follows.</p></article>",
        ["Hello there my friend.", "Second text here now.", "x and more text follows."],
    ),
    "its own header": (f"<article><header><h1>The Title Of It</h1></header><p>{TEXT}</p></article>", ["The Title Of It", LINE]),
    "laid out as a table": (
        f"<table><tr><td><a href=1>Home</a><br><a href=2>News</a></td><td><p>{TEXT * 3}</p><p>{TEXT * 2}</p></td></tr></table>",
        [" ".join([LINE] * 3), " ".join([LINE] * 2)],
    ),
    "an unclosed svg": (f"<svg><path d='x'><article><p>{TEXT}</p></article>", [LINE]),
}


def test_main_text_of_pages_of_many_kinds(spark):
    rows = [(k, name, f"<html><body>{NAV}{page}{FOOT}</body></html>") for k, (name, (page, _)) in enumerate(PAGES.items())]
    rows += [(50, "null", None), (51, "empty", ""), (52, "again", rows[0][2]), (52, "again", rows[0][2]), (None, "no id", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("mine")).withColumn("row", F.lit(1))
    got = {r.row.url: r.text for r in main_text.main_text(pages).collect()}
    assert {name: got[name] for name in PAGES} == {name: "\n".join(lines) for name, (_, lines) in PAGES.items()}
    assert got["null"] == got["empty"] == "" and got["again"] == got["no id"] == got["a paragraph that is a link"]
    report = main_text.text_report(pages)
    assert report.count() == len(rows) and report.where("n_chars <> length(text)").count() == 0
    assert main_text.text_report(pages.where("false")).count() == 0


def test_a_very_long_page_keeps_all_its_text(spark):
    page = f"<html><body>{NAV}<article>{''.join(f'<p>{TEXT}{k}.</p>' for k in range(20000))}</article>{FOOT}</body></html>"
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    lines = main_text.main_text(pages).first().text.split("\n")
    assert lines == [f"{LINE} {k}." for k in range(20000)]


def test_stray_end_tags_cost_no_more_than_others():
    start = time.process_time()
    nodes, _ = dom.parse("<div>" * 8000 + "x" + "</b>" * 8000 + "</div>" * 8000)
    assert len(nodes) == 8001 and time.process_time() - start < 1


# --- 4: archives ------------------------------------------------------------


def test_archives_survive_a_limit_of_rows_in_a_file(spark, tmp_path):
    rows = [(k, f"http://x/{k}", "text " * 50 * k) for k in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "2")
    try:
        warc.write_archives(pages, str(tmp_path / "a"), chunk=100)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    read = warc.read_archives(spark, str(tmp_path / "a")).collect()
    assert sorted(r.payload_bytes for r in read) == [250 * k for k in range(12)] and all(r.sound for r in read)


# --- 3: context -------------------------------------------------------------


def test_a_hit_is_judged_where_it_stands():
    finder = toxicity.Finder([fuzzy.Term("scum", False)])
    _, hits = finder.hits('Here "scummery" is a name, fine as it goes and goes, as ever so often in all of these texts; then scum here')
    assert [(edits, factor) for _, edits, factor in hits] == [(0, 1.0)]
    _, hits = finder.hits('Someone had it painted there in large letters, "scum" it was, and nobody ever cleaned that wall again')
    assert [factor for *_, factor in hits] == [toxicity.QUOTED]


# --- 10: blocks -------------------------------------------------------------


def test_a_long_item_is_cut_without_losing_a_window(spark, monkeypatch):
    words = [f"w{k}" for k in range(400)]
    docs = spark.createDataFrame([(k, " ".join(words[k : k + 10])) for k in range(391)] + [(999, " ".join(words[::2]))], "doc_id long, text string")
    benchmark = spark.createDataFrame([("i", " ".join(words)), ("j", "w1 w2")], "item_id string, text string")
    held = []
    block = decontaminate._blocks

    def watched(*args):
        number, blocks = block(*args)
        return number, (held.append(len(b)) or b for b in blocks)

    monkeypatch.setattr(decontaminate, "_blocks", watched)
    got = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.contamination_report(docs, benchmark).collect()}
    cut = {r.row.doc_id: r for r in decontaminate.find_contamination(docs, benchmark, ["doc_id"], block_chars=300).collect()}
    assert len(held) > 5
    assert all(got[k] == (10, 1 + (k in (0, 1))) for k in range(391)) and got[999] == (0, 0)
    for k, (hits, items) in got.items():
        assert sum(s.end - s.start for s in cut[k].spans) == hits and len(cut[k].items) == items


# --- 1: targets -------------------------------------------------------------


def projected_least_squares(p, n, targets, rounds=20000):
    """Nonnegative rates near one whose totals are nearest to the targets, on the dense matrix."""
    size = (p * n[:, None]).sum(axis=0)
    rates = np.ones(len(n))
    for _ in range(rounds):
        miss = ((rates * n) @ p - targets) / size
        rates = np.maximum(0, rates - 0.2 * p @ miss)
    return (rates * n) @ p


@pytest.mark.parametrize("wanted", [(0.5, 0.5), (0.9, 0.1), (0.99, 0.01)])
def test_fitted_totals_equal_projected_least_squares(spark, wanted):
    rng = np.random.default_rng(1)
    first = np.round(rng.uniform(0.05, 0.95, 60), 6)
    p, n = np.stack([first, np.round(1 - first, 6)], axis=1), rng.integers(1, 50, 60)
    targets = np.array(wanted) * n.sum()
    rows = spark.createDataFrame([(int(k), x.tolist()) for k, x in zip(n, p)], "n long, p array<double>")
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        misses = mixing.fit_rates(rows, targets)
    totals = (mixing.replay(p, misses)[0] * n) @ p
    best = projected_least_squares(p, n, targets)
    out_of_reach = np.abs(best - targets).max() > 1e-3 * targets.sum()
    if not out_of_reach:
        assert np.abs(totals - targets).max() <= 2e-3 * targets.sum() or any("rounds" in str(w.message) for w in said)
    missed = np.abs(totals - targets).max() > mixing.CLOSE * targets.sum()
    assert missed == any(re.search("shares are", str(w.message)) for w in said)


def test_the_shares_reached_are_told(spark):
    rows = [(10, 2.0, [0.25, 0.75]), (30, 1.0, [1.0, 0.0])]
    mixed = spark.createDataFrame(rows, "n_tokens long, rate double, p array<double>")
    got = {r.domain: (r.tokens, r.share) for r in mixing.reached(mixed, ["b", "a"]).collect()}
    assert got == {"a": (35.0, 0.7), "b": (15.0, 0.3)}
    assert {r.share for r in mixing.reached(mixed.where("false"), ["a", "b"]).collect()} == {None}
