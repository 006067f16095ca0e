"""Vector codes, hard negatives and URL filters: brute force, planted links, and the defined edge cases."""

import hashlib
import random

import numpy as np
import pytest

from tests.oracle_compare import _rows, duck
from tripgate.llm import negatives, queries, url_filter, vector_codes
from tripgate.llm.url_filter import Rule

VECTORS = "vec_id long, embedding array<float>, label int, v string, _row int, code int, id string"


def vectors(spark, rows):
    """Rows with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], VECTORS)


# ---- vector codes ----------------------------------------------------------------------------

def plain_codes(x: np.ndarray, parts: int, entries: int, rounds: int):
    """Every part against every entry, in Python integers."""
    width = x.shape[1] // parts
    books = [[list(map(int, r[p * width:(p + 1) * width])) for r in x[:entries]] for p in range(parts)]
    nearest = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book))
    cut = [[list(map(int, r[p * width:(p + 1) * width])) for r in x] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            got = [nearest(v, books[p])[1] for v in cut[p]]
            for e in range(len(books[p])):
                mine = [v for v, g in zip(cut[p], got) if g == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    final = [[nearest(v, books[p]) for v in cut[p]] for p in range(parts)]
    return ([bytes(final[p][i][1] for p in range(parts)) for i in range(len(x))],
            [sum(final[p][i][0] for p in range(parts)) for i in range(len(x))],
            hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest())


@pytest.mark.parametrize("scale,spread", [(4, 1.0), (1024, 1.0), (1024, 9e3)])
def test_codes_equal_brute_force(spark, scale, spread):
    rng = np.random.default_rng(5)
    # coarse values: many ties, equal rows and entries without parts
    x = np.round(rng.normal(size=(90, 8)) * 2).astype(np.float32) / 4 * np.float32(spread)
    x[40:60] = x[3]
    rows = [(i, [float(c) for c in r], i % 3 or None) for i, r in enumerate(x)]
    out = {r.vec_id: r for r in vector_codes.encode(vectors(spark, rows).repartition(5), scale=scale, entries=32, rounds=3).collect()}
    codes, errors, digest = plain_codes(np.floor(x.astype(np.float64) * scale), 4, 32, 3)
    assert [bytes(out[i].code) for i in range(90)] == codes
    assert [out[i].error for i in range(90)] == errors
    assert {out[i].codebooks_sha256 for i in out} == {digest}
    assert out[3].label_error == sum(errors[0::3]) and out[1].label_error == sum(errors[1::3])


def test_untouched_parts_compare_moved_entries_only():
    rng = np.random.default_rng(7)
    for _ in range(200):
        x, old = rng.integers(-2, 3, (40, 2)), rng.integers(-2, 3, (6, 2))
        new = old.copy()
        moved = rng.random(6) < 0.4
        new[moved] += rng.integers(-1, 2, (int(moved.sum()), 2))
        got = vector_codes.reassign(x, new, moved, *vector_codes.nearest(x, old))
        assert all((a == b).all() for a, b in zip(got, vector_codes.nearest(x, new)))


def test_codes_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [1.0, None, 0.0, 0.0], 1), (3, [nan, 0.0, 0.0, 0.0], 1), (4, [inf, 0.0, 0.0, 0.0], 1),
            (5, [0.5, 0.0, 0.0, 0.0], None), (5, [0.5, 0.0, 0.0, 0.0], None), (None, [9e30, 0.0, 0.0, -9e30], 2),
            (7, [0.5] * 6, 1), (8, [], 1), (9, [1.0, 1.0, 1.0, 1.0, 1.0, 1.0], None)]
    out = sorted(vector_codes.encode(vectors(spark, rows)).collect(), key=lambda r: (r.vec_id is None, r.vec_id or 0))
    assert [r.vec_id for r in out] == [5, 5, 7, 8, 9, None]
    assert [len(r.code) for r in out] == [4] * 6
    assert out[0] == out[1] and out[3].length == 0 and out[3].error == 0
    assert all(r.error == 0 for r in out)  # fewer rows than entries: each is an entry
    assert vector_codes.encode(vectors(spark, rows[:4])).collect() == []
    assert vector_codes.encode(vectors(spark, [])).columns == ["vec_id", "label", "code", "error", "label_error", "length", "codebooks_sha256"]


def test_lengths_beyond_the_book_limit_take_turns(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BOOK_BYTES", 1)
    rows = [(i, [float(i % 7)] * (4 + 4 * (i % 3)), i % 2) for i in range(60)]
    turns = {(r.vec_id, bytes(r.code), r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.encode(vectors(spark, rows), entries=3).collect()}
    monkeypatch.undo()
    whole = {(r.vec_id, bytes(r.code), r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.encode(vectors(spark, rows), entries=3).collect()}
    assert turns == whole and len(whole) == 60


# ---- hard negatives --------------------------------------------------------------------------

def plain_negatives(rows, is_anchor, scale, low=50, high=95):
    kept = [(n, i, [max(-negatives.LIMIT, min(negatives.LIMIT, int(np.floor(c * scale)))) for c in v], label) for n, (i, v, label) in enumerate(rows)
            if label is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for n, i, v, label in kept:
        if i is None or not is_anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, m, other) for m, j, w, other in kept if m != n and len(w) == len(v))
        for s, no, j, _, _ in [x for x in scored if x[4] == label][:5]:
            fits = [x for x in scored if x[4] != label and low * -s <= 100 * -x[0] <= high * -s][:3]
            out += [(i, None if no else j, r + 1, None if x[1] else x[2], -s, -x[0]) for r, x in enumerate(fits)]
    return sorted(out, key=str)


def mined(df, is_anchor="vec_id % 5 = 0", **options):
    from pyspark.sql import functions as F

    return sorted((tuple(r) for r in negatives.mine(df, F.expr(is_anchor), **options).collect()), key=str)


@pytest.mark.parametrize("length,scale,block", [(6, 4, 8 << 20), (150, 256, 8 << 20), (6, 4, 400)])
def test_negatives_equal_brute_force(spark, monkeypatch, length, scale, block):
    monkeypatch.setattr(negatives, "BLOCK_BYTES", block)
    monkeypatch.setattr(negatives, "TILE", 50)
    rng = np.random.default_rng(11)
    x = np.abs(rng.normal(size=(120, length))).round(1 if scale == 256 else 0).astype(np.float32)
    rows = [(i, [float(c) for c in r], int(rng.integers(3))) for i, r in enumerate(x)]
    rows += [(7, rows[7][1], rows[7][2]), (0, rows[0][1], rows[0][2]), (None, rows[3][1], 1), (201, None, 1), (202, rows[2][1], None),
             (205, [float("nan")] * length, 1), (210, [None] * length, 2), (215, [1.0, 2.0], 1), (216, [1.0, 1.0], 1), (217, [1.0, 1.5], 0), (220, [], 2)]
    got = mined(vectors(spark, rows).repartition(4), scale=scale)
    assert got == plain_negatives(rows, lambda i: i % 5 == 0, scale) and len(got) > 100


def test_scores_are_exact_for_large_components():
    rng = np.random.default_rng(3)
    a, b = rng.integers(-negatives.LIMIT, negatives.LIMIT + 1, (20, 700)), rng.integers(-negatives.LIMIT, negatives.LIMIT + 1, (30, 700))
    bound = int(max((a * a).sum(1).max(), (b * b).sum(1).max()))
    primes = negatives.primes_for(bound)
    assert np.prod(primes, dtype=object) > 2 * bound and len(set(primes)) == len(primes) > 4
    got = negatives.scores([negatives.residues(a, p) for p in primes], [negatives.residues(b, p) for p in primes], primes)
    assert (got == a @ b.T).all() and got.min() < 0


def test_negatives_without_anchors_or_rows(spark):
    assert mined(vectors(spark, [])) == []
    assert mined(vectors(spark, [(1, [1.0], 0), (2, [1.0], 1)])) == []
    assert mined(vectors(spark, [(5, [1.0], 0), (6, [1.0], 1)])) == []


# ---- URL filters -----------------------------------------------------------------------------

RULES = [Rule("org", "/", "allow"), Rule("bad.org", "/x", "block"), Rule("shop.example", "/", "block")]
PAGES = "page_id long, url string, html string, host int, rule int, _node string, u long"


def link(url):
    return f'<html><head><link rel="canonical" href="{url}"></head></html>'


def pages(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, "", 1) for r in rows], PAGES)


def test_aliases_take_block_decisions(spark):
    rows = [
        (1, "http://a.example/1", link("https://b.example/2")), (2, "https://b.example/2", None),
        (3, "https://B.example/2#top", '<meta http-equiv=refresh content="0; URL=http://www.shop.example/x">'),  # the class of 1 and 2
        (4, "http://c.org/4", link("http://shop.example/4")),  # allowed by its own rule
        (5, "http://d.example/5", link("http://c.org/4")),  # an alias of a blocked url through an allowed one
        (6, "http://e.example/6", "<!-- " + link("http://shop.example/6") + " -->"), (7, "http://e.example/7", "<script>" + link("http://shop.example/7")),
        (8, "http://bad.org/x/1", ""), (9, "http://bad.org/y", ""), (10, "http://notbad.org/x", ""), (11, "http://w.bad.org/x", ""),
        (12, "http://f.example/a/b?q=1", "<LINK HREF='../c' data-rel=canonical>"), (13, "http://f.example/a/d", '<link href=e rel="nofollow CANONICAL">'),
        (14, "http://f.example/a/e", '<link rel=canonical href="//shop.example/">'), (15, "HTTP://g.example", link("/")), (16, "http://g.example/", link("?p=1&amp;q")),
        (17, "http://g.example/?p=1&q", link("mailto:x@shop.example")), (18, None, link("http://shop.example/")), (19, "shop.example/1", None),
        (20, "http://shop.example", None), (21, "", ""), (22, "http://h.example/" + "y" * 50_000, "<link " * 5_000), (2, "https://b.example/2", None),
        (23, "http://x.example?u=http://shop.example/", None),
    ]
    judged = url_filter.judge(pages(spark, rows), RULES).collect()
    assert len(judged) == len(rows)
    got = {r.page_id: r for r in judged}
    blocked = {k for k, r in got.items() if r.verdict == "block"}
    assert blocked == {1, 2, 3, 5, 8, 11, 13, 14}
    assert {k: r.rule for k, r in got.items() if r.rule} == {4: "org/", 8: "bad.org/x", 9: "org/", 10: "org/", 11: "bad.org/x"}
    assert (got[3].host, got[3].path) == ("b.example", "/2") and (got[18].host, got[18].path, got[19].host) == ("", "", "")
    assert (got[20].host, got[20].path, got[23].host, got[23].path) == ("shop.example", "", "x.example", "")


def test_redirect_table_and_a_hub(spark):
    rows = [(i, f"http://s{i}.example/", link("http://hub.example/")) for i in range(300)] + [(300, "http://far.example/", None)]
    none = url_filter.judge(pages(spark, rows), RULES)
    assert none.where("verdict = 'block'").count() == 0
    chain = [("http://hub.example/", "http://h1.example/"), ("http://h1.example/", "http://shop.example/z"), (None, "http://far.example/"), ("x", None)]
    redirects = spark.createDataFrame(chain, "url string, target string")
    assert {r.page_id for r in url_filter.judge(pages(spark, rows), RULES, redirects).where("verdict = 'block'").collect()} == set(range(300))


def test_url_query_on_linked_pages_equals_sql(spark, tmp_path):
    rng = random.Random(9)
    urls = [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(['a.', 'M.', ''])}{rng.choice(['example.com', 'Example.org', 'x.net'])}/{rng.choice(['en', 'de', 'fr', 'es'])}/{i}" for i in range(160)]
    forms = [link, lambda u: f'<meta http-equiv="Refresh" content="3;url={u}">', lambda u: f"<!-- {link(u)} -->", lambda u: link("/de/" + u[-1:]), lambda u: link("e" + u[-1:]),
             lambda u: "<p>none</p>", lambda u: f"<script>{link(u)}</script>"]
    rows = [(i, None if i % 40 == 7 else u + rng.choice(["", "#f", "?q=1"]), None if i % 40 == 9 else rng.choice(forms)(rng.choice(urls))) for i, u in enumerate(urls)]
    path = f"{tmp_path}/pages.parquet"
    spark.createDataFrame(rows, "page_id long, url string, html string").toPandas().to_parquet(path)
    got = queries.url_verdicts(spark, str(tmp_path))
    due = duck(str(tmp_path)).sql(queries.ORACLE_SQL["op13_url_filter"])
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(due.columns, due.fetchall())
    assert got.where("rule is null and verdict = 'block'").count() > 5


def test_no_pages(spark):
    assert url_filter.judge(pages(spark, []), RULES).collect() == []
    with pytest.raises(ValueError):
        url_filter.judge(pages(spark, []), [Rule(f"h{i}", "/", "block") for i in range(url_filter.MAX_RULES + 1)])
