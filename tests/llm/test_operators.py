"""The corpus operators against brute force, the library they follow, or an exact round trip, on small fixtures."""

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgate.llm import decontam, embedding, jaccard, mixing, pii, queries, secret_scan, sharding, tokens, toxicity, warc
from tripgate.llm.common import prefix_sums
from tripgate.llm.components import components
from tripgate.llm.wordhash import LETTERS, word_hashes

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, h int"


def docs_of(spark, rows):
    """(doc_id, text, source) with extra columns whose names clash with those the operators use."""
    return spark.createDataFrame([(i, t, "xx", s, 1, 0.5, "extra", 7) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def corpus():
    """Exact and near copies, repeated rows, nulls, empty, short and long texts."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)] + ["É", "straße"]
    rows = [(0, None, "a"), (1, "", "b"), (2, "  \t\n", None), (3, "One two", "a"), (4, "one  TWO", "a"), (5, "a b c d e", None)]
    base = [rng.choices(vocab, k=n) for n in (30, 60, 120, 300)]
    for i in range(6, 90):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((i, rng.choice([" ", "\n"]).join(words), f"s{i % 4}"))
    rows += [(90, " ".join(rng.choices(vocab, k=9000)), "s1"), (91, "x" * 50_000, "s2"), (6, rows[6][1], "s2"), (None, rows[7][1], "s0")]
    return rows


def sets_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def reached(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_jaccard_equals_brute_force(spark, corpus):
    got = jaccard.jaccard_components(docs_of(spark, corpus)).collect()
    assert len(got) == len(corpus)
    sets = {i: sets_of(t) for i, t, _ in corpus if i is not None}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = reached(ids, links)
    assert len(links) > 20
    for r in got:
        if r.doc_id is None:
            assert r.component_id == want[7]
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id])


def postings_met(spark, monkeypatch, docs):
    """The postings whose documents meet in the last join, and the pairs and cells that came of them."""
    seen = {}
    real = jaccard.meetings

    def watched(rows, percent):
        out = real(rows, percent)
        seen.update(postings=rows.count(), cells=jaccard.open_cells(rows, percent).count(), pairs=out.agg(F.sum("found")).first()[0] or 0)
        return out

    monkeypatch.setattr(jaccard, "meetings", watched)
    got = jaccard.jaccard_components(docs, long=20).collect()
    monkeypatch.undo()
    return seen, got


@pytest.mark.parametrize("own", [(18, 18), (5, 40)])
def test_template_documents_meet_no_more_than_they_must(spark, monkeypatch, own):
    """Documents that share a passage without being near copies: join rows don't grow with the square of their number."""
    rng = random.Random(8)
    shared = [f"s{i}" for i in range(100)]
    rows = [(i, " ".join(shared + [f"o{i}x{k}" for k in range(rng.randint(*own))]), "a") for i in range(400)]
    seen = {}
    for n in (100, 200, 400):
        seen[n], got = postings_met(spark, monkeypatch, docs_of(spark, rows[:n]))
        sets = [sets_of(t) for _, t, _ in rows[:n]]
        links = [(a, b) for a in range(n) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
        want = reached(range(n), links)
        assert {r.doc_id: r.component_id for r in got} == want
    assert seen[400]["pairs"] <= 4 * max(seen[200]["pairs"], 50) / 2 + 100 and seen[400]["pairs"] <= 400 * 4
    assert seen[400]["cells"] <= 4 * 400


def test_stretches_are_bounded_and_whole():
    import pyarrow as pa

    from tripgate.llm.wordhash import stretches

    texts = pa.array(["a" * n if n is not None else None for n in (0, 5, None, 30, 200, 0, 1, 1, 1, 99, 2)] + ["é"] * 600)
    cuts = list(stretches(texts, rows=100, size=50))
    assert cuts[0][0] == 0 and cuts[-1][1] == len(texts) and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    for i, j in cuts:
        size = sum(len((t or "").encode()) for t in texts.slice(i, j - i).to_pylist())
        assert 0 < j - i <= 100 and (size <= 50 or j == i + 1)
    assert list(stretches(texts.slice(3, 4), size=40)) == [(0, 1), (1, 2), (2, 4)] and list(stretches(pa.array([], pa.string()))) == []


def test_jaccard_of_an_empty_table(spark):
    assert jaccard.jaccard_components(docs_of(spark, [])).collect() == []


def test_components_of_a_path_a_hub_and_repeats(spark):
    rows = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(5, 5), (None, 3), (41, 40), (200, 201), (201, 200)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(rows, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(42), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200}


def test_word_hashes_part_words_at_blanks_and_texts():
    import pyarrow as pa

    texts = ["ab Ab\tcd", None, "", "cd", "é ab" + "\n" * 3, "x" * 3_000_000 + " ab"]
    count, h = word_hashes(pa.array(texts))
    assert count.tolist() == [3, 0, 0, 1, 2, 2]
    h = h[:, 0]
    assert h[0] == h[1] == h[5] == h[7] and h[2] == h[3] and len(set(h.tolist())) == 4
    assert word_hashes(pa.array(["a,b"]), LETTERS)[0].tolist() == [2]


def test_mix_meets_targets_and_repeats(spark, corpus):
    docs = docs_of(spark, corpus)
    got = mixing.plan_mix(docs, block_words=16, shard_slots=32).taken().collect()
    assert len(got) == len(corpus)
    sizes = Counter()
    for _, t, s in corpus:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    assert sum(mixing.targets([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))])) == pytest.approx(1.5 * sum(sizes.values()))
    for s in order:
        rows = [r for r in got if r.source == s]
        assert {r.source_size for r in rows} == {sizes[s]}
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 0.5 and rows[0].target <= 2 * sizes[s]
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    again = mixing.plan_mix(docs.repartition(3), block_words=16, shard_slots=32).taken().collect()
    assert sorted((r.doc_id or -1, r.size, r.taken) for r in got) == sorted((r.doc_id or -1, r.size, r.taken) for r in again)
    assert mixing.plan_mix(docs_of(spark, [])).taken().collect() == []


def test_mix_targets_reshare_the_excess():
    assert mixing.targets([10, 100], [1, 1]) == [20.0, 145.0]
    assert mixing.targets([0, 10], [3, 1]) == [0.0, 15.0]


def test_mix_texts_hold_the_words_taken(spark, corpus):
    plan = mixing.plan_mix(docs_of(spark, corpus), block_words=16, shard_slots=32, keep=["text"])
    texts = plan.texts().collect()
    assert all(r.n_words == len(r.text.split(" ")) <= 16 for r in texts)
    assert sum(r.n_words for r in texts) == sum(r.taken for r in plan.taken().collect())


def broadcast_rows(df):
    """Rows that each broadcast of the plan that ran has sent."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "BroadcastExchangeExec":
            found.append(node.metrics().apply("numOutputRows").value())
        inner = {"AdaptiveSparkPlanExec": "executedPlan", "ReusedExchangeExec": "child"}.get(name, "plan" if name.endswith("QueryStageExec") else None)
        children = node.children()
        todo += [getattr(node, inner)()] if inner else [children.apply(i) for i in range(children.size())]
    return found


def test_mix_sends_only_sources_through_the_driver(spark):
    # 20,000 words in blocks of 4; the counts that stand for the slots are a few kilobytes, far below Spark's threshold
    docs = docs_of(spark, [(i, " ".join(["w"] * 500), f"s{i % 3}") for i in range(40)])
    plan = mixing.plan_mix(docs, block_words=4, shard_slots=64)
    taken = plan.taken()
    assert sum(r.taken for r in taken.collect()) == 30_000
    assert plan.slots.count() >= 7500 and max(broadcast_rows(taken)) <= 3


def test_mix_is_the_same_if_the_sources_are_beyond_the_bound(spark, corpus, monkeypatch):
    def taken():
        df = mixing.plan_mix(docs_of(spark, corpus), block_words=16, shard_slots=32).taken()
        return sorted((r.doc_id or -1, r.source or "", r.size, r.target, r.taken) for r in df.collect()), broadcast_rows(df)

    sent, n = taken()
    assert n
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", 0)
    assert taken() == (sent, [])


def test_prefix_sums_broadcast_nothing(spark):
    def many(batches):
        for b in batches:
            yield b.loc[b.index.repeat(100)].reset_index(drop=True)

    rows = spark.range(200).mapInPandas(many, "id long").selectExpr("id % 2 AS g", "id % 5 AS b", "id", "1L AS n")
    sums = prefix_sums(rows, "g", "b", [F.col("id")], "n", "before")
    assert sorted(r.before for r in sums.collect() if r.g == 1) == list(range(10_000))
    assert broadcast_rows(sums) == []


def test_permutation_is_one():
    for n in (1, 2, 7, 64, 1000):
        assert sorted(mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 9, dtype=np.uint64)).tolist()) == list(range(n))


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 16)).astype(np.float32)
    for i in range(100, 200):
        x[i] = x[i % 20] + rng.normal(size=16).astype(np.float32) * rng.choice([0, 0.05, 0.1])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [
        (300, None), (301, [0.0] * 16), (302, [math.nan] * 16), (303, [None] * 16), (304, [1.0, 2.0]), (305, [math.inf] * 16), (None, x[0].tolist()), (306, (x[1] * 2).tolist())]
    got = embedding.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(got) == len(rows)
    x = np.concatenate([x, x[1:2] * 2]).astype(float)
    ids = [*range(300), 306]
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    link = unit @ unit.T >= 0.9
    np.fill_diagonal(link, False)
    want = reached(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(link), strict=True)])
    found = sum(r.n_links for r in got)
    assert 0.9 * link.sum() <= found <= link.sum()
    by = {r.vec_id: r for r in got}
    assert all(by[i].n_links <= n for i, n in zip(ids, link.sum(1), strict=True))
    assert sum(by[i].component_id == want[i] for i in ids) >= 0.95 * len(ids)
    assert all(by[i].n_links == 0 and by[i].component_id == i and by[i].kept for i in range(300, 306))
    assert by[None].component_id is None and not by[None].kept


def test_embeddings_of_other_lengths_link_with_their_own(spark):
    rng = np.random.default_rng(12)
    rows = [(i, [float(c) for c in rng.normal(size=3)]) for i in range(6)] + [(20, [1.0, 0.3]), (21, [1.0, 0.3]), (22, [2.0, 0.61]), (23, [-1.0, 0.0]), (30, [2.0]), (31, [5.0]), (32, [-5.0])]
    base = rng.normal(size=(20, 12))
    rows += [(100 + i, [float(c) for c in base[i % 20] + rng.normal(size=12) * 0.1]) for i in range(120)]
    rows += [(300, [float("nan"), 1.0]), (301, [0.0, 0.0]), (302, None), (303, []), (None, [1.0, 0.3])]
    got = {r.vec_id: r for r in embedding.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows[:-5]]
    links = [(a, b) for a, x in good for b, y in good if a < b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9]
    want = reached([i for i, _ in good], links)
    count = Counter(i for pair in links for i in pair)
    assert {i: (got[i].n_links, got[i].component_id) for i, _ in good} == {i: (count[i], want[i]) for i, _ in good}
    assert got[20].n_links == 2 and got[30].component_id == 30 and got[31].component_id == 30
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in (300, 301, 302, 303)) and got[None].component_id is None


def test_embeddings_of_an_empty_table(spark):
    assert embedding.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_decontamination_finds_planted_items(spark):
    rng = random.Random(1)
    vocab = [f"v{i}" for i in range(500)]
    items = [(k, " ".join(rng.choices(vocab, k=n))) for k, n in enumerate((12, 25, 40, 60))] + [(8, None), (9, ""), (10, "just three words")]
    fill = lambda n: " ".join(rng.choices(vocab, k=n))
    near = items[3][1].split()
    near[20] = "changed"
    rows = [(0, fill(200), "s"), (1, fill(50) + " " + items[1][1].upper() + "\n" + fill(30), "s"), (2, items[2][1], "s"), (3, fill(9) + " " + " ".join(near), "s"),
            (4, None, "s"), (5, "", "s"), (6, "Just three words", "s"), (7, "here just three words again", "s"), (2, items[2][1], "s"), (11, " ".join(items[3][1].split()[:30]), "s")]
    got = decontam.contamination(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {(1, 1): 1.0, (2, 2): 1.0, (3, 3): 51 / 61, (6, 10): 1.0}
    assert {(r.doc_id, r.item_id): pytest.approx(r.similarity) for r in got} == want
    assert next(r.window_start for r in got if r.doc_id == 1) == 50


def test_decontamination_equals_brute_force_over_all_starts(spark):
    rng = random.Random(12)
    a, b = [f"a{i}" for i in range(30)], [f"b{i}" for i in range(30)]
    vocab = [f"v{i}" for i in range(60)]
    items = [(0, a + b), (1, rng.choices(vocab, k=24)), (2, (a[:12] + b[:12]) * 2), (3, rng.choices(vocab, k=80))]
    fill = lambda n: [f"f{rng.randrange(10_000)}" for _ in range(n)]
    texts = [fill(100) + b + a + fill(100), b + a, a[:28] + b, fill(3) + (b[:12] + a[:12]) * 2 + fill(5)]
    for _ in range(40):
        words = list(rng.choice(items)[1])
        cut = rng.randrange(len(words))
        words = words[cut:] + words[:cut] if rng.random() < 0.7 else words
        if rng.random() < 0.3:
            words[rng.randrange(len(words))] = "changed"
        texts.append(fill(rng.randrange(30)) + words + words[:rng.randrange(20)] + fill(rng.randrange(30)))
    cuts = lambda w: [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    want = {}
    for d, text in enumerate(texts):
        for i, item in items:
            whole, own = cuts(text), Counter(cuts(item))
            n = sum(own.values())
            for start in range(max(0, len(whole) - n) + 1):
                window = Counter(whole[start:start + n])
                both = (window & own).total()
                s = both / (window.total() + n - both)
                if s >= 0.8 and s > want.get((d, i), (0, 0))[0]:
                    want[d, i] = s, start
    got = decontam.contamination(docs_of(spark, [(d, " ".join(t), "s") for d, t in enumerate(texts)]),
                                 spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")).collect()
    assert want[0, 0][0] == pytest.approx(52 / 60) and len(want) > 20
    assert {(r.doc_id, r.item_id): (pytest.approx(r.similarity), r.window_start) for r in got} == want


def test_fingerprints_and_similarities_by_hand(spark):
    rng = random.Random(21)
    lists = [[rng.choice([rng.getrandbits(64) - (1 << 63), 5, -7]) for _ in range(n)] for n in (1, 2, 3, 40, 333, 70_000)] + [[-1] * 40_000, [1 << 62] * 3]
    df = spark.createDataFrame([(i, x, lists[(i + 1) % 5][:50]) for i, x in enumerate(lists)], "i int, a array<bigint>, b array<bigint>")
    for r in df.select("i", "b", decontam.simhash(F.col("a")).alias("print"), decontam.similarity(F.slice("a", 1, 60), F.col("b")).alias("s")).collect():
        x = lists[r.i]
        votes = [sum(h >> k & 1 for h in x) for k in range(64)]
        want = sum(1 << k for k in range(64) if 2 * votes[k] > len(x))
        assert r.print % (1 << 64) == want
        one, two = Counter(x[:60]), Counter(r.b)
        assert r.s == pytest.approx((one & two).total() / (one | two).total())


def test_blocks_find_every_fingerprint_within_the_radius(spark):
    """Each pair within the radius comes once; the index alone, without shingles to guide it."""
    rng = random.Random(22)
    prints = [rng.getrandbits(64) for _ in range(12)]
    asked = []
    for k, n in enumerate((0, 1, 4, 5, 12, 19, 19, 19, 19, 19, 20, 24)):
        flipped = prints[k]
        for bit in (rng.sample(range(64), n) if k != 8 else range(19)):  # all in the lowest blocks
            flipped ^= 1 << bit
        asked.append(flipped)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    items = spark.createDataFrame([(i, signed(p)) for i, p in enumerate(prints)], "item_id int, item_print bigint").selectExpr(
        "*", "array(1L) AS item", "1 AS least", "1 AS most")
    probes = spark.createDataFrame([(i, signed(p)) for i, p in enumerate(asked)], "q int, print bigint").select("*", F.explode(decontam._keys(F.col("print"))).alias("k")).select("q", "print", "k.*")
    difference = F.col("print").bitwiseXOR(F.col("item_print"))
    met = decontam._filed(items, decontam.RADIUS).join(probes, ["block", "value"]).where(decontam._first_block(difference, decontam.RADIUS) == F.col("block"))
    got = Counter((r.q, r.item_id) for r in met.select("q", "item_id").collect())
    assert set(got.values()) == {1}
    assert {(q, i) for q, a in enumerate(asked) for i, p in enumerate(prints) if (a ^ p).bit_count() <= decontam.RADIUS} <= set(got)
    assert {(k, k) for k in range(10)} <= set(got)


def test_a_window_meets_all_items_of_its_width(spark):
    rng = random.Random(23)
    one = [f"w{i}" for i in range(40)]
    two = list(one)
    two[20] = "other"
    other = [f"x{i}" for i in range(40)]
    docs = docs_of(spark, [(1, " ".join(["a", "b"] + one + ["c"] * 9), "s"), (2, " ".join(one[:34]), "s"), (3, " ".join(rng.choices(one, k=60)), "s")])
    items = spark.createDataFrame([(0, " ".join(one)), (1, " ".join(two)), (2, " ".join(other)), (3, " ".join(one[:34]))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.contamination(docs, items).collect()}
    assert got == {(1, 0): 1.0, (1, 3): 1.0, (2, 0): pytest.approx(30 / 36), (2, 3): 1.0}


def test_shards_fit_and_follow_the_rule(spark, corpus):
    got = sharding.shard(docs_of(spark, corpus), limit=4000).collect()
    assert len(got) == len(corpus)
    sums, n = Counter(), Counter()
    for r in got:
        sums[r.shard] += r.n_bytes
        n[r.shard] += 1
    assert all(s <= 4000 or n[k] == 1 for k, s in sums.items()) and all(r.shard_bytes == sums[r.shard] and r.depth == len(r.shard) for r in got)
    assert all(not a.startswith(b) for a in sums for b in sums if a != b)
    assert sum(r.n_bytes for r in got) == sum(len((t or "").encode()) for _, t, _ in corpus)
    assert sharding.shard(docs_of(spark, [])).collect() == []


def test_shards_part_one_hot_id(spark):
    got = sharding.shard(docs_of(spark, [(7, "x" * 100, "s")] * 300), limit=2000).groupBy("shard").agg(F.sum("n_bytes").alias("b")).collect()
    assert sum(r.b for r in got) == 30_000 and max(r.b for r in got) <= 2000


def test_warc_round_trip(spark, scratch):
    big = "é<p>\r\n\r\nWARC/1.1\r\n" * 20_000
    rows = [(1, "http://a/ü x\r\n", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", big), (6, "u", "x"), (6, "u", "x"), (None, "u", "same"), (9, "u", "y")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    manifest = warc.write_archives(pages, scratch + "-warc")
    chunks = warc.read_archives(manifest, scratch + "-warc").collect()
    payload = {}
    for c in sorted(chunks, key=lambda c: c.chunk_no):
        payload[c.record_id] = payload.get(c.record_id, b"") + bytes(c.chunk)
    last = [c for c in chunks if c.last]
    assert len(last) == len(rows) and max(len(c.chunk) for c in chunks) <= warc.CHUNK
    for c in last:
        if c.record_type == "response":
            assert warc.base32(hashlib.sha1(payload[c.record_id]).digest()) == c.payload_digest and len(payload[c.record_id]) == c.payload_bytes
    assert payload[next(c.record_id for c in last if c.id == 5)] == big.encode()
    kinds = sorted((c.id or 0, c.record_type, c.refers_to) for c in last)
    assert kinds == [(0, "revisit", 2), (1, "revisit", 2), (2, "response", None), (3, "revisit", 4), (4, "response", None), (5, "response", None),
                     (6, "response", None), (6, "revisit", 6), (9, "response", None)]
    assert warc.round_trip(pages.limit(0)).collect() == []


@pytest.fixture(scope="module")
def vocabulary():
    return open(queries.vocabulary(), encoding="utf-8").read()


TEXTS = [None, "", "  ", "Hello world's <|endoftext|> it's 're 12³ ½", "İstanbul ΣΑΣ ﬁ é 日本語🙂", "a\x1cb\x85c​", "straße" * 500, "!?...---''s", "<|startoftext|"]


def test_token_counts_equal_the_library(spark, vocabulary):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(vocabulary)
    texts = TEXTS + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs = docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)])
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    plain = tokens.count_tokens(docs, queries.vocabulary()).collect()
    assert {r.doc_id: r.n_tokens for r in plain} == want
    assert all(r.over_limit == (want[r.doc_id] > 2048) and r.n_bytes == len((texts[r.doc_id] or "").encode()) for r in plain)
    stored = tokens.count_tokens(docs.where("doc_id < 40"), queries.vocabulary(), prefixes=True).collect()
    assert {r.doc_id: r.n_tokens for r in stored} == {i: want[i] for i in range(40)}
    for r in stored:
        for end, n in list(zip(r.prefix_end, r.prefix_tokens, strict=True))[:20]:
            if r.doc_id not in (3, 4):
                assert n == len(library.encode(texts[r.doc_id][:end], add_special_tokens=False).ids)


def test_truncation_by_prefix_tables(spark, vocabulary):
    from tokenizers import Tokenizer

    library, counter = Tokenizer.from_str(vocabulary), tokens.PrefixCounter(vocabulary)
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(12).collect():
        text = row.text[:160]
        sizes = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        for budget in (0, 1, 7, 23, 500):
            got = counter.truncated(text, budget)
            most = max(k for k, n in enumerate(sizes) if n <= budget)
            assert sizes[len(got)] <= budget and text[len(got):most].strip() == ""


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def test_pseudonyms_keep_format_validity_and_links(spark):
    values = {"email": "ann.b7@mail.example.com", "phone": "+1 (988) 555-2485", "ip": "42.144.35.254", "card": "4041 8949 7460 8795", "ssn": "123-45-6789", "date": "2020-02-29"}
    text = " and ".join(values.values())
    odd = "300.1.1.1 4041894974608796 31/02/2000 000-12-3456"
    rows = [(1, text, "s"), (2, "x " + text + ", " + odd, "s"), (3, None, "s"), (4, "", "s"), (1, text, "s"), (5, "plain words " * 2000, "s")]
    got = pii.pseudonymize(docs_of(spark, rows), "key").orderBy("doc_id").collect()
    assert got[0].text == got[1].text and got[2].text == "x " + got[0].text + ", " + odd
    new = dict(zip(values, got[0].text.split(" and "), strict=True))
    for kind, old in values.items():
        assert new[kind] != old and re.sub("[a-z]", "a", re.sub("[0-9]", "9", new[kind])).count("9") >= 1
        if kind != "ip":
            assert [c.isdigit() for c in new[kind]] == [c.isdigit() for c in old]
    assert luhn(new["card"]) and all(int(o) < 256 for o in new["ip"].split("."))
    assert got[3].text is None and got[4].text == "" and got[5].text == rows[5][1]
    assert [got[2][f"n_{k}"] for k in pii.KINDS] == [1] * 6 and got[3].n_ip == 0


def test_every_phone_number_is_renamed(spark):
    rng = random.Random(8)
    phones = ["+1 (017) 555-7713", "+1 (171) 555-2028", "+1 (000) 000-0000", "+1 (999) 199-9999"]
    phones += sorted({f"+1 ({rng.randrange(1000):03}) {rng.randrange(1000):03}-{rng.randrange(10000):04}" for _ in range(300)})
    rows = [(i, f"call {p}, or ({p})", "s") for i, p in enumerate(phones)]
    got = {r.doc_id: r for r in pii.pseudonymize(docs_of(spark, rows), "key").collect()}
    form = re.compile(r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}")
    new = [form.findall(got[i].text) for i in range(len(phones))]
    assert all(got[i].n_phone == 2 and a == b != p for i, (p, (a, b)) in enumerate(zip(phones, new, strict=True)))
    assert len({a for a, _ in new}) == len(phones)


def test_feistel_is_a_permutation(spark):
    vector = F.array(F.struct((F.col("id") / 60).cast("int").alias("v"), F.lit(5).alias("m")), F.struct((F.col("id") % 60).cast("int").alias("v"), F.lit(60).alias("m")))
    out = spark.range(300).select(F.transform(pii._feistel(vector, "k", "x"), lambda s: s["v"]).alias("o"))
    assert out.distinct().count() == 300 and out.where("o[0] >= 5 or o[1] >= 60").count() == 0


def test_token_counts_of_very_long_words(spark):
    """Memory must grow with the longest word, not with its square."""
    import resource

    from tokenizers import Tokenizer

    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=100_000)), "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(20_000)),
             "short words <|endoftext|> and " + "z" * 30_000]
    path = queries.vocabulary()
    library = Tokenizer.from_file(path)
    library.no_truncation()
    counter = tokens.PrefixCounter(open(path, encoding="utf-8").read())
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert [counter.count(t) for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400 << 10  # kilobytes
    assert max(map(len, counter.front)) <= tokens.SHARED >= max(map(len, counter.known), default=0)


def plain_ftrl(inputs, labels, epochs, alpha, beta, l1, l2):
    """FTRL-proximal as published, one coordinate at a time."""
    z, n = Counter(), Counter()

    def weight(i):
        shrink = 0.0 if i == toxicity.DIMENSIONS else l1
        return 0.0 if abs(z[i]) <= shrink else -(z[i] - math.copysign(shrink, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for row in order.permutation(len(inputs)):
            w = {i: weight(i) for i in inputs[row]}
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values())))))
            g = p - labels[row]
            for i in inputs[row]:
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


def test_toxicity_weights_equal_plain_ftrl():
    rng = np.random.default_rng(9)
    coords = [np.unique(rng.integers(0, 60, rng.integers(1, 15))).astype(np.int32) for _ in range(150)]
    labels = np.array([float((c < 6).any()) for c in coords])
    settings = {"alpha": 0.2, "beta": 1.0, "l1": 0.7, "l2": 0.05}
    got = toxicity.fitted(np.concatenate(coords), np.array([len(c) for c in coords]), np.arange(150), labels, 3, **settings)
    met = Counter(int(i) for c in coords for i in c)
    inputs = [[int(i) for i in c if met[int(i)] >= toxicity.LEAST_DOCS] + [toxicity.DIMENSIONS] for c in coords]
    want = plain_ftrl(inputs, labels, 3, **settings)
    assert {i for i, w in want.items() if w} - {toxicity.DIMENSIONS} == set(got) - {toxicity.DIMENSIONS}
    assert all(abs(got[i] - want[i]) < 1e-9 for i in got) and 5 < len(got) < 60


def test_training_needs_little_memory_beside_its_coordinates():
    coords = np.tile(np.arange(1 << 19, dtype=np.int32), 48)  # 96 MB
    tracemalloc.start()
    try:
        assert toxicity.fitted(coords, np.full(48, 1 << 19), np.arange(48), np.arange(48) % 2.0, 1)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 150 << 20


def test_parts_of_rows_teach_what_all_rows_at_once_teach():
    rng = np.random.default_rng(9)
    coords = [np.unique(rng.integers(0, 60, 12)).astype(np.int32) for _ in range(90)]
    labels = np.array([float((c < 6).any()) for c in coords])
    lengths = np.array([len(c) for c in coords])
    parts = [(np.concatenate(coords[a:a + 40]), lengths[a:a + 40]) for a in range(0, 90, 40)]
    want = toxicity.fitted(np.concatenate(coords), lengths, np.arange(90), labels, 2, l1=0.5)
    assert want and toxicity.fitted_parts(parts, np.arange(90), labels, 2, l1=0.5) == want


def test_toxicity_sample_is_bounded_in_bytes(spark, monkeypatch):
    docs = docs_of(spark, [(i, ("vile " if i % 2 else "kind ") + "word " * 400, "s") for i in range(300)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    sizes = []
    for limit in (96 << 20, 100_000):
        monkeypatch.setattr(toxicity, "TRAIN_BYTES", limit)
        sizes.append(len(toxicity.train(docs, labels)))
    assert sizes[0] >= sizes[1] > 0
    last = toxicity.score(docs, toxicity.train(docs, labels)).where(toxicity.held_out(F.col("doc_id"))).collect()
    assert sum((r.score > 0.5) == bool(r.doc_id % 2) for r in last) / len(last) > 0.9


def test_toxicity_learns_and_holds_out(spark):
    rng = random.Random(2)
    vocab = [f"n{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        words = rng.choices(vocab, k=rng.choice([3, 30, 200])) + (["Vile" + rng.choice(["", "ly", "ness", "st"])] if bad else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 1, int(bad)))
    rows += [(900, None, "s"), (901, "", "s"), (None, "vile words", "s"), (0, "", "s")]
    docs, known = docs_of(spark, rows), spark.createDataFrame([*labels, (3, 1, 0), (None, 0, 1), (700, None, None)], "doc_id long, quality int, toxic int")
    weights = toxicity.train(docs, known)
    assert 0 < len(weights) < 2000
    got = toxicity.score(docs, weights).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    import zlib

    assert all(r.held == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held and r.doc_id < 600]
    right = sum(r.predicted == (r.doc_id % 5 == 0) for r in held)
    assert len(held) > 150 and right / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got) and len(got) == len(rows)
    assert toxicity.train(docs, known.limit(0)) == {} and toxicity.score(docs, {}).where("score <> 0 or predicted <> 0").count() == 0


BASE = {
    "assign": (re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m.group(2)) >= 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 20),
    "hex": (re.compile("[0-9a-f]+"), lambda m: len(m.group()) >= 24),
}


def test_secret_spans_equal_the_patterns(spark):
    rng = random.Random(4)
    hexa = "".join(rng.choices("0123456789abcdef", k=40))
    texts = [None, "", f'é token = "{hexa}" 🙂 Password:abc password=abcdefg', "secret:token:abcdefg api_key='x.y-z_12'", "AKIA" + "Z" * 16 + " AKIAAKIA1 " + "AKIA" * 9,
             f"apikey={hexa} {hexa}{hexa}", "token=abc " * 300, "passwd\t=x APIKEY  :  ABCDEF=="]
    docs = docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)])
    got = secret_scan.scan_secrets(docs).select("doc_id", secret_scan.spans_text(*secret_scan.KINDS).alias("s")).collect()
    for r in got:
        spans = sorted((m.start(), no, f"{k}:{m.start()}:{m.end()}") for no, (k, (p, ok)) in enumerate(BASE.items()) for m in p.finditer(texts[r.doc_id] or "") if ok(m))
        assert r.s == ",".join(s for *_, s in spans)


def plain_tail(z):
    above = math.exp(-z * z / 2) / (1.64 * abs(z) + math.sqrt(0.76 * z * z + 4))
    return 1 - above if z < 0 else above


def plain_battery(token):
    """(encoding, p of a random string, p of ordinary text) of one token."""
    body = token.rstrip("=")
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", body):
        encoding, body = "hex", body.lower()
    elif re.fullmatch("[A-Z2-7]+", body):
        encoding = "base32"
    else:
        encoding, body = ("base62", body) if body.isalnum() else ("base64", body.replace("-", "+").replace("_", "/"))
    alphabet = secret_scan.ALPHABETS[encoding]
    n, a, v = len(body), len(alphabet), [alphabet.index(c) for c in body]
    pairs, p = n * (n - 1) / 2, 1 / a
    equal = sum(x == y for i, x in enumerate(v) for y in v[:i])
    var = pairs * p * (1 - p)
    third = pairs * p * (1 - p) * (1 - 2 * p) + n * (n - 1) * (n - 2) * p * p * (1 - p)
    shape = 4 * var ** 3 / third ** 2
    z_chi = 3 * math.sqrt(shape) * (max(1 + (equal - 0.5 - pairs * p) / math.sqrt(var * shape), 1e-9) ** (1 / 3) - 1 + 1 / (9 * shape))
    high = [x > (a - 1) / 2 for x in v]
    h = sum(high)
    runs = 1 + sum(x != y for x, y in zip(high, high[1:]))
    twice = 2 * h * (n - h)
    spread = twice * (twice - n) / (n * n * (n - 1))
    z_runs = max(abs(runs - twice / n - 1) - 0.5, 0) / math.sqrt(spread) if spread > 0 else 99.0
    mean = sum(v) / n
    total = sum((x - mean) ** 2 for x in v)
    z_serial = abs((sum((x - mean) * (y - mean) for x, y in zip(v, v[1:])) / total if total else 1.0) + 1 / n) * math.sqrt(n)
    p_random = min(1.0, 3 * min(plain_tail(z_chi), 2 * plain_tail(z_runs), 2 * plain_tail(z_serial)))
    kinds = ["0" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "m" for c in body]
    share, usual = min(sum(x != y for x, y in zip(kinds, kinds[1:])) / (n - 1), 1 - 1e-9), secret_scan.SWITCH_RATE
    bound = (n - 1) * (share * math.log(share / usual) + (1 - share) * math.log((1 - share) / (1 - usual))) if share > usual else 0.0
    return encoding, p_random, bound


def plain_added_spans(texts, q):
    """Candidates of all texts, judged by two Benjamini-Hochberg steps over sorted lists."""
    tokens = []
    for d, text in enumerate(texts):
        base = [m.span() for k, (p, ok) in BASE.items() for m in p.finditer(text) if ok(m)]
        for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}={0,2}", text):
            if not any(a < m.end() and m.start() < b for a, b in base):
                _, p, bound = plain_battery(m.group())
                steps = lambda x: min(int(max(x, 0) // secret_scan.BIN_WIDTH), secret_scan.BINS - 1) * secret_scan.BIN_WIDTH
                tokens.append((d, m.span(), min(len(m.group().rstrip("=")) // 16, secret_scan.BANDS - 1), steps(-math.log(max(p, 1e-300))), steps(bound)))
    out = set()
    for band in {t[2] for t in tokens}:
        of_band = [t for t in tokens if t[2] == band]

        def found(at):
            ranked = sorted((t[at] for t in of_band), reverse=True)
            least = [e for i, e in enumerate(ranked) if math.exp(-e) <= q * (i + 1 + sum(x == e for x in ranked[i + 1:])) / len(ranked)]
            return {t[:2] for t in of_band if least and t[at] >= min(least)}

        out |= found(4) - found(3)
    return out


def test_added_spans_equal_two_plain_steps(spark):
    rng = random.Random(14)
    b64 = secret_scan.ALPHABETS["base64"]
    texts = []
    for _ in range(300):
        parts = ["".join(rng.choices("abcdefghij", k=rng.randrange(20, 60))), "some_ordinary_name_of_thing", "CamelCaseWordsInARowAgain" * rng.randrange(1, 4),
                 "".join(rng.choices(b64, k=rng.randrange(20, 130))), "".join(rng.choices("0123456789ABCDEF", k=rng.choice([20, 32, 64]))), "path/to/some/file-of-2024/x1",
                 "aB3" * rng.randrange(7, 30), b64[:rng.randrange(20, 64)], "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=40)) + "==", "-" * 30, "A1" * 12]
        texts.append(" ".join(rng.sample(parts, rng.randrange(6))))
    got = secret_scan.scan_secrets(docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)]), keep=["doc_id"]).select("doc_id", "random").collect()
    want = plain_added_spans(texts, secret_scan.FALSE_SHARE)
    assert {(r.doc_id, (x.start, x.end)) for r in got for x in r.random} == want and len(want) > 100


def test_battery_is_true_to_length(spark):
    """Random strings of every length and alphabet fall below a level about as often as the level says."""
    rng = random.Random(15)
    for name, alphabet in secret_scan.ALPHABETS.items():
        for n in (20, 28, 48, 120):
            p = [plain_battery("".join(rng.choices(alphabet, k=n)))[1] for _ in range(600)]
            for level in (0.05, 0.01):
                assert sum(x <= level for x in p) / len(p) <= 1.6 * level + 0.008, (name, n, level)


def test_battery_adds_random_strings_only(spark):
    rng = random.Random(9)
    alphabet = secret_scan.ALPHABETS["base64"]
    rows = [(i, "key " + "".join(rng.choices(alphabet, k=44)) + " end", "s") for i in range(30)]
    rows += [(100 + i, "anordinarywordthatisverylong and another-hyphenated-compound-word-again " + "ab" * 30 + " " + "0123456789" * 4, "s") for i in range(30)]
    got = {r.doc_id: r.random for r in secret_scan.scan_secrets(docs_of(spark, rows)).select("doc_id", "random").collect()}
    assert sum(len(got[i]) == 1 for i in range(30)) >= 27 and all(not got[100 + i] for i in range(30))
    assert all((s.start, s.end) == (4, 48) for i in range(30) for s in got[i])


def test_schemas_hold_for_empty_tables(spark):
    empty = docs_of(spark, [])
    assert pii.pseudonymize(empty, "k").collect() == [] and secret_scan.scan_secrets(empty).collect() == []
    assert tokens.count_tokens(empty, queries.vocabulary()).collect() == []
    assert decontam.contamination(empty, spark.createDataFrame([], "item_id long, text string")).collect() == []
    assert isinstance(toxicity.score(empty, {}).schema, T.StructType)
