"""Each corpus operator on small tables with nulls, empty and long texts, ties, repeats and clashing columns, against brute force."""

import collections
import hashlib
import html
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.llm import common, decontaminate, htmltext, jaccard, multiindex, quality, sharding, suffixes, urlrules

DOCS = "doc_id long, text string, lang string, h long, n long, items string, size long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def frame(spark, texts, ids=None):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, None, 7, 8, "x", 9) for i, t in zip(ids or range(len(texts)), texts)], DOCS).repartition(3)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghié") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    base = [prose(rng, rng.randint(60, 160)) for _ in range(25)]
    near = []
    for t in base[:8]:
        w = t.split(" ")
        w[len(w) // 2] = "changed"
        near.append(" ".join(w))
    shared = prose(rng, 60)
    mixed = [prose(rng, 40) + "\n" + shared + " " + prose(rng, 30) for _ in range(6)]
    return [None, "", "   ", "one two", "One, two!", *base, *base[:3], *near, *mixed, "ab " * 400, "é" * 300, prose(rng, 4000), "x  y\n\n z \t", "\x1f▁ a▁b", shared[:199]]


# ---------------------------------------------------------------- 1


def test_decontamination(spark, texts):
    long_doc = next(t for t in texts if t and t.count(" ") == 3999)
    items = [(1, " ".join(long_doc.split(" ")[100:130])), (2, texts[5].upper()), (10, "ONE... two"), (3, None), (4, ""), (5, "no such words here"), (6, texts[5])]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    for block in (decontaminate.BLOCK_WORDS, 50):
        got = {r.doc_id: r for r in decontaminate.judged(decontaminate.contamination(frame(spark, texts), bench, block_words=block)).collect()}
        for i, t in enumerate(texts):
            w, hit, found = words(t), set(), set()
            for item, bt in items:
                b = words(bt)
                n = min(13, len(b))
                grams = {tuple(b[k : k + n]) for k in range(len(b) - n + 1)} if n else set()
                for k in range(len(w) - n + 1 if n else 0):
                    if tuple(w[k : k + n]) in grams:
                        hit.update(range(k, k + n))
                        found.add(str(item))
            r = got[i]
            assert (r.n_words, r.n_hit, r.n_items) == (len(w), len(hit), len(found))
            assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
            assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
    empty = bench.limit(0)
    assert not decontaminate.judged(decontaminate.contamination(frame(spark, texts), empty)).where("n_hit > 0").count()
    assert decontaminate.contamination(frame(spark, texts).limit(0), bench).count() == 0
    kept = decontaminate.decontaminated(frame(spark, texts), bench)
    assert kept.columns == frame(spark, texts).columns and kept.count() == sum(not r.contaminated for r in got.values())


def test_decontamination_of_repeated_ids(spark, texts):
    bench = spark.createDataFrame([(1, texts[5]), (2, texts[6]), (3, "not here")], "item_id long, text string")
    other = " ".join(f"w{i}" for i in range(len(words(texts[5]))))
    docs = frame(spark, [texts[5], other, texts[5], texts[5], other, None, None], [3, 3, 3, None, None, None, 4])
    some = [sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items) for r in decontaminate.judged(decontaminate.contamination(docs, bench, block_words=b)).collect()) for b in (decontaminate.BLOCK_WORDS, 20)]
    n = len(words(texts[5]))
    assert some[0] == some[1] == sorted([("3", n, n, 1), ("3", n, 0, 0), ("3", n, n, 1), ("None", n, n, 1), ("None", n, 0, 0), ("None", 0, 0, 0), ("4", 0, 0, 0)])


def test_cutting_spans():
    assert decontaminate.without_spans("Ab, cd ef gh!", [[1, 3]]) == "Ab,  gh!".replace("  ", "  ")


# ---------------------------------------------------------------- 2


def brute_links(texts, n=5, t=0.8):
    sets = []
    for x in texts:
        w = words(x)
        k = min(n, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    links, root = collections.Counter(), list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-12:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return links, [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("block", [256, 3])
def test_near_duplicates(spark, texts, block):
    rng = random.Random(2)
    big = prose(rng, 200).split(" ")
    group = [" ".join(big[:i] + ["other"] + big[i + 1 :]) for i in range(20, 60)]
    all_texts = [*texts, *group]
    links, roots = brute_links(all_texts)
    got = jaccard.near_duplicates(frame(spark, all_texts), block_docs=block).collect()
    assert {r.doc_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (links[i], roots[i], roots[i] == i) for i in range(len(all_texts))}


def test_near_duplicates_of_odd_rows(spark, texts):
    odd = frame(spark, [texts[5], texts[5], texts[5], texts[6]], [None, 3, 3, 1])
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_links, r.kept) for r in jaccard.near_duplicates(odd).collect())
    assert got == [(False, 1, 0, True), (False, 3, 1, True), (False, 3, 1, True), (True, 0, 0, True)]
    assert jaccard.near_duplicates(odd.limit(0)).count() == 0


def test_near_duplicates_of_repeated_ids(spark, texts):
    a, b = prose(random.Random(8), 90), prose(random.Random(9), 90)
    close = lambda t: t + " more"
    rows = [(5, a), (5, a), (9, close(a)), (7, a), (7, b), (12, close(b)), (5, b + " again")]
    got = jaccard.near_duplicates(frame(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    of_a, of_b = [(5, 3, 5), (5, 3, 5), (9, 3, 5), (7, 3, 5)], [(7, 2, 5), (12, 2, 5), (5, 2, 5)]
    assert sorted((r.doc_id, r.n_links, r.component_id) for r in got) == sorted(of_a + of_b)
    rows = [(5, a), (5, b), (9, close(a)), (3, close(b))]
    got = jaccard.near_duplicates(frame(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    assert sorted((r.doc_id, r.n_links, r.component_id) for r in got) == [(3, 1, 3), (5, 1, 3), (5, 1, 5), (9, 1, 5)]


def test_banding_reaches_the_recall():
    b, r = jaccard.banding(0.8, 0.9999)
    assert 1 - (1 - 0.8**r) ** b >= 0.9999


# ---------------------------------------------------------------- 5


def test_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(120, 16))
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(base)]
    for i in range(40):
        rows.append((200 + i, (base[i] + rng.normal(size=16) * 0.22).tolist(), i % 3))
    rows += [(300, base[0].tolist(), 0), (301, base[0].tolist(), None), (302, None, 0), (303, [0.0] * 16, 0), (304, [None] * 16, 0), (305, [float("nan")] * 16, 0), (306, [], 0), (307, [1.0, 2.0], 0), (308, [1.0, 2.1], 0), (None, base[0].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("id", F.lit(1)).withColumn("size", F.lit("x"))
    for block in (1024, 4):
        got = {r.vec_id: r for r in multiindex.near_vectors(df, block=block).collect()}
        ok = [(i, np.array(v, float), l) for i, v, l in rows if i is not None and l is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
        links = collections.defaultdict(set)
        for a in ok:
            for b in ok:
                if a[0] != b[0] and a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= 0.93:
                    links[a[0]].add(b[0])
        assert {i: r.n_links for i, r in got.items() if i is not None} == {i: len(links[i]) for i, _, _ in rows if i is not None}
        for i, r in got.items():
            seen, todo = {i}, [i]
            while todo:
                for j in links[todo.pop()] - seen:
                    seen.add(j)
                    todo.append(j)
            assert i is None or r.component_id == min(seen)
    assert multiindex.near_vectors(df.limit(0)).count() == 0


def test_traversal_visits_cells_by_distance():
    x = np.random.default_rng(4).normal(size=(300, 10))
    index = multiindex.MultiIndex(x, 8, 0.93, 0.99)
    unit = multiindex.units(x)
    a, b = index.halves(unit)
    every = (a[:, :, None] + b[:, None, :]).reshape(len(x), -1)
    home, reach, cells = index.visits(unit)
    for d, h, r, c in zip(every, home, reach, cells):
        assert len(set(c.tolist())) == len(c) and set(c.tolist()) == set(np.flatnonzero(d <= r).tolist()) and c[0] == h
        assert (np.diff(d[c]) >= 0).all() and h == d.argmin()
    assert multiindex.words_for(50_000) == 16 and multiindex.words_for(10) == 2 and multiindex.words_for(10**12) == multiindex.WORDS


def test_recall_of_planted_links(spark):
    """Partners at cosines from 0.93 to 0.96 among vectors in all directions."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(6000, 64)).astype(np.float32)
    unit = multiindex.units(base[:2000].astype(np.float64))
    side = rng.normal(size=unit.shape)
    side -= (side * unit).sum(1)[:, None] * unit
    cos = rng.uniform(0.931, 0.96, len(unit))[:, None]
    near = (cos * unit + np.sqrt(1 - cos**2) * multiindex.units(side)).astype(np.float32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([base, near]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in multiindex.near_vectors(df, words=8).collect()}
    caught = [got[6000 + i].component_id == i and got[i].n_links >= 1 for i in range(2000)]
    assert np.mean(caught) >= 0.99


# ---------------------------------------------------------------- 6


@pytest.mark.parametrize("hot", [suffixes.HOT, 1])
def test_suffix_dedup(spark, texts, hot):
    texts = [*texts, texts[5][:250], texts[6] + texts[7], "日本語" * 120]
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[k : k + 200] for b in raw for k in range(len(b) - 199))
    got = {r.doc_id: r for r in suffixes.dedup_digest(frame(spark, texts), hot=hot, at_once=16).collect()}
    for i, b in enumerate(raw):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())


def test_suffix_dedup_of_odd_rows(spark, texts):
    assert suffixes.dedup_digest(frame(spark, texts).limit(0)).count() == 0
    odd = suffixes.dedup_digest(frame(spark, [texts[5], texts[6], texts[6]], [None, 1, 1])).collect()
    assert sorted((r.doc_id or 0, r.n_removed > 0) for r in odd) == [(0, False), (1, True), (1, True)]
    kept = {r.doc_id: r.text for r in suffixes.deduped(frame(spark, [None, "日本語" * 120, "x" + "日本語" * 120])).collect()}
    assert kept[0] is None and "\ufffd" not in kept[1] + kept[2]


def test_run_length_index():
    rng = np.random.default_rng(3)
    for kinds, n in ((2, 60), (40, 60), (1, 5), (3, 1)):
        rows = [bytes(rng.integers(97, 97 + kinds, 30).astype(np.uint8)) for _ in range(n)] + [b"x" * 12 + bytes(rng.integers(97, 100, 18).astype(np.uint8)) for _ in range(n)]
        pads = rng.integers(0, 6, len(rows))
        rows = [r[: int(rng.integers(8, 31))] for r in rows]
        raw, lengths = np.frombuffer(b"".join(rows), np.uint8), np.array([len(r) for r in rows])
        index = suffixes.RunLengthIndex(raw, np.cumsum(lengths) - lengths, lengths, pads, 40)
        got = index.matches(7)
        padded = [[None] * p + list(r) + [None] * (40 - p - len(r)) for p, r in zip(pads, rows)]
        for c in range(34):
            seen = collections.Counter(tuple(r[c : c + 7]) for r in padded)
            assert got[:, c].tolist() == [seen[tuple(r[c : c + 7])] > 1 for r in padded]
    same = np.frombuffer(b"a long line that is the same" * 500, np.uint8)
    index = suffixes.RunLengthIndex(same, np.arange(500) * 28, np.full(500, 28), np.zeros(500, np.int64), 28)
    assert index.runs == 28 and sum(len(h) for h, *_ in index.columns) == 28 and index.matches(28).all()
    empty = np.zeros(0, np.int64)
    assert suffixes.RunLengthIndex(np.zeros(0, np.uint8), empty, empty, empty, 10).matches(5).shape == (0, 6)


# ---------------------------------------------------------------- 7


def test_html(spark):
    page = "<html><head><title>T</title><script>var a='</p>'</script></head><body><nav><ul><li><a href=x>Home</a></ul></nav><!-- no --><div class='ad'>Buy this.</div><article><h1>A &amp; B</h1><p>One <b>two\n three.<br>four<p>Five 1 < 2 &copy; six.</p><section class=comments><p>Nice post, well said.</p></section></article><footer>&copy; site</footer>"
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p"), (5, "u", "<article><p>" + "word " * 50_000 + "end.</article>")]
    got = {r.page_id: r for r in htmltext.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))).collect()}
    assert got[1].text == "A & B\n\nOne two three. four\n\nFive 1 < 2 © six."
    assert (got[2].text, got[2].n_chars, got[3].text) == ("", 0, "") and got[5].n_chars == 250_004
    fresh = [htmltext.training_example(p) for p in htmltext.labelled_pages(60, seed=99)]
    model = htmltext.trained()
    right = [a == b for f, l in fresh for a, b in zip(model.viterbi(f), l)]
    assert np.mean(right) > 0.97


def test_noise_of_names_never_seen():
    model = htmltext.trained()
    body = "<h1>Title here</h1><p>" + "Some long sentence of words. " * 10 + "</p><p>" + "More text is here, fine. " * 8 + "</p>"
    for noise in ("<div class='sponsor'>Buy our thing today.</div>", "<section class='discussion'><p>I think this is great, said the reader.</p></section>", "<div id='responses'><p>Me too, said another reader.</p></div>", "<div class='qzx'>Only today: less.</div>"):
        for open_, close in (("<article>", "</article>"), ("<main>", "</main>"), ("<div class='content'>", "</div>"), ("<div class='wvut'>", "</div>")):
            out = htmltext.main_text(f"<html><body><nav><a href=/>Home</a></nav>{open_}{body}{close}{noise}<footer>&copy; x</footer></body></html>", model)
            assert out.startswith("Title here\n\nSome") and out.endswith("fine.") and out.count("\n\n") == 2


def test_hostile_pages_cost_linear_time():
    import time

    model = htmltext.trained()
    kinds = ["<a ", "<div>a", "</x>", '<a "', "<a \">'", "<script ", "</script <script>", "<p>", "<!--", "<div><a>x</b>", "<a '\">", "&lt", "<div class='qa wb'>"]
    pages = [k * (1_000_000 // len(k)) for k in kinds] + ["".join(f"<div class=c{i}>a" for i in range(60_000)), "<b " + "class=" * 160_000 + ">x"]
    for page in pages:
        start = time.process_time()
        htmltext.main_text(page, model)
        assert time.process_time() - start < 12, page[:30]


def test_tags_end_where_quotes_allow():
    read = lambda page: [(t, shut, rest) for _, t, shut, rest in htmltext.tags(page) if t]
    assert read("<a href='x>y'>b</a>") == [("a", False, " href='x>y'"), ("a", True, "")]
    assert read("<p title=\"a>b<p>c") == [("p", False, ' title="a'), ("p", False, "")]
    assert [b.text for b in htmltext.leaf_blocks("1 < 2 <p>x</p><script>'</p>'</script> y <")] == ["1 < 2", "x", "y <"]


def test_viterbi_is_the_best_path():
    import itertools

    rng = np.random.default_rng(1)
    model = htmltext.ChainField({"a": 0, "b": 1, "c": 2}, rng.normal(size=(3, 2)), rng.normal(size=(2, 2)))
    feats = [["a"], ["b", "c"], ["c"], ["a", "b"]]
    e = model.scores(feats)
    score = lambda ls: sum(e[i][l] for i, l in enumerate(ls)) + sum(model.pairs[a][b] for a, b in zip(ls, ls[1:]))
    assert model.viterbi(feats) == list(max(itertools.product((0, 1), repeat=4), key=score))


def test_pages_of_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in htmltext.extracted(rows).collect()}
    for r in rows.collect():
        core = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", core)]
        assert got[r.page_id] == "\n\n".join(p for p in parts if p)


# ---------------------------------------------------------------- 8


def test_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.scored(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    held = [(got[r.doc_id].score, r.quality) for r in labels.dropDuplicates(["doc_id"]).collect() if r.doc_id in got and got[r.doc_id].held_out]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    odd = frame(spark, [None, "", "word " * 100_000, "a"], [None, 1, 2, 2])
    assert quality.scored(odd, labels).count() == 4
    assert [r.score for r in quality.scored(odd, labels.limit(0)).collect()] == [0.5] * 4
    assert quality.scored(odd.limit(0), labels).count() == 0


def test_votes_equal_brute_force():
    rng = np.random.default_rng(2)
    counts = rng.poisson(0.4, size=(300, quality.TERMS)).astype(np.float32)
    counts[150:200] = counts[100:150]  # ties
    model = quality.Neighbours.fit(counts, rng.integers(0, 2, 300))
    new = np.concatenate([counts[90:160], rng.poisson(0.4, size=(40, quality.TERMS)).astype(np.float32)])
    got = model.score(new)
    cos = model.latent(new) @ model.vectors.T
    for row, score in zip(cos, got):
        best = sorted(range(300), key=lambda i: (-row[i], i))[: quality.NEIGHBOURS]
        w = [max(float(row[i]), 0.0) ** 8 + 1e-9 for i in best]
        assert abs(score - sum(x * model.labels[i] for x, i in zip(w, best)) / sum(w)) < 1e-5


# ---------------------------------------------------------------- 9


def test_sharding(spark, texts):
    got = sharding.sharded(frame(spark, [*texts, "tail"], [*range(len(texts)), None]), 4).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        t = "tail" if r.doc_id is None else texts[r.doc_id] or ""
        assert (r.size, r.text_crc32) == (len(t.encode()) + 1, zlib.crc32(t.encode()))
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(got) == len(texts) + 1
    assert sharding.sharded(frame(spark, texts).limit(0)).count() == 0


def test_slot_maps():
    rng = random.Random(1)
    sizes = [rng.randint(0, 1000) for _ in range(2000)]
    one = sharding.SlotMap.balanced(sizes, 8)
    held = collections.Counter()
    for s, x in zip(one.shard_of, sizes):
        held[s] += x
    assert max(held.values()) - min(held.values()) <= 1000
    two = one.grown(sizes)
    assert two.version == 2 and two.shards == 9
    assert all(b == a or b == 8 for a, b in zip(one.shard_of, two.shard_of)) and {i for i, (a, b) in enumerate(zip(one.shard_of, two.shard_of)) if a != b} == set(two.moved)
    assert abs(sum(sizes[i] for i in two.moved) - sum(sizes) / 9) <= 1000


def test_stored_slot_maps(spark, texts, tmp_path):
    path = f"file://{tmp_path}/map"
    docs = frame(spark, [f"text {i} " * (i % 90) for i in range(3000)], list(range(3000)))
    first = {r.doc_id: r for r in sharding.sharded(docs, 4, map_path=path).collect()}
    held = collections.Counter()
    for r in first.values():
        held[r.shard] += r.size
    assert max(held.values()) - min(held.values()) <= 0.01 * sum(held.values()) and {r.map_version for r in first.values()} == {1}
    grown = sharding.rebalanced(docs, path)
    assert sharding.SlotMap.load(spark, path) == grown and sharding.saved_versions(spark, path) and grown.version == 2
    second = {r.doc_id: r for r in sharding.sharded(docs, 4, map_path=path).collect()}
    moved = [i for i in first if first[i].shard != second[i].shard]
    assert moved and {second[i].shard for i in moved} == {4} and all(first[i].virtual_slot == second[i].virtual_slot for i in first)
    assert {r.doc_id: r.shard for r in sharding.sharded(docs, 4, map_path=path, version=1).collect()} == {i: r.shard for i, r in first.items()}
    with pytest.raises(ValueError):
        grown.save(spark, path)
    nulls = sharding.sharded(frame(spark, [f"t{i}" for i in range(400)], [None] * 400), 4).collect()
    assert len({r.virtual_slot for r in nulls}) > 300


# ---------------------------------------------------------------- 10


def test_urls(spark):
    urls = [None, "", "no scheme", "HTTP://A.Example.COM/en/7?x#y", "http://b.com/en/", "http://x.example.net/de/81", "http://x.net/de/", "http://com/en/", "http://notcom/en/", "a://b.org/es/#q", "x://host", "x://h?p/q", "x://y://z/w"]
    spam = [f"http://spam-site.test/buy/{i}" for i in range(30)] + [f"http://fine.test/read/{i}" for i in range(30)]
    rows = list(enumerate([*urls, *spam]))
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit("x")).withColumn("key", F.lit(1))
    n = len(urls)
    labels = spark.createDataFrame([(n + i, 0 if i < 30 else 1) for i in range(60)] + [(0, 0), (1, None)], "doc_id long, quality int")
    got = {r.page_id: r for r in urlrules.judged_urls(pages, labels).collect()}
    assert [(got[i].host, got[i].path) for i in range(n)] == [("", ""), ("", ""), ("", ""), ("a.example.com", "/en/7"), ("b.com", "/en/"), ("x.example.net", "/de/81"), ("x.net", "/de/"), ("com", "/en/"), ("notcom", "/en/"), ("b.org", "/es/"), ("host", ""), ("h", ""), ("y:", "//z/w")]
    assert [(got[i].rule, got[i].verdict) for i in range(3, 10)] == [("example.com/en/7", "allow"), ("com/en/", "block"), ("example.net/de/8", "block"), ("net/de/", "allow"), ("com/en/", "block"), (None, "allow"), ("org/es/", "block")]
    assert {got[n + i].verdict for i in range(30)} == {"block"} and {got[n + i].verdict for i in range(30, 60)} == {"allow"}
    assert got[n].mined_rule in ("h:spam-site", "p:buy") and len(got) == len(rows)
    assert {r.verdict for r in urlrules.judged_urls(pages.where("page_id >= 13"), labels.limit(0)).collect()} == {"allow"}
    assert urlrules.judged_urls(pages.limit(0), labels).count() == 0


def test_mined_rules_equal_brute_force(spark):
    import itertools

    rng = random.Random(7)
    rows = []
    for _ in range(400):
        items = sorted({f"t{rng.randrange(9)}" for _ in range(rng.randint(1, 5))} | ({"x y", "z"} if rng.random() < 0.2 else set()))
        rows.append((items, ("t1" in items and "t2" in items or "x y" in items) and rng.random() < 0.9))
    got = urlrules.mined_rules(spark.createDataFrame(rows, "items array<string>, bad boolean"), least_support=0.02).collect()
    bads = sum(b for _, b in rows)
    same = {}  # tokens of the very same urls are one
    for t in {t for i, _ in rows for t in i}:
        same.setdefault(tuple(t in i for i, _ in rows), []).append(t)
    want, tokens = {}, sorted(min(v) for v in same.values())
    for k in range(1, 6):
        for c in itertools.combinations(tokens, k):
            hit = [b for i, b in rows if set(c) <= set(i)]
            if sum(hit) >= 8 and sum(hit) / len(hit) >= 0.6 and sum(hit) / len(hit) / (bads / 400) >= 1.2:
                if not any(set(d) < set(c) and want[d] >= sum(hit) / len(hit) - 1e-12 for d in want):
                    want[c] = sum(hit) / len(hit)
    assert {tuple(r.tokens): round(r.confidence, 9) for r in got} == {c: round(v, 9) for c, v in want.items()} and len(want) > 2
    assert all(" " not in t for r in got for t in r.rule_id.split(" ")) and any("x%20y" in r.rule_id for r in got)


def test_rules_over_all_tokens_of_a_url(spark):
    # 14 tokens are surer than x and y, which are bad only together
    rows = []
    for i in range(600):
        both, one = i % 6 == 0, i % 6 in (1, 2)
        bad = both or i % 4 == 0 and not one
        noise = [f"t{j}" for j in range(14) if bad and (both or (i * 7 + j * 13) % 3) or i % 97 == j]
        rows.append((noise + (["x", "y"] if both else ["x"] if i % 6 == 1 else ["y"] if i % 6 == 2 else []), bad))
    got = urlrules.mined_rules(spark.createDataFrame(rows, "items array<string>, bad boolean"), least_support=0.1).collect()
    assert sum(len(items) > 13 for items, _ in rows) > 90
    pair = [r for r in got if set(r.tokens) == {"x", "y"}]
    assert len(pair) == 1 and (pair[0].confidence, round(pair[0].support, 6)) == (1.0, round(100 / 600, 6))


def test_long_urls_are_mined_in_bounded_time(spark):
    rng = random.Random(3)
    urls = ["http://a.test/" + "/".join(f"s{i}" for i in range(40)) + "?" + "&".join(f"k{i}=1" for i in range(40))] * 6
    urls += [f"http://b{n}.test/" + "/".join(f"s{i}" for i in range(40) if rng.random() < 0.5) for n in range(60)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if i < 6 or i % 2 else 1) for i in range(66)], "doc_id long, quality int")
    got = urlrules.judged_urls(pages, labels).collect()
    assert len(got) == 66 and all(r.verdict == "block" for r in got if r.page_id < 6)


# ---------------------------------------------------------------- shared


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, 5000)]
    root = {x: x for e in edges for x in e}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_recall_of_near_duplicates_on_documents(spark):
    """Every linked pair of the table's documents, by an inverted list of 5-grams, against the links that the bands find."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets, where = {}, collections.defaultdict(list)
    for r in docs.collect():
        w = words(r.text)
        k = min(5, len(w))
        sets[r.doc_id] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
        for g in sets[r.doc_id]:
            where[g].append(r.doc_id)
    shared = collections.Counter((a, b) for ids in where.values() if len(ids) > 1 for i, a in enumerate(ids) for b in ids[:i])
    links = collections.Counter()
    for (a, b), n in shared.items():
        if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n):
            links[a] += 1
            links[b] += 1
    got = {r.doc_id: r.n_links for r in jaccard.near_duplicates(docs).collect()}
    assert sum(links.values()) > 100 and all(got[i] <= links[i] for i in got)
    assert sum(got.values()) >= 0.999 * sum(links.values())
