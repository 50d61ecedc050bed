"""Each operator against brute force or an exact round trip, over edge cases; empty tables give no rows."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from emberlog.llm import ball_tree, bpe, byte_cnn, common, components, decontamination, license_scan, nb_linear, ngram_join, ppm, substring_dedup, url_filter

LOWER = common.LOWER
RANKS, PATTERN = P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def collected(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_substrings(docs, empty):
    rows = [(r.doc_id, (r.text or "").encode().split()) for r in docs.collect()]
    seen = Counter(tuple(w[i : i + 35]) for _, w in rows for i in range(len(w) - 34))
    expected = []
    for doc_id, w in rows:
        gone = {j for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        expected.append((doc_id, len(w), len(gone), sha(b" ".join(kept))))
    out = substring_dedup.remove_repeats(docs, ["doc_id"], texts=True).select("rec.doc_id", "n_words", "n_removed", "kept_sha256", "kept")
    assert collected(out, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(expected, key=str)
    assert {r.kept for r in out.where("doc_id = 9").collect()} == {"tail one"}
    assert substring_dedup.remove_repeats(empty, ["doc_id"]).count() == 0


def test_substrings_of_hot_prefixes(spark, monkeypatch):
    """Groups beyond their size are split by longer prefixes, with the same result."""
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(45)]
    rows = []
    for i in range(60):
        start, end = rng.randint(0, 15), rng.randint(28, 45)
        rows.append((i, " ".join([f"u{i}a{j}" for j in range(40)] + passage[start:end] + [f"v{i % 3}b{j}" for j in range(30)])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [collected(substring_dedup.remove_repeats(df, ["doc_id"]), "rec", "n_removed", "kept_sha256")]
    monkeypatch.setattr(substring_dedup, "GROUP", 2)
    found.append(collected(substring_dedup.remove_repeats(df, ["doc_id"]), "rec", "n_removed", "kept_sha256"))
    assert found[0] == found[1] and any(r[1] for r in found[0])


def rows_joined(spark, run):
    """The most rows that one join made while run() ran, by Spark's own count."""
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    run()
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    most = 0
    for n in range(before, store.executionsCount()):
        i = store.executionsList().apply(n).executionId()
        values, nodes = store.executionMetrics(i), store.planGraph(i).allNodes()
        for node in (nodes.apply(k) for k in range(nodes.size())):
            metrics = node.metrics()
            for m in (metrics.apply(k) for k in range(metrics.size())):
                if "Join" in node.name() and m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    most = max(most, int(values.apply(m.accumulatorId()).replace(",", "")))
    return most


def test_substrings_of_a_frequent_line(spark, monkeypatch):
    """A line that fills texts: no join makes more rows than there are anchors, one for each time the line occurs."""
    monkeypatch.setattr(substring_dedup, "GROUP", 2)
    line, n = " ".join(f"l{j}" for j in range(12)), 40
    df = spark.createDataFrame([(i, f"u{i} " + f"{line} " * 60 + f"v{i}") for i in range(n)], "doc_id long, text string")
    out = []
    made = rows_joined(spark, lambda: out.extend(substring_dedup.remove_repeats(df, ["doc_id"]).collect()))
    assert {(r.n_words, r.n_removed) for r in out} == {(722, 720)}
    assert 0 < made <= 60 * n


def brute_links(rows, width, num, den):
    sets = []
    for _, t in rows:
        w = (t or "").encode().translate(LOWER).split()
        sets.append(frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) or (frozenset([tuple(w)]) if w else frozenset()))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def test_ngram_join(docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = ngram_join.join(docs, ["doc_id"]).select("rec.doc_id", "n_shingles", "component_id", "kept")
    assert collected(out, "doc_id", "n_shingles", "component_id") == brute_links(rows, 4, 85, 100)
    assert ngram_join.keep_one(docs).columns == docs.columns
    assert ngram_join.keep_one(docs, width=5, num=80, den=100).count() == out.where("kept").count()
    assert ngram_join.join(empty, ["doc_id"]).count() == 0


@pytest.mark.parametrize("short,rows,columns,sampled", [(256, 512, 2048, 16), (2, 3, 8, 1)])
def test_ngram_join_near_copies(spark, monkeypatch, short, rows, columns, sampled):
    """Families of edited copies; small limits force long columns, split blocks, and common n-grams."""
    for name, value in {"SHORT": short, "BLOCK_ROWS": rows, "COLUMNS": columns, "SAMPLED": sampled}.items():
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(4)
    texts = []
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(90)]
        for _ in range(12):
            own = list(base)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(len(own))] = f"n{rng.random()}"
            texts.append(" ".join(own))
    given = [(i, t) for i, t in enumerate(texts)]
    out = ngram_join.join(spark.createDataFrame(given, "doc_id long, text string"), ["doc_id"]).select("rec.doc_id", "n_shingles", "component_id")
    assert collected(out, "doc_id", "n_shingles", "component_id") == brute_links(given, 4, 85, 100)


def test_ngram_join_small_sets(spark):
    """Sets below OVERLAP elements link where the threshold lets them."""
    given = [(0, "a b"), (1, "a b c"), (2, "x"), (3, "x y"), (4, "q r s t"), (5, "q r s")]
    out = ngram_join.join(spark.createDataFrame(given, "doc_id long, text string"), ["doc_id"], width=1, num=60, den=100).select("rec.doc_id", "n_shingles", "component_id")
    assert collected(out, "doc_id", "n_shingles", "component_id") == brute_links(given, 1, 60, 100)


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, -7), (200, 200), (-7, 101)]
    roots = {r.id: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({roots[i] for i in range(51)}) == 1 and roots[100] == roots[-7] == roots[101] != roots[0] and 200 not in roots


def test_top_k(spark):
    rng = np.random.default_rng(1)
    base = [(i, [float(x) for x in rng.normal(size=4).round(1)]) for i in range(300)]
    bad = [(None, [1.0] * 4), (900, None), (901, [1.0, None, 0.0, 0.0]), (902, [float("nan")] * 4), (903, [float("inf")] * 4), (950, [1.0, 2.0]), (904, [3.0, 1.0]), (1000, []), (50, base[50][1]), (7, [1e7] * 4)]
    out = collected(ball_tree.top_k(spark.createDataFrame(base + bad, "vec_id long, embedding array<float>")), "query_id", "rank", "vec_id", "score")
    rows = [(k, i, [math.floor(256 * float(np.float32(x))) for x in v]) for k, (i, v) in enumerate(base + bad) if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = []
    for k, i, q in rows:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, x)), j) for m, j, x in rows if m != k and len(x) == len(q))[:5]
            expected += [(i, r, j, -s) for r, (s, j) in enumerate(scored, 1)]
    assert out == sorted(expected, key=str)
    assert ball_tree.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_top_k_in_rounds(spark, monkeypatch):
    """Many shards and rounds of queries: the result is that of brute force, and no join repeats queries for each shard."""
    for name, value in {"SHARD": 16, "LEAF": 4, "BLOCK": 4, "ROUND": 16}.items():
        monkeypatch.setattr(ball_tree, name, value)
    n = 4000
    x = np.random.default_rng(3).integers(-40, 40, (n, 3))
    df = spark.createDataFrame([(i, [float(c) / 256 for c in r]) for i, r in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    out = []
    made = rows_joined(spark, lambda: out.extend(collected(ball_tree.top_k(df), "query_id", "rank", "vec_id", "score")))
    expected = []
    for i in range(0, n, 50):
        scores = x @ x[i]
        best = [j for j in np.lexsort((np.arange(n), -scores)).tolist() if j != i][:5]
        expected += [(i, r, j, int(scores[j])) for r, j in enumerate(best, 1)]
    assert out == sorted(expected, key=str)
    assert made < n


def test_bpe(docs, empty):
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    expected = []
    for r in docs.collect():
        ids = enc.encode_ordinary(r.text or "")
        expected.append((r.doc_id, len(ids), sha(" ".join(map(str, ids)).encode()), sha((r.text or "").encode())))
    out = bpe.encode_documents(docs, RANKS, PATTERN, ids=True, text=True)
    assert collected(out, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=str)
    assert sorted(r.decoded for r in out.collect()) == sorted(r.text or "" for r in docs.collect())
    assert bpe.encode_documents(empty, RANKS, PATTERN).count() == 0


def test_bpe_digest_is_of_the_stream(monkeypatch):
    fed = []

    class Stream(bpe.Utf8Stream):
        def feed(self, block):
            fed.append(block)
            return super().feed(block)

    monkeypatch.setattr(bpe, "Utf8Stream", Stream)
    raw = "é 漢字 🙂 text".encode()
    row = bpe.encode_row(bpe.Encoder(RANKS, PATTERN), raw)
    assert b"".join(fed) == raw and row[2] == sha(raw)


def test_bpe_fuzz(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_STATES", 50)
    monkeypatch.setattr(bpe, "MOST_PIECES", 20)
    mine, enc, rng = bpe.Encoder(RANKS, PATTERN), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={}), random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("abcdest  \n\t'AB01é漢🙂…!#\u200b") for _ in range(rng.randint(1, 60)))
        assert [int(i) for b in mine.encode(text) for i in b.split(" ")] == enc.encode_ordinary(text)
        raw, stream, got = text.encode(), bpe.Utf8Stream(), ""
        while raw:
            cut = rng.randint(1, 3)
            got, raw = got + stream.feed(raw[:cut]), raw[cut:]
        assert got + stream.close() == text


def test_decontamination(spark, docs, empty):
    items = [("i1", " ".join(f"P{i}" for i in range(5, 25))), ("i2", "q1, Q2 q3"), ("i2", "one"), ("i3", None), ("i4", ""), (None, "same text twice"), ("i5", "nowhere at all to be found in any of these rows here")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    windows = [(i, tuple(w[k : k + 10])) for i, t in items for w in [decontamination.normal_words((t or "").encode())] if w for k in range(max(1, len(w) - 9))]
    expected = []
    for r in docs.collect():
        w, hit, own = decontamination.normal_words((r.text or "").encode()), set(), set()
        for i, win in windows:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    own |= {i} if i else set()
        expected.append((r.doc_id, len(w), len(hit), len(own), sha(",".join(sorted(own)).encode()), bool(hit)))
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    for block in (1 << 20, 30):
        assert collected(decontamination.summary(decontamination.find_benchmark_text(docs, bench, block_bytes=block)), *columns) == sorted(expected, key=str)
        kept = decontamination.drop_contaminated(docs, bench, block_bytes=block)
        assert kept.columns == docs.columns and kept.count() == sum(not e[-1] for e in expected)
    assert decontamination.summary(decontamination.find_benchmark_text(empty, bench)).count() == 0
    assert not any(r.contaminated for r in decontamination.summary(decontamination.find_benchmark_text(docs, bench.limit(0))).collect())


def test_urls(spark):
    urls = [None, "", "no scheme", "http://A.NET/x?y#z", "http://net", "http://xnet/a", "https://a.example.NET/en/1", "https://example.net/de/", "http://b.example.com/de/x", "http://example.com/fr/", "http://w.org/fr/#a", "http://org/f", "://", "x://h?q=/en/", "http://é.net/ü"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(0, "http://a.net/", "h")], "page_id long, url string, host string")
    out = {(r.page_id, r.host): (r.path, r.rule, r.verdict) for r in url_filter.judge(df).collect()}
    assert out[3, "a.net"] == ("/x", "net/", "block") and out[4, "net"] == ("", None, "allow") and out[5, "xnet"][1] is None
    assert out[6, "a.example.net"] == ("/en/1", "example.net/en/", "allow") and out[7, "example.net"][1] == "net/" and out[8, "b.example.com"][2] == "block" and out[10, "w.org"][1] == "org/fr/"
    assert out[0, ""] == ("", None, "allow") and out[13, "h"] == ("", None, "allow") and len(out) == len(urls) + 1
    assert collected(url_filter.judge(df, shard_bytes=30), "page_id", "host", "path", "rule", "verdict") == collected(url_filter.judge(df), "page_id", "host", "path", "rule", "verdict")
    assert url_filter.judge(df.limit(0)).count() == 0


def test_lm(docs, empty):
    rows = [(r.doc_id, (r.text or "").encode().translate(LOWER).split() + [b""]) for r in docs.collect()]
    held = [common.is_held_out(d, 10) for d, _ in rows]
    c = Counter(w for (_, ws), h in zip(rows, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    out = ppm.score_documents(docs).collect()
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out), key=str)
    assert got == sorted(((d, h, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for (d, ws), h in zip(rows, held)), key=str)
    assert all(r.score < 0 for r in out) and ppm.score_documents(empty).count() == 0


def test_ppm_is_a_probability():
    """After any context the bytes' probabilities sum to one, pruned nodes or not; the memo changes nothing."""
    seq = [ppm.grams(ppm.sequence(t.encode().split())) for t in ("abracadabra abra", "banana bandana", "abra banana cab")]
    keys, counts = np.unique(np.concatenate(seq), return_counts=True)
    for least in (1, 2):
        nodes = []
        for k in range(ppm.ORDER + 1):
            u, at = np.unique(keys & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
            n = np.bincount(at, counts)
            nodes.append((u[n >= least], n[n >= least]))
        trie = ppm.Trie(nodes)
        for context in (b"\n\n\n\n\n", b"abrac", b"xxxxa", b"xxxxx", b"anana", b"bra b"):
            g = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
            p = 10 ** trie.log_probability(g)
            assert abs(p.sum() - 1) < 1e-9, (least, context, p.sum())
        scorer = ppm.Scorer(trie, bits=2)
        assert np.array_equal(scorer(keys), scorer(keys)) and np.allclose(scorer(keys), trie.log_probability(keys))


def test_lm_counts_every_gram(spark, docs, monkeypatch):
    """Scores are those of the trie of all training grams, whatever is broadcast; a rare context stays known as the corpus grows."""
    df = docs.select("doc_id", "text")
    filler = spark.range(1000, 1400).selectExpr("id AS doc_id", "repeat('common words here ', 400) AS text")
    df = df.union(filler)
    rows = [(r.doc_id, ppm.grams(ppm.sequence((r.text or "").encode().translate(LOWER).split()))) for r in df.collect()]
    keys, counts = np.unique(np.concatenate([g for d, g in rows if not common.is_held_out(d, 10)]), return_counts=True)
    trie = ppm.Trie([ppm._node(keys, counts, k) for k in range(ppm.ORDER + 1)])
    expected = sorted(((d, round(float(trie.log_probability(g).sum()), 5)) for d, g in rows), key=str)
    assert counts.sum() > 1 << 20
    for most, block in ((1 << 20, 500_000), (50, 100)):
        monkeypatch.setattr(ppm, "MOST_GRAMS", most)
        monkeypatch.setattr(ppm, "BLOCK", block)
        assert sorted(((r.doc_id, round(r.score, 5)) for r in ppm.score_documents(df).collect()), key=str) == expected


def accuracy(spark, module, label, fit, scored, threshold):
    folder = "/root/testdata/sf0.01"
    docs, labels = common.table(spark, folder, "documents"), common.table(spark, folder, "labels")
    truth = {r.doc_id: r[label] for r in labels.collect()}
    rows = [(r.score, truth[r.doc_id]) for r in scored(docs, fit(docs, labels)).where("held_out").collect() if r.doc_id in truth]
    return np.mean([(s >= threshold) == bool(y) for s, y in rows])


def test_classifiers(spark, docs, empty):
    assert accuracy(spark, nb_linear, "toxic", nb_linear.train, nb_linear.score_toxicity, 0.5) > 0.9
    assert accuracy(spark, byte_cnn, "quality", byte_cnn.train, byte_cnn.score_quality, 0.3) > 0.85
    linear, net = nb_linear.fit([b"bad", b"good"] * 8, np.array([1, 0] * 8)), byte_cnn.fit([b"bad" * 9, b"good"] * 4, np.array([0, 1] * 4), epochs=1)
    for out in (nb_linear.score_toxicity(docs, linear), byte_cnn.score_quality(docs, net)):
        assert out.count() == docs.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in out.collect())
    assert nb_linear.score_toxicity(empty, linear).count() == byte_cnn.score_quality(empty, net).count() == 0
    assert byte_cnn.keep_good(docs, net).columns == docs.columns
    assert 0 < nb_linear.score(b"x", *nb_linear.fit([], np.zeros(0))) < 1


def test_toxicity_learns_from_whole_texts(spark):
    long = "clean words " * 6000 + "bad end"
    docs, labels = spark.createDataFrame([(i, long) for i in range(1, 4)], "doc_id long, text string"), spark.createDataFrame([(i, 1) for i in range(1, 4)], "doc_id long, toxic int")
    found = nb_linear.labelled(docs, labels, "toxic", 10)
    assert found and all(text == long.encode() for _, text, _ in found)
    assert np.array_equal(nb_linear.present(long.encode() * 20), np.unique(nb_linear.features(long.encode() * 20)))


def test_toxicity_features_are_of_characters():
    """As many n-grams in any script: one for each place of a character."""
    for text in ("abcdefgh", "абвгдежз", "漢字仮名交文章語", "🙂🙃😀😁😂😃😄😅"):
        assert len(nb_linear.features(text.encode())) == sum(8 + 2 - n + 1 for n in nb_linear.LENGTHS)


def test_cnn_gradients():
    m = {k: v.astype(np.float64) for k, v in byte_cnn.new_model(3).items()}
    raw = bytes(np.random.default_rng(0).integers(32, 120, 1500, dtype=np.uint8))
    g = byte_cnn._gradients([raw], np.ones(1), m, np.ones(1))[1]
    for k, at in {"embed": (raw[5], 2), "conv": (3, 4), "dense": (40, 5), "out": (2,), "out_b": (0,)}.items():
        old, loss = m[k][at], []
        for d in (1e-5, -1e-5):
            m[k][at] = old + d
            loss.append(-np.log(byte_cnn._forward([raw], m)[0]))
        m[k][at] = old
        assert abs((loss[0] - loss[1]) / 2e-5 - g[k][at]) < 1e-4


def test_cnn_learns_from_whole_texts(spark, monkeypatch):
    texts = {i: "clean words " * 1000 + "bad end" * (i % 2) for i in range(20)}
    docs, labels = spark.createDataFrame(list(texts.items()), "doc_id long, text string"), spark.createDataFrame([(i, 1 - i % 2) for i in texts], "doc_id long, quality int")
    seen = []
    with monkeypatch.context() as patch:
        patch.setattr(byte_cnn, "fit", lambda given, _: seen.extend(given))
        byte_cnn.train(docs, labels)
    assert sorted(seen) == sorted(t.encode() for i, t in texts.items() if not common.is_held_out(i, nb_linear.MODULUS))
    m, raw = {k: v.astype(np.float64) for k, v in byte_cnn.new_model(3).items()}, bytes(np.random.default_rng(0).integers(32, 120, 3000, dtype=np.uint8))
    p, whole = byte_cnn._gradients([raw], np.ones(1), m, np.ones(1))
    monkeypatch.setattr(byte_cnn, "BLOCK", 2 * byte_cnn.HALF)
    q, blocks = byte_cnn._gradients([raw], np.ones(1), m, np.ones(1))
    assert abs(p - q) < 1e-9 and all(np.allclose(whole[k], blocks[k], atol=1e-6) for k in m)


def test_licenses(docs, empty):
    out = {r.doc_id: r for r in license_scan.scan(docs.where("doc_id IS NOT NULL")).collect()}
    assert out[15].licenses == "MIT-notice" and out[15].best_coverage == 1 and out[0].n_matches == 0 and license_scan.scan(empty).count() == 0
    t = license_scan.Templates(license_scan.TEMPLATES, 0.8)
    words = license_scan.words_of(license_scan.TEMPLATES["MIT"].encode())
    edited = [w for i, w in enumerate(words) if i % 15] + [b"x"] * 50 + words
    assert [m[0] for m in t.matches([b"a"] * 30 + edited)] == ["MIT", "MIT"]
    pairs = license_scan.align(list("xabcydefz"), list("abcdefg"))
    assert pairs == sorted(pairs) and all(list("xabcydefz")[i] == list("abcdefg")[j] for i, j in pairs) and len(pairs) == 6


def test_pipeline_writes_tokens(spark, docs):
    import corpus_pipeline

    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    out = corpus_pipeline.encode(spark, docs, "")
    assert sorted(r.ids for r in out.collect()) == sorted(enc.encode_ordinary(r.text or "") for r in docs.collect())


def test_licenses_that_repeat():
    """Each of several consecutive notices is found, after other text, whole or edited."""
    t = license_scan.Templates(license_scan.TEMPLATES, 0.8)
    for head in ("", "x ", "some other words "):
        for text, size in (("Released under the MIT License. ", 5), ("All rights reserved. ", 3), ("Released xx under the MIT License. ", 6)):
            for n in (1, 2, 3, 50):
                found = t.matches(license_scan.words_of((head + text * n + "y all").encode()))
                first = len(head.split())
                assert [m[1:] for m in found] == [(1.0, first + i * size, first + (i + 1) * size) for i in range(n)]
    assert [m[2:] for m in t.matches(license_scan.words_of(b"x All rights reserved. All rights reserved. y all"))] == [(1, 4), (4, 7)]


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        assert after.columns == docs.columns or name == corpus_pipeline.STAGES[-1][0]
        assert 0 < after.count() <= before
        docs, before = after, after.count()
    assert {r.n_tokens >= 0 for r in docs.collect()} == {True}
