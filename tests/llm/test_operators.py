"""Each operator on a small corpus, against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kindred.llm import components, fitting, jaccard, language, lm, media, packing, positional, pseudonyms, sharding, toxicity, urlfilter


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def spaced(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t))


def twice(df):
    return df.union(df.where("doc_id in (3, 200, 205)"))


def test_media(corpus, nothing):
    rows = media.read_webp(media.store_as_webp(twice(corpus)), keep_pixels=True).collect()
    assert len(rows) == corpus.count() + 3
    want = {i: (t or "").encode() for i, t in texts_of(corpus)}
    for r in rows:
        payload = want[r.doc_id].ljust(max(64, -(-len(want[r.doc_id]) // 64) * 64), b"\0")
        assert (r.n_bytes, r.payload_bytes, bytes(r.pixels)) == (len(want[r.doc_id]), len(payload), payload)
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])
    assert media.read_webp(media.store_as_webp(nothing)).count() == 0
    lost = media.store_as_webp(corpus.limit(1)).withColumn("media", F.lit(None).cast("binary")).withColumn("feature", F.lit("x"))
    assert media.read_webp(lost).first().payload_bytes is None


def test_pseudonyms(spark, corpus, nothing):
    df = spark.createDataFrame([(1, "a 4539578763621486", 7), (2, None, 7), (3, "4539 5787 6362 1486", 7), (None, "", 7)], "doc_id long, text string, spans int")
    rows = {r.doc_id: r for r in pseudonyms.pseudonymise(df, "key").collect()}
    assert rows[1].text[2:] == rows[3].text.replace(" ", "") != "4539578763621486"
    assert rows[2].text is None and rows[None].n_replaced == 0 and [tuple(s) for s in rows[1].spans] == [(2, 18, "card")]
    assert pseudonyms.pseudonymise(corpus, "key").columns == [*corpus.columns, "spans", "n_replaced"]
    assert pseudonyms.pseudonymise(nothing, "key").count() == 0
    again = [r.text for r in pseudonyms.pseudonymise(df.union(df), "key").where("doc_id = 1").collect()]
    assert again == [rows[1].text] * 2 and [r.text for r in pseudonyms.pseudonymise(df, "other").where("doc_id = 1").collect()] != again[:1]
    with pytest.raises(ValueError):
        pseudonyms.pseudonymise(df, "")


ITEMS = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "one two"), (3, ""), (4, None), (10, "the-the the"), (5, "Alpha beta gamma delta epsilon zeta eta theta iota kappa mu")]


def plain_hits(docs, items, width):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    runs = [(i, cut(t)) for i, t in items]
    windows = [(i, w[k : k + width]) for i, w in runs if w for k in range(max(1, len(w) - width + 1))]
    for doc_id, t in docs:
        w = cut(t)
        at = {(i, p, len(x)) for i, x in windows for p in range(len(w) - len(x) + 1) if w[p : p + len(x)] == x}
        found = sorted({str(i) for i, _, _ in at})
        hit = len({q for _, p, n in at for q in range(p, p + n)})
        yield doc_id, len(w), hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0


@pytest.mark.parametrize(("rows", "size"), [(10**6, 10**6), (1, 10**6), (10**6, 3)])
def test_contamination(spark, corpus, nothing, monkeypatch, rows, size):
    """With small tables broadcast, and with shuffled joins only."""
    monkeypatch.setattr(positional, "MAX_BROADCAST", rows)
    monkeypatch.setattr(positional, "MAX_BYTES", size)
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")
    extra = spark.createDataFrame(
        [(300, "x ALPHA,beta gamma delta epsilon zeta eta theta iota kappa y alpha beta"), (301, "the the the the"), (302, "one one two two"), (None, "one two"), (303, "alpha beta gamma delta epsilon zeta eta theta iota kappa mu kappa lambda")],
        "doc_id long, text string",
    )
    docs = corpus.select("doc_id", "text", F.lit(1).alias("doc"), F.lit(2).alias("term")).unionByName(extra, allowMissingColumns=True)
    want = sorted(plain_hits(texts_of(docs), ITEMS, 10), key=repr)
    assert sorted(map(tuple, positional.contamination(docs, items).collect()), key=repr) == want
    assert positional.contamination(twice(docs), items).count() == docs.count() + 3
    assert positional.contamination(nothing, items).count() == 0
    assert positional.contamination(corpus, items.limit(0)).where("contaminated or n_hit > 0").count() == 0
    kept = positional.without_contaminated(docs, items)
    assert kept.columns == docs.columns and {300, 303} & {r.doc_id for r in kept.collect()} == set() and kept.count() == docs.count() - 2


def test_documents_made_of_short_items_go(spark, tmp_path):
    texts = [(1, "One, two"), (2, "one two three"), (3, "one two three four"), (4, "one two three four five"), (5, "x a b c d e"), (6, "plain"), (7, "one two the one two"), (None, "one two"), (8, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two"), (2, "a b c d e"), (3, ""), (4, None)], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = corpus_pipeline.drop_benchmark(spark, docs, str(tmp_path))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 4, 6, 8, None]
    assert positional.without_contaminated(docs, items).count() == len(texts) - 1
    assert positional.without_contaminated(docs, items.where("item_id > 1"), short_share=0.5).count() == len(texts) - 1


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x b x x a"), (2, "b x x x a"), (3, "a b c"), (4, None)], "doc_id long, text string")
    queries = spark.createDataFrame([(7, ["a", "b"]), (8, ["a", "zz"]), (9, ["a", "a"])], "query_id long, words array<string>")
    index = positional.build_index(docs, queries.select(F.explode("words").alias("word")))
    found = {(r.doc, r.query_id): r.start for r in positional.find_near(index, queries, 3).collect()}
    assert found == {(1, 7): 0, (3, 7): -1, (1, 9): -2, (2, 9): 2, (3, 9): -2}


def test_packing(corpus, nothing):
    caps = packing.Capacities(256)
    docs = twice(corpus)
    packed = packing.pack_documents(docs, caps, keep_ids=True)
    rows = packed.collect()
    ids = packing.encoder(None)
    whole = Counter()
    for doc_id, t in texts_of(docs):
        own = ids(t or "") + (1).to_bytes(4, "little")
        for k, at in enumerate(range(0, len(own), 1024)):
            whole[(doc_id, k, at // 4, len(own[at : at + 1024]) // 4, zlib.crc32(own[at : at + 1024]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == whole
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 256
    assert len(bins) <= -(-sum(r.length for r in rows) // 256) * 1.05 + 1
    assert packing.pack_documents(nothing, caps).count() == 0
    built = {r.sequence_id: len(bytes(r.ids)) // 4 for r in packing.sequences(packed).collect()}
    assert built == {k: sum(n for _, n in own) for k, own in bins.items()}


@pytest.mark.parametrize("most", [0, 10**6])
def test_packing_under_all_capacities(corpus, monkeypatch, most):
    """Documents and attention bind here, and the plan is joined both as a broadcast and by parts."""
    monkeypatch.setattr(packing, "MAX_PLAN_ROWS", most)
    caps = packing.Capacities(256, documents=3, attention=256 * 200, weights=(1, 0.5, 0.5), rule="dot")
    docs = corpus.withColumn("offset", F.lit("old")).withColumn("_rank", F.lit("old"))
    pieces = packing.token_pieces(docs, 200)
    rows = packing.pack(pieces.withColumn("offset", F.lit("old")), caps, ["doc_id", "piece", "ids_crc32"]).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(rows) == pieces.count()
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert len(own) <= 3 and sum(n for _, n in own) <= 256 and sum(n * n for _, n in own) <= 256 * 200
    assert max(len(own) for own in bins.values()) == 3
    tokens_only = packing.pack(pieces, packing.Capacities(256), ["doc_id", "piece", "ids_crc32"])
    assert tokens_only.select("sequence_id").distinct().count() <= len(bins)


def test_language(corpus, nothing):
    train = F.col("doc_id") % 4 != 2
    rows = {r.doc_id: r for r in language.predict_language(corpus, train).collect()}
    held = [r for r in corpus.where("doc_id < 160 and doc_id % 4 = 2").collect()]
    assert sum(rows[r.doc_id].lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert [rows[k].lang_pred for k in (200, 201, 202, 203)] == ["und"] * 4 and rows[200].score == 0
    assert all(0 <= r.score <= 1 for r in rows.values()) and len(rows) == corpus.count()
    assert language.predict_language(nothing, train).count() == 0
    unlearned = language.predict_language(corpus.withColumn("lang", F.lit(None).cast("string")), train)
    assert {r.lang_pred for r in unlearned.collect()} == {"und"}


def test_small_languages_and_rare_words_are_learned(spark):
    rows = [(k, f"common word number{chr(97 + k % 26)} the of", "en") for k in range(600)] + [(1000 + k, "zwar doch nun eben", "de") for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.predict_language(docs, F.lit(True), max_train_rows=20).where("doc_id >= 1000").collect()
    assert [r.lang_pred for r in found] == ["de"] * 4
    many = docs.union(docs.where("doc_id >= 1000").select(F.lit(1000).alias("doc_id"), F.concat("text", F.lit(" "), F.col("doc_id").cast("string")), "lang").crossJoin(spark.range(50)).drop("id"))
    sample = fitting.one_row_each(many, many.select("doc_id").distinct().limit(10_000))
    assert sample.count() == docs.count() == sample.select("doc_id").distinct().count()
    assert [r.lang_pred for r in language.predict_language(docs.union(docs.where("doc_id = 1001")), F.lit(True), 20).where("doc_id = 1001").collect()] == ["de"] * 2
    ids, n_rows = language.sample_by_language(docs.union(docs.where("doc_id = 7")), 20)
    kept = {r.doc_id for r in ids.collect()}
    assert len(kept) == 20 and {1000, 1001, 1002, 1003} <= kept and n_rows == {"en": 601, "de": 4}
    assert language._quotas({"a": 5, "b": 100, "c": 1}, 50) == {"c": 1, "a": 5, "b": 44}
    keys = np.arange(500_000, dtype=np.uint64)
    assert len(language._merged([(keys, np.ones((len(keys), 2)))]).keys) == len(keys)


def test_shards(corpus, nothing):
    docs = twice(corpus)
    rows = sharding.shard_by_bytes(docs, 7).collect()
    text_of = dict(texts_of(corpus))
    by_text, sums = {}, Counter()
    for r in rows:
        t = text_of[r.doc_id]
        assert r.size == len((t or "").encode()) + 16 and r.text_crc32 == zlib.crc32((t or "").encode())
        by_text.setdefault(t, set()).add(r.shard)
        sums[r.shard] += r.size
    assert all(len(s) == 1 for s in by_text.values()) and len(rows) == docs.count()
    for s in sums:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    keyed = sharding.shard_by_bytes(docs, 7)
    assert keyed.count() == len(rows) and sharding.shard_by_bytes(nothing, 7).count() == 0
    one = sharding.shard_by_bytes(corpus.where("doc_id = 3"), 5).collect()
    assert [(r.slot) for r in one] == [0]


def test_least_capacity_is_exact_with_few_bits(spark, monkeypatch):
    """With a top level of two runs, nearly every cut is found by splitting runs."""
    r = random.Random(9)
    rows = sorted((r.randrange(-(2**63), 2**63), r.randrange(1, 500)) for _ in range(300))
    monkeypatch.setattr(sharding, "TOP_BITS", 1)
    df = spark.createDataFrame(rows, "key long, bytes long")
    for shards in (1, 3, 40):

        def fits(c):
            n, left = 1, c
            for _, x in rows:
                if x > left:
                    n, left = n + 1, c
                left -= x
            return n <= shards

        low, high = max(x for _, x in rows), sum(x for _, x in rows)
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if fits(middle) else (middle + 1, high)
        capacity, keys = sharding.minimax_cuts(df, shards)
        sums = Counter()
        for k, x in rows:
            sums[sum(k >= e for e in keys)] += x
        assert capacity == low and max(sums.values()) <= low


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def test_url_rules(spark):
    cases = {
        "http://a.example.com/en/1?x": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "https://WWW.Example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://example.com/EN/": ("example.com", "/EN/", "com/", "allow"),
        "https://notexample.com/en/1": ("notexample.com", "/en/1", "com/", "allow"),
        "http://x.net/es/#a": ("x.net", "/es/", "net/es/", "block"),
        "http://x.net": ("x.net", "", None, "allow"),
        "http://com": ("com", "", None, "allow"),
        "nothing": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
        "a://b.com?c://d.net/es/": ("b.com", "", None, "allow"),
    }
    df = spark.createDataFrame([(k, u, "old") for k, u in enumerate([*cases, None, next(iter(cases))])], "page_id long, url string, rule string")
    rows = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(df, RULES).collect()}
    assert [rows[k] for k in range(len(cases))] == list(cases.values())
    assert rows[len(cases)] == ("", "", None, "allow") and rows[len(cases) + 1] == rows[0]
    assert urlfilter.judge(df.limit(0), RULES).count() == 0
    assert {r.verdict for r in urlfilter.judge(df, []).collect()} == {"allow"}


def test_rules_with_both_verdicts_capitals_and_equal_lengths(spark):
    df = spark.createDataFrame([(1, "http://x.ab.com/q/1"), (2, "http://x.ab.com/"), (3, "http://ab.com/q/")], "page_id long, url string")
    rules = [("allow", "AB.com/q/"), ("block", "ab.com/q/"), ("allow", "ab.com/"), ("block", "x.ab.com/")]
    rows = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge(df, rules).collect()}
    assert rows == {1: ("ab.com/q/", "block"), 2: ("x.ab.com/", "block"), 3: ("ab.com/q/", "block")}


def test_cascades_are_exact_over_their_universe(spark):
    universe = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key")).union(spark.createDataFrame([(None,)], "key string"))
    lists = {"a": universe.where("key like 'k7%'"), "b": universe.where("key like '%3'").union(spark.createDataFrame([("outside",)], "key string")), "c": universe.limit(0)}
    cascades = urlfilter.build_cascades(lists, universe, rate=0.2)
    assert len(cascades["a"]) > 2 and len(cascades["b"]) > 2 and cascades["c"] == []
    for name, like in (("a", "k7%"), ("b", "%3"), ("c", "")):
        assert universe.where(urlfilter.is_listed(F.col("key"), cascades[name]) != F.col("key").like(like)).count() == 0
    with pytest.raises(ValueError):
        urlfilter.build_cascades(lists, universe, max_bits=70)


def plain_components(docs, width, percent):
    sets = {}
    for i, t in docs:
        w = spaced(t)
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("bucket", [2, 16])
def test_similarity_components(spark, corpus, nothing, monkeypatch, bucket):
    monkeypatch.setattr(jaccard, "LARGE_BUCKET", bucket)
    base = [f"w{k}" for k in range(60)]
    near = [(400 + k, " ".join(base[: 60 - k] + [f"x{k}"] * (k % 3))) for k in range(24)]
    docs = corpus.select("doc_id", "text", "node").unionByName(spark.createDataFrame(near, "doc_id long, text string"), allowMissingColumns=True)
    for width, percent in ((4, 85), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similarity_components(docs, width, percent).collect()}
        assert got == plain_components(texts_of(docs), width, percent)


def edited_copies(first, many, base, edits):
    """Copies of a text with 0 to `edits` words of their own, so that most share tokens and few link."""
    r = random.Random(first)
    for k in range(many):
        words = list(base)
        for at in r.sample(range(len(words)), k % (edits + 1)):
            words[at] = f"own{first}x{k}x{at}"
        yield first + k, " ".join(words)


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_hot_buckets_in_which_most_pairs_do_not_link(spark, width, percent):
    a, b = [f"a{k}" for k in range(90)], [f"b{k}" for k in range(40)]
    texts = [*edited_copies(0, 90, a, 9), *edited_copies(100, 40, b, 6), *edited_copies(200, 30, a[:50] + b, 5)]
    docs = spark.createDataFrame([*texts, (1000, texts[5][1]), (None, texts[6][1])], "doc_id long, text string")
    got = jaccard.similarity_components(docs, width, percent).collect()
    want = plain_components([*texts, (1000, texts[5][1])], width, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    alone = [i for i, (_, c) in want.items() if c == i]
    assert 30 < len(alone) < 150
    assert [(r.n_shingles, r.component_id) for r in got if r.doc_id is None] == [want[6]]


def test_each_order_has_a_prefix_of_every_linked_pair():
    """The bounds that the joins use, against whole intersections."""
    r = np.random.default_rng(5)
    for _ in range(300):
        n, percent = int(r.integers(1, 120)), int(r.choice([60, 80, 85, 100]))
        a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[r.random(len(a)) < r.uniform(0.7, 1)], r.integers(0, 2**63, int(r.integers(0, 9))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not both or 100 * both < percent * (len(a) + len(b) - both):
            continue
        often = {int(t): int(x) for t, x in zip(a, r.integers(0, 511, len(a)))} | {int(t): 7 for t in b if t not in a}
        need = jaccard.needed(len(a), len(b), percent)
        assert both >= need and jaccard.linked(a, b, percent)
        for k, seed in enumerate(jaccard.ORDER_SEEDS):
            x, y = (s[jaccard.prefix_of(s, np.array([often[int(t)] for t in s]), seed, percent)] for s in (a, b))
            common = [(int(np.flatnonzero(x == t)[0]), int(np.flatnonzero(y == t)[0])) for t in np.intersect1d(x, y)]
            i, j = min(common)
            assert len(a) - i >= need and len(b) - j >= need
            if k:
                p, q = jaccard.signature(x, seed).view(np.uint64), jaccard.signature(y, seed).view(np.uint64)
                most = min(len(x) - int(np.bitwise_count(p & ~q).sum()), len(y) - int(np.bitwise_count(q & ~p).sum()))
                assert len(common) <= most and most + max(len(a) - len(x), len(b) - len(y)) >= need


def test_similarity_components_of_odd_tables(corpus, nothing):
    assert jaccard.similarity_components(nothing).count() == 0
    assert jaccard.similarity_components(twice(corpus), 4, 85).count() == corpus.count() + 3
    kept = jaccard.one_of_each(twice(corpus))
    want = plain_components(texts_of(corpus), 5, 80)
    assert kept.columns == corpus.columns and {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if c == i}


@pytest.mark.parametrize("few", [0, 10**6])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW_EDGES", few)
    links = [(k, k + 1) for k in range(20)] + [(30, 40), (40, 35), (7, 7)] + [(50, 60 + k) for k in range(9)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(21)}, 30: 30, 35: 30, 40: 30, 50: 50, **{60 + k: 50 for k in range(9)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
    again = components.components(spark.createDataFrame([(1, 1)], "a long, b long"))
    assert again.count() == 0


def plain_scores(texts, train, extra, order):
    """Counts by dictionaries of word tuples; the shares by the operator's own expectation-maximisation, fed with these counts."""
    runs = {i: [[("",) * k + tuple([*spaced(t), "</s>"]), k] for k in range(order)] for i, t in texts.items()}
    grams = lambda i, k: [tuple(runs[i][k][0][p : p + k + 1]) for p in range(len(runs[i][k][0]) - k)]
    every, kept = ([Counter() for _ in range(order)] for _ in range(2))
    for i in texts:
        for k in range(order):
            if i in train:
                every[k].update(grams(i, k))
                if i not in extra:
                    kept[k].update(grams(i, k))
    types = len(every[0])

    def counts(i, of):
        mine = [grams(i, k) for k in range(order)]
        contexts = [[sum(of[0].values())] * len(mine[0])]
        for k in range(1, order):
            contexts.append([of[k - 1][g[:-1]] if any(g[:-1]) else of[0][("</s>",)] for g in mine[k]])
        return lm.Counts([np.array([float(of[k][g]) for g in mine[k]]) for k in range(order)], [np.array(c, float) for c in contexts], np.array([len(mine[0])]))

    weights = np.zeros((0, lm.BUCKETS))
    for _ in range(order):
        found = Counter()
        for i in extra:
            for code, n in zip(*lm.events(counts(i, kept), weights, types), strict=True):
                found[int(code)] += int(n)
        codes = np.array(sorted(found), np.int64)
        weights = np.vstack([weights, lm.mixture_weights(codes, np.array([found[c] for c in codes.tolist()], np.int64))])
    return {i: float(np.log10(lm.estimates(counts(i, every), weights, types)[0]).sum()) for i in texts}


@pytest.mark.parametrize("order", [1, 2, 3])
def test_interpolated_scores(corpus, monkeypatch, order):
    monkeypatch.setattr(lm, "BATCH_BYTES", 3000)
    train = F.col("doc_id") % 7 != 2
    rows = {r.doc_id: r for r in lm.interpolated_scores(corpus, train, order, extra_share=4).collect()}
    tokens = {i: [*spaced(t), "</s>"] for i, t in texts_of(corpus)}
    counts = Counter(w for i, own in tokens.items() if i % 7 != 2 for w in own)
    total, kinds = sum(counts.values()), len(counts)
    extra = {r.doc_id for r in corpus.where(train & (F.pmod(F.xxhash64("doc_id", F.lit("held-out counts")), F.lit(4)) == 0)).collect()}
    want = plain_scores(dict(texts_of(corpus)), {i for i in tokens if i % 7 != 2}, extra, order)
    assert len(rows) == len(tokens)
    for i, own in tokens.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i % 7 == 2, len(own), sum(w in counts for w in own), total)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own), rel_tol=1e-9)
        assert math.isclose(r.score, want[i], rel_tol=1e-9)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_interpolated_scores_over_several_hops(corpus, nothing, monkeypatch):
    train = F.col("doc_id") % 7 != 2
    once = {r.doc_id: r.score for r in lm.interpolated_scores(corpus, train, extra_share=4).collect()}
    monkeypatch.setattr(lm, "BATCH_BYTES", 2000)
    monkeypatch.setattr(lm, "MAX_FAN", 4)
    hops = []
    passed = lm._passed_on
    monkeypatch.setattr(lm, "_passed_on", lambda *a: hops.append(a[2]) or passed(*a))
    again = {r.doc_id: r.score for r in lm.interpolated_scores(corpus, train, extra_share=4).collect()}
    assert len(hops) >= 2 and set(again) == set(once)
    assert all(math.isclose(again[i], once[i], rel_tol=1e-9) for i in once)
    assert lm.interpolated_scores(nothing, train).count() == 0
    rows = twice(corpus).unionByName(corpus.where("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    scored = lm.interpolated_scores(rows, train).collect()
    assert len(scored) == len(once) + 4 and sum(r.doc_id is None for r in scored) == 1
    assert len({r.score for r in scored if r.doc_id == 3}) == 1
    with pytest.raises(ValueError):
        lm.interpolated_scores(corpus, train, order=8)


def test_what_is_sent_grows_with_the_batches(corpus, monkeypatch):
    """Rows for each batch and hop are at most MAX_FAN, however many batches there are."""
    monkeypatch.setattr(lm, "MAX_FAN", 4)
    every = F.lit(True)
    for size in (4000, 1000, 500):
        monkeypatch.setattr(lm, "BATCH_BYTES", size)
        batches = lm.settle(lm._batches(corpus, every, F.lit(False)), "batches")
        n = batches.count()
        tables = []
        monkeypatch.setattr(lm, "settle", lambda df, name, keep=lm.settle: tables.append((name, out := keep(df, name))) or out)
        lm._exchanged(batches, 3)
        monkeypatch.undo()
        monkeypatch.setattr(lm, "MAX_FAN", 4)
        sent = [t.count() for name, t in tables if name == "sent"]
        assert sent and all(x <= 4 * n * 2 for x in sent), (n, sent)


def test_toxicity(spark, corpus, nothing):
    labels = corpus.where("doc_id < 160").select("doc_id", F.coalesce(F.col("text").contains("idiot"), F.lit(False)).cast("int").alias("toxic"))
    labels = labels.union(spark.createDataFrame([(None, 1), (3, None), (999, 1)], "doc_id long, toxic int"))
    train = F.col("doc_id") % 4 != 2
    docs = corpus.withColumn("score", F.lit("old"))
    rows = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels, train).collect()}
    assert len(rows) == corpus.count() and all(0 <= r.score <= 1 for r in rows.values())
    truth = {r.doc_id: r.toxic for r in labels.where("doc_id < 160 and toxic is not null").collect()}
    wrong = [i for i, t in truth.items() if i % 4 == 2 and rows[i].predicted != t]
    assert len(wrong) <= 2
    assert rows[200].score == rows[201].score == rows[202].score and rows[200].predicted == 0
    again = toxicity.score_toxicity(twice(docs), labels.union(labels), train).collect()
    assert len(again) == len(rows) + 3 and all(r.score == rows[r.doc_id].score for r in again)
    assert toxicity.score_toxicity(nothing, labels, train).count() == 0
    unlearned = toxicity.score_toxicity(corpus, labels.where("toxic = 0"), train)
    assert {(r.score, r.predicted) for r in unlearned.collect()} == {(0.0, 0)}


def test_calibration_never_falls():
    r = np.random.default_rng(2)
    x = r.normal(size=900)
    places, chances = toxicity.calibrated(x, (r.random(900) < 1 / (1 + np.exp(-3 * x))).astype(float))
    assert (np.diff(places) >= 0).all() and (np.diff(chances) >= 0).all() and 0 < chances[0] < 0.1 and 0.9 < chances[-1] < 1
    places, chances = toxicity.calibrated(-x, (x > 0).astype(float))
    assert np.allclose(chances, chances[0])


def test_spelling_models_are_distributions(corpus):
    """What any symbol can follow adds up to 1 in both classes and all shared levels."""
    sample = corpus.where("doc_id < 160").select("doc_id", "text", F.coalesce(F.col("text").contains("idiot"), F.lit(False)).cast("int").alias("toxic"), (F.col("doc_id") % toxicity.FOLDS).cast("int").alias("fold"))
    model = toxicity.models_of(toxicity._counted(sample))[0]
    symbols = np.arange(1 << 9, dtype=np.uint64)[: toxicity.SYMBOLS]
    below = np.full((len(symbols), 1), -np.log(toxicity.SYMBOLS))
    history = [int(c) for c in b"idi"]
    for k, level in enumerate([*model.shared, model.top], 1):
        context = 0
        for c in history[len(history) - k + 1 :]:
            context = context << 9 | c
        codes = np.uint64(context << 9) | symbols
        below = level.mixed(codes, codes >> np.uint64(9), below if k < toxicity.ORDER else np.repeat(below, 2, axis=1))
        assert np.allclose(np.exp(below).sum(axis=0), 1), k
    assert below[ord("o"), 1] > below[ord("o"), 0]


def test_held_out_labels_are_never_read(corpus):
    labels = corpus.where("doc_id < 160").select("doc_id", F.col("text").contains("idiot").cast("int").alias("toxic"))
    train = F.col("doc_id") % 4 != 2
    turned = labels.withColumn("toxic", F.when(train, F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in toxicity.score_toxicity(corpus, x, train).collect()} for x in (labels, turned))
    assert a == b


def test_the_hash_space_is_exchanged_in_parts(spark, monkeypatch):
    r = random.Random(11)
    docs = spark.createDataFrame([(k, " ".join(r.choice(["oak", "elm", "ash", "yew", "fir"]) for _ in range(r.randrange(40)))) for k in range(200)], "doc_id long, text string")
    train = F.col("doc_id") % 7 != 2
    sent, found = [], {}
    asked = lm._asked
    for passes, fan in ((1, 256), (3, 256), (3, 2)):
        monkeypatch.setattr(lm, "BATCH_BYTES", 1000)
        monkeypatch.setattr(lm, "PASSES", passes)
        monkeypatch.setattr(lm, "MAX_FAN", fan)
        parts = []
        monkeypatch.setattr(lm, "_asked", lambda *a: (parts.append(a[4]), asked(*a))[1])
        found[passes, fan] = sorted(lm.interpolated_scores(docs, train, 3).collect())
        sent.append(parts)
    assert len(sent[0]) == 1 and len(sent[1]) == 3 and len(sent[2]) == 2
    assert [k for p in sent[1] for k in p] == list(sent[0][0])  # each part of the hash space once
    assert found[1, 256] == found[3, 256] == found[3, 2]
