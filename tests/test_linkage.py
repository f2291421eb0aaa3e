"""Blocking, features, metrics, selection and results on small frames."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from kindred.functions import similarity
from kindred.functions import text as T
from kindred.operators import blocking, features, metrics, model, sampling, selection, submission, truth
from kindred.plans import catalog, linkage
from kindred.plans.linkage import Options
from kindred.session import settle

S, C = "source1_entity_id", "candidate_entity_id"


def vendors_of(df, source="S1-1"):
    return {r.vendor_entity_id for r in df.where(F.col(S) == source).collect()}


def normalized(spark, values, function):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r.y for r in df.select(function(F.col("x")).alias("y")).collect()]


def test_candidates_share_a_key_and_are_distinct(entities):
    s = entities([("S1-1", "Alpha Shop", "44 Oak Road"), ("S1-2", "Unmatched Business", "99 Unknown Lane"), ("S1-3", "_", "")])
    v = entities([("S2-01", "Alpha Shop", "44 Oak Rd"), ("S2-02", "Beta Shop", "1 Elm Street"), ("S3-01", "Alpha Store", "44 Other Road"), ("S3-02", "_", "")])
    pairs = blocking.candidate_pairs(s, v)
    assert vendors_of(pairs) == {"S2-01", "S3-01"}
    assert vendors_of(pairs, "S1-2") == set() == vendors_of(pairs, "S1-3")
    assert pairs.count() == pairs.distinct().count() == 2
    assert blocking.candidate_pairs(s, v, 1).count() == 1
    assert vendors_of(blocking.candidate_pairs(s, v, 1)) == {"S2-01"}


def test_more_equal_keys_rank_first(entities):
    s = entities([("S1-1", "Acme Bakery", "42 Main Street")])
    v = entities([("S2-01", "Acme Tools", "42 Side Street"), ("S2-02", "Acme Bakery", "42 Main Street"), ("S2-03", "Acme Bakery", "7 Far Lane 42")])
    assert vendors_of(blocking.candidate_pairs(s, v, 2)) == {"S2-02", "S2-03"}


def test_similarity_breaks_ties_before_the_id(entities):
    s = entities([("S1-1", "Acme Bakery", "42 Main Street")])
    v = entities([("S2-01", "Zzzzzzzzzzz", "42 Main Street"), ("S2-99", "Acmf Bakery", "42 Main Street")])
    assert vendors_of(blocking.candidate_pairs(s, v, 1)) == {"S2-99"}


def test_legal_endings_match(entities):
    s = entities([("S1-1", "Acme, Inc.", "1 A")])
    v = entities([("S2-01", "ACME LLC", "2 B"), ("S2-02", "Acme Restaurant Group", "3 C")])
    assert vendors_of(blocking.candidate_pairs(s, v)) == {"S2-01"}


def test_scoring_only_what_straddles_rank_k_changes_nothing(spark, entities):
    r = random.Random(3)
    names, streets = ["Oak", "Oak Inc", "Elm", "Elm Co. Ltd.", "Ash & Son", ""], ["1 A Street", "1 A St", "2 B Road", None, "3 C"]
    make = lambda p, n: entities([(f"{p}-{k}", r.choice(names), r.choice(streets)) for k in range(n)])
    s, v = make("S1", 12), make("S2", 60)
    sk, vk = blocking.blocking_keys(s, S), blocking.blocking_keys(v, "vendor_entity_id")
    pairs = blocking.deduplicated(blocking.candidate_matches(sk, vk))
    rows = blocking.similarity_score(pairs, sk, vk).collect()
    for k in (1, 3, 7, 100):
        naive = set()
        for source in {x[S] for x in rows}:
            own = sorted((x for x in rows if x[S] == source), key=lambda x: (-x.matched_key_count, -x.similarity_score, x.length_gap, x.vendor_entity_id))
            naive |= {(source, x.vendor_entity_id) for x in own[:k]}
        assert {tuple(x) for x in blocking.top_candidates(pairs, sk, vk, k).collect()} == naive


def test_classes_of_equal_entities_give_the_same_pairs(spark, entities):
    r = random.Random(5)
    names, streets = ["Oak", "Oak Inc", "Oak Inc 7", "Elm", "Elm Co. Ltd.", "Ash & Son", "", "_"], ["1 A Street", "1 A St", "2 B Road", "B Road 2", None, "3 C", ""]
    make = lambda p, n: entities([(f"{p}-{k}", r.choice(names), r.choice(streets)) for k in range(n)])
    s, v = make("S1", 90), make("S2", 200)
    sk, vk = blocking.blocking_keys(s, S), blocking.blocking_keys(v, "vendor_entity_id")
    left, right = sk.collect(), vk.collect()
    matches, pairs = {}, {}
    for a in left:
        for b in right:
            gap = abs(a.name_length - b.name_length) + abs(a.address_length - b.address_length)
            kinds = [k for k in blocking.KEY_KINDS if a[f"key_{k}"] is not None and a[f"key_{k}"] == b[f"key_{k}"]]
            matches |= {(a[S], b.vendor_entity_id, k): gap for k in kinds}
            if kinds:
                pairs[a[S], b.vendor_entity_id] = (len(kinds), gap)
    found = blocking.candidate_matches(sk, vk).collect()
    assert len(found) == len(matches) and {(x[0], x[1], x.blocking_key): x.length_gap for x in found} == matches
    found = blocking.candidate_evidence(sk, vk).collect()
    assert len(found) == len(pairs) and {(x[0], x[1]): (x.matched_key_count, x.length_gap) for x in found} == pairs
    plain = blocking.deduplicated(blocking.candidate_matches(sk, vk))
    assert sorted(blocking.scored_candidates(sk, vk).collect()) == sorted(blocking.similarity_score(plain, sk, vk).collect())
    for k in (4, 500):
        assert sorted(blocking.candidate_pairs(s, v, k, 9).collect()) == sorted(blocking.top_candidates(plain, sk, vk, k, 9).collect())
    # A repeated id merges its rows' evidence, as before.
    twice = vk.union(blocking.blocking_keys(entities([("S2-0", "Elm", "3 C")]), "vendor_entity_id"))
    assert sorted(blocking.candidate_evidence(sk, twice).collect()) == sorted(blocking.deduplicated(blocking.candidate_matches(sk, twice)).collect())


def test_copies_are_joined_and_ranked_as_classes(spark, entities):
    copies = lambda p: spark.range(2500).selectExpr(f"concat('{p}-', id) entity_id", "'Oak Inc' business_name", "'1 A Street' business_address")
    sk, vk = blocking.blocking_keys(copies("S1"), S), blocking.blocking_keys(copies("S2"), "vendor_entity_id")
    assert blocking._class_pairs(blocking._classes(sk, S, 1), blocking._classes(vk, "vendor_entity_id", 3), S, "vendor_entity_id").count() == 1
    assert blocking._classes(sk, S).count() == 3  # rows of 1,000, 1,000 and 500 ids
    assert blocking.candidate_evidence(sk, vk).where("matched_key_count = 4").count() == 2500**2
    top = blocking.candidate_pairs(copies("S1"), copies("S2"), 3)
    assert top.count() == top.select(S).distinct().count() * 3 == 7500
    assert {r[0] for r in top.select("vendor_entity_id").distinct().collect()} == {"S2-0", "S2-1", "S2-10"}


def test_arguments_are_checked(entities):
    s = entities([("S1-1", "a", "b")])
    with pytest.raises(ValueError):
        blocking.candidate_pairs(s, s, 0)
    with pytest.raises(ValueError, match="business_address"):
        blocking.candidate_pairs(s.drop("business_address"), s)
    with pytest.raises(ValueError, match="S1-1"):
        blocking.assert_unique_ids(s.union(s), "Source 1")


def test_normalisation(spark):
    assert normalized(spark, ["École & Fils, Inc.", "ÉCOLE and FILS LLC", None, "  ", "a_b--c"], T.normalize_name) == ["école and fils inc", "école and fils llc", "", "", "a b c"]
    assert normalized(spark, ["Suite #2 Street Street", "Ste. 2", None], T.normalize_address) == ["ste 2 st st", "ste 2", ""]
    padded = lambda c: T.abbreviate_by_replacement(T.normalize_name(c))
    assert normalized(spark, ["street street road"], padded) == ["st street rd"]
    endings = lambda c: T.strip_legal_suffix(T.normalize_name(c))
    assert normalized(spark, ["inc", "a co pvt ltd", "L.L.C.", "bianco", "Acme, Inc."], endings) == ["inc", "a co", "l l c", "bianco", "acme"]
    assert normalized(spark, ["S2-1, S3-2 ,,S2-3", "", None], T.id_list) == [["S2-1", "S3-2", "S2-3"], [], []]


def test_kernels():
    assert round(similarity.ratio("and fils inc école", "and fils llc école"), 4) == 88.8889
    assert similarity.token_sort_ratio("b a", "a b") == 100
    assert similarity.token_set_ratio("a b", "a b c") == 100 and similarity.token_set_ratio("", "a") == 0
    assert similarity.partial_ratio("", "") == 100 and similarity.partial_ratio("", "a") == 0
    assert similarity.partial_ratio("abc", "xxabcxx") == 100
    assert round(similarity.jaro_winkler("MARTHA", "MARHTA"), 4) == 0.9611
    assert similarity.jaro_winkler("", "") == 0

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
        return row[-1]

    r = random.Random(1)
    for _ in range(300):
        a, b = ("".join(r.choice("abcé") for _ in range(r.randrange(9))) for _ in "ab")
        assert similarity.common_length(a, b) == plain(a, b)


def test_jaro_winkler_equals_the_sql_function(spark):
    import duckdb

    r = random.Random(2)
    pairs = [tuple("".join(r.choice("abcdé ") for _ in range(r.randrange(1, 12))) for _ in "ab") for _ in range(400)]
    con = duckdb.connect()
    for a, b in pairs:
        want = con.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0]
        assert abs(similarity.jaro_winkler(a.encode(), b.encode()) - want) < 1e-12


def test_features(spark, entities):
    s = entities([("S1-1", "Acme, Inc.", "12 Main Street"), ("S1-2", None, None)])
    v = entities([("S2-1", "ACME LLC", "12 Main St"), ("S2-2", None, None)])
    ids = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S2-2")], f"{S} string, vendor_entity_id string")
    pairs = features.attach_attributes(s, v, ids)
    assert pairs.columns == features.PAIR_COLUMNS
    made = features.engineer_features(pairs)
    assert [f.dataType.simpleString() for f in made.schema[len(pairs.columns) :]] == ["float"] * 14
    one, two = made.orderBy(S).collect()
    assert (one.exact_name_key_match, one.word_digit_key_match, one.exact_address_key_match, one.legal_name_key_match, one.blocking_key_match_count) == (0, 1, 1, 1, 3)
    assert one.legal_name_similarity == 100 and one.address_digit_match == 1
    assert (two.name_jaro_winkler, two.legal_name_similarity, two.blocking_key_match_count) == (100, 0, 0)
    assert features.attach_attributes(s, v, ids.limit(0)).columns == features.PAIR_COLUMNS


def test_labels_and_lists(spark, entities):
    lists = spark.createDataFrame([("S1-1", "S2-1, S2-2"), ("S1-2", "")], f"{S} string, matched_entity_ids string")
    known = truth.truth_pairs(lists)
    assert known.count() == 2 and truth.truth_pairs(lists, entities([("S1-2", "", "")])).count() == 0
    pairs = spark.createDataFrame([("S1-1", "S2-1", 0.9), ("S1-1", "S2-9", 0.2), ("S1-3", "S2-1", 0.5)], f"{S} string, {C} string, probability double")
    assert {(r[S], r[C]): r.label for r in truth.attach_labels(pairs, known).collect()} == {("S1-1", "S2-1"): 1, ("S1-1", "S2-9"): 0, ("S1-3", "S2-1"): 0}
    ids = entities([("S1-1", "", ""), ("S1-2", "", ""), ("S1-2", "", "")])
    assert sorted(map(tuple, submission.threshold_submission(ids, pairs, 0.5).collect())) == [("S1-1", "S2-1"), ("S1-2", "")]
    assert sorted(map(tuple, submission.candidate_submission(ids, pairs.union(pairs)).collect())) == [("S1-1", "S2-1,S2-9"), ("S1-2", "")]


def test_metrics(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], f"{S} string")
    pairs = lambda rows: spark.createDataFrame(rows, f"{S} string, {C} string")
    known = pairs([("a", "1"), ("a", "2")])
    predicted = pairs([("a", "1"), ("a", "2"), ("a", "3"), ("c", "1"), ("z", "1")])
    scores = {r[S]: r.f05 for r in metrics.scores_by_record(ids, known, predicted).collect()}
    assert round(scores["a"], 3) == 0.714 and scores["b"] == 1 and scores["c"] == 0
    assert round(metrics.macro_f05(ids, known, predicted).first()[0], 6) == round((scores["a"] + 1) / 3, 6)
    assert metrics.macro_f05(ids.limit(0), known, predicted).first()[0] == 0
    rows = spark.createDataFrame([(1, 1), (0, 1), (1, 0)], "label int, predicted int")
    assert metrics.micro_f05(rows).first()[0] == 0.5 and metrics.micro_f05(rows.limit(0)).first()[0] == 0


def scored(spark, rows):
    return spark.createDataFrame(rows, f"{S} string, {C} string, probability double")


def test_relative_floor_is_over_the_whole_record(spark):
    pairs = scored(spark, [("a", "1", 0.8), ("a", "2", 0.5), ("b", "1", 0.8), ("b", "2", 0.75)])
    assert {(r[S], r[C]) for r in selection.accepted(pairs, 0.4, 0.9).collect()} == {("a", "1"), ("b", "1"), ("b", "2")}
    assert selection.accepted(pairs.limit(0), 0.4, 0.9).count() == 0


def test_grid_equals_brute_force(spark):
    r = random.Random(5)
    ids = [f"s{k}" for k in range(12)]
    rows = {(r.choice(ids), f"v{r.randrange(6)}"): r.choice([0.29, 0.57, r.random(), 0.0, 1.0]) for _ in range(60)}
    known = {(r.choice(ids[:9]), f"v{r.randrange(6)}") for _ in range(25)}
    frame = spark.createDataFrame([(i,) for i in ids], f"{S} string")
    pairs = scored(spark, [(s, v, p) for (s, v), p in rows.items()])
    grid = {(round(x.threshold, 2), x.relative): x.score for x in selection.threshold_grid(frame, spark.createDataFrame(list(known), f"{S} string, {C} string"), pairs).collect()}
    assert len(grid) == 570
    for (t, floor), score in grid.items():
        total = 0
        for i in ids:
            own = {v: p for (s, v), p in rows.items() if s == i}
            best = max(own.values(), default=0)
            kept = {v for v, p in own.items() if p >= t and p >= floor * best}
            true = {v for s, v in known if s == i}
            hits = len(kept & true)
            total += 1 if not kept and not true else 1.25 * hits / (len(kept) + 0.25 * len(true)) if hits else 0
        assert abs(score - total / len(ids)) < 1e-9, (t, floor)


def test_selection_chooses_on_one_half_and_scores_the_other(spark):
    ids = spark.createDataFrame([(f"s{k}",) for k in range(2)], f"{S} string")
    split = spark.createDataFrame([("s0", "a"), ("s1", "b")], f"{S} string, half string")
    pairs = scored(spark, [("s0", "t", 0.82), ("s0", "f", 0.60), ("s1", "t", 0.54), ("s1", "f", 0.90)])
    known = spark.createDataFrame([("s0", "t"), ("s1", "t")], f"{S} string, {C} string")
    assert selection.select_threshold(ids, known, pairs, split=split) == selection.Choice(0.82, 0.95, 1.0, 0.0)
    none = selection.select_threshold(ids, known.limit(0), pairs.withColumn("probability", F.lit(0.1)), split=split)
    assert none.threshold == 0.95 and none.selection_score == 1
    low = selection.select_threshold(ids, known, pairs.where(f"{C} = 't'").withColumn("probability", F.lit(0.2)), split=split)
    assert (low.threshold, low.selection_score) == (0.2, 1.0)
    with pytest.raises(ValueError):
        selection.select_threshold(ids.limit(1), known, pairs)


def test_samples_folds_and_halves(spark, entities):
    rows = entities([(f"S1-{k}", "", "") for k in range(12)])
    five = sampling.sample_records(rows, 5)
    assert five.distinct().count() == 5
    assert {r.entity_id for r in five.collect()} == {r.entity_id for r in sampling.sample_records(rows.repartition(7), 5).collect()}
    assert sampling.sample_records(rows, 99).count() == 12
    with pytest.raises(ValueError):
        sampling.sample_records(rows, 0)
    ids = rows.select(F.col("entity_id").alias(S))
    halves = sampling.halves(ids.limit(11))
    assert halves.where("half = 'a'").count() == 5 and halves.count() == 11
    folds = sampling.group_folds(ids.union(ids), S, 3)
    assert folds.count() == 12 and {r.fold for r in folds.collect()} <= {0, 1, 2}


def test_rare_positives_keep_their_probability(spark):
    r = random.Random(4)
    rows = [(f"g{g}", float(label) + r.gauss(0, 0.2), r.random(), label) for g in range(20) for label in [1] + [0] * 10]
    df = spark.createDataFrame(rows, f"{S} string, positive_signal double, weak_signal double, label int")
    out = model.out_of_fold(df, 3, model.Trees(5, 3), ["positive_signal", "weak_signal"])
    assert out.count() == len(rows)
    means = {x.label: x.p for x in out.groupBy("label").agg(F.avg("probability").alias("p")).collect()}
    assert means[1] > 0.3 and means[1] > means[0]
    assert model.class_weights(df) == {1: 10.0, 0: 1.0}
    assert model.fit_matcher(df.where("label = 1"), columns=["weak_signal"]).constant == 1.0
    with pytest.raises(ValueError):
        model.out_of_fold(df, 21)


def test_composition_equals_the_library(spark):
    text = "é 가 Å"
    assert normalized(spark, [text, "ascii"], T.nfc) == [unicodedata.normalize("NFC", text), "ascii"]


def test_model_queries_run_with_the_defaults(spark, monkeypatch):
    sf, calls = "/root/testdata/sf0.001", []
    monkeypatch.setattr(catalog.model, "out_of_fold", lambda rows, *args, **more: calls.append((args, more)) or rows.withColumn("probability", F.lit(0.5)))
    monkeypatch.setattr(catalog.linkage, "sensitivity_report", lambda s, v, t, options, sizes: calls.append((options, sizes)))
    catalog.oof_scores(spark, sf)
    catalog.sensitivity_report(spark, sf)
    assert calls[0] == ((), {}) and calls[1][0] == catalog.linkage.Options() and set(calls[1][1]) >= {10_000, 50_000, 100_000}


def common(a, b):
    rows = [[0] * (len(b) + 1)]
    for x in a:
        row = [0]
        for k, y in enumerate(b):
            row.append(max(rows[-1][k] + 1 if x == y else 0, rows[-1][k + 1], row[k]))
        rows.append(row)
    return rows[-1][-1]


def plain_ratio(a, b):
    return 200 * common(a, b) / (len(a) + len(b)) if a or b else 100.0


def plain_jaro_winkler(a, b):
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, pairs = set(), []
    for i, x in enumerate(a):
        j = next((j for j in range(len(b)) if abs(i - j) <= reach and j not in taken and b[j] == x), None)
        if j is not None:
            taken.add(j)
            pairs.append(i)
    m = len(pairs)
    if not m:
        return 0.0
    out_of_place = sum(a[i] != b[j] for i, j in zip(pairs, sorted(taken), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - out_of_place) / m) / 3
    start = next((k for k in range(min(4, len(a), len(b))) if a[k] != b[k]), min(4, len(a), len(b)))
    return jaro + (start * 0.1 * (1 - jaro) if jaro > 0.7 else 0)


def plain_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    sides = [" ".join(sorted(x & y) + sorted(s - (x & y))) for s in (x, y)]
    return max(plain_ratio(*sides), *(plain_ratio(both, s) if both else 0 for s in sides))


def plain_partial(a, b):
    if not a or not b:
        return 100.0 if a == b else 0.0
    best = 0.0
    for short, long in [(a, b)] * (len(a) <= len(b)) + [(b, a)] * (len(b) <= len(a)):
        n = len(short)
        windows = {long[max(0, k) : k + n] for k in range(1 - n, len(long))}
        best = max(best, *(plain_ratio(short, w) for w in windows))
    return best


def test_fuzzy_features_equal_plain_ones(spark):
    r = random.Random(3)
    made = lambda: " ".join("".join(r.choice("abcé1") for _ in range(r.randrange(1, 6))) for _ in range(r.randrange(0, 5)))
    rows = []
    for _ in range(300):
        texts = [made() for _ in range(6)]
        for k in (0, 2, 4):
            if r.random() < 0.5:
                texts[k + 1] = " ".join(r.sample(texts[k].split(), len(texts[k].split()))) if r.random() < 0.3 else texts[k][: r.randrange(9)].strip() + " " + made()
        rows.append(tuple(t.strip() for t in texts))
    rows += [("",) * 6, ("a", "", "a", "", "a", ""), ("a a", "a", "a a", "a", "a a", "a")]
    df = spark.createDataFrame(rows, "n1 string, n2 string, a1 string, a2 string, l1 string, l2 string")
    got = df.select("*", similarity.fuzzy_features("n1", "n2", "a1", "a2", "l1", "l2").alias("f")).collect()
    assert len(got) == len(rows)
    for x in got:
        want = [
            plain_ratio(" ".join(sorted(x.n1.split())), " ".join(sorted(x.n2.split()))),
            plain_set(x.n1, x.n2),
            100 * (1.0 if x.n1 == x.n2 else plain_jaro_winkler(x.n1, x.n2)),
            plain_set(x.a1, x.a2),
            plain_partial(x.a1, x.a2),
            plain_ratio(x.l1, x.l2) if x.l1 and x.l2 else 0.0,
        ]
        assert [round(v, 9) for v in x.f] == [round(v, 9) for v in want], x


def test_the_last_row_of_a_record_counts(spark):
    rows = [("S1-1", "S2-1, S3-2", 1), ("S1-2", "S2-5", 2), ("S1-1", "S3-9,S3-9", 3), ("S1-2", " ", 4), ("S1-3", None, 5)]
    df = spark.createDataFrame(rows, "source1_entity_id string, matched_entity_ids string, line int").coalesce(1)
    for order in ("line", None):
        assert [tuple(r) for r in truth.truth_pairs(df, order=order).collect()] == [("S1-1", "S3-9")]
    first = truth.truth_pairs(df.withColumn("line", -F.col("line")), order="line")
    assert sorted(map(tuple, first.collect())) == [("S1-1", "S2-1"), ("S1-1", "S3-2"), ("S1-2", "S2-5")]


def test_pairs_are_made_only_of_classes_that_can_be_among_the_best(spark, entities):
    # Three vendors agree in all keys, a hundred others in the address alone: with k = 2 or 3 these are counted, but never paired.
    s = entities([("S1-1", "Oak Inc", "1 A Street"), ("S1-2", "Elm", None)])
    v = entities([(f"S2-{k}", "OAK inc", "1 A St") for k in range(3)] + [(f"S3-{k}", f"name{k}", "1 A Street") for k in range(100)])
    sk, vk = blocking.blocking_keys(s, S), blocking.blocking_keys(v, "vendor_entity_id")
    left, right = blocking._classes(sk, S, 1), blocking._classes(vk, "vendor_entity_id", 5).withColumn("n", F.size("vendor_entity_ids"))
    for k, tier, above, same, pairs in ((2, 4, 0, 3, 1), (3, 4, 0, 3, 1), (4, 1, 3, 100, 101)):
        tiers = blocking._tiers(left, right, k)
        assert [tuple(x)[1:] for x in tiers.collect()] == [(tier, above, same)]
        assert blocking._pairs_from(tiers, left, right).count() == pairs
    plain = blocking.deduplicated(blocking.candidate_matches(sk, vk))
    for k, found in zip((2, 4, 7), blocking.ranked_candidates(s, v, [2, 4, 7], 9), strict=True):
        assert sorted(found.collect()) == sorted(blocking.top_candidates(plain, sk, vk, k, 9).collect())


def test_a_truth_of_groups_is_that_of_its_pairs(spark):
    r = random.Random(3)
    # Some records and vendors are in several groups or none, and rows are repeated.
    s = [(f"S1-{k}", f"g{r.randrange(6)}") for k in range(20) for _ in range(r.choice([0, 1, 1, 2]))] + [("S1-x", None)]
    v = [(f"S2-{k}", f"g{r.randrange(6)}") for k in range(25) for _ in range(r.choice([0, 1, 1, 3]))] + [("S2-x", None)]
    groups = truth.Groups(spark.createDataFrame(s, f"{S} string, group string"), spark.createDataFrame(v, f"{C} string, group string"))
    known = {(a, b) for a, g in s for b, h in v if g is not None and g == h}
    pairs = spark.createDataFrame(known, f"{S} string, {C} string")
    scored = spark.createDataFrame([(f"S1-{k}", f"S2-{r.randrange(27)}", r.randrange(101) / 100) for k in range(22) for _ in range(3)], f"{S} string, {C} string, probability double")
    ids = spark.createDataFrame([(f"S1-{k}",) for k in range(22)], f"{S} string")
    assert {(x[S], x[C], x.probability): x.label for x in truth.attach_labels(scored, groups).collect()} == {(x[S], x[C], x.probability): int((x[S], x[C]) in known) for x in scored.collect()}
    assert sorted(truth.true_counts(groups).collect()) == sorted(truth.true_counts(pairs).collect())
    assert metrics.macro_f05(ids, groups, scored).first() == metrics.macro_f05(ids, pairs, scored).first()
    assert sorted(selection.threshold_grid(ids, groups, scored).collect()) == sorted(selection.threshold_grid(ids, pairs, scored).collect())
    assert selection.select_threshold(ids, groups, scored) == selection.select_threshold(ids, pairs, scored)


def test_many_texts_are_compared_as_one_by_one():
    r = random.Random(8)
    texts = ["".join(r.choice("ab c0é") for _ in range(r.choice([0, 1, 3, 9, 20, 40, 64, 70]))).encode() for _ in range(150)]
    many = similarity.Many(texts)
    for a in texts[:60]:
        assert many.jaro_winkler(a).tolist() == [similarity.jaro_winkler(a, b) for b in texts]


def test_keys_with_many_pairs_are_ranked_in_blocks(spark, entities, monkeypatch):
    # One name on either side: its pairs are ranked in blocks, of which each gives the best k of a record at most.
    r = random.Random(4)
    streets = [None, "", *(f"{n} {x}" for n in (1, 2, 12) for x in ("A Street", "A St", "B Road", "Bé Road", "C"))]
    make = lambda p, n: entities([(f"{p}-{k}", r.choice(["Oak", "Oak", "Oak Inc", "Elm"]), f"{r.choice(streets)} {r.randrange(40)}") for k in range(n)])
    s, v = make("S1", 40), make("S2", 90)
    for name, value in (("HOT_PAIRS", 200), ("SOURCE_BLOCK", 20), ("VENDOR_BLOCK", 40)):
        monkeypatch.setattr(blocking, name, value)
    sk, vk = blocking.blocking_keys(s, S), blocking.blocking_keys(v, "vendor_entity_id")
    plain = blocking.deduplicated(blocking.candidate_matches(sk, vk))
    blocks, made = [], blocking._best_in_blocks
    monkeypatch.setattr(blocking, "_best_in_blocks", lambda *args: blocks.append(made(*args)) or blocks[-1])
    for k, digits in ((4, 9), (20, None)):
        assert sorted(blocking.candidate_pairs(s, v, k, digits).collect()) == sorted(blocking.top_candidates(plain, sk, vk, k, digits).collect())
    assert blocks and blocks[0].where("similarity_score is not null").count() > 0
    assert blocks[0].where("similarity_score is not null").count() < plain.count()


def test_equal_texts_are_compared_once(spark, monkeypatch):
    rows = [(f"S1-{k}", f"S2-{k}", *x) for k in range(50) for x in (("Oak Inc 7", "OAK", "1 A Street", None), ("Oak Inc 7", "OAK", "1 A Street", ""), (None, "Elm", "2 B", "2 B Road"))]
    pairs, seen = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in features.PAIR_COLUMNS)), []
    plain = features.normalized_pairs
    monkeypatch.setattr(features, "normalized_pairs", lambda texts: seen.append(texts) or plain(texts))
    made, builtin = features.engineer_features(pairs).collect(), features.add_builtin_features(pairs)
    assert [x.count() for x in seen] == [3, 3] and len(made) == 150
    expected = features.builtin_features(plain(pairs)).select(builtin.columns)
    assert sorted(map(str, builtin.collect())) == sorted(map(str, expected.collect()))
    assert {(r.name_2, r.address_2, r.name_length_diff, r.address_length_diff) for r in made} == {("OAK", None, 6.0, 6.0), ("OAK", "", 6.0, 6.0), ("Elm", "2 B Road", 3.0, 3.0)}


def test_equal_rows_are_fitted_as_one_with_their_count(spark, monkeypatch):
    r = random.Random(6)
    points = [(float(r.randrange(4)), float(r.randrange(3))) for _ in range(200)]
    rows = spark.createDataFrame([(f"S1-{k % 40}", f"S2-{k}", a, b, int(a > 1) if k % 9 else 0) for k, (a, b) in enumerate(points)], f"{S} string, {C} string, a double, b double, label int")
    fitted, fit = [], model.GBTClassifier.fit
    monkeypatch.setattr(model.GBTClassifier, "fit", lambda self, data: fitted.append(data.count()) or fit(self, data))
    found = model.out_of_fold(rows, 2, model.Trees(2, 2), ["a", "b"])
    assert found.count() == 200 and len(fitted) == 2 and max(fitted) <= 24


def test_keys_with_many_pairs_are_joined_in_blocks(spark, entities, monkeypatch):
    r = random.Random(9)
    names, streets = ["Oak", "Oak", "Oak Inc", "Oak Inc 7", "Elm", "Elm", ""], ["1 A Street", "1 A St", "2 B Road", None, ""]
    make = lambda p, n: entities([(f"{p}-{k}", r.choice(names), f"{r.choice(streets) or ''} {r.choice('xyz')}") for k in range(n)])
    sk, vk = blocking.blocking_keys(make("S1", 40), S), blocking.blocking_keys(make("S2", 70), "vendor_entity_id")
    plain = sorted(blocking.deduplicated(blocking.candidate_matches(sk, vk)).collect())
    for limit, block in (("HOT_PAIRS", 20), ("PAIR_BLOCK", 4)):
        monkeypatch.setattr(blocking, limit, block)
    placed, plan = [], blocking._hot
    monkeypatch.setattr(blocking, "_hot", lambda *args: placed.append(plan(*args)) or placed[-1])
    for few in (blocking.FEW_KEYS, 0):
        monkeypatch.setattr(blocking, "FEW_KEYS", few)
        assert sorted(blocking.candidate_evidence(sk, vk).collect()) == plain
    assert placed[0].where("parts_s > 1 and parts_v > 1").count() > 1


def test_rows_of_texts_are_compared_as_one_by_one():
    r = random.Random(4)
    make = lambda: "".join(r.choice("ab c0é\0") for _ in range(r.choice([0, 1, 2, 3, 9, 20, 40, 60, 70]))).encode()
    a, b = ([make() for _ in range(6000)] for _ in "ab")
    a, b = a + a[:50] + [b"\0", b"a" * 64], b + b[:50] + [b"a", b"b" * 63 + b"a"]
    assert similarity.jaro_winkler_rows(a, b).tolist() == [similarity.jaro_winkler(x, y) for x, y in zip(a, b, strict=True)]
    assert similarity.jaro_winkler_rows([], []).tolist() == []


def test_pairs_are_scored_without_a_shuffle_of_pairs(spark, entities):
    s, v = (entities([(f"{p}-{k}", "Oak Inc", f"{k % 2} A Street") for k in range(4)]) for p in ("S1", "S2"))
    scored = blocking.scored_candidates(blocking.blocking_keys(s, S), blocking.blocking_keys(v, "vendor_entity_id"))
    assert scored.count() == 16 and scored._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_equal_texts_are_normalised_once(spark, entities, monkeypatch):
    rows = [("S1-1", "Oak Inc", "1 A Street"), ("S1-2", "Oak Inc", "1 A Street"), ("S1-3", None, ""), ("S1-4", None, None), ("S1-5", "Elm", None)]
    s, v = entities(rows), entities([(f"S2-{i}", n, a) for i, n, a in rows[1:] + rows[:2]])
    plain, seen = blocking.blocking_keys, []
    monkeypatch.setattr(blocking, "blocking_keys", lambda e, c: seen.append(e.count()) or plain(e, c))
    for found, want, c in zip(blocking.keys_of_both(s, v), (s, v), (S, "vendor_entity_id"), strict=True):
        assert found.columns == plain(want, c).columns and sorted(found.collect(), key=str) == sorted(plain(want, c).collect(), key=str)
    assert seen == [4]


#: Queries and how many of the joins in their plans may send a table to all executors: the changes of the grid, 570 rows at most, and the ids of a sample.
SENT = {
    "candidates_top5": 0,
    "acceptance_mask": 0,
    "features_fuzzy": 0,
    "labels": 0,
    "matches_beyond_candidates": 0,
    "relative_max": 0,
    "attach_attributes": 0,
    "features_builtin": 0,
    "macro_f05": 0,
    "oof_scores": 0,
    "threshold_sweep": 1,
    "candidate_submission": 0,
    "features_jaro_winkler": 0,
    "match_submission": 0,
    "select_threshold": 0,
    "validate_submission": 0,
    "group_folds": 0,
    "micro_f05": 0,
    "sensitivity_report": 1,
}


@pytest.mark.parametrize("name", SENT)
def test_tables_as_large_as_the_input_are_not_sent_by_way_of_the_driver(spark, monkeypatch, name):
    plans, trees = [], model.Trees(iterations=1, depth=2)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for module in (blocking, features, selection, model, catalog, linkage):
        monkeypatch.setattr(module, "settle", lambda df, name="table": plans.append(plan(df)) or settle(df, name))
    monkeypatch.setattr(model.out_of_fold, "__defaults__", (2, trees, features.FEATURE_COLUMNS, S))
    monkeypatch.setattr(linkage, "Options", lambda: Options(folds=2, trees=trees))
    monkeypatch.setattr(linkage, "SAMPLE_SIZES", ())
    plans.append(plan(catalog.QUERIES[name](spark, "/root/testdata/sf0.001")))
    assert sum(p.count("BroadcastHashJoin") for p in plans) == SENT[name]
