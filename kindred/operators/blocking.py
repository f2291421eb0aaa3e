"""Candidate pairs: four blocking keys, one join, evidence, similarity and the best k for each record.

Entities of equal texts and keys are one class: classes are joined, counted and scored, and ids put in their place afterwards.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from functools import reduce
from math import comb
from operator import and_, or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import text as T
from kindred.functions.similarity import Many, jaro_winkler_bytes
from kindred.session import settle, shuffled
from kindred.sources.tsv import ENTITY_COLUMNS, require_columns

KEY_KINDS = ["exact_name", "word_digit", "exact_addr", "legal_name"]
PAIR = ["source1_entity_id", "vendor_entity_id"]
#: What makes a class; all other columns of blocking_keys follow from these.
PROFILE = ["normalized_name", "normalized_address", "legal_name", "key_word_digit"]
#: A row holds so many ids at most; larger classes have several rows.
IDS_IN_A_ROW = 1000
#: Rows of one key that make more pairs than this are paired in blocks of so many rows of the source and so many of the vendors.
HOT_PAIRS, SOURCE_BLOCK, VENDOR_BLOCK = 100_000, 500, 4000
#: The same for pairs that all are results, with blocks of so many rows on either side; a table of so many such keys is sent to all executors.
PAIR_BLOCK, FEW_KEYS = 1000, 10_000
TEXTS = ["normalized_name", "legal_name", "normalized_address"]


def blocking_keys(entities: DataFrame, id_column: str = "entity_id") -> DataFrame:
    """Normalised texts, their lengths and the four keys (null where empty) of every entity."""
    normal = entities.select(
        F.col("entity_id").alias(id_column),
        T.normalize_name(F.col("business_name")).alias("normalized_name"),
        T.normalize_name(F.col("business_address")).alias("_address"),
        "business_address",
    ).withColumn("normalized_address", T.abbreviate(F.col("_address")))
    named = normal.withColumn("legal_name", T.strip_legal_suffix(F.col("normalized_name")))
    return named.select(
        id_column,
        "normalized_name",
        "normalized_address",
        "legal_name",
        F.length("normalized_name").alias("name_length"),
        F.length("normalized_address").alias("address_length"),
        T.filled(F.col("normalized_name")).alias("key_exact_name"),
        T.word_digit(F.col("normalized_name"), F.col("business_address")).alias("key_word_digit"),
        T.filled(F.col("normalized_address")).alias("key_exact_addr"),
        T.filled(F.col("legal_name")).alias("key_legal_name"),
    )


def keys_of_both(source: DataFrame, vendors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`blocking_keys` of two entity tables, written in one job; equal texts are normalised once."""
    texts = ["business_name", "business_address"]
    rows = reduce(DataFrame.unionByName, [x.select("entity_id", *texts, F.lit(own).alias("_own")) for x, own in ((source, True), (vendors, False))])
    made = blocking_keys(rows.select(*texts).distinct().withColumn("entity_id", F.struct(*texts)), "_texts")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_texts.{c}")) for c in texts])
    keys = settle(rows.join(shuffled(made), same).drop(*texts, "_texts"), "keys")
    return tuple(keys.where(F.col("_own") == own).drop("_own").withColumnRenamed("entity_id", c) for own, c in ((True, PAIR[0]), (False, PAIR[1])))


def _exploded(keys: DataFrame, id_column: str) -> DataFrame:
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"key_{k}").alias("key")) for k in KEY_KINDS])
    flat = keys.select(f"{id_column}s", F.col("name_length").alias(f"{id_column}_n"), F.col("address_length").alias(f"{id_column}_a"), F.explode(kinds).alias("k"))
    return flat.select("*", "k.kind", "k.key").drop("k").where(F.col("key").isNotNull())


def _grouped(rows: DataFrame, by: list[str], id_column: str) -> DataFrame:
    """One row for every IDS_IN_A_ROW rows with equal `by`: these columns and ids."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(id_column))
    return rows.withColumn("_part", F.floor((place - 1) / IDS_IN_A_ROW)).groupBy(*by, "_part").agg(F.collect_list(F.struct(id_column)).alias(f"{id_column}s")).drop("_part")


def _with_ids(pairs: DataFrame, *columns: str | Column) -> DataFrame:
    """Pairs of rows that hold ids as pairs of ids, with the given columns."""
    left = pairs.select(F.explode(f"{PAIR[0]}s").alias("_s"), f"{PAIR[1]}s", *columns)
    kept = left.columns[2:]
    return left.select("_s", F.explode(f"{PAIR[1]}s").alias("_v"), *kept).select(f"_s.{PAIR[0]}", f"_v.{PAIR[1]}", *kept)


def candidate_matches(source_keys: DataFrame, vendor_keys: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    """Every pair with an equal key, once for each kind: ids, blocking_key, length_gap. One join for all four kinds, of classes of equal entities."""
    s, v = (_exploded(_grouped(x, [c for c in x.columns if c != i], i), i) for x, i in ((source_keys, PAIR[0]), (vendor_keys, PAIR[1])))
    if kinds is not None:
        s, v = s.where(F.col("kind").isin(kinds)), v.where(F.col("kind").isin(kinds))
    gap = F.abs(F.col(f"{PAIR[0]}_n") - F.col(f"{PAIR[1]}_n")) + F.abs(F.col(f"{PAIR[0]}_a") - F.col(f"{PAIR[1]}_a"))
    return _with_ids(s.join(v, ["kind", "key"]), F.col("kind").alias("blocking_key"), gap.alias("length_gap"))


def _classes(keys: DataFrame, id_column: str, first: int | None = None) -> DataFrame:
    """Classes that have a key, with a number in the place of the id, and their ids; with `first`, only so many of each class, in order."""
    columns = [c for c in keys.columns if c != id_column]
    keyed = keys.where(reduce(or_, [F.col(f"key_{k}").isNotNull() for k in KEY_KINDS]))
    if first is None:
        classes = _grouped(keyed, columns, id_column)
    else:
        place = F.row_number().over(Window.partitionBy(*PROFILE).orderBy(id_column))
        classes = keyed.withColumn("_place", place).where(F.col("_place") <= first).groupBy(*columns).agg(F.collect_list(F.struct(id_column)).alias(f"{id_column}s"))
    return classes.withColumn(id_column, F.monotonically_increasing_id())


def _class_pairs(source: DataFrame, vendors: DataFrame, *columns: str) -> DataFrame:
    """Every pair of rows with an equal key, once: matched_key_count, length_gap and the given columns.

    A pair comes up for each kind of key that agrees, and stays where that kind is the first.
    """
    def exploded(rows, side):
        kept = rows.select(*[F.col(c).alias(f"{side}{c}") for c in ("name_length", "address_length", *(f"key_{k}" for k in KEY_KINDS))], *[c for c in columns if c in rows.columns])
        held = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(f"{side}key_{k}").alias("key")) for i, k in enumerate(KEY_KINDS)])
        return kept.withColumn("_k", F.explode(held)).select("*", "_k.kind", "_k.key").drop("_k").where(F.col("key").isNotNull())

    agree = [F.coalesce(F.col(f"s_key_{k}") == F.col(f"v_key_{k}"), F.lit(False)) for k in KEY_KINDS]
    first = reduce(lambda c, i: c.when(agree[i], i), range(len(agree)), F)
    gap = F.abs(F.col("s_name_length") - F.col("v_name_length")) + F.abs(F.col("s_address_length") - F.col("v_address_length"))
    on = ["kind", "key"]
    left, right = exploded(source, "s_"), exploded(vendors, "v_")
    hot = settle(_hot(left, right, on, PAIR_BLOCK, PAIR_BLOCK), "hot")
    if hot.isEmpty():
        joined = left.join(right, on)
    else:
        # Keys with many pairs go in blocks to many tasks. Blocks of a key of legal names are left out where all its rows
        # have one name, since these pairs come up for the name.
        legal = KEY_KINDS.index("legal_name")
        names = left.select(*on, F.col("s_key_exact_name").alias("name")).union(right.select(*on, F.col("v_key_exact_name"))).where(F.col("kind") == legal)
        one = names.join(hot, on, "left_semi").groupBy(on).agg(F.min("name").alias("a"), F.max("name").alias("b")).where("a = b").select(on)
        hot = settle(hot.join(one, on, "left_anti").unionByName(hot.join(one, on).withColumn("parts_s", F.lit(0))), "blocks")
        sizes = hot.withColumnsRenamed({"parts_s": "_parts_s", "parts_v": "_parts_v"})

        def blocks(rows, own, other, by):
            placed = rows.join(F.broadcast(sizes) if few else sizes, on, "left").where(F.coalesce(F.col("_parts_s"), F.lit(1)) > 0)
            block = F.pmod(F.xxhash64(*by), F.coalesce(F.col(f"_parts_{own}"), F.lit(1))).cast("int").alias(f"block_{own}")
            every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(f"_parts_{other}"), F.lit(1)) - 1)).alias(f"block_{other}")
            return placed.select(*rows.columns, block, every)

        few = hot.count() <= FEW_KEYS
        texts = lambda side: [f"{side}key_{k}" for k in KEY_KINDS]
        joined = blocks(left, "s", "v", texts("s_")).join(blocks(right, "v", "s", texts("v_")), [*on, "block_s", "block_v"])
    met = joined.where(F.col("kind") == first)
    return met.select(*columns, sum(a.cast("long") for a in agree).alias("matched_key_count"), gap.alias("length_gap"))


def _unique(keys: DataFrame, id_column: str) -> bool:
    return keys.groupBy(id_column).count().where((F.col("count") > 1) | F.col(id_column).isNull()).isEmpty()


def candidate_evidence(source_keys: DataFrame, vendor_keys: DataFrame) -> DataFrame:
    """`deduplicated(candidate_matches(...))` without a shuffle of pairs: classes are counted, and ids put in their place. Plainly where an id repeats."""
    source_keys, vendor_keys = settle(source_keys, "source_keys"), settle(vendor_keys, "vendor_keys")
    if not (_unique(source_keys, PAIR[0]) and _unique(vendor_keys, PAIR[1])):
        return deduplicated(candidate_matches(source_keys, vendor_keys))
    ids = [f"{c}s" for c in PAIR]
    s, v = settle(_classes(source_keys, PAIR[0]), "source_classes"), settle(_classes(vendor_keys, PAIR[1]), "vendor_classes")
    pairs = _class_pairs(s, v, *ids)
    return _with_ids(pairs, "matched_key_count", "length_gap")


def scored_candidates(source_keys: DataFrame, vendor_keys: DataFrame, digits: int | None = None) -> DataFrame:
    """All candidate pairs with matched_key_count, length_gap and similarity_score, rounded if wanted, which is worked out once for each pair of classes. Plainly where an id repeats."""
    score = lambda value: value if digits is None else F.round(value, digits)
    source_keys, vendor_keys = settle(source_keys, "source_keys"), settle(vendor_keys, "vendor_keys")
    if not (_unique(source_keys, PAIR[0]) and _unique(vendor_keys, PAIR[1])):
        scored = similarity_score(deduplicated(candidate_matches(source_keys, vendor_keys)), source_keys, vendor_keys)
        return scored.withColumn("similarity_score", score(F.col("similarity_score")))
    s, v = settle(_classes(source_keys, PAIR[0]), "source_classes"), settle(_classes(vendor_keys, PAIR[1]), "vendor_classes")
    # Texts and ids come along, so that no pair is shuffled.
    texts = {side: [f"{side}{c}" for c in TEXTS] for side in ("s_", "v_")}
    s, v = (x.withColumnsRenamed(dict(zip(TEXTS, names, strict=True))) for x, names in zip((s, v), texts.values(), strict=True))
    pairs = _class_pairs(s, v, *[f"{c}s" for c in PAIR], *texts["s_"], *texts["v_"])
    return _with_ids(pairs.withColumn("similarity_score", score(_similarity())), "matched_key_count", "length_gap", "similarity_score")


def deduplicated(matches: DataFrame) -> DataFrame:
    """One row for each pair: how many kinds of keys agree, and the length gap."""
    return matches.groupBy(*PAIR).agg(F.count_distinct("blocking_key").alias("matched_key_count"), F.min("length_gap").alias("length_gap"))


def _similarity() -> Column:
    """The score of a pair from its texts, in columns that begin with s_ and v_."""
    name, legal, address = (jaro_winkler_bytes(F.col(f"s_{c}"), F.col(f"v_{c}")) for c in TEXTS)
    some = {c: (F.col(f"s_{c}") != "") & (F.col(f"v_{c}") != "") for c in TEXTS}
    part = lambda c, value: F.when(some[c], value).otherwise(F.lit(0.0))
    named = part("normalized_name", F.greatest(name, part("legal_name", legal)))
    return 0.7 * named + 0.3 * part("normalized_address", address)


def similarity_score(pairs: DataFrame, source_keys: DataFrame, vendor_keys: DataFrame) -> DataFrame:
    """Add similarity_score: 0.7 of the better name similarity and 0.3 of that of the addresses; empty texts count 0."""
    s = source_keys.select(PAIR[0], *[F.col(c).alias(f"s_{c}") for c in TEXTS])
    v = vendor_keys.select(PAIR[1], *[F.col(c).alias(f"v_{c}") for c in TEXTS])
    both = pairs.join(shuffled(s), PAIR[0]).join(shuffled(v), PAIR[1])
    return both.withColumn("similarity_score", _similarity()).select(*pairs.columns, "similarity_score")


def top_candidates(pairs: DataFrame, source_keys: DataFrame, vendor_keys: DataFrame, top_k: int = 30, digits: int | None = None) -> DataFrame:
    """The best k pairs of each record by key count, similarity, length gap and vendor id.

    Only ids are returned, so the similarity matters only where a class of equal key counts straddles
    rank k: classes wholly above it are kept and those below dropped without any string kernel.
    digits: round the similarity before ranking, for comparison with engines that add in another order.
    """
    if top_k < 1:
        raise ValueError("top_k must be at least 1")
    own = Window.partitionBy(PAIR[0])
    above = own.orderBy(F.desc("matched_key_count")).rangeBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy(PAIR[0], "matched_key_count")
    ranked = pairs.withColumn("above", F.count("*").over(above)).withColumn("same", F.count("*").over(same))
    ranked = ranked.where(F.col("above") < top_k)
    sure = ranked.where(F.col("above") + F.col("same") <= top_k).select(*PAIR)
    open_ = ranked.where(F.col("above") + F.col("same") > top_k).select(*PAIR, "length_gap", "above")
    scored = similarity_score(open_, source_keys, vendor_keys)
    score = F.col("similarity_score") if digits is None else F.round("similarity_score", digits)
    place = F.row_number().over(own.orderBy(score.desc(), "length_gap", PAIR[1]))
    return sure.union(scored.withColumn("place", place).where(F.col("place") <= top_k - F.col("above")).select(*PAIR))


def _by_sets(rows: DataFrame, *columns: str) -> DataFrame:
    """A row for each set of kinds all of whose keys a row has: the given columns, bits (the set), keys (those of the set, else '', which no key is)."""
    def held(bits):
        inside = [bool(bits >> i & 1) for i in range(len(KEY_KINDS))]
        keys = [F.col(f"key_{k}") for k in KEY_KINDS]
        whole = reduce(and_, [key.isNotNull() for key, used in zip(keys, inside, strict=True) if used])
        return F.when(whole, F.struct(F.lit(bits).alias("bits"), F.array(*[key if used else F.lit("") for key, used in zip(keys, inside, strict=True)]).alias("keys")))

    sets = F.filter(F.array(*[held(bits) for bits in range(1, 1 << len(KEY_KINDS))]), lambda x: x.isNotNull())
    return rows.select(*columns, F.explode(sets).alias("_set")).select(*columns, "_set.bits", "_set.keys")


def _tiers(source: DataFrame, vendors: DataFrame, top_k: int) -> DataFrame:
    """For each row of the source with a candidate: tier, the key count at which rank k is reached (or the least, with fewer candidates), above and same, the candidates with more keys and with so many.

    No pair is made: vendors are counted for each set of keys, and those that agree in exactly so many kinds follow by inclusion and exclusion.
    """
    kinds = range(1, len(KEY_KINDS) + 1)
    counts = _by_sets(vendors, "n").groupBy("bits", "keys").agg(F.sum("n").alias("n"))
    sums = [F.coalesce(F.sum(F.when(F.bit_count("bits") == size, F.col("n"))), F.lit(0)).alias(f"_{size}") for size in kinds]
    met = _by_sets(source, PAIR[0]).join(shuffled(counts), ["bits", "keys"]).groupBy(PAIR[0]).agg(*sums)
    exactly = {j: sum((F.col(f"_{size}") * ((-1) ** (size - j) * comb(size, j)) for size in kinds if size >= j), F.lit(0)) for j in kinds}
    exact = met.select(PAIR[0], *[exactly[j].alias(f"_e{j}") for j in kinds])
    above = {j: sum((F.col(f"_e{i}") for i in kinds if i > j), F.lit(0)) for j in kinds}
    tier = reduce(lambda c, j: c.when((above[j] < top_k) & (F.col(f"_e{j}") > 0), j), kinds, F)
    picked = lambda values: reduce(lambda c, j: c.when(F.col("tier") == j, values[j]), kinds, F)
    return exact.withColumn("tier", tier).select(PAIR[0], "tier", picked(above).cast("long").alias("above"), picked({j: F.col(f"_e{j}") for j in kinds}).cast("long").alias("same"))


def _sides(tiers: DataFrame, source: DataFrame, vendors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows for each set of kinds, of the source only sets of as many kinds as its tier, with all columns but the keys."""
    more = ["name_length", "address_length", "key_word_digit", *TEXTS]
    left = _by_sets(source.join(shuffled(tiers), PAIR[0]), PAIR[0], "tier", "above", "same", *more).where(F.bit_count("bits") == F.col("tier"))
    return left, _by_sets(vendors, PAIR[1], *(c for c in ["first"] if c in vendors.columns), *more)


def _hot(left: DataFrame, right: DataFrame, on: list[str], source_block: int, vendor_block: int) -> DataFrame:
    """The keys with more than HOT_PAIRS pairs: parts_s and parts_v, into how many blocks either side goes."""
    n, m = left.groupBy(on).agg(F.count("*").alias("n")), right.groupBy(on).agg(F.count("*").alias("m"))
    many = n.join(shuffled(m), on).where(F.col("n") * F.col("m") > HOT_PAIRS)
    return many.select(*on, F.ceil(F.col("n") / source_block).cast("int").alias("parts_s"), F.ceil(F.col("m") / vendor_block).cast("int").alias("parts_v"))


def _in_blocks(rows: DataFrame, hot: DataFrame, on: list[str], own: str, other: str, by: str) -> DataFrame:
    """Rows with hot keys in a block of their side (`own`), once for each block of the other side (`other`)."""
    every = F.explode(F.sequence(F.lit(0), F.col(f"parts_{other}") - 1)).alias(f"block_{other}")
    return rows.join(hot, on).select(*rows.columns, F.pmod(F.xxhash64(by), F.col(f"parts_{own}")).cast("int").alias(f"block_{own}"), every)


def _pairs_from(tiers: DataFrame, source: DataFrame, vendors: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """The pairs, but for those of `hot` keys, that agree in at least as many kinds as the source's tier: ids, matched_key_count, length_gap, tier, above, same.

    They meet in a set of just so many kinds, and stay where it is the first of those in which they agree.
    """
    left, right = _sides(tiers, source, vendors)
    if hot is not None:
        left = left.join(hot, ["bits", "keys"], "left_anti")
    named = lambda rows, name: rows.withColumnsRenamed({c: f"{name}{c}" for c in ("name_length", "address_length", "key_word_digit", *TEXTS)})
    joined = named(left, "s_").join(shuffled(named(right, "v_")), ["bits", "keys"])
    compared = {"exact_name": "normalized_name", "word_digit": "key_word_digit", "exact_addr": "normalized_address", "legal_name": "legal_name"}
    agree = sum((F.when((F.col(f"s_{compared[k]}") == F.col(f"v_{compared[k]}")) & (F.col(f"s_{compared[k]}") != ""), 1 << i).otherwise(0) for i, k in enumerate(KEY_KINDS)), F.lit(0))
    up_to = F.element_at(F.array(*[F.lit((1 << bits.bit_length()) - 1) for bits in range(1, 1 << len(KEY_KINDS))]), F.col("bits"))
    gap = F.abs(F.col("s_name_length") - F.col("v_name_length")) + F.abs(F.col("s_address_length") - F.col("v_address_length"))
    met = joined.withColumn("_agree", agree).where(F.col("_agree").bitwiseAND(up_to) == F.col("bits"))
    return met.select(*PAIR, F.bit_count("_agree").alias("matched_key_count"), gap.alias("length_gap"), "tier", "above", "same")


def _rounded(scores: np.ndarray, digits: int) -> np.ndarray:
    """Rounded half up by their decimal digits, as Spark's round does."""
    scaled = scores * 10.0**digits
    whole = np.floor(scaled + 0.5)
    unit = Decimal(1).scaleb(-digits)
    for k in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-3):
        whole[k] = float(Decimal(repr(float(scores[k]))).quantize(unit, ROUND_HALF_UP).scaleb(digits))
    return whole


BEST_FIELDS = f"{PAIR[0]} long, {PAIR[1]} long, length_gap int, above long, similarity_score double"


def _best_of_block(top_k: int, digits: int | None):
    """A function of two Arrow tables, a block of either of `_sides`: of each row of the source the pairs above its tier, without a score, and the best k in it."""

    def coded(left, right, column):
        known: dict = {}
        return [np.array([-1 if not x else known.setdefault(x, len(known)) for x in t[column].to_pylist()], dtype=np.int64) for t in (left, right)]

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list = [[], [], [], [], []]
        if left.num_rows and right.num_rows:
            bits = left["bits"][0].as_py()
            up_to = (1 << bits.bit_length()) - 1
            numbers = lambda t, c: t[c].to_numpy()
            codes = [coded(left, right, c) for c in ("normalized_name", "key_word_digit", "normalized_address", "legal_name")]
            ids = {x: k for k, x in enumerate(sorted(set(right["first"].to_pylist())))}
            order = np.array([ids[x] for x in right["first"].to_pylist()])
            texts = {}
            for c in TEXTS:
                unique = list(dict.fromkeys(right[c].to_pylist()))
                at = {x: k for k, x in enumerate(unique)}
                texts[c] = (left[c].to_pylist(), Many([x.encode() for x in unique]), np.array([at[x] for x in right[c].to_pylist()]), {})

            def similarity(c, i, rows):
                mine, many, at, seen = texts[c]
                if mine[i] not in seen:
                    seen[mine[i]] = many.jaro_winkler(mine[i].encode())
                return seen[mine[i]][at[rows]]

            s_id, v_id = numbers(left, PAIR[0]), numbers(right, PAIR[1])
            tier, above, same = (numbers(left, c) for c in ("tier", "above", "same"))
            s_name, s_address = numbers(left, "name_length"), numbers(left, "address_length")
            v_name, v_address = numbers(right, "name_length"), numbers(right, "address_length")
            for i in range(left.num_rows):
                agree = np.zeros(right.num_rows, dtype=np.uint8)
                for k, (a, b) in enumerate(codes):
                    if a[i] >= 0:
                        agree |= (b == a[i]).astype(np.uint8) << k
                met = (agree & up_to) == bits
                count = np.bitwise_count(agree)
                higher, rows = np.flatnonzero(met & (count > tier[i])), np.flatnonzero(met & (count == tier[i]))
                gap = np.abs(s_name[i] - v_name) + np.abs(s_address[i] - v_address)
                score = np.full(len(rows), np.nan)
                if above[i] + same[i] > top_k and len(rows):
                    name = np.maximum(similarity("normalized_name", i, rows), similarity("legal_name", i, rows))
                    score = 0.7 * name + 0.3 * similarity("normalized_address", i, rows)
                    ranked = score if digits is None else _rounded(score, digits)
                    if len(rows) > top_k:
                        near = ranked >= np.partition(ranked, len(rows) - top_k)[len(rows) - top_k]
                        rows, score, ranked = rows[near], score[near], ranked[near]
                        first = np.lexsort((order[rows], gap[rows], -ranked))[:top_k]
                        rows, score = rows[first], score[first]
                for rows_, score_ in ((higher, np.full(len(higher), np.nan)), (rows, score)):
                    for values, more in zip(found, (np.full(len(rows_), s_id[i]), v_id[rows_], gap[rows_], np.full(len(rows_), above[i]), score_), strict=True):
                        values.append(more)
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.float64()]
        whole = [np.concatenate(x) if x else np.array([]) for x in found]
        columns = [pa.array(x.astype(t.to_pandas_dtype()), type=t, mask=np.isnan(x) if t == pa.float64() else None) for x, t in zip(whole, types, strict=True)]
        return pa.table(columns, names=[f.split()[0] for f in BEST_FIELDS.split(", ")])

    return best


def _best_in_blocks(left: DataFrame, right: DataFrame, hot: DataFrame, top_k: int, digits: int | None) -> DataFrame:
    """The pairs of hot keys that can be among the best k: those above the tier (or all, where its candidates are few), without a score, and in each block the best k of an open tier."""
    on = ["bits", "keys"]
    blocks = [*on, "block_s", "block_v"]
    s, v = _in_blocks(left, hot, on, "s", "v", PAIR[0]), _in_blocks(right, hot, on, "v", "s", PAIR[1])
    return s.groupBy(blocks).cogroup(v.groupBy(blocks)).applyInArrow(_best_of_block(top_k, digits), BEST_FIELDS)


def best_of_classes(source_keys: DataFrame, vendor_keys: DataFrame, top_ks: list[int], digits: int | None = None) -> list[DataFrame]:
    """`top_candidates` of all pairs with an equal key, for unique ids, by classes; one frame for each k of `top_ks`.

    Equal texts rank equally up to the id, so of each class of vendors only the first k ids can be among
    the best, and records of one class have the same candidates. Pairs are made only of classes that agree in as many kinds
    as those at rank k do, or more, and only such as straddle rank k are scored.
    """
    if min(top_ks) < 1:
        raise ValueError("top_k must be at least 1")
    s = settle(_classes(source_keys, PAIR[0], 1).drop(f"{PAIR[0]}s"), "source_classes")
    first = F.array_min(f"{PAIR[1]}s")[PAIR[1]].alias("first")
    v = settle(_classes(vendor_keys, PAIR[1], max(top_ks)).select("*", F.size(f"{PAIR[1]}s").alias("n"), first), "vendor_classes")
    ids = v.select(PAIR[1], F.col(f"{PAIR[1]}s").alias("ids"))
    own = Window.partitionBy(PAIR[0])
    named = lambda pairs, *kept: pairs.join(shuffled(ids), PAIR[1]).select(PAIR[0], *kept, F.explode("ids").alias("id")).select(PAIR[0], f"id.{PAIR[1]}", *kept)
    classes = s.select(F.col(PAIR[0]).alias("class"), *[F.col(c).alias(f"c_{c}") for c in PROFILE])
    members = source_keys.join(shuffled(classes), reduce(and_, [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in PROFILE])).select("class", F.col(PAIR[0]).alias("member"))
    if len(top_ks) > 1:
        members = settle(members, "members")

    def best(top_k):
        tiers = settle(_tiers(s, v, top_k), "tiers")
        left, right = _sides(tiers, s, v)
        hot = settle(_hot(left, right, ["bits", "keys"], SOURCE_BLOCK, VENDOR_BLOCK), "hot")
        some_hot = not hot.isEmpty()
        ranked = settle(_pairs_from(tiers, s, v, hot if some_hot else None), "ranked")
        open_ = (F.col("matched_key_count") == F.col("tier")) & (F.col("above") + F.col("same") > top_k)
        sure = ranked.where(~open_).select(*PAIR)
        scored = similarity_score(ranked.where(open_).select(*PAIR, "length_gap", "above"), s, v)
        if some_hot:
            blocks = settle(_best_in_blocks(left, right, hot, top_k, digits), "blocks")
            sure = sure.union(blocks.where(F.col("similarity_score").isNull()).select(*PAIR))
            scored = scored.union(blocks.where(F.col("similarity_score").isNotNull()).select(scored.columns))
        score = F.col("similarity_score") if digits is None else F.round("similarity_score", digits)
        # Every class has an id at least, so none after k better ones counts.
        near = scored.withColumn("score", score).withColumn("rank", F.rank().over(own.orderBy(F.desc("score"), "length_gap"))).where(F.col("rank") <= top_k)
        place = F.row_number().over(own.orderBy(F.desc("score"), "length_gap", PAIR[1]))
        found = named(near, "score", "length_gap", "above").withColumn("place", place).where(F.col("place") <= top_k - F.col("above")).select(*PAIR)
        return named(sure).union(found).withColumnRenamed(PAIR[0], "class").join(shuffled(members), "class").select(F.col("member").alias(PAIR[0]), PAIR[1])

    return [best(k) for k in top_ks]


def top_of_classes(source_keys: DataFrame, vendor_keys: DataFrame, top_k: int = 30, digits: int | None = None) -> DataFrame:
    """`best_of_classes` for one k."""
    return best_of_classes(source_keys, vendor_keys, [top_k], digits)[0]


def assert_unique_ids(entities: DataFrame, label: str) -> None:
    """Raise ValueError where an id occurs twice, since every later join would repeat its pairs."""
    twice = entities.groupBy("entity_id").count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"{label} has repeated ids, such as {', '.join(sorted(str(r.entity_id) for r in twice))}")


def ranked_candidates(source: DataFrame, vendors: DataFrame, top_ks: list[int], digits: int | None = None) -> list[DataFrame]:
    """From two entity tables to ranked candidate ids, source1_entity_id and vendor_entity_id, for each k of `top_ks`."""
    if min(top_ks) < 1:
        raise ValueError("top_k must be at least 1")
    for df, label in ((source, "Source 1"), (vendors, "Vendors")):
        require_columns(df, ENTITY_COLUMNS, label)
    s, v = keys_of_both(source, vendors)
    if _unique(s, PAIR[0]) and _unique(v, PAIR[1]):
        return best_of_classes(s, v, top_ks, digits)
    pairs = deduplicated(candidate_matches(s, v))
    return [top_candidates(pairs, s, v, k, digits) for k in top_ks]


def candidate_pairs(source: DataFrame, vendors: DataFrame, top_k: int = 30, digits: int | None = None) -> DataFrame:
    """From two entity tables to ranked candidate ids: source1_entity_id, vendor_entity_id."""
    return ranked_candidates(source, vendors, [top_k], digits)[0]
