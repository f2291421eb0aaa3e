"""Exact Jaccard joins of word shingles, by prefix filters under several token orders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.components import components
from kindred.llm.text import mix, shingle_sets
from kindred.session import lean, release, settle

SKETCH_BITS, SLICES = 23, 64
FLUSH = 1_000_000
BLOOM_BITS = 25
LARGE_BUCKET = 16
HUB_ROUNDS = 2
#: Longs of the signature of a prefix, under each of the orders after the first.
SIGN_WORDS = 8
ORDER_SEEDS = (0x51ED270B27B4F3CF, 0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93)


def prefix_length(n, percent: int):
    """How many of a set's first tokens, in any order, must have one in common with any linked set."""
    return n - (percent * n + 99) // 100 + 1


def needed(na, nb, percent: int):
    """The least intersection with which sets of these sizes link."""
    return -(-percent * (na + nb) // (100 + percent))


def _node(tokens: np.ndarray) -> int:
    total = int(mix(tokens).sum(dtype=np.uint64)) + len(tokens) * ORDER_SEEDS[0]
    return int(mix(np.array([total & (2**64 - 1)], np.uint64)).view(np.int64)[0])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


class _Seen(set):
    """Nodes that this task has had; forgetting only costs repeated rows, which are merged later."""

    def first(self, node: int) -> bool:
        if node in self:
            return False
        if len(self) > 1_000_000:
            self.clear()
        self.add(node)
        return True


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _counter(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _classes(docs: DataFrame, width: int) -> DataFrame:
    """kind 0: a document (a doc_id, b node, n set size); kind 1: a slice (a) of this task's counts of its distinct sets' tokens, by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = _Seen(), [], 0
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            ids, nodes, sizes = batch.column(0), [], []
            for tokens in shingle_sets(batch.column(1), width):
                node = _node(tokens) if len(tokens) else None
                nodes.append(node)
                sizes.append(len(tokens))
                if node is not None and seen.first(node):
                    held.append(_counter(tokens))
                    size += len(tokens)
                    if size > FLUSH:
                        np.add.at(counts, np.concatenate(held), 1)
                        held, size = [], 0
            yield _rows(np.zeros(len(sizes), np.int32), ids, nodes, sizes, [None] * len(sizes))
        if held:
            np.add.at(counts, np.concatenate(held), 1)
        parts = counts.reshape(SLICES, -1)
        made = [(k, zstandard.ZstdCompressor(level=1).compress(part.tobytes())) for k, part in enumerate(parts) if part.any()]
        if made:
            where, packed = zip(*made, strict=True)
            yield _rows(np.ones(len(made), np.int32), list(where), [None] * len(made), [0] * len(made), list(packed))

    return _texts(docs).mapInArrow(lean(run), "kind int, a long, b long, n long, counts binary")


def _rows(kind, a, b, n, counts) -> pa.RecordBatch:
    kinds = {"kind": pa.int32(), "a": pa.int64(), "b": pa.int64(), "n": pa.int64(), "counts": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((kind, a, b, n, counts), kinds.values(), strict=True)], names=list(kinds))


def _frequencies(slices: DataFrame) -> np.ndarray:
    """How often tokens of each hash prefix occur, in sixteenths of an octave: a table of fixed size at any scale."""

    def total(rows: pa.Table) -> pa.Table:
        out = np.zeros((1 << SKETCH_BITS) // SLICES)
        for x in rows["counts"]:
            out += np.frombuffer(zstandard.ZstdDecompressor().decompress(x.as_py()), np.uint32)
        packed = zstandard.ZstdCompressor(level=1).compress(np.minimum(np.log2(1 + out) * 16, 511).astype(np.uint16).tobytes())
        return pa.table({"a": pa.array([rows["a"][0].as_py()], pa.int64()), "counts": pa.array([packed], pa.binary())})

    found = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), np.uint16)
    for r in slices.select("a", "counts").groupBy("a").applyInArrow(total, "a long, counts binary").collect():
        found[r.a] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(r.counts)), np.uint16)
    return found.ravel()


def ordered(tokens: np.ndarray, often: np.ndarray, seed: int) -> np.ndarray:
    """Places of a set's tokens in a global order: rare tokens first, those about as frequent by a hash.

    The first order tells frequencies apart by sixteenths of an octave, the others by whole octaves, so
    each order begins with the rare tokens and has the others in a place of its own.
    """
    mixed = mix(tokens ^ np.uint64(seed))
    if seed == ORDER_SEEDS[0]:
        return often.astype(np.uint64) << np.uint64(55) | mixed >> np.uint64(9)
    return (often >> 4).astype(np.uint64) << np.uint64(59) | mixed >> np.uint64(5)


def prefix_of(tokens: np.ndarray, often: np.ndarray, seed: int, percent: int) -> np.ndarray:
    """The places in `tokens` of the set's prefix under an order, the first one first."""
    place, keep = ordered(tokens, often, seed), prefix_length(len(tokens), percent)
    first = np.argpartition(place, keep - 1)[:keep] if keep < len(tokens) else np.arange(len(tokens))
    return first[np.argsort(place[first])]


def signature(prefix: np.ndarray, seed: int) -> np.ndarray:
    """Bits for the tokens of a prefix. Each bit that another signature lacks is a token that the other prefix lacks."""
    bits = np.zeros(64 * SIGN_WORDS, np.uint8)
    bits[(mix(prefix ^ np.uint64(seed)) & np.uint64(64 * SIGN_WORDS - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def _prefixes(docs: DataFrame, width: int, percent: int, frequencies: np.ndarray) -> DataFrame:
    """Of each set: node, n, the tokens of its prefix under the first order, and the signatures of its prefixes under the others."""
    table = docs.sparkSession.sparkContext.broadcast(frequencies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, known = _Seen(), table.value
        for batch in batches:
            nodes, sizes, prefixes, signs = [], [], [], []
            for tokens in shingle_sets(batch.column(1), width):
                if not len(tokens) or not seen.first(node := _node(tokens)):
                    continue
                often = known[_counter(tokens)]
                nodes.append(node)
                sizes.append(len(tokens))
                prefixes.append(_signed(tokens[prefix_of(tokens, often, ORDER_SEEDS[0], percent)]))
                signs.append(np.concatenate([signature(tokens[prefix_of(tokens, often, seed, percent)], seed) for seed in ORDER_SEEDS[1:]]))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((nodes, sizes, prefixes, signs), kinds, strict=True)], names=["node", "n", "tokens", "sign"])

    return _texts(docs).mapInArrow(lean(run), "node long, n long, tokens array<long>, sign array<long>")


def _bloom(keys: DataFrame, name: str):
    """A broadcast table of one bit for each hash prefix, set for those of the keys: of fixed size at any scale."""
    bit = F.shiftrightunsigned(name, 64 - BLOOM_BITS)
    mask = F.expr("shiftleft(1L, cast(bit % 64 as int))")
    words = keys.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("w")).agg(F.bit_or(mask).alias("v")).toArrow()
    table = np.zeros(1 << (BLOOM_BITS - 6), np.int64)
    table[words["w"].to_numpy()] = words["v"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(table.view(np.uint8))


def _holds(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys the Bloom table lets pass."""
    bit = keys.astype(np.int64, copy=False).view(np.uint64) >> np.uint64(64 - BLOOM_BITS)
    return (table[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _shared(prefixes: DataFrame) -> DataFrame:
    """Rows of the prefixes whose token another set's prefix has as well: token, place, node, n. A Bloom filter spares most others the way."""
    tokens = prefixes.select(F.explode("tokens").alias("token"))
    met = settle(tokens.groupBy("token").agg(F.count("*").alias("rows")).where("rows > 1").select("token"), "met")
    bloom = _bloom(met, "token")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bloom.value
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            token = lists.flatten().to_numpy(zero_copy_only=False)
            place = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = _holds(bits, token)
            node, n = (np.repeat(batch.column(k).to_numpy(zero_copy_only=False), sizes)[keep] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(token[keep]), pa.array(place[keep].astype(np.int32)), pa.array(node), pa.array(n)], names=["token", "place", "node", "n"])

    rows = prefixes.select("node", "n", "tokens").mapInArrow(lean(run), "token long, place int, node long, n long")
    return rows.join(met, "token", "left_semi").distinct()


def _sets(docs: DataFrame, width: int, wanted: DataFrame) -> DataFrame:
    """The whole sets of the wanted nodes: node, tokens. A Bloom filter of fixed size spares the others the way."""
    bloom = _bloom(wanted, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, bits = _Seen(), bloom.value
        for batch in batches:
            nodes, held = [], []
            for tokens in shingle_sets(batch.column(1), width):
                if len(tokens) and _holds(bits, np.array([node := _node(tokens)]))[0] and seen.first(node):
                    nodes.append(node)
                    held.append(tokens.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(held, pa.binary())], names=["node", "tokens"])

    found = _texts(docs).mapInArrow(lean(run), "node long, tokens binary").join(wanted, "node", "left_semi")
    return found.groupBy("node").agg(F.first("tokens").alias("tokens"))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link, by their whole intersection."""
    need = needed(len(a), len(b), percent)
    return min(len(a), len(b)) >= need and len(np.intersect1d(a, b, assume_unique=True)) >= need


def _verified(docs: DataFrame, width: int, percent: int, pairs: DataFrame) -> DataFrame:
    """Those pairs of nodes that link: a, b."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = _sets(docs, width, settle(ends, "ends"))
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return settle(both.select("a", "b", "ta", "tb").mapInArrow(lean(run), "a long, b long"), "links")


def _need(percent: int, x: str, y: str):
    """The least intersection with which sets of the sizes in these columns link."""
    return F.expr(f"({percent} * ({x} + {y}) + {99 + percent}) div {100 + percent}")


def _early(percent: int):
    """Whether the token that rows x and y have in common can be the first that linked sets share: enough of both must stand behind it in the first order."""
    need = _need(percent, "x.n", "y.n")
    return (F.col("x.n") - F.col("x.place") >= need) & (F.col("y.n") - F.col("y.place") >= need)


def _in_further_orders(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose prefixes can share enough under all further orders as well.

    Signatures tell how many tokens of each prefix the other surely lacks; the others, with all that
    is behind the prefixes, must be enough for a link.
    """
    signs = prefixes.select("node", "n", "sign")
    for t in ("a", "b"):
        own = signs.select(F.col("node").alias(t), F.col("n").alias(f"n{t}"), F.col("sign").alias(f"sign_{t}"))
        pairs = pairs.join(own.join(pairs.select(t).distinct(), t, "left_semi").dropDuplicates([t]), t)
    need = _need(percent, "na", "nb")
    length = {t: F.expr(f"n{t} - ({percent} * n{t} + 99) div 100 + 1") for t in ("a", "b")}
    behind = F.greatest(*[F.col(f"n{t}") - length[t] for t in ("a", "b")])
    met = F.lit(True)
    for order in range(len(ORDER_SEEDS) - 1):
        for t, u in (("a", "b"), ("b", "a")):
            bits = [(F.get(f"sign_{t}", F.lit(k)), F.get(f"sign_{u}", F.lit(k))) for k in range(order * SIGN_WORDS, (order + 1) * SIGN_WORDS)]
            alone = sum((F.bit_count(p.bitwiseAND(F.bitwise_not(q))) for p, q in bits), F.lit(0))
            met = met & (length[t] - alone + behind >= need)
    return pairs.where(met).select("a", "b")


def _rooted(shared: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Rows of tokens that several components share, with their component (root), whether it is the one with the most rows of the token (major), and how many rows the others have (minors)."""
    shared = shared.select("token", "place", "node", "n")
    rooted = shared.withColumn("root", F.col("node")) if roots is None else shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kinds = rooted.groupBy("token", "root").agg(F.count("*").alias("rows"))
    most = kinds.groupBy("token").agg(F.max(F.struct("rows", "root")).alias("most"), F.sum("rows").alias("all"), F.count("*").alias("kinds")).where("kinds > 1")
    return rooted.join(most, "token").select("token", "place", "node", "n", "root", (F.col("root") == F.col("most.root")).alias("major"), (F.col("all") - F.col("most.rows")).alias("minors"))


def _pairs_of(met: DataFrame) -> DataFrame:
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _to_hubs(rooted: DataFrame, percent: int) -> DataFrame:
    """In large buckets only, each set with one: of those outside the largest component, the set in whose prefix the token comes first.

    So a large group of near copies is joined by one pair for each copy.
    """
    large = rooted.where(F.col("minors") >= LARGE_BUCKET)
    hubs = large.where("not major").groupBy("token").agg(F.min(F.struct("place", "node", "n", "root")).alias("hub")).select("token", "hub.*")
    met = large.alias("x").join(hubs.alias("y"), F.col("x.token") == F.col("y.token"))
    return _pairs_of(met.where((F.col("x.root") != F.col("y.root")) & _early(percent)))


def _crossing(rooted: DataFrame, percent: int) -> DataFrame:
    """All candidates in a bucket that are not yet in one component. One of the two is always outside the bucket's largest component."""
    met = rooted.where("not major").alias("x").join(rooted.alias("y"), F.col("x.token") == F.col("y.token"))
    once = F.col("y.major") | (F.col("x.node") < F.col("y.node"))
    return _pairs_of(met.where((F.col("x.root") != F.col("y.root")) & once & _early(percent)))


def similarity_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Components of the graph of all pairs whose shingle sets have a Jaccard similarity of at least `percent` hundredths.

    docs: doc_id, text and any others, which are ignored. Returns a row for each row of the input:
    doc_id, n_shingles, component_id, the smallest doc_id reachable. A set: the distinct shingles of
    `width` words, A-Z lower-cased, of the whole text; with fewer words, the whole sequence as one; a
    null or empty text has none and links with nothing. Null ids are kept and never the smallest.

    Equal sets are one node. Three global orders of the tokens begin with the rare ones, by counts from
    the whole corpus in a table of fixed size by hash (collisions change the work and never the result).
    Candidates share a token of their prefixes under the first order, early enough in both, and must
    then share enough of their prefixes under the second and the third, as far as signatures of fixed
    size tell; only those that pass all are verified by their whole sets. In large buckets each set is
    first paired with one other, a hub, and then only sets that the links so far don't connect.
    No candidate is capped, so no link is lost; shingles and sets are told apart by 64-bit hashes. Ties
    in frequency go by hash. Repeated rows are rows of their own and share a component.
    """
    found = settle(_classes(docs, width), "classes")
    rows = settle(found.where("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("node"), F.col("n").alias("n_shingles")), "rows")
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    prefixes = settle(_prefixes(docs, width, percent, _frequencies(found.where("kind = 1"))), "prefixes")
    release(found)
    shared = settle(_shared(prefixes), "shared")
    links = roots = None
    for last in [False] * HUB_ROUNDS + [True]:
        rooted = settle(_rooted(shared, roots), "rooted")
        release(shared)
        for find in (_crossing,) if last else (_to_hubs, _crossing):
            met = settle(find(rooted, percent), "pairs")
            pairs = settle(_in_further_orders(met, prefixes, percent), "candidates")
            release(met)
            if not pairs.isEmpty():
                break
        if not pairs.isEmpty():
            more = _verified(docs, width, percent, pairs)
            links = more if links is None else links.union(more)
            roots = components(links)
        if find is _crossing:
            release(rooted, prefixes)
            break
        shared = rooted
    if roots is None:
        least = nodes.select("node", F.col("least").alias("component_id"))
    else:
        placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        lowest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
        least = placed.join(lowest, "root").select("node", "component_id")
    alone = rows.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return rows.where("node is not null").join(least, "node").select("doc_id", "n_shingles", "component_id").union(alone)


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` without those that are in a component of a smaller doc_id; rows that repeat an id stay or go together."""
    ids = similarity_components(docs.select("doc_id", "text"), width, percent)
    gone = ids.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
