"""A word model by deleted interpolation: maximum-likelihood estimates of each order, mixed by how often the context occurs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.text import chunks, mix, words
from kindred.session import release, settle, sweep

BATCH_BYTES = 5 << 20
#: A unit sends its keys to at most so many others; more are reached over several hops.
MAX_FAN = 256
#: The hash space is exchanged in so many parts, one after the other, so that only one part's keys are on disk at a time.
PASSES = 3
END, BEGIN = np.uint64(0x27D4EB2F165667C5), np.uint64(0x165667B19E3779F9)
LEFT, RIGHT = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x9FB21C651E98DF25)
#: The lowest bits of a key tell its order.
ORDER_BITS = 3
STEPS = 8
NEVER = 999
BUCKETS = 26
ROUNDS = 60
PRIOR = 1.0


def _squeeze(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _expand(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _keys_of(data: bytes) -> np.ndarray:
    return np.cumsum(_expand(data, np.uint64), dtype=np.uint64)


def _of_keys(keys: np.ndarray) -> bytes:
    return _squeeze(np.diff(keys, prepend=np.uint64(0)))


def _batches(docs: DataFrame, train: Column, extra: Column) -> DataFrame:
    """Documents in batches of about BATCH_BYTES of text, compressed; those that the weights are learned on apart."""
    fields = "batch long, extra boolean, raw long, ids array<long>, train array<boolean>, sizes array<long>, blob binary"

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held = {True: [[], [], [], [], 0], False: [[], [], [], [], 0]}

        def row(kind):
            nonlocal made
            ids, flags, sizes, parts, raw = held[kind]
            held[kind] = [[], [], [], [], 0]
            made += 1
            columns = [(task << 24) + made, kind, raw, ids, flags, sizes, zstandard.ZstdCompressor(level=3).compress(b"".join(parts))]
            types = [pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary()]
            names = ["batch", "extra", "raw", "ids", "train", "sizes", "blob"]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in given:
            for doc_id, text, flag, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = (text or "").encode()
                mine = held[kind]
                for column, value in zip(mine, (doc_id, flag, len(part), part), strict=False):
                    column.append(value)
                mine[4] += len(part)
                if mine[4] >= BATCH_BYTES:
                    yield row(kind)
        for kind in (True, False):
            if held[kind][0]:
                yield row(kind)

    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), train.alias("train"), extra.alias("extra"))
    return own.mapInArrow(run, fields)


def _grams(blob: bytes, sizes: list[int], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys of every word and end with the words before it, for 1 to `order` words, and how many each document has."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    offsets = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
    tagged = np.uint64((1 << 64) - (1 << ORDER_BITS))
    keys, lengths = [[] for _ in range(order)], []
    for low, high in chunks(offsets):
        part = offsets[low : high + 1]
        hashes, counts, _, _ = words(data[part[0] : part[-1]], part - part[0])
        ends = np.cumsum(counts + 1) - 1
        starts = ends - counts
        tokens = np.full(len(hashes) + len(counts), END, np.uint64)
        tokens[np.delete(np.arange(len(tokens)), ends)] = hashes
        run = mix(tokens)
        for k in range(order):
            if k:
                before = np.empty_like(run)
                before[1:] = run[:-1]
                before[starts] = mix(BEGIN + np.uint64(k))
                run = mix(before * LEFT + mix(tokens * RIGHT))
            keys[k].append(run & tagged | np.uint64(k + 1))
        lengths.append(counts + 1)
    return [np.concatenate(c) for c in keys], np.concatenate(lengths)


def _edges(keys: np.ndarray, prefix: int, fan: int, level: int) -> np.ndarray:
    """Where each of the `fan` parts of a unit's key range begins in sorted keys. The key space has fan**level ranges; the unit has that of number `prefix`."""
    ranges = fan ** (level + 1)
    firsts = [-(-((prefix * fan + k) << 64) // ranges) for k in range(1, fan)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(firsts, np.uint64)), [len(keys)]])


SENT = "prefix long, unit long, sender long, keys binary, every binary, extra binary"


def _sent(prefix: int, unit: int, sender: int, keys: np.ndarray, every: np.ndarray, extra: np.ndarray, fan: int, level: int, ranges: range | None = None) -> pa.RecordBatch:
    """A unit's keys and counts, dealt to the units of the next level, or to those of `ranges`: unit tells those of one range apart."""
    edges = _edges(keys, prefix, fan, level)
    parts = [(k, edges[k], edges[k + 1]) for k in (range(fan) if ranges is None else ranges) if edges[k + 1] > edges[k]]
    rows = [(prefix * fan + k, unit, sender, _of_keys(keys[x:y]), _squeeze(every[x:y]), _squeeze(extra[x:y])) for k, x, y in parts]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(types), types, strict=True)], names=["prefix", "unit", "sender", "keys", "every", "extra"])


def _units(number: int, units: int) -> int:
    """Which of the units of the next level a sender belongs to."""
    return int(mix(np.array([number], np.int64).view(np.uint64))[0] % np.uint64(units))


def _asked(batches: DataFrame, order: int, fan: int, units: int, ranges: range | None = None) -> DataFrame:
    """Each batch's distinct keys, or those in `ranges` of the `fan` parts of the hash space, and their counts in training text (every) and in that on which weights are learned (extra)."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            for r in range(batch.num_rows):
                number, extra, train, sizes, blob = (batch.column(k)[r].as_py() for k in range(5))
                grams, lengths = _grams(blob, sizes, order)
                weights = np.repeat(np.array(train, bool), lengths)
                keys, places = np.unique(np.concatenate(grams), return_inverse=True)
                every = np.bincount(places, np.tile(weights, order), len(keys)).astype(np.uint32)
                yield _sent(0, _units(number, units), number, keys, every, every if extra else np.zeros_like(every), fan, 0, ranges)

    return batches.select("batch", "extra", "train", "sizes", "blob").mapInArrow(run, SENT)


def _merged(rows: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct keys of all senders, the places of each sender's among them, and the sums of the counts."""
    keys = [_keys_of(x.as_py()) for x in rows["keys"]]
    distinct, places = np.unique(np.concatenate(keys), return_inverse=True)
    sums = [np.bincount(places, np.concatenate([_expand(x.as_py(), np.uint32) for x in rows[c]]), len(distinct)).astype(np.uint32) for c in ("every", "extra")]
    return distinct, np.split(places, np.cumsum([len(k) for k in keys])[:-1]), *sums


def _number(prefix: int, unit: int) -> int:
    return prefix << 24 | unit


def _passed_on(sent: DataFrame, fan: int, level: int, units: int) -> DataFrame:
    """What units sum up over their senders, dealt to the units of the next level."""

    def run(rows: pa.Table) -> pa.Table:
        prefix, unit = rows["prefix"][0].as_py(), rows["unit"][0].as_py()
        keys, _, every, extra = _merged(rows)
        return pa.Table.from_batches([_sent(prefix, _units(unit, units), _number(prefix, unit), keys, every, extra, fan, level)])

    return sent.groupBy("prefix", "unit").applyInArrow(run, SENT)


ANSWER = "sender long, prefix long, mine boolean, every binary, extra binary, total long, types long, total_extra long"
ANSWER_KINDS = {"sender": pa.int64(), "prefix": pa.int64(), "mine": pa.bool_(), "every": pa.binary(), "extra": pa.binary(), "total": pa.int64(), "types": pa.int64(), "total_extra": pa.int64()}


def _answers(rows: pa.Table, places: list[np.ndarray], every: np.ndarray, extra: np.ndarray, more: list[tuple]) -> pa.Table:
    """For each sender, by how much the sums are above its own counts; that is mostly 0 and packs well. mine: whether the sender has extra text."""
    out = list(more)
    prefix = rows["prefix"][0].as_py()
    for r, own in enumerate(places):
        theirs = {c: _expand(rows[c][r].as_py(), np.uint32) for c in ("every", "extra")}
        out.append((rows["sender"][r].as_py(), prefix, bool(theirs["extra"].any()), _squeeze(every[own] - theirs["every"]), _squeeze(extra[own] - theirs["extra"]), 0, 0, 0))
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), ANSWER_KINDS.values(), strict=True)], names=list(ANSWER_KINDS))


def _answered(sent: DataFrame) -> DataFrame:
    """The units of the last level see a range's keys from all senders. A row for each with sender -1 has the words and distinct words in training."""

    def run(rows: pa.Table) -> pa.Table:
        keys, places, every, extra = _merged(rows)
        single = (keys & np.uint64((1 << ORDER_BITS) - 1)) == 1
        known = (-1, rows["prefix"][0].as_py(), False, None, None, int(every[single].sum(dtype=np.int64)), int((every[single] > 0).sum()), int(extra[single].sum(dtype=np.int64)))
        return _answers(rows, places, every, extra, [known])

    return sent.groupBy("prefix").applyInArrow(run, ANSWER)


def _passed_back(sent: DataFrame, answers: DataFrame) -> DataFrame:
    """What units of a middle level answer their senders, from the answers that they got."""

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.Table.from_batches([], schema=pa.schema(list(ANSWER_KINDS.items())))
        _, places, every, extra = _merged(rows)
        order = np.argsort(np.array(found["prefix"].to_pylist()))
        every, extra = (own + np.concatenate([_expand(found[c][int(k)].as_py(), np.uint32) for k in order]) for own, c in ((every, "every"), (extra, "extra")))
        return _answers(rows, places, every, extra, [])

    numbered = sent.withColumn("number", F.shiftleft("prefix", 24).bitwiseOR(F.col("unit")))
    return numbered.groupBy("number").cogroup(answers.where("sender >= 0").withColumn("number", F.col("sender")).groupBy("number")).applyInArrow(lambda x, y: run(x.drop_columns(["number"]), y.drop_columns(["number"])), ANSWER)


def _exchanged(batches: DataFrame, order: int, part: int = 0, passes: int = 1, spent: list[DataFrame] | None = None) -> DataFrame | None:
    """The counts of every batch's keys over all batches.

    With up to MAX_FAN batches, each sends a part of its keys to as many units as there are batches.
    With more, units pass on the sums of a few senders each, over as many hops as it takes, and answer
    them on the way back. So what is sent is at most MAX_FAN rows for each batch and hop, and what a
    unit holds is about what a batch holds, at any number of batches. With several passes, only the
    keys in one part of the hash space; nothing where there are more passes than parts. spent, if
    given, gets the tables that nothing needs afterwards.
    """
    n = max(1, batches.count())
    hops = 1
    while MAX_FAN**hops < n:
        hops += 1
    fan = next(f for f in range(max(1, int(n ** (1 / hops)) - 1), n + 2) if f**hops >= n)
    units = [-(-n // fan ** (k + 1)) for k in range(hops)]
    ranges = range(part * fan // passes, (part + 1) * fan // passes)
    if not ranges:
        return None
    sent = [_asked(batches, order, fan, units[0], ranges)]
    for k in range(1, hops):
        sent[-1] = settle(sent[-1], "sent")
        sent.append(_passed_on(sent[-1], fan, k, units[k]))
    done = sent[:-1]
    answers = settle(_answered(sent.pop()), "counts")
    if hops == 1:
        return answers
    known = settle(answers.where("sender = -1"), "known")
    while sent:
        done.append(answers)
        answers = settle(_passed_back(sent.pop(), answers), "counts")
    if spent is not None:
        spent.extend(done)
    return answers.where("sender >= 0").unionByName(known)


@dataclass
class Counts:
    """Of each token of a batch, how often it occurs with the words before it, by order; how often those occur; and the documents' lengths."""

    grams: list[np.ndarray]
    contexts: list[np.ndarray]
    lengths: np.ndarray


def _counts(batch: pa.Table, answers: pa.Table, order: int, kept: bool, total: int) -> Counts:
    """From all training text or, if `kept`, from that without the extra documents."""
    train = np.array(batch["train"][0].as_py(), bool)
    keys, lengths = _grams(batch["blob"][0].as_py(), batch["sizes"][0].as_py(), order)
    distinct, places = np.unique(np.concatenate(keys), return_inverse=True)
    found = np.bincount(places, np.tile(np.repeat(train, lengths), order), len(distinct))
    own = found.copy() if batch["extra"][0].as_py() else np.zeros_like(found)
    rows = np.argsort(np.array(answers["prefix"].to_pylist()))
    found += np.concatenate([_expand(answers["every"][int(k)].as_py(), np.uint32) for k in rows])
    if kept:
        found -= own + np.concatenate([_expand(answers["extra"][int(k)].as_py(), np.uint32) for k in rows])
    n = int(lengths.sum())
    grams = [found[places[k * n : (k + 1) * n]] for k in range(order)]
    ends = np.cumsum(lengths)
    contexts = [np.full(n, float(total))]
    for k in range(1, order):
        context = np.empty(n)
        context[1:] = grams[k - 1][:-1]
        # Texts begin as often as they end.
        context[ends - lengths] = grams[0][ends - 1]
        contexts.append(context)
    return Counts(grams, contexts, lengths)


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(context)[1], BUCKETS - 1)


def estimates(counts: Counts, weights: np.ndarray, types: int) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the tokens when as many orders are mixed as there are rows of weights; and the next order's own estimates (0 beyond the last)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        own = [np.where(c > 0, g / c, 0) for g, c in zip(counts.grams, counts.contexts, strict=True)]
    p = np.full(len(own[0]), 1 / (types + 1))
    for mine, context, shares in zip(own, counts.contexts, weights, strict=False):
        share = np.where(context > 0, shares[_bucket(context)], 0)
        p = share * mine + (1 - share) * p
    return p, own[len(weights)] if len(weights) < len(own) else np.zeros_like(p)


def events(counts: Counts, weights: np.ndarray, types: int) -> tuple[np.ndarray, np.ndarray]:
    """Held-out tokens by the next order's context bucket, and by its own estimate and the one below, these in eighths of an octave: codes and numbers."""
    below, own = estimates(counts, weights, types)
    context = counts.contexts[len(weights)]
    with np.errstate(divide="ignore"):
        steps = [np.where(p > 0, np.minimum(np.round(-STEPS * np.log2(p)), NEVER - 1), NEVER).astype(np.int64) for p in (own, below)]
    return np.unique((_bucket(context) * 1000 + steps[0]) * 1000 + steps[1], return_counts=True)


def mixture_weights(codes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Expectation-maximisation for each context bucket: the share of an order's own estimate against the one below.

    A bucket without held-out tokens has the share of the nearest one below that has some. Each side
    has a prior of one token, so that no share is 0 or 1.
    """
    bucket, own, below = codes // 1_000_000, codes // 1000 % 1000, codes % 1000
    own, below = (np.where(x < NEVER, 2.0 ** (-x / STEPS), 0) for x in (own, below))
    weights, last = np.zeros(BUCKETS), 0.5
    for k in range(BUCKETS):
        mine = bucket == k
        if mine.any():
            share, n = 0.5, numbers[mine].astype(np.float64)
            for _ in range(ROUNDS):
                part = share * own[mine]
                gained = (part / np.maximum(part + (1 - share) * below[mine], 1e-300) * n).sum()
                share = (gained + PRIOR) / (n.sum() + 2 * PRIOR)
            last = share
        weights[k] = last
    return weights


def _events(batches: DataFrame, answers: DataFrame, order: int, weights: np.ndarray, total: int, types: int) -> DataFrame:
    def run(batch: pa.Table, found: pa.Table) -> pa.Table:
        codes, n = events(_counts(batch, found, order, True, total), weights, types) if batch.num_rows else (np.zeros(0, np.int64),) * 2
        return pa.table({"code": pa.array(codes, pa.int64()), "n": pa.array(n.astype(np.int64), pa.int64())})

    rows = batches.groupBy("batch").cogroup(answers.groupBy("sender")).applyInArrow(run, "code long, n long")
    return rows.groupBy("code").agg(F.sum("n").alias("n"))


def _scores(batches: DataFrame, answers: DataFrame, order: int, weights: np.ndarray, total: int, types: int) -> DataFrame:
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(batch: pa.Table, found: pa.Table) -> pa.Table:
        if not batch.num_rows:
            return pa.Table.from_arrays([pa.array([], k) for k in kinds], names=names)
        counts = _counts(batch, found, order, False, total)
        word, lengths = counts.grams[0], counts.lengths
        p, _ = estimates(counts, weights, types)
        starts = np.cumsum(lengths) - lengths
        base = np.log10((word + 1) / (total + types + 1))
        columns = [batch["ids"][0].values, [not x for x in batch["train"][0].as_py()], lengths, np.add.reduceat((word > 0).astype(np.int64), starts), np.full(len(lengths), total), np.add.reduceat(base, starts), np.add.reduceat(np.log10(p), starts)]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    fields = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return batches.groupBy("batch").cogroup(answers.groupBy("sender")).applyInArrow(run, fields)


def interpolated_scores(docs: DataFrame, train: Column, order: int = 3, extra_share: int = 10) -> DataFrame:
    """The log10 probability of every text under a word model learned from the rows where `train` holds.

    docs: doc_id, text and any others, which are ignored. Words stand between ASCII white space, A-Z
    lower-cased; after the last comes an end, so a null or empty text is one token. Returns doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score (words alone, add-one) and score, a row for
    each row of the input; repeated rows count and score each, and equal texts score the same. Null
    ids are kept. An empty table has no rows, and without training rows every word is unknown.

    `order`, 1 to 7: how many words a run has. From single words up, the maximum-likelihood estimate
    of each order is mixed with what the orders below give; the share depends on the power of two of
    how often the context occurs. Counts are of all training text: each batch of documents sends its
    distinct runs of words, with counts, to units that each have a range of their hashes, and gets the
    sums back, so no task holds more than a batch or a unit, and a frequent word is one key in each
    batch. The hash space goes in PASSES parts, one after the other: batches are cut into words anew
    for each, and what was sent for one is deleted before the next. One training document in `extra_share`, by a hash of its id, is the held-out text: counts
    without these give the estimates on which expectation-maximisation learns the shares; the scores
    then use the counts of all training text. Held-out tokens reach the driver as a histogram of
    bounded size, one for each order. A batch of 5 MB of text is what a task holds; a longer text is a
    batch alone. 61-bit hashes tell runs of words apart.
    """
    if not 1 <= order < 1 << ORDER_BITS:
        raise ValueError(f"an order of {order} isn't possible")
    train = F.coalesce(train, F.lit(True))
    extra = train & (F.pmod(F.xxhash64("doc_id", F.lit("held-out counts")), F.lit(extra_share)) == 0)
    batches = settle(_batches(docs, train, extra), "batches")
    parts = []
    for part in range(PASSES):
        spent: list[DataFrame] = []
        parts.append(_exchanged(batches, order, part, PASSES, spent))
        release(*spent)
        spent.clear()
        sweep(batches.sparkSession)
    answers = reduce(DataFrame.unionByName, [p for p in parts if p is not None])
    known = answers.where("sender = -1").agg(F.sum("total").alias("total"), F.sum("types").alias("types"), F.sum("total_extra").alias("extra")).first()
    total, types, kept = known.total or 0, known.types or 0, (known.total or 0) - (known.extra or 0)
    found, weights = answers.where("sender >= 0"), np.zeros((0, BUCKETS))
    for _ in range(order):
        learned = _events(batches.where("extra"), found.where("mine").select("sender", "prefix", "every", "extra"), order, weights, kept, types).toArrow()
        weights = np.vstack([weights, mixture_weights(learned["code"].to_numpy(), learned["n"].to_numpy())])
    return _scores(batches, found.select("sender", "prefix", "every"), order, weights, total, types)
