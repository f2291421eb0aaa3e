"""Toxic texts by two Kneser-Ney models of spelling, one for each class, over backoff counts that both share."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.fitting import one_row_each
from kindred.llm.text import CHUNK_BYTES, SYMBOL_BITS, SYMBOLS, Counter64, Remembered, Spelled, buffers, chunks, words
from kindred.session import lean, settle, small_batches

ORDER = 4
#: Words speak for a toxic text by what their log-likelihoods differ beyond these, so that chance differences of many words don't add up.
BEYOND = (1.0, 2.0, 4.0)
#: So many symbols at least count as a text's length.
LEAST_LENGTH = 20
FOLDS = 5
THRESHOLD = 0.3
APART = np.arange(256) < 128
APART[65:91] = APART[97:123] = APART[48:58] = False
#: Counts of ordinary and of toxic texts, fold by fold.
COUNTS = [f"c{k}" for k in range(2 * FOLDS)]


def _discount(counts: np.ndarray) -> float:
    one, two = float((counts == 1).sum()), float((counts == 2).sum())
    return min(max(one / (one + 2 * two), 0.1), 0.9) if one + two else 0.5


@dataclass
class Level:
    """Counts of one order: of each gram, and of each context its sum and how many grams follow it. A column for each class, or one for both."""

    grams: Counter64
    sums: Counter64
    kinds: Counter64
    discounts: np.ndarray

    @classmethod
    def of(cls, codes: np.ndarray, counts: np.ndarray) -> Level:
        """From distinct codes with counts (columns by class); a code's context is all but its last symbol."""
        order = np.argsort(codes)
        codes, counts = codes[order], counts[order].astype(np.float32)
        distinct, places = np.unique(codes >> np.uint64(SYMBOL_BITS), return_inverse=True)
        total = lambda x: np.stack([np.bincount(places, c, len(distinct)) for c in x.T], axis=1).astype(np.float32)
        return cls(Counter64(codes, counts), Counter64(distinct, total(counts)), Counter64(distinct, total(counts > 0)), np.array([_discount(c) for c in counts.T]))

    def mixed(self, codes: np.ndarray, contexts: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Interpolated log probabilities by class; those of the order below where the context is unknown."""
        total = self.sums(contexts)
        seen = total > 0
        safe = np.where(seen, total, 1)
        with np.errstate(divide="ignore"):
            own = np.log(np.maximum(self.grams(codes) - self.discounts, 0) / safe)
            rest = np.log(self.discounts * self.kinds(contexts) / safe) + below
        return np.where(seen, np.logaddexp(own, rest), below)


@dataclass
class Model:
    """shared: the backoff levels 1 to ORDER - 1, from both classes; top: for each class, runs of ORDER symbols or from the word's begin. The rest: how comparisons become scores."""

    shared: list[Level]
    top: Level
    weights: np.ndarray
    places: np.ndarray
    chances: np.ndarray

    def spelling(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of each word: its log-likelihood as an ordinary and as a toxic word, and its symbols."""
        spelled = Spelled(data, starts, ends)
        inner = spelled.place > 0
        place, owner = spelled.place[inner], spelled.word[inner]
        below = np.full((len(place), 1), -np.log(SYMBOLS))
        full = np.zeros(len(place), np.uint64)
        for k in range(1, ORDER + 1):
            codes = spelled.codes(k)[inner]
            usable = place + 1 > k
            if k < ORDER:
                own = codes[usable]
                below[usable] = self.shared[k - 1].mixed(own, own >> np.uint64(SYMBOL_BITS), below[usable])
            at = np.minimum(place + 1, ORDER) == k
            full[at] = codes[at]
        each = self.top.mixed(full, full >> np.uint64(SYMBOL_BITS), np.repeat(below, 2, axis=1))
        return np.column_stack([*(np.bincount(owner, c, len(starts)) for c in each.T), (ends - starts + 1).astype(float)])


def _counted(sample: DataFrame) -> DataFrame:
    """The distinct words of a sample (text, toxic, fold) with their counts."""
    fields = "key long, word string, " + ", ".join(f"{c} long" for c in COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            column = np.array(batch.column(1).to_pylist(), np.int64) + 2 * np.array(batch.column(2).to_pylist(), np.int64)
            for low, high in chunks(offsets):
                part = offsets[low : high + 1]
                piece = data[part[0] : part[-1]]
                hashes, counts, starts, ends = words(piece, part - part[0], APART)
                distinct, first, places = np.unique(hashes, return_index=True, return_inverse=True)
                n = len(distinct)
                each = np.bincount(places * len(COUNTS) + np.repeat(column[low:high], counts), minlength=len(COUNTS) * n).reshape(n, -1)
                text = [piece[a:b].tobytes().decode() for a, b in zip(starts[first], ends[first], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(text, pa.string()), *map(pa.array, each.T.astype(np.int64))], names=["key", "word", *COUNTS])

    rows = sample.select("text", "toxic", "fold").mapInArrow(lean(run), fields)
    return rows.groupBy("key").agg(F.any_value("word").alias("word"), *[F.sum(c).alias(c) for c in COUNTS])


def _grams(vocabulary: DataFrame) -> DataFrame:
    """Runs of symbols in distinct words. level 1 to 3: runs of one more symbol that occur at all; -1 to -3: of how many words (c0) they are the begin; 0: of ORDER symbols or from a word's begin, with the counts of the words."""
    fields = "level int, code long, " + ", ".join(f"{c} long" for c in COUNTS)

    def rows(level: int, codes: np.ndarray, each: np.ndarray | None = None) -> pa.RecordBatch:
        distinct, places = np.unique(codes, return_inverse=True)
        n = len(distinct)
        sums = np.zeros((len(COUNTS), n), np.int64)
        for k, column in enumerate(each.T if each is not None else [None]):
            sums[k] = np.bincount(places, column, n)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, level, np.int32)), pa.array(distinct.view(np.int64)), *map(pa.array, sums)], names=["level", "code", *COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            counts = np.stack([c.to_numpy() for c in batch.columns[1:]], axis=1)
            for low, high in chunks(offsets, CHUNK_BYTES // 4):
                spelled = Spelled(data, offsets[low:high], offsets[low + 1 : high + 1])
                inner = spelled.place > 0
                place, owner = spelled.place[inner], low + spelled.word[inner]
                full = np.zeros(len(place), np.uint64)
                for k in range(1, ORDER + 1):
                    codes = spelled.codes(k)[inner]
                    if k > 1:
                        yield rows(k - 1, codes[place + 1 >= k])
                    if k < ORDER:
                        # What begins a word has nothing to its left: there the words that it begins are counted.
                        yield rows(-k, codes[place + 1 == k])
                    at = np.minimum(place + 1, ORDER) == k
                    full[at] = codes[at]
                yield rows(0, full, counts[owner])

    return vocabulary.select("word", *COUNTS).mapInArrow(lean(run), fields).groupBy("level", "code").agg(*[F.sum(c).alias(c) for c in COUNTS])


def _numbers(table: pa.Table, names: list[str]) -> np.ndarray:
    return np.stack([table[c].to_numpy() for c in names], axis=1)


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def _shared_levels(grams: pa.Table) -> list[Level]:
    """Backoff counts: by how many different symbols a run is preceded, in distinct words of both classes."""
    level, code, counts = grams["level"].to_numpy(), _codes(grams["code"]), _numbers(grams, COUNTS)
    out = []
    for k in range(1, ORDER):
        wider = code[level == k]
        # Runs that begin a word, and so have no symbol before them, come with the words that they begin.
        lefts = wider[(wider >> np.uint64(SYMBOL_BITS * k)) > 0] & np.uint64((1 << SYMBOL_BITS * k) - 1)
        distinct, places = np.unique(np.concatenate([lefts, code[level == -k]]), return_inverse=True)
        n = np.bincount(places, np.concatenate([np.ones(len(lefts)), counts[level == -k, 0]]), len(distinct))
        out.append(Level.of(distinct, n[:, None]))
    return out


def models_of(vocabulary: DataFrame) -> list[Model]:
    """A model of all counts, then one without each fold's. The driver gets sums that the sample bounds, and no text."""
    grams = _grams(vocabulary).toArrow()
    shared = _shared_levels(grams)
    top = grams.filter(pc.equal(grams["level"], 0))
    codes, counts = _codes(top["code"]), _numbers(top, COUNTS).reshape(top.num_rows, FOLDS, 2)
    every = counts.sum(axis=1)
    out = []
    for left in (every, *(every - counts[:, fold] for fold in range(FOLDS))):
        some = left.any(axis=1)
        out.append(Model(shared, Level.of(codes[some], left[some]), np.zeros(len(BEYOND)), np.zeros(1), np.zeros(1)))
    return out


def _compared(ordinary: np.ndarray, toxic: np.ndarray, size: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of each text, by its length: what the toxic log-likelihoods of its words exceed the ordinary ones by beyond each of BEYOND, as a root, as a few strong words say hardly less than many."""
    out = np.zeros((len(counts), len(BEYOND)))
    some = counts > 0
    if some.any():
        where = (np.cumsum(counts) - counts)[some]
        length = np.maximum(np.add.reduceat(size, where), LEAST_LENGTH)
        for k, least in enumerate(BEYOND):
            out[some, k] = np.sqrt(np.add.reduceat(np.maximum(toxic - ordinary - least, 0), where) / length)
    return out


def comparisons(model: Model, texts: pa.Array, memory: Remembered) -> np.ndarray:
    data, offsets = buffers(texts)
    out = []
    for low, high in chunks(offsets, 2 * CHUNK_BYTES):
        part = offsets[low : high + 1]
        piece = data[part[0] : part[-1]]
        hashes, counts, starts, ends = words(piece, part - part[0], APART)
        each = memory(hashes, starts, ends, piece, model.spelling) if len(hashes) else np.zeros((0, 3))
        out.append(_compared(*each.T, counts))
    return np.concatenate(out) if out else np.zeros((0, len(BEYOND)))


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the comparisons, without a constant, by Newton's method with a small ridge."""
    scale = x.std(axis=0) + 1e-6
    a = np.column_stack([np.ones(len(x)), x / scale])
    w, ridge = np.zeros(a.shape[1]), np.diag([1e-6, *[1.0] * x.shape[1]])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[1:] / scale


def calibrated(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Comparisons and the chance of a toxic text at each, which never falls: shares in runs of equal size, pooled where one has less than the run before it."""
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    each = max(2, int(len(x) ** 0.5))
    runs: list[list[float]] = []
    for low in range(0, len(x), each):
        own = slice(low, low + each)
        runs.append([x[own].sum(), y[own].sum(), len(x[own])])
    pooled: list[list[list[float]]] = []
    share = lambda block: sum(r[1] for r in block) / sum(r[2] for r in block)
    for r in runs:
        pooled.append([r])
        while len(pooled) > 1 and share(pooled[-2]) >= share(pooled[-1]):
            last = pooled.pop()
            pooled[-1] += last
    places = [r[0] / r[2] for block in pooled for r in block]
    # One text of either class is added to each block, so that no chance is 0 or 1.
    chances = [(sum(r[1] for r in block) + 0.5) / (sum(r[2] for r in block) + 1) for block in pooled for _ in block]
    return np.array(places), np.maximum.accumulate(np.array(chances))


def probabilities(model: Model, x: np.ndarray) -> np.ndarray:
    return np.interp(x @ model.weights, model.places, model.chances)


def train_model(sample: DataFrame) -> Model | None:
    """Fit on a sample (text, toxic, fold); None unless both classes occur. Scores are calibrated on texts that their models haven't seen, fold by fold."""
    if sample.select("toxic").distinct().count() < 2:
        return None
    model, *without = models_of(settle(_counted(sample), "words"))
    shared = sample.sparkSession.sparkContext.broadcast(without)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(m, Remembered(3, 200_000)) for m in shared.value]
        for batch in batches:
            fold = np.array(batch.column(2).to_pylist(), np.int64)
            x = np.zeros((batch.num_rows, len(BEYOND)))
            for k in np.unique(fold).tolist():
                x[fold == k] = comparisons(held[k][0], batch.column(0).filter(pa.array(fold == k)), held[k][1])
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    with small_batches(sample.sparkSession):
        rows = sample.select("text", "toxic", "fold").mapInArrow(lean(run), "x array<double>, toxic int").toArrow()
    shared.unpersist()
    # Summed in one order, so that the weights don't depend on how the rows were dealt.
    x, y = np.array(rows["x"].to_pylist()), rows["toxic"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y))
    model.weights = logistic(x[order], y[order])
    model.places, model.chances = calibrated(x[order] @ model.weights, y[order])
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, train: Column, max_toxic: int = 2_000, max_plain: int = 3_000) -> DataFrame:
    """Add a score from 0 to 1 and predicted (1 where it is at least 0.3) to every row of docs, from its whole text.

    labels: doc_id, toxic; null labels are ignored, and of several for one document the highest counts.
    Labels of rows where `train` doesn't hold are never read. The models and the scale of
    their comparison are fitted on at most `max_toxic` and `max_plain` labelled documents, those first by a
    hash of doc_id, and one row of each where ids repeat; nothing else is bounded. Counts are summed
    over the cluster, and the driver gets those of runs of four symbols. Words are runs of letters and
    digits, A-Z lower-cased. Each class has a Kneser-Ney model of how words are spelled: a run of four
    symbols that is rare or unknown in the class falls back to shorter ones, by counts that both
    classes share. The toxic and the ordinary log-likelihood of a text are compared word by
    word and normalised by its length; the score is the share of toxic texts among held-out ones with
    such a comparison. A null or empty text has no words and scores as one without
    evidence; equal texts, also repeated rows, score the same. Without labels of both classes every
    score is 0. An empty table has no rows. Existing columns named score or predicted are replaced.
    """
    marked = labels.where("toxic is not null and doc_id is not null").where(train).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = marked.where("toxic = 1").orderBy(*order).limit(max_toxic).union(marked.where("toxic = 0").orderBy(*order).limit(max_plain))
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    sample = settle(one_row_each(docs.select("doc_id", F.col("text").cast("string").alias("text")), ids).withColumn("fold", fold), "sample")
    model = train_model(sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    fields = docs.select(kept).schema.add("score", "double", False).add("predicted", "integer", False)
    at = kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, memory = shared.value, Remembered(3, 500_000)
        for batch in batches:
            p = probabilities(held, comparisons(held, batch.column(at), memory)) if held is not None else np.zeros(batch.num_rows)
            columns = [*batch.columns, pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "score", "predicted"])

    return docs.select(kept).mapInArrow(lean(run), fields)
