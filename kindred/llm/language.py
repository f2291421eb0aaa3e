"""The language of a text: known words by their frequency in each language, unseen ones by ever shorter character n-grams."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.fitting import fit_in_task, one_row_each
from kindred.llm.text import CHUNK_BYTES, NO_LETTER, Counter64, Remembered, Spelled, buffers, chunks, words
from kindred.session import settle

LONGEST = 5
SMOOTH = 0.5
UNKNOWN = "und"


@dataclass
class Model:
    """Natural log frequencies by language, as columns in the order of `names`: of words, and of n-grams of each length."""

    names: list[str]
    prior: np.ndarray
    words: Counter64
    grams: list[Counter64]

    def word_scores(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray | None = None) -> np.ndarray:
        """Of each word: its log frequencies if it is known, else the mean over those of its longest n-grams of which any is known; 0 if none is."""
        if hashes is None:
            span = np.stack([starts, ends], axis=1).ravel()
            hashes = _hash_spans(data, span)
        out = self.words(hashes)
        open_ = ~self.words.known(hashes)
        if open_.any():
            out[open_] = self._backoff(data, starts[open_], ends[open_])
        return out

    def _backoff(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.zeros((len(starts), len(self.names)))
        left = np.arange(len(starts))
        for width in range(LONGEST, 0, -1):
            if not len(left):
                break
            table = self.grams[width - 1]
            spelled = Spelled(data, starts[left], ends[left])
            codes = spelled.codes(width)
            usable = (spelled.place + 1 >= width) & (spelled.place > 0)
            usable[usable] = table.known(codes[usable])
            owner, found = spelled.word[usable], table(codes[usable])
            n = np.bincount(owner, minlength=len(left))
            hit = n > 0
            for k in range(len(self.names)):
                out[left[hit], k] = (np.bincount(owner, found[:, k], len(left))[hit]) / n[hit]
            left = left[~hit]
        return out


def _hash_spans(data: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Hashes of given words, as words() has them."""
    starts, ends = span[::2], span[1::2]
    sizes = ends - starts
    joined = np.concatenate([data[a:b] for a, b in zip(starts, ends, strict=True)] or [data[:0]])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return words(joined, offsets, NO_LETTER)[0]


def _log(counts: Counter64) -> Counter64:
    totals = counts.values.sum(axis=0) + SMOOTH * len(counts.keys) + 1
    return Counter64(counts.keys, np.log((counts.values + SMOOTH) / totals))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> Counter64:
    """Sum rows of equal keys."""
    keys, values = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    distinct, places = np.unique(keys, return_inverse=True)
    return Counter64(distinct, np.stack([np.bincount(places, values[:, k], len(distinct)) for k in range(values.shape[1])], axis=1))


def learn(texts: pa.Array, names: list[str], labels: np.ndarray, n_rows: np.ndarray) -> Model:
    """A model from lower-cased texts with the place of each one's language in `names`; n_rows: of each language, in all."""
    data, offsets = buffers(texts)
    found: list[list] = [[] for _ in range(LONGEST + 1)]

    def counted(keys, owners, weights=None):
        distinct, first = np.unique(keys, return_inverse=True)
        flat = np.bincount(first * len(names) + owners, weights, len(distinct) * len(names))
        return distinct, flat.reshape(-1, len(names))

    for low, high in chunks(offsets, 4 * CHUNK_BYTES):
        part = offsets[low : high + 1]
        own = data[part[0] : part[-1]]
        hashes, counts, starts, ends = words(own, part - part[0], NO_LETTER)
        if not len(hashes):
            continue
        # A word counts once in a document, so that one that repeats a word endlessly doesn't speak for its language.
        rows = np.repeat(np.arange(high - low), counts)
        order = np.lexsort((hashes, rows))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (np.diff(hashes[order]) != 0) | (np.diff(rows[order]) != 0)
        once = np.sort(order[fresh])
        hashes, starts, ends, owners = hashes[once], starts[once], ends[once], labels[low:high][rows[once]]
        found[0].append(counted(hashes, owners))
        kinds, first, places = np.unique(hashes, return_index=True, return_inverse=True)
        weights = np.bincount(places * len(names) + owners, minlength=len(kinds) * len(names)).reshape(-1, len(names))
        spelled = Spelled(own, starts[first], ends[first])
        for width in range(1, LONGEST + 1):
            codes = spelled.codes(width)
            usable = (spelled.place + 1 >= width) & (spelled.place > 0)
            mine = weights[spelled.word[usable]]
            distinct, where = np.unique(codes[usable], return_inverse=True)
            found[width].append((distinct, np.stack([np.bincount(where, mine[:, k], len(distinct)) for k in range(len(names))], axis=1)))
    none = [(np.zeros(0, np.uint64), np.zeros((0, len(names))))]
    tables = [_log(_merged(f or none)) for f in found]
    share = n_rows + 1.0
    return Model(names, np.log(share / share.sum()), tables[0], tables[1:])


def _quotas(counts: dict[str, int], most: int) -> dict[str, int]:
    """How many of each language to take, `most` in all: all of small ones, equal numbers of the others."""
    out, left = {}, most
    for k, lang in enumerate(sorted(counts, key=lambda x: (counts[x], x))):
        out[lang] = min(counts[lang], left // (len(counts) - k))
        left -= out[lang]
    return out


def sample_by_language(usable: DataFrame, most: int) -> tuple[DataFrame, dict[str, int]]:
    """At most `most` ids, of every language those first by a hash of doc_id; and how many rows each language has.

    Only ids whose hash is below a bound that leaves a few more than are wanted are put in order.
    """
    pairs = settle(usable.where("doc_id is not null").groupBy("lang", "doc_id").agg(F.count("*").alias("n")), "pairs")
    found = pairs.groupBy("lang").agg(F.count("*").alias("n_ids"), F.sum("n").alias("n_rows")).collect()
    counts = {r.lang: r.n_ids for r in found}
    wanted = [(lang, n, (n + 8 * n**0.5 + 50) / counts[lang]) for lang, n in _quotas(counts, most).items()]
    place = F.xxhash64("doc_id")
    near = pairs.join(F.broadcast(usable.sparkSession.createDataFrame(wanted, "lang string, quota long, bound double")), "lang").where(place / 2.0**64 + 0.5 <= F.col("bound"))
    first = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(place, "doc_id")))
    return first.where("rank <= quota").select("doc_id").distinct(), {r.lang: r.n_rows for r in found}


def predict_language(docs: DataFrame, train: Column, max_train_rows: int = 12_000) -> DataFrame:
    """Predict the language of every whole text, learning from `lang` of the rows where `train` holds.

    docs: doc_id, text, lang and any others, which are ignored. Returns doc_id, lang_pred and score, a
    row for each row of the input; equal texts, also in repeated rows, are predicted alike, and an empty
    table has no rows. The classifier is fitted on at most `max_train_rows` rows that have a lang and a
    text: one of each id, all ids of small languages and equally many of the others, those first by a
    hash of doc_id. Of languages that score the same, the first by name is predicted. How frequent the languages are is counted over all rows. Nothing else is
    bounded: all words and n-grams of the sample are kept. A word is a run of letters (and of all that isn't ASCII), lower-cased. Each word's log frequencies (in how many
    documents it occurs) are added up for each language; score is the share of the best one after dividing by the root of the number of
    words, so that long texts don't all score 1. A text that is null or has no letter is und with a
    score of 0; so is every text where nothing can be learned from.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has"), "lang", train.alias("train"))
    usable = own.where("train and lang is not null and has")
    ids, n_rows = sample_by_language(usable, max_train_rows)

    def fit(rows: pa.Table) -> Model:
        names = sorted(set(rows["lang"].to_pylist()))
        return learn(rows["text"].combine_chunks(), names, np.array([names.index(x) for x in rows["lang"].to_pylist()], np.int64), np.array([n_rows[x] for x in names]))

    shared = docs.sparkSession.sparkContext.broadcast(fit_in_task(one_row_each(usable.select("doc_id", "text", "lang"), ids).select("text", "lang"), fit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pickle.loads(shared.value) if shared.value else None
        memory = Remembered(len(held.names)) if held else None
        for batch in batches:
            n = batch.num_rows
            pick, score = np.full(n, -1), np.zeros(n)
            data, offsets = buffers(batch.column(1))
            for low, high in chunks(offsets, 4 * CHUNK_BYTES) if held else ():
                part = offsets[low : high + 1]
                piece = data[part[0] : part[-1]]
                hashes, counts, starts, ends = words(piece, part - part[0], NO_LETTER)
                total = np.tile(held.prior, (high - low, 1))
                if len(hashes):
                    each = memory(hashes, starts, ends, piece, held.word_scores)
                    owner = np.repeat(np.arange(high - low), counts)
                    for k in range(len(held.names)):
                        total[:, k] += np.bincount(owner, each[:, k], high - low)
                total -= total.max(axis=1, keepdims=True)
                odds = np.exp(total / np.sqrt(np.maximum(counts, 1))[:, None])
                pick[low:high] = total.argmax(axis=1)
                score[low:high] = 1 / odds.sum(axis=1)
            has = np.array(batch.column(2).to_pylist(), bool) if held else np.zeros(n, bool)
            said = [held.names[k] if x else UNKNOWN for k, x in zip(pick.tolist(), has.tolist(), strict=True)] if held else [UNKNOWN] * n
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string()), pa.array(np.where(has, score, 0.0))], names=["doc_id", "lang_pred", "score"])

    return own.select("doc_id", "text", "has").mapInArrow(run, "doc_id long, lang_pred string, score double")
