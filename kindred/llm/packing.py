"""Best-fit packing of token pieces into sequences under several capacities at once."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.ranks import gapless
from kindred.session import lean, settle

END_ID = 1
CACHED = 200_000
SPECIAL = "<|"
SIMPLE = re.compile(r"[!-&(-~ß-öø-ÿ]+")
PARTS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
UNUSUAL_SPACE = re.compile("[\x1c-\x1f]")
MAX_PLAN_ROWS = 400_000


@dataclass(frozen=True)
class Capacities:
    """What a sequence holds at most; the weight of each kind where bins are compared.

    Attention cost of a piece: the square of its tokens. Without limits of their own, as many documents
    as tokens and all attention within them are allowed; what is left of them still counts where bins
    are compared.
    """

    tokens: int = 4096
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.25, 0.25)
    rule: str = "norm"

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], dtype=np.float64)


class _Parts(dict):
    """Ids of a run of letters, a digit or a run of marks, by the model alone."""

    def __init__(self, tokenizer):
        super().__init__()
        self.model = tokenizer.model
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in kept]
        self.letters = {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(rest)}

    def __missing__(self, part: str) -> bytes:
        if len(self) >= CACHED:
            self.clear()
        mapped = part if part.isascii() else "".join(self.letters[b] for b in part.encode())
        ids = b"".join(t.id.to_bytes(4, "little") for t in self.model.tokenize(mapped))
        self[part] = ids
        return ids


class _Chunks(dict):
    """Ids of what stands between white space: the vocabulary's splitter never joins across it."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.parts = tokenizer, _Parts(tokenizer)

    def __missing__(self, chunk: str) -> bytes:
        lowered = chunk.lower()
        if SIMPLE.fullmatch(lowered) and SPECIAL not in chunk:
            ids = b"".join([self.parts[p] for p in PARTS.findall(lowered)])
        else:
            ids = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(chunk) <= 40:
            if len(self) >= CACHED:
                self.clear()
            self[chunk] = ids
        return ids


def encoder(path: str | None):
    """A function from a text to its ids as little-endian 32-bit bytes. Its tables, of bounded size, end with it."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    chunks = _Chunks(Tokenizer.from_file(path))

    def encode(text: str) -> bytes:
        if UNUSUAL_SPACE.search(text):
            return np.array(chunks.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join(map(chunks.__getitem__, text.split()))

    return encode


def token_pieces(docs: DataFrame, capacity: int = 4096, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Cut each document's ids into pieces of at most `capacity`: doc_id, piece, start, length, ids_crc32, and ids if wanted.

    A document is the ids of its text, then one end id, so a null or empty text is a piece of one id.
    Only documents longer than a piece are cut. The whole text is encoded, chunk by chunk between
    white space, which gives the same ids as the vocabulary's own encoder on the whole, also of texts
    that spell the vocabulary's special tokens. Nothing bounds a text's length; its ids are held at once.
    """
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        end, width = END_ID.to_bytes(4, "little"), 4 * capacity
        for batch in batches:
            rows = [[] for _ in range(6)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    for column, value in zip(rows, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part), strict=True):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            n = 5 + keep_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows[:n], types[:n], strict=True)], names=names[:n])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lean(run), fields)


def best_fit_plan(counts: dict[int, int], caps: Capacities) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Where the pieces of each length go: (length, first rank, how many, first bin, offset) rows, and the number of bins.

    Best fit, the longest first. Bins in the same state are one entry with a range of bin numbers,
    and pieces of a length are alike, so a step puts one piece each into as many bins of the best
    state as there are pieces. "norm" takes the state whose weighted remainder after the piece is
    shortest, "dot" the one with the smallest weighted product of remainder and piece; both count
    each kind as a share of its capacity, and a bin must hold the piece in every kind. Where no state
    does, as many bins are opened as the rest needs.
    """
    full = caps.vector()
    weights = np.array(caps.weights)
    room, held = np.zeros((1024, 3)), np.zeros((1024, 2), dtype=np.int64)
    used, bins, rows = 0, 0, []

    def add(state, first, n):
        nonlocal room, held, used
        if used == len(room):
            alive = held[:used, 1] > 0
            keep = int(alive.sum())
            size = max(1024, 2 * keep)
            fresh, own = np.zeros((size, 3)), np.zeros((size, 2), dtype=np.int64)
            fresh[:keep], own[:keep] = room[:used][alive], held[:used][alive]
            room, held, used = fresh, own, keep
        room[used], held[used] = state, (first, n)
        used += 1

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        item = np.array([length, 1, length * length], dtype=np.float64)
        if (item > full).any():
            raise ValueError(f"a piece of {length} tokens is larger than a sequence")
        each = int((full // item).min())
        while left:
            fits = (room[:used] >= item).all(axis=1) & (held[:used, 1] > 0)
            if fits.any():
                where = np.flatnonzero(fits)
                after = room[where] / full
                score = (weights * after * (item / full)).sum(axis=1) if caps.rule == "dot" else (weights * (after - item / full) ** 2).sum(axis=1)
                best = int(where[np.argmin(score)])
                n = min(left, int(held[best, 1]))
                first, state = int(held[best, 0]), room[best] - item
                offset = int(full[0] - room[best, 0])
                if n == held[best, 1]:
                    held[best, 1] = 0
                else:
                    held[best] += (n, -n)
            else:
                n = -(-left // each)
                first, state, offset = bins, full - item, 0
                bins += n
            rows.append((length, rank, n, first, offset))
            left, rank = left - n, rank + n
            if state.min() >= 1:
                add(state, first, n)
    return rows, bins


def pack(pieces: DataFrame, caps: Capacities, order: list[str], salts: int = 64) -> DataFrame:
    """Add sequence_id and offset to pieces with a `length` from 1 to the token capacity.

    The driver gets the number of pieces of each length, at most as many rows as a sequence has
    tokens, and plans whole bins from it. The pieces themselves are numbered within their length, in
    `order`, and find their bin by that number. `pieces` must give the same rows each time. Columns of
    the input with the names of added or inner ones (sequence_id, offset, _at_*, _rank, _part) are replaced.
    """
    inner = ("sequence_id", "offset", "_at_length", "_at_rank", "_at_count", "_at_bin", "_at_offset", "_rank", "_part")
    pieces = pieces.select([c for c in pieces.columns if c not in inner])
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows, _ = best_fit_plan(counts, caps)
    plan = pieces.sparkSession.createDataFrame(rows, "_at_length long, _at_rank long, _at_count long, _at_bin long, _at_offset long")
    ranked = gapless(pieces, ["length"], order, "_rank", salts)
    within = (F.col("length") == F.col("_at_length")) & F.col("_rank").between(F.col("_at_rank"), F.col("_at_rank") + F.col("_at_count") - 1)
    if len(rows) <= MAX_PLAN_ROWS:
        joined = ranked.join(F.broadcast(plan), within)
    else:
        spread = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_part")
        joined = ranked.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int")).join(plan.select("*", spread), ["_part"]).where(within)
    return joined.select(*pieces.columns, (F.col("_at_bin") + F.col("_rank") - F.col("_at_rank")).alias("sequence_id"), F.col("_at_offset").alias("offset"))


def pack_documents(docs: DataFrame, caps: Capacities = Capacities(), vocabulary: str | None = None, keep_ids: bool = False, salts: int = 64) -> DataFrame:
    """Pieces of all documents with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Rows that repeat are packed each. Pieces of one length are interchangeable and are dealt by doc_id,
    piece and ids_crc32; null ids are packed as well. Other columns are ignored. An empty table has no
    rows. A piece that no sequence can hold under `caps` raises ValueError.
    """
    pieces = settle(token_pieces(docs, caps.tokens, vocabulary, keep_ids), "pieces")
    return pack(pieces, caps, ["doc_id", "piece", "ids_crc32"], salts)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces with ids: sequence_id, n_documents, ids (little-endian 32-bit)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.size("p").alias("n_documents"), F.concat(F.lit(b""), F.aggregate(F.transform("p", lambda x: x["ids"]), F.lit(b""), lambda a, b: F.concat(a, b))).alias("ids")
    )
