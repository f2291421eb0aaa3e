"""Media columns: byte payloads kept as lossless WebP files, and the files read back as pixels with features."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.webp import MAX_SIDE, Tools, encode_image, file_of, images_of, predictions, uncrossed

SIDE = 16
ROW = 4 * SIDE
#: Predictors that the encoder tries in each block: left, above, above left, and the mean of the last two.
TRIED = (1, 2, 4, 8)
BLOCK_BITS = 4
#: A channel that goes less with green than this isn't freed of it.
MIN_CORRELATION = 0.05


def _bits(samples: np.ndarray) -> float:
    """What prefix codes of all samples take at least."""
    counts = np.bincount(samples.ravel(), minlength=256)
    counts = counts[counts > 0]
    return samples.size * np.log2(samples.size) - float((counts * np.log2(counts)).sum())


def chosen_tools(pixels: np.ndarray) -> Tools:
    """What makes an image small, from its pixels alone.

    Few colours make a palette, and colours that mostly repeat make copies and a colour cache worth
    their time. Else a predictor is picked for each block, green taken from red and blue, and red and
    blue by a share of green, each kept only if the samples then take fewer bits.
    """
    colours = len(set(np.ascontiguousarray(pixels).view(np.uint32).ravel().tolist()))
    if pixels.shape[0] * SIDE >= 8 * colours:
        return Tools(palette=colours <= 256, copies=True, cache_bits=6 if colours > 256 else 0)
    least, tools = _bits(pixels), Tools(block_bits=BLOCK_BITS)
    own = pixels
    if _smooth(pixels, least):
        residue, modes = _predicted_by_block(pixels)
        if (bits := _bits(residue) + 64 + 2 * len(modes)) < least:
            least, own, tools.modes = bits, residue, modes
    if tools.modes is None:
        green = pixels[..., 1:2] * np.array([1, 0, 1, 0], np.uint8)
        if (bits := _bits(pixels - green) + 3) < least:
            least, own, tools.subtract_green = bits, pixels - green, True
    factors = _shares_of_green(own)
    if any(factors) and _bits(uncrossed(own.astype(np.int64), factors, BLOCK_BITS)) + 64 < least:
        tools.factors = factors
    return tools


def _smooth(pixels: np.ndarray, least: float) -> bool:
    """Whether plain differences to the left or above take fewer bits than the samples, so that it's worth trying predictors."""
    gaps = [g for g in (pixels[1:] - pixels[:-1], pixels[:, 1:] - pixels[:, :-1]) if g.size]
    return any(_bits(g) * pixels.size < least * g.size for g in gaps)


def _predicted_by_block(pixels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the predictor with the smallest residue in each block leaves, and these predictors."""
    own, each = pixels.astype(np.int64), 1 << BLOCK_BITS
    blocks = -(-len(own) // each)
    left = [(own - predictions(own, np.full((blocks, 1), mode), BLOCK_BITS)) & 255 for mode in TRIED]
    gaps = [np.add.reduceat(np.minimum(x, 256 - x).sum(axis=(1, 2)), np.arange(0, len(own), each)) for x in left]
    best = np.argmin(gaps, axis=0)
    residue = np.choose(np.repeat(best, each)[: len(own), None, None], left)
    return residue.astype(np.uint8), np.array(TRIED)[best][:, None]


def _shares_of_green(samples: np.ndarray) -> tuple[int, int, int]:
    """Factors of the cross-colour transform (red to blue, green to blue, green to red), by least squares; 0 where green tells little."""
    red, green, blue = (np.ascontiguousarray(samples[..., k]).view(np.int8).ravel().astype(np.float32) for k in range(3))
    square = float(green @ green)
    share = lambda c: float(green @ c) / square if square and float(green @ c) ** 2 > MIN_CORRELATION * square * float(c @ c) else 0.0
    if abs(float(green.mean())) > float(green.std()):
        return 0, 0, 0
    return 0, *(int(np.clip(round(32 * share(c)), -128, 127)) for c in (blue, red))


def to_media(payload: bytes) -> bytes:
    """A payload, filled with 0 to a positive multiple of 64 bytes, as WebP files of 16 pixels a row, one after the other.

    A file has at most 16384 rows, a MiB. The bytes are red, green, blue and alpha in turn. What the
    encoder uses follows from the pixels alone.
    """
    size = max(ROW, -(-len(payload) // ROW) * ROW)
    pixels = np.frombuffer(payload.ljust(size, b"\0"), np.uint8).reshape(-1, SIDE, 4)
    parts = (pixels[low : low + MAX_SIDE] for low in range(0, len(pixels), MAX_SIDE))
    return b"".join(file_of(encode_image(part, chosen_tools(part))) for part in parts)


def feature_of(images: list[np.ndarray]) -> str:
    """Rows, mean of each channel, number of values, their entropy in bits, and where a column is brighter than the one before."""
    pixels = np.concatenate(images) if len(images) > 1 else images[0]
    counts = np.bincount(pixels.ravel(), minlength=256)
    p = counts[counts > 0] / pixels.size
    columns = pixels.sum(axis=0, dtype=np.int64)
    light = columns.sum(axis=1)
    bits = "".join("1" if a > b else "0" for a, b in zip(light[1:].tolist(), light[:-1].tolist(), strict=True))
    means = ",".join(f"{m / (len(pixels) * SIDE):.3f}" for m in columns.sum(axis=0).tolist())
    return f"{len(pixels)}x{SIDE};mean={means};values={len(p)};entropy={-float((p * np.log2(p)).sum()):.4f};rising={bits}"


def store_as_webp(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media: the UTF-8 bytes of every whole text as WebP files. A null text is an empty one. Other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, files = [], []
            for text in batch.column(1):
                payload = (text.as_py() or "").encode()
                sizes.append(len(payload))
                files.append(to_media(payload))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(files, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def read_webp(media: DataFrame, keep_pixels: bool = False) -> DataFrame:
    """Read every media column back, adding payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature and, if wanted, pixels.

    media: a column media of WebP files, and others that are kept (but not those named like the added
    ones). Everything is worked out from the decoded pixels and the stored bytes. A null media gives
    nulls; bytes that are no lossless WebP raise WebpError.
    """
    added = {"payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string"}
    if keep_pixels:
        added["pixels"] = "binary"
    kept = [c for c in media.columns if c not in added and c != "media"]
    fields = media.select(kept).schema
    for name, kind in added.items():
        fields = fields.add(name, kind)
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(batch.num_columns - 1):
                data = value.as_py()
                if data is None:
                    rows.append((None,) * len(added))
                    continue
                images = list(images_of(data))
                payload = b"".join(i.tobytes() for i in images)
                row = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-ROW:]), len(data), hashlib.sha256(data).hexdigest(), feature_of(images))
                rows.append((*row, payload) if keep_pixels else row)
            columns = zip(*rows, strict=True) if rows else [[]] * len(added)
            made = [pa.array(list(c), kinds[k]) for c, k in zip(columns, added.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*kept, *added])

    return media.select(*kept, "media").mapInArrow(run, fields)
