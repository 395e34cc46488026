"""Quality scores from compression: how much better good text's dictionary packs a document than bad text's.

Two zstandard dictionaries are trained, one on texts labelled good and one on texts labelled bad.
A document is cut into blocks, so that its own history does not drown the dictionaries, and each
block is packed with both. The difference of the packed sizes over their sum is the main feature;
a logistic regression on labelled rows the dictionaries have not seen calibrates it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlab.llm.common import pieces, process_cache, share, small_batches


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    prior: float
    block: int = 512
    level: int = 3


def _packers(model: Model):
    cache = process_cache("quality")
    key = zlib.crc32(model.good), zlib.crc32(model.bad), model.level
    if cache.get("packers", ("",))[0] != key:
        made = []
        for content in (model.good, model.bad):
            data = zstandard.ZstdCompressionDict(content)
            data.precompute_compress(level=model.level)
            made.append(zstandard.ZstdCompressor(level=model.level, dict_data=data, write_content_size=False, write_dict_id=False))
        cache["packers"] = key, made
    return cache["packers"][1]


def features(model: Model, text: bytes) -> list[float]:
    """Constant, normalised size difference, worst block's difference, packed share, and length terms."""
    good, bad = (p.compress for p in _packers(model))
    sizes = [(len(good(b)), len(bad(b))) for b in (text[i : i + model.block] for i in range(0, len(text), model.block))]
    if not sizes:
        return [1.0] + [0.0] * 6
    a, b = map(sum, zip(*sizes))
    whole = (a - b) / (a + b)
    worst = max((x - y) / (x + y) for x, y in sizes)
    share = (a + b) / (2 * len(text) + 40)
    size = np.log(len(text) + 20) - 7
    return [1.0, 10 * whole, 10 * worst, 10 * share, 10 * whole * size, size, 10 * share * size]


def score(model: Model, text: bytes) -> float:
    """Calibrated likelihood of label 1; the prior where there is no text."""
    if not text:
        return model.prior
    z = float(np.dot(model.weights, features(model, text)))
    return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def fit(
    docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "quality",
    per_label: int = 1600, for_dictionary: int = 600, text_bytes: int = 12 << 20, dictionary_bytes: int = 112_640,
) -> Model:
    """Fit on a bounded sample of labelled rows.

    Rows whose ``crc32(id as text) mod 5`` is 0 are held out. Of the others, the ``per_label``
    rows of each label with the smallest hash of their id are read, up to ``text_bytes`` of text a
    label; the first ``for_dictionary`` (at most half) train the dictionary, the rest calibrate.
    With one label missing or no text at all, every score is the share of label 1 (0.5 without labels).
    """
    labelled = (
        labels.where(f"`{label}` in (0, 1) and crc32(cast(`{id}` as string)) % 5 != 0")
        .select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
        .groupBy("id").agg(F.min("label").alias("label"))
    )
    order = [F.xxhash64("id"), "id"]
    picked = labelled.where("label = 1").orderBy(*order).limit(2 * per_label).union(labelled.where("label = 0").orderBy(*order).limit(2 * per_label))
    shares = dict(labelled.groupBy("label").count().collect())
    prior = shares.get(1, 0) / sum(shares.values()) if shares else 0.5
    found = (
        docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text != ''")
        .join(F.broadcast(picked), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
        .orderBy(F.xxhash64("id"), "id")
    )
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    for row in found.toLocalIterator():
        mine = texts[row["label"]]
        if len(mine) < per_label and sum(map(len, mine[-1:])) + len(row["text"]) < text_bytes:
            mine.append(row["text"].encode())
    for mine in texts.values():
        total = np.cumsum([len(t) for t in mine])
        del mine[int(np.searchsorted(total, text_bytes)) :]
    return train(texts[1], texts[0], prior, for_dictionary=for_dictionary, dictionary_bytes=dictionary_bytes)


def train(good: list[bytes], bad: list[bytes], prior: float, *, for_dictionary: int = 600, dictionary_bytes: int = 112_640) -> Model:
    """Dictionaries from the first texts of each label, logistic weights from the rest."""
    flat = Model(b"", b"", (float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))),) + (0.0,) * 6, prior)
    if not good or not bad:
        return flat
    cut_good, cut_bad = (min(for_dictionary, (len(x) + 1) // 2) for x in (good, bad))
    contents = []
    for rows in (good[:cut_good], bad[:cut_bad]):
        samples = [t[i : i + flat.block] for t in rows for i in range(0, len(t), flat.block)]
        try:
            contents.append(zstandard.train_dictionary(dictionary_bytes, samples).as_bytes())
        except zstandard.ZstdError:  # too few samples to train on: their plain text serves
            contents.append(b"".join(samples)[-dictionary_bytes:])
    model = replace(flat, good=contents[0], bad=contents[1])
    rest_good, rest_bad = good[cut_good:] or good, bad[cut_bad:] or bad
    x = np.array([features(model, t) for t in [*rest_good, *rest_bad]])
    y = np.array([1.0] * len(rest_good) + [0.0] * len(rest_bad))
    importance = np.where(y == 1, prior / len(rest_good), (1 - prior) / len(rest_bad)) * len(y)
    w = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps of a ridge-penalised logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (importance * (y - p)) - 0.01 * w
        bend = (x * (importance * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return replace(model, weights=tuple(map(float, w)))


def with_scores(docs: DataFrame, model: Model, text: str = "text", score_column: str = "score") -> DataFrame:
    """``docs`` with the score of the whole text, 0 to 1.

    A NULL or empty text gets the prior. Repeated rows get equal scores; other columns pass
    through unchanged, a column already named like the score is replaced. An empty table stays empty.
    """
    small_batches(docs.sparkSession)
    shared = share(docs.sparkSession, model, "quality")
    kept = [c for c in docs.columns if c != score_column]
    source = docs.select(*(f"`{c}`" for c in kept), F.coalesce(f"`{text}`", F.lit("")).alias("__text"))
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        for batch in pieces(batches, "__text"):
            scores = [score(model, t.encode()) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], [*kept, score_column])

    return source.mapInArrow(run, f"{fields}, `{score_column}` double")
