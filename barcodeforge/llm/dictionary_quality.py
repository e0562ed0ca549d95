"""Quality classifier by compression: zstandard dictionaries of good and bad labelled text, and
the normalised difference of the two compressed sizes as a calibrated score."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barcodeforge.llm import common as C

THRESHOLD = 0.3
#: bytes compressed at a time: short enough that a text does not become its own dictionary
BLOCK = 512
DICTIONARY_BYTES = 256 << 10
LEVEL = 3
#: bounds of the labelled sample: documents of a class, and code points of one of them
SAMPLE_PER_CLASS = 3000
SAMPLE_CHARS = 20_000


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries, the logistic calibration ``sigmoid(slope * difference + offset)``, and
    the share of good documents, which is the score of a text without bytes."""

    good: bytes
    bad: bytes
    slope: float
    offset: float
    prior: float

    def scorer(self):
        good, bad = _compressor(self.good), _compressor(self.bad)

        def score(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            diff = np.array([_difference(t, good, bad) for t in texts], dtype=float)
            value = 1 / (1 + np.exp(-np.clip(self.slope * diff + self.offset, -50, 50)))
            return diff, np.where([not t for t in texts], self.prior, value)

        return score


def _blocks(text: bytes) -> list[bytes]:
    return [text[i:i + BLOCK] for i in range(0, len(text), BLOCK)]


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; of too little text to train on, the text itself."""
    raw = b"".join(samples)
    size = min(DICTIONARY_BYTES, max(1024, len(raw) // 4))
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return raw[:DICTIONARY_BYTES]


def _compressor(dictionary: bytes):
    data = zstandard.ZstdCompressionDict(dictionary)
    if len(dictionary) >= 8:
        data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=False, write_content_size=False,
                                    write_dict_id=False) if dictionary else zstandard.ZstdCompressor(level=LEVEL)


def _difference(text: bytes, good, bad) -> float:
    """(size under the bad dictionary - size under the good one) / bytes, over all blocks."""
    total = 0
    for block in _blocks(text):
        total += len(bad.compress(block)) - len(good.compress(block))
    return total / max(1, len(text))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Weighted logistic regression of one standardised variable by Newton's method."""
    centre, scale = float(x.mean()), float(x.std()) or 1.0
    a = np.stack([(x - centre) / scale, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    weight = weight * len(x) / weight.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        gradient = a.T @ (weight * (y - p)) - ridge * beta
        hessian = (a * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1] - beta[0] * centre / scale)


def train_quality_model(docs: DataFrame, labels: DataFrame, sample_per_class: int = SAMPLE_PER_CLASS,
                        sample_chars: int = SAMPLE_CHARS) -> QualityModel:
    """Fit on labelled documents whose fold is not 0.

    A sample of at most ``sample_per_class`` documents of each class (in hash order of the id,
    none above ``sample_chars``) comes to the driver: half of it makes the dictionaries, the
    other half the calibration, each class weighted by its count among all training labels.
    A null label counts as none; of several labels of an id the smallest holds. Without both
    classes every score is the share of the class there is (0.5 without labels).
    """
    known = (labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
             .where(C.fold("doc_id") != 0))
    counts = {int(r[0]): int(r[1]) for r in known.groupBy("quality").count().collect()}
    prior = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    order = F.xxhash64("doc_id")
    chosen = [known.where(F.col("quality") == q).where(C.sampled(order, sample_per_class, counts.get(q, 0)))
              .orderBy(F.pmod(order, F.lit(1 << 30)), "doc_id").limit(sample_per_class) for q in (0, 1)]
    sample = F.broadcast(chosen[0].union(chosen[1]))
    rows = (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .where(F.col("text").isNotNull() & (F.length("text") <= sample_chars)).join(sample, "doc_id")
            .select(F.xxhash64("doc_id", F.lit("half")).alias("h"), "quality", "text").collect())
    rows = sorted((r["h"], int(r["quality"]), r["text"].encode()) for r in rows if r["text"])
    half: dict[int, list[list[bytes]]] = {0: [[], []], 1: [[], []]}
    for k, (_, quality, text) in enumerate(rows):
        half[quality][k % 2].append(text)
    if not all(half[q][k] for q in (0, 1) for k in (0, 1)):
        return QualityModel(b"", b"", 0.0, float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))), prior)
    good, bad = (_dictionary([b for t in half[q][0] for b in _blocks(t)]) for q in (1, 0))
    a, b = _compressor(good), _compressor(bad)
    x = np.array([_difference(t, a, b) for q in (0, 1) for t in half[q][1]])
    y = np.repeat([0.0, 1.0], [len(half[0][1]), len(half[1][1])])
    weight = np.where(y == 1, counts[1] / len(half[1][1]), counts[0] / len(half[0][1]))
    slope, offset = _logistic(x, y, weight)
    return QualityModel(good, bad, slope, offset, prior)


def _bytes(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
            .to_pylist()]


def quality_scores(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size_difference, score`` of every whole text (null as empty: the class share).
    Repeated rows keep their own row, ids may be null, other columns are ignored."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        score = model.scorer()
        for part in C.passes(batches, "text"):
            diff, value = score(_bytes(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(diff), pa.array(value)],
                                             ["doc_id", "size_difference", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, size_difference double, score double")


def keep_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text scores ``threshold`` or more."""
    def run(batches):
        score = model.scorer()
        for part in C.passes(batches, text_col):
            _, value = score(_bytes(part.column(text_col)))
            yield part.filter(pa.array(value >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op1(spark, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    model = train_quality_model(docs, C.table(spark, sf_dir, "labels"))
    return quality_scores(docs, model).select(
        "doc_id", (C.fold("doc_id") == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "size_difference")
