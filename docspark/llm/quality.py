"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

A text becomes hashed counts of its letter n-grams (``GRAMS`` code points, in lower case, of any script),
counts of the shapes of its character triples (case, digits, marks and breaks), and how often its words
repeat. Rare features weigh more (tf-idf). A truncated SVD of the labelled sample
turns these into latent vectors. The labelled vectors are broadcast (``MAX_LABELLED`` rows of
``LATENT`` numbers at most); every document meets all of them in blocked products of unit vectors,
which are exact cosines, and the ``NEIGHBOURS`` nearest vote with weights that grow with similarity.

The classifier is fitted on a bounded sample: of the labelled rows offered, the ``MAX_LABELLED`` with
the smallest hash of their id (at most as many rows, should ids repeat), and the SVD on ``MAX_FITTED`` of these. Everything else reads all rows.

Cases: null and empty texts, and any text when nothing is labelled, score the mean label of the
sample (0.5 without any); texts of any length are read whole; a document labelled several times
counts with the mean of its labels; null labels are left out; other columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docspark.llm.batches import free_name, put, steps

MAX_LABELLED = 4096
MAX_FITTED = 2048
LATENT = 48
NEIGHBOURS = 25
#: A neighbour's weight is its cosine to this power.
SHARPNESS = 16
#: A document is predicted good from this score on.
ACCEPT = 0.7

#: Sample rows that are dense at once.
BLOCK = 256

_TRIPLES = 4096
_RATIOS = 12
_LENGTHS = 16
_HASHED = 8192
#: Lengths of the letter n-grams.
GRAMS = (2, 4)
FEATURES = _TRIPLES + _RATIOS * _LENGTHS + _HASHED


def _shapes() -> bytes:
    """Class of each byte: capital, small or any non-ASCII letter, digit, blank, break, each mark of its own."""
    table = bytearray(256)
    marks = iter(range(6, 64))
    for b in range(256):
        c = chr(b)
        if b >= 128 or "a" <= c <= "z":
            table[b] = 1
        elif "A" <= c <= "Z":
            table[b] = 2
        elif "0" <= c <= "9":
            table[b] = 3
        elif c == "\n":
            table[b] = 4
        elif b <= 32 or b == 127:
            table[b] = 5
        else:
            table[b] = next(marks)
    return bytes(table)


SHAPES = _shapes()


def _letter_counts(text: str) -> np.ndarray:
    """How often each hashed n-gram of letters occurs."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    counts = np.zeros(_HASHED, np.int64)
    for n in GRAMS:
        codes = np.zeros(max(0, len(points) - n + 1), np.uint32)
        for i in range(n):
            codes = (codes ^ points[i:len(codes) + i]) * np.uint32(0x9E3779B1)
            codes ^= codes >> np.uint32(15)
        counts += np.bincount(codes % _HASHED, minlength=_HASHED)
    return counts


def features(texts: list[str | None]) -> np.ndarray:
    """Unit rows of damped counts; a row of zeros for a text without content."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for i, text in enumerate(texts):
        if not text:
            continue
        data = text.encode("utf-8", "surrogatepass")
        kinds = np.frombuffer((b"\n" + data + b"\n").translate(SHAPES), np.uint8).astype(np.uint32)
        codes = kinds[:-2] * np.uint32(4093) + kinds[1:-1] * np.uint32(257) + kinds[2:] * np.uint32(17)
        counts = np.bincount(codes % _TRIPLES, minlength=_TRIPLES)
        row = np.sqrt(counts.astype(np.float32))
        out[i, :_TRIPLES] = row / np.linalg.norm(row)
        row = np.sqrt(_letter_counts(text).astype(np.float32))
        out[i, -_HASHED:] = row / np.linalg.norm(row)
        words = data.split()
        if words:
            # How far repetition goes, among texts of about this length.
            ratio = len(set(words)) / len(words)
            length = min(_LENGTHS - 1, len(words).bit_length())
            at = min(ratio, 0.9999) * (_RATIOS - 1)
            low = int(at)
            base = _TRIPLES + length * _RATIOS + low
            out[i, base], out[i, base + 1] = 0.5 * (1 - (at - low)), 0.5 * (at - low)
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


class _Sample:
    """Feature rows of the sample, sparse; ``block`` makes a few of them dense and weighted."""

    def __init__(self, at: list[bytes], values: list[bytes]) -> None:
        self.starts = np.cumsum([0, *[len(x) // 2 for x in at]])
        self.at = np.frombuffer(b"".join(at), "<u2")
        self.values = np.frombuffer(b"".join(values), "<f4")
        # Rare features weigh more, as far as the sample knows them.
        held = np.bincount(self.at, minlength=FEATURES)
        self.weights = np.log((1 + len(at)) / (1 + held)).astype(np.float32) + np.float32(0.2)

    def block(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), FEATURES), np.float32)
        for line, row in zip(out, rows):
            own = slice(self.starts[row], self.starts[row + 1])
            line[self.at[own]] = self.values[own]
        return out * self.weights

    def times(self, rows: np.ndarray, basis: np.ndarray) -> np.ndarray:
        return np.concatenate([self.block(part) @ basis for part in _portions(rows)])


def _portions(rows: np.ndarray) -> list[np.ndarray]:
    return [rows[at:at + BLOCK] for at in range(0, len(rows), BLOCK)]


def _leading(sample: _Sample, rows: np.ndarray) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration over blocks: the whole matrix is never made."""
    size = min(LATENT, len(rows), FEATURES)
    basis = np.random.default_rng(11).standard_normal((FEATURES, size)).astype(np.float32)
    for _ in range(12):
        turned = np.zeros_like(basis)
        for part in _portions(rows):
            block = sample.block(part)
            turned += block.T @ (block @ basis)
        basis = np.linalg.qr(turned)[0].astype(np.float32)
    left, values, turn = np.linalg.svd(sample.times(rows, basis), full_matrices=False)
    kept = values > 1e-3 * max(values.max(), 1e-30)
    return (basis @ turn.T.astype(np.float32))[:, kept]


def _labelled_sample(docs: DataFrame, labels: DataFrame, allowed: Column, doc_id: str, text: str, label: str) -> DataFrame:
    """Texts and mean labels of the bounded sample of the rows that ``allowed`` lets in."""
    offered = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & allowed)
    picked = (offered.groupBy(doc_id).agg(F.avg(label).alias("label"))
              .orderBy(F.xxhash64(doc_id), doc_id).limit(MAX_LABELLED))
    return docs.select(doc_id, text).join(F.broadcast(picked), doc_id)


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality") -> dict[str, np.ndarray | float]:
    """Projection, labelled latent vectors and their labels. ``allowed`` is a condition on ``labels``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches, text):
            for start in range(0, len(texts), 256):
                rows = features(texts[start:start + 256])
                at = [np.flatnonzero(row) for row in rows]
                part = batch.slice(start, len(at))
                yield pa.RecordBatch.from_pydict({
                    "id": part.column(0), "label": part.column(2),
                    "at": pa.array([x.astype("<u2").tobytes() for x in at]),
                    "values": pa.array([row[x].astype("<f4").tobytes() for row, x in zip(rows, at)])})

    sample = _labelled_sample(docs, labels, allowed, doc_id, text, label)
    sample = sample.select(F.col(doc_id).cast("string"), text, F.col("label").cast("double"))
    # An id may stand in any number of rows; the sample stays bounded.
    found = sample.mapInArrow(run, "id string, label double, at binary, values binary").orderBy(
        F.xxhash64("id"), "id", "at", "values").limit(MAX_LABELLED).toArrow()
    if not found.num_rows:
        return {"prior": 0.5}
    kept = _Sample(found.column("at").to_pylist(), found.column("values").to_pylist())
    y = found.column("label").to_numpy()
    del found
    everyone = np.arange(len(y))
    basis = _leading(kept, np.linspace(0, len(y) - 1, min(MAX_FITTED, len(y))).astype(int))
    return {"projection": kept.weights[:, None] * basis, "vectors": _unit(kept.times(everyone, basis)), "labels": y,
            "prior": float(y.mean())}


def vote(model: dict, texts: list[str | None]) -> np.ndarray:
    """Score of each text: the labels of its neighbours, weighted by similarity."""
    scores = np.full(len(texts), model["prior"])
    if "vectors" not in model:
        return scores
    vectors, y = model["vectors"], model["labels"]
    k = min(NEIGHBOURS, len(y))
    for start in range(0, len(texts), 256):
        latent = _unit(features(texts[start:start + 256]) @ model["projection"])
        cosines = latent @ vectors.T
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weights = np.clip(np.take_along_axis(cosines, near, 1), 0, None).astype(np.float64) ** SHARPNESS
        total = weights.sum(axis=1)
        known = total > 0
        scores[start:start + len(latent)][known] = (weights * y[near]).sum(axis=1)[known] / total[known]
    return scores.clip(0, 1)


def score_quality(df: DataFrame, model: dict, text: str = "text", score: str = "score") -> DataFrame:
    """Append ``score``, with underscores behind it while the table has such a column; one narrow pass."""
    score = free_name(df, score)
    schema = T.StructType([*df.schema.fields, T.StructField(score, T.DoubleType())])
    arrow = to_arrow_schema(schema)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches, text):
            yield put(batch, arrow, **{score: pa.array(vote(shared.value, texts))})

    return df.mapInArrow(run, schema)
