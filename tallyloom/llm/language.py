"""Language identification by nearest centroid.

A text is a unit vector of TF-IDF weights over hashed byte trigrams; every language has a few
centroids from spherical k-means; the language of the centroid with the largest cosine is predicted.
A text farther from it than nearly all learned texts of that language is marked as rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import bytewords as bw
from tallyloom.llm.base import bounded_sample, column, crc_fold, extended, query, table

DIMENSIONS = 1 << 12
CENTROIDS = 3
#: Texts learned from, per language. Only their vectors reach the driver.
SAMPLE = 300
REJECTED = 0.001

UNKNOWN = "und"

#: Letters stay, lower-cased where ASCII; all else is a blank.
_LETTERS = np.array(
    [b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)],
    dtype=np.uint8,
)


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """Counts of hashed trigrams, one row per text. Trigrams never mix two texts."""
    data, offsets = bw.spaced(texts)
    letters = np.concatenate(([np.uint8(32)], _LETTERS[data]))
    counts = np.zeros(len(texts) * DIMENSIONS, np.float32)
    ends = offsets[1:] + 1
    for a in range(1, len(letters) - 1, bw.CHUNK):
        part = letters[a - 1 : a + bw.CHUNK + 1].astype(np.uint32)
        code = part[:-2] << np.uint32(16) | part[1:-1] << np.uint32(8) | part[2:]
        middle = np.flatnonzero(part[1:-1] != 32)
        slot = (code[middle] * np.uint32(2654435761)) >> np.uint32(32 - 12)
        row = np.searchsorted(ends, middle + a, "right")
        counts += np.bincount(row * DIMENSIONS + slot, minlength=len(counts)).astype(np.float32)
    return counts.reshape(len(texts), DIMENSIONS)


@dataclass
class LanguageModel:
    weights: np.ndarray  # inverse document frequency of each dimension
    centroids: np.ndarray  # one unit vector per row
    languages: list[str]  # language of each centroid
    floors: np.ndarray  # least accepted cosine of each centroid's language

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return unit(np.log1p(counts) * self.weights)

    def predict(self, texts: pa.Array):
        """Nearest centroid and its cosine, for each text."""
        cosine = self.vectors(trigram_counts(texts)) @ self.centroids.T
        best = cosine.argmax(axis=1)
        return best, np.clip(cosine[np.arange(len(best)), best], 0.0, 1.0)


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm == 0, 1, norm)


def _cluster(vectors: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Centroids by spherical k-means, started from the vectors farthest from each other."""
    centres = vectors[:1]
    while len(centres) < min(k, len(vectors)):
        centres = np.vstack([centres, vectors[(vectors @ centres.T).max(axis=1).argmin()]])
    for _ in range(rounds):
        own = (vectors @ centres.T).argmax(axis=1)
        centres = unit(np.vstack([
            vectors[own == c].sum(axis=0) if (own == c).any() else centres[c]
            for c in range(len(centres))
        ]))
    return centres


def fit(labelled: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> LanguageModel | None:
    """Learn from at most `sample` texts of each language in (doc_id, text, lang).

    Vectors are made by tasks from whole texts; the driver gets sample x languages vectors of
    DIMENSIONS bytes counts. None if there is nothing to learn from.
    """

    def rows(batches):
        for batch in bw.chunks(batches):
            counts = trigram_counts(column(batch, "text"))
            packed = [row.tobytes() for row in counts]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "lang"), pa.array(packed, pa.binary())], names=["lang", "counts"]
            )

    usable = labelled.where(F.col("text").isNotNull())
    chosen = bounded_sample(usable.select("doc_id", "text", "lang"), "lang", sample)
    found = chosen.select("text", "lang").mapInArrow(rows, "lang string, counts binary").collect()
    if not found:
        return None
    langs = np.array([r["lang"] for r in found])
    counts = np.vstack([np.frombuffer(r["counts"], np.float32) for r in found])
    order = np.lexsort((counts @ np.arange(DIMENSIONS), langs))  # whatever order tasks end in
    langs, counts = langs[order], counts[order]
    weights = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    vectors = unit(np.log1p(counts) * weights)
    centres, names, floors = [], [], []
    for lang in sorted(set(langs.tolist())):
        own = vectors[langs == lang]
        found_centres = _cluster(own, centroids)
        floor = np.quantile((own @ found_centres.T).max(axis=1), REJECTED)
        centres.append(found_centres)
        names += [lang] * len(found_centres)
        floors += [floor] * len(found_centres)
    return LanguageModel(weights, np.vstack(centres), names, np.array(floors))


def identify(documents: DataFrame, model: LanguageModel | None) -> DataFrame:
    """To each row without its text: lang_pred, score (cosine, 0 to 1) and rejected.

    lang_pred is `und` for a null text, one without a letter, and for all texts if no model could be
    learned; the score is then 0. Rows are answered one by one, repeated ones alike; nothing but the
    text decides. An empty table gives no rows.
    """
    keys = [name for name in documents.columns if name != "text"]
    shared = documents.sparkSession.sparkContext.broadcast(model)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_lettered")

    def rows(batches):
        model = shared.value
        for batch in bw.chunks(batches):
            known = column(batch, "_lettered").to_numpy(zero_copy_only=False)
            if model is None:
                names = [UNKNOWN] * batch.num_rows
                score, far = np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
            else:
                best, score = model.predict(column(batch, "text"))
                names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
                far = ~known | (score < model.floors[best])
                score = np.where(known, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    *(column(batch, name) for name in keys),
                    pa.array(names, pa.string()),
                    pa.array(score.astype(np.float64)),
                    pa.array(far),
                ],
                names=[*keys, "lang_pred", "score", "rejected"],
            )

    schema = extended(
        documents.drop("text").schema, "lang_pred string, score double, rejected boolean"
    )
    return documents.select(*keys, "text", lettered).mapInArrow(rows, schema)


@query()
def op9_language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    held_out = crc_fold(F.col("doc_id"), 4) == 2
    model = fit(documents.where(~held_out))
    return identify(documents.select("doc_id", held_out.alias("held_out"), "text"), model)
