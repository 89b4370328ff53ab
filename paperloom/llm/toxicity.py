"""Toxicity by multiple-instance learning: sentence scores joined by noisy-or, learned from document labels."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from paperloom.llm.common import by_rows, check_kept

BUCKETS = 1 << 20
SAMPLE_DOCUMENTS = 12_000  # bound of the labelled sample that the weights are fitted to
EPOCHS = 200
LEARNING_RATE = 0.3
SHRINK = 1e-6
FIRST_BIAS = -6.0
FIRST_WEIGHT = 6.0
MIN_RATIO = 25.0  # log-likelihood ratio of a word that tells toxic documents from clean ones
MIN_DOCUMENTS = 4
MIN_LIFT = 5  # times the share of clean documents with a word that the share of toxic ones must be
BATCH_TEXTS = 512
THRESHOLD = 0.5
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")
CACHED_WORDS = 300_000


class WordBuckets(dict):
    """Hash bucket of each lower-case word; forgets all when it holds too many."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word) % BUCKETS
        return found


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence: runs without full stop, exclamation or question mark, or line end."""
    return [m.span() for m in SENTENCE.finditer(text)]


def instances(text: str | None, buckets: WordBuckets) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Distinct word buckets of each sentence, where it begins among them, and the spans of the sentences with a word."""
    words, starts, spans = [], [], []
    for start, end in sentences(text or ""):
        found = set(WORD.findall(text[start:end].lower()))
        if found:
            starts.append(len(words))
            spans.append((start, end))
            words.extend(sorted(map(buckets.__getitem__, found)))
    return np.array(words, "int32"), np.array(starts, "int64"), spans


Bag = tuple[np.ndarray, np.ndarray, int]  # word buckets, where each sentence begins among them, label


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float

    def sentence_scores(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        z = np.add.reduceat(self.weights[words].astype("float64"), starts) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def noisy_or(scores: np.ndarray) -> float:
    """The chance that at least one sentence offends; 0 without a sentence."""
    return float(-np.expm1(np.log1p(-np.minimum(scores, 1 - 1e-12)).sum())) if len(scores) else 0.0


def without_copies(bags: list[Bag]) -> list[Bag]:
    """One bag of each group of copies and near copies, which would make any of their words look telling.

    A bag goes if its label and four least word hashes, under any of four
    hashings, are those of an earlier bag.
    """
    seen: set[tuple] = set()
    kept = []
    for words, starts, label in bags:
        distinct = np.unique(words).astype("uint64")
        sketch = []
        for number, factor in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)):
            mixed = (distinct + np.uint64(1)) * np.uint64(factor)
            mixed ^= mixed >> np.uint64(29)
            least = np.sort(mixed * np.uint64(0xBF58476D1CE4E5B9))[:4]
            sketch.append((number, label, least.tobytes()))
        if not seen.intersection(sketch):
            kept.append((words, starts, label))
        seen.update(sketch)
    return kept


def telling_words(bags: list[Bag]) -> np.ndarray:
    """Buckets that clearly more toxic than clean documents have, by the log-likelihood ratio of their presence."""
    labels = np.array([y for _, _, y in bags])
    toxic = np.bincount(np.concatenate([np.unique(w) for w, _, y in bags if y == 1] or [[]]).astype("int64"), minlength=BUCKETS)
    clean = np.bincount(np.concatenate([np.unique(w) for w, _, y in bags if y == 0] or [[]]).astype("int64"), minlength=BUCKETS)
    n_toxic, n_clean = int((labels == 1).sum()), int((labels == 0).sum())
    if not n_toxic or not n_clean:
        return np.zeros(0, "int64")
    share = (toxic + clean) / (n_toxic + n_clean)

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)

    ratio = 2 * (
        part(toxic, n_toxic * share)
        + part(clean, n_clean * share)
        + part(n_toxic - toxic, n_toxic * (1 - share))
        + part(n_clean - clean, n_clean * (1 - share))
    )
    often = toxic * n_clean >= MIN_LIFT * clean * n_toxic
    return np.flatnonzero((ratio >= MIN_RATIO) & often & (toxic >= MIN_DOCUMENTS))


def fit_noisy_or(bags: list[Bag]) -> ToxicityModel:
    """Maximum likelihood of the document labels under the noisy-or of sentence scores, by Adagrad on all bags at once.

    Only telling words get a weight: with every word, rare ones would be
    learned by heart.
    """
    weights, bias = np.zeros(BUCKETS, "float64"), FIRST_BIAS
    bags = without_copies([b for b in bags if len(b[1])])
    chosen = telling_words(bags) if bags else np.zeros(0, "int64")
    if not len(chosen):
        return ToxicityModel(weights.astype("float32"), bias)
    column = np.full(BUCKETS, -1, "int32")
    column[chosen] = np.arange(len(chosen))
    labels = np.array([y for _, _, y in bags], "float64")
    n_sentences = np.array([len(s) for _, s, _ in bags])
    first = np.cumsum(n_sentences) - n_sentences
    features, owners = [], []
    for at, (words, starts, _) in zip(first, bags):
        columns = column[words]
        where = np.flatnonzero(columns >= 0)
        features.append(columns[where])
        owners.append(at + np.searchsorted(starts, where, "right") - 1)
    feature, owner = np.concatenate(features), np.concatenate(owners)
    total = int(n_sentences.sum())
    importance = 1.0 / len(bags)
    w, seen, seen_bias = np.full(len(chosen), FIRST_WEIGHT), np.full(len(chosen), 1e-12), 1e-12
    for _ in range(EPOCHS):
        z = np.bincount(owner, w[feature], total) + bias
        p = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
        whole = -np.expm1(np.add.reduceat(np.log1p(-np.minimum(p, 1 - 1e-12)), first))
        slope = p * np.repeat(importance * (labels - whole) / np.maximum(whole, 1e-9), n_sentences)
        gradient = np.bincount(feature, slope[owner], len(w)) - SHRINK * w
        seen += gradient**2
        w += LEARNING_RATE * gradient / np.sqrt(seen)
        seen_bias += slope.sum() ** 2
        bias += LEARNING_RATE * slope.sum() / np.sqrt(seen_bias)
    weights[chosen] = w
    return ToxicityModel(weights.astype("float32"), float(bias))


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE_DOCUMENTS,
) -> ToxicityModel:
    """Fit sentence weights to at most `sample` labelled documents, chosen by a hash of the id.

    `usable` says which label rows may be learned from. A document labelled
    more than once counts as toxic if any label says so. Word buckets, not
    texts, go to the driver; their number is bounded with the sample.
    """
    known = labels.where(usable & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    marked = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    chosen = marked.orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets = WordBuckets()
        for piece in by_rows(batches, BATCH_TEXTS):
            made = [instances(text, buckets)[:2] for text in piece["text"]]
            yield pd.DataFrame(
                {
                    "id": piece["id"].to_numpy(),
                    "words": [w.tobytes() for w, _ in made],
                    "starts": [s.tobytes() for _, s in made],
                    "toxic": piece["toxic"].to_numpy(),
                }
            )

    rows = texts.mapInPandas(bags, "id long, words binary, starts binary, toxic int").toPandas()
    rows = rows.sort_values(["id", "words"], kind="stable").drop_duplicates("id")  # one order in every run
    return fit_noisy_or(
        [
            (np.frombuffer(w, "int32"), np.frombuffer(s, "int64"), y)
            for w, s, y in zip(rows["words"], rows["starts"], rows["toxic"])
        ]
    )


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Noisy-or score of every whole text and its offending sentences: doc_id, score, predicted, offending, `keep`.

    offending holds start, end (characters) and score of each sentence whose
    own score reaches one half, in the order of the text. Null and empty texts
    and texts without a word have score 0. Rows are judged one by one:
    repeated rows and null ids stay. An empty table gives no rows. `keep` must
    not name a column of the result; that raises a ValueError.
    """
    check_kept(keep, ("score", "predicted", "offending"))
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((model.weights, model.bias))  # BUCKETS floats, whatever the input

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, buckets = ToxicityModel(*sent.value), WordBuckets()
        for piece in by_rows(batches, BATCH_TEXTS):
            scores, offending = [], []
            for text in piece["__text"]:
                words, starts, spans = instances(text, buckets)
                p = own.sentence_scores(words, starts) if len(starts) else np.zeros(0)
                scores.append(noisy_or(p))
                bad = np.flatnonzero(p >= THRESHOLD).tolist()
                offending.append([{"start": spans[i][0], "end": spans[i][1], "score": float(p[i])} for i in bad])
            predicted = [int(s >= THRESHOLD) for s in scores]
            yield piece.drop(columns="__text").assign(score=scores, predicted=predicted, offending=offending)

    kept = docs.select(
        F.col(id_col).alias("doc_id"), *[F.col(c) for c in keep if c != "doc_id"], F.col(text_col).alias("__text")
    )
    added = "score double, predicted int, offending array<struct<start:int,end:int,score:double>>"
    schema = StructType([*kept.drop("__text").schema.fields, *StructType.fromDDL(added).fields])
    for field in schema.fields:
        field.nullable = True
    return kept.mapInPandas(work, schema)
