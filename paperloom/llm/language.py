"""Language identification with hyperdimensional profiles of letter n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from paperloom.llm.common import by_rows, check_kept

DIMENSIONS = 1024
SEED = 20
CACHED_GRAMS = 60_000
GATHERED = 1024  # vectors of a text's trigrams that are added up at a time
FRACTION = 30  # binary places of the whole numbers that profiles are added up as
BINS = 10_000  # cosines are counted in bins of this fineness
UNDETERMINED = "und"
BATCH_TEXTS = 256
ENOUGH_GRAMS = 40  # distinct trigrams of a text that can be told from noise
ORDINARY = 0.01  # share of the labelled texts that may be further from its own language than ordinary texts
GAP = 32  # stands for any run of characters other than letters


class GramSpace:
    """Vectors of trigrams: three random letter vectors of +1 and -1, permuted by their place, multiplied together."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.order = np.random.default_rng(SEED).permutation(dimensions)
        self.is_letter = np.array([chr(c).isalpha() for c in range(0x110000)])
        self.letters: dict[int, np.ndarray] = {}
        self.forget()

    def forget(self) -> None:
        self.codes = np.zeros(0, "int64")
        self.rows = np.zeros(0, "int64")
        self.vectors = np.zeros((1024, self.dimensions), "int8")

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            bits = np.random.default_rng([SEED, code]).integers(0, 2, self.dimensions)
            self.letters[code] = (2 * bits - 1).astype("int8")
        return self.letters[code]

    def trigrams(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct trigrams of the lower-cased letters, words apart by one gap, and their counts."""
        points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype("int64")
        points = np.where(self.is_letter[points], points, GAP)
        points = points[np.append(True, (points[1:] != GAP) | (points[:-1] != GAP))]
        if len(points) < 3:
            return np.zeros(0, "int64"), np.zeros(0, "int64")
        return np.unique(points[:-2] << 42 | points[1:-1] << 21 | points[2:], return_counts=True)

    def places(self, grams: np.ndarray) -> np.ndarray:
        """Row of each gram in `vectors`; vectors of new grams are made."""
        if len(self.codes) + len(grams) > CACHED_GRAMS:
            self.forget()
        at = np.searchsorted(self.codes, grams)
        known = at < len(self.codes)
        known[known] = self.codes[at[known]] == grams[known]
        if not known.all():
            new = grams[~known]
            start = len(self.codes)
            while start + len(new) > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
            once, twice = self.order, self.order[self.order]
            for i, gram in enumerate(new.tolist()):
                a, b, c = gram >> 42, (gram >> 21) & 0x1FFFFF, gram & 0x1FFFFF
                self.vectors[start + i] = self.letter(a)[twice] * self.letter(b)[once] * self.letter(c)
            codes = np.concatenate([self.codes, new])
            rows = np.concatenate([self.rows, np.arange(start, start + len(new))])
            order = np.argsort(codes)
            self.codes, self.rows = codes[order], rows[order]
            at = np.searchsorted(self.codes, grams)
        return self.rows[at]

    def profile(self, text: str | None) -> np.ndarray | None:
        """The bundle of all trigrams, scaled to length one; None without a letter."""
        return self.measured(text)[0]

    def measured(self, text: str | None) -> tuple[np.ndarray | None, int]:
        """The profile of a text and the number of its distinct trigrams."""
        if not text:
            return None, 0
        grams, counts = self.trigrams(text)
        if not len(grams):
            return None, 0
        rows = self.places(grams)  # may move `vectors`
        bundle, weights = np.zeros(self.dimensions, "float32"), counts.astype("float32")
        for at in range(0, len(rows), GATHERED):  # whole numbers, so the parts add up exactly
            bundle += weights[at : at + GATHERED] @ self.vectors[rows[at : at + GATHERED]].astype("float32")
        length = float(np.linalg.norm(bundle))
        return bundle / length if length else bundle, len(grams)


@dataclass
class LanguageModel:
    languages: list[str]
    prototypes: np.ndarray  # one unit vector for each language


def _sample(
    docs: DataFrame, usable: Column, id_col: str, text_col: str, lang_col: str, per_language: int
) -> DataFrame:
    """(id, lang, text) of at most `per_language` labelled documents of each language, chosen by a hash of the id.

    Languages are counted first; a hash then leaves little more than the wanted
    number of each, before any rows of one language meet in a task.
    """
    rows = docs.where(usable & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull())
    ids = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"))
    # one row for each language, as the model has one vector
    share = ids.groupBy("lang").agg((F.lit(1.2 * per_language + 100) / F.count(F.lit(1))).alias("share"))
    place = F.xxhash64("id") / F.lit(2.0**64) + F.lit(0.5)
    near = ids.join(F.broadcast(share), "lang").where(place < F.col("share")).select("id", "lang")
    first = W.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    sample = near.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language).select("id").distinct()
    wanted = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    return wanted.join(F.broadcast(sample), "id", "left_semi")


def _labelled(docs: DataFrame, usable: Column, text_col: str, lang_col: str) -> DataFrame:
    """(lang, text) of all documents that may be learned from."""
    rows = docs.where(usable & F.col(lang_col).isNotNull())
    return rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))


def train_languages(
    docs: DataFrame, usable: Column, text_col: str = "text", lang_col: str = "lang"
) -> LanguageModel:
    """Prototypes from all labelled documents where `usable` holds.

    Each task adds up its documents' profiles and Spark the sums of the tasks,
    so the driver gets one vector for each language. Profiles are added up as
    whole numbers: the sums are the same however the rows are dealt to tasks.
    """
    chosen = _labelled(docs, usable, text_col, lang_col)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        space, total = GramSpace(), {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                profile = space.profile(text)
                if profile is not None:
                    whole = np.rint(profile.astype("float64") * (1 << FRACTION)).astype("int64")
                    total[lang] = total.get(lang, 0) + whole
        if total:
            yield pd.DataFrame({"lang": list(total), "bundle": list(total.values())})

    parts = chosen.mapInPandas(sums, "lang string, bundle array<bigint>")
    places = parts.select("lang", F.posexplode("bundle").alias("place", "value"))
    added = places.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    bundles: dict[str, np.ndarray] = {}
    for row in added.collect():  # one vector for each language
        bundles.setdefault(row["lang"], np.zeros(DIMENSIONS))[row["place"]] = row["value"]
    names = sorted(n for n in bundles if bundles[n].any())
    vectors = np.array([bundles[n] / np.linalg.norm(bundles[n]) for n in names], "float32").reshape(-1, DIMENSIONS)
    return LanguageModel(names, vectors)


def ordinary_cosine(
    docs: DataFrame,
    usable: Column,
    model: LanguageModel,
    text_col: str = "text",
    lang_col: str = "lang",
) -> float:
    """A cosine well below those of texts in the learned languages: half of what all but ORDINARY of the labelled texts reach.

    All labelled texts where `usable` holds and with ENOUGH_GRAMS trigrams are
    measured, each against its own language, and counted in bins; the lower
    end of a bin stands for its cosines. 0 without any.
    """
    at = {name: i for i, name in enumerate(model.languages)}

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        space = GramSpace()
        for batch in batches:
            found = []
            for lang, text in zip(batch["lang"], batch["text"]):
                profile, n_grams = space.measured(text)
                if profile is not None and lang in at and n_grams >= ENOUGH_GRAMS:
                    found.append(float(model.prototypes[at[lang]] @ profile))
            yield pd.DataFrame({"cosine": found}, dtype="float64")

    found = _labelled(docs, usable, text_col, lang_col).mapInPandas(measure, "cosine double")
    bins = found.groupBy(F.floor(F.col("cosine") * BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    counted = sorted((r["bin"], r["n"]) for r in bins.collect())  # 2 * BINS rows and a few at most
    if not counted:
        return 0.0
    reached = np.cumsum([n for _, n in counted])
    at = int(np.searchsorted(reached, ORDINARY * reached[-1], side="right"))
    return max(0.0, counted[at][0] / BINS / 2)


def identify_languages(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """The nearest language prototype of every whole text: doc_id, lang_pred, score, grams, and the columns in `keep`.

    score is the cosine of the document's bundle and the prototype, 0 where it
    is negative. Null and empty texts and texts without a letter are `und`
    with score 0, and so is everything when no language was learned. Equal
    cosines take the language that sorts first. grams is the number of distinct
    trigrams. Rows are judged one by one: repeated rows and null ids stay. An
    empty table gives no rows. `keep` must not name a column of the result;
    that raises a ValueError.
    """
    check_kept(keep, ("lang_pred", "score", "grams"))
    names, prototypes = model.languages, model.prototypes

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        space = GramSpace()
        for piece in by_rows(batches, BATCH_TEXTS):
            preds, scores, grams = [], [], []
            for text in piece["__text"]:
                profile, n_grams = space.measured(text) if names else (None, 0)
                grams.append(n_grams)
                if profile is None:
                    preds.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                cosines = prototypes @ profile
                best = int(np.argmax(cosines))
                preds.append(names[best])
                scores.append(min(1.0, max(0.0, float(cosines[best]))))
            yield piece.drop(columns="__text").assign(lang_pred=preds, score=scores, grams=grams)

    kept = docs.select(
        F.col(id_col).alias("doc_id"), *[F.col(c) for c in keep if c != "doc_id"], F.col(text_col).alias("__text")
    )
    schema = kept.drop("__text").schema.add("lang_pred", "string").add("score", "double").add("grams", "long")
    for field in schema.fields:
        field.nullable = True
    return kept.mapInPandas(work, schema)
