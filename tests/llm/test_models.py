import random
import re

import pytest
from pyspark.sql import functions as F

from paperloom.llm.common import id_remainder
from paperloom.llm.language import identify_languages, train_languages
from paperloom.llm.toxicity import score_toxicity, sentences, train_toxicity


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    syllables = {"aa": ["ka", "ri", "to", "mun", "el"], "bb": ["ost", "vre", "zug", "hin", "pf"]}
    bad = ["grunk", "blarf", "snid"]
    docs, labels = [], []
    for i in range(600):
        lang = "aa" if i % 3 else "bb"
        words = ["".join(rng.choices(syllables[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(20, 80))]
        toxic = int(i % 6 == 1)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        text = " ".join(w + ("." if rng.random() < 0.1 else "") for w in words)
        docs.append((i, text, lang, "s"))
        labels.append((i, 1, toxic))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_languages_of_held_out_documents(corpus):
    docs, _ = corpus
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    found = identify_languages(docs, train_languages(docs, ~held_out), keep=("lang",)).where(held_out).collect()
    assert len(found) > 100
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows = [(i, "abc abc abc", "one") for i in range(50)] + [(i, "xyz xyz", "two") for i in range(50, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert train_languages(docs, F.col("doc_id") < 50).languages == ["one"]


def test_odd_rows_have_a_language(corpus, odd_docs, no_docs):
    model = train_languages(corpus[0], F.lit(True))
    rows = identify_languages(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert {r.lang_pred for r in rows if r.doc_id in (2, 3, 4, 5)} == {"und"}
    assert identify_languages(no_docs, model).count() == 0
    nothing = train_languages(no_docs, F.lit(True))
    assert {r.lang_pred for r in identify_languages(odd_docs, nothing).collect()} == {"und"}


def test_prototypes_are_the_plain_bundles_and_scores_their_cosines(spark):
    """Every trigram vector made by hand: letters of +1 and -1, permuted by place, multiplied, added up."""
    import numpy as np

    from paperloom.llm.language import DIMENSIONS, SEED

    order = np.random.default_rng(SEED).permutation(DIMENSIONS)
    letter = lambda c: 2.0 * np.random.default_rng([SEED, ord(c)]).integers(0, 2, DIMENSIONS) - 1

    def bundle(text):
        spaced = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
        spaced = re.sub(" +", " ", spaced)
        total = sum(letter(a)[order][order] * letter(b)[order] * letter(c) for a, b, c in zip(spaced, spaced[1:], spaced[2:]))
        return total / np.linalg.norm(total)

    rows = [(1, "Some words, and more", "en"), (2, "words 12 of Öl", "en"), (3, "zug zug hin", "xx"), (4, "more zug?", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train_languages(docs, F.lit(True))
    sums = {lang: sum(bundle(t) for _, t, own in rows if own == lang) for lang in ("en", "xx")}
    wanted = {lang: v / np.linalg.norm(v) for lang, v in sums.items()}
    assert model.languages == ["en", "xx"]
    np.testing.assert_allclose(model.prototypes, [wanted["en"], wanted["xx"]], atol=1e-5)
    for r in identify_languages(docs, model, keep=("text",)).collect():
        cosines = {lang: float(v @ bundle(r.text)) for lang, v in wanted.items()}
        assert r.lang_pred == max(cosines, key=cosines.get) and r.score == pytest.approx(max(cosines.values()), abs=1e-5)


def test_samples_are_bounded_and_the_same_in_any_layout(spark):
    from paperloom.llm.language import _sample

    rows = [(i, f"t{i}", "hot" if i % 10 else "cold") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    ids = [
        sorted((r.lang, r.id) for r in _sample(docs.repartition(n), F.lit(True), "doc_id", "text", "lang", 200).collect())
        for n in (1, 7)
    ]
    assert ids[0] == ids[1] and len(ids[0]) == 400


def test_kept_columns_must_not_clash(spark, corpus, odd_docs):
    docs, labels = corpus
    for keep in (("score",), ("Lang_Pred",)):
        with pytest.raises(ValueError, match="rename the columns"):
            identify_languages(docs, train_languages(docs, F.lit(False)), keep=keep)
    with pytest.raises(ValueError, match="rename the columns"):
        score_toxicity(odd_docs, train_toxicity(docs, labels.limit(0), F.lit(True)), keep=("score",))


def test_noisy_or_of_sentences_by_hand():
    import numpy as np

    from paperloom.llm.toxicity import noisy_or

    assert noisy_or(np.array([0.5, 0.2])) == pytest.approx(1 - 0.5 * 0.8)
    assert noisy_or(np.zeros(0)) == 0.0 and noisy_or(np.array([1.0, 0.3])) == pytest.approx(1.0, abs=1e-6)


def test_toxicity_of_held_out_documents(corpus):
    docs, labels = corpus
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    model = train_toxicity(docs, labels, ~held_out)
    found = score_toxicity(docs, model, keep=("text",)).join(labels, "doc_id").where(held_out).collect()
    assert sum(r.predicted == r.toxic for r in found) / len(found) > 0.97
    for r in found:
        for s in r.offending:  # the sentences found hold the words that were planted
            assert any(w in r.text[s.start : s.end] for w in ("grunk", "blarf", "snid"))
    assert any(r.offending for r in found)


def test_odd_rows_have_a_score(spark, corpus, odd_docs, no_docs):
    docs, labels = corpus
    model = train_toxicity(docs, labels, F.lit(True))
    rows = score_toxicity(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert {(r.score, r.predicted) for r in rows if r.doc_id in (2, 3, 4)} == {(0.0, 0)}
    assert score_toxicity(no_docs, model).count() == 0
    assert score_toxicity(odd_docs, train_toxicity(no_docs, labels.limit(0), F.lit(True))).where("predicted = 1").count() == 0
    odd_labels = spark.createDataFrame([(1, None), (None, 1), (1, 0), (1, 1)], "doc_id long, toxic int")
    train_toxicity(odd_docs, odd_labels, F.lit(True))


def test_sentences():
    text = "One. Two! three\nfour?five"
    assert [text[a:b].strip() for a, b in sentences(text)] == ["One", "Two", "three", "four", "five"]


def test_languages_are_learned_from_all_labelled_texts(spark):
    """1,700 texts of one language, where a sample of 1,500 misses some."""
    import numpy as np
    from paperloom.llm.language import GramSpace, ordinary_cosine, train_languages

    texts = ["".join(chr(97 + (i * k) % 26) for k in range(3, 20)) for i in range(1700)]
    docs = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    space = GramSpace()
    whole = np.sum([space.profile(t).astype("float64") for t in texts], axis=0)
    models = [train_languages(docs.repartition(n), F.lit(True)) for n in (1, 5)]
    assert np.abs(models[0].prototypes[0] - whole / np.linalg.norm(whole)).max() < 1e-6
    assert (models[0].prototypes == models[1].prototypes).all()
    long = docs.where("doc_id < 300").withColumn("text", F.concat_ws(" ", "text", F.lit("the quick brown fox jumps over the lazy dog again and again")))
    cosines = sorted(float(models[0].prototypes[0] @ space.profile(r.text)) for r in long.collect())
    assert abs(ordinary_cosine(long, F.lit(True), models[0]) - max(0.0, cosines[3]) / 2) <= 1e-4


def test_a_long_text_gathers_few_vectors_at_a_time():
    """The bundle is the exact sum of the vectors of all trigrams, which take a byte a dimension."""
    import random
    import numpy as np
    from paperloom.llm.language import GramSpace

    space, rng = GramSpace(), random.Random(5)
    text = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(1500))
    grams, counts = space.trigrams(text)
    rows = space.places(grams)
    bundle = sum(int(n) * space.vectors[row].astype("int64") for row, n in zip(rows, counts))
    assert len(grams) > 3000 and space.vectors.dtype == np.int8
    assert np.abs(space.profile(text) - bundle / np.linalg.norm(bundle)).max() < 1e-6
