"""From saved exports to a search result, through the public functions only."""

import pytest

from paperloom.operators.ordering import with_row_index
from paperloom.plans.build_corpus import journal_corpus, normalized_corpus
from paperloom.plans.build_index import index_articles
from paperloom.plans.search import search_entries
from paperloom.sources.citations import read_entries
from paperloom.sources.nbib import read_nbib
from paperloom.sources.tables import JOURNAL_COLUMNS, read_raw, write_raw

TITLES = ["Sleep deprivation in athletes", "Cardiac fibrosis atlas", "Burden of cancer", "Scurfy mouse protein"]


def test_exports_to_ranking(spark, tmp_path):
    exports, queries = tmp_path / "exports", tmp_path / "queries"
    exports.mkdir(), queries.mkdir()
    for i, title in enumerate(TITLES):
        (exports / f"{i}.nbib").write_text(
            f"PMID- {i}\nTI  - {title}\nAB  - We study {title.lower()}\n      and the methods.\nAU  - A\nAU  - B\n"
            f"JT  - J\nDP  - 202{i} Spring\nLID - 10.1/{i} [doi]\n"
        )
    (exports / "bad.nbib").write_text("TI  - No abstract\n")
    (queries / "q.bib").write_text("@article{q, title={Cancer burden}, abstract={Burden of {cancer} and the methods}}")
    (queries / "q.ris").write_text("TY  - JOUR\nTI  - Cardiac atlas of fibrosis\nER  - \n")

    write_raw(journal_corpus(read_nbib(spark, str(exports))), str(tmp_path / "raw"))
    articles = read_raw(spark, str(tmp_path / "raw"), JOURNAL_COLUMNS)
    assert articles.count() == 4
    normal = {r.DOI: r.Title for r in normalized_corpus(articles).collect()}
    assert normal["10.1/2"] == "burden cancer"

    numbered = with_row_index(articles, "DOI")
    assert [(r.DOI, r.doc_idx) for r in numbered.orderBy("DOI").collect()] == [(f"10.1/{i}", i) for i in range(4)]
    index_articles(numbered, str(tmp_path / "index"), "pubmed", id_col="doc_idx")
    found = search_entries(spark, read_entries(spark, str(queries)), str(tmp_path / "index"), "pubmed")
    best = {r.query_id.rsplit("/", 1)[-1]: r.doc_id for r in found.where("rank = 1").collect()}
    assert best == {"q.bib": 2, "q.ris": 1}
    assert found.count() == 8  # a corpus of fewer than ten gives all of it


def test_lemmas_on_both_sides(spark, tmp_path):
    rows = [(0, "Neural networks studies", "Of networks"), (1, "Neural network study", None), (2, "Other things", "x")]
    articles = spark.createDataFrame(rows, "doc_id long, Title string, Abstract string")
    lemmas = spark.createDataFrame([("networks", "network"), ("studies", "study")], "token string, lemma string")
    normal = normalized_corpus(articles, lemmas=lemmas, id_col="doc_id").orderBy("doc_id").collect()
    assert [tuple(r) for r in normal[:2]] == [(0, "neural network study", "network"), (1, "neural network study", "")]
    index_articles(articles, str(tmp_path / "index"), "c", lemmas=lemmas)
    (tmp_path / "queries").mkdir()
    (tmp_path / "queries" / "q.bib").write_text("@article{q, title={The studies}}")
    found = search_entries(spark, read_entries(spark, str(tmp_path / "queries")), str(tmp_path / "index"), "c")
    assert {r.doc_id for r in found.where("score > 0").collect()} == {0, 1}


def test_one_command_indexes_and_adds(spark, tmp_path):
    from paperloom.plans.run import parsed, run
    from paperloom.plans.search import search

    record = "PMID- {0}\nTI  - {1}\nAB  - We study {1}\nAU  - A\nJT  - J\nDP  - 2020\nLID - 10.1/{0} [doi]\n"
    for name, titles in (("first", TITLES[:2]), ("second", TITLES[2:])):
        (tmp_path / name).mkdir()
        text = "\n\n".join(record.format(f"{name}{i}", t) for i, t in enumerate([*titles, titles[0]]) if i < 2 or name == "first")
        (tmp_path / name / "all.nbib").write_text(text)
    base, out = str(tmp_path / "index"), str(tmp_path / "corpus")
    options = ["--index", base, "--corpus-out", out]
    first = run(spark, parsed([*options, "--exports", str(tmp_path / "first")]))["pubmed"]
    both = run(spark, parsed([*options, "--exports", str(tmp_path / "second"), "--append", "--keep-versions", "1"]))["pubmed"]
    assert (first.n_docs, both.n_docs, len(both.segments)) == (3, 5, 2)
    kept = {r.doc_id: r.Title for r in spark.read.parquet(f"{out}/pubmed.parquet").collect()}
    assert sorted(kept) == list(range(5))
    queries = spark.createDataFrame([(1, "cancer burden")], "query_id long, text string")
    (best,) = search(spark, queries, base, "pubmed").where("rank = 1").collect()
    assert kept[best.doc_id] == "Burden of cancer"
    with pytest.raises(SystemExit):
        parsed(["--index", base])
