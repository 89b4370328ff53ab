"""Timings of the headline jobs; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paperloom.operators.grams import FEATURES  # noqa: E402
from paperloom.operators.weights import WEIGHTINGS  # noqa: E402
from paperloom.plans.build_index import build_index  # noqa: E402
from paperloom.plans.search import search  # noqa: E402
from paperloom.registry import inputs  # noqa: E402
from paperloom.registry.queries import QUERIES  # noqa: E402
from paperloom.session import fresh_path, local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SINGLE = (
    "tf_unigram", "tf_bigram", "binary_bigram", "tfidf_unigram", "tfidf_bigram", "vocabulary", "top10_similar",
    "topk_padded", "cosine_scores", "normalize_docs", "lemma_join", "complete_records", "bib_records", "ris_records",
    "article_details", "cap_per_section", "section_counts",
)


def timed(job) -> float:
    start = time.perf_counter()
    df = job()
    if isinstance(df, DataFrame):
        df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) if CPUS.isdigit() else 8, memory="16g")
    docs, queries = inputs.documents(spark, SF_DIR), inputs.queries(spark, SF_DIR)
    timed(lambda: QUERIES["tf_unigram"](spark, SF_DIR))  # starts the JVM's compilers and the file cache
    base = fresh_path(spark, "bench-index")
    seconds = {f"build_{f}": timed(lambda f=f: build_index(docs, base, f, [f])) for f in FEATURES}
    seconds["build_both"] = timed(lambda: build_index(docs, base, "documents"))
    for feature in FEATURES:
        for weighting in WEIGHTINGS:
            job = lambda f=feature, w=weighting: search(spark, queries, base, "documents", f, w)
            seconds[f"search_{weighting}_{feature}"] = timed(job)
    seconds |= {name: timed(lambda n=name: QUERIES[n](spark, SF_DIR)) for name in SINGLE}
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
