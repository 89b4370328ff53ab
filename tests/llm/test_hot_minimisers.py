"""A line that many documents hold must not gather all of them in one group."""

import random

from pyspark.sql import functions as F

from paperloom.llm import passages as S


def test_line_in_different_surroundings(spark, monkeypatch, tmp_path):
    real, folder = S.repeated_windows, str(tmp_path)

    def measured(bucket, window):
        import os
        import uuid

        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write(str(int(bucket["words"].notna().sum())))
        return real(bucket, window)

    monkeypatch.setattr(S, "repeated_windows", measured)
    monkeypatch.setattr(S, "BUCKET_RUNS", 100)
    monkeypatch.setattr(S, "HOT_RUNS", 50, raising=False)
    rng = random.Random(5)
    line = [f"line{i}" for i in range(12)]
    rows = []
    for i in range(1500):
        own = [f"w{rng.randrange(10**9)}" for _ in range(40)]
        rows.append((i, " ".join(own[:20] + line + own[20:])))
    rows += [(2000 + i, rows[i][1]) for i in range(0, 1500, 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    removed = S.remove_repeated_passages(docs).groupBy((F.col("doc_id") >= 2000).alias("copy"))
    got = {r.copy: (r.least, r.most) for r in removed.agg(F.min("n_removed").alias("least"), F.max("n_removed").alias("most")).collect()}
    assert got == {False: (0, 0), True: (52, 52)}
    assert max(int(p.read_text()) for p in tmp_path.iterdir()) <= 400
