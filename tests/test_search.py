"""The inverted index (F1) against brute force."""

import random
import shutil

from pyspark.sql import functions as F

from voxtide.operators import search as SI

SCHEMA = "review_id string, text string"


def test_search_matches_brute_force(spark, tmp_path):
    rng = random.Random(11)
    letters = "abcÄé ñ"
    texts = [None, "", "ab", "X" * 5000 + "needle in hay"] + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    rows = [(str(i), t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    path = str(tmp_path / "index")
    SI.index_texts(df.where("review_id % 2 = 0"), path, batch=0)
    SI.index_texts(df.where("review_id % 2 = 1").limit(3), path, batch=1)
    SI.index_texts(df.where("review_id % 2 = 1"), path, batch=1)        # a batch that is indexed again replaces itself
    SI.index_texts(df.where("review_id < 0"), path, batch=2)            # an empty one
    subjects = ["NEEDLE", "abc", "ä é", "bca", "é", "", "zzz", "cab a", "xxxxx"] + [t[5:12] for t in texts[4:40] if len(t) > 12]
    for s in subjects:
        got = sorted(r.review_id for r in SI.search_index(spark, path, s, SCHEMA).collect())
        assert got == sorted(i for i, t in rows if t is not None and s.lower() in t.lower()), s


def test_a_rare_subject_reads_its_partitions_only(spark, tmp_path):
    df = spark.range(3000).select(F.col("id").cast("string").alias("review_id"), F.concat(F.lit("common words and "), F.sha1(F.col("id").cast("string"))).alias("text"))
    path = str(tmp_path / "index")
    SI.index_texts(df, path)
    rare = df.where("review_id = 77").first().text[17:]
    part = spark.read.parquet(f"{path}/texts").where("review_id = 77").first().part
    for p in range(SI.PARTS):
        if p != part:
            shutil.rmtree(f"{path}/texts/batch=0/part={p}")
    assert [r.review_id for r in SI.search_index(spark, path, rare, SCHEMA).collect()] == ["77"]
    shutil.rmtree(f"{path}/postings")
    shutil.rmtree(f"{path}/texts/batch=0/part={part}")
    assert SI.search_index(spark, path, "nothing like it", SCHEMA).count() == 0     # a gram that no text has: neither is read
