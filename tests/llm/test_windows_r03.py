"""Round 3: windows of words are sorted only in texts where two of them have the same hash."""

from collections import Counter

from pyspark.sql import functions as F

from siftloom.llm.op12_divergence import measure


def _repeated(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)})


def test_only_texts_with_equal_hashes_are_sorted(spark):
    texts = ["", "a", "a a", "a a a", "a a a a", "a b c a b c", "a b c d", "b a b a b", " ".join(f"w{i}" for i in range(300)), " ".join(f"w{i % 70}" for i in range(300)), "x y z q x y z", None]
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    common = spark.createDataFrame([("en", ["a", "b"])], "lang string, common array<string>")
    measured = measure(docs, common)
    assert {r.doc_id: r.n_repeat_words for r in measured.collect()} == {i: _repeated((t or "").split()) for i, t in enumerate(texts)}
    plan = measured._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan
    assert measured.where(F.col("n_repeat_words").isNull()).count() == 0
