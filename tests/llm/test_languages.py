import random

import numpy as np
from pyspark.sql import functions as F

from dewpoint.llm import queries as llm
from dewpoint.llm.languages import Kernel, _solved, identify, spectrum, train

SF_DIR = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, lang_pred int, score string"


def grams(text):
    small = text.lower()
    return {small[i : i + n] for n in (1, 2, 3) for i in range(len(small) - n + 1)}


def kernel(a, b):
    shared, both = len(grams(a) & grams(b)), len(grams(a)) * len(grams(b))
    return shared / both**0.5 if both else 0.0


def test_kernel_equals_sets_of_n_grams():
    draw = random.Random(2)
    texts = ["", "a", "Ab", "aba", "日本語\U0001F600", "İstanbul", "\x00 \x00"]
    texts += ["".join(draw.choices("abcdé ÉÀ.", k=draw.randrange(300))) for _ in range(20)]
    marks = [t for t in texts if t][::2]
    found = Kernel.of([spectrum(t) for t in marks])
    matrix = found.presence(texts) @ found.landmarks
    expected = np.array([[kernel(t, m) for m in marks] for t in texts])
    assert np.abs(matrix - expected).max() < 1e-5  # single precision


def test_long_texts_are_cut_without_loss():
    draw = random.Random(5)
    text = "".join(draw.choices("abcdefghij klmno", k=1_100_000)) + "xyzzy"
    points = {sum((ord(c) + 1) << 21 * (len(g) - 1 - i) for i, c in enumerate(g)) for g in grams(text)}
    assert spectrum(text).tolist() == sorted(points)


def test_regression_equals_its_definition():
    """With every row a landmark it is kernel ridge regression itself."""
    draw = np.random.default_rng(1)
    x = draw.normal(size=(40, 60))
    k = x @ x.T
    target = np.eye(2)[draw.integers(0, 2, 40)]
    weights = _solved(k, target, k, np.zeros(40, dtype=bool))
    exact = np.linalg.solve(k + 1e-3 * 40 * np.eye(40), target - 0.5)
    assert np.abs(k @ weights - k @ exact).max() < 1e-3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    found = llm.op12_language(spark, SF_DIR).join(docs, "doc_id").collect()
    assert len(found) == docs.count()
    apart = [r for r in found if r.held_out]
    assert 150 < len(apart) < 250
    assert sum(r.lang == r.lang_pred for r in apart) >= 0.98 * len(apart)
    assert all(0 <= r.score <= 1 for r in found)


def test_same_model_from_other_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, two = (train(d, rows=100, landmarks=20) for d in (docs, docs.repartition(7).union(docs)))
    assert one.languages == two.languages and np.array_equal(one.grams, two.grams)
    assert len(one.languages) == 4


def test_odd_documents(spark):
    rows = [
        (1, None, "en", 1, "x"), (2, "", "en", 1, "x"), (3, " 12 !\n", "en", 1, "x"),
        (4, "the cat and the dog", "en", 1, "x"), (4, "the cat and the dog", "en", 1, "x"),
        (5, "le chat et le chien", "fr", 1, "x"), (None, "the dog", None, None, None),
        (6, "日本", None, 1, "x"), (7, "é", "fr", 1, "x"), (8, "the dog " * 100_000, "en", 1, "x"),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    model = train(docs)
    found = [tuple(r) for r in identify(docs, model).select("doc_id", "lang_pred", "score").collect()]
    by_id = {i: (p, s) for i, p, s in found}
    assert len(found) == len(rows) and model.languages == ["en", "fr"]
    assert by_id[1] == by_id[2] == by_id[3] == ("und", 0.0)
    assert by_id[4][0] == by_id[8][0] == by_id[None][0] == "en"
    assert by_id[5][0] == by_id[7][0] == "fr"
    assert by_id[6] == ("en", 0.5)  # no landmark has its letters
    assert identify(docs.limit(0), model).collect() == []
    for none in (docs.limit(0), docs.withColumn("lang", F.lit(None).cast("string"))):
        assert train(none) is None
        assert {r.lang_pred for r in identify(docs, train(none)).collect()} == {"und"}
