import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from casona.llm import langid


def test_held_out_accuracy(spark, docs):
    found = langid.predict(docs.withColumn("held", langid.held_out()), langid.train(docs), keep=["doc_id", "held", "lang"]).toPandas()
    held = found[found["held"]]
    assert set(held["doc_id"]) == {d for d in found["doc_id"] if zlib.crc32(str(d).encode()) % 5 == 0}
    assert langid.accuracy(held) >= 0.95 and found["score"].between(0, 1).all()


def test_windows_equal_plain_convolution():
    model = langid.ByteCNN.fresh(["a", "b"], 3)
    text = ("Ein Haus, 12 Bäume; " * 40).encode()
    rows = langid.windows_of(text)
    classes = [int(langid.CLASS_OF[b]) for b in text] + [0] * langid.WINDOW * 2
    for w in range(len(rows)):
        best = [-1e9] * (langid.FILTERS * len(langid.WIDTHS))
        for p in range(w * langid.WINDOW, (w + 1) * langid.WINDOW):
            for f in range(len(best)):
                width = max(langid.WIDTHS) - f // langid.FILTERS
                at = [classes[p + j] if p + j < len(text) else 0 for j in range(width)]
                best[f] = max(best[f], sum(float(model.taps[j][c, f]) for j, c in enumerate(at)))
        assert np.allclose(model.maps(rows[w : w + 1]).max(axis=1)[0], best, atol=1e-4)


def test_edge_cases(edge, edge_rows):
    model = langid.train(edge, chars=200)
    rows = langid.predict(edge, model).collect()
    assert len(rows) == len(edge_rows)
    by_text = {r["text"]: r for r in rows}
    for text in (None, "", " \t\n ", "123 ... !!!"):
        assert by_text[text]["lang_pred"] == "und" and by_text[text]["score"] == 0
    assert {r["lang_pred"] for r in rows} <= {"und", "en", "fr", "de", "es"}
    assert all(r["fingerprint"] == "f" for r in rows)
    kept = langid.predict(edge, model, min_score=0.0).count()
    assert kept == sum(r["lang_pred"] != "und" for r in rows)


def test_prediction_reads_only_the_text(spark, docs):
    model = langid.train(docs)
    few = docs.limit(40)
    changed = few.select((F.col("doc_id") + 7).alias("doc_id"), "text", F.lit("xx").alias("lang"), F.lit("s").alias("source"), "n_chars")
    a, b = (sorted((r["text"], r["lang_pred"], r["score"]) for r in langid.predict(x, model).collect()) for x in (few, changed))
    assert a == b


def test_nothing_learned(none, docs):
    assert langid.predict(none, langid.train(none)).count() == 0
    model = langid.train(none)
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(docs.limit(5), model).collect()} == {("und", 0.0)}


def test_one_label_and_late_text():
    model = langid.fit([b"abc def"], ["en"])
    assert model.predict([b"xyz"])[0] == ["en"]
    rng = random.Random(1)
    two = langid.fit([bytes(rng.choices(b"abcdefgh ", k=400)) for _ in range(30)] + [bytes(rng.choices(b"stuvwxyz ", k=400)) for _ in range(30)], ["a"] * 30 + ["b"] * 30, steps=150)
    assert two.predict([b"ab cd " * 10 + b"st uv xyz " * 4000])[0] == ["b"]  # the whole text counts, not its start
