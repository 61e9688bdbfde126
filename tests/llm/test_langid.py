import numpy as np

from pyspark.sql import functions as F

from toxiscope.llm import langid
from toxiscope.llm.queries import op4_langid


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    got = op4_langid(spark, d).join(truth, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and 250 < len(held) < 420
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_messy_rows(messy, no_docs, documents):
    net = langid.train(documents)
    assert net.labels == ["de", "en", "es", "fr"]
    got = langid.predict(messy, net, out=("p", "s"))
    assert got.columns == [*messy.columns, "p", "s"]
    rows = got.collect()
    for r in rows:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.p in net.labels) if letters else (r.p == "und" and r.s == 0)
    assert len(rows) == messy.count()
    assert langid.train(no_docs) is None
    assert langid.predict(messy, None, out=("p", "s")).where("p <> 'und'").count() == 0
    assert langid.predict(no_docs, net).count() == 0


def test_pair_tables_equal_the_plain_network():
    net = langid.ByteConvNet(["a", "b", "c"])
    x = np.random.default_rng(0).integers(0, 256, (130, langid.WINDOW)).astype(np.uint8)
    assert np.allclose(net.probabilities(x), net._forward(x)[2], atol=1e-4)


def test_gradients_match_differences():
    net = langid.ByteConvNet(["a", "b"])
    x = np.random.default_rng(1).integers(97, 105, (5, 20)).astype(np.uint8)
    y = np.array([0, 1, 1, 0, 1])
    g = net._gradients(x, y)
    loss = lambda: -np.log(net._forward(x)[2][np.arange(5), y]).mean()
    for name, at in [("embed", (99, 2)), ("conv3", (4, 1)), ("bias2", (3,)), ("out", (5, 1)), ("shift", (0,))]:
        keep = net.w[name][at]
        net.w[name][at] = keep + 1e-5
        up = loss()
        net.w[name][at] = keep - 1e-5
        down = loss()
        net.w[name][at] = keep
        assert abs((up - down) / 2e-5 - g[name][at]) < 1e-4


def test_whole_text_counts():
    x, used = langid.windows_of(b"A" * (3 * langid.WINDOW + 5))
    assert x.shape == (4, langid.WINDOW) and used.tolist() == [langid.WINDOW] * 3 + [5] and (x[0] == 97).all()


def test_every_language_is_in_the_sample(spark):
    rows = [(i, f"text number {i} of language {i % 80}", f"l{i % 80:02d}") for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    _, labels = langid.training_sample(df)
    assert len(set(labels)) == 80
