import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from orderlens.llm import kneser_ney as kn


class Brute:
    """The same model over dictionaries of byte strings."""

    def __init__(self, texts, order=kn.ORDER):
        self.order = order
        grams = {order: Counter(g for t in texts for g in self.grams(t))}
        for k in range(order - 1, 0, -1):
            grams[k] = Counter(g[1:] for g in grams[k + 1])
        self.c = grams
        self.d = {k: kn.discounts_of([sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]) for k, c in grams.items()}
        self.ctx = {}
        for k, c in grams.items():
            by = defaultdict(list)
            for g, n in c.items():
                by[g[:-1]].append(n)
            self.ctx[k] = by

    def grams(self, text):
        data = b"\xff" * (self.order - 1) + text.encode()
        return [data[i : i + self.order] for i in range(len(data) - self.order + 1)]

    def p(self, gram):
        p = 1 / 256
        for k in range(1, self.order + 1):
            g = gram[-k:]
            counts = self.ctx[k].get(g[:-1])
            if counts:
                d = self.d[k]
                c = self.c[k].get(g, 0)
                rest = sum(d[min(n, 3) - 1] for n in counts) / sum(counts)
                p = max(c - (d[min(c, 3) - 1] if c else 0), 0) / sum(counts) + rest * p
        return p

    def nats(self, text):
        g = self.grams(text)
        return -sum(math.log(self.p(x)) for x in g) / len(g) if g else None


TRUSTED = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "größe und höhe", "the cat"] * 3 + ["the mat and the log and the cat"]
OTHERS = ["the cat and the dog", "zzzz qqqq xxxx", "", "größe", "th", "\x00\x01", "the cat sat " * 2000, "漢字"]


@pytest.mark.parametrize("shard_rows", [kn.SHARD_ROWS, 40])
def test_perplexities_match_brute_force(frame, monkeypatch, shard_rows):
    monkeypatch.setattr(kn, "SHARD_ROWS", shard_rows)
    trusted = frame([(t,) for t in TRUSTED], "text string")
    texts = frame([(t, len(t.encode())) for t in TRUSTED + OTHERS], "text string, size int").withColumn("id", F.col("text"))
    model = kn.train(trusted)
    brute = Brute(TRUSTED)
    for k in range(1, kn.ORDER + 1):
        assert {r.gram.to_bytes(k, "big"): r.c for r in model.grams[k].collect()} == dict(brute.c[k])
        assert model.discounts[k] == pytest.approx(brute.d[k])
    logs = kn.log_probabilities(kn.ngram_counts(texts).select("gram"), model)
    got = {r.id: r.nats for r in kn.perplexities(texts, logs).collect()}
    assert len(got) == len(set(TRUSTED + OTHERS))
    for t, nats in got.items():
        assert (nats is None) == (t == "")
        if t:
            assert nats == pytest.approx(brute.nats(t), rel=1e-9)


def test_probabilities_sum_to_one(frame):
    model = kn.train(frame([(t,) for t in TRUSTED], "text string"))
    context = int.from_bytes(b"the ", "big") << 8
    every = frame([(context + b,) for b in range(256)], "gram long")
    assert sum(math.exp(r.logp) for r in kn.log_probabilities(every, model).collect()) == pytest.approx(1.0)


def test_judge(spark, frame):
    good = [(i, TRUSTED[i % 16] + f" {i % 7}", "en") for i in range(120)] + [(i, "größe und höhe der", "de") for i in range(120, 130)]
    rest = [(200, "@@@@ #### $$$$ %%%% ^^^^ &&&&", "en"), (201, "the cat sat on the log", None), (202, None, "en"), (203, "", None), (None, "the cat", "en"),
            (200, "@@@@ #### $$$$ %%%% ^^^^ &&&&", "en")]
    docs = frame([(*r, "x", "y") for r in good + rest], "doc_id long, text string, lang string, kept string, trusted string")
    labels = frame([(i, 1) for i in range(130)] + [(200, 0), (None, 1), (5, 1)], "doc_id long, quality int")
    got = kn.judge(docs, labels, F.expr("quality = 1")).collect()
    assert len(got) == len(good + rest)
    by = {r.doc_id: r for r in got}
    assert all(by[i].kept for i in range(130)) and not by[200].kept and by[201].kept and by[None].kept
    assert not by[202].kept and by[202].perplexity is None and not by[203].kept


def test_nothing_trusted_and_empty_table(spark, frame):
    docs = frame([(1, "some text", "en"), (2, None, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = {r.doc_id: r for r in kn.judge(docs, labels, F.expr("quality = 1")).collect()}
    assert got[1].kept and got[1].perplexity == pytest.approx(256) and got[1].threshold is None and not got[2].kept
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert kn.judge(none, labels, F.expr("quality = 1")).collect() == []


def test_quality_labels_are_told_apart(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = kn.judge(docs, labels, F.expr("quality = 1 AND toxic = 0")).join(labels, "doc_id").collect()
    good = [r for r in got if r.quality == 1]
    bad = [r for r in got if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.97 * len(good) and sum(r.kept for r in bad) <= 0.35 * len(bad)
