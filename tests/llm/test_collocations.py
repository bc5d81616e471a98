import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from orderlens.llm import collocations as co
from orderlens.llm import gram_counts as gc
from orderlens.llm import queries


def brute(rows, least=30, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        drop = set()
        for p, a in cand.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    sub = p[i : i + size]
                    if 100 * a >= 80 * cand[sub]:
                        drop.add(sub)
        found = []
        for p, a in cand.items():
            if p in drop:
                continue
            score, _, left, right = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (s, a, p, left, right) in enumerate(sorted(found)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def corpus(seed, docs, hot=False):
    rng = random.Random(seed)
    rows = []
    vocab = [f"w{i}" for i in range(60)] + ["État", "Ünder", "naïve", "日本", "𝒳"]
    phrases = [rng.sample(vocab, rng.randrange(2, 7)) for _ in range(12)]
    for i in range(docs):
        words = []
        for _ in range(rng.randrange(30)):
            words += rng.choice(phrases) if rng.random() < 0.4 else [rng.choice(vocab)]
            if rng.random() < 0.1:
                words.append(rng.choice([". Then", ", and", "x;y", "\tEnd\n", "?!", "a.b"]))
        if hot:
            words += ["of", "the", rng.choice(vocab), rng.choice(vocab)] * 5
        rows.append((rng.choice(["en", "en", "de", None, ""]), " ".join(words)))
    return rows + [("en", None), ("fr", ""), (None, " \t"), ("de", "solo"), ("en", "A\x0bb\x0cc " * 40), ("xx", "ha " * 200)] + rows[:30]


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_against_brute_force(frame):
    rows = corpus(1, 1500)
    out = co.collocations(frame(rows, "lang string, text string"))
    assert [t for _, t in out.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    want = brute(rows)
    assert got(out) == want and len(want) > 100


def test_hot_pairs_top_and_many_buckets(frame, monkeypatch):
    rows = corpus(2, 400, hot=True)
    monkeypatch.setattr(co, "HOT", 30)
    monkeypatch.setattr(co, "TOP", 25)
    monkeypatch.setattr(co, "HELD", 500)
    monkeypatch.setattr(gc, "HELD", 500)
    monkeypatch.setattr(gc, "BUCKET_ENTRIES", 1 << 11)
    assert got(co.collocations(frame(rows, "lang string, text string", parts=6))) == brute(rows, top=25)


def test_multikey_sort_counts_every_phrase():
    rng = np.random.default_rng(4)
    rows = rng.integers(1, 5, (4, 3000)).astype(np.uint64)
    rows[3, rng.random(3000) < 0.3] = 0
    rows[2:, rng.random(3000) < 0.2] = 0
    weight = rng.integers(1, 4, 3000)
    want = Counter()
    for column, n in zip(rows.T.tolist(), weight.tolist()):
        for size in range(2, 5):
            if column[size - 1]:
                want[tuple(column[:size])] += n
    for least, whole_from in ((1, 2), (40, 2), (40, 4)):
        have = {}
        for pointer, words, a in co.multikey_sort(rows, weight, least, whole_from):
            have.update({tuple(rows[:words, p].tolist()): n for p, n in zip(pointer, a.tolist())})
        keep = {p: n for p, n in want.items() if n >= least or len(p) < whole_from}
        assert {p: n for p, n in have.items() if n >= least} == {p: n for p, n in want.items() if n >= least}
        assert keep.items() <= have.items() if whole_from == 4 else have == keep


def test_large_counts_stay_exact(spark):
    a = 2**52 + 1
    phrases = spark.createDataFrame([(1, 2, 0, 0, a)], "w1 long, w2 long, w3 long, w4 long, a long")
    words = spark.createDataFrame([(1, a + 5), (2, a + 12)], "w long, n long")
    row = co._scored(phrases, words).first()
    assert row.score == 2_000_000 * a // (2 * a + 17)


def test_empty_tables_and_extra_columns(spark, frame):
    assert co.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
    rows = [("new york is big", "en", 5, "x")] * 40
    out = co.collocations(frame(rows, "text string, lang string, a int, w1 string"))
    assert [tuple(r) for r in out.collect()] == [("en", 1, "new york is big", 40, 40, 40, 160, 1_000_000)]


def test_query(spark, tmp_path):
    rows = corpus(3, 150)
    spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(rows)], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    assert got(queries.op11_collocations(spark, str(tmp_path))) == brute(rows)
