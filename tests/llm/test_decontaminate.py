import hashlib
import re

import pytest

from orderlens.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def windows(items):
    out = {}
    for item, text in items:
        w = words(text)
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            out.setdefault(tuple(w[i : i + size]), set()).update([] if item is None else [str(item)])
    return out


def brute(text, wins):
    w = words(text)
    hit, items = set(), set()
    for size in {len(k) for k in wins}:
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in wins:
                hit.update(range(i, i + size))
                items |= wins[tuple(w[i : i + size])]
    sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return len(w), len(hit), len(items), sha, bool(hit) and 20 * len(hit) >= len(w)


PASSAGE = "Alpha beta, gamma delta epsilon; zeta eta theta iota kappa lambda mu nu xi omicron"
ITEMS = [(1, PASSAGE), (10, PASSAGE), (2, "short item Größe"), (3, None), (4, ""), (5, "--- !!"), (None, "nameless words here"), (1, PASSAGE)]
DOCS = [
    (1, PASSAGE.upper()), (2, "x " * 500 + PASSAGE), (3, "a short-item größe b"), (4, "a short item GRÖSSE b"), (5, None), (6, ""),
    (7, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (8, "the nameless words here"), (8, "the nameless words here"),
    (9, "beta\x00gamma alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"), (None, "short item größe " * 3),
    (11, "y " * 200_000 + "short item größe"),
]
RESULT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("block_chars", [dc.BLOCK_CHARS, 20])
def test_scan_matches_brute_force(frame, block_chars):
    wins = windows(ITEMS)
    got = dc.scan(frame(DOCS, "doc_id long, text string"), frame(ITEMS, "item_id long, text string"), block_chars=block_chars)
    rows = sorted((r.doc_id or -1, *(r[c] for c in RESULT)) for r in got.collect())
    assert rows == sorted((i or -1, *brute(t, wins)) for i, t in DOCS)


def test_real_tables_match_brute_force(spark, sf, docs):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    wins = windows([(r.item_id, r.text) for r in bench.collect()])
    got = {r.doc_id: r for r in dc.scan(docs, bench).collect()}
    for r in docs.collect():
        assert tuple(got[r.doc_id][c] for c in RESULT) == brute(r.text, wins)


def test_modes_and_clashing_columns(frame):
    df = frame([(1, PASSAGE + " tail", "x", "y"), (2, "clean text", "x", "y"), (3, None, None, None)], "doc_id long, text string, n_hit string, hits string")
    bench = frame(ITEMS, "item_id long, text string")
    assert dict(dc.scan(df, bench).dtypes)["n_hit"] == "bigint"
    left = dc.decontaminate(df, bench)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [2, 3]
    cut = {r.doc_id: r for r in dc.decontaminate(df, bench, "spans").collect()}
    assert cut[1].text.strip() == "tail" and cut[2].text == "clean text" and cut[3].text is None and cut[1].n_hit == "x"
    with pytest.raises(ValueError):
        dc.decontaminate(df, bench, "words")


def test_empty_tables(spark, frame):
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dc.scan(none, frame(ITEMS, "item_id long, text string")).collect() == []
    got = dc.scan(frame(DOCS, "doc_id long, text string"), bench).collect()
    assert len(got) == len(DOCS) and not any(r.contaminated for r in got)
