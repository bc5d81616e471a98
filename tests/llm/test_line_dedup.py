import random

import pytest

from orderlens.llm import line_dedup as ld


def tokens(line):
    return frozenset("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line).replace("\x0b", " ").replace("\x0c", " ").split(" ")) - {""}


def lines_of(text):
    return (text or "").split("\n")


def brute(rows):
    """Removed line numbers by (id, text); repeated rows are one document."""
    seen = []
    for i, t in dict.fromkeys(rows):
        for k, x in enumerate(lines_of(t)):
            w = tokens(x.replace("\t", " ").replace("\r", " "))
            if w:
                seen.append(((i is None, i or 0, k), (i, t), k, w))
    seen.sort(key=lambda s: s[0])
    gone = {key: set() for _, key, _, _ in seen}
    for n, (_, key, k, w) in enumerate(seen):
        if any(9 * len(w & v) >= 4 * (len(w) + len(v)) for _, _, _, v in seen[:n]):
            gone[key].add(k)
    return gone


def rebuilt(text, gone):
    if not gone:
        return text
    lines = lines_of(text)
    left = [x for i, x in enumerate(lines) if i not in gone]
    return "\n".join(left) if any(x.strip() for x in left) else ""


def check(rows, got):
    gone = brute(rows)
    want = sorted((str(i), rebuilt(t, gone.get((i, t), set())) or "", len(gone.get((i, t), ()))) for i, t in rows)
    assert sorted((str(r.doc_id), r.text or "", r.n_removed) for r in got) == want


@pytest.fixture(scope="module")
def noisy():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "a"] * 40
    base = [[rng.choice(vocabulary) for _ in range(rng.choice((1, 2, 3, 4, 5, 6, 9, 12, 20, 40, 90)))] for _ in range(120)]
    rows = []
    for i in range(90):
        out = []
        for _ in range(rng.randint(0, 9)):
            w = list(rng.choice(base))
            for _ in range(rng.choice((0, 0, 1, 2, 4))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rng.shuffle(w) if rng.random() < 0.2 else None
            out.append(rng.choice(("  ", "")) + (" " * rng.randint(1, 2)).join(x.upper() if rng.random() < 0.1 else x for x in w))
        rows.append((i, "\n".join(out)))
    return rows


@pytest.mark.parametrize("partners, limit", [(ld.PARTNERS, ld.GROUP_LIMIT), (1, 6)])
def test_matches_brute_force(frame, noisy, monkeypatch, partners, limit):
    """Also with short candidate lists and every token in chunks."""
    monkeypatch.setattr(ld, "PARTNERS", partners)
    monkeypatch.setattr(ld, "GROUP_LIMIT", limit)
    check(noisy, ld.dedup_lines(frame(noisy, "doc_id long, text string")).collect())


def test_edge_cases(frame):
    long = " ".join(f"t{i}" for i in range(20_000))
    rows = [
        (1, None), (2, ""), (3, "\n\n"), (4, " \t \n same line here\n\nother words stand here now"), (5, "SAME line here"), (5, "SAME line here"),
        (6, "same line here\n\n"), (7, long), (8, long + " more"), (None, "a null id has its own line\nsame  line here"), (9, "one"), (10, "one\x0cone\none two"),
    ]
    check(rows, ld.dedup_lines(frame(rows, "doc_id long, text string")).collect())


def test_removed_lines_and_clashing_columns(spark, frame):
    rows = [(1, "a b c d e", "x"), (2, "fresh text\na b c d e", "y"), (3, None, "z")]
    df = frame(rows, "doc_id long, text string, n_lines string")
    got = {r.doc_id: r for r in ld.removed_lines(df).collect()}
    assert got[1].removed == [] and got[2].removed == [1] and got[2].n_lines == 2 and got[3].n_lines == 0
    out = ld.dedup_lines(df)
    assert dict(out.dtypes)["n_lines"] == "bigint" and {r.doc_id: r.text for r in out.collect()} == {1: "a b c d e", 2: "fresh text", 3: None}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ld.dedup_lines(empty).collect() == [] and ld.removed_lines(empty).collect() == []


def test_rows_without_an_id_are_different_documents(frame):
    text = "a line that many rows hold\nand a second line of theirs"
    rows = [(None, text)] * 5 + [(None, "other words\nmore\nAND a second line of theirs"), (None, None), (1, "a line with an id"), (None, "a line with an id")]
    df = frame(rows, "doc_id long, text string")
    out = sorted(((r.doc_id, r.text, r.n_removed) for r in ld.dedup_lines(df).collect()), key=str)
    want = [(None, text, 0)] + [(None, "", 2)] * 4 + [(None, "other words\nmore", 1), (None, None, 0), (1, "a line with an id", 0), (None, "", 1)]
    assert out == sorted(want, key=str)
    gone = sorted(tuple(r.removed) for r in ld.removed_lines(df).collect())
    assert gone == [(), (), (), (0,), *[(0, 1)] * 4, (2,)]


def test_real_documents(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(rows, ld.dedup_lines(docs).collect())


def test_long_words_that_a_polynomial_takes_for_equal(frame):
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    rows = [(1, word), (2, word.translate(str.maketrans("ab", "ba")))]
    assert all(r.n_removed == 0 for r in ld.dedup_lines(frame(rows, "doc_id long, text string")).collect())


def test_ids_of_other_types(frame):
    rows = [("a10", "one two three\nx"), ("a2", "one two three\ny"), ("B", "one two three"), (None, "one two three"), (None, "x")]
    out = ld.removed_lines(frame(rows, "doc_id string, text string"))
    assert dict(out.dtypes)["doc_id"] == "string"
    got = sorted((str(r.doc_id), r.n_lines, sorted(r.removed)) for r in out.collect())
    assert got == [("B", 1, []), ("None", 1, [0]), ("None", 1, [0]), ("a10", 2, [0]), ("a2", 2, [0])]
    kept = {r.doc_id: r.text for r in ld.dedup_lines(frame(rows[:3], "doc_id string, text string")).collect()}
    assert kept == {"B": "one two three", "a10": "x", "a2": "y"}


def test_entries_travel_in_blocks(frame, noisy, monkeypatch):
    """The blocks hold the entries, each key in one bucket, many entries a row; candidates do
    not depend on how many buckets are searched at once."""
    import numpy as np
    import pyarrow as pa
    from pyspark.sql import functions as F

    texts = frame(noisy, "id long, text string").withColumn("h", F.xxhash64("text"))
    lines = ld.stored(ld.distinct_lines(texts, ld.token_counts(texts)))
    chunks = np.full(1 << ld.SKETCH_BITS, 1, np.int32)
    chunks[::3] = 3
    want = sorted(tuple(r) for r in ld.prefix_entries(lines, chunks).collect())
    rows = ld.entry_blocks(lines, chunks, 4).orderBy("bucket").collect()
    blocks = [np.frombuffer(r.entries, ld._PACKED) for r in rows]
    assert sorted(tuple(e) for b in blocks for e in b.tolist()) == want
    tasks = lines.rdd.getNumPartitions()
    assert max(map(len, blocks)) <= ld.BLOCK and len(rows) <= len(want) / ld.BLOCK + 4 * tasks
    bucket_of = {}
    assert all(bucket_of.setdefault(k, r.bucket) == r.bucket for r, b in zip(rows, blocks) for k in b["key"].tolist())

    def found(at_once, size):
        monkeypatch.setattr(ld, "AT_ONCE", at_once)
        batches = [pa.RecordBatch.from_pylist([{"bucket": r.bucket, "entries": bytes(r.entries)} for r in rows[i : i + size]]) for i in range(0, len(rows), size)]
        out = pa.Table.from_batches(list(ld._partners(iter(batches))))
        return set(zip(out["y"].to_pylist(), out["x"].to_pylist()))

    monkeypatch.setattr(ld, "PARTNERS", 10**6)
    assert found(1, 1) == found(10**9, 10**6) == {(r.y, r.x) for r in ld.all_candidates(lines, chunks, lines.select(F.col("k1").alias("y"))).collect()}
