import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from orderlens.llm import periodic_runs as pr
from orderlens.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    out = []
    n = len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            part = words[i : i + length]
            if length >= max(24, 3 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts():
    rng = random.Random(5)
    out = [None, "", " \t\n", "a", "a " * 23, "a " * 24, "A\x0ba\n" * 12, ("x y " * 12).strip()]
    for alphabet in (1, 2, 3, 30):
        for _ in range(40):
            words = [f"w{rng.randrange(alphabet)}" for _ in range(rng.randrange(20, 60))]
            for _ in range(rng.randrange(4)):
                at, p, turns = rng.randrange(len(words)), rng.randrange(1, 40), rng.randrange(2, 6)
                words[at:at] = (words[at : at + p] * turns)[rng.randrange(3) :]
            out.append(" ".join(words))
    # a period whose every long gram occurs twice within it
    a, b = [f"a{i}" for i in range(17)], [f"b{i}" for i in range(18)]
    block = a + a + a + b + b + b + a + b
    out += [" ".join(block * 3), " ".join((block * 4)[5:-7]), " ".join(["q"] + block * 3 + a * 3 + ["z"] * 40)]
    # nested: runs within the turns of a longer run, and runs that overlap
    turn = ["r"] * 30 + ["s", "t"] * 15 + ["u"]
    out.append(" ".join(turn * 3 + turn[:40]))
    out.append(" ".join(["m", "n", "o"] * 9 + ["m", "n"] * 13))
    # words of bytes that a polynomial hash takes for equal
    tm = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    out.append(" ".join([tm, tm.translate(str.maketrans("ab", "ba"))] * 15))
    return out


@pytest.fixture(scope="module")
def cases():
    return list(enumerate(texts()))


def test_runs_and_collapsed_text(frame, cases):
    rows = cases + [(None, "k l " * 20), (3, cases[3][1])]
    got = pr.periodic_runs(frame(rows, "doc_id long, text string"))
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect())
    want = []
    for i, t in rows:
        words = WORD.findall(t or "")
        runs = brute_runs(words)
        want.append((-1 if i is None else i, len(words), runs, brute_collapsed(words, runs)))
    assert found == sorted(want)
    assert any(len(r) > 1 for _, _, r, _ in found)


def test_a_long_text(frame):
    words = (["p", "q", "r"] * 40_000) + [str(i) for i in range(50_000)] + ([str(i) for i in range(9_000)] * 4)[:-5]
    row = pr.periodic_runs(frame([(1, "\n".join(words))], "doc_id long, text string", parts=1)).first()
    # the numbers 0 to 8999 follow themselves, so the last run is 4 turns less 5 words
    assert [tuple(r) for r in row.runs] == [(0, 120_000, 3), (170_000, 35_995, 9_000)]
    assert row.n_words == 205_995 and len(row.collapsed.split()) == 3 + 50_000 + 9_000


def test_no_gram_occurs_twice(frame):
    rows = pr.periodic_runs(frame([(1, " ".join(map(str, range(40)))), (2, "a " * 16 + "b")], "doc_id long, text string", parts=2)).collect()
    assert [(r.n_words, r.runs) for r in sorted(rows)] == [(40, []), (17, [])]


def test_empty_table_extra_and_clashing_columns(frame, spark):
    assert pr.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    row = pr.periodic_runs(frame([("z " * 24, 5, "old", 7)], "text string, Runs int, found string, row int")).first()
    assert [tuple(r) for r in row.runs] == [(0, 24, 1)] and row.found == "old" and row["row"] == 7
    assert set(row.asDict()) == {"text", "found", "row", "n_words", "runs", "collapsed"}


def brute_query(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (len(runs), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(brute_collapsed(words, runs)))


NAMES = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_against_brute_force(spark, tmp_path, cases):
    rows = cases + [(1000 + i, " ".join(f"v{(i * j) % 37}" for j in range(i % 150))) for i in range(400)] + [(None, "e " * 30), (2, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.op12_periodic_runs(spark, str(tmp_path))
    assert dict(out.dtypes)["exponent_milli"] == "bigint" and dict(out.dtypes)["n_runs"] == "bigint"
    got = sorted(((-1 if r.doc_id is None else r.doc_id), *[r[c] for c in NAMES]) for r in out.collect())
    want = sorted(((-1 if i is None else i), *brute_query(i, t)) for i, t in rows)
    assert list(map(str, got)) == list(map(str, want))
