import re

import numpy as np
import pytest
import xxhash

from orderlens.llm import simhash as sh
from orderlens.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values, bits=4):
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def check(rows, got):
    """Fingerprints and components of (id, text) rows, null ids as one beyond all."""
    values = [brute_print(t) for _, t in rows]
    roots = brute_components(values)
    name = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            name[r] = min(i, name.get(r, i))
    want = sorted((-1 if i is None else i, f"{v:016x}", name.get(r, -1)) for (i, _), v, r in zip(rows, values, roots))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, -1 if r.component_id is None else r.component_id) for r in got) == want


def test_edge_cases(frame):
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    rows = [
        (5, None), (3, ""), (9, " \t\n"), (4, "one"), (1, "ONE"), (2, "a b c"), (2, "a b c"), (None, "x y z q"), (7, "Ünï cödé wörds hére now"),
        (8, long), (6, long + " w1"), (None, "one"),
    ]
    check(rows, sh.near_duplicates(frame(rows, "doc_id long, text string")).collect())


def test_real_documents(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(rows, sh.near_duplicates(docs).collect())


@pytest.mark.parametrize("limit", [sh.GROUP_LIMIT, 10])
def test_links_connect_like_all_pairs(spark, limit):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.integers(0, 64, 3)) for b in base for _ in range(6)]
    values = sorted({*map(int, base), *near})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(3)
    edges = sh.links(fps, group_limit=limit).collect()
    assert all((e.u ^ e.v) & (2**64 - 1) != 0 for e in edges)
    got = {v: v for v in signed}

    def find(v):
        while got[v] != v:
            v = got[v]
        return v

    for e in edges:
        a, b = find(e.u), find(e.v)
        got[max(a, b)] = min(a, b)
    roots = brute_components(values)
    groups = {}
    for v, r in zip(signed, roots):
        groups.setdefault(r, set()).add(find(v))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_trie_join_gives_every_pair():
    rng = np.random.default_rng(3)
    for bits in (0, 2, 4):
        groups = np.sort(rng.integers(0, 5, 400))
        values = rng.integers(0, 2**12, 400, dtype=np.uint64) * np.uint64(0x0010000000100001)
        order = np.lexsort((values, groups))
        values, groups = values[order], groups[order]
        got = sorted((int(i), int(j)) for a, b in sh.trie_self_join(values, groups, bits) for i, j in zip(a, b))
        want = [(i, j) for i in range(400) for j in range(i + 1, 400) if groups[i] == groups[j] and int(values[i] ^ values[j]).bit_count() <= bits]
        assert got == want


def test_more_blocks_for_more_rows():
    for rows, blocks in ((1000, 5), (1 << 30, 6), (1 << 36, 7)):
        assert sh.block_choices(rows)[0] == blocks
    for rows in (1, 1 << 30):
        n, masks = sh.block_choices(rows)
        assert all(m.bit_count() >= 64 * (n - 4) // n - 4 for m in masks)


def test_keep_one(spark, frame):
    text = "some text of a document that is long enough to count as one"
    rows = [(4, text, "a"), (2, text, "b"), (2, text, "c"), (9, "another thing altogether written here", "d"), (None, "only a null id has this text", "e"),
            (None, "only a null id has this text", "f"), (7, None, "g"), (6, "", "h")]
    df = frame(rows, "doc_id long, text string, component_id string")
    got = sh.keep_one(df)
    assert got.columns == df.columns
    found = sorted((r.doc_id or -1, r.text or "") for r in got.collect())
    assert found == sorted([(2, text), (9, rows[3][1]), (-1, rows[4][1]), (6, "")])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sh.keep_one(empty).collect() == [] and sh.near_duplicates(empty).collect() == []


def test_components_of_chains_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 5), (7, 3), (3, 7), (3, 1)]
    got = {r.u: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 100 for i in range(101, 161)) and got[7] == 1 and got[3] == 1 and 5 not in got
