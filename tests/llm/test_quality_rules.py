import re

from orderlens.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    n = len(words)
    base = n < 10 or 100 * len(covered) > 20 * n
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), base)


TEXTS = [
    None, "", "   \n\t ", "one", "a b c d e a b c d e", "the end of the day is the end of the day is the end",
    "x " * 40, "a b c d e f g h i j k\na b\na b\n\n", "\x0bword\x0cword\rword ünï 漢字 🎉", "## ** $$ && || << >> %% the of and to",
    "la la la la la la la la la", "w1 w2 w3 w4 w5 w6 w1 w2 w3 w4 w5 w7 w8 w9 w10 w11 w12 w13 w14 w15 w16 w17",
    " ".join(f"word{i}" for i in range(30_000)),
]


def test_counts_match_brute_force(frame):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "one"), (None, "a b c d e f g h i j k")]
    got = q.score(frame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    want = sorted((i if i is not None else -1, *brute(t)) for i, t in rows)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((r.doc_id if r.doc_id is not None else -1, *(r[c] for c in names)) for r in got) == want


def test_real_documents_match_brute_force(docs):
    some = docs.collect()
    got = {r.doc_id: r for r in q.score(docs).collect()}
    for r in some:
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == brute(r.text)


def test_rules_are_judged_by_whole_numbers(frame):
    plain = "the cat and the dog sat on a mat in the house of a friend by the sea with 1 2 3 4 5 6 7 8 9"
    cases = {
        "plain": (plain, []),
        "symbols": (plain + " ### ###", ["symbols"]),
        "short words": (" ".join(chr(97 + i % 26) for i in range(20)) + " " + " ".join("bcdfghjklm"), ["words_too_short"]),
        "no stop words": (" ".join(f"word{i}" for i in range(40)), ["stop_words"]),
    }
    rows = [(k, v[0]) for k, v in cases.items()]
    got = {r.doc_id: r for r in q.score(frame(rows, "doc_id string, text string")).collect()}
    for name, (_, failed) in cases.items():
        assert set(failed) <= set(got[name].failed), name
        assert got[name].kept == (not got[name].failed and not got[name].base_failed)
    assert got["plain"].kept


FINNISH = (
    "Vanha kalastaja istui aamulla laiturilla ja korjasi verkkojaan kun aurinko nousi hitaasti metsän yläpuolelle. Hänen "
    "poikansa keitti kahvia mökin pihalla ja lauloi hiljaa laulua jonka isoäiti oli opettanut hänelle monta vuotta aikaisemmin"
)
ITALIAN = (
    "IL VECCHIO PESCATORE SEDEVA LA MATTINA PRESTO SUL MOLO E RIPARAVA LE RETI MENTRE IL SOLE SALIVA LENTAMENTE SOPRA IL BOSCO "
    "E SUO FIGLIO PREPARAVA UN CAFFÈ NEL CORTILE DELLA CASA CANTANDO UNA CANZONE"
)


def test_stop_words_of_other_languages_and_in_capitals(frame):
    rows = [(1, FINNISH, "fi"), (2, ITALIAN, "it"), (3, ITALIAN, None), (4, FINNISH, "en"), (5, ITALIAN.lower(), "es")]
    got = {r.doc_id: (r.kept, r.failed) for r in q.score(frame(rows, "doc_id long, text string, lang string")).collect()}
    assert {i: k for i, (k, _) in got.items()} == {1: True, 2: True, 3: True, 4: False, 5: True}
    assert got[4][1] == ["stop_words"]
    assert {r.doc_id for r in q.keep_good(frame(rows, "doc_id long, text string, lang string")).collect()} == {1, 2, 3, 5}


def test_clashing_columns_and_filters(frame):
    rows = [(1, "the cat and the dog sat on a mat in the house", "mine", 7, "w")]
    df = frame(rows, "doc_id long, text string, kept string, n_words int, words string")
    out = q.score(df)
    assert out.columns.count("kept") == 1 and dict(out.dtypes)["kept"] == "boolean"
    assert out.filter("kept").count() == 1
    kept = q.keep_good(df)
    assert kept.columns == df.columns and kept.collect()[0].kept == "mine"


def test_empty_table_and_native_plan(spark, frame):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert q.score(empty).collect() == [] and q.keep_good(empty).collect() == []
    plan = q.score(frame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
