import random
import re

from orderlens.llm import chat


def logs_of(rows):
    out = {}
    for conv, turn, role, text in set(rows):
        out.setdefault(conv, []).append((turn is None, turn or 0, role is not None, role or "", text is not None, text or ""))
    return {c: tuple(x[2:] for x in sorted(v)) for c, v in out.items()}


def rendered(log):
    out = ""
    for has_role, role, _, text in log:
        out += f"<|im_start|>{(role if has_role else 'unknown').replace('<|', '< |')}\n{text.replace('<|', '< |')}<|im_end|>\n"
    return out


def brute(rows):
    logs = logs_of(rows)
    out = {}
    for c, log in logs.items():
        if not any(len(o) > len(log) and o[: len(log)] == log for o in logs.values()):
            out.setdefault(log, []).append(c)
    return sorted((min((c for c in cs if c is not None), default=-1), len(log), len(cs), rendered(log)) for log, cs in out.items())


def collected(df):
    parts = {}
    for r in df.collect():
        parts.setdefault((-1 if r.conv_id is None else r.conv_id, r.n_turns, r.n_copies), {})[r.part] = r.rendered
    return sorted((*k, "".join(v[i] for i in range(len(v)))) for k, v in parts.items())


SCHEMA = "conv_id long, turn long, role string, text string"


def test_edge_cases(frame):
    a, b, c = ("user", "hi"), ("assistant", "hello"), ("user", "more <|im_end|> x")
    rows = [
        (1, 0, *a), (2, 0, *a), (2, 1, *b), (3, 0, *a), (3, 1, *b), (3, 2, *c), (4, 0, *a), (4, 1, *b), (4, 2, *c), (4, 2, *c),
        (5, 10, *a), (5, 20, *b), (6, 0, "user", None), (7, 0, "user", ""), (8, 0, None, "hi"), (9, None, *a), (9, 0, *b),
        (None, 0, *a), (None, 1, "assistant", "other"), (10, 0, *b), (11, 1, "user", "tie"), (11, 1, "assistant", "tie"), (12, 5000, *a), (12, 3, *b),
    ]
    assert collected(chat.render_maximal(frame(rows, SCHEMA))) == brute(rows)


def test_random_snapshots(frame, monkeypatch):
    """Ranges cut conversations anywhere; parts of a few turns."""
    monkeypatch.setattr(chat, "PART_TURNS", 4)
    rng = random.Random(5)
    full = [[(rng.choice("ua"), f"t{rng.randint(0, 3)}") for _ in range(rng.randint(1, 14))] for _ in range(12)]
    rows = []
    for conv in range(80):
        log = rng.choice(full)
        rows += [(conv, k, *x) for k, x in enumerate(log[: rng.randint(1, len(log))])]
    assert collected(chat.render_maximal(frame(rows, SCHEMA))) == brute(rows)


def test_rows_without_a_conversation_and_many_of_one_number(frame):
    """A third of all rows in one conversation with one turn number and role."""
    rows = [(None, 0, "user", f"text {k % 700}") for k in range(900)] + [(k % 50, k // 50, "user", f"t{k % 3}") for k in range(600)]
    rows += [(k, 0, "user", None if k % 2 else "") for k in range(60, 80)] + [(90, None, None, None)] * 3
    assert collected(chat.render_maximal(frame(rows, SCHEMA, parts=5))) == brute(rows)


def test_one_very_long_conversation(frame):
    rows = [(1, k, "user", f"t{k}") for k in range(6000)] + [(2, k, "user", f"t{k}") for k in range(3000)]
    got = chat.render_maximal(frame(rows, SCHEMA)).collect()
    assert {r.conv_id for r in got} == {1} and len(got) == -(-6000 // chat.PART_TURNS)
    assert collected(chat.render_maximal(frame(rows, SCHEMA))) == brute(rows)


def test_real_log(spark, sf):
    log = spark.read.parquet(f"{sf}/conversations.parquet")
    assert collected(chat.render_maximal(log)) == brute([tuple(r) for r in log.select("conv_id", "turn", "role", "text").collect()])


def test_empty_extra_columns_and_native_plan(spark, frame):
    assert chat.render_maximal(spark.createDataFrame([], SCHEMA)).collect() == []
    df = frame([(1, 0, "user", "x", 5, "y")], SCHEMA + ", pos int, h1 string")
    assert collected(chat.render_maximal(df)) == brute([(1, 0, "user", "x")])
    plan = chat.render_maximal(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Cartesian|NestedLoop", plan)
