"""The pipeline's stages against brute-force versions, each on its own input."""

import hashlib

import public_tokenizers
import pytest
import test_decontaminate
import test_line_dedup
import test_quality_rules
import test_simhash
import tiktoken

import corpus_pipeline
from orderlens.llm import byte_bpe

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf, docs, tmp_path_factory):
    """(input, output) rows of each stage, written and read between them."""
    out, path = [], tmp_path_factory.mktemp("stages")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{path}/{k}")
        after = spark.read.parquet(f"{path}/{k}")
        out.append((docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def test_quality_stage(stages):
    before, after, columns = stages[0]
    kept = {r.doc_id for r in after}
    assert columns == COLUMNS and kept < {r.doc_id for r in before}
    assert all(r.doc_id not in kept for r in before if test_quality_rules.brute(r.text)[-1])


def test_line_stage(stages):
    before, after, columns = stages[1]
    gone = test_line_dedup.brute([(r.doc_id, r.text) for r in before])
    assert columns == COLUMNS
    assert sorted((r.doc_id, r.text) for r in after) == sorted((r.doc_id, test_line_dedup.rebuilt(r.text, gone.get((r.doc_id, r.text)))) for r in before)


def test_near_duplicate_stage(stages):
    before, after, columns = stages[2]
    rows = sorted((r.doc_id, r.text) for r in before)
    roots = test_simhash.brute_components([test_simhash.brute_print(t) for _, t in rows])
    assert columns == COLUMNS
    assert sorted(r.doc_id for r in after) == [i for k, (i, _) in enumerate(rows) if roots[k] == k]


def test_benchmark_stage(spark, sf, stages):
    before, after, columns = stages[3]
    wins = test_decontaminate.windows([(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    assert columns == COLUMNS
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if not test_decontaminate.brute(r.text, wins)[-1])


def test_token_stage(stages):
    before, after, _ = stages[4]
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.VOCABULARY))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in after}
    assert len(after) == len(before)
    for r in before:
        ids = enc.encode_ordinary(r.text or "")
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_run_equals_the_stages(spark, sf, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, stages[-1][1]))


def test_stages_take_empty_repeated_and_clashing_rows(spark, sf, frame):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    text = "the cat and the dog sat on a mat in the house of a friend"
    odd = frame([(1, text, None, None, None, "a"), (1, text, None, None, None, "a"), (None, text, "en", "s", 5, "b"), (2, None, "en", "s", 0, "c")],
                "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, sf).collect() == []
        odd = stage(spark, odd, sf)
        assert odd.columns[-1] == "kept"
    # the null id comes last in line dedup, so its copied text goes and the row stays
    assert sorted((str(r.doc_id), r.text, r.kept) for r in odd.collect()) == [("1", text, "a"), ("None", "", "b")]
