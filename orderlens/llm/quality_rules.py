"""Quality rules: a threshold table compiled into one Spark projection.

Words are the runs ``[^\\x20\\x09-\\x0D]+`` of the text. Base counts:

- ``n_words``, ``word_chars`` (code points inside words),
- ``n_symbols``: characters of ``#*$%&|<>``,
- ``n_dup_lines``: \\n-split lines with a word that equal an earlier line,
- ``n_repeat_words``: words inside 5-word windows found twice or more in the text,
- ``n_lines`` (lines with a word) and ``n_stop_words``.

A rule compares ``factor * count`` with ``limit * base`` in whole numbers, so that
no verdict hangs on rounding. ``base_failed`` holds for fewer than 10 words or more
than 20 % repeated words; ``kept`` needs the base and every rule of the table.

Edge cases: a null or empty text has no words and fails the base; a null language is
an unknown one, a null in any other column does not matter; equal rows get equal verdicts; very long texts are
one row and are scanned whole; the empty table gives no rows. Input columns named
like a result are replaced by the result.

Only Spark's built-in functions: no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import as_text, packed, quoted

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Separators of words, symbol characters, frequent function words of
# the corpus languages (English, German, French, Spanish).
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "auf das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "au aux dans de des du en est et il la le les par pas pour que qui sur un une "
    "al con del el las lo los no para por se su una y"
).split()
STOP_LANGUAGES = ("en", "de", "fr", "es")

#: Stop words as they stand in texts: in lower case, capitalised or in capitals.
STOP_FORMS = sorted({form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())})


@dataclass(frozen=True)
class Rule:
    """Fails when ``factor * count`` is above (or, for ``least``, below) ``limit * base``,
    in texts of ``from_words`` words or more (a ratio over a few words says little). A
    rule for some ``languages`` does not judge texts that are said to be in another one."""

    name: str
    count: str
    factor: int
    limit: int
    base: str
    least: bool = False
    from_words: int = 0
    languages: tuple[str, ...] = ()


#: Length, symbol, stop-word and line ratios.
RULES = (
    Rule("words_too_short", "word_chars", 1, 2, "n_words", least=True),
    Rule("words_too_long", "word_chars", 1, 15, "n_words"),
    Rule("symbols", "n_symbols", 10, 1, "n_words"),
    Rule("stop_words", "n_stop_words", 50, 1, "n_words", least=True, from_words=20, languages=STOP_LANGUAGES),
    Rule("duplicate_lines", "n_dup_lines", 2, 1, "n_lines"),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")


def compiled(rules: tuple[Rule, ...], lang: Column | None = None) -> dict[str, Column]:
    """One boolean column per rule of the table: true where the rule fails. ``lang``: the
    texts' language, if it is known."""
    out = {}
    for r in rules:
        left, right = F.col(r.count) * F.lit(r.factor), F.col(r.base) * F.lit(r.limit)
        out[r.name] = ((left < right) if r.least else (left > right)) & (F.col("n_words") >= r.from_words)
        if r.languages and lang is not None:
            out[r.name] = out[r.name] & F.coalesce(lang.isin(*r.languages), F.lit(True))
    return out


def _word_arrays(rows: DataFrame) -> DataFrame:
    """text, its words and its lines that have a word."""
    bare = F.btrim(F.col("text"), F.lit(SPACES))
    return rows.withColumn(
        "words", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t-\\r]+"))
    ).withColumn("lines", F.filter(F.split(F.col("text"), "\n"), lambda x: x.rlike("[^ \\t-\\r]")))


def _repeated_words(rows: DataFrame) -> DataFrame:
    """n_repeat_words. Window hashes first: a text whose window hashes are all
    different (nearly every one) repeats nothing; the others compare the windows."""
    n = F.size("words")
    starts = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))

    def window(i: Column) -> list[Column]:
        return [F.get("words", i + k) for k in range(WINDOW)]

    rows = rows.withColumn("hashes", F.transform(starts, lambda i: F.xxhash64(*window(i))))
    rows = rows.withColumn("any_repeat", F.size(F.array_distinct("hashes")) < F.size("hashes"))
    rows = rows.withColumn(
        "sorted",
        F.when(
            F.col("any_repeat"),
            F.sort_array(F.transform(starts, lambda i: F.struct(F.concat_ws(" ", *window(i)).alias("w"), i.alias("i")))),
        ),
    )
    last = F.size("sorted") - 1

    def at(i: Column) -> Column:
        return F.get("sorted", i)["w"]

    repeated = F.filter(
        F.sequence(F.lit(0), last), lambda k: F.coalesce(at(k) == at(k - 1), F.lit(False)) | F.coalesce(at(k) == at(k + 1), F.lit(False))
    )
    rows = rows.withColumn(
        "starts",
        F.when(F.col("any_repeat"), F.sort_array(F.transform(repeated, lambda k: F.get("sorted", k)["i"]))).otherwise(
            F.array().cast("array<int>")
        ),
    )
    # each start covers its window up to the next start
    covered = F.zip_with(
        F.col("starts"),
        F.slice(F.col("starts"), 2, F.greatest(F.size("starts"), F.lit(1))),
        lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    return rows.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0))))


def score(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, lang_col: str = "lang") -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``failed`` (names of failed rules)
    and ``kept``. ``lang_col``: the column with the texts' language, if there is one; the
    stop-word rule judges texts in its languages and those in an unknown one."""
    rows = packed(docs).withColumn("text", as_text(F.col("row").getField(text_col)))
    rows = _repeated_words(_word_arrays(rows))
    counted = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.regexp_replace("text", "[ \\t-\\r]+", "")),
        "n_symbols": F.length(F.regexp_replace("text", "[^" + SYMBOLS + "]+", "")),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.col("n_repeat_words"),
        "n_lines": F.size("lines"),
        "n_stop_words": F.size(F.filter("words", lambda w: w.isin(*STOP_FORMS))),
    }
    # inline() of one struct: a caller's filter on a result stays above this node, so
    # that the optimizer does not copy the counting expressions into the filter
    counts = rows.select("row", F.inline(F.array(F.struct(*[c.cast("long").alias(n) for n, c in counted.items()]))))
    lang = F.col("row").getField(lang_col).cast("string") if lang_col in docs.columns else None
    fails = compiled(rules, lang)
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in fails.items()]))
    results = {c: F.col(c) for c in COUNTS} | {"base_failed": base, "failed": failed, "kept": ~base & (F.size(failed) == 0)}
    taken = set(results)
    return counts.select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in taken],
        *[c.alias(name) for name, c in results.items()],
    )


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` whose text passes, with their columns as they were."""
    probe = "__quality_verdict"
    verdict = score(docs.select("*", quoted(text_col).alias(probe + "_text"), F.struct("*").alias(probe + "_row")),
                    probe + "_text", rules)
    return verdict.filter("kept").select(probe + "_row.*")
