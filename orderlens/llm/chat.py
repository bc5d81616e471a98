"""Chat formatting of logged conversations, after collapsing cumulative snapshots.

A log holds snapshots: conversations that are a prefix of a longer one, or repeat one.
Turns get the rolling hashes of their prefix: sums of two 64-bit hashes of (position,
role, text), which extend turn by turn. A conversation goes if its hash is that of a
proper prefix of another conversation of any length; of equal conversations the
smallest id stays. Joins are on (length, hash) after aggregation on both sides, so that
a first turn or a conversation that a third of the log shares is one row.

What travels is a turn's number, role and the 128-bit hash of its text. Texts are read for
turns that share number and role with another text (their order is that of the texts), and
for the maximal conversations when they are rendered.

Positions and sums are made in two levels: turns are range-partitioned by conversation and
order, stored, numbered and summed within the segment of a conversation that a partition
holds, and then over segments. So a conversation of very many turns, or with very many
rows of one number, is spread over tasks. Rendered texts come in parts of at most
``PART_TURNS`` turns.

Edge cases: repeated rows (same conversation, turn, role and text) count once; turns
with the same number are ordered by role and text, null turn numbers last; rows with a
null conversation id are one conversation; a null role renders as ``unknown`` and a
null text as nothing, and neither equals an empty one; markers inside texts are broken
up; an empty table gives no rows; extra columns are ignored.

Only DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.membership import key_hash, may_be_in
from orderlens.llm.common import quoted, stored

PART_TURNS = 512

# The markers around a turn.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"

_HASHES = ("h1", "h2")
_TURN = ("conv", "turn", "role", "t1", "t2")


def _rows(log: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, t1, t2, text): the log's rows with the hashes of their texts."""
    rows = log.select(
        quoted(conv).alias("conv"), quoted(turn).cast("long").alias("turn"),
        quoted(role).cast("string").alias("role"), quoted(text).cast("string").alias("text"),
    )
    hashes = [F.xxhash64(F.lit(salt), F.col("text").isNull(), F.col("text")).alias(f"t{salt}") for salt in (1, 2)]
    return rows.select("conv", "turn", "role", *hashes, "text")


def _turns(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, t1, t2, nth, block): the different turns. ``nth`` orders those of
    one number and role by their texts; ``block`` numbers the ranges that the turns, in
    order, are cut into."""
    turns = rows.select(*_TURN).distinct()
    ties = turns.groupBy("conv", "turn", "role").count().filter("count > 1")
    texts = rows.alias("a").join(ties.alias("b"), _same("a", "b", ("conv", "turn", "role")), "left_semi").distinct()
    # few: texts of one number, role and conversation. They are ranked by segments, too
    ranked = _ranked(texts, ["conv", "turn", "role"], [F.col("text").asc_nulls_first()], "nth")
    joined = turns.alias("a").join(ranked.alias("b"), _same("a", "b", _TURN), "left").select(*[f"a.{c}" for c in _TURN], "b.nth")
    ranged = joined.repartitionByRange(F.col("conv").asc_nulls_first(), *_order())
    return stored(ranged.withColumn("block", F.spark_partition_id()))


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("nth").asc_nulls_first()]


def _ranked(rows: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Rows of ``_TURN`` with their rank by ``order`` within ``keys``, from 1, in segments of
    a range partitioning."""
    ranged = rows.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys], *order)
    cut = stored(ranged.withColumn("block", F.spark_partition_id()))
    local = cut.withColumn("local", F.row_number().over(Window.partitionBy(*keys, "block").orderBy(*order)))
    blocks = cut.groupBy(*keys, "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*keys, "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    joined = local.alias("a").join(blocks.alias("b"), _same("a", "b", (*keys, "block")))
    return joined.select(*[f"a.{c}" for c in _TURN], (F.col("a.local") + F.col("b.before")).alias(name))


def _same(left: str, right: str, names: tuple[str, ...]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return cond


def _with_offsets(rows: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """``rows`` with ``before_<name>`` (the total over earlier blocks of the
    conversation) and ``all_<name>`` (over the conversation)."""
    blocks = rows.groupBy("conv", "block").agg(*[c.alias(n) for n, c in totals.items()])
    whole = Window.partitionBy("conv")
    earlier = whole.orderBy(F.col("block").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "conv", "block",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias("before_" + n) for n in totals],
        *[F.sum(n).over(whole).alias("all_" + n) for n in totals],
    )
    joined = rows.alias("a").join(blocks.alias("b"), _same("a", "b", ("conv", "block")))
    return joined.select("a.*", *[F.col(f"b.{p}{n}") for n in totals for p in ("before_", "all_")])


def prefix_hashes(log: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, turns, turn, role, t1, t2, h1, h2): every turn with its position from 1,
    the length of its conversation, the hashes of its text and those of the prefix that
    ends with it."""
    return _prefixes(_rows(log, conv, turn, role, text))


def _prefixes(rows: DataFrame) -> DataFrame:
    turns = _turns(rows)
    inside = Window.partitionBy("conv", "block").orderBy(*_order())
    turns = _with_offsets(turns.withColumn("local", F.row_number().over(inside)), {"n": F.count("*")})
    turns = turns.withColumn("pos", F.col("before_n") + F.col("local"))
    seen = [F.col("pos"), F.col("role").isNull(), F.col("role"), F.col("t1"), F.col("t2")]
    for salt, h in enumerate(_HASHES):
        turns = turns.withColumn(h, F.xxhash64(F.lit(salt), *seen).cast("decimal(20,0)"))
    turns = turns.select("block", "pos", F.col("all_n").alias("turns"), *_TURN, *_HASHES)
    turns = _with_offsets(turns, {h: F.sum(h) for h in _HASHES})
    running = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    sums = [(F.sum(h).over(running) + F.col("before_" + h)).cast("decimal(38,0)").alias(h) for h in _HASHES]
    return turns.select("pos", "turns", *_TURN, *sums)


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """(conv, turns, copies): conversations that are no proper prefix of another, one
    for each set of equal ones."""
    key = ["turns", *_HASHES]
    heads = prefixes.filter(F.col("pos") == F.col("turns")).groupBy(*key).agg(F.min("conv").alias("conv"), F.count("*").alias("copies"))
    proper = prefixes.filter(F.col("pos") < F.col("turns")).select(F.col("pos").alias("turns"), *_HASHES).distinct()
    return heads.join(proper, key, "left_anti").select("conv", "turns", "copies")


def rendered_turn(role: Column, text: Column) -> Column:
    def plain(c: Column) -> Column:
        return F.replace(c, F.lit("<|"), F.lit("< |"))

    return F.concat(
        F.lit(TURN_START), plain(F.coalesce(role, F.lit("unknown"))), F.lit("\n"),
        plain(F.coalesce(text, F.lit(""))), F.lit(TURN_END + "\n"),
    )


def render_maximal(log: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(``conv``, n_turns, n_copies, part, rendered): the maximal conversations as chat
    text, in parts from 0 on."""
    rows = _rows(log, conv, turn, role, text)
    prefixes = stored(_prefixes(rows))
    kept = maximal_conversations(prefixes)
    places = prefixes.alias("a").join(kept.alias("b"), _same("a", "b", ("conv",)))
    places = places.select(*[f"a.{c}" for c in _TURN], "b.turns", "b.copies", "a.pos")
    # only now the texts, of maximal conversations alone and each once
    same = key_hash([F.col("conv")])
    wanted = may_be_in(rows, same, kept.select(same.alias("k")), "k").groupBy(*_TURN).agg(F.first("text").alias("text"))
    told = places.alias("a").join(wanted.alias("b"), _same("a", "b", _TURN))
    rows = told.select(
        "a.conv", "a.turns", "a.copies", "a.pos", F.floor((F.col("a.pos") - 1) / PART_TURNS).alias("part"),
        rendered_turn(F.col("a.role"), F.col("b.text")).alias("piece"),
    )
    pieces = F.array_sort(F.collect_list(F.struct("pos", "piece")))
    parts = rows.groupBy("conv", "turns", "copies", "part").agg(F.array_join(F.transform(pieces, lambda x: x["piece"]), "").alias("rendered"))
    return parts.select(F.col("conv").alias(conv), F.col("turns").alias("n_turns"), F.col("copies").alias("n_copies"), "part", "rendered")
