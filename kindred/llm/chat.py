"""Chat formatting: collapse cumulative snapshots of conversations, then render what is left.

Loggers often store a conversation again after each turn.  A rolling hash of the turns names
every prefix; a conversation whose whole hash is a proper prefix of another one is dropped by an
anti-join, of equal ones the least identifier stays, and the maximal ones are rendered.  All of
it is DataFrame operations.

Turns go by (turn, role, text), nulls first; a row repeated in full counts once.  Null roles and
texts read as empty.  Rows without conversation are ignored.  An empty table gives none.

The rolling hash of a prefix is the sum over its turns of 64-bit hashes of (place, role, text),
twice with different seeds: exact as a decimal, so a window computes it turn by turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OUT = ("conv_id", "n_turns", "n_copies", "rendered")


def prefixes(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, h1, h2, last): every turn with the hash of the turns up to it."""
    turns = conversations.filter("conv_id is not null").select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    same = F.struct("turn", "role", "text")
    turns = turns.withColumn("again", F.lag(same).over(order).eqNullSafe(same)).filter("not again")
    turns = turns.withColumn("place", F.row_number().over(order))
    seeds = {"h1": F.xxhash64("place", "role", "text"), "h2": F.xxhash64(F.lit("second"), "text", "place", "role")}
    turns = turns.withColumn("last", F.lead("place").over(order).isNull())
    for name, value in seeds.items():
        turns = turns.withColumn(name, F.sum(value.cast("decimal(20,0)")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return turns.select("conv_id", "place", "role", "text", "h1", "h2", "last")


def maximal(rows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of conversations that no other one continues."""
    whole = rows.filter("last").groupBy("place", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    inner = rows.filter("not last").select("place", "h1", "h2").distinct()
    return whole.join(inner, ["place", "h1", "h2"], "left_anti").select(
        "conv_id", F.col("place").cast("long").alias("n_turns"), "n_copies"
    )


def render(conversations: DataFrame) -> DataFrame:
    """Per maximal conversation: conv_id, n_turns, n_copies, rendered.

    A rendered conversation is one value, so its turns meet in one row; nothing larger does.
    """
    rows = prefixes(conversations)
    turn = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>"))
    kept = rows.select("conv_id", "place", turn.alias("turn")).join(maximal(rows), "conv_id")
    return kept.groupBy("conv_id", "n_turns", "n_copies").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "turn"))), lambda t: t["turn"]), "\n").alias("rendered")
    ).select(*OUT)


SQL = """with t as (select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
        from conversations where conv_id is not null),
    p as (select *, row_number() over w as place, count(*) over (partition by conv_id) as n,
        string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') over w as prefix
        from t window w as (partition by conv_id order by turn nulls first, role, text)),
    whole as (select min(conv_id) as conv_id, count(*) as n_copies, n, prefix from p where place = n group by n, prefix),
    inner_ones as (select distinct prefix from p where place < n),
    kept as (select * from whole where prefix not in (select prefix from inner_ones))
    select k.conv_id, k.n as n_turns, k.n_copies,
        string_agg('<|' || p.role || '|>' || chr(10) || p.text || chr(10) || '<|end|>', chr(10) order by place) as rendered
    from kept k join p on p.conv_id = k.conv_id group by all"""
