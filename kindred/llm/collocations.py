"""Phrase collocations: frequent 2- and 3-word phrases whose parts rarely stand apart.

Texts are lower-cased (A-Z only), cut at ``.,;:!?`` and line ends into pieces and those at
spaces and tabs into words; everything is counted per language (null: ``und``).  Phrases
never cross pieces.

Counting follows the suffix-array route: a task cuts its documents into shards of at most
``SHARD_WORDS`` words at piece boundaries (a longer piece is cut into stretches that overlap
by two words, each start counted once), numbers the shard's words, and sorts all word
positions by the next three word ids, a suffix array to depth three whose last column before
each suffix is the shard's Burrows-Wheeler column.  Every n-gram of one to three words is one
interval of that order: intervals of one word are refined to the right into those of two and
three, and each interval's width is the n-gram's count in the shard.  Shards' counts are
summed by Spark (one shuffle, where a pair of words travels once with all third words that
follow it), so a shard costs memory linear in ``SHARD_WORDS`` whatever the length of a document.

Scoring, exact in integers: a = f(phrase) must reach ``LEAST``; cutting after k words gives
l = f(head), r = f(tail) and floor(1,000,000 a^2 / (l r)); the lowest cut counts, ties to the
smallest k.  A 2-word candidate is dropped when a 3-word candidate holding it, at either end,
has 100 f(longer) >= 50 a.  Each language's first ``TOP`` rows by score, a (both descending)
and phrase (byte order) are returned.

Defined cases: null text counts as empty, null lang as ``und``; repeated rows count as often
as they occur; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.stage import staged

SHARD_WORDS = 1 << 22
OUT_ROWS = 1 << 16  # phrases of one batch handed back to Spark, but for the third words of one pair
LEAST = 10
TOP = 2000
LONGEST = 3
# Fixed values of the definition: where pieces end, and what parts words.
PIECE_ENDS = "[.,;:!?\\x{0A}-\\x{0D}]"
WORD_GAPS = "[ \\t]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# A phrase's language and first two words are one text, parted by a tab, which no word holds.
# ``lasts`` are the words that end a phrase of it, parted by spaces, first the empty one of the
# phrase of ``key`` alone, and ``counts`` are those phrases' counts: rows of the one shuffle
# are as few and narrow as can be.
COUNTS = "key string, lasts string, counts string"


def pieces(docs: DataFrame) -> DataFrame:
    """(lang, words): every piece of every text as an array of words, JVM-side."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")) if "lang" in docs.columns else F.lit("und")
    split = docs.select(lang.alias("lang"), F.explode(F.split(text, PIECE_ENDS)).alias("piece"))
    words = F.filter(F.split(F.col("piece"), WORD_GAPS), lambda w: w != "")
    return split.select("lang", words.alias("words")).filter(F.size("words") > 0)


def _batch(lang: str, heads: list[pa.Array], edge: np.ndarray, lasts: pa.Array, f: np.ndarray) -> pa.RecordBatch:
    """Rows of phrases' first words; ``lasts`` and ``f`` of row i lie from edge[i] to edge[i + 1]."""
    phrase = pc.binary_join_element_wise(*heads, " ") if len(heads) > 1 else heads[0]
    offsets, counts = pa.array(edge - edge[0], pa.int32()), pa.array(f.astype(np.int64)).cast(pa.string())
    listed = [pc.binary_join(pa.ListArray.from_arrays(offsets, part), " ") for part in (lasts, counts)]
    return pa.RecordBatch.from_arrays(
        [pc.binary_join_element_wise(lang, phrase, "\t"), *listed], names=["key", "lasts", "counts"]
    )


def _shard_counts(lang: str, parts: list):
    """Counts of 1- to 3-grams of one shard from its depth-three suffix array.

    ``parts``: (words, start, size, owned) of stretches: where each lies among the words, and
    how many leading starts of it are counted here (the rest only finish n-grams of those).
    """
    begin = np.cumsum([0] + [len(words) for words, *_ in parts[:-1]])
    start, size, owned = (np.concatenate([part[k] for part in parts]) for k in (1, 2, 3))
    start = start + np.repeat(begin, [len(part[1]) for part in parts])
    if not start.size:
        return
    # The shard's number of words, under an empty phrase.
    none = pa.array([""], pa.string())
    yield _batch(lang, [none], np.arange(2), none, owned.sum(keepdims=True))
    coded = pa.concat_arrays([words for words, *_ in parts]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    words = coded.dictionary.take(order)
    number = np.empty(len(words), np.int64)
    number[order.to_numpy()] = np.arange(1, len(words) + 1)
    ids = number[coded.indices.to_numpy()]
    del coded, parts
    # Stretches one after the other, each followed by the end of a piece (0).
    base = np.cumsum(size + 1) - size - 1
    seq = np.zeros(int((size + 1).sum()) + 2, np.int64)
    seq[_ranges(base, size)] = ids[_ranges(start, size)]
    pos = _ranges(base, owned)
    keys = [seq[pos], seq[pos + 1], seq[pos + 2]]
    keys[2][keys[1] == 0] = 0
    kinds = len(words) + 1
    if kinds**3 < 1 << 63:  # the suffix array to depth three, its keys in one number
        key = (keys[0] * kinds + keys[1]) * kinds + keys[2]
        del keys, seq
        key.sort()
        key, third = np.divmod(key, kinds)
        k = [*np.divmod(key, kinds), third]
    else:
        order = np.lexsort(keys[::-1])
        k = [key[order] for key in keys]
    change = np.zeros(pos.size, bool)
    change[0] = True
    intervals = []
    for size in range(1, LONGEST + 1):
        change[1:] |= k[size - 1][1:] != k[size - 1][:-1]
        # An interval of ``size`` words starts where a key of its first ``size`` changes.
        first = np.flatnonzero(change)
        width = np.diff(np.append(first, pos.size))
        keep = k[size - 1][first] > 0
        intervals.append((first[keep], width[keep]))
    named = pa.concat_arrays([none.cast(words.type), words])  # by id; 0 is no word
    (first, width), pairs, (third, times) = intervals
    for i in range(0, first.size, OUT_ROWS):
        some = slice(i, i + OUT_ROWS)
        heads, lone = named.take(pa.array(k[0][first[some]])), np.zeros(first[some].size, np.int64)
        yield _batch(lang, [heads], np.arange(lone.size + 1), named.take(pa.array(lone)), width[some])
    # A pair's interval holds those of the phrases it begins, which follow it in its row.
    first, width = pairs
    begin = np.append(np.searchsorted(third, first), third.size)
    edge = begin + np.arange(begin.size)
    i = 0
    while i < first.size:
        stop = max(i + 1, int(np.searchsorted(edge, edge[i] + OUT_ROWS, "right")) - 1)
        inside = slice(begin[i], begin[stop])
        at = begin[i:stop] - begin[i]
        lasts = np.insert(k[2][third[inside]], at, 0)
        f = np.insert(times[inside], at, width[i:stop])
        heads = [named.take(pa.array(k[j][first[i:stop]])) for j in (0, 1)]
        yield _batch(lang, heads, edge[i : stop + 1], named.take(pa.array(lasts)), f)
        i = stop


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every run, ``size`` of each."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


def _stretches(length: np.ndarray, most: int):
    """Where pieces, one after the other, are cut: start, size and owned starts of each stretch.

    A piece longer than ``most`` goes in stretches overlapping by two words.
    """
    count = -(-length // most)
    begin = _ranges(np.zeros(length.size, np.int64), count) * most
    left = np.repeat(length, count) - begin
    start = np.repeat(np.cumsum(length) - length, count) + begin
    return start, np.minimum(left, most + LONGEST - 1), np.minimum(left, most)


def _counting(shard_words: int):
    def run(batches):
        open_shards: dict[str, list] = {}
        held = 0  # words of all open shards together

        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                lists = batch.column("words").take(pa.array(np.flatnonzero(langs.indices.to_numpy() == code)))
                words = lists.flatten()
                start, size, owned = _stretches(lists.value_lengths().to_numpy().astype(np.int64), shard_words)
                upto, i = np.cumsum(size), 0
                while i < size.size:
                    before = int(upto[i] - size[i])
                    stop = max(i + 1, int(np.searchsorted(upto, before + shard_words - held, "right")))
                    if held and int(upto[stop - 1]) - before + held > shard_words:
                        for some in list(open_shards):
                            yield from _shard_counts(some, open_shards.pop(some))
                        held = 0
                        continue
                    low, high = int(start[i]), int(start[stop - 1] + size[stop - 1])
                    some = words.slice(low, high - low), start[i:stop] - low, size[i:stop], owned[i:stop]
                    open_shards.setdefault(lang, []).append(some)
                    held += int(upto[stop - 1]) - before
                    i = stop
        for lang in list(open_shards):
            yield from _shard_counts(lang, open_shards.pop(lang))

    return run


def phrase_counts(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, size, phrase, f): every 1- to 3-word phrase with its count, summed over shards,
    and per language the number of words under size 0 and phrase ""."""
    # Shards' phrases hardly repeat inside a task, so sums before the shuffle would cost more
    # than they save.
    counted = pieces(docs).mapInArrow(_counting(shard_words), COUNTS).repartition("key")
    each = counted.select("key", F.inline(F.arrays_zip(F.split("lasts", " ").alias("last"), F.split("counts", " ").alias("f"))))
    summed = each.groupBy("key", "last").agg(F.sum(F.col("f").cast("long")).alias("f"))
    head = F.substring_index("key", "\t", -1)
    spaces = F.length(head) - F.length(F.replace(head, F.lit(" ")))
    alone = F.col("last") == ""
    return summed.select(
        F.expr("left(key, length(key) - length(substring_index(key, '\t', -1)) - 1)").alias("lang"),
        F.when(head == "", 0).when(alone, spaces + 1).otherwise(LONGEST).alias("size"),
        F.when(alone, head).otherwise(F.concat(head, F.lit(" "), "last")).alias("phrase"), "f",
    )


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per lang the first ``top`` collocations: lang, rank, phrase, a, l, r, n, score."""
    # Parts of a candidate occur at least as often as it does, so only frequent phrases
    # are kept, and the words of each language (size 0); they are read several times, so
    # they are staged.
    counts = phrase_counts(docs, shard_words)
    kept = staged(counts.filter((F.col("f") >= least) | (F.col("phrase") == "")))
    totals = kept.filter(F.col("size") == 0).select("lang", F.col("f").alias("n"))
    frequent = kept.filter(F.col("size") > 0)
    cands = frequent.filter(F.col("size") >= 2)
    # Parts are written out only for the join that needs them, and are never three words.
    w = F.split("phrase", " ")
    tail1, head2 = F.array_join(F.slice(w, 2, 2), " "), F.array_join(F.slice(w, 1, 2), " ")
    three = F.col("size") == 3
    parts = (("l1", w[0]), ("r1", tail1), ("l2", F.when(three, head2)), ("r2", F.when(three, F.element_at(w, -1))))
    for name, part in parts:
        side = frequent.filter(F.col("size") < 3).select("lang", F.col("phrase").alias("_part"), F.col("f").alias(name))
        cands = cands.withColumn("_part", part).join(side, ["lang", "_part"], "left").drop("_part")
    a = F.col("f")
    big = "decimal(38,0)"
    cands = cands.withColumn("_top", F.lit(1_000_000).cast(big) * a.cast(big) * a.cast(big))
    for k in (1, 2):
        cands = cands.withColumn(f"_bottom{k}", (F.col(f"l{k}").cast(big) * F.col(f"r{k}").cast(big)).cast(big))
    # Exact: every term is a positive integer below 10^38, and div floors.
    s1, s2 = F.expr("_top div _bottom1"), F.expr("_top div _bottom2")
    second = (F.col("size") == 3) & (s2 < s1)
    scored = cands.select(
        "lang", "size", "phrase", a.alias("a"),
        F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"),
        F.when(second, s2).otherwise(s1).alias("score"),
    )
    # Two-word candidates inside a three-word one at either end, with the longer's count.
    longer = frequent.filter(three).select(
        "lang", F.explode(F.array(head2, tail1)).alias("phrase"), F.col("f").alias("_longer")
    )
    longer = longer.groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(
        F.col("_longer").isNull() | (100 * F.col("_longer") < 50 * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.col("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", F.col("l").cast("long").alias("l"), F.col("r").cast("long").alias("r"),
        F.col("n").cast("long").alias("n"), F.col("score").cast("long").alias("score"),
    )


# The same result in DuckDB SQL over the table ``documents``.
SQL = r"""
with d as (
  select coalesce(lang, 'und') as lang,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[.,;:!?\x0A-\x0D]') as ps
  from documents),
p as (select lang, unnest(ps) as piece from d),
w as (select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') as ws from p),
t as (select lang, ws, unnest(range(1, len(ws) + 1)) as i from w where len(ws) > 0),
g as (select lang, ws[i] as w1, ws[i + 1] as w2, ws[i + 2] as w3 from t),
n as (select lang, count(*) as n from g group by lang),
u as (select lang, w1 as w, count(*) as f from g group by lang, w1),
b as (select lang, w1, w2, count(*) as f from g where w2 is not null group by lang, w1, w2),
c2 as (select lang, w1, w2, f as a from b where f >= 10),
c3 as (select lang, w1, w2, w3, count(*) as a from g where w3 is not null group by lang, w1, w2, w3 having count(*) >= 10),
s2 as (
  select c.lang, c.w1 || ' ' || c.w2 as phrase, c.a, x.f as l, y.f as r,
         (1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f) as score
  from c2 c join u x on x.lang = c.lang and x.w = c.w1 join u y on y.lang = c.lang and y.w = c.w2
  where not exists (
    select 1 from c3 where c3.lang = c.lang and 100 * c3.a >= 50 * c.a
      and ((c3.w1 = c.w1 and c3.w2 = c.w2) or (c3.w2 = c.w1 and c3.w3 = c.w2)))),
s3 as (
  select c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3 as phrase, c.a, x.f as l1, y.f as r1, z.f as l2, v.f as r2,
         (1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f) as s1,
         (1000000::hugeint * c.a * c.a) // (z.f::hugeint * v.f) as s2
  from c3 c
  join u x on x.lang = c.lang and x.w = c.w1
  join b y on y.lang = c.lang and y.w1 = c.w2 and y.w2 = c.w3
  join b z on z.lang = c.lang and z.w1 = c.w1 and z.w2 = c.w2
  join u v on v.lang = c.lang and v.w = c.w3),
scored as (
  select lang, phrase, a, l, r, score from s2
  union all
  select lang, phrase, a, case when s2 < s1 then l2 else l1 end, case when s2 < s1 then r2 else r1 end,
         case when s2 < s1 then s2 else s1 end
  from s3),
ranked as (
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, score
  from scored)
select ranked.lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n.n::bigint as n,
       score::bigint as score
from ranked join n on n.lang = ranked.lang
where rank <= 2000
"""
