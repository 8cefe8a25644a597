"""Mix sources to target weights by Pareto order sampling.

Sources in code point order (null last) get weights that repeat, and share a multiple of all words. A
target stops at ``most`` times its source's words; the excess goes to the others by weight until none is
above. A source whose target is c + f times its words takes every document c times for certain
(c whole, 0 <= f < 1) and a sample worth f times its words, in which a document's chance grows with its size: f_i = f * size_i *
sum(size) / sum(size^2), so that the expected words are the target; those that would pass 1 are nearly certain. Documents are
ranked by random odds divided by inclusion odds, (u / (1 - u)) / (f_i / (1 - f_i)), and the smallest are taken until the words
come nearest to the target, so the size of the sample is fixed and not left to chance.

``u`` is the md5 of doc_id and the text's md5, so reruns, retries and any partitioning agree, and only rows alike in both have
equal ranks. No source is gathered in a task: two histograms of the rank (1,024 buckets each) locate the cell that holds the cut,
and only that cell, about a millionth of a source, is sorted, equal rows counted as one. The outcome is one row per source; each
document is then decided on its own row, and texts are never shuffled. Where the cut falls within equal rows, as many as fit
are taken: only then are those rows stored and numbered, by their tasks' counts.

A null or empty text has size 0 and takes nothing. Rows that repeat a doc_id are documents of their own. A source without words has
target 0. A null doc_id draws as the empty string. An empty table gives no rows. Extra columns pass through ``mix``, whatever
their names; ``doc_id``, ``source`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierlake import scratch
from tierlake.llm import text as T

# Fixed values of the mix.
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST = 2
LEVEL = 1024
SURE = 1 - 1e-9  # chance of a document whose own would be 1 or more


def size() -> Column:
    """Words of the text, counted without building them."""
    return F.regexp_count(T.text_or_empty(), F.lit(T.WORD)).cast("bigint")


def _text_key() -> Column:
    return F.md5(T.text_or_empty().cast("binary"))


def _draw() -> Column:
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("_key"))
    digits = F.substring(F.md5(name.cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint") + 0.5) / float(1 << 52)


def _rank() -> Column:
    """Random odds over inclusion odds; null where nothing is left to sample."""
    chance = F.col("_part") * F.col("_size").cast("double") * F.col("_source_size").cast("double") / F.col("_squares")
    chance = F.least(chance, F.lit(SURE))
    return F.when((F.col("_part") > 0) & (F.col("_size") > 0), (F.col("_u") / (1 - F.col("_u"))) / (chance / (1 - chance)))


def _cell(rank: Column) -> tuple[Column, Column]:
    place = rank / (1 + rank) * LEVEL
    coarse = F.floor(place)
    return coarse, F.floor((place - coarse) * LEVEL)


def targets(sizes: DataFrame, weights: Sequence[int], percent: int, most: int) -> DataFrame:
    """(source, source_size, squares, target, whole, part) per source. One row each enters the window."""
    squares = F.sum(F.col("size").cast("decimal(19,0)") * F.col("size").cast("decimal(19,0)")).cast("double")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), squares.alias("squares"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    index = (F.row_number().over(order) - 1) % len(weights)
    totals = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), index + 1))
    # Sources fill up in the order of what their weight can take; level: words per weight for the rest.
    by_fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    full = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most
    goal = F.sum("source_size").over(everything) * percent
    totals = totals.withColumn("_level", (goal - full * 100) / (F.sum("weight").over(onward) * 100))
    totals = totals.withColumn("_open", F.col("_level") * F.col("weight") < F.col("source_size") * most)
    level = F.min(F.when(F.col("_open"), F.struct(F.col("source_size") / F.col("weight"), F.col("_level").alias("level"))))
    level = level.over(everything).getField("level")
    target = F.when(F.col("_open"), level * F.col("weight")).otherwise(F.col("source_size") * float(most))
    totals = totals.withColumn("target", target)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio)
    return totals.select("source", "source_size", "squares", "target", whole.alias("whole"), (ratio - whole).alias("part"))


ROW = ["_source", "doc_id", "_key", "_size", "_u"]


def _sized(docs: DataFrame) -> DataFrame:
    """What the mix reads of a document, beside the whole row."""
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
        docs["source"].alias("_source"),
        docs["doc_id"].alias("doc_id"),
        _text_key().alias("_key"),
        size().alias("_size"),
    )
    return rows.withColumn("_u", _draw())


def plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = SHARE_PERCENT, most: int = MOST) -> DataFrame:
    """One row per source: its target, its certain copies, where its sample ends, and how many of the rows there it takes."""
    sizes = scratch.stored(_sized(docs).select(*ROW), "sizes")
    goals = targets(sizes.select(F.col("_source").alias("source"), F.col("_size").alias("size")), weights, percent, most)
    goals = scratch.stored(goals.withColumnsRenamed({c: f"_{c}" for c in goals.columns}), "targets")
    goals = goals.withColumn("_rest", F.col("_target") - F.col("_whole") * F.col("_source_size"))
    coarse, fine = _cell(F.col("_rank"))
    ranked = _with_source(sizes, goals).withColumn("_rank", _rank()).filter("_rank is not null")
    ranked = ranked.withColumns({"_coarse": coarse, "_fine": fine})
    ranked = ranked.select("_source", "doc_id", "_key", "_size", "_rank", "_coarse", "_fine", "_rest")
    first = _cut(ranked, "_coarse", F.lit(0).cast("bigint"))
    ranked = _with_source(ranked.drop("_rest"), first).filter("_coarse = _cut").drop("_cut")
    second = _cut(ranked, "_fine", F.col("_before"))
    second = second.withColumnsRenamed({"_cut": "_cut_fine", "_before": "_before_fine"})
    inside = _with_source(ranked.drop("_rest", "_before"), second).filter("_fine = _cut_fine")
    alike = ["_source", "_rank", "doc_id", "_key", "_size"]
    inside = inside.groupBy(*alike, "_coarse", "_fine", "_before_fine", "_rest").agg(F.count("*").alias("_n"))
    order = Window.partitionBy("_source").orderBy("_rank", "doc_id", "_key").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("_n") * F.col("_size")).over(order), F.lit(0)) + F.col("_before_fine")
    # A row is taken where half of it or more lies before the target; of equal rows as many as that.
    fits = F.floor((2 * (F.col("_rest") - before) + F.col("_size")) / (2 * F.col("_size")))
    inside = inside.withColumn("_fit", F.greatest(F.lit(0), F.least(F.col("_n"), fits)).cast("bigint"))
    last = F.struct("_rank", "doc_id", "_key", "_fit", "_n")
    ends = inside.groupBy("_source").agg(
        F.first("_coarse").alias("_cut_coarse"),
        F.first("_fine").alias("_cut_fine"),
        F.max(F.when(F.col("_fit") > 0, last)).alias("_last"),
    )
    return scratch.stored(_with_source(goals, ends, "left").drop("_rest"), "mix")


def _with_source(rows: DataFrame, per_source: DataFrame, how: str = "inner") -> DataFrame:
    """Join one row per source, null source included."""
    per_source = per_source.withColumnRenamed("_source", "_of")
    return rows.join(per_source, F.col("_source").eqNullSafe(F.col("_of")), how).drop("_of")


def _cut(ranked: DataFrame, bucket: str, before: Column) -> DataFrame:
    """The bucket of each source in which the words reach the rest, and the words before it."""
    sums = ranked.groupBy("_source", bucket).agg(
        F.sum("_size").alias("_words"), F.first("_rest").alias("_rest"), F.first(before).alias("_start")
    )
    upto = Window.partitionBy("_source").orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("_upto", F.sum("_words").over(upto) + F.col("_start"))
    sums = sums.filter("_upto > _rest and _upto - _words <= _rest")
    return sums.select("_source", F.col(bucket).alias("_cut"), (F.col("_upto") - F.col("_words")).alias("_before"), "_rest")


def copies(docs: DataFrame, per_source: DataFrame) -> DataFrame:
    """The documents (``_row``) with _size, _source_size, _target and how often each is taken (``_copies``)."""
    both = _with_source(_sized(docs), per_source).withColumn("_rank", _rank())
    coarse, fine = _cell(F.col("_rank"))
    place = F.struct(coarse.alias("a"), fine.alias("b"))
    cut = F.struct(F.col("_cut_coarse").alias("a"), F.col("_cut_fine").alias("b"))
    own, last = (F.struct(*[F.col(f"{at}{c}").alias(c) for c in ("_rank", "doc_id", "_key")]) for at in ("", "_last."))
    known = F.col("_rank").isNotNull() & F.col("_cut_coarse").isNotNull()
    at_end = F.coalesce(known & (place == cut) & F.col("_last").isNotNull() & (own == last), F.lit(False))
    before = known & ((place < cut) | ((place == cut) & F.col("_last").isNotNull() & (own < last)))
    both = both.withColumns({"_at_end": at_end, "_taken": (at_end | F.coalesce(before, F.lit(False))).cast("bigint")})
    if not per_source.filter("_last._fit < _last._n").isEmpty():
        split = F.col("_at_end") & (F.col("_last._fit") < F.col("_last._n"))
        numbered = _numbered(both.filter(split))
        numbered = numbered.withColumn("_taken", (F.col("_number") <= F.col("_last._fit")).cast("bigint")).drop("_number")
        both = both.filter(~split).unionByName(numbered)
    return both.withColumn("_copies", F.col("_whole") + F.col("_taken"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Equal rows of each source with a number from 1: that within their task, and the counts of the tasks before.

    Rows are stored, so that their tasks stay the same; a window holds the part of one task.
    """
    rows = scratch.stored(rows.withColumns({"_task": F.spark_partition_id(), "_slot": F.monotonically_increasing_id()}), "equal")
    counts = rows.groupBy("_source", "_task").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy("_source").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("_source").alias("_s"), F.col("_task").alias("_t"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_ahead"))
    within = F.row_number().over(Window.partitionBy("_source", "_task").orderBy("_slot"))
    same = F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_task") == F.col("_t"))
    placed = rows.withColumn("_within", within).join(F.broadcast(counts), same)
    return placed.withColumn("_number", F.col("_ahead") + F.col("_within")).drop("_within", "_ahead", "_s", "_t", "_task", "_slot")


def mix_report(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    return copies(docs.select("doc_id", "source", "text"), plan(docs)).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """The documents, each row as often as the mix takes it."""
    taken = copies(docs, plan(docs))
    repeated = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return taken.filter("_copies > 0").select("_row", repeated.alias("_copy")).select("_row.*")


REPORT_SQL = r"""
with sized as (
  select doc_id, source, md5(coalesce(text, '')) as key, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents
), totals as (
  select source, sum(size)::bigint as source_size, sum(size::hugeint * size)::double as squares from sized group by source
), weighed as (
  select *, [3, 1, 2][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight from totals
), level as (
  select *, (sum(source_size) over () * 150
      - 100 * 2 * coalesce(sum(source_size) over (order by source_size / weight, source nulls last
          rows between unbounded preceding and 1 preceding), 0))::double
      / (100 * sum(weight) over (order by source_size / weight, source nulls last
          rows between current row and unbounded following))::double as level
  from weighed
), open_ones as (
  select min_by(level, source_size / weight) as level from level where level * weight < source_size * 2
), goals as (
  select l.source, l.source_size, l.squares,
      case when l.level * weight < source_size * 2 then o.level * weight else source_size * 2.0::double end as target
  from level l, open_ones o
), parts as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end as whole,
      case when source_size > 0 then target / source_size - floor(target / source_size) else 0 end as part
  from goals
), drawn as (
  select s.doc_id, s.key, s.size, p.*,
      (('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || key), 1, 13))::bigint + 0.5) / 4503599627370496.0::double as u,
      least(part * size::double * source_size::double / squares, 1 - 1e-9::double) as chance
  from sized s join parts p on s.source is not distinct from p.source
), ranked as (
  select *, case when part > 0 and size > 0 then (u / (1 - u)) / (chance / (1 - chance)) end as rank from drawn
), summed as (
  select *, sum(size) over (partition by source order by rank, doc_id, key rows unbounded preceding) as upto from ranked
)
select doc_id, size::bigint as size, source_size, target,
    (size * (whole + case when rank is not null and 2 * upto - size <= 2 * (target - whole * source_size) then 1 else 0 end))::bigint as taken
from summed
"""
