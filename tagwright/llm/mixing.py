"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Every source gets a share of all words by its weight, at most ``max_copies``
times what it has. A document is due copies in proportion to its ``favour``, at
most ``max_copies``, so that the words due add up to the target: the whole part is
certain, the rest is the inclusion probability of one more copy. Documents are
ranked by the odds of a random number over the odds of inclusion, and take the
extra copy in that order until the source's target is reached. The random number
hashes the row (id, source, text, and its number among equal rows), so that reruns
agree, however the rows are partitioned.

The rank order of a source is never sorted as a whole, as one source may hold a
third of all rows. A radix descent sums sizes by digits of the rank value (at
most ``DIGIT`` sums for each source and level) until the boundary lies in a
2^-24th of the source; only those rows are ranked one by one.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; documents of size 0 take 0 words; without any word all targets
are 0; rows of one id and repeated rows are sampled as rows of their own, also
where the id is null; very long texts count whole; columns of other names play no
part; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tagwright.session import write_shared

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
DIGIT = 4096
LEVELS = 2

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int], max_copies: int) -> DataFrame:
    """``target`` of each row of (source, source_size).

    Shares by weight, capped and the excess shared again until nothing is above
    its cap, is a water level: sources by cap over weight fill up in that order,
    and the level where the rest can take the rest holds for all of them. One row
    per source meets in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    number = (F.row_number().over(by_name) - 1) % len(weights)
    capped = (
        sources.withColumn("weight", F.get(cycle, number.cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(max_copies)))
        .withColumn("fill", F.col("cap") / F.col("weight"))
    )
    by_fill = Window.orderBy("fill", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    leveled = capped.withColumn("level", left / F.sum("weight").over(onward))
    full = F.col("level") >= F.col("fill")
    water = F.max(F.when(~full, F.col("level"))).over(everything)
    return leveled.withColumn(
        "target", F.when(full, F.col("cap")).otherwise(F.col("weight") * water)
    ).select("source", "source_size", "target")


def twin_key(doc_id: Column, source: Column, text: Column) -> Column:
    """A digest that equal rows share."""
    parts = [F.coalesce(F.concat(F.lit("i"), doc_id.cast("string")), F.lit("-"))]
    parts.append(F.coalesce(F.concat(F.lit("s"), source), F.lit("-")))
    parts.append(F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def numbered(rows: DataFrame) -> DataFrame:
    """Stored rows (twin, part, ...) with their ``number`` among equal ones, counted
    inside the task that wrote them and then over tasks, so that a row repeated
    without end is no single group."""
    counts = rows.groupBy("twin", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("twin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("first", F.sum("n").over(earlier)).filter("first is not null").select("twin", "part", "first")
    inside = F.row_number().over(Window.partitionBy("twin", "part").orderBy("size"))
    marked = rows.withColumn("inside", inside).join(before, ["twin", "part"], "left")
    return marked.withColumn("number", F.col("inside") + F.coalesce("first", F.lit(0))).drop("inside", "first")


def random_number(twin: Column, number: Column, seed: int) -> Column:
    """A number inside (0, 1) from 52 bits of a hash of the row."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), twin, F.lit(":"), number.cast("string")))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def copies_due(sized: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """Copies that a document is due, by source and favour: favour times a level, at
    most ``max_copies``. Favours fill up from the highest down, and the level at
    which the rest takes the rest of the target holds for all of them. One row for
    each source and favour; a source's favours meet in one task."""
    classes = with_source(sized.groupBy("source", "favour").agg(F.sum("size").alias("words")), targets)
    by_favour = Window.partitionBy("source").orderBy(F.desc("favour"))
    before = by_favour.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_favour.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("target") - F.lit(float(max_copies)) * F.coalesce(F.sum("words").over(before), F.lit(0))
    liked = F.sum(F.col("favour") * F.col("words")).over(onward)
    leveled = classes.withColumn("level", F.when(liked > 0, F.try_divide(left, liked)).otherwise(F.lit(0.0)))
    full = F.col("level") * F.col("favour") >= F.lit(float(max_copies))
    level = F.max(F.when(~full, F.col("level"))).over(Window.partitionBy("source"))
    due = F.when(full, F.lit(float(max_copies))).otherwise(F.col("favour") * level)
    return leveled.select("source", "favour", "source_size", "target", due.alias("due"))


def mix_sources(
    docs: DataFrame,
    *,
    weights: Sequence[int] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    favour: Column | None = None,
    keep: str | None = None,
    seed: int = 0,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, source, size,
    source_size, target, copies, taken (= copies * size), and the column that
    ``keep`` names, as ``kept``.

    A document of twice the ``favour`` is due twice the copies, up to
    ``max_copies`` (1 where it is missing or not positive). It should have few
    distinct values, such as grades.
    """
    liked = F.lit(1.0)
    if favour is not None:
        given = favour.cast("double")
        liked = F.when((given > 0) & (given < float("inf")), given).otherwise(F.lit(1.0))
    sized = write_shared(
        docs.select(
            "doc_id",
            "source",
            n_words(F.col("text")).alias("size"),
            liked.alias("favour"),
            twin_key(F.col("doc_id"), F.col("source"), F.col("text")).alias("twin"),
            F.spark_partition_id().alias("part"),
            (F.lit(None).cast("long") if keep is None else F.col(keep)).alias("kept"),
        )
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights, max_copies)
    due = write_shared(copies_due(sized, targets, max_copies))

    odds = random_number(F.col("twin"), F.col("number"), seed)
    odds = odds / (1 - odds)
    other = due.withColumnsRenamed({"source": "_source", "favour": "_favour"})
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("favour") == F.col("_favour"))
    ranked = (
        numbered(sized)
        .join(other, same)
        .drop("_source", "_favour", "part")
        .withColumn("certain", F.floor("due"))
        .withColumn("part", F.col("due") - F.col("certain"))
        .withColumn("_odds", odds / F.when(F.col("part") > 0, F.col("part") / (1 - F.col("part"))))
        .withColumn("rank", F.when(F.col("part") > 0, F.col("_odds") / (1 + F.col("_odds"))))
        .drop("_odds")
    )
    ranked = write_shared(ranked)
    bounds = boundaries(ranked)
    placed = with_source(ranked, bounds).withColumn("key", rank_key())
    # Rows before the boundary's digits take the copy, rows after it don't.
    extra = F.when(F.col("rank").isNull() | (F.col("need") <= 0), F.lit(0)).when(
        F.col("key") != F.col("bound"), (F.col("key") < F.col("bound")).cast("int")
    )
    decided = placed.withColumn("extra", extra)
    at_bound = decided.filter(F.col("extra").isNull())
    order = Window.partitionBy("source").orderBy("rank", "twin", "number").rowsBetween(Window.unboundedPreceding, -1)
    so_far = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    at_bound = at_bound.withColumn(
        "extra", (so_far + F.col("size") / 2 <= F.col("need")).cast("int")
    )
    all_rows = decided.filter(F.col("extra").isNotNull()).unionByName(at_bound)
    copies = (F.col("certain") + F.col("extra")).cast("long")
    return all_rows.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
        "kept",
    )


def with_source(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    """Rows with the columns of their source, null sources included."""
    other = by_source.withColumnRenamed("source", "_source")
    return rows.join(other, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def rank_key() -> Column:
    return F.floor(F.col("rank") * F.lit(float(DIGIT**LEVELS)))


def boundaries(ranked: DataFrame) -> DataFrame:
    """Per source: words that extra copies should add (``need``), the digits of
    the rank value where the sum of sizes passes it (``bound``), and the sum
    before them (``before``)."""
    state = ranked.groupBy("source").agg(
        (F.max("target") - F.sum(F.col("certain") * F.col("size"))).alias("need"),
        F.lit(0).cast("long").alias("bound"),
        F.lit(0).cast("long").alias("before"),
    )
    for level in range(1, LEVELS + 1):
        state = write_shared(state)
        inside = with_source(ranked.filter(F.col("rank").isNotNull()), state)
        digits = F.floor(rank_key() / F.lit(DIGIT ** (LEVELS - level)))
        if level > 1:
            inside = inside.filter(F.floor(digits / F.lit(DIGIT)) == F.col("bound"))
        sums = inside.groupBy("source", digits.alias("digits")).agg(
            F.sum("size").alias("words"), F.first("need").alias("need"), F.first("before").alias("before")
        )
        up_to = Window.partitionBy("source").orderBy("digits")
        passed = F.col("before") + F.sum("words").over(up_to)
        # The first digit that passes the need, or one past the last.
        found = (
            sums.withColumn("passed", passed)
            .groupBy("source")
            .agg(
                F.min(F.when(F.col("passed") > F.col("need"), F.col("digits"))).alias("hit"),
                F.max("digits").alias("last"),
                F.max(F.when(F.col("passed") <= F.col("need"), F.col("passed"))).alias("sum_before"),
            )
        )
        state = (
            state.withColumnRenamed("source", "_source")
            .join(found, F.col("_source").eqNullSafe(F.col("source")), "left")
            .select(
                F.col("_source").alias("source"),
                "need",
                F.coalesce("hit", F.col("last") + 1, "bound").cast("long").alias("bound"),
                F.coalesce("sum_before", "before").alias("before"),
            )
        )
    return write_shared(state)


ORACLE = """
with sized as (
  select doc_id, source, size, length(size::varchar)::double as favour, twin,
         row_number() over (partition by twin) as number
  from (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
               md5(coalesce('i' || doc_id::varchar, '-') || '|' || coalesce('s' || source, '-') || '|' || md5(coalesce(text, ''))) as twin
        from documents)),
totals as (
  select source, sum(size)::bigint as source_size from sized group by source),
weighted as (
  select *, [5.0::double, 2.0::double, 1.0::double][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight,
         source_size * 3.0::double as cap
  from totals),
leveled as (
  select *, cap / weight as fill,
         (sum(source_size) over ()
            - coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))::double
         / sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as level
  from weighted),
targets as (
  select source, source_size,
         case when level >= fill then cap
              else weight * max(case when level < fill then level end) over () end as target
  from leveled),
classes as (
  select s.source, favour, source_size, target, sum(size)::double as words
  from sized s join targets t on s.source is not distinct from t.source group by all),
filled as (
  select *, case when sum(favour * words) over later > 0
                 then (target - 3.0::double * coalesce(sum(words) over earlier, 0)) / sum(favour * words) over later
                 else 0.0::double end as level
  from classes
  window earlier as (partition by source order by favour desc rows between unbounded preceding and 1 preceding),
         later as (partition by source order by favour desc rows between current row and unbounded following)),
dues as (
  select source, favour, source_size, target,
         case when level * favour >= 3 then 3.0::double
              else favour * max(case when level * favour < 3 then level end) over (partition by source) end as due
  from filled),
due as (
  select s.doc_id, s.source, s.size, s.twin, s.number, d.source_size, d.target, d.due,
         (cast('0x' || substr(md5('0:' || twin || ':' || number::varchar), 1, 13) as bigint)::double + 0.5) / 4503599627370496.0::double as u
  from sized s join dues d on s.source is not distinct from d.source and s.favour = d.favour),
ranked as (
  select *, due - floor(due) as part,
         (u / (1 - u)) / ((due - floor(due)) / (1 - (due - floor(due)))) as odds
  from due),
placed as (
  select *, target - sum(floor(due) * size) over (partition by source) as need,
         case when part > 0 then odds / (1 + odds) end as place
  from ranked),
summed as (
  select *, coalesce(sum(case when place is not null then size end)
              over (partition by source order by place nulls last, twin, number
                    rows between unbounded preceding and 1 preceding), 0)::double as so_far
  from placed)
select doc_id, size::bigint as size, source_size, target,
       ((floor(due) + case when place is not null and need > 0 and so_far + size / 2.0 <= need then 1 else 0 end) * size)::bigint as taken
from summed
"""
