"""Mixing sources to target weights as a time-varying curriculum (operator 10).

Every source has a target (words the mix takes from it) and a schedule: a
piecewise linear weight over training time 0..1. Integrating the schedule
gives the share of the source's target that is demanded up to a time; the
words of a source, laid end to end in a fixed pseudo-random order and
repeated as often as the target asks, are placed at the time at which demand
reaches them (the inverse of the integral, in closed form per segment). The
mixed documents are then range-sorted by that position.

Rules for odd rows: a null text or one without words has size 0 and is never
taken; a null source is a source of its own, ordered last; repeated rows are
separate rows; an empty table gives an empty result. Columns of the input are
kept; the columns added here replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm.common import WORD, stored

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: A source's words are repeated at most so often.
MAX_REPEATS = 3
#: Schedules as (time, weight) knots, given to the sources in turn: falling, rising, peaking in the middle.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 0.5), (0.5, 1.5), (1.0, 0.5)),
)
ADDED = ("size", "source_size", "target", "taken", "first_position")


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _inverse(share: Column, knots) -> Column:
    """Time at which the integral of a schedule reaches ``share`` of its whole."""
    pieces, whole = [], 0.0
    for (t0, a), (t1, b) in zip(knots, knots[1:], strict=False):
        area = (t1 - t0) * (a + b) / 2.0
        pieces.append((t0, t1, a, b, whole, area))
        whole += area
    out = None
    for t0, t1, a, b, before, area in reversed(pieces):
        need = share * F.lit(whole) - F.lit(before)  # area asked for within this piece
        slope = (b - a) / (t1 - t0)
        if slope == 0:
            at = F.lit(t0) + need / F.lit(a)
        else:
            at = F.lit(t0) + (F.sqrt(F.greatest(F.lit(a * a) + need * F.lit(2 * slope), F.lit(0.0))) - F.lit(a)) / F.lit(slope)
        out = at if out is None else F.when(share * F.lit(whole) <= F.lit(before + area), at).otherwise(out)
    return out


def position(share: Column, rank: Column, schedules=SCHEDULES) -> Column:
    """Training time 0..1 of the word at ``share`` of its source's target."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        out = F.when(rank % len(schedules) == k, _inverse(share, knots)).otherwise(out)
    return out


def source_targets(by_source: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Targets from one row per source (skey, source, source_size).

    A capped proportional share in closed form: with sources ordered by
    cap / weight, the capped ones are a prefix, and the rest share what is
    left by weight. One row per source passes through these windows.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = by_source.withColumn("rank", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * max_repeats)
    ranked = ranked.withColumn("ratio", F.col("cap").cast("double") / F.col("weight").cast("double"))
    everything = Window.partitionBy()
    upto = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("ratio", "rank").rowsBetween(0, Window.unboundedFollowing)
    step = (ranked.withColumn("whole", F.sum("source_size").over(everything))
            .withColumn("spent", F.coalesce(F.sum("cap").over(upto), F.lit(0)))
            .withColumn("rest", F.sum("weight").over(after)))
    # the share per unit of weight if this source and all with a larger ratio stay below their caps
    step = step.withColumn("level", (F.col("whole") - F.col("spent")).cast("double") / F.col("rest").cast("double"))
    step = step.withColumn("fits", F.when(F.col("level") <= F.col("ratio"), F.col("level")))
    step = step.withColumn("chosen", F.max("fits").over(everything))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight").cast("double") * F.col("chosen"), F.lit(0.0)))
    return step.withColumn("target", target).select("skey", "rank", "source_size", "target")


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights=WEIGHTS, max_repeats: int = MAX_REPEATS, schedules=SCHEDULES) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target, taken and first_position.

    Cumulative words per source are built from 4,096 hash buckets per source
    (sums per bucket, then a running sum inside each bucket), so that a source
    with a third of all rows is spread over thousands of groups.
    """
    spread = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.drop(*[c for c in ADDED if c in docs.columns]).withColumns({
        "size": size_of(F.col(text_col)),
        "skey": F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n")),
        "spread": spread,
        "bucket": F.substring(spread, 1, 3),
    })
    sums = rows.groupBy("skey", F.col(source_col).alias("source"), "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("skey", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("offset"))
    targets = source_targets(sums.groupBy("skey", "source").agg(F.sum("bucket_size").alias("source_size")), weights, max_repeats)
    plan = offsets.join(targets, "skey")
    inside = (Window.partitionBy("skey", "bucket").orderBy("spread", F.col(id_col), "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = rows.join(plan, ["skey", "bucket"]).withColumn("start", F.col("offset") + F.sum("size").over(inside) - F.col("size"))
    asked = F.floor(F.col("target") + F.lit(0.5)).cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(asked / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    out = out.withColumn("asked", asked).withColumn("passes", full)
    extra = F.col("asked") - F.col("passes") * F.col("source_size") - F.col("start")
    taken = F.col("passes") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), extra))
    out = out.withColumn("taken", taken.cast("long"))
    share = F.col("start").cast("double") / F.col("asked").cast("double")
    return out.withColumn("first_position", F.when(F.col("taken") > 0, position(share, F.col("rank"), schedules)))


def plan_columns(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in ADDED] + list(ADDED)


def training_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   schedules=SCHEDULES, extra: tuple[str, ...] = (), **options) -> DataFrame:
    """The mixed corpus: one row per copy taken, range-sorted by training position; ``extra`` names columns of the plan to keep.

    Adds copy (0, 1, ...) and position. Where the mix takes only a part of a
    document's last copy, that copy's text holds its first words up to there.
    """
    plan = plan_mix(docs, id_col, text_col, source_col, schedules=schedules, **options)
    copies = plan.where("taken > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1)))
    left = F.col("taken") - F.col("copy") * F.col("size")
    whole_words = F.regexp_extract_all(F.col(text_col), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.slice(whole_words, F.lit(1), left.cast("int")), "")
    share = (F.col("copy") * F.col("source_size") + F.col("start")).cast("double") / F.col("asked").cast("double")
    copies = copies.withColumn(text_col, F.when(left < F.col("size"), cut).otherwise(F.col(text_col)))
    copies = copies.withColumn("position", position(share, F.col("rank"), schedules))
    keep = [c for c in docs.columns if c not in (*ADDED, "copy", "position")]
    return copies.select(*keep, *extra, "copy", "position").repartitionByRange("position").sortWithinPartitions("position")


def mixed_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The plan's rows with ``taken`` counted in the mixed corpus: the words of a row's copies, added up.

    A row with words is known by its source and its place among the source's words.
    """
    order = training_order(docs, id_col, text_col, source_col, extra=("skey", "start"), **options)
    copies = stored(order.select("skey", "start", "copy", "position", size_of(F.col(text_col)).alias("words")), "mixed-copies")
    words = copies.groupBy("skey", "start").agg(F.sum("words").alias("words"))
    plan = plan_mix(docs, id_col, text_col, source_col, **options).drop("taken").withColumn("place", F.when(F.col("size") > 0, F.col("start")))
    joined = plan.join(words.withColumnRenamed("start", "place"), ["skey", "place"], "left")
    return joined.select(id_col, "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"))


ORACLE_SQL = r"""
with rows_ as (
  select doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size, source,
         coalesce('s' || source, 'n') as skey, md5(coalesce(doc_id::varchar, '')) as spread
  from documents),
sizes as (select skey, source, sum(size)::bigint as source_size from rows_ group by all),
ranked as (select *, row_number() over (order by source asc nulls last) - 1 as rank_ from sizes),
weighed as (select *, (rank_ % 3 + 1)::bigint as weight, source_size * 3 as cap from ranked),
ratios as (select *, cap::double / weight::double as ratio from weighed),
steps as (select *, sum(source_size) over () as whole,
    coalesce(sum(cap) over (order by ratio, rank_ rows between unbounded preceding and 1 preceding), 0) as spent,
    sum(weight) over (order by ratio, rank_ rows between current row and unbounded following) as rest from ratios),
levels as (select *, (whole - spent)::double / rest::double as level from steps),
chosen as (select max(level) as chosen from levels where level <= ratio),
targets as (select skey, rank_, source_size, least(cap::double, coalesce(weight::double * chosen, 0.0)) as target from levels, chosen),
placed as (select r.doc_id, r.size, t.source_size, t.target, t.rank_, floor(t.target + 0.5)::bigint as asked,
    (sum(r.size) over (partition by r.skey order by r.spread, r.doc_id, r.size rows unbounded preceding))::bigint - r.size as start
  from rows_ r join targets t using (skey)),
counted as (select *, case when source_size > 0 then asked // source_size else 0 end as passes from placed)
select doc_id, size, source_size, target,
       (passes * size + greatest(0, least(size, asked - passes * source_size - start)))::bigint as taken
from counted
"""
