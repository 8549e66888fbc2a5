"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, checkpointed, fresh, table, unit_interval
from .ranks import gapless_rank

# Children of a node of the reduction tree.
FAN = 64
# A probability this close to 0 or 1 is integral.
EPS = 1e-9
KEY = ["source", "doc_id", "text_hash", "size"]


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(digests: DataFrame, weights: Sequence[float], max_repeat: int) -> DataFrame:
    """One row per source: its size and its target, which sum to the size of all.

    Sources in code point order, null last, take ``weights`` in turn. A target is
    ``min(max_repeat * size, level * weight)``; the level is found by going through the sources in the
    order in which a rising level meets their limits. One row per source goes through one task.
    """
    per_source = digests.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turns = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (
        per_source.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", F.get(turns, (F.col("place") - 1) % len(weights)))
        .withColumn("cap", F.col("source_size").cast("double") * max_repeat)
        .withColumn("meets", F.col("cap") / F.col("weight"))
    )
    everything = Window.partitionBy()
    earlier = Window.orderBy("meets", "place").rowsBetween(Window.unboundedPreceding, -1)

    def before(column: str) -> Column:
        return F.coalesce(F.sum(column).over(earlier), F.lit(0.0))

    level = (F.sum(F.col("source_size").cast("double")).over(everything) - before("cap")) / (
        F.sum("weight").over(everything) - before("weight")
    )
    return (
        ranked.withColumn("level", level)
        .withColumn(
            "level",
            F.min(F.when(F.col("level") <= F.col("meets"), F.struct("meets", "place", "level"))).over(everything)["level"],
        )
        .select("source", "source_size", "rows", F.least("cap", F.col("level") * F.col("weight")).alias("target"))
    )


def _pivot(state: Column, unit: Column, seed: int) -> Column:
    """Let the carried unit and the next one fight: size moves from one to the other, with chances that
    keep both expectations, until one of them is taken or left. The other is carried on."""
    carried = state["carried"]
    p, a, q, b = carried["chance"], carried["size"], unit["chance"], unit["size"]
    rise, fall = F.least(a * (1 - p), b * q), F.least(a * p, b * (1 - q))
    wins = unit_interval(F.xxhash64(carried["draw"], unit["draw"], F.lit(seed))) * (rise + fall) < fall

    def settle(m: Column) -> Column:
        first, second = m["first"], m["second"]
        first_open = (first > EPS) & (first < 1 - EPS)
        second_open = (second > EPS) & (second < 1 - EPS)

        def decided(u: Column, chance: Column) -> Column:
            return F.struct(u["id"].alias("id"), (chance >= 0.5).cast("int").alias("extra"))

        def carry(u: Column, chance: Column) -> Column:
            return F.struct(u["id"].alias("id"), u["draw"].alias("draw"), u["size"].alias("size"), chance.alias("chance"))

        return F.struct(
            F.when(first_open, carry(carried, first)).when(second_open, carry(unit, second)).alias("carried"),
            F.concat(
                state["done"],
                F.when(first_open, F.array(decided(unit, second)))
                .when(second_open, F.array(decided(carried, first)))
                .otherwise(F.array(decided(carried, first), decided(unit, second))),
            ).alias("done"),
        )

    moved = F.struct(
        F.when(wins, p + rise / a).otherwise(p - fall / a).alias("first"),
        F.when(wins, q - rise / b).otherwise(q + fall / b).alias("second"),
    )
    fought = F.get(F.transform(F.array(moved), settle), F.lit(0))
    return F.when(carried.isNull(), F.struct(unit.alias("carried"), state["done"].alias("done"))).otherwise(fought)


def pivotal_rounding(units: DataFrame, seed: int) -> DataFrame:
    """0 or 1 extra copy for each unit, given ``source, id, draw, size, chance, blocks``.

    ``chance`` is strictly between 0 and 1, ``size`` positive. Units are folded in blocks of about
    ``FAN``; each block leaves at most one undecided unit, and those meet in the next level of the tree.
    Large units fight first, so that the undecided one is small. Sizes taken per source are kept exactly
    but for its last undecided unit, whose chance is rounded: off by half its size at most.
    """
    id_type = units.schema["id"].dataType.simpleString()
    empty = F.struct(
        F.lit(None).cast(f"struct<id:{id_type},draw:bigint,size:double,chance:double>").alias("carried"),
        F.array().cast(f"array<struct<id:{id_type},extra:int>>").alias("done"),
    )
    largest = units.agg(F.max("blocks")).first()[0] or 0
    level = units.withColumn("block", F.pmod(F.col("draw"), F.col("blocks"))).drop("blocks")
    levels = 1 + (math.ceil(math.log(largest, FAN) - 1e-9) if largest > 1 else 0)
    decided = []
    for _ in range(levels):
        folded = checkpointed(
            level.groupBy("source", "block")
            .agg(F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("falling"), "draw", "id", "size", "chance"))).alias("units"))
            .select(
                "source",
                "block",
                F.aggregate(
                    F.transform("units", lambda u: F.struct(*[u[c].alias(c) for c in ("id", "draw", "size", "chance")])),
                    empty,
                    lambda state, unit: _pivot(state, unit, seed),
                ).alias("state"),
            )
        )
        decided.append(folded.select(F.explode("state.done").alias("d")).select("d.id", "d.extra"))
        level = folded.where("state.carried is not null").select(
            "source", F.floor(F.col("block") / FAN).alias("block"), "state.carried.*"
        )
    last = level.select("id", (F.col("chance") >= 0.5).cast("int").alias("extra"))
    for d in decided:
        last = last.unionByName(d)
    return last


def mix_plan(
    docs: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0), max_repeat: int = 3, seed: int = 17
) -> DataFrame:
    """Copies of every distinct row: ``source, doc_id, text_hash, size, rows, source_size, target, copies, more``.

    ``rows`` rows of one source with the same id and text are one unit: each is taken ``copies`` times, and ``more``
    of them, fewer than all, once more. The whole part of target / source_size goes to every row. Of rows times the
    fractional part, the whole part is taken for sure; what remains is the chance of one more row, so a unit enters
    the rounding with the size of a single row however often it is repeated. A row without words takes part with a draw of its own. Only
    digests are shuffled, never texts.
    """
    digests = checkpointed(
        docs.select("source", "doc_id", F.xxhash64("text").alias("text_hash"), word_count().alias("size"))
    )
    targets = checkpointed(source_targets(digests, weights, max_repeat))
    units = (
        digests.groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(targets.withColumnRenamed("rows", "source_rows").withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("share", F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0)))
        .withColumn("base", F.floor(F.col("share") + EPS))
        .withColumn("more", (F.col("share") - F.col("base")) * F.col("rows"))
        .withColumn("sure", F.floor(F.col("more") + EPS))
        .withColumn("chance", F.col("more") - F.col("sure"))
        .withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "text_hash", "source"))
    )
    units = checkpointed(units.drop("share", "more"))
    chancy = F.col("chance") > EPS
    rounded = pivotal_rounding(
        units.where(chancy & (F.col("size") > 0)).select(
            "source",
            F.struct(*KEY).alias("id"),
            "draw",
            F.col("size").cast("double").alias("size"),
            "chance",
            F.ceil(F.col("source_rows") / FAN).alias("blocks"),
        ),
        seed,
    ).select("id.*", "extra")
    on = [F.col(f"u.{c}").eqNullSafe(F.col(f"r.{c}")) for c in KEY]
    alone = F.when(chancy & (F.col("u.size") == 0), (unit_interval(F.col("draw")) < F.col("chance")).cast("int"))
    return (
        units.alias("u")
        .join(rounded.alias("r"), on, "left")
        .select(
            *[f"u.{c}" for c in KEY],
            "rows",
            "source_size",
            "target",
            F.col("base"),
            (F.col("sure") + F.coalesce(F.col("extra"), alone, F.lit(0))).alias("extra"),
        )
        .select(
            *KEY,
            "rows",
            "source_size",
            "target",
            (F.col("base") + F.floor(F.col("extra") / F.col("rows"))).cast("int").alias("copies"),
            (F.col("extra") % F.col("rows")).alias("more"),
        )
    )


def mix(docs: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0), max_repeat: int = 3, seed: int = 17) -> DataFrame:
    """The mixed documents: every row as often as the mix takes it, with the columns of ``docs``.

    Needs ``doc_id``, ``text`` and ``source``. Null sources are a source, null and empty texts have size 0. Which of
    several equal rows (id, source and text) are taken once more is a matter of their physical place; only rows that
    are repeated are put in order for that. An empty table stays empty. Other columns pass through.
    """
    names = fresh(docs, "text_hash", "copies", "key_doc", "key_source", "copy", "more", "rows", "unit", "place")
    hashed, copies, doc, source, again, more, rows, unit, place = names
    plan = mix_plan(docs.select("doc_id", "text", "source"), weights, max_repeat, seed)
    plan = plan.withColumnsRenamed({"doc_id": doc, "source": source, "text_hash": hashed, "copies": copies, "more": more, "rows": rows})
    plan = checkpointed(plan.select(doc, source, hashed, copies, more, rows).where((F.col(copies) > 0) | (F.col(more) > 0)))
    keyed = docs.withColumn(again, F.xxhash64("text"))

    def joined(some: DataFrame) -> DataFrame:
        on = keyed["doc_id"].eqNullSafe(some[doc]) & keyed["source"].eqNullSafe(some[source]) & (keyed[again] == some[hashed])
        return keyed.join(some, on)

    def taken(found: DataFrame, times: Column) -> DataFrame:
        return found.withColumn(again, F.explode(F.sequence(F.lit(1), times.cast("int")))).select(*docs.columns)

    once = taken(joined(plan.where(F.col(rows) == 1)), F.col(copies))
    repeated = plan.where(F.col(rows) > 1)
    if repeated.isEmpty():
        return once
    found = joined(repeated).withColumn(unit, F.xxhash64(source, doc, hashed))
    found = gapless_rank(found, unit, [], place)
    times = F.col(copies) + (F.col(place) < F.col(more)).cast("int")
    return once.unionByName(taken(found.where(times > 0), times))


def op1_mixing(spark, sf_dir):
    """What the mix takes of every document, with its source's size and target."""
    plan = mix_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "copies",
        "more",
        F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("row"),
    ).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("copies") + (F.col("row") <= F.col("more")).cast("int"))).alias("taken"),
    )
