"""Mixing sources to target weights as a time-varying curriculum.

Sources share the words of the whole mix by weight; a target stops at `MOST_REPEATS` times its
source's size and the excess is reshared by weight (`targets`). Each source also has a schedule: a
piecewise linear weight over training time 0..1. Its integral, scaled to the source's target, is the
source's cumulative token demand. The documents of a source follow each other in a hashed order,
epoch after epoch, until the target is met; the demand at a copy's middle word is inverted to the
time at which the source has been asked for so many words: the copy's training position. Sorting all
copies by position (a range sort) gives the training order.

Running sums per source are taken in two levels, within hashed buckets and over the buckets' sums,
so a source with a third of all rows is spread over as many tasks as it has buckets. Only sizes move;
a text is joined to its positions once, when the mix is written out.

Copies are whole documents. The last epoch takes the documents up to the first that does not fit.
It goes on with later ones of at most half of the words still missing, in rounds, each a
running sum over what is left; a round that does not take them all more than halves the words
missing, so the rounds are few, and after the last at most one more document fits. Then, if that
comes nearer to the target, it takes the one other document whose size is nearest to the words still
missing. A source's rounds are kept as (largest size, last start), not as lists of documents.

Edge cases: a NULL source is a source of its own and comes last. NULL and empty texts have size 0 and
take no position. Repeated rows are documents of their own. NULL ids are mixed like any other. An
empty table gives an empty mix. Other columns stay as they are.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import staged, word_count
from orderloom.operators.dedup import unused

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = 17
# Weight over training time, as (time, weight) knots; sources take them in turn.
SCHEDULES = (
    ((0.0, 2.0), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.75, 1.0), (1.0, 2.0)),
)


def _source_key(source: Column) -> Column:
    """A key that is never NULL: the source behind '=', or nothing for NULL."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _cycle(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MOST_REPEATS
) -> DataFrame:
    """(src, source_size, schedule, target) from (src, source, source_size), a row per source.

    Windows without a partition are sound here: the table holds one row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sources.withColumn("rank", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("weight", _cycle(list(weights), F.col("rank")).cast("long"))
    ranked = ranked.withColumn("most", F.col("source_size") * repeats)
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    wide = "decimal(38,0)"
    filled = (
        ranked.withColumn("all", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("left", F.col("all") - F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn(
            "left_weight",
            F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        )
    )
    # In order of size by weight, the sources that stop at their most come first.
    stops = F.col("most").cast(wide) * F.col("left_weight") <= F.col("weight").cast(wide) * F.col(
        "left"
    )
    filled = filled.withColumn("stops", stops)
    stopped = F.when(F.col("stops"), F.col("most"))
    stopped_weight = F.when(F.col("stops"), F.col("weight"))
    rest = F.col("all") - F.coalesce(F.sum(stopped).over(everything), F.lit(0))
    rest_weight = F.col("all_weight") - F.coalesce(F.sum(stopped_weight).over(everything), F.lit(0))
    share = F.col("weight").cast("double") * rest.cast("double") / F.when(
        rest_weight > 0, rest_weight
    ).cast("double")
    target = F.when(F.col("stops"), F.col("most").cast("double")).otherwise(share)
    return filled.select("src", "source_size", F.col("rank").alias("schedule"), target.alias("target"))


def position_at(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time at which a schedule has used up this share (0..1) of its whole demand."""
    spans = [(t, u - t, v, w) for (t, v), (u, w) in zip(knots, knots[1:])]
    areas = [(v + w) / 2 * h for _, h, v, w in spans]
    whole, used, at = sum(areas), 0.0, F.lit(knots[-1][0])
    pieces = []
    for (t, h, v, w), area in zip(spans, areas):
        asked = F.greatest(share * whole - used, F.lit(0.0))
        root = F.sqrt(F.greatest(v * v + 2 * asked * ((w - v) / h), F.lit(0.0)))
        inside = F.when(asked > 0, 2 * asked / (v + root)).otherwise(0.0)
        used += area
        pieces.append((used, F.lit(t) + inside))
    for used, piece in reversed(pieces):
        at = F.when(share * whole < used, piece).otherwise(at)
    return at


def _offsets(rows: DataFrame) -> DataFrame:
    """Per source and bucket, the words of the rows in the source's earlier buckets."""
    earlier = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = rows.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    before = F.coalesce(F.sum("words").over(earlier), F.lit(0))
    return per_bucket.select("src", "bucket", before.alias("offset"))


def _taken(cuts: str = "cuts") -> Column:
    return F.exists(cuts, lambda c: (F.col("size") <= c["most"]) & (F.col("start") <= c["last"]))


def _filled(more: DataFrame, gaps: DataFrame, buckets: DataFrame, n_rows: int) -> DataFrame:
    """Fills the gaps, round by round, with rows of `more`: `cuts` says which, `missing` what is left."""
    small = F.col("size") * 2 <= F.col("missing")
    columns = ["src", "bucket", "start", "size"]
    left = more.join(buckets.join(gaps, "src"), ["src", "bucket"]).where(small).select(*columns)
    left = staged(left, "left", n_rows)
    while True:
        rows = left.join(buckets.join(gaps, "src"), ["src", "bucket"]).where(small & ~_taken())
        rows = rows.select(*columns, "missing")
        reached = rows.join(_offsets(rows), ["src", "bucket"]).where("offset < missing")
        within = Window.partitionBy("src", "bucket").orderBy("start")
        within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        reached = reached.withColumn("words", F.col("offset") + F.sum("size").over(within))
        got = reached.where("words <= missing").groupBy("src")
        got = got.agg(F.max("words").alias("words"), F.max("start").alias("last"))
        cut = F.array(F.struct((F.col("missing") / 2).alias("most"), F.col("last").alias("last")))
        gaps = gaps.join(got, "src", "left").select(
            "src",
            "fitting",
            (F.col("missing") - F.coalesce("words", F.lit(0))).alias("missing"),
            F.when(F.col("words").isNull(), F.col("cuts")).otherwise(F.concat("cuts", cut)).alias("cuts"),
            F.col("words").isNotNull().alias("grew"),
        )
        gaps = staged(gaps, "gaps", 1)
        grew = gaps.where("grew").count()
        gaps = gaps.drop("grew")
        if not grew:
            return gaps


def schedule(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = MOST_REPEATS,
    schedules: tuple = SCHEDULES,
    seed: int = SEED,
) -> DataFrame:
    """One row per document row: its size, its source's size and target, and its positions.

    `copy` is a hash of the text and `src` the source's key; with the id they name the row.
    """
    text = F.col(text_col)
    order = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}")))
    sizes = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.xxhash64(text).alias("copy"),
            F.col(source_col).alias("source"),
            _source_key(F.col(source_col)).alias("src"),
            word_count(text).alias("size"),
            order.alias("order"),
        ),
        "sizes",
        compression="zstd",
    )
    # As many buckets as rows in one of them, so neither level of the sums outgrows the other.
    n_rows = sizes.count()
    buckets = max(1, isqrt(n_rows))
    place = F.conv(F.substring("order", 1, 8), 16, 10).cast("long") * buckets
    rows = sizes.withColumn("bucket", F.shiftright(place, 32)).drop("source")

    per_bucket = rows.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    sources = sizes.groupBy("src").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size")
    )
    earlier = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    offsets = offsets.drop("words").join(targets(sources, weights, repeats), "src")

    within = Window.partitionBy("src", "bucket").orderBy("order", "doc_id", "size", "copy")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(offsets, ["src", "bucket"]).withColumn("start", F.col("start") + F.col("offset"))

    whole = F.floor(F.col("target") / F.nullif("source_size", F.lit(0)))
    rows = rows.withColumn("whole", whole.cast("int"))
    rows = rows.withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
    rows = staged(rows.drop("order", "offset"), "placed", n_rows, "zstd")
    stop = F.col("start") + F.col("size")
    fits = (stop.cast("double") <= F.col("part")) & (F.col("whole") < repeats)
    more = rows.where((F.col("size") > 0) & (F.col("whole") < repeats))
    gaps = more.groupBy("src").agg(
        F.coalesce(F.max(F.when(fits, stop)), F.lit(0)).alias("fitting"), F.first("part").alias("part")
    )
    gaps = gaps.select(
        "src",
        "fitting",
        (F.col("part") - F.col("fitting")).alias("missing"),
        F.array().cast("array<struct<most: double, last: bigint>>").alias("cuts"),
    )
    gaps = staged(gaps, "gaps", 1)
    in_buckets = staged(more.select("src", "bucket").distinct(), "buckets", buckets)
    unfit = more.where(~fits)
    gaps = _filled(unfit, gaps, in_buckets, n_rows)
    # Each candidate is known by its start, which no other document with words shares.
    unfit = unfit.join(in_buckets.join(gaps, "src"), ["src", "bucket"])
    missing = F.col("missing")
    nearest = F.min(F.struct(F.abs(F.col("size") - missing).alias("off"), "bucket", "start"))
    last = (
        unfit.where(~_taken())
        .groupBy("src", "missing")
        .agg(nearest.alias("n"))
        .where("n.off < missing")
        .select("src", "n.bucket", "n.start")
    )
    columns = ["src", "bucket", "start", "size", "fitting"]
    extras = unfit.where(_taken()).select(*columns).unionByName(
        unfit.join(last, ["src", "bucket", "start"]).select(*columns)
    )
    extras = staged(extras, "extras", n_rows)
    by_start = Window.partitionBy("src", "bucket").orderBy("start")
    by_start = by_start.rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("fitting") + F.col("offset") + F.coalesce(F.sum("size").over(by_start), F.lit(0))
    extras = extras.join(_offsets(extras), ["src", "bucket"])
    extras = extras.select("src", "bucket", "start", before.alias("last_start"))
    rows = rows.join(extras, ["src", "bucket", "start"], "left")
    extra = F.when(fits | (F.col("last_start").isNotNull() & (F.col("size") > 0)), 1).otherwise(0)
    copies = F.when(F.col("size") > 0, F.col("whole") + extra).otherwise(0).cast("int")
    rows = rows.withColumn("copies", copies)

    epochs = F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(
        F.array().cast("array<int>")
    )
    number = F.col("schedule") % len(schedules)

    def position(epoch: Column) -> Column:
        start = F.when(epoch < F.col("whole"), F.col("start")).otherwise(
            F.coalesce("last_start", "start")
        )
        middle = epoch * F.col("source_size") + start + F.col("size") / 2
        share = F.least(middle / F.col("target"), F.lit(1.0))
        at = F.lit(None).cast("double")
        for i, knots in enumerate(schedules):
            at = F.when(number == i, position_at(share, knots)).otherwise(at)
        return at

    return rows.select(
        "doc_id",
        "copy",
        "src",
        "start",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        F.transform(epochs, position).alias("positions"),
    )


def _in_order(
    docs: DataFrame, plan: DataFrame, id_col: str, text_col: str, source_col: str
) -> tuple[DataFrame, list[str]]:
    """The documents of a plan in training order, each as often as it is taken, beside the columns that
    say which row of the plan a copy is of (source key and start) and its position; and their names.

    Documents and plan meet in one exchange of the texts: rows that agree in id, text and source
    are told apart by number on both sides, and a number's two rows then lie side by side.
    """
    names = docs.columns
    # Helper columns stand beside the caller's, whatever those are called.
    own_id, copy, src, start, positions, rank, number, at = [
        unused(name, names)
        for name in ("_id", "_copy", "_src", "_start", "_positions", "_rank", "_number", "_at")
    ]
    keys = [own_id, copy, src]
    rows = docs.withColumns(
        {
            own_id: F.coalesce(F.col(id_col).cast("string"), F.lit("")),
            copy: F.xxhash64(text_col),
            src: _source_key(F.col(source_col)),
            start: F.lit(None).cast("long"),
            positions: F.lit(None).cast("array<double>"),
            rank: F.xxhash64(*names),
        }
    )
    wanted = plan.where("size > 0").select(
        *[F.lit(None).cast(docs.schema[name].dataType).alias(name) for name in names],
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(own_id),
        F.col("copy").alias(copy),
        F.col("src").alias(src),
        F.col("start").alias(start),
        F.col("positions").alias(positions),
        F.col("start").alias(rank),
    )
    is_doc = F.col(start).isNull()
    side_by_side = rows.unionByName(wanted).repartition(*keys)
    of_side = Window.partitionBy(*keys, is_doc).orderBy(rank)
    same_number = Window.partitionBy(*keys, number)
    met = side_by_side.withColumn(number, F.row_number().over(of_side)).select(
        *names,
        *keys,
        number,
        is_doc.alias(rank),
        F.max(start).over(same_number).alias(start),
        F.max(positions).over(same_number).alias(positions),
    )
    placed = met.where(F.col(rank)).withColumn(at, F.explode(positions))
    # The id and the text's hash are computed again, so that the sort does not carry them twice.
    order = [at, F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.xxhash64(text_col), src, number]
    return placed.select(*names, src, start, at, number).orderBy(*order).drop(number), [src, start, at]


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **parameters,
) -> DataFrame:
    """The documents in training order, each as often as the mix takes it, with their columns."""
    plan = schedule(docs, id_col, text_col, source_col, **parameters)
    placed, _ = _in_order(docs, plan, id_col, text_col, source_col)
    return placed.select(*docs.columns)


def read_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **parameters,
) -> DataFrame:
    """Write the mix out in training order, and say from its files what it holds of each document.

    One row per document row, as `schedule` has them; `taken` are the words of all its copies in the
    files, `n_copies` their number and `first_position` the place of the first.
    """
    plan = schedule(docs, id_col, text_col, source_col, **parameters)
    plan = staged(plan, "plan", compression="zstd")
    placed, (src, start, at) = _in_order(docs, plan, id_col, text_col, source_col)
    mix = staged(placed, "mix", compression="zstd", **{"parquet.compression.codec.zstd.level": "9"})
    held = mix.groupBy(F.col(src).alias("src"), F.col(start).alias("start")).agg(
        F.sum(word_count(F.col(text_col))).alias("words"),
        F.count(F.lit(1)).alias("copies"),
        F.min(at).alias("first"),
    )
    # A document without words shares the start of the one behind it.
    worded = F.col("size") > 0
    return plan.join(held, ["src", "start"], "left").select(
        "doc_id",
        "copy",
        "src",
        "start",
        "size",
        "source_size",
        "target",
        F.when(worded, F.coalesce("words", F.lit(0))).otherwise(0).cast("long").alias("taken"),
        F.when(worded, F.coalesce("copies", F.lit(0))).otherwise(0).cast("long").alias("n_copies"),
        F.when(worded, F.col("first")).alias("first_position"),
    )
