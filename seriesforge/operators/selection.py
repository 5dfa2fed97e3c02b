"""Exact order statistics and chronological cuts without sorting a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from seriesforge.session import materialize, settle

DIGIT = 16  # bits settled by one pass


def sortable(value: Column) -> Column:
    """The bits of a double as a long that sorts like the number; -0.0 is 0.0, nulls are not allowed."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0)).cast("bigint")
    return bits.bitwiseXOR(F.shiftright(bits, 63).bitwiseAND(F.lit((1 << 63) - 1)))


def digit_counts(rows: DataFrame, keys: list[str], done: int) -> DataFrame:
    """Rows, least and greatest value of each value of the digit after the first ``done`` bits.

    Combined in the map tasks: whatever a group holds, at most 2**DIGIT rows a group come out.
    """
    rest = 64 - DIGIT - done
    # The first digit keeps the sign and sorts as it is, the others are plain bits.
    digit = F.shiftright("_s", rest) if not done else F.shiftright("_s", rest).bitwiseAND(F.lit((1 << DIGIT) - 1))
    carried = [c for c in rows.columns if c not in ("_s", "_v")]
    return rows.groupBy(*carried, digit.alias("_digit")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))


def exact_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """Exact median of ``value`` per group (at least one key), nulls and NaN ignored.

    Radix selection over the sortable bits: a pass counts the rows of each value of the next 16 bits
    and keeps the one that holds the middle, for all groups at once. Raw values are never ordered, so
    a group of any size only ever sends counts; a group is settled once all that is left of it is one
    value, mostly after two passes. ``df`` is read twice: hand in a stored table.
    """
    rows = (df.select(*keys, F.col(value).cast("double").alias("_v")).dropna()
            .select(*keys, sortable(F.col("_v")).alias("_s"), "_v"))
    order = Window.partitionBy(*keys).orderBy("_digit")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    settled, open_, near = [], None, rows
    for done in range(0, 64, DIGIT):
        if open_ is not None:
            # Only rows that share the bits settled so far are read again.
            inside = near.join(open_, keys).filter(F.shiftright("_s", 64 - done) == F.col("_prefix"))
            near = materialize(inside.select(*keys, "_s", "_v"), "median-rows")
            counted = digit_counts(near.join(open_.select(*keys, "_prefix", "_need", "_even", "_next"), keys), keys, done)
        else:
            counted = digit_counts(rows, keys, done).withColumn("_n", F.sum("_c").over(whole)).select(
                "*", F.lit(0).cast("bigint").alias("_prefix"), F.floor((F.col("_n") + 1) / 2).alias("_need"),
                (F.col("_n") % 2 == 0).alias("_even"), F.lit(None).cast("double").alias("_next")).drop("_n")
        # One row a digit: the least value behind it is needed if the upper middle is the next one.
        placed = counted.withColumns({"_upto": F.sum("_c").over(upto), "_behind": F.lead("_lo").over(order)})
        before = F.col("_upto") - F.col("_c")
        prefix = F.col("_digit") if not done else F.shiftleft("_prefix", DIGIT).bitwiseOR(F.col("_digit"))
        chosen = settle(placed.filter((F.col("_need") > before) & (F.col("_need") <= F.col("_upto"))).select(
            *keys, prefix.alias("_prefix"), (F.col("_need") - before).alias("_need"), "_even", "_c", "_lo", "_hi",
            F.coalesce("_behind", "_next").alias("_next")), "median-digits")
        settled.append(chosen.filter(F.col("_lo") == F.col("_hi")))
        open_ = chosen.filter(F.col("_lo") != F.col("_hi"))
        if open_.isEmpty():
            break
    found = settled[0]
    for more in settled[1:]:
        found = found.unionByName(more)
    upper = F.when(F.col("_even") & (F.col("_need") == F.col("_c")), F.col("_next")).otherwise(F.col("_lo"))
    return found.select(*keys, ((F.col("_lo") + upper) / 2).alias(name))


def exact_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, median) for many columns of a whole table: columns become the groups."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "value")
    return exact_median(long, ["column_name"], "value")


def _cell(width_us: int) -> Column:
    return ((F.col("_us") - F.pmod("_us", F.lit(width_us))) / F.lit(width_us)).cast("bigint")


def ordinals(df: DataFrame, group: list[str], order: list[str], name: str = "_pos") -> DataFrame:
    """Number the rows of each group from 0 by ``order``, however many a group has.

    A range sort deals the rows out; a row's number is its place within its part plus the rows of
    the group in the parts before, of which there is one count a part.
    """
    by = [*group, *order]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = materialize(placed.withColumn("_part", F.spark_partition_id())
                         .withColumn("_at", F.monotonically_increasing_id()), "ordered")
    sizes = placed.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_c"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(sizes.select(*[F.col(g).alias(f"_g{k}") for k, g in enumerate(group)], F.col("_part").alias("_p"),
                                 "_first", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start")), "part-starts")
    same = F.col("_part") == F.col("_p")
    for k, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{k}"))
    number = F.col("_start") + F.col("_at") - F.col("_first")
    return placed.join(starts, same).select(*df.columns, number.alias(name))


def chronological_cut(df: DataFrame, keys: list[str], us: Column, ties: list[str], test_fraction: float,
                      steps_us: tuple[int, ...] = (86_400_000_000, 60_000_000, 1_000_000)) -> DataFrame:
    """Flag the first int(n * (1 - test_fraction)) rows of every group as ``is_train``.

    Row numbers over a group would put the group into one task. Instead the row where the cut
    falls is closed in on by counts per day, minute and second, all combined on the map side;
    only rows of that one second are numbered, and those dealt out by the tie columns. Rows without
    a time come last, in tie order, and are training rows as far as the others don't suffice.
    ``df`` is read several times: hand in a stored table.
    """
    rows = df.withColumn("_us", us)
    timed = rows.filter(F.col("_us").isNotNull()).select(*keys, "_us")

    def needed(frame: DataFrame, cut: DataFrame, on_cell: bool) -> DataFrame:
        """Attach the rows still needed; a cut of the whole table is two numbers, used as literals."""
        if keys:
            return frame.join(cut, [*keys, "_cell"] if on_cell else keys)
        found = cut.first()
        if found is None:
            return frame.filter(F.lit(False)).withColumn("_need", F.lit(0).cast("bigint"))
        inside = frame.filter(F.col("_cell") == found["_cell"]) if on_cell else frame
        return inside.withColumn("_need", F.lit(found["_need"]))

    # The same float arithmetic as an index computed by truncation.
    train_rows = F.floor(F.count(F.lit(1)) * F.lit(1 - test_fraction)).cast("bigint")
    goal = settle(rows.groupBy(*keys).agg(
        train_rows.alias("_need"), F.greatest(train_rows - F.count("_us"), F.lit(0)).alias("_late")), "cut")
    cut, parent = goal.drop("_late"), None
    for width in steps_us:
        inside = (needed(timed, cut, False) if parent is None
                  else needed(timed.withColumn("_cell", _cell(parent)), cut, True).drop("_cell"))
        counts = inside.groupBy(*keys, "_need", _cell(width).alias("_cell")).agg(F.count(F.lit(1)).alias("_c"))
        # One row per cell of the level above: days, then minutes of one day, then seconds of one minute.
        running = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
        start = F.col("_upto") - F.col("_c")
        # The cut lies in the cell that takes the running count past the needed rows.
        cut = settle(counts.withColumn("_upto", F.sum("_c").over(running))
                     .filter((F.col("_need") >= start) & (F.col("_need") < F.col("_upto")))
                     .select(*keys, "_cell", (F.col("_need") - start).alias("_need")), "cut")
        parent = width
    marked = rows.withColumn("_row_cell", _cell(steps_us[-1]))
    if keys:
        marked = marked.join(cut, keys, "left").join(goal.select(*keys, "_late"), keys, "left")
    else:
        found, whole = cut.first(), goal.first()
        marked = marked.withColumns({c: F.lit(found and found[c]).cast("bigint") for c in ("_cell", "_need")})
        marked = marked.withColumn("_late", F.lit(whole["_late"] if whole else 0).cast("bigint"))
    untimed = F.col("_us").isNull()
    in_cut = F.coalesce(F.col("_row_cell") == F.col("_cell"), F.lit(False))
    # Rows without a time need numbers only where some of them, and not all, are training rows.
    contested = (in_cut | (untimed & (F.coalesce("_late", F.lit(0)) > 0)))
    open_ = marked.filter(contested).withColumn("_untimed", untimed).withColumn(
        "_need", F.when(untimed, F.col("_late")).otherwise(F.col("_need")))
    numbered = ordinals(open_, [*keys, "_untimed"], ["_us", *[t for t in ties if t not in keys]])
    numbered = numbered.withColumn("is_train", F.col("_pos") < F.col("_need"))
    # Without a cut cell every timed row is needed for training.
    plain = marked.filter(~contested).withColumn(
        "is_train", F.when(untimed, F.lit(False))
        .otherwise(F.col("_cell").isNull() | (F.col("_row_cell") < F.col("_cell"))))
    return plain.select(*df.columns, "is_train").unionByName(numbered.select(*df.columns, "is_train"))
