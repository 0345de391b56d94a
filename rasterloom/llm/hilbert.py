"""Shards along a Hilbert curve over metadata columns, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rasterloom.llm.tables import stored

BITS = 5


def _curve_tables(n):
    """Per-cell tables of the curve's rule in n dimensions: inverse Gray code, entry corner, direction.

    Hamilton's description: at each level the cell's corner label is turned into the curve's frame
    (entry e, direction d), its inverse Gray code w is the next digit, and e and d move on.
    """
    def trailing_ones(w):
        return (~w & (w + 1)).bit_length() - 1

    inverse = [0] * (1 << n)
    for w in range(1 << n):
        inverse[w ^ (w >> 1)] = w
    entry = [0 if w == 0 else (v := 2 * ((w - 1) // 2)) ^ (v >> 1) for w in range(1 << n)]
    direction = [0 if w == 0 else trailing_ones(w - 1 if w % 2 == 0 else w) % n for w in range(1 << n)]
    return inverse, entry, direction


def curve_index(cells, bits=BITS):
    """Hilbert index of a point whose coordinates are columns of integers below 2 ** bits."""
    n = len(cells)
    inverse, entry, direction = (F.array(*map(F.lit, t)) for t in _curve_tables(n))
    full = (1 << n) - 1

    def rotate(x, k, right):  # within n bits
        a, b = (k, F.lit(n) - k) if right else (F.lit(n) - k, k)
        return F.call_function("shiftright", x, a).bitwiseOR(F.call_function("shiftleft", x, b)).bitwiseAND(F.lit(full))

    def step(acc, level):
        corner = F.lit(0)
        for i, c in enumerate(cells):
            corner = corner.bitwiseOR(F.call_function("shiftleft", F.call_function("shiftright", c, level).bitwiseAND(F.lit(1)), F.lit(i)))
        turned = rotate(corner.bitwiseXOR(acc["e"]), acc["d"] + 1, True)
        w = F.get(inverse, turned)
        return F.struct(
            (acc["h"] * F.lit(1 << n) + w).alias("h"),
            acc["e"].bitwiseXOR(rotate(F.get(entry, w), acc["d"] + 1, False)).alias("e"),
            ((acc["d"] + F.get(direction, w) + 1) % n).alias("d"))

    start = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step, lambda acc: acc["h"])


def _number(df, column):
    """A column of numbers in order, as longs or doubles: nulls first, NaN last."""
    if isinstance(df.schema[column].dataType, T.IntegralType):
        return F.coalesce(F.col(column).cast("long"), F.lit(-(1 << 63)))
    code = F.col(column).cast("double")
    return F.when(F.isnan(code), float("inf")).otherwise(F.coalesce(code, F.lit(float("-inf"))))


def _quantile_values(df, column, n):
    """The values, null first, that hold the 1/n, 2/n, ... quantiles of a column of any ordered type.

    Whole values are counted and ranked, and the counts summed along the ranks. Only the at most n
    values found meet in one place, and one number for each 4096 ranks.
    """
    laid = stored(ranked(df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows")), ["value"]).withColumn("block", F.shiftright("rank", 12)), "values")
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = laid.groupBy("block").agg(F.sum("rows").alias("in_block")).select("block", F.coalesce(F.sum("in_block").over(before), F.lit(0)).alias("before"))
    total = laid.agg(F.sum("rows")).first()[0] or 1
    inside = Window.partitionBy("block").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = laid.join(blocks, "block").withColumn("upto", F.col("before") + F.sum("rows").over(inside))
    cell = lambda rows: F.floor(rows * F.lit(n) / F.lit(total))
    return [r.value for r in upto.filter(cell(F.col("upto")) > cell(F.col("upto") - F.col("rows"))).orderBy("rank").select("value").collect()]


def ranked(df, order):
    """``df`` with ``rank``, from 0 in the given order, which must end in a column that differs between rows.

    Rows are dealt by sampled ranges and sorted inside them. Only the sizes of the ranges, one number
    each, meet in one place.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = stored(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    sizes = laid.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return laid.withColumn("_part", part).join(F.broadcast(sizes), "_part").withColumn(
        "rank", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_before")


def hilbert_shards(docs, dimensions, shards=40, bits=BITS):
    """Cut ``docs`` into shards whose row counts are at most one apart, along a Hilbert curve.

    ``docs`` has doc_id, text and the named dimensions (of any ordered type). Each dimension is quantised
    to 2 ** bits cells by the quantiles of its whole values, so hot values do not leave the other cells empty. Rows are
    sorted by curve index, then equal texts stand together, and the order is cut into equal runs: a
    shard spans a compact box of the dimensions, which is what min/max statistics of files prune by.
    A hot value is cut like any other stretch of the order. Null dimensions come first; null texts
    have the size and checksum of empty ones; repeated rows are all kept; an empty table gives none.

    Returns doc_id, size, text_crc32, curve, shard, slot.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    number = [d == "size" or isinstance(docs.schema[d].dataType, (T.IntegralType, T.FloatType, T.DoubleType)) for d in dimensions]
    rows = docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"), *(
        (size if d == "size" else _number(docs, d) if plain else F.col(d)).alias(f"_d{i}") for i, (d, plain) in enumerate(zip(dimensions, number))), F.monotonically_increasing_id().alias("_uid"))
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = rows.agg(F.count(F.lit(1)), *(F.percentile_approx(f"_d{i}", cuts, 1000).alias(f"_d{i}") for i, plain in enumerate(number) if plain)).first()
    bounds = [sorted(set(found[f"_d{i}"] or [])) if plain else _quantile_values(rows, f"_d{i}", 1 << bits) for i, plain in enumerate(number)]
    above = lambda i, b: F.col(f"_d{i}").isNotNull() if b is None else F.col(f"_d{i}") > F.lit(b)
    cells = [sum((F.when(above(i, b), 1).otherwise(0) for b in bounds[i]), F.lit(0)).cast("int") for i in range(len(dimensions))]
    cells = rows.select("doc_id", "size", "text_crc32", "_uid", *(c.alias(f"_c{i}") for i, c in enumerate(cells)))
    cells = cells.select("doc_id", "size", "text_crc32", "_uid", curve_index([F.col(f"_c{i}") for i in range(len(dimensions))], bits).alias("curve"))
    laid = ranked(cells, ["curve", "text_crc32", "size", "doc_id", "_uid"])
    total = laid.count()
    small, more = divmod(total, shards)  # the first ``more`` shards have one row more
    head = more * (small + 1)
    rank = F.col("rank")
    shard = F.when(rank < head, F.floor(rank / (small + 1))).otherwise(F.floor((rank - head) / max(small, 1)) + more)
    laid = laid.withColumn("shard", shard.cast("int"))
    first = F.when(F.col("shard") < more, F.col("shard") * F.lit(small + 1)).otherwise(F.lit(head) + (F.col("shard") - more) * F.lit(small))
    return laid.select("doc_id", "size", "text_crc32", "curve", "shard", (rank - first).cast("long").alias("slot"))
