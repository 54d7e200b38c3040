"""Sharding along a Hilbert curve [DataFrame functions only].

Several metadata columns are quantised into ``2**bits`` cells each, cells of about
equal row counts whose borders keep the order of the values. The cells of a row are
a point of a grid; rows are put in the order of the point's index on the Hilbert
curve and that order is cut into runs. Neighbouring runs then cover small boxes in
all dimensions at once, so a reader prunes files on any of the columns.

Edge cases: a null value of a dimension lies in cell 0; a null text has no bytes and
checksum 0; equal rows take neighbouring places in any order; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, let, pick, with_rank, with_running_total


def cell_borders(df: DataFrame, dims: list[str], cells: int) -> list[list]:
    """For each dimension the smallest value of every cell but the first.

    A value's cell is ``floor(rows below it * cells / rows)``. Values are counted
    (partial aggregation), then summed in order by range partitions. At most
    ``cells`` values per dimension reach the driver.
    """
    # one narrow table of (dimension, value as order-preserving text)
    each = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("dim"), c.alias("value")) for i, c in enumerate(_texts(df, dims))
    ])).alias("d")).select("d.*").filter("value IS NOT NULL")
    counted = cut(each.groupBy("dim", "value").agg(F.count("*").alias("n")))
    totals = {r.dim: r.n for r in counted.groupBy("dim").agg(F.sum("n").alias("n")).collect()}
    base, at = {}, 0
    for i in range(len(dims)):
        base[i], at = at, at + totals.get(i, 0)
    if not at:
        return [[] for _ in dims]
    lookup = F.create_map(*[F.lit(x) for i in totals for x in (i, base[i])])
    total = F.create_map(*[F.lit(x) for i in totals for x in (i, totals[i])])
    ranked = with_running_total(counted, [F.col("dim"), F.col("value")], "n")
    cell = F.floor((F.col("before") - lookup[F.col("dim")]) * cells / total[F.col("dim")])
    firsts = ranked.groupBy("dim", cell.alias("cell")).agg(F.min("value").alias("value")).collect()
    return [sorted(r.value for r in firsts if r.dim == i and r.cell > 0) for i in range(len(dims))]


def _texts(df: DataFrame, dims: list[str]) -> list[Column]:
    """Each dimension as text in the same order: whole numbers are padded with zeros,
    negative ones counted up from the smallest long."""
    kinds = dict(df.dtypes)
    out = []
    for d in dims:
        if kinds[d] in ("tinyint", "smallint", "int", "bigint"):
            up = F.col(d).cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")
            out.append(F.lpad(up.cast("string"), 20, "0"))
        else:
            out.append(F.col(d).cast("string"))
    return out


def curve_index(cells: list[Column], bits: int) -> Column:
    """Hilbert index of the grid point ``cells`` (``bits`` bits each).

    Skilling's transform (2004): undo the rotations from the highest bit down,
    Gray-encode, then interleave the bits.
    """
    n = len(cells)
    # (bit, dimension) in the order in which rotations are undone
    turns = [(level, i) for level in range(bits - 1, 0, -1) for i in range(n)]

    def turn(x: Column, step: Column) -> Column:
        p = step["p"]
        i = step["i"]
        mine = F.get(x, i)
        high = mine.bitwiseAND(p + 1) != 0
        swap = F.get(x, F.lit(0)).bitwiseXOR(mine).bitwiseAND(p)
        return F.transform(x, lambda v, j: F.when(
            j == 0, v.bitwiseXOR(F.when(high, p).otherwise(swap))).when(
            (j == i) & ~high, v.bitwiseXOR(swap)).otherwise(v))

    def xor(a: Column, b: Column) -> Column:
        return a.bitwiseXOR(b)

    def gray(x: Column) -> Column:
        return F.transform(x, lambda v, j: F.aggregate(F.slice(x, 1, j + 1), F.lit(0), xor))

    levels = F.array(*[F.lit(level) for level in range(bits - 1, 0, -1)])

    def fold(g: Column) -> Column:
        last = F.get(g, F.lit(n - 1))
        t = F.aggregate(levels, F.lit(0), lambda acc, k: F.when(
            F.expr("1").bitwiseAND(F.call_function("shiftright", last, k)) != 0,
            acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1), k) - 1)).otherwise(acc))
        return let(t, lambda v: F.transform(g, lambda u: u.bitwiseXOR(v)))

    def weave(x: Column) -> Column:
        places = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(i).alias("i"))
                           for k in range(bits - 1, -1, -1) for i in range(n)])
        return F.aggregate(places, F.lit(0).cast("long"), lambda acc, s: acc * 2 + F.call_function(
            "shiftright", F.get(x, s["i"]), s["k"]).bitwiseAND(F.lit(1)).cast("long"))

    start = F.array(*[c.cast("int") for c in cells])
    undone = start if not turns else F.aggregate(
        F.array(*[F.struct(F.lit((1 << k) - 1).alias("p"), F.lit(i).alias("i")) for k, i in turns]),
        start, turn)
    return let(undone, lambda x: let(gray(x), lambda g: let(fold(g), weave)))


def hilbert_order(df: DataFrame, dims: list[str], bits: int = 5) -> DataFrame:
    """Adds ``h``, the Hilbert index of the quantised dimensions."""
    borders = cell_borders(df, dims, 1 << bits)
    cells = []
    for c, b in zip(_texts(df, dims), borders):
        steps = sum(((c >= F.lit(v)).cast("int") for v in b), F.lit(0))
        cells.append(F.coalesce(steps, F.lit(0)))
    return df.withColumn("h", curve_index(cells, bits))


def shard_rows(docs: DataFrame, shards: int = 24, bits: int = 5,
               dims: tuple[str, ...] = ("lang", "source", "size")) -> DataFrame:
    """Cuts the Hilbert order of ``docs`` into ``shards`` runs of equal row counts.

    ``docs`` needs ``doc_id``, ``text`` and the dimensions (``size`` is derived).
    Returns ``doc_id, size, text_crc32, h, shard, slot`` and the dimensions; shard
    sizes differ by at most one row, slots run gapless from 0 in curve order.
    """
    rest = [d for d in dims if d != "size"]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = cut(pick(docs, "doc_id", "text", *rest).select(
        "doc_id", *rest, (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32")))
    total = rows.count()
    order = [F.col(c).asc_nulls_first() for c in ("h", "doc_id", "text_crc32", "size", *rest)]
    ranked = with_rank(hilbert_order(rows, list(dims), bits), order)
    # exact whole-number division, so that no shard is off by a rounded quotient
    shard = F.expr(f"rank * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {max(total, 1)} + {shards - 1}) div {shards}")
    return (ranked.withColumn("shard", shard).withColumn("slot", F.col("rank") - first)
            .withColumn("shard", F.col("shard").cast("int")).drop("rank"))
