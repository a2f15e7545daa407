"""K-d tree sharding of a table by its metadata (operator 1).

A cell of rows is split at a weighted median along its widest dimension (its
extent as a share of the table's), again and again, until the leaves reach the
target bytes.  All cells of a level are split together.  A median is found by
narrowing histograms that Spark sums per cell, over the dimension, then the
text's checksum, then the row's number, so it is exact to the row however many
rows tie; one row per cell reaches the driver in each pass.

Defined cases: null metadata lies at the low end of its dimension; a null text
weighs one byte, as an empty one; rows that tie in a dimension are ordered by
checksum, and equal texts are cut apart only if they are more than a hundredth
of a leaf or differ in a dimension; an empty table has no rows to place; without any dimension the checksum splits; repeated rows
are placed each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, TimestampType

from tiersmith.llm.common import gapless_rank, materialize, with_rid

BINS = 4096
# Leaves, and with them the plan on the driver and the rows broadcast, are at most this many.
MAX_LEAVES = 65_536
# Rows of equal dimension and checksum stay together up to this share of a leaf's bytes.
GROUP_SHARE = 0.01
_FAR = 1 << 60


def coordinate(column: str, kind: DataType) -> Column:
    """A dimension as a long: integers as they are, other numbers and times to a
    thousandth, anything else by the checksum of its text (an order of no meaning)."""
    c = F.col(f"`{column}`")
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        value, low = F.greatest(F.least(c.cast("long"), F.lit(_FAR)), F.lit(-_FAR)), -_FAR
    elif isinstance(kind, (FloatType, DoubleType, DecimalType, TimestampType, DateType)):
        number = F.unix_date(c).cast("double") if isinstance(kind, DateType) else c.cast("double")
        number = F.when(~F.isnan(number), F.greatest(F.least(number * 1000, F.lit(float(_FAR))), F.lit(float(-_FAR))))
        value, low = F.floor(number).cast("long"), -_FAR
    else:
        value, low = F.crc32(c.cast("string").cast("binary")), -1
    return F.coalesce(value, F.lit(low).cast("long"))


def _split(rows: DataFrame, cells: dict[int, dict]) -> None:
    """Sets each cell's ``cut``: the last (dimension, checksum, row id) of its left part."""
    spark = rows.sparkSession
    crc_most, rid_most = (1 << 32) - 1, rows.agg(F.max("_rid")).first()[0]
    for c in cells.values():
        c.update(at=0, fixed=[0, 0], low=c["least"], high=c["most"], before=0, cut=None)
    while True:
        some = {k: c for k, c in cells.items() if c["cut"] is None}
        if not some:
            return
        for c in some.values():
            c["step"] = -(-(c["high"] - c["low"] + 1) // BINS)
        plan = spark.createDataFrame(
            [(k, c["dim"], c["at"], *c["fixed"], c["low"], c["high"], c["step"], c["before"], c["goal"]) for k, c in some.items()],
            "cell int, dim int, at int, f0 long, f1 long, low long, high long, step long, before long, goal long")
        met = rows.join(F.broadcast(plan), "cell").withColumn("v0", F.get("dims", F.col("dim")))
        value = F.when(F.col("at") == 0, F.col("v0")).when(F.col("at") == 1, F.col("_crc")).otherwise(F.col("_rid"))
        met = (met.withColumn("v", value).where("v between low and high")
               .where("(at < 1 or v0 = f0) and (at < 2 or _crc = f1)"))
        bins = met.groupBy("cell", F.expr("(v - low) div step").alias("bin"), "before", "goal").agg(F.sum("_size").alias("w"))
        upto = Window.partitionBy("cell").orderBy("bin")
        found = (bins.withColumn("sum", F.col("before") + F.sum("w").over(upto)).where("sum >= goal")
                 .groupBy("cell").agg(F.min_by(F.struct("bin", "w", "sum"), "bin").alias("b")))
        for cell, b in found.collect():
            c = cells[cell]
            c["low"] += b["bin"] * c["step"]
            c["high"] = min(c["high"], c["low"] + c["step"] - 1)
            c["before"] = b["sum"] - b["w"]
            if b["sum"] == c["goal"]:  # the bin ends where the cut should be
                c["cut"] = (*c["fixed"][: c["at"]], c["high"], *(crc_most, rid_most)[c["at"]:])
            elif c["step"] == 1 and c["at"] == 1 and b["w"] <= c["group"]:  # equal texts: together, on the nearer side
                nearer = c["goal"] - c["before"] >= b["sum"] - c["goal"]
                c["cut"] = (c["fixed"][0], c["low"] if nearer else c["low"] - 1, rid_most)
            elif c["step"] == 1 and c["at"] < 2:  # rows that tie: go on to the next component
                c["fixed"][c["at"]] = c["low"]
                c["at"] += 1
                c["low"], c["high"] = (0, crc_most) if c["at"] == 1 else (0, rid_most)
            elif c["step"] == 1:  # one row is left: to the side that comes out nearer
                nearer = c["goal"] - c["before"] >= b["sum"] - c["goal"]
                c["cut"] = (*c["fixed"], c["low"] if nearer else c["low"] - 1)


def kd_shards(df: DataFrame, keep: Sequence[str], target_bytes: int | None = None, shards: int | None = None,
              text: str = "text", dims: Sequence[str] | None = None) -> DataFrame:
    """``keep``, ``size`` (UTF-8 bytes of the text plus 1), ``text_crc32``,
    ``shard`` (0 to leaves - 1) and ``slot`` (gapless within the shard).

    The number of leaves is given, or follows from ``target_bytes``; ``dims``
    are the metadata columns, by default all but the text."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    dims = [c for c in kinds if c != text] if dims is None else list(dims)
    coordinates = [coordinate(c, kinds[c]) for c in dims] or [F.lit(0).cast("long")]
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = materialize(with_rid(df.select(
        *keep, (F.octet_length(whole) + F.lit(1).cast("long")).alias("_size"), F.crc32(whole.cast("binary")).alias("_crc"),
        F.array(*coordinates).alias("dims"))))
    n = len(coordinates)
    total = rows.agg(F.sum("_size")).first()[0] or 0
    leaves = shards or max(1, -(-total // target_bytes))
    if leaves > MAX_LEAVES:
        raise ValueError(f"{leaves} leaves: raise target_bytes, at most {MAX_LEAVES} are planned at a time")
    parts = {0: leaves}  # first leaf of a cell -> leaves in it
    cells = rows.withColumn("cell", F.lit(0))
    spans = None
    level = 0
    while total and any(k > 1 for k in parts.values()):
        extents = [f(F.get("dims", F.lit(i))).alias(f"{name}{i}") for i in range(n) for f, name in ((F.min, "a"), (F.max, "b"))]
        stats = {r["cell"]: r for r in cells.groupBy("cell").agg(F.sum("_size").alias("w"), *extents).collect()}
        if spans is None:
            spans = [max(1, stats[0][f"b{i}"] - stats[0][f"a{i}"]) for i in range(n)]
        todo = {}
        for cell, r in stats.items():
            if parts[cell] > 1:
                dim = max(range(n), key=lambda i: ((r[f"b{i}"] - r[f"a{i}"]) / spans[i], -i))
                left = parts[cell] // 2
                todo[cell] = {"dim": dim, "least": r[f"a{dim}"], "most": r[f"b{dim}"], "left": left,
                              "goal": max(1, round(r["w"] * left / parts[cell])), "group": GROUP_SHARE * total / leaves}
        if not todo:
            break  # the cells that should split are empty
        _split(cells, todo)
        cuts = rows.sparkSession.createDataFrame(
            [(k, c["dim"], *map(int, c["cut"]), c["left"]) for k, c in todo.items()],
            "cell int, dim int, c0 long, c1 long, c2 long, left int")
        v0 = F.get("dims", F.col("dim"))
        past = (v0 > F.col("c0")) | ((v0 == F.col("c0")) & ((F.col("_crc") > F.col("c1")) | ((F.col("_crc") == F.col("c1")) & (F.col("_rid") > F.col("c2")))))
        cells = (cells.join(F.broadcast(cuts), "cell", "left")
                 .withColumn("cell", F.col("cell") + F.when(F.col("dim").isNotNull() & past, F.col("left")).otherwise(0))
                 .select(*rows.columns, "cell"))
        level += 1
        if level % 4 == 0:
            cells = materialize(cells)
        parts = {k: v for cell, v0_ in parts.items() for k, v in (
            ((cell, todo[cell]["left"]), (cell + todo[cell]["left"], v0_ - todo[cell]["left"])) if cell in todo
            else ((cell, v0_ if cell in stats else 1),))}
    named = cells.select(*keep, "_rid", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.col("cell").alias("shard"))
    return gapless_rank(named, ["shard"], "slot").select(*keep, "size", "text_crc32", "shard", "slot")
