"""Sharding by a k-d tree over document metadata.

A node holds a range of shards. It is split along its widest dimension (widths are shares of the whole table's extent) at
the weighted median: the point that leaves to the left the bytes of the shards there (half of them, or the smaller half
of an odd number), so leaves come out near the target whatever their number.

Each row has a key per dimension: 24 bits of the coordinate, 18 bits of a hash of the text, 20 bits of a hash of the row.
Rows that tie in a dimension are told apart by the rest of the key, so a value that a third of all rows share is split
like any other. Rows of equal texts that together weigh no more than an eighth of a shard are one point: they share the
least of their coordinates and all bits of their keys, so no cut parts them; heavier groups are split by row. The cut of every node of a level is found at once by histograms:
each pass splits the range that holds the cut into 1,024 bins, whose bytes are combined before they are shuffled, until
the bin at the cut is a sliver of a shard. Passes read a narrow table of the metadata, never texts; nodes and bins stay in
tables, and only a flag per pass reaches the driver.

Slots number the rows of a shard without gaps; they are dealt out in parts by a hash of the row, so no task needs a whole
shard. Null texts weigh nothing but the fixed cost; null metadata sorts first. Repeated rows are placed like different
ones with the same id, side by side. An empty table gives an empty one. Results come with the id alone, so no other column
can clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapline.llm.common import drop_staged, staged, table

BINS, SLIVER, FIXED_BYTES = 1024, 1000, 16
# Share of a shard that rows of equal texts may weigh and still stay together.
TOGETHER = 1 / 8
_SPREAD, _TEXT, _ROW = 24, 18, 20


def text_bytes(text) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def category(column) -> Column:
    """A coordinate for a value without an order: its place on a ring of hashes."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")).cast("double")


def magnitude(column) -> Column:
    """A coordinate for a size: its logarithm."""
    return F.log2(1 + F.greatest(F.coalesce(F.col(column), F.lit(0)), F.lit(0)).cast("double"))


def _points(docs: DataFrame, dims: list[Column], id_col: str, text_col: str, shards: int | None,
            target_bytes: int | None) -> tuple[DataFrame, int]:
    """The narrow table (id, size, checksum, row hash and one key per dimension) and the number of shards."""
    named = [f"_c{i}" for i in range(len(dims))]
    narrow = staged(docs.select(
        F.col(id_col).alias("id"), (text_bytes(F.col(text_col)) + FIXED_BYTES).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("crc"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("same"),
        *(F.coalesce(d.cast("double"), F.lit(0.0)).alias(n) for d, n in zip(dims, named, strict=True)),
    ), "metadata")
    extent = narrow.agg(F.sum("size").alias("total"), *(
        f(n).alias(f"{f.__name__}{n}") for n in named for f in (F.min, F.max))).head()
    total = extent["total"] or 0
    if shards is None:
        shards = max(1, -(-total // target_bytes))
    together = narrow.groupBy("same").agg(F.count("*").alias("n"), F.sum("size").alias("weight"), *(
        F.min(n).alias(f"g{n}") for n in named)).where(
            (F.col("n") > 1) & (F.col("weight") <= TOGETHER * total / shards)).drop("weight")
    narrow = narrow.join(together, "same", "left").withColumns({n: F.coalesce(f"g{n}", n) for n in named})
    own = F.when(F.col("n").isNull(), F.col("row")).otherwise(F.col("same"))
    tie = F.shiftleft(F.col("crc").bitwiseAND((1 << _TEXT) - 1), _ROW).bitwiseOR(own.bitwiseAND((1 << _ROW) - 1))
    keys = []
    for i, n in enumerate(named):
        low, high = extent[f"min{n}"] or 0.0, extent[f"max{n}"] or 0.0
        place = F.lit(0) if high <= low else (F.col(n) - low) / (high - low) * ((1 << _SPREAD) - 1)
        keys.append(F.shiftleft(place.cast("long"), _TEXT + _ROW).bitwiseOR(tie).alias(f"k{i}"))
    return narrow.select("id", "size", "crc", "row", *keys), int(shards)


def _split(points: DataFrame, dims: int) -> DataFrame:
    """One level: every node of more than one shard becomes two."""
    open_nodes = points.where("leaves > 1")
    span = _TEXT + _ROW
    boxes = open_nodes.groupBy("node", "leaves").agg(
        F.sum("size").alias("total"), *(f(f"k{i}").alias(f"{f.__name__}{i}") for i in range(dims) for f in (F.min, F.max)))
    width = [F.shiftright(f"max{i}", span) - F.shiftright(f"min{i}", span) for i in range(dims)]
    widest = F.greatest(*width) if dims > 1 else width[0]
    dim = reduce(lambda rest, i: F.when(width[i] == widest, i).otherwise(rest), reversed(range(dims)), F.lit(0))

    def of_dim(name: str) -> Column:
        return reduce(lambda rest, i: F.when(F.col("dim") == i, F.col(f"{name}{i}")).otherwise(rest),
                      range(1, dims), F.col(f"{name}0"))

    cuts = staged(boxes.withColumn("dim", dim).select(
        "node", "leaves", "dim", "total", of_dim("min").alias("low"), (of_dim("max") + 1).alias("high"),
        F.lit(0).cast("long").alias("before"),
        (F.col("total") * F.floor(F.col("leaves") / 2) / F.col("leaves")).alias("wanted"),
        F.col("total").alias("inside"), F.lit(2).cast("long").alias("many")), "cuts")
    coarse = (F.col("many") > 1) & (F.col("high") - F.col("low") > 1) & (
        F.col("inside") * SLIVER * F.col("leaves") > F.col("total"))
    while cuts.where(coarse).limit(1).count():
        step = F.greatest(F.lit(1), F.ceil((F.col("high") - F.col("low")) / BINS)).cast("long")
        bins = (
            open_nodes.drop("leaves").join(cuts.where(coarse).withColumn("step", step), "node")
            .withColumn("k", of_dim("k")).where("k >= low and k < high")
            .groupBy("node", "leaves", "dim", "total", "low", "high", "before", "wanted", "step",
                     F.floor((F.col("k") - F.col("low")) / F.col("step")).alias("bin"))
            .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        )
        upto = F.sum("bytes").over(W.partitionBy("node").orderBy("bin"))
        first = W.partitionBy("node").orderBy("bin")
        finer = (
            bins.withColumn("upto", F.col("before") + upto).where("upto >= wanted")
            .withColumn("nth", F.row_number().over(first)).where("nth = 1")
            .select("node", "leaves", "dim", "total", (F.col("low") + F.col("bin") * F.col("step")).alias("low"),
                    F.least("high", F.col("low") + (F.col("bin") + 1) * F.col("step")).alias("high"),
                    (F.col("upto") - F.col("bytes")).alias("before"), "wanted", F.col("bytes").alias("inside"),
                    F.col("rows").alias("many"))
        )
        then, cuts = cuts, staged(finer.union(cuts.where(~coarse)), "cuts")
        drop_staged(then)
    # The bin at the cut goes to the side that it lies nearer to.
    at = F.when((F.col("wanted") - F.col("before")) * 2 >= F.col("inside"), F.col("high")).otherwise(F.col("low"))
    met = points.join(cuts.select("node", "dim", at.alias("cut")), "node", "left")
    left = F.floor(F.col("leaves") / 2).cast("int")
    right = of_dim("k") >= F.col("cut")
    return met.select(
        "id", "size", "crc", "row", *(f"k{i}" for i in range(dims)),
        F.when(right, F.col("node") + left).otherwise(F.col("node")).alias("node"),
        F.when(right, F.col("leaves") - left).when(~right, left).otherwise(F.col("leaves")).cast("int").alias("leaves"),
    )


def kd_shards(docs: DataFrame, dims: list[Column], shards: int | None = None, target_bytes: int | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row: near equal bytes in `shards` shards, or in as many as it takes
    for a shard to hold about `target_bytes`."""
    points, shards = _points(docs, dims, id_col, text_col, shards, target_bytes)
    now = staged(points.withColumns({"node": F.lit(0), "leaves": F.lit(shards)}), "tree")
    for _ in range((shards - 1).bit_length()):
        then, now = now, staged(_split(now, len(dims)), "tree")
        drop_staged(then)
    part = F.pmod(F.col("row"), F.lit(64))
    rows = now.withColumn("part", part)
    offsets = rows.groupBy("node", "part").agg(F.count("*").alias("n")).select(
        "node", "part", (F.sum("n").over(W.partitionBy("node").orderBy("part")) - F.col("n")).alias("offset"))
    within = F.row_number().over(W.partitionBy("node", "part").orderBy("row", "id")) - 1
    return rows.withColumn("within", within).join(offsets, ["node", "part"]).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.col("node").cast("int").alias("shard"),
        (F.col("offset") + F.col("within")).cast("long").alias("slot"))


def write_shards(docs: DataFrame, placed: DataFrame, folder: str, id_col: str = "doc_id") -> None:
    """Write the rows of docs as Parquet, a folder per shard, each in order of its slots."""
    docs.join(placed.select(id_col, "shard", "slot"), id_col).repartition("shard").sortWithinPartitions(
        "shard", "slot").write.partitionBy("shard").parquet(folder)


def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    placed = kd_shards(docs, [magnitude("n_chars"), category("source"), category("lang")], shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
