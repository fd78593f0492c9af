"""Mixing sources to target weights by a low-discrepancy schedule of blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceway.llm.arrow import saved

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
#: Words of a block. Every source's last block is cut at its target, so the mix does not depend on it but for order.
BLOCK_WORDS = 512
#: Slots are drawn in runs of so many, each numbered by itself, with the counts of earlier runs added.
RUN = 65_536
#: Documents of a source are shuffled by a hash of 60 bits; so many of them make its buckets.
BUCKET_BITS = 12
CELLS = 4_096
#: Of a slot's number; points are exact up to 2**BITS slots.
BITS = 40


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def shares(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> list[float]:
    """Each source's words: all words by weight, no source above ``most`` times its own, the excess shared again."""
    total = float(sum(n for _, n in sizes))
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    target, free = [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        left = total - sum(target[i] for i in range(len(sizes)) if i not in free)
        whole = sum(weight[i] for i in free)
        above = {i for i in free if left * weight[i] / whole > most * sizes[i][1]}
        for i in free:
            target[i] = float(most * sizes[i][1]) if i in above else left * weight[i] / whole
        if not above:
            break
        free -= above
    return target


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, block_words: int = BLOCK_WORDS, seed: int = 17,
    row_col: str | None = None,
) -> DataFrame:
    """Per row: id, ``size``, ``source_size``, ``target``, ``taken`` (words the mix takes of it, repeats counted:
    ``taken // size`` times all of it, and of one document per source its first ``taken % size`` words once more).

    Sources in code point order, null last, weigh ``weights`` in turn; targets are ``shares``. Point i of the van der
    Corput sequence falls through the cumulative weights on a source; the source's r-th slot takes block r of its
    shuffled words, from the start again after the last, until its target is met (whole words, rounded down).
    No document is taken more than ``most`` times. Order and blocks depend on the rows' contents and ``seed`` only.
    Null or blank texts have size 0 and nothing taken; null ids are shuffled by their text; repeated rows are
    documents of their own; other columns are not read. An empty table gives no rows. ``row_col``, a number of the row,
    comes back beside its id where it is given.
    """
    kept = [F.col(row_col).alias("row")] if row_col else []
    also = ["row"] if row_col else []
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null|"), F.coalesce(F.col(text_col), F.lit(""))))
    rows = docs.select(
        *kept, F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), name)), 1, 15), 16, 10).cast("long").alias("order"),
    )
    rows = saved(rows.withColumn("bucket", F.shiftright("order", 60 - BUCKET_BITS)), "sizes")
    table = _sources(rows, weights, most)
    spark = docs.sparkSession
    if not table:
        numbers = f"{row_col} long, " if row_col else ""
        return spark.createDataFrame([], f"{numbers}{id_col} {rows.schema['id'].dataType.simpleString()}, size long, source_size long, target double, taken long")
    plan = spark.createDataFrame(table, "source string, s int, source_size long, target double")
    takes = _takes(spark, table, block_words)
    rows = rows.join(F.broadcast(plan.select("source", "s", "source_size", "target")), rows["source"].eqNullSafe(plan["source"])).drop("source")
    # Where each document begins in its source's shuffled words: bucket sums first, so that no source is one task.
    sums = rows.groupBy("s", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("s", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("s", "bucket").orderBy("order", "id", "size", *also).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("begin", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(sums, ["s", "bucket"])
    placed = placed.withColumn("begin", F.col("begin") + F.col("base"))
    pieces = placed.where("size > 0").select(
        *also, "id", "size", "source_size", "target", "s", "begin",
        F.explode(F.sequence(F.floor(F.col("begin") / block_words), F.floor((F.col("begin") + F.col("size") - 1) / block_words))).alias("block"),
    )
    joined = pieces.join(takes, ["s", "block"], "left")
    from_ = F.greatest("begin", F.col("block") * block_words)
    to = F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block_words)
    cut = F.col("block") * block_words + F.coalesce("part", F.lit(0))
    full = F.coalesce("full", F.lit(0))
    taken = full * (to - from_) + F.greatest(F.lit(0), F.least(to, cut) - from_)
    summed = joined.groupBy("s", "begin", *also, "id", "size", "source_size", "target").agg(
        F.sum(taken).alias("taken")
    )
    empty = placed.where("size = 0").select(*also, "id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    out = summed.select(empty.columns).unionByName(empty)
    return out.withColumnsRenamed({"id": id_col, **({"row": row_col} if row_col else {})})


def applied(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The mixed corpus: every document as often as it was taken, and a partly taken one cut after its last taken word.

    ``mixed`` is what ``mix`` gave for ``docs``, whose columns it returns. Documents of which nothing is taken are left
    out. ``length_col`` is counted anew for a cut text. Rows of one id share its takes; give the ``row_col`` of ``mix`` as
    ``id_col`` to tell them apart.
    """
    takes = mixed.where("taken > 0").groupBy(F.col(id_col).alias("_id")).agg(F.max("size").alias("_size"), F.max("taken").alias("_taken"))
    rows = docs.join(takes, docs[id_col].eqNullSafe(F.col("_id")))
    whole, rest = F.floor(F.col("_taken") / F.col("_size")).cast("int"), F.col("_taken") % F.col("_size")
    copies = F.concat(F.array_repeat(F.lit(0).cast("long"), whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    rows = rows.withColumn("_words", F.explode(copies))
    # Pieces of one word each, with the white space before it.
    pieces = F.split(text_col, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut = F.when(F.col("_words") > 0, F.array_join(F.slice(pieces, 1, F.col("_words").cast("int")), "")).otherwise(F.col(text_col))
    rows = rows.withColumn(text_col, cut)
    if length_col in docs.columns:
        rows = rows.withColumn(length_col, F.when(F.col("_words") > 0, F.length(text_col)).otherwise(F.col(length_col)).cast(docs.schema[length_col].dataType))
    return rows.select(docs.columns)


def _sources(rows: DataFrame, weights: tuple[int, ...], most: int) -> list[tuple]:
    """One tuple per source: they are named by the caller's table, of which a mix has few (thousands at most)."""
    sizes = rows.groupBy("source").agg(F.sum("size")).collect()
    known = sorted(((r[0], int(r[1])) for r in sizes), key=lambda x: (x[0] is None, (x[0] or "").encode("utf-32-be")))
    target = shares(known, weights, most)
    return [(name, s, size, words) for s, ((name, size), words) in enumerate(zip(known, target))]


def _slots(plan: list[tuple], block_words: int) -> list[float]:
    """How many slots each source gets: what its target needs, and enough more for the sequence's discrepancy."""
    out = []
    for _, _, size, words in plan:
        blocks = -(-size // block_words)
        rounds, rest = divmod(int(words), size) if size else (0, 0)
        need = rounds * blocks + -(-rest // block_words)
        out.append(need * 1.02 + 32 if need else 0.0)
    return out


def _takes(spark: SparkSession, table: list[tuple], block_words: int) -> DataFrame:
    """Per source and block: ``full`` takes, and ``part``, the words of a last take that the target cuts."""
    wanted = _slots(table, block_words)
    whole, low, cells = sum(wanted), 0.0, []
    for (_, s, size, words), slots in zip(table, wanted):
        high = low + slots
        if slots:  # cells of the unit interval make the lookup an equality
            first, last = int(low / whole * CELLS), min(CELLS - 1, int(high / whole * CELLS))
            cells += [(c, s, size, int(words), low / whole, high / whole if high < whole else 2.0) for c in range(first, last + 1)]
        low = high
    owner = spark.createDataFrame(cells, "cell long, s int, source_size long, goal long, low double, high double")
    point = F.conv(F.reverse(F.lpad(F.bin("id"), BITS, "0")), 2, 10).cast("double") / float(1 << BITS)  # van der Corput
    drawn = spark.range(int(whole) + 1).withColumn("u", point).withColumn("cell", F.floor(F.col("u") * CELLS))
    drawn = drawn.join(owner, "cell").where((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high")))
    drawn = drawn.select("id", "s", "source_size", "goal", F.floor(F.col("id") / RUN).alias("run"))
    counts = drawn.groupBy("s", "run").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("s").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("s", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("s", "run").orderBy("id")) - 1
    ranked = drawn.withColumn("rank", rank).join(counts, ["s", "run"]).withColumn("rank", F.col("rank") + F.col("base"))
    blocks = F.ceil(F.col("source_size") / block_words)
    block = F.pmod(F.col("rank"), blocks)
    start = F.floor(F.col("rank") / blocks) * F.col("source_size") + block * block_words
    length = F.least(F.lit(block_words).cast("long"), F.col("source_size") - block * block_words)
    got = F.least(start + length, F.col("goal")) - start
    slot = ranked.select("s", block.alias("block"), got.alias("got"), length.alias("length")).where("got > 0")
    return slot.groupBy("s", "block").agg(
        F.sum((F.col("got") == F.col("length")).cast("long")).alias("full"),
        F.coalesce(F.sum(F.when(F.col("got") < F.col("length"), F.col("got"))), F.lit(0)).alias("part"),
    )
