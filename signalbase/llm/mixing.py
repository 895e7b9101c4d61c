"""Mixing of sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage
from .common import GAP, prefix_sums, word_count

BLOCK_ROWS = 4096


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """Per source of ``sized(key, source, size)``: rows, source_size and target, in words.

    Sources in order of code points, null last, weigh ``weights`` in turn and share all words by weight. A target stops at
    ``most`` times the source's size; what exceeds it goes to the others by weight until none is above. With the sources in
    order of size per weight, those that stop come first, so one running sum finds the level of the others. The work
    is on one row per source.
    """
    totals = sized.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"),
                                      F.count("*").alias("n_rows"))
    ranked = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    weighed = (ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                                        ((F.col("rank") - 1) % len(weights) + 1).cast("int")).cast("double"))
               .withColumn("cap", F.col("source_size") * F.lit(float(most))))
    order = [F.col("cap") / F.col("weight"), F.col("rank")]
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
             / F.sum("weight").over(later))
    found = weighed.withColumn("level", level)
    free = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))
    return (found.withColumn("free", F.min(free).over(everything))
            .withColumn("target", F.least("cap", F.coalesce(F.col("free.level") * F.col("weight"), F.col("cap"))))
            .select("key", "source_size", "n_rows", "weight", "target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, seed: str = "0", id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row: doc_id, source, size (words), source_size, weight, target, copies (whole ones), cut (words of a last part), taken.

    Rows get a hash-random key from their id and are sorted by it within their source; a source of size S and budget
    floor(target) takes all its rows floor(budget / S) times, then rows from the start of the order while the words
    before them fit, the last one cut so that the source meets its budget exactly. Sums of preceding words are taken
    in blocks of about ``block_rows`` rows of the key order, so a source may hold any share of the rows.

    A null text has size 0 and takes 0 words. Null sources form one source, sorted last. Rows with null or repeated ids
    take part like others; equal rows are interchangeable. Other columns are not read. An empty table, or one without words,
    gives rows that take nothing.
    """
    sized = stage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                              word_count(F.col(text_col)).alias("size"))
                  .withColumn("key", F.when(F.col("source").isNull(), F.lit("-"))
                              .otherwise(F.concat(F.lit("="), F.col("source").cast("string")))), "sizes")
    targets = stage(source_targets(sized, weights, most), "targets")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = (sized.join(targets, "key").withColumn("digest", digest)
            .withColumn("block", F.floor(F.conv(F.substring("digest", 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)
                                         * F.ceil(F.col("n_rows") / block_rows))))
    summed = prefix_sums(rows, "key", "block", ["digest", "doc_id", "size"], "size", "before")
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    left = (F.col("rest") - F.col("before"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    whole = (F.col("size") > 0) & (part == F.col("size")) | (F.col("size") == 0) & (left > 0)
    return (summed.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
            .select("doc_id", "source", "size", "source_size", "weight", "target",
                    (F.col("epochs") + F.when(whole, 1).otherwise(0)).alias("copies"),
                    F.when(whole, F.lit(0)).otherwise(part).cast("long").alias("cut"),
                    (F.col("epochs") * F.col("size") + part).cast("long").alias("taken")))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              **options) -> DataFrame:
    """The mixed corpus: rows of ``docs`` repeated as often as ``mix`` takes them, the last one of a source cut to its words.

    Rows are matched to their plan by id, source and size; which of several rows equal in these takes more is decided by a
    hash of the whole row. Both sides are counted first (a plan has at most three outcomes for such rows), so rows without an
    id, or of one id, make neither pairs nor one large group. Texts are shuffled once, by the hash too; rows equal in all
    columns travel as one. Columns keep their names and types.
    """
    names = docs.columns
    key = ["_id", "_source", "_size"]

    def identity(column: str) -> F.Column:
        return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))

    def spans(rows: DataFrame, *order: F.Column) -> DataFrame:
        """The places (from, to] that each row's ``_n`` equal ones take among those of its key."""
        before = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn("_to", F.sum("_n").over(before)).withColumn("_from", F.col("_to") - F.col("_n")).drop("_n")

    plan = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options).select(
        identity("doc_id").alias("_id"), identity("source").alias("_source"), F.col("size").alias("_size"), "copies", "cut")
    outcomes = spans(plan.groupBy(*key, "copies", "cut").agg(F.count("*").alias("_n")), F.desc("copies"), F.desc("cut"))
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    rows = docs.select(row.alias("_row"), identity(id_col).alias("_id"), identity(source_col).alias("_source"),
                       word_count(F.col(text_col)).alias("_size"), F.xxhash64(row).alias("_tie"))
    kinds = spans(rows.groupBy(*key, "_tie").agg(F.count("*").alias("_n")), F.col("_tie"))
    met = kinds.join(outcomes.select(*key, "copies", "cut", F.col("_from").alias("_a"), F.col("_to").alias("_b")), key)
    common = (F.least("_to", "_b") - F.greatest("_from", "_a")).cast("int")
    taken = (met.withColumn("_common", common).where("_common > 0").groupBy(*key, "_tie")
             .agg(F.sum(F.col("copies") * F.col("_common")).alias("copies"), F.max("cut").alias("cut")).where("copies > 0 OR cut > 0"))
    both = (rows.groupBy(*key, "_tie").agg(F.first("_row").alias("_row")).join(stage(taken, "taken"), [*key, "_tie"])
            .select("_row", "copies", "cut"))
    text = F.col(f"_row.`{text_col}`")
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    parts = F.concat(F.array_repeat(F.lit(False), F.col("copies").cast("int")),
                     F.when(F.col("cut") > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")))
    cut = F.array_join(F.slice(words, 1, F.greatest(F.col("cut"), F.lit(1)).cast("int")), " ")
    return (both.withColumn("_part", F.explode(parts))
            .select(*[F.when(F.col("_part"), cut).otherwise(text).alias(c) if c == text_col
                      else F.col(f"_row.`{c}`").alias(c) for c in names]))
