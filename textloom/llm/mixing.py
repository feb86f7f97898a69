"""Mixing sources to target weights by Pareto order sampling (Rosén, 1997), on DataFrame operations only.

A source's target over its size is the number of copies each of its documents should have: the whole part are certain
copies, the rest is the inclusion probability p of one more. Documents are ranked by their random odds over their inclusion
odds, (u / (1 - u)) / (p / (1 - p)), and taken in that order until the source's words are filled: a sample of fixed size in
words. The words still missing before the document that would not fit go to the one later document that closes the gap best.

The order is found without sorting a source in one task: words are summed by 256 classes of the rank, then by 256 classes
within the one where the sum is reached, and only documents of that last class are sorted.

Random numbers come from md5 of seed and id, so reruns agree and other engines can repeat them.

Defined results: a null text has size 0; null sources are one source, last; sources of size 0 get target 0; rows of equal id
are taken or left together; a null id draws its number from its text; an empty table gives an empty result.
The table of sources (three numbers a source) is ranked in one task; everything else is dealt by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import Scratch, word_count

WEIGHTS, TOTAL, MOST, SEED = (3, 1, 2), 1.5, 2.0, "42"
CLASSES = 256


def uniform(id_: Column, text: Column, seed: str = SEED) -> Column:
    """A number inside (0, 1) from 52 bits of md5."""
    key = F.coalesce(id_.cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    x = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key).cast("binary")), 1, 13), 16, 10).cast("double")
    return (x + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(per: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size): shares of ``total`` times all words by weight, none above ``most`` times its size.

    Resharing the excess by weight until none is above is the same as one level L with target = min(cap, L * weight):
    in order of cap / weight, L is what remains per weight at the first source that it doesn't fill.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    r = per.withColumn("r", F.row_number().over(by_name))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("r") - 1, F.lit(len(weights))) + 1).cast("int"))
    r = r.withColumn("w", w).withColumn("cap", F.lit(most) * F.col("source_size"))
    fill = Window.orderBy(F.col("cap") / F.col("w"), "r")
    every = Window.orderBy(F.col("cap") / F.col("w"), "r").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    r = r.withColumn("k", F.row_number().over(fill))
    r = r.withColumn("before", F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    r = r.withColumn("left_w", F.sum("w").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    r = r.withColumn("all", F.lit(total) * F.sum("source_size").over(every))
    r = r.withColumn("level", (F.col("all") - F.col("before")) / F.col("left_w"))
    first = F.min(F.when(F.col("level") < F.col("cap") / F.col("w"), F.struct("k", "level"))).over(every)
    r = r.withColumn("first", first)
    target = F.when(F.col("first").isNull() | (F.col("k") < F.col("first.k")), F.col("cap")).otherwise(F.col("first.level") * F.col("w"))
    return r.select("source", "source_size", target.alias("target"))


def _odds(u: Column, p: Column) -> Column:
    return F.try_divide(u / (1 - u), p / (1 - p))  # null where p is 0: no extra copy


def plan(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(sized documents, one row per source with its target and what decides about a document)."""
    sized = scratch.save(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), uniform(F.col(id_col), F.col(text_col)).alias("u")), "sized")
    t = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    t = t.withColumn("copies", F.floor(ratio)).withColumn("p", ratio - F.floor(ratio)).withColumn("fill", F.col("target") - F.col("copies") * F.col("source_size"))
    t = scratch.save(t, "sources")
    part = t.where("p > 0").select(F.col("source").alias("s"), "p", "fill")
    q = sized.join(part, F.col("source").eqNullSafe(F.col("s"))).withColumn("q", _odds(F.col("u"), F.col("p")))
    fine = F.least(F.floor(F.col("q") / (1 + F.col("q")) * (CLASSES * CLASSES)), F.lit(CLASSES * CLASSES - 1))
    q = q.select("s", "fill", "id", "size", "q", fine.alias("fine"), F.floor(fine / CLASSES).alias("coarse"))

    def reached(sums: DataFrame, by: str, names: tuple[str, str]) -> DataFrame:
        """The class in which the running sum passes what there is to fill, and the sum before it."""
        w = Window.partitionBy("s").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = sums.withColumn("run", F.col("base") + F.sum("n").over(w))
        return run.where(F.col("run") > F.col("fill")).groupBy("s").agg(F.min(F.struct(F.col(by).alias("c"), (F.col("run") - F.col("n")).alias("b"))).alias("x")).select("s", F.col("x.c").alias(names[0]), F.col("x.b").alias(names[1]))

    one = reached(q.groupBy("s", "fill", "coarse").agg(F.sum("size").alias("n")).withColumn("base", F.lit(0).cast("long")), "coarse", ("at", "before"))
    one = scratch.save(one, "coarse").withColumnRenamed("s", "s1")
    inside = q.join(one, F.col("s").eqNullSafe(F.col("s1")) & (F.col("coarse") == F.col("at")))
    two = reached(inside.groupBy("s", "fill", "fine", F.col("before").alias("base")).agg(F.sum("size").alias("n")), "fine", ("at", "before"))
    two = scratch.save(two, "fine").withColumnRenamed("s", "s1")
    last = q.join(two, F.col("s").eqNullSafe(F.col("s1")) & (F.col("fine") == F.col("at")))
    w = Window.partitionBy("s").orderBy("q", "id")  # rows of equal rank count together
    last = last.withColumn("run", F.col("before") + F.sum("size").over(w))
    fits = F.col("run") <= F.col("fill")
    cut = last.groupBy("s", "fill", "at", "before").agg(F.max(F.when(fits, F.struct("q", "id"))).alias("cut"), F.max(F.when(fits, F.col("run"))).alias("run"))
    cut = cut.select(F.col("s").alias("s1"), "at", "cut", (F.col("fill") - F.coalesce("run", "before")).alias("gap"))
    cut = scratch.save(cut, "cut")
    later = q.join(cut, F.col("s").eqNullSafe(F.col("s1"))).where((F.col("fine") > F.col("at")) | (F.col("fine") == F.col("at")) & (F.col("cut").isNull() | (F.struct("q", "id") > F.col("cut"))))
    off = F.abs(F.col("size") - F.col("gap"))
    close = later.where(off < F.col("gap")).groupBy("s").agg(F.min(F.struct(off.alias("off"), "q", "id")).alias("c")).select(F.col("s").alias("s2"), F.struct("c.q", "c.id").alias("close"))
    decided = t.join(cut, F.col("source").eqNullSafe(F.col("s1")), "left").join(close, F.col("source").eqNullSafe(F.col("s2")), "left")
    decided = scratch.save(decided.select("source", "source_size", "target", "copies", "p", "at", "cut", "close"), "decided")
    return sized, decided


def copies_taken(u: Column, id_: Column) -> Column:
    """Copies of a document, given its number and the columns of its source's row."""
    q = _odds(u, F.col("p"))
    fine = F.least(F.floor(q / (1 + q) * (CLASSES * CLASSES)), F.lit(CLASSES * CLASSES - 1))
    rank = F.struct(q.alias("q"), id_.alias("id"))
    inside = (fine < F.col("at")) | (fine == F.col("at")) & (rank <= F.col("cut"))
    extra = (F.col("p") > 0) & (F.coalesce(inside, F.lit(False)) | F.coalesce(rank == F.col("close"), F.lit(False)))
    return F.col("copies") + F.when(extra, 1).otherwise(0)


def mix_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, size, source_size, target of its source, and the words that the mix takes of it, repeats counted."""
    sized, decided = plan(docs, Scratch(docs.sparkSession, "mixing"), id_col, text_col, source_col)
    d = decided.withColumnRenamed("source", "s")
    both = sized.join(d, F.col("source").eqNullSafe(F.col("s")))
    return both.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * copies_taken(F.col("u"), F.col("id"))).cast("long").alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: the documents, all columns, each as often as it is taken."""
    _, decided = plan(docs, Scratch(docs.sparkSession, "mix"), id_col, text_col, source_col)
    pre = "__mix_"
    names = docs.columns
    d = decided.select(F.col("source").alias(pre + "s"), F.struct("copies", "p", "at", "cut", "close").alias(pre + "d"))
    both = docs.join(d, F.col(source_col).eqNullSafe(F.col(pre + "s")))
    u = uniform(F.col(id_col), F.col(text_col))
    both = both.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(pre + "d.*"), u.alias("u"), F.col(id_col).alias("id"))
    n = copies_taken(F.col("u"), F.col("id"))
    return both.select("row", n.cast("int").alias("n")).where("n > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")
