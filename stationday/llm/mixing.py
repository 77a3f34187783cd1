"""Mixing sources to target weights by pivotal dependent rounding.

A document's copy fraction is its source's target divided by its source's
size. Its whole part is taken outright. What is left is a probability in
(0, 1) that dependent rounding turns into 0 or 1: two documents at a time
exchange words, in a random direction whose odds keep both expectations, until
one of them is integral; the other goes on to the next partner. The words of a
source that the mix takes therefore stay at their target, up to one document,
whatever the sizes of its documents, and each document's expected number of
copies is its fraction.

The work is a reduction tree. Each level deals the undecided documents of
every source into groups of about ``GROUP`` and folds each group to at most
one undecided document, so the largest source is split like any other and no
group grows with the data. The levels are as many as the largest source needs.

DataFrame functions only; nothing but one number (the largest group count)
reaches the driver. Random numbers are hashes of the document ids and a seed,
so that reruns agree.

Rows that share doc_id, source and size are one unit with a multiplicity n
(a NULL id in many rows, say) and are aggregated before any shuffle. Of n rows
with the fraction f, floor(n f) get the extra copy outright, at most one is left
with the rest as its probability, and the others get none: so repeated rows too
miss their source's target by one document at most. NULL and empty texts have
size 0 and are never taken; a NULL source is a source of its own; an empty table
gives an empty result. Columns other than doc_id, text and source are not looked
at; ``mixed_documents`` keeps them, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationday.llm.common import WORD, free_name, saved, unit_hash

GROUP = 64
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_COPIES = 2.0


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, n): units of equal rows and their number."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size")).groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))


def targets(units: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) of every source.

    Sources in code point order, NULL last, get the weights in rotation. They
    share ``share`` times all words by weight; a source stops at ``most`` times
    its size and its excess is shared again until none is above. That is one
    water level: with the sources sorted by cap per weight, those before the
    first whose cap exceeds its share are full. The two windows run over one
    row per source.
    """
    per = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    per = per.select("source", "source_size", w.alias("w"))
    cap = F.col("source_size") * F.lit(float(most))
    by_ratio = Window.orderBy((cap / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy((cap / F.col("w")).asc(), F.col("source").asc_nulls_last()).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    per = per.withColumn("cap", cap).withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
    per = per.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest))
    per = per.withColumn("open", F.col("cap") > F.col("level") * F.col("w"))
    # The first source that stays below its cap fixes the level of all later ones.
    first = F.min(F.when(F.col("open"), F.struct((F.col("cap") / F.col("w")).alias("r"), F.col("level").alias("level")))).over(everything)
    per = per.withColumn("first", first)
    target = F.when(F.col("first").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("first.level") * F.col("w")))
    return per.select("source", "source_size", target.alias("target"))


def _fold(level: int, seed: int) -> tuple[Column, Column]:
    """Fold the undecided units of a group: (units decided on the way, the one left).

    Largest first: what large documents leave undecided is then absorbed by
    many small ones, and the last one left of a source tends to be small.

    A unit is (doc_id, source, size, n, source_size, target, whole, words,
    mass): it can give ``words`` words, of which ``mass`` are expected now.
    """

    def step(state: Column, u: Column) -> Column:
        c = state["carry"]
        a, b = c["words"], u["words"]
        up = F.least(a - c["mass"], u["mass"])  # words that can move from u to the carry
        down = F.least(c["mass"], b - u["mass"])
        draw = unit_hash(F.lit(seed), F.lit(level), c["doc_id"], u["doc_id"], c["words"], u["words"])
        rise = draw * (up + down) < down
        c_mass = F.when(rise, F.when(a - c["mass"] <= u["mass"], a).otherwise(c["mass"] + u["mass"])).otherwise(
            F.when(c["mass"] <= b - u["mass"], F.lit(0.0)).otherwise(c["mass"] - (b - u["mass"]))
        )
        u_mass = F.when(rise, F.when(u["mass"] <= a - c["mass"], F.lit(0.0)).otherwise(u["mass"] - (a - c["mass"]))).otherwise(
            F.when(b - u["mass"] <= c["mass"], b).otherwise(u["mass"] + c["mass"])
        )
        pair = F.struct(c.withField("mass", c_mass).alias("c"), u.withField("mass", u_mass).alias("u"))

        def settle(p: Column) -> Column:
            c2, u2 = p["c"], p["u"]
            c_open = (c2["mass"] > 0) & (c2["mass"] < c2["words"])
            u_open = (u2["mass"] > 0) & (u2["mass"] < u2["words"])
            gone = F.filter(F.array(F.when(~c_open, c2), F.when(~u_open, u2)), lambda x: x.isNotNull())
            return F.struct(F.when(c_open, c2).when(u_open, u2).alias("carry"), F.concat(state["done"], gone).alias("done"))

        met = F.transform(F.array(pair), settle)[0]
        return F.when(c.isNull(), F.struct(u.alias("carry"), state["done"].alias("done"))).otherwise(met)

    units = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("unit.words")).alias("w"), F.xxhash64(F.lit(seed), F.lit(level), F.col("unit.doc_id")).alias("r"), F.col("unit").alias("u")))), lambda x: x["u"])
    return units, step


UNIT = "struct<doc_id:{id},source:{source},size:bigint,n:bigint,source_size:bigint,target:double,whole:bigint,words:double,mass:double>"


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MAX_COPIES, seed: int = 7) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, n): n equal rows each
    of which the mix takes ``copies`` times; up to three such rows for rows that
    share doc_id, source and size."""
    types = dict(docs.select("doc_id", "source").dtypes)
    unit_type = UNIT.format(id=types["doc_id"], source=types["source"])
    units = saved(sizes(docs), "mix-sizes")
    t = targets(units, weights, share, most).withColumnRenamed("source", "s")
    u = units.join(t, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    fraction = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    u = u.withColumn("whole", F.floor(fraction).cast("long")).withColumn("part", fraction - F.col("whole"))
    sure = F.floor(F.col("n") * F.col("part")).cast("long")
    # of n equal rows: those with an extra copy, the one to draw for, the others
    split = F.array(
        F.struct(sure.alias("n"), (F.col("whole") + 1).alias("whole"), F.lit(0.0).alias("p")),
        F.struct(F.lit(1).cast("long").alias("n"), F.col("whole").alias("whole"), (F.col("n") * F.col("part") - sure).alias("p")),
        F.struct((F.col("n") - sure - 1).alias("n"), F.col("whole").alias("whole"), F.lit(0.0).alias("p")),
    )
    u = u.withColumn("split", F.explode(F.filter(split, lambda x: x["n"] > 0))).drop("n", "whole")
    u = u.withColumn("n", F.col("split.n")).withColumn("whole", F.col("split.whole")).withColumn("words", F.col("size").cast("double"))
    u = u.withColumn("mass", F.col("words") * F.col("split.p"))
    u = saved(u.select(F.struct("doc_id", "source", "size", "n", "source_size", "target", "whole", "words", "mass").cast(unit_type).alias("unit")), "mix-units")
    open_ = (F.col("unit.mass") > 0) & (F.col("unit.mass") < F.col("unit.words"))
    done = [u.filter(~open_)]
    todo = u.filter(open_)
    counts = todo.groupBy(F.col("unit.source").alias("s")).agg(F.ceil(F.count(F.lit(1)) / F.lit(GROUP)).cast("long").alias("groups"))
    groups = counts.agg(F.max("groups")).first()[0] or 0
    todo = todo.join(counts, F.col("unit.source").eqNullSafe(F.col("s")), "left").select("unit", F.pmod(F.xxhash64(F.lit(seed), "unit.doc_id", "unit.words"), F.col("groups")).alias("g"))
    level = 0
    while groups:
        units_of, step = _fold(level, seed)
        zero = F.struct(F.lit(None).cast(unit_type).alias("carry"), F.array().cast(f"array<{unit_type}>").alias("done"))
        folded = todo.groupBy(F.col("unit.source").alias("s"), "g").agg(units_of.alias("units"))
        folded = folded.select("g", F.aggregate("units", zero, step).alias("f"))
        folded = saved(folded.select("g", F.col("f.carry").alias("carry"), F.col("f.done").alias("done")), f"mix-level{level}")
        done.append(folded.select(F.explode("done").alias("unit")))
        todo = folded.filter(F.col("carry").isNotNull()).select(F.col("carry").alias("unit"), F.floor(F.col("g") / F.lit(GROUP)).alias("g"))
        level += 1
        if groups == 1:
            break
        groups = -(-groups // GROUP)
    last = unit_hash(F.lit(seed), F.lit("last"), F.col("unit.doc_id"), F.col("unit.words")) * F.col("unit.words") < F.col("unit.mass")
    done.append(todo.select(F.col("unit").withField("mass", F.when(last, F.col("unit.words")).otherwise(F.lit(0.0))).alias("unit")))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    copies = F.col("unit.whole") + F.when((F.col("unit.mass") > 0) & (F.col("unit.words") > 0), 1).otherwise(0)
    return out.select("unit.doc_id", "unit.source", "unit.size", "unit.source_size", "unit.target", F.when(F.col("unit.size") > 0, copies).otherwise(0).cast("int").alias("copies"), "unit.n")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: every document as often as it is taken, with its
    columns and ``copy_no`` from 1 (an input column of that name is replaced).

    Of repeated rows the first few get one copy more. Their order is that of the
    rows' places, which are numbered within partitions first, so that no task
    has all rows of a large group."""
    cols = [c for c in docs.columns if c != "copy_no"]
    own = {k: free_name(cols, k) for k in ("id", "source", "size", "least", "extra", "at", "part", "before", "copies")}
    keys = [own["id"], own["source"], own["size"]]
    plan = mix_sources(docs, **options).groupBy(*(F.col(c).alias(own[k]) for c, k in (("doc_id", "id"), ("source", "source"), ("size", "size"))))
    plan = plan.agg(F.sum(F.col("copies").cast("long") * F.col("n")).alias("taken"), F.sum("n").alias("rows")).filter("taken > 0")
    plan = plan.select(*keys, F.expr("taken div rows").alias(own["least"]), (F.col("taken") % F.col("rows")).alias(own["extra"]))
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(*cols, F.monotonically_increasing_id().alias(own["at"]))
    joined = rows.join(plan, F.col("doc_id").eqNullSafe(F.col(own["id"])) & F.col("source").eqNullSafe(F.col(own["source"])) & (size == F.col(own["size"])), "inner")
    alike = joined.filter(F.col(own["extra"]) == 0).withColumn(own["copies"], F.col(own["least"]))
    some = saved(joined.filter(F.col(own["extra"]) > 0).withColumn(own["part"], F.shiftright(own["at"], 33)), "mix-repeated")
    counts = some.groupBy(*keys, own["part"]).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*keys).orderBy(own["part"]).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*(F.col(k).alias(f"{k}_c") for k in [*keys, own["part"]]), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(own["before"]))
    on = F.col(own["part"]) == F.col(f"{own['part']}_c")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"{k}_c"))
    place = F.row_number().over(Window.partitionBy(*keys, own["part"]).orderBy(own["at"]))
    some = some.withColumn(own["at"], place).join(counts, on)
    more = (F.col(own["before"]) + F.col(own["at"]) <= F.col(own["extra"])).cast("long")
    some = some.withColumn(own["copies"], F.col(own["least"]) + more)
    both = alike.select(*cols, own["copies"]).unionByName(some.select(*cols, own["copies"])).filter(F.col(own["copies"]) > 0)
    return both.select(*cols, F.explode(F.sequence(F.lit(1), F.col(own["copies"]).cast("int"))).alias("copy_no"))


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    from stationday.llm.common import table

    m = mix_sources(table(spark, sf_dir, "documents"))
    m = m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("row_no"))
    return m.drop("row_no")
