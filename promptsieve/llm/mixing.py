"""Mixing sources to target weights by pivotal dependent rounding.

Sources in code point order, null last, weigh `weights` in turn.  Together they
get `share` of all words; a target stops at `cap` times the words its source
has, and the excess goes to the others by weight until none is above: the level
at which the capped targets add up.  A document is then due `target / source
words` copies.  Whole copies are certain; of the fractions, two are paired at a
time and mass moves between them at random, with the words they stand for kept,
until one is 0 or 1.  The other goes on.  Blocks of some `BLOCK` documents are
reduced inside a row each, their residuals form the blocks of the next level,
and so on: a reduction tree in which no source is ever in one task.  The one
residual a source ends with is rounded to the nearer value, so that the words
taken differ from the target by less than one document.

Defined cases: equal rows (same id, source and text) are one entry with a
count, however many they are.  A null text has no words and takes none.  A
null source is a source.  Results depend on the rows and the seed alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptsieve.llm.texts import column, let, uniform, word_count
from promptsieve.session import shared_dir
from promptsieve.sources.sinks import stage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
BLOCK = 64


def targets(sizes: DataFrame, share: float = SHARE, cap: float = CAP, weights=WEIGHTS) -> DataFrame:
    """(source, source_size) with `target`, for a row per source.

    The level is the largest at which every source that is taken as capped is
    above its cap.  The windows run over one row per source, not over rows.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn + 1)
    weighed = sizes.withColumn("weight", weight).withColumn("most", cap * F.col("source_size"))
    weighed = weighed.withColumn("full_at", F.col("most") / F.col("weight"))
    before = Window.orderBy("full_at", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    capped, capped_weight = (F.coalesce(F.sum(c).over(before), F.lit(0.0)) for c in ("most", "weight"))
    level = (share * F.sum("source_size").over(all_rows) - capped) / (F.sum("weight").over(all_rows) - capped_weight)
    tried = weighed.withColumn("level", level)
    found = tried.withColumn("level", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(all_rows))
    # No level is low enough only if the share asks for more than all caps give.
    target = F.coalesce(F.least("most", F.col("level") * F.col("weight")), F.col("most"))
    return found.select("source", "source_size", "entries", target.alias("target"))


def _pair(carry: Column, other: Column, level: int, seed: int) -> Column:
    """One step: (settled, bit, carry) after mass has moved between the two."""
    up = F.least((1 - carry["x"]) * carry["size"], other["x"] * other["size"])
    down = F.least(carry["x"] * carry["size"], (1 - other["x"]) * other["size"])
    chance = uniform(F.lit(seed), F.lit(level), carry["key"], other["key"])

    def moved(m: Column) -> Column:
        raised = chance * (m["up"] + m["down"]) < m["down"]
        ends = F.when(
            raised, (1 - carry["x"]) * carry["size"] <= other["x"] * other["size"]
        ).otherwise(carry["x"] * carry["size"] <= (1 - other["x"]) * other["size"])
        return F.struct(raised.alias("raised"), ends.alias("ends"), m["up"].alias("up"), m["down"].alias("down"))

    def outcome(m: Column) -> Column:
        shift = F.when(m["raised"], m["up"]).otherwise(-m["down"])
        x = F.when(m["ends"], other["x"] - shift / other["size"]).otherwise(carry["x"] + shift / carry["size"])
        stays = F.when(m["ends"], other).otherwise(carry)
        return F.struct(
            F.when(m["ends"], carry).otherwise(other).withField("bit", (m["raised"] == m["ends"]).cast("int")).alias("settled"),
            stays.withField("x", F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))).alias("carry"),
        )

    return let(let(F.struct(up.alias("up"), down.alias("down")), moved), outcome)


def _reduce(items: Column, level: int, seed: int) -> Column:
    """A block as (settled items with their bits, the one that is left)."""
    start = F.struct(F.slice(items, 1, 0).alias("settled"), F.element_at(items, 1).alias("carry"))

    def step(state: Column, item: Column) -> Column:
        return let(
            _pair(state["carry"], item, level, seed),
            lambda p: F.struct(F.concat(state["settled"], F.array(p["settled"])).alias("settled"), p["carry"].alias("carry")),
        )

    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), start, step)


def entries(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Equal rows as one: id, source, size, key and their number."""
    return (
        docs.select(
            column(id_col).alias("id"),
            column(source_col).alias("source"),
            word_count(column(text_col)).alias("size"),
            row_key(id_col, text_col, source_col).alias("key"),
        )
        .groupBy("id", "source", "size", "key")
        .agg(F.count("*").alias("rows"))
    )


def row_key(id_col: str, text_col: str, source_col: str) -> Column:
    return F.xxhash64(column(id_col), column(source_col), column(text_col))


def copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    *, share: float = SHARE, cap: float = CAP, weights=WEIGHTS, seed: int = 7, block: int = BLOCK,
) -> DataFrame:
    """Per entry (`entries`): source_size, target, `base` copies of each of its
    rows and `extra`, the number of its rows that get one more."""
    spark = docs.sparkSession
    found = stage(entries(docs, id_col, text_col, source_col), shared_dir(spark, "entries"))
    sizes = found.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("entries")
    )
    aims = stage(targets(sizes, share, cap, weights), shared_dir(spark, "targets"))
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = found.join(aims.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    fraction = F.col("rows") * (due - F.floor(due))
    state = joined.select(
        "id", "source", "rows", "key", "source_size", "target",
        F.col("size").cast("double").alias("size"),
        F.floor(due).alias("base"),
        F.floor(fraction).alias("whole"),
        (fraction - F.floor(fraction)).alias("x"),
        F.lit(0).alias("bit"),
        F.ceil(F.col("entries") / block).cast("long").alias("blocks"),
    )
    open_ = (F.col("x") > 0) & (F.col("size") > 0)
    fields = [c for c in state.columns if c != "blocks"]
    settled = [state.where(~open_).select(*fields)]
    current, level = state.where(open_), 0
    # One pass per level of the tree: 64 entries, 4,096, 262,144 and so on.
    most = aims.agg(F.max("entries")).first()[0] or 0
    while most > 0:
        blocks = -(-most // block)
        item = F.struct((-F.col("size")).alias("order"), F.xxhash64(F.lit(seed), F.lit(level), "key", "id").alias("shuffled"), *fields)
        grouped = (
            current.groupBy("source", "blocks", F.pmod(F.xxhash64(F.lit(seed + level), "key", "id"), F.col("blocks")).alias("block"))
            .agg(F.array_sort(F.collect_list(item)).alias("items"))
            .select("blocks", _reduce(F.col("items"), level, seed).alias("r"))
        )
        done = stage(grouped, shared_dir(spark, f"level-{level}"))
        settled.append(done.select(F.explode("r.settled").alias("i")).select(*(F.col(f"i.{c}") for c in fields)))
        left = done.select("blocks", "r.carry.*").drop("order", "shuffled")
        last = F.col("blocks") <= 1
        settled.append(left.where(last).withColumn("bit", (F.col("x") >= 0.5).cast("int")).select(*fields))
        current = left.where(~last).withColumn("blocks", F.ceil(F.col("blocks") / block).cast("long"))
        most = blocks if blocks > 1 else 0
        level += 1
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out.select(
        "id", "source", F.col("size").cast("long").alias("size"), "key", "rows", "source_size", "target",
        F.col("base").cast("long").alias("base"), (F.col("whole") + F.col("bit")).cast("long").alias("extra"),
    )


def taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """Per row: id, size, source_size, target and the words the mix takes."""
    rows = copies(docs, id_col, text_col, source_col, **options).withColumn("n", F.explode(F.expr("sequence(1L, rows)")))
    times = F.col("base") + (F.col("n") <= F.col("extra")).cast("long")
    return rows.select(
        F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * times).alias("taken")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as it is taken."""
    due = copies(docs, id_col, text_col, source_col, **options).where(F.col("size") > 0)
    due = due.select(F.col("id").alias("due_id"), F.col("key").alias("due_key"), "rows", "base", "extra")
    keyed = docs.select(
        F.struct(*(column(c) for c in docs.columns)).alias("document"),
        column(id_col).alias("id"), row_key(id_col, text_col, source_col).alias("key"),
    )
    met = keyed.join(due, (F.col("key") == F.col("due_key")) & F.col("id").eqNullSafe(F.col("due_id")))
    single = met.where(F.col("rows") == 1).withColumn("n", F.lit(1))
    # Only rows that repeat another one have to be numbered.
    numbered = met.where(F.col("rows") > 1).withColumn(
        "n", F.row_number().over(Window.partitionBy("key", "id").orderBy(F.lit(1)))
    )
    times = F.col("base") + (F.col("n") <= F.col("extra")).cast("long")
    rows = single.unionByName(numbered).withColumn("times", times).where(F.col("times") > 0)
    return rows.select("document", F.explode(F.expr("sequence(1L, times)"))).select("document.*")
