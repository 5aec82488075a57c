"""Mixing sources to target weights with distributed prefix sums, in DataFrame operations.

Rows get hash-random keys. Within each source, the range of keys is cut into slots; the
slots' sizes give every slot the words before it. A source whose target is e times its
size and r words more gives every row e times, and once more the rows before the r-th
word in key order, cut at that word. All rows of a slot lie before that word or behind
it, but for the slot that holds it: only there a window sorts rows and gives each the words
before it. So of every source one slot is shuffled, however long the texts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame) -> DataFrame:
    """mix_null, mix_source, source_size with each source's target.

    Weights go round by the source's code points, null last. Targets share all words by
    weight; none is above ``MOST_REPEATS`` times its source, what is left is shared again.
    Sources in ascending order of the level at which they are full: before the first that
    the rest of the words does not fill, all are full. One row per source, on one task.
    """
    order = Window.orderBy("mix_null", "mix_source")
    turn = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (turn % len(WEIGHTS) + 1).cast("int"))
    capped = sizes.withColumns({"weight": weight, "cap": F.col("source_size") * MOST_REPEATS})
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "mix_null", "mix_source")
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = capped.withColumns({
        "place": F.row_number().over(by_level),
        "full": F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "open": F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)),
        "words": F.sum("source_size").over(everything),
    }).withColumn("level", (F.col("words") - F.col("full")) / F.col("open"))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level"))
    first = F.min(fits).over(everything)
    return levels.withColumn("first", first).select(
        "mix_null", "mix_source", "source_size",
        F.when(F.col("place") < F.col("first.place"), F.col("cap").cast("double"))
        .otherwise(F.col("first.level") * F.col("weight")).alias("target"),
    )


def mixture(
    docs: DataFrame, carried: list[str], *, seed: str = "mix", slots: int = 256, keep: bool = True
) -> DataFrame:
    """Every row of ``docs`` (doc_id, source, text) with size, source_size, target and taken.

    ``size`` counts the text's words (null or empty: 0); ``taken`` are the words that the
    mix takes of the row, repeats counted. The taken words of a source are its target's
    whole part. Null sources are one source. The order within a source depends on
    ``seed`` and doc_id alone; repeated rows follow each other in it. ``carried`` names
    the columns of ``docs`` that stay, under their own names, and must not be among
    those four; others, whatever they are called, go. ``slots`` cuts each source: raise it
    with the rows of the largest. ``keep`` writes the counted rows once, so that texts are
    read once; pass False if texts are carried. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")))
    keyed = docs.select(
        *carried,
        F.col("text").alias("mix_text"),
        F.col("source").isNull().alias("mix_null"),
        F.coalesce("source", F.lit("")).alias("mix_source"),
        key.alias("mix_key"),
    ).withColumn("mix_slot", (F.conv(F.substring("mix_key", 1, 6), 16, 10).cast("long") * slots / (1 << 24)).cast("int"))

    def sized(rows: DataFrame) -> DataFrame:
        return rows.withColumn("size", words(F.col("mix_text"))).drop("mix_text")

    base = scratch.keep(sized(keyed), "sizes") if keep else sized(keyed)
    in_slots = base.groupBy("mix_null", "mix_source", "mix_slot").agg(F.sum("size").alias("slot_size"))
    own = Window.partitionBy("mix_null", "mix_source").orderBy("mix_slot").rowsBetween(Window.unboundedPreceding, -1)
    slot_starts = in_slots.withColumn("slot_start", F.coalesce(F.sum("slot_size").over(own), F.lit(0)))
    goals = targets(in_slots.groupBy("mix_null", "mix_source").agg(F.sum("slot_size").alias("source_size")))
    epochs = F.coalesce(F.floor(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))), F.lit(0))
    ends_here = (F.col("mix_rest") > F.col("slot_start")) & (F.col("mix_rest") < F.col("slot_start") + F.col("slot_size"))
    # Written, so that Spark knows how small it is before it deals out any row.
    placed = scratch.keep(
        slot_starts.join(goals, ["mix_null", "mix_source"])
        .withColumn("mix_epochs", epochs)
        .withColumn("mix_rest", F.floor(F.col("target") - F.col("mix_epochs") * F.col("source_size")))
        .withColumn("mix_cut", F.coalesce(ends_here, F.lit(False)))
        .drop("slot_size"),
        "slots",
    )
    place = ["mix_null", "mix_source", "mix_slot"]
    # Rows of a slot before the one where the budget ends are all taken, those behind it are not.
    whole = base.join(placed.where("not mix_cut"), place).withColumn(
        "mix_more", F.when(F.col("slot_start") >= F.col("mix_rest"), F.lit(0)).otherwise(F.col("size"))
    )
    before = Window.partitionBy(*place).orderBy("mix_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("mix_rest") - F.col("slot_start") - F.coalesce(F.sum("size").over(before), F.lit(0))
    here = placed.where("mix_cut")
    cut = base.join(here, place) if keep else sized(keyed.join(here, place))
    cut = cut.withColumn("mix_more", F.greatest(F.lit(0), F.least(F.col("size"), left)))
    taken = (F.col("mix_epochs") * F.col("size") + F.col("mix_more")).cast("long").alias("taken")
    return whole.unionByName(cut).select(*carried, "size", "source_size", "target", taken)


def mixed_documents(docs: DataFrame, *, seed: str = "mix", slots: int = 256) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as taken, with the columns they had.

    A row comes once for each time that its words are taken in full, and once more with
    the words up to the cut (joined by one space) where its source's budget ends within
    it. Rows of no words are in no mix.
    """
    names = {name: f"mix_own_{at}" for at, name in enumerate(docs.columns)}
    carried = docs.select("doc_id", "source", "text", *[F.col(a).alias(b) for a, b in names.items()])
    taken = mixture(carried, list(names.values()), seed=seed, slots=slots, keep=False)
    text = F.col(names["text"])
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, F.col("mix_words").cast("int")), " ")
    copies = (
        taken.where("taken > 0")
        .withColumn("mix_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("taken") - 1) / F.col("size")))))
        .withColumn("mix_words", F.least("size", F.col("taken") - F.col("mix_copy") * F.col("size")))
        .withColumn(names["text"], F.when(F.col("mix_words") < F.col("size"), cut).otherwise(text))
    )
    out = copies.select(*[F.col(b).alias(a) for a, b in names.items()])
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


MIXTURE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':mix') AS k
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 3 * source_size AS cap,
         row_number() OVER w AS place,
         ((sum(source_size) OVER ()) - coalesce(sum(3 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level
  FROM sources WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
goal AS (SELECT place, level FROM levels WHERE level * weight <= cap ORDER BY place LIMIT 1),
goals AS (
  SELECT l.source, source_size,
         CASE WHEN l.place < g.place THEN cap::DOUBLE ELSE g.level * weight END AS target
  FROM levels l, goal g),
placed AS (
  SELECT doc_id, size, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         coalesce(floor(target / nullif(source_size, 0)), 0) AS epochs
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target - epochs * source_size) - start)))::BIGINT AS taken
FROM placed
"""
