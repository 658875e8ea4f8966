"""Operator 5: mix sources to target weights by pivotal dependent rounding.

Every document gets an expected number of copies (its source's target over the
source's size). Whole copies are certain; the fractional rest of two documents
is paired, and mass (in words) moves at random between them until one becomes
integral, so inclusion chances hold for each document and the words of a source
hold in sum. Pairing runs inside small salted chunks; the one document a chunk
leaves undecided goes to the next level of a reduction tree, until one document
of a source is left, which is rounded by its own chance. A hot source is thus
many chunks. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import cut

#: Mean number of documents that one chunk pairs off.
CHUNK = 48
#: Weights by a source's place in code point order, repeated; most copies of a document.
WEIGHTS, MOST = (1, 2, 3), 3
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, weight, source_size, target, docs) from (source, size) rows.

    Targets share the sum of all sizes by weight, stop at ``most`` times the
    source's size, and the excess is shared again: sources ordered by cap over
    weight are capped as long as the cap is within the share still open to them.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    every = Window.partitionBy(F.lit(0))
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("place")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (per.withColumn("place", place)
              .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int")).cast("double"))
              .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
              .withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("full", F.col("cap") * F.col("open") <= F.col("weight") * F.col("left")))
    rest = F.sum(F.when(~F.col("full"), F.col("weight"))).over(every)
    spent = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0.0))
    share = F.col("weight") * (F.sum("source_size").over(every) - spent) / rest
    return ranked.select("source", "weight", "source_size", "docs",
                         F.when(F.col("full"), F.col("cap")).otherwise(F.least("cap", share)).alias("target"))


def _chance(level: int) -> Column:
    """A uniform number in [0, 1) that depends on the document and the level alone."""
    return F.pmod(F.xxhash64(F.col("doc_id"), F.col("copy"), F.col("size"), F.lit(f"pivot {level}")), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _pair(state: Column, item: Column) -> Column:
    """Pivotal step between the undecided document and the next one."""
    held = state["held"]
    held_words, item_words = held["size"], item["size"]
    up = F.least((1 - held["part"]) * held_words, item["part"] * item_words)
    down = F.least(held["part"] * held_words, (1 - item["part"]) * item_words)
    rise = item["chance"] * (up + down) < down
    held_done = F.when(rise, (1 - held["part"]) * held_words <= item["part"] * item_words).otherwise(
        held["part"] * held_words <= (1 - item["part"]) * item_words)
    keys = ("doc_id", "copy", "size", "base", "chance")
    shifted = lambda x, words, sign: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x["part"] + sign * F.when(rise, up).otherwise(-down) / words))
    with_part = lambda x, part: F.struct(*[x[k].alias(k) for k in keys], part.alias("part"))
    whole = lambda yes: F.when(yes, F.lit(1.0)).otherwise(F.lit(0.0))
    step = F.when(
        held_done,
        F.struct(with_part(item, shifted(item, item_words, -1)).alias("held"),
                 F.concat(state["done"], F.array(with_part(held, whole(rise)))).alias("done")),
    ).otherwise(
        F.struct(with_part(held, shifted(held, held_words, 1)).alias("held"),
                 F.concat(state["done"], F.array(with_part(item, whole(~rise)))).alias("done")))
    return F.when(held.isNull(), F.struct(item.alias("held"), state["done"].alias("done"))).otherwise(step)


_ITEM = "struct<doc_id:bigint,copy:int,size:bigint,base:bigint,chance:double,part:double>"


def _level(items: DataFrame, level: int, chunks: Column) -> DataFrame:
    """One level: rows of a chunk are paired off; gives (source, held, done, chunks)."""
    chunk = F.pmod(F.xxhash64("doc_id", "copy", F.lit(f"deal {level}")), F.greatest(chunks, F.lit(1)))
    dealt = items.withColumn("chunks", chunks).withColumn("chunk", chunk).withColumn("chance", _chance(level))
    item = F.struct("chance", "doc_id", "copy", "size", "base", "part")
    rows = dealt.groupBy("source", "chunk").agg(F.sort_array(F.collect_list(item)).alias("rows"), F.max("chunks").alias("chunks"))
    ordered = F.transform("rows", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["copy"].alias("copy"), x["size"].alias("size"),
                                                      x["base"].alias("base"), x["chance"].alias("chance"), x["part"].alias("part")).cast(_ITEM))
    none = F.struct(F.lit(None).cast(_ITEM).alias("held"), F.array().cast(f"array<{_ITEM}>").alias("done"))
    state = f"struct<held:{_ITEM},done:array<{_ITEM}>>"
    return rows.select("source", "chunks", F.aggregate(ordered, none.cast(state), lambda s, x: _pair(s, x).cast(state)).alias("state")).select(
        "source", "chunks", "state.held", "state.done")


def mix_sources(docs: DataFrame, weights=WEIGHTS, most: int = MOST, text: str = "text") -> DataFrame:
    """(doc_id, size, source_size, target, taken, source) for every row of ``docs``.

    ``size`` counts the words of the text (null or empty: 0, taken 0); null is a
    source of its own, the last; a null doc_id is an ordinary value; repeated
    rows are rounded one by one; an empty table gives no rows; other columns are
    not read. ``taken`` is size times the copies drawn, at most ``most`` times
    the size. Draws come from hashes of the document alone, so reruns agree.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
    counted = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))
               .groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")))
    sized = cut(counted.select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy")))
    targets = cut(source_targets(sized, weights, most))
    right = targets.withColumnRenamed("source", "of")
    wanted = sized.join(right, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    base = F.least(F.floor(copies + F.lit(1e-12)), F.lit(most)).cast("bigint")
    part = F.greatest(copies - base, F.lit(0.0))
    wanted = wanted.withColumns({"base": base, "part": part})
    open_ = (F.col("part") > 1e-12) & (F.col("size") > 0)
    settled = wanted.where(~open_).select("source", "doc_id", "size", (F.col("base") * F.col("size")).alias("taken"))
    items = wanted.where(open_).select("source", "doc_id", "copy", "size", "base", "part", "docs")
    biggest = targets.agg(F.max("docs")).first()[0] or 0
    out, level, chunks = [settled], 0, F.ceil(F.col("docs") / CHUNK)
    taken = lambda x: ((x["base"] + F.when(x["part"] > 0.5, 1).otherwise(0)) * x["size"]).alias("taken")
    while biggest >= 1:
        done = _level(items, level, chunks)
        biggest = -(-biggest // CHUNK) if biggest > 1 else 0
        last = biggest <= 1
        done = done if last else cut(done)
        out.append(done.select("source", F.explode("done").alias("x")).select("source", "x.doc_id", "x.size", taken(F.col("x"))))
        items = done.select("source", "held.doc_id", "held.copy", "held.size", "held.base", "held.part", F.col("chunks").alias("docs"))
        if last:
            drawn = F.when(_chance(level + 1) < F.col("part"), 1).otherwise(0)
            out.append(items.select("source", "doc_id", "size", ((F.col("base") + drawn) * F.col("size")).alias("taken")))
            break
        level += 1
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    return rows.join(right, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", F.col("taken").cast("bigint").alias("taken"), "source")
