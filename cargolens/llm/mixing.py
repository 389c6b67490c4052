"""Mixing sources to target weights.

The words of a source, documents in key order, are packed into blocks of fixed length. The mix is a
run of slots dealt to output shards: every shard draws its source counts from a multinomial, and
the running counts of a source are scaled to its exact number of slots (draws given their totals). Slot
``j`` of a source is block ``p(j)``, where ``p`` is a pseudorandom permutation of its block indexes, a
new one for each full pass; slots meet blocks in a join on (source, block). The last
pass stops at the word, so a source gives its target to the word.

Targets: weights times all words, capped at ``max_repeat`` times a source's words; what is above the
cap is shared by weight among the others until none is above. A pass takes each word once, so no
document gives more than ``max_repeat`` times its words.

Every draw and permutation follows from the seed and the data: a rerun gives the same mix.

Defined results: null text has no words and gives none; a null source is a source of its own, last;
documents without words stay with 0; repeated rows are documents of their own; an empty table
gives an empty table; ``documents_of`` returns the columns of its input, extra ones included, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens.llm.common import fresh, numbered, ready, running, stage, words

#: Words of a block, and slots of an output shard.
BLOCK, SHARD_SLOTS = 256, 16_384
WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def scramble(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The image of ``index`` in a keyed permutation of ``range(size)``: a Feistel network, walked until it falls inside."""
    index, size, key = (np.asarray(a).astype(np.uint64) for a in (index, size, key))
    half = np.ones(len(size), np.uint64)
    for bits in range(1, 32):
        half = np.where(size > (np.uint64(1) << np.uint64(2 * bits)), np.uint64(bits + 1), half)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, live = index.copy(), np.arange(len(index))
    rounds = range(5, -1, -1) if inverse else range(6)
    with np.errstate(over="ignore"):
        while len(live):
            h, m, k = half[live], mask[live], key[live]
            left, right = out[live] >> h, out[live] & m
            for r in rounds:
                salt = k + np.uint64(r) * np.uint64(0x9E3779B97F4A7C15)
                if inverse:
                    left, right = right ^ (scramble(left + salt) & m), left
                else:
                    left, right = right, left ^ (scramble(right + salt) & m)
            out[live] = (left << h) | right
            live = live[out[live] >= size[live]]
    return out.astype(np.int64)


def permuted(index: Column, size: Column, key: Column, inverse: bool = False) -> Column:
    @F.pandas_udf(T.LongType())
    def run(i: pd.Series, n: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series(permute(i.to_numpy(np.int64), n.to_numpy(np.int64), k.to_numpy(np.int64).view(np.uint64), inverse))

    return run(index, size, key)


@dataclass
class Mix:
    """Documents with ``_size``, their place, source size and target; and what the mix takes, by document, pass and span of words."""

    documents: DataFrame
    takes: DataFrame


def targets(sizes: DataFrame, weights: list[int], max_repeat: int) -> DataFrame:
    """``(source, source_size)`` with weight and target; one row per source, so one ordered pass over them is small."""
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight).withColumn("_cap", F.col("source_size") * max_repeat)
    order = Window.orderBy(F.col("_cap") / F.col("weight"), "_rank")
    all_rows = Window.partitionBy(F.lit(0))
    # With the caps before a row spent, the level of the rest; the first row it leaves uncapped has the true level.
    spent = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    leveled = capped.withColumn("_level", (F.sum("source_size").over(all_rows) - spent) / left)
    fits = F.when(F.col("_level") <= F.col("_cap") / F.col("weight"), F.struct(F.col("_cap") / F.col("weight"), "_rank", "_level"))
    level = F.min(fits).over(all_rows)["_level"]
    target = F.least(F.coalesce(level, F.lit(0.0)) * F.col("weight"), F.col("_cap").cast("double"))
    return leveled.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, seed: int = 20, block: int = BLOCK) -> Mix:
    spark = ready(docs.sparkSession)
    size = F.size(words(F.col(text))).cast("long")
    light = numbered(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), size.alias("size")), ["doc_id"])
    plan = stage(targets(light.groupBy("source").agg(F.sum("size").alias("source_size")), list(weights), max_repeat), "targets")
    plan = plan.withColumn("source_key", F.xxhash64(F.col("source"), F.lit(seed)))
    placed = running(light, ["doc_id"], "size", by=["source"], ready_ranges=True)
    same = F.col("source").eqNullSafe(F.col("_source"))
    documents = stage(placed.join(plan.drop("weight").withColumnRenamed("source", "_source"), same).drop("_source"), "mixed")

    # Slots of each source: full passes, and a last pass of ``rest`` words.
    sized = plan.where("source_size > 0").withColumn("words", F.round("target").cast("long"))
    sized = sized.withColumn("blocks", F.ceil(F.col("source_size") / block)).withColumn("tail", F.col("source_size") - (F.col("blocks") - 1) * block)
    sized = sized.withColumn("passes", F.expr("words div source_size")).withColumn("rest", F.expr("words % source_size"))
    last = F.when(F.col("rest") > 0, F.least("blocks", F.ceil((F.col("rest") + block - F.col("tail")) / block))).otherwise(0)
    sized = sized.withColumn("slots", (F.col("passes") * F.col("blocks") + last).cast("long")).where("slots > 0")
    epoch_key = lambda e: F.xxhash64(F.col("source_key"), e, F.lit(seed))
    sized = sized.withColumn("tail_at", permuted(F.col("blocks") - 1, F.col("blocks"), epoch_key(F.col("passes")), inverse=True))
    sized = stage(sized.select("source_key", "slots", "blocks", "tail", "passes", "rest", "tail_at"), "slots")

    total = sized.agg(F.sum("slots")).head()[0] or 0
    shards = max(1, -(-total // SHARD_SLOTS))
    drawn = draws(sized, shards, total, seed)
    slots = drawn.join(sized, "source_key").withColumn("slot", F.explode(F.expr("sequence(first, last - 1)")))
    slots = slots.withColumn("epoch", F.expr("slot div blocks")).withColumn("i", F.expr("slot % blocks"))
    length = F.when(F.col("block") == F.col("blocks") - 1, F.col("tail")).otherwise(block)
    before = F.col("i") * block - F.when(F.col("tail_at") < F.col("i"), block - F.col("tail")).otherwise(0)
    take = F.when(F.col("epoch") < F.col("passes"), length).otherwise(F.least(length, F.col("rest") - before))
    slots = slots.withColumn("block", permuted(F.col("i"), F.col("blocks"), epoch_key(F.col("epoch")))).withColumn("take", take).where("take > 0")

    # Blocks by index: the stretch of each document that lies in them.
    end = F.col("before") + F.col("size")
    stretches = documents.where("size > 0").select(
        "_part", "_tie", "source_key", "before", end.alias("end"), F.explode(F.sequence(F.expr(f"before div {block}"), F.expr(f"(before + size - 1) div {block}"))).alias("block")
    )
    joined = stretches.join(slots.select("source_key", "block", "epoch", "take", "shard", "slot"), ["source_key", "block"])
    start = F.greatest(F.col("before"), F.col("block") * block)
    stop = F.least(F.col("end"), F.col("block") * block + F.col("take"))
    takes = joined.select("_part", "_tie", "epoch", "shard", "slot", (start - F.col("before")).alias("from"), (stop - F.col("before")).alias("to")).where("from < to")
    return Mix(documents, takes)


def draws(sized: DataFrame, shards: int, total: int, seed: int) -> DataFrame:
    """``(source_key, shard, first, last)``: the slots of each source that each output shard takes."""
    parts = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = sized.groupBy(F.lit(0).alias("one")).agg(F.sort_array(F.collect_list(F.struct("source_key", "slots"))).alias("all"))  # one row per source

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def draw(shard: pd.Series, size: pd.Series, slots: pd.Series) -> pd.Series:
        out = []
        for h, n, k in zip(shard, size, slots, strict=True):
            k = np.asarray(k, np.float64)
            out.append(np.random.Generator(np.random.PCG64([seed, int(h)])).multinomial(int(n), k / k.sum()))
        return pd.Series(out)

    size = F.least(F.lit(SHARD_SLOTS), F.lit(total) - F.col("shard") * SHARD_SLOTS)
    numbered_shards = shares.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))).repartition(parts, "shard")
    table = numbered_shards.withColumn("size", size)
    counts = table.withColumn("counts", draw("shard", "size", F.transform("all", lambda x: x["slots"])))
    each = counts.select("shard", F.explode(F.arrays_zip(F.col("all.source_key").alias("k"), F.col("all.slots").alias("s"), F.col("counts").alias("n"))).alias("x"))
    each = each.select("shard", F.col("x.k").alias("source_key"), F.col("x.s").alias("slots"), F.col("x.n").alias("n"))
    up = Window.partitionBy("source_key").orderBy("shard")
    # A source that no shard drew goes whole to one shard; else running counts are scaled to the exact total.
    none = F.sum("n").over(Window.partitionBy("source_key")) == 0
    n = F.when(none, F.when(F.col("shard") == F.pmod(F.col("source_key"), F.lit(shards)), 1).otherwise(0)).otherwise(F.col("n"))
    each = each.withColumn("n", n).withColumn("upto", F.sum("n").over(up)).withColumn("all", F.sum("n").over(Window.partitionBy("source_key")))
    scaled = lambda c: F.expr(f"cast(({c}) as decimal(38,0)) * slots div all")
    bounds = each.select("source_key", "shard", scaled("upto - n").alias("first"), scaled("upto").alias("last"))
    return bounds.where("first < last")


def taken(found: Mix) -> DataFrame:
    """Every document with the words the mix takes of it."""
    sums = found.takes.groupBy("_part", "_tie").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    rows = found.documents.join(sums, ["_part", "_tie"], "left")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source")


@F.pandas_udf(T.StringType())
def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
    """The spans of words of each text, as they stand there, one below the other."""

    def one(value: str, ranges) -> str:
        places = [m.span() for m in WORD.finditer(value)]
        pairs = sorted((int(r["from"]), int(r["to"])) for r in ranges)
        if len(pairs) == 1 and pairs[0] == (0, len(places)):
            return value
        return "\n".join(value[places[a][0] : places[b - 1][1]] for a, b in pairs)

    return pd.Series([one(t, s) for t, s in zip(text, spans, strict=True)])


def documents_of(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The mix as documents: a row per document and pass with the words taken there; columns of ``docs``.

    Documents of which nothing is taken, or which have no words, are not in the mix.
    """
    row, spans_of = fresh(docs, "_row"), fresh(docs, "_spans")
    kept = stage(docs.withColumn(row, F.monotonically_increasing_id()), "kept")
    named = lambda c: F.col(f"`{c}`")
    found = mix(kept.select(named(row).alias("key"), named(source).alias("source"), named(text).alias("text")), "key", **options)
    merged = found.takes.groupBy("_part", "_tie", "epoch").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    spans = merged.join(found.documents.select("_part", "_tie", F.col("doc_id").alias(row)), ["_part", "_tie"])
    spans = spans.select(row, join_spans(F.col("spans")).alias(spans_of))
    rows = kept.join(spans, row).withColumn(text, cut(named(text), named(spans_of)))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.char_length(named(text)).cast(docs.schema["n_chars"].dataType))
    return rows.select(*[named(c) for c in docs.columns])


def join_spans(spans: Column) -> Column:
    """Spans in order, neighbours that touch made one."""
    empty = F.array().cast("array<struct<from:bigint,to:bigint>>")

    def add(done: Column, s: Column) -> Column:
        tail = F.get(done, F.size(done) - 1)
        longer = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(tail["from"].alias("from"), s["to"].alias("to"))))
        return F.when(tail["to"] == s["from"], longer).otherwise(F.concat(done, F.array(F.struct(s["from"].alias("from"), s["to"].alias("to")))))

    return F.aggregate(F.sort_array(spans), empty, add)


def query(spark, sf_dir: str) -> DataFrame:
    """All documents mixed with weights 1, 2, 3 repeating and at most three passes."""
    found = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return taken(found).drop("source")
