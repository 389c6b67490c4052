"""N-gram Jaccard join: near-duplicate documents by a blocked sparse product.

Documents are rows and word n-grams columns of an incidence matrix A; the entries of A times its
transpose are overlaps. Two documents link when ``100 * overlap >= 80 * union``.

1. Equal sets are one row (a *node*): copies never multiply.
2. The columns are cut into blocks by hash. A block knows how many rows each of its columns has, and reports the
   columns with two rows or more. A row that shares fewer than 80 % of its columns cannot link and is discarded: a bound
   from its size alone. Columns that are frequent everywhere are recognised beforehand and count as
   shared without being gathered.
3. What is left is multiplied on the rarest columns only: a row of size n may miss n - ceil(0.8 n) columns, so one column
   of that many plus one, rarest first, must be shared. Rows whose sets differ too much never meet: each column of a row
   flips one of 256 bits, so two sets differ in as many columns as bits at least, and linked ones in (m + n) / 9 at most.
   No product is made where the columns that follow in either row are too few for ceil(4 (m + n) / 9) in common. The others are
   added per pair, and a pair is discarded when its sum plus what may follow stays below that.
4. Surviving pairs are told by 2,048 parity bits of the columns they may share and by the columns each has alone: large sets fill
   256 bits, so that those tell nothing. What is left is verified on whole sets, and the links are contracted to components.

Columns that many rows share are not multiplied out. First each row meets one hub per column, a row of the column's largest
component; verified links join rows to components. A round has few hubs per group of rows at first and more of them later, as few rows
are left, and rounds go on while they help. Then only rows outside the largest component of a column meet the rest of it. A pair
within one component adds nothing, so no component is lost, and a large group of near
copies costs about one product per row and column.

Defined results: null and blank texts have no n-grams, link with nothing and are their own component;
texts shorter than n words are one n-gram; repeated rows and copies share a component; a component
without any id has a null id; an empty table gives an empty table; extra columns are not read.
Sets and columns are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.llm.common import components, fresh, ready, stage
from cargolens.llm.shingles import of_texts

SIZE = 5
#: Entries of a column block, and the share of all entries above which a column counts as frequent: at most 2**18 columns.
BLOCK_ENTRIES, FREQUENT = 1 << 20, 1 << 18
#: Rows below which no column counts as frequent.
FEW = 256
#: Different hubs of a group of rows in the first round, however many columns they share; four times as many in each later one.
HUBS = 4
#: Rounds of hubs: at least, and at most while the products that are left outnumber the entries and still fall.
HUB_ROUNDS, MOST_ROUNDS = 2, 6
MANY = (1 << 31) - 1
#: The parity of a set's columns, 64 bits each.
PARITY = ["p0", "p1", "p2", "p3"]
#: Words of 64 bits of the wide parity that a pair is told by before its whole sets are fetched.
WIDE = 32


def parity(hashes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Per set, the bits that its columns flip an odd number of times."""
    bit = np.uint64(1) << (hashes & np.uint64(63))
    word = (hashes >> np.uint64(6)) & np.uint64(3)
    flipped = [np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(np.where(word == np.uint64(k), bit, np.uint64(0)))]) for k in range(len(PARITY))]
    return [(f[bounds[1:]] ^ f[bounds[:-1]]).view(np.int64) for f in flipped]


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))


def inspect(docs: DataFrame, size: int) -> DataFrame:
    """Rows of two kinds: (0, doc_id, node, n, parity) per document, (1, null, column, count, nulls) per column seen repeatedly in one go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sets in of_texts(batch.column(1), size):
                rows = len(sets.sizes)
                ids = batch.column(0).slice(sets.first, rows)
                columns, counts = np.unique(sets.hashes, return_counts=True)
                often = counts >= max(2, len(sets.hashes) // FREQUENT)
                columns, counts = columns[often].view(np.int64), counts[often]
                kind = np.repeat(np.array([0, 1], np.int32), [rows, len(columns)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind), pa.concat_arrays([ids, pa.nulls(len(columns), pa.int64())]), pa.array(np.concatenate([sets.keys(), columns])), pa.array(np.concatenate([sets.sizes, counts]))]
                    + [pa.concat_arrays([pa.array(p), pa.nulls(len(columns), pa.int64())]) for p in parity(sets.hashes, sets.bounds)],
                    names=["kind", "doc_id", "node", "n", *PARITY],
                )

    return docs.mapInArrow(run, "kind int, doc_id long, node long, n long, " + ", ".join(f"{p} long" for p in PARITY))


def entries(docs: DataFrame, size: int, bits: int, frequent) -> DataFrame:
    """Rows (block, nodes, counts, columns): what a go holds of a column block; frequent columns in blocks of their own, past the others."""

    def packed(block: np.ndarray, node: np.ndarray, column: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(block, kind="stable")
        block, node, column = block[order], node[order], column[order]
        new_block = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        new_run = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (node[1:] != node[:-1])]))
        runs = np.searchsorted(new_run, np.append(new_block, len(block)))
        counts = np.diff(np.append(new_run, len(block)))
        return pa.RecordBatch.from_arrays(
            [pa.array(block[new_block].astype(np.int32)), lists(node[new_run], runs, pa.int64()), lists(counts, runs, pa.int32()), lists(column, np.append(new_block, len(block)), pa.int64())],
            names=["block", "nodes", "counts", "columns"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, seen = frequent.value, set()
        for batch in batches:
            for sets in of_texts(batch.column(1), size):
                keys = sets.keys()
                fresh = np.zeros(len(keys), bool)
                for k, key in enumerate(keys.tolist()):
                    if sets.bounds[k + 1] > sets.bounds[k] and key not in seen:
                        seen.add(key)
                        fresh[k] = True
                take = fresh[sets.owners]
                column, node = sets.hashes[take], keys[sets.owners[take]]
                if not len(column):
                    continue
                block = (column >> np.uint64(64 - bits)).astype(np.int64)
                at = np.minimum(np.searchsorted(often, column), max(len(often) - 1, 0))
                common = often[at] == column if len(often) else np.zeros(len(column), bool)
                spread = (node.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
                yield packed(np.where(common, spread + (1 << bits), block), node, column.view(np.int64))

    return docs.mapInArrow(run, "block int, nodes array<long>, counts array<int>, columns array<long>")


def shared(packed: DataFrame, bits: int) -> DataFrame:
    """Rows (node, columns): the columns of each block that more than one node holds.

    A column is one number from here on: its rarity (four steps per doubling of its nodes) above 57 bits of its hash, so
    sorting numbers puts rare columns first and all of Spark's array functions work on plain longs.
    """

    def run(group: pa.Table) -> pa.Table:
        number = group.column("block")[0].as_py()
        flat = lambda name: group.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        node, column = np.repeat(flat("nodes"), flat("counts")), flat("columns")
        order = np.lexsort((node, column))
        node, column = node[order], column[order]
        first = np.concatenate([[True], (node[1:] != node[:-1]) | (column[1:] != column[:-1])])
        node, column = node[first], column[first]
        starts = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
        rows = np.diff(np.append(starts, len(column)))
        rows = np.repeat(np.full(len(rows), MANY) if number >= 1 << bits else rows, rows)
        node, column, rows = node[rows > 1], column[rows > 1], rows[rows > 1]
        column = (np.minimum(4 * np.log2(rows), 127).astype(np.int64) << 57) | (column.view(np.uint64) >> np.uint64(7)).astype(np.int64)
        order = np.argsort(node, kind="stable")
        node, column = node[order], column[order]
        heads = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.zeros(0, np.int64)
        bounds = np.append(heads, len(node))
        return pa.table([pa.array(node[heads]), lists(column, bounds, pa.int64())], names=["node", "columns"])

    return packed.groupBy("block").applyInArrow(run, "node long, columns array<long>")


def wide_parity(sets: DataFrame) -> DataFrame:
    """Rows (node, n, alone, w0, w1, ...): the parity of a row's shared columns in ``WIDE`` words, and how many columns it has alone."""
    each = sets.select("node", F.explode("columns").alias("column"))
    word, bit = F.expr(f"cast(shiftright(column, 6) & {WIDE - 1} as int)"), F.expr("shiftleft(1L, cast(column & 63 as int))")
    found = each.groupBy("node", word.alias("word")).agg(F.bit_xor(bit).alias("bits")).groupBy("node")
    found = found.agg(*[F.coalesce(F.max(F.when(F.col("word") == k, F.col("bits"))), F.lit(0)).alias(f"w{k}") for k in range(WIDE)])
    return sets.select("node", "n", (F.col("n") - F.size("columns")).alias("alone")).join(found, "node")


def close(pairs: DataFrame, wide: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` without those whose sets differ in too much to link, by what each row has alone and the parity of the rest."""
    side = lambda s: wide.select(F.col("node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in wide.columns if c != "node"])
    apart = " + ".join(f"bit_count(w{k}_a ^ w{k}_b)" for k in range(WIDE))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(f"9 * (alone_a + alone_b + {apart}) <= n_a + n_b").select("a", "b")


def linked(pairs: DataFrame, sets: DataFrame, wide: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that reach the similarity, by the overlap of their whole sets."""
    pairs = stage(close(pairs, wide), "close")
    side = lambda s: sets.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("columns").alias(f"set_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("overlap", F.size(F.array_intersect("set_a", "set_b")))
    return both.where("100 * overlap >= 80 * (n_a + n_b - overlap)").select("a", "b")


def products(left: DataFrame, right: DataFrame, whole: bool = True) -> DataFrame:
    """Sums of the products of the rarest columns per pair of different components, without those that a size bound discards.

    ``rest`` counts the columns of a row after this one. The first column that a pair shares comes before all its other
    ones in both rows, so a product that leaves too few is not made, nor any of a later column. These bounds hold where
    all columns meet (``whole``): a hub is met in some of the columns that are shared with it.
    """
    name = lambda df, s: df.select("column", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "rest", "label", *PARITY)])
    apart = " + ".join(f"bit_count({p}_x ^ {p}_y)" for p in PARITY)
    fits = f"label_x <> label_y AND 5 * n_x >= 4 * n_y AND 5 * n_y >= 4 * n_x AND 9 * ({apart}) <= n_x + n_y"
    if whole:
        fits += " AND 9 * (1 + least(rest_x, rest_y)) >= 4 * (n_x + n_y)"
    met = name(left, "x").join(name(right, "y"), "column").where(fits)
    # Both rows are x where both are open; a product counts once.
    sums = met.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"), (F.col("n_x") + F.col("n_y")).alias("n"), F.least("rest_x", "rest_y").alias("rest"), "column")
    sums = sums.groupBy("a", "b", "n", "column").agg(F.min("rest").alias("rest")).groupBy("a", "b", "n").agg(F.count("*").alias("sum"), F.min("rest").alias("rest"))
    return (sums.where("9 * (sum + rest) >= 4 * n") if whole else sums).select("a", "b")


def hub_order(turn: int) -> Column:
    """Smallest for the hub of a column: a row of its largest component, drawn anew for each turn and each kind of column."""
    drawn = F.xxhash64("node", F.pmod(F.xxhash64("column"), F.lit(HUBS * 4**turn)), F.lit(turn))
    return F.struct(F.col("label") != F.col("major"), drawn, "node", "n", "rest", "label", *PARITY)


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """``(doc_id, n_shingles, node, label, component_id)`` per document; label is one node of the component."""
    spark = ready(docs.sparkSession)
    light = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    seen = stage(inspect(light, size), "nodes")
    rows = seen.where("kind = 0")
    total = rows.agg(F.sum("n")).head()[0] or 0
    counted = seen.where("kind = 1").groupBy("node").agg(F.sum("n").alias("n")).where(F.col("n") >= max(FEW, total // FREQUENT))
    columns = np.sort(np.array([r[0] for r in counted.select("node").collect()], np.int64).view(np.uint64))  # at most FREQUENT of them
    bits = max(4, int(np.ceil(np.log2(max(1, total / BLOCK_ENTRIES)))))
    reported = shared(entries(light, size, bits, spark.sparkContext.broadcast(columns)), bits)
    merged = reported.groupBy("node").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("columns")))).alias("columns"))
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"), *[F.max(p).alias(p) for p in PARITY])
    sets = merged.join(nodes, "node").where(5 * F.size("columns") >= 4 * F.col("n")).select("node", "n", *PARITY, "columns")
    sets = stage(sets, "sets")
    wide = stage(wide_parity(sets), "wide")

    # One column among the rarest ``n - ceil(0.8 n) + 1`` must be shared; columns of a single row are the rarest of all.
    misses = F.expr("n - (4 * n + 4) div 5") - (F.col("n") - F.size("columns"))
    rarest = sets.withColumn("taken", (misses + 1).cast("int")).select("node", "n", *PARITY, F.size("columns").alias("all"), F.posexplode(F.slice("columns", 1, F.col("taken"))).alias("place", "column"))
    rarest = rarest.select("node", "n", *PARITY, (F.col("all") - F.col("place") - 1).alias("rest"), "column")
    held = rarest.groupBy("column").agg(F.count("*").alias("k")).where("k > 1").drop("k")
    rarest = stage(rarest.join(held, "column"), "rarest")
    labels, links, before, turn, last = sets.select("node", F.col("node").alias("label")), None, 0, 0, False
    while not last:
        labeled = stage(rarest.join(labels, "node"), "labeled")
        groups = labeled.groupBy("column", "label").agg(F.count("*").alias("k"))
        mixed = groups.groupBy("column").agg(F.max_by("label", F.struct("k", "label")).alias("major"), F.max("k").alias("most"), F.sum("k").alias("k"), F.count("*").alias("labels")).where("labels > 1")
        mixed = stage(mixed, "mixed")
        work, many = (x or 0 for x in mixed.agg(F.sum(F.expr("double(k - most) * k")), F.sum("k")).head())
        last = turn >= HUB_ROUNDS and (work <= 2 * many or work > 0.95 * before or turn >= MOST_ROUNDS)
        before = work
        open_rows = labeled.join(mixed.select("column", "major"), "column")
        if not last:
            hubs = open_rows.groupBy("column").agg(F.min(hub_order(turn)).alias("h")).select("column", *[f"h.{c}" for c in ("node", "n", "rest", "label", *PARITY)])
            pairs = products(open_rows.drop("major"), hubs, whole=False)
        else:
            pairs = products(open_rows.where("label <> major").drop("major"), open_rows.drop("major"))
        found = stage(linked(pairs, sets, wide), "links")
        links = found if links is None else links.union(found)
        joined = components(links)
        labels = sets.select("node").join(joined.select(F.col("id").alias("node"), "component"), "node", "left").select("node", F.coalesce("component", "node").alias("label"))
        labels, turn = stage(labels, "labels"), turn + 1

    every = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = every.groupBy("label").agg(F.min("first").alias("component_id"))
    known = every.select("node", "label").join(smallest, "label")
    named = rows.where("n > 0").select("doc_id", "n", "node").join(known, "node")
    blank = rows.where("n = 0").select("doc_id", "n", F.lit(None).cast("long").alias("node"), F.lit(None).cast("long").alias("label"), F.col("doc_id").alias("component_id"))
    columns_out = ["doc_id", F.col("n").alias("n_shingles"), "node", "label", "component_id"]
    return named.select(*columns_out).union(blank.select(*columns_out))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest id of each component, and every document without n-grams; columns as they came."""
    row = fresh(docs, "_row")
    kept = stage(docs.withColumn(row, F.monotonically_increasing_id()), "kept")
    light = kept.select(F.col(row).alias("_row"), F.col(text).alias("text"), F.col(key).alias("_key"))
    found = classes(light.select("_row", "text"), "_row", "text")
    ids = light.select(F.col("_row").alias("_id"), "_key")
    ranked = found.where("n_shingles > 0").join(ids, F.col("doc_id") == F.col("_id"))
    best = ranked.groupBy("label").agg(F.min(F.struct(F.col("_key").isNull(), "_key", "_id")).alias("m")).select(F.col("m._id").alias(row))
    blank = found.where("n_shingles = 0").select(F.col("doc_id").alias(row))
    return kept.join(best.union(blank), row).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with set size and component."""
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")
