"""Line dedup by an exact set-similarity join, in DataFrame functions only.

A line's tokens are its distinct runs of five words; a shorter line has one token, its whole word sequence. A line goes when an
earlier line of the corpus, in the order of (key, line), has a Jaccard similarity of 0.8 or more with it; of equal lines the first one stays.

* Lone runs: a similar line lacks ``n - ceil(0.8 n)`` runs at most. A line goes no further if it has more than that which no other
  line holds, by a third of all runs, chosen by their hash: each is hashed and counted as a row, with no set made of them.
* Rarity: words of the lines that are left are counted in a table of fixed size (a count per hash cell), and a token is as rare as its
  rarest word, by the magnitude of that count. Words keep their order of frequency however large the corpus grows: their
  counts spread over many magnitudes, where nearly all runs of five occur once. Equal magnitudes are ordered by hash. Any total
  order gives the same result; this one leaves frequent tokens out of the prefixes.
* Prefix filter: similar lines share one of the first ``n - ceil(0.8 n) + 1`` tokens of each. A token that one line
  has is told by the smallest and largest line number of its prefix entries and goes no further.
* Length filter: the smaller set has at least 0.8 of the larger one's tokens.
* Positional filter: at the first common token, what follows on both sides must suffice.
* Parity filter: each token flips one of 64 bits of its line. Where the bits of two lines differ, so do their sets, and
  similar sets differ in a ninth of their sizes at most.
* Verification: whole token sets of the pairs that are left.

Equal lines are folded before they meet others (128 bits of their words tell), and lines are numbered in their order. A line needs
one earlier match only, so each first meets the earliest line of its tokens; those that find their match there are done, and only
the others meet all earlier lines. A token that many variants of a line share so costs one pair per line, not all pairs.

Defined results: null text stays null; blank lines stay, as they hold no token; null keys come first; rows with equal keys count in
the order of their texts' hashes, and of rows equal in key and text one keeps its lines, the others lose all that hold a word;
a document may become empty and stays as a row; an empty table gives an empty table; extra columns are kept, whatever their names.
The input is taken to be a table: it is read by several passes, which know a row by its key and the hash of its text, never by its place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.llm.common import let, scratch, stage

SIZE = 5
#: White space within a line, but the space itself.
OTHER = "\t\x0b\x0c\r"
#: Of 256 hashes of runs, those that are sampled to tell which lines are unlike all others.
SAMPLED = 88
#: Cells of the rarity table: its size is fixed, whatever the corpus.
CELLS = 1 << 16
#: A token is a number: its magnitude above that many bits of its hash.
HASH_BITS = 57
#: At least ``SIZE`` words.
LONG = f"^(?:[^ ]++ ){{{SIZE - 1}}}"
WORD = "[^\\x20\\x09-\\x0D]"
ROW = ["known", "id", "hash"]
#: Whether two lines may be similar: length, positional and parity filter, told where they meet by a token, so that no other pair is made.
FITS = (
    "5 * n_x >= 4 * n_y AND 5 * n_y >= 4 * n_x AND 9 * (1 + least(n_x - i_x, n_y - i_y) - 1) >= 4 * (n_x + n_y)"
    " AND 9 * bit_count(bits_x ^ bits_y) <= n_x + n_y"
)


def row_of(key: str, text: str) -> list[Column]:
    """What a row is known and ordered by."""
    return [F.col(key).isNotNull().alias("known"), F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("hash")]


def spaced(text: Column) -> Column:
    """``text`` with a space for each other white space of its lines: one character to split at needs no regular expression."""
    odd = reduce(lambda a, b: a | b, [text.contains(c) for c in OTHER])
    return F.when(odd, F.translate(text, OTHER, " " * len(OTHER))).otherwise(text)


def words_of(line: Column) -> Column:
    return F.array_remove(F.split(spaced(line), " "), "")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds ``value``, evaluated once per row, however often it is used later."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(p, plain, k1, k2)`` of the lines that hold a word; ``plain`` are its words with a space between."""
    each = docs.select(*row_of(key, text), F.posexplode(F.split(spaced(F.col(text)), "\n")).alias("line", "body"))
    body = F.col("body")
    loose = body.contains("  ") | body.startswith(" ") | body.endswith(" ")
    tidy = F.when(loose, F.array_join(F.array_remove(F.split(body, " "), ""), " ")).otherwise(body)
    each = once(each, "plain", tidy).where("plain <> ''")
    return each.select(F.struct(*ROW, "line").alias("p"), "plain", F.xxhash64("plain").alias("k1"), F.xxhash64(F.lit(1), F.col("plain")).alias("k2"))


def runs_of(split: DataFrame) -> DataFrame:
    """``(k1, lacks, run)`` for every run of words of the lines, as often as it occurs; ``lacks``: how many a similar line may lack."""
    found = once(split.select("k1", "plain"), "words", F.split("plain", " ")).where(F.size("words") >= SIZE)
    n = F.size("words") - (SIZE - 1)
    lacks = F.expr(f"size(words) - {SIZE - 1} - (4 * (size(words) - {SIZE - 1}) + 4) div 5").cast("int")
    found = once(found.select("k1", lacks.alias("lacks"), "words"), "zipped", F.arrays_zip(*[F.slice("words", k + 1, n).alias(f"w{k}") for k in range(SIZE)]))
    parts = [f"w{k}" for k in range(SIZE)]
    return found.select("k1", "lacks", F.inline("zipped").alias(*parts)).select("k1", "lacks", F.xxhash64(*parts).alias("run"))


def unlike(split: DataFrame) -> DataFrame:
    """``k1`` of the lines of which more sampled runs than a similar line may lack are in no other line.

    A run is sampled by its own hash, so in all lines or none. Repeated runs of a line only raise ``lacks``.
    """
    sampled = runs_of(split).where(F.col("run").bitwiseAND(F.lit(255)) < SAMPLED)
    lone = sampled.groupBy("run").agg(F.min("k1").alias("k1"), F.max("k1").alias("last"), F.max("lacks").alias("lacks")).where("k1 = last")
    return lone.groupBy("k1").agg(F.count("*").alias("alone"), F.max("lacks").alias("lacks")).where("alone > lacks").select("k1")


def cell(word: Column) -> Column:
    return F.pmod(word, F.lit(CELLS)).cast("int")


def rarity(docs: DataFrame, text: str) -> list[int]:
    """Per cell the magnitude of the count of its words."""
    each = docs.select(F.explode(words_of(F.col(text))).alias("word"))
    counts = each.groupBy(cell(F.xxhash64("word")).alias("cell")).agg(F.count("*").alias("n")).collect()  # CELLS rows at most
    table = [0] * CELLS
    for row in counts:
        table[row["cell"]] = row["n"].bit_length()
    return table


def numbers(found: Column, table: list[int]) -> Column:
    """Words as numbers: the magnitude of the word's cell above the bits of its hash."""
    cells = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")  # folded to a constant
    hashes = F.transform(found, lambda w: F.xxhash64(w))
    return F.transform(hashes, lambda h: _number(F.shiftleft(F.get(cells, cell(h)), HASH_BITS), h))


def _number(magnitude: Column, hashed: Column) -> Column:
    return magnitude.bitwiseOR(F.shiftrightunsigned(hashed, 64 - HASH_BITS))


def tokens(found: Column, table: list[int]) -> Column:
    """The set of a line's runs from rare to frequent, each as one number; ``found`` are its words."""
    top = F.lit(((1 << (63 - HASH_BITS)) - 1) << HASH_BITS)

    def joined(a: Column, b: Column) -> Column:
        return _number(F.least(a, b).bitwiseAND(top), F.xxhash64(a, b))

    def after(v: Column, gap: int, left: Column) -> Column:
        return F.slice(v, F.lit(gap + 1), left)

    def runs(v: Column) -> Column:
        n = F.size(v)
        two = lambda: F.zip_with(F.slice(v, F.lit(1), n - 1), after(v, 1, n - 1), joined)
        four = lambda t: F.zip_with(F.slice(t, F.lit(1), n - 3), after(t, 2, n - 3), joined)
        five = lambda t: F.zip_with(F.slice(t, F.lit(1), n - 4), after(v, 4, n - 4), joined)
        return F.sort_array(F.array_distinct(let(let(two(), four), five)))

    short = F.array(F.xxhash64(F.array_join(found, " "), F.size(found)))
    return F.when(F.size(found) < SIZE, short).otherwise(let(numbers(found, table), runs))


def parity(set_: Column) -> Column:
    """64 bits, each flipped by the tokens that fall on it."""
    one = F.lit(1).cast("long")
    return F.aggregate(set_, F.lit(0).cast("long"), lambda s, t: s.bitwiseXOR(F.call_function("shiftleft", one, t.bitwiseAND(F.lit(63)).cast("int"))))


def similar(n_x: Column | str, n_y: Column | str, both: Column | str) -> Column:
    return F.expr(f"100 * {both} >= 80 * ({n_x} + {n_y} - {both})")


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in names])


def repeated(docs: DataFrame, key: str, text: str, again: bool) -> DataFrame:
    """``(known, id, hash, line)`` of the lines to remove from ``docs``; ``again`` tells that rows are equal in key and text."""
    split = lines(docs, key, text)
    apart = stage(unlike(split), "unlike")
    light = stage(split.select("p", "k1", "k2", F.col("plain").rlike(LONG).alias("long")), "lines")
    firsts = stage(light.groupBy("k1", "k2").agg(F.min("p").alias("p"), F.count("*").alias("copies"), F.max("long").alias("long")), "folded")
    # Numbers that grow in the order of the lines: ranges one after the other, each in order.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    open_ = firsts.where("long").join(apart, "k1", "left_anti").select("p")
    held = stage(open_.repartitionByRange(parts, "p").sortWithinPartitions("p").select(F.monotonically_increasing_id().alias("l"), "p"), "open-lines")
    bodies = stage(bodies_of(held, docs, key, text, again), "bodies")
    table = rarity(bodies, "body")
    sets = once(once(bodies, "words", words_of(F.col("body"))), "set", tokens(F.col("words"), table))
    sets = stage(sets.select("l", F.size("set").alias("n"), parity(F.col("set")).alias("bits"), "set"), "line-sets")

    prefix = F.slice("set", 1, F.expr("size(set) - (4 * size(set) + 4) div 5 + 1").cast("int"))
    entries = sets.select("l", "n", "bits", F.posexplode(prefix).alias("i", "token"))
    shared = entries.groupBy("token").agg(F.min("l").alias("first"), F.max("l").alias("last")).where("first < last").select("token", "first")
    met = stage(entries.join(shared, "token"), "met")
    name = lambda df, s: df.select("token", F.col("l").alias(s), F.col("n").alias(f"n_{s}"), F.col("i").alias(f"i_{s}"), F.col("bits").alias(f"bits_{s}"))

    def matching(pairs: DataFrame) -> DataFrame:
        """Numbers x of the pairs (x, y) that are similar."""
        close = stage(pairs.where(FITS).select("x", "y", "n_x", "n_y").distinct(), "line-pairs")
        for s in "xy":
            close = close.join(sets.select(F.col("l").alias(s), F.col("set").alias(f"set_{s}")), s)
        both = close.withColumn("both", F.size(F.array_intersect("set_x", "set_y")))
        return both.where(similar("n_x", "n_y", "both")).select("x").distinct()

    earliest, later = met.where("l = first"), met.where("l > first")
    found_first = stage(matching(name(later, "x").join(name(earliest, "y"), "token")), "found")
    rest = later.join(found_first, F.col("l") == F.col("x"), "left_anti")
    # The earliest line has been tried; a line without a match there meets the others before it.
    more = name(rest, "x").join(name(later, "y"), "token").where("y < x")
    near = found_first.union(matching(more))
    copies = light.join(firsts.where("copies > 1").select("k1", "k2", F.col("p").alias("kept")), ["k1", "k2"]).where("p <> kept").select("p.*")
    return near.join(held.select("l", "p"), F.col("x") == F.col("l")).select("p.*").union(copies).distinct()


def bodies_of(wanted: DataFrame, docs: DataFrame, key: str, text: str, again: bool) -> DataFrame:
    """``(l, body)``: the lines ``wanted(l, p)``."""
    asked = wanted.select("p.known", "p.id", "p.hash", F.struct("p.line", "l").alias("at")).groupBy(*ROW).agg(F.collect_list("at").alias("at"))  # lines of one text
    rows = docs.select(*row_of(key, text), F.col(text).alias("text"))
    each = rows.join(asked, same(rows, asked, ROW)).select(F.explode("at").alias("at"), F.split("text", "\n").alias("split"))
    found = each.select("at.l", F.get("split", F.col("at.line")).alias("body"))
    return found.dropDuplicates(["l"]) if again else found  # rows equal in key and text bring the same lines


def _repeats(docs: DataFrame, key: str, text: str) -> bool:
    """Whether rows are equal in key and text."""
    counts = docs.select(*row_of(key, text)).groupBy(*ROW).agg(F.count("*").alias("n"))
    return not counts.where("n > 1").isEmpty()


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the lines that repeat earlier ones; ``n_chars``, where there is one, is counted anew."""
    again = _repeats(docs, key, text)
    with scratch(docs.sparkSession):
        gone = stage(repeated(docs, key, text, again).groupBy(*ROW).agg(F.collect_set("line").alias("lines")), "gone")
    columns = [F.col(f"`{c}`").alias(c) for c in docs.columns]
    rows = docs.select(*row_of(key, text), F.monotonically_increasing_id().alias("place"), F.struct(*columns).alias("doc"))
    body = F.col("doc")[text]
    marked = rows.join(gone, same(rows, gone, ROW), "left").select(*[rows[c] for c in [*ROW, "place", "doc"]], F.coalesce("lines", F.array().cast("array<int>")).alias("lines"))
    if again:
        groups = rows.groupBy(*ROW).agg(F.min("place").alias("kept"), F.count("*").alias("n")).where("n > 1")
        marked = marked.join(groups, same(marked, groups, ROW), "left").select("doc", "lines", (F.col("place") > F.coalesce("kept", "place")).alias("again"))
    else:
        marked = marked.select("doc", "lines", F.lit(False).alias("again"))
    split = F.split(body, "\n")
    stays = lambda x, i: F.when(F.col("again"), ~x.rlike(WORD)).otherwise(~F.array_contains("lines", i))
    touched = F.col("again") | (F.size("lines") > 0)
    left = F.when(touched & body.isNotNull(), F.array_join(F.filter(split, stays), "\n")).otherwise(body)
    out = marked.select("doc", touched.alias("touched"), left.alias("left"))

    def column(c: str) -> Column:
        value = F.col("doc")[c]
        if c == text:
            return F.col("left").alias(c)
        if c == "n_chars":
            return F.when(F.col("touched"), F.char_length("left").cast(docs.schema[c].dataType)).otherwise(value).alias(c)
        return value.alias(c)

    return out.select(*[column(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """Per document: its lines, those removed, and length and digest of what is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", F.size(F.split("text", "\n")).alias("n_lines"))
    out = dedup(docs.select("doc_id", "text", "n_lines"))
    left = F.when(F.col("text") == "", F.lit(0)).otherwise(F.size(F.split("text", "\n")))
    return out.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), left.cast("long").alias("n_left"), F.char_length("text").cast("long").alias("left_chars"), F.sha2("text", 256).alias("left_sha256"))


SQL = r"""
WITH l AS (
  SELECT doc_id, i, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL)
), w AS (
  SELECT doc_id, i, line, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM l
), t AS (
  SELECT doc_id, i, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) END AS tokens FROM w WHERE len(w) > 0
), e AS (SELECT doc_id, i, len(tokens) AS n, unnest(tokens) AS token FROM t
), gone AS (
  SELECT DISTINCT doc_id, i FROM (
    SELECT x.doc_id, x.i, x.n, y.doc_id AS d, y.i AS j, y.n AS m, count(*) AS c
    FROM e x JOIN e y ON x.token = y.token AND (y.doc_id < x.doc_id OR (y.doc_id = x.doc_id AND y.i < x.i))
    GROUP BY ALL) WHERE 100 * c >= 80 * (n + m - c)
), kept AS (
  SELECT l.doc_id, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS left_text
  FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id
)
SELECT d.doc_id, CAST(len(string_split(d.text, chr(10))) AS BIGINT) AS n_lines,
  CAST(CASE WHEN left_text = '' THEN 0 ELSE len(string_split(left_text, chr(10))) END AS BIGINT) AS n_left,
  CAST(length(left_text) AS BIGINT) AS left_chars, sha256(left_text) AS left_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""
