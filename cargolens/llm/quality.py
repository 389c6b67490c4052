"""Quality rules with adaptive thresholds, in DataFrame functions only.

Base counts come from the whole text. Rates derived from them are put into log-linear histograms
per language and source: a quantile sketch with a relative error of 1/16 at most, exact below 32, that
merges by adding counts and gives the same answer in any order of rows. A group's sketch is blended with
that of its language and that of all, each with the weight of ``PRIOR`` documents: one rule at every size, by which small
groups lean on the others and large ones on themselves. Fences follow from the quartiles of the blend, so each source
is held against its own habit instead of a fixed cutoff. Where the quartiles tie, as in rates that are mostly zero, the
spread is what one occurrence (a symbol, a line, a repeated window) makes of the group's median document, by
the sketch of the denominators; up to ``REACH`` occurrences are no habit in a document of any length.
The fences join the documents on (language, source) and filter them.

The counts of a document are taken once and written without its text; the rest works on them. Bucket counts are added
before the shuffle, so a source with a third of all rows sends
no more than another.

Defined results: null text counts as empty, and a document without words fails the base rules;
null languages and sources are groups of their own; ties share a bucket and so a verdict;
repeated rows get the same verdict; an empty table gives an empty table; ``passing`` keeps all columns
of its input, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargolens.llm.common import fresh, let, stage, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Documents that the sketch of the language, and that of all, weigh in a group's own; counts are scaled to whole weights.
PRIOR, SCALE = 50, 1_000
#: Rates: numerator, denominator, scale to whole numbers, size of an occurrence (none: one per denominator), whether low values are odd as well.
RATES = {
    "word_length": ("word_chars", "n_words", 100, None, True),
    "symbols": ("n_symbols", "word_chars", 10_000, 1, False),
    "dup_lines": ("n_dup_lines", "n_lines", 1_000, 1, False),
    "repeats": ("n_repeat_words", "n_words", 1_000, 2 * WINDOW, False),
}
#: Spreads between the quartiles that a rate may lie beyond them.
REACH = 3
#: The denominators, whose medians tell what an occurrence is worth.
UNDER = sorted({r[1] for r in RATES.values()})
BASE_FAILED = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def windows(hashes: Column, size: int) -> Column:
    """A hash for every run of ``size`` words."""
    steps = F.when(F.size(hashes) >= size, F.sequence(F.lit(0), F.size(hashes) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(steps, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size)]))


def covered(grams: Column, size: int) -> Column:
    """Words inside the windows that occur twice or more: sort by hash, keep equal neighbours, join their stretches."""

    def repeated(s: Column) -> Column:
        equal = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        kept = F.filter(s, lambda x, k: equal(x, k - 1) | equal(x, k + 1))
        return F.sort_array(F.transform(kept, lambda x: x["i"]))

    def stretch(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(size), F.coalesce(F.get(p, k + 1) - x, F.lit(size)))), F.lit(0), lambda a, b: a + b)

    tagged = F.sort_array(F.transform(grams, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return let(let(tagged, repeated), stretch)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts and ``n_lines`` (lines with a word)."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    symbols = sum((F.octet_length(body) - F.octet_length(F.replace(body, F.lit(c), F.lit(""))) for c in SYMBOLS), F.lit(0))
    once = docs.withColumn("_words", words(F.col(text))).withColumn("_lines", lines)
    once = once.withColumn("_grams", let(F.transform("_words", lambda w: F.xxhash64(w)), lambda h: windows(h, WINDOW)))
    unique = F.size(F.array_distinct("_grams")) == F.size("_grams")
    out = once.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
            "n_symbols": symbols.cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.when(unique, F.lit(0)).otherwise(covered(F.col("_grams"), WINDOW)).cast("long"),
        }
    )
    return out.drop("_words", "_lines", "_grams")


def rate(name: str) -> Column:
    over, under, scale, _, _ = RATES[name]
    return F.expr(f"{over} * {scale} div greatest({under}, 1)")


def bucket(value: Column) -> Column:
    """Bucket of a whole number: itself below 32, then 16 buckets per power of two."""
    e = F.char_length(F.bin(value)) - 5
    return F.when(value < 32, value).otherwise(e * 16 + F.call_function("shiftright", value, e.cast("int"))).cast("int")


def lowest(b: Column) -> Column:
    """The smallest value of a bucket."""
    e = F.floor(b / 16).cast("int") - 1
    return F.when(b < 32, b.cast("long")).otherwise(F.call_function("shiftleft", (b - 16 * e).cast("long"), e))


def sketch(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Histogram rows ``(lang, source, rate, bucket, n)`` of the documents that pass the base rules; they merge by adding ``n``.

    The denominators of the rates have histograms of their own, under their names.
    """
    values = {name: rate(name) for name in RATES} | {name: F.col(name) for name in UNDER}
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("rate"), bucket(v).alias("bucket")) for name, v in values.items()])).alias("x")
    rows = measured.where("NOT base_failed").select(F.col(lang).alias("lang"), F.col(source).alias("source"), each)
    return rows.groupBy("lang", "source", "x.rate", "x.bucket").agg(F.count("*").alias("n"))


def levels() -> Column:
    """The sketches a group belongs to: its own (0), its language's (1), that of all (2)."""
    keep = lambda c, below, k: (F.col(c) if k < below else F.lit(None).cast("string")).alias("a" if c == "lang" else "b")
    return F.explode(F.array(*[F.struct(F.lit(k).alias("level"), keep("lang", 2, k), keep("source", 1, k)) for k in range(3)])).alias("l")


def blended(sketches: DataFrame) -> DataFrame:
    """``(lang, source, rate, bucket, w)``: each group's own counts, and those of its language and of all with a fixed weight."""
    merged = sketches.select("rate", "bucket", "n", levels()).groupBy("l.level", "l.a", "l.b", "rate", "bucket").agg(F.sum("n").alias("n"))
    merged = merged.withColumn("all", F.sum("n").over(Window.partitionBy("level", "a", "b", "rate")))
    w = F.when(F.col("level") == 0, F.col("n") * SCALE).otherwise(F.expr(f"n * {SCALE * PRIOR} div all"))
    # A row per sketch: it holds as many buckets as there are magnitudes, however many documents.
    whole = merged.groupBy(F.col("level").alias("k"), "a", "b").agg(F.collect_list(F.struct("rate", "bucket", w.alias("w"))).alias("buckets"))
    pairs = sketches.select("lang", "source").distinct().select("lang", "source", levels())
    match = (F.col("l.level") == F.col("k")) & F.col("l.a").eqNullSafe(F.col("a")) & F.col("l.b").eqNullSafe(F.col("b"))
    each = pairs.join(whole, match).select("lang", "source", F.explode("buckets").alias("x"))
    return each.groupBy("lang", "source", "x.rate", "x.bucket").agg(F.sum("x.w").alias("w"))


def fences(sketches: DataFrame) -> DataFrame:
    """``(lang, source)`` with the bounds ``<rate>_low`` and ``<rate>_high`` of the group's blended sketch."""
    group = Window.partitionBy("lang", "source", "rate")
    counted = blended(sketches).withColumn("all", F.sum("w").over(group)).withColumn("upto", F.sum("w").over(group.orderBy("bucket")))
    quartile = lambda k: lowest(F.min(F.when(F.col("upto") * 4 >= F.col("all") * k, F.col("bucket")))).alias(f"q{k}")
    found = counted.groupBy("lang", "source", "rate").agg(*[quartile(k) for k in (1, 2, 3)])
    pick = lambda name, q: F.max(F.when(F.col("rate") == name, F.col(q))).alias(f"{name}_{q}")
    wide = found.groupBy("lang", "source").agg(*[pick(n, q) for n in RATES for q in ("q1", "q3")], *[pick(n, "q2") for n in UNDER])
    bounds = []
    for name, (_, under, scale, size, _) in RATES.items():
        least = F.lit(scale) if size is None else F.expr(f"{size * scale} div greatest({under}_q2, 1)")
        reach = REACH * F.greatest(F.col(f"{name}_q3") - F.col(f"{name}_q1"), least)
        bounds += [(F.col(f"{name}_q1") - reach).alias(f"{name}_low"), (F.col(f"{name}_q3") + reach).alias(f"{name}_high")]
    return wide.select("lang", "source", *bounds)


def verdicts(docs: DataFrame, carry: tuple[str, ...] = (), lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """The columns ``carry`` with base counts, ``base_failed`` and ``kept``; the counts are taken once and written, without the texts."""
    bare = docs.select(F.col(lang).alias("_lang"), F.col(source).alias("_source"), F.col(text).alias("_text"), *[F.col(c) for c in carry])
    light = stage(measure(bare, "_text").drop("_text"), "counts").withColumn("base_failed", F.expr(BASE_FAILED))
    bounds = fences(sketch(light, "_lang", "_source"))
    joined = light.join(bounds, F.col("_lang").eqNullSafe(F.col("lang")) & F.col("_source").eqNullSafe(F.col("source")), "left")
    inside = F.lit(True)
    for name, (over, _, _, size, both) in RATES.items():
        value = rate(name)
        few = F.lit(False) if size is None else F.col(over) <= REACH * size
        inside = inside & (few | (value <= F.col(f"{name}_high")))
        if both:
            inside = inside & (value >= F.col(f"{name}_low"))
    kept = (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept")
    return joined.select(*[light[c] for c in carry], *COUNTS, "base_failed", kept)


def passing(docs: DataFrame, **columns: str) -> DataFrame:
    """The documents that are kept, with the columns they came with; they are written once with their row numbers, which a second scan may give anew."""
    row = fresh(docs, "_row")
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered", "zstd")
    good = verdicts(rows, (row,), **columns).where("kept").select(row)
    return rows.join(good, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet"), ("doc_id",))


def sql() -> str:
    """The same verdicts in DuckDB SQL."""
    blank = "[\\x20\\x09-\\x0D]+"
    symbols = " + ".join(f"(strlen(t) - strlen(replace(t, '{c}', '')))" for c in SYMBOLS)
    one = lambda n, o, u, s, w, b: f"SELECT *, '{n}' AS rate, '{u}' AS under, {o} * {s} // greatest({u}, 1) AS v, {s if w is None else w * s} AS least, {str(w is None).lower()} AS whole, {o} <= {REACH * (w or 0)} AS few, {str(b).lower()} AS low_too FROM f"
    rates = " UNION ALL ".join(one(n, *r) for n, r in RATES.items())
    unders = " UNION ALL ".join(f"SELECT lang, source, '{u}' AS rate, {u} AS v, base_failed FROM f" for u in UNDER)
    bucket_of = "CASE WHEN v < 32 THEN v ELSE (length(bin(v)) - 5) * 16 + (v >> (length(bin(v)) - 5)) END"
    value_of = "CASE WHEN {0} < 32 THEN {0} ELSE ({0} - 16 * ({0} // 16 - 1)) << ({0} // 16 - 1) END"
    return f"""
WITH b AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '{blank}'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents
), g AS (
  SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda k: array_to_string(w[k:k + {WINDOW - 1}], ' '))) AS gram FROM b WHERE len(w) >= {WINDOW}
), p AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1
), r AS (SELECT doc_id, sum(step) AS n FROM (SELECT doc_id, least({WINDOW}, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, {WINDOW})) AS step FROM p) GROUP BY doc_id
), m AS (
  SELECT b.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST({symbols} AS BIGINT) AS n_symbols,
    CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM b LEFT JOIN r USING (doc_id)
), f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
), v AS ({rates}
), h AS (
  SELECT lang, source, rate, {bucket_of} AS bucket, count(*) AS n FROM (SELECT lang, source, rate, v, base_failed FROM v UNION ALL {unders}) WHERE NOT base_failed GROUP BY ALL
), k AS (
  SELECT 0 AS level, lang AS a, source AS b, rate, bucket, n FROM h UNION ALL SELECT 1, lang, NULL, rate, bucket, n FROM h UNION ALL SELECT 2, NULL, NULL, rate, bucket, n FROM h
), s AS (SELECT level, a, b, rate, bucket, sum(n) AS n FROM k GROUP BY ALL
), y AS (SELECT level, a, b, rate, bucket, CASE WHEN level = 0 THEN n * {SCALE} ELSE n * {SCALE * PRIOR} // sum(n) OVER (PARTITION BY level, a, b, rate) END AS w FROM s
), o AS (
  SELECT lang, source, rate, bucket, sum(w) AS w FROM (SELECT DISTINCT lang, source FROM h) JOIN y
    ON (level = 0 AND a IS NOT DISTINCT FROM lang AND b IS NOT DISTINCT FROM source) OR (level = 1 AND a IS NOT DISTINCT FROM lang) OR level = 2 GROUP BY ALL
), c AS (
  SELECT *, sum(w) OVER (PARTITION BY lang, source, rate) AS total, sum(w) OVER (PARTITION BY lang, source, rate ORDER BY bucket) AS upto FROM o
), q AS (
  SELECT lang, source, rate, min(bucket) FILTER (upto * 4 >= total) AS b1, min(bucket) FILTER (upto * 4 >= total * 2) AS b2, min(bucket) FILTER (upto * 4 >= total * 3) AS b3
  FROM c GROUP BY ALL
), z AS (SELECT lang, source, rate, {value_of.format('b1')} AS q1, {value_of.format('b2')} AS q2, {value_of.format('b3')} AS q3 FROM q
), x AS (
  SELECT v.*, z.q1, z.q3, {REACH} * greatest(z.q3 - z.q1, CASE WHEN whole THEN least ELSE least // greatest(d.q2, 1) END) AS reach
  FROM v LEFT JOIN z ON z.rate = v.rate AND z.lang IS NOT DISTINCT FROM v.lang AND z.source IS NOT DISTINCT FROM v.source
  LEFT JOIN z d ON d.rate = v.under AND d.lang IS NOT DISTINCT FROM v.lang AND d.source IS NOT DISTINCT FROM v.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  bool_and(NOT base_failed AND coalesce((v <= q3 + reach OR (few AND NOT whole)) AND (NOT low_too OR v >= q1 - reach), true)) AS kept
FROM x GROUP BY ALL
"""


SQL = sql()
