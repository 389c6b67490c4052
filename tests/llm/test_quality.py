from __future__ import annotations

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from cargolens.llm import quality
from tests.check import compare, duck
from tests.llm.cases import DOCS, no_documents, odd_documents, odd_rows, words


def plain_counts(text):
    w = words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often, covered = Counter(windows), set()
    for i, g in enumerate(windows):
        if often[g] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def low(v):
    e = v.bit_length() - 5
    return v if v < 32 else (v >> e) << e


def plain_kept(rows):
    """Verdicts from counts of bucketed values: quartiles of a group blended with its language and all."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
    measured = [(r, dict(zip(names, (*plain_counts(r[1]), len([x for x in (r[1] or "").split("\n") if words(x)]))))) for r in rows]
    failed = lambda m: m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]
    value = lambda name, m: m[name] if name in m else m[quality.RATES[name][0]] * quality.RATES[name][2] // max(m[quality.RATES[name][1]], 1)
    groups, out = defaultdict(list), []
    for r, m in measured:
        if not failed(m):
            for g in ((r[2], r[3]), (r[2],), ()):
                groups[g].append(m)

    def quartiles(name, r):
        weights = Counter()
        for g in ((r[2], r[3]), (r[2],), ()):
            counts = Counter(low(value(name, m)) for m in groups[g])
            for v, n in counts.items():
                weights[v] += n * quality.SCALE if len(g) == 2 else n * quality.SCALE * quality.PRIOR // sum(counts.values())
        found, upto = {}, 0
        for v in sorted(weights):
            upto += weights[v]
            for k in (1, 2, 3):
                if 4 * upto >= k * sum(weights.values()):
                    found.setdefault(k, v)
        return found

    for r, m in measured:
        ok = not failed(m)
        if ok:
            for name, (over, under, scale, size, both) in quality.RATES.items():
                q = quartiles(name, r)
                least = scale if size is None else size * scale // max(quartiles(under, r)[2], 1)
                reach = quality.REACH * max(q[3] - q[1], least)
                few = size is not None and m[over] <= quality.REACH * size
                ok = ok and (few or value(name, m) <= q[3] + reach) and (not both or value(name, m) >= q[1] - reach)
        out.append((r[0], *(m[n] for n in names[:5]), failed(m), ok))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", *quality.COUNTS, "base_failed", "kept").collect()), key=str)


def test_query_equals_its_sql_and_the_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, duck(folder), folder, quality.query, quality.SQL) is None
    import pyarrow.parquet as pq

    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in pq.read_table(f"{folder}/documents.parquet").to_pylist()]
    assert got(quality.query(spark, folder)) == plain_kept(rows)


def test_odd_rows(spark):
    assert got(quality.verdicts(odd_documents(spark), ("doc_id",))) == plain_kept([r[:4] for r in odd_rows()])
    assert quality.passing(odd_documents(spark)).columns == DOCS.names
    assert quality.passing(no_documents(spark)).count() == 0


def test_sketches_merge_by_adding_counts(spark):
    measured = quality.measure(odd_documents(spark)).withColumn("base_failed", F.expr(quality.BASE_FAILED))
    whole = quality.sketch(measured)
    parts = quality.sketch(measured.where("doc_id % 2 = 0")).union(quality.sketch(measured.where("NOT doc_id % 2 <=> 0")))
    merged = parts.groupBy("lang", "source", "rate", "bucket").sum("n")
    assert sorted(map(str, map(tuple, merged.collect()))) == sorted(map(str, map(tuple, whole.collect())))


def sketch_of(spark, groups):
    rows = [(lang, source, rate, bucket, n) for (lang, source), found in groups.items() for rate, bucket, n in found]
    return spark.createDataFrame(rows, "lang string, source string, rate string, bucket int, n long")


def test_fences_follow_a_group_as_it_grows(spark):
    """One rule at every size: the same habit moves a group's fence the further, the more documents show it."""
    usual = [(name, 0, 10_000) for name in quality.RATES] + [(name, 30, 10_000) for name in quality.UNDER]
    highs = []
    for n in (1, 10, 49, 50, 51, 100, 1_000):
        odd = [(name, b, -(-n // 3)) for name in quality.RATES for b in (5, 15, 25)] + [(name, 30, n) for name in quality.UNDER]
        got = quality.fences(sketch_of(spark, {("en", "a"): usual, ("en", "b"): odd})).where("source = 'b'").head()
        highs.append(got["word_length_high"])
        assert got["dup_lines_high"] >= quality.REACH * (1_000 // 30)  # quartiles that tie: an occurrence in the median document
    assert highs == sorted(highs) and highs[0] < highs[-1]


def test_an_occurrence_is_worth_more_in_shorter_documents(spark):
    flat = lambda b: [(name, 0, 500) for name in quality.RATES] + [(name, b, 500) for name in quality.UNDER]
    got = {r["lang"]: r for r in quality.fences(sketch_of(spark, {("short", None): flat(4), (None, "long"): flat(31)})).collect()}
    assert got["short"]["dup_lines_high"] == 3 * (1_000 // 4) and got[None]["dup_lines_high"] == 3 * (1_000 // 31)


def test_labelled_documents(spark):
    """Held-out labels: what is marked good stays, what is marked bad goes."""
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.query(spark, "/root/testdata/sf0.01").where("NOT base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    count = {(r["quality"], r["kept"]): r["count"] for r in rows}
    assert count.get((1, False), 0) <= 0.01 * count[(1, True)]
    assert count.get((0, True), 0) <= 0.1 * count[(0, False)]


def test_no_python_in_the_plan(spark):
    text = quality.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(w in text for w in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))


def test_rows_are_numbered_anew_between_the_scans(spark, tmp_path, monkeypatch):
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(40)) if k % 3 else "too short", "en", "a", 1, "", "", k) for k in range(200)]
    spark.createDataFrame(rows, DOCS).repartition(6).write.parquet(str(tmp_path / "docs"))
    verdicts = quality.verdicts

    def then_split(*args, **columns):
        found = verdicts(*args, **columns).localCheckpoint()
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        return found

    monkeypatch.setattr(quality, "verdicts", then_split)
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a file to a split, then several files or pieces of them
    try:
        assert sorted(r["doc_id"] for r in quality.passing(spark.read.parquet(str(tmp_path / "docs"))).collect()) == [k for k in range(200) if k % 3]
    finally:
        for name in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{name}")
