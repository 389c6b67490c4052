from __future__ import annotations

import random

from pyspark.sql import functions as F

from cargolens.llm import line_dedup
from tests.check import compare, duck
from tests.llm.cases import DOCS, no_documents, odd_documents, odd_rows, words


def plain(rows):
    """Texts left, by comparing every line with all earlier ones; rows in their order."""
    seen, out = [], [None] * len(rows)
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k)):
        if rows[k][1] is None:
            continue
        kept = []
        for line in rows[k][1].split("\n"):
            w = words(line)
            tokens = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
            if not tokens or not any(len(tokens & s) * 100 >= 80 * len(tokens | s) for s in seen):
                kept.append(line)
            if tokens:
                seen.append(tokens)
        out[k] = "\n".join(kept)
    return sorted(((r[0], t) for r, t in zip(rows, out, strict=True)), key=str)


def got(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, duck(folder), folder, line_dedup.query, line_dedup.SQL) is None


def test_odd_rows_and_columns(spark):
    out = line_dedup.dedup(odd_documents(spark).coalesce(1))
    assert out.columns == DOCS.names
    assert got(out) == plain([r[:2] for r in odd_rows()])
    for r in out.collect():
        assert r["text"] is None or r["n_chars"] in (len(r["text"]), 3, 5, 1)
    assert line_dedup.dedup(no_documents(spark)).count() == 0


def test_variants_copies_and_frequent_tokens(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(4))
    base, shared, rows = [word() for _ in range(70)], [word() for _ in range(12)], []
    for k in range(60):
        some = []
        for _ in range(rng.randint(1, 4)):
            w = list(base[: rng.randint(50, 70)])
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = word()
            some.append(" ".join(w))
        some += [" ".join(shared + [word() for _ in range(rng.randint(0, 20))]), "", "too short a line", " ".join(word() for _ in range(rng.randint(5, 30)))]
        rng.shuffle(some)
        rows.append((k, "\n".join(some)))
    rows += [(k + 100, rows[k][1]) for k in range(0, 60, 3)]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(k, t, None, None, 0, "", "", 1) for k, t in rows], DOCS).coalesce(1)
    assert got(line_dedup.dedup(frame)) == plain(rows)


def test_short_lines_have_one_token(spark):
    rows = [(k, f"All rights reserved here\nAll  rights reserved\there\nown line {k}\n\nall rights reserved here") for k in range(5)]
    frame = spark.createDataFrame([(k, t, None, None, 0, "", "", 1) for k, t in rows], DOCS)
    assert got(line_dedup.dedup(frame)) == plain(rows)
    assert [t for _, t in plain(rows)][1:] == [f"own line {k}\n" for k in range(1, 5)]


def test_columns_of_any_name_are_kept(spark):
    names = ["epoch", "_row", "_gone", "_tie", "_p", "_spans", "_one", "doc", "lines", "place", "known", "id", "hash", "again", "left", "touched", "a.b"]
    rows = [(k, f"one line of more than five words\nand {k}", *["mine"] * len(names)) for k in (1, 2, 2)]
    frame = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *(f"`{n}` string" for n in names)]))
    out = line_dedup.dedup(frame)
    assert out.columns == frame.columns and got(out) == plain([r[:2] for r in rows])
    assert all(set(r[2:]) == {"mine"} for r in out.collect())


def test_rarity_follows_the_frequency_of_words(spark):
    rows = [(k, f"the of and rare{k} to in") for k in range(300)]
    table = line_dedup.rarity(spark.createDataFrame(rows, "doc_id long, text string"), "text")
    assert sorted(table)[-5:] == [9] * 5 and sum(m in (1, 2) for m in table) >= 295


def test_a_very_long_text_and_a_line_of_many_words(spark):
    base = [f"w{k}" for k in range(60_000)]
    changed = list(base)
    changed[30_000] = "changed"
    rows = [(1, " ".join(base)), (2, "first\n" + " ".join(changed) + "\nlast"), (3, "\n".join(f"line number {k} of a very long text" for k in range(40_000)))]
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: rows[0][1], 2: "first\nlast", 3: rows[2][1]}


def test_no_python_in_the_plans(spark):
    text = line_dedup.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(w in text for w in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))


def test_rows_are_numbered_anew_between_the_passes(spark, tmp_path, monkeypatch):
    rows = [(k, f"own line number {k} of this document\n{'shared line of many documents here' if k % 2 else 'w ' * 6 + str(k)}") for k in range(200)]
    frame = spark.createDataFrame([(k, t, None, None, len(t), "", "", 1) for k, t in rows], DOCS)
    frame.repartition(6).write.parquet(str(tmp_path / "docs"))
    repeated = line_dedup.repeated

    def then_split(*args):
        found = repeated(*args).localCheckpoint()
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        return found

    monkeypatch.setattr(line_dedup, "repeated", then_split)
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a file to a split, then several files or pieces of them
    try:
        assert got(line_dedup.dedup(spark.read.parquet(str(tmp_path / "docs")))) == plain(rows)
    finally:
        for name in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{name}")


def test_lines_whose_parity_differs_too_much_make_no_pair(spark):
    pairs = spark.createDataFrame([(9, 9, 0, 0, 7, 7), (9, 9, 0, 0, 0, 3), (9, 9, 0, 0, 0, 7), (9, 9, 2, 0, 7, 7), (9, 7, 0, 0, 7, 7)], "n_x int, n_y int, i_x int, i_y int, bits_x long, bits_y long")
    assert [r[0] for r in pairs.select(F.expr(line_dedup.FITS)).collect()] == [True, True, False, False, False]


def test_only_lines_with_more_lone_runs_than_a_similar_line_may_lack_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SAMPLED", 256)  # all runs
    base = [f"w{k}" for k in range(14)]
    texts = [" ".join(base), " ".join(base + ["x"]), " ".join(base + ["y", "z", "u"]), " ".join(f"v{k}" for k in range(14)), "a b c d", "e  f\tg h i", "j k l m n " * 6]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(7, texts[3]), (8, "e f g h i")], "doc_id long, text string")
    split = line_dedup.lines(frame, "doc_id", "text")
    assert {r["plain"]: r["p"]["id"] for r in split.collect() if r["p"]["id"] == 5} == {"e f g h i": 5}
    keys = {r["k1"]: r["plain"] for r in split.collect()}
    # Of 10, 11 and 13 runs a similar line may lack 2; 0, 1 and 3 are in no other line. Copies are one line, and short lines have no runs.
    # 26 runs, five of them different: they may lack 5.
    assert {keys[r["k1"]] for r in line_dedup.unlike(split).collect()} == {texts[2], texts[3], "e f g h i"}


def test_most_lines_unlike_all_others_get_no_token_set(spark, monkeypatch):
    rng = random.Random(9)
    some = lambda n: " ".join(f"{rng.randrange(10**6)}" for _ in range(n))
    rows = [(k, "\n".join(some(40) for _ in range(10))) for k in range(30)]
    rows += [(k + 30, rows[k][1].split("\n")[0] + " more\n" + some(40)) for k in range(5)]
    wanted, bodies_of = [], line_dedup.bodies_of
    monkeypatch.setattr(line_dedup, "bodies_of", lambda held, *rest: wanted.append(held.count()) or bodies_of(held, *rest))
    out = got(line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")))
    assert out == plain(rows)
    assert 10 <= wanted[0] <= 80
