from __future__ import annotations

import gzip
import hashlib
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from cargolens.llm import warc

SCHEMA = "page_id long, url string, html string, size long, digest string"
LONG = "<p>" + "y" * 200


def rows():
    found = [(3, "http://a/ b\r\n", LONG), (1, None, LONG), (2, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (None, "n", LONG), (None, "n", "z" * 150), (7, "é", "z" * 150), (8, "v", "é" * 70000)]
    return [(*r, 1, "d") for r in found + [found[0], (8, "v", "other" * 50)]]


def plain(pages):
    out, first = [], {}
    order = sorted(range(len(pages)), key=lambda k: (pages[k][0] is None, pages[k][0] or 0, k))
    for k in order:
        raw = (pages[k][2] or "").encode()
        if len(raw) >= 100:
            first.setdefault(raw, k)
    for k, r in enumerate(pages):
        raw = (r[2] or "").encode()
        revisit = len(raw) >= 100 and first[raw] != k
        out.append((r[0], len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", pages[first[raw]][0] if revisit else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_query(spark):
    pages = [(r["page_id"], r["url"], r["html"]) for r in pq.read_table("/root/testdata/sf0.001/pages.parquet").to_pylist()]
    assert got(warc.query(spark, "/root/testdata/sf0.001")) == plain(pages)


def test_odd_rows_small_files_and_repeated_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 700)
    frame = spark.createDataFrame(rows(), SCHEMA).coalesce(1)
    written = []
    for name in ("a", "b"):
        manifest = warc.write(frame if name == "a" else frame.coalesce(1), str(tmp_path / name), file_bytes=600)
        assert got(warc.read(manifest)) == plain(rows())
        written.append({p.name: p.read_bytes() for p in Path(tmp_path / name).glob("*.gz")})
        spark.conf.set("spark.sql.shuffle.partitions", "3")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert written[0] == written[1] and len(written[0]) > 3
    assert not list(tmp_path.glob("*/_temporary*.gz*"))
    text = gzip.decompress(written[0][min(written[0])])
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: ")
    assert got(warc.read(warc.write(frame.where("false"), str(tmp_path / "none")))) == []


def test_damage_is_noticed(spark, tmp_path):
    manifest = warc.write(spark.createDataFrame(rows()[:3], SCHEMA).coalesce(1), str(tmp_path / "d"))
    path = next(Path(tmp_path / "d").glob("*.gz"))
    path.write_bytes(gzip.compress(gzip.decompress(path.read_bytes()).replace(b"yyyy", b"yyyx", 1)))
    with pytest.raises(Exception, match="damaged"):
        warc.read(manifest).collect()


def test_rows_are_numbered_anew_between_the_reads(spark, tmp_path, monkeypatch):
    pages = [(k, f"u{k}", f"<p>{k % 20}" + "x" * 200 if k % 3 else "small", 1, "d") for k in range(300)] + rows() * 2
    spark.createDataFrame(pages, SCHEMA).repartition(6).write.parquet(str(tmp_path / "pages"))
    plan = warc.plan

    def then_split(*args):
        found = plan(*args)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        return found

    monkeypatch.setattr(warc, "plan", then_split)
    monkeypatch.setattr(warc, "SHARD_BYTES", 5000)
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a file to a split, then several files or pieces of them
    try:
        assert got(warc.read(warc.write(spark.read.parquet(str(tmp_path / "pages")), str(tmp_path / "out")))) == plain(pages)
    finally:
        for name in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{name}")


def test_payloads_that_change_between_the_reads_are_an_error(spark, tmp_path, monkeypatch):
    plan, frame = warc.plan, spark.createDataFrame(rows(), SCHEMA).coalesce(1)
    other = spark.createDataFrame([(*r[:2], r[2] + "!" if r[0] == 8 else r[2], *r[3:]) for r in rows()], SCHEMA)
    monkeypatch.setattr(warc, "plan", lambda pages, *names: plan(other, *names))
    with pytest.raises(Exception, match="changed between two reads"):
        warc.write(frame, str(tmp_path / "changed"))


def test_equal_rows_of_many_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 700)
    pages = [(None, "u", LONG, 1, "d")] * 40 + [(1, None, "tiny", 1, "d")] * 300 + [(2, u, LONG + "2", 1, "d") for u in ("b", "a", None)] * 5
    manifest = warc.write(spark.createDataFrame(pages, SCHEMA).repartition(5), str(tmp_path / "equal"))
    assert got(warc.read(manifest)) == plain(pages) and manifest.select("shard").distinct().count() > 5


def test_record_ids_are_unique_and_revisits_name_their_response(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 700)
    pages = rows() + [(None, "u", LONG, 1, "d")] * 9 + [(1, None, "tiny", 1, "d")] * 20 + [(2, u, LONG + "2", 1, "d") for u in ("b", "a", None, "")] * 5
    ids, refers = [], []
    for run in range(2):
        frame = spark.createDataFrame(pages, SCHEMA).repartition(2 + 3 * run)
        names = [r["uri"] for r in warc.write(frame, str(tmp_path / f"ids{run}")).collect()]
        headers = []
        for name in names:
            with open(name, "rb") as stream:
                headers += [h for h, _ in warc.records(stream)]
        ids.append({h["WARC-Record-ID"]: h["WARC-Type"] for h in headers})
        refers.append({h["WARC-Refers-To"] for h in headers if h["WARC-Type"] == "revisit"})
        assert len(ids[-1]) == len(headers) == len(pages)
    assert ids[0] == ids[1] and refers[0] == refers[1]
    assert {ids[0][r] for r in refers[0]} == {"response"}
