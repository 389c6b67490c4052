"""Token counts as delta-maintained rollups.

A batch of changes is folded to signed sums per source, language and tokenizer version and committed under its
id: an insert adds, a delete subtracts, a revised count takes the old number off its version and adds the
new one to its own. Totals are the sum of all committed batches, whatever their order. A batch
id is committed once: committing it again with the same sums changes nothing, with other sums it is an error, and one that broke off before
its commit does not count.

Open batches are folded into a table of totals, so a read costs that table and at most ``fold_after`` batches, however many were ever
committed. Batches and totals are written to folders of their own, and a small file renamed into place says that they count; the file
of the totals names the batches they hold, with a digest each. Whenever a step stops, what is left reads the same. What is not
named any more goes with ``sweep``, when readers of former totals are done and no commit is under way.

Changes are summed before the shuffle, so one source with a third of all rows sends no more than any other.

Defined results: null sources, languages and versions are groups of their own; null counts are 0; null or empty texts have no
tokens and still count as documents; repeated changes count each time within a batch; empty batches add nothing; a group
without documents and tokens is left out; extra columns are not read.
"""

from __future__ import annotations

import json
import re
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens.llm.bpe import encoder
from cargolens.llm.common import filesystem, ready, stage
from cargolens.llm.token_files import make_folder
from cargolens.session import shared_dir
from cargolens.streaming.slices import remove

#: Columns of a batch of changes; ``op`` is insert, delete or revise, and old values are read by the last two.
CHANGES = "op string, source string, lang string, old_version string, old_tokens long, new_version string, new_tokens long"
GROUP = ["source", "lang", "tokenizer_version"]


def count_tokens(text: Column, vocabulary: str) -> Column:
    """Number of BPE tokens of whole texts."""

    @F.pandas_udf(T.LongType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sum(map(len, encoder(vocabulary).parts_of(t or "")))).astype("int64")

    return run(text)


def signed(changes: DataFrame) -> DataFrame:
    """Signed rows of changes: one for what goes, one for what comes."""
    gone = F.struct(F.col("old_version").alias("tokenizer_version"), F.lit(-1).alias("documents"), (-F.coalesce("old_tokens", F.lit(0))).alias("tokens"))
    come = F.struct(F.col("new_version").alias("tokenizer_version"), F.lit(1).alias("documents"), F.coalesce("new_tokens", F.lit(0)).alias("tokens"))
    parts = F.when(F.col("op") == "insert", F.array(come)).when(F.col("op") == "delete", F.array(gone)).when(F.col("op") == "revise", F.array(gone, come))
    parts = F.coalesce(parts, F.raise_error(F.concat(F.lit("unknown change "), F.coalesce("op", F.lit("null")))))
    return changes.select("source", "lang", F.explode(parts).alias("x")).select("source", "lang", "x.*")


def sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))


def digest(rows: DataFrame) -> str:
    """What a batch's sums amount to, in any order of rows."""
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    hashes = [wide(F.xxhash64(F.lit(seed), *[f(c) for c in GROUP for f in (F.isnull, F.col)], "documents", "tokens")) for seed in (1, 2)]
    return ":".join(str(x) for x in rows.agg(F.count("*"), *hashes).head())


class Rollup:
    """A table of totals and the batches committed since, below one shared folder."""

    def __init__(self, spark: SparkSession, folder: str, fold_after: int = 32):
        self.spark, self.folder, self.fold_after = spark, folder, fold_after
        for part in ("commits", "totals"):
            make_folder(f"{folder}/{part}")

    def _names(self, part: str) -> list[str]:
        """Files and folders of a part, by name."""
        from pyarrow import fs

        files, root = filesystem(f"{self.folder}/{part}")
        return sorted(i.base_name for i in files.get_file_info(fs.FileSelector(root, allow_not_found=True)))

    def _load(self, name: str) -> dict:
        files, path = filesystem(f"{self.folder}/{name}")
        with files.open_input_stream(path) as stream:
            return json.loads(stream.read())

    def _publish(self, name: str, content: dict) -> None:
        from pyarrow import fs

        files, final = filesystem(f"{self.folder}/{name}")
        folder, _, base = final.rpartition("/")
        temporary = f"{folder}/_{uuid.uuid4().hex}"
        with files.open_output_stream(temporary) as stream:
            stream.write(json.dumps(content).encode())
        if files.get_file_info(final).type != fs.FileType.NotFound:
            files.delete_file(temporary)
            raise FileExistsError(base)
        files.move(temporary, final)

    def _current(self) -> tuple[int, dict]:
        """Version and content of the totals; version 0 holds no batch."""
        versions = [n for n in self._names("totals") if re.fullmatch(r"\d+\.json", n)]
        if not versions:
            return 0, {"folder": None, "batches": {}}
        return int(versions[-1].removesuffix(".json")), self._load(f"totals/{versions[-1]}")

    def _open(self, held: dict) -> dict[str, dict]:
        """Commits that the totals do not hold."""
        names = [n.removesuffix(".json") for n in self._names("commits") if n.endswith(".json")]
        return {b: self._load(f"commits/{b}.json") for b in names if b not in held["batches"]}

    def _sums(self, held: dict, more: dict[str, dict]) -> DataFrame:
        places = [f"{self.folder}/{x}" for x in [held["folder"], *[c["folder"] for c in more.values()]] if x]
        empty = "source string, lang string, tokenizer_version string, documents long, tokens long"
        rows = self.spark.read.schema(empty).parquet(*places) if places else self.spark.createDataFrame([], empty)
        return sums(rows).where("documents <> 0 OR tokens <> 0")

    def _digests(self) -> dict[str, str]:
        _, held = self._current()
        return held["batches"] | {b: c["digest"] for b, c in self._open(held).items()}

    def batches(self) -> list[str]:
        """Ids whose commit is complete."""
        return sorted(self._digests())

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds a batch; False when it is there already."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", batch):
            raise ValueError(f"not a batch id: {batch!r}")
        rows = sums(signed(changes))
        if batch in (known := self._digests()):
            return self._again(batch, known[batch], digest(rows))
        place = f"deltas/{batch}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/{place}")
        found = digest(self.spark.read.schema(rows.schema).parquet(f"{self.folder}/{place}"))
        try:
            self._publish(f"commits/{batch}.json", {"folder": place, "digest": found})
        except FileExistsError:  # another writer was faster
            return self._again(batch, self._digests()[batch], found)
        _, held = self._current()
        if len(self._open(held)) >= self.fold_after:
            self.fold()
        return True

    @staticmethod
    def _again(batch: str, known: str, found: str) -> bool:
        if known != found:
            raise ValueError(f"batch {batch!r} was committed with other content")
        return False

    def fold(self) -> int:
        """Adds the open batches to the totals; returns how many."""
        version, held = self._current()
        more = self._open(held)
        if more:
            place = f"totals/{version + 1:012d}-{uuid.uuid4().hex}"
            self._sums(held, more).write.parquet(f"{self.folder}/{place}")
            digests = held["batches"] | {b: c["digest"] for b, c in more.items()}
            self._publish(f"totals/{version + 1:012d}.json", {"folder": place, "batches": digests})
        return len(more)

    def sweep(self) -> int:
        """Removes folded batches, former totals and what broke off; returns how many folders."""
        version, held = self._current()
        kept = {held["folder"], *[c["folder"] for c in self._open(held).values()]}
        folders = [f"{part}/{n}" for part in ("deltas", "totals") for n in self._names(part) if not n.endswith(".json") and n[0] != "_"]
        gone = [f for f in folders if f not in kept]
        done = [f"commits/{b}.json" for b in held["batches"] if f"{b}.json" in self._names("commits")]
        old = [f"totals/{n}" for n in self._names("totals") if re.fullmatch(r"\d+\.json", n) and int(n.removesuffix(".json")) < version]
        for name in [*done, *old, *gone]:
            remove(self.spark, f"{self.folder}/{name}")
        return len(gone)

    def totals(self) -> DataFrame:
        """Documents and tokens of every group that has any."""
        _, held = self._current()
        return self._sums(held, self._open(held))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: inserted with a count estimated from their bytes, revised to the counts of a tokenizer; about one in 16 is deleted and inserted again."""
    from public_tokenizers import path

    ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    guess = F.ceil(F.octet_length(F.coalesce("text", F.lit(""))) / 4).cast("long")
    counted = stage(docs.select("source", "lang", guess.alias("guess"), count_tokens(F.col("text"), path("byte_bpe_50k.json")).alias("n")), "counts")
    none = F.lit(None)
    rows = lambda df, op, *old_new: df.select(F.lit(op).alias("op"), "source", "lang", *[c.cast(t).alias(n) for c, t, n in zip(old_new, ("string", "long", "string", "long"), ("old_version", "old_tokens", "new_version", "new_tokens"), strict=True)])
    rollup = Rollup(spark, shared_dir(spark, "token-counts"), fold_after=2)
    estimate, exact = F.lit("bytes_4"), F.lit("byte_bpe_50k")
    moved = counted.where("guess % 16 = 0")  # texts without bytes among them
    batches = {
        "0001-insert": rows(counted, "insert", none, none, estimate, F.col("guess")),
        "0002-revise": rows(counted, "revise", estimate, F.col("guess"), exact, F.col("n")),
        "0003-delete": rows(moved, "delete", exact, F.col("n"), none, none),
        "0004-insert": rows(moved, "insert", none, none, exact, F.col("n")),
    }
    for batch, changes in batches.items():
        rollup.commit(batch, changes)
    rollup.commit("0002-revise", batches["0002-revise"])  # a replay, as after a lost acknowledgement
    return rollup.totals()
