"""Periodic runs of words by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q that is at least twice as long as q (and ``LEAST``
words or more) and that no neighbouring word extends. The words of a stretch make a suffix automaton. Its states,
under their suffix links, form a tree whose path from the state of a prefix to the root holds all suffixes of
that prefix. Word by word, that path is accessed in a link-cut tree and recoloured with the word's
position, so a state's colour is the last end of its strings. Each access cuts the path into segments of one old
colour: the deepest state of a segment tells how long the suffix is that ended there before. If the distance
of the ends is no more than that length, the suffix repeats itself directly: a square, with its smallest
period, whose left end is as far as it goes. The last end at which (start, period) shows up is the right end of the run.

Only stretches that can hold a run go through the automaton. A run of 12 words or more repeats its windows of
6 words one period later, and these windows cover all its words, without a gap. So windows that a stretch
holds once cannot be part of a run of it; stretches are cut there until nothing changes. No run is lost or cut.

Defined results: null text has no words; texts without a run give an empty list and their words joined by one space; a null
key stays null; repeated rows are treated alike; an empty table gives an empty table; very long texts take time in
proportion to n log n in their periodic stretches; only the key and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.llm.common import let, ready, words

#: Shortest run, and the window that must repeat inside one: half of it.
LEAST = 12
WINDOW = LEAST // 2
#: Words of documents whose windows are counted in one go; a longer document is one go of its own.
GO = 1 << 18


class Automaton:
    """Suffix automaton of a sequence; state 1 is the root, 0 is nothing."""

    def __init__(self, sequence: list[int]):
        length, link, step = [0, 0], [0, 0], [{}, {}]
        last, ends = 1, []
        for symbol in sequence:
            new = len(length)
            length.append(length[last] + 1)
            link.append(1)
            step.append({})
            at = last
            while at and symbol not in step[at]:
                step[at][symbol] = new
                at = link[at]
            if at:
                found = step[at][symbol]
                if length[found] == length[at] + 1:
                    link[new] = found
                else:
                    split = len(length)
                    length.append(length[at] + 1)
                    link.append(link[found])
                    step.append(step[found].copy())
                    while at and step[at].get(symbol) == found:
                        step[at][symbol] = split
                        at = link[at]
                    link[found] = link[new] = split
            last = new
            ends.append(new)
        self.length, self.link, self.ends = length, link, ends


class Paths:
    """Link-cut tree over the suffix links: coloured preferred paths, each kept in a splay tree ordered by depth.

    All states of a path have one colour, which is stored at the root of its splay tree.
    """

    def __init__(self, link: list[int]):
        self.up = list(link)  # parent in the splay tree; at its root, the state above the path's top
        self.left, self.right = [0] * len(link), [0] * len(link)
        self.colour = [-1] * len(link)

    def splay(self, x: int) -> None:
        """Makes ``x`` the root of its splay tree, which hands its colour on."""
        up, left, right = self.up, self.left, self.right
        y = up[x]
        while y and (left[y] == x or right[y] == x):
            z = up[y]
            inner = z and (left[z] == y or right[z] == y)
            if inner and (left[z] == y) == (left[y] == x):
                self.rotate(y)
                self.rotate(x)
            elif inner:
                self.rotate(x)
                self.rotate(x)
            else:
                self.rotate(x)
                self.colour[x] = self.colour[y]
                return
            y = up[x]
            if not (y and (left[y] == x or right[y] == x)):
                self.colour[x] = self.colour[z]
                return

    def rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if left[y] == x:
            inner = left[y] = right[x]
            right[x] = y
        else:
            inner = right[y] = left[x]
            left[x] = y
        if inner:
            up[inner] = y
        up[y] = x
        up[x] = z
        if left[z] == y:
            left[z] = x
        elif right[z] == y:
            right[z] = x

    def access(self, state: int, colour: int) -> list[tuple[int, int]]:
        """Recolours the path from the root to ``state``; returns its old segments as (deepest state, old colour)."""
        up, right, colours = self.up, self.right, self.colour
        segments, below, x = [], 0, state
        while x:
            self.splay(x)
            if colours[x] >= 0:
                segments.append((x, colours[x]))
            if right[x]:  # what lies deeper stays behind, with its old colour
                colours[right[x]] = colours[x]
            right[x] = below
            below, x = x, up[x]
        colours[below] = colour
        return segments


def runs_in(sequence: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of the runs of a sequence, by start and period."""
    automaton = Automaton(sequence)
    paths, length = Paths(automaton.link), automaton.length
    ends: dict[tuple[int, int], int] = {}
    for end, state in enumerate(automaton.ends):
        for deepest, before in paths.access(state, end):
            period, common = end - before, length[deepest]
            if period <= common:
                ends[end - common - period + 1, period] = end
    found = ((start, end - start + 1, period) for (start, period), end in ends.items())
    return sorted((r for r in found if r[1] >= least), key=lambda r: (r[0], r[2]))


def named(pairs: np.ndarray) -> np.ndarray:
    """A small number for each distinct value."""
    return np.unique(pairs, return_inverse=True)[1]


def windows(ids: np.ndarray) -> np.ndarray:
    """A number per place, equal where the ``WINDOW`` words from there on are (beyond the end: any)."""
    padded = np.concatenate([ids, np.full(WINDOW, ids.max(initial=0) + 1)])
    name, size = padded, 1
    while size < WINDOW:  # windows of two sizes that are known make a larger one, named without hashing
        step = min(size, WINDOW - size)
        later = np.concatenate([name[step:], np.full(step, name[-1])])
        name = named(name * (int(later.max()) + 1) + later)
        size += step
    return name[: len(ids)]


def stretches(ids: np.ndarray, docs: np.ndarray) -> list[tuple[int, int]]:
    """``[from, to)`` of the stretches inside one document whose every word lies in a window that the stretch holds twice."""
    n = len(ids)
    gram, part, inside = windows(ids), docs.astype(np.int64), np.ones(n, bool)
    while n:
        place = np.flatnonzero(inside[: n - WINDOW + 1]) if n >= WINDOW else np.zeros(0, np.int64)
        place = place[part[place] == part[place + WINDOW - 1]]  # a stretch has no gap: its ends tell
        place = place[inside[place + WINDOW - 1]]
        key = part[place] * (int(gram.max()) + 1) + gram[place]
        _, where, count = np.unique(key, return_inverse=True, return_counts=True)
        starts = place[count[where] > 1]
        cover = np.zeros(n + 1, np.int64)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + WINDOW, -1)
        kept = np.cumsum(cover[:n]) > 0
        edge = np.ones(n, bool)
        edge[1:] = (kept[1:] != kept[:-1]) | (part[1:] != part[:-1])
        part = np.cumsum(edge)
        if (kept == inside).all():
            break
        inside = kept
    bounds = np.flatnonzero(np.concatenate([np.diff(np.concatenate([[0], np.where(inside, part, 0)])) != 0, [True]]))
    return [(int(a), int(b)) for a, b in zip(bounds[:-1], bounds[1:], strict=True) if inside[a] and b - a >= LEAST]


def in_documents(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs of each document, given as words."""
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for words_ in texts for w in words_), np.int64)
    sizes = np.array([len(w) for w in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in stretches(ids, np.repeat(np.arange(len(texts)), sizes)):
        k = int(np.searchsorted(first, a, "right")) - 1
        shift = a - int(first[k])
        out[k] += [(start + shift, length, period) for start, length, period in runs_in(ids[a:b].tolist())]
    return out


def collapsed(words_: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside the repetitions: of each run only its first period stays, unless another run takes it."""
    if not runs:
        return b" ".join(words_)
    gone = np.zeros(len(words_) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.cumsum(gone[:-1]) == 0
    return b" ".join(w for w, k in zip(words_, kept.tolist(), strict=True) if k)


def groups(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """Words of the documents of a batch, in goes of about ``GO`` words; ``bytes.split`` splits at the same white space as ``common.words``."""
    held, size = [], 0
    for text in texts.cast(pa.large_string()).cast(pa.large_binary()):
        held.append((text.as_py() or b"").split())
        size += len(held[-1])
        if size >= GO:
            yield held
            held, size = [], 0
    if held:
        yield held


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, runs, collapsed)`` per document: its runs by start and period, and its text without the repetitions."""
    ready(docs.sparkSession)
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for held in groups(batch.column(1)):
                found = in_documents(held)
                left = [collapsed(w, r).decode() for w, r in zip(held, found, strict=True)]
                listed = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found]
                arrays = [batch.column(0).slice(at, len(held)), pa.array(listed, pa.list_(run_type)), pa.array(left, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "runs", "collapsed"])
                at += len(held)

    kind = docs.schema[key].dataType.simpleString()
    read = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    found = read.mapInArrow(run, f"key {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return found.withColumnRenamed("key", key)


def with_repetitions(text: Column, key: Column) -> Column:
    """The query's input: in a tenth of the documents, told by their id, the words from some place on repeat."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def spread(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        place = lambda i: (a + F.pmod(i - a, p)).cast("int")
        return F.array_join(F.transform(w, lambda x, i: F.when(i >= a, F.get(w, place(i))).otherwise(x)), " ")

    chosen = F.coalesce(h % 10 == 0, F.lit(False)) & text.isNotNull()
    return F.when(chosen, let(words(text), lambda w: F.when(F.size(w) > 0, spread(w)).otherwise(F.lit("")))).otherwise(text)


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: number of runs, the longest one, and digests of all runs and of the collapsed text."""
    order = F.array_sort("runs", lambda a, b: F.when(a["length"] != b["length"], F.sign(b["length"] - a["length"])).when(a["start"] != b["start"], F.sign(a["start"] - b["start"])).otherwise(F.sign(a["period"] - b["period"])).cast("int"))
    best = F.get(order, F.lit(0))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", best).select(
        key,
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Runs of every document, a tenth of which repeat themselves by rule."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(find(docs.select("doc_id", with_repetitions(F.col("text"), F.col("doc_id")).alias("text"))))
