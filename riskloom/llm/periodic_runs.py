"""Periodic runs of words: tiles by period octave, solved one by one, stitched by document and period."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import WORD, partitions, small_batches, table, whole_text, written
from riskloom.llm.textbytes import random_words

#: a run has so many words at least, and so many periods
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: words that tiles of low octaves hold, as tiles of their own length would overlap too much
TILE_WORDS = 4096
#: words of tiles that are solved together
SOLVED_WORDS = 1 << 20
EXPLODED = "row_id long, doc_id long, plain_sha256 string, text string, octave int, begin long, words binary"
REPORT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs array<struct<start: long, length: long, period: long>>, runs_sha256 string, collapsed string, collapsed_sha256 string")

_MULTIPLIERS = random_words(1212, 64) | np.uint64(1)


def block_words(octave: int) -> int:
    """Words of the blocks of an octave: any stretch that a run repeats holds a whole one, at a multiple of this."""
    return max(8, 1 << octave)


def tile_words(octave: int) -> int:
    return max(TILE_WORDS, 8 << octave)


def tile_step(octave: int) -> int:
    """Neighbouring tiles share two blocks and a period, so pieces of one run overlap by a period and are found."""
    return tile_words(octave) - max(32, 4 << octave)


def octaves(n_words: int) -> range:
    """The octaves (periods from 2**k to 2**(k+1) - 1) that a document of ``n_words`` words may have runs in."""
    return range((n_words // LEAST_PERIODS).bit_length()) if n_words >= LEAST_WORDS else range(0)


def equal_blocks(marks: np.ndarray, octave: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): blocks whose mark comes again a period of the octave later. ``marks[i]`` stands for a block's
    words from word i on."""
    size = block_words(octave)
    rows = np.zeros(-(-len(marks) // size) * size, marks.dtype)
    rows[:len(marks)] = marks
    rows = rows.reshape(-1, size)
    if size == 1 << octave:
        row, period = np.nonzero(rows[1:] == rows[:-1, :1])
        return row * size, period + size
    row, period = np.nonzero(rows[:, 1 << octave:2 << octave] == rows[:, :1])
    return row * size, period + (1 << octave)


def tiles_with_repeats(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(document, octave, tile) of all tiles that hold a block twice, a period of the octave apart.

    Documents lie behind each other in ``codes``, longest first. A tile that isn't named holds no piece of a run. Blocks
    are compared by 64-bit sums here; one that is named wrongly costs time only.
    """
    marks, length = codes.astype(np.uint64) * _MULTIPLIERS[0] + _MULTIPLIERS[1], 1
    marks ^= marks >> np.uint64(29)
    for octave in octaves(int(sizes[0]) if len(sizes) else 0):
        alive = int(np.searchsorted(-sizes, -max(LEAST_WORDS, LEAST_PERIODS << octave), "right"))
        end = int(starts[alive - 1] + sizes[alive - 1])
        size = block_words(octave)
        while length < size:
            marks = marks[:-length] * _MULTIPLIERS[length.bit_length() + 1] + marks[length:]
            length *= 2
        marks = marks[:max(0, end - length + 1)]
        place, period = equal_blocks(marks, octave)
        doc = np.searchsorted(starts, place, "right") - 1
        inside = place + period + size <= starts[doc] + sizes[doc]
        place, period, doc = place[inside] - starts[doc[inside]], period[inside], doc[inside]
        step, words = tile_step(octave), tile_words(octave)
        last_tile = np.maximum(0, -(-(sizes[doc] - words) // step))
        high = np.minimum(place // step, last_tile)
        low = np.maximum(0, -(-(place + period + size - words) // step))
        named = np.concatenate([doc[low <= high] << 32 | high[low <= high], doc[low < high] << 32 | low[low < high]])
        for key in np.unique(named).tolist():
            yield key >> 32, octave, key & 0xFFFFFFFF


def _split(texts: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
    """Words of every text, and how many each has."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.string()))
    flat, sizes = lists.flatten(), np.asarray(pc.list_value_length(lists))
    solid = np.asarray(pc.not_equal(flat, ""))
    kept = np.concatenate([[0], np.cumsum(solid)])[np.concatenate([[0], np.cumsum(sizes)])]
    return pa.ListArray.from_arrays(pa.array(kept, pa.int32()), flat.filter(pa.array(solid))), np.diff(kept)


def _explode(keep_texts: bool):
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            lists, sizes = _split(batch.column("text"))
            codes = np.asarray(lists.flatten().dictionary_encode().indices)
            plain = pc.binary_join(lists, " ")
            starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            long = np.flatnonzero(sizes >= LEAST_WORDS)
            long = long[np.argsort(-sizes[long], kind="stable")]
            if len(long):
                spread = np.concatenate([codes[starts[i]:starts[i] + sizes[i]] for i in long])
                named = tiles_with_repeats(spread, np.concatenate([[0], np.cumsum(sizes[long])])[:-1], sizes[long])
            else:
                named = iter(())
            tiles, repeats, held = [], np.zeros(batch.num_rows, bool), 0
            for doc, octave, tile in named:
                i, begin = int(long[doc]), tile * tile_step(octave)
                words = codes[starts[i] + begin:starts[i] + min(sizes[i], begin + tile_words(octave))]
                tiles.append((row_id + i, octave, begin, words.astype("<i4").tobytes()))
                repeats[i] = True
                held += len(words)
                if held > SOLVED_WORDS:
                    yield _tile_rows(tiles)
                    tiles, held = [], 0
            yield _tile_rows(tiles)
            digests = [hashlib.sha256(t.as_buffer()).hexdigest() for t in plain]
            texts = plain if keep_texts else pc.if_else(pa.array(repeats), plain, pa.scalar(None, pa.string()))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(row_id + np.arange(n)), batch.column("doc_id"), pa.array(digests, pa.string()), texts,
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())],
                ["row_id", "doc_id", "plain_sha256", "text", "octave", "begin", "words"])
            row_id += n

    return explode


def _tile_rows(tiles: list) -> pa.RecordBatch:
    n, (rows, of_octave, begins, words) = len(tiles), zip(*tiles) if tiles else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(rows, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string()),
         pa.array(of_octave, pa.int32()), pa.array(begins, pa.int64()), pa.array(words, pa.binary())],
        ["row_id", "doc_id", "plain_sha256", "text", "octave", "begin", "words"])


class Names:
    """Exact names of all stretches of 1, 2, 4, ... words: two have one name if they are equal, word by word."""

    def __init__(self, codes: np.ndarray, longest: int) -> None:
        self.levels = [codes.astype(np.int64)]
        while 2 << len(self.levels) - 1 <= longest:
            last, size = self.levels[-1], 1 << len(self.levels) - 1
            pairs = (last[:-size].astype(np.int64) << 32) | last[size:]
            self.levels.append(pd.factorize(pairs)[0].astype(np.int32))

    def forward(self, place: np.ndarray, period: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The Z-function of the words from ``place`` on, at ``period``: how far both go on equally before ``end``."""
        z = np.zeros(len(place), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            go = np.flatnonzero(place + z + period + (1 << j) <= end)
            at = place[go] + z[go]
            z[go] += (self.levels[j][at] == self.levels[j][at + period[go]]).astype(np.int64) << j
        return z

    def backward(self, place: np.ndarray, period: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The Z-function of the reversed words before ``place``, at ``period`` (against those before place + period)."""
        z = np.zeros(len(place), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            go = np.flatnonzero(place - z - (1 << j) >= start)
            at = place[go] - z[go] - (1 << j)
            z[go] += (self.levels[j][at] == self.levels[j][at + period[go]]).astype(np.int64) << j
        return z


@cache
def _least_prime(below: int) -> np.ndarray:
    """The least prime that divides each number."""
    least = np.arange(below)
    for p in range(2, int(below ** 0.5) + 1):
        if least[p] == p:
            multiples = least[p * p::p]
            multiples[multiples == np.arange(p * p, below, p)] = p
    return least


def solve(octave: int, tiles: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tile, period, start, end) of the stretches of each tile that have a smallest period in the octave, go on as long
    as they keep it within the tile, and repeat two blocks at least.

    Boundaries lie at multiples of the block size. At each, the two Z-functions tell for a period how far the words
    on both sides of the boundary equal those a period later. Periods are tried where the block behind the
    boundary comes again; a stretch as long as asked for holds such a block. A stretch whose first period is itself a
    power has a smaller period, also in the whole run, and is left to that one's octave.
    """
    sizes = np.asarray([len(t) for t in tiles])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    size = block_words(octave)
    names = Names(np.concatenate(tiles), int(sizes.max()))
    level = size.bit_length() - 1
    if level >= len(names.levels):
        return (np.zeros(0, np.int64),) * 4
    place, period = equal_blocks(names.levels[level] + 1, octave)
    tile = np.searchsorted(starts, place, "right") - 1
    inside = (tile < len(tiles)) & (place + period + size <= starts[np.minimum(tile + 1, len(tiles))])
    place, period, tile = place[inside], period[inside], tile[inside]
    onward, back = names.forward(place, period, starts[tile + 1]), names.backward(place, period, starts[tile])
    enough = onward + back >= 2 * size
    found = np.unique(np.stack([tile, period, place - back, place + period + onward], 1)[enough], axis=0)
    tile, period, start, end = found.T
    rest, power = period.copy(), np.zeros(len(found), bool)
    least = _least_prime(2 << octave)
    while (open_ := np.flatnonzero(rest > 1)).size:
        prime = least[rest[open_]]
        part = period[open_] // prime
        power[open_] |= names.forward(start[open_], part, end[open_]) >= period[open_] - part
        while (more := rest[open_] % prime == 0).any():
            rest[open_] = np.where(more, rest[open_] // prime, rest[open_])
    tile, period, start, end = found[~power].T
    return tile, period, start - starts[tile], end - starts[tile]


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        waiting: dict[int, list] = {}
        rows, octave_of, begins = (np.asarray(batch.column(c)) for c in ("row_id", "octave", "begin"))
        for i, words in enumerate(batch.column("words")):
            waiting.setdefault(int(octave_of[i]), []).append((rows[i], begins[i], np.frombuffer(words.as_buffer(), "<i4")))
        for octave, tiles in waiting.items():
            low = 0
            while low < len(tiles):
                high, held = low, 0
                while high < len(tiles) and (high == low or held + len(tiles[high][2]) <= SOLVED_WORDS):
                    held += len(tiles[high][2])
                    high += 1
                some = tiles[low:high]
                tile, period, start, end = solve(octave, [t[2] for t in some])
                of_row, begin = np.asarray([t[0] for t in some]), np.asarray([t[1] for t in some])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of_row[tile]), pa.array(period), pa.array(begin[tile] + start), pa.array(begin[tile] + end)],
                    ["row_id", "period", "start", "end"])
                low = high


def exploded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_texts: bool = False) -> DataFrame:
    """The documents (octave is null) and, by octave, those overlapping tiles of them in which a block repeats.

    Texts stay with documents that have such a tile, or with all.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return written(rows.mapInArrow(_explode(keep_texts), EXPLODED), "run-tiles")


def stitched(tiles: DataFrame) -> DataFrame:
    """row_id, start, length, period of every run: pieces of one document and period that overlap by a period or more
    are one. Tiles are dealt out by themselves, so the tiles of a very long document are solved all over the cluster."""
    pieces = (tiles.where("octave is not null").select("row_id", "octave", "begin", "words")
              .repartition(partitions(tiles.sparkSession), "row_id", "octave", "begin")
              .mapInArrow(_solved, "row_id long, period long, start long, end long"))
    order = Window.partitionBy("row_id", "period").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = (reached.isNull() | (F.col("start") > reached - F.col("period"))).cast("int")
    numbered = pieces.withColumn("opens", opens).withColumn("run", F.sum("opens").over(order))
    runs = numbered.groupBy("row_id", "period", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.select("row_id", "start", (F.col("end") - F.col("start")).alias("length"), "period").where(
        f"length >= {LEAST_WORDS} and length >= {LEAST_PERIODS} * period")


def _collapse(text: str, runs: list[dict]) -> str:
    """The text without the words that any run holds after its first period."""
    words = text.split(" ")
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, [r["start"] + r["period"] for r in runs], 1)
    np.add.at(change, [r["start"] + r["length"] for r in runs], -1)
    return " ".join([w for w, n in zip(words, np.cumsum(change).tolist()) if not n])


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            runs = row["runs"] or []
            best = max(runs, key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]), default=None)
            lines = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in runs)
            text = _collapse(row["text"], runs) if runs else row["text"]
            out.append({
                "doc_id": row["doc_id"], "n_runs": len(runs), **(best or dict.fromkeys(("start", "length", "period"))),
                "exponent_milli": best and 1000 * best["length"] // best["period"], "runs": runs,
                "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(), "collapsed": text,
                "collapsed_sha256": hashlib.sha256(text.encode()).hexdigest() if runs else row["plain_sha256"]})
        struct = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
        text_type, number = pa.string(), pa.int64()
        yield pa.RecordBatch.from_pylist(out, pa.schema([
            *((c, number) for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")),
            ("runs", pa.list_(struct)), ("runs_sha256", text_type), ("collapsed", text_type), ("collapsed_sha256", text_type)]))


def run_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_texts: bool = False) -> DataFrame:
    """For every row of ``docs`` its runs of repeated words and the text without the repeats.

    A run is a stretch of consecutive words (white space is blanks and tab .. carriage return) with smallest period q,
    at least 24 words and three periods long, that can't be made longer. Columns: doc_id, n_runs; start, length, period and
    exponent_milli (1000 x length / period, floored) of the run with the greatest exponent (ties: first
    start, then period; null without a run); runs, in order of start and period; runs_sha256 of their lines;
    collapsed, the words joined by a blank without those that a run holds after its first period (null for a
    document without a repeated block, unless ``keep_texts``), and collapsed_sha256.

    Documents are cut into overlapping tiles, longer ones for longer periods; the tiles with a block that comes again are
    dealt over the cluster and solved alone; only pieces of runs and the texts that have them are shuffled again. A
    task holds one tile of the highest octave at least, which is as long as the document.

    Null texts count as empty; texts without 24 words have no runs; null ids and repeated rows each give their row;
    an empty table gives none. Other columns are not read.
    """
    tiles = exploded(docs, id_col, text_col, keep_texts)
    runs = stitched(tiles).groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("found"))
    runs = runs.select("row_id", F.transform("found", lambda r: F.struct(r.start, r.length, r.period)).alias("runs"))
    rows = tiles.where("octave is null").select("row_id", "doc_id", "plain_sha256", "text").join(runs, "row_id", "left")
    return rows.mapInArrow(_report, REPORT)


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, every tenth text (by the id's checksum) made to repeat some of its words to the end."""
    ids = docs.select("doc_id", whole_text("text").alias("text"), F.crc32(F.col("doc_id").cast("string")).alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    counted = ids.withColumn("g", F.floor(F.col("h") / 10)).withColumn("words", words).withColumn("n", F.size("words").cast("long"))
    placed = counted.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    placed = placed.withColumn("rest", (F.col("n") - F.col("a")).cast("int"))
    placed = placed.withColumn("p", F.when(F.col("n") > 0, 1 + F.floor(F.col("rest") / (3 + F.col("g") % 8))).cast("int"))
    root = F.slice("words", F.col("a") + 1, F.col("p"))
    again = F.slice(F.flatten(F.array_repeat(root, F.ceil(F.col("rest") / F.col("p")).cast("int"))), F.lit(1), F.col("rest"))
    whole = F.concat(F.slice("words", F.lit(1), F.col("a")), again)
    return placed.select("doc_id", F.when(F.col("n") > 0, F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    report = run_report(with_repeats(table(spark, folder, "documents")))
    return report.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
