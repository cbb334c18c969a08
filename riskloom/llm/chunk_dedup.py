"""Substring dedup by content-defined chunking: a gear hash cuts texts, chunks are deduplicated by digest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import NO_ID, small_batches, table, whole_text, written
from riskloom.llm.textbytes import RangeHash, pieces, random_words

#: bytes of a chunk: least and most; a cut falls on one of 2**CUT_BITS bytes beyond the least
LEAST, MOST, CUT_BITS = 16, 256, 4
#: bytes that the rolling hash sees; no more than the least chunk, so that it never sees another text
WINDOW = 16
#: a run of repeated chunks counts from this many bytes on, one that is the whole text always
RUN_BYTES = 80


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """The gear hash after every byte: h = (h << 1) + G[byte], of which a byte's trace is gone after WINDOW steps."""
    h = (random_words(211, 256) >> np.uint64(32)).astype(np.uint32)[raw]
    span = 1
    while span < WINDOW:
        h[span:] = h[span:] + (h[:-span] << np.uint32(span))
        span *= 2
    return h


def cut(candidates: list[int], begin: int, end: int) -> list[int]:
    """Chunk ends of the text at [begin, end): the first candidate at least LEAST bytes on, at most MOST bytes on."""
    ends, last = [], begin
    for at in candidates:
        while at - last > MOST:
            last += MOST
            ends.append(last)
        if at - last >= LEAST:
            ends.append(at)
            last = at
    while end - last > MOST:
        last += MOST
        ends.append(last)
    if end > last:
        ends.append(end)
    return ends


def _chunker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    high_hash, low_hash = RangeHash(223), RangeHash(227)
    for batch in batches:
        for low, high, raw, starts in pieces(batch.column("text")):
            gear = gear_hashes(raw)
            found = np.flatnonzero(gear >> np.uint32(32 - CUT_BITS) == 0) + 1
            where = np.searchsorted(found, starts, "right")  # a candidate at a text's last byte is its end
            ends, count = [], []
            positions = found.tolist()
            for i in range(high - low):
                own = cut(positions[where[i]:where[i + 1]], int(starts[i]), int(starts[i + 1]))
                ends += own
                count.append(len(own))
            end = np.array(ends, np.int64)
            offsets = np.concatenate([[0], np.cumsum(count)])
            row = np.repeat(np.arange(high - low), count)
            begin = np.zeros(len(end), np.int64)
            begin[1:] = end[:-1]
            nonempty = np.array(count, np.int64) > 0
            begin[offsets[:-1][nonempty]] = starts[:-1][nonempty]
            d1 = high_hash.ranges(high_hash.sums(raw), begin, end).view(np.int64)
            d2 = low_hash.ranges(low_hash.sums(raw), begin, end).view(np.int64)
            # whether a chunk is the first of its digest in its text
            order = np.lexsort((begin, d2, d1, row))
            same = np.zeros(len(end), bool)
            if len(end) > 1:
                a, b, c = row[order], d1[order], d2[order]
                same[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & (c[1:] == c[:-1])
            fresh = np.ones(len(end), bool)
            fresh[order[same]] = False
            index = pa.array(offsets, pa.int32())
            sizes = (end - begin).astype(np.int16)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").slice(low, high - low), pa.array(np.diff(starts)),
                 *[pa.ListArray.from_arrays(index, pa.array(v)) for v in (sizes, d1, d2, fresh)]],
                ["key", "n_bytes", "sizes", "d1", "d2", "fresh"])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From chunk sizes and repeated chunks to runs of bytes."""
    for batch in batches:
        rows = []
        for key, n_bytes, sizes, shared, stays, again in zip(*[batch.column(c).to_pylist() for c in
                                                              ("key", "n_bytes", "sizes", "shared", "stays", "again")]):
            shared, stays, again = set(shared or ()), set(stays or ()), set(again)
            begin, runs = 0, []
            for number, size in enumerate(sizes):
                end = begin + size
                repeated = number in shared or number in again
                if repeated:
                    gone = number in again or number not in stays
                    if runs and runs[-1][1] == begin:
                        runs[-1][1] = end
                        runs[-1][2].append((begin, end, gone))
                    else:
                        runs.append([begin, end, [(begin, end, gone)]])
                begin = end
            runs = [r for r in runs if r[1] - r[0] >= min(RUN_BYTES, n_bytes)]
            if not runs:
                continue
            removed: list[list[int]] = []
            for _, _, chunks in runs:
                for begin, end, gone in chunks:
                    if gone and removed and removed[-1][1] == begin:
                        removed[-1][1] = end
                    elif gone:
                        removed.append([begin, end])
            rows.append((key, n_bytes, len(sizes), sum(r[1] - r[0] for r in runs), sum(e - b for b, e in removed), len(removed),
                         ",".join(f"{b}:{e}" for b, e in removed)))
        if rows:
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in columns[:-1]], pa.array(columns[-1], pa.string())],
                ["key", "n_bytes", "n_chunks", "n_shared", "n_removed", "n_spans", "spans"])


def chunk_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document with a repeated passage: doc_id, n_bytes, n_chunks, n_shared, n_removed, n_spans, spans.

    Texts (UTF-8) are cut where a rolling hash of the last 16 bytes says so, 32 bytes apart on average, so
    an insertion moves only the cuts next to it. Chunks with one 128-bit digest are the same. A chunk is repeated
    where another document holds it or its own one holds it further up. Runs of repeated chunks count from RUN_BYTES
    bytes on, and whole texts of any size (``n_shared`` bytes); of each chunk the first place in the document with the
    smallest id stays, all others are removed (``spans``, begin:end in bytes).

    A chunk that comes again within its text is settled there, so a text repeated a thousand times over
    sends each chunk once. Counts by digest are summed before the shuffle; the join that brings them back has a
    single row for each digest, and adaptive execution splits the other side of a frequent one.

    Null texts are empty and have no chunks; a null id sorts last; rows that repeat an id are one document, whose
    chunks stay in each of its rows, and are marked as repeated. Empty tables give no rows. Other columns are not
    read. ``remove_spans`` applies the spans to the texts.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"), whole_text(text_col).alias("text"))
    cut_up = rows.mapInArrow(_chunker, "key long, n_bytes long, sizes array<smallint>, d1 array<long>, d2 array<long>, "
                                       "fresh array<boolean>")
    chunked = written(cut_up.withColumn("row_no", F.monotonically_increasing_id()), "chunks")
    chunks = chunked.select("key", "row_no", F.posexplode(F.arrays_zip("d1", "d2", "fresh")).alias("number", "chunk")).where(
        "chunk.fresh").select("key", "row_no", "number", F.col("chunk.d1").alias("d1"), F.col("chunk.d2").alias("d2"))
    repeated = written(chunks.groupBy("d1", "d2").agg(F.count("*").alias("times"), F.min("key").alias("least")).where("times > 1")
                       .select(F.col("d1").alias("r1"), F.col("d2").alias("r2"), "least"), "repeated-chunks")
    # a place goes to the join without its document's id: what stays is told when the hits are back at their row
    hits = chunks.drop("key").join(repeated, (F.col("d1") == F.col("r1")) & (F.col("d2") == F.col("r2"))).groupBy(
        F.col("row_no").alias("hit_row")).agg(F.collect_list(F.struct("number", "least")).alias("hits"))
    again = F.filter(F.transform("fresh", lambda new, i: F.when(~new, i)), lambda i: i.isNotNull())
    whole = chunked.select("key", "row_no", "n_bytes", "sizes", again.alias("again")).join(
        hits, F.col("row_no") == F.col("hit_row"), "left").where("hit_row is not null or size(again) > 0")
    shared, stays = "transform(hits, h -> h.number) AS shared", "transform(filter(hits, h -> h.least = key), h -> h.number) AS stays"
    out = whole.selectExpr("key", "n_bytes", "sizes", shared, stays, "again").mapInArrow(
        _spans, "key long, n_bytes long, n_chunks long, n_shared long, n_removed long, n_spans long, spans string")
    return out.select(F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"), "n_bytes", "n_chunks", "n_shared", "n_removed",
                      "n_spans", "spans")


def remove_spans(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the spans of ``chunk_dedup`` cut out of the texts; a cut character goes as a whole."""

    @F.udf("string")
    def without(text: str | None, spans: str | None) -> str | None:
        if text is None or not spans:
            return text
        data, kept, last = text.encode(), [], 0
        for span in spans.split(","):
            begin, end = map(int, span.split(":"))
            kept.append(data[last:begin])
            last = end
        return b"".join([*kept, data[last:]]).decode(errors="ignore")

    spans = found.select(F.col("doc_id").alias("span_id"), F.col("n_bytes").alias("span_bytes"), F.col("spans").alias("cut_spans")).dropDuplicates(["span_id", "span_bytes"])
    size = F.octet_length(whole_text(text_col))
    return docs.join(spans, F.col(id_col).eqNullSafe(F.col("span_id")) & (size == F.col("span_bytes")), "left").withColumn(
        text_col, without(F.col(text_col), F.col("cut_spans"))).drop("span_id", "span_bytes", "cut_spans")


def op7_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_dedup(table(spark, folder, "documents"))
