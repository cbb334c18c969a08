"""Suffix-array dedup: bytes covered by a string of SPAN bytes that starts anywhere else are removed.

A suffix array of every byte of a corpus would be many times the corpus, so the array is sparse: it holds the
suffixes that begin at anchors. Anchors are picked by what the text says there (the smallest hash of GRAM bytes
within SPAN bytes, the first of equal ones), so two equal strings of SPAN bytes have an anchor at the same
place, and nothing that repeats can miss the array. The array is dealt by the GRAM bytes at the anchor, every
group is sorted by deep-shallow sorting, forwards from the anchor and backwards, and neighbours say how far two
places agree on either side.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import NO_ID, partitions, small_batches, table, whole_text, written
from riskloom.llm.deep_shallow import common_prefix, deep_shallow_sort
from riskloom.llm.textbytes import RangeHash, mix64, pieces

SPAN, GRAM = 200, 32
#: starts of GRAM bytes within SPAN bytes, and bytes before an anchor that a string with it can reach
STARTS = SPAN - GRAM + 1
BACK = SPAN - GRAM
#: different surroundings of an anchor that one task sorts; anchors with more are counted string by string
LARGE = 20_000


def _sliding_least(keys: np.ndarray) -> np.ndarray:
    """The least of every STARTS entries in a row."""
    width, least = 1, keys
    while 2 * width <= STARTS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = STARTS - width
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def anchors(raw: np.ndarray, starts: np.ndarray, grams: RangeHash, around: RangeHash) -> tuple[np.ndarray, ...]:
    """(row, first, last, times, gram, surroundings) of runs of anchors alike; a run is a text that goes round."""
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(raw) < SPAN:
        return none
    sums = grams.sums(raw)
    at = np.arange(len(raw) - GRAM + 1)
    gram = grams.ranges(sums, at, at + GRAM)
    least = _sliding_least((gram & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64))
    valid = np.zeros(len(raw), bool)
    for begin, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if end - begin >= SPAN:
            valid[begin:end - SPAN + 1] = True
    picked = (least[valid[:len(least)]] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(picked):
        return none
    anchor = picked[np.r_[True, picked[1:] != picked[:-1]]]
    row = np.searchsorted(starts, anchor, "right") - 1
    begin = np.maximum(starts[row], anchor - BACK)
    end = np.minimum(starts[row + 1], anchor + SPAN)
    context = mix64(around.ranges(around.sums(raw), begin, end) + (anchor - begin).astype(np.uint64))
    own = gram[anchor]
    fresh = np.r_[True, (row[1:] != row[:-1]) | (own[1:] != own[:-1]) | (context[1:] != context[:-1])]
    first = np.flatnonzero(fresh)
    last = np.r_[first[1:], len(anchor)] - 1
    place = anchor - starts[row]
    return row[first], place[first], place[last], last - first + 1, own[first].view(np.int64), context[first].view(np.int64)


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams, around = RangeHash(307), RangeHash(311)
    for batch in batches:
        for low, high, raw, starts in pieces(batch.column("text")):
            row, first, last, times, gram, context = anchors(raw, starts, grams, around)
            offsets = pa.array(np.searchsorted(row, np.arange(high - low + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in
                     (first.astype(np.int32), last.astype(np.int32), times.astype(np.int32), gram, context)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").slice(low, high - low), batch.column("md5").slice(low, high - low),
                 pa.array(np.diff(starts)), *lists], ["key", "md5", "n_bytes", "first", "last", "times", "gram", "context"])


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around the wanted anchors of a text, before (reversed) and from the anchor on."""
    for batch in batches:
        for number in range(batch.num_rows):
            data = batch.column("text")[number].as_buffer().to_pybytes()
            wanted = batch.column("wanted")[number].values
            place = wanted.field("place").to_pylist()
            back = [data[max(0, p - BACK):p][::-1] for p in place]
            onward = [data[p:p + SPAN] for p in place]
            row = pa.array(np.full(len(place), batch.column("row_no")[number].as_py(), np.int64))
            yield pa.RecordBatch.from_arrays(
                [wanted.field("gram"), wanted.field("kinds"), row, wanted.field("place"), wanted.field("open"),
                 pa.array(back, pa.binary()), pa.array(onward, pa.binary())],
                ["gram", "kinds", "row_no", "place", "open", "back", "onward"])


def shared_reach(back: list[bytes], onward: list[bytes]) -> list[set[tuple[int, int]]]:
    """For every place of an anchor the (bytes before, bytes from it on) in which another place agrees, if SPAN or more.

    Places are ordered by what follows the anchor. Going down the common prefixes of neighbours, two runs of
    places that agree in r bytes onward become one; a place of the smaller run agrees furthest backward
    with its neighbours in the backward order of the larger, so only these pairs are looked at.
    """
    found: list[set[tuple[int, int]]] = [set() for _ in back]

    def meet(x: int, y: int, onward_bytes: int) -> None:
        back_bytes = common_prefix(back[x], back[y])
        if back_bytes + onward_bytes >= SPAN:
            found[x].add((back_bytes, onward_bytes))
            found[y].add((back_bytes, onward_bytes))

    if len(back) == 2:
        meet(0, 1, common_prefix(onward[0], onward[1]))
        return found
    lead = onward[0][:GRAM]
    agreed = GRAM if all(o.startswith(lead) for o in onward) else 0
    order, prefixes = deep_shallow_sort(onward, agreed)
    backward, _ = deep_shallow_sort(back)
    rank = [0] * len(back)
    for place, number in enumerate(backward):
        rank[number] = place
    parent = list(range(len(order)))
    members: list[list[int]] = [[rank[number]] for number in order]

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in sorted(range(1, len(order)), key=lambda i: -prefixes[i]):
        if prefixes[i] < GRAM:
            break
        small, big = root(i - 1), root(i)
        if len(members[small]) > len(members[big]):
            small, big = big, small
        ranks = members[big]
        for r in members[small]:
            spot = bisect_left(ranks, r)
            if spot > 0:
                meet(backward[r], backward[ranks[spot - 1]], prefixes[i])
            if spot < len(ranks):
                meet(backward[r], backward[ranks[spot]], prefixes[i])
            ranks.insert(spot, r)
        members[small] = []
        parent[small] = big
    return found


def _sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by gram; every group is sorted and gives the spans of its open places."""
    gram, group = None, {}

    def spans() -> list[tuple[int, int, int]]:
        if len(group) < 2:
            return []
        places = list(group)
        reach = shared_reach([group[p][1] for p in places], [group[p][2] for p in places])
        return [(row, place - before, place + after) for (row, place), own in zip(places, reach) if group[row, place][0]
                for before, after in own]

    out: list[tuple[int, int, int]] = []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("gram", "row_no", "place", "open", "back", "onward")]
        for own, row, place, is_open, back, onward in zip(*columns):
            if own != gram:
                out += spans()
                gram, group = own, {}
            group[row, place] = (is_open, back, onward)
        if len(out) > 10_000:
            yield _span_rows(out)
            out = []
    out += spans()
    if out:
        yield _span_rows(out)


def _span_rows(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    row, begin, end = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(begin, pa.int64()), pa.array(end, pa.int64())],
                                      ["row_no", "begin", "end"])


def _all_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of SPAN bytes with the anchor, as a digest."""
    for batch in batches:
        rows = []
        columns = [batch.column(c).to_pylist() for c in ("row_no", "place", "open", "back", "onward")]
        for row, place, is_open, back, onward in zip(*columns):
            text = back[::-1] + onward
            for begin in range(len(text) - SPAN + 1):
                digest = hashlib.blake2b(text[begin:begin + SPAN], digest_size=16).digest()
                rows.append((row, place - len(back) + begin, is_open, int.from_bytes(digest[:8], "big", signed=True),
                             int.from_bytes(digest[8:], "big", signed=True)))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             ["row_no", "begin", "open", "d1", "d2"])


def _large_groups(contexts: DataFrame) -> DataFrame:
    strings = written(contexts.select("row_no", "place", "open", "back", "onward").mapInArrow(
        _all_strings, "row_no long, begin long, open boolean, d1 long, d2 long").distinct(), "anchored-strings")
    again = strings.groupBy(F.col("d1").alias("r1"), F.col("d2").alias("r2")).agg(F.count("*").alias("n")).where("n > 1")
    return strings.where("open").join(again, (F.col("d1") == F.col("r1")) & (F.col("d2") == F.col("r2"))).select(
        "row_no", "begin", (F.col("begin") + SPAN).alias("end"))


def repeated_spans(hashed: DataFrame, large: int = LARGE) -> DataFrame:
    """(md5, copied, spans): what of each different text is repeated. ``hashed`` has key, md5, text.

    Equal texts are one text that is ``copied`` as a whole; the rest is done with one row of each. Anchors
    whose GRAM bytes come once are thrown out by a count that is summed before its shuffle. Places with equal
    surroundings (SPAN bytes on, BACK bytes back) are repeated as far as these go, and one of them stands for all
    in its group; only places whose surroundings are unlike are fetched from the texts and sorted.
    """
    spark = hashed.sparkSession
    rows = written(hashed.mapInArrow(
        _find_anchors, "key long, md5 string, n_bytes long, first array<int>, last array<int>, times array<int>, "
                       "gram array<long>, context array<long>").withColumn("row_no", F.monotonically_increasing_id()), "anchors")
    texts = written(rows.groupBy("md5").agg(F.count("*").alias("copies"), F.min("row_no").alias("row_no")), "texts")
    chosen = texts.select(F.col("row_no").alias("chosen"))
    one = rows.join(chosen, F.col("row_no") == F.col("chosen"), "left_semi")
    every = one.select("row_no", F.explode(F.arrays_zip("first", "last", "times", "gram", "context")).alias("a")).select(
        "row_no", "a.first", "a.last", "a.times", "a.gram", "a.context")
    frequent = every.groupBy(F.col("gram").alias("g")).agg(F.sum("times").alias("n")).where("n > 1").select("g")
    repeated = written(every.join(frequent, F.col("gram") == F.col("g"), "left_semi"), "repeated-anchors")
    # one place stands for all with its surroundings; first() takes both columns from one row
    kinds = written(repeated.groupBy("gram", "context").agg(
        F.sum("times").alias("n"), F.first("row_no").alias("row_no"), F.first("first").alias("place")), "surroundings")
    alike = kinds.where("n > 1").select(F.col("gram").alias("g"), F.col("context").alias("c"))
    whole = repeated.join(alike, (F.col("gram") == F.col("g")) & (F.col("context") == F.col("c")), "left_semi").select(
        "row_no", F.greatest(F.lit(0), F.col("first") - BACK).cast("long").alias("begin"),
        (F.col("last") + SPAN).cast("long").alias("end"))
    unlike = kinds.groupBy(F.col("gram").alias("g")).agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted = kinds.join(unlike, F.col("gram") == F.col("g")).groupBy(F.col("row_no").alias("wanted_row")).agg(
        F.collect_list(F.struct("gram", "kinds", "place", (F.col("n") == 1).alias("open"))).alias("wanted"))
    fetch = wanted.join(rows.select("row_no", F.col("key").alias("of_key"), F.col("md5").alias("of_md5")),
                        F.col("wanted_row") == F.col("row_no")).drop("wanted_row")
    contexts = written(
        hashed.join(fetch, (F.col("md5") == F.col("of_md5")) & (F.col("key") == F.col("of_key"))).select("text", "row_no", "wanted")
        .mapInArrow(_cut_contexts, "gram long, kinds long, row_no long, place int, open boolean, back binary, onward binary"),
        "contexts")
    groups = contexts.where(F.col("kinds") <= large).repartition(partitions(spark), "gram").sortWithinPartitions("gram")
    spans = whole.union(groups.mapInArrow(_sort_groups, "row_no long, begin long, end long")).union(
        _large_groups(contexts.where(F.col("kinds") > large)))
    by_row = spans.distinct().groupBy(F.col("row_no").alias("of_row")).agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    return texts.join(by_row, F.col("row_no") == F.col("of_row"), "left").where("copies > 1 or spans is not null").select(
        F.col("md5").alias("of_md5"), (F.col("copies") > 1).alias("copied"), "spans")


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 512):
            part = batch.slice(low, 512)
            out = []
            for number, (copied, spans) in enumerate(zip(part.column("copied").to_pylist(), part.column("spans").to_pylist())):
                data = part.column("text")[number].as_buffer().to_pybytes()
                runs = [[0, len(data)]] if copied and len(data) >= SPAN else []
                if not runs and spans:
                    for begin, end in sorted((s["begin"], min(s["end"], len(data))) for s in spans):
                        if runs and begin <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], end)
                        else:
                            runs.append([begin, end])
                kept = hashlib.sha256()
                at = 0
                for begin, end in runs:
                    kept.update(data[at:begin])
                    at = end
                kept.update(data[at:])
                out.append((len(data), sum(e - b for b, e in runs), len(runs), kept.hexdigest(),
                            ",".join(f"{b}:{e}" for b, e in runs)))
            n_bytes, removed, count, digest, text = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), *[pa.array(v, pa.int64()) for v in (n_bytes, removed, count)], pa.array(digest), pa.array(text)],
                ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", large: int = LARGE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (begin:end in bytes).

    Every byte that lies in a string of 200 bytes which also starts anywhere else, in this or another text, is
    removed; strings are judged on the input and don't cross texts. Null texts are empty; texts under 200 bytes lose
    nothing; repeated rows are copies of each other; a null id stays null. Empty tables give no rows; other
    columns are not read. An anchor with more than ``large`` different surroundings is settled by counting the
    digests of its strings, summed before the shuffle, as no one task should sort it.
    """
    small_batches(docs.sparkSession)
    hashed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"), whole_text(text_col).alias("text")
                         ).withColumn("md5", F.md5(F.encode("text", "UTF-8")))
    cover = written(repeated_spans(hashed, large), "repeated-spans")
    out = hashed.join(cover, F.col("md5") == F.col("of_md5"), "left").select("key", "text", "copied", "spans").mapInArrow(
        _remove, "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans string")
    return out.select(F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256",
                      "spans")


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup(table(spark, folder, "documents"))
