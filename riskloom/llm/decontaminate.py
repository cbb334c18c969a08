"""Benchmark decontamination: a BM25 index of the test items with block-max bounds, asked with every passage."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import small_batches, table, whole_text, written

#: BM25 constants
K1, B = 1.2, 0.75
#: a passage is a hit when it scores this share of what the item scores against itself
THRESHOLD = 0.5
#: postings in a block, and characters of items in an index segment (a segment is sent to the executors)
BLOCK, SEGMENT_CHARS = 32, 8_000_000
#: words of the shingles of the verification, and the share of question and of answer that must be there
SHINGLE, OVERLAP = 5, 0.8
#: raw words that a task remembers
REMEMBERED = 400_000
#: texts that are worked on together: characters at least
TOGETHER = 1 << 19

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def plain(word: str) -> str:
    return _EDGES.sub("", word.lower())


def plain_words(text: str) -> list[str]:
    return [w for w in map(plain, text.split()) if w]


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The last sentence with words is the answer, all before it the question; a single sentence is both."""
    sentences = [s for s in (plain_words(x) for x in _SENTENCE.split(text)) if s]
    if not sentences:
        return [], []
    return [w for s in sentences[:-1] for w in s] or sentences[-1], sentences[-1]


def shingles(words: list) -> set[tuple]:
    n = min(SHINGLE, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


@dataclass
class Statistics:
    """What all items of a benchmark say together: how many have words, their mean and greatest number of words, and how
    many hold each word (of those words that a segment needs)."""

    items: int
    mean: float
    longest: int
    holders: dict[str, int]

    @staticmethod
    def of(items: list[tuple[int | None, str]]) -> "Statistics":
        words = [w for w in (plain_words(t) for _, t in items) if w]
        sizes = [len(w) for w in words]
        return Statistics(len(words), sum(sizes) / max(1, len(sizes)), max(sizes, default=0), Counter(w for ws in words for w in set(ws)))


class Index:
    """Postings by term in blocks of BLOCK items. An item's weights are divided by its score against itself.

    Items are numbered by length, so the items of a block have impacts of one size and its maximum is tight.
    """

    def __init__(self, items: list[tuple[int | None, str]], all_items: Statistics | None = None) -> None:
        all_items = all_items or Statistics.of(items)
        known = sorted(((plain_words(t), i, t) for i, t in items), key=lambda x: (len(x[0]), x[1] is None, x[1] or 0, x[2]))
        known = [(w, i, t) for w, i, t in known if w]
        self.ids = [i for _, i, _ in known]
        self.vocabulary = {w: n for n, w in enumerate(sorted({w for ws, _, _ in known for w in ws}))}
        self.longest = all_items.longest
        self.parts = [question_and_answer(t) for _, _, t in known]
        self.parts = [tuple([self.vocabulary[w] for w in part] for part in parts) for parts in self.parts]
        holders, rows = all_items.holders, []
        for number, (ws, _, _) in enumerate(known):
            norm = K1 * (1 - B + B * len(ws) / all_items.mean)
            weights = {t: np.log1p((all_items.items - holders[t] + 0.5) / (holders[t] + 0.5)) * n * (K1 + 1) / (n + norm)
                       for t, n in Counter(ws).items()}
            own = sum(weights.values())
            rows += [(self.vocabulary[t], number, w / own) for t, w in weights.items()]
        rows.sort()
        self.term = np.array([r[0] for r in rows], np.int64)
        self.item = np.array([r[1] for r in rows], np.int64)
        self.impact = np.array([r[2] for r in rows], float)
        terms = len(self.vocabulary)
        # blocks: runs of postings of one term whose items lie in one block of item numbers
        key = self.term * (len(known) // BLOCK + 1) + self.item // BLOCK
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        self.block_first = np.r_[first, len(key)].astype(np.int64)
        self.block_item = self.item[first] // BLOCK
        self.block_max = np.maximum.reduceat(self.impact, first) if len(first) else np.zeros(0)
        self.term_blocks = np.searchsorted(self.term[first], np.arange(terms + 1))
        self.term_max = np.zeros(terms)
        np.maximum.at(self.term_max, self.term, self.impact)


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All of range(first[i], last[i]) one after the other, and the i of each."""
    count = last - first
    of = np.repeat(np.arange(len(first)), count)
    return np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + first[of], of


def retrieve(index: Index, passage: np.ndarray, term: np.ndarray, passages: int, threshold: float
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, item, score) of all pairs with at least ``threshold``; ``passage`` and ``term`` are distinct pairs.

    Bounds first, as in WAND: a passage's terms in order of their largest impacts have a pivot, the first at which
    these add up to the threshold; an item of none of the terms from there on can't reach it, so only blocks of
    items that such a term has are opened, and none of a passage without a pivot. Then the maxima of the blocks, added up by
    (passage, block of items), must reach the threshold; only postings of the blocks that remain are read. Nothing that could
    reach the threshold is left out.
    """
    slack = threshold - 1e-9
    bound = np.bincount(passage, index.term_max[term], passages)
    alive = bound[passage] >= slack
    passage, term = passage[alive], term[alive]
    if not len(passage):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
    order = np.lexsort((index.term_max[term], passage))
    passage, term = passage[order], term[order]
    sums = np.cumsum(index.term_max[term])
    first = np.searchsorted(passage, passage)
    from_pivot = sums - (sums - index.term_max[term])[first] >= slack - 1e-6    # sums over all passages round
    width = len(index.ids) // BLOCK + 1
    block, of = _spread(index.term_blocks[term[from_pivot]], index.term_blocks[term[from_pivot] + 1])
    opened = np.unique(passage[from_pivot][of] * width + index.block_item[block])
    block, of = _spread(index.term_blocks[term], index.term_blocks[term + 1])
    of_passage = passage[of]
    group = of_passage * width + index.block_item[block]
    place = np.minimum(np.searchsorted(opened, group), len(opened) - 1)
    alive = opened[place] == group
    block, of_passage, place = block[alive], of_passage[alive], place[alive]
    alive = np.bincount(place, index.block_max[block], len(opened))[place] >= slack
    block, of_passage = block[alive], of_passage[alive]
    posting, of = _spread(index.block_first[block], index.block_first[block + 1])
    pair, place = np.unique(of_passage[of] * len(index.ids) + index.item[posting], return_inverse=True)
    score = np.bincount(place, index.impact[posting], len(pair))
    hit = score >= slack
    return pair[hit] // len(index.ids), pair[hit] % len(index.ids), score[hit]


class _Terms(dict):
    """Term number of a raw word, -1 if no item has it, -2 if it has no letters or digits; forgets when full."""

    def __init__(self, vocabulary: dict[str, int]) -> None:
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> int:
        simple = plain(word)
        number = self.vocabulary.get(simple, -1) if simple else -2
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = number
        return number


def scan(index: Index, texts: list[str], terms: dict, threshold: float) -> list[tuple[int, int, float, float, float]]:
    """(text, item number, score, question overlap, answer overlap) of the verified items of each text.

    Passages are runs of as many words as the longest item has, beginning at every half of that, so a passage
    holds at least three quarters of an item that is there.
    """
    half = max(8, -(-index.longest // 2))
    numbers, cells, cell_text, gaps = [], [], [], []
    cell = 0
    for number, text in enumerate(texts):
        ids = np.fromiter(map(terms.__getitem__, text.split()), np.int64)
        ids = ids[ids > -2]
        numbers.append(ids)
        cells.append(cell + np.arange(len(ids)) // half)
        count = -(-len(ids) // half)
        cell_text.append(np.full(count + 1, number))
        gaps.append(cell + count)  # an empty cell keeps passages inside their text
        cell += count + 1
    if not cell:
        return []
    gap = np.zeros(cell, bool)
    gap[gaps] = True
    of_text = np.concatenate(cell_text)
    first_cell = np.searchsorted(of_text, np.arange(len(texts)))
    term, at = np.concatenate(numbers), np.concatenate(cells)
    term, at = term[term >= 0], at[term >= 0]
    # passage c covers the cells c and c + 1; a term counts once
    size = len(index.vocabulary)
    alone = np.unique(at * size + term)
    both = np.concatenate([alone, alone - size])  # as part of passage c and of passage c - 1
    both = both[both >= 0]
    both = both[~gap[both // size]]
    sums = np.bincount(alone // size, index.term_max[alone % size], cell + 1)
    near = (sums[:-1] + sums[1:])[both // size] >= threshold - 1e-9  # cheap bound before terms are made distinct
    pairs = np.unique(both[near])
    passage, items, score = retrieve(index, pairs // size, pairs % size, cell, threshold)
    best: dict[tuple[int, int], float] = defaultdict(float)
    where: dict[tuple[int, int], list[int]] = defaultdict(list)
    for p, item, s in zip(passage.tolist(), items.tolist(), score.tolist()):
        key = (int(of_text[p]), item)
        best[key] = max(best[key], s)
        where[key].append(p - int(first_cell[of_text[p]]))
    out = []
    for (number, item), s in best.items():
        found, ids = [0.0, 0.0], numbers[number]
        parts = [shingles(part) for part in index.parts[item]]
        reach = sum(map(len, index.parts[item]))
        for c in where[number, item]:
            words = ids[max(0, c * half - reach):(c + 2) * half + reach].tolist()
            # question and answer stand in one place
            share = []
            for part, grams in zip(index.parts[item], parts):
                n = min(SHINGLE, len(part))
                have = {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}
                share.append(len(grams & have) / len(grams))
            if min(share) > min(found) or sum(found) == 0:
                found = share
        if min(found) >= OVERLAP:
            out.append((number, item, s, *found))
    return out


def _together(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts with about TOGETHER characters, each with the number of its first text."""
    low = 0
    while low < len(texts):
        high, chars = low, 0
        while high < len(texts) and chars < TOGETHER:
            chars += len(texts[high])
            high += 1
        yield low, texts[low:high]
        low = high


def _scanner(index: Index, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _Terms(index.vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            for low, texts in _together(batch.column("text").to_pylist()):
                rows += [(low + n, *rest) for n, *rest in scan(index, texts, terms, threshold)]
            if rows:
                at, item, score, question, answer = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(at)), pa.array([index.ids[i] for i in item], pa.int64()), pa.array(score, pa.float64()),
                     pa.array(question, pa.float64()), pa.array(answer, pa.float64())],
                    ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    return run


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """One row per document and test item that it holds: doc_id, item_id, score, question_overlap, answer_overlap.

    Words are compared in lower case without marks at their ends. Every passage of every text is a BM25 query
    against the items; hits above ``threshold`` of the item's own score are verified: 80 % of the five-word
    shingles of the question and of the answer (an item's last sentence) must stand in the passage's
    surroundings. Items are indexed in segments of about ``segment_chars`` characters by id hash; a segment is
    built on the driver and sent to the executors, and a benchmark of many segments is asked segment after
    segment, so no object grows with either table. Document frequencies, mean length and the width of passages are those of
    the whole benchmark, so the answer doesn't hang on the segments.

    Null texts, empty texts and items without words match nothing. Null ids of documents and of items are carried
    through; documents that repeat are reported each. Empty tables give no rows. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return reduce(DataFrame.unionByName, [
        rows.mapInArrow(_scanner(index, threshold), "doc_id long, item_id long, score double, question_overlap double, "
                        "answer_overlap double") for index in indexes(items, item_col, item_text_col, segment_chars)])


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [plain_words(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("segment"), pa.array([len(w) for w in words], pa.int64()), pa.array([sorted(set(w)) for w in words], pa.list_(pa.string()))],
            ["segment", "size", "words"])


def indexes(items: DataFrame, item_col: str, item_text_col: str, segment_chars: int = SEGMENT_CHARS) -> Iterator[Index]:
    """The index segments of a benchmark, one after the other."""
    named = items.select(F.col(item_col).cast("long").alias("item_id"), whole_text(item_text_col).alias("text")).distinct()
    chars = named.agg(F.sum(F.char_length("text"))).first()[0] or 0
    segments = max(1, -(-chars // segment_chars))
    if segments == 1:
        yield Index([(r.item_id, r.text) for r in named.collect()])
        return
    number = F.pmod(F.xxhash64(F.coalesce(F.col("item_id"), F.lit(0)), "text"), F.lit(segments)).cast("int")
    named = written(named.withColumn("segment", number), "benchmark")
    words = written(named.mapInArrow(_item_words, "segment int, size long, words array<string>").where("size > 0"), "benchmark-words")
    total = words.agg(F.count("*"), F.avg("size"), F.max("size")).first()
    held = words.select("segment", F.explode("words").alias("word"))
    holders = written(held.groupBy("word").agg(F.count("*").alias("n")), "benchmark-holders")
    for segment in range(segments):
        own = [(r.item_id, r.text) for r in named.where(F.col("segment") == segment).collect()]
        asked = held.where(F.col("segment") == segment).select("word").distinct()
        yield Index(own, Statistics(total[0], total[1] or 0.0, total[2] or 0, {r.word: r.n for r in holders.join(asked, "word").collect()}))


def uncontaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns; row by row, nothing is moved."""
    small_batches(docs.sparkSession)

    def holds(index: Index) -> Column:
        @F.pandas_udf("boolean")
        def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            terms = _Terms(index.vocabulary)
            for batch in batches:
                hit = np.zeros(len(batch), bool)
                for low, texts in _together(batch.to_list()):
                    hit[[low + n for n, *_ in scan(index, texts, terms, threshold)]] = True
                yield pd.Series(hit)

        return found(whole_text(text_col))

    for index in indexes(items, item_col, item_text_col):
        docs = docs.where(~holds(index))
    return docs


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
