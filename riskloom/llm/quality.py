"""Quality classifier: random Fourier features, ridge by summed normal equations, isotonic calibration."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import small_batches, table, whole_text
from riskloom.llm.textbytes import BLANK, pieces, words

#: a document is predicted good from this score on
ACCEPT = 0.7
#: cosine features, ridge penalty for each training row, folds of the calibration, kernel width per statistic
FEATURES, PENALTY, FOLDS, WIDTH = 256, 1e-3, 5, 1.0
#: labelled rows that a fit reads at most (those with the smallest id hashes), and tasks that sum them: each gives
#: FOLDS * FEATURES**2 numbers, so there are few however many partitions the cluster has
FIT_ROWS, FIT_TASKS = 20_000, 8

STATISTICS = [
    "log_bytes", "word_length", "word_length_spread", "upper", "digit", "blank", "newline", "high_byte", "letter_mark",
    "pipe", "bang", "symbol", "bracket", "quote", "sentence_mark", "other_control", "mark_runs", "repeated_next",
    "distinct_words", "distinct_pairs", "distinct_lines", "top_word", "packed",
]


def _classes() -> np.ndarray:
    """Byte classes of the counted shares, in the order of STATISTICS[3:16]."""
    sets = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", bytes(range(128, 256)), b"-_'", b"|", b"!",
            b"#$%&*~^+=@\\/", b"<>()[]{}", b"\"`", b".,;:?", bytes([*range(9), 11, 12, *range(14, 32), 127])]
    lut = np.full(256, len(sets), np.int64)
    for number, members in enumerate(sets):
        lut[list(members)] = number
    return lut


_CLASS = _classes()
_COUNTED = 13


def statistics(column: pa.Array) -> np.ndarray:
    """A row of STATISTICS for every text of a column without nulls."""
    out = np.zeros((len(column), len(STATISTICS)))
    for low, high, raw, starts in pieces(column):
        rows = high - low
        size = np.diff(starts)
        of_row = np.repeat(np.arange(rows), size)
        shares = np.bincount(of_row * (_COUNTED + 1) + _CLASS[raw], minlength=rows * (_COUNTED + 1)).reshape(rows, -1)
        per_byte = 1.0 / np.maximum(size, 1)[:, None]
        begin, end, row = words(raw, starts)
        count = np.bincount(row, minlength=rows)
        length = (end - begin).astype(float)
        mean = np.bincount(row, length, rows) / np.maximum(count, 1)
        square = np.bincount(row, length**2, rows) / np.maximum(count, 1)
        # marks that stand next to the same mark
        mark = (raw < 128) & ~BLANK[raw] & ~((raw >= 48) & (raw < 58)) & ~((raw | 32) >= 97) | (raw == 124)
        run = np.zeros(len(raw))
        if len(raw) > 1:
            run[1:] = mark[1:] & (raw[1:] == raw[:-1])
        part = out[low:high]
        part[:, 0] = np.log1p(size)
        part[:, 1] = mean
        part[:, 2] = np.sqrt(np.maximum(square - mean**2, 0))
        part[:, 3:3 + _COUNTED] = np.sqrt(shares[:, :_COUNTED] * per_byte)
        part[:, 16] = np.sqrt(np.bincount(of_row, run, rows) * per_byte[:, 0])
        for i, text in enumerate(column.slice(low, rows).to_pylist()):
            part[i, 17:] = _repetition(text)
    return out


def _repetition(text: str) -> tuple[float, ...]:
    tokens = text.split()
    if not tokens:
        return 0.0, 1.0, 1.0, 1.0, 0.0, 1.0
    n, lines, data, counts = len(tokens), text.split("\n"), text.encode(), Counter(tokens)
    following = sum(map(str.__eq__, tokens, tokens[1:])) / n
    pairs = len(set(zip(tokens, tokens[1:]))) if n > 1 else 1
    # distinct words on a log scale, as their share falls with length in any text
    return (following, np.log(len(counts)) / np.log(n) if n > 1 else 1.0, pairs / max(n - 1, 1),
            len(set(lines)) / len(lines), max(counts.values()) / n, len(zlib.compress(data, 1)) / (len(data) + 12))


class Model:
    """What a fit leaves; plain arrays, sent with the tasks that score."""

    def __init__(self, mean, scale, weights, knots, values, rate):
        self.mean, self.scale, self.weights, self.knots, self.values, self.rate = mean, scale, weights, knots, values, rate

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier(stats, self.mean, self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), self.rate)
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0.0, 1.0)


def fourier(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Bias and FEATURES cosines whose inner products approximate a Gaussian kernel of the standardised statistics."""
    drawn = np.random.default_rng(17)
    d = stats.shape[1]
    direction = drawn.standard_normal((d, FEATURES)) / (WIDTH * np.sqrt(d))
    phase = drawn.uniform(0, 2 * np.pi, FEATURES)
    x = np.clip((stats - mean) / scale, -8, 8)
    z = np.sqrt(2.0 / FEATURES) * np.cos(x @ direction + phase)
    return np.concatenate([np.ones((len(x), 1)), z], axis=1)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the non-decreasing fit, as the ends of its level stretches."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    blocks: list[list[float]] = []  # sum, count, first x, last x
    for xi, yi in zip(x, y):
        blocks.append([yi, 1.0, xi, xi])
        while len(blocks) > 1 and (blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1] or blocks[-2][3] == blocks[-1][2]):
            total, count, _, last = blocks.pop()
            blocks[-1][0] += total
            blocks[-1][1] += count
            blocks[-1][3] = last
    knots = np.array([v for b in blocks for v in (b[2], b[3])])
    # half a row of either label keeps levels off 0 and 1, so that order is kept inside the outer blocks as well
    values = np.array([v for b in blocks for v in ((b[0] + 0.5) / (b[1] + 1.0),) * 2])
    return knots, np.maximum.accumulate(values)


def _training(docs: DataFrame, labels: DataFrame, fit_rows: int, id_col: str, text_col: str) -> DataFrame:
    """Statistics, label and fold of the labelled rows that may be learnt from, at most ``fit_rows`` of them."""
    ident = F.col("doc_id").cast("string")
    known = labels.where("doc_id is not null and quality in (0, 1)").where(F.crc32(F.encode(ident, "UTF-8")) % 4 != 2)
    drawn = known.select(F.col("doc_id").alias("labelled_id"), F.col("quality").cast("int").alias("label")).orderBy(
        F.xxhash64("labelled_id"), "labelled_id", "label").limit(fit_rows)
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text")).join(
        F.broadcast(drawn), F.col("doc_id") == F.col("labelled_id"))
    fold = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(FOLDS)).cast("int")
    return rows.select("doc_id", "text", "label", fold.alias("fold")).mapInArrow(
        _with_statistics, "doc_id long, label int, fold int, stats array<double>")


def _with_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        stats = statistics(batch.column("text"))
        lists = pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel()), stats.shape[1]).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), batch.column("fold"), lists],
                                         ["doc_id", "label", "fold", "stats"])


def _equations(mean: np.ndarray, scale: np.ndarray):
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
        for batch in batches:
            if len(batch):
                z = fourier(np.stack(batch.stats.to_list()), mean, scale)
                right = np.concatenate([z, batch.label.to_numpy(float)[:, None]], axis=1)
                for fold in range(FOLDS):
                    own = (batch.fold == fold).to_numpy()
                    total[fold] += z[own].T @ right[own]
        yield pd.DataFrame({"fold": np.repeat(np.arange(FOLDS), FEATURES + 1), "line": np.tile(np.arange(FEATURES + 1), FOLDS),
                            "sums": list(total.reshape(-1, FEATURES + 2))})

    return sums


def _add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"fold": [key[0]], "line": [key[1]], "sums": [np.sum(np.stack(group.sums.to_list()), axis=0)]})


def _ridge(equations: np.ndarray, rows: float) -> np.ndarray:
    left = equations[:, :-1] + PENALTY * max(rows, 1.0) * np.diag(np.r_[1e-6, np.full(FEATURES, 1.0 / FEATURES)])
    return np.linalg.solve(left, equations[:, -1])


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from the labelled rows outside the held-out quarter (crc32 of the id as text, mod 4, is 2).

    Each task sums the normal equations of its rows by fold; the sums are added up by line, 257 numbers each.
    A fold is scored by the sums of the other folds, and these scores, which no row had a part in, are
    calibrated by isotonic regression; the weights that are kept come from all folds. What reaches the driver
    is bounded by ``fit_rows`` and FEATURES. Without labels the score is 1, with a single label it is that one.
    """
    small_batches(docs.sparkSession)
    rows = _training(docs, labels, fit_rows, id_col, text_col).repartition(FIT_TASKS)
    train = rows.persist()  # at most fit_rows rows of numbers
    try:
        k = len(STATISTICS)
        aggregates = [f(F.get("stats", F.lit(i))) for i in range(k) for f in (F.avg, F.stddev_pop)]
        moments = train.agg(F.count("*"), F.avg("label"), *aggregates).first()
        if not moments[0] or moments[1] in (0.0, 1.0):
            return Model(None, None, None, None, None, 1.0 if not moments[0] else float(moments[1]))
        mean = np.array(moments[2::2], float)
        scale = np.maximum(np.array(moments[3::2], float), 1e-3)
        schema = "fold int, line int, sums array<double>"
        lines = train.mapInPandas(_equations(mean, scale), schema).groupBy("fold", "line").applyInPandas(_add, schema).collect()
        equations = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
        for fold, line, sums in lines:
            equations[fold, line] = sums
        counts = equations[:, 0, 0]
        every = equations.sum(axis=0)
        apart = np.stack([_ridge(every - equations[f], counts.sum() - counts[f]) for f in range(FOLDS)])

        def left_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    z = fourier(np.stack(batch.stats.to_list()), mean, scale)
                    yield pd.DataFrame({"raw": np.einsum("ij,ij->i", z, apart[batch.fold.to_numpy()]), "label": batch.label})

        scored = train.mapInPandas(left_out, "raw double, label int").toPandas()
        order = scored.sort_values(["raw", "label"])
        knots, values = isotonic(order.raw.to_numpy(), order.label.to_numpy(float))
        return Model(mean, scale, _ridge(every, counts.sum()), knots, values, float(moments[1]))
    finally:
        train.unpersist()


def score_of(model: Model, text: Column) -> Column:
    """The score of a text column; row by row, nothing is moved."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(statistics(pc.fill_null(pa.array(texts, pa.string()), ""))))

    return score(text)


def classify(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= 0.7).

    Scores depend on the text alone. Null texts count as empty and are scored like any text; rows with a null
    id are scored (held_out is null); a document with several labels trains with each of them; label rows
    without a label, with another value than 0 or 1, or without a document are not used. An empty table gives
    no rows; other columns are not read.
    """
    model = fit(docs, labels, fit_rows, id_col, text_col)
    scored = docs.select(F.col(id_col).alias("doc_id"), score_of(model, whole_text(text_col)).alias("score"))
    held = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is predicted good, with all their columns."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    return docs.where(score_of(model, whole_text(text_col)) >= ACCEPT)


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
