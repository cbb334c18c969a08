"""Token ids as ORC: run-length encoded integers, row indexes and Bloom filters on the document id."""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import partitions, release, small_batches, table, whole_text
from riskloom.session import staged_path

#: ends a document
END_ID = 0
#: words whose ids a Python worker remembers, and the longest such word
REMEMBERED, REMEMBERED_CHARS = 1_000_000, 32
ORC_OPTIONS = {
    "orc.create.index": "true", "orc.row.index.stride": "1000", "orc.stripe.size": str(16 << 20),
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "compression": "zstd",
}
FILE_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"

#: in texts with white space next to white space, pre-tokens may end elsewhere than at words, so these go whole
_ODD = re.compile(r"\s\s|<\||\0")
# fixed value: the pre-tokens of the byte-level tokenizer
_PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: beyond these characters (and among control characters) classes may differ between libraries
_COMMON = regex.compile("[\t\n\r\x20-\x7e\xa1-\u024f]*")


@functools.cache
def byte_letters() -> str:
    """The letter by which a byte-level vocabulary writes each byte: printable bytes as themselves, others from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in printable else next(others)) for b in range(256))


class _Units(dict):
    """Ids (as bytes) of the units of a text: a word, mostly with the blank before it, or a line feed.

    What comes first is remembered, and common words come early.
    """

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.merge = tokenizer.model.tokenize

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<i4").tobytes()

    def word(self, pre_token: str) -> bytes:
        """Ids of a single pre-token: the vocabulary's merges, without looking for pre-tokens again."""
        if (ids := self.get(pre_token)) is None:
            letters = pre_token.encode().decode("latin-1").translate(byte_letters())
            ids = np.asarray([token.id for token in self.merge(letters)], "<i4").tobytes()
            if len(pre_token) <= REMEMBERED_CHARS and len(self) < REMEMBERED:
                self[pre_token] = ids
        return ids

    def __missing__(self, unit: str) -> bytes:
        core = unit[1:] if unit[:1] == " " else unit
        plain = unit.isascii() or _COMMON.fullmatch(unit)
        if plain and core.isalpha():
            return self.word(unit)
        if plain and core[-1:] in ".,:;!?" and core[:-1].isalpha():
            ids = self.word(unit[:-1]) + self.word(core[-1])
        elif _COMMON.fullmatch(unit):
            ids = b"".join([self.word(p) for p in _PRE_TOKEN.findall(unit)])
        else:
            return self.whole(unit)
        if len(unit) <= REMEMBERED_CHARS and len(self) < REMEMBERED:
            self[unit] = ids
        return ids


class Encoder:
    """Encodes whole texts with a byte-level tokenizer, a word that comes again only once."""

    def __init__(self, tokenizer) -> None:
        self.units = _Units(tokenizer)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers.

        Where no two white-space characters meet, the pre-tokenizer begins a new pre-token at every blank, and a
        line feed is one of its own. So the ids of a text are those of its units "word", " word", "\\n", ... one
        after the other, and those of a unit are those of its pre-tokens.
        """
        if _ODD.search(text):
            return self.units.whole(text)
        units = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        return b"".join(map(self.units.__getitem__, units))


_encoders: dict[str, Encoder] = {}


def _worker_encoder(tokenizer_json: str) -> Encoder:
    """One for each Python worker; it lives on from task to task."""
    from tokenizers import Tokenizer

    if tokenizer_json not in _encoders:
        _encoders.clear()
        _encoders[tokenizer_json] = Encoder(Tokenizer.from_str(tokenizer_json))
    return _encoders[tokenizer_json]


def _encoder(tokenizer_json: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(tokenizer_json)
        part, start = TaskContext.get().partitionId(), 0
        end = np.asarray([END_ID], "<i4").tobytes()
        for batch in batches:
            texts = batch.column("text")
            for low in range(0, batch.num_rows, 256):
                rows = [encoder.encode(t) + end for t in texts.slice(low, 256).to_pylist()]
                sizes = np.asarray([len(r) // 4 for r in rows], np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                               pa.array(np.frombuffer(b"".join(rows), "<i4")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, 256), pa.array(np.full(len(rows), part, np.int32)),
                     pa.array(start + offsets[:-1]), pa.array(sizes), ids],
                    ["doc_id", "part", "part_start", "n_tokens", "ids"])
                start += int(offsets[-1])

    return encode


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        offsets = np.asarray(ids.offsets)
        values = np.ascontiguousarray(np.asarray(ids.values), "<i4")
        crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), batch.column("part_start"), batch.column("n_tokens"),
             pc.cast(pc.list_value_length(ids), pa.int64()), pa.array(crc, pa.int64())],
            ["doc_id", "part", "part_start", "n_tokens", "n_ids", "ids_crc32"])


def write_token_orc(docs: DataFrame, path: str, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
                    parts: int | None = None) -> DataFrame:
    """Encode every text, append id 0, write ORC files in ascending id order, and return the scan of them.

    Documents are range-partitioned by id and sorted (ties by text), a file for each range, so file and row
    order is id order and every ORC stripe covers a narrow span of ids: its statistics, row index and Bloom
    filter let a reader skip stripes by id, and stripes are read in parallel. Ids are plain integers in the
    file, which ORC run-length encodes. ``part`` and ``part_start`` (ids before the document in its file)
    turn into corpus positions with one small table of totals, see ``read_token_orc``.

    Null texts count as empty and give the single id 0; rows with a null id come first; repeated rows are all
    written. An empty table gives an empty file. Other columns are not read.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        tokenizer_json = file.read()  # a megabyte or two; sent with the task, as executors may lack the file
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    ordered = rows.repartitionByRange(parts or partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    encoded = ordered.mapInArrow(_encoder(tokenizer_json), FILE_SCHEMA)
    encoded.write.mode("overwrite").options(**ORC_OPTIONS).orc(path)
    release(spark)
    return spark.read.schema(FILE_SCHEMA).orc(path)


def read_token_orc(spark: SparkSession, path: str) -> DataFrame:
    """Per document of such a folder, from the files alone: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. Totals of files (one row each) are summed up by a
    window and broadcast.
    """
    small_batches(spark)
    spark.conf.set("spark.sql.orc.columnarReaderBatchSize", "512")
    files = spark.read.schema(FILE_SCHEMA).orc(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("part").alias("of_part"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    sums = files.mapInArrow(
        _checksums, "doc_id long, part int, part_start long, n_tokens long, n_ids long, ids_crc32 long")
    return sums.join(F.broadcast(offsets), F.col("part") == F.col("of_part")).select(
        "doc_id", (F.col("before") + F.col("part_start")).alias("start"), F.col("n_ids").alias("n_tokens"), "ids_crc32")


def token_orc(docs: DataFrame, tokenizer_file: str, path: str | None = None) -> DataFrame:
    """Write ``docs`` as token ids and return what the files hold; ``path`` defaults to a new shared folder."""
    path = path or staged_path(docs.sparkSession, "tokens-orc")
    write_token_orc(docs, path, tokenizer_file)
    return read_token_orc(docs.sparkSession, path)


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op3_token_orc(spark: SparkSession, folder: str) -> DataFrame:
    return token_orc(table(spark, folder, "documents"), default_tokenizer())
