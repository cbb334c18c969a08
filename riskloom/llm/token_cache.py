"""Token counts from a cache: stored counts by digest of content and tokenizer, only what is missing is encoded."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from importlib.metadata import version

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import small_batches, table, whole_text, written
from riskloom.llm.token_orc import byte_letters
from riskloom.session import exists, staged_path

#: documents with more tokens are over the limit
LIMIT = 2048
#: words whose counts a Python worker remembers, and the longest such word
REMEMBERED, REMEMBERED_CHARS = 1_000_000, 48
#: with so many missing digests at most (32 bytes each) these are broadcast, and only their texts are shuffled
BROADCAST_DIGESTS = 100_000
CACHE_SCHEMA = "digest binary, n_tokens long"

# fixed values: what a tokenizer file says when letter case and the kind of white space don't change its counts
_FOLDING_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_WORD_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
               "behavior": "Removed", "invert": True}
#: characters that normal form C leaves alone, and whose classes don't differ between libraries
_COMMON = regex.compile("[\x21-\x7e\xa1-\u024f]*")
_PIECE = regex.compile(_WORD_SPLIT["pattern"]["Regex"])


class TokenizerFile:
    """A tokenizer file's bytes, its library and the digest that names this version of both."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self.content = file.read()  # a megabyte or two; sent with the task, as executors may lack the file
        if path.endswith(".json"):
            self.library = "tokenizers"
        elif path.endswith(".model"):
            self.library = "sentencepiece"
        else:
            raise ValueError(f"{path}: neither .json nor .model")
        said = f"{self.library} {version(self.library)} no special tokens\n".encode()
        self.digest = hashlib.sha256(said + self.content).hexdigest()
        self.by_word = self.library == "tokenizers" and _counts_by_word(json.loads(self.content))


def _counts_by_word(tokenizer: dict) -> bool:
    """Whether a text has the tokens of its words, whatever white space is between them and whatever A-Z's case."""
    split = tokenizer.get("pre_tokenizer") or {}
    added = tokenizer.get("added_tokens", [])
    return (tokenizer.get("normalizer") == _FOLDING_NORMALIZER
            and split.get("type") == "Sequence" and split["pretokenizers"][0] == _WORD_SPLIT
            and all(p["type"] == "ByteLevel" and not p["add_prefix_space"] and not p["use_regex"] for p in split["pretokenizers"][1:])
            and not any(tokenizer.get(k) for k in ("post_processor", "truncation", "padding"))
            and all(a["content"].startswith("<|") and not any(c.isspace() for c in a["content"])
                    and not (a["lstrip"] or a["rstrip"] or a["single_word"]) for a in added))


def content(text: Column, tokenizer: TokenizerFile) -> Column:
    """The normalised content: texts that are equal in it have equal counts.

    For a tokenizer that counts by words: tabs and line feeds become spaces, spaces at both ends go, and A-Z is
    lower-cased in ASCII texts (in others a mark might join with a letter of one case only), except where something
    begins like an added token. For any other tokenizer: the text.
    """
    if not tokenizer.by_word:
        return text
    spaced = F.trim(F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit(" ")))
    folds = (F.octet_length(text) == F.char_length(text)) & ~F.contains(text, F.lit("<|"))
    return F.when(folds, F.lower(spaced)).otherwise(spaced)


class Counter:
    """Counts tokens of whole texts as the library does."""

    def __init__(self, library: str, file: bytes, by_word: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.by_word, self.memo = by_word, {}
        if library == "tokenizers":
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_str(file.decode())
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.encoded = lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            self.merge = tokenizer.model.tokenize
        else:
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_proto=file)
            self.encoded = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]

    def counts(self, texts: pa.Array) -> np.ndarray:
        if not self.by_word:
            return np.asarray(self.encoded(texts.to_pylist()), np.int64)
        lists = pc.ascii_split_whitespace(texts)
        codes = lists.flatten().dictionary_encode()
        of_word = np.asarray(self._words(codes.dictionary.to_pylist()), np.int64)
        sums = np.concatenate([[0], np.cumsum(of_word[np.asarray(codes.indices)])])
        ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists)))])
        return sums[ends[1:]] - sums[ends[:-1]]

    def _words(self, words: list[str]) -> list[int]:
        found = [self.memo.get(w) for w in words]
        odd = []
        for i in [i for i, n in enumerate(found) if n is None]:
            word = words[i]
            if _COMMON.fullmatch(word) and word == word.lower() and "<|" not in word:
                found[i] = sum(map(self._piece, [word] if word.isalpha() else _PIECE.findall(word)))
                self._remember(word, found[i])
            else:
                odd.append(i)
        if odd:
            for i, n in zip(odd, self.encoded([words[i] for i in odd])):
                found[i] = n
                self._remember(words[i], n)
        return found

    def _piece(self, piece: str) -> int:
        """The vocabulary's merges for what the normalizer leaves alone and the pre-tokenizer doesn't split."""
        if (n := self.memo.get(piece)) is None:
            n = len(self.merge(piece.encode().decode("latin-1").translate(byte_letters())))
            self._remember(piece, n)
        return n

    def _remember(self, word: str, n: int) -> None:
        if len(word) <= REMEMBERED_CHARS and len(self.memo) < REMEMBERED:
            self.memo[word] = n


_counters: dict[str, Counter] = {}


def _count(library: str, file: bytes, by_word: bool, name: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _counters:  # one for each Python worker; it lives on from task to task
            _counters.clear()
            _counters[name] = Counter(library, file, by_word)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(_counters[name].counts(batch.column("content")))], ["digest", "n_tokens"])

    return count


def stored_counts(spark: SparkSession, cache: str, tokenizer: TokenizerFile) -> DataFrame:
    """(digest, n_tokens) of all batches that were appended for this tokenizer version, a row for each digest.

    Two runs that missed one digest at the same time both append it; such rows are equal.
    """
    place = f"{cache}/tokenizer={tokenizer.digest}"
    if not exists(spark, place):
        return spark.range(0).selectExpr("cast(null as binary) as digest", "id as n_tokens")
    rows = spark.read.schema(CACHE_SCHEMA).option("recursiveFileLookup", "true").parquet(place)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer_file: str, cache: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit for every row of ``docs``.

    Every text becomes the SHA-256 of its normalised content (``content``). The distinct digests are joined to the
    counts that ``cache`` (a folder that all executors reach) stores for this tokenizer version: the digest of
    the file, its library and the library's version. Only distinct contents that are missing there are encoded, each once, by the
    library (no begin, end or added special tokens, special strings within a text as the library takes
    them, no truncation), and appended to the cache in a folder of their own, so runs don't disturb each other
    and a run that fails halfway leaves only true counts.

    Copies are folded before their text is shuffled, so a text that a third of all rows hold is moved once for each
    map task; its many rows meet the counts as digests, in a join that adaptive execution splits. Where few digests
    are missing, they are broadcast and no other text is shuffled.

    Null texts count as empty and have no tokens; null ids and repeated rows each give their row; an empty table
    gives none and appends nothing. Other columns are not read.
    """
    spark, tokenizer = docs.sparkSession, TokenizerFile(tokenizer_file)
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    keyed = texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                         content(F.col("text"), tokenizer).alias("content"))
    keyed = keyed.withColumn("digest", F.unhex(F.sha2("content", 256)))
    rows = written(keyed.select("doc_id", "n_bytes", "digest"), "token-rows")
    stored = stored_counts(spark, cache, tokenizer)
    asked = rows.select("digest").distinct().join(stored.withColumn("stored", F.lit(True)), "digest", "left")
    asked = written(asked.select("digest", "n_tokens"), "token-digests")
    missing = asked.where("n_tokens is null").select("digest")
    known = asked.where("n_tokens is not null")
    if n_missing := missing.count():
        wanted = keyed.select("digest", "content")
        if n_missing <= BROADCAST_DIGESTS:
            wanted = wanted.join(F.broadcast(missing), "digest", "left_semi")
        one_each = wanted.groupBy("digest").agg(F.first("content").alias("content"))
        if n_missing > BROADCAST_DIGESTS:
            one_each = one_each.join(missing, "digest", "left_semi")
        counted = one_each.mapInArrow(
            _count(tokenizer.library, tokenizer.content, tokenizer.by_word, tokenizer.digest), CACHE_SCHEMA)
        batch = staged_path(spark, "batch").rsplit("/", 1)[1]
        place = f"{cache}/tokenizer={tokenizer.digest}/{batch}"
        counted.write.parquet(place)
        known = known.union(spark.read.schema(CACHE_SCHEMA).parquet(place))
    return rows.join(known, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, against a cache that begins empty."""
    return token_counts(table(spark, folder, "documents"), default_tokenizer(), staged_path(spark, "token-cache"))
