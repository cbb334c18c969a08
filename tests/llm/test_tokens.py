"""Token counts against the libraries, with caches that are empty, partly filled and full."""

import random

import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from riskloom.llm import token_cache
from riskloom.llm.token_cache import Counter, TokenizerFile, op11_token_counts, token_counts

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"]


def library(name):
    path = str(public_tokenizers.path(name))
    if name.endswith(".json"):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
    from sentencepiece import SentencePieceProcessor
    model = SentencePieceProcessor(model_file=path)
    return lambda text: len(model.encode(text))


def odd_texts():
    draw = random.Random(4)
    letters = ["a", "B", "Z", "é", "É", "é", "W̊", "İ", "İ", "ß", "ẞ", "Σ", "ς", "ſ", "Å", "Å", "ǅ", "ª", "²", "½", "7", "'s", "'LL", "'",
               ".", "!?", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", " ", "  ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\xa0",
               " ", "​", "漢", "字", "😀", "́", "한", "ก็", "\x00", "İx", "ŉ"]
    return ["".join(draw.choice(letters) for _ in range(draw.randrange(1, 14))) for _ in range(3000)]


@pytest.mark.parametrize("name", FILES)
def test_counter_is_exact_on_odd_texts(name):
    tokenizer, count = TokenizerFile(str(public_tokenizers.path(name))), library(name)
    assert tokenizer.by_word == (name == "word_bpe_49k.json")
    texts = odd_texts() + ["", " ", "plain words, don't you'll THEY'VE 1234 x.y"]
    counter = Counter(tokenizer.library, tokenizer.content, tokenizer.by_word)
    for _ in range(2):    # the second time from memory
        assert counter.counts(pa.array(texts)).tolist() == [count(t) for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_normalised_content_keeps_counts(spark, name):
    tokenizer, count = TokenizerFile(str(public_tokenizers.path(name))), library(name)
    texts = [t for t in odd_texts() if "\x00" not in t] + ["Hello\tWORLD\n", "  hello world "]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", token_cache.content(F.col("text"), tokenizer).alias("c")).collect()
    assert all(count(r.c) == count(r.text) for r in rows)
    if tokenizer.by_word:
        assert rows[-1].c == rows[-2].c == "hello world"


def test_query(spark, testdata):
    count = library("word_bpe_49k.json")
    docs = spark.read.parquet(f"{testdata}/documents.parquet").collect()
    want = {(d.doc_id, len((d.text or "").encode()), n := count(d.text or ""), n > 2048) for d in docs}
    got = op11_token_counts(spark, testdata).collect()
    assert len(got) == len(docs) and {tuple(r) for r in got} == want and any(r.over_limit for r in got)


@pytest.mark.parametrize("few", [token_cache.BROADCAST_DIGESTS, 0])
def test_only_missing_contents_are_encoded(spark, monkeypatch, tmp_path, few):
    monkeypatch.setattr(token_cache, "BROADCAST_DIGESTS", few)
    count, path, cache = library("word_bpe_49k.json"), token_cache.default_tokenizer(), str(tmp_path / "cache")
    tokenizer = TokenizerFile(path)
    texts = [f"Text number {i % 300} of many." for i in range(900)] + ["the hot text"] * 500 + ["THE HOT\ttext"] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)

    def batches():
        place = tmp_path / "cache" / f"tokenizer={tokenizer.digest}"
        return sorted(spark.read.parquet(str(p)).count() for p in place.iterdir())
    half = token_counts(docs.where("doc_id < 150"), path, cache)
    assert half.count() == 150 and batches() == [150]
    for _ in range(2):
        got = {r.doc_id: r.n_tokens for r in token_counts(docs, path, cache).collect()}
        assert got == {i: count(t) for i, t in enumerate(texts)} and batches() == [150, 151]    # the second run appends nothing
    other = token_counts(docs, str(public_tokenizers.path("byte_bpe_50k.json")), cache, limit=6)
    exact = library("byte_bpe_50k.json")
    assert {(r.doc_id, r.n_tokens, r.over_limit) for r in other.collect()} == {(i, exact(t), exact(t) > 6) for i, t in enumerate(texts)}
    # two runs that missed the same contents both appended them
    spark.read.parquet(f"{cache}/tokenizer={tokenizer.digest}/*").write.parquet(f"{cache}/tokenizer={tokenizer.digest}/batch-again")
    assert {r.doc_id: r.n_tokens for r in token_counts(docs, path, cache).collect()} == got


def test_odd_rows(spark, odd_docs, no_docs, tmp_path):
    count, path = library("word_bpe_49k.json"), token_cache.default_tokenizer()
    got = sorted((tuple(r) for r in token_counts(odd_docs, path, str(tmp_path / "a")).collect()), key=str)
    rows = [(r.doc_id, r.text or "") for r in odd_docs.select("doc_id", "text").collect()]
    assert got == sorted(((i, len(t.encode()), count(t), count(t) > 2048) for i, t in rows), key=str)
    assert token_counts(no_docs, path, str(tmp_path / "b")).collect() == [] and not (tmp_path / "b").exists()
    (tmp_path / "x.txt").write_text("x")
    with pytest.raises(ValueError, match="neither"):
        TokenizerFile(str(tmp_path / "x.txt"))
