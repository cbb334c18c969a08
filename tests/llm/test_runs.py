"""Periodic runs against plain loops."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from riskloom.llm import periodic_runs
from riskloom.llm.periodic_runs import op12_periodic_runs, run_report

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_by_hand(words):
    """(start, period, length) by trying every period at every place."""
    n, found = len(words), set()
    codes = np.asarray([hash(w) for w in words], np.int64)
    for q in range(1, n // 3 + 1):
        same = codes[:-q] == codes[q:]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(int), [0]])))
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
            end = stop + q
            if end - start >= max(24, 3 * q):
                if not any(q % d == 0 and words[start:end - d] == words[start + d:end] for d in range(1, q)):
                    found.add((start, q, end - start))
    return sorted(found)


def report_by_hand(words):
    runs = runs_by_hand(words)
    dropped = {i for s, q, length in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[2], r[1]), -r[0], -r[1]), default=None)
    top = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def planted_by_hand(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def same_as_by_hand(rows, texts):
    got = sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=str)
    assert got == sorted((report_by_hand(w) for w in texts), key=str)


def test_query(spark, testdata):
    docs = spark.read.parquet(f"{testdata}/documents.parquet").collect()
    want = {d.doc_id: report_by_hand(planted_by_hand(d.doc_id, d.text)) for d in docs}
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in op12_periodic_runs(spark, testdata).collect()}
    assert got == want
    assert sum(v[0] > 0 for v in want.values()) > 50


def periodic_texts():
    rng, out = random.Random(5), []
    for size in (0, 1, 23, 24, 25, 60, 200, 700, 1500):
        for alphabet in (1, 2, 3, 50):
            words = [f"w{rng.randrange(alphabet)}" for _ in range(size)]
            out.append(words)
            q = rng.randrange(1, max(2, size // 3))
            out.append([*words, *(words[:q] * 5)[:max(24, 4 * q)], *words[::-1]])
    fib = ["a"], ["a", "b"]
    while len(fib[1]) < 900:
        fib = fib[1], fib[1] + fib[0]
    out += [fib[1], (fib[1][:30] + ["x"]) * 9, (["a"] * 30 + ["b"]) * 8, [f"{i % 7}" for i in range(23)]]
    return out


@pytest.mark.parametrize("tile", [64, 4096])
def test_built_texts(monkeypatch, tile):
    """Without Spark, as workers don't see the changed length: also with short tiles, so that runs lie over many."""
    texts = periodic_texts()
    monkeypatch.setattr(periodic_runs, "TILE_WORDS", tile)
    for octave in range(12):
        assert periodic_runs.tile_step(octave) * 2 >= periodic_runs.tile_words(octave)
    found = {}
    for words in texts:
        found[tuple(words)] = set()
        codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
        array = np.asarray([codes[w] for w in words], np.int32)
        pieces = {}
        for _, octave, t in periodic_runs.tiles_with_repeats(array, np.zeros(1, np.int64), np.asarray([len(array)])):
            begin = t * periodic_runs.tile_step(octave)
            part = array[begin:begin + periodic_runs.tile_words(octave)]
            for _, q, s, e in zip(*(x.tolist() for x in periodic_runs.solve(octave, [part]))):
                pieces.setdefault(q, []).append((begin + s, begin + e))
        for q, spans in pieces.items():
            low = high = None
            for s, e in sorted(spans) + [(10**9, 10**9)]:
                if low is None or s > high - q:
                    if low is not None and high - low >= max(24, 3 * q):
                        found[tuple(words)].add((low, q, high - low))
                    low, high = s, e
                high = max(high, e)
        assert sorted(found[tuple(words)]) == runs_by_hand(words)


def test_many_tiles(spark):
    """Runs over many tiles, through Spark; a document of one word, a long period, and one text without any."""
    long = [f"w{i}" for i in range(3000)]
    texts = [["a"] * 20_000, long * 4, ["x", *(long[:700] * 3), *long, *(long[:5] * 3000)], long]
    docs = spark.createDataFrame([(i, " \n".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: [(x.start, x.period, x.length) for x in r.runs] for r in run_report(docs).collect()}
    assert got == {0: [(0, 1, 20_000)], 1: [(0, 3000, 12_000)], 2: [(1, 700, 2800), (5101, 5, 15_000)], 3: []}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = run_report(odd_docs, keep_texts=True).collect()
    same_as_by_hand(rows, [WORD.findall(r.text or "") for r in odd_docs.collect()])
    assert run_report(no_docs).collect() == []
    repeated = spark.createDataFrame([(None, "a b " * 20)] * 3 + [(1, " b\na\tb" * 13)], "doc_id long, text string")
    rows = run_report(repeated).collect()
    assert [r.n_runs for r in rows] == [1] * 4 and sum(r.doc_id is None for r in rows) == 3
    same_as_by_hand(rows, [WORD.findall(r.text) for r in repeated.collect()])
    assert {r.collapsed for r in rows if r.doc_id is None} == {"a b"}
