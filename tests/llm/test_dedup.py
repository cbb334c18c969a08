"""Exact, near, chunk and suffix dedup against brute force."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from riskloom.llm import chosen_path, chunk_dedup as chunking, deep_shallow, suffix_dedup as suffixes
from riskloom.llm.chosen_path import near_duplicates, without_near_duplicates
from riskloom.llm.chunk_dedup import chunk_dedup, remove_spans
from riskloom.llm.deep_shallow import deep_shallow_sort
from riskloom.llm.exact_dedup import exact_dedup
from riskloom.llm.graph import components
from riskloom.llm.suffix_dedup import GRAM, SPAN, shared_reach, suffix_dedup
from riskloom.llm.textbytes import random_words

from .conftest import ODD_TEXTS

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def passages(spark):
    """Texts with shared passages, near copies and texts that go round."""
    draw = random.Random(5)
    words = ["".join(draw.choice("aeioustnr") for _ in range(draw.randint(2, 9))) for _ in range(3000)]

    def prose(n):
        return " ".join(draw.choice(words) for _ in range(n))

    shared = [prose(60) for _ in range(3)]
    texts = []
    for n in range(90):
        text = prose(draw.randint(20, 120))
        if n % 2:
            text += " " + shared[n % 3] + (" " if n % 4 == 1 else "") + prose(draw.randint(0, 30))
        texts.append(text)
    base = prose(300).split()
    for _ in range(40):
        own = list(base)
        for _ in range(draw.randint(0, 12)):
            own[draw.randrange(len(own))] = draw.choice(words)
        texts.append(" ".join(own))
    texts += ["ab " * 200, "ab " * 170, "x" * 700, texts[0], texts[0], "é" * 150, "ü" * 99, None, "", "a" * 199, "b" * 200]
    return spark.createDataFrame([(i, t, "src") for i, t in enumerate(texts)], "doc_id long, text string, md5 string")


# exact

def exact_by_hand(rows, pick):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for norm, ids in groups.items():
        real = [i for i in ids if i is not None]
        keep = pick(real) if real else None
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, keep, len(ids), digest) for i in ids]
    return out


@pytest.mark.parametrize("keep, pick", [("largest", max), ("smallest", min)])
@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_exact_dedup_odd_rows(odd_docs, keep, pick, ranges):
    got = exact_dedup(odd_docs, keep=keep, ranges=ranges).collect()
    shown = collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got)
    assert shown == collections.Counter(exact_by_hand(ODD_TEXTS, pick))
    kept = [(r.text_sha256, r.doc_id) for r in got if r.kept]
    assert len(kept) == len({s for s, _ in kept}) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_cuts_a_large_group(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i}") for i in range(900)]
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), keep="largest", ranges=16).collect()
    assert {r.group_size for r in got} == {1, 600}
    assert [r.doc_id for r in got if r.kept and r.group_size > 1] == [899]


def test_exact_dedup_empty(no_docs):
    assert exact_dedup(no_docs).count() == 0


# near

def near_by_hand(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = frozenset(zip(*[w[k:] for k in range(width)])) if len(w) >= width else frozenset([tuple(w)] if w else [])
    parent = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(spark, small_docs, width, percent):
    for docs in (small_docs, passages(spark)):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, width, percent).collect()}
        assert got == near_by_hand(rows, width, percent)


def test_near_duplicates_with_large_nodes(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "LEAF", 3)
    monkeypatch.setattr(chosen_path, "DEPTH", 4)
    docs = passages(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, 3, 85).collect()}
    assert got == near_by_hand(rows, 3, 85)


def family(spark, size, planted, apart=8, near=3):
    """Texts that are alike but under the threshold, and for some of them a near copy just over it."""
    draw = random.Random(11)
    words = [f"w{n}" for n in range(100_000)]
    base = [draw.choice(words) for _ in range(150)]

    def changed(text, places):
        own = list(text)
        for place in draw.sample(range(2, len(own) - 2), places):
            own[place] = draw.choice(words)
        return own

    texts = [changed(base, apart) for _ in range(size)]
    texts += [changed(texts[n], near) for n in range(0, size, size // planted)]
    return spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")


def test_near_duplicates_in_a_large_node_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "LEAF", 8)
    monkeypatch.setattr(chosen_path, "DEPTH", 2)
    monkeypatch.setattr(chosen_path, "BLOCK", 50)
    docs = family(spark, 500, 100)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = near_by_hand(rows, 3, 85)
    assert sum(not kept for *_, kept in want.values()) >= 80
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, 3, 85).collect()} == want


@pytest.mark.parametrize("percent", [80, 85, 90])
def test_trees_keep_their_recall_at_the_last_level(percent):
    depth = chosen_path._depth(percent)
    draw = np.random.default_rng(percent)
    same = draw.random((20_000, chosen_path.FUNCTIONS)) < percent / 100
    tokens = (np.arange(chosen_path.TREES)[:, None] * chosen_path.STRIDE + np.arange(depth)) % chosen_path.FUNCTIONS
    assert len(np.unique(tokens)) == tokens.size
    assert same[:, tokens].all(axis=2).any(axis=1).mean() > 0.998


def test_near_duplicates_in_a_family_under_the_threshold(spark):
    docs = family(spark, 3000, 150, apart=4, near=4)
    rows = {r.doc_id: frozenset(zip(*[r.text.split()[k:] for k in range(3)])) for r in docs.collect()}
    planted = [(n, 3000 + k) for k, n in enumerate(range(0, 3000, 20))]
    linked = [(a, b) for a, b in planted if 100 * len(rows[a] & rows[b]) >= 85 * len(rows[a] | rows[b])]
    assert len(linked) > 100
    got = {r.doc_id: r.component_id for r in near_duplicates(docs, 3, 85).collect()}
    assert sum(got[a] == got[b] for a, b in linked) >= len(linked) - 1


def test_long_words_of_two_letters_differ(spark):
    """Words that sums modulo a power of two can't tell apart, of 1,024 and of 16 bytes."""
    def thue_morse(n, a, b):
        return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))
    x, y = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    rows = [(1, f"{x} one two"), (2, f"{y} one two"), (3, f"{x} p q {y} p q"), (4, f"{thue_morse(16, 'a', 'b')} u v"), (5, f"{thue_morse(16, 'b', 'a')} u v")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (4, 3), 4: (1, 4), 5: (1, 5)}


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    got = near_duplicates(odd_docs).collect()
    assert len(got) == len(ODD_TEXTS)
    of = {r.doc_id: r for r in got if r.doc_id is not None}
    for empty in (3, 4, 5):
        assert (of[empty].n_shingles, of[empty].component_id, of[empty].kept) == (0, empty, True)
    assert of[1].component_id == of[2].component_id == 1 and not of[2].kept
    assert of[7].component_id == 6 and of[10].component_id == 9
    assert sorted(r.component_id for r in got if r.doc_id is None and r.component_id is not None) == [1]
    kept = without_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 3, 4, 5, 6, 8, 9, 11, None, 2**53 + 1, -5}
    assert near_duplicates(no_docs).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


# chunks

def test_chunk_dedup_finds_passages(spark):
    docs = passages(spark)
    got = {r.doc_id: r for r in chunk_dedup(docs).collect()}
    for n in range(1, 90, 2):
        assert got[n].n_shared >= 200
    assert got[0].n_removed == 0 and got[133].n_removed == got[133].n_bytes
    assert not any(n in got for n in range(2, 90, 2))
    cut = {r.doc_id: r.text for r in remove_spans(docs, chunk_dedup(docs)).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for n, text in texts.items():
        removed = got[n].n_removed if n in got else 0
        assert len((cut[n] or "").encode()) == len((text or "").encode()) - removed or "é" in text or "ü" in text


def test_chunk_dedup_survives_an_insertion(spark):
    draw = random.Random(2)
    text = " ".join("".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(400))
    docs = spark.createDataFrame([(1, text), (2, text[:700] + " inserted words " + text[700:])], "doc_id long, text string")
    got = {r.doc_id: r for r in chunk_dedup(docs).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed > 0.85 * len(text)


def test_chunk_dedup_finds_passages_of_two_documents(spark):
    draw = random.Random(8)

    def prose(n):
        return " ".join("".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(2, 8))) for _ in range(n))

    texts = []
    for _ in range(300):
        passage = prose(51)
        texts += [f"{prose(draw.randint(5, 60))} {passage} {prose(draw.randint(5, 60))}" for _ in range(2)]
    texts += ["a short text", "b", "a short text"]
    got = {r.doc_id: r for r in chunk_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert sum(n in got for n in range(600)) >= 598
    assert got[600].n_removed == 0 and got[602].n_removed == got[602].n_bytes and 601 not in got


def test_chunk_dedup_odd_rows(odd_docs, no_docs):
    got = {r.doc_id: r for r in chunk_dedup(odd_docs).collect()}
    assert got[7].n_removed > 0.99 * got[7].n_bytes and 6 in got
    assert not {3, 4, 5, 9, 11} & set(got)
    assert remove_spans(odd_docs, chunk_dedup(odd_docs)).columns == odd_docs.columns
    assert chunk_dedup(no_docs).count() == 0


def _chunks_in_python(data, table):
    """Chunk bounds of one text, byte by byte."""
    bounds, last = [], 0
    for at in range(len(data)):
        size = at + 1 - last
        gear = 0
        for byte in data[max(0, at + 1 - chunking.WINDOW):at + 1]:
            gear = (2 * gear + table[byte]) % 2**32
        if size == chunking.MOST or (size >= chunking.LEAST and gear >> (32 - chunking.CUT_BITS) == 0) or at + 1 == len(data):
            bounds.append((last, at + 1))
            last = at + 1
    return bounds


def _chunk_dedup_in_python(rows):
    """doc_id, n_bytes, n_chunks, n_shared, n_removed, spans by comparing the bytes of chunks; ids are distinct."""
    table = [int(w) for w in random_words(211, 256) >> np.uint64(32)]
    texts = {i: (t or "").encode() for i, t in rows}
    chunks = {i: _chunks_in_python(data, table) for i, data in texts.items()}
    first, own, holders = {}, {}, collections.Counter()
    for i in sorted(texts):
        for begin, end in chunks[i]:
            chunk = texts[i][begin:end]
            first.setdefault(chunk, (i, begin))
            holders[chunk] += own.setdefault((i, chunk), begin) == begin
    found = set()
    for i, data in texts.items():
        runs = []
        for begin, end in chunks[i]:
            if holders[data[begin:end]] > 1 or own[i, data[begin:end]] < begin:
                if runs and runs[-1][-1][1] == begin:
                    runs[-1].append((begin, end))
                else:
                    runs.append([(begin, end)])
        runs = [r for r in runs if r[-1][1] - r[0][0] >= min(chunking.RUN_BYTES, len(data))]
        if not runs:
            continue
        spans = []
        for begin, end in itertools.chain(*runs):
            if first[data[begin:end]] != (i, begin):
                if spans and spans[-1][1] == begin:
                    spans[-1][1] = end
                else:
                    spans.append([begin, end])
        found.add((i, len(data), len(chunks[i]), sum(r[-1][1] - r[0][0] for r in runs), sum(e - b for b, e in spans), len(spans),
                   ",".join(f"{b}:{e}" for b, e in spans)))
    return found


def test_chunk_dedup_equals_a_plain_chunker(spark):
    draw = random.Random(7)
    words = ["".join(draw.choices("abcdeé漢", k=draw.randint(1, 9))) for _ in range(3000)]
    passages = [" ".join(draw.choices(words, k=60)) for _ in range(5)]
    texts = [" ".join(draw.choices(words, k=draw.randint(0, 150))) for _ in range(60)]
    texts += [t + " " + draw.choice(passages) + " " + u for t, u in zip(texts[:20], texts[20:40])]      # shared passages
    texts += [texts[3], texts[3], "tiny", "tiny", "", None, passages[0] + passages[0], "ab" * 2000, "漢" * 300]
    draw.shuffle(texts)
    rows = list(zip(draw.sample(range(10_000), len(texts)), texts))
    got = [tuple(r) for r in chunk_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()]
    assert len(got) == len(set(got)) and set(got) == _chunk_dedup_in_python(rows)


# suffixes

def covered_by_hand(rows):
    seen = collections.Counter(b[k:k + SPAN] for _, b in rows for k in range(len(b) - SPAN + 1))
    out = []
    for i, b in rows:
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - SPAN + 1):
            if seen[b[k:k + SPAN]] > 1:
                gone[k] += 1
                gone[k + SPAN] -= 1
        gone = np.cumsum(gone)[:len(b)] > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return collections.Counter(out)


def found(docs, **settings):
    return collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                               for r in suffix_dedup(docs, **settings).collect())


@pytest.mark.parametrize("large", [20_000, 2])
def test_suffix_dedup_against_all_strings(spark, small_docs, large):
    for docs in (small_docs, passages(spark)):
        rows = [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]
        assert found(docs, large=large) == covered_by_hand(rows)


def test_suffix_dedup_odd_rows(odd_docs, no_docs):
    assert found(odd_docs) == covered_by_hand([(i, (t or "").encode()) for i, t in ODD_TEXTS])
    assert suffix_dedup(no_docs).count() == 0


def test_deep_shallow_sort(monkeypatch):
    draw = random.Random(1)
    for _ in range(600):
        monkeypatch.setattr(deep_shallow, "SHALLOW", draw.choice([0, 2, 5, 64]))
        most = draw.choice([1, 2, 4])
        heads = [bytes(draw.randint(0, most) for _ in range(draw.randint(0, 12))) for _ in range(4)]
        strings = [draw.choice(heads) + bytes(draw.randint(0, most) for _ in range(draw.randint(0, 6)))
                   for _ in range(draw.randint(0, 40))]
        order, prefixes = deep_shallow_sort(strings)
        assert sorted(order) == list(range(len(strings)))
        assert [strings[i] for i in order] == sorted(strings)
        assert prefixes == [-1 if i == 0 else common(strings[order[i - 1]], strings[order[i]]) for i in range(len(order))]


def test_shared_reach_against_all_pairs():
    draw = random.Random(4)

    def alike(parts):
        part = draw.choice(parts)
        cut = draw.randint(0, len(part))
        return part[:cut] + bytes(draw.randint(0, 3) for _ in range(len(part) - cut))

    for _ in range(60):
        gram = bytes(draw.randint(0, 255) for _ in range(GRAM))
        ahead, behind = ([bytes(draw.randint(0, 3) for _ in range(168)) for _ in range(3)] for _ in range(2))
        n = draw.randint(2, 30)
        back, onward = [alike(behind) for _ in range(n)], [gram + alike(ahead) for _ in range(n)]
        got = shared_reach(back, onward)
        for x in range(n):
            pairs = [(common(back[x], back[y]), common(onward[x], onward[y])) for y in range(n) if y != x]
            want = {p for a, b in pairs if a + b >= SPAN for p in range(-a, b)}
            assert {p for a, b in got[x] for p in range(-a, b)} == want


def test_anchors_are_picked_by_content():
    from riskloom.llm.textbytes import RangeHash
    draw = np.random.default_rng(3)
    text = draw.integers(97, 123, 260).astype(np.uint8)
    for lead in range(0, 90, 7):
        raw = np.concatenate([draw.integers(97, 123, lead).astype(np.uint8), text, draw.integers(97, 123, 50).astype(np.uint8)])
        row, first, *_ = suffixes.anchors(raw, np.array([0, len(raw)]), RangeHash(307), RangeHash(311))
        inside = {int(p) - lead for p in first}
        own, alone, *_ = suffixes.anchors(text, np.array([0, len(text)]), RangeHash(307), RangeHash(311))
        assert set(alone.tolist()) <= inside
