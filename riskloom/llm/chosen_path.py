"""MinHash near-dedup as a chosen-path set similarity join."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import NO_ID, Scratch, release, small_batches, table, whole_text, written
from riskloom.llm.graph import components
from riskloom.llm.textbytes import RangeHash, lower, mix64, pieces, random_words, words
from riskloom.session import staged_path, unstage

#: minwise functions, trees, and functions of each tree, which no other tree uses
FUNCTIONS, TREES, STRIDE = 60, 10, 6
#: branchings before nodes are looked at, branchings at most, and strays of a node that branches no more
FIRST, DEPTH, LEAF = 2, STRIDE, 64
#: chance that a pair at the threshold shares a node of a tree at the last level that the trees grow to
RECALL = 0.999
#: documents and shingles of a block of a node that is compared block by block; tokens that are counted at a time
BLOCK, BLOCK_SHINGLES, TOKENS = 256, 1 << 20, 4096
#: pairs whose signatures agree by this many standard deviations less than a link would are not looked at
LENIENCE = 4.5
#: bytes up to which a word is hashed by a sum
LONG_WORD = 256


def _word_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, hashes: RangeHash) -> np.ndarray:
    """64-bit hashes of words. Sums modulo 2**64 are equal for some pairs of long words whatever the base, so
    words of over LONG_WORD bytes are hashed by BLAKE2b."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    out = hashes.ranges(hashes.sums(raw), begin, end)
    for i in np.flatnonzero(end - begin > LONG_WORD).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(raw[begin[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def _shingle_sets(column: pa.Array, width: int, hashes: RangeHash, weights: np.ndarray) -> Iterator[np.ndarray]:
    """For every text its distinct shingles as sorted 64-bit hashes; shorter texts are one shingle."""
    for low, high, raw, starts in pieces(column):
        raw = lower(raw)
        begin, end, row = words(raw, starts)
        word = _word_hashes(raw, begin, end, hashes)
        first = np.searchsorted(row, np.arange(high - low + 1))
        count = max(0, len(word) - width + 1)
        mixed = np.full(count, width, np.uint64)
        for k in range(width):
            mixed += word[k:k + count] * weights[k]
        mixed = mix64(mixed)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= width:
                yield np.unique(mixed[a:b - width + 1])
            elif b > a:
                short = np.full(1, b - a, np.uint64)
                for k in range(b - a):
                    short += word[a + k:a + k + 1] * weights[k]
                yield mix64(short)
            else:
                yield np.zeros(0, np.uint64)


def _hashing(width: int) -> tuple[RangeHash, np.ndarray]:
    return RangeHash(101), random_words(103, width) | np.uint64(1)


def _signer(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, weights = _hashing(width)
        multiply, add = random_words(107, FUNCTIONS) | np.uint64(1), random_words(109, FUNCTIONS)
        for batch in batches:
            sizes, digests, signatures = [], [], []
            held: list[np.ndarray] = []

            def flush() -> None:
                if not held:
                    return
                size = np.array([len(s) for s in held])
                every = np.concatenate(held)
                full = np.flatnonzero(size)
                signature = np.zeros((len(held), FUNCTIONS), np.int32)
                if len(full):
                    first = (np.cumsum(size) - size)[full]
                    for f in range(FUNCTIONS):
                        least = np.minimum.reduceat(every * multiply[f] + add[f], first)
                        signature[full, f] = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
                sizes.extend(size.tolist())
                signatures.append(signature)
                held.clear()

            waiting = 0
            for shingles in _shingle_sets(batch.column("text"), width, hashes, weights):
                digests.append(np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), np.int64))
                held.append(shingles)
                waiting += len(shingles)
                if waiting > 1 << 17:
                    flush()
                    waiting = 0
            flush()
            if not sizes:
                continue
            digest = np.array(digests)
            flat = np.concatenate(signatures).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * FUNCTIONS, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("md5"), pa.array(sizes, pa.int64()), pa.array(digest[:, 0].copy()),
                 pa.array(digest[:, 1].copy()), lists], ["key", "md5", "n", "d1", "d2", "sig"])

    return sign


def _set_maker(width: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, weights = _hashing(width)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                sets = list(_shingle_sets(batch.column("text").slice(low, 512), width, hashes, weights))
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(low, 512), lists], ["key", "members"])

    return make


def _token(tree: Column, level: int) -> Column:
    """The minwise token by which a tree branches at a level."""
    return F.get("sig", F.pmod(tree * STRIDE + level, F.lit(FUNCTIONS)))


def _with_component(rows: DataFrame, group: DataFrame | None) -> DataFrame:
    """``rows`` with the component that their document has by now; one without a link is a component of its own."""
    if group is None:
        return rows.withColumn("component", F.col("key"))
    known = group.select(F.col("node").alias("linked"), F.col("component").alias("of_linked"))
    return rows.join(known, F.col("key") == F.col("linked"), "left").withColumn(
        "component", F.coalesce("of_linked", "key")).drop("linked", "of_linked")


def _similar(percent: int) -> Column:
    """Whether a pair (n_a, sig_a, n_b, sig_b) can be a link by its sizes and, up to LENIENCE standard deviations, by
    its signatures."""
    share = percent / 100
    least = FUNCTIONS * share - LENIENCE * (FUNCTIONS * share * (1 - share)) ** 0.5
    agree = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda same: same))
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return sizes & (agree >= least)


def _side(rows: DataFrame, side: str, *columns: str) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"{c}_{side}") for c in columns])


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (key_a, key_b) whose full sets are similar enough, as (a, b)."""
    left = sets.select(F.col("key").alias("left"), F.col("members").alias("of_a"))
    right = sets.select(F.col("key").alias("right"), F.col("members").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    both = pairs.join(left, F.col("key_a") == F.col("left")).join(right, F.col("key_b") == F.col("right")).select(
        F.col("key_a").alias("a"), F.col("key_b").alias("b"), common.alias("common"),
        (F.size("of_a") + F.size("of_b")).alias("total"))
    return both.where(100 * F.col("common") >= percent * (F.col("total") - F.col("common"))).select("a", "b")


def _block_links(percent: int):
    """Links between the two blocks of a pair, or within one, on the full sets; enough of them to join what is linked."""
    def compare(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        keys, component, side = (block.column(c).to_numpy() for c in ("key", "component", "block"))
        lists = block.column("members").combine_chunks()
        size = lists.value_lengths().to_numpy().astype(np.int64)
        token, times = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)[1:]
        row = np.repeat(np.arange(len(keys)), size)
        shared = times[token] > 1
        row, token = row[shared], (np.cumsum(times > 1) - 1)[token[shared]]
        order = np.argsort(token, kind="stable")
        row, token = row[order], token[order]
        low, high = np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())
        common = np.zeros((len(low), len(high)))
        edges = np.searchsorted(token, np.arange(0, (token[-1] if len(token) else 0) + TOKENS + 1, TOKENS))
        for a, b in zip(edges[:-1], edges[1:]):
            holds = np.zeros((len(keys), TOKENS), np.float32)
            holds[row[a:b], token[a:b] % TOKENS] = 1
            common += holds[low] @ holds[high].T
        linked = 100 * common >= percent * (size[low][:, None] + size[high][None, :] - common)
        linked &= component[low][:, None] != component[high][None, :]
        above = {c: c for c in component.tolist()}

        def root(c: int) -> int:
            while above[c] != c:
                above[c] = c = above[above[c]]
            return c

        found = []
        for x, y in zip(*np.nonzero(linked)):
            p, q = root(int(component[low[x]])), root(int(component[high[y]]))
            if p != q:
                above[p] = q
                found.append((int(keys[low[x]]), int(keys[high[y]])))
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def _whole_nodes(large: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links (a, b) that join the components of each node: its strays are compared with all of the node, block by block.

    Strays and documents of the largest component are dealt to blocks of their own; every block of strays meets every
    block of the node, each pair of blocks in a task of its own, and documents of the largest component never meet.
    """
    stray = F.col("component") != F.col("main")

    def blocks(of: Column) -> Column:
        return F.ceil(F.greatest(F.count_if(of) / BLOCK, F.sum(F.when(of, F.col("n")).otherwise(0)) / BLOCK_SHINGLES))

    counts = large.groupBy(F.col("node").alias("of")).agg(blocks(stray).alias("of_strays"), blocks(~stray).alias("of_main"))
    own = F.when(stray, F.pmod(F.xxhash64("key"), F.col("of_strays"))).otherwise(
        F.col("of_strays") + F.pmod(F.xxhash64("key"), F.col("of_main")))
    dealt = large.join(counts, F.col("node") == F.col("of")).select("node", "key", "component", "of_strays", "of_main", own.alias("block"))
    partners = F.when(F.col("block") < F.col("of_strays"), F.col("of_strays") + F.col("of_main")).otherwise(F.col("of_strays"))
    full = dealt.join(sets.select(F.col("key").alias("own"), "members"), F.col("key") == F.col("own"))
    met = full.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), partners - 1))).select(
        "node", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "key", "component", "members")
    return met.groupBy("node", "low", "high").applyInArrow(_block_links(percent), "a long, b long")


def _depth(percent: int) -> int:
    """The last level at which a pair at the threshold is together in one of the trees with a chance of RECALL."""
    levels = range(FIRST, DEPTH + 1)
    return max([d for d in levels if 1 - (1 - (percent / 100) ** d) ** TREES >= RECALL], default=FIRST)


class _Links:
    """The links found so far, written as they come, and the components that they make."""

    def __init__(self, spark: SparkSession, sets: DataFrame, percent: int) -> None:
        self.spark, self.sets, self.percent = spark, sets, percent
        self.paths: list[str] = []
        self.group: DataFrame | None = None

    def confirm(self, pairs: DataFrame, scratch: Scratch) -> None:
        self.add(_links(scratch.keep(pairs, "pairs"), self.sets, self.percent))

    def add(self, links: DataFrame) -> None:
        path = staged_path(self.spark, "links")
        links.write.parquet(path)
        every = self.spark.read.schema("a long, b long").parquet(*self.paths, path)
        if self.spark.read.schema("a long, b long").parquet(path).isEmpty():
            return
        self.paths.append(path)
        self.group = components(every)


def _grow(signed: DataFrame, sets_of, percent: int) -> DataFrame | None:
    """The components (node, component) that chosen-path trees find among ``signed``; None without a link.

    A node is a path of minwise tokens. In each node every document is first compared with one of them, that with the
    most copies, which is linear. What then lies in the node outside its largest component are strays. With up to LEAF
    strays each is compared with all documents of other components in the node, so nothing in it is left out; a node
    with more strays branches by one more token. A node of one component is done. Only few nodes live on for long, so
    the levels get small; in one with more strays after as many tokens as RECALL allows the strays are compared with
    all of it as well, block by block on the full sets.
    """
    spark = signed.sparkSession
    last = _depth(percent)
    tree, level, links, left_over = F.col("tree"), FIRST, None, []
    path = F.xxhash64(tree, *[_token(tree, level) for level in range(FIRST)])
    at = signed.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))).select("tree", "key", path.alias("node"))
    slim = signed.select(F.col("key").alias("own"), "n", "sig")
    counted = signed.select(F.col("key").alias("own"), "copies")
    scratch = Scratch(spark)
    while True:
        before = list(scratch.paths)
        # sizes are summed where the documents lie and written, so that the join can split a large node
        sizes = scratch.keep(at.groupBy("node").agg(F.count("*").alias("size")).where("size > 1").select(F.col("node").alias("of")), "sizes")
        placed = scratch.keep(at.join(sizes, F.col("node") == F.col("of"), "left_semi"), "paths")
        scratch.forget(before)  # all that the level before has left is in ``placed``
        if links is None:
            links = _Links(spark, sets_of(placed.select("key").distinct()), percent)
        members = _with_component(placed, links.group).join(counted, F.col("key") == F.col("own")).drop("own")
        order = F.struct("copies", -F.col("key"))
        hubs = members.groupBy(F.col("node").alias("of")).agg(F.max_by("key", order).alias("hub"), F.max_by("component", order).alias("of_hub"))
        rays = members.join(scratch.keep(hubs, "hubs"), F.col("node") == F.col("of")).where(
            F.col("component") != F.col("of_hub")).select("hub", "key").distinct()
        ends = rays.join(_side(slim, "a", "own", "n", "sig"), F.col("hub") == F.col("own_a")).join(
            _side(slim, "b", "own", "n", "sig"), (F.col("key") == F.col("own_b")) & _similar(percent))
        links.confirm(ends.select(F.col("own_a").alias("key_a"), F.col("own_b").alias("key_b")), scratch)

        members = scratch.keep(_with_component(placed, links.group), "members")
        parts = members.groupBy("node", "component").agg(F.count("*").alias("part"))
        state = scratch.keep(parts.groupBy(F.col("node").alias("of")).agg(
            F.sum("part").alias("size"), (F.sum("part") - F.max("part")).alias("strays"), F.max_by("component", "part").alias("main"))
            .where("strays > 0"), "nodes")
        opened = scratch.keep(members.join(state, F.col("node") == F.col("of")).drop("of").join(
            slim, F.col("key") == F.col("own")).drop("own"), "open-members")
        small = opened.where(F.col("strays") <= LEAF)
        strays = _side(small.where("component != main"), "a", "node", "key", "component", "n", "sig")
        others = _side(small, "b", "node", "key", "component", "main", "n", "sig")
        # two strays meet once
        apart = (F.col("component_a") != F.col("component_b")) & ((F.col("component_b") == F.col("main_b")) | (F.col("key_a") < F.col("key_b")))
        out = staged_path(spark, "leaf-pairs")
        strays.join(others, (F.col("node_a") == F.col("node_b")) & apart & _similar(percent)).select(
            "key_a", "key_b").distinct().write.parquet(out)
        left_over.append(out)
        large = opened.where(F.col("strays") > LEAF)
        if large.isEmpty():
            break
        if level >= last:
            links.add(_whole_nodes(large, links.sets, percent))
            break
        at = large.select("tree", "key", F.xxhash64("node", _token(tree, level)).alias("node"))
        level += 1
    pairs = spark.read.schema("key_a long, key_b long").parquet(*left_over).distinct()
    if links.group is not None:
        group = links.group.select(F.col("node"), F.col("component").alias("of_node"))
        for side in ("a", "b"):
            pairs = pairs.join(_side(group, side, "node", "of_node"), F.col(f"key_{side}") == F.col(f"node_{side}"), "left").drop(f"node_{side}")
        pairs = pairs.where("of_node_a is null or of_node_b is null or of_node_a != of_node_b").select("key_a", "key_b")
    links.confirm(pairs, scratch)
    scratch.forget(list(scratch.paths))
    for path in [*left_over, *links.paths]:
        unstage(spark, path)
    return links.group


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Words are runs without white space, A-Z lower-cased; a document's set are its distinct shingles of
    ``width`` words, of a shorter text the whole sequence. Documents with
    100 * intersection >= ``percent`` * union are linked; a component is named by its smallest id.

    Equal sets are one class, represented by its smallest id, so copies never meet each other. Representatives
    are joined by TREES independent chosen-path trees (see ``_grow``); every link is confirmed on the full sets.
    A tree uses functions of its own and branches only as often as a pair at the threshold keeps a chance of RECALL
    to share a node of one of the ten: four times at 0.85 (0.9993), three times at 0.80 (0.9992), twice at less; what
    is still large then is compared whole. A component is found when enough of its links are. Pairs whose signatures agree by
    over LENIENCE standard deviations less than a link's would are not compared: 3 in 100,000 of pairs at the threshold, fewer above.

    Null and empty texts and texts of white space have no set and are linked with nothing. Rows that repeat an id are one
    document if their texts have the same set; else the id stands for either. A null id is one id, which sorts last; a
    component of only such rows is null. An empty table gives no rows;
    other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"), whole_text(text_col).alias("text"))
    hashed = rows.withColumn("md5", F.md5(F.encode("text", "UTF-8")))
    every = written(hashed.mapInArrow(
        _signer(width), "key long, md5 string, n long, d1 long, d2 long, sig array<int>"), "signatures")
    classes = written(every.where("n > 0").groupBy("d1", "d2").agg(F.min("key").alias("least"), F.count("*").alias("copies")), "classes")
    named = classes.withColumnsRenamed({"d1": "c1", "d2": "c2"})
    signed = written(every.join(named, (F.col("key") == F.col("least")) & (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")))
                     .select("key", "md5", "n", "copies", "sig").groupBy("key").agg(
                         *[F.first(c).alias(c) for c in ("md5", "n", "copies", "sig")]), "representatives")

    def sets_of(keys: DataFrame) -> DataFrame:
        """The sets of some representatives, from their texts."""
        needed = keys.select(F.col("key").alias("wanted")).join(signed.select("key", "md5"), F.col("wanted") == F.col("key")).select(
            "wanted", F.col("md5").alias("wanted_md5"))
        fetched = hashed.join(needed, (F.col("key") == F.col("wanted")) & (F.col("md5") == F.col("wanted_md5")), "left_semi")
        return sets.keep(fetched.select("key", "text").mapInArrow(_set_maker(width), "key long, members array<long>"), "sets")

    sets = Scratch(docs.sparkSession)
    group = _grow(signed, sets_of, percent)
    sets.forget(list(sets.paths))
    release(docs.sparkSession)
    # the class table carries the component, so that a class of many copies meets a single row
    if group is None:
        final = named.select("c1", "c2", F.col("least").alias("component"))
    else:
        final = named.join(group, F.col("least") == F.col("node"), "left").select(
            "c1", "c2", F.coalesce("component", "least").alias("component"))
    out = every.select("key", "n", "d1", "d2").join(final, (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")), "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("key"))
    ident = F.when(F.col("key") != NO_ID, F.col("key"))
    return out.select(ident.alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.when(component != NO_ID, component).alias("component_id"), (component == F.col("key")).alias("kept"))


def without_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                            text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rows with a null id stay."""
    gone = near_duplicates(docs, width, percent, id_col, text_col).where("not kept").select(F.col("doc_id").alias("gone_id"))
    return docs.alias("d").join(gone.alias("g"), F.col(f"d.`{id_col}`") == F.col("g.gone_id"), "left_anti")


def op9_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), width=3, percent=85)
