"""Exact n-gram Jaccard self-join with adaptive multi-match prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel
from .shared import Scratch, checked_broadcast, lean, small_batches, united

U = np.uint64
#: Counters in one block of the frequency sketch; the sketch has 2^16 to 2^22 counters, by the number of documents.
BLOCK, LEAST_BITS, MOST_BITS = 4096, 16, 22
#: Where a counter stops (it only orders tokens), and how many groups of tasks are summed apart at first.
MOST_COUNTED, FAN_IN = 65535, 64
#: Share of all shingles, by hash, over which tokens of one class only are counted first: so many times the distance allowed.
OWN_SHARE = 2.0
#: Longest prefix extension, and the cost of verifying a candidate in postings read.
MOST_MATCHES, VERIFY = 4, 8.0
#: Rounds of pivots end when one adds no more than this share of the links found; the exact step takes what is left.
STARS = 0.02
#: Longest list of prefix tokens that a posting carries; pairs of longer ones are told apart after the join.
LISTED = 256


def token_sets(column: pa.Array, words: int):
    """For each row its sorted distinct shingle hashes."""
    data, offsets = kernel.buffers(column)
    for i, j in kernel.chunks(offsets):
        o = offsets[i : j + 1] - offsets[i]
        buf = kernel.LOWER[data[offsets[i] : offsets[j]]]
        ws, we = kernel.words(buf, o)
        h = kernel.range_hashes(buf, ws, we)
        at = np.searchsorted(ws, o)
        with np.errstate(over="ignore"):
            if len(h) >= words:
                s = np.zeros(len(h) - words + 1, U)
                for k in range(words):
                    s = kernel.mix(s * U(kernel.P) + h[k : k + len(s)])
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                if b - a >= words:
                    yield np.unique(s[a : b - words + 1])
                elif b > a:
                    x = U(b - a)
                    for k in range(a, b):
                        x = kernel.mix(np.array([x * U(kernel.P) + h[k]]))[0]
                    yield np.array([x])
                else:
                    yield np.zeros(0, U)


def sketch_batches(batches, words: int, bits: int):
    count = np.zeros(1 << bits, np.int32)
    for batch in batches:
        for s in token_sets(batch.column(0), words):
            if len(s):
                np.add.at(count, (s >> U(64 - bits)).astype(np.int64), 1)
    if count.any():
        blocks = np.minimum(count, MOST_COUNTED).astype(np.uint16).reshape(-1, BLOCK)
        some = np.flatnonzero(blocks.any(1))
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array([blocks[k].tobytes() for k in some], pa.binary())], ["block", "counts"])


def sum_blocks(key: tuple[pa.Scalar, ...], tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums one block over tasks, batch by batch; counters stop at MOST_COUNTED."""
    total = np.zeros(BLOCK, np.int64)
    for table in tables:
        for x in table.column("counts").to_pylist():
            total += np.frombuffer(x, np.uint16)
    counts = np.minimum(total, MOST_COUNTED).astype(np.uint16)
    yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([counts.tobytes()], pa.binary())], ["block", "counts"])


def frequencies(text: DataFrame, words: int, bits: int) -> np.ndarray:
    """Number of documents by hashed shingle, over all documents, in 2^bits counters of two bytes (8 MB at most). Tasks send their counters
    by block; blocks are summed on the executors in two levels, over FAN_IN groups of tasks and then over these, as streams of batches."""
    parts = text.mapInArrow(lean(lambda it: sketch_batches(it, words, bits)), "block int, counts binary")
    parts = parts.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(FAN_IN)))
    for keys in (["block", "part"], ["block"]):
        parts = parts.groupBy(*keys).applyInArrow(sum_blocks, "block int, counts binary")
    total = np.zeros(((1 << bits) // BLOCK, BLOCK), np.uint16)
    for r in parts.collect():
        total[r.block] = np.frombuffer(r.counts, np.uint16)
    return total.ravel()


def matches_needed(excess: np.ndarray, base: int, need: int) -> int:
    """How many shared prefix tokens to ask for: 1 where the prefix has no frequent token, else the number with the least estimated
    cost: postings of the lengthened prefix plus verification of the documents that can share so many of its tokens."""
    if not excess[:base].any():
        return 1
    best, at = None, 1
    for n in range(1, min(MOST_MATCHES, need) + 1):
        part = excess[: base + n - 1]
        cost = float(part.sum()) + VERIFY * float(np.partition(part, len(part) - n)[len(part) - n])
        if best is None or cost < best:
            best, at = cost, n
    return at


def prefix_batches(batches, words: int, percent: int, freq: np.ndarray):
    bits = int(np.log2(len(freq)))
    some = U(min(0xFFFF, int(OWN_SHARE * (100 - percent) / 100 * 0x10000)))
    usual = float(freq.mean()) + 4 * float(freq.mean()) ** 0.5 + 4
    for batch in batches:
        n, s1, s2, matches, prefix, sample = [], [], [], [], [], []
        for s in token_sets(batch.column(2), words):
            n.append(len(s))
            d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
            s1.append(int.from_bytes(d[:8], "little", signed=True))
            s2.append(int.from_bytes(d[8:], "little", signed=True))
            f = freq[(s >> U(64 - bits)).astype(np.int64)].astype(np.int64)
            order = np.lexsort((s, f))
            need = -(-percent * len(s) // 100)
            base = len(s) - need + 1
            k = matches_needed(np.maximum(f[order] - usual, 0.0), base, need) if len(s) else 1
            matches.append(k)
            sample.append(s[(s & U(0xFFFF)) < some].view(np.int64))
            prefix.append(s[order[: base + k - 1]].view(np.int64) if len(s) else np.zeros(0, np.int64))
        yield pa.record_batch(
            [
                batch.column(0),
                batch.column(1),
                pa.array(n, pa.int64()),
                pa.array(s1, pa.int64()),
                pa.array(s2, pa.int64()),
                pa.array(matches, pa.int32()),
                _lists(prefix),
                _lists(sample),
            ],
            ["doc_id", "th", "n", "s1", "s2", "matches", "prefix", "sample"],
        )


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64), pa.int64()))


def set_batches(batches, words: int):
    for batch in batches:
        sets = [s.view(np.int64) for s in token_sets(batch.column(1), words)]
        yield pa.record_batch([batch.column(0), _lists(sets)], ["node", "tokens"])


def ngram_join(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Texts are lower-cased (A-Z) and split at ASCII white space; the set of a document holds the 64-bit hashes of its distinct shingles
    of `words` words, or of all its words where there are fewer. Two documents link when 100 * shared >= percent * united;
    component_id is the smallest doc_id reachable over links. Documents without words link with nothing. No link is lost:

    1. Equal sets become one class (128-bit digest). Tokens are ordered by an estimate of their document frequency, then by hash. A
       class's prefix are its rarest tokens, lengthened where frequent ones raise its estimated candidate cost; a pair is a candidate
       only if it shares as many prefix tokens as the smaller of both extensions asks for.
    2. Tokens that only one class has bound its overlap with any other. They are counted over a share of all shingles, drawn by hash
       (what isn't counted only makes the bound looser), and classes that cannot reach the threshold go: all but near copies, in most
       corpora. Prefix tokens in two or more of the classes left keep their postings; over these classes' whole sets the same count
       is made once more in full, and bounds classes and pairs.
    3. Each token's postings first meet two pivots only, the class with the smallest share of such own tokens and one drawn anew each
       round; verified links make components. What is left to try are pairs in different components, by prefix tokens that still see
       two or more; these all are verified. A large group of near copies hangs together by its pivot and never becomes all pairs.

    Null doc_ids stay null and never are the smallest; null texts count as empty; repeated rows come back once each; empty tables give
    empty results; other columns are ignored.
    """
    return grouped(docs, words, percent).select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """ngram_join's rows with two further columns: th (a hash of the text, null for null) and group (a number for each component of two
    rows or more, null for rows that link with nothing). component_id is null where group is, or where no row has a doc_id."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "ngram_join")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), text)
    bits = min(max(int(max(docs.count(), 1)).bit_length() + 2, LEAST_BITS), MOST_BITS)
    freq = spark.sparkContext.broadcast(frequencies(src.select("text"), words, bits))
    schema = "doc_id long, th long, n long, s1 long, s2 long, matches int, prefix array<long>, sample array<long>"
    rows = scratch.put(src.mapInArrow(lean(lambda it: prefix_batches(it, words, percent, freq.value)), schema), "rows")
    freq.destroy()
    again, seed = None, 0
    while True:  # node: 64 bits of the digest; the few classes that share them are hashed anew
        full = _with_node(rows.where("n > 0"), again)
        classes = scratch.put(full.groupBy("node", "s1", "s2").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("size")), "classes")
        shared = scratch.put(classes.groupBy("node").count().where("count > 1").select("node"), "clashes")
        if shared.isEmpty():
            break
        seed += 1
        fresh = classes.join(shared, "node").select("s1", "s2", F.xxhash64("s1", "s2", F.lit(seed)).alias("again"))
        again = scratch.put(fresh if again is None else again.join(fresh, ["s1", "s2"], "left_anti").unionByName(fresh), "again")
    tokens = full.select("node", F.explode("sample").alias("token")).groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    own = tokens.where("lo = hi").groupBy(F.col("lo").alias("node")).agg(F.count(F.lit(1)).alias("own"))
    far = scratch.put(own.join(full.select("node", "n").distinct(), "node").where(f"100 * (n - own) < {percent} * n").select("node"), "far")
    near = scratch.put(full.select("node").distinct().join(far, "node", "left_anti"), "near")
    full = full.join(checked_broadcast(near, 48), "node", "left_semi")
    posts = full.select(F.explode("prefix").alias("token"), "node", "n", "matches")
    shared = scratch.put(posts.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("token"), "tokens")
    posts = scratch.put(posts.join(checked_broadcast(shared, 48), "token", "left_semi").distinct(), "posts")
    out = classes.where("size > 1").select("node", F.col("first").alias("component_id"), F.col("node").alias("group"))
    if not posts.isEmpty():
        comp = linked(src, full, posts, words, percent, scratch)
        roots = comp.join(classes, "node").groupBy("root").agg(F.min("first").alias("component_id"))
        inside = scratch.put(comp.join(roots, "root").select("node", "component_id", F.col("root").alias("group")), "inside")
        # a class of one document that links with no other class has no group
        alone = inside.groupBy("group").agg(F.count(F.lit(1)).alias("c"), F.first("node").alias("node")).where("c = 1")
        alone = alone.join(classes.where("size = 1").select("node"), "node", "left_semi").select("node")
        inside = inside.join(alone, "node", "left_anti")
        out = inside.unionAll(out.join(inside, "node", "left_anti"))
    out = scratch.put(out, "out")
    scratch.keep(*([rows, out] if again is None else [rows, out, again]))
    found = _with_node(rows, again).withColumn("node", F.when(F.col("n") > 0, F.col("node")))
    return found.join(checked_broadcast(out, 64), "node", "left").select("doc_id", "th", F.col("n").alias("n_shingles"), "component_id", "group")


def _with_node(rows: DataFrame, again: DataFrame | None) -> DataFrame:
    node = F.xxhash64("s1", "s2", F.lit(0))
    if again is None:
        return rows.withColumn("node", node)
    return rows.join(checked_broadcast(again, 48), ["s1", "s2"], "left").withColumn("node", F.coalesce("again", node)).drop("again")


def linked(src: DataFrame, full: DataFrame, posts: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """node, root (of its component) of the classes that may have links."""
    nodes = posts.select("node").distinct()
    where = full.join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "th")).alias("m"))
    where = scratch.put(where.select("node", "m.doc_id", "m.th").withColumnRenamed("doc_id", "id"), "where")
    picked = src.join(
        checked_broadcast(where, 64), F.col("doc_id").eqNullSafe(F.col("id")) & (src["th"] == where["th"])
    ).select("node", "text")
    sets = scratch.put(picked.mapInArrow(lean(lambda it: set_batches(it, words)), "node long, tokens array<long>").dropDuplicates(["node"]), "sets")
    for _ in range(2):  # own: tokens that no other class still in play has
        own = (
            sets.select("node", F.explode("tokens").alias("token"))
            .groupBy("token")
            .agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node"))
            .where("c = 1")
            .groupBy("node")
            .agg(F.count(F.lit(1)).alias("own"))
        )
        size = sets.select("node", F.size("tokens").cast("long").alias("n")).join(own, "node", "left")
        size = size.select("node", (F.col("n") - F.coalesce("own", F.lit(0))).alias("most"), "n").where(f"100 * most >= {percent} * n")
        size = scratch.put(size.select("node", "most"), "bounds")
        sets = scratch.put(sets.join(checked_broadcast(size, 48), "node", "left_semi"), "sets")
    posts = scratch.put(posts.join(checked_broadcast(size, 48), "node"), "live")
    can = f"least(a.n, b.n) * 100 >= {percent} * greatest(a.n, b.n) and {100 + percent} * least(a.most, b.most) >= {percent} * (a.n + b.n)"

    def verified(pairs: DataFrame) -> DataFrame:
        u, v = sets.select(F.col("node").alias("u"), F.col("tokens").alias("x")), sets.select(F.col("node").alias("v"), F.col("tokens").alias("y"))
        both = F.size(F.array_intersect("x", "y"))
        return scratch.put(
            pairs.join(u, "u").join(v, "v").where((100 + percent) * both >= percent * (F.size("x") + F.size("y"))).select("u", "v"), "links"
        )

    def merged(comp: DataFrame, found: DataFrame) -> DataFrame:
        of = lambda c, r: checked_broadcast(comp, 48, alias=lambda x: x.select(F.col("node").alias(c), F.col("root").alias(r)))
        edges = found.join(of("u", "ru"), "u").join(of("v", "rv"), "v").select(F.col("ru").alias("u"), F.col("rv").alias("v"))
        got = united(edges, scratch).select(F.col("node").alias("root"), F.col("root").alias("up"))
        return scratch.put(comp.join(checked_broadcast(got, 48), "root", "left").select("node", F.coalesce("up", "root").alias("root")), "comp")

    comp, total, again = scratch.put(posts.select("node").distinct().withColumn("root", F.col("node")), "comp"), 0, 0
    while True:
        again += 1
        live = posts.join(checked_broadcast(comp, 48), "node").select("token", F.struct("node", "root", "n", "most", "matches").alias("a"))
        mixed = live.groupBy("token").agg(
            F.min(F.struct((1 - F.col("a.most") / F.col("a.n")).alias("own"), F.col("a").alias("b"))).alias("p"),
            F.min(F.struct(F.xxhash64("token", "a.node", F.lit(again)).alias("own"), F.col("a").alias("b"))).alias("q"),
            F.min("a.root").alias("lo"),
            F.max("a.root").alias("hi"),
        )
        mixed = scratch.put(mixed.where("lo <> hi").select("token", F.array("p.b", "q.b").alias("b")), "mixed")
        if total is None or mixed.isEmpty():
            break
        star = live.join(checked_broadcast(mixed, 160), "token").select("a", F.explode("b").alias("b")).where(f"a.root <> b.root and {can}")
        found = verified(star.select(F.greatest("a.node", "b.node").alias("u"), F.least("a.node", "b.node").alias("v")).distinct())
        new = found.count()
        total += new
        if new:
            comp = merged(comp, found)
        if new <= STARS * total:
            total = None  # the rest is left to the exact step, over the components as they are now
    live = live.join(checked_broadcast(mixed, 160, alias=lambda x: x.select("token")), "token", "left_semi")
    # a pair comes out of the join once, at its smallest common token, if it has as many as needed; classes with very long prefixes
    # carry no list of theirs, and their pairs are counted after the join
    lists = live.groupBy(F.col("a.node").alias("node")).agg(F.array_sort(F.collect_list("token")).alias("prefix")).where(F.size("prefix") <= LISTED)
    lists = scratch.put(lists, "lists")
    live = scratch.put(live.join(checked_broadcast(lists, 8 * LISTED), F.col("a.node") == F.col("node"), "left").select("token", "a", "prefix"), "open")
    other = live.select(F.col("token").alias("same"), F.col("a").alias("b"), F.col("prefix").alias("other"))
    need, common = F.least("a.matches", "b.matches"), F.array_intersect("prefix", "other")
    once = F.col("prefix").isNull() | F.col("other").isNull() | ((F.get(common, F.lit(0)) == F.col("token")) & (F.size(common) >= need))
    cross = live.join(other, (F.col("token") == F.col("same")) & F.expr(f"a.node < b.node and a.root <> b.root and {can}") & once)
    cross = cross.groupBy(F.col("a.node").alias("u"), F.col("b.node").alias("v")).agg(
        F.count(F.lit(1)).alias("c"), F.min(need).alias("need"), F.bool_or(F.col("prefix").isNotNull() & F.col("other").isNotNull()).alias("counted")
    )
    found = verified(cross.where("counted or c >= need").select("u", "v"))
    return comp if found.isEmpty() else merged(comp, found)
