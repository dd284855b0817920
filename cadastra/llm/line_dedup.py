"""Fuzzy line dedup: MinHash signatures of byte shingles, banding, exact verification, distributed union-find."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel
from .shared import BROADCAST_BYTES, Scratch, checked_broadcast, lean, small_batches, stars, united

#: Bytes in a shingle, bands, rows in a band. A pair of Jaccard 0.8 shares a band with probability 1 - (1 - 0.8^4)^8 = 0.985, one
#: of 0.85 with 0.997, one of 0.5 with 0.40 (and is then rejected).
Q, BANDS, ROWS = 8, 8, 4
SIMILARITY = 0.8
#: Longs of a line's parity map; most lines and bytes of a band that one task looks at together.
MAPS, SLICE, SLICE_BYTES = 4, 1000, 8 << 20
#: Rounds of pivots over the bands above SLICE lines end when one finds fewer links than this share of the lines it looked at; this
#: decides only who finds the links that are left, not whether: the exact step tries all pairs that remain.
STARS = 0.05
#: Lines of a band up to which all its pairs are listed at once.
LISTED = 48
U = np.uint64
FULL = U(0xFFFFFFFFFFFFFFFF)
SQUEEZE = kernel.LOWER.copy()
SQUEEZE[[9, 11, 12, 13]] = 32
TABLE = SQUEEZE.tobytes()
#: Bytes whose shingles are hashed at once, so that they stay in a core's cache.
BLOCK = 1 << 15


def normalise(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cases A-Z, makes each run of white space inside a line one space and trims lines. Gives the new bytes (with newlines)
    and each line's start and end there, lines in their order."""
    b = np.frombuffer(buf.tobytes().translate(TABLE), np.uint8)
    starts, ends, _ = kernel.lines(buf, offsets)
    space = b == 32
    solid = ~(space | (b == 10))
    odd = space.copy()  # all spaces but those between two bytes of words in one row
    odd[1:-1] &= ~(solid[:-2] & solid[2:])
    filled = offsets[1:] > offsets[:-1]
    for edge in (offsets[:-1][filled], offsets[1:][filled] - 1):
        odd[edge] = space[edge]
    at = np.flatnonzero(odd)
    if not len(at):
        return b, starts, ends
    # a space stays if the next byte is of a word and a word stands before its run in its line
    line = np.searchsorted(starts, at, "right") - 1
    run = at[np.maximum.accumulate(np.where(np.r_[True, at[1:] != at[:-1] + 1], np.arange(len(at)), 0))]
    after = np.minimum(at + 1, len(b) - 1)
    gone = at[~((at + 1 < ends[line]) & ~space[after] & (run > starts[line]))]
    keep = np.ones(len(b), bool)
    keep[gone] = False
    return b[keep], starts - np.searchsorted(gone, starts), ends - np.searchsorted(gone, ends)


def signatures(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Band keys (lines x BANDS) from one-permutation MinHash over shingles of Q bytes; lines shorter than that are one shingle.
    Empty bins borrow from the next filled one. Lines are not empty and stand in their order."""
    bins, n = BANDS * ROWS, len(starts)
    low = np.full(n * bins, FULL)
    wide = np.concatenate([buf, np.zeros(Q, np.uint8)])
    view = np.ndarray((len(buf) + 1,), "<u8", wide, strides=(1,))
    length = ends - starts
    count = np.maximum(length - Q + 1, 1)
    bounds = np.r_[starts, ends[-1:]]
    for i, j in kernel.chunks(bounds, BLOCK):  # every byte of these lines begins a shingle; those that reach beyond a line are not counted
        first, span = starts[i], np.diff(bounds[i : j + 1])
        h = view[first : bounds[j]].copy()
        short = i + np.flatnonzero(length[i:j] < Q)
        h[starts[short] - first] &= (U(1) << (length[short] * 8).astype(U)) - U(1)
        h *= U(kernel.P)
        h ^= h >> U(32)
        h *= U(0xD6E8FEB86659FD93)
        h ^= h >> U(29)
        beyond = span - count[i:j]
        h[np.repeat(starts[i:j] - first + count[i:j] - (np.cumsum(beyond) - beyond), beyond) + np.arange(beyond.sum())] = FULL
        cell = (h >> U(64 - bins.bit_length() + 1)).view(np.int64)
        cell += np.repeat(np.arange(i * bins, j * bins, bins), span)
        np.minimum.at(low, cell, h)
    low = low.reshape(n, bins)
    gap = np.flatnonzero((low == FULL).any(1))
    if len(gap):
        some = low[gap]
        twice = np.concatenate([some, some], axis=1)
        at = np.where(twice != FULL, np.arange(2 * bins), 4 * bins)
        at = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1][:, :bins]
        got = np.take_along_axis(twice, at % (2 * bins), 1)
        far = (at - np.arange(bins)).astype(U)
        low[gap] = np.where(far > 0, kernel.mix(got + far * U(kernel.P)), some)
    key = np.zeros((n, BANDS), U)
    with np.errstate(over="ignore"):
        for i in range(ROWS):
            key = kernel.mix(key * U(kernel.P) + low[:, i * BANDS : (i + 1) * BANDS] + U(i + 1))
        return kernel.mix(key + np.arange(1, BANDS + 1, dtype=U)[None, :] * U(kernel.P_INV))


def _line_batches(batches):
    for batch in batches:
        data, offsets = kernel.buffers(batch.column(2))
        for i, j in kernel.chunks(offsets):
            raw, o = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            buf, starts, ends = normalise(raw, o)
            _, _, rows = kernel.lines(raw, o)
            number = np.arange(len(rows)) - np.searchsorted(rows, rows)
            full = ends > starts
            starts, ends, rows, number = starts[full], ends[full], rows[full], number[full]
            if not len(rows):
                continue
            keys = signatures(buf, starts, ends).view(np.int64)
            text = buf.tobytes()
            digest = np.frombuffer(
                b"".join(hashlib.blake2b(text[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist())), "<i8"
            ).reshape(-1, 2)
            at = pa.array(rows + i)
            yield pa.record_batch(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array(number.astype(np.int32)),
                    pa.array(digest[:, 0]),
                    pa.array(digest[:, 1]),
                    pa.array((ends - starts).astype(np.int32)),
                    pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), pa.array(keys.ravel())),
                ],
                ["dk", "th", "line", "d1", "d2", "size", "bands"],
            )


def _candidate_texts(batches):
    """From rows (dk, th, text, lines) the normalised text of each of these lines (line, node, slices), its bands, its number of shingles
    and their parity map. A document that a task has met already is left out."""
    met = set()
    for batch in batches:
        ids = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        fresh = []
        for x in ids:
            fresh.append(x not in met)
            met.add(x)
        batch = batch.filter(pa.array(fresh, pa.bool_()))
        data, offsets = kernel.buffers(batch.column(2))
        flat, many = batch.column(3).flatten(), batch.column(3).value_lengths().to_numpy()
        numbers, upto = flat.field("line").to_numpy(), np.r_[0, np.cumsum(many)]
        for i, j in kernel.chunks(offsets):
            raw, o = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            buf, first, last = normalise(raw, o)
            _, _, rows = kernel.lines(raw, o)
            chosen = np.repeat(np.searchsorted(rows, np.arange(j - i)), many[i:j]) + numbers[upto[i] : upto[j]]
            order = np.argsort(chosen)
            of, chosen = flat.slice(upto[i], len(order)).take(pa.array(order)), chosen[order]
            whole = buf.tobytes()
            lines = [whole[a:b] for a, b in zip(first[chosen].tolist(), last[chosen].tolist())]
            sets = [shingles(x) for x in lines]
            maps = parity(sets)
            text = b"".join(lines)
            ends = np.cumsum([len(x) for x in lines])
            at = np.r_[0, ends].astype(np.int32)
            keys = signatures(np.frombuffer(text, np.uint8), at[:-1].astype(np.int64), ends).view(np.int64).ravel()
            bands = pa.ListArray.from_arrays(np.arange(0, len(keys) + 1, BANDS, dtype=np.int32), pa.array(keys))
            texts = pa.StringArray.from_buffers(len(lines), pa.py_buffer(at), pa.py_buffer(text))
            yield pa.record_batch(
                [of.field("node"), texts, pa.array([len(s) for s in sets], pa.int32()), *(pa.array(maps[:, k]) for k in range(MAPS)), bands, of.field("slices")],
                ["node", "t", *SIGNS, "bands", "slices"],
            )


def shingles(text: str | bytes) -> np.ndarray:
    """Sorted distinct shingles of a normalised line of Q bytes or more, as numbers; none of shorter ones, which only equal lines match."""
    raw = text.encode() if isinstance(text, str) else text
    if len(raw) < Q:
        return np.zeros(0, U)
    v = np.sort(np.ndarray((len(raw) - Q + 1,), "<u8", raw, strides=(1,)))
    new = np.empty(len(v), bool)
    new[0] = True
    np.not_equal(v[1:], v[:-1], out=new[1:])
    return v[new]


SIGNS = ["n", *(f"m{i}" for i in range(MAPS))]


def parity(sets: list[np.ndarray]) -> np.ndarray:
    """For each set and each of MAPS * 64 buckets whether an odd number of shingles falls there (sets x MAPS longs). Two maps differ in no
    more bits than their sets in shingles."""
    out, width = np.zeros((len(sets), MAPS), np.int64), 64 * MAPS
    ends = np.cumsum([len(s) for s in sets])
    for i, j in kernel.chunks(np.r_[0, ends]):
        line = np.repeat(np.arange(j - i), [len(s) for s in sets[i:j]])
        at = (kernel.mix(np.concatenate(sets[i:j])) & U(width - 1)).astype(np.int64)
        odd = (np.bincount(line * width + at, minlength=(j - i) * width) & 1).astype(np.uint8)
        out[i:j] = np.packbits(odd).view("<i8").reshape(-1, MAPS)
    return out


def may_match(a: str, b: str) -> str:
    """SQL: false only for pairs that `similar` rejects: at Jaccard j two sets differ in (1 - j) / (1 + j) of their joint sizes."""
    apart = " + ".join(f"bit_count({a}m{i} ^ {b}m{i})" for i in range(MAPS))
    sizes = f"least({a}n, {b}n) > 0 and least({a}n, {b}n) + 1e-6D >= {SIMILARITY}D * greatest({a}n, {b}n)"
    return f"{sizes} and ({apart}) * {1 + SIMILARITY}D <= ({a}n + {b}n) * {1 - SIMILARITY:.6f}D + 1e-3D"


def similar(s: np.ndarray, t: np.ndarray) -> bool:
    """Whether two shingle sets have a Jaccard similarity of SIMILARITY or more."""
    if min(len(s), len(t)) < SIMILARITY * max(len(s), len(t)) or not len(s):
        return False
    at = np.minimum(np.searchsorted(t, s), len(t) - 1)
    both = int((t[at] == s).sum())
    return both >= SIMILARITY * (len(s) + len(t) - both)


def _verified(batches):
    """Keeps the pairs of similar lines; each text's shingles are made once a batch."""
    for batch in batches:
        known: dict[str, np.ndarray] = {}
        ok = []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            for x in (a, b):
                if x not in known:
                    known[x] = shingles(x)
            ok.append(similar(known[a], known[b]))
        yield batch.filter(pa.array(ok, pa.bool_())).select([0, 1])


class _Met:
    """Lines that meet in bands, as arrays: those of one (band, slice) stand together."""

    def __init__(self, table: pa.Table):
        get = lambda c: table.column(c).to_numpy()
        self.band, self.node, self.n = get("band"), get("node"), get("n").astype(np.int64)
        self.maps = np.stack([get(f"m{i}") for i in range(MAPS)], axis=1)
        self.bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        self.text, self.known = table.column("t"), {}
        slices = get("slice")
        self.starts = np.flatnonzero(np.r_[True, (self.band[1:] != self.band[:-1]) | (slices[1:] != slices[:-1])])
        self.sizes = np.diff(np.r_[self.starts, len(self.band)])

    def may(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether two lines may match and meet in this band first."""
        low, high = np.minimum(self.n[i], self.n[j]), np.maximum(self.n[i], self.n[j])
        apart = np.bitwise_count((self.maps[i] ^ self.maps[j]).view(U)).sum(1, dtype=np.int64)
        ok = (low > 0) & (low + 1e-6 >= SIMILARITY * high) & (apart * (1 + SIMILARITY) <= (low + high) * (1 - SIMILARITY) + 1e-3)
        at = np.flatnonzero(ok)
        i, j = np.broadcast_to(i, ok.shape)[at], j[at]
        same = self.bands[i] == self.bands[j]
        ok[at] = self.bands[i, same.argmax(1)] == self.band[j]
        return ok

    def similar(self, i: int, j: int) -> bool:
        for k in (i, j):
            if k not in self.known:
                self.known[k] = shingles(self.text[k].as_py())
        return similar(self.known[i], self.known[j])

    def links(self) -> tuple[list[int], list[int]]:
        us, vs = [], []
        for size in np.unique(self.sizes[(self.sizes > 1) & (self.sizes <= LISTED)]).tolist():
            a, b = np.triu_indices(size, 1)
            starts = self.starts[self.sizes == size]
            i, j = (starts[:, None] + a).ravel(), (starts[:, None] + b).ravel()
            at = np.flatnonzero(self.may(i, j))
            root: dict[int, int] = {}
            for x, y in zip(i[at].tolist(), j[at].tolist()):
                p, q = x, y
                while p in root:
                    p = root[p]
                while q in root:
                    q = root[q]
                if p != q and self.similar(x, y):
                    root[max(p, q)] = min(p, q)
                    us.append(x)
                    vs.append(y)
        for start, size in zip(self.starts[self.sizes > LISTED].tolist(), self.sizes[self.sizes > LISTED].tolist()):
            self.known.clear()
            comp = np.arange(start, start + size)
            for x in range(start, start + size - 1):
                rest = np.arange(x + 1, start + size)
                rest = rest[comp[rest - start] != comp[x - start]]
                for y in rest[self.may(np.array([x]), rest)].tolist() if len(rest) else ():
                    if comp[y - start] != comp[x - start] and self.similar(x, y):
                        comp[comp == comp[y - start]] = comp[x - start]
                        us.append(x)
                        vs.append(y)
        return us, vs


def _met(batches):
    """From rows sorted by (band, slice) the links among the lines of each, as many as it takes to join them."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        band, part = table.column("band").to_numpy(), table.column("slice").to_numpy()
        cut = np.flatnonzero((band[1:] != band[:-1]) | (part[1:] != part[:-1]))
        cut = int(cut[-1]) + 1 if len(cut) else 0
        held = table.slice(cut)
        if cut:
            yield _linked(table.slice(0, cut))
    if held is not None and held.num_rows:
        yield _linked(held)


def _linked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    met = _Met(table)
    u, v = (np.array(x, int) for x in met.links())
    return met.node[u], met.node[v]


def _met_stars(batches):
    return stars(_met(batches))


def _rebuilt(batches):
    """From rows (..., text, dropped) the text without the dropped lines."""
    for batch in batches:
        texts, left = [], []
        for text, drop in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
            gone = set(drop)
            kept = [x for k, x in enumerate(text.split("\n")) if k not in gone]
            texts.append("\n".join(kept))
            left.append(len(gone))
        yield pa.record_batch(
            [*batch.columns[:-2], pa.array(texts, batch.column(batch.num_columns - 2).type), pa.array(left, pa.int64())],
            [*batch.schema.names[:-1], "n_dropped"],
        )


def _crowded(texts: DataFrame, comp: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root with the links between lines in different slices of a band joined in."""
    texts = scratch.put(texts.where(F.exists("slices", lambda x: x > 1)), "crowded")
    first = texts.select("node", *SIGNS, F.explode(F.arrays_zip("bands", "slices")).alias("p")).where("p.slices > 1")
    first = scratch.put(first.select(F.col("p.bands").alias("band"), F.col("p.slices").alias("slices"), "node", *SIGNS), "posts")

    def rooted(comp: DataFrame) -> DataFrame:
        of = checked_broadcast(comp, 48, alias=lambda x: x.withColumnRenamed("node", "id"))
        return first.join(of, F.col("node") == F.col("id"), "left").withColumn("root", F.coalesce("root", "node")).drop("id")

    def joined(pairs: DataFrame) -> DataFrame:
        a, b = texts.select(F.col("node").alias("u"), F.col("t").alias("tu")), texts.select(F.col("node").alias("v"), F.col("t").alias("tv"))
        pairs = pairs.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()
        return scratch.put(pairs.join(a, "u").join(b, "v").select("u", "v", "tu", "tv").mapInArrow(lean(_verified), "u long, v long"), "links")

    again = 0
    while True:
        again += 1
        live = scratch.put(rooted(comp), "live")
        mixed = live.groupBy("band").agg(
            F.min(F.struct(F.xxhash64("node", F.lit(again)).alias("o"), F.struct("node", "root", *SIGNS).alias("p"))).alias("a"),
            F.max(F.struct(F.xxhash64("node", F.lit(again)).alias("o"), F.struct("node", "root", *SIGNS).alias("p"))).alias("b"),
            F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("c"),
        ).where("lo <> hi")
        mixed = scratch.put(mixed.select("band", F.array("a.p", "b.p").alias("pivots"), "c"), "mixed")
        most = mixed.agg(F.sum("c")).first()[0]
        if not most:
            return comp
        star = live.join(checked_broadcast(mixed, 200), "band").select("node", "root", *SIGNS, F.explode("pivots").alias("p"))
        found = joined(star.where("root <> p.root and " + may_match("", "p.")).select(F.col("node").alias("x"), F.col("p.node").alias("y")))
        new = found.count()
        if new:
            comp = united(comp.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(found), scratch)
        if new <= STARS * most:
            break
    live = rooted(comp)
    mixed = scratch.put(live.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("band"), "left")
    live = live.join(checked_broadcast(mixed, 48), "band", "left_semi").select("band", "slices", F.struct("node", "root", *SIGNS).alias("a"))
    live = scratch.put(live, "open")
    one = live.select("band", F.pmod(F.xxhash64("a.node", "band"), F.col("slices")).cast("int").alias("slice"), "a")
    other = live.select(
        F.col("band").alias("other_band"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other_slice"),
        F.pmod(F.xxhash64("a.node", "band"), F.col("slices")).cast("int").alias("own_slice"), F.col("a").alias("b"),
    )
    same = "band = other_band and slice = other_slice and slice < own_slice and a.root <> b.root and " + may_match("a.", "b.")
    found = joined(one.join(other.where("other_slice < own_slice"), F.expr(same)).select(F.col("a.node").alias("x"), F.col("b.node").alias("y")))
    return united(comp.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(found), scratch)


def line_dedup(docs: DataFrame) -> DataFrame:
    """All rows and columns of docs(doc_id, text, ...), each text without the lines that another kept line repeats, and two columns
    n_lines (lines before) and n_dropped in front: exactly one line of each class of near-equal lines stays in the whole corpus.

    Lines are compared lower-cased (A-Z), trimmed and with single spaces. Equal ones are joined by a 128-bit digest, both halves of
    which are the key. Of the distinct lines, those that share one of BANDS bands meet in it, in slices of at most SLICE lines and
    SLICE_BYTES: a pair is decided in the first band that both have, by sizes, parity maps and then the exact Jaccard similarity of the
    shingle sets, unless its lines already are in one class. The links found go to a distributed union-find. Bands of several slices
    go on: their lines first meet two pivots a round, drawn anew, while this finds many links; then all pairs that still are in
    different classes are tried. So every pair that shares a band is decided, and only banding may leave a pair of similar lines
    apart; tests measure how few. The line of the smallest (doc_id, line number) stays.

    Blank lines are no candidates and stay. Null texts come back null with no lines, empty ones unchanged; null doc_ids order last.
    Rows repeated with equal doc_id and text are one document: they come back equal, each with the lines that this document keeps. A
    document may lose all of its lines; its row stays. Empty tables give empty results; other columns pass through, but for n_lines
    and n_dropped, which are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "line_dedup")
    docs = docs.drop("n_lines", "n_dropped")
    others = [c for c in docs.columns if c != "text"]
    ident = [F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("dk"), F.xxhash64("text").alias("th")]
    src = docs.select(*ident, F.col("text").cast("string").alias("text")).where("text is not null and text <> ''")
    rows = scratch.put(src.mapInArrow(lean(_line_batches), "dk long, th long, line int, d1 long, d2 long, size int, bands array<long>"), "lines")
    each = rows.groupBy("d1", "d2").agg(
        F.min(F.struct("dk", "th", "line")).alias("m"), F.count(F.lit(1)).alias("c"), F.max("size").alias("size"), F.first("bands").alias("bands")
    )
    # a written id stays what it is
    each = scratch.put(each.withColumn("node", F.monotonically_increasing_id()), "distinct")
    posts = each.select(F.posexplode("bands").alias("place", "band"), "size", "node")
    shared = posts.groupBy("band").agg(F.count(F.lit(1)).alias("c"), F.sum("size").alias("bytes")).where("c > 1")
    slices = F.expr(f"cast(greatest((c - 1) div {SLICE}, bytes div {SLICE_BYTES}) + 1 as int)")
    shared = scratch.put(shared.select("band", slices.alias("slices")), "bands")
    # of each line with a shared band its slices by the band's place, 0 where it is alone there
    posts = posts.select("place", "band", "node").join(checked_broadcast(shared, 48), "band").groupBy("node")
    posts = posts.agg(F.map_from_entries(F.collect_list(F.struct("place", "slices"))).alias("by"))
    posts = posts.select("node", F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.coalesce(F.element_at("by", k), F.lit(0))).alias("slices"))
    where = posts.join(each.select("node", "m"), "node").groupBy("m.dk", "m.th").agg(F.collect_list(F.struct("m.line", "node", "slices")).alias("lines"))
    where = scratch.put(where, "where")
    docs_n, lines_n = where.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("lines")), F.lit(0))).first()
    side = F.broadcast(where) if 64 * docs_n + 120 * lines_n <= BROADCAST_BYTES else where
    schema = "node long, t string, n int, " + ", ".join(f"m{i} long" for i in range(MAPS)) + ", bands array<long>, slices array<int>"
    texts = scratch.put(src.join(side, ["dk", "th"]).select("dk", "th", "text", "lines").mapInArrow(lean(_candidate_texts), schema), "texts")
    if texts.count() > lines_n:  # repeated rows in different tasks
        texts = scratch.put(texts.dropDuplicates(["node"]), "texts")
    met = texts.select("node", "t", *SIGNS, "bands", F.explode(F.filter(F.arrays_zip("bands", "slices"), lambda x: x["slices"] > 0)).alias("p"))
    met = met.select(F.col("p.bands").alias("band"), F.pmod(F.xxhash64("node", "p.bands"), F.col("p.slices")).cast("int").alias("slice"), "node", *SIGNS, "bands", "t")
    met = met.repartition("band", "slice").sortWithinPartitions("band", "slice").mapInArrow(lean(_met_stars), "node long, root long")
    comp = united(met, scratch)
    if not shared.where("slices > 1").isEmpty():
        comp = _crowded(texts, comp, scratch)
    # of each class the smallest line stays
    members = comp.unionAll(comp.select(F.col("root").alias("node"), "root").distinct())
    members = scratch.put(members.join(each.select("node", "m"), "node"), "members")
    kept = scratch.put(members.groupBy("root").agg(F.min("m").alias("k")), "kept")
    members = scratch.put(members.join(checked_broadcast(kept, 96), "root").select("node", "k"), "keepers")
    bad = each.select("node", "d1", "d2", "m", "c").join(checked_broadcast(members, 96), "node", "left").where("c > 1 or k <> m")
    bad = scratch.put(bad.select("d1", "d2", F.coalesce("k", "m").alias("k")), "bad")
    drops = rows.select("dk", "th", "line", "d1", "d2").join(checked_broadcast(bad, 120), ["d1", "d2"]).where("dk <> k.dk or th <> k.th or line <> k.line")
    drops = scratch.put(drops.groupBy("dk", "th").agg(F.collect_set("line").alias("dropped")), "drops")
    scratch.keep(drops)
    key = [F.col(k).alias(f"_line_{k}") for k in ("dk", "th", "dropped")]
    text = F.coalesce(F.col("text"), F.lit(""))
    n_lines = F.when(text == "", 0).otherwise(F.size(F.split(text, "\n"))).cast("long").alias("n_lines")
    base = docs.select(n_lines, *others, "text", *(i.alias(f"_line_{k}") for i, k in zip(ident, ("dk", "th"))))
    marked = base.join(checked_broadcast(drops, 256, alias=lambda x: x.select(*key)), ["_line_dk", "_line_th"], "left")
    out = ["n_lines", *others, "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.select(*out).schema) + ", n_dropped long"
    cut = marked.where("_line_dropped is not null").select(*out, "_line_dropped").mapInArrow(lean(_rebuilt), schema)
    whole = marked.where("_line_dropped is null").select(*out, F.lit(0).cast("long").alias("n_dropped"))
    return cut.unionByName(whole).select("n_lines", "n_dropped", *others[: docs.columns.index("text")], "text", *others[docs.columns.index("text") :])
