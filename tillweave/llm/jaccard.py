"""N-gram Jaccard join by parity sketches.

A text's set is its distinct shingles of five lower-cased words. Within a band of sizes the hash
space is cut into blocks; XOR-ing the hashes that fall into a block gives the block's parity
sketch. One differing shingle changes one block, so two sets whose symmetric difference is at most
D differ in at most D blocks: sketch distance bounds set distance from below. A similarity of 0.75
means D <= (a + b) / 7, so of the non-empty blocks, in one global order, the first D + 1 of either set
must share a block (pigeonhole over prefixes). These block sketches are joined; candidates are
verified on the whole sets.

Exactness: bands overlap (a set whose partner may lie in the next band joins there too); small sets
have one shingle a block; a set with too few non-empty blocks for its D also joins by single
shingles. The order puts blocks of frequent shingles last; it changes cost, never results. The
counts are of shingles in 3 or more different sets of a batch, summed over the batches; the HEAVY_KEPT most
frequent set levels in a table of fixed size. A shingle rarer than that in every batch has level 0 and is not salted.

Cost: equal sets are one class first. A bucket's members are linked to its smallest member if their
sizes allow it; wherever members of like size then still lie in different components, whatever became
of their stars, the others are held against each other by parity bits, so groups of copies cost links in
proportion to their size. Buckets of the same members are tried once; a large one is cut into blocks, and
every two blocks meet in a task of their own, which returns only pairs that the bits do not rule out.
Buckets of frequent blocks are salted by document. Only ids of candidates are broadcast, up to BROADCAST_IDS rows.

Defined results: no words or null text: size 0 and linked with nothing; a null doc_id is its own row
with a null component; rows that repeat a doc_id are one node, linked where either text is;
extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm import arrays as A
from tillweave.llm.components import components
from tillweave.llm.shared import need, settled, ship

ship(__name__)

WORDS, FIRST_BAND, FACTOR, FILL = 5, 64, 4, 1.5
#: Shingles in HEAVY documents or more are frequent; of these the HEAVY_KEPT most frequent count.
HEAVY, HEAVY_KEPT, HEAVY_BITS = 24, 1 << 20, 22
SALTS, STAR, ENTRIES, MAX_BUCKETS = 16, 256, 200_000, 1 << 20
#: Entries that a task gathers before it hands them on.
HELD_ENTRIES = 1 << 18
#: Members of a bucket that meet in one block; pairs that a task holds before it sifts or yields them.
MEETING, HELD_PAIRS = 512, 1 << 18
#: Documents that are candidates are found by a broadcast of two ids and a salt up to this many rows (20 bytes each).
BROADCAST_IDS = 200_000
#: 64-bit words of the parity bits that candidates are held against before their texts are fetched: BIT_WORDS up to
#: BIT_SHINGLES shingles, and four times as many for every four times as many shingles.
BIT_WORDS, BIT_SHINGLES = 16, 1440
SETS = "kind long, doc_id long, n long, s1 long, s2 long, bits array<long>"
K = [np.uint64(x | 1) for x in (0x9AE16A3B2F90404F, 0xC949D7C7509E6557, 0xFF51AFD7ED558CCD, 0xD6E8FEB86659FD93)]


def _set_batches(batches):
    """kind 0: doc_id, size, two set hashes, parity bits; kind 1: a shingle hash found in 3 or more different sets of a batch."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        size, one, two, kept, bits, long, seen = [], [], [], [], [], [], set()
        for _i, _j, buf, offs in A.chunks(batch.column("text")):
            ptr, h = A.shingle_sets(buf, offs, WORDS)
            size.append(np.diff(ptr))
            words, each = parity_bits(ptr, h)
            bits.append(words)
            long.append(each)
            one.append(A.sums(A.mix(h ^ K[0]).view(np.int64), ptr))
            two.append(A.sums(A.mix(h ^ K[1]).view(np.int64), ptr))
            kept.append(h[np.repeat(_unseen(one[-1], size[-1], seen), size[-1])])
        if not size:
            continue
        n, one, two = (np.concatenate(x) for x in (size, one, two))
        heavy, times = _met_often(kept)
        zero, none = np.zeros(len(heavy), np.int64), np.zeros(len(n), np.int64)
        columns = ((none, zero + 1), (ids, heavy), (n, times), (one, zero), (two, zero))
        at = np.cumsum(np.concatenate(([0], *long, zero))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(bits)))
        yield pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(x)) for x in columns), lists], ["kind", "doc_id", "n", "s1", "s2", "bits"])


def _met_often(kept: list[np.ndarray], least: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that occur at least so often, and how often; counted by ranges of hashes, to sort little at a time."""
    heavy, times = [], []
    for part in range(16):
        h = np.sort(np.concatenate([k[(k >> np.uint64(60)) == part] for k in kept]))
        start = np.flatnonzero(np.concatenate((np.ones(min(len(h), 1), bool), h[1:] != h[:-1])))
        count = np.diff(np.append(start, len(h)))
        heavy.append(h[start[count >= least]].view(np.int64))
        times.append(count[count >= least])
    return np.concatenate(heavy), np.concatenate(times)


def parity_bits(ptr: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity bits of every set, in 64-bit words, and how many words each has. A shingle flips one bit, so differing bits never
    outnumber differing shingles; a set's bits at a quarter of the width are the XOR of the quarters of its words."""
    words = BIT_WORDS << (2 * np.searchsorted(BIT_SHINGLES * 4 ** np.arange(20), np.diff(ptr)))
    base, row = np.concatenate(([0], np.cumsum(words * 64))), A.owners(ptr)
    bit = base[row] + (A.mix(h ^ K[2]) % (words * 64).astype(np.uint64)[row]).astype(np.int64)
    odd = np.bincount(bit, minlength=base[-1]) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8"), words


def folded(words: np.ndarray, start: np.ndarray, each: np.ndarray, width: int) -> np.ndarray:
    """Rows of parity words, each folded to width words."""
    out = np.empty((len(start), width), np.uint64)
    for k in np.unique(each):
        r = np.flatnonzero(each == k)
        out[r] = np.bitwise_xor.reduce(words[start[r][:, None] + np.arange(k)].reshape(len(r), k // width, width), axis=1)
    return out


def _unseen(sig: np.ndarray, n: np.ndarray, seen: set) -> np.ndarray:
    """Marks the first row of every set not yet in seen, and adds them to it."""
    out = np.zeros(len(sig), bool)
    for r, key in enumerate(zip(sig.tolist(), n.tolist(), strict=True)):
        if key not in seen:
            seen.add(key)
            out[r] = True
    return out


def bands(n: np.ndarray) -> np.ndarray:
    """0 below FIRST_BAND, then one band for each FACTOR in size."""
    edges = [FIRST_BAND * FACTOR**k for k in range(20)]
    return np.searchsorted(edges, n, "right")


def sketch_tokens(h: np.ndarray, n: np.ndarray, band: int, levels: np.ndarray, single: bool = False):
    """Block sketches of rows of one band: token, row, the level of its rarest shingle."""
    ptr = np.concatenate(([0], np.cumsum(n)))
    row = A.owners(ptr)
    level = levels[(h >> np.uint64(64 - HEAVY_BITS)).astype(np.int64)]
    if band == 0 or single:
        return A.mix(h * K[2] + np.uint64(band * 2 + single)), row, level
    m = np.uint64(int(FIRST_BAND * FACTOR**band / FILL))
    block = ((h >> np.uint64(32)) * m) >> np.uint64(32)  # grows with h, and rows are sorted by h
    new = np.ones(len(h), bool)
    new[1:] = (block[1:] != block[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    if not len(at):
        return h, row, level
    parity = np.bitwise_xor.reduceat(A.mix(h * K[3]), at)
    return A.mix(parity ^ (block[at] * K[2]) ^ np.uint64(band << 1)), row[at], np.minimum.reduceat(level, at)


def prefix(token, row, level, keep: np.ndarray):
    """The first keep[row] tokens of each row in the global order: rarest first, then by hash."""
    order = np.lexsort((token, level, row))
    token, row, level = token[order], row[order], level[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
    some = rank < keep[row]
    return token[some], row[some], level[some] > 0


def _gathered(out: list) -> pa.RecordBatch:
    """Entries sorted into buckets, one row for each: its tokens, and its ids as 32-bit offsets of the smallest where these suffice."""
    bucket, token, doc = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.argsort(bucket, kind="stable")
    bucket, token, doc = bucket[order], token[order], doc[order]
    at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    ends = np.concatenate((at, [len(bucket)]))
    base = int(doc.min())
    ids = doc if int(doc.max()) - base >= 1 << 32 else (doc - base).astype(np.uint32)
    blobs = lambda x: pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((ends * x.itemsize).astype(np.int32)), pa.py_buffer(x)])
    return pa.RecordBatch.from_arrays([pa.array(bucket[at]), pa.array(np.full(len(at), base)), blobs(token), blobs(ids)], ["bucket", "base", "tokens", "ids"])


def _entries(table) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and doc_ids of the rows that _gathered made."""
    token, doc = [], []
    for base, t, i in zip(table.column("base").to_pylist(), table.column("tokens"), table.column("ids"), strict=True):
        token.append(np.frombuffer(t.as_buffer(), np.int64))
        short = len(i.as_buffer()) < len(t.as_buffer())
        doc.append(np.frombuffer(i.as_buffer(), np.uint32).astype(np.int64) + base if short else np.frombuffer(i.as_buffer(), np.int64))
    return np.concatenate(token), np.concatenate(doc)


def _entry_batches(packed_levels: bytes, buckets: int):
    def run(batches):
        levels = np.frombuffer(zlib.decompress(packed_levels), np.uint8)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            out, seen, held = [], set(), 0
            for i, j, buf, offs in A.chunks(batch.column("text")):
                ptr, h = A.shingle_sets(buf, offs, WORDS)
                n = np.diff(ptr)
                first = _unseen(A.sums(A.mix(h ^ K[0]).view(np.int64), ptr), n, seen) & (n > 0)
                home = bands(n)
                longest = n * 4 // 3
                for band in range(int(home.max(initial=0)) + 2):
                    edge = FIRST_BAND * FACTOR**band  # sizes of this band stay below it
                    for rows in (np.flatnonzero(first & (home == band)), np.flatnonzero(first & (home == band - 1) & (longest >= edge // FACTOR))):
                        if not len(rows):
                            continue
                        size = n[rows]
                        hh = h[np.repeat(ptr[rows] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())]
                        need_ = (size + np.minimum(longest[rows], edge - 1)) // 7 + 1
                        token, row, level = sketch_tokens(hh, size, band, levels)
                        some = np.bincount(row, minlength=len(rows))
                        parts = [prefix(token, row, level, need_)]
                        few = np.flatnonzero(some < need_)
                        if len(few):  # too few blocks for the pigeonhole: single shingles too
                            start = np.concatenate(([0], np.cumsum(size)[:-1]))[few]
                            one = hh[np.repeat(start - np.concatenate(([0], np.cumsum(size[few])[:-1])), size[few]) + np.arange(size[few].sum())]
                            t, r, v = prefix(*sketch_tokens(one, size[few], band, levels, True), need_[few])
                            parts.append((t, few[r], v))
                        for t, r, v in parts:
                            doc = ids[i:j][rows][r]
                            salt = np.where(v, 1 + (A.mix(doc.view(np.uint64)) % np.uint64(SALTS)).astype(np.int64), 0)
                            out.append((((A.mix(t + salt.astype(np.uint64)) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64) * 2 + v, t.view(np.int64), doc))
                            held += len(t)
                if held >= HELD_ENTRIES:
                    yield _gathered(out)
                    out, held = [], 0
            if held:
                yield _gathered(out)

    return run


FOUND = "kind int, token long, a long, others array<long>"


def join_bucket(table):
    """kind 0: a candidate pair (a, others[0]); 1: members of a block shared by three or more; 2: a salt's smallest."""
    salted = table.column("bucket")[0].as_py() % 2
    token, doc = _entries(table)
    order = np.lexsort((doc, token))
    token, doc = token[order], doc[order]
    new = np.concatenate(([True], (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])))
    token, doc = token[new], doc[new]
    start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    size = np.diff(np.append(start, len(token)))
    lead = np.repeat(doc[start], size)
    pair = np.unique(np.stack((doc, lead), axis=1)[doc != lead], axis=0)
    low = np.arange(len(start)) if salted else start[:0]
    # groups of the same members, by two sums of their hashes, count once; a salt is a part of a group and stays
    h = A.mix(doc.view(np.uint64))
    ends = np.append(start, len(token))
    sums = np.stack((A.sums(h.view(np.int64), ends), A.sums(A.mix(h ^ K[1]).view(np.int64), ends), size), axis=1)
    many = np.arange(len(start)) if salted else np.flatnonzero(size >= 3)
    if not salted and len(many):
        many = many[np.sort(np.unique(sums[many], axis=0, return_index=True)[1])]
    of = np.repeat(start[many] - np.concatenate(([0], np.cumsum(size[many])[:-1])).astype(np.int64), size[many]) + np.arange(size[many].sum()) if len(many) else start[:0]
    per = np.concatenate((np.ones(len(pair), np.int64), size[many], np.zeros(len(low), np.int64)))
    others = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(per))).astype(np.int32)), pa.array(np.concatenate((pair[:, 1], doc[of]))))
    kinds = np.repeat([0, 1, 2], (len(pair), len(many), len(low))).astype(np.int32)
    tokens = np.concatenate((np.zeros(len(pair), np.int64), token[start[many]], token[start[low]]))
    a = np.concatenate((pair[:, 0], doc[start[many]], doc[start[low]]))
    return pa.table({"kind": pa.array(kinds), "token": pa.array(tokens), "a": pa.array(a), "others": others})


MEMBER = ["token", "like", "lo", "hi", "block", "rep", "n", "component", "words"]
FOUND_PAIR = ["token", "like", "ca", "cb", "far", "a", "b", "many"]


def _meet_batches(nearest: bool):
    """Members of blocks, sorted by group: the pairs of a group in different components that sizes and parity bits allow, or of
    each two components the pair whose bits differ least and how many there are. words is 0 where no bits are known: such pairs are allowed."""

    def sifted(found: list[np.ndarray]) -> np.ndarray:
        """Rows of FOUND_PAIR without repeats; of each two components in a bucket one, if only the nearest are asked for."""
        x = np.concatenate(found)
        key = x[:, :7] if nearest else x[:, 5:7]
        x = x[np.lexsort(key.T[::-1])]
        key = x[:, :4] if nearest else x[:, 5:7]
        at = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
        out = x[at]
        out[:, 7] = np.add.reduceat(x[:, 7], at)
        return out

    def rows(x: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in x.T.copy()], FOUND_PAIR)

    def run(batches):
        held, words = None, np.zeros(0, np.uint64)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                new = [batch.column(c).to_numpy(zero_copy_only=False) for c in MEMBER]
                held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
                words = np.concatenate((words, batch.column("bits").flatten().to_numpy(zero_copy_only=False).view(np.uint64)))
            if held is None or not len(held[0]):
                continue
            edge = np.concatenate(([True], np.any([k[1:] != k[:-1] for k in held[:4]], axis=0)))
            stop = len(edge) if batch is None else int(np.flatnonzero(edge)[-1])  # the last group may go on
            token, like, lo, hi, block, rep, n, component, each = (x[:stop] for x in held)
            held = [x[stop:] for x in held]
            known, words = words, words[each.sum() :]
            found, many = [], 0
            if stop:
                start, first = np.cumsum(each) - each, np.flatnonzero(edge[:stop])
                group = np.cumsum(edge[:stop]) - 1
                width = np.minimum.reduceat(np.where(each, each, 1 << 40), first)[group]
            for w in np.unique(width) if stop else ():
                of = np.flatnonzero(width == w)
                at = np.zeros(stop, np.int64)
                drawn = of[each[of] > 0]
                at[drawn] = np.arange(len(drawn))
                bits = folded(known, start[drawn], each[drawn], int(w)) if len(drawn) else None
                i, d = of, 1
                while True:
                    i = i[i + d < stop]
                    i = i[group[i] == group[i + d]]
                    if not len(i):
                        break
                    j = i + d
                    ok = (component[i] != component[j]) & ((block[i] != block[j]) | (lo[i] == hi[i])) & (4 * np.minimum(n[i], n[j]) >= 3 * np.maximum(n[i], n[j]))
                    p, q = i[ok], j[ok]
                    far, sure = np.zeros(len(p), np.int64), np.flatnonzero((each[p] > 0) & (each[q] > 0))
                    if len(sure):
                        far[sure] = np.bitwise_count(bits[at[p[sure]]] ^ bits[at[q[sure]]]).sum(axis=1, dtype=np.int64)
                    ok = 7 * far <= n[p] + n[q]
                    p, q = p[ok], q[ok]
                    c = component[p], component[q]
                    found.append(np.stack((token[p], like[p], np.maximum(*c), np.minimum(*c), far[ok], np.maximum(rep[p], rep[q]), np.minimum(rep[p], rep[q]), np.ones_like(p)), axis=1))
                    many += len(p)
                    if many >= HELD_PAIRS:
                        found = [sifted(found)]
                        many = len(found[0])
                        if many >= HELD_PAIRS // 2:
                            yield rows(found[0])
                            found, many = [], 0
                    d += 1
            if many:
                yield rows(sifted(found))

    return run


def _verify_batches(batches):
    """Rows sorted by center and salt, centers first; yields the pairs that link."""
    group, held = None, []
    for batch in batches:
        key = list(zip(batch.column("c").to_pylist(), batch.column("salt").to_pylist(), strict=True))
        doc, lead = batch.column("doc_id").to_pylist(), batch.column("lead").to_pylist()
        a, b = [], []
        for i, j, buf, offs in A.chunks(batch.column("text")):
            ptr, h = A.shingle_sets(buf, offs, WORDS)
            for r in range(i, j):
                mine = h[ptr[r - i] : ptr[r - i + 1]]
                if key[r] != group:
                    group, held = key[r], []
                if lead[r]:
                    held.append(mine.copy())
                    continue
                for other in held:
                    at = np.minimum(np.searchsorted(other, mine), max(len(other) - 1, 0))
                    both = int((other[at] == mine).sum()) if len(other) else 0
                    if both and 100 * both >= 75 * (len(mine) + len(other) - both):
                        a.append(doc[r]), b.append(group[0])
                        break
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def fitting(df: DataFrame) -> DataFrame:
    """df, with a broadcast hint if it has at most BROADCAST_IDS (short) rows; else joins shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else df


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of documents, b the center, whose whole sets are similar enough.

    A center meets at most about STAR others in one salt; its text goes to each salt once."""
    sizes = pairs.groupBy("b").agg(F.count("*").alias("k"))
    salted = fitting(settled(pairs.join(sizes, "b").select("a", "b", F.expr(f"cast(pmod(xxhash64(a), k div {STAR} + 1) as int)").alias("salt"))))
    heads = fitting(settled(salted.select("b", "salt").distinct()))
    texts = docs.select("doc_id", "text")
    sides = texts.join(salted, F.col("doc_id") == F.col("a")).select(F.col("b").alias("c"), "salt", "doc_id", F.lit(0).alias("lead"), "text")
    heads = texts.join(heads, F.col("doc_id") == F.col("b")).select(F.col("b").alias("c"), "salt", "doc_id", F.lit(1).alias("lead"), "text")
    rows = sides.unionByName(heads).repartition("c", "salt").sortWithinPartitions("c", "salt", F.desc("lead"), "doc_id")
    return rows.mapInArrow(_verify_batches, "a long, b long")


def apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components."""
    of = lambda c: comp.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}"))
    both = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return both.filter("coalesce(c_a, a) != coalesce(c_b, b)").drop("c_a", "c_b")


def like_sizes(n: str):
    """Two size classes of a set: sets that may link, by their sizes, have one in common (4 / 3 < exp(1 / 3))."""
    k = F.floor(F.ln(n) * 3).cast("int")
    return F.array(k, k + 1)


def crowds(met: DataFrame, real: DataFrame) -> DataFrame:
    """The classes in buckets of three and more: token, size class, rep, n."""
    crowd = met.filter("kind = 1").select("token", F.explode("others").alias("doc_id")).join(real, "doc_id")
    return crowd.select("token", F.explode(like_sizes("n")).alias("like"), "rep", "n").distinct()


def open_pairs(crowd: DataFrame, comp: DataFrame, drawn: DataFrame, nearest: bool) -> DataFrame:
    """Pairs (a, b) that share a bucket, lie in different components ca, cb and are not ruled out by size or parity bits.

    nearest: of each bucket and two components the pair whose bits differ least, and how many there are."""
    home = crowd.join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    # buckets of the same members, by two 64-bit sums of their hashes, are tried once
    same = [F.bit_xor(F.xxhash64("rep", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    open_ = home.groupBy("token", "like").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"), *same).filter("lo != hi")
    once = open_.groupBy("x1", "x2", "size", "like").agg(F.min("token").alias("token")).select("token", "like", F.expr(f"cast(ceil(size / {MEETING}) as int)").alias("blocks"))
    some = home.join(once, ["token", "like"]).withColumn("block", F.expr("cast(pmod(xxhash64(rep), blocks) as int)")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    bits = drawn.select(F.col("doc_id").alias("rep"), "bits")
    some = some.join(bits, "rep", "left").select(
        "token", "like", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "rep", "n", "component",
        F.coalesce(F.size("bits"), F.lit(0)).cast("long").alias("words"), F.coalesce("bits", F.expr("cast(array() as array<long>)")).alias("bits"),
    )
    keys = ["token", "like", "lo", "hi"]
    found = some.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_meet_batches(nearest), ", ".join(f"{c} long" for c in FOUND_PAIR))
    return found if nearest else found.select("a", "b").distinct()


def differing_bits(x: str, y: str) -> str:
    """SQL for how many parity bits of two arrays of words differ, the longer folded to the shorter."""
    narrow = lambda p, q: f"transform(sequence(1, size({q})), i -> aggregate(sequence(0, size({p}) div size({q}) - 1), 0L, (s, k) -> s ^ {p}[i - 1 + k * size({q})]))"
    left, right = (f"if(size({p}) > size({q}), {narrow(p, q)}, {p})" for p, q in ((x, y), (y, x)))
    return f"aggregate(zip_with({left}, {right}, (u, v) -> bit_count(u ^ v)), 0, (s, k) -> s + k)"


def linked(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs."""
    need(docs, "doc_id", "text")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = docs.filter("doc_id is not null")
    found = settled(named.mapInArrow(_set_batches, SETS))
    sets = found.filter("kind = 0").select("doc_id", "n", "s1", "s2")
    total = sets.agg(F.sum("n")).first()[0] or 0
    heavy = found.filter("kind = 1").groupBy(F.expr(f"shiftrightunsigned(doc_id, {64 - HEAVY_BITS})").alias("slot"), "doc_id").agg(F.sum("n").alias("n"))
    heavy = heavy.filter(F.col("n") >= HEAVY).orderBy(F.desc("n"), "doc_id").limit(HEAVY_KEPT).groupBy("slot").agg(F.max("n").alias("n")).toPandas()
    levels = np.zeros(1 << HEAVY_BITS, np.uint8)
    levels[heavy["slot"].to_numpy(np.int64)] = np.minimum(255, 1 + 4 * np.log2(heavy["n"].to_numpy(np.float64) / HEAVY)).astype(np.uint8)
    buckets = int(min(MAX_BUCKETS, max(64, total / 3 / ENTRIES)))
    entries = named.mapInArrow(_entry_batches(zlib.compress(levels.tobytes(), 1), buckets), "bucket long, base long, tokens binary, ids binary")
    met = settled(entries.groupBy("bucket").applyInArrow(join_bucket, FOUND))

    classes = sets.filter("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"))
    member = settled(sets.join(classes, ["s1", "s2", "n"], "left").select("doc_id", "n", "rep"))
    real = member.filter("rep is not null").select("doc_id", "n", "rep").distinct()

    def of_reps(pairs: DataFrame) -> DataFrame:
        """Pairs of different classes (b the smaller) whose sizes allow a link, and how often each was met."""
        a = real.select(F.col("doc_id").alias("a"), F.col("rep").alias("ra"), F.col("n").alias("na"))
        b = real.select(F.col("doc_id").alias("b"), F.col("rep").alias("rb"), F.col("n").alias("nb"))
        both = pairs.join(a, "a").join(b, "b").filter("ra != rb and 4 * least(na, nb) >= 3 * greatest(na, nb)")
        return both.groupBy(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).agg(F.sum("times").alias("times"))

    drawn = found.filter("kind = 0").groupBy("doc_id").agg(F.collect_set(F.struct("n", "bits")).alias("z")).filter("size(z) = 1")
    drawn = settled(drawn.join(real.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").select("doc_id", F.col("z")[0]["n"].alias("n"), F.col("z")[0]["bits"].alias("bits")))

    def close(pairs: DataFrame) -> DataFrame:
        """Pairs that their parity bits do not rule out: more bits differ than shingles may."""
        side = lambda c: drawn.select(F.col("doc_id").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"w{c}"))
        both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
        return both.filter(f"wa is null or wb is null or 7 * {differing_bits('wa', 'wb')} <= na + nb").select("a", "b")

    stars = met.filter("kind = 0").groupBy("a", F.col("others")[0].alias("b")).agg(F.count("*").alias("times"))
    mins = met.filter("kind = 2").select("token", "a")
    low = mins.groupBy("token").agg(F.min("a").alias("b"))
    stars = settled(of_reps(stars.unionByName(mins.join(low, "token").filter("a != b").groupBy("a", "b").agg(F.count("*").alias("times")))))
    comp, links, tried = docs.sparkSession.createDataFrame([], "node long, component long"), None, None

    def tell_apart(pairs: DataFrame) -> None:
        """Verifies the pairs that have not been tried yet and updates links and components."""
        nonlocal comp, links, tried
        pairs = settled(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        if pairs.isEmpty():
            return
        tried = pairs if tried is None else tried.unionByName(pairs)
        linking = settled(verified(named, pairs))
        if not linking.isEmpty():
            links = linking if links is None else links.unionByName(linking)
            comp = settled(components(links))

    # first each class with the center that it met most often, then the other stars that this left apart
    tell_apart(close(stars.select("a", "b")).join(stars, ["a", "b"]).groupBy("a").agg(F.max_by("b", F.struct("times", -F.col("b"))).alias("b")))
    tell_apart(close(apart(stars.select("a", "b"), comp)))
    # Stars that sizes rule out say nothing of the others. Wherever a bucket's members of like size are still apart, the nearest
    # of each two components are tried, and at last every pair of the buckets where that has left any untried.
    crowd = settled(crowds(met, real))
    near = settled(open_pairs(crowd, comp, drawn, True))
    tell_apart(near.groupBy("ca", "cb").agg(F.min(F.struct("far", "a", "b")).alias("z")).select("z.a", "z.b"))
    if tried is not None:
        left = apart(near.select("token", F.col("like").cast("int").alias("like"), "a", "b", "many"), comp)
        left = left.join(tried.withColumn("done", F.lit(True)), ["a", "b"], "left").filter("many > 1 or done is null")
        left = settled(left.select("token", "like").distinct())
        if not left.isEmpty():
            tell_apart(open_pairs(crowd.join(left, ["token", "like"], "left_semi"), comp, drawn, False))
    out = member.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"))
    nameless = docs.filter("doc_id is null").mapInArrow(_set_batches, SETS).filter("kind = 0")
    return out.unionByName(nameless.select(F.lit(None).cast("long").alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")))
