"""Packing token sequences: first-fit decreasing over a tournament tree, in randomised groups.

Documents are tokenised in Arrow batches: texts are cut where white space follows anything else
(always a boundary of the byte-level pattern), distinct cuts are encoded once by the tokenizers
library and their ids gathered. Documents are dealt into groups by a seeded hash; each group is
packed on its own. Whole sequences come off a document's front; remainders are placed first-fit
decreasing, the tree of free room giving the first bin that fits in logarithmic time. What room is
left is then filled by cutting pieces of the emptiest bins, and the last bin becomes sequences
of power-of-two lengths, which need no padding.

Defined results: null or empty text is the end id alone; a null doc_id is packed like any other;
rows that repeat are packed each; very long texts fill whole sequences; extra columns are left out.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm import arrays as A
from tillweave.llm.shared import kept, need, ship, text_of

ship(__name__)

ROOM, END_ID, SEED = 2048, 1, 29
#: Text bytes that a group has on average, a row counting ROW_BYTES of its own; sets the number of groups from the corpus' size.
GROUP_BYTES, ROW_BYTES = 2 << 20, 64
#: Distinct cuts, and ids of these, that a worker remembers before it starts afresh.
KNOWN, POOL = 1_200_000, 10_000_000


def unit_starts(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Row starts, and ASCII white space right after a byte that surely isn't white space."""
    one, two = np.zeros(len(buf), np.uint8), np.zeros(len(buf), np.uint8)
    one[1:], two[2:] = buf[:-1], buf[:-2]
    wide = (one >= 0x80) & (((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | (two == 0x80) | (two == 0x81) | (two == 0x9A))
    cut = A.BLANK[buf] & (one > 32) & ~wide
    cut[offs[:-1][np.diff(offs) > 0]] = True
    return np.flatnonzero(cut)


class Cuts:
    """Ids of distinct cuts in one pool; sorted hashes and places find them."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.clear()

    def clear(self) -> None:
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.bounds, self.pool, self.used = np.zeros(1 << 16, np.int32), np.zeros(1 << 18, self.kind), 0

    def _grown(self, x: np.ndarray, n: int) -> np.ndarray:
        return x if n <= len(x) else np.concatenate((x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)))

    def learn(self, texts: list[str]) -> None:
        """Encode texts; their numbers follow those of the cuts known before."""
        known = len(self.keys)
        for i in range(0, len(texts), 20_000):
            got = [x.ids for x in self.tokenizer.encode_batch_fast(texts[i : i + 20_000], add_special_tokens=False)]
            n, k = known + i, len(got)
            sizes = np.fromiter(map(len, got), np.int64, k)
            flat = np.fromiter((t for ids in got for t in ids), self.kind, int(sizes.sum()))
            self.bounds = self._grown(self.bounds, n + k + 1)
            self.pool = self._grown(self.pool, self.used + len(flat))
            self.pool[self.used : self.used + len(flat)] = flat
            self.bounds[n + 1 : n + k + 1] = self.used + np.cumsum(sizes)  # a cut's ids end where the next one's begin
            self.used += len(flat)

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each row's begin."""
        s = unit_starts(buf, offs)
        e = np.append(s[1:], len(buf))
        h = A.segment_hashes(buf, s, e)
        keys, first, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > KNOWN or self.used > POOL:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        new = np.flatnonzero((at == len(self.keys)) | (np.append(self.keys, keys[:1])[at] != keys))
        if len(new):
            raw, known = buf.tobytes(), len(self.keys)
            self.learn([raw[s[i] : e[i]].decode() for i in first[new].tolist()])
            self.keys = np.insert(self.keys, at[new], keys[new])
            self.place = np.insert(self.place, at[new], np.arange(known, known + len(new), dtype=np.int32))
        unit = self.place[np.searchsorted(self.keys, keys)][back]
        start = self.bounds[unit].astype(np.int64)
        size = self.bounds[unit + 1] - start
        total = np.concatenate(([0], np.cumsum(size)))
        ids = self.pool[np.repeat(start - total[:-1], size) + np.arange(total[-1])]
        return ids, total[np.searchsorted(s, offs)]


def cuts(spec: str) -> Cuts:
    """One per worker process and vocabulary, kept between tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    name = f"cuts{zlib.crc32(spec.encode())}"
    if name not in kept():
        kept()[name] = Cuts(spec)
    return kept()[name]


def repeats(batch, i: int, j: int) -> np.ndarray:
    """For rows i to j, how many equal rows (doc_id and tie) stand before each among them: copies are dealt to several groups."""
    seen: dict = {}
    out = np.zeros(j - i, np.int64)
    for r, key in enumerate(zip(batch.column("doc_id").slice(i, j - i).to_pylist(), batch.column("tie").slice(i, j - i).to_pylist(), strict=True)):
        out[r] = seen[key] = seen.get(key, -1) + 1
    return out


def tokeniser(spec: str):
    def run(batches):
        known = cuts(spec)
        for batch in batches:
            for i, j, buf, offs in A.chunks(batch.column("text")):
                ids, ptr = known.encode(buf, offs)
                narrow = ids.astype("<u2") if known.tokenizer.get_vocab_size() <= 1 << 16 else ids.astype("<u4")
                end = np.array([END_ID], narrow.dtype).tobytes()
                number = repeats(batch, i, j)
                made = [narrow[ptr[r] : ptr[r + 1]].tobytes() + end for r in range(j - i)]
                rest = [batch.column(k).slice(i, j - i) for k in range(batch.num_columns) if batch.schema.names[k] != "text"]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(number), pa.array(made, pa.binary())], [*(n for n in batch.schema.names if n != "text"), "number", "ids"])

    return run


class Rooms:
    """Tournament tree of the free room of bins; unopened bins have all of it."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(bins - 1, 0).bit_length()
        self.best = [room] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Take size from the first bin that has it."""
        k, best = 1, self.best
        while k < self.leaves:
            k = 2 * k if best[2 * k] >= size else 2 * k + 1
        best[k] -= size
        bin_, k = k - self.leaves, k // 2
        while k:
            top = max(best[2 * k], best[2 * k + 1])
            if best[k] == top:
                break
            best[k], k = top, k // 2
        return bin_


def pack(sizes: list[int], room: int = ROOM) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of pieces (document, start, length); every id lies in one piece."""
    whole = [[(d, k * room, room)] for d, n in enumerate(sizes) for k in range(n // room)]
    rest = sorted((-(n % room), d) for d, n in enumerate(sizes) if n % room)
    rooms, bins = Rooms(max(len(rest), 1), room), [[] for _ in rest]
    for n, d in rest:
        bins[rooms.place(-n)].append((d, sizes[d] + n, -n))
    fill = {i: sum(p[2] for p in b) for i, b in enumerate(bins) if b}
    part = sorted((i for i in fill if fill[i] < room), key=lambda i: (-fill[i], i))
    a, z = 0, len(part) - 1
    while a < z:
        into, off = part[a], part[z]
        d, start, n = bins[off].pop()
        take = min(n, room - fill[into])
        bins[into].append((d, start, take))
        if take < n:
            bins[off].append((d, start + take, n - take))
        fill[into] += take
        fill[off] -= take
        a += fill[into] == room
        z -= not bins[off]
    out = whole + [b for i, b in enumerate(bins) if b and fill[i] == room]
    for i in (i for i, b in enumerate(bins) if b and fill[i] < room):
        left, pieces = fill[i], bins[i][::-1]
        while left:
            goal = 1 << (left.bit_length() - 1)
            left -= goal
            seq = []
            while goal:
                d, start, n = pieces.pop()
                take = min(n, goal)
                seq.append((d, start, take))
                if take < n:
                    pieces.append((d, start + take, n - take))
                goal -= take
            out.append(seq)
    return out


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_group(key, group):
    group = group.sort_by([("doc_id", "ascending"), ("tie", "ascending")])
    docs = group.column("doc_id").to_pylist()
    blobs = group.column("ids").to_pylist()
    width = np.dtype("<u2" if key[1].as_py() == 2 else "<u4")
    ids = [np.frombuffer(b, width).astype("<u4") for b in blobs]
    rows = []
    for q, seq in enumerate(pack([len(x) for x in ids])):
        at = 0
        for d, start, n in seq:
            rows.append((docs[d], start, n, zlib.crc32(ids[d][start : start + n].tobytes()), len(ids[d]), (key[0].as_py() << 32) + q, at))
            at += n
    names = [c.split()[0] for c in PIECES.split(", ")]
    return pa.table({n: pa.array([r[k] for r in rows], pa.int64()) for k, n in enumerate(names)})


def packed(docs: DataFrame, vocabulary: str, seed: int = SEED) -> DataFrame:
    """A row per piece of every document; vocabulary is the path of a tokenizers file on the driver."""
    need(docs, "doc_id", "text")
    with open(vocabulary, encoding="utf-8") as file:
        spec = file.read()
    from tokenizers import Tokenizer

    width = 2 if Tokenizer.from_str(spec).get_vocab_size() <= 1 << 16 else 4
    total = docs.agg(F.sum(F.octet_length(text_of()).cast("long") + ROW_BYTES)).first()[0] or 0
    groups = max(1, -(-total // GROUP_BYTES))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("tie", F.xxhash64(F.lit(seed), "text"))
    ids = rows.mapInArrow(tokeniser(spec), "doc_id long, tie long, number long, ids binary")
    group = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "tie", "number"), F.lit(groups))
    return ids.withColumns({"group": group, "width": F.lit(width)}).groupBy("group", "width").applyInArrow(pack_group, PIECES)
