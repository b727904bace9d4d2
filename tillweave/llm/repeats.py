"""Removal of repeated byte strings: every byte inside a 200-byte string that occurs elsewhere.

The dealt method builds the Burrows-Wheeler transform and common prefixes of a document collection
column by column. A column a round is as many rounds as the longest document has bytes, so it is
applied where the answer is open: content-chosen anchors (see anchors) settle, by one exchange of
30-byte entries, extents that occur once or that occur again as a whole; what is left, the
surroundings of the edges of repeats, is gathered by anchor and decided by the column-wise
construction over strings of at most 207 bytes (see bwt). All decisions are exact up to 64-bit hash
equality of whole extents; windows that are removed on the last step have compared equal.

Equal extents are merged within a task before the exchange. An anchor met with HOT or more
different extents in one batch is dealt by extent as well, and its open windows are counted by
their hashes, merged before their exchange, instead of gathered in one group. Equal rows (doc_id
and text) of a batch go through the exchange of texts as one row with their number.

Defined results: null or empty text has 0 bytes and nothing removed; texts under 200 bytes stay;
rows that repeat (same doc_id and text) are copies of each other and go whole when of 200 bytes or
more; a null doc_id is a document like others; extra columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm import anchors as N
from tillweave.llm import arrays as A
from tillweave.llm.bwt import long_matches
from tillweave.llm.shared import need, settled, ship, text_of

ship(__name__)

WINDOW, CHUNK = N.WINDOW, 8
HOT, GROUP_BYTES, MAX_GROUPS = 256, 4 << 20, 1 << 20
#: Flags of entries: several equal extents stand behind this one; the anchor is known elsewhere; it is hot.
MANY, MARK, IS_HOT = 1, 2, 4
ENTRY = np.dtype([("anchor", "<u8"), ("extent", "<u8"), ("row", "<i8"), ("lo", "<i4"), ("at", "u1"), ("run", "u1"), ("flag", "u1")])
COVER = np.dtype([("row", "<i8"), ("lo", "<i4"), ("hi", "<i4")])
PACKED = "kind int, bucket long, entries binary"


def _packed(kind: int, bucket: np.ndarray, entry: np.ndarray) -> list[tuple[int, int, bytes]]:
    if not len(bucket):
        return []
    order = np.argsort(bucket, kind="stable")
    bucket, entry = bucket[order], entry[order]
    at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    return [(kind, int(bucket[a]), entry[a:b].tobytes()) for a, b in zip(at, np.append(at[1:], len(bucket)), strict=True)]


def _columns(rows: list[tuple[int, int, bytes]]):
    kinds = ((0, pa.int32()), (1, pa.int64()), (2, pa.binary()))
    return [pa.array([r[k] for r in rows], t) for k, t in kinds], ["kind", "bucket", "entries"]


def _covers(row: np.ndarray, lo: np.ndarray, hi: np.ndarray, groups: int) -> list[tuple[int, int, bytes]]:
    """Bytes lo to hi of rows, for the rows' groups, overlapping ones of a row merged."""
    order = np.lexsort((hi, lo, row))
    row, lo, hi = row[order], lo[order].astype(np.int64), hi[order].astype(np.int64)
    if not len(row):
        return []
    change = np.concatenate(([True], row[1:] != row[:-1]))
    part = np.cumsum(change) - 1
    top = np.maximum.accumulate(hi + part * (1 << 32)) - part * (1 << 32)
    new = np.flatnonzero(change | np.concatenate(([True], lo[1:] > top[:-1])))
    c = np.empty(len(new), COVER)
    c["row"], c["lo"], c["hi"] = row[new], lo[new], top[np.append(new[1:], len(row)) - 1]
    return _packed(0, c["row"] % groups, c)


def _classes(e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """e sorted by anchor and extent: class of every entry, entries of each class, first of each."""
    new = np.concatenate(([True], (e["anchor"][1:] != e["anchor"][:-1]) | (e["extent"][1:] != e["extent"][:-1])))
    of = np.cumsum(new) - 1
    return of, np.bincount(of), np.flatnonzero(new)


def _emit(groups: int, hot: int):
    def run(batches):
        for batch in batches:
            rows = batch.column("row").to_numpy(zero_copy_only=False)
            made = []
            for i, _j, buf, offs in A.chunks(batch.column("text")):
                h, row, at, lo, hi = N.runs(buf, offs)
                e = np.empty(len(h), ENTRY)
                e["anchor"], e["row"], e["lo"] = h, rows[i + row], lo - offs[row]
                e["at"], e["run"], e["flag"] = at - lo, hi - lo, 0
                e["extent"] = A.segment_hashes(buf, lo, hi + WINDOW) ^ A.mix(e["at"].astype(np.uint64))
                made.append(e)
            if not made:
                continue
            e = np.concatenate(made)
            if not len(e):
                continue
            e = e[np.lexsort((e["extent"], e["anchor"]))]
            of, count, first = _classes(e)
            again = count[of] > 1
            out = _covers(e["row"][again], e["lo"][again], e["lo"][again].astype(np.int64) + e["run"][again] + WINDOW, groups)
            out = [(k, b + groups, c) for k, b, c in out]  # these take groups of their own through the exchange
            e = e[first]
            e["flag"] = np.where(count > 1, MANY, 0)
            head = np.concatenate(([True], e["anchor"][1:] != e["anchor"][:-1]))
            each = np.bincount(np.cumsum(head) - 1)
            many = (each >= hot)[np.cumsum(head) - 1]
            mark = e[head & many]
            mark["flag"] = MARK
            e["flag"][many] |= IS_HOT
            salt = np.where(many, A.mix(e["extent"]) % np.uint64(64) + np.uint64(1), 0).astype(np.uint64)
            whole = np.concatenate((e, mark))
            bucket = A.mix(whole["anchor"] ^ np.concatenate((salt, np.zeros(len(mark), np.uint64)))) % np.uint64(groups)
            out += _packed(1, bucket.astype(np.int64), whole)
            yield pa.RecordBatch.from_arrays(*_columns(out))

    return run


def _settle(groups: int, hot_classes: int):
    def run(table):
        """Covers of extents found again; entries that stay open, for their rows' groups."""
        if table.column("kind")[0].as_py() == 0:
            return pa.table([table.column("kind"), pc.subtract(table.column("bucket"), groups), table.column("entries")], names=table.column_names)
        e = np.frombuffer(b"".join(table.column("entries").to_pylist()), ENTRY)
        e = e[np.lexsort((e["flag"] & MARK, e["extent"], e["anchor"]))]
        mark = (e["flag"] & MARK) > 0
        known = np.unique(e["anchor"][mark])
        e = e[~mark].copy()
        if not len(e):
            return pa.table(*_columns([]))
        of, count, first = _classes(e)
        many = np.bitwise_or.reduceat(e["flag"], first)
        sure = (count > 1) | ((many & MANY) > 0)
        again = sure[of] & ((e["flag"] & MANY) == 0)  # those with MANY were covered where they were merged
        again |= (count[of] > 1) & ((e["flag"] & MANY) > 0)
        end = e["lo"].astype(np.int64) + e["run"] + WINDOW
        out = _covers(e["row"][again], e["lo"][again], end[again], groups)
        one = e[first]
        one["flag"] = np.where(sure, MANY, 0)
        head = np.concatenate(([True], one["anchor"][1:] != one["anchor"][:-1]))
        part = np.cumsum(head) - 1
        each = np.bincount(part)[part]
        single = np.bincount(part, ~sure)[part]
        elsewhere = np.isin(one["anchor"], known) | ((many & IS_HOT) > 0)
        one["flag"] |= np.where(elsewhere | (each > hot_classes), IS_HOT, 0).astype(np.uint8)
        stay = one[((each > 1) & (single > 0)) | elsewhere]
        return pa.table(*_columns(out + _packed(1, stay["row"] % groups, stay)))

    return run


OPEN = "kind int, bucket long, entries binary, anchor long, row long, lo int, at int, many int, text binary"


def _open_texts(groups: int):
    def run(docs, marks):
        """kind 1: the open extents' bytes, by anchor; kind 2: hashes of hot anchors' windows; kind 0: covers."""
        e = np.frombuffer(b"".join(marks.column("entries").to_pylist()), ENTRY)
        e = e[np.argsort(e["row"], kind="stable")]
        rows = docs.column("row").to_numpy()
        once = np.zeros(len(rows), bool)
        once[np.unique(rows, return_index=True)[1]] = True
        out, hashes, where = [], [], []
        for i, j, buf, offs in A.chunks(docs.column("text")):
            for r in range(i, j):
                a, b = np.searchsorted(e["row"], rows[r], "left"), np.searchsorted(e["row"], rows[r], "right")
                if a == b or not once[r]:
                    continue
                mine, base = e[a:b], offs[r - i]
                for x in mine[(mine["flag"] & IS_HOT) == 0]:
                    lo = int(x["lo"])
                    data = buf[base + lo : base + lo + int(x["run"]) + WINDOW].tobytes()
                    out.append((1, int(x["anchor"].view("<i8")) % groups, None, int(x["anchor"].view("<i8")), int(x["row"]), lo, int(x["at"]), int(x["flag"] & MANY), data))
                x = mine[(mine["flag"] & IS_HOT) > 0]
                if len(x):
                    n = x["run"].astype(np.int64) + 1
                    s = np.repeat(x["lo"].astype(np.int64) - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                    p = offs[r - i + 1]
                    hashes.append(A.segment_hashes(buf[base:p], s, s + WINDOW))
                    w = np.empty(len(s), COVER)
                    w["row"], w["lo"], w["hi"] = rows[r], s, np.repeat((x["flag"] & MANY).astype(np.int32), n)
                    where.append(w)
        if hashes:
            h, w = np.concatenate(hashes), np.concatenate(where)
            got, keep = _window_counts(h, w, groups)
            both = np.empty(keep.sum(), np.dtype([("h", "<u8"), ("w", COVER)]))
            both["h"], both["w"] = h[keep], w[keep]
            out += [(0, b + 2 * groups, c, None, None, None, None, None, None) for _, b, c in got]
            out += [(2, b + groups, c, None, None, None, None, None, None) for _, b, c in _packed(2, (both["h"] % np.uint64(groups)).astype(np.int64), both)]
        types = [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        names = [c.split()[0] for c in OPEN.split(", ")]
        return pa.table({n: pa.array([x[k] for x in out], t) for k, (n, t) in enumerate(zip(names, types, strict=True))})

    return run


def _window_counts(h: np.ndarray, w: np.ndarray, groups: int):
    """Covers of windows found twice (or standing for many), and one entry of each hash to pass on.

    Sorts nothing in place; the entry passed on says by hi = 1 that it stands for many."""
    order = np.argsort(h, kind="stable")
    new = np.concatenate(([True], h[order][1:] != h[order][:-1]))
    of = np.cumsum(new) - 1
    total = np.bincount(of) > 1
    total |= np.bincount(of, w["hi"][order]) > 0
    again = order[total[of]]
    covers = _covers(w["row"][again], w["lo"][again], w["lo"][again].astype(np.int64) + WINDOW, groups)
    keep = np.zeros(len(h), bool)
    first = order[new]
    keep[first] = True
    w["hi"][first] = total
    return covers, keep


def decide(anchor, row, lo, at, many, text: list[bytes], least: int = WINDOW):
    """Covers (row, lo, hi) of repeated windows among extents that share anchors.

    Extents are cut into sub-extents of CHUNK windows, placed by the anchor; those whose common core
    occurs once are unique, those equal as a whole repeat, the others go through the construction."""
    buf = np.frombuffer(b"".join(text), np.uint8)
    size = np.array([len(t) for t in text], np.int64)
    base = np.concatenate(([0], np.cumsum(size)[:-1]))
    shift = N.WINDOW - N.GRAM - at  # a window start s lies in chunk (s + shift) // CHUNK
    windows = size - least + 1
    c0, c1 = shift // CHUNK, (windows - 1 + shift) // CHUNK
    n = c1 - c0 + 1
    who = np.repeat(np.arange(len(size)), n)
    chunk = np.arange(n.sum()) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n) + c0[who]
    origin = chunk * CHUNK - shift[who]
    s, e = np.maximum(origin, 0), np.minimum(origin + CHUNK - 1, windows[who] - 1)
    core = A.segment_hashes(buf, base[who] + origin + CHUNK - 1, base[who] + origin + least)
    key = A.mix(core ^ A.mix(anchor[who].view(np.uint64) + chunk.astype(np.uint64)))
    whole = A.mix(A.segment_hashes(buf, base[who] + s, base[who] + e + least) ^ key ^ (s - origin).astype(np.uint64))
    order = np.lexsort((whole, key))
    key, whole, who, s, e = key[order], whole[order], who[order], s[order], e[order]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])))
    of, first = np.cumsum(new) - 1, np.flatnonzero(new)
    sure = (np.bincount(of) > 1) | (np.bincount(of, many[who]) > 0)
    head = np.concatenate(([True], key[first][1:] != key[first][:-1]))
    part = np.cumsum(head) - 1
    rest = (np.bincount(part)[part] > 1) & (np.bincount(part, ~sure)[part] > 0)
    x = first[rest]
    string, offset, match = long_matches(buf, base[who[x]] + s[x], e[x] - s[x] + least, least)
    hit = match & ~sure[of[x]][string]
    a = np.flatnonzero(sure[of] & (many[who] == 0))
    r = np.concatenate((row[who[a]], row[who[x[string[hit]]]]))
    start = np.concatenate((lo[who[a]] + s[a], lo[who[x[string[hit]]]] + s[x[string[hit]]] + offset[hit]))
    end = np.concatenate((lo[who[a]] + e[a] + least, start[len(a) :] + least))
    return r, start, end


def _decide_group(groups: int):
    def run(table):
        """Covers of a group of open extents, or of hashed windows; covers pass."""
        kind = table.column("kind")[0].as_py()
        if kind == 0:
            return pa.table([table.column("kind"), pc.subtract(table.column("bucket"), 2 * groups), table.column("entries")], names=["kind", "bucket", "entries"])
        if kind == 2:
            both = np.frombuffer(b"".join(table.column("entries").to_pylist()), np.dtype([("h", "<u8"), ("w", COVER)]))
            return pa.table(*_columns(_window_counts(both["h"], both["w"].copy(), groups)[0]))
        col = {c: table.column(c).to_numpy().astype(np.int64) for c in ("anchor", "row", "lo", "at", "many")}
        r, lo, hi = decide(col["anchor"], col["row"], col["lo"], col["at"], col["many"], table.column("text").to_pylist())
        return pa.table(*_columns(_covers(r, lo, hi, groups)))

    return run


DONE = "copies int, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,stop:int>>"


def _finish(docs, marks):
    """Removed runs and the digest of what is left, for every row of a group."""
    c = np.frombuffer(b"".join(marks.column("entries").to_pylist()), COVER)
    c = c[np.argsort(c["row"], kind="stable")]
    rows, out = docs.column("row").to_numpy(), []
    ids, copies = docs.column("doc_id").to_pylist(), docs.column("copies").to_pylist()
    for i, j, buf, offs in A.chunks(docs.column("text")):
        for r in range(i, j):
            a, b = np.searchsorted(c["row"], rows[r], "left"), np.searchsorted(c["row"], rows[r], "right")
            data = buf[offs[r - i] : offs[r - i + 1]]
            if a == b:
                out.append((copies[r], ids[r], len(data), 0, 0, hashlib.sha256(data.tobytes()).hexdigest(), []))
                continue
            step = np.zeros(len(data) + 1, np.int32)
            np.add.at(step, c["lo"][a:b], 1)
            np.add.at(step, c["hi"][a:b], -1)
            gone = np.concatenate(([0], np.cumsum(step[:-1]) > 0, [0])).astype(np.int8)
            edge = np.diff(gone)
            start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            kept = data[gone[1:-1] == 0].tobytes()
            spans = [{"start": x, "stop": y} for x, y in zip(start.tolist(), stop.tolist(), strict=True)]
            out.append((copies[r], ids[r], len(data), len(data) - len(kept), len(start), hashlib.sha256(kept).hexdigest(), spans))
    types = [pa.int32()] + [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))]
    names = ["copies", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    return pa.table({n: pa.array([x[k] for x in out], t) for k, (n, t) in enumerate(zip(names, types, strict=True))})


def _merge_copies(batches):
    """Equal rows of a batch as one row with their number, so that no group holds all copies of a row."""
    for batch in batches:
        row = batch.column("row").to_numpy()
        _, first, count = np.unique(row, return_index=True, return_counts=True)
        if not len(row):
            continue
        one = pa.Table.from_batches([batch]).take(pa.array(first))
        one = one.append_column("copies", pa.array(count.astype(np.int32))).select(["doc_id", "row", "bucket", "copies", "text"])
        yield from one.combine_chunks().to_batches()


def removed(docs: DataFrame, hot: int = HOT, hot_classes: int = 20_000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans of every row."""
    need(docs, "doc_id", "text")
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    groups = int(min(MAX_GROUPS, max(16, total // GROUP_BYTES)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row")).withColumn("bucket", F.pmod("row", F.lit(groups)))
    found = rows.select("row", "text").mapInArrow(_emit(groups, hot), PACKED)
    later = settled(found.groupBy("bucket").applyInArrow(_settle(groups, hot_classes), PACKED))
    merged = rows.mapInArrow(_merge_copies, "doc_id long, row long, bucket long, copies int, text string")
    dealt = merged.groupBy("bucket")  # its exchange is used by both cogroups
    opened = later.filter("kind = 1").select("bucket", "entries")
    texts = dealt.cogroup(opened.groupBy("bucket")).applyInArrow(_open_texts(groups), OPEN)
    last = texts.groupBy("bucket").applyInArrow(_decide_group(groups), PACKED)
    covers = later.filter("kind = 0").select("bucket", "entries").unionByName(last.select("bucket", "entries"))
    done = dealt.cogroup(covers.groupBy("bucket")).applyInArrow(_finish, DONE)
    return done.withColumn("copies", F.explode(F.expr("array_repeat(1, copies)"))).drop("copies")
