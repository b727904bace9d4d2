"""The training-data operators against brute force, on hand-made and small generated tables."""

import hashlib
import itertools
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillweave.llm import chat, components, fingerprints, jaccard, line_crf, line_dedup, mixing, packing, quality_rules, repeats, warc
from tillweave.llm.bwt import long_matches

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, pos int, n_dropped string"


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def corpus(n=60, seed=3):
    """Rows with nulls, empties, copies, near copies, shared lines and passages, long texts, repeated rows."""
    rng = random.Random(seed)
    vocab = ["alpha", "Beta", "gamma!", "été", "delta", "x", "Über", "omega|", "a b", "ñandú", "zeta", "##"]
    para = lambda k: " ".join(rng.choice(vocab) + str(rng.randrange(40)) for _ in range(k))
    shared, passage = "  A line that MANY documents Share\t", para(60)
    rows = []
    for i in range(n):
        lines = [para(rng.randrange(3, 60)) for _ in range(rng.randrange(1, 5))]
        if i % 3 == 0:
            lines.insert(1, shared if i % 2 else shared.strip().upper())
        if i % 5 == 0:
            lines.append(passage)
        rows.append([i, "\n".join(lines), "en", f"s{i % 3}" if i % 7 else None])
    rows[4][1], rows[5][1], rows[6][1] = None, "", "\n\n"
    rows[10][1] = rows[9][1]
    rows[11][1] = rows[9][1].replace(" ", "  ", 3)
    rows[12][1] = rows[9][1] + " extra tail words"
    rows[20][1] = "one two"
    rows[21][1] = "ONE\ttwo"
    rows[30][1] = "\n".join(para(200) for _ in range(40))
    rows[31][1] = rows[30][1][:20000] + " changed " + rows[30][1][20000:]
    rows.append(list(rows[9]))
    return [(*r, 1, "mine") for r in rows]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def keyed(rows, values):
    return sorted((r[0], *v) for r, v in zip(rows, values, strict=True))


# ---- 1
def brute_lines(rows, least=10):
    first = {}
    key = lambda x: lower(x.strip(" \t\n\x0b\f\r"))
    for r in rows:
        for x in (r[1] or "").split("\n"):
            if len(key(x)) >= least:
                first[key(x)] = min(first.get(key(x), r[0]), r[0])
    out = []
    for r in rows:
        ls = (r[1] or "").split("\n")
        kept = [x for x in ls if first.get(key(x), r[0]) == r[0]]
        out.append((len(ls), len(ls) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("hot", [2000, 0])
def test_line_dedup(spark, rows, docs, empty, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT_ROWS", hot)
    out = line_dedup.dedup_lines(docs)
    assert set(docs.columns) <= set(out.columns)
    got = sorted((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in out.collect())
    assert got == keyed(rows, brute_lines(rows))
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_null_ids_keep_all(spark):
    d = spark.createDataFrame([(None, "same line here"), (1, "same line here"), (2, "same line here")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_dropped) for r in line_dedup.dedup_lines(d).collect()) == [(0, 0), (1, 0), (2, 1)]


# ---- 2
def brute_groups(rows):
    sets = defaultdict(list)
    for r in rows:
        w = lower(r[1] or "").encode().split()
        w = [x.decode() for x in w]
        sets[r[0]].append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = sorted((top(a), top(b)))
                up[q] = p
    return [(len(s), top(r[0])) for r in rows for s in [_set(r[1])]]


def _set(text):
    w = [x for x in lower(text or "").encode().split()]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_jaccard(spark, rows, docs, empty):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.linked(docs).collect())
    assert got == keyed(rows, brute_groups(rows))
    assert jaccard.linked(empty).count() == 0


def test_jaccard_chains_and_grades(spark):
    rng, base = random.Random(5), [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(0, 16)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(words[: rng.randrange(250, 400)])))
    for i in range(60, 90):
        rows.append((i, " ".join(f"q{rng.randrange(50)}" for _ in range(rng.randrange(1, 12)))))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.linked(d).collect())
    assert got == keyed(rows, brute_groups(rows))


def test_jaccard_salted_buckets(spark, rows, docs, monkeypatch):
    monkeypatch.setattr(jaccard, "HEAVY", 3)
    got = sorted((r.doc_id, r.component_id) for r in jaccard.linked(docs).collect())
    assert got == sorted((r[0], v[1]) for r, v in zip(rows, brute_groups(rows), strict=True))


@pytest.mark.parametrize("heavy", [24, 3])
def test_jaccard_excerpts(spark, monkeypatch, heavy):
    """The smallest id of a bucket is too long for the others, which link with each other."""
    monkeypatch.setattr(jaccard, "HEAVY", heavy)
    data = []
    for seed in range(60):
        rng = random.Random(seed)
        words = [f"w{seed}x{rng.randrange(10**6)}" for _ in range(66)]
        part, changed = words[:48], 4 + seed % 3
        near = part[:-changed] + [f"n{seed}x{rng.randrange(10**6)}" for _ in range(changed)]
        data += [(3 * seed, " ".join(words)), (3 * seed + 1, " ".join(part)), (3 * seed + 2, " ".join(near))]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.linked(spark.createDataFrame(data, "doc_id long, text string")).collect())
    assert [x[2] for x in got] == [3 * s + min(k, 1) for s in range(60) for k in range(3)]
    assert got == keyed(data, brute_groups(data))


@pytest.mark.parametrize("meeting", [512, 2])
def test_jaccard_bands(spark, monkeypatch, meeting):
    """Every band of sizes and both widths of bits: a container, parts of it that link with each other, and grades, ids in every order."""
    monkeypatch.setattr(jaccard, "MEETING", meeting)
    monkeypatch.setattr(jaccard, "HELD_PAIRS", 64 if meeting == 2 else 1 << 18)
    rng, texts = random.Random(meeting), []
    for k, size in enumerate([12, 30, 60, 64, 90, 255, 300, 700, 1100, 1500, 2500, 6000] * 2):
        word = lambda: f"w{rng.randrange(10**7)}"  # noqa: E731, B023
        base = [word() for _ in range(size + 4)]
        part = base[: size * 2 // 3 + 4]
        group = [base, part]
        for grade in (0.05, 0.1, 0.13, 0.16):
            cut = max(1, int(len(part) * grade))
            group.append(part[:-cut] + [word() for _ in range(cut)])
            group.append([word() for _ in range(cut)] + part[cut:])
        group.append(base[size // 4 :])
        rng.shuffle(group)
        texts += [" ".join(g) for g in (group[:4] if size == 6000 and k > 12 else group)]
    rng.shuffle(texts)
    data = list(enumerate(texts))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.linked(spark.createDataFrame(data, "doc_id long, text string").repartition(5)).collect())
    assert got == keyed(data, brute_groups(data))


def test_parity_bits_fold():
    rng = np.random.default_rng(3)
    sets = [np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (3, 1440, 1441, 6000)]
    ptr = np.concatenate(([0], np.cumsum([len(x) for x in sets])))
    words, each = jaccard.parity_bits(ptr, np.concatenate(sets))
    assert each.tolist() == [16, 16, 64, 256]
    rows = jaccard.folded(words.view(np.uint64), np.cumsum(each) - each, each, 16)
    for k, x in enumerate(sets):
        one, _ = jaccard.parity_bits(np.array([0, len(x) % 1440]), x[: len(x) % 1440])
        two, _ = jaccard.parity_bits(np.array([0, len(x) - len(x) % 1440]), x[len(x) % 1440 :])
        whole = jaccard.folded(one.view(np.uint64), np.array([0]), np.array([len(one)]), 16) ^ jaccard.folded(two.view(np.uint64), np.array([0]), np.array([len(two)]), 16)
        assert (rows[k] == whole[0]).all()


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (200, 150), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 150: 100, 200: 100}


# ---- 3
def brute_rules(text):
    w = WORD.findall(text or "")
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    mark = set()
    for i in range(len(w) - 2):
        if grams[tuple(w[i : i + 3])] > 1:
            mark |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for x in (text or "").split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    failed = len(w) < 50 or 100 * len(mark) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(mark), failed


def test_character_trigrams_are_of_code_points():
    texts = ["añb€c", "", "añ", "a😀bc"]
    data = [t.encode() for t in texts]
    slot, row = quality_rules.character_trigrams(np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in data]))))
    want = [(k, t[i : i + 3]) for k, t in enumerate(texts) for i in range(len(t) - 2)]
    assert row.tolist() == [k for k, _ in want]
    one = {}
    for s, (_, t) in zip(slot.tolist(), want, strict=True):
        assert one.setdefault(t, s) == s
    assert len(set(one.values())) == len(one) and slot.min() >= 0 and slot.max() < 1 << quality_rules.CHAR_BITS


def labels_for(spark, rows):
    return spark.createDataFrame([(r[0], 0 if i % 6 == 0 else 1, 0) for i, r in enumerate(rows)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")


def test_quality_rules(spark, rows, docs, empty):
    model = quality_rules.train(docs, labels_for(spark, rows))
    got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.quality(docs, model).collect())
    assert got == keyed(rows, [brute_rules(r[1]) for r in rows])
    assert quality_rules.quality(docs, model).filter("base_failed and kept").count() == 0
    assert quality_rules.quality(empty, model).count() == 0


def test_quality_rules_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = quality_rules.quality(docs, quality_rules.train(docs, none))
    assert out.filter("not base_failed and not kept").count() == 0


@pytest.mark.parametrize("which", ["rules", "crf"])
def test_held_out_accuracy(spark, which):
    """On rows that never train, junk and clean texts are told apart."""
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    held = labels.filter("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2")
    if which == "rules":
        out = quality_rules.quality(docs, quality_rules.train(docs, labels)).filter("not base_failed").select("doc_id", "kept")
    else:
        out = line_crf.scores(docs, line_crf.train(docs, labels)).select("doc_id", (F.col("score") >= line_crf.ACCEPT).alias("kept"))
    both = out.join(held, "doc_id")
    assert both.filter("kept = (quality = 1)").count() >= 0.95 * both.count()


# ---- 4
def test_warc_round_trip(spark):
    big = "é<p>€ text</p>\r\n\r\n" * 3000
    pages = [(1, "http://a\r\nX: y", big, "x"), (2, None, None, "x"), (3, "http://b", "short", "x"), (4, "http://c", big, "x"), (5, "u", "k" * 1000, "x"), (6, "u", "k" * 1000, "x"), (7, "u", "k" * 999, "x"), (8, "u", "k" * 999, "x"), (None, "u", big, "x")]
    got = {r.page_id: tuple(r)[1:] for r in warc.round_trip(spark.createDataFrame(pages, "page_id long, url string, html string, kind string")).collect()}
    for page, _, html, _ in pages:
        data = (html or "").encode()
        same = [p for p, _, h, _ in pages if p is not None and (h or "") == (html or "")]
        keeper = max(same) if len(data) >= 1000 else page
        assert got[page] == (len(data), hashlib.sha1(data).hexdigest(), "response" if page == keeper else "revisit", None if page == keeper else keeper)
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_damage_is_found(spark):
    rows = [("response", "<a>", "<a>", 1, None, 1, None, "d", b"abc"), ("continuation", "<a:3>", "<a>", 3, 9, None, None, "", b"ghi")]
    with pytest.raises(Exception, match="segments missing"):
        warc.reassemble(spark.createDataFrame(rows, warc.RECORD)).collect()
    assert warc.unchunked(warc.chunked("aé".encode() * 5000)) == "aé".encode() * 5000


# ---- 5
def test_column_wise_construction():
    rng = np.random.default_rng(1)
    for _ in range(20):
        texts = [bytes(rng.integers(97, 99, rng.integers(1, 14)).astype(np.uint8)) for _ in range(30)]
        buf, size = np.frombuffer(b"".join(texts), np.uint8), np.array([len(x) for x in texts])
        a, b, m = long_matches(buf, np.concatenate(([0], np.cumsum(size)[:-1])), size, 5)
        count = Counter(x[k : k + 5] for x in texts for k in range(len(x) - 4))
        assert sorted(zip(a, b, strict=True)) == sorted((i, k) for i, x in enumerate(texts) for k in range(len(x) - 4))
        assert all((count[texts[i][o : o + 5]] > 1) == q for i, o, q in zip(a, b, m, strict=True))


def brute_repeats(rows):
    data = [(r[1] or "").encode() for r in rows]
    seen = Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [(256, 20_000), (2, 20_000), (256, 1)])
def test_repeats(spark, empty, hot):
    rows = corpus(40, 8)[:-1]
    rows += [(100, "periodic " * 100, "", "", 1, ""), (101, "z" * 199, "", "", 1, ""), (102, "z" * 199, "", "", 1, ""), (103, "y" * 201, "", "", 1, ""), (None, "q" * 150 + "r" * 100, "", "", 1, ""), (9, rows[9][1], "", "", 1, "")]
    out = repeats.removed(spark.createDataFrame(rows, SCHEMA), *hot)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect())
    assert got == sorted((r[0] if r[0] is not None else -1, *v) for r, v in zip(rows, brute_repeats(rows), strict=True))
    assert repeats.removed(empty).count() == 0


def test_repeats_of_many_equal_rows(spark):
    rows = [(1, "copy " * 60)] * 300 + [(2, "copy " * 60), (3, "x" * 150)] + [(4, "short")] * 50
    got = Counter((r.doc_id, r.n_bytes, r.n_removed) for r in repeats.removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    assert got == {(1, 300, 300): 300, (2, 300, 300): 1, (3, 150, 0): 1, (4, 5, 0): 50}


def test_construction_beyond_memory(monkeypatch):
    from tillweave.llm import bwt

    buf = np.frombuffer(b"abracadabra" * 3, np.uint8)
    whole = long_matches(buf, np.array([0, 11, 22]), np.array([11, 11, 9]), 4)
    monkeypatch.setattr(bwt, "IN_MEMORY", 1)
    assert all((a == b).all() for a, b in zip(whole, long_matches(buf, np.array([0, 11, 22]), np.array([11, 11, 9]), 4), strict=True))


# ---- 6
def test_pack_covers_everything_once():
    rng = random.Random(2)
    for _ in range(20):
        sizes = [rng.randrange(1, 700) for _ in range(rng.randrange(1, 60))]
        seqs = packing.pack(sizes, 128)
        at = defaultdict(list)
        for seq in seqs:
            n = sum(p[2] for p in seq)
            assert n == 128 or n & (n - 1) == 0
            for d, s, k in seq:
                at[d].append((s, k))
        for d, n in enumerate(sizes):
            end = 0
            for s, k in sorted(at[d]):
                assert s == end and k > 0
                end += k
            assert end == n
    assert packing.pack([]) == []


def test_first_fit():
    rooms = packing.Rooms(4, 10)
    assert [rooms.place(n) for n in (7, 6, 4, 3)] == [0, 1, 1, 0]


def test_packing_deals_equal_rows_to_many_groups(spark, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(packing, "GROUP_BYTES", 1000)
    rows = [(None, None)] * 200 + [(5, "the same text again ")] * 400
    out = packing.packed(spark.createDataFrame(rows, "doc_id long, text string"), public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert sum(r.length for r in out if r.doc_id is None) == 200 and len({r.sequence_id >> 32 for r in out}) > 4


def test_packing(spark, rows, docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    odd = [(500, "a  b   c\n\n  d\t\te  ", "", "", 1, ""), (501, " lead <|endoftext|> mid\r\n", "", "", 1, ""), (None, "no id it's 12", "", "", 1, ""), (502, "à la  \x1c x\u0085 y", "", "", 1, "")]
    out = packing.packed(docs.unionByName(spark.createDataFrame(odd, SCHEMA)), path).collect()
    import zlib

    texts = defaultdict(list)
    for r in [*rows, *odd]:
        texts[r[0]].append(r[1] or "")
    fill = defaultdict(list)
    whole = defaultdict(int)
    for p in out:
        ids = [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4") for t in texts[p.doc_id]]
        assert any(len(x) == p.doc_tokens and zlib.crc32(x[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for x in ids)
        fill[p.sequence_id].append((p.offset, p.length))
        whole[p.doc_id] += p.length
    for d, ts in texts.items():
        assert whole[d] == sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in ts)
    for pieces in fill.values():
        end = 0
        for o, n in sorted(pieces):
            assert o == end
            end += n
        assert end == 2048 or end & (end - 1) == 0
    assert packing.packed(empty, path).count() == 0


# ---- 7
def plain_targets(sizes, weights, repeats):
    """One source after another: the free ones share by weight what the capped ones leave."""
    capped = set()
    while True:
        left, total = sum(sizes) - repeats * sum(sizes[i] for i in capped), sum(w for i, w in enumerate(weights) if i not in capped)
        more = {i for i in range(len(sizes)) if i not in capped and left * weights[i] / total > repeats * sizes[i]}
        if not more:
            return [float(repeats * sizes[i]) if i in capped else left * weights[i] / total for i in range(len(sizes))]
        capped |= more


@pytest.mark.parametrize("sizes", [[100, 10, 1000], [0, 0, 0], [0, 5, 0, 0], [3**i for i in range(12)], [7] * 9, [5]])
def test_targets_stop_at_the_cap(spark, sizes):
    sources = spark.createDataFrame([(str(i), n, i) for i, n in enumerate(sizes)], "source string, size long, no long")
    got = [r.target for r in mixing.targets(sources, [1, 2, 3], 3).orderBy("no").collect()]
    assert got == plain_targets(sizes, [1 + i % 3 for i in range(len(sizes))], 3)


def test_mix_many_sources(spark):
    # more sources than one flow problem could hold; code point order, not that of UTF-16; null last
    names = [f"{chr(0x1F600 + i % 7)}{i}" if i % 2 else f"\uff21{i}" for i in range(20_500)] + [None]
    rows = [(i, "w " * (1 + i * 7 % 50), names[i % len(names)]) for i in range(30_000)]
    sizes = defaultdict(int)
    for i, text, source in rows:
        sizes[source] += 1 + i * 7 % 50
    order = sorted(sizes, key=lambda n: (n is None, n or ""))
    asked = dict(zip(order, plain_targets([sizes[n] for n in order], [1 + i % 3 for i in range(len(order))], 3), strict=True))
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(out) == len(rows)
    taken = defaultdict(int)
    for r in out:
        assert (r.mix_source_size, r.mix_target) == (sizes[r.source], asked[r.source]) and r.mix_taken <= 3 * r.mix_size
        taken[r.source] += r.mix_taken
    assert all(abs(taken[n] - asked[n]) <= 26 for n in order)


def test_routes_equal_one_flow(spark):
    # connected sets of sources solved one by one cost as little as one flow over all patterns
    rng = random.Random(3)
    patterns = {tuple(sorted({10 * g + rng.randrange(4) for _ in range(rng.randint(1, 3))})): rng.randint(0, 40) for g in range(6) for _ in range(5)}
    hist = spark.createDataFrame([([f"{s:02d}" for s in p], n) for p, n in patterns.items()], "held array<string>, words long")
    sources = sorted({s for p in patterns for s in p})
    asked = plain_targets([sum(n for p, n in patterns.items() if s in p) for s in sources], [1 + i % 2 for i in range(len(sources))], 3)
    keys = sorted(patterns)
    whole = mixing.min_cost_flow([(frozenset(sources.index(s) for s in p), patterns[p]) for p in keys], [int(t + 0.5) for t in asked], 3)
    got = {tuple(int(s) for s in r.held): r for r in mixing.routes(hist, [1, 2], 3, False).collect()}
    assert sorted(got) == keys and all(r.words == patterns[p] and 0 <= r.given <= 3 * r.words for p, r in got.items())

    def cost(words, given):
        return sum(r * r * max(0, min(words, given - r * words)) for r in range(3))

    assert sum(r.given for r in got.values()) == sum(whole)
    assert sum(cost(r.words, r.given) for r in got.values()) == sum(cost(patterns[p], g) for p, g in zip(keys, whole, strict=True))


def test_flow_prefers_fresh_words():
    # the shared pattern is left to the source that has nothing else
    given = mixing.min_cost_flow([(frozenset({0}), 100), (frozenset({0, 1}), 100)], [100, 100], 3)
    assert given == [100, 100]
    assert mixing.min_cost_flow([(frozenset({0}), 10)], [100], 3) == [30]


def least_cost(patterns, quotas, repeats):
    """All ways to give words, by trying: the most words, and of these the least cost."""
    best = None
    for given in itertools.product(*(range(repeats * n + 1) for _, n in patterns)):
        # Hall's condition: what any set of patterns gives fits into the sources that they touch
        some = (c for r in range(1, len(patterns) + 1) for c in itertools.combinations(range(len(patterns)), r))
        if any(sum(given[i] for i in c) > sum(quotas[s] for s in frozenset().union(*(patterns[i][0] for i in c))) for c in some):
            continue
        cost = sum(r * r * max(0, min(n, g - r * n)) for (_, n), g in zip(patterns, given, strict=True) for r in range(repeats))
        best = min(best or (0, 0), (-sum(given), cost)) if best else (-sum(given), cost)
    return best


@pytest.mark.parametrize("seed", range(12))
def test_flow_equals_trying_all(seed):
    rng = random.Random(seed)
    patterns = [(frozenset(rng.sample(range(4), rng.randint(1, 3))), rng.randint(0, 3)) for _ in range(4)]
    quotas = [rng.randint(0, 7) for _ in range(4)]
    given = mixing.min_cost_flow(patterns, quotas, 2)
    assert all(0 <= g <= 2 * n for g, (_, n) in zip(given, patterns, strict=True))
    cost = sum(r * r * max(0, min(n, g - r * n)) for (_, n), g in zip(patterns, given, strict=True) for r in range(2))
    assert (-sum(given), cost) == least_cost(patterns, quotas, 2)


def test_flow_of_many_patterns():
    rng = random.Random(1)
    patterns = list({frozenset(rng.sample(range(50), rng.randint(1, 12))): rng.randint(1, 10**6) for _ in range(20_000)}.items())
    total = sum(n for _, n in patterns)
    quotas = [int(total * (1 + s % 3) / 99) for s in range(50)]
    began = time.monotonic()
    given = mixing.min_cost_flow(patterns, quotas, 3)
    assert time.monotonic() - began < 60
    assert abs(sum(given) - sum(quotas)) < 50 and all(0 <= g <= 3 * n for g, (_, n) in zip(given, patterns, strict=True))


def test_mix(spark, rows, docs, empty):
    out = mixing.mix(docs).collect()
    assert sorted((r.doc_id, r.mix_size) for r in out) == sorted((r[0], len(WORD.findall(r[1] or ""))) for r in rows)
    by = defaultdict(list)
    for r in out:
        assert 0 <= r.mix_taken <= 3 * r.mix_size and r.mix_copies <= 3
        by[r.source].append(r)
    for group in by.values():
        most = max(r.mix_size for r in group)
        assert abs(sum(r.mix_taken for r in group) - group[0].mix_target) <= most / 2 + 1
        assert group[0].mix_source_size == sum(r.mix_size for r in group)
    assert sorted(map(tuple, mixing.mix(docs.repartition(3)).select("doc_id", "mix_taken").collect())) == sorted((r.doc_id, r.mix_taken) for r in out)
    assert mixing.mix(empty).count() == 0


def test_mix_keeps_clashing_columns(spark, docs):
    plain = sorted((r.doc_id, r.mix_taken) for r in mixing.mix(docs).collect())
    odd = docs.withColumns({"mix_size": F.lit("mine"), "__mx_held": F.lit(1), "__in_0": F.lit(2), "words": F.lit(3), "edge": F.lit(4)})
    out = mixing.mix(odd)
    assert [c for c in odd.columns if c != "mix_size"] == [c for c in out.columns if c not in mixing.RESULT]
    got = out.collect()
    assert sorted((r.doc_id, r.mix_taken) for r in got) == plain
    assert {(r["__mx_held"], r["__in_0"], r.words, r.edge) for r in got} == {(1, 2, 3, 4)}


def test_mix_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["a", "b"] if i % 2 else ["a"]) for i in range(40)] + [(99, None, None), (98, "w", [])]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, held array<string>"), "held", weights=(1, 1)).collect()
    assert len(out) == 42 and sum(r.mix_taken for r in out if r.held == ["a", "b"]) > 0


# ---- 8
def test_chat_round_trip(spark):
    tricky = ["<|im_end|><|im_start|>assistant ok", "a\\b\\0c\\1|d", "<\\1|", None, "", "\n\n", "é" * 1000, "<<||>>"]
    turns = [(c, t, ("assistant" if t % 2 else "user") if c else "odd%role\n<x>", tricky[(c + t) % 8]) for c in range(4) for t in range(16)]
    turns += [(9, 0, None, "no role"), (None, 0, "user", "no id"), (9, 0, "user", "tie")]
    d = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    back = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(chat.events_of(d, 7)))).collect()}
    want = defaultdict(list)
    for c, t, role, text in sorted(turns, key=lambda x: (str(x[0]), x[1], x[2] or "", x[3] or "")):
        want[c].append((role or "", text or ""))
    for c, said in want.items():
        assert [(t.role, t.text) for t in back[c].turns] == said
        assert list(back[c].loss) == [text for role, text in said if role == "assistant"]
    assert chat.fold(chat.events_of(d.filter("false"))).count() == 0


def test_chat_fold_order(spark):
    log = [(1, 0, 1, 3, "delta", None, "c"), (1, 0, 1, 1, "delta", None, "x"), (1, 0, 1, 2, "regenerate", None, None), (1, 0, 1, 0, "open", "user", None), (1, 1, 1, 0, "open", "assistant", None), (1, 1, 1, 1, "edit", None, "E"), (1, 1, 1, 2, "delta", None, "!")]
    got = chat.fold(spark.createDataFrame(log, "conv_id long, turn long, part int, seq int, kind string, role string, text string")).orderBy("turn").collect()
    assert [(r.role, r.text) for r in got] == [("user", "c"), ("assistant", "E!")]


# ---- 9
def test_fingerprints(spark, rows, empty):
    rows = [r for r in rows[:-1]]
    got = {r.doc_id: r for r in fingerprints.compare(spark.createDataFrame(rows, SCHEMA)).collect()}
    for k, r in enumerate(rows):
        text, after = r[1] or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        x = got[r[0]]
        assert (x.n_chars, x.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (x.fingerprint == x.edited_fingerprint) == (text == edited)
        assert 0 <= x.near_edited <= 1 and (x.near_next == 1.0 or text != after)
    assert got[9].fingerprint == got[10].fingerprint and got[9].near_next == 1.0
    assert fingerprints.compare(empty).count() == 0


@pytest.mark.parametrize("ranges", [(1024, 1000), (4, 100)])
def test_fingerprints_over_ranges(spark, monkeypatch, ranges):
    monkeypatch.setattr(fingerprints, "MAX_RANGES", ranges[0])
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", ranges[1])
    rows = [(i * 37 % 5000, f"text {i} " * 5) for i in range(5000)] + [(7, "second of id 7"), (None, "last")]
    got = {(r.doc_id, r.n_chars): r.edited_sha256 for r in fingerprints.compare(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()}
    order = sorted((r for r in rows if r[0] not in (None, 7)), key=lambda r: r[0])
    for a, b in zip(order, order[1:], strict=False):
        if b[0] == a[0] + 1:
            n = len(a[1]) // 4
            assert got[(a[0], len(a[1]))] == hashlib.sha256((a[1][: len(a[1]) - n] + b[1][:n]).encode()).hexdigest()
    last = order[-1]
    n = len(last[1]) // 4
    assert got[(last[0], len(last[1]))] == hashlib.sha256((last[1][: len(last[1]) - n] + "last"[:n]).encode()).hexdigest()


@pytest.mark.parametrize("ranges", [(1024, 100), (16, 100), (4, 20)])
def test_fingerprints_deal_null_and_frequent_ids(spark, monkeypatch, ranges):
    monkeypatch.setattr(fingerprints, "MAX_RANGES", ranges[0])
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", ranges[1])
    ids = [None if i % 3 == 0 else 50 if i % 3 == 1 else i % 100 for i in range(6000)]
    docs = spark.createDataFrame([(d, f"text {i} of many ") for i, d in enumerate(ids)], "doc_id long, text string").repartition(5)
    slots = fingerprints.dealt(docs).collect()
    assert max(Counter(r.slot for r in slots).values()) < (500 if ranges[0] > 4 else 2000)
    order = sorted(slots, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.th))
    assert [r.slot for r in order] == sorted(r.slot for r in slots)
    asked = Counter()
    for a, b in zip(order, order[1:] + order[:1], strict=True):
        n = len(a.text) // 4
        asked[a.doc_id, hashlib.sha256((a.text[: len(a.text) - n] + b.text[:n]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in fingerprints.compare(docs).select("doc_id", "edited_sha256").collect()) == asked


def test_likeness_of_trees(spark):
    """1 only for equal texts; an early insertion changes its neighbourhood alone."""
    rng = random.Random(9)
    long = " ".join(rng.choice(["stone", "ria", "milano", "lake", "of", "the", "xyz"]) + str(rng.randrange(99)) * (k % 5 == 0) for k in range(600))
    pairs = [("a\nb", "a\n\nb"), ("a\nb", "b\na"), ("", ""), ("", "x"), ("same", "same"), (long, "inserted " + long)]
    d = spark.createDataFrame(pairs, "a string, b string").select(fingerprints.likeness(fingerprints.tree(F.col("a")), fingerprints.tree(F.col("b"))).alias("z"))
    got = [r.z for r in d.collect()]
    assert got[2] == got[4] == 1.0 and all(x < 1 for i, x in enumerate(got) if i not in (2, 4)) and got[3] == 0 and got[5] > 0.8


def test_fingerprints_of_repeated_rows(spark):
    rows = [(1, "one two three four"), (1, "one two three four"), (2, None), (None, "last of all")]
    got = sorted(((r.doc_id, r.n_chars, r.near_next) for r in fingerprints.compare(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert [(d, n) for d, n, _ in got] == [(1, 18), (1, 18), (2, 0), (None, 11)]
    assert sorted(z for d, _, z in got if d == 1) == [0.0, 1.0]


def test_differing_paragraphs(spark):
    d = spark.createDataFrame([("\n".join(map(str, range(30))), "\n".join("x" if i == 17 else str(i) for i in range(31)))], "a string, b string")
    at = fingerprints.differing_paragraphs(fingerprints.tree(F.col("a")), fingerprints.tree(F.col("b")))
    assert d.select(at.alias("at")).first().at == [17, 30]


def brute_likeness(a, b):
    """Equal sections in place, then equal paragraphs anywhere, then equal pieces; and the first paragraph that differs."""
    if a == b:
        return 1.0, None
    cut = lambda p: re.findall(fingerprints.CUT, p)
    lines, whole, left = (a.split("\n"), b.split("\n")), 0, ([], [])
    n = fingerprints.SECTION
    for i in range(0, max(map(len, lines)), n):
        x, y = lines[0][i : i + n], lines[1][i : i + n]
        if x == y:
            whole += sum(1 + len(cut(p)) for p in x)
        else:
            left[0].extend(x), left[1].extend(y)
    mine, theirs = set(left[0]), set(left[1])
    whole += sum(1 + len(cut(p)) for p in mine & theirs)
    pa, pb = ({q for p in one - other for q in cut(p)} for one, other in ((mine, theirs), (theirs, mine)))
    whole += len(pa & pb)
    apart = len(mine ^ theirs) + len(pa ^ pb)
    first = next(i for i in range(max(map(len, lines))) if lines[0][i : i + 1] != lines[1][i : i + 1])
    return 2.0 * whole / (2 * whole + apart + 2), first


def test_descent_equals_brute_force(spark):
    rng = random.Random(12)
    word = lambda: rng.choice(["stone", "ria", "milano", "lake", "of", "ü", "the"])
    line = lambda: " ".join(word() for _ in range(rng.choice([0, 1, 3, 40, 90])))
    pairs = [("", ""), ("", "x"), ("a\nb", "a\n\nb"), ("x\n" * 9, "x\n" * 17)]
    for _ in range(120):
        a = [line() for _ in range(rng.randrange(1, 40))]
        b = list(a)
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(b) + 1)
            b[i : i + rng.randrange(3)] = [line() for _ in range(rng.randrange(3))]
        if rng.random() < 0.3:
            b = [p.replace("lake", "sea", 1) for p in b]
        pairs.append(("\n".join(a), "\n".join(b)))
    x, y = fingerprints.tree(F.col("a")), fingerprints.tree(F.col("b"))
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", fingerprints.likeness(x, y).alias("z"), F.get(fingerprints.differing_paragraphs(x, y), F.lit(0)).alias("first"))
    for r in rows.collect():
        assert (r.z, r["first"]) == brute_likeness(r.a, r.b)


# ---- 10
def test_crf_marginals_are_exact():
    rng = np.random.default_rng(4)
    ptr, trans = np.array([0, 1, 4, 9]), rng.normal(size=(2, 2))
    emit = rng.normal(size=9)
    good, z, pair = line_crf.marginals(emit, ptr, trans)
    expect = np.zeros((2, 2))
    for d in range(3):
        e = emit[ptr[d] : ptr[d + 1]]
        total, each = 0.0, np.zeros(len(e))
        for code in range(1 << len(e)):
            y = [(code >> k) & 1 for k in range(len(e))]
            w = np.exp(sum(e[k] for k in range(len(e)) if y[k]) + sum(trans[y[k], y[k + 1]] for k in range(len(e) - 1)))
            total += w
            each += w * np.array(y)
            for k in range(len(e) - 1):
                expect[y[k], y[k + 1]] += w / np.exp(z[d])
        assert np.isclose(np.log(total), z[d]) and np.allclose(each / total, good[ptr[d] : ptr[d + 1]])
    assert np.allclose(pair, expect)


def test_crf_edges(spark, rows, docs, empty):
    model = line_crf.train(docs, labels_for(spark, rows))
    got = line_crf.scores(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert line_crf.scores(empty, model).count() == 0
    same = spark.createDataFrame([(r[0], 1) for r in rows], "doc_id long, quality int")
    assert line_crf.scores(docs, line_crf.train(docs, same)).filter("score < 0.99").count() == 0
    assert line_crf.accepted(docs, model).columns == docs.columns
