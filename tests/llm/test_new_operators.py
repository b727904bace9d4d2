"""Collocations, whitening and language ID: brute force, exact integers, held-out accuracy, edge cases."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillweave.llm import collocations, lang_id, queries, whitening
from tillweave.llm.collocations import Container, HatTrie

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- collocations
def brute_collocations(rows, least=10, top=2000, within=50):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least:
            found[lang, p] = (a, *min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))))
    gone = {(lang, q) for (lang, p), c in found.items() if len(p) == 3 for q in (p[:2], p[1:]) if (lang, q) in found and 100 * c[0] >= within * found[lang, q][0]}
    out = []
    for lang in n:
        best = sorted((-c[1], -c[0], " ".join(p).encode(), c) for (m, p), c in found.items() if m == lang and (m, p) not in gone)
        out += [(lang, i + 1, b[2].decode(), b[3][0], b[3][3], b[3][4], n[lang], b[3][1]) for i, b in enumerate(best[:top])]
    return sorted(out)


def phrases_table(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def random_texts(seed, n=120):
    rng = np.random.default_rng(seed)
    words = ["Alpha", "beta", "alpha", "é", "Ünder", "a\x1fb", "x" * 3000, "漢字", "und", "-", "beta beta"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " \x0b", "!?"]
    rows = [(str(rng.choice(["en", "de"])), "".join(str(rng.choice(words)) + str(rng.choice(marks)) for _ in range(rng.integers(0, 80)))) for _ in range(n)]
    rows += [(None, "beta alpha " * 30), ("und", "beta alpha. " * 15), ("en", None), ("en", ""), (None, None), ("fr", " \t\n"), ("fr", "seul")]
    return rows + rows[:5]


@pytest.mark.parametrize("seed", range(3))
def test_collocations(spark, seed):
    rows = random_texts(seed)
    got = sorted(tuple(r) for r in collocations.collocations(phrases_table(spark, rows)).collect())
    want = brute_collocations(rows)
    assert got == want and len(got) > 50


def test_collocations_spill_and_burst(spark, monkeypatch):
    """Tiny containers, tries and words tables: every way through the counter gives the same counts."""
    for name, value in (("BURST", 8), ("ENTRIES", 64), ("WORD_BYTES", 4000), ("CHUNK", 512), ("MERGE", 16)):
        monkeypatch.setattr(collocations, name, value)
    rows = random_texts(7, 60)
    got = sorted(tuple(r) for r in collocations.collocations(phrases_table(spark, rows).repartition(3), least=3, top=40).collect())
    assert got == brute_collocations(rows, 3, 40)


def test_hat_trie_counts():
    rng, trie, want = np.random.default_rng(1), HatTrie(), Counter()
    for _ in range(6):
        first = rng.zipf(1.3, 60_000) % 5000 + 1
        keys = (first << 42) | (rng.integers(0, 40, 60_000) << 21) | rng.integers(0, 30, 60_000)
        keys, counts = np.unique(keys, return_counts=True)
        trie.add(keys, counts)
        want.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
    assert len(trie) == len(want) and len(trie.leaves) > 3
    assert all(leaf.n <= collocations.BURST or len(set((leaf.run()[0] >> 21).tolist())) == 1 for leaf in trie.leaves)
    kept = len(trie)
    keys, counts = trie.spill(kept // 2)
    assert (np.diff(keys) > 0).all() and len(trie) <= kept // 2 < kept == len(trie) + len(keys)
    rest = trie.spill(0)
    assert dict(zip(np.concatenate((keys, rest[0])).tolist(), np.concatenate((counts, rest[1])).tolist(), strict=True)) == want


def test_container_full_of_equal_homes():
    box, keys = Container(4), np.arange(1, 5000, dtype=np.int64)
    box.add(keys, keys)
    box.add(keys[::3], keys[::3])
    got, counts = box.run()
    assert (got == keys).all() and (counts == np.where((keys - 1) % 3 == 0, 2 * keys, keys)).all()


def test_collocations_wide_counts_and_empty(spark):
    frequent = spark.createDataFrame([("x", "a", 9 * 10**15), ("x", "b", 3 * 10**15), ("x", "a b", 2 * 10**15)], "lang string, phrase string, f long")
    row = collocations.cut_scores(frequent).first()
    assert (row.a, row.l, row.r, row.score) == (2 * 10**15, 9 * 10**15, 3 * 10**15, 10**6 * 4 // 27)
    empty = collocations.collocations(spark.createDataFrame([], "lang string, text string, rank long, phrase string"))
    assert empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and empty.count() == 0
    clash = phrases_table(spark, [("en", "go on " * 12)]).withColumns({c: F.lit(1) for c in ("f", "place", "part", "phrase", "rank", "n", "k")})
    assert sorted(tuple(r) for r in collocations.collocations(clash).collect()) == brute_collocations([("en", "go on " * 12)])


# ---- whitening
def vectors_table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def check_whitening(got, rows, most=32):
    """Against exact integers and numpy's eigenvalues; components by their own covariance and residuals."""
    fit = [(i, [int(np.floor(64 * float(c))) for c in v]) for i, v in rows]
    n, d = len(fit), len(fit[0][1])
    s = [sum(v[j] for _, v in fit) for j in range(d)]
    scatter = np.array([[n * sum(v[i] * v[j] for _, v in fit) - s[i] * s[j] for j in range(d)] for i in range(d)], float) / n / n
    value, vector = np.linalg.eigh(scatter)
    value, vector = value[::-1], vector[:, ::-1]
    rank = int((value > 1e-9 * max(value[0], 1e-300)).sum()) if value[0] > 0 else 0
    k = min(most, rank)
    assert len(got) == n * k
    by = sorted(got, key=lambda r: (r.vec_id, r.component))
    assert [(r.vec_id, r.component) for r in by] == sorted((i, c) for i, _ in fit for c in range(1, k + 1))
    deviation = {i: sum((n * v[j] - s[j]) ** 2 for j in range(d)) for i, v in fit}
    assert all(r.deviation == deviation[r.vec_id] and r.n == n for r in by)
    white = np.array([r.whitened for r in by]).reshape(n, k)
    assert np.abs(white.T @ white / n - np.outer(white.mean(0), white.mean(0)) - np.eye(k)).max() < 1e-9
    assert all(r.identity_error < 1e-9 for r in by)
    share = np.array([r.explained for r in by]).reshape(n, k)[0]
    assert np.allclose(share, value[:k] / value.sum(), rtol=1e-9)
    centred = np.array([[v[j] - s[j] / n for j in range(d)] for _, v in sorted(fit)])
    for c in range(k):
        alone = min(abs(value[c] - value[j]) for j in range(d) if j != c) > 1e-6 * value[0] if d > 1 else True
        if alone:
            plain = centred @ vector[:, c] / np.sqrt(value[c])
            assert min(np.abs(plain - white[:, c]).max(), np.abs(plain + white[:, c]).max()) < 1e-7 * np.sqrt(value[0] / value[c])


@pytest.mark.parametrize("seed,n,d", [(0, 40, 5), (1, 7, 12), (2, 60, 40), (3, 30, 1), (4, 3, 2)])
def test_whitening(spark, seed, n, d):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=d) * rng.uniform(0.1, 3, d)]) for i in range(n)]
    table = vectors_table(spark, rows)
    check_whitening(whitening.whiten(table, whitening.fit(table)).collect(), rows)


def test_whitening_equal_roots(spark):
    """Corners of a cross have one eigenvalue in every direction; a doubled axis stands out."""
    rows = [(2 * j + k, [float((1 - 2 * k) * (2 if j == 3 else 1)) if i == j else 0.0 for i in range(6)]) for j in range(6) for k in (0, 1)]
    table = vectors_table(spark, rows, "double")
    check_whitening(whitening.whiten(table, whitening.fit(table)).collect(), rows)


def test_whitening_large_entries(spark):
    """Beyond 64-bit sums: entries near 2**40, exact deviations where a long holds them, else null."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-(1 << 40), 1 << 40, 3)]) for i in range(12)]
    table = vectors_table(spark, rows, "double")
    got = whitening.whiten(table, whitening.fit(table)).collect()
    assert len(got) == 36 and all(r.deviation is None and r.identity_error < 1e-9 for r in got)
    white = np.array([r.whitened for r in sorted(got, key=lambda r: (r.vec_id, r.component))]).reshape(12, 3)
    assert np.abs(white.T @ white / 12 - np.eye(3)).max() < 1e-9


def test_whitening_unusable_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0]), (2, [1.5, -1.0]), (2, [1.5, -1.0]), (None, [-2.0, 0.25])]
    bad = [(5, None), (6, []), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1e30, 1.0]), (11, [1.0, 2.0, 3.0])]
    table = vectors_table(spark, good + bad).withColumns({c: F.lit(1) for c in ("component", "n", "i", "j", "value", "d")})
    got = whitening.whiten(table, whitening.fit(table)).collect()
    assert Counter(r.vec_id for r in got) == {1: 2, 2: 4, None: 2} and {r.n for r in got} == {4}
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, None)]):
        table = vectors_table(spark, rows)
        out = whitening.whiten(table, whitening.fit(table))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_characteristic_polynomial_and_roots(spark):
    rng = np.random.default_rng(3)
    half = rng.integers(-50, 50, (7, 5)).astype(object)
    a = half @ half.T  # rank 5 of 7
    poly = whitening.characteristic_polynomial(spark, a)
    x = np.zeros((7, 7), object)
    for c in poly[::-1]:  # Cayley-Hamilton, in exact integers
        x = x @ a + c * np.eye(7, dtype=int).astype(object)
    assert not x.any() and poly[:2] == [0, 0] and poly[-1] == 1
    roots = whitening.isolated_roots(poly, 7)
    value = np.linalg.eigvalsh(a.astype(float))[::-1]
    assert [t for _, _, t in roots] == [1] * 5
    assert np.allclose([whitening.to_float(2 * z + 1, b + 1) for z, b, _ in roots], value[:5], rtol=1e-12)
    assert whitening.isolated_roots([4, -4, 1], 5)[0][2] == 2  # (x - 2)**2


# ---- language ID
def test_lang_id_held_out(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = queries.op13_lang_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    held = out.filter("held_out").collect()
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def plain_vector(text, idf):
    """Counts of grams in plain Python, by the operator's slots."""
    codes = []
    for c in text:
        b = c.encode()
        if len(b) == 1:
            codes.append(ord(c.lower()) if c.isalpha() else 32)
        else:
            if b[0] == 0xC3 and 0x80 <= b[1] <= 0x9E and b[1] != 0x97:
                b = bytes((b[0], b[1] + 0x20))
            codes.append(int.from_bytes(b, "little"))
    n = Counter()
    for m in (1, 2, 3):
        for i in range(len(codes) - m + 1):
            n[sum(codes[i + j] * int(lang_id.MULTIPLIERS[m][j]) for j in range(m)) % (1 << 64) >> (64 - lang_id.SLOT_BITS)] += 1
    w = {s: (1 + np.log(c)) * idf[s] for s, c in n.items()}
    norm = np.sqrt(sum(x * x for x in w.values()))
    return {s: x / norm for s, x in w.items()}


def test_lang_id_against_plain_python(spark):
    rng = np.random.default_rng(2)
    parts = {"aa": ["ana", "Éna", "ano", "ania"], "bb": ["strk", "krst", "trsk"], "cc": ["漢字", "字", "漢漢"]}
    rows = [(i, " ".join(rng.choice(parts[lang], 12)), lang) for i, lang in enumerate(rng.choice(list(parts), 90).tolist())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.train(docs)
    learn = [t for i, t, _ in rows if __import__("zlib").crc32(str(i).encode()) % 4 != 2]
    df = Counter(s for t in learn for s in plain_vector(t, np.ones(lang_id.SLOTS)))
    assert np.allclose(model["idf"], [np.log((len(learn) + 1) / (df[s] + 1)) + 1 for s in range(lang_id.SLOTS)])
    got = {r.doc_id: r for r in lang_id.identify(docs, model).collect()}
    for i, text, lang in rows:
        v = plain_vector(text, model["idf"])
        alike = sum(x * model["centre"][s] for s, x in v.items())
        assert got[i].lang_pred == model["lang"][int(np.argmax(alike))] == lang
        assert abs(got[i].score - min(alike.max(), 1)) < 1e-4


def test_lang_id_edges(spark):
    rows = [(1, None, "aa"), (2, "", "aa"), (3, " 12 .,\n", "aa"), (4, "漢", "cc"), (5, "ª", None), (6, "abc abc", "aa"), (6, "abc abc", "aa"), (None, "zzz", "bb"), (9, "… — ٣", "aa"), (10, "x" * 300_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit("q") for c in ("draw", "share", "place", "slots", "score", "rejected")})
    model = lang_id.train(docs)
    got = [tuple(r) for r in lang_id.identify(docs, model).collect()]
    assert len(got) == len(rows)
    assert {g[0] for g in got if g[1] == "und" and g[2] == 0.0 and g[3]} == {1, 2, 3, 9}
    assert {g[1] for g in got if g[0] in (4, 5, 6, 10, None)} <= {"aa", "bb", "cc"}
    assert [g for g in got if g[0] == 6][0] == [g for g in got if g[0] == 6][1]
    nothing = lang_id.train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {tuple(r)[1:] for r in lang_id.identify(docs, nothing).collect()} == {("und", 0.0, True)}
    empty = lang_id.train(docs.limit(0))
    assert lang_id.identify(docs.limit(0), empty).count() == 0


def test_lang_id_rejects_what_is_far(spark):
    rows = [(i, "ana ano ania anana " * 5 + "ana" * (i % 5), "aa") for i in range(40)]
    docs = spark.createDataFrame(rows + [(100, "xkcd qwpz zzqx kjhg", None), (101, "ana ano ania", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.rejected for r in lang_id.identify(docs, lang_id.train(docs)).collect()}
    assert got[100] and not got[101] and not got[0]


# ---- clashing columns, maps, and very many empty documents
def test_line_dedup_with_helper_names(spark):
    from tillweave.llm import line_dedup

    names = ("__ld_id", "__ld_n", "ld_id", "ld_hash", "ld_n", "ld_words", "th")
    docs = spark.createDataFrame([(1, "a long enough line\nx"), (2, "a long enough line\ny")], "doc_id long, text string").withColumns({c: F.lit(5) for c in names})
    got = line_dedup.dedup_lines(docs).orderBy("doc_id").collect()
    assert [(r.text, r.n_dropped) for r in got] == [("a long enough line\nx", 0), ("y", 1)] and all(r[c] == 5 for r in got for c in names)


def test_near_duplicates_with_map_column(spark):
    import corpus_pipeline

    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text, {"b": 1}), (1, text, {"a": 2}), (2, text + " more", {}), (3, "other", None)], "doc_id long, text string, tags map<string,int>")
    got = corpus_pipeline.near_duplicates(spark, docs, "").orderBy("doc_id").collect()
    assert [(r.doc_id, r.tags) for r in got] == [(1, {"a": 2}), (3, None)]


def test_packing_deals_empty_documents_to_many_groups(spark):
    import public_tokenizers

    from tillweave.llm import packing

    docs = spark.range(300_000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    out = packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))
    groups = out.groupBy(F.shiftright("sequence_id", 32).alias("g")).agg(F.count("*").alias("n")).collect()
    assert sum(r.n for r in groups) == 300_000 and len(groups) >= 8 and max(r.n for r in groups) < 60_000
