"""Phrase collocations: exact counts by HAT-tries, scored against the best-explained cut.

Each task counts words and phrases of up to three words in a HAT-trie: a shallow trie over word ids
whose leaves are hash containers, each for a range of first words, or of second words below one first word.
A container of more than BURST entries bursts: its range is cut, and one that holds a single first word moves
a level down. When a task holds more than ENTRIES, its largest subtrees leave whole as a sorted run. Runs are
cut by prefix partition (a hash of the first two words, and of the third in SPLITS so that a hot prefix is
spread), packed by columns, exchanged, and merged partition by partition, a language at a time; ids are local
to a task, so runs carry words. The number of prefix partitions grows with that of input partitions. Only phrases found `least` times go on: every part of one is as frequent, so they
alone give the parts' counts. Scores are exact decimals; each language's best are taken in two steps.

Defined results: null text is empty and has no phrases; null lang is `und`, together with a lang of that name;
equal texts and repeated rows all count; of equal score and count the phrase that sorts first by its bytes
comes first; an empty table gives no rows. Words of any length and characters are whole. Counts beyond
10**16 are an error, not a wrong score. doc_id is not needed; extra columns are left out.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillweave.llm import arrays as A
from tillweave.llm.shared import need, settled, ship

ship(__name__)

LEAST, TOP, WITHIN = 10, 2000, 50
BURST, ENTRIES, WORD_BYTES, CHUNK = 1 << 15, 1 << 21, 1 << 26, 1 << 21
SPLITS, SALTS, PLACES_PER_TASK, MERGE = 8, 16, 8, 1 << 20
ID_BITS = 21
NONE = -1

BREAKS = np.zeros(256, bool)
BREAKS[list(b".,;:!?\n\x0b\f\r")] = True
GAPS = BREAKS.copy()
GAPS[[32, 9]] = True


class Container:
    """A hash table of packed phrases and counts, open addressing, filled by whole arrays."""

    def __init__(self, size: int = 1 << 10):
        self.keys, self.counts, self.n = np.full(size, NONE, np.int64), np.zeros(size, np.int64), 0

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(A.BASE)) >> np.uint64(64 - (len(self.keys).bit_length() - 1))).astype(np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """keys are distinct."""
        at, mask = self._home(keys), len(self.keys) - 1
        new, todo = [], np.arange(len(keys))
        while len(todo):
            held = self.keys[at[todo]]
            hit, free = held == keys[todo], held == NONE
            self.counts[at[todo[hit]]] += counts[todo[hit]]
            new.append(todo[free])
            todo = todo[~hit & ~free]
            at[todo] = (at[todo] + 1) & mask
        new = np.concatenate(new) if new else todo
        if 2 * (self.n + len(new)) > len(self.keys):
            old, have = self.entries()
            size = 1 << (2 * (self.n + len(new))).bit_length()
            self.keys, self.counts = np.full(size, NONE, np.int64), np.zeros(size, np.int64)
            self._put(old, have, self._home(old))
            at[new] = self._home(keys[new])
        self._put(keys[new], counts[new], at[new])
        self.n += len(new)

    def _put(self, keys: np.ndarray, counts: np.ndarray, at: np.ndarray) -> None:
        mask, todo = len(self.keys) - 1, np.arange(len(keys))
        while len(todo):
            done = self.keys[at[todo]] == NONE
            claim = todo[done]
            self.keys[at[claim]] = keys[claim]  # of several that claim a slot one wins
            done[done] = self.keys[at[claim]] == keys[claim]
            won, todo = todo[done], todo[~done]
            self.counts[at[won]] = counts[won]
            at[todo] = (at[todo] + 1) & mask

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        full = np.flatnonzero(self.keys != NONE)
        return self.keys[full], self.counts[full]

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = self.entries()
        order = np.argsort(keys)
        return keys[order], counts[order]


class HatTrie:
    """The trie's leaves in order: container i holds the packed phrases from starts[i] up to starts[i + 1]."""

    def __init__(self):
        self.starts, self.leaves = np.zeros(1, np.int64), [Container()]

    def __len__(self) -> int:
        return sum(leaf.n for leaf in self.leaves)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """keys are distinct and sorted."""
        cut = np.concatenate(([0], np.searchsorted(keys, self.starts[1:]), [len(keys)]))
        for i in np.flatnonzero(np.diff(cut))[::-1].tolist():  # from the end: bursts move what comes after
            self.leaves[i].add(keys[cut[i] : cut[i + 1]], counts[cut[i] : cut[i + 1]])
            if self.leaves[i].n > BURST:
                self._burst(i)

    def _burst(self, i: int) -> None:
        keys, counts = self.leaves[i].run()
        starts, parts, waiting = [], [], [(int(self.starts[i]), 0, len(keys))]
        while waiting:
            start, a, b = waiting.pop()
            at = None
            if b - a > BURST:
                for bits in (2 * ID_BITS, ID_BITS):  # by first words, else below one of them by second words
                    if keys[a] >> bits != keys[b - 1] >> bits:
                        at = (keys[(a + b) // 2] >> bits) << bits
                        at = at if at > keys[a] else ((keys[a] >> bits) + 1) << bits
                        break
            if at is None:
                leaf = Container(1 << (2 * (b - a)).bit_length())
                leaf.add(keys[a:b], counts[a:b])
                starts.append(start), parts.append(leaf)
            else:
                middle = a + int(np.searchsorted(keys[a:b], at))
                waiting += [(int(at), middle, b), (start, a, middle)]
        self.starts = np.concatenate((self.starts[:i], starts, self.starts[i + 1 :])).astype(np.int64)
        self.leaves[i : i + 1] = parts

    def spill(self, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """The largest leaves as a sorted run, so that at most `keep` entries stay."""
        left, gone = len(self), []
        for i in sorted(range(len(self.leaves)), key=lambda i: -self.leaves[i].n):
            if left <= keep or not self.leaves[i].n:
                break
            left -= self.leaves[i].n
            gone.append(i)
        runs = [self.leaves[i].run() for i in sorted(gone)]  # leaves are in key order
        for i in gone:
            self.leaves[i] = Container()
        return tuple(np.concatenate([r[k] for r in runs]) if runs else np.zeros(0, np.int64) for k in (0, 1))


class Counter:
    """Words of a task by language, and their trie."""

    def __init__(self, places: int):
        self.places, self.totals = places, {}
        self.clear()

    def clear(self) -> None:
        self.ids, self.words, self.langs, self.bytes, self.trie = {}, [b""], [""], 0, HatTrie()

    def ids_of(self, lang: np.ndarray, names: list[str], words: pa.Array) -> np.ndarray:
        coded = words.dictionary_encode()
        pair = lang * len(coded.dictionary) + coded.indices.to_numpy()
        some, where = np.unique(pair, return_inverse=True)
        found, of = np.empty(len(some), np.int64), some // len(coded.dictionary)
        for k in np.unique(of).tolist():
            at = np.flatnonzero(of == k)
            held, said = self.ids.setdefault(names[k], {}), coded.dictionary.take(pa.array(some[at] - k * len(coded.dictionary))).to_pylist()
            ids = np.fromiter(map(held.get, said, repeat(0)), np.int64, len(said))
            missing = np.flatnonzero(ids == 0)
            ids[missing] = np.arange(len(self.words), len(self.words) + len(missing))
            new = [said[i] for i in missing.tolist()]
            held.update(zip(new, ids[missing].tolist(), strict=True))
            self.words += new
            self.langs += [names[k]] * len(new)
            self.bytes += sum(map(len, new))
            found[at] = ids
        return found[where]

    def add(self, langs: list[str], buf: np.ndarray, offs: np.ndarray) -> None:
        s, e, ptr = A.words(buf, offs, GAPS)
        names = sorted(set(langs))
        row, number = A.owners(ptr), {n: k for k, n in enumerate(names)}
        lang = np.array([number[n] for n in langs], np.int64)[row]
        for n, k in zip(names, np.bincount(lang, minlength=len(names)).tolist(), strict=True):
            self.totals[n] = self.totals.get(n, 0) + k
        if not len(s):
            return
        buf = A.FOLD[buf]
        said = buf[~GAPS[buf]]
        at = np.concatenate(([0], np.cumsum(e - s))).astype(np.int32)
        ids = self.ids_of(lang, names, pa.Array.from_buffers(pa.binary(), len(s), [None, pa.py_buffer(at), pa.py_buffer(said)]))
        broken = np.concatenate(([0], np.cumsum(BREAKS[buf])))
        two = (row[1:] == row[:-1]) & (broken[s[1:]] == broken[e[:-1]])
        three = two[1:] & two[:-1]
        first = ids << (2 * ID_BITS)
        pairs = first[:-1][two] | (ids[1:][two] << ID_BITS)
        triples = first[:-2][three] | (ids[1:-1][three] << ID_BITS) | ids[2:][three]
        self.trie.add(*np.unique(np.concatenate((first, pairs, triples)), return_counts=True))

    def spilled(self, keep: int):
        """A batch for the run that leaves the trie: lang, place and the run's part for that place, packed."""
        keys, counts = self.trie.spill(keep)
        if not len(keys):
            return
        low, words = (1 << ID_BITS) - 1, pa.array(self.words, pa.binary())
        ids = [keys >> (2 * ID_BITS), (keys >> ID_BITS) & low, keys & low]
        phrases = pc.binary_join_element_wise(*(words.take(pa.array(i, mask=i == 0)) for i in ids), b" ", null_handling="skip")
        cut = np.frombuffer(words.buffers()[1], np.int32)[: len(words) + 1].astype(np.int64)
        text = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        mark = A.segment_hashes(text, cut[:-1], cut[1:])
        name, of = np.unique(np.array(self.langs, object).astype(str), return_inverse=True)
        prefix = A.mix(mark[ids[0]] * np.uint64(3) + mark[ids[1]] * np.uint64(A.BASE))
        place = ((prefix + mark[ids[2]] % np.uint64(SPLITS)) % np.uint64(self.places)).astype(np.int64)
        group = of[ids[0]] * self.places + place
        order = np.argsort(group, kind="stable")  # within a place the run stays in the trie's order
        group, phrases, counts = group[order], phrases.take(pa.array(order)), counts[order]
        begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        parts = [packed(phrases.slice(a, b - a), counts[a:b]) for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(group)], strict=True)]
        at = group[begin]
        langs = pa.array(name[at // self.places].tolist(), pa.string())
        for a in range(0, len(parts), 256):
            yield pa.RecordBatch.from_arrays([langs.slice(a, 256), pa.array(at[a : a + 256] % self.places), pa.array(parts[a : a + 256], pa.binary())], ["lang", "place", "part"])

    def full(self) -> bool:
        return len(self.words) + CHUNK >= 1 << ID_BITS or self.bytes > WORD_BYTES


def packed(phrases: pa.Array, counts: np.ndarray) -> bytes:
    """Phrases and counts of a run, compressed by columns."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([phrases, pa.array(counts)], ["phrase", "f"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def counter_of(places: int):
    def run(batches):
        """Runs of phrases with their counts; each language's words as the count of the empty phrase."""
        counter = Counter(places)
        for batch in batches:
            langs = pc.fill_null(batch.column("lang"), "und").to_pylist()
            for i, j, buf, offs in A.chunks(batch.column("text"), CHUNK):
                counter.add(langs[i:j], buf, offs)
                if counter.full():  # ids begin anew
                    yield from counter.spilled(0)
                    counter.clear()
                elif len(counter.trie) > ENTRIES:
                    yield from counter.spilled(ENTRIES // 2)
        yield from counter.spilled(0)
        totals = [packed(pa.array([b""]), np.array([n])) for n in counter.totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(counter.totals), pa.string()), pa.array([0] * len(totals), pa.int64()), pa.array(totals, pa.binary())], ["lang", "place", "part"])

    return run


def merger(least: int):
    def merged(phrases: list, counts: list) -> tuple[pa.Array, np.ndarray]:
        coded = pa.concat_arrays(phrases).dictionary_encode()
        total = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(total, coded.indices.to_numpy(), np.concatenate(counts))
        return coded.dictionary, total

    def run(batches):
        """Merges the runs of one language and place after the other; they come sorted by these."""

        def done():
            phrase, f = merged(phrases, counts)
            keep = pa.array((f >= least) | (pc.binary_length(phrase).to_numpy() == 0))
            phrase = phrase.filter(keep).cast(pa.string())
            return pa.RecordBatch.from_arrays([pa.array([now[0]] * len(phrase), pa.string()), phrase, pa.array(f).filter(keep)], ["lang", "phrase", "f"])

        now, phrases, counts, held = None, [], [], 0
        for batch in batches:
            for lang, place, part in zip(batch.column("lang").to_pylist(), batch.column("place").to_pylist(), batch.column("part"), strict=True):
                if now != (lang, place):
                    if now is not None:
                        yield done()
                    now, phrases, counts, held = (lang, place), [], [], 0
                with pa.ipc.open_stream(part.as_buffer()) as stream:
                    for rows in stream:
                        phrases.append(rows.column("phrase")), counts.append(rows.column("f").to_numpy())
                        held += rows.num_rows
                if held > MERGE:
                    one = merged(phrases, counts)
                    phrases, counts, held = [one[0]], [one[1]], 0
        if now is not None:
            yield done()

    return run


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, phrase, f of every word and phrase found `least` times or more; the empty phrase counts the language's words."""
    need(docs, "text", "lang")
    texts = docs.select(F.col("lang").cast("string").alias("lang"), "text")
    places = max(64, PLACES_PER_TASK * texts.rdd.getNumPartitions())
    runs = texts.mapInArrow(counter_of(places), "lang string, place long, part binary")
    return runs.repartition("lang", "place").sortWithinPartitions("lang", "place").mapInArrow(merger(least), "lang string, phrase string, f long")


def cut_scores(frequent: DataFrame) -> DataFrame:
    """lang, phrase, words, a, and l, r and score of the lowest-scoring cut, of ties the shortest first part."""
    words = frequent.withColumn("words", F.size(F.split("phrase", " ")))
    cuts = words.filter("words > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.selectExpr("lang", "phrase", "words", "f as a", "k", "substring_index(phrase, ' ', k) as head", "substring_index(phrase, ' ', k - words) as tail")
    part = lambda name, f: frequent.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    both = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"])
    exact = lambda c, n=19: F.col(c).cast(f"decimal({n},0)")
    fits = F.col("l") <= 10**16
    ratio = F.expr("cast(a * a * million as decimal(38,0)) div cast(l * r as decimal(38,0))")
    sized = both.select("lang", "phrase", "words", "k", F.col("a").alias("a_"), F.col("l").alias("l_"), F.col("r").alias("r_"), fits.alias("fits"), exact("a").alias("a"), exact("l").alias("l"), exact("r").alias("r"), F.lit(1_000_000).cast("decimal(7,0)").alias("million"))
    score = F.when(F.col("fits"), ratio).otherwise(F.raise_error(F.lit("a count is beyond 10**16")))
    best = sized.withColumn("score", score).groupBy("lang", "phrase", "words", F.col("a_").alias("a")).agg(F.min(F.struct("score", "k", F.col("l_").alias("l"), F.col("r_").alias("r"))).alias("best"))
    return best.select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, within: int = WITHIN) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score."""
    frequent = settled(phrase_counts(docs, least))
    totals = frequent.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    scored = cut_scores(frequent.filter("phrase != ''"))
    longer = frequent.withColumn("parts", F.split("phrase", " ")).filter(F.size("parts") > 2)
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.size("parts") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.size("parts") - m + 1), lambda i: F.array_join(F.slice("parts", i, m), " "))))
    inside = longer.select("lang", F.explode(spans).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < within * F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
