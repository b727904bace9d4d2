"""Document fingerprints as Merkle trees over pieces, paragraphs and sections.

Paragraphs are lines; a paragraph is cut by content into pieces (CUT: after a vowel and a space, 16 to
96 code points in), so an insertion changes only the pieces near it; a section is SECTION paragraphs.
A paragraph's node is the MD5 of its text, a section's the MD5 of its paragraphs' nodes, the root the
SHA-256 of the sections' nodes, so equal roots mean equal texts. Where roots differ, two trees are compared by descent: a
section that is equal in its place counts whole and is not looked into; of the others, paragraphs that both have count
whole, wherever they stand; only of those that are left are the pieces compared. Likeness is the Dice coefficient of what
counts as common (a paragraph weighs one and its pieces), 1 for equal roots. The same descent locates edits: positions of
paragraphs that differ. No Python runs in tasks.

Defined results: null text is empty; texts that differ, if only in newlines, have a likeness below 1; documents
are ordered by doc_id, null last, rows that repeat a doc_id by the hash of their text (rows equal in both share a task);
the document after the last is the first, so a single document is its own successor; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tillweave.llm.shared import need, text_of

SECTION = 8
#: A piece: up to the first vowel and space from its 17th code point on, at most 96 code points.
CUT = r"[^\n]{16,94}?[aeiou] |[^\n]{1,96}"
#: Most ranges of document ids, and of equal steps within each; a range's first row is what its neighbour is told of.
MAX_RANGES, MAX_STEPS, RANGE_ROWS = 1024, 1024, 1000


def paragraphs(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1), lambda p: F.md5(p.cast("binary")))


def sections(nodes: Column) -> Column:
    starts = F.sequence(F.lit(0), F.size(nodes) - 1, F.lit(SECTION))
    return F.transform(starts, lambda i: F.md5(F.array_join(F.slice(nodes, i + 1, SECTION), "").cast("binary")))


def root(section_nodes: Column) -> Column:
    return F.sha2(F.array_join(section_nodes, "").cast("binary"), 256)


def branches(text: Column) -> Column:
    """Per paragraph 8 hex digits of its node, then 8 of each of its pieces: equal as the paragraphs are."""
    digits = lambda t: F.substring(F.md5(t.cast("binary")), 1, 8)
    cut = lambda p: F.transform(F.regexp_extract_all(p, F.lit(CUT), F.lit(0)), digits)
    return F.transform(F.split(text, "\n", -1), lambda p: F.concat(digits(p), F.array_join(cut(p), "")))


def tree(text: Column) -> Column:
    """The root, 16 hex digits of each section's node, and the paragraphs' branches."""
    nodes = sections(paragraphs(text))
    return F.struct(root(nodes).alias("root"), F.transform(nodes, lambda n: F.substring(n, 1, 16)).alias("sections"), branches(text).alias("branches"))


def fingerprint(t: Column) -> Column:
    """The tree as one string: root, sections and branches with colons between, branches with commas."""
    return F.concat_ws(":", t["root"], F.array_join(t["sections"], ""), F.array_join(t["branches"], ","))


def differing_sections(a: Column, b: Column) -> Column:
    """Positions of sections that are not alike in both trees."""
    most = F.greatest(F.size(a["sections"]), F.size(b["sections"]))
    return F.filter(F.sequence(F.lit(0), most - 1), lambda i: ~F.get(a["sections"], i).eqNullSafe(F.get(b["sections"], i)))


def below(t: Column, at: Column) -> Column:
    """The branches of the sections at these positions."""
    return F.flatten(F.transform(at, lambda i: F.slice(t["branches"], i * SECTION + 1, SECTION)))


def weight(of: Column) -> Column:
    """Paragraphs and pieces of branches."""
    return F.aggregate(of, F.lit(0), lambda n, s: n + F.shiftright(F.length(s), 3))


def leaves(of: Column) -> Column:
    """Distinct pieces of branches."""
    return F.array_distinct(F.flatten(F.transform(of, lambda s: F.regexp_extract_all(F.substr(s, F.lit(9)), F.lit(".{8}"), F.lit(0)))))


def descent(a: Column, b: Column) -> Column:
    """What a comparison from the roots down finds: weight in common, and in one tree only (both trees' summed)."""
    at = differing_sections(a, b)
    mine, theirs = below(a, at), below(b, at)
    alike, only_a, only_b = F.array_intersect(mine, theirs), F.array_except(mine, theirs), F.array_except(theirs, mine)
    pa, pb = leaves(only_a), leaves(only_b)
    shared = F.size(F.array_intersect(pa, pb))
    common = weight(a["branches"]) - weight(mine) + weight(alike) + shared
    apart = F.size(only_a) + F.size(only_b) + F.size(pa) + F.size(pb) - 2 * shared
    return F.struct(common.alias("common"), apart.alias("apart"))


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of what the descent finds, the roots that differ counted: 1 exactly for equal roots."""
    d = descent(a, b)
    return F.when(a["root"] == b["root"], 1.0).otherwise(2.0 * d["common"] / (2 * d["common"] + d["apart"] + 2))


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Positions of paragraphs that differ, looked for only in sections that differ."""
    inner = F.flatten(F.transform(differing_sections(a, b), lambda i: F.sequence(i * SECTION, i * SECTION + SECTION - 1)))
    return F.filter(inner, lambda i: ~F.get(a["branches"], i).eqNullSafe(F.get(b["branches"], i)))


def dealt(docs: DataFrame) -> DataFrame:
    """doc_id, text, th (hash of the text), slot: slots follow the order of doc_id (null last), then th.

    Ids are cut into ranges at approximate quantiles, large tables' ranges into equal steps (all
    numbers are bounded and any cut gives the same result). An id that fills ranges of its own, and null, is dealt on by th.
    """
    need(docs, "doc_id", "text")
    rows = docs.select("doc_id", text_of().alias("text"))
    quantiles = F.percentile_approx("doc_id", [i / MAX_RANGES for i in range(1, MAX_RANGES)], 10 * MAX_RANGES)
    total = rows.agg(F.count("*").alias("n"), F.count("doc_id").alias("known"), quantiles.alias("q"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    want = min(MAX_RANGES, max(1, total.n // RANGE_ROWS))
    steps = min(MAX_STEPS, max(1, total.n // (RANGE_ROWS * MAX_RANGES)))
    seen = Counter(total.q or [])
    heavy = sorted(v for v, times in seen.items() if (times - 1) * total.known >= RANGE_ROWS * MAX_RANGES)
    cuts = sorted({*(total.q or [])[MAX_RANGES // want - 1 :: MAX_RANGES // want], *heavy})
    place = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("doc_id"))) if cuts else F.lit(0)
    if steps > 1:
        edges = F.array(*map(F.lit, [total.lo, *cuts, total.hi]))
        low, high = F.get(edges, place).cast("double"), F.get(edges, place + 1).cast("double")
        part = F.least(F.floor((F.col("doc_id").cast("double") - low) / F.greatest(high - low, F.lit(1.0)) * steps), F.lit(steps - 1))
        place = place * steps + part
    slot = F.when(F.col("doc_id").isNull(), (len(cuts) + 1) * steps).otherwise(place)
    more = min(MAX_STEPS, total.n // RANGE_ROWS) if heavy or total.known < total.n else 0
    if more:
        by_text = F.least(F.floor((F.col("th").cast("double") / 2.0**64 + 0.5) * more), F.lit(more - 1))
        wide = F.col("doc_id").isNull() | (F.col("doc_id").isin(heavy) if heavy else F.lit(False))
        # a heavy id is the first of its range: the other ids follow it
        slot = slot * (more + 1) + F.when(wide, by_text).otherwise(more)
    return rows.withColumn("th", F.xxhash64("text")).select("doc_id", "text", "th", slot.cast("int").alias("slot"))


def successors(docs: DataFrame) -> DataFrame:
    """doc_id, text, its tree, next_text and next_tree, with one exchange of the texts.

    Each slot's first row is also sent to the slot before it, so that the last row of a slot meets its successor.
    """
    keyed = dealt(docs)
    order = [F.col("doc_id").asc_nulls_last(), F.col("th")]
    firsts = keyed.groupBy("slot").agg(F.min(F.struct("doc_id", "th")).alias("first"))
    told = (
        firsts.withColumn("to", F.lag("slot").over(W.orderBy("slot")))
        .withColumn("to", F.coalesce("to", F.max("slot").over(W.partitionBy(F.lit(0)))))
        .select("to", F.col("slot").alias("from"), F.col("first.doc_id").alias("fid"), F.col("first.th").alias("fth"))
    )
    sent = keyed.join(F.broadcast(told), F.col("doc_id").eqNullSafe(F.col("fid")) & (F.col("th") == F.col("fth")) & (F.col("slot") == F.col("from")))
    sent = sent.dropDuplicates(["slot"]).select("doc_id", "text", F.col("to").alias("slot"), "th", F.lit(1).alias("guest"))
    # Dealt before the trees are built, so that only texts are exchanged.
    both = keyed.withColumn("guest", F.lit(0)).unionByName(sent).repartition("slot").withColumn("tree", tree(F.col("text")))
    w = W.partitionBy("slot").orderBy("guest", *order)
    led = both.withColumns({"next_text": F.lead("text").over(w), "next_tree": F.lead("tree").over(w)})
    return led.filter("guest = 0").select("doc_id", "text", "tree", "next_text", "next_tree")


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, likenesses to it and to the next; first_edited: the first paragraph that differs."""
    n = F.char_length("text")
    swap = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - swap), F.substring(F.col("next_text"), F.lit(1), swap))
    rows = successors(docs).withColumns({"n_chars": n.cast("long"), "edited": edited})
    rows = rows.withColumn("edited_tree", tree(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("tree")).alias("fingerprint"),
        fingerprint(F.col("edited_tree")).alias("edited_fingerprint"),
        likeness(F.col("tree"), F.col("edited_tree")).alias("near_edited"),
        likeness(F.col("tree"), F.col("next_tree")).alias("near_next"),
        F.get(differing_paragraphs(F.col("tree"), F.col("edited_tree")), F.lit(0)).alias("first_edited"),
    )
