"""Operator 5: near-duplicate documents by banded MinHash and odd sketches.

A document is its set of distinct 5-word shingles (hashed to 64 bits); documents are linked
whose sets have a Jaccard similarity of ``similarity`` percent or more (``SIMILARITY`` unless told).

1. Equal sets are one class; only classes are compared.
2. MinHash signatures are cut into ``BANDS`` bands of ``ROWS`` values. Classes that agree in a
   band share a bucket; a pair at the threshold shares none with probability 7e-11 (at 80 %: 1.3e-7).
3. Pairs are not formed within buckets. In each bucket all members are compared with one hub,
   the member with the largest buckets overall (the copies' common original, where there is
   one), and connected components are built from the confirmed links.
4. Buckets whose members are then still in several components are taken up again. In groups of
   more than ``SMALL`` members all are described by how they differ from the hub; an exact
   prefix filter on these differences (see ``_narrower``) gives smaller groups. Large ones get
   hubs of their own, and so on until none is mixed. Groups of up to ``SMALL`` wait for the end and
   are then compared directly, by sketches within one join, so that only pairs that pass leave
   it and a member costs at most ``SMALL`` / 2 estimates in a group. Texts of one template that differ in
   passages of their own never meet again, and no link between components is missed.

Each comparison passes two bitmaps first. One holds the parities of the shingles: the XOR of two
has no more ones than shingles that differ, so pairs with more ones than linked sets of their
sizes may differ in are dropped without any loss. The other is an odd sketch: the MinHash values
are folded into parities, and the number of ones in the XOR estimates high similarities
precisely. Pairs estimated below the threshold less six deviations of the samples are dropped;
with the sketch's own variance that loses a link at the threshold with probability 1.1e-6. The
others are confirmed on the full sets.

Nulls and edge cases: letters A-Z count as lower case; fewer than five words are one shingle; a
document without words has an empty set and no links; a null text counts as empty; rows of
equal doc_id and equal set are one document; a component's id is the smallest doc_id in it,
null only if all are null; ``one_of_each`` keeps one of repeated rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.llm.components import NODE_BYTES, smallest
from meterline.llm.oracles import OP5_SQL
from meterline.llm.registry import query, table
from meterline.llm.windows import mix
from meterline.session import SENT_BYTES, materialised, sent

WORDS = 5
SIMILARITY = 85  # percent
BANDS, ROWS = 40, 5
SKETCH_BITS = 512
#: Bits of the parities of a set.
PARITY_BITS = 1024
#: Members of a group that are compared directly.
SMALL = 256

#: Keys of texts or sets that are sent to all tasks; more are joined by a shuffle of all of these.
SENT = 4_000_000

#: Bytes that a row of a group and a number takes, and one of a node with its bitmaps.
GROUP_BYTES, LIGHT_BYTES = 24, 320

#: What tells documents apart: doc_id (0 if it is null), whether it is null, two text hashes.
DOC = ["doc", "no_id", "k0", "k1"]

#: Shingles that are hashed at once: what they take stays in a core's cache.
BLOCK = 256

_U, _HALF = np.uint64, np.uint32
_LANES = mix(np.arange(1, BANDS * ROWS + 1, dtype=_U), np.arange(1001, BANDS * ROWS + 1001, dtype=_U)).astype(_HALF) | _HALF(1)
_ADD = mix(np.arange(3, BANDS * ROWS + 3, dtype=_U), np.arange(77, BANDS * ROWS + 77, dtype=_U)).astype(_HALF)


def shingle_set(text: str) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = text.encode().lower().split()  # of bytes: A-Z only, and these six kinds of space
    if not words:
        return np.zeros(0, _U)
    names = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(_U)
    width = min(WORDS, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, _U)
    for k in range(width):
        out = mix(out, names[k : k + n])
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values of 32 bits; shingles are taken in blocks, so long texts need no more memory."""
    low = np.full(BANDS * ROWS, ~_HALF(0))
    short = (shingles ^ shingles >> _U(32)).astype(_HALF)
    room = np.empty((2, min(BLOCK, len(short)), BANDS * ROWS), _HALF)
    for k in range(0, len(short), BLOCK):
        part = short[k : k + BLOCK, None]
        hashed, shifted = room[:, : len(part)]
        np.multiply(part, _LANES, out=hashed)
        hashed += _ADD
        np.right_shift(hashed, _HALF(15), out=shifted)
        hashed ^= shifted
        hashed *= _HALF(0x9E3779B1)
        np.minimum(low, hashed.min(axis=0), out=low)
    return low.astype(_U)


def band_keys(values: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=_U)
    for k in range(ROWS):
        keys = mix(keys, values.reshape(BANDS, ROWS)[:, k])
    return keys


def odd_sketch(values: np.ndarray) -> np.ndarray:
    """Parities of how many (position, value) pairs hash to each bit."""
    bits = mix(values, np.arange(len(values), dtype=_U)) % _U(SKETCH_BITS)
    parity = np.bincount(bits.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def parities(shingles: np.ndarray) -> np.ndarray:
    """Parities of how many shingles hash to each bit."""
    bits = (shingles % _U(PARITY_BITS)).astype(np.int64)
    parity = np.bincount(bits, minlength=PARITY_BITS) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def sketch_least(similarity: int) -> float:
    """The least estimate that goes on: six deviations below ``similarity`` percent.

    Estimates vary by sqrt(J (1 - J) / samples).
    """
    j = similarity / 100
    return j - 6 * (j * (1 - j) / (BANDS * ROWS)) ** 0.5


def find_sets(docs: DataFrame, keys: str, whole: bool) -> DataFrame:
    """For rows of ``keys`` (columns of whole numbers) and text: n_shingles and the class (two
    hashes of the set); with ``whole`` the set itself, else band keys, sketch and parities."""
    names = keys.split(", ")
    schema = pa.schema([(k, pa.int64()) for k in names] + [("n_shingles", pa.int64()), ("c0", pa.int64()), ("c1", pa.int64())])
    lists = pa.list_(pa.int64())
    for name in ["shingles"] if whole else ["bands", "sketch", "parities"]:
        schema = schema.append(pa.field(name, lists))

    def rows_of(text: str | None) -> tuple:
        s = shingle_set(text or "")
        c0, c1 = (np.bitwise_xor.reduce(mix(s, np.full_like(s, k))) if len(s) else _U(0) for k in (5, 6))
        head = (len(s), int(c0.astype(np.int64)), int(c1.astype(np.int64)))
        if whole:
            return *head, s.view(np.int64)
        if not len(s):
            return *head, None, None, None
        values = signature(s)
        return *head, band_keys(values).view(np.int64), odd_sketch(values), parities(s)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 512):
                part = batch.slice(k, 512)
                found = list(zip(*map(rows_of, part.column(len(names)).to_pylist()), strict=True))
                columns = [*part.columns[: len(names)], *map(pa.array, found, schema.types[len(names) :])]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    kinds = ", ".join(f"{k} long" for k in names) + ", n_shingles long, c0 long, c1 long, "
    kinds += "shingles array<long>" if whole else "bands array<long>, sketch array<long>, parities array<long>"
    return docs.select(*names, "text").mapInArrow(emit, kinds)


def _node(c0: str = "c0", c1: str = "c1") -> Column:
    """A class's name: 128 bits, as text that sorts."""
    return F.concat(F.lpad(F.hex(c0), 16, "0"), F.lpad(F.hex(c1), 16, "0"))


def _ones(a: Column, b: Column, bits: int) -> Column:
    """How many bits of two bitmaps differ."""
    return sum((F.bit_count(a[k].bitwiseXOR(b[k])) for k in range(bits // 64)), F.lit(0))


def estimate(a: Column, b: Column) -> Column:
    """Similarity by two odd sketches: the share of equal MinHash values."""
    share = F.least(_ones(a, b, SKETCH_BITS) / F.lit(SKETCH_BITS), F.lit(0.4999))
    return 1 + F.log(1 - 2 * share) * SKETCH_BITS / (4 * BANDS * ROWS)


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int, n_sets: int) -> DataFrame:
    """The ``pairs`` (a, b) of nodes that are linked, by their sketches and then full sets; pairs
    with n_a and n_b have been told by their sketches.

    ``sets`` has ``n_sets`` rows of node, n_shingles, sketch, parities and shingles.
    """
    if "n_a" not in pairs.columns:
        light = [sent(_light(sets, x), n_sets, LIGHT_BYTES) for x in "ab"]
        pairs = pairs.join(light[0], "a").join(light[1], "b").filter(_close(similarity))
        pairs = materialised(pairs.select("a", "b", "n_a", "n_b"), "close")
    n = pairs.count()
    if not n:
        return pairs.select("a", "b")
    sets = _only(sets, pairs.select(F.explode(F.array("a", "b")).alias("node")), 2 * n)
    full = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"x_{x}"))
    both = sent(pairs, n, 2 * NODE_BYTES).join(full("a"), "a").join(full("b"), "b")
    shared = F.size(F.array_intersect("x_a", "x_b"))
    linked = shared * 100 >= (F.col("n_a") + F.col("n_b") - shared) * similarity
    return materialised(both.filter(linked).select("a", "b"), "confirmed")


def _only(sets: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """``sets``, less those of all other than the ``n`` ``nodes`` where these are few enough to be sent."""
    ends = nodes.select(F.xxhash64("node").alias("end"))
    if n * GROUP_BYTES > SENT_BYTES:
        ends = materialised(ends.distinct(), "ends")
        if ends.count() > SENT:
            return sets
    return sets.join(F.broadcast(ends), F.xxhash64("node") == F.col("end"), "left_semi")


def _light(sets: DataFrame, x: str) -> DataFrame:
    """What sketches are compared by, of node ``x``."""
    return sets.select(
        F.col("node").alias(x),
        F.col("n_shingles").alias(f"n_{x}"),
        F.col("sketch").alias(f"s_{x}"),
        F.col("parities").alias(f"p_{x}"),
    )


def _close(similarity: int) -> Column:
    """Whether a and b may be linked, by sizes, parities and sketches."""
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * similarity
    differ = _ones(F.col("p_a"), F.col("p_b"), PARITY_BITS)
    few = differ * (100 + similarity) <= (F.col("n_a") + F.col("n_b")) * (100 - similarity)
    return sizes & few & (estimate(F.col("s_a"), F.col("s_b")) >= sketch_least(similarity))


def link_classes(classes: DataFrame, texts: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """(node, label) of the classes that are labelled by another one, of ``classes`` with one
    document of ``texts`` each."""
    # A hash of the name halves the rows that are shuffled; one shared by chance only adds members.
    short = F.xxhash64("node").alias("short")
    n_classes = classes.count()
    groups = classes.select(short, F.explode("bands").alias("group"))
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = materialised(sizes, "groups")
    shared = groups.join(sent(sizes, sizes.count(), GROUP_BYTES), "group")
    names = classes.select("node", short)
    if n_classes * NODE_BYTES > SENT_BYTES:
        shared = materialised(shared, "shared")
    members = shared.join(sent(names, n_classes, NODE_BYTES), "short").select("group", "node", "n")
    members = materialised(members, "members")
    nodes = sent(members.select("node").distinct(), n_classes, NODE_BYTES)
    sets = materialised(_sets(classes, texts, nodes), "sets")
    n = sets.count()
    links = labels = None
    waiting = []
    while not members.isEmpty():
        hubs = _hubs(members, n)
        hubs = sent(hubs, hubs.count(), NODE_BYTES)
        with_hub = members.join(hubs, "group").filter("node <> hub")
        pairs = with_hub.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
        if n * LIGHT_BYTES > SENT_BYTES:
            pairs = materialised(pairs, "pairs")
        found = confirmed(pairs, sets, similarity, n)
        links, labels = _grown(links, labels, found)
        mixed = _mixed(members, labels, n)
        waiting.append(mixed.filter(F.col("n") <= SMALL).select("group", "node"))
        large = mixed.filter(F.col("n") > SMALL)
        if large.isEmpty():
            break
        narrow = _narrower(large, hubs, sets, similarity)
        waiting.append(narrow.filter(F.col("n") <= SMALL).select("group", "node"))
        members = narrow.filter(F.col("n") > SMALL)
    if labels is None:
        return classes.select("node", F.col("node").alias("label")).limit(0)
    small = reduce(DataFrame.unionByName, waiting)
    if small.isEmpty():
        return labels
    found = confirmed(_met(small, labels, sets, similarity, n), sets, similarity, n)
    return _grown(links, labels, found)[1]


def _grown(links: DataFrame | None, labels: DataFrame | None, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links with those ``found``, and the components; these stay if nothing was found."""
    if links is None:
        return found, smallest(found)
    if found.isEmpty():
        return links, labels
    links = links.unionByName(found)
    return links, smallest(links)


def _met(small: DataFrame, labels: DataFrame, sets: DataFrame, similarity: int, n: int) -> DataFrame:
    """(a, b, n_a, n_b) of members of one group and different components that may be linked."""
    one = small.join(sent(labels, n, 2 * NODE_BYTES), "node", "left").withColumn("label", F.coalesce("label", "node"))
    one = one.select("group", F.col("node").alias("a"), F.col("label").alias("l_a")).join(sent(_light(sets, "a"), n, LIGHT_BYTES), "a")
    if n * LIGHT_BYTES > SENT_BYTES:
        one = materialised(one, "small")
    two = one.select("group", *[F.col(f"{x}a").alias(f"{x}b") for x in ("", "l_", "n_", "s_", "p_")])
    apart = (F.col("l_a") != F.col("l_b")) & (F.col("a") < F.col("b"))
    met = one.join(two, (one["group"] == two["group"]) & apart & _close(similarity))
    return materialised(met.select("a", "b", "n_a", "n_b").distinct(), "met")


def _hubs(members: DataFrame, n: int) -> DataFrame:
    """(group, hub): the member of each group with the largest groups overall, of ``n`` nodes."""
    weight = members.groupBy("node").agg(F.sum("n").alias("weight"))
    weighted = members.select("group", "node").join(sent(weight, n, NODE_BYTES), "node")
    hub = weighted.groupBy("group").agg(F.max(F.struct("weight", "node")).alias("hub"))
    return materialised(hub.select("group", F.col("hub.node").alias("hub")), "hubs")


def _mixed(members: DataFrame, labels: DataFrame, n: int) -> DataFrame:
    """(group, node, n, label) of the groups whose members, of ``n`` nodes, lie in several
    components; of groups with the same members, one."""
    marked = members.join(sent(labels, n, 2 * NODE_BYTES), "node", "left").withColumn("label", F.coalesce("label", "node"))
    if n * 2 * NODE_BYTES > SENT_BYTES:
        marked = materialised(marked, "marked")
    same = [F.bit_xor(F.xxhash64(F.lit(k), "node")).alias(f"x{k}") for k in (0, 1)]
    seen = marked.groupBy("group").agg(F.min("label").alias("low"), F.max("label").alias("high"), *same).filter("low < high")
    once = seen.groupBy("x0", "x1").agg(F.min("group").alias("group"))
    return materialised(marked.join(once.select("group"), "group"), "mixed")


def _narrower(members: DataFrame, hubs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """(group, node, n): groups of fewer members, in one of which each pair of ``members`` that
    may be linked and lies in different components still meets.

    Groups of one hub h are taken together. A member's delta is what it and h do not share.
    Linked members a and b of sizes m and n differ in at most c (m + n) shingles, for
    c = (1 - J) / (1 + J), so their deltas A and B share (|A| - c m + |B| - c n) / 2 or more: a
    positive number, unless both are linked with h. By the prefix principle they then share one
    of the first shingles of their deltas, as many as that number leaves, in the order of how
    many members' deltas hold a shingle. Such a shingle and its holders are a new group. The
    hub's delta is empty, so groups shrink each round.
    """
    c = (100 - similarity) / (100 + similarity)
    rows = members.join(hubs, "group").select("hub", "node", "label").distinct()
    rows = materialised(rows, "rows")
    n = rows.count()
    of_hub = rows.filter("node = hub").select("hub", F.col("label").alias("hub_label"))
    ends = rows.select("node").unionByName(rows.select(F.col("hub").alias("node")))
    rows = rows.filter("node <> hub").join(sent(of_hub, n, 2 * NODE_BYTES), "hub")
    rows = rows.withColumn("far", F.col("label") != F.col("hub_label")).drop("hub_label")
    sets = _only(sets, ends, 2 * n)
    x = sets.select("node", "n_shingles", "shingles")
    y = x.select(F.col("node").alias("hub"), F.col("shingles").alias("hub_shingles"))
    delta = F.concat(F.array_except("shingles", "hub_shingles"), F.array_except("hub_shingles", "shingles"))
    rows = sent(rows, n, 3 * NODE_BYTES).join(x, "node").join(y, "hub").select("hub", "node", "label", "far", "n_shingles", delta.alias("delta"))
    rows = rows.withColumn("size", F.size("delta")).withColumn("w", F.col("size") - c * F.col("n_shingles"))
    rows = materialised(rows, "deltas")
    # Members of the hub's component need only meet others; these need to meet all.
    least = rows.groupBy("hub").agg(F.min("w").alias("any"), F.min(F.when(F.col("far"), F.col("w"))).alias("outer"))
    meets = (F.col("w") + F.when(F.col("far"), F.col("any")).otherwise(F.col("outer"))) / 2
    shared = F.greatest(F.lit(1), F.ceil(meets - 1e-6))
    first = rows.drop("delta").join(sent(least.filter("outer is not null"), n, NODE_BYTES), "hub")
    first = first.select("hub", "node", "label", "size", (F.col("size") - shared + 1).alias("first")).filter("first > 0")
    spread = rows.select("hub", "node", F.explode("delta").alias("s"))
    often = spread.groupBy("hub", "s").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    held = spread.join(often, ["hub", "s"])
    if n * 3 * NODE_BYTES > SENT_BYTES:
        held = materialised(held, "held")
    of_node = Window.partitionBy("hub", "node")
    ranked = held.join(sent(first, n, 3 * NODE_BYTES), ["hub", "node"])
    place = F.row_number().over(of_node.orderBy("often", "s"))
    ranked = ranked.withColumns({"place": place, "listed": F.count(F.lit(1)).over(of_node)})
    # Shingles that no other delta holds come first and are not listed.
    named = ranked.filter("place <= first - size + listed")
    named = materialised(named.select(F.xxhash64("hub", "s").alias("group"), "node", "label").distinct(), "named")
    sizes = named.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    sizes = sizes.filter("low < high").select("group", "n")
    return materialised(named.drop("label").join(sizes, "group"), "members")


def _sets(classes: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, n_shingles, shingles, sketch and parities of ``nodes``, from one document of each."""
    wanted = materialised(classes.select("node", *DOC, "sketch", "parities").join(nodes, "node", "left_semi"), "wanted")
    n = wanted.count()
    if n <= SENT:  # few keys are sent, and no text is shuffled
        keys = wanted.select(F.xxhash64(*DOC).alias("key"))
        found = texts.join(F.broadcast(keys), F.xxhash64(*DOC) == F.col("key"), "left_semi")
    else:
        found = texts.join(wanted.select(*DOC), DOC, "left_semi")
    sets = find_sets(found, ", ".join(DOC), whole=True).withColumn("node", _node())
    once = sets.select("node", "n_shingles", "shingles").dropDuplicates(["node"])
    return once.join(sent(wanted.select("node", "sketch", "parities"), n, LIGHT_BYTES), "node")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns(
        {
            "doc": F.coalesce("doc_id", F.lit(0)),
            "no_id": F.col("doc_id").isNull().cast("long"),
            "k0": F.xxhash64(text),
            "k1": F.xxhash64(F.lit(1), text),
        }
    )


def grouped(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """DOC, n_shingles and label (of the component; null without words) of all documents."""
    keyed = _keyed(docs.select("doc_id", "text")).select(*DOC, "text")
    found = find_sets(keyed, ", ".join(DOC), whole=False).withColumn("node", _node())
    found = materialised(found, "signatures")
    # Equal sets have equal bands and sketches, and any one text of a class stands for it.
    classes = (
        found.filter("n_shingles > 0")
        .groupBy("node")
        .agg(F.min(F.struct(*DOC, "bands", "sketch", "parities")).alias("one"))
        .select("node", "one.*")
    )
    classes = materialised(classes, "classes")
    labels = link_classes(classes, keyed, similarity)
    joined = found.select(*DOC, "n_shingles", "node").join(labels, "node", "left")
    label = F.when(F.col("n_shingles") > 0, F.coalesce("label", "node"))
    return materialised(joined.select(*DOC, "n_shingles", label.alias("label")), "grouped")


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of all documents (doc_id, text)."""
    found = grouped(docs, similarity)
    doc_id = F.when(F.col("no_id") == 0, F.col("doc"))
    least = found.filter("label is not null").groupBy("label").agg(F.min(doc_id).alias("component_id"))
    n = found.count()
    if n * NODE_BYTES > SENT_BYTES:
        least = materialised(least, "components")
    joined = found.join(sent(least, n, NODE_BYTES), "label", "left")
    component = F.when(F.col("label").isNull(), doc_id).otherwise(F.col("component_id"))
    return joined.select(
        doc_id.alias("doc_id"),
        "n_shingles",
        component.alias("component_id"),
        doc_id.eqNullSafe(component).alias("kept"),
    )


def one_of_each(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """``docs`` less all but one document of each component: the one of smallest doc_id (null
    after all others), of repeated rows one. Documents without words all stay."""
    found = grouped(docs, similarity)
    order = ["no_id", "doc", "k0", "k1"]
    first = found.filter("label is not null").groupBy("label").agg(F.min(F.struct(*order)).alias("one"))
    stay = first.select("one.*").unionByName(found.filter("label is null").select(*order).distinct())
    staying = materialised(stay, "stay").select(*DOC)
    rows = _keyed(docs.select(F.struct("*").alias("_row"), "doc_id", "text")).drop("doc_id", "text")
    # Rows whose key is of one row, which stays, need no shuffle; the others' keys are few or not sent.
    key = F.xxhash64(*DOC).alias("key")
    all_keys = found.select(key, F.lit(1).alias("n"), F.lit(0).alias("stay"))
    all_keys = all_keys.unionByName(staying.select(key, F.lit(0).alias("n"), F.lit(1).alias("stay")))
    odd = all_keys.groupBy("key").agg(F.sum("n").alias("n"), F.sum("stay").alias("stay")).filter("n <> 1 or stay <> 1")
    odd = materialised(odd.select("key", "stay"), "odd")
    n, n_stay = odd.agg(F.count(F.lit(1)), F.count_if(F.col("stay") > 0)).first()
    once = lambda some: some.join(staying, DOC, "left_semi").dropDuplicates(DOC).select("_row.*")
    if n > SENT:
        return once(rows)
    marked = rows.withColumn("key", key)
    plain = marked.join(F.broadcast(odd.select("key")), "key", "left_anti").select("_row.*")
    if not n_stay:
        return plain
    return plain.unionByName(once(marked.join(F.broadcast(odd.filter("stay > 0").select("key")), "key", "left_semi")))


@query("op5_near_duplicates", OP5_SQL)
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
