"""Operator 13: the main text of web pages, by deducing each site's template.

Tokens are tags and words, told apart by their place in the page (``html_tokens``). Pages of one
host are compared in four Spark steps:

1. Each task names the tokens that half of a host's pages among its own hold. A token that half
   of all pages of the host hold is named by at least one task, so these are all candidates.
2. Each page becomes the sequence of its candidates. A token's occurrence vector (how often each
   page holds it) is kept as sums of hashes of (page, count), which add up over tasks. Tokens of a
   host with equal vectors form an equivalence class; classes of at least three tokens count.
3. A class is valid if all pages repeat its tokens in one order. Valid classes are nested: one
   lies in a slot between two neighbouring tokens of another, on every page, and classes that
   cross each other are no template. What slots hold is added up by host.
4. Template tokens are taken off the pages; the blocks of text in the remaining slots are kept
   where they are main text: inside article or main elements, where a page has them, else in
   the host's slots with most text that is not linked.

Menus, headers, footers, asides, forms, adverts, notices, scripts, styles and readers' comments
are left out by element, role and name, as their text may differ on every page. A block made of
template words alone is left out inside articles, too, but only if at least ``STEADY`` percent of
the host's pages hold it and most of the host's pages differ in text, so that copies of an article
are not taken for a template. No page is shuffled: counts and templates are, and a host's template
goes back to its pages by a join, broadcast up to ``BROADCAST`` tokens.

Nulls and edge cases: null or empty html gives an empty text; a null url, or one without host,
has no template, and its page is judged on its own, as is one of a host with fewer than
``FEWEST`` different pages; page_id may be null or repeated, each row is returned; unclosed
elements, comments and quotes end with the page; a line break (br) ends a block; text of any
length is kept whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.html_tokens import Block, Distinct, Known, read
from meterline.llm.oracles import OP13_SQL
from meterline.llm.registry import query, table
from meterline.session import materialised

#: Percent of a host's pages that hold a template token; that hold one which may be cut from articles.
SUPPORT, STEADY = 50, 80
#: Tokens in a class; different pages of a host with a template; with one that reaches into articles.
CLASS_SIZE, FEWEST, MANY = 3, 3, 5
#: Percent of the best slot's text from which another slot holds main text, too.
SLOT_SHARE = 20
#: Pages that a task counts together; tokens of all hosts up to which they are broadcast.
CHUNK, BROADCAST = 20_000, 2_000_000

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def with_hosts(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, html) with the host in lower case, empty where there is none."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return pages.select("page_id", "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))


def _tokens(rows: list[dict]) -> list[tuple[int, str | None]]:
    return [(r["token"], r["word"]) for r in rows]


def _batch(**columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _lists(values: list, kind: pa.DataType) -> pa.Array:
    return pa.array(values, pa.list_(kind))


def _joined(rows: DataFrame, by_host: DataFrame, size, how: str) -> DataFrame:
    """``rows`` with the written row of their host; broadcast if all hosts' ``size`` is small."""
    total = by_host.agg(F.sum(size)).first()[0] or 0
    return rows.join(F.broadcast(by_host) if total <= BROADCAST else by_host, "host", how)


# --- step 1: candidates -------------------------------------------------------------------


def named_tokens(rows: DataFrame) -> DataFrame:
    """(host, kind, token, word): tokens that half of a task's pages hold (kind 0; a tag has no
    word), and the hash of each page's text (kind 1)."""

    def flushed(held: dict[str, tuple]) -> Iterator[pa.RecordBatch]:
        for host, (tags, words, digests) in held.items():
            often = [(t, None) for t, n in tags.items() if 100 * n >= SUPPORT * len(digests)]
            for path, counts in words.items():
                often += [(path, w) for w, n in counts.items() if 100 * n >= SUPPORT * len(digests)]
            rows = [(host, 0, t, w) for t, w in often] + [(host, 1, d, None) for d in digests]
            columns = zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.int64(), pa.string()), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], ["host", "kind", "token", "word"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = defaultdict(lambda: (Counter(), defaultdict(Counter), [])), 0
        for batch in batches:
            for host, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page = Distinct()
                blocks = read(html, page)
                tags, words, digests = held[host]
                tags.update(page.tags)
                for path, found in page.words.items():
                    words[path].update(found)
                digests.append(xxhash.xxh64_intdigest("\n".join([b.text for b in blocks])) - (1 << 63))
                n += 1
                if n >= CHUNK:
                    yield from flushed(held)
                    held.clear()
                    n = 0
        yield from flushed(held)

    return rows.select("host", "html").mapInArrow(run, "host string, kind int, token long, word string")


def candidates(rows: DataFrame) -> DataFrame:
    """(host, pages, texts, tokens) of the hosts with enough different pages."""
    named = materialised(named_tokens(rows.filter("host <> ''")), "named")
    texts = named.filter("kind = 1").groupBy("host", "token").count()
    sizes = texts.groupBy("host").agg(F.sum("count").alias("pages"), F.count(F.lit(1)).alias("texts"))
    tokens = named.filter("kind = 0").groupBy("host").agg(F.sort_array(F.collect_set(F.struct("token", "word"))).alias("tokens"))
    return materialised(sizes.filter(F.col("texts") >= FEWEST).join(tokens, "host"), "candidates")


# --- step 2: sequences, occurrence vectors and classes -------------------------------------


def sequences(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(host, key, seq) per page: numbers of its candidates in order, and for each block of text in
    between -(1 + words * 2^20 + linked words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        takers: dict[str, Known] = {}
        for batch in batches:
            hosts, pages = batch.column("host").to_pylist(), batch.column("html").to_pylist()
            keys, out = [], []
            for i, (host, html) in enumerate(zip(hosts, pages, strict=True)):
                if host not in takers:
                    takers[host] = Known(_tokens(batch.column("tokens")[i].as_py()))
                numbers = takers[host].numbers
                numbers.clear()
                blocks = read(html, takers[host])
                seq, at = [], 0
                for b in blocks:
                    seq += numbers[at : b.last]
                    seq.append(-(1 + (b.words << 20) + min(b.linked, (1 << 20) - 2)))
                    at = b.last
                out.append(seq + numbers[at:])
                keys.append(xxhash.xxh64_intdigest(html) - (1 << 63))
            yield _batch(host=pa.array(hosts, pa.string()), key=pa.array(keys, pa.int64()), seq=_lists(out, pa.int64()))

    joined = _joined(rows.filter("host <> ''").select("host", "html"), found.select("host", "tokens"), F.size("tokens"), "inner")
    return materialised(joined.mapInArrow(run, "host string, key long, seq array<long>"), "sequences")


def classes_of(seqs: DataFrame, found: DataFrame) -> DataFrame:
    """(host, classes): the tokens, by number, that share an occurrence vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for host, key, seq in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                seq = np.array(seq, np.int64)
                numbers, counts = np.unique(seq[seq >= 0], return_counts=True)
                if not len(numbers):
                    continue
                have = sums.get(host)
                if have is None or len(have) <= numbers[-1]:
                    grown = np.zeros((int(numbers[-1]) + 64, 4), np.int64)
                    if have is not None:
                        grown[: len(have)] = have
                    have = sums[host] = grown
                h = (counts.astype(np.uint64) * _M1) ^ np.uint64(key & (2**64 - 1))
                h = (h ^ (h >> np.uint64(31))) * _M2
                h ^= h >> np.uint64(29)
                one = np.stack([np.ones(len(h), np.int64), counts, (h >> np.uint64(32)).astype(np.int64), (h & np.uint64(0xFFFFFFFF)).astype(np.int64)], axis=1)
                have[numbers] += one
        for host, have in sums.items():
            numbers = np.flatnonzero(have[:, 0])
            cells = {c: have[numbers, i] for i, c in enumerate(("pages", "total", "h1", "h2"))}
            yield _batch(host=pa.array([host] * len(numbers), pa.string()), token=numbers, **cells)

    vectors = seqs.select("host", "key", "seq").mapInArrow(
        run, "host string, token long, pages long, total long, h1 long, h2 long"
    )
    vectors = vectors.groupBy("host", "token").agg(*(F.sum(c).alias(c) for c in ("pages", "total", "h1", "h2")))
    sizes = found.select("host", F.col("pages").alias("all"))
    often = vectors.join(sizes, "host").filter(
        (F.col("pages") >= FEWEST) & (100 * F.col("pages") >= SUPPORT * F.col("all"))
    )
    classes = often.groupBy("host", "pages", "total", "h1", "h2").agg(F.sort_array(F.collect_list("token")).alias("members"))
    classes = classes.filter(F.size("members") >= CLASS_SIZE)
    listed = classes.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("pages", "members"))).alias("classes"))
    return materialised(listed, "classes")


# --- step 3: order, nesting and slots ------------------------------------------------------

ORDER, NEST, SLOT, CROSSING = 0, 1, 2, -1


def facts_of_page(seq: list[int], member: dict[int, int], sizes: list[int]) -> Iterator[tuple]:
    """What a page tells of its host's classes, as (kind, a, b, c, x, y, order)."""
    places: dict[int, list[int]] = defaultdict(list)
    orders: dict[int, list[int]] = defaultdict(list)
    last = -1
    for at, k in enumerate(seq):
        if k < 0:
            words, linked = divmod(-k - 1, 1 << 20)
            yield SLOT, last, 0, 0, words, linked, None
        elif (c := member.get(k)) is not None:
            places[c].append(at)
            orders[c].append(k)
            last = k
    ends = {}
    for c, order in orders.items():
        size = sizes[c]
        once = order[:size]
        whole = len(order) % size == 0 and len(set(once)) == size and order == once * (len(order) // size)
        yield ORDER, c, 0, 0, 0 if whole else 1, 0, once if whole else []
        if whole:
            p = np.array(places[c])
            ends[c] = p, p[::size], p[size - 1 :: size]
    for outer, (p, _, _) in ends.items():
        for inner, (_, starts, stops) in ends.items():
            if inner != outer:
                before, after = np.searchsorted(p, starts), np.searchsorted(p, stops)
                slots = np.where(before == after, before % sizes[outer], CROSSING)
                for slot, n in zip(*(x.tolist() for x in np.unique(slots, return_counts=True)), strict=True):
                    yield NEST, inner, outer, slot, n, 0, None


def nested(classes: list[dict], facts: list[dict]) -> list[dict]:
    """The valid classes with tokens in order, each with the class and slot it lies in (or -1)."""
    valid = {}
    for f in facts:
        if f["kind"] == ORDER and f["x"] == 0 and f["least"] == f["most"]:
            valid[f["a"]] = f["most"]
    slots: dict[tuple[int, int], dict[int, int]] = defaultdict(dict)
    for f in facts:
        if f["kind"] == NEST and f["a"] in valid and f["b"] in valid:
            slots[f["a"], f["b"]][f["c"]] = f["x"]
    rank = lambda c: (classes[c]["pages"], len(valid[c]))
    for a, b in sorted(slots):
        # Each reaches across a border of the other: the weaker one is no template.
        if a < b and a in valid and b in valid and CROSSING in slots[a, b] and CROSSING in slots[b, a]:
            del valid[min((a, b), key=rank)]
    out = []
    for c, order in sorted(valid.items()):
        around = [(len(valid[b]), -b, next(iter(s))) for (a, b), s in slots.items() if a == c and b in valid and len(s) == 1 and min(s) > 0]
        # Of the classes around it, the innermost lies in all others.
        around = [x for x in around if not any(min(slots.get((-y[1], -x[1]), {0: 0})) > 0 for y in around if y is not x)]
        _, parent, slot = max(around, default=(0, 1, -1))
        out.append({"support": classes[c]["pages"], "tokens": order, "number": c, "parent": -parent, "slot": slot})
    return out


FACTS = "host string, kind int, a long, b long, c long, x long, y long, seq array<long>"
CLASSES = "array<struct<support: long, number: long, parent: long, slot: long, tokens: array<long>>>"
SLOTS = "array<struct<token: long, words: long, linked: long>>"
TOKENS = "array<struct<token: long, word: string>>"
TEMPLATES = f"host string, pages long, texts long, tokens {TOKENS}, classes {CLASSES}, slots {SLOTS}"


def templates(pages: DataFrame) -> DataFrame:
    """A row per host with a template: its tokens, its nested classes, with the numbers of their
    tokens in order, and the text in each slot, named by the token before it (-1: none)."""
    rows = with_hosts(pages)
    found = candidates(rows)
    seqs = sequences(rows, found)
    classes = classes_of(seqs, found)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        held: dict[tuple, list] = {}

        def flushed() -> pa.RecordBatch:
            keys = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), [pa.string(), pa.int32()] + [pa.int64()] * 3, strict=True)]
            x, y, seq = zip(*held.values(), strict=True)
            arrays = [*keys, pa.array(x, pa.int64()), pa.array(y, pa.int64()), _lists(list(seq), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, ["host", "kind", "a", "b", "c", "x", "y", "seq"])

        for batch in batches:
            for i, (host, seq) in enumerate(zip(batch.column("host").to_pylist(), batch.column("seq").to_pylist(), strict=True)):
                if host not in known:
                    members = [c["members"] for c in batch.column("classes")[i].as_py()]
                    known[host] = {k: c for c, m in enumerate(members) for k in m}, [len(m) for m in members]
                for kind, a, b, c, x, y, order in facts_of_page(seq, *known[host]):
                    key = host, kind, a, b, c
                    have = held.get(key)
                    if have is None:
                        held[key] = [x, y, order]
                    else:
                        have[0] += x
                        have[1] += y
                        if kind == ORDER and have[2] != order:
                            have[0], have[2] = have[0] + 1, []
            if len(held) > 200_000:
                yield flushed()
                held = {}
        if held:
            yield flushed()

    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                facts = row.pop("facts")
                row["classes"] = nested(row["classes"], facts)
                slots = [{"token": f["a"], "words": f["x"], "linked": f["y"]} for f in facts if f["kind"] == SLOT]
                out.append({**row, "slots": slots})
            yield pa.RecordBatch.from_pylist(out, schema=_TEMPLATE_ARROW)

    sized = F.aggregate("classes", F.lit(0), lambda n, c: n + F.size(c["members"]))
    facts = _joined(seqs.select("host", "seq"), classes, sized, "inner").mapInArrow(learn, FACTS)
    facts = facts.groupBy("host", "kind", "a", "b", "c").agg(
        F.sum("x").alias("x"), F.sum("y").alias("y"), F.min("seq").alias("least"), F.max("seq").alias("most")
    )
    listed = facts.groupBy("host").agg(
        F.collect_list(F.struct("kind", "a", "b", "c", "x", "y", "least", "most")).alias("facts")
    )
    hosts = found.join(classes, "host").join(listed, "host")
    return materialised(hosts.mapInArrow(arrange, TEMPLATES), "templates")


_LONG = pa.int64()
_TEMPLATE_ARROW = pa.schema(
    [
        ("host", pa.string()),
        ("pages", _LONG),
        ("texts", _LONG),
        ("tokens", pa.list_(pa.struct([("token", _LONG), ("word", pa.string())]))),
        (
            "classes",
            pa.list_(
                pa.struct(
                    [("support", _LONG), ("number", _LONG), ("parent", _LONG), ("slot", _LONG), ("tokens", pa.list_(_LONG))]
                )
            ),
        ),
        ("slots", pa.list_(pa.struct([("token", _LONG), ("words", _LONG), ("linked", _LONG)]))),
    ]
)


# --- step 4: what is left ------------------------------------------------------------------


class Template:
    """What a host's template says of a page."""

    def __init__(self, row: dict | None = None):
        tokens, classes, slots = (row["tokens"], row["classes"], row["slots"]) if row else ([], [], [])
        self.taker = Known(_tokens(tokens))
        self.words = {k for k, t in enumerate(tokens) if t["word"] is not None}
        # Words that may be cut from articles.
        copies = not row or row["texts"] < MANY or 2 * row["texts"] < row["pages"]
        steady = [] if copies else [c for c in classes if 100 * c["support"] >= STEADY * row["pages"]]
        self.furniture = self.words.intersection(*[{k for c in steady for k in c["tokens"]}])
        # Slots are named by the tokens of all classes, as they were counted; -1 is before any.
        self.scores = {s["token"]: s["words"] - 2 * s["linked"] for s in slots}
        best = max(self.scores.values(), default=0)
        self.slots = {t for t, v in self.scores.items() if v > 0 and 100 * v >= SLOT_SHARE * best}
        self.parting = {k for c in classes for k in c["tokens"]} | set(self.scores)

    def kept(self, html: str) -> list[str]:
        """The texts of a page's blocks that are main text."""
        numbers = self.taker.numbers
        numbers.clear()
        blocks = read(html, self.taker)
        free = [b for b in blocks if not self._is_furniture(numbers, b)]
        if any(b.main for b in blocks):
            return [b.text for b in free if b.main]
        slots = self._slots(numbers, free)
        kept = [
            2 * b.linked < b.words and (slot in self.slots or slot not in self.scores)
            for b, slot in zip(free, slots, strict=True)
        ]
        # A headline stands in a slot of its own before the text.
        for i, b in enumerate(free):
            if b.heading and 2 * b.linked < b.words and any(kept[i + 1 : i + 3]):
                kept[i] = True
        return [b.text for b, keep in zip(free, kept, strict=True) if keep]

    def _is_furniture(self, numbers: list[int], b: Block) -> bool:
        if not self.furniture:
            return False
        words = [k for k in numbers[b.first : b.last] if k in self.words]
        return len(words) == b.words > 0 and self.furniture.issuperset(words)

    def _slots(self, numbers: list[int], blocks: list[Block]) -> list[int]:
        """Of each block, the last template token before its end (-1: none)."""
        out, at, last = [], 0, -1
        for b in blocks:
            for k in numbers[at : b.last]:
                if k in self.parting:
                    last = k
            at = b.last
            out.append(last)
        return out


def main_text(pages: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """(page_id, url, text) of every page; ``found`` are its hosts' templates."""
    found = templates(pages) if found is None else found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Template] = {}
        for batch in batches:
            names = {n: i for i, n in enumerate(batch.schema.names)}
            out = []
            template = batch.column(names["template"])
            hosts, pages = (batch.column(names[c]).to_pylist() for c in ("host", "html"))
            for i, (host, html) in enumerate(zip(hosts, pages, strict=True)):
                if host not in known:
                    known[host] = Template(template[i].as_py())
                out.append("\n".join(known[host].kept(html)))
            yield _batch(
                page_id=batch.column(names["page_id"]), url=batch.column(names["url"]), text=pa.array(out, pa.string())
            )

    size = F.size("template.tokens") + F.size("template.slots")
    by_host = found.select("host", F.struct("pages", "texts", "tokens", "classes", "slots").alias("template"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return _joined(with_hosts(pages), by_host, size, "left").mapInArrow(run, f"page_id {kind}, url string, text string")


@query("op13_main_text", OP13_SQL)
def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    text = main_text(table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.length("text").cast("long"))
