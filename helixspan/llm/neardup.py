"""Near-duplicate classes with BagMinHash over multisets of word shingles.

Every shingle of five words is an element whose weight is how often it occurs. Weights are
cut into dyadic levels; each level of an element is a Poisson process of points in time,
and a point below the element's weight competes for a random register of the signature.
The earliest point of a register wins, so two registers agree with probability equal to
the weighted Jaccard similarity. Only points before a deadline that fills the registers
are drawn.

Signatures are banded. Texts with the same words are one node; nodes that share a band are
candidates, and a link needs the exact overlap of both multisets. First every node meets
the weightiest node of its buckets, as a copy meets its original, and components are
formed. In a bucket that still has several components, the nodes outside its largest
component meet all nodes of other components, in blocks: a task holds ``CHUNK`` nodes and
lets a part of the bucket stream by. Nodes of one component need no test, so no link
between components is lost, and no list of pairs is ever made.

Defined cases: a null text is alike with nothing; texts without words are alike only if
they are equal; a text of fewer than five words is one shingle; a null id comes last when
a class chooses its document; repeated rows are one class; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from helixspan.llm.components import connected_components
from helixspan.llm.texts import boxed, in_box, per_text, pick, unboxed
from helixspan.session import hand_over

SHINGLE = 5
#: Similarity of at least LINK = 4 / 5.
LINK = (4, 5)
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
#: Words whose hash a task remembers.
REMEMBERED = 300_000
#: Nodes that a block holds, and nodes of a bucket that stream by in one task.
CHUNK, PART = 256, 4096
WORDS = re.compile(r"\w+")
GOLD = np.uint64(0x9E3779B97F4A7C15)
STEP = 0x9E3779B97F4A7C15


def times(factor: int, by: int = STEP) -> np.uint64:
    """Product of two numbers in 64 bits."""
    return np.uint64(factor * by % (1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from 53 bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


class Shingles:
    """Word lists to shingle hashes; hashes of frequent words are remembered."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def hashes(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        out = []
        for word in words:
            value = known.get(word)
            if value is None:
                value = known[word] = xxhash.xxh64_intdigest(word)
            out.append(value)
        codes = np.array(out, np.uint64)
        size = min(SHINGLE, len(codes))
        n = len(codes) - size + 1 if size else 0
        total = np.full(max(n, 0), np.uint64(size))
        for k in range(size):
            total = mix(total * GOLD + codes[k : k + n])
        return total


def signatures(element: np.ndarray, count: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """n x REGISTERS values for n multisets given as (element, count, owner) triples."""
    m = REGISTERS
    weight = np.bincount(owner, count, n)
    deadline = (np.log(m) + 4.0) / np.maximum(weight, 1)
    best = np.full(n * m, np.inf)
    value = np.zeros(n * m, np.uint64)
    todo = np.ones(n, bool)
    todo[weight == 0] = False
    while todo.any():
        points = [p for p in levels(element, count, owner, deadline, todo)]
        register = np.concatenate([p[0] for p in points])
        time = np.concatenate([p[1] for p in points])
        point = np.concatenate([p[2] for p in points])
        order = np.lexsort((time, register))
        register, time, point = register[order], time[order], point[order]
        first = np.r_[True, register[1:] != register[:-1]] if len(register) else np.zeros(0, bool)
        best[register[first]] = time[first]
        value[register[first]] = point[first]
        todo &= np.isinf(best.reshape(n, m)).any(axis=1)
        deadline[todo] *= 2
    return value.reshape(n, m)


def levels(element, count, owner, deadline, todo):
    """Points (register of its owner, time, value) before the deadline, level by level."""
    m, level, low, width = REGISTERS, 0, 0, 1
    while True:
        here = (count > low) & todo[owner]
        if not here.any():
            break
        seed = mix(element[here] + times(level + 1, 0xD6E8FEB86659FD93))
        who, most = owner[here], count[here]
        time = np.zeros(len(seed))
        turn = 1
        while len(seed):
            draw = mix(seed + times(turn))
            time = time - np.log(unit(draw)) / (m * width)
            early = time <= deadline[who]
            seed, who, most, time, draw = seed[early], who[early], most[early], time[early], draw[early]
            place = mix(draw + np.uint64(1))
            register = ((place >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            inside = low + width * unit(mix(draw + np.uint64(2))) <= most
            yield (who[inside] * m + register[inside].astype(np.int64), time[inside], draw[inside])
            turn += 1
        level, low, width = level + 1, low + width, max(1, low + width)


def bands_of(signature: np.ndarray) -> np.ndarray:
    """One hash per band; the number of the band is part of it."""
    rows = signature.reshape(len(signature), BANDS, ROWS)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * GOLD, rows.shape[:2])
    for r in range(ROWS):
        total = mix(total + rows[:, :, r])
    return total.view(np.int64)


def describe():
    """Texts to (key of the words, number of shingles, bands); null without words."""
    shingles = Shingles()

    def work(texts: list[str | None]) -> list[tuple]:
        parts, keys = [], []
        for text in texts:
            words = WORDS.findall(text.lower()) if text is not None else []
            named = " ".join(words) if words else f"raw {text}"
            keys.append(None if text is None else hashlib.md5(named.encode(), usedforsecurity=False).hexdigest())
            parts.append(shingles.hashes(words))
        element, count, owner = [], [], []
        for i, part in enumerate(parts):
            found, times = np.unique(part, return_counts=True)
            element.append(found)
            count.append(times)
            owner.append(np.full(len(found), i))
        signature = signatures(
            np.concatenate(element), np.concatenate(count), np.concatenate(owner).astype(np.int64), len(texts)
        )
        bands = bands_of(signature)
        return [
            (key, len(part), row.tolist() if len(part) else [])
            for key, part, row in zip(keys, parts, bands, strict=True)
        ]

    return work


def multisets():
    shingles = Shingles()

    def work(texts: list[str | None]) -> list[tuple]:
        rows = []
        for text in texts:
            words = WORDS.findall(text.lower()) if text else []
            items, counts = np.unique(shingles.hashes(words).view(np.int64), return_counts=True)
            rows.append((items.tolist(), counts.tolist()))
        return rows

    return work


def alike(size: int, items: np.ndarray, counts: np.ndarray, size2: int, items2: np.ndarray, counts2: np.ndarray) -> bool:
    """Whether two multisets with sorted items have a similarity of at least LINK."""
    low, high = LINK
    if high * min(size, size2) < low * max(size, size2):
        return False
    place = np.searchsorted(items, items2)
    place[place == len(items)] = 0
    hit = items[place] == items2
    common = int(np.minimum(counts[place[hit]], counts2[hit]).sum())
    return (low + high) * common >= low * (size + size2)


@F.pandas_udf(T.BooleanType())
def alike_rows(
    size_a: pd.Series, items_a: pd.Series, counts_a: pd.Series,
    size_b: pd.Series, items_b: pd.Series, counts_b: pd.Series,
) -> pd.Series:
    return pd.Series(
        [alike(*row) for row in zip(size_a, items_a, counts_a, size_b, items_b, counts_b, strict=True)], dtype=bool
    )


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose multisets overlap enough."""

    def of(side: str) -> DataFrame:
        return sets.select(*[F.col(c).alias(f"{c}_{side}") for c in ("node", "size", "items", "counts")])

    both = pairs.join(of("a"), F.col("a") == F.col("node_a")).join(of("b"), F.col("b") == F.col("node_b"))
    columns = [f"{c}_{side}" for side in "ab" for c in ("size", "items", "counts")]
    return both.where(alike_rows(*columns)).select("a", "b")


def block_rows(open_: DataFrame) -> DataFrame:
    """(bucket, node, component) -> rows of blocks (bucket, chunk, part): side 0 is held, side 1 streams.

    A node outside the largest component is held in one chunk, for every part; each node
    streams once for every chunk that has to see it, so pairs of held nodes meet once.
    """
    sizes = open_.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("all"))
    rows = open_.join(main.where("main.n < all"), "bucket").withColumns(
        {
            "outside": F.col("component") != F.col("main.component"),
            "chunks": F.ceil((F.col("all") - F.col("main.n")) / CHUNK).cast("int"),
            "parts": F.ceil(F.col("all") / PART).cast("int"),
        }
    )
    own = F.pmod(F.xxhash64("node", F.lit("chunk")), F.col("chunks").cast("long")).cast("int")
    part = F.pmod(F.xxhash64("node", F.lit("part")), F.col("parts").cast("long")).cast("int")
    rows = rows.withColumns({"own": F.when(F.col("outside"), own).otherwise(F.col("chunks") - 1), "part": part})

    def place(chunk, part, side):
        return F.struct(chunk.alias("chunk"), part.alias("part"), F.lit(side).alias("side"))

    held = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: place(F.col("own"), p, 0))
    passing = F.transform(F.sequence(F.lit(0), F.col("own")), lambda c: place(c, F.col("part"), 1))
    places = F.when(F.col("outside"), F.concat(held, passing)).otherwise(passing)
    return rows.select("bucket", "node", "component", "outside", "own", F.inline(places))


def block_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links between components, from sorted block rows; a link that follows from others is left out."""
    key, held, stacked = None, [], None
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for batch in batches:
        links = []
        for row in batch.itertuples(index=False):
            if (row.bucket, row.chunk, row.part) != key:
                key, held, stacked, parent = (row.bucket, row.chunk, row.part), [], None, {}
            if row.side == 0:
                held.append(row)
                continue
            if not held:
                continue  # by chance no node was dealt to this chunk
            if stacked is None:
                stacked = (
                    np.array([h.size for h in held]),
                    np.array([h.component for h in held]),
                    np.array([h.node for h in held]),
                    np.stack([h.bands for h in held]),
                )
            sizes, components, nodes, bands = stacked
            same = bands == np.asarray(row.bands)
            first = same.argmax(axis=1)
            # Nodes that share several buckets are compared in the first of them only.
            here = same.any(axis=1) & (bands[np.arange(len(bands)), first] == row.bucket)
            here &= components != row.component
            if row.outside and row.own == row.chunk:
                here &= nodes < row.node
            low, high = LINK
            here &= high * np.minimum(sizes, row.size) >= low * np.maximum(sizes, row.size)
            for i in np.flatnonzero(here):
                other = held[i]
                one, two = root(row.component), root(other.component)
                if one != two and alike(row.size, row.items, row.counts, other.size, other.items, other.counts):
                    parent[one] = two
                    links.append((min(row.node, other.node), max(row.node, other.node)))
        yield pd.DataFrame(links, columns=["a", "b"])


def node_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """node, component of all nodes that are linked; ``members`` has (bucket, node).

    The weight of a node is how many nodes its buckets hold.
    """
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    weight = members.join(sizes, "bucket").groupBy("node").agg(F.sum("n").alias("weight"))
    rank = F.struct((-F.col("weight")).alias("w"), "node").alias("rank")
    ranked = hand_over(members.join(weight, "node").select("bucket", rank), "ranked")
    centres = ranked.groupBy("bucket").agg(F.min("rank").alias("pivot"))
    nearest = (
        ranked.join(centres, "bucket").where("pivot < rank")
        .groupBy(F.col("rank.node").alias("b")).agg(F.min("pivot").alias("pivot"))
        .select(F.col("pivot.node").alias("a"), "b")
    )
    links = hand_over(verified(hand_over(nearest, "nearest"), sets), "links")
    labels = hand_over(connected_components(links, "a", "b"), "labels")
    open_ = hand_over(
        members.join(labels, "node", "left").select(
            "bucket", "node", F.coalesce("component", "node").alias("component")
        ),
        "open",
    )
    blocks = hand_over(block_rows(open_), "blocks")
    filled = (
        blocks.join(sets, "node")
        .repartition("bucket", "chunk", "part")
        .sortWithinPartitions("bucket", "chunk", "part", "side", "node")
    )
    more = hand_over(filled.mapInPandas(block_links, "a long, b long"), "links")
    return hand_over(connected_components(links.unionByName(more), "a", "b"), "labels")


def described(docs: DataFrame) -> DataFrame:
    """uid, doc_id, mark (hash of the text), key, size, bands of every document."""
    describe_text = per_text(describe, "key string, size int, bands array<bigint>")
    return hand_over(
        pick(docs, "doc_id", "text").select(
            F.monotonically_increasing_id().alias("uid"),
            "doc_id",
            F.xxhash64("text").alias("mark"),
            describe_text(F.col("text")).alias("d"),
        ).select("uid", "doc_id", "mark", "d.*"),
        "described",
    )


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(uid, doc_id, mark, component, key) per document and (component, class_id, first) per class.

    ``first`` is (no id, doc_id, uid) of the document that stands for the class.
    """
    rows = described(docs)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid", "mark"))
    nodes = hand_over(
        rows.where("key IS NOT NULL")
        .groupBy("key")
        .agg(least.alias("first"), F.first("size").alias("size"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    each = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = hand_over(each.join(shared, "bucket"), "members")
    candidates = hand_over(
        members.select("node").distinct().join(nodes, "node").select(
            "node", "first.doc_id", "first.mark", "size", "bands"
        ),
        "candidates",
    )
    texts = pick(docs, "doc_id", "text").withColumn("mark", F.xxhash64("text"))
    same = texts["doc_id"].eqNullSafe(candidates["doc_id"]) & (texts["mark"] == candidates["mark"])
    multiset = per_text(multisets, "items array<bigint>, counts array<int>")
    sets = hand_over(
        texts.join(candidates, same)
        .select("node", "size", "bands", multiset(F.col("text")).alias("m"))
        .select("node", "size", "bands", "m.*")
        .groupBy("node")
        .agg(*[F.first(c).alias(c) for c in ("size", "bands", "items", "counts")]),
        "sets",
    )
    labels = node_links(members, sets)
    placed = hand_over(
        nodes.join(labels, "node", "left").select(
            "key", F.coalesce("component", "node").alias("component"), "first"
        ),
        "placed",
    )
    class_of = placed.groupBy("component").agg(F.min("first").alias("first"))
    return rows.join(placed.select("key", "component"), "key", "left"), hand_over(class_of, "classes")


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its class), kept (the one document that stays).

    A document without text is a class of its own, named by its own id.
    """
    rows, class_of = classes(docs)
    joined = rows.join(class_of, "component", "left")
    return joined.select(
        "doc_id",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        (F.col("component").isNull() | (F.col("uid") == F.col("first.uid"))).alias("kept"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """One document of each class, with its columns; documents without text all stay.

    Documents are found again by id and hash of the text. Only where a kept row has exact
    repeats, they are reduced to one.
    """
    names = docs.columns
    rows, class_of = classes(docs)
    kept = hand_over(
        rows.join(class_of, "component")
        .where((F.col("doc_id").eqNullSafe(F.col("first.doc_id"))) & (F.col("mark") == F.col("first.mark")))
        .groupBy(F.col("doc_id").alias("kept_id"), F.col("mark").alias("kept_mark"))
        .agg(F.count(F.lit(1)).alias("times")),
        "kept",
    )
    text = in_box(names, "text")
    whole = boxed(docs).withColumns({"id": in_box(names, "doc_id"), "mark": F.xxhash64(text)})
    stays = whole.where(text.isNotNull()).join(
        kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("mark") == F.col("kept_mark"))
    )
    single = stays.where("times = 1").select("row")
    repeated = stays.where("times > 1").groupBy("id", "mark").agg(F.first("row").alias("row")).select("row")
    empty = whole.where(text.isNull()).select("row")
    return unboxed(single.unionByName(repeated).unionByName(empty), names)
