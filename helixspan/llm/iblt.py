"""Document fingerprints as invertible Bloom lookup sketches, with DataFrame functions only.

A text is the set of digests of its paragraphs: lines, cut after every word whose hash
says so. Where a line is cut depends on the words there and not on their distance from its
start, so pieces behind an insertion stay as they were. A sketch has three subtables of
cells with a count, the XOR of the digests and the XOR of their check hashes. Sketches
subtract cell by cell, which leaves the digests that differ; cells that hold a single digest
are peeled until nothing is left. The stored sketches are subtracted first; only where
peeling stops short, the pair is sketched again with larger tables, until it succeeds.

Cells are rows that are grouped by (document, pair, cell). The documents are dealt by
their number once, so building, subtracting and all peeling rounds run within a stage.

Defined cases: a null text is an empty one; two texts without digests are alike (1.0); a
null doc_id comes last in the order of documents; documents with equal ids are ordered by
hash of the text, then text; a single document is its own next one; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window, functions as F

from helixspan.llm.texts import pick
from helixspan.session import hand_over, settings

#: A text is cut after one word in 16, and one below 512 code points once more after one
#: in 2, so that short texts have several digests as well.
COARSE, FINE, SHORT = 16, 2, 512
#: Where blanks are further apart than this (scripts without blanks, codes), every
#: character counts as a word.
LONGEST_WORD = 64
SUBTABLES = 3
#: Cells per subtable of the stored fingerprint.
WIDTH = 8
#: Rounds of peeling, each over one subtable, before a larger table is tried.
ROUNDS = 12
#: How much wider the tables of a further attempt are, until they hold all digests of both.
GROWTH = 8
#: Sections of the document order per shuffle partition, and at most.
SECTIONS_PER_PARTITION, MAX_SECTIONS = 8, 65536


#: The rounds are many small aggregations in one stage. Each would reserve a memory page
#: for its first-level map before the first row arrives; the second level needs none.
ONE_LEVEL = {"spark.sql.codegen.aggregate.map.twolevel.enabled": "false"}


def pieces(text: Column, every: int) -> Column:
    """Digests of the pieces, each up to a line end or a word whose hash is divisible."""

    def cut(word: Column) -> Column:
        return F.when(F.pmod(F.xxhash64(word), F.lit(every)) == 0, F.concat(word, F.lit("\n"))).otherwise(word)

    def cut_inside(word: Column) -> Column:
        return F.array_join(F.transform(F.regexp_extract_all(word, F.lit("(?s)."), F.lit(0)), cut), "")

    marked = F.transform(
        F.split(text, " "), lambda w: F.when(F.length(w) > LONGEST_WORD, cut_inside(w)).otherwise(cut(w))
    )
    found = F.filter(F.split(F.array_join(marked, " "), "\n"), lambda p: p != "")
    return F.array_distinct(F.transform(found, lambda p: F.xxhash64(p)))


def digests(text: Column) -> Column:
    found = pieces(text, COARSE)
    return F.when(F.length(text) < SHORT, F.array_union(found, pieces(text, FINE))).otherwise(found)


def check_of(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check"))


def cell_of(digest: Column, subtable: int, width: Column, seed: Column) -> Column:
    place = F.pmod(F.xxhash64(digest, F.lit(subtable), seed), width.cast("long"))
    return (width * subtable + place).cast("int")


def sketch(texts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, width, seed, digests (array) -> one row per used cell with n, digest, checks."""
    each = texts.select(*keys, "width", "seed", F.explode("digests").alias("digest"))
    cells = F.array(*[cell_of(F.col("digest"), j, F.col("width"), F.col("seed")) for j in range(SUBTABLES)])
    return (
        each.withColumn("checks", check_of(F.col("digest")))
        .select("*", F.explode(cells).alias("cell"))
        .groupBy(*keys, "width", "seed", "cell")
        .agg(
            F.count(F.lit(1)).cast("int").alias("n"),
            F.bit_xor("digest").alias("digest"),
            F.bit_xor("checks").alias("checks"),
        )
    )


def subtract(cells: DataFrame, keys: list[str], sign: Column) -> DataFrame:
    """Sum of signed sketches; cells that cancel out are gone."""
    return gather(cells.withColumn("n", F.col("n") * sign), [*keys, "width", "seed", "cell", "found"])


def gather(cells: DataFrame, keys: list[str]) -> DataFrame:
    return (
        cells.groupBy(*keys)
        .agg(
            F.sum("n").cast("int").alias("n"),
            F.bit_xor("digest").alias("digest"),
            F.bit_xor("checks").alias("checks"),
        )
        .where("n != 0 OR digest != 0 OR checks != 0")
    )


def peel(cells: DataFrame, keys: list[str], rounds: int = ROUNDS, keep: bool = False) -> DataFrame:
    """Recovered digests as rows with cell -1 (only left) or -2 (only right), and what is left.

    Within a subtable a digest has one cell, so a round never peels it twice. With ``keep``
    the recovered digests stay apart in column found, else they are counted.
    """
    columns = [*keys, "width", "seed", "cell", "found"]
    for r in range(rounds):
        j = r % SUBTABLES
        digest = F.col("digest")
        pure = (
            (F.col("cell") >= F.col("width") * j)
            & (F.col("cell") < F.col("width") * (j + 1))
            & (F.abs("n") == 1)
            & (F.col("checks") == check_of(digest))
        )

        def row(cell: Column, n: Column, found: Column) -> Column:
            return F.struct(
                cell.cast("int").alias("cell"),
                found.cast("long").alias("found"),
                n.cast("int").alias("n"),
                F.col("digest"),
                F.col("checks"),
            )

        none = F.lit(None)
        gone = [
            row(cell_of(digest, k, F.col("width"), F.col("seed")), -F.col("n"), none)
            for k in range(SUBTABLES)
            if k != j
        ]
        side = F.when(F.col("n") > 0, -1).otherwise(-2)
        recovered = row(side, F.lit(1), digest if keep else none)
        itself = row(F.col("cell"), F.col("n"), F.col("found"))
        step = F.when(pure, F.array(*gone, recovered)).otherwise(F.array(itself))
        cells = gather(cells.select(*keys, "width", "seed", F.inline(step)), columns)
    return cells


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id, text and the text of the next document in descending doc_id, wrapping around.

    The order is cut into sections at approximate quantiles of (doc_id, hash of the text),
    and the first document of each section is also sent to the section before it. The
    quantiles and the table of first documents have at most ``MAX_SECTIONS`` rows.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = min(MAX_SECTIONS, SECTIONS_PER_PARTITION * partitions)
    lowest = F.lit(-(1 << 63)).cast("long")
    keyed = pick(docs, "doc_id", "text").select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.bitwise_not(F.coalesce(F.col("doc_id").cast("long"), lowest)).alias("o"),
    )
    found = keyed.agg(F.percentile_approx("o", [i / n for i in range(1, n)], 4 * n)).first()[0]
    first, second = section_bounds(found or [])
    keyed = keyed.withColumn("h", F.xxhash64("text"))
    keyed = keyed.withColumn("section", section_of(F.col("o"), F.col("h"), first, second))
    heads = keyed.groupBy("section").agg(F.min(F.struct("o", "h")).alias("head"))
    along = Window.orderBy("section")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = hand_over(
        heads.select(
            F.col("section").alias("s"),
            "head",
            F.coalesce(F.lag("section").over(along), F.max("section").over(whole)).alias("before"),
        ),
        "heads",
    )
    is_head = (F.col("section") == F.col("s")) & (F.struct("o", "h") == F.col("head"))
    both = F.array_compact(
        F.array(
            F.struct(F.col("section"), F.lit(0).alias("tail")),
            F.when(
                F.col("before").isNotNull(),
                F.struct(F.col("before").alias("section"), F.lit(1).alias("tail")),
            ),
        )
    )
    placed = (
        keyed.join(F.broadcast(heads), is_head, "left")  # at most MAX_SECTIONS small rows
        .select("doc_id", "text", "o", "h", F.inline(both))
    )
    order = Window.partitionBy("section").orderBy("tail", "o", "h", "text")
    return (
        placed.withColumn("next_text", F.lead("text").over(order))
        .where("tail = 0")
        .select("doc_id", "text", "next_text")
    )


def section_bounds(found: list[int]) -> tuple[list[int], list[int]]:
    """Sorted bounds (value, hash); a value that fills several quantiles is cut by hash."""
    first, second = [], []
    for value, times in sorted(Counter(found).items()):
        for i in range(times):
            first.append(value)
            second.append(-(1 << 63) + i * (1 << 64) // times)
    return first, second


def section_of(o: Column, h: Column, first: list[int], second: list[int]) -> Column:
    """Number of bounds at or before (o, h), by binary search in two constant arrays."""
    if not first:
        return F.lit(0)
    values = F.split(F.lit(",".join(map(str, first))), ",").cast("array<bigint>")
    hashes = F.split(F.lit(",".join(map(str, second))), ",").cast("array<bigint>")
    steps = [1 << b for b in range(len(first).bit_length() - 1, -1, -1)]

    def move(at: Column, step: Column) -> Column:
        to = at + step
        inside = F.least(to, F.lit(len(first)))
        value, cut = F.element_at(values, inside), F.element_at(hashes, inside)
        return F.when(
            (to <= len(first)) & ((value < o) | ((value == o) & (cut <= h))), to
        ).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), move)


def versions(docs: DataFrame) -> DataFrame:
    """Per document: number, n_chars, edited_sha256, and the digests of own, edited and next text."""
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars") - half),
        F.substring(F.col("next_text"), F.lit(1), half),
    )
    return (
        in_order(docs)
        .withColumn("n_chars", F.length("text"))
        .withColumn("edited", edited)
        .select(
            F.monotonically_increasing_id().alias("number"),
            "doc_id",
            F.col("n_chars").cast("long"),
            F.sha2("edited", 256).alias("edited_sha256"),
            digests(F.col("text")).alias("own"),
            digests(F.col("edited")).alias("edited"),
            digests(F.col("next_text")).alias("next"),
        )
    )


def written(texts: DataFrame) -> DataFrame:
    """number, side, digests -> number, side, sketch of ``WIDTH`` cells per subtable as a string.

    The width is fixed, so every cell is an aggregate of its own over the digests.
    """
    digest, seed, width = F.col("digest"), F.lit(0), F.lit(WIDTH)
    each = texts.select("number", "side", F.explode("digests").alias("digest")).withColumns(
        {"checks": check_of(digest)}
        | {f"p{j}": cell_of(digest, j, width, seed) for j in range(SUBTABLES)}
    )
    cells = []
    for j in range(SUBTABLES):
        for c in range(j * WIDTH, (j + 1) * WIDTH):
            here = F.col(f"p{j}") == c
            cells += [
                F.count_if(here).alias(f"n{c}"),
                F.bit_xor(F.when(here, digest).otherwise(0)).alias(f"d{c}"),
                F.bit_xor(F.when(here, F.col("checks")).otherwise(0)).alias(f"c{c}"),
            ]
    sums = each.groupBy("number", "side").agg(*cells)
    text = F.concat_ws(
        ";",
        *[
            F.concat_ws(":", F.col(f"n{c}").cast("string"), F.hex(f"d{c}"), F.hex(f"c{c}"))
            for c in range(SUBTABLES * WIDTH)
        ],
    )
    return sums.select("number", "side", text.alias("sketch"))


def outcome(peeled: DataFrame) -> DataFrame:
    """number, pair, differing digests, and whether cells are left."""
    return peeled.groupBy("number", "pair").agg(
        F.sum(F.when(F.col("cell") < 0, F.col("n")).otherwise(0)).alias("differing"),
        (F.count_if(F.col("cell") >= 0) > 0).alias("stuck"),
    )


def again(pairs: DataFrame, attempt: int) -> DataFrame:
    """Outcome of pairs (number, pair, own, other): the first attempt subtracts sketches as
    stored, a further one has ``GROWTH`` times the cells and another seed. Tables grow no
    further than to hold the digests of both texts, and twice that from then on."""
    both = F.greatest(F.size("own") + F.size("other"), F.lit(WIDTH))
    all_of_both = F.pow(F.lit(2.0), F.ceil(F.log2(both)))
    grown = F.lit(float(WIDTH) * GROWTH ** (attempt - 1))
    # Attempts that the pair has made since its tables could hold everything.
    spare = F.greatest(F.floor(F.log2(grown / all_of_both) / F.log2(F.lit(float(GROWTH)))), F.lit(0))
    width = F.least(grown, all_of_both * F.pow(F.lit(2.0), spare)).cast("int")
    parts = F.array(
        F.struct(F.lit(0).alias("side"), F.col("own").alias("digests")),
        F.struct(F.lit(1).alias("side"), F.col("other").alias("digests")),
    )
    keys = ["number", "pair"]
    texts = pairs.select(*keys, width.alias("width"), F.lit(attempt - 1).alias("seed"), F.inline(parts))
    cells = sketch(texts, [*keys, "side"]).withColumn("found", F.lit(None).cast("long"))
    sign = F.when(F.col("side") == 0, 1).otherwise(-1)
    return outcome(peel(subtract(cells, keys, sign), keys))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Likeness is 1 - differing digests / digests of both texts. Further columns: the digests
    recovered per pair (differ_edited, differ_next) and the attempts it took (tries_edited,
    tries_next; 1 if the stored sketches were enough).
    """
    spark = docs.sparkSession
    base = hand_over(versions(docs), "versions")
    others = F.array(
        *[F.struct(F.lit(i).alias("pair"), F.col(c).alias("other")) for i, c in ((1, "edited"), (2, "next"))]
    )
    pairs = base.select("number", "own", "edited", "next").repartition("number")
    pairs = pairs.select("number", "own", F.inline(others))
    solved, attempt = [], 1
    while True:
        with settings(spark, ONE_LEVEL):
            found = hand_over(again(pairs, attempt), "peeled")
        solved.append(found.where("NOT stuck").withColumn("tries", F.lit(attempt)))
        stuck = found.where("stuck").select("number", "pair")
        if stuck.isEmpty():
            break
        attempt += 1
        chosen = base.join(stuck, "number")
        other = F.when(F.col("pair") == 1, F.col("edited")).otherwise(F.col("next"))
        pairs = chosen.select("number", "pair", "own", other.alias("other"))
    all_solved = solved[0]
    for more in solved[1:]:
        all_solved = all_solved.unionByName(more)
    per_doc = all_solved.groupBy("number").agg(
        *[F.max(F.when(F.col("pair") == p, F.col("differing"))).alias(f"d{p}") for p in (1, 2)],
        *[F.max(F.when(F.col("pair") == p, F.col("tries"))).alias(f"t{p}") for p in (1, 2)],
    )
    sides = F.array(
        *[F.struct(F.lit(i).alias("side"), F.col(c).alias("digests")) for i, c in enumerate(("own", "edited"))]
    )
    dealt = base.select("number", "own", "edited").repartition("number")
    sketches = written(dealt.select("number", F.inline(sides)))
    prints = sketches.groupBy("number").agg(
        *[F.max(F.when(F.col("side") == i, F.col("sketch"))).alias(f"s{i}") for i in (0, 1)]
    )
    rows = base.select(
        "number", "doc_id", "n_chars", "edited_sha256",
        *[F.size(c).alias(f"n_{c}") for c in ("own", "edited", "next")],
    )

    def near(differing: str, against: str) -> Column:
        total = F.col("n_own") + F.col(against)
        return F.when(total == 0, 1.0).otherwise(1.0 - F.coalesce(differing, F.lit(0)) / total)

    empty = F.lit(";".join(["0:0:0"] * (SUBTABLES * WIDTH)))
    return (
        rows.join(per_doc, "number", "left")
        .join(prints, "number", "left")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            F.coalesce("s0", empty).alias("fingerprint"),
            F.coalesce("s1", empty).alias("edited_fingerprint"),
            near("d1", "n_edited").alias("near_edited"),
            near("d2", "n_next").alias("near_next"),
            *[F.coalesce(f"d{p}", F.lit(0)).cast("long").alias(f"differ_{c}") for p, c in ((1, "edited"), (2, "next"))],
            *[F.coalesce(f"t{p}", F.lit(1)).alias(f"tries_{c}") for p, c in ((1, "edited"), (2, "next"))],
        )
    )
