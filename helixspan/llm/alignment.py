"""Links between the tokens of two tokenizers, counted over the corpus.

Both tokenizers spell out the same bytes. Places where a token of each ends cut a text
into groups; tokens whose byte ranges overlap are linked. The count of an id pair is the
number of documents that hold it linked, and every document gets back what its links add
up to. The pairs are counted outside of memory:

- **Runs.** A task collects (pair, document) records, sorts them and spills them as a run
  of compressed pieces, one per radix of the first tokenizer's id. A piece holds the
  distinct pairs with their number of documents, and apart from them the documents.
- **Counting.** Pieces of a radix are merged with a heap, a bounded number at a time, until
  one is left: (pair, count) in the order of the first tokenizer's ids. Only distinct pairs
  travel, so a pair that every document holds is one entry a run.
- **Contributions.** The runs of a radix stream past its counts. All pairs of an id of the
  first tokenizer lie together, which gives the highest count of each. What a document's
  links add up to goes back to the run it came from.

Words are encoded once per task: before a space that follows a visible character both
tokenizers always start a new token, the first by its pattern, the second because none of
its entries goes on with a space (``check_cuts``). So tokens, groups and links of a word
don't depend on its neighbours.

Defined cases: null and empty texts, and texts that one of the vocabularies cannot spell
out, have no tokens, zeros and an empty digest; repeated documents count each; equal or
null ids are kept apart by run and position; a single very long text makes a long run;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from helixspan.llm.texts import parts_by_size, pick
from helixspan.session import hand_over

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bits of an id, and of a document's position in its run.
ID_BITS, PLACE_BITS = 17, 22
#: Low bits of the first id that choose the radix.
RADIX_BITS = 6
#: Links and documents after which a run is spilled.
RUN_LINKS, RUN_DOCS = 1 << 21, 1 << 16
#: Runs that one merge reads, or that stream past a radix's counts in one task.
FAN = 64
#: Entries of a compressed block.
BLOCK = 1 << 16
#: Characters of the words that a task remembers.
MEMORY = 1 << 22
#: A space after a visible ASCII character, a letter or a digit, and before anything.
CUT = re.compile(r"(?s)(?<=[\w!-~])(?= .)")
CLOSED = re.compile(r"[\w!-~]")
#: Characters of new words that are encoded as one text.
TOGETHER = 1 << 16
SPACE = "▁"


# -- blocks of integers ----------------------------------------------------------------


def packed(*columns: np.ndarray) -> bytes:
    """Integer columns of equal length as blocks: rows, size, and the bytes of equal rank together."""
    press = zstandard.ZstdCompressor(level=1)
    out = []
    for at in range(0, len(columns[0]), BLOCK):
        rows = [np.ascontiguousarray(c[at : at + BLOCK], np.int64) for c in columns]
        planes = [np.diff(rows[0], prepend=0), *rows[1:]]
        body = press.compress(b"".join(p.view(np.uint8).reshape(-1, 8).T.tobytes() for p in planes))
        out += [np.array([len(rows[0]), len(body)], np.int64).tobytes(), body]
    return b"".join(out)


def blocks(data: bytes, columns: int = 2) -> Iterator[list[np.ndarray]]:
    expand = zstandard.ZstdDecompressor()
    at = 0
    while at < len(data):
        n, size = np.frombuffer(data, np.int64, 2, at).tolist()
        raw = expand.decompress(data[at + 16 : at + 16 + size], max_output_size=n * 8 * columns)
        parts = np.frombuffer(raw, np.uint8).reshape(columns, 8, n)
        rows = [np.ascontiguousarray(p.T).view(np.int64).ravel() for p in parts]
        rows[0] = np.cumsum(rows[0])
        yield rows
        at += 16 + size


def unpacked(data: bytes, columns: int = 2) -> list[np.ndarray]:
    found = list(blocks(data, columns))
    if not found:
        return [np.zeros(0, np.int64)] * columns
    return [np.concatenate(c) for c in zip(*found, strict=True)]


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
    return (keys[first], np.add.reduceat(values, first)) if len(keys) else (keys, values)


def merged(pieces: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted pieces of (pair, count) as one, block by block.

    The heap holds every piece by the last pair of its current block. Up to the smallest
    of these, nothing can follow any more, so the entries up to it are summed and emitted.
    """
    streams = [blocks(p) for p in pieces]
    heap = []
    for i, stream in enumerate(streams):
        block = next(stream, None)
        if block:
            heapq.heappush(heap, (int(block[0][-1]), i, block))
    while heap:
        bound = heap[0][0]
        taken, kept = [], []
        for last, i, (keys, counts) in heap:
            upto = int(np.searchsorted(keys, bound, "right"))
            taken.append((keys[:upto], counts[:upto]))
            if upto < len(keys):
                kept.append((last, i, [keys[upto:], counts[upto:]]))
            elif block := next(streams[i], None):
                kept.append((int(block[0][-1]), i, block))
        heap = kept
        heapq.heapify(heap)
        yield summed(*(np.concatenate(c) for c in zip(*taken, strict=True)))


# -- tokens, groups and links ----------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: itself if it prints."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def first_bytes(tokenizer: Tokenizer) -> dict[int, bytes]:
    letters = byte_letters()
    found = {}
    for entry, i in tokenizer.get_vocab(with_added_tokens=False).items():
        found[i] = bytes(letters[c] for c in entry)
    return found


def second_bytes(model: SentencePieceProcessor) -> dict[int, bytes]:
    found = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        found[i] = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode()
    return found


def check_cuts(second: dict[int, bytes]) -> None:
    """No entry of the second vocabulary goes on with a space after something else."""
    for i, spelled in second.items():
        if b" " in spelled.lstrip(b" "):
            raise ValueError(f"entry {i} reaches over a space: words can't be encoded by themselves")


class Words:
    """Both tokenizations of words, remembered until they take too much memory."""

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.first = Tokenizer.from_file(first)
        self.first.encode_special_tokens = True
        self.second = SentencePieceProcessor(model_file=second)
        spelled = first_bytes(self.first), second_bytes(self.second)
        check_cuts(spelled[1])
        self.bytes = [[side.get(i, b"") for i in range(max(side) + 1)] for side in spelled]
        self.lengths = [np.array([len(x) for x in side]) for side in self.bytes]
        # Decimal ids with what follows them in the text of the groups.
        self.marked = [f"{i}{c}" for n, marks in zip(map(len, self.bytes), (",|", ",;"), strict=True) for c in marks for i in range(n)]
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.texts: list[str] = []
        self.spelled: list[bool] = []
        # Four numbers and the links of every word; grown in place.
        self.sizes, self.pairs = array("q"), array("q")
        self.chars = 0

    def cut(self, text: str) -> list[str]:
        """The words of space + text, each with the space before it."""
        return CUT.split(" " + text)

    def look_up(self, words: list[str]) -> list[int]:
        new = [w for w in dict.fromkeys(words) if w not in self.places]
        # Words that end in a blank can't be told from the space of the next one.
        closed = [w for w in new if CLOSED.match(w[-1])]
        now, size = [], 0
        for word in closed:
            now.append(word)
            size += len(word)
            if size >= TOGETHER:
                self.add(now)
                now, size = [], 0
        self.add(now)
        for word in set(new).difference(closed):
            self.add([word])
        return list(map(self.places.__getitem__, words))

    def add(self, words: list[str]) -> None:
        """Learn words by encoding them as one text; the half with a word that can't be spelled is found by splitting."""
        if not words:
            return
        text = "".join(words)
        ids = [
            np.array(self.first.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64),
            np.array(self.second.encode(text[1:], num_threads=1), np.int64),
        ]
        whole = text.encode()
        fits = all(b"".join(map(t.__getitem__, i.tolist())) == whole for t, i in zip(self.bytes, ids, strict=True))
        if fits:
            self.keep(words, ids)
        elif len(words) == 1:
            self.append(words, [0, 0, 0, 0], [""], np.zeros(0, np.int64), False)
        else:
            self.add(words[: len(words) // 2])
            self.add(words[len(words) // 2 :])

    def keep(self, words: list[str], ids: list[np.ndarray]) -> None:
        ends = [np.cumsum(n[i]) for n, i in zip(self.lengths, ids, strict=True)]
        cuts = np.intersect1d(*ends, assume_unique=True)
        word_ends = np.cumsum([len(w.encode()) for w in words])
        if not np.isin(word_ends, cuts).all():
            raise ValueError("a token reaches over the end of a word")
        either, one, two = links(ids[0], ends[0], ids[1], ends[1])
        upto = [np.searchsorted(e, word_ends, "right") for e in (*ends, cuts, either)]
        sizes = np.stack([np.diff(u, prepend=0) for u in upto], axis=1)
        text = self.marked_ids(ids, ends, cuts)
        edges = [0, *(upto[0] + upto[1]).tolist()]
        texts = ["".join(text[a:b]) for a, b in zip(edges, edges[1:])]
        self.append(words, sizes.ravel().tolist(), texts, (turned(one) << ID_BITS) | two, True)

    def marked_ids(self, ids: list[np.ndarray], ends: list[np.ndarray], cuts: np.ndarray) -> list[str]:
        """Ids as `a1,` `a2|` `b1;`: within a group those of the first tokenizer come first."""
        group = [np.searchsorted(cuts, e) for e in ends]
        upto = [np.concatenate([[0], np.searchsorted(e, cuts, "right")]) for e in ends]
        merged_ids = np.empty(sum(map(len, ids)), np.int64)
        base = 0
        for side in (0, 1):
            at = np.arange(len(ids[side])) + upto[1 - side][group[side] + side]
            n = len(self.bytes[side])
            merged_ids[at] = base + ids[side] + n * (ends[side] == cuts[group[side]])
            base += 2 * n
        return list(map(self.marked.__getitem__, merged_ids.tolist()))

    def append(self, words, sizes, texts, pairs, fits: bool) -> None:
        start = len(self.texts)
        self.places.update(zip(words, range(start, start + len(words)), strict=True))
        self.sizes.extend(sizes)
        self.texts += texts
        self.pairs.frombytes(pairs.astype(np.int64).tobytes())
        self.spelled += [fits] * len(words)
        self.chars += sum(map(len, words))


def links(
    a_ids: np.ndarray, a_ends: np.ndarray, b_ids: np.ndarray, b_ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of the stretches between neighbouring ends of any token, and the ids linked in each."""
    ends = np.union1d(a_ends, b_ends)
    return ends, a_ids[np.searchsorted(a_ends, ends)], b_ids[np.searchsorted(b_ends, ends)]


def turned(ids: np.ndarray) -> np.ndarray:
    """Ids with the radix in front; ids of a radix keep their order."""
    low = ids & ((1 << RADIX_BITS) - 1)
    return (low.astype(np.int64) << (ID_BITS - RADIX_BITS)) | (ids >> RADIX_BITS)


RADIX_SHIFT = 2 * ID_BITS - RADIX_BITS


# -- runs ------------------------------------------------------------------------------

DOC_FIELDS = ("n_a", "n_b", "n_groups", "n_links")


def spill(records: list[np.ndarray]) -> Iterator[tuple[int, bytes, bytes]]:
    """(radix, pairs, postings) pieces of the records (pair << PLACE_BITS | place)."""
    both, times = np.unique(np.concatenate(records), return_counts=True)
    pairs, places = both >> PLACE_BITS, both & ((1 << PLACE_BITS) - 1)
    radix = pairs >> RADIX_SHIFT
    edges = np.flatnonzero(np.concatenate([[True], radix[1:] != radix[:-1]]))
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(radix)], strict=True):
        distinct, docs = np.unique(pairs[a:b], return_counts=True)
        yield int(radix[a]), packed(distinct, docs), packed(places[a:b], times[a:b])


def make_runs(paths: tuple[str, str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows of documents (kind doc) and of pieces (kind piece) of the runs a task makes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words(*paths)
        number, place, held, records = TaskContext.get().partitionId() << 32, 0, 0, []
        for batch in batches:
            for part in parts_by_size(batch["text"]):
                docs, found, n_links = described(words, batch, part, place)
                yield docs.assign(kind="doc", run=number)
                records.append(found)
                place, held = place + len(part), held + n_links
                if held >= RUN_LINKS or place >= RUN_DOCS:
                    yield from pieces(records, number)
                    number, place, held, records = number + 1, 0, 0, []
                if words.chars > MEMORY:
                    words.clear()
        yield from pieces(records, number)

    def pieces(records: list[np.ndarray], number: int) -> Iterator[pd.DataFrame]:
        if sum(map(len, records)):
            rows = pd.DataFrame(list(spill(records)), columns=["radix", "pairs", "postings"])
            yield rows.assign(kind="piece", run=number)

    def described(words: Words, batch: pd.DataFrame, part: range, place: int):
        cuts = []
        for i in part:
            text = batch["text"].iat[i]
            cuts.append(words.cut(text) if isinstance(text, str) and text else [])
        at = words.look_up([w for cut in cuts for w in cut])
        word_of, counts, digests, start = [], [], [], 0
        for cut in cuts:
            here, start = at[start : start + len(cut)], start + len(cut)
            if not all(map(words.spelled.__getitem__, here)):
                here = []
            word_of += here
            counts.append(len(here))
            line = "".join(map(words.texts.__getitem__, here))[:-1]
            digests.append(hashlib.sha256(line.encode()).hexdigest() if here else "")
        word, doc = np.array(word_of, np.int64), np.repeat(np.arange(len(part)), counts)
        sizes, store = (np.array(held, np.int64) for held in (words.sizes, words.pairs))
        sizes = sizes.reshape(-1, 4)
        totals = np.zeros((len(part), 4), np.int64)
        np.add.at(totals, doc, sizes[word])
        lengths = sizes[word, 3]
        start = np.concatenate([[0], np.cumsum(sizes[:, 3])])[word]
        shift = np.repeat(start - (np.cumsum(lengths) - lengths), lengths)
        pairs = store[shift + np.arange(len(shift))]
        found = (pairs << PLACE_BITS) | np.repeat(doc + place, lengths)
        docs = pd.DataFrame(totals, columns=DOC_FIELDS).assign(
            doc_id=batch["doc_id"].iloc[part.start : part.stop].array,
            place=np.arange(place, place + len(part)),
            groups_sha256=digests,
        )
        return docs, found, len(found)

    schema = ["kind", "run", "doc_id", "place", *DOC_FIELDS, "groups_sha256", "radix", "pairs", "postings"]
    whole = ["run", "place", *DOC_FIELDS, "radix"]
    others = ["doc_id", "groups_sha256", "pairs", "postings"]

    def with_all_columns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in run(batches):
            rows = rows.reindex(columns=schema)
            same = {c: rows[c].astype(object).where(rows[c].notna(), None) for c in others}
            yield rows.assign(**{c: rows[c].astype("Int64") for c in whole}, **same)

    return with_all_columns


RUN_SCHEMA = (
    "kind string, run long, doc_id string, place long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, radix int, pairs binary, postings binary"
)


def count_pairs(pieces: DataFrame, fan: int = FAN) -> tuple[int, DataFrame]:
    """Number of runs, and (radix, pairs): one piece per radix, with the documents of every pair."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        made = [packed(*block) for block in merged(list(rows["pairs"]))]
        return pd.DataFrame({"radix": [rows["radix"].iat[0]], "run": [rows["run"].iat[0]], "pairs": [b"".join(made)]})

    n_runs = left = pieces.select("run").distinct().count()
    while True:
        groups = max(1, -(-left // fan))
        dealt = pieces.select("radix", F.pmod(F.xxhash64("run"), F.lit(groups)).alias("run"), "pairs")
        done = dealt.groupBy("radix", "run").applyInPandas(merge, "radix int, run long, pairs binary")
        pieces = hand_over(done, "counted")
        if groups == 1:
            return n_runs, pieces.select("radix", "pairs")
        left = groups


def contribute(key, runs: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
    """Per run what the links of one radix add to its documents: place, n_best, count_sum."""
    rows = []
    if len(runs):
        pairs, counts = unpacked(counted["pairs"].iat[0])
        first_id = pairs >> ID_BITS
        edges = np.flatnonzero(np.concatenate([[True], first_id[1:] != first_id[:-1]]))
        most = np.repeat(np.maximum.reduceat(counts, edges), np.diff([*edges, len(pairs)]))
        best = counts == most
        for run, held, postings in zip(runs["run"], runs["pairs"], runs["postings"], strict=True):
            distinct, docs = unpacked(held)
            places, times = unpacked(postings)
            at = np.repeat(np.searchsorted(pairs, distinct), docs)
            touched, where = np.unique(places, return_inverse=True)
            sums = np.zeros((2, len(touched)), np.int64)
            np.add.at(sums[0], where, times * best[at])
            np.add.at(sums[1], where, times * counts[at])
            rows.append((run, packed(touched, *sums)))
    return pd.DataFrame(rows, columns=["run", "sums"])


def finish(key, docs: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
    docs = docs.sort_values("place")
    sums = np.zeros((2, len(docs)), np.int64)
    for data in parts["sums"]:
        places, best, total = unpacked(data, 3)
        sums[0, places] += best
        sums[1, places] += total
    made = docs.assign(n_best=sums[0], count_sum=sums[1])
    return made[["doc_id", *DOC_FIELDS, "n_best", "count_sum", "groups_sha256"]]


def align(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per document.

    ``first`` and ``second`` are paths of the vocabularies, readable by all executors.
    """
    written = spilled(docs, first, second)
    pieces = written.where("kind = 'piece'")
    n_runs, counted = count_pairs(pieces.select("run", "radix", "pairs"))
    salts = max(1, -(-n_runs // FAN))
    salt = F.pmod(F.xxhash64("run", F.lit("salt")), F.lit(salts)).cast("int")
    salted = pieces.select("run", "radix", salt.alias("salt"), "pairs", "postings")
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    parts = hand_over(
        salted.groupBy("radix", "salt")
        .cogroup(counted.select("radix", every, "pairs").groupBy("radix", "salt"))
        .applyInPandas(contribute, "run long, sums binary"),
        "contributions",
    )
    rows = written.where("kind = 'doc'").select("run", "place", "doc_id", *DOC_FIELDS, "groups_sha256")
    numbers = ", ".join(f"{c} long" for c in (*DOC_FIELDS, "n_best", "count_sum"))
    made = (
        rows.groupBy("run")
        .cogroup(parts.groupBy("run"))
        .applyInPandas(finish, f"doc_id string, {numbers}, groups_sha256 string")
    )
    return made.withColumn("doc_id", F.col("doc_id").cast(pick(docs, "doc_id").schema[0].dataType))


def spilled(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """The documents and the pieces of the runs, in the shared folder."""
    paths = (first or public_tokenizers.path(FIRST), second or public_tokenizers.path(SECOND))
    # The id travels as text, because a null would turn long ids into doubles in pandas.
    taken = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return hand_over(taken.mapInPandas(make_runs(paths), RUN_SCHEMA), "runs")


def pair_counts(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """a_id, b_id, documents of every linked id pair of the corpus."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["pairs"]:
                for pairs, counts in blocks(data):
                    a = pairs >> ID_BITS
                    low = a >> (ID_BITS - RADIX_BITS)
                    a = ((a & ((1 << (ID_BITS - RADIX_BITS)) - 1)) << RADIX_BITS) | low
                    yield pd.DataFrame({"a_id": a, "b_id": pairs & ((1 << ID_BITS) - 1), "documents": counts})

    pieces = spilled(docs, first, second).where("kind = 'piece'")
    _, counted = count_pairs(pieces.select("run", "radix", "pairs"))
    return counted.mapInPandas(spread, "a_id long, b_id long, documents long")
