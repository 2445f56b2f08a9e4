"""Language of words and documents with a linear-chain conditional random field.

A word's features are hashed n-grams of its letters with word ends (which are its affixes
too) and its entry in a lexicon of frequent words. Learned transitions tie neighbouring
words together. Forward-backward gives each word a distribution over the languages, also
in text that switches between them; a document gets the language with the largest sum.

The model is learned from whole texts of at most ``DOCS_PER_LANGUAGE`` documents of each
language outside the held-out fold: spans of them are put together to sequences that
switch, and likelihood is maximised. All documents are labelled.

Defined cases: a null text, or one without letters, is ``und`` with score 0; without any
language to learn from all documents are ``und``; ties go to the first language by code
point; repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from helixspan.llm.quality import fold
from helixspan.llm.texts import per_text, pick
from helixspan.session import hand_over

WORDS = re.compile(r"[^\W\d_]+")
DOCS_PER_LANGUAGE = 250
SEQUENCES, SEGMENTS, SEGMENT_WORDS = 1600, (1, 4), (4, 40)
#: Buckets of hashed n-grams, their lengths, least count of a lexicon word, lexicon size.
BUCKETS, NGRAMS, LEXICON_COUNT, LEXICON = 1 << 15, (1, 2, 3, 4), 4, 20000
EPOCHS, RATE, SHRINK = 60, 0.1, 1e-4
#: Lanes worked side by side, texts of one slice, word types kept per task.
LANES, TEXTS, TYPES = 256, 2048, 200_000
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def ngram_rows(types: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word number) of every n-gram of the padded words, sorted by word."""
    marked = "".join(f"\x02{w}\x03" for w in types)
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in types), np.int64, len(types))
    owner = np.repeat(np.arange(len(types)), sizes)
    buckets, owners = [], []
    key = np.zeros(len(codes), np.uint64)
    for n in range(1, max(NGRAMS) + 1):
        m = len(codes) - n + 1
        if m <= 0:
            break
        key = key[:m] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(n)
        inside = owner[:m] == owner[n - 1 :]
        if n in NGRAMS:
            mixed = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            buckets.append((mixed[inside] >> np.uint64(64 - 15)).astype(np.int64))
            owners.append(owner[:m][inside])
    return np.concatenate(buckets), np.concatenate(owners)


class Model:
    """languages, n-gram weights, lexicon weights, log transitions, log start."""

    def __init__(self, languages, grams, lexicon, lexicon_weights, transitions, start):
        self.languages, self.grams, self.lexicon = languages, grams, lexicon
        self.lexicon_weights, self.transitions, self.start = lexicon_weights, transitions, start

    def emissions(self, types: list[str]) -> np.ndarray:
        k = len(self.languages)
        out = np.zeros((len(types), k), np.float64)
        if not types:
            return out
        buckets, owners = ngram_rows(types)
        counts = np.bincount(owners, minlength=len(types))[:, None]
        for j in range(k):
            out[:, j] = np.bincount(owners, self.grams[buckets, j], len(types))
        out /= np.sqrt(counts)
        known = np.fromiter((self.lexicon.get(w, -1) for w in types), np.int64, len(types))
        out[known >= 0] += self.lexicon_weights[known[known >= 0]]
        return out


def lanes_of(lengths: np.ndarray, most: int = LANES) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Pack sequences into lanes of about equal length: (lane, offset) of each, lanes, steps."""
    total, longest = int(lengths.sum()), int(lengths.max())
    n = int(max(1, min(most, np.ceil(total / longest))))
    order = np.argsort(-lengths, kind="stable")
    lane = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    filled = np.zeros(n, np.int64)
    for i in order:
        at = int(np.argmin(filled))
        lane[i], offset[i] = at, filled[at]
        filled[at] += lengths[i]
    return lane, offset, filled, int(filled.max())


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, start: np.ndarray):
    """Marginals of each position, sums of pair marginals, first positions, log likelihood norms.

    ``scores`` are log emissions of all sequences one after the other. Sequences are laid
    into lanes and all lanes move a step at a time; a sequence's start resets its lane.
    """
    k = scores.shape[1]
    lengths = lengths[lengths > 0]
    lane, offset, filled, steps = lanes_of(lengths)
    n = len(filled)
    begin = np.cumsum(lengths) - lengths
    place = np.repeat(offset, lengths) + np.arange(len(scores)) - np.repeat(begin, lengths)
    lane_of = np.repeat(lane, lengths)
    top = scores.max(axis=1, keepdims=True)
    emit = np.ones((steps, n, k))
    emit[place, lane_of] = np.exp(scores - top)
    fresh = np.zeros((steps + 1, n, 1), bool)
    fresh[steps] = True
    fresh[offset, lane, 0] = True
    fresh[filled[filled < steps], np.flatnonzero(filled < steps), 0] = True
    move, first = np.exp(transitions), np.exp(start)
    alpha = np.empty((steps, n, k))
    norm = np.empty((steps, n, 1))
    now = np.full((n, k), 1.0 / k)
    for t in range(steps):
        now = np.where(fresh[t], first, now @ move) * emit[t]
        norm[t] = now.sum(axis=1, keepdims=True)
        now /= norm[t]
        alpha[t] = now
    gamma = np.empty((steps, n, k))
    after = np.ones((n, k))
    pairs = np.zeros((k, k))
    back = move.T.copy()
    for t in range(steps - 1, -1, -1):
        if t < steps - 1:
            weighed = emit[t + 1] * after / norm[t + 1]
            going = ~fresh[t + 1]
            pairs += (alpha[t] * going).T @ (weighed * going)
            after = np.where(fresh[t + 1], 1.0, weighed @ back)
        gamma[t] = alpha[t] * after
    marginal = gamma[place, lane_of]
    marginal /= marginal.sum(axis=1, keepdims=True)
    log_norm = float(np.log(norm[place, lane_of]).sum() + top.sum())
    return marginal, pairs * move, begin, log_norm


def segments(sizes: dict[str, list[int]], seed: int = 1) -> list[list[tuple[int, int, int, int]]]:
    """Sequences of (language number, text number, first word, words) that switch between languages.

    ``sizes`` has the number of words of each text by language.
    """
    draw = random.Random(seed)
    languages = sorted(sizes)
    found = []
    for number in range(SEQUENCES):
        parts = []
        for _ in range(draw.randint(*SEGMENTS)):
            at = (number + draw.randrange(len(languages))) % len(languages)
            text = draw.choice(range(len(sizes[languages[at]])))
            total = sizes[languages[at]][text]
            size = min(total, draw.randint(*SEGMENT_WORDS))
            parts.append((at, text, draw.randrange(total - size + 1), size))
        found.append(parts)
    return found


def fit(texts: dict[str, list[list[str]]]) -> Model | None:
    """Learn from word lists by language."""
    texts = {lang: [w for w in found if w] for lang, found in texts.items()}
    texts = {lang: found for lang, found in texts.items() if found}
    if not texts:
        return None
    languages = sorted(texts)
    counts = Counter(w for found in texts.values() for doc in found for w in doc)
    frequent = sorted((w for w, c in counts.items() if c >= LEXICON_COUNT), key=lambda w: (-counts[w], w))
    plan = segments({lang: [len(doc) for doc in found] for lang, found in texts.items()})
    parts = [[(at, texts[languages[at]][text][a : a + n]) for at, text, a, n in line] for line in plan]
    return learn(languages, frequent[:LEXICON], parts)


def learn(languages: list[str], frequent: list[str], parts: list[list[tuple[int, list[str]]]]) -> Model:
    """Maximum likelihood with Adam; ``parts`` has the segments of each sequence."""
    k = len(languages)
    model = Model(
        languages,
        np.zeros((BUCKETS, k)),
        {w: i for i, w in enumerate(sorted(frequent))},
        np.zeros((len(frequent), k)),
        np.zeros((k, k)),
        np.zeros(k),
    )
    words = [w for line in parts for _, own in line for w in own]
    tags = np.array([at for line in parts for at, own in line for _ in own])
    lengths = np.array([sum(len(own) for _, own in line) for line in parts])
    numbers: dict[str, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words])
    types = list(numbers)
    buckets, owners = ngram_rows(types)
    scale = 1 / np.sqrt(np.bincount(owners, minlength=len(types)))
    known = np.array([model.lexicon.get(w, -1) for w in types])
    has = known >= 0
    inner = np.ones(len(words), bool)
    starts = np.cumsum(lengths) - lengths
    inner[starts] = False
    seen_pairs = np.zeros((k, k))
    np.add.at(seen_pairs, (tags[:-1][inner[1:]], tags[1:][inner[1:]]), 1)
    seen_start = np.bincount(tags[starts], minlength=k)
    parts = [model.grams, model.lexicon_weights, model.transitions, model.start]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    size = len(words)
    for epoch in range(1, EPOCHS + 1):
        by_type = model.emissions(types)
        marginal, pairs, _, _ = forward_backward(by_type[codes], lengths, model.transitions, model.start)
        off = marginal.copy()
        off[np.arange(size), tags] -= 1
        type_off = np.stack([np.bincount(codes, off[:, j], len(types)) for j in range(k)], axis=1)
        spread = type_off * scale[:, None]
        grams = np.stack([np.bincount(buckets, spread[owners, j], BUCKETS) for j in range(k)], axis=1)
        lex = np.zeros_like(model.lexicon_weights)
        lex[known[has]] = type_off[has]
        gradients = [grams, lex, pairs - seen_pairs, marginal[starts].sum(axis=0) - seen_start]
        for part, gradient, (m, v) in zip(parts, gradients, moments, strict=True):
            g = gradient / size + SHRINK * part / 10
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            part -= RATE * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
    return model


def train(docs: DataFrame, held: tuple[int, int] | None = (4, 2)) -> Model | None:
    """Fit on a bounded number of documents of each language outside the held-out fold.

    The driver gets the number of words of each document, the lexicon and the words of the
    drawn segments, at most SEQUENCES x 4 x 40; none of it grows with the length of the texts.
    """
    outside = F.lit(True) if held is None else fold(F.col("doc_id"), held[0]) != held[1]
    usable = pick(docs, "doc_id", "text", "lang").where(outside).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = usable.groupBy("lang").count().withColumn(
        "bar", F.lit(2.0 * DOCS_PER_LANGUAGE) / F.col("count")
    )
    draw = F.pmod(F.xxhash64("doc_id", F.xxhash64("text"), F.lit("lang")), F.lit(1 << 30)) / float(1 << 30)
    near = usable.withColumn("draw", draw).join(F.broadcast(sizes), "lang").where("draw < bar")
    # A language of one hot text could still exceed the bound: the smallest draws are taken.
    rows = near.groupBy("lang").agg(
        F.slice(F.array_sort(F.collect_set(F.struct("draw", "doc_id"))), 1, DOCS_PER_LANGUAGE).alias("ids")
    ).select("lang", F.inline("ids"))
    chosen = usable.join(F.broadcast(rows.select("lang", "doc_id").distinct()), ["lang", "doc_id"])
    split = per_text(lambda: lambda texts: [(words_of(t),) for t in texts], "words array<string>")
    # Written down, so that all that follows reads the same texts; their words stay in the tasks.
    table = hand_over(
        chosen.dropDuplicates(["lang", "doc_id"]).select("lang", "doc_id", split("text")["words"].alias("words"))
    ).where(F.size("words") > 0)
    ids: dict[str, list[tuple]] = {}
    for row in table.select("lang", "doc_id", F.size("words").alias("n")).orderBy("lang", "doc_id").collect():
        ids.setdefault(row["lang"], []).append((row["doc_id"], row["n"]))
    if not ids:
        return None
    each = table.select(F.explode("words").alias("w")).groupBy("w").count().where(F.col("count") >= LEXICON_COUNT)
    frequent = [r["w"] for r in each.orderBy(F.desc("count"), "w").limit(LEXICON).collect()]
    languages = sorted(ids)
    plan = segments({lang: [n for _, n in found] for lang, found in ids.items()})
    wanted = [
        (languages[at], ids[languages[at]][text][0], line, place, a + 1, n)
        for line, found in enumerate(plan)
        for place, (at, text, a, n) in enumerate(found)
    ]
    kind = table.schema["doc_id"].dataType.simpleString()
    places = docs.sparkSession.createDataFrame(
        wanted, f"lang string, doc_id {kind}, line int, place int, a int, n int"
    )
    cut = table.join(F.broadcast(places), ["lang", "doc_id"]).select(
        "line", "place", F.expr("slice(words, a, n)").alias("own")
    )
    own = {(r["line"], r["place"]): r["own"] for r in cut.collect()}
    parts = [[(at, own[line, place]) for place, (at, *_) in enumerate(found)] for line, found in enumerate(plan)]
    return learn(languages, frequent, parts)


class Labeller:
    """Labels texts; remembers the emissions of the word types it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.table = np.zeros((0, len(self.model.languages)))

    def codes(self, words: list[str]) -> np.ndarray:
        if len(self.numbers) > TYPES:
            self.forget()
        before, numbers = len(self.numbers), self.numbers
        codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        if len(numbers) > before:
            new = list(numbers)[before:]
            self.table = np.vstack([self.table, self.model.emissions(new)])
        return codes

    def marginals(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(words) for words in texts])
        codes = self.codes([w for words in texts for w in words])
        if not len(codes):
            return np.zeros((0, len(self.model.languages))), lengths
        scores = self.table[codes]
        return forward_backward(scores, lengths, self.model.transitions, self.model.start)[0], lengths

    def label(self, texts: list[str | None]) -> list[tuple]:
        found = [words_of(text) for text in texts]
        marginal, lengths = self.marginals(found)
        ends = np.cumsum(lengths)
        rows = []
        best = marginal.argmax(axis=1) if len(marginal) else np.zeros(0, int)
        sums = np.vstack([np.zeros((1, len(self.model.languages))), np.cumsum(marginal, axis=0)])
        for end, length in zip(ends, lengths, strict=True):
            if not length:
                rows.append((UNKNOWN, 0.0, 0))
                continue
            mean = np.clip((sums[end] - sums[end - length]) / length, 0, 1)
            at = int(mean.argmax())
            own = best[end - length : end]
            rows.append((self.model.languages[at], float(mean[at]), int((own[1:] != own[:-1]).sum())))
        return rows


def identify(docs: DataFrame, model: Model | None | str = "train") -> DataFrame:
    """doc_id, held_out, lang_pred, score, switches (changes of language between words)."""
    if isinstance(model, str):
        model = train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, fixed by the parameters
    fields = ["lang_pred", "score", "switches"]

    @F.pandas_udf(
        T.StructType(
            [
                T.StructField("lang_pred", T.StringType()),
                T.StructField("score", T.DoubleType()),
                T.StructField("switches", T.LongType()),
            ]
        )
    )
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeller = Labeller(shared.value) if shared.value else None
        for batch in batches:
            rows: list[tuple] = []
            for at in range(0, len(batch), TEXTS):
                part = [x if isinstance(x, str) else None for x in batch.iloc[at : at + TEXTS]]
                rows += labeller.label(part) if labeller else [(UNKNOWN, 0.0, 0)] * len(part)
            yield pd.DataFrame(rows, columns=fields)

    return pick(docs, "doc_id", "text").select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), run("text").alias("found")
    ).select("doc_id", "held_out", "found.*")
