"""Personal data with patterns and a skip-chain conditional random field.

Patterns find e-mail and network addresses, card and phone numbers. The tokens that carry
a digit or an @, their neighbours, and tokens that repeat the form of one of them are the
nodes of a field: neighbours in the text share a potential, and so do consecutive
occurrences of the same form however far apart they are. Loopy message passing gives every
token a distribution over the kinds; tokens that the patterns missed are added where their
kind is nearly certain. Tokens without any of these marks are plain text whatever stands
around, so leaving them out changes nothing.

Weights are learned by pseudo-likelihood from the pattern spans of at most ``LEARN_DOCS``
documents: each token's kind given its form and the kinds of its neighbours and repeats.
When spans are searched, a pattern's match is strong evidence for its kind, and no match
is no evidence.

Defined cases: a null text has no spans; very long texts need memory in proportion to
their own length; repeated rows give equal spans; without a document to learn from only
the patterns speak; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame, functions as F

from helixspan.llm.texts import boxed, in_box, per_text, pick, smallest, unboxed

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
LABELS = OTHER + 1
LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"\S+")
MARKED = re.compile(r"[0-9@]")
TRIM = "\"'.,;:!?()[]{}<>|#*$%&"
LEARN_DOCS, EPOCHS, RATE, SHRINK = 1500, 200, 0.1, 3e-4
#: Log odds that a pattern's match adds to its kind.
MATCH = 8.0
#: Rounds of message passing, damping, probability that adds a span, neighbours kept.
ROUNDS, DAMPING, SURE, REACH = 12, 0.3, 0.98, 1


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str):
    """Leftmost non-overlapping matches, found from each @ so that long runs stay linear."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        else:
            done = max(done, at + 1)  # no later match can reach over an @
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns, by start, then kind."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        # Without leading zeros, because int() takes no very long runs of digits.
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (part.lstrip("0") for part in m[0].split("."))):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def written(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


class Graph:
    """Nodes and edges of the fields of several texts, with no edge between texts."""

    def __init__(self, texts: list[str], spans: list[list[tuple[int, int, int]]]):
        self.where: list[tuple[int, int, int]] = []  # text, start, end
        self.features: list[list[int]] = []
        self.base: list[int] = []
        chain, skip = [], []
        for number, (text, found) in enumerate(zip(texts, spans, strict=True)):
            tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
            words = [text[a:b] for a, b in tokens]
            forms = [w.strip(TRIM) for w in words]
            alike = [form_of(f) for f in forms]
            marked = [bool(MARKED.search(w)) for w in words]
            wanted = {form_of(f) for f, m in zip(forms, marked, strict=True) if m and f}
            near = set()
            for i, m in enumerate(marked):
                if m:
                    near.update(range(max(0, i - REACH), min(len(words), i + REACH + 1)))
            keep = [i for i in range(len(words)) if i in near or (forms[i] and alike[i] in wanted)]
            labels = self.cover([tokens[i] for i in keep], found)
            last: dict[str, int] = {}
            first = len(self.where)
            for k, i in enumerate(keep):
                node = first + k
                start, end = tokens[i]
                a = start + words[i].find(forms[i]) if forms[i] else start
                self.where.append((number, a, a + len(forms[i]) if forms[i] else end))
                self.features.append(shape(words[i], forms[i]))
                self.base.append(labels[k])
                if k and keep[k - 1] == i - 1:
                    chain.append((node - 1, node))
                if forms[i] and alike[i] in wanted:
                    if last.get(alike[i], node - 1) != node - 1:
                        skip.append((last[alike[i]], node))
                    last[alike[i]] = node
        self.chain = np.array(chain, np.int64).reshape(-1, 2)
        self.skip = np.array(skip, np.int64).reshape(-1, 2)

    @staticmethod
    def cover(tokens, found) -> list[int]:
        """Kind of the pattern span that covers most of a token, or none."""
        labels, at = [], 0
        for start, end in tokens:
            while at < len(found) and found[at][2] <= start:
                at += 1
            label = OTHER
            for a, kind, b in found[at : at + 4]:
                if a < end and b > start and 2 * (min(end, b) - max(start, a)) >= end - start - 4:
                    label = kind
                    break
            labels.append(label)
        return labels

    def matrix(self) -> np.ndarray:
        x = np.zeros((len(self.features), N_FEATURES))
        for i, row in enumerate(self.features):
            x[i, row] = 1
        return x

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """matrix() @ weights, each row summed in one order whatever other rows there are."""
        sizes = np.array([len(row) for row in self.features], np.int64)
        node = np.repeat(np.arange(len(sizes)), sizes)
        feature = np.array([i for row in self.features for i in row], np.int64)
        return gathered(weights[feature], node, len(self.features))


N_FEATURES = 22


def form_of(word: str) -> str:
    """What makes two tokens alike: the digits if there are four or more, else the lower case."""
    digits = "".join(c for c in word if "0" <= c <= "9")
    return digits if len(digits) >= 4 and "@" not in word else word.lower()


def shape(word: str, form: str) -> list[int]:
    """Indices of the features of a token's form."""
    digits = sum("0" <= c <= "9" for c in form)
    letters = sum(map(str.isalpha, form))
    at = form.find("@")
    tests = (
        True,
        at >= 0,
        at > 0 and "." in form[at:],
        digits > 0 and letters > 0,
        digits > 0 and letters == 0,
        digits == 0,
        digits in (1, 2),
        digits == 3,
        digits == 4,
        5 <= digits <= 9,
        10 <= digits <= 13,
        14 <= digits <= 19,
        digits > 19,
        "+" in word,
        word[:1] == "(",
        ")" in word,
        form.count("-") == 1,
        form.count("-") > 1,
        form.count(".") == 3 and letters == 0 and digits > 3,
        "=" in word,
        '"' in word,
        len(form) > 24,
    )
    return [i for i, test in enumerate(tests) if test]


def normal(logs: np.ndarray) -> np.ndarray:
    logs = logs - logs.max(axis=-1, keepdims=True)
    return logs - np.log(np.exp(logs).sum(axis=-1, keepdims=True))


class Field:
    """Weights: features x labels, and one table of label pairs per kind of edge."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.unary, self.chain, self.skip = unary, chain, skip

    def marginals(self, graph: Graph) -> np.ndarray:
        """Loopy sum-product with damping; messages run along both directions of an edge.

        A text's messages rest once they all have settled, so a text gets the same
        distributions whatever texts share its graph.
        """
        local = graph.scores(self.unary)
        base = np.array(graph.base, np.int64)
        matched = np.flatnonzero(base != OTHER)
        local[matched, base[matched]] += MATCH
        edges = [(graph.chain, self.chain), (graph.skip, self.skip)]
        source = np.concatenate([np.concatenate([e[:, 0], e[:, 1]]) for e, _ in edges])
        target = np.concatenate([np.concatenate([e[:, 1], e[:, 0]]) for e, _ in edges])
        if not len(source):
            return np.exp(normal(local))
        tables = np.concatenate(
            [np.concatenate([np.tile(w, (len(e), 1, 1)), np.tile(w.T, (len(e), 1, 1))]) for e, w in edges]
        )
        opposite, done = [], 0
        for e, _ in edges:
            n = len(e)
            opposite += [np.arange(n, 2 * n) + done, np.arange(n) + done]
            done += 2 * n
        opposite = np.concatenate(opposite)
        messages = np.full((len(source), LABELS), -np.log(LABELS))
        owner = np.array([number for number, _, _ in graph.where], np.int64)[source]
        live = np.arange(len(source))
        for _ in range(ROUNDS):
            belief = local + gathered(messages, target, len(local))
            out = belief[source[live]] - messages[opposite[live]]
            joint = out[:, :, None] + tables[live]
            top = joint.max(axis=1, keepdims=True)
            new = normal(np.log(np.exp(joint - top).sum(axis=1)) + top[:, 0, :])
            moved = np.zeros(owner.max() + 1)
            np.maximum.at(moved, owner[live], np.abs(new - messages[live]).max(axis=1))
            messages[live] = normal((1 - DAMPING) * new + DAMPING * messages[live])
            live = live[moved[owner[live]] >= 1e-3]
            if not len(live):
                break
        return np.exp(normal(local + gathered(messages, target, len(local))))


def gathered(messages: np.ndarray, target: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(target, messages[:, j], n) for j in range(LABELS)], axis=1)


def patterns(texts: list[str]) -> Counter:
    """How many nodes of the texts have the same features, kind and kinds around.

    A pattern is (features as bits, kind, kind of the node before, after, of the last and
    the next repeat); a node has at most one neighbour of each sort, OTHER + 1 means none.
    """
    graph = Graph(texts, [base_spans(text) for text in texts])
    labels = np.array(graph.base, np.int64)
    around = np.full((len(labels), 4), LABELS, np.int64)
    for i, edges in enumerate((graph.chain, graph.skip)):
        around[edges[:, 1], 2 * i] = labels[edges[:, 0]]
        around[edges[:, 0], 2 * i + 1] = labels[edges[:, 1]]
    bits = [sum(1 << i for i in row) for row in graph.features]
    return Counter(zip(bits, graph.base, *around.T.tolist(), strict=True))


def fit(texts: list[str]) -> Field | None:
    return learn(patterns(texts))


def learn(found: Counter) -> Field | None:
    """Pseudo-likelihood: each token given its features and its neighbours' labels.

    Nodes with the same pattern add the same, so their numbers are all that is needed.
    """
    rows = np.array(sorted(found), np.int64).reshape(-1, 6)
    labels = rows[:, 1]
    if not (labels != OTHER).any():
        return None
    count = np.array([found[tuple(row)] for row in rows.tolist()], float)
    sides = np.eye(LABELS + 1)[:, :LABELS]
    full = np.hstack([(rows[:, :1] >> np.arange(N_FEATURES)) & 1, *(sides[rows[:, 2 + i]] for i in range(4))])
    truth = np.eye(LABELS)[labels]
    # Rare kinds weigh more, so that the many plain tokens don't drown them.
    sizes = np.bincount(labels, count, LABELS)
    weight = count * (1 / np.sqrt(np.maximum(sizes, 1)))[labels]
    weight /= weight.sum()
    w, m, v = (np.zeros((full.shape[1], LABELS)) for _ in range(3))
    for t in range(1, EPOCHS + 1):
        p = np.exp(normal(full @ w))
        g = full.T @ ((p - truth) * weight[:, None]) + SHRINK * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    at = N_FEATURES
    tables = []
    for _ in range(2):
        before, after = w[at : at + LABELS], w[at + LABELS : at + 2 * LABELS]
        tables.append((before + after.T) / 2)
        at += 2 * LABELS
    return Field(w[:N_FEATURES], *tables)


def find_spans(texts: list[str | None], field: Field | None) -> list[tuple[list, list]]:
    """(pattern spans, all spans) of each text; only texts with a digit or @ make a graph."""
    base = [base_spans(t) if t and MARKED.search(t) else [] for t in texts]
    added = defaultdict(list)
    open_ = [i for i, t in enumerate(texts) if field and t and MARKED.search(t)]
    if open_:
        graph = Graph([texts[i] for i in open_], [base[i] for i in open_])
        chances = field.marginals(graph)
        best = chances.argmax(axis=1)
        chain = set(map(tuple, graph.chain.tolist()))
        sure = (best != OTHER) & (chances.max(axis=1) >= SURE)
        for node in np.flatnonzero(sure):
            number, start, end = graph.where[node]
            if graph.base[node] == OTHER and MARKED.search(texts[open_[number]], start, end):
                spans, kind = added[open_[number]], int(best[node])
                if spans and spans[-1][1] == kind and spans[-1][3] == node - 1 and (node - 1, node) in chain:
                    spans[-1] = (spans[-1][0], kind, end, node)
                else:
                    spans.append((start, kind, end, node))
    out = []
    for i, found in enumerate(base):
        extra = [(a, kind, b) for a, kind, b, _ in added[i] if not any(a < e and b > s for s, _, e in found)]
        out.append((found, sorted([*found, *extra])))
    return out


def train(docs: DataFrame) -> Field | None:
    """Fit on at most ``LEARN_DOCS`` documents with an @ or digits, smallest hashes first.

    The ids are chosen first. Their texts stay in the tasks: the driver gets how often each
    pattern of a node occurs, which does not grow with the length of the texts.
    """
    rich = (
        pick(docs, "doc_id", "text")
        .where(F.col("text").rlike(r"@[A-Za-z0-9]|\+[0-9]|[0-9]{4}"))
        .withColumn("o", F.xxhash64("doc_id", F.xxhash64("text"), F.lit("pii")))
    )
    chosen = smallest(rich.select("o").distinct(), "o", LEARN_DOCS, rich.count())
    texts = rich.join(F.broadcast(chosen), "o").select("o", "text").dropDuplicates(["o"])
    run = per_text(lambda: count_patterns, "patterns array<array<bigint>>, n array<bigint>")
    each = texts.select(run("text").alias("p")).select(F.inline(F.arrays_zip("p.patterns", "p.n")))
    rows = each.groupBy("patterns").agg(F.sum("n").alias("n")).collect()
    return learn(Counter({tuple(r["patterns"]): r["n"] for r in rows}))


def count_patterns(texts: list[str | None]) -> list[tuple]:
    found = [patterns([text or ""]) for text in texts]
    return [([list(p) for p in f], list(f.values())) for f in found]


def finder(field: Field | None):
    def work(texts: list[str | None]) -> list[tuple]:
        rows = []
        for base, spans in find_spans(texts, field):
            count = [sum(kind == k for _, kind, _ in base) for k in range(len(KINDS))]
            digest = hashlib.sha256(written(base).encode()).hexdigest()
            rows.append((*count, digest, written(spans)))
        return rows

    return per_text(
        lambda: work,
        "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    )


def find(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the pattern spans, their digest, and all spans."""
    run = finder(train(docs))
    return pick(docs, "doc_id", "text").select("doc_id", run(F.col("text")).alias("p")).select("doc_id", "p.*")


def masked(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with each span, or run of overlapping spans, replaced by its kind."""
    if not spans:
        return text
    parts, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            parts += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def mask(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced, n_chars counted anew; null texts stay null."""
    names = docs.columns
    field = train(docs)

    def work(texts: list[str | None]) -> list[tuple]:
        found = find_spans(texts, field)
        return [(masked(text, spans),) for text, (_, spans) in zip(texts, found, strict=True)]

    run = per_text(lambda: work, "text string")
    clean = boxed(docs).select("row", run(in_box(names, "text"))["text"].alias("clean"))
    new = {"text": F.col("clean")}
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.coalesce(F.length("clean").cast(kind), F.col(f"row.c{names.index('n_chars')}"))
    return unboxed(clean, names, new=new)
