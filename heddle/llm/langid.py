"""Language identification of every word by a linear-chain conditional random field.

Emissions are sums of learned weights of a word's features: character n-grams, affixes (n-grams that touch a word
mark, up to five symbols) and membership of the languages' lexicons. Transitions between the labels of neighbouring
words are learned too, from sequences in which passages of several documents follow each other, so code-switched text
keeps its own labels on each side. Forward-backward gives each word's marginal; a document's prediction is the label
with the largest mean marginal, and that mean is its score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import batch_of, in_arrow, pieces, project, rows_kept

BUCKETS = 1 << 16
GRAMS = (1, 2, 3, 4)
AFFIX = 5
UNDETERMINED = "und"
SLICE = 1 << 20  # bytes of text that are labelled at once
_word = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters; numerals that are no decimal digits count as word characters, but not as letters."""
    found = _word.findall(text.lower()) if text else []
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed feature numbers of the words, one after the other, and where each word's begin."""
    joined = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    ends = (starts + sizes)[owner]
    place = np.arange(len(joined))
    numbers, owners = [], []
    h = np.full(len(joined), 0xCBF29CE484222325, np.uint64)
    for n in range(1, AFFIX + 1):
        ahead = place + n - 1
        inside = ahead < ends
        h[inside] = (h[inside] ^ joined[ahead[inside]]) * np.uint64(0x100000001B3) + np.uint64(n)
        use = inside if n in GRAMS else inside & ((place == starts[owner]) | (ahead == ends - 1))
        mixed = h[use] * np.uint64(0x9E3779B97F4A7C15)
        numbers.append((mixed >> np.uint64(48)).astype(np.int64) % BUCKETS)
        owners.append(owner[use])
    numbers, owners = np.concatenate(numbers), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return numbers[order], np.searchsorted(owners[order], np.arange(len(words)))


class Field:
    """The model: labels, weights (a row for each feature), transitions, start scores and lexicons."""

    def __init__(self, labels: list[str], lexicons: dict[str, list[int]]):
        self.labels, self.lexicons = labels, lexicons
        n = len(labels)
        self.weights = np.zeros((BUCKETS, n), np.float32)
        self.lexical = np.zeros((n, n), np.float32)  # of being in the lexicon of a row's label
        self.steps = np.zeros((n, n), np.float32)
        self.first = np.zeros(n, np.float32)

    def emissions(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.labels)), np.float32)
        numbers, starts = features(words)
        out = np.add.reduceat(self.weights[numbers], starts, axis=0)
        for i, w in enumerate(words):
            for k in self.lexicons.get(w, ()):
                out[i] += self.lexical[k]
        return out


def marginals(emit: np.ndarray, sizes: np.ndarray, steps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Forward-backward over many sequences at once: emit has their words one after the other, sizes their lengths.

    Sequences advance together, the longest last, so each step works on all that are still running.
    """
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    lengths = sizes[order]
    local = np.exp(emit - emit.max(1, keepdims=True))
    move = np.exp(steps - steps.max())
    alpha, beta = np.empty_like(local), np.empty_like(local)
    running = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")  # sequences longer than t
    state = None
    for t, n in enumerate(running):
        at = starts[:n] + t
        state = local[at] * (np.exp(first - first.max()) if t == 0 else state[:n] @ move)
        state /= state.sum(1, keepdims=True)
        alpha[at] = state
    state = np.empty((0, local.shape[1]), local.dtype)
    for t in range(len(running) - 1, -1, -1):
        n = running[t]
        at = starts[:n] + t
        now = np.ones((n, local.shape[1]), local.dtype)
        now[: len(state)] = state  # what follows t; a sequence that ends at t has ones
        beta[at] = now
        state = (now * local[at]) @ move.T
        state /= state.sum(1, keepdims=True)
    both = alpha * beta
    return both / both.sum(1, keepdims=True)


def train(sample: list[tuple[str, list[str]]], rounds: int = 40, length: int = 48, lexicon: int = 500, rate: float = 0.15, decay: float = 1e-4, seed: int = 7) -> Field:
    """Fits a field on (label, words) passages by Adam on the whole sample's conditional likelihood.

    Two thirds of the sequences join passages of different documents.
    """
    labels = sorted({label for label, _ in sample})
    counts = {label: Counter(w for own, words in sample if own == label for w in words) for label in labels}
    lexicons: dict[str, list[int]] = {}
    for k, label in enumerate(labels):
        for w, n in sorted(counts[label].items(), key=lambda x: (-x[1], x[0]))[:lexicon]:
            if n > 1:
                lexicons.setdefault(w, []).append(k)
    field = Field(labels, lexicons)
    rng = np.random.default_rng(seed)
    sequences = []
    usable = [(labels.index(label), words) for label, words in sample if words]
    for i, (k, words) in enumerate(usable):
        sequence = [(w, k) for w in words[:length]]
        if i % 3:
            cut = int(rng.integers(length // 4, length))
            other, more = usable[int(rng.integers(len(usable)))]
            sequence = sequence[:cut] + [(w, other) for w in more[: length - min(cut, len(sequence))]]
        sequences.append(sequence)
    if not sequences:
        return field
    vocabulary = sorted({w for s in sequences for w, _ in s})
    number = {w: i for i, w in enumerate(vocabulary)}
    ids = np.array([number[w] for s in sequences for w, _ in s])
    truth = np.array([k for s in sequences for _, k in s])
    sizes = np.array([len(s) for s in sequences], np.int64)
    starts = np.cumsum(sizes) - sizes
    numbers, begins = features(vocabulary)
    repeats = np.diff(np.append(begins, len(numbers)))
    n = len(labels)
    onehot = np.eye(n, dtype=np.float32)[truth]
    inner = np.ones(len(ids), bool)
    inner[starts] = False
    after = np.flatnonzero(inner)
    follows = np.zeros((n, n))
    np.add.at(follows, (truth[after - 1], truth[after]), 1)
    parts = {"weights": field.weights, "lexical": field.lexical, "steps": field.steps, "first": field.first}
    moment = {p: [np.zeros_like(v), np.zeros_like(v)] for p, v in parts.items()}
    lexicon_of = [(i, k) for i, w in enumerate(vocabulary) for k in lexicons.get(w, ())]
    lex_word, lex_label = (np.array(x, np.int64) for x in zip(*lexicon_of, strict=True)) if lexicon_of else (np.empty(0, np.int64), np.empty(0, np.int64))
    for step in range(1, rounds + 1):
        emit = field.emissions(vocabulary)[ids]
        p, pairs = expected(emit, sizes, field.steps, field.first)
        error = p - onehot
        per_word = np.stack([np.bincount(ids, error[:, k], len(vocabulary)) for k in range(n)], 1)
        spread = np.repeat(per_word, repeats, axis=0)
        slope = {
            "weights": np.stack([np.bincount(numbers, spread[:, k], BUCKETS) for k in range(n)], 1),
            "lexical": np.stack([np.bincount(lex_label, per_word[lex_word, k], n) for k in range(n)], 1),
            "steps": pairs - follows,
            "first": error[starts].sum(0),
        }
        for name, value in parts.items():
            g = slope[name] / len(sequences) + decay * value
            m, v = moment[name]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return field


def expected(emit: np.ndarray, sizes: np.ndarray, steps: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of words, and the expected count of each pair of neighbouring labels."""
    p = marginals(emit, sizes, steps, first)
    # The pair marginal is alpha' . move . (local beta)', whose row and column sums are p; scaling finds it from p.
    starts = np.cumsum(sizes) - sizes
    inner = np.ones(len(emit), bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    forward = forward_only(emit, sizes, steps, first)
    move = np.exp(steps - steps.max())
    ahead = forward[at - 1] @ move
    back = p[at] / np.maximum(ahead, 1e-30)
    pairs = (forward[at - 1][:, :, None] * move[None] * back[:, None, :]).sum(0)
    return p, pairs


def forward_only(emit: np.ndarray, sizes: np.ndarray, steps: np.ndarray, first: np.ndarray) -> np.ndarray:
    order = np.argsort(-sizes, kind="stable")
    starts, lengths = (np.cumsum(sizes) - sizes)[order], sizes[order]
    local, move = np.exp(emit - emit.max(1, keepdims=True)), np.exp(steps - steps.max())
    alpha, state = np.empty_like(local), None
    for t, n in enumerate(np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")):
        at = starts[:n] + t
        state = local[at] * (np.exp(first - first.max()) if t == 0 else state[:n] @ move)
        state /= state.sum(1, keepdims=True)
        alpha[at] = state
    return alpha


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, per_label: int = 400, passage: int = 64) -> Field:
    """Fits a field on at most per_label documents of each non-null lang that are not held out, those of the lowest hash.

    Of each one passage of at most `passage` words, at a place that the text's hash gives, is learned from; nothing
    else reaches the driver. Without any labelled document the field has no labels.
    """
    rows = project(docs, doc_id="long", text="string", lang="string").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    hashed = rows.withColumn("rank", (F.xxhash64(F.col("doc_id").cast("string")) / float(1 << 63) + 1) / 2)
    counts = hashed.groupBy("lang").count().collect()  # a row for each label, as the field has
    if not counts:
        return train([])
    many = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], r["count"])])
    near = hashed.where(F.col("rank") * many[F.col("lang")] <= 2 * per_label).select("lang", "rank", "text")
    schema = pa.schema([("lang", pa.string()), ("rank", pa.float64()), ("words", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            out = []
            for rank, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = words_of(text)
                at = int(rank * 1e9) % max(1, len(words) - passage + 1)
                out.append(words[at : at + passage])
            yield batch_of(schema, [batch.column(0), batch.column(1), out])

    sample = sorted(((r.lang, r.rank, r.words) for r in near.mapInArrow(run, "lang string, rank double, words array<string>").toLocalIterator()), key=lambda x: x[:2])
    taken: Counter = Counter()
    use = []
    for label, _, words in sample:
        taken[label] += 1
        if taken[label] <= per_label:
            use.append((label, words))
    return train(use)


class Labeller:
    """Predicts batches of whole texts; keeps the emissions of the words it has met, up to a bound."""

    KEEP = 100_000

    def __init__(self, field: Field):
        self.field = field
        self.number: dict[str, int] = {}
        self.table = np.zeros((0, len(field.labels)), np.float32)

    def __call__(self, texts: list[str | None], words: bool = False) -> tuple[list[str], list[float], list[list[str]]]:
        field = self.field
        if len(self.number) > self.KEEP:
            self.number, self.table = {}, self.table[:0]
        number = self.number
        split = [words_of(t) for t in texts] if field.labels else [[] for _ in texts]
        fresh = list(dict.fromkeys(w for t in split for w in t if w not in number))
        for at in range(0, len(fresh), 50_000):
            part = fresh[at : at + 50_000]
            self.table = np.concatenate([self.table, field.emissions(part)])
            number.update(zip(part, range(len(number), len(number) + len(part)), strict=True))
        sizes = np.array([len(t) for t in split], np.int64)
        ids = np.fromiter((number[w] for t in split for w in t), np.int64, int(sizes.sum()))
        p = marginals(self.table[ids], sizes, field.steps, field.first) if len(ids) else np.zeros((0, len(field.labels)), np.float32)
        some = np.flatnonzero(sizes)
        labels, scores = [UNDETERMINED] * len(split), [0.0] * len(split)
        if len(some):
            mean = np.add.reduceat(p.astype(np.float64), (np.cumsum(sizes) - sizes)[some], axis=0) / sizes[some, None]
            for i, k, s in zip(some, mean.argmax(1), mean.max(1), strict=True):
                labels[i], scores[i] = field.labels[k], min(1.0, float(s))
        of_words: list[list[str]] = []
        if words:
            best = [field.labels[k] for k in p.argmax(1)] if len(p) else []
            of_words = [best[e - n : e] for e, n in zip(np.cumsum(sizes), sizes, strict=True)]
        return labels, scores, of_words


def predict(docs: DataFrame, field: Field, words: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text, and with `words` the label of each word in text order.

    A text that is null or has no letter, and any text for a field without labels, is 'und' with score 0 and no
    labels. Repeated rows stay. Nothing but the text is looked at.
    """
    names = [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())]
    schema = pa.schema(names + ([("words", pa.list_(pa.string()))] if words else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(field)
        for batch in pieces(batches, "text", SLICE):
            labels, scores, of_words = labeller(batch.column(1).to_pylist(), words)
            yield batch_of(schema, [batch.column(0), labels, scores] + ([of_words] if words else []))

    wanted = "doc_id long, lang_pred string, score double" + (", words array<string>" if words else "")
    return in_arrow(project(docs, doc_id="long", text="string"), run, wanted)


def identify(docs: DataFrame, **bounds: int) -> DataFrame:
    """Learns from docs and predicts all of them: (doc_id, held_out, lang_pred, score)."""
    return predict(docs, learn(docs, **bounds)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def determined(docs: DataFrame, least: float = 0.35, **bounds: int) -> DataFrame:
    """The rows of docs whose language can be told: not 'und', and with a score of `least` or more."""
    field = learn(docs, **bounds)

    def chooser() -> Callable[[list[str | None]], list[bool]]:
        labeller = Labeller(field)
        return lambda texts: [k != UNDETERMINED and s >= least for k, s, in zip(*labeller(texts)[:2], strict=True)]

    return rows_kept(docs, chooser, most=SLICE)
