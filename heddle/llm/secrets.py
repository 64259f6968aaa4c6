"""Secret scan: stochastic automata inferred from labelled credentials score every candidate by format likelihood.

Three base patterns label credentials in the corpus. A bounded sample of each kind is split into formats, by a prefix
that many share or else by the marks within. Of each format a prefix tree is built and its statistically compatible
states are merged (red-blue order, Hoeffding bounds on the frequencies of symbols and ends, into the state that makes
what follows likeliest), which leaves a probabilistic automaton. Ordinary tokens give a chain over pairs of symbols: of
those in a single case or of digits at first, and then of all that do not look like secrets, for there may be unlabelled
ones among them. Each candidate token outside the base spans is then scored: it is a secret when its mean log likelihood
under some format is as high as a labelled credential's, and above that of ordinary tokens by a margin that hardly any
of these reach.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import batch_of, in_arrow, pieces, project, rows_changed, written

# The base patterns, their least lengths (of the value for assign) and the order of kinds.
KINDS = ("assign", "access", "hex", "format")
WORDS = "password|passwd|secret|token|api_?key"  # letters in either case
VALUE = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
CANDIDATE = r"[A-Za-z0-9+/_=-][A-Za-z0-9+/_.=-]{10,}[A-Za-z0-9+/_=-]"  # the alphabet of assign values and its least length; no dot at an end

SYMBOLS = 68  # of the base patterns' alphabet, and the end
BACKED = 2.0  # observations that the symbols' overall frequencies stand for in each state
MARGIN = 0.4  # nats a symbol above the model of ordinary tokens, at least
ORDINARY = 0.995  # share of ordinary tokens that the margin keeps out
LEAST_SAMPLE = 10  # credentials by which a format can be told

_assign = re.compile(f"(?ai:{WORDS}){VALUE}")
_access = re.compile(ACCESS)
_hex = re.compile(f"[0-9a-f]{{{LEAST['hex']},}}")  # the same runs that HEX finds and the length then keeps
_candidate = re.compile(CANDIDATE)
_marks = str.maketrans("", "", "+/_.=-")
_begin = re.compile(r"[A-Za-z0-9]{1,8}[-_.]")


class PrefixTree:
    """Counts of a sample's prefixes; node 0 is the root."""

    def __init__(self, sample: Iterable[str]):
        self.seen, self.ends, self.next, self.taken = [0], [0], [{}], [{}]
        for word in sample:
            node = 0
            self.seen[0] += 1
            for c in word:
                self.taken[node][c] = self.taken[node].get(c, 0) + 1
                if c not in self.next[node]:
                    self.next[node][c] = len(self.seen)
                    self.seen.append(0)
                    self.ends.append(0)
                    self.next.append({})
                    self.taken.append({})
                node = self.next[node][c]
                self.seen[node] += 1
            self.ends[node] += 1

    def compatible(self, a: int, b: int, bound: float) -> bool:
        """Whether all frequencies below a and b are within the Hoeffding bound of each other."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.seen[a], self.seen[b]
            if not n or not m:
                continue
            gap = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > gap:
                return False
            for c in self.taken[a].keys() | self.taken[b].keys():
                if abs(self.taken[a].get(c, 0) / n - self.taken[b].get(c, 0) / m) > gap:
                    return False
                if c in self.next[a] and c in self.next[b]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def fold(self, into: int, tree: int) -> None:
        """Adds the counts of a subtree to those of the states that its words reach from `into`."""
        todo = [(into, tree)]
        while todo:
            into, tree = todo.pop()
            self.seen[into] += self.seen[tree]
            self.ends[into] += self.ends[tree]
            for c, n in self.taken[tree].items():
                self.taken[into][c] = self.taken[into].get(c, 0) + n
                if c in self.next[into]:
                    todo.append((self.next[into][c], self.next[tree][c]))
                else:
                    self.next[into][c] = self.next[tree][c]

    def merged(self, alpha: float) -> list[int]:
        """Merges states; returns those that stay. A state that fits none of them stays itself."""
        bound = math.sqrt(math.log(2 / alpha) / 2)
        red = [0]
        while True:
            kept = set(red)
            blue = {}
            for r in red:
                for c in sorted(self.next[r]):
                    if self.next[r][c] not in kept:
                        blue.setdefault(self.next[r][c], (r, c))
            if not blue:
                return red
            q = max(blue, key=lambda s: (self.seen[s], -s))
            parent, symbol = blue[q]
            fit = [r for r in red if self.compatible(r, q, bound)]
            if fit:
                r = max(fit, key=lambda r: (self.likelihood(r, q), -r))
                self.next[parent][symbol] = r
                self.fold(r, q)
            else:
                red.append(q)

    def likelihood(self, state: int, other: int) -> float:
        """Log likelihood of what follows in `other` by the frequencies in `state`."""
        total = math.log(self.seen[state] + 0.1 * SYMBOLS)
        found = self.ends[other] * (math.log(self.ends[state] + 0.1) - total)
        return found + sum(n * (math.log(self.taken[state].get(c, 0) + 0.1) - total) for c, n in self.taken[other].items())


class Automaton:
    """A probabilistic automaton with smoothed transitions; score() is the mean log likelihood of a symbol."""

    def __init__(self, sample: Iterable[str], alpha: float = 0.05):
        tree = PrefixTree(sorted(sample))
        states = tree.merged(alpha)
        number = {s: i for i, s in enumerate(states)}
        overall, leads = Counter(), defaultdict(Counter)
        for s in states:
            overall.update(tree.taken[s])
            for c, n in tree.taken[s].items():
                leads[c][number[tree.next[s][c]]] += n
        size = sum(overall.values()) + SYMBOLS
        self.usual = {c: (n + 1) / size for c, n in overall.items()}
        self.unseen = 1 / size
        self.after = {c: max(sorted(n), key=n.__getitem__) for c, n in leads.items()}  # where a symbol leads most often
        self.steps, self.weight, self.end = [], [], []
        for s in states:
            total = tree.seen[s] + BACKED
            self.steps.append({c: (math.log((n + BACKED * self.usual[c]) / total), number[tree.next[s][c]]) for c, n in tree.taken[s].items()})
            self.weight.append(math.log(BACKED / total))
            self.end.append(math.log((tree.ends[s] + BACKED / SYMBOLS) / total))

    def score(self, word: str) -> float:
        """A symbol that its state has never seen has its overall frequency, and leads where it does most often."""
        state, total = 0, 0.0
        for c in word:
            step = self.steps[state].get(c)
            if step is None:
                step = self.weight[state] + math.log(self.usual.get(c, self.unseen)), self.after.get(c, state)
            total += step[0]
            state = step[1]
        return (total + self.end[state]) / (len(word) + 1)


class Chain:
    """Frequencies of symbols after the one before; score() is the mean log likelihood of a symbol."""

    def __init__(self, sample: Iterable[str]):
        pairs, firsts, overall = Counter(), Counter(), Counter()
        for word in sample:
            pairs.update(zip("^" + word, word + "$"))
            firsts.update("^" + word)
            overall.update(word + "$")
        size = sum(overall.values()) + SYMBOLS
        self.usual, self.unseen = {c: math.log((n + 1) / size) for c, n in overall.items()}, -math.log(size)
        self.firsts = firsts
        self.pairs = {p: math.log((n + BACKED * math.exp(self.usual[p[1]])) / (firsts[p[0]] + BACKED)) for p, n in pairs.items()}

    def score(self, word: str) -> float:
        total = 0.0
        for p in zip("^" + word, word + "$"):
            known = self.pairs.get(p)
            total += math.log(BACKED / (self.firsts[p[0]] + BACKED)) + self.usual.get(p[1], self.unseen) if known is None else known
        return total / (len(word) + 1)


def by_format(sample: list[str]) -> dict[str, list[str]]:
    """Credentials by format: a beginning up to a mark that enough of them share, or else the kinds of marks within.

    Formats of too few go together.
    """
    begins = Counter(m[0] for w in sample if (m := _begin.match(w)))
    groups, out = defaultdict(list), defaultdict(list)
    for w in sample:
        m = _begin.match(w)
        shared = m is not None and begins[m[0]] >= LEAST_SAMPLE
        groups[m[0] if shared else "".join(sorted({"+" if c in "+/=" else c for c in w if not c.isalnum()}))].append(w)
    for name, words in groups.items():
        out[name if len(words) >= LEAST_SAMPLE else "other"] += words
    return out


class Formats:
    """Automata of the formats with the least score of each, and the model of ordinary tokens with its margin."""

    def __init__(self, credentials: dict[str, list[str]], ordinary: list[str], quantile: float = 0.02):
        self.kinds, self.margin, self.ordinary = [], MARGIN, None
        for kind in KINDS[:-1]:
            for sample in by_format(credentials.get(kind) or []).values():
                if len(sample) < LEAST_SAMPLE:
                    continue
                automaton = Automaton([w for i, w in enumerate(sample) if i % 5])
                scores = sorted(automaton.score(w) for w in sample[::5])
                self.kinds.append((automaton, scores[int(quantile * len(scores))] - 3 * spread(scores) / len(scores)))
        kept = [w for w in ordinary if single_class(w)]
        for _ in range(3):
            self.ordinary = Chain(kept) if kept else None
            kept = [w for w in ordinary if self.score(w) is None]
        if kept:
            self.ordinary = Chain([w for i, w in enumerate(kept) if i % 5])
            over = sorted(max(a.score(w) for a, _ in self.kinds) - self.usual(w) for w in kept[::5]) if self.kinds else [0.0]
            self.ordinary, self.margin = Chain(kept), max(MARGIN, min(2 * MARGIN, over[int(ORDINARY * (len(over) - 1))]))

    def usual(self, word: str) -> float:
        """The score as an ordinary token: by the chain, or as any string of its class."""
        chain = self.ordinary.score(word) if self.ordinary else -math.log(SYMBOLS) - self.margin
        return max(chain, -math.log(single_class(word) or math.inf))

    def score(self, word: str) -> float | None:
        """The excess over ordinary tokens, if the word has one of the formats; else None. Of several the best counts."""
        best = max((s for a, least in self.kinds if (s := a.score(word)) >= least), default=None)
        if best is None:
            return None
        over = best - self.usual(word)
        return over if over >= self.margin else None


def single_class(word: str) -> int | None:
    """How many symbols there are of a word that has digits only, or letters of one case after its first, and marks."""
    bare = word.translate(_marks)
    if not bare or bare.isdecimal():
        return 16
    return 32 if bare.isalpha() and (bare[1:].islower() or bare.isupper()) else None


def spread(values: list[float]) -> float:
    mean = sum(values) / len(values)
    return math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))


def base_spans(text: str) -> list[tuple[int, int, int, float | None]]:
    """(start, kind number, end, None) of the base patterns' matches."""
    found = [(m.start(), 0, m.end(), None) for m in _assign.finditer(text) if m.end(1) - m.start(1) >= LEAST["assign"]]
    found += [(m.start(), 1, m.end(), None) for m in _access.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), 2, m.end(), None) for m in _hex.finditer(text)]
    return found


def labelled(docs: DataFrame) -> DataFrame:
    """(kind, word) that occur in the corpus: labelled credentials, and as kind '' the candidates that are none."""
    found = lambda pattern, kind, group: F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(group)), lambda w: F.struct(F.lit(kind).alias("kind"), w.alias("word")))
    every = F.concat(found(f"(?i:{WORDS}){VALUE}", "assign", 1), found(ACCESS, "access", 0), found(f"[0-9a-f]{{{LEAST['hex']},}}", "hex", 0), found(CANDIDATE, "", 0))
    rows = project(docs, text="string").where(F.col("text").isNotNull()).select(F.explode(every).alias("x")).select("x.kind", "x.word")
    least = F.create_map(*[F.lit(v) for kv in LEAST.items() for v in kv])[F.col("kind")]
    return rows.where((F.col("kind") == "") | (F.length("word") >= least)).distinct()


def learn(docs: DataFrame, per_kind: int = 400, ordinary: int = 2000, longest: int = 256) -> Formats:
    """Fits on at most per_kind credentials of a kind and so many ordinary tokens, those of the lowest hash.

    Longer words than `longest` are not learned from. These bounds are all that the driver ever holds.
    """
    words = written(labelled(docs), "credentials").where(F.length("word") <= longest)
    credentials = words.where("kind <> ''")
    pick = lambda df, n: [r.word for r in df.orderBy(F.xxhash64("word"), "word").limit(n).collect()]
    sample = {k: pick(credentials.where(F.col("kind") == k).select("word"), per_kind) for k in KINDS[:-1]}
    return Formats(sample, pick(words.where("kind = ''").join(credentials.select("word").distinct(), "word", "left_anti").select("word"), ordinary))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and digests of scan()'s spans."""
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "format")
    return scanned.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        count("format").alias("n_format"),
    )


class Finder:
    """All spans (start, kind number, end, score) of a text, in order; keeps the scores of the words it has met."""

    def __init__(self, formats: Formats):
        self.formats, self.known = formats, {}

    def __call__(self, text: str | None) -> list[tuple[int, int, int, float | None]]:
        if not text:
            return []
        spans, known = base_spans(text), self.known
        base = list(spans)
        for m in _candidate.finditer(text):
            word = m[0]
            if word not in known:
                if len(known) >= 100_000:
                    known.clear()
                known[word] = self.formats.score(word)
            if known[word] is not None and not any(s[0] <= m.start() and m.end() <= s[2] for s in base):
                spans.append((m.start(), 3, m.end(), known[word]))
        return sorted(spans, key=lambda s: s[:3])


def hide(text: str | None, spans: list[tuple[int, int]], mask: str) -> str | None:
    """The text with each run of overlapping (start, end) put out by the mask."""
    parts, at = [], 0
    for start, end in spans:
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join([*parts, text[at:]]) if spans else text


def scan(docs: DataFrame, formats: Formats) -> DataFrame:
    """(doc_id, spans) of every whole text: spans are structs (kind, start, end, score) by start, then kind.

    Offsets are code points, ends exclusive. Base spans have no score. Spans of kind 'format' are whole candidates that
    lie in no base span; one may lie in them. Formats that score alike give the same span.
    Null and empty texts have no span; repeated rows stay.
    """
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(kind))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(formats)
        for batch in pieces(batches, "text"):
            found = [finder(t) for t in batch.column(1).to_pylist()]
            yield batch_of(schema, [batch.column(0), [[{"kind": KINDS[k], "start": s, "end": e, "score": x} for s, k, e, x in spans] for spans in found]])

    wanted = "doc_id long, spans array<struct<kind:string,start:long,end:long,score:double>>"
    return in_arrow(project(docs, doc_id="long", text="string"), run, wanted)


def scan_learned(docs: DataFrame, **bounds: int) -> DataFrame:
    """Learns the formats from docs and scans them."""
    return scan(docs, learn(docs, **bounds))


def masked(docs: DataFrame, mask: str = "[secret]", **bounds: int) -> DataFrame:
    """The rows of docs, all columns, with every secret in their texts put out by the mask and n_chars made right."""
    formats = learn(docs, **bounds)

    def changer() -> Callable[[list[str | None]], list[str | None]]:
        finder = Finder(formats)
        return lambda texts: [hide(t, [(s[0], s[2]) for s in finder(t)], mask) for t in texts]

    return rows_changed(docs, changer)
