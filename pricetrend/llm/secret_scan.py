"""Secret scans with inferred credential grammars.

Three fixed patterns find the base credentials. The strings they match are the
labelled examples: for each kind, a prefix tree of their character classes is
generalised by merging states that are statistically compatible (Hoeffding
bounds on their outgoing frequencies, applied to all successors), which gives
a probabilistic automaton. All other long tokens of a text are candidates, whole
and in parts: from the start or after any sign (``+/_.=-``), up to the end or before
any sign. A part becomes an added span if

- an automaton can generate it, and its likelihood per symbol is at least that of nearly
  all labelled examples. Merged states forget how long a credential is, so the likelihood
  has a factor for the length: a Gaussian kernel around each example's length, half that
  length wide. No length is ruled out as such; and
- it is ``margin`` nats likelier by the automaton than as ordinary text: a Markov chain of
  character classes, counted over all texts outside their base spans. It may be in its own
  or in the opposite case, since names in capitals are ordinary, too.

Of accepted parts that overlap the longest wins, then the first.

At most ``per_kind`` examples of a kind are learnt from: those of smallest hash
among the distinct matches of all documents, each task sending no more than
that. Base spans never depend on the automata.

Null texts count as empty; empty texts have no spans, and an empty table gives no rows and
no automata. Very long texts are scanned whole; a pass over a very long candidate ends where no
continuation could reach the least likelihood any more. Offsets count code points, ends are
exclusive. Repeated rows are scanned row by row. An input column named as the output one is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from pricetrend.llm.common import cut_lineage, slices, without

# The base patterns, the least length of what they match, and their order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
KINDS = ["assign", "access", "hex"]
KEYWORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

SIGNS = "+/_.=-"
SIGN = re.compile(r"[+/_.=-]")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{12,}")
SPAN = StructType([StructField("kind", StringType()), StructField("start", LongType()),
                   StructField("end", LongType()), StructField("score", DoubleType())])


@dataclass(frozen=True)
class SecretParams:
    per_kind: int = 500
    alpha: float = 0.05         # of the Hoeffding test; smaller merges more
    quantile: float = 0.02      # share of the labelled examples that may score lower than a candidate
    spread: float = 0.5         # width of the length kernel, as a share of the example's length
    margin: float = 20.0        # nats by which a candidate must be likelier than ordinary text
    least_examples: int = 20    # below this many, a kind has no automaton


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, order of kind, end, credential) of the base matches."""
    out = []
    if (":" in text or "=" in text) and any(k in (low := text.lower()) for k in KEYWORDS):
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    out.sort()
    return out


def symbols(token: str) -> str:
    """Character classes: digit, a-f, g-z, A-F, G-Z; other characters are themselves."""
    return token.translate(_CLASSES)


_CLASSES = {ord(c): k for chars, k in (("0123456789", "0"), ("abcdef", "a"), ("ghijklmnopqrstuvwxyz", "g"),
                                       ("ABCDEF", "A"), ("GHIJKLMNOPQRSTUVWXYZ", "G")) for c in chars}


# The classes by the byte of their character; everything else separates words.
ORDINARY = "0aAgG" + SIGNS + " "
_CODES = np.full(256, len(ORDINARY) - 1, np.uint8)
for _c in range(128):
    if chr(_c).isalnum() or chr(_c) in SIGNS:
        _CODES[_c] = ORDINARY.index(symbols(chr(_c)))


def count_pairs(text: str, counts: np.ndarray) -> None:
    """Add the adjacent classes of ``text``, piece by piece, to ``counts``."""
    n = len(ORDINARY)
    for at in range(0, len(text), 1 << 20):
        codes = _CODES[np.frombuffer(f" {text[at:at + (1 << 20)]} ".encode("utf-8", "replace"), np.uint8)]
        counts += np.bincount(codes[:-1].astype(np.int64) * n + codes[1:], minlength=n * n)


def chain(counts: np.ndarray, lean: float = 0.01) -> dict[str, float]:
    """Log-probability of each class after another one, and of each class alone. What follows a
    rare class may be known from credentials only, so each class gets the overall frequencies
    as further ``lean`` of all pairs."""
    n = len(ORDINARY)
    pairs = counts.reshape(n, n) + 0.5
    alone = pairs.sum(0) / pairs.sum()
    after = pairs + lean * pairs.sum() * alone
    after = np.log(after / after.sum(1, keepdims=True))
    out = {x + y: float(after[i, j]) for i, x in enumerate(ORDINARY) for j, y in enumerate(ORDINARY)}
    return out | {x: float(np.log(alone[i])) for i, x in enumerate(ORDINARY)}


@dataclass
class Automaton:
    """A probabilistic automaton: log-probabilities of the moves (given that the token goes
    on), which states may end a token, and of the lengths (from 0 to the last one that can
    reach ``least``); the chain of ordinary text (empty: no comparison)."""

    moves: list[dict[str, tuple[int, float]]] = field(default_factory=list)
    ends: list[bool] = field(default_factory=list)
    lengths: list[float] = field(default_factory=list)
    least: float = 0.0
    margin: float = 0.0
    ordinary: dict[str, float] = field(default_factory=dict)

    def score(self, token: str) -> float:
        """Mean log-likelihood per symbol, the length included; -inf if it can't be generated."""
        return dict(self.scores(symbols(token), 0, {len(token)})).get(len(token), -math.inf)

    def scores(self, classes: str, start: int, ends: set[int]) -> Iterator[tuple[int, float]]:
        """Each of ``ends`` up to which it can generate the symbols from ``start`` on, and the score."""
        state, total = 0, 0.0
        for at in range(start, min(len(classes), start + len(self.lengths) - 1)):
            step = self.moves[state].get(classes[at])
            if step is None:
                return
            state, p = step
            total += p
            if at + 1 in ends and self.ends[state]:
                n = at + 1 - start
                yield at + 1, (total + self.lengths[n]) / (n + 1)

    def accepted(self, classes: str, start: int, ends: set[int]) -> Iterator[tuple[int, float]]:
        """The ends of the parts from ``start`` on that pass both tests, with the score above ``least``."""
        own, other, at, swapped = 0.0, 0.0, start, ""
        for end, score in self.scores(classes, start, ends):
            if score < self.least:
                continue
            if self.ordinary:
                if not swapped:
                    swapped = classes[start:start + len(self.lengths)].swapcase()
                while at < end:
                    last = at if at == start else at - 1
                    own += self.ordinary[classes[last:at + 1]]
                    other += self.ordinary[swapped[last - start:at + 1 - start]]
                    at += 1
                if score * (end - start + 1) - max(own, other) < self.margin:
                    continue
            yield end, score - self.least


def length_model(tokens: list[str], spread: float, size: int) -> np.ndarray:
    """Log-probabilities of the lengths below ``size``: a kernel around each example's length."""
    at, out = np.arange(size, dtype=np.float64), np.full(size, -np.inf)
    for n, times in sorted(Counter(map(len, tokens)).items()):
        wide = max(1.0, spread * n)
        out = np.logaddexp(out, math.log(times / len(tokens) / (wide * math.sqrt(2 * math.pi))) - 0.5 * ((at - n) / wide) ** 2)
    return out


def infer(tokens: list[str], params: SecretParams = SecretParams(),
          ordinary: dict[str, float] | None = None) -> Automaton | None:
    """Merge the prefix tree of the tokens' classes into an automaton (None if too few)."""
    if len(tokens) < params.least_examples:
        return None
    kids: list[dict[str, int]] = [{}]
    passed, ended, flow = [0], [0], [defaultdict(int)]
    for token in sorted(tokens):
        at = 0
        passed[0] += 1
        for s in symbols(token):
            flow[at][s] += 1
            if s not in kids[at]:
                kids[at][s] = len(kids)
                kids.append({})
                passed.append(0)
                ended.append(0)
                flow.append(defaultdict(int))
            at = kids[at][s]
            passed[at] += 1
        ended[at] += 1
    bound = math.sqrt(0.5 * math.log(2.0 / params.alpha))

    def differ(x: int, n: int, y: int, m: int) -> bool:
        return abs(x / n - y / m) > bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if differ(ended[a], passed[a], ended[b], passed[b]):
                return False
            for s in flow[a].keys() | flow[b].keys():
                if differ(flow[a].get(s, 0), passed[a], flow[b].get(s, 0), passed[b]):
                    return False
            todo += [(kids[a][s], kids[b][s]) for s in kids[b] if s in kids[a]]
        return True

    def fold(a: int, b: int) -> None:
        """Add the subtree of b to a; b's tree is disjoint from the finished states."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            passed[a] += passed[b]
            ended[a] += ended[b]
            for s, n in flow[b].items():
                flow[a][s] += n
            for s, k in kids[b].items():
                if s in kids[a]:
                    todo.append((kids[a][s], k))
                else:
                    kids[a][s] = k

    red, blue = [0], [(0, s) for s in sorted(kids[0])]
    while blue:
        parent, s = blue.pop(0)
        node = kids[parent][s]
        if node in red:
            continue
        for r in red:
            if compatible(r, node):
                kids[parent][s] = r
                fold(r, node)
                break
        else:
            red.append(node)
        blue = sorted({(r, s) for r in red for s in kids[r] if kids[r][s] not in red})
    index = {r: i for i, r in enumerate(red)}
    out = Automaton(margin=params.margin, ordinary=ordinary or {})
    for r in red:
        on = passed[r] - ended[r]
        out.moves.append({s: (index[k], math.log(flow[r][s] / on)) for s, k in sorted(kids[r].items())})
        out.ends.append(ended[r] > 0)
    size = 4 * max(map(len, tokens)) + 2
    out.lengths = length_model(tokens, params.spread, size).tolist()
    scores = sorted(out.score(t) for t in tokens)
    out.least = scores[int(params.quantile * (len(scores) - 1))]
    # The likeliest symbol throughout bounds every score; beyond the last length at which the
    # bound reaches ``least`` no pass goes on.
    top = max(p for m in out.moves for _, p in m.values())
    while True:
        lengths = length_model(tokens, params.spread, size)
        bound = (np.arange(size) * top + lengths) / (np.arange(size) + 1)
        if bound[-1] < out.least and bound[-1] < bound[-2]:
            break
        size *= 2
    out.lengths = lengths[:int(np.flatnonzero(bound >= out.least)[-1]) + 1].tolist()
    return out


def learn(df: DataFrame, params: SecretParams = SecretParams(), text: str = "text") -> dict[str, Automaton]:
    """The automaton of each kind, from the base credentials of all texts of ``df``."""
    most = params.per_kind

    def smallest(rows: dict[int, dict[str, int]]) -> dict[int, dict[str, int]]:
        return {k: dict(sorted(v.items(), key=lambda x: (x[1], x[0]))[:most]) for k, v in rows.items()}

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, dict[str, int]] = {0: {}, 1: {}, 2: {}}
        pairs = np.zeros(len(ORDINARY) ** 2, np.int64)
        for part in slices(batches):
            for t in part.column(text).to_pylist():
                base = base_spans(t or "")
                for _, k, _, token in base:
                    seen[k].setdefault(token, xxhash.xxh64_intdigest(token, 7) >> 1)
                count_pairs(masked(t or "", [("", s, e, None) for s, _, e, _ in base], " "), pairs)
            if any(len(v) > 8 * most for v in seen.values()):
                seen = smallest(seen)
        rows = [(KINDS[k], h, t, 1) for k, v in smallest(seen).items() for t, h in v.items()]
        rows += [("", int(i), "", int(pairs[i])) for i in np.flatnonzero(pairs)]
        yield pa.RecordBatch.from_pylist([dict(zip(("kind", "hash", "token", "n"), r)) for r in rows],
                                         pa.schema([("kind", pa.string()), ("hash", pa.int64()),
                                                    ("token", pa.string()), ("n", pa.int64())]))

    found = cut_lineage(df.select(text).mapInArrow(sample, "kind string, hash long, token string, n long")
                        .groupBy("kind", "hash", "token").agg(F.sum("n").alias("n")), "credentials")
    pairs = np.zeros(len(ORDINARY) ** 2, np.int64)
    for r in found.where("kind = ''").collect():  # one row for each pair of classes
        pairs[r["hash"]] = r["n"]
    out = {}
    for kind in KINDS:  # each at most per_kind strings
        rows = found.where(F.col("kind") == kind).orderBy("hash", "token").limit(most).collect()
        if automaton := infer([r["token"] for r in rows], params, chain(pairs)):
            out[kind] = automaton
    return out


def parts(token: str) -> tuple[list[int], set[int]]:
    """Where parts of a candidate may start (after a sign), and where they may end (before one)."""
    signs = [m.start() for m in SIGN.finditer(token)]
    return [0, *(p + 1 for p in signs if p + 1 < len(token))], {len(token), *signs}


def added(token: str, automata: dict[str, Automaton], taken: list[tuple[int, int]]) -> list[tuple[int, int, str, float]]:
    """The accepted parts of a candidate (start, end, kind, score) that overlap neither
    ``taken`` nor a longer one, or an earlier one of the same length."""
    starts, ends = parts(token)
    classes, best = symbols(token), {}
    for start in starts:
        for k, a in automata.items():
            for end, score in a.accepted(classes, start, ends):
                best[start, end] = max(best.get((start, end), (-math.inf, "")), (score, k))
    out, used = [], bytearray(len(token))
    for s, e in taken if best else []:
        s, e = max(0, s), min(len(token), e)
        used[s:e] = b"\1" * max(0, e - s)
    for start, end in sorted(best, key=lambda x: (x[0] - x[1], x[0])):
        if 1 not in used[start:end]:
            used[start:end] = b"\1" * (end - start)
            out.append((start, end, best[start, end][1], best[start, end][0]))
    return out


def find(text: str, automata: dict[str, Automaton]) -> list[tuple[str, int, int, float | None]]:
    """All spans of a text: the base ones (score null) and the added ones, ordered
    by start, then base kinds as listed, then added kinds."""
    base = base_spans(text)
    out = [(s, k, KINDS[k], e, None) for s, k, e, _ in base]
    if automata:
        taken, i = sorted((s, e) for s, _, e, _ in base), 0
        for m in CANDIDATE.finditer(text):
            while i < len(taken) and taken[i][1] <= m.start():
                i += 1
            j = i
            while j < len(taken) and taken[j][0] < m.end():
                j += 1
            out += [(m.start() + s, len(KINDS) + KINDS.index(k), "grammar_" + k, m.start() + e, score)
                    for s, e, k, score in added(m[0], automata, [(s - m.start(), e - m.start()) for s, e in taken[i:j]])]
    out.sort(key=lambda x: x[:2])
    return [(kind, s, e, score) for s, _, kind, e, score in out]


def scan(df: DataFrame, automata: dict[str, Automaton], text: str = "text", spans: str = "spans") -> DataFrame:
    """The other columns of ``df`` with all spans of ``text`` (array of kind, start, end, score)."""
    df = without(df, {spans} - {text})
    carried = [c for c in df.columns if c.lower() != text.lower()]
    schema = StructType([*(df.schema[c] for c in carried), StructField(spans, ArrayType(SPAN))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            got = [[dict(zip(("kind", "start", "end", "score"), s)) for s in find(t or "", automata)]
                   for t in part.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), pa.array(got, kind)], schema.names)

    return df.mapInArrow(run, schema)


def masked(text: str, spans: list[tuple[str, int, int, float | None]], mark: str) -> str:
    """The text with each span, or run of overlapping spans, replaced by ``mark``."""
    out, at = [], 0
    for _, start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def redact(df: DataFrame, automata: dict[str, Automaton], text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every span of ``text`` replaced by ``mark``; null texts stay null."""
    schema, place = df.schema, df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            got = [None if t is None else masked(t, find(t, automata), mark) for t in part.column(place).to_pylist()]
            columns = list(part.columns)
            columns[place] = pa.array(got, pa.string())
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return df.mapInArrow(run, schema)
