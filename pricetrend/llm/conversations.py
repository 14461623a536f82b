"""Conversation structure repair by Four-Russians block tables.

The rows of a conversation, by turn (nulls first; ties by role, then text), are to
become ``(s?(ua)+)?`` in role initials: nothing, or an optional system row and
then user and assistant in turns. Edits are Keep (0), Rerole to user or
assistant (1), Delete (2; blank and duplicate rows must go) and Insert of an
empty user or assistant row (5); a truncated row that stays costs 5 more. Of the
cheapest edits those whose initials are ASCII-least win.

What is left to pay after a row depends on the state of the pattern (start,
after s, after u, after a): a vector of four costs. Less their minimum only a few
dozen such vectors can occur, so they are numbered. For every block of ``block``
symbols (what a row is, as far as edits care) and every numbered vector a table
has the vector before the block and what was added to the minimum. Conversations
go from their last block to their first by one lookup a block. Then each
block is expanded backward, from the vector at its right end, and the edits are
read off forward; among equal costs the least initial is taken, which is safe
because the vector after every row is exact.

Conversations of up to ``long_rows`` rows and ``long_bytes`` of text are dealt by id and
sorted inside partitions; a task holds one batch and one conversation. Longer
ones are split: equal rows become one with a number, the rest is sorted over
all tasks by range, and each (conversation, piece) gives its block function,
that is, for all numbered vectors and states at once. The functions of the pieces
(a row each) are put together, and each piece then expands on its own. Only the
digest and the string of edits, one value each by definition, pass a single
task, as a stream.

Null roles and texts count as one blank. Null ids are a conversation of their
own. Very long texts stay whole. Without rows after damage everything is zero and the digest that
of the empty string. An empty table gives no rows. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType, StructField, StructType

from pricetrend.llm.common import cut_lineage

# Blanks, the signs that end a text, costs of the edits.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = [".", "!", "?"]
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# Symbols: initial s, u, a, other (plus 4: truncated), a row that must go, and no row at all.
OTHER, GONE, NONE = 3, 8, 9
# States: start, after s, after u, after a. What an inserted or reroled row is there, and where it leads.
START, S, U, A = range(4)
NEXT = [U, U, A, U]
FILLER = ["user", "user", "assistant", "user"]
KEPT = {(START, 0): S, (START, 1): U, (S, 1): U, (A, 1): U, (U, 2): A}
OPS = "DKR"


@dataclass(frozen=True)
class RepairParams:
    block: int = 3
    long_rows: int = 100_000
    long_bytes: int = 1 << 26
    per_piece: int = 50_000


class Tables:
    """Numbered cost vectors, single-row and block transitions, and the edits of a row."""

    def __init__(self, block: int):
        end = (0, 2 * INSERT, INSERT, 0)
        self.vectors, number = [end], {end: 0}
        step: list[list[tuple[int, int]]] = []
        edits: list[list[list[tuple[int, int, int]]]] = []      # vector, symbol, state -> inserts, op, next state
        i = 0
        while i < len(self.vectors):
            step.append([])
            edits.append([])
            for symbol in range(10):
                cost, edit = self._row(self.vectors[i], symbol)
                low = min(cost)
                vector = tuple(c - low for c in cost)
                if vector not in number:
                    number[vector] = len(self.vectors)
                    self.vectors.append(vector)
                step[i].append((number[vector], low))
                edits[i].append(edit)
            i += 1
        self.costs = np.array(self.vectors, np.int64)
        self.to, self.low = np.array(step, np.int64).transpose(2, 1, 0)      # symbol x vector
        self.inserts, self.op, self.next = np.array(edits, np.int64).transpose(3, 1, 0, 2)     # symbol x vector x state
        self.block = block
        # Blocks of symbols, the first symbol as the highest digit.
        to, low = np.arange(len(self.vectors))[None, :], np.zeros((1, len(self.vectors)), np.int64)
        for _ in range(block):
            # One more symbol in front of every block so far: first the block, then the symbol.
            low = (low[None, :, :] + self.low[:, to]).reshape(-1, len(self.vectors))
            to = self.to[:, to].reshape(-1, len(self.vectors))
        self.block_to, self.block_low = to, low

    @staticmethod
    def _row(after: tuple, symbol: int) -> tuple[tuple, list[tuple[int, int, int]]]:
        """Costs before a row and its edits in each state, from the costs after it."""
        if symbol == NONE:
            return after, [(0, 3, q) for q in range(4)]
        own: list[dict[str, tuple[int, int]]] = []
        for q in range(4):
            ways = {"D": (DELETE + after[q], q)}
            if symbol != GONE:
                extra, kind = TRUNCATED * (symbol >= 4), symbol % 4
                if (q, kind) in KEPT:
                    ways["K"] = (KEEP + extra + after[KEPT[q, kind]], KEPT[q, kind])
                ways["R"] = (REROLE + extra + after[NEXT[q]], NEXT[q])
            own.append(ways)
        best = [min(c for c, _ in w.values()) for w in own]
        chain = [[q, NEXT[q], NEXT[NEXT[q]], NEXT[NEXT[NEXT[q]]]] for q in range(4)]
        cost = tuple(min(INSERT * k + best[s] for k, s in enumerate(chain[q])) for q in range(4))
        edits = []
        for q in range(4):
            n, at = 0, q
            while True:
                ways = {k: v for k, v in own[at].items() if v[0] == cost[at]}
                more = cost[at] == INSERT + cost[NEXT[at]]
                least = min([*ways, *("I" * more)])
                if least != "I":
                    edits.append((n, OPS.index(least), ways[least][1]))
                    break
                n, at = n + 1, NEXT[at]
        return cost, edits

    def ending(self, q: int) -> int:
        """How many rows are inserted after the last one."""
        return int(self.costs[0][q]) // INSERT

    def backward(self, symbols: np.ndarray, starts: np.ndarray, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Block lookups from the last to the first row of each sequence, all side by side.

        ``starts`` has the first position of each sequence (and the end of all), ``vector`` the
        numbered vectors after them. Returns the vectors and what was added before each sequence,
        and for each row of the padded blocks its symbol and the vector after it.
        """
        size = np.diff(starts)
        blocks = -(-size // self.block)
        first = np.concatenate([[0], np.cumsum(blocks)])
        padded = np.full(first[-1] * self.block, NONE, np.int64)
        fill = blocks * self.block - size       # padding stands before a sequence
        padded[np.arange(len(symbols)) + np.repeat(first[:-1] * self.block + fill - starts[:-1], size)] = symbols
        digits = padded.reshape(-1, self.block)
        code = digits @ (10 ** np.arange(self.block - 1, -1, -1))
        vector, added, right = vector.copy(), np.zeros(len(size), np.int64), np.zeros(first[-1], np.int64)
        by = np.argsort(-blocks, kind="stable")
        longest = blocks[by]
        for t in range(int(blocks.max(initial=0))):
            live = by[:np.searchsorted(-longest, -t, side="left")]
            b = first[live + 1] - 1 - t
            right[b] = vector[live]
            added[live] += self.block_low[code[b], vector[live]]
            vector[live] = self.block_to[code[b], vector[live]]
        after = np.zeros_like(digits)
        v = right
        for j in range(self.block - 1, -1, -1):     # expand the blocks
            after[:, j] = v
            v = self.to[digits[:, j], v]
        return vector, added, padded, after.ravel()

    def forward(self, symbols: np.ndarray, starts: np.ndarray, vector: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
        """The edits of all rows (inserts before, op, state before) and the state after each sequence;
        also the vectors and sums of ``backward``."""
        vector, added, padded, after = self.backward(symbols, starts, vector)
        size = np.diff(starts)
        first = np.concatenate([[0], np.cumsum(-(-size // self.block))]) * self.block
        at = first[1:] - size
        state, before = state.copy(), np.zeros(len(symbols), np.int64)
        inserts, op = np.zeros_like(before), np.zeros_like(before)
        by = np.argsort(-size, kind="stable")
        longest = size[by]
        for t in range(int(size.max(initial=0))):
            live = by[:np.searchsorted(-longest, -t, side="left")]
            row, q = starts[:-1][live] + t, state[live]
            symbol, v = padded[at[live] + t], after[at[live] + t]
            before[row], inserts[row], op[row] = q, self.inserts[symbol, v, q], self.op[symbol, v, q]
            state[live] = self.next[symbol, v, q]
        return inserts, op, before, state, vector, added


_TABLES: dict[int, Tables] = {}


def tables(block: int) -> Tables:
    if block not in _TABLES:
        _TABLES[block] = Tables(block)
    return _TABLES[block]


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text, copies (0: the row is dropped, 2: repeated) after the damage that
    the crc32 of ``conv:turn`` names."""
    some = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(some(conv), F.lit(":"), some(turn)).cast("binary")) % 20
    return df.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.when(fate == 4, F.lit("user")).otherwise(some(role)).alias("role"),
        F.when(fate == 1, F.lit("")).when(fate == 2, F.regexp_replace(some(text), "[.!?]", "")).otherwise(some(text)).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).cast("long").alias("copies"))


def undamaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The same columns of rows as they are."""
    some = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    return df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), some(role).alias("role"),
                     some(text).alias("text"), F.lit(1).cast("long").alias("copies"))


def _faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``kind`` (0 to 3 by the role's initial, 8 a blank text, plus 4 for a truncated one)."""
    body = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    cut = F.when(F.right(body, F.lit(1)).isin(*ENDS), 0).otherwise(4)
    return rows.withColumn("kind", F.when(body == "", GONE).otherwise(kind + cut).cast("int"))


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _legal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether initials a (0 s, 1 u, 2 a, 3 other) may stand before b."""
    return ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))


def _initials(roles: list[str]) -> np.ndarray:
    return np.array(["sua".find(r[0]) % 4 if r else OTHER for r in roles], np.int64)


def _lines(n: int, op: int, q: int, role: str, text: str) -> list[str]:
    """The repaired rows that one row gives: those inserted before it and, unless deleted, itself."""
    out = []
    for _ in range(n):
        out.append(FILLER[q] + ":")
        q = NEXT[q]
    if op == 1:
        out.append(f"{role}:{text}")
    elif op == 2:
        out.append(f"{FILLER[q]}:{text}")
    return out


def _closing(t: Tables, q: int) -> list[str]:
    out = []
    for _ in range(t.ending(q)):
        out.append(FILLER[q] + ":")
        q = NEXT[q]
    return out


def repair(convs: list, turns: list, roles: list[str], texts: list[str], copies: list[int], kinds: list[int], t: Tables) -> tuple[list, list[tuple]]:
    """The result rows of whole conversations whose rows come in order."""
    ids, own = [], []
    starts, symbols, rows, faults = [0], [], [], []
    i = 0
    while i < len(convs):
        j = i
        seen: set[tuple[str, str]] = set()
        n = [0, 0, 0]
        for j in range(i, len(convs) + 1):
            if j == len(convs) or convs[j] != convs[i]:
                break
            for _ in range(copies[j]):
                key = (roles[j], texts[j])
                if kinds[j] == GONE:
                    n[0] += 1
                    symbols.append(GONE)
                elif key in seen:
                    n[1] += 1
                    symbols.append(GONE)
                else:
                    n[2] += kinds[j] >= 4
                    symbols.append(kinds[j])
                seen.add(key)
                rows.append(j)
        ids.append(convs[i])
        there = [x for x, c in zip(turns[i:j], copies[i:j]) if c and x is not None]
        faults.append((max(there) - min(there) + 1 - len(set(there)) if there else 0, *n))
        starts.append(len(rows))
        i = j
    symbols, cuts = np.array(symbols, np.int64), np.array(starts, np.int64)
    zero = np.zeros(len(ids), np.int64)
    inserts, op, before, state, vector, added = t.forward(symbols, cuts, zero, zero)
    cost = added + t.costs[vector, START]
    initials = _initials([roles[j] for j in rows])
    bad = ~_legal(initials[:-1], initials[1:])
    inserts, op, before = inserts.tolist(), op.tolist(), before.tolist()
    for c, (a, b) in enumerate(zip(starts, starts[1:])):
        lines: list[str] = []
        for k in range(a, b):
            lines += _lines(inserts[k], op[k], before[k], roles[rows[k]], texts[rows[k]])
        q = int(state[c])
        lines += _closing(t, q)
        audit = "".join("I" * inserts[k] + OPS[op[k]] for k in range(a, b)) + "I" * t.ending(q)
        own.append((*faults[c], int(bad[a:max(a, b - 1)].sum()), int(cost[c]), audit,
                    hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()))
    return ids, own


def _schema(conv: DataType, rest: str) -> StructType:
    return StructType([StructField("conv", conv), *StructType.fromDDL(rest).fields])


def _short(rows: DataFrame, p: RepairParams) -> DataFrame:
    """Conversations that a task can hold: dealt by id, sorted, repaired whole."""
    names = [f.split()[0] for f in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables(p.block)
        held: list[list] = [[], [], [], [], [], []]
        kind = None

        def flush(n: int) -> pa.RecordBatch:
            ids, own = repair(*[c[:n] for c in held], t)
            for c in held:
                del c[:n]
            columns = list(zip(*own)) if own else [()] * len(names)
            types = [pa.int64()] * 6 + [pa.string()] * 2
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), *(pa.array(list(c), x) for c, x in zip(columns, types))], ["conv", *names])

        for batch in batches:
            kind = batch.schema.field("conv").type
            for c, name in zip(held, ("conv", "turn", "role", "text", "copies", "kind")):
                c += batch.column(name).to_pylist()
            # All but the last conversation, which may go on in the next batch.
            n = len(held[0])
            while n and held[0][n - 1] == held[0][-1]:
                n -= 1
            if n:
                yield flush(n)
        if held[0]:
            yield flush(len(held[0]))

    dealt = (_faults(rows).repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", "text")
             .select("conv", "turn", "role", "text", "copies", "kind"))
    return dealt.mapInArrow(run, _schema(rows.schema["conv"].dataType, RESULT))


# ------------------------------------------------------------------ conversations too long for one task
def _expanded(g: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all copies of a piece's rows in order, and the row of each."""
    n, kind, seen = (g.column(c).to_numpy() for c in ("n", "kind", "seen"))
    row = np.repeat(np.arange(len(n)), n)
    first = np.concatenate([[True], row[1:] != row[:-1]]) if len(row) else np.zeros(0, bool)
    return np.where(first & ~seen.astype(bool)[row], kind[row], GONE).astype(np.int64), row


def _functions(g: pa.Table, t: Tables) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every numbered vector after a piece: the vector before it, what is added, and where each state ends."""
    symbols, _ = _expanded(g)
    v = len(t.vectors)
    one = np.arange(v)
    _, _, padded, _ = t.backward(symbols, np.array([0, len(symbols)]), np.zeros(1, np.int64))
    to, added = one.copy(), np.zeros(v, np.int64)
    digits = padded.reshape(-1, t.block)
    code = digits @ (10 ** np.arange(t.block - 1, -1, -1))
    right = np.zeros((len(code), v), np.int64)
    for b in range(len(code) - 1, -1, -1):
        right[b] = to
        added += t.block_low[code[b], to]
        to = t.block_to[code[b], to]
    ends = np.tile(np.arange(4), (v, 1))
    for b in range(len(code)):
        after = [right[b]]
        for s in digits[b, :0:-1]:
            after.append(t.to[s, after[-1]])
        for s, x in zip(digits[b], after[::-1]):
            ends = t.next[s, x[:, None], ends]
    return to, added, ends


def _long(rows: DataFrame, n_rows: int, p: RepairParams) -> DataFrame:
    """The same result for conversations that no task should hold."""
    conv = rows.schema["conv"].dataType
    same = rows.where("copies > 0").groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("n")).withColumn("h", F.sha2("text", 256))
    age = F.struct(F.col("turn").isNotNull(), "turn")
    firsts = (same.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("h").alias("x"))
              .agg(F.min(age).alias("first")))
    marked = (same.join(firsts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("h") == F.col("x")))
              .withColumn("seen", age > F.col("first")).drop("c", "r", "x", "h", "first"))
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    pieces = max(1, math.ceil(n_rows / p.per_piece))
    t = cut_lineage(_faults(marked).repartitionByRange(pieces, *order).sortWithinPartitions(*order)
                    .withColumn("pos", F.monotonically_increasing_id()).withColumn("piece", F.shiftright("pos", 33)), "conversation-pieces")

    def summarise(g: pa.Table) -> pa.Table:
        g = g.sort_by("pos")
        to, added, ends = _functions(g, tables(p.block))
        symbols, row = _expanded(g)
        kind, n = g.column("kind").to_numpy(), g.column("n").to_numpy()
        initials = g.column("initial").to_numpy()
        turns = [x for x in g.column("turn").to_pylist() if x is not None]
        blank = int(n[kind == GONE].sum())
        bad = int((~_legal(initials[row][:-1], initials[row][1:])).sum())
        return pa.table({"conv": g.column("conv")[:1], "piece": g.column("piece")[:1], "to": pa.array([to.tolist()], pa.list_(pa.int32())),
                         "added": pa.array([added.tolist()], pa.list_(pa.int64())), "ends": pa.array([ends.ravel().tolist()], pa.list_(pa.int32())),
                         "head": pa.array([int(initials[0])]), "tail": pa.array([int(initials[-1])]), "low": pa.array([min(turns, default=None)], pa.int64()),
                         "high": pa.array([max(turns, default=None)], pa.int64()), "distinct": pa.array([len(set(turns))]), "blank": pa.array([blank]),
                         "duplicate": pa.array([int((symbols == GONE).sum()) - blank]), "truncated": pa.array([int(((symbols >= 4) & (symbols < GONE)).sum())]),
                         "illegal": pa.array([bad])})

    initial = F.substring("role", 1, 1)
    narrow = t.select("conv", "piece", "pos", "turn", "n", "kind", "seen",
                      F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER).cast("long").alias("initial"))
    sums = narrow.groupBy("conv", "piece").applyInArrow(summarise, _schema(
        conv, "piece long, to array<int>, added array<long>, ends array<int>, head long, tail long, low long, high long, "
              "distinct long, blank long, duplicate long, truncated long, illegal long"))

    def together(g: pa.Table) -> pa.Table:
        """Right to left for the vectors, then left to right for the states; a row per piece."""
        rows = g.sort_by("piece").to_pylist()
        k = tables(p.block)
        vector, cost, after = 0, 0, []
        for r in reversed(rows):
            after.append(vector)
            cost += r["added"][vector]
            vector = r["to"][vector]
        cost += int(k.costs[vector][START])
        state, states = START, []
        for r, v in zip(rows, reversed(after)):
            states.append(state)
            state = r["ends"][4 * v + state]
        total = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal")}
        total["illegal"] += int((~_legal(np.array([r["tail"] for r in rows[:-1]], np.int64), np.array([r["head"] for r in rows[1:]], np.int64))).sum())
        known = [r for r in rows if r["low"] is not None]
        shared = sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))   # a turn on both sides of a cut
        gaps = known[-1]["high"] - known[0]["low"] + 1 - (sum(r["distinct"] for r in known) - shared) if known else 0
        n = len(rows)
        return pa.table({"conv": g.column("conv"), "piece": [r["piece"] for r in rows], "vector": after[::-1], "state": states,
                         "closing": [0] * (n - 1) + [1], "gaps": [gaps] * n, **{c: [x] * n for c, x in total.items()}, "cost": [cost] * n})

    joint = "vector long, state long, closing long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    whole = cut_lineage(sums.groupBy("conv").applyInArrow(together, _schema(conv, "piece long, " + joint)), "conversation-functions")

    def expand(g: pa.Table, f: pa.Table) -> pa.Table:
        """The edits and the repaired rows of a piece, a row for each of its rows."""
        g, f, k = g.sort_by("pos"), f.to_pylist()[0], tables(p.block)
        symbols, row = _expanded(g)
        inserts, op, before, state, _, _ = k.forward(symbols, np.array([0, len(symbols)]), np.array([f["vector"]]), np.array([f["state"]]))
        audits, lines = [[] for _ in range(g.num_rows)], [[] for _ in range(g.num_rows)]
        roles, texts = g.column("role").to_pylist(), g.column("text").to_pylist()
        for r, i, o, q in zip(row.tolist(), inserts.tolist(), op.tolist(), before.tolist()):
            audits[r].append("I" * i + OPS[o])
            lines[r] += _lines(i, o, q, roles[r], texts[r])
        if f["closing"]:
            q = int(state[0])
            audits[-1].append("I" * k.ending(q))
            lines[-1] += _closing(k, q)
        return pa.table({"conv": g.column("conv"), "pos": g.column("pos"), "audit": pa.array(["".join(a) for a in audits], pa.string()),
                         "n_lines": pa.array([len(x) for x in lines], pa.int64()), "lines": pa.array(["\n".join(x) for x in lines], pa.string())})

    edited = (t.select("conv", "piece", "pos", "role", "text", "n", "kind", "seen").groupBy("conv", "piece")
              .cogroup(whole.groupBy("conv", "piece")).applyInArrow(expand, _schema(conv, "pos long, audit string, n_lines long, lines string")))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digest and edits of one conversation after the other, a batch at a time."""
        now, digest, audit, any_line, kind = None, None, [], False, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array(["".join(audit)], pa.string()), pa.array([digest.hexdigest()], pa.string())],
                                              ["conv", "audit", "repaired_sha256"])
        for batch in batches:
            kind = batch.schema.field("conv").type
            for c, a, n, text in zip(*(batch.column(x).to_pylist() for x in ("conv", "audit", "n_lines", "lines"))):
                if digest is None or c != now:
                    if digest is not None:
                        yield done()
                    now, digest, audit, any_line = c, hashlib.sha256(), [], False
                audit.append(a)
                if n:
                    digest.update((("\n" if any_line else "") + text).encode("utf-8", "surrogatepass"))
                    any_line = True
        if digest is not None:
            yield done()

    streamed = (edited.repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), "pos").select("conv", "audit", "n_lines", "lines")
                .mapInArrow(stream, _schema(conv, "audit string, repaired_sha256 string")))
    totals = whole.where("closing = 1").drop("piece", "vector", "state", "closing").withColumnRenamed("conv", "c")
    zero = F.lit(0).cast("long")
    # A conversation whose rows were all dropped has no piece.
    every = rows.select(F.col("conv").alias("its")).groupBy("its").agg(F.count(F.lit(1)).alias("_n"))
    found = streamed.join(totals, F.col("conv").eqNullSafe(F.col("c")))
    names = [f.split()[0] for f in RESULT.split(", ")]
    empty = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    return (every.join(found, F.col("its").eqNullSafe(F.col("conv")), "left")
            .select(F.col("its").alias("conv"), *[F.coalesce(F.col(c), empty.get(c, zero)).alias(c) for c in names]))


def repaired(rows: DataFrame, params: RepairParams = RepairParams()) -> DataFrame:
    """conv, faults, cost, audit and repaired_sha256 of every conversation of ``rows`` (see ``damaged``)."""
    per = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    long = cut_lineage(per.where((F.col("n") > params.long_rows) | (F.col("bytes") > params.long_bytes))
                       .select(F.col("conv").alias("long_conv"), "n"), "long-conversations")
    about = long.agg(F.count(F.lit(1)).alias("convs"), F.sum("n").alias("rows")).first()
    if not about["convs"]:
        return _short(rows, params)
    # The list grows by one for each long_rows rows of the table at most; it is broadcast while it is small.
    ids = F.broadcast(long) if about["convs"] <= 100_000 else long
    same = F.col("conv").eqNullSafe(F.col("long_conv"))
    return _short(rows.join(ids, same, "left_anti"), params).unionByName(_long(rows.join(ids, same, "left_semi"), 2 * about["rows"], params))
