"""Repair of conversation structure by the cheapest edits: a min-plus dynamic program over a grammar.

A turn is one symbol: its role's initial and its fault (blank, a copy of an earlier turn, cut short). A conversation is to
read system?, (user, assistant)+, or be empty. Turns are kept, given the other role, deleted, or inserted without
text; of equally cheap edits those whose initials (D, I, K, R) come first in ASCII are taken.

What a symbol does is a 4 x 4 matrix: from what stands before it to what stands after it (nothing, a system, a user or an
assistant turn) the least cost, with the rank of its edits among those from the same start. Two matrices multiply by minimum
and sum. Edits of one stretch from one start to different ends are never beginnings of one another (each ends with a
turn's own edit, and a start and edits settle the end), so that ranks decide ties as whole strings would.

Sequences are cut into blocks of ``BLOCK`` turns. Re-Pair [Larsson and Moffat, 1999] makes a grammar of the distinct blocks:
Spark counts neighbouring symbols, the most frequent pairs become symbols, round by round. A rule's matrix is the product of
its two parts', and keeps where they meet: the edits are a rope, written out only where a conversation takes them. Rules are
shared by all conversations; at most ``RULES`` are made, which bounds what is broadcast and changes no result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tableload.llm.common import stored, text_slices

BLOCK = 512  # turns
RULES = 512
PAIRS = 64  # new rules in a round
FIRST_SYMBOL = 0xE000  # rules are characters of the private area
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"

# The costs of edits.
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1

# states: what the repaired conversation ends with so far
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# symbols: role initials (x: any other), upper-case if the turn is cut short; turns that must be deleted
BLANK, COPY = "b", "d"
LEAVES = "suaxSUAX" + BLANK + COPY
# the turn that comes next where a role is free to choose, and how many insertions make a state an end
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
CLOSE = {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
STATE_OF = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


@dataclass(frozen=True)
class Matrix:
    """By start and end: cost (None if there is no way), rank among the ends of the start, and where its two parts meet."""

    cost: tuple[tuple[int | None, ...], ...]
    rank: tuple[tuple[int, ...], ...]
    meet: tuple[tuple[int, ...], ...] = ()


def edits(symbol: str, state: int) -> Iterator[tuple[int, str, int]]:
    """Cost, letter and new state of the edits of one turn."""
    yield DELETE, "D", state
    if symbol in (BLANK, COPY):
        return
    extra, role = CUT_SHORT * symbol.isupper(), STATE_OF.get(symbol.lower())
    if role == NEXT[state] or role == SYSTEM and state == NOTHING:
        yield extra, "K", role
    yield REROLE + extra, "R", NEXT[state]


def leaf(symbol: str) -> tuple[Matrix, dict[tuple[int, int], str]]:
    """The matrix of a turn, insertions before it included, and its edits by start and end."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(4):
        state = start
        for inserted in range(3):  # more only lead round in a circle
            for cost, letter, end in edits(symbol, state):
                found = (cost + INSERT * inserted, "I" * inserted + letter)
                best[start, end] = min(best.get((start, end), found), found)
            state = NEXT[state]
    order = {i: sorted((best[i, j][1], j) for j in range(4) if (i, j) in best) for i in range(4)}
    ranks = {(i, j): r for i, row in order.items() for r, (_, j) in enumerate(row)}
    cost = tuple(tuple(best[i, j][0] if (i, j) in best else None for j in range(4)) for i in range(4))
    rank = tuple(tuple(ranks.get((i, j), 0) for j in range(4)) for i in range(4))
    return Matrix(cost, rank), {at: letters for at, (_, letters) in best.items()}


def times(first: Matrix, second: Matrix) -> Matrix:
    """The matrix of ``first`` followed by ``second``; ``first`` may have fewer starts."""
    costs, ranks, meets = [], [], []
    for own_cost, own_rank in zip(first.cost, first.rank):
        ways = []
        for end in range(4):
            found = [
                (own_cost[k] + second.cost[k][end], own_rank[k], k)
                for k in range(4)
                if own_cost[k] is not None and second.cost[k][end] is not None
            ]
            ways.append(min(found) if found else None)
        order = sorted((w[1], second.rank[w[2]][end], end) for end, w in enumerate(ways) if w)
        place = {end: r for r, (_, _, end) in enumerate(order)}
        costs.append(tuple(w[0] if w else None for w in ways))
        ranks.append(tuple(place.get(end, 0) for end in range(4)))
        meets.append(tuple(w[2] if w else 0 for w in ways))
    return Matrix(tuple(costs), tuple(ranks), tuple(meets))


class Grammar:
    """Rules (symbol, left, right), oldest first, with their matrices, evaluated bottom-up."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.rules = rules
        self.parts = {symbol: (left, right) for symbol, left, right in rules}
        self.matrices: dict[str, Matrix] = {}
        self.letters: dict[tuple[str, int, int], str] = {}
        for symbol in LEAVES:
            self.matrices[symbol], own = leaf(symbol)
            self.letters.update({(symbol, *at): text for at, text in own.items()})
        for symbol, left, right in rules:
            self.matrices[symbol] = times(self.matrices[left], self.matrices[right])
        self.blocks: dict[str, tuple[str, list[Matrix]]] = {}

    def shortened(self, symbols: str) -> str:
        for symbol, left, right in self.rules:
            symbols = symbols.replace(left + right, symbol)
        return symbols

    def block(self, symbols: str) -> tuple[str, list[Matrix]]:
        """A block in the grammar's symbols, and the products of its first one, two, ... matrices."""
        if symbols not in self.blocks:
            if len(self.blocks) > 20_000:
                self.blocks.clear()
            short = self.shortened(symbols)
            products = [self.matrices[short[0]]]
            for symbol in short[1:]:
                products.append(times(products[-1], self.matrices[symbol]))
            self.blocks[symbols] = short, products
        return self.blocks[symbols]

    def written(self, symbol: str, start: int, end: int) -> str:
        """The rope of a symbol from one state to another, written out."""
        at = (symbol, start, end)
        if at not in self.letters:
            left, right = self.parts[symbol]
            k = self.matrices[symbol].meet[start][end]
            self.letters[at] = self.written(left, start, k) + self.written(right, k, end)
        return self.letters[at]

    def block_edits(self, symbols: str, start: int, end: int) -> str:
        short, products = self.block(symbols)
        out = []
        for symbol, product in zip(short[:0:-1], products[:0:-1]):
            k = product.meet[start][end]
            out.append(self.written(symbol, k, end))
            end = k
        out.append(self.written(short[0], start, end))
        return "".join(reversed(out))

    def solve(self, blocks: list[str]) -> tuple[int, str]:
        """Cost and edits of a conversation, given as its blocks in order."""
        so_far, meets = Matrix(((0, None, None, None),), ((0, 0, 0, 0),)), []
        for symbols in blocks:
            so_far = times(so_far, self.block(symbols)[1][-1])
            meets.append(so_far.meet[0])
        ends = [(c + INSERT * CLOSE[j], so_far.rank[0][j], j) for j, c in enumerate(so_far.cost[0]) if c is not None]
        cost, _, end = min(ends)
        out = ["I" * CLOSE[end]]
        for symbols, meet in zip(reversed(blocks), reversed(meets)):
            out.append(self.block_edits(symbols, meet[end], end))
            end = meet[end]
        return cost, "".join(reversed(out))


def re_pair(blocks: DataFrame, most: int = RULES) -> list[tuple[str, str, str]]:
    """Rules from the distinct strings of ``symbols``; at most ``PAIRS`` counts come to the driver in a round."""
    distinct = stored(blocks.select("symbols").distinct(), "distinct-blocks")
    rules: list[tuple[str, str, str]] = []
    while len(rules) < most:
        shared = distinct.sparkSession.sparkContext.broadcast(rules)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: Counter = Counter()
            for batch in batches:
                for symbols in batch.column("symbols").to_pylist():
                    for symbol, left, right in shared.value:
                        symbols = symbols.replace(left + right, symbol)
                    found.update(map("".join, zip(symbols, symbols[1:])))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["pair", "n"])

        pairs = distinct.mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1")
        frequent = pairs.orderBy(F.col("n").desc(), "pair").limit(min(PAIRS, most - len(rules))).collect()
        if not frequent:
            break
        rules += [(chr(FIRST_SYMBOL + len(rules) + i), r.pair[0], r.pair[1]) for i, r in enumerate(frequent)]
    return rules


def turns_of(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present: Column | None = None
) -> DataFrame:
    """conv_id, turn, role, text (nulls: one space), key (of role and text) and present of every row."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role_col, text_col))
    named = rows.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), text.alias("text"),
        (F.lit(True) if present is None else present).alias("present"),
    )
    return named.withColumn("key", F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256)))


def symbols_of(turns: DataFrame) -> DataFrame:
    """(conv_id, block, symbols): the turns that are present, in order, as strings of at most ``BLOCK`` symbols. Stored."""
    said = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    short = ~F.substring(said, -1, 1).isin(".", "!", "?")
    symbol = F.when(said == "", BLANK).when(short, F.upper(letter)).otherwise(letter)
    narrow = turns.filter("present").select("conv_id", "turn", "key", symbol.alias("symbol"), F.monotonically_increasing_id().alias("row"))
    # by ranges of the whole order, so that a conversation of any length is spread over tasks
    ordered = narrow.repartitionByRange("conv_id", "turn", "key", "row").sortWithinPartitions("conv_id", "turn", "key", "row").drop("row", "turn")
    ordered = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered-turns")
    copied = ordered.groupBy("conv_id", "key").agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1")
    marked = ordered.alias("o").join(copied.alias("c"), F.expr("o.conv_id <=> c.conv_id and o.key = c.key"), "left")
    marked = marked.select("o.conv_id", "at", F.expr(f"if(symbol <> '{BLANK}' and at > first, '{COPY}', symbol)").alias("symbol"))
    own = F.transform(F.array_sort(F.collect_list(F.struct("at", "symbol"))), lambda x: x["symbol"])
    blocks = marked.groupBy("conv_id", F.expr(f"at div {BLOCK}").alias("block")).agg(F.array_join(own, "").alias("symbols"))
    return stored(blocks, "turn-blocks")


def solved(blocks: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(conv_id, cost, audit, blank, duplicate, truncated) of every conversation with turns.

    A conversation's blocks, a row for ``BLOCK`` turns, pass through one task in order.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(rules)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(batch.column("conv_id").to_pylist(), batch.column("symbols").to_pylist())

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, out = Grammar(shared.value), []
        for conv, own in groupby(rows(batches), key=lambda r: r[0]):
            own = [symbols for _, symbols in own]
            cost, audit = grammar.solve(own)
            counts = [sum(s.count(c) for s in own) for c in (BLANK, COPY)]
            out.append((conv, cost, audit, *counts, sum(sum(map(s.count, "SUAX")) for s in own)))
            if len(out) == 1000:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    names = ["conv_id", "cost", "audit", "blank", "duplicate", "truncated"]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (id_type, pa.int64(), pa.string(), *[pa.int64()] * 3))], names)

    conv = blocks.schema["conv_id"].dataType.simpleString()
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[conv]
    dealt = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block").select("conv_id", "symbols")
    return dealt.mapInArrow(solve, f"conv_id {conv}, cost long, audit string, blank long, duplicate long, truncated long")


@dataclass
class Plan:
    """What is known of a conversation before its turns come: the row of ``solved``."""

    cost: int = 0
    audit: str = ""
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, kind, turn, role, text, plan) rows: a conversation's plan, its turns in order, then those not present."""
    names = ["conv_id", "kind", "turn", "role", "text", "cost", "audit", "blank", "duplicate", "truncated"]
    for batch in text_slices(batches):
        for conv, kind, turn, role, text, *plan in zip(*(batch.column(n).to_pylist() for n in names)):
            yield conv, kind, turn, role, text, Plan(*plan) if kind == 0 else None


def _applied(audit: str, turns: Iterator[tuple]) -> Iterator[tuple]:
    """(letter, turn, role, text) of every edit but deletions; deleted turns are consumed. All turns are consumed."""
    state = NOTHING
    for letter in audit:
        _, _, turn, role, text, _ = next(turns) if letter != "I" else (None, None, None, None, "", None)
        if letter == "D":
            continue
        if letter == "K" and state == NOTHING and role[:1] == "s":
            state = SYSTEM
        else:
            state = NEXT[state]
        yield letter, turn, role if letter == "K" else ("user" if state == USER else "assistant"), text


class Watched:
    """Passes turns on while it counts gaps between turn numbers and neighbours whose roles do not fit."""

    def __init__(self, turns: Iterator[tuple]):
        self.turns, self.last, self.low, self.high, self.distinct, self.illegal = turns, None, None, None, 0, 0

    def __iter__(self) -> Iterator[tuple]:
        for row in self.turns:
            if row[1] != 1:
                continue
            turn, initial = row[2], row[3][:1]
            if turn is not None:
                self.distinct += turn != self.high  # turns come in order
                self.low, self.high = turn if self.low is None else self.low, turn
            if self.last is not None:
                self.illegal += self.last + initial not in ("su", "ua", "au")
            self.last = initial
            yield row

    @property
    def gaps(self) -> int:
        return self.high - self.low + 1 - self.distinct if self.distinct else 0


def _planned(turns: DataFrame) -> DataFrame:
    """The plan of each conversation followed by its turns, in order, conversation by conversation within a partition."""
    blocks = symbols_of(turns)
    plans = stored(solved(blocks, re_pair(blocks)), "plans")
    empty = {"cost": "long", "audit": "string", "blank": "long", "duplicate": "long", "truncated": "long"}
    own = turns.select(
        "conv_id", F.when(F.col("present"), 1).otherwise(2).alias("kind"), "turn", "key", "role", F.when(F.col("present"), F.col("text")).alias("text"),
        *[F.lit(None).cast(t).alias(c) for c, t in empty.items()],
    )
    none = {f.name: F.lit(None).cast(f.dataType) for f in own.schema.fields}
    first = plans.select(*[(F.col(c) if c in plans.columns else F.lit(0) if c == "kind" else none[c]).alias(c) for c in own.columns])
    return own.unionByName(first).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "key").drop("key")


def repaired(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conv_id of ``turns_of`` rows.

    Turns are taken by number (nulls first), ties by the SHA-256 of role and text; rows that are not ``present`` only
    name their conversation, and one without any has zeros and no edits. A null conv_id is a conversation. Repeated rows
    are turns: copies. An empty table gives no rows. The SHA-256 is of the repaired ``role:text``, joined by newlines:
    as that is one sequential sum, a conversation's turns pass through one task, as a stream that is never held whole.
    """
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    conv = turns.schema["conv_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for id_, own in groupby(_streamed(batches), key=lambda r: r[0]):
            head = next(own)
            watched = Watched(own if head[1] == 0 else iter(()))
            plan, rows = head[5] or Plan(), iter(watched)
            sha, joint = hashlib.sha256(), b""
            for _, _, role, text in _applied(plan.audit, rows):
                sha.update(joint + f"{role}:{text}".encode())
                joint = b"\n"
            for _ in rows:
                raise RuntimeError("a plan ended before its turns")
            values = (id_, watched.gaps, plan.blank, plan.duplicate, plan.truncated, watched.illegal, plan.cost, plan.audit, sha.hexdigest())
            yield pa.RecordBatch.from_pydict({n: pa.array([v], id_type if n == "conv_id" else None) for n, v in zip(names, values)})

    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[conv]
    schema = f"conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return _planned(turns).mapInArrow(lambda batches: _joined(digest(batches)), schema)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, position, edit, turn, role, text): the conversations of ``turns_of`` rows after their cheapest edits."""
    conv = turns.schema["conv_id"].dataType.simpleString()
    number = turns.schema["turn"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for id_, own in groupby(_streamed(batches), key=lambda r: r[0]):
            head = next(own)
            done = enumerate(_applied(head[5].audit if head[5] else "", own))
            while part := [(id_, i, *row) for i, row in (x for _, x in zip(range(500), done))]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], ["conv_id", "position", "edit", "turn", "role", "text"])

    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    types = [arrow[conv], pa.int64(), pa.string(), arrow[number], pa.string(), pa.string()]
    schema = f"conv_id {conv}, position long, edit string, turn {number}, role string, text string"
    return _planned(turns).mapInArrow(lambda batches: _joined(write(batches)), schema)


def _joined(batches: Iterator[pa.RecordBatch], most_rows: int = 500, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Small batches put together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held[-1:]) and (len(held) >= most_rows or batch.nbytes > most_bytes):
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def damaged(rows: DataFrame) -> DataFrame:
    """``turns_of`` conversations whose turns are damaged by a hash of ``conv_id:turn``: in 20 cases one is dropped (not
    present), one emptied, one loses its end marks, one is repeated, one gets the role user."""
    space = F.lit(" ")
    at = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    text, role = (F.coalesce(F.col(c), space) for c in ("text", "role"))
    hit = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(at.cast("binary")) % 20).alias("hit"))
    hit = hit.select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.col("hit"), F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return turns_of(hit, present=F.col("hit") != 0)
