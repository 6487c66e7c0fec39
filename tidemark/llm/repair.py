"""Structure repair of conversations by a grammar-compressed shortest-path search.

A row of a conversation becomes one symbol: its role's initial, whether it is cut off, or that
it must go. Over four states (nothing yet, after a system, user or assistant row) each symbol
is a matrix of (cost, edits) in the min-plus sense: cheapest way from state to state, ties to
the least string of edits. Re-Pair replaces frequent pairs of symbols by rules, over all
conversations at once; a rule's matrix is the product of its two symbols' matrices, made once,
bottom-up, with its edits kept as a rope of shared parts. A conversation is then a few matrices.

Insertions belong to the row after them. So the strings of one stretch end with the edit of
its last row, none is the beginning of another, and equal costs can be settled inside each
stretch: the search goes backward over costs and then forward once.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"
SALTS = 16
# Symbols: GONE must be deleted, others are 1 + 2 * role + cut off, with roles in this order.
GONE, ROLES, FIRST_RULE, BREAK = 0, "sua", 9, 255
RULES, ROUNDS = 240, 12
# States, and what insertions alone do: (from, to) -> number of rows inserted.
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
INSERTED = {
    (START, START): 0, (START, USER): 1, (START, ASSISTANT): 2,
    (SYSTEM, SYSTEM): 0, (SYSTEM, USER): 1, (SYSTEM, ASSISTANT): 2,
    (USER, USER): 0, (USER, ASSISTANT): 1,
    (ASSISTANT, ASSISTANT): 0, (ASSISTANT, USER): 1,
}
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
FOLLOWS = ("su", "ua", "au")
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults: a hash of conversation and turn drops a row, empties it,
    takes its sentence ends away, repeats it or gives it to the user. Nulls are one space."""

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat(plain("conv_id"), F.lit(":"), plain("turn"))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    text = (
        F.when(kind == 1, "").when(kind == 2, F.translate(plain("text"), ENDS, "")).otherwise(plain("text"))
    )
    role = F.when(kind == 4, "user").otherwise(plain("role"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("_"),
    ).drop("_")


def _turns(turns: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )


def faults(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, initial, fault and symbol of every row, without its text.

    A row is a duplicate unless it is the first of its conversation, role and text. Each of
    ``SALTS`` parts of such a group finds its first row, and only those meet: a text that one
    conversation repeats without end is spread over tasks.
    """
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    looked = _turns(turns).select(
        "conv_id", "turn", "role", "digest",
        (bare == "").alias("blank"),
        (~F.contains(F.lit(ENDS), F.right(bare, F.lit(1)))).alias("cut"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).alias("salt"),
    )
    group = ["conv_id", "role", "digest"]
    first = F.row_number().over(Window.partitionBy(*group, "salt").orderBy("turn")) == 1
    firsts = looked.withColumn("salt", F.when(first, -1).otherwise(F.col("salt")))
    number = F.row_number().over(Window.partitionBy(*group, "salt").orderBy("turn"))
    again = (F.col("salt") >= 0) | (number > 1)
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return firsts.withColumn("again", again).select(
        "conv_id", "turn", "role", "digest", "again", initial.alias("initial"),
        F.when(F.col("blank"), BLANK).when(F.col("again"), DUPLICATE).when(F.col("cut"), TRUNCATED)
        .otherwise(NO_FAULT).alias("fault"),
        F.when(F.col("blank") | F.col("again"), GONE).otherwise(1 + 2 * place + F.col("cut").cast("int"))
        .alias("symbol"),
    )


STRETCH = (
    "conv_id long, part int, symbols binary, blank long, duplicate long, truncated long, illegal long,"
    " first string, last string, turns long, low long, high long"
)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each conversation's rows of one task amount to; rows come in order."""
    part, now, out = TaskContext.get().partitionId(), None, []
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "turn", "initial", "fault", "symbol")]
        for conv, turn, initial, fault, symbol in zip(*columns):
            if now is None or now[0] != conv:
                if now is not None:
                    out.append(now)
                now = [conv, part, bytearray(), 0, 0, 0, 0, initial, initial, 0, None, None]
            elif now[8] + initial not in FOLLOWS:
                now[6] += 1
            now[2].append(symbol)
            if fault:
                now[2 + fault] += 1
            now[8] = initial
            if turn is not None and turn != now[11]:
                now[9] += 1
                now[10] = turn if now[10] is None else now[10]
                now[11] = turn
        if len(out) > 4096:
            yield _rows(out, STRETCH)
            out = []
    if now is not None:
        yield _rows([*out, now], STRETCH)


ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _rows(rows: list, schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(",")]
    columns = list(zip(*rows))
    arrays = [
        pa.array([bytes(v) for v in column] if kind == "binary" else column, ARROW[kind])
        for (_, kind), column in zip(fields, columns)
    ]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


SEQUENCE = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, symbols binary"


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its stretches in order."""
    for batch in batches:
        out = []
        for conv, parts in zip(batch.column("conv_id").to_pylist(), batch.column("parts").to_pylist()):
            symbols = b"".join(p["symbols"] for p in parts)
            sums = [sum(p[n] for p in parts) for n in ("blank", "duplicate", "truncated", "illegal")]
            sums[3] += sum(a["last"] + b["first"] not in FOLLOWS for a, b in zip(parts, parts[1:]))
            timed = [p for p in parts if p["turns"]]
            gaps = 0
            if timed:
                shared = sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
                number = sum(p["turns"] for p in timed) - shared
                gaps = timed[-1]["high"] - timed[0]["low"] + 1 - number
            out.append([conv, gaps, *sums, symbols])
        if out:
            yield _rows(out, SEQUENCE)


def sequences(turns: DataFrame) -> DataFrame:
    """One row per conversation: its counts and its symbols, a byte for each of its rows.

    Rows are dealt by ranges of (conversation, turn, ...), so a very long conversation lies
    in several tasks, and only one short row of each task meets the others.
    """
    order = ["conv_id", "turn", "role", "digest", "again"]
    laid = faults(turns).repartitionByRange(*order).sortWithinPartitions(*order)
    parts = laid.mapInArrow(_stretches, STRETCH)
    listed = F.sort_array(F.collect_list(F.struct(*[f.split()[0] for f in STRETCH.split(", ")[1:]])))
    return parts.groupBy("conv_id").agg(listed.alias("parts")).mapInArrow(_joined, SEQUENCE)


# -- the grammar ---------------------------------------------------------------------------


class Rope:
    """A string of edits made of shared parts."""

    __slots__ = ("left", "right", "leaf")

    def __init__(self, leaf: str = "", left: Rope | None = None, right: Rope | None = None):
        self.leaf, self.left, self.right = leaf, left, right

    def __add__(self, other: Rope) -> Rope:
        return Rope(left=self, right=other)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            rope = todo.pop()
            if rope.left is None:
                out.append(rope.leaf)
            else:
                todo += (rope.right, rope.left)
        return "".join(out)


Matrix = list[list[tuple[int, Rope] | None]]


def _better(old: tuple[int, Rope] | None, new: tuple[int, Rope]) -> tuple[int, Rope]:
    if old is None or new[0] != old[0]:
        return new if old is None or new[0] < old[0] else old
    return new if str(new[1]) < str(old[1]) else old


def product(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product; equal costs are settled by the edits."""
    out: Matrix = [[None] * 4 for _ in range(4)]
    for x in range(4):
        for middle in range(4):
            head = a[x][middle]
            if head is None:
                continue
            for y in range(4):
                tail = b[middle][y]
                if tail is not None:
                    out[x][y] = _better(out[x][y], (head[0] + tail[0], head[1] + tail[1]))
    return out


def terminal(symbol: int) -> Matrix:
    """Insertions, then the edit of one row."""
    steps: dict[tuple[int, int], list[tuple[int, str]]] = {(x, x): [(DELETE, "D")] for x in range(4)}
    if symbol != GONE:
        role, cut = divmod(symbol - 1, 2)
        stays = CUT * cut
        for x in range(4):
            y = ASSISTANT if x == USER else USER
            if role == 0 and x == START:
                steps.setdefault((START, SYSTEM), []).append((stays, "K"))
            kept = (role == 1 and y == USER) or (role == 2 and y == ASSISTANT)
            steps.setdefault((x, y), []).append((stays, "K") if kept else (REROLE + stays, "R"))
    out: Matrix = [[None] * 4 for _ in range(4)]
    for (x, middle), times in INSERTED.items():
        for (start, y), edits in steps.items():
            for cost, edit in edits if start == middle else ():
                out[x][y] = _better(out[x][y], (INSERT * times + cost, Rope("I" * times + edit)))
    return out


@dataclass
class Grammar:
    """Rules in the order they were made, and the matrix of every symbol."""

    rules: list[tuple[int, int]]
    matrices: list[Matrix]

    def compress(self, symbols: bytes) -> bytes:
        return _compressed(symbols, self.rules)


def _compressed(symbols: bytes, rules: list[tuple[int, int]]) -> bytes:
    for number, pair in enumerate(rules):
        symbols = symbols.replace(bytes(pair), bytes([FIRST_RULE + number]))
    return symbols


def pair_counts(shapes: DataFrame, rules: list[tuple[int, int]]) -> DataFrame:
    """(pair, n): how often each pair of neighbours stands in the compressed conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            blob = bytes([BREAK]).join(batch.column("symbols").to_pylist())
            code = np.frombuffer(_compressed(blob, rules), np.uint8).astype(np.int64)
            if len(code) < 2:
                continue
            often = batch.column("n").to_numpy()[np.cumsum(code == BREAK)]
            pair = code[:-1] * 256 + code[1:]
            # In a run of one symbol every other pair counts, as pairs may not overlap.
            begins = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
            inside = np.arange(len(code)) - np.repeat(begins, np.diff(np.r_[begins, len(code)]))
            fine = (code[:-1] != BREAK) & (code[1:] != BREAK)
            fine &= (code[:-1] != code[1:]) | (inside[:-1] % 2 == 0)
            np.add.at(total, pair[fine], often[:-1][fine])
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["pair", "n"])

    return shapes.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def grammar(found: DataFrame, rules: int = RULES, rounds: int = ROUNDS) -> Grammar:
    """Re-Pair over all sequences.

    Each round replaces the most frequent pairs that have no symbol in common, so that one
    count serves several rules. A count has at most 2**16 rows, for symbols are bytes. Fewer
    rules make longer sequences and never another result.
    """
    shapes = stored(found.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "repair-shapes")
    made: list[tuple[int, int]] = []
    for _ in range(rounds):
        counted = sorted((-r.n, r.pair) for r in pair_counts(shapes, made).collect())
        used: set[int] = set()
        for n, pair in counted:
            both = divmod(pair, 256)
            if -n >= 2 and len(made) < rules and not used & {*both}:
                made.append(both)
                used |= {*both}
        if not used:
            break
    matrices = [terminal(s) for s in range(FIRST_RULE)]
    for a, b in made:
        matrices.append(product(matrices[a], matrices[b]))
    return Grammar(made, matrices)


FAR = 1 << 60


class Repairer:
    """Cheapest edits of sequences; strings of edits and answers are kept while they are few."""

    def __init__(self, grammar: Grammar):
        self.grammar = grammar
        self.costs = [[[FAR if e is None else e[0] for e in row] for row in m] for m in grammar.matrices]
        self.texts: dict[tuple[int, int, int], str] = {}
        self.known: dict[bytes, tuple[int, str]] = {}

    def _text(self, symbol: int, x: int, y: int) -> str:
        key = (symbol, x, y)
        if key not in self.texts:
            self.texts[key] = str(self.grammar.matrices[symbol][x][y][1])
        return self.texts[key]

    def repair(self, symbols: bytes) -> tuple[int, str]:
        if symbols in self.known:
            return self.known[symbols]
        found = self._search(self.grammar.compress(symbols))
        if len(symbols) <= 256:
            if len(self.known) >= 65536:
                self.known.clear()
            self.known[symbols] = found
        return found

    def _search(self, code: bytes) -> tuple[int, str]:
        rest = array("q", bytes(32 * (len(code) + 1)))  # cheapest end, by place and state
        rest[4 * len(code) :] = array("q", [INSERT * CLOSING[x] for x in range(4)])
        for i in range(len(code) - 1, -1, -1):
            a, b, c, d = rest[4 * i + 4 : 4 * i + 8]
            for x, row in enumerate(self.costs[code[i]]):
                rest[4 * i + x] = min(row[0] + a, row[1] + b, row[2] + c, row[3] + d)
        x, out = START, []
        for i, symbol in enumerate(code):
            row, best = self.costs[symbol][x], rest[4 * i + x]
            fit = [y for y in range(4) if row[y] + rest[4 * i + 4 + y] == best]
            text, x = min((self._text(symbol, x, y), y) for y in fit)
            out.append(text)
        return rest[START], "".join(out) + "I" * CLOSING[x]


def audits(found: DataFrame, rules: Grammar) -> DataFrame:
    """``found`` with cost and audit in place of its symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer(rules)
        for batch in batches:
            answers = [repairer.repair(s) for s in batch.column("symbols").to_pylist()]
            kept = [n for n in batch.schema.names if n != "symbols"]
            more = [pa.array([a[0] for a in answers], pa.int64()), pa.array([a[1] for a in answers], pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *more], [*kept, "cost", "audit"])

    return found.mapInArrow(run, AUDIT)


AUDIT = SEQUENCE.replace("symbols binary", "cost long, audit string")
HEAD = [f.split()[0] for f in AUDIT.split(", ")][1:]


# -- the repaired conversations ------------------------------------------------------------


def _in_order(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """Each conversation's counts and edits, and then its rows, together and in order."""
    rows = _turns(turns).withColumn("head", F.lit(0))
    heads = audited.select("conv_id", *HEAD, F.lit(1).alias("head"))
    both = rows.unionByName(heads, allowMissingColumns=True)
    order = ["conv_id", F.desc("head"), "turn", "role", "digest"]
    return both.repartition("conv_id").sortWithinPartitions(*order)


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """("head", row) once a conversation, then (edit, turn, role, text) for what is left of it.

    Only the edits of one conversation and one batch of rows are held.
    """
    audit, at, state = "", 0, START

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, at = (ASSISTANT if state == USER else USER), at + 1
            yield "I", None, NAMES[state], ""

    for batch in batches:
        names = batch.schema.names
        for values in zip(*(batch.column(n).to_pylist() for n in names)):
            row = dict(zip(names, values))
            if row["head"]:
                yield from inserted()
                audit, at, state = row["audit"], 0, START
                yield "head", row
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "D":
                continue
            role = row["role"]
            if edit == "K" and state == START and role[:1] == "s":
                state = SYSTEM
            else:
                state = ASSISTANT if state == USER else USER
                role = role if edit == "K" else NAMES[state]
            yield edit, row["turn"], role, row["text"]
    yield from inserted()


REPAIRED = "conv_id long, position long, edit string, turn long, role string, text string"


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, size, conv, position = [], 0, None, 0
    for found in _walked(batches):
        if found[0] == "head":
            conv, position = found[1]["conv_id"], 0
            continue
        out.append([conv, position, *found])
        position, size = position + 1, size + len(found[3])
        if len(out) >= 4096 or size > 1 << 24:
            yield _rows(out, REPAIRED)
            out, size = [], 0
    if out:
        yield _rows(out, REPAIRED)


SUMMARY = AUDIT + ", repaired_sha256 string"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, head, digest, first = [], None, None, True

    def done() -> list:
        return [head["conv_id"], *(head[n] for n in HEAD), digest.hexdigest()]

    for found in _walked(batches):
        if found[0] == "head":
            if head is not None:
                out.append(done())
            head, digest, first = found[1], hashlib.sha256(), True
            if len(out) >= 4096:
                yield _rows(out, SUMMARY)
                out = []
        else:
            line = f"{found[2]}:{found[3]}" if first else f"\n{found[2]}:{found[3]}"
            digest.update(line.encode("utf-8", "surrogatepass"))
            first = False
    if head is not None:
        yield _rows([*out, done()], SUMMARY)


def audited(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns``: conv_id, counts of faults, cost and audit, stored."""
    found = stored(sequences(turns), "repair-sequences")
    return stored(audits(found, grammar(found)), "repair-audits")


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), edit, turn, role, text.

    Inserted rows have no turn. ``turns`` as for ``conversation_repairs``.
    """
    return _in_order(turns, audited(turns)).mapInArrow(_repaired, REPAIRED)


def conversation_repairs(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256.

    Rows of a conversation are taken by turn, null turns first, rows of one turn by role and
    then by the SHA-256 of their text; a null role or text is one space; rows without conv_id
    are one conversation. The first fault of a row counts: blank, duplicate (role and text
    seen earlier), truncated (no sentence end). Deleting costs 3 and is the only edit of
    blank and duplicate rows, a new role 2, an inserted empty row 2, a truncated row that
    stays 1. The repaired roles are nothing, or an optional system row and then pairs of
    user and assistant rows. Other columns are not looked at; no rows give no rows.

    The hash of a conversation is sequential by definition: its rows pass one task in order,
    one batch at a time, and are not gathered.
    """
    return _in_order(turns, audited(turns)).mapInArrow(_summaries, SUMMARY)


def all_repairs(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """``conversation_repairs`` with a row for conversations that have lost all their rows."""
    found = conversation_repairs(turns).withColumnRenamed("conv_id", "_conv")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    numbers = [n for n in HEAD if n != "audit"]
    return ids.join(found, ids["conv_id"].eqNullSafe(found["_conv"]), "left").select(
        "conv_id",
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
