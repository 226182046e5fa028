"""Repair of damaged conversations by weighted interval parsing.

**Grammar.** A conversation should read ``(s?(ua)+)?`` in role initials. The four states of that
language (start, after a system row, after a user row, after an assistant row) give nonterminals
``[p,q]``: what leads from state p to state q. In Chomsky normal form the repair grammar is

* ``[p,q] -> [p,r] [r,q]``, cost 0,
* ``[p,q] -> row``, kept (0), given another role (2) or deleted (3, and then p = q),
* ``[p,q] ->`` an inserted row (2) or nothing (p = q).

**Chart.** A cell holds, for every nonterminal, the least (cost, audit) that derives a span of rows;
insertions are closed over on both sides of every row. Among equally cheap audits of one cell
none is the beginning of another (the further letters would be insertions, which cost), so the
least audit of a whole is made of least audits of its parts. As the nonterminals name
their states, every split of a span gives the same cell: the chart needs one split a span and is
filled bottom-up over spans of doubling length, 2n cells instead of n squared.

**Layout.** Equal rows of a turn are one row with a count. Rows are range-partitioned in conversation
order; a task turns its stretches into cells of bounded spans, and cells of a conversation
are combined 64 at a time, round after round, until one is left. So a conversation may be spread
over any number of tasks. Only the digest of its repaired text, which cannot
be combined, reads the rows of a conversation in one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import shipped
from tapeloom.plans.staging import stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# rows of a span that one task turns into a cell, and cells combined in one go
SPAN = 4096
FAN = 64

BLANKS = " \t\n\x0b\x0c\r"
STATES = range(4)
# what a role initial leads to: state before -> state after
_MOVES = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_FINAL = (0, 3)

Cell = tuple  # of four rows of four (cost, audit) or None
NOTHING: Cell = tuple(tuple((0, "") if p == q else None for q in STATES) for p in STATES)


def combine(left: Cell, right: Cell) -> Cell:
    """``[p,q] -> [p,r] [r,q]`` with the least (cost, audit) of each."""
    rows = []
    for p in STATES:
        row = []
        for q in STATES:
            best = None
            for r in STATES:
                a, b = left[p][r], right[r][q]
                if a is None or b is None:
                    continue
                cost = a[0] + b[0]
                if best is None or cost < best[0]:
                    best = (cost, a[1] + b[1])
                elif cost == best[0]:
                    best = (cost, min(best[1], a[1] + b[1]))
            row.append(best)
        rows.append(tuple(row))
    return tuple(rows)


def _least(*cells: Cell) -> Cell:
    found = lambda p, q: [c[p][q] for c in cells if c[p][q] is not None]
    return tuple(tuple(min(found(p, q), default=None) for q in STATES) for p in STATES)


def _lexical(initials: str, cost: int, letter: str) -> Cell:
    """Cells of one row that is read as one of ``initials``."""
    to = {(p, q) for i in initials for p, q in _MOVES.get(i, {}).items()}
    return tuple(tuple((cost, letter) if (p, q) in to else None for q in STATES) for p in STATES)


def _closure() -> Cell:
    one = _least(NOTHING, _lexical("ua", INSERT, "I"))
    closed = one
    while (more := combine(closed, one)) != closed:
        closed = more
    return closed


INSERTIONS = _closure()


def row_cell(initial: str, kept: bool, truncated: bool) -> Cell:
    """The closed cell of one row; ``kept`` is false where it has to go."""
    ways = [tuple(tuple((DELETE, "D") if p == q else None for q in STATES) for p in STATES)]
    if kept:
        more = TRUNCATED if truncated else 0
        ways += [_lexical(initial, KEEP + more, "K"), _lexical("ua", REROLE + more, "R")]
    return combine(combine(INSERTIONS, _least(*ways)), INSERTIONS)


# by initial and fault: whole, truncated, blank or duplicate
_ROW = {(i, f): row_cell(i, f < 2, f == 1) for i in ("s", "u", "a", "") for f in range(3)}


def power(cell: Cell, n: int) -> Cell:
    """The cell of ``n`` equal rows in a row."""
    out = None
    while n:
        if n & 1:
            out = cell if out is None else combine(out, cell)
        cell, n = combine(cell, cell) if n > 1 else cell, n >> 1
    return NOTHING if out is None else out


def cheapest(cell: Cell) -> tuple[int, str]:
    return min(cell[0][q] for q in _FINAL if cell[0][q] is not None)


class Span:
    """Cells of neighbouring spans, combined as soon as two are equally long."""

    def __init__(self) -> None:
        self.cells: list[tuple[int, Cell]] = []
        self.rows = 0
        self.first: str | None = None
        self.last = ""
        self.illegal = 0

    def add(self, cell: Cell, size: int, first: str, last: str, illegal: int) -> None:
        self.illegal += illegal + (self.first is not None and self.last + first not in ("su", "ua", "au"))
        self.first = first if self.first is None else self.first
        self.last = last
        self.rows += size
        while self.cells and self.cells[-1][0] <= size:
            before, left = self.cells.pop()
            cell, size = combine(left, cell), size + before
        self.cells.append((size, cell))

    def row(self, conv: str, at: int) -> tuple:
        _, cell = self.cells[-1]
        for _, left in reversed(self.cells[:-1]):
            cell = combine(left, cell)
        flat = [x for row in cell for x in row]
        costs = [None if x is None else x[0] for x in flat]
        return conv, at, self.rows, self.first, self.last, self.illegal, costs, [x and x[1] for x in flat]


_PIECE_TYPE = (
    "conv string, at long, size long, first string, last string, illegal long, costs array<long>, audits array<string>"
)
_PIECE_ARROW = pa.schema(
    [
        ("conv", pa.string()),
        ("at", pa.int64()),
        ("size", pa.int64()),
        ("first", pa.string()),
        ("last", pa.string()),
        ("illegal", pa.int64()),
        ("costs", pa.list_(pa.int64())),
        ("audits", pa.list_(pa.string())),
    ]
)


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _written(found: list[tuple]) -> pa.RecordBatch:
    return _columns(found, _PIECE_ARROW)


def _spans(most: int):
    """Sorted rows to cells of up to ``most`` of them; ``at`` orders the cells of a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span, name, taken, at = Span(), None, 0, TaskContext.get().partitionId() << 33
        done: list[tuple] = []
        letters = 0
        for batch in batches:
            for conv, initial, fault, n in zip(*(batch.column(c).to_pylist() for c in ("conv", "initial", "fault", "n"))):
                if taken and (conv != name or taken >= most):
                    done.append(span.row(name, at))
                    letters, at = letters + 16 * span.rows, at + 1
                    span, taken = Span(), 0
                    # what a batch of cells holds is bounded by letters, not by cells
                    if letters > 1 << 22:
                        yield _written(done)
                        done, letters = [], 0
                name, taken = conv, taken + 1
                cell, repeats = _ROW[initial, fault], n - 1
                if repeats:
                    # further copies of a row are duplicates, or as blank as the first
                    cell = combine(cell, power(_ROW[initial, 2], repeats))
                span.add(cell, n, initial, initial, repeats)
        if taken:
            done.append(span.row(name, at))
        yield _written(done)

    return run

def _joined(fan: int):
    """Neighbouring cells of one conversation, ``fan`` or fewer, to one."""

    def run(rows: pa.Table) -> pa.Table:
        span, parts = Span(), rows.sort_by("place").to_pylist()
        for part in parts:
            flat = [None if c is None else (c, a) for c, a in zip(part["costs"], part["audits"])]
            cell = tuple(tuple(flat[4 * p : 4 * p + 4]) for p in STATES)
            span.add(cell, part["size"], part["first"], part["last"], part["illegal"])
        return pa.Table.from_batches([_written([span.row(parts[0]["conv"], parts[0]["place"] // fan)])])

    return run

def _whole(cells: DataFrame, fan: int) -> DataFrame:
    """One cell per conversation: neighbours are combined, ``fan`` at a time, until one is left."""
    while True:
        numbered = cells.selectExpr(
            "*",
            "row_number() over (partition by conv order by at) - 1 as place",
            "count(1) over (partition by conv) as cells",
        )
        if numbered.where("cells > 1").isEmpty():
            return cells
        groups = numbered.where("cells > 1").groupBy("conv", F.expr(f"place div {fan}"))
        more = groups.applyInArrow(_joined(fan), _PIECE_TYPE)
        cells = stage(numbered.where("cells = 1").select(*cells.columns).union(more))


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cheapest way through each conversation's cell."""
    schema = pa.schema([("conv", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])
    for batch in batches:
        found, letters = [], 0
        for i, conv in enumerate(batch.column("conv").to_pylist()):
            costs, audits = batch.column("costs")[i].as_py(), batch.column("audits")[i].as_py()
            found.append((conv, *min((costs[q], audits[q]) for q in _FINAL if costs[q] is not None)))
            letters += len(found[-1][2])
            if letters > 1 << 22:
                yield _columns(found, schema)
                found, letters = [], 0
        yield _columns(found, schema)


_DIGEST_ARROW = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])


def _repaired(audit: str) -> Iterator[tuple[str, str]]:
    """Each edit of an audit with the role it stands for (none for a deletion)."""
    place = -(len(audit.replace("D", "")) % 2)
    for letter in audit:
        if letter == "D":
            yield letter, ""
        else:
            yield letter, "system" if place < 0 else ("user", "assistant")[place % 2]
            place += 1


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each repaired conversation; its audit comes first, then its rows in order."""
    found: list[tuple[str, str]] = []
    name, edits, digest, begun = None, iter(()), hashlib.sha256(), False

    def put(line: str) -> None:
        nonlocal begun
        digest.update(("\n" + line if begun else line).encode())
        begun = True

    def upto_row() -> tuple[str, str]:
        for letter, role in edits:
            if letter != "I":
                return letter, role
            put(f"{role}:")
        return "", ""

    for batch in batches:
        names = ("conv", "audit", "role", "text", "n")
        for conv, audit, role, text, n in zip(*(batch.column(c).to_pylist() for c in names)):
            if audit is not None:
                if name is not None:
                    upto_row()
                    found.append((name, digest.hexdigest()))
                name, edits, digest, begun = conv, _repaired(audit), hashlib.sha256(), False
                continue
            for _ in range(n):
                letter, to = upto_row()
                if letter == "K":
                    put(f"{role}:{text}")
                elif letter == "R":
                    put(f"{to}:{text}")
        yield _columns(found, _DIGEST_ARROW)
        found = []
    if name is not None:
        upto_row()
        found.append((name, digest.hexdigest()))
    yield _columns(found, _DIGEST_ARROW)


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv, turn, role, text, n)``: the rows after damage, equal ones counted.

    ``crc32("conv_id:turn") % 20`` decides: 0 drops a row, 1 empties its text, 2 removes ``.!?``, 3
    repeats it, 4 makes it the user's. A null counts as one space, but a null ``turn`` stays null.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    return (
        conversations.select(
            _conv().alias("conv"),
            F.col("turn").cast("long").alias("turn"),
            F.when(kind == 4, "user").otherwise(space("role")).alias("role"),
            text.alias("text"),
            F.when(kind == 3, 2).otherwise(1).cast("long").alias("n"),
            kind.alias("kind"),
        )
        .where("kind <> 0")
        .groupBy("conv", "turn", "role", "text")
        .agg(F.sum("n").alias("n"))
    )


def _conv():
    """A conversation's name inside: a null id is one of its own."""
    return F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` of ``damaged`` with ``initial`` and ``fault``: 0 none, 1 truncated, 2 duplicate, 3 blank.

    The fault is that of the first of ``n`` equal rows. A duplicate is decided by the first turn
    with its role and text, which is an aggregate: no task holds a conversation.
    """
    rows = rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    firsts = rows.groupBy("conv", "role", "digest").agg(
        F.max(F.col("turn").isNull()).alias("untimed"), F.min("turn").alias("first_turn")
    )
    later = F.col("turn").isNotNull() & (F.col("untimed") | (F.col("turn") > F.col("first_turn")))
    solid = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    return rows.join(firsts, ["conv", "role", "digest"]).select(
        "conv",
        "turn",
        "role",
        F.left("text", F.lit(64)).alias("head"),
        "digest",
        "text",
        "n",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("").alias("initial"),
        F.when(solid == "", 3)
        .when(later, 2)
        .when(F.right(solid, F.lit(1)).isin(".", "!", "?"), 0)
        .otherwise(1)
        .alias("fault"),
    )


ORDER = ["conv", "turn", "role", "head", "digest"]


@shipped
def repair_conversations(conversations: DataFrame, span: int = SPAN, fan: int = FAN) -> DataFrame:
    """Damage, faults, cheapest repair and its digest, one row per ``conv_id`` of the input.

    Rows of a conversation are taken by turn (null first), rows of one turn by role and text
    (its first 64 characters, then its SHA-256). Columns other than ``conv_id``, ``turn``, ``role`` and ``text``
    are not read. A null ``conv_id`` is a conversation of its own; a role that is not kept as a
    system, user or assistant initial can only be changed or deleted. An empty table gives no rows; a
    conversation without rows after damage gives zeros, an empty audit and the digest of the empty text.
    """
    rows = stage(faults(damaged(conversations)))
    ordered = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    cells = stage(
        ordered.select("conv", "initial", F.least("fault", F.lit(2)).alias("fault"), "n").mapInArrow(_spans(span), _PIECE_TYPE)
    )
    whole = stage(_whole(cells, fan))
    answers = stage(whole.select("conv", "costs", "audits").mapInArrow(_answered, "conv string, cost long, audit string"))

    nothing = lambda kind: F.lit(None).cast(kind)
    first = answers.select(
        "conv", F.lit(0).alias("part"), nothing("long").alias("turn"), nothing("string").alias("role"),
        nothing("string").alias("head"), nothing("string").alias("digest"), nothing("string").alias("text"),
        nothing("long").alias("n"), "audit",
    )
    lines = rows.select(
        "conv", F.lit(1).alias("part"), "turn", "role", "head", "digest", "text", "n", nothing("string").alias("audit")
    )
    stream = first.union(lines).repartition("conv").sortWithinPartitions("conv", "part", *ORDER[1:])
    digests = stream.select("conv", "audit", "role", "text", "n").mapInArrow(_digests, "conv string, repaired_sha256 string")

    times = rows.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps")
    )
    of = lambda fault, n: F.sum(F.when(F.col("fault") == fault, n).otherwise(0))
    seen = rows.groupBy("conv").agg(
        of(3, F.col("n")).alias("blank"),
        F.sum(F.when(F.col("fault") == 2, F.col("n")).when(F.col("fault") < 2, F.col("n") - 1).otherwise(0)).alias("duplicate"),
        of(1, F.lit(1)).alias("truncated"),
    )
    named = conversations.select("conv_id").distinct().select("conv_id", _conv().alias("conv"))
    out = (
        named.join(times, "conv", "left")
        .join(seen, "conv", "left")
        .join(whole.select("conv", "illegal"), "conv", "left")
        .join(answers, "conv", "left")
        .join(digests, "conv", "left")
    )
    count = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c)
    return out.select(
        "conv_id",
        *[count(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
