"""Repair of conversations by weighted interval parsing.

The legal role sequences are ``(s?(ua)+)?``. The repair grammar is in Chomsky
normal form: its nonterminals are pairs of places (p, q) in that pattern, its rules

    (p, q) -> (p, r) (r, q)
    (p, p) -> row deleted          (p, q) -> row kept or given a new role
    (p, q) -> nothing, at the price of the inserted turns between p and q

A cell holds for each nonterminal the least (cost, audit) of its span of rows,
closed under insertion at both ends. Cells combine by ascending span length: all
splits of all spans within a block of rows, then blocks side by side. (Combining is
associative, so one split of a longer span gives the same minimum as all.)
Choices go back down the same way, so a conversation of any length is parsed by many tasks.

Two audits of one cell and cost are never one the start of the other, because a span's
edits but insertions are as many as its rows; so least parts make least wholes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cohortlens.llm.places import batched, in_groups, placed, runs
from cohortlens.session import cut_lineage

#: Prices of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: White space, and the marks that end a sentence.
BLANKS, MARKS = " \t\n\x0b\x0c\r", ".!?"
#: Rows whose spans are parsed by all splits, and cells that are then combined at a time.
BLOCK, FAN = 16, 8

#: Places in the pattern: at its start, after the system turn, after a user, after an assistant turn.
_STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ENDS = (0, 3)
_NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
_ROLES = {"u": "user", "a": "assistant"}

Best = tuple[int, str]
Cell = dict[tuple[int, int], Best]


def _insertions() -> Cell:
    """What nothing can become: each place reaches others by one or two inserted turns."""
    cell = {}
    for p in range(4):
        cell[p, p] = (0, "")
        one = _STEPS[p, _NEXT[p]]
        two = _STEPS[one, _NEXT[one]]
        cell.setdefault((p, one), (INSERT, "I"))
        cell.setdefault((p, two), (2 * INSERT, "II"))
    return cell


def joined(left: Cell, right: Cell) -> Cell:
    """The least of each nonterminal over all pairs of the two cells."""
    out: Cell = {}
    for one, two, whole in _RULES:
        if one in left and two in right:
            (cost, audit), (more, rest) = left[one], right[two]
            new = (cost + more, audit + rest)
            if whole not in out or new < out[whole]:
                out[whole] = new
    return out


_NOTHING = _insertions()
#: The binary rules: (p, r), (r, q) and (p, q).
_PAIRS = sorted({*_NOTHING, *((p, q) for (p, _), q in _STEPS.items())})
_RULES = [((p, r), (r, q), (p, q)) for p, r in _PAIRS for r_, q in _PAIRS if r == r_]


@lru_cache(256)
def row_cell(initial: str, must_go: bool, truncated: bool) -> Cell:
    """The cell of a single row."""
    cell = {(p, p): (DELETE, "D") for p in range(4)}
    if not must_go:
        extra = TRUNCATED if truncated else 0
        for p in range(4):
            q = _STEPS[p, _NEXT[p]]
            cell[p, q] = (REROLE + extra, "R")
            if (p, initial) in _STEPS:
                cell[p, _STEPS[p, initial]] = (extra, "K")
    return joined(joined(_NOTHING, cell), _NOTHING)


@lru_cache(4096)
def block_cell(rows: tuple[tuple[str, str | None], ...]) -> Cell:
    """The cell of a block's rows, given as initials and faults; blocks are often alike."""
    return parsed([row_cell(i, k in ("blank", "duplicate"), k == "truncated") for i, k in rows])


def parsed(cells: list[Cell]) -> Cell:
    """The cell of neighbouring rows: every span, shortest first, from every split."""
    spans = {(i, i + 1): cell for i, cell in enumerate(cells)}
    for length in range(2, len(cells) + 1):
        for i in range(len(cells) - length + 1):
            best: Cell = {}
            for k in range(i + 1, i + length):
                for key, value in joined(spans[i, k], spans[k, i + length]).items():
                    if key not in best or value < best[key]:
                        best[key] = value
            spans[i, i + length] = best
    return spans[0, len(cells)]


def chosen(cells: list[Cell], p: int, q: int) -> list[tuple[int, int]]:
    """The nonterminals of neighbouring cells that make up the least (p, q)."""
    ways: dict[int, tuple[Best, list[int]]] = {p: ((0, ""), [p])}
    for cell in cells:
        after: dict[int, tuple[Best, list[int]]] = {}
        for (a, b), (more, rest) in cell.items():
            if a in ways:
                (cost, audit), path = ways[a]
                new = (cost + more, audit + rest)
                if b not in after or new < after[b][0]:
                    after[b] = (new, [*path, b])
        ways = after
    path = ways[q][1]
    return list(zip(path, path[1:]))


def edits(audit: str, p: int, initials: list[str]) -> Iterator[tuple[str, int | None, str | None]]:
    """(edit, row, new role) of a block whose parse begins at place ``p``."""
    row = 0
    for edit in audit:
        if edit == "D":
            yield edit, row, None
        elif edit == "K":
            yield edit, row, None
            p = _STEPS[p, initials[row]]
        else:
            yield edit, row if edit == "R" else None, _ROLES[_NEXT[p]]
            p = _STEPS[p, _NEXT[p]]
        row += edit != "I"


def _packed(cell: Cell) -> list[tuple]:
    return [(p, q, cost, audit) for (p, q), (cost, audit) in sorted(cell.items())]


def _unpacked(rows: Iterable[dict]) -> Cell:
    return {(r["p"], r["q"]): (r["cost"], r["audit"]) for r in rows}


def _legal(left: str, right: str) -> bool:
    return left + right in ("su", "ua", "au")


def _map(rows: DataFrame, keys: tuple[str, ...], schema: str, task) -> DataFrame:
    """``task`` over the groups of ``rows`` by ``keys``, which come first; it yields rows."""
    out = to_arrow_schema(StructType.fromDDL(schema))
    width = len(keys)
    return in_groups(rows, *keys).mapInArrow(
        lambda batches: batched(
            (row for key, group in runs(batches, width) for row in task(key, group)), out
        ),
        schema,
    )


_CELLS = (
    "n long, size long, first string, last string, illegal long, blank long, duplicate long, "
    "truncated long, cells array<struct<p: int, q: int, cost: long, audit: string>>"
)


def faults(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts, rows) of ``turns``: uid, role and text; uid, conv_id, n, size, initial and fault.

    A row's place ``n`` follows turn (null first), role and a digest of the text.
    ``fault`` is the first of blank, duplicate and truncated that holds, else null.
    """
    text = F.rtrim(F.col("text"), F.lit(BLANKS))
    last = F.substring(text, -1, 1)
    texts = cut_lineage(
        turns.select(
            "conv_id",
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit(" ")).alias("role"),
            F.coalesce("text", F.lit(" ")).alias("text"),
        )
        .withColumn("digest", F.md5("text"))
        .withColumn("blank", text == "")
        .withColumn("cut", ~last.isin(*MARKS))
        .withColumn("uid", F.monotonically_increasing_id())
    )
    numbers = texts.select("uid", "conv_id", "turn", "role", "digest", "blank", "cut")
    rows = cut_lineage(placed(numbers, "conv_id", "turn", "role", "digest", "uid"))
    # the first row of each role and text that occurs more than once
    again = (
        rows.groupBy("conv_id", "role", "digest")
        .agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("times"))
        .where("times > 1")
        .select(*(F.col(c).alias(f"a_{c}") for c in ("conv_id", "role", "digest")), "first")
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("a_conv_id"))
        & (F.col("role") == F.col("a_role"))
        & (F.col("digest") == F.col("a_digest"))
    )
    fault = (
        F.when(F.col("blank"), "blank")
        .when(F.col("n") > F.col("first"), "duplicate")
        .when(F.col("cut"), "truncated")
    )
    found = rows.join(again, same, "left").select(
        "uid", "conv_id", "n", "size", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")
    )
    return texts.select("uid", "turn", "role", "text"), cut_lineage(found)


def repair(turns: DataFrame, block: int = BLOCK, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(conversations, edits) of ``turns`` (conv_id, turn, role, text).

    ``conversations`` has conv_id, blank, duplicate, truncated (rows by their first
    fault), illegal (neighbours whose initials are not su, ua or au), cost and audit.
    ``edits`` has conv_id, place (two numbers that order a conversation), edit (K, R, D,
    I), turn, role and text after the edit; deleted rows have them as they were, inserted
    ones an empty text and no turn.

    A null role or text counts as one space, a null conv_id is a conversation.
    Rows of one turn are ordered by role and a digest of the text; of equal rows the
    first stays. An unknown role can be replaced or deleted. Other columns are ignored. A
    text is hashed once and moves once, whatever its length; a conversation of
    any length is parsed in blocks of ``block`` rows, ``fan`` cells at a time. An
    empty table gives no rows.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    texts, rows = faults(turns)

    def block_cells(key, group):
        conv, at = key
        initials = [r[3] for r in group]
        kinds = [r[4] for r in group]
        cell = block_cell(tuple(zip(initials, kinds)))
        illegal = sum(not _legal(a, b) for a, b in zip(initials, initials[1:]))
        counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
        size = -(-group[0][2] // block)
        yield conv, at, size, initials[0], initials[-1], illegal, *counts, _packed(cell)

    keyed = rows.select(
        "conv_id", F.expr(f"n div {block}").alias("at"), "n", "uid", "size", "initial", "fault"
    )
    schema = f"conv_id {kind}, {_CELLS}"
    levels = [cut_lineage(_map(keyed, ("conv_id", "at"), schema, block_cells))]

    def wider(key, group):
        conv, at = key
        cell = _unpacked(group[0][-1])
        for row in group[1:]:
            cell = joined(cell, _unpacked(row[-1]))
        illegal = sum(not _legal(a[3], b[2]) for a, b in zip(group, group[1:]))
        counts = [sum(r[k] for r in group) for k in (4, 5, 6, 7)]
        size = -(-group[0][1] // fan)
        yield conv, at, size, group[0][2], group[-1][3], counts[0] + illegal, *counts[1:], _packed(cell)

    parent = F.expr(f"n div {fan}").alias("at")
    columns = [c.split()[0] for c in _CELLS.split("cells")[0].split(", ") if c] + ["cells"]
    while (levels[-1].agg(F.max("size")).first()[0] or 1) > 1:
        up = levels[-1].select("conv_id", parent, *columns)
        levels.append(cut_lineage(_map(up, ("conv_id", "at"), schema, wider)))

    ends = F.filter("cells", lambda c: (c["p"] == 0) & c["q"].isin(*_ENDS))
    best = F.array_min(
        F.transform(ends, lambda c: F.struct(c["cost"], c["audit"], c["p"], c["q"]))
    )
    tops = levels.pop().withColumn("best", best)
    whole = tops.select(
        "conv_id", "blank", "duplicate", "truncated", "illegal", "best.cost", "best.audit"
    )
    picks = tops.select("conv_id", "n", "best.p", "best.q", "cells")

    def narrower(key, group):
        conv, _ = key
        (_, p, q, _), *rest = group
        for (n, _, _, cells), (a, b) in zip(rest, chosen([_unpacked(r[3]) for r in rest], p, q)):
            yield conv, n, a, b, cells

    nothing = F.lit(None).cast("int")
    for level in reversed(levels):
        head = picks.select("conv_id", F.col("n").alias("at"), F.lit(-1).cast("long").alias("n"), "p", "q")
        below = level.select("conv_id", parent, "n", nothing.alias("p"), nothing.alias("q"), "cells")
        both = head.unionByName(below, allowMissingColumns=True)
        picks = cut_lineage(
            _map(
                both, ("conv_id", "at"),
                f"conv_id {kind}, n long, p int, q int, {_CELLS[_CELLS.index('cells'):]}", narrower,
            )
        )

    mine = F.filter("cells", lambda c: (c["p"] == F.col("p")) & (c["q"] == F.col("q")))[0]["audit"]
    head = picks.select(
        "conv_id", F.col("n").alias("at"), F.lit(-1).cast("long").alias("n"), "p", mine.alias("audit")
    )
    both = head.unionByName(
        keyed.select("conv_id", "at", "n", "uid", "initial"), allowMissingColumns=True
    )

    def block_edits(key, group):
        conv, at = key
        (_, p, audit, _, _), *rest = group
        for step, (edit, row, role) in enumerate(edits(audit, p, [r[4] for r in rest])):
            yield conv, at, step, edit, None if row is None else rest[row][3], role

    done = _map(
        both, ("conv_id", "at"),
        f"conv_id {kind}, at long, step int, edit string, uid long, new_role string", block_edits,
    )
    edited = done.join(texts, "uid", "left").select(
        "conv_id",
        F.struct("at", "step").alias("place"),
        "edit",
        "turn",
        F.coalesce("new_role", "role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return whole, edited
