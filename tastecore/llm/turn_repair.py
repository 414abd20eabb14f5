"""Repair of conversation structure: Wagner-Fischer alignment of turns with the alternating grammar string.

A repaired conversation is empty or has the role initials s?(ua)+. For every feasible length the grammar has at most
one string of that length, and all strings end alike, so one Wagner-Fischer table over what is left of the rows and of
the target answers every length: entry (i, r) is the least cost of aligning the rows from i on with the last r letters.
An incumbent from a greedy repair bounds the lengths and, as Ukkonen does, the band of entries around the diagonal that a
repair of that cost can pass through. Each length is backtraced from its entry to the ASCII-least of its cheapest audits,
and the (cost, audit) of all lengths are compared.

Rows are range sorted by conversation and turn, so a conversation with very many rows is spread over tasks. One that lies
within a task and has at most SEGMENT_ROWS rows is repaired there. Others go on as segments of bounded size, whose
repeated turns are found by a group-by over digests. Every segment is aligned on its own for each state of the grammar
before and after it (nothing yet, after s, after a, after u); the conversation's repair is the cheapest chain of its segments.
Two audits of one cost between the same states are never the start of one another, so the least chain is made of least parts.
Only the joining of segments, with the hash of the repaired text, runs in order; it holds one segment and one audit per state.

Edits cost: keep 0, rerole to user or assistant 3, delete 4, insert an empty turn 3; a truncated row that stays costs 3 more.
A row's first fault counts: blank (only white space), duplicate (role and text seen earlier), truncated (the last letter
is not one of . ! ?). Blank and duplicate rows have to be deleted.

Edge cases: null roles and texts are one space; null turns come first; rows of one turn are in the order of role and text
(of the first 64 characters, then of a digest); rows without a conv_id are one conversation; conversations without any
row left have zeros, no audit and the hash of an empty text; only conv_id, turn, role, text and `dropped` are read.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastecore.llm.batches import map_arrow, slices
from tastecore.plans.staging import stage

SEGMENT_ROWS = 256
SEGMENT_CHARACTERS = 1 << 20  # a segment ends with the row that reaches this
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
# Fixed values of the task.
RETYPE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
NAMES = {"u": "user", "a": "assistant"}
#: States of the grammar: nothing yet, after s, after a whole pair, after u.
START, SYSTEM, PAIR, USER = range(4)
INFINITE = 1 << 60
SPACE = " \t\n\v\f\r"
LAST = re.compile(r"[.!?]")

GONE = "x"  # has to be deleted
Row = tuple[str, bool, bool]  # initial, has to be deleted, is truncated


def _rows(signature: str) -> list[Row]:
    """A signature is all that an alignment depends on. It has a letter per row: the initial (- for others), the same as a
    capital (_ for others) if the row is truncated, or GONE."""
    return [("-" if c in "-_" else c.lower(), c == GONE, c in "SUA_") for c in signature]


def greedy_cost(rows: Sequence[Row]) -> int:
    """The cost of some repair, plus what it takes to end in any other state of the grammar."""
    cost, expected = 0, "u"
    for initial, gone, cut in rows:
        if gone:
            cost += DELETE_COST
            continue
        stay = (0 if initial == expected else RETYPE_COST) + (TRUNCATED_COST if cut else 0)
        if stay <= DELETE_COST:
            cost, expected = cost + stay, "a" if expected == "u" else "u"
        else:
            cost += DELETE_COST
    return cost + 2 * INSERT_COST


class Alignment:
    """The table for targets that end in one state: entry (i, r) for the rows from i on and the last r letters."""

    def __init__(self, rows: Sequence[Row], last: str, bound: int) -> None:
        self.rows, self.n, self.last = rows, len(rows), last
        self.more = bound // INSERT_COST + 1  # letters more, or fewer, than rows left
        self.fewer = bound // DELETE_COST + 1
        n = self.n
        below: dict[int, int] = {r: INSERT_COST * r for r in range(self.more + 1)}
        self.table = [below]
        for i in reversed(range(n)):
            initial, gone, cut = rows[i]
            left = n - i
            stay = INFINITE if gone else (TRUNCATED_COST if cut else 0)
            now: dict[int, int] = {0: DELETE_COST * left}
            for r in range(max(1, left - self.fewer), left + self.more + 1):
                best = min(below.get(r, INFINITE) + DELETE_COST, now.get(r - 1, INFINITE) + INSERT_COST)
                put = stay + (0 if initial == self.expected(r) else RETYPE_COST)
                now[r] = min(best, below.get(r - 1, INFINITE) + put)
            self.table.append(now)
            below = now
        self.table.reverse()

    def expected(self, r: int) -> str:
        """The first of the last r letters."""
        return self.last if r % 2 else ("a" if self.last == "u" else "u")

    def cost(self, i: int, r: int) -> int:
        return DELETE_COST * (self.n - i) if r == 0 else self.table[i].get(r, INFINITE)

    def backtrace(self, i: int, r: int) -> str:
        """The ASCII-least of the cheapest audits of the rows from i on and the last r letters."""
        audit = []
        while i < self.n or r:
            here = self.cost(i, r)
            if i < self.n and self.cost(i + 1, r) + DELETE_COST == here:
                audit.append(DELETE)
                i += 1
            elif r and self.cost(i, r - 1) + INSERT_COST == here:
                audit.append(INSERT)
                r -= 1
            else:
                audit.append(KEEP if self.rows[i][0] == self.expected(r) else REROLE)
                i, r = i + 1, r - 1
        return "".join(audit)

    def lengths(self) -> range:
        return range(max(0, self.n - self.fewer), self.n + self.more + 1)

    def after_system(self, r: int) -> tuple[int, str] | None:
        """The least (cost, audit) of the target s and r letters: some system turn is kept, all before it deleted."""
        best, first = INFINITE, -1
        for i, (initial, gone, cut) in enumerate(self.rows):
            if initial == "s" and not gone:
                cost = DELETE_COST * i + (TRUNCATED_COST if cut else 0) + self.cost(i + 1, r)
                if cost <= best:  # the later one: its audit has a D where the other has a K
                    best, first = cost, i
        return None if best >= INFINITE else (best, DELETE * first + KEEP + self.backtrace(first + 1, r))


Step = tuple[int, int, int, str]  # state before, state after, cost, audit


@functools.lru_cache(maxsize=1 << 13)
def alignments(signature: str, entries: tuple[int, ...], exits: tuple[int, ...]) -> tuple[Step, ...]:
    """The least (cost, audit) between every two of these states."""
    rows = _rows(signature)
    bound = greedy_cost(rows)
    found: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(entry: int, end: int, cost: int, audit) -> None:
        """audit: a function, as most lengths are dearer than one that is known."""
        if entry in entries and end in exits and cost < INFINITE:
            known = found.get((entry, end))
            if known is None or cost <= known[0]:
                own = (cost, audit())
                found[entry, end] = own if known is None else min(known, own)

    for end, last in ((PAIR, "a"), (USER, "u")):
        if end not in exits and not (end == PAIR and {START, SYSTEM} & {*exits}):
            continue
        table = Alignment(rows, last, bound)
        for r in sorted({0, *table.lengths()}, key=lambda r: abs(r - table.n)):
            cost, audit = table.cost(0, r), functools.partial(table.backtrace, 0, r)
            if r == 0:
                for state in (START, SYSTEM, end):
                    offer(state, state, cost, audit)
            elif table.expected(r) == "u":
                for entry in (START, SYSTEM, PAIR):
                    offer(entry, end, cost, audit)
            else:
                offer(USER, end, cost, audit)
            if START in entries and (r == 0 or table.expected(r) == "u"):
                own = table.after_system(r)
                if own is not None:
                    offer(START, SYSTEM if r == 0 else end, own[0], lambda own=own: own[1])
    return tuple((entry, end, cost, audit) for (entry, end), (cost, audit) in found.items())


def repaired(audit: str, rows: Sequence[tuple[str, str]], state: int) -> tuple[list[str], int]:
    """`role:text` of the rows (role, text) after the edits, and the state after them."""
    out, i = [], 0
    for edit in audit:
        if edit == DELETE:
            i += 1
            continue
        role, text = ("", "") if edit == INSERT else rows[i]
        i += edit != INSERT
        expected = "a" if state == USER else "u"
        if edit == KEEP and state == START and role[:1] == "s":
            state = SYSTEM
        else:
            state = USER if expected == "u" else PAIR
        out.append(f"{role if edit == KEEP else NAMES[expected]}:{text}")
    return out, state


@dataclass
class Turns:
    """Rows of one conversation, in order, as far as they are held."""

    conv_id: int | None
    turns: list = field(default_factory=list)
    roles: list = field(default_factory=list)
    texts: list = field(default_factory=list)
    characters: int = 0

    def add(self, turn, role: str, text: str) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.characters += len(text)

    def full(self, segment_rows: int) -> bool:
        return len(self.turns) >= segment_rows or self.characters >= SEGMENT_CHARACTERS


def faults(roles: Sequence[str], texts: Sequence[str], repeated: set[int] | None) -> tuple[str, tuple[int, int, int]]:
    """The signature of rows, and how many are blank, duplicate and truncated. `repeated`: known places, else found."""
    seen: set[tuple[str, str]] = set()
    rows, counts = [], [0, 0, 0]
    for place, (role, text) in enumerate(zip(roles, texts)):
        end = text.rstrip(SPACE)[-1:]
        again = (role, text) in seen if repeated is None else place in repeated
        seen.add((role, text))
        fault = 0 if not end else 1 if again else 2 if not LAST.match(end) else None
        if fault is not None:
            counts[fault] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "-"
        rows.append(GONE if fault in (0, 1) else initial if fault is None else "_" if initial == "-" else initial.upper())
    return "".join(rows), tuple(counts)


def illegal_pairs(roles: Sequence[str]) -> int:
    letters = [r[:1] for r in roles]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:]))


def _gaps(low, high, distinct: int) -> int:
    return 0 if low is None else min(high - low + 1 - distinct, 2**63 - 1)


FOUND = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
FOUND_NAMES = [c.split()[0] for c in FOUND.split(", ")]
FOUND_KINDS = [pa.int64()] * 7 + [pa.string()] * 2
OPEN = "place long, turns array<long>, roles array<string>, texts array<string>"
OPEN_NAMES = [c.split()[0] for c in OPEN.split(", ")]
OPEN_KINDS = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string())]


def _batch(rows: list[tuple], names: Sequence[str], kinds: Sequence[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))


def repair_whole(own: Turns) -> tuple:
    """The result of a conversation that is held whole."""
    signature, (blank, duplicate, truncated) = faults(own.roles, own.texts, None)
    cost, audit = min((cost, audit) for _, _, cost, audit in alignments(signature, (START,), (START, PAIR)))
    text, _ = repaired(audit, list(zip(own.roles, own.texts)), START)
    known = [t for t in own.turns if t is not None]
    gaps = _gaps(known[0], known[-1], len(set(known))) if known else 0
    digest = hashlib.sha256("\n".join(text).encode("utf-8", "surrogatepass")).hexdigest()
    return own.conv_id, gaps, blank, duplicate, truncated, illegal_pairs(own.roles), cost, audit, digest


def _collected(batches: Iterator[pa.RecordBatch], segment_rows: int) -> Iterator[pa.RecordBatch]:
    """From sorted rows: results of the conversations that lie within the task and one segment; the segments of others."""
    number = TaskContext.get().partitionId() << 32
    names, kinds = [*FOUND_NAMES, *OPEN_NAMES], [*FOUND_KINDS, *OPEN_KINDS]
    nothing_found, nothing_open = (None,) * (len(FOUND_NAMES) - 1), (None,) * len(OPEN_NAMES)
    out: list[tuple] = []
    held, border = None, True  # whether the conversation may have rows in an earlier segment or task

    def segment(own: Turns) -> tuple:
        nonlocal number
        number += 1
        return own.conv_id, *nothing_found, number, own.turns, own.roles, own.texts

    for rows in slices(batches):
        for conv_id, turn, role, text, dropped in zip(*[c.to_pylist() for c in rows.columns]):
            if held is None or held.conv_id != conv_id:
                if held is not None:
                    out.append(segment(held) if border else (*repair_whole(held), *nothing_open))
                    border = False
                held = Turns(conv_id)
            if dropped:
                continue
            if held.full(segment_rows):
                out.append(segment(held))
                held, border = Turns(conv_id), True
            held.add(turn, role, text)
        if sum(len(r[-1] or ()) + 1 for r in out) >= SEGMENT_ROWS:
            yield _batch(out, names, kinds)
            out = []
    if held is not None:
        out.append(segment(held))
    yield _batch(out, names, kinds)


STEPS = "steps array<struct<entry: int, exit: int, cost: long, audit: string>>, blank long, duplicate long, truncated long"
STEP_KIND = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments with their cheapest edits between all states."""
    states = (START, SYSTEM, PAIR, USER)
    for part in slices(batches, 8):
        out = []
        for row in part.to_pylist():
            signature, counts = faults(row["roles"], row["texts"], set(row["repeated"] or ()))
            steps = [dict(zip(("entry", "exit", "cost", "audit"), s)) for s in alignments(signature, states, states)]
            out.append((row["conv_id"], row["place"], row["turns"], row["roles"], row["texts"], steps, *counts))
        yield _batch(out, ["conv_id", *OPEN_NAMES, "steps", "blank", "duplicate", "truncated"], [pa.int64(), *OPEN_KINDS, STEP_KIND, *[pa.int64()] * 3])


class _Chain:
    """The segments of one conversation, joined one after the other."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.best = {START: (0, "", hashlib.sha256())}
        self.counts = [0, 0, 0, 0]
        self.low = self.high = self.last_role = None
        self.distinct = 0

    def add(self, row: dict) -> None:
        known = [t for t in row["turns"] if t is not None]
        if known:
            self.low = known[0] if self.low is None else self.low
            self.distinct += len(set(known)) - (known[0] == self.high)
            self.high = known[-1]
        roles = row["roles"]
        joined = [self.last_role, *roles] if self.last_role is not None else roles
        self.last_role = roles[-1] if roles else self.last_role
        for i, n in enumerate((row["blank"], row["duplicate"], row["truncated"], illegal_pairs(joined))):
            self.counts[i] += n
        rows = list(zip(roles, row["texts"]))
        chosen: dict[int, tuple[int, str, dict]] = {}
        for step in row["steps"]:
            before = self.best.get(step["entry"])
            if before is not None:
                own = (before[0] + step["cost"], before[1] + step["audit"])
                known = chosen.get(step["exit"])
                if known is None or own < known[:2]:
                    chosen[step["exit"]] = (*own, step)
        after = {}
        for state, (cost, audit, step) in chosen.items():
            digest = self.best[step["entry"]][2].copy()
            text, _ = repaired(step["audit"], rows, step["entry"])
            if text:
                digest.update((("" if step["entry"] == START else "\n") + "\n".join(text)).encode("utf-8", "surrogatepass"))
            after[state] = (cost, audit, digest)
        self.best = after

    def found(self) -> tuple:
        cost, audit, digest = min((self.best[s] for s in (START, PAIR) if s in self.best), key=lambda b: b[:2])
        return self.conv_id, _gaps(self.low, self.high, self.distinct), *self.counts, cost, audit, digest.hexdigest()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chain, out = None, []
    for part in slices(batches, 8):
        for row in part.to_pylist():
            if chain is None or chain.conv_id != row["conv_id"]:
                if chain is not None:
                    out.append(chain.found())
                chain = _Chain(row["conv_id"])
            chain.add(row)
        if len(out) >= SEGMENT_ROWS:
            yield _batch(out, FOUND_NAMES, FOUND_KINDS)
            out = []
    if chain is not None:
        out.append(chain.found())
    yield _batch(out, FOUND_NAMES, FOUND_KINDS)


def repair(turns: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row per conversation: its faults, and the cheapest repair with its audit.

    `turns`: conv_id, turn, role, text, and perhaps `dropped`: such rows only say that the conversation is there.
    Columns: conv_id, gaps (turn numbers missing between the first and the last), blank, duplicate, truncated, illegal
    (neighbouring roles other than su, ua, au), cost, audit, repaired_sha256.
    """
    space = F.lit(" ")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in turns.columns else F.lit(False)).alias("dropped"),
    )
    # Equal rows are spread by their place in the input, so that no value fills a range alone.
    keys = {
        "_role": F.substring("role", 1, 64), "_text": F.substring("text", 1, 64),
        "_rest": F.md5(F.concat_ws("\u0000", "role", "text")), "_spread": F.monotonically_increasing_id(),
    }
    ordered = rows.withColumns(keys).orderBy("conv_id", "turn", *keys).select(*rows.columns)
    collected = stage(map_arrow(ordered, lambda parts: _collected(parts, segment_rows), f"{FOUND}, {OPEN}"), "conversations")
    segments = collected.filter("place is not null").select("conv_id", *OPEN_NAMES)
    # Repeated rows of segments: an earlier place has the same role and text.
    both = F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "row")
    name = F.coalesce(F.col("conv_id").cast("string"), F.lit("-"))
    digest = F.md5(F.concat_ws(":", name, F.octet_length("row.roles").cast("string"), F.concat("row.roles", "row.texts")))
    digests = segments.select("conv_id", "place", both).select("place", "at", digest.alias("digest"))
    firsts = digests.groupBy("digest").agg(F.min(F.struct("place", "at")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = digests.join(firsts.select("digest", "first"), "digest").filter(F.struct("place", "at") > F.col("first"))
    # A list holds places of one segment, SEGMENT_ROWS at most.
    repeated = again.groupBy("place").agg(F.collect_list("at").alias("repeated"))
    known = segments.join(repeated, "place", "left").select("conv_id", *OPEN_NAMES, "repeated")
    aligned = map_arrow(known, _aligned, f"conv_id long, {OPEN}, {STEPS}")
    chains = aligned.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return collected.filter("place is null").select(*FOUND_NAMES).unionAll(map_arrow(chains, _joined, FOUND))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults by crc32(`conv_id:turn`) % 20: 0 drops a row, 1 empties its text, 2 removes its . ! ?, 3 repeats
    it, 4 makes its role user. Nulls are one space, but a null turn stays without a number."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.crc32(name.cast("binary")) % 20).alias("_fault"),
    )
    fault = F.col("_fault")
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), (fault == 0).alias("dropped"), "_fault")
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("*", F.explode(copies)).select("conv_id", "turn", "role", "text", "dropped")
