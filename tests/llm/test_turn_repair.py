"""Conversation repair against an exhaustive search."""

import functools
import hashlib
import itertools
import random
import zlib

import pytest

from tastecore.llm import turn_repair

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\v\f\r"


def least(rows, states=("",), ends=("", "p")):
    """Least (cost, audit) over all edits; states: '' nothing, s, p after a pair, u. rows: (initial, gone, cut)."""

    @functools.cache
    def rest(i, state, inserted):
        found = [(0, "")] if i == len(rows) and state in ends else []
        step = "p" if state == "u" else "u"
        if inserted < 2:
            found.append(tuple(x + y for x, y in zip((3, "I"), rest(i, step, inserted + 1))))
        if i < len(rows):
            initial, gone, cut = rows[i]
            found.append(tuple(x + y for x, y in zip((4, "D"), rest(i + 1, state, 0))))
            if not gone:
                want = "a" if state == "u" else "u"
                own = ((0, "K") if initial == want else (3, "R")), step
                for (cost, edit), after in [own, *([((0, "K"), "s")] if state == "" and initial == "s" else [])]:
                    found.append(tuple(x + y for x, y in zip((cost + 3 * cut, edit), rest(i + 1, after, 0))))
        return min(found, default=(1 << 50, ""))

    return min(rest(0, s, 0) for s in states)


def signature(rows):
    return "".join(turn_repair.GONE if gone else ("_" if c == "-" else c.upper()) if cut else c for c, gone, cut in rows)


NAMES = {turn_repair.START: "", turn_repair.SYSTEM: "s", turn_repair.PAIR: "p", turn_repair.USER: "u"}


def test_alignments_equal_all_edits_between_all_states():
    kinds = [(c, False, cut) for c in "sua-" for cut in (False, True)] + [("u", True, False)]
    rng = random.Random(2)
    cases = [c for n in range(4) for c in itertools.product(kinds, repeat=n)]
    cases += [tuple(rng.choice(kinds) for _ in range(rng.randrange(4, 12))) for _ in range(500)]
    for rows in cases:
        found = {(a, b): (cost, audit) for a, b, cost, audit in turn_repair.alignments(signature(rows), tuple(NAMES), tuple(NAMES))}
        pairs = itertools.product(NAMES, NAMES) if len(rows) < 3 else rng.sample(list(itertools.product(NAMES, NAMES)), 3)
        for a, b in pairs:
            want = least(rows, (NAMES[a],), (NAMES[b],))
            assert found.get((a, b), (1 << 50, "")) == (want if want[0] < 1 << 40 else (1 << 50, "")), (rows, a, b)


def expected(rows):
    """Rows (conv_id, turn, role, text) after damage -> the result, conversation by conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in rows if r[0] == conv and r[4] is False), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, judged, counts = set(), [], [0, 0, 0]
        for _, role, text, _ in own:
            end = text.rstrip(SPACE)[-1:]
            fault = 0 if not end else 1 if (role, text) in seen else 2 if end not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            judged.append((role[:1] if role[:1] in tuple("sua") else "-", fault in (0, 1), fault == 2))
        cost, audit = least(tuple(judged))
        text, i, state = [], 0, ""
        for edit in audit:
            if edit == "D":
                i += 1
                continue
            role = "assistant" if state == "u" else "user"
            body = "" if edit == "I" else own[i][2]
            if edit == "K":
                role = own[i][1]
            state = "s" if edit == "K" and state == "" and role[:1] == "s" else "p" if state == "u" else "u"
            i += edit != "I"
            text.append(f"{role}:{body}")
        turns = [t for t, *_ in own if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest())
    return out


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if fault == 1 else text.translate(str.maketrans("", "", ".!?")) if fault == 2 else text
        row = (conv, turn, "user" if fault == 4 else role, text, fault == 0)
        out += [row, row] if fault == 3 else [row]
    return out


def odd_rows(seed, conversations=60):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "", " \n", None, "What?\n", "très bien !", "a.b", "Ok! 　", "😀."]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "Assistant"]
    rows = []
    for conv in [None, *range(conversations)]:
        for turn in range(rng.randrange(1, 9)):
            number = rng.choice([turn, turn, turn, turn + rng.randrange(4), None])
            text = rng.choice(texts) if rng.random() < 0.5 else f"Turn {turn}{rng.choice('.!?x')}"
            rows.append((conv, number, rng.choice(roles), text))
    rows += [rows[5]] * 3
    rows += [(1000, t, ["user", "assistant"][t % 2] if t % 7 else "system", f"{t % 90}{'.' if t % 5 else ''}") for t in range(300)]  # a long one
    rows += [(c, 0, "user", "Gone.") for c in range(5000, 5100)]  # some of these lose their only row
    return rows


@pytest.mark.parametrize("segment_rows,partitions", [(256, 2), (1, 9), (4, 40), (50, 3)])
def test_repair_equals_exhaustive_search(spark, many_chunks, segment_rows, partitions):
    rows = odd_rows(segment_rows)
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as dropped", "1 as place").repartition(partitions)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = {tuple(r) for r in turn_repair.repair(turn_repair.damaged(table), segment_rows).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == {*expected(damaged(rows)).values()}


def test_long_texts_of_one_turn_and_undamaged_rows(spark):
    rows = [(1, 0, "user", "x" * 3_000_000 + "."), (1, 1, "assistant", "y " * 1_000_000), (1, 1, "assistant", "y " * 1_000_000 + "z."), (2, None, None, None)]
    found = {tuple(r) for r in turn_repair.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    plain = [(c, t, " " if r is None else r, " " if x is None else x, False) for c, t, r, x in rows]
    assert found == {*expected(plain).values()}


def test_no_rows(spark):
    assert turn_repair.repair(turn_repair.damaged(spark.createDataFrame([], SCHEMA))).collect() == []
    gone = spark.createDataFrame([(3, 1, "user", "a.", True)], SCHEMA + ", dropped boolean")
    assert [tuple(r) for r in turn_repair.repair(gone).collect()] == [(3, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
