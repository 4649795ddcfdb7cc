"""Repair of conversations against all edits there are, and against the cheapest edits found forwards."""

import hashlib
import itertools
import random
import re

import pytest

from changewatch.llm import turns

SPACE = " \t\n\x0b\f\r"
FORM = re.compile("(s?(ua)+)?")
ROWS = "conv_id long, turn long, role string, text string, k int, place string, cost string"


def frame(spark, rows):
    """With columns whose names clash with those of results."""
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], ROWS)


def in_order(rows):
    rows = [(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows]
    return sorted(rows, key=lambda row: (row[1] is not None, row[1] or 0, row[2], hashlib.sha256(row[3].encode()).digest()))


def faults(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        fault = None
        if not text.strip(SPACE):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif text.strip(SPACE)[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        found.append(fault)
    return found


def choices(row, fault):
    """letter, cost, role and text of what a row may become."""
    _, _, role, text = row
    extra = 3 if fault == "truncated" else 0
    yield "D", 4, None
    if fault not in ("blank", "duplicate"):
        yield "K", extra, (role, text)
        for other in ("user", "assistant"):
            yield "R", 3 + extra, (other, text)


GAPS = [("I" * n, 3 * n, [(role, "") for role in roles]) for n in range(3) for roles in itertools.product(("user", "assistant"), repeat=n)]


def all_edits(rows):
    """The cheapest (cost, letters, turns) of all edits with up to two insertions in each place."""
    best = None
    options = [list(choices(row, fault)) for row, fault in zip(rows, faults(rows))]
    for own in itertools.product(*options):
        for gaps in itertools.product(GAPS, repeat=len(rows) + 1):
            cost = sum(o[1] for o in own) + sum(g[1] for g in gaps)
            if best and cost > best[0]:
                continue
            letters, out = gaps[0][0], list(gaps[0][2])
            for (letter, _, turn), (inserted, _, more) in zip(own, gaps[1:]):
                letters += letter + inserted
                out += [turn] * (turn is not None) + more
            if FORM.fullmatch("".join(role[:1] or "-" for role, _ in out)) and (best is None or (cost, letters) < best[:2]):
                best = cost, letters, out
    return best


def forwards(rows):
    """The same step by step, for longer ones: the cheapest for each last role so far."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    def stretched(states):
        for _ in range(2):
            for state, (cost, letters, out) in list(states.items()):
                role = "assistant" if state == "u" else "user"
                option = cost + 3, letters + "I", out + [(role, "")]
                if role[0] not in states or option < states[role[0]]:
                    states[role[0]] = option
        return states

    states = {"": (0, "", [])}
    for row, fault in zip(rows, faults(rows)):
        behind = {}
        for state, (cost, letters, out) in stretched(states).items():
            for letter, more, turn in choices(row, fault):
                if turn is not None and (turn[0][:1] or "-") not in follows[state]:
                    continue
                after = state if turn is None else turn[0][0]
                option = cost + more, letters + letter, out + [turn] * (turn is not None)
                if after not in behind or option < behind[after]:
                    behind[after] = option
        states = behind
    states = stretched(states)
    return min(states[s] for s in ("", "a") if s in states)


def expected(rows, find):
    found = []
    for conv in {row[0] for row in rows}:
        own = in_order([row for row in rows if row[0] == conv])
        numbers = {row[1] for row in own if row[1] is not None}
        marks = faults(own)
        cost, letters, out = find(own)
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in out).encode()).hexdigest()
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        found.append((conv, max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, marks.count("blank"), marks.count("duplicate"),
                      marks.count("truncated"), illegal, cost, letters, digest))
    return sorted(found, key=str)


def drawn(rng, conv, most):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t", None, "a.\n", "漢字", "done. \x0b"]
    turn, rows = 0, []
    for _ in range(rng.randint(1, most)):
        turn += rng.choice([0, 1, 1, 1, 2])
        rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(roles), rng.choice(texts)))
    return rows


def test_forwards_is_the_cheapest_of_all_edits():
    rng = random.Random(11)
    for _ in range(150):
        rows = in_order(drawn(rng, 1, 3))
        assert forwards(rows) == all_edits(rows)


@pytest.mark.parametrize("size", [1, 3, 1024])
def test_repair_against_brute_force(spark, size):
    rng = random.Random(size)
    rows = [row for conv in range(60) for row in drawn(rng, conv if conv else None, 12)]
    rows += [(100, i, "user" if i % 2 == 0 else "assistant", f"{i}.") for i in range(60)]  # costs don't settle at once
    rows += [(101, i, "system", f"{i}.") for i in range(20)] + [(102, 5, "user", "same.")] * 9
    rows += [(103, 1, "user", "long " * 50_000), (103, 2, "assistant", "z" * 100_000 + ".")]
    df = frame(spark, rows)
    repaired = turns.repaired(df, size=size)
    found = sorted((tuple(r) for r in turns.audits(repaired, df).collect()), key=str)
    assert found == expected(rows, forwards)
    if size == 3:
        by_place = sorted(repaired.where("conv_id = 102").collect(), key=lambda r: r.place)
        assert [(r.edit, r.role, r.text, r.fault) for r in by_place] == [
            *[("I", "user", "", None)] * 0, ("K", "user", "same.", None), *[("D", "user", "same.", "duplicate")] * 8, ("I", "assistant", "", None)]


def test_costs_settle_whatever_they_start_from():
    rng = random.Random(5)
    for _ in range(50):
        codes = bytes(rng.choice([0, 1, 2, 3, 1, 2]) | rng.choice([0, 0, 4, 8, 16]) for _ in range(40))
        start = turns.level(tuple(rng.randint(0, 9) for _ in range(4)))
        old = turns.at_begin(codes, turns.AT_END)
        assert turns.fixed(codes, start, turns.AT_END, old) == turns.at_begin(codes, start)


def test_conversations_without_turns_and_none(spark):
    df = frame(spark, [(1, 0, "user", "Hi."), (None, None, None, None)])
    found = turns.audits(turns.repaired(df.where("false")), df).collect()
    assert sorted((tuple(r) for r in found), key=str) == sorted([(c, 0, 0, 0, 0, 0, 0, "", turns.EMPTY) for c in (1, None)], key=str)
    assert turns.audits(turns.repaired(df.where("false")), df.where("false")).collect() == []


def test_damage(spark):
    import zlib
    rows = [(c, t, "assistant", "One. Two!? three") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    found = {}
    for r in turns.damaged(frame(spark, rows)).collect():
        found.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for c, t, role, text in rows:
        name = f"{' ' if c is None else c}:{' ' if t is None else t}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        want = {0: None, 1: [(role, "")], 2: [(role, re.sub("[.!?]", "", text))], 3: [(role, text)] * 2, 4: [("user", text)]}.get(kind, [(role, text)])
        assert found.get((c, t)) == want
