"""Repair of the structure of conversations by Viterbi with rank convergence (operator 11).

A conversation is to be of the form: perhaps a system turn, then user and assistant in turn, user first, assistant last; or empty. The cheapest
edits are those of a shortest path over four states: nothing yet, after the system turn, after a user turn, after an assistant turn.
``costs`` of a place are the least costs from each state there to the end, found from the end backwards.

1. Rows without their texts are put in order by range, so that a conversation of any length is spread, and cut into chunks. Each
   chunk is run backwards from speculative costs at its end, as if the conversation ended there.
2. Fix-up passes: a chunk whose costs at the end differ from those its successor has found at its beginning, by more than a constant, runs
   again from these, until its costs differ from the old ones by a constant only: what is before is right then. Passes are
   repeated until none differs.
3. Each chunk follows the least edits from every state it may be entered in. These maps of states, four numbers a chunk, put one after the
   other tell in which state each chunk is entered.
4. The chunks give the edit of each row, and rows get their texts by conversation, turn, role and digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from changewatch.llm.common import mapped, scratch, written

CHUNK = 1024  # rows
PART = 200_000  # rows of a range
SPACE = " \t\n\x0b\f\r"
BLANK, DUPLICATE, TRUNCATED = 4, 8, 16  # bits of a code; the lower two are the initial of the role
INITIALS = {"s": 0, "u": 1, "a": 2}  # 3 for others
FAULTS = {BLANK: "blank", DUPLICATE: "duplicate", TRUNCATED: "truncated"}
#: What edits cost: fixed values.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {START: {0: SYSTEM, 1: USER}, SYSTEM: {1: USER}, USER: {2: ASSISTANT}, ASSISTANT: {1: USER}}
OTHER = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # where a turn of the next role leads
ROLES = {USER: "user", ASSISTANT: "assistant"}
AT_END = (0, 6, 3, 0)
Costs = tuple[int, int, int, int]


def level(costs: Costs) -> Costs:
    """Costs without what they have in common."""
    least = min(costs)
    return tuple(c - least for c in costs)


@lru_cache(maxsize=1 << 16)
def before(costs: Costs, code: int) -> Costs:
    """The costs before a row, given those behind it."""
    own = [DELETE + costs[state] for state in range(4)]
    if not code & (BLANK | DUPLICATE):
        extra = CUT_OFF if code & TRUNCATED else 0
        for state in range(4):
            own[state] = min(own[state], REROLE + extra + costs[OTHER[state]])
            kept = FOLLOWS[state].get(code & 3)
            if kept is not None:
                own[state] = min(own[state], extra + costs[kept])
    user, assistant = min(own[USER], INSERT + own[ASSISTANT]), min(own[ASSISTANT], INSERT + own[USER])
    return min(own[START], INSERT + user), min(own[SYSTEM], INSERT + user), user, assistant


@lru_cache(maxsize=1 << 16)
def followed(costs: Costs, code: int, state: int) -> tuple[str, int]:
    """The edits at a row and before it, the first in the order of letters among the cheapest, and the state behind it. ``costs`` are
    those behind it."""
    here, edits = before(costs, code), ""
    extra = CUT_OFF if code & TRUNCATED else 0
    while True:
        if DELETE + costs[state] == here[state]:
            return edits + "D", state
        if INSERT + here[OTHER[state]] == here[state]:
            edits, state = edits + "I", OTHER[state]
            continue
        kept = FOLLOWS[state].get(code & 3)
        if kept is not None and extra + costs[kept] == here[state]:
            return edits + "K", kept
        return edits + "R", OTHER[state]


def backwards(codes: bytes, end: Costs) -> list[Costs]:
    """The costs behind each row."""
    found = []
    for code in reversed(codes):
        found.append(end)
        end = level(before(end, code))
    return found[::-1]


def at_begin(codes: bytes, end: Costs) -> Costs:
    for code in reversed(codes):
        end = level(before(end, code))
    return end


def fixed(codes: bytes, end: Costs, old_end: Costs, old_begin: Costs) -> Costs:
    """The costs at the beginning for new ones at the end; as they were from where both differ by a constant only."""
    for code in reversed(codes):
        if end == old_end:
            return old_begin
        end, old_end = level(before(end, code)), level(before(old_end, code))
    return end


def traced(codes: bytes, end: Costs, state: int) -> tuple[list[str], int]:
    edits = []
    for code, costs in zip(codes, backwards(codes, end)):
        own, state = followed(costs, code, state)
        edits.append(own)
    return edits, state


def rows_of(conversations: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    found = conversations.select(
        F.col(key).alias("k"), F.col(turn).cast("long").alias("t"), F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("r"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("x"))
    return found.withColumn("d", F.unhex(F.sha2("x", 256)))


def same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    found = F.lit(True)
    for name in names:
        found &= a[name].eqNullSafe(b[name])
    return found


def marked(rows: DataFrame) -> DataFrame:
    """Distinct k, t, r, d with their number n, whether they are blank or truncated, and whether an earlier turn has role and text."""
    stripped = F.rtrim("x", F.lit(SPACE))
    cut = ~F.right(stripped, F.lit(1)).isin(".", "!", "?")
    counted = rows.select("k", "t", "r", "d", (stripped == "").alias("blank"), cut.alias("cut")).groupBy("k", "t", "r", "d").agg(
        F.count(F.lit(1)).alias("n"), F.max("blank").alias("blank"), F.max("cut").alias("cut"))
    firsts = rows.groupBy("k", "r", "d").agg(F.min(F.struct(F.col("t").isNotNull().alias("has"), "t")).alias("f")).select(
        "k", F.col("f.t").alias("t"), "r", "d", F.lit(True).alias("first"))
    return counted.join(firsts, same(counted, firsts, "k", "t", "r", "d"), "left").select(
        counted["k"], counted["t"], counted["r"], counted["d"], "n", "blank", "cut", F.coalesce("first", F.lit(False)).alias("first"))


def chunks(rows: DataFrame, size: int, kind: str) -> DataFrame:
    """Chunks of ``marked`` rows in order: k, part and number, which order them, codes, and for each row turn, role and digest; and the
    costs at the beginning if the conversation ended behind it."""
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // PART))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        own: list[tuple] = []
        key, number, weight = None, 0, 0

        def close() -> None:
            nonlocal own, number
            if own:
                codes, *lists = zip(*own)
                done.append((key, number, bytes(codes), *map(list, lists), list(at_begin(bytes(codes), AT_END))))
                own, number = [], number + 1

        def table() -> pa.RecordBatch:
            nonlocal weight
            columns = list(zip(*done)) if done else [[]] * 7
            done.clear()
            weight = 0
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (key_type, pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.string()),
                                                          pa.list_(pa.binary()), pa.list_(pa.int32())))],
                ["k", "number", "codes", "turns", "roles", "digests", "begin"])

        for batch in batches:
            key_type = batch.schema.field("k").type
            for k, t, r, d, n, blank, late, first in zip(*(batch.column(c).to_pylist() for c in
                                                            ("k", "t", "r", "d", "n", "blank", "cut", "first"))):
                if k != key:
                    close()
                    key = k
                initial = INITIALS.get(r[:1], 3)
                for i in range(n):
                    fault = BLANK if blank else DUPLICATE if i or not first else TRUNCATED if late else 0
                    own.append((initial | fault, t, r, d))
                    if len(own) == size:
                        close()
                    weight += 1
                    if weight > 1 << 16:
                        yield table()
            if done:
                yield table()
        close()
        if done:
            yield table()

    ordered = rows.repartitionByRange(parts, "k", "t", "r", "d").sortWithinPartitions("k", "t", "r", "d")
    found = mapped(ordered, cut, f"k {kind}, number long, codes binary, turns array<bigint>, roles array<string>, digests array<binary>, begin array<int>")
    return found.withColumn("part", F.spark_partition_id())


def settled(links: DataFrame) -> DataFrame:
    """Chunks of conversations of several with the costs at their end that follow from the chunks behind them, and ``last``. Each pass
    runs those again whose successor has found others than they started from."""
    order = Window.partitionBy("k").orderBy("part", "number")

    def rerun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, begins = [], []
            for codes, end, begin, follows in zip(*(batch.column(c).to_pylist() for c in ("codes", "end", "begin", "follows"))):
                if follows is not None and follows != end:
                    begin = list(fixed(codes, tuple(follows), tuple(end), tuple(begin)))
                    end = follows
                ends.append(end), begins.append(begin)
            at = [batch.schema.get_field_index(c) for c in ("k", "part", "number", "codes")]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, at), pa.array(ends, pa.list_(pa.int32())), pa.array(begins, pa.list_(pa.int32()))],
                ["k", "part", "number", "codes", "end", "begin"])

    kinds = ", ".join(f"{c} {links.schema[c].dataType.simpleString()}" for c in ("k", "part", "number", "codes", "end", "begin"))
    while True:
        ahead = written(links.withColumn("follows", F.lead("begin").over(order)), "passes")
        if ahead.where("follows IS NOT NULL AND follows <> end").isEmpty():
            return ahead.select("k", "part", "number", "codes", "end", F.col("follows").isNull().alias("last"))
        links = mapped(ahead, rerun, kinds)


def entered(links: DataFrame) -> DataFrame:
    """part, number, end, last, and the state in which each chunk is entered. Only chunks' maps of states, not their rows, of a
    conversation pass one task."""
    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [[traced(codes, tuple(end), state)[1] for state in range(4)]
                   for codes, end in zip(batch.column("codes").to_pylist(), batch.column("end").to_pylist())]
            at = [batch.schema.get_field_index(c) for c in ("k", "part", "number", "end", "last")]
            yield pa.RecordBatch.from_arrays([*map(batch.column, at), pa.array(own, pa.list_(pa.int32()))],
                                             ["k", "part", "number", "end", "last", "ways"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = START
        for batch in batches:
            states = []
            for own, last in zip(batch.column("ways").to_pylist(), batch.column("last").to_pylist()):
                states.append(state)
                state = START if last else own[state]
            at = [batch.schema.get_field_index(c) for c in ("part", "number", "end", "last")]
            yield pa.RecordBatch.from_arrays([*map(batch.column, at), pa.array(states, pa.int32())],
                                             ["part", "number", "end", "last", "state"])

    kind = links.schema["k"].dataType.simpleString()
    found = mapped(links, ways, f"k {kind}, part int, number long, end array<int>, last boolean, ways array<int>")
    return mapped(found.repartition("k").sortWithinPartitions("k", "part", "number"), walk,
                  "part int, number long, end array<int>, last boolean, state int")


def edits_of(cut: DataFrame, states: DataFrame, kind: str) -> DataFrame:
    """Each row and inserted turn: k, place, which orders the turns of a conversation, t, edit, role, was (the role before), d, fault and cost."""
    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(9)]
            at: list[int] = []
            for i, (part, number, codes, turns, roles, digests, end, last, state) in enumerate(zip(*(
                    batch.column(c).to_pylist() for c in ("part", "number", "codes", "turns", "roles", "digests", "end", "last", "state")))):
                end = AT_END if end is None else tuple(end)
                last, state = last is not False, state or START
                steps, _ = traced(codes, end, state)
                place = (part << 40) + (number << 20)
                for code, turn, was, digest, own in zip(codes, turns, roles, digests, steps):
                    for letter in own[:-1]:
                        state = OTHER[state]
                        for column, value in zip(columns, (place, None, "I", ROLES[state], None, None, None, INSERT)):
                            column.append(value)
                        at.append(i)
                        place += 1
                    letter, role, cost = own[-1], was, 0
                    if letter == "D":
                        cost = DELETE
                    else:
                        cost = CUT_OFF if code & TRUNCATED else 0
                        if letter == "R":
                            state = OTHER[state]
                            role, cost = ROLES[state], cost + REROLE
                        else:
                            state = FOLLOWS[state][code & 3]
                    for column, value in zip(columns, (place, turn, letter, role, was, digest, FAULTS.get(code & ~3), cost)):
                        column.append(value)
                    at.append(i)
                    place += 1
                while last and state in (SYSTEM, USER):
                    state = OTHER[state]
                    for column, value in zip(columns, (place, None, "I", ROLES[state], None, None, None, INSERT)):
                        column.append(value)
                    at.append(i)
                    place += 1
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("k").take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                ["k", "place", "t", "edit", "role", "was", "d", "fault", "cost"])

    told = cut.join(states, ["part", "number"], "left")
    return mapped(told, edit, f"k {kind}, place long, t long, edit string, role string, was string, d binary, fault string, cost int")


def repaired(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             size: int = CHUNK) -> DataFrame:
    """Every turn, deleted and inserted ones included: key, place (which orders the turns of a conversation), turn, edit (K for kept, R for
    another role, D for deleted, I for inserted), role, was (the role before), text, fault and cost.

    Turns of a conversation are in the order of turn, null first; those with the same turn by role and SHA-256 of the text. A null role or text is one
    space; null keys are one conversation; repeated rows are turns each, all but the first a duplicate; other columns are not looked
    at, an empty table gives an empty one. Edits are the cheapest, of equally cheap ones those whose letters come first.
    ``size`` is the number of rows of a chunk, which doesn't change the result."""
    spark = conversations.sparkSession
    rows = rows_of(conversations, key, turn, role, text)
    kind = rows.schema["k"].dataType.simpleString()
    with scratch(spark):
        with scratch(spark):
            cut = written(chunks(written(marked(rows), "marked"), size, kind), "chunks", keep=True)
        several = F.count(F.lit(1)).over(Window.partitionBy("k"))
        links = cut.select("k", "part", "number", "codes", F.lit(list(AT_END)).cast("array<int>").alias("end"), "begin")
        links = written(links.withColumn("several", several).where("several > 1").drop("several"), "links")
        edits = written(edits_of(cut, written(entered(settled(links)), "states"), kind), "edits", keep=True)
    texts = rows.select(F.col("k").alias("k2"), F.col("t").alias("t2"), F.col("r").alias("r2"), F.col("d").alias("d2"), "x").dropDuplicates(
        ["k2", "t2", "r2", "d2"])
    on = F.col("k").eqNullSafe(F.col("k2")) & F.col("t").eqNullSafe(F.col("t2")) & (F.col("was") == F.col("r2")) & (F.col("d") == F.col("d2"))
    return edits.join(texts, on, "left").select(
        F.col("k").alias(key), "place", F.col("t").alias(turn), "edit", F.col("role").alias(role), "was",
        F.coalesce("x", F.lit("")).alias(text), "fault", "cost")


EMPTY = hashlib.sha256(b"").hexdigest()


def audits(repaired_rows: DataFrame, keys: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Of each of the ``keys``, which may be null and have no rows: gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    The turns of a conversation pass a task one after the other, as a SHA-256 needs them; only its letters are held."""
    fixed_part = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    names = ["k", *fixed_part, "audit", "repaired_sha256"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        key = counts = None

        def close() -> None:
            if counts is not None:
                gaps = most - least + 1 - turns if turns else 0
                done.append((key, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, "".join(letters), sha.hexdigest()))

        def table() -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [[]] * len(names)
            done.clear()
            kinds = [key_type, *[pa.int64()] * len(fixed_part), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        for batch in batches:
            key_type = batch.schema.field("k").type
            for k, t, edit, own_role, was, x, fault, own_cost in zip(*(batch.column(c).to_pylist() for c in
                                                                       ("k", "t", "edit", "role", "was", "x", "fault", "cost"))):
                if counts is None or k != key:
                    close()
                    key, counts, letters, sha = k, dict.fromkeys(FAULTS.values(), 0), [], hashlib.sha256()
                    turns = illegal = cost = 0
                    most = least = last = None
                    any_kept = False
                letters.append(edit)
                cost += own_cost
                if edit != "D":
                    sha.update((("\n" if any_kept else "") + own_role + ":" + x).encode())
                    any_kept = True
                if edit == "I":
                    continue
                if fault:
                    counts[fault] += 1
                if last is not None and last[:1] + was[:1] not in ("su", "ua", "au"):
                    illegal += 1
                last = was
                if t is not None and t != most:  # turns ascend
                    turns, most, least = turns + 1, t, t if least is None else least
            yield table()
        close()
        if done:
            yield table()

    rows = repaired_rows.select(F.col(key).alias("k"), "place", F.col(turn).alias("t"), "edit", F.col(role).alias("role"), "was",
                                F.col(text).alias("x"), "fault", "cost")
    kind = rows.schema["k"].dataType.simpleString()
    found = mapped(rows.repartition("k").sortWithinPartitions("k", "place"), walk, f"k {kind}, " + ", ".join(
        f"{c} long" for c in fixed_part) + ", audit string, repaired_sha256 string")
    keys = keys.select(F.col(key).alias("own")).distinct()
    return keys.join(found, F.col("own").eqNullSafe(F.col("k")), "left").select(
        F.col("own").alias(key), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in fixed_part],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY)).alias("repaired_sha256"))


def damaged(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """key, turn, role and text of turns of which some are dropped, emptied, without their full stops, repeated, or given to the user."""
    part = F.crc32(F.concat(F.coalesce(F.col(key).cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col(turn).cast("string"), F.lit(" ")))
                   .cast("binary")) % 20
    own_role, own_text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role, text))
    rows = conversations.select(F.col(key).alias("k"), F.col(turn).alias("t"), own_role.alias("r"), own_text.alias("x"), part.alias("h")).where("h <> 0")
    rows = rows.select("k", "t", F.when(F.col("h") == 4, "user").otherwise(F.col("r")).alias("r"),
                       F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("x", ".!?", "")).otherwise(F.col("x")).alias("x"),
                       F.explode(F.when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return rows.select(F.col("k").alias(key), F.col("t").alias(turn), F.col("r").alias(role), F.col("x").alias(text))


#: The same in SQL: CRC-32 by its definition, and the cheapest edits forwards, turn by turn, with their letters.
SQL = """
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(1, strlen(k) + 1), lambda i: ascii(k[i])::BIGINT),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS h
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations)
), hit AS (
  SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, unnest(CASE h WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n,
    left(role, 1) AS i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS stripped
  FROM hit
), faulty AS (
  SELECT *, stripped = '' AS blank, stripped <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS copy,
    lag(i) OVER (PARTITION BY conv_id ORDER BY n) AS before
  FROM numbered
), ready AS (
  SELECT *, blank OR copy AS must, NOT blank AND NOT copy AND right(stripped, 1) NOT IN ('.', '!', '?') AS cut FROM faulty
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(copy) AS duplicate,
    count_if(cut) AS truncated, count_if(n > 1 AND before || i NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS last
  FROM ready GROUP BY conv_id
), moves(state, letter, initial, target, cost, role) AS (
  VALUES ('0', 'K', 's', 's', 0, NULL), ('0', 'K', 'u', 'u', 0, NULL), ('s', 'K', 'u', 'u', 0, NULL), ('u', 'K', 'a', 'a', 0, NULL),
    ('a', 'K', 'u', 'u', 0, NULL), ('0', 'R', NULL, 'u', 3, 'user'), ('s', 'R', NULL, 'u', 3, 'user'), ('u', 'R', NULL, 'a', 3, 'assistant'),
    ('a', 'R', NULL, 'u', 3, 'user'), ('0', 'D', NULL, '0', 4, NULL), ('s', 'D', NULL, 's', 4, NULL), ('u', 'D', NULL, 'u', 4, NULL),
    ('a', 'D', NULL, 'a', 4, NULL)
), inserts(state, letters, target, cost, lines) AS (
  VALUES ('0', '', '0', 0, []), ('s', '', 's', 0, []), ('u', '', 'u', 0, []), ('a', '', 'a', 0, []), ('0', 'I', 'u', 3, ['user:']),
    ('s', 'I', 'u', 3, ['user:']), ('u', 'I', 'a', 3, ['assistant:']), ('a', 'I', 'u', 3, ['user:']),
    ('0', 'II', 'a', 6, ['user:', 'assistant:']), ('s', 'II', 'a', 6, ['user:', 'assistant:'])
), paths AS (
  SELECT conv_id, 0::BIGINT AS n, '0' AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM counts
  UNION ALL
  SELECT conv_id, n, state, best.cost, best.audit, best.lines FROM (
    SELECT p.conv_id, p.n + 1 AS n, m.target AS state, min({'cost': p.cost + e.cost + m.cost + CASE WHEN r.cut AND m.letter <> 'D' THEN 3 ELSE 0 END,
        'audit': p.audit || e.letters || m.letter,
        'lines': p.lines || e.lines || CASE m.letter WHEN 'D' THEN [] ELSE [coalesce(m.role, r.role) || ':' || r.text] END}) AS best
    FROM paths p JOIN ready r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.n = p.n + 1 JOIN inserts e ON e.state = p.state
      JOIN moves m ON m.state = e.target AND (m.initial IS NULL OR m.initial = r.i) AND (m.letter = 'D' OR NOT r.must)
    GROUP BY p.conv_id, p.n, m.target)
), ends AS (
  SELECT c.conv_id, min({'cost': p.cost + e.cost, 'audit': p.audit || e.letters, 'lines': p.lines || e.lines}) AS best
  FROM counts c JOIN paths p ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.n = c.last JOIN inserts e ON e.state = p.state
  WHERE e.target IN ('0', 'a') GROUP BY c.conv_id
)
SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM k.conv_id
  LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM k.conv_id
"""
