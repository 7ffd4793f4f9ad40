"""Conversation structure repair by Knuth's lightest-derivation agenda (operator 11).

A conversation is repaired to the role pattern ``(s?(ua)+)?`` by edits of its rows.  An item is (place, state): what is
left to do from that place on, where the state is what the pattern expects there.  Deductions build an item from the
item after an edit: keep, rerole or delete the row at the place, or insert a row.  Each has a weight (cost, audit): it
adds its cost and puts its initial before the audit of its antecedent.  Weights are popped from a heap; the first weight
popped for an item is its lightest, so the item is final, and the goal is (0, start).

Knuth's conditions: every edit keeps the order of weights (costs add; audits of equal cost that cover the same rows are
no prefixes of one another, so a letter before both keeps their order) and none is lighter than its antecedent: the heap
orders by (cost, rows covered, audit), and a keep, the one free edit, covers a row more.  For one item, no two deductions
have the same letter, so comparing letters is comparing audits, and no audit is copied while searching.

At scale: rows travel as a skeleton (role initial, fault, digest of the text) in ranges of (conversation, turn, role,
digest); a range yields segments of at most ``SEGMENT`` rows, each repaired in memory.  A conversation that lies in one
segment is done there.  Longer ones, or those a range boundary cuts, take three more steps on their segments: a
4 x 4 table of costs between states (an agenda run by state, in parallel), the cost still to come behind each segment
(a scan over those tables), and the trace from each of the four states, of which the right one is chosen in order.  What
one task holds of a conversation is a small multiple of its audit, which is one value of the result.  Texts are moved
once, in the order of the audit, and stream past it.

Defined cases: a null role or text is one space; null turns come first; rows of one turn come in the order of role, then
of their text's SHA-256; null conversation ids are one conversation; repeated rows are duplicates; the state after a row
is told by its role's first character, and a role that starts with another character than s, u and a cannot be kept;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailcheck.llm.common import fields, map_batches, shared_dir, ship, stored

SEGMENT = 2_000
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED_COST = 3
WHITE = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = (".", "!", "?")

#: States of the pattern: start, after system, after user, after assistant.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEP = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
FREE_ROLE = {START: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}
FREE_STEP = {s: STEP[s, role[0]] for s, role in FREE_ROLE.items()}
FREE_FROM = {t: tuple(s for s, x in FREE_STEP.items() if x == t) for t in range(4)}
KEPT_FROM = {(t, c): tuple(s for (s, x), y in STEP.items() if (x, y) == (c, t)) for t in range(4) for c in "sua"}
FAR = 1 << 60
LAST = (0, FAR, FAR, 0)
LEGAL = {"su", "ua", "au"}


def lightest(roles: str, faults: str, behind: tuple[int, ...] | list[int]) -> tuple[list[int], list[str]]:
    """Cost and first letter of every item, as lists by 4 * place + state.

    ``roles`` and ``faults`` have a character a row: the role's initial, and ``.`` none, ``b`` blank, ``d`` duplicate or
    ``t`` truncated.  ``behind`` are the axioms: the cost still to come after the last row, by state.
    """
    n = len(roles)
    cost, first = [FAR] * (4 * n + 4), [""] * (4 * n + 4)
    final = [False] * (4 * n + 4)
    heap = [(c, 0, "", 4 * n + t) for t, c in enumerate(behind) if c < FAR]
    heapq.heapify(heap)
    rerole, delete, insert = COSTS["R"], COSTS["D"], COSTS["I"]
    push, pop = heapq.heappush, heapq.heappop
    for c, _, _, item in heap:
        cost[item] = c

    def deduce(c: int, covered: int, letter: str, item: int) -> None:
        if not final[item] and (c < cost[item] or c == cost[item] and letter < first[item]):
            cost[item], first[item] = c, letter
            push(heap, (c, covered, letter, item))

    while heap:
        c, covered, letter, item = pop(heap)
        if final[item] or (c, letter) != (cost[item], first[item]):
            continue
        final[item] = True
        place, t = divmod(item, 4)
        for s in FREE_FROM[t]:
            deduce(c + insert, covered, "I", 4 * place + s)
        if place:
            at, fault = 4 * (place - 1), faults[place - 1]
            deduce(c + delete, covered + 1, "D", at + t)
            if fault == "." or fault == "t":
                more = c + (TRUNCATED_COST if fault == "t" else 0)
                for s in KEPT_FROM.get((t, roles[place - 1]), ()):
                    deduce(more, covered + 1, "K", at + s)
                for s in FREE_FROM[t]:
                    deduce(more + rerole, covered + 1, "R", at + s)
    return cost, first


def trace(roles: str, first: list[str], state: int, last: bool) -> tuple[str, int]:
    """The audit from place 0 in ``state``, and the state it ends in; behind the last row only where ``last``."""
    n, place, out = len(roles), 0, []
    while place < n or last:
        letter = first[4 * place + state]
        if not letter:
            break
        out.append(letter)
        if letter in "IR":
            state = FREE_STEP[state]
        elif letter == "K":
            state = STEP[state, roles[place]]
        place += letter != "I"
    return "".join(out), state


def illegal_pairs(roles: str) -> int:
    return sum(roles[i : i + 2] not in LEGAL for i in range(len(roles) - 1))


def _turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turn, role, text, digest, initial, fault (but for duplicates) of every row."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    return df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), one(role_col).alias("role"), one(text_col).alias("text")).select(
        "*", F.substring(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), 1, 16).alias("digest"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("-").alias("initial"),
        F.when(body == "", "b").when(F.right(body, F.lit(1)).isin(*SENTENCE_ENDS), ".").otherwise("t").alias("fault"))


def _segments(turns: DataFrame) -> DataFrame:
    """Segments of at most SEGMENT rows in order, those of whole conversations with their repair.

    Copies of a row meet as one row with their number; a mark, sorted before it, tells the first row of its role and text.
    """
    key = ("conv", "turn", "role", "digest")
    rows = turns.groupBy(*key, "initial", "fault").agg(F.count(F.lit(1)).alias("n"))
    firsts = turns.groupBy("conv", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("at"))
    marks = firsts.select("conv", F.col("at.turn").alias("turn"), "role", "digest", F.lit("-").alias("initial"), F.lit(".").alias("fault"), F.lit(0).cast("long").alias("n"))
    dealt = rows.unionByName(marks).repartitionByRange(*key).sortWithinPartitions(*key, "n")

    def make():
        part, seq = TaskContext.get().partitionId(), 0
        mark = conv = None
        roles: list[str] = []
        faults: list[str] = []
        held = 0
        started, whole = False, False  # whole: the conversation began inside this range
        ready: dict[str, list] = {}

        def clear() -> None:
            for name in ("conv", "part", "seq", "roles", "faults", "audit", "cost", "cut"):
                ready[name] = []

        def close(ended: bool) -> None:
            """Put the held rows out as a segment; ended: no more rows of the conversation are in this range."""
            nonlocal seq, held
            if not started:
                return
            a, b = "".join(roles), "".join(faults)
            roles.clear(), faults.clear()
            held = 0
            audit = cost = None
            if whole and ended:
                costs, first = lightest(a, b, LAST)
                audit, cost = trace(a, first, START, True)[0], costs[START]
            for name, x in zip(ready, (conv, part, seq, a, b, audit, cost, audit is None)):
                ready[name].append(x)
            seq += 1

        def each(batch: pa.RecordBatch) -> Iterator[dict]:
            nonlocal mark, conv, held, started, whole
            for c, turn, role, digest, initial, fault, n in zip(*(x.to_pylist() for x in batch.columns)):
                if not started or c != conv:
                    close(True)
                    whole = started  # what the range begins with may have begun before
                    conv, started = c, True
                if not n:
                    mark = (turn, role, digest, c)
                    continue
                new = mark == (turn, role, digest, c)
                while n:
                    if held >= SEGMENT:
                        close(False)
                        whole = False
                    some = min(n, SEGMENT - held)
                    roles.append(initial * some)
                    faults.append("b" * some if fault == "b" else (fault if new else "d") + "d" * (some - 1))
                    new, n, held = False, n - some, held + some
            if len(ready["conv"]) > 500:
                yield dict(ready)
                clear()

        def end() -> Iterator[dict]:
            nonlocal whole
            whole = False  # what the range ends with may go on behind it
            close(False)
            if ready["conv"]:
                yield dict(ready)

        clear()
        each.end = end
        return each

    schema = fields(turns, ["conv"], "part int, seq int, roles string, faults string, audit string, cost long, cut boolean")
    return map_batches(dealt.select(*key, "initial", "fault", "n"), schema, make)


def _cut_repairs(cut: DataFrame, at: str) -> DataFrame:
    """conv, audit, cost, illegal pairs between segments, of the conversations that lie in several segments."""

    def tables():
        def each(batch: pa.RecordBatch) -> Iterator[dict]:
            out = []
            for roles, faults in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                to = [lightest(roles, faults, [0 if s == t else FAR for s in range(4)])[0][:4] for t in range(4)]
                out.append([to[t][s] for s in range(4) for t in range(4)])
            ends = [(x[:1], x[-1:]) for x in batch.column(3).to_pylist()]
            yield {"conv": batch.column(0), "part": batch.column(1), "seq": batch.column(2), "costs": out, "head": [x for x, _ in ends], "tail": [x for _, x in ends]}

        return each

    costs = map_batches(cut.select("conv", "part", "seq", "roles", "faults"), fields(cut, ["conv", "part", "seq"], "costs array<long>, head string, tail string"), tables)

    def behind(table: pd.DataFrame) -> pd.DataFrame:
        """The cost still to come behind every segment of a conversation, and whether its first pair is illegal."""
        table = table.sort_values(["part", "seq"])
        after, out = LAST, []
        for m in reversed(table["costs"].tolist()):
            out.append(list(after))
            after = tuple(min(FAR, *(m[4 * s + t] + after[t] for t in range(4))) for s in range(4))
        tails = ["", *table["tail"].tolist()[:-1]]
        return table[["conv", "part", "seq"]].assign(behind=out[::-1], last=[False] * (len(table) - 1) + [True],
                                                     joint=[int(bool(a) and a + b not in LEGAL) for a, b in zip(tails, table["head"])])

    ship(cut.sparkSession)
    bounds = stored(costs.groupBy("conv").applyInPandas(behind, fields(cut, ["conv", "part", "seq"], "behind array<long>, last boolean, joint int")), "bounds", at)
    met = cut.select("part", "seq", "roles", "faults").join(bounds, ["part", "seq"]).select("conv", "part", "seq", "roles", "faults", "behind", "last", "joint")

    def traces():
        def each(batch: pa.RecordBatch) -> Iterator[dict]:
            out = {k: [] for k in ("audits", "ends", "costs")}
            for roles, faults, after, last in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5, 6))):
                cost, first = lightest(roles, faults, after)
                found = [trace(roles, first, s, last) for s in range(4)]
                out["audits"].append([x for x, _ in found]), out["ends"].append([x for _, x in found]), out["costs"].append(cost[0])
            yield {"conv": batch.column(0), "part": batch.column(1), "seq": batch.column(2), "joint": batch.column(7), **out}

        return each

    paths = map_batches(met, fields(cut, ["conv", "part", "seq"], "joint int, audits array<string>, ends array<int>, costs long"), traces)

    def choose(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(["part", "seq"])
        state, out = START, []
        for audits, ends in zip(table["audits"], table["ends"]):
            out.append(audits[state])
            state = ends[state]
        return pd.DataFrame({"conv": table["conv"].iloc[:1], "audit": "".join(out), "cost": int(table["costs"].iloc[0]), "joints": int(table["joint"].sum())})

    return paths.groupBy("conv").applyInPandas(choose, fields(cut, ["conv"], "audit string, cost long, joints long"))


def repairs(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, audit, cost, blank, duplicate, truncated, illegal of every conversation that has rows; stored."""
    spark = df.sparkSession
    at = shared_dir(spark, "conversations")
    turns = _turns(df, conv_col, turn_col, role_col, text_col).drop("text")
    segments = stored(_segments(turns), "segments", at)
    of = lambda c: F.length(F.translate("faults", "".join(x for x in ".bdt" if x != c), "")).cast("long")
    pairs = F.length("roles") - 1 - sum(F.coalesce(F.regexp_count("roles", F.lit(f"{p[0]}(?={p[1]})")), F.lit(0)) for p in sorted(LEGAL))
    counted = segments.select("conv", "cut", "audit", "cost", of("b").alias("blank"), of("d").alias("duplicate"), of("t").alias("truncated"), pairs.cast("long").alias("illegal"))
    names = ["blank", "duplicate", "truncated", "illegal"]
    sums = counted.where("cut").groupBy("conv").agg(*(F.sum(c).alias(c) for c in names))
    cut = _cut_repairs(segments.where("cut"), at)
    late = sums.select("conv", F.lit(None).cast("string").alias("audit"), F.lit(None).cast("long").alias("cost"), *names).unionByName(
        cut.select("conv", "audit", "cost", *(F.lit(0).cast("long").alias(c) for c in names[:3]), F.col("joints").alias("illegal")))
    late = late.groupBy("conv").agg(F.max("audit").alias("audit"), F.max("cost").alias("cost"), *(F.sum(c).alias(c) for c in names))
    return stored(counted.where("not cut").select("conv", "audit", "cost", *names).unionByName(late), "repairs", at)


def repaired_turns(df: DataFrame, plans: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, place, edit, role, text of the rows of the repaired conversations: kept and reroled rows and inserted ones.

    Each conversation lies in one partition, in order.  Its rows stream past its audit in batches.
    """
    turns = _turns(df, conv_col, turn_col, role_col, text_col)
    none = lambda c: F.lit(None).cast(turns.schema[c].dataType).alias(c)
    rows = turns.select("conv", F.lit(1).alias("kind"), "turn", "role", "digest", "text", "initial")
    audits = plans.select("conv", F.lit(0).alias("kind"), none("turn"), none("role"), none("digest"), F.col("audit").alias("text"), F.lit("").alias("initial"))
    dealt = rows.unionByName(audits).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "digest")

    def make():
        conv, audit, at, state, place = None, "", 0, START, 0
        out: dict[str, list] = {}

        def clear() -> None:
            for name in ("conv", "place", "edit", "role", "text"):
                out[name] = []

        def put(edit: str, role: str, text: str) -> None:
            nonlocal place
            for name, x in zip(out, (conv, place, edit, role, text)):
                out[name].append(x)
            place += 1

        def inserts() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                put("I", FREE_ROLE[state], "")
                state, at = FREE_STEP[state], at + 1

        def each(batch: pa.RecordBatch) -> Iterator[dict]:
            nonlocal conv, audit, at, state, place
            texts = batch.column(5)
            for k, (c, kind, role, initial) in enumerate(zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 6)))):
                if not kind:
                    inserts()
                    conv, audit, at, state, place = c, texts[k].as_py(), 0, START, 0
                    continue
                inserts()
                edit, at = audit[at], at + 1
                if edit == "K":
                    put("K", role, texts[k].as_py())
                    state = STEP[state, initial]
                elif edit == "R":
                    put("R", FREE_ROLE[state], texts[k].as_py())
                    state = FREE_STEP[state]
            if out["conv"]:
                yield dict(out)
                clear()

        def end() -> Iterator[dict]:
            inserts()
            if out["conv"]:
                yield dict(out)

        clear()
        each.end = end
        return each

    return map_batches(dealt, fields(turns, ["conv"], "place long, edit string, role string, text string"), make)


def _digests(repaired: DataFrame) -> DataFrame:
    """conv and the SHA-256 of its ``role:text`` lines; the rows come as repaired_turns deals them."""

    def make():
        conv = sha = None
        out: dict[str, list] = {"conv": [], "sha": []}

        def close() -> None:
            if sha is not None:
                out["conv"].append(conv), out["sha"].append(sha.hexdigest())

        def each(batch: pa.RecordBatch) -> Iterator[dict]:
            nonlocal conv, sha
            texts = batch.column(3)
            for k, (c, place, role) in enumerate(zip(*(batch.column(i).to_pylist() for i in (0, 1, 2)))):
                if place == 0:
                    close()
                    conv, sha = c, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:".encode())
                sha.update(texts[k].as_py().encode())
            if out["conv"]:
                yield {k: list(v) for k, v in out.items()}
                out["conv"].clear(), out["sha"].clear()

        def end() -> Iterator[dict]:
            close()
            if out["conv"]:
                yield out

        each.end = end
        return each

    return map_batches(repaired.select("conv", "place", "role", "text"), fields(repaired, ["conv"], "sha string"), make)


def damaged(df: DataFrame) -> DataFrame:
    """The conversations with the faults that the contract of op11 plants, by a hash of conversation and turn."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault: Column = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn")).cast("binary")) % 20
    rows = df.select("conv_id", "turn", one("role").alias("role"), one("text").alias("text"), fault.alias("fault")).where("fault != 0")
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                       F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows, names = damaged(given), ("conv_id", "turn", "role", "text")
    plans = repairs(rows, *names)
    hashes = _digests(repaired_turns(rows, plans, *names))
    turns = rows.select("conv_id", "turn").distinct().groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    numbers, words = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), ("audit", "repaired_sha256")

    def part(df: DataFrame, **columns: Column) -> DataFrame:
        kinds = {**dict.fromkeys(numbers, "long"), **dict.fromkeys(words, "string")}
        return df.select(df[df.columns[0]].alias("conv_id"), *(columns.get(c, F.lit(None)).cast(t).alias(c) for c, t in kinds.items()))

    every = [part(given.select("conv_id").distinct()), part(turns, gaps=F.col("gaps")), part(hashes, repaired_sha256=F.col("sha")),
             part(plans, **{c: F.col(c) for c in (*numbers[1:], "audit")})]
    met = every[0].unionByName(every[1]).unionByName(every[2]).unionByName(every[3]).groupBy("conv_id").agg(*(F.max(c).alias(c) for c in (*numbers, *words)))
    return met.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
