"""Conversation structure repair: cheapest edits by a min-plus product over a grammar of role/fault sequences."""

from __future__ import annotations

import functools
import hashlib
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import shuffle_partitions
from signalloom.operators.staging import staged

#: White space: a text of these alone is blank.
SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
ROLES = ("user", "assistant")
#: Adjacent role initials that are in order.
LEGAL = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

#: A row's symbol: its role initial (x: any other) for a sound row, the capital for a truncated one, then digits.
INITIALS = "suax"
SOUND, CUT, BLANK, COPY = "suax", "SUAX", "0123", "4567"
#: Symbols of rules follow each other from this code point on.
FIRST_RULE = 0x4E00
#: Bounds of the grammar: rules in all, and new ones in each round over the sequences.
RULES, BATCH = 512, 64

# Ropes: a short string, or (left, right, length).
SHORT = 32


def joined(a, b):
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= SHORT:
        return a + b
    if a == "" or b == "":
        return a or b
    return (a, b, _length(a) + _length(b))


def _length(rope) -> int:
    return len(rope) if isinstance(rope, str) else rope[2]


def flat(rope) -> str:
    out, open_ = [], [rope]
    while open_:
        x = open_.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            open_ += (x[1], x[0])
    return "".join(out)


def before(a, b) -> bool:
    """Whether rope ``a`` spells the lesser string. Parts that both share are passed over unread.

    Edits of the same rows and of equal cost are never a proper prefix of each other: what one had more would be
    insertions, which cost. So the order is kept whatever is put before or after both.
    """
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if isinstance(x, str) and isinstance(y, str):
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x[:n] < y[:n]
            left += [x[n:]] if len(x) > n else []
            right += [y[n:]] if len(y) > n else []
        elif isinstance(y, str) or (not isinstance(x, str) and x[2] >= y[2]):
            left += (x[1], x[0])
            right.append(y)
        else:
            right += (y[1], y[0])
            left.append(x)
    return bool(right) and not left


def least(a, b):
    """The cheaper of two (cost, rope), among equals the lesser rope; None is dearer than all."""
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if before(b[1], a[1]) else a


# Roles so far: 0 none, 1 a system row, 2 ends in user, 3 ends in assistant. Complete: 0 and 3.
STATES = range(4)
TO_USER, TO_ASSISTANT = ((0, 2), (1, 2), (3, 2)), ((2, 3),)
KEPT = {"s": ((0, 1),), "u": TO_USER, "a": TO_ASSISTANT, "x": ()}


def product(a, b):
    """Min-plus product of two transfer matrices, {(from, to): (cost, rope)}."""
    out: dict = {}
    for (i, k), (cost, rope) in a.items():
        for j in STATES:
            if (k, j) in b:
                more, end = b[k, j]
                out[i, j] = least(out.get((i, j)), (cost + more, joined(rope, end)))
    return out


def _insertions() -> dict:
    one = {(i, i): (0, "") for i in STATES} | {x: (INSERT, "I") for x in TO_USER + TO_ASSISTANT}
    return product(product(one, one), one)


INSERTIONS = _insertions()


def leaf(symbol: str) -> dict:
    """Transfer matrix of any insertions and then an edit of one row."""
    edits: dict = {(i, i): (DELETE, "D") for i in STATES}
    if symbol in SOUND + CUT:
        extra = TRUNCATED * (symbol in CUT)
        for x in TO_USER + TO_ASSISTANT:
            edits[x] = (REROLE + extra, "R")
        for x in KEPT[symbol.lower()]:
            edits[x] = (KEEP + extra, "K")
    return product(INSERTIONS, edits)


@functools.lru_cache(maxsize=4)
def matrices(rules: tuple[str, ...]) -> dict[str, dict]:
    """The matrix of every symbol; rule n is named by code point FIRST_RULE + n and replaces the pair ``rules[n]``."""
    known = {s: leaf(s) for s in SOUND + CUT + BLANK + COPY}
    for n, pair in enumerate(rules):
        known[chr(FIRST_RULE + n)] = product(known[pair[0]], known[pair[1]])
    return known


def packed(sequence: str, rules: tuple[str, ...]) -> str:
    for n, pair in enumerate(rules):
        sequence = sequence.replace(pair, chr(FIRST_RULE + n))
    return sequence


def cheapest(sequence: str, rules: tuple[str, ...]) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a sequence of symbols."""
    known = matrices(rules)
    now: dict = {(0, 0): (0, "")}
    for symbol in packed(sequence, rules):
        now = product(now, known[symbol])
    now = product(now, INSERTIONS)
    cost, rope = least(now.get((0, 0)), now.get((0, 3)))
    return cost, flat(rope)


def grammar(sequences: DataFrame, most: int = RULES, batch: int = BATCH) -> tuple[str, ...]:
    """Re-Pair over a table of sequences: rules that replace the pairs that occur most often, until none occurs twice.

    Every round counts adjacent symbols of the sequences as rewritten so far, in the tasks that hold them, and makes
    rules of the ``batch`` most frequent pairs at once, at most ``most`` in all. Only those pairs reach the driver.
    """
    rules: tuple[str, ...] = ()
    while len(rules) < most:

        def count(batches, rules=rules):
            pairs: Counter = Counter()
            for part in batches:
                for sequence in part.column(0).to_pylist():
                    text = packed(sequence, rules)
                    pairs.update(map("".join, zip(text, text[1:])))
            yield pa.record_batch({"pair": pa.array(list(pairs), pa.string()), "n": pa.array(list(pairs.values()), pa.int64())})

        counted = sequences.mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        chosen = counted.where("n > 1").orderBy(F.desc("n"), "pair").limit(min(batch, most - len(rules))).collect()
        if not chosen:
            break
        rules += tuple(r["pair"] for r in chosen)
    return rules


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): faults put in by a hash of conversation and turn.

    Of twenty hash values, 0 drops the row, 1 empties its text, 2 takes out its sentence ends, 3 repeats the row and
    4 makes its role user. Null roles and texts, and null ids in what is hashed, become one space.
    """
    key = F.concat(_filled("conv_id"), F.lit(":"), _filled("turn"))
    roll = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text = F.when(roll == 1, "").when(roll == 2, F.translate(_filled("text"), "".join(ENDS), "")).otherwise(_filled("text"))
    return conversations.where(roll != 0).select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(roll == 4, ROLES[0]).otherwise(_filled("role")).alias("role"),
        text.alias("text"),
        F.when(roll == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]


def sequences(rows: DataFrame) -> DataFrame:
    """(conv_id, sequence): the symbols of a conversation's rows in order.

    Copies of a row in the same turn are one row with a number. Texts stay behind: what is sorted, by ranges that
    cut long conversations too, is narrow. A task strings the symbols of a conversation's rows together, and what
    several tasks have of it is joined; that is a character a row, as the audit is.
    """
    trimmed = F.rtrim("text", F.lit(SPACE))
    first = F.substring("role", 1, 1)
    faults = staged(
        rows.select(
            "conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("digest"), "copies",
            F.when(first.isin(*INITIALS[:3]), first).otherwise(INITIALS[3]).alias("initial"),
            (trimmed == "").alias("blank"),
            (~F.right(trimmed, F.lit(1)).isin(*ENDS)).alias("cut"),
        )
        .groupBy("conv_id", "turn", "role", "digest", "initial", "blank", "cut")
        .agg(F.sum("copies").alias("copies")),
        "faults",
    )
    place = F.struct(F.col("turn").isNotNull(), "turn")
    firsts = faults.where("not blank").groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"))
    firsts = staged(firsts, "firsts").select(*[F.col(c).alias(f"f_{c}") for c in ("conv_id", "role", "digest")], "first")
    same = F.col("conv_id").eqNullSafe(F.col("f_conv_id")) & (F.col("role") == F.col("f_role")) & (F.col("digest") == F.col("f_digest"))
    as_symbol = lambda alphabet: F.translate("initial", INITIALS, alphabet)
    copies = F.col("copies").cast("int")
    alive = F.when(F.col("cut"), as_symbol(CUT)).otherwise(as_symbol(SOUND))
    symbols = (
        F.when(F.col("blank"), F.repeat(as_symbol(BLANK), copies))
        .when(place == F.col("first"), F.concat(alive, F.repeat(as_symbol(COPY), copies - 1)))
        .otherwise(F.repeat(as_symbol(COPY), copies))
    )
    marked = staged(
        faults.join(firsts, same, "left").select("conv_id", "turn", "role", "digest", symbols.alias("symbols")), "symbols"
    )
    by = [F.col("conv_id").asc_nulls_first(), *_order()]
    parts = shuffle_partitions(rows.sparkSession)
    inner = marked.repartitionByRange(parts, *by).sortWithinPartitions(*by).select("conv_id", "symbols")

    def string_together(batches):
        part, now, held, kind = TaskContext.get().partitionId(), None, None, pa.null()

        def runs(batch):
            nonlocal now, held
            ids, pieces = [], []
            for i, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held is None or i != now:
                    if held is not None:
                        ids.append(now)
                        pieces.append("".join(held))
                    now, held = i, []
                held.append(s)
            return ids, pieces

        def out(ids, pieces):
            return pa.record_batch({"conv_id": pa.array(ids, kind), "part": pa.array([part] * len(ids), pa.int32()), "symbols": pa.array(pieces, pa.string())})

        for batch in batches:
            kind = batch.column(0).type
            yield out(*runs(batch))
        if held is not None:
            yield out([now], ["".join(held)])

    id_type = rows.schema["conv_id"].dataType.simpleString()
    runs = inner.mapInArrow(string_together, f"conv_id {id_type}, part int, symbols string")
    pieces = F.array_sort(F.collect_list(F.struct("part", "symbols")))
    return runs.groupBy("conv_id").agg(F.array_join(F.transform(pieces, lambda x: x["symbols"]), "").alias("sequence"))


def _judged(distinct: DataFrame, rules: tuple[str, ...]) -> DataFrame:
    """Faults, cost and audit of each sequence."""
    initials = str.maketrans(CUT + BLANK + COPY, INITIALS * 3)

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("sequence", "blank", "duplicate", "truncated", "illegal", "cost", "audit")}
            for s in batch.column(0).to_pylist():
                roles = s.translate(initials)
                cost, audit = cheapest(s, rules)
                row = (s, sum(map(s.count, BLANK)), sum(map(s.count, COPY)), sum(map(s.count, CUT)), sum(a + b not in LEGAL for a, b in zip(roles, roles[1:])), cost, audit)
                for column, value in zip(out.values(), row):
                    column.append(value)
            yield pa.record_batch({c: pa.array(v, pa.string() if c in ("sequence", "audit") else pa.int64()) for c, v in out.items()})

    return distinct.mapInArrow(run, "sequence string, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def judged(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (see ``damaged``): faults, cost and audit of its cheapest repair.

    Equal sequences of symbols are repaired once, whatever the number of conversations. A grammar over them names
    pairs that recur; each rule's matrix is the product of its two sides' and serves all sequences.
    """
    found = staged(sequences(rows), "sequences")
    distinct = staged(found.select("sequence").distinct(), "distinct-sequences")
    return found.join(staged(_judged(distinct, grammar(distinct)), "judged"), "sequence").drop("sequence")


def repaired(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the rows of the repaired conversations, each conversation's in order.

    Rows of a conversation follow its audit through one sorted partition; a task holds a batch and one audit. Deleted
    rows are left out, inserted ones have an empty text.
    """
    id_type = rows.schema["conv_id"].dataType.simpleString()
    both = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", F.md5(F.col("text").cast("binary")).alias("digest"), "text", "copies").unionByName(
        verdicts.select("conv_id", F.lit(0).alias("kind"), F.col("audit").alias("text")), allowMissingColumns=True
    )
    parts = shuffle_partitions(rows.sparkSession)
    dealt = both.repartition(parts, "conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "kind", *_order())

    def follow(batches):
        audit, at, state, place, now = "", 0, 0, 0, None
        out: list[list] = [[] for _ in range(5)]

        def put(edit, role, text):
            nonlocal state, place
            state = 1 if role[:1] == "s" else 2 if role[:1] == "u" else 3
            for column, value in zip(out, (now, place, edit, role, text)):
                column.append(value)
            place += 1

        def insert():
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                put("I", ROLES[state == 2], "")
                at += 1

        def flush(kind):
            batch = pa.record_batch(
                {"conv_id": pa.array(out[0], kind), "place": pa.array(out[1], pa.int64()), "edit": pa.array(out[2], pa.string()), "role": pa.array(out[3], pa.string()), "text": pa.array(out[4], pa.string())}
            )
            for column in out:
                column.clear()
            return batch

        kind_of_id = None
        for batch in batches:
            kind_of_id = batch.column(0).type
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text", "copies")]
            for conv_id, kind, role, text, copies in zip(*columns):
                if kind == 0:
                    audit, at, state, place, now = text, 0, 0, 0, conv_id
                    insert()
                    continue
                for _ in range(copies):
                    edit = audit[at]
                    at += 1
                    if edit != "D":
                        put(edit, role if edit == "K" else ROLES[state == 2], text)
                    insert()
            yield flush(kind_of_id)

    return dealt.select("conv_id", "kind", "role", "text", "copies").mapInArrow(follow, f"conv_id {id_type}, place long, edit string, role string, text string")


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of rows that come as ``repaired`` gives them; a text is hashed as it passes by."""
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        now, state, kind = None, None, pa.null()
        out = lambda ids, hashes: pa.record_batch({"conv_id": pa.array(ids, kind), "repaired_sha256": pa.array(hashes, pa.string())})
        for batch in batches:
            kind = batch.column(0).type
            ids, hashes = [], []
            for conv_id, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text"))):
                if place == 0:
                    if state is not None:
                        ids.append(now)
                        hashes.append(state.hexdigest())
                    now, state = conv_id, hashlib.sha256()
                state.update(f"{chr(10) if place else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
            yield out(ids, hashes)
        if state is not None:
            yield out([now], [state.hexdigest()])

    return rows.select("conv_id", "place", "role", "text").mapInArrow(run, f"conv_id {id_type}, repaired_sha256 string")


def digest(conversations: DataFrame) -> DataFrame:
    """Damage conversations and repair them: one row per conversation of the input, nulls being one conversation.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Rows of the same turn
    are put in order of role and of the MD5 of the text; null turns come first. A role that starts with neither s, u
    nor a is never kept. A conversation that lost all its rows has zeros, an empty audit and the hash of nothing.
    Repeated rows are duplicates. Any other columns are ignored; an empty table gives no rows.

    The hash of a conversation's text runs through its rows in order, so a conversation is hashed by one task
    however long it is; all other work splits long conversations.
    """
    source = conversations.select("conv_id", "turn", "role", "text")
    rows = damaged(source)
    verdicts = staged(judged(rows), "verdicts")
    turns = rows.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n")).groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps")
    )
    hashes = digests(repaired(rows, verdicts))
    out = source.select("conv_id").distinct()
    for part in (verdicts, turns, hashes):
        named = part.withColumnRenamed("conv_id", "_id")
        out = out.join(named, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(
        "conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
