"""Conversation structure repair: the cheapest edits that make the roles read `(s?(ua)+)?`.

A Viterbi pass over a conversation's rows has four states, what the last
role put out begins with: nothing yet, s, u or a.  The paths of the states' survivors are a tree of
backpointers with counted references.  A path that no survivor continues is
released; as soon as all survivors share an ancestor, the edits up to it are
settled, put out and forgotten.  Memory holds only what is open.  Of equally
cheap paths to a state the one whose letters come first stays; both are
compared as far as they are open, back to their last shared edit.  (Paths of
one state and one cost never begin with one another: extra letters would be
insertions, which cost.)

Rows are sorted by conversation and turn, and tasks stream them.  A
conversation of more than ``long_rows`` rows is not given to one task: its
rows are dealt by ranges of turns, each segment is solved from every state it
may begin in, a fold over the segments chooses the cheapest chain, and the
edits are applied by segment.  Only the digest of such a conversation, SHA-256
over its whole text, has to follow one row after the other.

Faults, the first that holds: blank (no character but white space), duplicate
(role and text as in an earlier row), truncated (the last character that is
no white space is none of `.!?`).  Keep costs 0, Rerole 2, Delete 3 (required
for the first two), Insert of an empty row 2, and a truncated row that stays 1.

Defined results: a null role or text is one space; rows of a null
conversation id are one conversation; null turns come first; rows of one turn
are taken by role and text, so equal rows are neighbours; a conversation
without rows has no edits; the empty table gives an empty result; very long
texts are carried whole; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections import deque
from collections.abc import Callable, Iterator
from functools import cmp_to_key
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import SPACES, small_batches
from corpusmill.operators.neardup import salted_join_sides
from corpusmill.session import reliable_checkpoint

#: A conversation of more rows is dealt to many tasks.
LONG_ROWS = 20_000
#: A (role, text) of one conversation that stands at more turns is salted in its join.
HOT_ROWS = 20_000
#: Characters of text in one row of a segment.
CHUNK_CHARS = 1_000_000

# The faults, the states, and what an edit costs.
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
START, S, U, A = range(4)
RENAME_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
LEGAL_NEIGHBOURS = ("su", "ua", "au")

#: The state that a user or an assistant row leads to from each state.
AFTER_USER = {START: U, S: U, A: U}
AFTER_ASSISTANT = {U: A}
KEEPS = {"s": {START: S}, "u": AFTER_USER, "a": AFTER_ASSISTANT}
MOVES = AFTER_USER | AFTER_ASSISTANT
#: What a path at these states can save over one at A: keeping one s row rather than deleting it.
LEADS = {START: DELETE_COST, S: 0}


class Edit:
    """A node of the backpointer tree: an edit after all those before it."""

    __slots__ = ("before", "letter", "depth", "next", "held")

    def __init__(self, before: "Edit | None", letter: str):
        self.before, self.letter, self.next, self.held = before, letter, [], 0
        self.depth = 0
        if before is not None:
            self.depth = before.depth + 1
            before.next.append(self)

    def release(self) -> None:
        """Forget the node, and the ones before it that led only here."""
        node = self
        while node is not None and not node.next and not node.held and node.before is not None:
            before, node.before = node.before, None
            before.next.remove(node)
            node = before


def comes_first(a: Edit, b: Edit) -> bool:
    """Whether the letters up to ``a`` are less than those up to ``b``."""
    x = y = ""
    while a is not b:
        if a.depth >= b.depth:
            x, a = a.letter, a.before
        else:
            y, b = b.letter, b.before
    return x < y


class Survivors:
    """The best path to each state over the rows so far."""

    def __init__(self, start: int = START, first: bool = True):
        self.root = Edit(None, "")
        self.root.held = 1
        self.best: dict[int, tuple[int, Edit]] = {start: (0, self.root)}
        if first:
            self._choose(self._inserted(self.best))

    def _inserted(self, base: dict[int, tuple[int, Edit]]) -> list[tuple[int, int, Edit]]:
        """(state, cost, edit) of each base path, and of it with one or two rows put in behind it."""
        out = []
        for state, (cost, edit) in base.items():
            out.append((state, cost, edit))
            for _ in range(2):
                state, cost, edit = MOVES[state], cost + INSERT_COST, Edit(edit, "I")
                out.append((state, cost, edit))
        return out

    @staticmethod
    def _least(found: list[tuple[int, int, Edit]]) -> dict[int, tuple[int, Edit]]:
        best: dict[int, tuple[int, Edit]] = {}
        for state, cost, edit in found:
            held = best.get(state)
            if held is None or cost < held[0] or (cost == held[0] and edit is not held[1] and comes_first(edit, held[1])):
                best[state] = (cost, edit)
        return best

    def _choose(self, found: list[tuple[int, int, Edit]], more: tuple = ()) -> None:
        last, self.best = self.best, self._least(found)
        if A in self.best:  # what follows costs from A at most so much more, so these can't win any more
            most = self.best[A][0]
            self.best = {s: v for s, v in self.best.items() if v[0] <= most + LEADS.get(s, v[0])}
        for _, edit in self.best.values():
            edit.held += 1
        for _, edit in last.values():
            edit.held -= 1
        for edit in [e for _, _, e in found] + [e for _, e in last.values()] + [e for _, _, e in more]:
            edit.release()

    def row(self, initial: str, fault: int) -> str:
        """Take a row in; the letters that are settled by it."""
        found = []
        keeps = KEEPS.get(initial, {})
        for state, (cost, edit) in self.best.items():
            found.append((state, cost + DELETE_COST, Edit(edit, "D")))
            if fault in (BLANK, DUPLICATE):
                continue
            cost += TRUNCATED_COST if fault == TRUNCATED else 0
            if state in keeps:
                found.append((keeps[state], cost, Edit(edit, "K")))
            found.append((MOVES[state], cost + RENAME_COST, Edit(edit, "R")))
        self._choose(self._inserted(self._least(found)), tuple(found))
        return self.settled()

    def settled(self) -> str:
        out = []
        while len(self.root.next) == 1 and not self.root.held:
            self.root = self.root.next[0]
            self.root.before = None
            out.append(self.root.letter)
        return "".join(out)

    def open(self, edit: Edit) -> str:
        """The letters of a path that are not settled yet."""
        out = []
        while edit is not self.root:
            out.append(edit.letter)
            edit = edit.before
        return "".join(reversed(out))

    def ends(self) -> dict[int, tuple[int, str]]:
        """State -> (cost, open letters)."""
        return {state: (cost, self.open(edit)) for state, (cost, edit) in self.best.items()}

    def finish(self) -> tuple[int, str]:
        """Cost and open letters of the best path that ends in a whole structure."""
        return min(v for state, v in self.ends().items() if state in (START, A))


class Writer:
    """Applies settled edits to rows in order: yields (edit, role, text) of each; role and text of a deleted row are its own."""

    def __init__(self, state: int = START):
        self.state = state
        self.rows: deque[tuple[str, str]] = deque()

    def apply(self, letters: str) -> Iterator[tuple[str, str, str]]:
        for letter in letters:
            role, text = ("", "") if letter == "I" else self.rows.popleft()
            if letter in "IR":
                self.state = MOVES[self.state]
                role = "user" if self.state == U else "assistant"
            elif letter == "K":
                self.state = KEEPS[role[:1]][self.state]
            yield letter, role, text


def first_fault(text: str, seen: bool) -> int:
    said = text.rstrip(SPACES)
    return BLANK if not said else DUPLICATE if seen else NONE if said[-1] in ".!?" else TRUNCATED


class Tally:
    """Counts over a stretch of a conversation's rows in order."""

    def __init__(self):
        self.faults = [0] * 4
        self.illegal = self.turns = 0
        self.first_role = self.last_role = self.first_turn = self.last_turn = None

    def add(self, turn: int | None, role: str, fault: int) -> None:
        self.faults[fault] += 1
        if self.last_role is None:
            self.first_role = role[:1]
        else:
            self.illegal += self.last_role + role[:1] not in LEGAL_NEIGHBOURS
        self.last_role = role[:1]
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def join(self, other: "Tally") -> None:
        """Add the stretch that follows."""
        self.faults = [a + b for a, b in zip(self.faults, other.faults)]
        self.illegal += other.illegal
        if self.last_role is None:
            self.first_role = other.first_role
        elif other.first_role is not None:
            self.illegal += self.last_role + other.first_role not in LEGAL_NEIGHBOURS
        self.last_role = other.last_role if other.last_role is not None else self.last_role
        if other.first_turn is not None:
            self.turns += other.turns - (other.first_turn == self.last_turn)
            self.first_turn = other.first_turn if self.first_turn is None else self.first_turn
            self.last_turn = other.last_turn

    def counts(self) -> dict[str, int]:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return {"gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE],
                "truncated": self.faults[TRUNCATED], "illegal": self.illegal}


def marked_rows(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", copies_col: str | None = None) -> DataFrame:
    """Distinct rows (key, turn, role, text) with how often they stand there and whether an earlier
    turn of the conversation has the same role and text; written, as several jobs read it."""
    small_batches(rows.sparkSession)
    one_space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    distinct = (rows.select(conversation_key(conv_col).alias("key"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                            one_space(role_col).alias("role"), one_space(text_col).alias("text"),
                            (F.col(f"`{copies_col}`") if copies_col else F.lit(1)).cast("long").alias("times"))
                .groupBy("key", "turn", "role", "text").agg(F.sum("times").alias("times")))
    distinct = reliable_checkpoint(distinct)
    # of a null turn or, if there is none, the least one, the row is the first of its kind
    again = (distinct.groupBy("key", "role", "text")
             .agg(F.min("turn").alias("_least"), F.max(F.col("turn").isNull()).alias("_null"), F.count(F.lit(1)).alias("_n"))
             .where("_n > 1"))
    hot = again.where(F.col("_n") > HOT_ROWS).select(
        "key", "role", "text", F.ceil(F.col("_n") / F.lit(HOT_ROWS)).cast("int").alias("_salts"))
    big, small, keys = salted_join_sides(distinct, again, ["key", "role", "text"], hot, "turn")
    seen = F.col("_n").isNotNull() & F.when(F.col("_null"), F.col("turn").isNotNull()).otherwise(
        F.col("turn") > F.col("_least"))
    return big.join(small, keys, "left").select("key", "turn", "role", "text", "times", seen.alias("seen"))


def conversation_key(conv_col: str):
    """A text that stands for a conversation id, the null id included."""
    c = F.col(f"`{conv_col}`")
    return F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit(":"), c.cast("string")))


def in_order(rows: DataFrame) -> list:
    return [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def conversations_of(batches) -> Iterator[tuple[str, Iterator[tuple]]]:
    """(key, rows (turn, role, text, fault)) of sorted batches; repeated rows come one by one."""
    def rows():
        for b in batches:
            yield from zip(*[b.column(c).to_pylist() for c in ("key", "turn", "role", "text", "times", "seen")])

    def single(group):
        for _, turn, role, text, times, seen in group:
            for k in range(times):
                yield turn, role, text, first_fault(text, seen or k > 0)

    for key, group in groupby(rows(), key=lambda r: r[0]):
        yield key, single(group)


SUMMARY = ("key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")
EDITS = "key string, place long, edit string, role string, text string"


ARROW = {"long": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string())}


def batched(rows: Iterator[tuple], columns: str, weigh: Callable[[tuple], int] = lambda r: 1,
            most: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of rows whose weights come to about ``most``."""
    schema = pa.schema([(name, ARROW[kind]) for name, kind in map(str.split, columns.split(", "))])
    held, weight = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for r in rows:
        held.append(r)
        weight += weigh(r)
        if len(held) >= 10_000 or weight >= most:
            yield batch()
            held, weight = [], 0
    if held:
        yield batch()


def edited(rows: Iterator[tuple], tally: Tally) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of a whole conversation as they are settled; returns the cost."""
    best, writer = Survivors(), Writer()
    for turn, role, text, fault in rows:
        tally.add(turn, role, fault)
        writer.rows.append((role, text))
        yield from writer.apply(best.row(role[:1], fault))
    cost, rest = best.finish()
    yield from writer.apply(rest)
    return cost


class Digest:
    """SHA-256 of repaired rows, and the letters."""

    def __init__(self):
        self.sha, self.letters, self.any = hashlib.sha256(), [], False

    def add(self, letter: str, role: str, text: str) -> None:
        self.letters.append(letter)
        if letter != "D":
            self.sha.update((("\n" if self.any else "") + f"{role}:{text}").encode())
            self.any = True


def summarise(batches):
    def one():
        for key, rows in conversations_of(batches):
            tally, digest = Tally(), Digest()
            steps = edited(rows, tally)
            while True:
                try:
                    digest.add(*next(steps))
                except StopIteration as end:
                    cost = end.value
                    break
            yield (key, *tally.counts().values(), cost, "".join(digest.letters), digest.sha.hexdigest())

    yield from batched(one(), SUMMARY)


def list_edits(batches):
    def one():
        for key, rows in conversations_of(batches):
            for place, (edit, role, text) in enumerate(edited(rows, Tally())):
                yield key, place, edit, role, text

    yield from batched(one(), EDITS, lambda r: len(r[4]), 4_000_000)


# --- conversations that many tasks share ----------------------------------------

CHUNK = "key string, part long, chunk long, roles array<string>, texts array<string>, ends string, tally string"
DONE = "key string, part long, chunk long, place long, edits string, roles array<string>, texts array<string>"
DIGESTS = "key string, audit string, repaired_sha256 string"
TALLY = ("faults", "illegal", "turns", "first_role", "last_role", "first_turn", "last_turn")


def cut(batches):
    """Rows of a segment in chunks, and a last row with its tally and, for each state it may begin in, its ends."""
    part = TaskContext.get().partitionId()

    def one():
        for key, rows in conversations_of(batches):
            tally, chunk, roles, texts, size = Tally(), 0, [], [], 0
            # the first segment begins before all rows, others behind a row, in any state
            runs = {s: (Survivors(s, False), []) for s in (START, S, U, A)} | {-1: (Survivors(), [])}
            for turn, role, text, fault in rows:
                tally.add(turn, role, fault)
                for best, letters in runs.values():
                    letters.append(best.row(role[:1], fault))
                roles.append(role)
                texts.append(text)
                size += len(text) + 16
                if size >= CHUNK_CHARS:
                    yield key, part, chunk, roles, texts, None, None
                    chunk, roles, texts, size = chunk + 1, [], [], 0
            ends = [(start, state, cost, "".join(letters) + tail)
                    for start, (best, letters) in runs.items() for state, (cost, tail) in best.ends().items()]
            yield key, part, chunk, roles, texts, json.dumps(ends), json.dumps([getattr(tally, f) for f in TALLY])

    yield from batched(one(), CHUNK, most=4)


def cheaper(a: tuple[int, list], b: tuple[int, list]) -> bool:
    """Whether a chain costs less than another, or as much and its letters come first."""
    if a[0] != b[0]:
        return a[0] < b[0]
    return "".join(letters for _, _, letters in a[1]) < "".join(letters for _, _, letters in b[1])


def chain(key, segments: pd.DataFrame) -> pd.DataFrame:
    """The cheapest chain of segment ends of one conversation: each segment's first state, letters and place.
    Its input is what the segments put out: 20 strings with a letter for each of its rows."""
    segments = segments.sort_values("part")
    total = Tally()
    best: dict[int, tuple[int, list]] = {-1: (0, [])}
    for part, ends, told in zip(segments["part"], segments["ends"], segments["tally"]):
        tally = Tally()
        for name, value in zip(TALLY, json.loads(told)):
            setattr(tally, name, value)
        total.join(tally)
        after: dict[int, tuple[int, list]] = {}
        for start, state, cost, letters in json.loads(ends):
            if start in best:
                before, way = best[start]
                found = (before + cost, [*way, (int(part), START if start < 0 else start, letters)])
                if state not in after or cheaper(found, after[state]):
                    after[state] = found
        best = after
    cost, way = min((v for state, v in best.items() if state in (START, A)), key=cmp_to_key(
        lambda a, b: -1 if cheaper(a, b) else 1))
    out = pd.DataFrame(way, columns=["part", "state", "letters"])
    out["place"] = out["letters"].str.len().cumsum() - out["letters"].str.len()
    return out.assign(key=key[0], cost=cost, **total.counts())


CHAIN = ("part long, state long, letters string, place long, key string, cost long, gaps long, blank long, duplicate long, "
         "truncated long, illegal long")


def apply_chunks(batches):
    """(key, part, chunk, place, edits, roles, texts): the chunks with their edits; a segment's row of
    letters comes before its chunks."""
    def one():
        writer, letters, at, place = Writer(), "", 0, 0
        for b in batches:
            for r in b.to_pylist():
                if r["chunk"] < 0:
                    writer, letters, at, place = Writer(r["state"]), r["letters"], 0, r["place"]
                    continue
                writer.rows.extend(zip(r["roles"], r["texts"]))
                left, stop = len(r["roles"]), at
                while left or (stop < len(letters) and letters[stop] == "I"):
                    left -= letters[stop] != "I"
                    stop += 1
                done = list(writer.apply(letters[at:stop]))
                yield (r["key"], r["part"], r["chunk"], place + at, letters[at:stop],
                       [x for _, x, _ in done], [x for _, _, x in done])
                at = stop

    yield from batched(one(), DONE, most=4)


def digest_chunks(batches):
    def one():
        rows = (r for b in batches for r in b.to_pylist())
        for key, group in groupby(rows, key=lambda r: r["key"]):
            digest = Digest()
            for r in group:
                for step in zip(r["edits"], r["roles"], r["texts"]):
                    digest.add(*step)
            yield key, "".join(digest.letters), digest.sha.hexdigest()

    yield from batched(one(), DIGESTS)


def long_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edited chunks, and the chain of segments, of conversations of any length."""
    cut_rows = reliable_checkpoint(
        rows.repartitionByRange(*in_order(rows)).sortWithinPartitions(*in_order(rows)).mapInArrow(cut, CHUNK))
    chains = reliable_checkpoint(
        cut_rows.where(F.col("ends").isNotNull()).select("key", "part", "ends", "tally")
        .groupBy("key").applyInPandas(chain, CHAIN))
    nothing = F.array().cast("array<string>")
    texts = cut_rows.select("key", "part", "chunk", "roles", "texts", F.lit(0).cast("long").alias("state"),
                            F.lit("").alias("letters"), F.lit(0).cast("long").alias("place"))
    told = chains.select("key", "part", F.lit(-1).cast("long").alias("chunk"), nothing.alias("roles"), nothing.alias("texts"),
                         "state", "letters", "place")
    done = (texts.unionByName(told).repartition("key", "part").sortWithinPartitions("key", "part", "chunk")
            .mapInArrow(apply_chunks, DONE))
    return done, chains


def parts(rows: DataFrame, long_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of conversations that one task streams, sorted; and rows of longer ones, if there are any."""
    long = rows.groupBy("key").agg(F.sum("times").alias("n")).where(F.col("n") > long_rows).select("key")
    long = reliable_checkpoint(long)
    many = long.count() > 0
    short = rows.join(long, "key", "left_anti") if many else rows
    short = short.repartition("key").sortWithinPartitions(*in_order(rows))
    return short, rows.join(long, "key", "left_semi") if many else None


def audits(rows: DataFrame, long_rows: int = LONG_ROWS) -> DataFrame:
    """One row for each conversation of ``marked_rows``: fault counts, cost, the edits' letters and the digest of the
    repaired rows."""
    short, long = parts(rows, long_rows)
    out = short.mapInArrow(summarise, SUMMARY)
    if long is None:
        return out
    done, chains = long_conversations(long)
    counts = chains.groupBy("key").agg(*[F.first(c).alias(c) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")])
    digests = (done.select("key", "part", "chunk", "edits", "roles", "texts").repartition("key")
               .sortWithinPartitions("key", "part", "chunk").mapInArrow(digest_chunks, DIGESTS))
    return out.unionByName(counts.join(digests, "key"))


def edits(rows: DataFrame, long_rows: int = LONG_ROWS) -> DataFrame:
    """(key, place, edit, role, text): all edits of each conversation in order; the rows whose edit is
    not D are the repaired conversation."""
    short, long = parts(rows, long_rows)
    out = short.mapInArrow(list_edits, EDITS)
    if long is None:
        return out
    done, _ = long_conversations(long)
    steps = F.arrays_zip(F.split("edits", "").alias("edit"), F.col("roles").alias("role"), F.col("texts").alias("text"))
    return out.unionByName(
        done.select("key", "place", F.posexplode(steps).alias("k", "step")).where(F.col("step.role").isNotNull())
        .select("key", (F.col("place") + F.col("k")).alias("place"), "step.edit", "step.role", "step.text"))


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", long_rows: int = LONG_ROWS) -> DataFrame:
    """(conv_id, place, edit, role, text) of a table of conversations; without the rows whose
    edit is D it is the repaired table."""
    ids = conversations.select(F.col(f"`{conv_col}`").alias(conv_col)).distinct().withColumn("key", conversation_key(conv_col))
    found = edits(marked_rows(conversations, conv_col, turn_col, role_col, text_col), long_rows)
    return ids.join(found, "key").select(conv_col, "place", "edit", "role", "text")


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage by crc32 of `conv_id:turn`: (conv_id, turn, role, text, copies)."""
    one_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(one_space("conv_id"), F.lit(":"), one_space("turn")).cast("binary")) % 20
    text = (F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(one_space("text"), "[.!?]", ""))
            .otherwise(one_space("text")))
    return conversations.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(one_space("role")).alias("role"),
        text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("copies"))


def report(conversations: DataFrame, long_rows: int = LONG_ROWS) -> DataFrame:
    """The contract's columns of a conversations table."""
    ids = conversations.select("conv_id").distinct().withColumn("key", conversation_key("conv_id"))
    found = audits(marked_rows(damage(conversations), copies_col="copies"), long_rows)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(found, "key", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
