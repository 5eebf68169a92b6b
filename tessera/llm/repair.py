"""Conversation structure repair by cost layers of grammar states.

A conversation is sound when its roles read `(s?(ua)+)?`. That grammar has four states: nothing yet,
after the system turn, after a user turn, after an assistant turn. For each place between turns one
machine word holds layers of four bits: bit 4 c + q says that from state q the rest of the
conversation can be made sound for at most c more than the cheapest state needs (a bit-parallel
search with errors, as Wu and Manber's agrep, with the grammar in place of the pattern). Reading a
turn backwards is a few masks: keeping is a shift between states, changing the role or deleting moves
the bits up by the layers they cost. The first layer that holds the start is the cost; walking
forwards by the bits, and taking the least letter that stays on a cheapest way, gives the least audit.

No state needs over twelve more than the cheapest: after a user turn one insertion (5) closes the pair,
after an assistant turn one (5) opens it, the start can do what the other states can, and a system
turn that only the start could keep is deleted for 2. So sixteen layers, one word of 64 bits, are
enough for a conversation of any length, and nothing falls off the top.

Damage and faults are columns. Rows meet by conversation in order of turn (nulls first, then role and
text) and stream through a task: texts wait in memory, beyond 8 MB in a file of the shared folder, one
byte of flags a turn stays. Words are kept once every 65,536 turns and made again block by block on
the way forward. So memory grows with a conversation by two bytes a turn, flags and the audit, which
is one string by contract; its digest is of one text, which no two tasks can share.

Defined results: null conv_id, turn, role and text read as one space in the damage key, a null role
or text is one space, and rows without conv_id are one conversation. Rows of equal turn go by role and
text. A turn's number is compared as a number; gaps beyond a long stay at the largest long. Roles
count by their first letter, which is case-sensitive; a role of another letter can only be changed or
deleted. Extra columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import io
import struct
import uuid
from array import array

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.files import resolve
from tessera.session import new_folder, ship_package

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANK = " \t\n\x0b\f\r"
START, SYSTEM, USER, ASSISTANT = range(4)
LAYERS = 16
#: Where an initial leads from each state; None where it may not stand.
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_ALL = (1 << 4 * LAYERS) - 1
_EACH = sum(1 << 4 * c for c in range(LAYERS))
BLOCK, SPOOL, BATCH = 65_536, 8 << 20, 2_000


def step(word: int, moves: dict[int, int]) -> int:
    """States from which one of the moves leads into the word, in every layer at once."""
    out = 0
    for source, target in moves.items():
        out |= (word >> target & _EACH) << source
    return out


#: One insertion or one changed role: from every state but none into nothing.
TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}


def with_insertions(word: int) -> int:
    """Insertions before a place; two open and close a pair, more never help."""
    for _ in range(2):
        word |= step(word, TURN) << 4 * INSERT & _ALL
    return word


def settled(word: int) -> tuple[int, int]:
    """(word without its empty low layers, their number, two at most); the layers that come in at the
    top hold every state."""
    low = ((word & -word).bit_length() - 1) // 4
    return word >> 4 * low | _ALL ^ _ALL >> 4 * low, low


@functools.lru_cache(1 << 16)
def before(word: int, initial: str, faulty: bool, truncated: bool) -> tuple[int, int]:
    """(word before a turn from the word after it, layers by which its base rises). Insertions after
    the turn are already in `word`; those before it are added."""
    out = word << 4 * DELETE & _ALL
    if not faulty:
        extra = TRUNCATED if truncated else 0
        out |= step(word, NEXT.get(initial, {})) << 4 * (KEEP + extra) & _ALL
        out |= step(word, TURN) << 4 * (REROLE + extra) & _ALL
    for c in range(1, LAYERS):  # at most c: a layer holds what the lower ones hold
        out |= (out >> 4 * (c - 1) & 15) << 4 * c
    return settled(with_insertions(out))


def accepting() -> int:
    """The word after the last turn: nothing or an assistant turn, in all layers."""
    return with_insertions(_EACH << START | _EACH << ASSISTANT)


def layer(word: int, state: int) -> int:
    """The first layer that holds the state."""
    mine = word >> state & _EACH
    return ((mine & -mine).bit_length() - 1) // 4


def choices(initial: str, faulty: bool, truncated: bool, state: int):
    """(letter, cost, next state, whether the turn is read) in order of the letters."""
    yield "D", DELETE, state, True
    yield "I", INSERT, TURN[state], False
    if not faulty:
        extra = TRUNCATED if truncated else 0
        target = NEXT.get(initial, {}).get(state)
        if target is not None:
            yield "K", KEEP + extra, target, True
        yield "R", REROLE + extra, TURN[state], True


class Turns:
    """The turns of one conversation as they come: a byte of flags a turn, and role and text, which go
    to a file of the shared folder beyond SPOOL bytes."""

    INITIALS = ("s", "u", "a", "")

    def __init__(self, folder: str | None = None):
        self.folder, self.flags, self.texts, self.path, self.stream = folder, bytearray(), io.BytesIO(), None, None

    def add(self, role: bytes, text: bytes, initial: str, faulty: bool, truncated: bool) -> None:
        self.flags.append(self.INITIALS.index(initial if initial in "sua" else "") | faulty << 2 | truncated << 3)
        for part in (struct.pack("<QQ", len(role), len(text)), role, text):
            self.texts.write(part)
        if self.folder and self.texts.tell() > SPOOL:
            if self.stream is None:
                system, self.path = resolve(f"{self.folder}/{uuid.uuid4().hex}")
                system.create_dir(self.path.rpartition("/")[0], recursive=True)
                self.stream = system.open_output_stream(self.path)
            self.stream.write(self.texts.getvalue())
            self.texts = io.BytesIO()

    def block(self, i: int) -> list[tuple[str, bool, bool]]:
        return [(self.INITIALS[b & 3], bool(b & 4), bool(b & 8)) for b in self.flags[i * BLOCK : (i + 1) * BLOCK]]

    def read(self):
        """(role, text) from the first turn on."""
        for source in self._sources():
            while head := source.read(16):
                role, text = struct.unpack("<QQ", head)
                yield source.read(role), source.read(text)

    def _sources(self):
        if self.stream is not None:
            self.stream.close()
            with resolve(f"{self.folder}/{self.path.rpartition('/')[2]}")[0].open_input_file(self.path) as f:
                yield f
        self.texts.seek(0)
        yield self.texts

    def close(self) -> None:
        if self.stream is not None:
            resolve(f"{self.folder}/")[0].delete_file(self.path)


def repaired(turns: Turns) -> tuple[int, str, str]:
    """(cost, least audit, digest of the repaired conversation)."""
    word, base, ends = accepting(), 0, {}
    blocks = (len(turns.flags) + BLOCK - 1) // BLOCK
    for b in range(blocks - 1, -1, -1):
        ends[b] = word, base
        for turn in reversed(turns.block(b)):
            word, up = before(word, *turn)
            base += up
    cost = left = base + layer(word, START)
    digest, audit, state, first, texts = hashlib.sha256(), bytearray(), START, True, turns.read()

    def put(role: bytes, text: bytes) -> None:
        nonlocal first
        digest.update((b"" if first else b"\n") + role + b":" + text)
        first = False

    for b in range(blocks + 1):
        flags = turns.block(b) if b < blocks else []
        word, base = ends[b] if b < blocks else (accepting(), 0)
        words, bases = array("Q", [word]), array("q", [base])
        for turn in reversed(flags):
            word, up = before(word, *turn)
            base += up
            words.append(word)
            bases.append(base)
        words.reverse()
        bases.reverse()
        at = 0
        while at < len(flags) or (b == blocks and left):
            turn = flags[at] if at < len(flags) else ("", False, False)
            for letter, price, target, read in choices(*turn, state):
                if read and at == len(flags):
                    continue
                if price <= left and bases[at + read] + layer(words[at + read], target) == left - price:
                    break
            else:
                raise AssertionError("no edit stays on a cheapest way")
            role, text = next(texts) if read else (b"", b"")
            if letter in "IR":
                put(b"user" if target == USER else b"assistant", text)
            elif letter == "K":
                put(role, text)
            audit += letter.encode()
            left, state, at = left - price, target, at + read
    return cost, audit.decode(), digest.hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """The rows (c, turn, role, text) after damage; a dropped row stays as one with `dropped` set and
    nothing in it, so that its conversation is known."""
    key = F.concat(F.coalesce(F.col("c").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.withColumn("harm", F.crc32(key.cast("binary")) % 20).withColumn("role", F.coalesce("role", F.lit(" "))).withColumn("text", F.coalesce("text", F.lit(" ")))
    harm, text = F.col("harm"), F.col("text")
    dropped = harm == 0
    rows = rows.select(
        "c",
        F.when(~dropped, F.col("turn")).alias("turn"),
        F.when(~dropped, F.when(harm == 4, "user").otherwise(F.col("role"))).alias("role"),
        F.when(~dropped, F.when(harm == 1, "").when(harm == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)).alias("text"),
        dropped.alias("dropped"),
        F.when(harm == 3, 2).otherwise(1).alias("times"),
    )
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times")


def faults(rows: DataFrame) -> DataFrame:
    """Adds blank, truncated and seen (role and text stood earlier in the conversation; equal turns by
    role and text, and of copies the later ones)."""
    content = F.rtrim(F.col("text"), F.lit(BLANK))
    earlier = Window.partitionBy("c", "role", F.md5(F.encode("text", "utf-8")), "dropped").orderBy(F.col("turn").asc_nulls_first(), "copy")
    last: Column = F.right(content, F.lit(1))
    return rows.select("*", (content == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"), (F.row_number().over(earlier) > 1).alias("seen"))


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


class _Conversation:
    """One conversation of the stream."""

    def __init__(self, folder: str):
        self.turns, self.counts = Turns(folder), {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.least = self.most = self.last = None
        self.distinct, self.previous = 0, None

    def add(self, turn, role, text, dropped, blank, truncated, seen) -> None:
        if dropped:
            return
        if turn is not None and turn != self.last:
            self.least = turn if self.least is None else self.least
            self.most = self.last = turn
            self.distinct += 1
        fault = "blank" if blank else "duplicate" if seen else "truncated" if truncated else None
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.previous is not None and self.previous + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.previous = initial
        self.turns.add(role.encode(), text.encode(), initial, fault in ("blank", "duplicate"), fault == "truncated")

    def result(self) -> dict:
        gaps = 0 if self.least is None else min(self.most - self.least + 1 - self.distinct, (1 << 63) - 1)
        cost, audit, digest = repaired(self.turns)
        self.turns.close()
        return {"gaps": gaps, **self.counts, "cost": cost, "audit": audit, "repaired_sha256": digest}


def repair(conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", harm: bool = True) -> DataFrame:
    """One row for each conversation: its key, gaps, blank, duplicate, truncated, illegal, cost, audit
    and repaired_sha256. With `harm` the rows are damaged first by the rule of `damaged`."""
    spark = conversations.sparkSession
    ship_package(spark)
    rows = conversations.select(F.col(conversation).alias("c"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    if harm:
        rows = damaged(rows)
    else:
        rows = rows.select("c", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.lit(False).alias("dropped"), F.lit(1).alias("copy"))
    kind = rows.schema["c"].dataType
    rows = faults(rows).repartition("c").sortWithinPartitions("c", F.col("turn").asc_nulls_first(), "role", "text", "copy")
    folder = new_folder(spark, "conversations")
    names = ["turn", "role", "text", "dropped", "blank", "truncated", "seen"]

    def run(batches):
        out_type = held = None
        current, rows, begun = None, [], False
        done = lambda: pa.RecordBatch.from_pydict({"c": pa.array([r.pop("c") for r in rows], out_type)} | {f: [r[f] for r in rows] for f in _FIELDS}, schema=pa.schema([("c", out_type)] + [(f, pa.string() if f in ("audit", "repaired_sha256") else pa.int64()) for f in _FIELDS]))
        for batch in batches:
            out_type = batch.schema.field("c").type
            for c, *row in zip(*[batch.column(k).to_pylist() for k in ["c", *names]], strict=True):
                if not begun or c != current:
                    if begun:
                        rows.append({"c": current, **held.result()})
                        if len(rows) >= BATCH or len(rows[-1]["audit"]) > 1 << 20:
                            yield done()
                            rows = []
                    current, held, begun = c, _Conversation(folder), True
                held.add(*row)
        if begun:
            rows.append({"c": current, **held.result()})
            yield done()

    return rows.select("c", *names).mapInArrow(run, f"c {kind.simpleString()}, {RESULT}").withColumnRenamed("c", conversation)
