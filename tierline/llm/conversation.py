"""Repair of conversation structure by rank-convergence parallel Viterbi.

A conversation's rows, by turn, should read `(s?(ua)+)?` in the initials of their roles. Each row is kept (0), given
the role user or assistant (1) or deleted (2; required for blank rows and repetitions), empty rows of these
roles may be inserted anywhere (5), and a row that breaks off costs 5 more unless it is deleted. Which edits are
cheapest is a shortest path through four states (nothing yet, after system, after user, after assistant): going
backward, a row maps the vector of the states' costs-to-go to another one, linearly in (min, +).

* Rows are range-sorted by conversation and turn, however many one conversation has. A conversation that lies
  inside one partition and is not long is solved there at once.
* All others, those that a cut may go through and long ones, are laid out as pieces of bounded size. Equal rows
  are looked for inside a piece, then among the digests of all pieces of a conversation.
* Every piece is solved backward from a speculative vector. Then passes follow: a piece whose successor's vector,
  less a constant, differs from the one it started from is run again from there, beside its old run, until the two
  vectors differ only by a constant; the rest of the old run then holds. Passes end when nothing changed. Pieces that are
  still open after `passes` rounds (a stretch in which deleting everything is cheapest passes every difference on)
  get their start from the pieces' transfer matrices, multiplied along the conversation.
* Costs-to-go known, all four states are traced forward in each piece, the states are stitched along the
  conversation, and each piece writes its part of the audit: at every place the ASCII-least letter that the
  costs-to-go allow. (A letter settles the next state, and equally dear audits are never prefixes of each other, so this gives the least audit.)
* Parts are put together by a task that streams them in order; it holds one batch of parts, and of a conversation
  only its audit and the state of its hash.

Defined cases: null ids make one conversation; a null role or text counts as one space, a null turn comes first and does not
count in `gaps`; rows of one turn go by role, then by a hash of the text; equal rows are repetitions of the first;
empty and very long texts are whole; a conversation without rows has zeros, an empty audit and the hash of the empty string; further columns are not looked at;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.session import materialize

#: Rows and bytes of text of one piece.
PIECE_ROWS, PIECE_BYTES = 4096, 1 << 20
#: Passes before the pieces that are still open are settled by transfer matrices.
PASSES = 4
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
#: Role initials; every other initial is 3.
CLASSES = {"s": 0, "u": 1, "a": 2}
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: The state after a row of each class, by state (-1: not allowed): nothing yet, after system, after user, after assistant.
NEXT = ((1, 2, -1, -1), (-1, 2, -1, -1), (-1, -1, 3, -1), (-1, 2, -1, -1))
#: The state after an inserted or renamed row, which has the only role that fits.
OTHER = (2, 2, 3, 2)
RENAME, DELETE, INSERT, BROKEN = 1, 2, 5, 5
#: Costs to go at the end of a conversation.
END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 40


def costs(after: tuple, code: int, kind: int) -> list[int]:
    """Costs to go before a row, from those after it."""
    out = [DELETE + x for x in after]
    if code < BLANK:
        extra = BROKEN if code == TRUNCATED else 0
        for s in range(4):
            out[s] = min(out[s], RENAME + extra + after[OTHER[s]])
            if NEXT[s][kind] >= 0:
                out[s] = min(out[s], extra + after[NEXT[s][kind]])
        for _ in range(2):
            out = [min(out[s], INSERT + out[OTHER[s]]) for s in range(4)]
    return out


@lru_cache(None)
def back(after: tuple, code: int, kind: int) -> tuple:
    """The same, less a constant. The differences are small, so there are few different vectors."""
    out = costs(after, code, kind)
    least = min(out)
    return tuple(x - least for x in out)


@lru_cache(None)
def edit(after: tuple, code: int, kind: int, state: int) -> tuple[str, int, int]:
    """The least letters for a row in a state, the next state and what they cost."""
    before, letters, cost = costs(after, code, kind), "", 0
    extra = BROKEN if code == TRUNCATED else 0
    while True:
        if DELETE + after[state] == before[state]:
            return letters + "D", state, cost + DELETE
        if INSERT + before[OTHER[state]] == before[state]:
            letters, state, cost = letters + "I", OTHER[state], cost + INSERT
        elif NEXT[state][kind] >= 0 and extra + after[NEXT[state][kind]] == before[state]:
            return letters + "K", NEXT[state][kind], cost + extra
        else:
            return letters + "R", OTHER[state], cost + RENAME + extra


def backward(codes: bytes, kinds: bytes, end: tuple) -> list[tuple]:
    """The vector after each row, from the last one to the first, and before the first."""
    out = [end]
    for i in range(len(codes) - 1, -1, -1):
        out.append(back(out[-1], codes[i], kinds[i]))
    return out


def forward(codes: bytes, kinds: bytes, vectors: list[tuple], state: int) -> tuple[list[str], int, int]:
    """Letters of each row, the last state, and the cost."""
    letters, cost, n = [], 0, len(codes)
    for i in range(n):
        found, state, dear = edit(vectors[n - 1 - i], codes[i], kinds[i], state)
        letters.append(found)
        cost += dear
    return letters, state, cost


def run_again(codes: bytes, kinds: bytes, old_end: tuple, old: tuple, end: tuple) -> tuple:
    """The vector before the first row, given that of a run from another end."""
    for i in range(len(codes) - 1, -1, -1):
        if end == old_end:
            return old
        old_end, end = back(old_end, codes[i], kinds[i]), back(end, codes[i], kinds[i])
    return end


def transfer(codes: bytes, kinds: bytes) -> list[int]:
    """What a piece makes of each unit vector: 16 numbers."""
    out = []
    for s in range(4):
        v = tuple(0 if x == s else FAR for x in range(4))
        for i in range(len(codes) - 1, -1, -1):
            v = tuple(min(x, FAR) for x in costs(v, codes[i], kinds[i]))
        out += v
    return out


def written(letters: list[str], roles, texts, state: int) -> list[str]:
    """The rows that the letters leave, as `role:text`."""
    out = []
    for some, role, text in zip(letters, roles, texts):
        for x in some:
            if x == "D":
                continue
            if x == "K":
                state = NEXT[state][CLASSES[role[:1]]]
                out.append(f"{role}:{text}")
            else:
                state = OTHER[state]
                out.append(("user:" if state == 2 else "assistant:") + (text if x == "R" else ""))
    return out


def closing(state: int) -> tuple[str, list[str]]:
    """What is inserted at the end of a conversation."""
    lines = {0: [], 1: ["user:", "assistant:"], 2: ["assistant:"], 3: []}[state]
    return "I" * len(lines), lines


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
PIECE = "pid long, turns array<long>, kinds binary, codes binary, roles array<string>, texts array<string>, keys array<string>"
NAMES = [x.split()[0] for x in (RESULT + ", " + PIECE).split(", ")]
ARROW = dict(zip(NAMES, [*[pa.int64()] * 6, pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(),
                         *[pa.list_(pa.string())] * 3]))


def digest(role: str, text: str) -> str:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


class Rows:
    """Rows of one conversation, in order, as they arrive."""

    def __init__(self):
        self.turns, self.kinds, self.codes, self.roles, self.texts, self.seen, self.size = [], bytearray(), bytearray(), [], [], set(), 0

    def add(self, turn, role: str, text: str, code: int) -> None:
        if code != BLANK:
            key = (role, text)
            if key in self.seen:
                code = DUPLICATE
            self.seen.add(key)
        self.turns.append(turn)
        self.kinds.append(CLASSES.get(role[:1], 3))
        self.codes.append(code)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)

    def counts(self) -> list[int]:
        known = [t for t in self.turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum((a, b) not in LEGAL for a, b in zip(self.kinds, self.kinds[1:]))
        return [gaps, self.codes.count(BLANK), self.codes.count(DUPLICATE), self.codes.count(TRUNCATED), illegal]

    def solved(self) -> dict:
        letters, state, cost = forward(self.codes, self.kinds, backward(self.codes, self.kinds, END), 0)
        more, lines = closing(state)
        text = "\n".join(written(letters, self.roles, self.texts, 0) + lines)
        values = [*self.counts(), cost + INSERT * len(more), "".join(letters) + more, hashlib.sha256(text.encode()).hexdigest()]
        return dict(zip(NAMES, values))

    def piece(self, pid: int) -> dict:
        keys = ["" if c >= BLANK else digest(r, t) for c, r, t in zip(self.codes, self.roles, self.texts)]
        return {"pid": pid, "turns": self.turns, "kinds": bytes(self.kinds), "codes": bytes(self.codes), "roles": self.roles, "texts": self.texts, "keys": keys}


def locally(id_type: pa.DataType, piece_rows: int, piece_bytes: int):
    """Sorted rows of a partition to results of conversations that lie inside it, and pieces of all others."""

    def run(batches):
        base, no = TaskContext.get().partitionId() << 32, 0
        now, rows, whole, out = object(), None, False, []

        def piece():
            nonlocal no
            out.append((now, rows.piece(base + no)))
            no += 1

        def batch():
            columns = [pa.array([c for c, _ in out], id_type), *(pa.array([r.get(n) for _, r in out], ARROW[n]) for n in NAMES)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv", *NAMES])

        for given in batches:
            for conv, turn, role, text, code, copies in zip(*(c.to_pylist() for c in given.columns)):
                if rows is None or conv != now:
                    if rows is not None:
                        if whole:
                            out.append((now, rows.solved()))
                        else:
                            piece()
                    # the first conversation of a partition may have begun in another one
                    whole, now, rows = rows is not None, conv, Rows()
                for _ in range(copies):
                    if len(rows.codes) >= piece_rows or rows.size >= piece_bytes:
                        piece()
                        whole, rows = False, Rows()
                    rows.add(turn, role, text, code)
            if out:
                yield batch()
        if rows is not None:
            piece()  # the last one may go on elsewhere
            yield batch()

    return run


def vectors_of(work):
    """A pass over pieces: `work` gives the end and the start vector of one."""

    def run(batches):
        for given in batches:
            rows = given.to_pylist()
            found = [work(r) for r in rows]
            ends, starts = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*(given.column(c) for c in ("pid", "conv", "kinds", "codes")), pa.array([list(x) for x in ends], pa.list_(pa.int64())),
                 pa.array([list(x) for x in starts], pa.list_(pa.int64()))],
                ["pid", "conv", "kinds", "codes", "end", "start"])

    return run


def settle(pieces: DataFrame, id_type: str, passes: int) -> DataFrame:
    """(pid, conv, kinds, codes, end, start, last) with the true vector, less a constant, at the end of each piece."""
    spark = pieces.sparkSession
    schema = f"pid long, conv {id_type}, kinds binary, codes binary, end array<long>, start array<long>"
    along = Window.partitionBy("conv").orderBy("pid")
    close = F.array(*[F.lit(x).cast("long") for x in END])

    def speculated(r):
        return END, backward(r["codes"], r["kinds"], END)[-1]

    def again(r):
        return r["true_end"], run_again(r["codes"], r["kinds"], tuple(r["end"]), tuple(r["start"]), tuple(r["true_end"]))

    def seen(df):
        return df.withColumn("true_end", F.coalesce(F.lead("start").over(along), close))

    open_ = F.col("true_end") != F.col("end")
    state = materialize(spark, pieces.select("pid", "conv", "kinds", "codes").mapInArrow(vectors_of(speculated), schema))
    for _ in range(passes):
        now = materialize(spark, seen(state))
        if now.filter(open_).isEmpty():
            break
        redone = now.filter(open_).mapInArrow(vectors_of(again), schema)
        state = materialize(spark, now.filter(~open_).drop("true_end").unionByName(redone))
    else:
        # one row of 16 numbers a piece, in order from the last piece of a conversation to its first
        unsettled = seen(state).filter(open_).select("conv").distinct().withColumnRenamed("conv", "_c")
        stuck = state.join(unsettled, F.col("conv").eqNullSafe(F.col("_c")), "left_semi")

        def matrices(batches):
            for given in batches:
                m = [transfer(r["codes"], r["kinds"]) for r in given.select(["codes", "kinds"]).to_pylist()]
                yield pa.RecordBatch.from_arrays([given.column("pid"), given.column("conv"), pa.array(m, pa.list_(pa.int64()))], ["pid", "conv", "m"])

        def stitched(batches):
            now, v = object(), END
            for given in batches:
                ends = []
                for conv, m in zip(given.column("conv").to_pylist(), given.column("m").to_pylist()):
                    if conv != now:
                        now, v = conv, END
                    ends.append(list(v))
                    v = [min(v[t] + m[4 * t + s] for t in range(4)) for s in range(4)]
                    v = [x - min(v) for x in v]
                yield pa.RecordBatch.from_arrays([given.column("pid"), pa.array(ends, pa.list_(pa.int64()))], ["_pid", "true_end"])

        m = stuck.mapInArrow(matrices, f"pid long, conv {id_type}, m array<long>")
        m = m.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), F.col("pid").desc())
        ends = m.mapInArrow(stitched, "_pid long, true_end array<long>")
        now = state.join(ends, F.col("pid") == F.col("_pid"), "left").drop("_pid").withColumn("true_end", F.coalesce("true_end", "end"))
        state = materialize(spark, now.mapInArrow(vectors_of(again), schema))
    return state.withColumn("last", F.lead("pid").over(along).isNull())


def states(batches):
    """The state in which each piece ends, for each state in which it may begin."""
    for given in batches:
        out = []
        for r in given.to_pylist():
            vectors = backward(r["codes"], r["kinds"], tuple(r["end"]))
            out.append([forward(r["codes"], r["kinds"], vectors, s)[1] for s in range(4)])
        yield pa.RecordBatch.from_arrays([given.column("pid"), given.column("conv"), pa.array(out, pa.list_(pa.int64()))], ["pid", "conv", "after"])


def entered(batches):
    """The state in which each piece begins; pieces come in the order of their conversations."""
    now, state = object(), 0
    for given in batches:
        out = []
        for conv, after in zip(given.column("conv").to_pylist(), given.column("after").to_pylist()):
            if conv != now:
                now, state = conv, 0
            out.append(state)
            state = after[state]
        yield pa.RecordBatch.from_arrays([given.column("pid"), pa.array(out, pa.int64())], ["_pid", "state"])


PART = ("n long, first_kind long, last_kind long, first_turn long, last_turn long, n_turns long, blank long, duplicate long, "
        "truncated long, illegal long, cost long, audit string, lines long, repaired string")
PART_NAMES = [x.split()[0] for x in PART.split(", ")]


def parts(batches):
    """Each piece's part of the result."""
    for given in batches:
        out = []
        for r in given.to_pylist():
            codes, kinds, turns = r["codes"], r["kinds"], [t for t in r["turns"] if t is not None]
            letters, state, cost = forward(codes, kinds, backward(codes, kinds, tuple(r["end"])), r["state"])
            lines = written(letters, r["roles"], r["texts"], r["state"])
            more, inserted = closing(state) if r["last"] else ("", [])
            lines += inserted
            some = len(codes) > 0
            out.append((
                len(codes), kinds[0] if some else None, kinds[-1] if some else None, turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)),
                codes.count(BLANK), codes.count(DUPLICATE), codes.count(TRUNCATED), sum((a, b) not in LEGAL for a, b in zip(kinds, kinds[1:])),
                cost + INSERT * len(more), "".join(letters) + more, len(lines), "\n".join(lines)))
        columns = [pa.array(c, pa.string() if n in ("audit", "repaired") else pa.int64()) for n, c in zip(PART_NAMES, zip(*out))]
        if out:
            yield pa.RecordBatch.from_arrays([given.column("conv"), given.column("pid"), *columns], ["conv", "pid", *PART_NAMES])


def together(id_type: pa.DataType):
    """Parts in order to one row a conversation."""

    def run(batches):
        now, t, out, started = None, None, [], False

        def finished():
            gaps = t["last_turn"] - t["first_turn"] + 1 - t["n_turns"] if t["n_turns"] else 0
            return (now, gaps, t["blank"], t["duplicate"], t["truncated"], t["illegal"], t["cost"], "".join(t["audit"]), t["sha"].hexdigest())

        def batch():
            columns = [pa.array(c, id_type if i == 0 else ARROW[NAMES[i - 1]]) for i, c in enumerate(zip(*out))]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv", *NAMES[:8]])

        for given in batches:
            for r in given.to_pylist():
                if not started or r["conv"] != now:
                    if started:
                        out.append(finished())
                    now, started = r["conv"], True
                    t = {"n_turns": 0, "last_turn": None, "last_kind": None, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": [],
                         "sha": hashlib.sha256(), "lines": 0}
                if r["lines"]:
                    t["sha"].update((("\n" if t["lines"] else "") + r["repaired"]).encode())
                for c in ("blank", "duplicate", "truncated", "illegal", "cost", "lines"):
                    t[c] += r[c]
                t["audit"].append(r["audit"])
                if r["n"]:
                    t["illegal"] += t["last_kind"] is not None and (t["last_kind"], r["first_kind"]) not in LEGAL
                    t["last_kind"] = r["last_kind"]
                if r["n_turns"]:
                    if t["n_turns"]:
                        t["n_turns"] += r["n_turns"] - (r["first_turn"] == t["last_turn"])
                    else:
                        t["n_turns"], t["first_turn"] = r["n_turns"], r["first_turn"]
                    t["last_turn"] = r["last_turn"]
            if out:
                yield batch()
        if started:
            out.append(finished())
            yield batch()

    return run


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, copies): rows damaged by crc32(`conv:turn`) % 20 (0 dropped, 1 emptied, 2 without
    `.!?`, 3 twice, 4 from a user). Dropped rows stay with no copies, so that their conversation is known."""
    space = F.lit(" ")
    text = F.coalesce(F.col(text_col).cast("string"), space)
    name = F.concat(F.coalesce(F.col(conv_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space))
    rows = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), space).alias("role"),
                       text.alias("text"), (F.crc32(name) % 20).alias("_how"))
    how = F.col("_how")
    return rows.select(
        "conv", "turn", F.when(how == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(how == 1, "").when(how == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(how == 0, 0).when(how == 3, 2).otherwise(1).alias("copies"))


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS, piece_bytes: int = PIECE_BYTES, passes: int = PASSES, id_col: str = "conv_id") -> DataFrame:
    """One row a conversation: (id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    `rows` has conv, turn, role, text and copies, the number of times a row stands there (0: it only names its conversation).
    """
    spark = rows.sparkSession
    field = rows.schema["conv"].dataType
    kind = field.simpleString()
    arrow = _arrow_type(field)
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    code = F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    space = F.lit(" ")
    rows = rows.select("conv", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), "copies")
    # equal rows may be many; a number that a scan repeats lets them be cut apart
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.xxhash64("text")]
    ranged = rows.withColumn("_n", F.monotonically_increasing_id()).repartitionByRange(*order, F.col("_n")).drop("_n").sortWithinPartitions(*order)
    schema = f"conv {kind}, {RESULT}, {PIECE}"
    found = ranged.select("conv", "turn", "role", "text", code.cast("int").alias("code"), F.col("copies").cast("int").alias("copies")).mapInArrow(locally(arrow, piece_rows, piece_bytes), schema)
    found = materialize(spark, found)
    done = found.filter("pid IS NULL").select("conv", *NAMES[:8])
    pieces = found.filter("pid IS NOT NULL").select("conv", *NAMES[8:])

    # a row that another piece had before; each piece names a row once, so a name has as many rows as pieces
    named = pieces.select("conv", "pid", F.posexplode("keys").alias("i", "key")).filter("key <> ''")
    first = Window.partitionBy("conv", "key").orderBy("pid")
    again = named.withColumn("nth", F.row_number().over(first)).filter("nth > 1").groupBy(F.col("pid").alias("_pid")).agg(F.collect_list("i").alias("again"))

    def recoded(batches):
        for given in batches:
            codes = []
            for c, more in zip(given.column("codes").to_pylist(), given.column("again").to_pylist()):
                c = bytearray(c)
                for i in more or ():
                    c[i] = DUPLICATE
                codes.append(bytes(c))
            yield pa.RecordBatch.from_arrays([given.column("pid"), given.column("conv"), given.column("kinds"), pa.array(codes, pa.binary())], ["pid", "conv", "kinds", "codes"])

    coded = pieces.select("conv", "pid", "kinds", "codes").join(again, F.col("pid") == F.col("_pid"), "left").drop("_pid")
    coded = materialize(spark, coded.mapInArrow(recoded, f"pid long, conv {kind}, kinds binary, codes binary"))
    settled = materialize(spark, settle(coded, kind, passes))
    in_order = settled.mapInArrow(states, f"pid long, conv {kind}, after array<long>").repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "pid")
    begun = in_order.mapInArrow(entered, "_pid long, state long")
    known = settled.select(F.col("pid").alias("_pid"), "codes", "end", "last").join(begun, "_pid")
    parted = pieces.drop("codes", "keys").join(known, F.col("pid") == F.col("_pid")).mapInArrow(parts, f"conv {kind}, pid long, {PART}")
    gathered = parted.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "pid")
    rest = gathered.mapInArrow(together(arrow), f"conv {kind}, {RESULT}")
    return done.unionByName(rest).withColumnRenamed("conv", id_col)


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
