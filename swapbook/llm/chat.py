"""Transcript parsing: a hidden Markov model recovers the speakers of raw transcripts, which are then rendered as turns.

A transcript is a sequence of lines. The hidden state of a line is a role and whether it begins a turn; what is seen is
its speaker marker, if it has one, its length, a question mark at its end and its first letter. Transitions and
emissions are smoothed counts over a bounded sample of labelled conversations. The Viterbi path gives each line's
role; lines from one beginning to the next are a turn, shown without its marker in one canonical form.

A conversation is cut into blocks of neighbouring turns, and each task works on one block. For a conversation of several
blocks, a first pass reduces each block to the best score from each state before it to each state at its end (a
6 x 6 matrix); a scan over these fixes the states at the seams, and each block's own path is then found between them,
which gives the path of the whole. So a conversation of any length is never in one task.

Defined cases: equal rows of one place (conversation, turn, text) count once; different texts at one place follow each
other in the order of a hash; a null text is an empty line; a null conversation is one of its own, a null turn comes
first; an unknown or null role is not learned from, of two roles at one place the first is; without any labels all states are equally likely to begin with;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swapbook.llm import ship
from swapbook.llm.store import kept

ROLES = ("system", "user", "assistant")
#: Speaker markers by role, as they stand before a colon at the start of a line.
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "q", "question", "customer"),
    "assistant": ("assistant", "ai", "a", "answer", "bot"),
}
STATES = 2 * len(ROLES)  # role, then role + len(ROLES) for a line that goes on
SEEN = 64
BLOCK = 1024
MAX_ROWS = 20_000
LOWEST = -1e9


def marker(role: str) -> str:
    return f"(?i)^ *(?:{'|'.join(MARKERS[role])}) ?: "


def any_marker() -> str:
    return f"(?i)^ *(?:{'|'.join(m for r in ROLES for m in MARKERS[r])}) ?: "


def seen(line: Column) -> Column:
    """Number of what is observed of a line."""
    kind = F.lit(0)
    for i, role in enumerate(ROLES):
        kind = F.when(F.rlike(line, F.lit(marker(role))), i + 1).otherwise(kind)
    n = F.length(line)
    size = F.when(n < 20, 0).when(n < 80, 1).when(n < 240, 2).otherwise(3)
    asks = F.rlike(line, F.lit("\\? *$")).cast("int")
    upper = F.rlike(line, F.lit("^[^\\p{L}]*\\p{Lu}")).cast("int")
    return (kind * 16 + size * 4 + asks * 2 + upper).cast("int")


def lines_of(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """(conv, turn, tie, line_no, line, seen): the lines of a transcript in order."""
    named = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(text), F.lit("")).alias("_t")
    ).distinct()
    each = named.select("conv", "turn", F.xxhash64("_t").alias("tie"), F.posexplode(F.split("_t", "\n")).alias("line_no", "line"))
    return each.withColumn("seen", seen(F.col("line")))


class Model:
    def __init__(self, starts: np.ndarray, moves: np.ndarray, shows: np.ndarray):
        """Counts of first states, transitions and observations per state."""
        first = starts + 0.5
        first[len(ROLES) :] = 0
        self.start = np.log(np.maximum(first / first.sum(), 1e-300)).clip(LOWEST)
        moves = moves + 0.1
        for i in range(STATES):
            for role in range(len(ROLES)):
                if role != i % len(ROLES):
                    moves[i, len(ROLES) + role] = 0  # a turn goes on in its own role only
        self.move = np.where(moves > 0, np.log(np.maximum(moves / moves.sum(axis=1, keepdims=True), 1e-300)), LOWEST)
        shows = shows + 0.1
        self.show = np.log(shows / shows.sum(axis=1, keepdims=True))

    def transfer(self, observed: np.ndarray) -> np.ndarray:
        """Best score from each state before these lines to each state of the last one."""
        best = np.where(np.eye(STATES, dtype=bool), 0.0, LOWEST * 10)
        for o in observed:
            best = (best[:, :, None] + self.move[None]).max(axis=1) + self.show[:, o]
        return best

    def path(self, observed: np.ndarray, before: int = -1, last: int = -1) -> np.ndarray:
        """States of the lines; ``before`` and ``last`` fix the state before them and that of the last one."""
        score = (self.start if before < 0 else self.move[before]) + self.show[:, observed[0]]
        back = np.zeros((len(observed), STATES), np.int64)
        for i in range(1, len(observed)):
            options = score[:, None] + self.move
            back[i] = options.argmax(axis=0)
            score = options.max(axis=0) + self.show[:, observed[i]]
        states = np.empty(len(observed), np.int64)
        states[-1] = score.argmax() if last < 0 else last
        for i in range(len(observed) - 1, 0, -1):
            states[i - 1] = back[i, states[i]]
        return states


def learn(transcripts: DataFrame, roles: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text",
          role: str = "role") -> Model:
    """Counts over at most ``MAX_ROWS`` rows of whole conversations, picked by a hash; ``roles`` has the true ones."""
    index = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col(role)).cast("int") - 1
    known = roles.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), index.alias("role")).filter("role >= 0")
    known = known.groupBy("conv", "turn").agg(F.min("role").alias("role")).orderBy(F.xxhash64("conv"), "conv", "turn").limit(MAX_ROWS)
    lines = lines_of(transcripts, conv, turn, text).join(known, ["conv", "turn"])
    lines = lines.withColumn("state", F.when(F.col("line_no") == 0, F.col("role")).otherwise(F.col("role") + len(ROLES)))
    order = Window.partitionBy("conv").orderBy("turn", "tie", "line_no")
    pairs = lines.withColumn("before", F.coalesce(F.lag("state").over(order), F.lit(-1)))
    table = pairs.groupBy("before", "state", "seen").count().toPandas()
    starts, moves, shows = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, SEEN))
    for b, s, o, n in table.itertuples(index=False):
        shows[s, o] += n
        if b < 0:
            starts[s] += n
        else:
            moves[b, s] += n
    return Model(starts, moves, shows)


ORDER = ["turn", "tie", "line_no"]


def _seams(blocks: DataFrame, shared) -> DataFrame:
    """(conv, block, before, last) of conversations with several blocks."""

    def scan(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block").reset_index(drop=True)
        # a start before the first line: the scores of the first block come from its own pass
        reached = [np.asarray(rows["begin"].iloc[0], float)]
        matrices = [np.asarray(m, float).reshape(STATES, STATES) for m in rows["m"]]
        for m in matrices[1:]:
            reached.append((reached[-1][:, None] + m).max(axis=0))
        last = np.empty(len(rows), np.int64)
        last[-1] = reached[-1].argmax()
        for i in range(len(rows) - 1, 0, -1):
            last[i - 1] = (reached[i - 1] + matrices[i][:, last[i]]).argmax()
        before = np.concatenate([[-1], last[:-1]])
        return pd.DataFrame({"conv": rows["conv"], "block": rows["block"], "before": before, "last": last})

    def reduced(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        observed = rows.sort_values(ORDER, na_position="first")["seen"].to_numpy()
        model = ship.received(shared)
        begin = model.start + model.show[:, observed[0]]
        for o in observed[1:]:
            begin = (begin[:, None] + model.move).max(axis=0) + model.show[:, o]
        return pd.DataFrame({"conv": [key[0]], "block": [key[1]], "m": [model.transfer(observed).ravel()], "begin": [begin]})

    kind = blocks.schema["conv"].dataType.simpleString()
    several = blocks.groupBy("conv").agg(F.min("block").alias("_lo"), F.max("block").alias("_hi")).filter("_lo <> _hi")
    several = several.select(F.col("conv").alias("_conv"))
    long_ = blocks.join(several, F.col("conv").eqNullSafe(F.col("_conv")), "left_semi")
    matrices = long_.groupBy("conv", "block").applyInPandas(reduced, f"conv {kind}, block long, m array<double>, begin array<double>")
    return matrices.groupBy("conv").applyInPandas(scan, f"conv {kind}, block long, before int, last int")


def parse(lines: DataFrame, model: Model) -> DataFrame:
    """(conv, turn_no, role, line_no, line): the lines with the turns they belong to, markers taken off."""
    shared = ship.broadcast(lines.sparkSession.sparkContext, model)
    kind = lines.schema["conv"].dataType.simpleString()
    blocks = lines.withColumn("block", F.floor(F.coalesce("turn", F.lit(0).cast("long")) / BLOCK).cast("long"))
    seams = _seams(blocks.select("conv", "block", *ORDER, "seen"), shared).withColumnsRenamed({"conv": "_conv", "block": "_block"})
    met = blocks.join(seams, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")), "left").drop("_conv", "_block")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(ORDER, na_position="first").reset_index(drop=True)
        before, last = rows["before"].iloc[0], rows["last"].iloc[0]
        fixed = [-1 if pd.isna(x) else int(x) for x in (before, last)]
        states = ship.received(shared).path(rows["seen"].to_numpy(), *fixed)
        begins = states < len(ROLES)
        return pd.DataFrame({
            "conv": rows["conv"], "block": rows["block"], "at": np.arange(len(rows)), "line": rows["line"],
            "role": [ROLES[s % len(ROLES)] for s in states], "own": np.cumsum(begins), "begins": begins,
        })

    done = kept(met.groupBy("conv", "block").applyInPandas(
        run, f"conv {kind}, block long, at long, line string, role string, own long, begins boolean"
    ))
    sums = done.groupBy("conv", "block").agg(F.max("own").alias("_turns"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("conv", "block", F.coalesce(F.sum("_turns").over(before), F.lit(0)).alias("_offset"))
    numbered = done.alias("d").join(
        offsets.alias("o"), F.col("d.conv").eqNullSafe(F.col("o.conv")) & (F.col("d.block") == F.col("o.block"))
    )
    clean = F.when(F.col("begins"), F.regexp_replace("line", any_marker(), "")).otherwise(F.col("line"))
    return numbered.select(
        F.col("d.conv").alias("conv"), (F.col("_offset") + F.col("own")).alias("turn_no"), "role",
        F.struct(F.col("d.block").alias("block"), "at").alias("place"), clean.alias("line"),
    )


def rendered(parsed: DataFrame) -> DataFrame:
    """One row per turn: conv, turn_no, role, n_lines, text and its canonical form."""
    turns = parsed.groupBy("conv", "turn_no").agg(
        F.first("role").alias("role"),
        F.count(F.lit(1)).alias("n_lines"),
        F.array_join(F.array_sort(F.collect_list(F.struct("place", "line")))["line"], "\n").alias("text"),
    )
    body = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("<|end|>\n"))
    return turns.withColumn("rendered", body)
