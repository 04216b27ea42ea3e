"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A transcript is rows (conv_id, turn, text) in order of turn; each text is cut into lines.  A state is
a role with "begins a turn" or "goes on"; an observation is the line's speaker marker (``User:``,
``### Assistant``, ``[system]``, another ``Name:`` or none), whether it begins a row or the
transcript, its length, and whether it ends in a question mark.  Start, transition and emission
counts come from labelled transcripts, mixed with a belief that ties markers to their roles.  Viterbi gives
the most likely states; lines up to the next beginning form a turn, rendered as
``<|role|>``, a line feed, and the lines without the marker.

Distribution.  Lines are dealt by ranges of (conv_id, turn, row, line), so a conversation of any
length is many ranges.  A range's Viterbi is a state-by-state table of best paths; the driver chains
the tables of conversations that cross ranges (two per range at most) and each range is then decoded
between the states so fixed.  That gives the most likely states of the whole conversation.

Nulls and edge cases: rows without conv_id are one conversation; a null turn comes first; a null or
empty text is one empty line; rows that repeat conv_id and turn follow in order of their text;
repeated rows are each a turn of their own; roles that are null are not learned from; without any
labelled row the roles are user and assistant by the prior alone; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, stored

#: Speaker names by the role they stand for (fixed values).
SPEAKERS = {
    "system": ["system", "instructions", "context"],
    "user": ["user", "human", "question", "q", "customer", "prompter"],
    "assistant": ["assistant", "bot", "ai", "answer", "a", "agent", "response"],
}
#: Roles that the driver's tables of states hold; more are an error, none is left out.
MAX_ROLES = 256
LENGTH_BOUNDS = [0, 10, 20, 40, 80, 120, 160, 200, 300, 400, 600, 1000]
#: Prior count of anything; weight of the expected marker and place chances beside the learned ones;
#: chance of a role's marker where it does not belong.
PRIOR, BELIEF, STRAY = 0.5, 0.05, 0.0005
MARKER = r"^\s*(?:#+\s*|\*\*|\[|<\|?)([A-Za-z]{1,20})(?:\s*\d{0,3})(?:\]|\|?>|\*\*)?\s*:?|^\s*([A-Za-z]{1,20})\s*\d{0,3}\s*:"


def _name(line: str) -> Column:
    """The speaker's name that a line begins with, lower-cased, else empty."""
    return ascii_lower(F.concat(F.regexp_extract(line, MARKER, 1), F.regexp_extract(line, MARKER, 2)))


def _markers(roles: list[str]) -> dict[str, int]:
    """Number of the marker feature for each known speaker name: role + 2; 1 is another name, 0 none."""
    out = {}
    for k, role in enumerate(roles):
        for name in [role.lower(), *SPEAKERS.get(role, [])]:
            out.setdefault(name, k + 2)
    return out


def lines_of(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, part, pos, line_no, line, place, size, asks, name): lines in ranges, in order."""
    rows = turns.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                        F.monotonically_increasing_id().alias("row"))
    each = rows.select("conv_id", "turn", "role", "row", F.xxhash64("text").alias("tie"),
                       F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    bounds = F.array(*[F.lit(b) for b in LENGTH_BOUNDS])
    found = each.select(
        "*", F.when(F.col("line_no") > 0, 0).otherwise(1).alias("place"),
        F.size(F.filter(bounds, lambda b: b < F.length("line"))).alias("size"),
        F.when(F.rtrim("line").endswith("?"), 1).otherwise(0).alias("asks"), _name("line").alias("name"))
    order = ["conv_id", "turn", "tie", "row", "line_no"]
    return stored(found.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
                  .withColumn("pos", F.monotonically_increasing_id()).drop("tie", "row"), "chat-lines")


@dataclass
class Model:
    """roles in order; states 2 r (begins) and 2 r + 1 (goes on); log probabilities."""

    roles: list[str]
    start: np.ndarray
    step: np.ndarray
    emit: dict[str, np.ndarray]

    def scores(self, lines: pd.DataFrame) -> np.ndarray:
        """Line by state: log probability of the observations."""
        known = _markers(self.roles)
        marker = np.array([known.get(x, 1) if x else 0 for x in lines["name"]], int)
        # the first line of a transcript is a beginning of its own kind
        place = np.where(_first(lines) & (lines["place"].to_numpy() == 1), 2, lines["place"].to_numpy())
        out = self.emit["marker"][:, marker] + self.emit["place"][:, place]
        for f in ("size", "asks"):
            out = out + self.emit[f][:, lines[f].to_numpy()]
        return out.T


def _same(a, b) -> bool:
    return a == b or (pd.isna(a) and pd.isna(b))


def _first(lines: pd.DataFrame) -> np.ndarray:
    return lines["opens"].to_numpy()


def _edges(lines: DataFrame, train: Column | None = None) -> list:
    """First and last line of every range, in order of range: a row for each range."""
    learned = F.coalesce(F.lit(False) if train is None else train, F.lit(False)).alias("train")
    ends = [f(F.struct("pos", "conv_id", "role", "place", learned)).alias(n) for f, n in ((F.min, "first"), (F.max, "last"))]
    return sorted(lines.groupBy("part").agg(*ends).collect(), key=lambda r: r["part"])


def _marked(lines: DataFrame, edges: list) -> DataFrame:
    """``lines`` with ``opens``: whether a line is the first of its conversation."""
    going = [r["part"] for p, r in zip(edges, edges[1:], strict=False) if _same(p["last"]["conv_id"], r["first"]["conv_id"])]
    before = Window.partitionBy("part").orderBy("pos")
    # ranges that go on with a conversation: one entry a range at most
    inner = F.lag(F.struct("conv_id")).over(before)
    opens = F.when(inner.isNull(), ~F.col("part").isin(going) if going else F.lit(True)).otherwise(~inner["conv_id"].eqNullSafe(F.col("conv_id")))
    return lines.withColumn("opens", opens)


def fit(lines: DataFrame, edges: list, train: Column) -> Model:
    """Counts over the lines of labelled conversations (``train``: a condition on conv_id)."""
    labelled = _marked(lines, edges).where(train)
    own = labelled.where("role IS NOT NULL")
    roles = sorted(r["role"] for r in own.select("role").distinct().limit(MAX_ROLES + 1).collect())
    if len(roles) > MAX_ROLES:
        raise ValueError(f"more than {MAX_ROLES} different roles")
    belief = BELIEF if roles else 1.0
    roles = roles or ["assistant", "user"]
    known = _markers(roles)
    names = F.coalesce(*[F.when(F.col("name") == n, k) for n, k in known.items()], F.when(F.col("name") == "", 0).otherwise(1))
    state = F.coalesce(*[F.when(F.col("role") == r, 2 * k) for k, r in enumerate(roles)]) + F.when(F.col("place") == 0, 1).otherwise(0)
    rows = labelled.select("part", "pos", "conv_id", "opens", state.alias("state"), names.alias("marker"),
                           F.when(F.col("opens") & (F.col("place") == 1), 2).otherwise(F.col("place")).alias("place"), "size", "asks")
    before = F.lag("state").over(Window.partitionBy("part").orderBy("pos"))
    rows = stored(rows.withColumn("before", F.when(~F.col("opens"), before)), "chat-states")
    n = 2 * len(roles)
    widths = {"marker": len(roles) + 2, "place": 3, "size": len(LENGTH_BOUNDS) + 1, "asks": 2}
    start, step = np.full(n, PRIOR), np.full((n, n), PRIOR)
    start[1::2] = step[:, 1::2] = 1e-3
    for k in range(n):
        step[k, k | 1] += PRIOR  # a turn goes on with its own role
    for r in rows.where("opens AND state IS NOT NULL").groupBy("state").count().collect():
        start[r["state"]] += r["count"]
    for r in rows.where("before IS NOT NULL AND state IS NOT NULL").groupBy("before", "state").count().collect():
        step[r["before"], r["state"]] += r["count"]
    # the belief mixed in below covers markers and places that the labelled lines never show
    emit = {f: np.full((n, w), 1e-3 if f in ("marker", "place") else PRIOR) for f, w in widths.items()}
    for f in widths:
        for r in rows.where("state IS NOT NULL").groupBy("state", f).count().collect():
            emit[f][r["state"], r[f]] += r["count"]
    # transitions over the seam of two ranges: one for each range at most
    seam = {r: 2 * k for k, r in enumerate(roles)}
    for p, r in zip(edges, edges[1:], strict=False):
        a, b = p["last"], r["first"]
        if a["train"] and _same(a["conv_id"], b["conv_id"]) and a["role"] in seam and b["role"] in seam:
            step[seam[a["role"]] + (a["place"] == 0), seam[b["role"]] + (b["place"] == 0)] += 1
    emit = {f: x / x.sum(1, keepdims=True) for f, x in emit.items()}
    marker, place = _expected(len(roles))
    emit["marker"] = (1 - belief) * emit["marker"] + belief * marker
    emit["place"] = (1 - belief) * emit["place"] + belief * place
    return Model(roles, np.log(start / start.sum()), np.log(step / step.sum(1, keepdims=True)), {f: np.log(x) for f, x in emit.items()})


def _expected(roles: int) -> tuple[np.ndarray, np.ndarray]:
    """Chances of marker and place by state that hold whatever the labelled transcripts show: a
    role's marker begins a turn of that role, and a turn may begin within a row."""
    marker = np.full((2 * roles, roles + 2), STRAY)
    marker[:, :2] = 0.05
    marker[1::2, 0] = 0.9
    for k in range(roles):
        marker[2 * k, k + 2] = 0.9
    place = np.full((2 * roles, 3), 0.3)
    place[1::2] = [0.98, 0.01, 0.01]
    return marker / marker.sum(1, keepdims=True), place / place.sum(1, keepdims=True)


def best_paths(scores: np.ndarray, step: np.ndarray) -> np.ndarray:
    """[i, j]: best log probability of a path over all lines that begins in state i and ends in j."""
    n = scores.shape[1]
    best = np.full((n, n), -np.inf)
    np.fill_diagonal(best, scores[0])
    for row in scores[1:]:
        best = (best[:, :, None] + step[None]).max(1) + row
    return best


def viterbi(scores: np.ndarray, step: np.ndarray, start: np.ndarray, end: int | None = None) -> np.ndarray:
    """Most likely states; ``start`` are the log weights of the first state, ``end`` fixes the last one."""
    value = start + scores[0]
    back = np.zeros(scores.shape, np.int16)
    for k in range(1, len(scores)):
        through = value[:, None] + step
        back[k] = through.argmax(0)
        value = through.max(0) + scores[k]
    out = np.empty(len(scores), np.int16)
    out[-1] = value.argmax() if end is None else end
    for k in range(len(scores) - 1, 0, -1):
        out[k - 1] = back[k, out[k]]
    return out


def _fragments(lines: pd.DataFrame) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of lines of one conversation."""
    ids = lines["conv_id"]
    new = (ids != ids.shift()) & ~(ids.isna() & ids.shift().isna())
    at = [*np.flatnonzero(new.to_numpy() | (np.arange(len(lines)) == 0)), len(lines)]
    return zip(at, at[1:], strict=False)


def recover(turns: DataFrame, train: Column) -> tuple[DataFrame, Model]:
    """(lines with ``state``, model) of ``turns(conv_id, turn, role, text)``; roles are read where ``train`` holds only."""
    lines = lines_of(turns)
    edges = _edges(lines, train)
    model = fit(lines, edges, train)
    slim = stored(_marked(lines, edges).select("part", "pos", "conv_id", "opens", "place", "size", "asks", "name"), "chat-observed")
    n = len(model.start)

    def tables(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos", ignore_index=True)
        scores, bounds = model.scores(group), list(_fragments(group))
        ends = [bounds[0], bounds[-1]] if len(bounds) > 1 else bounds
        return pd.DataFrame({"part": group["part"].iloc[0], "nth": range(len(ends)),
                             "best": [best_paths(scores[a:b], model.step).astype("<f8").tobytes() for a, b in ends]})

    linked = {r["part"] for p, r in zip(edges, edges[1:], strict=False) if _same(p["last"]["conv_id"], r["first"]["conv_id"])}
    fixed: dict[int, dict[str, tuple[int, int]]] = {}
    if linked:
        at = {e["part"]: k for k, e in enumerate(edges)}
        touched = linked | {edges[at[p] - 1]["part"] for p in linked}
        found = (slim.where(F.col("part").isin(sorted(touched))).groupBy("part")
                 .applyInPandas(tables, "part int, nth int, best binary").collect())
        best: dict[int, list] = {}
        for r in sorted(found, key=lambda r: (r["part"], r["nth"])):
            best.setdefault(r["part"], []).append(np.frombuffer(bytes(r["best"]), "<f8").reshape(n, n))
        fixed = _chain(edges, linked, best, model)

    def decode(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos", ignore_index=True)
        scores, bounds = model.scores(group), list(_fragments(group))
        known = fixed.get(int(group["part"].iloc[0]), {})
        states = np.empty(len(group), np.int32)
        for k, (a, b) in enumerate(bounds):
            pair = known.get("last") if k == len(bounds) - 1 and "last" in known else known.get("first") if k == 0 else None
            start, end = model.start, None
            if pair is not None:
                start, end = np.full(n, -np.inf), pair[1]
                start[pair[0]] = 0.0
            states[a:b] = viterbi(scores[a:b], model.step, start, end)
        return pd.DataFrame({"part": group["part"], "pos": group["pos"], "state": states})

    states = slim.groupBy("part").applyInPandas(decode, "part int, pos bigint, state int")
    return lines.join(stored(states, "chat-decoded"), ["part", "pos"]), model


def _chain(edges: list, linked: set[int], best: dict[int, list], model: Model) -> dict[int, dict[str, tuple[int, int]]]:
    """First and last state of every fragment of the conversations that cross ranges."""
    out: dict[int, dict[str, tuple[int, int]]] = {}
    k = 0
    while k + 1 < len(edges):
        if edges[k + 1]["part"] not in linked:
            k += 1
            continue
        chain = [k]
        while chain[-1] + 1 < len(edges) and edges[chain[-1] + 1]["part"] in linked:
            chain.append(chain[-1] + 1)
            if len(best[edges[chain[-1]]["part"]]) > 1:  # another conversation begins within this range
                break
        parts = [edges[i]["part"] for i in chain]
        frags = [best[parts[0]][-1], *(best[p][0] for p in parts[1:])]
        value, steps = model.start[:, None] + frags[0], []
        steps.append(value.argmax(0))
        value = value.max(0)
        for m in frags[1:]:
            into = value[:, None] + model.step
            through = into.max(0)[:, None] + m
            steps.append((into.argmax(0), through.argmax(0)))
            value = through.max(0)
        end = int(value.argmax())
        for i in range(len(frags) - 1, -1, -1):
            enter = int(steps[0][end]) if i == 0 else int(steps[i][1][end])
            slot = "last" if i == 0 else "first"
            out.setdefault(parts[i], {})[slot] = (enter, end)
            if i:
                end = int(steps[i][0][enter])
        k = chain[-1]
    return out


def render(lines: DataFrame, model: Model) -> DataFrame:
    """One row a recovered turn: conv_id, turn and line_no of its first line, role, n_lines, rendered."""
    begins = (F.col("state") % 2 == 0) | F.col("opens")
    order = Window.partitionBy("part").orderBy("pos")
    marked = _marked(lines, _edges(lines)).withColumn("begins", begins).withColumn("nth", F.sum(begins.cast("int")).over(order))
    marked = stored(marked, "chat-turns")
    # lines at the head of a range that go on with a turn of an earlier one: one entry a range at most
    counts = sorted(marked.groupBy("part").agg(F.max("nth").alias("n"), F.min("nth").alias("least")).collect(), key=lambda r: r["part"])
    carry, last = [], None
    for r in counts:
        if r["least"] == 0 and last is not None:
            carry.append((r["part"], *last))
        if r["n"]:
            last = (r["part"], r["n"])
    spark = lines.sparkSession
    heads = spark.createDataFrame(carry, "part int, _part int, _nth bigint")
    placed = (marked.join(F.broadcast(heads), (marked["part"] == heads["part"]) & (marked["nth"] == 0), "left")
              .select(F.coalesce("_part", marked["part"]).alias("tpart"), F.coalesce("_nth", "nth").alias("tnth"), marked["part"].alias("part"),
                      "pos", "conv_id", "turn", "line_no", "line", "state", "name", "begins"))
    # a marker goes where a turn of the role that it names begins; elsewhere the words belong to the text
    known = _markers(model.roles)
    named = F.coalesce(*[F.when(F.col("name") == n, k - 2) for n, k in known.items()])
    cut = F.when(F.col("begins") & (named == F.floor(F.col("state") / 2)), F.regexp_replace("line", f"(?:{MARKER})\\s*", "")).otherwise(F.col("line"))
    item = F.struct("part", "pos", "line_no", "turn", "conv_id", "state", cut.alias("line"))
    each = placed.groupBy("tpart", "tnth").agg(F.sort_array(F.collect_list(item)).alias("all"))
    role = F.array(*[F.lit(r) for r in model.roles])[F.floor(F.col("all")[0]["state"] / 2).cast("int")]
    return each.select(F.col("all")[0]["conv_id"].alias("conv_id"), F.col("all")[0]["turn"].alias("turn"),
                       F.col("all")[0]["line_no"].alias("line_no"), role.alias("role"), F.size("all").alias("n_lines"),
                       F.concat(F.lit("<|"), role, F.lit("|>\n"), F.array_join(F.col("all.line"), "\n")).alias("rendered"))


def format_chats(turns: DataFrame, train: Column) -> DataFrame:
    """Canonical turns of ``turns(conv_id, turn, role, text)``; see ``recover`` and ``render``."""
    return render(*recover(turns, train))
