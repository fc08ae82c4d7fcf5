"""Chat formatting: roles recovered from transcripts by a hidden Markov model, then canonical turns.

The states are the roles a line may open, or go on with; a line is observed as a speaker marker (of a
known word, of an unknown name, or none) together with its shape. The Viterbi path over the lines of a
transcript says where turns begin and whose they are, also where a marker is missing, foreign or only
looks like one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.common import by_bytes

# Words that name a speaker, by role.
MARKERS = {
    "system": "system instruction instructions context setup".split(),
    "user": "user human customer client question q prompt me you".split(),
    "assistant": "assistant ai bot agent model answer a response reply gpt".split(),
}
ROLES = list(MARKERS)
STATES = [(role, opens) for role in ROLES for opens in (True, False)]
MARK = re.compile(r"^\s*(?:(?:\#{1,6}|>+|[-*\[(<|]+)\s*)?(?:\*\*)?([^\W\d_][\w .-]{0,30}?)(?:\*\*)?\s*"
                  r"(?:[|\])>]+\s*)?[:：]\s*(?:\*\*)?\s?(.*)$|^\s*<\|?\s*(?:im_start\|>)?([A-Za-z]+)\s*\|?>\s*(.*)$", re.S)
# Probabilities of the model: of a turn's next line opening another turn, and of the next turn's role.
OPEN = 0.35
NEXT = {"system": {"system": 0.02, "user": 0.9, "assistant": 0.08},
        "user": {"system": 0.01, "user": 0.04, "assistant": 0.95},
        "assistant": {"system": 0.01, "user": 0.95, "assistant": 0.04}}
FIRST = {"system": 0.3, "user": 0.65, "assistant": 0.05}


def observed(line: str) -> tuple[str, str]:
    """What kind of marker the line begins with (a role, ``name`` or ``none``), and the line without it."""
    found = MARK.match(line)
    if not found:
        return "none", line
    name = (found[1] or found[3] or "").strip().lower()
    rest = found[2] if found[1] is not None else found[4]
    for role, words in MARKERS.items():
        if name in words or (name.split() and name.split()[0] in words and len(name.split()) <= 2):
            return role, rest or ""
    return ("name", line) if len(name.split()) <= 3 else ("none", line)


def emission(state: tuple[str, bool], kind: str, line: str) -> float:
    """Log probability of the observation in the state."""
    role, opens = state
    if not opens:  # a line within a turn rarely looks marked
        p = {"none": 0.97, "name": 0.025}.get(kind, 0.002)
    elif kind in MARKERS:
        p = 0.9 if kind == role else 0.004
    else:
        p = {"name": 0.05, "none": 0.03}[kind]
    # shape: questions and short lines are rather a user's, lists and long lines an assistant's
    asks, long = line.rstrip().endswith("?"), len(line) > 300
    shape = {"system": (0.1, 0.3), "user": (0.5, 0.3), "assistant": (0.15, 0.6)}[role]
    return math.log(p) + math.log(shape[0] if asks else 1 - shape[0]) + math.log(shape[1] if long else 1 - shape[1])


def transition(before: tuple[str, bool], after: tuple[str, bool]) -> float:
    if not after[1]:
        return math.log(1 - OPEN) if after[0] == before[0] else -math.inf
    return math.log(OPEN * NEXT[before[0]][after[0]])


TRANSITIONS = [[transition(a, b) for a in STATES] for b in STATES]


def best_path(lines: list[tuple[str, str]]) -> list[int]:
    """Viterbi: the most probable states of the observed (kind, line) pairs."""
    if not lines:
        return []
    reach = [math.log(FIRST[role]) + emission(s, *lines[0]) if (role := s[0]) and s[1] else -math.inf for s in STATES]
    came: list[list[int]] = []
    for kind, line in lines[1:]:
        step, back = [], []
        for j, s in enumerate(STATES):
            i = max(range(len(STATES)), key=lambda k: reach[k] + TRANSITIONS[j][k])
            back.append(i)
            step.append(reach[i] + TRANSITIONS[j][i] + emission(s, kind, line))
        reach = step
        came.append(back)
    path = [max(range(len(STATES)), key=lambda k: reach[k])]
    for back in reversed(came):
        path.append(back[path[-1]])
    return path[::-1]


def parse(transcript: str) -> list[tuple[str, str]]:
    """(role, text) turns; the marker of an opening line is taken off. Blank lines say nothing about roles: those
    inside a turn stay, those at its ends go."""
    lines, gaps, gap = [], [], []  # lines with text, and the blank ones before each
    for x in transcript.split("\n"):
        if x.strip():
            lines.append(x)
            gaps.append(gap)
            gap = []
        else:
            gap.append(x)
    seen = [observed(x) for x in lines]
    turns: list[tuple[str, list[str]]] = []
    path = best_path([(k, x) for (k, _), x in zip(seen, lines, strict=True)])
    for (kind, rest), line, gap, state in zip(seen, lines, gaps, path, strict=True):
        role, opens = STATES[state]
        text = rest if kind in MARKERS and opens else line
        if opens or not turns:
            turns.append((role, [text]))
        else:
            turns[-1][1].extend([*gap, text])
    return [(role, "\n".join(x).strip()) for role, x in turns]


def rendered(turns: list[tuple[str, str]]) -> str:
    """Canonical form of turns."""
    return "".join(f"<|{role}|>\n{text}\n<|end|>\n" for role, text in turns)


def format_chats(df: DataFrame, text_col: str = "transcript", keep: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """``keep`` columns plus ``n_turns``, ``turns`` (role, text) and ``rendered`` of each transcript.

    A null or blank transcript has no turns and renders as ''. Each row is parsed by itself: repeated
    rows, null keys and further columns do not matter, and an empty table gives an empty result.
    """
    keep = list(keep)
    source = df.select(*keep, df[text_col].alias("__text"))
    turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "__text"):
                parsed = [parse(t or "") for t in part.column("__text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array([len(p) for p in parsed], pa.int64()),
                     pa.array([[{"role": r, "text": t} for r, t in p] for p in parsed], turn),
                     pa.array([rendered(p) for p in parsed], pa.string())], names=[*keep, "n_turns", "turns", "rendered"])

    schema = "".join(f"`{c}` {source.schema[c].dataType.simpleString()}, " for c in keep)
    return source.mapInArrow(kernel, f"{schema}n_turns long, turns array<struct<role: string, text: string>>, rendered string")
