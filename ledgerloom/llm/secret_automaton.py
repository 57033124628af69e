"""Secrets found by one automaton for all rules.

The regular expressions of all rules become one nondeterministic automaton over bytes, which
subset construction makes deterministic and partition refinement minimal. Its transition
array takes one step per byte of a text, whatever the number of rules, and tells where a
match of which rule is complete. Only there do two small automata of that rule run: its
mirror image back to the leftmost start, and itself forward to the longest end.

So the spans of a rule are its leftmost, longest, non-overlapping matches. This needs rules
in which a match that begins earlier is also complete no later, which holds for a fixed word
followed by a run of characters.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from re import _parser as regex_parser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerloom.llm.common import free_names, text_of


@dataclass(frozen=True)
class Rule:
    """``head`` and ``body`` are parts of one expression in ASCII; a match is kept if the
    characters after its longest head, or all of them, are ``least`` or more.

    Long minima belong in ``least``: a counter in an expression multiplies the states of the
    automaton for all rules.
    """

    kind: str
    head: str
    body: str
    least: int
    whole: bool = True  # count all characters of the match
    any_case: bool = False


# The base rules.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
        r"[A-Za-z0-9+/_.=-]+",
        8,
        whole=False,
        any_case=True,
    ),
    Rule("access", r"AKIA", r"[A-Z0-9]+", 16),
    Rule("hex", r"", r"[0-9a-f]{8,}", 32),
)
# Formats of well-known tokens, fixed values too.
MORE_RULES = (
    Rule("forge", r"gh[opsu]_", r"[A-Za-z0-9]+", 40),
    Rule("chat", r"xox[abprs]-", r"[A-Za-z0-9-]+", 29),
    Rule("pem", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", r"", 1),
)
RULES = BASE_RULES + MORE_RULES


class _Nfa:
    """Thompson automata: steps by sets of bytes, and empty steps."""

    def __init__(self) -> None:
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.empty.append([])
        return len(self.steps) - 1

    def add(self, parsed, begin: int, any_case: bool, mirrored: bool) -> int:
        """Append a parsed expression after ``begin``; returns its end."""
        items = list(parsed)
        for op, arg in reversed(items) if mirrored else items:
            begin = self._item(str(op), arg, begin, any_case, mirrored)
        return begin

    def _item(self, op: str, arg, begin: int, any_case: bool, mirrored: bool) -> int:
        if op == "SUBPATTERN":
            return self.add(arg[-1], begin, any_case, mirrored)
        end = self.state()
        if op in ("LITERAL", "IN"):
            chars = _chars([("LITERAL", arg)] if op == "LITERAL" else arg)
            if any_case:
                chars |= {ord(x) for c in chars for x in (chr(c).lower(), chr(c).upper())}
            self.steps[begin].append((frozenset(chars), end))
        elif op == "BRANCH":
            for branch in arg[1]:
                start = self.state()
                self.empty[begin].append(start)
                self.empty[self.add(branch, start, any_case, mirrored)].append(end)
        elif op == "MAX_REPEAT":
            least, most, inner = arg
            at = begin
            for _ in range(least):
                at = self.add(inner, at, any_case, mirrored)
            if most == regex_parser.MAXREPEAT:
                loop = self.state()
                self.empty[at].append(loop)
                self.empty[self.add(inner, loop, any_case, mirrored)].append(loop)
                self.empty[loop].append(end)
            else:
                self.empty[at].append(end)
                for _ in range(most - least):
                    at = self.add(inner, at, any_case, mirrored)
                    self.empty[at].append(end)
        else:
            raise ValueError(f"{op} is not part of the rules' language")
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


def _chars(items) -> set[int]:
    found: set[int] = set()
    for op, arg in items:
        if str(op) == "LITERAL":
            found.add(arg)
        elif str(op) == "RANGE":
            found.update(range(arg[0], arg[1] + 1))
        else:
            raise ValueError(f"{op} is not part of the rules' language")
    if max(found) > 127:
        raise ValueError("rules are in ASCII")
    return found


def _deterministic(nfa: _Nfa, begin: int, ends: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Subset construction and minimisation: transitions (states x 256), bits of the ends.

    State 0 is the beginning. Bytes that all steps treat alike are handled as one.
    """
    sets = {chars for steps in nfa.steps for chars, _ in steps}
    signature = defaultdict(list)
    for byte in range(256):
        signature[frozenset(i for i, chars in enumerate(sets) if byte in chars)].append(byte)
    alike = list(signature.values())
    known = {nfa.closure([begin]): 0}
    todo, rows = list(known), []
    while len(rows) < len(todo):
        now, row = todo[len(rows)], []
        for bytes_ in alike:
            step = {t for s in now for chars, t in nfa.steps[s] if bytes_[0] in chars}
            following = nfa.closure(step)
            if following not in known:
                known[following] = len(todo)
                todo.append(following)
            row.append(known[following])
        rows.append(row)
    table = np.array(rows)
    marks = np.array([sum(1 << k for s, k in ends.items() if s in states) for states in todo])
    # Refine by what can be told apart, until nothing more can.
    _, part = np.unique(marks, return_inverse=True)
    while True:
        told = np.column_stack([part, part[table]])
        _, finer = np.unique(told, axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == part.max():
            break
        part = finer
    first = np.array([np.flatnonzero(part == p)[0] for p in range(part.max() + 1)])
    # The beginning is state 0, states with an end come last.
    order = sorted(range(len(first)), key=lambda p: (marks[first[p]] != 0, p != part[0], p))
    number = np.empty(len(order), dtype=int)
    number[order] = np.arange(len(order))
    small = number[part[table[first[order]]]]
    wide = np.empty((len(order), 256), dtype=np.int32)
    for column, bytes_ in enumerate(alike):
        wide[:, bytes_] = small[:, [column]]
    return wide, marks[first[order]]


def _one(text: str, rule: Rule, mirrored: bool) -> tuple[np.ndarray, np.ndarray]:
    nfa = _Nfa()
    begin = nfa.state()
    end = nfa.add(regex_parser.parse(text), begin, rule.any_case, mirrored)
    return _deterministic(nfa, begin, {end: 0})


def _dead(table: np.ndarray, marks: np.ndarray) -> set[int]:
    """States that can't be left and accept nothing."""
    return {s for s in range(len(table)) if not marks[s] and (table[s] == s).all()}


class Automaton:
    """All rules compiled: one array for the pass over the bytes, and three for each rule."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        nfa = _Nfa()
        begin = nfa.state()
        nfa.steps[begin].append((frozenset(range(256)), begin))  # a match may begin anywhere
        ends = {}
        for k, rule in enumerate(rules):
            start = nfa.state()
            nfa.empty[begin].append(start)
            ends[nfa.add(regex_parser.parse(rule.head + rule.body), start, rule.any_case, False)] = k
        self.all = _deterministic(nfa, begin, ends)
        self.forward = [_one(r.head + r.body, r, False) for r in rules]
        self.backward = [_one(r.head + r.body, r, True) for r in rules]
        self.heads = [_one(r.head, r, False) for r in rules]

    def scanner(self):
        """A function from a text to its spans (rule number, start, end), in code points."""
        rules = self.rules
        table, marks = self.all
        # States are premultiplied, so that a step is one lookup.
        steps = (table.astype(np.int64) * 256).ravel().tolist()
        of_state = marks.tolist()
        final = int(np.flatnonzero(marks)[0]) * 256 if marks.any() else len(steps)
        small = [
            [(t.tolist(), [bool(x) for x in m], _dead(t, m)) for t, m in part]
            for part in (self.forward, self.backward, self.heads)
        ]
        forward, backward, heads = small

        def furthest(part, data: bytes, at: int, stop: int, step: int) -> int:
            """How far a run from ``at`` is an accepted one; -1 if nowhere."""
            table, ends, dead = part
            state, found = 0, at if ends[0] else -1
            while at != stop:
                state = table[state][data[at if step > 0 else at - 1]]
                at += step
                if ends[state]:
                    found = at
                elif state in dead:
                    break
            return found

        def spans(text: str) -> list[tuple[int, int, int]]:
            data = text.encode("utf-8", "surrogatepass")
            state, hits = 0, []
            for i, byte in enumerate(data):
                state = steps[state + byte]
                if state >= final:
                    hits.append((i + 1, of_state[state >> 8]))
            if not hits:
                return []
            free = [0] * len(rules)  # where the next match of a rule may begin
            found = []
            for end, mask in hits:
                for k, rule in enumerate(rules):
                    if not mask >> k & 1 or end <= free[k]:
                        continue
                    start = furthest(backward[k], data, end, free[k], -1)
                    if start < 0:
                        continue
                    stop = furthest(forward[k], data, start, len(data), 1)
                    free[k] = stop
                    body = start if rule.whole else furthest(heads[k], data, start, stop, 1)
                    if stop - body >= rule.least:
                        found.append((k, start, stop))
            if len(data) != len(text):
                starts = np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)
                point = lambda at: int(starts[at - 1]) if at else 0
                found = [(k, point(a), point(b)) for k, a, b in found]
            return sorted(found, key=lambda x: (x[1], x[0]))

        return spans


def secret_spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All spans of a text as ``kind:start:end``, comma-joined, by start, then by rule."""
    automaton = Automaton(rules)
    kinds = [r.kind for r in rules]
    held: list = []

    @F.pandas_udf(StringType())
    def scan(texts: pd.Series) -> pd.Series:
        if not held:
            held.append(automaton.scanner())
        spans = held[0]
        return pd.Series([",".join(f"{kinds[k]}:{a}:{b}" for k, a, b in spans(t)) for t in texts], dtype=object)

    return scan(text)


def find_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_column: str = "text", out: str = "spans"
) -> DataFrame:
    """``docs`` with ``out``: array of (kind, start, end), by start, then in the rules' order.

    Offsets are code points, ends exclusive. Null and empty texts have no spans; texts are
    scanned whole; repeated rows and other columns come through (a column called ``out`` is
    replaced).
    """
    (flat,) = free_names(docs, "_spans")
    parts = F.transform(
        F.split(F.col(flat), ","),
        lambda x: F.struct(
            F.split(x, ":")[0].alias("kind"),
            F.split(x, ":")[1].cast("bigint").alias("start"),
            F.split(x, ":")[2].cast("bigint").alias("end"),
        ),
    )
    nothing = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    found = docs.withColumn(flat, secret_spans(text_of(text_column), rules))
    return found.withColumn(out, F.when(F.col(flat) == "", nothing).otherwise(parts)).drop(flat)


@F.pandas_udf(StringType())
def _masked(texts: pd.Series, spans: pd.Series) -> pd.Series:
    def mask(text: str, flat: str) -> str:
        out, at = [], 0
        for x in flat.split(","):
            kind, start, end = x.split(":")
            start, end = int(start), int(end)
            if start >= at:
                out += [text[at:start], f"[{kind}]"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    return pd.Series([mask(t, s) if s else t for t, s in zip(texts, spans, strict=True)], dtype=object)


def mask_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_column: str = "text", length_column: str | None = "n_chars"
) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans are one.

    A text without spans stays as it is, and a null text stays null. ``length_column`` (code
    points) follows the text where the text changed. Columns and their order stay.
    """
    flat, new = free_names(docs, "_spans", "_masked")
    text = text_of(text_column)
    found = docs.withColumn(flat, secret_spans(text, rules))
    masked = found.withColumn(new, _masked(text, F.col(flat)))
    changed = {text_column: F.when(F.col(flat) != "", F.col(new)).otherwise(F.col(text_column))}
    if length_column in docs.columns:
        length = F.char_length(F.col(new)).cast(docs.schema[length_column].dataType)
        changed[length_column] = F.when(F.col(flat) != "", length).otherwise(F.col(length_column))
    return masked.withColumns(changed).select(*docs.columns)
