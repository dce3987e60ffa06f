"""Secret scans (10): all rules as one deterministic automaton over bytes.

``compile_rules`` parses each rule's regular expression, builds one NFA for
all of them, turns it into a DFA by subset construction (unanchored: the
start states are in every subset) and minimises that by partition
refinement.  The result is a transition array (state x byte class) and, for
each state, a bit mask of the rules that end there.

A scan reads every byte once.  Bytes that lead every state back to the start
cut the text into independent pieces, which are stepped side by side.  Where
a rule has ended in a piece, its exact expression gives the spans there
(leftmost, not overlapping, per kind).

Results for odd input: a null or empty text has no spans; repeated rows get
the same result; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.llm.common import slices


@dataclass(frozen=True)
class Rule:
    """``scan``: what the automaton looks for, true of every match that counts.
    ``exact``: the expression whose leftmost matches are taken.  Matches whose
    ``group`` is shorter than ``least`` are dropped."""
    kind: str
    scan: str
    exact: str
    group: int = 0
    least: int = 1


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + \
    "|" + _either_case("api") + "_?" + _either_case("key")
_ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?"""

# The three base rules, in the order in which they are listed.
BASE_RULES = (
    Rule("assign", _ASSIGN + r"[A-Za-z0-9+/_.=\-]{6}", _ASSIGN + r"([A-Za-z0-9+/_.=\-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16}", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24}", r"[0-9a-f]+", 0, 24),
)
# Public token formats, found in addition (the automaton looks for their marks).
MORE_RULES = (
    Rule("github", r"gh[pousr]_", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]\-", r"xox[abprs]-[A-Za-z0-9\-]+", 0, 16),
    Rule("google", r"AIza", r"AIza[A-Za-z0-9_\-]+", 0, 39),
    Rule("jwt", r"\.eyJ",
         r"eyJ[A-Za-z0-9_\-]+\.eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+", 0, 40),
    Rule("pem", r"\-\-\-\-\-BEGIN [A-Z ]*PRIVATE KEY\-\-\-\-\-", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES


# ------------------------------------------------------------------ compiling


class _Nfa:
    """Thompson construction of a byte NFA from literals, classes, groups, ``|``, ``?``, ``*``, ``+``, ``{n}``."""

    def __init__(self) -> None:
        self.free: list[set[int]] = []                       # moves that read nothing
        self.moves: list[tuple[frozenset[int], int] | None] = []   # (bytes, next state)
        self.rule: list[int] = []                            # rule of each state
        self.ends: dict[int, int] = {}                       # last state of a rule -> rule

    def state(self) -> int:
        self.free.append(set())
        self.moves.append(None)
        self.rule.append(self.now)
        return len(self.free) - 1

    def add(self, pattern: str, rule: int) -> int:
        self.src, self.at, self.now = pattern, 0, rule
        first, last = self._either()
        if self.at != len(pattern):
            raise ValueError(f"cannot read rule at {self.at}: {pattern}")
        self.ends[last] = rule
        return first

    def _peek(self) -> str:
        return self.src[self.at: self.at + 1]

    def _either(self) -> tuple[int, int]:
        branches = [self._sequence()]
        while self._peek() == "|":
            self.at += 1
            branches.append(self._sequence())
        if len(branches) == 1:
            return branches[0]
        first, last = self.state(), self.state()
        for a, b in branches:
            self.free[first].add(a)
            self.free[b].add(last)
        return first, last

    def _sequence(self) -> tuple[int, int]:
        first = last = self.state()
        while self._peek() not in ("", "|", ")"):
            begin = self.at
            a, b = self._atom()
            end = self.at
            times = re.compile(r"\{(\d+)\}").match(self.src, self.at)
            if times:
                for _ in range(int(times[1]) - 1):
                    self.at = begin
                    c, d = self._atom()
                    self.free[b].add(c)
                    b = d
                self.at = times.end()
            elif self._peek() in ("?", "*", "+") and self._peek():
                mark, self.at = self._peek(), end + 1
                enter, leave = self.state(), self.state()
                self.free[enter].add(a)
                self.free[b].add(leave)
                if mark != "+":
                    self.free[enter].add(leave)
                if mark != "?":
                    self.free[b].add(a)
                a, b = enter, leave
            self.free[last].add(a)
            last = b
        return first, last

    def _atom(self) -> tuple[int, int]:
        c = self._peek()
        if c == "(":
            self.at += 1
            a, b = self._either()
            self.at += 1
            return a, b
        chars = self._class() if c == "[" else {self._char()}
        a, b = self.state(), self.state()
        self.moves[a] = (frozenset(chars), b)
        return a, b

    def _char(self) -> int:
        c = self.src[self.at]
        self.at += 1
        if c != "\\":
            return ord(c)
        c = self.src[self.at]
        self.at += 1
        if c == "x":
            self.at += 2
            return int(self.src[self.at - 2: self.at], 16)
        return ord(c)

    def _class(self) -> set[int]:
        self.at += 1
        out: set[int] = set()
        while self._peek() != "]":
            a = self._char()
            if self._peek() == "-" and self.src[self.at + 1] != "]":
                self.at += 1
                out |= set(range(a, self._char() + 1))
            else:
                out.add(a)
        self.at += 1
        return out


LONG = 4096                  # bytes; longer pieces are stepped in stretches of this size


@dataclass(frozen=True)
class Automaton:
    byte_class: np.ndarray   # 256 -> class
    moves: np.ndarray        # state * classes + class -> next state; state 0 is the start
    ends: np.ndarray         # state -> bit mask of the rules that end there (surely the first time in a piece)
    cuts: np.ndarray         # 256 booleans: bytes after which every state is the start
    shortest: int            # bytes of the shortest text in which a rule ends

    @property
    def classes(self) -> int:
        return len(self.moves) // len(self.ends)


def compile_rules(patterns: Sequence[str]) -> Automaton:
    """One minimal DFA that finds where any of ``patterns`` ends, with the rules that end there."""
    nfa = _Nfa()
    starts = [nfa.add(p, i) for i, p in enumerate(patterns)]

    def closed(states) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in nfa.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(s for s in seen if nfa.moves[s] or s in nfa.ends)

    # p covers q (of the same rule) if p ends no later than q on every text (greatest fixed
    # point).  A scan only asks whether a rule has ended in a piece, so a covered state adds
    # nothing to a subset; leaving it out keeps counters from multiplying.
    after = {s: closed({m[1]}) for s, m in enumerate(nfa.moves) if m}
    covers = {(q, p) for q in after for p in after if q != p and nfa.rule[q] == nfa.rule[p] and nfa.moves[q][0] <= nfa.moves[p][0]}
    covers |= {(q, e) for e in nfa.ends for q in after if nfa.rule[q] == nfa.rule[e]}
    while True:
        kept = {(q, p) for q, p in covers
                if p in nfa.ends or all(a in after[p] or any((a, b) in covers for b in after[p]) for a in after[q])}
        if kept == covers:
            break
        covers = kept
    covered_by = {q: {p for x, p in covers if x == q and ((p, q) not in covers or p < q)} for q in after}

    def lean(states: frozenset[int]) -> frozenset[int]:
        return frozenset(q for q in states if not covered_by.get(q, set()) & states)

    # bytes that every move treats alike form one class
    sets = list(dict.fromkeys(m[0] for m in nfa.moves if m))
    member = np.array([[b in s for s in sets] for b in range(256)])
    _, sample, byte_class = np.unique(member, axis=0, return_index=True, return_inverse=True)
    byte_class = byte_class.ravel()

    base = lean(closed(starts))
    number, todo, table, ends = {base: 0}, [base], [], []
    while todo:                                              # subset construction
        now = todo.pop(0)
        row = []
        for b in sample:
            new = lean(closed({nfa.moves[s][1] for s in now if nfa.moves[s] and int(b) in nfa.moves[s][0]}) | base)
            if new not in number:
                number[new] = len(number)
                todo.append(new)
            row.append(number[new])
        table.append(row)
        ends.append(sum({1 << nfa.ends[s] for s in now if s in nfa.ends}))
    moves, ends = np.array(table), np.array(ends)

    _, part = np.unique(ends, return_inverse=True)           # minimisation: refine until stable
    while True:
        _, finer = np.unique(np.column_stack([part, part[moves]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == part.max():
            break
        part = finer
    names = np.full(part.max() + 1, -1)
    order = [part[0], *(p for p in dict.fromkeys(part.tolist()) if p != part[0])]
    names[order] = np.arange(len(order))
    part = names[part]
    sample_state = np.zeros(len(order), dtype=int)
    sample_state[part[::-1]] = np.arange(len(part))[::-1]
    moves, ends = part[moves[sample_state]], ends[sample_state]

    reached, seen, shortest = {0}, {0}, 0
    while reached and not any(ends[s] for s in reached):
        reached = {int(t) for s in reached for t in moves[s]} - seen
        seen |= reached
        shortest += 1
    cut_class = (moves == 0).all(axis=0)
    return Automaton(byte_class.astype(np.uint8), moves.astype(np.int32).ravel(), ends.astype(np.int32),
                     cut_class[byte_class], shortest)


def bytes_of(pattern: str) -> np.ndarray:
    """256 booleans: the bytes that a text matching ``pattern`` can hold."""
    nfa = _Nfa()
    nfa.add(pattern, 0)
    out = np.zeros(256, dtype=bool)
    for move in nfa.moves:
        if move:
            out[list(move[0])] = True
    return out


# ------------------------------------------------------------------- scanning


def scan_bytes(data: np.ndarray, bounds: np.ndarray, dfa: Automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of ``data`` in which a rule ends: (begin, end, mask of rules).  No piece crosses ``bounds``.

    Pieces are stepped side by side; those longer than ``LONG`` one by one, their stretches side by side."""
    stop = dfa.cuts[data]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    begin = np.unique(np.concatenate([[0], np.flatnonzero(stop) + 1, inner]))
    begin = begin[begin < len(data)]
    end = np.append(begin[1:], len(data))
    end = end - stop[np.maximum(end - 1, 0)] if len(end) else end
    long = end - begin >= dfa.shortest
    begin, end = begin[long], end[long]
    order = np.argsort(begin - end, kind="stable")           # longest first
    begin, end = begin[order], end[order]
    length = end - begin
    classes, width = dfa.byte_class[data], dfa.classes
    state = np.zeros(len(begin), dtype=np.int32)
    hits = np.zeros(len(begin), dtype=np.int32)
    n_long = int((length > LONG).sum())
    for i in range(n_long):
        hits[i] = _scan_long(classes[begin[i]: end[i]], dfa)
    top = int(length[n_long]) if len(length) > n_long else 0
    live = len(length) - np.searchsorted(length[::-1], np.arange(top), side="right")
    for t in range(top):
        k = live[t]
        now = dfa.moves[state[n_long:k] * width + classes[begin[n_long:k] + t]]
        state[n_long:k] = now
        hits[n_long:k] |= dfa.ends[now]
    found = np.flatnonzero(hits)
    found = found[np.argsort(begin[found])]
    return begin[found], end[found], hits[found]


def _scan_long(classes: np.ndarray, dfa: Automaton, step: int = LONG) -> int:
    """The rules that end in one long piece: its stretches of ``step`` bytes run side by side from the start state; a stretch
    whose true entry state turns out to be another is run again, up to where it meets the states it had before."""
    k = -(-len(classes) // step)
    grid = np.zeros(k * step, dtype=classes.dtype)
    grid[: len(classes)] = classes
    grid = grid.reshape(k, step)
    path = np.empty((step, k), dtype=np.int32)
    entry, state = np.zeros(k, dtype=np.int32), np.zeros(k, dtype=np.int32)
    for t in range(step):
        path[t] = state = dfa.moves[state * dfa.classes + grid[:, t]]
    while True:
        true = np.append(np.int32(0), path[-1, :-1])
        live = np.flatnonzero(true != entry)
        if not len(live):
            break
        entry, state = true, true[live]
        for t in range(step):
            state = dfa.moves[state * dfa.classes + grid[live, t]]
            apart = path[t, live] != state
            live, state = live[apart], state[apart]
            if not len(live):
                break
            path[t, live] = state
    return int(np.bitwise_or.reduce(dfa.ends[path.T.ravel()[: len(classes)]]))


class Scanner:
    """Finds all ``rules``, also one alone, side by side in one pass over the bytes (none: finds nothing).

    The automaton marks the pieces in which a rule ends; the spans of a marked piece come from the rule's ``exact`` expression
    by Python's ``re``.  ``exact`` uses the same syntax as ``scan`` (literals, classes, groups, ``| ? * + {n}``) and has the group that the rule names.
    Two rules of one kind both give their spans under it."""

    def __init__(self, rules: Sequence[Rule] = RULES):
        if len(rules) > 31:
            raise ValueError("a scan takes at most 31 rules; scan twice for more")
        self.rules = tuple(rules)
        self.exact = [re.compile(r.exact, re.ASCII) for r in rules]
        for r, x in zip(rules, self.exact, strict=True):
            if r.group > x.groups:
                raise ValueError(f"rule {r.kind} has no group {r.group}")
        if rules:
            dfa = compile_rules([r.scan for r in rules])
            # a piece must not end at a byte that one of its secrets can hold
            self.dfa = replace(dfa, cuts=dfa.cuts & ~np.logical_or.reduce([bytes_of(r.exact) for r in rules]))

    def spans(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """For each text its (start, rule, end) by start, then rule; code points, end exclusive."""
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        upto = np.cumsum(sizes)
        data = np.frombuffer(b"".join(texts.to_pylist()), dtype=np.uint8)
        out: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
        if not len(data) or not self.rules:
            return out
        begin, end, mask = scan_bytes(data, upto, self.dfa)
        of = np.searchsorted(upto, begin, side="right")
        last = (-1, 0, 0)                                    # text, bytes read, code points read
        for d, a, b, m in zip(of.tolist(), begin.tolist(), end.tolist(), mask.tolist(), strict=True):
            if last[0] != d:
                last = (d, int(upto[d] - sizes[d]), 0)
            shift = last[2] + _points(data[last[1]:a])
            last = (d, a, shift)
            piece = data[a:b].tobytes().decode("utf-8", "replace")
            for i, r in enumerate(self.rules):
                if m >> i & 1:
                    out[d] += [(shift + x.start(), i, shift + x.end()) for x in self.exact[i].finditer(piece)
                               if len(x[r.group]) >= r.least]
        for s in out:
            s.sort()
        return out


def _points(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes: those that do not continue a character."""
    return int(((data & 0xC0) != 0x80).sum())


def written(spans: list[tuple[int, int, int]], rules: Sequence[Rule]) -> str:
    return ",".join(f"{rules[i].kind}:{a}:{b}" for a, i, b in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: doc_id, kinds (the rule of each span), starts, ends (arrays by start, then rule)."""
    scanner = Scanner(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            found = scanner.spans(b.column("text"))
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"),
                pa.array([[scanner.rules[i].kind for _, i, _ in s] for s in found], pa.list_(pa.string())),
                pa.array([[a for a, _, _ in s] for s in found], pa.list_(pa.int64())),
                pa.array([[e for _, _, e in s] for s in found], pa.list_(pa.int64())),
            ], names=["doc_id", "kinds", "starts", "ends"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, kinds array<string>, starts array<long>, ends array<long>")


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
           rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with each secret replaced by its kind in angle brackets (of spans that
    overlap, their union by the first one's kind); ``length_col`` gets the new length.
    Texts without a secret, and nulls, stay as they are."""
    scanner, names = Scanner(rules), docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col):
            found = scanner.spans(b.column(at))
            texts = b.column(at).to_pylist()
            for i, s in enumerate(found):
                if s:
                    texts[i] = _replaced(texts[i], s, scanner.rules)
            new = pa.array(texts, pa.string())
            columns = [new if i == at else c for i, c in enumerate(b.columns)]
            if length_col in names:
                k = names.index(length_col)
                hit = pa.array([bool(s) for s in found])
                columns[k] = pc.if_else(hit, pc.utf8_length(new).cast(columns[k].type), columns[k])
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)


def _replaced(text: str, spans: list[tuple[int, int, int]], rules: Sequence[Rule]) -> str:
    out, at, k = [], 0, 0
    while k < len(spans):
        a, i, e = spans[k]
        k += 1
        while k < len(spans) and spans[k][0] < e:
            e = max(e, spans[k][2])
            k += 1
        out += [text[at:a], f"<{rules[i].kind}>"]
        at = e
    return "".join([*out, text[at:]])


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, a hash of the base spans, and all spans as text."""
    spans = "transform({}, x -> concat_ws(':', x.kinds, x.starts, x.ends))"
    every = "arrays_zip(kinds, starts, ends)"
    kinds = [r.kind for r in BASE_RULES]
    base = f"filter({every}, x -> x.kinds in ({', '.join(repr(k) for k in kinds)}))"
    return found.select(
        "doc_id", *[F.expr(f"cast(size(filter(kinds, k -> k = '{k}')) as bigint)").alias(f"n_{k}") for k in kinds],
        F.sha2(F.concat_ws(",", F.expr(spans.format(base))), 256).alias("base_sha256"),
        F.concat_ws(",", F.expr(spans.format(every))).alias("spans"))
