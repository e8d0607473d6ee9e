"""Secret scans: fixed patterns, and formats inferred from what they find.

The patterns label credentials. From a bounded sample of labelled values, at most ``labelled`` of each kind, a probabilistic
automaton is inferred per kind: the prefix tree of the values, written as character classes, whose states are merged where their
counts of symbols and ends agree within a Hoeffding bound. Every maximal run of credential characters in every text is a
candidate; its score is the log likelihood ratio per character between the best automaton and ordinary runs. The limit lies
half-way between ordinary runs and labelled values that the automata have not seen, of which at least ``recall`` pass. Candidates above it that no pattern has found are added.

Nulls and ties: NULL and empty texts have no spans; rows that repeat are scanned alike; spans are counted in
code points; of spans that start together the kinds are ordered as listed; other columns pass through. Without labelled
values there are no automata and only the patterns count.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabstand.llm.common import slices, stored

KINDS = ("assign", "access", "hex", "inferred")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
RUN = re.compile(r"[A-Za-z0-9+/_.=-]+")
#: A candidate is at least this many nats per character likelier as a credential than as an ordinary run.
LEAST_RATIO = 0.5
LEAST = {"assign": 12, "access": 18, "hex": 16, "inferred": 16}

IN_RUN = np.zeros(256, dtype=bool)
IN_RUN[[c for c in range(128) if RUN.match(chr(c))]] = True


def classed(value: str) -> str:
    """Characters by class: digits, the letters that hexadecimal numbers use, other letters, each sign for itself."""
    return value.translate(CLASSES)


CLASSES = {ord(c): "0" for c in "0123456789"}
CLASSES |= {ord(c): "a" for c in "abcdef"} | {ord(c): "z" for c in "ghijklmnopqrstuvwxyz"}
CLASSES |= {ord(c): "A" for c in "ABCDEF"} | {ord(c): "Z" for c in "GHIJKLMNOPQRSTUVWXYZ"}
SIZES = {"0": 10, "a": 6, "z": 20, "A": 6, "Z": 20}


class Automaton:
    """A probabilistic automaton inferred by merging the states of a prefix tree."""

    def __init__(self, values: Iterable[str], confidence: float = 0.05):
        self.bound = math.sqrt(0.5 * math.log(2 / confidence))
        #: Per state: strings that pass, strings that end, and by symbol the next state and how many take it.
        self.passing, self.ending, self.next = [0], [0], [{}]
        for value in values:
            state = 0
            self.passing[0] += 1
            for symbol in classed(value):
                to, n = self.next[state].get(symbol, (len(self.next), 0))
                if to == len(self.next):
                    self.passing.append(0)
                    self.ending.append(0)
                    self.next.append({})
                self.next[state][symbol] = (to, n + 1)
                state = to
                self.passing[state] += 1
            self.ending[state] += 1
        self._merge_all()

    def _differ(self, a: int, n: int, b: int, m: int) -> bool:
        return n > 0 and m > 0 and abs(a / n - b / m) > self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, one: int, two: int) -> bool:
        waiting = [(one, two)]
        while waiting:
            p, q = waiting.pop()
            n, m = self.passing[p], self.passing[q]
            if self._differ(self.ending[p], n, self.ending[q], m):
                return False
            for symbol in self.next[p].keys() | self.next[q].keys():
                to_p, in_p = self.next[p].get(symbol, (None, 0))
                to_q, in_q = self.next[q].get(symbol, (None, 0))
                if self._differ(in_p, n, in_q, m):
                    return False
                if to_p is not None and to_q is not None and to_p != to_q:
                    waiting.append((to_p, to_q))
        return True

    def _fold(self, red: int, blue: int) -> None:
        """Adds the tree below ``blue`` to ``red``."""
        waiting = [(red, blue)]
        while waiting:
            p, q = waiting.pop()
            self.passing[p] += self.passing[q]
            self.ending[p] += self.ending[q]
            for symbol, (to_q, n) in self.next[q].items():
                if symbol in self.next[p]:
                    to_p, m = self.next[p][symbol]
                    self.next[p][symbol] = (to_p, m + n)
                    waiting.append((to_p, to_q))
                else:
                    self.next[p][symbol] = (to_q, n)

    def _merge_all(self) -> None:
        red = [0]
        while True:
            blue = [(state, symbol, to) for state in red for symbol, (to, _) in sorted(self.next[state].items()) if to not in red]
            if not blue:
                break
            state, symbol, to = max(blue, key=lambda b: (self.passing[b[2]], -b[2]))
            for other in red:
                if self._compatible(other, to):
                    self.next[state][symbol] = (other, self.next[state][symbol][1])
                    self._fold(other, to)
                    break
            else:
                red.append(to)
        self.states = {state: i for i, state in enumerate(red)}
        self.rules = [
            {s: (self.states[to], math.log((n + 0.01) / (self.passing[state] + 0.2))) for s, (to, n) in self.next[state].items()}
            for state in red
        ]
        self.ends = [math.log((self.ending[state] + 0.01) / (self.passing[state] + 0.2)) for state in red]
        self.missing = math.log(0.001)

    def score(self, symbols: str) -> float:
        """Log likelihood of a string of classes; a step that no rule allows starts again at a price."""
        state, total = 0, 0.0
        for symbol in symbols:
            state, log = self.rules[state].get(symbol, (0, self.missing))
            total += log
        return total + self.ends[state]


class Ordinary:
    """Class bigrams of ordinary runs."""

    def __init__(self, values: Iterable[str]):
        self.pairs: dict[str, int] = {}
        self.firsts: dict[str, int] = {}
        for value in values:
            symbols = "^" + classed(value) + "$"
            for a, b in zip(symbols, symbols[1:]):
                self.pairs[a + b] = self.pairs.get(a + b, 0) + 1
                self.firsts[a] = self.firsts.get(a, 0) + 1

    def score(self, symbols: str) -> float:
        symbols = "^" + symbols + "$"
        return sum(
            math.log((self.pairs.get(a + b, 0) + 1) / (self.firsts.get(a, 0) + 12)) for a, b in zip(symbols, symbols[1:])
        )


@dataclass
class Formats:
    """Automata by kind, the model of ordinary runs and the limit of the score."""

    automata: dict[str, Automaton] = field(default_factory=dict)
    ordinary: Ordinary | None = None
    limit: float = math.inf

    def score(self, value: str) -> float:
        symbols = classed(value)
        plain = self.ordinary.score(symbols)
        return max((a.score(symbols) - plain) / len(symbols) for a in self.automata.values())

    def accepts(self, value: str) -> bool:
        return bool(self.automata) and self.score(value) >= self.limit


def pattern_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) of what the patterns find, leftmost and without overlaps within a kind."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # Runs of credential characters hold all runs of hexadecimal ones.
    for run in RUN.finditer(text):
        if run.end() - run.start() >= LEAST["hex"]:
            found += [
                (run.start() + m.start(), 2, run.start() + m.end(), m[0])
                for m in HEX.finditer(run[0])
                if m.end() - m.start() >= LEAST["hex"]
            ]
    return sorted(found)


def long_runs(data: np.ndarray, offsets: np.ndarray, least: int) -> np.ndarray:
    """Which rows have a run of at least ``least`` credential characters."""
    inside = np.concatenate([[False], IN_RUN[data], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    # Runs that go on over the end of a row are cut there.
    row = np.searchsorted(offsets, starts, side="right") - 1
    long = ends - starts >= least
    out = np.zeros(len(offsets) - 1, dtype=bool)
    for r, s, e in zip(row[long].tolist(), starts[long].tolist(), ends[long].tolist()):
        while s < e:
            stop = min(e, int(offsets[r + 1]))
            out[r] |= stop - s >= least
            s, r = stop, r + 1
    return out


def inferred_spans(text: str, base: list[tuple[int, int, int, str]], formats: Formats) -> list[tuple[int, int, int, str]]:
    taken = [(s, e) for s, _, e, _ in base]
    return [
        (run.start(), 3, run.end(), run[0])
        for run in RUN.finditer(text)
        if run.end() - run.start() >= LEAST["inferred"]
        and not any(s < run.end() and run.start() < e for s, e in taken)
        and formats.accepts(run[0])
    ]


def labelled_values(docs: DataFrame, labelled: int, text: str) -> DataFrame:
    """(kind, value): up to ``labelled`` distinct values of each kind of pattern, and of ordinary runs, drawn by hash."""

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, values = [], []
            for at, data, offsets in slices(batch.column(0)):
                for row in np.flatnonzero(long_runs(data, offsets, LEAST["assign"])).tolist():
                    body = data[offsets[row] : offsets[row + 1]].tobytes().decode("utf-8", "replace")
                    spans = pattern_spans(body)
                    for _, kind, _, value in spans:
                        kinds.append(KINDS[kind])
                        values.append(value)
                    if not spans:
                        ordinary = {r for r in RUN.findall(body) if len(r) >= LEAST["assign"]}
                        kinds += ["ordinary"] * len(ordinary)
                        values += ordinary
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())], ["kind", "value"])

    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("body")
    values = docs.select(body).mapInArrow(label, "kind string, value string").distinct()
    by_hash = Window.partitionBy("kind").orderBy(F.xxhash64("value"), "value")
    return values.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= labelled).select("kind", "value", "rank")


def infer_formats(docs: DataFrame, labelled: int = 600, recall: float = 0.95, text: str = "text") -> Formats:
    """Formats from a sample of at most ``labelled`` values a kind: three quarters teach, one quarter sets the limit."""
    rows = stored(labelled_values(docs, labelled, text)).toPandas().sort_values(["kind", "rank"])
    of = lambda kind: rows.loc[rows["kind"] == kind, "value"].tolist()
    teach = lambda values: [v for i, v in enumerate(values) if i % 4]
    hold = lambda values: values[::4]
    automata = {kind: Automaton(teach(of(kind))) for kind in KINDS[:3] if len(of(kind)) >= 8}
    formats = Formats(automata, Ordinary(teach(of("ordinary"))))
    if not automata:
        return formats
    held = sorted(formats.score(v) for kind in automata for v in hold(of(kind)))
    # Ordinary runs may hold a credential that no pattern names, so their highest scores don't count.
    plain = sorted(map(formats.score, of("ordinary"))) or [0.0]
    plain = plain[int(0.98 * (len(plain) - 1))]
    formats.limit = max((held[int((1 - recall) * len(held))] + plain) / 2, LEAST_RATIO)
    return formats


def scanned(docs: DataFrame, formats: Formats, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``found``: the spans (kind, start, end, value) in order."""
    kept = [name for name in docs.columns if name not in (text, "found")]
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("value", T.StringType())])
    schema = T.StructType([docs.schema[name] for name in kept] + [T.StructField("found", T.ArrayType(span))])
    shipped = docs.sparkSession.sparkContext.broadcast(formats)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formats = shipped.value
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))
        for batch in batches:
            out: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for at, data, offsets in slices(batch.column(batch.num_columns - 1)):
                for row in np.flatnonzero(long_runs(data, offsets, LEAST["assign"])).tolist():
                    body = data[offsets[row] : offsets[row + 1]].tobytes().decode("utf-8", "replace")
                    base = pattern_spans(body)
                    spans = sorted(base + inferred_spans(body, base, formats))
                    out[at + row] = [{"kind": KINDS[k], "start": s, "end": e, "value": v} for s, k, e, v in spans]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, kind)], [*kept, "found"])

    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return docs.select(*[F.col(f"`{n}`") for n in kept], body.alias("_body")).mapInArrow(scan, schema)
